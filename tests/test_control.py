"""As-of values, options that change over time, and folds in segments, against plain readings."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewarden.learning.detector import Detector, fold_block
from tidewarden.learning.exact import detections_of, exact_fold, exact_fold_in_segments, final_state
from tidewarden.operators import control, metrics
from tidewarden.operators.ordered import as_of
from tidewarden.schema import DetectorOptions
from tidewarden.sources import codec

START = dt.datetime(2024, 1, 1)
OPTIONS = DetectorOptions(n_models=2, drift_delta=0.3)


@pytest.mark.parametrize("width", [None, 60])
def test_as_of_takes_the_newest_fact(spark, width):
    """One key holds most rows; facts tie, probes have no time, no fact, or a null key."""
    draw = random.Random(7)
    at = lambda k: None if k is None else START + dt.timedelta(seconds=k)
    facts = [(draw.choice([0, 0, 0, 1]), draw.randint(100, 900), i, i * 1.5 if i % 7 else None) for i in range(200)]
    facts += [(None, 300, 900, 9.0), (0, None, 901, 1.0), (0, 500, 902, 7.0), (0, 500, 903, None)]
    probes = [(draw.choice([0, 0, 0, 1, 2]), draw.choice([None, *range(0, 1000, 13)]), i) for i in range(150)] + [(None, 301, 150)]
    found = as_of(
        spark.createDataFrame([(k, at(t), p) for k, t, p in probes], "shard int, ts timestamp, probe int"),
        spark.createDataFrame([(k, at(t), n, v) for k, t, n, v in facts], "shard int, ts timestamp, nth int, v double"),
        ("nth", "v"), "nth", width=width,
    )
    plain = {}
    for key, time, probe in probes:
        known = [(t, n, v) for k, t, n, v in facts if k == key and t is not None and time is not None and t <= time]
        plain[probe] = max(known, key=lambda f: f[:2])[1:] if known else (None, None)
    assert {r["probe"]: (r["nth"], r["v"]) for r in found.collect()} == plain
    assert as_of(found.select("shard", "ts", "probe").limit(0), found.limit(0), ("v",), "probe").isEmpty()


def test_metrics_stand_until_the_next_multiple(spark):
    rows = [(0, START + dt.timedelta(minutes=i), i, i % 3 == 0, i % 2 == 0) for i in range(25)]
    found = spark.createDataFrame(rows, "shard int, ts timestamp, event_id long, is_bot_pred boolean, is_bot boolean")
    standing = metrics.metrics_in_force(found, found.select("shard", "ts", "event_id"), OPTIONS.with_(update_frequency=10))
    by_id = {r["event_id"]: r for r in standing.collect()}
    assert by_id[8]["instance_number"] == 0 and by_id[8]["precision"] == 0.0
    assert {by_id[i]["instance_number"] for i in range(9, 19)} == {10} and by_id[24]["instance_number"] == 20
    assert by_id[12]["tp"] == sum(p and b for _, _, _, p, b in rows[:10])


def table(spark, versions):
    at = lambda m: None if m is None else START + dt.timedelta(minutes=m)
    return spark.createDataFrame([(at(m), t, d) for m, t, d in versions], control.CONTROL_SCHEMA)


def test_versions_hold_from_their_time(spark):
    versions = [(10, 0.9, None), (20, None, False), (30, 7.0, True), (None, 0.1, False), (30, 0.2, None)]
    rows = [(i, None if i == 99 else START + dt.timedelta(minutes=i)) for i in (0, 9, 10, 19, 20, 29, 30, 50, 99)]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp")
    found = {r["event_id"]: (r["threshold"], r["drift_on"]) for r in control.with_control(events, table(spark, versions), OPTIONS).collect()}
    own, strict, off, last = (0.6, True), (0.9, True), (0.9, False), (1.0, True)
    assert found == {0: own, 9: own, 10: strict, 19: strict, 20: off, 29: off, 30: last, 50: last, 99: own}
    none = control.with_control(events, table(spark, []), OPTIONS).select("threshold", "drift_on").distinct().collect()
    assert [tuple(r) for r in none] == [own]
    with pytest.raises(ValueError):
        many = spark.range(control.MAX_VERSIONS + 1).select(F.timestamp_seconds("id").alias("valid_from"), F.lit(0.5).alias("threshold"), F.lit(True).alias("drift_on"))
        control.with_control(events, many, OPTIONS)


def test_fold_obeys_the_versions(spark, traffic):
    """A threshold changes at once; while the drift test is off nothing is observed, later it goes on."""
    first, last = traffic.agg(F.min("ts"), F.max("ts")).first()
    minutes = [int((first + (last - first) * k / 3 - START).total_seconds() // 60) for k in (1, 2)]
    versions = table(spark, [(minutes[0], 0.95, False), (minutes[1], 0.2, True)])
    rows = control.with_control(traffic, versions, OPTIONS).cache()
    found = {r["event_id"]: r for r in detections_of(exact_fold(rows, OPTIONS)).collect()}
    for r in rows.select("event_id", "shard", "threshold", "drift_on").collect():
        mine = found[r["event_id"]]
        assert mine["is_bot_pred"] == (mine["vote"] and mine["confidence"] >= r["threshold"])
        assert r["drift_on"] or not (mine["drift"] or mine["warning"])
    checked = rows.filter("drift_on").groupBy("shard").count().collect()
    for shard, count in checked:
        assert max(r["instance_number"] for r in found.values() if r["shard"] == shard) == count


def test_constant_columns_change_nothing():
    draw = np.random.default_rng(1)
    x, labels, copies = draw.random((300, 14)), draw.random(300) < 0.4, draw.poisson(1.0, (300, 2))
    plain = fold_block(Detector.fresh(OPTIONS), x, labels, copies, OPTIONS)
    ruled = fold_block(Detector.fresh(OPTIONS), x, labels, copies, OPTIONS, threshold=np.full(300, OPTIONS.threshold), drift_on=np.ones(300, bool))
    assert all((plain[name] == ruled[name]).all() for name in plain)


def test_segments_give_one_fold(spark, traffic, tmp_path):
    """Also when a run stops after any segment and is started again."""
    columns = ("event_id", "is_bot_pred", "bot_votes", "drift", "window_length", "instance_number")
    whole = exact_fold(traffic, OPTIONS).cache()
    span = traffic.agg(F.max(F.unix_micros("ts")) - F.min(F.unix_micros("ts"))).first()[0] // 1_000_000
    seconds = span // 3 + 1
    early = traffic.filter(F.floor(F.unix_micros("ts") / (seconds * 1_000_000)) == traffic.select(F.min(F.floor(F.unix_micros("ts") / (seconds * 1_000_000)))).first()[0])
    exact_fold_in_segments(early, OPTIONS, seconds, str(tmp_path / "run"))  # a run that stopped here
    folded = exact_fold_in_segments(traffic, OPTIONS, seconds, str(tmp_path / "run"))
    found = detections_of(folded)
    assert found.count() == 1000 and found.select(*columns).exceptAll(detections_of(whole).select(*columns)).isEmpty()
    mine, plain = (sorted((r["shard"], r["model_id"], r["n"], r["seen"], r["correct"]) for r in final_state(f).collect()) for f in (folded, whole))
    assert mine == plain
    assert exact_fold_in_segments(traffic.limit(0), OPTIONS, 60, str(tmp_path / "none")).isEmpty()


def test_metadata_of_any_json(spark):
    lines = ['{"sessionId":"a","httpVersion":"HTTP/2","metadata":{"n":{"deep":[1,2.5,{"x":null}]},"big":12345678901234567890,"t":"ü"}}',
             '{"sessionId":"b","httpVersion":"HTTP/2","metadata":[1,"two"]}', '{"sessionId":"c","httpVersion":"HTTP/2","metadata":null}',
             '{"sessionId":"d","httpVersion":"HTTP/2"}', '{"sessionId":"e","metadata":{', "null"]
    text = spark.createDataFrame([(line,) for line in lines], "value string")
    for _ in range(2):
        good, rejected = codec.split_bad_records(codec.decode_events(text, any_metadata=True))
        assert rejected.count() == (2 if text.columns == ["value"] else 0)
        filled = codec.apply_defaults(good, F.lit(START))
        text = codec.encode_events(filled).select("key", "value")
    found = {r[0]: tuple(r)[1:] for r in filled.select(
        "session_id", F.to_json("metadata"), F.try_variant_get("metadata", "$.n.deep[1]", "double"), F.try_variant_get("metadata", "$[1]", "string")).collect()}
    assert found["a"] == ('{"big":12345678901234567890,"n":{"deep":[1,2.5,{"x":null}]},"t":"ü"}', 2.5, None)
    assert found["b"] == ('[1,"two"]', None, "two") and found["d"] == ("{}", None, None)
    assert found["c"][1:] == (None, None)
