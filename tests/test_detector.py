"""The documented behaviour of a detector, on the derived traffic."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from derived_traffic import TrafficOptions, labelled_traffic
from tidewarden.functions import display, scoring
from tidewarden.functions.features import normalise_weights, with_features, zscore
from tidewarden.learning import kernel
from tidewarden.learning.exact import (
    detections_of,
    drift_events_of,
    exact_fold,
    final_state,
    shards_for,
)
from tidewarden.learning.mixing import batch_number, batch_starts, mix
from tidewarden.operators import detect as detecting
from tidewarden.operators import augment, ensemble, metrics, sampling
from tidewarden.operators.statistics import feature_stats, merge_feature_stats
from tidewarden.plans import queries
from tidewarden.schema import DetectorOptions
from tidewarden.sources.model_store import load_model, save_model, versions

OPTIONS = DetectorOptions(n_models=5, threshold=0.6, update_frequency=100)
STEADY = TrafficOptions(shards=1, phase_seconds=None)


def bots_found(events, options=OPTIONS):
    return detections_of(exact_fold(events, options)).filter("is_bot_pred").count()


def test_initial_state(spark):
    state = ensemble.initial_state(ensemble.shard_list(spark, 3), DetectorOptions())
    rows = state.collect()
    assert len(rows) == 30 and all(r["n"] == 0 and not r["rules"] for r in rows)
    assert rows[0]["weights"] == pytest.approx([1 / 14] * 14)


def test_threshold_is_clamped():
    assert DetectorOptions(threshold=1.5).threshold == 1.0
    assert DetectorOptions(threshold=-0.5).threshold == 0.0
    assert DetectorOptions(threshold=0.9).with_(seed=1).threshold == 0.9
    with pytest.raises(ValueError):
        DetectorOptions(vote="other")


def test_detects_bots_and_keeps_every_event(keyed):
    events = labelled_traffic(keyed.filter("event_id < 100"), STEADY)
    found = detections_of(exact_fold(events, OPTIONS))
    assert found.count() == 100 and found.filter("is_bot_pred").count() > 0


def test_learning_does_not_get_worse(keyed):
    found = detections_of(exact_fold(labelled_traffic(keyed, STEADY), OPTIONS)).cache()
    early = metrics.detection_metrics(found.filter("event_id < 500")).first()
    whole = metrics.detection_metrics(found).first()
    assert whole["accuracy"] >= 0.9 * early["accuracy"]
    for name in ("precision", "recall", "f1", "accuracy"):
        assert 0 <= whole[name] <= 1
    p, r = whole["precision"], whole["recall"]
    assert whole["f1"] == pytest.approx(2 * p * r / (p + r))


def test_accuracy_band_of_the_default_detector(keyed):
    found = detections_of(
        exact_fold(labelled_traffic(keyed, STEADY), DetectorOptions(drift_enabled=False))
    )
    row = metrics.detection_metrics(found).first()
    assert row["accuracy"] > 0.9 and row["precision"] > 0.95 and row["recall"] > 0.65


def test_more_bots_are_found_where_there_are_more(keyed):
    few = labelled_traffic(keyed.filter("event_id < 300"), TrafficOptions(0.1, shards=1))
    many = labelled_traffic(keyed.filter("event_id < 300"), TrafficOptions(0.5, shards=1))
    assert bots_found(many) >= bots_found(few)


def test_no_events(keyed):
    folded = exact_fold(labelled_traffic(keyed.limit(0), STEADY), OPTIONS)
    assert folded.count() == 0
    row = metrics.detection_metrics(detections_of(folded)).first()
    assert row["detections"] == 0 and row["precision"] == row["recall"] == row["accuracy"] == 0.0


def test_partitioning_does_not_change_the_result(keyed):
    events = labelled_traffic(keyed, TrafficOptions(shards=3))
    first = detections_of(exact_fold(events, OPTIONS))
    second = detections_of(exact_fold(events.repartition(13, "ip_address"), OPTIONS))
    assert first.exceptAll(second).isEmpty() and first.count() == 1000


def test_fold_sorts_and_shuffles_once(traffic):
    plan = exact_fold(traffic, OPTIONS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1


def test_forced_drift_is_found(keyed):
    events = labelled_traffic(keyed, STEADY)
    late = F.col("event_id") >= 600
    flipped = events.withColumn(
        "is_bot", F.when(late, ~F.col("is_bot")).otherwise(F.col("is_bot"))
    )
    kinds = {r["type"] for r in drift_events_of(detections_of(exact_fold(flipped, OPTIONS))).collect()}
    assert kinds == {"WARNING", "DRIFT"}
    off = OPTIONS.with_(drift_enabled=False)
    assert drift_events_of(detections_of(exact_fold(flipped, off))).isEmpty()


@pytest.mark.parametrize("vote", ["majority", "weighted"])
def test_native_and_arrow_scoring_agree(traffic, vote):
    options = OPTIONS.with_(vote=vote, grace_period=20)
    state = final_state(exact_fold(traffic, options)).cache()
    native = detecting.detect(traffic, state, options, "native")
    arrow = detecting.detect(traffic, state, options, "arrow")
    assert arrow.count() == 1000
    assert native.drop("confidence").exceptAll(arrow.drop("confidence")).isEmpty()
    joined = native.select("event_id", F.col("confidence").alias("a")).join(
        arrow.select("event_id", F.col("confidence").alias("b")), "event_id"
    )
    assert joined.agg(F.max(F.abs(F.col("a") - F.col("b")))).first()[0] < 1e-9


def test_large_state_is_joined_not_broadcast(traffic, monkeypatch):
    state = final_state(exact_fold(traffic, OPTIONS)).cache()
    expected = detecting.detect(traffic, state, OPTIONS).drop("confidence").cache()
    expected.count()
    monkeypatch.setattr(detecting, "BROADCAST_BYTES", 10)
    with pytest.raises(ValueError):
        detecting.detect(traffic, state, OPTIONS, "arrow")
    joined = detecting.detect(traffic, state, OPTIONS).drop("confidence")
    assert joined.exceptAll(expected).isEmpty() and joined.count() == 1000


def test_save_load_and_reset(spark, traffic, tmp_path):
    path = str(tmp_path / "models")
    state = final_state(exact_fold(traffic, OPTIONS)).cache()
    save_model(ensemble.initial_state(ensemble.shard_list(spark, 4), OPTIONS), path, 0)
    save_model(state, path, 3)
    assert versions(spark, path) == [0, 3]
    loaded = load_model(spark, path)
    assert loaded.drop("version").exceptAll(state.drop("version")).isEmpty()
    assert loaded.agg(F.max("seen")).first()[0] == state.agg(F.max("seen")).first()[0] > 0
    assert load_model(spark, path, 0).agg(F.max("seen")).first()[0] == 0
    with pytest.raises(FileNotFoundError):
        load_model(spark, str(tmp_path / "none"))


def test_replace_worst(traffic):
    state = final_state(exact_fold(traffic, OPTIONS)).cache()
    drifted = state.filter("shard = 2").select("shard").distinct()
    fresh = ensemble.replace_worst(state, drifted).filter("n = 0").collect()
    assert [(r["shard"], r["model_id"]) for r in fresh] == [(2, 0)]
    worst = metrics.worst_model(ensemble.accuracies(state)).filter("shard = 2").first()["model_id"]
    fresh = ensemble.replace_worst(state, drifted, "weighted").filter("n = 0").collect()
    assert [(r["shard"], r["model_id"]) for r in fresh] == [(2, worst)]


def test_mixing_is_close_to_exact(keyed, tmp_path):
    spark = keyed.sparkSession
    options = DetectorOptions(n_models=5, drift_enabled=False)
    events = labelled_traffic(keyed, TrafficOptions(shards=1))
    exact = metrics.detection_metrics(detections_of(exact_fold(events, options))).first()
    run = mix(events, options, root=str(tmp_path / "run"), rows_per_slice=80, slices_per_batch=4)
    mixed = metrics.detection_metrics(run.detections()).first()
    assert mixed["detections"] == 1000
    assert abs(mixed["recall"] - exact["recall"]) < 0.05
    # Statistics, counts and rules do not depend on the slices at all.
    options = options.with_(grace_period=20, max_rules=10)
    run = mix(events, options, root=str(tmp_path / "many-rules"), rows_per_slice=80, slices_per_batch=4)
    columns = ("model_id", "n", "seen", F.col("rules"))
    single = final_state(exact_fold(events, options))
    assert all(len(row["rules"]) == 10 for row in single.collect())
    assert run.state().select(*columns).exceptAll(single.select(*columns)).isEmpty()
    mean = F.expr("transform(mean, v -> round(v, 6))")
    assert run.state().select("model_id", mean).exceptAll(single.select("model_id", mean)).isEmpty()
    # A finished run is resumed without doing anything again.
    before = versions(spark, run.models_path)
    assert versions(spark, mix(events, options, root=run.root).models_path) == before


def test_mixing_is_repeatable(keyed, tmp_path):
    spark = keyed.sparkSession
    options = DetectorOptions(n_models=3)
    events = labelled_traffic(keyed, TrafficOptions(shards=1))
    runs = []
    for k, rows in enumerate((events, events.repartition(7), events.repartition(3, "event_id"))):
        run = mix(rows, options, root=str(tmp_path / str(k)), rows_per_slice=90, slices_per_batch=2)
        runs.append(sorted(run.detections().select("event_id", "confidence", "is_bot_pred").collect()))
    assert len(runs[0]) == 1000 and runs[0] == runs[1] == runs[2]
    chunks = spark.range(40).select("id", batch_number(F.col("id"), 8).alias("b"), batch_number(F.col("id"), 3).alias("c")).collect()
    for row in chunks:
        assert row["b"] == sum(s <= row["id"] for s in batch_starts(40, 8)) - 1
        assert row["c"] == sum(s <= row["id"] for s in batch_starts(40, 3)) - 1


def test_mixing_costs_few_jobs_a_batch(keyed, tmp_path):
    spark = keyed.sparkSession
    events = labelled_traffic(keyed, TrafficOptions(shards=1))
    jobs = {}
    for limit in (300, 900):
        spark.sparkContext.setJobGroup(f"mix{limit}", "mixing")
        some = events.filter(F.col("event_id") < limit)
        run = mix(some, DetectorOptions(n_models=2), root=str(tmp_path / str(limit)), rows_per_slice=30, slices_per_batch=1)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert run.detections().count() == some.count() and run.control().count() == some.count() // 30
        jobs[limit] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"mix{limit}"))
    assert jobs[900] - jobs[300] < 5 * 20  # every stage that adaptive execution starts is a job


def test_a_batch_of_mixing_is_one_job(keyed, tmp_path):
    spark = keyed.sparkSession
    events = labelled_traffic(keyed, TrafficOptions(shards=1)).filter("event_id < 630")
    jobs = {}
    for size in (30, 210):  # 21 batches of one slice, or 3
        spark.sparkContext.setJobGroup(f"size{size}", "mixing")
        run = mix(events, DetectorOptions(n_models=2), root=str(tmp_path / str(size)), rows_per_slice=size, slices_per_batch=1)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert run.detections().count() == 630 and run.control().count() == 630 // size
        jobs[size] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"size{size}"))
    assert jobs[30] - jobs[210] <= 18 + 2  # listing files may cost a job


def test_mixing_does_not_depend_on_how_rows_arrive(keyed, tmp_path):
    spark = keyed.sparkSession
    events = labelled_traffic(keyed, TrafficOptions(shards=1))
    found, setting = [], "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(setting)
    try:
        for rows in (usual, "7"):
            spark.conf.set(setting, rows)
            run = mix(events, DetectorOptions(n_models=3), root=str(tmp_path / rows), rows_per_slice=90, slices_per_batch=4)
            found.append([sorted(map(str, table.collect())) for table in (run.detections(), run.control(), run.state())])
    finally:
        spark.conf.set(setting, usual)
    assert len(found[0][0]) == 1000 and found[0] == found[1]


def _hard_block(rows, seed, n_models=6):
    """Events whose label the features tell little of, so that models err often; some values repeat, some are not numbers."""
    draw = np.random.default_rng(seed)
    x = np.column_stack([draw.integers(0, 4, (rows, 7)), draw.normal(1, 2, (rows, 7))]).astype(float)
    x[draw.random(x.shape) < 0.01] = np.nan if seed == 2 else 0.0
    copies = draw.poisson(1, (rows, n_models))
    copies[:, -1] = 0
    return x, draw.random(rows) < 0.4, copies


def test_models_walk_together_as_alone(monkeypatch):
    options, walked = DetectorOptions(grace_period=40, max_rules=12), []
    together = kernel._walked_together
    monkeypatch.setattr(kernel, "_walked_together", lambda *args: walked.append(1) or together(*args))
    models = alone = [kernel.Model() for _ in range(6)]
    for seed in range(4):
        x, is_bot, copies = _hard_block(400, seed)
        found = kernel.train_blocks(models, x, is_bot, copies, options)
        single = [kernel.train_block(m, x, is_bot, copies[:, i], options) for i, m in enumerate(alone)]
        for (scores, model), (own_scores, own) in zip(found, single):
            assert np.array_equal(scores, own_scores, equal_nan=True)
            assert all(np.array_equal(getattr(model, k), getattr(own, k), equal_nan=k != "rule_bot") for k in vars(own))
        models, alone = [model for _, model in found], [model for _, model in single]
    assert len(walked) == 4
    kernel.train_blocks(models, np.zeros((0, 14)), np.zeros(0, bool), np.zeros((0, 6), int), options)


def test_rule_hits_equal_pair_by_pair():
    x, _, _ = _hard_block(600, 2)
    rules = _hard_block(600, 3)[0][::7]
    expected = (np.abs(x[:, None] - rules[None]) < 0.1).sum(axis=2) >= 7
    assert expected.any() and np.array_equal(kernel.rule_hits(x, rules), expected)
    assert kernel.rule_hits(x, rules[:0]).shape == (600, 0) and kernel.rule_hits(x[:0], rules).shape == (0, len(rules))


def test_blocks_are_whole_and_in_order():
    import pandas as pd
    from tidewarden.learning.mixing import BLOCK_ROWS, _blocks

    sizes = {(0, 0): 3, (0, 1): 2 * BLOCK_ROWS, (1, 0): BLOCK_ROWS + 1, (1, 2): 5}
    rows = pd.DataFrame([(*key, i) for key, size in sizes.items() for i in range(size)], columns=["batch", "chunk", "i"])
    for step in (1000, 4999, len(rows)):
        frames = [rows.iloc[at : at + step] for at in range(0, len(rows), step)]
        found = [(key, block["i"].tolist()) for key, block in _blocks([rows.iloc[:0], *frames], ["batch", "chunk"])]
        assert [key for key, _ in found] == [(0, 0), (0, 1), (0, 1), (1, 0), (1, 0), (1, 2)]
        assert [len(i) for _, i in found] == [3, BLOCK_ROWS, BLOCK_ROWS, BLOCK_ROWS, 1, 5]
        for key, size in sizes.items():
            assert sum((i for k, i in found if k == key), []) == list(range(size))


def test_mixing_goes_on_after_its_last_write(keyed, tmp_path, monkeypatch):
    from tidewarden.learning import mixing

    events = labelled_traffic(keyed, TrafficOptions(shards=1)).filter("event_id < 400")
    options, sizes = DetectorOptions(n_models=2), {"rows_per_slice": 40, "slices_per_batch": 2}
    whole = mix(events, options, root=str(tmp_path / "whole"), **sizes)
    monkeypatch.setattr(mixing, "BATCHES_PER_WRITE", 2)
    done, kept = [], mixing.mix_batches

    def stopped(*args):
        if len(done) == 1:
            raise RuntimeError("stopped")
        done.append(kept(*args))

    monkeypatch.setattr(mixing, "mix_batches", stopped)
    with pytest.raises(RuntimeError, match="stopped"):
        mix(events, options, root=str(tmp_path / "parts"), **sizes)
    monkeypatch.setattr(mixing, "mix_batches", kept)
    parts = mix(events, options, root=str(tmp_path / "parts"), **sizes)
    for read in (mixing.MixRun.detections, mixing.MixRun.control, mixing.MixRun.state):
        assert sorted(map(str, read(parts).collect())) == sorted(map(str, read(whole).collect()))


def test_batch_starts():
    assert batch_starts(20, 8) == [0, 1, 2, 4, 8, 16]
    assert batch_starts(1, 8) == [0]


def test_merged_statistics_equal_whole(traffic):
    parts = feature_stats(traffic, "shard", "phase")
    m2 = F.transform("sd", lambda s: s * s * (F.col("n") - 1))
    merged = {r["shard"]: r for r in merge_feature_stats(parts.withColumn("m2", m2), "shard").collect()}
    for row in feature_stats(traffic, "shard").collect():
        mine = merged[row["shard"]]
        assert mine["n"] == row["n"] and mine["mean"] == pytest.approx(row["mean"])
        sd = [(v / (row["n"] - 1)) ** 0.5 for v in mine["m2"]]
        assert sd == pytest.approx(row["sd"])


def test_rule_samples_with_a_small_grace_period(traffic):
    options = OPTIONS.with_(grace_period=3, n_models=2, max_rules=4)
    copied = sampling.with_copies(with_features(traffic), options)
    numbered = sampling.weighted_instance_numbers(copied, options, width=3600)
    samples = sampling.rule_samples(numbered, options)
    totals = numbered.groupBy("shard").agg(
        *[F.sum(F.col("copies")[m]).alias(f"t{m}") for m in range(2)]
    )
    for row in totals.collect():
        for m in range(2):
            numbers = samples.filter((F.col("shard") == row["shard"]) & (F.col("model_id") == m))
            found = sorted(r["rule_number"] for r in numbers.select("rule_number").collect())
            assert found == list(range((row[f"t{m}"] - 1) // 3 + 1))
    kept = sampling.rule_lists(sampling.latest_rules(samples, options), options)
    assert all(len(r["rules"]) == 4 for r in kept.collect())


def test_rule_distance_and_threshold_are_strict(spark):
    ones = F.array(*[F.lit(1.0)] * 14)
    at = lambda close, gap: F.array(*[F.lit(1.0)] * close, *[F.lit(1.0 + gap)] * (14 - close))
    row = spark.range(1).select(
        scoring.rule_matches(ones, at(7, 5.0)).alias("seven"),
        scoring.rule_matches(ones, at(6, 5.0)).alias("six"),
        scoring.close_features(F.array(*[F.lit(0.1)] * 14), F.array(*[F.lit(0.0)] * 14)).alias("edge"),
        scoring.says_bot(F.lit(0.7)).alias("at"),
        scoring.majority(F.lit(2), F.lit(2)).alias("tie"),
        zscore(F.lit(3.0), F.lit(1.0), F.lit(0.0)).alias("flat"),
    ).first()
    assert row.asDict() == {
        "seven": True, "six": False, "edge": 0, "at": False, "tie": False, "flat": 0.0
    }


def test_zero_weights_stay_zero(spark):
    row = spark.range(1).select(normalise_weights(F.array(F.lit(0.0), F.lit(0.0))).alias("w")).first()
    assert row["w"] == [0.0, 0.0]


def test_display(spark):
    row = spark.range(1).select(
        display.format_percent(F.lit(0.12345)).alias("p"),
        display.format_percent(F.lit(None).cast("double")).alias("none"),
        display.status_band(F.lit(0.9), "accuracy").alias("good"),
        display.status_band(F.lit(0.65), "recall").alias("warning"),
        display.status_band(F.lit(0.11), "error").alias("danger"),
        display.status_band(F.lit(0.1), "other").alias("other"),
        display.bar_width(F.lit(1.5)).alias("width"),
    ).first()
    assert list(row) == ["12.35%", "0%", "good", "warning", "danger", "", 100.0]


def test_shards_grow_with_the_data():
    assert shards_for(10, 1000) == 8 and shards_for(1_000_000, 1000) == 1000


def test_noise_keeps_rates_and_nulls(spark):
    rows = spark.createDataFrame([(i, 100.0, 1.0, None) for i in range(500)], "event_id long, avg_response_time double, click_rate double, scroll_depth double")
    found = augment.add_noise(rows, augment.noise_factor()).collect()
    assert all(90 <= r["avg_response_time"] < 110 and 0.9 <= r["click_rate"] <= 1 and r["scroll_depth"] is None for r in found)
    assert len({r["avg_response_time"] for r in found}) > 400


def test_periods_count_from_the_epoch(spark):
    rows = spark.sql("select * from values (timestamp '1969-12-31 23:59:59'), (timestamp '1970-01-01 00:00:09'), (timestamp '1970-01-01 00:00:10'), (null) t(ts)")
    assert [r[0] for r in rows.select(augment.period("ts", 10)).collect()] == [-1, 0, 1, None]


@pytest.mark.parametrize("engine", ["native", "arrow"])
def test_shards_without_models_are_scored_neutral(spark, traffic, engine):
    state = ensemble.snapshot(traffic, OPTIONS)
    found = detecting.detect(traffic, state.filter("shard < 2"), OPTIONS, engine, keep=("session_id",))
    rows = found.select("shard", "vote", "is_bot_pred", "confidence", "bot_votes", "human_votes", "model_bots").collect()
    assert len(rows) == traffic.count()
    untrained = [r for r in rows if r["shard"] >= 2]
    expected = (False, False, 0.0, 0, OPTIONS.n_models, [False] * OPTIONS.n_models)
    assert untrained and all(tuple(r)[1:] == expected for r in untrained)
    assert any(r["vote"] for r in rows if r["shard"] < 2)
    assert found.join(traffic, ["event_id", "session_id"]).count() == len(rows)


def test_too_few_detectors_for_a_table_are_refused(spark, monkeypatch):
    monkeypatch.setattr(queries, "ROWS_PER_SHARD", 100)
    with pytest.raises(ValueError, match=queries.SHARDS_SETTING):
        queries.fold_shards(spark, "/root/testdata/sf0.001")
    spark.conf.set(queries.SHARDS_SETTING, "10")
    try:
        assert queries.fold_shards(spark, "/root/testdata/sf0.001") == 10
    finally:
        spark.conf.unset(queries.SHARDS_SETTING)


def test_only_exact_folds_are_limited_by_rows_of_a_shard(spark, monkeypatch):
    monkeypatch.setattr(queries, "ROWS_PER_SHARD", 100)
    assert queries.QUERIES["d1_feature_stats"](spark, "/root/testdata/sf0.001").count() > 0
    with pytest.raises(ValueError, match=queries.SHARDS_SETTING):
        queries.QUERIES["f7_detect_with_drift"](spark, "/root/testdata/sf0.001")
