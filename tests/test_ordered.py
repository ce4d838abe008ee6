"""Chunked running values equal plain windows, whatever the chunks and the skew."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewarden.operators.drift import cut_bound, drift_cut_scan, recent_events
from tidewarden.operators.ordered import Running, instance_number, rolling_sums, running
from tidewarden.operators.sessions import session_features


@pytest.fixture(scope="module")
def skewed(spark):
    """3,000 rows; one key has most of them, and many rows share a timestamp."""
    i = F.col("event_id")
    return spark.range(3000).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 5 < 3, 0).otherwise(F.col("id") % 4).cast("int").alias("shard"),
        F.timestamp_seconds(1_700_000_000 + F.floor(F.col("id") / 700) * 60).alias("ts"),
        (F.hash("id") % 100).cast("bigint").alias("v"),
    )


@pytest.mark.parametrize("width", [60, 150, 86_400])
def test_running_equals_window(skewed, width):
    mine = running(
        skewed,
        {
            "total": Running("sum", F.col("v")),
            "highest": Running("max", F.col("v")),
            "lowest_before": Running("min", F.col("v"), inclusive=False),
        },
        width=width,
    )
    frame = Window.partitionBy("shard").orderBy("ts", "event_id")
    so_far = frame.rowsBetween(Window.unboundedPreceding, 0)
    theirs = skewed.withColumns(
        {
            "total": F.sum("v").over(so_far),
            "highest": F.max("v").over(so_far),
            "lowest_before": F.min("v").over(frame.rowsBetween(Window.unboundedPreceding, -1)),
        }
    ).select(*mine.columns)
    assert mine.count() == 3000
    assert mine.exceptAll(theirs).isEmpty()


def test_chunks_split_the_hot_key(skewed):
    from tidewarden.operators.ordered import chunked

    largest = chunked(skewed, width=60).groupBy("shard", "chunk").count().agg(F.max("count")).first()[0]
    assert largest < 600  # the hot key alone has about 1,900 rows


def test_rows_without_key_or_time_are_kept(spark):
    rows = [(None, None, 1, 5), (None, 60, 2, 7), (1, None, 3, 1), (1, 7200, 4, 2), (1, 7200, 5, 4), (2, 10, 6, None)]
    events = spark.createDataFrame(rows, "shard int, s long, event_id long, v long").select(
        "shard", F.timestamp_seconds("s").alias("ts"), "event_id", "v"
    )
    found = running(events, {"total": Running("sum", F.col("v")), "high": Running("max", F.col("v"), inclusive=False)})
    got = {r["event_id"]: (r["total"], r["high"]) for r in found.collect()}
    assert got == {1: (5, None), 2: (12, 5), 3: (1, None), 4: (3, 1), 5: (7, 2), 6: (0, None)}
    assert running(events.limit(0), {"total": Running("sum", F.col("v"))}).isEmpty()


def test_one_exchange_of_all_rows(skewed):
    numbered = instance_number(skewed, width=60)
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
    assert plan.count("Exchange hashpartitioning(shard#") == 3  # chunk totals twice, rows and carries once
    assert "SortMergeJoin" not in plan


@pytest.mark.parametrize("block_rows", [10, 64, 5000])
def test_rolling_equals_window(skewed, block_rows):
    numbered = instance_number(skewed, width=60)
    mine = rolling_sums(numbered, {"s": F.col("v")}, 10, block_rows=block_rows)
    frame = Window.partitionBy("shard").orderBy("ts", "event_id").rowsBetween(-9, 0)
    theirs = skewed.withColumn("s", F.sum("v").over(frame)).select("event_id", "s")
    assert mine.count() == 3000
    assert mine.select("event_id", "s").exceptAll(theirs).isEmpty()


@pytest.mark.parametrize("width", [600, 7200, 10**7])
def test_sessions_of_one_hot_user(spark, width):
    events = spark.range(2000).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 3 < 2, 1).otherwise(F.col("id") % 7).alias("user_id"),
        F.timestamp_seconds(F.col("id") * 50 + F.floor(F.col("id") / 97) * 4000).alias("ts"),
        F.lit("click").alias("event_type"),
        F.lit(1.0).alias("value"),
    )
    mine = session_features(events, 3600, width=width)
    theirs = events.groupBy("user_id", F.session_window("ts", "3600 seconds").alias("w")).agg(
        F.count(F.lit(1)).alias("events"), F.min("ts").alias("session_start")
    )
    columns = ("user_id", "session_start", "events")
    assert mine.count() == theirs.count()
    assert mine.select(*columns).exceptAll(theirs.select(*columns)).isEmpty()


def test_cut_scan_against_brute_force(spark):
    import math

    counts = [(b, 32, 2 if b < 20 else 16) for b in range(40)]
    blocks = spark.createDataFrame(counts, "block long, n long, errors long").select(
        F.lit(0).alias("shard"), "*", F.lit(1).cast("bigint").alias("instance_number"),
        F.current_timestamp().alias("ts"),
    )
    found = {r["block"]: r for r in drift_cut_scan(blocks, 0.002, width=7).collect()}
    assert len(found) == 39
    n, s = 40 * 32, sum(c[2] for c in counts)
    for cut_after in range(39):
        n0 = 32 * (cut_after + 1)
        s0 = sum(c[2] for c in counts[: cut_after + 1])
        log = math.log(2 * math.log(n) / 0.002)
        inverse = 1 / n0 + 1 / (n - n0)
        bound = math.sqrt(2 * inverse * (s / n) * (1 - s / n) * log) + 2 / 3 * inverse * log
        row = found[cut_after]
        assert row["bound"] == pytest.approx(bound)
        assert row["cut"] == (abs(s0 / n0 - (s - s0) / (n - n0)) > bound)
    assert found[19]["cut"]


def test_constant_errors_have_no_cut(spark):
    blocks = spark.range(60).select(
        F.lit(0).alias("shard"), F.col("id").alias("block"), F.lit(32).cast("bigint").alias("n"),
        F.lit(2).cast("bigint").alias("errors"), F.lit(1).cast("bigint").alias("instance_number"),
        F.current_timestamp().alias("ts"),
    )
    assert drift_cut_scan(blocks, 0.002).filter("cut").isEmpty()


def test_recent_events_limits_before_the_shuffle(spark):
    history = spark.range(1000).select(
        (F.col("id") % 2).cast("int").alias("shard"), F.col("id").alias("instance_number"),
        F.lit("WARNING").alias("type"),
    )
    recent = recent_events(history, 3)
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Partial") > plan.index("Exchange")  # below the shuffle in the tree
    assert sorted(r["instance_number"] for r in recent.collect()) == list(range(994, 1000))


def test_cut_bound_is_symmetric(spark):
    row = spark.range(1).select(
        cut_bound(F.lit(10), F.lit(90), F.lit(0.2), 0.01).alias("a"),
        cut_bound(F.lit(90), F.lit(10), F.lit(0.2), 0.01).alias("b"),
    ).first()
    assert row["a"] == pytest.approx(row["b"])
