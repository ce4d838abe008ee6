"""Session aggregates from raw user events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewarden.operators.ordered import Running, chunked, running, with_running


from tidewarden.functions.draws import shard_of
from tidewarden.schema import FEATURE_TYPES, FEATURES

#: Event types that are told apart in a session's vector; ``purchase`` makes its label and no feature.
KINDS = ("view", "click", "signup", "error")
LABEL_KIND = "purchase"
#: From this number in ``props`` on, a session counts as one of the newer protocol.
NEWER_FROM = 50


def _counts(kind: str) -> Column:
    return F.coalesce(F.col("event_type") == kind, F.lit(False)).cast("bigint")


def _summed() -> dict[str, Column]:
    """What a session sums over its events. Values are summed as decimals, so any order gives the same."""
    exact = F.coalesce(F.col("value").try_cast("decimal(18,2)"), F.lit(0).cast("decimal(18,2)"))
    return {
        **{kind: _counts(kind) for kind in (*KINDS, LABEL_KIND)},
        "value": F.col("value"),
        "exact_value": exact,
        "with_props": F.col("props").isNotNull().cast("bigint"),
    }


def _highest() -> dict[str, Column]:
    return {"newest_k": F.get_json_object("props", "$.k").try_cast("bigint")}


def _session_columns() -> list[Column]:
    """Start, end, size, mean gap and duration from (start, end, n)."""
    span = F.unix_micros("end") - F.unix_micros("start")
    count = F.col("n")
    return [
        F.col("start").alias("session_start"),
        F.col("end").alias("session_end"),
        count.alias("events"),
        F.when(count > 1, span / (count - 1) / 1000.0).otherwise(0.0).alias("avg_gap_ms"),
        (span / 1e6).alias("duration_s"),
    ]


def _bounds(start: str = "ts", end: str = "ts", n: Column | None = None) -> list[Column]:
    first = F.min("event_id" if start == "ts" else "first_event")
    return [
        F.min(start).alias("start"),
        F.max(end).alias("end"),
        (F.count(F.lit(1)) if n is None else n).alias("n"),
        first.alias("first_event"),
    ]


def sessions_of(
    events: DataFrame, gap_seconds: int, sums: dict[str, Column], highs: dict[str, Column], width: int | None = None
) -> DataFrame:
    """Sessions of each user, split where the gap reaches ``gap_seconds``, with sums and maxima over their events.

    Events move once, by user and time bucket of ``width`` seconds. Inside a bucket they
    are summed to parts of sessions, and only parts are put together over buckets, so even
    one user holding most rows is spread over many tasks.
    """
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))
    keyed = timed.select("user_id", "ts", "event_id", *[c.alias(n) for n, c in {**sums, **highs}.items()])
    key = ("user_id",)
    seen = with_running(
        chunked(keyed, width=width), {"last_ts": Running("max", F.col("ts"), inclusive=False)}, key
    )
    gap = F.unix_micros("ts") - F.unix_micros("last_ts")
    starts = F.col("last_ts").isNull() | (gap >= gap_seconds * 1_000_000)
    bucket = Window.partitionBy(*key, "chunk").orderBy("ts", "event_id")
    part = F.sum(starts.cast("bigint")).over(bucket.rowsBetween(Window.unboundedPreceding, 0))
    totals = [*[F.sum(n).alias(n) for n in sums], *[F.max(n).alias(n) for n in highs]]
    parts = seen.withColumn("part", part).groupBy("user_id", "chunk", "part").agg(*_bounds(), *totals)
    opens = (F.col("part") > 0).cast("bigint")  # part 0 goes on with the session before its bucket
    numbered = running(
        parts.drop("chunk"), {"session": Running("sum", opens)}, key, ("start", "part"), width
    )
    return numbered.groupBy("user_id", "session").agg(*_bounds("start", "end", F.sum("n")), *totals)


def session_features(events: DataFrame, gap_seconds: int, width: int | None = None) -> DataFrame:
    """Size, errors, value, mean gap and duration of every session; see :func:`sessions_of`."""
    found = sessions_of(events, gap_seconds, {"errors": _counts("error"), "value_sum": F.col("value")}, {}, width)
    return found.select("user_id", "session", *_session_columns(), "errors", "value_sum")


def _windowed(events: DataFrame, gap_seconds: int, watermark: str, sums: dict[str, Column], highs: dict[str, Column]) -> DataFrame:
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", watermark)
    named = timed.select("user_id", "ts", "event_id", *[c.alias(n) for n, c in {**sums, **highs}.items()])
    # windows that touch are merged, so one a microsecond shorter splits where the gap is reached
    window = F.session_window("ts", f"{gap_seconds * 1_000_000 - 1} microseconds")
    totals = [*[F.sum(n).alias(n) for n in sums], *[F.max(n).alias(n) for n in highs]]
    return named.groupBy("user_id", window).agg(*_bounds(), *totals)


def session_features_stream(events: DataFrame, gap_seconds: int, watermark: str) -> DataFrame:
    """The same sessions from a stream; a session closes once the watermark passes it."""
    found = _windowed(events, gap_seconds, watermark, {"errors": _counts("error"), "value_sum": F.col("value")}, {})
    return found.select("user_id", *_session_columns(), "errors", "value_sum")


def _as_traffic(found: DataFrame, shards: int) -> DataFrame:
    """Sessions as events for detection.

    The slots of the vector, in its order: events of the session; their mean value; kinds of events
    in it; share of clicks; share of views; its seconds; views; errors; mean milliseconds between
    events; events with properties; whether it has clicks; whether it has a sign-up; zero (no screen
    is given); the newer protocol where ``k`` of the properties reaches :data:`NEWER_FROM`. The label says
    whether it has a purchase. The id is that of its first event, the time that of its last.
    """
    n = F.col("n")
    span = F.unix_micros("end") - F.unix_micros("start")
    kinds = sum(((F.col(kind) > 0).cast("int") for kind in KINDS), F.lit(0))
    slots = {
        "requests_per_second": n,
        "avg_response_time": F.col("exact_value").cast("double") / n,
        "unique_endpoints": kinds,
        "click_rate": F.col("click") / n,
        "scroll_depth": F.col("view") / n,
        "session_duration": F.floor(span / 1_000_000),
        "page_views_per_session": F.col("view"),
        "error_rate": F.col("error"),
        "time_between_requests": F.when(n > 1, span / (n - 1) / 1000.0).otherwise(0.0),
        "distinct_headers": F.col("with_props"),
        "javascript_enabled": F.col("click") > 0,
        "cookies_enabled": F.col("signup") > 0,
        "screen_resolution": F.lit(0),
        "http_version": F.when(F.col("newest_k") >= NEWER_FROM, "HTTP/2").otherwise("HTTP/1.1"),
    }
    return found.select(
        F.col("first_event").alias("event_id"),
        shard_of("first_event", shards).alias("shard"),
        F.col("end").alias("ts"),
        F.concat_ws(":", F.col("user_id").cast("string"), F.col("first_event").cast("string")).alias("session_id"),
        F.lit(None).cast("string").alias("ip_address"),
        F.lit(None).cast("string").alias("user_agent"),
        *[slots[name].cast(FEATURE_TYPES[name]).alias(name) for name in FEATURES],
        (F.col(LABEL_KIND) > 0).alias("is_bot"),
    )


def session_traffic(events: DataFrame, gap_seconds: int, shards: int, width: int | None = None) -> DataFrame:
    """Sessions of (event_id, ts, user_id, event_type, value, props) as labelled events; see :func:`_as_traffic`."""
    return _as_traffic(sessions_of(events, gap_seconds, _summed(), _highest(), width), shards)


def session_traffic_stream(events: DataFrame, gap_seconds: int, watermark: str, shards: int) -> DataFrame:
    """The same from a stream, in append mode: a session is sent on once the watermark passes its end
    by the gap, so sessions leave in the order of their ends and a keyed detector can follow."""
    found = _windowed(events, gap_seconds, watermark, _summed(), _highest())
    return _as_traffic(found, shards)
