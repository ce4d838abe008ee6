"""One query per operator, each over the whole ``events`` table."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewarden.functions import display, scoring
from tidewarden.functions.draws import copies_per_model
from tidewarden.functions.features import (
    explode_features,
    normalise_weights,
    standard_deviations,
    with_features,
    zscores,
)
from tidewarden.learning.exact import (
    WATCHED_SCHEMA,
    detections_of,
    drift_events_of,
    exact_fold,
    exact_fold_in_segments,
    final_detectors,
    final_state,
    shards_for,
)
from tidewarden.learning.mixing import mix
from tidewarden.operators import detect as detecting
from tidewarden.operators import augment, control, drift, ensemble, metrics, sampling, sessions, statistics, windows
from tidewarden.operators.ordered import instance_number
from tidewarden.operators.report import metrics_snapshot
from tidewarden.schema import FEATURES, RULE_CONFIDENCE, DetectorOptions
from tidewarden.session import ROCKSDB_PROVIDER, scratch_path, shuffle_width, written
from tidewarden.sources import codec, model_store
from tidewarden.sources.streams import read_event_stream
from tidewarden.sources.tables import read_table
from tidewarden.streaming.batches import ExactBatches, ExactRun, exact_batches
from tidewarden.streaming.exact import exact_stream, stream_detectors
from tidewarden.streaming.pipeline import decoded_stream, write_detections

OPTIONS = DetectorOptions(n_models=5, threshold=0.6)
FOLD_OPTIONS = DetectorOptions(n_models=3, threshold=0.6, drift_enabled=False)
#: Detectors that the traffic is dealt to, unless the session sets ``SHARDS_SETTING``.
SHARDS = 8
SHARDS_SETTING = "spark.tidewarden.shards"
#: An exact fold runs a shard in one task, so a shard may not hold many more rows than this.
ROWS_PER_SHARD = 1_000_000
PERIOD = 100
#: How long after an event the metrics in force are asked for.
PROBE_MINUTES = 30
#: Thresholds that a control table sets, at equal spans of time.
CONTROL_THRESHOLDS = (0.9, 0.3)
#: Spans of time of the segmented fold.
SEGMENTS = 5
#: Spans of time after which the labels of a shard turn round, by shard number.
SHIFT_SPANS = (1, 2, 4)
#: Blocks of errors after which a window's histogram is written and handed on.
SEGMENT_BLOCKS = 64
ROLLING = 100
DELTA = OPTIONS.drift_delta
#: Length of a period of behaviour.
PERIOD_SECONDS = 10 * 86_400
SESSION_GAP_SECONDS = 8 * 3600

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(column: Column | str, digits: int = 6) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.round(column, digits)


def settled(column: Column) -> Column:
    """Rounded to the digits that a sum over many rows settles in any order: fewer for large values."""
    size = F.abs(column)
    return F.when(size >= 1e6, F.round(column, 1)).when(size >= 1e3, F.round(column, 3)).otherwise(F.round(column, 6))


def given_sessions(spark: SparkSession, folder: str, shards: int) -> DataFrame:
    """The given events as labelled sessions, dealt to that many detectors."""
    return sessions.session_traffic(read_table(spark, folder, "events"), SESSION_GAP_SECONDS, shards)


def fold_shards(spark: SparkSession, folder: str) -> int:
    """Detectors for exact folds, as the session sets them; a table too large for them is refused.

    Their number never follows the row count by itself: that would deal the events to other
    detectors, and so change every model, as the table grows.
    """
    shards = _shards(spark)
    rows = read_table(spark, folder, "events").count()
    if shards_for(rows, ROWS_PER_SHARD, shards) > shards:
        raise ValueError(
            f"{rows} events are too many for {shards} detectors of {ROWS_PER_SHARD} events: "
            f"set {SHARDS_SETTING} and train anew"
        )
    return shards


def events(spark: SparkSession, folder: str) -> DataFrame:
    """The traffic at any size, over the detectors that the session sets."""
    return given_sessions(spark, folder, _shards(spark))


def fold_events(spark: SparkSession, folder: str) -> DataFrame:
    """The traffic for exact folds, whose shards are limited."""
    return given_sessions(spark, folder, fold_shards(spark, folder))


def stored_events(spark: SparkSession, folder: str) -> DataFrame:
    """The traffic as a table, for queries that pass over it more than once."""
    return written(events(spark, folder), "traffic")


def snapshot(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Events and the models trained on them, as used by the scoring queries."""
    labelled = stored_events(spark, folder)
    return labelled, written(ensemble.snapshot(labelled, OPTIONS), "snapshot")


def detections(spark: SparkSession, folder: str, options=OPTIONS) -> DataFrame:
    labelled, state = snapshot(spark, folder)
    return detecting.detect(labelled, state, options)


def stored_detections(spark: SparkSession, folder: str) -> DataFrame:
    """Detections as a written table, for queries that read them more than once."""
    return written(detections(spark, folder), "detections")


def votes(spark: SparkSession, folder: str) -> DataFrame:
    labelled, state = snapshot(spark, folder)
    return detecting.vote_events(with_features(labelled), state, n_models=OPTIONS.n_models)


def model_votes(spark: SparkSession, folder: str) -> DataFrame:
    """One row per event and model."""
    exploded = detections(spark, folder).select(
        "event_id", "shard", "is_bot", F.posexplode("model_bots").alias("model_id", "bot")
    )
    return exploded


def _rates() -> list[Column]:
    return [rounded(name).alias(name) for name in ("precision", "recall", "f1", "accuracy")]


# Labelled traffic


@query
def g1_labelled_traffic(spark, folder):
    """The sessions of the given events with their label."""
    doubles = {
        "avg_response_time",
        "click_rate",
        "scroll_depth",
        "page_views_per_session",
        "time_between_requests",
    }
    labelled = events(spark, folder).drop("ip_address", "user_agent")
    return labelled.select(
        *[rounded(c).alias(c) if c in doubles else F.col(c) for c in labelled.columns]
    )


@query
def g2_multiplicative_noise(spark, folder):
    """The given sessions with noise on three of their values."""
    noisy = augment.add_noise(events(spark, folder), augment.noise_factor())
    return noisy.select(
        "event_id",
        rounded(augment.noise_factor()).alias("noise"),
        *[rounded(c).alias(c) for c in augment.NOISY],
    )


@query
def g3_drift_phases(spark, folder):
    """How the share of labelled sessions and their size change from period to period."""
    timed = events(spark, folder).withColumn("epoch", augment.period("ts", PERIOD_SECONDS))
    return timed.groupBy("epoch", (F.col("epoch") % augment.PHASES).cast("int").alias("phase")).agg(
        rounded(F.avg(F.col("is_bot").cast("int"))).alias("ratio"),
        F.count(F.lit(1)).alias("events"),
        F.count_if("is_bot").alias("bots"),
        rounded(F.avg(F.when(F.col("is_bot"), F.col("requests_per_second")))).alias("bot_rps"),
    )


@query
def g4_session_features(spark, folder):
    raw = read_table(spark, folder, "events")
    found = sessions.session_features(raw, SESSION_GAP_SECONDS)
    return found.select(
        "user_id",
        "session_start",
        "session_end",
        "events",
        "errors",
        rounded("value_sum", 4).alias("value_sum"),
        rounded("avg_gap_ms", 6).alias("avg_gap_ms"),
        rounded("duration_s", 6).alias("duration_s"),
    )


@query
def g4_session_vectors(spark, folder):
    found = with_features(events(spark, folder))
    return found.select(
        "event_id", "shard", "is_bot", *[rounded(F.col("features")[i]).alias(f"f{i:02d}") for i in range(len(FEATURES))]
    )


@query
def f7_detect_sessions(spark, folder):
    """The exact fold over the sessions of the given events."""
    return _detected(detections_of(exact_fold(fold_events(spark, folder), FOLD_OPTIONS)))


@query
def f3_session_weights(spark, folder):
    """Weights learned from the sessions of the given events."""
    return _weights(final_state(exact_fold(fold_events(spark, folder), FOLD_OPTIONS)))


@query
def f7_session_stream(spark, folder):
    """Sessions cut from a stream of the given events, and detected by the keyed detectors behind them.

    A session is detected once the watermark has passed it, so those still open at the end are not.
    """
    raw = written(read_table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp")), "given")
    raw = raw.withColumn("span", span_of(raw, STREAM_SPANS))
    path = scratch_path(spark, "arrivals")
    for span in range(STREAM_SPANS):
        own = raw.filter(F.col("span") == span).drop("span")
        own.coalesce(STREAM_FILES).write.mode("append").parquet(path)
    stream = spark.readStream.schema(raw.drop("span").schema).option("maxFilesPerTrigger", str(STREAM_FILES)).parquet(path)
    rows = sessions.session_traffic_stream(stream, SESSION_GAP_SECONDS, "0 seconds", _shards(spark))
    out, checkpoint = scratch_path(spark, "streamed"), scratch_path(spark, "checkpoint")
    with _keyed_state(spark):
        _finish(write_detections(exact_stream(rows, FOLD_OPTIONS), out, checkpoint))
    return _detected(spark.read.schema(WATCHED_SCHEMA).parquet(out))


# Decoding and encoding


def wire_records(spark: SparkSession, folder: str, *keep: str) -> DataFrame:
    """JSON text of every event, some of it damaged by the rule of ``event_id % 97``."""
    text = codec.encode_events(events(spark, folder), "event_id", *keep)
    kind = F.col("event_id") % 97
    value = F.col("value")
    damaged = (
        F.when(kind == 0, F.expr("substr(value, 1, 40)"))
        .when(kind == 1, F.lit("null"))
        .when(kind == 2, F.regexp_replace(value, '"errorRate":[0-9]+', '"errorRate":"zz"'))
        .when(kind == 3, F.regexp_replace(value, ',"httpVersion":"[^"]*"', ""))
        .when(kind == 4, F.regexp_replace(value, ',"isBot":(true|false)', ""))
        .when(kind == 5, F.regexp_replace(value, '"timestamp":[0-9]+,', ""))
        .when(kind == 6, F.regexp_replace(value, '"uniqueEndpoints":[0-9]+,', ""))
        .when(kind == 7, F.regexp_replace(value, "^\\{", '{"surplus":[1,2],'))
        .otherwise(value)
    )
    return text.select("event_id", *keep, damaged.alias("value"))


def decoded_records(spark: SparkSession, folder: str) -> DataFrame:
    return codec.decode_events(wire_records(spark, folder))


def _event_columns() -> list[Column]:
    doubles = [f for f in FEATURES if f in ("avg_response_time", "click_rate", "scroll_depth",
                                            "page_views_per_session", "time_between_requests")]
    plain = [f for f in FEATURES if f not in doubles]
    return [
        F.col("event_id"),
        F.col("session_id"),
        F.col("ts"),
        *[F.col(f) for f in plain],
        *[rounded(f).alias(f) for f in doubles],
        F.col("is_bot"),
    ]


@query
def a2_decode_events(spark, folder):
    decoded = decoded_records(spark, folder)
    ok = decoded.filter(F.col(codec.CORRUPT).isNull())
    return (
        ok.select(*_event_columns())
        .drop("ts")
        .withColumns(
            {
                "unique_endpoints": F.coalesce("unique_endpoints", F.lit(-1)),
                "is_bot": F.coalesce(F.col("is_bot").cast("string"), F.lit("missing")),
            }
        )
    )


@query
def a3_apply_defaults(spark, folder):
    decoded = decoded_records(spark, folder).filter(F.col(codec.CORRUPT).isNull())
    at = F.lit("2024-02-01 00:00:00").cast("timestamp")
    filled = codec.apply_defaults(decoded, ingest_time=at)
    return filled.select(*_event_columns(), F.size("metadata").alias("metadata_size"))


@query
def a4_split_bad_records(spark, folder):
    good, rejected = codec.split_bad_records(decoded_records(spark, folder))
    return good.select("event_id", F.lit("good").alias("outcome")).unionByName(
        rejected.select("event_id", F.col("reason").alias("outcome"))
    )


@query
def a5_encode_events(spark, folder):
    encoded = codec.encode_events(events(spark, folder))
    paths = {
        "session_id": "$.sessionId",
        "time": "$.timestamp",
        "ip": "$.ipAddress",
        "agent": "$.userAgent",
        "rps": "$.requestsPerSecond",
        "js": "$.javascriptEnabled",
        "http": "$.httpVersion",
        "bot": "$.isBot",
    }
    return encoded.select(
        "key", *[F.get_json_object("value", path).alias(name) for name, path in paths.items()]
    )


@query
def a9_model_store(spark, folder):
    path = scratch_path(spark, "models")
    _, state = snapshot(spark, folder)
    fresh = ensemble.initial_state(state.select("shard").distinct(), OPTIONS)
    model_store.save_model(fresh, path, 0)
    model_store.save_model(state, path, 1)
    return _state_summary(model_store.load_model(spark, path))


@query
def a9_resume(spark, folder):
    """Detectors learned from the earlier half of the time, saved, loaded and taken on over the later one."""
    rows = written(fold_events(spark, folder), "traffic")
    at = F.unix_micros("ts")
    first, last = rows.agg(F.min(at), F.max(at)).first()
    early = F.coalesce(at < ((first or 0) + (last or 0)) // 2, F.lit(True))
    path = scratch_path(spark, "detectors")
    before = written(exact_fold(rows.filter(early), FOLD_OPTIONS), "folded")
    model_store.save_detectors(final_detectors(before), path, 0)
    start = model_store.load_detectors(spark, path)
    after = exact_fold(rows.filter(~early), FOLD_OPTIONS, start)
    return _detected(detections_of(before).unionByName(detections_of(after)))


#: Spans of time a registered stream reads one after the other, and the files of each.
STREAM_SPANS = 4
STREAM_FILES = 4


def span_of(rows: DataFrame, spans: int) -> Column:
    """The number of the span of time, of equally long ones, that a row of the table is in."""
    at = F.unix_micros("ts")
    first, last = rows.agg(F.min(at), F.max(at)).first()
    return F.floor((at - (first or 0)) * spans / ((last or 0) - (first or 0) + 1)).cast("bigint")


def _arrivals(rows: DataFrame, label: str) -> str:
    """A folder of text files (value), span after span, each shard's records of a span in one file.

    Files are read in the order of their writing, so every shard's records arrive in order for any
    limit on the files of a batch.
    """
    path = scratch_path(rows.sparkSession, label)
    for span in range(STREAM_SPANS):
        own = rows.filter(F.col("span") == span).repartitionById(STREAM_FILES, F.col("shard") % STREAM_FILES)
        own.select("value").write.mode("append").text(path)
    return path


def _wire_id() -> Column:
    return F.col("metadata")["event_id"].cast("bigint")


def _numbered_records(spark: SparkSession, folder: str) -> DataFrame:
    """(shard, span, value): every event as its JSON record, with its number in the metadata."""
    rows = written(fold_events(spark, folder), "traffic")
    rows = rows.withColumn("metadata", F.create_map(F.lit("event_id"), F.col("event_id").cast("string")))
    rows = rows.withColumn("span", span_of(rows, STREAM_SPANS))
    return codec.encode_events(rows, "shard", "span", "ts")


def _shards(spark: SparkSession) -> int:
    return int(spark.conf.get(SHARDS_SETTING, str(SHARDS)))


def _finish(writer) -> None:
    """Run a stream over all that is there, batch by batch, and wait for its end."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception():
        raise query.exception()


#: Partitions of a keyed stream, at most (more where there are many detectors). Every batch opens and commits
#: a state store for each, so a session's partitions, set for the size of its tables, would be paid in every batch.
KEYED_PARTITIONS = 48


@contextmanager
def _keyed_state(spark: SparkSession):
    """The state store that keyed detectors need and its number of partitions, for the streams started inside."""
    width = min(shuffle_width(spark), max(KEYED_PARTITIONS, 4 * _shards(spark)))
    settings = {
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
        "spark.sql.shuffle.partitions": str(width),
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value else spark.conf.unset(name)


@query
def a7_stream_batches(spark, folder):
    """The exact job end to end over a stream of JSON records, several batches long."""
    path = _arrivals(_numbered_records(spark, folder), "arrivals")
    records = read_event_stream(spark, "text", path, maxFilesPerTrigger=str(STREAM_FILES))
    run = ExactRun(spark, scratch_path(spark, "exact-run"))
    handler = ExactBatches(run, FOLD_OPTIONS, _shards(spark), _wire_id)
    _finish(exact_batches(records, handler, f"{run.root}/checkpoint"))
    return _detected(run.detections())


@query
def a4_stream_outcomes(spark, folder):
    """Records of every batch of a stream, some of them damaged: read, good, and rejected by reason."""
    rows = written(wire_records(spark, folder, "shard", "ts"), "wire")
    path = _arrivals(rows.withColumn("span", span_of(rows, STREAM_SPANS)), "arrivals")
    records = read_event_stream(spark, "text", path, maxFilesPerTrigger=str(STREAM_FILES))
    run = ExactRun(spark, scratch_path(spark, "exact-run"))
    _finish(exact_batches(records, ExactBatches(run, FOLD_OPTIONS, _shards(spark)), f"{run.root}/checkpoint"))
    reasons = ("null_event", "unparsable", "missing_http_version")
    by_reason = run.rejected().groupBy("batch").agg(*[F.count_if(F.col("reason") == r).alias(r) for r in reasons])
    counted = run.batches().join(by_reason, "batch", "left")
    return counted.select(
        F.col("batch").cast("bigint").alias("batch"), "records", (F.col("records") - F.col("rejected")).alias("good"),
        *[F.coalesce(F.col(r), F.lit(0)).alias(r) for r in reasons],
    )


def _half_and_half(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, str]:
    """(detections of the earlier half of the time, records of the later one, where its detectors are saved)."""
    rows = _numbered_records(spark, folder)
    early = F.col("span") < STREAM_SPANS // 2
    records = written(rows.withColumn("early", early), "records")
    first, _ = decoded_stream(records.filter("early").select("value"), _shards(spark), _wire_id())
    folded = written(exact_fold(first, FOLD_OPTIONS), "folded")
    path = scratch_path(spark, "detectors")
    model_store.save_detectors(final_detectors(folded), path, 0)
    return detections_of(folded), records.filter("not early"), path


def _exact_stream_over(spark: SparkSession, records: DataFrame, start: DataFrame | None = None) -> tuple[str, str]:
    """(folder of detections, checkpoint) of a keyed stream over the records."""
    path = _arrivals(records, "arrivals")
    stream = read_event_stream(spark, "text", path, maxFilesPerTrigger=str(STREAM_FILES))
    events, _ = decoded_stream(stream, _shards(spark), _wire_id())
    out, checkpoint = scratch_path(spark, "streamed"), scratch_path(spark, "checkpoint")
    with _keyed_state(spark):
        _finish(write_detections(exact_stream(events, FOLD_OPTIONS, start), out, checkpoint))
    return out, checkpoint


@query
def h4_stream_from_saved(spark, folder):
    """A batch fold over the earlier half of the time, and a stream over the later one that starts
    from the detectors the fold saved."""
    before, records, path = _half_and_half(spark, folder)
    out, _ = _exact_stream_over(spark, records, model_store.load_detectors(spark, path))
    after = spark.read.schema(WATCHED_SCHEMA).parquet(out)
    return _detected(before.select(*after.columns).unionByName(after))


@query
def a9_stream_detectors(spark, folder):
    """Weights of the detectors that a stopped stream left in its checkpoint, saved and loaded."""
    _, checkpoint = _exact_stream_over(spark, _numbered_records(spark, folder))
    path = scratch_path(spark, "detectors")
    with _keyed_state(spark):
        model_store.save_detectors(stream_detectors(spark, checkpoint), path, 1)
    state = model_store.models_of(model_store.load_detectors(spark, path))
    return _weights(state)


def _weights(state: DataFrame) -> DataFrame:
    return state.select("shard", "model_id", "n", F.posexplode("weights").alias("i", "w")).select(
        "shard", "model_id", "n", F.col("i").cast("bigint").alias("feature_index"), rounded("w").alias("weight")
    )


def _detected(found: DataFrame) -> DataFrame:
    return found.select(
        "event_id",
        "is_bot_pred",
        "vote",
        rounded("confidence").alias("confidence"),
        "bot_votes",
        "human_votes",
    )


def _state_summary(state: DataFrame) -> DataFrame:
    """A state as plain columns, array values in long form."""
    return state.select(
        "shard",
        "model_id",
        "version",
        "n",
        F.size("rules").cast("bigint").alias("rules"),
        F.posexplode(F.arrays_zip("mean", "m2", "weights")).alias("i", "v"),
    ).select(
        "shard",
        "model_id",
        "version",
        "n",
        "rules",
        F.col("i").cast("bigint").alias("feature_index"),
        settled(F.col("v.mean")).alias("mean"),
        settled(F.sqrt(F.col("v.m2"))).alias("root_m2"),
        rounded(F.col("v.weights")).alias("weight"),
    )


# Projections


@query
def b1_feature_vector(spark, folder):
    vector = with_features(events(spark, folder))
    return vector.select(
        "event_id",
        *[rounded(F.col("features")[i]).alias(f"f{i:02d}") for i in range(len(FEATURES))],
    )


@query
def b2_feature_names(spark, folder):
    long = explode_features(with_features(events(spark, folder)))
    return long.select(
        "event_id",
        F.col("feature_index").cast("bigint").alias("feature_index"),
        "feature_name",
        rounded("value").alias("value"),
    )


def _with_stats(spark: SparkSession, folder: str) -> DataFrame:
    labelled = events(spark, folder)
    stats = statistics.feature_stats(labelled, "shard").drop("n")
    return with_features(labelled).join(stats, "shard")


@query
def b3_zscore(spark, folder):
    z = zscores(F.col("features"), F.col("mean"), F.col("sd"))
    return _with_stats(spark, folder).select(
        "event_id", F.posexplode(z).alias("i", "z")
    ).select("event_id", F.col("i").cast("bigint").alias("feature_index"), rounded("z").alias("z"))


@query
def b4_feature_score(spark, folder):
    z = zscores(F.col("features"), F.col("mean"), F.col("sd"))
    weights = ensemble.given_weights(F.lit(0))
    return _with_stats(spark, folder).select(
        "event_id", rounded(scoring.feature_score(z, weights)).alias("feature_score")
    )


def _with_model_zero(spark: SparkSession, folder: str) -> DataFrame:
    labelled, state = snapshot(spark, folder)
    model = state.filter(F.col("model_id") == 0).drop("model_id", "version")
    return with_features(labelled).join(model, "shard")


def _linear() -> Column:
    sd = standard_deviations(F.col("m2"), F.col("n"))
    return scoring.feature_score(
        zscores(F.col("features"), F.col("mean"), sd), F.col("weights")
    )


@query
def b5_rule_match(spark, folder):
    x = F.col("features")
    closest = F.array_max(
        F.transform("rules", lambda r: scoring.close_features(x, r["thresholds"]))
    )
    matching = F.filter("rules", lambda r: scoring.rule_matches(x, r["thresholds"]))
    return _with_model_zero(spark, folder).select(
        "event_id",
        F.size(matching).cast("bigint").alias("matching_rules"),
        closest.cast("bigint").alias("closest"),
    )


@query
def b6_rule_score(spark, folder):
    score = scoring.rule_score(F.col("features"), F.col("rules"))
    return _with_model_zero(spark, folder).select("event_id", rounded(score).alias("rule_score"))


@query
def b7_blend_score(spark, folder):
    score = scoring.blend(scoring.rule_score(F.col("features"), F.col("rules")), _linear())
    return _with_model_zero(spark, folder).select("event_id", rounded(score).alias("score"))


@query
def b8_neutral_score(spark, folder):
    labelled, state = snapshot(spark, folder)
    trained = F.col("shard") % 2 == 0
    half = state.withColumn("n", F.when(trained, F.col("n")).otherwise(0))
    voted = detecting.vote_events(with_features(labelled), half)
    return voted.select("event_id", rounded(F.col("votes")[0]["score"]).alias("score"))


@query
def b9_predict_one(spark, folder):
    first = F.col("votes")[0]
    return votes(spark, folder).select(
        "event_id",
        first["bot"].alias("bot"),
        rounded(first["confidence"]).alias("confidence"),
    )


@query
def b10_clamp(spark, folder):
    raw = read_table(spark, folder, "events")
    return raw.select(
        "event_id",
        rounded(scoring.clamp(F.col("value") / 100, 0.0, 1.0)).alias("unit"),
        rounded(scoring.clamp(F.col("value") / 100, 0.1, 0.7)).alias("ratio"),
    )


@query
def b11_status_band(spark, folder):
    found = metrics.detection_metrics(detections(spark, folder), "shard")
    return found.select(
        "shard",
        *[
            display.status_band(F.col(kind), kind).alias(f"{kind}_band")
            for kind in ("accuracy", "precision", "recall", "f1")
        ],
        display.status_band(1 - F.col("accuracy"), "error").alias("error_band"),
    )


@query
def b12_format_percent(spark, folder):
    found = metrics.detection_metrics(detections(spark, folder), "shard")
    return found.select(
        "shard",
        *[display.format_percent(F.col(k)).alias(k) for k in ("accuracy", "precision", "recall")],
        rounded(display.bar_width(F.col("f1"))).alias("f1_bar"),
    )


@query
def b13_model_size(spark, folder):
    _, state = snapshot(spark, folder)
    return state.select("shard", "model_id", display.model_size(F.col("rules")).alias("bytes"))


@query
def b14_event_summary(spark, folder):
    labelled, state = snapshot(spark, folder)
    shown = ("session_id", "ip_address", "requests_per_second")
    found = detecting.detect(labelled, state, OPTIONS, keep=shown)
    return found.select("event_id", display.event_summary().alias("summary"))


# Filters


@query
def c1_detection_threshold(spark, folder):
    return detections(spark, folder).select(
        "event_id", "vote", rounded("confidence").alias("confidence"), "is_bot_pred"
    )


@query
def c1_untrained_shards(spark, folder):
    """Every second shard has no models; its events are still detected, as human."""
    labelled, state = snapshot(spark, folder)
    found = detecting.detect(labelled, state.filter(F.col("shard") % 2 == 0), OPTIONS)
    return found.select(
        "event_id",
        "bot_votes",
        "human_votes",
        "vote",
        rounded("confidence").alias("confidence"),
        "is_bot_pred",
    )


@query
def c3_skip_null_event(spark, folder):
    return codec.skip_null_events(decoded_records(spark, folder)).select("event_id")


@query
def c4_labelled_only(spark, folder):
    decoded = decoded_records(spark, folder).filter(F.col(codec.CORRUPT).isNull())
    return codec.labelled_only(decoded).select("event_id", "is_bot")


@query
def c5_rule_gate(spark, folder):
    _, state = snapshot(spark, folder)
    rules = state.select("shard", "model_id", F.explode("rules").alias("r"))
    gate = F.when(F.col("model_id") % 2 == 0, 1e-4).otherwise(0.9)
    return rules.filter(sampling.rule_gate(RULE_CONFIDENCE, gate)).select(
        "shard", "model_id", F.col("r.seq").alias("seq"), F.col("r.outcome").alias("outcome")
    )


# Aggregates


@query
def d1_feature_stats(spark, folder):
    stats = statistics.feature_stats(events(spark, folder), "shard")
    return stats.select(
        "shard", "n", F.posexplode(F.arrays_zip("mean", "sd")).alias("i", "v")
    ).select(
        "shard",
        "n",
        F.col("i").cast("bigint").alias("feature_index"),
        settled(F.col("v.mean")).alias("mean"),
        settled(F.col("v.sd")).alias("sd"),
    )


@query
def d1_merge_feature_stats(spark, folder):
    """Statistics per day merged into statistics per shard."""
    daily = events(spark, folder).withColumn("day", F.date_trunc("day", "ts"))
    parts = statistics.feature_stats(daily, "shard", "day")
    m2 = F.transform("sd", lambda s: s * s * (F.col("n") - 1))
    merged = statistics.merge_feature_stats(parts.withColumn("m2", m2), "shard")
    sd = standard_deviations(F.col("m2"), F.col("n"))
    return merged.select(
        "shard", "n", F.posexplode(F.arrays_zip("mean", sd.alias("sd"))).alias("i", "v")
    ).select(
        "shard",
        "n",
        F.col("i").cast("bigint").alias("feature_index"),
        settled(F.col("v.mean")).alias("mean"),
        settled(F.col("v.sd")).alias("sd"),
    )


@query
def d2_majority_vote(spark, folder):
    return detections(spark, folder).select("event_id", "bot_votes", "human_votes", "vote")


@query
def d3_mean_confidence(spark, folder):
    return votes(spark, folder).select(
        "event_id", rounded(scoring.mean_confidence(F.col("votes"))).alias("confidence")
    )


@query
def d4_weighted_vote(spark, folder):
    """Votes weighted by each model's accuracy on the same events."""
    labelled, state = snapshot(spark, folder)
    first = detecting.detect(labelled, state, OPTIONS)
    seen = metrics.model_accuracy(
        first.select(
            "event_id", "shard", "is_bot", F.posexplode("model_bots").alias("model_id", "bot")
        )
    ).select("shard", "model_id", "seen", "correct")
    weighted = state.drop("seen", "correct").join(seen, ["shard", "model_id"])
    options = OPTIONS.with_(vote="weighted")
    weighted = written(weighted.select(*state.columns), "weighted")
    found = detecting.detect(labelled, weighted, options)
    return found.select(
        "event_id", "vote", rounded("confidence").alias("confidence"), "is_bot_pred"
    )


@query
def d5_all_predictions(spark, folder):
    return detections(spark, folder).select(
        "event_id",
        F.array_join(F.transform("model_bots", lambda b: b.cast("string")), ",").alias("votes"),
    )


@query
def d6_best_model(spark, folder):
    return metrics.best_model(metrics.model_accuracy(model_votes(spark, folder)))


@query
def d7_worst_model(spark, folder):
    return metrics.worst_model(metrics.model_accuracy(model_votes(spark, folder)))


@query
def d8_model_accuracy_summary(spark, folder):
    accuracies = metrics.model_accuracy(model_votes(spark, folder))
    found = metrics.model_accuracy_summary(accuracies, "shard")
    return found.select(
        "shard", *[rounded(c).alias(c) for c in found.columns if c != "shard"]
    )


@query
def d9_confusion_matrix(spark, folder):
    return metrics.confusion_matrix(detections(spark, folder), "shard")


@query
def d10_precision_recall_f1(spark, folder):
    found = metrics.detection_metrics(detections(spark, folder), "shard")
    return found.select("shard", "detections", *_rates()).drop("accuracy")


@query
def d11_accuracy(spark, folder):
    found = metrics.detection_metrics(detections(spark, folder))
    return found.select("detections", rounded("accuracy").alias("accuracy"))


@query
def d12_prequential_accuracy(spark, folder):
    """Test-then-train accuracy of the exact learner, per shard."""
    folded = exact_fold(fold_events(spark, folder), FOLD_OPTIONS)
    found = metrics.ensemble_accuracy(detections_of(folded), "shard")
    return found.withColumn("accuracy", rounded("accuracy"))


@query
def d12_model_accuracy(spark, folder):
    found = metrics.model_accuracy(model_votes(spark, folder))
    return found.select(
        "shard",
        F.col("model_id").cast("bigint").alias("model_id"),
        "seen",
        "correct",
        rounded("accuracy").alias("accuracy"),
    )


@query
def d13_bot_rate(spark, folder):
    found = metrics.bot_rate(detections(spark, folder), "shard")
    return found.withColumns(
        {"bot_rate": rounded("bot_rate"), "bot_percent": rounded("bot_percent")}
    )


@query
def d14_throughput(spark, folder):
    found = metrics.throughput(events(spark, folder), "shard")
    return found.withColumn("events_per_second", rounded("events_per_second", 9))


@query
def d15_bad_record_rate(spark, folder):
    found = metrics.bad_record_rate(decoded_records(spark, folder), codec.is_bad())
    return found.withColumn("error_rate", rounded("error_rate"))


def shifted(found: DataFrame) -> DataFrame:
    """Detections whose labels turn round: never, once, or three times over the time of the table, by shard."""
    at = F.unix_micros("ts")
    first, last = found.agg(F.min(at), F.max(at)).first()
    spans = F.element_at(F.array(*[F.lit(s) for s in SHIFT_SPANS]), F.col("shard") % len(SHIFT_SPANS) + 1)
    span = F.floor((at - (first or 0)) * spans / ((last or 0) - (first or 0) + 1))
    return found.withColumn("is_bot", F.when(span % 2 == 1, ~F.col("is_bot")).otherwise(F.col("is_bot")))


def shifted_detections(spark: SparkSession, folder: str) -> DataFrame:
    return written(shifted(stored_detections(spark, folder)), "shifted")


def _watched(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Detections under turning labels, the same under their adaptive window, and the drift history."""
    found = shifted_detections(spark, folder)
    watched = written(windows.watch(found, DELTA, OPTIONS.warning_level), "watched")
    return found, watched, written(windows.watched_history(watched), "history")


@query
def d16_drift_summary(spark, folder):
    _, watched, history = _watched(spark, folder)
    found = drift.drift_summary(watched, history)
    return found.withColumns(
        {
            "drift_rate": rounded("drift_rate"),
            "current_error_rate": rounded("current_error_rate"),
        }
    )


@query
def d17_ensemble_report(spark, folder):
    _, state = snapshot(spark, folder)
    report = ensemble.ensemble_report(state)
    return report.select("shard", F.explode("models").alias("m")).select(
        "shard", "m.model_id", "m.instances", F.col("m.depth").cast("bigint").alias("depth"), "m.bytes"
    )


@query
def d17_learned_report(spark, folder):
    """The report on models that the exact fold has learned, with their votes that were right."""
    folded = exact_fold(fold_events(spark, folder), FOLD_OPTIONS)
    report = ensemble.ensemble_report(final_state(folded))
    per_model = report.select("shard", rounded("avg_accuracy").alias("avg_accuracy"), F.explode("models").alias("m"))
    return per_model.select(
        "shard", "avg_accuracy", "m.model_id", "m.instances", "m.correct", rounded("m.accuracy").alias("accuracy")
    )


@query
def a11_metrics_snapshot(spark, folder):
    """The snapshot document, read back from its JSON text."""
    found, watched, history = _watched(spark, folder)
    document = metrics_snapshot(found, drift.drift_summary(watched, history))
    schema = (
        "detector struct<detections:bigint,tp:bigint,tn:bigint,fp:bigint,fn:bigint,"
        "accuracy:double,precision:double,recall:double,f1:double,"
        "drift:struct<checks:bigint,warnings:bigint,drifts:bigint,drift_rate:double,"
        "current_error_rate:double,window_length:bigint,in_warning_zone:bigint>>,"
        "processor struct<events:bigint,bots:bigint,bot_percent:double,events_per_second:double>"
    )
    parsed = document.select(F.from_json("document", schema).alias("d"))
    flat = parsed.select("d.detector.*", "d.processor.events", "d.processor.bots",
                         "d.processor.bot_percent", "d.processor.events_per_second")
    return flat.select(
        "detections", "tp", "tn", "fp", "fn", *_rates(),
        F.col("drift.checks").alias("checks"),
        F.col("drift.warnings").alias("warnings"),
        F.col("drift.drifts").alias("drifts"),
        rounded("drift.drift_rate").alias("drift_rate"),
        rounded("drift.current_error_rate").alias("current_error_rate"),
        F.col("drift.window_length").alias("window_length"),
        F.col("drift.in_warning_zone").alias("in_warning_zone"),
        "bots",
        rounded("bot_percent").alias("bot_percent"),
        rounded("events_per_second", 9).alias("events_per_second"),
    )


# Ordered operators


@query
def e1_instance_number(spark, folder):
    narrow = events(spark, folder).select("shard", "ts", "event_id")
    return instance_number(narrow).select("event_id", "shard", "instance_number")


@query
def e2_running_feature_stats(spark, folder):
    found = statistics.running_feature_stats(stored_events(spark, folder))
    pick = (0, 1, 5, 8, 10)
    columns = [f"{kind}_{FEATURES[i]}" for i in pick for kind in ("mean", "sd")]
    # values given to the cent have means half-way between two roundings, so the half is set apart
    return found.select("event_id", "n", *[rounded(F.col(c) + 1e-7, 3).alias(c) for c in columns])


def _numbered(spark: SparkSession, folder: str) -> DataFrame:
    copied = sampling.with_copies(with_features(stored_events(spark, folder)), OPTIONS)
    return sampling.weighted_instance_numbers(copied, OPTIONS)


@query
def e3_weighted_instance_number(spark, folder):
    return _numbered(spark, folder).select(
        "event_id", F.posexplode("trained").alias("model_id", "trained")
    ).select("event_id", F.col("model_id").cast("bigint").alias("model_id"), "trained")


@query
def e4_periodic_metrics(spark, folder):
    found = metrics.periodic_metrics(stored_detections(spark, folder), PERIOD)
    return found.select("shard", "instance_number", "event_id", *metrics.CELLS, *_rates())


@query
def e4_metrics_in_force(spark, folder):
    """The metrics that stand half an hour after each event, from the last multiple of the update frequency."""
    found = stored_detections(spark, folder)
    later = F.col("ts") + F.expr(f"interval {PROBE_MINUTES} minutes")
    probes = found.select("shard", "event_id", later.alias("ts"))
    standing = metrics.metrics_in_force(found, probes, OPTIONS.with_(update_frequency=PERIOD))
    return standing.select("event_id", "instance_number", *metrics.CELLS, *_rates())


@query
def f13_options_in_force(spark, folder):
    """The exact fold under a control table: the threshold changes at a third and at two thirds of the time."""
    rows = written(fold_events(spark, folder), "traffic")
    at = F.unix_micros("ts")
    first, last = rows.agg(F.min(at), F.max(at)).first()
    third = ((last or 0) - (first or 0)) // 3
    changes = [((first or 0) + (k + 1) * third, t) for k, t in enumerate(CONTROL_THRESHOLDS)]
    versions = spark.createDataFrame(changes, "at bigint, threshold double").select(
        F.timestamp_micros("at").alias("valid_from"), "threshold", F.lit(None).cast("boolean").alias("drift_on")
    )
    return _detected(detections_of(exact_fold(control.with_control(rows, versions, FOLD_OPTIONS), FOLD_OPTIONS)))


@query
def f7_detect_in_segments(spark, folder):
    """The exact fold in spans of time, with the detectors written between them."""
    rows = written(fold_events(spark, folder), "traffic")
    at = F.unix_micros("ts")
    first, last = rows.agg(F.min(at), F.max(at)).first()
    seconds = max(1, ((last or 0) - (first or 0)) // (SEGMENTS * 1_000_000))
    folded = exact_fold_in_segments(rows, FOLD_OPTIONS, seconds, scratch_path(spark, "segments"))
    return _detected(detections_of(folded))


@query
def a2_variant_metadata(spark, folder):
    """The given columns of every event as nested metadata: encoded, decoded, encoded and decoded again,
    and read by path."""
    raw = read_table(spark, folder, "events")
    own = raw.select(
        "event_id",
        F.to_variant_object(
            F.struct(
                F.struct("user_id", F.array("event_type", F.col("value").cast("string")).alias("tags")).alias("who"),
                F.col("value").cast("decimal(18,2)").alias("value"),
                F.parse_json(F.coalesce("props", F.lit("null"))).alias("props"),
            )
        ).alias("metadata"),
    )
    each = sessions.session_traffic(raw, 0, _shards(spark))  # without a gap every event is a session
    rows = each.join(own, "event_id")
    text = codec.encode_events(rows, "event_id")
    for _ in range(2):
        decoded = codec.apply_defaults(codec.decode_events(text, any_metadata=True).filter(F.col(codec.CORRUPT).isNull()))
        text = codec.encode_events(decoded, "event_id")
    get = lambda path, kind: F.variant_get("metadata", path, kind)
    return decoded.select(
        "event_id",
        get("$.who.user_id", "bigint").alias("user_id"),
        get("$.who.tags[0]", "string").alias("event_type"),
        rounded(get("$.value", "double"), 4).alias("value"),
        get("$.props.k", "bigint").alias("k"),
        F.schema_of_variant("metadata").contains("props: OBJECT<k: BIGINT>").alias("typed"),
    )


@query
def e5_rule_samples(spark, folder):
    samples = sampling.rule_samples(_numbered(spark, folder), OPTIONS)
    return samples.select(
        "shard", F.col("model_id").cast("bigint").alias("model_id"), "rule_number", "event_id"
    )


@query
def e6_rule_buffer(spark, folder):
    """Newest rules, with a buffer of five so that old ones are dropped."""
    options = OPTIONS.with_(max_rules=5)
    samples = sampling.rule_samples(_numbered(spark, folder), options)
    return sampling.latest_rules(samples, options).select(
        "shard", F.col("model_id").cast("bigint").alias("model_id"), "rule_number", "event_id"
    )


@query
def e7_error_indicator(spark, folder):
    _, watched, _ = _watched(spark, folder)
    return watched.select(
        "event_id", "error", "instance_number", rounded("error_rate").alias("error_rate"), "window_length", "drift"
    )


@query
def e8_warning_zone(spark, folder):
    _, watched, _ = _watched(spark, folder)
    return watched.select("event_id", "in_warning_zone", "warning_entered", "warning_left")


@query
def e8_detection_only(spark, folder):
    """Zones where a drift is noticed but not answered: the window is cut and goes on."""
    found = shifted_detections(spark, folder)
    watched = windows.watch(found, DELTA, OPTIONS.warning_level, reset=False)
    return watched.select(
        "event_id", rounded("error_rate").alias("error_rate"), "window_length", "drift", "in_warning_zone",
        "warning_entered", "warning_left",
    )


@query
def f8_window_histogram(spark, folder):
    """Buckets of every shard's window at the end, folded span by span."""
    errors = written(drift.running_error(shifted_detections(spark, folder)), "errors")
    _, final = windows.windows_in_segments(windows.error_sums(errors), DELTA, segment_blocks=SEGMENT_BLOCKS)
    found = windows.histogram(final)
    return found.select("shard", F.col("level").cast("bigint").alias("level"), F.col("place").cast("bigint").alias("place"), "n", "errors")


@query
def e9_recent_drifts(spark, folder):
    _, _, history = _watched(spark, folder)
    return drift.recent_events(history, 3).select(
        "shard", "instance_number", "type", rounded("error_rate").alias("error_rate")
    )


@query
def e10_retrain_flag(spark, folder):
    _, _, history = _watched(spark, folder)
    return drift.retrain_flags(history)


@query
def e11_time_since_drift(spark, folder):
    found, _, history = _watched(spark, folder)
    return drift.time_since_drift(found, history)


@query
def e12_rolling_metrics(spark, folder):
    found = metrics.rolling_metrics(stored_detections(spark, folder), ROLLING)
    return found.select("event_id", "instance_number", *metrics.CELLS, *_rates())


@query
def e13_metric_evolution(spark, folder):
    found = metrics.metric_evolution(detections(spark, folder), "1 hour", "shard")
    return found.select("shard", "window_start", *metrics.CELLS, *_rates())


@query
def a10_drift_history(spark, folder):
    _, _, history = _watched(spark, folder)
    path = scratch_path(spark, "drift-log")
    half = F.col("shard") % 2
    model_store.append_log(history.filter(half == 0), path, 0)
    model_store.append_log(history.filter(half == 1), path, 1)
    return model_store.read_log(spark, path).select(
        "shard", "instance_number", "type", rounded("error_rate").alias("error_rate")
    )


# Learning and drift


@query
def f1_poisson_copies(spark, folder):
    keyed = events(spark, folder)
    copies = copies_per_model("event_id", OPTIONS.n_models, OPTIONS.seed)
    return keyed.select("event_id", F.posexplode(copies).alias("m", "k")).select(
        "event_id", F.col("m").cast("bigint").alias("model_id"), F.col("k").cast("bigint").alias("copies")
    )


@query
def f2_learn_rule(spark, folder):
    _, state = snapshot(spark, folder)
    rules = state.select("shard", "model_id", F.explode("rules").alias("r"))
    return rules.select(
        "shard",
        "model_id",
        F.col("r.seq").alias("seq"),
        F.col("r.outcome").alias("outcome"),
        *[rounded(F.col("r.thresholds")[i]).alias(f"t{i:02d}") for i in range(len(FEATURES))],
    )


@query
def f3_adjusted_weights(spark, folder):
    """Weights of every model after learning from the whole table, one event at a time."""
    return _weights(final_state(exact_fold(fold_events(spark, folder), FOLD_OPTIONS)))


@query
def f4_normalise_weights(spark, folder):
    """Each event's vector divided by its sum; every 50th event's is all zero."""
    zero = F.col("event_id") % 50 == 0
    vector = with_features(events(spark, folder)).select(
        "event_id",
        F.transform("features", lambda x: F.when(zero, 0.0).otherwise(x)).alias("w"),
    )
    return vector.select(
        "event_id", F.posexplode(normalise_weights(F.col("w"))).alias("i", "w")
    ).select("event_id", F.col("i").cast("bigint").alias("feature_index"), rounded("w").alias("w"))


@query
def f5_train_step(spark, folder):
    """Statistics and rule counts of every model after the exact fold."""
    folded = exact_fold(fold_events(spark, folder), FOLD_OPTIONS)
    return final_state(folded).select(
        "shard",
        "model_id",
        "n",
        F.size("rules").cast("bigint").alias("rules"),
        F.posexplode(F.arrays_zip("mean", "m2")).alias("i", "v"),
    ).select(
        "shard",
        "model_id",
        "n",
        "rules",
        F.col("i").cast("bigint").alias("feature_index"),
        settled(F.col("v.mean")).alias("mean"),
        settled(F.sqrt(F.col("v.m2") / (F.col("n") - 1))).alias("sd"),
    )


@query
def f6_ensemble_prequential(spark, folder):
    """Per model: events seen and votes that were right before training on the event."""
    folded = exact_fold(fold_events(spark, folder), FOLD_OPTIONS)
    return final_state(folded).select("shard", "model_id", "seen", "correct")


@query
def f7_detect(spark, folder):
    return _detected(detections_of(exact_fold(fold_events(spark, folder), FOLD_OPTIONS)))


@query
def f7_detect_with_drift(spark, folder):
    """The whole job: exact learning with the drift test and model replacement."""
    return detections_of(exact_fold(fold_events(spark, folder), DetectorOptions()))


@query
def f8_adaptive_drift(spark, folder):
    options = DetectorOptions(drift_delta=0.3)
    folded = exact_fold(fold_events(spark, folder), options)
    return drift_events_of(detections_of(folded))


@query
def f7_detect_mixing(spark, folder):
    """One global detector learned in parallel slices, batch by batch."""
    return mix(stored_events(spark, folder), DetectorOptions(), rows_per_slice=1_000).detections()


@query
def f9_drift_cut_scan(spark, folder):
    errors = drift.running_error(stored_detections(spark, folder))
    cuts = drift.drift_cut_scan(written(drift.error_blocks(errors), "blocks"), DELTA)
    return cuts.select(
        "shard",
        "block",
        "n0",
        "n1",
        *[rounded(c).alias(c) for c in ("mean0", "mean1", "bound")],
        "cut",
    )


@query
def f10_drift_response(spark, folder):
    """Replacement in the shards whose detections raised an error above the warning level."""
    labelled, state = snapshot(spark, folder)
    found = metrics.detection_metrics(detecting.detect(labelled, state, OPTIONS), "shard")
    drifted = found.filter(1 - F.col("accuracy") > 0.06).select("shard")
    replaced = ensemble.replace_worst(state, drifted, OPTIONS.vote)
    return _state_summary(replaced)


@query
def f11_reset_state(spark, folder):
    _, state = snapshot(spark, folder)
    return _state_summary(
        ensemble.initial_state(state.select("shard").distinct(), OPTIONS, version=2)
    )


@query
def f12_initial_state(spark, folder):
    shards = events(spark, folder).select("shard").distinct()
    return _state_summary(ensemble.initial_state(shards, DetectorOptions()))


def minimum_slice(spark: SparkSession, folder: str) -> DataFrame:
    """Statistics, rules and given weights of one pass, then detection and its metrics."""
    found = metrics.detection_metrics(detections(spark, folder), "shard")
    return found.select("shard", "detections", *metrics.CELLS, *_rates())
