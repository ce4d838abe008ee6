"""JSON records to event columns and back, with bad records kept apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewarden.schema import FEATURE_TYPES, WIRE_SCHEMA, WIRE_TO_COLUMN

CORRUPT = "_corrupt"
_CASED = {"columnNameOfCorruptRecord": CORRUPT}


def _decode_schema(any_metadata: bool) -> T.StructType:
    wire = [
        T.StructField(f.name, T.VariantType()) if any_metadata and f.name == "metadata" else f
        for f in WIRE_SCHEMA.fields
    ]
    return T.StructType([*wire, T.StructField(CORRUPT, T.StringType())])


def decode_events(records: DataFrame, value: str = "value", any_metadata: bool = False) -> DataFrame:
    """Parse the JSON text; unknown fields are ignored, other columns are kept.

    Text that does not parse, or a field of the wrong type, is left in ``_corrupt``. ``metadata`` is
    a map of texts, or with ``any_metadata`` a variant: any JSON, with its numbers and nesting,
    read by path (``variant_get``) and encoded again as it was.
    """
    kept = [c for c in records.columns if c != value]
    event = F.from_json(F.col(value), _decode_schema(any_metadata), _CASED)
    # Inlined from an array of one, so that the text is parsed once per row: plain field
    # accesses would each be rewritten into a parse of their own.
    parsed = records.select(*kept, value, F.inline(F.array(event)))
    fields = [F.col(wire).alias(name) for wire, name in WIRE_TO_COLUMN.items()]
    is_null = F.coalesce(F.trim(value), F.lit("null")) == "null"
    corrupt = F.when(is_null, "null").otherwise(F.col(CORRUPT))
    return parsed.select(*kept, *fields, corrupt.alias(CORRUPT))


def apply_defaults(decoded: DataFrame, ingest_time: Column | None = None) -> DataFrame:
    """Missing numbers are 0, flags and label false, the map empty, the time now.

    ``ts`` turns from epoch milliseconds into a timestamp. ``http_version`` has no
    default: an event without one cannot be scored.
    """
    ingest_time = F.current_timestamp() if ingest_time is None else ingest_time
    defaults = {
        "ts": F.coalesce(F.timestamp_millis("ts"), ingest_time),
        "is_bot": F.coalesce("is_bot", F.lit(False)),
        "confidence": F.coalesce("confidence", F.lit(0.0)),
    }
    if isinstance(decoded.schema["metadata"].dataType, T.VariantType):
        defaults["metadata"] = F.coalesce("metadata", F.parse_json(F.lit("{}")))
    else:
        defaults["metadata"] = F.coalesce("metadata", F.create_map().cast("map<string,string>"))
    for name, kind in FEATURE_TYPES.items():
        if name != "http_version":
            defaults[name] = F.coalesce(F.col(name), F.lit(0).cast(kind))
    return decoded.withColumns(defaults)


def is_bad() -> Column:
    """Records the detector skips: unparsable, JSON null, or without an HTTP version."""
    return F.col(CORRUPT).isNotNull() | F.col("http_version").isNull()


def bad_reason() -> Column:
    text = F.trim(CORRUPT)
    return (
        F.when(text == "null", "null_event")
        .when(F.col(CORRUPT).isNotNull(), "unparsable")
        .when(F.col("http_version").isNull(), "missing_http_version")
    )


def split_bad_records(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good events, rejected records with a reason)."""
    good = decoded.filter(~is_bad()).drop(CORRUPT)
    rejected = decoded.filter(is_bad()).withColumn("reason", bad_reason())
    return good, rejected


def skip_null_events(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.coalesce(F.trim(CORRUPT) != "null", F.lit(True)))


def labelled_only(events: DataFrame) -> DataFrame:
    return events.filter(F.col("is_bot").isNotNull())


def encode_events(events: DataFrame, *keep: str) -> DataFrame:
    """Key (the session id) and JSON text per event, after the columns to keep."""
    fields = []
    for wire, name in WIRE_TO_COLUMN.items():
        if name not in events.columns:
            continue
        column = F.unix_millis(name) if wire == "timestamp" else F.col(name)
        fields.append(column.alias(wire))
    return events.select(
        *keep, F.col("session_id").alias("key"), F.to_json(F.struct(*fields)).alias("value")
    )
