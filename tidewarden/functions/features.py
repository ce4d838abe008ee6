"""The 14-value feature vector and its z-scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewarden.schema import FEATURES, N_FEATURES


def feature_value(name: str) -> Column:
    """One feature as a double; HTTP/2 (case-sensitive) counts as 1.0."""
    if name == "http_version":
        return F.when(F.col(name) == "HTTP/2", 1.0).otherwise(0.0)
    return F.col(name).cast("double")


def feature_vector() -> Column:
    return F.array(*[feature_value(name) for name in FEATURES])


def with_features(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Just what learning and scoring need: ids, order, the vector and the label, beside
    the columns named in ``keep``."""
    return events.select(
        "event_id", "shard", "ts", feature_vector().alias("features"), "is_bot", *keep
    )


def feature_names() -> Column:
    return F.array(*[F.lit(name) for name in FEATURES])


def explode_features(featured: DataFrame) -> DataFrame:
    """Long form: one row per event and feature, with the feature's name."""
    return featured.select(
        "event_id", F.posexplode("features").alias("feature_index", "value")
    ).withColumn("feature_name", F.element_at(feature_names(), F.col("feature_index") + 1))


def zscore(x: Column, mean: Column, sd: Column) -> Column:
    return F.when(sd == 0, F.lit(0.0)).otherwise((x - mean) / sd)


def zscores(x: Column, mean: Column, sd: Column) -> Column:
    """Element-wise z-scores of three arrays of the same length."""
    return F.transform(
        F.arrays_zip(x.alias("x"), mean.alias("m"), sd.alias("s")),
        lambda t: zscore(t["x"], t["m"], t["s"]),
    )


def standard_deviations(m2: Column, n: Column) -> Column:
    """Sample standard deviations from sums of squared deviations; 0 below two rows."""
    return F.transform(
        m2, lambda v: F.when(n > 1, F.sqrt(F.greatest(v, F.lit(0.0)) / (n - 1))).otherwise(0.0)
    )


def uniform_weights() -> Column:
    return F.array_repeat(F.lit(1.0 / N_FEATURES), N_FEATURES)


def normalise_weights(weights: Column) -> Column:
    """Divide by the sum; an all-zero vector stays zero."""
    total = F.aggregate(weights, F.lit(0.0), lambda acc, w: acc + w)
    return F.when(total > 0, F.transform(weights, lambda w: w / total)).otherwise(weights)
