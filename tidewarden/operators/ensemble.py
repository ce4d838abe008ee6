"""The ``model_state`` table: fresh models, reset, replacement, snapshots, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewarden.functions.display import model_size
from tidewarden.functions.features import feature_vector, uniform_weights
from tidewarden.operators.metrics import ratio, worst_model
from tidewarden.operators.sampling import (
    latest_rules,
    rule_lists,
    rule_samples,
    weighted_instance_numbers,
    with_copies,
)
from tidewarden.operators.statistics import weighted_feature_moments
from tidewarden.schema import MODEL_STATE_SCHEMA, N_FEATURES, RULE_TYPE, DetectorOptions
from tidewarden.session import written

STATE_COLUMNS = MODEL_STATE_SCHEMA.fieldNames()


def _fresh_columns() -> dict[str, Column]:
    zeros = F.array_repeat(F.lit(0.0), N_FEATURES)
    return {
        "n": F.lit(0).cast("bigint"),
        "mean": zeros,
        "m2": zeros,
        "weights": uniform_weights(),
        "rules": F.array().cast(T.ArrayType(RULE_TYPE)),
        "correct": F.lit(0).cast("bigint"),
        "seen": F.lit(0).cast("bigint"),
    }


def fresh_models(n_models: int, names: list[str]) -> Column:
    """An array of fresh models with the fields ``names``, for shards without a state."""
    columns = _fresh_columns()
    model = lambda m: F.struct(*[m.alias(c) if c == "model_id" else columns[c].alias(c) for c in names])
    return F.transform(F.sequence(F.lit(0), F.lit(n_models - 1)), model)


def initial_state(shards: DataFrame, options: DetectorOptions, version: int = 0) -> DataFrame:
    """Fresh models for every row of ``shards``: the first version, and also a reset.

    Options such as the threshold live outside the state, so a reset keeps them.
    """
    models = F.explode(F.sequence(F.lit(0), F.lit(options.n_models - 1)))
    return (
        shards.select("shard", models.alias("model_id"))
        .withColumns({"version": F.lit(version).cast("bigint"), **_fresh_columns()})
        .select(*STATE_COLUMNS)
    )


def shard_list(spark: SparkSession, shards: int) -> DataFrame:
    return spark.range(shards).select(F.col("id").cast("int").alias("shard"))


def accuracies(state: DataFrame, vote: str = "weighted") -> DataFrame:
    """Accuracy per model; under the plain majority no accuracy is kept and all are 0."""
    kept = ratio(F.col("correct"), F.col("seen")) if vote == "weighted" else F.lit(0.0)
    return state.select("shard", "model_id", kept.alias("accuracy"))


def replace_worst(state: DataFrame, drifted: DataFrame, vote: str = "majority") -> DataFrame:
    """A fresh model in place of the worst one, in the shards listed in ``drifted``.

    Under the plain majority all accuracies tie, so the worst is the first model.
    """
    replaced = worst_model(accuracies(state, vote)).join(drifted.select("shard"), "shard", "left_semi")
    kept = state.join(replaced, ["shard", "model_id"], "left_anti")
    version = F.col("version")
    fresh = (
        state.join(replaced, ["shard", "model_id"], "left_semi")
        .select("shard", "model_id", version.alias("version"))
        .withColumns(_fresh_columns())
    )
    return kept.unionByName(fresh).select(*STATE_COLUMNS)


def given_weights(model_id: Column) -> Column:
    """Hand-set weights on the request rate and the page views, differing per model."""
    first = F.lit(0.4) + model_id * 0.05
    by_feature = {0: first, 6: F.lit(1.0) - first}
    return F.array(*[by_feature.get(i, F.lit(0.0)) for i in range(N_FEATURES)])


def snapshot(events: DataFrame, options: DetectorOptions, weights=given_weights) -> DataFrame:
    """Statistics and rules each model holds after training once over ``events``.

    Weights depend on the order of mistakes and are given instead; everything else of a
    model's state is order-free or a running count, so no sequential fold is needed.
    """
    copied = with_copies(events, options).withColumn("features", feature_vector())
    narrow = copied.select("shard", "ts", "event_id", "features", "is_bot", "copies")
    numbered = weighted_instance_numbers(narrow, options)
    samples = written(rule_samples(numbered, options), "rules")  # one in grace_period rows
    rules = rule_lists(latest_rules(samples, options), options)
    stats = weighted_feature_moments(copied)
    empty = F.array().cast(T.ArrayType(RULE_TYPE))
    return (
        stats.join(rules, ["shard", "model_id"], "left")
        .withColumns(
            {
                "version": F.lit(1).cast("bigint"),
                "weights": weights(F.col("model_id")),
                "rules": F.coalesce(F.col("rules"), empty),
                "correct": F.lit(0).cast("bigint"),
                "seen": F.lit(0).cast("bigint"),
            }
        )
        .select(*STATE_COLUMNS)
    )


def ensemble_report(state: DataFrame) -> DataFrame:
    """One row per shard: totals and a list of per-model statistics (one per model)."""
    accuracy = ratio(F.col("correct"), F.col("seen"))
    model = F.struct(
        "model_id",
        F.col("n").alias("instances"),
        "correct",
        accuracy.alias("accuracy"),
        F.size("rules").alias("depth"),
        model_size(F.col("rules")).alias("bytes"),
    )
    return state.groupBy("shard").agg(
        F.max("seen").alias("instances"),
        F.avg(accuracy).alias("avg_accuracy"),
        F.array_sort(F.collect_list(model)).alias("models"),
    )
