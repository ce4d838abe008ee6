"""Poisson training copies and the rules sampled from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewarden.functions.draws import copies_per_model
from tidewarden.operators.ordered import Running, running
from tidewarden.schema import RULE_CONFIDENCE, DetectorOptions


def with_copies(events: DataFrame, options: DetectorOptions) -> DataFrame:
    """Add ``copies``: per model, how often it trains on the event."""
    return events.withColumn(
        "copies", copies_per_model("event_id", options.n_models, options.seed)
    )


def weighted_instance_numbers(
    copied: DataFrame, options: DetectorOptions, **running_options
) -> DataFrame:
    """Add ``trained``: per model, copies trained up to and including each event.

    All models ride in one window, so the stream is shuffled once, not once per model.
    """
    names = [f"_trained_{m}" for m in range(options.n_models)]
    values = {
        name: Running("sum", F.col("copies")[m].cast("bigint")) for m, name in enumerate(names)
    }
    summed = running(copied, values, **running_options)
    return summed.withColumn("trained", F.array(*names)).drop(*names)


def rule_gate(confidence: Column | float, split_confidence: Column | float) -> Column:
    """A new rule is kept only if its confidence exceeds the split confidence."""
    confidence = F.lit(confidence) if isinstance(confidence, float) else confidence
    return confidence > split_confidence


def rule_samples(numbered: DataFrame, options: DetectorOptions) -> DataFrame:
    """Events that become rules: one per trained copy whose 0-based index divides evenly
    by the grace period. Input from :func:`weighted_instance_numbers`."""
    grace = options.grace_period
    per_model = F.posexplode(F.arrays_zip("copies", "trained")).alias("model_id", "c")
    exploded = numbered.select("shard", "ts", "event_id", "features", "is_bot", per_model)
    first = F.col("c.trained") - F.col("c.copies")
    due = F.floor((first + grace - 1) / grace).cast("bigint")
    last = F.floor((F.col("c.trained") - 1) / grace).cast("bigint")
    hits = exploded.filter((F.col("c.copies") > 0) & (due <= last))
    return hits.select(
        "shard",
        "model_id",
        F.explode(F.sequence(due, last)).alias("rule_number"),
        "ts",
        "event_id",
        "features",
        "is_bot",
    ).filter(rule_gate(RULE_CONFIDENCE, options.split_confidence))


def latest_rules(samples: DataFrame, options: DetectorOptions) -> DataFrame:
    """The newest ``max_rules`` rules of each model.

    Rule numbers run without gaps, so the cut is a filter on the highest number: no sort
    and no per-group list of all rules.
    """
    newest = samples.groupBy("shard", "model_id").agg(F.max("rule_number").alias("newest"))
    return (
        samples.join(newest, ["shard", "model_id"])
        .filter(F.col("rule_number") > F.col("newest") - options.max_rules)
        .drop("newest")
    )


def rule_lists(latest: DataFrame, options: DetectorOptions) -> DataFrame:
    """Rules as one ordered array per (shard, model), at most ``max_rules`` long."""
    rule = F.struct(
        (F.col("rule_number") * options.grace_period).alias("seq"),
        F.col("features").alias("thresholds"),
        F.col("is_bot").alias("outcome"),
    )
    return latest.groupBy("shard", "model_id").agg(
        F.array_sort(
            F.collect_list(rule), lambda a, b: (a["seq"] - b["seq"]).cast("int")
        ).alias("rules")
    )
