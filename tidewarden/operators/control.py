"""Options changed while a job runs: a versioned table, each event under the version valid at its time.

A control table (valid_from timestamp, threshold double, drift_on boolean) is written by people, so it
is small; more than :data:`MAX_VERSIONS` rows are refused. A null in a version leaves that option as
the versions before left it, and before the first version the job's own options hold. Versions
of the same time are taken in the order of their values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewarden.schema import DetectorOptions

MAX_VERSIONS = 10_000
CONTROL_SCHEMA = "valid_from timestamp, threshold double, drift_on boolean"
#: Columns that say, event by event, what an exact fold obeys instead of its options.
CONTROL_COLUMNS = ("threshold", "drift_on")


def _versions(control: DataFrame, options: DetectorOptions) -> list[tuple[int, float, bool]]:
    """(microseconds, threshold, drift on) of every version, nulls filled in."""
    micros = F.unix_micros("valid_from").alias("at")
    rows = control.filter("valid_from is not null").select(micros, *CONTROL_COLUMNS).orderBy("at", *CONTROL_COLUMNS)
    rows = rows.limit(MAX_VERSIONS + 1).collect()
    if len(rows) > MAX_VERSIONS:
        raise ValueError(f"a control table holds {MAX_VERSIONS} versions at most")
    threshold, drift_on, found = options.threshold, options.drift_enabled, []
    for row in rows:
        threshold = threshold if row["threshold"] is None else max(0.0, min(1.0, row["threshold"]))
        drift_on = drift_on if row["drift_on"] is None else row["drift_on"]
        found.append((row["at"], threshold, drift_on))
    return found


def with_control(events: DataFrame, control: DataFrame, options: DetectorOptions) -> DataFrame:
    """Events with ``threshold`` and ``drift_on`` as valid at their ``ts``; no shuffle, no join.

    Events without a time are under the job's own options. Scoring takes the columns by
    :func:`decided`, an exact fold (batch or stream) finds them by itself.
    """
    versions = _versions(control, options)
    own = F.struct(F.lit(options.threshold).alias("threshold"), F.lit(options.drift_enabled).alias("drift_on"))
    if versions:
        entry = lambda i, at, t, d: F.struct(F.lit(at).cast("bigint").alias("at"), F.lit(i).alias("nth"), F.lit(t).alias("threshold"), F.lit(d).alias("drift_on"))
        known = F.array(*[entry(i, *v) for i, v in enumerate(versions)])
        valid = F.array_max(F.filter(known, lambda v: v["at"] <= F.unix_micros("ts")))
        own = F.when(valid.isNull(), own).otherwise(F.struct(valid["threshold"].alias("threshold"), valid["drift_on"].alias("drift_on")))
    return events.withColumn("_own", own).withColumns({c: F.col("_own")[c] for c in CONTROL_COLUMNS}).drop("_own")


def decided(threshold: Column | str = "threshold") -> Column:
    """The thresholded detection of a scored event under its own threshold."""
    return F.col("vote") & (F.col("confidence") >= (F.col(threshold) if isinstance(threshold, str) else threshold))
