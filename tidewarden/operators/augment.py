"""Labelled traffic varied by noise and counted by period."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewarden.functions.draws import uniform
from tidewarden.functions.scoring import clamp

#: The values that noise is put on; the latter two are rates and stay in [0, 1].
NOISY = ("avg_response_time", "click_rate", "scroll_depth")
#: Behaviour comes back after so many periods.
PHASES = 3


def noise_factor(key: str = "event_id") -> Column:
    """A repeatable factor within 10 % to both sides for each key."""
    return (uniform(key, "15") - 0.5) * 0.2


def add_noise(events: DataFrame, noise: Column) -> DataFrame:
    """One factor within ±10 % on three columns; the two rates stay in [0, 1]. A null value stays null."""
    first, *rates = NOISY
    varied = {first: F.col(first) * (1 + noise)}
    kept = {name: F.when(F.col(name).isNotNull(), clamp(F.col(name) * (1 + noise), 0.0, 1.0)) for name in rates}
    return events.withColumns(varied | kept)


def period(ts: str, seconds: int) -> Column:
    """Number of the period of so many seconds, from the epoch on, that a time falls in; null for no time."""
    return F.floor(F.unix_micros(ts) / (seconds * 1_000_000)).cast("bigint")
