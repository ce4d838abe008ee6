"""Reproducible random draws derived from a key column.

A draw depends only on the key and its salt, so a retried or re-partitioned task
draws the same value, and any engine with md5 can repeat it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cumulative Poisson(1) probabilities of 0, 1, ... 11; above them 12.
# A 32-bit draw tells no later ones apart.
POISSON_CUTS = (
    0.36787944117144233,
    0.7357588823428847,
    0.9196986029286058,
    0.9810118431238462,
    0.9963401531726563,
    0.9994058151824183,
    0.9999167588507119,
    0.9999897508033252,
    0.9999988747974019,
    0.9999998885745215,
    0.9999999899522335,
    0.9999999991683891,
)


def uniform(key: Column | str, salt: str | Column) -> Column:
    """A draw in [0, 1) from the first 32 bits of md5("key:salt")."""
    key = F.col(key) if isinstance(key, str) else key
    salt = F.lit(f":{salt}") if isinstance(salt, str) else F.concat(F.lit(":"), salt)
    digest = F.md5(F.concat(key.cast("string"), salt))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def uniforms(key: Column | str, count: int) -> Column:
    """An array of draws with salts 0, 1, ... ``count - 1``.

    One lambda instead of ``count`` copies of the expression: the generated code stays
    below the size from which the JVM no longer compiles it.
    """
    salts = F.sequence(F.lit(0), F.lit(count - 1))
    return F.transform(salts, lambda i: uniform(key, i.cast("string")))


def poisson(u: Column) -> Column:
    """Number of cut points not above a uniform draw: the inverse distribution."""
    copies = F.lit(0)
    for cut in POISSON_CUTS:
        copies = copies + (u >= cut).cast("int")
    return copies


def copies_per_model(key: Column | str, n_models: int, seed: int) -> Column:
    """How often models 0, 1, ... train on an event: Poisson(1) draws per (event, model).

    The draws are made first and mapped second: inside one lambda each comparison with a
    cut point would hash again.
    """
    models = F.sequence(F.lit(0), F.lit(n_models - 1))
    salt = lambda m: F.concat(m.cast("string"), F.lit(f":{seed}"))
    return F.transform(F.transform(models, lambda m: uniform(key, salt(m))), poisson)


def shard_of(key: Column | str, shards: int) -> Column:
    """An even split of unique keys over ``shards`` detectors, whatever else is skewed."""
    return F.floor(uniform(key, "shard") * shards).cast("int")
