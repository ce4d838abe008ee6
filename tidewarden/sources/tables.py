"""Readers for parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Use all cores on a table with fewer splits than cores.

    A large table has more splits than cores and is returned as it is, unshuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
