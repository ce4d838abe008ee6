"""What the operators' queries share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def remainder_of(text: Column, of: int) -> Column:
    return F.crc32(text.cast("binary")) % of


def remainder(of: int, id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``of``; null for a null id."""
    return remainder_of(F.col(id_col).cast("string"), of)
