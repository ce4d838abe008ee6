"""A training-data pipeline over ``documents``: language, near duplicates, benchmark, personal data, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewarden.llm import decontaminate, jaccard, language, packing, pii
from tidewarden.llm.common import table
from tidewarden.session import scratch_path

#: Near duplicates are judged on five words and a similarity of 0.8.
NEAR = jaccard.JaccardOptions(shingle=5, at_least=80, of=100)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that have a language; what gets ``und`` goes."""
    return language.keep_identified(docs, language.learn(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near duplicates. Rows of one
    id are one document; rows with a null id or without words stay."""
    found = jaccard.similar_documents(docs, NEAR)
    gone = found.where(F.col("component_id") != F.col("doc_id")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of a benchmark item."""
    return decontaminate.drop_leaked(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind; ``n_chars`` is counted anew."""
    clean = pii.redact(docs, pii.train(docs))
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of the training sequences."""
    pieces = packing.cut(docs).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    packed = packing.pack(pieces)
    return packed.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("benchmark", drop_benchmark),
    ("personal_data", redact_personal_data),
    ("packing", pack_sequences),
]

#: The language mixture, the trained spans and the packing plan have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
