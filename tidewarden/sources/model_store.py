"""Versioned ``model_state`` tables and append-only logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewarden.schema import MODEL_STATE_SCHEMA

STATE_COLUMNS = MODEL_STATE_SCHEMA.fieldNames()


def save_model(state: DataFrame, path: str, version: int) -> None:
    """Write one version. A version is a folder of its own, so writing it again after
    a failure replaces it and other versions stay."""
    state.drop("version").write.mode("overwrite").parquet(f"{path}/version={version}")


def _files(spark: SparkSession, path: str):
    """The file system of a path and the path itself, as Hadoop objects."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def is_written(spark: SparkSession, path: str) -> bool:
    """True if a table's write has completed."""
    files, marker = _files(spark, f"{path}/_SUCCESS")
    return files.exists(marker)


def numbered_folders(spark: SparkSession, path: str, name: str) -> list[int]:
    """Numbers n of the folders ``name=n`` under a path, from one listing."""
    files, root = _files(spark, path)
    if not files.exists(root):
        return []
    names = [status.getPath().getName() for status in files.listStatus(root)]
    return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{name}="))


def versions(spark: SparkSession, path: str) -> list[int]:
    """Versions whose write has completed, oldest first."""
    found = numbered_folders(spark, path, "version")
    return [v for v in found if is_written(spark, f"{path}/version={v}")]


def newest_version(spark: SparkSession, path: str, below: int | None = None) -> int | None:
    """The newest version whose write has completed (older than ``below``, if given), looked for from
    the newest down, so that a long history costs one listing."""
    for version in reversed(numbered_folders(spark, path, "version")):
        if (below is None or version < below) and is_written(spark, f"{path}/version={version}"):
            return version
    return None


def _newest(spark: SparkSession, path: str) -> int:
    found = newest_version(spark, path)
    if found is None:
        raise FileNotFoundError(f"no model version in {path}")
    return found


def save_detectors(detectors: DataFrame, path: str, version: int) -> None:
    """Write one version of whole detectors (shard, detector), as an exact fold ends with them."""
    detectors.select("shard", "detector").write.mode("overwrite").parquet(f"{path}/version={version}")


def load_detectors(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version of whole detectors, the newest by default."""
    version = _newest(spark, path) if version is None else version
    return spark.read.parquet(f"{path}/version={version}").select("shard", "detector")


def models_of(detectors: DataFrame, version: int = 0) -> DataFrame:
    """The models inside whole detectors, as a ``model_state`` table."""
    kept = F.from_json("detector", T.StructType([T.StructField("models", T.ArrayType(MODEL_STATE_SCHEMA))]))
    models = detectors.select("shard", F.inline(kept["models"]).alias(*[f"_{c}" for c in STATE_COLUMNS]))
    named = models.select("shard", *[F.col(f"_{c}").alias(c) for c in STATE_COLUMNS if c != "shard"])
    return named.withColumn("version", F.lit(version).cast("bigint")).select(*STATE_COLUMNS)


def load_model(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version of the state, the newest by default; only its folder is read."""
    version = _newest(spark, path) if version is None else version
    stored = spark.read.parquet(f"{path}/version={version}")
    return stored.withColumn("version", F.lit(version).cast("bigint")).select(*STATE_COLUMNS)


def append_log(rows: DataFrame, path: str, batch: int) -> None:
    """Append a batch to a log; the same batch written twice is kept once."""
    rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path)
