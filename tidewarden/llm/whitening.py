"""Whitening of vectors by the distributed block matrices of Spark's MLlib."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewarden.session import scratch_path, ship_package, written

#: Entries whose whole number would not be exact as a double count as not finite.
LARGEST = float(2**53) / 1024


@dataclass(frozen=True)
class WhiteningOptions:
    """``components`` to project on; ``scale`` and ``shift`` make the whole number of an entry;
    a block holds ``block_bytes`` of centred doubles, or less, so that every core has one."""

    components: int = 8
    scale: int = 1024
    shift: int = 100_000
    block_bytes: int = 16 << 20


def whole_vectors(vectors: DataFrame, options: WhiteningOptions) -> DataFrame:
    """(vec_id, x array<bigint>) of the vectors without null, non-finite or too large entries."""
    entry = F.col("embedding").cast("array<double>")
    bad = F.exists("e", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= LARGEST))
    rows = vectors.select("vec_id", entry.alias("e")).where(F.col("e").isNotNull()).where(~bad)
    return rows.select("vec_id", F.transform("e", lambda c: F.floor(c * options.scale) + F.lit(options.shift)).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)


def _column_sums(x: np.ndarray) -> list[int]:
    high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
    return [(int(h) << 32) + int(v) for h, v in zip(high, low)]


def dimension_sums(rows: DataFrame) -> list[int]:
    """Exact sum of every dimension; a task sends one row for each."""

    def partial(batches):
        total: list[int] | None = None
        for batch in batches:
            if len(batch):
                own = _column_sums(_matrix(batch.column(0)))
                total = own if total is None else [a + b for a, b in zip(total, own)]
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total)), pa.int32()), pa.array([str(t) for t in total], pa.string())], ["i", "part"]
            )

    parts = rows.select("x").mapInArrow(partial, "i int, part string")
    sums = parts.groupBy("i").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total"))
    return [int(r["total"]) for r in sums.orderBy("i").collect()]


def centred_rows(rows: DataFrame, n: int, sums: list[int]) -> DataFrame:
    """(vec_id, deviation, task, at, centred): each vector less the mean, the exact squared distance
    of ``n`` times the vector from the sums, and its place among the rows of its task."""
    names = ["vec_id", "deviation", "task", "at", "centred"]
    vec_id = rows.schema["vec_id"].dataType.simpleString()

    def centre(batches):
        at, task = 0, TaskContext.get().partitionId()
        total = np.array(sums, object)
        small = max(abs(s) for s in sums) < 1 << 61
        for batch in batches:
            if not len(batch):
                continue
            x = _matrix(batch.column(1))
            if small and n * int(np.abs(x).max(initial=0)) < 1 << 61:
                moved = n * x - total.astype(np.int64)
            else:
                moved = n * x.astype(object) - total
            if int(np.abs(moved).max(initial=0)) ** 2 * x.shape[1] < 1 << 62:
                far = (moved.astype(np.int64) ** 2).sum(axis=1).tolist()
            else:
                far = (moved.astype(object) ** 2).sum(axis=1).tolist()
            far = [f if f < 1 << 63 else None for f in far]
            flat = pa.array((moved / n).astype(float).ravel())
            ends = pa.array(np.arange(len(batch) + 1, dtype=np.int32) * x.shape[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(far, pa.int64()), pa.array([task] * len(batch), pa.int32()),
                 pa.array(range(at, at + len(batch)), pa.int64()), pa.ListArray.from_arrays(ends, flat)], names,
            )
            at += len(batch)

    return rows.select("vec_id", "x").mapInArrow(centre, f"vec_id {vec_id}, deviation bigint, task int, at bigint, centred array<double>")


def indexed(rows: DataFrame) -> DataFrame:
    """Rows with a gapless ``index``: the rows of the tasks before, and the place in the own one.

    There is one total for each task that wrote them; that table is broadcast.
    """
    counts = rows.groupBy("task").agg((F.max("at") + 1).alias("held"))
    before = F.sum("held").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("task", F.coalesce(before, F.lit(0)).alias("before"))
    return rows.join(F.broadcast(offsets), "task").withColumn("index", F.col("before") + F.col("at")).drop("task", "at", "before")


def _times(left: BlockMatrix, right: BlockMatrix, parts: int) -> BlockMatrix:
    """The product, with the shared dimension cut into ``parts`` that are multiplied apart and added."""
    found = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, parts)
    return BlockMatrix(found, left.rowsPerBlock, right.colsPerBlock)


def rows_per_block(n: int, dimensions: int, cores: int, options: WhiteningOptions) -> int:
    """As many rows as ``block_bytes`` hold, or fewer where that leaves cores without a block."""
    return max(1, min(options.block_bytes // (8 * dimensions), max(256, -(-n // cores))))


def principal(scatter: np.ndarray, n: int, components: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(eigenvalues, share of the trace, whitening columns) of a covariance, by falling eigenvalue.

    Directions without variance (nothing beyond rounding) are left out.
    """
    covariance = (scatter + scatter.T) / (2 * n)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    real = min(components, int((values > max(values[0], 0) * len(values) * np.finfo(float).eps).sum()))
    values, vectors = values[:real], vectors[:, :real]
    return values, values / np.trace(covariance), vectors / np.sqrt(values)


def identity_error(projected: DataFrame, components: int) -> float:
    """Largest absolute entry of the covariance of the projections less the identity."""
    w = [F.col("w")[i] for i in range(components)]
    means = projected.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(w)]).first()
    pairs = [(i, j) for i in range(components) for j in range(i + 1)]
    products = projected.agg(*[F.avg((w[i] - means[i]) * (w[j] - means[j])).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(products[k] - (i == j)) for k, (i, j) in enumerate(pairs))


def whiten(vectors: DataFrame, options: WhiteningOptions = WhiteningOptions()) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for every vector that is kept.

    Entries become whole numbers, so sums and deviations are exact (a deviation beyond a long is
    null). The centred rows are indexed into a block matrix; its transpose times itself, block by
    block, is the scatter, of which only the small square reaches the driver; the block matrix
    times the whitening columns are the projections, joined to the ids by row index.

    Dropped are null vectors and those that hold null, non-finite or too large entries; vectors
    without entries, and those of another length than the most frequent one (of equally frequent
    ones the longest), cannot be compared and are dropped too. Repeated rows and null ids count
    and return one by one. Directions without variance have no component, so equal vectors, a
    single one, or an empty table return no rows. Other columns are not looked at.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    out = f"vec_id {vectors.schema['vec_id'].dataType.simpleString()}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    rows = whole_vectors(vectors, options)
    lengths = rows.groupBy(F.size("x").alias("d")).count().where("d > 0")
    top = lengths.agg(F.max(F.struct("count", "d")).alias("top")).first()["top"]
    if top is None:
        return spark.createDataFrame([], out)
    n, d = top["count"], top["d"]
    rows = rows.where(F.size("x") == d)
    centred = written(centred_rows(rows, n, dimension_sums(rows)), "centred")
    numbered = indexed(centred)

    per_block = rows_per_block(n, d, spark.sparkContext.defaultParallelism, options)
    blocks = -(-n // per_block)
    named = MLUtils.convertVectorColumnsFromML(numbered.select("index", array_to_vector("centred").alias("v")), "v")
    matrix = IndexedRowMatrix(named, n, d).toBlockMatrix(per_block, d)
    scatter = _times(matrix.transpose(), matrix, blocks).toLocalMatrix().toArray()
    values, explained, columns = principal(scatter, n, options.components)
    k = len(values)
    if k == 0:
        return spark.createDataFrame([], out)

    whitening = spark.sparkContext.parallelize([((0, 0), Matrices.dense(d, k, columns.ravel(order="F").tolist()))], 1)
    product = _times(matrix, BlockMatrix(whitening, d, k, d, k), 1)

    def unblock(block):
        (row, _), found = block
        return [(row * per_block + at, w) for at, w in enumerate(found.toArray().tolist())]

    path = scratch_path(spark, "projected")
    product.blocks.flatMap(unblock).toDF("index bigint, w array<double>").write.parquet(path)
    projected = spark.read.parquet(path)
    error = identity_error(projected, k)
    shares = F.array(*[F.lit(float(s)) for s in explained])
    joined = numbered.select("index", "vec_id", "deviation").join(projected, "index")
    each = joined.select("vec_id", "deviation", F.posexplode("w").alias("i", "whitened"))
    return each.select("vec_id", (F.col("i") + 1).alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation", "whitened",
                       F.element_at(shares, F.col("i") + 1).alias("explained"), F.lit(float(error)).alias("identity_error"))
