"""Near-duplicate vectors by randomised-rotation binary codes.

A unit vector is rotated at random; the signs of its coordinates are its code, and the inner
product of vector and code is kept as the correction factor. With it the code gives an
unbiased estimate of the inner product with any other rotated vector, with a bound on its
error. Only pairs whose bound reaches the threshold are recomputed in double precision.

Vectors meet in buckets of equal code bits, within one label and dimension. Small labels are
one bucket. For others the number of bits grows with the label and the number of bucket
tables is set so that a pair at the threshold is missed with probability ``miss`` at most.
A large bucket is compared block against block.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewarden.llm.components import connected_components
from tidewarden.session import ship_package, written


@dataclass(frozen=True)
class VectorOptions:
    """``bucket``: vectors of a label that one bucket holds on average, at most; ``block``:
    vectors that are compared in one task; ``width``: standard errors of the bound."""

    threshold: float = 0.93
    bucket: int = 8192
    block: int = 1024
    miss: float = 1e-6
    width: float = 6.0
    seed: int = 17


def tables_for(vectors: int, options: VectorOptions) -> tuple[int, int]:
    """(bits, tables) for a label of so many vectors."""
    bits = max(0, math.ceil(math.log2(max(vectors, 1) / options.bucket)))
    if not bits:
        return 0, 1
    same = (1 - math.acos(options.threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(options.miss) / math.log1p(-same))


def rotation(dim: int, number: int, options: VectorOptions) -> np.ndarray:
    draw = np.random.default_rng([options.seed, dim, number])
    q, r = np.linalg.qr(draw.standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def codes(unit: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rotated, code as +-1 / sqrt(dim), correction factor) of unit vectors."""
    rotated = (unit @ turn).astype(np.float32)
    code = np.where(rotated >= 0, np.float32(1), np.float32(-1)) / np.float32(math.sqrt(unit.shape[1]))
    return rotated, code, np.einsum("ij,ij->i", rotated, code)


def upper_bounds(code: np.ndarray, factor: np.ndarray, rotated: np.ndarray, width: float) -> np.ndarray:
    """The highest inner product that each coded vector may have with each rotated one."""
    dim = code.shape[1]
    seen = code @ rotated.T
    spread = np.sqrt(np.maximum(1 - factor * factor, 0))[:, None]
    estimate = seen / factor[:, None] + width * spread / factor[:, None] / math.sqrt(max(dim - 1, 1))
    # never higher than if all that the code leaves out pointed the same way
    certain = factor[:, None] * seen + spread * np.sqrt(np.maximum(1 - seen * seen, 0))
    return np.minimum(estimate, certain) + 1e-5


def links(a: np.ndarray, b: np.ndarray | None, options: VectorOptions) -> tuple[np.ndarray, np.ndarray]:
    """Numbers (in a, in b) of all pairs at the threshold or above; b None: pairs i < j of a."""
    other = a if b is None else b
    turn = rotation(a.shape[1], 0, options)
    size_a, size_b = np.sqrt((a * a).sum(axis=1)), np.sqrt((other * other).sum(axis=1))
    _, code, factor = codes(a / size_a[:, None], turn)
    rotated = codes(other / size_b[:, None], turn)[0]
    found = []
    for at in range(0, len(a), 512):
        bound = upper_bounds(code[at : at + 512], factor[at : at + 512], rotated, options.width)
        i, j = np.nonzero(bound >= options.threshold)
        i += at
        if b is None:
            i, j = i[i < j], j[i < j]
        for some in range(0, len(i), 1 << 16):
            x, y = i[some : some + (1 << 16)], j[some : some + (1 << 16)]
            exact = np.einsum("ij,ij->i", a[x], other[y]) / (size_a[x] * size_b[y])
            found.append(np.stack([x, y])[:, exact >= options.threshold])
    pairs = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
    return pairs[0], pairs[1]


def roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest number reachable from each of ``n`` by the pairs."""
    low = np.arange(n)
    while True:
        new = low.copy()
        np.minimum.at(new, i, low[j])
        np.minimum.at(new, j, low[i])
        new = new[new]
        if (new == low).all():
            return low
        low = new


def _pack(batches):
    """Valid vectors as float64 bytes with their dimension; others have none."""
    for batch in batches:
        raw, dims = [], []
        for vector in batch.column(2).to_pylist():
            good = None
            if vector and None not in vector:
                row = np.asarray(vector, np.float64)
                if np.isfinite(row).all() and 0 < float(row @ row) < math.inf:
                    good = row
            raw.append(None if good is None else good.tobytes())
            dims.append(0 if good is None else len(good))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(raw, pa.binary()), pa.array(dims, pa.int32())],
                                         names=["id", "label", "raw", "dim"])


def near_duplicates(vectors: DataFrame, options: VectorOptions = VectorOptions(), id_col: str = "vec_id",
                    vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id, n_links, component_id, kept) for every row with an id, over links within a label.

    Vectors link when labels are equal and not null and their cosine reaches the threshold.
    A null or empty vector, one of zeros and one with null or non-finite components link
    with nothing, as do vectors of different dimension. Rows of equal vector and label are one class: each links
    with all others. component_id is the smallest id reachable, itself included; a row with
    a null id links with nothing and has no component. Ids are whole numbers, expected to be
    unique; other columns are not read.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    label = vectors.schema[label_col].dataType.simpleString()
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("vector"))
    packed = written(rows.mapInArrow(_pack, f"id long, label {label}, raw binary, dim int"), "vectors")
    valid = packed.where("id is not null and label is not null and dim > 0")
    classes = written(valid.groupBy("label", "dim", "raw").agg(F.min("id").alias("rep"), F.count("*").alias("n")), "classes")
    sizes = classes.groupBy("label", "dim").agg(F.count("*").alias("many"))

    def dealt(batches):
        """A row for each bucket table that a class is in, with its keys in all tables."""
        for batch in batches:
            dim, many = batch.column(1).to_numpy(), batch.column(5).to_numpy()
            for d, m in {(int(x), tables_for(int(y), options)) for x, y in zip(dim, many, strict=True)}:
                bits, tables = m
                mine = np.flatnonzero((dim == d) & np.array([tables_for(int(y), options) == m for y in many]))
                raw = batch.column(2).take(pa.array(mine))
                data = np.frombuffer(b"".join(raw.to_pylist()), np.float64).reshape(-1, d)
                keys = np.zeros((len(mine), tables), np.int64)
                for t in range(tables if bits else 0):
                    for k in range(bits):
                        number = t * bits + k
                        turn = rotation(d, 1 + number // d, options)
                        keys[:, t] |= (data @ turn[:, number % d] >= 0).astype(np.int64) << k
                all_keys = [row.tobytes() for row in keys]
                for t in range(tables):
                    chosen = batch.take(pa.array(mine))
                    yield pa.RecordBatch.from_arrays(
                        [*chosen.columns[:5], pa.array(np.full(len(mine), t, np.int32)), pa.array(keys[:, t]), pa.array(all_keys, pa.binary())],
                        names=["label", "dim", "raw", "rep", "n", "bucket_table", "bucket", "keys"])

    kept = f"label {label}, dim int, raw binary, rep long, n long, bucket_table int, bucket long, keys binary"
    place = ["label", "dim", "bucket_table", "bucket"]
    buckets = written(classes.join(sizes, ["label", "dim"]).select("label", "dim", "raw", "rep", "n", "many").mapInArrow(dealt, kept), "buckets")
    blocks = buckets.groupBy(place).agg(F.ceil(F.count("*") / options.block).alias("blocks"))
    mine = F.pmod(F.xxhash64("rep"), F.col("blocks"))
    pairs = buckets.join(blocks, place).withColumn("mine", mine).withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
    pairs = pairs.withColumn("low", F.least("mine", "other")).withColumn("high", F.greatest("mine", "other"))

    def compare(table: pa.Table) -> pa.Table:
        number = table["bucket_table"][0].as_py()
        rep, n = table["rep"].to_numpy(), table["n"].to_numpy()
        data = np.frombuffer(b"".join(table["raw"].to_pylist()), np.float64).reshape(len(rep), -1)
        keys = np.frombuffer(b"".join(table["keys"].to_pylist()), np.int64).reshape(len(rep), -1)
        upper = table["mine"].to_numpy() != table["low"].to_numpy()
        if table["low"][0].as_py() == table["high"][0].as_py():
            i, j = links(data, None, options)
        else:
            first, second = np.flatnonzero(~upper), np.flatnonzero(upper)
            i, j = links(data[first], data[second], options) if len(first) and len(second) else (np.zeros(0, int),) * 2
            i, j = first[i], second[j]
        new = ~(keys[i, :number] == keys[j, :number]).any(axis=1)  # not met in an earlier table
        i, j = i[new], j[new]
        linked = np.bincount(i, n[j], len(rep)) + np.bincount(j, n[i], len(rep))
        order = np.argsort(rep)
        rank = np.empty(len(rep), np.int64)
        rank[order] = np.arange(len(rep))
        root = rep[order][roots(len(rep), rank[i], rank[j])][rank]
        out = np.flatnonzero(linked)
        return pa.table({"a": rep[out], "b": root[out], "linked": linked[out].astype(np.int64)})

    met = pairs.select(*place, "low", "high", "mine", "rep", "n", "raw", "keys").groupBy(*place, "low", "high").applyInArrow(compare, "a long, b long, linked long")
    met = written(met, "links")
    parts = connected_components(met.select("a", "b"), "vector-components")
    totals = met.groupBy("a").agg(F.sum("linked").alias("linked"))
    facts = (classes.join(totals, classes["rep"] == totals["a"], "left").join(parts, classes["rep"] == parts["id"], "left")
             .select("label", "dim", "raw", (F.col("n") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id")))
    out = packed.join(facts, ["label", "dim", "raw"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    links_of = F.when(F.col("id").isNotNull(), F.coalesce("n_links", F.lit(0))).otherwise(0)
    return out.select(F.col("id").alias(id_col), links_of.alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
