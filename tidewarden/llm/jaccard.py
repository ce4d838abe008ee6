"""Exact Jaccard join of documents' word shingles with signature trees.

Documents with equal shingle sets are one class. The others meet where they share a key: a
key is one of the ``keys`` shingles of lowest hash of a set, however frequent it is. Two sets
of similarity J share no key only if ``keys`` shingles that one set has alone come before all
that they share in a random order: a probability of at most 2 * (1 - J) ** keys, 1e-12 for J = 0.8.

Sets that meet are searched by a signature tree: a node holds the OR of its sets' bitmaps and
their range of sizes, and two nodes are followed only if the bits that they share allow the
overlap that their sizes ask for. What remains is gathered into candidate groups, in which the
whole sets are compared exactly by the same traversal, passing over pairs that are already
in one component. Hot keys and large groups are compared block against block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewarden.llm.components import connected_components
from tidewarden.llm.embedding import roots
from tidewarden.llm.text import mix64, run_hashes, run_valid, slices, text_of, word_hashes, words_of
from tidewarden.session import ship_package, written


@dataclass(frozen=True)
class JaccardOptions:
    """Sets link when ``of`` * intersection >= ``at_least`` * union. ``hot``: a key that so many
    sets, or one in ``hot_share``, have is counted and its sets dealt into blocks; ``block``:
    sets that are compared with each other at once."""

    shingle: int = 4
    at_least: int = 85
    of: int = 100
    keys: int = 18
    hot: int = 256
    hot_share: int = 2000
    block: int = 1024
    leaf: int = 32
    fanout: int = 4


def shingles_of(column, options: JaccardOptions) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every shingle, its text's number) of the texts of a slice, repeats included."""
    words = words_of(column, lower=True)
    hashes = word_hashes(words)
    size, k = np.diff(words.first), options.shingle
    runs = run_hashes(hashes, k, k)
    at = np.flatnonzero(run_valid(words.first, len(hashes), k))
    text = text_of(words.first, len(hashes))
    found, of = [runs[at]], [text[at]]
    for few in range(1, k):  # the whole sequence of a text with fewer words
        short = np.flatnonzero(size == few)
        if len(short):
            found.append(run_hashes(hashes, few, few)[words.first[short]])
            of.append(short)
    return np.concatenate(found), np.concatenate(of)


def sets_of(column, options: JaccardOptions) -> list[np.ndarray]:
    """The sorted shingle hashes of each text of a slice."""
    found, of = shingles_of(column, options)
    order = np.lexsort((found, of))
    found, of = found[order], of[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (of[1:] != of[:-1])
    found, of = found[new], of[new]
    return np.split(found, np.searchsorted(of, np.arange(1, len(column))))


def bitmap(shingles: np.ndarray, words: int = 0) -> np.ndarray:
    """Bits of a set, about one or two for each shingle; the number of 64-bit words is a power of two."""
    words = words or 1 << max(0, int(len(shingles) - 1).bit_length() - 6)
    flags = np.zeros(words * 64, bool)
    flags[(shingles & np.uint64(words * 64 - 1)).astype(np.int64)] = True
    return np.packbits(flags, bitorder="little").view(np.uint64)


class Node(NamedTuple):
    bits: np.ndarray
    low: int
    high: int
    spare: int  # shingles beyond a set's bits, at most
    rows: np.ndarray
    below: list


def grow(rows: np.ndarray, bits: np.ndarray, size: np.ndarray, options: JaccardOptions) -> Node:
    """A tree over rows that are in order of size."""
    below = []
    if len(rows) > options.leaf:
        below = [grow(part, bits, size, options) for part in np.array_split(rows, options.fanout) if len(part)]
        whole = np.bitwise_or.reduce([n.bits for n in below])
        return Node(whole, below[0].low, below[-1].high, max(n.spare for n in below), rows, below)
    spare = size[rows] - np.bitwise_count(bits[rows]).sum(axis=1, dtype=np.int64)
    return Node(np.bitwise_or.reduce(bits[rows]), int(size[rows[0]]), int(size[rows[-1]]), int(spare.max()), rows, below)


def may_link(a: Node, b: Node, options: JaccardOptions) -> bool:
    low, high = (a, b) if a.low <= b.low else (b, a)
    if high.low * options.at_least > low.high * options.of:
        return False
    shared = int(np.bitwise_count(a.bits & b.bits).sum()) + min(a.spare, b.spare)
    need = options.at_least * (a.low + b.low)
    return shared * (options.of + options.at_least) >= need


def candidates(a: Node, b: Node, bits_a, bits_b, size_a, size_b, options: JaccardOptions, settled=None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows whose bitmaps allow a link, leaf pair by leaf pair; a is b: each pair once."""
    stack = [(a, b)]
    while stack:
        x, y = stack.pop()
        if not may_link(x, y, options) or settled is not None and settled(x, y):
            continue
        if x.below or y.below:
            left, right = x.below or [x], y.below or [y]
            stack += [(p, q) for i, p in enumerate(left) for q in (right[i:] if x is y else right)]
            continue
        p, q = x.rows, y.rows
        only_p = np.bitwise_count(bits_a[p][:, None, :] & ~bits_b[q][None]).sum(axis=2, dtype=np.int64)
        only_q = np.bitwise_count(~bits_a[p][:, None, :] & bits_b[q][None]).sum(axis=2, dtype=np.int64)
        n, m = size_a[p][:, None], size_b[q][None]
        most = np.minimum(n - only_p, m - only_q)
        good = most * (options.of + options.at_least) >= options.at_least * (n + m)
        if x is y:
            good &= np.arange(len(p))[:, None] < np.arange(len(q))[None]
        i, j = np.nonzero(good)
        if len(i):
            yield p[i], q[j]


def fold(bits: np.ndarray) -> np.ndarray:
    half = bits.shape[1] // 2
    return bits[:, :half] | bits[:, half:]


def meet(bits: list[bytes], size: np.ndarray, side: np.ndarray, options: JaccardOptions) -> tuple[np.ndarray, np.ndarray]:
    """Candidate pairs of a group; sets of two different sides are compared only across them."""
    width = np.array([len(b) // 8 for b in bits])
    found = [np.zeros((2, 0), np.int64)]
    sides = np.unique(side)

    def trees(rows, matrix):
        order = rows[np.argsort(size[rows], kind="stable")]
        where = np.searchsorted(rows, order)
        return order, matrix[where], size[order]

    for w in np.unique(width):
        def part(s, of):
            rows = np.flatnonzero((width == of) & (side == s))
            if not len(rows):
                return None
            matrix = np.frombuffer(b"".join(bits[r] for r in rows), np.uint64).reshape(len(rows), of)
            rows, matrix, n = trees(rows, fold(matrix) if of > w else matrix)
            return rows, matrix, n, grow(np.arange(len(rows)), matrix, n, options)

        pairs = [(s, w, s, 2 * w) for s in sides] if len(sides) == 1 else [(sides[0], w, sides[1], 2 * w), (sides[1], w, sides[0], 2 * w), (sides[0], w, sides[1], w)]
        if len(sides) == 1:
            pairs.append((sides[0], w, sides[0], w))
        built: dict = {}
        for s, of, t, to in pairs:
            for key in ((s, of), (t, to)):
                if key not in built:
                    built[key] = part(*key)
            a, b = built[(s, of)], built[(t, to)]
            if a is None or b is None:
                continue
            for i, j in candidates(a[3], b[3], a[1], b[1], a[2], b[2], options):
                found.append(np.stack([a[0][i], b[0][j]]))
    both = np.concatenate(found, axis=1)
    return both[0], both[1]


class Overlap:
    """Sizes of the intersections of a group's sets, counted for 32 sets at once."""

    def __init__(self, sets: list[np.ndarray]):
        known, code = np.unique(np.concatenate(sets), return_inverse=True)
        self.codes = np.split(code, np.cumsum([len(s) for s in sets])[:-1])
        self.marks = np.zeros(len(known), np.uint32)  # bit c: the c-th set of the other side has this shingle

    def pairs(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Shingles that set i[n] shares with set j[n]."""
        left, of_left = np.unique(i, return_inverse=True)
        right, of_right = np.unique(j, return_inverse=True)
        out = np.zeros(len(i), np.int64)
        bits = np.arange(32, dtype=np.uint32)
        for at in range(0, len(right), 32):
            some = right[at : at + 32].tolist()
            for c, r in enumerate(some):
                self.marks[self.codes[r]] |= np.uint32(1 << c)
            mine = np.flatnonzero((of_right >= at) & (of_right < at + 32))
            counts = np.zeros((len(left), 32), np.int64)
            for row in np.unique(of_left[mine]).tolist():
                counts[row] = (self.marks[self.codes[left[row]]][:, None] >> bits & np.uint32(1)).sum(axis=0)
            out[mine] = counts[of_left[mine], of_right[mine] - at]
            for r in some:
                self.marks[self.codes[r]] = 0
        return out


def verify(sets: list[np.ndarray], side: np.ndarray, options: JaccardOptions) -> tuple[np.ndarray, np.ndarray]:
    """Links of a group, enough to hold its components: pairs already joined are passed over."""
    size = np.array([len(s) for s in sets])
    parent = list(range(len(sets)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links = []
    widest = 1 << max(0, int(size.max() - 1).bit_length() - 6)
    whole = np.stack([bitmap(s, widest) for s in sets])
    sides = [np.flatnonzero(side == s) for s in np.unique(side)]
    built = []
    for rows in sides:
        order = rows[np.argsort(size[rows], kind="stable")]
        built.append((order, grow(np.arange(len(order)), whole[order], size[order], options)))
    (rows_a, a), (rows_b, b) = built[0], built[-1]

    def settled(x: Node, y: Node) -> bool:
        first = root(int(rows_a[x.rows[0]]))
        return all(root(int(r)) == first for r in rows_a[x.rows]) and all(root(int(r)) == first for r in rows_b[y.rows])

    overlap = Overlap(sets)
    for p, q in candidates(a, b, whole[rows_a], whole[rows_b], size[rows_a], size[rows_b], options, settled):
        i, j = rows_a[p], rows_b[q]
        apart = np.array([root(x) != root(y) for x, y in zip(i.tolist(), j.tolist(), strict=True)], bool)
        i, j = i[apart], j[apart]
        shared = overlap.pairs(i, j)
        linked = options.of * shared >= options.at_least * (size[i] + size[j] - shared)
        for x, y in zip(i[linked].tolist(), j[linked].tolist(), strict=True):
            first, second = root(x), root(y)
            if first != second:
                parent[max(first, second)] = min(first, second)
                links.append((x, y))
    pairs = np.array(links, np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def _in_groups(compare):
    """Run ``compare`` over the rows of each route of a partition and give edges (a, b) of its components."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if len(b)]
        if not parts:
            return
        table = pa.Table.from_batches(parts)
        route, rep = table["route"].to_numpy(), table["rep"].to_numpy()
        size, side = table["n"].to_numpy(), table["side"].to_numpy()
        load = table["load"].combine_chunks()
        order = np.argsort(route, kind="stable")
        cuts = np.flatnonzero(np.append(True, np.diff(route[order]) != 0))
        ends = np.append(cuts[1:], len(order))
        out_a, out_b = [], []
        for begin, end in zip(cuts[end_over_one := (ends - cuts) > 1], ends[end_over_one], strict=True):
            rows = order[begin:end]
            rows = rows[np.argsort(rep[rows], kind="stable")]
            i, j = compare(load.take(pa.array(rows)).to_pylist(), size[rows], side[rows])
            if len(i):
                root = roots(len(rows), i, j)
                moved = np.flatnonzero(root != np.arange(len(rows)))
                out_a.append(rep[rows[moved]])
                out_b.append(rep[rows[root[moved]]])
        if out_a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], names=["a", "b"])
    return run


def _routes(rows: DataFrame, key: str, blocks: str, *keep: str) -> DataFrame:
    """A row for each pair of blocks that a set of a group of ``blocks`` blocks takes part in."""
    side = F.pmod(F.xxhash64("rep"), F.col(blocks))
    dealt = rows.withColumn("side", side).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1)))
    route = F.when(F.col(blocks) == 1, F.col(key)).otherwise(F.xxhash64(key, F.least("side", "other"), F.greatest("side", "other")))
    return dealt.select(route.alias("route"), "side", "rep", *keep)


def similar_documents(docs: DataFrame, options: JaccardOptions = JaccardOptions(), id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) for every row, over links between shingle sets.

    Words are lower-cased (A-Z) runs without white space; a text of fewer words than a
    shingle is one shingle, a null text or one without words has none and links with
    nothing. component_id is the smallest id reachable by links, itself included; rows of one
    id count as one document if their sets are equal and else link through that id. A null id has a null component and links
    with nothing. Ids are whole numbers; other columns are not read.
    """
    spark = docs.sparkSession
    ship_package(spark)

    def describe(batches) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            sets = sets_of(part.column(1), options)
            sums = [[int((mix64(s ^ np.uint64(salt))).sum(dtype=np.uint64).view(np.int64)) for s in sets] for salt in (0x51ED, 0xA7C3)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(sums[0], pa.int64()), pa.array(sums[1], pa.int64()),
                 pa.array([s[: options.keys].tobytes() for s in sets], pa.binary()), pa.array([bitmap(s).tobytes() for s in sets], pa.binary())],
                names=["id", "n", "s", "t", "low", "bits"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    described = written(rows.mapInArrow(describe, "id long, n long, s long, t long, low binary, bits binary"), "shingles")
    valid = described.where("id is not null and n > 0")
    first = valid.groupBy("n", "s", "t").agg(F.min(F.struct("id", "low", "bits")).alias("first"))
    reps = written(first.select(F.col("first.id").alias("rep"), "n", "s", "t", F.col("first.low").alias("low"), F.col("first.bits").alias("bits")), "sets")
    most = reps.count() // options.hot_share

    def frequent(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, n = np.unique(np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint64), return_counts=True)
            some = n > 1
            yield pa.RecordBatch.from_arrays([pa.array(key[some].view(np.int64)), pa.array(n[some].astype(np.int64))], names=["key", "n"])

    counted = reps.select("low").mapInArrow(frequent, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    hot_rows = counted.where(F.col("n") >= max(options.hot, most)).collect()  # keys * hot_share rows at most, or keys * docs / hot if fewer
    hot_rows.sort(key=lambda r: r["key"])
    hot = spark.sparkContext.broadcast((np.array([r["key"] for r in hot_rows], np.int64), np.array([r["n"] for r in hot_rows], np.int64)))

    def keyed(batches) -> Iterator[pa.RecordBatch]:
        hot_key, hot_n = hot.value
        for batch in batches:
            low = batch.column(2).to_pylist()
            size = np.array([len(x) // 8 for x in low])
            key = np.frombuffer(b"".join(low), np.int64)
            row = np.repeat(np.arange(len(low)), size)
            n = np.zeros(len(key), np.int64)
            if len(hot_key) and len(key):
                at = np.minimum(np.searchsorted(hot_key, key), len(hot_key) - 1)
                n[hot_key[at] == key] = hot_n[at[hot_key[at] == key]]
            blocks = np.maximum(1, -(-n // options.block))
            yield pa.RecordBatch.from_arrays([pa.array(key), batch.column(0).take(pa.array(row)), pa.array(blocks)], names=["key", "rep", "blocks"])

    keys = reps.select("rep", "n", "low").mapInArrow(keyed, "key long, rep long, blocks long")
    routes = written(_routes(keys, "key", "blocks"), "keys")
    shared = routes.groupBy("route").agg(F.count("*").alias("many")).where("many > 1").select("route")
    loads = routes.join(shared, "route", "left_semi").join(reps.select("rep", "n", F.col("bits").alias("load")), "rep")
    met = loads.repartition("route").mapInArrow(_in_groups(lambda load, size, side: meet(load, size, side, options)), "a long, b long")
    groups = connected_components(met, "candidates")
    groups = written(groups.withColumnRenamed("id", "rep").withColumnRenamed("component", "key"), "groups")
    blocks = groups.groupBy("key").agg(F.ceil(F.count("*") / options.block).alias("blocks"))
    texts = rows.join(groups, rows["id"] == groups["rep"]).select("rep", "key", "text")

    def whole(batches) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            sets = sets_of(part.column(2), options)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                                             names=["rep", "key", "n", "load"])

    full = texts.mapInArrow(whole, "rep long, key long, n long, load binary").where("n > 0").join(blocks, "key")
    exact = lambda load, size, side: verify([np.frombuffer(x, np.uint64) for x in load], side, options)
    linked = _routes(full, "key", "blocks", "n", "load").repartition("route").mapInArrow(_in_groups(exact), "a long, b long")
    same_set = valid.join(reps.select("n", "s", "t", "rep"), ["n", "s", "t"]).where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    parts = connected_components(linked.union(same_set), "documents")
    out = described.select("id", "n").join(parts, "id", "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))
