"""Best-fit packing of documents into sequences by minimum bin slack.

Pieces of equal length are alike, so a sequence is planned over the number of pieces of each
length: the longest one left is put in, and a bitset of reachable sums over the lengths left
finds the fullest feasible rest. The combination is used as often as its lengths last. The
plan has at most a few combinations per length, whatever the number of documents.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewarden.session import scratch_path, ship_package

END = b"\0\0\0\0"
#: Characters that both tokenizer libraries class alike; others go to ``tokenizers`` itself.
ODD = re.compile(r"[^\n\r\t\x20-\x7e¡-ɏ]")


@dataclass(frozen=True)
class PackOptions:
    """``tokenizer`` names a byte-level BPE of the public tokenizers, or is a path without
    its ending: ``.json`` and the same vocabulary as ``.tiktoken`` are read."""

    capacity: int = 2048
    tokenizer: str = "byte_bpe_50k"
    cached_words: int = 300_000


class Encoder(dict):
    """Token ids of texts as unsigned little-endian 32-bit bytes.

    A byte-level BPE never joins across the place before a lone space, nor across a lone
    line break, so texts are cut there and each part's ids are kept for the next time. Texts
    that hold one of the vocabulary's added tokens get its id, as the tokenizer gives it.
    """

    def __init__(self, options: PackOptions) -> None:
        import base64

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        super().__init__()
        place = (lambda e: options.tokenizer + e) if "/" in options.tokenizer else (lambda e: public_tokenizers.path(options.tokenizer + e))
        self.whole = Tokenizer.from_file(place(".json"))
        self.added = [token.content for token in self.whole.get_added_tokens_decoder().values()]
        with open(place(".tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.part = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.limit = options.cached_words

    def __missing__(self, part: str) -> bytes:
        found = self[part] = np.asarray(self.part.encode_ordinary(part), "<u4").tobytes()
        return found

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        if ODD.search(text) or any(token in text for token in self.added):
            return np.asarray(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if any(pair in text for pair in ("  ", " \n", "\n ", "\n\n", "\t", "\r")):
            return np.asarray(self.part.encode_ordinary(text), "<u4").tobytes()
        if len(self) > self.limit:
            self.clear()
        parts = text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")
        return b"".join(map(self.__getitem__, parts))


@functools.lru_cache(maxsize=1)
def encoder_of(options: PackOptions) -> Encoder:
    """The encoder of this Python worker; its cached words serve the worker's next tasks too."""
    return Encoder(options)


def cut(docs: DataFrame, options: PackOptions = PackOptions(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces of all documents: (id, piece, start, length, ids, part, nth), as a written table.

    A document is the token ids of its whole text (null: none), then id 0. One of at most
    ``capacity`` ids is one piece; a longer one is cut into pieces of ``capacity``, of
    which the first may be shorter. ids holds unsigned little-endian 32-bit numbers. part
    and nth number the pieces of each length. Repeated rows are documents of their own,
    null ids stay null, no rows give no pieces; other columns are not read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches) -> Iterator[pa.RecordBatch]:
        encoder, numbers = encoder_of(options), Counter()
        part = TaskContext.get().partitionId()
        for batch in batches:
            for begin in range(0, len(batch), 200):
                some = batch.slice(begin, 200)
                rows: list[tuple] = []
                for row, text in enumerate(some.column(1).to_pylist()):
                    ids = encoder.ids(text) + END
                    total = len(ids) // 4
                    start, length = 0, (total - 1) % options.capacity + 1
                    piece = 0
                    while start < total:
                        rows.append((row, piece, start, length, ids[4 * start : 4 * (start + length)], numbers[length]))
                        numbers[length] += 1
                        start, length, piece = start + length, options.capacity, piece + 1
                at, piece, start, length, ids, nth = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [some.column(0).take(pa.array(at)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                     pa.array(ids, pa.binary()), pa.array([part] * len(at), pa.int32()), pa.array(nth, pa.int64())],
                    names=["id", "piece", "start", "length", "ids", "part", "nth"])

    path = scratch_path(spark, "pieces")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {kind}, piece int, start long, length long, ids binary, part int, nth long"
    rows.mapInArrow(run, schema).write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def fullest(counts: dict[int, int], lengths: list[int], room: int) -> list[tuple[int, int]]:
    """(length, how many) of a combination with the largest sum up to ``room``.

    Bit s of ``reached`` says that some of the lengths so far sum up to s; longer ones come
    first, and the search ends once ``room`` itself is reached.
    """
    reached, full = 1, (1 << (room + 1)) - 1
    steps: list[tuple[int, int]] = []
    for length in lengths:
        if length > room:
            continue
        before = reached
        for _ in range(min(counts[length], room // length)):
            more = reached | (reached << length) & full
            if more == reached:
                break
            reached = more
        if reached != before:
            steps.append((length, before))
            if reached >> room & 1:
                break
    total = reached.bit_length() - 1
    taken = []
    for length, before in reversed(steps):
        n = 0
        while not before >> total & 1:
            total -= length
            n += 1
        if n:
            taken.append((length, n))
    return taken


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """(how often, [(length, how many)]) for sequences that hold all pieces of ``counts``."""
    left = {length: n for length, n in counts.items() if n > 0}
    lengths = sorted(left, reverse=True)
    out = []
    while lengths:
        first = lengths[0]
        left[first] -= 1
        taken = Counter(dict(fullest(left, [x for x in lengths if left[x]], capacity - first)))
        left[first] += 1
        taken[first] += 1
        times = min(left[length] // n for length, n in taken.items())
        out.append((times, sorted(taken.items(), reverse=True)))
        for length, n in taken.items():
            left[length] -= times * n
        lengths = [x for x in lengths if left[x]]
    return out


def pack(pieces: DataFrame, options: PackOptions = PackOptions()) -> DataFrame:
    """``pieces`` (as of :func:`cut`, with or without ids) with ``sequence_id`` and ``offset``.

    Sequences are gapless from offset 0 and hold at most ``capacity`` ids. Only counts by
    length reach the driver (``capacity`` rows); pieces find their place by their number
    among those of their length.
    """
    spark = pieces.sparkSession
    ship_package(spark)
    by_part = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = by_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    counts = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs: dict[int, list[tuple]] = {}
    sequence = 0
    for times, taken in plan(counts, options.capacity):
        at = 0
        for length, n in taken:
            runs.setdefault(length, []).append((sequence, times, n, at))
            at += length * n
        sequence += times
    # for the pieces of a length in turn: the first one's rank, sequence and offset in each run
    base, rank, table = {}, 0, []
    for length, parts in sorted(runs.items()):
        base[length] = rank
        for first, times, n, at in parts:
            table.append((rank, first, n, at, length))
            rank += times * n
    shared = spark.sparkContext.broadcast((base, np.array(table, np.int64).reshape(-1, 5)))  # bounded by the capacity
    names = pieces.columns

    def run(batches) -> Iterator[pa.RecordBatch]:
        base, table = shared.value
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy()
            rank = np.array([base[x] for x in length.tolist()], np.int64) + batch.column(len(names)).to_numpy()
            row = table[np.searchsorted(table[:, 0], rank, "right") - 1]
            nth = rank - row[:, 0]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(names)], pa.array(row[:, 1] + nth // row[:, 2]), pa.array(row[:, 3] + nth % row[:, 2] * length)],
                names=[*names, "sequence_id", "offset"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    placed = pieces.join(starts, ["length", "part"]).select(*names, (F.col("before") + F.col("nth")).alias("rank"))
    return placed.mapInArrow(run, f"{kinds}, sequence_id long, offset long")
