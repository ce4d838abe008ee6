"""Language-model scores: unigram counts of words, and prediction by partial matching of bytes.

The word part needs the corpus count of every word of every text. Texts are dealt into
batches; a batch asks for each of its distinct words once, and gets a table of counts back,
so what moves grows with batches' vocabularies and no table of all words is broadcast. What
is asked for is summed by word and joined with what the batches ask, and a batch's texts are
read after its answers, a slice at a time: a task holds a batch's table and one slice of text.

The byte part is a context trie of depth three. A byte seen after its longest context is
coded there; else an escape (as likely as the context's number of distinct followers) leads
to the next shorter context, where the followers already ruled out are excluded. Counts of
two-byte strings are shared; strings of four bytes (a three-byte context and its byte) are asked
for as words are. Their sums go to the share of their last two context bytes (65,536 strings at
most), which holds all counts that a code length needs, and a batch gets lengths back. All
learned contexts take part, and none passes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewarden.llm.text import mix64, slices, utf8, word_hashes, words_of
from tidewarden.session import ship_package


#: Bytes of text read or scored at a time (a longer text by itself), which bounds the arrays of a task.
SLICE = 1 << 19
#: Distinct words and strings that a task holds before it asks for them, and strings whose lengths are found at once.
HELD, SHARED = 1 << 22, 1 << 16


@dataclass(frozen=True)
class LmOptions:
    """``batch_bytes``: text that one batch holds, about."""

    batch_bytes: int = 24 << 20


@dataclass(frozen=True)
class Trie:
    """Base-2 code lengths of a small frozen trie in memory, the plain form that tests compare with.

    two[context * 256 + byte] is the length of a byte after a two-byte context and
    three[row, byte] after a three-byte one. slots maps a hashed three-byte context to its
    row (-1: not held); ``keys`` holds the rows' contexts.
    """

    two: np.ndarray
    slots: np.ndarray
    keys: np.ndarray
    three: np.ndarray


def codes_of(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Four-byte strings that end at every byte; the first bytes of a text have zeros before them."""
    padded = np.concatenate([np.zeros(3, np.uint8), data]).astype(np.uint32)
    n = len(data)
    code = (padded[:n] << 24) | (padded[1 : n + 1] << 16) | (padded[2 : n + 2] << 8) | padded[3 : n + 3]
    for back in (1, 2, 3):
        at = offsets[:-1] + 3 - back
        at = at[at < offsets[1:]]
        code[at] &= np.uint32((1 << (8 * (4 - back))) - 1)
    return code


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two-byte strings of the learned texts and their counts, merged over the whole task."""
    counts = np.zeros(1 << 16, np.int64)
    for part in slices(batches, limit=SLICE):
        counts += np.bincount(codes_of(*utf8(part.column(0))) & 0xFFFF, minlength=1 << 16)
    code = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(counts[code])], names=["code", "n"])


def _log2(x: np.ndarray) -> np.ndarray:
    return np.log2(np.maximum(x, 1e-300))


def pair_counts(texts: DataFrame) -> np.ndarray:
    """How often each byte follows each byte in the texts: 65,536 counts at most reach the driver."""
    seen = texts.where("text is not null").mapInArrow(_pairs, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toPandas()
    c2 = np.zeros(1 << 16)
    c2[seen["code"].to_numpy(np.int64)] = seen["n"].to_numpy(np.float64)
    return c2.reshape(256, 256)


def lengths(code: np.ndarray, n: np.ndarray, c2: np.ndarray) -> np.ndarray:
    """Base-2 code lengths of distinct, sorted four-byte strings by their counts ``n`` (0: not learned).

    All learned strings that share the last two context bytes of any of them must be among them.
    """
    c1 = c2.sum(axis=0)
    total, kinds = c1.sum(), (c1 > 0).sum()
    len0 = np.where(c1 > 0, -_log2(c1 / max(total + kinds, 1)), -_log2(kinds / max(total + kinds, 1)) + np.log2(max(256 - kinds, 1)))
    if not kinds:
        len0 = np.full(256, 8.0)
    has2 = c2 > 0
    t2, d2 = c2.sum(axis=1), has2.sum(axis=1)
    rest_t, rest_d = total - has2 @ c1, kinds - d2
    escape2 = np.where(t2 > 0, -_log2(d2 / np.maximum(t2 + d2, 1)), 0.0)
    below = np.where(c1[None, :] > 0, -_log2(c1[None, :] / np.maximum(rest_t + rest_d, 1)[:, None]),
                     -_log2(np.maximum(rest_d, 0.5) / np.maximum(rest_t + rest_d, 1))[:, None] + np.log2(max(256 - kinds, 1)))
    len1 = np.where(has2, -_log2(c2 / np.maximum(t2 + d2, 1)[:, None]), escape2[:, None] + below)
    len1[t2 == 0] = len0
    # order 2: strings of three bytes, and sums over their contexts of two
    code = code.astype(np.int64)
    code3, of3 = np.unique(code & 0xFFFFFF, return_inverse=True)
    n3 = np.bincount(of3, weights=n, minlength=len(code3))
    context2, of2 = np.unique(code3 >> 8, return_inverse=True)
    mid, last = code3 >> 8 & 255, code3 & 255
    sum2 = lambda x: np.bincount(of2, weights=x, minlength=len(context2))[of2]
    t3, d3 = sum2(n3), sum2(n3 > 0)
    left_t, left_d = t2[mid] - sum2((n3 > 0) * c2[mid, last]), d2[mid] - d3
    again = np.maximum(left_t + left_d, 1)
    lower = np.where(has2[mid, last], -_log2(c2[mid, last] / again), len1[mid, last] - escape2[mid] - _log2(np.maximum(left_d, 0.5) / again))
    escape3 = np.where(t3 > 0, -_log2(d3 / np.maximum(t3 + d3, 1)), 0.0)
    two = np.where(n3 > 0, -_log2(n3 / np.maximum(t3 + d3, 1)), escape3 + lower)
    two = np.where(t3 == 0, len1[mid, last], two)
    # order 3
    context3, of4 = np.unique(code >> 8, return_inverse=True)
    sum3 = lambda x: np.bincount(of4, weights=x, minlength=len(context3))[of4]
    t4, d4 = sum3(n), sum3(n > 0)
    parent, two = n3[of3], two[of3]
    left_t, left_d = t3[of3] - sum3((n > 0) * parent), d3[of3] - d4
    again = np.maximum(left_t + left_d, 1)
    lower = np.where(parent > 0, -_log2(parent / again), two - escape3[of3] - _log2(np.maximum(left_d, 0.5) / again))
    three = np.where(n > 0, -_log2(n / np.maximum(t4 + d4, 1)), -_log2(d4 / np.maximum(t4 + d4, 1)) + lower)
    return np.where(t4 == 0, two, three)


def lay_out(code3: np.ndarray, n3: np.ndarray, code4: np.ndarray, n4: np.ndarray) -> Trie:
    """Code lengths from counts of three-byte strings and, in order, of four-byte strings of the kept contexts."""
    c3 = np.zeros(1 << 24, np.float32)
    c3[code3] = n3
    c3 = c3.reshape(1 << 16, 256)
    c2 = np.zeros((256, 256), np.float64)
    np.add.at(c2, (code3 >> 8 & 255, code3 & 255), n3)
    c1 = c2.sum(axis=0)
    # order 0, with an escape to a uniform byte
    total, kinds = c1.sum(), (c1 > 0).sum()
    len0 = np.where(c1 > 0, -_log2(c1 / max(total + kinds, 1)), -_log2(np.full(256, kinds / max(total + kinds, 1))) + _log2(np.full(256, max(256 - kinds, 1))))
    if not kinds:
        len0 = np.full(256, 8.0)
    # order 1: excluded from order 0 are the followers of the one-byte context
    has2 = c2 > 0
    t2, d2 = c2.sum(axis=1), has2.sum(axis=1)
    excluded = has2 @ c1
    rest_t, rest_d = total - excluded, kinds - d2
    escape2 = np.where(t2 > 0, -_log2(d2 / np.maximum(t2 + d2, 1)), 0.0)
    below = np.where(c1[None, :] > 0, -_log2(c1[None, :] / np.maximum(rest_t + rest_d, 1)[:, None]),
                     -_log2(np.maximum(rest_d, 0.5) / np.maximum(rest_t + rest_d, 1))[:, None] + np.log2(max(256 - kinds, 1)))
    len1 = np.where(has2, -_log2(c2 / np.maximum(t2 + d2, 1)[:, None]), escape2[:, None] + below)
    len1[t2 == 0] = len0
    # order 2
    two = np.empty((1 << 16, 256), np.float32)
    tail = np.arange(256)
    for head in range(256):
        block = c3[head * 256 : head * 256 + 256].astype(np.float64)
        has3 = block > 0
        t3, d3 = block.sum(axis=1), has3.sum(axis=1)
        left_t = t2[tail] - (has3 * c2).sum(axis=1)
        left_d = d2[tail] - d3
        escape3 = np.where(t3 > 0, -_log2(d3 / np.maximum(t3 + d3, 1)), 0.0)
        seen1 = -_log2(c2 / np.maximum(left_t + left_d, 1)[:, None])
        unseen1 = len1 - escape2[:, None] - _log2(np.maximum(left_d, 0.5) / np.maximum(left_t + left_d, 1))[:, None]
        lower = np.where(has2, seen1, unseen1)
        block = np.where(has3, -_log2(block / np.maximum(t3 + d3, 1)[:, None]), escape3[:, None] + lower)
        block[t3 == 0] = len1[t3 == 0]
        two[head * 256 : head * 256 + 256] = block
    context, first = np.unique(code4 >> 8, return_index=True)
    three = np.empty((len(context), 256), np.float32)
    two_of = two.reshape(1 << 16, 256)
    for at in range(0, len(context), 1024):  # a part at a time: the tables are wide
        some = context[at : at + 1024]
        mine = slice(first[at], first[at + 1024] if at + 1024 < len(first) else None)
        rows = np.zeros((len(some), 256))
        rows[np.searchsorted(some, code4[mine] >> 8), code4[mine] & 255] = n4[mine]
        has4 = rows > 0
        t4, d4 = rows.sum(axis=1), has4.sum(axis=1)
        parent = c3[some & 0xFFFF].astype(np.float64)
        parent_t, parent_d = parent.sum(axis=1), (parent > 0).sum(axis=1)
        left_t, left_d = parent_t - (has4 * parent).sum(axis=1), parent_d - d4
        escape4 = -_log2(d4 / np.maximum(t4 + d4, 1))
        escape3 = -_log2(parent_d / np.maximum(parent_t + parent_d, 1))
        again = -_log2(np.maximum(left_d, 0.5) / np.maximum(left_t + left_d, 1))
        lower = np.where(parent > 0, -_log2(parent / np.maximum(left_t + left_d, 1)[:, None]),
                         two_of[some & 0xFFFF] - escape3[:, None] + again[:, None])
        three[at : at + 1024] = np.where(has4, -_log2(rows / np.maximum(t4 + d4, 1)[:, None]), escape4[:, None] + lower)
    bits = max(4, int(np.ceil(np.log2(max(len(context), 1)))) + 2)
    slots = np.full(1 << bits, -1, np.int32)
    home = _home(context.astype(np.uint64), bits)
    for row, at in enumerate(home):
        while slots[at] >= 0:
            at = (at + 1) & ((1 << bits) - 1)
        slots[at] = row
    return Trie(two.reshape(-1), slots, np.append(context, -1).astype(np.int64), three)


def _home(context: np.ndarray, bits: int) -> np.ndarray:
    return (mix64(context) >> np.uint64(64 - bits)).astype(np.int64)


def code_lengths(column, trie: Trie) -> np.ndarray:
    """Bits of each text of a slice; the first bytes of a text follow zeros."""
    data, offsets = utf8(column)
    n = len(data)
    padded = np.concatenate([np.zeros(3, np.uint8), data]).astype(np.int64)
    context = (padded[:n] << 16) | (padded[1 : n + 1] << 8) | padded[2 : n + 2]
    for back in (1, 2, 3):
        at = offsets[:-1] + 3 - back
        at = at[at < offsets[1:]]
        context[at] &= (1 << (8 * (3 - back))) - 1
    bits = int(np.log2(len(trie.slots)))
    at = _home(context.astype(np.uint64), bits)
    row = trie.slots[at]
    wrong = np.flatnonzero((row >= 0) & (trie.keys[row] != context))
    while len(wrong):
        at[wrong] = (at[wrong] + 1) & (len(trie.slots) - 1)
        row[wrong] = trie.slots[at[wrong]]
        wrong = wrong[(row[wrong] >= 0) & (trie.keys[row[wrong]] != context[wrong])]
    cost = np.empty(n, np.float32)
    held = row >= 0
    cost[held] = trie.three[row[held], data[held]]
    away = np.flatnonzero(~held)
    cost[away] = trie.two[((context[away] & 0xFFFF) << 8) | data[away]]
    sums = np.concatenate([[0.0], np.cumsum(cost, dtype=np.float64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _merged(parts: list) -> tuple[np.ndarray, np.ndarray]:
    words, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return words, np.bincount(where, weights=np.concatenate([p[1] for p in parts]), minlength=len(words))


def _vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct words (kind 0) and four-byte strings (kind 1) of a batch of texts with their learned occurrences.

    Once per batch, but for batches of more than ``HELD`` of them, which ask for some again.
    """
    held: dict[tuple[int, int], list] = {}
    added: dict[tuple[int, int], int] = {}

    def add(batch, kind, found, n) -> None:
        key = int(batch), kind
        pieces = held.setdefault(key, [])
        pieces.append((found, n))
        added[key] = added.get(key, 0) + len(found)
        if added[key] > max(2 * len(pieces[0][0]), 1 << 16):
            held[key], added[key] = [_merged(pieces)], 0

    def asked() -> Iterator[pa.RecordBatch]:
        for (batch, kind), parts in held.items():
            words, n = _merged(parts)
            for at in range(0, len(words), 1 << 16):
                one = slice(at, at + (1 << 16))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(words[one]), kind, np.int32)), pa.array(words[one].astype(np.int64)),
                     pa.array(np.full(len(words[one]), batch, np.int32)), pa.array(n[one].astype(np.int64))],
                    names=["kind", "word", "batch", "n"])
        held.clear()
        added.clear()

    for part in slices(batches, limit=SLICE):
        data, offsets = utf8(part.column(1))
        code = codes_of(data, offsets)
        words = words_of(part.column(1), lower=True)
        hashes = word_hashes(words).view(np.int64)
        of, teaches = (part.column(k).to_numpy(zero_copy_only=False) for k in (0, 2))
        for batch in np.unique(of):
            for taught in (True, False):
                mine = (of == batch) & (teaches == taught)
                for kind, found, each in ((0, hashes, np.diff(words.first)), (1, code, np.diff(offsets))):
                    found, n = np.unique(found[np.repeat(mine, each)], return_counts=True)
                    add(batch, kind, found, n * float(taught))
        if sum(len(x) for parts in held.values() for x, _ in parts) > HELD:
            yield from asked()
    yield from asked()


def _lengths(c2: Broadcast):
    """Code lengths of the strings of whole shares, which come in order."""
    def answer(word: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(word)
        word = word[order]
        return pa.RecordBatch.from_arrays([pa.array(word), pa.array(lengths(word, n[order], c2.value))], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share, word, n = (np.zeros(0, np.int64) for _ in range(3))
        for batch in batches:
            share, word, n = (np.concatenate([x, batch.column(k).to_numpy()]) for k, x in enumerate((share, word, n)))
            whole = int(np.searchsorted(share, share[-1])) if len(share) else 0
            if whole and len(share) > SHARED:
                yield answer(word[:whole], n[:whole])
                share, word, n = share[whole:], word[whole:], n[whole:]
        if len(word):
            yield answer(word, n)
    return run


def _scores(tokens: int, distinct: int, taught: int):
    """Scores of the texts (side 2) of batches; before them come a batch's counts of words (side 0) and lengths of strings (side 1)."""
    floor = np.log10(1.0 / (tokens + distinct + 1.0))
    last = np.log10((taught + 1.0) / (tokens + distinct + 1.0))

    def table(pieces: list, kind) -> tuple[np.ndarray, np.ndarray]:
        if not pieces:
            return np.zeros(0, kind), np.zeros(0)
        word, n = (np.concatenate(x) for x in zip(*pieces))
        order = np.argsort(word, kind="stable")
        return word[order], n[order]

    def scored(part: pa.RecordBatch, word, n, string, length) -> pa.RecordBatch:
        column = part.column(6)
        data, offsets = utf8(column)
        sums = np.concatenate([[0.0], np.cumsum(length[np.searchsorted(string, codes_of(data, offsets))] if len(data) else [])])
        bits = sums[offsets[1:]] - sums[offsets[:-1]]
        words = words_of(column, lower=True)
        hashes = word_hashes(words).view(np.int64)
        count = np.zeros(len(hashes))
        if len(word):
            place = np.minimum(np.searchsorted(word, hashes), len(word) - 1)
            hit = word[place] == hashes
            count[hit] = n[place[hit]]
        add = lambda x: np.diff(np.concatenate([[0.0], np.cumsum(x)])[words.first])
        sizes = np.diff(words.first)
        base = add(np.log10(count + 1.0)) + sizes * floor + last
        found = {
            "id": part.column(4), "held_out": part.column(5), "n_tokens": (sizes + 1).astype(np.int64),
            "n_known": (add(count > 0) + (taught > 0)).astype(np.int64), "train_tokens": np.full(len(part), tokens, np.int64),
            "base_score": base, "score": -bits * np.log10(2.0), "bits_per_byte": bits / np.maximum(np.diff(offsets), 1)}
        return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in found.values()], names=list(found))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, tables, pieces = None, None, ([], [])
        for batch in batches:
            of, side = (batch.column(k).to_numpy() for k in (0, 1))
            cuts = [0, *(np.flatnonzero((np.diff(of) != 0) | (np.diff(side) != 0)) + 1), len(of)]
            for at, end in zip(cuts[:-1], cuts[1:]):
                if at == end:
                    continue
                if of[at] != current:
                    current, tables, pieces = of[at], None, ([], [])
                part = batch.slice(at, end - at)
                if side[at] < 2:
                    word = part.column(2).to_numpy()
                    pieces[side[at]].append((word.astype(np.uint32 if side[at] else np.int64), part.column(3).to_numpy().copy()))
                    continue
                if tables is None:
                    tables, pieces = (*table(pieces[0], np.int64), *table(pieces[1], np.uint32)), ([], [])
                for some in slices([part], limit=SLICE):
                    yield scored(some, *tables)
    return run


def score(docs: DataFrame, held_out: Column, options: LmOptions = LmOptions(),
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) per row.

    Learns from the rows where ``held_out`` is false (null: held out). Words are lower-cased
    (A-Z) runs without white space, each text ending with an end token. base_score sums
    log10((c + 1) / (N + V + 1)) over the tokens; score is the trie's log10 probability of
    the text's bytes. A null or empty text is one end token and no bytes (score 0). One row
    per input row; repeated rows teach as often as they stand there. Without learned rows
    every count is 0. Other columns are not read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       F.coalesce(held_out, F.lit(True)).alias("held_out"))
    shared = spark.sparkContext.broadcast(pair_counts(rows.where("not held_out").select("text")))
    sums = rows.agg(F.sum(F.octet_length("text")).alias("size"), F.sum((~F.col("held_out")).cast("int")).alias("taught")).first()
    n_batches = max(1, -(-(sums["size"] or 0) // options.batch_bytes))
    taught = sums["taught"] or 0
    dealt = rows.withColumn("batch", F.pmod(F.xxhash64("id", "text"), F.lit(n_batches)).cast("int"))
    apart = dealt.select("batch", "text", (~F.col("held_out")).alias("teaches")).repartitionById(n_batches, "batch")
    asked = apart.mapInArrow(_vocabulary, "kind int, word long, batch int, n long").repartition(
        2 * n_batches, "kind", "word").persist(StorageLevel.DISK_ONLY)
    totals = asked.groupBy("kind", "word").agg(F.sum("n").alias("n"))
    known = totals.where("kind = 0 and n > 0")
    facts = known.agg(F.sum("n").alias("tokens"), F.count("n").alias("kinds")).first()
    tokens, distinct = (facts["tokens"] or 0) + taught, facts["kinds"] + (taught > 0)
    strings = totals.where("kind = 1").select(F.shiftright("word", 8).bitwiseAND(0xFFFF).alias("share"), "word", "n")
    strings = strings.repartition("share").sortWithinPartitions("share").mapInArrow(_lengths(shared), "word long, n double")
    answers = known.select("kind", "word", F.col("n").cast("double").alias("n")).unionByName(strings.withColumn("kind", F.lit(1)))
    answered = asked.select("kind", "word", "batch").join(answers, ["kind", "word"])
    kind_of = docs.schema[id_col].dataType
    nothing = lambda name, kind: F.lit(None).cast(kind).alias(name)
    both = answered.select("batch", F.col("kind").alias("side"), "word", "n", nothing("id", kind_of), nothing("held_out", "boolean"), nothing("text", "string")).unionByName(
        dealt.select("batch", F.lit(2).alias("side"), nothing("word", "long"), nothing("n", "double"), "id", "held_out", "text"))
    scored = both.repartitionById(n_batches, "batch").sortWithinPartitions("batch", "side").mapInArrow(
        _scores(tokens, distinct, taught),
        f"id {kind_of.simpleString()}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double, bits_per_byte double")
    return scored.withColumnRenamed("id", id_col)
