"""Substring removal by relative Lempel-Ziv parsing against an index of the whole corpus.

Every text is a reference for those after it. Blocks of it are indexed by anchors: of each
window of consecutive words, the run of words inside it with the lowest hash. Equal windows
have the same anchor, so only anchors that stand at two places are followed up, and where the
words around an anchor differ, single windows are looked up. With the earliest occurrence of
each repeated window a text is parsed greedily into factors: a factor goes on while the next
window continues the same reference; at its end, the windows across the boundary have their
own references. The words of all factors are the duplicate spans.

A frequent anchor or window never gathers: each task first settles its own occurrences and
passes on one row for each anchor (or window) that it has seen. Repeated rows are one document:
what a task has of them is one row, so copies of a row cost their number, not its square.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewarden.llm.text import mix64, run_hashes, run_valid, slices, word_hashes, words_of
from tidewarden.session import ship_package

STEP = 0x9E6C63D0676A9A99
BACK = pow(STEP, -1, 2**64)
#: A place: the word's number, and how far before it the first and the last window of an anchor start, 4 bits each.
PLACE = 8
LAST_ID = 2**63 - 1
ONE, MANY, CHECK, COPY = 0, 1, 2, 3


@dataclass(frozen=True)
class SubstringOptions:
    """``window``: words that make a duplicate; ``run``: words of an anchor (window - run below 16);
    ``flush``: anchors that a task settles at once."""

    window: int = 20
    run: int = 6
    flush: int = 1 << 21


def anchors(hashes: np.ndarray, first: np.ndarray, options: SubstringOptions) -> tuple[np.ndarray, ...]:
    """(anchor hash, context hash, word, windows' first and last start) over the words of a slice.

    The context covers all words of the anchor's windows.
    """
    size, wide = options.window, options.window - options.run + 1
    starts = np.flatnonzero(run_valid(first, len(hashes), size))
    if not len(starts):
        empty = np.zeros(0, np.int64)
        return empty.astype(np.uint64), empty.astype(np.uint64), empty, empty, empty
    runs = run_hashes(hashes, options.run, 1)
    low, span = runs, 1
    while 2 * span <= wide:
        low, span = np.minimum(low[:-span], low[span:]), 2 * span
    if span < wide:
        low = np.minimum(low[: len(runs) - wide + 1], low[wide - span :][: len(runs) - wide + 1])
    lowest = low[starts]
    at = np.full(len(starts), -1)
    for off in range(wide - 1, -1, -1):
        at[runs[starts + off] == lowest] = off
    at += starts
    new = np.append(True, (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1))
    begin = np.flatnonzero(new)
    word, s, e = at[begin], starts[begin], starts[np.append(begin[1:], len(starts)) - 1]
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.append(np.uint64(1), np.full(len(hashes), STEP, np.uint64)))
        undo = np.cumprod(np.append(np.uint64(1), np.full(len(hashes), BACK, np.uint64)))
        sums = np.append(np.uint64(0), np.cumsum(hashes * powers[:-1]))
        context = (sums[e + size] - sums[s]) * undo[s]
    shape = ((word - s) << 4 | (word - e)).astype(np.uint64)
    return runs[word], mix64(context ^ mix64(shape + np.uint64(77))), word, s, e


def settle(keys: list[np.ndarray], id_: np.ndarray, tell: np.ndarray, place: np.ndarray,
           last: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows in order, number of the first row of each class, whether the row starts one), by keys, id, tell and place.

    Of rows equal in all of these only one stays, the one with the lowest ``last``.
    """
    order = np.lexsort(([] if last is None else [last]) + [place, tell, id_, *keys[::-1]])
    new, other = (np.append(True, np.zeros(max(len(order) - 1, 0), bool))[: len(order)] for _ in range(2))
    for key in keys:
        sorted_ = key[order]
        new[1:] |= sorted_[1:] != sorted_[:-1]
    other |= new
    for column in (id_, tell, place):
        sorted_ = column[order]
        other[1:] |= sorted_[1:] != sorted_[:-1]
    order, new = order[other], new[other]
    return order, np.flatnonzero(new)[np.cumsum(new) - 1] if len(order) else order, new


def distinct_marks(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Marks (kind, id, tell, place, ref_id, ref_place), of those of one kind and place the one with the smallest reference."""
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    keep = np.append(True, np.any([c[1:] != c[:-1] for c in columns[:4]], axis=0))
    return [c[keep] for c in columns]


def _batch(names: list[str], columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64) if c.dtype == np.uint64 else c) for c in columns], names=names)


def _spread(id_: np.ndarray, tell: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Routes of rows that are settled already, so that a frequent anchor's share no task."""
    return mix64(id_.astype(np.uint64) ^ mix64(tell.view(np.uint64) ^ mix64(place.astype(np.uint64))))


ANCHOR = ["kind", "route", "context", "id", "tell", "place", "ref_id", "ref_place"]
ANCHOR_TYPE = "kind int, route long, context long, id long, tell long, place long, ref_id long, ref_place long"
MARK = ["kind", "id", "tell", "place", "ref_id", "ref_place"]
MARK_TYPE = "kind int, id long, tell long, place long, ref_id long, ref_place long"


def _index(options: SubstringOptions):
    """Anchors of the texts (id, tell, text), settled within the task."""
    def out(parts):
        key, context, id_, tell, place = (np.concatenate(x) for x in zip(*parts, strict=True))
        if not len(key):
            return
        order, first, new = settle([key, context], id_, tell, place)
        key, context, id_, tell, place = key[order], context[order], id_[order], tell[order], place[order]
        heads = np.flatnonzero(new)
        head_new = np.append(True, key[heads][1:] != key[heads][:-1])
        group = np.cumsum(head_new) - 1
        several = np.bincount(group)[group] > 1
        kinds = [(ONE, heads[~several], False), (MANY, heads[several & head_new], False), (CHECK, heads[several], False), (COPY, np.flatnonzero(~new), True)]
        for kind, rows, refer in kinds:
            if len(rows):
                ref = first[rows]
                zero = np.zeros(len(rows), np.int64)
                route = key[rows] if kind < CHECK else _spread(id_[rows], tell[rows], place[rows])
                yield _batch(ANCHOR, [np.full(len(rows), kind, np.int32), route, context[rows], id_[rows], tell[rows], place[rows],
                                      id_[ref] if refer else zero, place[ref] if refer else zero])

    def run(batches) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for part in slices(batches):
            words = words_of(part.column(2))
            hashes = word_hashes(words)
            key, context, word, s, e = anchors(hashes, words.first, options)
            text = np.searchsorted(words.first, word, "right") - 1
            id_, tell = part.column(0).to_numpy()[text], part.column(1).to_numpy()[text]
            place = (word - words.first[text]) << PLACE | (word - s) << 4 | (word - e)
            parts.append((key, context, id_, tell, place))
            held += len(key)
            if held >= options.flush:
                yield from out(parts)
                parts, held = [], 0
        if parts:
            yield from out(parts)
    return run


def _pass_on(held: list, least: int) -> Iterator[pa.RecordBatch]:
    """Empties ``held`` (settled marks) once it has ``least`` rows."""
    if held and sum(len(x[0]) for x in held) >= least:
        yield _batch(MARK, distinct_marks([np.concatenate(x) for x in zip(*held, strict=True)]))
        held.clear()


def _shared(options: SubstringOptions):
    """Marks (kind, id, tell, place, ref_id, ref_place) from all rows of a share of the anchors."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        parts, held = [], []
        for batch in batches:
            kind = batch.column(0).to_numpy()
            done = kind >= CHECK
            if done.any():
                held.append([kind[done], *(batch.column(c).to_numpy()[done] for c in range(3, 8))])
                yield from _pass_on(held, options.flush)
            if not done.all():
                parts.append([batch.column(c).to_numpy()[~done] for c in range(6)])
        yield from _pass_on(held, 1)
        if not parts:
            return
        kind, key, context, id_, tell, place = (np.concatenate(x) for x in zip(*parts, strict=True))
        order, first, new = settle([key, context], id_, tell, place, -kind)
        kind, key, context, id_, tell, place = (x[order] for x in (kind, key, context, id_, tell, place))
        key_new = np.append(True, key[1:] != key[:-1])
        group = np.cumsum(key_new) - 1
        mixed = (np.bincount(group, new) > 1) | (np.bincount(group, kind == MANY) > 0)
        alone = np.bincount(group) == 1
        copy = (kind == ONE) & ~new
        check = (kind == ONE) & new & mixed[group] & ~alone[group]
        for value, rows in ((COPY, np.flatnonzero(copy)), (CHECK, np.flatnonzero(check))):
            if len(rows):
                ref = first[rows]
                yield _batch(MARK, [np.full(len(rows), value, np.int32), id_[rows], tell[rows], place[rows], id_[ref], place[ref]])
    return run


def _ranges(marks, kind: int) -> tuple[np.ndarray, ...]:
    """(window start, ref id, ref start) of the windows of a text's marks of a kind."""
    rows = [m for m in marks or () if m["kind"] == kind]
    place = np.array([m["place"] for m in rows], np.int64)
    ref = np.array([m["ref_id"] for m in rows], np.int64)
    ref_place = np.array([m["ref_place"] for m in rows], np.int64)
    word, before, after = place >> PLACE, place >> 4 & 15, place & 15
    n = before - after + 1
    back = np.repeat(before, n) - (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
    return np.repeat(word, n) - back, np.repeat(ref, n), np.repeat(ref_place >> PLACE, n) - back


WINDOW = ["known", "route", "second", "id", "tell", "place", "ref_id", "ref_place"]
WINDOW_TYPE = "known int, route long, second long, id long, tell long, place long, ref_id long, ref_place long"


def _windows(options: SubstringOptions):
    """Hashes of the windows to look up, of rows (id, tell, text, marks), settled within the task."""
    def out(parts):
        one, two, id_, tell, place = (np.concatenate(x) for x in zip(*parts, strict=True))
        order, first, new = settle([one, two], id_, tell, place)
        one, two, id_, tell, place = (x[order] for x in (one, two, id_, tell, place))
        for known, rows in ((0, np.flatnonzero(new)), (1, np.flatnonzero(~new))):
            if len(rows):
                ref = first[rows]
                route = _spread(id_[rows], tell[rows], place[rows]) if known else one[rows]
                yield _batch(WINDOW, [np.full(len(rows), known, np.int32), route, two[rows], id_[rows], tell[rows], place[rows], id_[ref], place[ref]])

    def run(batches) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for part in slices(batches):
            marks = part.column(3).to_pylist()
            some = [i for i, m in enumerate(marks) if m and any(x["kind"] == CHECK for x in m)]
            if not some:
                continue
            part = part.take(pa.array(some))
            words = words_of(part.column(2))
            hashes = word_hashes(words)
            one, two = run_hashes(hashes, options.window, 2), run_hashes(mix64(hashes), options.window, 3)
            for k, i in enumerate(some):
                start = np.unique(_ranges(marks[i], CHECK)[0])
                at = words.first[k] + start
                id_, tell = part.column(0)[k].as_py(), part.column(1)[k].as_py()
                parts.append((one[at], two[at], np.full(len(at), id_), np.full(len(at), tell), start << PLACE))
                held += len(at)
            if held >= options.flush:
                yield from out(parts)
                parts, held = [], 0
        if parts:
            yield from out(parts)
    return run


def _repeated(options: SubstringOptions):
    """Marks of the windows that have an earlier equal one, from all rows of a share of the windows."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        parts, held = [], []
        for batch in batches:
            known = batch.column(0).to_numpy() == 1
            if known.any():
                held.append([np.full(int(known.sum()), COPY, np.int32), *(batch.column(c).to_numpy()[known] for c in range(3, 8))])
                yield from _pass_on(held, options.flush)
            if not known.all():
                parts.append([batch.column(c).to_numpy()[~known] for c in range(1, 6)])
        yield from _pass_on(held, 1)
        if not parts:
            return
        one, two, id_, tell, place = (np.concatenate(x) for x in zip(*parts, strict=True))
        order, first, new = settle([one, two], id_, tell, place)
        id_, tell, place = id_[order], tell[order], place[order]
        rows = np.flatnonzero(~new)
        if len(rows):
            ref = first[rows]
            yield _batch(MARK, [np.full(len(rows), COPY, np.int32), id_[rows], tell[rows], place[rows], id_[ref], place[ref]])
    return run


def parse(n_words: int, start: np.ndarray, ref: np.ndarray, ref_start: np.ndarray, window: int) -> list[tuple[int, int, int, int]]:
    """Factors (start, words, reference id, reference start) that cover all repeated windows.

    A window that stands there more than once keeps the smallest reference.
    """
    order = np.lexsort((ref_start, ref, start))
    start, ref, ref_start = start[order], ref[order], ref_start[order]
    keep = np.append(True, start[1:] != start[:-1])[: len(start)]
    start, ref, ref_start = start[keep], ref[keep], ref_start[keep]
    on = (start[1:] == start[:-1] + 1) & (ref[1:] == ref[:-1]) & (ref_start[1:] == ref_start[:-1] + 1)
    begin = np.flatnonzero(np.append(True, ~on)[: len(start)])
    last = np.append(begin[1:], len(start))[: len(begin)] - 1
    factors, done = [], 0
    for b, e in zip(begin.tolist(), last.tolist(), strict=True):
        s, stop = max(int(start[b]), done), int(start[e]) + window
        if stop > s:
            factors.append((s, stop - s, int(ref[b]), int(ref_start[b]) + s - int(start[b])))
            done = stop
    return factors


FACTOR = "array<struct<start:long,words:long,ref_id:long,ref_start:long>>"
_FACTOR = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "words", "ref_id", "ref_start")]))


def _finish(options: SubstringOptions):
    """(id, n_words, n_removed, kept, factors) of rows (id, tell, text, marks, more marks)."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            n_words, removed, kept, factors = [], [], [], []
            for text, marks, more in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), part.column(4).to_pylist(), strict=True):
                words = (text or "").encode().split()
                found: list = []
                if marks or more:
                    pairs = [_ranges(marks, COPY), _ranges(more, COPY)]
                    found = parse(len(words), *(np.concatenate(x) for x in zip(*pairs, strict=True)), options.window)
                gone, at, rest = 0, 0, []
                for start, n, _, _ in found:
                    rest += words[at:start]
                    at, gone = start + n, gone + n
                n_words.append(len(words))
                removed.append(gone)
                kept.append(b" ".join(rest + words[at:] if found else words).decode())
                factors.append([dict(zip(("start", "words", "ref_id", "ref_start"), f, strict=True)) for f in found])
            ids = part.column(0)
            ids = pa.compute.if_else(pa.compute.equal(ids, LAST_ID), pa.scalar(None, pa.int64()), ids)
            yield pa.RecordBatch.from_arrays([ids, pa.array(n_words, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string()),
                                              pa.array(factors, _FACTOR)], names=["id", "n_words", "n_removed", "kept", "factors"])
    return run


def remove_repeats(docs: DataFrame, options: SubstringOptions = SubstringOptions(), id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """(id, n_words, n_removed, kept, factors) of every row.

    Words are runs without white space, unchanged. A word goes if a window of ``window``
    words that covers it also starts earlier: in a text with a smaller id or earlier in the
    same text; windows are judged on the input. kept holds the other words, joined by a
    space; factors the removed spans with a place where each stands earlier. A null or empty
    text has no words. Rows of one id and equal text are the same document and give the same
    row each; those of one id and different text come in the order of a hash. A null id
    counts as the largest. Ids are whole numbers; other columns are not read.
    """
    if not 0 <= options.window - options.run < 16:
        raise ValueError("window - run must be under 16")
    spark = docs.sparkSession
    ship_package(spark)
    tell = F.xxhash64("text").alias("tell")
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("id"), F.col(text_col).alias("text")).select("id", tell, "text")
    mark = F.struct("kind", "place", "ref_id", "ref_place")

    def by_text(found: DataFrame, name: str) -> DataFrame:
        return found.groupBy("id", "tell").agg(F.collect_list(mark).alias(name))

    index = rows.mapInArrow(_index(options), ANCHOR_TYPE)
    marks = by_text(index.repartition("route").mapInArrow(_shared(options), MARK_TYPE), "marks")
    # the text's rows are shuffled once: both uses below have the same plan up to here
    marked = rows.join(marks.hint("merge"), ["id", "tell"], "left").select("id", "tell", "text", "marks")
    looked = marked.mapInArrow(_windows(options), WINDOW_TYPE)
    more = by_text(looked.repartition("route").mapInArrow(_repeated(options), MARK_TYPE), "more")
    found = marked.join(more.hint("merge"), ["id", "tell"], "left").select("id", "tell", "text", "marks", "more")
    out = found.mapInArrow(_finish(options), f"id long, n_words long, n_removed long, kept string, factors {FACTOR}")
    return out.withColumnRenamed("id", id_col)


def brute_force(rows: list[tuple[int, str | None]], window: int) -> dict[int, tuple[int, int, str]]:
    """{id: (words, removed, sha256 of the kept words)} of a few documents, for tests."""
    seen: dict[tuple, tuple[int, int]] = {}
    texts = {i: (t or "").encode().split() for i, t in rows}
    for i in sorted(texts):
        for s in range(len(texts[i]) - window + 1):
            seen.setdefault(tuple(texts[i][s : s + window]), (i, s))
    out = {}
    for i, words in texts.items():
        gone = set()
        for s in range(len(words) - window + 1):
            if seen[tuple(words[s : s + window])] != (i, s):
                gone |= set(range(s, s + window))
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        out[i] = (len(words), len(gone), hashlib.sha256(kept).hexdigest())
    return out
