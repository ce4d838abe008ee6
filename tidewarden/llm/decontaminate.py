"""Benchmark decontamination: q-gram lemma filtering and banded alignment.

If a text holds a window of ``m`` bytes of a benchmark item, begun anywhere in the item, with at
most k edits, both share at least ``m + 1 - q * (k + 1)`` q-grams whose diagonals (position in
the text less position in the item) lie within k of each other. Shared q-grams of all places of
an item are counted in overlapping bands of diagonals. A phrase that many items and documents
share reaches that bound alone, so windows that do are put to the lemma once more, with the
window cut into pieces of four bytes: each edit spoils one piece at most, so all but k stand in
the band. What holds both is verified by an alignment inside the band. So every passage of ``window`` bytes is
found at any offset. A passage gives a row for each window of the ``stride`` steps that it
holds, or one for its best window if it holds none of them.

Items under ``least`` bytes are searched for whole: of k + 1 pieces one has no edit.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewarden.llm.text import _BREAK, _LOWER, slices, utf8
from tidewarden.session import ship_package


@dataclass(frozen=True)
class LeakOptions:
    """``window``: bytes of an item that count as a passage, or the whole of a shorter item; one
    edit is allowed for every ``bytes_per_edit``. ``stride``: steps of the windows that give rows
    of their own. ``block_bytes``: benchmark text that one pass holds in memory."""

    window: int = 120
    stride: int = 60
    q: int = 10
    bytes_per_edit: int = 15
    least: int = 30
    block_bytes: int = 16 << 20


FILTER_BITS = 22
#: Bytes of the disjoint pieces of a window; shared q-grams that are sorted at once.
PIECE, POSTINGS = 4, 1 << 22


def normalise(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased A-Z, white space runs as one space: (bytes, offsets, original places)."""
    low = _LOWER[data]
    gap = _BREAK[data]
    low[gap] = 32
    keep = np.ones(len(low), bool)
    keep[1:] = ~(gap[1:] & gap[:-1])
    edges = offsets[:-1]
    keep[edges[edges < len(low)]] = True
    places = np.flatnonzero(keep)
    return low[places], np.searchsorted(places, offsets), places


def _grams(data: np.ndarray, q: int) -> np.ndarray:
    """64-bit codes of the q bytes from every place (8 <= q <= 16)."""
    n = len(data) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    loads = np.ndarray((len(data) - 7,), "<u8", np.ascontiguousarray(data), 0, (1,))
    code = loads[:n] * np.uint64(0x9FB21C651E98DF25)
    code ^= loads[q - 8 : q - 8 + n] * np.uint64(0xC2B2AE3D27D4EB4F)
    return code ^ (code >> np.uint64(29))


@dataclass(frozen=True)
class LeakIndex:
    items: list
    texts: list[bytes]  # normalised
    window: np.ndarray  # bytes of an item's windows: all of a short item
    edits: np.ndarray
    bound: np.ndarray
    codes: np.ndarray  # sorted q-gram codes of all places of the longer items, repeated
    item_of: np.ndarray
    place: np.ndarray
    seen: np.ndarray
    whole: np.ndarray  # bytes of all items, and where each begins
    begins: np.ndarray
    pieces: dict  # bytes of a piece: its sorted codes, the short items and the places in them


def build_index(items: list, texts: list[str], options: LeakOptions) -> LeakIndex:
    data = []
    for text in texts:
        raw = np.frombuffer((text or "").encode(), np.uint8)
        data.append(normalise(raw, np.array([0, len(raw)]))[0].tobytes().strip(b" "))
    size = np.array([len(d) for d in data], np.int64)
    m = np.minimum(size, options.window)
    edits = m // options.bytes_per_edit
    grams = [_grams(np.frombuffer(d, np.uint8), options.q) if len(d) >= options.least else np.zeros(0, np.uint64) for d in data]
    item_of = np.repeat(np.arange(len(data)), [len(g) for g in grams])
    place = np.concatenate([np.arange(len(g)) for g in grams] or [np.zeros(0, int)])
    code = np.concatenate(grams or [np.zeros(0, np.uint64)])
    order = np.argsort(code, kind="stable")
    seen = np.zeros(1 << FILTER_BITS, bool)
    seen[code >> np.uint64(64 - FILTER_BITS)] = True
    short: dict[int, list] = {}
    for i in np.flatnonzero((size > 0) & (size < options.least)).tolist():  # of k + 1 pieces one has no edit
        cuts = np.linspace(0, size[i], edits[i] + 2).astype(int)
        for at, end in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            piece = data[i][at : min(end, at + 8)]
            short.setdefault(len(piece), []).append((int.from_bytes(piece, "little"), i, at))
    pieces = {}
    for n, found in short.items():
        found.sort()
        pieces[n] = (np.array([f[0] for f in found], np.uint64), np.array([f[1] for f in found]), np.array([f[2] for f in found]))
    return LeakIndex(list(items), data, m, edits, m + 1 - options.q * (edits + 1), code[order], item_of[order], place[order], seen,
                     np.frombuffer(b"".join(data), np.uint8), np.cumsum(np.append(0, size)), pieces)


def align(window: bytes, region: bytes, low: int, width: int, budget: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the best place of ``window`` in ``region``, or None above the budget.

    Only diagonals low to low + width - 1 are visited: row i, column j is at j - i.
    """
    w, r = np.frombuffer(window, np.uint8), np.frombuffer(region, np.uint8)
    steps = np.arange(width)
    far = 1 << 20
    column = steps + low
    cost = np.where((column >= 0) & (column <= len(r)), 0, far)
    origin = column.copy()
    for i in range(1, len(w) + 1):
        column = steps + low + i
        inside = (column >= 1) & (column <= len(r))
        same = np.ones(width, bool)
        same[inside] = r[column[inside] - 1] != w[i - 1]
        new, came = np.where(inside, cost + same, far), origin.copy()
        up = np.append(cost[1:] + 1, far)
        better = up < new
        new[better], came[better] = up[better], np.append(origin[1:], 0)[better]
        new[(column < 0) | (column > len(r))] = far
        run = new - steps  # moves along the text: each costs one
        lowest = np.minimum.accumulate(run)
        source = np.maximum.accumulate(np.where(run == lowest, steps, 0))
        cost, origin = lowest + steps, came[source]
        cost[(column < 0) | (column > len(r))] = far
        if cost.min() > budget:
            return None
    end = int(cost.argmin())
    return int(cost[end]), int(origin[end]), int(end + low + len(w))


def fewest_edits(windows: np.ndarray, starts: np.ndarray, region: np.ndarray, low: int, width: int, budget: int) -> np.ndarray:
    """Edits of the best place of every window (one a row, beginning at ``starts`` of its item), above the budget if there is none.

    Diagonals are places in the region less places in the item: low to low + width - 1.
    """
    steps, far = np.arange(width), 1 << 20
    column = starts[:, None] + low + steps
    cost = np.where((column >= 0) & (column <= len(region)), 0, far)
    for i in range(windows.shape[1]):
        column = column + 1
        inside = (column >= 1) & (column <= len(region))
        same = region[np.clip(column - 1, 0, len(region) - 1)] != windows[:, i, None]
        new = np.where(inside, cost + same, far)
        new[:, :-1] = np.minimum(new[:, :-1], cost[:, 1:] + 1)
        new[(column < 0) | (column > len(region))] = far
        cost = np.minimum.accumulate(new - steps, axis=1) + steps
        cost[(column < 0) | (column > len(region))] = far
        if cost.min() > budget:
            break
    return cost.min(axis=1)


def find_leaks(column, index: LeakIndex, options: LeakOptions):
    """Rows (text number, item, place in the item, start byte, end byte, edits) for the texts of a slice."""
    raw, offsets = utf8(column)
    data, at, places = normalise(raw, offsets)
    if not len(data):
        return
    originals = lambda t, s, e: (int(places[s]) - int(offsets[t]), int(places[e - 1]) + 1 - int(offsets[t]))
    for t, item, s, e, edits in _short_leaks(data, at, index):
        yield (t, item, 0, *originals(t, s, e), edits)
    codes = _grams(data, options.q)
    hits = np.flatnonzero(index.seen[codes >> np.uint64(64 - FILTER_BITS)])
    if not len(hits):
        return
    code = codes[hits]
    lo, hi = np.searchsorted(index.codes, code, "left"), np.searchsorted(index.codes, code, "right")
    text = np.searchsorted(at, hits, side="right") - 1
    good = (hi > lo) & (hits + options.q <= at[text + 1])
    hits, lo, n, text = hits[good], lo[good], (hi - lo)[good], text[good]
    if not len(hits):
        return
    part = np.cumsum(n) // POSTINGS
    cuts = np.flatnonzero((part[1:] != part[:-1]) & (text[1:] != text[:-1])) + 1  # between texts
    given: dict[tuple, list] = {}
    for cut in np.split(np.arange(len(hits)), cuts):
        yield from _long_leaks(data, at, originals, hits[cut], text[cut], lo[cut], n[cut], index, options, given)


def _loads(data: np.ndarray) -> np.ndarray:
    """The PIECE bytes from every place as a number."""
    return np.ascontiguousarray(np.ndarray((max(len(data) - PIECE + 1, 0),), "<u4", np.ascontiguousarray(data), 0, (1,)))


def candidates(data: np.ndarray, at: np.ndarray, hits: np.ndarray, text: np.ndarray, lo: np.ndarray, n: np.ndarray,
               index: LeakIndex, options: LeakOptions) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """(text, item, cell, starts of windows): what both counts leave of the shared q-grams, by text, item and cell.

    A cell is k + 1 diagonals; a band is a cell and the next.
    """
    posting = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
    text, hits = np.repeat(text, n), np.repeat(hits, n)
    item, spot = index.item_of[posting], index.place[posting]
    cell = (hits - at[text] - spot) // (index.edits[item] + 1)
    first_text, lowest = int(text[0]), int(cell.min())
    sizes = len(index.items), int(cell.max()) - lowest + 1, int(spot.max()) + 1
    if (int(text[-1]) - first_text + 1) * sizes[0] * sizes[1] * sizes[2] < 1 << 62:  # one number a row is sorted fastest
        key = np.sort((((text - first_text) * sizes[0] + item) * sizes[1] + cell - lowest) * sizes[2] + spot)
        key, spot = np.divmod(key, sizes[2])
        band, cell = np.divmod(key, sizes[1])
        text, item = np.divmod(band, sizes[0])
        text, cell = text + first_text, cell + lowest
    else:
        order = np.lexsort((spot, cell, item, text))
        text, item, cell, spot = text[order], item[order], cell[order], spot[order]
    first = np.flatnonzero(np.append(True, (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (cell[1:] != cell[:-1])))
    after = np.zeros(len(first), bool)
    a, b = first[:-1], first[1:]
    after[:-1] = (text[a] == text[b]) & (item[a] == item[b]) & (cell[a] + 1 == cell[b])
    count = np.diff(np.append(first, len(text)))
    reach = count + np.where(after, np.append(count[1:], 0), 0)
    some = reach >= index.bound[item[first]]
    first, reach = first[some], reach[some]
    if not len(first):
        return
    text, item, cell = text[first], item[first], cell[first]
    # windows with enough shared q-grams: from the last of ``bound`` consecutive ones back to the first
    group = np.repeat(np.arange(len(first)), reach)
    mine = spot[np.repeat(first - (np.cumsum(reach) - reach), reach) + np.arange(reach.sum())]
    mine = mine[np.lexsort((mine, group))]
    other = np.arange(len(mine)) + (index.bound[item] - 1)[group]
    inside = other < np.cumsum(reach)[group]
    mine, last, group = mine[inside], mine[other[inside]], group[inside]
    size = np.diff(index.begins)[item]
    begin = np.maximum(last - (index.window[item] - options.q)[group], 0)
    end = np.minimum(mine, (size - index.window[item])[group])
    inside = begin <= end
    begin, end, group = begin[inside], end[inside], group[inside]
    follows = np.append(False, group[1:] == group[:-1])[: len(group)]
    begin = np.maximum(begin, np.where(follows, np.append(0, end[:-1])[: len(end)] + 1, 0))
    length = np.maximum(end - begin + 1, 0)
    group = np.repeat(group, length)
    start = np.repeat(begin - (np.cumsum(length) - length), length) + np.arange(length.sum())
    if not len(start):
        return
    kept = np.zeros(len(start), bool)
    pieces = _Pieces(_loads(index.whole), _loads(data), index, at, text, item, cell)
    many, size = np.bincount(group)[group] > 8, index.window[item[group]]
    for m in np.unique(size).tolist():
        for rows, stand in ((np.flatnonzero((size == m) & ~many), pieces.one_by_one), (np.flatnonzero((size == m) & many), pieces.at_once)):
            for low in range(0, len(rows), 1 << 16):
                part = rows[low : low + (1 << 16)]
                kept[part] = stand(group[part], start[part], m)
    group, start = group[kept], start[kept]
    heads = np.flatnonzero(np.append(True, group[1:] != group[:-1])[: len(group)])
    for g, starts in zip(group[heads].tolist(), np.split(start, heads[1:]), strict=True) if len(heads) else ():
        yield int(text[g]), int(item[g]), int(cell[g]), starts


class _Pieces:
    """Which windows have all but k of their disjoint pieces on diagonals from the cell before theirs to the cell after."""

    def __init__(self, source: np.ndarray, target: np.ndarray, index: LeakIndex, at: np.ndarray, text: np.ndarray, item: np.ndarray, cell: np.ndarray):
        self.source, self.target, self.edits = source, target, index.edits[item]
        self.here, self.begin, self.stop = index.begins[item], at[text], at[text + 1] - PIECE
        self.there = self.begin + (cell - 1) * (self.edits + 1)

    def stand(self, group: np.ndarray, spot: np.ndarray, k: int) -> np.ndarray:
        """Whether the pieces at these places of the groups' items stand on any of the diagonals."""
        out = np.zeros(len(group), bool)
        for low in range(0, len(group), 1 << 16):
            g, p = group[low : low + (1 << 16)], spot[low : low + (1 << 16)]
            place = (self.there[g] + p)[:, None] + np.arange(3 * (k + 1))
            same = self.target[np.clip(place, 0, len(self.target) - 1)] == self.source[self.here[g] + p][:, None]
            same &= (place >= self.begin[g][:, None]) & (place <= self.stop[g][:, None])
            out[low : low + (1 << 16)] = same.any(axis=1)
        return out

    def one_by_one(self, group: np.ndarray, start: np.ndarray, m: int) -> np.ndarray:
        """For groups of few windows: piece by piece, until more than k are missing."""
        k, missed, alive = int(self.edits[group[0]]), np.zeros(len(start), np.int64), np.arange(len(start))
        for j in range(0, m - PIECE + 1, PIECE):
            missed[alive] += ~self.stand(group[alive], start[alive] + j, k)
            if j % (4 * PIECE) == 0:
                alive = alive[missed[alive] <= k]
        return missed <= k

    def at_once(self, group: np.ndarray, start: np.ndarray, m: int) -> np.ndarray:
        """For groups of many windows, which have most pieces in common: each place once."""
        k, steps = int(self.edits[group[0]]), np.arange(0, m - PIECE + 1, PIECE)
        width = int(start.max()) + m
        places, which = np.unique((group * width + start)[:, None] + steps, return_inverse=True)
        found = self.stand(places // width, places % width, k)
        return (~found[which.reshape(len(group), len(steps))]).sum(axis=1) <= k


def _long_leaks(data: np.ndarray, at: np.ndarray, originals, hits: np.ndarray, text: np.ndarray, lo: np.ndarray, n: np.ndarray,
                index: LeakIndex, options: LeakOptions, given: dict[tuple, list]):
    """Rows of :func:`find_leaks` from the shared q-grams of some texts."""
    for t, i, cell, starts in candidates(data, at, hits, text, lo, n, index, options):
        m, k, whole = int(index.window[i]), int(index.edits[i]), index.texts[i]
        lowest, width = cell * (k + 1) - k, 4 * (k + 1)
        before = given.setdefault((t, i), [])  # (place in the item, start in the texts) of the rows given
        begin, stop = int(at[t]), int(at[t + 1])
        last = len(whole) - m

        def look(w: int):
            """The window at ``w`` of the item in the band: (edits, start, end) in the texts, or None."""
            left = max(0, lowest + w)
            region = data[begin + left : min(stop, begin + lowest + w + width + m)].tobytes()
            window = whole[w : w + m]
            exact = region.find(window)
            found = (0, exact, exact + m) if exact >= 0 else align(window, region, lowest + w - left, width, k)
            return None if found is None or found[0] > k else (found[0], begin + left + found[1], begin + left + found[2])

        def new(w: int, s: int) -> bool:
            return not any(w == v and abs(s - r) <= k + 1 for v, r in before)

        for w in starts[(starts % options.stride == 0) | (starts == last)].tolist():
            found = look(w)
            if found is not None and new(w, found[1]):  # else the neighbouring band has the same place
                before.append((w, found[1]))
                yield (t, i, w, *originals(t, found[1], found[2]), found[0])
        # passages that hold no window of the steps: the best of all windows
        near = lambda w: any(abs(w - v) < options.stride and abs((r - v) - (begin + lowest + 2 * k)) <= 4 * (k + 1) for v, r in before)
        starts = np.array([w for w in starts.tolist() if not near(w)], np.int64)
        source = np.frombuffer(whole, np.uint8)
        for part in np.split(starts, np.arange(256, len(starts), 256)):
            if not len(part):
                continue
            left = max(0, lowest + int(part[0]))
            region = data[begin + left : min(stop, begin + lowest + int(part[-1]) + width + m)]
            if not len(region):
                continue
            edits = fewest_edits(source[part[:, None] + np.arange(m)], part, region, lowest - left, width, k)
            for w in part[np.argsort(edits, kind="stable")][: int((edits <= k).sum())].tolist():
                if near(w):
                    continue
                found = look(w)
                if found is not None:
                    before.append((w, found[1]))
                    yield (t, i, w, *originals(t, found[1], found[2]), found[0])


WORD = np.zeros(256, bool)
WORD[[*b"abcdefghijklmnopqrstuvwxyz0123456789", *range(128, 256)]] = True


def _short_leaks(data: np.ndarray, at: np.ndarray, index: LeakIndex):
    """Places (text, item, start, end, edits) of whole items under ``least`` bytes that stand between words."""
    if not index.pieces:
        return
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    loads = np.ndarray((len(data),), "<u8", padded, 0, (1,))
    given = set()
    for n, (codes, items, spots) in index.pieces.items():
        mine = loads & np.uint64((1 << 8 * n) - 1)
        lo, hi = np.searchsorted(codes, mine, "left"), np.searchsorted(codes, mine, "right")
        for hit in np.flatnonzero(hi > lo).tolist():
            t = int(np.searchsorted(at, hit, side="right")) - 1
            begin, stop = int(at[t]), int(at[t + 1])
            for p in range(int(lo[hit]), int(hi[hit])):
                i, guess = int(items[p]), hit - int(spots[p])
                m, k, whole = int(index.window[i]), int(index.edits[i]), index.texts[i]
                left = max(begin, guess - k)
                region = data[left : min(stop, guess + m + k)].tobytes()
                exact = region.find(whole)
                found = (0, exact, exact + m) if exact >= 0 else align(whole, region, guess - k - left, 2 * k + 1, k) if k else None
                if found is None or found[0] > k:
                    continue
                s, e = left + found[1], left + found[2]
                inside = s > begin and WORD[data[s - 1]] and WORD[data[s]] or e < stop and WORD[data[e]] and WORD[data[e - 1]]
                if inside or any((t, i, s + d) in given for d in range(-k - 1, k + 2)):
                    continue
                given.add((t, i, s))
                yield t, i, s, e, found[0]


def leaks(docs: DataFrame, benchmark: DataFrame, options: LeakOptions = LeakOptions(),
          id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text") -> DataFrame:
    """Rows (id, item, item_start, start, end, edits): windows of benchmark items in documents.

    start and end are code points of the document's text; item_start is the window's place in
    the item. Letter case of A-Z and the amount of white space do not count; edits are bytes.
    Whole texts are searched. A null or empty text has no rows; null and empty items
    are never found, those under ``least`` bytes only whole and not inside a word; an empty benchmark gives no rows. Repeated documents and
    items each get their own rows; other columns are not read. A benchmark over
    ``block_bytes`` is searched for in several passes, so memory does not grow with it.
    """
    spark = docs.sparkSession
    ship_package(spark)
    kinds = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
    names = (id_col, "item" if item_col == id_col else item_col)
    schema = f"`{names[0]}` {kinds[0]}, `{names[1]}` {kinds[1]}, item_start int, start int, end int, edits int"
    rows = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    id_type, item_type = (pa_type(docs, id_col), pa_type(benchmark, item_col))

    def one(shared) -> DataFrame:
        def run(batches) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for part in slices(batches):
                ids, texts = part.column(0), part.column(1)
                out = [[] for _ in names + ("item_start", "start", "end", "edits")]
                for t, i, w, start, end, edits in find_leaks(texts, index, options):
                    raw = np.frombuffer(texts[t].as_py().encode(), np.uint8)
                    leads = (raw & 0xC0) != 0x80  # first bytes of code points
                    first = int(leads[:start].sum()) - (not leads[start])
                    values = (ids[t].as_py(), index.items[i], w, first,
                              int(leads[:end].sum()), edits)
                    for column, value in zip(out, values, strict=True):
                        column.append(value)
                types = [id_type, item_type] + [pa.int32()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)],
                                                 names=[*names, "item_start", "start", "end", "edits"])

        return rows.mapInArrow(run, schema)

    found = [one(shared) for shared in indexes(benchmark, options, item_col, item_text_col)]
    return functools.reduce(DataFrame.union, found)


def indexes(benchmark: DataFrame, options: LeakOptions, item_col: str, item_text_col: str) -> list:
    """Broadcast indexes of the benchmark's items, each of about ``block_bytes`` of text."""
    parts = benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text"))
    size = parts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = -(-size // options.block_bytes) or 1
    out = []
    for block in range(passes):
        mine = parts.where(F.pmod(F.xxhash64("text"), F.lit(passes)) == block).collect()
        index = build_index([r["item"] for r in mine], [r["text"] for r in mine], options)
        out.append(benchmark.sparkSession.sparkContext.broadcast(index))
    return out


def drop_leaked(docs: DataFrame, benchmark: DataFrame, options: LeakOptions = LeakOptions(), text_col: str = "text",
                item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows whose text holds no window of a benchmark item, with all their columns."""
    ship_package(docs.sparkSession)
    place = docs.columns.index(text_col)

    def without(shared):
        def run(batches) -> Iterator[pa.RecordBatch]:
            for part in slices(batches, text_col):
                keep = np.ones(len(part), bool)
                for found in find_leaks(part.column(place), shared.value, options):
                    keep[found[0]] = False
                yield part.filter(pa.array(keep))
        return run

    for shared in indexes(benchmark, options, item_col, item_text_col):
        docs = docs.mapInArrow(without(shared), docs.schema)
    return docs


def pa_type(df: DataFrame, column: str) -> pa.DataType:
    """The Arrow type of an id column: text or a whole number."""
    kind = df.schema[column].dataType.simpleString()
    return {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "string": pa.string()}[kind]
