"""Personal data as spans: fixed patterns, and a semi-Markov conditional random field beside them.

The patterns give the base spans. The field looks at regions with digits or address signs,
scores whole candidate segments by features of the entire span, and a dynamic programme over
segments of bounded length chooses boundaries and types of a region together. It is trained
on base spans of a bounded sample of documents and on rewritten forms of those spans.
"""

from __future__ import annotations

import bisect
import itertools
import math
import random
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewarden.llm.decontaminate import pa_type
from tidewarden.llm.text import slices
from tidewarden.session import ship_package

KINDS = ("email", "ip", "card", "phone")
# The base patterns.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
#: The same, found from their signs outwards: what follows an @, and numbers joined by points.
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")

#: Stretches in which a number may stand, and addresses that are spelt out.
NUMBER_REGION = re.compile(r"[+(]{0,2}[0-9](?:[ ().+\-\[\]]{0,3}[0-9])+")
SPELT_AT = re.compile(r"\[at\]|\(at\)|\{at\}| at ")
SPELT_DOMAIN = re.compile(
    r"(?:\[at\]|\(at\)|\{at\}| at ) ?[A-Za-z0-9-]+(?: ?(?:\.|\[dot\]|\(dot\)|\{dot\}| dot ) ?[A-Za-z0-9-]+)+")
TOKEN = re.compile(r"[0-9]+|[A-Za-z]+|.", re.S)
SIGN = re.compile(r"\[at\]|\(at\)|\{at\}|\bat\b")
SPELT_DOT = re.compile(r"\[dot\]|\(dot\)|\{dot\}|\bdot\b")
MOST_DIGITS = 19
#: Numbers that are no personal data, as lessons.
PLAIN_NUMBERS = ("1 2 3 4 5 6 7 8 9 10 11", "2024-01-02 10-22-33", "10.5 20.25 30.125", "1999-2000 2001-2002",
                 "100 200 300 400", "12 (3) 45 (6) 78 90", "0.25 0.5 0.75 1.0 1.25", "1 000 000 000")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _before(text: str, low: int, end: int) -> int:
    """Where the characters of a local part that stand right before ``end`` begin, not below ``low``."""
    found = LOCAL.match(text[low:end][::-1])
    return end - found.end() if found else end


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Spans of :data:`EMAIL`, leftmost and not overlapping, in time linear in the text."""
    low = 0
    at = text.find("@")
    while at >= 0:
        start, domain = _before(text, low, at), DOMAIN.match(text, at)
        low = at + 1  # no local part reaches over an @
        if start < at and domain:
            low = domain.end()
            yield start, low
        at = text.find("@", low)


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Spans of :data:`IP`: of numbers joined by points every four, from the left."""
    for run in DOTTED.finditer(text):
        at = run.start()
        parts = run[0].split(".")
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = at + sum(map(len, four)) + 3
            if all(int(p[-4:]) <= 255 and len(p.lstrip("0")) <= 3 for p in four):
                yield at, end
            at = end + 1


def spelt(text: str) -> Iterator[tuple[int, int]]:
    """Addresses that are spelt out, leftmost and not overlapping."""
    low = 0
    sign = SPELT_AT.search(text)
    while sign:
        end = sign.start()
        if end > low and text[end - 1] == " ":
            end -= 1
        start, domain = _before(text, low, end), SPELT_DOMAIN.match(text, sign.start())
        after = sign.start() + 1
        if start < end and domain:
            low = after = domain.end()
            yield start, low
        sign = SPELT_AT.search(text, after)


class Overlaps:
    """Which stretches meet a set of spans, by their starts and the furthest end so far."""

    def __init__(self, spans: list[tuple[int, int, int]]):
        ordered = sorted((s, e) for _, s, e in spans)
        self.starts = [s for s, _ in ordered]
        self.ends = list(itertools.accumulate((e for _, e in ordered), max))

    def covers(self, start: int, end: int) -> bool:
        k = bisect.bisect_right(self.starts, start)
        return k > 0 and self.ends[k - 1] >= end

    def meets(self, start: int, end: int) -> bool:
        k = bisect.bisect_left(self.starts, end)
        return k > 0 and self.ends[k - 1] > start


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind and start, in code points."""
    found = [(0, *span) for span in emails(text)]
    if DIGIT.search(text):
        found += [(1, *span) for span in addresses(text)]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 13:
                digits = m[0].replace(" ", "").replace("-", "")
                if 13 <= len(digits) <= 19 and luhn(digits):
                    found.append((2, *m.span()))
        if "+" in text:
            found += [(3, *m.span()) for m in PHONE.finditer(text)
                      if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return found


@dataclass(frozen=True)
class FieldOptions:
    """``sample_docs``: documents with base spans that the field is trained on, about, whole ones
    of up to ``sample_chars`` characters (longer ones are not drawn)."""

    sample_docs: int = 600
    sample_chars: int = 20_000
    longest: int = 21
    rounds: int = 4
    rate: float = 0.3
    seed: int = 7


@dataclass
class Field:
    """Weights of the features; an entity's segment has at most ``longest`` tokens."""

    weights: dict[str, float] = field(default_factory=dict)
    longest: int = 21


def regions(text: str) -> list[tuple[int, int]]:
    """Disjoint stretches of a text that the field reads."""
    signs = "at)" in text or "at]" in text or "at}" in text or (" at " in text and " dot " in text)
    found = list(spelt(text)) if signs else []
    if DIGIT.search(text):
        found += [m.span() for m in NUMBER_REGION.finditer(text) if m.end() - m.start() >= 7]
    found.sort()
    out: list[tuple[int, int]] = []
    for s, e in found:
        if out and s < out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _shape(segment: str) -> str:
    return re.sub(r"[A-Za-z]+", "a", re.sub(r"[0-9]+", lambda m: str(min(len(m[0]), 9)), segment))


def segment_features(kind: int, segment: str, before: str, after: str) -> list[str] | None:
    """Features of a whole segment as this kind; None where it can't be one."""
    name = KINDS[kind]
    digits = re.sub(r"[^0-9]", "", segment)
    groups = re.findall(r"[0-9]+", segment)
    if kind == 0:
        if not SIGN.search(segment) or not segment[0].isalnum() or not segment[-1].isalpha():
            return None
        tail = re.split(r"[^A-Za-z]+", segment)[-1]
        dots = len(SPELT_DOT.findall(segment)) + segment.count(".")
        if not dots:
            return None
        signs = "plain" if re.search(r" at ", segment) else "bracket"
        dotted = "spelt" if SPELT_DOT.search(segment) else "point"
        words = len(segment.split())
        return [f"{name}|bias", f"{name}|{signs}|{dotted}", f"{name}|tail{min(len(tail), 5)}",
                f"{name}|dots{min(dots, 4)}", f"{name}|words{min(words, 8)}"]
    if not segment[0] in "+(0123456789" or not segment[-1].isdigit():
        return None
    if before[-1:].isalnum() or after[:1].isalnum():
        return None
    if kind == 1:
        if len(groups) != 4 or len(re.findall(r"\.", segment)) != 3 or any(int(g[:4]) > 255 for g in groups):
            return None
        return [f"{name}|bias", f"{name}|{re.sub('[0-9]+', '0', segment)[:24]}"]
    if kind == 2:
        if not 13 <= len(digits) <= 19 or segment[0] in "+(" or not luhn(digits):
            return None
        separators = "".join(sorted(set(re.sub(r"[0-9]", "", segment))))
        sizes = "-".join(map(str, map(len, groups)))
        return [f"{name}|bias", f"{name}|n{len(digits)}", f"{name}|sep{separators}", f"{name}|sizes{sizes}"]
    if not 9 <= len(digits) <= 15 or segment.count("(") != segment.count(")"):
        return None
    shape = _shape(segment)
    separators = "".join(sorted(set(re.sub(r"[0-9]", "", segment))))
    last = before.rstrip(" ")[-1:]
    left = "none" if not last else "digit" if last.isdigit() else last if last in "+-.()" else "other"
    return [f"{name}|left{left}", f"{name}|least{min(map(len, groups))}",
            f"{name}|bias", f"{name}|n{len(digits)}", f"{name}|shape{shape[-9:]}", f"{name}|head{segment[0] if segment[0] in '+(' else '9'}",
            f"{name}|sep{separators}", f"{name}|groups{min(len(groups), 6)}", f"{name}|head{segment[0] in '+('}groups{min(len(groups), 6)}"]


def lattice(text: str, start: int, end: int, longest: int):
    """(token edges, segments (i, j, kind, features)) of a region; kind 4 is outside, one token."""
    tokens = [m.span() for m in TOKEN.finditer(text, start, end)]
    segments = []
    for i, (s, e) in enumerate(tokens):
        token = text[s:e]
        group = "digits" if token.isdigit() else "word" if token.isalpha() else "sign"
        segments.append((i, i + 1, 4, [f"out|{group}"]))
        if group == "sign" and token not in "+(":
            continue
        for j in range(i + 1, min(i + longest, len(tokens)) + 1):
            last = text[tokens[j - 1][0] : tokens[j - 1][1]]
            if not last.isalnum():
                continue
            segment = text[s : tokens[j - 1][1]]
            n = sum(c.isdigit() for c in segment)
            if n > MOST_DIGITS and group != "word":
                break
            for kind in range(4) if n >= 4 or group == "word" or SIGN.search(segment) else ():
                found = segment_features(kind, segment, text[max(start, s - 3) : s], text[tokens[j - 1][1] : tokens[j - 1][1] + 1])
                if found:
                    segments.append((i, j, kind, found))
    return tokens, segments


def _score(weights: dict[str, float], features: list[str]) -> float:
    return sum(weights.get(f, 0.0) for f in features)


def decode(model: Field, text: str, start: int, end: int) -> list[tuple[int, int, int]]:
    """The best segmentation of a region: its (kind, start, end)."""
    tokens, segments = lattice(text, start, end, model.longest)
    if all(s[2] == 4 for s in segments):
        return []
    best = [(0.0, None)] + [(-math.inf, None)] * len(tokens)
    by_start = defaultdict(list)
    for segment in segments:
        by_start[segment[0]].append(segment)
    for i in range(len(tokens)):
        for segment in by_start[i]:
            value = best[i][0] + _score(model.weights, segment[3])
            if value > best[segment[1]][0]:
                best[segment[1]] = (value, segment)
    found, at = [], len(tokens)
    while at:
        segment = best[at][1]
        if segment[2] < 4:
            found.append((segment[2], tokens[segment[0]][0], tokens[segment[1] - 1][1]))
        at = segment[0]
    return found[::-1]


def _gradient(weights: dict[str, float], n: int, segments, gold: set) -> dict[str, float]:
    """Observed less expected feature counts of a region, by forward and backward sums."""
    scores = [_score(weights, s[3]) for s in segments]
    forward, backward = [-math.inf] * (n + 1), [-math.inf] * (n + 1)
    forward[0] = backward[n] = 0.0

    def add(a: float, b: float) -> float:
        top = max(a, b)
        return top if top == -math.inf else top + math.log(math.exp(a - top) + math.exp(b - top))

    order = sorted(range(len(segments)), key=lambda k: segments[k][0])
    for k in order:
        i, j = segments[k][:2]
        forward[j] = add(forward[j], forward[i] + scores[k])
    for k in reversed(order):
        i, j = segments[k][:2]
        backward[i] = add(backward[i], backward[j] + scores[k])
    out: dict[str, float] = defaultdict(float)
    for k, (i, j, kind, features) in enumerate(segments):
        value = ((i, j, kind) in gold) - math.exp(min(0.0, forward[i] + scores[k] + backward[j] - forward[n]))
        for f in features:
            out[f] += value
    return out


def _rewritten(kind: int, span: str, draw: random.Random) -> list[tuple[str, bool]]:
    """Other spellings of a base span, and broken ones that are no personal data."""
    digits = re.sub(r"[^0-9]", "", span)
    if kind == 0:
        name, _, domain = span.partition("@")
        spelt = domain.replace(".", " dot ")
        return [(f"{name} at {spelt}", True), (f"{name}[at]{domain}", True), (f"{name} (at) {domain}", True),
                (f"{name} [at] {domain.replace('.', ' [dot] ')}", True), (f"{name}(at){domain.replace('.', '(dot)')}", True)]
    if kind == 1:
        parts = span.split(".")
        return [("[.]".join(parts), True), (" . ".join(parts), True),
                (".".join([str(256 + draw.randrange(600)), *parts[1:]]), False), (".".join(parts[:3]), False)]
    if kind == 2:
        quads = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        broken = digits[:-1] + str((int(digits[-1]) + draw.randrange(1, 9)) % 10)
        return [(".".join(quads), True), ("  ".join(quads), True), (" - ".join(quads), True), (broken, False),
                (" ".join(broken[i : i + 4] for i in range(0, len(broken), 4)), False), (digits[:11], False)]
    local = digits[-10:].rjust(10, "2")
    a, b, c = local[:3], local[3:6], local[6:]
    return [(f"({a}) {b}-{c}", True), (f"{a}-{b}-{c}", True), (f"1-{a}-{b}-{c}", True), (f"1 ({a}) {b}-{c}", True),
            (f"{a}.{b}.{c}", True), (f"001 {a} {b} {c}", True), (digits, False), (f"{digits[:5]} {digits[5:]}", False),
            (f"{digits[:4]}-{digits[4:6]}-{digits[6:8]} {digits[8:]}", False)]


def train(docs: DataFrame, options: FieldOptions = FieldOptions(), id_col: str = "doc_id",
          text_col: str = "text") -> Field:
    """A field trained on documents with digits or address signs: about ``sample_docs`` of
    them, drawn by a hash of the id, of repeated ids one row. Null ids or texts teach nothing;
    without such documents the field has no weights and adds no spans."""
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    seen = rows.where("id is not null").where(F.length("text") <= options.sample_chars).where(F.col("text").rlike("@|[0-9]{3}"))
    share = options.sample_docs / max(seen.count(), 1)
    drawn = seen.where(F.pmod(F.xxhash64("id", F.lit(6)), F.lit(1_000_000)) < share * 1e6)
    sample = drawn.groupBy("id").agg(F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text"))
    draw = random.Random(options.seed)
    lessons: dict[str, tuple] = {}

    def lesson(text: str, spans: list[tuple[int, int, int]]) -> None:
        for s, e in regions(text):
            inside = [x for x in spans if s <= x[1] and x[2] <= e]
            tokens, segments = lattice(text, s, e, options.longest)
            at = {span[0]: k for k, span in enumerate(tokens)}
            ends = {span[1]: k + 1 for k, span in enumerate(tokens)}
            gold, covered = set(), set()
            for kind, x, y in inside:
                if x in at and y in ends and not covered & set(range(at[x], ends[y])):
                    gold.add((at[x], ends[y], kind))
                    covered |= set(range(at[x], ends[y]))
            gold |= {(k, k + 1, 4) for k in range(len(tokens)) if k not in covered}
            if any(x[2] < 4 for x in segments) and len(tokens) <= 200:
                key = _shape(text[s:e]) + str(sorted(gold))
                lessons.setdefault(key, (len(tokens), segments, gold))

    for row in sorted(sample.collect()):  # about sample_docs texts of bounded length
        text = row["text"]
        spans = base_spans(text)
        lesson(text, spans)
        for kind, s, e in spans:
            left, right = text[max(0, s - 20) : s], text[e : e + 20]
            if DIGIT.search(left[-3:] + right[:3]) or "@" in left + right:
                continue
            for other, real in _rewritten(kind, text[s:e], draw):
                lesson(left + other + right, [(kind, len(left), len(left) + len(other))] if real else [])
    if lessons:
        for numbers in PLAIN_NUMBERS:
            lesson(f"see {numbers} there", [])
    weights: dict[str, float] = {}
    seen_squares: dict[str, float] = defaultdict(float)
    order = sorted(lessons)
    for _ in range(options.rounds):
        draw.shuffle(order)
        for key in order:
            for f, g in _gradient(weights, *lessons[key]).items():
                g -= 0.001 * weights.get(f, 0.0)
                if g:
                    seen_squares[f] += g * g
                    weights[f] = weights.get(f, 0.0) + options.rate * g / math.sqrt(seen_squares[f] + 1e-6)
    return Field(weights, options.longest)


def find_spans(text: str | None, model: Field) -> tuple[list, list]:
    """(base spans, added spans): added ones overlap no base span."""
    if not text:
        return [], []
    base = base_spans(text)
    added, known = [], Overlaps(base)
    for s, e in regions(text):
        if known.covers(s, e):
            continue
        for kind, x, y in decode(model, text, s, e):
            if not known.meets(x, y):
                added.append((kind, x, y))
    return base, added


SPAN = "array<struct<kind:string,start:int,end:int>>"
_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def personal_data(docs: DataFrame, model: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, added): spans of personal data in each row's whole text, in code points.

    base holds the spans of the fixed patterns, by kind and start; added those of the field.
    A null or empty text has none. One row per input row, repeated and null ids included;
    other columns are not read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)  # a few thousand weights
    kind_of = docs.schema[id_col].dataType.simpleString()
    as_rows = lambda spans: [{"kind": KINDS[k], "start": s, "end": e} for k, s, e in sorted(spans)]

    def run(batches) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = [find_spans(t, shared.value) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([as_rows(b) for b, _ in found], _SPAN),
                 pa.array([as_rows(a) for _, a in found], _SPAN)], names=[id_col, "base", "added"])

    rows = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"`{id_col}` {kind_of}, base {SPAN}, added {SPAN}")


def redact(docs: DataFrame, model: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with every span replaced by ``[KIND]``; all other columns stay as they are.

    A null text stays null. Overlapping spans are replaced as one, under the first one's kind.
    """
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def clean(text: str | None) -> str | None:
        base, added = find_spans(text, shared.value)
        if not base and not added:
            return text
        out, at = [], 0
        for kind, s, e in sorted(base + added, key=lambda x: (x[1], -x[2])):
            if s >= at:
                out += [text[at:s], f"[{KINDS[kind].upper()}]"]
            at = max(at, e)
        return "".join(out) + text[at:]

    def run(batches) -> Iterator[pa.RecordBatch]:
        for part in batches:
            texts = pa.array([clean(t) for t in part.column(place).to_pylist()], part.schema.field(place).type)
            columns = part.columns
            columns[place] = texts
            yield pa.RecordBatch.from_arrays(columns, schema=part.schema)

    return docs.mapInArrow(run, docs.schema)


__all__ = ["KINDS", "Field", "FieldOptions", "personal_data", "redact", "train", "pa_type"]
