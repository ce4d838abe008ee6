"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

Each word enters as an embedding of its hash beside the mean embedding of its byte trigrams.
The network reads windows of consecutive words; windows overlap by half and cover the whole
text. A document's score is that of its most toxic window. Labels belong to documents, so
training picks the most suspicious window of every toxic document, fits, and picks again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewarden.llm.text import slices, text_of, word_hashes, words_of
from tidewarden.session import ship_package

WORD_BUCKETS, GRAM_BUCKETS = 1 << 13, 1 << 13
OPEN, CLOSE = 1, 2  # bytes that stand for a word's edges
SLICE = 2 << 20


@dataclass(frozen=True)
class ToxicityOptions:
    """``sample_toxic``, ``sample_clean``: about so many labelled documents are learned from,
    whole ones of up to ``sample_chars`` characters (longer ones teach nothing)."""

    sample_toxic: int = 700
    sample_clean: int = 2800
    sample_chars: int = 20_000
    window: int = 16
    stride: int = 8
    hidden: int = 8
    word_size: int = 8
    gram_size: int = 12
    rounds: int = 3
    epochs: int = 3
    batch: int = 256
    drop: float = 0.2
    rate: float = 0.01
    seed: int = 3


Weights = dict[str, np.ndarray]


def inputs_of(column):
    """(unique words' hashes, trigram buckets, first trigram of each, word of each place, first word of each text)."""
    words = words_of(column, lower=True)
    hashes = word_hashes(words)
    unique, at, word = np.unique(hashes, return_index=True, return_inverse=True)
    start, length = words.start[at], words.end[at] - words.start[at]
    first = np.concatenate([[0], np.cumsum(length + 2)])
    buffer = np.empty(int(first[-1]), np.uint32)
    buffer[first[:-1]] = OPEN
    buffer[first[1:] - 1] = CLOSE
    place = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    buffer[np.repeat(first[:-1] + 1, length) + place] = words.data[np.repeat(start, length) + place]
    code = buffer[:-2] | (buffer[1:-1] << np.uint32(8)) | (buffer[2:] << np.uint32(16)) if len(buffer) else buffer
    code = (code * np.uint32(2654435761)) >> np.uint32(32 - 13)
    keep = np.ones(len(buffer), bool)  # no trigram starts on a word's last byte or its edge
    keep[first[1:] - 1] = keep[first[1:] - 2] = False
    grams = code[keep[: len(code)]].astype(np.int64)
    return unique, grams, np.concatenate([[0], np.cumsum(length)]).astype(np.int64), word, words.first


def windows_of(first: np.ndarray, word: np.ndarray, n_unique: int, options: ToxicityOptions):
    """(window x place word numbers, text of each window); places beyond a short text hold ``n_unique``."""
    size = np.diff(first)
    n = np.maximum(0, -(-(size - options.window) // options.stride)) + 1
    text = np.repeat(np.arange(len(size)), n)
    nth = np.arange(n.sum()) - np.repeat(np.concatenate([[0], np.cumsum(n)[:-1]]), n)
    start = np.minimum(nth * options.stride, np.maximum(size[text] - options.window, 0))
    place = start[:, None] + np.arange(options.window)[None, :]
    held = place < size[text][:, None]
    padded = np.append(word, n_unique)
    at = np.where(held, first[:-1][text][:, None] + place, len(word))
    return padded[at].astype(np.int32), text


def begin(options: ToxicityOptions) -> Weights:
    draw = np.random.default_rng(options.seed)
    h, x = options.hidden, options.word_size + options.gram_size
    normal = lambda *shape, by=0.3: (draw.standard_normal(shape) * by).astype(np.float32)
    weights = {"word": normal(WORD_BUCKETS, options.word_size, by=0.05), "gram": normal(GRAM_BUCKETS, options.gram_size, by=0.3),
               "look": normal(2 * h), "out": normal(2 * h), "bias": np.zeros(1, np.float32)}
    for side in ("f", "b"):
        weights |= {f"in_{side}": normal(x, 3 * h), f"add_{side}": np.zeros(3 * h, np.float32), f"turn_{side}": normal(h, 3 * h)}
    return weights


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(20)).astype(np.int64) % WORD_BUCKETS


def vectors(weights: Weights, unique, grams, first) -> np.ndarray:
    """Input vectors of unique words, with one of zeros for empty places."""
    own = weights["word"][_bucket(unique)]
    out = np.zeros((len(unique) + 1, own.shape[1] + weights["gram"].shape[1]), np.float32)
    out[:-1, : own.shape[1]] = own
    if len(grams):
        parts = np.add.reduceat(weights["gram"][grams], first[:-1], axis=0)
        out[:-1, own.shape[1] :] = parts / np.diff(first)[:, None].astype(np.float32)
    return out


def _summed(n: int, at: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """``n`` sums of the rows, by the number that each row has in ``at``."""
    out = np.zeros((n, rows.shape[1]), np.float32)
    if len(at):
        order = np.argsort(at, kind="stable")
        first = np.flatnonzero(np.append(True, np.diff(at[order]) != 0))
        out[at[order][first]] = np.add.reduceat(rows[order], first, axis=0)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1.0)


def forward(weights: Weights, vector: np.ndarray, windows: np.ndarray, keep: list | None = None) -> np.ndarray:
    """Logits of windows; with ``keep``, what the backward pass needs is stored there."""
    h = weights["turn_f"].shape[0]
    n, length = windows.shape
    states = np.empty((length, n, 2 * h), np.float32)
    for side, steps in (("f", range(length)), ("b", range(length - 1, -1, -1))):
        projected = vector @ weights[f"in_{side}"] + weights[f"add_{side}"]
        turn = weights[f"turn_{side}"]
        state = np.zeros((n, h), np.float32)
        column = slice(0, h) if side == "f" else slice(h, 2 * h)
        for t in steps:
            given = projected[windows[:, t]]
            kept = state @ turn
            gates = _sigmoid(given[:, : 2 * h] + kept[:, : 2 * h])
            z, r = gates[:, :h], gates[:, h:]
            new = np.tanh(given[:, 2 * h :] + r * kept[:, 2 * h :])
            if keep is not None:
                keep.append((side, t, state, z, r, new, kept[:, 2 * h :]))
            state = new + z * (state - new)
            states[t, :, column] = state
    look = states @ weights["look"]
    look = np.exp(look - look.max(axis=0))
    look /= look.sum(axis=0)
    pooled = np.einsum("tn,tnh->nh", look, states)
    if keep is not None:
        keep.append((states, look, pooled))
    return pooled @ weights["out"] + weights["bias"][0]


def _gradients(weights: Weights, vector: np.ndarray, windows: np.ndarray, wanted: np.ndarray):
    """Gradients of the mean log loss, with that of each input vector as ``vector``."""
    h = weights["turn_f"].shape[0]
    keep: list = []
    logits = forward(weights, vector, windows, keep)
    states, look, pooled = keep.pop()
    d = (_sigmoid(logits) - wanted) / len(wanted)
    grad = {k: np.zeros_like(v) for k, v in weights.items() if k not in ("word", "gram")}
    grad["out"], grad["bias"] = pooled.T @ d, np.array([d.sum()], np.float32)
    d_pooled = d[:, None] * weights["out"][None, :]
    d_look = np.einsum("tnh,nh->tn", states, d_pooled)
    d_look = look * (d_look - (look * d_look).sum(axis=0))
    grad["look"] = np.einsum("tn,tnh->h", d_look, states)
    d_states = look[:, :, None] * d_pooled[None] + d_look[:, :, None] * weights["look"]
    d_vector = np.zeros_like(vector)
    reached = {side: np.empty((windows.shape[1], len(wanted), 3 * h), np.float32) for side in ("f", "b")}
    carried = {"f": np.zeros((len(wanted), h), np.float32), "b": np.zeros((len(wanted), h), np.float32)}
    for side, t, before, z, r, new, kept in reversed(keep):
        dh = carried[side] + d_states[t, :, slice(0, h) if side == "f" else slice(h, 2 * h)]
        d_new = dh * (1 - z) * (1 - new * new)
        d_z = dh * (before - new) * z * (1 - z)
        d_r = d_new * kept * r * (1 - r)
        turned = np.concatenate([d_z, d_r, d_new * r], axis=1)
        given = np.concatenate([d_z, d_r, d_new], axis=1)
        grad[f"turn_{side}"] += before.T @ turned
        carried[side] = dh * z + turned @ weights[f"turn_{side}"].T
        reached[side][t] = given
    for side in ("f", "b"):
        projected = _summed(len(vector), windows.T.reshape(-1), reached[side].reshape(-1, 3 * h))
        grad[f"in_{side}"], grad[f"add_{side}"] = vector.T @ projected, projected.sum(axis=0)
        d_vector += projected @ weights[f"in_{side}"].T
    return grad, d_vector


def fit(texts: list[str], toxic: np.ndarray, options: ToxicityOptions, clean_weight: float = 1.0) -> Weights:
    """Weights from whole labelled texts; ``scale`` and ``shift`` turn a document's highest
    window into its score, a clean text counting ``clean_weight`` times there."""
    weights = begin(options)
    weights |= {"scale": np.ones(1, np.float32), "shift": np.zeros(1, np.float32)}
    if not len(toxic) or toxic.all() or not toxic.any():
        weights["shift"][:] = 0 if not len(toxic) else 4 if toxic.all() else -4
        weights["scale"][:] = 0
        return weights
    draw = np.random.default_rng(options.seed + 1)
    unique, grams, first, word, firsts = inputs_of(pa.array(texts, pa.large_string()))
    windows, text = windows_of(firsts, word, len(unique), options)
    # the first choice of windows: trigrams that more of the toxic documents hold, as a z value
    pairs = np.unique(text_of(firsts, len(word)) * len(unique) + word)
    doc, held = pairs // len(unique), pairs % len(unique)
    size = np.diff(first)[held]
    gram = grams[np.repeat(first[held], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)]
    seen = np.unique(np.repeat(doc, size) * GRAM_BUCKETS + gram)
    n = [np.bincount(seen[toxic[seen // GRAM_BUCKETS] == label] % GRAM_BUCKETS, minlength=GRAM_BUCKETS) for label in (0, 1)]
    many = np.bincount(toxic, minlength=2)
    share = (n[0] + n[1] + 1) / (many.sum() + 2)
    z = (n[1] / many[1] - n[0] / many[0]) / np.sqrt(share * (1 - share) * (1 / many[0] + 1 / many[1]))
    suspicion = np.append(np.maximum.reduceat(z[grams], first[:-1]) if len(grams) else [], -9.0)
    value = suspicion[windows].max(axis=1)
    tables = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in weights.items()}
    step = 0
    chosen: set[int] = set()
    for round_ in range(options.rounds):
        order = np.lexsort((-value, text))
        tops = order[np.unique(text[order], return_index=True)[1]]  # the most suspicious window of each text
        good = tops[toxic[text[tops]] == 1]
        chosen |= set(tops[toxic[text[tops]] == 0].tolist())
        calm = np.flatnonzero(toxic[text] == 0)
        bad = np.array(sorted(chosen | set(draw.choice(calm, min(len(calm), 2 * len(tops)), replace=False).tolist())))
        rows = np.concatenate([np.repeat(good, max(1, len(bad) // (2 * len(good)))), bad])
        wanted = (toxic[text[rows]] == 1).astype(np.float32)
        for _ in range(options.epochs):
            mixed = draw.permutation(len(rows))
            for at in range(0, len(mixed), options.batch):
                pick = mixed[at : at + options.batch]
                part = windows[rows[pick]]
                used, local = np.unique(part, return_inverse=True)
                real = used[used < len(unique)]
                size = np.diff(first)[real]
                starts = np.concatenate([[0], np.cumsum(size)])
                mine = grams[np.repeat(first[real], size) + np.arange(size.sum()) - np.repeat(starts[:-1], size)]
                vector = vectors(weights, unique[real], mine, starts)
                drop = draw.random(len(real)) < options.drop
                vector[:-1][drop, : options.word_size] = 0  # so that parts of words are learned too
                local = local.reshape(part.shape)
                grad, d_vector = _gradients(weights, vector, local, wanted[pick])
                d_vector = d_vector[: len(real)]
                d_vector[drop, : options.word_size] = 0
                grad["word"] = _summed(WORD_BUCKETS, _bucket(unique[real]), d_vector[:, : options.word_size])
                shares = d_vector[:, options.word_size :] / np.maximum(size, 1)[:, None]
                grad["gram"] = _summed(GRAM_BUCKETS, mine, np.repeat(shares, size, axis=0))
                step += 1
                for k, g in grad.items():
                    m, v = tables[k]
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    weights[k] -= options.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
        vector = vectors(weights, unique, grams, first)
        value = np.concatenate([forward(weights, vector, windows[i : i + 4096]) for i in range(0, len(windows), 4096)])
    most = np.maximum.reduceat(value, np.flatnonzero(np.append(True, text[1:] != text[:-1])))
    scale, shift = 1.0, 0.0
    counts = np.where(toxic == 1, 1.0, clean_weight)
    for _ in range(500):  # a logistic curve over documents' highest windows
        error = (_sigmoid(scale * most + shift) - toxic) * counts
        scale -= 0.05 * float((error * most).sum() / counts.sum() + 0.01 * (scale - 1))
        shift -= 0.5 * float(error.sum() / counts.sum())
    weights["scale"][:], weights["shift"][:] = scale, shift
    return weights


def train(docs: DataFrame, labels: DataFrame, options: ToxicityOptions = ToxicityOptions(), id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "toxic") -> Weights:
    """A network trained on a bounded sample of the labels (id, label), drawn by a hash of the id.

    Label 1 is toxic, any other is not; of several labels of an id the highest counts, of
    several texts the one with the lowest hash. Null ids, labels or texts teach nothing. The sample is drawn from the labels alone, and only
    its few ids go to the documents, so no text moves but the sample's. Without both labels
    the score is a constant.
    """
    marks = labels.select(F.col(id_col).cast("string").alias("id"), (F.col(label_col) == 1).cast("int").alias("toxic"))
    marks = marks.where("id is not null and toxic is not null").groupBy("id").agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in marks.groupBy("toxic").count().collect()}
    draw = F.pmod(F.xxhash64("id", F.lit(11)), F.lit(1_000_000))
    limits = {label: 1e6 * n / sizes.get(label, 1) for label, n in ((0, options.sample_clean), (1, options.sample_toxic))}
    drawn = marks.where(draw < F.when(F.col("toxic") == 1, F.lit(limits[1])).otherwise(F.lit(limits[0]))).collect()
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).where(F.length("text") <= options.sample_chars)
    few = docs.sparkSession.createDataFrame(drawn, "id string, toxic int")  # about sample_toxic + sample_clean rows
    sample = rows.join(F.broadcast(few), "id")
    one = sample.groupBy("id", "toxic").agg(F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text"))
    found = one.toPandas().sort_values(["id", "toxic", "text"])
    got = found["toxic"].value_counts()
    weight = sizes.get(0, 1) / max(got.get(0, 1), 1) / (sizes.get(1, 1) / max(got.get(1, 1), 1))
    return fit(list(found["text"]), found["toxic"].to_numpy().astype(np.int64), options, weight)


def scores(column, weights: Weights, options: ToxicityOptions) -> tuple[np.ndarray, np.ndarray]:
    """(score, highest window's number) of each text of a slice."""
    unique, grams, first, word, firsts = inputs_of(column)
    vector = vectors(weights, unique, grams, first)
    windows, text = windows_of(firsts, word, len(unique), options)
    value = np.concatenate([forward(weights, vector, windows[i : i + 4096]) for i in range(0, len(windows), 4096)])
    start = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
    most = np.maximum.reduceat(value, start)
    top = np.flatnonzero(value == most[text])
    where = top[np.unique(text[top], return_index=True)[1]] - start
    return _sigmoid(weights["scale"][0] * most + weights["shift"][0]).astype(np.float64), where


def toxicity(docs: DataFrame, weights: Weights, options: ToxicityOptions = ToxicityOptions(),
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, worst_word): each row's score from all windows of its whole text.

    worst_word is the place of the first word of the highest window, the earliest of equal
    ones. A null or empty text is one empty window. One row per input row, repeated and
    null ids included; other columns are not read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(weights)  # fixed size, under 1 MB
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, limit=SLICE):
            score, where = scores(part.column(1), shared.value, options)
            size = np.diff(words_of(part.column(1)).first)
            place = np.minimum(where * options.stride, np.maximum(size - options.window, 0))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(score), pa.array(place.astype(np.int64))],
                                             names=[id_col, "score", "worst_word"])

    rows = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"`{id_col}` {kind}, score double, worst_word long")
