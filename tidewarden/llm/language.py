"""Language identification as a mixture: the share of each language in every document.

Hashed byte n-grams get log likelihoods per language from a labelled sample. A document is
cut into chunks of consecutive words; expectation-maximisation over the chunks estimates
the document's language proportions. Starting from the best single language, the next
likely language joins as long as it lowers the penalised likelihood (BIC).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewarden.llm.text import _LOWER, slices, utf8, words_of
from tidewarden.session import ship_package

BUCKET_BITS = 16
UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageOptions:
    """``sample_docs``: about so many labelled documents of each language are learned from."""

    sample_docs: int = 3000
    chunk_words: int = 8
    rounds: int = 12
    add: float = 0.5
    sharpness: float = 0.6
    max_languages: int = 1000


@dataclass(frozen=True)
class LanguageModel:
    names: list[str]
    log_p: np.ndarray  # languages x buckets, float32


def _buckets(data: np.ndarray) -> np.ndarray:
    """The bucket of the lower-cased byte trigram that ends at each byte."""
    low = _LOWER[data].astype(np.uint32)
    before = np.zeros_like(low)
    before[1:] = low[:-1]
    earlier = np.zeros_like(low)
    earlier[2:] = low[:-2]
    code = (low | (before << 8) | (earlier << 16)) * np.uint32(2654435761)
    return code >> np.uint32(32 - BUCKET_BITS)


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for name, texts in batch.groupby("lang")["text"]:
            data = utf8(pa.array(["\n" + t for t in texts], pa.large_string()))[0]
            found = np.bincount(_buckets(data), minlength=1 << BUCKET_BITS)
            counts[name] = counts.get(name, 0) + found
    for name, found in counts.items():
        at = np.flatnonzero(found)
        yield pd.DataFrame({"lang": name, "bucket": at, "n": found[at]})


def learn(labelled: DataFrame, options: LanguageOptions = LanguageOptions(),
          id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Trigram likelihoods of each language of ``labelled``.

    The rows learned from are a bounded sample: per language about ``sample_docs``
    documents chosen by a hash of the id, with their whole texts. Rows with
    a null id, text or language teach nothing. Languages are the label's values, at most
    ``max_languages`` (more raise ValueError). No labelled rows give a model without
    languages, which predicts ``und``.
    """
    spark = labelled.sparkSession
    ship_package(spark)
    rows = labelled.select(
        F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"),
        F.col(lang_col).cast("string").alias("lang"),
    ).where("id is not null and text is not null and lang is not null")
    sizes = rows.groupBy("lang").count().limit(options.max_languages + 1).collect()
    if len(sizes) > options.max_languages:
        raise ValueError(f"more than {options.max_languages} languages")
    names = sorted(r["lang"] for r in sizes)
    if not names:
        return LanguageModel([], np.zeros((0, 1 << BUCKET_BITS), np.float32))
    share = {r["lang"]: options.sample_docs / r["count"] for r in sizes}
    draw = (F.xxhash64("id", F.lit(5)) % 1_000_000 + 1_000_000) % 1_000_000
    limit = F.coalesce(*[F.when(F.col("lang") == n, F.lit(share[n] * 1e6)) for n in names])
    sample = rows.where(draw < limit).select("lang", "text")
    counted = sample.mapInPandas(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = counted.toPandas()  # languages x buckets at most
    counts = np.zeros((len(names), 1 << BUCKET_BITS))
    counts[found["lang"].map({n: i for i, n in enumerate(names)}), found["bucket"]] = found["n"]
    pooled = counts.sum(axis=0) / max(counts.sum(), 1)
    # a language's unseen trigrams fall back on what all languages share
    smooth = counts + options.add * (1 << 12) * (0.5 * pooled + 0.5 / (1 << BUCKET_BITS))
    log_p = np.log(smooth / smooth.sum(axis=1, keepdims=True))
    return LanguageModel(names, log_p.astype(np.float32))


def _fit(chunks: np.ndarray, first: np.ndarray, allowed: np.ndarray, rounds: int):
    """EM over all documents of a slice at once: (proportions, log likelihood).

    chunks: chunk x language likelihoods, scaled to a maximum of 1; first: the first chunk
    of each document, all documents having one; allowed: document x language.
    """
    sizes = np.diff(np.append(first, len(chunks)))
    doc = np.repeat(np.arange(len(first)), sizes)
    share = allowed / allowed.sum(axis=1, keepdims=True)
    for _ in range(rounds):
        part = chunks * share[doc]
        part /= part.sum(axis=1, keepdims=True)
        share = np.add.reduceat(part, first, axis=0) / sizes[:, None]
    total = (chunks * share[doc]).sum(axis=1)
    return share, np.add.reduceat(np.log(np.maximum(total, 1e-300)), first)


def mixtures(column, model: LanguageModel, options: LanguageOptions) -> np.ndarray:
    """Document x language proportions of a slice's texts; a row of zeros where a text has no words."""
    words = words_of(column)
    n_docs, n_langs = len(words.first) - 1, len(model.names)
    out = np.zeros((n_docs, n_langs))
    per_doc = np.diff(words.first)
    full = np.flatnonzero(per_doc)
    if not len(full) or not n_langs:
        return out
    # chunks of whole words: the last chunk of a document may be shorter
    n_chunks = -(-per_doc[full] // options.chunk_words)
    first = np.concatenate([[0], np.cumsum(n_chunks)[:-1]])
    within = np.arange(n_chunks.sum()) - np.repeat(first, n_chunks)
    word = np.repeat(words.first[:-1][full], n_chunks) + within * options.chunk_words
    begin = words.start[word]
    buckets = _buckets(words.data)
    scores = np.empty((len(begin), n_langs))
    for k in range(n_langs):
        scores[:, k] = np.add.reduceat(model.log_p[k][buckets], begin, dtype=np.float64)
    scores *= options.sharpness
    top = scores.max(axis=1, keepdims=True)
    chunks = np.exp(np.maximum(scores - top, -60.0))
    order = np.argsort(-np.add.reduceat(np.maximum(scores - top, -60.0), first, axis=0), axis=1, kind="stable")
    wide, _ = _fit(chunks, first, np.ones((len(full), n_langs)), options.rounds)
    # the best single language comes first, then the others by their share when all take part
    lead = order[:, :1]
    wide[np.arange(len(full)), lead[:, 0]] = 2.0
    ranked = np.argsort(-wide, axis=1, kind="stable")
    allowed = np.zeros((len(full), n_langs))
    allowed[np.arange(len(full)), ranked[:, 0]] = 1
    best, fit = _fit(chunks, first, allowed, 0)
    live = np.arange(len(full))
    penalty = 0.5 * np.log(np.maximum(n_chunks, 2)) + 1.0
    for k in range(1, n_langs):
        live = live[wide[live, ranked[live, k]] > 1e-3]
        if not len(live):
            break
        trial = allowed[live].copy()
        trial[np.arange(len(live)), ranked[live, k]] = 1
        rows = np.repeat(np.isin(np.arange(len(full)), live), n_chunks)
        sizes = n_chunks[live]
        share, value = _fit(chunks[rows], np.concatenate([[0], np.cumsum(sizes)[:-1]]), trial, options.rounds)
        better = value - fit[live] > penalty[live]
        live = live[better]
        allowed[live], best[live], fit[live] = trial[better], share[better], value[better]
    out[full] = best
    return out


def identify(docs: DataFrame, model: LanguageModel, options: LanguageOptions = LanguageOptions(),
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, languages): the main language of each row's whole text.

    ``languages`` maps every language of the selected set to its proportion; ``score`` is
    the proportion of ``lang_pred``. A text that is null or has no letter gets ``und``,
    score 0 and no languages. One row per input row, repeated ids and null ids included;
    other columns are not read. Equal proportions go to the first name in order.
    """
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)  # languages x 2^16 floats

    def run(batches):
        known = shared.value
        for part in slices(batches):
            shares = mixtures(part.column(1), known, options)
            letters = part.column(2).to_numpy(zero_copy_only=False)
            names, scores, maps = [], [], []
            for row, letter in zip(shares, letters, strict=True):
                pairs = [(known.names[k], float(row[k])) for k in np.flatnonzero(row)] if letter else []
                name, score = max(pairs, key=lambda x: x[1], default=(UNKNOWN, 0.0))
                names.append(name)
                scores.append(min(1.0, score))
                maps.append(pairs)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(maps, pa.map_(pa.string(), pa.float64()))],
                names=[id_col, "lang_pred", "score", "languages"])

    letter: Column = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(F.col(id_col), F.col(text_col).alias("text"), letter.alias("letter"))
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, lang_pred string, score double, languages map<string,double>")


def keep_identified(docs: DataFrame, model: LanguageModel, options: LanguageOptions = LanguageOptions(),
                    text_col: str = "text") -> DataFrame:
    """The rows whose text has a language, with all their columns; those that get ``und`` go."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)
    names, place = docs.columns, docs.columns.index(text_col)
    letter = F.coalesce(docs[text_col].rlike(r"\p{L}"), F.lit(False))

    def run(batches):
        for part in slices(batches, text_col):
            known = mixtures(part.column(place), shared.value, options).any(axis=1)
            keep = known & part.column(len(names)).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep)) for c in part.columns[: len(names)]], names=names)

    return docs.select("*", letter.alias("has a letter")).mapInArrow(run, docs.schema)
