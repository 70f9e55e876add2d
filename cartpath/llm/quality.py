"""Quality rules: boosted trees over document statistics (operator 4).

Statistics of the whole text are taken in one pass; base rules fail a document outright,
and gradient-boosted trees judge the others. More symbols, repeated words, repeated lines
or runs of one word can only lower a score (monotonic constraints). The trees are fitted
on a bounded sample (``SAMPLE_DOCS`` labelled documents by hash of the id), flattened into
node arrays and broadcast.

``n_repeat_words``: windows of 8 words are ranked by doubling (1, 2, 4, 8 words; ranks of
pairs, so equal ranks are equal windows); the words under windows that occur twice count.

Defined cases: null and empty texts have no words and fail the base rules; with no usable
labels every document that passes the base rules is kept (score 1); a repeated label counts
once, the higher quality first, and of rows with one id the least text; repeated rows and further columns make no difference; an
empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boosting import FlatTrees, constant, fit_trees
from .common import ship, text_slices

SAMPLE_DOCS = 8_000
WINDOW = 8
LEAST_SCORE = 0.5
SYMBOLS = "#*$%&|<>"
FEATURES = ("log_words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "same_next_share",
            "distinct_share", "capital_share", "digit_share", "mark_share", "line_words", "top_share")
MONOTONIC = {"symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "same_next_share": -1}
SCORED = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, score double, kept boolean")

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOL = re.compile(r"[#*$%&|<>]")
_CAPITAL = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_DIGIT = re.compile(r"[0-9]")
_MARK = re.compile(r"[!?.,;:]")


def repeated_words(ids: np.ndarray, owner: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Marks the words (ids of all texts in a row, ``owner`` the text of each) under windows
    that occur twice or more in their text."""
    n = len(ids)
    marked = np.zeros(n, bool)
    if n < window:
        return marked
    rank, width = ids.astype(np.int64), 1
    while width < window:
        step = min(width, window - width)
        pair = rank[:len(rank) - step] * (int(rank.max()) + 1) + rank[step:]
        rank, width = pd.factorize(pair)[0].astype(np.int64), width + step
    # A window lies in one text, and is compared within it.
    inside = owner[:len(rank)] == owner[window - 1:]
    at = np.flatnonzero(inside)
    key = owner[at].astype(np.int64) * (int(rank.max()) + 1) + rank[at]
    codes = pd.factorize(key)[0]
    twice = at[np.bincount(codes)[codes] > 1] if len(at) else at
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, twice, 1)
    np.add.at(edge, twice + window, -1)
    return edge[:-1].cumsum() > 0


def statistics(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Base counts (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) and the features."""
    words = [_WORD.findall(t) for t in texts]
    n = np.array([len(w) for w in words], np.int64)
    flat = [w for ws in words for w in ws]
    ids = pd.factorize(np.array(flat, dtype=object))[0] if flat else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(texts)), n)
    per_text = lambda marks: np.bincount(owner, weights=marks, minlength=len(texts)).astype(np.int64)
    chars = per_text(np.fromiter(map(len, flat), np.int64, len(flat)))
    repeat = per_text(repeated_words(ids, owner))
    same = np.zeros(len(flat), bool)
    same[1:] = (ids[1:] == ids[:-1]) & (owner[1:] == owner[:-1])
    same = per_text(same)
    pairs = np.unique(owner * (int(ids.max(initial=0)) + 1) + ids, return_counts=True)
    pair_owner = pairs[0] // (int(ids.max(initial=0)) + 1)
    distinct = np.bincount(pair_owner, minlength=len(texts))
    top = np.zeros(len(texts), np.int64)
    np.maximum.at(top, pair_owner, pairs[1])
    symbols, dup, lines, capitals, digits, marks = (np.zeros(len(texts), np.int64) for _ in range(6))
    for i, t in enumerate(texts):
        symbols[i], capitals[i] = len(_SYMBOL.findall(t)), len(_CAPITAL.findall(t))
        digits[i], marks[i] = len(_DIGIT.findall(t)), len(_MARK.findall(t))
        full = [line for line in t.split("\n") if _WORD.search(line)]
        lines[i], dup[i] = len(full), len(full) - len(set(full))
    w, c, m = np.maximum(n, 1), np.maximum(chars, 1), np.maximum(lines, 1)
    features = np.stack([np.log1p(n), chars / w, symbols / c, dup / m, repeat / w, same / w, distinct / w,
                         capitals / c, digits / c, marks / w, n / m, top / w], axis=1).astype(float)
    return np.stack([n, chars, symbols, dup, repeat], axis=1), features


def learn_quality(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> FlatTrees:
    """Trees from ``docs`` (doc_id, text) and ``labels`` (doc_id, quality)."""
    ship(docs.sparkSession)
    known = (labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
             .filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
             .groupBy("doc_id").agg(F.max(F.when(F.col("quality") > 0, 1).otherwise(0)).alias("quality"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs))  # at most sample_docs ids

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            base, x = statistics(batch.column("text").to_pylist())
            x = x[passes := ~base_failed(base)]
            yield pa.RecordBatch.from_arrays([batch.column("quality").filter(pa.array(passes)), *[pa.array(x[:, i]) for i in range(len(FEATURES))]],
                                             ["quality", *FEATURES])

    rows = (docs.select("doc_id", F.col("text").cast("string")).filter(F.col("text").isNotNull()).join(F.broadcast(known), "doc_id")
            .groupBy("doc_id", "quality").agg(F.min("text").alias("text")).select("quality", "text").mapInArrow(measure, "quality int, " + ", ".join(f"{f} double" for f in FEATURES)).toPandas())
    rows = rows.sort_values([*FEATURES, "quality"])
    if rows["quality"].nunique() < 2:
        return constant(0.999)
    signs = {FEATURES.index(f): s for f, s in MONOTONIC.items()}
    return fit_trees(rows[list(FEATURES)].to_numpy(), rows["quality"].to_numpy(float), signs)


def base_failed(base: np.ndarray) -> np.ndarray:
    return (base[:, 0] < 20) | (100 * base[:, 4] > 30 * base[:, 0])


def score_quality(docs: DataFrame, trees: FlatTrees, least_score: float = LEAST_SCORE) -> DataFrame:
    """Base counts, verdict of the base rules, score and final verdict of every row."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(trees)
    names = [x.split()[0] for x in SCORED.split(", ")]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            base, x = statistics([t or "" for t in batch.column("text").to_pylist()])
            failed, p = base_failed(base), shared.value.probability(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(base[:, i]) for i in range(5)], pa.array(failed), pa.array(p),
                 pa.array(~failed & (p >= least_score))], names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(score, SCORED)
