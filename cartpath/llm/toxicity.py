"""Toxicity by a weighted lexicon (operator 7).

Texts are folded first: capitals, full-width letters, Cyrillic and Greek look-alikes and
digits or signs used for letters inside a word become plain letters. An Aho-Corasick
automaton finds the lexicon's entries (whole words and word beginnings) in one pass; a hit
inside an exception phrase does not count, and of several entries at one word the
heaviest counts. A word with signs anywhere (``idi07``, ``1d10t``, ``id!ot``) is looked up
wholly folded as well, with a ``!`` at its ends as punctuation and as a letter; without a
letter (``2024``, ``$$$``) it stays as it is. The hits' weights and their share of the length enter a logistic curve.

The lexicon is learned from labelled documents: an entry's weight is the smoothed log-odds
of the document shares that hold it, in toxic against other documents, exception phrases
are pairs of words around an entry that stand in other documents. The labelled rows are a bounded sample
(``SAMPLE_DOCS`` by hash of the id); Spark counts their terms, and the kept entries are
bounded (``ENTRIES``), so what is broadcast has a fixed size.

Defined cases: null and empty texts score as a text without hits; a null id is never
learned from and not held out; labels that are null, missing or all alike give every text
the same score, the share of toxic ones; repeated labels of one document count once, a
toxic one first, and of rows with one id the least text; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_crc32, materialize, ship, text_slices

SAMPLE_DOCS = 12_000
ENTRIES = 4_000
EXCEPTIONS = 1_000
LEAST_DOCS = 5
LEAST_WEIGHT = 2.0
PREFIXES = (4, 5, 6)
SCORED = "doc_id long, held_out boolean, score double, predicted int"

# Look-alikes of Latin letters, and signs written for letters.
_ALIKE = dict(zip("авгеёзіїјкмнорсԁԛѕтухԝһαβεζηικμνορτυχω", "abreesiijkmhopcdqstyxwhabezhikmvoptyxw"))
_SIGNS = dict(zip("0134578@$!", "oieastbasi"))
_SIGNED = re.compile(r"(?<![^ ])[^ ]*[0134578@$!][^ ]*")
_WHOLE = str.maketrans(_SIGNS)
_MARK = re.compile(r"(?<=[^\W\d_])[0134578@$]+(?=[^\W\d_])|(?<![^ ])[0134578@$](?=[^\W\d_]{2})")
_fold_table: np.ndarray | None = None


def fold_table() -> np.ndarray:
    """Code point -> folded code point; anything but letters, digits and the signs becomes a space."""
    global _fold_table
    if _fold_table is None:
        table = np.full(0x110000, 32, np.uint32)
        for i in range(0x110000):
            c = chr(i)
            if not c.isalnum():
                continue
            low = c.lower()
            if len(low) != 1:
                low = c
            if 0xFF00 <= i < 0xFFF0 or 0x1D400 <= i < 0x1D800:
                wide = unicodedata.normalize("NFKC", low)
                low = wide.lower() if len(wide) == 1 else low
            table[i] = ord(_ALIKE.get(low, low))
        for c in "@$!":
            table[ord(c)] = ord(c)
        _fold_table = table
    return _fold_table


def _flat(text: str) -> str:
    """Folded letters, digits and signs; everything else is a space."""
    return fold_table()[np.frombuffer(text.encode("utf-32-le"), np.uint32)].tobytes().decode("utf-32-le", "replace")


def _plain(flat: str) -> str:
    """`` word word `` with inner signs folded, other ``@``, ``$`` and every ``!`` as spaces."""
    flat = flat.replace("!", " ")
    if not flat.isalpha():
        flat = _MARK.sub(lambda m: "".join(_SIGNS[c] for c in m.group()), flat)
    flat = flat.replace("@", " ").replace("$", " ")
    return f" {' '.join(flat.split(' '))} ".replace("  ", " ") if "  " not in flat else f" {' '.join(flat.split())} "


def fold(text: str) -> str:
    """`` word word `` with single spaces at both ends; look-alikes and inner signs folded."""
    return _plain(_flat(text)) if text else " "


def _whole(word: str) -> list[str]:
    """Wholly folded forms of a word with signs; the first takes each ``!`` at its ends as punctuation."""
    if not any(map(str.isalpha, word)):
        return []
    core = word.strip("!")
    before, after = len(word) - len(word.lstrip("!")), len(word) - len(word.rstrip("!"))
    forms = {"!" * a + core + "!" * b: None for a in (0, 1, before) if a <= before for b in (0, 1, after) if b <= after}
    return [f.translate(_WHOLE) for f in forms]


def fold_signed(text: str) -> tuple[str, list[tuple[int, int, list[str]]]]:
    """``fold`` of a text, and for each word with signs its start and end there and its wholly folded forms."""
    if not text:
        return " ", []
    flat = _flat(text)
    parts, signed, at, last = [], [], 0, 0
    for m in _SIGNED.finditer(flat):
        if plain := flat[last:m.start()].split():
            parts.append(" " + " ".join(plain))
            at += len(parts[-1])
        last, word = m.end(), m.group()
        here = _plain(word).rstrip()
        parts.append(here)
        if forms := [f for f in _whole(word) if f" {f}" != here]:
            signed.append((at, at + len(here), forms))
        at += len(here)
    if not last:
        return _plain(flat), []
    if plain := flat[last:].split():
        parts.append(" " + " ".join(plain))
    return ("".join(parts) or " ") + " ", signed


def terms(folded: str, signed: list[tuple[int, int, list[str]]] = ()) -> set[str]:
    """Words and word beginnings of a folded text, as they are looked up."""
    # A ``!`` at a word's end is mostly punctuation: those forms are looked up, not learned.
    words = {*folded.split(), *(forms[0] for _, _, forms in signed)}
    out = {f" {w} " for w in words if len(w) < 40}
    for n in PREFIXES:
        out.update(f" {w[:n]}" for w in words if len(w) > n)
    return out


class Lexicon:
    def __init__(self, weights: dict[str, float], exceptions: tuple[str, ...] = (),
                 curve: tuple[float, ...] = (-4.0, 0.0, 0.0, 0.0)):
        self.weights, self.exceptions, self.curve = dict(weights), tuple(exceptions), tuple(curve)
        self._automaton = None

    def __getstate__(self):
        return {**self.__dict__, "_automaton": None}

    def automaton(self):
        if self._automaton is None:
            self._automaton = ahocorasick.Automaton()
            for e, w in self.weights.items():
                self._automaton.add_word(e, (len(e), w))
            for e in self.exceptions:
                self._automaton.add_word(e, (len(e), None))
            if self.weights or self.exceptions:
                self._automaton.make_automaton()
        return self._automaton

    def hits(self, folded: str) -> dict[int, tuple[float, int]]:
        """Start -> weight and end of the heaviest entry there, without those inside exceptions."""
        found: dict[int, tuple[float, int]] = {}
        if not self.weights:
            return found
        spared = []
        for end, (n, w) in self.automaton().iter(folded):
            start = end - n + 1
            if w is None:
                spared.append((start, end))
            elif start not in found or found[start][0] < w:
                found[start] = (w, end)
        if spared:
            # Inside an exception: among those that begin no later, one ends no earlier.
            spared.sort()
            begins, reach = [a for a, _ in spared], list(accumulate((b for _, b in spared), max))
            found = {s: v for s, v in found.items() if not (i := bisect_right(begins, s)) or reach[i - 1] < v[1]}
        return found

    def hits_signed(self, folded: str, signed: list[tuple[int, int, list[str]]]) -> dict[int, tuple[float, int]]:
        """``hits``, with words looked up wholly folded too; the heavier form of a word counts."""
        found = self.hits(folded)
        starts = sorted(found)  # words with signs are apart: what one adds does not concern another
        for start, end, forms in signed if self.weights else ():
            before = folded[max(0, folded.rfind(" ", 0, start)):start]
            stop = folded.find(" ", end + 1)
            after = folded[end:stop + 1] if stop > 0 else " "
            best = max((h[len(before)] for h in (self.hits(f"{before} {form}{after}") for form in forms) if len(before) in h), default=None)
            if best:
                own = max(starts[bisect_left(starts, start):bisect_left(starts, end)], key=lambda s: found[s], default=None)
                if own is None or found[own][0] < best[0]:
                    found[start if own is None else own] = (best[0], end)
        return found

    def features(self, text: str | None) -> tuple[float, float, float]:
        folded, signed = fold_signed(text or "")
        found = self.hits_signed(folded, signed)
        mass = sum(w for w, _ in found.values())
        words = max(1, folded.count(" ") - 1)
        return float(np.log1p(mass)), float(np.log1p(100 * mass / words)), float(np.log1p(len(found)))

    def score(self, texts: list[str | None]) -> np.ndarray:
        x = np.array([self.features(t) for t in texts]).reshape(-1, 3)
        return 1 / (1 + np.exp(-(x @ np.array(self.curve[1:]) + self.curve[0])))


def _fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> tuple[float, ...]:
    """Ridge logistic regression (Newton steps) with an intercept."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        penalty = np.diag([1e-6, *[ridge * len(x) / 100] * (x.shape[1] - 1)])
        h = (x * (p * (1 - p))[:, None]).T @ x + penalty
        w -= (move := np.linalg.solve(h, x.T @ (p - y) + penalty @ w))
        if np.abs(move).max() < 1e-8:
            break
    return tuple(map(float, w))


def learn_lexicon(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, entries: int = ENTRIES) -> Lexicon:
    """A lexicon from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic), held-out documents left aside."""
    spark = docs.sparkSession
    ship(spark)
    known = (labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
             .filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (id_crc32() % 5 != 0))
             .groupBy("doc_id").agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("toxic")))
    # At most sample_docs ids.
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
    sample = materialize(docs.select("doc_id", F.col("text").cast("string")).filter(F.col("text").isNotNull())
                         .join(F.broadcast(known), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
                         .select("toxic", "text"), "toxicity-sample")
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    pos, neg = sizes.get(1, 0), sizes.get(0, 0)
    if not pos or not neg:
        share = (pos + 0.5) / (pos + neg + 1) if pos or neg else 0.1
        return Lexicon({}, (), (float(np.log(share / (1 - share))), 0.0, 0.0, 0.0))

    def counted(batches: Iterator[pa.RecordBatch], make) -> Iterator[pa.RecordBatch]:
        seen = {0: Counter(), 1: Counter()}
        for batch in text_slices(batches):
            for toxic, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist()):
                seen[toxic].update(make(*fold_signed(text)))
        every = list(seen[0].keys() | seen[1].keys())
        for i in range(0, len(every), 50_000):
            part = every[i:i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), *[pa.array([seen[k][t] for t in part], pa.int64()) for k in (1, 0)]],
                                             ["term", "pos", "neg"])

    def counts(make) -> DataFrame:
        return (sample.mapInArrow(lambda b: counted(b, make), "term string, pos long, neg long")
                .groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))

    weight = F.log((F.col("pos") + 0.5) / (pos + 1)) - F.log((F.col("neg") + 0.5) / (neg + 1))
    best = (counts(terms).filter(F.col("pos") >= LEAST_DOCS).withColumn("w", weight).filter(F.col("w") >= LEAST_WEIGHT)
            .orderBy(F.desc("w"), "term").limit(entries).collect())
    chosen: dict[str, float] = {}
    for r in sorted(best, key=lambda r: (len(r["term"]), r["term"])):
        term = r["term"]
        # A beginning that is as telling stands for the longer entries.
        if not any(term.startswith(p) and chosen[p] >= 0.8 * r["w"] for p in (term[:n + 1] for n in PREFIXES) if p != term and p in chosen):
            chosen[term] = float(r["w"])
    plain = Lexicon(chosen)

    def around(folded: str, _) -> set[str]:
        out = set()
        for start, (_, end) in plain.hits(folded).items():
            stop = folded.find(" ", start + 1)
            after = folded.find(" ", stop + 1)
            before = folded.rfind(" ", 0, start)
            if after > 0:
                out.add(folded[start:after + 1])
            if before >= 0:
                out.add(folded[before:stop + 1])
        return out

    spared = (counts(around).filter((F.col("neg") >= 3) & (F.col("neg") * (pos + 1) > 10 * (F.col("pos") + F.lit(0.5)) * (neg + 1)))
              .orderBy(F.desc("neg"), "term").limit(EXCEPTIONS).collect())
    plain = Lexicon(chosen, tuple(r["term"] for r in spared))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            x = np.array([plain.features(t) for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), *[pa.array(x[:, i]) for i in range(3)]], ["toxic", "a", "b", "c"])

    # Four numbers for each of at most sample_docs rows.
    rows = sample.mapInArrow(measured, "toxic int, a double, b double, c double").toPandas()
    rows = rows.sort_values(["a", "b", "c", "toxic"])
    return Lexicon(chosen, plain.exceptions, _fit_curve(rows[["a", "b", "c"]].to_numpy(), rows["toxic"].to_numpy(float)))


def score_toxicity(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(lexicon)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            s = shared.value.score(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                                             ["doc_id", "held_out", "score", "predicted"])

    held = F.coalesce(id_crc32() % 5 == 0, F.lit(False))
    return docs.select(F.col("doc_id").cast("long"), held.alias("held_out"), F.col("text").cast("string")).mapInArrow(score, SCORED)


def drop_toxic(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """The rows of ``docs`` (all columns) that are not predicted toxic."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(lexicon)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            yield batch.filter(pa.array(shared.value.score(batch.column("text").to_pylist()) < 0.5))

    return docs.mapInArrow(keep, docs.schema)
