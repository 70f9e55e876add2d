"""Language identification by cross-parsing (operator 10).

From each language's labelled text a suffix automaton is built. A text is parsed against
it into the longest phrases that occur in the labelled text; ``phrases * log2(size of the
labelled text) / length`` estimates the cross entropy in bits a letter, and the language
that needs the fewest normalised phrases wins.

The automata's edges lie in one table for all languages (row displacement: a state is the
place of its row, an edge stands at state + symbol with its owner), so its size follows
the labelled text and not the alphabets; a failed step starts the next phrase at the root.
The pieces of all texts of a slice are parsed in step, one symbol of every piece and
language at a time. Texts are folded to the letters of all labelled texts and single
spaces; a letter that a language's own labelled text lacks is a phrase by itself there.
Texts are parsed whole, in pieces of ``PIECE`` symbols that each begin a phrase.

The labelled text is a bounded sample: ``SAMPLE_DOCS`` documents of a language are drawn by
hash of the id, each gives its first ``4 * SAMPLE_CHARS / SAMPLE_DOCS`` (1,000) characters, and
the first ``SAMPLE_CHARS`` (16,000) of these are kept, so with long documents about 16 of the
64 count. More than 16 languages share ``16 * SAMPLE_CHARS`` characters, at least 1,000 each.
Every labelled language is kept. One model holds ``GROUP`` languages at most; where there are more, the
sample stays a written table and a document is parsed against one group's model after the other
(a pass over the texts for each), the best of all groups deciding: the same results, with memory
bounded by a group, at the cost of the passes.

Defined cases: a null text and one without a letter give ``und`` and score 0; a null id is
never learned from and not held out; with nothing to learn from everything is ``und``;
ties go to the first language in code point order; repeated rows and further columns make
no difference; an empty table gives an empty result.
"""

from __future__ import annotations

import sys
from collections.abc import Collection, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranking import with_dense_id
from .common import id_crc32, materialize, pass_id, ship, stored, text_slices

PIECE = 1024
SAMPLE_DOCS = 64
SAMPLE_CHARS = 16_000
UNKNOWN = "und"
#: A kept text's language explains it in so many bits a letter, some phrases left aside.
MOST_BITS = 6.5
FREE_PHRASES = 4
#: Languages of one model; so many samples are on the driver and in a task at once.
GROUP = 256
_BEST = pa.list_(pa.struct([("bits", pa.float64()), ("lang", pa.string()), ("rest", pa.float64())]))
PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double"
_SPACE, _OTHER = 0, 1


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton (state 0 is the root)."""
    step, link, length, last = [{}], [-1], [0], 0
    for c in symbols:
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                twin = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return step


def displaced(rows: list[tuple[np.ndarray, int]]) -> tuple[np.ndarray, int]:
    """A place for every row (symbols, number), all different, so that no two edges meet; and the slots used.

    Long rows first, the short ones fill the holes; blocks without room are not tried again."""
    place = np.zeros(len(rows), np.int64)
    most = max((int(s[-1]) for s, _ in rows if len(s)), default=0) + 1
    slots = 2 * sum(len(s) for s, _ in rows) + 2 * len(rows) + most + 256
    used, taken, block, at, size = np.zeros(slots, bool), np.zeros(slots, bool), np.arange(128), 0, None
    for symbols, number in sorted(rows, key=lambda r: (-len(r[0]), r[1])):
        if len(symbols) != size:
            size = len(symbols)
            if size < 2:
                at = 0
        while True:
            if at + most + 256 > len(used):
                used, taken = (np.concatenate([x, np.zeros(len(x), bool)]) for x in (used, taken))
            free = ~taken[at:at + 128]
            for c in symbols if size < 8 else ():
                free &= ~used[at + c:at + c + 128]
            if size >= 8:
                free &= ~used[at + block[:, None] + symbols].any(axis=1)
            first = int(free.argmax())
            if free[first]:
                break
            at += 128
        place[number] = at + first
        taken[at + first] = True
        used[at + first + symbols] = True
    return place, int(place.max(initial=0)) + most


class LanguageModel:
    """``fold``: code point -> symbol; ``table``: state + symbol -> owner of the edge and next state;
    ``start``: language, symbol -> state after a new phrase and ended phrases."""

    SHIFT = 32

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(samples)
        letters = sorted(c for c in set("".join(samples.values()).lower()) if c.isalpha())
        self.width = len(letters) + 2
        number = {c: i + 2 for i, c in enumerate(letters)}
        kind = np.min_scalar_type(self.width)
        self.fold = np.fromiter((number.get(c.lower(), _OTHER) if c.isalpha() else _SPACE for c in map(chr, range(sys.maxunicode + 1))),
                                kind, sys.maxunicode + 1)
        steps, self.bits = [], []
        for lang in self.languages:
            symbols = self.symbols(samples[lang])
            steps.append(suffix_automaton(symbols.tolist()))
            self.bits.append(float(np.log2(len(symbols) + 2)))
        # A root has no row: its edges are in ``start``.
        offsets = np.cumsum([0, *map(len, steps)]).tolist()
        rows = [(np.array(sorted(edges) if s else [], np.int64), at + s) for at, step in zip(offsets, steps) for s, edges in enumerate(step)]
        place, slots = displaced(rows)
        self.table = np.full(slots, -1, np.int64)
        self.start = np.empty((len(steps), self.width), np.int64)
        self.roots = [int(place[at]) for at in offsets[:-1]]
        for k, (at, step) in enumerate(zip(offsets, steps)):
            # No way on: the symbol starts a new phrase, or is one by itself.
            self.start[k] = self.roots[k] + (1 << self.SHIFT)
            for c, t in step[0].items():
                self.start[k, c] = place[at + t]
            for s, edges in enumerate(step[1:], at + 1):
                own = int(place[s])
                for c, t in edges.items():
                    self.table[own + c] = own << self.SHIFT | int(place[at + t])

    def symbols(self, text: str) -> np.ndarray:
        """Folded symbols of a text: runs of anything but letters are one space."""
        s = self.fold[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
        keep = np.ones(len(s), bool)
        keep[1:] = (s[1:] != _SPACE) | (s[:-1] != _SPACE)
        return s[keep]

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases of each text in each language (texts x languages) and the texts' symbols."""
        flat = [self.symbols(t) for t in texts]
        sizes = np.array([len(x) for x in flat], np.int64)
        count = np.zeros((len(texts), len(self.languages)), np.int64)
        if not sizes.sum() or not self.languages:
            return count, sizes
        flat = np.concatenate(flat).astype(np.int64)
        pieces = -(-sizes // PIECE)
        owner = np.repeat(np.arange(len(texts)), pieces)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = np.repeat(np.cumsum(sizes) - sizes, pieces) + nth * PIECE
        length = np.minimum(PIECE, np.repeat(sizes, pieces) - nth * PIECE)
        order = np.argsort(-length, kind="stable")
        start, length, owner = start[order], length[order], owner[order]
        roots = np.array(self.roots, np.int64)[:, None]
        state = np.repeat(roots, len(owner), axis=1)
        ended = np.zeros_like(state)
        low = (1 << self.SHIFT) - 1
        alive = np.searchsorted(-length, -np.arange(length[0]), side="left")
        for t in range(length[0]):
            k = alive[t]
            here, symbol = state[:, :k], flat[start[:k] + t]
            edge, fresh = self.table[here + symbol], self.start[:, symbol]
            on = edge >> self.SHIFT == here
            ended[:, :k] += np.where(on, 0, (fresh >> self.SHIFT) + (here != roots))
            state[:, :k] = np.where(on, edge, fresh) & low
        ended += state != roots
        np.add.at(count, owner, ended.T)
        return count, sizes

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        lang, score, _ = self.judge(texts)
        return lang, score

    def judge(self, texts: list[str | None], free: int = 0) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language and score of each text, and the bits a letter that the language needs for all
        phrases but ``free`` ones (infinitely many bits without any language)."""
        count, sizes = self.phrases([t or "" for t in texts])
        known = np.array([bool(t) and any(map(str.isalpha, t)) for t in texts], bool)
        score = np.zeros(len(texts))
        if not self.languages:
            return [UNKNOWN] * len(texts), score, np.full(len(texts), np.inf)
        bits = count * np.array(self.bits) / np.maximum(sizes, 1)[:, None]
        best = bits.argmin(axis=1)
        if len(self.languages) > 1:
            first, second = np.partition(bits, 1, axis=1)[:, :2].T
            score[known] = (1 - first / np.maximum(second, 1e-12))[known]
        else:
            score[known] = 1.0
        rest = np.maximum(count[np.arange(len(texts)), best] - free, 0) * np.array(self.bits)[best] / np.maximum(sizes, 1)
        return [self.languages[b] if k else UNKNOWN for b, k in zip(best, known)], score, rest


class LanguageGroups:
    """More languages than one model holds: a written sample (group, lang, nth, text) from which the
    models of ``GROUP`` languages at a time are made, one after the other."""

    def __init__(self, sample: DataFrame, groups: int, share: int):
        self.sample, self.groups, self.share = sample, groups, share

    def model(self, group: int) -> LanguageModel:
        return _model(self.sample.filter(F.col("group") == group), self.share)


def _model(sample: DataFrame, share: int) -> LanguageModel:
    parts: dict[str, list[str]] = {}
    for r in sample.orderBy("lang", "nth").select("lang", "text").collect():
        parts.setdefault(r["lang"], []).append(r["text"])
    return LanguageModel({lang: "".join(f" {t}" for t in texts)[:share] for lang, texts in parts.items()})


def learn_languages(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS,
                    group: int = GROUP) -> LanguageModel | LanguageGroups:
    """The languages of ``docs`` (doc_id, text, lang), held-out documents left aside: a model of all
    of them, or beyond ``group`` languages one for each group."""
    rows = docs.select("doc_id", "text", "lang").filter(
        F.col("lang").isNotNull() & (F.col("lang") != UNKNOWN) & F.col("text").rlike(r"\p{L}") & (id_crc32() % 4 != 2))
    # Top rows of each language: Spark keeps sample_docs rows a language and task before the shuffle.
    pick = Window.partitionBy("lang").orderBy("draw", "doc_id", "text")
    chosen = (rows.select("lang", "doc_id", F.substring("text", 1, 4 * sample_chars // sample_docs).alias("text"),
                          F.xxhash64(F.col("doc_id")).alias("draw"))
              .withColumn("nth", F.row_number().over(pick)).filter(F.col("nth") <= sample_docs).select("lang", "nth", "text"))
    chosen = materialize(chosen, "language-sample")
    number = chosen.select("lang").distinct().count()
    share = max(1000, min(sample_chars, 16 * sample_chars // max(1, number)))
    if number <= group:
        return _model(chosen, share)
    named = with_dense_id(chosen.select("lang").distinct(), ["lang"])
    placed = chosen.join(named, "lang").withColumn("group", F.floor((F.col("id") - 1) / group).cast("int")).drop("id")
    return LanguageGroups(materialize(placed, "language-groups"), -(-number // group), share)


def _judged(docs: DataFrame, models: LanguageGroups, free: int) -> DataFrame:
    """row, lang, score and rest (see ``LanguageModel.judge``) of every row of ``docs`` (row, text):
    a pass for each group, whose two best languages are written, then the best of all."""
    spark = docs.sparkSession
    ship(spark)
    passes = None
    for g in range(models.groups):
        shared = spark.sparkContext.broadcast(models.model(g))

        def parse(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            model = shared.value
            for batch in text_slices(batches):
                texts = [t or "" for t in batch.column("text").to_pylist()]
                count, sizes = model.phrases(texts)
                bits = count * np.array(model.bits) / np.maximum(sizes, 1)[:, None]
                rest = np.maximum(count - free, 0) * np.array(model.bits) / np.maximum(sizes, 1)[:, None]
                best = np.argsort(bits, axis=1, kind="stable")[:, :2]
                here = [[{"bits": float(bits[i, k]), "lang": model.languages[k], "rest": float(rest[i, k])} for k in ks]
                        if any(map(str.isalpha, t)) else [] for i, (t, ks) in enumerate(zip(texts, best.tolist()))]
                yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(here, _BEST)], ["row", "best"])

        found = materialize(docs.mapInArrow(parse, "row long, best array<struct<bits:double,lang:string,rest:double>>"), "language-pass")
        shared.unpersist()
        passes = found if passes is None else passes.unionByName(found)
    # At most two of each group.
    best = passes.groupBy("row").agg(F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, 2).alias("b"))
    first, second = F.get("b", F.lit(0)), F.get("b", F.lit(1))
    score = 1 - first["bits"] / F.greatest(second["bits"], F.lit(1e-12))
    return best.select("row", F.coalesce(first["lang"], F.lit(UNKNOWN)).alias("lang"), F.coalesce(score, F.lit(0.0)).alias("score"),
                       F.coalesce(first["rest"], F.lit(float("inf"))).alias("rest"))


def predict_language(docs: DataFrame, model: LanguageModel | LanguageGroups) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""
    held = F.coalesce(id_crc32() % 4 == 2, F.lit(False))
    if isinstance(model, LanguageGroups):
        rows = pass_id(stored(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), "documents"), "row")
        found = rows.select("row", "doc_id", held.alias("held_out")).join(_judged(rows.select("row", "text"), model, 0), "row")
        return found.select("doc_id", "held_out", F.col("lang").alias("lang_pred"), "score")
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            lang, score = shared.value.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(lang, pa.string()), pa.array(score)],
                ["doc_id", "held_out", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), held.alias("held_out"), F.col("text").cast("string")).mapInArrow(predict, PREDICTED)


def keep_languages(docs: DataFrame, model: LanguageModel | LanguageGroups, wanted: Collection[str] | None = None, most_bits: float = MOST_BITS,
                   free: int = FREE_PHRASES) -> DataFrame:
    """The rows of ``docs`` (all columns) whose text is in one of the ``wanted`` languages (by
    default any learned one): their language needs the fewest phrases, and, but for ``free`` ones that
    decide nothing in short texts, at most ``most_bits`` bits a letter. Texts of other languages
    and of random letters need more than that in every language; they go, whatever their ``lang``
    says, and so do texts without a letter."""
    if isinstance(model, LanguageGroups):
        rows = pass_id(docs := stored(docs, "documents"), "_llm_row")
        found = _judged(rows.select(F.col("_llm_row").alias("row"), "text"), model, free)
        found = found.filter((F.col("lang") != UNKNOWN) & (F.col("rest") <= most_bits))
        found = found if wanted is None else found.filter(F.col("lang").isin(*wanted))
        return rows.join(found.select(F.col("row").alias("_llm_row")), "_llm_row", "left_semi").select(*docs.columns)
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    good = None if wanted is None else frozenset(wanted)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            lang, _, bits = shared.value.judge(batch.column("text").to_pylist(), free)
            yield batch.filter(pa.array([x != UNKNOWN and (good is None or x in good) and b <= most_bits for x, b in zip(lang, bits.tolist())]))

    return docs.mapInArrow(keep, docs.schema)
