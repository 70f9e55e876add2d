"""Filter interaction audit by Hart and Mas-Colell's potential (operator 12).

Five filters, A to E, may remove a document. In the removal game of a part of the corpus a
coalition of filters is worth the number of documents that it removes. The potential of
a coalition S is defined recursively, ``P({}) = 0`` and ``|S| P(S) = v(S) + sum over i in S of
P(S without i)``; the Shapley value of a filter is ``P(all) - P(all without it)``, and what a
filter removes at a step of an order is the difference of two coalitions' worths.

All of it follows from how many documents fail exactly which filters: 32 counts a part.

1. Failure flags from built-in functions, one pass over the texts, which leave as a digest.
2. Labels by id, then one row for each (id, text, part, flags, labels) and, summed, for each
   (text, part, flags, labels) with the least id: copies of a text become few rows before the
   least id of a text is looked up, so a text that a third of all rows hold is no hot key.
3. 32 counts a part, and from them the potentials and the 120 orders' 600 steps of every
   part, vectorised over parts.

Defined cases: a null text is the empty text; an id that is null is not smaller or larger than
any other (such a document never fails E, nor makes others fail); rows of one id do not
make each other fail; a document has a label if any row of ``labels`` for its id says 1; a
null source is the part ``''``; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, ship

FILTERS = "ABCDE"
ALL = (1 << len(FILTERS)) - 1
ORDERS = ["".join(p) for p in permutations(FILTERS)]
STEPS = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
         "good_lost long, toxic_lost long, shapley long")
#: Parts whose steps are made at once.
SLICE = 256

# Fixed values of the filters.
LEAST_WORDS = 200
DISTINCT_PERCENT = 50
CAPITAL_PERCENT = 2
SYMBOLS = "#$%&*|"


def text_flags(text: Column) -> Column:
    """Bits of the filters A to D that a text (not null) fails."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n_words, n_distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    failed = [n_words < LEAST_WORDS, 100 * n_distinct < DISTINCT_PERCENT * n_words,
              100 * capitals > CAPITAL_PERCENT * F.length(text), text.rlike(f"[{SYMBOLS}]")]
    return sum((f.cast("int") * (1 << i) for i, f in enumerate(failed[1:], 1)), failed[0].cast("int"))


def failure_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, flags, n, good, toxic): documents of a part that fail exactly the filters of ``flags``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("part"),
                       F.unhex(F.sha2(text, 256)).alias("text"), text_flags(text).alias("flags"))
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    rows = rows.join(marks, "doc_id", "left").na.fill(0, ["good", "toxic"])
    alike = ["text", "part", "flags", "good", "toxic"]
    ids = rows.groupBy("doc_id", *alike).agg(F.count(F.lit(1)).alias("n"))
    # Rows without id, of the least id, and all.
    copies = materialize(ids.groupBy(*alike).agg(
        F.min("doc_id").alias("low"), F.coalesce(F.min_by("n", "doc_id"), F.lit(0)).alias("n_low"), F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("n_null")), "copies")
    least = copies.groupBy("text").agg(F.min("low").alias("least"))
    found = copies.join(least, "text").withColumn(
        "first", F.col("n_null") + F.when(F.col("low") == F.col("least"), F.col("n_low")).otherwise(0))
    repeat = 1 << FILTERS.index("E")
    both = F.array(F.struct(F.col("flags").alias("flags"), F.col("first").alias("n")),
                   F.struct((F.col("flags") + repeat).alias("flags"), (F.col("n") - F.col("first")).alias("n")))
    each = found.select("part", "good", "toxic", F.explode(both).alias("e")).select("part", "good", "toxic", "e.flags", "e.n")
    return each.groupBy("part", "flags").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic"))


def worths(counts: np.ndarray) -> np.ndarray:
    """Worth of each coalition (last axis): rows that fail one of its filters."""
    within = counts.copy()  # rows whose failures all lie in the coalition
    coalitions = np.arange(ALL + 1)
    for i in range(len(FILTERS)):
        has = coalitions[coalitions >> i & 1 == 1]
        within[..., has] += within[..., has ^ 1 << i]
    # Rows that none of the coalition's filters removes fail filters outside only.
    return within[..., [ALL]] - within[..., ALL ^ coalitions]


def potentials(worth: np.ndarray, scale: int) -> np.ndarray:
    """``scale`` times the potential of each coalition, recursively from the smaller ones;
    exact in integers when ``scale`` is a multiple of 60 (the least common multiple of 1 to 5)."""
    p = np.zeros_like(worth)
    for s in sorted(range(1, ALL + 1), key=int.bit_count):
        smaller = sum(p[..., s ^ 1 << i] for i in range(len(FILTERS)) if s >> i & 1)
        p[..., s] = (scale * worth[..., s] + smaller) // s.bit_count()
    return p


def _order_steps():
    """For each order and step: the coalition before it, its filter, and the filter's own coalition."""
    before, index = [], []
    for order in ORDERS:
        done = 0
        for letter in order:
            i = FILTERS.index(letter)
            before.append(done)
            index.append(i)
            done |= 1 << i
    return np.array(before), np.array(index)


def steps(n: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> dict[str, np.ndarray]:
    """The columns of all orders' steps, from the 32 counts of each part (arrays parts x 32)."""
    before, index = _order_steps()
    own = 1 << index
    after = before | own
    v, total = worths(n), n.sum(axis=1, keepdims=True)
    p = potentials(v, len(ORDERS))
    removed = v[:, after] - v[:, before]
    vg, vt = worths(good), worths(toxic)
    return {"kept": total - v[:, after], "removed": removed, "redundant": v[:, own] - removed, "unique_fails": v[:, [ALL]] - v[:, ALL ^ own],
            "good_lost": vg[:, after] - vg[:, before], "toxic_lost": vt[:, after] - vt[:, before], "shapley": p[:, [ALL]] - p[:, ALL ^ own]}


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part, order of the filters and step (see ``STEPS``)."""
    cells = F.map_from_entries(F.collect_list(F.struct("flags", F.struct("n", "good", "toxic"))))
    parts = failure_counts(docs, labels).groupBy("part").agg(cells.alias("cells"))

    def by_flags(name: str) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(ALL)), lambda s: F.coalesce(F.try_element_at("cells", s)[name], F.lit(0))).alias(name)

    parts = parts.select("part", *map(by_flags, ("n", "good", "toxic")))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders = pa.array(np.repeat(ORDERS, len(FILTERS)))
        numbers = np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(ORDERS))
        for batch in batches:
            for a in range(0, batch.num_rows, SLICE):
                some = batch.slice(a, SLICE)
                table = steps(*(np.array(some.column(c).to_pylist(), np.int64) for c in ("n", "good", "toxic")))
                k = some.num_rows
                yield pa.RecordBatch.from_arrays(
                    [some.column("part").take(pa.array(np.repeat(np.arange(k), len(numbers)))), orders.take(pa.array(np.tile(np.arange(len(orders)), k))),
                     pa.array(np.tile(numbers, k)), *(pa.array(x.ravel()) for x in table.values())],
                    ["part", "filter_order", "step", *table])

    ship(docs.sparkSession)
    return parts.mapInArrow(make, STEPS)
