"""Document fingerprints from Lempel-Ziv phrases (operator 8).

A text's bytes are parsed into dictionary phrases (each the longest known phrase and one
byte more), the phrases are hashed, and the ``SIZE`` smallest hashes are the fingerprint.
The likeness of two fingerprints is the share of common hashes among the smallest of both,
an estimate of the common share of their phrase sets, which is high where one text would
compress the other. The dictionary starts anew every ``WINDOW`` bytes, so memory is
bounded for any text.

``neighbours`` also edits each text with the start of the next document in id order. A row's
place is its id, its text's hash and its number in the scan. Spark ranges the places (narrow rows, no
text), and each range's first place is the border from which a vectorised search gives every row
its range; so a text is shuffled once and read next to its successor, and null ids, repeated ids and
repeated rows spread over ranges like all others. The first row of a range is sent to the range
before it too. The borders are 32 bytes a range, beside the plan, which does not grow with them.

Defined cases: null and empty texts have no phrases and an empty fingerprint; two empty
fingerprints have likeness 1, an empty and another 0; equal ids are ordered by text, null
ids come last; a single document is its own successor; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import shuffle_partitions
from .common import pass_id, ship, stored, text_slices

SIZE = 64
WINDOW = 1 << 20
MARKED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_M = (1 << 62) - 1


class PhraseParser:
    """Parses bytes fed in parts; ``copy`` branches off with what has been parsed."""

    __slots__ = ("at", "fed", "hashes", "known", "least")

    def __init__(self):
        self.known: dict[int, int] = {}
        self.at, self.fed = 0, 0
        self.hashes: list[int] = [0]
        self.least = np.zeros(0, np.uint32)

    def copy(self) -> PhraseParser:
        other = PhraseParser()
        other.known, other.at, other.fed = self.known.copy(), self.at, self.fed
        other.hashes, other.least = self.hashes.copy(), self.least
        return other

    def feed(self, data: bytes) -> PhraseParser:
        while data:
            part, data = data[:WINDOW - self.fed], data[WINDOW - self.fed:]
            known, hashes, at = self.known, self.hashes, self.at
            get, n = known.get, len(known)
            for c in part:
                key = at << 8 | c
                at = get(key)
                if at is None:
                    n += 1
                    known[key] = n
                    at = 0
                    # The parent's number is in the key, its hash in the list.
                    hashes.append((hashes[key >> 8] * 0x2545F4914F6CDD1D + c + 1) & _M)
            self.at, self.fed = at, self.fed + len(part)
            if self.fed == WINDOW:
                self.least = self.fingerprint()
                self.known, self.at, self.fed, self.hashes = {}, 0, 0, [0]
        return self

    def fingerprint(self) -> np.ndarray:
        """The smallest phrase hashes, ascending."""
        h = np.array(self.hashes[1:], np.uint64)
        h ^= h >> np.uint64(31)
        h *= np.uint64(0x9E3779B97F4A7C15)
        return np.unique(np.concatenate([self.least, (h >> np.uint64(32)).astype(np.uint32)]))[:SIZE]


def fingerprint(text: str | None) -> np.ndarray:
    return PhraseParser().feed((text or "").encode()).fingerprint()


def as_text(mark: np.ndarray) -> str:
    return mark.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.sort(np.concatenate([a, b]))
    twice = both[1:][both[1:] == both[:-1]]
    least = np.unique(both)[:SIZE]
    return float(np.searchsorted(twice, least[-1], side="right") / len(least))


class _Document:
    """A document on its way: parsed whole, and branched off where its edit begins."""

    def __init__(self, doc_id, text: str):
        self.doc_id, self.n = doc_id, len(text)
        self.text, self.half = text, len(text) // 2
        parser = PhraseParser().feed(text[:self.n - self.half].encode())
        self.branch = parser.copy()
        self.mark = parser.feed(text[self.n - self.half:].encode()).fingerprint()

    def beside(self, following: _Document) -> tuple:
        start = following.text[:self.half]
        edited = self.branch.feed(start.encode()).fingerprint()
        digest = hashlib.sha256((self.text[:self.n - self.half] + start).encode()).hexdigest()
        return (self.doc_id, self.n, digest, as_text(self.mark), as_text(edited), likeness(self.mark, edited),
                likeness(self.mark, following.mark))


PLACE = ["none", "id", "hash", "turn"]


def _placed(docs: DataFrame) -> DataFrame:
    """doc_id, text and the place of every row: ids ascending, null last, then the text's hash and the row's number."""
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return pass_id(rows, "turn").select("doc_id", "text", F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"),
                                        F.xxhash64("text").alias("hash"), "turn")


def _heads(rows: DataFrame, ranges: int) -> np.ndarray:
    """The first places of about ``ranges`` ranges of equal numbers of rows (one column a range,
    ascending): Spark ranges the places alone, and each range's least place is kept."""
    dealt = rows.select(*PLACE).repartitionByRange(ranges, *PLACE)
    least = dealt.groupBy(F.spark_partition_id().alias("range")).agg(F.min(F.struct(*PLACE)).alias("place"))
    found = least.select("place.*").toArrow()
    heads = np.stack([found.column(c).to_numpy().astype(np.int64) for c in PLACE])
    return heads[:, np.lexsort(heads[::-1])]


def _numbers(heads: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The range of each place (both arrays have a column a place) and whether it is the range's first one."""
    k = heads.shape[1]
    both = np.concatenate([heads, places], axis=1)
    later = np.arange(both.shape[1]) >= k  # a head stands before its own row
    order = np.lexsort((later, *both[::-1]))
    number = np.empty(both.shape[1], np.int64)
    number[order] = np.cumsum(~later[order]) - 1
    number = number[k:]
    return number, (heads[:, np.maximum(number, 0)] == places).all(axis=0)


def neighbours(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Fingerprints of every text of ``docs`` and of its edit with the next
    document, and their likeness."""
    spark = docs.sparkSession
    ship(spark)
    ranges = ranges or 4 * shuffle_partitions(spark)
    rows = _placed(stored(docs.select("doc_id", "text"), "documents"))
    heads = _heads(rows, ranges)
    if not heads.size:
        return spark.createDataFrame([], MARKED)
    shared = spark.sparkContext.broadcast(heads)  # 32 bytes a range

    @F.pandas_udf("range int, head boolean")
    def number(none: pd.Series, id_: pd.Series, hash_: pd.Series, turn: pd.Series) -> pd.DataFrame:
        n, first = _numbers(shared.value, np.stack([none.to_numpy().astype(np.int64), *(x.to_numpy() for x in (id_, hash_, turn))]))
        return pd.DataFrame({"range": n.astype(np.int32), "head": first})

    rows = rows.withColumn("at", number(*PLACE))
    # A range's first row goes to the range before it too.
    before = F.pmod(F.col("at.range") - 1, F.lit(heads.shape[1]))
    rows = rows.select("doc_id", "text", *PLACE, F.col("at.range").alias("range"), F.when(F.col("at.head"), before).alias("before"))
    targets = F.array_compact(F.array(F.struct(F.col("range").alias("range"), F.lit(0).alias("extra")),
                                      F.when(F.col("before").isNotNull(), F.struct(F.col("before").alias("range"), F.lit(1).alias("extra")))))
    rows = rows.select("doc_id", "text", *PLACE, F.explode(targets).alias("to")).select("to.range", "to.extra", "doc_id", "text", *PLACE)
    rows = rows.repartition(ranges, "range").sortWithinPartitions("range", "extra", *PLACE)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in MARKED.split(", ")]
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        held, at, paired = None, None, False
        for batch in text_slices(batches):
            out = []
            for r, extra, doc, text in zip(*(batch.column(c).to_pylist() for c in ("range", "extra", "doc_id", "text"))):
                if r != at:
                    held, at, paired = None, r, False
                if extra and paired:
                    continue  # a copy of the row that the range's last one has met
                here = _Document(doc, text)
                if held is not None:
                    out.append(held.beside(here))
                held, paired = here, bool(extra)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    return rows.select("range", "extra", "doc_id", "text").mapInArrow(mark, MARKED)
