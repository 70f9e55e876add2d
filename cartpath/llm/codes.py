"""Vector code compression by ball k-means (operator 13).

A vector becomes integers, ``floor(4096 x)``, and is cut into 8 equal parts; each part position
has a codebook of up to 16 entries that k-means refines, and a vector's code is its parts'
nearest entries. Everything is exact in integers, ties go to the lower index.

Ball k-means: the parts that belong to an entry form a ball whose radius is the largest
distance to the entry. After the entries have moved,

* another entry can win a part of the ball only if half its distance to the ball's entry does
  not exceed the radius: these are the neighbour entries, nearest first;
* a part nearer to its entry than half the distance of the nearest neighbour is in the stable
  core and stays without any comparison;
* the rest lies in rings between half distances: a part in the ring behind the m-th neighbour is
  compared with the first m neighbours only.

With ``<=`` throughout the result equals a full comparison, equal distances included. Radii are
those of the whole table: each round leaves, beside the sums, the largest distance of each
entry's parts; by the triangle inequality the ball's radius around the moved entry is at most
that plus the move.

A round is one pass: it reads the vectors with their codes as written by the last one,
and writes them with new codes together with sums of each batch (a handful of rows a batch,
added up by Spark). The driver holds only codebooks: 8 x 16 entries. Older rounds are
deleted as soon as the next one is written.

Defined cases: rows whose vector is null or has a null or non-finite component go; null ids
come last and equal ids go by their components when the first entries are chosen; vectors
have the length of the first kept one, rows of another length go (so do empty vectors); a
length that 8 does not divide is filled up with zeros; tables of fewer than 16 vectors have
smaller codebooks; components so large that squared distances would not fit a long raise; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.materialize import discard
from .common import materialize, ship

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Labels up to this many are broadcast (16 bytes each); beyond it their sums are joined by a shuffle.
FEW_LABELS = 100_000
SALTS = 64
#: Components of one pass over an Arrow batch.
SLICE_VALUES = 1 << 20

STATE = ("kind int, vec_id long, label long, vector binary, code binary, error long, "
         "part int, entry int, n long, sums array<long>, far long")


def kept_vectors(rows: DataFrame) -> DataFrame:
    """vec_id, label and vector of the rows with a vector of finite components."""
    found = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                        F.col("embedding").cast("array<double>").alias("vector"))
    return found.filter(F.col("vector").isNotNull() & _finite("vector"))


def _finite(name: str):
    """Whether an array (not null) has components, none of them null, NaN or infinite."""
    bad = F.exists(name, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (F.size(name) > 0) & ~F.coalesce(bad, F.lit(True))


def _first(vectors: DataFrame):
    ints = F.transform("vector", lambda x: F.floor(x * SCALE).cast("long"))
    return vectors.select("vec_id", ints.alias("v")).orderBy(F.col("vec_id").asc_nulls_last(), "v")


def first_entries(vectors: DataFrame) -> np.ndarray:
    """Codebooks (parts, entries, components) from the vectors of the smallest ids."""
    found = [r.v for r in _first(vectors).limit(ENTRIES).collect()]
    width = -(-len(found[0]) // PARTS)
    filled = [v + [0] * (width * PARTS - len(v)) for v in found]
    return np.array(filled, np.int64).reshape(len(found), PARTS, width).transpose(1, 0, 2)


def _squares(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    d = x - centre
    return np.einsum("...j,...j->...", d, d)


class Balls:
    """The entries of one part position, their balls and neighbours."""

    def __init__(self, entries: np.ndarray, radius: np.ndarray):
        """``radius``: of each entry's ball, rounded up."""
        self.entries = entries
        between = _squares(entries[:, None, :], entries[None, :, :])
        self.near = []
        for i, row in enumerate(between):
            # Half the distance to a neighbour is within the radius: d^2 <= (2 r)^2.
            reach = [(int(d), j) for j, d in enumerate(row.tolist()) if j != i and d <= 4 * int(radius[i]) ** 2]
            reach.sort()
            self.near.append((np.array([d for d, _ in reach], np.int64), [j for _, j in reach]))

    def assign(self, x: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entries and squared distances of parts ``x`` that belonged to ``code``."""
        own = _squares(x, self.entries[code])
        out, least = code.copy(), own.copy()
        for i in np.unique(code):
            half, ids = self.near[i]
            if not ids:
                continue
            ball = np.flatnonzero(code == i)
            # The ring of a part: how many neighbours have half their distance within its own.
            rings = np.searchsorted(half, 4 * own[ball], side="right")
            ball = ball[rings > 0]  # the others are the stable core
            rings = rings[rings > 0]
            for m, j in enumerate(ids):
                ball, rings = ball[rings > m], rings[rings > m]
                if not len(ball):
                    break
                d = _squares(x[ball], self.entries[j])
                better = (d < least[ball]) | ((d == least[ball]) & (j < out[ball]))
                who = ball[better]
                out[who], least[who] = j, d[better]
        return out, least


def full_search(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entries and squared distances, compared with every entry."""
    d = np.stack([_squares(x, e) for e in entries], axis=-1)
    code = d.argmin(axis=-1)
    return code, np.take_along_axis(d, code[..., None], axis=-1)[..., 0]


def _integers(vectors: pa.Array, width: int) -> np.ndarray:
    """Components (rows, parts, width) of lists of doubles."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    x = np.floor(flat.reshape(len(vectors), -1) * SCALE)
    # Sums of `parts * width` squares of differences must fit a long.
    most = math.isqrt((1 << 62) // (PARTS * width)) // 2
    if x.size and np.abs(x).max() > most:
        raise ArithmeticError(f"components beyond {most / SCALE} have distances that do not fit a long")
    out = np.zeros((len(x), PARTS * width), np.int64)
    out[:, :x.shape[1]] = x
    return out.reshape(len(x), PARTS, width)


def _round(rows: DataFrame, entries: np.ndarray, radius: np.ndarray | None, name: str) -> tuple[DataFrame, DataFrame]:
    """One assignment: the written vectors with codes, and (part, entry, n, sums, far) of their parts.
    ``rows``: vec_id, label, vector (doubles) at first, else the vectors of the last round."""
    width, first = entries.shape[2], radius is None

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        balls = None if first else [Balls(entries[p], radius[p]) for p in range(PARTS)]
        size = max(1, SLICE_VALUES // (PARTS * width))
        sums = np.zeros(entries.shape, object)  # whole numbers without a bound
        count, far = np.zeros(entries.shape[:2], np.int64), np.zeros(entries.shape[:2], np.int64)
        for batch in (b.slice(a, size) for b in batches for a in range(0, b.num_rows, size)):
            n = batch.num_rows
            if first:
                x = _integers(batch.column("vector"), width)
                old = np.zeros((n, PARTS), np.int64)
            else:
                x = np.frombuffer(b"".join(batch.column("vector").to_pylist()), np.int64).reshape(n, PARTS, width)
                old = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(n, PARTS).astype(np.int64)
            code, error = np.zeros((n, PARTS), np.uint8), np.zeros(n, np.int64)
            for p in range(PARTS):
                own, d = full_search(x[:, p], entries[p]) if first else balls[p].assign(x[:, p], old[:, p])
                code[:, p] = own
                error += d
                np.maximum.at(far[p], own, d)
                count[p] += np.bincount(own, minlength=entries.shape[1])
                some = np.zeros(entries.shape[1:], np.int64)
                np.add.at(some, own, x[:, p])
                sums[p] += some
            blank = {f: pa.nulls(n, t) for f, t in (("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64())), ("far", pa.int64()))}
            yield pa.RecordBatch.from_pydict({
                "kind": pa.array(np.zeros(n, np.int32)), "vec_id": batch.column("vec_id"), "label": batch.column("label"),
                "vector": pa.array([r.tobytes() for r in x], pa.binary()), "code": pa.array([r.tobytes() for r in code], pa.binary()),
                "error": pa.array(error), **blank})
        used = [(p, e) for p, e in zip(*np.nonzero(count))]
        n = len(used)
        blank = {f: pa.nulls(n, t) for f, t in (("vec_id", pa.int64()), ("label", pa.int64()), ("vector", pa.binary()), ("code", pa.binary()), ("error", pa.int64()))}
        yield pa.RecordBatch.from_pydict({
            "kind": pa.array(np.ones(n, np.int32)), **blank,
            "part": pa.array([p for p, _ in used], pa.int32()), "entry": pa.array([e for _, e in used], pa.int32()),
            "n": pa.array([int(count[u]) for u in used], pa.int64()), "sums": pa.array([[int(s) for s in sums[u]] for u in used], pa.list_(pa.int64())),
            "far": pa.array([int(far[u]) for u in used], pa.int64())})

    if first:
        rows = rows.select("vec_id", "label", "vector")
    done = materialize(rows.mapInArrow(work, STATE), name, partition_by="kind")
    state = done.filter("kind = 0").select("vec_id", "label", "vector", "code", "error")
    return state, done.filter("kind = 1").select("part", "entry", "n", "sums", "far")


def _moved(entries: np.ndarray, found: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The entries at the floor of their parts' mean, and a bound of each ball's radius around them."""
    width = entries.shape[2]
    total = found.groupBy("part", "entry").agg(
        F.sum(F.col("n").cast("decimal(38,0)")).alias("n"), F.max("far").alias("far"),
        F.array(*[F.sum(F.col("sums")[i].cast("decimal(38,0)")) for i in range(width)]).alias("sums"))
    new, radius = entries.copy(), np.zeros(entries.shape[:2], np.int64)
    for r in total.collect():  # at most PARTS * ENTRIES rows
        new[r.part, r.entry] = [int(s) // int(r.n) for s in r.sums]
        shift = int(_squares(new[r.part, r.entry], entries[r.part, r.entry]))
        radius[r.part, r.entry] = math.isqrt(r.far) + 1 + math.isqrt(shift) + 1
    return new, radius


def codebooks_sha256(entries: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, entries.ravel().tolist())).encode()).hexdigest()


def with_label_sums(rows: DataFrame) -> DataFrame:
    """``rows`` (a written table) with label_error, the sum of ``error`` over equal labels, null being one."""
    sums = materialize(rows.groupBy("label").agg(F.sum("error").cast("long").alias("label_error")), "label-errors")
    same = F.col("label").eqNullSafe(F.col("other"))
    sums = sums.withColumnRenamed("label", "other")
    if sums.count() <= FEW_LABELS:
        return rows.join(F.broadcast(sums), same).drop("other")
    # A label may hold a large share of all rows: deal them over salts.
    salted = sums.withColumn("salt2", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int"))
    return rows.join(salted, (F.col("salt") == F.col("salt2")) & same).drop("other", "salt", "salt2")


def compress_vectors(rows: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error, label_error) of every kept row, ``code`` being one byte a part,
    and the final codebooks. ``rows``: vec_id, embedding, label."""
    spark = rows.sparkSession
    ship(spark)
    vectors = kept_vectors(rows)
    least = _first(vectors).first()
    if least is None:
        return spark.createDataFrame([], "vec_id long, label long, code binary, error long, label_error long"), np.zeros((PARTS, 0, 0), np.int64)
    vectors = vectors.filter(F.size("vector") == len(least.v))
    entries = first_entries(vectors)
    state, radius = vectors, None
    for k in range(rounds + 1):
        last, (state, found) = state, _round(state, entries, radius, f"codes-{k}")
        discard(last)
        if k < rounds:
            entries, radius = _moved(entries, found)
    coded = state.select("vec_id", "label", "code", "error")
    return with_label_sums(coded), entries
