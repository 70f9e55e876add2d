"""Substring dedup by seed and extend (operator 11).

A passage of ``WORDS`` words or more that a document shares with one of smaller id is
removed from it, word by word; passages are judged on the texts as they came.

1. Seeds. Every run of ``words`` words has one anchor: the least hash among its
   ``seed_words``-grams (winnowing), so equal runs have equal anchors wherever they stand.
   A block of documents (one slice of the scan) sends its distinct anchors with the least
   and largest id that hold them; anchors of at least two documents are seeds.
2. Extend. Around a seed the match grows both ways to every run of ``words`` words whose
   anchor it is. Runs are hashed and joined with all other documents' by the least id that
   holds them. Only a block's first holder of a run takes part, the others are decided
   where they stand, so neither groups of copies nor common phrases give long groups, and no
   pair of documents is ever made.
3. Consecutive matched runs are one maximal repeat, and only those that some smaller
   document holds are kept; their words go.

Everything travels as packed columns, a row for a block and a bucket of hashes: keys one
way, one bit a key back. Texts travel compressed, by block, once for step 2 and once for
step 3. Run keys are 64 bits of one hash inside a bucket of another one, so with more
buckets (they follow ``spark.sql.shuffle.partitions``) the key grows too: at 10^13 words and
120,000 partitions about 20 runs are expected to meet a wrong partner, here none. Words are
hashed to 64 bits by a polynomial over their bytes.

Defined cases: null and wordless texts have no words and keep the empty text; an id that is
null is neither smaller nor larger than another, so such a document stays whole and
removes nothing; rows of one id do not remove each other's passages; a passage that
repeats in one document only stays; texts shorter than ``words`` words stay; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import shuffle_partitions
from .common import materialize, pass_id, ship, stored, text_slices

WORDS = 13
SEED_WORDS = 4
#: Buckets of hashes for each shuffle partition.
BUCKETS = 4
#: Bytes of text in a block, about.
BLOCK_BYTES = 6 << 20
#: Bytes whose words are hashed at once.
HASH_BYTES = 2 << 20

PACKED = "bucket int, block long, base long, keys binary, low binary, many binary"
ANSWERS = "block long, kind int, bucket int, data binary"
REPEATS = "row long, doc_id long, n_words long, n_removed long, repeats array<struct<start:long,length:long>>, kept string"


_BASE = 0x9E3779B97F4A7C13
_BYTES = np.random.default_rng(11).integers(1, 1 << 64, 256, np.uint64, endpoint=False)
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the words ``raw[start:end]`` (sorted, apart): the bytes' polynomial mod 2^64, all
    words of a stretch at once by prefix sums, brought to the same place by the inverse base."""
    out = np.zeros(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        a = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, a + HASH_BYTES, side="right")))
        sums = np.zeros(int(ends[j - 1]) - a + 1, np.uint64)
        n = len(sums) - 1
        np.cumsum(_BYTES[raw[a:a + n]] * _power(n)[0][:n], out=sums[1:])
        begin = starts[i:j] - a
        out[i:j] = (sums[ends[i:j] - a] - sums[begin]) * _power(n)[1][begin]
        i = j
    return _mix(out + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


_cached: list[np.ndarray] = []


def _power(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of each."""
    if not _cached or len(_cached[0]) < n:
        size = max(n, HASH_BYTES)
        made = [_powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size)]
        if size > HASH_BYTES:  # a huge word
            return made
        _cached[:] = made
    return _cached


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def anchors(hashes: np.ndarray, words: int, seed_words: int) -> np.ndarray:
    """The anchor of each run of ``words`` words: its least ``seed_words``-gram hash."""
    grams = np.zeros(len(hashes) - seed_words + 1, np.uint64)
    for i in range(seed_words):
        grams = _mix(grams + hashes[i:len(grams) + i] * np.uint64(2 * i + 3))
    # Least of a sliding window of `left` grams, by doubling.
    left, width = words - seed_words + 1, 1
    while 2 * width <= left:
        grams = np.minimum(grams[:-width], grams[width:])
        width *= 2
    rest = left - width
    return np.minimum(grams[:-rest], grams[rest:]) if rest else grams


def run_hashes(hashes: np.ndarray, at: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of the runs of ``words`` words that start ``at``."""
    one, two = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)
    for i in range(words):
        h = hashes[at + i]
        one = _mix(one + h * np.uint64(2 * i + 3))
        two = two * np.uint64(0x9E3779B97F4A7C15) + h
    return one, two


class Block:
    """The documents of one slice: their words, and the runs that start in them."""

    def __init__(self, ids: pa.Array, texts: pa.Array, words: int, seed_words: int):
        self.words = words
        binary = texts.cast(pa.binary()).fill_null(b"")
        self.cuts = np.frombuffer(binary.buffers()[1], np.int32)[binary.offset:binary.offset + len(binary) + 1].astype(np.int64)
        low = int(self.cuts[0])
        self.raw = np.frombuffer(binary.buffers()[2] or b"", np.uint8)[low:int(self.cuts[-1])]
        self.cuts -= low
        # A word starts at a byte that is no space, behind a space or at a text's start.
        self.solid = ~_SPACE[self.raw]
        border = np.zeros(len(self.raw) + 1, bool)
        border[self.cuts] = True
        begins = self.solid & border[:-1]
        begins[1:] |= self.solid[1:] & ~self.solid[:-1]
        closes = self.solid & border[1:]
        closes[:-1] |= self.solid[:-1] & ~self.solid[1:]
        self.word_starts, self.word_ends = np.flatnonzero(begins), np.flatnonzero(closes) + 1
        #: First word of each text, and the number of words.
        self.starts = np.searchsorted(self.word_starts, self.cuts)
        counts = np.diff(self.starts)
        self.hashes = word_hashes(self.raw, self.word_starts, self.word_ends)
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        whole = np.repeat(ids.fill_null(0).to_numpy(zero_copy_only=False), counts)
        if len(self.hashes) >= words:
            anchor = anchors(self.hashes, words, seed_words)
            # A run lies in one document that has an id.
            last = np.repeat(self.starts[1:], counts)[:len(anchor)]
            self.at = np.flatnonzero((np.arange(len(anchor)) + words <= last) & np.repeat(known, counts)[:len(anchor)])
            self.anchor, self.doc = anchor[self.at], whole[self.at]
        else:
            self.at, self.anchor, self.doc = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.base = int(self.doc.min()) if len(self.doc) else 0

    def seeds(self, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct anchors in order of (bucket, anchor), their buckets, and for every run the place of its anchor."""
        # Neighbours mostly share their anchor: one look-up for each stretch.
        first = np.flatnonzero(np.concatenate([[True], self.anchor[1:] != self.anchor[:-1]])) if len(self.anchor) else np.zeros(0, np.int64)
        keys, place = np.unique(self.anchor[first], return_inverse=True)
        place = np.repeat(place, np.diff(np.append(first, len(self.anchor))))
        return *_by_bucket(keys, _bucket(_mix(keys), buckets)), place

    def extend(self, seeded: np.ndarray, buckets: int):
        """Of the runs whose anchor is a seed: (runs, keys, their buckets, place of each run's key)."""
        runs = np.flatnonzero(seeded)
        one, two = run_hashes(self.hashes, self.at[runs], self.words)
        keys, first, place = np.unique(one, return_index=True, return_inverse=True)
        return runs, *_by_bucket(keys, _bucket(_mix(two[first]), buckets)), place


    def without(self, gone: np.ndarray) -> pa.Array:
        """The texts without some words (flags): the others, joined by one space."""
        left = ~gone
        keep = self.solid.copy()
        keep[keep] = np.repeat(left, self.word_ends - self.word_starts)
        # A word that is not its text's first one left takes the space before it along.
        before = np.concatenate([[0], np.cumsum(left)])
        first = np.repeat(before[self.starts[:-1]], np.diff(self.starts))
        spaces = self.word_starts[left & (before[:-1] > first)] - 1
        keep[spaces] = True
        raw = self.raw.copy()
        raw[spaces] = 0x20
        sizes = np.concatenate([[0], np.cumsum(keep)])[self.cuts]
        return pa.Array.from_buffers(pa.binary(), len(self.cuts) - 1, [None, pa.py_buffer(sizes.astype(np.int32)), pa.py_buffer(raw[keep])]).cast(pa.string())


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _by_bucket(keys: np.ndarray, bucket: np.ndarray):
    """Order of the keys by bucket, with the borders: (order, buckets met, their first places)."""
    order = np.lexsort((keys, bucket))
    met, start = np.unique(bucket[order], return_index=True)
    return keys, order, met, np.append(start, len(keys))


def _least(place: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    low = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(low, place, doc)
    return low


def _most(place: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    high = np.full(n, np.iinfo(np.int64).min)
    np.maximum.at(high, place, doc)
    return high


def _packed(block: int, base: int, keys, order, met, cuts, low, many) -> pa.RecordBatch:
    """One row a bucket: keys in order, the least id of each (above ``base``) and whether the block holds several."""
    far = low - base
    size = next(s for s in (2, 4, 8) if s == 8 or not len(far) or (far.min() >= 0 and int(far.max()) < 1 << 8 * s))
    far = far.astype(f"u{size}") if size < 8 else low
    parts = [order[a:b] for a, b in zip(cuts, cuts[1:])]
    n = len(met)
    return pa.RecordBatch.from_arrays(
        [pa.array(met.astype(np.int32)), pa.array(np.full(n, block)), pa.array(np.full(n, base)), pa.array([keys[p].tobytes() for p in parts], pa.binary()),
         pa.array([far[p].tobytes() for p in parts], pa.binary()), pa.array([np.packbits(many[p]).tobytes() for p in parts], pa.binary())],
        ["bucket", "block", "base", "keys", "low", "many"])


def _answers(block: np.ndarray, kind: int, bucket: list[int], bits: list[bytes]) -> pa.RecordBatch:
    n = len(bucket)
    return pa.RecordBatch.from_arrays([pa.array(block, pa.int64()), pa.array([kind] * n, pa.int32()), pa.array(bucket, pa.int32()), pa.array(bits, pa.binary())],
                                      ["block", "kind", "bucket", "data"])


def _judged(packed: DataFrame, kind: int) -> DataFrame:
    """The answers to packed keys, a bucket at a time: for kind 1 the keys of two ids or more,
    for kind 2 the keys that a smaller id holds than the block's least one."""
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def decide():
            sizes = [len(k) // 8 for _, _, k, _, _ in held]
            keys = np.concatenate([np.frombuffer(k, np.uint64) for _, _, k, _, _ in held])
            low = np.concatenate([np.frombuffer(x, f"u{w}").astype(np.int64) + base if (w := len(x) // n) < 8 else np.frombuffer(x, np.int64)
                                  for (_, base, _, x, _), n in zip(held, sizes)])
            distinct, place = np.unique(keys, return_inverse=True)
            least = _least(place, low, len(distinct))
            if kind == 1:
                many = np.concatenate([np.unpackbits(np.frombuffer(m, np.uint8), count=n).astype(bool) for (_, _, _, _, m), n in zip(held, sizes)])
                several = _most(place, low, len(distinct)) > least
                several[place[many]] = True
                true = several[place]
            else:
                true = low > least[place]
            cut = np.split(true, np.cumsum(sizes)[:-1])
            told = [(row[0], at, np.packbits(c).tobytes()) for row, c in zip(held, cut) if c.any()]
            return _answers(np.array([x[0] for x in told], np.int64), kind, [x[1] for x in told], [x[2] for x in told])

        for batch in batches:
            for bucket, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if bucket != at:
                    if held:
                        yield decide()
                    at, held = bucket, []
                held.append(row)
        if held:
            yield decide()

    dealt = packed.repartition("bucket").sortWithinPartitions("bucket", "block")
    return materialize(dealt.mapInArrow(judge, ANSWERS), f"answers-{kind}")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return text_slices(batches, limit=BLOCK_BYTES)


def _stored(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _with_answers(docs: DataFrame, answers: list[DataFrame], work, schema: str) -> DataFrame:
    """``work(block id, documents, answers)`` for every block; answers are {kind: {bucket: bits}}."""
    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            yield _answers(np.array([batch.column("row")[0].as_py()]), 0, [0], [_stored(batch)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, told = None, {}
        for batch in batches:
            for i, (block, kind, bucket) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("block", "kind", "bucket")))):
                if block != at:
                    at, told = block, {1: {}, 2: {}}
                data = batch.column("data")[i].as_py()
                if kind:
                    told[kind][bucket] = data
                else:  # the texts come last
                    yield from work(block, pa.ipc.open_stream(data).read_next_batch(), told)

    rows = docs.mapInArrow(store, ANSWERS)
    for a in answers:
        rows = rows.unionByName(a)
    dealt = rows.repartition("block").sortWithinPartitions("block", F.col("kind").desc(), "bucket")
    return dealt.mapInArrow(run, schema)


def _marked(told: dict[int, bytes], order, met, cuts) -> np.ndarray:
    """The bits of all buckets, by key."""
    true = np.zeros(len(order), bool)
    for bucket, a, b in zip(met.tolist(), cuts, cuts[1:]):
        if bucket in told:
            true[order[a:b]] = np.unpackbits(np.frombuffer(told[bucket], np.uint8), count=b - a).astype(bool)
    return true


def maximal_repeats(matched: np.ndarray, words: int, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths, in words, of the stretches that matched runs (sorted starts) cover;
    ``borders`` are the first words of the texts, which no stretch crosses."""
    if not len(matched):
        return matched, matched
    # Runs that touch or overlap in one text make one stretch.
    text = np.searchsorted(borders, matched, side="right")
    new = np.flatnonzero((np.diff(matched) > words) | (np.diff(text) > 0)) + 1
    first, last = matched[np.concatenate([[0], new])], matched[np.append(new - 1, len(matched) - 1)]
    return first, last - first + words


def remove_repeats(docs: DataFrame, words: int = WORDS, seed_words: int = SEED_WORDS) -> DataFrame:
    """row, doc_id, n_words, n_removed, repeats (start and length of the removed stretches, in
    words) and the kept text (its words joined by spaces) of every row of ``docs`` (``row``
    is its pass number)."""
    if not 1 <= seed_words <= words:
        raise ValueError("seed_words must be between 1 and words")
    spark = docs.sparkSession
    ship(spark)
    buckets = BUCKETS * shuffle_partitions(spark)
    docs = pass_id(stored(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), "documents"), "row")

    def opened(batch: pa.RecordBatch) -> Block:
        return Block(batch.column("doc_id"), batch.column("text"), words, seed_words)

    def send_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            b = opened(batch)
            keys, order, met, cuts, place = b.seeds(buckets)
            low = _least(place, b.doc, len(keys))
            yield _packed(batch.column("row")[0].as_py(), b.base, keys, order, met, cuts, low, _most(place, b.doc, len(keys)) > low)

    def matches(b: Block, told: dict):
        _, order, met, cuts, place = b.seeds(buckets)
        return b.extend(_marked(told[1], order, met, cuts)[place], buckets)

    def send_runs(block: int, batch: pa.RecordBatch, told: dict) -> Iterator[pa.RecordBatch]:
        if told[1]:
            b = opened(batch)
            runs, keys, order, met, cuts, place = matches(b, told)
            if len(runs):
                yield _packed(block, b.base, keys, order, met, cuts, _least(place, b.doc[runs], len(keys)), np.zeros(len(keys), bool))

    def cut(block: int, batch: pa.RecordBatch, told: dict) -> Iterator[pa.RecordBatch]:
        b = opened(batch)
        matched = np.zeros(0, np.int64)
        if told[1]:
            runs, keys, order, met, cuts, place = matches(b, told)
            first = _least(place, b.doc[runs], len(keys))
            # Another document here has it, or one elsewhere.
            matched = b.at[runs[(b.doc[runs] > first[place]) | _marked(told[2], order, met, cuts)[place]]]
        begin, length = maximal_repeats(matched, words, b.starts)
        gone = np.zeros(len(b.hashes) + 1, np.int64)
        np.add.at(gone, begin, 1)
        np.subtract.at(gone, begin + length, 1)
        gone = np.cumsum(gone[:-1]) > 0
        removed = np.concatenate([[0], np.cumsum(gone)])[b.starts]
        # The stretches of each text, counted from its first word.
        place = np.searchsorted(begin, b.starts)
        repeats = pa.StructArray.from_arrays([pa.array(begin - np.repeat(b.starts[:-1], np.diff(place))), pa.array(length)], ["start", "length"])
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("doc_id"), pa.array(np.diff(b.starts)), pa.array(np.diff(removed)),
             pa.ListArray.from_arrays(pa.array(place.astype(np.int32)), repeats), b.without(gone)],
            ["row", "doc_id", "n_words", "n_removed", "repeats", "kept"])

    seeds = _judged(docs.mapInArrow(send_seeds, PACKED), 1)
    covered = _judged(_with_answers(docs, [seeds], send_runs, PACKED), 2)
    return _with_answers(docs, [seeds, covered], cut, REPEATS)
