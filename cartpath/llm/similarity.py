"""N-gram Jaccard join by T-occurrence search (operator 6).

A document is the set of its distinct word n-grams (64-bit hashes). Two documents link
when ``|A & B| >= threshold * |A | B|``; the result names the connected component of each.

1. Equal sets are one node from here on, so a group of copies costs one row a copy.
2. Sets of similar size share a size class. In a class the hash space is cut into ``k`` equal
   parts, and a document's list keys are hashes of (class, part, its shingles there). Linked
   sets differ in at most ``d`` shingles and each spoils one part, so they stand together in
   at least ``T = k - d`` inverted lists: finding them is a T-occurrence search.
3. A list's members are compared with a pivot first (those that meet it twice), which joins
   most of what belongs together at one comparison a member.
4. T-occurrence search for the rest. A document outside the largest component of a list
   asks its lists. As in DivideSkip the ``L`` longest are set aside, the others are merged,
   whoever occurs ``T - L`` times is looked up in the long ones by binary search, and those
   found ``T`` times are candidates. Lists travel as sorted arrays in blocks by member, so
   memory does not grow with a list.
5. Candidates must pass bounds that linked sets cannot miss: their sizes, and the parity bits
   of their shingles (a shingle that only one set holds changes one bit at most). Documents
   that ask within one component are checked in blocks, to which a candidate's bits go once.
6. Comparison of what is left, grouped by pivot in blocks of members: inverted lists of the
   pivot's shingles over the block, short ones heap-merged, long ones binary-probed
   (DivideSkip again), members with the exact overlap stay.
7. Components: least labels over the links with pointer jumping, each round written.

Defined cases: null and wordless texts have an empty set, link with nothing and are their
own component; shorter texts than n words have one shingle; null ids take part, and a
component's id is its least id that is not null; repeated rows are copies; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from array import array
from collections.abc import Iterator
from fractions import Fraction
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.materialize import discard, release_shuffles
from .common import materialize, pass_id, ship, stored, text_bytes, text_slices

N = 4
THRESHOLD = "0.85"
#: More parts than differences, as a factor: the larger, the more lists linked sets share.
SPARE_PARTS = 1.3
BLOCK = 256
#: Shingles of the sets that are compared with a pivot at once (or one set, however large).
HELD = 1 << 19
#: Asking documents that check their candidates together.
ASKING = 512
#: Candidates of such a block, counted with repeats, in one piece of it.
PIECE = 1 << 18
#: Members of a list in one array.
POSTINGS = 16_384
#: Pivots of a list are drawn in so many ways.
PIVOTS = 4
#: Copies up to this many (8 bytes each) are broadcast.
FEW_COPIES = 1 << 21
MU = 0.0085
PARITY_BITS = 1024
SETS = "row long, doc_id long, n_shingles long, mark1 long, mark2 long, parity binary, keys array<long>, needs array<long>"

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_MASK = (1 << 64) - 1
_KEPT = 200_000


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > _KEPT:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_hashes = _WordHashes()


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: bytes, n: int) -> np.ndarray:
    """Sorted distinct hashes of the text's word n-grams."""
    words = text.translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    if len(words) < n:
        return np.array([xxhash.xxh3_64_intdigest(h.tobytes(), seed=len(words))], np.uint64)
    total = np.zeros(len(h) - n + 1, np.uint64)
    for i in range(n):
        total = _mix(total + h[i:len(h) - n + 1 + i] * np.uint64(2 * i + 3))
    return np.unique(total)


class Classes:
    """Size classes and list keys for a threshold."""

    def __init__(self, threshold: Fraction, ratio: float = 1.5, spare_parts: float = SPARE_PARTS):
        self.threshold, self.spare_parts = threshold, spare_parts
        self.starts = [1]
        while self.starts[-1] < 1 << 40:
            self.starts.append(max(self.starts[-1] + 1, math.ceil(self.starts[-1] * ratio)))

    def differences(self, a: int, b: int) -> int:
        """Most shingles in which linked sets of these sizes differ: (a + b) (1 - t) / (1 + t)."""
        t = self.threshold
        return math.floor((a + b) * (1 - t) / (1 + t))

    def parts(self, c: int) -> int:
        """Parts of the class; 0 where only equal sets link."""
        high = self.starts[c + 1] - 1
        differ = self.differences(high, high)
        return math.ceil(self.spare_parts * differ) + 3 if differ else 0

    def of(self, size: int) -> list[int]:
        """Classes of the partners at least as large, its own first."""
        c = 0
        while self.starts[c + 1] <= size:
            c += 1
        most = math.floor(size / self.threshold)
        out = [c]
        while self.starts[out[-1] + 1] <= most:
            out.append(out[-1] + 1)
        return out

    def keys(self, s: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """List keys of a sorted set (their lowest byte is the class), and for each class
        ``class | T << 8``: linked sets whose larger one is of the class share T keys or more."""
        out, needs = [], []
        if not len(s):
            return np.zeros(0, np.int64), needs
        upper, mixed = s >> np.uint64(32), _mix(s ^ np.uint64(0x5851F42D4C957F2D))
        for c in self.of(len(s)):
            parts = self.parts(c)
            if not parts:
                continue
            # No partner in this class is larger than its end or than size / threshold.
            differ = self.differences(len(s), min(self.starts[c + 1] - 1, math.floor(len(s) / self.threshold)))
            part = (upper * np.uint64(parts)) >> np.uint64(32)
            first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            where, sums = part[first], np.add.reduceat(mixed, first)
            need = len(where) - differ
            if need < 1:
                # All parts that hold shingles may be spoiled: the empty ones count as well.
                full = np.zeros(parts, np.uint64)
                full[where] = sums
                where, sums, need = np.arange(parts, dtype=np.uint64), full, 1
            key = _mix(sums + _mix(where + np.uint64((c + 1) << 32)))
            out.append((key & np.uint64(~0xFF & _MASK)) | np.uint64(c))
            needs.append(c | need << 8)
        return np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64), needs


def occurring(lists: list[np.ndarray], need: int) -> np.ndarray:
    """Members of at least ``need`` of the sorted lists, by DivideSkip."""
    lists = sorted(lists, key=len, reverse=True)
    aside = min(need - 1, int(need / (MU * math.log2(len(lists[0]) + 2) + 1)))
    who, times = np.unique(np.concatenate(lists[aside:]), return_counts=True)
    for k, probe in enumerate(lists[:aside]):
        # A member still needs enough of the lists ahead.
        hopeful = times >= need - (aside - k)
        who, times = who[hopeful], times[hopeful]
        if not len(who):
            break
        place = np.searchsorted(probe, who)
        times = times + (probe[np.minimum(place, len(probe) - 1)] == who if len(probe) else 0)
    return who[times >= need]


def required(a: int, b: int, t: Fraction) -> int:
    """Least overlap of linked sets of these sizes."""
    return math.ceil((a + b) * t / (1 + t))


def t_occurrence(query: np.ndarray, members: list[np.ndarray], t: Fraction) -> list[int]:
    """Members (sorted arrays) that link with ``query``, by DivideSkip."""
    sizes = [len(m) for m in members]
    fits = [i for i, n in enumerate(sizes) if min(n, len(query)) >= t * max(n, len(query)) and n]
    if not fits:
        return []
    # Inverted lists: shingle of the query -> members that hold it.
    found = [np.searchsorted(query, members[i]) for i in fits]
    place = [p[(p < len(query)) & (query[np.minimum(p, len(query) - 1)] == members[i])] for i, p in zip(fits, found)]
    flat, who = np.concatenate(place), np.repeat(fits, [len(p) for p in place])
    order = np.argsort(flat, kind="stable")
    flat, who = flat[order], who[order]
    cut = np.flatnonzero(np.diff(flat)) + 1
    starts = np.concatenate([[0], cut]) if len(flat) else np.zeros(0, np.int64)
    lists = np.split(who, cut) if len(flat) else []
    least = min(required(len(query), sizes[i], t) for i in fits)
    longest = max(map(len, lists), default=1)
    aside = min(least - 1, int(least / (MU * math.log2(longest + 1) + 1)))
    by_length = sorted(range(len(lists)), key=lambda i: -len(lists[i]))
    long_ones, short_ones = by_length[:aside], by_length[aside:]
    probes = query[flat[starts[sorted(long_ones)]]] if long_ones else query[:0]
    out = []
    for i, run in groupby(heapq.merge(*(lists[k].tolist() for k in short_ones))):
        overlap = sum(1 for _ in run)
        need = required(len(query), sizes[i], t)
        if overlap < need - len(probes):
            continue
        at = np.searchsorted(members[i], probes)
        overlap += int((members[i][np.minimum(at, sizes[i] - 1)] == probes).sum())
        if overlap >= need:
            out.append(i)
    return out


def parity(s: np.ndarray) -> bytes:
    """For each of ``PARITY_BITS`` buckets, whether it holds an odd number of the shingles."""
    return np.packbits((np.bincount((s % np.uint64(PARITY_BITS)).astype(np.int64), minlength=PARITY_BITS) & 1).astype(np.uint8)).tobytes()


def shingle_sets(docs: DataFrame, n: int, classes: Classes) -> DataFrame:
    """row, doc_id, n_shingles, two marks of the set, its parity bits, list keys and needs."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            sets = [shingles(t, n) for t in text_bytes(batch)]
            keys, needs = zip(*(classes.keys(s) for s in sets))
            offsets = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
            marks = [np.array([_mix(s + np.uint64(seed)).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64) for seed in (1, 2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), *map(pa.array, marks),
                 pa.array([parity(x) for x in sets], pa.binary()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(keys))), pa.array(needs, pa.list_(pa.int64()))],
                ["row", "doc_id", "n_shingles", "mark1", "mark2", "parity", "keys", "needs"])

    ship(docs.sparkSession)
    return docs.select("row", "doc_id", "text").mapInArrow(make, SETS)


def _allowed(n1, bits1, n2, bits2, t: Fraction):
    """Whether sizes and parity bits (arrays, rows by pair) allow a link."""
    num, den = t.numerator, t.denominator
    differ = np.bitwise_count(bits1 ^ bits2).sum(axis=1, dtype=np.int64)
    return (np.minimum(n1, n2) * den >= np.maximum(n1, n2) * num) & (differ * (den + num) <= (n1 + n2) * (den - num))


def _bits(raw: list[bytes], n: int | None = None) -> np.ndarray:
    return np.frombuffer(b"".join(raw), np.uint64).reshape(len(raw) if n is None else n, PARITY_BITS // 64)


def _sketches(sets: DataFrame, name: str) -> DataFrame:
    return sets.select(F.col("row").alias(name), "n_shingles", "parity")


def _possible_pairs(pairs: DataFrame, sets: DataFrame, t: Fraction) -> DataFrame:
    """The pairs (node, pivot) whose sizes and parity bits allow a link."""
    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                n1, n2 = batch.column("n1").to_numpy(), batch.column("n2").to_numpy()
                sound = _allowed(n1, _bits(batch.column("p1").to_pylist()), n2, _bits(batch.column("p2").to_pylist()), t)
                yield batch.select(["node", "pivot"]).filter(pa.array(sound))

    both = (pairs.join(_sketches(sets, "node").withColumnsRenamed({"n_shingles": "n1", "parity": "p1"}), "node")
            .join(_sketches(sets, "pivot").withColumnsRenamed({"n_shingles": "n2", "parity": "p2"}), "pivot"))
    return both.mapInArrow(pick, "node long, pivot long")


def _possible_candidates(asked: DataFrame, sets: DataFrame, t: Fraction) -> tuple[DataFrame, DataFrame]:
    """The pairs (node, pivot) of ``asked`` (asking, top, candidates; a written table) whose
    sizes and parity bits allow a link, and the written table that they are read from."""
    blocks = asked.groupBy("top").agg(F.ceil(F.count(F.lit(1)) / ASKING).cast("int").alias("blocks"))
    asked = asked.join(blocks, "top").select("top", F.pmod(F.xxhash64("asking"), F.col("blocks")).cast("int").alias("block"), "asking", "candidates")
    asked = materialize(asked, "asked-blocks")
    # A block with many candidates is cut into pieces by candidate.
    pieces = asked.groupBy("top", "block").agg(F.ceil(F.sum(F.size("candidates")) / PIECE).cast("int").alias("pieces"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, values = batch.column("candidates").offsets.to_numpy(), batch.column("candidates").values.to_numpy()
            for i, (top, block, asking, n) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("top", "block", "asking", "pieces")))):
                own = values[offsets[i]:offsets[i + 1]]
                piece = (_mix(own.view(np.uint64)) % np.uint64(n)).astype(np.int32)
                for k in np.unique(piece).tolist():
                    yield pa.RecordBatch.from_pydict({"top": pa.array([top], pa.int64()), "block": pa.array([block], pa.int32()), "piece": pa.array([k], pa.int32()),
                                                      "asking": pa.array([asking], pa.int64()), "candidates": pa.array([own[piece == k]], pa.list_(pa.int64()))})

    place = ["top", "block", "piece"]
    whole = asked.join(pieces, ["top", "block"])
    parted = materialize(
        whole.filter("pieces = 1").select("top", "block", F.lit(0).alias("piece"), "asking", "candidates").unionByName(
            whole.filter("pieces > 1").mapInArrow(cut, "top long, block int, piece int, asking long, candidates array<long>")), "asked-pieces")
    discard(asked)

    def each_once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def distinct():
            who = np.unique(np.concatenate(held))
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(who), at[0])), *[pa.array(np.full(len(who), x, np.int32)) for x in at[1:]], pa.array(who)], [*place, "node"])

        for batch in batches:
            offsets, values = batch.column("candidates").offsets.to_numpy(), batch.column("candidates").values.to_numpy()
            for i, key in enumerate(zip(*(batch.column(c).to_pylist() for c in place))):
                if key != at:
                    if held:
                        yield distinct()
                    at, held = key, []
                held.append(values[offsets[i]:offsets[i + 1]].copy())
        if held:
            yield distinct()

    known = (parted.select(*place, "candidates").repartition(*place).sortWithinPartitions(*place).mapInArrow(each_once, "top long, block int, piece int, node long")
             .join(_sketches(sets, "node"), "node")
             .select(*place, F.lit(0).alias("kind"), "node", "n_shingles", "parity", F.lit(None).cast("array<long>").alias("candidates")))
    asking = parted.join(_sketches(sets, "asking"), "asking").select(
        *place, F.lit(1).alias("kind"), F.col("asking").alias("node"), "n_shingles", "parity", "candidates")
    rows = known.unionByName(asking).repartition(*place).sortWithinPartitions(*place, "kind", "node")

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Ids, sizes and parity bits of a piece's candidates: 144 bytes each.
        at, ids, sizes, bits, table = None, array("q"), array("q"), bytearray(), None
        for batch in batches:
            out = [np.zeros((0, 2), np.int64)]
            candidates = batch.column("candidates")
            offsets, values = candidates.offsets.to_numpy(), candidates.values.to_numpy()
            for i, (top, block, piece, kind, node, n, raw) in enumerate(zip(*(batch.column(c).to_pylist() for c in (*place, "kind", "node", "n_shingles", "parity")))):
                if (top, block, piece) != at:
                    at, ids, sizes, bits, table = (top, block, piece), array("q"), array("q"), bytearray(), None
                if kind == 0:
                    ids.append(node)
                    sizes.append(n)
                    bits += raw
                    continue
                if table is None:
                    table = np.frombuffer(ids, np.int64), np.frombuffer(sizes, np.int64), _bits([bytes(bits)], len(ids))
                where = np.searchsorted(table[0], values[offsets[i]:offsets[i + 1]])
                who = table[0][where[_allowed(n, _bits([raw]), table[1][where], table[2][where], t)]]
                out.append(np.stack([np.maximum(who, node), np.minimum(who, node)], axis=1))
            pairs = np.concatenate(out)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["node", "pivot"])

    return rows.mapInArrow(pick, "node long, pivot long").distinct(), parted


def _verified(pairs: DataFrame, docs: DataFrame, n: int, t: Fraction) -> DataFrame:
    """Of the distinct pairs (node, pivot) those that link. ``docs``: row, text."""
    pairs = materialize(pairs, "candidates")
    wanted = pairs.select("node").union(pairs.select("pivot")).distinct()

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            made = [shingles(x, n).tobytes() for x in text_bytes(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(made, pa.binary())], ["row", "shingles"])

    made = materialize(docs.select("row", "text").join(wanted.withColumnRenamed("node", "row"), "row", "left_semi")
                       .mapInArrow(sets, "row long, shingles binary"), "candidate-sets")
    blocks = pairs.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    members = (pairs.join(blocks, "pivot").select("pivot", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"), "node")
               .join(made.withColumnRenamed("row", "node"), "node").select("pivot", "block", F.lit(1).alias("kind"), "node", "shingles"))
    heads = (blocks.select("pivot", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
             .join(made.withColumnRenamed("row", "pivot"), "pivot")
             .select("pivot", "block", F.lit(0).alias("kind"), F.col("pivot").alias("node"), "shingles"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, query, nodes, held, size = None, None, [], [], 0

        def matches():
            hits = t_occurrence(query, held, t) if held else []
            return pa.RecordBatch.from_arrays([pa.array([nodes[i] for i in hits], pa.int64()), pa.array([key[0]] * len(hits), pa.int64())], ["node", "pivot"])

        for batch in batches:
            raw = batch.column("shingles")
            for i, (pivot, block, kind, node) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("pivot", "block", "kind", "node")))):
                if (pivot, block) != key:
                    if held:
                        yield matches()
                    key, query, nodes, held, size = (pivot, block), None, [], [], 0
                # A copy of its own: the batch can go while a block is held.
                s = np.frombuffer(raw[i].as_py(), np.uint64)
                if kind == 0:
                    query = s
                    continue
                if held and (len(held) == 2 * BLOCK or size + len(s) > HELD):
                    yield matches()
                    nodes, held, size = [], [], 0
                nodes.append(node)
                held.append(s)
                size += len(s)
        if held:
            yield matches()

    both = heads.unionByName(members).repartition("pivot", "block").sortWithinPartitions("pivot", "block", "kind", "node")
    links = materialize(both.mapInArrow(search, "node long, pivot long"), "links")
    discard(pairs, made)
    return links


def least_labels(links: DataFrame) -> DataFrame:
    """(node, component) of every node that has a link (node, pivot): the least node reachable."""
    both = links.select(F.col("node").alias("a"), F.col("pivot").alias("b"))
    edges = materialize(both.union(both.select("b", "a")).distinct(), "edges")
    labels = spent = materialize(edges.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("node"), F.least("a", "m").alias("component")), "labels")
    while True:
        # The least label among a node and its neighbours, then the label of that label.
        near = (edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("component").alias("near")))
        step = labels.join(near.withColumnRenamed("a", "node"), "node").select(
            "node", F.col("component").alias("was"), F.least("component", "near").alias("component"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("further"))
        step = materialize(step.join(jump, "component", "left").select(
            "node", "was", F.least("component", F.coalesce("further", "component")).alias("component")), "labels")
        discard(spent)
        labels, spent = step.select("node", "component"), step
        if step.filter("was != component").isEmpty():
            discard(edges)
            return labels


def _searched(lists: DataFrame, needs: DataFrame, labels: DataFrame) -> DataFrame:
    """T-occurrence search across components: rows (asking, top, candidates), ``top`` being
    the heaviest component in any list of the asking node.

    ``lists``: key, node, long; ``needs``: node, class, need; ``labels``: node, component."""
    sizes = labels.groupBy("component").agg(F.count(F.lit(1)).alias("weight"))
    placed = (lists.join(labels.join(sizes, "component"), "node", "left")
              .select("key", "node", "long", F.coalesce("component", "node").alias("component"), F.coalesce("weight", F.lit(1)).alias("weight")))
    placed = materialize(placed, "placed")
    # Lists with members of several components; every one but the heaviest component's asks.
    rank = F.struct("weight", "component")
    open_lists = placed.groupBy("key").agg(F.min(rank).alias("low"), F.max(rank).alias("top")).filter("low != top").select("key", "top")
    tops = placed.join(open_lists, "key").select("key", "node", "long", "component", "top", (rank < F.col("top")).alias("asks"))
    tops = materialize(tops, "open-lists")
    most = tops.agg(F.max("long").alias("m")).first()["m"] or 1
    buckets = -(-most // POSTINGS)
    postings = (tops.withColumn("bucket", F.pmod(F.xxhash64("node"), F.lit(buckets))).groupBy("key", "bucket")
                .agg(F.array_sort(F.collect_list(F.struct("node", "component"))).alias("who"))
                .select("key", "bucket", F.col("who.node").alias("members"), F.col("who.component").alias("components")))
    asks = tops.filter("asks").withColumn("class", F.col("key").bitwiseAND(F.lit(0xFF))).join(needs, ["node", "class"])
    asks = asks.select("key", F.col("node").alias("asking"), "class", F.col("component").alias("own"), "need",
                       F.max("top").over(Window.partitionBy("node"))["component"].alias("top"))
    rows = asks.join(postings, "key").drop("key")
    rows = rows.repartition("asking", "class", "bucket").sortWithinPartitions("asking", "class", "bucket")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def candidates():
            who = occurring(held, at[4])
            return pa.RecordBatch.from_arrays([pa.array([at[0]], pa.int64()), pa.array([at[5]], pa.int64()), pa.array([who], pa.list_(pa.int64()))],
                                              ["asking", "top", "candidates"]).slice(0, min(1, len(who)))

        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in ("asking", "class", "bucket", "own", "need", "top")))
            (cut, members), (cut2, components) = [(batch.column(c).offsets.to_numpy(), batch.column(c).values.to_numpy()) for c in ("members", "components")]
            for i, key in enumerate(keys):
                if key != at:
                    if held and len(held) >= at[4]:
                        yield candidates()
                    at, held = key, []
                others = components[cut2[i]:cut2[i + 1]] != key[3]
                held.append(members[cut[i]:cut[i + 1]][others])
        if held and len(held) >= at[4]:
            yield candidates()

    asked = materialize(rows.mapInArrow(merge, "asking long, top long, candidates array<long>"), "asked")
    discard(placed, tops)
    return asked


def _without(rows: DataFrame, copies: DataFrame) -> DataFrame:
    """``rows`` that are no ``copies`` (row; a written table). Few copies are broadcast, so that the rows' keys
    are not shuffled for them; more are joined."""
    return rows.join(F.broadcast(copies) if copies.count() <= FEW_COPIES else copies.hint("merge"), "row", "left_anti")


def near_duplicates(docs: DataFrame, n: int = N, threshold: str = THRESHOLD, spare_parts: float = SPARE_PARTS) -> DataFrame:
    """row, doc_id, n_shingles, node and component of every row of ``docs`` (``row``
    is its pass number), with component_id, the component's least doc_id.
    ``spare_parts`` trades list keys for candidates; it does not change the result."""
    t = Fraction(threshold)
    if not 0 < t <= 1 or n < 1:
        raise ValueError("threshold must be in (0, 1], n positive")
    docs = pass_id(stored(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), "documents"), "row")
    sets = materialize(shingle_sets(docs, n, Classes(t, spare_parts=spare_parts)), "sets")
    marks = ["n_shingles", "mark1", "mark2"]
    nodes = materialize(sets.filter("n_shingles > 0").groupBy(*marks).agg(F.min("row").alias("node"), F.min("doc_id").alias("least_id")), "nodes")

    # Inverted lists with two members or more, of one row of each set.
    copies = sets.select("row", *marks).join(nodes, marks).filter("row != node").select("row")
    lists = _without(sets.filter(F.size("keys") > 0), materialize(copies, "copies")).select(F.col("row").alias("node"), F.explode("keys").alias("key"))
    of_key = Window.partitionBy("key")
    drawn = F.struct(F.xxhash64("node", F.pmod("key", F.lit(PIVOTS << 8))).alias("draw"), F.col("node").alias("node"))
    lists = lists.select("node", "key", F.count(F.lit(1)).over(of_key).alias("long"), F.min(drawn).over(of_key)["node"].alias("pivot"))
    lists = materialize(lists.filter("long > 1"), "lists")
    # Most keys stand in no list of two: the table goes on without them, and so does the disk.
    every_key, sets = sets, materialize(sets.drop("keys"), "sets-without-keys")
    discard(every_key)
    release_shuffles(docs.sparkSession)
    needs = sets.select(F.col("row").alias("node"), F.explode("needs").alias("n")).select(
        "node", F.col("n").bitwiseAND(F.lit(0xFF)).alias("class"), F.shiftright("n", 8).alias("need"))

    pair = [F.greatest("node", "pivot").alias("node"), F.least("node", "pivot").alias("pivot")]
    compared = lists.filter("node != pivot").select(*pair).groupBy("node", "pivot").count().filter("count > 1").select("node", "pivot")
    compared = materialize(compared, "compared")
    links = _verified(_possible_pairs(compared, sets, t), docs, n, t)
    release_shuffles(docs.sparkSession)
    labels = least_labels(links)
    asked = _searched(lists.select("key", "node", "long"), needs, labels)
    discard(lists, labels)
    possible, pieces = _possible_candidates(asked, sets, t)
    discard(asked)
    more = _verified(possible.join(compared, ["node", "pivot"], "left_anti"), docs, n, t)
    discard(pieces, compared)
    every = least_labels(links.unionByName(more))
    discard(links, more)

    comps = nodes.join(every, "node", "left").withColumn("component", F.coalesce("component", "node"))
    ids = comps.groupBy("component").agg(F.min("least_id").alias("component_id"))
    comps = comps.join(ids, "component").select(*marks, "node", "component", "component_id")
    out = sets.select("row", "doc_id", *marks).join(comps, marks, "left")
    return out.select("row", "doc_id", "n_shingles", "node", "component",
                      F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def first_of_each(docs: DataFrame, n: int, threshold: str, spare_parts: float = SPARE_PARTS) -> DataFrame:
    """The rows of ``docs`` (all columns), one of each component: the one with
    the least doc_id (null last), then row. Rows without words stay."""
    docs = stored(docs, "documents")
    found = materialize(near_duplicates(docs, n, threshold, spare_parts), "components")
    keys = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))
    best = found.filter("n_shingles > 0").groupBy("component").agg(F.min_by("row", keys).alias("_llm_row")).select("_llm_row")
    kept = best.union(found.filter("n_shingles = 0").select("row"))
    return pass_id(docs, "_llm_row").join(kept, "_llm_row", "left_semi").select(*docs.columns)
