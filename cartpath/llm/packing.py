"""Packing token pieces into sequences (operator 2).

A document is its token ids and an end id. It is cut into pieces of ``capacity`` ids and a
remainder; the pieces go to randomised groups of about ``group_pieces`` pieces, and each
group is packed on its own by first-fit decreasing: the largest piece first, into the
first sequence with room, found in O(log n) by a tournament tree over the room left.

Tokenising happens once, in place: pieces (ids' checksum, no text, no ids) are written, so
only narrow rows are shuffled to their groups. A group holds ``group_pieces`` pieces on
average by construction (the number of groups follows from the count), whatever the keys.

Defined cases: a null or empty text is its end id alone; very long documents give many
pieces; repeated rows are packed each; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, ship, text_bytes, text_slices
from .tokens import VOCABULARY, encoder, tokenizer_path

CAPACITY = 2048
END_ID = 1
GROUP_PIECES = 16384

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PACKED = PIECE + ", sequence_id long, offset long"


class TournamentTree:
    """Room left in each bin; ``first(size)`` is the first bin with at least that room."""

    def __init__(self, leaves: int):
        self.base = 1 << max(0, (max(1, leaves) - 1).bit_length())
        self.most = [0] * (2 * self.base)

    def put(self, leaf: int, room: int) -> None:
        most, i = self.most, leaf + self.base
        most[i] = room
        while i > 1:
            i >>= 1
            best = most[2 * i] if most[2 * i] >= most[2 * i + 1] else most[2 * i + 1]
            if most[i] == best:
                return
            most[i] = best

    def first(self, size: int) -> int:
        most, i = self.most, 1
        if most[1] < size:
            return -1
        while i < self.base:
            i *= 2
            if most[i] < size:
                i += 1
        return i - self.base


def first_fit_decreasing(sizes: Sequence[int], capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each size; sizes in 1..capacity, equal sizes in the given order."""
    sizes = np.asarray(sizes, dtype=np.int64)
    if len(sizes) and (sizes.min() < 1 or sizes.max() > capacity):
        raise ValueError("sizes must be between 1 and the capacity")
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    order = np.argsort(-sizes, kind="stable")
    full = int((sizes == capacity).sum())
    bins[order[:full]] = np.arange(full)
    tree, used, room = TournamentTree(len(sizes) - full), 0, []
    for i, size in zip(order[full:].tolist(), sizes[order[full:]].tolist()):
        b = tree.first(size)
        if b < 0:
            b, used = used, used + 1
            room.append(capacity)
        bins[i], offsets[i] = full + b, capacity - room[b]
        room[b] -= size
        tree.put(b, room[b])
    return bins, offsets


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, start, length, ids_crc32 and doc_tokens of every piece."""
    end = int(end_id).to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for batch in text_slices(batches):
            rows = []
            for doc, ids in zip(batch.column("doc_id").to_pylist(), enc.ids(text_bytes(batch))):
                ids += end
                n = len(ids) // 4
                for a in range(0, n, capacity):
                    part = ids[4 * a:4 * (a + capacity)]
                    rows.append((doc, a, len(part) // 4, zlib.crc32(part), n))
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, PIECE)


def pack_documents(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
                   group_pieces: int = GROUP_PIECES) -> DataFrame:
    """The pieces with their sequence and offset; sequence ids are unique, not gapless."""
    pieces = token_pieces(docs, vocabulary or tokenizer_path(VOCABULARY), capacity, end_id)
    pieces = materialize(pieces.withColumn("_n", F.monotonically_increasing_id()), "pieces")
    groups = max(1, -(-pieces.count() // group_pieces))

    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    grouped = pieces.withColumn("_group", F.pmod(F.xxhash64("_n"), F.lit(groups)))
    packed = grouped.select("_group", "_n", "length").groupBy("_group").applyInPandas(
        lambda g: _placed(g, capacity), "_n long, sequence_id long, offset long")
    return pieces.join(packed, "_n").select(*columns, "sequence_id", "offset")


def _placed(group: pd.DataFrame, capacity: int) -> pd.DataFrame:
    group = group.sort_values("_n", ignore_index=True)
    bins, offsets = first_fit_decreasing(group["length"].to_numpy(), capacity)
    return pd.DataFrame({"_n": group["_n"], "sequence_id": (group["_group"].to_numpy() << 32) + bins, "offset": offsets})
