"""Token counts that follow edits (operator 3).

A document is a list of pre-tokens (a chunk and the white space behind it) under a segment
tree whose nodes hold the sums of characters and tokens below them. An edit (offset,
characters to delete, text to insert) finds its leaves by descending on character sums;
only the touched leaves' text plus its boundary context (to the ends of the pre-tokens
around it) is encoded again, and the sums on the way to the root are updated. A region
that now holds several pre-tokens stays in its first leaf, so the tree keeps its shape.

Defined cases: null and empty texts have one empty leaf and accept insertions; edits are
clipped to the text; very long texts take memory in proportion to their length; repeated
rows are counted each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, text_slices
from .tokens import VOCABULARY, ChunkEncoder, encoder, tokenizer_path

_LEAF = re.compile(r"[^\x20\x09-\x0D]*[\x20\x09-\x0D]+|[^\x20\x09-\x0D]+")
COUNTS = "doc_id long, n_chars long, n_tokens long, n_chars_edited long, n_tokens_edited long, n_chars_encoded long"


class TokenTree:
    def __init__(self, tokens: Sequence[int], leaves: Sequence[str]):
        self.leaves = list(leaves) or [""]
        self.size = 1 << (len(self.leaves) - 1).bit_length()
        # Row 0: characters, row 1: tokens; level by level from the leaves up.
        level = np.zeros((2, self.size), np.int64)
        level[0, :len(leaves)] = list(map(len, leaves))
        level[1, :len(leaves)] = tokens
        self.sums = np.zeros((2, 2 * self.size), np.int64)
        at = self.size
        while True:
            self.sums[:, at:2 * at] = level
            if at == 1:
                break
            level, at = level[:, 0::2] + level[:, 1::2], at // 2
        self.encoded = 0

    @property
    def n_chars(self) -> int:
        return int(self.sums[0, 1])

    @property
    def n_tokens(self) -> int:
        return int(self.sums[1, 1])

    def find(self, offset: int) -> tuple[int, int]:
        """Leaf that holds the character at ``offset`` and the offset inside it; behind the end: the last leaf."""
        chars, i = self.sums[0], 1
        if offset >= chars[1]:
            last = len(self.leaves) - 1
            while last > 0 and not chars[self.size + last]:
                last -= 1
            return last, int(chars[self.size + last])
        while i < self.size:
            i *= 2
            if offset >= chars[i]:
                offset -= int(chars[i])
                i += 1
        return i - self.size, offset

    def _set(self, leaf: int, text: str, tokens: int) -> None:
        self.leaves[leaf] = text
        i, change = leaf + self.size, np.array([len(text), tokens]) - self.sums[:, leaf + self.size]
        while i:
            self.sums[:, i] += change
            i >>= 1

    def edit(self, enc: ChunkEncoder, offset: int, delete: int, insert: str) -> None:
        offset = max(0, min(offset, self.n_chars))
        delete = max(0, min(delete, self.n_chars - offset))
        first, a = self.find(offset)
        last, b = self.find(offset + delete)
        # Context: a leaf begins behind white space and ends with it, except the last one.
        if first > 0 and a == 0:
            before = first - 1
            while before > 0 and not self.leaves[before]:
                before -= 1
            if self.leaves[before] and not self.leaves[before][-1].isspace():
                first, a = before, len(self.leaves[before])
        region = self.leaves[first][:a] + insert + self.leaves[last][b:]
        # What is left may now touch the next pre-token.
        while last + 1 < len(self.leaves) and (not region or region[-1] not in " \t\n\r\x0b\x0c"):
            last += 1
            region += self.leaves[last]
        self.encoded += len(region)
        self._set(first, region, len(enc.ids([region.encode()])[0]) // 4)
        for leaf in range(first + 1, last + 1):
            if self.leaves[leaf]:
                self._set(leaf, "", 0)


def token_tree(text: str, enc: ChunkEncoder) -> TokenTree:
    leaves = _LEAF.findall(text)
    # Every leaf holds one chunk, but for white space at the very start.
    chunks = enc.chunks(text.encode())
    found = enc.learn(chunks)
    kept = enc.kept
    tokens = [len(found[c] if c in found else kept[c]) // 4 for c in chunks] if found else [len(kept[c]) // 4 for c in chunks]
    if len(leaves) > len(tokens):
        tokens.insert(0, 0)
    return TokenTree(tokens, leaves)


def default_edits(text: str) -> list[tuple[int, int, str]]:
    """Three edits that depend on the text alone: a cut, an insertion, a replacement (offsets as of each step)."""
    n = len(text)
    return [(n // 4, min(16, n // 8), ""), (n // 2, 0, "edited passage "), (3 * n // 4, min(5, n // 8), text[:12])]


def count_with_edits(docs: DataFrame, edits=default_edits, vocabulary: str | None = None) -> DataFrame:
    """Counts before and after the edits that ``edits(text)`` lists, and the characters encoded again."""
    vocabulary = vocabulary or tokenizer_path(VOCABULARY)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for batch in text_slices(batches):
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                tree = token_tree(text or "", enc)
                row = [doc, tree.n_chars, tree.n_tokens]
                for offset, delete, insert in edits(text or ""):
                    tree.edit(enc, offset, delete, insert)
                rows.append((*row, tree.n_chars, tree.n_tokens, tree.encoded))
            names = [x.split()[0] for x in COUNTS.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)

    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(count, COUNTS)
