"""Token ids of white-space separated chunks, remembered per worker.

The word tokenizer drops white space and never joins across it, so a text's ids are those
of its chunks in order. Chunks repeat, so their ids are kept (up to ``KEPT`` chunks, then
the memory starts anew); new plain words are encoded many at a time.
"""

from __future__ import annotations

import os
from collections.abc import Iterable
from itertools import chain, filterfalse

import numpy as np
from public_tokenizers import path as tokenizer_path

VOCABULARY = "word_bpe_49k.json"
WORD_END = "</w>"
KEPT = 500_000
LONGEST_KEPT = 48
# Marks but for the apostrophe, which belongs to the letters behind it.
_MARKS = rb"""!"#$%&()*+,-./:;<=>?@[\]^_`{|}~"""
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Words encoded in one call.
_TOGETHER = 64
#: Stands for a chunk that is not known yet; no id has these bytes.
_HOLE = b"\xff\xff\xff\xff"
_open: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """The worker's encoder for a vocabulary file."""
    if path not in _open:
        _open[path] = ChunkEncoder(path)
    return _open[path]


def _letters(word: bytes) -> bool:
    """Letters only, also after the tokenizer's folding."""
    return word.isalpha() or not word.isascii() and word.decode().lower().isalpha()


class _Kept(dict):
    """Chunk -> ids; what is missing is noted, in order, and given as a hole."""

    def __init__(self):
        self.missed: list[bytes] = []

    def __missing__(self, chunk: bytes) -> bytes:
        self.missed.append(chunk)
        return _HOLE


class ChunkEncoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks fill the cores
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(self.tokenizer.get_vocab().values()) + 1, dtype=bool)
        self.ends[[i for t, i in vocab.items() if t.endswith(WORD_END)]] = True
        self.kept = _Kept()

    def _plain(self, words: list[bytes]) -> None:
        """Chunks of letters only are one word each: their ids end at word-end tokens."""
        ids = np.array(self.tokenizer.encode_batch_fast([b" ".join(words).decode()], add_special_tokens=False)[0].ids, dtype="<u4")
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) == len(words) and stops[-1] == len(ids):
            raw, stops = ids.tobytes(), (stops * 4).tolist()
            for w, a, b in zip(words, [0, *stops], stops):
                self.kept[w] = raw[a:b]
        else:
            for w in words:
                self.kept[w] = self.encode(w)

    def encode(self, chunk: bytes) -> bytes:
        return np.array(self.tokenizer.encode(chunk.decode(), add_special_tokens=False).ids, dtype="<u4").tobytes()

    def chunks(self, text: bytes) -> list[bytes]:
        """Chunks of a text; ASCII capitals folded (the tokenizer folds them too) unless a
        special token's name could be meant, which is matched before folding."""
        return (text if b"<|" in text else text.translate(_LOWER)).split()

    def learn(self, chunks: Iterable[bytes]) -> dict[bytes, bytes]:
        """Remember chunks; ids of those too long to keep are returned."""
        kept, rest, words, tails = self.kept, {}, [], {}
        if len(kept) > KEPT:
            kept.clear()
        missing = set(filterfalse(kept.__contains__, chunks))
        for c in missing:
            if len(c) > LONGEST_KEPT:
                rest[c] = self.encode(c)
            elif _letters(c):
                words.append(c)
            elif (w := c.rstrip(_MARKS)) and w != c and _letters(w):
                tails[c] = w  # the tokenizer cuts between a letter and a mark
            else:
                kept[c] = self.encode(c)
        words = list({*words, *(w for w in tails.values() if w not in kept)})
        for i in range(0, len(words), _TOGETHER):
            self._plain(words[i:i + _TOGETHER])
        if tails:
            for c, w in tails.items():
                marks = c[len(w):]
                if marks not in kept:
                    kept[marks] = self.encode(marks)
                kept[c] = kept[w] + kept[marks]
        return rest

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        kept, out = self.kept, []
        for text in texts:
            kept.missed = missed = []
            out.append((b"".join(map(kept.__getitem__, self.chunks(text))), missed))
        found = self.learn(chain.from_iterable(missed for _, missed in out))
        return [self._filled(raw, missed, found) if missed else raw for raw, missed in out]

    def _filled(self, raw: bytes, missed: list[bytes], found: dict[bytes, bytes]) -> bytes:
        kept, parts = self.kept, raw.split(_HOLE)
        holes = [found[c] if c in found else kept[c] for c in missed]
        return b"".join(chain.from_iterable(zip(parts, [*holes, b""])))
