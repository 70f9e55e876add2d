"""Packing and edit-aware counting against whole encodings and plain first fit."""

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cartpath.llm.counting import count_with_edits, default_edits, token_tree
from cartpath.llm.packing import TournamentTree, first_fit_decreasing, pack_documents
from cartpath.llm.tokens import VOCABULARY, ChunkEncoder, encoder, tokenizer_path

PATH = tokenizer_path(VOCABULARY)
TOKENIZER = Tokenizer.from_file(PATH)


def ids(text):
    return TOKENIZER.encode(text, add_special_tokens=False).ids


PIECES = st.lists(st.sampled_from(["a", "Bee", " ", "\n", "don't", "́", "É", "12", ".", ",", "İ", "Σ", "<|endoftext|>", "<|ENDOFTEXT|>",
                                   "\x1c", " ", "naïve,", "x" * 60, "'s"]), max_size=15)


@settings(max_examples=300, deadline=None)
@given(PIECES)
def test_ids_of_chunks_equal_the_whole(pieces):
    text = "".join(pieces)
    assert np.frombuffer(encoder(PATH).ids([text.encode()])[0], "<u4").tolist() == ids(text)


def test_small_memory_gives_the_same_ids(monkeypatch):
    import cartpath.llm.tokens as T
    monkeypatch.setattr(T, "KEPT", 3)
    enc = ChunkEncoder(PATH)
    for text in ("one two three four five", "five six, seven. eight", "one five nine"):
        assert np.frombuffer(enc.ids([text.encode()])[0], "<u4").tolist() == ids(text)


@settings(max_examples=200, deadline=None)
@given(PIECES, st.lists(st.tuples(st.integers(0, 40), st.integers(0, 6), st.sampled_from(["", " ", "x", " y ", "'s", "\n"])), max_size=5))
def test_edits_keep_the_counts(pieces, edits):
    text = "".join(pieces).replace("<|endoftext|>", "").replace("<|ENDOFTEXT|>", "")
    tree = token_tree(text, encoder(PATH))
    assert (tree.n_tokens, tree.n_chars) == (len(ids(text)), len(text))
    for offset, delete, insert in edits:
        offset = min(offset, len(text))
        text = text[:offset] + insert + text[offset + delete:]
        tree.edit(encoder(PATH), offset, delete, insert)
        assert "".join(tree.leaves) == text and (tree.n_tokens, tree.n_chars) == (len(ids(text)), len(text))


def test_an_edit_encodes_its_surroundings_only():
    text = "many plain words " * 2000
    tree = token_tree(text, encoder(PATH))
    tree.edit(encoder(PATH), len(text) // 2, 3, "other")
    assert tree.encoded < 60


def test_counts_of_the_documents(docs, odd, none):
    for table in (docs, odd):
        want = []
        for r in table.collect():
            text = r.text or ""
            row = [r.doc_id, len(text), len(ids(text))]
            for offset, delete, insert in default_edits(text):
                text = text[:offset] + insert + text[offset + delete:]
            want.append((*row, len(text), len(ids(text))))
        got = [tuple(r)[:5] for r in count_with_edits(table).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert count_with_edits(none).count() == 0


@pytest.mark.parametrize("seed", range(20))
def test_tournament_tree_equals_plain_first_fit(seed):
    rnd = random.Random(seed)
    sizes = [rnd.randint(1, 50) for _ in range(rnd.randint(0, 200))]
    bins, offsets = first_fit_decreasing(sizes, 50)
    room, plain = [], []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        b = next((b for b, r in enumerate(room) if r >= sizes[i]), len(room))
        room += [50] * (b == len(room))
        plain.append((i, b, 50 - room[b]))
        room[b] -= sizes[i]
    assert sorted(plain) == list(zip(range(len(sizes)), bins.tolist(), offsets.tolist()))


def test_tree_without_room():
    tree = TournamentTree(3)
    assert tree.first(1) == -1
    tree.put(2, 7)
    assert tree.first(7) == 2 and tree.first(8) == -1
    with pytest.raises(ValueError):
        first_fit_decreasing([0], 5)


def unpacked(rows, capacity):
    """Checks the sequences; doc_id -> list of (start, length, crc, doc_tokens)."""
    sequences, out = {}, {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        out.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32, r.doc_tokens))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end and length > 0
            end += length
        assert end <= capacity
    return out, sequences


def expected(text, capacity):
    whole = np.array([*ids(text or ""), 1], "<u4")
    cut = [(a, whole[a:a + capacity]) for a in range(0, len(whole), capacity)]
    return [(a, len(p), zlib.crc32(p.tobytes()), len(whole)) for a, p in cut]


@pytest.mark.parametrize("capacity, group", [(2048, 16384), (64, 50)])
def test_packing_is_a_round_trip(docs, odd, none, capacity, group):
    for table in (docs, odd):
        out, sequences = unpacked(pack_documents(table, capacity=capacity, group_pieces=group).collect(), capacity)
        want = {}
        for r in table.collect():
            want.setdefault(r.doc_id, []).extend(expected(r.text, capacity))
        assert {k: sorted(v) for k, v in out.items()} == {k: sorted(v) for k, v in want.items()}
    assert pack_documents(none).count() == 0
    out, sequences = unpacked(pack_documents(docs).collect(), 2048)
    fill = [sum(n for _, n in s) for s in sequences.values()]
    assert sum(fill) >= 0.97 * 2048 * (len(fill) - 1)  # all but the group's last sequence
