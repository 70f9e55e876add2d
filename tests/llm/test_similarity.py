"""N-gram Jaccard join against all pairs; the list keys' guarantee; DivideSkip; components."""

import random
import re
from fractions import Fraction

import numpy as np
import pytest

from cartpath.llm import similarity
from cartpath.llm.similarity import Classes, first_of_each, least_labels, near_duplicates, occurring, parity, shingles, t_occurrence

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_set(text, n):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return frozenset(tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))) if words else frozenset()


def plain_components(rows, n, t):
    """(doc_id, set size, least doc_id reachable) of each row, by all pairs."""
    sets = [plain_set(text, n) for _, text in rows]
    parent = list(range(len(rows)))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and len(a & sets[j]) >= t * len(a | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return [(d, len(sets[i]), least.get(root(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)]


def family(rnd, words, base, members, edits):
    out = []
    for _ in range(members):
        w = list(base)
        for _ in range(rnd.randint(0, edits)):
            k, p = rnd.randrange(3), rnd.randrange(len(w))
            if k == 0:
                w[p] = rnd.choice(words)
            elif k == 1:
                w.insert(p, rnd.choice(words))
            elif len(w) > 1:
                del w[p]
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("seed, n, threshold", [(1, 4, "0.85"), (2, 5, "0.8"), (3, 1, "0.5"), (4, 4, "0.85")])
def test_components_match_all_pairs(spark, seed, n, threshold):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(400 if seed < 4 else 12)]
    passage = [rnd.choice(words) for _ in range(60)]
    texts = []
    for _ in range(14):
        size = rnd.choice([2, 5, 9, 15, 40, 120, 300])
        base = [rnd.choice(words) for _ in range(size)]
        if rnd.random() < 0.4:
            base[size // 2:size // 2] = passage
        texts += family(rnd, words, base, rnd.choice([1, 3, 12]), max(1, len(base) // 25))
    texts += ["", None, "  ", "one", "ONE", "one two", "Two one"] + texts[:5]
    rnd.shuffle(texts)
    rows = [(3 * i + 1, t) for i, t in enumerate(texts)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), n, threshold)
    assert sorted(tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()) == sorted(plain_components(rows, n, Fraction(threshold)))


def test_chain_of_links(spark):
    """Neighbours link, ends do not: one component through the middle ones."""
    words = [f"w{i}" for i in range(200)]
    rows = [(50 - i, " ".join(words[4 * i:4 * i + 100])) for i in range(12)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 1, "0.9").collect()
    assert {r.component_id for r in got} == {39}
    assert plain_components(rows, 1, Fraction("0.9")) == [(d, 100, 39) for d, _ in rows]


@pytest.mark.parametrize("threshold, spare", [("0.85", 1.3), ("0.8", 1.3), ("0.85", 1.0), ("0.5", 1.1), ("0.95", 2.0)])
def test_linked_sets_share_enough_lists(threshold, spare):
    """In the larger set's class, linked sets share at least as many keys as both say."""
    classes, t = Classes(Fraction(threshold), spare_parts=spare), Fraction(threshold)
    rng = np.random.default_rng(7)
    checked = 0
    for _ in range(600):
        a = np.unique(rng.integers(0, 2**63, rng.choice([1, 2, 5, 8, 13, 30, 90, 400])).astype(np.uint64) * np.uint64(2))
        drop = rng.integers(0, max(1, int(len(a) * (1 - float(t)) * 1.1)) + 1)
        add = rng.integers(0, max(1, int(len(a) * (1 - float(t)) * 0.6)) + 1)
        b = np.unique(np.concatenate([rng.permutation(a)[drop:], rng.integers(0, 2**63, add).astype(np.uint64) * np.uint64(2)]))
        both = len(np.intersect1d(a, b))
        if both == len(a) == len(b) or not len(b) or both < t * len(np.union1d(a, b)):
            continue
        (ka, na), (kb, nb) = classes.keys(a), classes.keys(b)
        c = classes.of(max(len(a), len(b)))[0]
        shared = (np.intersect1d(ka, kb) & 0xFF == c).sum()
        assert shared >= max(x >> 8 for x in na + nb if x & 0xFF == c)
        checked += 1
    assert checked > 50


@pytest.mark.parametrize("seed", range(15))
def test_divide_skip_matches_intersections(seed):
    rng = np.random.default_rng(seed)
    t = Fraction(rng.choice(["0.5", "0.8", "0.85", "1"]))
    query = np.unique(rng.integers(0, 500, rng.integers(1, 120)).astype(np.uint64))
    members = [np.unique(np.concatenate([rng.permutation(query)[rng.integers(0, 1 + len(query) // 3):], rng.integers(0, 500, rng.integers(0, 12)).astype(np.uint64)]))
               for _ in range(rng.integers(0, 40))] + [np.zeros(0, np.uint64), query]
    want = [i for i, m in enumerate(members) if len(m) and len(np.intersect1d(query, m)) >= t * len(np.union1d(query, m))]
    assert t_occurrence(query, members, t) == want


@pytest.mark.parametrize("seed", range(15))
def test_occurrences_match_counts(seed):
    rng = np.random.default_rng(seed)
    lists = [np.unique(rng.integers(0, 60, rng.integers(0, 50))) for _ in range(rng.integers(1, 30))]
    who, times = np.unique(np.concatenate(lists), return_counts=True)
    for need in range(1, len(lists) + 1):
        assert occurring(list(lists), need).tolist() == who[times >= need].tolist()


def test_parity_never_exceeds_the_difference():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = (np.unique(rng.integers(0, 3000, rng.integers(1, 900)).astype(np.uint64)) for _ in range(2))
        bits = [np.unpackbits(np.frombuffer(parity(x), np.uint8)) for x in (a, b)]
        assert (bits[0] != bits[1]).sum() <= len(np.setxor1d(a, b)) and not (bits[0] != np.unpackbits(np.frombuffer(parity(a), np.uint8))).any()


def test_shingles():
    assert len(shingles(b"a b c d e", 4)) == 2 and len(shingles(b"a b", 4)) == 1 and len(shingles(b" \n", 4)) == 0
    assert (shingles(b"A b\tC d", 4) == shingles(b"a B c\x0bd", 4)).all() and shingles(b"a b", 4) != shingles(b"b a", 4)
    assert len(shingles(b"x x x x x x x", 4)) == 1


def test_least_labels(spark):
    rnd = random.Random(2)
    edges = [(i, i + 1) for i in range(30)] + [(rnd.randrange(100, 160), rnd.randrange(100, 160)) for _ in range(45)]
    edges = [(max(e), min(e)) for e in edges if e[0] != e[1]]
    got = {r.node: r.component for r in least_labels(spark.createDataFrame(edges, "node long, pivot long")).collect()}
    want = {x: x for e in edges for x in e}
    for _ in want:
        for a, b in edges:
            want[a] = want[b] = min(want[a], want[b])
    assert got == want


def test_documents(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = near_duplicates(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(tuple(r) for r in got) == sorted(plain_components(rows, 4, Fraction("0.85")))


def test_odd_rows(odd, odd_rows, none):
    got = near_duplicates(odd).select("doc_id", "n_shingles", "component_id").collect()
    want = plain_components([(r[0], r[1]) for r in odd_rows], 4, Fraction("0.85"))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert near_duplicates(none).count() == 0 and first_of_each(none, 4, "0.85").count() == 0
    kept = first_of_each(odd, 4, "0.85")
    assert kept.schema == odd.schema
    # PROSE five times (one with a word more) leaves the least id; the four empty rows and null pairs stay.
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, None, None, 3, 4, 5, 6, 7, 8, 9, 10], key=str)


def test_parameters(docs):
    for bad in ({"threshold": "0"}, {"threshold": "1.2"}, {"n": 0}):
        with pytest.raises(ValueError):
            near_duplicates(docs, **bad)


@pytest.mark.parametrize("few", [0, 1 << 21])
def test_copies_are_left_out_either_way(spark, tmp_path, monkeypatch, few):
    """Copies by broadcast and by a join, candidate blocks in pieces, comparisons of few shingles at once."""
    rnd = random.Random(8)
    base = [" ".join(f"w{rnd.randrange(60)}" for _ in range(60)) for _ in range(6)]
    rows = []
    for i in range(150):
        w = rnd.choice(base).split()
        for _ in range(rnd.choice([0, 0, 1, 2, 6])):
            w[rnd.randrange(len(w))] = f"x{rnd.randrange(9)}"
        rows.append((i, " ".join(w)))
    monkeypatch.setattr(similarity, "FEW_COPIES", few)
    monkeypatch.setattr(similarity, "PIECE", 16)
    monkeypatch.setattr(similarity, "HELD", 200)
    monkeypatch.setattr(similarity, "ASKING", 8)
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "d"))
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in similarity.near_duplicates(spark.read.parquet(str(tmp_path / "d"))).collect())
    assert got == sorted(plain_components(rows, 4, Fraction("0.85")))
