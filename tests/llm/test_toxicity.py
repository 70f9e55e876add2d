"""Folding, matching against a plain search, exceptions, held-out quality, odd rows."""

import random
import re
import time
import zlib

import pytest
from pyspark.sql import functions as F

from cartpath.llm.toxicity import Lexicon, drop_toxic, fold, fold_signed, learn_lexicon, score_toxicity, terms


@pytest.mark.parametrize("text, folded", [
    ("LOSER", " loser "), ("l0ser", " loser "), ("$tupid!", " stupid "), ("сlоwn", " clown "), ("ＭＯＲＯＮ", " moron "), ("1diot", " idiot "),
    ("in 2024 at 10", " in 2024 at 10 "), ("a.b  c", " a b c "), ("", " "), ("!!!", "  "), ("É", " é "),
    ("idi07 w0rthle55 1d10t", " idi07 worthle55 1diot "), ("id!ot!", " id ot "), ("$$$ 2024! $5", " 2024 5 ")])
def test_folding(text, folded):
    assert fold(text).split() == folded.split() and fold(text).startswith(" ") and fold(text).endswith(" ")


@pytest.mark.parametrize("text, forms", [
    ("idi07", [["idiot"]]), ("so w0rthle55, you", [["worthless"]]), ("1d10t", [["idiot"]]), ("id!ot", [["idiot"]]), ("m0r0n5", [["morons"]]),
    ("!d!07!", [["d!07", "!d!07", "d!07!", "!d!07!"]]), ("naz!!!", [["naz!", "naz!!!"]]), ("a $h!7 b", [["shit"]]), ("l0ser", []), ("loser!", [["loser!"]]),
    ("in 2024 at 10!", []), ("$$$ !!! @ 5", []), ("", [])])
def test_words_with_signs_are_folded_wholly(text, forms):
    folded, signed = fold_signed(text)
    assert folded == fold(text) and all(folded[a] == folded[b] == " " for a, b, _ in signed)
    whole = str.maketrans("!07", "iot")
    assert [set(f) for *_, f in signed] == [{x.translate(whole) for x in f} for f in forms]


def test_disguised_words_are_found():
    lexicon = Lexicon({" idiot ": 3.0, " worthl": 2.0, " loser ": 4.0}, (" village idiot ",))
    found = lambda text: sorted(w for w, _ in lexicon.hits_signed(*fold_signed(text)).values())
    for text in ("idi07", "1d10t", "1D10T!!", "id!ot", "an !d!0t here", "idiot!", "!diot", "@ idio7 $$$"):
        assert found(text) == [3.0], text
    assert found("w0rthle55 you") == [2.0] and found("l0ser! you id!07, idiot") == [3.0, 3.0, 4.0]
    assert found("in 2024 at 10! $$$ 1070 the village id!ot") == [] == found("village 1d10t!")
    # Both forms of a word count once, the heavier one.
    assert found("loser!idiot") == [3.0, 4.0] and "idiot" in {t.strip() for t in terms(*fold_signed("1d10t"))}


def test_rare_disguises_are_predicted(spark):
    docs, marks = made(spark)
    lexicon = learn_lexicon(docs, marks)
    texts = ["word1 word2 " * 20 + x for x in ("grimb4l", "9r1mbal vex0r", "v3x0r!", "gr!mb@l", "7r1m 2024 $$$ 10!")]
    assert [s >= 0.5 for s in lexicon.score(texts)] == [True, True, True, True, False]


@pytest.mark.parametrize("seed", range(10))
def test_hits_match_a_plain_search(seed):
    rnd = random.Random(seed)
    lexicon = Lexicon({" bad ": 2.0, " badge": 1.0, " ugl": 3.0, " bad egg ": 4.0}, (" not bad ", " ugl duck"))
    words = ["bad", "badge", "badges", "ugly", "not", "egg", "duck", "fine", "ugl"]
    text = fold(" ".join(rnd.choice(words) for _ in range(30)))
    spared = [(m.start(), m.start() + len(e) - 1) for e in lexicon.exceptions for m in re.finditer(f"(?={e})", text)]
    want = {}
    for e, w in lexicon.weights.items():
        for m in re.finditer(f"(?={e})", text):
            want[m.start()] = max(want.get(m.start(), (0, 0)), (w, m.start() + len(e) - 1))
    want = {s: v for s, v in want.items() if not any(a <= s and v[1] <= b for a, b in spared)}
    assert lexicon.hits(text) == want


def test_longer_texts_weigh_hits_less():
    lexicon = Lexicon({" bad ": 2.0}, (), (-3.0, 0.5, 1.0, 0.5))
    short, long, clean = lexicon.score(["so bad", "so bad" + " word" * 500, "so good"])
    assert short > long > clean


def made(spark):
    """Toxic documents hold slur words, disguised at times; "slurp" in "nice slurp" is harmless."""
    rnd = random.Random(3)
    filler = [f"word{i}" for i in range(300)]
    rows, marks = [], []
    for i in range(800):
        words, toxic = [rnd.choice(filler) for _ in range(40)], i % 5 == 0
        if toxic:
            words[rnd.randrange(40)] = rnd.choice(["grimbal", "Gr1mbal!", "gr¡mbal grimbal", "vexor", "VEX0R", "nice slurp vexor"])
        elif i % 7 == 0:
            words[rnd.randrange(40)] = "nice slurp"
        rows.append((i, " ".join(words)))
        marks.append((i, 1, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")


def test_held_out_quality(spark):
    docs, marks = made(spark)
    lexicon = learn_lexicon(docs, marks)
    rows = score_toxicity(docs, lexicon).join(marks, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert sum(r.predicted == r.toxic for r in held) >= 0.97 * len(held)
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    kept = drop_toxic(docs, lexicon)
    assert kept.columns == docs.columns and kept.count() == sum(not r.predicted for r in rows)


def test_labels_of_held_out_documents_are_not_used(spark):
    docs, marks = made(spark)
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    a, b = learn_lexicon(docs, marks), learn_lexicon(docs, marks.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic"))))
    assert a.weights == b.weights and a.curve == pytest.approx(b.curve)


def test_exceptions_are_learned(spark):
    rows = [(i, f"word{i} trash can day" if i % 3 else f"word{i} you trash human trash") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(600)], "doc_id long, toxic int")
    lexicon = learn_lexicon(docs, marks)
    a, b = lexicon.score(["a trash can day", "you trash human trash"])
    assert a < 0.5 < b


def test_odd_rows(spark, odd, odd_rows, none, labels):
    marks = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (6, None), (None, 1), (7, 0), (10, 1), (99, 1)], "doc_id long, toxic int")
    for lab in (marks, labels.limit(0), marks.where("toxic = 0"), labels):
        lexicon = learn_lexicon(odd, lab)
        rows = score_toxicity(odd, lexicon).collect()
        assert len(rows) == len(odd_rows) and all(0 <= r.score <= 1 for r in rows)
        assert drop_toxic(odd, lexicon).schema == odd.schema
    assert score_toxicity(none, learn_lexicon(none, labels)).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_signed_words_and_exceptions_match_scans(seed):
    """Exceptions and words with signs, many of each, against scans over all spans and hits."""
    rnd = random.Random(seed)
    lexicon = Lexicon({" idiot ": 3.0, " idio": 1.0, " loser ": 4.0, " los": 0.5}, (" village idiot ", " loser idiot loser ", " sore loser"))
    words = ["idiot", "idi07", "l0ser", "loser", "village", "sore", "1d10t", "id!ot", "fine", "lost", "v!llage", "2024"]
    folded, signed = fold_signed(" ".join(rnd.choice(words) for _ in range(60)))
    spared = [(m.start(), m.start() + len(e) - 1) for e in lexicon.exceptions for m in re.finditer(f"(?={e})", folded)]
    hits = lexicon.hits(folded)
    every = Lexicon(lexicon.weights).hits(folded)
    assert hits == {s: v for s, v in every.items() if not any(a <= s and v[1] <= b for a, b in spared)}
    want = dict(hits)
    for start, end, forms in signed:
        before, stop = folded[max(0, folded.rfind(" ", 0, start)):start], folded.find(" ", end + 1)
        looked = [lexicon.hits(f"{before} {f}{folded[end:stop + 1] if stop > 0 else ' '}") for f in forms]
        best = max((h[len(before)] for h in looked if len(before) in h), default=None)
        own = max((s for s in want if start <= s < end), key=lambda s: want[s], default=None)
        if best and (own is None or want[own][0] < best[0]):
            want[start if own is None else own] = (best[0], end)
    assert lexicon.hits_signed(folded, signed) == want


def test_long_texts_take_time_in_proportion():
    """5 MB of hits, exceptions and disguised words."""
    lexicon = Lexicon({" idiot ": 3.0, " loser ": 4.0}, (" village idiot ",))
    text = "village idiot idi07 loser fine words l0ser and 1d10t " * 100_000
    began = time.process_time()
    mass, share, number = lexicon.features(text)
    assert time.process_time() - began < 60 and number > 12
    short = lexicon.features(text[:5300])
    assert share == pytest.approx(short[1], rel=1e-2)
