"""Cross parsing against a plain longest-match parse; held-out accuracy; odd rows."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from cartpath.llm import language
from cartpath.llm.language import LanguageModel, keep_languages, learn_languages, predict_language, suffix_automaton


def plain_phrases(symbols, sample, piece):
    """Longest phrases that occur in the sample; an unseen symbol is a phrase."""
    count = 0
    for a in range(0, len(symbols), piece):
        part, i = symbols[a:a + piece], 0
        while i < len(part):
            n = 1
            while i + n <= len(part) and part[i:i + n] in sample:
                n += 1
            i += max(1, n - 1)
            count += 1
    return count


@pytest.mark.parametrize("seed", range(8))
def test_phrases_match_a_plain_parse(seed, monkeypatch):
    monkeypatch.setattr(language, "PIECE", 16)
    rnd = random.Random(seed)
    word = lambda letters: "".join(rnd.choice(letters) for _ in range(rnd.randint(1, 6)))
    samples = {"x": " ".join(word("abc") for _ in range(30)), "y": " ".join(word("bcdé") for _ in range(50))}
    model = LanguageModel(samples)
    texts = ["".join(rnd.choice("aBcdeé 1-z") for _ in range(rnd.randint(0, 80))) for _ in range(12)] + ["", "..."]
    counts, sizes = model.phrases(texts)
    for i, lang in enumerate(model.languages):
        sample = bytes(model.symbols(samples[lang]))
        for k, text in enumerate(texts):
            symbols = bytes(model.symbols(text))
            assert sizes[k] == len(symbols) and counts[k, i] == plain_phrases(symbols, sample, 16)


def scripts(n):
    """Languages with 20 letters of their own each, of one shared block beyond Latin."""
    rnd = random.Random(7)
    out = {}
    for i in range(n):
        letters = [chr(0x4E00 + 20 * i + k) for k in range(20)]
        out[f"l{i:03}"] = [" ".join("".join(rnd.choice(letters) for _ in range(rnd.randint(2, 6))) for _ in range(60)) for _ in range(6)]
    return out


def test_large_alphabets_are_told_apart():
    made = scripts(12)
    model = LanguageModel({lang: " ".join(texts[:5]) for lang, texts in made.items()})
    lang, score = model.predict([texts[5] for texts in made.values()])
    assert lang == list(made) and (score > 0.2).all()
    # The table follows the labelled text, not the number of letters.
    rnd = random.Random(1)
    wide = LanguageModel({"zh": "".join(chr(rnd.randrange(0x4E00, 0x4E00 + 3000)) for _ in range(16_000))})
    assert wide.width > 2500 and len(wide.table) < 20 * 16_000
    text = "".join(chr(rnd.randrange(0x4E00, 0x4E00 + 3500)) for _ in range(900))
    rnd = random.Random(1)
    sample = "".join(chr(rnd.randrange(0x4E00, 0x4E00 + 3000)) for _ in range(16_000))
    assert wide.phrases([text])[0][0, 0] == plain_phrases(text, sample, 1024)


def test_every_labelled_language_is_learned(spark):
    rows = [(100 * i + k, text, lang) for i, (lang, texts) in enumerate(scripts(80).items()) for k, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = learn_languages(docs)
    assert len(model.languages) == 80
    assert all(r.lang_pred == r.lang for r in predict_language(docs, model).join(docs.select("doc_id", "lang"), "doc_id").collect())


def test_groups_of_languages_give_the_same(spark, tmp_path):
    """Ten models of eight languages and one of all: the same languages and scores."""
    rows = [(100 * i + k, text, lang) for i, (lang, texts) in enumerate(scripts(80).items()) for k, text in enumerate(texts)]
    rows += [(9000, None, "l001"), (9001, "...", "l002"), (None, rows[3][1], None), (9002, "plain latin text that nobody has labelled here", "l003")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    whole, groups = learn_languages(docs), learn_languages(docs, group=8)
    assert groups.groups == 10 and all(len(groups.model(g).languages) == 8 for g in range(10))
    tell = lambda m: sorted(((r.doc_id, r.held_out, r.lang_pred, round(r.score, 9)) for r in predict_language(docs, m).collect()), key=str)
    assert tell(whole) == tell(groups)
    for wanted in (None, ["l001", "l017"]):
        kept = [sorted(map(str, keep_languages(docs, m, wanted=wanted).collect())) for m in (whole, groups)]
        assert kept[0] == kept[1] and 0 < len(kept[0]) < len(rows)


def test_automaton_knows_every_substring():
    s = [0, 1, 0, 1, 1, 2, 0]
    step = suffix_automaton(s)
    known = set()
    for a in range(len(s)):
        state = 0
        for c in s[a:]:
            state = step[state][c]
    for state in range(len(step)):
        known |= {state}
    assert len(step) <= 2 * len(s) and 3 not in step[0]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = predict_language(docs, learn_languages(docs)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows) and len(rows) == 1000
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held) and all(0 <= r.score <= 1 for r in rows)


def test_foreign_and_mislabelled_texts_go(spark):
    """The stage's decisions against a plain parse: texts of unlearned languages and of random letters go."""
    rnd = random.Random(5)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    samples = {}
    for r in docs.orderBy("doc_id").collect():
        if r.text and len(samples.get(r.lang, "")) < 16_000:
            samples[r.lang] = samples.get(r.lang, "") + " " + r.text[:1000]
    model = LanguageModel(samples)
    noise = [" ".join("".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(2, 9))) for _ in range(n)) for n in (30, 60, 400)]
    foreign = ["Wikipedia jest encyklopedią internetową działającą zgodnie z zasadą otwartej treści oraz wolnego dostępu dla wszystkich",
               "Tämä on suomenkielinen lause joka kertoo kauniista kesäpäivästä järven rannalla hyvien ystävien kanssa illalla",
               "Привет мир как дела сегодня хорошая погода на улице", "東京は日本の首都です。人口は多いです。", *noise]
    short = ["Ok", "a", "the", "Привет"]
    extra = [(10_000 + i, t, "en") for i, t in enumerate(foreign)] + [(20_000 + i, t, "fr") for i, t in enumerate(short)]
    every = docs.union(spark.createDataFrame(extra, docs.schema))
    rows = every.collect()
    kept = {r.doc_id for r in keep_languages(every, model).collect()}
    assert not kept & set(range(10_000, 20_000)) and kept >= {20_000, 20_001, 20_002, 20_003}
    assert kept >= {r.doc_id for r in rows if r.doc_id < 10_000 and r.text and any(map(str.isalpha, r.text))}
    samples = [bytes(model.symbols(samples[lang])) for lang in model.languages]
    for r in rnd.sample([r for r in rows if r.text and len(r.text) < 400], 60) + [r for r in rows if r.doc_id >= 10_000]:
        symbols = bytes(model.symbols(r.text))
        counts = [(plain_phrases(symbols, sample, 1024), i) for i, sample in enumerate(samples)]
        bits, best, count = min((c * model.bits[i] / max(1, len(symbols)), i, c) for c, i in counts)
        fits = max(0, count - 4) * model.bits[best] / max(1, len(symbols)) <= 6.5
        assert (r.doc_id in kept) == (fits and any(map(str.isalpha, r.text))), r
    only = {r.doc_id for r in keep_languages(docs, model, wanted=["de"]).collect()}
    found = {r.doc_id for r in predict_language(docs, model).collect() if r.lang_pred == "de"}
    assert only == found and found


def test_labels_of_held_out_documents_are_not_used(spark, docs):
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    other = docs.withColumn("lang", F.when(held, F.lit("zz")).otherwise(F.col("lang")))
    a, b = learn_languages(docs), learn_languages(other)
    assert a.languages == b.languages and (a.table == b.table).all()


def test_odd_rows(spark, odd, odd_rows, none):
    model = learn_languages(odd)
    rows = predict_language(odd, model).collect()
    assert len(rows) == len(odd_rows)
    for r in rows:
        assert r.lang_pred in {"en", "de", "fr", "und"} and not (r.doc_id is None and r.held_out)
    assert {r.doc_id for r in rows if r.lang_pred == "und"} == {None, 3, 4, 5, 9}
    assert [r.score for r in rows if r.lang_pred == "und"] == [0.0] * 6
    kept = keep_languages(odd, model)
    assert kept.schema == odd.schema and kept.count() == len(odd_rows) - 6
    assert predict_language(none, learn_languages(none)).count() == 0
    # Nothing to learn from: everything is und.
    blank = learn_languages(odd.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in predict_language(odd, blank).collect()} == {"und"}
