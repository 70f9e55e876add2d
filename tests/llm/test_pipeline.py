"""The pipeline stage by stage against brute force, odd rows, registration, plans."""

import sys
from collections import Counter
from fractions import Fraction

import corpus_pipeline
import pytest

import __spark_entry__ as entry
from cartpath.llm import language, toxicity
from cartpath.llm.mixing import mix_sources
from llm.conftest import SF
from llm.test_similarity import plain_components
from llm.test_tokens import expected, unpacked


def test_registered():
    queries = entry.queries()
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in queries) == 1
    assert queries["pipeline"] is corpus_pipeline.run and "op1_mix_sources" in entry.oracle_sql()
    assert [len(corpus_pipeline.STAGES), corpus_pipeline.ORACLE_SQL] == [5, None]


def test_stages_match_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, rows = docs.columns, [r.asDict() for r in docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        if name == "language_id":
            model = language.learn_languages(docs)
            want = [r for r in rows if model.predict([r["text"]])[0][0] != "und"]
        elif name == "toxicity":
            lexicon = toxicity.learn_lexicon(docs, spark.read.parquet(f"{SF}/labels.parquet"))
            want = [r for r in rows if lexicon.score([r["text"]])[0] < 0.5]
        elif name == "ngram_jaccard":
            comps = plain_components([(r["doc_id"], r["text"]) for r in rows], 5, Fraction("0.8"))
            want = [r for r, (d, n, c) in zip(rows, comps) if not n or c == d]
        elif name == "mix_sources":
            taken = {r.doc_id: (r.position1 is not None) + (r.position2 is not None) for r in mix_sources(docs).collect()}
            want = [r for r in rows for _ in range(taken[r["doc_id"]])]
        else:
            want = None
        out = stage(spark, docs, SF)
        path = str(tmp_path / name)
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        if want is not None:
            assert docs.columns == columns
            got = [r.asDict() for r in docs.collect()]
            assert Counter(map(str, got)) == Counter(map(str, want)) and got
            rows = got
    pieces, _ = unpacked(docs.collect(), 2048)
    packed = {}
    for r in rows:
        packed.setdefault(r["doc_id"], []).extend(expected(r["text"], 2048))
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in packed.items()}


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_odd_rows(spark, odd, odd_rows, none, tmp_path, name, stage):
    out = stage(spark, odd, SF)
    if name == "pack_documents":
        assert len(unpacked(out.collect(), 2048)[0]) == len({r[0] for r in odd_rows})
    else:
        assert out.columns == odd.columns and 0 < out.count() <= 2 * len(odd_rows)
    none.write.parquet(str(tmp_path / "none"))
    assert stage(spark, spark.read.parquet(str(tmp_path / "none")), SF).count() == 0


def test_clean_documents_are_kept(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    told = corpus_pipeline.language_id(spark, docs, "/root/testdata/sf0.01")
    clean = corpus_pipeline.remove_toxic(spark, told, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("toxic = 0")
    assert told.count() >= 0.99 * docs.count()
    assert clean.join(labels, "doc_id").count() >= 0.99 * told.join(labels, "doc_id").count()


def test_sharding_plan_is_native(spark):
    plan = entry.queries()["op9_ring_shards"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow")) and "CartesianProduct" not in plan


def test_entry_imports_without_the_subpackage(tmp_path):
    """The rest of the library imports and registers its queries when these folders are gone."""
    import shutil
    import subprocess
    root = tmp_path / "repo"
    shutil.copytree(entry._HERE, root, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), sorted(q for q in e.queries() if q.startswith('op') or q == 'pipeline'))"],
                          cwd=root, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin"})
    assert done.returncode == 0 and done.stdout.strip().endswith("[]"), done.stderr
