import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
PROSE = ("the river ran past the old mill and the children threw stones into the slow brown water while their "
         "mother called them home for supper because the evening had grown cold and the lamps were lit")


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and long texts, ties, repeated rows."""
    long = " ".join(f"{w}{i % 700}" for i in range(3000) for w in ("wort", "mot"))
    return [
        (1, PROSE, "en", "a", 10), (1, PROSE, "en", "a", 10), (2, PROSE, "en", "b", 10), (2, PROSE + " again", "en", "b", None),
        (None, PROSE, "en", "a", 10), (None, None, None, None, None), (None, None, None, None, None),
        (3, None, "en", "a", 0), (4, "", "en", None, 0), (5, " \n\t ", None, "b", 4), (6, "word", "de", "a", 4),
        (7, long, "de", "c", len(long)), (8, "x" * 50_000, "fr", "c", 50_000), (9, "1234 !!! ???", "en", "c", 12),
        (10, "Zażółć gęślą jaźń 東京 😀 <|endoftext|>", None, "", 30)]


@pytest.fixture(scope="session")
def odd(spark, odd_rows, tmp_path_factory):
    """The same as a stored table, with further columns whose names the operators use themselves."""
    df = spark.createDataFrame(odd_rows, DOCS)
    extra = ("row", "key", "bin", "size", "score", "place", "node", "component", "target", "held_out", "_n", "range", "hash")
    path = str(tmp_path_factory.mktemp("odd") / "documents.parquet")
    df.selectExpr("*", *[f"'clash' AS {c}" for c in extra]).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")
