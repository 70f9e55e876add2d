"""End-to-end jobs: the reference's command-line scripts as Spark jobs on files.

Each job reads with explicit schemas, writes its outputs distributed (no driver collect)
and writes intermediates that several branches read below the checkpoint folder, so a lost
executor costs a re-read, not a re-run. Its own intermediates are deleted once its outputs
are complete.

    prepare_split(spark, "data/events.csv", "data/generated")            # train/test stage tables, CSV
    cut_test_sessions(spark, "data/generated/test_set.parquet", "data/generated") # trimmed + labels
    build_item_categories(spark, "data/generated/train_set.parquet", "data", "data/generated")
    score(spark, "data/generated/test_labels", "predictions.csv")         # one-row DataFrame
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..config import SEED, SESSION_GAP_SEC, TEST_WEEKS, TOP_K, TRAIN_WEEKS
from ..functions.materialize import materialize, temporary
from ..functions.sequence import without_place
from ..operators.catalog import anchor_bounds, item_categories
from ..operators.evaluation import get_scores
from ..operators.labels import cut_rows, points_of, test_labels, trimmed_sessions
from ..operators.sessions import sessionize
from ..operators.split import COLS, split_rows
from ..sources import files, sinks, stages


def prepare_split(spark: SparkSession, events_path: str, output_path: str,
                  train_weeks: int = TRAIN_WEEKS, test_weeks: int = TEST_WEEKS,
                  gap_sec: int = SESSION_GAP_SEC) -> tuple[DataFrame, DataFrame]:
    """Click-log CSV -> ``train_set`` and ``test_set``, each as a stage table (folder ``<set>.parquet``,
    sorted by session and time in ranges that later jobs read without an exchange) and as a CSV
    export (folder ``<set>``).

    Item ids stay text, as in the log. The log has no source sequence: ties inside one
    second are ordered by event type and item."""
    out = output_path.rstrip("/")
    with temporary(spark):
        sessions = materialize(sessionize(files.read_click_log(spark, events_path), gap_sec).sortWithinPartitions("timestamp"), "job-sessions")
        rows = materialize(split_rows(sessions, train_weeks, test_weeks), "job-split", partition_by="part")
        sets = []
        for part in ("train", "test"):
            path = f"{out}/{part}_set"
            sets.append(stages.write_sessions(rows.where(rows["part"] == part).drop("part"), f"{path}.parquet"))
            sinks.write_sessions(sets[-1], path)
    return tuple(without_place(s).select(*[c for c in COLS if c in s.columns]) for s in sets)


def _sessions(spark: SparkSession, path: str) -> DataFrame:
    """A stage table (``....parquet``) or its CSV export."""
    return stages.read_sessions(spark, path) if path.rstrip("/").endswith(".parquet") else files.read_sessions(spark, path)


def cut_test_sessions(spark: SparkSession, test_set_path: str, output_path: str,
                      seed: int = SEED, lists: bool = False) -> tuple[DataFrame, DataFrame]:
    """Test set (stage table or CSV) -> ``test_sessions`` (JSON lines, one per kept event, or with
    ``lists`` one list per session) and ``test_labels`` (JSON lines, one per session)."""
    out = output_path.rstrip("/")
    with temporary(spark):
        # The cut rows feed both outputs: positions and split points are computed once.
        cut = materialize(cut_rows(_sessions(spark, test_set_path), seed), "job-cut")
        write, read = ((sinks.write_trimmed_session_lists, files.read_trimmed_session_lists) if lists
                       else (sinks.write_trimmed_sessions, files.read_trimmed_sessions))
        write(trimmed_sessions(cut), f"{out}/test_sessions")
        sinks.write_labels(test_labels(cut, points_of(cut)), f"{out}/test_labels")
    return read(spark, f"{out}/test_sessions"), files.read_labels(spark, f"{out}/test_labels")


def build_item_categories(spark: SparkSession, train_set_path: str, input_path: str, output_path: str,
                          train_weeks: int = TRAIN_WEEKS, test_weeks: int = TEST_WEEKS) -> DataFrame:
    """Train set (stage table or CSV) + category tree + item property parts -> sorted ``item_categories`` CSV."""
    train = _sessions(spark, train_set_path)
    src = input_path.rstrip("/")
    tree = files.read_category_tree(spark, f"{src}/category_tree.csv")
    props = files.read_item_properties(spark, [f"{src}/item_properties_part1.csv",
                                               f"{src}/item_properties_part2.csv"], seconds=False)
    cats = item_categories(props, tree, anchor_bounds(train, train_weeks, test_weeks))
    out = f"{output_path.rstrip('/')}/item_categories"
    sinks.write_item_categories(cats, out)
    return files.read_item_categories(spark, out)


def score(spark: SparkSession, labels_path: str, predictions_path: str, k: int = TOP_K, strict: bool = True) -> DataFrame:
    """Labels JSON lines + predictions CSV -> one row of Recall@k and MRR per type. Raises on
    duplicates and, unless ``strict`` is False, on a predicted session without labels."""
    return get_scores(files.read_labels(spark, labels_path), files.read_predictions(spark, predictions_path), k, strict)
