"""cartpath: click-log session analytics as Spark DataFrame operators.

Each operator is a function ``DataFrame (+ parameters) -> DataFrame``::

    from cartpath import sessionize, train_test_split, cut_test_set, get_scores
    sessions = sessionize(events, gap_sec=1800)
    train, test = train_test_split(sessions, train_weeks=3, test_weeks=2)
    trimmed, labels, points = cut_test_set(test, seed=42)
    scores = get_scores(labels, predictions, k=20)
"""

from .operators.catalog import anchor_bounds, item_categories
from .operators.evaluation import evaluate_sessions, get_scores, mrr, num_events, recall
from .operators.labels import cut_at, cut_test_set, label_index, split_points
from .operators.sessions import mark_sessions, sessionize
from .operators.split import leakage_check, qualifying_sessions, split_bounds, train_test_split

__all__ = [
    "anchor_bounds", "item_categories", "evaluate_sessions", "get_scores", "mrr", "num_events",
    "recall", "cut_at", "cut_test_set", "label_index", "split_points", "mark_sessions",
    "sessionize", "leakage_check", "qualifying_sessions", "split_bounds", "train_test_split",
]
