"""Explicit schemas of every table the library reads or writes (never inferred)."""

from pyspark.sql import types as T

L, S = T.LongType(), T.StringType()


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Raw click log as exported by the shop: timestamp in milliseconds.
RAW_EVENTS = _struct(("timestamp", L), ("visitorid", L), ("event", S), ("itemid", S),
                     ("transactionid", L))

# Sessionized rows (train and test sets). ``seq`` is the source order of the event and
# breaks ties between events of one visitor in the same second.
SESSIONS = _struct(("timestamp", L), ("event", S), ("itemid", L), ("session", L), ("seq", L))


def sessions(with_seq: bool = True, text_items: bool = False) -> T.StructType:
    """The session table's layout, with or without ``seq``, item ids as numbers or text."""
    seq = [("seq", L)] if with_seq else []
    return _struct(("timestamp", L), ("event", S), ("itemid", S if text_items else L), ("session", L), *seq)


CATEGORY_TREE = _struct(("categoryid", L), ("parentid", L))

# Time-versioned key/value item properties, timestamp in milliseconds.
ITEM_PROPERTIES = _struct(("timestamp", L), ("itemid", L), ("property", S), ("value", S))

ITEM_CATEGORIES = _struct(("itemid", L), ("categoryid", L), ("parentid", L))

LABEL_SETS = _struct(("addtocart", T.ArrayType(L)), ("transaction", T.ArrayType(L)))

# One JSON line per test session: {"session": 12, "labels": {"addtocart": [5]}}
LABELS_JSON = T.StructType([T.StructField("session", L, True),
                            T.StructField("labels", LABEL_SETS, True)])

# Trimmed test sessions, written one JSON line per kept event.
TRIMMED_EVENT_JSON = _struct(("session", L), ("pos", L), ("itemid", L), ("timestamp", L),
                             ("event", S))

# Trimmed test sessions as one list per session.
TRIMMED_LIST_JSON = _struct(("session", L), ("start", L), ("events", T.ArrayType(_struct(("itemid", L), ("timestamp", L), ("event", S)))))

# Predictions file: header line, then ``<session>_<type>,<id> <id> ...``
PREDICTIONS_CSV = _struct(("session_type", S), ("labels", S))
