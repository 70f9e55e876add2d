"""License scans (operator 5).

One Aho-Corasick automaton over normalised words finds notice phrases and identifier tags.
Behind a tag (``SPDX-License-Identifier:``; its place goes back to the bytes of the text) an
and/or/with expression is read from the words as written, ordered by a shunting-yard parser and
evaluated: ``and`` demands every part, ``or`` leaves the choice of the least restrictive one,
``with`` grants an exception and lowers its licence by one class. A name is a family and a
version (``CC-BY-NC-3.0``, ``LGPL-2.0-or-later``, ``0BSD``). The score is the largest restriction among
the expressions and the phrases outside them: a phrase inside an expression is a piece of a name,
which counts through the expression alone.

Normalised words: capitals A-Z folded, runs of digits, letters a-z and everything above
ASCII. ``first`` and ``last`` count words from 0.

Defined cases: null and empty texts have no words, no labels and score 0; an expression is
read whole, however long its line is; a broken
expression keeps the labels read up to the fault; the restriction class of a name that is
not in the table is unknown (0.5) and gives no label; repeated rows and further columns
make no difference; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from itertools import accumulate

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, text_bytes, text_slices

# The base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Further notice phrases, their labels.
NOTICES = {
    "mit license": "mit", "permission is hereby granted free of charge": "mit", "apache license": "apache",
    "apache license version 2 0": "apache-2.0", "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd", "mozilla public license": "mpl",
    "eclipse public license": "epl", "lesser general public license": "lgpl", "affero general public license": "agpl",
    "general public license version 2": "gpl-2.0", "general public license version 3": "gpl-3.0",
    "cc by sa": "cc-by-sa", "cc by nc": "cc-by-nc", "cc by nd": "cc-by-nd", "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd", "cc0": "cc0", "public domain": "public-domain", "unlicense": "unlicense",
    "isc license": "isc", "creative commons attribution": "cc-by",
}
TAGS = ("spdx license identifier",)
TAG_WORDS = 3
# Restriction of a label, from 0 (none) to 1 (all rights kept).
CLASSES = {
    "public-domain": 0.0, "cc0": 0.0, "unlicense": 0.0, "mit": 0.2, "isc": 0.2, "bsd": 0.2, "apache": 0.2, "apache-2.0": 0.2,
    "cc-by": 0.2, "mpl": 0.4, "epl": 0.4, "lgpl": 0.4, "cc-by-sa": 0.6, "gpl": 0.6, "gpl-2.0": 0.6, "gpl-3.0": 0.6, "agpl": 0.8,
    "cc-by-nd": 0.8, "cc-by-nc": 0.8, "cc-by-nc-sa": 0.8, "cc-by-nc-nd": 0.9, "reserved": 1.0,
}
# Families of expression names with their labels; further families and their restriction.
FAMILIES = {
    "mit": "mit", "x11": "mit", "isc": "isc", "apache": "apache", "bsd": "bsd", "0bsd": "bsd", "mpl": "mpl", "epl": "epl",
    "lgpl": "lgpl", "gpl": "gpl", "agpl": "agpl", "cc-by": "cc-by", "cc-by-sa": "cc-by-sa", "cc-by-nc": "cc-by-nc", "cc-by-nd": "cc-by-nd",
    "cc-by-nc-sa": "cc-by-nc-sa", "cc-by-nc-nd": "cc-by-nc-nd", "cc0": "cc0", "cc-pddc": "public-domain", "unlicense": "unlicense",
    "wtfpl": "wtfpl", "zlib": "zlib", "bsl": "bsl", "ncsa": "ncsa", "postgresql": "postgresql", "psf": "psf", "python": "psf",
    "artistic": "artistic", "cddl": "cddl", "eupl": "eupl", "osl": "osl", "sspl": "sspl", "busl": "busl",
}
CLASSES |= {"wtfpl": 0.0, "zlib": 0.2, "bsl": 0.2, "ncsa": 0.2, "postgresql": 0.2, "psf": 0.2, "artistic": 0.4, "cddl": 0.4, "eupl": 0.6,
            "osl": 0.6, "sspl": 0.9, "busl": 0.9}
#: Families whose labels carry the version.
VERSIONED = ("gpl", "apache")
UNKNOWN = 0.5
FOUND = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
         "score double, expressions array<string>")

_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_GAP = re.compile(rb"[^0-9A-Za-z\x80-\xff(]*")
_WORD = re.compile(rb"[^ ]+")
_VERSION = re.compile(r"(.+?)-v?(\d+(?:\.\d+)*)(?:-[a-z0-9-]+)?")
_EXPRESSION = re.compile(rb"\(|\)|[A-Za-z0-9.+-]+|[\n\r]|\S")
_RANK = {"or": 1, "and": 2, "with": 3}
_automaton = None


def automaton():
    global _automaton
    if _automaton is None:
        _automaton = ahocorasick.Automaton()
        for phrase in {*BASE, *NOTICES, *TAGS}:
            _automaton.add_word(f" {phrase} ", phrase)
        _automaton.make_automaton()
    return _automaton


def parse_expression(words: Iterable[str]) -> tuple[list[str], int]:
    """Postfix form of the longest sound expression at the start, and the words it takes.

    Shunting yard: names go out, operators wait for those that bind tighter, brackets hold
    them back. ``with`` binds tightest, then ``and``, then ``or``. No word is read behind the
    first that cannot continue the expression."""
    out, stack, depth, name_next, good = [], [], 0, True, (0, [], 0)
    for i, word in enumerate(words):
        low = word.lower()
        if name_next:
            if word == "(":
                stack.append("(")
                depth += 1
                continue
            if word == ")" or low in _RANK:
                break
            out.append(low)
            name_next = False
        elif word == ")":
            if not depth:
                break
            while stack[-1] != "(":
                out.append(stack.pop())
            stack.pop()
            depth -= 1
        elif low in _RANK:
            while stack and stack[-1] != "(" and _RANK[stack[-1]] >= _RANK[low]:
                out.append(stack.pop())
            stack.append(low)
            name_next = True
        else:
            break
        if not depth and not name_next:
            # Outside brackets at most one operator of each rank waits.
            good = (len(out), stack[::-1], i + 1)
    return out[:good[0]] + good[1], good[2]


def name_label(name: str) -> str | None:
    """The label of a name: its family's, with the version where the family's labels carry it."""
    name = name.lower()
    for end in ("-only", "-or-later", "+"):
        name = name.removesuffix(end)
    if name in FAMILIES:
        return FAMILIES[name]
    m = _VERSION.fullmatch(name)
    label = FAMILIES.get(m.group(1)) if m else None
    return f"{label}-{m.group(2)}" if label in VERSIONED else label


def restriction_of(label: str) -> float:
    """The class of a label; a version that is not in the table has its family's class."""
    return CLASSES[label] if label in CLASSES else CLASSES[label.rsplit("-", 1)[0]]


def evaluate(postfix: list[str]) -> tuple[float, set[str]]:
    """Restriction of an expression and the labels of its names."""
    stack: list[tuple[float, set[str]]] = []
    for item in postfix:
        if item in _RANK:
            (b, lb), (a, la) = stack.pop(), stack.pop()
            if item == "with":
                stack.append((max(0.0, round(a - 0.2, 6)), la))
            else:
                stack.append((min(a, b) if item == "or" else max(a, b), la | lb))
        else:
            label = name_label(item)
            stack.append((restriction_of(label) if label else UNKNOWN, {label} if label else set()))
    return stack[0]


class _Words:
    """Names, operators and brackets from a place up to the end of the line, read on demand."""

    def __init__(self, text: bytes, start: int):
        self.ends, self.found = [], _EXPRESSION.finditer(text, start)

    def __iter__(self) -> Iterator[str]:
        for m in self.found:
            word = m.group().decode("latin-1")
            if word in "\n\r":
                return
            self.ends.append(m.end())
            yield word.rstrip(".") or "."


def read_expressions(text: bytes, tags: list[int]) -> tuple[list[list[str]], list[tuple[int, int]]]:
    """The expressions (postfix) behind the tags, given by their words' numbers, and the words that each takes."""
    spans = [m.span() for m in _WORD.finditer(text.translate(_WORDS))]
    found, taken = [], []
    for i in tags:
        words = _Words(text, _GAP.match(text, spans[i + TAG_WORDS - 1][1]).end())
        postfix, n = parse_expression(words)
        if postfix:
            found.append(postfix)
            taken.append((i, bisect_left(spans, (words.ends[n - 1],))))
    return found, taken


def scan(text: bytes) -> tuple:
    """n_words, n_base, first, last, base labels, all labels, score, expressions."""
    words = text.translate(_WORDS).split()
    if not words:
        return 0, 0, None, None, "", "", 0.0, []
    flat = f" {b' '.join(words).decode('latin-1')} "
    starts, hits, tags = [], [], []
    for end, phrase in automaton().iter(flat):
        # The blank before the phrase.
        at = end - len(phrase) - 1
        if phrase in BASE:
            starts.append(at)
        (tags if phrase in TAGS else hits).append((at, phrase))
    # Start of a phrase in the flat text -> its word's number.
    starts.sort()
    places = [flat.count(" ", 0, starts[k] + 1) - 1 for k in (0, -1)] if starts else [None, None]
    base = {BASE[p] for _, p in hits if p in BASE}
    labels = base | {NOTICES[p] for _, p in hits if p in NOTICES}
    expressions, outside = [], {p for _, p in hits}
    if tags:
        blanks = list(accumulate((len(w) + 1 for w in words), initial=0))
        number = lambda at: bisect_left(blanks, at)
        expressions, taken = read_expressions(text, [number(at) for at, _ in tags])
        begins = [a for a, _ in taken]

        def inside(at: int) -> bool:
            i = bisect_right(begins, number(at))
            return i > 0 and number(at) < taken[i - 1][1]

        outside = {p for at, p in hits if not inside(at)}
    restriction = [restriction_of(BASE[p] if p in BASE else NOTICES[p]) for p in outside]
    for postfix in expressions:
        value, names = evaluate(postfix)
        restriction.append(value)
        labels |= names
    return (len(words), len(starts), *places, ",".join(sorted(base)), ",".join(sorted(labels)),
            max(restriction, default=0.0), [" ".join(x) for x in expressions])


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Counts, places, labels, restriction (score) and expressions (postfix) of every row."""
    names = [x.split()[0] for x in FOUND.split(", ")]
    types = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.string())]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            rows = [(doc, *scan(text)) for doc, text in zip(batch.column("doc_id").to_pylist(), text_bytes(batch))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(find, FOUND)
