"""Phrase places against a plain search; expressions; odd rows."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cartpath.llm.licenses import BASE, evaluate, name_label, parse_expression, scan, scan_licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    places, found = [], set()
    for phrase, label in BASE.items():
        p = phrase.split()
        at = [i for i in range(len(words)) if words[i:i + len(p)] == p]
        places += at
        found |= {label} if at else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(found))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["CC", "by", "BY-NC", "general", "Public", "license", "all", "rights", "reserved", "reservedé", " ", "-", "\n", "0", "İ", "K"]), max_size=25),
       st.sampled_from([" ", "", ", "]))
def test_base_phrases(words, glue):
    text = glue.join(words)
    assert scan(text.encode())[:5] == plain(text)


@pytest.mark.parametrize("words, postfix", [
    ("MIT", "mit"), ("A or B and C", "a b c and or"), ("( A or B ) and C", "a b or c and"),
    ("GPL-2.0 WITH Classpath or MIT", "gpl-2.0 classpath with mit or"), ("A and B or C with D", "a b and c d with or"),
    ("A or B extra words", "a b or"), ("A and", "a"), ("( A or B", ""), ("or A", ""), ("", ""), ("A ) or B", "a"), ("( ( A ) )", "a")])
def test_expressions_are_parsed(words, postfix):
    assert " ".join(parse_expression(words.split())[0]) == postfix


@pytest.mark.parametrize("words, value, labels", [
    ("MIT OR GPL-3.0-only", 0.2, {"mit", "gpl-3.0"}), ("MIT AND GPL-3.0-or-later", 0.6, {"mit", "gpl-3.0"}),
    ("GPL-2.0+ WITH Classpath-exception-2.0", 0.4, {"gpl-2.0"}), ("Own-License OR AGPL-3.0", 0.5, {"agpl"}),
    ("(MIT OR AGPL-3.0) AND CC0-1.0", 0.2, {"mit", "agpl", "cc0"})])
def test_expressions_are_evaluated(words, value, labels):
    spaced = words.replace("(", "( ").replace(")", " )").split()
    assert evaluate(parse_expression(spaced)[0]) == (value, labels)


def test_tags_and_notices():
    text = "// SPDX-License-Identifier: (Apache-2.0 OR MIT)\nCode. Licensed under CC BY-NC 4.0. All rights reserved."
    n, n_base, first, last, base, labels, score, expressions = scan(text.encode())
    assert (base, labels, score, expressions) == ("cc-by,reserved", "apache-2.0,cc-by,cc-by-nc,mit,reserved", 1.0, ["apache-2.0 mit or"])
    assert scan(b"spdx-license-identifier: MIT.")[5:7] == ("mit", 0.2)
    assert scan("GNU General Public License, version 3".encode())[4:7] == ("gpl", "gpl,gpl-3.0", 0.6)
    assert scan(b"no licence here")[1:] == (0, None, None, "", "", 0.0, [])


def test_the_score_covers_all_labels():
    assert scan(b"SPDX-License-Identifier: MIT\nlicensed under CC BY NC ND")[4:] == ("cc-by", "cc-by,cc-by-nc,cc-by-nc-nd,mit", 0.9, ["mit"])
    # Pieces of names count through their expression: the choice of the least restrictive one stays.
    n, n_base, *_, base, labels, score, expressions = scan(b"SPDX-License-Identifier: CC-BY-NC-ND-4.0 OR MIT")
    assert (n_base, base, score, expressions) == (1, "cc-by", 0.2, ["cc-by-nc-nd-4.0 mit or"])
    assert scan(b"SPDX-License-Identifier: (CC-BY-NC-4.0 OR MIT) and more under cc by nc")[6] == 0.8
    assert scan(b"all rights reserved. SPDX-License-Identifier: MIT")[6] == 1.0


def test_tags_end_at_words():
    text = b"SPDX-License-Identifier: MIT\nMany SPDX-License-Identifiers GPL-3.0 are known"
    assert scan(text)[5:] == ("mit", 0.2, ["mit"])
    assert scan("xSPDX-License-Identifier: MIT".encode())[5:] == ("", 0.0, [])
    text = "é SPDX license\n identifier: Apache-2.0, then Übung SPDX-License-Identifier (GPL-2.0 WITH Own)".encode()
    assert scan(text)[5:] == ("apache-2.0,gpl-2.0", 0.4, ["apache-2.0", "gpl-2.0 own with"])


@pytest.mark.parametrize("name, label, value", [
    ("CC-BY-3.0", "cc-by", 0.2), ("LGPL-2.0-or-later", "lgpl", 0.4), ("0BSD", "bsd", 0.2), ("BSD-3-Clause", "bsd", 0.2), ("GPL-1.0+", "gpl-1.0", 0.6),
    ("Apache-1.1", "apache-1.1", 0.2), ("CC-BY-NC-SA-3.0-US", "cc-by-nc-sa", 0.8), ("MIT-0", "mit", 0.2), ("CC0-1.0", "cc0", 0.0), ("MPL-1.1", "mpl", 0.4),
    ("AGPL-1.0-only", "agpl", 0.8), ("Zlib", "zlib", 0.2), ("EUPL-1.2", "eupl", 0.6), ("Own-License", None, 0.5), ("GPL", "gpl", 0.6), ("CC-3.0", None, 0.5)])
def test_names_go_by_family_and_version(name, label, value):
    assert name_label(name) == label
    assert scan(f"SPDX-License-Identifier: {name}".encode())[6] == value


@pytest.mark.parametrize("form", ["{}", "({})", "(({}) AND MIT)"])
@pytest.mark.parametrize("names", [120, 1000, 100_000])
def test_long_expressions_are_read_whole(form, names):
    inner = " OR ".join(["GPL-2.0"] + ["Own-License"] * names + ["AGPL-3.0"])
    text = "SPDX-License-Identifier: " + form.format(inner) + "\nMPL-2.0 OR EPL-2.0"
    labels, score, (expression,) = scan(text.encode())[5:]
    both = "AND" in form
    assert labels == "agpl,gpl-2.0" + ",mit" * both and score == 0.5
    assert expression.split().count("own-license") == names and expression.split().count("or") == names + 1
    # The last alternative is the least restrictive one.
    free = text.replace("AGPL-3.0", "CC0-1.0")
    assert scan(free.encode())[5:7] == (("cc0,gpl-2.0,mit", 0.2) if both else ("cc0,gpl-2.0", 0.0))


def test_names_are_not_cut():
    for pad in range(960, 1010):
        text = "SPDX-License-Identifier: " + "A" * pad + " OR GPL-3.0-or-later"
        assert scan(text.encode())[5:7] == ("gpl-3.0", 0.5)


def test_documents_and_odd_rows(docs, odd, none):
    for table in (docs, odd):
        got = [tuple(r)[:6] for r in scan_licenses(table).collect()]
        assert sorted(got, key=str) == sorted([(r.doc_id, *plain(r.text)) for r in table.collect()], key=str)
    assert scan_licenses(none).count() == 0
