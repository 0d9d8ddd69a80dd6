import re

import numpy as np
import regex
from hypothesis import given, settings, strategies as st

from callwise.llm import license_scan as L
from callwise.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain_base(text):
    words, places, labels = WORD.findall(lower(text)), [], set()
    for phrase, label in L.PHRASES.items():
        sought = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(sought)] == sought:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def plain_labels(text, notices=L.NOTICES):
    """Every notice searched with its errors in the whole text, no seeds."""
    joined = " ".join(WORD.findall(lower(text)))
    found = {label for n, label, k in notices if regex.search(f"(?:{n}){{e<={k}}}", joined)}
    return ",".join(sorted(found | set(filter(None, plain_base(text)[4].split(",")))))


def edited(text, edits, rng):
    """``text`` with so many characters replaced, removed or put in."""
    chars = list(text)
    for _ in range(edits):
        at = int(rng.integers(len(chars)))
        kind = rng.integers(3)
        if kind == 0:
            chars[at] = "x"
        elif kind == 1 and len(chars) > 1:
            del chars[at]
        else:
            chars.insert(at, "q")
    return "".join(chars)


def test_pieces_cover_the_notice():
    for notice, _, k in L.NOTICES:
        cut = L.pieces(notice, k)
        assert "".join(p for _, p in cut) == notice and len(cut) == k + 1 and all(notice[o : o + len(p)] == p for o, p in cut)
    assert all(len(p) >= 6 for n, _, k in L.NOTICES for _, p in L.pieces(n, k))


def test_labels_equal_a_search_without_seeds(make, words):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(150):
        notice, _, k = L.NOTICES[i % len(L.NOTICES)]
        middle = edited(notice, int(rng.integers(0, k + 2)), rng)
        rows.append((i, f"{words(int(rng.integers(0, 30)), i)} {middle.upper() if i % 5 == 0 else middle} {words(int(rng.integers(0, 30)), 999 + i)}"))
    for r in L.scan(make(rows)).collect():
        text = rows[r["doc_id"]][1]
        assert r["labels"] == plain_labels(text), text
        assert tuple(r)[1:6] == plain_base(text)


def test_spans_point_into_the_text(make):
    text = "Ünï \U0001f600 -- Licenced  under the\nApache License, Version 2.0! Released undr the MIT-license; released under the mit license"
    (r,) = L.scan(make([(1, text)])).collect()
    spans = [(s["label"], text[s["start"] : s["end"]], s["edits"]) for s in r["spans"]]
    assert spans == [("apache", "Licenced  under the\nApache License, Version 2.0", 1), ("mit", "Released undr the MIT-license", 1), ("mit", "released under the mit license", 0)]
    assert (r["n_base"], r["first_word"], r["last_word"], r["score"]) == (3, 5, 18, 1.0)
    (r,) = L.scan(make([(1, "x relesed under the mit licence y")])).collect()
    assert (r["labels"], r["base_labels"], round(r["score"], 3)) == ("mit", "", 0.933)


def test_odd_rows(make, odd):
    rows = L.scan(make(odd)).orderBy("doc_id").collect()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(tuple(r)[1:])
    assert len(rows) == len(odd) and len(by[8]) == 2 and len(by[None]) == 2
    for i, text in odd:
        assert (*plain_base(text), plain_labels(text) if text and len(text) < 10_000 else "", 0.0, []) in by[i]
    assert L.scan(make([])).collect() == []


def test_long_text_full_of_notices(make):
    text = "Licensed under the Apache Licence, Version 2.0. CC BY! " * 20_000
    (r,) = L.scan(make([(1, text)])).collect()
    assert (r["n_words"], r["n_base"], len(r["spans"]), r["labels"]) == (200_000, 20_000, 20_000, "apache,cc-by")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["CC", "by", "cc by", "MIT", "license", "gnu", "General", "public", "apache", "é", "-", "_", "9", "\x00", " "]), max_size=20), st.sampled_from([" ", "-", "", "\n"]))
def test_base_places(parts, glue):
    text = glue.join(parts)
    words = L.words_of(text.encode())
    places, labels = L.base_places(b" ".join(words))
    assert (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))) == plain_base(text)


def test_query(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = QUERIES["op12_license_scan"](spark, "/root/testdata/sf0.001").collect()
    assert {r["doc_id"]: tuple(r)[1:6] for r in rows} == {i: plain_base(t) for i, t in docs.items()}
    assert all(0 <= r["score"] <= 1 for r in rows) and sum(r["n_base"] > 0 for r in rows) > 0
