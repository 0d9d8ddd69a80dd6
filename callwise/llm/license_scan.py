"""License scan: exact phrases, and fuzzy search for short license notices.

A text is read as its words (ASCII letters in lower case, digits, everything beyond ASCII), joined by single spaces.

1. Exact phrases are found as runs of whole words.
2. A notice that may differ by k edits is split into k + 1 pieces. By the pigeonhole principle every occurrence with at
   most k edits holds one piece unchanged, so one Aho-Corasick scan for all pieces of all notices finds every candidate.
3. A candidate is the stretch in which the notice must then lie. If it is not there unchanged, ``regex`` matches the
   notice in it with at most k errors and gives the best span and its edits. Equal stretches are matched once per batch.

One scan per text, no shuffle; memory is one Arrow batch of whole texts. Work beyond the scan is a bounded match for each
stretch found, so a document full of notices costs in proportion to its length.

Defined results: null text is empty; an empty text has no words, no labels and score 0; rows that repeat are scanned each
for itself; an empty table gives no rows; rows without id are scanned like others; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import pairwise

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from callwise.llm.common import map_texts, texts

# fixed values: phrases and labels of the contract
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: Notices as words, with their label and the edits allowed: one for about twelve characters, as far as they stay distinct.
NOTICES = (
    ("licensed under the apache license version 2 0", "apache", 3),
    ("released under the mit license", "mit", 2),
    ("licensed under the mit license", "mit", 2),
    ("licensed under the gnu general public license", "gpl", 3),
    ("licensed under the gnu lesser general public license", "lgpl", 3),
    ("licensed under the gnu affero general public license", "agpl", 3),
    ("licensed under cc by", "cc-by", 1),
    ("licensed under cc by nc", "cc-by-nc", 0),
    ("licensed under cc by sa", "cc-by-sa", 0),
    ("licensed under a creative commons attribution", "cc-by", 3),
    ("permission is hereby granted free of charge to any person", "mit", 4),
    ("this program is free software you can redistribute it", "gpl", 4),
    ("redistribution and use in source and binary forms", "bsd", 4),
    ("subject to the terms of the mozilla public license", "mpl", 4),
    ("permission to use copy modify and or distribute this software", "isc", 4),
    ("free and unencumbered software released into the public domain", "unlicense", 4),
    ("distributed under the boost software license", "bsl", 3),
    ("no rights reserved", "cc0", 1),
)
REMEMBERED = 1 << 14

_SEPARATORS = bytes(b for b in range(128) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122))
_WORDS = bytes.maketrans(bytes(range(65, 91)) + _SEPARATORS, bytes(range(97, 123)) + b" " * len(_SEPARATORS))
_WORD = regex.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")  # in either case

SCHEMA = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, "
    "spans array<struct<label:string,start:bigint,end:bigint,edits:int>>"
)


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(_WORDS).split()


def pieces(notice: str, edits: int) -> list[tuple[int, str]]:
    """``edits + 1`` pieces of about equal length that cover the notice: ``(offset, piece)``."""
    cuts = [round(i * len(notice) / (edits + 1)) for i in range(edits + 2)]
    return [(a, notice[a:b]) for a, b in pairwise(cuts)]


class Scanner:
    """The pieces of all notices as one automaton, their patterns, and what equal stretches gave."""

    def __init__(self, notices: Sequence[tuple[str, str, int]]) -> None:
        self.notices = notices
        self.seeds = ahocorasick.Automaton()
        for number, (notice, _, edits) in enumerate(notices):
            for offset, piece in pieces(notice, edits):
                self.seeds.add_word(piece, [*self.seeds.get(piece, []), (number, offset, len(piece))])
        self.seeds.make_automaton()
        self.patterns = [regex.compile(f"(?b)(?:{regex.escape(n, literal_spaces=True)}){{e<={k}}}") for n, _, k in notices]
        self.best = lru_cache(REMEMBERED)(self._best)

    def _best(self, number: int, stretch: str) -> tuple[int, int, int] | None:
        """``(start, end, edits)`` of the best match in a stretch."""
        notice = self.notices[number][0]
        at = stretch.find(notice)
        if at >= 0:
            return at, at + len(notice), 0
        found = self.patterns[number].search(stretch)
        return found and (found.start(), found.end(), sum(found.fuzzy_counts))

    def stretches(self, joined: str) -> Iterator[tuple[int, int, int]]:
        """``(notice, start, end)`` around each seed, every stretch once while it stays the latest of its notice."""
        latest: dict[int, set] = {}
        for last, seeds in self.seeds.iter(joined):
            for number, offset, size in seeds:
                notice, _, edits = self.notices[number]
                start = last + 1 - size - offset
                span = max(0, start - edits), min(len(joined), start + len(notice) + edits)
                known = latest.setdefault(number, set())
                if span not in known:
                    if len(known) > 64:
                        known.clear()
                    known.add(span)
                    yield number, *span

    def matches(self, joined: str) -> list[tuple[int, int, int, int]]:
        """``(start, end, edits, notice)``: for each notice its matches that do not overlap, the fewest edits first."""
        found: dict[int, set] = {}
        for number, a, b in self.stretches(joined):
            best = self.best(number, joined[a:b])
            if best:
                found.setdefault(number, set()).add((a + best[0], a + best[1], best[2]))
        out = []
        for number, spans in found.items():
            group, reach = [], -1
            for span in [*sorted(spans), None]:
                if group and (span is None or span[0] >= reach):
                    out += [(*s, number) for s in _apart(group)]
                    group = []
                if span:
                    group.append(span)
                    reach = max(reach, span[1])
        return sorted(out)


def _apart(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of one cluster that do not overlap: the best, then the best on either side of it."""
    out, todo = [], [spans]
    while todo:
        group = todo.pop()
        if group:
            best = min(group, key=lambda s: (s[2], s[0], s[1]))
            out.append(best)
            todo += [[s for s in group if s[1] <= best[0]], [s for s in group if s[0] >= best[1]]]
    return out


def base_places(joined: bytes) -> tuple[list[int], set[str]]:
    """Numbers of the words at which a phrase stands, and the labels of the phrases."""
    framed, places, labels = b" " + joined + b" ", [], set()
    for phrase, label in PHRASES.items():
        sought, word, counted = b" " + phrase.encode() + b" ", 0, 0
        at = framed.find(sought)
        while at >= 0:
            word += framed.count(b" ", counted, at)
            counted = at
            places.append(word)
            labels.add(label)
            at = framed.find(sought, at + 1)
    return places, labels


def _located(raw: bytes, found: list[tuple[int, int, int, int]]) -> Iterator[tuple[int, int]]:
    """Code points of the text for places in the joined words; places come in order of their start."""
    text, starts, ends, at = raw.decode(), [], [], 0
    for m in _WORD.finditer(text):
        starts.append((at, m.start()))
        at += m.end() - m.start() + 1
        ends.append(at - 1)
    for a, b, *_ in found:
        i = min(bisect_left(ends, a + 1), len(starts) - 1)
        j = max(bisect_right(starts, (b - 1, len(text))) - 1, i)
        yield starts[i][1] + max(0, a - starts[i][0]), starts[j][1] + min(b, ends[j]) - starts[j][0]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", notices: Sequence[tuple[str, str, int]] = NOTICES) -> DataFrame:
    """Labels and spans of every text; columns of ``SCHEMA``.

    ``n_base``, ``first_word``, ``last_word`` and ``base_labels`` tell the exact phrases, ``labels`` adds the notices.
    ``spans`` are the notices found, in code points of the text, with their edits. ``score`` is 1 where a phrase or an
    unchanged notice stands, else the share of the best notice's characters that needed no edit, and 0 without any.
    """
    scanner: list[Scanner] = []
    kinds = to_arrow_schema(StructType.fromDDL(SCHEMA))

    def each(ids: list, raws: list) -> dict:
        if not scanner:
            scanner.append(Scanner(notices))
        out: dict[str, list] = {name: [] for name in kinds.names}
        for raw in raws:
            words = words_of(raw)
            joined = b" ".join(words)
            places, labels = base_places(joined)
            found = scanner[0].matches(joined.decode())
            spans = [
                {"label": notices[n][1], "start": a, "end": b, "edits": edits}
                for (a, b), (*_, edits, n) in zip(_located(raw, found) if found else (), found, strict=True)
            ]
            score = max((1 - edits / len(notices[n][0]) for *_, edits, n in found), default=0.0)
            row = (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))
            row += (",".join(sorted(labels | {s["label"] for s in spans})), 1.0 if places else score, spans)
            for name, value in zip(list(out)[1:], row, strict=True):
                out[name].append(value)
        return {name: pa.array(ids if name == "doc_id" else values, kinds.field(name).type) for name, values in out.items()}

    return map_texts(texts(docs, id_col, text_col), each, SCHEMA)
