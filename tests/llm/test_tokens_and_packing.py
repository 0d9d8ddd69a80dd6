import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from callwise.llm import packing, token_counts, tokens
from tests.llm.conftest import collected

TEXTS = [
    "", " ", "a", " a", "a ", "a  b", "a\n\nb", "a \n b", "\n a", "don't stop", "x<|endoftext|>y", "<|endoftext|>", "  lead", "trail  ", "tab\tb",
    "Ünïcödé ß ŝ", "emoji \U0001f600 ‍ x", "nbsp here", "a　b c", "\x1c \x1d x", "12345 6,7", "é" * 50, "a" * 300, "a b\r\nc", "\u0085 x \u0085",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(tokens.VOCABULARY))


def test_pieces_encode_as_the_library(library, words):
    encoder = tokens.Encoder(cached=50)
    for text in [*TEXTS, words(500, 3), " ".join(TEXTS), "".join(TEXTS)]:
        for _ in range(2):
            assert np.frombuffer(encoder.ids(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_counts_match_the_library(make, library, odd):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(100 + k, t) for k, (_, t) in enumerate(odd)] + [(None, "a b")]
    got = collected(token_counts.token_counts(make(rows)), "doc_id")
    want = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows]
    assert got == sorted(want, key=lambda r: (r[0] is not None, r[0] or 0))
    assert token_counts.token_counts(make([])).count() == 0


def test_whole_tokens_are_proven(library):
    whole = tokens.whole_tokens()
    assert len(whole) > 40_000
    assert all(len(library.encode(s, add_special_tokens=False).ids) == 1 for s in list(whole)[::997])


def test_packing_is_an_exact_round_trip(make, library, odd, words):
    rows = [*odd, *[(300 + k, words(40 + 7 * k, k)) for k in range(60)], *[(500 + k, "same short text") for k in range(300)]]
    docs = make(rows)
    placed = packing.pack(docs)
    got = [r.asDict() for r in placed.collect()]
    ids = [(i, library.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in rows]
    pieces = []
    for i, whole in ids:
        cuts = packing.cut(len(whole), 1024)
        assert sum(n for _, n in cuts) == len(whole) and all(n == 1024 for _, n in cuts[1:])
        pieces += [(i, k, s, n, zlib.crc32(np.array(whole[s : s + n], "<u4").tobytes())) for k, (s, n) in enumerate(cuts)]
    key = lambda p: tuple(-1 if x is None else x for x in p)
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got), key=key) == sorted(pieces, key=key)
    used = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == used.get(r["sequence_id"], 0)
        used[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(used.values()) <= 1024 and sorted(used) == list(range(len(used)))
    assert len(used) <= -(-sum(used.values()) // 1024) + 1
    real = {r["sequence_id"]: list(r["ids"]) for r in packing.sequences(docs, placed).collect()}
    assert {k: len(v) for k, v in real.items()} == used
    by_doc = dict(ids)
    for r in got[:200]:
        if r["doc_id"] not in (None, 8):
            assert real[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] == by_doc[r["doc_id"]][r["start"] : r["start"] + r["length"]]
    assert packing.pack(make([])).count() == 0


def test_classes_are_matched_as_single_documents_would_be():
    rng = np.random.default_rng(2)
    for _ in range(60):
        sizes = rng.integers(1, 33, rng.integers(1, 200)).tolist()
        slots = packing.match_classes({s: sizes.count(s) for s in sizes}, 32)
        gaps = []
        for s in sorted(sizes, reverse=True):
            fit = min((g for g in gaps if g >= s), default=None)
            if fit is None:
                gaps.append(32 - s)
            else:
                gaps[gaps.index(fit)] = fit - s
        sequences = max(f + -(-n // per) for _, _, n, per, f, _ in slots)
        assert sequences == len(gaps)


def test_a_frequent_length_is_ranked_in_blocks(make, spark):
    rows = packing.pieces(make([(k, "equal length") for k in range(500)]).select("doc_id", "text"))
    from callwise.sources.staging import stage

    placed = packing.place(stage(rows, "pieces"), block_rows=40).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in placed}) == 500
