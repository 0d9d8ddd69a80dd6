import hashlib

import numpy as np
import xxhash

from callwise.llm import exact_dedup, simhash
from tests.llm.conftest import collected


def lower(text):
    return (text or "").encode().lower()


def test_exact_groups_match_brute_force(make, odd):
    got = collected(exact_dedup.exact_duplicates(make(odd), prefix_bytes=4).drop("n_bytes", "prefix_hash"), "doc_id", "keep_id")
    documents = {(i, lower(t)) for i, t in odd}
    want = []
    for i, t in documents:
        ids = [j for j, u in documents if u == t]
        known = [j for j in ids if j is not None]
        keep = max(known) if known else None
        want.append((i, keep, sum(lower(u) == t for _, u in odd), i == keep))
    assert got == sorted(want, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def test_texts_that_share_length_and_prefix_are_told_apart(make):
    rows = [(1, "prefix-aaaa"), (2, "prefix-bbbb"), (3, "prefix-AAAA")]
    got = collected(exact_dedup.exact_duplicates(make(rows), prefix_bytes=6).select("doc_id", "keep_id", "kept"), "doc_id")
    assert got == [(1, 3, False), (2, 2, True), (3, 3, True)]


def test_exact_stage_keeps_columns_and_one_row(make, odd, spark):
    docs = make(odd)
    left = exact_dedup.drop_exact_duplicates(docs)
    assert left.columns == docs.columns
    texts = [lower(r["text"]) for r in left.select("text").collect()]
    assert sorted(texts) == sorted({lower(t) for _, t in odd})
    assert exact_dedup.drop_exact_duplicates(docs.limit(0)).count() == 0
    assert exact_dedup.exact_duplicates(docs.limit(0)).count() == 0


def test_texts_without_id_or_of_one_id_stay_apart(make):
    long = "p" * 300
    rows = [(None, "abc"), (5, "ABC"), (None, "xyz"), (7, "one"), (7, "two"), (9, "One"), (None, long + "a"), (None, long + "b"), (3, long + "c"), (3, long + "d"), (4, "Twice"), (4, "twice")]
    left = exact_dedup.drop_exact_duplicates(make(rows))
    want = [(None, long + "a"), (None, long + "b"), (None, "xyz"), (3, long + "c"), (3, long + "d"), (4, "twice"), (5, "abc"), (7, "two"), (9, "one")]
    got = [(i, t.lower()) for i, t in collected(left.select("doc_id", "text"), "doc_id")]
    assert sorted(got, key=lambda r: (r[0] or 0, r[1])) == sorted(want, key=lambda r: (r[0] or 0, r[1]))
    decided = exact_dedup.exact_duplicates(make(rows)).select("doc_id", "keep_id", "group_size", "kept")
    named = sorted((i or 0, k or 0, n, kept) for i, k, n, kept in decided.collect())
    assert named == sorted([(0, 5, 2, False), (5, 5, 2, True), (0, 0, 1, True), (7, 9, 2, False), (7, 7, 1, True), (9, 9, 2, True)] + [(0, 0, 1, True)] * 2 + [(3, 3, 1, True)] * 2 + [(4, 4, 2, True)])
    digests = [hashlib.sha256(lower(t)).hexdigest() for _, t in rows]
    per_row = collected(exact_dedup.with_copies(make(rows)).select("text_sha256", "doc_id"), "text_sha256", "doc_id")
    assert sorted((h, i or 0) for h, i in per_row) == sorted((h, i or 0) for h, (i, _) in zip(digests, rows, strict=True))


def fingerprint(text):
    words = lower(text).split()
    parts = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(parts))


def smallest_reachable(ids, fps, distance=2):
    best = dict(zip(ids, ids, strict=True))
    changed = True
    while changed:
        changed = False
        for i, a in zip(ids, fps, strict=True):
            low = min(best[j] for j, b in zip(ids, fps, strict=True) if (a ^ b).bit_count() <= distance)
            if low < best[i]:
                best[i], changed = low, True
    return best


def test_simhash_matches_brute_force(make, odd, words):
    base = words(400, 9)
    rows = [r for r in odd if r[0] is not None] + [(100 + k, base.replace(base.split()[k], "swap", 1)) for k in range(25)] + [(200, base), (201, base)]
    got = collected(simhash.simhash_groups(make(rows)), "doc_id")
    fps = [fingerprint(t) for _, t in rows]
    assert sorted((i, f & (2**64 - 1)) for i, f, *_ in got) == sorted((i, f) for (i, _), f in zip(rows, fps, strict=True))
    best = smallest_reachable([i for i, _ in rows], fps)
    assert all(c == best[i] for i, *_, c in got)
    assert len({c for *_, c in got}) < len({i for i, *_ in got})


def test_simhash_rows_without_id_and_empty_table(make, odd):
    got = simhash.simhash_groups(make([(None, "a b c d"), (3, "a b c d"), (None, "x y z")]))
    assert collected(got.select("doc_id", "component_id"), "doc_id", "component_id") == [(None, None), (None, 3), (3, 3)]
    assert simhash.simhash_groups(make([])).count() == 0
    docs = make(odd)
    left = simhash.drop_near_duplicates(docs)
    assert left.columns == docs.columns


def test_links_inside_a_list_connect_what_is_near():
    rng = np.random.default_rng(3)
    for n in (2, 40, 400):
        values = np.unique(rng.integers(0, 2**16 if n > 100 else 2**10, n).astype(np.uint64))
        a, b = simhash._links(values, 2)
        best = smallest_reachable(list(range(len(values))), [int(v) for v in values])
        label = list(range(len(values)))
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            old, new = label[y], label[x]
            label = [new if v == old else v for v in label]
        assert len(set(label)) == len(set(best.values()))
        assert all((label[i] == label[j]) == (best[i] == best[j]) for i in range(0, len(values), 7) for j in range(0, len(values), 5))


def test_digest_is_of_the_normalised_text(make):
    got = exact_dedup.digests(make([(1, "ÀBC")])).collect()[0]["text_sha256"]
    assert got == hashlib.sha256("Àbc".encode()).hexdigest()
