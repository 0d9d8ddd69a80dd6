from collections import Counter

import numpy as np

from callwise.llm import substring_dedup as S
from tests.llm.conftest import collected


def classes(rows, length):
    """Smallest doc_id reachable through equal runs of ``length`` words."""
    words = {i: (t or "").encode().lower().split() for i, t in rows if i is not None}
    root, first = {i: i for i in words}, {}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, w in words.items():
        for k in range(len(w) - length + 1):
            j = first.setdefault(tuple(w[k : k + length]), i)
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return {i: find(i) for i in words}


def test_compact_windows_are_the_cartesian_tree_nodes():
    rng = np.random.default_rng(1)
    for _ in range(200):
        n, least = int(rng.integers(1, 60)), int(rng.integers(2, 9))
        v = rng.integers(1, 40, n).astype(np.uint64)
        v[rng.random(n) < 0.08] = 0
        want = []
        for c in np.flatnonzero(v):
            a = b = c
            while a > 0 and v[a - 1] > v[c]:
                a -= 1
            while b < n - 1 and v[b + 1] >= v[c]:
                b += 1
            if b - a + 1 >= least:
                want.append((c, a, b))
        assert list(zip(*(x.tolist() for x in S.compact_windows(v, least, 64)), strict=True)) == want


def test_exact_passages_of_any_place_are_found(make, words, odd):
    rows = [r for r in odd if r[0] != 8]
    for k in range(40):
        passage = words(51 + k % 9, 1000 + k // 4)
        rows.append((100 + k, f"{words(k * 5, 2000 + k)} {passage.upper() if k % 3 == 0 else passage} {words(200 - k * 5, 3000 + k)}"))
    shared = words(30, 77)
    rows += [(300 + k, f"{words(60, 4000 + k)} {shared} {words(60, 5000 + k)}") for k in range(20)]  # too short to count
    got = {r["doc_id"]: r["component_id"] for r in S.repeated_passages(make(rows)).collect()}
    want = classes(rows, 51)
    size = Counter(want.values())
    assert got == {i: c for i, c in want.items() if size[c] > 1}


def test_copies_and_one_passage_in_all_documents(make, words):
    passage = words(70, 8)
    rows = [(k, f"{words(30 + k % 17, 100 + k)} {passage} {words(20, 900 + k)}") for k in range(150)] + [(500 + k, words(120, 9)) for k in range(80)]
    sides = [[words(30 + k % 17, 100 + k).split()[::-1] for k in range(150)], [words(20, 900 + k).split() for k in range(150)]]

    def shared(lists, k):
        same = lambda x, y: next((n for n, (v, w) in enumerate(zip(x, y, strict=False)) if v != w), len(x))
        return max(same(lists[k], lists[j]) for j in range(150) if j != k)

    result = S.repeated_passages(make(rows)).collect()
    got = {r["doc_id"]: r["component_id"] for r in result}
    assert got == {**{k: 0 for k in range(150)}, **{500 + k: 500 for k in range(80)}}
    for r in result:
        if r["doc_id"] < 150:
            own = 30 + r["doc_id"] % 17
            # two documents may have the same word beside the passage by chance; it then belongs to what they share
            before, after = (shared(t, r["doc_id"]) for t in sides)
            assert all(own - before <= p["first"] and p["end"] <= own + 70 + after for p in r["passages"])


def test_near_copies_link_and_unrelated_texts_do_not(make, words):
    text = words(300, 11).split()
    edited = [w if k % 40 != 20 else "changed" for k, w in enumerate(text)]  # no 42 words in a row are the same
    rows = [(1, " ".join(text)), (2, " ".join(edited)), (3, words(300, 12))]
    got = collected(S.repeated_passages(make(rows)).select("doc_id", "component_id"), "doc_id")
    assert got == [(1, 1), (2, 1)]


def test_passages_on_one_diagonal_stay_apart(make, words):
    head, tail = words(60, 21), words(60, 22)
    rows = [(k, f"{head} {words(500, 30 + k)} {tail}") for k in (1, 2)]
    result = S.repeated_passages(make(rows)).collect()
    assert [r["component_id"] for r in result] == [1, 1]
    for r in result:
        (a, b), (c, d) = [tuple(p) for p in r["passages"]]
        assert 0 <= a <= S.STEP and 60 - S.STEP <= b <= 60 and 560 <= c <= 560 + S.STEP and 620 - S.STEP <= d <= 620


def test_near_passages_of_documents_already_linked_are_reported(make, words):
    licence, text = words(60, 41), words(200, 42).split()
    edited = [w if k % 40 != 20 else "changed" for k, w in enumerate(text)]  # no 42 words in a row are the same
    rows = [(k, f"{licence} {words(90, 50 + k)} {' '.join(t)}") for k, t in ((1, text), (2, edited))]
    rows += [(k, f"{licence} {words(90, 50 + k)}") for k in (3, 4, 5)]
    got = {r["doc_id"]: (r["component_id"], [tuple(p) for p in r["passages"]]) for r in S.repeated_passages(make(rows)).collect()}
    assert {i: c for i, (c, _) in got.items()} == dict.fromkeys(range(1, 6), 1)
    for i in (1, 2):
        first, end = got[i][1][-1]
        assert first < 190 and end > 310
    assert all(end <= 60 for i in (3, 4, 5) for _, end in got[i][1])


def jaccard(left, right):
    one, two = set(left), set(right)
    return len(one & two) / len(one | two)


def test_stretches_are_those_of_brute_force():
    rng = np.random.default_rng(3)
    hits = 0
    for _ in range(150):
        left = rng.permutation(1000)[: int(rng.integers(8, 26))].astype(np.uint64)
        right = [int(v) for v in left if rng.random() > 0.08]
        for _ in range(int(rng.integers(0, 6))):
            right.insert(int(rng.integers(0, len(right) + 1)), int(rng.integers(2000, 9000)))
        right = np.array(right, np.uint64)
        best = 0
        for a in range(len(left)):
            for b in range(a + 8, len(left) + 1):
                for c in range(len(right)):
                    for d in range(c + 8, len(right) + 1):
                        if min(b - a, d - c) > best and jaccard(left[a:b].tolist(), right[c:d].tolist()) >= 0.8:
                            best = min(b - a, d - c)
        found = S.similar_stretches(left, right, 0, 8, 0.8)
        assert all(jaccard(left[a:b].tolist(), right[c:d].tolist()) >= 0.8 and min(b - a, d - c) >= 8 for a, b, c, d in found)
        # brute force may end a stretch on a place that only one text has
        assert bool(found) == (best >= 8) or best < 11
        hits += bool(found)
    assert 30 < hits < 150


def test_stretches_apart_and_repeated_shingles():
    left, right = np.arange(400, dtype=np.uint64), np.arange(400, dtype=np.uint64)
    right[100:300] = 999
    right[[30, 340]] = 999
    assert S.similar_stretches(left, right, 0, 46, 0.8) == [(0, 100, 0, 100), (300, 400, 300, 400)]
    right[::3] = 999
    assert S.similar_stretches(left, right, 0, 46, 0.8) == []
    same = np.zeros(60, np.uint64)
    ((a, b, c, d),) = S.similar_stretches(same, same[:50], 0, 46, 0.8)
    assert b - a == d - c == 50  # any 50 of the 60


def edited(words, kind, seed, size):
    w = words(size, seed).split()
    k = 5 + seed * 7 % (size - 10)
    return " ".join({"insert": [*w[:k], "brandnew", *w[k:]], "delete": w[:k] + w[k + 1 :], "replace": [*w[:k], "brandnew", *w[k + 1 :]]}[kind])


def test_recall_of_edited_passages(make, words):
    """Pairs that share a passage with one or two words inserted, deleted or replaced, between unlike words of their own."""
    rows, pairs = [], []
    for n, (kind, size) in enumerate((k, z) for k in ("insert", "delete", "replace") for z in (60, 80)):
        for k in range(40):
            i, seed = 1000 * (n + 1) + 2 * k, 10_000 * (n + 1) + k
            rows.append((i, f"{words(60, seed + 200)} {words(size, seed)} {words(60, seed + 400)}"))
            rows.append((i + 1, f"{words(30 + k, seed + 600)} {edited(words, kind, seed, size)} {words(90, seed + 800)}"))
            if jaccard(*[S.shingles([t.encode()])[0].tolist() for t in (words(size, seed), edited(words, kind, seed, size))]) >= 0.8:
                pairs.append((i, kind, size))
    got = {r["doc_id"]: (r["component_id"], r["passages"]) for r in S.repeated_passages(make(rows)).collect()}
    found = Counter((kind, size) for i, kind, size in pairs if got.get(i, (0,))[0] == i and got.get(i + 1, (0,))[0] == i)
    asked = Counter((kind, size) for _, kind, size in pairs)
    assert len(asked) == 6
    assert all(found[k] >= 0.9 * asked[k] for k in asked)
    assert all(c in (i, i - 1) for i, (c, _) in got.items())  # nothing links that was not planted
    for i, _, size in pairs:
        if i in got:
            assert all(p["first"] >= 60 - 8 and p["end"] <= 60 + size + 8 for p in got[i][1])


def test_edited_passage_in_very_many_documents(make, words):
    """Over FREQUENT windows of one key in a batch, each document with edits of its own."""
    passage = words(90, 8).split()
    rows = []
    for k in range(700):
        at = 3 + k % 84
        rows.append((k, f"{words(20, 100 + k)} {' '.join([*passage[:at], f'w{k}', *passage[at:]])} {words(20, 2000 + k)}"))
    got = {r["doc_id"]: r["component_id"] for r in S.repeated_passages(make(rows)).collect()}
    assert got == dict.fromkeys(range(700), 0)


def test_pairs_around_a_line_that_all_documents_share(make, words):
    """The line is in more documents than meet at once; each pair shares what follows, but for one word."""
    line = words(26, 8)
    rows = [(k, f"{words(40, 100 + k)} {line} own{k} {words(24, 5000 + k // 2)} {words(40, 900 + k)}") for k in range(3 * S.FULL)]
    got = {r["doc_id"]: r["component_id"] for r in S.repeated_passages(make(rows)).collect()}
    assert got == {k: k // 2 * 2 for k, _ in rows}


def test_texts_that_repeat_one_word_do_not_all_meet(make, words):
    """A word that stands 25 times in a row makes no passage; its documents are not compared in pairs."""
    docs = make([(k, f"{words(40, 100 + k)} {'the ' * 25}{words(40, 900 + k)}") for k in range(2 * S.FULL)])
    rows = S.paired(S.windows(docs)).filter(S.F.col("kind") != S.REPEAT).cache()
    none = docs.sparkSession.createDataFrame([], "node bigint, component bigint")
    assert rows.filter(S.F.col("kind") == S.CANDIDATE).count() == 0
    assert S.crossing(rows.filter(S.F.col("kind") == S.LEFT), none).count() == 0


def test_passages_around_a_repeated_word(make, words):
    """A word put into or taken out of what repeats; few shingles are unlike, the longest varied run has 15."""
    rows = []
    for n, (x, y) in enumerate(((14, 14), (8, 20), (20, 8))):
        one, two = words(x, 10 + n), words(y, 20 + n)
        for k, between in enumerate(("the " * 30, "the " * 13 + "brandnew " + "the " * 16, "the " * 26)):
            rows.append((10 * n + k, f"{words(30, 300 + 10 * n + k)} {one} {between}{two} {words(30, 600 + 10 * n + k)}"))
    got = {r["doc_id"]: r["component_id"] for r in S.repeated_passages(make(rows)).collect()}
    assert got == {i: i // 10 * 10 for i, _ in rows}


def test_passages_of_two_repeated_words(make, words):
    """Few shingles, each repeated another number of times; the first word is in more documents than meet at once."""
    rows = [(k, f"{words(30, 100 + k)} {'the ' * (30 - k % 2 * 4)}{f'own{k // 2} ' * (25 + k % 2 * 4)}{words(30, 900 + k)}") for k in range(3 * S.FULL)]
    got = {r["doc_id"]: r["component_id"] for r in S.repeated_passages(make(rows)).collect()}
    assert got == {k: k // 2 * 2 for k, _ in rows}


def test_passages_that_end_on_unlike_words(make, words):
    """45 equal words are 41 of the 51 shingles of two passages of 50 words; 44 are 40 of 52."""
    rows = [(2 * n + k, f"{words(30, 100 + 2 * n + k)} {words(n, n)} {words(30, 900 + 2 * n + k)}") for n in (44, 45, 49) for k in (0, 1)]
    rows += [(k, words(45, 3)) for k in (1, 2)]  # too short
    got = {r["doc_id"]: r["component_id"] for r in S.repeated_passages(make(rows)).collect()}
    assert {i: c for i, c in got.items() if i >= 90} == {90: 90, 91: 90, 98: 98, 99: 98}
    assert not {1, 2} & got.keys()


def test_chain_is_a_longest_one():
    rng = np.random.default_rng(6)
    for _ in range(100):
        left, right = (rng.integers(0, int(rng.integers(2, 30)), int(rng.integers(2, 40))) for _ in "xy")
        size = np.zeros((len(left) + 1, len(right) + 1), int)
        for a, b in np.ndindex(len(left), len(right)):
            size[a + 1, b + 1] = max(size[a, b + 1], size[a + 1, b], size[a, b] + (left[a] == right[b]))
        i, j = S.aligned(left.astype(np.uint64), right.astype(np.uint64), 0)
        assert len(i) == size[-1, -1] and np.all(left[i] == right[j]) and np.all(np.diff(i) > 0) and np.all(np.diff(j) > 0)


def test_two_texts_of_one_document(make, words):
    one, two = words(70, 71), words(70, 72)
    rows = [(1, one), (1, two), (1, two), (2, edited(words, "insert", 71, 70)), (3, edited(words, "delete", 72, 70)), (4, words(90, 73))]
    got = {r["doc_id"]: r["component_id"] for r in S.repeated_passages(make(rows)).collect()}
    assert got == {1: 1, 2: 1, 3: 1}


def test_empty_and_odd_tables(make):
    assert S.repeated_passages(make([])).count() == 0
    assert S.repeated_passages(make([(1, None), (2, "a b"), (None, "x " * 100)])).count() == 0
