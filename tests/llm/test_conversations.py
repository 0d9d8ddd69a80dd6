import hashlib
import re
import zlib
from functools import lru_cache

import numpy as np
import pytest

from callwise.llm import conversations as C
from callwise.llm.queries import QUERIES

SCHEMA = "conv_id bigint, turn bigint, role string, text string, audit string, gid int"
COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def plain_damage(rows):
    text = lambda x: " " if x is None else str(x)
    out = []
    for conv, turn, role, said in rows:
        role, said = text(role), text(said)
        deal = zlib.crc32(f"{text(conv)}:{text(turn)}".encode()) % 20
        if deal:
            said = "" if deal == 1 else re.sub("[.!?]", "", said) if deal == 2 else said
            out += [(conv, turn, "user" if deal == 4 else role, said)] * (2 if deal == 3 else 1)
    return out


def plain_repair(rows):
    """All edits at every turn and state, least cost and then least text, by recursion over whole strings."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).hexdigest()))
    seen, faults = set(), []
    for _, _, role, text in rows:
        last = re.sub(r"[\x20\x09-\x0D]", "", text)[-1:]
        faults.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else "")
        seen.add((role, text))
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    initials = lambda s: {"": "su", "s": "u", "u": "a", "a": "u"}[s[-1:]]

    @lru_cache(None)
    def best(i, last, inserted):
        out = []
        if i == len(rows) and last in ("", "a"):
            out.append((0, "", ()))
        if inserted < 3:
            to = "a" if last == "u" else "u"
            cost, audit, lines = best(i, to, inserted + 1)
            out.append((cost + 3, "I" + audit, (("user:" if to == "u" else "assistant:"), *lines)))
        if i < len(rows):
            (_, _, role, text), fault = rows[i], faults[i]
            cost, audit, lines = best(i + 1, last, 0)
            out.append((cost + 4, "D" + audit, lines))
            if fault not in ("blank", "duplicate"):
                late = 3 * (fault == "truncated")
                if role[:1] and role[:1] in initials(last):
                    cost, audit, lines = best(i + 1, role[:1], 0)
                    out.append((cost + late, "K" + audit, (f"{role}:{text}", *lines)))
                to = "a" if last == "u" else "u"
                cost, audit, lines = best(i + 1, to, 0)
                out.append((cost + 3 + late, "R" + audit, (f"{'user' if to == 'u' else 'assistant'}:{text}", *lines)))
        return min(out, default=(10**9, "", ()))

    cost, audit, lines = best(0, "", 0)
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return gaps, *(faults.count(x) for x in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def expected(rows, original=None):
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    out = {c: plain_repair(tuple(v)) for c, v in by.items()}
    for r in original or ():
        out.setdefault(r[0], (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()))
    return out


def got(df):
    rows = df.select(*COLUMNS).collect()
    out = {r["conv_id"]: tuple(r)[1:] for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.fixture(scope="module")
def table(spark):
    return lambda rows: spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def random_rows(seed, convs=40, longest=30):
    rng = np.random.default_rng(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "anna"]
    said = ["Yes.", "no", "Why?", " \t", "", "Go!", "a b c.", None, "Ünï?"]
    rows = []
    for conv in range(convs):
        turn = 0
        for _ in range(int(rng.integers(1, longest))):
            turn += int(rng.integers(0, 3))
            text = said[rng.integers(len(said))] if rng.random() < 0.4 else f"text {rng.integers(10**6)}{'.' if rng.random() < 0.8 else ''}"
            rows.append((conv, None if rng.random() < 0.03 else turn, roles[rng.integers(5 if rng.random() < 0.8 else len(roles))], text))
    return rows


def cleaned(rows):
    return [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]


@pytest.mark.parametrize("turns", [1, 3, 256])
def test_repair_equals_brute_force_for_any_chunk_size(table, turns):
    rows = random_rows(1, convs=25)
    assert got(C.repair_conversations(table(rows), turns=turns)) == expected(cleaned(rows))


def test_long_conversation_over_many_partitions(spark, table):
    rng = np.random.default_rng(3)
    rows = [(7, t, ["user", "assistant"][(t + (rng.random() < 0.1)) % 2], f"said {rng.integers(40 if t % 3 else 10**6)}{'.' if rng.random() < 0.9 else ''}") for t in range(600)]
    rows += [(c, t, "user", "Hm.") for c in (3, 9) for t in range(5)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = got(C.repair_conversations(table(rows).repartition(7), turns=4))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    import sys

    sys.setrecursionlimit(20_000)
    assert found == expected(rows)


def test_costs_that_never_become_parallel(table):
    rows = [(1, t, "system", f"text {t}") for t in range(12)] + [(2, t, "system", "S.") for t in range(9)] + [(3, t, "tool", f"{t}") for t in range(9)]
    assert got(C.repair_conversations(table(rows), turns=1)) == expected(rows)


def test_damage_and_conversations_without_turns(table):
    rows = [(c, t, r, x) for c, t, r, x in random_rows(2, convs=60, longest=6)]
    rows += [(None, 1, "user", "Hi."), (None, None, None, None), (None, 2, "assistant", "Yes."), (1000, 1, "user", "a " * 50_000 + ".")]
    rows += rows[:20]
    found = got(C.with_all(C.repair_conversations(C.damaged(table(rows))), table(rows)))
    assert found == expected(plain_damage(rows), rows)
    gone = [r for r in [(c, 0, "user", "Hi.") for c in range(200)] if not plain_damage([r])]
    assert set(got(C.with_all(C.repair_conversations(C.damaged(table(gone))), table(gone))).values()) == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_empty_table(table):
    assert C.with_all(C.repair_conversations(C.damaged(table([]))), table([])).collect() == []


def test_repaired_turns_are_legal_and_hash_alike(table):
    rows = random_rows(4, convs=20)
    report = got(C.repair_conversations(table(rows), turns=3))
    turns = {}
    for r in C.repaired_turns(table(rows), turns=3).orderBy("conv_id", "gid", "place").collect():
        turns.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    for conv, row in report.items():
        lines = turns.get(conv, [])
        assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in lines))
        assert hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest() == row[-1]


def test_query_on_the_given_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(QUERIES["op11_conversations"](spark, sf)) == expected(plain_damage(rows), rows)
