"""Conversation structure repair: rank-convergence parallel Viterbi over chunks of turns.

A conversation may be as long as the table, so it is cut into chunks of turns in their order. The cheapest repair is a
shortest path over (turn, state), where the state is what the repaired roles so far allow next. Costs run backwards: a
chunk turns the vector of costs at its end into the one at its start.

1. Every chunk starts from a speculative vector (the one at a conversation's end).
2. Fix-up passes: a chunk takes the vector at the start of the next chunk for its end and runs again, old and new vector
   side by side, only until both differ by a constant; from there on all choices are the same. Passes end when no start
   moved. Vectors become parallel within a few turns; a run of chunks in which they never do costs a pass per chunk.
3. With the costs at all ends, a chunk maps each state at its start to one at its end. Maps that do not depend on the
   state (nearly all) end the chain of dependence; the others are composed in doubling steps.
4. A forward walk takes the least letter among the cheapest edits at each step, which gives the least audit.

Turns that must go (blank ones, duplicates) add the same to every cost, so they are counted between the other turns and
take no part in the vectors; equal turns are counted before they are sorted. So neither a conversation that holds a
third of all rows nor a turn that repeats in all of it makes a large task. Only the hash of one repaired text is one
sequence by its nature: its chunks stream through one task, one chunk in memory at a time.

Defined results: null role and text are one space; a null ``conv_id`` is a conversation of its own; turns sort with nulls
first and then by role and by the SHA-256 of the text; a role without first letter s, u or a (also an empty one) cannot
be kept; an empty table gives no rows; texts are whole whatever their length; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from callwise.llm.common import reachable
from callwise.sources.staging import local_rows, stage

#: A chunk ends at either bound; a longer text is a chunk of its own.
CHUNK_TURNS = 256
CHUNK_BYTES = 4 << 20

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
LETTERS = "sua"
#: States: nothing yet, after the system turn, a user turn is open, an answer closed it. The next inserted or reroled turn.
NEXT = (2, 2, 3, 2)
ROLE = {2: "user", 3: "assistant"}
KEPT = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (3, 1): 2, (2, 2): 3}
END = (0, 2 * INSERT, INSERT, 0)
BLANKS = " \t\n\x0b\x0c\r"

CHUNK = "part int, seq bigint, conv_id {id}, opens boolean, closes boolean, codes binary, gone array<bigint>, roles array<string>, texts array<string>, head string, tail string, blank bigint, duplicate bigint, truncated bigint, illegal bigint"
PIECE = "conv_id {id}, gid bigint, audit string, cost bigint, turns array<struct<role:string,text:string>>, blank bigint, duplicate bigint, truncated bigint, illegal bigint"
COUNTS = ("blank", "duplicate", "truncated", "illegal")


class Costs:
    """Steps of the shortest path; each (code, vector) is worked out once, vectors count from their least entry."""

    def __init__(self) -> None:
        self.steps: dict = {}
        self.moves: dict = {}

    @staticmethod
    def options(code: int, after: tuple) -> tuple:
        """Costs at each state before a turn, given those after it (absolute, from the same base)."""
        late = TRUNCATED if code >= 4 else 0
        plain = []
        for q in range(4):
            best = min(DELETE + after[q], REROLE + late + after[NEXT[q]])
            kept = KEPT.get((q, code % 4))
            plain.append(best if kept is None else min(best, KEEP + late + after[kept]))
        out = list(plain)
        for _ in range(3):
            out = [min(plain[q], INSERT + out[NEXT[q]]) for q in range(4)]
        return tuple(out)

    def back(self, code: int, after: tuple) -> tuple:
        found = self.steps.get((code, after))
        if found is None:
            costs = self.options(code, after)
            found = self.steps[code, after] = tuple(c - min(costs) for c in costs)
        return found

    def vectors(self, codes: bytes, end: tuple) -> list[tuple]:
        out = [end]
        for code in reversed(codes):
            out.append(self.back(code, out[-1]))
        out.reverse()
        return out

    def start(self, codes: bytes, end: tuple) -> tuple:
        for code in reversed(codes):
            end = self.back(code, end)
        return end

    def again(self, codes: bytes, old: tuple, new: tuple, start: tuple) -> tuple:
        """The start for end ``new``, where ``old`` gave ``start``: stops where both differ by a constant."""
        for code in reversed(codes):
            if old == new:
                return start
            old, new = self.back(code, old), self.back(code, new)
        return new

    def move(self, code: int, q: int, after: tuple) -> tuple[str, int, int]:
        """``(letters, state, cost)`` at one turn: inserted turns, then what becomes of it."""
        found = self.moves.get((code, q, after))
        if found is None:
            costs, letters, at, spent = self.options(code, after), "", q, 0
            late = TRUNCATED if code >= 4 else 0
            while True:
                kept = KEPT.get((at, code % 4))
                if costs[at] == DELETE + after[at]:
                    found = letters + "D", at, spent + DELETE
                elif costs[at] == INSERT + costs[NEXT[at]]:
                    letters, at, spent = letters + "I", NEXT[at], spent + INSERT
                    continue
                elif kept is not None and costs[at] == KEEP + late + after[kept]:
                    found = letters + "K", kept, spent + KEEP + late
                else:
                    found = letters + "R", NEXT[at], spent + REROLE + late
                break
            self.moves[code, q, after] = found
        return found

    def exits(self, codes: bytes, end: tuple) -> list[int]:
        """The state after the chunk for each state before it."""
        after = self.vectors(codes, end)[1:]
        states = [0, 1, 2, 3]
        for code, costs in zip(codes, after, strict=True):
            if len(set(states)) == 1:
                states = [self.move(code, states[0], costs)[1]] * 4
            else:
                states = [self.move(code, q, costs)[1] for q in states]
        return states

    def walk(self, codes: bytes, gone: list, roles: list, texts: list, entry: int, end: tuple, closes: bool) -> tuple[str, int, list]:
        """``(audit, cost, turns)`` of a chunk. Turns that must go are deleted first: D is the least letter."""
        after = self.vectors(codes, end)[1:]
        letters, cost, turns, q = [], 0, [], entry
        for i, code in enumerate(codes):
            done, state, spent = self.move(code, q, after[i])
            letters.append("D" * gone[i] + done)
            cost += DELETE * gone[i] + spent
            for _ in range(len(done) - 1):
                q = NEXT[q]
                turns.append({"role": ROLE[q], "text": ""})
            if done[-1] != "D":
                turns.append({"role": roles[i] if done[-1] == "K" else ROLE[NEXT[q]], "text": texts[i]})
            q = state
        letters.append("D" * gone[-1])
        cost += DELETE * gone[-1]
        while closes and q in (1, 2):
            q = NEXT[q]
            letters.append("I")
            cost += INSERT
            turns.append({"role": ROLE[q], "text": ""})
        return "".join(letters), cost, turns


def _illegal(a: str, b: str) -> bool:
    return a + b not in ("su", "ua", "au")


def _arrow(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def damaged(rows: DataFrame) -> DataFrame:
    """The faults of the contract, dealt by ``crc32(conv_id:turn) % 20`` (see ``op11_conversations``)."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    dealt = rows.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), (F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20).alias("deal"))
    changed = dealt.filter("deal <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("deal") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("deal") == 1, "").when(F.col("deal") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("deal") == 3, 2).otherwise(1))).alias("copy"),
    )
    return changed.drop("copy")


def _marked(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(turns, counted)``: a row per turn that may stay with its text, and per group of equal turns that must go."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    role = F.coalesce(F.col("role").cast("string"), F.lit(" "))
    at = F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce(F.col("turn").cast("bigint"), F.lit(0)).alias("turn"))
    plain = rows.select("conv_id", at.alias("at"), role.alias("role"), text.alias("text"))
    plain = plain.withColumn("digest", F.sha2("text", 256)).withColumn("is_blank", F.length(F.translate("text", BLANKS, "")) == 0)
    counted = stage(plain.groupBy("conv_id", "at", "role", "digest", "is_blank").agg(F.count("*").alias("n")), "turns")
    same = ["conv_id", "role", "digest"]
    firsts = counted.filter("not is_blank").groupBy(*same).agg(F.min("at").alias("at"))
    keys = [*same, "at"]
    right = firsts.select(*[F.col(k).alias(f"f_{k}") for k in keys], F.lit(1).alias("is_first"))
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"f_{k}"))
    marked = counted.join(right, on, "left").select(*keys, "is_blank", (F.col("n") - F.coalesce("is_first", F.lit(0))).alias("n")).filter("n > 0")
    texts = plain.filter("not is_blank").groupBy(*same).agg(F.min("at").alias("at"), F.min("text").alias("text"))
    return texts.select(*keys, F.lit(0).alias("must_go"), "text", F.lit(0).cast("bigint").alias("n"), F.lit(False).alias("is_blank")).unionByName(
        marked.select(*keys, F.lit(1).alias("must_go"), F.lit(None).cast("string").alias("text"), "n", "is_blank")
    ), counted


def _cut(schema: str, turns: int, size: int):
    """Chunks of a sorted partition. ``opens`` and ``closes`` are corrected at the partition's ends by the caller."""
    kinds = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held, ready, ready_bytes = TaskContext.get().partitionId(), 0, None, [], 0

        def fresh(conv, opens):
            return {"part": part, "conv_id": conv, "opens": opens, "codes": bytearray(), "gone": [0], "roles": [], "texts": [], "head": None, "tail": None, "size": 0, **dict.fromkeys(COUNTS, 0)}

        def close(chunk, closes):
            nonlocal seq, ready_bytes
            ready_bytes += chunk.pop("size")
            ready.append(chunk | {"seq": seq, "closes": closes, "codes": bytes(chunk["codes"])})
            seq += 1

        def out():
            nonlocal ready_bytes
            rows = pa.RecordBatch.from_pylist(ready, kinds)
            ready.clear()
            ready_bytes = 0
            return rows

        for batch in batches:
            for row in batch.to_pylist():
                conv, text, initial = row["conv_id"], row["text"], row["role"][:1]
                if held is None:
                    held = fresh(conv, True)
                elif held["conv_id"] != conv:
                    close(held, True)
                    held = fresh(conv, True)
                elif not row["must_go"] and (len(held["codes"]) >= turns or held["size"] + len(text) > size and held["codes"]):
                    last = held["tail"]
                    close(held, False)
                    held = fresh(conv, False) | {"tail": last}
                if held["head"] is None:
                    held["head"] = initial
                if held["tail"] is not None:
                    held["illegal"] += _illegal(held["tail"], initial)
                held["tail"] = initial
                if row["must_go"]:
                    n = row["n"]
                    held["blank" if row["is_blank"] else "duplicate"] += n
                    held["illegal"] += (n - 1) * _illegal(initial, initial)
                    held["gone"][-1] += n
                else:
                    open_end = text.rstrip(BLANKS)[-1] not in ".!?"
                    held["truncated"] += open_end
                    held["codes"].append((LETTERS.find(initial) if initial and initial in LETTERS else 3) + 4 * open_end)
                    held["gone"].append(0)
                    held["roles"].append(row["role"])
                    held["texts"].append(text)
                    held["size"] += len(text)
                if ready_bytes > size or len(ready) > 1000:
                    yield out()
        if held is not None:
            close(held, True)
        if ready:
            yield out()

    return run


def _chunks(rows: DataFrame, turns: int, size: int) -> tuple[DataFrame, DataFrame]:
    """Written chunks in global order ``gid``, and the counted turns."""
    marked, counted = _marked(rows)
    order = ["conv_id", "at", "role", "digest", "must_go"]
    columns = marked.select(*order, "text", "n", "is_blank")
    kind = dict(columns.dtypes)["conv_id"]
    schema = CHUNK.format(id=kind)
    cut = columns.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "role", "must_go", "text", "n", "is_blank").mapInArrow(_cut(schema, turns, size), schema)
    cut = stage(cut, "chunks")
    # a row per task that wrote chunks: where its first and last conversation go on in the tasks beside it
    ends = cut.groupBy("part").agg(F.max("seq").alias("n"), F.min(F.struct("seq", "conv_id", "head")).alias("first"), F.max(F.struct("seq", "conv_id", "tail")).alias("last"))
    ends = sorted(ends.collect(), key=lambda r: r["part"])  # as many rows as tasks
    base, fixed = 0, []
    for i, r in enumerate(ends):
        back = i > 0 and ends[i - 1]["last"]["conv_id"] == r["first"]["conv_id"]
        on = i + 1 < len(ends) and ends[i + 1]["first"]["conv_id"] == r["last"]["conv_id"]
        fixed.append((r["part"], base, r["n"], back, on, int(back and _illegal(ends[i - 1]["last"]["tail"], r["first"]["head"]))))
        base += r["n"] + 1
    places = local_rows(cut.sparkSession, fixed, "part int, base bigint, final bigint, back boolean, on boolean, pair int")
    at_first, at_last = F.col("seq") == 0, F.col("seq") == F.col("final")
    chunks = cut.join(F.broadcast(places), "part").select(
        (F.col("base") + F.col("seq")).alias("gid"),
        "conv_id",
        (F.col("opens") & ~(at_first & F.col("back"))).alias("opens"),
        (F.col("closes") & ~(at_last & F.col("on"))).alias("closes"),
        "codes", "gone", "roles", "texts", "blank", "duplicate", "truncated",
        (F.col("illegal") + F.when(at_first, F.col("pair")).otherwise(0)).alias("illegal"),
    )
    return chunks, counted


def _each(make, schema: str):
    """Run ``make(costs)``, a function of a row, over Arrow batches."""
    kinds = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = make(Costs())
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_pylist([each(r) for r in batch.to_pylist()], kinds)

    return run


def _speculated(costs: Costs):
    return lambda r: {"gid": r["gid"], "opens": r["opens"], "closes": r["closes"], "codes": r["codes"], "end": list(END), "start": list(costs.start(r["codes"], END)), "moved": True}


def _fixed_up(costs: Costs):
    def each(r):
        old, new, start = tuple(r["end"]), tuple(r["next_start"] or r["end"]), tuple(r["start"])
        fixed = start if old == new else costs.again(r["codes"], old, new, start)
        return {"gid": r["gid"], "opens": r["opens"], "closes": r["closes"], "codes": r["codes"], "end": list(new), "start": list(fixed), "moved": fixed != start}

    return each


def _mapped(costs: Costs):
    def each(r):
        exits = costs.exits(r["codes"], tuple(r["end"]))
        return {"gid": r["gid"], "opens": r["opens"], "end": r["end"], "exits": [exits[0]] * 4 if r["opens"] else exits}

    return each


def _walked(costs: Costs):
    def each(r):
        audit, cost, turns = costs.walk(r["codes"], r["gone"], r["roles"], r["texts"], r["entry"], tuple(r["end"]), r["closes"])
        return {"conv_id": r["conv_id"], "gid": r["gid"], "audit": audit, "cost": cost, "turns": turns, **{c: r[c] for c in COUNTS}}

    return each


def _decided(parts: DataFrame) -> DataFrame:
    """``(gid, end, entry)`` of the chunks of cut conversations: costs by fix-up passes, states by composed maps."""
    vector = "gid bigint, opens boolean, closes boolean, codes binary, end array<bigint>, start array<bigint>, moved boolean"
    known = stage(parts.select("gid", "opens", "closes", "codes").mapInArrow(_each(_speculated, vector), vector), "vectors")
    while True:
        after = known.select((F.col("gid") - 1).alias("gid"), F.col("start").alias("next_start"))
        inner = known.join(after, "gid", "left").withColumn("next_start", F.when(~F.col("closes"), F.col("next_start")))
        known = stage(inner.mapInArrow(_each(_fixed_up, vector), vector), "vectors")
        if known.filter("moved").isEmpty():
            break
    mapped = "gid bigint, opens boolean, end array<bigint>, exits array<int>"
    maps = stage(known.select("gid", "opens", "end", "codes").mapInArrow(_each(_mapped, mapped), mapped), "maps")
    step = 1
    while not maps.filter(F.size(F.array_distinct("exits")) > 1).isEmpty():
        before = maps.select((F.col("gid") + step).alias("gid"), F.col("exits").alias("earlier"))
        through = F.transform("earlier", lambda q: F.element_at("exits", q + 1))
        maps = stage(maps.join(before, "gid", "left").withColumn("exits", F.when(F.col("earlier").isNotNull(), through).otherwise(F.col("exits"))).drop("earlier"), "maps")
        step *= 2
    before = maps.select((F.col("gid") + 1).alias("gid"), F.col("exits")[0].alias("entry"))
    return maps.drop("exits").join(before, "gid", "left").select("gid", "end", F.when(F.col("opens"), 0).otherwise(F.col("entry")).alias("entry"))


def _pieces(rows: DataFrame, turns: int, size: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(whole, cut, counted)``: repaired chunks of conversations in one chunk and in several, and the counted turns."""
    reachable(rows.sparkSession)
    chunks, counted = _chunks(rows, turns, size)
    schema = PIECE.format(id=dict(chunks.dtypes)["conv_id"])
    alone = F.col("opens") & F.col("closes")
    whole = chunks.filter(alone).withColumn("end", F.array(*[F.lit(x).cast("bigint") for x in END])).withColumn("entry", F.lit(0))
    parts = chunks.filter(~alone)
    decided = _decided(parts) if not parts.isEmpty() else None
    cut = parts.join(decided, "gid") if decided is not None else whole.filter("false")
    return whole.mapInArrow(_each(_walked, schema), schema), cut.mapInArrow(_each(_walked, schema), schema), counted


def _lines(turns: str):
    return F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")


def _streamed(schema: str):
    """Sums, audit and hash of conversations whose chunks come in order; one chunk's text is in memory at a time."""
    kinds = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def done():
            row = {k: v for k, v in held.items() if k in kinds.names} | {"audit": "".join(held["letters"]), "repaired_sha256": held["hash"].hexdigest()}
            return pa.RecordBatch.from_pylist([row], kinds)

        for batch in batches:
            for r in batch.to_pylist():
                if held is not None and held["conv_id"] != r["conv_id"]:
                    yield done()
                    held = None
                if held is None:
                    held = {"conv_id": r["conv_id"], "cost": 0, "letters": [], "hash": hashlib.sha256(), "lines": False, **dict.fromkeys(COUNTS, 0)}
                for k in ("cost", *COUNTS):
                    held[k] += r[k]
                held["letters"].append(r["audit"])
                if r["body"]:
                    held["hash"].update(b"\n" * held["lines"] + r["body"].encode())
                    held["lines"] = True
        if held is not None:
            yield done()

    return run


def repaired_turns(rows: DataFrame, turns: int = CHUNK_TURNS, size: int = CHUNK_BYTES) -> DataFrame:
    """The repaired conversations: ``(conv_id, gid, place, role, text)``, in order of ``gid`` and ``place``."""
    whole, cut, _ = _pieces(rows, turns, size)
    return whole.unionByName(cut).select("conv_id", "gid", F.posexplode("turns").alias("place", "t")).select("conv_id", "gid", "place", "t.role", "t.text")


def repair_conversations(rows: DataFrame, turns: int = CHUNK_TURNS, size: int = CHUNK_BYTES) -> DataFrame:
    """Faults, cheapest repair and hash of the repaired text of every conversation of ``(conv_id, turn, role, text)``.

    Columns: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``. The allowed roles
    are an optional system turn and then pairs of user and assistant, or nothing at all.
    """
    whole, cut, counted = _pieces(rows, turns, size)
    schema = f"conv_id {dict(rows.dtypes)['conv_id']}, cost bigint, audit string, repaired_sha256 string, " + ", ".join(f"{c} bigint" for c in COUNTS)
    names = ["conv_id", *COUNTS, "cost", "audit", "repaired_sha256"]
    once = whole.withColumn("repaired_sha256", F.sha2(_lines("turns"), 256)).select(*names)
    lines = cut.withColumn("body", _lines("turns")).drop("turns").repartition("conv_id").sortWithinPartitions("conv_id", "gid")
    found = once.unionByName(lines.mapInArrow(_streamed(schema), schema).select(*names))
    number = F.when(F.col("at.known"), F.col("at.turn"))
    gaps = counted.groupBy("conv_id").agg(F.coalesce(F.max(number) - F.min(number) + 1 - F.count_distinct(number), F.lit(0)).alias("gaps"))
    gaps = gaps.withColumnRenamed("conv_id", "g_conv_id")
    return found.join(gaps, F.col("conv_id").eqNullSafe(F.col("g_conv_id"))).select("conv_id", "gaps", *names[1:])


def with_all(found: DataFrame, rows: DataFrame) -> DataFrame:
    """``found`` with a row of zeros, an empty audit and the hash of nothing for each conversation of ``rows`` not in it."""
    every = rows.select(F.col("conv_id").alias("o_conv_id")).distinct()
    joined = every.join(found, F.col("conv_id").eqNullSafe(F.col("o_conv_id")) & F.col("cost").isNotNull(), "left")
    zero = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("gaps", *COUNTS, "cost")]
    return joined.select(F.col("o_conv_id").alias("conv_id"), *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
