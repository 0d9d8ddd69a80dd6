"""Secret scan with DataFrame functions only: three fixed patterns and windows of high entropy.

Regular expressions of Spark give matches but not their places. A text split by a pattern is the list of what stands
between the matches, so the running lengths of gaps and matches are the places, in code points. Running sums are taken in
blocks, so the work grows with the number of matches and not with its square.

Entropy: candidate strings are long runs of key characters, cut at "=", so that a key's name and its value are two. A
candidate is scanned in overlapping parts of bounded length. In a part a window slides over the characters and carries
the count of each character: a step changes the count of the one that leaves and of the one that enters, and by them the
sum of c*log2(c). The bound on the entropy depends on the character class of the candidate. Hot windows that overlap are
one span. Allow-listed candidates and spans are dropped: the list looks at the span's own characters, not at its neighbors.

No pattern repeats a group with backtracking, so none needs stack space by the length of a text. Defined results: null and
empty texts have no spans; each row is scanned by itself, repeated rows and rows without id too; texts are whole, however
long; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from callwise.llm.common import texts

# ---- fixed values: the patterns of the scan, in the order of their kinds ----
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_LENGTH, ACCESS_LENGTH, HEX_LENGTH = 6, 20, 24
KINDS = ("assign", "access", "hex", "entropy")
# ---- end of fixed values ----

#: A candidate is a maximal run of key characters.
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"
WINDOW = 20
#: Bits per character a window must exceed: (class, whole-candidate pattern, bound), the first that matches counts.
CLASSES = (
    ("hex", "^[0-9a-fA-F]+$", 3.0),
    ("alphanumeric", "^[A-Za-z0-9]+$", 3.7),
    ("base64", "^[A-Za-z0-9+/]+$", 3.8),
    ("identifier", "^[A-Za-z0-9+/_-]+$", 3.9),
)
#: Harmless candidates: UUID, path of plain words.
ALLOWED = (r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$", r"^/?(?:[a-z]{1,20}/)++[a-z_-]*[0-9]{0,4}$")
#: Harmless spans: no digit, no letter, placeholder.
ALLOWED_SPANS = (r"^[^0-9]*$", r"^[^A-Za-z]*$", r"(?i)example|sample|placeholder|dummy|changeme")
#: Running sums are taken in blocks of so many, windows in parts of so many characters.
BLOCK = 256
PART = 512
#: Key characters have codes from "+" to "z".
FIRST_CODE, CODES = ord("+"), ord("z") - ord("+") + 1


def _literal(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, which is worked out once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _running(lengths: str) -> str:
    """Sums of all earlier entries of an array of integers."""
    zero = "named_struct('at', 0, 'p', CAST(array() AS array<int>))"
    add = "(a, v) -> named_struct('at', a.at + {v}, 'p', concat(a.p, array(a.at)))"
    block = f"aggregate(slice(l, k * {BLOCK} + 1, {BLOCK}), {zero}, {add.format(v='v')})"
    blocks = f"transform(sequence(0, CAST((size(l) - 1) div {BLOCK} AS int)), k -> {block})"
    before = f"aggregate(q, {zero}, {add.format(v='v.at')}, a -> a.p)"
    return _let("l", lengths, _let("q", blocks, f"flatten(zip_with(q, {before}, (x, o) -> transform(x.p, v -> v + o)))"))


def _matches(kind: int, pattern: str, least: int, group: int = 0) -> Column:
    """Spans ``(start, kind, end, found)`` of the matches whose group has ``least`` characters or more, in order."""
    p = _literal(pattern)
    steps = f"zip_with(slice(split(text, {p}, -1), 1, size(f)), f, (x, y) -> named_struct('gap', length(x), 'long', length(y), 'found', y))"
    places = _running("transform(m, x -> x.gap + x.long)")
    span = f"named_struct('start', o + x.gap, 'kind', {kind}, 'end', o + x.gap + x.long, 'found', x.found)"
    spans = f"zip_with(m, {places}, (x, o) -> {span})"
    if group == 0:
        picked = f"filter({spans}, x -> length(x.found) >= {least})"
    else:
        both = f"zip_with({spans}, regexp_extract_all(text, {p}, {group}), (x, g) -> named_struct('s', x, 'n', length(g)))"
        picked = f"transform(filter({both}, x -> x.n >= {least}), x -> x.s)"
    return F.expr(_let("f", f"regexp_extract_all(text, {p}, 0)", _let("m", steps, picked)))


NONE = "CAST(array() AS array<struct<start:int,kind:int,end:int,found:string>>)"


def _if(guard: str, spans: Column) -> Column:
    """Most texts hold nothing; the guard is one cheap look."""
    return F.when(F.expr(guard), spans).otherwise(F.expr(NONE))


def _entropy_spans(window: int) -> Column:
    """Merged windows above the bound inside the candidates ``cand`` that no span of ``b0``, ``b1`` or ``b2`` covers."""
    table = "array(0D, " + ", ".join(f"{c}D * log2({c}D)" for c in range(1, window + 2)) + ")"  # c * log2(c) at place c + 1
    ranges = "CAST(array() AS array<struct<a:int,b:int>>)"
    put = lambda code, change: f"concat(slice(n, 1, {code} - 1), array(n[{code} - 1] + {change}), slice(n, {code} + 1, {CODES}))"
    # one character: its count and the sum after it entered, then after the one that leaves has left
    entered = _let("n", "a.n", f"named_struct('s', a.s + t[n[k[i - 1] - 1] + 1] - t[n[k[i - 1] - 1]], 'n', {put('k[i - 1]', 1)})")
    left = _let("n", "e.n", f"named_struct('s', e.s + t[n[k[i - {window + 1}] - 1] - 1] - t[n[k[i - {window + 1}] - 1]], 'n', {put(f'k[i - {window + 1}]', -1)})")
    now = _let("e", entered, f"IF(i > {window}, {left}, e)")
    begun = f"i - {window}"
    grown = (
        f"IF(size(a.r) > 0 AND element_at(a.r, -1).b >= {begun}, concat(slice(a.r, 1, size(a.r) - 1), array(named_struct('a', element_at(a.r, -1).a, 'b', i))), "
        f"concat(a.r, array(named_struct('a', {begun}, 'b', i))))"
    )
    hot = f"i >= {window} AND log2({window}) - w.s / {window} > c.bound"
    step = _let("w", now, f"named_struct('s', w.s, 'n', w.n, 'r', IF({hot}, {grown}, a.r))")
    zero = f"named_struct('s', 0D, 'n', array_repeat(0, {CODES}), 'r', {ranges})"
    slide = _let("k", f"transform(split(part, ''), x -> ascii(x) - {FIRST_CODE - 1})", f"aggregate(sequence(1, size(k)), {zero}, (a, i) -> {step}, a -> a.r)")
    parts = f"zip_with(p, slice(p, 2, size(p)), (x, y) -> concat(x, coalesce(left(y, {window - 1}), '')))"
    moved = f"transform({slide}, r -> named_struct('a', r.a + j * {PART}, 'b', r.b + j * {PART}))"
    each = _let("p", f"regexp_extract_all(c.found, '.{{1,{PART}}}', 0)", f"flatten(transform({parts}, (part, j) -> {moved}))")
    # ranges that touch become one: what begins a chain and what ends one, in order
    opens, closes = "filter(r, (x, i) -> i = 0 OR r[i - 1].b < x.a)", "filter(r, (x, i) -> i = size(r) - 1 OR r[i + 1].a > x.b)"
    spans = _let("r", each, f"zip_with({opens}, {closes}, (x, y) -> named_struct('start', c.start + x.a, 'kind', 3, 'end', c.start + y.b, 'found', substring(c.found, x.a + 1, y.b - x.a)))")
    bound = "CASE " + " ".join(f"WHEN c.found RLIKE {_literal(p)} THEN {b}D" for _, p, b in CLASSES) + " END"
    classed = f"transform(cand, c -> named_struct('start', c.start, 'found', c.found, 'bound', {bound}))"
    found = _let("t", table, f"flatten(transform({classed}, c -> {spans}))")
    harmless = " OR ".join(f"e.found RLIKE {_literal(p)}" for p in ALLOWED_SPANS)
    # the last span of a kind that begins at or before e, by halving: spans of a kind do not overlap
    middle = "CAST((z.lo + z.hi + 1) div 2 AS int)"
    halve = lambda b: f"aggregate(sequence(1, 31), named_struct('lo', 0, 'hi', size({b})), (z, i) -> IF(z.lo = z.hi, z, IF({b}[{middle} - 1].start <= e.start, named_struct('lo', {middle}, 'hi', z.hi), named_struct('lo', z.lo, 'hi', {middle} - 1))), z -> z.lo)"
    covered = " OR ".join(f"coalesce(get({b}, {halve(b)} - 1).end >= e.end, false)" for b in ("b0", "b1", "b2"))
    return F.expr(f"filter({found}, e -> NOT ({harmless}) AND NOT ({covered}))")


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``(doc_id, base, added)``: sorted spans ``(start, kind, end, found)`` in code points, end exclusive, per row.

    ``base`` has the matches of the fixed patterns, ``added`` the windows of high entropy that no base span covers. No shuffle.
    """
    source = texts(docs, id_col, text_col)
    base = source.select(
        "doc_id",
        "text",
        _if("contains(text, '=') OR contains(text, ':')", _matches(0, ASSIGN, ASSIGN_LENGTH, 2)).alias("b0"),
        _if("contains(text, 'AKIA')", _matches(1, ACCESS, ACCESS_LENGTH)).alias("b1"),
        # a run of 24 or more is the same match with or without the shorter runs before it
        _if(f"text RLIKE '[0-9a-f]{{{HEX_LENGTH},}}'", _matches(2, f"[0-9a-f]{{{HEX_LENGTH},}}", HEX_LENGTH)).alias("b2"),
        _if(f"text RLIKE {_literal(CANDIDATE)}", _matches(3, CANDIDATE, window)).alias("c"),
    )
    allowed = " OR ".join(f"s.found RLIKE {_literal(p)}" for p in ALLOWED)
    scanned = base.select("doc_id", "b0", "b1", "b2", F.array_sort(F.concat("b0", "b1", "b2")).alias("base"), F.expr(f"filter(c, s -> NOT ({allowed}))").alias("cand"))
    added = F.when(F.size("cand") > 0, _entropy_spans(window)).otherwise(F.expr(NONE))
    return scanned.select("doc_id", "base", F.array_sort(added).alias("added"))


def render(spans: Column | str) -> Column:
    """``kind:start:end`` by start, then kind, comma-joined."""
    name = f"array({', '.join(_literal(k) for k in KINDS)})"
    spans = F.col(spans) if isinstance(spans, str) else spans
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.element_at(F.expr(name), s["kind"] + 1), s["start"], s["end"])), ",")
