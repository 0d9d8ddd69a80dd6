"""DuckDB twins of the registered queries, written from the definitions and not from the Spark code."""

from __future__ import annotations

import math

from callwise.sources.campaign import CATEGORICAL, INTERCEPT, NUMERIC, OLD_INTERCEPT, OLD_WEIGHTS, WEIGHTS

CAMPAIGN = """
campaign AS (
WITH pre AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2001-07-01 00:00:00'),
o AS (SELECT o_custkey, COUNT(*) AS n_orders, MAX(o_orderdate) AS last_order,
        SUM(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS n_urgent,
        SUM(CASE WHEN o_orderpriority = '2-HIGH' THEN 1 ELSE 0 END) AS n_high,
        SUM(CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END) AS n_low
      FROM pre GROUP BY o_custkey),
l AS (SELECT o_custkey,
        SUM(CASE WHEN l_returnflag = 'A' THEN l_extendedprice ELSE 0.0 END) AS spend_a,
        SUM(CASE WHEN l_returnflag = 'N' THEN l_extendedprice ELSE 0.0 END) AS spend_n,
        SUM(CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0.0 END) AS spend_r
      FROM pre JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_custkey),
y AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-07-01 00:00:00'),
e AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'error')
SELECT c.c_custkey AS id,
       CASE WHEN c.c_custkey % 50 = 7 THEN NULL ELSE c.c_mktsegment END AS segment,
       n.n_name AS nation,
       CASE WHEN c.c_acctbal < 0 THEN NULL ELSE c.c_acctbal END AS income,
       CAST(o.last_order AS DATE) AS last_order,
       CAST(COALESCE(o.n_orders, 0) AS INT) AS n_orders,
       CAST(COALESCE(o.n_urgent, 0) AS INT) AS n_urgent,
       CAST(COALESCE(o.n_high, 0) AS INT) AS n_high,
       CAST(COALESCE(o.n_low, 0) AS INT) AS n_low,
       ROUND(COALESCE(l.spend_a, 0.0), 2) AS spend_a,
       ROUND(COALESCE(l.spend_n, 0.0), 2) AS spend_n,
       ROUND(COALESCE(l.spend_r, 0.0), 2) AS spend_r,
       CASE WHEN e.user_id IS NULL THEN 0 ELSE 1 END AS complain,
       CASE WHEN y.o_custkey IS NULL THEN 0 ELSE 1 END AS response
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN o ON o.o_custkey = c.c_custkey LEFT JOIN l ON l.o_custkey = c.c_custkey
LEFT JOIN y ON y.o_custkey = c.c_custkey LEFT JOIN e ON e.user_id = c.c_custkey)"""

BASE_COLUMNS = ["segment", "nation", "income", "last_order", "n_orders", "n_urgent", "n_high", "n_low", "spend_a", "spend_n", "spend_r", "complain", "response"]
DAY = "strftime(last_order, '%Y-%m-%d') AS last_order"
DATED = "dated AS (SELECT * REPLACE (strftime(last_order, '%Y-%m-%d') AS last_order) FROM campaign)"
COMPLETE = "complete AS (SELECT * FROM campaign WHERE segment IS NOT NULL AND income IS NOT NULL AND last_order IS NOT NULL)"
DOCS = """
docs AS (SELECT doc_id, lang, source, n_chars, CAST(length(text) - length(replace(text, ' ', '')) + 1 AS INT) AS n_words, toxic, quality
  FROM labels JOIN documents USING (doc_id))"""
ORACLE: dict[str, str] = {}


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


def add(name: str, *ctes: str, sql: str) -> None:
    ORACLE[name] = with_(*ctes) + sql if ctes else sql


def dbl(c: str) -> str:
    return f"CAST({c} AS DOUBLE)"


def r6(expr: str, name: str, digits: int = 6) -> str:
    return f"round({expr}, {digits}) AS {name}"


def bounds(source: str, cols: list[str], name: str = "bounds", group: str | None = None) -> str:
    """Quartile fences per column, for the whole source or per group."""
    items = ", ".join(
        f"quantile_cont({dbl(c)}, 0.25) - 1.5 * (quantile_cont({dbl(c)}, 0.75) - quantile_cont({dbl(c)}, 0.25)) AS lo_{c}, "
        f"quantile_cont({dbl(c)}, 0.75) + 1.5 * (quantile_cont({dbl(c)}, 0.75) - quantile_cont({dbl(c)}, 0.25)) AS hi_{c}"
        for c in cols
    )
    head = f"{group} AS grp, " if group else ""
    tail = f" GROUP BY {group}" if group else ""
    return f"{name} AS (SELECT {head}{items} FROM {source}{tail})"


def clamped(c: str) -> str:
    return f"CASE WHEN {c} < lo_{c} THEN lo_{c} WHEN {c} > hi_{c} THEN hi_{c} ELSE {dbl(c)} END"


def medians(source: str, cols: list[str], name: str = "medians") -> str:
    return f"{name} AS (SELECT " + ", ".join(f"quantile_cont({dbl(c)}, 0.5) AS md_{c}" for c in cols) + f" FROM {source})"


def mode_of(source: str, c: str) -> str:
    return f"(SELECT {c} FROM {source} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


def coded(source: str, c: str) -> str:
    """Dictionary of one column: the rank of each value in its own order."""
    return f"code_{c} AS (SELECT {c} AS v, row_number() OVER (ORDER BY {c}) - 1 AS code FROM (SELECT DISTINCT {c} FROM {source} WHERE {c} IS NOT NULL))"


FEATURES = (
    CAMPAIGN,
    bounds("campaign", NUMERIC),
    medians("campaign", NUMERIC),
    "features AS (SELECT id, " + ", ".join(f"COALESCE({clamped(c)}, md_{c}) AS {c}" for c in NUMERIC) + ", response FROM campaign, bounds, medians)",
)


def logistic(intercept: float, weights: dict[str, float]) -> str:
    terms = "".join(f" + ({w!r}) * {c}" for c, w in weights.items())
    return f"1.0 / (1.0 + exp(-({intercept!r}{terms})))"


SCORED = (
    *FEATURES,
    "scored AS (SELECT id, response AS label, "
    + f"round({logistic(INTERCEPT, WEIGHTS)}, 3) AS score, round({logistic(OLD_INTERCEPT, OLD_WEIGHTS)}, 3) AS old_score, n_orders, n_low FROM features)",
    "pred AS (SELECT *, CASE WHEN score >= 0.53 THEN 1 ELSE 0 END AS pred FROM scored)",
)


def sizes(counts: str, share: str, name: str) -> str:
    """Rows per class of one holdout: floors, then the largest remainders."""
    return f"""
{name}_t AS (SELECT cls, n, CAST(ceil({share} * sum(n) OVER ()) AS BIGINT) AS total, CAST(sum(n) OVER () AS BIGINT) AS alln FROM {counts}),
{name}_f AS (SELECT *, (total * n) // alln AS fl, (total * n) % alln AS rem FROM {name}_t),
{name} AS (SELECT cls, n, CAST(fl + CASE WHEN row_number() OVER (ORDER BY rem DESC, cls) <= total - sum(fl) OVER () THEN 1 ELSE 0 END AS BIGINT) AS take FROM {name}_f)"""


def hashed(source: str) -> str:
    return f"hashed AS (SELECT *, row_number() OVER (PARTITION BY response ORDER BY md5(concat(id, '-250')), id) AS pos FROM {source})"


def split(source: str) -> tuple[str, ...]:
    return (
        f"counts AS (SELECT response AS cls, count(*) AS n FROM {source} GROUP BY response)",
        sizes("counts", "0.1::DOUBLE", "first"),
        "rest AS (SELECT cls, n - take AS n FROM first)",
        sizes("rest", "0.2::DOUBLE", "second"),
        hashed(source),
        "split AS (SELECT h.* EXCLUDE (pos), CASE WHEN pos <= f.take THEN 'serving' WHEN pos <= f.take + s.take THEN 'eval' ELSE 'train' END AS split "
        "FROM hashed h JOIN first f ON f.cls = h.response JOIN second s ON s.cls = h.response)",
    )


ALL = ["id", *BASE_COLUMNS]
add("campaign_base", CAMPAIGN, sql="SELECT * REPLACE (" + DAY + ") FROM campaign")
add("csv_roundtrip", CAMPAIGN, sql="SELECT * REPLACE (" + DAY + ") FROM campaign")
add("split_table_roundtrip", CAMPAIGN, *split("campaign"), sql="SELECT id, segment, income, response FROM split WHERE split = 'eval'")
add("feature_table_roundtrip", *FEATURES, sql="SELECT id, " + ", ".join(r6(c, c) for c in NUMERIC) + ", response FROM features")
add("feature_allowlist", CAMPAIGN, sql="SELECT * EXCLUDE (id) REPLACE (" + DAY + ") FROM campaign")
add("serving_projection", CAMPAIGN, sql=f"SELECT id, {', '.join(CATEGORICAL + NUMERIC)}, {DAY} FROM campaign")
add("split_label", CAMPAIGN, sql="SELECT * REPLACE (" + DAY + ") FROM campaign")
add("column_routing", CAMPAIGN, sql="SELECT id, " + ", ".join(f"{dbl(c)} AS {c}" for c in NUMERIC) + ", segment, nation, complain FROM campaign")
add("dropna_any", CAMPAIGN, COMPLETE, sql="SELECT * REPLACE (" + DAY + ") FROM complete")
add("min_value_filter", CAMPAIGN, sql="SELECT * REPLACE (" + DAY + ") FROM campaign WHERE n_orders > 2")
add("threshold_classify", *SCORED, sql="SELECT id, score, pred FROM pred")
add("fit_union", CAMPAIGN, *split("campaign"), sql="""
SELECT split, count(*) AS n, CAST(sum(n_orders) AS BIGINT) AS orders FROM (
  SELECT * FROM split WHERE split = 'train' UNION ALL SELECT * FROM split WHERE split = 'eval') GROUP BY split""")

add("date_render", CAMPAIGN, sql="SELECT id, strftime(last_order, '%Y-%m-%d') AS value FROM campaign")
add("lenient_timestamp", sql="""
SELECT event_id, strftime(try_cast(CASE WHEN event_id % 3 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') ELSE props END AS TIMESTAMP), '%Y-%m-%d') AS value
FROM events""")
add("days_since", CAMPAIGN, sql="""
SELECT id, CAST(DATE '2001-07-01' - last_order AS DOUBLE) AS days FROM campaign
UNION ALL
SELECT -1 - event_id, CAST(floor((epoch_us(TIMESTAMP '2024-02-01 06:00:00') - epoch_us(ts)) / 86400000000.0) AS DOUBLE) FROM events""")
add("winsorize_expr", CAMPAIGN, sql="SELECT id, CASE WHEN income < 1000 THEN 1000.0::DOUBLE WHEN income > 8000 THEN 8000.0::DOUBLE ELSE income END AS income FROM campaign")

add("stratified_holdout", CAMPAIGN, "counts AS (SELECT response AS cls, count(*) AS n FROM campaign GROUP BY response)",
    sizes("counts", "0.1::DOUBLE", "first"), hashed("campaign"),
    sql="SELECT id, response, pos <= take AS is_holdout FROM hashed JOIN first ON cls = response")
add("three_way_split", CAMPAIGN, COMPLETE, *split("complete"), sql="SELECT id, response, split FROM split")
add("serving_emulation", CAMPAIGN, *split("campaign"), sql="SELECT * EXCLUDE (response, split) REPLACE (" + DAY + ") FROM split WHERE split = 'serving'")
def folds(rows: str, key: str = "doc_id", label: str = "toxic") -> tuple[str, ...]:
    return (f"""
numbered AS (SELECT {key}, {label}, min({key}) OVER (PARTITION BY {label}) AS head FROM {rows}),
laid AS (SELECT *, row_number() OVER (ORDER BY head, {key}) - 1 AS place, row_number() OVER (PARTITION BY {label} ORDER BY {key}) - 1 AS pos FROM numbered),
dealt AS (SELECT {label}, place % 10 AS fold, count(*) AS n FROM laid GROUP BY ALL),
ends AS (SELECT {label}, fold, sum(n) OVER (PARTITION BY {label} ORDER BY fold) AS upto, sum(n) OVER (PARTITION BY {label} ORDER BY fold) - n AS start FROM dealt)""",)


FOLDED = "SELECT l.doc_id, l.toxic, CAST(e.fold AS INT) AS fold FROM laid l JOIN ends e ON e.toxic = l.toxic AND l.pos >= e.start AND l.pos < e.upto"
add("stratified_kfold", DOCS, *folds("docs"), sql=FOLDED)
add("stratified_kfold_text", DOCS, "named AS (SELECT concat('doc-', doc_id) AS doc_id, toxic FROM docs)", *folds("named"), sql=FOLDED)
add("label_encode_large", sql="SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY CAST(o_orderkey AS VARCHAR)) - 1 AS DOUBLE) AS code FROM orders")
add("class_weights_many", sql="""SELECT o_orderkey, cls, round(count(*) OVER () / ((SELECT count(DISTINCT o_custkey % 5000) FROM orders) * count(*) OVER (PARTITION BY cls))::DOUBLE, 6) AS weight
FROM (SELECT o_orderkey, o_custkey % 5000 AS cls FROM orders)""")

CLAMP_COLS = [*NUMERIC, "complain"]
add("iqr_winsorize", CAMPAIGN, bounds("campaign", CLAMP_COLS), sql="SELECT id, " + ", ".join(r6(clamped(c), c) for c in CLAMP_COLS) + " FROM campaign, bounds")
add("iqr_winsorize_fitted", CAMPAIGN, "buyers AS (SELECT * FROM campaign WHERE response = 1)", bounds("buyers", NUMERIC),
    sql="SELECT id, " + ", ".join(r6(clamped(c), c) for c in NUMERIC) + ", response FROM campaign, bounds")
add("median_impute", CAMPAIGN, medians("campaign", NUMERIC),
    sql="SELECT id, " + ", ".join(r6(f"COALESCE({dbl(c)}, md_{c})", c) for c in NUMERIC) + " FROM campaign, medians")
add("mode_impute", CAMPAIGN, sql="SELECT id, " + ", ".join(f"COALESCE({c}, {mode_of('campaign', c)}) AS {c}" for c in CATEGORICAL) + " FROM campaign")
CAT_ROWS = "cats AS (SELECT id, segment, nation, complain FROM campaign WHERE segment IS NOT NULL)"
add("label_encode", CAMPAIGN, CAT_ROWS, *[coded("cats", c) for c in CATEGORICAL],
    sql="SELECT id, " + ", ".join(f"CAST(code_{c}.code AS DOUBLE) AS {c}" for c in CATEGORICAL) + " FROM cats "
    + " ".join(f"JOIN code_{c} ON code_{c}.v = cats.{c}" for c in CATEGORICAL))
add("label_encode_join", CAMPAIGN, coded("campaign", "n_orders"),
    sql="SELECT id, CAST(code AS DOUBLE) AS n_orders FROM campaign JOIN code_n_orders ON v = n_orders")
add("label_unseen", CAMPAIGN, "known AS (SELECT * FROM campaign WHERE n_orders > 16)", sql=" UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM campaign WHERE {c} NOT IN (SELECT {c} FROM known) GROUP BY {c}"
    for c in ("nation", "n_orders")))

PREPARED = (
    CAMPAIGN,
    COMPLETE,
    *split("complete"),
    "kept AS (SELECT * FROM split WHERE split = 'serving' OR n_orders > 2)",
    "fitrows AS (SELECT * FROM kept WHERE split <> 'serving')",
    bounds("kept", NUMERIC, group="split"),
    medians("fitrows", NUMERIC),
    *[coded("fitrows", c) for c in CATEGORICAL],
    "prepared AS (SELECT id, "
    + ", ".join(f"COALESCE({clamped(c)}, md_{c}) AS {c}" for c in NUMERIC)
    + ", "
    + ", ".join(f"CAST(code_{c}.code AS DOUBLE) AS {c}" for c in CATEGORICAL)
    + ", response, split FROM kept JOIN bounds ON grp = split CROSS JOIN medians "
    + " ".join(f"LEFT JOIN code_{c} ON code_{c}.v = COALESCE(kept.{c}, {mode_of('fitrows', c)})" for c in CATEGORICAL)
    + ")",
)
add("fit_apply_pipeline", *PREPARED, sql="SELECT id, " + ", ".join(r6(c, c) for c in NUMERIC) + ", segment, nation, complain, response, split FROM prepared")
add("standardize", CAMPAIGN, "m AS (SELECT " + ", ".join(f"avg({c}) AS a_{c}, stddev_pop({c}) AS s_{c}" for c in NUMERIC) + " FROM campaign)",
    sql="SELECT id, " + ", ".join(r6(f"({c} - a_{c}) / s_{c}", c) for c in NUMERIC) + " FROM campaign, m")


def anova(source: str, c: str, label: str, task: str) -> str:
    return f"""SELECT '{c}' AS feature, CASE WHEN sum(ss) = 0 THEN CASE WHEN sum(n * (m - g) * (m - g)) > 0 THEN 'inf'::DOUBLE END
  ELSE round((sum(n * (m - g) * (m - g)) / (count(*) - 1)) / (sum(ss) / (sum(n) - count(*))), 6) END AS f, '{task}' AS task FROM (
  SELECT count({c}) AS n, avg({c}) AS m, var_pop({c}) * count({c}) AS ss, (SELECT avg({c}) FROM {source}) AS g FROM {source} GROUP BY {label})"""


SEPARATED = "separated AS (SELECT response, response * 3 AS separator, 7 AS constant FROM campaign)"
add("anova_f", CAMPAIGN, DOCS, SEPARATED, sql=" UNION ALL ".join(
    [anova("campaign", c, "response", "response") for c in NUMERIC] + [anova("separated", c, "response", "response") for c in ("separator", "constant")] + [anova("docs", c, "toxic", "toxic") for c in ("n_chars", "n_words")]))
add("select_k_best", *FEATURES, "rated AS (" + " UNION ALL ".join(anova("features", c, "response", "x") for c in NUMERIC) + ")",
    "wide AS (SELECT *, response * 3.0::DOUBLE AS separator FROM features)",
    "best AS (SELECT feature FROM (SELECT feature, f FROM rated UNION ALL SELECT 'separator', 'inf'::DOUBLE) ORDER BY f DESC LIMIT 4)",
    sql="SELECT id, response, feature, round(value, 6) AS value FROM (UNPIVOT wide ON " + ", ".join([*NUMERIC, "separator"]) + " INTO NAME feature VALUE value) WHERE feature IN (SELECT feature FROM best)")

TYPES = {"segment": "BYTES", "nation": "BYTES", "income": "FLOAT", "last_order": "BYTES", "spend_a": "FLOAT", "spend_n": "FLOAT", "spend_r": "FLOAT"}
kind = lambda c: TYPES.get(c, "INT")
add("stats_common", CAMPAIGN, sql=" UNION ALL ".join(
    f"SELECT '{c}' AS feature, '{kind(c)}' AS type, count(*) AS num_examples, {len(BASE_COLUMNS)}::BIGINT AS num_features, count({c}) AS num_non_missing, "
    f"count(*) - count({c}) AS num_missing, CAST(min(CASE WHEN {c} IS NOT NULL THEN 1 END) AS BIGINT) AS min_num_values, "
    f"CAST(max(CASE WHEN {c} IS NOT NULL THEN 1 END) AS BIGINT) AS max_num_values, 1.0::DOUBLE AS avg_num_values, count({c}) AS tot_num_values FROM campaign"
    for c in BASE_COLUMNS))


def moments(source: str, c: str) -> str:
    return (
        f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std_dev, count(CASE WHEN {c} = 0 THEN 1 END) AS num_zeros, "
        f"round({dbl(f'min({c})')}, 6) AS min, round({dbl(f'max({c})')}, 6) AS max, round(quantile_cont({dbl(c)}, 0.5), 6) AS median FROM {source}"
    )


add("stats_numeric", CAMPAIGN, sql=" UNION ALL ".join([moments("campaign", c) for c in [*NUMERIC, "complain", "response"]] + [moments("events", "value")]))


def words(source: str, c: str) -> str:
    top = f"(SELECT {{}} FROM {source} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"
    return (
        f"SELECT '{c}' AS feature, count(DISTINCT {c}) AS num_unique, round(avg(length({c})), 6) AS avg_length, "
        f"{top.format(c)} AS top_value, {top.format('count(*)')} AS top_count FROM {source}"
    )


add("stats_string", CAMPAIGN, DATED, sql=" UNION ALL ".join([words("dated", c) for c in ("segment", "nation", "last_order")] + [words("events", c) for c in ("event_type", "props")]))
NUM_BY = "round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std_dev, round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS median, NULL::DOUBLE AS num_unique, NULL::VARCHAR AS top_value"
add("stats_by_split", CAMPAIGN, *split("campaign"),
    "tops AS (SELECT split, segment, count(*) AS n FROM split WHERE segment IS NOT NULL GROUP BY ALL)", sql=" UNION ALL ".join(
    [f"SELECT split, '{c}' AS feature, '{kind(c)}' AS type, count(*) AS num_examples, count(*) - count({c}) AS num_missing, {NUM_BY.format(c=c)} FROM split GROUP BY split"
     for c in ("income", "n_orders")]
    + ["""SELECT s.split, 'segment', 'BYTES', count(*), count(*) - count(segment), NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, count(DISTINCT segment)::DOUBLE,
       (SELECT t.segment FROM tops t WHERE t.split = s.split ORDER BY n DESC, t.segment LIMIT 1) FROM split s GROUP BY s.split"""]))
add("stats_typed", CAMPAIGN, sql=" UNION ALL ".join(
    f"SELECT '{c}' AS feature, '{kind(c)}' AS type, count({c}) AS num_non_missing, count(*) - count({c}) AS num_missing FROM campaign" for c in [*NUMERIC, "segment"]))


def equal_width(source: str, c: str) -> str:
    return f"""SELECT '{c}' AS feature, CAST(b AS INT) AS bucket, round(lo + b * w, 6) AS low, round(lo + (b + 1) * w, 6) AS high,
  (SELECT count(*) FROM {source} s WHERE s.{c} IS NOT NULL AND CASE WHEN w > 0 THEN least(9, floor(({dbl('s.' + c)} - lo) / w)) ELSE 0 END = b) AS n
  FROM (SELECT {dbl(f'min({c})')} AS lo, ({dbl(f'max({c})')} - {dbl(f'min({c})')}) / 10 AS w FROM {source}), range(10) AS r(b)"""


def equal_share(source: str, c: str) -> str:
    return f"""SELECT '{c}' AS feature, CAST(b AS INT) AS bucket, round(q[b + 1], 6) AS low, round(q[b + 2], 6) AS high,
  (SELECT count(*) FROM {source} s WHERE {dbl('s.' + c)} >= q[b + 1] AND ({dbl('s.' + c)} < q[b + 2] OR b = 9)) AS n
  FROM (SELECT quantile_cont({dbl(c)}, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]) AS q FROM {source}), range(10) AS r(b)"""


add("hist_equal_width", CAMPAIGN, sql=" UNION ALL ".join([equal_width("campaign", c) for c in [*NUMERIC, "complain"]] + [equal_width("events", "value")]))
add("hist_quantiles", CAMPAIGN, sql=" UNION ALL ".join([equal_share("campaign", c) for c in NUMERIC] + [equal_share("events", "value")]))


def top(source: str, c: str, k: int) -> str:
    return f"""SELECT * FROM (SELECT '{c}' AS feature, CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) AS INT) AS rank, CAST({c} AS VARCHAR) AS value, count(*) AS n
  FROM {source} WHERE {c} IS NOT NULL GROUP BY {c}) WHERE rank <= {k}"""


add("top_values", CAMPAIGN, sql=" UNION ALL ".join([top("campaign", c, 5) for c in CATEGORICAL] + [top("events", c, 5) for c in ("event_type", "props")]))


def side(c: str, s: str) -> str:
    return (
        f"SELECT '{c}' AS feature, round(avg({c}), 6) AS {s}_mean, round(quantile_cont({dbl(c)}, 0.5), 6) AS {s}_median, "
        f"count(CASE WHEN {c} = 0 THEN 1 END)::DOUBLE AS {s}_num_zeros FROM split WHERE split = '{s}'"
    )


COMPARED = ["income", "n_orders", "spend_a", "complain", "response"]
add("stats_compare", CAMPAIGN, *split("campaign"), sql="SELECT * FROM (" + " UNION ALL ".join(side(c, "eval") for c in COMPARED[:-1])
    + ") FULL OUTER JOIN (" + " UNION ALL ".join(side(c, "train") for c in COMPARED) + ") USING (feature)")


def constraint(source: str, c: str) -> str:
    t = kind(c)
    domain = (
        f"(SELECT CASE WHEN count(*) <= 100 THEN string_agg(v, '|' ORDER BY v) END FROM (SELECT DISTINCT {c} AS v FROM {source} WHERE {c} IS NOT NULL))"
        if t == "BYTES" and c != "plain_date" else "NULL::VARCHAR"
    )
    is_bool = f"min({c}) >= 0 AND max({c}) <= 1" if t == "INT" else "FALSE"
    return (
        f"SELECT '{c}' AS feature, '{t}' AS type, CASE WHEN count({c}) = count(*) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS min_fraction, 1::BIGINT AS min_count, "
        f"1::INT AS shape_dim, {domain} AS domain, {is_bool} AS is_bool FROM {source}"
    )


add("infer_schema", CAMPAIGN, DATED, sql=" UNION ALL ".join(constraint("dated", c) for c in BASE_COLUMNS))
# last_order is a date here and gets no string domain
RULES = (
    CAMPAIGN,
    COMPLETE,
    "rules AS (SELECT feature, type, min_fraction, shape_dim, CASE WHEN feature <> 'last_order' THEN domain END AS domain, is_bool, "
    "CASE WHEN feature = 'response' THEN 'SERVING' ELSE '' END AS not_in FROM ("
    + " UNION ALL ".join(constraint("complete", c).replace("string_agg(v, '|' ORDER BY v)", "string_agg(CAST(v AS VARCHAR), '|' ORDER BY v)") for c in BASE_COLUMNS)
    + "))",
)
add("schema_environments", *RULES, sql="SELECT feature, environment FROM rules, (VALUES ('TRAINING'), ('SERVING')) e(environment) WHERE NOT_IN <> environment".replace("NOT_IN", "not_in"))
add("schema_roundtrip", *RULES, sql="SELECT feature, type, domain, not_in FROM rules")
FAULTY = """
faulty AS (SELECT id, CASE WHEN n_orders > 14 THEN 'SPACE' WHEN n_orders < 5 THEN 'AIR' ELSE segment END AS segment, nation, income, CAST(n_orders AS VARCHAR) AS n_orders,
  n_high % 3 + 1 AS n_urgent, n_high, n_low, spend_a, spend_n, last_order, CASE WHEN n_low > 3 THEN 2 ELSE complain END AS complain, 0.5 AS old_score FROM campaign)"""
OUT = "anomaly_type, 'ERROR' AS severity"
SEEN_TYPES = {**TYPES, "n_orders": "BYTES", "old_score": "FLOAT"}
FAULT_COLS = ["segment", "nation", "income", "n_orders", "n_urgent", "n_high", "n_low", "spend_a", "spend_n", "last_order", "complain", "old_score"]
SEEN = "seen AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, '{SEEN_TYPES.get(c, 'INT')}' AS seen, count(*) AS examples, count({c}) AS present, "
    + ("min(n_urgent) AS lo, max(n_urgent) AS hi" if c == "n_urgent" else "1 AS lo, 1 AS hi")
    + " FROM faulty"
    for c in FAULT_COLS) + ")"
CHECKS = {
    "anomaly_type": f"SELECT feature, 'type' AS {OUT}, 'unexpected type' AS detail, seen AS observed, type AS expected FROM seen JOIN rules USING (feature) WHERE seen <> type",
    "anomaly_missing_column": f"SELECT feature, 'missing_column' AS {OUT}, 'column is missing' AS detail, 'absent' AS observed, 'present' AS expected FROM rules "
    "WHERE not_in <> 'SERVING' AND feature NOT IN (SELECT feature FROM seen)",
    "anomaly_new_column": f"SELECT feature, 'new_column' AS {OUT}, 'column is not in the schema' AS detail, 'present' AS observed, 'absent' AS expected FROM seen "
    "WHERE feature NOT IN (SELECT feature FROM rules)",
    "anomaly_presence": f"SELECT feature, 'presence' AS {OUT}, CASE WHEN present < examples * min_fraction THEN 'too few examples have a value' ELSE 'too few values' END AS detail, "
    "CAST(present AS VARCHAR) AS observed, CAST(min_fraction AS VARCHAR) AS expected FROM seen JOIN rules USING (feature) WHERE present < examples * min_fraction OR present < 1",
    "anomaly_domain": f"""SELECT 'segment' AS feature, 'domain' AS {OUT}, 'values outside the domain: ' || string_agg(segment, ', ' ORDER BY segment) AS detail,
  count(*) || ' values in ' || sum(n) || ' rows' AS observed, 'domain' AS expected FROM (SELECT segment, count(*) AS n FROM faulty WHERE segment IS NOT NULL
  AND segment NOT IN (SELECT unnest(string_split(domain, '|')) FROM rules WHERE feature = 'segment') GROUP BY segment) HAVING count(*) > 0""",
    "anomaly_bool": f"SELECT 'complain' AS feature, 'bool' AS {OUT}, 'values other than 0 and 1' AS detail, min(complain) || ' to ' || max(complain) AS observed, '0 to 1' AS expected "
    "FROM faulty HAVING min(complain) < 0 OR max(complain) > 1",
    "anomaly_shape": f"SELECT feature, 'shape' AS {OUT}, 'wrong number of values per cell' AS detail, lo || ' to ' || hi AS observed, CAST(shape_dim AS VARCHAR) AS expected "
    "FROM seen JOIN rules USING (feature) WHERE hi > shape_dim OR lo < shape_dim",
}
for _name, _sql in CHECKS.items():
    add(_name, *RULES, FAULTY, SEEN, sql=_sql)
EVERY = " UNION ALL ".join(f"SELECT * FROM ({s})" for s in CHECKS.values())
add("anomaly_report", *RULES, FAULTY, SEEN, sql=f"SELECT feature, anomaly_type, severity, detail FROM ({EVERY})")
add("validation_gate", *RULES, FAULTY, SEEN, sql=f"""
SELECT 'clean' AS data, 0::BIGINT AS anomalies, FALSE AS warns
UNION ALL SELECT 'faulty', count(*), count(*) > 0 FROM ({EVERY}) WHERE feature <> 'old_score'""")
add("heavy_values", sql=" UNION ALL ".join([top("lineitem", c, 5) for c in ("l_partkey", "l_orderkey", "l_returnflag")] + [top("events", c, 5) for c in ("event_type", "props", "user_id")]))

SPANS = """
previous AS (SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-16 00:00:00'),
now AS (SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-16 00:00:00' AND event_type <> 'error')"""


def linf(c: str) -> str:
    return f"""SELECT '{c}' AS feature, round(max(abs(coalesce(p, 0) - coalesce(q, 0))), 6) AS distance FROM
  (SELECT {c} AS v, count(*) / sum(count(*)) OVER () AS p FROM previous GROUP BY {c}) FULL OUTER JOIN
  (SELECT {c} AS v, count(*) / sum(count(*)) OVER () AS q FROM now GROUP BY {c}) USING (v)"""


def jsd(c: str, factor: str = "") -> str:
    return f"""SELECT '{c}' AS feature, round(sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2, 6) AS distance
  FROM (SELECT b, sum(a) / sum(sum(a)) OVER () AS p, sum(z) / sum(sum(z)) OVER () AS q FROM (
    SELECT a, z, least(9, floor((v - min(v) OVER ()) / ((max(v) OVER () - min(v) OVER ()) / 10))) AS b FROM (
      SELECT {dbl(c)} AS v, 1 AS a, 0 AS z FROM previous UNION ALL SELECT {dbl(c)}{factor}, 0, 1 FROM now)) GROUP BY b)"""


add("skew_linf", SPANS, sql=" UNION ALL ".join(linf(c) for c in ("event_type", "props")))
add("drift_jsd", SPANS, sql=jsd("value", " * 2") + " UNION ALL " + jsd("user_id"))
add("skew_drift_report", SPANS, sql=f"""
WITH gaps AS ({linf('event_type')} UNION ALL {jsd('value', ' * 2')} UNION ALL {jsd('user_id')})
SELECT feature, 'drift' AS anomaly_type, '0.01' AS expected FROM gaps WHERE distance > 0.01
UNION ALL SELECT feature, 'skew', '0.1' FROM gaps WHERE distance > 0.1""".replace("WITH gaps", "SELECT * FROM (WITH gaps") + ")")

KEPT_EVENTS = "kept AS (SELECT * FROM events WHERE NOT (ts::DATE = DATE '2024-01-09' AND event_type = 'error'))"


def week_numbers(c: str) -> str:
    return f"""SELECT strftime(date_trunc('week', ts), '%Y-%m-%d') AS week, '{c}' AS feature, count({c}) AS n, count(*) - count({c}) AS missing,
  count(CASE WHEN {c} = 0 THEN 1 END) AS zeros, round(avg({dbl(c)}), 6) AS mean, round(stddev_pop({dbl(c)}), 6) AS std_dev,
  round(min({dbl(c)}), 6) AS min, round(max({dbl(c)}), 6) AS max FROM kept GROUP BY 1"""


add("span_statistics", KEPT_EVENTS, sql=f"""{week_numbers('value')} UNION ALL {week_numbers('user_id')}
UNION ALL SELECT strftime(date_trunc('week', ts), '%Y-%m-%d'), 'event_type', count(event_type), count(*) - count(event_type), 0, NULL, NULL, NULL, NULL FROM kept GROUP BY 1""")


def day_drift(feature: str, value: str, distance: str) -> str:
    return f"""SELECT strftime(day, '%Y-%m-%d') AS day, '{feature}' AS feature, round({distance}, 6) AS distance FROM (
  SELECT day, v, coalesce(sum(a) / nullif(sum(sum(a)) OVER (PARTITION BY day), 0), 0) AS p, coalesce(sum(z) / nullif(sum(sum(z)) OVER (PARTITION BY day), 0), 0) AS q FROM (
    SELECT t.day, {value} AS v, 1 AS a, 0 AS z FROM (SELECT DISTINCT ts::DATE AS day FROM events) t JOIN events ON ts::DATE BETWEEN t.day - 7 AND t.day - 1
    UNION ALL SELECT ts::DATE, {value}, 0, 1 FROM events) WHERE v IS NOT NULL GROUP BY day, v)
  GROUP BY day HAVING sum(p) > 0 AND sum(q) > 0"""


DIVERGENCE = "sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2"
add("span_drift", sql=" UNION ALL ".join([
    day_drift("value", "CASE WHEN value < 0 THEN 0 WHEN value < 10 THEN 1 WHEN value < 25 THEN 2 WHEN value < 50 THEN 3 WHEN value < 100 THEN 4 WHEN value < 200 THEN 5 WHEN value IS NOT NULL THEN 6 END", DIVERGENCE),
    *[day_drift(c, c, "max(abs(p - q))") for c in ("event_type", "props")]]))


def knn(rows: str, cols: list[str], k: int, key: str = "id") -> str:
    dist = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in cols)
    return f"""
near AS (SELECT * FROM (SELECT a.{key} AS id, b.{key} AS neighbor, CAST({dist} AS DOUBLE) AS distance2,
  CAST(row_number() OVER (PARTITION BY a.{key} ORDER BY {dist}, b.{key}) AS INT) AS rank FROM {rows} a JOIN {rows} b ON a.{key} <> b.{key}) WHERE rank <= {k})"""


MINORITY = "rare AS (SELECT * FROM features WHERE response = 1)"
add("knn_minority", *FEATURES, MINORITY, knn("rare", NUMERIC, 5), sql="SELECT id, neighbor, rank, round(sqrt(distance2), 6) AS distance FROM near")
add("knn_documents", DOCS, "rare AS (SELECT doc_id, n_chars::DOUBLE AS n_chars, n_words::DOUBLE AS n_words FROM docs WHERE toxic = 1)", knn("rare", ["n_chars", "n_words"], 3, "doc_id"),
    sql="SELECT id, neighbor, rank, distance2 FROM near")
draw = lambda part: f"('0x' || substr(md5('250-' || j || '-{part}'), 1, 15))::BIGINT"
SYNTH = (
    *FEATURES,
    MINORITY,
    knn("rare", NUMERIC, 5),
    f"""
missing AS (SELECT count(*) FILTER (WHERE response = 0) - count(*) FILTER (WHERE response = 1) AS n FROM features),
placed AS (SELECT *, row_number() OVER (ORDER BY md5(concat(id, '-250')), id) - 1 AS pos FROM rare),
degree AS (SELECT id, count(*) AS k FROM near GROUP BY id),
drawn AS (SELECT j, {draw('base')} % (SELECT count(*) FROM rare) AS pos, {draw('neighbor')} AS pick, {draw('gap')} / 1152921504606846976.0::DOUBLE AS gap
  FROM missing, range(n) AS r(j)),
synth AS (SELECT j, b.id AS base, e.id AS neighbor, gap, """
    + ", ".join(f"b.{c} + gap * (e.{c} - b.{c}) AS {c}" for c in NUMERIC)
    + """, 1 AS response FROM drawn d JOIN placed b ON b.pos = d.pos JOIN degree g ON g.id = b.id
  JOIN near n ON n.id = b.id AND n.rank = d.pick % g.k + 1 JOIN rare e ON e.id = n.neighbor)""",
)
add("smote_rows", *SYNTH, sql="SELECT j, base, neighbor, round(gap, 4) AS gap, " + ", ".join(f"round({c}, 4) AS {c}" for c in NUMERIC) + ", response FROM synth")
add("smote", *SYNTH, sql="SELECT response, count(*) AS n, " + ", ".join(f"round(avg({c}), 3) AS avg_{c}" for c in NUMERIC)
    + f" FROM (SELECT {', '.join(NUMERIC)}, response FROM features UNION ALL SELECT {', '.join(NUMERIC)}, response FROM synth) GROUP BY response")
add("class_weights", CAMPAIGN, "counts AS (SELECT response, count(*) AS n FROM campaign GROUP BY response)",
    sql="SELECT id, response, round((SELECT sum(n) FROM counts) / ((SELECT count(*) FROM counts) * n)::DOUBLE, 6) AS weight FROM campaign JOIN counts USING (response)")

add("predict_proba", *FEATURES, sql=f"SELECT id, round({logistic(INTERCEPT, WEIGHTS)}, 6) AS score FROM features")
add("soft_vote", *SCORED, sql="SELECT id, round((score + old_score) / 2, 6) AS score FROM scored")
GRID = "grid AS (SELECT a.v AS actual, b.v AS predicted FROM (VALUES (0), (1)) a(v), (VALUES (0), (1)) b(v))"
CELLS = "cells AS (SELECT actual, predicted, count(p.id) AS n FROM grid LEFT JOIN pred p ON p.label = actual AND p.pred = predicted GROUP BY actual, predicted)"
add("confusion_matrix", *SCORED, GRID, CELLS, sql="SELECT actual, predicted, n FROM cells")


def report(source: str, by: str = "") -> tuple[str, ...]:
    """Classification report of (label, pred) rows, per group when ``by`` is given."""
    g, on = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    group_match = f"AND r.{by} = x.{by}" if by else ""
    groups = f"(SELECT DISTINCT {by} FROM {source})" if by else "(SELECT 1 AS one)"
    pick = f"x.{by}, " if by else ""
    return (
        f"""
per_class AS (SELECT {pick}CAST(c AS VARCHAR) AS row, count(CASE WHEN r.label = c AND r.pred = c THEN 1 END) AS tp, count(CASE WHEN r.pred = c THEN 1 END) AS called,
  count(CASE WHEN r.label = c THEN 1 END) AS support FROM {groups} x CROSS JOIN (VALUES (0), (1)) v(c) LEFT JOIN {source} r ON TRUE {group_match} GROUP BY {pick}c),
rates AS (SELECT *, CASE WHEN called > 0 THEN tp::DOUBLE / called ELSE 0 END AS precision, CASE WHEN support > 0 THEN tp::DOUBLE / support ELSE 0 END AS recall FROM per_class),
rated AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM rates),
report AS (SELECT {g}row, precision, recall, f1, support FROM rated
  UNION ALL SELECT {g}'accuracy', sum(tp)::DOUBLE / sum(support), sum(tp)::DOUBLE / sum(support), sum(tp)::DOUBLE / sum(support), sum(support) FROM rated {on}
  UNION ALL SELECT {g}'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM rated {on}
  UNION ALL SELECT {g}'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support) FROM rated {on})""",
    )


MEASURES = "round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support"
add("classification_report", *SCORED, *report("pred"), sql=f"SELECT row, {MEASURES} FROM report")
add("holdout_report", *PREPARED,
    f"judged AS (SELECT split, response AS label, CASE WHEN round({logistic(INTERCEPT, WEIGHTS)}, 6) >= 0.53 THEN 1 ELSE 0 END AS pred FROM prepared)",
    *report("judged", "split"), sql=f"SELECT split, row, {MEASURES} FROM report")
CURVE = """
per_score AS (SELECT score AS threshold, sum(label) AS pos, count(*) - sum(label) AS neg FROM {source} GROUP BY score),
cum AS (SELECT threshold, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM per_score
  WINDOW w AS (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING)),
pr AS (SELECT threshold, tp / (tp + fp) AS precision, tp / p AS recall FROM cum),
roc AS (SELECT threshold, fp / n AS fpr, tp / p AS tpr FROM cum UNION ALL SELECT NULL, 0, 0)"""
HARD = CURVE.replace("score AS threshold", "pred::DOUBLE AS threshold").replace("GROUP BY score", "GROUP BY pred").format(source="pred")
for _w in ("per_score", "cum", "roc"):
    HARD = HARD.replace(_w, f"{_w}_h")
HARD = HARD.replace("\npr AS", "\npr_h AS")
add("precision_recall_curve", *SCORED, CURVE.format(source="scored"),
    sql="SELECT round(threshold, 6) AS threshold, round(precision, 6) AS precision, round(recall, 6) AS recall FROM pr UNION ALL SELECT NULL, 1, 0")
add("best_threshold", *SCORED, CURVE.format(source="scored"), sql="""
SELECT * FROM (SELECT round(threshold, 6) AS threshold, round(CASE WHEN precision + recall = 0 THEN 'nan'::DOUBLE ELSE (2 * recall + precision) / (recall + precision) END, 6) AS objective,
  'reference' AS name FROM pr ORDER BY CASE WHEN precision + recall = 0 THEN 'nan'::DOUBLE ELSE (2 * recall + precision) / (recall + precision) END DESC, threshold LIMIT 1)
UNION ALL SELECT * FROM (SELECT round(threshold, 6), round(CASE WHEN precision + recall = 0 THEN 0 ELSE 2 * recall * precision / (recall + precision) END, 6), 'f1'
  FROM pr ORDER BY CASE WHEN precision + recall = 0 THEN 0 ELSE 2 * recall * precision / (recall + precision) END DESC, threshold LIMIT 1)""")
add("roc_curve", *SCORED, CURVE.format(source="scored"), HARD, sql="""
SELECT round(threshold, 6) AS threshold, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr, 'score' AS ranked_by FROM roc
UNION ALL SELECT round(threshold, 6), round(fpr, 6), round(tpr, 6), 'pred' FROM roc_h""")
area = lambda t: f"(SELECT round(sum((fpr - px) * (tpr + py) / 2), 6) FROM (SELECT fpr, tpr, lag(fpr) OVER w AS px, lag(tpr) OVER w AS py FROM {t} WINDOW w AS (ORDER BY fpr, tpr)))"
pr_area = """SELECT round(sum((recall - pr) * (precision + pp) / 2), 6), 'precision-recall' FROM (
  SELECT precision, recall, lag(recall) OVER w AS pr, lag(precision) OVER w AS pp
  FROM (SELECT threshold, precision, recall FROM pr UNION ALL SELECT 'inf'::DOUBLE, 1, 0) WINDOW w AS (ORDER BY threshold DESC))"""
add("auc_trapezoid", *SCORED, CURVE.format(source="scored"), HARD, sql=f"SELECT {area('roc')} AS auc, 'roc' AS curve UNION ALL SELECT {area('roc_h')}, 'roc of labels' UNION ALL {pr_area}")


def points(pred: str) -> str:
    return (
        f"round(coalesce(count(CASE WHEN label = 1 AND {pred} THEN 1 END)::DOUBLE / nullif(count(CASE WHEN {pred} THEN 1 END), 0), 0), 6) AS precision, "
        f"round(coalesce(count(CASE WHEN label = 1 AND {pred} THEN 1 END)::DOUBLE / nullif(count(CASE WHEN label = 1 THEN 1 END), 0), 0), 6) AS recall, "
        f"round(count(CASE WHEN (label = 1) = ({pred}) THEN 1 END)::DOUBLE / count(*), 6) AS accuracy"
    )


add("point_metrics", *SCORED, sql=f"SELECT {points('score >= 0.53')} FROM scored")

VERSIONS = """
scores AS (SELECT id, score, 'v0.0.2' AS version FROM scored WHERE n_orders > 5 UNION ALL SELECT id, old_score, 'v0.0.1' FROM scored WHERE n_low > 0),
outcomes AS (SELECT id, response AS result FROM campaign WHERE n_urgent > 2)"""
add("attach_scores", *SCORED, VERSIONS, sql="SELECT c.id, segment, score AS success_rate FROM campaign c LEFT JOIN scores s ON s.id = c.id AND version = 'v0.0.2'")
add("champion_challenger", *SCORED, VERSIONS, sql="""
SELECT id, o.score AS old_score, n.score AS new_score, round(n.score - o.score, 6) AS change FROM
  (SELECT * FROM scores WHERE version = 'v0.0.1') o FULL OUTER JOIN (SELECT * FROM scores WHERE version = 'v0.0.2') n USING (id)""")
add("outcome_metrics", *SCORED, VERSIONS, sql=f"""
SELECT version, {points('score >= 0.53')}, count(*) AS calls FROM (SELECT version, score, result AS label FROM scores JOIN outcomes USING (id)) GROUP BY version""")
JUDGED = """
judged AS (SELECT version, CAST(scores.id % 5 AS INT) AS fold, scores.score, scored.label FROM scores JOIN scored USING (id)),
judged_scores AS (SELECT version, fold, score AS threshold, sum(label) AS pos, count(*) - sum(label) AS neg FROM judged GROUP BY 1, 2, 3),
judged_sums AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER g AS p, sum(neg) OVER g AS n FROM judged_scores
  WINDOW w AS (PARTITION BY version, fold ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING), g AS (PARTITION BY version, fold)),
judged_curve AS (SELECT version, fold, threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, p, n, coalesce(tp / nullif(tp + fp, 0), 0) AS precision,
  CASE WHEN p > 0 THEN tp / p ELSE 1 END AS recall, coalesce(fp / nullif(n, 0), 0) AS fpr, coalesce(tp / nullif(p, 0), 0) AS tpr FROM judged_sums),
judged_steps AS (SELECT *, lag(fpr, 1, 0) OVER w AS fpr0, lag(tpr, 1, 0) OVER w AS tpr0, lag(precision, 1, 1) OVER w AS precision0
  FROM judged_curve WINDOW w AS (PARTITION BY version, fold ORDER BY threshold DESC)),
judged_areas AS (SELECT version, fold, sum((fpr - fpr0) * (tpr + tpr0) / 2) AS roc_auc, sum((tpr - tpr0) * (precision + precision0) / 2) AS pr_auc,
  CAST(max(p) AS BIGINT) AS positives, CAST(max(n) AS BIGINT) AS negatives FROM judged_steps GROUP BY 1, 2),
judged_best AS (SELECT version, fold, threshold, f1 AS objective FROM (SELECT *, CASE WHEN precision + recall = 0 THEN 0 ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM judged_curve)
  QUALIFY row_number() OVER (PARTITION BY version, fold ORDER BY f1 DESC, threshold) = 1)"""
add("version_curves", *SCORED, VERSIONS, JUDGED, sql="""
SELECT version, fold, round(threshold, 6) AS threshold, tp, fp, round(precision, 6) AS precision, round(recall, 6) AS recall, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr FROM judged_curve""")
add("version_areas", *SCORED, VERSIONS, JUDGED, sql="""
SELECT version, fold, round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc, positives, negatives, round(threshold, 6) AS threshold, round(objective, 6) AS objective
FROM judged_areas JOIN judged_best USING (version, fold)""")
add("call_list", *SCORED, VERSIONS, sql="""
SELECT id, score FROM scores WHERE version = 'v0.0.2' AND id NOT IN (SELECT id FROM outcomes) ORDER BY score DESC, id LIMIT 100""")
add("score_upsert", *SCORED, VERSIONS, sql="""
SELECT c.id, c.nation, round(o.score / 2, 6) AS old_rate, n.score AS new_rate FROM campaign c
LEFT JOIN scores o ON o.id = c.id AND o.version = 'v0.0.1' LEFT JOIN scores n ON n.id = c.id AND n.version = 'v0.0.2'""")
RUNS = "runs AS (" + " UNION ALL ".join(
    f"SELECT '{n}' AS run_name, '{t}' AS threshold, {points(f'{c} >= {t}')} FROM scored" for n, c, t in (("new", "score", 0.53), ("new-low", "score", 0.3), ("old", "old_score", 0.53))) + ")"
add("log_run", *SCORED, RUNS, sql="""
SELECT run_name, 'threshold' AS first_param, '8' AS n, recall, NULL::VARCHAR AS model_path FROM runs UNION ALL SELECT 'manual', 'n', '18', 0.5, 'models/v0'""")
add("leaderboard", *SCORED, RUNS, sql="SELECT metric, CAST(rank() OVER (PARTITION BY metric ORDER BY value DESC) AS INT) AS rank, run_name, value FROM ("
    + " UNION ALL ".join(f"SELECT 'validation_{m}' AS metric, run_name, {m} AS value FROM runs" for m in ("precision", "recall", "accuracy")) + ")")

add("daily_scores", *SCORED, VERSIONS, sql="""
SELECT id, version, round(score / CASE WHEN id % 2 = 0 THEN 4 ELSE 2 END, 6) AS score, CASE WHEN id % 2 = 0 THEN '2024-03-02' ELSE '2024-03-01' END AS scored_on FROM scores""")
add("outcomes_latest", *SCORED, VERSIONS, "last AS (SELECT id, CASE WHEN id % 3 = 0 THEN 1 - result ELSE result END AS result FROM outcomes)", sql=f"""
SELECT version, {points('score >= 0.53')}, count(*) AS calls FROM (SELECT version, score, result AS label FROM scores JOIN last USING (id)) GROUP BY version""")
# ---- training -----------------------------------------------------------------------------------------------
# ``base (g, id, x, y)``: the real training rows of each group g (a fold or a choice of features), features as a list.
# ``t (g, y, x)`` adds the synthetic rows and the 1 of the intercept. ``models (m, g, c)`` names the fits. The recursive
# ``newton`` takes Newton steps on the penalised mean loss; a step solves its system by elimination over lists.
BALANCED = f"""
sizes AS (SELECT g, count(*) FILTER (WHERE y = 1) AS n1, count(*) FILTER (WHERE y = 0) AS n0 FROM base GROUP BY g),
rare AS (SELECT g, id, x, row_number() OVER (PARTITION BY g ORDER BY md5(concat(id, '-250')), id) - 1 AS pos FROM base WHERE y = 1),
pairs AS (SELECT a.g, a.id, b.id AS neighbor, b.x AS other, list_reduce(list_transform(a.x, lambda v, i: (v - b.x[i]) * (v - b.x[i])), lambda u, v: u + v) AS d
  FROM rare a JOIN rare b ON a.g = b.g AND a.id <> b.id),
near AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY g, id ORDER BY d, neighbor) AS rank FROM pairs) WHERE rank <= 5),
degree AS (SELECT g, id, count(*) AS k FROM near GROUP BY g, id),
drawn AS (SELECT g, j, {draw('base')} % n1 AS pos, {draw('neighbor')} AS pick, {draw('gap')} / 1152921504606846976.0::DOUBLE AS gap FROM sizes, range(n0 - n1) AS r(j)),
synth AS (SELECT d.g, d.j, list_transform(b.x, lambda v, i: v + gap * (n.other[i] - v)) AS x FROM drawn d JOIN rare b ON b.g = d.g AND b.pos = d.pos
  JOIN degree k ON k.g = d.g AND k.id = b.id JOIN near n ON n.g = d.g AND n.id = b.id AND n.rank = pick % k.k + 1),
t AS (SELECT g, y, list_append(x, 1.0::DOUBLE) AS x FROM base UNION ALL SELECT g, 1, list_append(x, 1.0::DOUBLE) FROM synth),
many AS (SELECT g, count(*)::DOUBLE AS n, max(len(x)) AS k FROM t GROUP BY g)"""
NEWTON = """
newton AS (
  SELECT 0 AS step, m, g, c, n, k, list_transform(range(k), lambda i: 0.0::DOUBLE) AS beta, 1.0::DOUBLE AS moved FROM models JOIN many USING (g)
  UNION ALL
  SELECT step, m, g, c, n, k, list_transform(beta, lambda b, j: b - done[j][k + 1]), list_max(list_transform(done, lambda line: abs(line[k + 1]))) FROM (
    SELECT step, m, g, c, n, k, beta, list_reduce(list_concat([list(line ORDER BY i)], list_transform(range(1, k + 1), lambda e: [[e::DOUBLE]])),
      lambda acc, e: list_transform(acc, lambda line, i: CASE WHEN i = e[1][1] THEN list_transform(line, lambda v: v / acc[i][i])
        ELSE list_transform(line, lambda v, j: v - line[e[1][1]::BIGINT] / acc[e[1][1]::BIGINT][e[1][1]::BIGINT] * acc[e[1][1]::BIGINT][j]) END)) AS done
    FROM (SELECT step, m, g, c, n, k, beta, i, list(v ORDER BY j) AS line FROM (
      SELECT any_value(step) + 1 AS step, m, any_value(g) AS g, any_value(c) AS c, any_value(n) AS n, any_value(k) AS k, any_value(beta) AS beta, i, j,
        CASE WHEN j <= any_value(k) THEN sum(p * (1 - p) * x[i] * x[j]) / any_value(n) + CASE WHEN i = j AND i < any_value(k) THEN 1 / (any_value(c) * any_value(n)) ELSE 0 END
             ELSE sum((p - y) * x[i]) / any_value(n) + CASE WHEN i < any_value(k) THEN any_value(beta)[i] / (any_value(c) * any_value(n)) ELSE 0 END END AS v
      FROM (SELECT step, m, b.g, c, n, k, beta, y, x, 1 / (1 + exp(-list_dot_product(beta, x))) AS p FROM newton b JOIN t ON t.g = b.g WHERE step < 25 AND moved > 1e-11),
        unnest(range(1, k + 1)) AS a(i), unnest(range(1, k + 2)) AS e(j) GROUP BY m, i, j) GROUP BY step, m, g, c, n, k, beta, i)
    GROUP BY step, m, g, c, n, k, beta)),
fitted AS (SELECT m, g, c, arg_max(beta, step) AS beta FROM newton GROUP BY m, g, c)"""
ALL_FEATURES = NUMERIC + CATEGORICAL
LISTED = "[" + ", ".join(dbl(c) for c in ALL_FEATURES) + "]"
TRAINED = tuple(part.replace("WHERE split = 'serving' OR n_orders > 2", "") for part in PREPARED)
TRAIN = (*TRAINED, f"train AS (SELECT id, {LISTED} AS x, response AS y FROM prepared WHERE split = 'train')")
ONE = (*TRAIN, "base AS (SELECT -1 AS g, id, x, y FROM train)", BALANCED, "models AS (SELECT 0 AS m, -1 AS g, 1.0::DOUBLE AS c)", NEWTON)
P = "1 / (1 + exp(-list_dot_product(beta, list_append({x}, 1.0::DOUBLE))))"
recursive = lambda sql: sql.replace("WITH ", "WITH RECURSIVE ", 1)


def trained(name: str, *ctes: str, sql: str) -> None:
    ORACLE[name] = recursive(with_(*ctes)) + sql


trained("logistic_fit", *ONE, f"names AS (SELECT unnest({ALL_FEATURES + ['intercept']!r}) AS feature, unnest(range(1, {len(ALL_FEATURES) + 2})) AS i)", sql="""
SELECT feature, round(beta[i] * coalesce((SELECT sqrt(avg(x[i] * x[i])) FROM train), 1), 6) AS effect FROM fitted, names""")
trained("logistic_scores", *ONE, sql=f"SELECT id, response, round({P.format(x=LISTED)}, 6) AS score FROM prepared, fitted WHERE split = 'eval'")
FOLDED_TRAIN = (
    *TRAIN, *folds("(SELECT id, y FROM train)", "id", "y"),
    "folded AS (SELECT t.*, e.fold FROM train t JOIN laid l ON l.id = t.id JOIN ends e ON e.y = l.y AND l.pos >= e.start AND l.pos < e.upto)",
    "base AS (SELECT g, id, x, y FROM folded, range(10) AS f(g) WHERE fold <> g)", BALANCED,
    "models AS (SELECT row_number() OVER () AS m, g, c FROM range(10) AS f(g), (VALUES (0.1::DOUBLE), (13), (15), (20), (40)) AS v(c))", NEWTON,
    f"runs AS (SELECT c, g, avg(CASE WHEN ({P.format(x='x')} > 0.5) = (y = 1) THEN 1.0::DOUBLE ELSE 0 END) AS accuracy FROM fitted JOIN folded ON fold = g GROUP BY c, g)",
)
LIMITS = "(VALUES (500), (1000)) AS l(max_iter)"
trained("grid_runs", *FOLDED_TRAIN, sql=f"SELECT c, max_iter, CAST(g AS INT) AS fold, round(accuracy, 6) AS accuracy FROM runs, {LIMITS}")
trained("grid_search", *FOLDED_TRAIN, f"means AS (SELECT c, max_iter, avg(accuracy) AS accuracy FROM runs, {LIMITS} GROUP BY c, max_iter)", sql="""
SELECT c, max_iter, round(accuracy, 6) AS accuracy, row_number() OVER (ORDER BY round(accuracy, 9) DESC, c, max_iter) = 1 AS chosen FROM means""")
# Poisson(1) draws and the root cut of each tree: three features by hash order, every value tried
LIMITS_OF_DRAW = [int(sum(math.exp(-1) / math.factorial(i) for i in range(k + 1)) * 2**60) for k in range(12)]
ROOT_DRAW = "('0x' || substr(md5('250-' || tree || '-' || id), 1, 15))::BIGINT"
ORACLE["random_forest_fit"] = with_(
    *TRAIN, "base AS (SELECT -1 AS g, id, x, y FROM train)", BALANCED, f"""
keyed AS (SELECT id, x, y FROM base UNION ALL SELECT -1 - j, x, 1 FROM synth),
sown AS (SELECT *, {' + '.join(f'(({ROOT_DRAW}) >= {limit})::INT' for limit in LIMITS_OF_DRAW)} AS w FROM keyed, range(100) AS r(tree)),
looked AS (SELECT tree, i, row_number() OVER (PARTITION BY tree ORDER BY md5('250-' || tree || '-' || (i - 1))) AS place FROM range(100) AS r(tree), range(1, {len(ALL_FEATURES) + 1}) AS f(i)),
steps AS (SELECT tree, place, i, x[i] AS v, sum(w)::DOUBLE AS w, sum(w * y)::DOUBLE AS k FROM sown JOIN looked USING (tree) WHERE w > 0 AND place <= {math.isqrt(len(ALL_FEATURES))} GROUP BY tree, place, i, v),
runs AS (SELECT tree, place, i, v, lead(v) OVER o AS next, sum(w) OVER o AS n, sum(k) OVER o AS k, sum(w) OVER (PARTITION BY tree, place) AS alln, sum(k) OVER (PARTITION BY tree, place) AS allk
  FROM steps WINDOW o AS (PARTITION BY tree, place ORDER BY v)),
gains AS (SELECT *, (k * k + (n - k) * (n - k)) / n + ((allk - k) * (allk - k) + (alln - n - allk + k) * (alln - n - allk + k)) / (alln - n) AS gain FROM runs WHERE next IS NOT NULL),
best AS (SELECT * FROM gains QUALIFY row_number() OVER (PARTITION BY tree ORDER BY gain DESC, place, v) = 1),
totals AS (SELECT tree, sum(w) AS n, sum(w * y) AS positive FROM sown GROUP BY tree)""") + f"""
SELECT CAST(tree AS INT) AS tree, CAST(t.n AS BIGINT) AS n, CAST(t.n AS BIGINT) AS in_leaves, CAST(t.positive AS BIGINT) AS positive, {ALL_FEATURES!r}[i] AS feature, round((v + next) / 2, 4) AS threshold
FROM best JOIN totals t USING (tree)"""
ORACLE["snapshot_upsert"] = ORACLE["score_upsert"]
add("fold_features", *TRAIN, *folds("(SELECT id, y FROM train)", "id", "y"), f"""
folded AS (SELECT t.*, e.fold FROM train t JOIN laid l ON l.id = t.id JOIN ends e ON e.y = l.y AND l.pos >= e.start AND l.pos < e.upto),
parts AS (SELECT g, i, y, x[i] AS v FROM folded, range(10) AS f(g), unnest(range(1, {len(ALL_FEATURES) + 1})) AS r(i) WHERE fold <> g),
classes AS (SELECT g, i, y, count(*) AS n, avg(v) AS mean, var_pop(v) AS spread FROM parts GROUP BY g, i, y),
grand AS (SELECT g, i, sum(n * mean) / sum(n) AS grand, sum(n * spread) / (sum(n) - 2) AS within FROM classes GROUP BY g, i),
scores AS (SELECT g, i, sum(n * (mean - grand) * (mean - grand)) / any_value(within) AS f FROM classes JOIN grand USING (g, i) GROUP BY g, i)""", sql=f"""
SELECT CAST(g AS INT) AS left_out, {ALL_FEATURES!r}[i] AS feature, round(f, 6) AS f, row_number() OVER (PARTITION BY g ORDER BY f DESC, i DESC) <= 5 AS chosen FROM scores""")
for _name in ("mlp_fit",):
    add(_name, CAMPAIGN, COMPLETE, *split("complete"), sql="SELECT id, response, TRUE AS scored FROM split WHERE split = 'eval'")
add("batch_score", CAMPAIGN, COMPLETE, *split("complete"), sql="SELECT id, nation, id IN (SELECT id FROM split WHERE split = 'serving') AS scored FROM campaign")
trained("feature_ablation", *TRAIN, f"""
parts AS (SELECT i, y, x[i] AS v FROM train, unnest(range(1, {len(ALL_FEATURES) + 1})) AS r(i)),
classes AS (SELECT i, y, count(*) AS n, avg(v) AS mean, var_pop(v) AS spread FROM parts GROUP BY i, y),
spreads AS (SELECT i, sum(n * spread) / (sum(n) - 2) AS within, sum(n * mean * mean) - sum(n * mean) * sum(n * mean) / sum(n) AS between_ FROM classes GROUP BY i),
ranked AS (SELECT i, row_number() OVER (ORDER BY between_ / within DESC, i DESC) AS place FROM spreads),
picked AS (SELECT g, list(i ORDER BY i) AS picks FROM ranked, (VALUES (5), (10), ({len(ALL_FEATURES)})) AS v(g) WHERE place <= g GROUP BY g),
base AS (SELECT g, id, list_transform(picks, lambda i: x[i]) AS x, y FROM train, picked)""", BALANCED, "models AS (SELECT g AS m, g, 1.0::DOUBLE AS c FROM picked)", NEWTON, f"""
scored AS (SELECT g, response AS label, {P.format(x=f"list_transform(picks, lambda i: {LISTED}[i])")} AS score FROM prepared, fitted JOIN picked USING (g) WHERE split = 'eval')""",
    sql=f"SELECT 'select-' || g || '-features' AS run_name, CAST(g AS VARCHAR) AS n, {points('score >= 0.53')} FROM scored GROUP BY g")
ORACLE["saved_pipeline"] = ORACLE["fit_apply_pipeline"]
trained("daily_run", *ONE, sql=f"SELECT id, round({P.format(x=LISTED)}, 6) AS rate FROM prepared, fitted WHERE split = 'serving'")
