"""DuckDB SQL for every query that SQL can express, written independently of the
Spark code: brute force where that is simplest."""

from __future__ import annotations

from scoreloom.functions.columns import CHI_SQUARE_CRITICAL, RATE_NAMES
from scoreloom.operators.score import BEST_METRICS, GAINS_SHARES
from verification.fixtures import (
    CREDIT_FACTORS, CREDIT_NUMERIC, CREDIT_SQL, CREDIT_VARIABLES, LINE_KEYS, LINE_NUMERIC,
    LINES_SQL, MISSING_SQL, SCORED_SQL, STRONG_SQL)

ORACLES: dict[str, str] = {}
SPELLINGS = "'null','Null','NULL','NaN','nan','Na','NA','N/A','None','NONE','\\N','?'"


def r(expr: str, digits: int = 6) -> str:
    return f"round({expr}, {digits}) + 0.0::DOUBLE"


def share(keys, stream: str) -> str:
    text = " || '|' || ".join([f"'{stream}:1'", *[f"{k}::VARCHAR" for k in keys]])
    return f"md5({text})"


def hash_int(keys, stream: str) -> str:
    return f"('0x' || substr({share(keys, stream)}, 1, 8))::BIGINT"


def union(parts) -> str:
    return "\nUNION ALL ".join(parts)


# ---- audits ---------------------------------------------------------------

def _checks(rows, source: str) -> str:
    return union(f"SELECT '{c}' AS \"check\", ({o})::BIGINT AS observed, ({e})::BIGINT AS expected, "
                 f"({p}) AS passed FROM {source}" for c, o, e, p in rows)


def _audit_id(name: str, tab: str) -> str:
    src = f"(SELECT count(*) AS n, count(DISTINCT {name}) AS u, count(*) - count({name}) AS m FROM {tab})"
    return _checks([("id_exists", "1", "1", "true"), ("id_unique", "u", "n", "u = n"),
                    ("id_not_null", "m", "0", "m = 0")], src)


ORACLES["audit_id"] = _audit_id("o_orderkey", "orders")
ORACLES["audit_id_repeated"] = _audit_id("l_orderkey", "lineitem")
ORACLES["audit_label"] = _checks(
    [("label_exists", "1", "1", "true"), ("label_not_null", "m", "0", "m = 0")],
    "(SELECT count(*) - count(quality) AS m FROM documents LEFT JOIN labels USING (doc_id))")
ORACLES["audit_volume"] = _checks(
    [("volume_rows", "n", "50", "n >= 50"), ("volume_columns", "4", "1", "true")],
    "(SELECT count(*) AS n FROM orders)")
ORACLES["audit_dictionary"] = _checks(
    [("dictionary_two_cells", "bad", "0", "bad = 0"), ("dictionary_no_repeats", "rep", "0", "rep = 0"),
     ("dictionary_known_types", "unk", "0", "unk = 0")],
    """(SELECT (SELECT count(*) FROM part WHERE p_name IS NULL OR p_type IS NULL) AS bad,
        (SELECT count(*) FROM (SELECT p_name FROM part GROUP BY p_name HAVING count(*) > 1)) AS rep,
        (SELECT count(*) FROM part WHERE lower(p_type) NOT IN ('standard', 'large', 'small')) AS unk)""")
ORACLES["audit_columns"] = """
WITH t(variable) AS (VALUES ('large'), ('promo'), ('p_brand')),
     dic AS (SELECT DISTINCT lower(p_type) AS variable FROM part)
SELECT variable, 'table_only' AS side FROM t WHERE variable NOT IN (SELECT variable FROM dic)
UNION ALL SELECT variable, 'dictionary_only' FROM dic WHERE variable NOT IN (SELECT variable FROM t)"""

# ---- sources --------------------------------------------------------------

ORACLES["typed_columns"] = """
SELECT c_mktsegment, c_nationkey::VARCHAR AS c_nationkey, c_custkey::DOUBLE AS c_custkey, c_acctbal,
       TRY_CAST(c_name AS DOUBLE) AS c_name FROM customer"""
for _name in ("csv_import_na", "csv_import_no_header", "csv_import_inferred"):
    ORACLES[_name] = f"""WITH {MISSING_SQL}
SELECT o_orderkey::DOUBLE AS o_orderkey, o_totalprice, c_acctbal, o_orderstatus FROM miss"""
ORACLES["dictionary_import"] = """
WITH k AS (SELECT p_name AS variable, min(p_type) AS t FROM part GROUP BY p_name)
SELECT variable, CASE WHEN t IN ('SMALL', 'LARGE') THEN 'factor' ELSE 'numeric' END AS type
FROM k WHERE t <> 'STANDARD'"""
ORACLES["table_export"] = "SELECT c_custkey, c_name, c_acctbal FROM customer"
ORACLES["report_json_and_text"] = """
SELECT o_orderpriority AS label, count(*)::BIGINT AS n,
       'labels' || chr(9) || o_orderpriority || chr(9) || count(*)::VARCHAR AS value
FROM orders GROUP BY o_orderpriority"""

# ---- profiles -------------------------------------------------------------

def _numeric(columns, tab: str) -> str:
    return union(f"""SELECT '{c}' AS variable, {r(f'max({c})', 4)} AS max, {r(f'min({c})', 4)} AS min,
  {r(f'avg({c})', 4)} AS mean, {r(f'stddev_samp({c})', 4)} AS sigma,
  {r(f'quantile_cont({c}, 0.5)', 4)} AS median, (count(*) - count({c}))::BIGINT AS missing_count
FROM {tab}""" for c in columns)


def _levels(columns, tab: str) -> str:
    return union(f"SELECT '{c}' AS variable, {c}::VARCHAR AS level FROM {tab}" for c in columns)


_ALL_LINE = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, "
             "l_tax, l_returnflag, l_linestatus, l_shipdate")
ORACLES["numeric_profile"] = (f"WITH {MISSING_SQL}\n" + _numeric(LINE_NUMERIC, "lineitem")
                              + "\nUNION ALL " + _numeric(CREDIT_NUMERIC, "miss"))
ORACLES["profile_auto_sample"] = f"""WITH ranked AS (
  SELECT *, row_number() OVER (ORDER BY {share(LINE_KEYS, 'sample')}, {_ALL_LINE}) AS rn, count(*) OVER () AS total
  FROM lineitem),
s AS (SELECT * FROM ranked WHERE total <= 10000 OR total <= 20000 OR rn <= 20000)
""" + _numeric(LINE_NUMERIC, "s")
ORACLES["factor_profile"] = f"""WITH {MISSING_SQL},
lv AS ({_levels(CREDIT_FACTORS, 'miss')}),
c AS (SELECT variable, level, count(*) AS n FROM lv GROUP BY variable, level),
m AS (SELECT variable, level, row_number() OVER (PARTITION BY variable ORDER BY n DESC, level) AS rn
      FROM c WHERE level IS NOT NULL)
SELECT c.variable, count(level)::BIGINT AS level_num,
       coalesce(sum(n) FILTER (WHERE level IS NULL), 0)::BIGINT AS missing_count,
       (SELECT m.level FROM m WHERE m.variable = c.variable AND rn = 1) AS most_freq_level,
       string_agg(level, '|' ORDER BY level) AS levels
FROM c GROUP BY c.variable"""
ORACLES["level_counts"] = f"""WITH {MISSING_SQL}, lv AS ({_levels(CREDIT_FACTORS, 'miss')})
SELECT variable, level, count(*)::BIGINT AS n FROM lv GROUP BY variable, level"""
ORACLES["label_counts"] = """SELECT quality::VARCHAR AS label, count(*)::BIGINT AS n
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY quality"""
_N_MISSING = " + ".join(f"({c} IS NULL)::INTEGER" for c in CREDIT_VARIABLES)
ORACLES["row_missing"] = f"WITH {MISSING_SQL} SELECT o_orderkey, {_N_MISSING} AS n_missing FROM miss"
ORACLES["column_missing"] = f"WITH {MISSING_SQL} " + union(
    f"SELECT '{c}' AS variable, (count(*) - count({c}))::BIGINT AS missing_count FROM miss"
    for c in CREDIT_VARIABLES)
ORACLES["column_std"] = f"WITH {MISSING_SQL} " + union(
    f"SELECT '{c}' AS variable, {r(f'stddev_samp({c})', 4)} AS sigma FROM miss" for c in CREDIT_NUMERIC)
ORACLES["level_domain"] = f"""WITH {MISSING_SQL}, lv AS ({_levels(CREDIT_FACTORS, 'miss')})
SELECT DISTINCT variable, level FROM lv WHERE level IS NOT NULL"""

# ---- cleaning -------------------------------------------------------------

ORACLES["drop_sparse_rows"] = f"""WITH {MISSING_SQL}
SELECT {', '.join(CREDIT_VARIABLES)}, o_orderkey FROM miss WHERE {_N_MISSING} <= 1"""
ORACLES["droppable_variables"] = """
WITH n AS (SELECT count(*) AS rows, count(DISTINCT l_orderkey) AS keys,
                  count(CASE WHEN l_linenumber = 1 THEN l_tax END) AS full_tax,
                  count(DISTINCT l_linestatus) AS st FROM lineitem)
SELECT 'same_text' AS variable, 'constant_factor' AS reason
UNION ALL SELECT 'same_number', 'constant_numeric'
UNION ALL SELECT 'null_factor', 'sparse'
UNION ALL SELECT 'mostly_null', 'sparse' FROM n WHERE rows - full_tax >= floor(rows * 0.8::DOUBLE)
UNION ALL SELECT 'l_orderkey', 'too_many_levels' FROM n WHERE keys > floor(rows * 0.01::DOUBLE)
UNION ALL SELECT 'l_linestatus', 'too_many_levels' FROM n WHERE st > floor(rows * 0.01::DOUBLE)"""
ORACLES["drop_named_variables"] = "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer"
ORACLES["fill_missing"] = f"""WITH {MISSING_SQL}
SELECT o_orderkey, y, o_totalprice, coalesce(c_acctbal, -1.0::DOUBLE) AS c_acctbal, c_mktsegment,
       coalesce(o_orderstatus, 'none') AS o_orderstatus, c_nationkey FROM miss"""
ORACLES["learned_fill"] = f"""WITH {MISSING_SQL},
lv AS ({_levels(CREDIT_FACTORS, 'miss')}),
m AS (SELECT variable, level, row_number() OVER (PARTITION BY variable ORDER BY count(*) DESC, level) AS rn
      FROM lv WHERE level IS NOT NULL GROUP BY variable, level)
SELECT variable, NULL::DOUBLE AS fill_number, level AS fill_text FROM m WHERE rn = 1
UNION ALL """ + union(f"SELECT '{c}', {r(f'quantile_cont({c}, 0.5)', 4)}, NULL FROM miss"
                      for c in CREDIT_NUMERIC)
ORACLES["as_categories"] = "SELECT doc_id::VARCHAR AS doc_id, quality::VARCHAR AS quality FROM labels"
ORACLES["keep_columns"] = "SELECT p_brand, p_partkey FROM part"
ORACLES["rows_with_level"] = "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'"

# ---- sampling -------------------------------------------------------------

def _split(limit: str) -> str:
    return f"""SELECT o_orderkey, CASE WHEN {hash_int(['o_orderkey'], 'split')} / 4294967296.0::DOUBLE
  < {limit}::DOUBLE THEN 'first' ELSE 'second' END AS part FROM orders"""


ORACLES["ratio_split"] = _split("0.25")
ORACLES["holdout_split"] = _split("0.7")
ORACLES["stratified_split"] = f"""WITH s AS (
  SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY {share(['o_orderkey'], 'stratified')}) AS rn,
         count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders)
SELECT o_orderkey, CASE WHEN rn <= floor(0.3::DOUBLE * n) THEN 'first' ELSE 'second' END AS part FROM s"""
ORACLES["sample_share"] = f"""SELECT {', '.join(LINE_KEYS)}, l_quantity FROM lineitem
WHERE {hash_int(LINE_KEYS, 'share')} / 4294967296.0::DOUBLE < 0.1::DOUBLE"""
ORACLES["sample_n"] = f"""SELECT {', '.join(LINE_KEYS)}, l_quantity FROM lineitem
ORDER BY {share(LINE_KEYS, 'sample')}, {', '.join(LINE_KEYS)}, l_quantity LIMIT 5000"""
ORACLES["under_sample"] = f"""WITH j AS (
  SELECT doc_id, lang, source, n_chars, quality, toxic FROM documents JOIN labels USING (doc_id)),
c AS (SELECT *, count(*) OVER (PARTITION BY quality) AS n,
             row_number() OVER (PARTITION BY quality ORDER BY {share(['doc_id'], 'under')}) AS rn FROM j),
b AS (SELECT min(n) AS minor, max(n) AS major FROM c)
SELECT doc_id, lang, source, n_chars, quality, toxic FROM c, b
WHERE n = minor OR major * 1.0::DOUBLE / minor <= 2 OR rn <= 2 * minor"""
ORACLES["modulo_folds"] = f"""SELECT o_orderkey, ({hash_int(['o_orderkey'], 'fold')} % 5)::INTEGER AS fold
FROM orders"""

# ---- joins ----------------------------------------------------------------

ORACLES["join_left"] = """SELECT d.doc_id, d.lang, l.quality, l.toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""
ORACLES["join_right"] = """SELECT d.doc_id, l.quality, l.toxic, d.lang
FROM labels l RIGHT JOIN documents d ON d.doc_id = l.doc_id"""
ORACLES["join_inner"] = """SELECT o_orderkey, o_custkey, o_totalprice, c_mktsegment
FROM orders JOIN customer ON o_custkey = c_custkey"""
ORACLES["join_full"] = """
WITH a AS (SELECT l_partkey, l_suppkey, count(*)::BIGINT AS n_large FROM lineitem WHERE l_quantity > 45
           GROUP BY l_partkey, l_suppkey),
     b AS (SELECT l_partkey, l_suppkey, count(*)::BIGINT AS n_cheap FROM lineitem
           WHERE l_discount > 0.09::DOUBLE GROUP BY l_partkey, l_suppkey)
SELECT coalesce(a.l_partkey, b.l_partkey) AS l_partkey, coalesce(a.l_suppkey, b.l_suppkey) AS l_suppkey,
       n_large, n_cheap FROM a FULL JOIN b ON a.l_partkey = b.l_partkey AND a.l_suppkey = b.l_suppkey"""
ORACLES["join_full_tables"] = """
WITH a AS (SELECT l_orderkey, count(*)::BIGINT AS n_items FROM lineitem GROUP BY l_orderkey),
     b AS (SELECT event_id, count(*)::BIGINT AS n_events FROM events GROUP BY event_id)
SELECT coalesce(l_orderkey, event_id) AS l_orderkey, n_items, n_events FROM a FULL JOIN b ON l_orderkey = event_id"""
ORACLES["lookup_join"] = """
WITH o AS (SELECT o_custkey, o_totalprice, o_orderkey, row_number() OVER (
             PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) AS rn FROM orders)
SELECT c_custkey, c_name, o_totalprice, o_orderkey
FROM customer LEFT JOIN o ON c_custkey = o_custkey AND rn = 1"""
ORACLES["union_widen"] = """
SELECT c_custkey AS id, c_nationkey::DOUBLE AS v, NULL::VARCHAR AS name FROM customer
UNION ALL SELECT s_suppkey, s_acctbal, s_name FROM supplier"""

# ---- binning, WOE, IV -----------------------------------------------------

_PROBS = "[" + ", ".join(f"{i / 20!r}::DOUBLE" for i in range(21)) + "]"


def _break_lists(columns, tab: str) -> str:
    return union(f"SELECT '{c}' AS variable, quantile_cont({c}, {_PROBS}) AS q FROM {tab}" for c in columns)


def _breaks(columns, tab: str) -> str:
    return f"""SELECT variable, unnest(range(0, 21)) AS position, unnest(q) AS b
FROM ({_break_lists(columns, tab)})"""


ORACLES["quantile_breaks"] = f"""WITH {MISSING_SQL},
br AS ({_breaks(LINE_NUMERIC, 'lineitem')} UNION ALL {_breaks(CREDIT_NUMERIC, 'miss')})
SELECT variable, position::INTEGER AS position, {r('b', 4)} AS break FROM br"""


def _bin(column: str) -> str:
    """The first break position at or above the value, the lowest included."""
    return (f"(SELECT min(position) FROM br WHERE variable = '{column}' AND position >= 1 AND {column} <= b)")


ORACLES["quantile_bins"] = f"""WITH {MISSING_SQL}, br AS ({_breaks(CREDIT_NUMERIC, 'miss')})
SELECT o_orderkey, """ + ", ".join(
    f"'{c}_' || {_bin(c)}::VARCHAR AS {c}" for c in CREDIT_NUMERIC) + " FROM miss"
ORACLES["label_to_binary"] = """
SELECT l_linestatus, CAST(l_linestatus = (SELECT min(l_linestatus) FROM lineitem) AS INTEGER) AS y,
       count(*)::BIGINT AS n FROM lineitem GROUP BY l_linestatus"""


def _counts(tab: str, numeric, factors) -> str:
    """CTEs br, long, cnt, woe: (variable, bin, position, n, pos, neg, pct_1, pct_0, woe)."""
    br = f"br AS ({_breaks(numeric, tab)})," if numeric else ""
    rows = [f"""SELECT '{c}' AS variable, '{c}_' || p::VARCHAR AS bin, p AS position, y
FROM (SELECT y, {_bin(c)} AS p FROM {tab})""" for c in numeric]
    rows += [f"SELECT '{c}' AS variable, {c}::VARCHAR AS bin, NULL::BIGINT AS position, y FROM {tab}"
             for c in factors]
    return br + f"""
long AS ({union(rows)}),
cnt AS (SELECT variable, bin, position::INTEGER AS position, count(*)::BIGINT AS n,
               sum(y)::BIGINT AS pos, (count(*) - sum(y))::BIGINT AS neg
        FROM long GROUP BY variable, bin, position),
tot AS (SELECT sum(y)::DOUBLE AS tp, (count(*) - sum(y))::DOUBLE AS tn FROM {tab}),
pct AS (SELECT cnt.*, pos / tp AS pct_1, neg / tn AS pct_0 FROM cnt, tot),
woe AS (SELECT *, {_woe('pct_1', 'pct_0')} AS woe FROM pct)"""


def _woe(p1: str, p0: str) -> str:
    e = f"CASE WHEN {p1} = 0 OR {p0} = 0 THEN ({p1} + {p0}) / 200 ELSE 0 END"
    return f"ln(({p1} + {e}) / ({p0} + {e}))"


def _chi(a: str, b: str, c: str, d: str) -> str:
    """The rule by margins: a margin of nothing on both rows, any empty cell, then the corrected statistic."""
    total = f"({a} + {b} + {c} + {d})"
    least = f"least({a}, {b}, {c}, {d})"
    same_side = f"(({a} + {c} = 0 OR {b} + {d} = 0) AND {a} + {b} > 0 AND {c} + {d} > 0)"
    away = f"(abs({a} * {d} - {c} * {b}) - CASE WHEN {least} < 5 THEN {total} / 2.0::DOUBLE ELSE 0 END)"
    margins = f"(({a} + {c}) * ({b} + {d}) * ({a} + {b}) * ({c} + {d}) + 0.1::DOUBLE)"
    return f"""(CASE WHEN {total} = 0 OR {same_side} THEN 0.0::DOUBLE
  WHEN {least} = 0 THEN 100.0::DOUBLE
  ELSE ({away} * {away} * {total} + 0.1::DOUBLE) / {margins} END)"""


def _merged(tab: str, numeric, factors) -> str:
    """CTEs of _counts and: grp (variable, ord, bin, g), merged (one row per group)."""
    kind = f"variable IN ({', '.join(repr(c) for c in numeric)})" if numeric else "false"
    return f"""{_counts(tab, numeric, factors)},
bins AS (SELECT variable, bin, n, pos::DOUBLE AS pos, neg::DOUBLE AS neg, row_number() OVER (
           PARTITION BY variable ORDER BY CASE WHEN {kind} THEN position ELSE woe END, bin NULLS FIRST) AS ord
         FROM woe WHERE NOT ({kind}) OR position IS NOT NULL),
walk AS (
  SELECT variable, ord, bin, n, pos AS own_pos, neg AS own_neg, 1 AS g, pos, neg FROM bins WHERE ord = 1
  UNION ALL
  SELECT b.variable, b.ord, b.bin, b.n, b.pos, b.neg,
         CASE WHEN {_chi('w.pos', 'w.neg', 'b.pos', 'b.neg')} <= 2.706::DOUBLE THEN w.g ELSE w.g + 1 END,
         CASE WHEN {_chi('w.pos', 'w.neg', 'b.pos', 'b.neg')} <= 2.706::DOUBLE THEN w.pos + b.pos ELSE b.pos END,
         CASE WHEN {_chi('w.pos', 'w.neg', 'b.pos', 'b.neg')} <= 2.706::DOUBLE THEN w.neg + b.neg ELSE b.neg END
  FROM walk w JOIN bins b ON b.variable = w.variable AND b.ord = w.ord + 1),
grp AS (
  SELECT variable, ord, bin, g, n, own_pos AS pos, own_neg AS neg FROM walk
  UNION ALL
  SELECT variable, 0, bin, 0, n, pos, neg FROM woe WHERE {kind} AND position IS NULL),
joined AS (
  SELECT variable, g::INTEGER AS "group",
         CASE WHEN count(*) > 1 THEN string_agg(coalesce(bin, 'NULL'), '_' ORDER BY ord) ELSE min(bin) END AS bin,
         sum(n)::BIGINT AS n, sum(pos)::BIGINT AS pos, sum(neg)::BIGINT AS neg
  FROM grp GROUP BY variable, g),
merged AS (
  SELECT *, {_woe('pct_1', 'pct_0')} AS woe
  FROM (SELECT joined.*, pos / tp AS pct_1, neg / tn AS pct_0 FROM joined, tot))"""


_STRONG_FACTORS = ["l_linenumber", "l_suppkey"]
_CREDIT = ("miss", CREDIT_NUMERIC, CREDIT_FACTORS)
_STRONG = ("strong", LINE_NUMERIC, _STRONG_FACTORS)
ORACLES["woe_table"] = f"""WITH {MISSING_SQL}, {_counts(*_CREDIT)}
SELECT variable, bin, position, n, pos, neg, {r('pct_1')} AS pct_1, {r('pct_0')} AS pct_0,
       {r('woe')} AS woe FROM woe"""


def _bracket() -> tuple[str, str]:
    low, high = "0.0::DOUBLE", "1.0::DOUBLE"
    low = "CASE " + " ".join(f"WHEN chi2 <= {c!r}::DOUBLE THEN {a!r}::DOUBLE"
                             for a, c in reversed(CHI_SQUARE_CRITICAL)) + f" ELSE {low} END"
    high = "CASE " + " ".join(f"WHEN chi2 >= {c!r}::DOUBLE THEN {a!r}::DOUBLE"
                              for a, c in CHI_SQUARE_CRITICAL) + f" ELSE {high} END"
    return low, high


ORACLES["adjacent_chi2"] = f"""WITH {STRONG_SQL}, {_counts('strong', LINE_NUMERIC, [])},
pairs AS (SELECT variable, position, bin, pos::DOUBLE AS c, neg::DOUBLE AS d,
                 lag(pos::DOUBLE) OVER w AS a, lag(neg::DOUBLE) OVER w AS b
          FROM cnt WINDOW w AS (PARTITION BY variable ORDER BY position)),
x AS (SELECT variable, position, bin, {_chi('a', 'b', 'c', 'd')} AS chi2 FROM pairs WHERE a IS NOT NULL)
SELECT variable, position, bin, {r('chi2', 4)} AS chi2, {_bracket()[0]} AS p_low, {_bracket()[1]} AS p_high
FROM x"""
_MERGED_COLUMNS = f"""SELECT variable, "group", bin, n, pos, neg, {r('pct_1')} AS pct_1,
  {r('pct_0')} AS pct_0, {r('woe')} AS woe FROM merged"""
ORACLES["chi_merge"] = f"WITH RECURSIVE {MISSING_SQL}, {_merged(*_CREDIT)} {_MERGED_COLUMNS}"
ORACLES["chi_merge_strong"] = f"WITH RECURSIVE {STRONG_SQL}, {_merged(*_STRONG)} {_MERGED_COLUMNS}"
ORACLES["merge_groups_streamed"] = f"""WITH RECURSIVE {STRONG_SQL}, {_merged(*_STRONG)}
SELECT variable, bin, g::INTEGER AS "group" FROM grp"""
ORACLES["woe_order"] = f"""WITH {STRONG_SQL}, {_counts('strong', [], _STRONG_FACTORS)}
SELECT variable, bin, {r('woe')} AS woe,
       row_number() OVER (PARTITION BY variable ORDER BY woe, bin NULLS FIRST)::BIGINT AS rank FROM woe"""
_IV = f"SELECT variable, {r('sum((pct_1 - pct_0) * woe)')} AS iv FROM merged GROUP BY variable"
ORACLES["iv_table"] = f"WITH RECURSIVE {MISSING_SQL}, {_merged(*_CREDIT)} {_IV}"
ORACLES["iv_table_strong"] = f"WITH RECURSIVE {STRONG_SQL}, {_merged(*_STRONG)} {_IV}"
ORACLES["woe_values"] = f"""WITH RECURSIVE {STRONG_SQL}, {_merged(*_STRONG)}
SELECT variable, bin, {r('woe')} AS woe FROM merged"""
ORACLES["woe_levels"] = f"""WITH RECURSIVE {STRONG_SQL}, {_merged(*_STRONG)}
SELECT grp.variable, grp.bin, merged."group", {r('merged.woe')} AS woe
FROM grp JOIN merged ON grp.variable = merged.variable AND grp.g = merged."group\""""
_CODES = """ev AS (SELECT event_id, user_id::VARCHAR AS user_id, (event_type = 'error')::INTEGER AS y FROM events),
lc AS (SELECT user_id AS level, sum(y) AS pos, count(*) - sum(y) AS neg FROM ev GROUP BY user_id),
lw AS (SELECT level, ln((pos / (SELECT sum(y) FROM ev)::DOUBLE + 0.01::DOUBLE)
                      / (neg / (SELECT count(*) - sum(y) FROM ev)::DOUBLE + 0.01::DOUBLE)) AS woe FROM lc),
codes AS (SELECT level, woe, round((woe - (SELECT avg(woe) FROM lw)) / (SELECT stddev_samp(woe) FROM lw)
                                   * 10)::BIGINT::VARCHAR AS code FROM lw)"""
ORACLES["woe_level_code"] = f"""WITH {_CODES}
SELECT 'user_id' AS variable, level, {r('woe')} AS woe, code FROM codes"""
ORACLES["reduce_levels"] = f"""WITH {_CODES}, size AS (SELECT count(*) AS n FROM lc)
SELECT event_id, CASE WHEN n > 100 THEN code ELSE user_id END AS user_id
FROM ev JOIN codes ON level = user_id, size"""

# ---- scores ---------------------------------------------------------------

ORACLES["score_histogram"] = f"""WITH {SCORED_SQL},
b AS (SELECT i::INTEGER AS bin, i * 0.01::DOUBLE AS low, (i + 1) * 0.01::DOUBLE AS high FROM range(100) t(i))
SELECT bin, {r('low')} AS low, {r('high')} AS high,
       (SELECT count(*) FROM scored WHERE p1 > low AND p1 <= high)::BIGINT AS n FROM b"""
_GRID = f"""{SCORED_SQL},
sp AS (SELECT p1, sum(y) AS pos, count(*) - sum(y) AS neg FROM scored GROUP BY p1),
t AS (SELECT i / 100.0::DOUBLE AS threshold FROM range(101) g(i)),
grid AS (
  SELECT threshold, coalesce(sum(pos) FILTER (WHERE p1 >= threshold), 0)::BIGINT AS tps,
         coalesce(sum(neg) FILTER (WHERE p1 >= threshold), 0)::BIGINT AS fps,
         coalesce(sum(neg) FILTER (WHERE p1 < threshold), 0)::BIGINT AS tns,
         coalesce(sum(pos) FILTER (WHERE p1 < threshold), 0)::BIGINT AS fns
  FROM t, sp GROUP BY threshold)"""
# the same by a self-join-free route: running sums over the distinct scores
_STEPS = f"""{SCORED_SQL},
sp AS (SELECT p1, sum(y)::BIGINT AS pos, (count(*) - sum(y))::BIGINT AS neg FROM scored GROUP BY p1),
steps AS (
  SELECT p1, pos, neg, sum(pos) OVER w::BIGINT AS tps, sum(neg) OVER w::BIGINT AS fps,
         (row_number() OVER w - 1)::BIGINT AS idx,
         (sum(pos) OVER () - sum(pos) OVER w)::BIGINT AS fns,
         (sum(neg) OVER () - sum(neg) OVER w)::BIGINT AS tns,
         sum(pos) OVER ()::BIGINT AS ap, sum(neg) OVER ()::BIGINT AS an
  FROM sp WINDOW w AS (ORDER BY p1 DESC))"""
_STEPS = _STEPS.replace("OVER w::BIGINT", "OVER w").replace("OVER ()::BIGINT", "OVER ()")


def _div(a: str, b: str) -> str:
    return f"coalesce(({a}) / nullif(({b})::DOUBLE, 0), 0)"


def _rates(tab: str) -> str:
    """A subquery of ``tab`` with every rate."""
    return f"""(SELECT *, {_div('2.0::DOUBLE * precision * tpr', '1.0::DOUBLE * precision + tpr')} AS f1,
  {_div('5.0::DOUBLE * precision * tpr', '4.0::DOUBLE * precision + tpr')} AS f2,
  {_div('1.25::DOUBLE * precision * tpr', '0.25::DOUBLE * precision + tpr')} AS f0point5,
  tpr AS recall, tnr AS specificity, least(tpr, tnr) AS min_per_class_accuracy,
  (tpr + tnr) / 2.0::DOUBLE AS mean_per_class_accuracy
FROM (SELECT *, {_div('tps', 'tps + fps')} AS precision, {_div('tps', 'tps + fns')} AS tpr,
  {_div('tns', 'tns + fps')} AS tnr, {_div('fns', 'tps + fns')} AS fnr, {_div('fps', 'tns + fps')} AS fpr,
  {_div('tps + tns', 'tps + fps + tns + fns')} AS accuracy,
  {_div('abs(tps::DOUBLE * tns - fps::DOUBLE * fns)',
        'sqrt((tps + fps)::DOUBLE) * sqrt((tps + fns)::DOUBLE) * sqrt((tns + fps)::DOUBLE) * sqrt((tns + fns)::DOUBLE)')}
    AS absolute_mcc FROM {tab}))"""


ORACLES["threshold_grid"] = f"WITH {_GRID} SELECT * FROM grid"
ORACLES["threshold_rates"] = f"""WITH {_GRID} SELECT {r('threshold')} AS threshold, tps, fps, tns, fns,
""" + ", ".join(f"{r(n)} AS {n}" for n in RATE_NAMES) + f" FROM {_rates('grid')}"
ORACLES["ks_grid"] = f"""WITH {_GRID},
k AS (SELECT tpr - fpr AS gap, threshold FROM {_rates('grid')}),
b AS (SELECT gap, threshold FROM k ORDER BY gap DESC, threshold LIMIT 1)
SELECT {r('greatest(gap, 0)')} AS ks, {r('CASE WHEN gap > 0 THEN threshold ELSE 0 END')} AS ks_threshold FROM b"""
_KS = """ks AS (SELECT tps / ap::DOUBLE - fps / an::DOUBLE AS gap, p1, idx FROM steps
  ORDER BY gap DESC, p1 LIMIT 1)"""
ORACLES["ks_exact"] = f"""WITH {_STEPS}, {_KS}
SELECT {r('gap')} AS ks, {r('p1')} AS ks_threshold, idx AS ks_idx FROM ks"""
ORACLES["ks_thinned"] = f"""WITH {_STEPS}, {_KS},
pick AS (SELECT min(idx) AS i FROM steps GROUP BY (idx * 20) // (SELECT count(*) FROM steps) UNION SELECT idx FROM ks)
SELECT idx, {r('p1')} AS threshold, tps::BIGINT AS tps, fps::BIGINT AS fps, tns, fns,
       {r('tpr - fpr')} AS tpr_fpr
FROM {_rates('steps')} WHERE (SELECT count(*) FROM steps) <= 30 OR idx IN (SELECT i FROM pick)"""


def _line(actual: str, zero: str, one: str, wrong: str, of: str) -> str:
    return f"""SELECT {r('threshold')} AS threshold, '{actual}' AS actual, ({zero})::BIGINT AS predicted_0,
  ({one})::BIGINT AS predicted_1, {r(f'({wrong}) / nullif(({of})::DOUBLE, 0)')} AS error,
  '(' || ({wrong})::VARCHAR || ' / ' || ({of})::VARCHAR || ')' AS rate FROM grid WHERE threshold < 1"""


ORACLES["confusion_at"] = f"WITH {_GRID} " + union([
    _line("0", "tns", "fps", "fps", "tns + fps"), _line("1", "fns", "tps", "fns", "tps + fns"),
    _line("Total", "tns + fns", "fps + tps", "fps + fns", "tns + fns + fps + tps")])
ORACLES["score_group"] = f"""WITH {SCORED_SQL},
band AS (SELECT j, (SELECT count(*) FROM scored WHERE y = 1 AND p1 >= j / 10.0::DOUBLE
                      AND (p1 < (j + 1) / 10.0::DOUBLE OR j = 9))::BIGINT AS pos,
                (SELECT count(*) FROM scored WHERE y = 0 AND p1 >= j / 10.0::DOUBLE
                      AND (p1 < (j + 1) / 10.0::DOUBLE OR j = 9))::BIGINT AS neg FROM range(10) g(j)),
x AS (SELECT *, j >= i AS hit, (SELECT count(*) FROM scored) AS total FROM band, range(11) h(i))
SELECT i / 10.0::DOUBLE AS cut, (j / 10.0::DOUBLE)::VARCHAR || '-' || ((j + 1) / 10.0::DOUBLE)::VARCHAR AS score_band,
  {r('(pos + neg) / total::DOUBLE')} AS fraction,
  CASE WHEN hit THEN pos ELSE 0 END AS tps, CASE WHEN hit THEN neg ELSE 0 END AS fps,
  CASE WHEN hit THEN 0 ELSE neg END AS tns, CASE WHEN hit THEN 0 ELSE pos END AS fns,
  CASE WHEN hit AND pos > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS recall,
  CASE WHEN hit THEN {r(_div('pos', 'pos + neg'))} ELSE 0.0::DOUBLE END AS precision,
  CASE WHEN hit THEN {r(_div('pos', 'pos + neg'))} ELSE {r(_div('neg', 'pos + neg'))} END AS accuracy,
  CASE WHEN NOT hit AND neg > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS specificity
FROM x"""
ORACLES["top_n"] = f"""WITH {_STEPS},
goal AS (SELECT i, greatest((i * (SELECT count(*) FROM scored)) // 10, 1) AS g FROM range(1, 11) r(i)),
hit AS (SELECT i, (SELECT max(p1) FROM steps WHERE tps + fps >= g) AS cut FROM goal)
SELECT 'Top' || (i * 10)::VARCHAR || '%' AS score_top, {r('p1')} AS threshold, tps::BIGINT AS tps,
  fps::BIGINT AS fps, tns, fns, {r('tpr')} AS recall, {r('precision')} AS precision,
  {r('accuracy')} AS accuracy, {r('tnr')} AS specificity
FROM hit JOIN {_rates('steps')} ON p1 = cut"""
_CUTS = ", ".join(f"({i + 1}, {round(1 - s, 10)!r}::DOUBLE)" for i, s in enumerate(GAINS_SHARES))
_CUT_Q = union(
    f"SELECT {i + 1} AS g, quantile_cont(p1, {round(1 - s, 10)!r}) AS cut FROM scored"
    for i, s in enumerate(GAINS_SHARES))
ORACLES["gains_lift"] = f"""WITH {SCORED_SQL},
cuts AS ({_CUT_Q}),
lab AS (SELECT y, p1, (SELECT coalesce(min(g), 16) FROM cuts WHERE p1 >= cut) AS g FROM scored),
gr AS (SELECT g, sum(y)::DOUBLE AS pos, (count(*) - sum(y))::DOUBLE AS neg, count(*)::DOUBLE AS n,
              sum(p1) AS s, min(p1) AS low FROM lab GROUP BY g),
c AS (SELECT *, sum(pos) OVER w AS cp, sum(neg) OVER w AS cn, sum(s) OVER w AS cs, sum(n) OVER w AS cc,
             sum(pos) OVER () AS ap, sum(neg) OVER () AS an, sum(n) OVER () AS al
      FROM gr WINDOW w AS (ORDER BY g))
SELECT g::INTEGER AS "group", {r('cc / al')} AS cumulative_data_fraction, {r('low')} AS lower_threshold,
  {r('(pos / n) / (ap / al)')} AS lift, {r('(cp / cc) / (ap / al)')} AS cumulative_lift,
  {r('pos / n')} AS response_rate, {r('s / n')} AS score, {r('cp / cc')} AS cumulative_response_rate,
  {r('cs / cc')} AS cumulative_score, {r('pos / ap')} AS capture_rate, {r('cp / ap')} AS cumulative_capture_rate,
  {r('100 * ((pos / n) / (ap / al) - 1)')} AS gain, {r('100 * ((cp / cc) / (ap / al) - 1)')} AS cumulative_gain,
  {r('cp / ap - cn / an')} AS kolmogorov_smirnov
FROM c"""


def _best(names) -> str:
    return f"""WITH {_STEPS}, rated AS (SELECT * FROM {_rates('steps')}),
long AS ({union(f"SELECT '{n}' AS metric, {n} AS value, p1, idx FROM rated" for n in names)}),
rk AS (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY value DESC, p1) AS rn FROM long)
SELECT metric, {r('p1')} AS threshold, {r('value')} AS value, idx FROM rk WHERE rn = 1"""


ORACLES["best_thresholds"] = _best(BEST_METRICS)
ORACLES["max_criteria"] = _best(RATE_NAMES)


def _loss(tab: str, steps: str) -> str:
    clip = "greatest(1e-15::DOUBLE, least((1 - 1e-15)::DOUBLE, p1))"
    return f"""SELECT count(*)::BIGINT AS nobs, avg((y - p1) * (y - p1)) AS mse,
  avg(-(y * ln({clip}) + (1 - y) * ln(1 - {clip}))) AS logloss, var_pop(y) AS vy,
  (SELECT sum(neg * (tps - pos / 2.0::DOUBLE)) / (max(ap)::DOUBLE * max(an)) FROM {steps}) AS auc FROM {tab}"""


ORACLES["overall_metrics"] = f"""WITH {_STEPS}, m AS ({_loss('scored', 'steps')})
SELECT nobs, {r('mse')} AS mse, {r('sqrt(mse)')} AS rmse, {r('logloss')} AS logloss,
  {r('1 - mse / vy')} AS r2, {r('auc')} AS auc, {r('2 * auc - 1')} AS gini, NULL::DOUBLE AS aic FROM m"""


def _set(which: str, cond: str) -> str:
    steps = _STEPS.split("sp AS", 1)[1].replace("FROM scored GROUP", f"FROM {which} GROUP")
    steps = ("sp AS" + steps).replace("sp AS", f"sp_{which} AS").replace("steps AS", f"steps_{which} AS") \
        .replace("FROM sp ", f"FROM sp_{which} ")
    return f"""{which} AS (SELECT * FROM scored
  WHERE {hash_int(LINE_KEYS, 'split')} / 4294967296.0::DOUBLE {cond} 0.7::DOUBLE), {steps},
m_{which} AS ({_loss(which, 'steps_' + which)})"""


ORACLES["metrics_by_line"] = f"""WITH {SCORED_SQL},
g AS (SELECT l_linenumber, p1, sum(y) AS pos, count(*) - sum(y) AS neg FROM scored GROUP BY l_linenumber, p1),
s AS (SELECT *, sum(pos) OVER (PARTITION BY l_linenumber ORDER BY p1 DESC) AS tps FROM g),
a AS (SELECT l_linenumber, sum(neg * (tps - pos / 2.0::DOUBLE)) / (sum(pos)::DOUBLE * sum(neg)) AS auc
      FROM s GROUP BY l_linenumber),
m AS (SELECT l_linenumber, count(*)::BIGINT AS nobs, avg((y - p1) * (y - p1)) AS mse, var_pop(y) AS vy FROM scored
      GROUP BY l_linenumber)
SELECT l_linenumber, nobs, {r('mse')} AS mse, {r('1 - mse / vy')} AS r2, {r('auc')} AS auc FROM m JOIN a USING (l_linenumber)"""
_LABELLED = f"""WITH {MISSING_SQL}, labelled AS (
  SELECT o_orderkey, CAST(o_totalprice > 250000 OR c_nationkey % 5 = 0 AS INTEGER) AS y FROM miss)"""
ORACLES["train_lr_folds"] = f"""{_LABELLED}
SELECT ({hash_int(['o_orderkey'], 'fold')} % 3)::INTEGER AS fold, count(*)::BIGINT AS n, sum(y)::BIGINT AS positives,
       count(*)::BIGINT AS scored FROM labelled GROUP BY 1"""
ORACLES["train_holdout"] = f"""{_LABELLED}
SELECT CASE WHEN {hash_int(['o_orderkey'], 'split')} / 4294967296.0::DOUBLE < 0.7::DOUBLE THEN 'trained' ELSE 'judged' END
       AS side, count(*)::BIGINT AS n, sum(y)::BIGINT AS positives FROM labelled GROUP BY 1"""
ORACLES["metric_sets"] = f"""WITH {SCORED_SQL}, {_set('train', '<')}, {_set('valid', '>=')}
""" + union(f"""SELECT '{w}' AS split, nobs, {r('mse')} AS mse, {r('logloss')} AS logloss, {r('auc')} AS auc
FROM m_{w}""" for w in ("train", "valid"))


def _nb_numeric(c: str) -> str:
    def part(k: int) -> str:
        return f"(-ln(sd_{k}_{c}) - power(({c} - mean_{k}_{c}) / sd_{k}_{c}, 2) / 2)"
    return f"coalesce({part(1)} - {part(0)}, 0)"


_NB_MOMENTS = ", ".join(
    f"avg({c}) FILTER (WHERE y = {k}) AS mean_{k}_{c}, stddev_samp({c}) FILTER (WHERE y = {k}) AS sd_{k}_{c}"
    for c in CREDIT_NUMERIC for k in (0, 1))


def _nb_levels(laplace: float) -> str:
    def share(k: int) -> str:
        return (f"coalesce(nullif((count(*) FILTER (WHERE y = {k}) + {laplace}) / (max(n{k}) + {laplace} * max(k))::DOUBLE, 0), "
                "0.001::DOUBLE)")
    return ", ".join(
        f"""l_{c} AS (SELECT {c} AS lv, ln({share(1)}) - ln({share(0)}) AS ll
    FROM miss, nn, (SELECT count(DISTINCT {c}) AS k FROM miss) WHERE {c} IS NOT NULL GROUP BY {c})"""
        for c in CREDIT_FACTORS)


def _nb_score(laplace: float, source: str) -> str:
    return f"""WITH {MISSING_SQL.replace('miss AS', 'kept AS', 1) if source else MISSING_SQL}{source},
nn AS (SELECT sum(y) AS n1, count(*) - sum(y) AS n0 FROM miss),
mo AS (SELECT {_NB_MOMENTS} FROM miss), {_nb_levels(laplace)},
odds AS (SELECT o_orderkey, ln(n1 / n0::DOUBLE) + {' + '.join(_nb_numeric(c) for c in CREDIT_NUMERIC)}
  + {' + '.join(f'coalesce(l_{c}.ll, 0)' for c in CREDIT_FACTORS)} AS odds
  FROM miss {' '.join(f'LEFT JOIN l_{c} ON {c} = l_{c}.lv' for c in CREDIT_FACTORS)}, nn, mo)
SELECT o_orderkey, {r('1 / (1 + exp(-odds))')} AS p1 FROM odds"""


ORACLES["nb_score"] = _nb_score(1, "")
#: A level that one label never has: buildings are taken from the positives.
ORACLES["nb_score_unsmoothed"] = _nb_score(
    0, ", miss AS (SELECT * REPLACE (CASE WHEN y = 1 AND c_mktsegment = 'BUILDING' THEN 'MACHINERY' "
       "ELSE c_mktsegment END AS c_mktsegment) FROM kept)")

_DIST = " + ".join(f"({c} - c_{c}) * ({c} - c_{c})" for c in LINE_NUMERIC)
_ASSIGNED = f"""centre AS (
  SELECT row_number() OVER (ORDER BY l_linenumber) - 1 AS k, {', '.join(
      f'round(avg({c}), 4) + (row_number() OVER (ORDER BY l_linenumber) - 1) AS c_{c}' for c in LINE_NUMERIC)}
  FROM lineitem GROUP BY l_linenumber),
best AS (SELECT lineitem.*, k, {_DIST} AS d, row_number() OVER (
           PARTITION BY {_ALL_LINE} ORDER BY {_DIST}, k) AS rn FROM lineitem, centre),
assigned AS (SELECT *, k::INTEGER AS cluster FROM best WHERE rn = 1)"""
ORACLES["cluster_assign"] = f"""WITH {_ASSIGNED}
SELECT {', '.join(LINE_KEYS)}, {r('l_quantity', 2)} AS l_quantity, cluster, {r('d', 2)} AS sq_dist FROM assigned"""
ORACLES["cluster_quality"] = f"""WITH {_ASSIGNED}
SELECT cluster, count(*)::BIGINT AS size, {r('sum(d) / 1e9', 3)} AS withinss, """ + ", ".join(
    f"{r(f'avg({c})', 1)} AS mean_{c}" for c in LINE_NUMERIC) + " FROM assigned GROUP BY cluster"
_SS = " + ".join(f"var_pop({c}) * count({c})" for c in LINE_NUMERIC)
ORACLES["cluster_totals"] = f"""WITH {_ASSIGNED},
s AS (SELECT {_SS} AS totss, sum(d) AS tot_withinss FROM assigned)
SELECT {r('totss / 1e9', 3)} AS totss, {r('tot_withinss / 1e9', 3)} AS tot_withinss,
       {r('(totss - tot_withinss) / 1e9', 3)} AS betweenss FROM s"""

#: The seven centres for all rows; fold k of three has the first 7 - k of them for its own rows.
_SETS = f"""parts AS (SELECT *, row_number() OVER () AS nth, ({hash_int(LINE_KEYS, 'fold')} % 3)::INTEGER AS part FROM lineitem),
centre AS (
  SELECT row_number() OVER (ORDER BY l_linenumber) - 1 AS k, {', '.join(
      f'round(avg({c}), 4) + (row_number() OVER (ORDER BY l_linenumber) - 1) AS c_{c}' for c in LINE_NUMERIC)}
  FROM lineitem GROUP BY l_linenumber),
models AS (SELECT 'train' AS "set", 0 AS fold, p.part, centre.* FROM centre, (VALUES (0), (1), (2)) p(part)
           UNION ALL SELECT 'xval', p.part, p.part, centre.* FROM centre, (VALUES (0), (1), (2)) p(part) WHERE k < 7 - p.part),
near AS (SELECT "set", fold, nth, {', '.join(LINE_NUMERIC)}, arg_min(k, (d, k)) AS k, min(d) AS d
         FROM (SELECT parts.*, "set", fold, k, {_DIST} AS d FROM parts JOIN models USING (part)) GROUP BY ALL)"""
ORACLES["cluster_sets"] = f"""WITH {_SETS}
SELECT m."set", m.fold, m.k::INTEGER AS cluster, count(near.k)::BIGINT AS size, {r('coalesce(sum(d), 0) / 1e9', 3)} AS withinss
FROM (SELECT DISTINCT "set", fold, k FROM models) m LEFT JOIN near ON m."set" = near."set" AND m.fold = near.fold
  AND m.k = near.k GROUP BY ALL"""
ORACLES["cluster_set_totals"] = f"""WITH {_SETS},
folds AS (SELECT "set", fold, count(*) AS n, {_SS} AS totss, sum(d) AS within FROM near GROUP BY ALL)
SELECT "set", sum(n)::BIGINT AS size, {r('sum(totss) / 1e9', 3)} AS totss, {r('sum(within) / 1e9', 3)} AS tot_withinss,
       {r('sum(totss - within) / 1e9', 3)} AS betweenss FROM folds GROUP BY 1"""


def _kmeans_sets(folds: int, part: str, fitted: str, judged: str, held: str) -> str:
    """Columns are scaled by the rows that train; a set is judged to the mean of each of its folds."""
    scale = ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in LINE_NUMERIC)
    spread = " + ".join(f"var_pop(({c} - m_{c}) / s_{c}) * count(*)" for c in LINE_NUMERIC)
    return f"""SELECT '{folds} ' || name AS "set", sum(n)::BIGINT AS size, sum(n)::BIGINT AS in_clusters,
  {r('sum(ss) / sum(n)', 5)} AS totss_per_row, true AS adds_up
FROM (SELECT 'train' AS name, 0 AS part, count(*) AS n, {spread} AS ss FROM ({part}) p, (SELECT {scale} FROM ({part}) q WHERE {fitted})
      WHERE {fitted}
      UNION ALL SELECT '{held}', part, count(*), {spread} FROM ({part}) p, (SELECT {scale} FROM ({part}) q WHERE {fitted})
      WHERE {judged} GROUP BY part) GROUP BY name"""


ORACLES["kmeans_sets"] = _kmeans_sets(
    1, f"SELECT *, CASE WHEN {hash_int(LINE_KEYS, 'split')} / 4294967296.0::DOUBLE < 0.7::DOUBLE THEN 0 ELSE 1 END AS part "
       "FROM lineitem", "part = 0", "part = 1", "valid") + " UNION ALL " + _kmeans_sets(
    3, f"SELECT *, {hash_int(LINE_KEYS, 'fold')} % 3 AS part FROM lineitem", "true", "true", "xval")
