"""DuckDB SQL equivalents of the catalogue queries (the correctness oracle).

Each string runs on the pre-registered parquet views.  Doubles are rounded
through VARCHAR -> DECIMAL so DuckDB rounds ties the way Spark's ``round``
does (half-up on the shortest decimal form), and counts are cast to BIGINT.
"""

from __future__ import annotations

import re


def rnd(expr: str, digits: int = 4) -> str:
    """Spark-compatible ``round(expr, digits)`` for a DOUBLE expression."""
    return f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def y0(label: str) -> str:
    """Start year of a period label, -1 when unparsable."""
    return f"COALESCE(TRY_CAST(NULLIF(regexp_extract(CAST({label} AS VARCHAR), '^\\s*([0-9]{{4}})', 1), '') AS INTEGER), -1)"


def label(year: str) -> str:
    return f"printf('%d-%02d', {year}, ({year} + 1) % 100)"


# ---------------------------------------------------------------- panel CTEs

PANEL_CTE = f"""
li_o AS (
  SELECT l_orderkey AS o_orderkey, SUM(l_quantity) AS mp,
         SUM(l_extendedprice * (1 - l_discount)) AS rev, COUNT(*) AS nl,
         SUM(l_extendedprice * l_tax) AS taxamt
  FROM lineitem GROUP BY l_orderkey),
stints AS (
  SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS yr, o_orderpriority AS stint,
         CAST(COUNT(*) AS DOUBLE) AS G, SUM(mp) AS MP, SUM(rev) AS REV,
         CAST(SUM(nl) AS DOUBLE) AS NL, SUM(taxamt) AS TAXAMT
  FROM orders JOIN li_o USING (o_orderkey)
  GROUP BY o_custkey, yr, o_orderpriority),
comb AS (
  SELECT o_custkey, yr, CAST(COUNT(*) AS VARCHAR) || 'TM' AS stint, SUM(G) AS G, SUM(MP) AS MP,
         SUM(REV) AS REV, SUM(NL) AS NL, SUM(TAXAMT) AS TAXAMT
  FROM stints GROUP BY o_custkey, yr HAVING COUNT(*) >= 2),
panel AS (
  SELECT o_custkey, {label('yr')} AS period, stint, G, MP, REV, NL, TAXAMT FROM stints
  UNION ALL
  SELECT o_custkey, {label('yr')} AS period, stint, G, MP, REV, NL, TAXAMT FROM comb)
"""

DEDUP_CTE = f"""
ded AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY o_custkey, period
      ORDER BY COALESCE(regexp_matches(stint, '^[0-9]+TM$'), false) DESC, stint) AS rn
    FROM panel WHERE o_custkey IS NOT NULL AND period IS NOT NULL) WHERE rn = 1),
rated AS (
  SELECT *, (0.01 * REV + 2.0 * NL + -0.05 * TAXAMT) / NULLIF(G, 0) AS rate,
         {y0('period')} AS y0,
         COALESCE(G >= 2 AND MP >= 100, false) AS q
  FROM ded)
"""

SUMMARY_CTE = f"""
{PANEL_CTE.strip()},
{DEDUP_CTE.strip()},
roll AS (
  SELECT o_custkey, MIN(y0) AS first_period_start_year, arg_min(period, y0) AS first_period,
         COALESCE(SUM(G), 0.0) AS career_games,
         CAST(COUNT(*) FILTER (WHERE q) AS INTEGER) AS n_qualifying,
         AVG(rate) FILTER (WHERE q) AS mean_rate_qual
  FROM rated GROUP BY o_custkey),
wend AS (SELECT COALESCE(MAX(y0) FILTER (WHERE y0 >= 1990), MAX(y0)) AS e FROM rated),
s2 AS (
  SELECT roll.*, COALESCE(first_period_start_year BETWEEN 1995 AND 1997, false) AS entry_cohort,
    CASE WHEN CAST(trunc(career_games) AS BIGINT) <= 0 THEN 'A' WHEN n_qualifying = 0 THEN 'B'
         WHEN n_qualifying = 1 THEN 'C' ELSE 'D' END AS tier,
    CAST(wend.e AS INTEGER) AS window_end_year,
    CASE WHEN first_period_start_year BETWEEN 1990 AND wend.e
         THEN CAST(GREATEST(1, wend.e - first_period_start_year + 1) AS DOUBLE) END AS eligible_periods
  FROM roll CROSS JOIN wend),
s3 AS (
  SELECT *, eligible_periods * 12.0 AS nominal_max_games,
         career_games / (eligible_periods * 12.0) AS games_vs_opportunity
  FROM s2),
mom AS (
  SELECT AVG(mean_rate_qual) AS mr, STDDEV_POP(mean_rate_qual) AS sr,
         AVG(ln(1 + games_vs_opportunity)) AS ml, STDDEV_POP(ln(1 + games_vs_opportunity)) AS sl
  FROM s3 WHERE tier = 'D' AND entry_cohort),
summary AS (
  SELECT s3.*,
    CASE WHEN tier = 'D' AND entry_cohort THEN (mean_rate_qual - mr) / NULLIF(sr, 0) END AS z_rate,
    CASE WHEN tier = 'D' AND entry_cohort THEN (ln(1 + games_vs_opportunity) - ml) / NULLIF(sl, 0) END AS z_longevity
  FROM s3 CROSS JOIN mom),
summary2 AS (
  SELECT *, CASE WHEN tier = 'D' AND entry_cohort THEN 0.7 * z_rate + 0.3 * z_longevity END AS composite
  FROM summary)
"""

SUMMARY_SELECT = f"""
SELECT o_custkey, first_period_start_year, first_period, {rnd('career_games')} AS career_games,
       n_qualifying, {rnd('mean_rate_qual')} AS mean_rate_qual, entry_cohort, tier, window_end_year,
       {rnd('eligible_periods')} AS eligible_periods, {rnd('nominal_max_games')} AS nominal_max_games,
       {rnd('games_vs_opportunity')} AS games_vs_opportunity, {rnd('z_rate')} AS z_rate,
       {rnd('z_longevity')} AS z_longevity, {rnd('composite')} AS composite
FROM summary2
"""


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body.strip()}"


SQL: dict[str, str] = {}

SQL["career_summary"] = _with(SUMMARY_CTE, SUMMARY_SELECT)

SQL["tier_counts"] = _with(SUMMARY_CTE, """
SELECT tier, COUNT(*) AS n_entities,
       CAST(COUNT(*) FILTER (WHERE entry_cohort) AS BIGINT) AS n_cohort,
       CAST(COUNT(composite) AS BIGINT) AS n_composite
FROM summary2 GROUP BY tier
""")

SQL["zscore_composite"] = _with(SUMMARY_CTE, f"""
SELECT o_custkey, {rnd('z_rate')} AS z_rate, {rnd('z_longevity')} AS z_longevity,
       {rnd('composite')} AS composite
FROM summary2 WHERE tier = 'D' AND entry_cohort
""")

SQL["opportunity_share"] = _with(SUMMARY_CTE, f"""
SELECT o_custkey, first_period_start_year, window_end_year,
       {rnd('eligible_periods')} AS eligible_periods, {rnd('nominal_max_games')} AS nominal_max_games,
       {rnd('games_vs_opportunity')} AS games_vs_opportunity
FROM summary2
""")

SQL["dedupe_prefer_flagged"] = f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_shipdate,
       {rnd('l_quantity')} AS l_quantity, {rnd('l_extendedprice')} AS l_extendedprice
FROM (
  SELECT *, row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber
    ORDER BY COALESCE(l_returnflag = 'A', false) DESC, l_partkey, l_suppkey, l_shipdate,
             l_quantity, l_extendedprice) AS rn
  FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL)
WHERE rn = 1
"""

SQL["keep_first"] = f"""
SELECT user_id, event_type, event_id, ts, {rnd('value')} AS value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id NULLS FIRST) AS rn
  FROM events) WHERE rn = 1
"""

SQL["keep_last"] = f"""
SELECT user_id, event_type, event_id, ts, {rnd('value')} AS value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC NULLS LAST) AS rn
  FROM events) WHERE rn = 1
"""

SQL["latest_per_key"] = f"""
SELECT o_custkey, o_orderkey, period, {rnd('o_totalprice')} AS o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey
           ORDER BY {y0('period')} DESC, o_orderdate DESC NULLS LAST, o_orderkey DESC NULLS LAST) AS rn
  FROM (SELECT *, {label('year(o_orderdate)')} AS period FROM orders) o
  WHERE o_custkey IS NOT NULL AND regexp_matches(period, '^[0-9]{{4}}-[0-9]{{2}}$')) WHERE rn = 1
"""

SQL["earliest_per_key"] = f"""
SELECT o_custkey, o_orderpriority AS first_priority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY y, o_orderdate, o_orderkey) AS rn
  FROM (SELECT *, {y0(label('year(o_orderdate)'))} AS y FROM orders) o WHERE y >= 1990) WHERE rn = 1
"""

SQL["first_seen"] = """
SELECT o_custkey, o_orderkey, o_orderdate FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate NULLS FIRST, o_orderkey NULLS FIRST) AS rn
  FROM orders) WHERE rn = 1
"""

SQL["weighted_index"] = f"""
SELECT l_orderkey, l_linenumber,
  {rnd('0.5 * l_extendedprice + 100.0 * l_discount + -200.0 * (CASE WHEN l_linenumber <> 3 THEN l_tax END)')} AS index_value
FROM lineitem
"""

SQL["safe_ratio"] = f"""
SELECT l_orderkey, l_linenumber, {rnd('l_extendedprice / NULLIF(l_tax, 0)')} AS price_per_tax FROM lineitem
"""

SQL["patch_join"] = _with(PANEL_CTE, f"""
, base AS (
  SELECT o_custkey, {label('yr')} AS period, SUM(G) AS G, SUM(MP) AS MP, SUM(MP) / SUM(G) AS AQ
  FROM stints GROUP BY o_custkey, yr),
pst AS (
  SELECT o_custkey, {label('CAST(year(o_orderdate) AS INTEGER)')} AS period, o_orderpriority AS stint,
         AVG(l_quantity) AS AQ, MAX(l_discount) AS MD
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE year(o_orderdate) >= 1998
  GROUP BY 1, 2, 3),
patch AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, period ORDER BY stint NULLS FIRST) AS rn
                 FROM pst) WHERE rn = 1)
SELECT b.o_custkey, b.period, {rnd('b.G')} AS G, {rnd('b.MP')} AS MP, {rnd('COALESCE(p.AQ, b.AQ)')} AS AQ,
       {rnd('p.MD')} AS MD
FROM base b LEFT JOIN patch p
  ON b.o_custkey IS NOT DISTINCT FROM p.o_custkey AND b.period IS NOT DISTINCT FROM p.period
""")

SQL["left_label_join"] = """
SELECT c_custkey, c_name, COALESCE(n.n_name, 'UNK') AS n_name
FROM customer c LEFT JOIN (SELECT n_nationkey, n_name FROM nation WHERE n_regionkey <= 2) n
  ON c.c_nationkey = n.n_nationkey
"""

SQL["one_to_one_join"] = _with(SUMMARY_CTE, """
SELECT c_custkey AS o_custkey, c_name, c_mktsegment, s.tier
FROM customer LEFT JOIN summary2 s ON c_custkey = s.o_custkey
""")

_BLOCKS = ",\n".join(
    f"b{f} AS (SELECT l_orderkey, SUM(l_quantity) AS {f}_qty, COUNT(*) AS {f}_n FROM lineitem "
    f"WHERE l_returnflag = '{f}' GROUP BY l_orderkey)" for f in "ANR"
)

SQL["outer_block_assembly"] = f"""
WITH {_BLOCKS},
w AS (SELECT * FROM bA FULL OUTER JOIN bN USING (l_orderkey) FULL OUTER JOIN bR USING (l_orderkey))
SELECT o_orderkey, o_custkey, {rnd('A_qty')} AS A_qty, A_n, {rnd('N_qty')} AS N_qty, N_n,
       {rnd('R_qty')} AS R_qty, R_n
FROM orders LEFT JOIN w ON o_orderkey = w.l_orderkey
"""

EVENTS_LONG_CTE = f"""
el AS (
  SELECT event_id, user_id, event_type AS table_id,
    CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 7 = 1 THEN '' WHEN event_id % 7 = 2 THEN '  '
         WHEN event_id % 7 = 3 THEN 'nan' ELSE {label('year(ts)')} END AS Season,
    CASE WHEN event_id % 7 <> 0 THEN value END AS value,
    CASE WHEN event_type = 'click' THEN value END AS click_value,
    CASE WHEN event_type = 'purchase' THEN props END AS purchase_props,
    CAST(NULL AS DOUBLE) AS empty_measure
  FROM events)
"""

_SPLIT_COLS = ["event_id", "user_id", "Season", "click_value", "empty_measure", "purchase_props", "value"]

SQL["split_by_type"] = _with(EVENTS_LONG_CTE, f"""
SELECT table_id, COUNT(*) AS n_rows,
  concat_ws(',', {', '.join(f"CASE WHEN COUNT({c}) > 0 THEN '{c}' END" for c in _SPLIT_COLS)}) AS columns
FROM el WHERE table_id IS NOT NULL GROUP BY table_id
""")

SQL["drop_all_null"] = _with(EVENTS_LONG_CTE, f"""
SELECT event_id, user_id, table_id, Season, {rnd('value')} AS value, {rnd('click_value')} AS click_value,
       purchase_props
FROM el
""")

SQL["drop_spacers"] = _with(EVENTS_LONG_CTE, """
SELECT event_id, table_id, Season FROM el WHERE Season IS NOT NULL AND trim(Season) NOT IN ('', 'nan')
""")

SQL["normalise_names"] = f"""
SELECT l_orderkey AS "order", {rnd('l_discount')} AS Price_disc_pct, {rnd('l_tax')} AS tax_price,
       {rnd('l_quantity')} AS qty_total, l_returnflag AS flag
FROM lineitem
"""

SQL["safe_numeric"] = f"""
SELECT event_id,
  {rnd("TRY_CAST(CASE WHEN event_id % 11 = 0 THEN 'x' ELSE regexp_extract(props, '([0-9]+)', 1) END AS DOUBLE)")} AS k,
  event_type AS kind, CAST(user_id AS VARCHAR) AS Team
FROM events
"""

SQL["replace_by_key"] = f"""
WITH ex AS (SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders
            WHERE o_orderdate < TIMESTAMP '1998-01-01'),
nw AS (SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice * 2 AS o_totalprice FROM orders
       WHERE o_orderdate >= TIMESTAMP '1997-01-01')
SELECT o_orderkey, o_custkey, o_orderdate, {rnd('o_totalprice')} AS o_totalprice FROM ex
WHERE NOT EXISTS (SELECT 1 FROM nw WHERE CAST(nw.o_custkey AS VARCHAR) = CAST(ex.o_custkey AS VARCHAR))
UNION ALL
SELECT o_orderkey, o_custkey, o_orderdate, {rnd('o_totalprice')} AS o_totalprice FROM nw
"""

SQL["backfill_keys"] = """
SELECT o_custkey, o_orderkey, o_orderdate FROM orders WHERE year(o_orderdate) <= 1996
UNION ALL
SELECT o_custkey, o_orderkey, o_orderdate FROM orders l WHERE year(o_orderdate) >= 1997
  AND NOT EXISTS (SELECT 1 FROM orders e WHERE year(e.o_orderdate) <= 1996
                  AND CAST(e.o_custkey AS VARCHAR) = CAST(l.o_custkey AS VARCHAR))
"""


def _missing(a: str, ka: str, b: str, kb: str) -> str:
    return (f"(SELECT COUNT(DISTINCT CAST({ka} AS VARCHAR)) FROM {a} WHERE {ka} IS NOT NULL AND "
            f"CAST({ka} AS VARCHAR) NOT IN (SELECT CAST({kb} AS VARCHAR) FROM {b} WHERE {kb} IS NOT NULL))")


SQL["key_set_diff"] = f"""
SELECT {_missing('documents', 'doc_id', 'labels', 'doc_id')} AS docs_without_label,
       {_missing('labels', 'doc_id', 'documents', 'doc_id')} AS labels_without_doc,
       {_missing('orders', 'o_orderkey', 'lineitem', 'l_orderkey')} AS orders_without_lines,
       {_missing('lineitem', 'l_orderkey', 'orders', 'o_orderkey')} AS lines_without_order
"""

SQL["crosswalk_filter"] = """
SELECT DISTINCT d.source, l.quality, CAST(NULL AS DOUBLE) AS height
FROM documents d LEFT JOIN labels l USING (doc_id)
WHERE l.quality IS NOT NULL AND d.source IS NOT NULL
"""

SQL["failure_log"] = """
SELECT d.doc_id AS entity_id, d.source AS entity_url, 'toxic:' || d.lang AS error
FROM documents d LEFT JOIN labels l USING (doc_id) WHERE l.toxic = 1
"""

SQL["union_by_name"] = """
SELECT doc_id, lang, source, CAST(NULL AS INTEGER) AS quality FROM documents WHERE contains(source, 'src1')
UNION ALL
SELECT doc_id, NULL AS lang, NULL AS source, quality FROM labels
"""

# ------------------------------------------------------------ profiling (A)

_EL_COLS = ["event_id", "user_id", "table_id", "Season", "value", "click_value", "purchase_props", "empty_measure"]

SQL["null_rates"] = _with(EVENTS_LONG_CTE, "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column, {rnd(f'COUNT(*) FILTER (WHERE {c} IS NULL) * 100.0 / COUNT(*)')} AS pct_missing FROM el"
    for c in _EL_COLS
))

_LINE_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _describe_rows(table: str, cols) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column, COUNT({c}) AS count, {rnd(f'AVG({c})')} AS mean, {rnd(f'STDDEV_SAMP({c})')} AS std, "
        f"{rnd(f'MIN({c})')} AS min, {rnd(f'quantile_cont({c}, 0.25)')} AS p25, {rnd(f'quantile_cont({c}, 0.5)')} AS p50, "
        f"{rnd(f'quantile_cont({c}, 0.75)')} AS p75, {rnd(f'MAX({c})')} AS max FROM {table}"
        for c in cols
    )


SQL["describe"] = _describe_rows("lineitem", _LINE_NUM)

SQL["value_counts"] = _with(EVENTS_LONG_CTE, "SELECT Season, COUNT(*) AS n FROM el GROUP BY Season")

_EV_NUM = ["value", "click_value", "user_id", "event_id"]
_pairs = []
for _i, _a in enumerate(_EV_NUM):
    for _b in _EV_NUM[_i:]:
        _pairs.append((_a, _b))
        if _a != _b:
            _pairs.append((_b, _a))

SQL["corr_matrix"] = _with(EVENTS_LONG_CTE, "\nUNION ALL\n".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, {rnd(f'corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))')} AS r FROM el"
    for a, b in _pairs
))

SQL["histogram"] = f"""
WITH d AS (SELECT event_type, value AS x FROM events WHERE value IS NOT NULL),
r AS (SELECT event_type, MIN(x) AS mn, MAX(x) AS mx FROM d GROUP BY event_type),
c AS (
  SELECT d.event_type,
    CAST(CASE WHEN mx - mn = 0 THEN 15 ELSE LEAST(FLOOR((x - mn) / (mx - mn) * 30), 29) END AS INTEGER) AS bin,
    COUNT(*) AS n
  FROM d JOIN r USING (event_type) GROUP BY 1, 2),
g AS (SELECT event_type, mn, mx, CAST(t.b AS INTEGER) AS bin FROM r CROSS JOIN range(30) t(b))
SELECT g.event_type, g.bin, {rnd('mn + bin * (mx - mn) / 30')} AS lo, {rnd('mn + (bin + 1) * (mx - mn) / 30')} AS hi,
       COALESCE(c.n, 0) AS n
FROM g LEFT JOIN c USING (event_type, bin)
"""

SQL["box_stats"] = f"""
WITH d AS (SELECT event_type, value AS x FROM events WHERE value IS NOT NULL),
q AS (SELECT event_type, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median,
             quantile_cont(x, 0.75) AS q3 FROM d GROUP BY event_type),
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo_fence, q3 + 1.5 * (q3 - q1) AS hi_fence FROM q),
a AS (
  SELECT d.event_type,
    MIN(x) FILTER (WHERE x >= lo_fence AND x <= hi_fence) AS whisker_lo,
    MAX(x) FILTER (WHERE x >= lo_fence AND x <= hi_fence) AS whisker_hi,
    COUNT(*) FILTER (WHERE NOT (x >= lo_fence AND x <= hi_fence)) AS n_outliers,
    COUNT(*) AS n
  FROM d JOIN f USING (event_type) GROUP BY d.event_type)
SELECT f.event_type, a.n, {rnd('q1')} AS q1, {rnd('median')} AS median, {rnd('q3')} AS q3, {rnd('iqr')} AS iqr,
       {rnd('whisker_lo')} AS whisker_lo, {rnd('whisker_hi')} AS whisker_hi, a.n_outliers
FROM f JOIN a USING (event_type)
"""

SQL["top_bottom"] = f"""
WITH s AS (SELECT o_custkey, SUM(o_totalprice) AS spend FROM orders GROUP BY o_custkey)
(SELECT 'top' AS side, o_custkey, {rnd('spend')} AS spend FROM s ORDER BY spend DESC, o_custkey LIMIT 25)
UNION ALL
(SELECT 'bottom' AS side, o_custkey, {rnd('spend')} AS spend FROM s WHERE spend IS NOT NULL
 ORDER BY spend ASC, o_custkey LIMIT 10)
"""

SQL["first_non_null"] = _with(EVENTS_LONG_CTE, f"""
SELECT user_id, {rnd('arg_min(value, event_id) FILTER (WHERE value IS NOT NULL)')} AS value,
       {rnd('arg_min(click_value, event_id) FILTER (WHERE click_value IS NOT NULL)')} AS click_value
FROM el GROUP BY user_id
""")

SQL["scatter_pairs"] = _with(EVENTS_LONG_CTE, f"""
SELECT event_id, {rnd('value')} AS value, {rnd('click_value')} AS click_value FROM el
WHERE value IS NOT NULL AND click_value IS NOT NULL
""")

SQL["grain_check"] = """
SELECT COUNT(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS n_urgent,
       COUNT(*) FILTER (WHERE o_orderstatus = 'O') AS n_open,
       (SELECT MAX(c) FROM (SELECT COUNT(*) AS c FROM lineitem GROUP BY l_orderkey)) AS max_lines_per_order,
       (SELECT MAX(c) FROM (SELECT COUNT(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber)) AS max_key_group,
       COUNT(DISTINCT o_custkey) AS n_customers,
       (SELECT COUNT(*) FROM (SELECT DISTINCT o_custkey, o_orderstatus FROM orders)) AS n_cust_status,
       MIN(o_orderdate) AS min_orderdate, MAX(o_orderdate) AS max_orderdate
FROM orders
"""

SQL["top_groups"] = """
SELECT l_suppkey, COUNT(*) AS n FROM lineitem GROUP BY l_suppkey ORDER BY n DESC, l_suppkey NULLS FIRST LIMIT 3
"""

SQL["report_pivot"] = f"""
WITH c AS (SELECT l_returnflag, l_linestatus, AVG(l_quantity) AS avg_qty FROM lineitem GROUP BY 1, 2)
SELECT l_returnflag, {rnd("MAX(avg_qty) FILTER (WHERE l_linestatus = 'O')")} AS "O",
       {rnd("MAX(avg_qty) FILTER (WHERE l_linestatus = 'F')")} AS "F"
FROM c GROUP BY l_returnflag
"""

SQL["report_unpivot"] = f"""
WITH d AS ({_describe_rows('lineitem', _LINE_NUM)})
SELECT "column", stat, value FROM d UNPIVOT (value FOR stat IN (mean, std, min, p25, p50, p75, max))
"""

SQL["cumulative_share"] = f"""
WITH r AS (SELECT p_brand, SUM(l_extendedprice * (1 - l_discount)) AS revenue
           FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand),
t AS (SELECT SUM(revenue) AS total FROM r)
SELECT p_brand, {rnd('revenue')} AS revenue, {rnd('revenue / total')} AS share,
       {rnd('SUM(revenue) OVER (ORDER BY revenue DESC, p_brand ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / total')} AS cum_share
FROM r CROSS JOIN t
"""

# ---------------------------------------------------------------- audits (V)

SQL["audit_duplicates"] = """
SELECT (SELECT CAST(COALESCE(SUM(c), 0) AS BIGINT) FROM (SELECT COUNT(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber)
        WHERE c > 1) AS key_dup_rows,
       (SELECT CAST(COALESCE(SUM(c), 0) AS BIGINT) FROM (SELECT COUNT(*) AS c FROM lineitem GROUP BY ALL_COLS) WHERE c > 1)
         AS full_dup_rows
""".replace(
    "ALL_COLS",
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus, l_shipdate",
)


def _empty(c: str, text: bool = True) -> str:
    return f"({c} IS NULL OR regexp_matches({c}, '^\\s*$'))" if text else f"({c} IS NULL)"


SQL["audit_empty"] = _with(EVENTS_LONG_CTE, f"""
SELECT COUNT(*) FILTER (WHERE {_empty('Season')} AND {_empty('purchase_props')} AND empty_measure IS NULL)
         AS n_empty_rows,
       COUNT(*) AS n_rows
FROM el
""")

_LI_ALL = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
           "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def _sev(expr: str) -> str:
    return f"CASE WHEN {expr} > 0 THEN 'issue' ELSE 'ok' END"


def _dups(table: str, keys, where: str = "TRUE") -> str:
    return (f"(SELECT CAST(COALESCE(SUM(c), 0) AS BIGINT) FROM (SELECT COUNT(*) AS c FROM {table} WHERE {where} "
            f"GROUP BY {', '.join(keys)}) WHERE c > 1)")


def _empty_all(cols_text, cols_other) -> str:
    parts = [_empty(c) for c in cols_text] + [f"{c} IS NULL" for c in cols_other]
    return " AND ".join(parts)


SQL["audit_tables"] = _with(EVENTS_LONG_CTE, f"""
SELECT 'lineitem' AS "table", 'row_count' AS "check", CASE WHEN COUNT(*) = 0 THEN 'issue' ELSE 'ok' END AS severity,
       COUNT(*) AS n_rows, CAST(NULL AS VARCHAR) AS detail FROM lineitem
UNION ALL
SELECT 'lineitem', 'empty_rows', {_sev('COUNT(*) FILTER (WHERE ' + _empty_all(['l_returnflag', 'l_linestatus'], [c for c in _LI_ALL if c not in ('l_returnflag', 'l_linestatus')]) + ')')},
       COUNT(*) FILTER (WHERE {_empty_all(['l_returnflag', 'l_linestatus'], [c for c in _LI_ALL if c not in ('l_returnflag', 'l_linestatus')])}), NULL FROM lineitem
UNION ALL
SELECT 'lineitem', 'key_duplicates', {_sev(_dups('lineitem', ['l_orderkey', 'l_linenumber']))},
       {_dups('lineitem', ['l_orderkey', 'l_linenumber'])}, 'l_orderkey,l_linenumber'
UNION ALL
SELECT 'events_long', 'row_count', CASE WHEN COUNT(*) = 0 THEN 'issue' ELSE 'ok' END, COUNT(*), NULL FROM el
UNION ALL
SELECT 'events_long', 'empty_rows', {_sev('COUNT(*) FILTER (WHERE ' + _empty_all(['table_id', 'Season', 'purchase_props'], ['event_id', 'user_id', 'value', 'click_value', 'empty_measure']) + ')')},
       COUNT(*) FILTER (WHERE {_empty_all(['table_id', 'Season', 'purchase_props'], ['event_id', 'user_id', 'value', 'click_value', 'empty_measure'])}), NULL FROM el
UNION ALL
SELECT 'events_long', 'key_duplicates', {_sev(_dups('el', ['user_id', 'table_id', 'Season'], 'Season IS NOT NULL'))},
       {_dups('el', ['user_id', 'table_id', 'Season'], 'Season IS NOT NULL')}, 'user_id,table_id,Season'
UNION ALL
SELECT 'events_long', 'full_row_duplicates', {_sev(_dups('el', _EL_COLS, 'Season IS NOT NULL'))},
       {_dups('el', _EL_COLS, 'Season IS NOT NULL')}, NULL
""")

_DOC_PROF = """
prof AS (
  SELECT d.doc_id, d.source, d.lang, l.quality,
         CASE WHEN l.toxic = 1 THEN 'error' ELSE 'ok' END AS status
  FROM documents d LEFT JOIN labels l USING (doc_id))
"""

SQL["readiness"] = _with(_DOC_PROF, """
, k AS (
  SELECT
    (SELECT COUNT(*) FROM prof WHERE status IS DISTINCT FROM 'ok') AS bad_status,
    (SELECT COUNT(DISTINCT doc_id) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM prof)) AS ids_not_profiled,
    (SELECT COUNT(DISTINCT doc_id) FROM prof WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS profiles_not_listed,
    (SELECT abs((SELECT COUNT(*) FROM prof WHERE lang <> 'es') - (SELECT COUNT(*) FROM prof))) AS crosswalk_count_gap,
    (SELECT CASE WHEN COUNT(*) > 0 AND (SELECT COUNT(*) FROM prof WHERE status IS DISTINCT FROM 'ok') = 0
                 THEN COUNT(*) ELSE 0 END FROM prof WHERE status = 'error') AS stale_failures,
    (SELECT COUNT(DISTINCT source) FROM documents WHERE lang = 'en' AND source IS NOT NULL AND source NOT IN (
        SELECT d.source FROM documents d JOIN labels l USING (doc_id) WHERE l.quality = 1 AND d.source IS NOT NULL))
      AS mapped_keys_without_rows)
SELECT 'blocking' AS severity, 'bad_status' AS "check", CAST(bad_status AS BIGINT) AS n FROM k
UNION ALL SELECT 'blocking', 'ids_not_profiled', CAST(ids_not_profiled AS BIGINT) FROM k
UNION ALL SELECT 'blocking', 'profiles_not_listed', CAST(profiles_not_listed AS BIGINT) FROM k
UNION ALL SELECT 'blocking', 'crosswalk_count_gap', CAST(crosswalk_count_gap AS BIGINT) FROM k
UNION ALL SELECT 'blocking', 'stale_failures', CAST(stale_failures AS BIGINT) FROM k
UNION ALL SELECT 'warning', 'mapped_keys_without_rows', CAST(mapped_keys_without_rows AS BIGINT) FROM k
""")

_ALL_TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
               "benchmark labels conversations").split()

SQL["summary_counters"] = _with(PANEL_CTE, "SELECT " + ",\n".join(
    [f"(SELECT COUNT(*) FROM {t}) AS n_{t}" for t in _ALL_TABLES]
    + ["(SELECT COUNT(*) FROM panel) AS n_panel_rows",
       "(SELECT COUNT(*) FROM documents d JOIN labels l USING (doc_id) WHERE l.toxic = 1) AS n_error_profiles"]
))

# --------------------------------------------------- panel assembly

_LABEL_RE = "'^[0-9]{4}-[0-9]{2}$'"


def _is_label(c: str) -> str:
    return f"COALESCE(regexp_matches({c}, {_LABEL_RE}), false)"


_DET_COLS = ["Season", "Team", "N", "QTY", "QTY100", "AQ", "MD"]
_DET_TAGS = ["totals", "per100", "advanced"]

ELONG_CTE = f"""
{PANEL_CTE.strip()},
comb2 AS (
  SELECT o_custkey, yr, CAST(COUNT(*) AS VARCHAR) || 'TM' AS stint, MIN(stint) AS pos, SUM(G) AS G, SUM(MP) AS MP,
         SUM(REV) AS REV, SUM(NL) AS NL, SUM(TAXAMT) AS TAXAMT
  FROM stints GROUP BY o_custkey, yr HAVING COUNT(*) >= 2),
advr AS (
  SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS yr, o_orderpriority AS stint,
         AVG(l_quantity) AS AQ, MAX(l_quantity) AS MQ, MAX(l_discount) AS MD
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2, 3),
elong AS (
  SELECT o_custkey AS entity_id, 'totals' AS table_id, {label('yr')} AS Season, stint AS Team, stint AS Pos,
         G, MP, REV, NL, TAXAMT, CAST(NULL AS DOUBLE) AS AQ, CAST(NULL AS DOUBLE) AS MQ, CAST(NULL AS DOUBLE) AS MD
  FROM stints
  UNION ALL
  SELECT o_custkey, 'totals', {label('yr')}, stint, pos, G, MP, REV, NL, TAXAMT, NULL, NULL, NULL FROM comb2
  UNION ALL
  SELECT o_custkey, 'totals', 'Career', 'TOT', NULL, SUM(G), SUM(MP), SUM(REV), SUM(NL), SUM(TAXAMT), NULL, NULL, NULL
  FROM stints GROUP BY o_custkey
  UNION ALL
  SELECT o_custkey, 'advanced', {label('yr')}, stint, NULL, NULL, NULL, NULL, NULL, NULL, AQ, MQ, MD FROM advr)
"""

FULLPANEL_CTE = f"""
{ELONG_CTE.strip()},
cw AS (
  SELECT c_custkey AS entity_id,
         CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE CAST(c_nationkey AS VARCHAR) END AS link_id,
         CASE WHEN c_custkey % 13 = 0 THEN 'unknown' ELSE printf('%d-06-15', 1960 + c_nationkey) END AS birthday,
         CASE WHEN c_acctbal < 0 THEN 'error' ELSE 'ok' END AS status,
         CASE WHEN c_acctbal < 0 THEN 'negative balance' END AS error
  FROM customer),
tot AS (SELECT * FROM elong WHERE table_id = 'totals' AND {_is_label('Season')} AND G IS NOT NULL AND MP IS NOT NULL),
base AS (SELECT tot.*, cw.link_id, cw.birthday, cw.status, cw.error FROM tot LEFT JOIN cw USING (entity_id)),
patch AS (
  SELECT entity_id, Season, AQ, MQ, MD FROM (
    SELECT *, row_number() OVER (PARTITION BY entity_id, Season ORDER BY Team NULLS FIRST) AS rn
    FROM elong WHERE table_id = 'advanced' AND {_is_label('Season')}) WHERE rn = 1),
patched AS (
  SELECT b.* REPLACE (COALESCE(p.AQ, b.AQ) AS AQ, COALESCE(p.MQ, b.MQ) AS MQ, COALESCE(p.MD, b.MD) AS MD)
  FROM base b LEFT JOIN patch p
    ON b.entity_id IS NOT DISTINCT FROM p.entity_id AND b.Season IS NOT DISTINCT FROM p.Season),
dl AS (
  SELECT CAST(s_nationkey AS VARCHAR) AS link_id, CAST(year(l_shipdate) AS INTEGER) AS yr, COUNT(*) AS N,
         SUM(l_quantity) AS QTY, AVG(l_quantity) AS AQ, MAX(l_discount) AS MD
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2),
dc AS (SELECT link_id, SUM(N) AS N, SUM(QTY) AS QTY, MAX(MD) AS MD FROM dl GROUP BY link_id),
det AS (
  SELECT link_id, 'totals' AS table_id, {label('yr')} AS Season, 'T' || link_id AS Team, CAST(N AS DOUBLE) AS N, QTY,
         CAST(NULL AS DOUBLE) AS QTY100, CAST(NULL AS DOUBLE) AS AQ, CAST(NULL AS DOUBLE) AS MD FROM dl
  UNION ALL SELECT link_id, 'per100', {label('yr')}, 'T' || link_id, NULL, NULL, 100.0 * QTY / N, NULL, NULL FROM dl
  UNION ALL SELECT link_id, 'advanced', {label('yr')}, 'T' || link_id, NULL, NULL, NULL, AQ, MD FROM dl
  UNION ALL SELECT link_id, 'totals', 'Career', 'T' || link_id, CAST(N AS DOUBLE), QTY, NULL, NULL, NULL FROM dc
  UNION ALL SELECT link_id, 'per100', 'Career', 'T' || link_id, NULL, NULL, 100.0 * QTY / N, NULL, NULL FROM dc
  UNION ALL SELECT link_id, 'advanced', 'Career', 'T' || link_id, NULL, NULL, NULL, QTY / N, MD FROM dc),
blk AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY table_id, link_id
                                 ORDER BY {y0('Season')} DESC, Season DESC NULLS LAST, Team DESC NULLS LAST) AS rn
    FROM det WHERE link_id IS NOT NULL AND {_is_label('Season')}) WHERE rn = 1),
wide AS (
  SELECT link_id, {', '.join(f"MAX({c}) FILTER (WHERE table_id = '{t}') AS cbb_{t}_{c}" for t in _DET_TAGS for c in _DET_COLS)}
  FROM blk GROUP BY link_id),
fullpanel AS (SELECT patched.*, wide.* EXCLUDE (link_id) FROM patched LEFT JOIN wide USING (link_id))
"""

_PANEL_OUT = ["entity_id", "Season", "Team", "Pos", "G", "MP", "AQ", "MQ", "MD", "link_id", "birthday", "status",
              "cbb_totals_Season", "cbb_totals_N", "cbb_totals_QTY", "cbb_per100_QTY100", "cbb_advanced_AQ",
              "cbb_advanced_MD", "cbb_advanced_Team"]
_PANEL_DOUBLES = {"G", "MP", "AQ", "MQ", "MD", "cbb_totals_N", "cbb_totals_QTY", "cbb_per100_QTY100",
                  "cbb_advanced_AQ", "cbb_advanced_MD"}


def _sel(cols, doubles, src: str = "") -> str:
    pre = f"{src}." if src else ""
    return ", ".join(f"{rnd(pre + c)} AS {c}" if c in doubles else f"{pre}{c}" for c in cols)


# Every shared step is computed once.
SQL["panel_build"] = re.sub(r"(\w+) AS \(\s*SELECT", r"\1 AS MATERIALIZED (SELECT", _with(FULLPANEL_CTE, f"SELECT {_sel(_PANEL_OUT, _PANEL_DOUBLES)} FROM fullpanel"))

_NT_COLS = ["entity_id", "Season", "Team", "Pos", "G", "MP", "REV", "NL", "TAXAMT", "AQ", "MQ", "MD", "Rk"]
_NT_ORDER = ["entity_id"] + sorted(c for c in _NT_COLS if c != "entity_id")

SQL["normalise_tables"] = _with(ELONG_CTE, f"""
, nt AS (
  SELECT * REPLACE (CASE WHEN table_id = 'advanced' AND entity_id % 9 = 0 THEN '  ' ELSE Season END AS Season),
         CASE WHEN Season = 'Career' AND entity_id % 2 = 0 THEN 'Rk' END AS Rk
  FROM elong),
hd AS (SELECT * FROM nt WHERE Rk IS DISTINCT FROM 'Rk' AND table_id IS NOT NULL),
tags AS (SELECT * FROM (VALUES ('totals'), ('per100'), ('advanced')) t(table_id)),
per AS (
  SELECT table_id,
    COUNT(*) FILTER (WHERE Season IS NOT NULL AND trim(Season) NOT IN ('', 'nan')) AS n_rows,
    concat_ws(',', {', '.join(f"CASE WHEN COUNT({c}) > 0 THEN '{c}' END" for c in _NT_ORDER)}) AS columns
  FROM hd GROUP BY table_id)
SELECT tags.table_id, COALESCE(per.n_rows, 0) AS n_rows, per.columns FROM tags LEFT JOIN per USING (table_id)
""")

# -------------------------------------------------------------- cohort (C4)

COHORT_CTE = f"""
{SUMMARY_CTE.strip()},
{FULLPANEL_CTE.strip().replace(PANEL_CTE.strip() + ",", "", 1).strip()},
pded AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY entity_id, Season
                                 ORDER BY COALESCE(regexp_matches(Team, '^[0-9]+TM$'), false) DESC, Team NULLS FIRST) AS rn
    FROM fullpanel WHERE entity_id IS NOT NULL AND Season IS NOT NULL) WHERE rn = 1),
firstrow AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY Season NULLS FIRST, Team NULLS FIRST) AS rn
    FROM pded) WHERE rn = 1),
based AS (
  SELECT f.*, s.tier, s.entry_cohort, s.composite, s.first_period_start_year
  FROM firstrow f LEFT JOIN summary2 s ON f.entity_id = s.o_custkey),
masked AS (
  SELECT * FROM based WHERE tier = 'D' AND COALESCE(entry_cohort, false) AND link_id IS NOT NULL
    AND length(link_id) > 0 AND composite IS NOT NULL),
cc AS (SELECT * FROM masked WHERE cbb_advanced_AQ IS NOT NULL),
rook AS (
  SELECT entity_id, CASE WHEN tok IN ('1', '2', '3') THEN tok ELSE 'UNK' END AS grp FROM (
    SELECT entity_id, trim(regexp_split_to_array(upper(trim(Pos)), '[-/,]')[1]) AS tok,
           row_number() OVER (PARTITION BY entity_id ORDER BY {y0('Season')}, Season, Team) AS rn
    FROM pded WHERE {y0('Season')} >= 1990) WHERE rn = 1),
cohort AS (
  SELECT cc.*, CAST(cc.first_period_start_year - year(TRY_CAST(birthday AS DATE)) AS DOUBLE) AS debut_age,
         CAST(COALESCE(r.grp, 'UNK') = '2' AS DOUBLE) AS pos_is_2,
         CAST(COALESCE(r.grp, 'UNK') = '3' AS DOUBLE) AS pos_is_3
  FROM cc LEFT JOIN rook r USING (entity_id))
"""

_MODEL_FEATURES = ["debut_age", "pos_is_2", "pos_is_3", "cbb_advanced_AQ", "cbb_advanced_MD",
                   "cbb_totals_QTY", "cbb_per100_QTY100", "AQ", "MD"]

SQL["cohort_mask"] = _with(COHORT_CTE, f"SELECT entity_id, tier, {rnd('composite')} AS composite, link_id FROM masked")

SQL["cohort_frame"] = _with(COHORT_CTE, f"""
SELECT entity_id, Season, tier, {rnd('composite')} AS composite, first_period_start_year,
       {_sel(_MODEL_FEATURES, set(_MODEL_FEATURES))}
FROM cohort
""")

SQL["complete_case"] = _with(COHORT_CTE, f"SELECT entity_id, {rnd('debut_age')} AS debut_age FROM cohort WHERE debut_age IS NOT NULL")

SQL["feature_projection"] = _with(COHORT_CTE, f"""
SELECT entity_id, {_sel(_MODEL_FEATURES, set(_MODEL_FEATURES))}, {rnd('composite')} AS composite FROM cohort
""")

_TEXT_CBB = {"Season", "Team"}
_FEATURE_CANDS = sorted([f"cbb_{t}_{c}" for t in _DET_TAGS for c in _DET_COLS] + ["debut_age", "pos_is_2", "pos_is_3"])


def _num(c: str) -> str:
    if any(c.endswith("_" + t) for t in _TEXT_CBB):
        return (f"(CASE WHEN regexp_matches({c}, '^\\s*[+-]?(([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?)\\s*$') "
                f"THEN TRY_CAST(trim({c}) AS DOUBLE) END)")
    return f"CAST({c} AS DOUBLE)"


SQL["select_features"] = _with(COHORT_CTE, "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, {rnd(f'AVG(CASE WHEN {_num(c)} IS NULL THEN 1.0 ELSE 0.0 END)')} AS missing_share, "
    f"COALESCE(AVG(CASE WHEN {_num(c)} IS NULL THEN 1.0 ELSE 0.0 END) <= 0.5 AND MIN({_num(c)}) < MAX({_num(c)}), false) AS kept "
    f"FROM cohort"
    for c in _FEATURE_CANDS
))

_POS = "trim(regexp_split_to_array(upper(trim(o_orderpriority)), '[-/,]')[1])"

SQL["position_code"] = f"""
SELECT o_orderkey, CASE WHEN {_POS} IN ('1', '2', '3') THEN {_POS} ELSE 'UNK' END AS code FROM orders
"""

SQL["dummies"] = f"""
WITH c AS (SELECT o_orderkey, CASE WHEN {_POS} IN ('1', '2', '3') THEN {_POS} ELSE 'UNK' END AS code FROM orders)
SELECT o_orderkey, CAST(COALESCE(code, 'UNK') = '2' AS DOUBLE) AS pos_is_2,
       CAST(COALESCE(code, 'UNK') = '3' AS DOUBLE) AS pos_is_3
FROM c
"""

SQL["debut_age"] = f"""
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN 'not a date'
                                   ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS birth FROM orders)
SELECT l_orderkey, l_linenumber, {rnd('CAST(year(l_shipdate) - year(TRY_CAST(birth AS DATE)) AS DOUBLE)')} AS age
FROM lineitem JOIN o ON l_orderkey = o.o_orderkey
"""

# ------------------------------------------------------------- modeling (M)


def _thr(share: float) -> str:
    return "'" + format(int(share * (16 ** 32)), "032x") + "'"


def _split(key: str) -> str:
    return f"CASE WHEN md5(CAST({key} AS VARCHAR) || '|42') < {_thr(0.2)} THEN 'test' ELSE 'train' END"


def _fold(key: str) -> str:
    h = f"md5(CAST({key} AS VARCHAR) || '|fold42')"
    return (f"CASE WHEN {h} < {_thr(0.2)} THEN 0 WHEN {h} < {_thr(0.4)} THEN 1 WHEN {h} < {_thr(0.6)} THEN 2 "
            f"WHEN {h} < {_thr(0.8)} THEN 3 ELSE 4 END")


SQL["hash_split"] = f"SELECT {_split('o_orderkey')} AS split, COUNT(*) AS n FROM orders GROUP BY 1"

SQL["kfold_sizes"] = f"SELECT {_fold('o_orderkey')} AS fold, COUNT(*) AS n FROM orders GROUP BY 1"

_IMP = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

SQL["impute_scale"] = f"""
WITH d AS (
  SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice,
         CASE WHEN l_linenumber <> 2 THEN l_discount END AS l_discount,
         CASE WHEN l_orderkey % 5 <> 0 THEN l_tax END AS l_tax,
         {_split("concat_ws('-', l_orderkey, l_linenumber)")} AS split
  FROM lineitem),
med AS (SELECT {', '.join(f'quantile_cont({c}, 0.5) AS m_{c}' for c in _IMP)} FROM d WHERE split = 'train'),
mom AS (SELECT {', '.join(f'AVG(COALESCE({c}, m_{c})) AS a_{c}, STDDEV_POP(COALESCE({c}, m_{c})) AS s_{c}' for c in _IMP)}
        FROM d CROSS JOIN med WHERE split = 'train')
SELECT l_orderkey, l_linenumber,
  {', '.join(rnd(f'(COALESCE({c}, m_{c}) - a_{c}) / (CASE WHEN s_{c} = 0 OR s_{c} IS NULL THEN 1.0 ELSE s_{c} END)') + f' AS {c}' for c in _IMP)}
FROM d CROSS JOIN med CROSS JOIN mom WHERE split = 'test'
"""

SQL["regression_metrics"] = f"""
WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a
           FROM lineitem),
e AS (SELECT l_extendedprice AS y, l_extendedprice - (a + b * l_quantity) AS e FROM lineitem CROSS JOIN f)
SELECT {rnd('sqrt(AVG(e * e))')} AS rmse, {rnd('AVG(abs(e))')} AS mae,
       {rnd('1 - SUM(e * e) / (VAR_POP(y) * COUNT(y))')} AS r2
FROM e
"""

SQL["pca_covariance"] = f"""
WITH t AS (SELECT vec_id, embedding FROM embeddings WHERE {_split('vec_id')} = 'train'),
l AS (SELECT vec_id, r.i - 1 AS i, CAST(embedding[r.i] AS DOUBLE) AS x FROM t CROSS JOIN range(1, 65) r(i)),
s AS (SELECT i, AVG(x) AS m, STDDEV_POP(x) AS sd FROM l GROUP BY i),
z AS (SELECT vec_id, l.i, (x - m) / (CASE WHEN sd = 0 OR sd IS NULL THEN 1.0 ELSE sd END) AS z FROM l JOIN s USING (i))
SELECT printf('b%d_d%02d', a.i // 16, a.i % 16) AS col_a, printf('b%d_d%02d', b.i // 16, b.i % 16) AS col_b,
       {rnd('covar_pop(a.z, b.z)')} AS cov
FROM z a JOIN z b USING (vec_id) GROUP BY a.i, b.i
"""

# ------------------------------------------------------------ pages

SQL["page_comments"] = """
SELECT page_id, CAST(generate_subscripts(arr, 1) - 1 AS INTEGER) AS comment_no, unnest(arr) AS comment
FROM (SELECT page_id, regexp_extract_all(html, '(?s)<!--(.*?)-->', 1) AS arr FROM pages)
"""

SQL["page_links"] = """
SELECT page_id, CAST(generate_subscripts(arr, 1) - 1 AS INTEGER) AS link_no, unnest(arr) AS href
FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS arr FROM pages)
"""

SQL["url_id"] = """
SELECT page_id, NULLIF(regexp_extract(url, '/([a-z]{2})/([0-9]+)', 1), '') AS lang,
       CAST(NULLIF(regexp_extract(url, '/([a-z]{2})/([0-9]+)', 2), '') AS BIGINT) AS num
FROM pages
"""


def _xn(expr: str, pattern: str, group: int = 1) -> str:
    return f"NULLIF(regexp_extract({expr}, '{pattern}', {group}), '')"


_HREF = _xn("html", '<a href="([^"]*)"')
_ROOT = "regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1)"
_DIR = "regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^?#]*/)', 1)"
_SCHEME = "regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)"

SQL["text_fields"] = f"""
SELECT page_id, {_xn('html', '<title>(.*?)</title>')} AS title, {_HREF} AS first_href,
  CASE WHEN regexp_matches({_HREF}, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN {_HREF}
       WHEN starts_with({_HREF}, '//') THEN {_SCHEME} || ':' || {_HREF}
       WHEN starts_with({_HREF}, '/') THEN {_ROOT} || {_HREF}
       ELSE (CASE WHEN {_DIR} = '' THEN {_ROOT} || '/' ELSE {_DIR} END) || {_HREF} END AS abs_href,
  CAST({_xn('html', 'Recruiting Rank:\\s*([0-9]{4})')} AS INTEGER) AS recruiting_year,
  CAST({_xn('html', 'Recruiting Rank:.*?\\(([0-9]+)\\)')} AS INTEGER) AS recruiting_rank,
  CASE WHEN CAST({_xn('html', '\\b([4-7])-([0-9]{1,2})\\b', 2)} AS INTEGER) <= 11
       THEN CAST(CAST({_xn('html', '\\b([4-7])-([0-9]{1,2})\\b', 1)} AS INTEGER) * 12
                 + CAST({_xn('html', '\\b([4-7])-([0-9]{1,2})\\b', 2)} AS INTEGER) AS DOUBLE) END AS height_inches,
  CAST({_xn('html', '(?i)\\b([0-9]{2,3})\\s*lb')} AS DOUBLE) AS weight_lb
FROM pages
"""

SQL["url_template"] = """
WITH s AS (SELECT CAST(MIN(year(o_orderdate)) AS INTEGER) AS lo, CAST(MAX(year(o_orderdate)) AS INTEGER) AS hi FROM orders)
SELECT CAST(r.y AS INTEGER) AS year, printf('https://stats.example.org/leagues/totals_%d.html', r.y) AS url
FROM s CROSS JOIN range(s.lo, s.hi + 1) r(y)
"""

SQL["missing_period_profile"] = _with(EVENTS_LONG_CTE, """
SELECT table_id, COUNT(*) AS n FROM el WHERE Season IS NULL GROUP BY table_id
ORDER BY n DESC, table_id NULLS FIRST LIMIT 3
""")

SQL["profile_report"] = _with(_DOC_PROF, f"""
SELECT 'rows' AS section, 'documents' AS item, CAST(COUNT(*) AS DOUBLE) AS value FROM documents
UNION ALL SELECT 'rows', 'labels', CAST(COUNT(*) AS DOUBLE) FROM labels
UNION ALL SELECT 'missing_pct', 'quality', {rnd('COUNT(*) FILTER (WHERE quality IS NULL) * 100.0 / COUNT(*)')} FROM prof
UNION ALL SELECT 'distinct', 'label_doc_id', CAST(COUNT(DISTINCT doc_id) AS DOUBLE) FROM labels
UNION ALL SELECT 'range', 'order_year_min', CAST(MIN(year(o_orderdate)) AS DOUBLE) FROM orders
UNION ALL SELECT 'range', 'order_year_max', CAST(MAX(year(o_orderdate)) AS DOUBLE) FROM orders
UNION ALL SELECT 'status', status, CAST(COUNT(*) AS DOUBLE) FROM prof GROUP BY status
""")

# ------------------------------------- documented-only outcome variants (spec)

SQL["quartile_label"] = _with(SUMMARY_CTE, f"""
, e AS (SELECT * FROM summary2 WHERE composite IS NOT NULL),
c AS (SELECT quantile_cont(composite, 0.25) AS q25, quantile_cont(composite, 0.75) AS q75 FROM e)
SELECT o_custkey, {rnd('composite')} AS composite,
       CASE WHEN composite >= q75 THEN 'top' WHEN composite <= q25 THEN 'bottom' ELSE 'middle' END AS quartile
FROM e CROSS JOIN c
""")

SQL["prime_rate"] = _with(f"{PANEL_CTE.strip()},\n{DEDUP_CTE.strip()}", f"""
, top AS (
  SELECT o_custkey, rate, row_number() OVER (PARTITION BY o_custkey ORDER BY rate DESC, period) AS rk
  FROM rated WHERE q AND rate IS NOT NULL)
SELECT o_custkey, {rnd('AVG(rate)')} AS prime_rate, COUNT(*) AS n_prime FROM top WHERE rk <= 3 GROUP BY o_custkey
""")

SQL["restricted_z"] = _with(SUMMARY_CTE, f"""
, lk AS (SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE CAST(c_nationkey AS VARCHAR) END AS link_id
         FROM customer),
r AS (SELECT s3.* FROM s3 JOIN lk ON s3.o_custkey = lk.c_custkey
      WHERE tier = 'D' AND entry_cohort AND lk.link_id IS NOT NULL),
m AS (SELECT AVG(mean_rate_qual) AS mr, STDDEV_POP(mean_rate_qual) AS sr,
             AVG(ln(1 + games_vs_opportunity)) AS ml, STDDEV_POP(ln(1 + games_vs_opportunity)) AS sl FROM r),
z AS (SELECT o_custkey, (mean_rate_qual - mr) / NULLIF(sr, 0) AS zr,
             (ln(1 + games_vs_opportunity) - ml) / NULLIF(sl, 0) AS zl FROM r CROSS JOIN m)
SELECT o_custkey, {rnd('zr')} AS z_rate_r, {rnd('zl')} AS z_longevity_r, {rnd('0.7 * zr + 0.3 * zl')} AS composite_r
FROM z WHERE 0.7 * zr + 0.3 * zl IS NOT NULL
""")

# ------------------------- pages rendered from orders, read back

_RENDERED = """
WITH o AS (
  SELECT *, 'o' || o_orderkey AS page_id, o_orderkey % 4 AS layout, CAST(year(o_orderdate) AS INTEGER) AS yr
  FROM orders WHERE o_orderkey % 50 <> 49)
"""
_THIS, _LAST = label("yr"), label("(yr - 1)")
_TABLE_ROWS = f"""
SELECT page_id, 'totals' AS table_id, 0 AS row_no, 7 AS n_cells, '1' AS rk, {_THIS} AS season, o_orderpriority AS tm, CAST(o_custkey AS VARCHAR) AS g,
       CAST(o_orderkey AS VARCHAR) AS mp, CAST(o_orderkey + 7 AS VARCHAR) AS mp_1, '.5' AS fgpct,
       CAST(NULL AS VARCHAR) AS per, CAST(NULL AS VARCHAR) AS a_b, CAST(NULL AS VARCHAR) AS a_b_1, CAST(NULL AS VARCHAR) AS gone FROM o
UNION ALL SELECT page_id, 'totals', 1, 7, '2', {_LAST}, o_orderpriority, CAST(o_custkey + 1 AS VARCHAR), NULL,
       CAST(o_orderkey + 8 AS VARCHAR), 'NA-like', NULL, NULL, NULL, NULL FROM o
UNION ALL SELECT page_id, 'advanced', 0, 2, NULL, {_THIS}, NULL, NULL, NULL, NULL, NULL, CAST(o_orderkey % 30 AS VARCHAR), NULL, NULL, NULL FROM o
UNION ALL SELECT page_id, 'shooting', 0, 2, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, o_orderstatus, '<' || o_custkey || '>', NULL FROM o
"""

SQL["page_tables"] = _RENDERED + _TABLE_ROWS

SQL["page_listing"] = _RENDERED + """
SELECT page_id, 0 AS row_no, 'Customer ' || o_custkey AS entity_name, 'c' || o_custkey AS entity_id,
       'https://stats.example.org/players/c/c' || o_custkey || '.html' AS entity_url FROM o
"""

SQL["page_bios"] = _RENDERED + """
SELECT page_id, 'ok' AS status, CAST(NULL AS VARCHAR) AS error, strftime(o_orderdate, '%Y-%m-%d') AS birthday, yr AS recruiting_year,
       CAST(1 + o_custkey % 100 AS INTEGER) AS recruiting_rank, 'https://stats.example.org/cbb/players/p' || o_custkey || '.html' AS profile_url,
       'p' || o_custkey AS profile_id,
       CASE WHEN layout <> 3 AND o_orderkey % 14 <= 11 THEN CAST((4 + o_custkey % 4) * 12 + o_orderkey % 14 AS DOUBLE) END AS height_inches,
       CASE WHEN layout <> 3 THEN CAST(100 + o_orderkey % 200 AS DOUBLE) END AS weight_lb FROM o
UNION ALL SELECT 'o' || o_orderkey, 'error', 'empty page', NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM orders WHERE o_orderkey % 50 = 49
UNION ALL SELECT 'p' || page_id, CASE WHEN html IS NULL THEN 'error' ELSE 'ok' END, CASE WHEN html IS NULL THEN 'empty page' END,
       NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM pages
"""

SQL["pages_panel"] = _RENDERED + f"""
SELECT page_id, {_THIS} AS "Season", o_orderpriority AS "Tm", CAST(o_custkey AS DOUBLE) AS "G", CAST(o_orderkey AS DOUBLE) AS "MP",
       CAST(o_orderkey % 30 AS DOUBLE) AS "PER", 'p' || o_custkey AS profile_id FROM o
"""

SQL["pages_counters"] = _RENDERED + """
SELECT (SELECT COUNT(*) FROM orders) + (SELECT COUNT(*) FROM pages) AS n_pages,
       (SELECT COUNT(*) FROM orders WHERE o_orderkey % 50 = 49) + (SELECT COUNT(*) FROM pages WHERE html IS NULL) AS n_errors,
       COUNT(*) AS n_with_link, COUNT(*) AS n_listing_rows, 4 * COUNT(*) AS n_long_rows, COUNT(*) AS n_panel_rows FROM o
"""

SQL["page_status"] = """
SELECT page_id, CASE WHEN html IS NULL THEN 'error' ELSE 'ok' END AS status,
       CASE WHEN html IS NULL THEN 'empty page' END AS error
FROM pages
"""

# ------------------------------------- closed forms, optimality, PCA on the cohort

_FITS = f"""
d AS (
  SELECT {_fold("concat_ws('-', l_orderkey, l_linenumber)")} AS fold, l_quantity AS x1, l_discount AS x2, l_extendedprice / 1000 AS y FROM lineitem),
fits AS (SELECT CAST(i AS INTEGER) AS fit FROM range(5) r(i)),
m AS (
  SELECT fit, AVG(x1) AS m1, STDDEV_POP(x1) AS s1, AVG(x2) AS m2, STDDEV_POP(x2) AS s2, AVG(y) AS my
  FROM d JOIN fits ON fold <> fit GROUP BY fit),
z AS (
  SELECT fit, fold = fit AS val, (x1 - m1) / s1 AS z1, (x2 - m2) / s2 AS z2, y - my AS y FROM d CROSS JOIN m),
s AS (
  SELECT fit, val, COUNT(*) AS n, SUM(z1 * z1) AS s11, SUM(z1 * z2) AS s12, SUM(z2 * z2) AS s22,
         SUM(z1 * y) AS c1, SUM(z2 * y) AS c2, SUM(y * y) AS yy FROM z GROUP BY fit, val)
"""

# Two standardised columns: (S + alpha I) beta = c by Cramer's rule.
SQL["ridge_two"] = f"""
WITH {_FITS.strip()},
a AS (SELECT CAST(i AS INTEGER) AS step, pow(10, -2 + 5.0 * i / 23) AS alpha FROM range(24) r(i)),
b AS (
  SELECT step, alpha, fit, ((s22 + alpha) * c1 - s12 * c2) / ((s11 + alpha) * (s22 + alpha) - s12 * s12) AS b1,
         ((s11 + alpha) * c2 - s12 * c1) / ((s11 + alpha) * (s22 + alpha) - s12 * s12) AS b2
  FROM s CROSS JOIN a WHERE NOT val),
e AS (
  SELECT step, alpha, sqrt((yy - 2 * (b1 * c1 + b2 * c2) + b1 * b1 * s11 + 2 * b1 * b2 * s12 + b2 * b2 * s22) / n) AS rmse
  FROM b JOIN s USING (fit) WHERE val)
SELECT step, {rnd('alpha')} AS alpha, {rnd('AVG(rmse)')} AS cv_rmse FROM e GROUP BY step, alpha
"""

# One standardised column: the coefficient is the soft-thresholded covariance.
SQL["lasso_one"] = f"""
WITH {_FITS.strip()},
top AS (SELECT abs(covar_pop(x1, y)) / STDDEV_POP(x1) AS amax FROM d),
a AS (SELECT CAST(i AS INTEGER) AS step, amax * pow(10, -3.0 * i / 99) AS alpha FROM top CROSS JOIN range(100) r(i)),
b AS (SELECT step, alpha, fit, sign(c1) * greatest(abs(c1 / n) - alpha, 0) AS b1 FROM s CROSS JOIN a WHERE NOT val),
e AS (SELECT step, alpha, (yy - 2 * b1 * c1 + b1 * b1 * s11) / n AS mse FROM b JOIN s USING (fit) WHERE val)
SELECT step, {rnd('alpha')} AS alpha, {rnd('AVG(mse)')} AS cv_mse FROM e GROUP BY step, alpha
"""

SQL["lasso_checks"] = f"SELECT unnest({_MODEL_FEATURES!r}) AS feature, true AS optimal"

SQL["pca_cohort"] = _with(COHORT_CTE, f"""
, f AS ({" UNION ALL ".join(f"SELECT '{c}' AS feature FROM cohort HAVING AVG(CASE WHEN {_num(c)} IS NULL THEN 1.0 ELSE 0.0 END) <= 0.5 AND MIN({_num(c)}) < MAX({_num(c)})" for c in _FEATURE_CANDS)})
SELECT COUNT(*) AS n_entities, COUNT(*) FILTER (WHERE {_split('entity_id')} = 'train') AS n_train,
       CAST((SELECT COUNT(*) FROM f) AS INTEGER) AS n_features, (SELECT string_agg(feature, ',' ORDER BY feature) FROM f) AS feature_columns,
       true AS ratios_sum_to_one, true AS ratios_fall, true AS smallest_k, true AS loadings_orthonormal, true AS scores_uncorrelated
FROM cohort
""")

SQL["file_round_trip"] = """
SELECT 'orders' AS table_id, CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
       CASE WHEN o_orderkey % 5 <> 0 THEN o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END AS o_orderpriority,
       CAST((SELECT COUNT(*) FROM orders) AS INTEGER) AS n_written, CAST((SELECT COUNT(*) FROM orders) AS INTEGER) AS n_read, 9 AS n_years,
       (SELECT COUNT(DISTINCT o_orderpriority) FROM orders WHERE o_orderkey % 7 <> 0) AS n_priorities, CAST(0 AS BIGINT) AS n_missing
FROM orders
"""

SQL["pages_appearances"] = _RENDERED + """
, first AS (SELECT o_custkey, min(page_id) AS page_id FROM o GROUP BY o_custkey)
SELECT page_id, 0 AS row_no, 'Customer ' || o_custkey AS entity_name, 'c' || o_custkey AS entity_id,
       'https://stats.example.org/players/c/c' || o_custkey || '.html' AS entity_url FROM first
"""

SQL["model_checks"] = _with(COHORT_CTE, f"""
, y AS (SELECT {_split('entity_id')} AS split, COUNT(composite) AS n_rows, VAR_POP(composite) AS v FROM cohort GROUP BY 1)
SELECT model, split, n_rows, {rnd('v')} AS var_outcome, true AS consistent
FROM y CROSS JOIN (SELECT unnest(['ridge', 'lasso_cv', 'random_forest', 'gradient_boosting']) AS model)
""")

# One cut per tree kind and fold: of all cuts of both columns the one of most gain, scored on the rows held out.
# The forest's leaves are means; boosting starts at the mean and takes half of each leaf, shrunk by l2.
SQL["stump_cv"] = f"""
WITH raw AS (
  SELECT {_fold("concat_ws('-', l_orderkey, l_linenumber)")} AS fold, l_quantity AS x1, CASE WHEN l_quantity % 7 <> 0 THEN l_discount END AS x2, l_extendedprice / 1000 AS y FROM lineitem),
fits AS (SELECT CAST(i AS INTEGER) AS fit FROM range(5) r(i)),
med AS (SELECT fit, AVG(y) AS my, quantile_cont(x2, 0.5) AS m2 FROM raw JOIN fits ON fold <> fit GROUP BY fit),
kinds AS (SELECT * FROM (VALUES ('forest', 0.0, 0.0, 1.0), ('boost', 0.0, 1.0, 0.5), ('boost', 1000.0, 1.0, 0.5)) t(kind, l2, centred, rate)),
-- each distinct value of a column, as a cut: rows at most that large go left
vals AS (
  SELECT fit, fold = fit AS val, c, x, COUNT(*) AS n, SUM(y - my) AS s, SUM((y - my) * (y - my)) AS ss, ANY_VALUE(my) AS my
  FROM (SELECT fit, fold, 1 AS c, x1 AS x, y, my FROM raw CROSS JOIN med UNION ALL SELECT fit, fold, 2, COALESCE(x2, m2), y, my FROM raw CROSS JOIN med) GROUP BY ALL),
tot AS (SELECT fit, SUM(n) AS n, SUM(s) AS s FROM vals WHERE NOT val AND c = 1 GROUP BY fit),
cuts AS (
  SELECT fit, c, x, SUM(n) OVER w AS nl, SUM(s) OVER w AS sl FROM vals WHERE NOT val WINDOW w AS (PARTITION BY fit, c ORDER BY x)),
gains AS (
  SELECT kind, l2, rate, centred, cuts.fit, c, x, my, nl, tot.n - nl AS nr, sl + (1 - centred) * my * nl AS gl, tot.s - sl + (1 - centred) * my * (tot.n - nl) AS gr
  FROM cuts JOIN tot USING (fit) JOIN med USING (fit) CROSS JOIN kinds WHERE nl >= 20 AND tot.n - nl >= 20),
best AS (
  SELECT *, row_number() OVER (PARTITION BY kind, l2, fit ORDER BY gl * gl / (nl + l2) + gr * gr / (nr + l2) DESC) AS r FROM gains),
leaf AS (
  SELECT kind, l2, fit, c, x, my, rate * gl / (nl + l2) - (1 - centred) * my AS pl, rate * gr / (nr + l2) - (1 - centred) * my AS pr FROM best WHERE r = 1),
err AS (
  SELECT kind, l2, leaf.fit, SUM(v.ss - 2 * v.s * CASE WHEN v.x <= leaf.x THEN pl ELSE pr END + v.n * pow(CASE WHEN v.x <= leaf.x THEN pl ELSE pr END, 2)) / SUM(v.n) AS mse
  FROM leaf JOIN vals v ON v.fit = leaf.fit AND v.c = leaf.c AND v.val GROUP BY ALL)
SELECT kind, CAST(l2 AS DOUBLE) AS l2, fit AS fold, {rnd("sqrt(mse)")} AS rmse FROM err
"""

SQL["search_checks"] = """
SELECT * FROM (VALUES ('forest', 24, 5, 24, true, true), ('boost', 30, 5, 30, true, true)) t(kind, n_draws, n_folds, n_distinct, in_grid, consistent)
"""

SQL["importance_known"] = """
SELECT * FROM (VALUES ('same', true, false), ('l_discount', false, true), ('l_quantity', false, true)) t(feature, large, "none")
"""

SQL["running_share_lines"] = f"""
WITH l AS (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS line, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem)
SELECT line, cents, {rnd("CAST(SUM(cents) OVER (ORDER BY cents DESC, line ROWS UNBOUNDED PRECEDING) AS DOUBLE) / CAST(SUM(cents) OVER () AS DOUBLE)")} AS cum_share
FROM l
"""

SQL["corr_embedding"] = f"""
WITH e AS (
  SELECT vec_id, CAST(i AS INTEGER) AS i, CASE WHEN (vec_id + i) % 7 <> 0 THEN CAST(embedding[i + 1] AS DOUBLE) END AS v FROM embeddings CROSS JOIN range(64) r(i)),
c AS (SELECT a.i AS a, b.i AS b, corr(a.v, b.v) AS r FROM e a JOIN e b USING (vec_id) GROUP BY a.i, b.i)
SELECT printf('d%02d', a) AS col_a, printf('d%02d', b) AS col_b, {rnd("printf('%.12f', r)")} AS r FROM c
"""

_PROFILED = {"l_quantity": "l_quantity", "l_extendedprice": "l_extendedprice", "l_tax": "CASE WHEN l_orderkey % 5 <> 0 THEN l_tax END", "l_linenumber": "l_linenumber"}
_PROFILE_TOP = "(SELECT regexp_replace(string_agg(v || ':' || n, '|' ORDER BY n DESC, v), '\\\\.0:', ':', 'g') FROM (SELECT CAST({x} AS VARCHAR) AS v, COUNT(*) AS n FROM lineitem WHERE ({x}) IS NOT NULL GROUP BY 1 ORDER BY n DESC, v LIMIT 3))".replace("\\\\", "\\")
SQL["profile_columns"] = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(COUNT(*) AS BIGINT) AS n_rows, CAST(COUNT(*) - COUNT({x}) AS BIGINT) AS n_null, {rnd(f'(COUNT(*) - COUNT({x})) / COUNT(*)')} AS null_share, COUNT(DISTINCT {x}) AS n_distinct, "
    f"{rnd(f'AVG({x})')} AS mean, {rnd(f'STDDEV_SAMP({x})')} AS std, CAST(MIN({x}) AS DOUBLE) AS min, CAST(MAX({x}) AS DOUBLE) AS max, "
    + ("CAST(NULL AS VARCHAR)" if c == "l_extendedprice" else _PROFILE_TOP.format(x=x)) + " AS top_values FROM lineitem"
    for c, x in _PROFILED.items()
) + f""" UNION ALL SELECT 'l_returnflag', COUNT(*), 0, 0.0, COUNT(DISTINCT l_returnflag), NULL, NULL, NULL, NULL, {_PROFILE_TOP.format(x="l_returnflag")} FROM lineitem"""

SQL["file_order"] = """
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderkey % 2 ORDER BY o_orderkey DESC) - 1 AS place FROM orders
"""


def _found(table: str, check: str, count: str, severity: str = "issue", detail: str = "NULL", bad: str | None = None) -> str:
    return f"""SELECT '{table}' AS "table", '{check}' AS "check", CASE WHEN {bad or f'({count}) > 0'} THEN '{severity}' ELSE 'ok' END AS severity, CAST(({count}) AS BIGINT) AS n_rows, CAST({detail} AS VARCHAR) AS detail"""


def _rows_of(table: str) -> str:
    return f"SELECT COUNT(*) FROM {table}"


_TWICE = "(SELECT * FROM customer UNION ALL SELECT * FROM customer WHERE c_custkey % 100 = 0)"
_EL_BLANK = _empty_all(["table_id", "Season", "purchase_props"], ["event_id", "user_id", "value", "click_value", "empty_measure"])
SQL["audit_set"] = _with(EVENTS_LONG_CTE, "\nUNION ALL\n".join([
    *[x for t, name in (("lineitem", "lineitem"), ("orders", "orders"), (_TWICE, "customer"), ("el", "events_long")) for x in (
        _found(name, "row_count", _rows_of(t), bad=f"({_rows_of(t)}) = 0"),
        _found(name, "empty_rows", f"SELECT COUNT(*) FROM el WHERE {_EL_BLANK}" if t == "el" else "0"))],
    _found("nothing", "row_count", "0", bad="true"), _found("nothing", "empty_rows", "0"),
    _found("lineitem", "key_duplicates", _dups("lineitem", ["l_orderkey", "l_linenumber"]), "note", "'l_orderkey,l_linenumber'"),
    _found("lineitem", "key_duplicates", _dups("lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice"]), "issue", "'l_orderkey,l_partkey,l_suppkey,l_extendedprice'"),
    _found("lineitem", "full_row_duplicates", _dups("lineitem", _LI_ALL)),
    _found("orders", "key_duplicates", _dups("orders", ["o_orderkey"]), "issue", "'o_orderkey'"),
    _found("orders", "key_duplicates", _dups("orders", ["o_custkey"], "o_orderstatus = 'P'"), "issue", "'o_custkey'"),
    _found("orders", "key_duplicates", "0", "issue", "'missing columns o_nothing'", bad="true"),
    _found("orders", "full_row_duplicates", _dups("orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"])),
    _found("customer", "key_duplicates", _dups(_TWICE, ["c_custkey"]), "issue", "'c_custkey'"),
    _found("customer", "key_duplicates", _dups(_TWICE, ["c_nationkey"]), "note", "'c_nationkey'"),
    _found("customer", "full_row_duplicates", _dups(_TWICE, ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])),
    _found("events_long", "no_period", "SELECT COUNT(*) FROM el WHERE Season IS NULL", "note", "'Season'"),
    _found("events_long", "key_duplicates", _dups("el", ["user_id", "table_id", "Season"], "Season IS NOT NULL"), "issue", "'user_id,table_id,Season'"),
    _found("nothing", "key_duplicates", "0", detail="'n_nationkey'"), _found("nothing", "full_row_duplicates", "0"),
    _found("gone", "readable", "0", detail="'AnalysisException'", bad="true"),
]))

SQL["refresh_rebuild"] = _with(ELONG_CTE, f"""
SELECT entity_id, COUNT(*) AS n_rows, {rnd("SUM(CASE WHEN entity_id % 5 = 0 THEN 2 ELSE 1 END * G)")} AS games, 0 AS differ, 3 AS commits,
       CAST((SELECT COUNT(*) FROM elong WHERE table_id = 'totals') AS INTEGER) AS n_totals, CAST((SELECT COUNT(*) FROM elong WHERE table_id = 'advanced') AS INTEGER) AS n_advanced
FROM elong WHERE table_id = 'totals' AND Season <> 'Career' AND G IS NOT NULL AND MP IS NOT NULL GROUP BY entity_id
""")

SQL["l1_known"] = f"""
WITH d AS (SELECT l_quantity AS x, l_extendedprice / 1000 + 2 * l_quantity AS y FROM lineitem), c AS (SELECT covar_pop(x, y) / STDDEV_POP(x) AS c FROM d)
SELECT 'l_quantity' AS feature, {rnd("sign(c) * greatest(abs(c) - 1.5, 0)")} AS coefficient FROM c WHERE abs(c) > 1.5
"""

# Covariance [[9v, 3v, 0], [3v, v, 0], [0, 0, 1600]]: eigenvalues 10v, 1600 and 0.
SQL["pca_known_loadings"] = f"""
SELECT feature, pc, {rnd("loading")} AS loading FROM (VALUES
  ('a_qty', 'PC1', 3 / sqrt(10.0)), ('b_qty', 'PC1', 1 / sqrt(10.0)), ('c_side', 'PC1', 0.0), ('a_qty', 'PC2', 0.0), ('b_qty', 'PC2', 0.0), ('c_side', 'PC2', 1.0)) t(feature, pc, loading)
"""

SQL["pca_known_scree"] = f"""
WITH v AS (SELECT 10 * VAR_POP(l_quantity) AS a FROM lineitem)
SELECT pc, CASE pc WHEN 1 THEN {rnd("a / (a + 1600)")} WHEN 2 THEN {rnd("1600 / (a + 1600)")} ELSE 0.0::DOUBLE END AS ratio,
       CASE pc WHEN 1 THEN {rnd("a / (a + 1600)")} ELSE 1.0::DOUBLE END AS cumulative, pc <= 2 AS kept, 0.9::DOUBLE AS target
FROM v CROSS JOIN (SELECT CAST(unnest([1, 2, 3]) AS INTEGER) AS pc)
"""

SQL["pca_known_corr"] = f"""
WITH d AS (SELECT {_split("concat_ws('-', l_orderkey, l_linenumber)")} AS split, l_quantity AS x, l_extendedprice / 1000 AS y FROM lineitem)
SELECT split, 'PC1' AS pc, {rnd("corr(x, y)")} AS r_success FROM d GROUP BY split UNION ALL SELECT DISTINCT split, 'PC2', 0.0::DOUBLE FROM d
"""

SQL["pca_known_top"] = f"""
SELECT * FROM (VALUES ('qty', 'a_qty', {rnd("3 / sqrt(10.0)")}), ('side', 'c_side', 0.0::DOUBLE)) t(base, feature, loading)
"""

SQL["strip_prefix"] = "SELECT p_partkey, CASE p_partkey % 4 WHEN 2 THEN 'x_' ELSE '' END || p_brand AS base FROM part"

SQL["normalise_sinks"] = _with(ELONG_CTE, """
, n AS (SELECT table_id, COUNT(*) AS n FROM elong GROUP BY table_id UNION ALL SELECT 'missing', 0 UNION ALL SELECT 'mapping', COUNT(*) FROM customer WHERE c_custkey % 10 <> 0)
SELECT table_id, n AS n_rows, n AS n_read FROM n WHERE table_id IN ('totals', 'advanced', 'missing', 'mapping')
""")
