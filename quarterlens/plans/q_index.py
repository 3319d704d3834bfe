"""Registered membership / id / dimension queries (orders and customers stand in)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from quarterlens.functions import ids
from quarterlens.operators.enrich import left_dim_with_default, null_tokens, rows_with_nulls
from quarterlens.operators.joins import bounded_broadcast
from quarterlens.operators.partitioning import spread
from quarterlens.plans import membership as M
from quarterlens.plans import stand_ins
from quarterlens.plans.q_calendar import filing_names
from quarterlens.plans.registry import register
from quarterlens.sources.membership_lines import (join_records, parse_membership_lines,
                                                  parse_membership_records)
from quarterlens.sources.tables import read_table
from quarterlens.streaming.incremental import pending

INDEX_AFTER = dt.date(1995, 12, 31)


def _pad(x: str) -> str:
    return f"CASE WHEN length({x}) >= 10 THEN {x} ELSE lpad({x}, 10, '0') END"


INDEX_SQL = """
WITH m AS (SELECT o_orderdate::DATE AS date, o_custkey::VARCHAR AS ticker FROM orders
           WHERE o_orderdate::DATE > DATE '1995-12-31'),
l AS (SELECT date, 'Q' || quarter(date) || '-' || strftime(date, '%y') AS quarter,
             date_trunc('quarter', date)::DATE AS quarter_start,
             CASE ticker WHEN 'BF.B' THEN 'BF-B' WHEN 'BRK.B' THEN 'BRK-B' ELSE ticker END AS ticker
      FROM m WHERE month(date) IN (3, 6, 9, 12)),
mx AS (SELECT quarter_start, max(date) AS max_date FROM l GROUP BY quarter_start)
SELECT DISTINCT l.quarter, l.quarter_start, l.ticker
FROM l JOIN mx ON l.quarter_start = mx.quarter_start AND l.date = mx.max_date"""


def index_of(spark, sf):
    return M.historical_index(stand_ins.membership(spark, sf), after=INDEX_AFTER)


@register("index_snapshot", INDEX_SQL)
def q_index_snapshot(spark, sf):
    """Members at each quarter's last snapshot in the quarter's last month."""
    return index_of(spark, sf)


@register("member_explode", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_linestatus = 'F' AND l_linenumber = 6 THEN NULL
                                 ELSE l_shipdate::DATE END AS date,
       unnest(CASE WHEN l_linenumber = 7 THEN []
                   WHEN l_linenumber = 5 THEN [l_partkey::VARCHAR]
                   WHEN l_returnflag = 'R'
                   THEN [l_partkey::VARCHAR, l_suppkey::VARCHAR, l_orderkey::VARCHAR]
                   ELSE [l_partkey::VARCHAR, l_suppkey::VARCHAR] END) AS ticker
FROM lineitem""")
def q_member_explode(spark, sf):
    """A7 + I13 + I14 + J1: snapshot text lines ``date,"t1,t2[,t3]"`` parsed back to rows.

    One line per line item (two or three listed ids), built and parsed in the scan
    stage: no grouping, so no list is ever collected and nothing is shuffled. By line
    number some lines are unquoted single tickers (5), have an impossible date (6, where
    finished) or no list at all (7).
    """
    li = spread(read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey",
                                                   "l_suppkey", "l_returnflag", "l_linestatus",
                                                   "l_shipdate"]), ["l_orderkey", "l_linenumber"])
    listed = F.concat_ws(",", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"),
                         F.when(F.col("l_returnflag") == "R", F.col("l_orderkey").cast("string")))
    day = F.when((F.col("l_linestatus") == "F") & (F.col("l_linenumber") == 6), F.lit("2019-02-30")) \
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd"))
    tail = F.when(F.col("l_linenumber") == 7, F.lit(" no list")) \
        .when(F.col("l_linenumber") == 5, F.concat(F.lit(","), F.col("l_partkey").cast("string"))) \
        .otherwise(F.concat(F.lit(',"'), listed, F.lit('"')))
    lines = li.select("l_orderkey", "l_linenumber", F.concat(day, tail).alias("value"))
    return parse_membership_lines(lines, "value", keep=("l_orderkey", "l_linenumber"))


_LIST_LINES = """
SELECT o_custkey AS file, o_orderkey, nth,
       CASE WHEN nth = 1 THEN strftime(o_orderdate, '%Y-%m-%d') || ',"' ELSE '' END
       || l_partkey || CASE WHEN nth = n THEN '"' ELSE ',' END AS line
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS nth,
             count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem) l
JOIN orders ON l_orderkey = o_orderkey"""


@register("member_records", f"""
WITH lines AS ({_LIST_LINES}),
files AS (SELECT file, string_agg(line, chr(10) ORDER BY o_orderkey, nth) AS text FROM lines GROUP BY file),
found AS (SELECT file, regexp_extract_all(text, '(\\d{{4}}-\\d{{2}}-\\d{{2}}),"([^"]+)"', 1) AS dates,
                 regexp_extract_all(text, '(\\d{{4}}-\\d{{2}}-\\d{{2}}),"([^"]+)"', 2) AS lists FROM files),
r AS (SELECT file, unnest(dates) AS date, unnest(lists) AS list FROM found)
SELECT file, date::DATE AS date, unnest(string_split(replace(list, chr(10), ''), ',')) AS ticker FROM r""")
def q_member_records(spark, sf):
    """A7 with lists that run over lines and splits: an order is a record of as many lines as it
    has items, a customer's orders are a file, and every third line begins a split."""
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    order = Window.partitionBy("l_orderkey")
    li = li.withColumns({
        "nth": F.row_number().over(order.orderBy("l_linenumber", "l_partkey", "l_suppkey")),
        "n": F.count(F.lit(1)).over(order)})
    line = F.concat(
        F.when(F.col("nth") == 1, F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(',"')))
        .otherwise(""), F.col("l_partkey").cast("string"),
        F.when(F.col("nth") == F.col("n"), '"').otherwise(","))
    lines = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("file"), "o_orderkey", "nth",
        (F.col("o_orderkey") * 10_000 + F.floor(F.col("nth") / 3)).alias("split"),
        line.alias("value")) \
        .repartition("file").sortWithinPartitions("file", "o_orderkey", "nth")
    return parse_membership_records(join_records(lines), keep=("file",))


@register("ticker_fix", """
WITH t AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'BF.B' WHEN 1 THEN 'BRK.B' WHEN 2 THEN 'BRK.B.'
                                    ELSE c_custkey || '.' || c_nationkey END AS raw FROM customer)
SELECT c_custkey, raw, CASE raw WHEN 'BF.B' THEN 'BF-B' WHEN 'BRK.B' THEN 'BRK-B' ELSE raw END AS ticker,
       replace(raw, '.', '-') AS dashed FROM t""")
def q_ticker_fix(spark, sf):
    """The two share-class spellings are rewritten as whole cells, others only look alike."""
    c = read_table(spark, sf, "customer", ["c_custkey", "c_nationkey"])
    raw = F.expr("CASE c_custkey % 4 WHEN 0 THEN 'BF.B' WHEN 1 THEN 'BRK.B' WHEN 2 THEN 'BRK.B.' "
                 "ELSE c_custkey || '.' || c_nationkey END")
    t = c.select("c_custkey", raw.alias("raw"), raw.alias("ticker"))
    return ids.fix_tickers(t).withColumn("dashed", ids.dots_to_dashes("raw"))


def _conversion(spark, sf):
    c = read_table(spark, sf, "customer", ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"])
    return c.select(
        F.col("c_custkey").cast("string").alias("ticker"),
        F.when(F.col("c_acctbal") > 0, ids.pad_cik((F.col("c_custkey") * 7).cast("string"))).alias("cik"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit(None).cast("string"))
        .otherwise(F.col("c_name")).alias("company_name"))


def _patch(spark, sf):
    c = read_table(spark, sf, "customer", ["c_custkey", "c_name", "c_mktsegment"])
    named = F.col("c_mktsegment").isin("BUILDING", "AUTOMOBILE")
    return c.select(
        F.col("c_custkey").cast("string").alias("ticker"),
        F.col("c_custkey").cast("string").alias("cik"),
        F.when(named, F.col("c_name")).alias("company_name"))


@register("enrich_fallback", f"""
WITH idx AS ({INDEX_SQL}),
conv AS (SELECT c_custkey::VARCHAR AS ticker,
                CASE WHEN c_acctbal > 0 THEN {_pad('(c_custkey * 7)::VARCHAR')} END AS cik,
                CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_name END AS company_name
         FROM customer),
patch AS (SELECT c_custkey::VARCHAR AS ticker, {_pad('c_custkey::VARCHAR')} AS cik,
                 CASE WHEN c_mktsegment IN ('BUILDING', 'AUTOMOBILE') THEN c_name END AS company_name
          FROM customer),
j AS (SELECT i.quarter, i.quarter_start, i.ticker, c.cik, c.company_name
      FROM idx i LEFT JOIN conv c ON i.ticker = c.ticker)
SELECT * FROM j WHERE cik IS NOT NULL AND company_name IS NOT NULL
UNION ALL
SELECT j.quarter, j.quarter_start, j.ticker, p.cik, p.company_name
FROM j LEFT JOIN patch p ON j.ticker = p.ticker
WHERE j.cik IS NULL OR j.company_name IS NULL""")
def q_enrich_fallback(spark, sf):
    """N2 / D5 + C10 + H1: ids and names, whole-row fallback to the patch table."""
    return M.base_index(index_of(spark, sf), _conversion(spark, sf), _patch(spark, sf))


@register("core_join", f"""
WITH f AS (SELECT o_orderkey, {_pad('o_custkey::VARCHAR')} AS cik, o_orderdate::DATE AS period FROM orders),
conv AS (SELECT {_pad('c_custkey::VARCHAR')} AS cik, c_custkey::VARCHAR AS ticker, c_name AS company_name FROM customer),
fj AS (SELECT f.*, conv.ticker, conv.company_name, strftime(f.period, '%Y-%m') AS date_clean
       FROM f LEFT JOIN conv ON f.cik = conv.cik),
m AS (SELECT strftime(o_orderdate, '%Y-%m') AS date_clean, o_custkey::VARCHAR AS ticker,
             min(o_orderdate::DATE) AS first_member_date, max(o_orderdate::DATE) AS last_member_date,
             count(*) AS member_snapshots
      FROM orders WHERE o_orderdate::DATE > DATE '1995-12-31' GROUP BY 1, 2)
SELECT fj.date_clean, fj.ticker, fj.o_orderkey, fj.cik, fj.period, fj.company_name,
       m.first_member_date, m.last_member_date, m.member_snapshots
FROM fj JOIN m ON fj.date_clean = m.date_clean AND fj.ticker = m.ticker""")
def q_core_join(spark, sf):
    """Filings joined to the member list of their report month."""
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    filings = o.select("o_orderkey", F.col("o_custkey").cast("string").alias("cik"),
                       F.to_date("o_orderdate").alias("period"))
    c = read_table(spark, sf, "customer", ["c_custkey", "c_name"])
    conv = c.select(F.col("c_custkey").cast("string").alias("cik"),
                    F.col("c_custkey").cast("string").alias("ticker"), F.col("c_name").alias("company_name"))
    members = (o.select(F.to_date("o_orderdate").alias("date"), F.col("o_custkey").cast("string").alias("ticker"))
               .filter(F.col("date") > F.lit(INDEX_AFTER)))
    return M.core_table(members, filings, conv).select(
        "date_clean", "ticker", "o_orderkey", "cik", "period", "company_name",
        "first_member_date", "last_member_date", "member_snapshots")


@register("wanted_semi", """
WITH f AS (SELECT o_orderkey, 'filings/' || year(o_orderdate) || 'q' || quarter(o_orderdate) || '/' ||
   CASE WHEN o_orderstatus = 'P'
        THEN strftime(o_orderdate, '%Y%m%d') || '_10-Q_misc_' || o_orderkey || '.txt'
        ELSE strftime(o_orderdate, '%Y%m%d') || '_' || CASE WHEN o_orderstatus = 'F' THEN '10-K' ELSE '10-Q' END ||
             '_edgar_data_' || o_custkey || '_' || o_orderkey || '.txt' END AS path FROM orders),
g AS (SELECT o_orderkey, path, nullif(regexp_extract(path, 'edgar_data_(\\d+)_', 1), '') AS cik FROM f)
SELECT o_orderkey, path, cik FROM g
WHERE cik::BIGINT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'AUTOMOBILE')""")
def q_wanted_semi(spark, sf):
    """Filing paths of wanted companies (one market segment's customers)."""
    paths = filing_names(spark, sf).select("o_orderkey", "path")
    wanted = (read_table(spark, sf, "customer", ["c_custkey", "c_mktsegment"])
              .filter(F.col("c_mktsegment") == "AUTOMOBILE").select(F.col("c_custkey").alias("cik")))
    return M.wanted_paths(paths, wanted).select("o_orderkey", "path", "cik")


@register("resume_anti", f"""
WITH idx AS ({INDEX_SQL}),
done AS (SELECT DISTINCT quarter_start FROM idx WHERE quarter_start < DATE '1998-01-01')
SELECT * FROM idx WHERE quarter_start NOT IN (SELECT quarter_start FROM done)""")
def q_resume_anti(spark, sf):
    """Quarters already in the master result (before 1998) are skipped."""
    idx = index_of(spark, sf)
    done = idx.filter(F.col("quarter_start") < F.lit(dt.date(1998, 1, 1))).select("quarter_start")
    return pending(idx, done, ["quarter_start"])


def sector_dim(spark, sf):
    """Sector / industry per ticker: market segment and nation; ``None`` text for debtors."""
    c = read_table(spark, sf, "customer", ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"])
    n = read_table(spark, sf, "nation", ["n_nationkey", "n_name"])
    j = c.join(bounded_broadcast(n), c["c_nationkey"] == n["n_nationkey"], "left")
    return j.select(F.col("c_custkey").cast("string").alias("ticker"),
                    F.col("c_mktsegment").alias("sector"),
                    F.when(F.col("c_acctbal") < 0, F.lit("None")).otherwise(F.col("n_name")).alias("industry"))


SECTOR_SQL = """SELECT c_custkey::VARCHAR AS ticker, c_mktsegment AS sector,
  CASE WHEN c_acctbal < 0 THEN 'None' ELSE n_name END AS industry
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"""


@register("left_dim_default", f"""
WITH idx AS ({INDEX_SQL}), s AS ({SECTOR_SQL})
SELECT idx.quarter, idx.quarter_start, idx.ticker,
  coalesce(CASE WHEN s.sector = 'None' THEN NULL ELSE s.sector END, 'N/A') AS sector,
  coalesce(CASE WHEN s.industry = 'None' THEN NULL ELSE s.industry END, 'N/A') AS industry
FROM idx LEFT JOIN s ON idx.ticker = s.ticker""")
def q_left_dim_default(spark, sf):
    """D13 + C11 + C13: sector lookup; ``None`` text and misses become ``N/A``."""
    return left_dim_with_default(index_of(spark, sf), sector_dim(spark, sf), "ticker",
                                 ["sector", "industry"])


@register("missing_report", f"""
WITH s AS ({SECTOR_SQL}),
n AS (SELECT ticker, CASE WHEN sector = 'None' THEN NULL ELSE sector END AS sector,
             CASE WHEN industry = 'None' THEN NULL ELSE industry END AS industry FROM s)
SELECT * FROM n WHERE ticker IS NULL OR sector IS NULL OR industry IS NULL""")
def q_missing_report(spark, sf):
    """N13 / C10 + C11: tickers whose sector or industry is missing."""
    return rows_with_nulls(null_tokens(sector_dim(spark, sf)))


@register("distinct_members", f"""
WITH idx AS ({INDEX_SQL})
SELECT quarter, quarter_start, count(DISTINCT ticker) AS n_tickers FROM idx GROUP BY quarter, quarter_start
ORDER BY quarter_start""")
def q_distinct_members(spark, sf):
    """E3 + G1: distinct members per quarter, in calendar (not label) order."""
    idx = index_of(spark, sf)
    return (idx.groupBy("quarter", "quarter_start").agg(F.count_distinct("ticker").alias("n_tickers"))
            .orderBy("quarter_start"))


@register("sector_map_rows", """
SELECT c_custkey::VARCHAR AS ticker, c_mktsegment AS sector,
       CASE WHEN c_acctbal < 0 THEN 'None' ELSE n_name END AS industry
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
def q_sector_map_rows(spark, sf):
    """A ticker -> {sector, industry} dictionary turned into rows.

    Distributed, the dictionary is a column of single-entry maps (one per row),
    never one map collected per group.
    """
    from quarterlens.operators.reshape import map_to_rows

    d = sector_dim(spark, sf)
    maps = d.select(F.create_map("ticker", F.struct("sector", "industry")).alias("m"))
    return map_to_rows(maps, "m", "ticker", "info")
