"""Registered scalar-function queries: quarters, ids, header parsing, labels, sessions."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarterlens.functions import ids, quarters as Q
from quarterlens.functions.numeric import percent_text_to_double, up_down_to_label
from quarterlens.functions.text import header_period, normalise_newlines
from quarterlens.functions.timefns import day_start, earnings_session, exchange_wall_clock, time_text
from quarterlens.operators.partitioning import spread
from quarterlens.plans import stand_ins
from quarterlens.plans.registry import register, rounded
from quarterlens.sources.tables import read_table


@register("quarter_labels", """
WITH d AS (SELECT DISTINCT o_orderdate::DATE AS date FROM orders),
l AS (SELECT date, 'Q' || quarter(date) || '-' || strftime(date, '%y') AS quarter FROM d)
SELECT date, quarter,
  CASE WHEN year(date) BETWEEN 1996 AND 2000 THEN quarter ELSE 'Unknown' END AS quarter_bounded,
  date_trunc('quarter', date)::DATE AS quarter_start,
  strftime(date, '%Y-%m') AS month_label,
  date_trunc('month', date)::DATE AS month_start,
  nullif(regexp_extract(quarter, 'Q([1-4])', 1), '') AS q_num,
  'Q' || quarter(date) || '-' || right(year(date)::VARCHAR, 2) AS quarter_year
FROM l""")
def q_quarter_labels(spark, sf):
    """I1, I2, I4, I5 on every distinct order date."""
    d = read_table(spark, sf, "orders", ["o_orderdate"]).select(
        F.to_date("o_orderdate").alias("date")).distinct()
    lab = d.withColumn("quarter", Q.quarter_label("date"))
    return lab.select(
        "date", "quarter",
        Q.quarter_label_bounded("date", 1996, 2000).alias("quarter_bounded"),
        Q.quarter_start("date").alias("quarter_start"),
        Q.month_label("date").alias("month_label"),
        Q.month_start("date").alias("month_start"),
        Q.quarter_number("quarter").alias("q_num"),
        Q.compose_label(F.concat(F.lit("Q"), F.quarter("date").cast("string")),
                        F.year("date")).alias("quarter_year"))


@register("quarter_bounds", """
WITH l AS (SELECT DISTINCT 'Q' || quarter(o_orderdate) || '-' || strftime(o_orderdate, '%y') AS quarter FROM orders),
p AS (SELECT quarter, regexp_extract(quarter, '^Q([1-4])-', 1)::INTEGER AS q,
             2000 + regexp_extract(quarter, '-(\\d{2})$', 1)::INTEGER AS y FROM l)
SELECT quarter, make_date(y, q * 3 - 2, 1) AS quarter_start,
  last_day(make_date(y, q * 3, 1)) AS quarter_end,
  last_day(make_date(y, q * 3, 1)) - 7 AS window_start,
  last_day(make_date(y, q * 3, 1)) + 1 AS fetch_end
FROM p""")
def q_quarter_bounds(spark, sf):
    """I3 + I17: label -> first / last day (two-digit years read as 20YY, as the
    reference does), and the 7-day look-back window used by quarter-end prices."""
    lab = read_table(spark, sf, "orders", ["o_orderdate"]).select(
        Q.quarter_label("o_orderdate").alias("quarter")).distinct()
    qe = Q.label_quarter_end("quarter")
    return lab.select("quarter", Q.label_quarter_start("quarter").alias("quarter_start"),
                      qe.alias("quarter_end"), F.date_sub(qe, 7).alias("window_start"),
                      F.date_add(qe, 1).alias("fetch_end"))


_FNAME_SPARK = """CASE WHEN o_orderstatus = 'P'
  THEN concat(date_format(o_orderdate, 'yyyyMMdd'), '_10-Q_misc_', o_orderkey, '.txt')
  ELSE concat(date_format(o_orderdate, 'yyyyMMdd'), '_',
              CASE WHEN o_orderstatus = 'F' THEN '10-K' ELSE '10-Q' END,
              '_edgar_data_', o_custkey, '_', o_orderkey, '.txt') END"""
_FNAME_DUCK = """CASE WHEN o_orderstatus = 'P'
  THEN strftime(o_orderdate, '%Y%m%d') || '_10-Q_misc_' || o_orderkey || '.txt'
  ELSE strftime(o_orderdate, '%Y%m%d') || '_' ||
       CASE WHEN o_orderstatus = 'F' THEN '10-K' ELSE '10-Q' END ||
       '_edgar_data_' || o_custkey || '_' || o_orderkey || '.txt' END"""


def filing_names(spark, sf):
    """Filing file names and folder paths derived from orders (one filing per order)."""
    o = spread(read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"]), ["o_orderkey"])
    named = o.select("o_orderkey", "o_custkey", "o_orderdate",
                     F.expr(_FNAME_SPARK).alias("filename"))
    return named.withColumn("path", ids.join_path(
        F.concat(F.lit("filings/"), F.year("o_orderdate"), F.lit("q"), F.quarter("o_orderdate")),
        "filename"))


def _pad_sql(x: str) -> str:
    return f"CASE WHEN length({x}) >= 10 THEN {x} ELSE lpad({x}, 10, '0') END"


@register("cik_pad", f"""
WITH f AS (SELECT o_orderkey, {_FNAME_DUCK} AS filename,
                  'filings/' || year(o_orderdate) || 'q' || quarter(o_orderdate) AS folder
           FROM orders),
g AS (SELECT *, folder || '/' || filename AS path,
             nullif(regexp_extract(filename, 'edgar_data_(\\d+)_', 1), '') AS cik_raw,
             (o_orderkey * 1000000)::VARCHAR AS wide FROM f)
SELECT o_orderkey, filename, path, cik_raw, {_pad_sql('cik_raw')} AS cik,
  {_pad_sql('wide')} AS cik_wide,
  nullif(regexp_extract(filename, '10-[QK]', 0), '') AS filing_type,
  CASE WHEN contains(path, '10-K') THEN '10-K' ELSE '10-Q' END AS path_type,
  string_split(path, '/')[-1] AS base_name
FROM g""")
def q_cik_pad(spark, sf):
    """Cik from the file name, zero-padded to 10 (longer kept whole)."""
    f = filing_names(spark, sf)
    raw = ids.cik_from_name("filename")
    return f.select("o_orderkey", "filename", "path", raw.alias("cik_raw"),
                    ids.pad_cik(raw).alias("cik"),
                    ids.pad_cik((F.col("o_orderkey") * 1000000).cast("string")).alias("cik_wide"),
                    ids.filing_type_from_name("filename").alias("filing_type"),
                    ids.filing_type_from_path("path").alias("path_type"),
                    ids.base_name("path").alias("base_name"))


_HEADER_SPARK = """concat(
  CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN repeat(' ', 5000) ELSE '' END,
  'ACCESSION NUMBER: ', o_orderkey,
  CASE WHEN o_orderstatus = 'O' THEN chr(13) || chr(10) ELSE chr(10) END,
  'CONFORMED PERIOD OF REPORT: ',
  CASE WHEN o_orderpriority = '5-LOW' THEN concat(year(o_orderdate), '1301')
       ELSE date_format(o_orderdate, 'yyyyMMdd') END,
  chr(10), 'FILED AS OF DATE: ', date_format(o_orderdate, 'yyyyMMdd'))"""
_HEADER_DUCK = """
  CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN repeat(' ', 5000) ELSE '' END ||
  'ACCESSION NUMBER: ' || o_orderkey ||
  CASE WHEN o_orderstatus = 'O' THEN chr(13) || chr(10) ELSE chr(10) END ||
  'CONFORMED PERIOD OF REPORT: ' ||
  CASE WHEN o_orderpriority = '5-LOW' THEN year(o_orderdate) || '1301'
       ELSE strftime(o_orderdate, '%Y%m%d') END ||
  chr(10) || 'FILED AS OF DATE: ' || strftime(o_orderdate, '%Y%m%d')"""


@register("period_parse", f"""
WITH h AS (SELECT o_orderkey, replace({_HEADER_DUCK}, chr(13) || chr(10), chr(10)) AS header FROM orders),
p AS (SELECT o_orderkey, try_strptime(nullif(regexp_extract(substr(header, 1, 5000),
        'CONFORMED PERIOD OF REPORT:\\s*(\\d{{8}})', 1), ''), '%Y%m%d')::DATE AS period FROM h)
SELECT o_orderkey, period, 'Q' || quarter(period) || '-' || strftime(period, '%y') AS quarter FROM p""")
def q_period_parse(spark, sf):
    """A2 + I9: report period from the first 5,000 characters; bad or late -> null."""
    o = spread(read_table(spark, sf, "orders", ["o_orderkey", "o_orderstatus", "o_orderpriority", "o_orderdate"]), ["o_orderkey"])
    h = o.select("o_orderkey", normalise_newlines(F.expr(_HEADER_SPARK)).alias("header"))
    p = h.select("o_orderkey", header_period("header").alias("period"))
    return p.select("o_orderkey", "period", Q.quarter_label("period").alias("quarter"))


@register("pct_parse_filter", """
WITH t AS (SELECT l_orderkey, l_linenumber,
    CASE WHEN l_returnflag = 'R' THEN 'n/a%' ELSE ((l_quantity::INTEGER - 25)::VARCHAR || '.5%') END AS coq_text
  FROM lineitem),
p AS (SELECT l_orderkey, l_linenumber, coq_text, TRY_CAST(replace(coq_text, '%', '') AS DOUBLE) AS coq_pct FROM t)
SELECT * FROM p WHERE abs(coq_pct) > 20""")
def q_pct_parse_filter(spark, sf):
    """I11 + C5: percent text -> double, keep |change| > 20."""
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"])
    t = li.select("l_orderkey", "l_linenumber", F.when(F.col("l_returnflag") == "R", F.lit("n/a%"))
                  .otherwise(F.concat((F.col("l_quantity").cast("int") - 25).cast("string"), F.lit(".5%")))
                  .alias("coq_text"))
    p = t.withColumn("coq_pct", percent_text_to_double("coq_text"))
    return p.filter(F.abs("coq_pct") > 20)


@register("label_map", """
WITH t AS (SELECT CASE l_returnflag WHEN 'A' THEN 'Up' WHEN 'R' THEN 'Down' ELSE 'Flat' END AS up_down FROM lineitem),
m AS (SELECT CASE up_down WHEN 'Up' THEN 1 WHEN 'Down' THEN 0 END AS label FROM t),
c AS (SELECT label, count(*) AS n FROM m WHERE label IS NOT NULL GROUP BY label)
SELECT label, n, round(n / sum(n) OVER (), 6) AS share FROM c""")
def q_label_map(spark, sf):
    """I12 + C9 + E4: Up/Down -> 1/0, other -> null and dropped, normalised counts."""
    li = read_table(spark, sf, "lineitem", ["l_returnflag"])
    t = li.select(F.when(F.col("l_returnflag") == "A", "Up").when(F.col("l_returnflag") == "R", "Down")
                  .otherwise("Flat").alias("up_down"))
    m = t.select(up_down_to_label("up_down").alias("label")).dropna(subset=["label"])
    return rounded(value_counts(m, "label"))


def value_counts(df, column: str, normalise: bool = True):
    """Counts per value (nulls excluded, as pandas does) and their share.

    The total is a scalar subquery over the per-value counts: a partial + final
    global sum, whatever the number of distinct values (an unpartitioned window
    would move every group into one task). Spark reuses the counts' shuffle for
    it, so the input is scanned once.
    """
    c = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    if normalise:
        c = c.withColumn("share", F.col("n") / c.agg(F.sum("n")).scalar())
    return c


@register("value_counts_norm", """
WITH c AS (SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1)
SELECT o_orderpriority, n, round(n / sum(n) OVER (), 6) AS share FROM c ORDER BY o_orderpriority""")
def q_value_counts_norm(spark, sf):
    """E4 + G1: normalised value counts, sorted by value."""
    o = read_table(spark, sf, "orders", ["o_orderpriority"])
    return rounded(value_counts(o, "o_orderpriority").orderBy("o_orderpriority"))


def _session_sql(op: str, cutoff_s: int) -> str:
    return f"""
SELECT event_id, user_id AS ticker, ts::DATE AS earnings_date, strftime(ts, '%H:%M:%S') AS earnings_time,
  CASE WHEN ts IS NULL THEN NULL
       WHEN date_diff('microsecond', date_trunc('day', ts), ts) {op} {cutoff_s * 1000000} THEN 'AMC'
       ELSE 'BMO' END AS session
FROM events WHERE event_type = 'signup'"""


def _sessions(spark, sf, cutoff, inclusive):
    e = stand_ins.earnings(spark, sf)
    return e.select("event_id", "ticker", F.to_date("earnings_ts").alias("earnings_date"),
                    time_text("earnings_ts").alias("earnings_time"),
                    earnings_session("earnings_ts", cutoff, inclusive).alias("session"))


@register("session_a", _session_sql(">=", 15 * 3600))
def q_session_a(spark, sf):
    """I15 rule A: at or after 15:00:00 -> AMC (after market close), else BMO."""
    return _sessions(spark, sf, "15:00:00", True)


@register("session_b", _session_sql(">", 12 * 3600))
def q_session_b(spark, sf):
    """I15 rule B: strictly after 12:00:00 -> AMC, else BMO; null time -> null."""
    return _sessions(spark, sf, "12:00:00", False)


@register("session_exchange", """
WITH l AS (SELECT event_id, user_id AS ticker, timezone('America/New_York', timezone('UTC', ts)) AS local_ts
           FROM events WHERE event_type = 'signup')
SELECT event_id, ticker, local_ts, local_ts::DATE AS local_date, date_trunc('day', local_ts) AS local_day_start,
  CASE WHEN local_ts IS NULL THEN NULL
       WHEN date_diff('microsecond', date_trunc('day', local_ts), local_ts) >= 54000000000 THEN 'AMC'
       ELSE 'BMO' END AS session
FROM l""")
def q_session_exchange(spark, sf):
    """I16 + I15: event instants (recorded in UTC) as New York wall clock, the local
    day and its midnight, and the session rule applied to the local time of day."""
    e = stand_ins.earnings(spark, sf)
    local = e.select("event_id", "ticker", exchange_wall_clock("earnings_ts").alias("local_ts"))
    return local.select("event_id", "ticker", "local_ts", F.to_date("local_ts").alias("local_date"),
                        day_start("local_ts").alias("local_day_start"),
                        earnings_session("local_ts", "15:00:00", True).alias("session"))
