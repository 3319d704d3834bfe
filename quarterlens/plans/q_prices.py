"""Registered price / earnings queries: events (purchases = prices, signups = earnings,
views = lookups) and orders (order totals = quarterly prices) stand in."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from quarterlens.functions.quarters import quarter_label, quarter_start
from quarterlens.functions.timefns import earnings_session
from quarterlens.operators.asof import asof_join
from quarterlens.operators.latest import latest_by
from quarterlens.operators.reshape import wide_to_long
from quarterlens.plans import prices as P
from quarterlens.plans import stand_ins
from quarterlens.plans.q_index import INDEX_SQL, index_of
from quarterlens.plans.registry import register, rounded
from quarterlens.sources.tables import read_table

# DuckDB fragments shared by the oracles.
DC = """dc AS (SELECT ticker, date, close FROM (
    SELECT user_id AS ticker, ts::DATE AS date, value AS close,
           row_number() OVER (PARTITION BY user_id, ts::DATE ORDER BY ts DESC, event_id DESC) AS rn
    FROM events WHERE event_type = 'purchase') WHERE rn = 1)"""
DCO = """dco AS (SELECT ticker, date, close FROM (
    SELECT o_custkey::VARCHAR AS ticker, o_orderdate::DATE AS date, o_totalprice AS close,
           row_number() OVER (PARTITION BY o_custkey, o_orderdate::DATE ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
    FROM orders) WHERE rn = 1)"""
QLAB = "'Q' || quarter({0}) || '-' || strftime({0}, '%y')"


def _daily(spark, sf):
    return P.daily_last(stand_ins.prices(spark, sf), "ticker", "ts", "close", "event_id")


def _signup_dates(spark, sf):
    return stand_ins.earnings(spark, sf).select(
        "event_id", "ticker", F.to_date("earnings_ts").alias("earnings_date"))


@register("asof_tol7", """
WITH l AS (SELECT event_id, user_id AS ticker, ts FROM events WHERE event_type = 'signup'),
r AS (SELECT event_id AS price_event_id, user_id AS ticker, ts AS price_ts, value AS close
      FROM events WHERE event_type = 'purchase' AND value IS NOT NULL),
c AS (SELECT l.event_id, l.ticker, l.ts, r.price_ts, r.close, r.price_event_id,
        row_number() OVER (PARTITION BY l.event_id ORDER BY r.price_ts DESC, r.price_event_id DESC) AS rn
      FROM l LEFT JOIN r ON l.ticker = r.ticker AND r.price_ts <= l.ts AND r.price_ts >= l.ts - INTERVAL 7 DAY)
SELECT event_id, ticker, ts, price_ts, round(close, 6) AS close, price_event_id FROM c WHERE rn = 1""")
def q_asof_tol7(spark, sf):
    """Last price at or before each event, at most 7 days old."""
    left = stand_ins.earnings(spark, sf).select("event_id", "ticker", F.col("earnings_ts").alias("ts"))
    right = stand_ins.prices(spark, sf).filter(F.col("close").isNotNull()).select(
        "ticker", F.col("ts").alias("price_ts"), "close", F.col("event_id").alias("price_event_id"))
    return rounded(asof_join(left, right, ["ticker"], "ts", "price_ts", "backward", True,
                             dt.timedelta(days=7), "price_event_id"))


@register("asof_unbounded", """
WITH l AS (SELECT event_id, user_id AS ticker, ts FROM events WHERE event_type = 'view'),
r AS (SELECT event_id AS earnings_event_id, user_id AS ticker, ts AS earnings_ts FROM events WHERE event_type = 'signup'),
c AS (SELECT l.*, r.earnings_ts, r.earnings_event_id,
        row_number() OVER (PARTITION BY l.event_id ORDER BY r.earnings_ts DESC, r.earnings_event_id DESC) AS rn
      FROM l LEFT JOIN r ON l.ticker = r.ticker AND r.earnings_ts <= l.ts)
SELECT event_id, ticker, ts, earnings_ts, earnings_event_id FROM c WHERE rn = 1""")
def q_asof_unbounded(spark, sf):
    """Latest earnings at or before each lookup, no age limit."""
    left = stand_ins.views(spark, sf)
    right = stand_ins.earnings(spark, sf).select(
        "ticker", "earnings_ts", F.col("event_id").alias("earnings_event_id"))
    return asof_join(left, right, ["ticker"], "ts", "earnings_ts", "backward", True, None,
                     "earnings_event_id")


@register("asof_strict_prev", f"""
WITH {DC},
l AS (SELECT event_id, user_id AS ticker, ts::DATE AS earnings_date FROM events WHERE event_type = 'signup'),
c AS (SELECT l.*, dc.date AS prev_date, dc.close AS prev_close,
        row_number() OVER (PARTITION BY l.event_id ORDER BY dc.date DESC) AS rn
      FROM l LEFT JOIN dc ON dc.ticker = l.ticker AND dc.date < l.earnings_date AND dc.date >= l.earnings_date - 5)
SELECT event_id, ticker, earnings_date, prev_date, round(prev_close, 6) AS prev_close FROM c WHERE rn = 1""")
def q_asof_strict_prev(spark, sf):
    """Close of the nearest earlier day (day itself excluded), up to 5 days back."""
    return rounded(P.close_before(_signup_dates(spark, sf), _daily(spark, sf), "earnings_date", 5, "prev"))


@register("asof_forward", f"""
WITH {DC},
l AS (SELECT event_id, user_id AS ticker, ts::DATE AS earnings_date FROM events WHERE event_type = 'signup'),
c AS (SELECT l.*, dc.date AS price_date, dc.close AS price_close,
        row_number() OVER (PARTITION BY l.event_id ORDER BY dc.date ASC) AS rn
      FROM l LEFT JOIN dc ON dc.ticker = l.ticker AND dc.date >= l.earnings_date AND dc.date <= l.earnings_date + 1)
SELECT event_id, ticker, earnings_date, price_date, round(price_close, 6) AS price_close FROM c WHERE rn = 1""")
def q_asof_forward(spark, sf):
    """Close on the day, else the first within the next day."""
    return rounded(P.close_on_or_after(_signup_dates(spark, sf), _daily(spark, sf), "earnings_date", 1, "price"))


@register("quarter_end_prices", f"""
WITH idx AS ({INDEX_SQL}), {DCO},
q AS (SELECT *, last_day((quarter_start + INTERVAL 2 MONTH)::DATE) AS quarter_end FROM idx),
c AS (SELECT q.*, dco.date AS price_date, dco.close AS q_end_price,
        row_number() OVER (PARTITION BY q.quarter, q.ticker ORDER BY dco.date DESC) AS rn
      FROM q LEFT JOIN dco ON dco.ticker = q.ticker AND dco.date <= q.quarter_end AND dco.date >= q.quarter_end - 7)
SELECT quarter, quarter_start, ticker, quarter_end, price_date, round(q_end_price, 6) AS q_end_price FROM c WHERE rn = 1""")
def q_quarter_end_prices(spark, sf):
    """Each index member's last price in the 7 days up to its quarter end."""
    daily = P.daily_last(stand_ins.order_prices(spark, sf), "ticker", "ts", "close", "event_id")
    return rounded(P.quarter_end_prices(index_of(spark, sf), daily, 7))


def _view_quarters(spark, sf):
    v = stand_ins.views(spark, sf)
    return v.select("ticker", quarter_label("ts").alias("quarter"),
                    quarter_start("ts").alias("quarter_start")).distinct()


VIEW_Q = f"""vq AS (SELECT DISTINCT user_id AS ticker, {QLAB.format('ts')} AS quarter,
                 date_trunc('quarter', ts)::DATE AS quarter_start FROM events WHERE event_type = 'view')"""


@register("earnings_prev_close", f"""
WITH {VIEW_Q}, {DC},
q AS (SELECT *, last_day((quarter_start + INTERVAL 2 MONTH)::DATE) AS quarter_end FROM vq),
ev AS (SELECT user_id AS ticker, ts::DATE AS earnings_date FROM events WHERE event_type = 'signup'),
e AS (SELECT q.*, (SELECT max(ev.earnings_date) FROM ev WHERE ev.ticker = q.ticker AND ev.earnings_date <= q.quarter_end) AS earnings_date FROM q),
c AS (SELECT e.*, dc.date AS prev_date, dc.close AS prev_close,
        row_number() OVER (PARTITION BY e.ticker, e.quarter ORDER BY dc.date DESC) AS rn
      FROM e LEFT JOIN dc ON dc.ticker = e.ticker AND dc.date < e.earnings_date AND dc.date >= e.earnings_date - 5)
SELECT ticker, quarter, quarter_start, quarter_end, earnings_date, prev_date, round(prev_close, 6) AS prev_close
FROM c WHERE rn = 1""")
def q_earnings_prev_close(spark, sf):
    """N9 / D7 + D8: latest earnings up to the quarter end and the close before it."""
    return rounded(P.earnings_prev_close(_view_quarters(spark, sf), stand_ins.earnings(spark, sf),
                                         _daily(spark, sf)))


def _order_events(spark, sf):
    o = read_table(spark, sf, "orders", ["o_custkey", "o_orderdate"])
    return o.select(F.col("o_custkey").cast("string").alias("ticker"),
                    F.col("o_orderdate").alias("earnings_ts"))


ORDER_EVENTS = """ev AS (SELECT o_custkey::VARCHAR AS ticker,
                      date_trunc('quarter', o_orderdate)::DATE AS quarter_start,
                      o_orderdate AS earnings_ts FROM orders)"""


@register("first_in_quarter", f"""
WITH idx AS ({INDEX_SQL}), {ORDER_EVENTS},
f AS (SELECT ticker, quarter_start, min(earnings_ts) AS earnings_ts FROM ev GROUP BY ALL)
SELECT idx.ticker, idx.quarter, idx.quarter_start, f.earnings_ts
FROM idx LEFT JOIN f ON idx.ticker = f.ticker AND idx.quarter_start = f.quarter_start""")
def q_first_in_quarter(spark, sf):
    """Earliest event of each member's quarter (orders as events)."""
    return P.first_event_in_quarter(index_of(spark, sf), _order_events(spark, sf))


@register("dates_in_quarter", f"""
WITH idx AS ({INDEX_SQL}), {ORDER_EVENTS},
f AS (SELECT ticker, quarter_start, string_agg(DISTINCT strftime(earnings_ts, '%Y-%m-%d'), ', '
                               ORDER BY strftime(earnings_ts, '%Y-%m-%d')) AS earnings_dates
      FROM ev GROUP BY ticker, quarter_start)
SELECT idx.ticker, idx.quarter, idx.quarter_start, f.earnings_dates
FROM idx LEFT JOIN f ON idx.ticker = f.ticker AND idx.quarter_start = f.quarter_start""")
def q_dates_in_quarter(spark, sf):
    """All distinct event dates of each member's quarter, ascending, comma-joined."""
    return P.event_dates_in_quarter(index_of(spark, sf), _order_events(spark, sf))


def _cod_sql(date: str, session: str, alias: str = "x") -> str:
    return f"""LEFT JOIN dc b ON b.ticker = {alias}.ticker AND b.date = CASE WHEN {session} = 'AMC' THEN {date} ELSE {date} - 1 END
      LEFT JOIN dc t ON t.ticker = {alias}.ticker AND t.date = CASE WHEN {session} = 'AMC' THEN {date} + 1 ELSE {date} END"""


COD_EXPR = ("round(CASE WHEN session IS NOT NULL THEN round_even((t.close - b.close) / b.close * 100 * 100, 0) / 100 END, 6)")
SESSION_A = ("CASE WHEN {0} IS NULL THEN NULL WHEN date_diff('microsecond', date_trunc('day', {0}), {0}) >= 54000000000 "
             "THEN 'AMC' ELSE 'BMO' END")


@register("change_on_day", f"""
WITH {DC},
x AS (SELECT event_id, user_id AS ticker, ts::DATE AS earnings_date, {SESSION_A.format('ts')} AS session
      FROM events WHERE event_type = 'signup')
SELECT x.event_id, x.ticker, x.earnings_date, x.session, round(b.close, 6) AS base_close,
       round(t.close, 6) AS target_close, {COD_EXPR} AS cod
FROM x {_cod_sql('x.earnings_date', 'x.session')}""")
def q_change_on_day(spark, sf):
    """F2 + I18: change on the earnings day in %, rounded half-to-even to 2 decimals."""
    e = stand_ins.earnings(spark, sf).select(
        "event_id", "ticker", F.to_date("earnings_ts").alias("earnings_date"),
        earnings_session("earnings_ts").alias("session"))
    return rounded(P.change_on_day(e, _daily(spark, sf)))


@register("earnings_features", f"""
WITH {VIEW_Q}, {DC},
ev AS (SELECT user_id AS ticker, date_trunc('quarter', ts)::DATE AS quarter_start, min(ts) AS earnings_ts
       FROM events WHERE event_type = 'signup' GROUP BY ALL),
f AS (SELECT vq.*, ev.earnings_ts FROM vq LEFT JOIN ev ON vq.ticker = ev.ticker AND vq.quarter_start = ev.quarter_start),
g AS (SELECT *, earnings_ts::DATE AS earnings_date, strftime(earnings_ts, '%H:%M:%S') AS earnings_time,
             {SESSION_A.format('earnings_ts')} AS session FROM f),
h AS (SELECT *, CASE WHEN session = 'AMC' THEN earnings_date + 1 WHEN session = 'BMO' THEN earnings_date END AS price_day FROM g),
p AS (SELECT h.*, dc.close AS price_close,
        row_number() OVER (PARTITION BY h.ticker, h.quarter ORDER BY dc.date ASC) AS rn
      FROM h LEFT JOIN dc ON dc.ticker = h.ticker AND dc.date >= h.price_day AND dc.date <= h.price_day + 1),
x AS (SELECT * FROM p WHERE rn = 1),
y AS (SELECT x.*, {COD_EXPR} AS cod FROM x {_cod_sql('x.earnings_date', 'x.session')}),
s AS (SELECT c_custkey AS ticker, c_mktsegment AS sector FROM customer)
SELECT y.ticker, quarter, quarter_start, earnings_date, earnings_time, session,
       round(price_close, 6) AS close_price_earnings, cod, coalesce(s.sector, 'N/A') AS sector
FROM y LEFT JOIN s ON y.ticker = s.ticker""")
def q_earnings_features(spark, sf):
    """First earnings per quarter, session, close used, change on day, sector."""
    return rounded(P.earnings_features(_view_quarters(spark, sf), stand_ins.earnings(spark, sf),
                                       _daily(spark, sf), stand_ins.sectors(spark, sf)))


def quarterly_prices(spark, sf):
    """Per (customer, quarter): the quarter's last order total, as the quarter-end price."""
    p = stand_ins.order_prices(spark, sf)
    q = p.groupBy("ticker", quarter_label("ts").alias("quarter"), quarter_start("ts").alias("quarter_start")) \
         .agg(latest_by(p, "close", "ts", "event_id").alias("q_end_price"))
    return q.select("ticker", "quarter", "quarter_start", "q_end_price")


QOQ_SQL = f"""
WITH o AS (SELECT o_custkey::VARCHAR AS ticker, {QLAB.format('o_orderdate')} AS quarter,
                  date_trunc('quarter', o_orderdate)::DATE AS quarter_start, o_totalprice,
                  row_number() OVER (PARTITION BY o_custkey, date_trunc('quarter', o_orderdate)
                                     ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders),
q AS (SELECT ticker, quarter, quarter_start, o_totalprice AS q_end_price FROM o WHERE rn = 1),
l AS (SELECT *, lag(quarter_start) OVER (PARTITION BY ticker ORDER BY quarter_start) AS ps,
                lag(q_end_price) OVER (PARTITION BY ticker ORDER BY quarter_start) AS pp FROM q),
c AS (SELECT ticker, quarter, quarter_start, q_end_price,
             CASE WHEN ps = (quarter_start - INTERVAL 3 MONTH)::DATE THEN pp END AS prev_price FROM l),
d AS (SELECT *, (q_end_price - prev_price) / prev_price * 100 AS coq_pct FROM c)
SELECT ticker, quarter, quarter_start, round(q_end_price, 6) AS q_end_price, round(prev_price, 6) AS prev_price,
       round(coq_pct, 6) AS coq_pct,
       CASE WHEN coq_pct > 0 THEN 'Up' WHEN coq_pct IS NOT NULL THEN 'Down' END AS up_or_down
FROM d"""


@register("qoq_change", QOQ_SQL)
def q_qoq_change(spark, sf):
    """quarter-over-quarter change against the directly preceding quarter, Up / Down."""
    return rounded(P.quarter_over_quarter(quarterly_prices(spark, sf)))


@register("topk_change", f"""
WITH z AS ({QOQ_SQL})
SELECT * FROM z WHERE coq_pct IS NOT NULL
ORDER BY coq_pct DESC, ticker ASC, quarter_start ASC LIMIT 30""")
def q_topk_change(spark, sf):
    """G2 + G3: the 30 largest quarter-over-quarter gains (unique tie order)."""
    q = P.quarter_over_quarter(quarterly_prices(spark, sf)).filter(F.col("coq_pct").isNotNull())
    return rounded(q.orderBy(F.col("coq_pct").desc(), F.col("ticker").asc(),
                             F.col("quarter_start").asc()).limit(30))


@register("market_cap", f"""
WITH {DCO},
e AS (SELECT o_orderkey AS event_id, o_custkey::VARCHAR AS ticker, o_orderdate::DATE AS date FROM orders
      WHERE year(o_orderdate) BETWEEN 1996 AND 1997),
c AS (SELECT e.*, dco.date AS close_date, dco.close,
        row_number() OVER (PARTITION BY e.event_id ORDER BY dco.date DESC) AS rn
      FROM e LEFT JOIN dco ON dco.ticker = e.ticker AND dco.date <= e.date),
sh AS (SELECT c_custkey::VARCHAR AS ticker, abs(c_acctbal) * 1000 + 1 AS shares_outstanding FROM customer)
SELECT event_id, c.ticker, date, close_date, round(round_even(close * 100, 0) / 100, 6) AS close_price,
       round_even(close * shares_outstanding, 0) AS market_cap
FROM c LEFT JOIN sh ON c.ticker = sh.ticker WHERE rn = 1""")
def q_market_cap(spark, sf):
    """N12 / D9 + C14: market cap at each order of 1996 and 1997 (orders as events; the years
    before and after are left out), from the last close on or before it."""
    p = stand_ins.order_prices(spark, sf)
    daily = P.daily_last(p, "ticker", "ts", "close", "event_id")
    events = p.select("event_id", "ticker", F.col("ts").alias("earnings_ts"))
    shares = stand_ins.company_info(spark, sf).select(F.col("ticker").cast("string").alias("ticker"),
                                                      "shares_outstanding")
    return rounded(P.market_caps(events, daily, shares, 1996, 1997))


@register("latest_cap", """
WITH p AS (SELECT user_id AS ticker, value AS close,
                  row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
           FROM events WHERE event_type = 'purchase'),
l AS (SELECT ticker, close FROM p WHERE rn = 1),
info AS (SELECT c_custkey AS ticker, c_name AS short_name, CASE WHEN c_acctbal > 0 THEN c_name END AS long_name,
                abs(c_acctbal) * 1000 + 1 AS shares_outstanding, c_mktsegment AS sector, n_name AS industry
         FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)
SELECT l.ticker, coalesce(short_name, 'N/A') AS short_name, coalesce(long_name, 'N/A') AS long_name,
       round(round_even(close * 100, 0) / 100, 6) AS latest_price,
       round(round_even(close * shares_outstanding, 0), 6) AS latest_market_cap,
       coalesce(sector, 'N/A') AS sector, coalesce(industry, 'N/A') AS industry
FROM l LEFT JOIN info ON l.ticker = info.ticker""")
def q_latest_cap(spark, sf):
    """Latest price and market cap per ticker with company facts."""
    return rounded(P.latest_caps(stand_ins.prices(spark, sf), stand_ins.company_info(spark, sf)))


# The columns that the oracle SQL spells out; the query takes its series from the data.
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@register("close_matrix", """
WITH d AS (SELECT event_type, ts::DATE AS date, value,
                  row_number() OVER (PARTITION BY event_type, ts::DATE ORDER BY ts DESC, event_id DESC) AS rn
           FROM events),
x AS (SELECT * FROM d WHERE rn = 1)
SELECT date, """ + ", ".join(f"round(max(value) FILTER (WHERE event_type = '{t}'), 6) AS {t}" for t in EVENT_TYPES)
          + " FROM x GROUP BY date")
def q_close_matrix(spark, sf):
    """Long -> wide, one column per series of the data (event types stand in for tickers)."""
    e = read_table(spark, sf, "events", ["event_id", "ts", "event_type", "value"])
    daily = P.daily_last(e, "event_type", "ts", "value", "event_id", value_name="close")
    return rounded(P.close_matrix(daily, ticker_col="event_type"))


@register("wide_to_long", """
WITH d AS (SELECT event_type, ts::DATE AS date, value,
                  row_number() OVER (PARTITION BY event_type, ts::DATE ORDER BY ts DESC, event_id DESC) AS rn
           FROM events)
SELECT date, event_type AS ticker, round(value, 6) AS close FROM d WHERE rn = 1""")
def q_wide_to_long(spark, sf):
    """The wide close matrix back to long (date, series, value) rows."""
    wide = q_close_matrix(spark, sf)
    return rounded(wide_to_long(wide, ["date"], [c for c in wide.columns if c != "date"]))
