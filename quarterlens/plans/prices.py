"""Prices and earnings aligned to quarters."""

from __future__ import annotations

import datetime as dt
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterlens.functions.numeric import round_half_even
from quarterlens.functions.quarters import quarter_start
from quarterlens.functions.timefns import earnings_session, time_text, year_between
from quarterlens.operators.asof import MAX_GROUP_ROWS, asof_join
from quarterlens.operators.latest import latest_by

DAY = dt.timedelta(days=1)


def daily_last(events: DataFrame, key: str, ts: str, value: str, tie: str,
               date_name: str = "date", value_name: str = "close") -> DataFrame:
    """One value per (key, day): the day's last row by (ts, tie). A mergeable
    hash aggregate, so partial aggregation absorbs a hot key before the shuffle."""
    return (events.groupBy(key, F.to_date(ts).alias(date_name))
            .agg(latest_by(events, value, ts, tie).alias(value_name)))


def with_quarter_end(index: DataFrame) -> DataFrame:
    return index.withColumn("quarter_end", F.last_day(F.add_months("quarter_start", 2)))


def quarter_end_prices(index: DataFrame, daily: DataFrame, days: int = 7) -> DataFrame:
    """Last close in [quarter_end - days, quarter_end]; null closes dropped first.

    Both sides have at most one row per ticker and day (a member per quarter, a close per day), so
    the join's groups are bounded by its bucket of days and need no counting.
    """
    closes = daily.filter(F.col("close").isNotNull()).select(
        "ticker", F.col("date").alias("price_date"), F.col("close").alias("q_end_price"))
    return asof_join(with_quarter_end(index), closes, ["ticker"], "quarter_end", "price_date",
                     "backward", True, dt.timedelta(days=days), max_group_rows=None)


def latest_event_before(left: DataFrame, events: DataFrame, left_date: str,
                        event_date: str = "earnings_date",
                        max_group_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """Latest event date on or before ``left_date`` (unbounded look-back)."""
    ev = events.select("ticker", F.col(event_date))
    return asof_join(left, ev, ["ticker"], left_date, event_date, "backward", True, None,
                     right_tie=event_date, max_group_rows=max_group_rows)


def close_before(left: DataFrame, daily: DataFrame, left_date: str, days: int = 5,
                 prefix: str = "prev", max_group_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """Close of the nearest day strictly before ``left_date``, at most ``days`` back."""
    c = daily.select("ticker", F.col("date").alias(f"{prefix}_date"), F.col("close").alias(f"{prefix}_close"))
    return asof_join(left, c, ["ticker"], left_date, f"{prefix}_date", "backward", False,
                     dt.timedelta(days=days), max_group_rows=max_group_rows)


def close_on_or_after(left: DataFrame, daily: DataFrame, left_date: str, days: int = 1,
                      prefix: str = "price") -> DataFrame:
    """Close on the day, else the first one within ``days`` after it."""
    c = daily.select("ticker", F.col("date").alias(f"{prefix}_date"), F.col("close").alias(f"{prefix}_close"))
    return asof_join(left, c, ["ticker"], left_date, f"{prefix}_date", "forward", True,
                     dt.timedelta(days=days))


def earnings_prev_close(quarterly: DataFrame, earnings: DataFrame, daily: DataFrame) -> DataFrame:
    """Latest earnings date <= quarter end, then the close of the previous trading
    day (up to five calendar days back).

    All sides have at most one row per ticker and day (a member per quarter, the distinct
    earnings dates, a close per day), so the joins' groups need no counting."""
    ev = earnings.select("ticker", F.to_date("earnings_ts").alias("earnings_date")).distinct()
    e = latest_event_before(with_quarter_end(quarterly), ev, "quarter_end", max_group_rows=None)
    return close_before(e, daily, "earnings_date", 5, "prev", max_group_rows=None)


def first_event_in_quarter(index: DataFrame, events: DataFrame, ts: str = "earnings_ts") -> DataFrame:
    """Earliest event of the same (ticker, quarter); left rows kept as they are.

    An equi-join on the first day of the event's quarter (quarters tile the calendar, so no
    range join; a label's two-digit year would be ambiguous), after a partial ``min`` per
    (ticker, quarter). The whole last day of the quarter counts (L31).
    """
    first = (events.groupBy("ticker", quarter_start(ts).alias("quarter_start"))
             .agg(F.min(ts).alias(ts)))
    return index.join(first, ["ticker", "quarter_start"], "left").select(*index.columns, ts)


def event_dates_in_quarter(index: DataFrame, events: DataFrame, ts: str = "earnings_ts") -> DataFrame:
    """All distinct event dates of the quarter, ascending, ``", "``-joined.

    ``collect_set`` runs per (ticker, quarter): at most 92 distinct dates per group.
    """
    dates = (events.groupBy("ticker", quarter_start(ts).alias("quarter_start"))
             .agg(F.array_join(F.sort_array(F.collect_set(F.date_format(ts, "yyyy-MM-dd"))), ", ")
                  .alias("earnings_dates")))
    return index.join(dates, ["ticker", "quarter_start"], "left") \
        .select(*index.columns, "earnings_dates")


def change_on_day(events: DataFrame, daily: DataFrame, date_col: str = "earnings_date",
                  session_col: str = "session") -> DataFrame:
    """change in % around the event, 2 decimals (numpy rounding).

    Before open (BMO): close(d) vs close(d-1); after close (AMC): close(d+1) vs
    close(d). Calendar days: a missing day (weekend) gives null. Two exact-date
    equi-joins, no window.
    """
    amc = F.col(session_col) == "AMC"
    e = events.withColumn("_base_date", F.when(amc, F.col(date_col)).otherwise(F.date_sub(date_col, 1))) \
              .withColumn("_target_date", F.when(amc, F.date_add(date_col, 1)).otherwise(F.col(date_col)))
    base = daily.select("ticker", F.col("date").alias("_base_date"), F.col("close").alias("base_close"))
    target = daily.select("ticker", F.col("date").alias("_target_date"), F.col("close").alias("target_close"))
    j = e.join(base, ["ticker", "_base_date"], "left").join(target, ["ticker", "_target_date"], "left")
    cod = F.try_divide(F.col("target_close") - F.col("base_close"), F.col("base_close")) * 100
    return j.withColumn("cod", F.when(F.col(session_col).isNotNull(), round_half_even(cod, 2))) \
            .drop("_base_date", "_target_date")


def closes_around(events: DataFrame, daily: DataFrame, date_col: str,
                  offsets: Sequence[int]) -> DataFrame:
    """``events`` plus (_has_i, _close_i) of the day ``date_col`` + offsets[i], for each i.

    Each event asks for its few days in one equi-join on (ticker, date), so the daily closes are
    read and shuffled once however many days are needed. Rows equal in every column
    come out once.
    """
    asked = events.withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(len(offsets) - 1))))
    shift = F.element_at(F.array(*map(F.lit, offsets)), F.col("_i") + 1)
    asked = asked.withColumn("_day", F.date_add(date_col, shift))
    c = daily.select(F.col("ticker").alias("_t"), F.col("date").alias("_d"), F.col("close").alias("_c"))
    got = asked.join(c, (F.col("ticker") == F.col("_t")) & (F.col("_day") == F.col("_d")), "left")
    aggs = []
    for i in range(len(offsets)):
        aggs += [F.max((F.col("_i") == i) & F.col("_d").isNotNull()).alias(f"_has_{i}"),
                 F.max(F.when(F.col("_i") == i, F.col("_c"))).alias(f"_close_{i}")]
    return got.groupBy(*events.columns).agg(*aggs)


def earnings_features(index: DataFrame, earnings: DataFrame, daily: DataFrame,
                      sectors: DataFrame, cutoff: str = "15:00:00", inclusive: bool = True) -> DataFrame:
    """First earnings of the quarter, its date / time / session, the close used
    for it (BMO: that day, AMC: the next day, first available within a day), the
    change on day (as :func:`change_on_day`) and the sector (``N/A`` when unknown).

    All closes of an event, from the day before to two days after, come from one join.
    """
    f = first_event_in_quarter(index, earnings)
    f = f.select(*index.columns, F.to_date("earnings_ts").alias("earnings_date"),
                 time_text("earnings_ts").alias("earnings_time"),
                 earnings_session("earnings_ts", cutoff, inclusive).alias("session"))
    f = closes_around(f, daily, "earnings_date", [-1, 0, 1, 2])
    amc = F.col("session") == "AMC"

    def first_of(i: int, j: int) -> Column:
        return F.when(F.col(f"_has_{i}"), F.col(f"_close_{i}")).otherwise(F.col(f"_close_{j}"))

    base = F.when(amc, F.col("_close_1")).otherwise(F.col("_close_0"))
    target = F.when(amc, F.col("_close_2")).otherwise(F.col("_close_1"))
    cod = F.try_divide(target - base, base) * 100
    f = f.withColumn("close_price_earnings", F.when(amc, first_of(2, 3)).otherwise(
        F.when(F.col("session") == "BMO", first_of(1, 2)))) \
        .withColumn("cod", F.when(F.col("session").isNotNull(), round_half_even(cod, 2)))
    return (f.join(sectors.select("ticker", "sector"), "ticker", "left")
            .withColumn("sector", F.coalesce("sector", F.lit("N/A")))
            .select(*index.columns, "earnings_date", "earnings_time", "session",
                    "close_price_earnings", "cod", "sector"))


def quarter_over_quarter(quarterly: DataFrame, price_col: str = "q_end_price") -> DataFrame:
    """F6 (our definition; the reference only consumes the result): change in % against
    the directly preceding quarter and an Up / Down label (Up when the change is
    positive). A gap of more than one quarter gives null.

    The window runs per ticker over quarterly rows, i.e. at most four rows per year
    and ticker, whatever the raw data volume.
    """
    w = Window.partitionBy("ticker").orderBy("quarter_start")
    adjacent = F.lag("quarter_start").over(w) == F.add_months("quarter_start", -3)
    q = quarterly.select("*", F.when(adjacent, F.lag(price_col).over(w)).alias("prev_price"))
    chg = F.try_divide(F.col(price_col) - F.col("prev_price"), F.col("prev_price")) * 100
    return q.select("*", chg.alias("coq_pct"),
                    F.when(chg > 0, "Up").when(chg.isNotNull(), "Down").alias("up_or_down"))


def market_caps(events: DataFrame, daily: DataFrame, shares: DataFrame,
                first_year: int, last_year: int) -> DataFrame:
    """N12 / D9 + C14 + I18: market cap at each event date in the year range, priced
    at the last close on or before it (no close at all -> null)."""
    e = events.filter(year_between("earnings_ts", first_year, last_year)) \
              .select("event_id", "ticker", F.to_date("earnings_ts").alias("date"))
    c = daily.select("ticker", F.col("date").alias("close_date"), "close")
    j = asof_join(e, c, ["ticker"], "date", "close_date", "backward", True, None, "close_date")
    j = j.join(shares, "ticker", "left")
    return j.select("event_id", "ticker", "date", "close_date",
                    round_half_even("close", 2).alias("close_price"),
                    round_half_even(F.col("close") * F.col("shares_outstanding"), 0).alias("market_cap"))


def latest_caps(prices: DataFrame, info: DataFrame) -> DataFrame:
    """Latest close per ticker (ties by the tie column) and market cap; names and
    sector default to ``N/A``."""
    last = prices.groupBy("ticker").agg(latest_by(prices, "close", "ts", "event_id").alias("_close"))
    j = last.join(info, "ticker", "left")
    price = F.col("_close")
    return j.select(
        "ticker",
        F.coalesce("short_name", F.lit("N/A")).alias("short_name"),
        F.coalesce("long_name", F.lit("N/A")).alias("long_name"),
        round_half_even(price, 2).alias("latest_price"),
        round_half_even(price * F.col("shares_outstanding"), 0).alias("latest_market_cap"),
        F.coalesce("sector", F.lit("N/A")).alias("sector"),
        F.coalesce("industry", F.lit("N/A")).alias("industry"))


def close_matrix(daily: DataFrame, tickers: Sequence[str] | None = None,
                 ticker_col: str = "ticker", date_col: str = "date",
                 value_col: str = "close") -> DataFrame:
    """One row per date, one column per ticker.

    Without ``tickers`` every series of the data gets a column (a job finds them; the columns are
    in name order). A list fixes the schema and must cover the data: a series outside of it
    is an error, not a lost column.
    """
    if tickers is None:
        found = daily.select(ticker_col).distinct().orderBy(ticker_col)
        tickers = [r[0] for r in found.collect() if r[0] is not None]
    else:
        known = F.col(ticker_col).isin(list(tickers)) | F.col(ticker_col).isNull()
        daily = daily.withColumn(ticker_col, F.when(known, F.col(ticker_col)).otherwise(
            F.raise_error(F.concat(F.lit("series not listed: "), F.col(ticker_col)))))
    return daily.groupBy(date_col).pivot(ticker_col, list(tickers)).agg(F.first(value_col))
