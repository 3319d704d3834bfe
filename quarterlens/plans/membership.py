"""Index membership, company ids and the filings core table."""

from __future__ import annotations

import datetime as dt
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterlens.functions import ids
from quarterlens.functions.quarters import (month_label, quarter_label,
                                            quarter_label_bounded, quarter_start)
from quarterlens.operators.enrich import enrich_with_fallback
from quarterlens.operators.joins import bounded_broadcast

QUARTER_END_MONTHS = (3, 6, 9, 12)


def historical_index(snapshots: DataFrame, after: dt.date = dt.date(2018, 12, 31),
                     months: Sequence[int] = QUARTER_END_MONTHS,
                     bounded_years: tuple[int, int] | None = None) -> DataFrame:
    """(quarter, quarter_start, ticker) of the last snapshot of each quarter.

    Snapshots after ``after`` (strict, C3) in the quarter's last month (C4) at the
    quarter's latest date (D4 / E1), distinct (E2). The per-quarter maximum is a
    partial aggregate with one row per quarter - a calendar-bounded table - so it
    is broadcast back; no window puts a whole quarter into one task.
    ``bounded_years`` reproduces the reference's table form (other years -> Unknown).
    """
    s = snapshots.filter(F.col("date") > F.lit(after))
    if bounded_years:
        q = quarter_label_bounded("date", *bounded_years)
        qs = F.when(q != "Unknown", quarter_start("date"))
    else:
        q, qs = quarter_label("date"), quarter_start("date")
    s = ids.fix_tickers(s.select("date", "ticker", q.alias("quarter"), qs.alias("quarter_start")))
    s = s.filter(F.month("date").isin(list(months)))
    # A ticker's latest day in the quarter is a partial aggregate; the quarter's latest day is
    # the maximum over those rows (the same exchange, so the snapshots are scanned once). The key
    # is the quarter's first day: a label's two-digit year is ambiguous.
    last = s.groupBy("quarter", "quarter_start", "ticker").agg(F.max("date").alias("_last"))
    top = last.groupBy(F.col("quarter_start").alias("_qs")).agg(F.max("_last").alias("_max_date"))
    hit = last.join(bounded_broadcast(top), F.col("quarter_start").eqNullSafe(F.col("_qs"))
                    & (F.col("_last") == F.col("_max_date")))
    return hit.select("quarter", "quarter_start", "ticker")


def base_index(index: DataFrame, conversion: DataFrame, patch: DataFrame) -> DataFrame:
    """Index rows with (cik, company_name); incomplete rows take both from ``patch``."""
    conv = conversion.select("ticker", "cik", "company_name")
    fix = patch.select("ticker", ids.pad_cik("cik").alias("cik"), "company_name")
    return enrich_with_fallback(index, conv, fix, "ticker", ["cik", "company_name"])


def core_table(members: DataFrame, filings: DataFrame, conversion: DataFrame) -> DataFrame:
    """Filings -> ticker via cik (left), then inner join with the members of the
    report month on (month label, ticker): the company was an index member that
    month (D1, D3, I2).

    The member side is first reduced to one row per (month, ticker) - first and
    last snapshot date and the number of snapshots - with a partial (map-side)
    aggregate, so a filing matches at most once per ticker. Joining raw snapshots
    would emit every (filing, snapshot) pair of a month: a hot ticker's group
    would grow as the product of both sides.
    """
    f = filings.withColumn("cik", ids.pad_cik("cik"))
    conv = conversion.select(ids.pad_cik("cik").alias("cik"), "ticker", "company_name")
    f = f.join(conv, "cik", "left").withColumn("date_clean", month_label("period"))
    m = ids.fix_tickers(members.select("date", "ticker"))
    m = (m.groupBy(month_label("date").alias("date_clean"), "ticker")
         .agg(F.min("date").alias("first_member_date"), F.max("date").alias("last_member_date"),
              F.count(F.lit(1)).alias("member_snapshots")))
    return f.join(m, ["date_clean", "ticker"], "inner")


def wanted_paths(paths: DataFrame, wanted_ciks: DataFrame, name_col: str = "path") -> DataFrame:
    """Keep paths whose cik (read from the name, compared as a number) is wanted.

    A name without a cik gives null and simply fails the semi join (L26).
    """
    w = wanted_ciks.select(F.col("cik").cast("long").alias("_wanted")).distinct()
    p = paths.withColumn("cik", ids.cik_from_name(F.col(name_col)))
    return p.join(w, p["cik"].cast("long") == w["_wanted"], "left_semi")
