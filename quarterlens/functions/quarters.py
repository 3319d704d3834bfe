"""Quarter and month labels.

Labels look like ``Q1-19``. A label alone does not sort chronologically and its
two-digit year is ambiguous, so tables built here carry ``quarter_start`` (DATE)
next to the label; the label is for joins and display.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarterlens.functions.util import col_of


def quarter_label(d) -> Column:
    """``Qn-YY`` of a date or timestamp; null stays null."""
    d = col_of(d)
    return F.concat(F.lit("Q"), F.quarter(d).cast("string"), F.lit("-"),
                    F.date_format(d, "yy"))


def quarter_label_bounded(d, first_year: int = 2019, last_year: int = 2024) -> Column:
    """I1, table form: years outside [first_year, last_year] map to ``Unknown``."""
    d = col_of(d)
    y = F.year(d)
    return (F.when(d.isNull(), F.lit("Unknown"))
            .when(y.between(first_year, last_year), quarter_label(d))
            .otherwise(F.lit("Unknown")))


def quarter_start(d) -> Column:
    """First day of the quarter of ``d`` as DATE."""
    return F.trunc(F.to_date(col_of(d)), "quarter")


def quarter_end(d) -> Column:
    """Last day of the quarter of ``d`` as DATE."""
    return F.last_day(F.add_months(quarter_start(d), 2))


def month_label(d) -> Column:
    """``yyyy-MM``."""
    return F.date_format(col_of(d), "yyyy-MM")


def month_start(d) -> Column:
    """Back to the first of the month."""
    return F.trunc(F.to_date(col_of(d)), "MM")


def _label_parts(label):
    label = col_of(label)
    q = F.regexp_extract(label, r"^Q([1-4])-", 1).try_cast("int")
    yy = F.regexp_extract(label, r"-(\d{2}|\d{4})$", 1)
    return q, yy


def label_year(label, century: int = 2000) -> Column:
    """Year of a label; two digits mean ``century + yy`` (the reference rule is 20YY)."""
    _, yy = _label_parts(label)
    return (F.when(F.length(yy) == 4, yy.try_cast("int"))
            .when(F.length(yy) == 2, F.lit(century) + yy.try_cast("int")))


def label_quarter_start(label, century: int = 2000) -> Column:
    """First day of the quarter named by a label; malformed label gives null."""
    q, _ = _label_parts(label)
    return F.make_date(label_year(label, century), q * 3 - 2, F.lit(1))


def label_quarter_end(label, century: int = 2000) -> Column:
    """Last day of the quarter named by a label."""
    q, _ = _label_parts(label)
    return F.last_day(F.make_date(label_year(label, century), q * 3, F.lit(1)))


def quarter_number(label) -> Column:
    """I4: quarter digit as a string, null when the label has none."""
    return F.nullif(F.regexp_extract(col_of(label), r"Q([1-4])", 1), F.lit(""))


def compose_label(quarter, year) -> Column:
    """``Qn`` + ``-`` + last two digits of the year."""
    y = col_of(year).cast("int").cast("string")
    return F.concat(col_of(quarter), F.lit("-"), F.substring(y, -2, 2))
