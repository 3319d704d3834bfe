"""Time-of-day and day arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarterlens.functions.util import col_of

MICROS_PER_SECOND = 1_000_000


MICROS_PER_DAY = 86_400 * MICROS_PER_SECOND


def time_of_day_micros(ts) -> Column:
    """Wall-clock microseconds since midnight, from the clock fields (TIMESTAMP: in
    the session time zone; TIMESTAMP_NTZ: as stored). A DST switch does not shift
    the clock reading, as elapsed time since midnight would."""
    ts = col_of(ts)
    hm = (F.hour(ts) * 3600 + F.minute(ts) * 60).cast("long") * MICROS_PER_SECOND
    return hm + (F.date_part(F.lit("SECOND"), ts) * MICROS_PER_SECOND).cast("long")


def wall_clock_micros(ts) -> Column:
    """Microseconds from 1970-01-01 00:00 to the wall-clock reading of ``ts``; for a
    TIMESTAMP_NTZ this is exact and independent of the session time zone."""
    ts = col_of(ts)
    return F.unix_date(F.to_date(ts)).cast("long") * MICROS_PER_DAY + time_of_day_micros(ts)


def time_text(ts) -> Column:
    """``HH:mm:ss`` of a timestamp (display; comparisons use full precision)."""
    return F.date_format(col_of(ts), "HH:mm:ss")


def earnings_session(ts, cutoff: str = "15:00:00", inclusive: bool = True) -> Column:
    """``AMC`` when the time of day is past the cutoff, else ``BMO``; null -> null.

    Rule A of the reference is ``>= 15:00:00``; rule B is ``> 12:00:00``.
    """
    h, m, s = (int(x) for x in cutoff.split(":"))
    limit = F.lit((h * 3600 + m * 60 + s) * MICROS_PER_SECOND)
    tod = time_of_day_micros(ts)
    after = tod >= limit if inclusive else tod > limit
    return F.when(col_of(ts).isNull(), F.lit(None).cast("string")) \
        .when(after, F.lit("AMC")).otherwise(F.lit("BMO"))


def year_between(ts, first: int, last: int) -> Column:
    """C14: inclusive year range."""
    return F.year(col_of(ts)).between(first, last)


def exchange_wall_clock(ts, zone: str = "America/New_York", source_zone: str = "UTC") -> Column:
    """I16: wall-clock time at the exchange (TIMESTAMP_NTZ) of an instant recorded in
    ``source_zone``; session time zone independent."""
    return F.convert_timezone(F.lit(source_zone), F.lit(zone), col_of(ts).cast("timestamp_ntz"))


def day_start(ts, wall_clock: bool = True) -> Column:
    """I16: midnight of the timestamp's day.

    ``wall_clock=True`` for a TIMESTAMP_NTZ (e.g. :func:`exchange_wall_clock`): the
    NTZ midnight of its date, whatever the session time zone (``date_trunc`` would
    first read the value in the session zone). ``False`` for a TIMESTAMP instant:
    midnight in the session time zone.
    """
    ts = col_of(ts)
    return F.to_date(ts).cast("timestamp_ntz") if wall_clock else F.date_trunc("DAY", ts)
