"""Latest value per group by (time, tie) as a hash aggregation.

``max(struct(time, tie, value))`` is exact, but Spark keeps struct aggregation
buffers in a sort-based aggregate. Here (time, tie) is packed into one
DECIMAL(38,0) that orders exactly like the pair, and ``max_by(value, key)`` keeps
fixed-width buffers, so both the partial (map-side) and the final aggregation are
hash aggregations; a hot group is absorbed by the partial step before the shuffle.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterlens.functions.timefns import wall_clock_micros

# A bigint tie shifted by 2^63 is in [0, 2^64) < 10^20: the time takes the digits
# above. Time units: days (DATE) or microseconds; |micros| < 10^18 (about years
# -29,000 to 33,000) keeps the key within 38 digits, beyond that ANSI mode raises.
_TIE_SPAN = Decimal(10) ** 20
_TIE_OFFSET = Decimal(2) ** 63
_KEY = "decimal(38,0)"
_UTC_NAMES = {"UTC", "Etc/UTC", "GMT", "Etc/GMT", "Z", "+00:00", "Zulu", "Universal"}


def time_units(df: DataFrame, time: str) -> Column:
    """Days since the epoch (DATE) or microseconds (TIMESTAMP: the instant;
    TIMESTAMP_NTZ: the wall clock, session time zone independent)."""
    t = df.schema[time].dataType
    c = F.col(time)
    if isinstance(t, T.DateType):
        return F.unix_date(c).cast("long")
    if isinstance(t, T.TimestampNTZType):
        zone = df.sparkSession.conf.get("spark.sql.session.timeZone", "")
        if zone in _UTC_NAMES:  # the cast is exact (no offset, no DST) and cheaper
            return F.unix_micros(c.cast("timestamp"))
        return wall_clock_micros(c)
    if isinstance(t, T.TimestampType):
        return F.unix_micros(c)
    raise TypeError(f"{time}: DATE or TIMESTAMP expected, got {t.simpleString()}")


def order_key(df: DataFrame, time: str, tie: str) -> Column:
    """(time, tie) as one DECIMAL(38,0) ordering like the pair. A null tie sorts
    below every tie of the same time; a null time gives a null key (row ignored)."""
    shifted_tie = F.coalesce(F.col(tie).cast(_KEY) + F.lit(_TIE_OFFSET).cast(_KEY), F.lit(0).cast(_KEY))
    return time_units(df, time).cast(_KEY) * F.lit(_TIE_SPAN).cast(_KEY) + shifted_tie


def latest_by(df: DataFrame, value: str, time: str, tie: str) -> Column:
    """Aggregate: ``value`` of the row with the greatest (time, tie) of the group.

    ``tie`` must be an integral column; pass a unique one for a deterministic result.
    """
    if not isinstance(df.schema[tie].dataType, T.IntegralType):
        raise TypeError(f"{tie}: integral tie column expected")
    return F.max_by(F.col(value), order_key(df, time, tie))
