"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarterlens.functions.util import col_of


def round_half_even(c, digits: int = 0) -> Column:
    """Numpy-style rounding of a double: ``rint(x * 10^d) / 10^d``.

    Spark's ``round`` is half-up and ``bround`` works on the decimal form; numpy
    rounds the binary product half-to-even, which ``rint`` reproduces.
    """
    scale = 10.0 ** digits
    x = col_of(c).cast("double")
    return F.rint(x * scale) / scale if digits else F.rint(x)


def percent_text_to_double(c) -> Column:
    """``'12.5%'`` -> 12.5; anything unparsable -> null."""
    return F.replace(col_of(c), F.lit("%"), F.lit("")).try_cast("double")


def up_down_to_label(c) -> Column:
    """Down -> 0, Up -> 1, anything else -> null."""
    c = col_of(c)
    return F.when(c == "Up", F.lit(1)).when(c == "Down", F.lit(0))


def softmax3(a, b, c) -> Column:
    """Softmax of three logits as ``struct<positive, negative, neutral>``.

    Shifted by the maximum for stability; same value as the unshifted formula.
    """
    a, b, c = col_of(a).cast("double"), col_of(b).cast("double"), col_of(c).cast("double")
    m = F.greatest(a, b, c)
    ea, eb, ec = F.exp(a - m), F.exp(b - m), F.exp(c - m)
    z = ea + eb + ec
    return F.struct((ea / z).alias("positive"), (eb / z).alias("negative"),
                    (ec / z).alias("neutral"))
