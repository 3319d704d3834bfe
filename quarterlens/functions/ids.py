"""Company ids, file names and tickers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterlens.functions.util import col_of

# Fixed values that must equal the reference's: file-name patterns and the two
# share-class ticker spellings it rewrites.
CIK_IN_NAME = r"edgar_data_(\d+)_"
CIK_IN_NAME_STRICT = r"_edgar_data_(\d+)_"
FILING_TYPE_IN_NAME = r"10-[QK]"
TICKER_FIXES = {"BF.B": "BF-B", "BRK.B": "BRK-B"}


def pad_cik(c, width: int = 10) -> Column:
    """Left-pad with zeros to ``width``; longer values are kept whole; null stays null."""
    s = col_of(c).cast("string")
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))


def cik_from_name(name, strict: bool = False) -> Column:
    """Digits between ``edgar_data_`` and the next ``_``; null when absent."""
    pat = CIK_IN_NAME_STRICT if strict else CIK_IN_NAME
    return F.nullif(F.regexp_extract(col_of(name), pat, 1), F.lit(""))


def filing_type_from_name(name) -> Column:
    """I8: first ``10-Q`` / ``10-K`` in a file name; null when absent."""
    return F.nullif(F.regexp_extract(col_of(name), FILING_TYPE_IN_NAME, 0), F.lit(""))


def filing_type_from_path(path) -> Column:
    """I8, path form: ``10-K`` when the path contains it, else ``10-Q``."""
    return F.when(col_of(path).contains("10-K"), F.lit("10-K")).otherwise(F.lit("10-Q"))


def base_name(path) -> Column:
    """Last path segment."""
    return F.substring_index(col_of(path), "/", -1)


def join_path(*parts) -> Column:
    """Folder + name."""
    return F.concat_ws("/", *[col_of(p) for p in parts])


def fix_tickers(df: DataFrame, column: str = "ticker") -> DataFrame:
    """Whole-cell rewrite of the fixed share-class spellings."""
    return df.replace(TICKER_FIXES, subset=[column])


def dots_to_dashes(c) -> Column:
    """C12, character form: every ``.`` becomes ``-``."""
    return F.translate(col_of(c), ".", "-")
