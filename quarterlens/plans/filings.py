"""Filing metadata and MD&A extraction jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterlens.functions import ids
from quarterlens.functions.text import with_section
from quarterlens.sources.filings import filings_metadata, read_filings

__all__ = ["read_filings", "filings_metadata", "extract_mda"]


def extract_mda(filings: DataFrame, quarter: str | None = None,
                type_from: str = "path", keep: Sequence[str] = ()) -> DataFrame:
    """(cik, filename, path, management_discussion) for every filing.

    ``quarter`` optionally keeps one quarter (C7; pruned when the input is
    partitioned by quarter). The section rule follows the filing type - read
    from the path (``10-K`` in it, else 10-Q) as the reference does, or from the
    file name. Missing sections are null rows, not dropped rows. ``keep`` names further columns.
    """
    df = filings
    if quarter is not None:
        df = df.filter(F.col("quarter") == quarter)
    ftype = ids.filing_type_from_path("path") if type_from == "path" else \
        F.coalesce(ids.filing_type_from_name("filename"), F.lit("10-Q"))
    df = df.select(ids.cik_from_name("filename").alias("cik"), "filename", "path", *keep,
                   "text")
    return with_section(df, "text", ftype, "management_discussion").drop("text")
