"""Sentiment jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterlens.functions.quarters import compose_label
from quarterlens.operators.sentiment import averages_only, sentiment_stats

__all__ = ["sentiment_stats", "averages_only", "sentiment_export"]


def sentiment_export(stats: DataFrame) -> DataFrame:
    """(ticker, quarter 'Qn', year, net_sentiment) -> (ticker, quarter_year, net_sentiment)."""
    return stats.select("ticker", compose_label("quarter", "year").alias("quarter_year"),
                        "net_sentiment")
