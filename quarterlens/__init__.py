"""quarterlens: filings, sentiment and price analytics as lazy Spark DataFrame jobs.

Public entry points take and return DataFrames. Nothing here collects row data to
the driver; the only driver round trips are fitted model parameters (a few numbers
per feature) and bounded category lists, exactly like Spark ML estimators.
"""

from quarterlens.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
