"""clickmarts: web-analytics event marts on Spark DataFrames.

Raw, nested GA4-style event exports in; clean events, event-item products,
long-form event parameters, sessions (last-touch and last-non-direct
attribution) and users (first-touch attribution) out.  Every step is a
DataFrame transformation built from ``pyspark.sql.functions``; no Python UDF
runs in any mart.
"""

from clickmarts.config import MartConfig

__all__ = ["MartConfig"]
