"""streamlens: record-stream analytics on PySpark.

Three record streams (retail transactions, video frames, uploaded files) are
parsed from JSON messages, filtered, enriched with built-in Spark expressions,
summarised per entity and aggregated in tumbling windows.  Every transform is
``f(df, **params) -> DataFrame`` and, unless it is an OVER form, works on both
static and streaming DataFrames.
"""

__version__ = "0.1.0"
