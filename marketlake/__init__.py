"""Prediction-market analytics on Spark.

Everything here is DataFrame in, DataFrame out.  Library functions never
collect data to the driver; the only driver-side work is argument checking
and schema inspection (``df.columns``).
"""

__all__ = ["functions", "sources", "operators", "plans", "streaming"]
