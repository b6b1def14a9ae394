"""Arrivals star-schema analytics on Spark.

Sources are cleaned and typed with native Spark expressions, joined into
one fact table and four dimensions, checked for quality and queried.
Every step is a ``DataFrame -> DataFrame`` function; nothing iterates over
rows on the driver.
"""

__version__ = "0.1.0"
