"""tidepool: a PySpark-native library for everyday table analytics.

Every operator takes and returns a Spark ``DataFrame`` and is written with
built-in Spark expressions (Catalyst + whole-stage codegen) or ``pyspark.ml``.
Nothing is collected to the driver inside an operator.

Sub-packages
------------
sources    readers: CSV, JSON documents, JDBC, binary/image files, listings, generated rows
sinks      table writes and DDL (overwrite, append, CTAS, external tables, insert-select)
functions  column-expression helpers (strings, dates, numbers)
operators  relational and domain operators (joins, windows, statements, observations, ML, images)
streaming  incremental, duplicate-free loading (batch anti-join and Structured Streaming)
plans      the registered query catalogue (Spark query + DuckDB oracle pairs) and plan checks
"""

from tidepool.session import build_session, scratch_path, load_tables  # noqa: F401

__all__ = ["build_session", "scratch_path", "load_tables"]
