"""Sinks: the feed as JSON Lines, and the job error log.

The source returned the whole feed as one text value; at scale that would
pass every document through one place.  Here each document is one line and
every task writes its own part file, so the write is as parallel as the
plan.
"""

from __future__ import annotations

import datetime as dt
import traceback

from pyspark.sql import DataFrame, SparkSession

ERROR_LOG_SCHEMA = "logged_at timestamp, object_name string, error_type string, message string, trace string"


def write_jsonl(docs: DataFrame, path: str, doc_col: str = "doc", mode: str = "overwrite",
                compression: str | None = None) -> None:
    """Write one JSON document per line; one part file per task."""
    w = docs.select(doc_col).write.mode(mode)
    if compression:
        w = w.option("compression", compression)
    w.text(path)


def error_message(exc: BaseException, object_name: str) -> str:
    """The log's message text; its error text has the fixed width of the source's column."""
    return f"ERROR: {type(exc).__name__} OBJECT: {object_name} MESSAGE: {str(exc)[:1000]}"


def append_error(spark: SparkSession, path: str, object_name: str, exc: BaseException) -> None:
    """Append one row to the error-log table (parquet) for a failed job run; the trace is whole."""
    trace = "".join(traceback.format_exception(exc))
    row = [(dt.datetime.now(dt.timezone.utc), object_name, type(exc).__name__,
            error_message(exc, object_name), trace)]
    spark.createDataFrame(row, ERROR_LOG_SCHEMA).write.mode("append").parquet(path)
