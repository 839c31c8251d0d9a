"""Staged tables of one run: a database of its own in the shared checkpoint folder.

A staged relation is written once and read as often as its branches need it;
a lost executor costs the step that it worked on, not the steps before.
Tables that meet on a key are clustered by it (hash buckets, sorted within
each), so that joining them moves no row.  The database is dropped, files and
all, when the run ends, also when it fails.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir


class Staging:
    """``with Staging(spark) as store: t = store.table("legs", df, by="set_id")``."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.database = f"tessera_stage_{uuid.uuid4().hex}"

    def __enter__(self) -> Staging:
        folder = f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/{self.database}"
        self.spark.sql(f"CREATE DATABASE {self.database} LOCATION '{folder}'")
        return self

    def __exit__(self, *_) -> None:
        self.spark.sql(f"DROP DATABASE IF EXISTS {self.database} CASCADE")

    def table(self, name: str, df: DataFrame, by: str | None = None) -> DataFrame:
        """Write ``df`` as a table of the run and return it as read back; ``by`` clusters it.

        One file a bucket: rows are dealt to tasks as they are to buckets.
        Tables of one run have the same number of buckets.
        """
        full = f"{self.database}.{name}"
        if by is None:
            df.write.format("parquet").saveAsTable(full)
        else:
            n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            df.repartition(n, by).write.format("parquet").bucketBy(n, by).sortBy(by).saveAsTable(full)
        return self.spark.table(full)
