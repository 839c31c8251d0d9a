"""Readers for the driver's parquet tables with explicit schemas.

Reading with a declared schema skips footer-based inference on every call and
fails loudly if a file drifts.  Only the columns a plan selects reach the
scan (``ReadSchema``), so the full width here costs nothing.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SCHEMAS: dict[str, str] = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = SCHEMAS.get(name)
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


class NamedTables:
    """Tables by name, of one or more databases, instead of a folder of files.

    ``NamedTables("catalog", {"events": "reviews.events"})`` reads ``events``
    of the database ``reviews`` and every other table of ``catalog``.
    """

    def __init__(self, database: str, elsewhere: dict[str, str] | None = None):
        self.database = database
        self.elsewhere = dict(elsewhere or {})

    def name(self, table: str) -> str:
        return self.elsewhere.get(table, f"{self.database}.{table}")

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        """The declared columns of the table; a ValueError names those that it lacks or has with another type."""
        df = spark.table(self.name(table))
        if table not in SCHEMAS:
            return df
        return df.select(*check_columns(df.schema, table, self.name(table)))


def check_columns(found: T.StructType, table: str, where: str) -> list[str]:
    """The names of the table's declared columns; a ValueError where ``found`` lacks one or has another type."""
    declared = T.StructType.fromDDL(SCHEMAS[table])
    types = {f.name.lower(): f.dataType.simpleString() for f in found.fields}
    wrong = [f"{f.name} is {types.get(f.name, 'missing')}, not {f.dataType.simpleString()}"
             for f in declared.fields if types.get(f.name) != f.dataType.simpleString()]
    if wrong:
        raise ValueError(f"{where} differs from the declaration of {table}: {'; '.join(wrong)}")
    return declared.fieldNames()


def register_folder(spark: SparkSession, folder: str, database: str, tables: Iterable[str]) -> None:
    """Register Parquet files of a folder as external tables of a database (made where it is missing).

    The files' columns are held against the declared ones.  Dropping such a
    table leaves its files.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for table in tables:
        path = f"{folder.rstrip('/')}/{table}.parquet"
        found = spark.read.parquet(path).schema
        if table in SCHEMAS:
            check_columns(found, table, path)
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{table} ({columns}) USING parquet LOCATION '{path}'")
