"""The feed job: parameters in, JSON Lines out, failures logged and re-raised.

``run_feed(spark, sf_dir, out_dir, brand_code=..., as_of=...)`` is the
batch entry point.  Inputs are first reduced to what the published sets need
(``plans.reduce``).  What several branches read is staged in a database of the
run (``plans.staging``); headers, variant rows and views are staged too, clustered
by set, so the documents are put together without moving a row.  Nothing is
cached on executors, and the database is gone when the run ends.
"""

from __future__ import annotations

import sys
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.catalog import Catalog
from ..sources.sinks import append_error, write_jsonl
from ..sources.tables import NamedTables
from .feed import documents, headers, published, variant_rows, variants, views
from .reduce import ReducedStages
from .stages import Stages
from .staging import Staging


#: Length of the brand code parameter; what is longer is cut, as by the source's declaration.
BRAND_CODE_CHARS = 2


def brand_parameter(code: str) -> str:
    return code[:BRAND_CODE_CHARS]


def brand_lookup(catalog: Catalog, brand_code: str) -> DataFrame:
    """Brands carrying a brand code (the parameter lookup); the code is a bound parameter of the SQL text."""
    return catalog.spark.sql("SELECT brand_id, brand_name FROM {brand} WHERE brand_code = :code",
                             args={"code": brand_parameter(brand_code)}, brand=catalog.brand)


def brand_name_of(catalog: Catalog, brand_code: str) -> Column:
    """The smallest name carrying a brand code, as a scalar subquery; the code where there is none."""
    name = brand_lookup(catalog, brand_code).agg(F.min("brand_name").alias("n")).scalar()
    return F.coalesce(name, F.lit(brand_parameter(brand_code)))


def stage_documents(spark: SparkSession, source: str | NamedTables, store: Staging, brand_code: str = "r1",
                    as_of: str = "2024-01-15", brand_label: str | None = None,
                    dedupe_products: bool = True) -> DataFrame:
    """The documents, from tables staged in ``store``."""
    st = ReducedStages(Stages(Catalog(spark, source), as_of=as_of, brand_code=brand_parameter(brand_code)), store)
    sets = store.table("published", published(st, dedupe_products), by="set_id")
    label = F.lit(brand_label) if brand_label else brand_name_of(st.cat, brand_code)
    parts = {"headers": lambda: headers(st, sets, label), "variants": lambda: variant_rows(st, sets), "views": lambda: views(st, sets)}

    def stage(name: str) -> DataFrame:
        return store.table(name, parts[name](), by="set_id")

    with ThreadPoolExecutor(len(parts)) as pool:  # three jobs that need nothing of each other
        header, rows, view = pool.map(stage, parts)
    return documents(header, variants(rows), view)


def build_feed(spark: SparkSession, source: str | NamedTables, brand_code: str = "r1",
               as_of: str = "2024-01-15", brand_label: str | None = None,
               dedupe_products: bool = True) -> DataFrame:
    """(set_id, doc), kept in the checkpoint folder; the staged tables are dropped."""
    with Staging(spark) as store:
        return stage_documents(spark, source, store, brand_code, as_of, brand_label, dedupe_products).checkpoint()


def run_feed(spark: SparkSession, source: str | NamedTables, out_dir: str, brand_code: str = "r1",
             as_of: str = "2024-01-15", brand_label: str | None = None,
             error_log: str | None = None, partitions: int | None = None) -> None:
    """Build and write the feed; on failure append to ``error_log`` and re-raise."""
    try:
        with Staging(spark) as store:
            docs = stage_documents(spark, source, store, brand_code, as_of, brand_label)
            if partitions:
                docs = docs.repartition(partitions, "set_id")
            write_jsonl(docs, out_dir)
    except Exception as exc:
        if error_log:
            try:
                append_error(spark, error_log, "run_feed", exc)
            except Exception as second:  # the log must not hide the failure it reports
                print(f"the error log could not be written: {second}", file=sys.stderr)
        raise
