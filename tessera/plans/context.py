"""Per-query build context: one catalog + one set of stages per (session, directory)."""

from __future__ import annotations

import zlib

from pyspark.sql import SparkSession

from ..sources.catalog import Catalog
from ..sources.tables import SCHEMAS, NamedTables, register_folder
from .stages import Stages

# Fixed run parameters of the registered queries (oracle SQL uses the same literals).
AS_OF = "2024-01-15"
BRAND_CODE = "r1"


def stages_for(spark: SparkSession, sf_dir: str, as_of: str = AS_OF,
               brand_code: str = BRAND_CODE) -> Stages:
    return Stages(Catalog(spark, sf_dir), as_of=as_of, brand_code=brand_code)


def named_tables(spark: SparkSession, sf_dir: str) -> NamedTables:
    """The folder's tables in two databases: the review events apart from the catalog."""
    key = f"{zlib.crc32(sf_dir.rstrip('/').encode()):08x}"
    catalog, reviews = f"tessera_catalog_{key}", f"tessera_reviews_{key}"
    register_folder(spark, sf_dir, catalog, [t for t in SCHEMAS if t != "events"])
    register_folder(spark, sf_dir, reviews, ["events"])
    return NamedTables(catalog, {"events": f"{reviews}.events"})


def named_stages(spark: SparkSession, sf_dir: str) -> Stages:
    return Stages(Catalog(spark, named_tables(spark, sf_dir)), as_of=AS_OF, brand_code=BRAND_CODE)
