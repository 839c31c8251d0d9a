"""Aggregation operators: string aggregation and EAV pivot."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def string_agg(df: DataFrame, keys: Sequence[str], value: Column | str, sep: str = "|",
               distinct: bool = False, alias: str = "value") -> DataFrame:
    """``STRING_AGG(value, sep)`` per key, NULLs skipped, values in ascending order.

    The source gives no order; ascending order makes the text deterministic.
    ``distinct=True`` dedupes with ``collect_set`` (deduped map-side too).
    """
    v = F.col(value) if isinstance(value, str) else value
    bag = F.collect_set(v) if distinct else F.collect_list(v)
    return df.groupBy(*keys).agg(F.array_join(F.array_sort(bag), sep).alias(alias))


def eav_pivot(df: DataFrame, key: str, name: str, value: str, names: Sequence[str],
              renames: Mapping[str, str] | None = None) -> DataFrame:
    """Entity-attribute-value rows -> one row per entity, one column per listed name.

    Names not listed are ignored but their entity is kept (all-NULL row),
    exactly like ``PIVOT (MAX(v) FOR name IN (...))``.  The list is always
    explicit, so Spark never runs a distinct-values job to discover it.
    """
    out = df.groupBy(key).pivot(name, list(names)).agg(F.max(value))
    if renames:
        out = out.withColumnsRenamed(dict(renames))
    return out
