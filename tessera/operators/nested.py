"""Nested-collection operators: ordered arrays and keyed objects per group.

A correlated "subquery per row that returns a JSON array" becomes one
``groupBy(key).agg(collect_list(struct))`` joined back to its parent, so
the child relation is scanned once, not once per parent row.  Elements are
deduplicated before collection, so what a group collects is bounded by the
size of the document it produces.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _cmp(a: Column, b: Column, desc: bool) -> Column:
    """-1/0/1 comparator of two values; ascending puts NULLs first, descending last."""
    lt, gt = (F.lit(1), F.lit(-1)) if desc else (F.lit(-1), F.lit(1))
    return (F.when(a.isNull() & b.isNull(), 0)
            .when(a.isNull(), F.lit(1) if desc else F.lit(-1))
            .when(b.isNull(), F.lit(-1) if desc else F.lit(1))
            .when(a < b, lt).when(a > b, gt).otherwise(0))


def collect_ordered(df: DataFrame, keys: Sequence[str],
                    order: Sequence[Column | tuple[Column, bool]],
                    payload: Column, alias: str) -> DataFrame:
    """Per key, an array of ``payload`` in the given order (applied after collection).

    ``order`` items are columns (ascending) or ``(column, descending)``.  A
    ``sort`` before ``collect_list`` guarantees nothing after a shuffle;
    sorting the collected structs does.  Give a total order.
    """
    spec = [(o, False) if isinstance(o, Column) else (o[0], bool(o[1])) for o in order]
    fields = [c.alias(f"_s{i}") for i, (c, _) in enumerate(spec)]
    coll = F.collect_list(F.struct(*fields, payload.alias("_p")))
    if not any(d for _, d in spec):
        ordered = F.array_sort(coll)
    else:
        def comparator(a, b):
            out = F.lit(0)
            for i in reversed(range(len(spec))):
                c = _cmp(a[f"_s{i}"], b[f"_s{i}"], spec[i][1])
                out = F.when(c != 0, c).otherwise(out)
            return out
        ordered = F.array_sort(coll, comparator)
    return (df.groupBy(*keys).agg(ordered.alias("_arr"))
            .select(*keys, F.transform("_arr", lambda e: e["_p"]).alias(alias)))


def keyed_object(df: DataFrame, keys: Sequence[str], map_key: str, order: Sequence[str],
                 value: Column, alias: str, unique: bool = False) -> DataFrame:
    """Per key, a map ``map_key -> value`` with keys in ascending order.

    Duplicate map keys are collapsed first: the row with the smallest
    ``order`` tuple wins (``row_number() = 1``, reduced map-side by a partial
    window group limit; the value itself is never compared).  Rows with a
    NULL map key are dropped, so ``map_from_entries`` never sees a duplicate
    or NULL key.
    """
    picked = df.filter(F.col(map_key).isNotNull())
    if not unique:  # ``unique=True``: the caller already has one row per (keys, map_key)
        w = Window.partitionBy(*keys, map_key).orderBy(*[F.col(c).asc() for c in order])
        picked = picked.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
    picked = picked.select(*keys, map_key, value.alias("_v"))
    coll = F.collect_list(F.struct(F.col(map_key).alias("key"), F.col("_v").alias("value")))
    if _orderable(picked.schema["_v"].dataType):
        by_key = F.array_sort(coll)  # keys are unique, so this orders by key
    else:  # VARIANT / MAP values cannot be compared: order on the key alone
        by_key = F.array_sort(coll, lambda a, b: F.when(a["key"] < b["key"], -1)
                              .when(a["key"] > b["key"], 1).otherwise(0))
    return picked.groupBy(*keys).agg(F.map_from_entries(by_key).alias(alias))


def _orderable(dt: T.DataType) -> bool:
    if isinstance(dt, (T.VariantType, T.MapType)):
        return False
    if isinstance(dt, T.StructType):
        return all(_orderable(f.dataType) for f in dt.fields)
    if isinstance(dt, T.ArrayType):
        return _orderable(dt.elementType)
    return True


def nonempty(arr: Column | str) -> Column:
    """NULL instead of an empty array/map, so the JSON key is omitted."""
    arr = F.col(arr) if isinstance(arr, str) else arr
    return F.when(F.size(arr) > 0, arr)
