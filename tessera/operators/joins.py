"""Join-shaped operators: existence, top-1 per key, residual left join, fallback.

All are plain DataFrame joins/aggregates so Catalyst keeps predicate
pushdown and AQE can pick broadcast or sort-merge at runtime and split
skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def exists_in(df: DataFrame, other: DataFrame, on) -> DataFrame:
    """Rows of ``df`` with at least one match in ``other`` (never multiplies rows)."""
    return df.join(other, on, "left_semi")


def top1_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str],
                 cols: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the first row in the ascending total order ``order_by``.

    ``row_number() = 1`` over a window: Spark plans a partial
    ``WindowGroupLimit`` before the shuffle, so every map task keeps only its
    local first row per key and a key holding a third of all rows is reduced
    before it moves.  ``order_by`` must make the order total.
    """
    cols = list(cols) if cols is not None else [c for c in df.columns if c not in keys]
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc() for c in order_by])
    return (df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
            .select(*keys, *[c for c in cols if c not in keys]))


def left_join_on(df: DataFrame, other: DataFrame, keys: Sequence[str],
                 residual: Column | None = None) -> DataFrame:
    """LEFT JOIN with an extra predicate kept in the ON clause.

    A residual in ON only decides which right rows match; every left row
    survives.  (Filtering after the join would turn it into an inner join.)
    """
    cond = [df[k] == other[k] for k in keys]
    if residual is not None:
        cond.append(residual)
    out = df.join(other, cond, "left")
    return out.drop(*[other[k] for k in keys])


def fallback_lookup(left: DataFrame, right: DataFrame, key: str, prefer: tuple[str, str],
                    value: str, out: str = "fallback_value",
                    right_filter: Column | None = None) -> DataFrame:
    """Double LEFT JOIN with COALESCE, with the exact row multiplicity.

    Same result as::

        left LEFT JOIN right r1 ON key AND r1.<prefer[1]> = left.<prefer[0]> AND filter
             LEFT JOIN right r2 ON key AND filter
        -> COALESCE(r1.value, r2.value)

    returned grouped as ``(left columns, out, mult)`` where ``mult`` is the
    number of joined rows carrying that value.  The second join adds every
    candidate again, so the literal plan emits |r1| x |r2| pairs per key.
    Here left rows are counted, candidates are counted per (key, preferred
    column, value), joined once, and a window over each distinct left row
    gives the totals.  A preferred row with a value counts once for every
    candidate; a preferred row without one falls through to all candidates,
    as COALESCE does.  No pair is ever formed.  Rows without candidates keep
    ``out`` NULL and count once.
    """
    lcol, rcol = prefer
    r = right if right_filter is None else right.filter(right_filter)
    counts = (r.groupBy(F.col(key).alias("_key"), F.col(rcol).alias("_pref"),
                        F.col(value).alias("_val"))
              .agg(F.count(F.lit(1)).alias("_c")))
    cols = list(left.columns)
    rows = left.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    j = rows.join(counts, rows[key] == counts["_key"], "left").drop("_key")
    w = Window.partitionBy(*cols)
    is_pref = F.coalesce(F.col("_pref") == F.col(lcol), F.lit(False))
    c = F.coalesce("_c", F.lit(1))
    j = (j.withColumn("_all", F.sum("_c").over(w))
         .withColumn("_own", F.sum(F.when(is_pref, F.col("_c")).otherwise(0)).over(w))
         .withColumn("_own_null", F.sum(F.when(is_pref & F.col("_val").isNull(), F.col("_c")).otherwise(0)).over(w)))
    direct = F.when(is_pref & F.col("_val").isNotNull(), c * F.col("_all")).otherwise(0)
    through = c * F.when(F.col("_own") > 0, F.col("_own_null")).otherwise(1)
    return (j.groupBy(*cols, F.col("_val").alias(out))
            .agg(F.sum(F.col("_n") * (direct + through)).cast("bigint").alias("mult"))
            .filter(F.col("mult") > 0))
