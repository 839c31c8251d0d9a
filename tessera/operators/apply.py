"""Applies: a table expression evaluated for each row of another, declared and left to Catalyst.

``apply_rows`` is the correlated subquery in FROM (``DataFrame.lateralJoin``);
``define_table_function`` and ``apply_function`` are the parameterised table
function and its inner and outer apply (SQL ``LATERAL``).  Both are
decorrelated by the optimizer: an equality with the outer row becomes a key of
a hash or merge join, and an aggregate is grouped by that key.  Nothing is
evaluated row by row.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_OUTER = "outer_row"


def outer(name: str) -> Column:
    """A column of the outer row, inside ``apply_rows``."""
    return F.col(f"{_OUTER}.`{name}`").outer()


def apply_rows(df: DataFrame, inner: DataFrame | Callable[[], DataFrame], keep_all: bool = False) -> DataFrame:
    """Each row of ``df`` with the rows of ``inner`` for it; ``inner`` names ``df``'s columns by ``outer``.

    ``keep_all`` also keeps rows without any (an outer apply).  Aggregates in
    ``inner`` go into ``select`` (a global aggregate gives one row for each
    outer row, also where nothing matches).  Compare by equality where rows
    are many: other comparisons leave no join key.
    """
    made = inner() if callable(inner) else inner
    return df.alias(_OUTER).lateralJoin(made, how="left" if keep_all else "inner")


def define_table_function(spark: SparkSession, name: str, params: Mapping[str, str], returns: Mapping[str, str],
                          body: str, **relations: DataFrame) -> None:
    """``name(params) -> table``: a temporary SQL function whose body reads ``relations`` by their names.

    The relations become temporary views called ``<function>_<relation>``;
    in ``body`` they stand in braces: ``SELECT url FROM {urls} WHERE id = p_id``.
    Defining a name again replaces it; what was applied before keeps its plan.
    """
    views = {}
    for relation, df in relations.items():
        views[relation] = f"{name}_{relation}"
        df.createOrReplaceTempView(views[relation])
    columns = lambda of: ", ".join(f"{c} {t}" for c, t in of.items())
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({columns(params)}) RETURNS TABLE ({columns(returns)}) "
              f"RETURN {body.format(**views)}")


def apply_function(df: DataFrame, function: str, *args: str, keep_all: bool = False) -> DataFrame:
    """Each row of ``df`` with the rows of ``function(args)``; ``args`` are SQL expressions over ``df``'s columns."""
    join = "LEFT JOIN" if keep_all else "JOIN"
    return df.sparkSession.sql(
        f"SELECT l.*, f.* FROM {{df}} AS l {join} LATERAL {function}({', '.join(args)}) AS f", df=df)
