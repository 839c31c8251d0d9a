"""Flag, inline-IF and 'all children' expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def iif(cond: Column, when_true, when_false) -> Column:
    """IIF: a NULL condition takes the false branch."""
    return F.when(cond, when_true).otherwise(when_false)


def positive_flag(amount) -> Column:
    """``CONVERT(bit, IIF(x > 0, 1, 0))``: NULL amount -> false."""
    return F.coalesce(_c(amount) > 0, F.lit(False))


def true_false_text(flag) -> Column:
    """int flag -> 'true' when it equals 1, else 'false' (NULL -> 'false')."""
    return iif(_c(flag) == 1, F.lit("true"), F.lit("false"))


def gender_label(brand_id, mens_brand_id: int = 11) -> Column:
    return iif(_c(brand_id) == mens_brand_id, F.lit("Mens"), F.lit("Womens"))


def all_true_text(flag) -> Column:
    """Aggregate: 'false' if any child flag is 0, else 'true' (all NULL -> 'true').

    ``bool_and`` would give NULL for an all-NULL group, so MIN over the int
    value is used instead.
    """
    return F.when(F.min(_c(flag).cast("int")) == 0, F.lit("false")).otherwise(F.lit("true"))
