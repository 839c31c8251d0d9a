"""Collated keys: equality of text in joins, grouping and DISTINCT by a collation.

Spark's default compares bytes.  A collated column type makes every
comparison of the column follow the collation: the hash of an exchange, the
keys of a join and of a grouping, so equal keys meet in one task and nothing
has to be rewritten to lower case first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Case does not count.
ANY_CASE = "UTF8_LCASE"
#: Blanks at the end do not count (the equality of fixed-width text).
PADDED = "UTF8_BINARY_RTRIM"
#: Neither counts.
ANY_CASE_PADDED = "UTF8_LCASE_RTRIM"


def with_collation(df: DataFrame, collation: str, *columns: str) -> DataFrame:
    """``df`` with these text columns compared by ``collation`` from here on."""
    return df.withColumns({c: F.collate(F.col(c), collation) for c in columns})


def collated_join(left: DataFrame, right: DataFrame, on: list[str], collation: str, how: str = "inner") -> DataFrame:
    """Join on equally named text columns under ``collation``; both sides' spellings are compared, the left's is kept."""
    return with_collation(left, collation, *on).join(with_collation(right, collation, *on), on, how)


def one_spelling(df: DataFrame, *columns: str) -> DataFrame:
    """The columns as plain text in lower case without blanks at the end: which spelling a group shows is not defined."""
    return df.withColumns({c: F.collate(F.rtrim(F.lower(F.col(c))), "UTF8_BINARY") for c in columns})
