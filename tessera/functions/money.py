"""Money text parsing and 'low-high' price ranges, as JVM-side Column expressions.

The source stores prices as text: a single amount (``19.99``) or a range
(``19.99-29.99``).  Parsing follows the lenient money conversion of the
source system: surrounding blanks, one leading sign, one leading currency mark
and commas before the decimal point are accepted, the empty string is zero,
anything else that is not a plain decimal number is NULL (no exception, no
scientific notation).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(19,4)"

# Fixed value: the shape of a money amount once surrounding blanks are gone.
_AMOUNT = r"^([+-]? *\$?|\$ *[+-]) *([0-9][0-9,]*(\.[0-9]*)?|\.[0-9]+)$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_money(text) -> Column:
    """Lenient text -> decimal(19,4); NULL when not an amount, 0 for ''."""
    t = F.trim(_c(text))
    return (F.when(t == "", F.lit(0).cast(MONEY))
            .when(t.rlike(_AMOUNT), F.regexp_replace(t, r"[$, ]", "").try_cast(MONEY)))


def before_first(text, sep: str = "-") -> Column:
    """Text before the first ``sep``; '' when there is none or it leads."""
    s = _c(text)
    pos = F.instr(s, sep)
    return F.when(pos > 1, F.substring_index(s, sep, 1)).when(pos.isNotNull(), F.lit(""))


def after_last(text, sep: str = "-") -> Column:
    """Text after the last ``sep`` (the whole text when there is none)."""
    return F.substring_index(_c(text), sep, -1)


def range_low(text, sep: str = "-") -> Column:
    """Lower bound: the amount before the first dash, else the whole text."""
    s = _c(text)
    head = before_first(s, sep)
    # blank-padded equality: a head of only blanks counts as empty
    return F.when(F.rtrim(head) == "", parse_money(s)).otherwise(parse_money(head))


def range_high(text, sep: str = "-") -> Column:
    """Upper bound: the amount after the last dash when there is one, else the whole text."""
    s = _c(text)
    return F.when(s.contains(sep), parse_money(after_last(s, sep))).otherwise(parse_money(s))
