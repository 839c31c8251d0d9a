"""Date-text cleaning and open-ended validity intervals.

Run dates are explicit arguments (``as_of``), never ``current_date()``, so a
job re-run on the same inputs writes the same feed.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names, in order; the first three letters are their abbreviations.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september",
          "october", "november", "december")

_MONTH = "(" + "|".join(f"{m[:3]}(?:{m[3:]})?" if m[3:] else m for m in MONTHS) + ")"
_Y, _N = r"(\d{4})", r"(\d{1,2})"
#: The accepted shapes of a date: (pattern, which of its groups are year, month and day).
DATE_SHAPES = (
    (rf"{_Y}[-/.]{_N}[-/.]{_N}", "ymd"),
    (rf"{_N}[-/.]{_N}[-/.]{_Y}", "mdy"),
    (r"(\d{4})(\d{2})(\d{2})", "ymd"),
    (rf"{_MONTH}\.? +{_N}(?:, *| +){_Y}", "mdy"),
    (rf"{_N} +{_MONTH}\.?,? +{_Y}", "dmy"),
    (_Y, "y"),
)
#: An optional time of day, 24 hours or AM/PM.
_TIME = r"(?:(?: +|T)(\d{1,2}):(\d{2})(?::(\d{2})(\.\d{1,6})?)?(?: *([ap]m))?)?"
_SEP = "\x01"


def _shape() -> tuple[str, str]:
    """One pattern for all shapes, and the replacement that puts the parts in one order.

    A group that took no part in the match is empty in the replacement, so
    the groups of a part stand side by side, one from each shape.
    """
    groups: dict[str, list[int]] = {"y": [], "m": [], "d": []}
    n = 0
    for _, order in DATE_SHAPES:
        for part in order:
            n += 1
            groups[part].append(n)
    parts = ["".join(f"${g}" for g in groups[part]) for part in "ymd"]
    parts += [f"${n + 1}", f"${n + 2}", f"${n + 3}${n + 4}", f"${n + 5}"]
    return f"(?i)^(?:{'|'.join(p for p, _ in DATE_SHAPES)}){_TIME}$", _SEP + _SEP.join(parts)


_PATTERN, _PARTS = _shape()


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date_text(text) -> Column:
    """Text -> timestamp; NULL when it has none of the accepted shapes or is no date of the calendar.

    The shape is recognised by one pattern, which also puts the parts in
    order; they are then read once.  Month names are full or three letters,
    in any case; a year alone is its first day; without a time it is midnight.
    """
    given = F.replace(F.trim(_c(text)), F.lit(_SEP), F.lit("?"))  # only a match has the separator
    parts = F.split(F.regexp_replace(given, _PATTERN, _PARTS), _SEP)
    return F.transform(F.array(parts), _from_parts)[0]  # a lambda reads the parts once


def _from_parts(parts: Column) -> Column:
    """[marker, year, month, day, hour, minute, second, half of day] -> timestamp."""
    # a text of no accepted shape stays as it was, in one piece
    part = lambda i: F.nullif(F.try_element_at(parts, F.lit(i + 2)), F.lit(""))
    number = lambda i, other=None: F.coalesce(part(i), F.lit(other)).try_cast("int")
    names = F.array(*[F.lit(m[:3]) for m in MONTHS])
    name = F.nullif(F.array_position(names, F.lower(F.left(part(1), F.lit(3)))), F.lit(0)).cast("int")
    month = F.when(part(1).isNull(), 1).otherwise(F.coalesce(part(1).try_cast("int"), name))
    hour, half = number(3, "0"), F.lower(part(6))
    hour = F.when(half.isNull(), hour).when(hour.between(1, 12), hour % 12 + F.when(half == "pm", 12).otherwise(0))
    second = F.coalesce(part(5), F.lit("0")).try_cast("decimal(8,6)")
    return F.try_make_timestamp(number(0), month, number(2, "1"), hour, number(4, "0"), second)


def as_of_date(as_of) -> _dt.date:
    if isinstance(as_of, _dt.datetime):
        return as_of.date()
    if isinstance(as_of, _dt.date):
        return as_of
    return _dt.date.fromisoformat(str(as_of))


def next_midnight(as_of) -> Column:
    """Midnight after the run date, as a timestamp literal."""
    d = as_of_date(as_of) + _dt.timedelta(days=1)
    return F.lit(d.isoformat()).cast("timestamp")


def valid_on(start, end, as_of) -> Column:
    """Open-ended interval test at tomorrow midnight.

    (start is NULL or start < tomorrow) and (end is NULL or tomorrow <= end).
    Equivalent to the four-branch OR of the source, which Catalyst would
    factor to the same two conjuncts.  ``start``/``end`` are timestamps:
    parse date text once into columns first (``parse_date_text``), so the
    parser is not expanded once per reference inside the predicate.
    """
    t = next_midnight(as_of)
    s, e = _c(start), _c(end)
    return (s.isNull() | (s < t)) & (e.isNull() | (t <= e))
