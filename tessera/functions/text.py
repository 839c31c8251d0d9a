"""String helpers with the source system's NULL and blank rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MULTI_SEP = "|"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nonblank(text) -> Column:
    """``text != ''`` with blank-padded comparison: NULL, '' and all-blank fail."""
    return F.rtrim(_c(text)) != ""


def concat_nullable(*parts) -> Column:
    """``a + b`` string concatenation: any NULL part makes the result NULL."""
    return F.concat(*[_c(p) for p in parts])


def concat_skip_null(*parts) -> Column:
    """``CONCAT(a, b)``: NULL parts count as ''."""
    return F.concat_ws("", *[_c(p) for p in parts])


def fixed_text(value, width: int = 20) -> Column:
    """Number/text -> text of at most ``width`` characters (a VARCHAR(n) convert)."""
    return F.left(_c(value).cast("string"), F.lit(width))


def product_path(set_id) -> Column:
    return concat_nullable(F.lit("/products/"), fixed_text(set_id, 20))


def split_multi(text) -> Column:
    """'|'-joined text -> array of values (NULL stays NULL)."""
    return F.split(_c(text), r"[|]")


def is_single_valued(text) -> Column:
    return F.instr(_c(text), MULTI_SEP) == 0


def scalar_or_array(text) -> Column:
    """'a' -> JSON string "a"; 'a|b' -> JSON array ["a","b"]; NULL -> NULL (key omitted).

    Returned as a VARIANT so one field can carry either shape; ``to_json``
    then quotes and escapes the values itself.
    """
    if isinstance(text, str):  # one SQL expression: a single call to build, same plan
        c = f"`{text}`"
        return F.expr(f"CASE WHEN {c} IS NULL THEN CAST(NULL AS VARIANT) "
                      f"WHEN instr({c}, '|') = 0 THEN CAST({c} AS VARIANT) "
                      f"ELSE CAST(split({c}, '[|]') AS VARIANT) END")
    t = text
    return (F.when(t.isNull(), F.lit(None).cast("variant"))
            .when(is_single_valued(t), t.cast("variant"))
            .otherwise(split_multi(t).cast("variant")))


def quote_escape(text) -> Column:
    """Escape double quotes with a backslash (the hand-built JSON of the source)."""
    return F.replace(_c(text), F.lit('"'), F.lit('\\"'))


def pipe_to_json_list_body(text) -> Column:
    """'a|b' -> 'a","b' (the text between the brackets of a hand-built JSON list)."""
    return F.replace(quote_escape(text), F.lit("|"), F.lit('","'))
