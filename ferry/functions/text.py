"""Scalar helpers with T-SQL meaning, written as built-in Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CRLF = "\r\n"


def quoted(name: str) -> str:
    """A column name as one identifier, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def _c(x: Column | str) -> Column:
    return F.col(quoted(x)) if isinstance(x, str) else x


def split_names(text: str | None, sep: str = ",") -> list[str]:
    """A user's name list: CRLF removed, split on ``sep``, trimmed, empties dropped, distinct (first wins)."""
    if not text:
        return []
    seen: dict[str, None] = {}
    for part in text.replace(CRLF, "").split(sep):
        part = part.strip()
        if part:
            seen.setdefault(part, None)
    return list(seen)


def split_explode(c: Column | str, sep: str = ",", trim: bool = True, drop_empty: bool = True) -> Column:
    """Generator: one row per piece of ``c`` split on the literal ``sep`` (table-valued STRING_SPLIT)."""
    pattern = "".join(ch if ch.isalnum() else "\\" + ch for ch in sep)
    pieces = F.split(_c(c), pattern, -1)
    if trim:
        pieces = F.transform(pieces, lambda p: F.trim(p))
    if drop_empty:
        pieces = F.filter(pieces, lambda p: F.length(p) > 0)
    return F.explode(pieces)


def tsql_len(c: Column | str) -> Column:
    """LEN: characters, trailing blanks ignored."""
    return F.length(F.rtrim(_c(c)))


def charindex(needle: str, haystack: Column | str, start: int = 1) -> Column:
    """CHARINDEX: 1-based position of ``needle`` in ``haystack`` from ``start``, 0 when absent."""
    return F.locate(needle, _c(haystack), start)


def concat_nn(*cols: Column | str) -> Column:
    """CONCAT: NULL arguments count as empty strings."""
    return F.concat(*[F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols])


def quote_name(c: Column | str, left: str = "[", right: str = "]") -> Column:
    """QUOTENAME: delimit an identifier, doubling the closing bracket inside it."""
    return F.concat(F.lit(left), F.replace(_c(c), F.lit(right), F.lit(right * 2)), F.lit(right))


def replace_text(c: Column | str, old: str, new: str) -> Column:
    """REPLACE: every occurrence of ``old``."""
    return F.replace(_c(c), F.lit(old), F.lit(new))


def iif(cond: Column, a, b) -> Column:
    return F.when(cond, a).otherwise(b)
