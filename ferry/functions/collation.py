"""Comparisons under a server's collation, by Spark's collated string types.

Servers compare text by a collation: without case, with or without accents, and
without the blanks at its end. ``lower()`` covers only the first. Here a column gets the
collated type, so joins, distinct rows, groups, sorting and lists compare as the server
does while the values stay as they are; Spark shuffles and joins by the collation's sort keys.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferry.functions.text import quoted

_FLAGS = {"CI": "CI", "CS": None, "AI": "AI", "AS": None}


def spark_collation(server: str) -> str:
    """The Spark collation of a server collation's name: ``..._CI_AS`` is without case, ``..._AI`` without accents,
    ``..._BIN`` / ``..._BIN2`` by code point. All ignore blanks at the end, as servers do."""
    parts = server.upper().split("_")
    if {"BIN", "BIN2"} & set(parts):
        return "UTF8_BINARY_RTRIM"
    flags = [_FLAGS[p] for p in parts if _FLAGS.get(p)]
    return "_".join(["UNICODE", *flags, "RTRIM"])


DEFAULT = "SQL_Latin1_General_CP1_CI_AS"


def collated(col: Column | str, server: str = DEFAULT) -> Column:
    """The column as a collated string: comparisons with it follow the collation."""
    c = F.col(quoted(col)) if isinstance(col, str) else col
    return F.collate(c, spark_collation(server))


def with_collation(df: DataFrame, columns: Sequence[str], server: str = DEFAULT) -> DataFrame:
    """``df`` with collated columns; every later join, group, distinct or sort on them follows the collation."""
    return df.select(*[collated(c, server).alias(c) if c in columns else F.col(quoted(c)) for c in df.columns])


def plain(df: DataFrame) -> DataFrame:
    """The same values as ordinary strings (for writing, or to compare them byte by byte again)."""
    return df.select(*[F.collate(F.col(quoted(f.name)), "UTF8_BINARY").alias(f.name)
                       if f.dataType.typeName() == "string" else F.col(quoted(f.name)) for f in df.schema.fields])


def distinct_collated(df: DataFrame, columns: Sequence[str], server: str = DEFAULT) -> DataFrame:
    """Distinct values under the collation, each written as the first of its spellings (by code points)."""
    return plain(with_collation(df.select(*[F.col(quoted(c)) for c in columns], *[F.col(quoted(c)).alias(f"_f_{c}") for c in columns]),
                                columns, server)
                 .groupBy(*[F.col(quoted(c)) for c in columns]).agg(F.min(F.struct(*[f"_f_{c}" for c in columns])).alias("_f"))
                 .select(*[F.col("_f").getField(f"_f_{c}").alias(c) for c in columns]))


def count_collated(df: DataFrame, column: str, server: str = DEFAULT, out: str = "n") -> DataFrame:
    """Rows for each value under the collation, written as the first of its spellings."""
    c = F.col(quoted(column))
    return df.groupBy(collated(c, server).alias("_f")).agg(F.min(c).alias(column), F.count(F.lit(1)).alias(out)).select(column, out)


def join_collated(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], how: str = "inner", server: str = DEFAULT) -> DataFrame:
    """Equi-join of (left column, right column) pairs under the collation; all columns of both sides (left only for semi / anti)."""
    keyed = right.select("*", *[collated(r, server).alias(f"_f_k{i}") for i, (_, r) in enumerate(on)])
    cond = F.lit(True)
    for i, (l, _) in enumerate(on):
        cond = cond & (collated(left[quoted(l)], server) == F.col(f"_f_k{i}"))
    return left.join(keyed, cond, how).drop(*[f"_f_k{i}" for i in range(len(on))])


def in_list(col: Column | str, values: Iterable[str], server: str = DEFAULT) -> Column:
    """``col IN (...)`` under the collation."""
    return collated(col, server).isin(*[F.collate(F.lit(v), spark_collation(server)) for v in values])
