"""Data guards run before a transfer, each one aggregation pass over the table.

Every check reduces the table with a partial (map-side) aggregation to a few
numbers per column, so the cost is one scan and a tiny shuffle whatever the
table size, and a hot key cannot overload a task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferry.functions.render import render, render_field
from ferry.functions.text import quoted
from ferry.sources.delimited import FileFormat, encode


class GuardError(ValueError):
    pass


def null_counts(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """(column_name, null_rows) for each required column, one pass."""
    if not required:
        return df.sparkSession.createDataFrame([], "column_name string, null_rows long")
    agg = df.agg(*[F.count_if(F.col(quoted(c)).isNull()).alias(f"n{i}") for i, c in enumerate(required)])
    cells = [x for i, c in enumerate(required) for x in (F.lit(c), F.col(f"n{i}"))]
    return agg.select(F.stack(F.lit(len(required)), *cells).alias("column_name", "null_rows"))


def guard_not_null(df: DataFrame, required: Sequence[str], raise_on_fail: bool = False) -> DataFrame:
    """NULLs that NOT NULL target columns would receive."""
    out = null_counts(df, required)
    if raise_on_fail:
        bad = out.filter("null_rows > 0").collect()
        if bad:
            raise GuardError("NULLs in NOT NULL columns: " + ", ".join(f"{r[0]} ({r[1]})" for r in bad))
    return out


def guard_types(df: DataFrame, targets: dict[str, str], raise_on_fail: bool = False) -> DataFrame:
    """(column_name, target_type, bad_rows): non-NULL values that do not survive the cast."""
    items = list(targets.items())
    agg = df.agg(*[F.count_if(F.col(quoted(c)).isNotNull() & F.col(quoted(c)).try_cast(t).isNull()).alias(f"b{i}")
                   for i, (c, t) in enumerate(items)])
    cells = [x for i, (c, t) in enumerate(items) for x in (F.lit(c), F.lit(t), F.col(f"b{i}"))]
    out = agg.select(F.stack(F.lit(len(items)), *cells).alias("column_name", "target_type", "bad_rows"))
    if raise_on_fail:
        bad = out.filter("bad_rows > 0").collect()
        if bad:
            raise GuardError("values that do not fit the target type: " +
                             ", ".join(f"{r[0]} as {r[1]} ({r[2]})" for r in bad))
    return out


def overlap_suffixes(delim: str) -> list[str]:
    """Field endings that make a split find the delimiter too early.

    A field ending in ``delim[:k]`` is unsafe when the rest ``delim[k:]`` is
    also a prefix of ``delim`` (the delimiter overlaps itself): the splitter
    then matches ``delim[:k] + delim[:len-k]`` first. For ``^|^`` that is
    the ending ``^|``; delimiters without self-overlap (``~|^``) have none.
    """
    return [delim[:k] for k in range(1, len(delim)) if delim.startswith(delim[k:])]


def safe_record_predicate(fields: list[Column], fmt: FileFormat, record: Column | None = None) -> Column:
    """True when the record built from ``fields`` (rendered, non-NULL) reads back field for field.

    Exact for leftmost-match splitting: no field contains the delimiter, no
    field but the last ends in an overlapping delimiter prefix, and the record
    holds no record separator. Only ``contains`` / ``endswith`` per field,
    no regular expression, so it costs a fraction of the render itself.
    """
    ok = F.lit(True)
    ends = overlap_suffixes(fmt.field_delim)
    for i, f in enumerate(fields):
        ok = ok & ~f.contains(fmt.field_delim)
        if i < len(fields) - 1:
            for e in ends:
                ok = ok & ~f.endswith(e)
    rec = record if record is not None else F.concat_ws(fmt.field_delim, *fields)
    sep = fmt.line_sep
    for e in overlap_suffixes(sep):
        ok = ok & ~rec.endswith(e)
    return ok & (F.instr(F.concat(rec, F.lit(sep)), F.lit(sep)) == F.length(rec) + 1)


def unsafe_rows_predicate(df: DataFrame, fmt: FileFormat) -> Column:
    """True for rows whose landed record would not read back field for field.

    Containment of the delimiter is not enough: a value ending in a prefix of
    the field delimiter shifts the boundary (see ``overlap_suffixes``).
    """
    fields = [render_field(f.name, f.dataType, fmt.nulls) for f in df.schema.fields]
    return ~safe_record_predicate(fields, fmt)


def split_check_predicate(df: DataFrame, fmt: FileFormat) -> Column:
    """Slow reference form of ``unsafe_rows_predicate``: re-split and compare (used in tests)."""
    fields = [render_field(f.name, f.dataType, fmt.nulls) for f in df.schema.fields]
    line = encode(df, fmt)
    same = F.split(line, fmt.split_regex, -1) == F.array(*fields)
    sep_ok = F.instr(F.concat(line, F.lit(fmt.line_sep)), F.lit(fmt.line_sep)) == F.length(line) + 1
    return ~(same & sep_ok)


def delimiter_check(df: DataFrame, fmt: FileFormat, label: str = "") -> DataFrame:
    """(table_name, rows, unsafe_rows) in one pass."""
    return df.agg(F.lit(label).alias("table_name"), F.count(F.lit(1)).alias("rows"),
                  F.count_if(unsafe_rows_predicate(df, fmt)).alias("unsafe_rows"))


def length_check(df: DataFrame, declared: dict[str, int] | None = None) -> DataFrame:
    """(column_name, max_len, over_rows): longest rendered field in bytes and rows over a declared length.

    Columns without a declared length get none (``over_rows`` 0); use
    ``type_limits(df)`` to declare the limits the types themselves imply.
    """
    declared = declared or {}
    fields = df.schema.fields
    aggs = []
    for i, f in enumerate(fields):
        ln = F.octet_length(render(f.name, f.dataType))
        aggs.append(F.max(ln).alias(f"m{i}"))
        lim = declared.get(f.name)
        aggs.append((F.count_if(ln > lim) if lim is not None else F.lit(0).cast("long")).alias(f"o{i}"))
    agg = df.agg(*aggs)
    cells = [x for i, f in enumerate(fields) for x in (F.lit(f.name), F.col(f"m{i}"), F.col(f"o{i}"))]
    return agg.select(F.stack(F.lit(len(fields)), *cells).alias("column_name", "max_len", "over_rows"))


def type_limits(df: DataFrame) -> dict[str, int]:
    """Declared lengths implied by the column types (see ``max_text_length``); unbounded types left out."""
    from ferry.functions.render import max_text_length
    out = {}
    for f in df.schema.fields:
        n = max_text_length(f.dataType)
        if n is not None:
            out[f.name] = n
    return out


def unique_check(df: DataFrame, keys: Sequence[str], raise_on_fail: bool = False) -> DataFrame:
    """Keys that occur more than once, with their counts (PRIMARY KEY / UNIQUE check)."""
    dup = df.groupBy(*[F.col(quoted(k)) for k in keys]).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if raise_on_fail and not dup.isEmpty():
        raise GuardError(f"duplicate keys in ({', '.join(keys)})")
    return dup


def all_children_flag(df: DataFrame, parent: Sequence[str], cond: Column, out: str = "all_children") -> DataFrame:
    """Per parent: does every child row satisfy ``cond``? (bool_and with map-side combine)."""
    return df.groupBy(*[F.col(quoted(p)) for p in parent]).agg(F.bool_and(F.coalesce(cond, F.lit(False))).alias(out))
