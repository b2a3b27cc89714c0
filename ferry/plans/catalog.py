"""Choosing tables, describing landed files and previewing a transfer.

Table choice works on catalog *metadata* (table names), which is bounded by
the number of tables, so it runs on the driver. Everything that looks at rows
(previews, summaries, field lengths) is one distributed aggregation per table.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferry.functions.render import render, render_field
from ferry.functions.text import quoted
from ferry.operators.names import as_list, is_wildcard, like_body
from ferry.sources.delimited import FileFormat, encode


class SelectionError(ValueError):
    pass


@dataclass(frozen=True)
class TableRef:
    schema: str
    name: str
    path: str | None = None   # parquet folder / file; None: a table of Spark's catalog

    @property
    def full_name(self) -> str:
        return f"{self.schema}.{self.name}"

    def read(self, spark) -> DataFrame:
        return spark.read.parquet(self.path) if self.path else spark.table(f"{self.schema}.{self.name}")


def _list_dir(root: str, spark=None) -> list[tuple[str, str, bool]]:
    """(name, full path, is directory) of the entries of ``root``.

    The listing goes through the Hadoop FileSystem of the path (HDFS, object
    stores, local).
    """
    if spark is None:
        from pyspark.sql import SparkSession
        spark = SparkSession.active()
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = [(st.getPath().getName(), st.getPath().toString(), st.isDirectory()) for st in fs.listStatus(path)]
    return sorted(out)


def catalog_from_dir(root: str, default_schema: str = "dbo", spark=None) -> list[TableRef]:
    """Tables of a folder: ``<root>/<t>.parquet`` (schema ``default_schema``) and
    ``<root>/<schema>/<t>.parquet`` (metadata listing only, no data is read)."""
    refs = []
    for name, full, is_dir in _list_dir(root, spark):
        if name.startswith(("_", ".")):
            continue
        if name.endswith(".parquet"):
            refs.append(TableRef(default_schema, name[: -len(".parquet")], full))
        elif is_dir:
            for sub, sub_full, _d in _list_dir(full, spark):
                if sub.endswith(".parquet"):
                    refs.append(TableRef(name, sub[: -len(".parquet")], sub_full))
    return refs


def catalog_from_metastore(spark, databases: list[str] | None = None) -> list[TableRef]:
    """Tables of Spark's catalog: databases act as schemas (temporary views are skipped)."""
    dbs = databases or [d.name for d in spark.catalog.listDatabases()]
    refs = []
    for db in dbs:
        for t in spark.catalog.listTables(db):
            if not t.isTemporary:
                refs.append(TableRef(db, t.name))
    return refs


def _expand(entries: list[str], universe: list[str], wildcard: str | None) -> list[str]:
    out: dict[str, None] = {}
    for e in entries:
        if is_wildcard(e, wildcard):
            rx = re.compile(like_body(e, wildcard), re.IGNORECASE | re.DOTALL)
            for u in universe:
                if rx.fullmatch(u):
                    out.setdefault(u, None)
        else:
            out.setdefault(e, None)
    return list(out)


def select_tables(catalog: list[TableRef], schemas=None, tables=None, schemas_except=None, tables_except=None,
                  all_tables: bool = False, wildcard: str | None = "*", sep: str = ",") -> list[TableRef]:
    """Tables chosen by include lists minus exception pairs.

    * ``all_tables`` takes every table and forbids include lists;
    * literal schema / table names that exist nowhere raise; wildcard entries
      that match nothing vanish silently;
    * include = existing (schema, table) pairs of the two lists (a table name
      present in another schema only is silently skipped);
    * exceptions need both lists and remove the pairs they name;
    * an empty result raises.
    """
    s_in, t_in = as_list(schemas, sep), as_list(tables, sep)
    s_ex, t_ex = as_list(schemas_except, sep), as_list(tables_except, sep)
    if not all_tables and (not s_in or not t_in):
        raise SelectionError("schema and table lists must not be empty unless all tables are chosen")
    if all_tables and (s_in or t_in):
        raise SelectionError("choose either all tables or schema / table lists, not both")
    if bool(s_ex) != bool(t_ex):
        raise SelectionError("exceptions need both a schema list and a table list")
    all_schemas = sorted({r.schema for r in catalog})
    all_names = sorted({r.name for r in catalog})
    lower_s = {s.lower() for s in all_schemas}
    lower_t = {t.lower() for t in all_names}
    if all_tables:
        chosen = list(catalog)
    else:
        missing = [s for s in s_in if not is_wildcard(s, wildcard) and s.lower() not in lower_s]
        missing += [t for t in t_in if not is_wildcard(t, wildcard) and t.lower() not in lower_t]
        if missing:
            raise SelectionError("not found: " + ", ".join(missing))
        s_set = {s.lower() for s in _expand(s_in, all_schemas, wildcard)}
        t_set = {t.lower() for t in _expand(t_in, all_names, wildcard)}
        chosen = [r for r in catalog if r.schema.lower() in s_set and r.name.lower() in t_set]
    if s_ex:
        se = {s.lower() for s in _expand(s_ex, all_schemas, wildcard)}
        te = {t.lower() for t in _expand(t_ex, all_names, wildcard)}
        chosen = [r for r in chosen if not (r.schema.lower() in se and r.name.lower() in te)]
    if not chosen:
        raise SelectionError("no table left to transfer")
    return chosen


def format_fields(df: DataFrame, fmt: FileFormat) -> DataFrame:
    """Field layout of a landed table: (field_no, column_name, max_len, terminator).

    Field numbers follow the exported columns; the last field ends with the
    record separator, the others with the field delimiter; ``max_len`` is the
    longest rendered value in bytes, measured in one pass.
    """
    spark = df.sparkSession
    fields = df.schema.fields
    agg = df.agg(*[F.max(F.octet_length(render(f.name, f.dataType))).alias(f"m{i}")
                   for i, f in enumerate(fields)]).collect()[0]
    n = len(fields)
    rows = [(i + 1, f.name, agg[f"m{i}"], fmt.line_sep if i == n - 1 else fmt.field_delim)
            for i, f in enumerate(fields)]
    return spark.createDataFrame(rows, "field_no int, column_name string, max_len int, terminator string")


def plan_preview(tables: dict[str, DataFrame], fmt: FileFormat, parallel: int = 4) -> DataFrame:
    """What a transfer would move, writing nothing: (table_name, rows, bytes) per table.

    ``bytes`` counts every record with its separator, plus the header record,
    as landed without compression (gzip parts come out smaller).
    """
    queries = []
    sep_len = len(fmt.line_sep.encode("utf-8"))
    fd_len = len(fmt.field_delim.encode("utf-8"))
    for name, df in tables.items():
        hdr = len(fmt.field_delim.join(df.columns).encode("utf-8")) + sep_len if fmt.header else 0
        # per record: its fields' bytes + (n - 1) delimiters + the separator; summing
        # field lengths avoids building each record string just to measure it
        per_row = (max(len(df.columns) - 1, 0)) * fd_len + sep_len
        field_bytes = sum((F.octet_length(render_field(f.name, f.dataType, fmt.nulls)) for f in df.schema.fields),
                          F.lit(0))
        rows = F.count(F.lit(1))
        queries.append(df.agg(F.lit(name).alias("table_name"), rows.alias("rows"),
                            (F.coalesce(F.sum(field_bytes.cast("long")), F.lit(0)) + rows * per_row + hdr)
                            .cast("long").alias("bytes")))
    from concurrent.futures import ThreadPoolExecutor
    # One small job per table, a few at a time: a union of a thousand plans would be one huge plan.
    with ThreadPoolExecutor(max_workers=max(1, min(parallel, len(queries)))) as pool:
        found = list(pool.map(lambda q: tuple(q.first()), queries))
    from pyspark.sql import SparkSession
    return SparkSession.active().createDataFrame(found, "table_name string, rows long, bytes long")


def column_summary(df: DataFrame, table: str, exact: bool = True) -> DataFrame:
    """Data dictionary: (table_name, ordinal, column_name, nulls, distinct_values, rows).

    Exact counts group each column by itself: every scan reads one column of a
    columnar table, values are combined map-side before they move, and no row is
    repeated once per column as several distinct counts in one aggregation would.
    Map columns count by their JSON text. ``exact=False`` is one pass with
    HyperLogLog++ counts, whose memory stays fixed however large the table.
    """
    def value(f) -> Column:
        c = F.col(quoted(f.name))
        return F.to_json(c) if "map<" in f.dataType.simpleString() else c

    fields = df.schema.fields
    if not exact:
        aggs = [F.count(F.lit(1)).alias("rows")]
        for i, f in enumerate(fields):
            aggs += [F.count_if(value(f).isNull()).alias(f"n{i}"), F.approx_count_distinct(value(f)).alias(f"d{i}")]
        cells = [x for i, f in enumerate(fields) for x in (F.lit(i + 1), F.lit(f.name), F.col(f"n{i}"), F.col(f"d{i}"))]
        return df.agg(*aggs).select(F.lit(table).alias("table_name"), F.stack(F.lit(len(fields)), *cells).alias(
            "ordinal", "column_name", "nulls", "distinct_values"), "rows")
    out = None
    for i, f in enumerate(fields):
        values = df.groupBy(value(f).alias("v")).agg(F.count(F.lit(1)).alias("n"))
        one = values.agg(F.lit(table).alias("table_name"), F.lit(i + 1).alias("ordinal"), F.lit(f.name).alias("column_name"),
                         F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
                         F.count("v").alias("distinct_values"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))
        out = one if out is None else out.unionAll(one)
    return out
