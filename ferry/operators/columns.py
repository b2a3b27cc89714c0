"""Column choice: projection in schema order and the exclusion rules.

Column flags live in ``StructField.metadata``:
  * ``{"identity": true}``  - generated key column,
  * ``{"computed": true}``  - derived column (the target recomputes it),
  * ``{"not_null": true}``  - NOT NULL in the source (parquet reads are always nullable);
  * ``{"sql_type": "xml"}`` - the source system's type name, for type exclusion lists.

All functions only change the projection, so Catalyst prunes the parquet scan
to the exported columns (``ReadSchema`` in the plan).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferry.functions.render import is_supported, max_text_length, type_label
from ferry.functions.text import quoted
from ferry.operators.names import as_list, is_wildcard, like_body

import re


def _matches(name: str, patterns: list[str], case_sensitive: bool = False, wildcard: str | None = "*") -> bool:
    flags = 0 if case_sensitive else re.IGNORECASE
    for p in patterns:
        if is_wildcard(p, wildcard):
            # the expression syntax used here means the same in Java and in Python
            if re.fullmatch(like_body(p, wildcard), name, flags | re.DOTALL):
                return True
        elif (name == p) if case_sensitive else (name.lower() == p.lower()):
            return True
    return False


def with_flags(df: DataFrame, **flags: Iterable[str]) -> DataFrame:
    """Attach flags, e.g. ``with_flags(df, identity=["id"], computed=["net"], not_null=["a"])``."""
    out = df
    for flag, names in flags.items():
        for n in names:
            meta = dict(out.schema[n].metadata)
            meta[flag] = True
            out = out.withMetadata(n, meta)
    return out


def with_source_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Record source-system type names, e.g. ``{"rowguid": "uniqueidentifier"}``."""
    out = df
    for n, t in types.items():
        out = out.withMetadata(n, {**out.schema[n].metadata, "sql_type": t})
    return out


def flag_of(field: T.StructField, flag: str) -> bool:
    return bool(field.metadata.get(flag, False))


def project_columns(df: DataFrame, names: str | Iterable[str] | None = None, case_sensitive: bool = False,
                    wildcard: str | None = "*", sep: str = ",") -> DataFrame:
    """Keep the listed columns (wildcards allowed) in *schema* order, not list order."""
    if names is None:
        return df
    pats = as_list(names, sep)
    return df.select(*[quoted(f.name) for f in df.schema.fields if _matches(f.name, pats, case_sensitive, wildcard)])


def exclude_by_name(df: DataFrame, names: str | Iterable[str] | None, case_sensitive: bool = False,
                    wildcard: str | None = "*", sep: str = ",") -> DataFrame:
    pats = as_list(names, sep)
    return df.select(*[quoted(f.name) for f in df.schema.fields if not _matches(f.name, pats, case_sensitive, wildcard)])


def exclude_by_type(df: DataFrame, types: str | Iterable[str] | None, wildcard: str | None = "*",
                    sep: str = ",") -> DataFrame:
    """Drop columns whose type is listed.

    A column matches by its Spark type name (``typeName()``, e.g.
    ``timestamp_ntz``, ``decimal``; a user-defined type counts as its
    underlying SQL type) or by the source system's type name kept in field
    metadata ``sql_type`` (e.g. ``uniqueidentifier`` or ``xml`` landed as strings).
    """
    pats = as_list(types, sep)

    def labels(f: T.StructField) -> list[str]:
        dt = f.dataType
        out = [type_label(dt.sqlType() if isinstance(dt, T.UserDefinedType) else dt)]
        if f.metadata.get("sql_type"):
            out.append(str(f.metadata["sql_type"]))
        return out

    return df.select(*[quoted(f.name) for f in df.schema.fields
                       if not any(_matches(lb, pats, False, wildcard) for lb in labels(f))])


def exclude_by_flag(df: DataFrame, export_identity: bool = True, export_computed: bool = False) -> DataFrame:
    keep = [quoted(f.name) for f in df.schema.fields
            if not (flag_of(f, "identity") and not export_identity)
            and not (flag_of(f, "computed") and not export_computed)]
    return df.select(*keep)


def choose_columns(df: DataFrame, exclude_names=None, exclude_types=None, export_identity: bool = True,
                   export_computed: bool = False, wildcard: str | None = "*", sep: str = ",") -> DataFrame:
    """All column rules together, in the order flags -> names -> types."""
    out = exclude_by_flag(df, export_identity, export_computed)
    out = exclude_by_name(out, exclude_names, wildcard=wildcard, sep=sep)
    return exclude_by_type(out, exclude_types, wildcard=wildcard, sep=sep)


def unknown_names(df: DataFrame, names: str | Iterable[str] | None, wildcard: str | None = "*", sep: str = ",") -> list[str]:
    """Literal entries of a column list that name no column of ``df`` (wildcard entries may match nothing)."""
    own = {c.lower() for c in df.columns}
    return [p for p in as_list(names, sep) if not is_wildcard(p, wildcard) and p.lower() not in own]


def unknown_columns(df: DataFrame, names: str | Iterable[str] | None, wildcard: str | None = "*", sep: str = ",") -> DataFrame:
    """``unknown_names`` as rows (column_name)."""
    return df.sparkSession.createDataFrame([(n,) for n in unknown_names(df, names, wildcard, sep)], "column_name string")


COLUMNS_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("ordinal", T.IntegerType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("data_type", T.StringType()),
    T.StructField("is_identity", T.BooleanType()),
    T.StructField("is_computed", T.BooleanType()),
    T.StructField("is_not_null", T.BooleanType()),
    T.StructField("has_mapping", T.BooleanType()),
    T.StructField("max_text_len", T.IntegerType()),
    T.StructField("is_exported", T.BooleanType()),
])


def columns_rows(table: str, source: DataFrame, exported: DataFrame) -> list[tuple]:
    """One row (``COLUMNS_SCHEMA``) per source column with its flags and whether it is exported (metadata only)."""
    kept = set(exported.columns)
    return [(table, i + 1, f.name, f.dataType.simpleString(), flag_of(f, "identity"), flag_of(f, "computed"),
             flag_of(f, "not_null") or not f.nullable, is_supported(f.dataType),
             max_text_length(f.dataType) if is_supported(f.dataType) else None, f.name in kept)
            for i, f in enumerate(source.schema.fields)]
