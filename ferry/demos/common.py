"""Shared pieces of the demo queries: table access, the landing format, SQL rendering."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ferry.session import table_path
from ferry.sources.delimited import FileFormat

# The landing format of the demos: field delimiter ^|^, record end ~~~ + CRLF.
FMT = FileFormat(field_delim="^|^", row_delim="~~~", crlf=True)

CORE_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

# Column types of the driver tables (FIXTURES.md), used to write oracle SQL.
TABLE_COLUMNS: dict[str, list[tuple[str, str]]] = {
    "region": [("r_regionkey", "int"), ("r_name", "string")],
    "nation": [("n_nationkey", "int"), ("n_name", "string"), ("n_regionkey", "int")],
    "customer": [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"),
                 ("c_mktsegment", "string")],
    "supplier": [("s_suppkey", "bigint"), ("s_name", "string"), ("s_nationkey", "int"), ("s_acctbal", "double")],
    "part": [("p_partkey", "bigint"), ("p_name", "string"), ("p_brand", "string"), ("p_type", "string"),
             ("p_size", "int"), ("p_retailprice", "double")],
    "orders": [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
               ("o_totalprice", "double"), ("o_orderdate", "timestamp"), ("o_orderpriority", "string")],
    "lineitem": [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"),
                 ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"),
                 ("l_tax", "double"), ("l_returnflag", "string"), ("l_linestatus", "string"),
                 ("l_shipdate", "timestamp")],
    "events": [("event_id", "bigint"), ("ts", "timestamp"), ("user_id", "bigint"), ("event_type", "string"),
               ("value", "double"), ("props", "string")],
    "documents": [("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"),
                  ("n_chars", "bigint")],
    "pages": [("page_id", "bigint"), ("url", "string"), ("html", "string")],
    "conversations": [("conv_id", "bigint"), ("turn", "bigint"), ("role", "string"), ("text", "string")],
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def sql_render(col: str, typ: str) -> str:
    """Oracle-side text of one field, same rules as ``ferry.functions.render``."""
    if typ == "string":
        return f"coalesce(CASE WHEN {col} = '' THEN chr(0) ELSE {col} END, '')"
    return f"coalesce(CAST({col} AS VARCHAR), '')"


def sql_record(table: str, sep: str = "^|^", columns: list[tuple[str, str]] | None = None) -> str:
    cols = columns or TABLE_COLUMNS[table]
    return f"concat_ws('{sep}', " + ", ".join(sql_render(c, t) for c, t in cols) + ")"


LINE_SEP_SQL = "'~~~' || chr(13) || chr(10)"
