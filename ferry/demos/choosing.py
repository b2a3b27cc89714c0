"""Demo queries for projection, selection, predicates and guards."""

from __future__ import annotations

from pyspark.sql import functions as F

from ferry.demos.common import FMT, TABLE_COLUMNS, load, sql_record, sql_render
from ferry.operators.checks import all_children_flag, delimiter_check, guard_not_null, guard_types, length_check
from ferry.operators.columns import (exclude_by_flag, exclude_by_name, exclude_by_type, project_columns,
                                     unknown_columns, with_flags)
from ferry.operators.names import (flag_exceptions, missing_names, pattern_pairs, select_pairs, wildcard_expand,
                                   wildcard_match)
from ferry.operators.relational import case_map, searched_case
from ferry.operators.skew import skew_join
from ferry.plans.catalog import column_summary
from ferry.session import scratch_path
from ferry.sources.delimited import read_delimited, write_delimited
from ferry.functions.text import iif

Q: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        Q[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


@query("project_columns", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def project_columns_demo(spark, sf):
    return project_columns(load(spark, sf, "customer"), "c_acct*, C_*NAME, c_custkey")


@query("exclude_by_name", "SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def exclude_by_name_demo(spark, sf):
    return exclude_by_name(load(spark, sf, "customer"), "C_NAME, no_such_column")


@query("exclude_by_type",
       "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def exclude_by_type_demo(spark, sf):
    return exclude_by_type(load(spark, sf, "orders"), "timestamp*")


@query("exclude_by_flag",
       "SELECT l_orderkey, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, "
       "l_linestatus, l_shipdate FROM lineitem")
def exclude_by_flag_demo(spark, sf):
    li = load(spark, sf, "lineitem")
    li = li.withColumn("l_net", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    li = with_flags(li, identity=["l_linenumber"], computed=["l_net"])
    return exclude_by_flag(li, export_identity=False, export_computed=False)


@query("wildcard_match", "SELECT * FROM part WHERE p_name ILIKE 'small%' OR p_name ILIKE '%widget'")
def wildcard_match_demo(spark, sf):
    return wildcard_match(load(spark, sf, "part"), "p_name", "small*, *widget")


@query("wildcard_text", "SELECT doc_id, lang FROM documents WHERE text ILIKE '%the%' OR text ILIKE 'a%n_s%.'")
def wildcard_text_demo(spark, sf):
    """Values with line breaks: a wildcard spans them."""
    return wildcard_match(load(spark, sf, "documents"), "text", "*the*, a*n_s*.").select("doc_id", "lang")


# Entries without "*" compare by equality ("S_ALL" matches nothing); inside a
# wildcard entry "_" is LIKE's any-character ("S_A*" matches SMALL, STANDARD).
_JOIN_LIKE_PATTERNS = ["ECO*", "*AR*", "S_ALL", "S_A*", "PROMO", "promo*"]


@query("join_like",
       "SELECT p_partkey, p_type, pattern FROM part JOIN (VALUES ('ECO%', 'ECO*', true), ('%AR%', '*AR*', true), "
       "('S_ALL', 'S_ALL', false), ('S_A%', 'S_A*', true), ('PROMO', 'PROMO', false), ('promo%', 'promo*', true)) "
       "v(lk, pattern, wild) ON CASE WHEN wild THEN p_type ILIKE lk ELSE lower(p_type) = lower(lk) END")
def join_like_demo(spark, sf):
    return pattern_pairs(load(spark, sf, "part").select("p_partkey", "p_type"), "p_type", _JOIN_LIKE_PATTERNS)


@query("wildcard_expand",
       "SELECT 'PROMO' AS name UNION SELECT 'NOSUCH' UNION "
       "SELECT DISTINCT p_type FROM part WHERE p_type ILIKE 'ECO%' OR p_type ILIKE '%AR%'")
def wildcard_expand_demo(spark, sf):
    return wildcard_expand(spark, load(spark, sf, "part"), "p_type", "ECO*, *AR*, PROMO, NOSUCH")


@query("select_pairs",
       "SELECT * FROM orders WHERE o_orderstatus IN ('F', 'P') "
       "AND (o_orderpriority LIKE '1-%' OR o_orderpriority = '3-MEDIUM')")
def select_pairs_demo(spark, sf):
    return select_pairs(load(spark, sf, "orders"), "o_orderstatus", "F, P", "o_orderpriority", "1-*, 3-MEDIUM")


@query("flag_exceptions",
       "SELECT o_orderkey, c_mktsegment, o_orderstatus, CASE WHEN (c_mktsegment = 'BUILDING' AND o_orderstatus = 'F') "
       "OR (c_mktsegment ILIKE 'MACHINE%' AND o_orderstatus = 'O') THEN 1 ELSE 0 END AS is_exception "
       "FROM orders JOIN customer ON o_custkey = c_custkey")
def flag_exceptions_demo(spark, sf):
    o, c = load(spark, sf, "orders"), load(spark, sf, "customer")
    j = skew_join(o, c, [("o_custkey", "c_custkey")]).select("o_orderkey", "c_mktsegment", "o_orderstatus")
    return flag_exceptions(j, [("BUILDING", "F"), ("MACHINE*", "O")], ("c_mktsegment", "o_orderstatus"))


@query("missing_names",
       "SELECT DISTINCT conv_id FROM conversations c WHERE NOT EXISTS "
       "(SELECT 1 FROM conversations a WHERE a.conv_id = c.conv_id AND a.role = 'assistant')")
def missing_names_demo(spark, sf):
    conv = load(spark, sf, "conversations")
    requested = conv.select("conv_id").distinct()
    return missing_names(requested, conv.filter(F.col("role") == "assistant"), "conv_id")


_REQUIRED = ["event_id", "ts", "event_type"]


@query("guard_not_null", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {e} IS NULL) AS null_rows FROM events"
    for c, e in [("event_id", "event_id"), ("ts", "ts"), ("event_type", "nullif(event_type, 'error')")]))
def guard_not_null_demo(spark, sf):
    ev = load(spark, sf, "events").withColumn("event_type", F.nullif(F.col("event_type"), F.lit("error")))
    return guard_not_null(ev, _REQUIRED)


_TYPE_TARGETS = {"o_orderpriority": "int", "o_orderstatus": "string", "o_custkey": "int", "o_totalprice": "bigint"}
_DUCK_TYPES = {"int": "INTEGER", "string": "VARCHAR", "bigint": "BIGINT"}


@query("guard_types", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS target_type, count(*) FILTER (WHERE {c} IS NOT NULL AND "
    f"TRY_CAST({c} AS {_DUCK_TYPES[t]}) IS NULL) AS bad_rows FROM orders" for c, t in _TYPE_TARGETS.items()))
def guard_types_demo(spark, sf):
    return guard_types(load(spark, sf, "orders"), _TYPE_TARGETS)


@query("all_children_flag",
       "SELECT l_orderkey, bool_and(coalesce(l_linestatus = 'F', false)) AS all_f FROM lineitem GROUP BY l_orderkey")
def all_children_flag_demo(spark, sf):
    return all_children_flag(load(spark, sf, "lineitem"), ["l_orderkey"], F.col("l_linestatus") == "F", out="all_f")


def _crafted(spark, sf):
    d = load(spark, sf, "documents")
    return d.withColumn("text", F.when(F.col("lang") == "de", F.concat(F.col("text"), F.lit("^|")))
                        .otherwise(F.col("text")))


def _unsafe_sql(table: str, cols: list[tuple[str, str]], src: str | None = None) -> str:
    rec = sql_record(table, columns=cols)
    fields = "[" + ", ".join(sql_render(c, t) for c, t in cols) + "]"
    sep = "'~~~' || chr(13) || chr(10)"
    return (f"SELECT '{table}' AS table_name, count(*) AS rows, count(*) FILTER (WHERE NOT ("
            f"string_split({rec}, '^|^') = {fields} AND strpos({rec} || {sep}, {sep}) = length({rec}) + 1)) "
            f"AS unsafe_rows FROM {src or table}")


_CRAFTED_SQL = ("(SELECT doc_id, CASE WHEN lang = 'de' THEN text || '^|' ELSE text END AS text, lang, source, n_chars "
                "FROM documents)")


@query("delimiter_check", " UNION ALL ".join([
    _unsafe_sql("documents", TABLE_COLUMNS["documents"]),
    _unsafe_sql("pages", TABLE_COLUMNS["pages"]),
    _unsafe_sql("conversations", TABLE_COLUMNS["conversations"]),
    _unsafe_sql("crafted", TABLE_COLUMNS["documents"], _CRAFTED_SQL),
]))
def delimiter_check_demo(spark, sf):
    out = None
    for name, df in [("documents", load(spark, sf, "documents")), ("pages", load(spark, sf, "pages")),
                     ("conversations", load(spark, sf, "conversations")), ("crafted", _crafted(spark, sf))]:
        part = delimiter_check(df, FMT, name)
        out = part if out is None else out.unionByName(part)
    return out


_DECLARED = {"text": 20000, "lang": 2, "source": 4}


def _length_sql() -> str:
    parts = []
    for c, t in TABLE_COLUMNS["documents"]:
        val = f"CASE WHEN {c} = '' THEN chr(0) ELSE {c} END" if t == "string" else f"CAST({c} AS VARCHAR)"
        lim = _DECLARED.get(c)
        over = f"count(*) FILTER (WHERE strlen({val}) > {lim})" if lim is not None else "0"
        parts.append(f"SELECT '{c}' AS column_name, CAST(max(strlen({val})) AS INTEGER) AS max_len, "
                     f"CAST({over} AS BIGINT) AS over_rows FROM documents")
    return " UNION ALL ".join(parts)


@query("length_check", _length_sql())
def length_check_demo(spark, sf):
    return length_check(load(spark, sf, "documents"), _DECLARED)


_PRIO = {"1-URGENT": "U", "2-HIGH": "H", "3-MEDIUM": "M", "4-NOT SPECIFIED": "N"}


@query("case_map",
       "SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'U' WHEN '2-HIGH' THEN 'H' "
       "WHEN '3-MEDIUM' THEN 'M' WHEN '4-NOT SPECIFIED' THEN 'N' ELSE 'L' END AS prio_code, "
       "CASE WHEN o_totalprice >= 200000 THEN 'high' WHEN o_totalprice >= 50000 THEN 'mid' ELSE 'low' END "
       "AS price_band FROM orders")
def case_map_demo(spark, sf):
    o = load(spark, sf, "orders")
    return o.select("o_orderkey", case_map("o_orderpriority", _PRIO, "L").alias("prio_code"),
                    searched_case([(F.col("o_totalprice") >= 200000, "high"),
                                   (F.col("o_totalprice") >= 50000, "mid")], "low").alias("price_band"))


@query("predicates",
       "SELECT o_orderkey, o_orderstatus, CASE WHEN o_totalprice >= 150000 THEN 1 ELSE 0 END AS big FROM orders "
       "WHERE o_orderstatus IN ('F', 'O') AND NOT (o_orderpriority = '5-LOW') "
       "AND (o_totalprice > 100000 OR o_totalprice <= 1000) AND o_orderdate IS NOT NULL "
       "AND o_custkey <> 0 AND NOT (o_totalprice < 0)")
def predicates_demo(spark, sf):
    o = load(spark, sf, "orders")
    cond = (F.col("o_orderstatus").isin("F", "O") & ~(F.col("o_orderpriority") == "5-LOW")
            & ((F.col("o_totalprice") > 100000) | (F.col("o_totalprice") <= 1000))
            & F.col("o_orderdate").isNotNull() & (F.col("o_custkey") != 0) & ~(F.col("o_totalprice") < 0))
    return o.filter(cond).select("o_orderkey", "o_orderstatus",
                                 iif(F.col("o_totalprice") >= 150000, F.lit(1), F.lit(0)).alias("big"))


# Column names with a dot, a quote, a blank and a backquote.
_ODD = {"o_orderkey": "a.b", "o_orderstatus": "it's", "o_orderpriority": "two words", "o_custkey": "back`tick"}
_ODD_SQL = 'SELECT o_orderkey AS "a.b", o_orderstatus AS "it\'s", o_orderpriority AS "two words", o_custkey AS "back`tick" FROM orders'


@query("odd_names",
       f"SELECT column_name, nulls, distinct_values FROM (VALUES ('a.b', 1), ('it''s', 2), ('two words', 3), "
       f"('back`tick', 4)) v(column_name, i) JOIN (SELECT 1 AS i, count(*) - count(\"a.b\") AS nulls, "
       f"count(DISTINCT \"a.b\") AS distinct_values FROM ({_ODD_SQL}) UNION ALL SELECT 2, count(*) - count(\"it's\"), "
       f"count(DISTINCT \"it's\") FROM ({_ODD_SQL}) UNION ALL SELECT 3, count(*) - count(\"two words\"), "
       f"count(DISTINCT \"two words\") FROM ({_ODD_SQL}) UNION ALL SELECT 4, count(*) - count(\"back`tick\"), "
       f"count(DISTINCT \"back`tick\") FROM ({_ODD_SQL})) USING (i)")
def odd_names_demo(spark, sf):
    """A table with awkward column names is landed, read back and summarised."""
    o = load(spark, sf, "orders")
    odd = o.select(*[F.col(c).alias(n) for c, n in _ODD.items()])
    path = scratch_path(spark, "odd-names")
    write_delimited(odd, path, FMT.with_(header=True))
    back = read_delimited(spark, path, odd.schema, FMT.with_(header=True))
    return column_summary(back, "orders").select("column_name", "nulls", "distinct_values")


@query("unknown_columns",
       "SELECT 'c_phone' AS column_name UNION SELECT 'no_such'")
def unknown_columns_demo(spark, sf):
    """Literal entries of a column list that the table does not have (the strict option's finding)."""
    return unknown_columns(load(spark, sf, "customer"), "c_phone, C_NAME, no_such, c_acct*")
