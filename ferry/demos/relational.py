"""Demo queries for joins, aggregates, windows, set operations and table changes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ferry.demos.common import load
from ferry.functions.collation import count_collated, join_collated
from ferry.functions.text import charindex, concat_nn, quote_name, replace_text, split_explode, tsql_len
from ferry.operators.checks import unique_check
from ferry.operators.numbering import last_in_group, next_key, row_number
from ferry.operators.relational import (agg_string, apply_union, count_where, delete_where, distinct_union,
                                        existing_pairs, insert_select, insert_values, lookup, merge_insert,
                                        outer_apply_flag, replace_table, update_from, update_set)
from ferry.operators.patterns import pattern_join
from ferry.operators.skew import skew_join
from ferry.operators.uniqueness import UniqueAppender
from ferry.session import scratch_path
from ferry.sources.versions import VersionedTable

Q: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        Q[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------- joins

@query("join_inner",
       "SELECT l_orderkey, l_linenumber, l_partkey, c_custkey, n_name, r_name FROM lineitem "
       "JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey "
       "JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def join_inner(spark, sf):
    li, o, c = load(spark, sf, "lineitem"), load(spark, sf, "orders"), load(spark, sf, "customer")
    n, r = load(spark, sf, "nation"), load(spark, sf, "region")
    oc = skew_join(o.select("o_orderkey", "o_custkey"), c.select("c_custkey", "c_nationkey"),
                   [("o_custkey", "c_custkey")])
    loc = skew_join(li.select("l_orderkey", "l_linenumber", "l_partkey"), oc, [("l_orderkey", "o_orderkey")])
    return (loc.join(n, loc.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
            .select("l_orderkey", "l_linenumber", "l_partkey", F.col("o_custkey").alias("c_custkey"), "n_name",
                    "r_name"))


@query("join_left",
       "SELECT o_orderkey, c_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey "
       "AND c_mktsegment = 'BUILDING'")
def join_left(spark, sf):
    o, c = load(spark, sf, "orders"), load(spark, sf, "customer")
    # the extra ON condition only restricts the right side, so it is applied there
    building = c.filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey", "c_name")
    return skew_join(o.select("o_orderkey", "o_custkey"), building, [("o_custkey", "c_custkey")], "left").select(
        "o_orderkey", "c_name")


@query("join_anti",
       "SELECT * FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def join_anti(spark, sf):
    d, lab = load(spark, sf, "documents"), load(spark, sf, "labels")
    return skew_join(d, lab.select("doc_id"), ["doc_id"], "left_anti")


@query("join_semi",
       "SELECT * FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey "
       "AND o_totalprice > 300000)")
def join_semi(spark, sf):
    c, o = load(spark, sf, "customer"), load(spark, sf, "orders")
    big = o.filter(F.col("o_totalprice") > 300000).select("o_custkey")
    return skew_join(c, big, [("c_custkey", "o_custkey")], "left_semi")


_REGIONS = ["ASIA", "EUROPE", "AMERICA"]
_SEGMENTS = ["BUILDING", "MACHINERY"]


@query("join_cross",
       "SELECT r_name, c_mktsegment FROM (VALUES ('ASIA'), ('EUROPE'), ('AMERICA')) a(r_name) "
       "CROSS JOIN (VALUES ('BUILDING'), ('MACHINERY')) b(c_mktsegment) WHERE EXISTS ("
       "SELECT 1 FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey "
       "WHERE region.r_name = a.r_name AND customer.c_mktsegment = b.c_mktsegment)")
def join_cross(spark, sf):
    c, n, r = load(spark, sf, "customer"), load(spark, sf, "nation"), load(spark, sf, "region")
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return existing_pairs(j, "r_name", _REGIONS, "c_mktsegment", _SEGMENTS)


@query("lookup_id",
       "SELECT s_suppkey, n_name AS nation_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey")
def lookup_id(spark, sf):
    s, n = load(spark, sf, "supplier"), load(spark, sf, "nation")
    return lookup(s, n, "s_nationkey", "n_nationkey", "n_name", "nation_name").select("s_suppkey", "nation_name")


@query("outer_apply",
       "SELECT o_orderkey, CASE WHEN EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey "
       "AND c_mktsegment = 'BUILDING') THEN 1 ELSE 0 END AS flag FROM orders")
def outer_apply(spark, sf):
    o, c = load(spark, sf, "orders"), load(spark, sf, "customer")
    return outer_apply_flag(o, c, [("o_custkey", "c_custkey")], F.col("c_mktsegment") == "BUILDING").select(
        "o_orderkey", "flag")


@query("apply_union",
       "SELECT o_orderkey, x.label FROM orders LEFT JOIN LATERAL ("
       "SELECT c_name AS label FROM customer WHERE c_custkey = o_custkey AND c_mktsegment = 'BUILDING' "
       "UNION SELECT n_name FROM customer JOIN nation ON c_nationkey = n_nationkey "
       "WHERE c_custkey = o_custkey AND c_mktsegment <> 'BUILDING') x ON true")
def apply_union_demo(spark, sf):
    o, c, n = load(spark, sf, "orders"), load(spark, sf, "customer"), load(spark, sf, "nation")
    base = c.filter(F.col("c_mktsegment") == "BUILDING")
    other = c.filter(F.col("c_mktsegment") != "BUILDING").join(n, c.c_nationkey == n.n_nationkey)
    return apply_union(o, [(base, [("o_custkey", "c_custkey")], "c_name"),
                           (other, [("o_custkey", "c_custkey")], "n_name")], "label").select("o_orderkey", "label")


@query("apply_matches",
       "SELECT o_orderkey, x.label FROM orders LEFT JOIN LATERAL ("
       "SELECT c_name AS label FROM customer WHERE c_custkey = o_custkey "
       "UNION SELECT c_mktsegment FROM customer WHERE c_custkey = o_custkey AND c_acctbal > 0 "
       "UNION SELECT l_returnflag FROM lineitem WHERE l_orderkey = o_orderkey) x ON true")
def apply_matches(spark, sf):
    """Several branches match one row, two of them by one column and one by another."""
    o, c, li = load(spark, sf, "orders"), load(spark, sf, "customer"), load(spark, sf, "lineitem")
    by_customer = [("o_custkey", "c_custkey")]
    return apply_union(o, [(c, by_customer, "c_name"), (c.filter(F.col("c_acctbal") > 0), by_customer, "c_mktsegment"),
                           (li, [("o_orderkey", "l_orderkey")], "l_returnflag")], "label").select("o_orderkey", "label")


# ---------------------------------------------------------------- aggregates, sets, windows

@query("agg_count",
       "SELECT o_orderstatus, count(*) AS orders, count(*) FILTER (WHERE o_totalprice > 200000) AS big_orders "
       "FROM orders GROUP BY o_orderstatus")
def agg_count(spark, sf):
    o = load(spark, sf, "orders")
    return o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"),
                                          count_where(F.col("o_totalprice") > 200000, "big_orders"))


@query("agg_minmax",
       "SELECT l_returnflag, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship, "
       "min(l_quantity) AS min_qty, max(l_quantity) AS max_qty FROM lineitem GROUP BY l_returnflag")
def agg_minmax(spark, sf):
    li = load(spark, sf, "lineitem")
    return li.groupBy("l_returnflag").agg(F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"),
                                          F.min("l_quantity").alias("min_qty"), F.max("l_quantity").alias("max_qty"))


@query("next_key",
       "SELECT o_orderkey, o_custkey, coalesce(min(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey "
       "ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), o_orderkey + 1) AS next_key FROM orders")
def next_key_demo(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return next_key(o, "o_orderkey", ["o_custkey"])


@query("agg_string",
       "SELECT o_orderstatus, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS priorities "
       "FROM orders GROUP BY o_orderstatus")
def agg_string_demo(spark, sf):
    return agg_string(load(spark, sf, "orders"), ["o_orderstatus"], "o_orderpriority", ",", out="priorities",
                      distinct=True)


@query("agg_string_all",
       "SELECT c_nationkey, string_agg(c_mktsegment, '|' ORDER BY c_mktsegment) AS segments FROM customer "
       "GROUP BY c_nationkey")
def agg_string_all(spark, sf):
    return agg_string(load(spark, sf, "customer"), ["c_nationkey"], "c_mktsegment", "|", out="segments")


@query("distinct", "SELECT DISTINCT c_mktsegment, c_nationkey FROM customer")
def distinct_demo(spark, sf):
    return load(spark, sf, "customer").select("c_mktsegment", "c_nationkey").distinct()


@query("union_distinct",
       "SELECT s_nationkey AS nationkey FROM supplier UNION SELECT c_nationkey FROM customer")
def union_distinct(spark, sf):
    s, c = load(spark, sf, "supplier"), load(spark, sf, "customer")
    return distinct_union(s.select(F.col("s_nationkey").alias("nationkey")),
                          c.select(F.col("c_nationkey").alias("nationkey")))


@query("row_number_part",
       "SELECT row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn, o_orderkey, "
       "o_custkey FROM orders")
def row_number_part(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return row_number(o, ["o_orderdate", "o_orderkey"], ["o_custkey"], out="rn").select("rn", "o_orderkey",
                                                                                         "o_custkey")


@query("row_number_all",
       "SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber) AS rn, l_orderkey, l_linenumber FROM lineitem")
def row_number_all(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return row_number(li, ["l_orderkey", "l_linenumber"], out="rn")


@query("lead_last",
       "SELECT l_orderkey, l_linenumber, lead(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) "
       "IS NULL AS is_last FROM lineitem")
def lead_last(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return last_in_group(li, ["l_linenumber"], ["l_orderkey"])


@query("sort", "SELECT * FROM orders ORDER BY o_orderdate DESC, o_orderkey")
def sort_demo(spark, sf):
    return load(spark, sf, "orders").orderBy(F.col("o_orderdate").desc(), "o_orderkey")


@query("unique_check", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 1")
def unique_check_demo(spark, sf):
    return unique_check(load(spark, sf, "orders"), ["o_custkey"])


# ---------------------------------------------------------------- table changes

@query("update_set",
       "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, "
       "CASE WHEN o_orderstatus = 'P' AND o_totalprice > 200000 THEN '1-URGENT' ELSE o_orderpriority END "
       "AS o_orderpriority FROM orders")
def update_set_demo(spark, sf):
    o = load(spark, sf, "orders")
    return update_set(o, (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 200000),
                      o_orderpriority="1-URGENT")


@query("update_two",
       "SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'P' THEN 'X' ELSE o_orderstatus END AS o_orderstatus, "
       "o_totalprice, o_orderdate, CASE WHEN o_orderstatus = 'P' THEN o_orderstatus || '/' || o_orderpriority "
       "ELSE o_orderpriority END AS o_orderpriority FROM orders")
def update_two(spark, sf):
    """Condition and second expression use a column that the first assignment changes."""
    return update_set(load(spark, sf, "orders"), F.col("o_orderstatus") == "P", O_ORDERSTATUS="X",
                      o_orderpriority=F.concat("o_orderstatus", F.lit("/"), "o_orderpriority"))


@query("insert_other_case",
       "SELECT n_nationkey, n_name, n_regionkey FROM nation UNION ALL "
       "SELECT s_suppkey + 1000, s_name, NULL FROM supplier")
def insert_other_case(spark, sf):
    rows = load(spark, sf, "supplier").select(F.col("s_name").alias("N_NAME"),
                                              (F.col("s_suppkey") + 1000).alias("N_NationKey"))
    return insert_select(load(spark, sf, "nation"), rows)


@query("delete_where",
       "SELECT * FROM orders WHERE NOT coalesce(o_orderstatus = 'F' AND o_orderpriority LIKE '5%', false)")
def delete_where_demo(spark, sf):
    o = load(spark, sf, "orders")
    return delete_where(o, (F.col("o_orderstatus") == "F") & F.col("o_orderpriority").startswith("5"))


_HAS_P = "EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')"


@query("merge_insert",
       f"SELECT * FROM customer WHERE {_HAS_P} UNION ALL "
       f"SELECT * FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND NOT {_HAS_P}")
def merge_insert_demo(spark, sf):
    c, o = load(spark, sf, "customer"), load(spark, sf, "orders")
    target = skew_join(c, o.filter(F.col("o_orderstatus") == "P"), [("c_custkey", "o_custkey")], "left_semi")
    source = c.filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
    return merge_insert(target, source, ["c_custkey"])


@query("insert_select",
       "SELECT * FROM nation UNION ALL SELECT * FROM (VALUES (25, 'ATLANTIS', 0), (26, 'LEMURIA', 2)) "
       "v(n_nationkey, n_name, n_regionkey) UNION ALL "
       "SELECT r_regionkey + 100 AS n_nationkey, r_name AS n_name, r_regionkey AS n_regionkey FROM region")
def insert_select_demo(spark, sf):
    n, r = load(spark, sf, "nation"), load(spark, sf, "region")
    with_values = insert_values(spark, n, [(25, "ATLANTIS", 0), (26, "LEMURIA", 2)])
    from_region = r.select((F.col("r_regionkey") + 100).alias("n_nationkey"), F.col("r_name").alias("n_name"),
                           F.col("r_regionkey").alias("n_regionkey"))
    return insert_select(with_values, from_region)


@query("replace_table",
       "SELECT r_name, count(*) AS nations FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name")
def replace_table_demo(spark, sf):
    n, r = load(spark, sf, "nation"), load(spark, sf, "region")
    path = scratch_path(spark, "replace")
    replace_table(n.groupBy(F.col("n_regionkey").cast("string").alias("r_name")).agg(
        F.count(F.lit(1)).alias("nations")), path)
    second = n.join(r, n.n_regionkey == r.r_regionkey).groupBy("r_name").agg(F.count(F.lit(1)).alias("nations"))
    return replace_table(second, path)


@query("update_from",
       "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, coalesce(c_mktsegment, o_orderpriority) "
       "AS o_orderpriority FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_mktsegment = 'BUILDING'")
def update_from_demo(spark, sf):
    c = load(spark, sf, "customer").where("c_mktsegment = 'BUILDING'")
    source = c.select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("o_orderpriority"))
    return update_from(load(spark, sf, "orders"), source, ["o_custkey"], ["o_orderpriority"])


@query("update_files",
       "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, CASE WHEN o_orderkey < 100 THEN "
       "o_orderstatus || '!' ELSE o_orderpriority END AS o_orderpriority FROM orders "
       "WHERE NOT (o_orderkey >= 200 AND o_orderkey < 300)")
def update_files(spark, sf):
    """An update and a delete in a table of 20 files; of these, only those with such rows are written anew."""
    table = VersionedTable(spark, scratch_path(spark, "update-files"))
    table.replace(load(spark, sf, "orders").repartitionByRange(20, "o_orderkey"))
    table.update(F.col("o_orderkey") < 100, o_orderpriority=F.concat("o_orderstatus", F.lit("!")))
    table.delete((F.col("o_orderkey") >= 200) & (F.col("o_orderkey") < 300))
    return table.read()


@query("table_versions",
       "SELECT 1 AS version, count(*) AS rows, min(c_custkey) AS first, max(c_custkey) AS last FROM customer WHERE c_nationkey < 10 "
       "UNION ALL SELECT 2, count(*), min(c_custkey), max(c_custkey) FROM customer WHERE c_nationkey < 15 "
       "UNION ALL SELECT 3, count(*), min(c_custkey), max(c_custkey) FROM customer WHERE c_nationkey IS NOT NULL "
       "UNION ALL SELECT 4, count(*), min(c_custkey), max(c_custkey) FROM customer WHERE c_nationkey = 3")
def table_versions(spark, sf):
    """Replace, append a batch (twice, counted once), merge, replace again; every version stays readable."""
    c = load(spark, sf, "customer")
    table = VersionedTable(spark, scratch_path(spark, "table-versions"))
    table.replace(c.where("c_nationkey < 10"))
    for _ in range(2):
        table.append(c.where("c_nationkey >= 10 and c_nationkey < 15"), batch="second")
    table.merge_insert(c.where("c_nationkey >= 12"), ["c_custkey"])
    table.replace(c.where("c_nationkey = 3"), expect=3)
    found = [table.read(v).agg(F.lit(v).alias("version"), F.count(F.lit(1)).alias("rows"), F.min("c_custkey").alias("first"),
                               F.max("c_custkey").alias("last")) for v in range(1, table.version() + 1)]
    return reduce(lambda a, b: a.unionAll(b), found)


@query("unique_append",
       "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem b WHERE l_linestatus = 'F' AND EXISTS ("
       "SELECT 1 FROM lineitem s WHERE s.l_returnflag <> 'N' AND s.l_orderkey = b.l_orderkey AND s.l_linenumber = b.l_linenumber)")
def unique_append(spark, sf):
    """Keys of a batch that are stored already, found by the Bloom filter of the stored keys and an exact look-up."""
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    path = scratch_path(spark, "unique-append")
    li.where("l_returnflag <> 'N'").write.parquet(path)
    return UniqueAppender(spark, path, ["l_orderkey", "l_linenumber"]).conflicts(li.where("l_linestatus = 'F'"))


# ---------------------------------------------------------------- patterns from a table, collations

@query("join_patterns",
       "WITH p AS (SELECT DISTINCT regexp_replace(substr(text, 1, 30), '[*%_\\[\\]^]', '', 'g') AS part FROM "
       "(SELECT text FROM documents UNION ALL SELECT text FROM benchmark) WHERE length(text) >= 30) "
       "SELECT doc_id, '*' || part || '*' AS pattern FROM documents JOIN p ON contains(lower(text), lower(part)) WHERE part <> ''")
def join_patterns(spark, sf):
    """Every document with the patterns that it matches, out of those made from all beginnings of texts."""
    d, b = load(spark, sf, "documents"), load(spark, sf, "benchmark")
    part = F.regexp_replace(F.substring("text", 1, 30), r"[*%_\[\]^]", "")
    parts = d.select("text").unionAll(b.select("text")).where(F.length("text") >= 30).select(part.alias("part")).where("part <> ''")
    patterns = parts.select(F.concat(F.lit("*"), "part", F.lit("*")).alias("pattern"))
    return pattern_join(d, "text", patterns, "pattern").select("doc_id", "pattern")


_SPELT = ("CASE c_custkey % 4 WHEN 0 THEN c_mktsegment WHEN 1 THEN lower(c_mktsegment) "
          "WHEN 2 THEN replace(c_mktsegment, 'U', 'Ü') || '  ' ELSE c_mktsegment || ' ' END")


@query("collate_groups",
       f"WITH v AS (SELECT {_SPELT} AS segment FROM customer) "
       "SELECT 'AI' AS accents, min(segment) AS segment, count(*) AS n FROM v GROUP BY strip_accents(lower(rtrim(segment))) "
       "UNION ALL SELECT 'AS', min(segment), count(*) FROM v GROUP BY lower(rtrim(segment))")
def collate_groups(spark, sf):
    """Groups of spellings: without case and end blanks, with and without accents."""
    v = load(spark, sf, "customer").select(F.expr(_SPELT).alias("segment"))
    return (count_collated(v, "segment", "Latin1_General_CI_AI").select(F.lit("AI").alias("accents"), "segment", "n")
            .unionAll(count_collated(v, "segment", "Latin1_General_CI_AS").select(F.lit("AS"), "segment", "n")))


@query("collate_join",
       f"WITH v AS (SELECT c_custkey, {_SPELT} AS segment FROM customer), s AS ("
       "SELECT DISTINCT c_mktsegment AS name, length(c_mktsegment)::BIGINT AS letters FROM customer) "
       "SELECT c_custkey, segment, name, letters FROM v JOIN s ON lower(rtrim(segment)) = lower(rtrim(name))")
def collate_join(spark, sf):
    c = load(spark, sf, "customer")
    names = c.select(F.col("c_mktsegment").alias("name"), F.length("c_mktsegment").cast("long").alias("letters")).distinct()
    return join_collated(c.select("c_custkey", F.expr(_SPELT).alias("segment")), names, [("segment", "name")])


# ---------------------------------------------------------------- scalar functions

@query("split_explode",
       "SELECT doc_id, count(*) AS n_lines FROM (SELECT doc_id, trim(unnest(string_split(text, chr(10)))) AS line "
       "FROM documents) WHERE length(line) > 0 GROUP BY doc_id")
def split_explode_demo(spark, sf):
    d = load(spark, sf, "documents")
    lines = d.select("doc_id", split_explode("text", "\n").alias("line"))
    return lines.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_lines"))


@query("quote_name",
       "SELECT n_nationkey, '[' || replace(r_name, ']', ']]') || '].[' || replace(n_name, ']', ']]') || ']' "
       "AS qualified FROM nation JOIN region ON n_regionkey = r_regionkey")
def quote_name_demo(spark, sf):
    n, r = load(spark, sf, "nation"), load(spark, sf, "region")
    j = n.join(r, n.n_regionkey == r.r_regionkey)
    return j.select("n_nationkey", F.concat(quote_name("r_name"), F.lit("."), quote_name("n_name")).alias("qualified"))


@query("scalar_text",
       "SELECT o_orderkey, length(rtrim(o_orderpriority || '  ')) AS len, strpos(o_orderpriority, '-') AS dash, "
       "replace(o_orderpriority, '-', ' / ') AS replaced, o_orderstatus || '' || CAST(o_custkey AS VARCHAR) AS joined, "
       "substr(o_orderpriority, 3, 4) AS part, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS rank, "
       "chr(CAST(64 + o_orderkey % 26 + 1 AS INTEGER)) AS letter, CAST(o_orderkey AS VARCHAR) AS key_text FROM orders")
def scalar_text(spark, sf):
    """LEN, CHARINDEX, REPLACE, CONCAT (NULL as empty), SUBSTRING, CAST, CHAR and TO_VARCHAR."""
    o = load(spark, sf, "orders")
    priority = F.col("o_orderpriority")
    return o.select("o_orderkey", tsql_len(F.concat(priority, F.lit("  "))).alias("len"),
                    charindex("-", "o_orderpriority").cast("long").alias("dash"),
                    replace_text("o_orderpriority", "-", " / ").alias("replaced"),
                    concat_nn("o_orderstatus", F.lit(None), "o_custkey").alias("joined"),
                    F.substring(priority, 3, 4).alias("part"), F.substring(priority, 1, 1).cast("int").alias("rank"),
                    F.chr(F.lit(64) + F.col("o_orderkey") % 26 + 1).alias("letter"),
                    F.col("o_orderkey").cast("string").alias("key_text"))
