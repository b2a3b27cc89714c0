"""Name lists, wildcards, table choice and column rules."""

import pytest
from pyspark.sql import functions as F

from ferry.functions.text import split_names
from ferry.operators.checks import GuardError, guard_not_null, guard_types, length_check, unique_check
from ferry.operators.columns import (choose_columns, columns_rows, COLUMNS_SCHEMA, exclude_by_flag, exclude_by_name,
                                     exclude_by_type, project_columns, with_flags)
from ferry.operators.names import (flag_exceptions, like_body, match_any, missing_message, missing_names,
                                   pattern_pairs, select_pairs, wildcard_expand, wildcard_match)
from ferry.plans.catalog import SelectionError, TableRef, catalog_from_dir, select_tables

NAMES = ["Alpha", "alpine", "Buzz", "fizz", "a_mid_b", "axmidxb", "Product", "ProductModel", "Address", "x"]


@pytest.fixture(scope="module")
def names(spark):
    return spark.createDataFrame([(n,) for n in NAMES] + [(None,)], "name string")


def _hits(df, patterns, **kw):
    return sorted(r[0] for r in wildcard_match(df, "name", patterns, **kw).collect())


def test_split_names_list_input():
    assert split_names("a, b ,, c") == ["a", "b", "c"]
    assert split_names("a,\r\n b,\r\nc , a") == ["a", "b", "c"]
    assert split_names("") == [] and split_names(None) == []


def test_patterns(names):
    assert _hits(names, "A*") == sorted(["Address", "Alpha", "alpine", "a_mid_b", "axmidxb"])
    assert _hits(names, "*z") == sorted(["Buzz", "fizz"])
    assert _hits(names, "*mid*") == sorted(["a_mid_b", "axmidxb"])
    assert _hits(names, "*") == sorted(NAMES)
    assert _hits(names, "alpha") == sorted(["Alpha"])                 # literal, case-insensitive
    assert _hits(names, "alpha", case_sensitive=True) == sorted([])
    assert _hits(names, "a_mid_b") == sorted(["a_mid_b"])             # literal: "_" is not a wildcard
    assert _hits(names, "a_mid*") == sorted(["a_mid_b", "axmidxb"])   # in a wildcard entry "_" is any char
    assert _hits(names, "Buzz, Buzz, nomatch*") == sorted(["Buzz"])   # duplicate, no-match
    assert _hits(names, "[ab]*") == sorted(["Address", "Alpha", "alpine", "a_mid_b", "axmidxb", "Buzz"])
    assert _hits(names, "[^ab]*") == sorted(["fizz", "Product", "ProductModel", "x"])


def test_like_body_escapes_metacharacters():
    import re
    assert re.fullmatch(like_body("a.b*"), "a.bc") and not re.fullmatch(like_body("a.b*"), "axbc")
    assert re.fullmatch(like_body("(x)*"), "(x)yz")


def test_pattern_pairs_one_row_per_match(names):
    pairs = sorted((r["name"], r["pattern"]) for r in pattern_pairs(names, "name", ["A*", "*a", "x"]).collect())
    assert ("Alpha", "A*") in pairs and ("Alpha", "*a") in pairs and ("x", "x") in pairs
    assert len(pairs) == 5 + 1 + 1  # A* x5, *a: Alpha, x: x


def test_wildcard_expand_keeps_literals(spark, names):
    out = sorted(r[0] for r in wildcard_expand(spark, names, "name", "Product*, NoSuchTable, fizz").collect())
    assert out == ["NoSuchTable", "Product", "ProductModel", "fizz"]


def test_select_pairs_and_flags(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), ("c", "z"), (None, "x")], "a string, b string")
    assert sorted(select_pairs(df, "a", "a, b", "b", "x").collect()) == [("a", "x"), ("b", "x")]
    flagged = {(r.a, r.b): r.is_exception for r in flag_exceptions(df, [("a", "*"), ("c", "z")], ("a", "b")).collect()}
    assert flagged == {("a", "x"): 1, ("a", "y"): 1, ("b", "x"): 0, ("c", "z"): 1, (None, "x"): 0}
    exc = spark.createDataFrame([("a", "y"), ("a", "y")], "a string, b string")
    rows = flag_exceptions(df, exc, ("a", "b")).collect()
    assert len(rows) == 5 and sum(r.is_exception for r in rows) == 1


def test_missing_names(spark, names):
    req = spark.createDataFrame([("ALPHA",), ("nope",)], "name string")
    assert [r[0] for r in missing_names(req, names, "name").collect()] == ["nope"]
    assert missing_message(spark, "alpha, nope, Z*", names, "name", "table") == "table(s) not found: nope"
    assert missing_message(spark, "alpha", names, "name") is None


CATALOG = [TableRef("Sales", "Orders", "p1"), TableRef("Sales", "OrderLines", "p2"), TableRef("HR", "Employee", "p3"),
           TableRef("HR", "EmployeeHistory", "p4"), TableRef("dbo", "Orders", "p5"), TableRef("dbo", "FactSales", "p6")]


def _names(refs):
    return sorted(r.full_name for r in refs)


def test_select_tables_rules():
    assert _names(select_tables(CATALOG, "Sales, HR", "Order*, Employee*", "*", "*History")) == [
        "HR.Employee", "Sales.OrderLines", "Sales.Orders"]
    # a table name that exists only in another schema is silently skipped
    assert _names(select_tables(CATALOG, "HR", "Employee, Orders")) == ["HR.Employee"]
    assert _names(select_tables(CATALOG, "dbo", "*", "dbo", "Fact*")) == ["dbo.Orders"]
    assert len(select_tables(CATALOG, all_tables=True)) == 6
    with pytest.raises(SelectionError):
        select_tables(CATALOG, "Sales", "NoSuchTable")
    with pytest.raises(SelectionError):
        select_tables(CATALOG, "Sales", None)
    with pytest.raises(SelectionError):
        select_tables(CATALOG, "Sales", "Orders", all_tables=True)
    with pytest.raises(SelectionError):
        select_tables(CATALOG, "Sales", "Orders", "Sales", None)
    with pytest.raises(SelectionError):
        select_tables(CATALOG, "Sales", "Orders", "*", "*")


def test_catalog_from_dir():
    refs = catalog_from_dir("/root/testdata/sf0.001")
    assert {r.name for r in refs} >= {"orders", "lineitem"} and {r.schema for r in refs} == {"dbo"}


@pytest.fixture(scope="module")
def flagged(spark):
    df = spark.createDataFrame([(1, "a", 1.0, 2.0), (2, "b", None, 4.0), (3, None, 3.0, 6.0)],
                               "id int, a string, b double, c double")
    return with_flags(df, identity=["id"], computed=["c"], not_null=["a"])


def test_column_rules(spark, flagged):
    assert exclude_by_flag(flagged).columns == ["id", "a", "b"]
    assert exclude_by_flag(flagged, export_identity=False, export_computed=True).columns == ["a", "b", "c"]
    assert exclude_by_name(flagged, "A, nosuch").columns == ["id", "b", "c"]
    assert exclude_by_type(flagged, "double").columns == ["id", "a"]
    assert project_columns(flagged, "c, ID").columns == ["id", "c"]
    assert choose_columns(flagged, exclude_names="b", export_identity=False).columns == ["a"]
    plan = {r.column_name: r for r in spark.createDataFrame(columns_rows("t", flagged, exclude_by_flag(flagged)), COLUMNS_SCHEMA).collect()}
    assert plan["c"].is_computed and not plan["c"].is_exported and plan["a"].is_not_null


def test_guards(spark, flagged):
    nn = {r.column_name: r.null_rows for r in guard_not_null(flagged, ["a", "id"]).collect()}
    assert nn == {"a": 1, "id": 0}
    with pytest.raises(GuardError):
        guard_not_null(flagged, ["a"], raise_on_fail=True)
    df = spark.createDataFrame([("1",), ("x",), (None,), ("3000000000",)], "s string")
    bad = {(r.column_name, r.target_type): r.bad_rows for r in guard_types(df, {"s": "int"}).collect()}
    assert bad == {("s", "int"): 2}
    with pytest.raises(GuardError):
        guard_types(df, {"s": "int"}, raise_on_fail=True)
    lc = {r.column_name: (r.max_len, r.over_rows) for r in length_check(df, {"s": 1}).collect()}
    assert lc == {"s": (10, 1)}
    dup = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert unique_check(dup, ["k"]).collect() == [(1, 2)]
    with pytest.raises(GuardError):
        unique_check(dup, ["k"], raise_on_fail=True)


def test_match_any_literal_list_pushes_down(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = df.filter(match_any("o_orderstatus", "F, O", case_sensitive=True))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(o_orderstatus" in plan


def test_catalog_listing_through_hadoop_fs_and_metastore(spark):
    local = catalog_from_dir("/root/testdata/sf0.001")
    via_fs = catalog_from_dir("/root/testdata/sf0.001", spark=spark)
    assert [(r.schema, r.name) for r in local] == [(r.schema, r.name) for r in via_fs]
    assert via_fs[0].read(spark).count() >= 0
    from ferry.plans.catalog import catalog_from_metastore
    spark.sql("CREATE DATABASE IF NOT EXISTS ferry_t")
    spark.read.parquet("/root/testdata/sf0.001/region.parquet").write.mode("overwrite").saveAsTable("ferry_t.region")
    refs = catalog_from_metastore(spark, ["ferry_t"])
    assert [(r.schema, r.name) for r in refs] == [("ferry_t", "region")] and refs[0].read(spark).count() == 5
    assert _names(select_tables(refs, "ferry_t", "reg*")) == ["ferry_t.region"]
