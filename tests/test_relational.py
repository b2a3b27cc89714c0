"""Table changes, aggregates and apply/lookup joins on small literal tables."""

import json

from pyspark.sql import functions as F

from ferry.operators.checks import all_children_flag
from ferry.operators.relational import (agg_string, apply_union, case_map, delete_where, distinct_union,
                                        existing_pairs, insert_select, insert_values, lookup, merge_insert,
                                        object_agg, outer_apply_flag, replace_table, searched_case, update_from,
                                        update_set)
from ferry.functions.text import charindex, concat_nn, quote_name, split_explode, tsql_len
from ferry.session import scratch_path


def test_merge_insert_only_new_keys(spark):
    tgt = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    src = spark.createDataFrame([(2, "B"), (3, "c"), (3, "c2"), (None, "n")], "k int, v string")
    out = sorted(merge_insert(tgt, src, ["k"]).collect(), key=lambda r: (r.k is None, r.k or 0, r.v))
    assert [tuple(r) for r in out] == [(1, "a"), (2, "b"), (3, "c"), (3, "c2"), (None, "n")]


def test_update_delete_insert(spark):
    df = spark.createDataFrame([(1, "x", 10.0), (2, None, 20.0), (3, "y", None)], "id int, s string, d double")
    up = {r.id: r.s for r in update_set(df, F.col("d") > 15, s="big").collect()}
    assert up == {1: "x", 2: "big", 3: "y"}
    assert sorted(r.id for r in delete_where(df, F.col("d") > 15).collect()) == [1, 3]  # NULL cond keeps row 3
    src = spark.createDataFrame([(3, "z")], "id int, s string")
    assert {r.id: r.s for r in update_from(df, src, ["id"], ["s"]).collect()} == {1: "x", 2: None, 3: "z"}
    assert insert_values(spark, df, [(4, "w", 1.5)]).count() == 4
    ins = insert_select(df, spark.createDataFrame([(9,)], "id int"))
    assert ins.filter("id = 9").collect()[0].s is None


def test_replace_table(spark):
    path = scratch_path(spark, "t-replace")
    replace_table(spark.createDataFrame([(1,)], "a int"), path)
    out = replace_table(spark.createDataFrame([(2,), (3,)], "a int"), path)
    assert sorted(r.a for r in out.collect()) == [2, 3]


def test_agg_string_and_object_agg(spark):
    df = spark.createDataFrame([("g", "b"), ("g", "a"), ("g", "b"), ("h", None), ("h", "c")], "g string, v string")
    assert dict(agg_string(df, ["g"], "v", ",", distinct=True).collect()) == {"g": "a,b", "h": "c"}
    assert dict(agg_string(df, ["g"], "v", "|", distinct=False).collect()) == {"g": "a|b|b", "h": "c"}
    objs = dict(object_agg(df.filter("v is not null"), ["g"], "v", columns=["v"]).collect())
    assert json.loads(objs["g"]) == [{"v": "a"}, {"v": "b"}, {"v": "b"}]


def test_outer_apply_never_duplicates(spark):
    left = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    right = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "k2 int, t string")
    out = dict(outer_apply_flag(left, right, [("k", "k2")], F.col("t") == "x").collect())
    assert out == {1: 1, 2: 0, 3: 0}


def test_apply_union_and_lookup(spark):
    left = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    a = spark.createDataFrame([(1, "base")], "id int, name string")
    b = spark.createDataFrame([(2, "udt")], "id int, name string")
    out = dict(apply_union(left, [(a, [("k", "id")], "name"), (b, [("k", "id")], "name")], "resolved").collect())
    assert out == {1: "base", 2: "udt", 3: None}
    lk = dict(lookup(left, a, "k", "id", "name", "nm").select("k", "nm").collect())
    assert lk == {1: "base", 2: None, 3: None}


def test_existing_pairs_and_sets(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "y"), ("c", "x")], "p string, q string")
    assert sorted(existing_pairs(df, "p", ["a", "b"], "q", ["x", "z"]).collect()) == [("a", "x")]
    u = distinct_union(df.select("p"), df.select("q"))
    assert sorted(r[0] for r in u.collect()) == ["a", "b", "c", "x", "y"]


def test_case_and_all_children(spark):
    df = spark.createDataFrame([(1, "F"), (1, "F"), (2, "F"), (2, "O"), (3, None)], "o int, s string")
    flags = dict(all_children_flag(df, ["o"], F.col("s") == "F").collect())
    assert flags == {1: True, 2: False, 3: False}
    out = df.select(case_map("s", {"F": "fin"}, "other").alias("c"),
                    searched_case([(F.col("o") > 2, "hi")], "lo").alias("d")).collect()
    assert out[0] == ("fin", "lo") and out[-1] == ("other", "hi")


def test_scalar_helpers(spark):
    row = spark.createDataFrame([("ab]c  ", None)], "s string, n string").select(
        tsql_len("s").alias("len"), charindex("]", "s").alias("ci"), concat_nn("s", "n", F.lit(1)).alias("cc"),
        quote_name("s").alias("q")).collect()[0]
    assert row == (4, 3, "ab]c  1", "[ab]]c  ]")
    parts = spark.createDataFrame([("a, b ,, c",)], "s string").select(split_explode("s", ",").alias("p"))
    assert [r.p for r in parts.collect()] == ["a", "b", "c"]


def test_agg_string_splits_a_hot_group(spark):
    from ferry.operators.relational import agg_string
    rows = [("hot", f"v{i:05d}") for i in range(3000)] + [("cold", "b"), ("cold", "a"), ("cold", "a")]
    df = spark.createDataFrame(rows, "g string, v string")
    got = dict(agg_string(df, ["g"], "v", "|", distinct=True, num_partitions=6).collect())
    assert got["cold"] == "a|b"
    assert got["hot"] == "|".join(f"v{i:05d}" for i in range(3000))
    assert dict(agg_string(df, ["g"], "v", ",", distinct=False, num_partitions=6).collect())["cold"] == "a,a,b"


def test_agg_string_orders_numbers_as_numbers(spark):
    from ferry.operators.relational import agg_string
    df = spark.createDataFrame([(1, 10), (1, 9), (1, 100), (2, -1)], "g int, v int")
    assert dict(agg_string(df, ["g"], "v", ",").collect()) == {1: "9,10,100", 2: "-1"}


def test_ties_do_not_depend_on_the_partition_count(spark):
    from ferry.operators.relational import ordered_concat
    rows = [("g", i % 3, f"text {i}") for i in range(400)]
    df = spark.createDataFrame(rows, "g string, o int, t string").repartition(5)
    one, many = (ordered_concat(df, ["g"], "o", "t", "|", num_partitions=n).first().concat for n in (1, 8))
    assert one == many and sorted(one.split("|")) == sorted(r[2] for r in rows)
    long = [("g", ("p" * 70) + str(i % 50), f"v{i}") for i in range(200)] + [("g", "p" * 64, f"s{i}") for i in range(50)]
    df = spark.createDataFrame(long, "g string, o string, t string").repartition(4)
    got = [ordered_concat(df, ["g"], "o", "t", "|", num_partitions=n).first().concat.split("|") for n in (1, 8)]
    order = {t: o for _, o, t in long}
    assert got[0] == got[1] and [order[t] for t in got[0]] == sorted(order[t] for t in got[0])


def test_update_sees_the_old_row_and_checks_names(spark):
    import pytest
    df = spark.createDataFrame([(1, 0), (3, 0)], "a int, b int")
    assert sorted(map(tuple, update_set(df, F.col("a") == 1, a=2, b=9).collect())) == [(2, 9), (3, 0)]
    assert sorted(map(tuple, update_set(df, None, b=F.col("a"), A=0).collect())) == [(0, 1), (0, 3)]
    with pytest.raises(ValueError):
        update_set(df, None, nothing=1)


def test_insert_matches_names_without_case(spark):
    import pytest
    target = spark.createDataFrame([(1, "a")], "id int, name string")
    rows = spark.createDataFrame([("b", 2)], "NAME string, ID int")
    assert sorted(map(tuple, insert_select(target, rows).collect())) == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError):
        insert_select(target, rows.withColumnRenamed("ID", "idd"))


def test_apply_keeps_every_match_and_lookup_refuses_two_values(spark):
    import pytest
    left = spark.createDataFrame([(1, 5), (2, 5), (None, 6)], "k int, j int")
    a = spark.createDataFrame([(1, "x"), (1, "y"), (1, "x")], "id int, v string")
    b = spark.createDataFrame([(1, "z"), (2, None)], "id int, v string")
    c = spark.createDataFrame([(5, "x"), (6, "w")], "id int, v string")
    key = [("k", "id")]
    got = sorted(((r.k, r.j, r.o) for r in apply_union(left, [(a, key, "v"), (b, key, "v")], "o").collect()), key=str)
    assert got == sorted([(1, 5, "x"), (1, 5, "y"), (1, 5, "z"), (2, 5, None), (None, 6, None)], key=str)
    got = sorted(((r.k, r.j, r.o) for r in apply_union(left, [(a, key, "v"), (b, key, "v"), (c, [("j", "id")], "v")], "o").collect()), key=str)
    assert got == sorted([(1, 5, "x"), (1, 5, "y"), (1, 5, "z"), (2, 5, None), (2, 5, "x"), (None, 6, "w")], key=str)
    same = spark.createDataFrame([(1, "x"), (1, "x")], "id int, v string")
    assert {r.k: r.o for r in lookup(left, same, "k", "id", "v", "o").collect()} == {1: "x", 2: None, None: None}
    for bad in (a, spark.createDataFrame([(1, "x"), (1, None)], "id int, v string")):
        with pytest.raises(Exception, match="more than one value"):
            lookup(left, bad, "k", "id", "v", "o").collect()
