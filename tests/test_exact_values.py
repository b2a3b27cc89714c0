"""Instants in any zone, nested microseconds, any column name, values with line breaks, pushed filters."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferry.operators.checks import delimiter_check, guard_not_null, guard_types, length_check, unique_check
from ferry.operators.names import flag_exceptions, match_any, missing_names, pattern_pairs, select_pairs, wildcard_expand, wildcard_match
from ferry.operators.numbering import last_in_group, next_key, row_number
from ferry.operators.relational import (agg_string, apply_union, delete_where, insert_select, lookup, merge_insert, object_agg,
                                        outer_apply_flag, update_from, update_set)
from ferry.operators.skew import skew_join
from ferry.plans.catalog import TableRef, column_summary, format_fields, plan_preview
from ferry.plans.run import TransferOptions, plan_table, run_export, run_import
from ferry.plans.transfer import same_content, verify_round_trip
from ferry.session import scratch_path
from ferry.sources.delimited import FileFormat, read_delimited, write_delimited


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_instants_survive_in_any_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        micros = [1730611800_000001, 1730615400_000001, -62135596800_000000, 253402300799_999999, 0, -1, None]  # the repeated hour first
        kind = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("u", T.LongType())])
        df = spark.createDataFrame(list(enumerate(micros)), kind).select(
            "i", F.timestamp_micros("u").alias("t"), F.array(F.timestamp_micros("u")).alias("a"),
            F.struct(F.timestamp_micros("u").alias("x"), F.timestamp_micros("u").cast("timestamp_ntz").alias("n")).alias("s"),
            F.create_map(F.lit("k"), F.timestamp_micros("u")).alias("m"))
        path = scratch_path(spark, "zone")
        write_delimited(df, path, FileFormat())
        back = read_delimited(spark, path, df.schema, FileFormat())
        number = lambda d: sorted(map(tuple, d.select(
            "i", F.unix_micros("t"), F.unix_micros(F.col("a")[0]), F.unix_micros("s.x"), F.col("s.n").cast("string"),
            F.unix_micros(F.col("m")["k"])).collect()))
        assert number(back) == number(df)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_texts_of_other_zones_are_read(spark):
    from ferry.functions.render import parse
    df = spark.createDataFrame([("2024-01-01 00:00:00",), ("2024-01-01 02:00:00+02:00",), ("2024-01-01",), ("2024-01-01T00:00:00Z",)], "t string")
    assert {r[0] for r in df.select(F.unix_micros(parse(F.col("t"), T.TimestampType()))).collect()} == {1704067200_000000}


ODD = ["a.b", "it's", "back`tick", "two words", "x-y[0]"]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, f"v{i % 3}", None if i == 4 else "w", float(i), dt.date(2020, 1, 1)) for i in range(6)]
    return spark.createDataFrame(rows, T.StructType([T.StructField(n, t) for n, t in zip(
        ODD, (T.LongType(), T.StringType(), T.StringType(), T.DoubleType(), T.DateType()))]))


def test_any_column_name(spark, odd):
    a, b, c, d, _ = ODD
    fmt = FileFormat(header=True)
    opts = TransferOptions(fmt=fmt)
    plan = plan_table(spark, TableRef("dbo", "odd", ""), opts, odd)
    landing, target = scratch_path(spark, "odd-l"), scratch_path(spark, "odd-t")
    assert run_export(spark, [plan], landing, opts).first().error == "None"
    assert run_import(spark, [plan], landing, target, opts).first().error == "None"
    back = spark.read.parquet(f"{target}/dbo.odd")
    assert back.columns == ODD and verify_round_trip(odd, back).count() == 0 and same_content(odd, back)
    assert {r.column_name: r.distinct_values for r in column_summary(odd, "o'dd").collect()}[b] == 3
    assert {r.column_name: r.null_rows for r in guard_not_null(odd, ODD).collect()}[c] == 1
    assert {r.column_name: r.bad_rows for r in guard_types(odd, {b: "int", a: "int"}).collect()} == {b: 6, a: 0}
    assert length_check(odd, {b: 1}).where("over_rows = 6").count() == 1
    assert delimiter_check(odd, fmt, "odd").first().unsafe_rows == 0
    assert unique_check(odd, [b, c]).count() == 2
    assert format_fields(odd, fmt).count() == 5 and plan_preview({"odd": odd}, fmt).first().rows == 6
    assert row_number(odd, [a], [b], out="n").where("n = 2").count() == 3
    assert row_number(odd, [a], [b], out="n", hot_rows=2, num_partitions=3).where("n = 2").count() == 3
    assert last_in_group(odd, [a], [b]).where("is_last").count() == 3
    assert next_key(odd, a, [b]).where("next_key = 7").count() == 0
    assert wildcard_match(odd, b, "v0, *1").count() == 4
    assert select_pairs(odd, b, "v0", c, "w").count() == 2
    assert pattern_pairs(odd, b, ["v*"]).count() == 6 and wildcard_expand(spark, odd, b, "v*").count() == 3
    assert flag_exceptions(odd, odd.where(F.col("`a.b`") == 0), (b, c)).where("is_exception = 1").count() == 2
    assert missing_names(odd, odd.where(F.col("`a.b`") < 2), b).count() == 2
    assert update_set(odd, None, **{b: "z"}).where(F.col("`it's`") == "z").count() == 6
    assert update_from(odd, odd.select(F.col("`a.b`"), F.lit("q").alias(b)).limit(2), [a], [b]).where(F.col("`it's`") == "q").count() == 2
    assert insert_select(odd, odd).count() == 12 and merge_insert(odd, odd, [a]).count() == 6
    assert delete_where(odd, F.col("`a.b`") == 1).count() == 5
    assert agg_string(odd, [b], c).count() == 3 and object_agg(odd, [b], a).count() == 3
    assert outer_apply_flag(odd, odd, [(a, a)]).where("flag = 1").count() == 6
    assert apply_union(odd, [(odd, [(a, a)], b), (odd, [(d, d)], c)], "o").where("o = 'w'").count() == 5
    assert lookup(odd, odd, a, a, b, "got").where(F.col("got") == F.col("`it's`")).count() == 6
    for how in ("inner", "left", "left_semi", "left_anti"):
        assert skew_join(odd, odd.select(F.col("`a.b`").alias("k.2")), [(a, "k.2")], how).count() == (0 if how == "left_anti" else 6)


def test_wildcards_span_line_breaks(spark):
    texts = ["one\ntwo the three", "the", "a\nb", "x\n", "x", "THE\r\n", None, "50% off", "k\u212a"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")

    def got(pattern, **kw):
        return {r.t for r in wildcard_match(df, "t", [pattern], **kw).collect()}

    assert got("*the*") == {"one\ntwo the three", "the", "THE\r\n"}
    assert got("*the*", case_sensitive=True) == {"one\ntwo the three", "the"}
    assert got("a*b") == {"a\nb"} and got("x") == {"x"} and got("*x") == {"x"} and got("x*") == {"x\n", "x"}
    assert got("*_x*") == set() and got("_") == set() and got("*_") == {t for t in texts if t}
    assert got("kk") == {"k\u212a"} and got("k*") == {"k\u212a"}  # the Kelvin sign is a k in lower case
    assert got("[xa]*") == {"a\nb", "x\n", "x"} and got("*") == {t for t in texts if t is not None}


def test_lists_reach_the_scan(spark):
    part = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    pushed = lambda df: [x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if "PushedFilters" in x][0]
    assert "StringStartsWith(p_type" in pushed(part.where(match_any("p_type", "ECONOMY, promo")))
    assert "StringStartsWith(p_type" in pushed(part.where(match_any("p_type", "eco*")))
    assert "In(p_type" in pushed(part.where(match_any("p_type", "ECONOMY, PROMO", case_sensitive=True)))
