"""Data records that look like a header are data; update_from and lookup refuse only what a row meets."""

import pytest
from pyspark.sql import functions as F

from ferry.operators.relational import lookup, update_from
from ferry.plans.run import TransferOptions, plan_table, run_export, run_import
from ferry.plans.catalog import TableRef
from ferry.session import scratch_path
from ferry.sources.delimited import FileFormat, known_header_parts, read_delimited, read_header, read_records, write_delimited
from ferry.streaming.landing import stream_import

HEAD = FileFormat(header=True)


@pytest.mark.parametrize("parts", [1, 3])
@pytest.mark.parametrize("compression", [None, "gzip"])
def test_rows_that_equal_the_header_survive(spark, parts, compression):
    df = spark.createDataFrame([("name",), ("x",), ("y",)], "name string").repartition(parts)
    fmt, path = HEAD.with_(compression=compression), scratch_path(spark, "equal")
    write_delimited(df, path, fmt)
    write_delimited(df, path, fmt, mode="append")
    assert len(known_header_parts(spark, path)) == 2 and read_header(spark, path, fmt) == ["name"]
    assert sorted(r.name for r in read_delimited(spark, path, df.schema, fmt).collect()) == ["name", "name", "x", "x", "y", "y"]
    target = scratch_path(spark, "equal-stream")
    for _ in range(2):
        stream_import(spark, path, df.schema, fmt, target, f"equal_{parts}_{compression}")
    assert sorted(r.name for r in spark.read.parquet(target).collect()) == ["name", "name", "x", "x", "y", "y"]


def test_the_whole_transfer_keeps_them(spark):
    base, opts = scratch_path(spark, "equal-run"), TransferOptions(fmt=HEAD, landing_mode="append")
    plan = plan_table(spark, TableRef("dbo", "t", ""), opts, spark.createDataFrame([("n^|^m", "n"), ("n", "m")], "n string, m string").select(
        F.col("m").alias("n"), F.lit("m").alias("m")))
    for rows in (2, 6):
        run_export(spark, [plan], f"{base}/l", opts).collect()
        run_import(spark, [plan], f"{base}/l", f"{base}/t", opts).collect()
    assert read_records(spark, f"{base}/l/dbo.t", HEAD).where("value = 'n^|^m'").count() == 2


def test_foreign_files_lose_their_first_record_only(spark):
    path = scratch_path(spark, "foreign")
    lines = [["a", "x", "a"], ["a", "a"], ["a"], ["y", "a"]]  # the last file has no header of its own
    for i, part in enumerate(lines):
        spark.createDataFrame([(v,) for v in part], "value string").coalesce(1).write.mode("append").option("lineSep", HEAD.line_sep).text(path)
    got = sorted(r.value for r in read_records(spark, path, HEAD, header_text="a").collect())
    assert got == ["a", "a", "a", "x", "y"]


def test_update_from_refuses_two_source_rows_for_a_row(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    source = spark.createDataFrame([(1, "x"), (3, "p"), (3, "q"), (None, "n")], "k int, v string")
    assert sorted(map(tuple, update_from(target, source, ["k"], ["v"]).collect()), key=str) == [(1, "x"), (2, "b"), (None, "c")]
    with pytest.raises(Exception, match="more than one source row"):
        update_from(target, source.unionAll(spark.createDataFrame([(1, "z")], source.schema)), ["k"], ["v"]).collect()
    nulls = spark.createDataFrame([(2, None)], source.schema)
    assert (2, None) in {tuple(r) for r in update_from(target, nulls, ["k"], ["v"]).collect()}


def test_an_ambiguous_lookup_key_that_no_row_asks_for(spark):
    names = spark.createDataFrame([(1, "x"), (2, "p"), (2, "q")], "id int, v string")
    asked = spark.createDataFrame([(1,), (9,), (None,)], "k int")
    assert {r.k: r.o for r in lookup(asked, names, "k", "id", "v", "o").collect()} == {1: "x", 9: None, None: None}
    with pytest.raises(Exception, match="more than one value"):
        lookup(spark.createDataFrame([(2,)], "k int"), names, "k", "id", "v", "o").collect()
