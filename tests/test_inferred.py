"""Inferred loads in one scan where the guess holds, in two where it does not."""

from pyspark.sql import functions as F

from ferry.plans.transfer import import_inferred, load_inferred, verify_round_trip
from ferry.session import scratch_path
from ferry.sources.delimited import FileFormat, infer_fields, write_delimited

SF = "/root/testdata/sf0.01"
FMT = FileFormat(header=True)


def test_same_types_and_rows_as_two_passes(spark):
    for table in ("part", "orders", "events", "nation"):
        path = scratch_path(spark, f"inferred-{table}")
        write_delimited(spark.read.parquet(f"{SF}/{table}.parquet"), f"{path}/l", FMT)
        for guess_rows in (1, 1_000_000):
            res, fields, scans = load_inferred(spark, f"{path}/l", FMT, f"{path}/t{guess_rows}", guess_rows)
            assert res.error is None and fields == infer_fields(spark, f"{path}/l", FMT)
            if guess_rows > 1:
                assert scans == 1
            back = spark.read.parquet(f"{path}/t{guess_rows}")
            assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in fields] and res.rows == back.count()
            assert verify_round_trip(import_inferred(spark, f"{path}/l", FMT), back).count() == 0


def test_a_late_misfit_takes_a_second_scan_and_loses_nothing(spark):
    path = scratch_path(spark, "misfit")
    df = spark.range(0, 3000, 1, 3).select("id", F.when(F.col("id") == 2999, F.lit("007")).otherwise(F.col("id").cast("string")).alias("code"))
    write_delimited(df, f"{path}/l", FMT)
    res, fields, scans = load_inferred(spark, f"{path}/l", FMT, f"{path}/t", guess_rows=10)
    assert scans == 2 and [f.dataType.simpleString() for f in fields] == ["bigint", "string"]
    assert verify_round_trip(df, spark.read.parquet(f"{path}/t")).count() == 0


def test_empty_and_failing_loads(spark):
    path = scratch_path(spark, "inferred-none")
    write_delimited(spark.range(0), f"{path}/l", FMT)
    res, fields, scans = load_inferred(spark, f"{path}/l", FMT, f"{path}/t")
    assert (res.error, res.rows, scans, [f.name for f in fields]) == (None, 0, 1, ["id"])
    assert load_inferred(spark, f"{path}/nothing", FMT, f"{path}/t2")[0].error is not None
