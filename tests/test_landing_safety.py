"""Bad landings are neither published nor loaded; appended ones verify; headers are known by content."""

import glob

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferry.operators.columns import with_flags
from ferry.plans.catalog import SelectionError, TableRef, catalog_from_dir
from ferry.plans.run import TransferOptions, plan_table, plan_transfer, run_export, run_import
from ferry.plans.transfer import import_inferred, verify_round_trip
from ferry.session import scratch_path
from ferry.sources.delimited import (FileFormat, HeaderError, has_data, infer_fields, read_delimited, read_records,
                                     write_delimited)

SF = "/root/testdata/sf0.001"


def test_unsafe_export_publishes_nothing_and_is_refused(spark):
    base = spark.createDataFrame([(1, "x^|^y"), (2, "ok")], "id int, t string")
    opts = TransferOptions()
    plan = plan_table(spark, TableRef("dbo", "u", ""), opts, base)
    landing, target = scratch_path(spark, "u-land"), scratch_path(spark, "u-target")
    assert run_export(spark, [plan], landing, opts).first().error.startswith("1 records")
    assert not glob.glob(f"{landing.removeprefix('file:')}/**/part-*", recursive=True)
    assert "not loaded" in run_import(spark, [plan], landing, target, opts).first().error
    assert not has_data(spark, f"{target}/dbo.u")
    good = plan_table(spark, TableRef("dbo", "u", ""), opts, base.where("id = 2"))
    assert run_export(spark, [good], landing, opts).first().error == "None"
    assert run_import(spark, [good], landing, target, opts).first().error == "None"
    assert spark.read.parquet(f"{target}/dbo.u").count() == 1


def test_appended_landings_verify(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    landing, target = scratch_path(spark, "a-land"), scratch_path(spark, "a-target")
    first, more = TransferOptions(fmt=FileFormat(header=True)), TransferOptions(fmt=FileFormat(header=True), landing_mode="append")
    ref = TableRef("dbo", "orders", "")
    plans = [plan_table(spark, ref, o, orders.where(c)) for o, c in ((first, "o_orderkey % 2 = 0"), (more, "o_orderkey % 2 <> 0"))]
    for o, p in zip((first, more), plans):
        assert run_export(spark, [p], landing, o).first().error == "None"
    report = run_import(spark, [plans[0]], landing, target, first).first()
    assert report.error == "None" and report.rows_copied == orders.count()
    assert verify_round_trip(orders, spark.read.parquet(f"{target}/dbo.orders")).count() == 0


def test_a_failing_target_read_never_restarts_identities(spark):
    src = with_flags(spark.read.parquet(f"{SF}/nation.parquet"), identity=["n_nationkey"])
    opts = TransferOptions(export_identity=False)
    plan = plan_table(spark, TableRef("dbo", "nation", ""), opts, src)
    landing, target = scratch_path(spark, "i-land"), scratch_path(spark, "i-target")
    run_export(spark, [plan], landing, opts).collect()
    src.drop("n_nationkey").write.parquet(f"{target}/dbo.nation")  # a target without the identity column
    report = run_import(spark, [plan], landing, target, opts, targets={"dbo.nation": src.schema}).first()
    assert report.error != "None" and spark.read.parquet(f"{target}/dbo.nation").count() == 25


def test_a_landing_without_header_is_not_read_as_one_with(spark):
    df = spark.range(0, 100).select(F.col("id").alias("n"), F.col("id").cast("string").alias("s")).repartition(4)
    path = scratch_path(spark, "h")
    write_delimited(df, path, FileFormat())
    with pytest.raises(HeaderError):
        read_delimited(spark, path, df.schema, FileFormat(header=True))
    # told the header's text, nothing but that text is left out
    assert read_records(spark, path, FileFormat(header=True), header_text="n^|^s").count() == 100


def test_foreign_file_with_a_header(spark):
    path = scratch_path(spark, "foreign")
    lines = ["n^|^code^|^x", "1^|^007^|^1.5", "2^|^1D^|^2e3", "3^|^ 5^|^NaN"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.option("lineSep", "~~~\r\n").text(path + "/d")
    one = glob.glob(f"{path.removeprefix('file:')}/d/part-*")[0]
    for where in (path + "/d", one):
        back = import_inferred(spark, where, FileFormat(header=True))
        assert dict(back.dtypes) == {"n": "bigint", "code": "string", "x": "double"}
        assert sorted(r.code for r in back.collect()) == [" 5", "007", "1D"]


@pytest.mark.parametrize("values, kind", [
    (["1D", "2F"], T.StringType()), (["007", "12"], T.StringType()), ([" 5", "6"], T.StringType()), (["0", "-12"], T.LongType()),
    (["1.50", "-0.25"], T.DecimalType(3, 2)), (["1E10", "-Infinity"], T.DoubleType()), (["00.5"], T.StringType()),
    (["2020"], T.LongType()), (["0020"], T.StringType()), (["2020-01-31"], T.DateType()), (["2020-01-31 10:00"], T.TimestampNTZType()),
    (["12:30"], T.StringType()), (["5\n"], T.StringType())])
def test_inferred_types_change_no_value(spark, values, kind):
    path = scratch_path(spark, "infer")
    spark.createDataFrame([(v,) for v in values], "v string").coalesce(1).write.option("lineSep", "~~~\r\n").text(path)
    assert infer_fields(spark, path, FileFormat(), ["v"])[0].dataType == kind


def test_strict_unknown_columns(spark):
    catalog = catalog_from_dir(SF, spark=spark)
    choose = dict(schemas="dbo", tables="nation, region")
    plan_transfer(spark, catalog, TransferOptions(columns_except="n_name, x*", strict=True, allow_not_null_exceptions=True), **choose)
    plan_transfer(spark, catalog, TransferOptions(columns_except="typo"), **choose)
    with pytest.raises(SelectionError, match="typo"):
        plan_transfer(spark, catalog, TransferOptions(columns_except="n_name, typo", strict=True), **choose)
