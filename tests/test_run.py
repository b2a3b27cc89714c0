"""The whole transfer flow on the driver tables (sf0.001)."""

from pyspark.sql import functions as F

from ferry.operators.columns import with_flags
from ferry.plans.catalog import TableRef, catalog_from_dir
from ferry.plans.run import (TransferOptions, columns_report, plan_table, plan_transfer, run_export, run_import,
                             what_if)
from ferry.plans.transfer import verify_round_trip
from ferry.session import scratch_path
from ferry.sources.delimited import FileFormat

SF = "/root/testdata/sf0.001"


def test_export_and_import_chosen_tables(spark):
    opts = TransferOptions(fmt=FileFormat(header=True), columns_except="*comment*", parallel=4)
    plans = plan_transfer(spark, catalog_from_dir(SF), opts, schemas="dbo", tables="orders, line*, nation",
                          schemas_except="dbo", tables_except="nation")
    assert sorted(p.name for p in plans) == ["dbo.lineitem", "dbo.orders"]
    preview = {r.table_name: r.rows for r in what_if(plans, opts).collect()}
    landing, target = scratch_path(spark, "run-land"), scratch_path(spark, "run-target")
    ex = {r.table_name: r for r in run_export(spark, plans, landing, opts).collect()}
    im = {r.table_name: r for r in run_import(spark, plans, landing, target, opts).collect()}
    for p in plans:
        assert ex[p.name].error == "None" and ex[p.name].rows_copied == preview[p.name]
        assert im[p.name].rows_copied == preview[p.name]
        back = spark.read.parquet(f"{target}/{p.name}")
        assert verify_round_trip(p.source, back).count() == 0
    cols = columns_report(spark, plans).collect()
    assert {r.table_name for r in cols} == {"dbo.lineitem", "dbo.orders"} and all(r.is_exported for r in cols)


def test_guards_block_a_table_but_not_the_others(spark):
    base = spark.read.parquet(f"{SF}/region.parquet")
    nn = with_flags(base, not_null=["r_name"])
    opts = TransferOptions(columns_except="r_name")
    bad = plan_table(spark, TableRef("dbo", "region_nn", ""), opts, nn)
    good = plan_table(spark, TableRef("dbo", "region", ""), opts, base)
    assert bad.error and "NOT NULL" in bad.error and good.error is None
    ok_override = plan_table(spark, TableRef("dbo", "r", ""), TransferOptions(columns_except="r_name",
                                                                               allow_not_null_exceptions=True), nn)
    assert ok_override.error is None
    unsafe_src = base.withColumn("r_name", F.concat("r_name", F.lit("^|^")))
    unsafe = plan_table(spark, TableRef("dbo", "unsafe", ""), TransferOptions(), unsafe_src)
    res = {r.table_name: r for r in run_export(spark, [bad, good, unsafe], scratch_path(spark, "run-g"),
                                               TransferOptions()).collect()}
    assert res["dbo.region"].rows_copied == 5 and res["dbo.region"].error == "None"
    assert "NOT NULL" in res["dbo.region_nn"].error and res["dbo.region_nn"].rows_text == "?"
    assert res["dbo.unsafe"].error.startswith("5 records")


def test_identity_generated_on_import_continues_after_target_max(spark):
    src = with_flags(spark.read.parquet(f"{SF}/nation.parquet"), identity=["n_nationkey"])
    opts = TransferOptions(export_identity=False, identity_order={"dbo.nation": ["n_name"]})
    plan = plan_table(spark, TableRef("dbo", "nation", ""), opts, src)
    assert "n_nationkey" not in plan.exported.columns
    landing, target = scratch_path(spark, "id-land"), scratch_path(spark, "id-target")
    run_export(spark, [plan], landing, opts).collect()
    for _ in range(2):  # the second load appends after the max
        res = run_import(spark, [plan], landing, target, opts).collect()[0]
        assert res.error == "None" and res.rows_copied == 25
    ids = sorted(r.n_nationkey for r in spark.read.parquet(f"{target}/dbo.nation").collect())
    assert ids == list(range(1, 51))


def test_inferred_target_replaces_table(spark):
    opts = TransferOptions(fmt=FileFormat(header=True), target="inferred")
    plans = plan_transfer(spark, catalog_from_dir(SF), opts, schemas="dbo", tables="part")
    landing, target = scratch_path(spark, "inf-land"), scratch_path(spark, "inf-target")
    run_export(spark, plans, landing, opts).collect()
    for _ in range(2):
        res = run_import(spark, plans, landing, target, opts).collect()[0]
        assert res.error == "None"
    back = spark.read.parquet(f"{target}/dbo.part")
    assert back.count() == plans[0].source.count()
    assert dict(back.dtypes)["p_size"] == "bigint"


def test_cli_export_and_import(spark, capsys):
    from ferry.cli import main
    landing, target = scratch_path(spark, "cli-land"), scratch_path(spark, "cli-target")
    rc = main(["--source", SF, "--landing", landing, "--target", target, "--schemas", "dbo",
               "--tables", "nation; reg*", "--list-sep", ";", "--header", "--columns-except", "n_comment"])
    assert rc == 0
    assert spark.read.parquet(f"{target}/dbo.nation").count() == 25
    assert spark.read.parquet(f"{target}/dbo.region").count() == 5
    rc = main(["--source", SF, "--landing", landing, "--schemas", "dbo", "--tables", "nation", "--what-if"])
    assert rc == 0 and "dbo.nation" in capsys.readouterr().out
    # exporting again into the same landing folder replaces the landed files
    rc = main(["--source", SF, "--landing", landing, "--schemas", "dbo", "--tables", "nation", "--header"])
    assert rc == 0


def test_wildcards_can_be_switched_off(spark):
    opts = TransferOptions(wildcard=None)
    import pytest
    from ferry.plans.catalog import SelectionError
    with pytest.raises(SelectionError):  # "reg*" is now a literal name that does not exist
        plan_transfer(spark, catalog_from_dir(SF), opts, schemas="dbo", tables="reg*")


def test_load_is_verified_against_the_export_fingerprint(spark):
    """A landed value changed between export and import is caught without re-reading the source."""
    import glob
    import os
    import shutil
    opts = TransferOptions(fmt=FileFormat(header=True))
    plans = plan_transfer(spark, catalog_from_dir(SF), opts, schemas="dbo", tables="nation")
    landing, target = scratch_path(spark, "fp-land"), scratch_path(spark, "fp-target")
    run_export(spark, plans, landing, opts).collect()
    ok = run_import(spark, plans, landing, target, opts).collect()[0]
    assert ok.error == "None" and ok.rows_copied == 25
    # a copy of the landing (without the local checksum files, which would catch it first)
    tampered = scratch_path(spark, "fp-tampered")
    shutil.copytree(os.path.join(landing.removeprefix("file:"), "dbo.nation"),
                    os.path.join(tampered.removeprefix("file:"), "dbo.nation"),
                    ignore=shutil.ignore_patterns("*.crc"))
    part = [f for f in glob.glob(os.path.join(tampered.removeprefix("file:"), "dbo.nation", "part-*"))
            if not os.path.basename(f).startswith("part-00000-")][0]
    with open(part, "rb") as fh:
        data = fh.read()
    assert b"NATION_1^" in data
    with open(part, "wb") as fh:
        fh.write(data.replace(b"NATION_1^", b"NATION_7^", 1))
    bad = run_import(spark, plans, tampered, scratch_path(spark, "fp-target2"), opts).collect()[0]
    assert "fingerprint mismatch" in bad.error


def test_format_layout_from_metadata(spark):
    from ferry.plans.run import format_layout
    opts = TransferOptions(fmt=FileFormat())
    plans = plan_transfer(spark, catalog_from_dir(SF), opts, schemas="dbo", tables="region, nation")
    rows = [tuple(r) for r in format_layout(spark, plans, opts.fmt).orderBy("table_name", "field_no").collect()]
    assert rows[:3] == [("dbo.nation", 1, "n_nationkey", "int", "cast as string", 11, "^|^"),
                        ("dbo.nation", 2, "n_name", "string", "as is", None, "^|^"),
                        ("dbo.nation", 3, "n_regionkey", "int", "cast as string", 11, "~~~\r\n")]


def test_transfer_in_one_call(spark):
    from ferry.plans.run import transfer
    opts = TransferOptions(fmt=FileFormat(header=True), parallel=4)
    rep = transfer(spark, catalog_from_dir(SF), scratch_path(spark, "one-land"), scratch_path(spark, "one-target"),
                   opts, schemas="dbo", tables="region, nation, orders").collect()
    assert [r.table_name for r in rep] == ["dbo.nation", "dbo.orders", "dbo.region"]
    assert all(r.error == "None" and r.rows_landed == r.rows_loaded > 0 for r in rep)


def test_import_into_an_existing_wider_target(spark):
    """Loading into an existing table: columns matched by name, the target's extra column stays NULL."""
    from pyspark.sql import types as T
    opts = TransferOptions(fmt=FileFormat(header=True))
    plans = plan_transfer(spark, catalog_from_dir(SF), opts, schemas="dbo", tables="region")
    landing, target = scratch_path(spark, "wide-land"), scratch_path(spark, "wide-target")
    schema = T.StructType([T.StructField("R_NAME", T.StringType()), T.StructField("note", T.StringType()),
                           T.StructField("r_regionkey", T.IntegerType())])
    spark.createDataFrame([("OLD", "kept", 99)], schema).write.parquet(f"{target}/dbo.region")
    run_export(spark, plans, landing, opts).collect()
    res = run_import(spark, plans, landing, target, opts).collect()[0]
    assert res.error == "None" and res.rows_copied == 5
    back = spark.read.parquet(f"{target}/dbo.region")
    assert back.columns == ["R_NAME", "note", "r_regionkey"] and back.count() == 6
    assert back.filter("note is null").count() == 5 and back.filter("R_NAME = 'OLD'").count() == 1


def test_column_summary_and_scratch(spark):
    from ferry.plans.catalog import column_summary
    rows = [(1, "a", {"k": 1}), (1, None, {"k": 1}), (2, "a", None)]
    df = spark.createDataFrame(rows, "i int, s string, m map<string,int>")
    want = {("i", 0, 2, 3), ("s", 1, 1, 3), ("m", 1, 1, 3)}
    for exact in (True, False):
        got = column_summary(df, "t", exact).collect()
        assert {(r.column_name, r.nulls, r.distinct_values, r["rows"]) for r in got} == want
    assert column_summary(df.limit(0), "t").select("nulls", "distinct_values", "rows").distinct().collect() == [(0, 0, 0)]
    assert spark.sparkContext.applicationId in scratch_path(spark, "x")
