"""Transfers that are broken off and started again; loads that do not match; replacements that die."""

import os
import subprocess
import sys

import pytest

from ferry.operators.columns import with_flags
from ferry.plans.catalog import TableRef, catalog_from_dir
from ferry.plans.control import Claimed, WorkLog
from ferry.plans.run import TransferOptions, plan_table, run_export, run_import, transfer
from ferry.plans.transfer import verify_round_trip
from ferry.session import scratch_path
from ferry.sources import delimited
from ferry.sources.delimited import FileFormat, publish, settle

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"
TABLES = "customer, events, lineitem, nation, orders, part, region, supplier"


@pytest.mark.parametrize("state, table, done", [("committed", "dbo.nation", 4), ("loading", "dbo.orders", 4), ("landing", "dbo.part", 0)])
def test_a_killed_run_loads_every_row_once(spark, state, table, done):
    """The process dies after 4 of 8 tables, while the fifth is being moved, or while a landing is being moved."""
    base = scratch_path(spark, "killed")
    os.makedirs(base.removeprefix("file:"), exist_ok=True)
    script = os.path.join(REPO, "tests", "scripts", "killed_transfer.py")
    out = subprocess.run([sys.executable, script, REPO, base, state, table], capture_output=True, text=True, timeout=600)
    assert out.returncode == 9, out.stderr[-2000:]
    log = WorkLog(spark, f"{base}/target", "nightly")
    states = {r.item: r.state for r in log.frame().collect()}
    assert sum(s == "committed" for s in states.values()) == done and states[table] == state
    catalog, opts = catalog_from_dir(SF), TransferOptions(fmt=FileFormat(header=True), parallel=4)
    run = dict(schemas="dbo", tables=TABLES, run_id="nightly")
    if state != "committed":  # another driver may still be at work there
        again = {r.table_name: r for r in transfer(spark, catalog, f"{base}/landing", f"{base}/target", opts, **run).collect()}
        assert state in again[table].error
    for _ in range(2):  # the second time there is nothing left to do
        report = transfer(spark, catalog, f"{base}/landing", f"{base}/target", opts, takeover=True, **run).collect()
        assert {r.error for r in report} == {"None"} and len(report) == 8
        for r in report:
            source = spark.read.parquet(f"{SF}/{r.table_name.removeprefix('dbo.')}.parquet")
            assert r.rows_loaded == r.rows_landed == source.count()
            assert verify_round_trip(source, spark.read.parquet(f"{base}/target/{r.table_name}")).count() == 0
    assert {r.state for r in log.frame().collect()} == {"committed"}


def test_another_run_id_loads_again(spark):
    base, catalog, opts = scratch_path(spark, "ids"), catalog_from_dir(SF), TransferOptions()
    for run_id, rows in (("one", 5), ("one", 5), ("two/2", 10)):
        assert transfer(spark, catalog, f"{base}/l", f"{base}/t", opts, run_id=run_id, schemas="dbo", tables="region").first().error == "None"
        assert spark.read.parquet(f"{base}/t/dbo.region").count() == rows


def test_two_drivers_do_not_take_the_same_step(spark):
    root = scratch_path(spark, "log")
    one, two = WorkLog(spark, root, "r"), WorkLog(spark, root, "r")
    assert one.claim("a.b")["attempt"] == 1 and one.claim("a.b")["state"] == "claimed"
    with pytest.raises(Claimed):
        two.claim("a.b")
    late = WorkLog(spark, root, "r", takeover=True)
    assert late.claim("a.b")["attempt"] == 2
    with pytest.raises(Claimed):
        one.record("a.b", "landing", made="x")
    late.record("a.b", "failed", error="no")
    assert two.claim("a.b")["attempt"] == 3
    assert [(r.item, r.state, r.attempt) for r in two.frame().collect()] == [("a.b", "claimed", 3)]


def test_a_failed_table_is_tried_again(spark):
    base, opts = scratch_path(spark, "again"), TransferOptions()
    src = with_flags(spark.read.parquet(f"{SF}/region.parquet"))
    bad = plan_table(spark, TableRef("dbo", "region", ""), opts, src.selectExpr("r_regionkey", "r_name || '^|^' AS r_name"))
    good = plan_table(spark, TableRef("dbo", "region", ""), opts, src)
    for plan, error in ((bad, True), (good, False)):
        log = WorkLog(spark, base, "r")
        assert (run_export(spark, [plan], f"{base}/l", opts, log).first().error != "None") == error
    assert run_import(spark, [good], f"{base}/l", f"{base}/t", opts, log=log).first().rows_copied == 5
    assert log.last("dbo.region")["attempt"] == 2


def test_a_mismatching_load_leaves_the_target_as_it_was(spark):
    base, opts = scratch_path(spark, "mismatch"), TransferOptions()
    plan = plan_table(spark, TableRef("dbo", "region", ""), opts, spark.read.parquet(f"{SF}/region.parquet"))
    run_export(spark, [plan], f"{base}/l", opts).collect()
    assert run_import(spark, [plan], f"{base}/l", f"{base}/t", opts).first().error == "None"
    path = f"{base}/l/dbo.region"
    extra = spark.createDataFrame([("9^|^ATLANTIS",)], "value string")
    extra.write.mode("append").option("lineSep", opts.fmt.line_sep).text(path)
    res = run_import(spark, [plan], f"{base}/l", f"{base}/t", opts).first()
    assert "mismatch" in res.error and spark.read.parquet(f"{base}/t/dbo.region").count() == 5
    assert not [n for n in delimited.file_names(spark, f"{base}/t/dbo.region") if n.startswith("_ferry_load")]


def test_a_replacement_that_dies_between_its_renames(spark):
    base = scratch_path(spark, "swap")
    spark.range(3).write.parquet(f"{base}/t")
    spark.range(7).write.parquet(f"{base}/new")
    target, fs = delimited._hadoop_fs(spark, f"{base}/t")
    old, _ = delimited._hadoop_fs(spark, delimited._replaced(f"{base}/t"))
    fs.rename(target, old)  # died here
    settle(spark, f"{base}/t")
    assert spark.read.parquet(f"{base}/t").count() == 3
    fs.rename(target, old)  # and here; this time the new files are still wanted
    publish(spark, f"{base}/new", f"{base}/t", replace_all=True)
    publish(spark, f"{base}/new", f"{base}/t", replace_all=True)
    assert spark.read.parquet(f"{base}/t").count() == 7 and not fs.exists(old)
