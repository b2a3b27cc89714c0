"""Transfers end to end: parallel export, metrics, logs, preview, entry contract."""

import glob
import os

from pyspark.sql import functions as F

import __spark_entry__ as entry_mod
from ferry.demos.common import CORE_TABLES, FMT, load
from ferry.plans.catalog import column_summary, format_fields, plan_preview
from ferry.plans.transfer import export_all, export_table, metrics_frame, run_parallel
from ferry.session import scratch_path
from ferry.sources.logs import log_metrics, read_logs

SF = "/root/testdata/sf0.001"


def _fs(path):
    return path[len("file:"):] if path.startswith("file:") else path


def test_export_all_and_metrics(spark):
    base = scratch_path(spark, "t-all")
    tables = {t: load(spark, SF, t) for t in CORE_TABLES}
    res = export_all(spark, tables, base, FMT.with_(header=True), parallel=4)
    m = {r.table_name: r for r in metrics_frame(spark, res).collect()}
    for t, df in tables.items():
        assert m[t].rows_copied == df.count() and m[t].error == "None"
        assert m[t].rows_text == f"{df.count():,}"


def test_failing_table_does_not_stop_the_others(spark):
    good = load(spark, SF, "region")
    bad = good.withColumn("boom", F.raise_error(F.lit("bad row")).cast("string"))
    base = scratch_path(spark, "t-fail")
    items = [("good", lambda: export_table(good, f"{base}/good", FMT, "good")),
             ("bad", lambda: export_table(bad, f"{base}/bad", FMT, "bad"))]
    res = {r.table_name: r for r in metrics_frame(spark, run_parallel(spark, items, 2)).collect()}
    assert res["good"].rows_copied == 5 and res["good"].error == "None"
    assert res["bad"].rows_copied is None and res["bad"].rows_text == "?" and "bad row" in res["bad"].error


def test_plan_preview_matches_landed_bytes(spark):
    fmt = FMT.with_(header=True)
    tables = {t: load(spark, SF, t) for t in ["nation", "orders"]}
    preview = {r.table_name: r for r in plan_preview(tables, fmt).collect()}
    for t, df in tables.items():
        path = scratch_path(spark, f"t-prev-{t}")
        from ferry.sources.delimited import write_delimited
        write_delimited(df, path, fmt)
        size = sum(os.path.getsize(p) for p in glob.glob(os.path.join(_fs(path), "part-*")))
        assert preview[t].bytes == size and preview[t].rows == df.count()


def test_format_fields_and_summary(spark):
    df = spark.createDataFrame([(1, "abc", None), (22, "", 1.5)], "a int, b string, c double")
    ff = format_fields(df, FMT).collect()
    assert [(r.field_no, r.column_name, r.max_len, r.terminator) for r in ff] == [
        (1, "a", 2, "^|^"), (2, "b", 3, "^|^"), (3, "c", 3, "~~~\r\n")]
    cs = {r.column_name: (r.rows, r.nulls, r.distinct_values) for r in column_summary(df, "t").collect()}
    assert cs == {"a": (2, 0, 2), "b": (2, 0, 2), "c": (2, 1, 1)}


LOG_A = """Starting copy...
1,234 rows copied.
Network packet size (bytes): 4096
Clock Time (ms.) Total : 56     Average : (22035.7 rows per sec.)
"""
LOG_B = """Starting copy...
SQLState = 22001, NativeError = 0
Error = [Microsoft][ODBC Driver] String data, right truncation
BCP import with a format file will convert empty strings in delimited columns to NULL. error
Copy failed.
"""


def test_log_metrics_from_files(spark, tmp_path):
    (tmp_path / "a.log").write_text(LOG_A)
    (tmp_path / "b.log").write_text(LOG_B)
    out = {os.path.basename(r.file): r for r in log_metrics(read_logs(spark, str(tmp_path))).collect()}
    a, b = out["a.log"], out["b.log"]
    assert (a.rows_copied, a.clock_ms, a.rows_per_sec, a.error) == (1234, 56, 22035, "None")
    assert (a.rows_text, a.clock_text, a.speed_text) == ("1,234", "56", "22,035")
    assert b.rows_copied is None and b.rows_text == "?"
    assert b.error == "Error = [Microsoft][ODBC Driver] String data, right truncation\nCopy failed."


def test_entry_contract(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0].round_trip_differences == 0 and rows[0].error == "None"
    keys = set(entry_mod.queries())
    oracles = set(entry_mod.oracle_sql())
    from ferry.demos import QUERIES
    assert oracles <= keys and set(QUERIES) <= oracles
    assert len(keys) >= 60


def test_fingerprint_detects_changes_and_ignores_order(spark):
    from ferry.plans.transfer import fingerprint, same_content
    df = spark.read.parquet(f"{SF}/orders.parquet")
    assert same_content(df, df.orderBy(F.desc("o_orderkey")).repartition(3))
    changed = df.withColumn("o_totalprice", F.when(F.col("o_orderkey") == 1, 0.0).otherwise(F.col("o_totalprice")))
    assert not same_content(df, changed)
    dup = df.unionByName(df.limit(1))
    assert fingerprint(dup)[0] == fingerprint(df)[0] + 1 and not same_content(df, dup)
    m = spark.createDataFrame([(1, {"a": 1})], "id int, m map<string,int>")
    assert same_content(m, m)


def test_report_frame_headings(spark):
    from ferry.plans.transfer import REPORT_HEADINGS, report_frame
    res = export_all(spark, {"nation": load(spark, SF, "nation")}, scratch_path(spark, "t-rep"), FMT)
    rep = report_frame(metrics_frame(spark, res))
    assert tuple(rep.columns) == REPORT_HEADINGS
    row = rep.collect()[0]
    assert row["Table"] == "nation" and row["RowsCopied"] == "25" and row["Error"] == "None"
