"""Rejected records with an error budget; verification that names the differing rows."""

from pyspark.sql import functions as F

from ferry.plans.locate import FingerprintTree, fingerprint_leaves, locate_differences
from ferry.plans.transfer import verify_round_trip
from ferry.session import scratch_path
from ferry.sources.delimited import FileFormat, encode_rows, file_names
from ferry.sources.rejects import load_with_rejects

SF01 = "/root/testdata/sf0.1"
FMT = FileFormat()


def land(spark, lines, path, fmt=FMT):
    spark.createDataFrame([(x,) for x in lines], "value string").repartition(3).write.option("lineSep", fmt.line_sep).text(path)


def test_three_bad_rows_in_sixty_thousand(spark):
    li = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    base, total = scratch_path(spark, "rejects"), li.count()
    three = li.orderBy("l_orderkey", "l_linenumber").limit(3).select("l_orderkey", "l_linenumber").collect()
    bad = F.lit(False)
    for r in three:
        bad = bad | ((F.col("l_orderkey") == r[0]) & (F.col("l_linenumber") == r[1]))
    texts = li.withColumn("l_quantity", F.when(bad, F.lit("many")).otherwise(F.col("l_quantity").cast("string")))
    encode_rows(texts, FMT).write.option("lineSep", FMT.line_sep).text(f"{base}/l")
    report = load_with_rejects(spark, f"{base}/l", li.schema, FMT, f"{base}/t", f"{base}/r", max_rejects=3)
    assert (report.result.rows, report.rejected, report.result.error) == (total - 3, 3, None)
    rows = spark.read.parquet(f"{base}/r").collect()
    assert {r.reason for r in rows} == {"column l_quantity: many is not double"} and len(rows) == 3
    assert all(f"{base}/l/part-" in r.file and r.split_start >= 0 and "many" in r.record for r in rows)
    assert verify_round_trip(li.where(~bad), spark.read.parquet(f"{base}/t")).count() == 0
    over = load_with_rejects(spark, f"{base}/l", li.schema, FMT, f"{base}/t", f"{base}/r2", max_rejects=2)
    assert over.result.rows is None and "3 records rejected" in over.result.error
    assert spark.read.parquet(f"{base}/t").count() == total - 3 and spark.read.parquet(f"{base}/r2").count() == 3
    assert not [n for n in file_names(spark, f"{base}/t") if n.startswith("_ferry_load")]


def test_reasons_of_all_kinds(spark):
    base = scratch_path(spark, "reasons")
    schema = "id int not null, d date, flag boolean, list array<int>, price decimal(5,2), name string"
    land(spark, ["1^|^2024-02-29^|^1^|^[1,2]^|^9.50^|^ok", "2^|^^|^^|^^|^^|^", "^|^^|^^|^^|^^|^x", "3^|^2023-02-29^|^^|^^|^^|^", "4^|^^|^yes?^|^^|^^|^",
                 "5^|^^|^^|^[1,^|^^|^", "6^|^^|^^|^^|^9999.5^|^", "7^|^too few", "8^|^^|^^|^^|^^|^a^|^b"], f"{base}/l")
    fields = spark.createDataFrame([], schema).schema
    report = load_with_rejects(spark, f"{base}/l", fields, FMT, f"{base}/t", f"{base}/r", max_rejects=10, required=["name"])
    assert sorted(r.id for r in spark.read.parquet(f"{base}/t").collect()) == [1] and report.rejected == 8
    got = sorted(r.reason for r in spark.read.parquet(f"{base}/r").collect())
    assert got == sorted(["column name is NULL", "column id is NULL", "column d: 2023-02-29 is not date", "column flag: yes? is not boolean",
                          "column list: [1, is not array<int>", "column price: 9999.5 is not decimal(5,2)", "record has 2 fields, 6 expected",
                          "record has 7 fields, 6 expected"])


def test_clean_loads_write_no_list(spark):
    base = scratch_path(spark, "clean")
    land(spark, ["1", "2"], f"{base}/l")
    fields = spark.createDataFrame([], "id int").schema
    report = load_with_rejects(spark, f"{base}/l", fields, FMT, f"{base}/t", f"{base}/r")
    assert (report.result.rows, report.rejected, report.rejects_path) == (2, 0, None) and file_names(spark, f"{base}/r") == []


def test_one_changed_row_in_six_hundred_thousand_is_one_bucket(spark):
    li = spark.read.parquet(f"{SF01}/lineitem.parquet")
    keys = ["l_orderkey", "l_linenumber"]
    one = li.orderBy(*keys).first()
    here = (F.col("l_orderkey") == one.l_orderkey) & (F.col("l_linenumber") == one.l_linenumber) & (F.col("l_partkey") == one.l_partkey)
    changed = li.withColumn("l_tax", F.when(here, F.col("l_tax") + 1).otherwise(F.col("l_tax")))
    trees = [FingerprintTree(fingerprint_leaves(d, keys)) for d in (li, changed)]
    assert len(trees[0].differing(trees[1])) == 1 and trees[0].differing(trees[0]) == []
    rows = locate_differences(li, changed, keys).collect()
    assert sorted((r.l_orderkey, r.source_rows, r.landed_rows) for r in rows) == [(one.l_orderkey, 0, 1), (one.l_orderkey, 1, 0)]
    assert locate_differences(li, li, keys).collect() == []


def test_missing_repeated_and_null_keyed_rows_are_located(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y"), (None, "n"), (3, None)], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "y"), (None, "m"), (3, None), (4, "new")], "k int, v string")
    got = sorted(map(str, (tuple(r) for r in locate_differences(a, b, ["k"], leaves=64).collect())))
    assert got == sorted(map(str, [(2, "y", 2, 1), (None, "n", 1, 0), (None, "m", 0, 1), (4, "new", 0, 1)]))
