"""Versioned tables: atomic replacement, conflicts, idempotent appends, rewriting of touched files only."""

import pytest
from pyspark.sql import functions as F

from ferry.session import scratch_path
from ferry.sources.versions import Conflict, VersionedTable


def rows_of(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture()
def table(spark):
    t = VersionedTable(spark, scratch_path(spark, "versions"))
    t.replace(spark.range(0, 2000, 1, 20).select("id", (F.col("id") % 7).cast("string").alias("name")))
    return t


def test_versions_stay_as_they_were_read(spark, table):
    first = table.read()
    assert table.version() == 1 and first.count() == 2000
    table.replace(spark.createDataFrame([(1, "x")], "id long, name string"))
    assert rows_of(table.read()) == [(1, "x")] and first.count() == 2000 and table.read(1).count() == 2000
    table.replace(table.read().limit(0))
    assert table.read().collect() == [] and table.read().columns == ["id", "name"]
    assert [(r.version, r.operation, r.rows) for r in table.history().collect()] == [(1, "replace", 2000), (2, "replace", 1), (3, "replace", 0)]


def test_a_failing_replace_leaves_the_old_rows(spark, table):
    bad = table.read().withColumn("name", F.when(F.col("id") == 1234, F.raise_error(F.lit("no"))).otherwise(F.col("name")))
    with pytest.raises(Exception, match="no"):
        table.replace(bad)
    assert table.version() == 1 and table.read().count() == 2000
    assert len(table.vacuum(older_than_s=-10)) == 0  # the failed write has left no files


def test_of_two_writers_one_is_refused(spark, table):
    seen = table.version()
    table.update(F.col("id") == 5, name="mine")
    with pytest.raises(Conflict):
        table.replace(spark.range(3).select("id", F.lit("theirs").alias("name")), expect=seen)
    with pytest.raises(Conflict):
        table.delete(F.col("id") < 100, expect=seen)
    assert rows_of(table.read().where("id = 5")) == [(5, "mine")] and table.read().count() == 2000
    assert table.version() == 2


def test_appends_do_not_conflict_and_a_batch_counts_once(spark, table):
    new = spark.createDataFrame([(9001, "a")], "id long, NAME string")
    stale = table.entry()
    assert table.append(new, batch="b1") == 2 and table.append(new, batch="b1") == 2
    part, rows, n = table._write(spark.createDataFrame([(9002, "b")], "id long, name string"))
    with pytest.raises(Conflict):  # the version an append has started from may be gone; append() tries again
        table._commit(stale, {**stale, "parts": stale["parts"] + [part]}, [])
    assert table.append(new.withColumn("id", F.col("id") + 2)) == 3
    assert rows_of(table.read().where("id > 9000")) == [(9001, "a"), (9003, "a")]
    with pytest.raises(ValueError, match="other"):
        table.append(new.withColumn("other", F.lit(1)))


def test_an_update_that_hits_one_of_twenty_files_writes_one(spark, table):
    before = {tuple(r[0].split("/")[-2:]) for r in table.read().select("_metadata.file_path").distinct().collect()}
    assert len(before) == 20
    table.update((F.col("id") >= 110) & (F.col("id") < 120), NAME=F.concat("name", F.lit("!")))
    entry = table.entry()
    after = {tuple(r[0].split("/")[-2:]) for r in table.read().select("_metadata.file_path").distinct().collect()}
    assert len(before & after) == 19 and len(after) == 20 and table.history().orderBy(F.desc("version")).first().files_written == 1
    assert entry["rows"] == 2000 and rows_of(table.read().where("name like '%!'")) == [(i, f"{i % 7}!") for i in range(110, 120)]
    table.delete(F.col("id") < 150)  # a file and a half, one of them rewritten before
    assert table.read().count() == 1850 == table.entry()["rows"]
    table.delete(F.col("id") % 2 == 0)
    assert rows_of(table.read().select("id")) == [(i,) for i in range(151, 2000, 2)]
    version = table.version()
    assert table.update(F.col("name") == "nobody", name="x") == version and table.delete(F.lit(None).cast("boolean")) == version
    table.delete(F.lit(True))
    assert table.read().collect() == [] and table.entry()["rows"] == 0


def test_merge_inserts_new_keys_and_keeps_stored_files(spark, table):
    source = spark.createDataFrame([(5, "old"), (5000, "new"), (None, "null")], "id long, name string")
    before = table.entry()["parts"]
    table.merge_insert(source, ["id"])
    assert table.entry()["parts"][:-1] == before and table.read().count() == 2002
    assert rows_of(table.read().where("id = 5 or id = 5000")) == [(5, "5"), (5000, "new")]


def test_vacuum_removes_what_no_kept_version_uses(spark, table):
    table.update(F.col("id") == 7, name="seven")
    table.append(spark.createDataFrame([(3000, "c")], "id long, name string"))
    want = rows_of(table.read())
    assert table.vacuum(keep=3, older_than_s=-10) == [] and table.vacuum() == []
    gone = table.vacuum(keep=1, older_than_s=-10)
    assert len([g for g in gone if g.endswith(".parquet")]) == 1 and rows_of(table.read()) == want
    table.replace(table.read().limit(3))
    table.vacuum(older_than_s=-10)
    assert table.read().count() == 3
    with pytest.raises(Exception):
        table.read(1).collect()
