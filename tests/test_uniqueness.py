"""UNIQUE on append by a Bloom filter of the stored keys."""

import pytest
from pyspark.sql import functions as F

from ferry.operators.checks import GuardError
from ferry.operators.uniqueness import UniqueAppender, _semi, key_filter, possible_hits
from ferry.session import scratch_path


def rows(spark, a, b, step=1):
    return spark.range(a, b, step).select("id", (F.col("id") % 3).cast("string").alias("part"), F.lit("x").alias("v"))


def test_keys_that_are_stored_are_always_found_and_others_rarely(spark):
    stored, keys = rows(spark, 0, 60_000), ["id", "part"]
    filters = key_filter(stored, keys, 60_000).cache()
    assert filters.count() == 8
    assert possible_hits(rows(spark, 59_000, 60_000), filters, keys).count() == 1_000
    wrong = possible_hits(rows(spark, 100_000, 140_000), filters, keys).count()
    assert wrong < 40_000 / 100
    nulls = spark.createDataFrame([(None, "a"), (1, None), (None, None)], "id long, part string")
    assert possible_hits(nulls, key_filter(nulls, keys, 3), keys).count() == 3
    assert possible_hits(nulls.where("id = 1"), key_filter(nulls.where("id is null"), keys, 2), keys).count() == 0


def test_appends_are_checked_and_a_clean_one_reads_no_stored_rows(spark):
    table = UniqueAppender(spark, scratch_path(spark, "unique"), ["id", "part"])
    assert table.append(rows(spark, 0, 5_000)) == 5_000 and table.append(rows(spark, 5_000, 9_000)) == 4_000
    seem = possible_hits(rows(spark, 20_000, 20_050), table.filters(), table.keys)
    plan = seem._jdf.queryExecution().optimizedPlan().toString()
    assert "_ferry_keys" not in table.stored().inputFiles()[0] and " v#" not in plan  # the filter alone is joined
    with pytest.raises(GuardError, match="stored already"):
        table.append(rows(spark, 8_990, 9_010))
    with pytest.raises(GuardError, match="duplicate"):
        table.append(rows(spark, 10_000, 10_010).unionAll(rows(spark, 10_005, 10_006)))
    assert table.stored().count() == 9_000
    assert table.append(rows(spark, 8_990, 9_010), on_conflict="skip") == 10 and table.stored().count() == 9_010
    assert table.stored().groupBy("id", "part").count().where("count > 1").isEmpty()
    assert sorted(r.id for r in table.conflicts(rows(spark, 9_005, 9_015)).collect()) == [9_005, 9_006, 9_007, 9_008, 9_009]


def test_rows_from_elsewhere_make_the_filter_anew(spark):
    path = scratch_path(spark, "unique-old")
    rows(spark, 0, 100).write.parquet(path)
    table = UniqueAppender(spark, path, ["id"])
    assert table.prepare() and not table.prepare()
    rows(spark, 100, 120).write.mode("append").parquet(path)
    assert [r.id for r in table.conflicts(rows(spark, 119, 125)).collect()] == [119] and not table.prepare()
    nulls = spark.createDataFrame([(None, "0", "x")], "id long, part string, v string")
    assert table.append(nulls) == 1
    with pytest.raises(GuardError):  # NULLs are equal under UNIQUE
        table.append(nulls)
    assert _semi(nulls, table.stored(), ["id"]).count() == 1
