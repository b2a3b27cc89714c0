"""Summaries kept up batch by batch."""

from pyspark.sql import functions as F

from ferry.plans.summary import RunningSummary, batch_summary, merged
from ferry.session import scratch_path

SF = "/root/testdata/sf0.1"


def test_merged_batches_equal_one_pass(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet").withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("P"))) \
        .withColumn("tags", F.array("o_orderstatus"))
    running = RunningSummary(spark, scratch_path(spark, "summary"))
    parts = [orders.where(F.pmod(F.xxhash64("o_orderkey"), F.lit(5)) == i) for i in range(5)]
    assert [running.add(p, "orders", f"b{i}") for i, p in enumerate(parts)] == [True] * 5
    assert not running.add(parts[0], "orders", "b0")
    one = {r.column_name: r for r in merged(batch_summary(orders, "orders", "all")).collect()}
    many = {r.column_name: r for r in running.summary().collect()}
    true = orders.agg(*[F.countDistinct(c).alias(c) for c in orders.columns]).first()
    n = orders.count()
    assert set(one) == set(many) == set(orders.columns)
    for c, r in many.items():
        assert (r.rows, r.nulls, r.distinct_values) == (one[c].rows, one[c].nulls, one[c].distinct_values)
        assert r.rows == n and abs(r.distinct_values - true[c]) <= max(1, 0.02 * true[c])
    assert many["o_orderstatus"].nulls == orders.where("o_orderstatus is null").count() > 0
    for x, q in zip((0.25, 0.5, 0.75), many["o_totalprice"].quantiles):
        rank = orders.where(F.col("o_totalprice") <= q).count() / n
        assert abs(rank - x) <= 0.02
    assert many["o_orderstatus"].quantiles is None and many["tags"].quantiles is None and many["o_orderdate"].quantiles is not None


def test_empty_batches_and_extremes(spark):
    df = spark.createDataFrame([(1, float("nan"), "b"), (None, 2.0, "a"), (3, None, None)], "i int, x double, s string")
    rows = {r.column_name: r for r in batch_summary(df, "t", "b").collect()}
    assert (rows["i"].least, rows["i"].most, rows["s"].least, rows["s"].most) == ("1", "3", "a", "b")
    got = {r.column_name: r for r in merged(batch_summary(df, "t", "b").unionAll(batch_summary(df.limit(0), "t", "none"))).collect()}
    assert got["x"].quantiles == [2.0, 2.0, 2.0] and (got["x"].rows, got["x"].nulls, got["x"].distinct_values) == (3, 1, 2)
    running = RunningSummary(spark, scratch_path(spark, "summary-none"))
    assert running.summary().collect() == []
    assert running.add(df.limit(0), "t", "x") and {r.distinct_values for r in running.summary().collect()} == {0}
