"""skew_join equals a plain join for every supported join type, and reads each input once."""

import pytest
from pyspark.sql import functions as F

from ferry.operators.relational import apply_union, lookup, merge_insert, outer_apply_flag
from ferry.operators.skew import skew_join
from ferry.session import scratch_path

HOWS = ["inner", "left", "left_semi", "left_anti"]


@pytest.fixture(scope="module")
def sides(spark):
    left = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 101 == 1, F.lit(None))
        .otherwise(F.col("id") % 500).cast("long").alias("k"),
        F.col("id").alias("v"))
    right = spark.range(0, 400).select((F.col("id") + 2).alias("k"), (F.col("id") * 10).alias("w"))
    return left, right


def _rows(df):
    return sorted((tuple((v is None, v if v is not None else 0) for v in r)
                   for r in df.select(sorted(df.columns)).collect()))


@pytest.mark.parametrize("how", HOWS)
@pytest.mark.parametrize("null_right", [False, True])
def test_equals_plain_join(spark, sides, how, null_right):
    left, right = sides
    if null_right:
        right = right.unionByName(spark.createDataFrame([(None, 1), (None, 2)], "k long, w long"))
    assert _rows(skew_join(left, right, ["k"], how)) == _rows(left.join(right, ["k"], how))


@pytest.mark.parametrize("how", HOWS)
def test_hot_key_on_the_right(spark, sides, how):
    right, left = sides  # the right side now repeats key 7 ten thousand times
    left, right = left.withColumnRenamed("w", "x"), right.withColumnRenamed("v", "y")
    want = _rows(left.join(right, ["k"], how))
    assert _rows(skew_join(left, right, ["k"], how)) == want
    if how == "left":
        assert _rows(skew_join(left, right, ["k"], how, right_hot=True)) == want
    if how in ("left_semi", "left_anti"):  # reduced before it is joined
        plan = skew_join(left, right, ["k"], how)._jdf.queryExecution().optimizedPlan().toString()
        assert "Aggregate [k" in plan


def test_hot_key_only_in_a_late_file_and_derived_keys(spark):
    path = scratch_path(spark, "t-late")
    early = spark.range(0, 4000).select(F.col("id").alias("k"), F.col("id").alias("v"))
    early.repartition(30).write.parquet(path)
    spark.range(0, 4000).select(F.lit(999).cast("long").alias("k"), F.col("id").alias("v")).coalesce(1).write.mode("append").parquet(path)
    left = spark.read.parquet(path).withColumn("k", F.concat(F.lit("x"), F.col("k").cast("string")))
    right = spark.range(0, 1500).select(F.concat(F.lit("x"), F.col("id").cast("string")).alias("k"), F.col("id").alias("w"))
    for how in HOWS:
        assert _rows(skew_join(left, right, ["k"], how)) == _rows(left.join(right, ["k"], how))


def test_hot_left_key_is_split_at_run_time(spark, sides):
    left, right = sides
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        for how in ("left", "left_anti", "inner"):
            joined = skew_join(left.withColumn("pad", F.sha2(F.col("v").cast("string"), 256)).repartition(6), right, ["k"], how)
            joined.write.format("noop").mode("overwrite").save()
            joined.collect()
            assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString(), how
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _scans(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


def test_every_input_is_read_once(spark):
    folder = "/root/testdata/sf0.001"
    orders, customer, nation = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("orders", "customer", "nation"))
    key = [("o_custkey", "c_custkey")]
    for how in HOWS:
        assert _scans(skew_join(orders, customer, key, how)) == 2
    assert _scans(lookup(customer, nation, "c_nationkey", "n_nationkey", "n_name", "nation")) == 2
    assert _scans(outer_apply_flag(orders, customer, key)) == 2
    assert _scans(merge_insert(customer, customer.limit(5), ["c_custkey"])) == 3  # target twice: its keys and its rows
    branches = [(customer.where(F.col("c_nationkey") == i), key, "c_name") for i in range(5)]
    assert _scans(apply_union(orders, branches, "x")) == 1 + 5
    chain = orders
    for i in range(5):
        chain = skew_join(chain, customer.select("c_custkey", F.col("c_name").alias(f"n{i}")), key, "left")
    assert _scans(chain) == 1 + 5
