"""Row numbers / identity / last-row / next-key, checked against brute force, with a hot key."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ferry.operators import numbering
from ferry.operators.numbering import identity_generate, last_in_group, next_key, row_number, spread


@pytest.fixture(scope="module")
def skewed(spark):
    # key 0 holds a third of all rows; order keys are unique per key
    rows = []
    for i in range(3000):
        g = 0 if i % 3 == 0 else i % 97
        rows.append((g, i, f"v{i % 7}"))
    return spark.createDataFrame(rows, "g int, k int, v string").repartition(5)


def _brute_rn(rows, group, order):
    out = {}
    groups = {}
    for r in rows:
        groups.setdefault(r[group] if group is not None else None, []).append(r)
    for key, rs in groups.items():
        for i, r in enumerate(sorted(rs, key=lambda x: x[order])):
            out[r[order]] = i + 1
    return out


def test_row_number_per_group_matches_brute_force(spark, skewed):
    rows = skewed.collect()
    got = {r.k: r.rn for r in row_number(skewed, ["k"], ["g"], out="rn").collect()}
    assert got == _brute_rn(rows, 0, 1)


def test_row_number_global_and_identity(spark, skewed):
    rows = skewed.collect()
    got = {r.k: r.rn for r in row_number(skewed, ["k"], out="rn").collect()}
    assert got == _brute_rn(rows, None, 1)
    ids = {r.k: r.id for r in identity_generate(skewed, [F.col("k").desc()], out="id", seed=100, step=10).collect()}
    assert ids[2999] == 100 and ids[0] == 100 + 10 * 2999


def test_hot_group_is_split_across_partitions(spark, skewed):
    _ranged, pieces = spread(skewed, ["k"], ["g"], num_partitions=8)
    hot = pieces.filter("g = 0").collect()
    assert len(hot) >= 3  # the hot key spans several tasks, not one


def test_last_in_group_and_next_key(spark, skewed):
    last = {r.k for r in last_in_group(skewed, ["k"], ["g"]).filter("is_last").collect()}
    w = Window.partitionBy("g").orderBy("k")
    brute = {r.k for r in skewed.withColumn("l", F.lead("k").over(w)).filter("l is null").collect()}
    assert last == brute
    nk = {r.k: r.next_key for r in next_key(skewed, "k", ["g"]).collect()}
    brute_nk = {r.k: r.nk for r in skewed.withColumn("nk", F.coalesce(F.lead("k").over(w), F.col("k") + 1)).collect()}
    assert nk == brute_nk


def test_hot_groups_take_the_ranged_way(spark, skewed):
    rows = skewed.collect()
    got = {r.k: r.rn for r in row_number(skewed, ["k"], ["g"], out="rn", hot_rows=500, num_partitions=7).collect()}
    assert got == _brute_rn(rows, 0, 1)
    w = Window.partitionBy("g").orderBy("k")
    assert {r.k for r in last_in_group(skewed, ["k"], ["g"], hot_rows=500, num_partitions=7).filter("is_last").collect()} == \
        {r.k for r in skewed.withColumn("l", F.lead("k").over(w)).filter("l is null").collect()}
    assert {r.k: r.next_key for r in next_key(skewed, "k", ["g"], hot_rows=500, num_partitions=7).collect()} == \
        {r.k: r.nk for r in skewed.withColumn("nk", F.coalesce(F.lead("k").over(w), F.col("k") + 1)).collect()}


def test_numbers_do_not_rest_on_a_reused_exchange(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").select("l_orderkey", "l_linenumber")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        rows = row_number(li, ["l_orderkey", "l_linenumber"], out="rn", num_partitions=9).collect()
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
    rows.sort(key=lambda r: (r.l_orderkey, r.l_linenumber))
    assert [r.rn for r in rows] == list(range(1, len(rows) + 1))


def test_ordinary_groups_move_full_rows_once(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    for df in (row_number(orders, ["o_orderkey"], ["o_custkey"]), last_in_group(orders, ["o_orderkey"], ["o_custkey"]),
               next_key(orders, "o_orderkey", ["o_custkey"])):
        assert df._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1


def test_null_group_keys_are_numbered(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "g int, k int")
    got = sorted(((r.g, r.k, r.rn) for r in row_number(df, ["k"], ["g"], out="rn").collect()), key=lambda x: x[1])
    assert got == [(None, 1, 1), (None, 2, 2), (1, 3, 1)]


def test_global_numbering_plan_has_no_single_partition_row_exchange(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    plan = row_number(df, ["l_orderkey"], out="rn")._jdf.queryExecution().executedPlan().toString()
    # the only SinglePartition exchange is on the tiny per-partition count table
    assert plan.count("SinglePartition") <= 1


def test_range_partition_count_follows_data_size(spark):
    from ferry.operators.numbering import range_partitions
    small = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    assert range_partitions(small) == spark.sparkContext.defaultParallelism
    assert range_partitions(small, target_bytes=1024) > 8  # a (pretend) large table gets more partitions


def test_few_wide_rows_are_hot_by_their_bytes(spark, monkeypatch):
    wide = spark.range(60).select(F.when(F.col("id") < 40, 0).otherwise(F.col("id")).cast("int").alias("g"), F.col("id").alias("k"),
                                  F.repeat(F.lit("x"), 5000).alias("text"), F.array(F.repeat(F.lit("y"), 100)).alias("parts"))
    monkeypatch.setattr(numbering, "HOT_BYTES", 100_000)
    cold, hot = numbering._by_size(wide, ["g"], numbering.HOT_ROWS)
    assert hot.count() == 40 and cold.count() == 20
    got = {r.k: r.rn for r in row_number(wide, ["k"], ["g"], out="rn").collect()}
    assert got == {**{k: k + 1 for k in range(40)}, **{k: 1 for k in range(40, 60)}}


def test_types_that_parquet_cannot_hold(spark):
    odd = spark.range(9).select("id", F.lit(None).alias("nothing"), F.expr("make_interval(0, id)").alias("span"))
    got = row_number(odd, [F.desc("id")], out="rn")
    assert {r.id: r.rn for r in got.select("rn", "id").collect()} == {i: 9 - i for i in range(9)}
    assert got.columns == ["rn", "id", "nothing", "span"]


def test_values_survive_the_files(spark):
    rows = spark.sql("""SELECT * FROM VALUES
        (1, TIMESTAMP'0001-01-01 00:00:00.000001', DATE'0001-01-01', 'NaN'::double, X'00ff', map('a', 1), struct(1 AS `x y`)),
        (2, TIMESTAMP'9999-12-31 23:59:59.999999', DATE'9999-12-31', -0.0::double, NULL, NULL, NULL) AS t(k, at, d, x, raw, m, `a.b`)""")
    out = row_number(rows, ["k"], out="rn")
    text = lambda df: sorted(map(str, df.select(*[F.col(f"`{c}`").cast("string") for c in rows.columns]).collect()))
    assert text(out) == text(rows) and sorted(r.rn for r in out.select("rn").collect()) == [1, 2]
