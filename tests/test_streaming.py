"""Incremental import: each landed file is loaded exactly once across runs."""

from ferry.plans.transfer import verify_round_trip
from ferry.session import scratch_path
from ferry.sources.delimited import FileFormat, write_delimited
from ferry.streaming.landing import stream_import

SF = "/root/testdata/sf0.001"


def test_stream_import_is_incremental_and_exactly_once(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    fmt = FileFormat(header=True)
    landing, target = scratch_path(spark, "s-land"), scratch_path(spark, "s-target")
    first = orders.filter("o_orderstatus = 'F'")
    rest = orders.filter("o_orderstatus <> 'F' or o_orderstatus is null")
    write_delimited(first, landing, fmt, mode="append")
    q1 = stream_import(spark, landing, orders.schema, fmt, target, "orders_inc")
    assert q1.exception() is None
    assert spark.read.parquet(target).count() == first.count()
    write_delimited(rest, landing, fmt, mode="append")
    stream_import(spark, landing, orders.schema, fmt, target, "orders_inc")
    stream_import(spark, landing, orders.schema, fmt, target, "orders_inc")  # nothing new: no duplicates
    back = spark.read.parquet(target)
    assert verify_round_trip(orders, back).count() == 0
