"""Heavy tables start first."""

import time

from ferry.operators.numbering import input_bytes
from ferry.plans.transfer import TransferResult, run_parallel
from ferry.sources.delimited import folder_bytes

SF = "/root/testdata/sf0.01"


def test_skewed_tables_take_little_more_than_the_bound(spark):
    from datetime import datetime
    seconds = [0.05] * 24 + [0.3, 0.2, 0.8]  # the heaviest is listed last
    begun = []

    def item(i):
        begun.append(i)
        time.sleep(seconds[i])
        return TransferResult(str(i), datetime.now(), datetime.now(), i)

    items = [(str(i), lambda i=i: item(i)) for i in range(len(seconds))]
    start = time.perf_counter()
    results = run_parallel(spark, items, 3, [int(1000 * s) for s in seconds])
    took = time.perf_counter() - start
    bound = max(max(seconds), sum(seconds) / 3)
    assert took <= 1.1 * bound + 0.05 and set(begun[:3]) == {26, 24, 25}
    assert [r.rows for r in results] == list(range(len(seconds))) and [r.table for r in results] == [str(i) for i in range(len(seconds))]


def test_weights_come_from_files_without_running_anything(spark):
    li, region = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("lineitem", "region"))
    assert input_bytes(li.select("l_tax").where("l_tax > 0")) > 100 * input_bytes(region) > 0
    assert folder_bytes(spark, f"{SF}/region.parquet") > 0 and folder_bytes(spark, f"{SF}/nothing") == 0
