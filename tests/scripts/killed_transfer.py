"""A transfer whose process is killed: argv = repo, target folder, state to die in, table to die at."""
import os
import sys

sys.path.insert(0, sys.argv[1])

from ferry.plans.catalog import catalog_from_dir  # noqa: E402
from ferry.plans.control import WorkLog  # noqa: E402
from ferry.plans.run import TransferOptions, transfer  # noqa: E402
from ferry.session import local_session  # noqa: E402
from ferry.sources import delimited  # noqa: E402
from ferry.sources.delimited import FileFormat  # noqa: E402

_, _, base, state, table = sys.argv
spark = local_session(cores=4, app="killed")
record = WorkLog.record


def dies(self, item, step, **facts):
    out = record(self, item, step, **facts)
    if (item, step) == (table, state):
        os._exit(9)
    return out


WorkLog.record = dies
tables = "customer, events, lineitem, nation, orders, part, region, supplier"
transfer(spark, catalog_from_dir("/root/testdata/sf0.001"), f"{base}/landing", f"{base}/target",
         TransferOptions(fmt=FileFormat(header=True), parallel=1), run_id="nightly", schemas="dbo", tables=tables).collect()
