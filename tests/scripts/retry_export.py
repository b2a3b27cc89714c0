"""Run in its own process: a local session that retries failed tasks (local[4,3])."""
import sys

sys.path.insert(0, sys.argv[1])

import pandas as pd  # noqa: E402
from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from ferry.plans.transfer import fingerprint  # noqa: E402
from ferry.session import scratch_path  # noqa: E402
from ferry.sources.delimited import FileFormat, read_delimited, write_delimited  # noqa: E402

spark = (SparkSession.builder.master("local[4,3]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
spark.sparkContext.setLogLevel("OFF")


@F.pandas_udf("long")
def lose_first_attempt(s: pd.Series) -> pd.Series:
    tc = TaskContext.get()
    if tc.attemptNumber() == 0 and tc.partitionId() == 1:
        raise RuntimeError("injected task loss")
    return s


df = spark.range(0, 40000, numPartitions=4).select(F.col("id"), lose_first_attempt("id").alias("v"),
                                                    F.concat(F.lit("row "), F.col("id").cast("string")).alias("s"))
fmt = FileFormat(header=True)
path = scratch_path(spark, "retry")
stats = {"fingerprint": True}
rows = write_delimited(df, path, fmt, stats=stats)
back = read_delimited(spark, path, df.schema, fmt)
clean = spark.range(0, 40000, numPartitions=4).select("id", F.col("id").alias("v"),
                                                       F.concat(F.lit("row "), F.col("id").cast("string")).alias("s"))
from ferry.operators.numbering import row_number  # noqa: E402

skewed = spark.range(0, 30000, numPartitions=4).select(
    (F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50)).alias("g"), lose_first_attempt("id").alias("k"))
numbered = row_number(skewed, ["k"], ["g"], out="rn", num_partitions=6).select("g", "k", "rn").collect()
by_group = {}
for g, k, rn in numbered:
    by_group.setdefault(g, []).append((k, rn))
dense = all(sorted(rn for _, rn in v) == list(range(1, len(v) + 1)) and
            [rn for _, rn in sorted(v)] == list(range(1, len(v) + 1)) for v in by_group.values())
print("NUMBERING", len(numbered), dense)

tracker = spark.sparkContext.statusTracker()
failed = 0
for job in tracker.getJobIdsForGroup(None):
    info = tracker.getJobInfo(job)
    for sid in (info.stageIds if info else []):
        st = tracker.getStageInfo(sid)
        failed += st.numFailedTasks if st else 0
print("RESULT", rows, back.count(), stats["fingerprint"] == fingerprint(back) == fingerprint(clean))
print("FAILED_TASKS", failed)
spark.stop()
