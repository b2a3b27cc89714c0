"""Connected components of a link table by alternating large-star / small-star rounds.

Every round is a ``groupBy`` with map-side combine and an equi-join that AQE
can split, so a hub node with a third of all links is no single task's work.
Rounds are checkpointed in the shared folder; nothing is gathered on the driver
but one row of sums per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.llm.common import cut


def _summary(edges: DataFrame) -> tuple:
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(h.bitwiseAND(F.lit(0x7FFFFFFF))),
                           F.sum(F.shiftrightunsigned(h, 33))).first())


def components(links: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``; component = smallest node reachable.

    Links with a null end and self links are ignored; repeated links count once;
    an empty table gives an empty result. Raises if ``max_rounds`` do not suffice
    (the number of rounds grows with the logarithm of the table).
    """
    edges = cut(links.where(F.col(a) != F.col(b))
                .select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")).distinct())
    before = _summary(edges)
    if before[0] == 0:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    for _ in range(max_rounds):
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        edges = cut(small.distinct())
        after = _summary(edges)
        if after == before:
            roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)
        before = after
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
