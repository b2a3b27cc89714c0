"""Verification that says where two tables differ.

Rows are dealt into buckets by a hash of their key; each bucket's fingerprint (rows and
sums of two row hashes) is a leaf of a tree whose inner nodes are sums of leaves. Both
trees take one scan with map-side sums; comparing them from the root
down names the buckets that differ, and only rows of those are shuffled and compared.
A tree can be kept as a small file, so that a later check reads one side only.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferry.functions.fingerprint import fingerprint_aggs, row_hashes
from ferry.functions.text import quoted
from ferry.plans.transfer import verify_round_trip

LEAVES = 4096   # a power of two; what the driver compares
FAN = 16


def bucket_of(keys: Sequence[str], leaves: int = LEAVES) -> Column:
    return F.pmod(F.xxhash64(*[F.col(quoted(k)) for k in keys]), F.lit(leaves))


def fingerprint_leaves(df: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None, leaves: int = LEAVES) -> DataFrame:
    """``(bucket, n, a, b)`` of the buckets that have rows."""
    h1, h2 = row_hashes(df, list(columns) if columns else None)
    n, a, b = fingerprint_aggs(F.col("_f_1"), F.col("_f_2"))
    return (df.select(bucket_of(keys, leaves).alias("bucket"), h1.alias("_f_1"), h2.alias("_f_2")).groupBy("bucket")
            .agg(n.alias("n"), a.alias("a"), b.alias("b")))


class FingerprintTree:
    """Fingerprints of all buckets; level 0 is the root."""

    def __init__(self, leaves: DataFrame, size: int = LEAVES):
        rows = {r.bucket: (int(r.n), int(r.a), int(r.b)) for r in leaves.collect()}  # at most ``size`` rows
        level = [rows.get(i, (0, 0, 0)) for i in range(size)]
        self.levels = [level]
        while len(level) > 1:
            level = [tuple(map(sum, zip(*level[i:i + FAN]))) for i in range(0, len(level), FAN)]
            self.levels.insert(0, level)

    def differing(self, other: "FingerprintTree") -> list[int]:
        """Buckets whose fingerprints differ, found from the root down."""
        nodes = [0]
        for depth, (mine, theirs) in enumerate(zip(self.levels, other.levels)):
            if depth:
                nodes = [c for n in nodes for c in range(n * FAN, min((n + 1) * FAN, len(mine)))]
            nodes = [n for n in nodes if mine[n] != theirs[n]]
        return nodes


def locate_differences(source: DataFrame, landed: DataFrame, keys: Sequence[str], leaves: int = LEAVES) -> DataFrame:
    """The rows of :func:`verify_round_trip` (with their counts on both sides), read from differing buckets only."""
    columns = source.columns
    trees = [FingerprintTree(fingerprint_leaves(d, keys, columns, leaves), leaves) for d in (source, landed)]
    nodes = trees[0].differing(trees[1])
    inside = bucket_of(keys, leaves).isin(*np.array(nodes).tolist()) if nodes else F.lit(False)
    return verify_round_trip(source.where(inside), landed.where(inside))
