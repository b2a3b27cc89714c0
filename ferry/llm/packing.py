"""Conflict-constrained best-fit packing of documents into sequences of fixed length.

A bin never holds two documents of one source nor two of one duplicate cluster.
Documents are dealt to shards of about ``SHARD`` pieces by a hash of the id, so
hot sources and groups of copies spread evenly, or, given a schedule, in contiguous
runs of it, so that shards follow one another as the schedule does; each shard packs
its own bins, largest piece first. Bins stand in order of their residual length and carry a
source and a cluster bitmap. The successor search starts at the smallest
residual that holds the piece and goes on until a bin's bitmaps allow it: the
tightest compatible bin. A new bin opens only when there is none.

Lengths are words (``[^\\x20\\x09-\\x0D]+``). A document longer than a bin is cut
into full pieces, which fill bins of their own, and a rest that is packed like
any other: whole texts, no prefixes.

Defined results
    null or empty text: one piece of length 0; a null source is a source of its
    own; null ids are packed too; the default cluster is the text without white
    space around it, so repeated rows conflict; ties: larger length, then
    smaller id, piece and row hash; empty table: empty result; extra columns
    are not read.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferry.llm.common import ASCII_SPACE, landed
from ferry.llm.mixing import _prefix

CAPACITY = 2_048
SHARD = 4_096


def best_fit(lengths: list[int], sources: list[int], clusters: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """(bin, offset) of each piece, taken in the order given; negative numbers never conflict."""
    residuals: list[tuple[int, int]] = []  # (residual, bin), ascending
    held: list[tuple[int, int]] = []       # source and cluster bitmap of each bin
    bins, offsets = [], []
    for length, source, cluster in zip(lengths, sources, clusters):
        source_bit = 1 << source if source >= 0 else 0
        cluster_bit = 1 << cluster if cluster >= 0 else 0
        at = bisect_left(residuals, (length, -1))
        while at < len(residuals):
            has_sources, has_clusters = held[residuals[at][1]]
            if not (has_sources & source_bit or has_clusters & cluster_bit):
                break
            at += 1
        if at < len(residuals):
            residual, n = residuals.pop(at)
        else:
            residual, n = capacity, len(held)
            held.append((0, 0))
        held[n] = (held[n][0] | source_bit, held[n][1] | cluster_bit)
        insort(residuals, (residual - length, n))
        bins.append(n)
        offsets.append(capacity - residual)
    return bins, offsets


def _numbers(column: pd.Series) -> list[int]:
    return pd.factorize(column, use_na_sentinel=False)[0].tolist()


def words(text: Column) -> Column:
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")).cast("long")


def _numbered(items: DataFrame) -> DataFrame:
    """``items`` with ``before``: the pieces that stand before a document in the schedule."""
    slots = _prefix(items.groupBy(F.lit("").alias("_s"), F.col("slot").alias("_b")).agg(F.sum("n").alias("_n")))
    within = Window.partitionBy("slot").orderBy("place", "doc_id", "cluster")  # a slot is one block of text
    return (items.withColumn("_in", F.sum("n").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n"))
            .join(slots.select("_pb", "_before"), F.col("slot") == F.col("_pb"))
            .withColumn("before", F.col("_before") + F.col("_in")))


def packed(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
           cluster: Column | None = None, length: Column | None = None, capacity: int = CAPACITY,
           one_per_source: bool = True, schedule: tuple[str, str] | None = None) -> DataFrame:
    """``(doc_id, piece, start, length, bin_shard, bin_no, bin_offset)``, one row per piece of every document.

    ``schedule`` names the columns of a document's slot and of its place in the
    slot: shard 0 then holds the first pieces of the schedule, shard 1 the next.
    """
    length = words(F.col(text_col)) if length is None else length
    cluster = F.md5(F.btrim(F.coalesce(F.col(text_col), F.lit("")), F.lit(ASCII_SPACE))) if cluster is None else cluster
    items = landed(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                               cluster.cast("string").alias("cluster"), length.alias("words"),
                               *[F.col(c).cast("long").alias(n) for c, n in zip(schedule or (), ("slot", "place"))]),
                   "packing-items")
    last = F.greatest(F.ceil(F.col("words") / capacity) - 1, F.lit(0)).cast("long")
    if schedule:
        items = _numbered(items.withColumn("n", last + 1))
    pieces = (items.select("doc_id", "source", "cluster", "words", *["before"] * bool(schedule), F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece"))
              .withColumn("start", F.col("piece") * capacity)
              .withColumn("length", F.least(F.lit(capacity).cast("long"), F.col("words") - F.col("start"))))
    total = pieces.count()
    shards = max(1, round(total / SHARD))
    # The cluster is part of the hash: repeated rows of one id meet only if they are copies.
    pieces = pieces.withColumn("bin_shard", F.pmod(F.xxhash64("doc_id", "piece", "cluster"), F.lit(shards)))
    if schedule:
        size = -(-total // shards)
        pieces = pieces.withColumn("bin_shard", F.floor((F.col("before") + F.col("piece")) / F.lit(size)).cast("long")).drop("before")

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "piece", "source", "cluster"],
                              ascending=[False, True, True, True, True], kind="stable", ignore_index=True)
        n = len(pdf)
        sources = _numbers(pdf["source"]) if one_per_source else [-1] * n
        clusters = _numbers(pdf["cluster"])
        pdf["bin_no"], pdf["bin_offset"] = best_fit(pdf["length"].tolist(), sources, clusters, capacity)
        return pdf[["doc_id", "piece", "start", "length", "bin_shard", "bin_no", "bin_offset"]]

    return pieces.drop("words").groupBy("bin_shard").applyInPandas(
        pack, "doc_id long, piece long, start long, length long, bin_shard long, bin_no long, bin_offset long")


def digest(docs: DataFrame) -> DataFrame:
    return packed(docs)
