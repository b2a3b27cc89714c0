"""Mixing sources to target weights by a Pfair schedule, in DataFrame functions only.

Each source is a stream of blocks of ``block_chars`` characters. Its weight w is
an exact fraction of all weights (decimals as written, never rounded to slots);
block j (from 0) is released at floor(j / w) and due by ceil((j + 1) / w).
Earliest deadline first gives every block a slot inside its window, so after any
number of slots each source is within one block of its target weight. Weights
with a small common denominator Q repeat after Q slots; other schedules are
computed until the last block is due. A block's slot is a lookup by (source,
block mod its blocks in the table). The schedule is written to the shared
folder ``BATCH`` blocks at a time: the driver holds one batch and one entry per
source, whatever the length. Its time is a few microseconds a slot.

A document belongs to the block in which its first character falls when its
source is read in the order of a hash of the id. Those running sums take no
hot task: sums per (source, hash bucket), prefix sums over the buckets in two
steps, and a window inside each small bucket. No row is dropped or repeated:
once a source runs out, its slots stay empty and the others keep their order.

Defined results
    a null source is a source of its own; null or empty text counts one
    character; null ids take part (placed by their text); repeated rows share a
    source position order but each keeps its own place; empty table: empty
    result; extra columns are carried through untouched.
"""

from __future__ import annotations

import heapq
import itertools
import json
import math
from collections.abc import Iterator
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ferry.llm.common import folded, landed, unfolded
from ferry.session import scratch_path

BLOCK_CHARS = 65_536
BATCH = 100_000         # blocks of the schedule that the driver holds at once
MAX_SOURCES = 100_000   # more than that are refused: weights are a stated table of that size at most
ROWS_PER_BUCKET = 256


def exact_parts(weights: dict[str, float]) -> dict[str, int]:
    """Whole numbers in exactly the proportions of the weights."""
    if any(w <= 0 or not math.isfinite(w) for w in weights.values()):
        raise ValueError("target weights must be positive and finite")
    exact = {s: Fraction(str(w)) for s, w in weights.items()}
    scale = math.lcm(*(x.denominator for x in exact.values()))
    parts = {s: int(x * scale) for s, x in exact.items()}
    common = math.gcd(*parts.values())
    return {s: n // common for s, n in parts.items()}


def _window(parts: dict[str, int], cycle: int, s: str, j: int) -> tuple[int, int]:
    """Release and deadline of block ``j`` of a source."""
    return j * cycle // parts[s], -(-(j + 1) * cycle // parts[s])


def schedule_end(parts: dict[str, int], blocks: dict[str, int]) -> int:
    """Slots of the schedule: one cycle, or less if the last block is due sooner."""
    cycle = sum(parts.values())
    return min(cycle, max(_window(parts, cycle, s, n - 1)[1] for s, n in blocks.items()))


def cycle_slots(parts: dict[str, int], blocks: dict[str, int] | None = None) -> Iterator[tuple[str, int, int, int, int]]:
    """(source, block, release, deadline, slot) of one cycle by earliest deadline first, in the order of slots.

    With ``blocks`` (how many each source has), a cycle that is longer than they
    need ends when the last of them is due, and blocks beyond them are left out.
    """
    cycle = sum(parts.values())
    waiting = [(0, s, 0) for s in sorted(parts)]
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int, int]] = []
    end = cycle if blocks is None else schedule_end(parts, blocks)
    for slot in range(end):
        while waiting and waiting[0][0] <= slot:
            release, s, j = heapq.heappop(waiting)
            heapq.heappush(ready, (_window(parts, cycle, s, j)[1], s, j, release))
        due, s, j, release = heapq.heappop(ready)  # the shares fill the cycle, so a block is always ready
        if slot >= due:
            raise AssertionError("a block missed its deadline")
        if end == cycle or j < blocks.get(s, 0):
            yield s, j, release, due, slot
        if j + 1 < parts[s]:
            heapq.heappush(waiting, (_window(parts, cycle, s, j + 1)[0], s, j + 1))


def _listed(spark: SparkSession, values: list, kind: str) -> DataFrame:
    """A small list from the driver as rows ``c``."""
    return spark.range(0, 1, 1, 1).select(F.explode(F.from_json(F.lit(json.dumps(values)), f"array<{kind}>")).alias("c"))


def schedule_table(spark: SparkSession, parts: dict[str, int], blocks: dict[str, int]) -> DataFrame:
    """``(_cs, _cj, _r, _d, _t)``: the schedule as files, written ``BATCH`` blocks at a time."""
    path = scratch_path(spark, "mixing-schedule")
    rows = cycle_slots(parts, blocks) if blocks else iter(())
    batch, schema = list(itertools.islice(rows, BATCH)), None
    while batch or schema is None:
        by_source: dict[str, list[tuple[int, int, int, int]]] = {}
        for s, *numbers in batch:
            by_source.setdefault(s, []).append(numbers)
        table = (_listed(spark, [{"s": s, "w": w} for s, w in by_source.items()], "struct<s: string, w: array<array<long>>>")
                 .select(F.col("c.s").alias("_cs"), F.explode("c.w").alias("w"))
                 .select("_cs", *[F.col("w")[i].alias(name) for i, name in enumerate(["_cj", "_r", "_d", "_t"])]))
        table.write.mode("append").parquet(path)
        batch, schema = list(itertools.islice(rows, BATCH)), table.schema
    return spark.read.schema(schema).parquet(path)


def _source_key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("null"))


def _place(id_col: str, text_col: str) -> Column:
    """What is hashed for a row's place in its source: its id, or its text where it has none."""
    return F.coalesce(F.col(id_col).cast("string"), F.md5(text_col))


def source_sizes(docs: DataFrame, source_col: str, size: Column) -> dict[str, int]:
    """Characters per source key; refuses more than ``MAX_SOURCES`` sources."""
    rows = (docs.groupBy(_source_key(F.col(source_col)).alias("s")).agg(F.sum(size).alias("n"))
            .limit(MAX_SOURCES + 1).collect())
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    return {r.s: r.n for r in rows}


def _prefix(parts: DataFrame) -> DataFrame:
    """Characters of a source before each of its buckets, summed in two steps of at most 1,024 rows a group."""
    parts = parts.withColumn("_hi", F.shiftright("_b", 10))
    high = (parts.groupBy("_s", "_hi").agg(F.sum("_n").alias("_n"))
            .withColumn("_base", F.sum("_n").over(Window.partitionBy("_s").orderBy("_hi")) - F.col("_n"))
            .select("_s", "_hi", "_base"))
    inner = F.sum("_n").over(Window.partitionBy("_s", "_hi").orderBy("_b")) - F.col("_n")
    return (parts.withColumn("_in", inner).join(high, ["_s", "_hi"])
            .select(F.col("_s").alias("_ps"), F.col("_b").alias("_pb"), (F.col("_base") + F.col("_in")).alias("_before")))


def scheduled(docs: DataFrame, weights: dict[str | None, float] | None = None, id_col: str = "doc_id",
              source_col: str = "source", text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Every row of ``docs`` with ``_block`` (of its source), ``_offset`` (characters into the block),
    ``_release``, ``_deadline`` and ``_slot``.

    ``weights`` names every source (``None`` for null); without it a source
    weighs the square root of its characters, which lifts small sources.
    """
    size = F.greatest(F.coalesce(F.length(text_col), F.lit(0)), F.lit(1)).cast("long")
    sizes = source_sizes(docs, source_col, size)
    if weights is None:
        target = {s: math.sqrt(n) for s, n in sizes.items()}
    else:
        target = {"null" if s is None else f"={s}": w for s, w in weights.items()}
        if missing := sorted(sizes.keys() - target.keys()):
            raise ValueError(f"no target weight for {missing[:10]}")
    parts = exact_parts(target) if target else {}
    blocks = {s: (n - 1) // block_chars + 1 for s, n in sizes.items()}
    slots = sum(parts.values())
    spark = docs.sparkSession
    table = schedule_table(spark, parts, blocks)
    # A schedule that was ended early holds every block and never turns.
    turning = bool(blocks) and schedule_end(parts, blocks) == slots
    per_source = landed(_listed(spark, [{"s": s, "a": parts[s] if turning else n} for s, n in blocks.items()], "struct<s: string, a: long>")
                        .select(F.col("c.s").alias("_as"), F.col("c.a").alias("_share")), "mixing-shares")

    bits = max(1, min(40, math.ceil(math.log2(max(2, docs.count() / ROWS_PER_BUCKET)))))
    keyed = (folded(docs, _s=_source_key(F.col(source_col)), _id=id_col, _h=F.xxhash64(_place(id_col, text_col)),
                    _n=size, _m=F.md5(text_col))
             .withColumn("_b", F.shiftrightunsigned("_h", 64 - bits)))
    before = _prefix(keyed.groupBy("_s", "_b").agg(F.sum("_n").alias("_n")))
    order = Window.partitionBy("_s", "_b").orderBy("_h", "_id", "_m")
    placed = (keyed.withColumn("_in", F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n"))
              .join(before, (F.col("_s") == F.col("_ps")) & (F.col("_b") == F.col("_pb")))
              .withColumn("_at", F.col("_before") + F.col("_in"))
              .withColumn("_block", F.floor(F.col("_at") / block_chars).cast("long"))
              .withColumn("_offset", F.col("_at") % block_chars))
    # One row per source, at most MAX_SOURCES: a proven bound for the broadcast.
    placed = placed.join(F.broadcast(per_source), F.col("_s") == F.col("_as"))
    placed = placed.join(table, (F.col("_s") == F.col("_cs")) & (F.col("_block") % F.col("_share") == F.col("_cj")))
    turn = F.floor(F.col("_block") / F.col("_share")).cast("long") * F.lit(slots if turning else 0)
    return placed.select(*unfolded(F.col("row"), docs.columns), "_block", "_offset", (turn + F.col("_r")).alias("_release"),
                         (turn + F.col("_d")).alias("_deadline"), (turn + F.col("_t")).alias("_slot"))


def mixed(docs: DataFrame, weights: dict[str | None, float] | None = None) -> DataFrame:
    """All rows and columns of ``docs``, in the order of the schedule."""
    return scheduled(docs, weights).orderBy("_slot", "_offset").select(*docs.columns)


def digest(docs: DataFrame) -> DataFrame:
    """One row per document: where the schedule puts it."""
    return scheduled(docs.select("doc_id", "source", "text")).select(
        "doc_id", "source", F.col("_block").alias("block"), F.col("_offset").alias("block_offset"),
        F.col("_release").alias("release_slot"), F.col("_deadline").alias("deadline_slot"),
        F.col("_slot").alias("slot"))
