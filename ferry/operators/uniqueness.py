"""UNIQUE on append: new keys are checked against a Bloom filter of the stored ones.

The filter stands beside the table (hidden folder ``_ferry_keys``) as rows of bitmaps:
a key's hash names a chunk, and four further parts of a hash a bit in each of the
chunk's four bitmaps of 32,768 bits. Chunks hold ``KEYS_PER_CHUNK`` keys on average, so about one
new key in 400 seems to be there without being so. An append joins the new keys
with the chunks (16 bits for each stored key instead of the keys themselves, no
shuffle of the table) and looks up in the table only those that seem to be there;
mostly there are none, and the table is not read at all.

Every append adds the chunks of its own keys before its rows, so a filter can know
keys that are not stored (a failed append), never the other way round. A table that
has grown by other means is found by its number of rows, and its filter is built anew.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.functions.text import quoted
from ferry.operators.checks import GuardError, unique_check
from ferry.sources.delimited import _hadoop_fs, has_data

FOLDER = "_ferry_keys"
BITS = 32_768            # of one bitmap, fixed by Spark's bitmap functions
HASHES = 4
KEYS_PER_CHUNK = 8_192
KIND = "chunks long, chunk long, b0 binary, b1 binary, b2 binary, b3 binary, keys long"


def _hash(keys: Sequence[str], seed: int) -> Column:
    """NULLs count as equal, as in a UNIQUE constraint; the place of a NULL matters."""
    return F.xxhash64(F.lit(seed), *[x for k in keys for x in (F.col(quoted(k)).isNull(), F.col(quoted(k)))])


def _bit(bits: Column, i: int) -> Column:
    return F.shiftrightunsigned(bits, 15 * i).bitwiseAND(F.lit(BITS - 1)).cast("long")


def key_filter(df: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """The chunks of ``df``'s keys (map-side combined: a task sends bitmaps, not keys)."""
    chunks = 1 << max(0, math.ceil(math.log2(max(1, rows / KEYS_PER_CHUNK))))
    placed = df.select(F.pmod(_hash(keys, 0), F.lit(chunks)).alias("chunk"), _hash(keys, 1).alias("bits"))
    maps = [F.expr("bitmap_construct_agg(p%d)" % i).alias(f"b{i}") for i in range(HASHES)]
    return placed.select("chunk", *[_bit(F.col("bits"), i).alias(f"p{i}") for i in range(HASHES)]).groupBy("chunk").agg(
        *maps, F.count(F.lit(1)).alias("keys")).select(F.lit(chunks).cast("long").alias("chunks"), "chunk",
                                                        *[f"b{i}" for i in range(HASHES)], "keys")


def _is_set(bitmap: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (bit % 8).cast("int")) == 1


def possible_hits(batch: DataFrame, filters: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct keys of ``batch`` that may be stored."""
    sizes = [r[0] for r in filters.select("chunks").distinct().collect()]  # powers of two: a few tens at most
    if not sizes:
        return batch.select(*[F.col(quoted(k)) for k in keys]).limit(0)
    key = F.struct(*[F.col(quoted(k)).alias(k) for k in keys]).alias("_key")
    asked = batch.select(key, F.explode(F.array(*[F.lit(s).cast("long") for s in sizes])).alias("chunks"),
                         _hash(keys, 0).alias("_h"), _hash(keys, 1).alias("_b"))
    asked = asked.withColumn("chunk", F.pmod(F.col("_h"), F.col("chunks")))
    met = asked.join(filters, ["chunks", "chunk"])
    for i in range(HASHES):
        met = met.where(_is_set(F.col(f"b{i}"), _bit(F.col("_b"), i)))
    return met.select("_key.*").distinct()


def append_conflicts(stored: DataFrame, batch: DataFrame, keys: Sequence[str], filters: DataFrame) -> DataFrame:
    """Keys of ``batch`` that are stored: an exact look-up of those the filter lets through."""
    seem = possible_hits(batch, filters, keys)
    if seem.isEmpty():
        return seem
    return _semi(seem, stored, keys)


def _semi(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left rows whose key is among the right rows, NULLs equal."""
    other = right.select(*[F.col(quoted(k)).alias(f"_f_{i}") for i, k in enumerate(keys)])
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(quoted(k)).eqNullSafe(F.col(f"_f_{i}"))
    return left.join(other, same, "left_semi")


class UniqueAppender:
    """Appends to a Parquet table whose ``keys`` are unique."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str]):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.folder = f"{self.path}/{FOLDER}"

    def filters(self) -> DataFrame:
        return self.spark.read.schema(KIND).parquet(self.folder) if has_data(self.spark, self.folder) else \
            self.spark.createDataFrame([], KIND)

    def stored(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def prepare(self) -> bool:
        """Build the filter if the table has rows that it does not know; True if it was built."""
        if not has_data(self.spark, self.path):
            return False
        rows = self.stored().count()  # from the files' footers
        known = self.filters().agg(F.sum("keys")).first()[0] or 0
        if known >= rows:
            return False
        made = f"{self.path}/_ferry_keys_{uuid.uuid4().hex}"
        key_filter(self.stored(), self.keys, rows).write.parquet(made)
        target, fs = _hadoop_fs(self.spark, self.folder)
        source, _ = _hadoop_fs(self.spark, made)
        fs.delete(target, True)
        fs.rename(source, target)
        return True

    def conflicts(self, batch: DataFrame) -> DataFrame:
        """Keys of ``batch`` that are stored already."""
        self.prepare()
        if not has_data(self.spark, self.path):
            return batch.select(*[F.col(quoted(k)) for k in self.keys]).limit(0)
        return append_conflicts(self.stored(), batch, self.keys, self.filters())

    def append(self, batch: DataFrame, on_conflict: str = "error") -> int:
        """Append ``batch``; the rows appended. ``on_conflict``: ``error`` refuses the batch, ``skip`` leaves out stored keys."""
        unique_check(batch, self.keys, raise_on_fail=True)
        clash = self.conflicts(batch)
        if not clash.isEmpty():
            if on_conflict != "skip":
                some = ", ".join(str(tuple(r)) for r in clash.limit(5).collect())
                raise GuardError(f"keys ({', '.join(self.keys)}) are stored already, e.g. {some}")
            other = clash.select(*[F.col(quoted(k)).alias(f"_f_{i}") for i, k in enumerate(self.keys)])
            same = F.lit(True)
            for i, k in enumerate(self.keys):
                same = same & F.col(quoted(k)).eqNullSafe(F.col(f"_f_{i}"))
            batch = batch.join(other, same, "left_anti")
        rows = batch.count()
        if rows:
            key_filter(batch, self.keys, rows).write.mode("append").parquet(self.folder)
            batch.write.mode("append").parquet(self.path)
        return rows
