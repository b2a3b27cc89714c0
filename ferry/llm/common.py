"""Shared pieces: reading tables, cutting lineage in the shared folder, row hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.session import checkpoint_dir, scratch_path

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"
ASCII_SPACE = " \t\n\x0b\x0c\r"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, by Spark's reader only (the path may be any store Spark reads)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def landed(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    The files survive lost executors and cut the lineage; Parquet keeps them
    smaller than ``checkpoint()`` does.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.options(**({"compression": compression} if compression else {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (shared folder) of a small frame inside an iteration."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def folded(docs: DataFrame, **named: Column | str) -> DataFrame:
    """``docs`` as one struct column ``row`` beside the named columns, so that no extra column can clash."""
    own = [c if isinstance(c, Column) else F.col(c) for c in named.values()]
    return docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"),
                       *[c.alias(name) for name, c in zip(named, own)])


def unfolded(row: Column, names: list[str], **changed: Column) -> list[Column]:
    """The columns of a struct made by :func:`folded`, some of them replaced."""
    return [(changed[c] if c in changed else row.getField(c)).alias(c) for c in names]


def is_held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """True where crc32 of the id's decimal text leaves ``remainder``; null ids are never held out."""
    crc = F.crc32(doc_id.cast("string").cast("binary"))
    return F.coalesce(F.pmod(crc, F.lit(modulus)) == remainder, F.lit(False))


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
