"""Order-independent content fingerprints as aggregate expressions.

Two independent 64-bit row hashes (xxhash64, and xxhash64 with a constant
prefix) summed as exact decimals, plus the row count. Equal multisets of rows
always give equal fingerprints; different ones collide only by hash accident.
The aggregates combine map-side, so they can ride along any pass over the
rows: a write's ``Observation``, or a one-row aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferry.functions.text import quoted


def hash_inputs(df: DataFrame, columns: list[str] | None = None) -> list[Column]:
    """Columns as hash inputs; maps (not hashable) go through their JSON text."""
    fields = [df.schema[c] for c in (columns or df.columns)]
    return [F.to_json(F.col(quoted(f.name))) if "map<" in f.dataType.simpleString() else F.col(quoted(f.name)) for f in fields]


def row_hashes(df: DataFrame, columns: list[str] | None = None) -> tuple[Column, Column]:
    cols = hash_inputs(df, columns)
    return (F.xxhash64(*cols).cast("decimal(38,0)"),
            F.xxhash64(F.lit("ferry-fp-2"), *cols).cast("decimal(38,0)"))


def fingerprint_aggs(h1: Column, h2: Column, prefix: str = "fp") -> list[Column]:
    """(rows, sum h1, sum h2) aggregates named ``{prefix}_n``, ``{prefix}_a``, ``{prefix}_b``."""
    return [F.count(F.lit(1)).alias(f"{prefix}_n"), F.coalesce(F.sum(h1), F.lit(0)).alias(f"{prefix}_a"),
            F.coalesce(F.sum(h2), F.lit(0)).alias(f"{prefix}_b")]


def from_metrics(m: dict, prefix: str = "fp") -> tuple[int, int, int]:
    return int(m.get(f"{prefix}_n") or 0), int(m.get(f"{prefix}_a") or 0), int(m.get(f"{prefix}_b") or 0)
