"""Loads that list the records they cannot take, under an error budget.

A bulk load that stops at its first bad record helps nobody with a million good
ones. Here every record is checked while it is parsed: its number of fields, every
field against its type, columns that must not be NULL. Good records are loaded; bad ones
are written, as they are, with the reason and where they were found. The counts
come from the load's own pass; a clean load reads the text once, one with bad records a
second time to list them. More bad records than the budget allows fail the load, and the
target stays as it was (the list is written all the same).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferry.functions.render import parse, untoken
from ferry.functions.text import quoted
from ferry.plans.transfer import TransferResult
from ferry.sources.delimited import FileFormat, discard, header_line, known_header_parts, publish, read_header

_JSON = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
REASON = "_f_reason"


@dataclass
class LoadReport:
    result: TransferResult
    rejected: int
    rejects_path: str | None


def _fits(text: Column, dt: T.DataType) -> Column:
    """False where a present text is not a value of the type."""
    value = F.get_json_object(text, "$") if isinstance(dt, _JSON) else parse(text, dt, strict=False)
    return text.isNull() | value.isNotNull()


def checked(spark: SparkSession, path: str, fields: Sequence[T.StructField] | T.StructType, fmt: FileFormat,
            required: Sequence[str] = ()) -> DataFrame:
    """Typed columns with the record's ``value``, ``file``, ``split_start`` and the reason (NULL: good) beside them."""
    fields = list(fields.fields if isinstance(fields, T.StructType) else fields)
    raw = spark.read.option("lineSep", fmt.line_sep).text(path).select(
        "value", F.col("_metadata.file_path").alias("_f_file"), F.col("_metadata.file_block_start").alias("_f_start"),
        F.col("_metadata.file_name").alias("_f_name"))
    if fmt.header:
        known = known_header_parts(spark, path)
        if known is not None:
            raw = raw.where(~F.col("_f_name").isin(known))
        else:  # foreign: the header's text at the beginning of a file
            raw = raw.where((F.col("value") != F.lit(header_line(read_header(spark, path, fmt), fmt))) | (F.col("_f_start") > 0))
    parts = F.split("value", fmt.split_regex, -1)
    text = raw.select("*", parts.alias("_f_parts"))
    text = text.select("value", "_f_file", "_f_start", F.size("_f_parts").alias("_f_n"),
                       *[untoken(F.get("_f_parts", F.lit(i)), fmt.nulls).alias(f"_f_t{i}") for i in range(len(fields))])
    must = {r.lower() for r in required} | {f.name.lower() for f in fields if not f.nullable}
    reason = F.when(F.col("_f_n") != len(fields), F.concat(F.lit("record has "), F.col("_f_n").cast("string"),
                                                           F.lit(f" fields, {len(fields)} expected")))
    for i, f in enumerate(fields):
        t = F.col(f"_f_t{i}")
        if not isinstance(f.dataType, (T.StringType, T.NullType)):
            reason = reason.when(~_fits(t, f.dataType), F.concat(F.lit(f"column {f.name}: "), F.substring(t, 1, 100),
                                                                 F.lit(f" is not {f.dataType.simpleString()}")))
        if f.name.lower() in must:
            reason = reason.when(t.isNull(), F.lit(f"column {f.name} is NULL"))
    return text.select(*[parse(F.col(f"_f_t{i}"), f.dataType, strict=False).alias(f.name) for i, f in enumerate(fields)],
                       F.col("value").alias("_f_value"), "_f_file", "_f_start", reason.alias(REASON))


def rejects(rows: DataFrame) -> DataFrame:
    """``(file, split_start, record, reason)`` of the bad records: the split of the file in which a record begins."""
    return rows.where(F.col(REASON).isNotNull()).select(F.col("_f_file").alias("file"), F.col("_f_start").alias("split_start"),
                                                        F.col("_f_value").alias("record"), F.col(REASON).alias("reason"))


def load_with_rejects(spark: SparkSession, path: str, fields: Sequence[T.StructField] | T.StructType, fmt: FileFormat, dest: str,
                      rejects_path: str, max_rejects: int = 0, required: Sequence[str] = ()) -> LoadReport:
    """Append the good records of a landing to ``dest`` and write the bad ones to ``rejects_path`` (Parquet).

    More than ``max_rejects`` bad records: an error in the result, nothing is appended.
    """
    start = datetime.now()
    rows = checked(spark, path, fields, fmt, required)
    names = [f.name for f in (fields.fields if isinstance(fields, T.StructType) else fields)]
    seen = Observation(f"ferry_rejects_{uuid.uuid4().hex}")
    counted = rows.observe(seen, F.count_if(F.col(REASON).isNull()).alias("good"), F.count_if(F.col(REASON).isNotNull()).alias("bad"))
    made = f"{dest.rstrip('/')}/_ferry_load_{uuid.uuid4().hex}"
    try:
        counted.where(F.col(REASON).isNull()).select(*[F.col(quoted(n)) for n in names]).write.parquet(made)
        good, bad = int(seen.get["good"]), int(seen.get["bad"])
        if bad:
            rejects(rows).write.mode("append").parquet(rejects_path)
    except Exception:
        discard(spark, made)
        raise
    if bad > max_rejects:
        discard(spark, made)
        error = f"{bad} records rejected, {max_rejects} allowed: see {rejects_path}"
        return LoadReport(TransferResult(dest, start, datetime.now(), None, error, dest), bad, rejects_path)
    publish(spark, made, dest, replace_all=False)
    return LoadReport(TransferResult(dest, start, datetime.now(), good, None, dest), bad, rejects_path if bad else None)
