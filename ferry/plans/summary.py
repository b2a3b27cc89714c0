"""A data dictionary that is kept up batch by batch.

Every batch leaves one row a column: rows, NULLs, smallest and largest value, a HyperLogLog sketch of its
distinct values and, for numbers and times, a quantile sketch. Sketches of batches merge, so the
summary of a table follows from its batches' rows (a few KB each), and a new batch never makes the
table be read again. All of a batch's rows come from one pass over it.

Merged counts of rows, NULLs and extremes are exact. Distinct counts of merged batches equal those of one pass
(the same registers), within about 2 % of the truth (``LG_K`` 14); quantiles are within about 2 % of the rank (``KLL_K`` 400).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferry.functions.text import quoted
from ferry.sources.delimited import has_data

LG_K = 14
KLL_K = 400
QUANTILES = (0.25, 0.5, 0.75)
KIND = ("table_name string, batch string, ordinal int, column_name string, rows long, nulls long, least string, most string, "
        "distinct binary, quantiles binary")


def _value(f: T.StructField) -> Column:
    c = F.col(quoted(f.name))
    return F.to_json(c) if isinstance(f.dataType, (T.MapType, T.ArrayType, T.StructType)) else c


def _measure(f: T.StructField) -> Column | None:
    """The column as a number that orders as it does; None where there is none."""
    c = F.col(quoted(f.name))
    if isinstance(f.dataType, T.NumericType):
        return c.cast("double")
    if isinstance(f.dataType, T.TimestampType):
        return F.unix_micros(c).cast("double")
    if isinstance(f.dataType, T.TimestampNTZType):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if isinstance(f.dataType, T.DateType):
        return F.unix_date(c).cast("double")
    return None


def batch_summary(df: DataFrame, table: str, batch: str) -> DataFrame:
    """One row for each column of a batch, in one pass."""
    fields = df.schema.fields
    aggs, cells = [F.count(F.lit(1)).alias("rows")], []
    for i, f in enumerate(fields):
        v, m = _value(f), _measure(f)
        # NaN counts as a value but has no place among quantiles.
        kll = F.kll_sketch_agg_double(F.when(~F.isnan(m), m), KLL_K) if m is not None else F.lit(None).cast("binary")
        order = m is not None or isinstance(f.dataType, (T.StringType, T.BooleanType))
        aggs += [F.count_if(v.isNull()).alias(f"n{i}"), F.hll_sketch_agg(F.xxhash64(v), LG_K).alias(f"h{i}"),
                 (F.min(v).cast("string") if order else F.lit(None).cast("string")).alias(f"a{i}"),
                 (F.max(v).cast("string") if order else F.lit(None).cast("string")).alias(f"z{i}"), kll.alias(f"q{i}")]
        cells.append(F.struct(F.lit(i + 1).alias("ordinal"), F.lit(f.name).alias("column_name"), F.col("rows"), F.col(f"n{i}").alias("nulls"),
                              F.col(f"a{i}").alias("least"), F.col(f"z{i}").alias("most"), F.col(f"h{i}").alias("distinct"),
                              F.col(f"q{i}").alias("quantiles")))
    return df.agg(*aggs).select(F.explode(F.array(*cells)).alias("c")).select(
        F.lit(table).alias("table_name"), F.lit(batch).alias("batch"), "c.*")


class RunningSummary:
    """The batches' rows of any number of tables in one folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def batches(self) -> DataFrame:
        return self.spark.read.schema(KIND).parquet(self.path) if has_data(self.spark, self.path) else \
            self.spark.createDataFrame([], KIND)

    def add(self, df: DataFrame, table: str, batch: str) -> bool:
        """Take a batch in; False if it is known already."""
        if not self.batches().where((F.col("table_name") == table) & (F.col("batch") == batch)).isEmpty():
            return False
        batch_summary(df, table, batch).write.mode("append").parquet(self.path)
        return True

    def summary(self, quantiles: Sequence[float] = QUANTILES) -> DataFrame:
        return merged(self.batches(), quantiles)


def merged(batches: DataFrame, quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """``(table_name, ordinal, column_name, rows, nulls, distinct_values, quantiles)`` of all batches together."""
    # Every distinct-count sketch is united twice: a sketch that was never united counts by the order in which its
    # values came, united ones by their registers alone, so only then one pass and many batches give the same number.
    first = F.col("again") == 0
    total = batches.withColumn("again", F.explode(F.array(F.lit(0), F.lit(1)))).groupBy("table_name", "ordinal", "column_name").agg(
        F.sum(F.when(first, F.col("rows"))).alias("rows"), F.sum(F.when(first, F.col("nulls"))).alias("nulls"),
        F.hll_union_agg("distinct").alias("d"), F.kll_merge_agg_double(F.when(first, F.col("quantiles"))).alias("q"),
        F.max((F.col("nulls") > 0).cast("int")).alias("some_null"))
    # A NULL is hashed like a value, so it takes one of the distinct values counted.
    count = F.greatest(F.hll_sketch_estimate("d") - F.col("some_null"), F.lit(0))
    some = F.coalesce(F.kll_sketch_get_n_double("q"), F.lit(0)) > 0
    return total.select("table_name", "ordinal", "column_name", "rows", "nulls", count.alias("distinct_values"),
                        F.when(some, F.array(*[F.kll_sketch_get_quantile_double("q", F.lit(float(x))) for x in quantiles])).alias("quantiles"))
