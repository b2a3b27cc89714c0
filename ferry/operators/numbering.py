"""Row numbering, identity values and "next / last row" tests without hot tasks.

A plain ``Window.partitionBy(g).orderBy(k)`` sends every row of a group to one
task, and a window without ``partitionBy`` sends the whole table to one task.

Groups are measured first (rows and bytes, map-side combined). Groups below
``HOT_ROWS`` and ``HOT_BYTES`` take the plain window: one exchange of full rows.
Larger ones - there are at most rows / ``HOT_ROWS`` + bytes / ``HOT_BYTES`` of
them - and numbering without groups are *range*-partitioned on (group, order keys, tie-breaker), so a hot group is cut
into consecutive pieces on several partitions:

  1. ``repartitionByRange`` + ``sortWithinPartitions``; the tie-breaker is a hash
     of the remaining columns, so equal order keys still split and the driver's
     range sample stays small;
  2. every row gets its partition and position, and the result is checkpointed
     in the shared folder: piece table and rows are read from the same files,
     whatever Spark reuses or recomputes;
  3. the piece table - at most one row per partition and hot group boundary -
     carries counts and first positions; a window over a group's pieces yields
     each piece's offset, and the pieces are broadcast to the rows.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferry.functions.fingerprint import hash_inputs
from ferry.functions.text import quoted
from ferry.session import checkpoint_dir

_PID, _MID, _START, _END, _N, _OFF, _LASTPIECE = "_f_pid", "_f_mid", "_f_start", "_f_end", "_f_n", "_f_off", "_f_lastpiece"


def _col(c: Column | str) -> Column:
    return F.col(quoted(c)) if isinstance(c, str) else c


def _names(cols: Sequence[Column | str]) -> set[str]:
    return {c for c in cols if isinstance(c, str)}


TARGET_PARTITION_BYTES = 128 * 1024 * 1024
HOT_ROWS = 2_000_000
HOT_BYTES = 256 * 1024 * 1024


def range_partitions(df: DataFrame, target_bytes: int = TARGET_PARTITION_BYTES) -> int:
    """Range-partition count for ``df``: about ``target_bytes`` per partition.

    The count must be explicit (AQE never re-coalesces an explicit count, which
    keeps partition ids stable), so it comes from the size of the plan's
    inputs: the sum of its leaf relations with a known size (file scans report
    their bytes; Catalyst's estimate of a whole plan multiplies join inputs, and
    unknown sources report the maximum). Never below the cluster's total cores
    (``defaultParallelism``), so every core takes part; AQE cannot shrink an
    explicit count, so tiny inputs should not get hundreds of tasks either.
    """
    spark = df.sparkSession
    try:
        floor = int(spark.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001 - no SparkContext access (e.g. a remote session)
        floor = int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = input_bytes(df)
    return floor if known is None else max(floor, -(-known // target_bytes))


def input_bytes(df: DataFrame) -> int | None:
    """Bytes of the inputs of a plan as far as they are known (None: not at all), without running it."""
    spark = df.sparkSession
    unknown = int(spark.conf.get("spark.sql.defaultSizeInBytes", str(2 ** 63 - 1)))
    try:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    except Exception:  # noqa: BLE001 - no estimate
        return None
    known = [x for x in sizes if x < unknown]
    return sum(known) if known else None


def row_bytes(df: DataFrame) -> tuple[int, Column | None]:
    """About how many bytes a row takes: 8 a column, and the lengths of texts and nested values (None: there are none)."""
    lengths = [F.octet_length(_col(f.name) if isinstance(f.dataType, (T.StringType, T.BinaryType)) else _col(f.name).cast("string"))
               for f in df.schema.fields
               if isinstance(f.dataType, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType))]
    more = [F.coalesce(x, F.lit(0)).cast("long") for x in lengths]
    return 8 * len(df.columns), functools.reduce(lambda a, b: a + b, more) if more else None


def spread(df: DataFrame, order_by: Sequence[Column | str], partition_by: Sequence[str] = (),
           num_partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(ranged rows with piece id and position, piece table with offsets)."""
    n = num_partitions or range_partitions(df)
    used = set(partition_by) | _names(order_by)
    rest = [f.name for f in df.schema.fields if f.name not in used]
    # one 64-bit hash of the other columns breaks ties: it splits a hot key over
    # partitions while the range sample the driver collects stays a few longs
    # per row, whatever the width of the columns (whole texts, maps)
    tie = [F.xxhash64(*hash_inputs(df, rest))] if rest else []
    keys = [_col(c) for c in partition_by] + [_col(c) for c in order_by] + tie
    checkpoint_dir(df.sparkSession)
    ranged = (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
              .withColumn(_PID, F.spark_partition_id())
              .withColumn(_MID, F.monotonically_increasing_id())).checkpoint(eager=True)
    groups = [_col(c) for c in partition_by]
    pieces = ranged.groupBy(_PID, *groups).agg(F.count(F.lit(1)).alias(_N), F.min(_MID).alias(_START),
                                      F.max(_MID).alias(_END))
    w = Window.partitionBy(*groups).orderBy(_PID) if partition_by else Window.orderBy(_PID)
    pieces = (pieces.withColumn(_OFF, F.coalesce(F.sum(_N).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .withColumn(_LASTPIECE, F.lead(_PID).over(w).isNull()))
    return ranged, pieces


def _attach(ranged: DataFrame, pieces: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows with their piece; the pieces are few (see the module text)."""
    names = [c for c in pieces.columns if c != _PID and c not in partition_by]
    renamed = pieces.select(F.col(_PID).alias("_f_ppid"), *[_col(c).alias(f"_f_g{i}") for i, c in enumerate(partition_by)], *names)
    cond = F.col(_PID) == F.col("_f_ppid")
    for i, c in enumerate(partition_by):
        cond = cond & _col(c).eqNullSafe(F.col(f"_f_g{i}"))
    return ranged.join(F.broadcast(renamed), cond).drop("_f_ppid", *[f"_f_g{i}" for i in range(len(partition_by))])


def _clean(df: DataFrame) -> DataFrame:
    return df.drop(_PID, _MID, _START, _END, _N, _OFF, _LASTPIECE)


def _by_size(df: DataFrame, partition_by: Sequence[str], hot_rows: int) -> tuple[DataFrame | None, DataFrame | None]:
    """(rows of ordinary groups, rows of hot groups); None where there are no such rows."""
    if not partition_by:
        return None, df
    fixed, more = row_bytes(df)
    rows, size = F.count(F.lit(1)), F.count(F.lit(1)) * fixed
    keys = (df.groupBy(*[_col(c) for c in partition_by]).agg(rows.alias(_N), (size if more is None else size + F.sum(more)).alias(_MID))
            .where((F.col(_N) >= hot_rows) | (F.col(_MID) >= HOT_BYTES)))
    checkpoint_dir(df.sparkSession)
    hot = keys.select(*[_col(c).alias(f"_f_g{i}") for i, c in enumerate(partition_by)]).checkpoint(eager=True)
    if not hot.take(1):
        return df, None
    cond = F.lit(True)
    for i, c in enumerate(partition_by):
        cond = cond & _col(c).eqNullSafe(F.col(f"_f_g{i}"))
    return df.join(F.broadcast(hot), cond, "left_anti"), df.join(F.broadcast(hot), cond, "left_semi")


def _united(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def row_number(df: DataFrame, order_by: Sequence[Column | str], partition_by: Sequence[str] = (),
               out: str = "row_number", start: int = 1, step: int = 1, num_partitions: int | None = None,
               hot_rows: int = HOT_ROWS) -> DataFrame:
    """ROW_NUMBER() OVER ([PARTITION BY ...] ORDER BY ...) as ``out`` (first column)."""
    cold, hot = _by_size(df, partition_by, hot_rows)
    rest = [_col(c) for c in df.columns]
    parts = []
    if cold is not None:
        w = Window.partitionBy(*[_col(c) for c in partition_by]).orderBy(*[_col(c) for c in order_by])
        parts.append(cold.select(((F.row_number().over(w) - 1) * step + start).cast("long").alias(out), *rest))
    if hot is not None:
        ranged, pieces = spread(hot, order_by, partition_by, num_partitions)
        rn = (F.col(_MID) - F.col(_START) + F.col(_OFF)) * step + start
        parts.append(_attach(ranged, pieces, partition_by).select(rn.cast("long").alias(out), *rest))
    return _united(parts)


def identity_generate(df: DataFrame, order_by: Sequence[Column | str], out: str = "id", seed: int = 1,
                      step: int = 1, num_partitions: int | None = None) -> DataFrame:
    """IDENTITY(seed, step) values for rows in ``order_by`` order: dense, gap-free."""
    return row_number(df, order_by, (), out, seed, step, num_partitions)


def last_in_group(df: DataFrame, order_by: Sequence[Column | str], partition_by: Sequence[str],
                  out: str = "is_last", num_partitions: int | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """LEAD(x) OVER (PARTITION BY g ORDER BY k) IS NULL: the last row of each group."""
    cold, hot = _by_size(df, partition_by, hot_rows)
    parts = []
    if cold is not None:
        w = Window.partitionBy(*[_col(c) for c in partition_by]).orderBy(*[_col(c) for c in order_by])
        parts.append(cold.withColumn(out, F.lead(F.lit(1)).over(w).isNull()))
    if hot is not None:
        ranged, pieces = spread(hot, order_by, partition_by, num_partitions)
        flag = (F.col(_MID) == F.col(_END)) & F.col(_LASTPIECE)
        parts.append(_clean(_attach(ranged, pieces, partition_by).withColumn(out, flag)))
    return _united(parts)


def next_key(df: DataFrame, key: str, partition_by: Sequence[str], out: str = "next_key",
             num_partitions: int | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """COALESCE(MIN(key) over the following rows of the group, key + 1) for a unique key.

    In a hot group the next row is a ``lead`` inside the piece - several pieces,
    so several tasks; the last row of a piece takes the first key of the next
    piece of its group.
    """
    cold, hot = _by_size(df, partition_by, hot_rows)
    groups = [_col(c) for c in partition_by]
    parts = []
    if cold is not None:
        w = Window.partitionBy(*groups).orderBy(_col(key))
        parts.append(cold.withColumn(out, F.coalesce(F.lead(_col(key)).over(w), _col(key) + 1)))
    if hot is not None:
        ranged, _ = spread(hot, [key], partition_by, num_partitions)
        firsts = ranged.groupBy(_PID, *groups).agg(F.min(_col(key)).alias("_f_first"))
        w = Window.partitionBy(*groups).orderBy(_PID) if partition_by else Window.orderBy(_PID)
        nxt = firsts.withColumn("_f_next_piece", F.lead("_f_first").over(w)).drop("_f_first")
        rows = ranged.withColumn("_f_lead", F.lead(_col(key)).over(Window.partitionBy(_PID, *groups).orderBy(_MID)))
        res = _attach(rows, nxt, partition_by).withColumn(
            out, F.coalesce(F.col("_f_lead"), F.col("_f_next_piece"), _col(key) + 1))
        parts.append(_clean(res.drop("_f_lead", "_f_next_piece")))
    return _united(parts)
