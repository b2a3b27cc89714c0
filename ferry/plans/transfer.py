"""Table transfers: export, import and many tables at once, with metrics.

One transfer item is one distributed Spark job (a write). Items run from a
bounded driver thread pool under the FAIR scheduler, so small tables do not
queue behind large ones while every large table still spreads over all
executors. A failing item is recorded with its error and does not stop the
others. Metrics come back as a DataFrame ordered by table name.
"""

from __future__ import annotations

import uuid

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferry.functions.text import quoted
from ferry.functions.fingerprint import fingerprint_aggs, from_metrics, row_hashes
from ferry.sources.delimited import (FileFormat, infer_fields, read_delimited, read_header,
                                     read_records, parse_records, write_delimited)


@dataclass
class TransferResult:
    table: str
    start_time: datetime
    end_time: datetime
    rows: int | None
    error: str | None = None
    path: str | None = None
    fingerprint: tuple[int, int, int] | None = None

    @property
    def duration_ms(self) -> int:
        return int(round((self.end_time - self.start_time).total_seconds() * 1000))


METRICS_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("start_time", T.TimestampNTZType()),
    T.StructField("end_time", T.TimestampNTZType()),
    T.StructField("duration_ms", T.LongType()),
    T.StructField("rows_copied", T.LongType()),
    T.StructField("error", T.StringType()),
    T.StructField("path", T.StringType()),
])


def export_table(df: DataFrame, path: str, fmt: FileFormat, table: str = "", mode: str = "errorifexists") -> TransferResult:
    """Land one table; the error (if any) is captured in the result."""
    start = datetime.now()
    try:
        rows = write_delimited(df, path, fmt, mode=mode)
        err = None
    except Exception as exc:  # noqa: BLE001 - one failing table must not stop the others
        rows, err = None, f"{type(exc).__name__}: {str(exc).splitlines()[0] if str(exc) else ''}"
    return TransferResult(table, start, datetime.now(), rows, err, path)


def import_table(spark: SparkSession, path: str, fmt: FileFormat, file_fields: list[T.StructField] | T.StructType,
                 target: T.StructType | None = None, strict: bool = True) -> DataFrame:
    """Typed rows of a landed table (fields by position, loaded by name into ``target``)."""
    return read_delimited(spark, path, file_fields, fmt, target=target, strict=strict)


def import_by_name(spark: SparkSession, path: str, fmt: FileFormat, target: T.StructType, strict: bool = True) -> DataFrame:
    """Load a landed table with a header into ``target``, matching column names case-insensitively.

    File columns the target lacks are ignored; target columns the file lacks are NULL.
    """
    if not fmt.header:
        raise ValueError("matching by column name needs a header record")
    names = read_header(spark, path, fmt)
    tgt = {f.name.lower(): f for f in target.fields}
    file_fields = [T.StructField(tgt[n.lower()].name if n.lower() in tgt else n,
                                 tgt[n.lower()].dataType if n.lower() in tgt else T.StringType())
                   for n in names]
    return parse_records(read_records(spark, path, fmt), file_fields, fmt, target=target, strict=strict)


def import_inferred(spark: SparkSession, path: str, fmt: FileFormat, sample_fraction: float | None = None) -> DataFrame:
    """Load a landed table with column types inferred from its text (create-from-template)."""
    fields = infer_fields(spark, path, fmt, sample_fraction=sample_fraction)
    return read_delimited(spark, path, fields, fmt)


def load_inferred(spark: SparkSession, path: str, fmt: FileFormat, dest: str,
                  guess_rows: int = 10_000) -> tuple[TransferResult, list[T.StructField], int]:
    """Load a landed table into the new folder ``dest`` with inferred types; the result, the types and the scans it took.

    The types are guessed from the first records, and the load counts in the same pass what every
    column's values would be. If the guess is what all values say, that was the only scan; else the
    table is loaded once more with the types now known.
    """
    from ferry.functions.render import parse
    from ferry.sources.delimited import decide_types, discard, type_votes
    start = datetime.now()
    obs = Observation(f"ferry_infer_{uuid.uuid4().hex}")
    try:
        names = read_header(spark, path, fmt) if fmt.header else None
        records = read_records(spark, path, fmt)
        if names is None:
            first = records.limit(1).collect()
            names = [f"_c{i}" for i in range(len(first[0][0].split(fmt.field_delim)) if first else 0)]
        texts, votes = type_votes(records.limit(guess_rows), len(names), fmt)
        guess = decide_types(names, texts.agg(*votes).first().asDict())
        texts, votes = type_votes(records, len(names), fmt)
        typed = texts.observe(obs, F.count(F.lit(1)).alias("rows"), *votes).select(
            *[parse(F.col(f"c{i}"), f.dataType, strict=False).alias(f.name) for i, f in enumerate(guess)])
        typed.write.parquet(dest)
        fields, scans = decide_types(names, obs.get), 1
        if fields != guess:
            discard(spark, dest)
            read_delimited(spark, path, fields, fmt).write.parquet(dest)
            scans = 2
        rows, err = int(obs.get["rows"]), None
    except Exception as exc:  # noqa: BLE001 - one failing table must not stop the others
        fields, scans, rows, err = [], 0, None, f"{type(exc).__name__}: {str(exc).splitlines()[0] if str(exc) else ''}"
    return TransferResult(dest, start, datetime.now(), rows, err, dest), fields, scans


def load_into(df: DataFrame, target_path: str, mode: str = "append", fmt: str = "parquet") -> TransferResult:
    """Append (bulk load never truncates) or replace a target table stored at ``target_path``."""
    start = datetime.now()
    obs = Observation(f"ferry_load_{uuid.uuid4().hex}")
    try:
        df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode).format(fmt).save(target_path)
        rows, err = int(obs.get.get("rows", 0) or 0), None
    except Exception as exc:  # noqa: BLE001
        rows, err = None, f"{type(exc).__name__}: {str(exc).splitlines()[0] if str(exc) else ''}"
    return TransferResult(target_path, start, datetime.now(), rows, err, target_path)


class FingerprintTap:
    """Takes the content fingerprint of rows while a later action runs over them.

        tap = FingerprintTap(parsed)            # tap.df: the same rows, observed
        load_into(tap.df.select(...), dest)     # one pass: load and fingerprint
        tap.result()                            # only after the action succeeded

    Exact when the observed rows are in the action's final stage (a plain
    load); behind a shuffle a retried map task could count twice, which shows
    as a mismatch, never as a false match.
    """

    def __init__(self, df: DataFrame, columns: list[str] | None = None):
        self._obs = Observation(f"ferry_fp_{uuid.uuid4().hex}")
        h1, h2 = row_hashes(df, columns)
        self.df = df.observe(self._obs, *fingerprint_aggs(h1, h2))

    def result(self) -> tuple[int, int, int]:
        return from_metrics(self._obs.get)


def run_parallel(spark: SparkSession, items: list[tuple[str, Callable[[], TransferResult]]],
                 parallel: int = 4, weights: list[int] | None = None) -> list[TransferResult]:
    """Run transfer items from a bounded pool of driver threads, one FAIR pool per item; results in the items' order.

    With ``weights`` (bytes, about) the heaviest start first, so that a large table that happens to be
    listed last does not run alone at the end: the run takes at most 4/3 of the best possible time.
    """
    sc = spark.sparkContext

    def run(item: tuple[str, Callable[[], TransferResult]]) -> TransferResult:
        name, fn = item
        sc.setLocalProperty("spark.scheduler.pool", f"ferry-{name}")
        try:
            res = fn()
        except Exception as exc:  # noqa: BLE001
            now = datetime.now()
            res = TransferResult(name, now, now, None, f"{type(exc).__name__}: {exc}")
        finally:
            sc.setLocalProperty("spark.scheduler.pool", None)
        res.table = name
        return res

    if parallel <= 1 or len(items) <= 1:
        return [run(i) for i in items]
    order = sorted(range(len(items)), key=lambda i: -weights[i]) if weights else list(range(len(items)))
    with ThreadPoolExecutor(max_workers=min(parallel, len(items))) as pool:
        done = dict(zip(order, pool.map(run, [items[i] for i in order])))
    return [done[i] for i in range(len(items))]


def export_all(spark: SparkSession, tables: dict[str, DataFrame | Callable[[], DataFrame]], base_path: str,
               fmt: FileFormat, parallel: int = 4) -> list[TransferResult]:
    """Land every table under ``base_path/<table>``; results in input order.

    A table may be given as a loader (``lambda: spark.read.parquet(p)``): it
    then runs inside its worker thread, so the per-table schema reads overlap
    instead of running one after another on the driver.
    """
    def item(name: str, src) -> TransferResult:
        df = src() if callable(src) else src
        return export_table(df, f"{base_path.rstrip('/')}/{name}", fmt, name)

    return run_parallel(spark, [(n, (lambda n=n, d=d: item(n, d))) for n, d in tables.items()], parallel)


def metrics_frame(spark: SparkSession, results: list[TransferResult]) -> DataFrame:
    """Job-result records as a DataFrame: raw numbers plus the report's text forms.

    Text forms use thousands separators and ``?`` when a figure is unknown;
    speed is rows per second over the wall-clock duration.
    """
    rows = [(r.table, r.start_time, r.end_time, r.duration_ms, r.rows, r.error, r.path) for r in results]
    df = spark.createDataFrame(rows, METRICS_SCHEMA)
    speed = F.when(F.col("duration_ms") > 0,
                   (F.col("rows_copied") * 1000 / F.col("duration_ms")).cast("long"))
    return (df.withColumn("rows_per_sec", speed)
            .withColumn("rows_text", F.coalesce(F.format_number("rows_copied", 0), F.lit("?")))
            .withColumn("duration_text", F.coalesce(F.format_number("duration_ms", 0), F.lit("?")))
            .withColumn("speed_text", F.coalesce(F.format_number("rows_per_sec", 0), F.lit("?")))
            .withColumn("error", F.coalesce("error", F.lit("None")))
            .orderBy("table_name"))


# The headings of the per-table job report, in their order.
REPORT_HEADINGS = ("Table", "StartTime", "EndTime", "Duration [ms]", "RowsCopied", "Speed [rows/s]", "Error")


def report_frame(metrics: DataFrame) -> DataFrame:
    """The job report as printed after a run: text figures (thousands separators, ``?``), sorted by table."""
    cols = ["table_name", "start_time", "end_time", "duration_text", "rows_text", "speed_text", "error"]
    return metrics.select(*[F.col(c).alias(h) for c, h in zip(cols, REPORT_HEADINGS)]).orderBy("Table")


def verify_round_trip(source: DataFrame, landed: DataFrame) -> DataFrame:
    """Rows whose copy count differs between the two sides; empty = exact copy (as multisets).

    One aggregation over the union of both sides, grouped by every column:
    a single shuffle (two ``exceptAll`` would need two), and identical rows
    are combined map-side before it.
    """
    cols = source.columns
    # map columns cannot be grouped: they are compared through their JSON text
    maps = {f.name for f in source.schema.fields if "map<" in f.dataType.simpleString()}

    def side(df: DataFrame, s: int, l: int) -> DataFrame:
        return df.select(*[F.to_json(F.col(quoted(c))).alias(c) if c in maps else F.col(quoted(c)) for c in cols],
                         F.lit(s).alias("_f_s"), F.lit(l).alias("_f_l"))

    tagged = side(source, 1, 0).unionByName(side(landed, 0, 1))
    counts = tagged.groupBy(*[F.col(quoted(c)) for c in cols]).agg(F.sum("_f_s").alias("source_rows"), F.sum("_f_l").alias("landed_rows"))
    return counts.filter(F.col("source_rows") != F.col("landed_rows"))


def _fingerprint_row(df: DataFrame, columns: list[str], side: int) -> DataFrame:
    d = df.select(*[F.col(quoted(c)) for c in columns])
    h1, h2 = row_hashes(d)
    return d.agg(F.lit(side).alias("side"), *fingerprint_aggs(h1, h2))


def fingerprints(*dfs: DataFrame, columns: list[str] | None = None) -> list[tuple[int, int, int]]:
    """Order-independent content fingerprints (rows, sum of xxhash64, sum of a second row hash).

    All tables are reduced in one job (their scans run side by side) by
    map-side partial sums - no shuffle of rows. Sums are exact decimals (no
    overflow); equal multisets always give equal fingerprints, different ones
    collide only by 64-bit hash accident.
    """
    cols = columns or dfs[0].columns
    parts = [_fingerprint_row(d, cols, i) for i, d in enumerate(dfs)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    rows = {r["side"]: r.asDict() for r in out.collect()}
    return [from_metrics(rows[i]) for i in range(len(dfs))]


def fingerprint(df: DataFrame, columns: list[str] | None = None) -> tuple[int, int, int]:
    return fingerprints(df, columns=columns)[0]


def same_content(source: DataFrame, landed: DataFrame) -> bool:
    """Cheap multiset equality of two tables with the same columns (see ``fingerprints``)."""
    a, b = fingerprints(source, landed, columns=source.columns)
    return a == b
