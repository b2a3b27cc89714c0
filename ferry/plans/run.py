"""The whole transfer: choose tables and columns, guard, land, load, report.

    plans = plan_transfer(spark, catalog, TransferOptions(...), schemas="Sales",
                          tables="Order*", columns_except="Notes*")
    what_if(plans, opts)                              # rows / bytes, writes nothing
    exported = run_export(spark, plans, landing, opts)
    loaded = run_import(spark, plans, landing, target_root, opts)

Table and column choice is catalog metadata (driver side, bounded by the
number of tables and columns). Every data step is a distributed Spark job:
one shuffle-free write per table on export, one shuffle-free read + append
per table on import, run concurrently from a bounded thread pool.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferry.functions.render import is_supported
from ferry.operators.columns import COLUMNS_SCHEMA, choose_columns, columns_rows, flag_of, unknown_names
from ferry.operators.numbering import identity_generate, input_bytes
from ferry.plans.catalog import SelectionError, TableRef, plan_preview, select_tables
from ferry.plans.transfer import (FingerprintTap, TransferResult, fingerprints, import_table,
                                  load_inferred, load_into, metrics_frame, run_parallel)
from ferry.functions.text import quoted
from ferry.plans.control import Claimed, WorkLog
from ferry.sources.delimited import (FileFormat, discard, folder_bytes, has_data, publish, read_manifest, refusal, refuse, settle,
                                     write_delimited, write_manifest)


@dataclass(frozen=True)
class TransferOptions:
    fmt: FileFormat = FileFormat()
    columns_except: str | list[str] | None = None
    types_except: str | list[str] | None = None
    export_identity: bool = True
    export_computed: bool = False
    allow_not_null_exceptions: bool = False
    check_delimiters: bool = True
    strict: bool = False           # an excluded column that no chosen table has is an error
    parallel: int = 4
    target: str = "typed"          # "typed": append by name into existing / source schema; "inferred": replace
    identity_order: dict[str, list[str]] = field(default_factory=dict)
    landing_mode: str = "overwrite"  # re-export replaces a table's landed files; "append" adds parts
    verify: bool = True            # after a typed load, compare content fingerprints of source and target
    list_sep: str = ","            # separator of the name lists
    wildcard: str | None = "*"     # wildcard character of the name lists (None: no wildcards)


@dataclass
class TablePlan:
    ref: TableRef
    source: DataFrame
    exported: DataFrame
    error: str | None = None

    @property
    def name(self) -> str:
        return self.ref.full_name


def _not_null(f: T.StructField) -> bool:
    return flag_of(f, "not_null") or not f.nullable


def plan_table(spark: SparkSession, ref: TableRef, opts: TransferOptions, df: DataFrame | None = None) -> TablePlan:
    """Column rules and schema guards for one table (no data is read)."""
    src = df if df is not None else ref.read(spark)
    exported = choose_columns(src, opts.columns_except, opts.types_except, opts.export_identity,
                              opts.export_computed, opts.wildcard, opts.list_sep)
    kept = set(exported.columns)
    error = None
    unmapped = [f"{f.name} {f.dataType.simpleString()}" for f in exported.schema.fields if not is_supported(f.dataType)]
    if unmapped:
        error = "no type mapping for: " + ", ".join(unmapped)
    # A NOT NULL column dropped by the name / type lists cannot be loaded (flag drops are expected).
    dropped_by_list = [f for f in src.schema.fields if f.name not in kept
                       and not (flag_of(f, "identity") or flag_of(f, "computed"))]
    bad = [f.name for f in dropped_by_list if _not_null(f)]
    if bad and not opts.allow_not_null_exceptions and error is None:
        error = "excluded columns are NOT NULL in the source: " + ", ".join(bad)
    if not exported.columns and error is None:
        error = "no column left to export"
    return TablePlan(ref, src, exported, error)


def plan_transfer(spark: SparkSession, catalog: list[TableRef], opts: TransferOptions, schemas=None, tables=None,
                  schemas_except=None, tables_except=None, all_tables: bool = False) -> list[TablePlan]:
    refs = select_tables(catalog, schemas, tables, schemas_except, tables_except, all_tables,
                         wildcard=opts.wildcard, sep=opts.list_sep)
    # each plan reads one table's schema (a small Spark job): overlap them
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=max(1, min(opts.parallel, len(refs)))) as pool:
        plans = list(pool.map(lambda r: plan_table(spark, r, opts), refs))
    if opts.strict:
        missing = [set(unknown_names(p.source, opts.columns_except, opts.wildcard, opts.list_sep)) for p in plans]
        if unknown := set.intersection(*missing):
            raise SelectionError("excluded columns not found in any chosen table: " + ", ".join(sorted(unknown)))
    return plans


def columns_report(spark: SparkSession, plans: list[TablePlan]) -> DataFrame:
    """All columns of all chosen tables with their flags, ordered by table and ordinal."""
    rows = [row for p in plans for row in columns_rows(p.name, p.source, p.exported)]
    return spark.createDataFrame(rows, COLUMNS_SCHEMA).orderBy("table_name", "ordinal")


LAYOUT_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()), T.StructField("field_no", T.IntegerType()),
    T.StructField("column_name", T.StringType()), T.StructField("data_type", T.StringType()),
    T.StructField("rendering", T.StringType()), T.StructField("max_length", T.IntegerType()),
    T.StructField("terminator", T.StringType()),
])


def format_layout(spark: SparkSession, plans: list[TablePlan], fmt: FileFormat) -> DataFrame:
    """The landed files' field layout per table, from metadata only (no data read).

    Field numbers follow the exported columns; the last field ends with the
    record separator, the others with the field delimiter; ``max_length`` is
    the longest text the column's type can render to (NULL: unbounded).
    """
    from ferry.functions.render import max_text_length, rendering_rule
    rows = []
    for p in plans:
        if p.error:
            continue
        fields = p.exported.schema.fields
        for i, f in enumerate(fields):
            rows.append((p.name, i + 1, f.name, f.dataType.simpleString(), rendering_rule(f.dataType),
                         max_text_length(f.dataType), fmt.line_sep if i == len(fields) - 1 else fmt.field_delim))
    return spark.createDataFrame(rows, LAYOUT_SCHEMA)


def what_if(plans: list[TablePlan], opts: TransferOptions) -> DataFrame:
    """Rows and landed bytes each table would move; nothing is written."""
    return plan_preview({p.name: p.exported for p in plans if p.error is None}, opts.fmt, opts.parallel)


def _failed(name: str, msg: str) -> TransferResult:
    from datetime import datetime
    now = datetime.now()
    return TransferResult(name, now, now, None, msg)


def run_export(spark: SparkSession, plans: list[TablePlan], landing: str, opts: TransferOptions,
               log: WorkLog | None = None) -> DataFrame:
    """Land every planned table under ``landing/<schema>.<table>``; metrics DataFrame.

    Every table is written to a folder of its own beside the landing and
    published (its files renamed into place) only when the write has ended well.
    With ``check_delimiters`` the same pass counts records that would not read
    back; a table with any is not published, and its landing is marked so that
    ``run_import`` refuses it until an export succeeds. A manifest with the rows
    and the fingerprint of every published batch stays next to its files. With a
    ``log``, tables that have landed in this run are not written again.
    """
    replace_all = opts.landing_mode == "overwrite"

    def item(p: TablePlan):
        path = f"{landing.rstrip('/')}/{p.name}"
        if p.error:
            return _failed(p.name, p.error)
        from datetime import datetime
        start = datetime.now()
        if log:
            try:
                step = log.claim(p.name)
            except Claimed as other:
                return _failed(p.name, str(other))
            if step["state"] == "landing":  # broken off while the files were moved
                publish(spark, step["made"], path, replace_all)
                step = log.record(p.name, "landed")
            if step["state"] != "claimed":
                return TransferResult(p.name, start, datetime.now(), step["rows_landed"], None, path)
        made = f"{landing.rstrip('/')}/_ferry_batch_{uuid.uuid4().hex}"
        stats: dict = {"fingerprint": True}
        rows, err = None, None
        try:
            rows = write_delimited(p.exported, made, opts.fmt, stats=stats)
            if stats["unsafe"] and opts.check_delimiters:
                err = f"{stats['unsafe']} records contain the field delimiter or record separator"
                discard(spark, made)
                refuse(spark, path, err)
            else:
                write_manifest(spark, made, {"rows": rows, "fingerprint": list(stats["fingerprint"]),
                                             "columns": p.exported.columns})
                if log:
                    log.record(p.name, "landing", made=made, rows_landed=rows)
                publish(spark, made, path, replace_all)
                if log:
                    log.record(p.name, "landed")
        except Exception as exc:  # noqa: BLE001 - one failing table must not stop the others
            rows, err = None, f"{type(exc).__name__}: {str(exc).splitlines()[0] if str(exc) else ''}"
            discard(spark, made)
            refuse(spark, path, err)
        if err and log:
            log.record(p.name, "failed", error=err)
        return TransferResult(p.name, start, datetime.now(), rows, err, path)

    weights = [0 if p.error else input_bytes(p.exported) or 0 for p in plans]
    return metrics_frame(spark, run_parallel(spark, [(p.name, lambda p=p: item(p)) for p in plans], opts.parallel, weights))


def run_import(spark: SparkSession, plans: list[TablePlan], landing: str, target_root: str,
               opts: TransferOptions, targets: dict[str, T.StructType] | None = None,
               log: WorkLog | None = None) -> DataFrame:
    """Load landed tables into ``target_root/<schema>.<table>`` (parquet); metrics DataFrame.

    ``typed``: fields by position with the exported types, matched by name
    into the target schema (given in ``targets``, else the existing target
    table's, else the source's); target columns the landing lacks are NULL,
    as through a column-subset view; identity columns that were not exported are generated after the
    target's current maximum, in ``identity_order`` (default: the first
    exported column). Rows are appended, as bulk loads never truncate.
    ``inferred``: types inferred from the text, table replaced, columns by name.

    Rows are loaded into a folder beside the target, compared with the source, and
    only then moved into it: a load that fails leaves the target as it was. With a
    ``log``, tables committed in this run are not loaded again.
    """
    targets = targets or {}

    def moved(name: str, res: TransferResult, made: str, dest: str, replace_all: bool) -> TransferResult:
        """Publish loaded rows, or drop them if there was an error."""
        if res.error is None:
            if log:
                log.record(name, "loading", made=made, rows_loaded=res.rows)
            publish(spark, made, dest, replace_all)
            if log:
                log.record(name, "committed")
        else:
            discard(spark, made)
        return res

    def logged(p: TablePlan):
        """``item`` under the log: skip, finish or do the work."""
        from datetime import datetime
        if log is None or p.error:
            return item(p)
        start, dest = datetime.now(), f"{target_root.rstrip('/')}/{p.name}"
        try:
            step = log.claim(p.name)
            if step["state"] == "loading":  # broken off while the rows were moved
                publish(spark, step["made"], dest, replace_all=opts.target == "inferred")
                step = log.record(p.name, "committed")
        except Claimed as other:
            return _failed(p.name, str(other))
        if step["state"] == "committed":
            return TransferResult(p.name, start, datetime.now(), step["rows_loaded"], None, dest)
        res = item(p)
        if res.error:
            log.record(p.name, "failed", error=res.error)
        return res

    def item(p: TablePlan):
        if p.error:
            return _failed(p.name, p.error)
        path = f"{landing.rstrip('/')}/{p.name}"
        dest = f"{target_root.rstrip('/')}/{p.name}"
        settle(spark, path)
        settle(spark, dest)
        refused = refusal(spark, path)
        if refused:
            return _failed(p.name, f"not loaded, its export failed: {refused}")
        if opts.target == "inferred":
            if not opts.fmt.header:
                return _failed(p.name, "an inferred-schema load needs a header record")
            made = f"{target_root.rstrip('/')}/_ferry_load_{uuid.uuid4().hex}"
            return moved(p.name, load_inferred(spark, path, opts.fmt, made)[0], made, dest, True)
        schema = targets.get(p.name) or _existing_schema(spark, dest, p.source.schema) or p.source.schema
        parsed = import_table(spark, path, opts.fmt, p.exported.schema)
        df = _to_target(parsed, schema)
        missing_ids = [f.name for f in schema.fields if flag_of(f, "identity") and f.name not in p.exported.columns]
        for col in missing_ids:
            order = opts.identity_order.get(p.name) or [c for c in p.exported.columns][:1]
            df = _continue_identity(spark, df.drop(col), col, order, dest).select(*[F.col(quoted(n)) for n in schema.names])
        manifest = read_manifest(spark, path) if opts.verify else None
        # the exported columns pass into the target unchanged (same names up to case, same
        # types): tap them on the final rows, in the final stage of the write, in export order
        by_lower = {f.name.lower(): f for f in schema.fields}
        tap_cols = [by_lower[c.lower()].name for c in p.exported.columns if c.lower() in by_lower]
        same = len(tap_cols) == len(p.exported.columns) and all(
            by_lower[f.name.lower()].dataType == f.dataType for f in p.exported.schema.fields)
        tap = FingerprintTap(df, tap_cols) if manifest and same else None
        made = f"{dest}/_ferry_load_{uuid.uuid4().hex}"
        res = load_into(tap.df if tap else df, made, mode="errorifexists")
        if opts.verify and res.error is None:
            if tap:
                # fingerprint taken during the load vs the one taken during the export
                ok = tap.result() == tuple(manifest["fingerprint"])
            else:
                # no manifest (appended landings) or retyped target: compare the landing
                # with the source by re-reading both sides
                a, b = fingerprints(p.exported, parsed, columns=p.exported.columns)
                ok = a == b
            if not ok:
                res.error = "loaded content differs from the source (fingerprint mismatch)"
        return moved(p.name, res, made, dest, False)

    weights = [0 if p.error else folder_bytes(spark, f"{landing.rstrip('/')}/{p.name}") for p in plans]
    return metrics_frame(spark, run_parallel(spark, [(p.name, lambda p=p: logged(p)) for p in plans], opts.parallel, weights))


def _existing_schema(spark: SparkSession, dest: str, source: T.StructType) -> T.StructType | None:
    """Schema of an existing parquet target (None when there is none yet).

    Column flags (identity, computed, ...) come from the source column of the
    same name, since a stored table does not keep them.
    """
    if not has_data(spark, dest):
        return None
    existing = spark.read.parquet(dest).schema  # a target that cannot be read is an error, not an absent one
    src = {f.name.lower(): f for f in source.fields}
    return T.StructType([T.StructField(f.name, f.dataType, f.nullable,
                                       {**(src[f.name.lower()].metadata if f.name.lower() in src else {}),
                                        **f.metadata})
                         for f in existing.fields])


def _to_target(parsed: DataFrame, schema: T.StructType) -> DataFrame:
    """Parsed file columns into the target schema by name; absent columns NULL."""
    have = {c.lower(): c for c in parsed.columns}
    return parsed.select(*[F.col(quoted(have[f.name.lower()])).cast(f.dataType).alias(f.name) if f.name.lower() in have
                           else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def _continue_identity(spark: SparkSession, df: DataFrame, col: str, order: list[str], dest: str) -> DataFrame:
    top = 0
    if has_data(spark, dest):
        # A failing read or a missing column fails the load: numbering from 1 again would repeat identities.
        top = spark.read.parquet(dest).agg(F.max(F.col(quoted(col)))).collect()[0][0] or 0
    return identity_generate(df, order, out=col, seed=int(top) + 1)


def transfer(spark: SparkSession, catalog: list[TableRef], landing: str, target_root: str, opts: TransferOptions,
             run_id: str | None = None, takeover: bool = False, **selection) -> DataFrame:
    """Choose, land and load in one call; one report row per table.

    With a ``run_id`` the run keeps a control table (``ferry.plans.control``) in the target
    folder: started again under the same id, it goes on where it was broken off and loads
    no row twice. ``takeover`` says that an earlier driver of the run is dead.

    ``selection`` takes the ``plan_transfer`` arguments (schemas, tables,
    schemas_except, tables_except, all_tables). The report sets rows landed
    beside rows loaded, both durations, and the first error of either step.
    """
    plans = plan_transfer(spark, catalog, opts, **selection)
    log = WorkLog(spark, target_root, run_id, takeover) if run_id else None
    ex = run_export(spark, plans, landing, opts, log)
    ok = [p for p in plans if p.error is None]
    failed_export = {r.table_name for r in ex.filter("error <> 'None'").select("table_name").collect()}
    im = run_import(spark, [p for p in ok if p.name not in failed_export], landing, target_root, opts, log=log)
    e = ex.select("table_name", F.col("rows_copied").alias("rows_landed"),
                  F.col("duration_ms").alias("export_ms"), F.col("error").alias("export_error"))
    i = im.select("table_name", F.col("rows_copied").alias("rows_loaded"),
                  F.col("duration_ms").alias("load_ms"), F.col("error").alias("load_error"))
    j = e.join(i, "table_name", "left")
    err = (F.when(F.col("export_error") != "None", F.col("export_error"))
           .when(F.col("load_error").isNull(), F.lit("not loaded"))
           .when(F.col("load_error") != "None", F.col("load_error")).otherwise(F.lit("None")))
    return j.select("table_name", "rows_landed", "rows_loaded", "export_ms", "load_ms", err.alias("error")) \
        .orderBy("table_name")

