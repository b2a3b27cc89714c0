"""Demo queries for sources, sinks and transfers.

File-writing demos land data in the session's shared scratch area and return
the data read back, so their oracle is the plain table.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferry.demos.common import CORE_TABLES, FMT, LINE_SEP_SQL, TABLE_COLUMNS, load, sql_record
from ferry.functions.render import render_field
from ferry.operators.columns import exclude_by_name
from ferry.operators.numbering import identity_generate
from ferry.operators.relational import object_agg
from ferry.plans.catalog import catalog_from_dir, column_summary, format_fields, plan_preview
from ferry.plans.locate import locate_differences
from ferry.plans.run import TransferOptions, transfer
from ferry.plans.summary import RunningSummary
from ferry.plans.control import WorkLog
from ferry.plans.transfer import export_all, import_by_name, import_inferred, import_table, load_inferred, load_into, metrics_frame
from ferry.session import scratch_path
from ferry.sources.delimited import (encode, encode_rows, header_line, parse_records, read_delimited, read_header_records,
                                     write_delimited)
from ferry.sources.logs import log_metrics
from ferry.sources.rejects import load_with_rejects

Q: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        Q[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def _round_trip(spark: SparkSession, df: DataFrame, label: str, fmt=FMT) -> DataFrame:
    path = scratch_path(spark, label)
    write_delimited(df, path, fmt)
    return read_delimited(spark, path, df.schema, fmt)


@query("scan_table", "SELECT * FROM customer")
def scan_table(spark, sf):
    return load(spark, sf, "customer")


@query("export_encode", f"SELECT {sql_record('lineitem')} AS value FROM lineitem")
def export_encode(spark, sf):
    return encode_rows(load(spark, sf, "lineitem"), FMT)


@query("null_render",
       "SELECT event_id, coalesce(nullif(event_type, 'error'), '') AS field_nulls, "
       "CASE WHEN event_type = 'view' THEN chr(0) ELSE event_type END AS field_empty FROM events")
def null_render(spark, sf):
    ev = load(spark, sf, "events")
    staged = ev.select("event_id", F.nullif(F.col("event_type"), F.lit("error")).alias("a"),
                       F.when(F.col("event_type") == "view", F.lit("")).otherwise(F.col("event_type")).alias("b"))
    return staged.select("event_id", render_field("a", T.StringType()).alias("field_nulls"),
                         render_field("b", T.StringType()).alias("field_empty"))


@query("null_if",
       "SELECT event_id, CASE WHEN event_type IN ('error', 'view') THEN NULL ELSE event_type END AS event_type "
       "FROM events")
def null_if(spark, sf):
    ev = load(spark, sf, "events")
    token = (F.when(F.col("event_type") == "error", F.lit("NULL"))
             .when(F.col("event_type") == "view", F.lit("null")).otherwise(F.col("event_type")))
    records = ev.select(F.concat_ws(FMT.field_delim, F.col("event_id").cast("string"), token).alias("value"))
    fields = [T.StructField("event_id", T.LongType()), T.StructField("event_type", T.StringType())]
    return parse_records(records, fields, FMT.with_(nulls="tokens"))


@query("export_header",
       "SELECT table_name, string_agg(column_name, '^|^' ORDER BY ordinal_position) AS header "
       "FROM information_schema.columns WHERE table_name IN ("
       + ", ".join(f"'{t}'" for t in CORE_TABLES) + ") GROUP BY table_name")
def export_header(spark, sf):
    base = scratch_path(spark, "headers")
    fmt = FMT.with_(header=True)
    results = export_all(spark, {t: load(spark, sf, t) for t in CORE_TABLES}, base, fmt, parallel=4)
    failed = [r for r in results if r.error]
    if failed:
        raise RuntimeError(failed[0].error)
    return read_header_records(spark, base, fmt)


@query("import_typed", "SELECT * FROM orders")
def import_typed(spark, sf):
    return _round_trip(spark, load(spark, sf, "orders"), "orders")


@query("import_skip_header", "SELECT * FROM documents")
def import_skip_header(spark, sf):
    return _round_trip(spark, load(spark, sf, "documents"), "documents", FMT.with_(header=True))


@query("export_gzip", "SELECT * FROM events")
def export_gzip(spark, sf):
    return _round_trip(spark, load(spark, sf, "events"), "events-gz", FMT.with_(compression="gzip", header=True))


@query("import_subset", "SELECT s_suppkey, s_name, s_nationkey, CAST(NULL AS DOUBLE) AS s_acctbal FROM supplier")
def import_subset(spark, sf):
    sup = load(spark, sf, "supplier")
    landed = exclude_by_name(sup, "s_acctbal")
    path = scratch_path(spark, "supplier-subset")
    write_delimited(landed, path, FMT)
    return import_table(spark, path, FMT, landed.schema, target=sup.schema)


@query("match_by_name", "SELECT * FROM supplier")
def match_by_name(spark, sf):
    sup = load(spark, sf, "supplier")
    shuffled = sup.select(*[F.col(c).alias(c.upper()) for c in reversed(sup.columns)])
    path = scratch_path(spark, "supplier-byname")
    fmt = FMT.with_(header=True)
    write_delimited(shuffled, path, fmt)
    return import_by_name(spark, path, fmt, sup.schema)


@query("import_append", "SELECT * FROM orders")
def import_append(spark, sf):
    orders = load(spark, sf, "orders")
    target = scratch_path(spark, "orders-target")
    batches = [orders.filter(F.col("o_orderstatus") == "F"),
               orders.filter((F.col("o_orderstatus") != "F") | F.col("o_orderstatus").isNull())]
    for i, batch in enumerate(batches):
        path = scratch_path(spark, f"orders-batch{i}")
        write_delimited(batch, path, FMT)
        res = load_into(import_table(spark, path, FMT, orders.schema), target, mode="append")
        if res.error:
            raise RuntimeError(res.error)
    return spark.read.parquet(target)


@query("identity_generate", "SELECT row_number() OVER (ORDER BY p_partkey) AS id, * FROM part")
def identity_generate_demo(spark, sf):
    return identity_generate(load(spark, sf, "part"), ["p_partkey"], out="id")


@query("import_infer",
       "SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size, "
       "CAST(p_retailprice AS DECIMAL(4,1)) AS p_retailprice FROM part")
def import_infer(spark, sf):
    fmt = FMT.with_(header=True)
    path = scratch_path(spark, "part-infer")
    write_delimited(load(spark, sf, "part"), path, fmt)
    return import_inferred(spark, path, fmt)


def _transfer(spark, sf):
    """The whole flow: choose, guard, land, publish, load, verify."""
    base = scratch_path(spark, "transfer")
    return transfer(spark, catalog_from_dir(sf, spark=spark), f"{base}/landing", f"{base}/target",
                    TransferOptions(fmt=FMT), schemas="dbo", tables=", ".join(CORE_TABLES)).withColumn(
        "table_name", F.regexp_replace("table_name", "^dbo[.]", ""))


@query("transfer_all", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS rows_copied FROM {t}" for t in CORE_TABLES))
def transfer_all(spark, sf):
    return _transfer(spark, sf).select("table_name", F.col("rows_loaded").alias("rows_copied"))


@query("transfer_metrics", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS rows_copied, format('{{:,}}', count(*)) AS rows_text, "
    f"'None' AS error FROM {t}" for t in CORE_TABLES))
def transfer_metrics(spark, sf):
    return _transfer(spark, sf).select("table_name", F.col("rows_landed").alias("rows_copied"),
                                       F.format_number("rows_loaded", 0).alias("rows_text"), "error")


def _log_lines(spark, sf):
    ev = load(spark, sf, "events")
    et = F.col("event_type")
    line = (F.when(et == "purchase", F.concat(F.format_number(F.col("user_id") * 1000 + F.col("event_id"), 0),
                                              F.lit(" rows copied.")))
            .when(et == "view", F.concat(F.lit("Clock Time (ms.) Total : "), F.col("event_id").cast("string"),
                                         F.lit("  Average : ("), (F.col("value") * 100).cast("long").cast("string"),
                                         F.lit(".5 rows per sec.)")))
            .when(et == "error", F.concat(F.lit("Error = [driver] copy failed for event "),
                                          F.col("event_id").cast("string")))
            .when(et == "signup", F.lit("Warning: BCP import with a format file will convert empty strings in "
                                        "delimited columns to NULL. error"))
            .otherwise(F.concat(F.lit("Starting copy of batch "), F.col("event_id").cast("string"))))
    return ev.select(F.concat(F.lit("log_"), F.col("user_id").cast("string")).alias("file"),
                     F.struct("ts", "event_id").alias("line_no"), line.alias("line"))


_LOG_LINES_SQL = """
WITH lines AS (
  SELECT 'log_' || CAST(user_id AS VARCHAR) AS file, ts, event_id,
    CASE WHEN event_type = 'purchase' THEN format('{:,}', user_id * 1000 + event_id) || ' rows copied.'
         WHEN event_type = 'view' THEN 'Clock Time (ms.) Total : ' || CAST(event_id AS VARCHAR) || '  Average : ('
              || CAST(CAST(trunc(value * 100) AS BIGINT) AS VARCHAR) || '.5 rows per sec.)'
         WHEN event_type = 'error' THEN 'Error = [driver] copy failed for event ' || CAST(event_id AS VARCHAR)
         WHEN event_type = 'signup' THEN 'Warning: BCP import with a format file will convert empty strings in '
              || 'delimited columns to NULL. error'
         ELSE 'Starting copy of batch ' || CAST(event_id AS VARCHAR) END AS line
  FROM events),
x AS (
  SELECT file, ts, event_id, line,
    CASE WHEN regexp_matches(line, '([0-9][0-9,]*)\\s+rows copied')
         THEN regexp_extract(line, '([0-9][0-9,]*)\\s+rows copied', 1) END AS r,
    CASE WHEN regexp_matches(line, 'Clock Time.*?:\\s*([0-9,]+)')
         THEN regexp_extract(line, 'Clock Time.*?:\\s*([0-9,]+)', 1) END AS c,
    CASE WHEN regexp_matches(line, 'Average\\s*:\\s*\\(([0-9]+)\\.')
         THEN regexp_extract(line, 'Average\\s*:\\s*\\(([0-9]+)\\.', 1) END AS s,
    CASE WHEN regexp_matches(line, '(?i)\\b(error|failed)\\b')
          AND NOT contains(line, 'BCP import with a format file will convert empty strings in delimited columns to NULL')
         THEN line END AS e
  FROM lines),
g AS (
  SELECT file,
    TRY_CAST(replace(arg_min(r, (ts, event_id)) FILTER (WHERE r IS NOT NULL), ',', '') AS BIGINT) AS rows_copied,
    TRY_CAST(replace(arg_min(c, (ts, event_id)) FILTER (WHERE c IS NOT NULL), ',', '') AS BIGINT) AS clock_ms,
    TRY_CAST(replace(arg_min(s, (ts, event_id)) FILTER (WHERE s IS NOT NULL), ',', '') AS BIGINT) AS rows_per_sec,
    coalesce(string_agg(e, chr(10) ORDER BY ts, event_id) FILTER (WHERE e IS NOT NULL), 'None') AS error
  FROM x WHERE r IS NOT NULL OR c IS NOT NULL OR s IS NOT NULL OR e IS NOT NULL GROUP BY file)
SELECT file, rows_copied, clock_ms, rows_per_sec, error,
  coalesce(format('{:,}', rows_copied), '?') AS rows_text,
  coalesce(format('{:,}', clock_ms), '?') AS clock_text,
  coalesce(format('{:,}', rows_per_sec), '?') AS speed_text
FROM g
"""


@query("log_metrics", _LOG_LINES_SQL)
def log_metrics_demo(spark, sf):
    return log_metrics(_log_lines(spark, sf))


def _import_lines(spark, sf):
    ev = load(spark, sf, "events")
    speed = F.when(F.col("event_id") % 3 == 0, F.format_number(F.col("value") * 1000, 1)).otherwise(
        F.col("event_id").cast("string"))
    line = F.concat(F.lit("Clock Time (ms.) Total : "), F.format_number(F.col("event_id") * 1000, 0),
                    F.lit("  Average : ("), speed, F.lit(" rows per sec.)"))
    return ev.select(F.concat(F.lit("in_"), F.col("event_id").cast("string")).alias("file"), F.lit(1).alias("line_no"),
                     line.alias("line"))


@query("log_metrics_import",
       "SELECT 'in_' || CAST(event_id AS VARCHAR) AS file, event_id * 1000 AS clock_ms, "
       "CASE WHEN event_id % 3 = 0 THEN CAST(string_split(replace(printf('%.1f', value * 1000), ',', ''), '.')[1] AS BIGINT) "
       "ELSE event_id END AS rows_per_sec FROM events")
def log_metrics_import(spark, sf):
    """Logs of the loading side: speeds with thousands separators (22,035.7) or without a point."""
    return log_metrics(_import_lines(spark, sf), side="import").select("file", "clock_ms", "rows_per_sec")


@query("infer_codes",
       "SELECT CAST(p_partkey AS BIGINT) AS p_partkey, lpad(CAST(p_partkey % 1000 AS VARCHAR), 6, '0') AS zeros, "
       "CAST(p_size AS VARCHAR) || 'D' AS letter, ' ' || CAST(p_size AS VARCHAR) AS blank, p_retailprice * 1e10 AS big FROM part")
def infer_codes(spark, sf):
    """Codes that look like numbers stay text: leading zeros, a letter that Java reads as a double, blanks.

    The landing is foreign: every file has the header on top of its data.
    """
    p = load(spark, sf, "part").select(
        F.col("p_partkey").cast("long").alias("p_partkey"), F.lpad((F.col("p_partkey") % 1000).cast("string"), 6, "0").alias("zeros"),
        F.concat(F.col("p_size").cast("string"), F.lit("D")).alias("letter"),
        F.concat(F.lit(" "), F.col("p_size").cast("string")).alias("blank"), (F.col("p_retailprice") * F.lit(1e10)).alias("big"))
    fmt, path = FMT.with_(header=True), scratch_path(spark, "codes")
    body = p.select(encode(p, fmt).alias("value"), F.lit(1).alias("o"), F.pmod(F.hash("p_partkey"), F.lit(4)).alias("file"))
    heads = spark.range(4).select(F.lit(header_line(p.columns, fmt)).alias("value"), F.lit(0).alias("o"), F.col("id").cast("int").alias("file"))
    (heads.union(body).repartition("file").sortWithinPartitions("file", "o").drop("o")
     .write.partitionBy("file").option("lineSep", fmt.line_sep).text(path))
    return import_inferred(spark, path, fmt)


@query("exact_timestamps",
       "SELECT event_id, ts, ts AS nested, ts AS first, CAST(NULL AS TIMESTAMP) AS second, 2 AS elements FROM events")
def exact_timestamps(spark, sf):
    """Instants, alone and nested, survive to the microsecond."""
    ev = load(spark, sf, "events").select("event_id", "ts", F.struct(F.col("ts").alias("t")).alias("s"),
                                          F.array("ts", F.lit(None)).alias("many"))
    path = scratch_path(spark, "timestamps")
    write_delimited(ev, path, FMT)
    return read_delimited(spark, path, ev.schema, FMT).select(
        "event_id", "ts", F.col("s.t").alias("nested"), F.get("many", F.lit(0)).alias("first"),
        F.get("many", F.lit(1)).alias("second"), F.size("many").alias("elements"))


@query("import_equal_header", "SELECT n_name FROM nation UNION ALL SELECT 'n_name' FROM region")
def import_equal_header(spark, sf):
    """Data records that look like the header are data, in whatever file they land."""
    names = load(spark, sf, "nation").select("n_name").unionAll(load(spark, sf, "region").select(F.lit("n_name").alias("n_name")))
    return _round_trip(spark, names, "equal-header", FMT.with_(header=True))


@query("transfer_resumed", " UNION ALL ".join(
    f"SELECT 'dbo.{t}' AS table_name, count(*) AS rows_landed, count(*) AS rows_loaded, count(*) AS rows_stored, 'committed' AS state, "
    f"{2 if t == CORE_TABLES[4] else 1} AS attempt FROM {t}" for t in CORE_TABLES))
def transfer_resumed(spark, sf):
    """A run that stopped after four of eight tables, with a fifth begun, goes on under the same id."""
    base, catalog = scratch_path(spark, "resumed"), catalog_from_dir(sf, spark=spark)
    opts = TransferOptions(fmt=FMT.with_(header=True), parallel=4)
    where = (spark, catalog, f"{base}/landing", f"{base}/target", opts)
    transfer(*where, run_id="nightly", schemas="dbo", tables=", ".join(CORE_TABLES[:4])).collect()
    WorkLog(spark, f"{base}/target", "nightly").claim(f"dbo.{CORE_TABLES[4]}")  # by a driver that died then
    report = transfer(*where, run_id="nightly", takeover=True, schemas="dbo", tables=", ".join(CORE_TABLES))
    stored = None
    for t in CORE_TABLES:
        one = spark.read.parquet(f"{base}/target/dbo.{t}").agg(F.count(F.lit(1)).alias("rows_stored")).withColumn("table_name", F.lit(f"dbo.{t}"))
        stored = one if stored is None else stored.unionByName(one)
    log = WorkLog(spark, f"{base}/target", "nightly").frame().select(F.col("item").alias("table_name"), "state", F.col("attempt").cast("int"))
    return (report.join(stored, "table_name").join(log, "table_name")
            .select("table_name", "rows_landed", "rows_loaded", "rows_stored", "state", "attempt"))


@query("import_rejects",
       "SELECT o_orderkey, CASE WHEN o_orderkey % 5000 = 1 THEN 'column o_totalprice: abc is not double' "
       "ELSE 'record has 7 fields, 6 expected' END AS reason, "
       "(SELECT count(*) FROM orders WHERE o_orderkey % 5000 NOT IN (1, 2)) AS loaded FROM orders WHERE o_orderkey % 5000 IN (1, 2)")
def import_rejects(spark, sf):
    """Bad records are listed with their reason, good ones are loaded."""
    orders, base = load(spark, sf, "orders"), scratch_path(spark, "rejects")
    mark = F.col("o_orderkey") % 5000
    texts = orders.withColumn("o_totalprice", F.when(mark == 1, F.lit("abc")).when(mark == 2, F.concat(F.col("o_totalprice").cast("string"), F.lit("^|^")))
                              .otherwise(F.col("o_totalprice").cast("string")))
    write_delimited(texts, f"{base}/landing", FMT)
    load_with_rejects(spark, f"{base}/landing", orders.schema, FMT, f"{base}/target", f"{base}/rejects", max_rejects=1_000_000)
    loaded = spark.read.parquet(f"{base}/target").agg(F.count(F.lit(1)).alias("loaded"))
    found = spark.read.parquet(f"{base}/rejects")
    return found.select(F.split("record", r"\^\|\^")[0].cast("long").alias("o_orderkey"), "reason").join(F.broadcast(loaded))


@query("locate_difference",
       "SELECT l_orderkey, l_linenumber, l_quantity, 1 AS source_rows, 0 AS landed_rows FROM lineitem WHERE l_orderkey % 20000 = 1 "
       "UNION ALL SELECT l_orderkey, l_linenumber, l_quantity + 1, 0, 1 FROM lineitem WHERE l_orderkey % 20000 = 1")
def locate_difference(spark, sf):
    """The rows that differ between two sides, found in the few buckets whose fingerprints differ."""
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_partkey", "l_suppkey", "l_shipdate")
    other = li.withColumn("l_quantity", F.when(F.col("l_orderkey") % 20000 == 1, F.col("l_quantity") + 1).otherwise(F.col("l_quantity")))
    return locate_differences(li, other, ["l_orderkey", "l_linenumber"]).select(
        "l_orderkey", "l_linenumber", "l_quantity", "source_rows", "landed_rows")


@query("transfer_stamps", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, true AS in_order, true AS within_run, true AS duration_agrees, count(*) AS rows_copied FROM {t}"
    for t in CORE_TABLES))
def transfer_stamps(spark, sf):
    """The start and end stamps of every table lie within the run, and the duration is their difference."""
    begun = F.lit(datetime.now())
    results = export_all(spark, {t: (lambda t=t: load(spark, sf, t)) for t in CORE_TABLES}, scratch_path(spark, "stamps"), FMT)
    ended = F.lit(datetime.now())
    ms = (F.unix_micros(F.col("end_time").cast("timestamp")) - F.unix_micros(F.col("start_time").cast("timestamp"))) / 1000
    return metrics_frame(spark, results).select(
        "table_name", (F.col("start_time") <= F.col("end_time")).alias("in_order"),
        ((F.col("start_time") >= begun.cast("timestamp_ntz")) & (F.col("end_time") <= ended.cast("timestamp_ntz"))).alias("within_run"),
        (F.abs(ms - F.col("duration_ms")) <= 1).alias("duration_agrees"), "rows_copied")


def _format_fields_sql() -> str:
    cols = TABLE_COLUMNS["lineitem"]
    parts = []
    for i, (c, t) in enumerate(cols):
        term = LINE_SEP_SQL if i == len(cols) - 1 else "'^|^'"
        val = f"CASE WHEN {c} = '' THEN chr(0) ELSE {c} END" if t == "string" else f"CAST({c} AS VARCHAR)"
        parts.append(f"SELECT {i + 1} AS field_no, '{c}' AS column_name, CAST(max(strlen({val})) AS INTEGER) AS max_len, "
                     f"{term} AS terminator FROM lineitem")
    return " UNION ALL ".join(parts)


@query("format_fields", _format_fields_sql())
def format_fields_demo(spark, sf):
    return format_fields(load(spark, sf, "lineitem"), FMT)


@query("object_agg",
       "SELECT r_name, '[' || string_agg(json_object('n_nationkey', n_nationkey, 'n_name', n_name, "
       "'n_regionkey', n_regionkey)::VARCHAR, ',' ORDER BY n_nationkey) || ']' AS nations "
       "FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name")
def object_agg_demo(spark, sf):
    nation, region = load(spark, sf, "nation"), load(spark, sf, "region")
    j = nation.join(region, nation.n_regionkey == region.r_regionkey).select("r_name", "n_nationkey", "n_name",
                                                                              "n_regionkey")
    return object_agg(j, ["r_name"], "n_nationkey", out="nations", columns=["n_nationkey", "n_name", "n_regionkey"])


PREVIEW_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@query("plan_preview", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS rows, CAST(coalesce(sum(strlen({sql_record(t)}) + 5), 0) AS BIGINT) "
    f"AS bytes FROM {t}" for t in PREVIEW_TABLES))
def plan_preview_demo(spark, sf):
    return plan_preview({t: load(spark, sf, t) for t in PREVIEW_TABLES}, FMT)


@query("column_summary", " UNION ALL ".join(
    f"SELECT 'orders' AS table_name, {i + 1} AS ordinal, '{c}' AS column_name, count(*) - count({c}) AS nulls, "
    f"count(DISTINCT {c}) AS distinct_values, count(*) AS rows FROM orders"
    for i, (c, _t) in enumerate(TABLE_COLUMNS["orders"])))
def column_summary_demo(spark, sf):
    return column_summary(load(spark, sf, "orders"), "orders")


@query("summary_running", " UNION ALL ".join(
    f"SELECT 'orders' AS table_name, {i + 1} AS ordinal, '{c}' AS column_name, count(*)::BIGINT AS rows, (count(*) - count({c}))::BIGINT AS nulls, "
    f"true AS distinct_within_bound FROM orders" for i, (c, _t) in enumerate(TABLE_COLUMNS["orders"])))
def summary_running(spark, sf):
    """The summary of a table from the sketches of its batches, its distinct counts held against exact ones."""
    orders, running = load(spark, sf, "orders"), RunningSummary(spark, scratch_path(spark, "running"))
    for year, part in enumerate([orders.where("o_orderstatus = 'F'"), orders.where("o_orderstatus <> 'F' or o_orderstatus is null")]):
        running.add(part, "orders", f"batch {year}")
    exact = column_summary(orders, "orders").select("ordinal", F.col("distinct_values").alias("exact"))
    close = F.abs(F.col("distinct_values") - F.col("exact")) <= F.greatest(F.lit(1.0), 0.02 * F.col("exact"))
    return running.summary().join(exact, "ordinal").select("table_name", "ordinal", "column_name", "rows", "nulls",
                                                           close.alias("distinct_within_bound"))


@query("infer_once",
       "SELECT CAST(p_partkey AS BIGINT) AS p_partkey, p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size, 1 AS scans FROM part")
def infer_once(spark, sf):
    """An inferred load whose guess from the first records holds: the text is gone through once."""
    p = load(spark, sf, "part").drop("p_retailprice")
    base, fmt = scratch_path(spark, "infer-once"), FMT.with_(header=True)
    write_delimited(p, f"{base}/landing", fmt)
    _, _, scans = load_inferred(spark, f"{base}/landing", fmt, f"{base}/target")
    return spark.read.parquet(f"{base}/target").withColumn("scans", F.lit(scans))
