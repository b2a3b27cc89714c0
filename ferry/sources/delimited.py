"""Delimited text landing: encode rows, write part files, read them back typed.

Layout of one landed table (a directory):
  * one text record per row: fields joined by ``field_delim``, record ended by
    ``row_delim`` followed by CRLF (the physical line separator);
  * with ``header=True`` the column names form the only record of the file
    ``part-00000-*``; data lives in the other part files; a hidden file names the
    header parts, so a data record that looks like the header is never taken for it;
  * optional gzip per part file (many parts keep the unsplittable codec parallel).

Writing is a single shuffle-free stage: parquet scan -> codegen'd render ->
text sink, one part file per input split. Reading is the text source (file
splits become tasks) -> ``split`` -> typed cast, again shuffle-free.
"""

from __future__ import annotations

import uuid

from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferry.functions.render import parse, render_field, untoken

HEADER_FILE_PREFIX = "part-00000-"


@dataclass(frozen=True)
class FileFormat:
    """Per-table file options kept together (delimiters, header, codec, NULL rules)."""

    field_delim: str = "^|^"
    row_delim: str = "~~~"
    crlf: bool = True
    header: bool = False
    compression: str | None = None
    nulls: str = "marker"
    encoding: str = "UTF-8"

    def __post_init__(self) -> None:
        if not 1 <= len(self.field_delim) <= 3:
            raise ValueError("field delimiter must have 1 to 3 characters")
        if len(self.row_delim) > 16:
            raise ValueError("row delimiter may have at most 16 characters")
        if "\\" in self.row_delim or "/" in self.row_delim:
            raise ValueError("do not use \\ or / in the row delimiter")
        if not self.line_sep:
            raise ValueError("empty record separator")
        if self.field_delim in self.line_sep or self.line_sep in self.field_delim:
            raise ValueError("field delimiter and record separator overlap")
        if self.encoding.upper().replace("-", "") not in ("UTF8",):
            raise ValueError("only UTF-8 landing files are supported")
        if self.nulls not in ("marker", "tokens"):
            raise ValueError("nulls must be 'marker' or 'tokens'")

    @property
    def line_sep(self) -> str:
        return self.row_delim + ("\r\n" if self.crlf else "")

    @property
    def split_regex(self) -> str:
        return "".join(ch if ch.isalnum() else "\\" + ch for ch in self.field_delim)

    def with_(self, **kw) -> "FileFormat":
        return replace(self, **kw)


def encode(df: DataFrame, fmt: FileFormat, columns: list[str] | None = None) -> Column:
    """The record text of each row (without the record separator)."""
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    if columns is not None:
        order = {n: i for i, n in enumerate(columns)}
        fields.sort(key=lambda f: order[f.name])
    return F.concat_ws(fmt.field_delim, *[render_field(f.name, f.dataType, fmt.nulls) for f in fields])


def encode_rows(df: DataFrame, fmt: FileFormat, columns: list[str] | None = None) -> DataFrame:
    return df.select(encode(df, fmt, columns).alias("value"))


def header_line(names: list[str], fmt: FileFormat) -> str:
    return fmt.field_delim.join(names)


def write_delimited(df: DataFrame, path: str, fmt: FileFormat, mode: str = "errorifexists",
                    stats: dict | None = None) -> int:
    """Land ``df`` at ``path``; returns the number of data rows written.

    The count comes from an ``Observation`` on the final (result) stage, whose
    accumulator updates Spark applies once per partition even when tasks are
    retried, so the figure stays exact under executor loss. If ``stats`` is a
    dict, the same pass also counts records that would not read back (see
    ``ferry.operators.checks.unsafe_rows_predicate``) into ``stats["unsafe"]``:
    the delimiter check costs no second scan. With ``stats["fingerprint"] = True``
    the pass also yields the content fingerprint of the rows written
    (``stats["fingerprint"]`` becomes (rows, hash sum a, hash sum b)).
    """
    spark = df.sparkSession
    obs = Observation(f"ferry_rows_{uuid.uuid4().hex}")
    if stats is None:
        body = encode_rows(df, fmt).observe(obs, F.count(F.lit(1)).alias("rows"))
    else:
        from ferry.functions.fingerprint import fingerprint_aggs, row_hashes
        from ferry.operators.checks import safe_record_predicate
        names = [f"_f{i}" for i in range(len(df.columns))]
        extra = []
        if stats.get("fingerprint"):
            h1, h2 = row_hashes(df)
            extra = [h1.alias("_h1"), h2.alias("_h2")]
        rendered = df.select(*[render_field(f.name, f.dataType, fmt.nulls).alias(n)
                               for f, n in zip(df.schema.fields, names)],
                             *extra)
        rec = rendered.select(F.concat_ws(fmt.field_delim, *names).alias("value"), *names,
                              *([F.col("_h1"), F.col("_h2")] if extra else []))
        ok = safe_record_predicate([F.col(n) for n in names], fmt, F.col("value"))
        metrics = [F.count(F.lit(1)).alias("rows"), F.count_if(~ok).alias("unsafe")]
        if extra:
            metrics += fingerprint_aggs(F.col("_h1"), F.col("_h2"))
        body = rec.observe(obs, *metrics).select("value")
    out = body
    if fmt.header:
        # Two partitions, the second empty: single partitions of both sides of a union may be made one, and
        # the header stands alone in the first part.
        hdr = spark.range(0, 2, 1, 2).where("id = 0").select(F.lit(header_line(df.columns, fmt)).alias("value"))
        out = hdr.union(body)
    writer = out.write.mode(mode).option("lineSep", fmt.line_sep)
    if fmt.compression:
        writer = writer.option("compression", fmt.compression)
    writer.text(path)
    if fmt.header:
        _note_header_parts(spark, path)
    got = obs.get
    if stats is not None:
        stats["unsafe"] = int(got.get("unsafe", 0) or 0)
        if stats.get("fingerprint"):
            from ferry.functions.fingerprint import from_metrics
            stats["fingerprint"] = from_metrics(got)
    return int(got.get("rows", 0) or 0)


HEADERS_PREFIX = "_ferry_headers"
MANIFEST_PREFIX = "_ferry_manifest"
REFUSED_FILE = "_ferry_refused.json"


def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names below a folder, or [] if there is no such folder (through the path's own file system)."""
    p, fs = _hadoop_fs(spark, path)
    return sorted(st.getPath().getName() for st in fs.listStatus(p)) if fs.exists(p) else []


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder, 0 if there is no such folder."""
    p, fs = _hadoop_fs(spark, path)
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def has_data(spark: SparkSession, path: str) -> bool:
    return any(not n.startswith(("_", ".")) for n in file_names(spark, path))


def _write_small(spark: SparkSession, target: str, info: dict) -> None:
    import json
    p, fs = _hadoop_fs(spark, target)
    out = fs.create(p, True)
    try:
        out.write(bytearray(json.dumps(info).encode("utf-8")))
    finally:
        out.close()


def _read_small(spark: SparkSession, target: str) -> dict:
    import json
    p, fs = _hadoop_fs(spark, target)
    stream = fs.open(p)
    try:
        java = spark.sparkContext._jvm.java.io
        return json.loads(java.BufferedReader(java.InputStreamReader(stream, "UTF-8")).readLine())
    finally:
        stream.close()


def known_header_parts(spark: SparkSession, path: str) -> list[str] | None:
    """Names of the header parts of a landing that this library wrote; None for foreign files."""
    notes = [n for n in file_names(spark, path) if n.startswith(HEADERS_PREFIX)]
    return sorted({f for n in notes for f in _read_small(spark, f"{path.rstrip('/')}/{n}")["files"]}) if notes else None


def _note_header_parts(spark: SparkSession, path: str) -> None:
    """Remember which part of the write just done holds the header (appended writes have one each)."""
    known = set(known_header_parts(spark, path) or [])
    new = [n for n in file_names(spark, path) if n.startswith(HEADER_FILE_PREFIX) and n not in known]
    _write_small(spark, f"{path.rstrip('/')}/{HEADERS_PREFIX}-{uuid.uuid4().hex}.json", {"files": new})


def write_manifest(spark: SparkSession, path: str, info: dict) -> None:
    """Facts of one landing batch (rows, fingerprint, columns) as a hidden file that readers skip.

    Every batch has its own manifest, so appended landings add up.
    """
    _write_small(spark, f"{path.rstrip('/')}/{MANIFEST_PREFIX}-{uuid.uuid4().hex}.json", info)


def read_manifest(spark: SparkSession, path: str) -> dict | None:
    """The manifests of all batches of a landing as one (rows and fingerprint sums added), None without any."""
    found = [_read_small(spark, f"{path.rstrip('/')}/{n}") for n in file_names(spark, path) if n.startswith(MANIFEST_PREFIX)]
    if not found:
        return None
    return {"rows": sum(m["rows"] for m in found), "fingerprint": [sum(x) for x in zip(*(m["fingerprint"] for m in found))],
            "columns": found[0]["columns"], "batches": len(found)}


def refuse(spark: SparkSession, path: str, why: str) -> None:
    """Mark a landing as not to be loaded."""
    _write_small(spark, f"{path.rstrip('/')}/{REFUSED_FILE}", {"error": why})


def refusal(spark: SparkSession, path: str) -> str | None:
    return _read_small(spark, f"{path.rstrip('/')}/{REFUSED_FILE}")["error"] if REFUSED_FILE in file_names(spark, path) else None


def write_once(spark: SparkSession, target: str, info: dict) -> bool:
    """Make a small file that is there whole or not at all; False if it exists (it is never overwritten)."""
    from py4j.protocol import Py4JJavaError
    folder, _, _ = target.rpartition("/")
    draft = f"{folder}/_draft-{uuid.uuid4().hex}"
    _write_small(spark, draft, info)
    source, fs = _hadoop_fs(spark, draft)
    to, _ = _hadoop_fs(spark, target)
    sc = spark.sparkContext
    context = sc._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(source).toUri(), sc._jsc.hadoopConfiguration())
    never = sc._gateway.new_array(sc._jvm.org.apache.hadoop.fs.Options.Rename, 0)  # no option: an existing file stays
    try:
        context.rename(fs.makeQualified(source), fs.makeQualified(to), never)
    except Py4JJavaError:
        fs.delete(source, False)
        if not fs.exists(to):
            raise
        return False
    return True


def _replaced(path: str) -> str:
    """Where the old files of a folder stand while it is being replaced."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_ferry_old_{name}"


def settle(spark: SparkSession, path: str) -> None:
    """Undo a replacement that was broken off between its two renames: the old files come back."""
    target, fs = _hadoop_fs(spark, path)
    old, _ = _hadoop_fs(spark, _replaced(path))
    if not fs.exists(target) and fs.exists(old):
        fs.rename(old, target)


def publish(spark: SparkSession, made: str, path: str, replace_all: bool) -> None:
    """Move a finished batch of files into ``path``; with ``replace_all`` they become its only files.

    Broken off anywhere, it can be called again with the same arguments. A
    replacement is two renames of whole folders; between them the old files stand beside the target.
    """
    source, fs = _hadoop_fs(spark, made)
    target, _ = _hadoop_fs(spark, path)
    jvm = spark.sparkContext._jvm
    if replace_all:
        old, _ = _hadoop_fs(spark, _replaced(path))
        if fs.exists(source):
            fs.delete(jvm.org.apache.hadoop.fs.Path(source, "_SUCCESS"), False)
            if fs.exists(target):
                fs.delete(old, True)
                if not fs.rename(target, old):
                    raise OSError(f"could not move {path} aside")
            fs.mkdirs(target.getParent())
            if not fs.rename(source, target):
                raise OSError(f"could not move the new files to {path}")
        fs.delete(old, True)
        return
    if not fs.exists(source):
        return  # moved already
    fs.mkdirs(target)
    for status in fs.listStatus(source):
        name = status.getPath().getName()
        if name != "_SUCCESS" and not fs.rename(status.getPath(), jvm.org.apache.hadoop.fs.Path(target, name)):
            raise OSError(f"could not move {name} into {path}")
    marker = jvm.org.apache.hadoop.fs.Path(target, REFUSED_FILE)
    if fs.exists(marker):
        fs.delete(marker, False)
    fs.delete(source, True)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a batch that was never published."""
    p, fs = _hadoop_fs(spark, path)
    fs.delete(p, True)


def read_records(spark: SparkSession, path: str, fmt: FileFormat, skip_header: bool | None = None,
                 header_text: str | None = None) -> DataFrame:
    """Raw records (column ``value``) of a landed directory or of foreign files.

    The header parts of our own landings are known by name; they are not even read,
    and every other record is data. In foreign files the header is the first record
    of a file, if it equals the header's text (``header_text``, else the first record of all,
    ``read_header``); further records with that text are data.
    """
    raw = spark.read.option("lineSep", fmt.line_sep).text(path)
    skip = fmt.header if skip_header is None else skip_header
    if not skip:
        return raw
    known = known_header_parts(spark, path)
    if known is not None:
        return raw.filter(~F.col("_metadata.file_name").isin(known)).select("value")
    if header_text is None:
        header_text = header_line(read_header(spark, path, fmt), fmt)
    same = (F.col("value") == F.lit(header_text)) & (F.col("_metadata.file_block_start") == 0)
    # Records of one text are alike, so it is enough to know for every file how many of them are data.
    tops = (raw.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                       F.monotonically_increasing_id().alias("place")).where(F.col("start") == 0)
            .groupBy("file").agg((F.min_by("value", "place") == F.lit(header_text)).cast("int").alias("head"),
                                 F.count_if(F.col("value") == F.lit(header_text)).cast("int").alias("n")))
    again = tops.select(F.explode(F.array_repeat(F.lit(header_text), F.col("n") - F.col("head"))).alias("value"))
    return raw.filter(~same).select("value").unionAll(again)


class HeaderError(ValueError):
    """A landing that should have a header record has none."""


def read_header(spark: SparkSession, path: str, fmt: FileFormat) -> list[str]:
    """Column names from the header record (one record, read on the driver).

    For our layout only the header file is listed and read (a path glob), never
    the data parts; a foreign single file gives its first record.
    """
    rdr = spark.read.option("lineSep", fmt.line_sep)
    known = known_header_parts(spark, path)
    if known:
        return rdr.text(f"{path.rstrip('/')}/{known[0]}").first()[0].split(fmt.field_delim)
    try:
        first = rdr.text(f"{path.rstrip('/')}/{HEADER_FILE_PREFIX}*").limit(1).collect()
    except AnalysisException:  # no header part below this path: a foreign file
        first = rdr.text(path).limit(1).collect()
    if not first:
        return []
    return first[0][0].split(fmt.field_delim)


def read_header_records(spark: SparkSession, base: str, fmt: FileFormat) -> DataFrame:
    """(table_name, header) of every landed table directly under ``base``; lists header files only."""
    raw = spark.read.option("lineSep", fmt.line_sep).text(f"{base.rstrip('/')}/*/{HEADER_FILE_PREFIX}*")
    return raw.select(F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/part-00000-[^/]*$", 1)
                      .alias("table_name"), F.col("value").alias("header"))


def _fields_checked(fmt: FileFormat, n: int, strict: bool) -> Column:
    parts = F.split(F.col("value"), fmt.split_regex, -1)
    if not strict:
        return parts
    msg = F.concat(F.lit(f"record does not have {n} fields: "), F.substring(F.col("value"), 1, 200))
    return F.when(F.size(parts) == n, parts).otherwise(F.raise_error(msg))


def parse_records(records: DataFrame, file_fields: list[T.StructField], fmt: FileFormat,
                  target: T.StructType | None = None, strict: bool = True) -> DataFrame:
    """Typed rows from raw records.

    ``file_fields`` describe the fields of the file by position. ``target``
    (optional) is the table to load into: its columns are matched to file
    fields by name, case-insensitively; target columns with no field get NULL,
    as when loading through a column-subset view.
    """
    n = len(file_fields)
    staged = records.select(_fields_checked(fmt, n, strict).alias("_f"))
    by_name = {f.name.lower(): i for i, f in enumerate(file_fields)}
    out_fields = target.fields if target is not None else file_fields
    cols = []
    for f in out_fields:
        i = by_name.get(f.name.lower())
        if i is None:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        text = untoken(F.get(F.col("_f"), i), fmt.nulls)
        cols.append(parse(text, f.dataType, strict).alias(f.name))
    return staged.select(*cols)


def read_delimited(spark: SparkSession, path: str, file_fields: list[T.StructField] | T.StructType,
                   fmt: FileFormat, target: T.StructType | None = None, strict: bool = True,
                   header_text: str | None = None) -> DataFrame:
    fields = list(file_fields.fields if isinstance(file_fields, T.StructType) else file_fields)
    if fmt.header and header_text is None:
        # The first record must be the header of these fields; a data record is never taken for one.
        found = read_header(spark, path, fmt)
        if found and [n.lower() for n in found] != [f.name.lower() for f in fields]:
            raise HeaderError(f"{path}: the first record is not the header of the expected fields")
        header_text = header_line(found, fmt)
    records = read_records(spark, path, fmt, header_text=header_text)
    return parse_records(records, fields, fmt, target, strict)


# Numbers as this library (or a bulk-copy tool) writes them. Codes such as 007, 1D or ' 5' are text.
_WHOLE = r"[+-]?(0|[1-9][0-9]*)"
_INT_RE = r"\A[+-]?(0|[1-9][0-9]{0,17})\z"
_DEC_RE = rf"\A{_WHOLE}(\.[0-9]+)?\z"
_DOUBLE_RE = rf"\A({_WHOLE}(\.[0-9]+)?([eE][+-]?[0-9]+)?|NaN|-?Infinity)\z"
_DATE_RE = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
_TIME_RE = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,9})?)?\z"


def infer_fields(spark: SparkSession, path: str, fmt: FileFormat,
                 names: list[str] | None = None, sample_fraction: float | None = None) -> list[T.StructField]:
    """Infer field types from the landed text in one aggregation pass.

    Per column, each non-NULL value votes for the narrowest type it parses as;
    the column gets the narrowest type all its values accept, in the order
    boolean (literal true / false only), bigint, decimal(p, s) (plain digits
    with a point; p and s from the longest integer and fraction parts, p <= 38),
    double, date, timestamp, string. Decimal before double keeps money exact.
    Text that a number would not give back (leading zeros, blanks, letters as
    in ``1D``) keeps its column a string.
    The whole file is read unless ``sample_fraction`` is given.
    """
    if names is None:
        names = read_header(spark, path, fmt) if fmt.header else None
    records = read_records(spark, path, fmt)
    if sample_fraction is not None:
        records = records.sample(fraction=sample_fraction, seed=17)
    if names is None:
        first = records.limit(1).collect()
        width = len(first[0][0].split(fmt.field_delim)) if first else 0
        names = [f"_c{i}" for i in range(width)]
    texts, votes = type_votes(records, len(names), fmt)
    return decide_types(names, texts.agg(*votes).first().asDict() if votes else {})


def type_votes(records: DataFrame, width: int, fmt: FileFormat) -> tuple[DataFrame, list[Column]]:
    """The records' fields as texts ``c0``, ``c1``, ... and aggregates from which :func:`decide_types` tells their types."""
    parts = F.split(F.col("value"), fmt.split_regex, -1)
    texts = records.select(*[untoken(F.get(parts, i), fmt.nulls).alias(f"c{i}") for i in range(width)])
    aggs = []
    for i in range(width):
        t = F.col(f"c{i}")
        aggs += [
            F.count(t).alias(f"n{i}"),
            F.count_if(F.lower(t).isin("true", "false")).alias(f"b{i}"),
            F.count_if(t.rlike(_INT_RE)).alias(f"i{i}"),
            F.count_if(t.rlike(_DEC_RE)).alias(f"p{i}"),
            F.max(F.length(F.ltrim(F.regexp_extract(t, r"^[+-]?([0-9]+)", 1)))).alias(f"pi{i}"),
            F.max(F.length(F.regexp_extract(t, r"\.([0-9]+)$", 1))).alias(f"pf{i}"),
            F.count_if(t.rlike(_DOUBLE_RE)).alias(f"d{i}"),
            F.count_if(t.rlike(_DATE_RE) & t.try_cast("date").isNotNull()).alias(f"dt{i}"),
            F.count_if(t.rlike(_TIME_RE) & t.try_cast("timestamp_ntz").isNotNull()).alias(f"ts{i}"),
        ]
    return texts, aggs


def decide_types(names: list[str], votes: dict) -> list[T.StructField]:
    """The narrowest type that all values of a column accept."""
    fields = []
    for i, name in enumerate(names):
        n = votes[f"n{i}"]
        if n == 0:
            dt: T.DataType = T.StringType()
        elif votes[f"b{i}"] == n:
            dt = T.BooleanType()
        elif votes[f"i{i}"] == n:
            dt = T.LongType()
        elif votes[f"p{i}"] == n and 0 < (votes[f"pi{i}"] or 0) + (votes[f"pf{i}"] or 0) <= 38:
            scale = votes[f"pf{i}"] or 0
            dt = T.DecimalType(max(1, (votes[f"pi{i}"] or 0) + scale), scale)
        elif votes[f"d{i}"] == n:
            dt = T.DoubleType()
        elif votes[f"dt{i}"] == n:
            dt = T.DateType()
        elif votes[f"ts{i}"] == n:
            dt = T.TimestampNTZType()
        else:
            dt = T.StringType()
        fields.append(T.StructField(name, dt, True))
    return fields
