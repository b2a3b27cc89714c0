"""Incremental import of landed part files with Structured Streaming.

A landing folder that keeps receiving exports (``mode="append"``: new part
files, each export with its own header part) is loaded with the file stream
source: each run picks up only files it has not seen, parses them exactly like
the batch import, and appends to a parquet table through the exactly-once
file sink. Progress lives in a checkpoint below the session's shared
``spark.checkpoint.dir``, so a lost driver or executor resumes without
loading a file twice or skipping one.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ferry.session import checkpoint_dir
from ferry.sources.delimited import HEADER_FILE_PREFIX, FileFormat, has_data, header_line, known_header_parts, parse_records


def stream_import(spark: SparkSession, landing: str, file_fields: list[T.StructField] | T.StructType,
                  fmt: FileFormat, target_path: str, name: str, target: T.StructType | None = None,
                  checkpoint: str | None = None, once: bool = True,
                  max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start (and with ``once`` run to completion) the incremental load of ``landing``.

    ``once=True`` processes everything present now (``availableNow``) and stops;
    ``once=False`` keeps polling for new files.
    """
    fields = list(file_fields.fields if isinstance(file_fields, T.StructType) else file_fields)
    reader = spark.readStream.format("text").option("lineSep", fmt.line_sep)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = reader.load(landing)
    if fmt.header:
        if known_header_parts(spark, landing) is not None or not has_data(spark, landing):
            # our own landing (or one that is still empty): headers are parts of their own, everything else is data
            raw = raw.filter(~F.col("_metadata.file_name").startswith(HEADER_FILE_PREFIX)).select("value")
        else:  # foreign files: by content, at the beginning of a file
            header = header_line([f.name for f in fields], fmt)
            raw = raw.filter((F.col("value") != F.lit(header)) | (F.col("_metadata.file_block_start") > 0)).select("value")
    rows = parse_records(raw, fields, fmt, target=target)
    ckpt = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/ferry-streams/{name}"
    writer = (rows.writeStream.format("parquet").option("path", target_path)
              .option("checkpointLocation", ckpt).queryName(f"ferry_{name}"))
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="10 seconds")
    query = writer.start()
    if once:
        query.awaitTermination()
    return query
