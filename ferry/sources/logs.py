"""Transfer-log parsing: rows copied, clock time, speed and error lines per log.

Logs are read with the text source (every file split a task); each line is
reduced by regular expressions first, and only extracted figures and error
lines are shuffled to their file's group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.functions.text import quoted
from ferry.operators.relational import ordered_concat

# The patterns and the benign sentence of a bulk-copy log, by the side that wrote it.
ROWS_RE = {"export": r"([0-9][0-9,]*)\s+rows copied", "import": r"([0-9,]+)\s+rows copied"}
CLOCK_RE = r"Clock Time.*?:\s*([0-9,]+)"
AVERAGE_RE = {"export": r"Average\s*:\s*\(([^)]*)\)", "import": r"Average\s*:\s*\(([0-9,\.]+)"}
WHOLE_PART_RE = r"\(([0-9]+)\."
ERROR_RE = r"(?i)\b(error|failed)\b"
BENIGN_SENTENCE = "BCP import with a format file will convert empty strings in delimited columns to NULL"


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, line) for every line of every log under ``path``.

    ``line_no`` orders the lines of one file without moving the file to one
    task: (start offset of the file split, position inside the split).
    """
    raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"),
                                       F.col("_metadata.file_block_start").alias("_blk"))
    return raw.select("file", F.struct("_blk", F.monotonically_increasing_id().alias("_pos")).alias("line_no"),
                      "line")


def _whole(c: Column) -> Column:
    """Whole part of a figure of digits, commas and points; NULL for any other text."""
    digits = F.substring_index(F.replace(c, F.lit(","), F.lit("")), ".", 1)
    return F.when(c.rlike(r"\A[0-9,.]+\z"), F.when(digits == "", F.lit(0)).otherwise(digits.try_cast("long")))


def log_metrics(lines: DataFrame, file_col: str = "file", order_col: str = "line_no", line_col: str = "line",
                side: str = "export") -> DataFrame:
    """Per log file: rows_copied, clock_ms, rows_per_sec (first match in line order) and error text.

    Error text is every line that says ``error`` or ``failed`` as a word, minus
    the one benign sentence, joined by newlines in line order; ``None`` if none.
    ``side`` tells which program wrote the log: the export's speed counts only as
    plain digits before a point inside the brackets of the average; the
    import's may have thousands separators and no point.
    Unknown figures are NULL here and ``?`` in the ``*_text`` columns.
    """
    l = F.col(quoted(line_col))
    average = F.when(l.rlike(AVERAGE_RE[side]), F.regexp_extract(l, AVERAGE_RE[side], 0 if side == "export" else 1))
    speed = average if side == "import" else F.when(average.rlike(WHOLE_PART_RE), F.regexp_extract(average, WHOLE_PART_RE, 1))
    staged = lines.select(
        F.col(quoted(file_col)).alias("file"), F.col(quoted(order_col)).alias("_o"),
        F.when(l.rlike(ROWS_RE[side]), F.regexp_extract(l, ROWS_RE[side], 1)).alias("_rows"),
        F.when(l.rlike(CLOCK_RE), F.regexp_extract(l, CLOCK_RE, 1)).alias("_clock"),
        speed.alias("_speed"),
        F.when(l.rlike(ERROR_RE) & ~l.contains(BENIGN_SENTENCE), l).alias("_err"),
    ).filter(F.col("_rows").isNotNull() | F.col("_clock").isNotNull() | F.col("_speed").isNotNull()
             | F.col("_err").isNotNull())
    figures = staged.groupBy("file").agg(
        F.min_by("_rows", F.when(F.col("_rows").isNotNull(), F.col("_o"))).alias("_rows"),
        F.min_by("_clock", F.when(F.col("_clock").isNotNull(), F.col("_o"))).alias("_clock"),
        F.min_by("_speed", F.when(F.col("_speed").isNotNull(), F.col("_o"))).alias("_speed"),
    )
    # error lines joined in line order without gathering a large log in one task
    errors = ordered_concat(staged.filter(F.col("_err").isNotNull()), ["file"], "_o", "_err", "\n", "_errtext")
    out = figures.join(errors, "file", "left").select(
        "file",
        _whole(F.col("_rows")).alias("rows_copied"),
        _whole(F.col("_clock")).alias("clock_ms"),
        _whole(F.col("_speed")).alias("rows_per_sec"),
        F.coalesce(F.col("_errtext"), F.lit("None")).alias("error"),
    )
    return (out.withColumn("rows_text", F.coalesce(F.format_number("rows_copied", 0), F.lit("?")))
            .withColumn("clock_text", F.coalesce(F.format_number("clock_ms", 0), F.lit("?")))
            .withColumn("speed_text", F.coalesce(F.format_number("rows_per_sec", 0), F.lit("?"))))
