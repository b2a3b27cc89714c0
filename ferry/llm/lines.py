"""Line dedup: drop lines that many documents share, keep the rest in place.

Built from DataFrame functions only: explode normalised lines, hash them, count
distinct documents per hash, drop frequent lines everywhere but in the largest
document id that holds them, and reassemble by position.

Shuffles: (hash, doc_id) pairs with map-side combine, the pairs again against
the frequent hashes (an equi-join AQE may split), and the texts once by doc_id.

Defined results
    null or empty text: one empty line, nothing dropped; null id: such a row
    neither counts as a document nor loses lines; repeated rows of one id count
    as one document and each loses the same lines; empty table: empty result;
    extra columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferry.llm.common import ASCII_LOWER, ASCII_SPACE, ASCII_UPPER, folded, landed, unfolded


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_hash(line: Column, min_chars: int) -> Column:
    """128-bit hash of a line's key; null for keys shorter than ``min_chars`` code points."""
    stripped = F.btrim(line, F.lit(ASCII_SPACE))
    return F.when(F.length(stripped) >= min_chars,
                  F.unhex(F.md5(F.translate(stripped, ASCII_UPPER, ASCII_LOWER).cast("binary"))))


def frequent_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40,
                   min_docs: int = 5) -> tuple[DataFrame, DataFrame]:
    """``(line_hash, doc_id)`` pairs, landed, and ``(line_hash, n_docs, last_doc)`` of the frequent ones."""
    hashes = F.array_distinct(F.array_compact(F.transform(_lines(F.col(text_col)),
                                                          lambda x: line_hash(x, min_chars))))
    pairs = landed(docs.select(F.col(id_col).alias("doc_id"), F.explode(hashes).alias("line_hash"))
                   .where("doc_id is not null"), "line-hashes")
    counts = (pairs.distinct().groupBy("line_hash")
              .agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("last_doc"))
              .where(F.col("n_docs") >= min_docs))
    # Landed, so that its join with the pairs has an exchange on either side and AQE can split a hot line.
    return pairs, landed(counts, "frequent-lines")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40,
                min_docs: int = 5) -> DataFrame:
    """Every row of ``docs`` with ``text_col`` rebuilt from its kept lines, plus
    ``_n_lines`` and ``_n_dropped``."""
    pairs, counts = frequent_lines(docs, id_col, text_col, min_chars, min_docs)
    dropped = (pairs.join(counts, "line_hash").where("doc_id <> last_doc")
               .groupBy("doc_id").agg(F.collect_set("line_hash").alias("gone")))
    joined = folded(docs, doc_id=id_col, text=text_col).join(dropped, "doc_id", "left")
    lines = _lines(F.col("text"))
    stay = F.filter(lines, lambda x: ~F.coalesce(F.array_contains("gone", line_hash(x, min_chars)), F.lit(False)))
    touched = F.col("gone").isNotNull()
    out = joined.withColumn("stay", F.when(touched, stay)).withColumn("n_lines", F.size(lines).cast("long"))
    kept = F.when(touched, F.array_join("stay", "\n")).otherwise(F.coalesce("text", F.lit("")))
    n_dropped = F.when(touched, F.col("n_lines") - F.size("stay")).otherwise(F.lit(0)).cast("long")
    return out.select(*unfolded(F.col("row"), docs.columns, **{text_col: kept}),
                      F.col("n_lines").alias("_n_lines"), n_dropped.alias("_n_dropped"))


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns of :func:`dedup_lines` over a ``documents`` table."""
    out = dedup_lines(docs.select("doc_id", "text"))
    return out.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"),
                      F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line,
             generate_subscripts(string_split(t, chr(10)), 1) AS pos FROM d),
k AS (SELECT doc_id, pos, line,
             translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, max(doc_id) AS last_doc FROM k WHERE length(key) >= 40
      GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.*, (f.key IS NOT NULL AND k.doc_id <> f.last_doc) AS gone FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (gone))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
