"""Substring dedup: remove repeated passages by level-wise doubling.

A passage is a window of ``window`` consecutive words. Testing every window of
the corpus at full length would move a row per word. Instead lengths are
doubled: about a quarter of the window, half of it, then the window. At each
length a window is represented by the smallest hash among its grams of that
length (equal windows have equal representatives, and neighbouring windows
share theirs, so a document has a few for a hundred words). Windows whose
representative occurs in one document only are out; only those repeated at one
length are extended to twice that length. At full length the representative is
the window itself, as a 96-bit hash, and what survives there is repeated. The
search ends early for documents without candidates; beyond the window's own
length doubling can add nothing, since longer repeats consist of windows.

Each level moves distinct (hash, document) pairs: smallest and largest document
per hash with map-side combine, then an equi-join AQE may split, so a passage
that a third of all documents share is no single task's work. Texts are dealt by
id once, compressed; all levels read that one exchange. Texts that are exact copies of one
with a smaller id leave before the first level: all their windows are repeated.

Defined results
    null or empty text: no words, nothing removed; null ids: kept whole and not
    compared; repeated rows of one id are one document and treated alike; texts
    shorter than a window stay; empty table: empty result; extra columns are
    not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 50
LEVELS = 3
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd multipliers of the two rolling hashes
DOCS_AT_ONCE = 64

_powers: dict[tuple[int, bool], np.ndarray] = {}


def _power(base: int, n: int, inverse: bool) -> np.ndarray:
    """base ** i (or its inverse mod 2**64) for i < n, kept between texts."""
    have = _powers.get((base, inverse))
    if have is None or len(have) < n:
        step = np.uint64(pow(base, -1, 1 << 64) if inverse else base)
        have = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(max(n, 4096) * 2, step)]))
        _powers[base, inverse] = have
    return have[:n]


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def grams(hashes: np.ndarray, size: int, base: int = BASES[0]) -> np.ndarray:
    """64-bit hash of the ``size`` words from each position on (rolling, mod 2**64, then mixed)."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * _power(base, len(hashes), True))])
    out = (sums[size:] - sums[:n]) * _power(base, n, False)
    out = (out ^ out >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return out ^ out >> np.uint64(32)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` consecutive values, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def level_lengths(window: int, levels: int) -> list[int]:
    """Gram lengths, each about twice the one before: 50 in three levels gives 13, 25, 50."""
    return sorted({max(1, -(-window // 2 ** k)) for k in range(levels)})


def representatives(hashes: np.ndarray, size: int, window: int) -> np.ndarray:
    """For each window its smallest gram hash of ``size`` words."""
    return sliding_min(grams(hashes, size), window - size + 1)


def _words(packed: bytes | None) -> list[bytes]:
    return zstandard.decompress(packed).split() if packed else []


def _packed(texts: DataFrame) -> DataFrame:
    """``(doc_id, m, z)``: digest and compressed text, under half of what the exchange would hold otherwise."""
    def run(batches):
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for at in range(0, batch.num_rows, DOCS_AT_ONCE):
                part = batch.slice(at, DOCS_AT_ONCE)
                z = [None if t is None else packer.compress(t) for t in part.column("text").cast(pa.binary()).to_pylist()]
                yield pa.record_batch([part.column("doc_id"), part.column("m"), pa.array(z, pa.binary())], names=["doc_id", "m", "z"])

    return texts.select("doc_id", F.md5("text").alias("m"), "text").mapInArrow(run, "doc_id long, m string, z binary")


def _pairs(texts: DataFrame, window: int, before: int | None, size: int) -> DataFrame:
    """Distinct ``(h, h2, doc_id)`` of one level; ``alive`` holds the hashes that survived the one before."""
    def run(batches):
        for batch in batches:
            alive = batch.column("alive") if before else None
            for at in range(0, batch.num_rows, DOCS_AT_ONCE):
                ids, first, second = [], [], []
                part = batch.column("z").slice(at, DOCS_AT_ONCE).to_pylist()
                for i, (doc, packed) in enumerate(zip(batch.column("doc_id").slice(at, DOCS_AT_ONCE).to_pylist(), part)):
                    words = _words(packed)
                    if len(words) < window:
                        continue
                    hashes = word_hashes(words)
                    keys = representatives(hashes, size, window)
                    checks = (grams(hashes, window, BASES[1]) if size == window else np.zeros(len(keys), np.uint64)).astype(np.uint32)
                    if before:
                        keep = np.isin(representatives(hashes, before, window),
                                       alive[at + i].values.to_numpy(zero_copy_only=False).view(np.uint64))
                        keys, checks = keys[keep], checks[keep]
                    keys, where = np.unique(keys, return_index=True)
                    ids.append(np.full(len(keys), doc, np.int64))
                    first.append(keys)
                    second.append(checks[where])
                if ids:
                    yield pa.record_batch([pa.array(np.concatenate(first).view(np.int64)),
                                           pa.array(np.concatenate(second).view(np.int32)),
                                           pa.array(np.concatenate(ids))], names=["h", "h2", "doc_id"])

    return texts.mapInArrow(run, "h long, h2 int, doc_id long")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   levels: int = LEVELS) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept)`` for every row; ``kept`` joins the words that stay by one space."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # The same filter below and above the packing: inner and left joins then have one exchange in common.
    named = _packed(texts.where("doc_id is not null")).where("doc_id is not null")
    digests = texts.select("doc_id", F.md5("text").alias("m")).where("m is not null and doc_id is not null")
    first = digests.groupBy("m").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    copies = (digests.join(first.where("first < last"), "m").where("doc_id > first")
              .groupBy("doc_id").agg(F.collect_set("m").alias("copied")))

    lengths = level_lengths(window, levels)
    alive = None
    for n, size in enumerate(lengths):
        if alive is None:
            # The left join is only for dropping copies, so the texts are dealt by id here already.
            level = named.join(copies, "doc_id", "left").where(
                F.col("copied").isNull() | ~F.array_contains("copied", F.col("m"))).select("doc_id", "z")
        else:
            level = named.join(alive, "doc_id")
        pairs = _pairs(level, window, lengths[n - 1] if n else None, size)
        if size == window:  # repeated in a document with a smaller id
            spread = pairs.groupBy("h", "h2").agg(F.min("doc_id").alias("first"))
            met = pairs.join(spread, ["h", "h2"]).where("doc_id > first")
        else:
            spread = pairs.groupBy("h", "h2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
            met = pairs.join(spread.where("first < last"), ["h", "h2"])
        alive = met.groupBy("doc_id").agg(F.collect_list("h").alias("alive"))

    def cut_out(batches):
        for batch in (b.slice(at, DOCS_AT_ONCE) for b in batches for at in range(0, b.num_rows, DOCS_AT_ONCE)):
            n_words, n_removed, kept = [], [], []
            for packed_text, gone, whole in zip(batch.column("z").to_pylist(), batch.column("alive"),
                                                batch.column("copy").to_pylist()):
                words = _words(packed_text)
                n = len(words)
                covered = np.zeros(n, bool)
                if n >= window and whole:
                    covered[:] = True
                elif n >= window and gone.is_valid:
                    found = np.isin(grams(word_hashes(words), window),
                                    gone.values.to_numpy(zero_copy_only=False).view(np.uint64))
                    edge = np.zeros(n + 1, np.int64)
                    edge[:-window] += found
                    edge[window:] -= found
                    covered = np.cumsum(edge[:-1]) > 0
                n_words.append(n)
                n_removed.append(int(covered.sum()))
                kept.append(b" ".join(words if not n_removed[-1] else [words[i] for i in np.flatnonzero(~covered)]))
            yield pa.record_batch([batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                                   pa.array(kept, pa.binary()).cast(pa.string())],
                                  names=["doc_id", "n_words", "n_removed", "kept"])

    whole = F.coalesce(F.array_contains("copied", F.col("m")), F.lit(False)).alias("copy")
    out = named.join(copies, "doc_id", "left").join(alive, "doc_id", "left").select("doc_id", "z", "alive", whole)
    nameless = _packed(texts.where("doc_id is null")).select(
        "doc_id", "z", F.lit(None).cast("array<long>").alias("alive"), F.lit(False).alias("copy"))
    out = out.unionAll(nameless)
    return out.mapInArrow(cut_out, "doc_id long, n_words long, n_removed long, kept string")


def digest(docs: DataFrame) -> DataFrame:
    out = remove_repeats(docs)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS k FROM s),
f AS (SELECT k, min(doc_id) AS first_doc FROM win GROUP BY k),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS pos FROM win JOIN f USING (k) WHERE doc_id > first_doc),
p AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM d),
r AS (SELECT p.doc_id, count(c.pos) AS gone,
             string_agg(word, ' ' ORDER BY p.pos) FILTER (c.pos IS NULL) AS kept
      FROM p LEFT JOIN c ON c.doc_id = p.doc_id AND c.pos = p.pos GROUP BY p.doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(gone, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN r USING (doc_id)
"""
