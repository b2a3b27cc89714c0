"""SimHash near-dedup with Golay-code fuzzy keys.

Fingerprints: 64-bit SimHash of word shingles (XXH64, seed 42), computed in
Arrow batches. Candidates: a 64-bit fingerprint is cut into three segments of
22, 21 and 21 bits. Of at most three differing bits no two segments can hold
two or more, so some *pair* of segments differs by at most one bit in each.

The binary Golay code [23, 12] is perfect: every 23-bit word lies within
distance 3 of exactly one codeword, its decoded index (12 bits). A word one bit
away lies within 4 of that codeword, so the list of codewords within 4 (one or
six) of one segment holds the decoded index of the other. One side of the join
therefore carries (decoded, listed) and the other (listed, decoded) indices of
a segment pair: at most 6 keys of 24 bits per pair and side, every link within
three bits is met, and a fingerprint pair meets at most once per segment pair
and side. The bit distance is verified inside the join.

Equal fingerprints are one node (its smallest document), so groups of copies
are never expanded into pairs.

Defined results
    null or empty text: fingerprint zero, linked like any other; null id: the
    row gets its fingerprint's component and is never itself a component id;
    repeated rows: one output row each; empty table: empty result.
"""

from __future__ import annotations

from functools import cache, partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferry.llm.common import folded, landed, unfolded
from ferry.llm.components import components

SEED = 42
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # (first bit, bits)
GOLAY_GENERATOR = 0b110001110101          # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
LANE = np.uint64(0x0101010101010101)
DOCS_AT_ONCE = 256


def _hashes(text: bytes | None, size: int) -> np.ndarray:
    words = (text or b"").lower().split()  # bytes: ASCII letters and ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    h = partial(xxhash.xxh64_intdigest, seed=SEED)
    if len(words) < size:
        return np.array([h(b" ".join(words))], np.uint64)
    grams = map(b" ".join, zip(*(words[i:] for i in range(size))))
    return np.fromiter(map(h, grams), np.uint64, len(words) - size + 1)


def fingerprints(texts: list[bytes | None], size: int = 3) -> np.ndarray:
    """SimHash of each text: bit set where over half the shingle hashes have it.

    Bits are counted in eight 8-bit lanes of a word over runs of at most 255
    hashes, so all 64 counts take eight additions per hash.
    """
    parts = [_hashes(t, size) for t in texts]
    lengths = np.array([len(p) for p in parts], np.int64)
    full = np.flatnonzero(lengths)
    out = np.zeros(len(texts), np.uint64)
    if not len(full):
        return out
    hashes, lengths = np.concatenate([parts[i] for i in full]), lengths[full]
    runs = (lengths + 254) // 255
    first_run = np.cumsum(runs) - runs
    run_in_doc = np.arange(runs.sum()) - np.repeat(first_run, runs)
    starts = np.repeat(np.cumsum(lengths) - lengths, runs) + 255 * run_in_doc
    bits = np.zeros(len(full), np.uint64)
    for k in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(k)) & LANE, starts)
        counts = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8), first_run, axis=0, dtype=np.int64)
        for j in range(8):
            bits |= (2 * counts[:, j] > lengths).astype(np.uint64) << np.uint64(8 * j + k)
    out[full] = bits
    return out


def with_fingerprint(docs: DataFrame, text_col: str, size: int, name: str) -> DataFrame:
    """``docs`` and the fingerprint of each row's text as a signed long column ``name``."""
    place = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, DOCS_AT_ONCE):
                part = batch.slice(at, DOCS_AT_ONCE)
                texts = part.column(place).cast(pa.string()).cast(pa.binary()).to_pylist()
                yield pa.record_batch([*part.columns, pa.array(fingerprints(texts, size).view(np.int64))],
                                      names=[*part.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())]))


def fingerprint_table(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """``(doc_id, fp)`` for every row, fp as a signed long."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return with_fingerprint(texts, "text", size, "fp").select("doc_id", "fp")


def _remainder(words: np.ndarray) -> np.ndarray:
    """Syndrome of 23-bit words: remainder by the generator polynomial."""
    words = words.astype(np.int64)
    for bit in range(22, 10, -1):
        words = np.where(words >> bit & 1, words ^ (GOLAY_GENERATOR << (bit - 11)), words)
    return words


@cache
def golay_tables() -> np.ndarray:
    """Error patterns of weight up to 4 by syndrome, lightest first: 2,048 x 6, -1 where there are fewer."""
    patterns = np.array([sum(1 << i for i in c) for w in range(5) for c in combinations(range(23), w)], np.int64)
    syndromes = _remainder(patterns)
    order = np.argsort(syndromes, kind="stable")
    at = np.arange(len(order)) - np.searchsorted(syndromes[order], syndromes[order])
    table = np.full((2048, 6), -1, np.int64)
    table[syndromes[order], at] = patterns[order]
    return table


def golay_indices(words: np.ndarray) -> np.ndarray:
    """Indices (12 bits) of the codewords within 4 of each 23-bit word: decoded first, then -1 padded."""
    patterns = golay_tables()[_remainder(words)]
    return np.where(patterns < 0, -1, (words[:, None] ^ patterns) >> 11)


def fuzzy_keys(fps: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Per fingerprint, the keys of the left and of the right side of the candidate join."""
    indices = [golay_indices((fps >> np.uint64(at)).astype(np.int64) & ((1 << bits) - 1)) for at, bits in SEGMENTS]
    left, right = [], []
    for n, (a, b) in enumerate(combinations(indices, 2)):
        for side, keys in ((left, np.where(b < 0, -1, a[:, :1] << 12 | b)), (right, np.where(a < 0, -1, a << 12 | b[:, :1]))):
            side.append(np.where(keys < 0, -1, keys | n << 24))
    return [x[x >= 0] for x in np.hstack(left)], [x[x >= 0] for x in np.hstack(right)]


def _with_keys(nodes: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            left, right = fuzzy_keys(batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64))
            kind = pa.list_(pa.int64())
            yield pa.record_batch([batch.column("node"), batch.column("fp"), pa.array(left, kind),
                                   pa.array(right, kind)], names=["node", "fp", "l", "r"])

    return nodes.mapInArrow(run, "node long, fp long, l array<long>, r array<long>")


def links(nodes: DataFrame, max_bits: int = 3) -> DataFrame:
    """``(a, b)`` for every pair of distinct fingerprints of ``nodes(node, fp)`` within ``max_bits`` (at most 3)."""
    if not 0 <= max_bits <= 3:
        raise ValueError("the segment keys guarantee at most three differing bits")
    keyed = landed(_with_keys(nodes), "golay-keys")
    left = keyed.select(F.explode("l").alias("key"), F.col("node").alias("a"), F.col("fp").alias("fa"))
    right = keyed.select(F.explode("r").alias("key"), F.col("node").alias("b"), F.col("fp").alias("fb"))
    near = F.bit_count(F.col("fa").bitwiseXOR(F.col("fb"))) <= max_bits
    return left.join(right, (left.key == right.key) & (F.col("fa") < F.col("fb")) & near).select("a", "b").distinct()


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3,
                       max_bits: int = 3) -> DataFrame:
    """``(doc_id, fp, component_id)`` for every row of ``docs``."""
    prints = landed(fingerprint_table(docs, id_col, text_col, size), "fingerprints")
    nodes = landed(prints.groupBy("fp").agg(F.min("doc_id").alias("node")).where("node is not null"), "fp-nodes")
    found = components(links(nodes, max_bits), "a", "b")
    named = nodes.join(found, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return prints.join(named, "fp", "left").select("doc_id", "fp", "component_id")


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns over a ``documents`` table."""
    return simhash_components(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3,
             max_bits: int = 3) -> DataFrame:
    """Rows of ``docs`` that stay: of each group the row with the smallest id, all columns.

    Of several rows with that id one stays (the semi-join has already brought
    them together). Rows without an id stay only if no row with an id has their
    fingerprint, one for each fingerprint.
    """
    table = simhash_components(docs, id_col, text_col, size, max_bits)
    rows = folded(docs, doc_id=F.col(id_col).cast("long"), text=F.col(text_col).cast("string"))
    heads = table.where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    named = rows.join(heads, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    nameless = with_fingerprint(rows.where("doc_id is null"), "text", size, "fp")
    taken = table.where("doc_id is not null").select("fp").distinct()
    nameless = nameless.join(taken, "fp", "left_anti").dropDuplicates(["fp"])
    return named.select("row").unionAll(nameless.select("row")).select(*unfolded(F.col("row"), docs.columns))
