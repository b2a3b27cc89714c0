"""``value LIKE pattern`` joins with patterns from a table, as equi-joins.

A typed list of patterns is one predicate (``ferry.operators.names``); thousands of
patterns from a table are not. Here each pattern is keyed by a piece of text that
every match must hold, and values meet patterns on that piece: an equi-join that Spark
shuffles, broadcasts or splits like any other. Only the pairs that meet are tested
with the whole pattern. Patterns without wildcards meet values by equality.

How long a piece is follows from the pattern's longest run of letters (``LEVELS``): the
longer the run, the longer the piece and the fewer the values that hold it by chance. Of
the pieces in a window of letters only the one of the smallest hash counts; a value that
holds the run holds its windows, so it finds the same pieces, and has to show only a few of
its own. Of a pattern's pieces the rarest is taken, as counted over the values.
Patterns that differ in a few letters meet the same values on a piece that they share, more of both in
larger tables. So where many patterns have a longest run of one length, whole runs of it are the pieces.
Patterns without any letter meet every value (they match most of them anyway).

Pieces travel as hashes with a hash of their value, and only those that are in a Bloom filter of
the patterns' pieces; equal hashes of different texts only mean one more pair to test. Texts
themselves move once, to meet the pairs found. With a piece goes where its value holds it first:
a pattern that is open at both ends is tried around that place before the whole text is searched.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferry.functions.text import quoted
from ferry.operators.names import is_wildcard, like_to_regex
from ferry.session import scratch_path

# The letters beyond ASCII that equal an ASCII letter when case is ignored, and that letter.
FOLDED = {"İ": "i", "ı": "i", "ſ": "s", "K": "k"}
# Letters of a piece, and pieces in a window: patterns take the first level whose windows fit a run.
LEVELS = ((16, 9), (9, 4), (5, 2), (3, 1), (2, 1), (1, 1))
OWN_SHARE = 4            # a length of longest runs that a quarter of the patterns have is a level of its own: whole runs
SPAN = 64                # letters of the longest window, and of the longest such run
# Where lower and upper case are one letter each and long settled, or there is none: ASCII, Latin, Greek, Cyrillic,
# Hebrew to Myanmar, Hangul and Ethiopic, punctuation, CJK, full-width punctuation.
SETTLED = ((0x01, 0x17F), (0x384, 0x3CE), (0x400, 0x45F), (0x590, 0x109F), (0x1100, 0x139F), (0x2000, 0x20BF),
           (0x2E80, 0xA4CF), (0xAC00, 0xD7A3), (0xFF01, 0xFF20))
LETTERS_AT_ONCE = 1 << 15   # arrays of so many hashes stay in a core's cache
MAP_BITS = 32_768        # of one bitmap, fixed by Spark's bitmap functions
MOST_MAPS = 8_192        # 32 MB of filter; with more patterns it lets more pieces through, none is lost
BITS_PER_KEY = 16
PROBES = (0, 20, 36)     # each bit of a key in the filter is named by the key from this bit on
EVERY = 0                # the key that every value has


def literal_runs(pattern: str, wildcard: str = "*") -> list[str]:
    """The runs of letters between wildcards (``*``, ``%``, ``_``, ``[...]``) that a match must hold."""
    runs, run, i = [], "", 0
    while i < len(pattern):
        ch, step = pattern[i], 1
        if ch == "[" and "]" in pattern[i + 1:]:
            step = pattern.index("]", i + 1) - i + 1
        if ch in (wildcard, "%", "_") or step > 1:
            runs.append(run)
            run = ""
        else:
            run += ch
        i += step
    return [r for r in [*runs, run] if r]


def _fold(letter: str) -> str:
    """The letter for all those that a regular expression takes for it when case is ignored."""
    upper = letter.upper()
    lower = (upper if len(upper) == 1 else letter).lower()
    return FOLDED.get(letter) or (lower if len(lower) == 1 else letter)


@cache
def _letters(case_sensitive: bool) -> np.ndarray:
    """Code point -> the code point that stands for it in pieces; 0 where no piece may hold it."""
    out = np.arange(1 << 16, dtype=np.uint32)
    if not case_sensitive:
        out = np.array([ord(_fold(chr(c))) for c in range(1 << 16)], np.uint32)
        settled = np.zeros(1 << 16, bool)
        for first, last in SETTLED:
            settled[first:last + 1] = True
        out[~settled[np.minimum(out, 0xFFFF)]] = 0
    out[0xD800:0xE000] = out[0xFFFF] = 0  # 0xFFFF: and all beyond
    return out


def _codes(text: str, case_sensitive: bool) -> np.ndarray:
    return _letters(case_sensitive)[np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4"), 0xFFFF)]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def _hashes(codes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` letters in a row, put together from those of 1, 2, 4 ... letters."""
    base, total = 0x9E3779B97F4A7C15, len(codes) - size + 1
    block, width = _mixed(codes.astype(np.uint64) + np.uint64(1)), 1
    out, got = None, 0
    while True:
        if size & width:
            out = block[:total] if out is None else out * np.uint64(pow(base, width, 1 << 64)) + block[got:got + total]
            got += width
        if got == size:
            return _mixed(out + np.uint64(size))
        block = block[:-width] * np.uint64(pow(base, width, 1 << 64)) + block[width:]
        width *= 2


def _may_be_in(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The places of the keys that the filter lets through."""
    at = np.arange(len(keys))
    for p in PROBES:
        bit = (keys[at].view(np.uint64) >> np.uint64(p)) & np.uint64(len(bits) * 8 - 1)
        at = at[(bits[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 > 0]
    return at


def _pieces(texts: list[str], size: int, window: int, case_sensitive: bool,
            bits: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the text, key and window's place in it, of each window's piece that may be in the filter ``bits``.

    The same piece in a row counts once, at its first window.
    """
    codes = _codes("\0".join(texts), case_sensitive)
    span = size + window - 1
    if len(codes) < span:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    least, cover = _hashes(codes, size), 1
    while cover < window:
        step = min(cover, window - cover)
        least, cover = np.minimum(least[:-step], least[step:]), cover + step
    cuts = np.concatenate([[0], np.cumsum(codes == 0)])
    whole = cuts[span:] == cuts[:-span]  # windows in one text, without a letter that no piece may hold
    first = whole.copy()
    first[1:] &= (least[1:] != least[:-1]) | ~whole[:-1]
    at = np.flatnonzero(first)
    keys = _mixed(least[at]).view(np.int64)
    if bits is not None:
        let = _may_be_in(bits, keys)
        at, keys = at[let], keys[let]
    starts = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
    owner = np.searchsorted(starts, at, "right") - 1
    return owner, keys, at - starts[owner]


def _runs(pattern: str, wildcard: str, case_sensitive: bool) -> list[str]:
    whole = (_codes(r, case_sensitive).tobytes().decode("utf-32-le") for r in literal_runs(pattern, wildcard))
    return [part for r in whole for part in r.split("\0") if part]


def levels_for(runs: dict[int, int]) -> tuple[tuple[int, int], ...]:
    """``LEVELS`` and those of frequent lengths, the longest first; ``runs``: length of the longest run -> number of patterns."""
    own = {n: 1 for n, count in runs.items() if 1 < n <= SPAN and OWN_SHARE * count >= sum(runs.values())}
    return tuple(sorted((dict(LEVELS) | own).items(), key=lambda level: (sum(level), level), reverse=True))


def pattern_keys(pattern: str, wildcard: str = "*", case_sensitive: bool = False, levels: tuple[tuple[int, int], ...] = LEVELS) -> list[str]:
    """Pieces of one length of which any one finds all matches of a wildcard pattern; '' if it has no letter."""
    runs = _runs(pattern, wildcard, case_sensitive)
    longest = max(map(len, runs), default=0)
    if not longest:
        return [""]
    size, window = next((s, w) for s, w in levels if s + w - 1 <= longest)
    out = set()
    for r in runs:
        if window == 1:
            out |= {r[j:j + size] for j in range(len(r) - size + 1)}
        elif len(r) >= size + window - 1:
            found = _hashes(np.frombuffer(r.encode("utf-32-le"), "<u4"), size)
            out |= {r[j:j + size] for j in (i + int(found[i:i + window].argmin()) for i in range(len(found) - window + 1))}
    return sorted(out)


def _longest(wildcard: str, case_sensitive: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            patterns = batch.column("pattern")
            longest = [max(map(len, _runs(p, wildcard, case_sensitive)), default=0) if is_wildcard(p, wildcard) else None for p in patterns.to_pylist()]
            yield pa.record_batch([patterns, pa.array(longest, pa.int32())], names=["pattern", "longest"])

    return run


def _keyed(wildcard: str, case_sensitive: bool, levels: tuple[tuple[int, int], ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = "s" if case_sensitive else "siu"
        for batch in batches:
            patterns = batch.column("pattern").to_pylist()
            wild = [is_wildcard(p, wildcard) for p in patterns]
            texts = [pattern_keys(p, wildcard, case_sensitive, levels) if w else [] for p, w in zip(patterns, wild)]
            key_of = {"": EVERY}
            for size, _ in levels:
                some = list({k for keys in texts for k in keys if len(k) == size})
                owner, keys, _ = _pieces(some, size, 1, True)  # folded already
                key_of |= {some[i]: k for i, k in zip(owner.tolist(), keys.tolist())}
            yield pa.record_batch(
                [pa.array(patterns, pa.string()), pa.array([like_to_regex(p, wildcard, flags) if w else None for p, w in zip(patterns, wild)], pa.string()),
                 pa.array([len(keys[0]) if keys else None for keys in texts], pa.int32()),
                 pa.array([[key_of[k] for k in keys] for keys in texts], pa.list_(pa.int64())),
                 pa.array([w and {p[0], p[-1]} <= {wildcard, "%"} for p, w in zip(patterns, wild)], pa.bool_())],
                names=["pattern", "regex", "size", "keys", "open"])

    return run


def _key_filter(keys: DataFrame, n: int) -> np.ndarray:
    """A Bloom filter of about ``n`` keys in at most ``MOST_MAPS`` bitmaps (tasks send bitmaps, not keys)."""
    maps = min(MOST_MAPS, 1 << max(0, math.ceil(math.log2(max(1, n * BITS_PER_KEY / MAP_BITS)))))
    bits = [F.shiftrightunsigned("key", p).bitwiseAND(F.lit(maps * MAP_BITS - 1)) for p in PROBES]
    rows = (keys.select(F.explode(F.array(*bits)).alias("bit"))
            .groupBy(F.shiftright("bit", 15).alias("map"))
            .agg(F.expr(f"bitmap_construct_agg(bit & {MAP_BITS - 1})").alias("bits")).collect())
    out = np.zeros(maps * MAP_BITS // 8, np.uint8)
    for r in rows:
        out[r["map"] * MAP_BITS // 8:(r["map"] + 1) * MAP_BITS // 8] = np.frombuffer(r["bits"], np.uint8)
    return out


def _in_parts(texts: list[str]) -> Iterator[tuple[list[int], list[int], list[str]]]:
    """Parts of texts with their texts' places and their own in these, about ``LETTERS_AT_ONCE`` letters at a time.

    Longer texts come in parts that overlap by a window.
    """
    places, offsets, parts, held = [], [], [], 0
    for i, text in enumerate(texts):
        for at in range(0, len(text), LETTERS_AT_ONCE):
            part = text[at:at + LETTERS_AT_ONCE + SPAN]
            if held and held + len(part) > LETTERS_AT_ONCE:
                yield places, offsets, parts
                places, offsets, parts, held = [], [], [], 0
            places.append(i)
            offsets.append(at)
            parts.append(part)
            held += len(part)
    if parts:
        yield places, offsets, parts


def _value_keys(levels: list[tuple[int, int]], every: bool, case_sensitive: bool, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            vids = batch.column("vid").to_numpy()
            found = [(vids, np.full(len(vids), EVERY), np.zeros(len(vids), np.int64))] if every else []
            for places, offsets, parts in _in_parts(batch.column("value").to_pylist()) if levels else ():
                for level in levels:
                    owner, keys, at = _pieces(parts, *level, case_sensitive, bits)
                    found.append((vids[np.array(places)[owner]], keys, at + np.array(offsets)[owner]))
            if found:
                vid, key, at = map(np.concatenate, zip(*found))
                yield pa.record_batch([pa.array(vid), pa.array(key), pa.array(at.astype(np.int32))], names=["vid", "key", "at"])

    return run


def _matches(value: Column) -> Column:
    """Whether the value of a pair matches its pattern.

    What an open pattern matches it also finds in any longer text. A run of the pattern that holds the piece begins a
    window's length after ``_f_at`` at most and a run's length before it, and the pattern is as long as either.
    """
    size, regex = F.length("_f_pattern"), F.col("_f_regex")
    first = F.greatest(F.col("_f_at") - size, F.lit(0))
    return (F.col("_f_open") & F.rlike(value.substr(first + 1, 3 * size), regex)) | F.rlike(value, regex)


def pattern_join(df: DataFrame, col: str, patterns: DataFrame, pattern_col: str, out: str = "pattern",
                 wildcard: str = "*", case_sensitive: bool = False) -> DataFrame:
    """Rows of ``df`` with each pattern of ``patterns[pattern_col]`` that ``col`` matches (column ``out``).

    Entries match as in ``match_any``: with the wildcard as LIKE, without it by equality. Repeated patterns count
    once, NULL values and NULL patterns match nothing.
    """
    spark = df.sparkSession

    def kept(some: DataFrame, label: str) -> DataFrame:  # patterns are read several times, and long in the making
        path = scratch_path(spark, label)
        some.write.parquet(path)
        return spark.read.schema(some.schema).parquet(path)

    distinct = kept(patterns.select(F.col(quoted(pattern_col)).cast("string").alias("pattern")).where(F.col("pattern").isNotNull()).distinct()
                    .mapInArrow(_longest(wildcard, case_sensitive), "pattern string, longest int"), "patterns")
    # At most a row for each length up to SPAN.
    lengths = (distinct.where(F.col("longest").isNotNull()).groupBy(F.least("longest", F.lit(SPAN + 1)).alias("longest"))
               .agg(F.count(F.lit(1)).alias("n")).collect())
    levels = levels_for({r["longest"]: r["n"] for r in lengths})
    chosen = kept(distinct.select("pattern").mapInArrow(_keyed(wildcard, case_sensitive, levels),
                                                        "pattern string, regex string, size int, keys array<long>, open boolean"), "pattern-keys")
    value = F.col(quoted(col)).cast("string")
    equal = (lambda c: c) if case_sensitive else F.lower
    own = [F.col(quoted(c)) for c in df.columns]
    rows = df.where(value.isNotNull())
    out_cols = [*own, F.col("_f_pattern").alias(out)]
    # A row for each length of pieces, and one (NULL) for the patterns without wildcards.
    sizes = {r["size"]: r["n"] for r in chosen.groupBy("size").agg(F.sum(F.size("keys")).alias("n")).collect()}
    plain = chosen.where(F.col("regex").isNull()).select(equal(F.col("pattern")).alias("_f_same"), F.col("pattern").alias("_f_pattern"))
    found = rows.withColumn("_f_same", equal(value)).join(plain, "_f_same").select(*out_cols)
    has_plain = sizes.pop(None, None) is not None
    if not sizes:
        return found
    wild = chosen.where(F.col("regex").isNotNull())
    keys = wild.select("pattern", "regex", "open", F.explode("keys").alias("key"))
    shared = spark.sparkContext.broadcast(_key_filter(keys, sum(sizes.values())).tobytes())
    # Values travel as hashes; equal hashes of different values only mean one more pair to test.
    pieces = (rows.select(F.xxhash64(value).alias("vid"), value.alias("value"))
              .mapInArrow(_value_keys([x for x in levels if x[0] in sizes], 0 in sizes, case_sensitive, shared), "vid long, key long, at int")
              # Said here, so that both uses below read one shuffle.
              .where(F.col("vid").isNotNull() & F.col("key").isNotNull()).groupBy("vid", "key").agg(F.min("at").alias("at")))
    often = pieces.groupBy("key").agg(F.count("at").alias("n"))  # of "at" for the same reason
    # A piece that no value holds shows that the pattern matches nothing.
    rarest = (keys.join(often, "key", "left").groupBy("pattern", "regex", "open")
              .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "key")).alias("best"))
              .where(F.col("best.n") > 0).select("pattern", "regex", "open", F.col("best.key").alias("key")))
    pairs = pieces.join(rarest, "key").select(F.col("vid").alias("_f_vid"), F.col("pattern").alias("_f_pattern"),
                                              F.col("regex").alias("_f_regex"), F.col("open").alias("_f_open"), F.col("at").alias("_f_at"))
    tested = (rows.withColumn("_f_vid", F.xxhash64(value)).join(pairs, "_f_vid").where(_matches(value)).select(*out_cols))
    return found.unionAll(tested) if has_plain else tested
