"""Phrase collocations, counted by dynamic itemset counting.

The corpus is dealt once into ``SHARDS`` shards, which are scanned in a cycle, one
a step. Words are counted from the first step on. As soon as the counts so far of
both subphrases of a longer phrase (all but its last, all but its first word) reach
the threshold, the phrase is active and counted from the next step on, beside
shorter phrases that are still under way. Every phrase is counted for exactly one
full cycle from its own first step, so its count is whole; the scan ends when
nothing is under way. A phrase that reaches the threshold has subphrases that reach
it too, so none is missed, and phrases with a rare part are hardly ever counted.

Tasks must know which phrases are active. They get, for each length, a table of
``SLOTS`` bytes: the step at which a phrase with that hash first reached the
threshold. Its size is fixed. Phrases that share a slot can only become active
too early, all of them at a step that every task agrees on: they are counted
needlessly, never wrongly, and the frequent ones are told by their counts.

Counts go from tasks to Spark as partial sums by language and phrase (exact
strings, no hashes); a step adds them to the counts under way in one shuffle and
lands the result, so a lost executor costs part of a step. The driver gets the
slots of a step as one bitmap a length (``SLOTS`` bits) and nothing that grows with the corpus.

Defined results
    null text counts as empty, null lang as ``und``; repeated rows are texts of
    their own; ids are not read; ties in the score are ordered by count, then
    phrase (UTF-8 bytes); an empty table gives an empty result; extra columns
    are not read; texts without words count for nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ferry.llm.common import landed
from ferry.session import scratch_path

MIN_COUNT = 10
MAX_WORDS = 3
TOP = 2000
SHARDS = 2               # more start longer phrases earlier, and carry counts under way through more shuffles
SLOTS = 1 << 22
MAP_BITS = 32_768        # of one bitmap, fixed by Spark's bitmap functions
NEVER = 255              # a slot that no phrase has reached; steps stay far below it
SALTS = 64
BYTES_AT_ONCE, WORDS_AT_ONCE = 2 << 20, 1 << 19
RAW_KEYS, HELD_KEYS = 2_000_000, 1_500_000
WITHOUT_LANG = "und"

# Upper case A-Z to lower case; piece ends to a line break; tab to a space.
_TABLE = bytes(10 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b in b" \t" else b + 32 if 65 <= b <= 90 else b
               for b in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)
_KIND = "lang string, size int, phrase string, due int, n long"
GAP, END = 0, 1          # ids of the empty word (two spaces in a row) and of the end of a piece


def lang_seed(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode())


def joined(hashes: np.ndarray, more: np.ndarray) -> np.ndarray:
    """Hashes of phrases from those of all but their last words and of their last words."""
    x = (hashes + np.uint64(1)) * _MIX
    return (x ^ (x >> np.uint64(29))) + more


def slots_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes % np.uint64(SLOTS)).astype(np.int64)


class _Vocabulary(dict):
    """Word -> number; keeps every word's hash."""

    def __init__(self, lang: str):
        super().__init__({b"": GAP, b"\n": END})
        self.seed, self.words, self.hashes = lang_seed(lang), [b"", b"\n"], [0, 0]

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.words)
        self.words.append(word)
        self.hashes.append(xxhash.xxh64_intdigest(word, self.seed))
        return number


class _Tally:
    """Keys and their counts, from arrays of keys."""

    def __init__(self):
        self.raw, self.waiting = [], 0
        self.keys, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, keys: np.ndarray) -> None:
        self.raw.append(keys)
        self.waiting += len(keys)
        if self.waiting > RAW_KEYS:
            self.settle()

    def settle(self) -> None:
        if self.waiting:
            keys, counts = np.unique(np.concatenate(self.raw), return_counts=True)
            both = np.concatenate([self.keys, keys])
            self.keys, at = np.unique(both, return_inverse=True)
            self.counts = np.bincount(at, np.concatenate([self.counts, counts])).astype(np.int64)
            self.raw, self.waiting = [], 0


class ShardCounter:
    """Counts, over one language's texts of one shard, the phrases that are active at ``step``."""

    def __init__(self, lang: str, step: int, shards: int, reached: list[np.ndarray]):
        self.lang, self.step, self.shards, self.reached = lang, step, shards, reached
        self.longest = len(reached) + 1
        self.bits = 63 // self.longest
        self.tokens = 0
        self.clear()

    def clear(self) -> None:
        self.vocabulary = _Vocabulary(self.lang)
        self.tallies = [_Tally() for _ in range(self.longest)]

    def full(self) -> bool:
        """Counts should leave before more is added."""
        return (len(self.vocabulary.words) > 1 << (self.bits - 1)
                or sum(len(t.keys) + t.waiting for t in self.tallies) > HELD_KEYS + RAW_KEYS)

    def active(self, hashes: list[np.ndarray], size: int) -> np.ndarray:
        """First step of each phrase of ``size`` words; ``hashes``: those of its two subphrases."""
        return 1 + np.maximum(*[self.reached[size - 2][slots_of(h)].astype(np.int16) for h in hashes])

    def under_way(self, first: np.ndarray) -> np.ndarray:
        return (first <= self.step) & (first + self.shards > self.step)

    def slices(self, text: bytes) -> Iterator[tuple[list[bytes], int]]:
        """Words of ``text`` (lower-cased pieces, each ended by a line break), at most ``WORDS_AT_ONCE`` own ones at a time.

        A slice ends with the next ones as well, for phrases that begin with its own.
        """
        words = text.replace(b"\n", b" \n ").split(b" ")
        if len(words) <= WORDS_AT_ONCE:
            yield words, len(words)
        else:
            words = [w for w in words if w]
            for at in range(0, len(words), WORDS_AT_ONCE):
                yield words[at:at + WORDS_AT_ONCE + self.longest - 1], WORDS_AT_ONCE

    def add(self, words: list[bytes], own: int) -> None:
        """Count the phrases that begin with one of the first ``own`` words."""
        ids = np.fromiter(map(self.vocabulary.__getitem__, words), np.int64, len(words))
        ids = ids[ids != GAP]
        if self.step < self.shards:
            found = ids[:own]
            found = found[found != END]
            self.tokens += len(found)
            self.tallies[0].add(found)
        hashes = np.array(self.vocabulary.hashes, np.uint64)[ids]
        grams, fits, keys = hashes, ids != END, ids
        for size in range(2, self.longest + 1):
            fits = fits[:-1] & (ids[size - 1:] != END)
            mine = np.flatnonzero(fits[:own])
            going = mine[self.under_way(self.active([grams[mine], grams[mine + 1]], size))]
            keys = (keys[:-1] << self.bits) | ids[size - 1:]
            self.tallies[size - 1].add(keys[going])
            if size < self.longest:
                grams = joined(grams[:-1], hashes[size - 1:])

    def batches(self):
        """The counts as record batches; begins anew."""
        words = pa.array(self.vocabulary.words, pa.binary())
        hashes = np.array(self.vocabulary.hashes, np.uint64)
        for size, tally in enumerate(self.tallies, 1):
            tally.settle()
            for at in range(0, len(tally.keys), 100_000):
                keys, counts = tally.keys[at:at + 100_000], tally.counts[at:at + 100_000]
                ids = [(keys >> (self.bits * i)) & ((1 << self.bits) - 1) for i in range(size - 1, -1, -1)]
                due = np.full(len(keys), self.shards - 1)
                if size > 1:
                    halves = [reduce(joined, [hashes[i] for i in part]) for part in (ids[:-1], ids[1:])]
                    due = self.active(halves, size) + self.shards - 1
                phrase = pc.binary_join_element_wise(*[words.take(pa.array(i)) for i in ids], b" ")
                yield self._batch(size, phrase, due, counts)
        if self.tokens:
            yield self._batch(0, pa.array([b""], pa.binary()), np.array([self.shards - 1]), np.array([self.tokens]))
        self.tokens = 0
        self.clear()

    def _batch(self, size: int, phrase: pa.Array, due: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        n = len(counts)
        text = pc.cast(phrase, options=pc.CastOptions(pa.string(), allow_invalid_utf8=True))
        return pa.record_batch([pa.array([self.lang] * n, pa.string()), pa.array(np.full(n, size, np.int32)), text,
                                pa.array(due.astype(np.int32)), pa.array(counts.astype(np.int64))],
                               names=["lang", "size", "phrase", "due", "n"])


def _portions(texts: list[bytes]):
    """The texts as lower-cased pieces, in portions of about ``BYTES_AT_ONCE`` that end where a piece ends."""
    held, size = [], 0
    for text in texts:
        text = text.translate(_TABLE)
        at = 0
        while len(text) - at > BYTES_AT_ONCE:  # a very long text: cut after a piece
            end = text.find(b"\n", at + BYTES_AT_ONCE)
            if end < 0:
                break
            yield text[at:end + 1]
            at = end + 1
        held.append(text[at:])
        size += len(text) - at
        if size > BYTES_AT_ONCE:
            yield b"\n".join(held)
            held, size = [], 0
    if held:
        yield b"\n".join(held)


def _count(step: int, shards: int, reached: list[np.ndarray]):
    """The function that counts a shard's texts (``lang, text``), a task at a time."""
    def run(batches):
        counters: dict[str, ShardCounter] = {}
        for batch in batches:
            by_lang: dict[str, list[bytes]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                counter = counters.setdefault(lang, ShardCounter(lang, step, shards, reached))
                for portion in _portions(texts):
                    for words, own in counter.slices(portion):
                        counter.add(words, own)
                        if counter.full():
                            yield from counter.batches()
            if len(counters) > 1 and sum(sum(len(t.keys) + t.waiting for t in c.tallies) for c in counters.values()) \
                    > HELD_KEYS + RAW_KEYS:  # many languages share what a task may hold
                for counter in counters.values():
                    yield from counter.batches()
                counters.clear()
        for counter in counters.values():
            yield from counter.batches()

    return run


def _slots(batches):
    """``(size, map, bits)``: the slots of a task's phrases, as the bitmaps of ``MAP_BITS`` slots that hold any."""
    found: dict[int, np.ndarray] = {}
    for batch in batches:
        sizes, langs, phrases = batch.column("size").to_numpy(), batch.column("lang"), batch.column("phrase").cast(pa.binary())
        for size in np.unique(sizes).tolist():
            some = pa.array(sizes == size)
            seeds = {lang: lang_seed(lang) for lang in langs.filter(some).unique().to_pylist()}
            hashes = np.array([[xxhash.xxh64_intdigest(w, seeds[lang]) for w in phrase.split(b" ")] for lang, phrase
                               in zip(langs.filter(some).to_pylist(), phrases.filter(some).to_pylist())], np.uint64)
            found.setdefault(size, np.zeros(-(-SLOTS // MAP_BITS) * MAP_BITS, bool))[slots_of(reduce(joined, hashes.T))] = True
    for size, flags in found.items():
        bits = np.packbits(flags, bitorder="little").reshape(-1, MAP_BITS // 8)
        maps = np.flatnonzero(bits.any(axis=1))
        yield pa.record_batch([pa.array(np.full(len(maps), size, np.int32)), pa.array(maps.astype(np.int32)),
                               pa.array([bits[m].tobytes() for m in maps], pa.binary())], names=["size", "map", "bits"])


def crossed_slots(phrases: DataFrame) -> Iterator[tuple[int, np.ndarray]]:
    """``(size, slots)`` of the phrases (``lang, size, phrase``), a bitmap at a time; the driver holds bitmaps, whatever their number."""
    maps = (phrases.select("lang", "size", "phrase").mapInArrow(_slots, "size int, map int, bits binary")
            .groupBy("size", "map").agg(F.expr("bitmap_or_agg(bits)").alias("bits")).collect())
    for r in maps:
        yield r["size"], r["map"] * MAP_BITS + np.flatnonzero(np.unpackbits(np.frombuffer(r["bits"], np.uint8), bitorder="little"))


def frequent_phrases(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", min_count: int = MIN_COUNT,
                     max_words: int = MAX_WORDS, shards: int = SHARDS) -> DataFrame:
    """``(lang, size, phrase, n)``: every phrase of 1 to ``max_words`` words found ``min_count`` times or more.

    Size 0 (an empty phrase) holds the number of all word occurrences of a language.
    """
    if not 2 <= max_words <= 3:  # the numbers of a phrase's words share 63 bits
        raise ValueError("phrases of 2 or 3 words")
    spark = docs.sparkSession
    path = scratch_path(spark, "collocation-shards")
    # Dealt row by row, so that no value of any column decides where its rows go.
    docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(WITHOUT_LANG)).alias("lang"),
                F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                ((F.monotonically_increasing_id() + F.spark_partition_id()) % shards).cast("int").alias("shard")) \
        .write.partitionBy("shard").parquet(path)
    there = {r.shard for r in spark.read.schema("shard int").parquet(path).select("shard").distinct().collect()}
    reached = [np.full(SLOTS, NEVER, np.uint8) for _ in range(max_words - 1)]
    under_way, whole, fresh = None, [], []
    step = 0
    # Words are under way in the first cycle, longer phrases for a cycle after a slot was first reached.
    while step < shards or any(fresh[-shards:]):
        if step >= NEVER:
            raise RuntimeError("more steps than phrases of this length can take")
        parts = [under_way] if under_way is not None else []
        if step % shards in there:
            texts = spark.read.schema("lang string, text string").parquet(f"{path}/shard={step % shards}")
            parts.append(texts.mapInArrow(_count(step, shards, reached), _KIND).withColumn("before", F.lit(0).cast("long")))
        if not parts:
            fresh.append(0)
            step += 1
            continue
        # Few rows of a task are alike, so they are dealt out first and summed once.
        counts = (reduce(DataFrame.unionByName, parts).repartition("lang", "size", "phrase").groupBy("lang", "size", "phrase")
                  .agg(F.max("due").alias("due"), F.sum("n").alias("n"), F.sum("before").alias("before")))
        counts = landed(counts.where((F.col("due") > step) | (F.col("n") >= min_count) | (F.col("size") == 0)),
                        "collocation-counts")
        crossed = counts.where((F.col("before") < min_count) & (F.col("n") >= min_count)
                               & F.col("size").between(1, max_words - 1))
        fresh.append(0)
        for size, slot in crossed_slots(crossed):
            table = reached[size - 1]
            slot = slot[table[slot] == NEVER]
            table[slot] = step
            fresh[-1] += len(slot)
        whole.append(counts.where(F.col("due") == step).select("lang", "size", "phrase", "n"))
        under_way = counts.where(F.col("due") > step).select("lang", "size", "phrase", "due", "n", F.col("n").alias("before"))
        step += 1
    if not whole:
        return spark.createDataFrame([], "lang string, size int, phrase string, n long")
    return reduce(DataFrame.unionAll, whole)


# -- scores -------------------------------------------------------------------

def scored(phrases: DataFrame, half: tuple[int, int] = (50, 100), top: int = TOP) -> DataFrame:
    """Collocations of :func:`frequent_phrases`: the best ``top`` of each language with their weakest cut.

    ``(lang, rank, phrase, a, l, r, n, score)``; a phrase is dropped if a longer one that holds it has at least
    ``half[0] / half[1]`` of its occurrences.
    """
    phrases = landed(phrases, "collocation-phrases")
    several = phrases.where(F.col("size") > 1).select("lang", "phrase", "size", F.col("n").alias("a"),
                                                      F.split("phrase", " ").alias("w"))

    def run_of(first, length):  # of the words w
        return F.array_join(F.slice("w", first, length), " ")

    def part(name):
        return phrases.where(F.col("size") > 0).select("lang", F.col("phrase").alias(f"{name}_phrase"), F.col("n").alias(name))

    cuts = several.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", "a", "k", run_of(F.lit(1), F.col("k")).alias("l_phrase"),
        run_of(F.col("k") + 1, F.col("size") - F.col("k")).alias("r_phrase"))
    cuts = cuts.join(part("l"), ["lang", "l_phrase"]).join(part("r"), ["lang", "r_phrase"])
    wide = "cast({} as decimal(16, 0))"  # products of two take 32 digits, with the factor a million 38
    score = F.expr(f"(cast(1000000 as decimal(7, 0)) * ({wide.format('a')} * {wide.format('a')})) "
                   f"div ({wide.format('l')} * {wide.format('r')})")
    best = (cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
            .select("lang", "phrase", "a", "cut.score", "cut.l", "cut.r"))
    inside = (several.where(F.col("size") > 2)
              .withColumn("part", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
              .withColumn("at", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("part") + 1)))
              .groupBy("lang", run_of(F.col("at"), F.col("part")).alias("phrase")).agg(F.max("a").alias("longer")))
    left = best.join(inside, ["lang", "phrase"], "left").where(
        F.coalesce(half[1] * F.col("longer") < half[0] * F.col("a"), F.lit(True))).drop("longer")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # First within parts of a language, so that its phrases do not meet in one task; then at most SALTS * top of them.
    left = left.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    left = left.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
    left = left.where(F.col("rank") <= top)
    left = left.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    totals = phrases.where(F.col("size") == 0).select("lang", "n")
    return left.where(F.col("rank") <= top).join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", min_count: int = MIN_COUNT,
                 max_words: int = MAX_WORDS, half: tuple[int, int] = (50, 100), top: int = TOP,
                 shards: int = SHARDS) -> DataFrame:
    return scored(frequent_phrases(docs, lang_col, text_col, min_count, max_words, shards), half, top)


def digest(docs: DataFrame) -> DataFrame:
    """The contract's rows over the whole ``documents`` table."""
    return collocations(docs)


ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
), grams AS (
  SELECT lang, k, unnest(list_transform(generate_series(1, len(w) - k + 1), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM w, (SELECT unnest([1, 2, 3]) AS k)
), f AS (
  SELECT lang, k, phrase, count(*) AS n FROM grams GROUP BY ALL
), c AS (
  SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND n >= 10
), cuts AS (
  SELECT lang, phrase, a, j, array_to_string(w[1:j], ' ') AS lp, array_to_string(w[j + 1:], ' ') AS rp
  FROM c, (SELECT unnest([1, 2]) AS j) WHERE j < k
), rated AS (
  SELECT cuts.lang, cuts.phrase, a, j, fl.n AS l, fr.n AS r,
         ((1000000::HUGEINT * a * a) // (fl.n::HUGEINT * fr.n))::BIGINT AS score
  FROM cuts JOIN f fl ON fl.lang = cuts.lang AND fl.phrase = lp JOIN f fr ON fr.lang = cuts.lang AND fr.phrase = rp
  QUALIFY row_number() OVER (PARTITION BY cuts.lang, cuts.phrase ORDER BY score, j) = 1
), inside AS (
  SELECT lang, array_to_string(w[i:i + 1], ' ') AS phrase, max(a) AS longer
  FROM c, (SELECT unnest([1, 2]) AS i) WHERE k = 3 GROUP BY ALL
), total AS (
  SELECT lang, sum(n)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang
)
SELECT rated.lang, row_number() OVER (PARTITION BY rated.lang ORDER BY score DESC, a DESC, rated.phrase) AS rank,
       rated.phrase, a, l, r, total.n, score
FROM rated LEFT JOIN inside ON inside.lang = rated.lang AND inside.phrase = rated.phrase
     JOIN total ON total.lang = rated.lang
WHERE longer IS NULL OR 100 * longer < 50 * a
QUALIFY rank <= 2000
"""
