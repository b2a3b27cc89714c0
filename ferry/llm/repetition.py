"""Quality rules: repetition found with a suffix array over the words of each text.

The words of many documents are sorted as suffixes at once (prefix doubling on
arrays, only the suffixes not told apart yet go on; words of different documents
count as different, so no repeat crosses a border). Common prefixes of neighbouring
suffixes come from the ranks that the doubling passed through. Intervals of the
common prefixes whose occurrences differ in the word before them are the maximal
repeated substrings; the union of their spans, as a share of the words, and the
longest of them are limited, beside base rules on length and repeated 3-word windows.

A document is judged alone, inside the task that reads it, so nothing is shuffled.
``WORDS_AT_ONCE`` bounds what a task sorts at once; a longer document is sorted alone
(some 100 bytes a word).

Defined results
    null text counts as empty; texts without words have counts of zero and fail the
    base rules; null ids and repeated rows are judged like any other row; an
    empty table gives an empty result; extra columns are not read. Words, lines
    and symbols are those of whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 50
WINDOW = 3               # words of the windows of the base rule
MAX_WINDOW_SHARE = (50, 100)
MIN_REPEAT = 8           # words a repeated substring has at least
MAX_COVERED = (30, 100)  # share of the words that repeated substrings may cover
MAX_REPEAT = 100         # words the longest repeated substring may have
SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\x0b\x0c\r"
WORDS_AT_ONCE = 500_000


# -- suffix array -------------------------------------------------------------

def _first_of(new: np.ndarray) -> np.ndarray:
    """Index of the first element of each element's group; ``new`` marks where groups begin."""
    return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))


def _changes(values: np.ndarray) -> np.ndarray:
    return np.concatenate([[True], values[1:] != values[:-1]])


def suffix_array(symbols: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order and the common prefix of each with the one before it.

    ``ends`` is, for every position, the end of its document; symbols of different
    documents must differ. Suffixes end where their documents end.
    """
    n = len(symbols)
    by = np.argsort(symbols, kind="stable")
    new = _changes(symbols[by])
    rank = np.empty(n + 1, np.int64)
    rank[by], rank[n] = _first_of(new), -1
    levels = [rank.astype(np.int32)]
    going, length = by[~(new & np.append(new[1:], True))], 1
    while len(going):
        ahead = going + length
        key = rank[going] * (n + 1) + np.where(ahead < ends[going], rank[np.minimum(ahead, n)] + 1, 0)
        by = np.argsort(key, kind="stable")
        going, key = going[by], key[by]
        before, new = rank[going], _changes(key)
        rank[going] = before + _first_of(new) - _first_of(_changes(before))
        going = going[~(new & np.append(new[1:], True))]
        length *= 2
        levels.append(rank.astype(np.int32))
    order = np.empty(n, np.int64)
    order[rank[:n]] = np.arange(n)
    return order, _common_prefixes(order, levels)


def _common_prefixes(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """For each suffix but the first, the words it shares with the one before; 0 for the first.

    ``levels[i]`` ranks all positions by their first ``2 ** i`` words.
    """
    common = np.zeros(len(order), np.int64)
    there = np.flatnonzero(levels[0][order[1:]] == levels[0][order[:-1]]) + 1
    a, b = order[there - 1].copy(), order[there].copy()
    for i in range(len(levels) - 1, -1, -1):
        same = levels[i][a] == levels[i][b]
        step = np.where(same, 1 << i, 0)
        common[there] += step
        a += step
        b += step
    return common


class Repeat(NamedTuple):
    """A maximal repeated substring: its words, and where its occurrences stand in the suffix array."""
    length: int
    first: int
    last: int


def maximal_repeats(symbols: np.ndarray, order: np.ndarray, common: np.ndarray, least: int) -> Iterator[Repeat]:
    """Maximal repeated substrings of at least ``least`` words, from the intervals of common prefixes.

    An interval is maximal to the right by itself, and to the left if the word before its
    occurrences is not always the same one (a document's first word has none).
    """
    before = np.where(order > 0, symbols[np.maximum(order, 1) - 1], -1)
    differs = np.concatenate([[0], np.cumsum(before[1:] != before[:-1])]) if len(order) else np.zeros(0)
    at = np.flatnonzero(common >= least)
    open_: list[tuple[int, int]] = []  # length, first
    last = -2

    def closed(length: int, until: int):
        """Intervals that end at ``until``, down to those of at most ``length``; returns where a shorter one begins."""
        first = None
        while open_ and open_[-1][0] > length:
            size, first = open_.pop()
            if differs[until] > differs[first]:
                yield Repeat(size, first, until)
        return first

    for i in at:
        if i != last + 1:
            yield from closed(0, last)
        first = yield from closed(int(common[i]), i - 1)
        if not open_ or open_[-1][0] < common[i]:
            open_.append((int(common[i]), int(i) - 1 if first is None else first))
        last = int(i)
    yield from closed(0, last)


# -- documents ----------------------------------------------------------------

def _numbers(words: list[list[bytes]]) -> np.ndarray:
    """A number for each word of each document: equal for equal words of one document only."""
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for ws in words for w in ws), np.int64, sum(map(len, words)))
    return np.repeat(np.arange(len(words)), [len(ws) for ws in words]) * max(1, len(known)) + ids


def _covered(repeat: np.ndarray, least: int) -> np.ndarray:
    """Words inside the union of repeated substrings of ``least`` words or more; ``repeat``: the longest at each word.

    The occurrences of maximal repeats cover what the longest repeat at every word covers: one that
    can grow to the left lies inside the one that begins a word earlier.
    """
    n = len(repeat)
    at = np.flatnonzero(repeat >= least)
    edges = np.bincount(at, minlength=n + 1) - np.bincount(at + repeat[at], minlength=n + 1)
    return np.cumsum(edges[:n]) > 0


def _text_counts(text: bytes) -> tuple[int, int, int]:
    """Code points in words, symbols, and lines with a word that equal an earlier line."""
    n = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    points = int(n.sum() - n[128:192].sum() - n[list(BLANKS)].sum())
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return points, int(n[list(SYMBOLS)].sum()), len(lines) - len(set(lines))


def judged(texts: list[bytes], min_repeat: int = MIN_REPEAT) -> dict[str, np.ndarray | list]:
    """Counts of each text, of its words and of its repeats, and the spans (word positions) its repeats cover."""
    words = [t.split() for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(sizes)
    symbols = _numbers(words)
    order, common = suffix_array(symbols, np.repeat(ends, sizes)) if len(symbols) else (symbols, symbols)
    repeat = np.zeros(len(symbols), np.int64)
    repeat[order] = np.maximum(common, np.append(common[1:], 0)[:len(common)])
    counts = np.array([_text_counts(t) for t in texts], np.int64).reshape(-1, 3)
    which = np.repeat(np.arange(len(texts)), sizes)

    def by_text(marks):
        return np.bincount(which[marks], minlength=len(texts))

    inside = _covered(repeat, min_repeat)
    text_of = np.concatenate([[-1], np.where(inside, which, -1), [-1]])  # the text of every covered word
    begins = np.flatnonzero(inside & (text_of[1:-1] != text_of[:-2]))
    finish = np.flatnonzero(inside & (text_of[1:-1] != text_of[2:])) + 1
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    for a, b in zip(begins, finish):
        start = int(ends[which[a]] - sizes[which[a]])
        spans[which[a]].append((int(a) - start, int(b) - start))
    found = np.array([order[r.first] for r in maximal_repeats(symbols, order, common, min_repeat)], np.int64)
    longest = np.zeros(len(texts), np.int64)
    np.maximum.at(longest, which, repeat)
    return {"n_words": sizes, "word_chars": counts[:, 0], "n_symbols": counts[:, 1], "n_dup_lines": counts[:, 2],
            "n_repeat_words": by_text(_covered(np.where(repeat >= WINDOW, WINDOW, 0), WINDOW)),
            "n_covered_words": by_text(inside), "longest_repeat": longest,
            "n_repeats": np.bincount(which[found], minlength=len(texts)), "spans": spans}


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered_words", "longest_repeat", "n_repeats")


def repetition(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_repeat: int = MIN_REPEAT) -> DataFrame:
    """One row per document with its counts and ``spans`` (from, to: words inside repeated substrings)."""
    spans_kind = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))

    def row_batch(ids: list, texts: list[bytes]):
        out = judged(texts, min_repeat)
        spans = [[{"from": a, "to": b} for a, b in s] for s in out["spans"]]
        return pa.record_batch([pa.array(ids, pa.int64()), *[pa.array(out[c], pa.int64()) for c in _COUNTS],
                                pa.array(spans, spans_kind)], names=["doc_id", *_COUNTS, "spans"])

    def run(batches):
        for batch in batches:
            ids, texts, held = [], [], 0
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                size = len(text or b"") // 4  # words, at most about
                if texts and held + size > WORDS_AT_ONCE:
                    yield row_batch(ids, texts)
                    ids, texts, held = [], [], 0
                ids.append(i)
                texts.append(text or b"")
                held += size
            if texts:
                yield row_batch(ids, texts)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"doc_id long, {', '.join(f'{c} long' for c in _COUNTS)}, spans array<struct<from: long, to: long>>")


def with_verdict(counts: DataFrame, min_words: int = MIN_WORDS, max_window_share: tuple[int, int] = MAX_WINDOW_SHARE,
                 max_covered: tuple[int, int] = MAX_COVERED, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """``base_failed`` and ``kept`` beside the counts of :func:`repetition`; shares are exact fractions."""
    n = F.col("n_words")
    failed = (n < min_words) | (max_window_share[1] * F.col("n_repeat_words") > max_window_share[0] * n)
    within = (max_covered[1] * F.col("n_covered_words") <= max_covered[0] * n) & (F.col("longest_repeat") <= max_repeat)
    return counts.withColumn("base_failed", failed).withColumn("kept", ~failed & within)


def keep_unrepetitive(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents that the rules keep: ``(doc_id, spans, ...)`` of :func:`with_verdict` where ``kept``."""
    return with_verdict(repetition(docs, id_col, text_col)).where("kept")


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns over the whole ``documents`` table, plus the covered words."""
    return with_verdict(repetition(docs)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                                 "n_repeat_words", "base_failed", "kept", "n_covered_words")


# Repeated substrings of 8 words or more cover what repeated 8-word windows cover, and one of over 100 words
# exists if a window of 101 words is repeated.
ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), t AS (
  SELECT r, doc_id, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols
  FROM d
), windows AS (
  SELECT r, size, i, count(*) OVER (PARTITION BY r, size, hash_key) AS found FROM (
    SELECT r, size, i, array_to_string(w[i:i + size - 1], ' ') AS hash_key FROM (
      SELECT r, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i FROM t, (SELECT unnest([3, 8, 101]) AS size)))
), covered AS (
  SELECT r, count(DISTINCT p) FILTER (size = 3) AS three, count(DISTINCT p) FILTER (size = 8) AS eight,
         count(*) FILTER (size = 101) AS long FROM (
    SELECT r, size, unnest(generate_series(i, i + size - 1)) AS p FROM windows WHERE found > 1)
  GROUP BY r
), counts AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         n_symbols::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(three, 0)::BIGINT AS n_repeat_words, coalesce(eight, 0)::BIGINT AS n_covered_words, coalesce(long, 0) AS long
  FROM t LEFT JOIN covered USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * n_covered_words <= 30 * n_words AND long = 0 AS kept,
       n_covered_words
FROM counts
"""
