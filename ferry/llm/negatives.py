"""Hard negatives by exact integer scores, computed as a residue-number-system matrix product.

Components become integers (``floor(scale * x)``). For a few primes below 1,024
the integers are reduced to signed residues; a float32 matrix product of residues
is exact as long as its partial sums stay below 2^24, so dimensions are taken in
runs of bounded length. The residues of a score are put together by Chinese
remaindering (mixed radix, in int64): with enough primes the signed score comes
back exactly, whatever the order of summation. How many primes are needed
follows from the largest component of the table.

Anchors are a stated set of rows, scored against all rows. They are taken in
waves of about ``WAVE`` anchors, and every wave is one scan of the rows: no row
vector is shuffled. Tasks keep, for each anchor, the few best rows they have seen;
a window over these partial lists selects the result. A wave takes two scans: the
first finds the positives, the second the negatives in each positive's window
of scores. The driver holds one wave of anchors (a bounded number of vectors) at a time.

Defined results
    rows with a null id, label or vector, or with a null or non-finite component,
    take no part, nor do vectors without components or of another length than the
    commonest; zero vectors do take part; "other rows" of an anchor are those with another id;
    exact repeats of an anchor (id, label and vector) are one anchor, other
    repeated rows count one by one; ties go to the smaller id; a positive with a
    score below zero has an empty window; an empty table gives an empty result;
    extra columns are not read; scores that could pass 2^60 (components near
    2^30 / sqrt(dimensions)) are refused with an error, as they would not fit the result.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferry.llm.common import landed
from ferry.llm.vectors import _usual_size, matrix

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
LOW, HIGH = (80, 100), (100, 100)   # 80 * positive <= 100 * negative <= 100 * positive
WAVE = 16_384                       # anchors the driver and each task hold at once, about
ANCHORS_AT_ONCE, ROWS_AT_ONCE = 1024, 2048
LIMIT = 1 << 60
EXACT = 1 << 24                     # whole numbers below this are exact in float32
NONE = np.iinfo(np.int64).min
PRIMES = [p for p in range(1021, 500, -2) if all(p % q for q in range(3, 32, 2))]


# -- the product --------------------------------------------------------------

def primes_for(bound: int) -> list[int]:
    """The largest primes below 1,024 whose product exceeds ``2 * bound + 1``."""
    product, taken = 1, []
    for p in PRIMES:
        if product > 2 * bound + 1:
            break
        taken.append(p)
        product *= p
    return taken


def residues(numbers: np.ndarray, prime: int) -> np.ndarray:
    """Signed residues, at most ``prime // 2`` in size, as float32."""
    r = numbers % prime
    return np.where(r > prime // 2, r - prime, r).astype(np.float32)


def product_mod(a: np.ndarray, b: np.ndarray, prime: int) -> np.ndarray:
    """``a @ b.T`` modulo ``prime`` (0 to prime - 1) of signed residues, exact: float32 in runs of dimensions."""
    run = max(1, EXACT // (prime // 2) ** 2)
    total = np.zeros((len(a), len(b)), np.int64)
    for at in range(0, a.shape[1], run):
        total += (a[:, at:at + run] @ b[:, at:at + run].T).astype(np.int64)
    return total % prime


def rebuild(parts: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Signed numbers from their residues (Chinese remaindering by mixed-radix digits).

    The digits of largest weight may pass int64 when few numbers near the bound
    exist; int64 arithmetic wraps modulo 2^64, so a result that fits is still exact.
    """
    digits: list[np.ndarray] = []
    for i, (part, prime) in enumerate(zip(parts, primes)):
        digit = part
        for j in range(i):
            digit = (digit - digits[j]) * pow(primes[j], -1, prime) % prime
        digits.append(digit)
    # Above half of the range means negative: compare from the most significant digit of (M - 1) / 2 down.
    half, bounds = (reduce(int.__mul__, primes, 1) - 1) // 2, []
    for prime in primes:
        bounds.append(half % prime)
        half //= prime
    negative = np.zeros(parts[0].shape, bool)
    for digit, bound in zip(digits, bounds):
        negative = np.where(digit == bound, negative, digit > bound)
    value, weight = np.zeros(parts[0].shape, np.uint64), 1
    for digit, prime in zip(digits, primes):
        value += digit.astype(np.uint64) * np.uint64(weight % (1 << 64))
        weight *= prime
    return np.where(negative, value - np.uint64(weight % (1 << 64)), value).view(np.int64)


class Scores:
    """Exact integer inner products of any rows with fixed anchors."""

    def __init__(self, anchors: np.ndarray, bound: int):
        self.primes = primes_for(bound)
        self.parts = [residues(anchors, p) for p in self.primes]

    def __call__(self, rows: np.ndarray, part: slice) -> np.ndarray:
        """One line per row of ``rows``, one column per anchor of ``part``."""
        return rebuild([product_mod(residues(rows, p), mine[part], p)
                        for p, mine in zip(self.primes, self.parts)], self.primes)


# -- best rows of a task ------------------------------------------------------

class Best:
    """For each of ``n`` slots, the ``k`` best (score, id) offered so far: larger scores, then smaller ids."""

    def __init__(self, n: int, k: int):
        self.k, self.least = k, np.full(n, NONE)
        self.slot, self.score, self.id = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def offer(self, first: int, scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray) -> None:
        """``scores`` (row by slot, slots from ``first`` on) where ``allowed``."""
        k, until = self.k, first + scores.shape[1]
        least = self.least[first:until]
        if len(scores) > k and (least == NONE).any():
            # Nothing below the k-th of these rows can stay.
            least = np.maximum(least, np.partition(np.where(allowed, scores, NONE), -k, axis=0)[-k])
        row, slot = np.nonzero(allowed & (scores >= least))
        if not len(row):
            return
        slots = np.concatenate([self.slot, slot + first])
        score, number = np.concatenate([self.score, scores[row, slot]]), np.concatenate([self.id, ids[row]])
        by = np.lexsort((number, -score, slots))
        slots, score, number = slots[by], score[by], number[by]
        rank = np.arange(len(slots)) - np.searchsorted(slots, slots)
        keep = rank < k
        self.slot, self.score, self.id = slots[keep], score[keep], number[keep]
        full = rank == k - 1
        self.least[slots[full]] = score[full]


def _candidates(rows: DataFrame, wave: "Wave", pick) -> DataFrame:
    """``(slot, score, id)``: the best rows of every task, by what ``pick`` offers."""
    def run(batches):
        best = pick.start()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                ids, labels = part.column("id").to_numpy(), part.column("label").to_numpy()
                q = matrix(part.column("q"))
                for first in range(0, len(wave.ids), ANCHORS_AT_ONCE):
                    those = slice(first, first + ANCHORS_AT_ONCE)
                    pick.offer(best, wave, those, wave.scores(q, those), ids, labels)
        for place, found in enumerate(best):
            yield pa.record_batch([pa.array(found.slot * len(best) + place), pa.array(found.score), pa.array(found.id)],
                                  names=["slot", "score", "id"])

    return rows.mapInArrow(run, "slot long, score long, id long")


def _first(df: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each slot, ranked from 1 (a few rows a task and slot come in)."""
    order = Window.partitionBy("slot").orderBy(F.desc("score"), "id")
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


class Wave:
    """A bounded set of anchors."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, q: np.ndarray, bound: int):
        self.ids, self.labels, self.scores = ids, labels, Scores(q, bound)


class Positives:
    """Rows of the anchor's label with another id; one slot for each anchor."""

    def __init__(self, anchors: int, k: int):
        self.anchors, self.k = anchors, k

    def start(self) -> list[Best]:
        return [Best(self.anchors, self.k)]

    def offer(self, best, wave, those, scores, ids, labels) -> None:
        same = (labels[:, None] == wave.labels[those]) & (ids[:, None] != wave.ids[those])
        best[0].offer(those.start, scores, same, ids)


class Negatives:
    """Rows of another label in the window of scores of a positive; a slot for each anchor and place among its positives.

    ``low`` and ``high`` hold, for every place and anchor, the bounds of the window (empty where low > high).
    """

    def __init__(self, low: np.ndarray, high: np.ndarray, k: int):
        self.low, self.high, self.k = low, high, k

    def start(self) -> list[Best]:
        return [Best(self.low.shape[1], self.k) for _ in self.low]

    def offer(self, best, wave, those, scores, ids, labels) -> None:
        other = (labels[:, None] != wave.labels[those]) & (ids[:, None] != wave.ids[those])
        for place, mine in enumerate(best):
            low, high = self.low[place, those], self.high[place, those]
            if (low <= high).any():
                mine.offer(those.start, scores, other & (scores >= low) & (scores <= high), ids)


def _below(numerator: int, denominator: int, scores: np.ndarray, up: bool) -> np.ndarray:
    """``numerator * score / denominator`` rounded down or up, in Python integers (a few per anchor)."""
    return np.array([-(-numerator * int(s) // denominator) if up else numerator * int(s) // denominator
                     for s in scores.reshape(-1)], np.int64).reshape(scores.shape)


# -- whole tables -------------------------------------------------------------

def quantised(vectors: DataFrame, id_col: str, vec_col: str, label: Column, scale: int = SCALE) -> DataFrame:
    """``(id, label, q)`` of the rows that take part."""
    size = _usual_size(vectors, vec_col)
    vec = F.col(vec_col)
    finite = F.forall(vec, lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)))
    return (vectors.where(F.col(id_col).isNotNull() & label.isNotNull() & (F.lit(size) > 0)
                          & F.coalesce((F.size(vec) == size) & finite, F.lit(False)))
            .select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"),
                    F.transform(vec, lambda x: F.floor(x.cast("double") * scale)).cast("array<long>").alias("q")))


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: tuple[int, int] = LOW, high: tuple[int, int] = HIGH, wave: int = WAVE) -> DataFrame:
    """Hard negatives of every anchor of ``rows(id, label, q)`` (``is_anchor``: a condition on ``id`` and ``label``).

    ``(anchor_id, positive_id, positive_rank, rank, negative_id, positive_score, negative_score)``: for each of an
    anchor's ``positives`` best rows of its label, the ``negatives`` best rows of other labels whose score lies
    between ``low`` and ``high`` (fractions) of the positive's.
    """
    spark = rows.sparkSession
    rows = landed(rows, "negatives-rows")
    none = spark.createDataFrame([], "anchor_id long, positive_id long, positive_rank int, rank int, negative_id long, "
                                     "positive_score long, negative_score long")
    top = rows.agg(F.max(F.aggregate("q", F.lit(0.0), lambda m, x: F.greatest(m, F.abs(x.cast("double"))))).alias("most"),
                   F.max(F.size("q")).alias("size"), F.count(F.when(is_anchor, 1)).alias("anchors")).first()
    if not top.anchors:
        return none
    bound = int(top.size) * int(top.most) ** 2
    if bound >= LIMIT:
        raise ValueError(f"components up to {top.most} give scores that do not fit: scale the vectors down")
    # Exact repeats of an anchor fall into one wave and are one anchor.
    waves = -(-top.anchors // wave)
    anchors = landed(rows.where(is_anchor).distinct().withColumn("wave", F.pmod(F.xxhash64("id", "label", "q"), F.lit(waves))),
                     "negatives-anchors") if waves > 1 else rows.where(is_anchor).distinct().withColumn("wave", F.lit(0))
    parts = [_wave(rows, anchors.where(F.col("wave") == w), bound, positives, negatives, low, high) for w in range(waves)]
    return reduce(DataFrame.unionAll, [p for p in parts if p is not None], none)


def _wave(rows: DataFrame, anchors: DataFrame, bound: int, positives: int, negatives: int, low: tuple[int, int],
          high: tuple[int, int]) -> DataFrame | None:
    """One wave, landed."""
    got = anchors.select("id", "label", "q").toArrow().combine_chunks()  # about WAVE rows
    if not got.num_rows:
        return None
    ids, labels = got.column("id").to_numpy(), got.column("label").to_numpy()
    wave = Wave(ids, labels, matrix(got.column("q").combine_chunks()), bound)
    # At most ``positives`` rows for each anchor of the wave.
    found = _first(_candidates(rows, wave, Positives(len(ids), positives)), positives).toPandas()
    place = found["rank"].to_numpy() - 1
    score = np.zeros((positives, len(ids)), np.int64)
    number, there = np.zeros_like(score), np.zeros_like(score, dtype=bool)
    at = (place, found["slot"].to_numpy())
    score[at], number[at], there[at] = found["score"], found["id"], True
    least = np.where(there, _below(*low, score, up=True), 1)
    most = np.where(there, _below(*high, score, up=False), 0)
    best = _first(_candidates(rows, wave, Negatives(least, most, negatives)), negatives)

    def named(batches):
        for batch in batches:
            slot = batch.column("slot").to_numpy()
            anchor, mine = slot // positives, slot % positives
            yield pa.record_batch([pa.array(ids[anchor]), pa.array(number[mine, anchor]), pa.array((mine + 1).astype(np.int32)),
                                   batch.column("rank"), batch.column("id"), pa.array(score[mine, anchor]),
                                   batch.column("score")],
                                  names=["anchor_id", "positive_id", "positive_rank", "rank", "negative_id",
                                         "positive_score", "negative_score"])

    return landed(best.mapInArrow(named, "anchor_id long, positive_id long, positive_rank int, rank int, negative_id long, "
                                         "positive_score long, negative_score long"), "negatives-wave")


def digest(vectors: DataFrame) -> DataFrame:
    """The contract's rows over the whole ``embeddings`` table."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    rows = quantised(vectors, "vec_id", "embedding", label)
    return hard_negatives(rows, F.col("id") % 100 == 0)


ORACLE = """
WITH usual AS (
  SELECT len(embedding) AS size FROM embeddings WHERE embedding IS NOT NULL
  GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1
), r AS (
  SELECT vec_id AS id,
         CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
         list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) = (SELECT size FROM usual)
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x::DOUBLE))) = len(embedding)
), long AS (
  SELECT id, label, unnest(q) AS x, generate_subscripts(q, 1) AS i FROM r
), s AS (
  SELECT a.id AS anchor_id, b.id AS id, a.label = b.label AS same, sum(a.x * b.x)::BIGINT AS score
  FROM (SELECT * FROM long WHERE id % 100 = 0) a JOIN long b ON a.i = b.i AND a.id <> b.id
  GROUP BY 1, 2, 3
), p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id)::INTEGER AS positive_rank
  FROM s WHERE same QUALIFY positive_rank <= 5
)
SELECT p.anchor_id, p.positive_id, p.positive_rank,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id)::INTEGER AS rank,
       s.id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
QUALIFY rank <= 5
"""
