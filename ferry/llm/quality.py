"""Quality classifier: random Fourier features over document statistics.

One Arrow pass turns each whole text into a fixed vector of statistics. Random
Fourier features of the standardised vector approximate a Gaussian kernel;
partition-wise sums of their normal equations (per fold, so that out-of-fold
models come by subtraction) fit ridge scores, and isotonic regression on the
out-of-fold scores calibrates them to probabilities.

The driver sees one row of means, ``FEATURES + 1`` summed rows per fold and the
calibration bins: fixed sizes, whatever the corpus.

Defined results
    null text counts as empty, and empty texts get the score of a text without
    words; null ids are scored and are never training rows; a repeated labels
    row counts once (the larger label wins a conflict); without training rows
    every score is 0.5, and ``keep_good`` keeps every document; empty table:
    empty result; extra columns are not read.
"""

from __future__ import annotations

from collections import Counter
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.llm.calibration import bin_of, calibrated, isotonic
from ferry.llm.common import is_held_out, landed

FEATURES = 256
FOLDS = 4
RIDGE = 1.0
WIDTH = 1.0     # kernel width, in units of the square root of the number of statistics
SEED = 7
KEEP_AT = 0.7
DOCS_AT_ONCE = 512

# Byte classes: 0 other symbol, 1 lower letter or part of a non-ASCII one, 2 upper letter, 3 digit, 4 space,
# 5 line break, 6 sentence punctuation.
CLASS = np.zeros(256, np.int64)
CLASS[128:] = 1
for _n, _chars in ((1, b"abcdefghijklmnopqrstuvwxyz"), (2, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (3, b"0123456789"),
                   (4, b" \t\r\x0b\x0c"), (5, b"\n"), (6, b".,;:'\"()-?")):
    CLASS[list(_chars)] = _n
STATISTICS = ("log_words", "mean_word", "word_spread", "lower", "upper", "digits", "space", "punctuation", "symbols",
              "exclamation", "pipes", "distinct_words", "top_word", "repeated_neighbours", "lettered_words",
              "log_lines", "log_line_length", "distinct_lines", "byte_entropy", "stops_per_word")


def statistics(text: bytes | None) -> list[float]:
    """The ``STATISTICS`` of one whole text."""
    text = text or b""
    words = text.split()
    if not words:
        return [0.0] * len(STATISTICS)
    size, n = len(text), len(words)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    share = np.bincount(CLASS, weights=counts, minlength=7) / size
    used = counts[counts > 0] / size
    lengths = np.fromiter(map(len, words), np.float64, n)
    tally = Counter(words)
    rows = text.split(b"\n")
    return [np.log1p(n), min(lengths.mean(), 50.0), min(lengths.std(), 50.0), share[1], share[2], share[3], share[4],
            share[6], share[0], counts[33] / size, counts[124] / size, len(tally) / n, max(tally.values()) / n,
            sum(map(eq, words, words[1:])) / n, sum(map(bytes.isalpha, tally)) / len(tally), np.log1p(len(rows)),
            np.log1p(size / len(rows)), len(set(rows)) / len(rows), float(-(used * np.log2(used)).sum()),
            (counts[46] + counts[63] + counts[33]) / n]


def _matrix(texts: pa.Array) -> np.ndarray:
    return np.array([statistics(t) for t in texts.cast(pa.binary()).to_pylist()], np.float64).reshape(-1, len(STATISTICS))


def statistics_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, x)`` for every row."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, DOCS_AT_ONCE):
                part = batch.slice(at, DOCS_AT_ONCE)
                yield pa.record_batch([part.column(0), pa.array(list(_matrix(part.column(1))), pa.list_(pa.float64()))],
                                      names=["doc_id", "x"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, x array<double>")


class Model:
    """Scores statistics: standardise, random Fourier features, ridge weights, calibration."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray):
        rng = np.random.default_rng(SEED)
        self.mean, self.spread = mean, np.where(spread > 1e-9, spread, 1.0)
        d = len(mean)
        self.directions = rng.normal(size=(d, FEATURES)) / (WIDTH * np.sqrt(d))
        self.phases = rng.uniform(0, 2 * np.pi, FEATURES)
        self.weights = np.zeros(FEATURES + 1)
        self.trained = False
        self.knots = isotonic(np.zeros(0), np.zeros(0), np.zeros(0))

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -8, 8)
        z = np.sqrt(2 / FEATURES) * np.cos(z @ self.directions + self.phases)
        return np.hstack([z, np.ones((len(x), 1))])

    def score(self, x: np.ndarray) -> np.ndarray:
        return calibrated(self.features(x) @ self.weights, self.knots)


def _solve(sums: np.ndarray) -> np.ndarray:
    """Ridge weights from rows of [X'X | X'y]; the constant is not shrunk."""
    shrink = np.full(FEATURES + 1, RIDGE)
    shrink[-1] = 1e-6
    return np.linalg.solve(sums[:, :-1] + np.diag(shrink), sums[:, -1])


def _stack(column) -> np.ndarray:
    return np.stack(column.to_numpy(zero_copy_only=False))


def fit(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> Model:
    """Fit on the rows of ``stats(doc_id, x)`` that ``labels`` labels."""
    wanted = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
              .groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.max(label_col).cast("double").alias("y")))
    train = landed(stats.join(wanted, "doc_id").select(
        "x", "y", F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int").alias("fold")), "quality-train")
    d = len(STATISTICS)
    moments = train.agg(F.array(*[F.avg(F.col("x")[i]) for i in range(d)]).alias("m"),
                        F.array(*[F.stddev_pop(F.col("x")[i]) for i in range(d)]).alias("s"),
                        F.count(F.lit(1)).alias("n")).first()
    if not moments.n:
        return Model(np.zeros(d), np.ones(d))
    model = Model(np.array(moments.m), np.array(moments.s))
    model.trained = True

    def sums(batches):
        total = np.zeros((FOLDS, FEATURES + 1, FEATURES + 2))
        for batch in batches:
            x = model.features(_stack(batch.column("x")))
            xy = np.hstack([x, batch.column("y").to_numpy()[:, None]])
            fold = batch.column("fold").to_numpy()
            for k in range(FOLDS):
                total[k] += x[fold == k].T @ xy[fold == k]
        flat = total.reshape(-1, FEATURES + 2)
        yield pa.record_batch([pa.array(np.arange(len(flat))), pa.array(list(flat), pa.list_(pa.float64()))],
                              names=["i", "row"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:  # one row per partition of the training table
        return pd.DataFrame({"i": pdf.i[:1], "row": [np.sum(np.stack(pdf.row.to_numpy()), axis=0)]})

    kind = "i long, row array<double>"
    rows = train.mapInArrow(sums, kind).groupBy("i").applyInPandas(add, kind).collect()
    total = np.zeros((FOLDS * (FEATURES + 1), FEATURES + 2))
    for r in rows:
        total[r.i] = r.row
    total = total.reshape(FOLDS, FEATURES + 1, FEATURES + 2)
    everything = total.sum(axis=0)
    model.weights = _solve(everything)
    others = np.array([_solve(everything - total[k]) for k in range(FOLDS)])

    def held_back(batches):
        for batch in batches:
            raw = (model.features(_stack(batch.column("x"))) * others[batch.column("fold").to_numpy()]).sum(axis=1)
            yield pa.record_batch([pa.array(bin_of(raw)), batch.column("y")], names=["bin", "y"])

    bins = (train.mapInArrow(held_back, "bin long, y double").groupBy("bin")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("hits")).toPandas())
    model.knots = isotonic(bins["bin"].to_numpy(), bins["n"].to_numpy(float), bins["hits"].to_numpy(float))
    return model


def training_labels(labels: DataFrame, modulus: int = 4, remainder: int = 2) -> DataFrame:
    """The rows labels may be learnt from."""
    return labels.where(~is_held_out(F.col("doc_id"), modulus, remainder))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns over whole ``documents`` and ``labels`` tables."""
    stats = landed(statistics_table(docs, "doc_id", "text"), "quality-statistics")
    model = fit(stats, training_labels(labels))

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.record_batch([batch.column("doc_id"), pa.array(model.score(_stack(batch.column("x"))))],
                                      names=["doc_id", "score"])

    return stats.mapInArrow(run, "doc_id long, score double").select(
        "doc_id", is_held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score",
        (F.col("score") >= KEEP_AT).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, keep_at: float = KEEP_AT) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, all columns, without a shuffle of texts.

    Without training rows there is no classifier, and nothing is rejected.
    """
    model = fit(landed(statistics_table(docs, "doc_id", "text"), "quality-statistics"), training_labels(labels))
    if not model.trained:
        return docs
    place = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, DOCS_AT_ONCE):
                part = batch.slice(at, DOCS_AT_ONCE)
                yield part.filter(pa.array(model.score(_matrix(part.column(place))) >= keep_at))

    return docs.mapInArrow(run, docs.schema)
