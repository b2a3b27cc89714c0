"""Toxicity by nearest labelled examples.

Terms are the words of a bounded sample of labelled rows (``MAX_EXAMPLES``, half
of them of the rarer label if there are so many): all of their words, so that a
text is compared by everything an example holds. Document
frequencies are counted over the whole corpus. A term's weight is its frequency in
the text, its inverse document frequency, and a factor for how far its presence
depends on the label; the factor never falls below ``FLOOR``, so no term is left out.

Examples are unit vectors in an inverted index; terms with long lists have, beside
them, the largest weight in each block of examples. A text's rare and telling terms
are added up first; what its other terms can add to a block at most follows from
the block maxima, so their lists are not read: only examples that can still be
among the k nearest are completed. The k nearest are exact. Votes weighted by nearness are
calibrated on the votes that each example gets from the others.

Defined results
    null text counts as empty; a text without a term of any example has no
    neighbours and gets the rate of such examples; null ids are scored and never
    examples; repeated labels rows count once (the larger label wins), of the
    texts of a repeated id the smallest is the example; no usable labels: every
    score is 0.0 without evidence; ties in cosine go to the smaller example id;
    empty table: empty result; extra columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.llm.calibration import bin_of, calibrated, isotonic
from ferry.llm.common import is_held_out, landed

MAX_EXAMPLES = 4_096    # labelled rows the classifier is fitted on
NEIGHBOURS = 15
BLOCK = 64
FLOOR = 0.03            # least factor for the label, beside at most 1
REST = 0.1              # what the terms that are not added up may add to a cosine
LONG = 8                # lists of more than a part in LONG of the examples are long
NEAR = 0.05             # added to a distance, so that an exact copy has a bounded vote
SHRINK = 0.25           # votes the base rate has
KEEP_AT = 0.7
WORD = re.compile(r"\w+")


def terms(text: str | None) -> Counter:
    """Occurrences of each word, in lower case."""
    return Counter(WORD.findall((text or "").lower()))


class BlockMaxIndex:
    """Unit vectors by term; terms with long lists also as rows of a table, with their largest weight in each block."""

    def __init__(self, row: np.ndarray, term: np.ndarray, weight: np.ndarray, ids: np.ndarray, labels: np.ndarray, terms: int):
        """``row``: the vector of each entry."""
        self.ids, self.labels, self.n = ids, labels, len(ids)
        by = np.argsort(term, kind="stable")
        self.term_from = np.searchsorted(term[by], np.arange(terms + 1))
        self.term_row, self.term_weight = row[by], weight[by]
        self.most = np.zeros(terms)
        np.maximum.at(self.most, term, weight)
        long = np.flatnonzero(np.diff(self.term_from) * LONG > self.n)
        self.long_of = np.full(terms, -1)
        self.long_of[long] = np.arange(len(long))
        blocks = max(1, -(-self.n // BLOCK))
        self.table = np.zeros((len(long), blocks * BLOCK))
        mine = np.flatnonzero(self.long_of[term] >= 0)
        self.table[self.long_of[term[mine]], row[mine]] = weight[mine]
        self.block_most = self.table.reshape(len(long), blocks, BLOCK).max(axis=2)

    def _sums(self, at: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Per vector, the sum over the terms ``at`` of their lists."""
        if not len(at):
            return np.zeros(self.n)
        parts = [slice(a, b) for a, b in zip(self.term_from[at].tolist(), self.term_from[at + 1].tolist())]
        rows = np.concatenate([self.term_row[p] for p in parts])
        return np.bincount(rows, np.concatenate([self.term_weight[p] for p in parts])
                           * np.repeat(weight, self.term_from[at + 1] - self.term_from[at]), self.n)

    def nearest(self, at: np.ndarray, weight: np.ndarray, k: int, without: int | None = None):
        """Positions and cosines of the k nearest vectors with a positive cosine, nearest first."""
        # Of the terms with long lists, those that can add least are left to the end, up to a sum of REST.
        long = self.long_of[at] >= 0
        most = np.where(long, weight * self.most[at], np.inf)
        by = np.argsort(most, kind="stable")
        last = np.zeros(len(at), bool)
        last[by[np.cumsum(most[by]) <= REST]] = True
        score = self._sums(at[~last], weight[~last])
        row, rest = self.long_of[at[last]], weight[last]
        bound = np.repeat(rest @ self.block_most[row], BLOCK)[:self.n]
        if without is not None:
            score[without] = -2.0
        least = max(np.partition(score, -k)[-k], 0.0) if self.n > k else 0.0
        rows = np.flatnonzero((score >= 0) & (score + bound >= least - 1e-9) & (score + bound > 0))
        exact = score[rows] + (rest @ self.table[row[:, None], rows] if len(row) else 0.0)
        rows, exact = rows[exact > 0], exact[exact > 0]
        top = np.lexsort((self.ids[rows], -np.round(exact, 12)))[:k]
        return rows[top], np.minimum(exact[top], 1.0)


class Examples:
    """The examples in a compact form (a term and its occurrences for each entry); workers build the index from it."""

    def __init__(self, row: np.ndarray, term: np.ndarray, n: np.ndarray, ids: np.ndarray, labels: np.ndarray, weight: np.ndarray):
        """``row``: the example of each entry, ascending; ``weight``: of each term."""
        self.row_from = np.searchsorted(row, np.arange(len(ids) + 1))
        self.term, self.n = term.astype(np.int32), n.astype(np.uint16 if n.max(initial=0) < 1 << 16 else np.uint32)
        self.ids, self.labels, self.weight, self._index = ids, labels, weight, None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_index": None}

    def vector(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        weight = (1 + np.log(n)) * self.weight[at]
        return weight / np.sqrt((weight ** 2).sum())

    def entries(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        part = slice(self.row_from[i], self.row_from[i + 1])
        return self.term[part].astype(np.int64), self.n[part].astype(float)

    @property
    def index(self) -> BlockMaxIndex:
        if self._index is None:
            row = np.repeat(np.arange(len(self.ids)), np.diff(self.row_from))
            weight = (1 + np.log(self.n.astype(float))) * self.weight[self.term]
            norm = np.sqrt(np.bincount(row, weight ** 2, len(self.ids)))
            self._index = BlockMaxIndex(row, self.term.astype(np.int64), weight / norm[row], self.ids, self.labels, len(self.weight))
        return self._index

    def vote(self, at: np.ndarray, n: np.ndarray, prior: float, without: int | None = None):
        rows, cosine = self.index.nearest(at, self.vector(at, n), NEIGHBOURS, without)
        near = 1 / (1 - cosine + NEAR)
        return (near @ self.labels[rows] + SHRINK * prior) / (near.sum() + SHRINK), rows, cosine


class Model:
    """What scores a text: the examples (one broadcast for fitting and scoring), base rates and calibration."""

    def __init__(self):
        self.examples, self.prior, self.bare, self.knots = None, 0.0, 0.0, None

    def score(self, at: np.ndarray, n: np.ndarray) -> tuple[float, list[tuple[int, float, int]]]:
        if self.examples is None or not len(at):
            return self.bare, []
        examples = self.examples.value
        raw, rows, cosine = examples.vote(at, n, self.prior)
        return float(calibrated(np.array([raw]), self.knots)[0]), \
            [(int(examples.ids[r]), float(c), int(examples.labels[r])) for r, c in zip(rows, cosine)]


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def _chosen(labels: DataFrame, id_col: str, label_col: str) -> tuple[DataFrame, dict[int, float]]:
    """At most ``MAX_EXAMPLES`` labelled ids, by hash within their label, and how many rows each stands for."""
    known = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
             .groupBy(F.col(id_col).cast("long").alias("_id")).agg((F.max(label_col) > 0).cast("int").alias("y")))
    there = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    half = MAX_EXAMPLES // 2
    taken = {y: min(n, max(half, MAX_EXAMPLES - there.get(1 - y, 0))) for y, n in there.items()}
    parts = [known.where(F.col("y") == y).orderBy(F.xxhash64("_id"), "_id").limit(n) for y, n in taken.items()]
    chosen = parts[0].unionAll(parts[1]) if len(parts) == 2 else parts[0] if parts else known.limit(0)
    return chosen, {y: there[y] / taken[y] for y in there}


def _counted(batches):
    """``(doc_id, y, terms, n)`` of the examples' texts."""
    for batch in batches:
        found = [terms(t) for t in batch.column("text").to_pylist()]
        yield pa.record_batch([batch.column("doc_id"), batch.column("y"), pa.array([list(f) for f in found], pa.list_(pa.string())),
                               pa.array([list(f.values()) for f in found], pa.list_(pa.int32()))],
                              names=["doc_id", "y", "terms", "n"])


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row of every element of a list column without nulls, and where rows begin."""
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.repeat(np.arange(len(sizes)), sizes), np.concatenate([[0], np.cumsum(sizes)])


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic") -> DataFrame:
    """``(doc_id, score, evidence)`` for every row of ``docs``; learns from all rows of ``labels`` given."""
    chosen, stands_for = _chosen(labels, id_col, label_col)
    texts = _texts(docs, id_col, text_col)
    # One text for each id, and at most MAX_EXAMPLES of them.
    sample = landed(texts.join(F.broadcast(chosen), texts.doc_id == chosen._id).groupBy("doc_id", "y")
                    .agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
                    .mapInArrow(_counted, "doc_id long, y int, terms array<string>, n array<int>"), "toxicity-examples")
    examples = sample.toArrow().combine_chunks().sort_by("doc_id")
    lists = examples.column("terms").combine_chunks()
    coded = lists.flatten().dictionary_encode()
    whole = {t: i for i, t in enumerate(coded.dictionary.to_pylist())}

    def count(batches):
        for batch in batches:
            at, n, sizes = [], [], []
            for text in batch.column("text").to_pylist():
                found = terms(text)
                common = found.keys() & whole.keys()
                at += map(whole.__getitem__, common)
                n += map(found.__getitem__, common)
                sizes.append(len(common))
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            yield pa.record_batch([batch.column("doc_id"), pa.ListArray.from_arrays(offsets, pa.array(at, pa.int32())),
                                   pa.ListArray.from_arrays(offsets, pa.array(n, pa.int32()))], names=["doc_id", "at", "n"])

    counts = landed(texts.mapInArrow(count, "doc_id long, at array<int>, n array<int>"), "toxicity-terms", compression="zstd")
    model = _model(counts, examples, coded.indices.to_numpy(zero_copy_only=False), len(coded.dictionary), stands_for)

    def run(batches):
        for batch in batches:
            _, edge = _flat(batch.column("at"))
            at, n = batch.column("at").flatten().to_numpy().astype(np.int64), batch.column("n").flatten().to_numpy().astype(float)
            found = [model.score(at[a:b], n[a:b]) for a, b in zip(edge[:-1], edge[1:])]
            proof = [[{"doc_id": d, "cosine": c, "label": y} for d, c, y in e] for _, e in found]
            kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("label", pa.int32())]))
            yield pa.record_batch([batch.column("doc_id"), pa.array([s for s, _ in found], pa.float64()),
                                   pa.array(proof, kind)], names=["doc_id", "score", "evidence"])

    return counts.mapInArrow(
        run, "doc_id long, score double, evidence array<struct<doc_id: long, cosine: double, label: int>>")


def document_frequencies(counts: DataFrame, terms_: int) -> tuple[np.ndarray, int]:
    """Rows of ``counts`` that hold each term, and all its rows (a number per term and task is shuffled)."""
    def run(batches):
        total, rows = np.zeros(terms_ + 1, np.int64), 0
        for batch in batches:
            total += np.bincount(batch.column("at").flatten().to_numpy(), minlength=terms_ + 1)
            rows += batch.num_rows
        total[terms_] = rows
        there = np.flatnonzero(total)
        yield pa.record_batch([pa.array(there), pa.array(total[there])], names=["t", "n"])

    got = counts.select("at").mapInArrow(run, "t long, n long").groupBy("t").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(terms_ + 1)
    out[got["t"].to_numpy(np.int64)] = got["n"]
    return out[:-1], int(out[-1])


def label_factor(row: np.ndarray, term: np.ndarray, y: np.ndarray, stands_for: np.ndarray, terms_: int) -> np.ndarray:
    """``FLOOR`` plus the correlation (0 to 1) of each term's presence with the label, by rows stood for."""
    n, hits = stands_for.sum(), (stands_for * y).sum()
    with_term = np.bincount(term, stands_for[row], terms_)
    both = np.bincount(term, (stands_for * y)[row], terms_)
    spread = np.sqrt(with_term * (n - with_term) * hits * (n - hits))
    return FLOOR + np.divide(np.abs(both * n - with_term * hits), spread, out=np.zeros(terms_), where=spread > 1e-9)


def _model(counts: DataFrame, examples: pa.Table, term: np.ndarray, terms_: int, stands_for: dict[int, float]) -> Model:
    df, total = document_frequencies(counts, terms_)
    model = Model()
    ids, y = examples.column("doc_id").to_numpy(), examples.column("y").to_numpy().astype(float)
    if not len(ids):
        return model
    each = np.array([stands_for[int(v)] for v in y])
    row, edge = _flat(examples.column("terms").combine_chunks())
    term, n = term.astype(np.int64), examples.column("n").combine_chunks().flatten().to_numpy().astype(float)
    # A term that every text holds keeps a small weight, so that a text of such terms has a direction.
    weights = np.maximum(np.log((1 + total) / (1 + df)), 0.01) * label_factor(row, term, y, each, terms_)
    model.prior = float((each * y).sum() / each.sum())
    empty = edge[1:] == edge[:-1]
    model.bare = float(((each * y)[empty].sum() + model.prior) / (each[empty].sum() + 1))
    if empty.all():
        return model
    # Examples with the same strongest term stand together: their block maxima are then tight.
    strongest = np.full(len(ids), terms_)
    by = np.lexsort(((1 + np.log(n)) * weights[term], row))
    strongest[row[by]] = term[by]  # the last, the largest, stays
    order = np.lexsort((ids, strongest))
    order = order[~empty[order]]
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(order))
    again = np.argsort(place[row], kind="stable")
    spark = counts.sparkSession
    model.examples = spark.sparkContext.broadcast(Examples(place[row][again], term[again], n[again], ids[order], y[order], weights))
    _calibrate(model, spark, each[order])
    return model


def _calibrate(model: Model, spark, each: np.ndarray) -> None:
    """Isotonic fit of the votes that every example gets from the others (examples spread over tasks)."""
    shared, prior = model.examples, model.prior

    def run(batches):
        examples = shared.value
        for batch in batches:
            raw = [examples.vote(*examples.entries(int(i)), prior, without=int(i))[0] for i in batch.column("id").to_numpy()]
            yield pa.record_batch([batch.column("id"), pa.array(raw, pa.float64())], names=["id", "raw"])

    labels = model.examples.value.labels
    got = spark.range(len(labels)).mapInArrow(run, "id long, raw double").toPandas()
    raw = np.zeros(len(labels))
    raw[got["id"]] = got["raw"]
    bins, where = np.unique(bin_of(raw), return_inverse=True)
    model.knots = isotonic(bins, np.bincount(where, each), np.bincount(where, each * labels), base=prior)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns, plus the evidence."""
    known = labels.where(~is_held_out(F.col("doc_id"), 3, 1))
    out = toxicity(docs, known)
    return out.select("doc_id", is_held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score",
                      (F.col("score") >= KEEP_AT).cast("int").alias("predicted"), "evidence")
