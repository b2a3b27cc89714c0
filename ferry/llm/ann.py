"""Nearest neighbours by inner product with an inverted multi-index.

Each half of a vector has its own codebook; a cell is a pair of centroids. A
query visits cells in the order of the summed inner products of its halves with
the two centroids, taken lazily from a heap, until the cells seen hold its
budget of rows; their rows are reranked exactly in double precision.

The budget is measured, not guessed: a few queries are answered by brute force
in one pass over the rows, and the budget is where the stated share of their
true neighbours has been visited.

Codebooks come from a bounded sample (``SAMPLE`` rows); every row is indexed.
Rows stand in buckets of about ``BUCKET`` rows: runs of small cells, or parts of
a large one, so a cell with a third of all rows is many buckets. Queries go in
blocks of ``QUERY_BLOCK`` to the buckets they visit. Of equal vectors only the
k + 1 with the smallest ids can be in any answer (ties go to smaller ids); the
others are searched for but not found, which keeps results whole.

Defined results
    null, zero, non-finite vectors, vectors of another than the usual size and
    null ids take no part; of several vectors under one id the smallest counts;
    fewer than k candidates: all of them; no queries or no vectors: empty
    result; extra columns are not read.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferry.llm.common import landed
from ferry.llm.vectors import as_doubles, lists, matrix, products

SAMPLE = 16_384
MAX_CENTROIDS = 256
ROWS_PER_CELL = 12
ROUNDS = 12
AUDIT = 96
VISITED = 0.97      # share of the audited queries' true neighbours that lie in visited cells
BUCKET = 4_096
QUERY_BLOCK = 4_096
SEED = 11


def codebook(points: np.ndarray, n: int) -> np.ndarray:
    """``n`` centroids by Lloyd's rounds from distinct sampled points (fewer where there are fewer)."""
    rng = np.random.default_rng(SEED)
    points = np.unique(points, axis=0)
    centres = points[rng.permutation(len(points))[:n]]
    for _ in range(ROUNDS):
        near = nearest_centre(points, centres)
        rows = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        centres = np.where(rows[:, None] > 0, sums / np.maximum(rows, 1)[:, None], centres)
    return centres


def nearest_centre(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres ** 2).sum(axis=1) - 2 * points @ centres.T, axis=1)


class MultiIndex:
    """The two codebooks and the number of rows in each cell."""

    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.first, self.second, self.half = first, second, first.shape[1]
        self.rows = np.zeros(len(first) * len(second), np.int64)

    def cells(self, x: np.ndarray) -> np.ndarray:
        return (nearest_centre(x[:, :self.half], self.first) * len(self.second)
                + nearest_centre(x[:, self.half:], self.second))

    def visit(self, query: np.ndarray, budget: int):
        """Non-empty cells in descending order of the summed products, until they hold ``budget`` rows."""
        a, b = self.first @ query[:self.half], self.second @ query[self.half:]
        by_a, by_b = np.argsort(-a, kind="stable").tolist(), np.argsort(-b, kind="stable").tolist()
        a, b, width = (-a).tolist(), (-b).tolist(), len(by_b)
        # Each pair enters once: from its left neighbour, or from above in the first column.
        heap, seen = [(a[by_a[0]] + b[by_b[0]], 0, 0)], 0
        rows = self.rows
        while heap and seen < budget:
            _, i, j = heapq.heappop(heap)
            if j + 1 < width:
                heapq.heappush(heap, (a[by_a[i]] + b[by_b[j + 1]], i, j + 1))
            if j == 0 and i + 1 < len(by_a):
                heapq.heappush(heap, (a[by_a[i + 1]] + b[by_b[0]], i + 1, 0))
            cell = by_a[i] * width + by_b[j]
            if rows[cell]:
                seen += int(rows[cell])
                yield cell


def _sampled(rows: DataFrame, n: int) -> DataFrame:
    return rows.orderBy(F.xxhash64("id"), "id").limit(n)


def train(rows: DataFrame, total: int) -> MultiIndex:
    sample = matrix_of(_sampled(rows, SAMPLE).toPandas().v)
    half = max(1, sample.shape[1] // 2)
    n = int(min(MAX_CENTROIDS, max(2, 2 ** round(math.log2(max(1.0, math.sqrt(total / ROWS_PER_CELL)))))))
    second = sample[:, half:] if sample.shape[1] > half else np.zeros((len(sample), 1))
    return MultiIndex(codebook(sample[:, :half], n), codebook(second, n))


def matrix_of(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()) if len(column) else np.zeros((0, 0))


def _padded(x: np.ndarray) -> np.ndarray:
    """A single component has an empty second half; a zero stands in for it."""
    return x if x.shape[1] > 1 else np.hstack([x, np.zeros((len(x), 1))])


def _best(query_ids, queries, ids, rows, scores, k: int) -> list[tuple]:
    """Exact top k of each query among the rows with a finite (approximate) score."""
    out = []
    for q in range(len(query_ids)):
        row = scores[q]
        there = np.flatnonzero(row > -np.inf)
        if len(there) > k:
            least = np.partition(row[there], len(there) - k)[len(there) - k]
            there = there[row[there] >= least - 1e-9 * max(1.0, abs(least))]  # rounding may not cut off a tie
        if len(there):
            exact = products(rows[there], queries[q])
            top = np.lexsort((ids[there], -exact))[:k]
            out.append((np.full(len(top), query_ids[q]), ids[there][top], exact[top]))
    return out


def _frame(found: list[tuple]) -> pd.DataFrame:
    if not found:
        return pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
    return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), map(np.concatenate, zip(*found)))))


RESULT = "query_id long, vec_id long, score double"


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def brute_force(rows: DataFrame, query_ids: np.ndarray, queries: np.ndarray, k: int) -> DataFrame:
    """Exact answers of a bounded set of queries in one pass over ``rows(id, v)``."""
    def run(batches):
        for batch in batches:
            ids, x = batch.column("id").to_numpy(), matrix(batch.column("v"))
            if len(ids):
                scores = queries @ x.T
                scores[query_ids[:, None] == ids[None, :]] = -np.inf
                yield pa.RecordBatch.from_pandas(_frame(_best(query_ids, queries, ids, x, scores, k)), preserve_index=False)

    return _top(rows.select("id", "v").mapInArrow(run, RESULT), k)


def measured_budget(index: MultiIndex, rows: DataFrame, asked: DataFrame, k: int) -> int:
    """Rows a query must visit so that ``VISITED`` of the audited true neighbours are among them."""
    audit = _sampled(asked, AUDIT).toPandas()
    queries = matrix_of(audit.v)
    truth = brute_force(rows, audit.id.to_numpy(), queries, k).toPandas()
    cells = rows.join(F.broadcast(rows.sparkSession.createDataFrame(truth[["vec_id"]].drop_duplicates())),
                      F.col("id") == F.col("vec_id")).select("id", "cell").toPandas()
    cell_of = dict(zip(cells.id, cells.cell))
    needed = []
    for q, query in zip(audit.id, queries):
        before, seen = {}, 0
        for cell in index.visit(_padded(query[None])[0], int(index.rows.sum())):
            seen += int(index.rows[cell])
            before[cell] = seen
        needed += [before[cell_of[v]] for v in truth.vec_id[truth.query_id == q]]
    return int(np.quantile(needed, VISITED, method="higher")) if needed else 0


def search(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding",
           k: int = 20) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row where ``is_query`` (over ``id_col``) its k nearest others."""
    spark = vectors.sparkSession
    named = vectors.withColumn("_ask", F.coalesce(is_query, F.lit(False)))
    asked_ids = named.where("_ask").select(F.col(id_col).cast("long").alias("id")).distinct()
    points = landed(as_doubles(vectors, id_col, vec_col).groupBy("id").agg(F.min("v").alias("v")), "ann-vectors")
    copies = Window.partitionBy("v").orderBy("id")
    findable = points.withColumn("n", F.row_number().over(copies)).where(F.col("n") <= k + 1).select("id", "v")
    total = points.count()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not total:
        return empty
    index = train(points, total)

    def place(batches):
        for batch in batches:
            x = _padded(matrix(batch.column("v")))
            if len(x):
                yield pa.record_batch([batch.column("id"), batch.column("v"), pa.array(index.cells(x))],
                                      names=["id", "v", "cell"])

    rows = landed(findable.mapInArrow(place, "id long, v array<double>, cell long"), "ann-index")
    for r in rows.groupBy("cell").count().collect():  # at most MAX_CENTROIDS ** 2 numbers
        index.rows[r.cell] = r["count"]
    asked = landed(points.join(asked_ids, "id"), "ann-queries")
    n_queries = asked.count()
    if not n_queries:
        return empty
    budget = max(measured_budget(index, rows, asked, k), 32 * k)

    # Buckets: runs of cells up to BUCKET rows, larger cells in parts.
    parts = np.maximum(1, -(-index.rows // BUCKET))
    first, at, held = np.zeros(len(index.rows), np.int64), 0, 0
    for cell, n in enumerate(index.rows.tolist()):
        if held and held + n > BUCKET:
            at, held = at + 1, 0
        first[cell], held = at, held + n
        if parts[cell] > 1:
            at, held = at + int(parts[cell]), 0
    query_blocks = -(-n_queries // QUERY_BLOCK)

    def deal(batches):
        for batch in batches:
            ids, cells = batch.column("id").to_numpy(), batch.column("cell").to_numpy()
            bucket = first[cells] + (ids * 0x9E3779B1 >> 7) % parts[cells]
            yield pa.record_batch([*batch.columns, pa.array(bucket)], names=["id", "v", "cell", "bucket"])

    dealt = rows.mapInArrow(deal, "id long, v array<double>, cell long, bucket long").withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))

    def probe(batches):
        for batch in batches:
            x = matrix(batch.column("v"))
            for i, q in enumerate(batch.column("id").to_pylist()):
                to: dict[int, list[int]] = {}
                for cell in index.visit(_padded(x[i:i + 1])[0], budget):
                    for part in range(parts[cell]):
                        to.setdefault(int(first[cell]) + part, []).append(cell)
                n = len(to)
                yield pa.record_batch([pa.array([q] * n, pa.int64()), lists(np.repeat(x[i:i + 1], n, axis=0)),
                                       pa.array(list(to), pa.int64()), pa.array(list(to.values()), pa.list_(pa.int64()))],
                                      names=["id", "v", "bucket", "cells"])

    probes = (asked.repartition("id").mapInArrow(probe, "id long, v array<double>, bucket long, cells array<long>")
              .withColumn("block", F.pmod(F.hash("id"), F.lit(query_blocks))))

    def rerank(rows: pd.DataFrame, probes: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or probes.empty:
            return _frame([])
        order = np.argsort(rows.cell.to_numpy(), kind="stable")
        ids, x, cells = rows.id.to_numpy()[order], matrix_of(rows.v)[order], rows.cell.to_numpy()[order]
        found = []
        for begin in range(0, len(probes), 512):
            some = probes.iloc[begin:begin + 512]
            query_ids, queries = some.id.to_numpy(), matrix_of(some.v)
            wanted = np.concatenate(some.cells.to_numpy())
            by = np.repeat(np.arange(len(some)), some.cells.map(len))
            order_w = np.argsort(wanted, kind="stable")
            wanted, by = wanted[order_w], by[order_w]
            scores = np.full((len(some), len(ids)), -np.inf)
            for cell in np.unique(wanted):
                who = by[np.searchsorted(wanted, cell):np.searchsorted(wanted, cell, "right")]
                lo, hi = np.searchsorted(cells, cell), np.searchsorted(cells, cell, "right")
                if hi > lo:
                    scores[who, lo:hi] = queries[who] @ x[lo:hi].T
            scores[query_ids[:, None] == ids[None, :]] = -np.inf
            found += _best(query_ids, queries, ids, x, scores, k)
        return _frame(found)

    found = dealt.groupBy("bucket", "block").cogroup(probes.groupBy("bucket", "block")).applyInPandas(rerank, RESULT)
    return _top(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def digest(embeddings: DataFrame) -> DataFrame:
    return search(embeddings, F.col("vec_id") % 20 == 0)
