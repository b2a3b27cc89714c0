import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ferry.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(n=420, dims=6, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        v = [round(rng.uniform(-1, 1) * 4) / 4 for _ in range(dims)] if i % 3 else [rng.gauss(0, 0.4) for _ in range(dims)]
        rows.append((i, [float(np.float32(x)) for x in v], rng.choice([0, 1, 2, 9])))
    rows[100] = (100, rows[104][1], rows[104][2])                      # a tie with another row
    rows += [(500, rows[9][1], 1), (500, rows[9][1], 1), (500, rows[10][1], 2)]     # a repeated anchor, and another of its id
    rows += [(503, rows[11][1], 2)] * 4                                # repeated rows
    rows += [(600, None, 1), (601, rows[1][1], None), (None, rows[2][1], 1), (700, [0.0] * dims, 0)]
    rows += [(602, [math.nan] + [0.0] * (dims - 1), 1), (603, [None] + [1.0] * (dims - 1), 1), (604, [math.inf] * dims, 1)]
    rows += [(800, [1.0], 1), (900, [], 1)]
    rng.shuffle(rows)
    return rows


def brute(rows, positives=5, negatives_=5, dims=6):
    own = []
    for i, v, label in rows:
        if i is None or v is None or label is None or len(v) != dims or any(x is None or not math.isfinite(x) for x in v):
            continue
        own.append((i, (label + 1) % 10 if i % 7 == 0 else label, tuple(math.floor(256 * x) for x in v)))
    out = []
    for a, label, q in sorted(set(x for x in own if x[0] % 100 == 0)):
        scored = [(-sum(x * y for x, y in zip(q, r)), i, other) for i, other, r in own if i != a]
        good = sorted((s, i) for s, i, other in scored if other == label)[:positives]
        bad = sorted((s, i) for s, i, other in scored if other != label)
        for place, (p, pid) in enumerate(good, 1):
            found = [(s, i) for s, i in bad if 80 * -p <= 100 * -s <= 100 * -p][:negatives_]
            out += [(a, pid, place, rank, i, -p, -s) for rank, (s, i) in enumerate(found, 1)]
    return sorted(out)


@pytest.mark.parametrize("wave", [16_384, 2])
def test_against_brute_force(llm_spark, wave):
    rows = table()
    df = llm_spark.createDataFrame(rows, SCHEMA).repartition(7).withColumn("slot", F.lit("clash")).withColumn("q", F.lit(1))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = negatives.hard_negatives(negatives.quantised(df, "vec_id", "embedding", label), F.col("id") % 100 == 0, wave=wave)
    want = brute(rows)
    assert sorted(map(tuple, got.collect())) == want
    assert len(want) > 60 and len({r[0] for r in want}) >= 5
    if wave > 2:
        assert sorted(map(tuple, negatives.digest(df).collect())) == want


def test_empty_tables_and_tables_without_anchors(llm_spark):
    assert negatives.digest(llm_spark.createDataFrame([], SCHEMA)).collect() == []
    assert negatives.digest(llm_spark.createDataFrame([(1, [1.0], 1), (2, [0.5], 2)], SCHEMA)).collect() == []
    assert negatives.digest(llm_spark.createDataFrame([(100, [], 1), (200, [], 2)], SCHEMA)).collect() == []


def test_scores_that_do_not_fit_are_refused(llm_spark):
    df = llm_spark.createDataFrame([(100, [1e30], 1), (200, [1.0], 1)], SCHEMA)
    with pytest.raises(ValueError):
        negatives.digest(df)


@pytest.mark.parametrize("dims, top", [(64, 256), (3, 2 ** 28), (200, 2 ** 20), (1, 0), (500, 7)])
def test_residue_products_are_exact(dims, top):
    rng = np.random.default_rng(1)
    a, b = rng.integers(-top, top + 1, (30, dims)), rng.integers(-top, top + 1, (20, dims))
    a[0], b[0], b[1] = top, -top, top
    got = negatives.Scores(b, dims * top * top)(a, slice(0, 20))
    want = [[sum(int(x) * int(y) for x, y in zip(r, c)) for c in b] for r in a]
    assert (got == np.array(want, object)).all()
    assert all(p < 1024 and all(p % q for q in range(2, p)) for p in negatives.PRIMES)


def test_best_keeps_ties_by_id_whatever_the_order():
    rng = np.random.default_rng(2)
    scores, ids = rng.integers(0, 4, (200, 3)), rng.permutation(200)
    allowed = rng.random((200, 3)) < 0.7
    best = negatives.Best(3, 5)
    for at in range(0, 200, 17):
        best.offer(0, scores[at:at + 17], allowed[at:at + 17], ids[at:at + 17])
    for slot in range(3):
        want = sorted((-scores[r, slot], ids[r]) for r in range(200) if allowed[r, slot])[:5]
        mine = best.slot == slot
        assert list(zip(-best.score[mine], best.id[mine])) == want
