import numpy as np
import pytest
from pyspark.sql import functions as F

from ferry.llm import ann, neighbours

SCHEMA = "vec_id long, embedding array<float>, label int"


def made(seed=1, n=700, d=16):
    """Tight groups from two to 150, exact copies, scaled copies, noise, ties and unusable vectors."""
    rng = np.random.default_rng(seed)
    rows = []
    for size in (150, 40, 9, 5, 2, 2, 2):
        centre = rng.normal(size=d)
        rows += [centre + rng.normal(size=d) * 0.12 for _ in range(size)]
    rows += [rng.normal(size=d) for _ in range(n - len(rows))]
    rows += [rows[3]] * 60 + [rows[-1] * 2, rows[-2] * 3]
    rows = [np.asarray(r, np.float32).tolist() for r in rows]
    ids = rng.permutation(len(rows) * 2)[:len(rows)]
    out = [(int(i), r, 0) for i, r in zip(ids, rows)]
    top = 2 * len(rows)
    odd = [None, [0.0] * d, [float("nan")] + [1.0] * (d - 1), [float("inf")] * d, [None] + [1.0] * (d - 1), [1.0, 2.0], []]
    out += [(top + 20 * i, v, 1) for i, v in enumerate(odd)]
    out += [(None, rows[0], 1), out[0], out[0]]
    return out


@pytest.fixture(scope="module")
def vectors(llm_spark):
    return llm_spark.createDataFrame(made(), SCHEMA).repartition(4).withColumns({c: F.lit("x") for c in ("id", "v", "n", "x", "cell", "copies")})


def usable(rows):
    out = {}
    for i, v, _ in rows:
        if i is not None and v and len(v) == 16 and all(x is not None and np.isfinite(x) for x in v) and any(v):
            out[i] = np.array(v, float)
    return out


def test_near_duplicates_against_all_pairs(vectors):
    rows = made()
    points = usable(rows)
    ids = sorted(points)
    x = np.stack([points[i] for i in ids])
    near = neighbours.cosines(x, x) >= 0.9
    np.fill_diagonal(near, False)
    component = list(range(len(ids)))
    changed = True
    while changed:
        best = [min([component[i], *(component[j] for j in np.flatnonzero(near[i]))]) for i in range(len(ids))]
        changed, component = best != component, best
    want = {i: (int(near[n].sum()), ids[component[n]]) for n, i in enumerate(ids)}
    got = neighbours.digest(vectors).collect()
    assert sorted(str(r.vec_id) for r in got) == sorted(str(r[0]) for r in rows)
    for r in got:
        n, c = want.get(r.vec_id, (0, r.vec_id))
        assert (r.n_links, r.component_id, r.kept) == (n, c, r.vec_id is not None and r.vec_id == c), r
    assert max(n for n, _ in want.values()) > 100


def all_pairs(points, threshold=0.9):
    """id -> (links, smallest id reachable), by all pairs."""
    ids = sorted(points)
    x = np.stack([points[i] for i in ids])
    near = neighbours.cosines(x, x) >= threshold
    np.fill_diagonal(near, False)
    component, changed = np.arange(len(ids)), True
    while changed:
        best = np.minimum(component, np.where(near, component[None, :], len(ids)).min(axis=1))
        changed, component = (best != component).any(), best
    return {i: (int(near[n].sum()), ids[component[n]]) for n, i in enumerate(ids)}


@pytest.mark.parametrize("broken", ["trees", "lists"])
def test_exact_lists_where_the_search_fails(llm_spark, monkeypatch, broken):
    """Without trees the audit finds nothing; with empty lists handed on, its links lead out of the components."""
    rows = made(seed=4, n=400)
    if broken == "trees":
        monkeypatch.setattr(neighbours, "MAX_ROUNDS", 1)
        monkeypatch.setattr(neighbours, "first_lists", lambda nodes, *_: nodes.select(
            F.col("id").alias("u"), F.col("id").alias("v"), F.lit(0.0).cast("float").alias("sim")).limit(0))
    else:
        monkeypatch.setattr(neighbours, "neighbour_lists", lambda nodes, total, size, threshold: (
            llm_spark.createDataFrame([], "u long, v long, sim float, place int"), neighbours.audited(nodes, threshold, total)))
    monkeypatch.setattr(neighbours, "BLOCK", 64)
    asked, exact = [], neighbours.exact_lists
    monkeypatch.setattr(neighbours, "exact_lists", lambda *a: asked.append(1) or exact(*a))
    got = neighbours.digest(llm_spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    want = all_pairs(usable(rows))
    assert asked == [1]
    assert {r.vec_id: (r.n_links, r.component_id) for r in got if r.vec_id in want} == want


def test_tight_groups_linked_to_each_other(llm_spark):
    """Lists full of a group's own members hide the links between two groups (0.99 within, 0.92 between)."""
    rng = np.random.default_rng(8)
    unit = lambda x: x / np.linalg.norm(x)
    rows = []
    for _ in range(80):
        a, o = unit(rng.normal(size=64)), unit(rng.normal(size=64))
        for centre in (a, unit(0.93 * a + (1 - 0.93 ** 2) ** 0.5 * unit(o - (o @ a) * a))):
            rows += [(len(rows) + i, (centre + 0.1 * unit(rng.normal(size=64))).astype(np.float32).tolist(), 0) for i in range(10)]
    want = all_pairs({i: np.array(v, float) for i, v, _ in rows})
    assert len({c for _, c in want.values()}) == 80
    got = neighbours.digest(llm_spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want


def test_trees_grow_with_their_depth():
    together = 1 - np.arccos(0.9) / np.pi
    for bits in (0, 9, 17, 20):
        assert 1 - (1 - together ** bits) ** neighbours.tree_count(bits, 0.9) >= 0.96


def test_audit_sees_linked_nodes_where_few_have_links(llm_spark):
    x = np.random.default_rng(4).normal(size=(4000, 32))
    x[:50] = x[50:100] * 1.01 + 0.01
    nodes = llm_spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    assert len({r.u for r in neighbours.audited(nodes, 0.9, 4000).collect()}) >= 64


def test_search_against_brute_force(vectors):
    points = usable(made())
    ids = np.array(sorted(points))
    x = np.stack([points[i] for i in ids])
    got = ann.digest(vectors).orderBy("query_id", "rank").collect()
    found, total = 0, 0
    for q in ids[ids % 20 == 0]:
        scores = (x * points[q]).sum(axis=1)
        order = [i for i in np.lexsort((ids, -scores)) if ids[i] != q][:20]
        mine = [r for r in got if r.query_id == q]
        assert [r.rank for r in mine] == list(range(1, 21))
        assert [(-r.score, r.vec_id) for r in mine] == sorted((-r.score, r.vec_id) for r in mine)
        for r in mine:
            assert r.score == scores[np.searchsorted(ids, r.vec_id)]
        found += len({r.vec_id for r in mine} & set(ids[order].tolist()))
        total += 20
    assert {r.query_id for r in got} == set(ids[ids % 20 == 0].tolist())
    assert found / total >= 0.9


def test_few_candidates_and_empty_tables(llm_spark):
    few = llm_spark.createDataFrame([(20, [1.0, 0.0], 0), (1, [0.5, 0.5], 0), (2, [0.5, 0.5], 0), (3, [-1.0, 0.0], 0)], SCHEMA)
    assert [tuple(r) for r in ann.digest(few).orderBy("rank").collect()] == [(20, 1, 1, 0.5), (20, 2, 2, 0.5), (20, 3, 3, -1.0)]
    assert [tuple(r) for r in neighbours.digest(few).orderBy("vec_id").collect()] == \
        [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True), (20, 0, 20, True)]
    none = llm_spark.createDataFrame([], SCHEMA)
    assert ann.digest(none).collect() == [] and neighbours.digest(none).collect() == []
    unusable = llm_spark.createDataFrame([(20, None, 0), (None, None, 0)], SCHEMA)
    assert ann.digest(unusable).collect() == []
    assert sorted(map(tuple, neighbours.digest(unusable).collect()), key=str) == [(20, 0, 20, True), (None, 0, None, False)]
    single = llm_spark.createDataFrame([(0, [2.0], 0), (7, [3.0], 0)], SCHEMA)
    assert [tuple(r) for r in ann.digest(single).collect()] == [(0, 1, 7, 6.0)]


def test_cells_are_visited_in_order_of_summed_products():
    rng = np.random.default_rng(3)
    index = ann.MultiIndex(rng.normal(size=(9, 4)), rng.normal(size=(7, 4)))
    index.rows[:] = rng.integers(0, 3, 63)
    q = rng.normal(size=8)
    sums = (index.first @ q[:4])[:, None] + (index.second @ q[4:])[None, :]
    order = [int(c) for c in np.argsort(-sums.ravel(), kind="stable") if index.rows[c]]
    assert list(index.visit(q, 10 ** 9)) == order
    some = list(index.visit(q, 10))
    assert some == order[:len(some)] and index.rows[some].sum() >= 10 > index.rows[some[:-1]].sum()
