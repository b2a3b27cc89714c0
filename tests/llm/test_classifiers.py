import math
import random
from collections import Counter

import numpy as np
import pytest
from messy import words

from ferry.llm import calibration, quality, toxicity

TABLES = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(llm_spark):
    docs = llm_spark.read.parquet(f"{TABLES}/documents.parquet")
    labels = llm_spark.read.parquet(f"{TABLES}/labels.parquet")
    return docs, labels, {r.doc_id: r for r in labels.collect()}


def auc(scores, labels):
    hit, miss = scores[labels == 1], scores[labels == 0]
    return (hit[:, None] > miss[None]).mean() + (hit[:, None] == miss[None]).mean() / 2


def test_quality_on_held_out_rows(tables):
    docs, labels, known = tables
    rows = quality.digest(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in known]
    scores, truth = np.array([r.score for r in held]), np.array([known[r.doc_id].quality for r in held])
    assert len(held) > 50 and auc(scores, truth) > 0.97
    assert np.mean((scores >= 0.7) == truth) > 0.95


def test_labels_of_held_out_rows_change_nothing(tables):
    docs, labels, _ = tables
    some = docs.limit(120)
    from pyspark.sql import functions as F
    lie = labels.withColumn("quality", F.when(quality.is_held_out(F.col("doc_id"), 4, 2), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert sorted(map(tuple, quality.digest(some, labels).collect())) == sorted(map(tuple, quality.digest(some, lie).collect()))
    lie = labels.withColumn("toxic", F.when(toxicity.is_held_out(F.col("doc_id"), 3, 1), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (sorted(map(str, toxicity.digest(some, x).collect())) for x in (labels, lie))
    assert one == two


def test_toxicity_on_held_out_rows(tables):
    docs, labels, known = tables
    rows = toxicity.digest(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in known]
    predicted, truth = np.array([r.predicted for r in held]), np.array([known[r.doc_id].toxic for r in held])
    assert not (predicted & (1 - truth)).any()          # clean documents are left alone
    assert (predicted & truth).sum() >= 0.6 * truth.sum()  # few labelled rows per language at this size
    proof = next(r for r in held if r.predicted)
    assert all(not toxicity_held(e.doc_id) for e in proof.evidence)


def toxicity_held(doc_id):
    import zlib
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


@pytest.fixture(scope="module")
def plain_labels(llm_spark):
    rows = [(100 + i, int(i % 5 > 0), int(i % 6 == 0)) for i in range(60)] + [(100, 1, 0), (None, 1, 1), (101, None, None), (500, 0, 0)]
    return llm_spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_messy_tables(messy, rows, no_docs, plain_labels, llm_spark):
    no_labels = plain_labels.limit(0)
    for op in (quality, toxicity):
        assert op.digest(no_docs, plain_labels).collect() == []
        got = op.digest(messy, plain_labels).collect()
        assert len(got) == len(rows) and all(r.score is not None and r.held_out is not None for r in got)
        got = op.digest(messy, no_labels).collect()
        assert len(got) == len(rows) and len({r.score for r in got}) == 1
    assert {r.predicted for r in quality.digest(messy, no_labels).collect()} == {0}
    kept = quality.keep_good(messy, plain_labels)
    assert kept.columns == messy.columns and kept.count() <= len(rows)


def test_nothing_is_rejected_without_training_rows(messy, rows, plain_labels):
    from pyspark.sql import functions as F
    held_out = plain_labels.where(quality.is_held_out(F.col("doc_id"), 4, 2))
    assert held_out.count() > 0
    for labels in (plain_labels.limit(0), held_out, plain_labels.withColumn("quality", F.lit(None).cast("int"))):
        kept = quality.keep_good(messy, labels)
        assert kept.columns == messy.columns and kept.count() == len(rows)


def test_statistics_of_odd_texts():
    assert quality.statistics(None) == quality.statistics(b"") == quality.statistics(b" \n") == [0.0] * len(quality.STATISTICS)
    for text in ("###", "\n\n|", "a" * 100_000, "é ü", "x\n" * 5000):
        assert np.isfinite(quality.statistics(text.encode())).all()


def test_normal_equations_against_one_matrix(llm_spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, len(quality.STATISTICS)))
    y = (x[:, 0] ** 2 + x[:, 3] > 0.8).astype(int)
    stats = llm_spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "doc_id long, x array<double>").repartition(5)
    labels = llm_spark.createDataFrame([(i, int(v)) for i, v in enumerate(y)], "doc_id long, quality int")
    model = quality.fit(stats, labels)
    f = model.features(x)
    shrink = np.diag(np.r_[np.full(quality.FEATURES, quality.RIDGE), 1e-6])
    assert np.allclose(model.weights, np.linalg.solve(f.T @ f + shrink, f.T @ y))
    gauss = np.exp(-0.5 * (((x[:50, None] - x[None, :50]) / model.spread) ** 2).sum(axis=2) / (x.shape[1] * quality.WIDTH ** 2))
    near = f[:50, :-1] @ f[:50, :-1].T
    assert np.abs(near - gauss).max() < 0.35 and np.abs(near - gauss).mean() < 0.07


def test_isotonic_fit_against_all_averages():
    rng = random.Random(4)
    for _ in range(30):
        bins = np.array(sorted(rng.sample(range(calibration.BINS), 12)))
        n = np.array([rng.randint(1, 9) for _ in bins], float)
        hits = np.array([rng.uniform(0, x) for x in n])
        raw, fit = calibration.isotonic(bins, n, hits)
        centres = calibration.LOW + (bins + 0.5) / calibration.BINS * (calibration.HIGH - calibration.LOW)
        # min-max formula of isotonic regression
        mean = lambda a, b: hits[a:b + 1].sum() / n[a:b + 1].sum()
        exact = [max(min(mean(a, b) for b in range(i, 12)) for a in range(i + 1)) for i in range(12)]
        assert (np.diff(fit) > 0).all()
        for c, e in zip(centres, exact):
            assert min(abs(fit - e)) < 1e-9
        assert min(raw) >= calibration.LOW and max(raw) <= calibration.HIGH


def test_block_max_index_is_exact():
    rng = np.random.default_rng(2)
    terms = 40
    for share in (0.1, 0.7):
        dense = np.where(rng.random((300, terms)) < share, rng.random((300, terms)) ** 4, 0)
        dense = dense[dense.any(axis=1)]
        dense[5] = dense[6] = dense[7]  # ties
        dense /= np.linalg.norm(dense, axis=1, keepdims=True)
        ids = rng.permutation(len(dense)) + 10
        row, term = np.nonzero(dense)
        index = toxicity.BlockMaxIndex(row, term, dense[row, term], ids, np.zeros(len(dense)), terms)
        for i, q in enumerate(dense[:120]):
            without = i if i % 2 else None
            rows, cosine = index.nearest(np.flatnonzero(q), q[q > 0], 15, without)
            exact = dense @ q
            order = [j for j in np.lexsort((ids, -np.round(exact, 12))) if exact[j] > 0 and j != without][:15]
            assert index.ids[rows].tolist() == ids[order].tolist()
            assert np.allclose(cosine, np.minimum(exact[order], 1))


def brute_toxicity(rows, labels):
    """Scores and evidence of all rows by dense vectors; ``labels``: (doc_id, toxic) rows that may be learnt from."""
    known = {}
    for d, y in labels:
        if d is not None and y is not None:
            known[d] = max(known.get(d, 0), y)
    texts = {}
    for d, text, *_ in rows:
        if d in known:
            texts[d] = min(texts.get(d, text or ""), text or "")
    vectors = {d: toxicity.terms(t) for d, t in texts.items()}
    vocabulary = sorted(set(t for v in vectors.values() for t in v))
    counted = [{t: n for t, n in toxicity.terms(r[1]).items() if t in set(vocabulary)} for r in rows] if vocabulary else [{} for _ in rows]
    df = Counter(t for c in counted for t in c)
    ids = sorted(vectors)
    y = np.array([known[d] for d in ids], float)
    n, hits = len(ids), y.sum()
    weight = {}
    for t in vocabulary:
        has = np.array([t in vectors[d] for d in ids], float)
        spread = math.sqrt(has.sum() * (n - has.sum()) * hits * (n - hits))
        phi = abs((has * y).sum() * n - has.sum() * hits) / spread if spread > 1e-9 else 0
        weight[t] = max(math.log((1 + len(rows)) / (1 + df[t])), 0.01) * (toxicity.FLOOR + phi)

    def unit(c):
        v = np.array([(1 + math.log(c[t])) * weight[t] if t in c else 0.0 for t in vocabulary])
        return v / np.linalg.norm(v)

    full = [i for i, d in enumerate(ids) if vectors[d]]
    dense = np.array([unit(vectors[ids[i]]) for i in full])
    prior = y.mean()
    empty = [i for i in range(n) if i not in full]
    bare = (y[empty].sum() + prior) / (len(empty) + 1)

    def vote(v, without=None):
        cos = np.minimum(dense @ v, 1)
        order = sorted((-round(cos[j], 12), ids[i], cos[j], y[i]) for j, i in enumerate(full) if cos[j] > 0 and j != without)[:15]
        near = np.array([1 / (1 - o[2] + toxicity.NEAR) for o in order])
        raw = (near @ np.array([o[3] for o in order]) + toxicity.SHRINK * prior) / (near.sum() + toxicity.SHRINK)
        return raw, [(o[1], o[2], o[3]) for o in order]

    raw = np.array([vote(dense[j], j)[0] for j in range(len(full))])
    bins, where = np.unique(calibration.bin_of(raw), return_inverse=True)
    knots = calibration.isotonic(bins, np.bincount(where).astype(float), np.bincount(where, y[full]), base=prior)
    out = []
    for r, c in zip(rows, counted):
        if not c:
            out.append((r[0], bare, []))
        else:
            raw, proof = vote(unit(c))
            out.append((r[0], float(calibration.calibrated(np.array([raw]), knots)[0]), proof))
    return out


def test_whole_toxicity_query_against_brute_force(messy, rows, plain_labels):
    labels = [(r.doc_id, r.toxic) for r in plain_labels.collect() if r.doc_id is None or not toxicity_held(r.doc_id)]
    want = brute_toxicity(rows, labels)
    got = toxicity.digest(messy, plain_labels).collect()
    key = lambda d, s, e: (d is not None, d or 0, round(s, 9), [(x[0], round(x[1], 9)) for x in e])
    assert sorted(key(r.doc_id, r.score, [(e.doc_id, e.cosine) for e in r.evidence]) for r in got) == sorted(key(*w) for w in want)
    assert sum(bool(r.evidence) for r in got) > 60


def test_copies_of_labelled_texts_have_them_as_evidence(llm_spark):
    """Rare wording counts as well: an unlabelled exact copy finds its example, at a cosine of 1."""
    rng = random.Random(8)
    prose = lambda: " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(7)) for _ in range(40))
    texts = [prose() for _ in range(90)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1000 + i, t) for i, t in enumerate(texts)]
    docs = llm_spark.createDataFrame(rows, "doc_id long, text string")
    labels = llm_spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(90)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    for i in range(90):
        first = got[1000 + i].evidence[0]
        assert (first.doc_id, first.label) == (i, int(i % 3 == 0)) and abs(first.cosine - 1) < 1e-9


def test_examples_are_bounded_and_stand_for_their_rows(llm_spark, monkeypatch):
    monkeypatch.setattr(toxicity, "MAX_EXAMPLES", 20)
    for toxic in (4, 60):
        labels = llm_spark.createDataFrame([(i, int(i < toxic)) for i in range(100)], "doc_id long, toxic int")
        chosen, stands_for = toxicity._chosen(labels, "doc_id", "toxic")
        taken = Counter(r.y for r in chosen.collect())
        assert taken == ({1: 4, 0: 16} if toxic == 4 else {1: 10, 0: 10})
        assert {y: round(stands_for[y] * n) for y, n in taken.items()} == {1: toxic, 0: 100 - toxic}


def test_terms_are_words():
    assert toxicity.terms("Idiots idiot, IDIOT \u00e9t\u00e9 12 a") == {"idiots": 1, "idiot": 2, "\u00e9t\u00e9": 1, "12": 1, "a": 1}
    assert toxicity.terms(None) == {} and words(None) == []
