"""Embedding near-dedup by NN-descent.

Equal vectors are one node. A first neighbour graph comes from random-hyperplane
leaves (every leaf's best pairs); then rounds of neighbours-of-neighbours joins
refine it: the neighbours of a node, forward and reverse, are compared with each
other, and each keeps its best ``LIST``. Rounds end when few lists change and an
audit - sampled nodes against all rows - finds the links there. The number of
trees grows with their depth, so that two vectors at the threshold share a leaf
as often in a large table as in a small one; crowded leaves are cut by further
planes. The audit widens until it has seen ``AUDIT_LINKED`` nodes with links (or
``AUDIT_MOST`` nodes). While it misses links, trees and rounds are added; if it
still finds less than ``RECALL`` of them after ``PASSES``, the lists are made
exactly: rows in balls with a centre and a radius, all pairs of balls that could
hold a link compared. That takes time, but always ends with whole lists.

Edges at the threshold are links. A list full of links is saturated: it may
have more than it holds, and what it lacks may lead out of the component found.
Saturated nodes of different components are therefore searched against each
other, in balls with a centre and a radius: two balls are compared row by row
unless their angles rule a link out, and a link found joins their components.
Then the lists are enlarged to their whole component, whose rows are compared
block by block; only counts leave a block, never its pairs. At last the audited
links, those of saturated nodes too, must lie within one component each, or the
search is repeated from exact lists.

No group is one task's work: leaves, reverse lists and components are cut into
parts of bounded size by a hash of the id.

Defined results
    vectors that are null, zero, non-finite or not of the usual size link with
    nothing (no links, their own component, kept); rows with a null id: no links,
    null component, not kept; several rows of one id: its smallest vector takes
    part and all rows get its result; empty table: empty result; extra columns
    are not read.
"""

from __future__ import annotations

import logging
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ferry.llm.common import landed
from ferry.llm.components import components
from ferry.llm.vectors import as_doubles, matrix

LIST = 8
TREES = 12          # at least
MISS = 0.035        # share of pairs at the threshold that no tree may hold in one leaf
MORE = 16           # further planes for crowded leaves
LEAF = 128
PART = 32           # reverse neighbours joined at once
BLOCK = 1_024       # rows of a component compared at once
AUDIT = 128         # nodes audited at first
AUDIT_LINKED = 64
AUDIT_MOST = 8_192
MAX_ROUNDS = 8
PASSES = 4
RECALL = 0.99
SETTLED = 0.05      # share of list entries that may still change
SLACK = 1e-5        # lists are in single precision; links are verified in double
SEED = 5
LOG = logging.getLogger(__name__)
EDGE = "u long, v long, sim float"


def _unit(x: np.ndarray) -> np.ndarray:
    return (x / np.sqrt((x * x).sum(axis=1, keepdims=True))).astype(np.float32)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All cosines between rows of ``a`` and of ``b`` in double precision."""
    return (a @ b.T) / (np.sqrt((a * a).sum(axis=1))[:, None] * np.sqrt((b * b).sum(axis=1))[None, :])


def _best_pairs(ids: np.ndarray, x: np.ndarray, k: int, least: np.ndarray | None = None) -> list[np.ndarray]:
    """(u, v, sim): for each row its ``k`` nearest other rows, above its ``least`` where given."""
    sims = x @ x.T
    np.fill_diagonal(sims, -2)
    k = min(k, len(ids) - 1)
    if k < 1:
        return [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32)]
    top = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    best = np.take_along_axis(sims, top, axis=1)
    keep = best > (-2 if least is None else least[:, None])
    return [np.repeat(ids, k)[keep.ravel()], ids[top.ravel()][keep.ravel()], best.ravel()[keep.ravel()]]


def _trimmed(edges: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of each list; one shuffle, by the list's node."""
    one = edges.repartition("u").groupBy("u", "v").agg(F.max("sim").alias("sim"), F.min("age").alias("age"))
    order = Window.partitionBy("u").orderBy(F.desc("sim"), "v")
    return one.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def _split(counts: DataFrame, size: int) -> DataFrame:
    return counts.withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("n") / size)).cast("int"))


def tree_count(bits: int, threshold: float) -> int:
    """Trees of ``bits`` planes after which a pair at ``threshold`` has shared a leaf, but for ``MISS``."""
    together = (1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi) ** bits
    return TREES if together >= 1 else max(TREES, math.ceil(math.log(MISS) / math.log1p(-max(together, 1e-4))))


def first_lists(nodes: DataFrame, total: int, size: int, threshold: float, turn: int = 0) -> DataFrame:
    """Best pairs of the leaves of random-hyperplane trees; other trees in each ``turn``."""
    bits = min(46, max(0, math.ceil(math.log2(max(1, total / LEAF)))))
    trees = tree_count(bits, threshold)
    planes = np.random.default_rng(SEED + turn).normal(size=(trees, bits + MORE, size)).astype(np.float32)

    def leaves(batches):
        weights = np.left_shift(np.int64(1), np.arange(bits + MORE, dtype=np.int64))
        for batch in batches:
            x = matrix(batch.column("x"), size)
            for tree in range(trees):
                code = ((x @ planes[tree].T > 0) @ weights).astype(np.int64)
                yield pa.record_batch([pa.array(np.full(len(x), tree)), pa.array(code & ((1 << bits) - 1)), pa.array(code >> bits),
                                       batch.column("id"), batch.column("x")], names=["tree", "leaf", "more", "id", "x"])

    rows = nodes.select("id", "x").mapInArrow(leaves, "tree long, leaf long, more long, id long, x array<float>")
    # Crowded leaves take as many further planes as would halve them to size; what these cannot part is cut by a hash.
    crowded = landed(rows.groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 2 * LEAF)
                     .select("tree", "leaf", F.least(F.lit(MORE), F.ceil(F.log2(F.col("n") / LEAF))).cast("int").alias("extra")),
                     "nn-crowded")
    rows = (rows.join(crowded, ["tree", "leaf"], "left")
            .withColumn("more", F.expr("more & (shiftleft(1L, coalesce(extra, 0)) - 1)")).drop("extra"))
    sizes = landed(_split(rows.groupBy("tree", "leaf", "more").agg(F.count(F.lit(1)).alias("n")), LEAF), "nn-leaves")
    dealt = rows.join(sizes, ["tree", "leaf", "more"]).withColumn("part", F.pmod(F.xxhash64("id", "tree"), F.col("parts")))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        u, v, sim = _best_pairs(pdf.id.to_numpy(), np.stack(pdf.x.to_numpy()), LIST)
        return pd.DataFrame({"u": u, "v": v, "sim": sim})

    return dealt.groupBy("tree", "leaf", "more", "part").applyInPandas(compare, EDGE)


def _refined(lists: DataFrame, nodes: DataFrame) -> DataFrame:
    """Candidate edges: pairs among the neighbours of each node that beat the worse end's list."""
    reverse = landed(_split(lists.groupBy(F.col("v").alias("c")).agg(F.count(F.lit(1)).alias("n")), PART), "nn-reverse")
    back = (lists.select(F.col("v").alias("c"), F.col("u").alias("m"), "age").join(reverse, "c")
            .select("c", F.pmod(F.xxhash64("m"), F.col("parts")).alias("part"), "m", "age"))
    forth = (lists.select(F.col("u").alias("c"), F.col("v").alias("m"), "age").join(reverse, "c", "left")
             .select("c", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("parts"), F.lit(1)).cast("long") - 1)).alias("part"),
                     "m", "age"))
    # A node's own list ends: candidates must beat its last entry.
    last = lists.groupBy(F.col("u").alias("m")).agg(F.min("sim").alias("least"), F.count(F.lit(1)).alias("n")).select(
        "m", F.when(F.col("n") >= LIST, F.col("least")).otherwise(F.lit(-2.0)).cast("float").alias("least"))
    known = nodes.select(F.col("id").alias("m"), "x").join(last, "m", "left").fillna({"least": -2.0})
    members = forth.unionAll(back).join(known, "m")

    def pairs(batches):
        held: list[pa.RecordBatch] = []

        def local(batch):
            c, part = batch.column("c").to_numpy(), batch.column("part").to_numpy()
            ids, x, least, age = (batch.column("m").to_numpy(), matrix(batch.column("x")), batch.column("least").to_numpy(),
                                  batch.column("age").to_numpy())
            edges = np.flatnonzero(np.r_[True, (c[1:] != c[:-1]) | (part[1:] != part[:-1]), True])
            out: list[list[np.ndarray]] = []
            for lo, hi in zip(edges[:-1], edges[1:]):
                if hi - lo > 1 and (age[lo:hi] == 0).any():  # something here has not been compared yet
                    some, at = np.unique(ids[lo:hi], return_index=True)
                    if len(some) > 1:
                        out.append(_best_pairs(some, x[lo:hi][at], LIST, least[lo:hi][at]))
            u, v, sim = map(np.concatenate, zip(*out)) if out else (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.float32),)
            return pa.record_batch([pa.array(u), pa.array(v), pa.array(sim.astype(np.float32))], names=["u", "v", "sim"])

        for batch in batches:  # sorted by (c, part): keep the last group back until it is whole
            held.append(batch)
            c, part = batch.column("c").to_numpy(), batch.column("part").to_numpy()
            cuts = np.flatnonzero((c[1:] != c[:-1]) | (part[1:] != part[:-1]))
            if len(cuts):
                cut = int(cuts[-1]) + 1
                whole = pa.Table.from_batches([*held[:-1], batch.slice(0, cut)]).combine_chunks().to_batches()[0]
                held = [batch.slice(cut)]
                yield local(whole)
        if held and (rest := pa.Table.from_batches(held).combine_chunks().to_batches()):
            yield local(rest[0])

    return (members.select("c", "part", "m", "x", "least", "age").repartition("c", "part")
            .sortWithinPartitions("c", "part").mapInArrow(pairs, EDGE))


def neighbour_lists(nodes: DataFrame, total: int, size: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """``(u, v, sim, place)`` after as many rounds as it takes, and the audit's links ``(u, v)``."""
    zero, one = F.lit(0).alias("age"), F.lit(1).alias("age")
    lists = landed(_trimmed(first_lists(nodes, total, size, threshold).select("u", "v", "sim", zero), LIST), "nn-lists")
    truth = landed(audited(nodes, threshold, total), "nn-audit")
    for n in range(PASSES * MAX_ROUNDS):
        found = _refined(lists, nodes).select("u", "v", "sim", F.lit(2).alias("age"))
        if n and n % MAX_ROUNDS == 0:
            found = found.unionAll(first_lists(nodes, total, size, threshold, n // MAX_ROUNDS).select(
                "u", "v", "sim", F.lit(2).alias("age")))
        # Ages: 0 new, 1 compared before; a pair found again stays old (the smaller of 1 and 2), a new one comes in as 2.
        merged = lists.select("u", "v", "sim", one).unionAll(found)
        lists = landed(_trimmed(merged, LIST).withColumn("age", F.when(F.col("age") == 2, 0).otherwise(1)), "nn-lists")
        changed = lists.where("age = 0").count()
        full = lists.groupBy("u").agg(F.count(F.lit(1)).alias("n"), F.min("sim").alias("least")).where(
            (F.col("n") >= LIST) & (F.col("least") >= threshold - SLACK)).select("u")
        # Other links of saturated nodes come when balls are compared and lists enlarged; near_duplicates audits them.
        asked = truth.join(full, "u", "left_anti")
        missing = (asked.join(lists.select("u", "v"), ["u", "v"], "left_anti")
                   .join(lists.select(F.col("v").alias("u"), F.col("u").alias("v")), ["u", "v"], "left_anti").count())
        if changed <= SETTLED * LIST * total and not missing:
            break
    links = asked.count()
    recall = 1 - missing / links if links else 1.0
    LOG.info("audit: %d of %d links missing after %d rounds, recall %.4f", missing, links, n + 1, recall)
    if recall < RECALL:
        return exact_lists(nodes, total, size, threshold), truth
    # The audit's links help, except those between saturated nodes: what finds these is to be audited.
    helped = truth.join(full, "u", "left_anti").unionAll(
        truth.join(full, "u").join(full.withColumnRenamed("u", "v"), "v", "left_anti").select("u", "v"))
    return lists.select("u", "v", "sim", "place").unionAll(
        helped.select("u", "v", F.lit(1.0).cast("float").alias("sim"), F.lit(0).alias("place"))), truth


def audited(nodes: DataFrame, threshold: float, total: int) -> DataFrame:
    """All links ``(u, v)`` of sampled nodes, by brute force: at least ``AUDIT``, more until enough of them have links."""
    most, size = min(total, AUDIT_MOST), AUDIT
    while True:
        out = landed(_links_of(nodes, min(size, most), threshold), "nn-audited")
        if size >= most or out.select("u").distinct().count() >= AUDIT_LINKED:
            return out
        size *= 8


def _links_of(nodes: DataFrame, size: int, threshold: float) -> DataFrame:
    sample = nodes.orderBy(F.xxhash64("id"), "id").limit(size).select("id", "v").toPandas()
    ids, vectors = sample.id.to_numpy(), np.stack(sample.v.to_numpy())

    def run(batches):
        for batch in batches:
            other, x = batch.column("id").to_numpy(), matrix(batch.column("v"))
            for at in range(0, len(ids), 512):
                some = ids[at:at + 512]
                near = cosines(vectors[at:at + 512], x) >= threshold if len(x) else np.zeros((len(some), 0), bool)
                near &= some[:, None] != other[None, :]
                a, b = np.nonzero(near)
                yield pa.record_batch([pa.array(some[a]), pa.array(other[b])], names=["u", "v"])

    return nodes.select("id", "v").mapInArrow(run, "u long, v long")


def _near_balls(nodes: DataFrame, members: DataFrame, threshold: float, within: bool) -> DataFrame:
    """``(p, q, ball, id, v)``: the rows of every two balls of ``members(id, component)`` that could hold a link.

    Balls of one component (and a ball with itself) count only if ``within``.
    """
    sizes = landed(_split(members.groupBy("component").agg(F.count(F.lit(1)).alias("n")), BLOCK), "nn-groups")
    rows = landed(members.join(sizes, "component").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
                  .join(nodes.select("id", "v"), "id").select("component", "part", "id", "v"), "nn-saturated-rows")

    def ball(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(pdf.v.to_numpy())
        x = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
        centre = x.mean(axis=0)
        size = np.sqrt((centre * centre).sum())
        centre = centre / size if size > 1e-9 else x[0]
        radius = float(np.arccos(np.clip(x @ centre, -1, 1)).max())
        return pd.DataFrame({"component": pdf.component[:1], "part": pdf.part[:1], "ball": [pdf.id.min()],
                             "centre": [centre], "radius": [radius]})

    balls = landed(rows.groupBy("component", "part").applyInPandas(
        ball, "component long, part long, ball long, centre array<double>, radius double"), "nn-balls")
    blocks = max(1, math.ceil(balls.count() / BLOCK))
    dealt = (balls.withColumn("own", F.pmod(F.xxhash64("ball"), F.lit(blocks)).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
             .select(F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "component",
                     "ball", "centre", "radius"))
    reach = math.acos(max(-1.0, min(1.0, threshold))) + 1e-6

    def reachable(pdf: pd.DataFrame) -> pd.DataFrame:
        i, j = pdf.i.iloc[0], pdf.j.iloc[0]
        left, right = pdf[pdf.own == i], pdf[pdf.own == j]
        if left.empty or right.empty:
            return pd.DataFrame({"p": np.zeros(0, np.int64), "q": np.zeros(0, np.int64)})
        angle = np.arccos(np.clip(np.stack(left.centre.to_numpy()) @ np.stack(right.centre.to_numpy()).T, -1, 1))
        near = angle <= left.radius.to_numpy()[:, None] + right.radius.to_numpy()[None, :] + reach
        p, q = left.ball.to_numpy(), right.ball.to_numpy()
        if not within:
            near &= left.component.to_numpy()[:, None] != right.component.to_numpy()[None, :]
        if i == j:
            near &= p[:, None] <= q[None, :]
        a, b = np.nonzero(near)
        return pd.DataFrame({"p": p[a], "q": q[b]})

    pairs = landed(dealt.groupBy("i", "j").applyInPandas(reachable, "p long, q long"), "nn-ball-pairs")
    held = rows.join(balls.select("component", "part", "ball"), ["component", "part"]).select("ball", "id", "v")
    return pairs.select("p", "q", F.explode(F.array_distinct(F.array("p", "q"))).alias("ball")).join(held, "ball")


def _across(nodes: DataFrame, members: DataFrame, threshold: float) -> DataFrame:
    """``(a, b)``: a link for every two balls of ``members(id, component)`` of different components that have one."""
    sides = _near_balls(nodes, members, threshold, within=False)

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        left, right = pdf[pdf.ball == pdf.p.iloc[0]], pdf[pdf.ball == pdf.q.iloc[0]]
        near = cosines(np.stack(left.v.to_numpy()), np.stack(right.v.to_numpy())) >= threshold
        a, b = (x[:1] for x in np.nonzero(near))  # each component is whole, so one link joins them
        return pd.DataFrame({"a": left.id.to_numpy()[a], "b": right.id.to_numpy()[b]})

    return sides.groupBy("p", "q").applyInPandas(compare, "a long, b long")


def exact_lists(nodes: DataFrame, total: int, size: int, threshold: float) -> DataFrame:
    """``(u, v, sim, place)`` with the best ``LIST`` links of every node, none missing: balls of the leaves of one
    tree, compared unless their angles rule a link out."""
    bits = min(62, max(0, math.ceil(math.log2(max(1, total / BLOCK)))))
    planes = np.random.default_rng(SEED).normal(size=(bits, size))

    def leaf(batches):
        weights = np.left_shift(np.int64(1), np.arange(bits, dtype=np.int64))
        for batch in batches:
            code = ((matrix(batch.column("v"), size) @ planes.T > 0) @ weights).astype(np.int64)
            yield pa.record_batch([batch.column("id"), pa.array(code)], names=["id", "component"])

    members = nodes.select("id", "v").mapInArrow(leaf, "id long, component long")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        left, right = pdf[pdf.ball == pdf.p.iloc[0]], pdf[pdf.ball == pdf.q.iloc[0]]
        sims = cosines(np.stack(left.v.to_numpy()), np.stack(right.v.to_numpy()))
        sims[left.id.to_numpy()[:, None] == right.id.to_numpy()[None, :]] = -2
        out = [_best_of(left.id.to_numpy(), right.id.to_numpy(), sims, threshold - SLACK)]
        if pdf.p.iloc[0] != pdf.q.iloc[0]:
            out.append(_best_of(right.id.to_numpy(), left.id.to_numpy(), sims.T, threshold - SLACK))
        return pd.concat(out)

    found = _near_balls(nodes, members, threshold, within=True).groupBy("p", "q").applyInPandas(compare, EDGE)
    return landed(_trimmed(found.withColumn("age", F.lit(0)), LIST).select("u", "v", "sim", "place"), "nn-exact")


def _best_of(ids: np.ndarray, others: np.ndarray, sims: np.ndarray, least: float) -> pd.DataFrame:
    """(u, v, sim): for each of ``ids`` its ``LIST`` nearest ``others`` of at least ``least``."""
    k = min(LIST, len(others))
    top = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    best = np.take_along_axis(sims, top, axis=1)
    keep = best >= least
    return pd.DataFrame({"u": np.repeat(ids, k)[keep.ravel()], "v": others[top[keep]], "sim": best[keep].astype(np.float32)})


def _enlarged(nodes: DataFrame, members: DataFrame, threshold: float) -> DataFrame:
    """``(id, n)``: links (weighted by copies) of the nodes of ``members(id, component)`` within their component."""
    sizes = landed(_split(members.groupBy("component").agg(F.count(F.lit(1)).alias("n")), BLOCK), "nn-components")
    rows = (members.join(sizes, "component").join(nodes.select("id", "v", "copies"), "id")
            .withColumn("own", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .select("component", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "id",
                    "v", "copies"))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        left = pdf[pdf.own == pdf.i.iloc[0]]
        right = pdf[pdf.own == pdf.j.iloc[0]]
        if left.empty or right.empty:
            return pd.DataFrame({"id": np.zeros(0, np.int64), "n": np.zeros(0, np.int64)})
        near = cosines(np.stack(left.v.to_numpy()), np.stack(right.v.to_numpy())) >= threshold
        near &= left.id.to_numpy()[:, None] != right.id.to_numpy()[None, :]
        out = [pd.DataFrame({"id": left.id, "n": near @ right.copies.to_numpy()})]
        if pdf.i.iloc[0] != pdf.j.iloc[0]:
            out.append(pd.DataFrame({"id": right.id, "n": near.T @ left.copies.to_numpy()}))
        return pd.concat(out)

    return (rows.groupBy("component", "i", "j").applyInPandas(compare, "id long, n long")
            .groupBy("id").agg(F.sum("n").alias("n")))


def _verified(ends: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """``(a, b, ca, cb)``: the pairs of ``ends(a, b)`` at the threshold in double precision, with their copies."""
    dot = lambda p, q: F.aggregate(F.zip_with(p, q, lambda s, t: s * t), F.lit(0.0), lambda s, t: s + t)
    cosine = dot(F.col("va"), F.col("vb")) / (F.sqrt(dot(F.col("va"), F.col("va"))) * F.sqrt(dot(F.col("vb"), F.col("vb"))))
    return (ends.join(nodes.select(F.col("id").alias("a"), F.col("v").alias("va"), F.col("copies").alias("ca")), "a")
            .join(nodes.select(F.col("id").alias("b"), F.col("v").alias("vb"), F.col("copies").alias("cb")), "b")
            .where(cosine >= threshold).select("a", "b", "ca", "cb"))


def linked(nodes: DataFrame, lists: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The verified links ``(a, b, ca, cb)``, the components ``(id, component)`` and the saturated nodes ``(id, component)``."""
    ends = lists.where(F.col("sim") >= threshold - SLACK).select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct()
    links = landed(_verified(ends, nodes, threshold), "nn-links")
    found = landed(components(links, "a", "b").select(F.col("node").alias("id"), "component"), "nn-found")

    # Links between saturated nodes of different components stand in no list.
    full = landed(lists.where((F.col("place") == LIST) & (F.col("sim") >= threshold - SLACK))
                  .select(F.col("u").alias("id")).join(found, "id"), "nn-full")
    if full.select("component").distinct().limit(2).count() == 2:
        bridges = landed(_across(nodes, full, threshold), "nn-bridges")
        if not bridges.isEmpty():
            found = landed(components(links.select("a", "b").unionAll(bridges), "a", "b")
                           .select(F.col("node").alias("id"), "component"), "nn-found")
    return links, found, full


def _apart(nodes: DataFrame, truth: DataFrame, found: DataFrame, threshold: float) -> int:
    """Audited links whose ends are not in one component."""
    at = lambda end: found.select(F.col("id").alias(end), F.col("component").alias(f"c{end}"))
    out = (truth.join(at("u"), "u", "left").join(at("v"), "v", "left")
           .where(~F.col("cu").eqNullSafe(F.col("cv")) | F.col("cu").isNull()))
    return _verified(out.select(F.col("u").alias("a"), F.col("v").alias("b")), nodes, threshold).count()


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                    threshold: float = 0.9) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row of ``vectors``."""
    usable = as_doubles(vectors, id_col, vec_col).groupBy("id").agg(F.min("v").alias("v"))
    points = landed(usable, "nn-vectors")

    def single(batches):
        for batch in batches:
            x = _unit(matrix(batch.column("v"))) if batch.num_rows else np.zeros((0, 1), np.float32)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.reshape(-1)))
            yield pa.record_batch([*batch.columns, flat], names=["id", "copies", "v", "x"])

    nodes = landed(points.groupBy("v").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"))
                   .select("id", "copies", "v").mapInArrow(single, "id long, copies long, v array<double>, x array<float>"),
                   "nn-nodes")
    total = nodes.count()
    ids = vectors.select(F.col(id_col).cast("long").alias("vec_id"))
    if not total:
        return ids.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                          F.col("vec_id").isNotNull().alias("kept"))
    size = len(nodes.first().v)
    lists, truth = neighbour_lists(nodes, total, size, threshold)
    links, found, full = linked(nodes, landed(lists, "nn-graph"), threshold)
    if apart := _apart(nodes, truth, found, threshold):
        LOG.info("%d audited links lead out of the component found", apart)
        links, found, full = linked(nodes, exact_lists(nodes, total, size, threshold), threshold)

    # Components with a saturated list are counted whole, the others from their links.
    saturated = landed(full.select("id").join(found, "id").select("component").distinct(), "nn-saturated")
    counted = links.select(F.col("a").alias("id"), F.col("cb").alias("n")).unionAll(
        links.select(F.col("b").alias("id"), F.col("ca").alias("n"))).groupBy("id").agg(F.sum("n").alias("n"))
    dense = _enlarged(nodes, found.join(saturated, "component", "left_semi"), threshold)
    plain = counted.join(found.join(saturated, "component", "left_anti").select("id"), "id", "left_semi")
    degree = dense.unionAll(plain)

    per_node = (nodes.join(found, "id", "left").join(degree, "id", "left")
                .select("v", F.coalesce("component", "id").alias("component"),
                        (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n")))
    per_id = points.join(per_node, "v").select(F.col("id").alias("vec_id"), "component", "n")
    return ids.join(per_id, "vec_id", "left").select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component", "vec_id"), F.lit(False)).alias("kept"))


def digest(embeddings: DataFrame) -> DataFrame:
    return near_duplicates(embeddings)


# Exact where the neighbour lists miss no link; on the test tables they miss none.
ORACLE = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
      ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
r AS (SELECT vec_id, vec_id AS reached FROM embeddings
      UNION SELECT r.vec_id, l.b FROM r JOIN l ON l.a = r.reached),
c AS (SELECT vec_id, min(reached) AS component_id FROM r GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM l GROUP BY a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM c LEFT JOIN n USING (vec_id)
"""
