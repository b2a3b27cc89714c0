import collections
import tracemalloc
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ferry.llm import mixing


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 60), min_size=1, max_size=12))
def test_cycle_stays_within_one_block_of_the_shares(weights):
    parts = {f"s{i}": w for i, w in enumerate(weights)}
    cycle, done = sum(parts.values()), defaultdict(int)
    for t, (s, j, release, deadline, slot) in enumerate(mixing.cycle_slots(parts), 1):
        assert slot == t - 1 and release <= slot < deadline and j == done[s]
        done[s] += 1
        for name, a in parts.items():
            assert abs(done[name] - t * a / cycle) < 1


def test_blocks_follow_the_weights_over_many_cycles():
    weights = {"a": 0.55, **{f"s{i}": 0.05 for i in range(9)}}
    assert mixing.exact_parts(weights) == {"a": 11, **{f"s{i}": 1 for i in range(9)}}
    odd = {"big": 0.5, **{f"s{i}": 0.5 / 299 for i in range(299)}}
    root = {f"s{i}": (i + 2) ** 0.5 for i in range(7)}
    for weights in (weights, odd, root):
        parts, total, done = mixing.exact_parts(weights), sum(weights.values()), defaultdict(int)
        blocks = {s: int(9000 * w / total) + 1 for s, w in weights.items()}
        cycle, rows = sum(parts.values()), list(mixing.cycle_slots(parts, blocks))
        turns = -(-9000 // cycle)
        for turn in range(turns):
            for s, _, release, deadline, slot in rows:
                t = turn * cycle + slot + 1
                if t <= 9000:
                    assert release <= slot < deadline
                    done[s] += 1
                    assert abs(done[s] - t * weights[s] / total) < 1 + 1e-6


def test_slots_follow_the_weights_in_the_table(llm_spark):
    docs = llm_spark.createDataFrame([(i, "x" * 100, "a" if i < 3300 else f"s{i % 9}") for i in range(6000)],
                                     "doc_id long, text string, source string")
    out = mixing.scheduled(docs, {"a": 0.55, **{f"s{i}": 0.05 for i in range(9)}}, block_chars=100).collect()
    assert len(out) == 6000
    assert abs(sum(r.source == "a" and r._slot < 4000 for r in out) - 2200) < 1


def test_every_row_is_placed_once_by_its_source_position(llm_spark, messy, rows):
    out = mixing.scheduled(messy, block_chars=500).select("doc_id", "source", "text", "_block", "_offset", "_slot", "_release", "_deadline").collect()
    assert sorted((r.doc_id, r.text) for r in out if r.doc_id is not None and r.text is not None) == \
        sorted((r[0], r[1]) for r in rows if r[0] is not None and r[1] is not None)
    assert len(out) == len(rows)
    at = defaultdict(list)
    for r in out:
        at[r.source].append((r._block * 500 + r._offset, max(1, len(r.text or ""))))
        assert r._release <= r._slot < r._deadline
    for places in at.values():  # each source is one stream without gaps or overlaps
        here = 0
        for place, size in sorted(places):
            assert place == here
            here += size
    slots = defaultdict(set)
    for r in out:
        slots[r._slot].add((r.source, r._block))
    assert all(len(x) == 1 for x in slots.values())


def test_stated_weights_and_order(llm_spark):
    docs = llm_spark.createDataFrame([(i, "x" * 100, "a" if i % 4 else None) for i in range(400)], "doc_id long, text string, source string")
    mixed = mixing.mixed(docs, {"a": 1.0, None: 1.0})
    assert mixed.columns == docs.columns
    per_slot = mixing.scheduled(docs, {"a": 1.0, None: 1.0}, block_chars=100).orderBy("_slot").select("source").collect()
    head = [r.source for r in per_slot][:100]
    assert abs(head.count("a") - 50) <= 1
    with pytest.raises(ValueError):
        mixing.scheduled(docs, {"a": 1.0})
    with pytest.raises(ValueError):
        mixing.exact_parts({"a": 0.0})


def test_the_schedule_is_written_in_batches(llm_spark, monkeypatch):
    parts, blocks = mixing.exact_parts({"a": 2 ** 0.5, "b": 1.0, "c": 3 ** 0.5}), {"a": 700, "b": 400, "c": 900}
    monkeypatch.setattr(mixing, "BATCH", 300)
    table = mixing.schedule_table(llm_spark, parts, blocks)
    assert sorted(map(tuple, table.collect())) == sorted(mixing.cycle_slots(parts, blocks))
    assert table.count() == 2000 and len(table.inputFiles()) == 7


def test_long_schedules_take_fixed_memory():
    parts = mixing.exact_parts({"a": 2 ** 0.5, "b": 1.0})
    tracemalloc.start()
    last = collections.deque(mixing.cycle_slots(parts, {"a": 117_000, "b": 82_000}), maxlen=1)[0]
    held = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert last[4] > 198_000 and held < 100_000


def test_rows_without_id_are_spread(llm_spark):
    docs = llm_spark.createDataFrame([(None if i % 3 else i, f"text {i}" * 9, "a") for i in range(3000)], "doc_id long, text string, source string")
    places = docs.select(F.xxhash64(mixing._place("doc_id", "text")).alias("h")).distinct().count()
    assert places == 3000
    out = mixing.scheduled(docs, block_chars=100).select((F.col("_block") * 100 + F.col("_offset")).alias("at"), F.length("text").alias("n")).collect()
    at = sorted((r.at, r.n) for r in out)
    assert all(a + n == b for (a, n), (b, _) in zip(at, at[1:]))


def test_empty_table_and_native_plan(messy, no_docs):
    assert mixing.digest(no_docs).collect() == []
    assert mixing.mixed(no_docs).collect() == []
    plan = mixing.digest(messy)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
