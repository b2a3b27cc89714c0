"""The pipeline: its classifier's decisions are taken as given, every later stage is held against brute force."""

import hashlib
from collections import defaultdict

import pytest
from messy import words

import corpus_pipeline
from ferry.llm import mixing, packing, quality
from test_lines import brute as brute_lines
from test_lines import lines_kept
from test_packing import plain_best_fit
from test_simhash import expected as simhash_expected


@pytest.fixture(scope="module")
def folder(tmp_path_factory, llm_spark, messy):
    path = str(tmp_path_factory.mktemp("corpus"))
    messy.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{path}/documents.parquet")
    rows = [(100 + i, int(i % 5 > 0), 0) for i in range(60)]
    llm_spark.createDataFrame(rows, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stage_by_stage(llm_spark, folder):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = llm_spark.read.parquet(f"{folder}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "line dedup", "simhash near-dedup", "mixing sources", "best-fit packing"]
    read = lambda df: sorted(map(tuple, df.collect()), key=str)

    scored = quality.digest(docs, llm_spark.read.parquet(f"{folder}/labels.parquet"))
    first = corpus_pipeline.quality_classifier(llm_spark, docs, folder)
    assert first.columns == columns
    good = defaultdict(list)
    for r in scored.collect():
        good[r.doc_id].append(r.predicted)
    rows = [tuple(r) for r in docs.collect()]
    sure = [r for r in rows if len(set(good[r[0]])) == 1]
    kept = read(first)
    assert sorted(str(r) for r in sure if good[r[0]][0]) == sorted(str(r) for r in kept if len(set(good[r[0]])) == 1)

    second = corpus_pipeline.line_dedup(llm_spark, llm_spark.createDataFrame(kept, docs.schema), folder)
    assert second.columns == columns
    got = read(second)
    want = brute_lines(kept)
    assert sorted(hashlib.sha256(r[1].encode()).hexdigest() for r in got) == sorted(r[3] for r in want)
    assert got == sorted(((r[0], t, r[2], r[3], len(t)) for r, t in zip(kept, lines_kept(kept))), key=str)

    third = corpus_pipeline.simhash_near_dedup(llm_spark, llm_spark.createDataFrame(got, docs.schema), folder)
    assert third.columns == columns
    left = read(third)
    decided = simhash_expected(got)
    assert sorted(r[0] for r in left if r[0] is not None) == sorted({c for d, _, c in decided if d is not None and d == c})
    assert set(left) <= set(got)

    fourth = corpus_pipeline.mix_sources(llm_spark, llm_spark.createDataFrame(left, docs.schema), folder)
    assert fourth.columns == columns and read(fourth) == left
    order = [tuple(r) for r in fourth.collect()]
    at = {tuple(r)[:5]: (r._slot, r._offset) for r in mixing.scheduled(llm_spark.createDataFrame(left, docs.schema)).collect()}
    assert [at[r] for r in order] == sorted(at[r] for r in order)

    fifth = corpus_pipeline.best_fit_packing(llm_spark, llm_spark.createDataFrame(left, docs.schema), folder)
    pieces = fifth.collect()
    assert len({r.bin_shard for r in pieces}) == 1  # few pieces: one shard, so one brute-force packing
    items = []
    for r in left:
        n = len(words(r[1]))
        for piece in range(max(1, -(-n // packing.CAPACITY))):
            cluster = hashlib.md5((r[1] or "").strip(" \t\n\x0b\x0c\r").encode()).hexdigest()
            items.append((-min(packing.CAPACITY, n - piece * packing.CAPACITY), r[0], piece, r[3], cluster))
    # null ids, then null sources, come last among equals
    items.sort(key=lambda x: (x[0], x[1] is None, x[1] or 0, x[2], x[3] is None, x[3] or "", x[4]))
    bins, offsets = plain_best_fit([-x[0] for x in items], [x[3] for x in items], [x[4] for x in items], packing.CAPACITY)
    assert sorted(((r.doc_id, r.piece, r.length, r.bin_no, r.bin_offset) for r in pieces), key=str) == \
        sorted(((x[1], x[2], -x[0], b, o) for x, b, o in zip(items, bins, offsets)), key=str)


def test_run_equals_its_stages_and_takes_empty_tables(llm_spark, folder, no_docs, tmp_path):
    out = corpus_pipeline.run(llm_spark, folder).collect()
    docs = llm_spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(llm_spark, docs, folder)
    assert sorted(map(str, docs.collect())) == sorted(map(str, out))
    no_docs.write.parquet(f"{tmp_path}/documents.parquet")
    llm_spark.read.parquet(f"{folder}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(llm_spark, str(tmp_path)).collect() == []


def test_shards_follow_the_schedule(llm_spark, monkeypatch, tmp_path):
    """Consecutive shards hold the target shares of their sources, until a source runs out."""
    monkeypatch.setattr(packing, "SHARD", 100)
    rows = [(i, f"w{i} " * 200, "en", "big" if i % 10 else "small", 1) for i in range(3000)]
    docs = llm_spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    monkeypatch.setattr(mixing.scheduled, "__defaults__", tuple(
        1_000 if x == mixing.BLOCK_CHARS else x for x in mixing.scheduled.__defaults__))
    mixed = corpus_pipeline.mix_sources(llm_spark, docs, "")
    mixed.write.parquet(f"{tmp_path}/mixed")
    out = corpus_pipeline.best_fit_packing(llm_spark, llm_spark.read.parquet(f"{tmp_path}/mixed"), "").collect()
    assert sorted(r.doc_id for r in out) == list(range(3000))
    held = defaultdict(list)
    for r in out:
        held[r.bin_shard].append(rows[r.doc_id][3])
    assert sorted(held) == list(range(30)) and all(len(x) == 100 for x in held.values())
    for n in range(11):  # weights 3 : 1 by the square root, so 300 small ones last for 1,200 documents
        assert abs(held[n].count("small") - 25) <= 3
