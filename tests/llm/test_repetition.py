import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from messy import SPACE

from ferry.llm import repetition


def windows(w, size):
    """Word positions inside windows found twice or more."""
    at = {}
    for i in range(len(w) - size + 1):
        at.setdefault(tuple(w[i:i + size]), []).append(i)
    return {p for places in at.values() if len(places) > 1 for i in places for p in range(i, i + size)}


def longest(w):
    size = 0
    while windows(w, size + 1):
        size += 1
    return size


def brute(text):
    w = re.findall(f"[^{SPACE}]+", text or "")
    lines = [x for x in (text or "").split("\n") if x.strip(SPACE)]
    three, eight, most = windows(w, 3), windows(w, 8), longest(w)
    failed = len(w) < 50 or 100 * len(three) > 50 * len(w)
    kept = not failed and 100 * len(eight) <= 30 * len(w) and most <= 100
    return (len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(three),
            failed, kept, len(eight))


def test_against_brute_force(messy, rows):
    got = sorted((tuple(r) for r in repetition.digest(messy).collect()), key=str)
    assert got == sorted(((r[0], *brute(r[1])) for r in rows), key=str)
    assert {r[7] for r in got} == {True, False}


def test_repetitive_documents_go(llm_spark):
    rng = np.random.default_rng(4)
    def prose(n):
        return " ".join(f"w{x}" for x in rng.integers(0, 10 ** 9, n))

    passage, block = prose(60), prose(101)
    texts = {1: prose(300), 2: " ".join([prose(90), passage, prose(90), passage]),   # a covered share of 40 %
             3: " ".join([prose(900), block, prose(9), block]), 4: prose(49), 5: " ".join([prose(8)] * 30),
             6: " ".join([prose(900), " ".join(block.split()[:100]), prose(9), " ".join(block.split()[:100])])}
    df = llm_spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r for r in repetition.with_verdict(repetition.repetition(df)).collect()}
    assert {d: r.kept for d, r in got.items()} == {1: True, 2: False, 3: False, 4: False, 5: False, 6: True}
    assert not got[2].base_failed and not got[3].base_failed
    assert [(s["from"], s["to"]) for s in got[2].spans] == [(90, 150), (240, 300)]
    assert (got[3].longest_repeat, got[6].longest_repeat, got[2].n_repeats) == (101, 100, 1)
    assert {r.doc_id for r in repetition.keep_unrepetitive(df).collect()} == {1, 6}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab", max_size=14), max_size=4))
def test_suffix_array_and_maximal_repeats(texts):
    docs = [[bytes([c]) for c in t.encode()] for t in texts]
    symbols = repetition._numbers(docs)
    sizes = np.array([len(d) for d in docs], np.int64)
    ends = np.repeat(np.cumsum(sizes), sizes)
    if not len(symbols):
        return
    order, common = repetition.suffix_array(symbols, ends)
    suffixes = [tuple(symbols[i:ends[i]]) for i in range(len(symbols))]
    assert [suffixes[i] for i in order] == sorted(suffixes)
    for i in range(1, len(order)):
        a, b = suffixes[order[i - 1]], suffixes[order[i]]
        assert common[i] == next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    got = set()
    for r in repetition.maximal_repeats(symbols, order, common, 1):
        places = order[r.first:r.last + 1]
        got.add((suffixes[places[0]][:r.length], tuple(sorted(places.tolist()))))
    want = {}
    for i, s in enumerate(suffixes):
        for k in range(1, len(s) + 1):
            want.setdefault(s[:k], set()).add(i)
    def maximal(sub, places):
        after = {symbols[i + len(sub)] if i + len(sub) < ends[i] else None for i in places}
        before = {symbols[i - 1] if i else None for i in places}
        ends_differ = len(after) > 1 or after == {None}
        starts = {i for i in places if not i or ends[i - 1] != ends[i]}
        return ends_differ and (len(before) > 1 or bool(starts))
    assert got == {(s, tuple(sorted(p))) for s, p in want.items() if len(p) > 1 and maximal(s, p)}


def test_portions_do_not_matter(llm_spark, rows, monkeypatch):
    texts = [(r[1] or "").encode() for r in rows]
    together = repetition.judged(texts)
    for i, text in enumerate(texts):
        alone = repetition.judged([text])
        for name in repetition._COUNTS:
            assert alone[name][0] == together[name][i]
        assert alone["spans"][0] == together["spans"][i]


def test_empty_table_and_null_texts(llm_spark, no_docs):
    assert repetition.digest(no_docs).collect() == []
    df = llm_spark.createDataFrame([(None, None), (1, None), (1, "")], "doc_id long, text string")
    assert sorted(map(tuple, repetition.digest(df).collect()), key=str) == \
        sorted([(d, 0, 0, 0, 0, 0, True, False, 0) for d in (None, 1, 1)], key=str)


@pytest.mark.parametrize("text, dups", [("a\na\n a\n\n\n", 1), ("x\r\nx\r\nx", 1), ("\t\n\t\n", 0)])
def test_duplicate_lines(text, dups):
    assert repetition._text_counts(text.encode())[2] == dups
