import random
from itertools import combinations

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from messy import words

from ferry.llm import simhash
from ferry.llm.components import components


def fingerprint(text):
    w = [x.lower() for x in words(text)]
    grams = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints):
    """Component of each fingerprint from {fp: smallest id}, by comparing all pairs."""
    parent = {fp: fp for fp in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations([fp for fp, doc in prints.items() if doc is not None], 2):
        if (a ^ b).bit_count() <= 3:
            parent[find(a)] = find(b)
    least = {}
    for fp, doc in prints.items():
        if doc is not None:
            least[find(fp)] = min(doc, least.get(find(fp), doc))
    return {fp: least.get(find(fp)) for fp in prints}


def expected(rows):
    prints = {}
    for doc, text, *_ in rows:
        fp = fingerprint(text)
        known = prints.get(fp)
        prints[fp] = doc if known is None else known if doc is None else min(known, doc)
    comps = groups(prints)
    return [(doc, f"{fingerprint(text):016x}", comps[fingerprint(text)]) for doc, text, *_ in rows]


def test_against_brute_force(messy, rows):
    got = sorted(map(tuple, simhash.digest(messy).collect()), key=str)
    assert got == sorted(expected(rows), key=str)


def test_keep_one(messy, rows):
    kept = simhash.keep_one(messy)
    assert kept.columns == messy.columns
    got = [(r.doc_id, fingerprint(r.text)) for r in kept.select("doc_id", "text").collect()]
    want = expected(rows)
    assert sorted(d for d, _ in got if d is not None) == sorted({c for d, _, c in want if d == c and d is not None})
    alone = {f for d, f, c in want if c is None}
    assert sorted(f"{f:016x}" for d, f in got if d is None) == sorted(alone)


def test_empty_table(no_docs):
    assert simhash.digest(no_docs).collect() == []
    assert simhash.keep_one(no_docs).collect() == []


def test_golay_tables_are_a_perfect_code():
    table = simhash.golay_tables()
    weights = np.vectorize(lambda x: bin(x).count("1") if x >= 0 else 9)(table)
    assert (np.sort(weights[:, 0]) == np.repeat([0, 1, 2, 3], [1, 23, 253, 1771])).all()
    assert set((table >= 0).sum(axis=1)) == {1, 6}


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 2 ** 64 - 1), st.sets(st.integers(0, 63), max_size=3))
def test_pairs_within_three_bits_share_a_key(fp, flips):
    other = fp
    for b in flips:
        other ^= 1 << b
    left, right = simhash.fuzzy_keys(np.array([fp, other], np.uint64))
    assert set(left[0]) & set(right[1]) and set(left[1]) & set(right[0])


def test_long_texts_count_bits_exactly():
    rng = random.Random(1)
    text = " ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(3000))
    assert simhash.fingerprints([text.encode(), None, b"One"])[0] == fingerprint(text)


def test_components_of_a_long_chain_and_a_hub(llm_spark):
    links = [(i, i + 1) for i in range(0, 400)] + [(1000, i) for i in range(1001, 1400)] + [(5, 5), (None, 3), (7, 6)]
    found = dict(map(tuple, components(llm_spark.createDataFrame(links, "a long, b long"), "a", "b").collect()))
    assert len(found) == 401 + 400
    assert {found[i] for i in range(401)} == {0} and {found[i] for i in range(1000, 1400)} == {1000}
