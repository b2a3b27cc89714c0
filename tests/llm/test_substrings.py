import hashlib

import numpy as np
from messy import words

from ferry.llm import substrings


def brute(rows, window=50):
    first = {}
    for doc, text, *_ in rows:
        w = words(text)
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            if doc is not None:
                first[key] = min(doc, first.get(key, doc))
    out = []
    for doc, text, *_ in rows:
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if doc is not None and first[tuple(w[i:i + window])] < doc:
                gone[i:i + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((doc, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_against_brute_force(messy, rows):
    got = sorted(map(tuple, substrings.digest(messy).collect()), key=str)
    assert got == brute(rows)
    assert sum(r[2] > 0 for r in got) > 20


def test_other_windows_and_levels(messy, rows):
    for window, levels in ((5, 1), (17, 4)):
        got = substrings.remove_repeats(messy, window=window, levels=levels)
        got = sorted(((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in got.collect()), key=str)
        assert got == brute(rows, window)


def test_empty_table(no_docs):
    assert substrings.digest(no_docs).collect() == []


def test_rolling_hash_depends_on_the_words_alone():
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 2 ** 63, 500).astype(np.uint64)
    again = np.concatenate([rng.integers(0, 2 ** 63, 123).astype(np.uint64), hashes])
    assert (substrings.grams(hashes, 50) == substrings.grams(again, 50)[123:]).all()
    assert len(np.unique(substrings.grams(hashes, 50))) == 451
    assert (substrings.sliding_min(hashes, 38) == [hashes[i:i + 38].min() for i in range(463)]).all()
    assert substrings.level_lengths(50, 3) == [13, 25, 50]
