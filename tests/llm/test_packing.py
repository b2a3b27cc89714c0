from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from messy import words

from ferry.llm import packing


def plain_best_fit(lengths, sources, clusters, capacity):
    """Looks at every bin: the compatible one with the least room, the oldest of equals."""
    bins, out = [], []
    for length, source, cluster in zip(lengths, sources, clusters):
        fits = [(b["room"], n) for n, b in enumerate(bins)
                if b["room"] >= length and source not in b["sources"] and cluster not in b["clusters"]]
        if fits:
            n = min(fits)[1]
        else:
            n = len(bins)
            bins.append({"room": capacity, "sources": set(), "clusters": set()})
        out.append((n, capacity - bins[n]["room"]))
        bins[n]["room"] -= length
        bins[n]["sources"].add(source)
        bins[n]["clusters"].add(cluster)
    return [n for n, _ in out], [o for _, o in out]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 20), st.integers(0, 4), st.integers(0, 6)), max_size=60))
def test_best_fit_against_looking_at_every_bin(items):
    items = sorted(items, reverse=True)
    args = [list(x) for x in zip(*items)] if items else [[], [], []]
    assert packing.best_fit(*args, 20) == plain_best_fit(*args, 20)


def test_whole_texts_within_capacity_without_conflicts(messy, rows):
    out = packing.packed(messy, capacity=100).collect()
    bins = defaultdict(list)
    for r in out:
        bins[r.bin_shard, r.bin_no].append(r)
    for held in bins.values():
        here = 0
        for r in sorted(held, key=lambda r: (r.bin_offset, r.length)):
            assert r.bin_offset == here
            here += r.length
        assert here <= 100
    # rows of one id and text are copies, rows of one source conflict: all stay apart
    by_id = {r[0]: r[3] for r in rows if r[0] not in (None, 103)}
    for held in bins.values():
        named = [by_id[r.doc_id] for r in held if r.doc_id in by_id]
        assert len(named) == len(set(named))
    total = defaultdict(int)
    for r in out:
        total[r.doc_id] += r.length
    want = defaultdict(int)
    for doc, text, *_ in rows:
        want[doc] += len(words(text))
    assert total == want
    assert len({r.piece for r in out if r.doc_id == 503}) == 300


def test_sources_may_share_bins_if_asked(messy):
    with_rule = packing.packed(messy, capacity=400).select("bin_shard", "bin_no").distinct().count()
    without = packing.packed(messy, capacity=400, one_per_source=False).select("bin_shard", "bin_no").distinct().count()
    assert without < with_rule


def test_empty_table(no_docs):
    assert packing.digest(no_docs).collect() == []
