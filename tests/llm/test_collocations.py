import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ferry.llm import collocations
from messy import LOWER


def brute(rows, min_count=10, top=2000, max_words=3):
    f, n = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for k in range(1, max_words + 1):
                f.update((lang, *w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    candidates = [p for p, a in f.items() if len(p) > 2 and a >= min_count]
    longest = Counter()
    for p in candidates:
        for k in range(2, len(p) - 1):
            for i in range(1, len(p) - k + 1):
                part = (p[0], *p[i:i + k])
                longest[part] = max(longest[part], f[p])
    for p in candidates:
        a = f[p]
        if 100 * longest[p] >= 50 * a:
            continue
        cuts = []
        for k in range(1, len(p) - 1):
            l, r = f[p[:1 + k]], f[(p[0], *p[1 + k:])]
            cuts.append((1_000_000 * a * a // (l * r), k, l, r))
        score, _, l, r = min(cuts)
        out.append((p[0], -score, -a, " ".join(p[1:]).encode(), l, r))
    ranked, seen = [], Counter()
    for lang, score, a, phrase, l, r in sorted(out):
        seen[lang] += 1
        if seen[lang] <= top:
            ranked.append((lang, seen[lang], phrase.decode(), -a, l, r, n[lang], -score))
    return ranked


def test_against_brute_force(messy, rows):
    d = F.coalesce(F.col("doc_id"), F.lit(1))
    langs = messy.withColumn("lang", F.when(d == 503, None).when(d % 2 == 0, F.lit("dé")).otherwise(F.lit("en")))
    got = sorted(map(tuple, collocations.digest(langs).collect()), key=lambda r: r[:2])
    assert got == brute([(r[0], r[1], None if r[0] == 503 else "en" if (r[0] or 1) % 2 else "dé") for r in rows])
    assert len({r[0] for r in got}) > 1 and any(r[2].count(" ") == 2 for r in got)


@pytest.mark.parametrize("options", [{"min_count": 3, "shards": 1}, {"min_count": 2, "shards": 7, "top": 5},
                                     {"min_count": 25, "shards": 3}, {"min_count": 4, "shards": 2, "max_words": 2}])
def test_other_thresholds_shards_and_lengths(messy, rows, options):
    got = sorted(map(tuple, collocations.collocations(messy, **options).collect()), key=lambda r: r[:2])
    assert got == brute(rows, options["min_count"], options.get("top", 2000), options.get("max_words", 3))


def test_phrases_that_become_frequent_in_the_last_shard(llm_spark):
    """Late words make late pairs, and those late triples: the cycle goes on until the last has been round."""
    texts = ["a b c"] * 6 + ["x"] * 30 + ["a b c"] * 6
    rows = [(i, t, "en") for i, t in enumerate(texts)]
    df = llm_spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
    for shards in (1, 2, 5, 8):
        found = collocations.frequent_phrases(df, min_count=11, shards=shards).where("size > 0")
        assert {(r.phrase, r.n) for r in found.collect()} == {("a", 12), ("b", 12), ("c", 12), ("x", 30), ("a b", 12), ("b c", 12),
                                                             ("a b c", 12)}


def test_slots_that_phrases_share_change_no_count(monkeypatch):
    monkeypatch.setattr(collocations, "slots_of", lambda h: (h % 3).astype(int))
    counter = collocations.ShardCounter("en", 1, 4, [collocations.np.zeros(3, collocations.np.uint8)] * 2)
    counter.add(b"p q p q\nq p".replace(b"\n", b" \n ").split(b" "), 100)
    got = {(b.column("size")[i].as_py(), b.column("phrase")[i].as_py()): b.column("n")[i].as_py()
           for b in counter.batches() for i in range(b.num_rows)}
    assert got == {(0, ""): 6, (1, "p"): 3, (1, "q"): 3, (2, "p q"): 2, (2, "q p"): 2, (3, "p q p"): 1, (3, "q p q"): 1}


def test_very_long_texts_are_cut_without_losing_phrases(llm_spark, monkeypatch):
    monkeypatch.setattr(collocations, "BYTES_AT_ONCE", 64)
    monkeypatch.setattr(collocations, "WORDS_AT_ONCE", 7)
    text = " ".join(f"w{i % 9}{',' if i % 31 == 0 else ''}" for i in range(400)) + "  tail\t\ttail  tail"
    counter = collocations.ShardCounter("en", 1, 4, [collocations.np.zeros(collocations.SLOTS, collocations.np.uint8)] * 2)
    for portion in collocations._portions([text.encode()]):
        for words, own in counter.slices(portion):
            counter.add(words, own)
    got = Counter()
    for b in counter.batches():
        for size, phrase, n in zip(*(b.column(c).to_pylist() for c in ("size", "phrase", "n"))):
            got[phrase] += n
    want = Counter()
    for piece in text.split(","):
        w = piece.split()
        for k in (1, 2, 3):
            want.update(" ".join(w[i:i + k]) for i in range(len(w) - k + 1))
    want[""] = sum(len(p.split()) for p in text.split(","))
    assert got == want


def test_scores_beyond_64_bits(llm_spark):
    big = 3 * 10 ** 12
    phrases = llm_spark.createDataFrame(
        [("en", 0, "", 9 * big), ("en", 1, "a", big + 7), ("en", 1, "b", big + 1), ("en", 2, "a b", big)],
        "lang string, size int, phrase string, n long")
    row = collocations.scored(phrases).first()
    assert row.score == 1_000_000 * big * big // ((big + 7) * (big + 1)) and (row.l, row.r, row.n) == (big + 7, big + 1, 9 * big)


def test_empty_table(no_docs):
    assert collocations.digest(no_docs).collect() == []


def test_texts_without_words(llm_spark):
    df = llm_spark.createDataFrame([(1, None, None), (2, " .,\n", "en")], "doc_id long, text string, lang string")
    assert collocations.digest(df.withColumn("n", F.lit(1))).collect() == []


def test_slots_reach_the_driver_as_bitmaps(llm_spark, monkeypatch):
    """However many phrases reach the threshold, the driver gets a bitmap for each 32,768 slots."""
    texts = [" ".join(f"w{i + j}" for j in range(100)) + "." for i in range(0, 4000, 100)] * 2
    df = llm_spark.createDataFrame([(i, t, "en" if i % 3 else None) for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    sent = []
    for name in ("collect", "toPandas"):
        monkeypatch.setattr(type(df), name, lambda self, *a, f=getattr(type(df), name): (sent.append(len(out := f(self, *a))), out)[1])
    found = collocations.frequent_phrases(df, min_count=1)
    assert sent and max(sent) <= 2 * -(-collocations.SLOTS // 32_768)
    monkeypatch.undo()
    sizes = Counter(r["size"] for r in found.where("size > 0").select("size").collect())
    of = lambda k: len({(i % 3 > 0, *ws[j:j + k]) for i, t in enumerate(texts) for ws in [t[:-1].split()] for j in range(101 - k)})
    assert sizes == {k: of(k) for k in (1, 2, 3)} and sizes[1] > 4000


def test_crossed_slots_are_those_of_the_phrases(llm_spark):
    phrases = [("en", 1, "a"), ("dé", 1, "a"), ("en", 2, "a b"), ("en", 1, "é"), *(("en", 2, f"x{i} y") for i in range(500))]
    df = llm_spark.createDataFrame(phrases, "lang string, size int, phrase string").repartition(3)
    got = {(size, int(s)) for size, slots in collocations.crossed_slots(df) for s in slots}
    counters = {lang: collocations._Vocabulary(lang) for lang in ("en", "dé")}
    want = set()
    for lang, size, phrase in phrases:
        ids = [counters[lang][w.encode()] for w in phrase.split(" ")]
        h = [collocations.np.array([counters[lang].hashes[i]], collocations.np.uint64) for i in ids]
        want.add((size, int(collocations.slots_of(collocations.reduce(collocations.joined, h))[0])))
    assert got == want
