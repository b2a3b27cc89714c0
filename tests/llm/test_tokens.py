import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ferry.llm import tokens
from ferry.session import scratch_path

PATH = public_tokenizers.path("word_bpe_49k.json")
ENCODER = tokens.Encoder(PATH)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t\x1c\xa0'.,!?aAéÉßİΣσ́e̸=<s12|#"), st.characters(codec="utf-8")), max_size=60))
def test_word_by_word_equals_whole_texts(text):
    assert ENCODER.words is not None
    got = np.frombuffer(ENCODER([text])[0], "<u2").tolist()
    assert got == ENCODER.tokenizer.encode(text, add_special_tokens=False).ids


ADDED = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|StartOfText|>", "<|endoftext", "|>", "\u017ftartoftext"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.sampled_from([*ADDED, " ", "\n", "x", "y.", "A", "\u0338"]), st.text(max_size=4)), max_size=8).map("".join))
def test_added_tokens_are_the_librarys(text):
    assert np.frombuffer(ENCODER([text])[0], "<u2").tolist() == ENCODER.tokenizer.encode(text, add_special_tokens=False).ids


def test_added_tokens_alone():
    assert np.frombuffer(ENCODER(["<|endoftext|>"])[0], "<u2").tolist() == [49407]
    for text in ("x<|ENDOFTEXT|>y", "a <|startoftext|> b", "<|endoftext|>.", "x<|endoftext|>Y"):
        assert np.frombuffer(ENCODER([text])[0], "<u2").tolist() == ENCODER.tokenizer.encode(text, add_special_tokens=False).ids


def test_files_read_back_against_the_library(messy, rows, tokenizer):
    got = tokens.digest(messy).orderBy("start").collect()
    coded = sorted(((d is not None, d, np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4").tobytes())
                    for d, t, *_ in rows), key=lambda x: (x[0], x[1] or 0, x[2]))
    start, want = 0, []
    for _, d, ids in coded:
        want.append((d, start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    # several rows of one id: their order among themselves is free
    assert sorted(r.n_tokens for r in got) == sorted(w[2] for w in want)
    unique = {w[0] for w in want if sum(x[0] == w[0] for x in want) == 1}
    assert [tuple(r) for r in got if r.doc_id in unique] == [w for w in want if w[0] in unique]
    assert [r.start for r in got] == np.r_[0, np.cumsum([r.n_tokens for r in got])[:-1]].tolist()


def test_other_tokenizer_with_whole_texts(messy, llm_spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert tokens.Encoder(path).words is None
    out = scratch_path(llm_spark, "tokens-test")
    tokens.encode_corpus(messy, path, out)
    back = tokens.read_blocks(llm_spark, f"{out}/blocks", tokens.read_code(llm_spark, out))
    want = Tokenizer.from_file(path).encode(messy.where("doc_id = 500 or doc_id = 110").orderBy("doc_id").first().text).ids + [1]
    assert np.frombuffer(back.where("doc_id = 110").first().ids, "<u4").tolist() == want


def test_empty_table(no_docs):
    assert tokens.digest(no_docs).collect() == []


def optimal_cost(counts, limit):
    """Least total length of a prefix code with codes of at most ``limit`` bits (plain dynamic programming)."""
    counts = sorted(counts, reverse=True)
    best = {(0, 1): 0}  # (placed, open nodes) at a depth
    for depth in range(1, limit + 1):
        after = {}
        for (done, open_nodes), cost in best.items():
            for leaves in range(min(2 * open_nodes, len(counts) - done) + 1):
                key = (done + leaves, min(2 * open_nodes - leaves, len(counts)))
                value = cost + depth * sum(counts[done:done + leaves])
                after[key] = min(value, after.get(key, 1 << 60))
        best = {k: min(v, best.get(k, 1 << 60)) if k[0] == len(counts) and k in best else v for k, v in after.items()}
        best.update({k: min(v, best.get(k, 1 << 60)) for k, v in after.items()})
        finished = [v for (done, _), v in best.items() if done == len(counts)]
    return min(finished)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 200), min_size=2, max_size=8), st.integers(3, 5))
def test_code_lengths_are_optimal_within_the_limit(counts, limit):
    lengths = tokens.code_lengths(np.array(counts), limit)
    assert lengths.max() <= limit and sum(2.0 ** -x for x in lengths) == 1
    assert (lengths * counts).sum() == optimal_cost(counts, limit)


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 3000), st.integers(1, 5000), st.integers(0, 99))
def test_blocks_round_trip(symbols, n, seed):
    rng = np.random.default_rng(seed)
    ids = (rng.zipf(1.3, n) % symbols).astype(np.int64) * 7
    there, counts = np.unique(ids, return_counts=True)
    code = tokens.Code(there, tokens.code_lengths(counts))
    payload, offsets = code.encode(ids)
    assert (tokens.decode(payload, offsets, n, code.table()) == ids).all()
    part = offsets[len(offsets) // 2:]  # decoding may begin at any checkpoint
    at = len(offsets) // 2 * tokens.STRIDE
    assert (tokens.decode(payload, part, n - at, code.table()) == ids[at:]).all()


def test_rare_words_leave_the_cache_and_frequent_ones_stay(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 8)
    encoder, asked = tokens.Encoder(PATH), []
    work_out = encoder.words.work_out
    encoder.words.work_out = lambda word: asked.append(word) or work_out(word)
    for i in range(60):
        text = f"often rare{chr(97 + i % 26)}{chr(97 + i // 26)}, often Once!"
        assert np.frombuffer(encoder([text])[0], "<u2").tolist() == ENCODER.tokenizer.encode(text, add_special_tokens=False).ids
    assert asked.count("often") == 1 and len(encoder.words) <= 8 and len(encoder.words.old) <= 8


def test_punctuation_makes_no_second_entry_of_a_word():
    encoder = tokens.Encoder(PATH)
    encoder(["often, (often) often.", "often; often"])
    assert "often" in encoder.words and not [w for w in encoder.words if "often" in w and w != "often"]


def test_distinct_words_are_looked_up_once_without_their_punctuation(monkeypatch):
    encoder, asked = tokens.Encoder(PATH), []
    each = encoder.words.each
    encoder.words.each = lambda words: asked.extend(words) or each(words)
    monkeypatch.setattr(tokens, "WORDS_AT_ONCE", 3)
    texts = ["Often, (often) often.", None, " \n ", "often; don't ,'s a,b.c!! \u2019a. \xa0", "", "\xe9t\xe9, often", "<|endoftext|> often"]
    want = [x.ids for x in encoder.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert [np.frombuffer(bytearray(x), "<u2").tolist() for x in encoder(texts)] == want
    assert asked.count("often") == 1 and not {"often,", "(often)", "often.", "often;"} & set(asked)
    assert encoder([" "]) == [b""] and encoder([]) == [] and encoder(["\xa0", "\r"]) == [b"", b""]


def test_one_encoder_for_a_process_and_wide_offsets():
    assert tokens.encoder_of(PATH) is tokens.encoder_of(PATH)
    code = tokens.Code(np.array([3, 5]), np.array([1, 1]))
    assert code.encode(np.array([3, 5] * 300))[1].dtype == np.int64  # a document may pass 2^31 bits
