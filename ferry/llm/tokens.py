"""Token ids as canonical length-limited Huffman code, in files of independent blocks.

Steps: tokenise every whole text (an end id after each document) and land the
ids; count ids over the whole corpus (partial counts per task, one row per id on
the driver); derive code lengths of at most ``MAX_BITS`` by package-merge; order
documents by id (range partitions, sorted); write blocks; read them back.

File format: Parquet rows, one per block, written by Spark (so lost tasks are
written again and only whole files appear). A block holds whole documents up to
``BLOCK_TOKENS`` tokens, or one longer document:

    part, block     place in the ascending order of documents
    first           tokens of this part before the block
    doc_ids, sizes  its documents and their numbers of tokens
    offsets         bit offset of every ``STRIDE``-th token
    payload         codes, most significant bit first

and one code table (id, length) from which the canonical code follows. Any
block decodes alone, and any ``STRIDE`` tokens from their bit offset: a lookup of
the next ``MAX_BITS`` bits gives the id and the length of its code, for all
offsets of a block at once.

Defined results
    null text: no tokens but the end id; null ids come first; repeated rows are
    documents of their own, ordered by their ids; an empty table gives an empty
    result; extra columns are not read.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.llm.common import landed, partitions
from ferry.session import scratch_path

END_ID = 1
MAX_BITS = 18
BLOCK_TOKENS = 131_072
STRIDE = 128
CACHE_WORDS = 200_000   # of each of two generations, in every worker process
TEXT_AT_ONCE = 4 << 20  # bytes of text whose words are looked up together; a longer text is taken alone
WORDS_AT_ONCE = 1 << 20
BLOCK_KIND = ("part long, block long, first long, doc_ids array<long>, sizes array<long>, offsets array<long>, "
              "payload binary")


# -- tokenising ---------------------------------------------------------------

LETTERS = re.compile("[a-zA-ZÀ-ÖØ-öø-ÿ]+").fullmatch  # letters that are their own NFC form and lower-case alone
EDGE = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # ASCII punctuation but the apostrophe, which may begin a pre-token of letters


LETTER, MARK, SPACE, OTHER = 1, 2, 4, 8
BYTE_IS = np.array([SPACE if c in b" \n" else OTHER if c >= 128 else LETTER if chr(c).isalpha() else MARK if chr(c) in EDGE else OTHER
                    for c in range(256)], np.uint8)


def is_plain(word: str) -> bool:
    """Only such letters."""
    return word.isalpha() if word.isascii() else LETTERS(word) is not None


def _byte_letters() -> dict[int, str]:
    """Latin-1 letter -> letters of byte-level BPE for its UTF-8 bytes (fixed by the tokenizer's format): printable bytes
    stand for themselves, the others from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {c: "".join(chr(b if b in shown else 256 + hidden.index(b)) for b in chr(c).encode()) for c in range(256)}


class _Words(dict):
    """Word -> its ids as bytes, worked out on a miss.

    Letters and the punctuation around them are looked up apart. What is looked
    up stays for two generations: a full one becomes the old one, and only what is
    asked for again moves from there to the new one. Rare words leave, frequent ones do not.
    """

    def __init__(self, tokenizer, kind: str, most: int):
        super().__init__()
        self.tokenizer, self.tokenize, self.kind, self.letters = tokenizer, tokenizer.model.tokenize, kind, _byte_letters()
        self.bytes_of = [array(kind, [i]).tobytes() for i in range(tokenizer.get_vocab_size())]
        self.most, self.old = most, {}

    def __missing__(self, word: str) -> bytes:
        return self.each([word])[0]

    def each(self, words: list[str]) -> list[bytes]:
        """The ids of every word."""
        found = list(map(self.get, words))
        old, work_out = self.old.get, self.work_out
        for i, ids in enumerate(found):
            if ids is None:
                word = words[i]
                ids = old(word)
                if ids is None:
                    ids = work_out(word)
                found[i] = self[word] = ids
                if len(self) >= self.most:
                    self.old = dict(self)
                    self.clear()
                    old = self.old.get
        return found

    def of(self, texts: list[str]) -> list[bytes]:
        """The ids of whole texts: cut into words where the tokenizer never joins, each distinct word looked up once."""
        data = np.frombuffer(bytearray("\n".join(texts), "utf-8"), np.uint8)
        kind = BYTE_IS[data]
        space = kind == SPACE
        first = ~space
        first[1:] &= space[:-1] | (kind[1:] + kind[:-1] == LETTER + MARK)
        at = np.flatnonzero(first)
        if not len(at):
            return [b""] * len(texts)
        spaces = np.cumsum(space, dtype=np.int32 if len(data) < 1 << 31 else np.int64)
        offsets = np.append(at - spaces[at], len(data) - spaces[-1])
        words = pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data[~space])]).dictionary_encode()
        found = self.each(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids = np.frombuffer(bytearray().join(found), self.kind)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // ids.itemsize
        starts, words = np.cumsum(sizes) - sizes, words.indices.to_numpy()
        ends, out = np.zeros(len(words) + 1, np.int64), []
        for i in range(0, len(words), WORDS_AT_ONCE):
            some = words[i:i + WORDS_AT_ONCE]
            n = sizes[some]
            until = np.cumsum(n)
            ends[i + 1:i + 1 + len(some)] = ends[i] + until
            out.append(ids[np.repeat(starts[some] - (until - n), n) + np.arange(until[-1])].tobytes())
        begin = np.cumsum([0] + [len(t) if t.isascii() else len(t.encode()) for t in texts]) + np.arange(len(texts) + 1)
        cuts = (ends[np.searchsorted(at, begin)] * ids.itemsize).tolist()
        joined = out[0] if len(out) == 1 else b"".join(out)
        return [joined[x:y] for x, y in zip(cuts, cuts[1:])]

    def work_out(self, word: str) -> bytes:
        if word.isalpha() if word.isascii() else LETTERS(word):  # a single pre-token: straight to the library's model
            letters = word.lower()
            bytes_of, tokens = self.bytes_of, self.tokenize(letters if letters.isascii() else letters.translate(self.letters))
            if len(tokens) == 1:
                return bytes_of[tokens[0].id]
            return b"".join([bytes_of[t.id] for t in tokens])
        stem = word.strip(EDGE)
        if is_plain(stem):
            at = word.index(stem)
            head, tail = word[:at], word[at + len(stem):]
            return (self[head] if head else b"") + self[stem] + (self[tail] if tail else b"")
        return array(self.kind, self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes() if word else b""


def _lowered(text: str) -> str:
    """The text in lower case where that is sure to be what the tokenizer does: all Latin-1, so in NFC already."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text
    return text.lower()


class Encoder:
    """Texts -> ids as little-endian bytes, by the tokenizers library.

    Where the tokenizer lower-cases, drops white space and never joins across
    it nor letters with punctuation, words are encoded once and remembered; otherwise whole texts are encoded.
    So are texts that hold an added token in any case: the library finds those
    before it lower-cases or splits.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.wide = self.tokenizer.get_vocab_size() > 1 << 16
        spec = json.loads(self.tokenizer.to_str())
        steps = [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])]
        pre = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        by_word = (steps == ["NFC", "Replace", "Lowercase"] and [x["type"] for x in pre] == ["Split", "ByteLevel"]
                   and pre[0]["behavior"] == "Removed" and pre[0]["invert"] and not pre[1]["add_prefix_space"]
                   and r"[\p{L}]+" in pre[0]["pattern"]["Regex"] and spec["model"]["type"] == "BPE")
        self.words = _Words(self.tokenizer, self.kind, CACHE_WORDS) if by_word else None
        added = [x["content"] for x in spec["added_tokens"] if x["content"]]
        self.added = re.compile("|".join(map(re.escape, added)), re.IGNORECASE).search if added else lambda text: None
        # Most texts hold no mark, so a plain search is all they take; a token without symbols needs the full one.
        marks = {max(re.findall(r"[!-/:-@\[-`{-~]+", x), key=len, default="") for x in added}
        self.marks = [""] if "" in marks else sorted(marks)

    def _whole(self, text: str) -> bool:
        return any(m in text for m in self.marks) and self.added(text) is not None

    def _encoded(self, text: str) -> bytes:
        return array(self.kind, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    @property
    def kind(self) -> str:
        return "I" if self.wide else "H"

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        if self.words is None:
            return [array(self.kind, e.ids).tobytes()
                    for e in self.tokenizer.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)]
        whole = {i: self._encoded(t) for i, t in enumerate(texts) if t and self._whole(t)}
        out = self.words.of([_lowered(t) if t and i not in whole else "" for i, t in enumerate(texts)])
        for i, ids in whole.items():
            out[i] = ids
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder_of(path: str) -> Encoder:
    """The encoder of this process: a Python worker keeps what it has looked up for the tasks after."""
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def token_table(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                end_id: int = END_ID) -> DataFrame:
    """``(doc_id, ids)`` landed: each document's ids with the end id, as little-endian bytes (2 or 4 an id)."""
    def run(batches):
        encoder = encoder_of(tokenizer)
        end = array(encoder.kind, [end_id]).tobytes()
        for batch in batches:
            sizes = np.cumsum([0 if n is None else n for n in pc.binary_length(batch.column(1)).to_pylist()])
            at = 0
            while at < batch.num_rows:
                n = max(1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + TEXT_AT_ONCE, "right")) - at)
                ids = [x + end for x in encoder(batch.column(1).slice(at, n).to_pylist())]
                yield pa.record_batch([batch.column(0).slice(at, n), pa.array(ids, pa.binary())], names=["doc_id", "ids"])
                at += n

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return landed(texts.mapInArrow(run, "doc_id long, ids binary"), "token-ids", compression="zstd")


# -- the code -----------------------------------------------------------------

def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``max_bits`` for positive ``counts`` (package-merge)."""
    n = len(counts)
    if n > 1 << max_bits:
        raise ValueError(f"{n} ids do not fit codes of {max_bits} bits")
    if n <= 1:
        return np.ones(n, np.int64)
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.float64)
    level, kinds = leaves, [np.ones(n, bool)]
    for _ in range(max_bits - 1):
        pairs = level[:len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, pairs])
        by = np.argsort(both, kind="stable")
        level = both[by]
        kinds.append(by < n)
    lengths, need = np.zeros(n, np.int64), 2 * n - 2
    for is_leaf in reversed(kinds):
        taken = int(is_leaf[:need].sum())
        lengths[:taken] += 1
        need = 2 * (need - taken)
    out = np.zeros(n, np.int64)
    out[order] = lengths
    return out


class Code:
    """Canonical code of ``(ids, lengths)``: shorter codes first, then smaller ids."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        order = np.lexsort((ids, lengths))
        self.ids, self.lengths = ids[order].astype(np.int64), lengths[order].astype(np.int64)
        width = np.int64(1) << (MAX_BITS - self.lengths)
        starts = np.cumsum(width) - width
        top = int(self.ids.max()) + 1 if len(ids) else 1
        self.code_of, self.bits_of = np.zeros(top, np.uint64), np.zeros(top, np.int64)
        self.code_of[self.ids] = (starts >> (MAX_BITS - self.lengths)).astype(np.uint64)
        self.bits_of[self.ids] = self.lengths
        self.width = width

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """Id and code length by the next ``MAX_BITS`` bits."""
        spare = (1 << MAX_BITS) - int(self.width.sum())  # only a code of a single id leaves any
        ids = np.concatenate([np.repeat(self.ids, self.width), np.zeros(spare, np.int64)])
        return ids, np.concatenate([np.repeat(self.lengths, self.width), np.ones(spare, np.int64)])

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Payload and the bit offset of every ``STRIDE``-th id."""
        bits = self.bits_of[ids]
        at = np.cumsum(bits) - bits
        word, room = at >> 5, (64 - (at & 31) - bits).astype(np.uint64)
        shifted = self.code_of[ids] << room
        n = int((at[-1] + bits[-1] + 31) // 32) + 1 if len(ids) else 0
        # Codes do not overlap, so sums of 32-bit parts are exact in floating point.
        high = np.bincount(word, (shifted >> np.uint64(32)).astype(np.float64), n)
        low = np.bincount(word + 1, (shifted & np.uint64(0xFFFFFFFF)).astype(np.float64), n)
        return (high + low).astype(">u4").tobytes(), at[::STRIDE]


def decode(payload: bytes, offsets: np.ndarray, n: int, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The ``n`` ids of a block, ``STRIDE`` table lookups at all offsets in step."""
    data = np.frombuffer(payload + bytes(8), np.uint8).astype(np.uint32)
    ahead = data[:-3] << np.uint32(24) | data[1:-2] << np.uint32(16) | data[2:-1] << np.uint32(8) | data[3:]
    ids, lengths = table
    at = offsets.astype(np.int64)
    out = np.zeros((STRIDE, len(at)), np.int64)
    last = len(ahead) - 1
    for step in range(min(STRIDE, n)):
        look = (ahead[np.minimum(at >> 3, last)] << (at & 7).astype(np.uint32)) >> np.uint32(32 - MAX_BITS)
        out[step] = ids[look]
        at += lengths[look]
    return out.T.reshape(-1)[:n]


# -- files --------------------------------------------------------------------

def global_counts(tokens: DataFrame, wide: bool) -> tuple[np.ndarray, np.ndarray]:
    """Ids that occur and how often, over the whole table."""
    def run(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            found = np.bincount(np.frombuffer(b"".join(batch.column("ids").to_pylist()), "<u4" if wide else "<u2"))
            if len(found) > len(total):
                found[:len(total)] += total
                total = found
            else:
                total[:len(found)] += found
        there = np.flatnonzero(total)
        yield pa.record_batch([pa.array(there), pa.array(total[there])], names=["id", "n"])

    rows = (tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
            .orderBy("id").collect())
    return np.array([r.id for r in rows], np.int64), np.array([r.n for r in rows], np.int64)


def write_blocks(tokens: DataFrame, code: Code, path: str, wide: bool) -> None:
    """Documents in ascending id order as coded blocks below ``path``."""
    def run(batches):
        part, block, first = TaskContext.get().partitionId(), 0, 0
        docs: list[tuple[int, bytes]] = []
        held = 0

        def coded():
            sizes = [len(x) // (4 if wide else 2) for _, x in docs]
            payload, offsets = code.encode(np.frombuffer(b"".join(x for _, x in docs), "<u4" if wide else "<u2"))
            return pa.record_batch(
                [pa.array([part]), pa.array([block]), pa.array([first]), pa.array([[d for d, _ in docs]], pa.list_(pa.int64())),
                 pa.array([sizes], pa.list_(pa.int64())), pa.array([offsets], pa.list_(pa.int64())),
                 pa.array([payload], pa.binary())],
                names=["part", "block", "first", "doc_ids", "sizes", "offsets", "payload"])

        for batch in batches:
            for doc, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
                n = len(ids) // (4 if wide else 2)
                if docs and held + n > BLOCK_TOKENS:
                    yield coded()
                    block, first, docs, held = block + 1, first + held, [], 0
                docs.append((doc, ids))
                held += n
        if docs:
            yield coded()

    ordered = (tokens.repartitionByRange(partitions(tokens), "doc_id").sortWithinPartitions("doc_id", "ids"))
    # Payload and offsets are dense already.
    ordered.mapInArrow(run, BLOCK_KIND).write.option("compression", "uncompressed").parquet(path)


def read_blocks(spark: SparkSession, path: str, code: Code) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of every document, from the files alone."""
    blocks = spark.read.schema(BLOCK_KIND).parquet(path)
    per_part = (blocks.groupBy("part").agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
                .orderBy("part").collect())  # a number for each output partition
    before, total = {}, 0
    for r in per_part:
        before[r.part], total = total, total + r.n

    def run(batches):
        table = code.table()
        for batch in batches:
            for i in range(batch.num_rows):
                sizes = batch.column("sizes")[i].values.to_numpy()
                ids = decode(batch.column("payload")[i].as_py(), batch.column("offsets")[i].values.to_numpy(),
                             int(sizes.sum()), table).astype("<u4")
                ends = np.cumsum(sizes)
                begin = before[batch.column("part")[i].as_py()] + batch.column("first")[i].as_py()
                parts = [ids[e - s:e].tobytes() for s, e in zip(sizes, ends)]
                yield pa.record_batch([batch.column("doc_ids")[i].values, pa.array(begin + ends - sizes), pa.array(sizes),
                                       pa.array(parts, pa.binary())], names=["doc_id", "start", "n_tokens", "ids"])

    return blocks.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def encode_corpus(docs: DataFrame, tokenizer: str, path: str, id_col: str = "doc_id", text_col: str = "text",
                  end_id: int = END_ID) -> Code:
    """Write ``docs`` to ``path`` (``blocks`` and ``code`` folders) and return the code."""
    wide = Encoder(tokenizer).wide
    tokens = token_table(docs, tokenizer, id_col, text_col, end_id)
    ids, counts = global_counts(tokens, wide)
    lengths = code_lengths(counts)
    code = Code(ids, lengths)
    spark = docs.sparkSession
    spark.createDataFrame([(int(i), int(n)) for i, n in zip(ids, lengths)], "id long, length int") \
        .coalesce(1).write.parquet(f"{path}/code")  # one row per id of the vocabulary
    write_blocks(tokens, code, f"{path}/blocks", wide)
    return code


def read_code(spark: SparkSession, path: str) -> Code:
    rows = spark.read.schema("id long, length int").parquet(f"{path}/code").collect()
    return Code(np.array([r.id for r in rows], np.int64), np.array([r.length for r in rows], np.int64))


def digest(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Encode to files, read the files back, and return the contract's columns."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    spark = docs.sparkSession
    path = scratch_path(spark, "token-files")
    encode_corpus(docs, tokenizer, path)
    back = read_blocks(spark, f"{path}/blocks", read_code(spark, path))

    def run(batches):
        for batch in batches:
            sums = [zlib.crc32(x) for x in batch.column("ids").to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"),
                                   pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return back.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
