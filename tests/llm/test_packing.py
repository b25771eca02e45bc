"""Token pieces against the tokenizer itself, and the packing's invariants."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from messy import empty, messy, rows
from tokenizers import Tokenizer

from stayframe.llm import packing

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(packing.default_tokenizer())


def _expected(tokenizer, text):
    ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
    return [(k, at, len(ids[at:at + 4096]), zlib.crc32(ids[at:at + 4096].tobytes())) for k, at in enumerate(range(0, len(ids), 4096))]


def _placed(records):
    bins = defaultdict(list)
    for r in records:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    return len(bins)


def _check(df, texts, tokenizer):
    got = packing.pack_documents(df).collect()
    want = Counter((i, *p) for i, t in texts for p in _expected(tokenizer, t))
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    n = _placed(got)
    assert n <= -(-sum(r["length"] for r in got) // 4096) + 1


def test_messy_documents(spark, tokenizer):
    _check(messy(spark), [(r[0], r[1]) for r in rows()], tokenizer)
    assert packing.pack_documents(empty(spark)).count() == 0


def test_driver_documents(spark, tokenizer):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    _check(df, [(r["doc_id"], r["text"]) for r in df.collect()], tokenizer)


def test_sequences_hold_the_documents(spark, tokenizer):
    df = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    packed = packing.pack_documents(df, with_ids=True).persist()
    held = {r["sequence_id"]: r["ids"] for r in packing.sequences(packed).collect()}
    docs = {r["doc_id"]: r["text"] for r in df.collect()}
    for r in packed.collect():
        ids = tokenizer.encode(docs[r["doc_id"]], add_special_tokens=False).ids + [1]
        assert held[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]] == ids[r["start"]:r["start"] + r["length"]]
    packed.unpersist()


def test_chunked_encoding_equals_the_tokenizer(tokenizer):
    encoder = packing.ChunkEncoder(open(packing.default_tokenizer(), encoding="utf-8").read())
    rng = random.Random(1)
    parts = ["a", "B", "é", "É", "'s", "'RE", "’", "1", "²", "½", "...", ".", ", ", "  ", "\n", " ", "\u0085", "\x1c", "\x01", "<|",
             "|>", "<|endoftext|>", "<|ENDOFTEXT|>", "İ", "Σ", "ς", "é", "日本", "ﬁ", "x.", "y, ", "\t", "!!", "_", "ſ",
             "​", "K", "😀", "don't."]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(1500)]
    for text, ids in zip(texts, encoder.encode([t.encode() for t in texts])):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_long_texts_go_in_parts(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "_SLICE", 1000)
    encoder = packing.ChunkEncoder(open(packing.default_tokenizer(), encoding="utf-8").read())
    text = "Alpha beta, gamma. " * 700 + "x" * 3000
    assert encoder.encode([text.encode()])[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


class _Watched:
    """A tokenizer that notes what is sent through the whole of it."""

    def __init__(self, tokenizer):
        self.model, self.tokenizer, self.seen = tokenizer.model, tokenizer, []

    def encode_batch_fast(self, texts, **kwargs):
        self.seen += texts
        return self.tokenizer.encode_batch_fast(texts, **kwargs)


def test_plain_words_go_to_the_model_alone(tokenizer):
    encoder = packing.ChunkEncoder(open(packing.default_tokenizer(), encoding="utf-8").read())
    encoder.tokenizer = watched = _Watched(tokenizer)
    latin = "".join(map(chr, range(0xC0, 0x100))).replace("×", "").replace("÷", "")
    texts = ["Plain words, and more. Élève, GROẞ groß!! naïve'; word...", *latin, latin, "a" + latin + "z$$$",
             "".join(map(chr, range(0x21, 0x7F))), *(f"été{chr(c)}, x{chr(c)}{chr(c)}" for c in range(0x21, 0x7F))]
    for text, ids in zip(texts, encoder.encode([t.encode() for t in texts])):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text
    assert not any(w in t.split() for t in watched.seen for w in ("plain", "words", "élève", "more", "groß!!", "naïve';"))
    assert any("groẞ" in t for t in watched.seen)  # beyond U+00FF: the whole tokenizer


def test_other_tokenizers_take_whole_chunks(tokenizer):
    import json
    spec = json.loads(open(packing.default_tokenizer(), encoding="utf-8").read())
    spec["normalizer"]["normalizers"].pop()  # case is kept
    encoder = packing.ChunkEncoder(json.dumps(spec))
    encoder.tokenizer = watched = _Watched(encoder.tokenizer)
    encoder.encode([b"plain words"])
    assert sorted(w for t in watched.seen for w in t.split() if w.isalpha()) == ["plain", "words"]


def test_best_two_fit():
    # greedy 60 + 30 leaves 10; 30 gives way to 22 + 18, which fill the gap
    where, place = packing.best_two_fit(np.array([60, 30, 22, 18]), capacity=100)
    assert where[0] == where[2] == where[3] != where[1] and place[0] == 0
    rng = np.random.default_rng(4)
    for _ in range(20):
        lengths = rng.integers(1, 101, rng.integers(1, 400))
        where, place = packing.best_two_fit(lengths, capacity=100)
        for k in range(where.max() + 1):
            at = np.flatnonzero(where == k)
            at = at[np.argsort(place[at])]
            assert (place[at] == np.cumsum(lengths[at]) - lengths[at]).all() and lengths[at].sum() <= 100
