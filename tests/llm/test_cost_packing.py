"""Cost-balanced pieces against the tokenizer, exact fill, and a plain greedy."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from messy import empty, messy, rows
from tokenizers import Tokenizer

from stayframe.llm import cost_packing as cp

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(cp.default_tokenizer())


def _check(df, texts, tokenizer, **options):
    """Every id once, in its place; sequences gapless, full or a power of two."""
    got = cp.pack_balanced(df, with_ids=True, **options).collect()
    capacity = options.get("capacity", 4096)
    want = defaultdict(list)
    for i, t in texts:
        want[i].append(tokenizer.encode(t or "", add_special_tokens=False).ids + [2])
    bins, docs = defaultdict(list), defaultdict(list)
    for r in got:
        ids = np.array(r["ids"], "<u4")
        assert len(ids) == r["length"] > 0 and zlib.crc32(ids.tobytes()) == r["ids_crc32"]
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
        docs[r["doc_id"]].append((r["doc_tokens"], r["start"], list(r["ids"])))
    assert docs.keys() == want.keys()
    for i, lists in want.items():
        left = sorted(docs[i])
        for ids in sorted(lists, key=len):  # rows that share an id: pieces of equal starts are of the same text or length
            at = 0
            while at < len(ids):
                piece = next(p for p in left if p[0] == len(ids) and p[1] == at and p[2] == ids[at:at + len(p[2])])
                left.remove(piece)
                at += len(piece[2])
        assert not left
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity and at & (at - 1) == 0
    return got, bins


def test_messy_documents(spark, tokenizer):
    texts = [(r[0], r[1]) for r in rows()]
    _check(messy(spark), texts, tokenizer)
    _check(messy(spark).coalesce(1), texts, tokenizer, capacity=64, shard_tokens=1024)
    assert cp.pack_balanced(empty(spark)).collect() == []


def test_null_ids_and_repeats(spark, tokenizer):
    data = [(None, "one two three"), (None, None), (None, "one two three"), (7, ""), (7, ""), (8, "a b c d e f")]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in data], "doc_id long, text string, Doc_ID string, length string")
    _check(df, data, tokenizer)


def test_driver_documents(spark, tokenizer):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    got, bins = _check(df, [(r["doc_id"], r["text"]) for r in df.collect()], tokenizer)
    costs = {r["sequence_id"]: r for r in cp.sequence_costs(cp.pack_balanced(df)).collect()}
    assert sum(r["tokens"] for r in costs.values()) == sum(r["length"] for r in got)


def test_invalid_utf8_does_not_end_the_job(spark):
    df = spark.sql("SELECT 1L AS doc_id, cast(X'61FF6220C3' AS string) AS text")
    assert sum(r["length"] for r in cp.pack_balanced(df).collect()) >= 2


def _plain(lengths, rooms, linear):
    """The method said plainly: longest first, lowest-cost sequence that holds it, else cut at the lowest-cost open one."""
    todo, cost, left, out = sorted((-n, i, 0) for i, n in enumerate(lengths)), [0] * len(rooms), list(rooms), []
    while todo:
        n, i, start = todo.pop(0)
        fits = [s for s in range(len(rooms)) if left[s] >= -n] or [s for s in range(len(rooms)) if left[s]]
        s = min(fits, key=lambda s: (cost[s], s))
        part = min(-n, left[s])
        out.append((i, start, part, s, rooms[s] - left[s]))
        left[s] -= part
        cost[s] += linear * part + part * part
        if part < -n:
            todo = sorted([*todo, (n + part, i, start + part)])
    return out


def test_balance_is_the_greedy():
    rng = random.Random(3)
    for _ in range(30):
        lengths = [rng.randint(1, 64) for _ in range(rng.randint(1, 80))]
        rooms = cp.room_of(sum(lengths), 64)
        assert sum(rooms) == sum(lengths) and all(r & (r - 1) == 0 for r in rooms)
        assert cp.balance(lengths, rooms, 10) == _plain(lengths, rooms, 10)


def test_costs_are_closer_than_by_first_fit():
    rng = np.random.default_rng(1)
    lengths = np.minimum(rng.lognormal(5.5, 1.2, 6000).astype(int) + 1, 2500).tolist()
    rooms = cp.room_of(sum(lengths))
    full = sum(r == 4096 for r in rooms)

    def spread(placed):
        cost = np.zeros(len(rooms))
        for _, _, n, s, _ in placed:
            cost[s] += cp.piece_cost(n)
        return cost[:full].std() / cost[:full].mean()

    first, free = [], np.array(rooms)
    for i in np.argsort(lengths)[::-1]:
        n = lengths[i]
        while n:
            s = int(np.argmax(free >= n)) if (free >= n).any() else int(np.argmax(free > 0))
            part = min(n, int(free[s]))
            first.append((i, 0, part, s, 0))
            free[s] -= part
            n -= part
    placed = cp.balance(lengths, rooms)
    assert spread(placed) < 0.5 * spread(first)
    assert len(placed) - len(lengths) <= len(rooms)  # at most one cut for each sequence


def test_plain_words_are_not_tokenised_one_by_one_as_texts(tokenizer, monkeypatch):
    encoder = cp._worker_encoder(open(cp.default_tokenizer(), encoding="utf-8").read())

    encoder.encode([b". ,"])  # signs alone are no words

    class Model:
        model = tokenizer.model

        def encode_batch_fast(self, texts, **kwargs):
            raise AssertionError(f"whole tokenizer called for {texts}")

    monkeypatch.setattr(encoder, "tokenizer", Model())
    text = "Zwölf plainish wordings, unseenly before; élégantes... " * 3
    assert encoder.encode([text.encode()])[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids
