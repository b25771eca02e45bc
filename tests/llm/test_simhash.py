"""Fingerprints, links and components against brute force."""

import random
import re
from collections import Counter

import numpy as np
import xxhash
from messy import empty, messy, rows

from stayframe.llm import simhash
from stayframe.llm.components import connected_components

SF = "/root/testdata/sf0.001"


def brute_fingerprint(text: str | None) -> int:
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    bits = Counter()
    for g in grams:
        h = xxhash.xxh64_intdigest(g.encode(), 42)
        bits.update(i for i in range(64) if h >> i & 1)
    return sum(1 << i for i in range(64) if 2 * bits[i] > len(grams))


def brute_components(prints: dict[int, int]) -> dict[int, int]:
    ids, root = sorted(prints), {i: i for i in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def _check(df, texts: dict[int, str], n_rows: int):
    got = simhash.near_duplicates(df).collect()
    prints = {i: brute_fingerprint(t) for i, t in texts.items()}
    want = brute_components(prints)
    assert len(got) == n_rows
    for r in got:
        assert r["fingerprint"] == f"{prints[r['doc_id']]:016x}" and r["component_id"] == want[r["doc_id"]]


def test_messy_documents(spark):
    _check(messy(spark), {r[0]: r[1] for r in rows()}, len(rows()))
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_driver_documents(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    docs = {r["doc_id"]: r["text"] for r in df.collect()}
    _check(df, docs, len(docs))


def test_null_ids_link_nothing(spark):
    df = spark.createDataFrame([(None, "a b c d"), (9, "A b c d"), (None, "zz yy xx ww vv")], "doc_id bigint, text string")
    got = {(r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(df).collect()}
    assert got == {(None, 9), (9, 9), (None, None)}


def test_long_text_in_pieces():
    text = " ".join(f"w{i % 977}" for i in range(40_000))
    assert simhash.fingerprint(text.encode()) == brute_fingerprint(text)


def test_every_close_pair_shares_a_cell():
    rng = random.Random(5)
    masks = simhash.cell_masks()
    assert len(masks) == 20

    def embed(x):
        low, high = x & simhash._LOW, x >> 1 & simhash._LOW
        return (low | high) | (low & high) << 1

    for _ in range(3000):
        a = rng.getrandbits(64)
        b = a
        for i in rng.sample(range(64), rng.randint(0, 3)):
            b ^= 1 << i
        assert (embed(a) ^ embed(b)).bit_count() <= (a ^ b).bit_count()  # the bound
        assert any(embed(a) & m == embed(b) & m for m in masks)


def test_cells_give_a_spanning_forest():
    rng = np.random.default_rng(2)
    for size in (5, 24, 25, 300):
        base = rng.integers(0, 2 ** 63, dtype=np.uint64)
        flips = rng.integers(0, 64, (size, 3))
        fp = np.array([base ^ np.uint64(1 << int(a)) ^ np.uint64(1 << int(b)) ^ np.uint64(1 << int(c)) for a, b, c in flips])
        fp = np.unique(fp)
        node = np.arange(len(fp))
        left, right = simhash.cell_links(np.zeros((len(fp), 2), np.int64), fp, node, 3)
        if len(fp) > simhash._PAIRWISE:
            assert len(left) < len(fp)
        want = brute_components(dict(enumerate(fp.tolist())))
        root = list(range(len(fp)))
        for _ in range(len(fp)):
            for a, b in zip(left, right):
                root[a] = root[b] = min(root[a], root[b])
        assert dict(enumerate(root)) == want


def test_components_of_chains_and_stars(spark):
    rng = random.Random(1)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 540)] + [(7, 539)]
    edges = chain + star + [(3, 3), (900, 901), (901, 900)]
    rng.shuffle(edges)
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = {i: 100 for i in range(101, 161)} | {i: 7 for i in range(500, 540)} | {901: 900}
    assert got == want
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_keep_one_row_per_component(spark):
    df = messy(spark)
    kept = simhash.keep_one(df)
    classes = {r["component_id"] for r in simhash.near_duplicates(df).collect()}
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(classes)
