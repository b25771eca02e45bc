"""Byte and word repeats against brute force over all windows."""

import hashlib
import random

import numpy as np
import pytest
from messy import empty, messy, rows, texts

from stayframe.llm import fm_dedup, repeats, suffix_dedup


def brute(docs: dict, tokens, width: int, every: bool) -> dict[int, np.ndarray]:
    places: dict = {}
    split = {i: tokens(t) for i, t in docs.items()}
    for i in sorted(docs, key=lambda i: (i is not None, i or 0)):
        for p in range(len(split[i]) - width + 1):
            places.setdefault(tuple(split[i][p:p + width]), []).append((i, p))
    gone = {i: np.zeros(len(s), bool) for i, s in split.items()}
    for found in places.values():
        for i, p in (found if every and len(found) > 1 else found[1:]):
            gone[i][p:p + width] = True
    return gone


def expected_bytes(docs, width):
    gone = brute(docs, lambda t: t.encode(), width, False)
    out = {}
    for i, g in gone.items():
        raw = np.frombuffer(docs[i].encode(), np.uint8)
        spans = int(np.count_nonzero(np.diff(np.r_[0, g.astype(int)]) == 1))
        out[i] = (len(raw), int(g.sum()), spans, hashlib.sha256(raw[~g].tobytes()).hexdigest())
    return out


def expected_words(docs, width):
    gone = brute(docs, lambda t: t.encode().split(), width, True)
    out = {}
    for i, g in gone.items():
        words = docs[i].encode().split()
        kept = b" ".join(w for w, x in zip(words, g) if not x)
        out[i] = (len(words), int(g.sum()), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("hot", [repeats.HOT, 1])  # 1: every shared anchor is crowded
def test_messy_documents(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats.removals, "__defaults__", (hot,))
    got = suffix_dedup.remove_repeats(messy(spark)).collect()
    assert len(got) == len(rows())
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == expected_bytes(texts(), 100)
    got = fm_dedup.remove_repeats(messy(spark)).collect()
    assert len(got) == len(rows())
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == expected_words(texts(), 35)


def test_driver_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs = {r["doc_id"]: r["text"] or "" for r in df.collect()}
    got = suffix_dedup.remove_repeats(df).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == expected_bytes(docs, 100)
    got = fm_dedup.remove_repeats(df).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == expected_words(docs, 35)


def test_null_ids_and_kept_text(spark):
    long = " ".join(f"w{i}" for i in range(50))
    df = spark.createDataFrame([(None, long), (1, "x " + long), (2, None)], "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(df, with_kept=True).collect()}
    assert got[None]["n_removed"] == 0 and bytes(got[1]["kept"]) == b"x " and got[2]["n_bytes"] == 0
    got = {r["doc_id"]: r for r in fm_dedup.remove_repeats(df, with_kept=True).collect()}
    assert got[None]["kept"] == "" and got[1]["kept"] == "x" and got[2]["n_words"] == 0


@pytest.mark.parametrize("hot", [repeats.HOT, 1])
def test_rows_without_or_with_equal_ids_are_documents_of_their_own(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats.removals, "__defaults__", (hot,))
    rng = random.Random(11)
    word = lambda n: " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(10**6)}" for _ in range(n))
    shared, clean, other, twice, twin = word(60), word(50), word(9), word(80), word(70)
    table = [(None, word(40) + " " + shared), (None, clean), (None, other), (7, shared + " tail"), (8, twice), (8, "x " + twice),
             (8, word(50)), (None, twin), (None, twin)]
    df = spark.createDataFrame(table, "doc_id bigint, text string").repartition(3)
    docs = {(i is not None, i or 0, n): t for n, (i, t) in enumerate(table)}

    def result(gone, tokens, glue):
        return sorted((-1 if k[0] is False else k[1], len(g), int(g.sum()),
                       hashlib.sha256(glue.join(w for w, x in zip(tokens(docs[k]), g) if not x)).hexdigest()) for k, g in gone.items())

    def split(t):
        return t.encode().split()

    got = fm_dedup.remove_repeats(df).collect()
    want = result(brute(docs, split, 35, True), split, b" ")
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got) == want
    got = suffix_dedup.remove_repeats(df, with_kept=True).collect()
    assert len(got) == len(table)
    left = sorted((r["doc_id"] or -1, r["n_bytes"], r["n_removed"]) for r in got)
    n = {t: len(t) for _, t in table}
    assert [x for x in left if x[0] == 7] == [(7, n[shared + " tail"], len(shared))]
    assert [x[2] for x in left if x[:2] == (-1, n[clean])] == [0] and [x[2] for x in left if x[:2] == (-1, n[other])] == [0]
    assert [x[2] for x in left if x[:2] == (-1, n[twin])] == [0, len(twin)]  # one of two equal texts stays
    assert sorted(x[2] for x in left if x[0] == 8) == [0, 0, len(twice)]
    assert all(len(r["kept"]) == r["n_bytes"] - r["n_removed"] for r in got)


def crowd(n: int) -> dict[int, str]:
    """Documents around one passage, most with texts of their own before and behind it, some equal there."""
    rng = random.Random(5)
    own = lambda k: " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(10**6)}" for _ in range(k))
    passage, tails = own(45), [own(30) for _ in range(3)]
    return {i: f"{own(30)} {passage} {rng.choice(tails) if i % 4 == 0 else own(30)}" for i in range(n)}


@pytest.mark.parametrize("hot", [repeats.HOT, 3])
def test_large_corpora_go_class_by_class(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats.removals, "__defaults__", (hot,))
    monkeypatch.setattr(repeats, "_ONE_PASS", 0)
    stored = []

    def noted(df, name, codec=None):
        out = store(df, name, codec)
        stored.append((name, out.count()))
        return out

    store = repeats.store
    monkeypatch.setattr(repeats, "store", noted)
    docs = crowd(24)
    df = spark.createDataFrame([*docs.items(), (3, docs[3]), (99, None)], "doc_id bigint, text string").repartition(3)
    docs[99] = ""
    got = suffix_dedup.remove_repeats(df).collect()
    assert len(got) == 26 and {r["doc_id"]: tuple(r)[1:] for r in got} == expected_bytes(docs, 100)
    for name in ("segments", "groups"):  # no class holds the most of the rows
        sizes = [n for x, n in stored if x == name]
        assert len(sizes) >= repeats.PASSES and max(sizes) < 0.6 * sum(sizes)
    got = fm_dedup.remove_repeats(df).collect()
    assert len(got) == 26 and {r["doc_id"]: tuple(r)[1:] for r in got} == expected_words(docs, 35)


def test_crowded_anchors_do_not_store_all_their_windows(spark, monkeypatch):
    stored, store, shares = {}, repeats.store, []

    def noted(df, name, codec=None):
        out = store(df, name, codec)
        stored[name] = stored.get(name, 0) + out.count()
        if name == "segments":
            shares.append(out.agg({"windows": "sum"}).first()[0])
        return out

    monkeypatch.setattr(repeats, "store", noted)
    monkeypatch.setattr(repeats.removals, "__defaults__", (3,))
    docs = crowd(40)
    df = spark.createDataFrame([*docs.items()], "doc_id bigint, text string")
    got = suffix_dedup.remove_repeats(df).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == expected_bytes(docs, 100)
    assert stored["pieces"] and stored["windows"] + stored["pieces"] < 0.3 * sum(shares)


@pytest.mark.parametrize("words", [False, True])
def test_pieces_hold_each_window_once_and_equal_windows_under_one_key(spark, words):
    rng = random.Random(2)
    unit = repeats.Unit(words, 20, 5)
    docs = [bytes(rng.choice(b"abc") for _ in range(60)) for _ in range(25)]
    docs += [d[:25] + bytes(rng.choice(b"abc") for _ in range(9)) + d[30:] for d in docs]
    if words:
        docs = [b" ".join(bytes([x]) for x in d) for d in docs]
    toks = [repeats.tokens_of(d, words) for d in docs]
    ends = np.r_[0, np.cumsum([len(t) for t in toks])]
    rows, whole = [], {}
    for d, a, n, route in zip(*repeats.segments_of(np.concatenate(toks), ends, unit)):
        parts, a = docs[d].split(b" ") if words else docs[d], int(a - ends[d])
        body = parts[a:a + n + unit.width - 1]
        rows.append((int(route.view(np.int64)), bytearray(b" ".join(body) if words else body), int(d), 0, a))
        whole |= {(int(d), a + o): tuple(parts[a + o:a + o + unit.width]) for o in range(n)}
    df = spark.createDataFrame(rows, "route bigint, content binary, doc bigint, sub bigint, start bigint")
    seen, key = {}, {}
    for r in repeats._pieces(df, unit).collect():
        parts = bytes(r["content"]).split(b" ") if words else bytes(r["content"])
        assert r["windows"] == len(parts) - unit.width + 1 <= repeats.BLOCK
        for o in range(r["windows"]):
            window = tuple(parts[o:o + unit.width])
            assert (r["doc"], r["start"] + o) not in seen and key.setdefault(window, r["route"]) == r["route"]
            seen[r["doc"], r["start"] + o] = window
    assert seen == whole


def test_empty_table(spark):
    assert suffix_dedup.remove_repeats(empty(spark)).count() == 0
    assert fm_dedup.remove_repeats(empty(spark)).count() == 0


def test_anchors_follow_content():
    rng = random.Random(1)
    for _ in range(60):
        width = rng.randint(3, 9)
        unit = repeats.Unit(False, width, rng.randint(1, width))
        docs = [bytes(rng.choice(b"ab") for _ in range(rng.randint(width, 40))) for _ in range(4)]
        ends = np.r_[0, np.cumsum([len(d) for d in docs])]
        doc, start, windows, route = repeats.segments_of(
            np.concatenate([repeats.tokens_of(d, False) for d in docs]), ends, unit)
        assert windows.sum() == sum(len(d) - width + 1 for d in docs)
        anchor: dict[bytes, int] = {}
        for d, a, n, v in zip(doc, start - ends[doc], windows, route):
            inside = [docs[d][a + o:a + o + width] for o in range(n)]
            assert len(set(inside)) == n  # equal windows never share a segment
            assert all(anchor.setdefault(w, v) == v for w in inside)


def test_shard_searches_against_bytes():
    rng = random.Random(3)
    for _ in range(80):
        width = rng.randint(4, 12)
        base = bytes(rng.choice(b"abc") for _ in range(60))
        parts = []
        for _ in range(rng.randint(2, 9)):
            a = rng.randint(0, 30)
            c = bytearray(base[a:a + width + rng.randint(0, 15)])
            if rng.random() < 0.5:
                c[rng.randrange(len(c))] = ord("z")
            parts.append(bytes(c))
        route = np.sort(np.array([rng.randint(0, 1) for _ in parts]))
        doc, start = np.array(rng.sample(range(20), len(parts))), np.array([rng.randint(0, 4) for _ in parts])
        got = suffix_dedup.later_windows(parts, route, doc, start, width)
        want = suffix_dedup._by_bytes(parts, route, doc, start, width)
        assert sorted(zip(*map(list, got))) == sorted(zip(*map(list, want)))
        seen: dict = {}
        for i, c in enumerate(parts):
            for o in range(len(c) - width + 1):
                seen.setdefault(c[o:o + width], []).append((i, o))
        got = fm_dedup.repeated_windows([b" ".join(bytes([x]) for x in c) for c in parts], width)
        assert set(zip(*map(list, got))) == {p for v in seen.values() if len(v) > 1 for p in v}


def test_hash_collisions_fall_back_to_bytes(monkeypatch):
    monkeypatch.setattr(suffix_dedup.PrefixHashes, "of", lambda self, at, length: np.zeros(len(at), np.uint64))
    parts = [b"samehead" + b"a" * 12, b"samehead" + b"b" * 12, b"samehead" + b"a" * 12]
    at = np.array([0, 0, 0])
    got = suffix_dedup.later_windows(parts, at, np.array([1, 2, 3]), at, 20)
    assert list(zip(*map(list, got))) == [(2, 0)]
