"""Spelling variants against a brute-force version."""

import random
import re
import zlib
from collections import Counter

import pytest
from messy import empty, messy, rows

from stayframe.llm import spelling

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_words(docs, least=6, count=5, every=199):
    n = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= least and c >= count}


def is_near(u, v):
    if len(u) > len(v):
        u, v = v, u
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    return len(v) == len(u) + 1 and any(v[:i] + v[i + 1:] == u for i in range(len(v)))


def brute(docs, **options):
    n = brute_words(docs, **options)
    by_size = {}
    for w in n:
        by_size.setdefault(len(w), []).append(w)
    near = {w: [v for d in (-1, 0, 1) for v in by_size.get(len(w) + d, ()) if is_near(w, v)] for w in n}
    form = {}
    for w, others in near.items():
        if others:
            top = min(others, key=lambda v: (-n[v], v))
            if n[top] >= 5 * n[w]:
                form[w] = top
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return out


def _same(df, docs, expect_some=True, **options):
    brute_options = {{"least_letters": "least", "least_count": "count", "errors_every": "every"}[k]: v for k, v in options.items()
                     if k != "range_words"}
    got = [tuple(r) for r in spelling.variants(df, **options).collect()]
    assert len(got) == len(set(got))
    want = brute(docs, **brute_options)
    assert set(got) == want
    assert not expect_some or any(g[1] for g in got)
    return got


def test_messy_and_empty(spark):
    _same(messy(spark), [(r[0], r[1]) for r in rows()], False)
    assert spelling.variants(empty(spark)).collect() == []


def test_driver_documents(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    _same(df, [(r["doc_id"], r["text"]) for r in df.collect()], False, least_letters=3, errors_every=7)


@pytest.mark.parametrize("seed", [1, 2])
def test_dense_words_over_many_ranges(spark, seed):
    """Few letters, so that most words are near many others and prefixes run over the borders of ranges."""
    rng = random.Random(seed)
    letters = "abé"
    vocabulary = ["".join(rng.choice(letters) for _ in range(rng.randint(3, 7))) for _ in range(150)]
    vocabulary += ["a" * k for k in range(3, 12)] + ["b" * 40 + w for w in ("a", "b", "é", "ab", "ba")]
    docs = [(rng.choice([None, *range(40)]), " ".join(rng.choice(vocabulary) * 1 for _ in range(rng.randint(0, 90))).title())
            for _ in range(120)]
    hot = [(1, " ".join(vocabulary[:12] * 40))] * 3 + [(2, None), (3, "")]
    docs += hot
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, Word int, n string").repartition(5)
    got = _same(df, docs, least_letters=3, least_count=2, errors_every=5)
    assert max(g[4] for g in got) > 3


def test_chains_of_forms(spark):
    words = {"abcdefgh": 3125, "abcdefg": 625, "abcdef": 125, "abcdeX".lower(): 25, "abcdxx": 5, "zzzzzz": 5}
    docs = [(i, " ".join([w] * n)) for i, (w, n) in enumerate(words.items())]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["word"]: r for r in spelling.variants(df, errors_every=1 << 40).collect()}
    assert {w: got[w]["root"] for w in words} == {w: "zzzzzz" if w == "zzzzzz" else "abcdefgh" for w in words}
    assert got["abcdef"]["form"] == "abcdefg" and got["zzzzzz"]["n_near"] == 0


def test_long_runs_and_parts(spark):
    long_run = "q" * 30_000
    docs = [(i, f"{long_run} {long_run}x " * 3) for i in range(4)]
    _same(spark.createDataFrame(docs, "doc_id long, text string"), docs, False)
    pattern = re.compile(f"[{spelling.LETTERS}]{{2,}}")
    text = "Aé bc defÀ ghij " * 50 + "x" * 100
    whole = Counter(pattern.findall(text.translate(LOWER)))
    for budget in (1, 7, 64):
        assert sum(spelling.runs(text.encode(), pattern, budget), Counter()) == whole


def test_numbers_are_those_of_one_trie():
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(1, 9))) for _ in range(300)})
    for step in (1, 7, 50):
        borders = spelling.Borders([words[min(i + step, len(words)) - 1] for i in range(0, len(words), step)])
        for k, word in enumerate(borders.last):
            path = borders.path(k)
            assert len(path) == len(word) + 1
            for p in range(1, len(word) + 1):
                owner = next(j for j, other in enumerate(borders.last) if other[:p] == word[:p])
                assert path[p] == (owner << 40) + p
