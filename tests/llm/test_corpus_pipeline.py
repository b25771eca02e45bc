"""Each stage of the corpus pipeline against brute force on what the stage before kept."""

import re
from collections import Counter

import corpus_pipeline
import pytest
import regex
from messy import messy, rows
from test_packing import _placed
from test_simhash import brute_components, brute_fingerprint

from stayframe.llm import langid, mixing, packing

SF = "/root/testdata/sf0.001"


def _run_stages(spark, docs, folder):
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, out[-1], SF).write.parquet(f"{folder}/{name}")
        out.append(spark.read.parquet(f"{folder}/{name}"))
    return out


@pytest.mark.parametrize("which", ["driver", "messy"])
def test_stages(spark, tmp_path, which):
    docs = spark.read.parquet(f"{SF}/documents.parquet") if which == "driver" else messy(spark)
    docs = docs.toDF(*[c if c != "Text" else "extra" for c in docs.columns])  # Parquet needs names that differ beyond case
    start, lang, exact, near, mixed, packed = _run_stages(spark, docs, tmp_path)
    for stage in (lang, exact, near, mixed):
        assert stage.columns == docs.columns

    def texts(df):
        return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]

    kept = Counter((i, t) for i, t in texts(start) if t and regex.search(r"\p{L}", t))
    if langid.training_sample(start):
        assert Counter(texts(lang)) == kept
    first = {}
    for i, t in texts(lang):
        key = re.sub(r"[\x20\x09-\x0D]+", " ", t)
        first[key] = min(i, first.get(key, i))
    assert sorted(i for i, _ in texts(exact)) == sorted(first.values())
    prints = {i: brute_fingerprint(t) for i, t in texts(exact)}
    assert sorted(i for i, _ in texts(near)) == sorted(set(brute_components(prints).values()))
    plan = {r["doc_id"]: r["copies"] for r in mixing.mix_plan(near).collect()}
    assert Counter(i for i, _ in texts(mixed)) == Counter({i: n for i, n in plan.items() if n})
    got = packed.collect()
    _placed(got)
    pieces = Counter((r["doc_id"], r["piece"], r["ids_crc32"]) for r in packing.pieces(mixed).collect())
    assert Counter((r["doc_id"], r["piece"], r["ids_crc32"]) for r in got) == pieces


def test_run_equals_the_stages(spark, tmp_path):
    got = corpus_pipeline.run(spark, SF)
    want = _run_stages(spark, spark.read.parquet(f"{SF}/documents.parquet"), tmp_path)[-1]
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert Counter(map(tuple, got.select(cols).collect())) == Counter(map(tuple, want.select(cols).collect()))


def test_messy_table_has_repeats():
    ids = [r[0] for r in rows()]
    assert len(ids) > len(set(ids))
