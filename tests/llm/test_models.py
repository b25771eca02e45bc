"""Language identification, toxicity and language-model scores."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import zstandard
from messy import empty, messy, rows

from stayframe.llm import langid, lm_score, toxicity

SF = "/root/testdata/sf0.01"


def _crc(i, m):
    return zlib.crc32(str(i).encode()) % m


@pytest.fixture(scope="module")
def driver(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_languages_of_driver_documents(spark, driver):
    truth = {r["doc_id"]: r["lang"] for r in driver.select("doc_id", "lang").collect()}
    got = langid.identify(driver).collect()
    held = [r for r in got if r["held_out"]]
    assert len(got) == len(truth) and all(r["held_out"] == (_crc(r["doc_id"], 5) == 0) for r in got)
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_edges(spark, driver):
    odd = spark.createDataFrame([(1000, None), (1001, ""), (1002, "12 $$ !!"), (None, "the and of with"), (1003, "ЖЖ"), (1004, "a")],
                                "doc_id bigint, text string")
    df = driver.select("doc_id", "text", "lang").unionByName(odd, allowMissingColumns=True)
    got = {r["doc_id"]: r for r in langid.identify(df).collect()}
    assert [got[i]["lang_pred"] for i in (1000, 1001, 1002)] == ["und"] * 3 and got[1001]["score"] == 0.0
    assert got[None]["lang_pred"] == "en" and got[1003]["lang_pred"] in {"en", "de", "fr", "es"} and got[1004]["score"] > 0
    assert langid.identify(empty(spark)).count() == 0
    unlabelled = driver.limit(5).selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")
    assert {r["lang_pred"] for r in langid.identify(unlabelled).collect()} == {"und"}
    assert len(langid.identify(messy(spark)).collect()) == len(rows())


def test_language_ignores_lang_of_what_it_predicts(spark, driver):
    """Labels of the held-out fold, ids and sources do not reach a prediction."""
    from pyspark.sql import functions as F
    a = {r["doc_id"]: r["lang_pred"] for r in langid.identify(driver).collect()}
    changed = driver.withColumn("lang", F.when(langid.crc32_remainder(F.col("doc_id"), 5) == 0, "xx").otherwise(F.col("lang")))
    assert a == {r["doc_id"]: r["lang_pred"] for r in langid.identify(changed.withColumn("source", F.lit("s"))).collect()}


def test_kernel_scores_are_the_kernel_regression():
    """The folded matrix gives what the kernel against landmarks gives."""
    sample = [("a", f"abab abba baab {i}".encode()) for i in range(8)] + [("b", f"xyxy xxyy yxyx {i}".encode()) for i in range(8)]
    model = langid.KernelModel.fit(sample, landmarks=4)
    assert model.predict([b"abba abab", b"yxxy yxyx"], model.table())[0] == ["a", "b"]
    long = b"abab abba " * 200_000  # more than one part
    assert model.predict([long], model.table())[0] == ["a"]


def test_language_keeps_every_landmark_ngram():
    """A language with two labelled texts in its own script keeps its n-grams beside three with many."""
    rng = np.random.default_rng(5)

    def text(letters):
        return " ".join("".join(rng.choice(list(letters), 6)) for _ in range(400)).encode()

    alphabets = {"a": "abcdefghijklmnop", "b": "hijklmnopqrstuvw", "c": "qrstuvwxyzabcdef", "r": "жшщыэюяфцчъбдлпт"}
    sample = [(lang, text(letters)) for lang, letters in alphabets.items() for _ in range(2 if lang == "r" else 40)]
    model = langid.KernelModel.fit(sample)
    grams = {g for _, t in sample for g in langid._grams(t).tolist()}
    assert set(model.keys.tolist()) == grams and len(grams) > 1 << 14
    assert model.predict([text(alphabets["r"]), "жш".encode(), text(alphabets["b"])], model.table())[0] == ["r", "r", "b"]
    padded = np.append(model.keys, np.uint64(0))
    for _, t in sample[::20]:  # also n-grams that share a slot are found
        got = model.keys[langid.KernelModel.present(t, model.keys, padded, model.table())]
        assert set(got.tolist()) == set(langid._grams(t).tolist())


def test_stage_without_labels_keeps_texts_with_letters(spark):
    df = spark.createDataFrame([(1, "some text"), (2, "жш"), (3, None), (4, "12 $$"), (None, "more")], "doc_id bigint, text string")
    got = langid.accepted(df.selectExpr("*", "CAST(NULL AS STRING) AS lang")).collect()
    assert {(r["doc_id"], r["text"]) for r in got} == {(1, "some text"), (2, "жш"), (None, "more")}


def test_toxicity_of_held_out_documents(spark, driver):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    got = {r["doc_id"]: r for r in toxicity.score(driver, labels).collect()}
    assert len(got) == driver.count() and all(r["held_out"] == (_crc(i, 3) == 1) for i, r in got.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got.values())
    held = [i for i in truth if got[i]["held_out"]]
    caught = [got[i]["predicted"] for i in held if truth[i]]
    false = [got[i]["predicted"] for i in held if not truth[i]]
    assert np.mean(caught) > 0.8 and np.mean(false) < 0.03


def test_toxicity_edges(spark, driver):
    labels = spark.createDataFrame([(1, None), (None, 1), (2, 1), (2, 0), (4, 0)], "doc_id bigint, toxic int")
    assert len(toxicity.score(messy(spark), labels).collect()) == len(rows())
    assert toxicity.score(empty(spark), labels).count() == 0
    got = toxicity.score(messy(spark), labels.limit(0)).collect()
    assert {(r["score"], r["predicted"]) for r in got} == {(0.0, 0)}


def test_label_model_recovers_accuracies():
    rng = np.random.default_rng(0)
    y = (rng.random(4000) < 0.3).astype(int)
    def voter(hit, false):
        return np.where(rng.random(4000) < np.where(y == 1, hit, false), 2, 0)
    a = voter(0.9, 0.05)
    v = np.stack([a, a, voter(0.8, 0.1), voter(0.7, 0.2), voter(0.95, 0.02)], axis=1)
    post, prob, corr = toxicity.label_model(v, v[:, -1] // 2)
    assert abs(prob[2, 1, 2] - 0.8) < 0.05 and abs(prob[3, 0, 2] - 0.2) < 0.05
    assert corr[0, 1] > 0.9 > 0.3 > abs(corr[0, 2])
    assert ((post > 0.5) == y).mean() > 0.95


def _base(texts):
    train = Counter()
    for i, t in texts:
        if _crc("" if i is None else i, 7) != 2:
            train.update((t or "").encode().lower().split())
            train["end"] += 1
    n, v = sum(train.values()), len(train)
    out = {}
    for i, t in texts:
        tokens = [*(t or "").encode().lower().split(), "end"]
        out[i] = (len(tokens), sum(w in train for w in tokens), n,
                  sum(np.log10((train.get(w, 0) + 1) / (n + v + 1)) for w in tokens))
    return out


def _check_base(got, texts):
    want = _base(texts)
    assert len(got) == len(texts)
    for r in got:
        w = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == w[:3] and r["base_score"] == pytest.approx(w[3])
        assert r["score"] < 0 and r["bits_per_byte"] > 0


def test_lm_base_and_model_on_driver_documents(spark, driver):
    texts = [(r["doc_id"], r["text"]) for r in driver.collect()]
    got = lm_score.score(driver, lot_bytes=1 << 20).collect()
    _check_base(got, texts)
    held = [r for r in got if r["held_out"]]
    assert np.mean([r["bits_per_byte"] for r in held]) < 2.6  # bytes of one of these languages: 4.2 bits by frequency alone
    again = {r["doc_id"]: r["score"] for r in lm_score.score(driver.repartition(5), lot_bytes=1 << 19).collect()}
    assert all(again[r["doc_id"]] == pytest.approx(r["score"]) for r in got)


def test_lm_edges(spark):
    _check_base(lm_score.score(messy(spark)).collect(), [(r[0], r[1]) for r in rows()])
    assert lm_score.score(empty(spark)).count() == 0
    lone = spark.createDataFrame([(next(i for i in range(99) if _crc(i, 7) == 2), "a b"), ], "doc_id bigint, text string")
    r = lm_score.score(lone).collect()[0]
    assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) == (3, 0, 0, 0.0) and r["score"] < 0


def _states(raw, code):
    """The tables' states, counted position by position."""
    sums = np.zeros((code.slots, 3), np.int64)
    contexts = lm_score.Contexts(raw)
    for c in range(lm_score._CONTEXTS):
        for on, node, bit in lm_score._nodes(contexts.byte[contexts.code], code):
            slot, check = lm_score._slots(contexts.ctx[c][contexts.code][on], node, c, code)
            np.add.at(sums, (slot, bit), 1)
            np.add.at(sums, (slot, 2), check.astype(np.int64))
    n = sums[:, :2].sum(axis=1)
    odds = np.clip(np.log((sums[:, 1] + 0.4) / (sums[:, 0] + 0.4)) * 14, -127, 127).round().astype(int) + 128
    conf = np.minimum(7, np.floor(np.log2(n + 1.0))).astype(int)
    return np.where(n > 0, odds << 8 | conf << 5 | np.round(sums[:, 2] / np.maximum(n, 1)).astype(int), 0).astype(np.uint16)


def test_lm_probabilities_sum_to_one():
    """Over all next bytes the model's probabilities add up to 1."""
    text = lm_score.stream(b"the cat and the hat and the bat sat on the mat " * 40)
    raw = np.frombuffer(text, np.uint8)
    code = lm_score.Code(np.bincount(raw, minlength=256))
    model = lm_score.MixingModel(code, _states(raw, code))
    model.learn(raw)
    total = sum(10 ** model.log10(np.frombuffer(b"the ca" + bytes([b]), np.uint8))[-1] for b in range(256))
    assert total == pytest.approx(1.0, abs=1e-3)
    assert model.log10(raw).mean() > -0.35


def test_lm_score_is_brute_force_over_a_small_corpus(spark):
    """Every count, the mix and the word shares written out: one position, one bit at a time."""
    rng = random.Random(6)
    words = ["alpha", "beta", "Gamma", "été", "x1"]
    docs = [(i, None if i == 4 else " ".join(rng.choice(words) for _ in range(rng.randint(0, 30)))) for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in lm_score.score(df, lot_bytes=300).collect()}
    model = lm_score.fit(df.selectExpr("doc_id", "coalesce(text, '') AS text"))
    train = [(t or "").encode() for i, t in docs if _crc(i, 7) != 2]
    code = model.code
    raw = np.frombuffer(b"".join(map(lm_score.stream, train)), np.uint8)
    assert (model.states == _states(raw, code)).all()  # after learning, the tables count all training documents
    tokens = [w for t in train for w in [*t.lower().split(), None]]
    for i, text in docs:
        body = lm_score.stream((text or "").encode())
        own = np.frombuffer(body, np.uint8)
        contexts = lm_score.Contexts(own)
        ps = []
        for at, k in enumerate(contexts.code):
            p = 1.0
            for on, x, gate, bit in model.levels(contexts):
                for j in np.flatnonzero(on == k):
                    dot = float(np.dot(x[j], model.weights[gate[j]] + model.by_byte[contexts.previous[k]]))
                    dot = max(-12.0, min(12.0, dot))
                    cell = int(np.clip(np.round(dot * 2) + 16, 0, 32))
                    one = min(1 - 1e-6, max(1e-6, 0.5 / (1 + math.exp(-dot)) + 0.5 * model.refine[contexts.previous[k], cell]))
                    p *= one if bit[j] else 1 - one
            ps.append(p)
        total, at = 0.0, 0
        for w in [*(text or "").encode().lower().split(), None]:
            n = 1 if w is None else len(w) + 1
            total += math.log10(0.8 * np.prod(ps[at:at + n]) + 0.2 * tokens.count(w) / len(tokens))
            at += n
        assert got[i]["score"] == pytest.approx(total, rel=1e-4)


def test_lm_words_and_streams():
    """White space, cases and empty texts as the contract has them, by both ways to split."""
    rng = random.Random(4)
    parts = ["a", "B", "é", "É", "x1", " ", "  ", "\t", "\n", "\x0b", "\x0c", "\r", "\u00a0", "\u2003", "\x1c", "\x85", "K"]
    texts = ["", " ", None, *["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(500)]]
    whole = pa.array([t or "" for t in texts])
    words, counts = lm_score.words_of(whole)
    words, at = words.to_pylist(), 0
    for start, size in ((0, 7), (100, 50), (400, 103), (3, 0)):  # slices too
        part, n = lm_score.words_of(whole.slice(start, size))
        assert n.tolist() == counts[start:start + size].tolist()
        assert part.to_pylist() == words[counts[:start].sum():counts[:start + size].sum()]
    for t, n in zip(texts, counts):
        want = (t or "").encode().lower().split()
        assert words[at:at + n] == want
        assert lm_score.stream((t or "").encode()) == b"".join(w + b" " for w in want) + b"\n"
        at += n
    assert at == len(words)


def test_lm_long_texts_keep_their_context():
    """Scored in parts of any size, a text has the probability it has as a whole."""
    rng = random.Random(8)
    text = lm_score.stream(" ".join(rng.choice(["one", "two", "three", "fourteen"]) for _ in range(400)).encode())
    raw = np.frombuffer(text, np.uint8)
    code = lm_score.Code(np.bincount(raw, minlength=256))
    model = lm_score.MixingModel(code, _states(raw, code))
    whole = model.log10(raw)
    for size in (1, 10, 37, 1000):
        cut = list(lm_score.parts(raw, size))
        assert b"".join(p[lead:].tobytes() for lead, p in cut) == text and len(cut) > 1
        logs = []
        for lead, p in cut:
            contexts = lm_score.Contexts(p, lead)
            logs.append(np.zeros(len(contexts.byte)))
            for on, x, gate, bit in model.levels(contexts):
                _, _, q = model.probability(x, gate, contexts.previous[on])
                logs[-1][on] += np.log10(np.where(bit == 1, q, 1 - q))
            logs[-1] = logs[-1][contexts.code]
        assert np.allclose(np.concatenate(logs), whole, atol=1e-5)


def test_lm_tables_grow_and_held_out_documents_beat_the_base(spark, driver):
    sizes = [sum(1 << b for b in lm_score.table_bits(n)) for n in (10 ** 6, 10 ** 8, 10 ** 10, 10 ** 12)]
    assert sizes == sorted(set(sizes)) and 50 < sizes[-1] / sizes[0] < 200  # a third of the powers of 10
    # the base pays one token for an unknown word, the model its spelling: they compare where all words are known
    held = [r for r in lm_score.score(driver, mixer_every=8).collect() if r["held_out"] and r["n_known"] == r["n_tokens"]]
    assert len(held) > 10 and sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_lm_null_and_repeated_ids(spark):
    docs = [(None, "a b c"), (None, "d d"), (None, None), (7, "a b c"), (7, "other words"), (7, "a b c")]
    df = spark.createDataFrame([(i, t, 1, "k") for i, t in docs], "doc_id bigint, text string, lot int, Doc_ID string")
    got = Counter((r["doc_id"], r["n_tokens"], r["n_known"], round(r["base_score"], 9), round(r["score"], 6)) for r in lm_score.score(df).collect())
    each = [(r["doc_id"], r["n_tokens"], r["n_known"], round(r["base_score"], 9), round(r["score"], 6))
            for r in lm_score.score(df, lot_bytes=2).collect()]
    assert got == Counter(each) and sorted(n for i, n, *_ in each if i is None) == [1, 3, 4] and sorted(n for i, n, *_ in each if i == 7) == [3, 4, 4]


def test_lm_weights_and_map_are_learned_from_every_training_document(spark, monkeypatch):
    """The bits that shards learned from are those of all training documents, each once."""
    rng = random.Random(3)
    docs = [(i, " ".join(rng.choice(["one", "two", "drei", "quatre"]) for _ in range(rng.randint(0, 40)))) for i in range(60)]
    seen, learn = [], lm_score.learn_mixer

    def watched(model, learned):
        seen.append([{r["i"]: r["v"] for r in part.collect()} for part in learned])
        learn(model, learned)

    monkeypatch.setattr(lm_score, "learn_mixer", watched)
    model = lm_score.fit(spark.createDataFrame(docs, "doc_id bigint, text string"))
    raw = np.frombuffer(b"".join(lm_score.stream(t.encode()) for i, t in docs if _crc(i, 7) != 2), np.uint8)
    bits = int(model.code.lengths[raw].sum())
    assert len(seen[0]) == lm_score.MIXER_EVERY > 1 and all(part[0] > 0 for part in seen[0])
    assert sum(part[0] for part in seen[0]) == bits
    first = 1 + model.weights.size + model.by_byte.size
    assert sum(v for part in seen[0] for i, v in part.items() if first <= i < first + model.refine.size) == bits


def test_lm_equal_contexts_are_looked_up_and_counted_once(monkeypatch):
    """Text that comes again in later slices costs no lookups and no additions of its own."""
    rng = random.Random(9)
    text = lm_score.stream(" ".join("".join(rng.choice("abcde") for _ in range(rng.randint(1, 9))) for _ in range(200)).encode())
    monkeypatch.setattr(lm_score, "_SLICE", len(text))  # what was worked on at once
    slots, rows = lm_score._slots, []
    monkeypatch.setattr(lm_score, "_slots", lambda context, node, c, code: rows.append(len(node)) or slots(context, node, c, code))

    class Docs:
        def mapInArrow(self, run, _):
            return [b for b in run([pa.record_batch({"doc_id": pa.array([0] * n), "text": pa.array([text.decode().strip()] * n)})])]

    work = []
    for n in (1, 6):
        raw = np.frombuffer(text * n, np.uint8)
        code = lm_score.Code(np.bincount(np.frombuffer(text, np.uint8), minlength=256))
        rows.clear()
        counts = lm_score.count_tables(Docs(), code)
        counted = sum(rows)
        total = np.concatenate([np.frombuffer(zstandard.decompress(b), np.uint32) for out in counts for b in out.column(1).to_pylist()])
        assert total.reshape(-1, 3)[:, :2].sum() == lm_score._CONTEXTS * code.lengths[raw].sum()
        model = lm_score.MixingModel(code, _states(raw, code))
        rows.clear()
        logs = model.log10(raw)
        work.append((counted, sum(rows)))
        assert np.allclose(logs.reshape(n, -1), logs[:len(text)])
    assert work[0] == work[1]


def test_lm_words_travel_in_rows_of_many_and_are_counted_exactly():
    rng = random.Random(4)
    lots = [Counter(rng.choice(["a", "bb", "été", "x" * 40, "https://a/%d" % rng.randint(0, 30), "n%d" % rng.randint(0, 200)])
                    for _ in range(500)) for _ in range(3)]
    lots[1].update({"held": 0, "\x00": 2})  # a word of held-out documents alone is not known
    tables = [lm_score.packed_words(k, pa.array([w.encode() for w in lot], pa.large_binary()), np.array(list(lot.values())), 7)
              for k, lot in enumerate(lots)]
    assert all(t.num_rows <= 7 for t in tables)
    whole, total = pa.concat_tables(tables), sum(lots, Counter())
    known = pa.concat_tables([lm_score.added_words(whole.filter(pc.equal(whole["range"], r))) for r in set(whole["range"].to_pylist())])
    assert (pc.sum(known["tokens"]).as_py(), pc.sum(known["distinct"]).as_py()) == (sum(total.values()), len(total))
    assert sum(np.array(b) for b in known["bytes"].to_pylist() if b).tolist() == np.bincount(
        np.frombuffer("".join(w * n for w, n in total.items()).encode(), np.uint8), minlength=256).tolist()
    for k, lot in enumerate(lots):
        words, c = lm_score.unpacked_words(known.filter(pc.equal(known["lot"], k)))
        assert dict(zip((w.as_py().decode() for w in words), c.tolist())) == {w: total[w] for w in lot if total[w]}
    empty = lm_score.packed_words(0, pa.array([], pa.large_binary()), np.zeros(0, np.int64), 7)
    assert empty.num_rows == 0 and len(lm_score.unpacked_words(empty)[0]) == 0


def test_lm_contexts_by_words_are_those_by_bytes():
    rng = random.Random(12)
    texts = ["", "a", "ab", "a b c d", "abcd", "abcde fghij", "x" * 100, "x" * 64 + " " + "x" * 65, "\x00 a\x00b", "été élève"]
    texts += [" ".join("".join(rng.choice("abc") for _ in range(rng.randint(1, 12))) for _ in range(rng.randint(0, 9))) for _ in range(80)]
    rng.shuffle(texts)
    raw = np.frombuffer(b"".join(lm_score.stream(t.encode()) for t in texts), np.uint8)
    for size in (1, 9, 50, len(raw)):
        for lead, part in lm_score.parts(raw, size):
            one, two = lm_score.Contexts(part, lead), lm_score.WordContexts(part, lead)
            plain, times = ([tuple(r) for r in np.stack([c.byte, c.last, c.word]).T.tolist()] for c in (one, two))
            assert dict(zip(plain, np.bincount(one.code))) == dict(zip(times, two.times()))
            value = np.array([hash(r) % 1000 for r in times], float)
            each = np.array([hash(r) % 1000 for r in plain], float)[one.code]
            assert (two.by_byte(value) == each).all()
            body = part[lead:]
            begins = np.r_[0, np.flatnonzero((body[:-1] == 0x20) | (body[:-1] == 0x0A)) + 1]
            assert np.allclose(two.by_word(value), np.add.reduceat(each, begins))
