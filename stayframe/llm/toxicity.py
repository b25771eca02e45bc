"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier.

1. Word counts of toxic and other labelled rows, over all of them, give a
   lexicon of words and word beginnings that speak for toxicity.
2. Voters: the lexicon dealt into many small lexicons, a fixed list of insults,
   and patterns (shouting, exclamations, density of hits).  Each votes with the
   number of its hits (none, one, more); the annotation is one more voter.
3. A label model, fitted by expectation maximisation, estimates every voter's
   accuracy (outcomes given the hidden label) and the correlations that voters
   keep given the label; correlated voters share their weight.
4. A logistic regression on lexicon and text features is trained on the
   model's posterior labels and scores every document.

Steps 2 and 3 and the fit of 4 use a bounded sample of the labelled rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayframe.llm.common import crc32_remainder, documents, pick, record_batch, slices, store, texts

FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7
SAMPLE_ROWS = 12_000  # labelled rows used to fit voters and classifier, about
LEXICON = 400  # terms, at most: the size of the model
LEXICONS = 24  # voters that the lexicon is dealt into
BEGINNINGS = (4, 5, 6)
LEAST_ROWS = 4
LOG_ODDS = 2.0
INSULTS = ("idiot", "moron", "stupid", "loser", "scum", "trash", "pathetic", "worthless", "disgusting", "clown",
           "dumb", "fool", "filth", "vermin", "garbage", "imbecile", "hate", "kill", "ugly", "liar")
_WORD = re.compile(r"[^\W\d_]+")
_EXTRA = 7


def words_of(text: bytes) -> list[str]:
    return _WORD.findall(text.decode("utf-8", "replace").lower())


_COUNTS = pa.schema([("word", pa.string()), ("toxic_rows", pa.int64()), ("other_rows", pa.int64())])


def labelled(df: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, toxic) of the rows that may be learned from."""
    marks = (pick(labels, doc_id="bigint", toxic="int").where("doc_id is not null and toxic is not null")
             .groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic")))
    rows = documents(df).where(crc32_remainder(F.col("doc_id"), FOLDS) != HELD_OUT)
    # shuffled at every size: the marks grow with the documents
    return rows.join(marks.hint("merge"), "doc_id").select("doc_id", "text", "toxic")


def term_counts(rows: DataFrame) -> DataFrame:
    """(term, toxic_rows, other_rows): rows with the word; beginnings add up their words' rows."""
    def run(batches):
        for whole in batches:
            counts: tuple[Counter, Counter] = (Counter(), Counter())
            for batch in slices(whole, 0, 8 << 20):
                for text, toxic in zip(texts(batch, 0), batch.column(1).to_pylist()):
                    counts[toxic].update(set(words_of(text)))
            seen = sorted(counts[0].keys() | counts[1].keys())
            yield record_batch(_COUNTS, seen, [counts[1][w] for w in seen], [counts[0][w] for w in seen])

    words = (rows.select("text", "toxic").mapInArrow(run, "word string, toxic_rows bigint, other_rows bigint")
             .groupBy("word").agg(F.sum("toxic_rows").alias("toxic_rows"), F.sum("other_rows").alias("other_rows")))
    size = F.char_length("word")
    kinds = [F.when(size > 2, F.concat(F.lit("="), "word"))]
    kinds += [F.when(size > n, F.concat(F.lit("^"), F.substring("word", 1, n))) for n in BEGINNINGS]
    return (words.withColumn("term", F.explode(F.array_compact(F.array(*kinds))))
            .groupBy("term").agg(F.sum("toxic_rows").alias("toxic_rows"), F.sum("other_rows").alias("other_rows")))


def lexicon(rows: DataFrame, size: int = LEXICON) -> list[str]:
    n = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    odds = (F.log((F.col("toxic_rows") + 0.5) / F.lit(n.get(1, 0) + 1.0))
            - F.log((F.col("other_rows") + 0.5) / F.lit(n.get(0, 0) + 1.0)))
    strong = (term_counts(rows).withColumn("odds", odds)
              .where((F.col("toxic_rows") >= LEAST_ROWS) & (F.col("odds") >= LOG_ODDS))
              .orderBy(F.desc(F.col("odds") * F.log1p("toxic_rows")), "term").limit(size))
    return [r["term"] for r in strong.select("term").collect()]


class Features:
    """Lexicon hits and text measures of a document."""

    def __init__(self, terms: list[str]):
        self.at = {t: i for i, t in enumerate(terms)}
        self.size = len(terms)
        self.known: dict[str, tuple[int, ...]] = {}

    def hits(self, word: str) -> tuple[int, ...]:
        got = self.known.get(word)
        if got is None:
            keys = ["=" + word] + ["^" + word[:n] for n in BEGINNINGS if len(word) > n]
            got = tuple(self.at[k] for k in keys if k in self.at)
            if len(self.known) < 300_000:
                self.known[word] = got
        return got

    def row(self, text: bytes) -> tuple[dict[int, int], list[float]]:
        """Counts by term, and text measures."""
        body = text.decode("utf-8", "replace")
        counts = Counter(_WORD.findall(body.lower()))
        n = sum(counts.values())
        found: dict[int, int] = {}
        struck = distinct = insults = 0
        for word, c in counts.items():
            if got := self.hits(word):
                struck += c
                distinct += 1
                for i in got:
                    found[i] = found.get(i, 0) + c
        insults = sum(counts[w] for w in INSULTS)
        letters = sum(map(len, counts)) or 1
        upper = sum(1 for c in body[:] if c.isupper()) if len(body) < 4096 else sum(map(str.isupper, body))
        return found, [np.log1p(struck), np.log1p(distinct), 100.0 * struck / max(n, 1), np.log1p(insults),
                       np.log1p(n), min(1.0, upper / max(letters, 1)), min(2.0, body.count("!") / max(n, 1))]

    def matrix(self, rows: list[tuple[dict[int, int], list[float]]]) -> np.ndarray:
        out = np.zeros((len(rows), self.size + _EXTRA), np.float32)
        for i, (found, extra) in enumerate(rows):
            for j, c in found.items():
                out[i, j] = np.log1p(c)
            out[i, self.size:] = extra
        return out


def votes(x: np.ndarray, terms: list[str], toxic: np.ndarray) -> np.ndarray:
    """Outcomes 0, 1, 2 of every voter for every row; the last voter is the annotation."""
    size = len(terms)
    part = np.array([zlib.crc32(t.encode()) % LEXICONS for t in terms], np.int64)
    hits = np.expm1(x[:, :size])
    out = [np.minimum(np.round(hits[:, part == k].sum(axis=1)), 2) for k in range(LEXICONS)]
    extra = x[:, size:]
    out.append(np.minimum(np.round(np.expm1(extra[:, 1])), 2))
    out.append(np.minimum(np.round(np.expm1(extra[:, 3])), 2))
    out.append(np.digitize(extra[:, 2], (0.25, 1.0)))
    out.append(np.digitize(extra[:, 5], (0.3, 0.7)))
    out.append(np.digitize(extra[:, 6], (0.1, 0.5)))
    out.append(2 * toxic)
    return np.stack(out, axis=1).astype(np.int64)


def label_model(v: np.ndarray, toxic: np.ndarray, rounds: int = 12) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(posterior of label 1, outcome probabilities voter x label x outcome, correlations)."""
    post = np.where(toxic > 0, 0.95, 0.05)
    fired = (v > 0).astype(float)
    one_hot = np.stack([v == o for o in range(3)], axis=2).astype(float)
    for _ in range(rounds):
        w = np.stack([1 - post, post])
        prob = (np.einsum("yn,nvo->vyo", w, one_hot) + 0.5) / (w.sum(axis=1)[None, :, None] + 1.5)
        left = np.zeros_like(fired)  # what of each vote the label does not explain
        for y in range(2):
            left += w[y][:, None] * (fired - (w[y] @ fired) / max(w[y].sum(), 1e-9))
        scale = np.sqrt((left ** 2).mean(axis=0)) + 1e-9
        corr = (left.T @ left) / len(left) / np.outer(scale, scale)
        np.fill_diagonal(corr, 0)
        share = 1.0 / (1.0 + np.maximum(np.abs(corr) - 0.1, 0).sum(axis=0))
        score = np.log(w.sum(axis=1) / len(v) + 1e-9)[:, None] + np.einsum("v,nvo,vyo->yn", share, one_hot, np.log(prob))
        post = 1.0 / (1.0 + np.exp(np.clip(score[0] - score[1], -50, 50)))
    return post, prob, corr


def logistic(x: np.ndarray, target: np.ndarray, ridge: float = 1.0, rounds: int = 15) -> np.ndarray:
    """Weights (the last one is the constant) by penalised Newton steps on soft targets."""
    x = np.concatenate([x.astype(np.float64), np.ones((len(x), 1))], axis=1)
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - target) + penalty * w
        curve = (x * (p * (1 - p) + 1e-4)[:, None]).T @ x + np.diag(penalty)
        move = np.linalg.solve(curve, grad)
        w -= move * min(1.0, 5.0 / (np.abs(move).max() + 1e-9))
        if np.abs(move).max() < 1e-5:
            break
    return w


def fit(df: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[list[str], np.ndarray] | None:
    """(terms, weights), or None when no labelled row may be learned from."""
    rows = store(labelled(df, labels), "labelled")
    total = rows.count()
    if not total:
        return None
    terms = lexicon(rows)
    share = min(1.0, sample_rows / total)
    picked = rows.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)

    def run(batches):
        features = Features(terms)
        for whole in batches:
            for batch in slices(whole, 0, 8 << 20):
                found = [features.row(t) for t in texts(batch, 0)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([list(f) for f, _ in found], pa.list_(pa.int32())),
                     pa.array([list(f.values()) for f, _ in found], pa.list_(pa.int32())),
                     pa.array([list(map(float, e)) for _, e in found], pa.list_(pa.float64())),
                     batch.column(1), batch.column(2)], names=["at", "n", "extra", "toxic", "doc_id"])

    got = (picked.select("text", "toxic", "doc_id")
           .mapInArrow(run, "at array<int>, n array<int>, extra array<double>, toxic int, doc_id bigint").collect())
    got.sort(key=lambda r: (r["doc_id"], r["toxic"]))
    x = Features(terms).matrix([(dict(zip(r["at"], r["n"])), r["extra"]) for r in got])
    toxic = np.array([r["toxic"] for r in got])
    if not len(toxic):
        return None
    post, _, _ = label_model(votes(x, terms, toxic), toxic)
    return terms, logistic(x, post)


_ROWS = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def score(df: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted.

    Nulls: a null text is empty and scored like any other; a null id folds as
    '' and has no label; labels with a null id or mark are ignored, and of
    several labels of one id the largest counts.  Without any labelled row every
    score is 0.  Repeated rows each get a row.  Empty table: empty result.
    Other columns (lang, source) are never read.
    """
    model = df.sparkSession.sparkContext.broadcast(fit(df, labels, sample_rows))

    def run(batches):
        terms, weights = model.value or ([], None)
        features = Features(terms)
        for whole in batches:
            for batch in slices(whole, 1, 4 << 20):
                if weights is None:
                    out = np.zeros(batch.num_rows)
                else:
                    x = features.matrix([features.row(t) for t in texts(batch)])
                    out = 1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30)))
                yield record_batch(_ROWS, batch.column(0), out.astype(float))

    out = documents(df).mapInArrow(run, "doc_id bigint, score double")
    return out.select("doc_id", (crc32_remainder(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))
