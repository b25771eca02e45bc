"""Language identification with blended-spectrum string kernels.

Two texts are compared by the n-grams (bytes of the lower-cased text, n = 2 to
4) present in both: K(x, y) = |x and y| / sqrt(|x| |y|), over the n-grams that
landmark documents contain, all of them.  Landmarks give the Nystrom approximation, and one
kernel ridge regression per language is solved against them.  The kernel is a
scaled inner product, so the landmark matrix and the regression weights fold
into one matrix of n-grams and languages; a text is scored by the sum of its
n-grams' rows.  Whole texts are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayframe.llm.common import crc32_remainder, documents, pick, record_batch, slices, texts

FOLDS = 5
PER_LANGUAGE = 240  # rows fitted per language, at most
LANDMARKS = 60  # of these, landmarks per language, at most
PREFERRED_BYTES = 1 << 16  # longer texts are taken for fitting only where shorter ones are too few
RIDGE = 1e-3
UNKNOWN = "und"
_SLOT_BITS = 20
_SCALE = np.uint64(0x9E3779B97F4A7C15)
_SIZES = (2, 3, 4)


def _codes(raw: np.ndarray) -> np.ndarray:
    """All n-grams of a byte array, as numbers that differ between sizes."""
    wide, out = raw.astype(np.uint64), []
    code = wide
    for n in range(2, max(_SIZES) + 1):
        if len(wide) < n:
            break
        code = (code[:-1] << np.uint64(8)) | wide[n - 1:]
        if n in _SIZES:
            out.append(code | np.uint64(n << 32))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _grams(text: bytes) -> np.ndarray:
    return _codes(np.frombuffer(text.decode("utf-8", "replace").lower().encode(), np.uint8))


def _slots(codes: np.ndarray) -> np.ndarray:
    return (codes * _SCALE) >> np.uint64(64 - _SLOT_BITS)


class KernelModel:
    """Folded weights over landmark n-grams, one column per language."""

    def __init__(self, languages: list[str], keys: np.ndarray, weights: np.ndarray, prior: np.ndarray):
        self.languages, self.keys, self.weights, self.prior = languages, keys, weights, prior

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """(slot -> its first feature, the number of features where none; per feature, whether its slot has another)."""
        return self.lookup(self.keys)

    @staticmethod
    def lookup(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``keys`` sorted by slot -> slot table and marks of keys that share the slot of the next one."""
        slots = _slots(keys)
        first = np.full(1 << _SLOT_BITS, len(keys), np.int32)
        first[slots[::-1]] = np.arange(len(keys), dtype=np.int32)[::-1]
        return first, np.append(slots[1:] == slots[:-1], [False] * min(2, len(keys) + 1))

    @staticmethod
    def present(text: bytes, keys: np.ndarray, padded: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Features whose n-gram stands in the text; ``padded`` is ``keys`` and one more entry."""
        first, shared = table
        seen = np.zeros(len(keys), bool)
        for at in range(0, max(1, len(text)), 1 << 20):  # overlapping parts of a long text
            codes = _grams(text[at:at + (1 << 20) + max(_SIZES)])
            f = first[_slots(codes)]
            while len(f):
                hit = padded[f] == codes
                seen[f[hit]] = True
                on = np.flatnonzero(shared[f] & ~hit)
                codes, f = codes[on], f[on] + 1
        return np.flatnonzero(seen)

    @classmethod
    def fit(cls, sample: list[tuple[str, bytes]], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> "KernelModel":
        """sample: (language, text) in a fixed order; the first of each language are landmarks."""
        languages = sorted({lang for lang, _ in sample})
        y = np.array([languages.index(lang) for lang, _ in sample])
        marks = np.concatenate([np.flatnonzero(y == c)[:landmarks] for c in range(len(languages))])
        keys = np.unique(np.concatenate([np.unique(_grams(sample[i][1])) for i in marks]))
        keys = keys[np.lexsort((keys, _slots(keys)))]
        table, padded = cls.lookup(keys), np.append(keys, np.uint64(0))
        rows = [cls.present(t, keys, padded, table) for _, t in sample]
        norms = np.sqrt(np.maximum([len(r) for r in rows], 1))
        # landmarks that hold an n-gram, n-gram after n-gram
        held = np.concatenate([rows[i] for i in marks])
        holder = np.repeat(np.arange(len(marks)), [len(rows[i]) for i in marks])[np.argsort(held, kind="stable")]
        many = np.bincount(held, minlength=len(keys))
        begin = np.cumsum(many) - many
        k_nm = np.zeros((len(sample), len(marks)))
        for i, r in enumerate(rows):
            n = many[r]
            at = np.repeat(begin[r] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            k_nm[i] = np.bincount(holder[at], minlength=len(marks)) / (norms[i] * norms[marks])
        k_mm = k_nm[marks]
        target = np.where(y[:, None] == np.arange(len(languages)), 1.0, -1.0)
        weight = (len(y) / (len(languages) * np.bincount(y, minlength=len(languages))))[y][:, None]
        left = k_nm.T @ (weight * k_nm) + ridge * len(y) * k_mm + 1e-8 * np.eye(len(marks))
        alpha = np.linalg.solve(left, k_nm.T @ (weight * target))
        weights = np.zeros((len(keys), len(languages)))
        for i, a in zip(marks, alpha):
            weights[rows[i]] += a / norms[i]
        return cls(languages, keys, weights.astype(np.float32), np.bincount(y, minlength=len(languages)) / max(1, len(y)))

    def predict(self, batch: list[bytes], table: tuple[np.ndarray, np.ndarray]) -> tuple[list[str], np.ndarray]:
        f, padded = np.zeros((len(batch), len(self.languages))), np.append(self.keys, np.uint64(0))
        for i, text in enumerate(batch):
            r = self.present(text, self.keys, padded, table)
            f[i] = self.weights[r].sum(axis=0) / np.sqrt(max(1, len(r)))
        f += 1e-6 * self.prior
        best = f.argmax(axis=1)
        e = np.exp(6.0 * (f - f.max(axis=1, keepdims=True)))
        return [self.languages[i] for i in best], (1.0 / e.sum(axis=1)).astype(float)


def training_sample(df: DataFrame, per_language: int = PER_LANGUAGE, folds: int = FOLDS) -> list[tuple[str, bytes]]:
    """At most per_language labelled rows of each language outside the held-out fold, by a hash of the id."""
    rows = pick(df, doc_id="bigint", text="string", lang="string").where(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & (crc32_remainder(F.col("doc_id"), folds) != 0))
    order = Window.partitionBy("lang").orderBy("_long", F.xxhash64("doc_id"), "doc_id")
    ids = (rows.select("doc_id", "lang", (F.octet_length("text") > PREFERRED_BYTES).alias("_long"))
           .withColumn("_n", F.row_number().over(order))
           .where(F.col("_n") <= per_language).select("doc_id", F.col("lang").alias("_lang"), "_n"))
    chosen = rows.join(F.broadcast(ids), "doc_id").where("lang = _lang").select("_n", "lang", "text").distinct().collect()
    return [(r["lang"], r["text"].encode()) for r in sorted(chosen, key=lambda r: (r["lang"], r["_n"], r["text"]))]


def _fit(df: DataFrame, per_language: int, folds: int):
    """Broadcast (languages, keys, weights, prior) of the fitted model, or None."""
    sample = training_sample(df, per_language, folds)
    made = KernelModel.fit(sample) if sample else None
    return df.sparkSession.sparkContext.broadcast(
        (made.languages, made.keys, made.weights, made.prior) if made else None)


class Predictor:
    """Predictions for record batches in a task."""

    def __init__(self, plain):
        self.model = KernelModel(*plain) if plain else None
        self.table = self.model.table() if plain else None
        self.letter = regex.compile(r"\p{L}")

    def lettered(self, docs: list[bytes]) -> list[bool]:
        return [bool(self.letter.search(d.decode(errors="replace"))) for d in docs]

    def __call__(self, docs: list[bytes]) -> tuple[list[str], np.ndarray]:
        if not self.model:
            return [UNKNOWN] * len(docs), np.zeros(len(docs))
        known = np.array(self.lettered(docs))
        langs, scores = self.model.predict(docs, self.table)
        return [x if k else UNKNOWN for x, k in zip(langs, known)], np.where(known, scores, 0.0)


_ROWS = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])
_BATCH, _BYTES = 128, 4 << 20


def identify(df: DataFrame, per_language: int = PER_LANGUAGE, folds: int = FOLDS) -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score.

    The model is fitted on the driver from a bounded sample: at most
    per_language labelled rows of each language whose crc32(doc_id) modulo folds
    is not 0.  A null text, or one without a letter, is ``und`` with score 0; so
    is everything when no labelled row exists.  A text without any known n-gram
    gets the most frequent language.  Null ids fold as ''.  Repeated rows each
    get a row.  Empty table: empty result.  Other columns are ignored.
    """
    model = _fit(df, per_language, folds)

    def run(batches):
        predict = Predictor(model.value)
        for whole in batches:
            for part in slices(whole, 1, _BYTES):
                for at in range(0, part.num_rows, _BATCH):
                    batch = part.slice(at, _BATCH)
                    yield record_batch(_ROWS, batch.column(0), *predict(texts(batch)))

    out = documents(df).mapInArrow(run, "doc_id bigint, lang_pred string, score double")
    return out.select("doc_id", (crc32_remainder(F.col("doc_id"), folds) == 0).alias("held_out"), "lang_pred", "score")


def accepted(df: DataFrame, per_language: int = PER_LANGUAGE, folds: int = FOLDS) -> DataFrame:
    """The rows that have an identified language, all columns kept; ``und`` rows go.

    Where no model can be fitted nothing is known against a language, so only
    null texts and texts without a letter go.  Rows pass through the tasks that judge them, so nothing is joined or shuffled.
    Columns are addressed by position, so further ones may have any name.  Bytes that are no UTF-8 are no letters.
    Repeated rows are judged alike.  Empty table: empty result.
    """
    model, at_text = _fit(df, per_language, folds), df.columns.index("text")
    flat = df.toDF(*[f"c{i}" for i in range(len(df.columns))])

    def run(batches):
        predict = Predictor(model.value)
        for whole in batches:
            for part in slices(whole, at_text, _BYTES):
                for at in range(0, part.num_rows, _BATCH):
                    batch = part.slice(at, _BATCH)
                    docs = texts(batch, at_text)
                    keep = [x != UNKNOWN for x in predict(docs)[0]] if predict.model else predict.lettered(docs)
                    yield batch.filter(pa.array(keep, pa.bool_()))

    return flat.mapInArrow(run, flat.schema).toDF(*df.columns)
