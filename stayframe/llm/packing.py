"""Best-two-fit packing of tokenised documents into sequences of bounded length.

Tokenising: each distinct white-space-separated chunk of a slice of text is
encoded once (the tokenizer never looks across white space): plain words by the
tokenizer's model alone, as a run of letters is one token run, others through
the whole tokenizer, many per call with a separator token between them; a
document's ids are gathered from those.  Packing: pieces are dealt to shards of bounded size; a shard is packed
in one task from the histogram of its lengths.  A sequence is filled greedily
(largest piece, then the largest that fits the gap); then its smallest piece is
exchanged for two unpacked pieces when their sum fits the widened gap more
tightly.  A shard wastes at most about one sequence over packing all at once.
"""

from __future__ import annotations

import re
import sys
import types
import zlib
from bisect import bisect_left, bisect_right, insort

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayframe.llm.common import documents, record_batch, slices, store, texts

CAPACITY = 4096
END_ID = 1
SHARD_PIECES = 16384
_SLICE = 2 << 20  # bytes of text in work at once in a task
_CACHED = 1_000_000  # chunks kept between slices by a worker; later ones are encoded again
_SEPARATOR = "\x01"


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


#: Normalizer and splitting under which a run of letters is one token run of the model, as ``ChunkEncoder._words`` takes it.
_NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
     "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
# letters of a to z and of U+00C0 to U+00FF, which compose with nothing in the chunk, then ASCII punctuation
_WORD = re.compile(rb"((?:[a-z]|\xC3[\x80-\x96\x98-\xB6\xB8-\xBF])+)([!-/:-@\[-`{-~]*)")
_BYTE_CHARS = {b: 256 + 34 + b - 0x80 for b in range(0x80, 0xA1)} | {0xAD: 256 + 67}  # ByteLevel's stand-ins
_SPACE = np.isin(np.arange(256), list(b"\x20\x09\x0a\x0b\x0c\x0d"))


class ChunkEncoder:
    """ids of UTF-8 texts, equal to the tokenizer's own on the whole text."""

    def __init__(self, tokenizer_json: str):
        import json
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        mark = self.tokenizer.encode(_SEPARATOR, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        spec = json.loads(tokenizer_json)
        self.by_word = spec.get("normalizer") == _NORMALIZER and spec.get("pre_tokenizer") == _PRE_TOKENIZER
        self._forget()

    def _forget(self) -> None:
        self.at: dict[bytes, int] = {b"": 0}
        self.ids = np.zeros(0, np.int32)
        self.starts = np.zeros(2, np.int64)

    def _words(self, chunks: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray, list[bytes]]:
        """Plain words, their flat ids and lengths, straight from the model; and the chunks that are no plain words."""
        tokenize, plain, flat, ends, others = self.tokenizer.model.tokenize, [], [], [], []
        for chunk in chunks:
            found = _WORD.fullmatch(chunk) if self.by_word else None
            if not found:
                others.append(chunk)
                continue
            letters, after = found.groups()
            text = letters.decode("latin-1") if letters.isascii() else \
                letters.decode().lower().encode().decode("latin-1").translate(_BYTE_CHARS)
            flat += [t.id for t in tokenize(text)]
            if after:
                flat += [t.id for t in tokenize(after.decode())]
            plain.append(chunk)
            ends.append(len(flat))
        return plain, np.array(flat, np.int32), np.diff(np.array([0, *ends])), others

    def _encode(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and lengths of new chunks."""
        flat, lengths = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for i in range(0, len(chunks), 2000):
            part = chunks[i:i + 2000]
            text = f" {_SEPARATOR} ".join([c.decode(errors="replace") for c in part])
            if self.mark is None or "<|" in text or text.count(_SEPARATOR) != len(part) - 1:
                each = [x.ids for x in self.tokenizer.encode_batch_fast([c.decode(errors="replace") for c in part], add_special_tokens=False)]
                flat.append(np.array([x for ids in each for x in ids], np.int32))
                lengths.append(np.array([len(ids) for ids in each]))
                continue
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)
            cuts = np.flatnonzero(ids == self.mark)
            if len(cuts) != len(part) - 1:
                raise AssertionError("separator token seen inside a chunk")
            flat.append(np.delete(ids, cuts))
            lengths.append(np.diff(np.r_[-1, cuts, len(ids)]) - 1)
        return np.concatenate(flat), np.concatenate(lengths)

    def _numbers(self, chunks: list[bytes]) -> np.ndarray:
        """Where the ids of each of these different chunks are; new chunks are encoded."""
        if len(self.at) > _CACHED:
            self._forget()
        new = [c for c in chunks if c not in self.at]
        if new:
            plain, flat, lengths, others = self._words(new)
            other_flat, other_lengths = self._encode(others)
            self.at.update(zip(plain + others, range(len(self.at), len(self.at) + len(new))))
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(np.concatenate([lengths, other_lengths]))])
            self.ids = np.concatenate([self.ids, flat, other_flat])
        return np.fromiter(map(self.at.__getitem__, chunks), np.int64, len(chunks))

    def _gather(self, parts: list[bytes], special: bool) -> list[np.ndarray]:
        """ids of each part; special tokens are matched in the text as it is."""
        ends = np.cumsum([len(p) + 1 for p in parts])
        text = b"\n".join([*parts, b""])
        raw = np.frombuffer(text if special else text.lower(), np.uint8)
        starts = np.r_[0, ends]
        if not special:
            # a full stop or comma after a letter, before white space, is a token run of its own
            stop = np.flatnonzero((raw == 0x2E) | (raw == 0x2C))
            before = raw[stop - 1]  # the last byte is no letter
            stop = stop[(before >= 0x61) & (before <= 0x7A) & _SPACE[raw[stop + 1]]]
            raw = np.insert(raw, stop, 0x20)
            starts = starts + np.searchsorted(stop, starts)
        column = pa.LargeStringArray.from_buffers(len(parts), pa.py_buffer(starts.astype(np.int64)), pa.py_buffer(raw))
        split = pc.ascii_split_whitespace(column)
        chunks = split.flatten().dictionary_encode()
        numbers = self._numbers(chunks.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist())
        which = numbers[chunks.indices.to_numpy()]
        lengths = self.starts[which + 1] - self.starts[which]
        ends = np.r_[0, np.cumsum(lengths)]
        ids = self.ids[np.repeat(self.starts[which] - ends[:-1], lengths) + np.arange(ends[-1])]
        return np.split(ids, ends[split.offsets.to_numpy()[1:-1]])

    def encode(self, batch: list[bytes]) -> list[np.ndarray]:
        """ids (int32) per text; long texts go through in parts that end at white space."""
        out: list[list[np.ndarray]] = [[] for _ in batch]
        parts, owner, held = [], [], 0

        def flush(special: bool = False) -> None:
            nonlocal held
            for i, ids in zip(owner, self._gather(parts, special) if parts else []):
                out[i].append(ids)
            parts.clear()
            owner.clear()
            held = 0

        for i, text in enumerate(batch):
            special, at = b"<|" in text, 0
            if special:
                flush()
            while True:
                end = len(text) if special else at + _SLICE
                while end < len(text) and text[end] not in b"\x20\x09\x0a\x0b\x0c\x0d":
                    end += 1
                parts.append(text[at:end])
                owner.append(i)
                held += len(parts[-1])
                if special or held >= _SLICE:
                    flush(special)
                if end >= len(text):
                    break
                at = end
        flush()
        return [x[0] if len(x) == 1 else np.concatenate(x) for x in out]


def _worker_encoder(tokenizer_json: str) -> ChunkEncoder:
    """One encoder per Python worker, so that its cache serves later tasks too."""
    held = sys.modules.setdefault("_worker_tokenizers", types.ModuleType("_worker_tokenizers"))
    name = f"t{zlib.crc32(tokenizer_json.encode())}"
    if not hasattr(held, name):
        setattr(held, name, ChunkEncoder(tokenizer_json))
    return getattr(held, name)


_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                     ("ids_crc32", pa.int64())])


def pieces(df: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
           with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids, if asked for): documents cut only beyond capacity."""
    from pathlib import Path
    spec = df.sparkSession.sparkContext.broadcast(Path(tokenizer or default_tokenizer()).read_text("utf-8"))
    schema = pa.schema([*_PIECES, ("ids", pa.list_(pa.int32()))]) if with_ids else _PIECES

    def run(batches):
        encoder = _worker_encoder(spec.value)
        for whole in batches:
            for batch in slices(whole, 1, _SLICE):
                rows: list[tuple] = []
                for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode(texts(batch))):
                    ids = np.append(ids, np.int32(end_id)).astype("<u4")
                    for k, at in enumerate(range(0, len(ids), capacity)):
                        part = ids[at:at + capacity]
                        row = (doc_id, k, at, len(part), zlib.crc32(part.tobytes()))
                        rows.append((*row, part.astype(np.int32)) if with_ids else row)
                if rows:
                    yield record_batch(schema, *[list(c) for c in zip(*rows)])

    kinds = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    return documents(df).mapInArrow(run, kinds + ", ids array<int>" * with_ids)


def best_two_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length; lengths are 1 to capacity."""
    order = np.argsort(lengths, kind="stable")
    count = np.bincount(lengths, minlength=capacity + 1)
    nxt = np.cumsum(count) - count  # next unused row of each length, in ``order``
    count, nxt = count.tolist(), nxt.tolist()
    open_lengths = [n for n in range(1, capacity + 1) if count[n]]
    free = np.zeros(capacity + 1, bool)
    free[open_lengths] = True
    where, place = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)

    def take(n: int) -> None:
        count[n] -= 1
        if not count[n]:
            del open_lengths[bisect_left(open_lengths, n)]
            free[n] = False

    def give(n: int) -> None:
        if not count[n]:
            insort(open_lengths, n)
            free[n] = True
        count[n] += 1

    k = 0
    while open_lengths:
        held, gap = [], capacity
        while open_lengths and (i := bisect_right(open_lengths, gap)):
            n = open_lengths[i - 1]
            take(n)
            held.append(n)
            gap -= n
        if gap and len(open_lengths) and (pair := _two(free, count, held[-1], gap)):
            give(held.pop())
            for n in pair:
                take(n)
                held.append(n)
        at = 0
        for n in held:
            row = order[nxt[n]]
            nxt[n] += 1
            where[row], place[row] = k, at
            at += n
        k += 1
    return where, place


def _two(free: np.ndarray, count: list[int], smallest: int, gap: int) -> tuple[int, int] | None:
    """Two unpacked lengths whose sum is at most smallest + gap, above smallest, and largest."""
    room = smallest + gap
    have = np.flatnonzero(free[:room])
    if not len(have) or 2 * have[0] > room:
        return None
    j = np.searchsorted(have, room - have, "right") - 1
    own = np.arange(len(have))
    j = np.where((j == own) & (np.array([count[n] for n in have]) < 2), j - 1, j)
    sums = np.where(j >= 0, have + have[np.maximum(j, 0)], 0)
    i = int(np.argmax(sums))
    return (int(have[j[i]]), int(have[i])) if sums[i] > smallest else None


def pack(parts: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Pieces with sequence_id and offset added; parts must be a stored table with a length column."""
    shards = max(1, -(-parts.count() // shard_pieces))
    dealt = parts.withColumn("_shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)).cast("bigint"))
    names = parts.columns

    def run(table: pa.Table) -> pa.Table:
        where, place = best_two_fit(table.column("length").to_numpy(), capacity)
        shard = table.column("_shard")[0].as_py()
        out = table.select(names)
        out = out.append_column("sequence_id", pa.array(shard * (2 ** 32) + where, pa.int64()))
        return out.append_column("offset", pa.array(place, pa.int64()))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema)
    return dealt.groupBy("_shard").applyInArrow(run, f"{schema}, sequence_id bigint, offset bigint")


def pack_documents(df: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
                   shard_pieces: int = SHARD_PIECES, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset.

    Nulls: a null text is empty (one piece, the end id alone); a null doc_id
    stays null.  Repeated rows are packed as often as they come.  Ties of length
    go by row order.  Empty table: empty result.  Other columns are ignored.
    """
    return pack(store(pieces(df, tokenizer, capacity, end_id, with_ids), "pieces"), capacity, shard_pieces)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) from pieces packed with_ids: at most one capacity of ids per row."""
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten(F.col("parts.ids")).alias("ids"))
