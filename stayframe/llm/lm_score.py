"""Language-model scores by logistic mixing of hashed-context bit predictors.

A document is the byte stream of its lower-cased words, each followed by a
space, and one end byte.  A byte is written as the bits of a prefix code, and
each bit is predicted in several contexts (the last two to four bytes, and the word
so far): a hashed table per context holds how often the bit was 0 and 1 in
the training documents.  The predictions, as log odds, are summed with weights
that a gate chooses by the last byte and by how often two of the contexts were seen; the sum is
refined by an adaptive map from (last byte, probability) to probability.  A word's
probability is mixed from the product of its bits and its share of all training tokens.
The score is the sum of the log10 probabilities of all words and the end.

Tables grow with the training text: their slots are a stated power of its bytes.  A
slot also adds up a check value of the contexts that use it; where the mean is not near
a context's own, the slot is mostly another's and counts as unseen.  Word counts are
exact at every size.  Weights and map are learned from all training documents, whole:
these are dealt to parts, and a part is learned from with tables that count the other
parts only, so that no document meets its own counts.  Learning goes shard by shard in
Newton steps, one a slice of text, with the curvature of all slices before; the shards'
weights are averaged by their bits, their maps' counts added.  The tables that score
count all parts.  All sums and shards are the same however the documents are
partitioned.

Counting: tasks fill tables from their part of the documents and the tables are
added slot range by slot range.  Equal contexts of some megabytes of text are counted,
and scored, once.  Word counts are grouped by lots of documents: a lot's distinct words
go packed, a row a range of hashes, to be added over all lots and return to the lot,
whose documents look them up.
"""

from __future__ import annotations

import heapq
import math
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayframe.llm.common import crc32_remainder, discard, documents, record_batch, slices, store, texts, utf8

FOLDS, HELD_OUT = 7, 2
MIXER_EVERY = 2  # parts of the training documents: weights and map are learned from each with tables of the others
WORD_SHARE = 0.2  # weight of a word's share of the training tokens in its probability; its bits have the rest
LOT_BYTES = 8 << 20
LOTS_A_RANGE = 4  # words are counted in so many times fewer ranges of hashes than there are lots
ORDERS = (2, 3, 4)  # bytes of the byte contexts; the last context is the word so far
#: Slots of the contexts' tables are 2^(these + a third of log2 of the training bytes), rounded:
#: 2^18 to 2^22 at 0.8 GB of text, twice as many for eight times the text.  Every worker holds
#: two bytes a slot (80 MB at 50 GB of text, 1.2 GB at 150 TB).
TABLE_GROWTH = (8.1, 10.1, 11.6, 12.1)
END = 0x0A
_CONTEXTS = len(TABLE_GROWTH)
_CHECKS, _NEAR = 32, 2  # check values, and how far a slot's mean may be from one's own
_SLICE = 1 << 20
_TOGETHER = 8 << 20  # of slices whose equal contexts are scored, or counted, once
_BLOCK = 1 << 14  # bits that are worked on together: their arrays stay in a core's cache
_RANGE = 1 << 16  # slots that are added together
_MAP = 33
_MAP_PRIOR = 20.0
_WEIGHT_PRIOR = 50.0  # curvature a weight starts with
_SHARD_BYTES = 4 << 20  # of training documents, learned one after the other
_CONF = 8
_ODDS = np.where(np.arange(256) > 0, np.arange(256, dtype=np.float32) - np.float32(128), np.float32(0)) * np.float32(1 / 14)


_PLACE = np.uint64(0x5851F42D4C957F2D)
_BEFORE = int.from_bytes(bytes([END] * 8), "little")
_MASKS = np.array([((1 << 64) - 1) ^ ((1 << (64 - 8 * k)) - 1) for k in range(9)], np.uint64)  # the highest k bytes
_PLAIN = bytes(0x20 if c in b"\x09\x0a\x0b\x0c\x0d" else c + 32 if 65 <= c <= 90 else c for c in range(256))


def stream(text: bytes) -> bytes:
    text = text.translate(_PLAIN).strip(b" ")
    if b"  " in text:
        text = b" ".join(text.split())
    return text + b" " * bool(text) + bytes([END])


def words_of(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(lower-cased words of all texts, words per text)."""
    raw, ends = utf8(column)  # anew from its first byte on: these functions do not heed the offset of a slice
    text = pa.LargeStringArray.from_buffers(len(column), pa.py_buffer((ends - ends[0]).astype(np.int64)),
                                            pa.py_buffer(np.ascontiguousarray(raw[ends[0]:ends[-1]])))
    split = pc.ascii_split_whitespace(pc.ascii_lower(text))
    words, counts = split.flatten(), np.diff(split.offsets.to_numpy())
    some = pc.not_equal(pc.binary_length(words), 0)
    before = np.r_[0, np.cumsum(some.to_numpy(zero_copy_only=False))]
    ends = np.cumsum(counts)
    return words.filter(some).cast(pa.large_binary()), before[ends] - before[ends - counts]


def prefix_code(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lengths, codes) of a Huffman code over 256 bytes, first bit highest."""
    heap = [(int(c) + 1, i, (i,)) for i, c in enumerate(counts)]
    heapq.heapify(heap)
    bits = [""] * 256
    while len(heap) > 1:
        a, _, x = heapq.heappop(heap)
        b, k, y = heapq.heappop(heap)
        for i in x:
            bits[i] = "0" + bits[i]
        for i in y:
            bits[i] = "1" + bits[i]
        heapq.heappush(heap, (a + b, k, x + y))
    return np.array([len(b) for b in bits]), np.array([int(b, 2) for b in bits], np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def histories(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(last four bytes, word so far) at each position of concatenated streams.

    What lies before a document counts as END bytes; a document ends with one.  The word so
    far is its last eight letters and how many letters it has.
    """
    n = len(raw)
    padded = np.concatenate([np.full(8, END, np.uint8), raw])
    eight = np.ndarray(n, "<u8", padded, strides=(1,)).copy()  # the eight bytes before each position, the last one highest
    after = np.flatnonzero(raw[:-1] == END) + 1
    for k in range(4):  # positions k after a document's start have k bytes of their own
        at = after[after + k < np.r_[after[1:], n]] + k
        eight[at] = eight[at] >> np.uint64(64 - 8 * k) << np.uint64(64 - 8 * k) | np.uint64(_BEFORE >> 8 * k) if k else np.uint64(_BEFORE)
    begin = np.r_[0, np.flatnonzero((raw[:-1] == 0x20) | (raw[:-1] == END)) + 1]
    inside = np.arange(n, dtype=np.int32) - np.repeat(begin.astype(np.int32), np.diff(np.r_[begin, n]))
    own = np.minimum(inside, 8)
    word = inside.astype(np.uint64)
    word *= _PLACE
    word ^= eight & _MASKS.take(own)
    eight >>= np.uint64(32)
    return eight.astype(np.uint32), word


def table_bits(training_bytes: int) -> tuple[int, ...]:
    return tuple(max(8, round(g + math.log2(max(1, training_bytes)) / 3)) for g in TABLE_GROWTH)


class Code:
    """The prefix code, its nodes' hashes and bits by level and byte, and the first slot of each context's table."""

    def __init__(self, counts: np.ndarray):
        self.lengths, self.codes = prefix_code(counts)
        level = np.arange(int(self.lengths.max()))[:, None]
        left = np.maximum(self.lengths - level, 1).astype(np.uint64)
        self.nodes = _mix((np.uint64(1) << level.astype(np.uint64) | self.codes >> left) + np.uint64(7))
        self.ones = (self.codes >> left - np.uint64(1) & np.uint64(1)).astype(np.int64)
        self.bits = table_bits(int(counts.sum()))
        self.first = np.r_[0, np.cumsum([1 << b for b in self.bits])].astype(np.int64)
        self.slots = int(self.first[-1])


def _by_length(byte: np.ndarray, code: Code) -> np.ndarray:
    """Order of falling code lengths, in which the bytes that have a bit come before those that have it not."""
    return np.argsort((255 - code.lengths).astype(np.uint8)[byte], kind="stable")


def _having(byte: np.ndarray, code: Code) -> list[int]:
    """How many bytes have a first, second, ... bit."""
    return np.bincount(code.lengths[byte])[::-1].cumsum()[::-1][1:].tolist()


def _blocks(n: int):
    return (slice(at, min(n, at + _BLOCK)) for at in range(0, n, _BLOCK))


def _nodes(byte: np.ndarray, code: Code):
    """Per bit of the bytes' codes, by blocks: (which of them have it, hash of the bits before it, bit)."""
    order = _by_length(byte, code)
    byte = byte[order]
    for t, have in enumerate(_having(byte, code)):
        for near in _blocks(have):
            yield order[near], code.nodes[t].take(byte[near]), code.ones[t].take(byte[near])


def _slots(context: np.ndarray, node: np.ndarray, c: int, code: Code) -> tuple[np.ndarray, np.ndarray]:
    """(slot, check value) of bits in context c."""
    h = context ^ node
    h ^= h >> np.uint64(31)  # as in _mix, in place
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    check = h.astype(np.uint8).view(np.int8) & np.int8(_CHECKS - 1)
    h >>= np.uint64(64 - code.bits[c])
    h += np.uint64(code.first[c])
    return h.view(np.int64), check


class Contexts:
    """Unique (contexts, byte) of a stream, and each context as a hash."""

    def __init__(self, raw: np.ndarray, lead: int = 0):
        last, word = (x[lead:] for x in histories(raw))
        raw = raw[lead:]
        self._keep(raw, last, word)

    def _keep(self, byte: np.ndarray, last: np.ndarray, word: np.ndarray) -> None:
        key = last * np.uint64(0xD6E8FEB86659FD93)
        key ^= word
        key *= np.uint64(0xA0761D6478BD642F)
        key ^= byte
        self.code, _, first = _numbered(key.view(np.int64))
        self.byte, self.last, self.word = byte[first], last[first], word[first]
        self.previous = (self.last & np.uint32(0xFF)).astype(np.int64)

    @property
    def ctx(self) -> list[np.ndarray]:
        return [self.hashes(c) for c in range(_CONTEXTS)]

    def hashes(self, c: int, rows=slice(None)) -> np.ndarray:
        if c == _CONTEXTS - 1:
            return _mix(_mix(self.word[rows]) + np.uint64(1))
        return _mix((self.last[rows].astype(np.uint64) & np.uint64((1 << (8 * ORDERS[c])) - 1)) + np.uint64(ORDERS[c] << 40))

    def each(self, order: np.ndarray):
        """Per context: (context, bytes, hashes, which of these a row in ``order`` is).

        Of the byte contexts what differs, in the order it comes first; of the word so far, in which few rows are equal, all rows.
        """
        yield _CONTEXTS - 1, self.byte[order], self.hashes(_CONTEXTS - 1, order), None
        rows, which = order, None
        for c in range(_CONTEXTS - 2, -1, -1):  # what differs in a shorter context differs in the longer ones
            own = self.hashes(c, rows)
            code, _, first = _numbered((own * np.uint64(0xA0761D6478BD642F) ^ self.byte[rows]).view(np.int64))
            rows, which = rows[first], code if which is None else code[which]
            yield c, self.byte[rows], own[first], which


def _runs(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``count`` numbers from each start on, one after the other."""
    return np.repeat(start - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))


class WordContexts(Contexts):
    """The same by words: equal first bytes after equal bytes are met once, and so are equal words from their fifth byte on.

    ``code`` has a number for each byte of these heads and tails.  A word's end is its own.
    """

    def __init__(self, raw: np.ndarray, lead: int = 0):
        ends = np.flatnonzero((raw == 0x20) | (raw == END))
        ends = ends[np.searchsorted(ends, lead):]
        if not len(ends) or ends[-1] < len(raw) - 1:
            ends = np.r_[ends, len(raw) - 1]
        self.begin = np.r_[lead, ends[:-1] + 1]
        self.length = ends - self.begin + 1
        padded = np.concatenate([np.full(8, END, np.uint8), raw, np.zeros(8, np.uint8)])
        eight = np.ndarray(len(raw) + 9, "<u8", padded, strides=(1,))  # the eight bytes before each position, the last one highest
        head = eight[self.begin + 4]
        own = np.full(len(raw) + 4, 4, np.uint8)  # bytes of its own that a document has before a position, up to four
        after = np.flatnonzero(raw[:-1] == END) + 1
        for k in (3, 2, 1, 0):
            own[after + k] = k
        at = np.flatnonzero(own[self.begin] < 4)
        others = (np.uint64(1) << np.uint64(8) * (4 - own[self.begin[at]]).astype(np.uint64)) - np.uint64(1)
        head[at] = head[at] & ~others | np.uint64(_BEFORE) & others
        head &= ~_MASKS[4 - np.minimum(self.length, 4)]
        self.head, heads, first = _numbered(head.view(np.int64))
        self.heads = np.minimum(self.length[first], 4)
        inside = _runs(np.zeros(len(first), np.int64), self.heads).astype(np.uint64)
        of_head = np.repeat(heads.view(np.uint64), self.heads)
        word = of_head >> np.uint64(32) << np.uint64(56) - np.uint64(8) * inside << np.uint64(8)
        word ^= inside * _PLACE
        inside *= np.uint64(8)
        of_head >>= inside
        columns = [((of_head >> np.uint64(32)).astype(np.uint8), of_head.astype(np.uint32), word)]

        self.long = np.flatnonzero(self.length > 4)
        begin, length = self.begin[self.long], self.length[self.long]
        name = length.astype(np.uint64) * _PLACE
        for k in range(0, 64, 8):
            on = np.flatnonzero(length > k)
            name[on] = _mix(name[on] ^ eight[begin[on] + (k + 8)] & ~_MASKS[8 - np.minimum(length[on] - k, 8)])
        far = np.flatnonzero(length > 64)  # these are not compared
        name[far] ^= _mix(begin[far].astype(np.uint64) + np.uint64(1))
        self.tail, _, first = _numbered(name.view(np.int64))
        begin, self.tails = begin[first], length[first] - 4
        inside = _runs(np.full(len(first), 4), self.tails)
        at = np.repeat(begin, self.tails) + inside
        before = eight[at]
        word = before & _MASKS[np.minimum(inside, 8)]
        word ^= inside.astype(np.uint64) * _PLACE
        columns.append((raw[at], (before >> np.uint64(32)).astype(np.uint32), word))
        del head, own, of_head, name, inside, at, before, word
        self._keep(*(np.concatenate(c) for c in zip(*columns)))

    def times(self) -> np.ndarray:
        """How often each comes."""
        often = (np.repeat(np.bincount(which, minlength=len(n)), n) for which, n in ((self.head, self.heads), (self.tail, self.tails)))
        return np.bincount(self.code, np.concatenate(list(often)), len(self.byte))

    def _first(self) -> tuple[np.ndarray, np.ndarray]:
        """Where in ``code`` each head and each tail begins."""
        return np.cumsum(self.heads) - self.heads, np.cumsum(self.tails) - self.tails + len(self.code) - int(self.tails.sum())

    def by_byte(self, value: np.ndarray) -> np.ndarray:
        """The values of the unique contexts for each byte of the stream."""
        out, rows, (head, tail) = np.empty(int(self.length.sum())), value.take(self.code), self._first()
        begin = self.begin - self.begin[0]
        for start, which, n in ((begin, head[self.head], np.minimum(self.length, 4)),
                                (begin[self.long] + 4, tail[self.tail], self.length[self.long] - 4)):
            out[_runs(start, n)] = rows[_runs(which, n)]
        return out

    def by_word(self, value: np.ndarray) -> np.ndarray:
        """Their sums for each word of the stream."""
        rows, (head, tail) = value.take(self.code), self._first()
        out = np.add.reduceat(rows[:len(rows) - int(self.tails.sum())], head)[self.head]
        if len(tail):
            out[self.long] += np.add.reduceat(rows, tail)[self.tail]
        return out


def _numbered(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of each key, unique keys, where each is for the first time); new keys are numbered as they come."""
    code, unique = pd.factorize(key, size_hint=max(1, len(key) // 4))
    highest = np.maximum.accumulate(code) if len(code) else code
    return code, unique, np.flatnonzero(np.r_[True, highest[1:] > highest[:-1]]) if len(code) else code


def parts(raw: np.ndarray, size: int):
    """(lead, part) of streams: parts end after a word or document; the first ``lead`` bytes of a part only give context."""
    at = 0
    while at < len(raw):
        end = min(len(raw), at + size)
        while end < len(raw):  # on to the end of the word
            stop = np.flatnonzero((raw[end - 1:end + size] == 0x20) | (raw[end - 1:end + size] == END))
            end = end + int(stop[0]) if len(stop) else min(len(raw), end + size)
            if len(stop):
                break
        lead = min(at, max(ORDERS))
        yield lead, raw[at - lead:end]
        at = end


_TABLES = pa.schema([("part", pa.int32()), ("counts", pa.binary())])


def _training_parts(docs: DataFrame, parts: int) -> list[DataFrame]:
    """All training documents, each in one of ``parts`` parts, by hash."""
    train = docs.where(crc32_remainder(F.col("doc_id"), FOLDS) != HELD_OUT)
    place = F.pmod(F.xxhash64("doc_id", "text", F.lit("mixer")), F.lit(parts))
    return [train.where(place == k) for k in range(parts)]


def byte_counts(docs: DataFrame) -> np.ndarray:
    schema = pa.schema([("counts", pa.list_(pa.int64()))])

    def run(batches):
        total = np.zeros(256, np.int64)
        for batch in batches:
            for text in texts(batch):
                total += np.bincount(np.frombuffer(stream(text), np.uint8), minlength=256)
        yield record_batch(schema, [total.tolist()])

    return added_bytes(docs.mapInArrow(run, "counts array<bigint>"))


def added_bytes(rows: DataFrame) -> np.ndarray:
    sums = rows.select(F.posexplode("counts").alias("i", "n")).groupBy("i").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(256, np.int64)
    for r in sums:
        out[r["i"]] = r["n"]
    return out


def count_tables(docs: DataFrame, code: Code) -> DataFrame:
    """(part, counts): packed sums of a range of slots (bits 0, bits 1, check values), one row per task that saw it."""
    def run(batches):
        table = np.zeros(3 * code.slots, np.uint32)
        for batch in batches:
            for piece in slices(batch, 1, _TOGETHER):
                raw = np.frombuffer(b"".join(map(stream, texts(piece))), np.uint8)
                for lead, part in parts(raw, _TOGETHER):
                    contexts = WordContexts(part, lead)
                    order = _by_length(contexts.byte, code)
                    met = contexts.times()[order]
                    for c, byte, ctx, which in contexts.each(order):
                        times = (met if which is None else np.bincount(which, met, len(byte))).astype(np.uint32)
                        for on, node, bit in _nodes(byte, code):
                            on = slice(on[0], on[-1] + 1)
                            slot, check = _slots(ctx[on], node, c, code)
                            slot *= 3
                            np.add.at(table, slot + bit, times[on])
                            slot += 2
                            np.add.at(table, slot, times[on] * check.astype(np.uint32))
        pack = zstandard.ZstdCompressor(level=1).compress
        for k, at in enumerate(range(0, 3 * code.slots, 3 * _RANGE)):
            part = table[at:at + 3 * _RANGE]
            if part.any():
                yield record_batch(_TABLES, [k], [pack(part.tobytes())])
    return docs.mapInArrow(run, "part int, counts binary")


def _packed_states(total: np.ndarray) -> bytes:
    n = total[:, 0] + total[:, 1]
    odds = np.clip(np.round(np.log((total[:, 1] + 0.4) / (total[:, 0] + 0.4)) * 14), -127, 127).astype(np.int64) + 128
    conf = np.minimum(_CONF - 1, np.floor(np.log2(n + 1.0))).astype(np.int64)
    check = np.round(total[:, 2] / np.maximum(n, 1)).astype(np.int64)
    return np.where(n > 0, odds << 8 | conf << 5 | check, 0).astype("<u2").tobytes()


def added_tables(counts: DataFrame, kind, pack) -> DataFrame:
    """(part, counts): the tables of numbers of ``kind`` added slot range by slot range, each sum as ``pack`` makes it."""
    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        part, total = None, None

        def packed():
            return record_batch(_TABLES, [part], [zstandard.compress(pack(total), 1)])

        for batch in batches:
            for k, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                got = np.frombuffer(unpack(blob), kind).reshape(-1, 3)
                if k != part:
                    if part is not None:
                        yield packed()
                    part, total = k, np.zeros(got.shape, np.int64)
                total += got
        if part is not None:
            yield packed()

    return counts.repartition("part").sortWithinPartitions("part").mapInArrow(run, "part int, counts binary")


def summed_tables(docs: DataFrame, code: Code) -> DataFrame:
    """(part, counts): the documents' counts, a row per range of slots; the tasks' tables are shuffled, never stored."""
    return added_tables(count_tables(docs, code), np.uint32, lambda total: total.astype("<i8").tobytes())


def merged_tables(sums: DataFrame) -> DataFrame:
    """(part, states): of each slot its log odds (8 bits), confidence (3) and mean check value (5), packed; 0 for unused ones."""
    return added_tables(sums, "<i8", _packed_states)


class MixingModel:
    """Tables, gated weights and the adaptive map."""

    def __init__(self, code: Code, states: np.ndarray, weights=None, by_byte=None, refine=None):
        self.code, self.states = code, states
        start = np.full((_CONF * _CONF, _CONTEXTS + 1), 0.3)
        start[:, -1] = 0.0
        self.weights = start if weights is None else weights
        self.by_byte = np.zeros((256, _CONTEXTS + 1)) if by_byte is None else by_byte
        grid = (np.arange(_MAP) - _MAP // 2) / 2.0
        self.refine = np.tile(1 / (1 + np.exp(-grid)), (256, 1)) if refine is None else refine

    def looked_up(self, byte: np.ndarray, ctx: np.ndarray, c: int, t: int) -> tuple[np.ndarray, np.ndarray]:
        """(log odds, confidence) of bit ``t`` of bytes in context c."""
        odds, conf = np.empty(len(byte), np.float32), np.empty(len(byte), np.uint8)
        for near in _blocks(len(byte)):
            slot, own = _slots(ctx[near], self.code.nodes[t].take(byte[near]), c, self.code)
            state = self.states.take(slot, mode="clip")
            own -= state.astype(np.int8) & np.int8(_CHECKS - 1)
            state *= np.abs(own) <= _NEAR  # 0 is an unused slot, or another's
            np.right_shift(state.astype(np.uint8), np.uint8(5), out=conf[near])
            _ODDS.take(state >> np.uint16(8), out=odds[near], mode="clip")
        return odds, conf

    def levels(self, contexts: Contexts):
        """Per bit, by blocks: (which of the unique contexts have it, inputs, gate, bit)."""
        order = _by_length(contexts.byte, self.code)
        byte = contexts.byte[order]
        each = [(c, own, ctx, which, _having(own, self.code)) for c, own, ctx, which in contexts.each(order)]
        for t, have in enumerate(_having(byte, self.code)):
            found = [(c, which, *self.looked_up(own[:n[t]], ctx[:n[t]], c, t)) for c, own, ctx, which, n in each]
            for near in _blocks(have):
                x, gate = np.ones((_CONTEXTS + 1, near.stop - near.start), np.float32), 0
                for c, which, odds, conf in found:
                    which = near if which is None else which[near]
                    x[c] = odds[which]
                    if c >= _CONTEXTS - 2:
                        gate += conf[which] * np.uint8(_CONF if c == _CONTEXTS - 1 else 1)
                yield order[near], x.T, gate.astype(np.int64), self.code.ones[t].take(byte[near])

    def joined(self) -> np.ndarray:
        """Per input, the weights of a gate and a last byte added up."""
        return np.ascontiguousarray((self.weights[:, None] + self.by_byte).reshape(-1, _CONTEXTS + 1).T)

    def mixed(self, x: np.ndarray, gate: np.ndarray, previous: np.ndarray, joined: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(probability, its place in the map) of the inputs, weighted."""
        cell = gate * 256 + previous
        mixed = None
        for c, w in enumerate(joined):
            w = w.take(cell, mode="clip")
            if c < _CONTEXTS:  # the last input is 1
                w *= x[:, c]
            mixed = w if mixed is None else np.add(mixed, w, out=mixed)
        np.clip(mixed, -12, 12, out=mixed)
        p = np.exp(-mixed)
        p += 1
        np.divide(1, p, out=p)
        mixed *= 2
        at = np.rint(mixed, out=mixed).astype(np.int64)
        at += _MAP // 2
        return p, np.clip(at, 0, _MAP - 1, out=at)

    def probability(self, x: np.ndarray, gate: np.ndarray, previous: np.ndarray, joined: np.ndarray | None = None):
        p, at = self.mixed(x, gate, previous, self.joined() if joined is None else joined)
        refined = self.refine.ravel().take(previous * _MAP + at, mode="clip")
        refined += p
        refined *= 0.5
        return p, at, np.clip(refined, 1e-6, 1 - 1e-6, out=refined)

    def learn(self, raw: np.ndarray, lead: int = 0) -> tuple[int, np.ndarray, np.ndarray]:
        """One Newton step over all bits of the streams, with the curvature of what was learned from before.

        Bits of equal contexts are one row that counts as often as they come.  A bit has the
        weights of its gate and those of its last byte, which are moved apart.
        Gives the number of bits and, for the map, how often each of its cells was met, and with bit 1.
        """
        contexts = Contexts(raw, lead)
        often = np.bincount(contexts.code, minlength=len(contexts.byte)).astype(np.float32)
        kinds = ((self.weights, "bent_gate"), (self.by_byte, "bent_byte"))
        for w, name in kinds:
            if not hasattr(self, name):
                setattr(self, name, np.tile(np.eye(w.shape[1]) * _WEIGHT_PRIOR, (len(w), 1, 1)))
        joined, met, rows = self.joined().astype(np.float32), np.zeros(2 * self.refine.size), []
        inputs, cells = _CONTEXTS + 1, len(self.weights) * 256  # a cell is a gate and a last byte
        pairs = [(i, j) for i in range(inputs) for j in range(i, inputs)]
        sums = np.zeros((len(pairs) + inputs, cells))

        def add():
            x, cell, slope, bent = (np.concatenate(c, axis=-1) for c in zip(*rows))
            rows.clear()
            order = np.argsort(cell, kind="stable")
            cell, slope = cell.take(order), slope.take(order)
            x = [row.take(order) for row in x]
            scaled = [bent.take(order)]
            scaled = [scaled[0] * row for row in x] + scaled  # the last input is 1
            starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
            here = cell[starts]
            for total, (i, j) in zip(sums, pairs):
                total[here] += np.add.reduceat(scaled[i] * x[j] if j < _CONTEXTS else scaled[i], starts)
            for i, total in enumerate(sums[len(pairs):]):
                total[here] += np.add.reduceat(slope * x[i] if i < _CONTEXTS else slope, starts)

        for on, x, gate, bit in self.levels(contexts):
            previous, times = contexts.previous.take(on), often.take(on)
            p, bucket = self.mixed(x, gate, previous, joined)
            np.add.at(met, (previous * _MAP + bucket) * 2 + bit, times.astype(np.float64))
            slope = np.subtract(bit, p, dtype=np.float32)
            slope *= times
            times *= p
            times *= 1 - p
            rows.append((x.T[:_CONTEXTS], (gate * 256 + previous).astype(np.uint16), slope, times))
            if len(rows) == 8:
                add()
        if rows:
            add()
        for others, (w, name) in enumerate(kinds, 1):
            own = sums.reshape(len(sums), -1, 256).sum(axis=3 - others)
            curvature = getattr(self, name)
            for total, (i, j) in zip(own, pairs):
                curvature[:, i, j] += total
                if i < j:
                    curvature[:, j, i] += total
            w += np.linalg.solve(curvature, own[len(pairs):].T[:, :, None])[:, :, 0]
        met = met.reshape(-1, 2)
        return int(round(met.sum())), met.sum(axis=1), met[:, 1]

    def log10(self, raw: np.ndarray, by=WordContexts.by_byte) -> np.ndarray:
        """log10 probability of each byte of concatenated streams, or of each word and end."""
        out = []
        self.weights, self.by_byte = self.weights.astype(np.float32), self.by_byte.astype(np.float32)
        joined = self.joined()
        for lead, part in parts(raw, _TOGETHER):
            contexts = WordContexts(part, lead)
            product = np.ones(len(contexts.byte))  # of a code's bits: far from the least number, as each has 1e-6 at least
            for on, x, gate, bit in self.levels(contexts):
                _, _, p = self.probability(x, gate, contexts.previous.take(on), joined)
                p -= 1 - bit
                product[on] *= np.abs(p, out=p)
            out.append(by(contexts, np.log10(product)))
        return np.concatenate(out) if out else np.zeros(0)

    def plain(self) -> tuple:
        return self.code, self.states, self.weights, self.by_byte, self.refine


def _states(tables: DataFrame, code: Code) -> np.ndarray:
    out = np.zeros(code.slots, np.uint16)
    for r in merged_tables(tables).toLocalIterator():
        got = np.frombuffer(zstandard.decompress(bytes(r["counts"])), "<u2")
        out[r["part"] * _RANGE:r["part"] * _RANGE + len(got)] = got
    return out


_LEARNED = pa.schema([("sums", pa.list_(pa.float64()))])


def learned_sums(part: DataFrame, model: MixingModel) -> DataFrame:
    """(i, v): over the shards' passes over all documents of a part, the sums of their bits, of weights times bits, and of the map's counts."""
    share = part.sparkSession.sparkContext.broadcast(model.plain())
    place = F.xxhash64("doc_id", "text", F.lit("shard"))
    size = part.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    dealt = part.select("text", place.alias("place"), F.pmod(place, F.lit(-(-size // _SHARD_BYTES) or 1)).alias("shard"))

    def run(table: pa.Table) -> pa.Table:
        own, bits, seen, ones, size = MixingModel(*share.value), 0, 0, 0, _SLICE >> 4  # short steps at first
        own.weights, own.by_byte = own.weights.astype(np.float64), own.by_byte.astype(np.float64)
        for batch in table.sort_by([("place", "ascending"), ("text", "ascending")]).to_batches():
            for piece in slices(batch, 0, _SLICE):
                raw = np.frombuffer(b"".join(map(stream, texts(piece, 0))), np.uint8)
                for lead, streams in parts(raw, size):
                    n, s, o = own.learn(streams, lead)
                    bits, seen, ones = bits + n, seen + s, ones + o
                size = _SLICE
        pa.default_memory_pool().release_unused()  # a worker goes on to other stages
        return pa.table({"sums": pa.array([np.r_[bits, bits * own.weights.ravel(), bits * own.by_byte.ravel(), seen, ones]])}, _LEARNED)

    rows = dealt.groupBy("shard").applyInArrow(run, "sums array<double>")
    sums = store(rows.select(F.posexplode("sums").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")), "learned")
    share.destroy()
    return sums


def learn_mixer(model: MixingModel, learned: list[DataFrame]) -> None:
    """Weights averaged by bits, and the map from added counts, over the shards of all parts."""
    sums = learned[0]
    for other in learned[1:]:
        sums = sums.unionByName(other)
    sums = sums.groupBy("i").agg(F.sum("v").alias("v")).collect()  # as many as there are weights and map cells
    if not sums:
        return
    flat = np.zeros(len(sums))
    for r in sums:
        flat[r["i"]] = r["v"]
    w, b, m = model.weights.size, model.by_byte.size, model.refine.size
    bits, weights, by_byte, seen, ones = np.split(flat, np.cumsum([1, w, b, m]))
    model.weights = weights.reshape(model.weights.shape) / bits
    model.by_byte = by_byte.reshape(model.by_byte.shape) / bits
    # a cell starts at its own probability, with the weight of some observations
    model.refine = ((model.refine.ravel() * _MAP_PRIOR + ones) / (_MAP_PRIOR + seen)).reshape(model.refine.shape)


def fit(docs: DataFrame, mixer_every: int = MIXER_EVERY, counts: np.ndarray | None = None) -> MixingModel:
    """The model of all training documents; ``mixer_every`` is the number of parts they are learned from in (2 or more).

    ``counts`` are the bytes of their streams, if they are known.
    """
    if mixer_every < 2:
        raise ValueError("weights are learned with tables of other parts: there must be two parts at least")
    dealt = _training_parts(docs, mixer_every)
    if counts is None:
        counts = byte_counts(docs.where(crc32_remainder(F.col("doc_id"), FOLDS) != HELD_OUT))
    code = Code(counts)
    tables = [store(summed_tables(part, code), f"tables{k}") for k, part in enumerate(dealt)]

    def states(left_out: int | None = None) -> np.ndarray:
        return _states(reduce(DataFrame.unionByName, [t for k, t in enumerate(tables) if k != left_out]), code)

    learned = [learned_sums(part, MixingModel(code, states(k))) for k, part in enumerate(dealt)]
    model = MixingModel(code, states())
    learn_mixer(model, learned)
    discard(*tables, *learned)
    return model


#: Words of a lot that fall to one range of hashes, one after the other, and their lengths and counts as packed numbers.
_WORDS = pa.schema([("lot", pa.int64()), ("range", pa.int32()), ("words", pa.binary()), ("lengths", pa.binary()), ("counts", pa.binary())])
_KNOWN = pa.schema([("lot", pa.int64()), ("words", pa.binary()), ("lengths", pa.binary()), ("counts", pa.binary()),
                    ("tokens", pa.int64()), ("distinct", pa.int64()), ("bytes", pa.list_(pa.int64()))])
_ROWS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()),
                   ("base_score", pa.float64()), ("score", pa.float64()), ("bits_per_byte", pa.float64())])


def _kinds(schema: pa.Schema) -> str:
    names = {pa.int64(): "bigint", pa.int32(): "int", pa.binary(): "binary", pa.float64(): "double",
             pa.list_(pa.int64()): "array<bigint>"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def _ends(words: pa.Array) -> np.ndarray:
    return np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1] if len(words) else np.zeros(1, np.int64)


def _ranges(words: pa.Array, ranges: int) -> np.ndarray:
    """Which range of hashes each word is in, by its first and last eight bytes and its length."""
    ends, data = _ends(words), words.buffers()[2]
    raw = np.concatenate([np.zeros(8, np.uint8), np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), np.zeros(8, np.uint8)])
    eight = np.ndarray(len(raw) - 7, "<u8", raw, strides=(1,))
    length = np.diff(ends)
    some = np.minimum(length, 8)
    h = _mix((eight[ends[1:]] & _MASKS[some]) + length.astype(np.uint64)) ^ eight[ends[:-1] + 8] & ~_MASKS[8 - some]
    return ((_mix(h) >> np.uint64(32)) % np.uint64(ranges)).astype(np.int32)


def packed_words(lot: int, words: pa.Array, n: np.ndarray, ranges: int) -> pa.Table:
    """A row per range of hashes with all of its words."""
    place = _ranges(words, ranges)
    order = np.argsort(place, kind="stable")
    place, words, n = place[order], words.take(pa.array(order)), n[order].astype("<i8")
    cuts = np.r_[0, np.flatnonzero(np.diff(place)) + 1, len(place)].tolist() if len(place) else [0]
    ends = _ends(words)
    data = words.buffers()[2].to_pybytes() if len(words) and words.buffers()[2] else b""
    rows = [(int(place[a]), data[ends[a]:ends[b]], np.diff(ends[a:b + 1]).astype("<i4").tobytes(), n[a:b].tobytes())
            for a, b in zip(cuts, cuts[1:])]
    columns = list(zip(*rows)) if rows else [(), (), (), ()]
    return pa.Table.from_arrays([pa.array([lot] * len(rows), pa.int64()), *(pa.array(c, f.type) for c, f in zip(columns, list(_WORDS)[1:]))],
                                schema=_WORDS)


def unpacked_words(rows: pa.Table) -> tuple[pa.Array, np.ndarray]:
    """(words, counts) of packed rows, one after the other."""
    data, lengths, counts = (b"".join(rows.column(name).to_pylist()) for name in ("words", "lengths", "counts"))
    ends = np.r_[0, np.cumsum(np.frombuffer(lengths, "<i4"), dtype=np.int64)]
    return (pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(data)]),
            np.frombuffer(counts, "<i8"))


def added_words(rows: pa.Table) -> pa.Table:
    """Of a range of hashes: per lot its words that training documents have, with their counts in all lots; at the first, the range's tokens, words and bytes."""
    words, n = unpacked_words(rows)
    each = words.dictionary_encode()
    which = each.indices.to_numpy()
    total = np.zeros(len(each.dictionary), np.int64)
    np.add.at(total, which, n)
    c, length = total[which], np.diff(_ends(words))
    data = np.frombuffer(words.buffers()[2], np.uint8)
    letters = np.frombuffer(each.dictionary.buffers()[2], np.uint8)
    met = np.bincount(letters, np.repeat(total, np.diff(_ends(each.dictionary))), 256)  # exact below 2^53
    out, at, lot = [], 0, rows.column("lot").to_pylist()
    for k, counts in enumerate(rows.column("counts").to_pylist()):
        own = slice(at, at + len(counts) // 8)
        have = c[own] > 0
        begin = int(_ends(words)[at])
        size = length[own]
        letters = data[begin:begin + int(size.sum())][np.repeat(have, size)]
        out.append((lot[k], letters.tobytes(), size[have].astype("<i4").tobytes(), c[own][have].astype("<i8").tobytes(),
                    0 if k else int(n.sum()), 0 if k else int((total > 0).sum()),
                    None if k else met.astype(np.int64).tolist()))
        at = own.stop
    del words, each
    pa.default_memory_pool().release_unused()  # a worker goes on to other stages
    return pa.Table.from_arrays([pa.array(col, f.type) for col, f in zip(zip(*out), _KNOWN)], schema=_KNOWN)


def score(df: DataFrame, mixer_every: int = MIXER_EVERY, lot_bytes: int = LOT_BYTES,
          word_share: float = WORD_SHARE) -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    Learned from the rows whose crc32(doc_id) modulo 7 is not 2.  Nulls: a null
    text is empty (the end token alone); null ids fold as ''.  Repeated rows count
    and are scored as often as they come; rows that share an id but not a text are
    scored apart.  Very long texts go through in parts that end after a word, with
    the context of what is before.  Without training rows all counts are 0 and the
    model is uniform over bits.  Empty table: empty result.  Other columns are ignored.
    """
    docs = documents(df)
    total = docs.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    lots = max(1, -(-total // lot_bytes))
    ranges = max(1, lots // LOTS_A_RANGE)
    fold = crc32_remainder(F.col("doc_id"), FOLDS)
    dealt = docs.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(lots)).cast("bigint").alias("lot"), "doc_id", "text",
                        (fold != HELD_OUT).alias("train"))

    def count(table: pa.Table) -> pa.Table:
        train = table.column(3).combine_chunks()
        learned, others = (pa.chunked_array([words_of(b.column(2))[0] for b in table.filter(f).to_batches()], pa.large_binary())
                           for f in (train, pc.invert(train)))
        counts = pc.value_counts(learned)
        seen = counts.field("values")
        new = pc.unique(others)
        new = new.filter(pc.invert(pc.is_in(new, seen)))
        n = np.r_[counts.field("counts").to_numpy(), np.zeros(len(new), np.int64)]
        out = packed_words(table.column(0)[0].as_py(), pa.concat_arrays([seen, new]), n, ranges)
        del learned, others, counts, seen, new
        pa.default_memory_pool().release_unused()  # a worker goes on to other stages
        return out

    words = store(dealt.groupBy("lot").applyInArrow(count, _kinds(_WORDS)), "words")
    ends = docs.where(fold != HELD_OUT).count()
    known = store(words.groupBy("range").applyInArrow(added_words, _kinds(_KNOWN)), "known")
    tokens, distinct = (x or 0 for x in known.agg(F.sum("tokens"), F.sum("distinct")).first())
    counts = added_bytes(known.where("bytes IS NOT NULL").select("bytes").withColumnRenamed("bytes", "counts"))
    counts += np.bincount([0x20, END], [tokens, ends], 256).astype(np.int64)  # a space after each word
    tokens, distinct = tokens + ends, distinct + (ends > 0)
    discard(words)
    share = df.sparkSession.sparkContext.broadcast(fit(docs, mixer_every, counts).plain())

    def run(rows: pa.Table, counts: pa.Table) -> pa.Table:
        model = MixingModel(*share.value)
        known_words, c_of = unpacked_words(counts)
        c_of = np.r_[c_of, 0, ends]  # the last two for words that are not there and for the end
        logs_of = np.log10(c_of + 1.0)
        with np.errstate(divide="ignore"):
            shares_of = np.log(c_of / max(tokens, 1) * word_share)
        floor = np.log10(tokens + distinct + 1)
        out = []
        for whole in rows.combine_chunks().to_batches():
            for batch in slices(whole, 2, _TOGETHER):
                streams = [stream(t) for t in texts(batch, 2)]
                words, n_tokens = words_of(batch.column(2))
                n_tokens += 1
                first = np.cumsum(n_tokens) - n_tokens
                each = words.dictionary_encode()
                found = pc.fill_null(pc.index_in(each.dictionary, value_set=known_words), len(c_of) - 2).to_numpy()
                at = np.full(int(n_tokens.sum()), len(c_of) - 1)
                inner = np.ones(len(at), bool)
                inner[first + n_tokens - 1] = False
                at[inner] = found[each.indices.to_numpy()]
                base = np.add.reduceat(logs_of[at], first) - n_tokens * floor
                known_n = np.add.reduceat((c_of > 0)[at].astype(np.int64), first)
                sizes = np.array([len(s) for s in streams])
                raw = np.frombuffer(b"".join(streams), np.uint8)
                logs = model.log10(raw, WordContexts.by_word)
                if tokens:
                    logs = np.logaddexp(logs * np.log(10) + np.log(1 - word_share), shares_of[at]) / np.log(10)
                sums = np.add.reduceat(logs, first)
                out.append(record_batch(_ROWS, batch.column(1), n_tokens, known_n, np.full(len(sizes), tokens), base, sums,
                                        -sums / sizes / np.log10(2)))
                pa.default_memory_pool().release_unused()
        return pa.Table.from_batches(out, schema=_ROWS)

    scored = (dealt.select("lot", "doc_id", "text").groupBy("lot")
              .cogroup(known.select("lot", "words", "lengths", "counts").groupBy("lot")).applyInArrow(run, _kinds(_ROWS)))
    return scored.select("doc_id", (fold == HELD_OUT).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         "base_score", "score", "bits_per_byte")
