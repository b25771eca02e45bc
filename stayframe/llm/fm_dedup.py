"""Substring dedup of words with a compressed FM-index per shard.

Segments of the corpus that may repeat meet by anchor (``repeats``).  A shard's
distinct segments are indexed: suffixes of the word sequence are sorted by
prefix doubling, the Burrows-Wheeler transform is kept in a wavelet matrix with
packed bits and sampled ranks, and the segments are streamed through it.
Backward search from an end word gives the matching statistic: the longest run
ending there that stands at least twice in the shard.  Intervals of at least the
window length are reported.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stayframe.llm.common import record_batch, texts
from stayframe.llm.repeats import Unit, apply_removals, keyed, removals, removed_mask

WIDTH = 35
GRAM = 8


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; equal suffixes are told apart by the end of the array."""
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        after = np.zeros(n, np.int64)
        after[:-step or None] = rank[step:] + 1 if step < n else 0
        key = rank * (n + 2) + after
        order = np.argsort(key, kind="stable")
        new = np.r_[0, key[order][1:] != key[order][:-1]].cumsum()
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n - 1 or step >= n:
            return order
        step *= 2


class BitRanks:
    """Packed bits with a running count per 64-bit block."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.words.view(np.uint8)[:len(packed)] = packed
        self.before = np.r_[0, np.cumsum(np.bitwise_count(self.words), dtype=np.int64)]

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Set bits among the first i."""
        block = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[block] + np.bitwise_count(self.words[block] & mask)


class FMIndex:
    """Backward search over the wavelet matrix of a Burrows-Wheeler transform."""

    def __init__(self, symbols: np.ndarray, separators: np.ndarray):
        """symbols: dense from 1; separators: True where a segment ends (the symbol there is ignored)."""
        n = len(symbols)
        unique_ends = np.where(separators, np.cumsum(separators) - 1, symbols + int(separators.sum()))
        order = suffix_order(unique_ends)
        plain = np.where(separators, 0, symbols)
        bwt = plain[order - 1]
        top = int(plain.max(initial=1)) + 1
        self.begin = np.r_[0, np.cumsum(np.bincount(plain, minlength=top))]
        self.n, self.levels = n, []
        seq = bwt
        for b in range(max(1, (top - 1).bit_length()) - 1, -1, -1):
            bits = (seq >> b) & 1 == 1
            zeros = int(n - bits.sum())
            self.levels.append((b, BitRanks(bits), zeros))
            seq = np.concatenate([seq[~bits], seq[bits]])
        self.first = np.zeros(top, np.int64)  # where each symbol's run begins in the last order
        runs = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
        self.first[seq[runs]] = runs

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often ``symbol`` is among the first i of the transform."""
        for b, bits, zeros in self.levels:
            one = (symbol >> b) & 1 == 1
            ones = bits.ones(i)
            i = np.where(one, zeros + ones, i - ones)
        return i - self.first[symbol]

    def step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        both = self.rank(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        return self.begin[symbol] + both[:len(symbol)], self.begin[symbol] + both[len(symbol):]


def repeated_windows(contents: list[bytes], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """(content, offset) of windows whose words stand at least twice in the shard.

    Each segment is read from its end.  A search goes on to the left while its
    interval holds two places; at ``width`` words or more all windows inside the
    match are repeated and the next search ends just before the first window not
    yet covered, else it ends one word earlier.
    """
    words = [c.split(b" ") for c in contents]
    number: dict[bytes, int] = {}
    lengths = np.array([len(w) for w in words])
    ids = np.fromiter((number.setdefault(x, len(number) + 1) for w in words for x in [*w, None]), np.int64, int(lengths.sum()) + len(words))
    stop = np.cumsum(lengths + 1)
    base = stop - lengths - 1
    separators = np.zeros(len(ids), bool)
    separators[stop - 1] = True
    index = FMIndex(ids, separators)
    lane = np.flatnonzero(lengths >= width)
    end = lengths[lane] - 1  # last word of the search
    length = np.zeros(len(lane), np.int64)
    low, high = np.zeros(len(lane), np.int64), np.full(len(lane), index.n)
    found_lane, found_a, found_b = [], [], []
    while len(lane):
        at = end - length
        can = at >= 0
        symbol = ids[base[lane] + np.maximum(at, 0)]
        lo, hi = index.step(symbol, low, high)
        grow = can & (hi - lo > 1)
        length += grow
        low, high = np.where(grow, lo, low), np.where(grow, hi, high)
        over = np.flatnonzero(~grow)
        if len(over):
            matched = length[over] >= width
            m = over[matched]
            found_lane.append(lane[m])
            found_a.append(end[m] - length[m] + 1)
            found_b.append(end[m] - width + 1)
            end[over] = np.where(matched, end[over] - length[over] + width - 1, end[over] - 1)
            length[over], low[over], high[over] = 0, 0, index.n
            go = end >= width - 1
            lane, end, length, low, high = lane[go], end[go], length[go], low[go], high[go]
    if not found_lane:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    which, a, b = map(np.concatenate, (found_lane, found_a, found_b))
    n = b - a + 1
    offset = np.repeat(a - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    return np.repeat(which, n), offset


_ROWS = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                   ("kept_sha256", pa.string()), ("kept", pa.string())])


def remove_repeats(df: DataFrame, width: int = WIDTH, gram: int = GRAM, with_kept: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256[, kept text].

    Each word covered by a window of ``width`` words that also starts anywhere
    else is removed, all places included; windows are judged on the input.
    Words are split at ASCII white space and compared unchanged.  Nulls: a null
    text has no words; rows with a null doc_id are a document each.  Repeated
    rows (one doc_id, one text) are one document, no copies of each other, and
    each gets its result; one doc_id with several texts is as many documents.  Empty table: empty result.  Other columns are ignored.
    """
    schema = _ROWS if with_kept else pa.schema(list(_ROWS)[:-1])

    def search(contents, route, doc, start):
        return repeated_windows(contents, width)

    def run(batches):
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text, spans in zip(batch.column(0).to_pylist(), texts(batch), batch.column(2).to_pylist()):
                words = text.split()
                n = len(words)
                if spans:
                    words = [words[i] for i in np.flatnonzero(~removed_mask(n, spans))]
                kept = b" ".join(words)
                row = (doc_id, n, n - len(words), hashlib.sha256(kept).hexdigest())
                rows.append((*row, kept.decode()) if with_kept else row)
            if rows:
                yield record_batch(schema, *[list(c) for c in zip(*rows)])

    docs = keyed(df)
    spans = removals(docs, Unit(True, width, gram), search, every_place=True)
    kinds = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"
    return apply_removals(docs, spans, run, kinds + ", kept string" * with_kept)
