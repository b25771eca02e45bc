"""Suffix-array dedup of byte strings: a hash-compared suffix sort finds repeated 100-byte strings.

Segments of the corpus that may repeat meet by anchor (``repeats``).  Inside a
shard the suffixes that start a window are sorted: first by anchor and their
first eight bytes, then, inside ties, by a bottom-up mergesort.  Two suffixes
are compared by the length of their common extension, found by binary search
over prefix polynomial hashes (logarithmically many hash comparisons), and the
byte after it.  Neighbours whose common extension reaches the window length are
compared byte by byte before they count as equal.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stayframe.llm.common import record_batch, texts
from stayframe.llm.repeats import Unit, apply_removals, keyed, mixed, removals, removed_mask

WIDTH = 100
GRAM = 24
_R = 0x9E3779B97F4A7C15


class PrefixHashes:
    """Polynomial hashes (modulo 2^64) of all prefixes of a byte array."""

    def __init__(self, raw: np.ndarray, width: int):
        self.raw, self.width = raw, width
        self.padded = np.concatenate([raw, np.zeros(width + 8, np.uint8)])
        n = len(self.padded)
        self.powers = _powers(_R, n)
        inverse = _powers(pow(_R, -1, 1 << 64), n)
        self.back = inverse
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(mixed(self.padded.astype(np.uint64) + np.uint64(1)) * self.powers, out=self.sums[1:])

    def of(self, at: np.ndarray, length: np.ndarray) -> np.ndarray:
        return (self.sums[at + length] - self.sums[at]) * self.back[at]

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length of the common extension of suffixes x and y, up to the width."""
        low = np.zeros(len(x), np.int64)
        step = 1 << (self.width.bit_length() - 1)
        while step:
            more = np.minimum(low + step, self.width)
            same = self.of(x, more) == self.of(y, more)
            low = np.where(same, more, low)
            step >>= 1
        return low

    def less(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(x before y, x equal to y within the width)."""
        k = self.common(x, y)
        return self.padded[x + k] < self.padded[y + k], k >= self.width


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    size = 1
    while size < n:
        m = min(size, n - size)
        out[size:size + m] = out[:m] * np.uint64(pow(base, size, 1 << 64))
        size += m
    return out


def merge_sort(hashes: PrefixHashes, suffix: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """Order (positions in ``suffix``) inside runs of equal ``bucket``, by hash-compared merges.

    All merges of one level, of all buckets, are done at once: the rank of each
    element in the neighbouring run is found by binary search, and the merge is
    stable.
    """
    order = np.arange(len(suffix))
    new = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    sizes = np.diff(np.r_[new, len(bucket)])
    begin, size = np.repeat(new, sizes), np.repeat(sizes, sizes)
    run = 1
    while run < sizes.max(initial=0):
        act = np.flatnonzero(size > run)
        local = act - begin[act]
        mine = local // run
        other = begin[act] + (mine ^ 1) * run
        stop = np.minimum(other + run, begin[act] + size[act])
        low, high = np.minimum(other, stop), stop.copy()
        right = (mine & 1) == 1
        x = suffix[order[act]]
        while True:
            todo = np.flatnonzero(low < high)
            if not len(todo):
                break
            mid = (low[todo] + high[todo]) // 2
            y = suffix[order[mid]]
            before, equal = hashes.less(y, x[todo])
            go = (before & ~equal) | (equal & right[todo])  # of equals the left run's come first
            low[todo] = np.where(go, mid + 1, low[todo])
            high[todo] = np.where(go, high[todo], mid)
        pair = begin[act] + (mine // 2) * 2 * run
        rank = np.where(other < stop, low - other, 0)
        to = pair + (local - mine * run) + np.maximum(rank, 0)
        fresh = order.copy()
        fresh[to] = order[act]
        order = fresh
        run *= 2
    return order


def later_windows(contents: list[bytes], route: np.ndarray, doc: np.ndarray, start: np.ndarray,
                  width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """(content, offset) of windows that also start at an earlier (doc, start) under the same route."""
    lengths = np.array([len(c) for c in contents])
    base = np.cumsum(lengths) - lengths
    raw = np.frombuffer(b"".join(contents), np.uint8)
    windows = lengths - width + 1
    which = np.repeat(np.arange(len(contents)), windows)
    offset = np.arange(len(which)) - np.repeat(np.cumsum(windows) - windows, windows)
    at = base[which] + offset
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    head = np.zeros(len(raw), np.uint64)
    for i in range(min(8, width)):
        head = (head << np.uint64(8)) | padded[i:i + len(raw)]
    key = head[at]
    first = np.lexsort((key, route[which]))
    k, r = key[first], route[which[first]]
    bucket = np.cumsum(np.r_[0, (k[1:] != k[:-1]) | (r[1:] != r[:-1])])
    tied = np.bincount(bucket)[bucket] > 1
    first, bucket = first[tied], bucket[tied]
    none = np.zeros(0, np.int64)
    if not len(first):
        return none, none
    hashes = PrefixHashes(raw, width)
    first = first[merge_sort(hashes, at[first], bucket)]
    near = np.flatnonzero(bucket[1:] == bucket[:-1])
    x, y = at[first[near]], at[first[near + 1]]
    same = hashes.common(x, y) >= width
    near, x, y = near[same], x[same], y[same]
    span = np.arange(width)
    for a in range(0, len(near), 1 << 16):  # collision verification
        part = slice(a, a + (1 << 16))
        if not (raw[x[part, None] + span] == raw[y[part, None] + span]).all():
            return _by_bytes(contents, route, doc, start, width)
    joined = np.zeros(len(first), bool)
    joined[near + 1] = True
    group = np.cumsum(~joined)
    w, o = which[first], offset[first]
    order = np.lexsort((start[w] + o, doc[w], group))
    w, o, group = w[order], o[order], group[order]
    d, s = doc[w], start[w] + o
    head_of = np.maximum.accumulate(np.where(np.r_[True, group[1:] != group[:-1]], np.arange(len(group)), 0))
    later = (d != d[head_of]) | (s != s[head_of])
    return w[later], o[later]


def _by_bytes(contents, route, doc, start, width):
    """The same from the bytes alone, for a shard in which two hashes collided."""
    earliest: dict[tuple, tuple] = {}
    places = [(r, c[o:o + width], (d, s + o), i, o) for i, (c, r, d, s) in
              enumerate(zip(contents, route.tolist(), doc.tolist(), start.tolist())) for o in range(len(c) - width + 1)]
    for r, w, p, _, _ in places:
        earliest[r, w] = min(p, earliest.get((r, w), p))
    late = [(i, o) for r, w, p, i, o in places if p != earliest[r, w]]
    return np.array([i for i, _ in late], np.int64), np.array([o for _, o in late], np.int64)


_ROWS = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                   ("kept_sha256", pa.string()), ("kept", pa.binary())])


def remove_repeats(df: DataFrame, width: int = WIDTH, gram: int = GRAM, with_kept: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept binary].

    Each byte covered by a string of ``width`` bytes that also starts earlier
    (smaller doc_id, or same document and earlier start) is removed; overlaps
    count and strings are judged on the input.  Nulls: a null text is empty;
    rows with a null doc_id come before all others and are a document each, in
    the order of a hash of their texts.  Repeated rows (one doc_id, one text) are
    one document, so they are no copies of each other and each gets its result;
    one doc_id with several texts is as many documents.  Empty table: empty result.  Other columns
    are ignored.
    """
    schema = _ROWS if with_kept else pa.schema(list(_ROWS)[:-1])

    def search(contents, route, doc, start):
        return later_windows(contents, route, doc, start, width)

    def run(batches):
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text, spans in zip(batch.column(0).to_pylist(), texts(batch), batch.column(2).to_pylist()):
                gone = removed_mask(len(text), spans)
                kept = np.frombuffer(text, np.uint8)[~gone].tobytes() if spans else text
                n_spans = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + gone[0]) if spans else 0
                row = (doc_id, len(text), len(text) - len(kept), n_spans, hashlib.sha256(kept).hexdigest())
                rows.append((*row, kept) if with_kept else row)
            if rows:
                yield record_batch(schema, *[list(c) for c in zip(*rows)])

    docs = keyed(df)
    spans = removals(docs, Unit(False, width, gram), search, every_place=False)
    kinds = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    return apply_removals(docs, spans, run, kinds + ", kept binary" * with_kept)
