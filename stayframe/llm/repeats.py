"""Repeated windows of a corpus: every window meets its equals in one shard, in linear work.

A document is a row of tokens (bytes or words); a window is ``width`` tokens in
a row.  A window's anchor is its least gram of ``gram`` tokens, by hash.  Equal
windows have equal anchors, so windows are routed by anchor and each shard can
be searched on its own.  Consecutive windows with one anchor travel together as
a segment.

1. anchors of all documents are counted; a segment whose anchor stands nowhere
   else in the corpus holds no repeated window;
2. the other segments are written out with their content, and equal segments
   are combined (in the tasks first, then by key): all but the first place of a
   content repeat it wholly;
3. distinct segments of one anchor are searched for common windows by the
   operator's own text index (suffix sort or FM-index);
4. both give intervals per document, which are applied to the whole texts.

An anchor with very many distinct segments (the edge of a passage that a third
of all documents share) is not searched in one task: its segments are cut into
pieces of a few windows by their distance from the anchor, and a piece goes
again through 2 and 3, by the tokens that all its windows hold.  Where very many
distinct pieces share those, too, their windows are grouped one by one by their
own content, and equal ones combine before the shuffle.  No case is dropped.

Only a few bytes of an anchor travel per place, but a segment travels with about
four times the text it stands for.  So a corpus beyond ``_ONE_PASS`` anchors goes
through 1 to 4 in ``PASSES`` classes of anchors (for 2, of documents), one class
after the other, and the disk holds the shuffles of one class.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayframe.llm.common import discard, pick, record_batch, slices, store, texts, utf8

HOT = 2000  # distinct segments of an anchor beyond which its windows are grouped one by one
PASSES = 2  # classes that a large corpus is worked on in, one after the other
_ONE_PASS = 1 << 20  # anchors counted by document up to which one class does
BLOCK = 8  # windows in a piece of a crowded anchor's segment
_SLICE = 2 << 20  # bytes of text in work at once
_PART = 1 << 20  # tokens of one document in work at once
_POSITION_BITS = 24
_SHARD_BYTES = 2 << 20  # segment bytes searched at once, cut between anchors
_MULTIPLIER = 0x9E3779B97F4A7C15
_NO_ID = -(1 << 63)


class Unit(NamedTuple):
    """What a token is, and the sizes of windows and anchors."""
    words: bool
    width: int
    gram: int


def tokens_of(text: bytes, words: bool) -> np.ndarray:
    """64-bit numbers standing for the tokens of a text."""
    if not words:
        return np.frombuffer(text, np.uint8).astype(np.uint64)
    parts = text.split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(parts))


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def gram_hashes(tokens: np.ndarray, size: int) -> np.ndarray:
    """Polynomial hash (modulo 2^64) of each run of ``size`` tokens, by doubling."""
    base = mixed(tokens + np.uint64(1))
    r, span, out, done = np.uint64(_MULTIPLIER), 1, None, 0
    while True:
        if size & span:
            if out is None:
                out, done = base, span
            else:  # the span already covered, then this one
                n = len(tokens) - done - span + 1
                if n <= 0:
                    return np.zeros(0, np.uint64)
                out = out[:n] * np.uint64(pow(_MULTIPLIER, span, 1 << 64)) + base[done:done + n]
                done += span
        if done == size:
            return mixed(out)
        if len(base) <= span:
            return np.zeros(0, np.uint64)
        base = base[:-span] * np.uint64(pow(_MULTIPLIER, span, 1 << 64)) + base[span:]
        span *= 2


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[:len(x) - (width - span)], x[width - span:]) if width > span else x


def segments_of(tokens: np.ndarray, ends: np.ndarray, unit: Unit):
    """Segments of concatenated documents: (document, first window, windows, anchor hash) arrays.

    ``ends`` are the documents' borders in ``tokens``; windows across a border do
    not count.  The leftmost least gram is the anchor, so two equal windows never
    share an anchor's place, and a segment has at most width - gram + 1 windows.
    """
    n = len(tokens) - unit.width + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none, np.zeros(0, np.uint64)
    hashes = gram_hashes(tokens, unit.gram)
    low = np.uint64((1 << _POSITION_BITS) - 1)
    places = np.arange(len(hashes), dtype=np.uint64)
    at = (sliding_min((hashes & ~low) | places, unit.width - unit.gram + 1) & low).astype(np.int64)[:n]
    lengths = np.diff(ends)
    inside = np.maximum(lengths - unit.width + 1, 0)
    starts = np.repeat(ends[:-1] - (np.cumsum(inside) - inside), inside) + np.arange(int(inside.sum()))
    if not len(starts):
        return none, none, none, np.zeros(0, np.uint64)
    doc = np.repeat(np.arange(len(lengths)), inside)
    at = at[starts]
    new = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])])
    return doc[new], starts[new], np.diff(np.r_[new, len(at)]), hashes[at[new]]


def _parts(batch: pa.RecordBatch, words: bool, width: int) -> Iterator[tuple[list[int], list[int], list[np.ndarray], list[bytes]]]:
    """Bounded lots of (row, first token, tokens, text); long documents in parts that share width - 1 tokens."""
    for piece in slices(batch, 1, _SLICE):
        base = piece.column(0).to_pylist()
        lot: tuple[list, list, list, list] = ([], [], [], [])
        for i, text in enumerate(texts(piece)):
            tok = tokens_of(text, words)
            if len(tok) < width:
                continue
            for at in range(0, len(tok) - width + 1, _PART):
                if at or len(tok) > _PART + width:
                    yield [base[i]], [at], [tok[at:at + _PART + width - 1]], [text]
                else:
                    for held, x in zip(lot, (base[i], 0, tok, text)):
                        held.append(x)
        if lot[0]:
            yield lot


_ANCHORS = pa.schema([("route", pa.int64()), ("doc", pa.int64()), ("sub", pa.int64()), ("n", pa.int32())])


def keyed(df: DataFrame) -> DataFrame:
    """(doc, sub, doc_id, text): (doc, sub) names a document, in the order in which places count.

    Rows with an id: doc is the id and sub a hash of the text, so only rows equal
    in both are one document.  Rows without an id come first and are a document
    each: they are stored, numbered in the order of their texts' hashes, so that
    every later step finds the same numbers.
    """
    rows = pick(df, doc_id="bigint", text="string").withColumn("text", F.coalesce("text", F.lit("")))
    named = rows.where("doc_id is not null").select(F.col("doc_id").alias("doc"), F.xxhash64("text").alias("sub"), "doc_id", "text")
    nameless = rows.where("doc_id is null")
    if nameless.isEmpty():
        return named
    numbered = store(nameless.select(F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("n"), "text")
                     .repartitionByRange("h", "n").sortWithinPartitions("h", "n")
                     .select(F.lit(_NO_ID).alias("doc"), F.monotonically_increasing_id().alias("sub"),
                             F.lit(None).cast("bigint").alias("doc_id"), "text"), "nameless")
    return named.unionByName(numbered)


def anchors(docs: DataFrame, unit: Unit) -> DataFrame:
    """(route, doc, sub, n): the places of each anchor, counted per document."""
    def run(batches):
        for batch in batches:
            keys, subs = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            rows = pa.RecordBatch.from_arrays([pa.array(range(batch.num_rows), pa.int64()), batch.column(2)], names=["row", "text"])
            for which, _, toks, _ in _parts(rows, unit.words, unit.width):
                ends = np.r_[0, np.cumsum([len(t) for t in toks])]
                doc, _, _, route = segments_of(np.concatenate(toks), ends, unit)
                order = np.lexsort((route, doc))
                doc, route = doc[order], route[order]
                new = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (route[1:] != route[:-1])]) if len(doc) else doc
                row = np.array(which, np.int64)[doc[new]]
                yield record_batch(_ANCHORS, route[new].view(np.int64), keys[row], subs[row], np.diff(np.r_[new, len(doc)]))
    return docs.select("doc", "sub", "text").mapInArrow(run, "route bigint, doc bigint, sub bigint, n int")


_SEGMENTS = pa.schema([("route", pa.int64()), ("ckey", pa.binary()), ("doc", pa.int64()), ("sub", pa.int64()),
                       ("start", pa.int64()), ("windows", pa.int32()), ("content", pa.binary())])

_KINDS = "route bigint, ckey binary, doc bigint, sub bigint, start bigint, windows int, content binary"


def repeated_segments(docs: DataFrame, unit: Unit) -> DataFrame:
    """(doc, sub, text, routes) -> segments with an anchor that stands elsewhere too."""
    def content(text: bytes, words: list[bytes] | None, a: int, b: int) -> bytes:
        return text[a:b] if words is None else b" ".join(words[a:b])

    def run(batches):
        for batch in batches:
            routes, r_ends = batch.column(3), batch.column(3).offsets.to_numpy()
            flat = routes.values.to_numpy().view(np.uint64)
            rows = pa.RecordBatch.from_arrays([pa.array(range(batch.num_rows), pa.int64()), batch.column(2)], names=["row", "text"])
            ids, subs = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for which, at, toks, bodies in _parts(rows, unit.words, unit.width):
                ends = np.r_[0, np.cumsum([len(t) for t in toks])]
                tokens = np.concatenate(toks)
                doc, start, windows, route = segments_of(tokens, ends, unit)
                wanted = np.concatenate([flat[r_ends[w]:r_ends[w + 1]] ^ mixed(np.array([i + 1], np.uint64)) for i, w in enumerate(which)])
                wanted.sort()
                if not len(wanted) or not len(doc):
                    continue
                key = route ^ mixed((doc + 1).astype(np.uint64))
                use = wanted[np.minimum(np.searchsorted(wanted, key), len(wanted) - 1)] == key
                doc, start, windows, route = doc[use], start[use], windows[use], route[use]
                split = [b.split() if unit.words else None for b in bodies]
                where = start - ends[doc] + np.array(at, np.int64)[doc]
                bodies_out = [content(bodies[d], split[d], a, a + w + unit.width - 1) for d, a, w in
                              zip(doc.tolist(), where.tolist(), windows.tolist())]
                for a in range(0, len(doc), 20_000):
                    b = slice(a, a + 20_000)
                    row = np.array(which)[doc[b]]
                    yield record_batch(_SEGMENTS, route[b].view(np.int64), [xxhash.xxh3_128_digest(x) for x in bodies_out[b]],
                                       ids[row], subs[row], where[b], windows[b], bodies_out[b])
    return docs.mapInArrow(run, _KINDS)


_INTERVALS = pa.schema([("doc", pa.int64()), ("sub", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])

#: (contents, route numbers, first places (rank of the document, start)) -> (content number, window offset) of windows to remove
Search = Callable[[list[bytes], np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def _search_shards(groups: DataFrame, unit: Unit, search: Search) -> DataFrame:
    """(route, content, doc, sub, start) sorted by route inside partitions -> intervals of removed tokens."""
    def searched(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows)
        route, doc, sub, start = (table.column(n).to_numpy() for n in ("route", "doc", "sub", "start"))
        number = np.cumsum(np.r_[0, route[1:] != route[:-1]])
        several = np.bincount(number)[number] > 1
        keep = np.flatnonzero(several)
        if not len(keep):
            return record_batch(_INTERVALS, [], [], [], [])
        contents = table.column("content").take(pa.array(keep)).to_pylist()
        order = np.lexsort((sub, doc))
        rank = np.zeros(len(doc), np.int64)
        rank[order[1:]] = np.cumsum((doc[order[1:]] != doc[order[:-1]]) | (sub[order[1:]] != sub[order[:-1]]))
        which, offset = search(contents, number[keep], rank[keep], start[keep])
        order = np.lexsort((offset, which))
        which, offset = which[order], offset[order]
        new = np.flatnonzero(np.r_[True, (which[1:] != which[:-1]) | (offset[1:] != offset[:-1] + 1)]) if len(which) else which
        last = np.r_[new[1:], len(which)] - 1 if len(new) else new
        at = keep[which[new]]
        return record_batch(_INTERVALS, doc[at], sub[at], start[at] + offset[new], start[at] + offset[last] + unit.width)

    def run(batches):
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                route = part.column("route").to_numpy()
                if size > _SHARD_BYTES:
                    last = held[-1].column("route")[len(held[-1]) - 1].as_py()
                    cut = int(np.argmax(route != last)) if (route != last).any() else len(route)
                    held.append(part.slice(0, cut))
                    if cut < len(route):
                        yield searched(held)
                        held, size, part = [], 0, part.slice(cut)
                    else:
                        continue
                held.append(part)
                _, ends = utf8(part.column("content"))
                size += int(ends[-1] - ends[0]) + 64 * part.num_rows
        if held:
            yield searched(held)

    return groups.mapInArrow(run, "doc bigint, sub bigint, a bigint, b bigint")


def _pieces(groups: DataFrame, unit: Unit) -> DataFrame:
    """(route, content, doc, sub, start) -> segments of at most ``BLOCK`` windows, by distance from the anchor.

    Windows of equal content hold the anchor at one distance, so they are in
    pieces of one block; the tokens that all windows of a block hold are equal,
    too, and their hash is the pieces' route.
    """
    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                routes, bodies = batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_pylist()
                toks = [tokens_of(body, unit.words) for body in bodies]
                hashes, end, rows = gram_hashes(np.concatenate(toks), unit.gram), 0, []
                for route, body, tok, doc, sub, start in zip(routes, bodies, toks, *(batch.column(i).to_pylist() for i in (2, 3, 4))):
                    parts, n, base = body.split(b" ") if unit.words else body, len(tok) - unit.width + 1, end
                    end += len(tok)
                    place = n - 1 + int(np.argmax(hashes[base + n - 1:base + unit.width - unit.gram + 1] == route))
                    for block in range((place - n + 1) // BLOCK, place // BLOCK + 1):
                        near = place - block * BLOCK  # the first token that all windows of the block hold
                        low, high = max(near - BLOCK + 1, 0), min(near, n - 1)
                        core, piece = parts[near:max(near - BLOCK + 1 + unit.width, near)], parts[low:high + unit.width]
                        if unit.words:
                            core, piece = b" ".join(core), b" ".join(piece)
                        key = xxhash.xxh3_64_intdigest(core, (int(route) + block) & 0xFFFFFFFFFFFFFFFF)
                        rows.append((key, xxhash.xxh3_128_digest(piece), doc, sub, start + low, high - low + 1, piece))
                if rows:
                    key, *rest = map(list, zip(*rows))
                    yield record_batch(_SEGMENTS, np.array(key, np.uint64).view(np.int64), *rest)

    return groups.select("route", "content", "doc", "sub", "start").mapInArrow(run, _KINDS)


_WINDOWS = pa.schema([("wkey", pa.binary()), ("content", pa.binary()), ("doc", pa.int64()), ("sub", pa.int64()),
                      ("start", pa.int64())])


def _window_by_window(groups: DataFrame, unit: Unit, every_place: bool) -> tuple[DataFrame, list[DataFrame]]:
    """Intervals from grouping the windows of distinct segments by their content, and the stored tables they read."""
    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                rows = []
                for body, doc, sub, start in zip(*(batch.column(i).to_pylist() for i in range(4))):
                    parts = body.split(b" ") if unit.words else body
                    for o in range(len(parts) - unit.width + 1):
                        w = parts[o:o + unit.width]
                        w = b" ".join(w) if unit.words else w
                        rows.append((xxhash.xxh3_128_digest(w), w, doc, sub, start + o))
                if rows:
                    yield record_batch(_WINDOWS, *[list(c) for c in zip(*rows)])

    windows = store(groups.select("content", "doc", "sub", "start")
                    .mapInArrow(run, "wkey binary, content binary, doc bigint, sub bigint, start bigint"), "windows", "zstd")
    place = F.struct("doc", "sub", "start")
    first = (windows.groupBy("wkey", "content").agg(F.min(place).alias("first"), F.max(place).alias("last"))
             .where("first <> last").select("wkey", "first"))
    hits = windows.select("wkey", "doc", "sub", "start").join(first, "wkey")
    if not every_place:
        hits = hits.where(place != F.col("first"))
    return hits.select("doc", "sub", F.col("start").alias("a"), (F.col("start") + unit.width).alias("b")), [windows]


def _intervals(segments: DataFrame, unit: Unit, search: Search, every_place: bool, hot: int,
               whole: bool = True) -> tuple[DataFrame, list[DataFrame]]:
    """Intervals from segments (whole ones or pieces), and the stored tables they read."""
    place = F.struct("doc", "sub", "start")
    groups = store(
        segments.groupBy("route", "ckey", "content")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .select("route", "ckey", "content", "first.doc", "first.sub", "first.start",
                (F.col("first") != F.col("last")).alias("copied")), "groups", "zstd")
    firsts = groups.where("copied").select("route", "ckey", place.alias("first"))
    others = segments.select("route", "ckey", "doc", "sub", "start", "windows").join(firsts.hint("shuffle_hash"), ["route", "ckey"])
    if not every_place:
        others = others.where(place != F.col("first"))
    copies = store(others.select("doc", "sub", F.col("start").alias("a"),
                                 (F.col("start") + F.col("windows") + unit.width - 1).alias("b")), "copies", "zstd")
    sizes = store(groups.groupBy("route").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "sizes")
    rows = groups.select("route", "content", "doc", "sub", "start")
    searched = _search_shards(rows.join(sizes.where(F.col("n") <= hot).select("route"), "route")
                              .repartition("route").sortWithinPartitions("route"), unit, search)
    found, held = searched.unionByName(copies), [groups, copies, sizes]
    crowded = sizes.where(F.col("n") > hot).select("route")
    if crowded.isEmpty():
        return found, held
    if whole:
        pieces = store(_pieces(rows.join(crowded, "route"), unit), "pieces", "zstd")
        more, below = _intervals(pieces, unit, search, every_place, hot, False)
        held.append(pieces)
    else:
        more, below = _window_by_window(rows.join(crowded, "route"), unit, every_place)
    return found.unionByName(more), held + below


def _class(df: DataFrame, k: int, n: int, *by: str) -> DataFrame:
    return df if n == 1 else df.where(F.pmod(F.xxhash64(*by), F.lit(n)) == k)


def _listed(parts: list[DataFrame], name: str) -> DataFrame:
    """One row per document from several tables (doc, sub, name: array)."""
    if len(parts) == 1:
        return parts[0]
    return reduce(DataFrame.unionByName, parts).groupBy("doc", "sub").agg(F.flatten(F.collect_list(name)).alias(name))


def removals(docs: DataFrame, unit: Unit, search: Search, every_place: bool, hot: int = HOT) -> DataFrame:
    """``keyed`` rows -> (doc, sub, spans array<struct<a, b>>): tokens to remove, per document that loses any.

    every_place: remove all places of a repeated window, else all but the first
    (by doc, sub, then start).  Rows equal in id and text are one document.
    """
    seen = store(anchors(docs, unit), "anchors", "zstd")
    n = PASSES if seen.count() > _ONE_PASS else 1
    wanted = []
    for k in range(n):
        part = _class(seen, k, n, "route")
        twice = part.groupBy("route").agg(F.sum("n").alias("total")).where("total > 1").select("route")
        wanted.append(store(part.select("route", "doc", "sub").join(twice.hint("shuffle_hash"), "route").groupBy("doc", "sub")
                            .agg(F.collect_list("route").alias("routes")), "wanted", "zstd"))
    discard(seen)
    segments = []
    for k in range(n):
        routes = _listed([_class(x, k, n, "doc", "sub") for x in wanted], "routes")
        segments.append(store(repeated_segments(_class(docs, k, n, "doc", "sub").join(routes.hint("shuffle_hash"), ["doc", "sub"])
                                                .select("doc", "sub", "text", "routes"), unit), "segments", "zstd"))
    discard(*wanted)
    spans = []
    for k in range(n):
        found, held = _intervals(_class(reduce(DataFrame.unionByName, segments), k, n, "route"), unit, search, every_place, hot)
        spans.append(store(found.groupBy("doc", "sub").agg(F.collect_list(F.struct("a", "b")).alias("spans")), "spans", "zstd"))
        discard(*held)
    discard(*segments)
    if n == 1:
        return spans[0]
    out = store(_listed(spans, "spans"), "spans", "zstd")
    discard(*spans)
    return out


def apply_removals(docs: DataFrame, spans: DataFrame, run, schema: str) -> DataFrame:
    """Give each ``keyed`` row's (doc_id, text, spans) to ``run``; documents without spans get none."""
    return docs.join(spans.hint("shuffle_hash"), ["doc", "sub"], "left").select("doc_id", "text", "spans").mapInArrow(run, schema)


def removed_mask(length: int, spans: list | None) -> np.ndarray:
    edges = np.zeros(length + 1, np.int64)
    if spans:
        a = np.array([s["a"] for s in spans])
        b = np.array([s["b"] for s in spans])
        np.add.at(edges, a, 1)
        np.add.at(edges, b, -1)
    return np.cumsum(edges[:-1]) > 0
