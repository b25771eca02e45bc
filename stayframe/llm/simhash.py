"""SimHash near-duplicates by a segment-popcount embedding and a grid range join.

Fingerprint: bit i is 1 when it is set in more than half of the XXH64 values of
the text's word shingles.  Embedding: the 64 bits are cut into 32 segments of
two bits, and each segment is mapped to its number of set bits (0, 1, 2), kept
in unary (00, 01, 11) so that the Manhattan distance of two embeddings is the
popcount of their XOR.  It never exceeds the Hamming distance of the
fingerprints, so a range join on the embedding loses no link.

Grid: the 32 counts form six groups.  Within Manhattan distance 3 at most three
groups can differ, so two linked fingerprints share a grid cell in at least one
of the 20 projections on three groups.  Cells are compared in the task that
holds them: first the Manhattan bound, then the exact bit distance.  A cell
gives a spanning forest of its links (at most one row per fingerprint), never
all pairs, and components are built from those forests.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayframe.llm.common import ROW_KEY, documents, only_rows, record_batch, store, texts, with_row_key
from stayframe.llm.components import connected_components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
SEGMENTS = 32
GROUPS = 6
_LOW = 0x5555555555555555
_PAIRWISE = 24  # cells up to this size are compared row against shifted row, all cells of a batch at once


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash of A-Z lower-cased words; 0 when there is no word."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams: Iterator[tuple[bytes, ...]] = iter([tuple(words)])
        n = 1
    else:
        grams = zip(*[words[i:] for i in range(shingle)])
        n = len(words) - shingle + 1
    join, digest = b" ".join, xxhash.xxh64_intdigest
    ones, left = np.zeros(64, np.int64), n
    while left:  # bounded pieces of the bit matrix, whatever the length of the text
        k = min(left, 1 << 14)
        values = np.fromiter((digest(join(g), seed) for g, _ in zip(grams, range(k))), np.uint64, k) \
            if left <= k else np.fromiter((digest(join(next(grams)), seed) for _ in range(k)), np.uint64, k)
        bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
        left -= k
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


_FINGERPRINTS = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])


def fingerprints(df: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, fp): fp as the signed long with the fingerprint's bits."""
    def run(batches):
        for batch in batches:
            out = np.fromiter((fingerprint(t, shingle, seed) for t in texts(batch)), np.uint64, batch.num_rows)
            yield record_batch(_FINGERPRINTS, batch.column(0), out.view(np.int64))
    return documents(df).mapInArrow(run, "doc_id bigint, fp bigint")


def group_masks(groups: int = GROUPS) -> list[int]:
    """Bit masks of the groups of two-bit segments."""
    edges = [round(SEGMENTS * g / groups) for g in range(groups + 1)]
    return [sum(3 << (2 * s) for s in range(a, b)) for a, b in zip(edges, edges[1:])]


def cell_masks(max_bits: int = MAX_BITS, groups: int = GROUPS) -> list[int]:
    """One mask per choice of the groups that stay equal when max_bits of them differ."""
    if not 0 <= max_bits < groups:
        raise ValueError("max_bits must be below the number of groups")
    parts = group_masks(groups)
    return [sum(parts[i] for i in keep) for keep in combinations(range(groups), groups - max_bits)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _forest(fp: np.ndarray, emb: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Spanning edges (positions) of the links inside one cell.

    Each popped row is compared with the rows not yet reached, and rows it
    reaches leave that set, so a dense cluster empties it after a few rows.
    """
    rest, edges = np.arange(len(fp)), []
    while len(rest):
        stack, rest = [rest[0]], rest[1:]
        while stack and len(rest):
            x = stack.pop()
            near = np.bitwise_count(emb[rest] ^ emb[x]) <= max_bits
            near[near] = np.bitwise_count(fp[rest[near]] ^ fp[x]) <= max_bits
            hit = rest[near]
            edges.extend((x, y) for y in hit)
            stack.extend(hit)
            rest = rest[~near]
    return edges


def cell_links(cell: np.ndarray, fp: np.ndarray, node: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside runs of equal ``cell`` (sorted): two arrays of nodes."""
    low = fp & np.uint64(_LOW)
    high = (fp >> np.uint64(1)) & np.uint64(_LOW)
    emb = (low | high) | ((low & high) << np.uint64(1))
    starts = np.flatnonzero(np.r_[True, np.any(cell[1:] != cell[:-1], axis=1)])
    sizes = np.diff(np.r_[starts, len(fp)])
    size_of = np.repeat(sizes, sizes)
    left, right = [], []
    small = np.flatnonzero((size_of > 1) & (size_of <= _PAIRWISE))
    run_of = np.repeat(np.arange(len(starts)), sizes)
    for d in range(1, _PAIRWISE):
        i = small[small + d < len(fp)]
        i = i[run_of[i] == run_of[i + d]]
        if not len(i):
            break
        i = i[np.bitwise_count(emb[i] ^ emb[i + d]) <= max_bits]
        i = i[np.bitwise_count(fp[i] ^ fp[i + d]) <= max_bits]
        left.append(node[i])
        right.append(node[i + d])
    for k in np.flatnonzero(sizes > _PAIRWISE):
        at = slice(starts[k], starts[k] + sizes[k])
        if edges := _forest(fp[at], emb[at], max_bits):
            pairs = np.array(edges) + starts[k]
            left.append(node[pairs[:, 0]])
            right.append(node[pairs[:, 1]])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def links(distinct: DataFrame, max_bits: int = MAX_BITS, groups: int = GROUPS) -> DataFrame:
    """(fp, node), one row per fingerprint -> edges (a, b) that connect all linked nodes."""
    low = F.col("fp").bitwiseAND(F.lit(_LOW))
    high = F.shiftrightunsigned("fp", 1).bitwiseAND(F.lit(_LOW))
    emb = low.bitwiseOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))
    cells = F.array(*[F.struct(F.lit(i).alias("p"), emb.bitwiseAND(F.lit(_signed(m))).alias("cell"))
                      for i, m in enumerate(cell_masks(max_bits, groups))])
    rows = (distinct.select("fp", "node", F.explode(cells).alias("c"))
            .select("c.p", "c.cell", "fp", "node")
            .repartition("p", "cell").sortWithinPartitions("p", "cell"))

    def run(batches):
        held = None
        for batch in batches:
            p, cell, fp, node = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            now = np.column_stack([p, cell, fp, node]).astype(np.int64)
            now = now if held is None else np.concatenate([held, now])
            last = int(np.argmax(np.all(now[:, :2] == now[-1, :2], axis=1)))  # the last cell may go on
            held, done = now[last:], now[:last]
            if len(done):
                yield record_batch(_EDGES, *cell_links(done[:, :2], done[:, 2].copy().view(np.uint64), done[:, 3], max_bits))
        if held is not None:
            yield record_batch(_EDGES, *cell_links(held[:, :2], held[:, 2].copy().view(np.uint64), held[:, 3], max_bits))

    return rows.mapInArrow(run, "a bigint, b bigint")


def near_duplicates(df: DataFrame, max_bits: int = MAX_BITS, shingle: int = SHINGLE, seed: int = SEED,
                    groups: int = GROUPS) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest doc_id reachable over links, itself included.
    Nulls: a null text has fingerprint zero, linked like any other; rows with a
    null doc_id get the component of their fingerprint but link nothing (null
    when no row with an id has that fingerprint).  Repeated rows are returned as
    often as they come.  Empty table: empty result.  Other columns are ignored.
    """
    rows = store(fingerprints(df, shingle, seed), "fingerprints")
    distinct = store(rows.groupBy("fp").agg(F.min("doc_id").alias("node")).where("node is not null"), "distinct")
    roots = connected_components(links(distinct, max_bits, groups))
    classes = (distinct.join(roots, "node", "left")
               .select("fp", F.coalesce("root", "node").alias("component_id")))
    return (rows.join(classes, "fp", "left")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def keep_one(df: DataFrame, max_bits: int = MAX_BITS, shingle: int = SHINGLE, seed: int = SEED,
             groups: int = GROUPS) -> DataFrame:
    """Of each component of linked fingerprints the row with the smallest id, all columns kept.

    Every row links by its own fingerprint, also one without an id or whose id
    has another text; a component without any id keeps one row too.
    """
    def run(batches):
        for batch in batches:
            fp = np.fromiter((fingerprint(t, shingle, seed) for t in texts(batch, len(ROW_KEY))), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(fp.view(np.int64))], names=[*ROW_KEY, "fp"])

    text = F.coalesce(F.col(f"c{df.columns.index('text')}").cast("string"), F.lit(""))
    rows = store(with_row_key(df).select(*ROW_KEY, text.alias("text"))
                 .mapInArrow(run, "_no_id boolean, _id bigint, _digest string, _rest bigint, fp bigint"), "fingerprints")
    distinct = store(rows.select("fp", F.col("fp").alias("node")).distinct(), "distinct")
    roots = connected_components(links(distinct, max_bits, groups))
    classes = distinct.join(roots, "node", "left").select("fp", F.coalesce("root", "node").alias("component"))
    kept = rows.join(classes, "fp").groupBy("component").agg(F.min(F.struct(*ROW_KEY)).alias("row")).select("row.*")
    return only_rows(df, kept)
