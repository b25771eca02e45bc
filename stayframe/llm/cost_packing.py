"""Cost-balanced packing of tokenised documents into sequences of bounded length.

Documents are dealt to tasks by a hash of their row, so that every task sees a
mix of the corpus, and are tokenised there.  A task packs shard by shard: a
shard is a bounded number of tokens, a multiple of the capacity (what is over
goes on to the next shard), so its sequences can be filled to the last token.
Each piece has an estimated cost, linear in its tokens plus quadratic for its
attention; pieces are taken by descending length and go to the sequence with
the lowest cost that has room for the whole piece, or, where none has, the
piece is cut to fill the lowest-cost sequence with any room and the rest waits
its turn.  The last shard of a task ends with sequences whose lengths are the
binary digits of the tokens left over: powers of two need no padding.

One pass, one shuffle of the texts; a task holds one shard and one text.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayframe.llm.common import documents, record_batch, slices, texts
from stayframe.llm.packing import _worker_encoder, default_tokenizer

CAPACITY = 4096
END_ID = 2
#: Tokens whose linear work equals the attention of one token to one other: 24 h^2 against 4 h
#: multiplications a layer, for a hidden size h of 1024.
LINEAR = 6 * 1024
SHARD_TOKENS = 1 << 20
_SLICE = 2 << 20  # bytes of text tokenised at once in a task


def piece_cost(length, linear: int = LINEAR):
    """Estimated cost of a piece: ``linear`` a token and 1 for each pair of its tokens."""
    return length * linear + length * length


def room_of(total: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of sequences that hold ``total`` tokens without padding: full ones, then powers of two."""
    full, rest = divmod(total, capacity)
    return [capacity] * full + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def balance(lengths: list[int], rooms: list[int], linear: int = LINEAR) -> list[tuple[int, int, int, int, int]]:
    """(row, start, length, sequence, offset) of pieces; lengths and rooms have the same sum.

    Pieces by descending length, ties by row; sequences by lowest cost, ties by number.
    """
    if sum(lengths) != sum(rooms):
        raise ValueError("sequences must hold exactly the tokens given")
    waiting = [(-n, row, 0) for row, n in enumerate(lengths) if n]
    heapq.heapify(waiting)
    room, load, taken, out = np.array(rooms, np.int64), np.zeros(len(rooms)), np.zeros(len(rooms), np.int64), []
    while waiting:
        n, row, start = heapq.heappop(waiting)
        n = -n
        open_ = np.flatnonzero(room >= n)
        if not len(open_):
            open_ = np.flatnonzero(room)
        s = int(open_[load[open_].argmin()])
        part = min(n, int(room[s]))
        out.append((row, start, part, s, int(taken[s])))
        room[s] -= part
        taken[s] += part
        load[s] += piece_cost(part, linear)
        if part < n:
            heapq.heappush(waiting, (part - n, row, start + part))
    return out


class _Packer:
    """Pieces of one task, packed whenever a shard of tokens is there."""

    def __init__(self, base: int, capacity: int, linear: int, shard_tokens: int, schema: pa.Schema, with_ids: bool):
        self.base, self.capacity, self.linear = base, capacity, linear
        self.limit = max(1, shard_tokens // capacity) * capacity
        self.schema, self.with_ids = schema, with_ids
        self.held: list[tuple] = []  # doc_id, tokens of the document, start, ids
        self.tokens = self.sequences = 0

    def add(self, doc_id, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(ids), self.capacity):
            part = ids[at:at + self.capacity]
            self.held.append((doc_id, len(ids), at, part))
            self.tokens += len(part)
            if self.tokens >= self.limit:
                yield self._full()

    def _full(self) -> pa.RecordBatch:
        """A shard of full sequences; tokens beyond a multiple of the capacity stay."""
        over, kept = self.tokens % self.capacity, []
        while over:
            doc_id, total, at, ids = self.held.pop()
            cut = max(0, len(ids) - over)
            if cut:
                self.held.append((doc_id, total, at, ids[:cut]))
            kept.append((doc_id, total, at + cut, ids[cut:]))
            over -= len(ids) - cut
        out = self.pack()
        self.held, self.tokens = kept[::-1], sum(len(k[3]) for k in kept)
        return out

    def pack(self) -> pa.RecordBatch:
        rooms = room_of(sum(len(h[3]) for h in self.held), self.capacity)
        rows = []
        for row, start, n, s, offset in balance([len(h[3]) for h in self.held], rooms, self.linear):
            doc_id, total, at, ids = self.held[row]
            part = ids[start:start + n]
            out = (doc_id, at + start, n, zlib.crc32(part.tobytes()), total, self.base + self.sequences + s, offset)
            rows.append((*out, part.astype(np.int32)) if self.with_ids else out)
        self.sequences += len(rooms)
        self.held, self.tokens = [], 0
        return record_batch(self.schema, *[list(c) for c in zip(*rows)])


_PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                     ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


def pack_balanced(df: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
                  linear: int = LINEAR, shard_tokens: int = SHARD_TOKENS, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids].

    Every id of every document is in exactly one piece; a sequence holds
    ``capacity`` tokens, or, up to once for each binary digit of the capacity
    and task, a smaller power of two (``capacity`` must be one), so no sequence
    needs padding.  Sequence ids are unique numbers with gaps.

    Nulls: a null text is empty (one piece, the end id alone); a null doc_id
    stays null.  Repeated rows and rows that share an id are packed as often as
    they come.  Ties: equal lengths go by the order of their rows' hashes, equal
    costs to the lower sequence.  Very long texts are cut like any others and
    may run on through several shards.  Empty table: empty result.  Other
    columns, whatever their names, are ignored.
    """
    from pathlib import Path
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    spec = df.sparkSession.sparkContext.broadcast(Path(tokenizer or default_tokenizer()).read_text("utf-8"))
    schema = pa.schema([*_PIECES, ("ids", pa.list_(pa.int32()))]) if with_ids else _PIECES
    deal = F.xxhash64(F.monotonically_increasing_id())
    # sorted, so that a task that runs again packs the same rows in the same order
    dealt = documents(df).withColumn("deal", deal).repartition("deal").sortWithinPartitions("deal").drop("deal")

    def run(batches):
        encoder = _worker_encoder(spec.value)
        packer = _Packer(TaskContext.get().partitionId() << 40, capacity, linear, shard_tokens, schema, with_ids)
        for whole in batches:
            for batch in slices(whole, 1, _SLICE):
                for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode(texts(batch))):
                    yield from packer.add(doc_id, np.append(ids, np.int32(end_id)).astype("<u4"))
        if packer.held:
            yield packer.pack()

    kinds = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
             "offset bigint")
    return dealt.mapInArrow(run, kinds + ", ids array<int>" * with_ids)


def sequence_costs(packed: DataFrame, linear: int = LINEAR) -> DataFrame:
    """sequence_id, tokens, pieces, cost of the sequences of ``pack_balanced``."""
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("tokens"), F.count(F.lit(1)).alias("pieces"),
                                             F.sum(piece_cost(F.col("length"), linear)).alias("cost"))
