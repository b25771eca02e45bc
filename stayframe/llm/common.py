"""Helpers shared by the operators: column picking, stored intermediates, Arrow text views."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayframe.session import ensure_checkpoint_dir
from stayframe.sources.staging import remove

#: ASCII white space as the contracts define it; the same text works in Java, RE2 and Python.
SPACES = r"[\x20\x09-\x0D]+"
WORDS = r"[^\x20\x09-\x0D]+"

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **types: str) -> DataFrame:
    """The named columns, cast, whatever other columns there are.

    Columns are found by exact name, then position, so further columns whose
    names differ only in case (or repeat) do not make a name ambiguous.
    """
    where = {}
    for i, name in enumerate(df.columns):
        where.setdefault(name, i)
    for name in types:
        if name not in where:
            raise ValueError(f"input has no column {name!r}; it has {df.columns}")
    flat = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return flat.select(*[F.col(f"c{where[n]}").cast(t).alias(n) for n, t in types.items()])


def documents(df: DataFrame) -> DataFrame:
    """(doc_id long, text string) with null texts as empty ones."""
    return pick(df, doc_id="bigint", text="string").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"))


ROW_KEY = ["_no_id", "_id", "_digest", "_rest"]


def with_row_key(df: DataFrame) -> DataFrame:
    """The columns as c0, c1, ... and ROW_KEY, which orders rows by id (nulls last) and tells rows apart that differ."""
    flat = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    doc_id, text = (F.col(f"c{df.columns.index(n)}").cast(t) for n, t in (("doc_id", "bigint"), ("text", "string")))
    # maps have no hash of their own
    whole = [F.to_json(F.struct(f.name)) if "map<" in f.dataType.simpleString() else F.col(f.name) for f in flat.schema]
    return flat.select("*", doc_id.isNull().alias("_no_id"), F.coalesce(doc_id, F.lit(0)).alias("_id"),
                       F.md5(F.coalesce(text, F.lit(""))).alias("_digest"), F.xxhash64(*whole).alias("_rest"))


def only_rows(df: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of ``df`` whose ROW_KEY is in ``keys``, all columns kept; of rows equal in all columns, one."""
    return with_row_key(df).join(keys, ROW_KEY, "left_semi").dropDuplicates(ROW_KEY).drop(*ROW_KEY).toDF(*df.columns)


def crc32_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id written in decimal, modulo ``divisor``; a null id counts as ''."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor).cast("int")


def store(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and scan it from there; codec: of Parquet, else the session's.

    This cuts the lineage: a lost executor makes Spark read files again instead
    of repeating the steps before.  Shuffle files of the writing job are
    released when it ends (where Spark has that setting), so disk use is that of
    the largest step, not of all of them.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stayframe-llm/{uuid.uuid4().hex[:12]}/{name}"
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("parquet.compression.codec.zstd.level", 1).parquet(path, compression=codec)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*stored: DataFrame) -> None:
    """Delete stored intermediates whose successors are stored."""
    for df in stored:
        remove(df.sparkSession, df.stored_at)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary Arrow column without copying; nulls are empty."""
    if column.null_count:
        column = pc.fill_null(column, pa.scalar(b"" if pa.types.is_binary(column.type) else "", column.type))
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if large else np.int32
    ends = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64) \
        if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, ends


def texts(batch: pa.RecordBatch, at: int = 1) -> list[bytes]:
    raw, ends = utf8(batch.column(at))
    view = raw.tobytes() if len(raw) and not raw.flags["C_CONTIGUOUS"] else memoryview(raw)
    return [bytes(view[ends[i]:ends[i + 1]]) for i in range(len(ends) - 1)]


def slices(batch: pa.RecordBatch, at: int, budget: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most ``budget`` bytes of column ``at`` (one row at least)."""
    _, ends = utf8(batch.column(at))
    start, n = 0, len(ends) - 1
    while start < n:
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] + budget, "right")) - 1)
        yield batch.slice(start, min(stop, n) - start)
        start = stop


def record_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
