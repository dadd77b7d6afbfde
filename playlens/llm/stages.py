"""Helpers shared by the operators: keys of documents, written stages, streams of Arrow columns."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from playlens.session import write_stage

NO_ID = -(1 << 63)  # stands for a null id inside an operator; sorts before all others
BATCH_ROWS, BATCH_BYTES = 1_000, 4 << 20

__all__ = ["write_stage", "keyed", "key_columns", "small_batches", "without", "with_text", "map_arrow", "array_column", "table", "hash_bitmap", "in_bitmap", "likely_in", "original_id", "task_memo"]

_memos: list[dict] = []


def task_memo(memo: dict) -> dict:
    """A memo of a worker for one task: Spark keeps idle workers, and what they remember is memory the next stage lacks."""
    _memos.append(memo)
    return memo


def small_batches(spark: SparkSession) -> None:
    """What a Python worker gets at once: some megabytes, since texts can be long; one text is never split."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def keyed(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_key, rid, text): an id without nulls, and a second key where ids are not unique.

    ``doc_key`` is the id, or ``NO_ID`` for null. ``rid`` is 0 while every id is unique and not null, else a hash
    of the text, so rows that share an id but not their text stay apart. Rows equal in both are one document.
    """
    key, rid = key_columns(docs, id_column, text)
    return docs.select(key.alias("doc_key"), rid.alias("rid"), F.col(text).alias("text"))


def key_columns(docs: DataFrame, id_column: str, text: str) -> tuple[Column, Column]:
    small_batches(docs.sparkSession)
    key = F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID).cast("long"))
    odd = docs.groupBy(key.alias("k")).agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") > 1) | (F.col("k") == NO_ID))
    unique = not odd.limit(1).count()
    return key, F.lit(0).cast("long") if unique else F.xxhash64(F.col(text), F.col(text).isNull())


def without(docs: DataFrame, dropped: DataFrame, id_column: str = "doc_id", text: str = "text", once: bool = False) -> DataFrame:
    """Rows of ``docs``, all columns, whose (doc_key, rid) is not in ``dropped``; ``once``: rows equal in id and text only once."""
    key, rid = key_columns(docs, id_column, text)
    row = docs.select(key.alias("doc_key"), rid.alias("rid"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    left = row.join(dropped, ["doc_key", "rid"], "left_anti")
    return (left.dropDuplicates(["doc_key", "rid"]) if once else left).select("row.*")


def with_text(docs: DataFrame, texts: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs``, all columns, with the text that (doc_key, rid, new_text) gives; rows without one go."""
    key, rid = key_columns(docs, id_column, text)
    others = [c for c in docs.columns if c != text]
    row = docs.select(key.alias("doc_key"), rid.alias("rid"), F.struct(*(F.col(f"`{c}`") for c in others)).alias("row"))
    joined = row.join(texts.dropDuplicates(["doc_key", "rid"]), ["doc_key", "rid"])
    return joined.select(*(F.col("new_text").alias(text) if c == text else F.col(f"row.`{c}`") for c in docs.columns))


def map_arrow(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """``mapInArrow`` whose workers, which Spark uses again, forget their memos and give freed memory back when a task is done."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            release_memory()

    return df.mapInArrow(task, schema)


def release_memory() -> None:
    for memo in _memos:
        memo.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def array_column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def table(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in columns.items()})


BITS = 1 << 24  # of a bitmap of hashes: 2 MB, whatever it stands for


def hash_bitmap(df: DataFrame, column: str) -> Broadcast:
    """A fixed-size bitmap of the top bits of 64-bit hashes, broadcast. What it lets pass still has to be joined."""
    bit = F.shiftrightunsigned(F.col(column), 40)
    words = df.select(bit.alias("bit")).groupBy(F.shiftright("bit", 5).cast("int").alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(bit % 32 as int)))").alias("bits"))
    bitmap = np.zeros(BITS // 32, np.uint32)
    for word, bits in words.collect():  # one row per 32 bits at most
        bitmap[word] = bits
    return df.sparkSession.sparkContext.broadcast(bitmap)


def in_bitmap(hashes: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    bit = hashes >> np.uint64(40)
    return (bitmap[bit >> np.uint64(5)] >> (bit & np.uint64(31)).astype(np.uint32)) & np.uint32(1) > 0


def likely_in(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Keyed documents that may be among ``keys`` (doc_key, rid), so that a join shuffles few other texts."""
    own = F.xxhash64("doc_key", "rid").alias("h")
    bitmap = hash_bitmap(keys.select(own), "h")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = in_bitmap(array_column(batch, "h").view(np.uint64), bitmap.value)
            yield batch.select(["doc_key", "rid", "text"]).filter(pa.array(keep))

    return map_arrow(rows.select("doc_key", "rid", "text", own), work, "doc_key long, rid long, text string")


def original_id(column: str = "doc_key") -> Column:
    return F.when(F.col(column) != NO_ID, F.col(column))
