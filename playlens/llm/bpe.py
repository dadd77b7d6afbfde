"""Byte-level BPE (operator 2): every distinct word is encoded once, however many documents hold it.

Texts are cut into pre-tokens. A task numbers the distinct words of some megabytes of texts (a block) and keeps the numbers in
text order: that is where each word stands. The distinct words are dealt out by their hash over all tasks, encoded there, and
their ids come back to their block, which puts each document together by position. So words cross the network once per
block and not once per occurrence, and the positions travel as packed numbers.

Decoding looks ids up in the table of token bytes, which has one row per id of the vocabulary.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import xxhash
import zstandard
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession

from playlens.llm import rolling
from playlens.llm.stages import map_arrow, small_batches, table

BLOCK_BYTES = 24 << 20  # of text
BUCKETS = 64  # lists a block's words are dealt to; each holds some thousand words
MEMO = 150_000  # words a task remembers
WORDS_AT_ONCE = 1 << 14  # whose ids are made one by one
MOST_VOCABULARY = 64 << 20  # bytes of a rank file that may be broadcast
ORDER, WORDS = -1, 0  # kinds of rows: a block's positions (first in sort order), a list of its words
ROW = "key long, block long, bucket int, ids array<long>, sizes array<int>, body binary, lengths binary"


class Vocabulary:
    """Ranks of byte strings, as read from a rank file of ``base64 rank`` lines."""

    def __init__(self, data: bytes, pattern: str):
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}
        self.encoding = tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.token_bytes = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.token_bytes[rank] = token

    def encode_word(self, word: str) -> list[int]:
        return self.encoding.encode_ordinary(word)


_loaded: dict[tuple, Vocabulary] = {}


def _vocabulary(shared: Broadcast) -> Vocabulary:
    data, pattern = shared.value
    key = (hash(data), pattern)
    if key not in _loaded:
        _loaded[key] = Vocabulary(data, pattern)
    return _loaded[key]


def share_vocabulary(spark: SparkSession, path: str, pattern: str) -> Broadcast:
    data = Path(path).read_bytes()
    if len(data) > MOST_VOCABULARY:
        raise ValueError(f"{path}: a rank file of {len(data)} bytes is too large to broadcast")
    return spark.sparkContext.broadcast((data, pattern))


def _row(key, block, bucket, body, lengths, ids=(), sizes=()) -> pa.RecordBatch:
    return table(
        key=pa.array([key], pa.int64()), block=pa.array([block], pa.int64()), bucket=pa.array([bucket], pa.int32()), ids=pa.array([ids], pa.list_(pa.int64())),
        sizes=pa.array([sizes], pa.list_(pa.int32())), body=pa.array([body], pa.binary()), lengths=pa.array([lengths], pa.binary()))


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers, one byte plane after the other, compressed."""
    rows = np.ascontiguousarray(numbers, "<u4").view(np.uint8).reshape(-1, 4)
    zipped = zstandard.ZstdCompressor(level=3).compressobj(size=rows.size)
    parts = [zipped.compress(rows[a: a + rolling.CHUNK, plane].tobytes()) for plane in range(4) for a in range(0, len(rows), rolling.CHUNK)]
    return b"".join(parts) + zipped.flush()


def _unpacked(data: bytes) -> np.ndarray:
    rows = np.empty((zstandard.frame_content_size(data) // 4, 4), np.uint8)
    with zstandard.ZstdDecompressor().stream_reader(data) as planes:
        for plane in range(4):
            for a in range(0, len(rows), rolling.CHUNK):
                part = rows[a: a + rolling.CHUNK, plane]
                part[:] = np.frombuffer(planes.read(len(part)), np.uint8)
    return rows.view("<u4").ravel()


#: Classes of the pattern that depend on a Unicode version, each with a character that all versions have in it.
CLASSES = {r"\s": "\u3000", r"\p{N}": "\u0661", r"\p{L}": "\u4e00"}
OTHER = "\u00a7"  # in none of them


def unlike_characters() -> dict[int, str]:
    """Code points that the tokenizer library and this process's ``regex`` put in different classes, with one that both put
    where the library has it. The library drops what a pattern does not match, so one text of all code points shows a class."""
    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    single = {bytes([i]): i for i in range(256)}
    theirs, ours = {}, {}
    for name in CLASSES:
        probe = tiktoken.Encoding("probe", pat_str=name, mergeable_ranks=single, special_tokens={})
        theirs[name] = set(bytes(probe.encode_ordinary(every)).decode())
        ours[name] = set(regex.findall(name, every))
    unlike = set().union(*(theirs[name] ^ ours[name] for name in CLASSES))
    return {ord(c): next((like for name, like in CLASSES.items() if c in theirs[name]), OTHER) for c in unlike}


def pieces(text: str, pattern: regex.Pattern, unlike: dict[int, str], characters: frozenset[str]) -> list[str]:
    """The matches of the pattern as the library sees its classes."""
    if text.isascii() or characters.isdisjoint(text):
        return pattern.findall(text)
    return [text[m.start(): m.end()] for m in pattern.finditer(text.translate(unlike))]


def _cut(batches: Iterator[pa.RecordBatch], pattern: str, unlike: dict[int, str]) -> Iterator[pa.RecordBatch]:
    """Blocks of documents as one row of positions and rows of words by hash bucket."""
    compiled, characters = regex.compile(pattern), frozenset(map(chr, unlike))
    task, number = TaskContext.get().partitionId(), 0
    words: dict[str, int] = {}
    order = array("I")
    ids: list = []
    sizes: list[int] = []
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal number
        block = (task << 32) | number
        number += 1
        text = list(words)
        words.clear()  # the numbers are the places in the list now
        # words stand by bucket; frequent ones first in each, which keeps the packed numbers small
        bucket = np.fromiter((xxhash.xxh3_64_intdigest(w.encode()) % BUCKETS for w in text), np.int64, len(text))
        # the positions are most of a block: counted and renumbered in place, some at a time
        places = np.frombuffer(order, np.uint32)
        parts = [places[a: a + rolling.CHUNK] for a in range(0, len(places), rolling.CHUNK)]
        count = np.zeros(len(text), np.int64)
        for part in parts:
            count += np.bincount(part, minlength=len(text))
        ranked = np.argsort(-count, kind="stable")
        by_bucket = np.argsort(bucket, kind="stable")
        frequency = np.empty(len(text), np.uint32)
        frequency[ranked] = np.arange(len(text), dtype=np.uint32)
        # numbers in the order row follow frequency; `lengths` of a word row carry both length and number
        for part in parts:
            part[:] = frequency[part]
        yield _row(block, block, ORDER, _packed(places), b"", ids, sizes)
        edges = np.searchsorted(bucket[by_bucket], np.arange(BUCKETS + 1))
        for b in range(BUCKETS):
            mine = by_bucket[edges[b]: edges[b + 1]]
            if len(mine):
                held = [text[i].encode() for i in mine.tolist()]
                yield _row(
                    b, block, b, zstandard.ZstdCompressor(level=3).compress(b"".join(held)), _packed(np.concatenate([np.fromiter(map(len, held), np.uint32, len(held)), frequency[mine]])))

    for batch in batches:
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            text = text.as_py() or ""
            found = pieces(text, compiled, unlike, characters)
            order.extend(words.setdefault(w, len(words)) for w in found)
            ids.append(doc)
            sizes.append(len(found))
            size += len(text)
            if size >= BLOCK_BYTES:
                yield from flush()
                words, order, ids, sizes, size = {}, array("I"), [], [], 0
    if ids:
        yield from flush()


def _encode_lists(batches: Iterator[pa.RecordBatch], shared: Broadcast) -> Iterator[pa.RecordBatch]:
    """Word lists become lists of ids; rows of positions pass."""
    vocabulary, memo = _vocabulary(shared), {}
    for batch in batches:
        for i, bucket in enumerate(batch.column("bucket").to_pylist()):
            row = batch.slice(i, 1)
            if bucket == ORDER:
                yield row
                continue
            lengths, numbers = np.split(_unpacked(row.column("lengths")[0].as_py()), 2)
            data = zstandard.ZstdDecompressor().decompress(row.column("body")[0].as_py())
            if len(memo) > MEMO:
                memo.clear()
            out, counts, at = array("I"), array("I"), 0
            for n in lengths.tolist():
                word = data[at: at + n]
                at += n
                ids = memo.get(word)
                if ids is None:
                    ids = memo[word] = array("I", vocabulary.encode_word(word.decode()))
                out += ids
                counts.append(len(ids))
            block = row.column("block")[0].as_py()
            yield _row(block, block, bucket, _packed(np.frombuffer(out, np.uint32)), _packed(np.concatenate([np.frombuffer(counts, np.uint32), numbers])))


def _assemble(batches: Iterator[pa.RecordBatch], shared: Broadcast, columns: list[str]) -> Iterator[pa.RecordBatch]:
    """Documents of each block: ids in text order, and what they decode to."""
    token_bytes = _vocabulary(shared).token_bytes
    block, order, held = None, None, []

    def flush() -> Iterator[pa.RecordBatch]:
        doc_ids, sizes, places = order[0], order[1], _unpacked(order[2])
        # ids of all words one after the other, by the words' numbers; a word is some ids, so lists of them would be most of the memory
        count = np.zeros(sum(len(n) for n, _, _ in held), np.int64)
        for numbers, counts, _ in held:
            count[numbers] = counts
        first = np.cumsum(count) - count
        flat = np.empty(int(count.sum()), np.int32)
        for numbers, counts, ids in held:
            flat[np.arange(len(ids)) + np.repeat(first[numbers] - (np.cumsum(counts, dtype=np.int64) - counts), counts)] = ids
        if not count.all() or places.size and int(places.max()) >= len(count):
            raise RuntimeError("a block's words came back incomplete")

        def of_words(made: Callable[[list[int]], object]) -> list:
            out = []
            for a in range(0, len(count), WORDS_AT_ONCE):
                n = count[a: a + WORDS_AT_ONCE]
                ids = flat[first[a]: first[a] + n.sum()].tolist()
                ends = np.cumsum(n)
                out += [made(ids[b:e]) for b, e in zip((ends - n).tolist(), ends.tolist())]
            return out

        decoded = of_words(lambda ids: b"".join([token_bytes[i] for i in ids])) if {"decoded", "decoded_sha256"} & set(columns) else []
        written = of_words(lambda ids: ",".join(map(str, ids))) if "ids_sha256" in columns else []
        ends = np.cumsum(sizes)
        for a, b in rolling.groups_of_rows(np.array(sizes), rolling.CHUNK // 4):
            spans = [places[e - n: e].tolist() for e, n in zip(ends[a:b].tolist(), sizes[a:b])]
            out = {"doc_id": pa.array(doc_ids[a:b], pa.int64()), "n_tokens": pa.array([int(count[s].sum()) for s in spans], pa.int64())}
            if "ids" in columns:
                words = places[ends[a] - sizes[a]: ends[b - 1]]
                n = count[words]
                values = flat[np.arange(n.sum()) + np.repeat(first[words] - (np.cumsum(n) - n), n)]
                edges = np.cumsum([0, *(int(count[s].sum()) for s in spans)])
                out["ids"] = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(values, pa.int32()))
            if "ids_sha256" in columns:
                out["ids_sha256"] = pa.array([hashlib.sha256(",".join([written[w] for w in s]).encode()).hexdigest() for s in spans])
            if "decoded" in columns or "decoded_sha256" in columns:
                texts = [b"".join([decoded[w] for w in s]) for s in spans]
                if "decoded" in columns:
                    out["decoded"] = pa.array(texts, pa.binary())
                if "decoded_sha256" in columns:
                    out["decoded_sha256"] = pa.array([hashlib.sha256(t).hexdigest() for t in texts])
            yield table(**{c: out[c] for c in columns})

    for batch in batches:
        for i, (number, bucket) in enumerate(zip(batch.column("block").to_pylist(), batch.column("bucket").to_pylist())):
            if bucket == ORDER:
                if order is not None:
                    yield from flush()
                block, held = number, []
                order = (batch.column("ids")[i].as_py(), batch.column("sizes")[i].as_py(), batch.column("body")[i].as_py())
            else:
                if number != block:
                    raise RuntimeError("words without their block")
                counts, numbers = np.split(_unpacked(batch.column("lengths")[i].as_py()), 2)
                held.append((numbers, counts, _unpacked(batch.column("body")[i].as_py())))
    if order is not None:
        yield from flush()


KINDS = {"doc_id": "long", "n_tokens": "long", "ids": "array<int>", "ids_sha256": "string", "decoded": "binary", "decoded_sha256": "string"}


def encoded(docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text: str = "text", columns: tuple[str, ...] = ("doc_id", "n_tokens", "ids", "decoded")) -> DataFrame:
    """One row per row of ``docs`` with the chosen ``columns``: doc_id, n_tokens, ids, ids_sha256, decoded (bytes), decoded_sha256.

    ``path`` names a rank file, ``pattern`` cuts texts into words, which are encoded apart; no special tokens. A null text
    counts as empty; ids may be null or repeat, since rows are carried by their place in a block.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = share_vocabulary(spark, path, pattern)
    rows = docs.selectExpr(f"CAST(`{id_column}` AS long) AS doc_id", f"`{text}` AS text")
    unlike = unlike_characters()
    cut = map_arrow(rows, lambda it: _cut(it, pattern, unlike), ROW)
    lists = map_arrow(cut.repartition("key"), lambda it: _encode_lists(it, shared), ROW)
    blocks = lists.repartition("block").sortWithinPartitions("block", "bucket")
    names = list(columns)
    out = map_arrow(blocks, lambda it: _assemble(it, shared, names), ", ".join(f"{c} {KINDS[c]}" for c in names))
    return out.withColumnRenamed("doc_id", id_column)


def decoded(encodings: DataFrame, path: str, pattern: str, id_column: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(id, decoded) of lists of ids; null lists give null, an unknown id fails."""
    shared = share_vocabulary(encodings.sparkSession, path, pattern)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _vocabulary(shared).token_bytes
        for batch in batches:
            texts = [None if row is None else b"".join([tokens[i] for i in row]) for row in batch.column("ids").to_pylist()]
            yield table(doc_id=batch.column("doc_id"), decoded=pa.array(texts, pa.binary()))

    rows = encodings.selectExpr(f"CAST(`{id_column}` AS long) AS doc_id", f"`{ids}` AS ids")
    return map_arrow(rows, work, "doc_id long, decoded binary").withColumnRenamed("doc_id", id_column)
