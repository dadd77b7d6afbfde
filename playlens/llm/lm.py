"""Language-model scoring (operator 13): an interpolated modified Kneser-Ney bigram model of words, counted in Spark.

Nothing is pruned, and nothing that grows with the corpus is broadcast or passes through the driver; the driver sees totals only.
Texts are read once. Each task cuts its texts into *blocks* of about ``BLOCK_TOKENS`` tokens and writes them as numbers of the block's
own dictionary (columns of bytes, compressed). From then on blocks ask, and get back what they asked for:

1. Words: a block sends its words to *word shards*, which add them up and give the words of training texts ids, frequent ones small ids.
2. Pairs: a block asks each *shard* for the distinct pairs of neighbours it holds, and says how often they occur in its training
   texts. The shard adds up the counts of all blocks into one array of sorted pair hashes and one of counts, which the
   worker writes to a file and memory-maps; every block's pairs are looked up there by binary search. A pair is dealt out by its
   first word, and a frequent first word by both, so that no word fills a shard.
3. Contexts and continuations: sums per word (distinct neighbours, followers seen once, twice, more often) go from the shards
   to the word shards, are added up there, and come back to the blocks that hold the word.

What is sent is packed, some rows per block and shard, not rows of words or pairs. ``BLOCK_TOKENS`` and ``SHARD_PAIRS`` bound what a
task holds; for corpora of many thousand shards both should be raised together, so that packets stay large.

Discounts are those of the modified Kneser-Ney method, estimated from counts of counts: of pair counts for bigrams, of distinct left
neighbours for words. Below the words all V known ones and one unknown word are alike. Scores are base-10 logarithms.
"""

from __future__ import annotations

import contextlib
import itertools
import math
import operator
import struct
import tempfile
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.llm.rolling import U64, mix
from playlens.llm.stages import map_arrow, small_batches, table, write_stage

BLOCK_TOKENS = 1 << 20
SLICE_BYTES = 1 << 22  # of a text that are cut into words at once
SHARD_PAIRS = 1_500_000  # tokens per shard; each has one pair, and equal pairs of a block are one
BUCKET_BITS = 20  # of a word's hash; ranges of buckets are the word shards
MODULUS, HELD_OUT = 7, 2
START, END = b"\t", b"\n"  # no word holds white space

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_BLANK = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")
_CODEC = pa.Codec("zstd", compression_level=1)
_HEAD = struct.Struct("<2sqq")


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers as narrow columns of bytes, compressed."""
    out = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        if a.dtype.itemsize > 1 and (not len(a) or a.min() >= 0):
            a = a.astype(np.min_scalar_type(int(a.max(initial=0))))
        body = _CODEC.compress(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes(), asbytes=True) if len(a) else b""
        out += [_HEAD.pack(a.dtype.str[1:].encode(), len(a), len(body)), body]
    return b"".join(out)


def unpack(data: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(data):
        kind, n, size = _HEAD.unpack_from(data, at)
        at += _HEAD.size
        dtype = np.dtype("<" + kind.decode())
        if n:
            planes = np.frombuffer(_CODEC.decompress(data[at: at + size], n * dtype.itemsize, asbytes=True), np.uint8)
            out.append(np.ascontiguousarray(planes.reshape(dtype.itemsize, n).T).view(dtype).ravel())
        else:
            out.append(np.empty(0, dtype))
        at += size
    return out


class Numbers(dict):
    """Numbers words in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def slices(text: bytes, size: int) -> Iterator[list[bytes]]:
    """The words of a text, of about ``size`` bytes at a time; at least one list."""
    text = text.translate(_LOWER)
    if len(text) <= size:
        yield text.split()
        return
    text, at = text.translate(_BLANK), 0
    while at < len(text):
        end = text.find(b" ", at + size)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


class Block:
    """Texts, or parts of a long one, as numbers of one dictionary. Each part begins with the token before it."""

    def __init__(self):
        self.numbers, self.tokens, self.n = Numbers(), [], 0
        self.rid, self.doc, self.known, self.held, self.size, self.opens = [], [], [], [], [], []

    def add(self, rid: int, doc: int | None, held: bool, before: bytes, words: list[bytes]) -> None:
        ids = [self.numbers[before], *map(self.numbers.__getitem__, words)]
        self.tokens.append(np.array(ids, np.uint32))
        self.n += len(words)
        for column, value in zip((self.rid, self.doc, self.known, self.held, self.size, self.opens), (rid, doc or 0, doc is not None, held, len(ids), before == START)):
            column.append(value)

    def row(self, block: int) -> pa.RecordBatch:
        """The texts as numbers, the dictionary, and the words' buckets and numbers of training tokens."""
        flat, size = np.concatenate(self.tokens), np.array(self.size)
        start = np.cumsum(size) - size
        counted = np.repeat(~np.array(self.held, bool), size)
        counted[start] &= np.array(self.opens, bool)  # what stands before a part is no token of it, but a start stands for its text
        counts = np.bincount(flat[counted], minlength=len(self.numbers))
        data = pack(np.array(self.rid, np.int64), np.array(self.doc, np.int64), np.array(self.known, np.uint8), np.array(self.held, np.uint8), size, flat)
        buckets = np.array([xxhash.xxh3_64_intdigest(w) >> (64 - BUCKET_BITS) for w in self.numbers])
        return table(block=[block], n=[self.n], data=[data], buckets=[pack(buckets)], words=[join_words(list(self.numbers))], counts=[pack(counts)])


def join_words(words: list[bytes]) -> bytes:
    text = b" ".join(words)
    return struct.pack("<q", len(text)) + _CODEC.compress(text, asbytes=True)


def split_words(data: bytes) -> list[bytes]:
    return _CODEC.decompress(data[8:], struct.unpack_from("<q", data)[0], asbytes=True).split(b" ")


def held_out(doc: int | None) -> bool:
    return zlib.crc32(b"" if doc is None else b"%d" % doc) % MODULUS == HELD_OUT


def blocks(docs: DataFrame) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rid, block, number = TaskContext.get().partitionId(), 0, Block(), 0
        for batch in batches:
            for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text")):
                before, held = START, held_out(doc)
                pieces = slices(text.as_buffer().to_pybytes() if text.is_valid else b"", SLICE_BYTES)
                words = next(pieces)
                while words is not None:
                    after = next(pieces, None)
                    if after is None:
                        words.append(END)
                    if words:
                        block.add(part << 40 | rid, doc, held, before, words)
                        before = words[-1]
                    words = after
                    if block.n >= BLOCK_TOKENS:
                        yield block.row(part << 32 | number)
                        block, number = Block(), number + 1
                rid += 1
        if block.n:
            yield block.row(part << 32 | number)

    return write_stage(map_arrow(docs, work, "block long, n long, data binary, buckets binary, words binary, counts binary"), "lm-blocks")


# What blocks and shards send each other. Rows of a block are read by kind, the payload last, and by place (the shard).
PAYLOAD, PAIRS, SUMS, WORDS, STATS, TOTALS = range(6)
SENT = "kind int, block long, place long, data binary, a long, b long"


def sent(kind: int, block: int, place: int, data: bytes | None = None, a: int = 0, b: int = 0) -> pa.RecordBatch:
    return table(kind=pa.array([kind], pa.int32()), block=[block], place=[place], data=pa.array([data], pa.binary()), a=[a], b=[b])


def grouped(batches: Iterator[pa.RecordBatch], key: str, *columns: str) -> Iterator[tuple[int, Iterator[tuple]]]:
    """Rows with one key after the other; the rows of a key must be read before the next key."""
    rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in (key, *columns))))
    for value, some in itertools.groupby(rows, operator.itemgetter(0)):
        yield value, (row[1:] for row in some)


def totals(rows: DataFrame) -> dict[int, int]:
    return dict(rows.filter(F.col("kind") == TOTALS).groupBy("a").agg(F.sum("b")).collect())


def shard_slices(of: np.ndarray) -> Iterator[np.ndarray]:
    """Places of each shard's members, shard by shard."""
    order = np.argsort(of, kind="stable")
    yield from np.split(order, np.flatnonzero(np.diff(of[order])) + 1) if len(of) else ()


def word_shard(buckets: np.ndarray, shards: int) -> np.ndarray:
    return buckets.astype(np.int64) * shards >> BUCKET_BITS


def word_ids(parts: DataFrame, shards: int) -> DataFrame:
    """For each block and word shard: ids of the block's words there, and their numbers of training tokens; both 0 where there are none.

    The ids of a shard are dealt out by number of tokens, so frequent words have small ids. TOTALS: tokens (0), words (1).
    """

    def asks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, buckets, words, counts in zip(*(batch.column(c).to_pylist() for c in ("block", "buckets", "words", "counts"))):
                of, words, counts = word_shard(unpack(buckets)[0], shards), split_words(words), unpack(counts)[0]
                for at in shard_slices(of):
                    yield table(place=[int(of[at[0]])], block=[block], words=[join_words([words[i] for i in at.tolist()])], counts=[pack(counts[at])])

    def answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for place, rows in grouped(batches, "place", "block", "words", "counts"):
            numbers, asked, some = Numbers(), [], []
            for block, words, counts in rows:
                asked.append((block, np.array([numbers[w] for w in split_words(words)], np.uint32)))
                some.append(unpack(counts)[0].astype(np.int64))
            total = np.zeros(len(numbers), np.int64)
            for (_, at), n in zip(asked, some):
                total[at] += n  # a block names each word once
            order = np.argsort(-total, kind="stable")
            ids = np.empty(len(total), np.int64)
            ids[order] = np.arange(len(total)) * shards + place + 1
            ids[total == 0] = 0
            for block, at in asked:
                yield sent(WORDS, block, place, pack(ids[at], total[at]))
            start = total[numbers[START]] if START in numbers else 0
            yield sent(TOTALS, 0, 0, a=0, b=int(total.sum() - start))
            yield sent(TOTALS, 0, 0, a=1, b=int((total > 0).sum() - (start > 0)))

    asked = map_arrow(parts.select("block", "buckets", "words", "counts"), asks, "place long, block long, words binary, counts binary")
    return write_stage(map_arrow(asked.repartition("place").sortWithinPartitions("place", "block"), answers, SENT), "lm-words")


def assembled(parts: DataFrame, *others: DataFrame) -> DataFrame:
    """The payloads, each after what was sent to its block."""
    rows = parts.select(F.lit(PAYLOAD).alias("kind"), "block", F.lit(0).cast("long").alias("place"), "data", "buckets")
    for other in others:
        rows = rows.unionByName(other.select("kind", "block", "place", "data"), allowMissingColumns=True)
    return rows.repartition("block").sortWithinPartitions("block", F.desc("kind"), "place")


def assembled_blocks(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[tuple[int, dict[int, list[np.ndarray]], bytes]]:
    """(block, what was sent by kind, payload). What was sent about words comes in the order of the block's own numbers."""
    for block, rows in grouped(batches, "block", "kind", "data", "buckets"):
        got: dict[int, list] = {}
        for kind, data, buckets in rows:
            if kind != PAYLOAD:
                got.setdefault(kind, []).append(unpack(data))
                continue
            own = np.argsort(word_shard(unpack(buckets)[0], shards), kind="stable")
            columns = {k: [np.concatenate(c) for c in zip(*v)] for k, v in got.items()}
            for k in (WORDS, SUMS):
                for i, column in enumerate(columns.get(k, ())):
                    columns[k][i] = np.empty(len(own), np.int64)
                    columns[k][i][own] = column
            yield block, columns, data


class Asked:
    """The distinct pairs of a block's known neighbours, in the order in which shards are asked for them."""

    def __init__(self, ids: np.ndarray, c: np.ndarray, payload: bytes, shards: int, tokens: int):
        self.rid, self.doc, self.known, self.held, self.size, flat = unpack(payload)
        flat, size = flat.astype(np.int64), self.size.astype(np.int64)
        self.part = np.repeat(np.arange(len(size)), size - 1)
        first = np.zeros(len(flat), bool)
        first[np.cumsum(size) - size] = True
        here = np.flatnonzero(~first)
        pairs, self.inverse = np.unique(flat[here - 1] * len(ids) + flat[here], return_inverse=True)
        self.v, self.w = pairs // len(ids), pairs % len(ids)  # the block's numbers
        self.n = np.bincount(self.inverse, 1 - self.held.astype(np.int64)[self.part], len(pairs)).astype(np.int64)
        v, w = ids[self.v], ids[self.w]
        known = np.flatnonzero((v > 0) & (w > 0))
        shard = shard_of(v[known], w[known], c[self.v[known]], shards, tokens)
        by = np.lexsort((w[known], v[known], shard))
        self.order, self.shard = known[by], shard[by]
        self.v_id, self.w_id = v[self.order], w[self.order]

    def by_shard(self) -> Iterator[tuple[int, bytes]]:
        for part in shard_slices(self.shard):
            v = self.v_id[part]
            yield int(self.shard[part[0]]), pack(np.diff(v, prepend=0), self.w_id[part], self.n[self.order[part]])


def shard_of(v: np.ndarray, w: np.ndarray, c: np.ndarray, shards: int, tokens: int) -> np.ndarray:
    """By the first word; one with more than a quarter of a shard's tokens is spread by the second word over several shards."""
    spread = (1 + 4 * c * shards // max(tokens, 1)).astype(U64)
    return (mix(v.astype(U64) + mix(mix(w.astype(U64)) % spread)) % U64(shards)).astype(np.int64)


def pair_hash(v: np.ndarray, w: np.ndarray, seed: int) -> np.ndarray:
    return mix(mix(v.astype(U64) + U64(seed)) + w.astype(U64))


class PairCounts:
    """Counts of pairs: a file of sorted hashes and their counts, mapped into memory and searched in halves."""

    def __init__(self, v: np.ndarray, w: np.ndarray, n: np.ndarray):
        for self.seed in range(64):
            keys = pair_hash(v, w, self.seed)
            order = np.argsort(keys, kind="stable")
            first = np.ones(len(order), bool)
            first[1:] = keys[order][1:] != keys[order][:-1]
            self.v, self.w = v[order][first], w[order][first]
            of = np.cumsum(first) - 1
            if (self.v[of] == v[order]).all() and (self.w[of] == w[order]).all():
                break  # else two pairs share a hash: take another one
        self.n = np.add.reduceat(n[order], np.flatnonzero(first)) if len(n) else n
        seen = self.n > 0
        self.v, self.w, self.n = self.v[seen], self.w[seen], self.n[seen]
        self.file = tempfile.TemporaryFile()
        keys[order][first][seen].tofile(self.file)
        self.n.astype(np.int64).tofile(self.file)
        self.file.flush()
        size = int(seen.sum())
        self.keys, self.counts = (np.memmap(self.file, t, "r", 8 * at, (size,)) for t, at in ((U64, 0), (np.int64, size))) if size else (np.empty(0, U64), np.empty(0, np.int64))

    def of(self, v: np.ndarray, w: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(v), np.int64)
        keys = pair_hash(v, w, self.seed)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.counts[at], 0)  # asked pairs are all among those that were hashed

    def close(self) -> None:
        self.keys = self.counts = None
        self.file.close()


def pair_counts(asks: DataFrame, shards: int) -> DataFrame:
    """For each block and pair shard the counts of the asked pairs; for word shards, STATS: ids with their numbers of distinct
    left neighbours and of followers seen once, twice, more often. TOTALS: pairs seen 1 to 4 times."""

    def answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for place, rows in grouped(batches, "place", "block", "data"):
            asked = [(block, *(a.astype(np.int64) for a in unpack(data))) for block, data in rows]
            pairs = [(np.cumsum(steps), w, n) for _, steps, w, n in asked]
            counts = PairCounts(*map(np.concatenate, zip(*pairs)))
            for (block, *_), (v, w, _) in zip(asked, pairs):
                yield sent(PAIRS, block, place, pack(counts.of(v, w)))
            ids = np.unique(np.concatenate([counts.v, counts.w]))
            classes = np.minimum(counts.n, 3)
            sums = [np.bincount(np.searchsorted(ids, some), minlength=len(ids)) for some in (counts.w, *(counts.v[classes == k] for k in (1, 2, 3)))]
            of = (ids - 1) % shards
            for at in shard_slices(of):
                yield sent(STATS, place, int(of[at[0]]), pack(np.diff(ids[at], prepend=0), *(s[at] for s in sums)))
            for k in (1, 2, 3, 4):
                yield sent(TOTALS, 0, 0, a=k, b=int((counts.n == k).sum()))
            counts.close()

    return write_stage(map_arrow(asks.repartition("place").sortWithinPartitions("place", "block"), answers, SENT), "lm-pairs")


def word_sums(words: DataFrame, pairs: DataFrame, shards: int) -> DataFrame:
    """For each block and word shard the sums of STATS of the block's words. TOTALS: words of 1 to 4 left neighbours, of 3 or more (5), all neighbours (6)."""

    def answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for place, rows in grouped(batches, "place", "kind", "block", "data"):
            some, sums = [], None
            for kind, block, data in rows:
                columns = unpack(data)
                if kind == STATS:  # these come first
                    some.append([(np.cumsum(columns[0].astype(np.int64)) - 1) // shards, *columns[1:]])
                    continue
                if sums is None:
                    sums = np.zeros((1 + max((int(s[0][-1]) + 1 for s in some), default=0), 4), np.int64)  # a row of zeros at the end
                    for at, *values in some:
                        sums[at] += np.stack(values, axis=1).astype(np.int64)
                    some = []
                ids = columns[0].astype(np.int64)
                got = sums[np.where(ids > 0, (ids - 1) // shards, len(sums) - 1)]
                yield sent(SUMS, block, place, pack(*got.T))
            left = sums[:, 0]
            for k in (1, 2, 3, 4):
                yield sent(TOTALS, 0, 0, a=k, b=int((left == k).sum()))
            yield sent(TOTALS, 0, 0, a=5, b=int((left > 2).sum()))
            yield sent(TOTALS, 0, 0, a=6, b=int(left.sum()))

    rows = words.filter(F.col("kind") == WORDS).unionByName(pairs.filter(F.col("kind") == STATS)).select("kind", "block", "place", "data")
    return write_stage(map_arrow(rows.repartition("place").sortWithinPartitions("place", F.desc("kind"), "block"), answers, SENT), "lm-sums")


def discounts(n: list[int]) -> np.ndarray:
    """What is taken off counts 0, 1, 2 and 3+, by the numbers of counts 1 to 4; never a whole count."""
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
    steps = [i - (i + 1) * y * n[i] / n[i - 1] if n[i - 1] else i / 2 for i in (1, 2, 3)]
    return np.array([0.0, *(min(max(d, 0.01 * i), 0.99 * i) for i, d in zip((1, 2, 3), steps))])


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """While stages are written, Spark deletes a query's shuffle files when it ends; the caller's setting comes back after."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def scored(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: the id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity.

    Training texts are those whose CRC-32 of the decimal id, modulo 7, is not 2; a null id counts as an empty text there, so such
    rows train. A null text is empty and has one token, its end. Repeated rows are texts of their own. Other columns play no part.
    Words in no training text are one unknown word. Without any training text all chances are one. Empty tables give no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc"), F.col(f"`{text}`").cast("string").alias("text"))
    with shuffles_dropped(spark):
        parts = blocks(rows)
        tokens = parts.agg(F.sum("n")).first()[0] or 0
        shards = max(1, min(math.ceil(tokens / SHARD_PAIRS), 1 << BUCKET_BITS))
        words = word_ids(parts, shards)

        def asks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block, got, data in assembled_blocks(batches, shards):
                for place, packed in Asked(*got[WORDS], data, shards, tokens).by_shard():
                    yield table(place=[place], block=[block], data=[packed])

        of = lambda rows, kind: rows.filter(F.col("kind") == kind)
        pairs = pair_counts(map_arrow(assembled(parts, of(words, WORDS)), asks, "place long, block long, data binary"), shards)
        sums = word_sums(words, pairs, shards)
        in_words, in_pairs, in_sums = totals(words), totals(pairs), totals(sums)

    total, size, distinct = in_words.get(0, 0), in_words.get(1, 0), in_sums.get(6, 0)
    off, off_left = (discounts([t.get(k, 0) for k in (1, 2, 3, 4)]) for t in (in_pairs, in_sums))
    rest = sum(off_left[i] * in_sums[k] for i, k in ((1, 1), (2, 2), (3, 5))) / distinct if distinct else 1.0
    uniform = float(rest) / (size + 1)

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, got, data in assembled_blocks(batches, shards):
            ids, c = got[WORDS]
            near, n1, n2, n3 = got[SUMS]
            asked = Asked(ids, c, data, shards, tokens)
            pair = np.zeros(len(asked.v), np.int64)
            if PAIRS in got:
                pair[asked.order] = got[PAIRS][0]
            below = uniform + np.maximum(near - off_left[np.minimum(near, 3)], 0) / max(distinct, 1)
            weight = np.where(c > 0, (off[1] * n1 + off[2] * n2 + off[3] * n3) / np.maximum(c, 1), 1.0)
            seen = (pair - off[np.minimum(pair, 3)]) / np.maximum(c[asked.v], 1)
            logs = np.log10(seen + weight[asked.v] * below[asked.w])
            base = np.log10((c + 1) / (total + size + 1))[asked.w]
            add = lambda per_pair: np.bincount(asked.part, per_pair[asked.inverse], len(asked.rid))
            yield table(
                rid=asked.rid.astype(np.int64), doc=pa.array(asked.doc.astype(np.int64), mask=asked.known == 0), held_out=asked.held.astype(bool),
                n_tokens=(asked.size.astype(np.int64) - 1), n_known=add((c > 0)[asked.w].astype(np.float64)).astype(np.int64), base_score=add(base), score=add(logs))

    schema = "rid long, doc long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    got = map_arrow(assembled(parts, of(words, WORDS), of(sums, SUMS), of(pairs, PAIRS)), scores, schema)
    whole = got.groupBy("rid").agg(  # a long text has several parts
        F.max("doc").alias(id_column), F.first("held_out").alias("held_out"), F.sum("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"),
        F.sum("base_score").alias("base_score"), F.sum("score").alias("score"))
    return whole.select(
        id_column, "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))
