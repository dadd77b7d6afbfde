"""MinHash near-dedup (operator 7): documents whose shingle sets have a similarity of the threshold or more are linked.

* Documents with equal sets fall into one class first; only its smallest document goes on, so copies never form pairs.
* ``BANDS * ROWS`` minima of permuted hashes give the band keys.
* For the estimate the hash range is cut into ``BINS``; of each bin's minimum ``BITS`` low bits are kept (0 for an empty bin),
  packed in longs. Equal fields are counted by bit operations and corrected for the chance that two fields agree by accident.
* Round 1 links each class to the most central class of its bands (the one that shares most bands with others), best
  estimate first. Round 2 takes up whatever shares a band and is still in different components, by one rule for all sizes: a
  class whose estimate with a member of a larger component reaches the lower margin is held against all members of that component.
  So no pair of a band is lost, and a group of n near copies costs n links instead of n² pairs. Estimates of a band
  are made in blocks of packed bits, of which only (class, component) comes out; members of the component that has most of a
  band are not held against each other.
* All links are confirmed on full sets.

With 32 bands of 5 rows a pair at 0.8 meets in no band once in 300,000; the margin is four standard errors of long texts wide,
and more for short ones, whose sets the bins hold nearly whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from playlens.llm import rolling
from playlens.llm.rolling import U64, mix
from playlens.llm.stages import NO_ID, array_column, keyed, likely_in, map_arrow, table, without, write_stage

BANDS, ROWS = 32, 5
BINS, BITS = 512, 4
MARGIN = 0.08  # below the threshold an estimate may lie
SHARE = 256  # members of a group whose texts meet in one task
BLOCK = 256  # members of a band whose bits meet in one task
PAIRS = 1 << 14  # estimates made at once
SHINGLE, THRESHOLD = 5, 80  # words, per cent

_HASHES = BANDS * ROWS
_FACTORS = mix(np.arange(1, _HASHES + 1, dtype=U64)) | U64(1)
_TERMS = mix(np.arange(_HASHES + 1, 2 * _HASHES + 1, dtype=U64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
FIELDS = 64 // BITS  # of a long
LONGS = BINS // FIELDS + BINS // 64  # the fields, and one bit for each filled bin
SIGNED = "doc_key long, rid long, n long, set_a long, set_b long, bits array<long>, bands array<long>"


def shingles(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row and the offsets of the rows. A text with fewer words is one shingle."""
    flat, offsets = rolling.text_bytes(column)
    words, rows = rolling.word_symbols(_LOWER[flat], offsets)
    count = np.diff(rows)
    values = words * U64(1)
    hashed = np.zeros(len(words), U64)
    row_of = np.repeat(np.arange(len(count)), count)
    left = rows[1:][row_of] - np.arange(len(words))  # words from here to the row's end
    for i in range(size):
        there = left > i
        hashed[there] = mix(hashed[there] * U64(rolling.BASE) + values[np.flatnonzero(there) + i] + U64(i + 1))
    short = count[row_of] < size
    starts = np.where(short, np.arange(len(words)) == rows[:-1][row_of], left >= size)
    row_of, hashed = row_of[starts], hashed[starts]
    order = np.lexsort((hashed, row_of))
    row_of, hashed = row_of[order], hashed[order]
    new = np.ones(len(hashed), bool)
    new[1:] = (row_of[1:] != row_of[:-1]) | (hashed[1:] != hashed[:-1])
    return hashed[new], np.searchsorted(row_of[new], np.arange(len(count) + 1))


def _in_parts(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges with texts of some megabytes together."""
    _, offsets = rolling.text_bytes(column)
    return rolling.groups_of_rows(np.diff(offsets), rolling.CHUNK)


def signatures(rows: DataFrame, size: int = SHINGLE) -> DataFrame:
    """Set sizes, set hashes (128 bits), packed low bits of the minima and band keys of keyed documents."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in _in_parts(batch.column("text")):
                part = batch.slice(a, b - a)
                sets, offsets = shingles(part.column("text"), size)
                n = np.diff(offsets)
                full = np.flatnonzero(n)
                begin = offsets[:-1][full]
                minima = np.zeros((len(n), _HASHES), U64)
                sums = np.zeros((2, len(n)), U64)
                if len(full):
                    sums[0][full] = np.add.reduceat(mix(sets), begin)
                    sums[1][full] = np.add.reduceat(mix(sets ^ U64(rolling.BASE)), begin)
                    for i in range(_HASHES):
                        minima[full, i] = np.minimum.reduceat((sets * _FACTORS[i] + _TERMS[i]) >> U64(32), begin)
                bands = np.zeros((len(n), BANDS), U64)
                for r in range(ROWS):
                    bands = mix(bands * U64(rolling.BASE) + minima[:, r::ROWS] + np.arange(BANDS, dtype=U64))
                # sets are sorted, so the first hash of a bin is its minimum
                row_bin = np.repeat(np.arange(len(n)), n) * BINS + (sets >> U64(64 - BINS.bit_length() + 1)).astype(np.int64)
                low = np.flatnonzero(np.append(True, row_bin[1:] != row_bin[:-1])) if len(sets) else np.empty(0, np.int64)
                field = mix(sets[low]) % U64((1 << BITS) - 1) + U64(1)
                bits = np.zeros(len(n) * BINS // FIELDS, U64)
                np.add.at(bits, row_bin[low] // FIELDS, field << (row_bin[low] % FIELDS * BITS).astype(U64))
                filled = np.zeros(len(n) * BINS // 64, U64)
                np.add.at(filled, row_bin[low] // 64, U64(1) << (row_bin[low] % 64).astype(U64))
                bits = np.concatenate([bits.reshape(len(n), -1), filled.reshape(len(n), -1)], axis=1)
                yield table(
                    doc_key=array_column(part, "doc_key"), rid=array_column(part, "rid"), n=n, set_a=sums[0].view(np.int64), set_b=sums[1].view(np.int64),
                    bits=_lists(bits), bands=_lists(bands))

    return map_arrow(rows, work, SIGNED)


def _lists(matrix: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(matrix) + 1) * matrix.shape[1], pa.int32()), pa.array(np.ascontiguousarray(matrix).view(np.int64).ravel()))


def bit_columns(df: DataFrame, side: str, *others: Column | str) -> DataFrame:
    """``df`` with its packed bits as columns of longs, named after ``side``."""
    return df.select(*others, *(F.col("bits")[i].alias(f"{side}{i}") for i in range(LONGS)))


def estimate(a: str, b: str) -> Column:
    """Similarity of two sides' bit columns: fields that agree in bins that either fills, corrected for accidental agreement."""
    fields, masks = range(BINS // FIELDS), range(BINS // FIELDS, LONGS)
    lowest = "1229782938247303441L"  # the lowest bit of each field
    xor = [f"({a}{i} ^ {b}{i})" for i in fields]
    differs = " + ".join(f"bit_count(({x} | shiftrightunsigned({x}, 1) | shiftrightunsigned({x}, 2) | shiftrightunsigned({x}, 3)) & {lowest})" for x in xor)
    both = " + ".join(f"bit_count({a}{i} & {b}{i})" for i in masks)
    either = " + ".join(f"bit_count({a}{i} | {b}{i})" for i in masks)
    chance = 1 / ((1 << BITS) - 1)
    # fields of bins that both leave empty are equal too
    return F.expr(f"((({either}) - ({differs})) - ({both}) * {chance}D) / ({1 - chance}D * ({either}))")


def _node() -> Column:
    return F.struct("doc_key", "rid")


def meet(rows: DataFrame, roles: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (a, b) of nodes whose full sets have ``percent`` similarity or more.

    ``roles`` (node, pivot, part, role): in each (pivot, part), nodes of role 1 are held against all nodes of role 0, which
    are few; a node gets its first link there. Each text is read once and sent where it is asked for.
    """
    wanted = roles.groupBy("node").agg(F.collect_list(F.struct(F.col("pivot.doc_key").alias("key"), F.col("pivot.rid").alias("rid"), "part", "role")).alias("roles"))
    wanted = wanted.select("node.doc_key", "node.rid", "roles")
    texts = likely_in(rows, wanted).join(wanted, ["doc_key", "rid"])
    # rows equal in id and text are one document: one of them will do
    dealt = texts.dropDuplicates(["doc_key", "rid"]).select("doc_key", "rid", "text", F.inline("roles")).toDF("doc_key", "rid", "text", "key", "pivot_rid", "part", "role")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, _Held()
        for batch in batches:
            out: list[tuple] = []
            for a, b in _in_parts(batch.column("text")):
                part = batch.slice(a, b - a)
                sets, offsets = shingles(part.column("text"), size)
                columns = [part.column(c).to_pylist() for c in ("doc_key", "rid", "key", "pivot_rid", "part", "role")]
                for i, (doc, rid, key, pivot_rid, no, role) in enumerate(zip(*columns)):
                    if group != (key, pivot_rid, no):
                        group, held = (key, pivot_rid, no), _Held()
                    mine = sets[offsets[i]: offsets[i + 1]]
                    if role == 0:
                        held.add((doc, rid), mine)
                    else:
                        first = held.similar(mine, percent)
                        if first is not None:
                            out.append((doc, rid, *first))
            if out:
                a, b, c, d = (pa.array(x, pa.int64()) for x in zip(*out))
                yield table(a_key=a, a_rid=b, b_key=c, b_rid=d)

    met = map_arrow(
        dealt.repartition("key", "pivot_rid", "part").sortWithinPartitions("key", "pivot_rid", "part", "role"), compare, "a_key long, a_rid long, b_key long, b_rid long")
    return met.select(F.struct(F.col("a_key").alias("doc_key"), F.col("a_rid").alias("rid")).alias("a"), F.struct(F.col("b_key").alias("doc_key"), F.col("b_rid").alias("rid")).alias("b"))


class _Held:
    """Sets that others are held against, as one sorted array of hashes with their owners."""

    def __init__(self):
        self.nodes: list[tuple] = []
        self.sets: list[np.ndarray] = []
        self.index: tuple | None = None

    def add(self, node: tuple, members: np.ndarray) -> None:
        self.nodes.append(node)
        self.sets.append(members)
        self.index = None

    def similar(self, members: np.ndarray, percent: int) -> tuple | None:
        """The first node whose set is similar enough."""
        if not self.nodes:
            return None
        if self.index is None:
            sizes = np.array(list(map(len, self.sets)))
            hashes, owner = np.concatenate(self.sets), np.repeat(np.arange(len(sizes)), sizes)
            order = np.argsort(hashes, kind="stable")
            self.index = hashes[order], owner[order], sizes
        hashes, owner, sizes = self.index
        low, high = np.searchsorted(hashes, members), np.searchsorted(hashes, members, "right")
        count = high - low
        at = np.arange(count.sum()) + np.repeat(low - (np.cumsum(count) - count), count)
        shared = np.bincount(owner[at], minlength=len(sizes))
        hits = np.flatnonzero(100 * shared >= percent * (sizes + len(members) - shared))
        return self.nodes[hits[0]] if len(hits) else None


def of_pairs(pairs: DataFrame) -> DataFrame:
    """Roles that hold each ``a`` of (a, b) against its ``b``; where b has many, they are dealt over groups that all hold it."""
    many = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / SHARE).cast("int").alias("groups"))
    asking = pairs.join(many, "b").select(
        F.col("a").alias("node"), F.col("b").alias("pivot"), F.pmod(F.xxhash64("a"), F.col("groups")).cast("int").alias("part"), F.lit(1).alias("role"))
    held = many.select(F.col("b").alias("node"), F.col("b").alias("pivot"), F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("part"), F.lit(0).alias("role"))
    return asking.unionByName(held)


def of_components(asks: DataFrame, members: DataFrame) -> DataFrame:
    """Roles that hold each ``node`` of (node, pivot) against all members (node, label) of component ``pivot``, both dealt over groups."""
    count = F.ceil(F.count(F.lit(1)) / SHARE)
    dealt = members.groupBy(F.col("label").alias("pivot")).agg(count.alias("cells")).join(asks.groupBy("pivot").agg(count.alias("parts")), "pivot")
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    held = members.select("node", F.col("label").alias("pivot")).join(dealt, "pivot").select("node", "pivot", "parts", own("cells").alias("cell"), each("parts").alias("part"), F.lit(0).alias("role"))
    asking = asks.join(dealt, "pivot").select("node", "pivot", "parts", each("cells").alias("cell"), own("parts").alias("part"), F.lit(1).alias("role"))
    return held.unionByName(asking).select("node", "pivot", (F.col("cell") * F.col("parts") + F.col("part")).alias("part"), "role")


def alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """`estimate` of rows of packed bits."""
    fields = BINS // FIELDS
    count = lambda x: np.bitwise_count(x).sum(axis=1, dtype=np.int64)
    x = a[:, :fields] ^ b[:, :fields]
    x |= x >> U64(1)
    x |= x >> U64(2)
    differs = count(x & U64(0x1111111111111111))
    both, either = count(a[:, fields:] & b[:, fields:]), count(a[:, fields:] | b[:, fields:])
    chance = 1 / ((1 << BITS) - 1)
    return (either - differs - both * chance) / ((1 - chance) * either)


HELD, ASKS, BOTH = range(3)  # roles of a class in a block
_BLOCKED = ("band", "cell", "part", "role", "major", "size", "label_key", "label_rid", "node_key", "node_rid")


def in_blocks(still: DataFrame) -> DataFrame:
    """Rows (band, node, label, size, bits) dealt out to blocks (band, cell, part) in which any two classes of a band meet, but
    two of its ``major`` component. A band of one block has each class once; else classes outside the major one ask in all cells."""
    by_label = still.groupBy("band", "label").agg(F.count(F.lit(1)).alias("n"))
    bands = by_label.groupBy("band").agg(F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("n"))
    bands = bands.select("band", F.col("top.label").alias("top"), F.ceil(F.col("n") / BLOCK).alias("cells"), F.ceil((F.col("n") - F.col("top.n")) / BLOCK).alias("parts"))
    rows = still.join(bands, "band").withColumn("major", F.col("label") == F.col("top"))
    one = (F.col("cells") == 1) & (F.col("parts") == 1)
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    own = lambda n, salt: F.pmod(F.xxhash64("node", F.lit(salt)), F.col(n))
    about = ["major", "size", "label", "node", "bits"]
    held = rows.select("band", own("cells", 0).alias("cell"), each("parts").alias("part"), F.when(one & ~F.col("major"), BOTH).otherwise(HELD).alias("role"), *about)
    asking = rows.filter(~F.col("major") & ~one).select("band", each("cells").alias("cell"), own("parts", 1).alias("part"), F.lit(ASKS).alias("role"), *about)
    flat = [F.col(f"{c}.{k}").alias(f"{c}_{short}") for c in ("label", "node") for k, short in (("doc_key", "key"), ("rid", "rid"))]
    return held.unionByName(asking).select("band", "cell", "part", "role", "major", "size", *flat, "bits")


def asking(still: DataFrame, floor: float) -> DataFrame:
    """(node, pivot): classes and the components, larger than their own, with a member of which a band and an estimate of ``floor`` are shared."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry: list[np.ndarray] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [array_column(batch, c) for c in _BLOCKED] + [batch.column("bits").flatten().to_numpy(zero_copy_only=False).view(U64).reshape(-1, LONGS)]
            if carry:
                rows = [np.concatenate(c) for c in zip(carry, rows)]
            edges = _edges(rows)
            yield from _asked(rows, edges, floor)
            carry = [c[edges[-1]:].copy() for c in rows]  # a block may go on
        if carry:
            yield from _asked(carry, [0, len(carry[0])], floor)

    blocks = in_blocks(still).repartition("band", "cell", "part").sortWithinPartitions("band", "cell", "part")
    found = map_arrow(blocks, work, "node_key long, node_rid long, label_key long, label_rid long").distinct()
    return found.select(*(F.struct(F.col(f"{c}_key").alias("doc_key"), F.col(f"{c}_rid").alias("rid")).alias(n) for c, n in (("node", "node"), ("label", "pivot"))))


def _edges(rows: list[np.ndarray]) -> list[int]:
    new = np.zeros(len(rows[0]), bool)
    for c in rows[:3]:
        new[1:] |= c[1:] != c[:-1]
    return [0, *np.flatnonzero(new).tolist()]


def _asked(rows: list[np.ndarray], edges: list[int], floor: float) -> Iterator[pa.RecordBatch]:
    """What asks whom in the blocks between ``edges``."""
    *_, role, major, size, label_key, label_rid, node_key, node_rid, bits = rows
    order = np.lexsort((label_rid, label_key, size))
    new = (label_key[order][1:] != label_key[order][:-1]) | (label_rid[order][1:] != label_rid[order][:-1])
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(np.append(0, new))  # equal for members of one component
    some: list[tuple[np.ndarray, np.ndarray]] = []
    waiting = 0

    def rated() -> Iterator[pa.RecordBatch]:
        a, b = (np.concatenate(c) for c in zip(*some))
        hits = [at + np.flatnonzero(alike(bits[a[at: at + PAIRS]], bits[b[at: at + PAIRS]]) >= floor) for at in range(0, len(a), PAIRS)]
        a, b = (c[np.concatenate(hits)] for c in (a, b))
        swap = rank[a] > rank[b]
        a, b = np.where(swap, b, a), np.where(swap, a, b)
        first = np.unique(a * len(rank) + rank[b], return_index=True)[1]  # a class asks a component once, however many of its members look alike
        a, b = a[first], b[first]
        if len(a):
            yield table(node_key=node_key[a], node_rid=node_rid[a], label_key=label_key[b], label_rid=label_rid[b])

    for low, high in zip(edges, edges[1:]):
        held = low + np.flatnonzero(role[low:high] != ASKS)
        asks = low + np.flatnonzero(role[low:high] != HELD)
        for a in np.array_split(asks, max(1, len(asks) * len(held) >> 18)):
            meets = (rank[a][:, None] != rank[held]) & (major[held] | (rank[a][:, None] < rank[held]))
            i, j = np.nonzero(meets)
            some.append((a[i], held[j]))
            waiting += len(i)
            if waiting >= PAIRS:
                yield from rated()
                some, waiting = [], 0
    if waiting:
        yield from rated()


def components(links: DataFrame, name: str) -> DataFrame:
    """(node, label): the smallest node each linked node can reach; labels spread to neighbours and jump to their own label's."""
    both = write_stage(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).filter(F.col("a") != F.col("b")).distinct(), f"{name}-links")
    labels = write_stage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("label")), f"{name}-labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        spread = write_stage(labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label")), f"{name}-spread")
        up = spread.select(F.col("node").alias("label"), F.col("label").alias("up"))
        new = write_stage(spread.join(up, "label", "left").select("node", "old", F.coalesce("up", "label").alias("label")), f"{name}-labels")
        labels = new.select("node", "label")
        if not new.filter(F.col("old") != F.col("label")).limit(1).count():
            return labels


LAST = (1 << 63) - 1  # stands for a null id here, larger than all others


def linked(rows: DataFrame, size: int, percent: int) -> DataFrame:
    """(doc_key, rid, n, top) of keyed documents; ``top`` is the smallest node reachable, a null id being the largest."""
    rows = rows.withColumn("doc_key", F.when(F.col("doc_key") == NO_ID, F.lit(LAST)).otherwise(F.col("doc_key")))
    signed = write_stage(signatures(rows, size), "near-signed")
    same = ["n", "set_a", "set_b"]
    firsts = write_stage(signed.filter("n > 0").groupBy(*same).agg(F.min(F.struct("doc_key", "rid", "bits", "bands")).alias("first")).select(
        *same, F.struct("first.doc_key", "first.rid").alias("node"), "first.bits", "first.bands"), "near-classes")
    banded = firsts.select("node", F.explode("bands").alias("band"))
    many = banded.groupBy("band").agg(F.count(F.lit(1)).alias("many")).filter("many > 1")
    shared = write_stage(banded.join(many, "band"), "near-bands")
    central = shared.groupBy("node").agg(F.sum("many").alias("central"))
    pivots = shared.join(central, "node").groupBy("band").agg(F.max(F.struct("central", "node")).alias("top")).select("band", F.col("top.node").alias("pivot"))
    floor = percent / 100 - MARGIN
    low = shared.join(pivots, "band").filter(F.col("node") != F.col("pivot")).select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()
    bits = firsts.select("node", "bits")
    rated = low.join(bit_columns(bits, "x", F.col("node").alias("a")), "a").join(bit_columns(bits, "y", F.col("node").alias("b")), "b").select("a", "b", estimate("x", "y").alias("about")).filter(F.col("about") >= floor)
    best = rated.groupBy("a").agg(F.max_by("b", F.struct("about", "b")).alias("b"))
    first_pairs = write_stage(best, "near-pairs")
    first_links = write_stage(meet(rows, of_pairs(first_pairs), size, percent), "near-confirmed")
    label = components(first_links, "near-first")

    # what shares a band and is in different components now
    sized = label.join(label.groupBy("label").agg(F.count(F.lit(1)).alias("size")), "label")
    grouped = shared.select("node", "band").join(sized, "node", "left").withColumns({"label": F.coalesce("label", "node"), "size": F.coalesce("size", F.lit(1).cast("long"))})
    open_bands = grouped.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter(F.col("low") != F.col("high")).select("band")
    still = write_stage(grouped.join(open_bands, "band").join(bits, "node"), "near-open")
    asks = write_stage(asking(still, floor), "near-asks")
    members = label.select("node", "label").unionByName(still.filter("size = 1").select("node", "label").distinct())
    roles = write_stage(of_components(asks, members), "near-roles")
    if roles.limit(1).count():
        label = components(write_stage(first_links.unionByName(meet(rows, roles, size, percent)), "near-confirmed"), "near-all")

    classes = firsts.select(*same, "node").join(label, "node", "left").select(*same, F.coalesce("label", "node").alias("top"))
    return signed.join(classes, same, "left").select("doc_key", "rid", "n", F.coalesce("top", _node()).alias("top"))


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = THRESHOLD) -> DataFrame:
    """One row per document: the id, n_shingles, component_id, kept.

    A shingle is ``size`` words, ASCII letters lower-cased; a text with fewer words is one shingle, a text without words
    (or null) has an empty set and is linked with nothing. ``component_id`` is the smallest id reachable over links of
    ``percent`` similarity or more; a null id counts as larger than all others. ``kept``: id and component_id are equal (or both null).
    """
    whole = linked(keyed(docs, id_column, text), size, percent)
    own, top = (F.when(F.col(c) != LAST, F.col(c)) for c in ("doc_key", "top.doc_key"))
    return whole.select(own.alias(id_column), F.col("n").alias("n_shingles"), top.alias("component_id"), own.eqNullSafe(top).alias("kept"))


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are the smallest of their group, once each."""
    whole = linked(keyed(docs, id_column, text), size, percent)
    dropped = whole.filter(_node() != F.col("top")).select(F.when(F.col("doc_key") == LAST, F.lit(NO_ID)).otherwise(F.col("doc_key")).alias("doc_key"), "rid").distinct()
    return without(docs, dropped, id_column, text, once=True)
