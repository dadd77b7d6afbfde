"""Conversation prefix trie (operator 11): nodes of shared prefixes, and totals of their subtrees by time-forward processing.

A turn is known by a digest of its role and text, so texts are read once and never shuffled. Turns are sorted by ranges of
(conversation, turn), so a conversation of any length is numbered by many tasks. A prefix is known by the exclusive or of
hashes of its (digest, depth), 128 bits, which bands of depth add up on their own; equal prefixes are one node.

A node is named by (conv_id, depth), conv_id its smallest member. Members of a node are members of its parent, so the nodes of one name
make a path, and only the top of a path has to look up its parent's name.

Totals of subtrees go from children to parents. Nodes with one member are chains whose totals are plain; each chain counts
for the node above it, added up per task before the shuffle. The other nodes are dealt out to shards: nodes of at most
``LIGHT`` members belong to the subtree of their highest such ancestor. A shard's nodes are sorted externally by reverse
level order. A node takes from a priority queue what its children have sent, and sends its totals to its parent through
that queue, which spills sorted runs to disk. What goes to parents outside the shard is added up per parent, and the heavier
nodes are the next, smaller trie, with ``LIGHT`` times as many members to a shard. The last shard holds at most ``TOP_NODES``.
"""

from __future__ import annotations

import hashlib
import heapq
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from playlens.llm.stages import array_column, map_arrow, small_batches, table, write_stage

GROUP, HEAD = 5, 9  # conversations of a group share the head of the first; a head has less than HEAD turns
LIGHT = 1_000  # members of a subtree that one shard holds
TOP_NODES = 100_000  # nodes that the last shard may hold
BAND = 4_096  # turns of a conversation whose prefixes are computed together
QUEUE = 100_000  # messages that a queue holds in memory
BLOCK_BYTES = 1 << 20  # of joined ids

KEY = ["kx", "ky", "depth"]
TOTALS = "kind int, conv long, depth long, children long, leaves long, saved long"


def numbered(turns: DataFrame) -> DataFrame:
    """(conv, part, local, a, b, bytes): turns in order, numbered within each conversation's share of a sorted part."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, count = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            conv = array_column(batch, "conv")
            if not len(conv):
                continue
            new = np.append(conv[0] != last, conv[1:] != conv[:-1])
            start = np.maximum.accumulate(np.where(new, np.arange(len(conv)), -count))
            local = np.arange(len(conv)) - start + 1
            last, count = conv[-1], int(local[-1])
            yield table(conv=conv, part=np.full(len(conv), part), local=local, **{c: batch.column(c) for c in ("a", "b", "bytes")})

    order = ["conv", "turn", "a", "b"]
    dealt = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    return write_stage(map_arrow(dealt, work, "conv long, part long, local long, a long, b long, bytes long"), "trie-turns")


def digested(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, a, b, bytes): 120 bits that stand for role and text, and the bytes of the text."""
    role_, text_ = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text))
    digest = F.sha2(F.concat(F.length(role_).cast("string"), F.lit(":"), role_, text_), 256)
    bits = lambda at: F.conv(F.substring("digest", at, 15), 16, 10).cast("long")
    rows = df.select(F.col(f"`{conv}`").cast("long").alias("conv"), F.col(f"`{turn}`").alias("turn"), digest.alias("digest"), F.octet_length(text_).cast("long").alias("bytes"))
    return rows.filter("conv IS NOT NULL").select("conv", "turn", bits(1).alias("a"), bits(16).alias("b"), "bytes")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations: (conv, length), and their turns (conv, depth, a, b, bytes, last) in a new order."""
    parts = turns.groupBy("conv", "part").agg(F.max("local").alias("n"))
    by = W.partitionBy("conv")
    parts = parts.select(
        "conv", "part", F.coalesce(F.sum("n").over(by.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"), F.sum("n").over(by).alias("own"))
    convs = parts.groupBy("conv").agg(F.first("own").alias("own")).select(
        "conv", "own", (F.col("conv") - F.col("conv") % GROUP).alias("base"), (F.crc32(F.col("conv").cast("string")) % HEAD).alias("head"))
    bases = convs.select(F.col("conv").alias("base"), F.col("own").alias("base_own"))
    taken = F.least("head", F.coalesce("base_own", F.lit(0)))
    convs = write_stage(convs.join(bases, "base", "left").select(
        "conv", "base", "head", taken.alias("taken"), (taken + F.greatest(F.col("own") - F.col("head"), F.lit(0))).alias("length")), "trie-convs")
    placed = turns.join(parts.join(convs, "conv"), ["conv", "part"]).withColumn("pos", F.col("before") + F.col("local"))
    tail = placed.filter("pos > head").select("conv", (F.col("pos") - F.col("head") + F.col("taken")).alias("depth"), "a", "b", "bytes", "length")
    heads = placed.filter((F.col("base") == F.col("conv")) & (F.col("pos") < HEAD)).select("base", F.col("pos").alias("depth"), "a", "b", "bytes")
    head = convs.join(heads, "base").filter("depth <= head").select("conv", "depth", "a", "b", "bytes", "length")
    return convs.select("conv", "length"), tail.unionByName(head)


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv, depth, kx, ky, px, py, bytes, last): the key of each prefix, and of the prefix one turn shorter."""
    hashed = turns.select(
        "conv", "depth", "bytes", "length", F.xxhash64("a", "b", "depth").alias("x"), F.xxhash64("depth", "b", "a", F.lit(7)).alias("y"), F.floor(F.col("depth") / BAND).alias("band"))
    inner = W.partitionBy("conv", "band").orderBy("depth")
    near = hashed.withColumns({"nx": F.bit_xor("x").over(inner), "ny": F.bit_xor("y").over(inner)})
    before = W.partitionBy("conv").orderBy("band").rowsBetween(W.unboundedPreceding, -1)
    carried = hashed.filter(F.col("length") >= BAND).groupBy("conv", "band").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y")).select(
        "conv", "band", F.bit_xor("x").over(before).alias("cx"), F.bit_xor("y").over(before).alias("cy"))
    whole = lambda near, carry: F.col(near).bitwiseXOR(F.coalesce(carry, F.lit(0).cast("long")))
    out = near.join(carried, ["conv", "band"], "left").select(
        "conv", "depth", "bytes", (F.col("depth") == F.col("length")).alias("last"), "x", "y", whole("nx", "cx").alias("kx"), whole("ny", "cy").alias("ky"))
    return write_stage(out.select("conv", *KEY, F.col("kx").bitwiseXOR(F.col("x")).alias("px"), F.col("ky").bitwiseXOR(F.col("y")).alias("py"), "bytes", "last"), "trie-prefixes")


def named(rows: DataFrame, convs: DataFrame, root: int) -> DataFrame:
    """Nodes but the root: key, conv, depth, n_convs, bytes, parent, length (of the conversation that names it)."""
    nodes = write_stage(rows.groupBy(*KEY).agg(
        F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs"), F.max("bytes").alias("bytes"), F.max("px").alias("px"), F.max("py").alias("py")), "trie-nodes")
    tops = nodes.groupBy("conv").agg(F.min("depth").alias("top"), F.min_by(F.struct("px", "py"), "depth").alias("p"))
    above = nodes.select(F.col("kx").alias("px"), F.col("ky").alias("py"), (F.col("depth") + 1).alias("top"), F.col("conv").alias("above"))
    paths = tops.select("conv", "top", "p.px", "p.py").join(above, ["px", "py", "top"], "left").join(convs, "conv").select(
        "conv", "top", "length", F.coalesce("above", F.lit(root).cast("long")).alias("above"))
    parent = F.when(F.col("depth") > F.col("top"), F.col("conv")).otherwise(F.col("above"))
    return write_stage(nodes.drop("px", "py").join(paths, "conv").select(*KEY, "conv", "n_convs", "bytes", "length", parent.alias("parent")), "trie-named")


class SpillingQueue:
    """Least first, over rows of whole numbers; beyond ``most`` rows in memory, sorted runs go to temporary files."""

    def __init__(self, most: int = QUEUE):
        self.most, self.heap, self.runs, self.fresh = most, [], [], 0

    def push(self, row: tuple[int, ...]) -> None:
        heapq.heappush(self.heap, (*row, -1))
        self.fresh += 1
        if self.fresh >= self.most:
            self._spill()

    def _spill(self) -> None:
        rows = sorted(r for r in self.heap if r[-1] < 0)
        self.heap = [r for r in self.heap if r[-1] >= 0]
        heapq.heapify(self.heap)
        file = tempfile.TemporaryFile()  # gone with the process, however it ends
        np.array([r[:-1] for r in rows], np.int64).tofile(file)
        file.seek(0)
        self.runs.append(self._read(file, len(rows[0]) - 1))
        self.fresh = 0
        self._next(len(self.runs) - 1)

    @staticmethod
    def _read(file, width: int, rows: int = 2_048) -> Iterator[tuple[int, ...]]:
        with file:
            while data := file.read(8 * width * rows):
                yield from map(tuple, np.frombuffer(data, np.int64).reshape(-1, width).tolist())

    def _next(self, run: int) -> None:
        row = next(self.runs[run], None)
        if row is not None:
            heapq.heappush(self.heap, (*row, run))

    def pop(self) -> tuple[int, ...]:
        *row, run = heapq.heappop(self.heap)
        if run < 0:
            self.fresh -= 1
        else:
            self._next(run)
        return tuple(row)

    def head(self) -> tuple[int, ...] | None:
        return self.heap[0][:-1] if self.heap else None


def forwarded(rows: Iterator[tuple], queue: int = QUEUE) -> Iterator[tuple]:
    """Totals of nodes that come in reverse level order: (0, conv, depth, children, leaves, saved) of each node, and at last
    (1, ...) what goes to parents that did not come. Rows: conv, depth, parent, own, children, leaves, saved; the last
    three are what came from other shards."""
    waiting = SpillingQueue(queue)

    def received(conv: int, depth: int) -> tuple[int, int, int]:
        got = [0, 0, 0]
        while (head := waiting.head()) is not None and head[:2] == (-depth, conv):
            for i, value in enumerate(waiting.pop()[2:]):
                got[i] += value
        return tuple(got)

    for conv, depth, parent, own, children, leaves, saved in rows:
        got = received(conv, depth)
        children, leaves, saved = children + got[0], leaves + got[1], own + saved + got[2]
        leaves = leaves if children else 1
        yield 0, conv, depth, children, leaves, saved
        if parent is not None:
            waiting.push((1 - depth, parent, 1, leaves, saved))
    while (head := waiting.head()) is not None:
        yield 1, head[1], -head[0], *received(head[1], -head[0])


def shard_totals(nodes: DataFrame, queue: int = QUEUE) -> DataFrame:
    """TOTALS of nodes with a ``shard``: conv, depth, parent, own, children, leaves, saved."""
    columns = ["shard", "conv", "depth", "parent", "own", "children", "leaves", "saved"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in columns)))
        held: tuple | None = next(rows, None)

        def shard() -> Iterator[tuple]:
            nonlocal held
            first = held[0]
            while held is not None and held[0] == first:
                yield held[1:]
                held = next(rows, None)

        out: list[tuple] = []
        names = [c.split()[0] for c in TOTALS.split(", ")]
        pack = lambda: table(**{n: pa.array(v, pa.int32() if n == "kind" else pa.int64()) for n, v in zip(names, zip(*out))})
        while held is not None:
            for row in forwarded(shard(), queue):
                out.append(row)
                if len(out) >= 20_000:
                    yield pack()
                    out = []
        if out:
            yield pack()

    order = [F.col("shard"), F.col("depth").desc(), F.col("conv")]
    return map_arrow(nodes.select(*columns).repartition("shard").sortWithinPartitions(*order), work, TOTALS)


def subtree_totals(nodes: DataFrame, rows: DataFrame, root: DataFrame, light: int, top_nodes: int, queue: int) -> list[DataFrame]:
    """(conv, depth, children, leaves, saved) of all nodes with several members and of the root, in written parts."""
    chains = nodes.filter("n_convs = 1").groupBy("conv").agg(F.min("depth").alias("depth"), F.min_by("parent", "depth").alias("parent"))
    sent = chains.groupBy(F.col("parent").alias("conv"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("children"))
    sent = sent.select("conv", "depth", "children", F.col("children").alias("leaves"), F.lit(0).cast("long").alias("saved"))
    shared = nodes.filter("n_convs > 1").select(*KEY, "conv", "parent", "n_convs", ((F.col("n_convs") - 1) * F.col("bytes")).alias("own"))
    parts, most, top = [], light, F.col("depth") == 0
    left = shared.unionByName(root)
    while True:
        heavy = left.filter(top | (F.col("n_convs") > most))
        last = heavy.count() <= top_nodes
        got = left.filter(~top & (F.col("n_convs") <= most))
        # the key of the highest light ancestor, which all members of its subtree share
        shards = rows.join(heavy.select(*KEY), KEY, "left_anti").groupBy("conv").agg(F.min_by("kx", "depth").alias("shard"))
        got = got.join(shards, "conv")
        parts.append(write_stage(shard_totals(_with_received(got, sent), queue), "trie-totals"))
        more = parts[-1].filter("kind = 1").select("conv", "depth", "children", "leaves", "saved")
        sent = sent.unionByName(more).groupBy("conv", "depth").agg(*(F.sum(c).alias(c) for c in ("children", "leaves", "saved")))
        if last:
            parts.append(write_stage(shard_totals(_with_received(heavy.withColumn("shard", F.lit(0).cast("long")), sent), queue), "trie-totals"))
            return [p.filter("kind = 0").drop("kind") for p in parts]
        sent, left, most = write_stage(sent, "trie-sent"), write_stage(heavy, "trie-left"), most * light


def _with_received(nodes: DataFrame, sent: DataFrame) -> DataFrame:
    return nodes.join(sent, ["conv", "depth"], "left").fillna(0, ["children", "leaves", "saved"])


def ends(rows: DataFrame, convs: DataFrame, block_bytes: int) -> DataFrame:
    """(key, ends_sha256) of the nodes where conversations end.

    Ids are sorted by ranges, so many tasks join the ids of one node; the digest then reads these blocks in order.
    """
    zero = F.lit(0).cast("long")
    ended = rows.filter("last").select(*KEY, "conv").unionByName(convs.filter("length = 0").select(zero.alias("kx"), zero.alias("ky"), zero.alias("depth"), "conv"))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, ids, size = None, None, [], 0
        pack = lambda: table(kx=[key[0]], ky=[key[1]], depth=[key[2]], first=[first], ids=[b",".join(ids)])
        for batch in batches:
            for *now, conv in zip(*(batch.column(c).to_pylist() for c in (*KEY, "conv"))):
                if ids and (now != key or size >= block_bytes):
                    yield pack()
                    ids, size = [], 0
                if not ids:
                    key, first = now, conv
                ids.append(b"%d" % conv)
                size += len(ids[-1]) + 1
        if ids:
            yield pack()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None
        pack = lambda: table(kx=[key[0]], ky=[key[1]], depth=[key[2]], ends_sha256=[sha.hexdigest()])
        for batch in batches:
            for *now, ids in zip(*(batch.column(c).to_pylist() for c in (*KEY, "ids"))):
                if now == key:
                    sha.update(b",")
                else:
                    if key is not None:
                        yield pack()
                    key, sha = now, hashlib.sha256()
                sha.update(ids)
        if key is not None:
            yield pack()

    order = [*KEY, "conv"]
    schema = "kx long, ky long, depth long"
    joined = map_arrow(ended.repartitionByRange(*order).sortWithinPartitions(*order), blocks, f"{schema}, first long, ids binary")
    return map_arrow(joined.repartition(*KEY).sortWithinPartitions(*KEY, "first"), digests, f"{schema}, ends_sha256 string")


def prefix_trie(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                light: int = LIGHT, top_nodes: int = TOP_NODES, queue: int = QUEUE) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Every conversation c is rebuilt first: the first h turns of conversation c - c % 5, then its own turns after its first h,
    h being the unsigned CRC-32 of its decimal id, modulo 9. A null role or text is empty. Turns are ordered by ``turn``, null
    first; at a tie by the SHA-256 of role and text, so repeated rows are turns of their own. Rows with a null conversation
    id belong to no conversation. c % 5 keeps the sign of c. Other columns play no part. An empty table has no nodes.
    """
    small_batches(df.sparkSession)
    convs, turns = rebuilt(numbered(digested(df, conv, turn, role, text)))
    least = convs.agg(F.min("conv").alias("root"), F.count(F.lit(1)).alias("n")).first()
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    if not least["n"]:
        return df.sparkSession.createDataFrame([], ", ".join(f"{n} long" for n in names) + ", ends_sha256 string")
    rows = prefixes(turns)
    nodes = named(rows, convs, least["root"])
    spark = df.sparkSession
    root = spark.createDataFrame([(0, 0, 0, least["root"], None, least["n"], 0)], "kx long, ky long, depth long, conv long, parent long, n_convs long, own long")
    totals = subtree_totals(nodes, rows, root, light, top_nodes, queue)
    known = totals[0]
    for part in totals[1:]:
        known = known.unionByName(part)
    plain: Column = F.when(F.col("depth") < F.col("length"), 1).otherwise(0).cast("long")
    every = nodes.select(*KEY, "conv", "parent", "n_convs", plain.alias("plain")).unionByName(root.drop("own").withColumn("plain", F.lit(0).cast("long")))
    out = every.join(known, ["conv", "depth"], "left").join(ends(rows, convs, BLOCK_BYTES), KEY, "left")
    return out.select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", F.coalesce("children", "plain").alias("n_children"),
        F.coalesce("leaves", F.lit(1).cast("long")).alias("n_leaves"), F.coalesce("saved", F.lit(0).cast("long")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))
