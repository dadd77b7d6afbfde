"""Windows of consecutive symbols that occur again elsewhere in the corpus, found without pairs of documents.

Every window of ``width`` symbols owns one *anchor*: of its ``gram``-symbol grams the one with the smallest hash, the
leftmost at a tie. Equal windows own equal anchors at equal offsets, so only occurrences of an anchor need to meet.
Consecutive windows with one anchor form a *piece*; a document of n symbols has about 2n / (width - gram + 2) of them, and
only these are shuffled:

1. Pieces are hashed by their whole content where they are cut. Each task first settles the copies it has seen itself, so a passage in a third of
   all rows sends one row per task and not one per document.
2. The rest is sorted by (anchor, piece hash) and streamed. In a class of equal pieces all windows repeat. An anchor with
   several classes (the edges of copied passages) leaves one *request* per class.
3. Requested pieces are cut from their texts and meet again under keys that cover nearly the whole window (`sub_pieces`),
   where an exact method of the operator compares their contents.

A window is judged on the input, never on what is left. ``keep_first`` leaves the occurrence with the smallest
(document, start); otherwise all occurrences count as repeated.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm import rolling
from playlens.llm.rolling import U64, PrefixHash, mix
from playlens.llm.stages import array_column, likely_in, map_arrow, table, write_stage

COMBINE_ROWS = 200_000
OUT_BYTES = 1 << 20  # of contents that a task gathers before it hands them on
OCCURRENCE = "anchor long, piece long, doc_key long, rid long, at long"
FOUND = "kind int, doc_key long, rid long, start int, n int, ahead int, settled boolean"
PIECE = "key long, doc_key long, rid long, start int, n int, ahead int, settled boolean, content binary"
# `at` packs two flags, the window count, how far the anchor lies ahead of the start, and the start
REMOVED, MANY, N_SHIFT, AHEAD_SHIFT, START_SHIFT, SMALL = 1, 2, 2, 11, 20, 0x1FF
HOT_KEY = 20_000  # pieces under one key beyond which windows are grouped one by one


@dataclass(frozen=True)
class Windows:
    width: int  # symbols of a window
    gram: int  # symbols of an anchor
    symbols: Callable  # (bytes, row offsets) -> symbols, row offsets in symbols
    units: Callable  # text bytes -> sliceable symbols
    joined: Callable  # slice of symbols -> bytes
    keep_first: bool
    parts: int  # groups of windows of an anchor that meet under keys of their own

    def __post_init__(self):
        if not 0 < self.span <= SMALL:
            raise ValueError(f"a window may hold 1 to {SMALL} anchors")

    @property
    def span(self) -> int:
        """Grams of a window, and the most windows of a piece."""
        return self.width - self.gram + 1


def _content_hashes(symbols: np.ndarray, start: np.ndarray, end: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """XXH3 hash of the content of each slice. Pieces count as equal by it and their anchor, of 64 bits each."""
    view, size = memoryview(np.ascontiguousarray(symbols).view(np.uint8)), symbols.itemsize
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(view[a:b], seed=s) for a, b, s in zip((start * size).tolist(), (end * size).tolist(), seeds.tolist())), U64, len(start))


def cut_pieces(symbols: np.ndarray, rows: np.ndarray, spec: Windows) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, start, windows, anchor position, anchor hash, piece hash) of all pieces, chunk by chunk."""
    values = rolling.BYTE_VALUES if symbols.dtype == np.uint8 else None
    for first, last in rolling.groups_of_rows(np.diff(rows), rolling.CHUNK):
        low, high = int(rows[first]), int(rows[last])
        step = rolling.CHUNK - spec.width
        for at in range(low, max(high - spec.width + 1, low + 1), step):
            end = min(high, at + step + spec.width - 1)
            part = symbols[at:end]
            if len(part) < spec.width:
                continue
            sums = PrefixHash(values[part] if values is not None else part)
            grams = sums.grams(spec.gram)
            mask = U64(rolling.CHUNK - 1)
            least = rolling.sliding_min((grams & ~mask) | np.arange(len(grams), dtype=U64), spec.span)
            # window starts whose window ends within their row
            fits = np.ones(len(least), bool)
            for edge in (rows[first + 1: last] - at).tolist():
                fits[max(0, edge - spec.width + 1): max(0, edge)] = False
            starts = np.flatnonzero(fits)
            if not len(starts):
                continue
            anchor_at = (least[starts] & mask).astype(np.int64)
            new = np.ones(len(starts), bool)
            new[1:] = (anchor_at[1:] != anchor_at[:-1]) | (starts[1:] != starts[:-1] + 1)
            begin = np.flatnonzero(new)
            n = np.diff(np.append(begin, len(starts)))
            s0, pos = starts[begin], anchor_at[begin]
            piece = _content_hashes(part, s0, s0 + n - 1 + spec.width, n + (pos - s0) * 65_536)
            row = np.searchsorted(rows[first: last + 1], s0 + at, "right") - 1 + first
            yield row, s0 + at - rows[row], n, pos - s0, grams[pos], piece


def _combined(columns: list[np.ndarray], spec: Windows) -> pa.RecordBatch:
    """Settles the classes of one buffer of occurrences: first rows go on, all others are removed already."""
    anchor, piece, doc, rid, at = columns
    order = np.lexsort((at, rid, doc, piece, anchor))
    anchor, piece, doc, rid, at = (c[order] for c in (anchor, piece, doc, rid, at))
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (piece[1:] != piece[:-1])
    if spec.keep_first:
        same = np.zeros(len(anchor), bool)  # a repeated row of the table is the same occurrence
        same[1:] = ~new[1:] & (doc[1:] == doc[:-1]) & (rid[1:] == rid[:-1]) & (at[1:] == at[:-1])
        anchor, piece, doc, rid, at, new = (c[~same] for c in (anchor, piece, doc, rid, at, new))
    else:
        many = np.append(~new[1:], False) & new
        at = at | np.where(many, MANY, 0)
    gone = ~new
    if gone.any():  # dealt out by document, since they meet nobody
        at = at | np.where(gone, REMOVED, 0)
        anchor = np.where(gone, mix((doc ^ (at << 7)).astype(U64)).astype(np.int64), anchor)
    return table(anchor=anchor, piece=piece, doc_key=doc, rid=rid, at=at)


def occurrences(docs: DataFrame, spec: Windows) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            doc, rid = array_column(batch, "doc_key"), array_column(batch, "rid")
            for row, s0, n, ahead, anchor, piece in cut_pieces(*spec.symbols(*rolling.text_bytes(batch.column("text"))), spec):
                held.append((anchor.view(np.int64), piece.view(np.int64), doc[row], rid[row], (s0 << START_SHIFT) | (ahead << AHEAD_SHIFT) | (n << N_SHIFT)))
                size += len(row)
                if size >= COMBINE_ROWS:
                    yield _combined([np.concatenate(c) for c in zip(*held)], spec)
                    held, size = [], 0
        if held:
            yield _combined([np.concatenate(c) for c in zip(*held)], spec)

    return map_arrow(docs, work, OCCURRENCE)


def settle(sorted_occurrences: DataFrame, spec: Windows) -> DataFrame:
    """Streams occurrences sorted by (anchor, piece, document, start) into removed pieces (kind 0) and requests (kind 1)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry: list[np.ndarray] | None = None  # first row of the class that may go on
        carry_multi = False  # whether its anchor had another class before
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [array_column(batch, c) for c in ("anchor", "piece", "doc_key", "rid", "at")]
            if carry is not None:
                rows = [np.concatenate([c, r]) for c, r in zip(carry, rows)]
            out, carry, carry_multi = _settled(rows, carry is not None and carry_multi, spec, last=False)
            yield out
        if carry is not None:
            yield _settled(carry, carry_multi, spec, last=True)[0]

    return map_arrow(sorted_occurrences, work, FOUND)


def _settled(rows: list[np.ndarray], multi_before: bool, spec: Windows, last: bool):
    anchor, piece, doc, rid, at = rows
    size = len(anchor)
    new_anchor = np.ones(size, bool)
    new_anchor[1:] = anchor[1:] != anchor[:-1]
    new = new_anchor.copy()
    new[1:] |= piece[1:] != piece[:-1]
    first = np.flatnonzero(new)  # of the classes
    first_of = first[np.cumsum(new) - 1]
    gone = ~new
    if spec.keep_first:
        gone &= ~((doc == doc[first_of]) & (rid == rid[first_of]) & ((at ^ at[first_of]) < (1 << N_SHIFT)))
    counts = np.diff(np.append(first, size))
    many = (counts > 1) | ((at[first] & MANY) > 0)
    group = np.cumsum(new_anchor) - 1
    classes = np.bincount(group[first])
    multi = classes[group[first]] > 1
    if multi_before:
        multi[group[first] == 0] = True
    removed = (at[first] & REMOVED) > 0
    whole = removed if spec.keep_first else removed | many
    ends_open = 0 if last else 1
    decided = np.arange(len(first)) < len(first) - ends_open
    carry, carry_multi = None, False
    if ends_open:
        k = first[-1]
        carry = [c[k: k + 1].copy() for c in rows]
        if many[-1] and not spec.keep_first:
            carry[4] |= MANY
        carry_multi = bool(multi[-1])
        if not multi[-1] and len(first) > 1 and group[first[-2]] == group[first[-1]]:
            carry_multi = True
    take_whole = first[decided & whole]
    take_gone = np.flatnonzero(gone)
    ask = decided & multi & ~removed
    index = np.concatenate([take_whole, take_gone, first[ask]])
    kind = np.concatenate([np.zeros(len(take_whole) + len(take_gone), np.int32), np.ones(int(ask.sum()), np.int32)])
    settled = np.concatenate([np.zeros(len(take_whole) + len(take_gone), bool), whole[ask]])
    return table(
        kind=kind, doc_key=doc[index], rid=rid[index], start=(at[index] >> START_SHIFT).astype(np.int32),
        n=((at[index] >> N_SHIFT) & SMALL).astype(np.int32), ahead=((at[index] >> AHEAD_SHIFT) & SMALL).astype(np.int32), settled=settled,
    ), carry, carry_multi


def found(docs: DataFrame, spec: Windows, name: str) -> DataFrame:
    """Removed pieces and requests of keyed documents, written to the shared folder."""
    dealt = occurrences(docs, spec).repartition("anchor").sortWithinPartitions("anchor", "piece", "doc_key", "rid", "at")
    return write_stage(settle(dealt, spec), name)


def per_document(ranges: DataFrame, columns: list[str], name: str) -> DataFrame:
    """The ranges of a document as one list; a document has no more of them than symbols."""
    return ranges.groupBy("doc_key", "rid").agg(F.collect_list(F.struct(*columns)).alias(name))


def sub_pieces(units, start: int, n: int, ahead: int, spec: Windows) -> Iterator[tuple[int, int, int, int, bytes]]:
    """(key, start, windows, anchor ahead, content) of a piece, its windows grouped by how far the anchor lies ahead.

    The key covers all symbols that every window of such a group holds, so contexts that differ seldom share it.
    """
    pos, step = start + ahead, -(-spec.span // spec.parts)
    for j in range((ahead - n + 1) // step, ahead // step + 1):
        near, far = j * step, min((j + 1) * step, spec.span) - 1
        a, b = max(start, pos - far), min(start + n, pos - near + 1)
        common = spec.joined(units[pos - near: pos - far + spec.width])
        yield xxhash.xxh3_64_intdigest(common, seed=j) - (1 << 63), a, b - a, pos - a, spec.joined(units[a: b - 1 + spec.width])


def requested(docs: DataFrame, requests: DataFrame, spec: Windows, name: str) -> DataFrame:
    """The requested pieces with their contents, written to the shared folder; only keys that pieces share."""

    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.binary())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        size = 0
        pack = lambda: table(**{c.split()[0]: pa.array(v, k) for c, v, k in zip(PIECE.split(", "), zip(*out), kinds)})
        for batch in batches:
            for doc, rid, text, asked in zip(*(batch.column(c) for c in ("doc_key", "rid", "text", "asked"))):
                units = spec.units(text.as_buffer().to_pybytes() if text.is_valid else b"")
                doc, rid = doc.as_py(), rid.as_py()
                for ask in asked:
                    ask = ask.as_py()
                    for key, start, n, ahead, content in sub_pieces(units, ask["start"], ask["n"], ask["ahead"], spec):
                        out.append((key, doc, rid, start, n, ahead, ask["settled"], content))
                        size += len(content)
                    if size >= OUT_BYTES:
                        yield pack()
                        out, size = [], 0
        if out:
            yield pack()

    asked = per_document(requests, ["start", "n", "ahead", "settled"], "asked")
    return write_stage(map_arrow(likely_in(docs, requests).join(asked, ["doc_key", "rid"]), work, PIECE), name)


def resolve(pieces: DataFrame, spec: Windows, shard: Callable[[list[list[tuple]]], Iterator[tuple]], shard_bytes: int) -> DataFrame:
    """Ranges (doc_key, rid, start, end) of repeated windows among requested pieces.

    Pieces of one key are sorted and handed to ``shard`` in whole groups of some ``shard_bytes`` together; with
    ``keep_first``, the pieces of a repeated row of the table are handed on once. Keys with more than HOT_KEY pieces take another way to the same result: one row per window and a grouping that adds up before the shuffle.
    """
    ranges = "doc_key long, rid long, start int, end int"
    counts = pieces.groupBy("key").agg(F.count(F.lit(1)).alias("many")).filter("many > 1")
    shared = pieces.join(counts, "key")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(groups):
            rows = list(shard(groups))
            if rows:
                a, b, c, d = zip(*rows)
                yield table(doc_key=pa.array(a, pa.int64()), rid=pa.array(b, pa.int64()), start=pa.array(c, pa.int32()), end=pa.array(d, pa.int32()))

        groups: list[list[tuple]] = []
        size, last = 0, None
        before: tuple | None = None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("key", "doc_key", "rid", "start", "n", "ahead", "settled", "content"))):
                if row[0] != last:
                    if size >= shard_bytes:
                        yield from flush(groups)
                        groups, size = [], 0
                    groups.append([])
                    last = row[0]
                if spec.keep_first and row[:4] == before:
                    continue
                before = row[:4]
                groups[-1].append(row[1:])
                size += len(row[7])
        if groups:
            yield from flush(groups)

    usual = shared.filter(F.col("many") <= HOT_KEY).drop("many").repartition("key").sortWithinPartitions("key", "doc_key", "rid", "start")
    return map_arrow(usual, work, ranges).unionByName(_by_window(shared.filter(F.col("many") > HOT_KEY), spec))


def _by_window(pieces: DataFrame, spec: Windows) -> DataFrame:
    """Repeated windows by grouping each window's content hash (128 bits)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, doc, rid, start, n, settled, content in zip(*(batch.column(c).to_pylist() for c in ("key", "doc_key", "rid", "start", "n", "settled", "content"))):
                units = spec.units(content)
                out += [(xxhash.xxh3_128_digest(spec.joined(units[i: i + spec.width])), doc, rid, start + i, settled) for i in range(n)]
            if out:
                a, b, c, d, e = zip(*out)
                yield table(window=pa.array(a, pa.binary()), doc_key=pa.array(b, pa.int64()), rid=pa.array(c, pa.int64()), start=pa.array(d, pa.int32()), settled=pa.array(e, pa.bool_()))

    rows = map_arrow(pieces, work, "window binary, doc_key long, rid long, start int, settled boolean")
    at = F.struct("doc_key", "rid", "start")
    firsts = rows.groupBy("window").agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    again = rows.join(firsts, "window")
    again = again.filter(at > F.col("first")) if spec.keep_first else again.filter(~F.col("settled"))
    return again.select("doc_key", "rid", "start", (F.col("start") + spec.width).cast("int").alias("end"))


def repeated_ranges(docs: DataFrame, spec: Windows, shard: Callable, shard_bytes: int, name: str, more: DataFrame | None = None) -> DataFrame:
    """(doc_key, rid, ranges): half-open symbol ranges that repeated windows cover, of documents that have any; ``more`` are others besides."""
    pieces = found(docs, spec, f"{name}-found")
    asked = requested(docs, pieces.filter("kind = 1").drop("kind"), spec, f"{name}-pieces")
    whole = pieces.filter("kind = 0").select("doc_key", "rid", "start", (F.col("start") + F.col("n") - 1 + spec.width).cast("int").alias("end"))
    whole = whole.unionByName(resolve(asked, spec, shard, shard_bytes))
    return per_document(whole if more is None else whole.unionByName(more), ["start", "end"], "ranges")


def covered(ranges: list, length: int) -> np.ndarray:
    """Marks the symbols of a document that its ranges cover."""
    edge = np.zeros(length + 1, np.int32)
    for r in ranges or ():
        edge[r["start"]] += 1
        edge[r["end"]] -= 1
    return np.cumsum(edge[:-1]) > 0
