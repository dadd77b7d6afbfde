"""Suffix-array dedup (operator 9): every byte that a repeated 200-byte string covers goes, wherever it stands.

`repeats` brings the candidate pieces together; this module compares them. Suffixes of the pieces of one key are sorted by a
mergesort whose comparison looks for the longest common extension by binary search over prefix polynomial hashes. Neighbours
in that order with a common extension of the whole window are repeats; their bytes are compared before they count.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm import repeats, rolling
from playlens.llm.rolling import PrefixHash
from playlens.llm.stages import array_column, keyed, map_arrow, original_id, table

WIDTH = 200
GRAM = 50
SHARD_BYTES = 1 << 20
VERIFY_PAIRS = 20_000


def byte_windows(width: int = WIDTH, gram: int | None = None) -> repeats.Windows:
    gram = gram or max(1, width // 4)
    return repeats.Windows(width=width, gram=gram, symbols=rolling.byte_symbols, units=memoryview, joined=bytes, keep_first=False, parts=4)


class SuffixOrder:
    """Windows of ``width`` bytes in one text, compared through hashes."""

    def __init__(self, data: np.ndarray, width: int):
        self.data, self.width = data, width
        self.sums = PrefixHash(rolling.BYTE_VALUES[data])

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Longest common extension of the suffixes at ``a`` and ``b``, at most ``width``: a binary search each."""
        low, high = np.zeros(len(a), np.int64), np.full(len(a), self.width, np.int64)
        while (open_ := low < high).any():
            mid = (low + high + 1) >> 1
            same = self.sums.slices(a, a + mid) == self.sums.slices(b, b + mid)
            low, high = np.where(open_ & same, mid, low), np.where(open_ & ~same, mid - 1, high)
        return low

    def before(self, a: np.ndarray, b: np.ndarray, or_equal: bool) -> np.ndarray:
        same = self.common(a, b)
        end = same >= self.width
        step = np.where(end, 0, same)
        return np.where(end, or_equal, self.data[a + step] < self.data[b + step])

    def sort(self, starts: np.ndarray, groups: np.ndarray) -> np.ndarray:
        """Order of ``starts`` (already grouped) by group and then suffix: all groups merge their runs level by level."""
        order = np.arange(len(starts))
        first = np.searchsorted(groups, groups)
        end = np.searchsorted(groups, groups, "right")
        place = order - first  # within the group
        run = 1
        longest = int((end - first).max()) if len(starts) else 0
        while run < longest:
            base = first + place // (2 * run) * (2 * run)
            in_left = (place // run) % 2 == 0
            other = np.minimum(np.where(in_left, base + run, base), end)
            other_end = np.minimum(np.where(in_left, base + 2 * run, base + run), end)
            low, high = other.copy(), other_end.copy()
            while True:
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                mid = (low[open_] + high[open_]) >> 1
                mine, theirs = starts[order[open_]], starts[order[mid]]
                left = in_left[open_]
                ahead = np.empty(len(open_), bool)  # the other goes before mine
                ahead[left] = self.before(theirs[left], mine[left], False)
                ahead[~left] = self.before(theirs[~left], mine[~left], True)
                low[open_] = np.where(ahead, mid + 1, low[open_])
                high[open_] = np.where(ahead, high[open_], mid)
            mine_from = np.where(in_left, base, np.minimum(base + run, end))
            target = base + (np.arange(len(order)) - mine_from) + (low - other)
            merged = np.empty_like(order)
            merged[target] = order
            order = merged
            run *= 2
        return order

    def verified(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the windows at ``a`` and ``b`` hold the same bytes."""
        steps, out = np.arange(self.width), np.empty(len(a), bool)
        for i in range(0, len(a), VERIFY_PAIRS):
            s = slice(i, i + VERIFY_PAIRS)
            out[s] = (self.data[a[s, None] + steps] == self.data[b[s, None] + steps]).all(axis=1)
        return out


def repeated_in_shard(groups: list[list[tuple]], width: int) -> Iterator[tuple[int, int, int, int]]:
    """Ranges of the windows that another piece of the same key holds too."""
    groups = [g for g in groups if len(g) > 1]
    if not groups:
        return
    pieces = [(i, *row) for i, group in enumerate(groups) for row in group]
    sizes = np.array([len(p[7]) for p in pieces])
    at = np.cumsum(sizes) - sizes
    n, ahead = np.array([p[4] for p in pieces]), np.array([p[5] for p in pieces])
    owner = np.repeat(np.arange(len(pieces)), n)
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    starts = at[owner] + inner
    # equal windows have their anchor equally far ahead
    group = np.array([p[0] for p in pieces])[owner] * (repeats.SMALL + 1) + ahead[owner] - inner
    by_group = np.argsort(group, kind="stable")
    owner, inner, starts, group = owner[by_group], inner[by_group], starts[by_group], group[by_group]
    suffixes = SuffixOrder(np.frombuffer(b"".join(p[7] for p in pieces), np.uint8), width)
    order = suffixes.sort(starts, group)
    a, b = order[:-1], order[1:]
    near = np.flatnonzero(group[a] == group[b])
    a, b = a[near], b[near]
    equal = suffixes.common(starts[a], starts[b]) >= width
    a, b = a[equal], b[equal]
    same = suffixes.verified(starts[a], starts[b])
    repeated = np.zeros(len(starts), bool)
    repeated[a[same]] = repeated[b[same]] = True
    hit = np.flatnonzero(repeated)
    hit = hit[np.lexsort((inner[hit], owner[hit]))]
    cut = np.flatnonzero((np.diff(owner[hit]) != 0) | (np.diff(inner[hit]) != 1)) + 1
    for run in np.split(hit, cut) if len(hit) else ():
        _, doc, rid, start, _, _, settled, _ = pieces[owner[run[0]]]
        if not settled:
            yield doc, rid, start + int(inner[run[0]]), start + int(inner[run[-1]]) + width


def repeated_bytes(docs: DataFrame, width: int = WIDTH, gram: int | None = None) -> DataFrame:
    """(doc_key, rid, ranges) of the bytes of keyed documents that repeated ``width``-byte strings cover."""
    return repeats.repeated_ranges(docs, byte_windows(width, gram), lambda groups: repeated_in_shard(groups, width), SHARD_BYTES, "bytes")


def strip_repeats(docs: DataFrame, id_column: str = "doc_id", text: str = "text", width: int = WIDTH, gram: int | None = None) -> DataFrame:
    """Documents without the bytes that a repeated string covers.

    Columns: the id, n_bytes, n_removed, n_spans (maximal removed runs), kept (remaining bytes), kept_sha256.
    A null text counts as empty; a null id stays null. Repeated rows are occurrences of their own, so rows that
    are equal in id and text are removed in each other's favour like any copies. Texts under ``width`` bytes stay whole.
    """
    rows = keyed(docs, id_column, text)
    marked = rows.join(repeated_bytes(rows, width, gram), ["doc_key", "rid"], "left")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, offsets = rolling.text_bytes(batch.column("text"))
            kept, removed, spans = [], [], []
            for a, b, ranges in zip(offsets[:-1].tolist(), offsets[1:].tolist(), batch.column("ranges").to_pylist()):
                if ranges:
                    gone = repeats.covered(ranges, b - a)
                    kept.append(flat[a:b][~gone].tobytes())
                    spans.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
                else:
                    kept.append(flat[a:b].tobytes())
                    spans.append(0)
                removed.append(b - a - len(kept[-1]))
            yield table(
                doc_key=array_column(batch, "doc_key"), n_bytes=np.diff(offsets), n_removed=pa.array(removed, pa.int64()), n_spans=pa.array(spans, pa.int64()),
                kept=pa.array(kept, pa.binary()), kept_sha256=pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
            )

    out = map_arrow(marked, work, "doc_key long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
    return out.select(original_id().alias(id_column), "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256")
