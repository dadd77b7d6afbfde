"""Polynomial hashes, sliding minima and Arrow text helpers, vectorised over whole batches of texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

from playlens.llm.stages import task_memo

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
POSITION_BITS = 18
CHUNK = 1 << POSITION_BITS  # symbols worked on at once: some arrays of 2 MB each

_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (splitmix finaliser)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


#: One scrambled value for each byte.
BYTE_VALUES = mix(np.arange(1, 257, dtype=U64) * U64(BASE))


def _power_table(name: str, base: int, n: int) -> np.ndarray:
    table = _powers.get(name)
    if table is None or len(table) < n:
        steps = np.full(max(n, CHUNK + 1), base, U64)
        steps[0] = 1
        table = _powers[name] = np.multiply.accumulate(steps)
    return table[:n]


def powers(n: int) -> np.ndarray:
    return _power_table("up", BASE, n)


def inverse_powers(n: int) -> np.ndarray:
    return _power_table("down", pow(BASE, -1, 1 << 64), n)


class PrefixHash:
    """Prefix polynomial hashes of a symbol array: the hash of any slice is two look-ups and one product."""

    def __init__(self, symbols: np.ndarray):
        self.n = len(symbols)
        self.sums = np.zeros(self.n + 1, U64)
        np.cumsum(symbols * powers(self.n), out=self.sums[1:])

    def slices(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * inverse_powers(self.n + 1)[start]

    def grams(self, k: int) -> np.ndarray:
        """Scrambled hash of every k consecutive symbols."""
        m = self.n - k + 1
        if m <= 0:
            return np.empty(0, U64)
        return mix((self.sums[k:] - self.sums[:m]) * inverse_powers(m))


def sliding_min(values: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive values, by doubling."""
    span, low = 1, values
    while span * 2 <= w:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    return low if span == w else np.minimum(low[: len(values) - w + 1], low[w - span: w - span + len(values) - w + 1])


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and the offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1]
    flat = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return flat[ends[0]: ends[-1]] if len(ends) else flat[:0], ends - ends[0]


def groups_of_rows(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``most`` units; a larger row stands alone."""
    first, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > first and total + size > most:
            yield first, i
            first, total = i, 0
        total += size
    if len(sizes):
        yield first, len(sizes)


_BLANKS = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")
SLICE_BYTES = 1 << 22  # of a text that are cut into words at once
MEMO = 200_000  # words a task remembers


class _WordHashes(dict):
    """Word -> XXH3 hash of its bytes; forgets all when large. (Polynomials modulo 2**64 collide on patterned words.)"""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_word_hashes = task_memo(_WordHashes())


def words_of(data: bytes) -> Iterator[list[bytes]]:
    """The words (bytes between ASCII white space) of a text, some megabytes at a time."""
    if len(data) <= SLICE_BYTES:
        yield data.split()
        return
    data, at = data.translate(_BLANKS), 0
    while at < len(data):
        end = data.find(b" ", at + SLICE_BYTES)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def word_symbols(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word and the offsets of the rows in words."""
    parts, counts, data = [], [0], flat.tobytes()
    total = 0
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        for words in words_of(data[a:b]):
            parts.append(np.fromiter(map(_word_hashes.__getitem__, words), U64, len(words)))
            total += len(words)
        counts.append(total)
    return np.concatenate(parts) if parts else np.empty(0, U64), np.array(counts)


def byte_symbols(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return flat, offsets


def filled_lines(text: bytes) -> list[bytes]:
    """The lines that hold more than white space, without white space at their ends."""
    return [line for line in map(bytes.strip, text.split(b"\n")) if line]


def line_symbols(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each filled line and the offsets of the rows in lines."""
    hashes, counts, data = [], [0], flat.tobytes()
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        hashes.extend(map(xxhash.xxh3_64_intdigest, filled_lines(data[a:b])))
        counts.append(len(hashes))
    return np.array(hashes, U64), np.array(counts)
