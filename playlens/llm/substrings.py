"""Substring dedup (operator 1): words of a passage that stands earlier in the corpus go.

The method streams documents through suffix automata of reference shards. Here the references are the corpus itself, which
no broadcast may hold, so shards are dealt out by content: `repeats` routes a passage and every earlier passage it could
equal to one shard, and drops what no other document shares. In a shard, pieces come in corpus order; each is streamed
through the automaton of its predecessors for matching statistics, and spans with matches of the threshold length are removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame

from playlens.llm import repeats, rolling
from playlens.llm.stages import array_column, keyed, map_arrow, original_id, table

WIDTH = 20
GRAM = 6
SHARD_BYTES = 1 << 20


def word_windows(width: int = WIDTH, gram: int | None = None) -> repeats.Windows:
    gram = gram or max(1, min(GRAM, width // 2))
    return repeats.Windows(width=width, gram=gram, symbols=rolling.word_symbols, units=bytes.split, joined=b" ".join, keep_first=True, parts=3)


class SuffixAutomaton:
    """All substrings of the sequences added so far."""

    def __init__(self):
        self.step: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]

    def _state(self, length: int, step: dict, link: int) -> int:
        self.length.append(length)
        self.step.append(step)
        self.link.append(link)
        return len(self.length) - 1

    def _split(self, p: int, q: int, symbol) -> int:
        """A copy of state ``q`` for its substrings that are no longer than those of ``p`` and the symbol."""
        copy = self._state(self.length[p] + 1, dict(self.step[q]), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.step[p].get(symbol) == q:
            self.step[p][symbol] = copy
            p = self.link[p]
        return copy

    def add(self, symbols: Sequence) -> None:
        last = 0
        for symbol in symbols:
            q = self.step[last].get(symbol)
            if q is not None:
                last = q if self.length[q] == self.length[last] + 1 else self._split(last, q, symbol)
                continue
            state, p = self._state(self.length[last] + 1, {}, 0), last
            while p >= 0 and symbol not in self.step[p]:
                self.step[p][symbol] = state
                p = self.link[p]
            if p >= 0:
                q = self.step[p][symbol]
                self.link[state] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, symbol)
            last = state

    def matching(self, symbols: Sequence) -> Iterator[int]:
        """For each position, the length of the longest substring ending there that was added."""
        state = size = 0
        for symbol in symbols:
            while state and symbol not in self.step[state]:
                state = self.link[state]
                size = self.length[state]
            if symbol in self.step[state]:
                state, size = self.step[state][symbol], size + 1
            yield size


def earlier_in_shard(groups: list[list[tuple]], width: int) -> Iterator[tuple[int, int, int, int]]:
    """Spans of pieces that an earlier piece of the same key holds; pieces come in corpus order."""
    for group in groups:
        known = SuffixAutomaton()
        for i, (doc, rid, start, _, _, _, content) in enumerate(group):
            words = content.split()
            if i:
                begin = end = -1
                for at, size in enumerate(known.matching(words), 1):
                    if size >= width:
                        if end < 0 or at - width > end:
                            if end >= 0:
                                yield doc, rid, start + begin, start + end
                            begin = at - width
                        end = at
                if end >= 0:
                    yield doc, rid, start + begin, start + end
            if i + 1 < len(group):
                known.add(words)


def earlier_words(docs: DataFrame, width: int = WIDTH, gram: int | None = None) -> DataFrame:
    """(doc_key, rid, ranges) of the words of keyed documents that earlier ``width``-word sequences cover."""
    return repeats.repeated_ranges(docs, word_windows(width, gram), lambda groups: earlier_in_shard(groups, width), SHARD_BYTES, "words")


def strip_substrings(docs: DataFrame, id_column: str = "doc_id", text: str = "text", width: int = WIDTH, gram: int | None = None) -> DataFrame:
    """Documents without the words that earlier passages cover.

    Columns: the id, n_words, n_removed, kept (remaining words joined by one space), kept_sha256. Words are what stands
    between ASCII white space. Order is (id, start), a null id before all others; rows that share an id are ordered
    by a hash of their text, and rows equal in id and text are one document. A null text has no words.
    """
    rows = keyed(docs, id_column, text)
    marked = rows.join(earlier_words(rows, width, gram), ["doc_key", "rid"], "left")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, count, removed = [], [], []
            for value, ranges in zip(batch.column("text"), batch.column("ranges").to_pylist()):
                words = value.as_buffer().to_pybytes().split() if value.is_valid else []
                count.append(len(words))
                if ranges:
                    gone = repeats.covered(ranges, len(words)).tolist()
                    words = [w for w, g in zip(words, gone) if not g]
                removed.append(count[-1] - len(words))
                kept.append(b" ".join(words))
            yield table(
                doc_key=array_column(batch, "doc_key"), n_words=pa.array(count, pa.int64()), n_removed=pa.array(removed, pa.int64()),
                kept=pa.array(kept, pa.binary()).cast(pa.string()), kept_sha256=pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
            )

    out = map_arrow(marked, work, "doc_key long, n_words long, n_removed long, kept string, kept_sha256 string")
    return out.select(original_id().alias(id_column), "n_words", "n_removed", "kept", "kept_sha256")
