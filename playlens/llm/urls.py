"""URL filters (operator 3): all glob rules run at once over each canonical URL as one bit-parallel automaton.

A glob is literal characters, ``*`` (any characters but ``/``) and ``**`` (any characters), and fits a whole canonical URL.
Each pattern owns one bit per matched literal, packed in as many 64-bit words as the rules need. A step shifts all bits,
masks them by the next character (Shift-And) and keeps those whose wildcard may swallow it. A batch of URLs steps together.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.llm import rolling
from playlens.llm.rolling import U64
from playlens.llm.stages import map_arrow, small_batches, table

#: Site rules: (verdict, host, path). They fit the host and its subdomains, and paths that start with theirs.
SITES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
#: Globs over ``.host/path`` that block what no site rule decides.
BLOCKED = ("**.cheap-**", "**-pills.**", "**.spam-**", "**-farm.**", "**casino**", "**viagra**", "*.xxx/**", "*.xxx", "*.adult.**", "**/wp-login**", "**/login/**", "**/cart/**", "**/checkout/**")


@dataclass(frozen=True)
class Automaton:
    shift: np.ndarray  # (256, words): bits a character may enter
    loop: np.ndarray  # (256, words): bits whose wildcard swallows a character
    start: np.ndarray  # (words,)
    accept: list[tuple[int, int]]  # (word, bit) of each pattern's end

    @classmethod
    def of(cls, globs: Sequence[str]) -> Automaton:
        parsed = [[p for p in re.split(rb"(\*\*|\*)|", g.encode()) if p] for g in globs]
        states = sum(1 + sum(p not in (b"*", b"**") for p in parts) for parts in parsed)
        words = states // 64 + 1
        shift, loop, start, accept = np.zeros((256, words), U64), np.zeros((256, words), U64), np.zeros(words, U64), []
        at = 0
        for parts in parsed:
            start[at >> 6] |= U64(1 << (at & 63))
            for p in parts:
                if p in (b"*", b"**"):
                    swallowed = np.arange(256) != (ord("/") if p == b"*" else -1)
                    loop[swallowed, at >> 6] |= U64(1 << (at & 63))
                else:
                    at += 1
                    shift[p[0], at >> 6] |= U64(1 << (at & 63))
            accept.append((at >> 6, at & 63))
            at += 1
        return cls(shift, loop, start, accept)

    def matches(self, flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(texts, patterns): which patterns fit each whole text. Texts leave the batch as they end."""
        size = np.diff(offsets)
        order = np.argsort(-size, kind="stable")
        begin, size = offsets[:-1][order], size[order]
        state = np.repeat(self.start[None, :], len(order), axis=0)
        live = len(order)
        step = 0
        while live:
            live = int(np.searchsorted(-size[:live], -step, "left"))  # texts longer than `step`
            if not live:
                break
            now, char = state[:live], flat[begin[:live] + step]
            moved = now << U64(1)
            moved[:, 1:] |= now[:, :-1] >> U64(63)
            state[:live] = (moved & self.shift[char]) | (now & self.loop[char])
            step += 1
        out = np.empty((len(order), len(self.accept)), bool)
        for i, (word, bit) in enumerate(self.accept):
            out[order, i] = (state[:, word] >> U64(bit)) & U64(1) > 0
        return out


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host (ASCII lower case) and path of a URL; both empty without ``://`` or for null."""
    rest = F.expr(f"CASE WHEN instr({url}, '://') > 0 THEN substring({url}, instr({url}, '://') + 3) ELSE '' END")
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def judged(pages: DataFrame, id_column: str = "page_id", url: str = "url", sites: Sequence[tuple[str, str, str]] = SITES, blocked: Sequence[str] = BLOCKED) -> DataFrame:
    """One row per page: the id, host, path, rule (host and path of the longest site rule that fits, or null), verdict.

    Without a site rule the verdict is ``block`` if any glob of ``blocked`` fits, else ``allow``; so a null URL is allowed
    unless a glob fits the empty host ``.``. Rows are judged one by one: repeated rows and null ids stay as they are.
    """
    small_batches(pages.sparkSession)
    globs = [f"*.{host}{path}**" for _, host, path in sites] + list(blocked)
    ranked = sorted(range(len(sites)), key=lambda i: -len(sites[i][1] + sites[i][2]))
    names, verdicts = [h + p for _, h, p in sites], [v for v, _, _ in sites]
    host, path = host_and_path(f"`{url}`")
    rows = pages.select(F.col(id_column).cast("long").alias("page_id"), F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton.of(globs)
        for batch in batches:
            flat, offsets = rolling.text_bytes(batch.column("canonical"))
            fits = automaton.matches(flat, offsets)
            best = np.full(len(fits), -1)
            for i in ranked[::-1]:
                best[fits[:, i]] = i
            bad = fits[:, len(sites):].any(axis=1)
            yield table(
                page_id=batch.column("page_id"), host=batch.column("host"), path=batch.column("path"),
                rule=pa.array([names[i] if i >= 0 else None for i in best], pa.string()),
                verdict=pa.array([verdicts[i] if i >= 0 else "block" if b else "allow" for i, b in zip(best, bad)], pa.string()))

    out = map_arrow(rows.withColumn("canonical", F.concat(F.lit("."), "host", "path")), work, "page_id long, host string, path string, rule string, verdict string")
    return out.withColumnRenamed("page_id", id_column)
