"""Line dedup (operator 10): runs of lines that stand earlier in the corpus go.

Winnowing: of every ``run`` consecutive line hashes the smallest is a fingerprint, so any shared run of that length shares
one. `repeats` joins the positions of equal fingerprints; each brings the lines it may belong to on both sides, and matches
are extended from the fingerprint both ways. A later occurrence of a run goes whole, runs being judged on the input.

A passage may stand on one line: a line of ``LONG`` or more words is a run by itself. Such lines need no windows; their hashes
(128 bits) are grouped, and only the place of the first goes back to the others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm import repeats, rolling
from playlens.llm.stages import array_column, keyed, map_arrow, original_id, table, with_text

RUN = 3
LONG = 20  # words of a line that is a run by itself
GRAM = 2  # lines of a fingerprint: a line that many documents share has other neighbours in most of them
SHARD_BYTES = 1 << 20


def line_windows(run: int = RUN) -> repeats.Windows:
    return repeats.Windows(width=run, gram=min(GRAM, run), symbols=rolling.line_symbols, units=rolling.filled_lines, joined=b"\n".join, keep_first=True, parts=1)


def extended_in_shard(groups: list[list[tuple]], run: int) -> Iterator[tuple[int, int, int, int]]:
    """Lines of pieces that match an earlier piece of the same fingerprint over ``run`` lines.

    Seen from the fingerprint, a run has some lines on its left and the rest on its right; both extensions together
    decide. Pieces come in corpus order, so what has been seen is earlier.
    """
    for group in groups:
        seen: set[tuple] = set()
        for doc, rid, start, n, ahead, _, content in group:
            lines = content.split(b"\n")
            for i in range(n):
                left, right = tuple(lines[i:ahead]), tuple(lines[ahead: i + run])
                if (left, right) in seen:
                    yield doc, rid, start + i, start + i + run
                else:
                    seen.add((left, right))


def earlier_long_lines(docs: DataFrame, words: int = LONG) -> DataFrame:
    """(doc_key, rid, start, end): filled lines of ``words`` or more words that stand earlier."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, rid, text in zip(batch.column("doc_key").to_pylist(), batch.column("rid").to_pylist(), batch.column("text")):
                for at, line in enumerate(rolling.filled_lines(text.as_buffer().to_pybytes()) if text.is_valid else ()):
                    if len(line) >= 2 * words - 1 and len(line.split()) >= words:
                        out.append((xxhash.xxh3_128_digest(line), doc, rid, at))
            if out:
                yield table(**{c: pa.array(v, k) for c, v, k in zip(("line", "doc_key", "rid", "at"), zip(*out), (pa.binary(), pa.int64(), pa.int64(), pa.int32()))})

    rows = map_arrow(docs, work, "line binary, doc_key long, rid long, at int")
    place = F.struct("doc_key", "rid", "at")
    firsts = rows.groupBy("line").agg(F.min(place).alias("first"), F.max(place).alias("last")).filter(F.col("first") != F.col("last")).select("line", "first")
    return rows.join(firsts, "line").filter(place > F.col("first")).select("doc_key", "rid", F.col("at").alias("start"), (F.col("at") + 1).alias("end")).distinct()


def earlier_lines(docs: DataFrame, run: int = RUN, long_words: int | None = LONG) -> DataFrame:
    """(doc_key, rid, ranges) of the filled lines of keyed documents that earlier runs cover."""
    long_lines = earlier_long_lines(docs, long_words) if long_words else None
    return repeats.repeated_ranges(docs, line_windows(run), lambda groups: extended_in_shard(groups, run), SHARD_BYTES, "lines", long_lines)


def kept_lines(rows: DataFrame, run: int = RUN, long_words: int | None = LONG) -> DataFrame:
    """(doc_key, rid, n_lines, n_removed, new_text) of keyed documents."""
    marked = rows.join(earlier_lines(rows, run, long_words), ["doc_key", "rid"], "left")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, count, removed = [], [], []
            for value, ranges in zip(batch.column("text"), batch.column("ranges").to_pylist()):
                lines = value.as_buffer().to_pybytes().split(b"\n") if value.is_valid else []
                filled = [i for i, line in enumerate(lines) if line.strip()]
                count.append(len(filled))
                gone = set()
                if ranges:
                    gone = {filled[i] for i in repeats.covered(ranges, len(filled)).nonzero()[0]}
                removed.append(len(gone))
                kept.append(b"\n".join(line for i, line in enumerate(lines) if i not in gone) if value.is_valid else None)
            yield table(
                doc_key=array_column(batch, "doc_key"), rid=array_column(batch, "rid"), n_lines=pa.array(count, pa.int64()), n_removed=pa.array(removed, pa.int64()),
                new_text=pa.array(kept, pa.binary()).cast(pa.string()), sha256=pa.array([hashlib.sha256(k or b"").hexdigest() for k in kept], pa.string()),
            )

    return map_arrow(marked, work, "doc_key long, rid long, n_lines long, n_removed long, new_text string, sha256 string")


def strip_lines(docs: DataFrame, id_column: str = "doc_id", text: str = "text", run: int = RUN, long_words: int | None = LONG) -> DataFrame:
    """Documents without the lines that earlier runs of ``run`` lines cover, or of one line with ``long_words`` words (None: no such rule).

    Columns: the id, n_lines (lines with more than white space), n_removed, kept (text left), kept_sha256.
    Lines are compared without white space at their ends; blank lines neither match nor count nor go. A null text has
    no lines and stays null (its digest is that of an empty text). Order is (id, line), a null id before all others;
    rows that share an id are ordered by a hash of their text, and rows equal in both are one document.
    """
    out = kept_lines(keyed(docs, id_column, text), run, long_words).withColumnRenamed("new_text", "kept").withColumnRenamed("sha256", "kept_sha256")
    return out.select(original_id().alias(id_column), "n_lines", "n_removed", "kept", "kept_sha256")


def without_runs(docs: DataFrame, id_column: str = "doc_id", text: str = "text", run: int = RUN, long_words: int | None = LONG) -> DataFrame:
    """The rows of ``docs``, all columns, with the lines left; documents of which every filled line went are dropped.

    A column ``n_chars`` is counted anew.
    """
    left = kept_lines(keyed(docs, id_column, text), run, long_words).filter((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines"))).select("doc_key", "rid", "new_text")
    out = with_text(docs, left, id_column, text)
    return out.withColumn("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
