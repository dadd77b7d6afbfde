"""Benchmark decontamination (operator 5): documents that hold a benchmark text go, re-parameterised or not.

Texts become template tokens: numbers, names and units are replaced by typed placeholders whose values are the slots. Beside the
templates stand the plain lower-case tokens, so that copies in other capitals, whose names are no names, are found too.
Windows of template tokens meet in a hash join; hits on one alignment of document and benchmark text form runs, and within
a run the longest part counts whose slots are consistent: one benchmark value always stands for one document value of its
type, and back.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm.rolling import U64, PrefixHash, groups_of_rows, mix
from playlens.llm.stages import array_column, hash_bitmap, in_bitmap, keyed, map_arrow, original_id, table, task_memo, without

WINDOW = 8  # template tokens that meet in the join
RUN = 13  # template tokens in a row that count as a leak, or a whole shorter benchmark text
LITERALS = 6  # of them at least, that are not placeholders

TOKEN = re.compile(r"[^\W\d_]+|\d+(?:[.,:/]\d+)*|[.!?\n]")
#: Unit words that count as units after a number.
UNITS = frozenset("""
mm cm m km in ft yd mi mg g kg lb lbs oz ml l s sec min h hr hrs day days week weeks month months year years second seconds minute minutes hour hours
meter meters metre metres kilometer kilometers mile miles foot feet inch inches gram grams kilogram kilograms pound pounds liter liters litre litres
dollar dollars cent cents euro euros percent degree degrees kmh mph hz khz mhz w kw v a j n pa
""".split())
# kinds of tokens, in the lowest bits of a token's code
PLAIN, TITLE, NUMBER, UNIT, STOP, KINDS = 0, 1, 2, 3, 4, 7
NAME_SLOT, NUMBER_SLOT, UNIT_SLOT = (U64(xxhash.xxh3_64_intdigest(x) & ~KINDS) for x in (b"<name>", b"<number>", b"<unit>"))
MEMO = 100_000  # tokens a task remembers
TOGETHER = 1 << 18  # characters of texts that are worked on at once; a longer text stands alone


class _Codes(dict):
    """Token -> hash of its lower-case form with its kind; forgets all when large."""

    def __missing__(self, token: str) -> int:
        if len(self) >= MEMO:
            self.clear()
        low = token.lower()
        if token in ".!?\n":
            kind = STOP
        elif token[0].isdigit():
            kind = NUMBER
        elif low in UNITS:
            kind = UNIT
        else:
            kind = TITLE if len(token) > 1 and token.istitle() else PLAIN
        code = self[token] = (xxhash.xxh3_64_intdigest(low) & ~KINDS) | kind
        return code


_codes = task_memo(_Codes())


def templates(texts: list[str]) -> tuple[list[tuple[np.ndarray, np.ndarray]], list[str], np.ndarray]:
    """Three views (symbols, slot kinds) of texts one after the other, their tokens, and the text of each token.

    Slot kind 0 is for literal tokens, else 1 name, 2 number, 3 unit. In the first view a capital at the start of a sentence
    says nothing, in the second it makes a slot too: a name if the token is a name inside the same text as well, else kind 4,
    which stands for its own value only. The third has no slots.
    """
    tokens, ends = [], [0]
    for text in texts:
        tokens += TOKEN.findall(text)
        ends.append(len(tokens))
    codes = np.fromiter(map(_codes.__getitem__, tokens), U64, len(tokens))
    kind = codes & U64(KINDS)
    word = np.flatnonzero(kind != STOP)
    before = np.full(len(tokens) + 1, STOP, U64)
    before[1:] = kind
    before[ends] = STOP  # each text starts a sentence
    owner = np.repeat(np.arange(len(texts)), np.diff(ends))[word]
    kind, before, symbols = kind[word], before[word], codes[word] & ~U64(KINDS)
    values = symbols.copy()
    slots = np.zeros(len(word), np.int8)
    slots[(kind == TITLE) & (before != STOP)] = 1
    slots[kind == NUMBER] = 2
    slots[(kind == UNIT) & (before == NUMBER)] = 3
    for slot, value in ((1, NAME_SLOT), (2, NUMBER_SLOT), (3, UNIT_SLOT)):
        symbols[slots == slot] = value
    first = np.flatnonzero((kind == TITLE) & (before == STOP))
    symbols_too, slots_too = symbols.copy(), slots.copy()
    symbols_too[first] = NAME_SLOT
    own = values + mix(owner.astype(U64))  # a value of one text
    slots_too[first] = np.where(np.isin(own[first], own[slots == 1]), 1, 4)
    return [(symbols, slots), (symbols_too, slots_too), (values, np.zeros(len(word), np.int8))], [tokens[i] for i in word.tolist()], owner


def template(text: str) -> tuple[list[tuple[np.ndarray, np.ndarray]], list[str]]:
    """The views of one text, and its tokens."""
    return templates([text])[:2]


def _wanted(views: list[tuple[np.ndarray, np.ndarray]], hashed: list[PrefixHash], n: int, fit: np.ndarray, bits: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(starts, hashes, slots) of each view's windows of ``n`` tokens among the starts ``fit``."""
    first = None
    for (_, slots), prefix in zip(views, hashed):
        hashes, at = prefix.grams(n) + U64(n), fit
        if first is not None:  # windows without such tokens are the same in all views
            at = at[hashes[at] != first[at]]
        else:
            first = hashes
        if bits is not None:
            at = at[in_bitmap(hashes[at], bits)]
        if slots.any():  # windows of placeholders alone say nothing, their values do (third view)
            filled = np.cumsum(np.append(0, slots != 0))
            at = at[filled[at + n] - filled[at] < n]
        yield at, hashes[at], slots


def _values(slots: np.ndarray, tokens: list[str], at: int, n: int) -> str:
    """The slots of a window as ``offset:kind:value`` parts."""
    held = np.flatnonzero(slots[at: at + n])
    return "\x1f".join(f"{i}:{slots[at + i]}:{tokens[at + i].lower()}" for i in held.tolist())


def _window_rows(docs: DataFrame, key: list[str], text: str, window: int, sizes: tuple[int, ...] = (), bitmap=None) -> DataFrame:
    """(key…, pos, length, hash, slots) of the template windows; only those in the bitmap if one is given.

    ``sizes``: lengths of short benchmark texts, which are looked for with windows of their own length.
    """
    schema = ", ".join(f"{k} long" for k in key) + ", pos int, length int, hash long, slots string"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bitmap.value if bitmap is not None else None
        for batch in batches:
            keys = [array_column(batch, k) for k in key]
            texts = [value or "" for value in batch.column(text).to_pylist()]
            out: list[tuple] = []
            for low, high in groups_of_rows(np.fromiter(map(len, texts), np.int64, len(texts)), TOGETHER):
                views, tokens, owner = templates(texts[low:high])
                lengths = np.bincount(owner, minlength=high - low)
                starts = np.cumsum(lengths) - lengths
                hashed = [PrefixHash(symbols) for symbols, _ in views]
                shorter = set(lengths[lengths < window].tolist()) if bits is None else set()
                for n in {window, *sizes, *shorter} - {0}:
                    fit = np.flatnonzero(owner[: max(len(owner) - n + 1, 0)] == owner[n - 1:])  # a window lies in one text
                    if n != window and n not in sizes:  # a shorter benchmark text is one window of its own length
                        fit = fit[lengths[owner[fit]] == n]
                    for found, hashes, slots in _wanted(views, hashed, n, fit, bits):
                        for at, hash_ in zip(found.tolist(), hashes.view(np.int64).tolist()):
                            i = owner[at]
                            out.append((*(k[low + i] for k in keys), at - starts[i], lengths[i], hash_, _values(slots, tokens, at, n)))
            if out:
                cols = list(zip(*out))
                kinds = [pa.int64()] * len(key) + [pa.int32(), pa.int32(), pa.int64(), pa.string()]
                yield table(**{c.split()[0]: pa.array(v, k) for c, v, k in zip(schema.split(", "), cols, kinds)})

    return map_arrow(docs, work, schema)


def _slots(held: str, at: int) -> Iterator[tuple[int, str, str]]:
    """(position, kind, value) of the slots of a window that starts at ``at``."""
    for part in held.split("\x1f") if held else ():
        i, kind, value = part.split(":", 2)
        yield at + int(i), kind, value


def consistent(pairs: dict[int, tuple[str, str, str]], begin: int, end: int) -> Iterator[tuple[int, int]]:
    """The longest ranges of ``begin`` to ``end`` whose slots map one to one; ``pairs``: position -> (kind, document's value, benchmark's)."""
    there: dict[tuple, list] = {}  # value -> [value it stands for, times in the range]
    back: dict[tuple, list] = {}
    order = sorted(pairs)
    low, oldest = begin, 0

    def fits(kind: str, d: str, b: str) -> bool:
        return there.get((kind, b), (d,))[0] == d and back.get((kind, d), (b,))[0] == b

    for i, at in enumerate(order):
        kind, d, b = pairs[at]
        own, kind = kind == "4", "1" if kind == "4" else kind
        if own and d != b or not fits(kind, d, b):
            yield low, at
            while oldest < i and (own and d != b or not fits(kind, d, b)):
                k, x, y = pairs[order[oldest]]
                k = "1" if k == "4" else k
                for held, key in ((there, (k, y)), (back, (k, x))):
                    held[key][1] -= 1
                    if not held[key][1]:
                        del held[key]
                low = order[oldest] + 1
                oldest += 1
            if own and d != b:
                low, oldest = at + 1, i + 1
                continue
        there.setdefault((kind, b), [d, 0])[1] += 1
        back.setdefault((kind, d), [b, 0])[1] += 1
    yield low, end


def _leak(hits: list[tuple[int, str, str]], length: int, window: int, run: int, literals: int) -> int:
    """Tokens of the longest consistent part of a run of hits (benchmark position, slots, benchmark slots) on one alignment, or 0.

    A slot whose value is that of the benchmark text counts as a literal, so an exact copy always has enough of them.
    """
    best, first = 0, 0
    hits = sorted(set(hits))
    window = min(window, length)
    for i in range(1, len(hits) + 1):
        if i < len(hits) and hits[i][0] <= hits[i - 1][0] + window:  # windows that touch leave no token between them
            continue
        part = hits[first:i]
        first = i
        begin, end = part[0][0], part[-1][0] + window
        if end - begin < min(run, length):
            continue
        pairs = {p: (kind, d, b) for at, doc, item in part for (p, _, d), (_, kind, b) in zip(_slots(doc, at), _slots(item, at))}
        for low, high in consistent(pairs, begin, end):
            size = high - low
            changed = sum(d != b for p, (_, d, b) in pairs.items() if low <= p < high)
            if size >= min(run, length) and size - changed >= min(literals, length):
                best = max(best, size)
    return best


def leaks(rows: DataFrame, benchmark: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW, run: int = RUN, literals: int = LITERALS) -> DataFrame:
    """(doc_key, rid, item_key, n_tokens): keyed documents with the benchmark texts they hold, at most one row a pair."""
    items = keyed(benchmark, item_id, text).groupBy("text").agg(F.min("doc_key").alias("item_key"))  # equal texts are one
    asked = _window_rows(items, ["item_key"], "text", window)
    short = [r[0] for r in asked.filter(F.col("length") < window).select("length").distinct().collect()]  # fewer than `window` values
    bitmap = hash_bitmap(asked, "hash")
    hits = _window_rows(rows, ["doc_key", "rid"], "text", window, tuple(short), bitmap)
    b = asked.select("hash", "item_key", F.col("pos").alias("item_pos"), F.col("length").alias("item_length"), F.col("slots").alias("item_slots"))
    aligned = hits.join(b, "hash").groupBy("doc_key", "rid", "item_key", "item_length", (F.col("pos") - F.col("item_pos")).alias("shift")).agg(
        F.collect_set(F.struct("item_pos", "slots", "item_slots")).alias("hits"))  # no more than the benchmark text has windows

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [
                _leak([(h["item_pos"], h["slots"], h["item_slots"]) for h in found], length, window, run, literals)
                for found, length in zip(batch.column("hits").to_pylist(), batch.column("item_length").to_pylist())
            ]
            yield table(doc_key=batch.column("doc_key"), rid=batch.column("rid"), item_key=batch.column("item_key"), n_tokens=pa.array(sizes, pa.int64()))

    found = map_arrow(aligned, work, "doc_key long, rid long, item_key long, n_tokens long")
    return found.filter("n_tokens > 0").groupBy("doc_key", "rid", "item_key").agg(F.max("n_tokens").alias("n_tokens"))


def judged(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", **settings) -> DataFrame:
    """One row per document: the id, n_items (benchmark texts it holds), item_id (the longest, then smallest), n_tokens, kept.

    A null text holds nothing; an empty benchmark leaves all. Benchmark texts without a token are never found, a null item
    id stays null in the report.
    """
    rows = keyed(docs, id_column, text)
    best = leaks(rows, benchmark, item_id, item_text, **settings).groupBy("doc_key", "rid").agg(
        F.count(F.lit(1)).alias("n_items"), F.min(F.struct((-F.col("n_tokens")).alias("less"), "item_key")).alias("best"))
    out = rows.select("doc_key", "rid").join(best, ["doc_key", "rid"], "left")
    return out.select(
        original_id().alias(id_column), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), original_id("best.item_key").alias("item_id"),
        F.coalesce(-F.col("best.less"), F.lit(0)).cast("long").alias("n_tokens"), F.col("best").isNull().alias("kept"))


def clean(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no benchmark text."""
    held = leaks(keyed(docs, id_column, text), benchmark, **settings).select("doc_key", "rid").distinct()
    return without(docs, held, id_column, text)
