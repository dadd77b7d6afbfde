"""Range, ladder, calendar and co-occurrence joins. None of them is a cross join."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from playlens.operators.keyed import top_k
from playlens.session import write_stage

BLOCK_ITEMS = 512  # items of a block of the product
BAND_STEP = 4


def left_fill(left: DataFrame, right: DataFrame, on: list[str], defaults: dict) -> DataFrame:
    """Left join where columns of the right side get a default."""
    joined = left.join(right, on, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def valid_on(facts: DataFrame, dim: DataFrame, on: list[str], day: str, spans: list[tuple[str, str]], how: str = "left") -> DataFrame:
    """Versioned-dimension join: equal keys and the day within every validity span (ends included).

    The equal keys make it a hash or merge join; AQE broadcasts the dimension when its measured size allows.
    """
    f, d = facts.alias("f"), dim.alias("d")
    cond: Column = F.lit(True)
    for key in on:
        cond = cond & (F.col(f"f.{key}") == F.col(f"d.{key}"))
    for start, end in spans:
        cond = cond & (F.col(f"f.{day}") >= F.col(f"d.{start}")) & (F.col(f"f.{day}") <= F.col(f"d.{end}"))
    bounds = {c for span in spans for c in span}
    extra = [F.col(f"d.{c}") for c in dim.columns if c not in on and c not in bounds]
    return f.join(d, cond, how).select("f.*", *extra)


def calendar(dim: DataFrame, start: str | Column, end: str | Column, day: str = "day") -> DataFrame:
    """Every dimension row for every day of the range."""
    as_day = lambda x: F.lit(x).cast("date") if isinstance(x, str) else x
    return dim.withColumn(day, F.explode(F.sequence(as_day(start), as_day(end), F.expr("interval 1 day"))))


def band_expand(df: DataFrame, day: str, width: int, name: str, not_after: str | Column | None = None) -> DataFrame:
    """One row per day from ``day`` to ``width`` days later, so a band join becomes an equi-join."""
    last = F.date_add(F.col(day), width)
    if not_after is not None:
        last = F.least(last, F.lit(not_after).cast("date") if isinstance(not_after, str) else not_after)
    fits = df.filter(last >= F.col(day))
    return fits.withColumn(name, F.explode(F.sequence(F.col(day), last, F.expr("interval 1 day"))))


def ladder_ranges(ladder: DataFrame, keys: list[str], threshold: str, low: str = "low", high: str = "high") -> DataFrame:
    """Half-open ranges of a ladder: each step ends where the next starts, the last has no end (null)."""
    following = F.lead(threshold).over(W.partitionBy(*keys).orderBy(threshold))
    return ladder.withColumn(low, F.col(threshold)).withColumn(high, following)


def range_lookup(facts: DataFrame, ranges: DataFrame, on: list[str], amount: str, low: str, high: str, how: str = "inner") -> DataFrame:
    """Rows with the range that holds their amount: ``low <= amount < high`` at equal keys; a null ``high`` is no bound."""
    f, r = facts.alias("f"), ranges.alias("r")
    cond = (F.col(f"f.{amount}") >= F.col(f"r.{low}")) & (F.col(f"r.{high}").isNull() | (F.col(f"f.{amount}") < F.col(f"r.{high}")))
    for key in on:
        cond = cond & (F.col(f"f.{key}") == F.col(f"r.{key}"))
    extra = [F.col(f"r.{c}") for c in ranges.columns if c not in on and c not in (low, high)]
    return f.join(r, cond, how).select("f.*", *extra)


def ladder_rate(facts: DataFrame, ladder: DataFrame, on: list[str], amount: str, threshold: str, how: str = "left") -> DataFrame:
    """Rows with the step of the highest threshold not above their amount."""
    ranges = ladder_ranges(ladder, on, threshold).drop(threshold)
    return range_lookup(facts, ranges, on, amount, "low", "high", how)


def epoch_ranges(dim: DataFrame, keys: list[str], first: str, changes: list[tuple[str, str]], value: str) -> DataFrame:
    """Columns (change day, value) of a wide row as validity ranges; ``first`` holds before the first change."""
    begin = F.to_date(F.lit("0001-01-01"))
    steps = F.array(
        F.struct(begin.alias("from_day"), F.col(first).alias(value)),
        *[F.struct(F.col(d).alias("from_day"), F.col(v).alias(value)) for d, v in changes],
    )
    steps = F.sort_array(F.filter(steps, lambda s: s["from_day"].isNotNull()))
    following = F.transform(
        steps,
        lambda s, i: F.struct(
            s["from_day"].alias("from_day"),
            F.coalesce(F.get(steps, i + 1)["from_day"], F.to_date(F.lit("9999-12-31"))).alias("to_day"),
            s[value].alias(value),
        ),
    )
    return dim.select(*keys, F.inline(following)).filter(F.col("from_day") < F.col("to_day"))


def hierarchy(members: DataFrame, member: str = "member_id", owner: str = "owner_id", name: str = "username") -> DataFrame:
    """Members with their owner's name; members without owner own themselves."""
    owners = members.select(F.col(member).alias(owner), F.col(name).alias("_owner_name"))
    return members.join(owners, owner, "left").withColumn(
        "owner_name", F.when(F.col(owner) == 0, F.col(name)).otherwise(F.col("_owner_name"))
    ).drop("_owner_name")


def co_usage(df: DataFrame, entity: str, item: str, blocks: int | None = None, chunk: int = 4_096) -> DataFrame:
    """For each ordered pair of items, the number of entities that used both.

    Computed as a blocked product of the entity-by-item incidence matrix with its transpose. Rows are
    sent once per block pair, never pairs of rows, so an entity that used everything costs its row
    count times the number of blocks. A task holds ``chunk`` entities by two blocks of items, and
    emits counts already summed over its entities.
    """
    used = df.select(F.col(entity).alias("e"), F.col(item).alias("i")).distinct()
    sizes = used.agg(F.approx_count_distinct("e").alias("e"), F.approx_count_distinct("i").alias("i")).first()
    blocks = blocks or max(1, math.ceil(sizes["i"] / 512))
    chunks = max(1, math.ceil(sizes["e"] / chunk))
    tagged = used.withColumn("c", F.pmod(F.xxhash64("e"), F.lit(chunks))).withColumn(
        "b", F.pmod(F.xxhash64("i"), F.lit(blocks)).cast("int")
    )
    other = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("o")
    sent = tagged.select("c", "e", "i", "b", other).select(
        "c", "e", "i", "b", F.least("b", "o").alias("lo"), F.greatest("b", "o").alias("hi")
    )
    kind = dict(used.dtypes)["i"]

    def product(pdf: pd.DataFrame) -> pd.DataFrame:
        rows, _ = pd.factorize(pdf["e"])
        cols, items = pd.factorize(pdf["i"])
        lo, hi = pdf["lo"].iat[0], pdf["hi"].iat[0]
        block = pd.Series(pdf["b"].to_numpy()).groupby(cols).first().to_numpy()
        seen = np.zeros((rows.max() + 1, len(items)), dtype=np.float32)
        seen[rows, cols] = 1.0
        left, right = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
        # float32 holds counts exactly up to 2**24, far above the entities of a chunk
        counts = seen[:, left].T @ seen[:, right]
        a, b = np.nonzero(counts)
        out = pd.DataFrame({"item": items[left[a]], "other": items[right[b]], "n": counts[a, b].astype("int64")})
        out = out[out["item"] != out["other"]]
        if lo != hi:  # the mirrored half
            out = pd.concat([out, out.rename(columns={"item": "other", "other": "item"})], ignore_index=True)
        return out[["item", "other", "n"]]

    parts = sent.groupBy("c", "lo", "hi").applyInPandas(product, f"item {kind}, other {kind}, n long")
    return parts.groupBy("item", "other").agg(F.sum("n").alias("n"))


def _products(left: DataFrame, right: DataFrame, blocks: int | None, chunk: int) -> DataFrame:
    """(item, other, n) per chunk of entities: items of ``left`` beside other items of ``right``. Both are distinct (e, i)."""
    sizes = left.unionByName(right).agg(F.approx_count_distinct("e").alias("e"), F.approx_count_distinct("i").alias("i")).first()
    blocks = blocks or max(1, math.ceil(sizes["i"] / BLOCK_ITEMS))
    chunks = max(1, math.ceil(sizes["e"] / chunk))
    part, block = F.pmod(F.xxhash64("e"), F.lit(chunks)).alias("c"), F.pmod(F.xxhash64("i"), F.lit(blocks)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    own = [F.col("e").alias("e"), F.col("i").alias("i")]  # both sides may be one table
    rows = left.select(part, *own, block.alias("l"), every.alias("r"))
    columns = right.select(part, *own, block.alias("r"), every.alias("l"))
    kind = dict(left.dtypes)["i"]

    def product(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        entities = pd.Index(a["e"]).intersection(pd.Index(b["e"])).unique()
        def incidence(rows):
            at = entities.get_indexer(rows["e"])
            cols, items = pd.factorize(rows["i"])
            out = np.zeros((len(entities), len(items)), dtype=np.float32)
            out[at[at >= 0], cols[at >= 0]] = 1.0
            return out, items
        (x, items), (y, others) = incidence(a), incidence(b)
        # float32 holds counts exactly up to 2**24, far above the entities of a chunk
        counts = x.T @ y
        i, j = np.nonzero(counts)
        out = pd.DataFrame({"item": items[i], "other": others[j], "n": counts[i, j].astype("int64")})
        return out[out["item"] != out["other"]]

    by = ["c", "l", "r"]
    return rows.groupBy(*by).cogroup(columns.groupBy(*by)).applyInPandas(product, f"item {kind}, other {kind}, n long")


def co_usage_top(df: DataFrame, entity: str, item: str, k: int, blocks: int | None = None, chunk: int = 4_096, step: int | None = None) -> DataFrame:
    """For each item the ``k`` others most often used by the same entities: item, other, n, rank; ties to the smaller other.

    A pair cannot have more users than the rarer item of the two. So others are tried from the most used down, in bands of
    support that end at a ``step``-th of where they begin (no bands where all items fit one block, unless given). An item that
    already has ``k`` others with more common users than it and the next band allow is done. Exact, and the pairs of
    much used items with the long tail of rare ones are never formed.
    """
    if step is None and df.agg(F.approx_count_distinct(item)).first()[0] <= BLOCK_ITEMS:
        return top_k(co_usage(df, entity, item, blocks, chunk), ["item"], [F.desc("n"), F.asc("other")], k)
    used = write_stage(df.select(F.col(entity).alias("e"), F.col(item).alias("i")).distinct(), "co-usage")
    support = write_stage(used.groupBy("i").agg(F.count(F.lit(1)).alias("s")), "co-usage-support")
    most, items = support.agg(F.max("s"), F.count(F.lit(1))).first()
    if not items:
        return used.select(F.col("i").alias("item"), F.col("i").alias("other"), F.lit(0).cast("long").alias("n"), F.lit(0).alias("rank"))
    step = step or BAND_STEP
    best: DataFrame | None = None
    high = most
    while high:
        low = high // step
        if best is None:
            active = support
        else:
            worst = best.groupBy(F.col("item").alias("i")).agg(F.count(F.lit(1)).alias("have"), F.min("n").alias("worst")).filter(F.col("have") >= k)
            active = support.join(worst, "i", "left").filter(F.col("worst").isNull() | (F.col("worst") <= F.least("s", F.lit(high)))).select("i")
            if active.isEmpty():
                break
        band = support.filter(F.col("s").between(low + 1, high))
        counts = _products(used.join(active, "i", "left_semi"), used.join(band, "i", "left_semi"), blocks, chunk)
        counts = counts.groupBy("item", "other").agg(F.sum("n").alias("n"))
        both = counts if best is None else counts.unionByName(best.drop("rank"))
        best = write_stage(top_k(both, ["item"], [F.desc("n"), F.asc("other")], k), "co-usage-best")
        high = low
    return best
