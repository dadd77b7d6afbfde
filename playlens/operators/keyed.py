"""Per-key building blocks that stay flat when one key holds much of the data.

First/last rows are aggregates (combined before the shuffle). Ranking, as-of lookups and one-to-one
matching cut each key into time slices, so no task ever holds a whole key: slice summaries, of which
a key has only as many as there are slices, carry the state from one slice to the next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def first_row(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of least ``order`` per key. ``order`` must tell all rows of a key apart."""
    return _edge_row(df, keys, order, F.min_by)


def last_row(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return _edge_row(df, keys, order, F.max_by)


def _edge_row(df, keys, order, pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    row = pick(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, "_row.*").select(*df.columns)


def first_day_rows(df: DataFrame, keys: list[str], day: str) -> DataFrame:
    """All rows of each key's first day."""
    first = df.groupBy(*keys).agg(F.min(day).alias("_first"))
    return df.join(first, keys).filter(F.col(day) == F.col("_first")).drop("_first")


def top_k(df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """``k`` first rows per key; each map task keeps at most ``k`` rows per key before the shuffle."""
    return df.withColumn(rank, F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter(F.col(rank) <= k)


def running_total(df: DataFrame, keys: list[str], day: str, measures: list[str], prefix: str = "total_") -> DataFrame:
    """Running sums over days; rows are first summed per day, so a key has one row per day."""
    daily = df.groupBy(*keys, day).agg(*[F.sum(m).alias(m) for m in measures])
    w = W.partitionBy(*keys).orderBy(day)
    return daily.select("*", *[F.sum(m).over(w).alias(prefix + m) for m in measures])


def with_group_total(df: DataFrame, keys: list[str], measure: str, name: str) -> DataFrame:
    """The group's sum beside each row: aggregate and join back, as a window would buffer the group."""
    totals = df.groupBy(*keys).agg(F.sum(measure).alias(name))
    return df.join(totals, keys)


def sliced_row_number(df: DataFrame, keys: list[str], ts: str, tie: list[str], name: str, unit: str = "minute") -> DataFrame:
    """``row_number`` per key by ``ts, tie`` without sorting a whole key in one task. Keys not null."""
    cut = [*keys, "_slice"]
    local = df.withColumn("_slice", F.date_trunc(unit, F.col(ts)))
    local = local.withColumn("_n", F.row_number().over(W.partitionBy(*cut).orderBy(ts, *tie)))
    before = W.partitionBy(*keys).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    # on the partitioning of the local ranks, so the sizes need no shuffle of rows
    offsets = local.groupBy(*cut).agg(F.max("_n").alias("_size")).select(
        *cut, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    return local.join(offsets, cut).withColumn(name, (F.col("_n") + F.col("_before")).cast("long")).drop("_slice", "_n", "_before")


def asof_latest(left: DataFrame, right: DataFrame, keys: list[str], left_ts: str, right_ts: str,
                payload: list[str], tie: list[str], unit: str = "hour") -> DataFrame:
    """Each left row with ``payload`` of the latest right row not after it (inner). Keys not null.

    ``tie`` orders right rows of one time. No row pairs are formed: both sides are read once in time
    order per key and slice; the last right row of earlier slices is carried over.
    """
    left_cols = [c for c in left.columns if c not in keys]
    tag = F.struct(F.col(right_ts).alias("_rt"), *payload)
    l = left.select(*keys, F.col(left_ts).alias("_ts"), F.lit(1).alias("_kind"), F.struct(*left_cols).alias("_l"))
    r = right.select(*keys, F.col(right_ts).alias("_ts"), F.lit(0).alias("_kind"), tag.alias("_r"),
                     F.struct(*tie).alias("_tie"))
    both = l.unionByName(r, allowMissingColumns=True).withColumn("_slice", F.date_trunc(unit, "_ts"))
    upto = W.partitionBy(*keys, "_slice").orderBy("_ts", "_kind", "_tie").rowsBetween(W.unboundedPreceding, 0)
    near = both.withColumn("_near", F.last("_r", ignorenulls=True).over(upto)).filter("_kind = 1")
    # the carried summaries: one row per key and slice
    ends = both.groupBy(*keys, "_slice").agg(
        F.max_by("_r", F.when(F.col("_kind") == 0, F.struct("_ts", "_tie"))).alias("_end")
    )
    before = W.partitionBy(*keys).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    carried = ends.select(*keys, "_slice", F.last("_end", ignorenulls=True).over(before).alias("_carry"))
    found = near.join(carried, [*keys, "_slice"]).withColumn("_hit", F.coalesce("_near", "_carry"))
    return found.filter(F.col("_hit").isNotNull()).select(
        *keys, "_l.*", F.col("_hit._rt").alias(right_ts), *[F.col(f"_hit.{p}").alias(p) for p in payload]
    )


def match_once(takers: DataFrame, givers: DataFrame, keys: list[str], taker: tuple[str, str], giver: tuple[str, str],
               days: int, unit: str = "minute") -> DataFrame:
    """One-to-one matching: takers, in order of time, each take the latest free giver.

    A giver can be taken from its own day until ``days`` days later, and only once; of one day all
    givers count as earlier than the takers. ``taker`` and ``giver`` name (time, id) columns; keys not null.
    Returns (taker id, giver id).

    Givers are a stack per key: each taker pops the latest. So with +1 per giver and -1 per taker, the
    running sum above its lowest point so far is the height of the stack, and a taker's partner is the
    latest giver put at that height. An expired giver may be popped for nothing, since all below it are
    older still. Sums per slice carry the running sum from slice to slice; no pairs are formed; and a
    (key, height) has at most one giver and one taker per day.
    """
    g = givers.select(*keys, F.col(giver[0]).alias("_ts"), F.col(giver[1]).alias("_id"), F.lit(0).alias("_kind"))
    t = takers.select(*keys, F.col(taker[0]).alias("_ts"), F.col(taker[1]).alias("_id"), F.lit(1).alias("_kind"))
    cut = [*keys, "_day", "_kind", "_slice"]
    both = g.unionByName(t).withColumn("_day", F.to_date("_ts")).withColumn("_slice", F.date_trunc(unit, "_ts"))
    both = both.dropna(subset=cut)  # stated here, so that both uses below share one shuffle
    local = both.withColumn("_n", F.row_number().over(W.partitionBy(*cut).orderBy("_ts", "_id")))
    sizes = local.groupBy(*cut).agg(F.max("_n").alias("_size"))
    by_time = W.partitionBy(*keys).orderBy("_day", "_kind", "_slice")
    earlier = by_time.rowsBetween(W.unboundedPreceding, -1)
    sums = sizes.withColumn("_end", F.sum(F.when(F.col("_kind") == 0, F.col("_size")).otherwise(-F.col("_size"))).over(by_time))
    state = sums.select(
        *cut, F.coalesce(F.lag("_end").over(by_time), F.lit(0)).alias("_sum"),
        F.least(F.lit(0), F.coalesce(F.min("_end").over(earlier), F.lit(0))).alias("_low"),
        F.sum("_kind").over(W.partitionBy(*keys)).alias("_takers"), F.sum(1 - F.col("_kind")).over(W.partitionBy(*keys)).alias("_givers"),
    ).filter("_takers > 0 and _givers > 0")  # a key needs both sides
    above = F.col("_sum") - F.col("_low")
    height = F.when(F.col("_kind") == 0, above + F.col("_n")).otherwise(above - F.col("_n") + 1)
    placed = local.join(state, cut).withColumn("_height", height).filter("_height > 0")
    order = W.partitionBy(*keys, "_height").orderBy("_day", "_kind")
    previous = F.lag(F.struct("_kind", "_id", "_day")).over(order)
    paired = placed.withColumn("_prev", previous).filter("_kind = 1 and _prev._kind = 0")
    return paired.filter(F.datediff("_day", "_prev._day") <= days).select(
        F.col("_id").alias(taker[1]), F.col("_prev._id").alias(giver[1])
    )
