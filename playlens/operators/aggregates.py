"""Aggregation shapes shared by the reports. All combine before the shuffle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_distinct(df: DataFrame, keys: list[str], columns: list[str], name: str, approximate: bool = False) -> DataFrame:
    """Distinct values, or distinct combinations when several columns are named (rows with a null are not counted)."""
    whole = F.lit(True)
    for c in columns:
        whole = whole & F.col(c).isNotNull()
    value = F.struct(*columns) if len(columns) > 1 else F.col(columns[0])
    if approximate:
        return df.groupBy(*keys).agg(F.approx_count_distinct(F.when(whole, value)).alias(name))
    distinct = df.select(*keys, *columns, whole.alias("_whole")).distinct()
    return distinct.groupBy(*keys).agg(F.count(F.when(F.col("_whole"), 1)).alias(name))


def pivot_offsets(df: DataFrame, keys: list[str], offset: str, offsets: list[int], measure: Column, name: str) -> DataFrame:
    """One column per offset: ``name`` has a ``{}`` for the offset."""
    columns = [F.sum(F.when(F.col(offset) == n, measure).otherwise(0)).cast("long").alias(name.format(n)) for n in offsets]
    return df.groupBy(*keys).agg(*columns)


def zero_filled_union(parts: list[DataFrame], keys: list[str], measures: list[str]) -> DataFrame:
    """Partial results with different measures as one table: sums, zero where a part says nothing."""
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return whole.groupBy(*keys).agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures])


def bucket_label(value: Column, edges: list[int], labels: list[str]) -> Column:
    """Label of the bucket that holds ``value``: label ``i`` is for edge ``i`` <= value < edge ``i+1``."""
    out = None
    for low, label in reversed(list(zip(edges, labels))):
        out = F.when(value >= low, label) if out is None else out.when(value >= low, label)
    return out


def histogram(entities: DataFrame, keys: list[str], value: str, edges: list[int], names: list[str], weight: Column | None = None) -> DataFrame:
    """One column per bucket with the number of entities in it. The last bucket is open."""
    highs = [*edges[1:], None]
    one = F.lit(1) if weight is None else weight
    columns = []
    for low, high, name in zip(edges, highs, names):
        inside = F.col(value) >= low if low is not None else F.lit(True)
        if high is not None:
            inside = inside & (F.col(value) < high)
        columns.append(F.sum(F.when(inside, one).otherwise(0)).cast("long").alias(name))
    return entities.groupBy(*keys).agg(*columns)


def set_text(df: DataFrame, keys: list[str], column: str, name: str, separator: str = "|") -> DataFrame:
    """The distinct values of a group as one sorted text."""
    return df.groupBy(*keys).agg(F.array_join(F.sort_array(F.collect_set(F.col(column).cast("string"))), separator).alias(name))


def ladder_text(steps: DataFrame, keys: list[str], threshold: str, rate: str, name: str) -> DataFrame:
    """The steps of each ladder in order of their threshold as one text, ``threshold=rate|…``, whatever the partitioning.

    A ladder has as many steps as its contract, so a group is small.
    """
    step = F.concat_ws("=", F.col(threshold).cast("string"), F.col(rate).cast("string"))
    ordered = steps.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(F.col(threshold), step.alias("s")))).alias("_s"))
    return ordered.select(*keys, F.array_join(F.col("_s.s"), "|").alias(name))


def roll_up(df: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """A coarser grain of an already aggregated table."""
    return df.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])


def subtract(total: DataFrame, part: DataFrame, keys: list[str], measures: list[str], floor: bool = False) -> DataFrame:
    """``total - part`` per key; keys that the part lacks count as zero."""
    p = part.select(*keys, *[F.col(m).alias(f"_{m}") for m in measures])
    joined = total.join(p, keys, "left")
    def rest(m):
        diff = F.coalesce(F.col(m), F.lit(0)) - F.coalesce(F.col(f"_{m}"), F.lit(0))
        return F.greatest(diff, F.lit(0)) if floor else diff
    return joined.select(*keys, *[rest(m).alias(m) for m in measures])
