"""Day bounds of reports, and the index of first times that spares them reading all history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.sinks import state
from playlens.sinks.deltas import BATCH


def between_days(df: DataFrame, day: str, start: str | None = None, end: str | None = None, reach: int = 0) -> DataFrame:
    """Rows of the days from ``start`` to ``reach`` days after ``end``, both included; None is no bound.

    The bare column is compared with constants, so the filter reaches the scan and prunes day partitions.
    """
    if start is not None:
        df = df.filter(F.col(day) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.filter(F.col(day) <= F.date_add(F.lit(end).cast("date"), reach))
    return df


def update_firsts(rows: DataFrame, path: str, load_id: int, keys: list[str], order: list[str], payload: list[str] = ()) -> None:
    """Take a load of rows (a day's, say) into the index of each key's first row by ``order``, a time first.

    A load reads its rows and the hash buckets of its keys. What it found goes to a log by day of the first time: a key's
    new first row (+1), and the one it replaces (-1) when an earlier row comes later. A repeated load replaces itself.
    """
    moved = state.advance(rows, f"{path}/state", load_id, keys, F.struct(*order, *payload), "min", state.bucket(keys))
    signed = F.array(F.struct(F.lit(1).alias("sign"), F.col("new").alias("row")), F.struct(F.lit(-1).alias("sign"), F.col("old").alias("row")))
    log = moved.select(*keys, F.inline(signed)).filter("row IS NOT NULL").select(*keys, "row.*", "sign", F.to_date(f"row.{order[0]}").alias("first_day"))
    state.write_parts(log, f"{path}/log", load_id, "first_day")


def firsts_between(spark: SparkSession, path: str, schema: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Keys whose first row lies in the days, with that row: only the log of these days is read.

    ``schema`` names keys, order and payload as the loads had them; the result has them and ``first_day``.
    """
    wanted = lambda day: (start is None or day >= start) and (end is None or day <= end)
    log = state.read_parts(spark, f"{path}/log", f"{schema}, sign int, first_day date, {BATCH} long", "first_day", wanted)
    columns = [c for c in log.columns if c not in ("sign", BATCH)]
    return log.groupBy(*columns).agg(F.sum("sign").alias("_n")).filter("_n > 0").drop("_n")
