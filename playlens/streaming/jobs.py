"""Streaming jobs: the batch operators on micro-batches. What they remember are tables (``sinks/state.py``)."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from playlens.operators.attribution import CHAINS, CLICK_DAYS, days_needed, device_name, first_changed_day, rematch
from playlens.session import write_stage
from playlens.sinks import state
from playlens.sinks.deltas import BATCH, _latest_base, read_deltas, write_delta
from playlens.sources.logs import parse_tagged

# --- fixed values: how long a repeated record is recognised --------------------------------------
ORDER_TTL, ATTRIBUTED_ORDER_TTL, LOGIN_TTL = "1 hour", "48 hours", "50 hours"
# --------------------------------------------------------------------------------------------------


def start(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Run ``each`` on every micro-batch; without ``every``, take what is there and stop."""
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def write_stream(stream: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append rows to a parquet folder, each exactly once (the sink keeps its own log of batches)."""
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def demultiplex(path: str, tags: list[str]) -> Callable[[DataFrame, int], None]:
    """Batch job: lines of many tags into one table per tag, malformed lines into another."""
    def each(lines: DataFrame, batch_id: int) -> None:
        lines.persist()  # read once for all tags
        for tag in tags:
            parsed = parse_tagged(lines, tag)
            write_delta(parsed.filter("is_valid").drop("line", "is_valid"), f"{path}/{tag}", batch_id)
            write_delta(parsed.filter("not is_valid").select("line"), f"{path}/{tag}_malformed", batch_id)
        lines.unpersist()
    return each


def dedup_within(stream: DataFrame, keys: list[str], ts: str, ttl: str) -> DataFrame:
    """First record of each key; repeats are known for ``ttl`` of event time, then the state is freed."""
    return stream.withWatermark(ts, ttl).dropDuplicatesWithinWatermark(keys)


def distinct_counts(path: str, keys: list[str], member: list[str], day: str, name: str) -> Callable[[DataFrame, int], None]:
    """Batch job: distinct ``member`` per ``keys`` (``day`` among them), whenever a row arrives; the counts of batches add up.

    What was seen is a table by day, so a batch reads the days it has rows for, and no row is too late.
    """
    def each(rows: DataFrame, batch_id: int) -> None:
        who = [k for k in dict.fromkeys([*keys, *member]) if k != day]
        changes = state.advance(rows, f"{path}/seen", batch_id, who, F.lit(1), "max", F.col(day)).withColumnRenamed(state.PART, day)
        write_delta(changes.groupBy(*keys).agg(F.count("*").alias(name)), f"{path}/deltas", batch_id)
    return each


def first_seen(path: str, keys: list[str], ts: str) -> Callable[[DataFrame, int], None]:
    """Batch job: signed changes (+1/-1) of first-seen counts per hour, in ``changes``.

    The first time of a key is its earliest, whenever it arrives: a late earlier record takes back the hour counted
    before. Times are kept in a table by hash buckets, one per key, without time limit, as the rule has none.
    """
    def each(rows: DataFrame, batch_id: int) -> None:
        moved = state.advance(rows, f"{path}/first", batch_id, keys, F.col(ts), "min", state.bucket(keys))
        hours = moved.select(*keys, F.date_trunc("hour", "new").alias("new"), F.date_trunc("hour", "old").alias("old")).filter(~F.col("new").eqNullSafe(F.col("old")))
        signed = F.array(F.struct(F.col("new").alias("hour"), F.lit(1).alias("change")), F.struct(F.col("old").alias("hour"), F.lit(-1).alias("change")))
        write_delta(hours.select(*keys, F.inline(signed)).filter("hour IS NOT NULL"), f"{path}/changes", batch_id)
    return each


def session_time(path: str, keys: list[str]) -> Callable[[DataFrame, int], None]:
    """Batch job: seconds to add per session report, in ``changes``: the whole length at first, then what the end moved on;
    sessions +1 at first.

    A session is known by ``keys`` and its start; ends are kept in a table by the day of the start, so late reports count too.
    """
    def each(rows: DataFrame, batch_id: int) -> None:
        by = [*keys, "start_ts"]
        moved = state.advance(rows, f"{path}/ends", batch_id, by, F.unix_timestamp("end_ts"), "max", F.to_date("start_ts"))
        known = F.col("old").isNotNull()
        seconds = F.col("new") - F.when(known, F.col("old")).otherwise(F.unix_timestamp("start_ts"))
        write_delta(moved.select(*by, seconds.alias("seconds"), F.when(known, 0).otherwise(1).alias("sessions")), f"{path}/changes", batch_id)
    return each


def with_cohort(orders: DataFrame, regs: DataFrame, keys: list[str]) -> DataFrame:
    """Streamed orders with the registration of the account from a stored table."""
    homes = regs.select("account", *keys, "reg_day").distinct()
    return orders.join(homes, "account").withColumn("dur", F.datediff("day", "reg_day"))


def join_within(left: DataFrame, right: DataFrame, on: list[str], left_ts: str, right_ts: str, days: int, late: str) -> DataFrame:
    """Stream-stream join of left rows with right rows of at most ``days`` days before; state is freed by the watermarks."""
    l, r = left.withWatermark(left_ts, late).alias("l"), right.withWatermark(right_ts, late).alias("r")
    cond = (F.col(f"l.{left_ts}") >= F.col(f"r.{right_ts}")) & (F.col(f"l.{left_ts}") <= F.col(f"r.{right_ts}") + F.expr(f"interval {days} days"))
    for key in on:
        cond = cond & (F.col(f"l.{key}") == F.col(f"r.{key}"))
    return l.join(r, cond).select("l.*", *[F.col(f"r.{c}") for c in right.columns if c not in on])


TRAITS = "game_id int, os int, device string, ip string, dev_type string, sys_version string, android_id string"


def attribution(path: str, days: int = CLICK_DAYS, chains=CHAINS) -> Callable[[DataFrame, int], None]:
    """Batch job: after each batch, the matches are those of :func:`attribute_activation` over all events so far.

    The stream carries clicks and activations, told apart by ``is_click``, in any order and however late. They are stored by day. A
    device's first activation is kept by hash buckets; an earlier one that comes later replaces it. Only the days that
    a batch can change are matched anew: from its earliest event back as far as a change can spread through the rules. Matches
    are stored by day of the activation; what a batch matched holds until a later batch matches that day again.
    ``changes`` holds what a batch added (+1) and took back (-1).
    """
    fields = [f.split()[0] for f in TRAITS.split(", ")]

    def each(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        rows = write_stage(rows.select("event_id", "ts", "is_click", *fields), "attribution-batch")
        clicks = rows.filter("is_click").select(F.col("event_id").alias("click_id"), F.col("ts").alias("click_ts"), *fields, F.to_date("ts").alias("day"))
        state.write_parts(clicks, f"{path}/clicks", batch_id, "day")
        known = rows.filter("not is_click").withColumn("known", device_name()).filter("known IS NOT NULL")
        row = F.struct(F.col("ts").alias("active_ts"), F.col("event_id").alias("active_id"), *[f for f in fields if f != "game_id"])
        moved = state.advance(known, f"{path}/first", batch_id, ["game_id", "known"], row, "min", state.bucket(["game_id", "known"]))
        signed = F.array(F.struct(F.lit(1).alias("sign"), F.col("new").alias("row")), F.struct(F.lit(-1).alias("sign"), F.col("old").alias("row")))
        actives = moved.select("game_id", F.inline(signed)).filter("row IS NOT NULL").select("game_id", "row.*", "sign", F.to_date("row.active_ts").alias("day"))
        state.write_parts(actives, f"{path}/actives", batch_id, "day")
        since = clicks.select("day").union(actives.select("day")).agg(F.min("day")).first()[0]
        if since is None:
            return
        first = days_needed(since, days, chains)
        upto = F.col(BATCH) <= batch_id
        stored = lambda name, shape: state.read_parts(spark, f"{path}/{name}", f"{shape}, {TRAITS}, day date, {BATCH} long", "day", lambda day: day >= str(first)).filter(upto)
        signs = stored("actives", "active_id long, active_ts timestamp, sign int")
        actives = signs.filter("sign > 0").join(signs.filter("sign < 0").select("active_id"), "active_id", "left_anti")
        before = read_matches(spark, path, batch_id, first)
        after = write_stage(rematch(actives, stored("clicks", "click_id long, click_ts timestamp"), before, since, days, chains), "attribution-after")
        state.write_parts(after, f"{path}/matches", batch_id, "day")
        from_day = first_changed_day(since, max(map(len, chains.values())) - 1, days)
        write_delta(spark.createDataFrame([(from_day,)], "since date"), f"{path}/matched", batch_id)
        pair = ["active_id", "click_id", "rule", "day"]
        gone = before.filter(F.col("day") >= F.lit(from_day)).join(after, pair, "left_anti").withColumn("sign", F.lit(-1))
        write_delta(after.join(before, pair, "left_anti").withColumn("sign", F.lit(1)).unionByName(gone), f"{path}/changes", batch_id)
    return each


MATCH = "active_id long, click_id long, rule int, day date"


def read_matches(spark: SparkSession, path: str, before: int | None = None, first: date | None = None) -> DataFrame:
    """Matches that hold (before a batch; of activations from a day on): active_id, click_id, rule, day."""
    upto = F.col(BATCH) < (1 << 62 if before is None else before)
    base, folded = _latest_base(spark, f"{path}/folded")
    wanted = None if first is None else lambda day: day >= str(first)
    rows = state.read_parts(spark, f"{path}/matches", f"{MATCH}, {BATCH} long", "day", wanted).filter(upto & (F.col(BATCH) > folded))
    if base is not None:
        rows = rows.unionByName(state.read_parts(spark, f"{path}/folded/base/upto={folded}", MATCH, "day", wanted).withColumn(BATCH, F.lit(folded).cast("long")))
    matched = read_deltas(spark, f"{path}/matched", "since date").filter(upto & (F.col(BATCH) >= folded))
    again = W.orderBy(BATCH).rowsBetween(1, W.unboundedFollowing)  # one row per batch since the last fold
    until = matched.select(BATCH, F.min("since").over(again).alias("until"))
    return rows.join(until, BATCH).filter(F.col("until").isNull() | (F.col("day") < F.col("until"))).drop(BATCH, "until")


def fold_matches(spark: SparkSession, path: str, upto: int) -> None:
    """Keep what holds after batch ``upto`` as a new base by day; readers use the old one until it is complete."""
    rows = read_matches(spark, path, upto + 1)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("day").parquet(f"{path}/folded/base/upto={upto}")


def late_dimension(path: str, read_dim: Callable[[SparkSession], DataFrame], key: str, schema: str) -> Callable[[DataFrame, int], None]:
    """Batch job: rows meet the dimension as it is now; rows it does not know yet wait for a later batch.

    The dimension is read anew, and once, for each batch. Waiting rows are those that the batch before left.
    """
    def each(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        waiting = read_deltas(spark, f"{path}/waiting", schema).filter(F.col(BATCH) == batch_id - 1).drop(BATCH)
        every = rows.unionByName(waiting)
        met = write_stage(every.join(read_dim(spark).withColumn("_known", F.lit(True)), key, "left"), "late-dimension")
        write_delta(met.filter("_known").drop("_known"), f"{path}/known", batch_id)
        write_delta(met.filter("_known IS NULL").select(*every.columns), f"{path}/waiting", batch_id)
    return each


def published_in_stream(path: str, static: Callable[[SparkSession], DataFrame]) -> Callable[[DataFrame, int], None]:
    """Batch job: facts of published games, where the stream itself announces games (``is_announcement``).

    Announcements of this and earlier batches count.
    """
    def each(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        rows.persist()
        write_delta(rows.filter("is_announcement").select("game_id").distinct(), f"{path}/games", batch_id)
        announced = read_deltas(spark, f"{path}/games", "game_id int").filter(F.col(BATCH) <= batch_id).select("game_id")
        games = static(spark).select("game_id").union(announced).distinct()
        write_delta(rows.filter("not is_announcement").join(games, "game_id", "left_semi").drop("is_announcement"), f"{path}/facts", batch_id)
        rows.unpersist()
    return each


def realtime_retention(logins: DataFrame, regs: DataFrame, keys: list[str], offsets: list[int]) -> DataFrame:
    """Logins (each account once a day) that fall on a retention day of their cohort; counts of batches add up."""
    homes = regs.select("account", *keys, "reg_day").distinct()
    return logins.join(homes, "account").withColumn("dur", F.datediff("day", "reg_day")).filter(F.col("dur").isin(offsets))
