"""Payments: revenue and payers, new payers, histograms, member spend, points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from playlens.functions.cleanse import time_bucket
from playlens.operators.aggregates import histogram, zero_filled_union
from playlens.operators.bounds import between_days
from playlens.operators.joins import epoch_ranges
from playlens.operators.keyed import asof_latest, first_row

# --- fixed values: report buckets in cents, and days --------------------------------------------
AMOUNT_EDGES = [None, 100, 5_000, 10_000, 30_000, 50_000, 100_000, 200_000, 300_000, 500_000, 1_000_000, 3_000_000]
AMOUNT_NAMES = ["pay_lt_1", "pay_1_50", "pay_50_100", "pay_100_300", "pay_300_500", "pay_500_1000", "pay_1000_2000",
                "pay_2000_3000", "pay_3000_5000", "pay_5000_10000", "pay_10000_30000", "pay_30000"]
PAY_DAYS_EDGES = [1, 2, 3, 4, 5, 6, 11, 21]
PAY_DAYS_NAMES = ["days_1", "days_2", "days_3", "days_4", "days_5", "days_6_10", "days_11_20", "days_gt_20"]
# ------------------------------------------------------------------------------------------------


def owned_orders(orders: DataFrame, regs: DataFrame, keys: list[str], ident: str = "event_id") -> DataFrame:
    """Orders with ``keys`` of the registration that owns them, one row each, so sums over the owners are the revenue.

    The owner is the account's latest registration not after the order; of an order before all of them the first one. Orders
    of accounts that never registered have null keys. ``ident`` orders registrations of one time. Accounts must not be null.
    """
    plain = orders.drop(*[k for k in keys if k in orders.columns])
    own = regs.select("account", "reg_ts", F.col(ident).alias("_reg"), *keys)
    timely = asof_latest(plain, own, ["account"], "order_ts", "reg_ts", [*keys, "_reg"], ["_reg"]).drop("reg_ts", "_reg")
    firsts = first_row(own, ["account"], ["reg_ts", "_reg"]).withColumnRenamed("reg_ts", "_first").drop("_reg")
    early = plain.join(firsts, "account", "left").filter(F.col("_first").isNull() | (F.col("order_ts") < F.col("_first"))).drop("_first")
    return timely.unionByName(early)


def pay_kpi(orders: DataFrame, keys: list[str], grain: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Money, paying accounts, paying devices per bucket."""
    bucketed = between_days(orders, "day", start, end).withColumn(grain, time_bucket("order_ts", grain))
    def payers(column, name):
        return bucketed.filter((F.col("status") == 4) & (F.col(column) != "")).select(*keys, grain, column).distinct().groupBy(*keys, grain).agg(F.count("*").alias(name))
    money = bucketed.groupBy(*keys, grain).agg(F.sum("cents").alias("pay_cents"))
    return zero_filled_union([money, payers("account", "pay_accounts"), payers("imei", "pay_devices")],
                             [*keys, grain], ["pay_cents", "pay_accounts", "pay_devices"])


def new_pay_kpi(orders: DataFrame, regs: DataFrame, keys: list[str], start: str | None = None, end: str | None = None, owned: bool = False) -> DataFrame:
    """Accounts that paid on the day they registered, at every place where they registered that day; with ``owned`` each
    order counts at its owner only, if that registration is of the same day."""
    orders, regs_ = between_days(orders, "day", start, end), between_days(regs, "reg_day", start, end)
    paid_ = orders.filter(F.col("status") == 4)
    born = regs_.select(*keys, "account", "imei", F.col("reg_day").alias("day")).distinct()
    if owned:
        by_owner = owned_orders(paid_.drop("reg_day"), regs, [*keys, "reg_day"]).filter(F.col("reg_day") == F.col("day"))
        spent = by_owner.groupBy(*keys, "account", "day").agg(F.sum("cents").alias("cents"))
        paid = spent.join(born, [*keys, "account", "day"])
    else:
        spent = paid_.groupBy("account", "day").agg(F.sum("cents").alias("cents"))
        paid = spent.join(born, ["account", "day"])
    per_account = paid.groupBy(*keys, "day", "account").agg(F.max("cents").alias("cents"))
    accounts = per_account.groupBy(*keys, "day").agg(F.count("*").alias("new_pay_accounts"), F.sum("cents").alias("new_pay_cents"))
    devices = paid.filter(F.col("imei") != "").select(*keys, "day", "imei").distinct().groupBy(*keys, "day").agg(F.count("*").alias("new_pay_devices"))
    return zero_filled_union([accounts, devices], [*keys, "day"], ["new_pay_accounts", "new_pay_cents", "new_pay_devices"])


def payer_totals(orders: DataFrame, regs: DataFrame, keys: list[str], start: str | None = None, end: str | None = None, owned: bool = False) -> DataFrame:
    """Amount and paid days per paying account and registration (of the days); with ``owned`` each order counts at its owner only."""
    if owned:
        by_owner = between_days(owned_orders(orders.drop("reg_day"), regs, [*keys, "reg_day"]).filter(F.col("reg_day").isNotNull()), "reg_day", start, end)
        daily = by_owner.groupBy(*keys, "reg_day", "account", "day").agg(F.sum("cents").alias("cents"))
    else:
        born = between_days(regs, "reg_day", start, end).select(*keys, "reg_day", "account").distinct()
        daily = orders.groupBy("account", "day").agg(F.sum("cents").alias("cents")).join(born, "account")
    return daily.groupBy(*keys, "reg_day", "account").agg(F.sum("cents").alias("cents"), F.count("*").alias("pay_days"))


def pay_amount_hist(orders: DataFrame, regs: DataFrame, keys: list[str], start: str | None = None, end: str | None = None, owned: bool = False) -> DataFrame:
    return histogram(payer_totals(orders, regs, keys, start, end, owned), [*keys, "reg_day"], "cents", AMOUNT_EDGES, AMOUNT_NAMES)


def pay_days_hist(orders: DataFrame, regs: DataFrame, keys: list[str], start: str | None = None, end: str | None = None, owned: bool = False) -> DataFrame:
    return histogram(payer_totals(orders, regs, keys, start, end, owned), [*keys, "reg_day"], "pay_days", PAY_DAYS_EDGES, PAY_DAYS_NAMES)


def member_spend(orders: DataFrame, bindings: DataFrame) -> DataFrame:
    """Per member: orders, recharge (all settled), paid amount net of refunds, last payment, bound accounts.

    ``bindings`` (member_id, change): +1 for a bound account, -1 for a released one.
    """
    paid, refunded = F.col("status") == 4, F.col("status") == 8
    spend = orders.filter(paid | refunded).groupBy("member_id").agg(
        F.count(F.when(paid, 1)).alias("orders"), F.sum(F.when(paid, F.col("cents")).otherwise(0)).alias("recharge_cents"),
        F.sum(F.when(refunded, -F.col("cents")).otherwise(F.col("cents"))).alias("paid_cents"),
        F.max(F.when(paid, F.col("day"))).alias("last_pay_day"),
    )
    bound = bindings.groupBy("member_id").agg(F.sum("change").alias("accounts"))
    return spend.join(bound, "member_id", "full_outer").fillna(0, ["orders", "recharge_cents", "paid_cents", "accounts"])


def mode_revenue(orders: DataFrame, regs: DataFrame, modes: DataFrame, changes: list[tuple[str, str]], game: str = "game_id") -> DataFrame:
    """Revenue per day and publish mode in force when the account registered; games without modes have mode 0.

    ``orders`` carry ``is_sandbox``; ``modes`` is one wide row per game.
    """
    spans = epoch_ranges(modes, [game], "mode", changes, "publish_mode")
    born = regs.select(game, "account", "reg_day").distinct().alias("r")
    s = spans.alias("s")
    cond = (F.col(f"r.{game}") == F.col(f"s.{game}")) & (F.col("r.reg_day") >= F.col("s.from_day")) & (F.col("r.reg_day") < F.col("s.to_day"))
    moded = born.join(s, cond, "left").select("r.*", F.coalesce("s.publish_mode", F.lit(0)).alias("publish_mode"))
    spent = orders.groupBy("account", "day").agg(
        F.sum("cents").alias("cents"), F.sum(F.when(F.col("is_sandbox"), F.col("cents")).otherwise(0)).alias("box"))
    return moded.join(spent, "account").groupBy("day", game, "publish_mode").agg(
        F.sum("cents").alias("pay_cents"), F.sum("box").alias("box_cents"))


def sdk_bills(requests: DataFrame, homes: DataFrame, games: DataFrame) -> DataFrame:
    """Billed amounts per day, game, channel, platform and company."""
    billed = requests.filter(F.col("order_no").isNotNull()).groupBy("day", "game_id", "account").agg(F.sum("cents").alias("cents"))
    placed = billed.join(homes, "account", "left").join(games, "game_id", "left")
    return placed.groupBy(
        "day", "game_id", F.coalesce("channel_id", F.lit(0)).alias("channel_id"), F.coalesce("os", F.lit(0)).alias("os"),
        F.coalesce("company", F.lit("")).alias("company"),
    ).agg(F.sum("cents").alias("cents"))


def points(sign_ins: DataFrame, orders: DataFrame, rate_percent: int) -> DataFrame:
    """Points earned: sign-in points, and recharge yuan times the rate (a value in (0, 1] becomes 1, else cut).

    Both inputs (member_id, day, ...); ``orders`` in cents.
    """
    scaled = F.col("cents") * rate_percent  # ten-thousandths of a point
    earned = F.when((scaled > 0) & (scaled <= 10_000), F.lit(1)).otherwise(F.floor(scaled / 10_000)).cast("long")
    return sign_ins.select("member_id", "day", F.col("points").cast("long").alias("points")).unionByName(
        orders.filter(F.col("status") == 4).select("member_id", "day", earned.alias("points")))


def points_quota(earned: DataFrame, downloads: DataFrame, orders: DataFrame) -> DataFrame:
    """Points, downloads and spend per member."""
    return zero_filled_union([
        earned.groupBy("member_id").agg(F.sum("points").alias("points")),
        downloads.groupBy("member_id").agg(F.count("*").alias("downloads")),
        orders.filter(F.col("status") == 4).groupBy("member_id").agg(F.sum("cents").alias("spend_cents")),
    ], ["member_id"], ["points", "downloads", "spend_cents"])


def points_issued(earned: DataFrame) -> DataFrame:
    """All points issued up to each day. One row per day enters the window."""
    daily = earned.groupBy("day").agg(F.sum("points").alias("points"))
    return daily.withColumn("points_to_date", F.sum("points").over(W.partitionBy(F.lit(0)).orderBy("day")))
