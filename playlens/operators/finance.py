"""Finance reports, source checks, and the app's member features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.functions.cleanse import drop_sandbox, zero_ratio
from playlens.operators.aggregates import zero_filled_union
from playlens.operators.joins import co_usage_top
from playlens.operators.keyed import last_row, top_k

# --- fixed values: wording of the exported reports ----------------------------------------------
FIRST_CHARGE_TEXT, REPEAT_CHARGE_TEXT, DIRECT_CHARGE_TEXT = "首充", "续充", "直充"
COMPLETED_TEXT, REFUNDED_TEXT = "订单完成", "退款完成"
DEFAULT_GROUP = "运营组"
COUPON_ONLY_TEXT, MIXED_PAY_TEXT = "纯代金券", "混合支付"
SEND_STATES = {0: "未发送", 1: "CP付款成功", 2: "CP付款失败", 3: "重试中", 4: "重试失败"}
ISSUE, CONSUME = 0, 1
RECONCILE_RATIO, RECONCILE_MIN_ORDERS = 0.8, 5
CO_DOWNLOADS = 80
# ------------------------------------------------------------------------------------------------


def cash_percent() -> Column:
    """Cash paid per list price of an order, in whole percent."""
    paid = F.col("pay_cents") + F.col("credit_cents") + F.col("coin_cents") / 10
    return F.round(100 * paid / (F.col("quantity") * F.col("list_cents"))).cast("long")


def _with_percent(orders: DataFrame, states: list[int]) -> DataFrame:
    return orders.filter(F.col("status").isin(states)).select(F.col("order_no").alias("order_id"), cash_percent().alias("percent"))


def _value(measure: str) -> Column:
    return F.round(F.sum(F.col(measure) * F.col("percent")) / 100).cast("long")


def coupon_ledger(trans: DataFrame, orders: DataFrame, settled: list[int], refunded: int = 8) -> DataFrame:
    """Coupons issued by recharge and by plan, and refunded, with their cash value, per day.

    ``trans`` (order_id: negative for plans, amount_org, kind, day, refund_day).
    """
    issued = trans.filter(F.col("kind") == ISSUE)
    by_recharge = F.col("order_id") > 0
    given = issued.groupBy("day").agg(
        F.sum(F.when(by_recharge, F.col("amount_org")).otherwise(0)).alias("recharge_coupon"),
        F.sum(F.when(F.col("order_id") < 0, F.col("amount_org")).otherwise(0)).alias("plan_coupon"))
    priced = issued.filter(by_recharge).join(_with_percent(orders, [*settled, refunded]), "order_id")
    worth = priced.groupBy("day").agg(_value("amount_org").alias("recharge_cash"))
    back = issued.join(_with_percent(orders, [refunded]), "order_id").filter(F.col("refund_day").isNotNull())
    back = back.groupBy(F.col("refund_day").alias("day")).agg(F.sum("amount_org").alias("refund_coupon"), _value("amount_org").alias("refund_cash"))
    return zero_filled_union([given, worth, back], ["day"], ["recharge_coupon", "plan_coupon", "recharge_cash", "refund_coupon", "refund_cash"])


def coupon_remaining(trans: DataFrame, orders: DataFrame, settled: list[int], before: str) -> DataFrame:
    """What is left on the coupons of settled orders before a day, and its cash value, per day of the last movement."""
    issued = trans.filter((F.col("kind") == ISSUE) & (F.col("order_id") > 0)).select("coupon_id", "order_id").join(_with_percent(orders, settled), "order_id")
    moves = trans.filter(F.col("day") < F.lit(before).cast("date")).select("coupon_id", "day", "tran_id", "amount")
    last = last_row(moves, ["coupon_id"], ["day", "tran_id", "amount"])
    return last.join(issued.select("coupon_id", "percent"), "coupon_id").groupBy("day").agg(
        F.sum("amount").alias("remaining"), _value("amount").alias("remaining_cash"))


def recharge_refund_totals(orders: DataFrame, receipts: DataFrame) -> DataFrame:
    """List price, paid amount and orders per day without test purchases; refunds of the day; net.

    ``orders`` (day, refund_day, list_cents, quantity, pay_cents, status).
    """
    live = drop_sandbox(orders, receipts)
    money = lambda p: [F.sum(F.col("list_cents") * F.col("quantity")).alias(f"{p}list"), F.sum("pay_cents").alias(f"{p}paid"), F.count("*").alias(f"{p}orders")]
    got = live.filter(F.col("status").isin(4, 8)).dropDuplicates(["order_no"]).groupBy("day").agg(*money(""))
    back = orders.filter(F.col("status") == 8).dropDuplicates(["order_no"]).groupBy(F.col("refund_day").alias("day")).agg(*money("refund_"))
    out = zero_filled_union([got, back], ["day"], ["list", "paid", "orders", "refund_list", "refund_paid", "refund_orders"])
    return out.withColumns({"net_list": F.col("list") - F.col("refund_list"), "net_paid": F.col("paid") - F.col("refund_paid")})


def _charge_text() -> Column:
    prod = F.col("prod_type")
    return F.when(prod.isin(1, 2, 5), FIRST_CHARGE_TEXT).when(prod == 4, REPEAT_CHARGE_TEXT).otherwise(DIRECT_CHARGE_TEXT)


def export_orders(orders: DataFrame, receipts: DataFrame, games: DataFrame, channels: DataFrame, groups: DataFrame) -> DataFrame:
    """Completed and refunded orders with names, a refunded order in both forms."""
    done = drop_sandbox(orders, receipts).filter(F.col("status").isin(4, 8)).withColumn("state", F.lit(COMPLETED_TEXT)).withColumn("state_day", F.col("day"))
    back = orders.filter(F.col("status") == 8).withColumn("state", F.lit(REFUNDED_TEXT)).withColumn("state_day", F.col("refund_day"))
    both = done.unionByName(back).select("order_no", "game_id", "channel_id", _charge_text().alias("charge"), "pay_type", "state", "day", "state_day",
                                         (F.col("list_cents") * F.col("quantity")).alias("list_total"), "pay_cents").distinct()
    return both.join(games, "game_id").join(channels, "channel_id").join(groups, ["game_id", "channel_id"], "left").fillna(DEFAULT_GROUP, ["group_name"])


def export_coupons_added(trans: DataFrame, orders: DataFrame, games: DataFrame) -> DataFrame:
    """Each issued coupon with its order and cash value."""
    issued = trans.filter((F.col("kind") == ISSUE) & (F.col("order_id") > 0))
    priced = issued.join(_with_percent(orders, [4, 8]), "order_id").join(orders.select(F.col("order_no").alias("order_id"), "game_id"), "order_id")
    return priced.join(games, "game_id").select(
        "coupon_id", "order_id", "game_name", "day", "amount_org", F.round(F.col("amount_org") * F.col("percent") / 100).cast("long").alias("cash_value"))


def export_coupons_used(trans: DataFrame, orders: DataFrame, requests: DataFrame) -> DataFrame:
    """Each use of a coupon with the request it paid, the amount used and its cash value.

    ``requests`` (request_no, send_state); a use is of a coupon alone, or mixed with other payment.
    """
    issued = trans.filter(F.col("kind") == ISSUE).select("coupon_id", F.col("order_id").alias("issue_order"))
    used = trans.filter(F.col("kind") == CONSUME).join(issued, "coupon_id")
    priced = used.join(_with_percent(orders, [0, 4, 8]).withColumnRenamed("order_id", "issue_order"), "issue_order").join(requests, "request_no")
    spent = F.col("amount_org") - F.col("amount")
    state = None
    for code, text in SEND_STATES.items():
        state = F.when(F.col("send_state") == code, text) if state is None else state.when(F.col("send_state") == code, text)
    return priced.select(
        "coupon_id", "issue_order", "request_no", state.alias("state"), F.when(F.col("order_id") == 0, COUPON_ONLY_TEXT).otherwise(MIXED_PAY_TEXT).alias("pay_kind"),
        "day", spent.alias("used"), F.round(spent * F.col("percent") / 100).cast("long").alias("cash_value"))


def source_reconcile(log: DataFrame, ledger: DataFrame, bucket: str, ratio: float = RECONCILE_RATIO, min_orders: int = RECONCILE_MIN_ORDERS) -> DataFrame:
    """Distinct orders in the log against the ledger per bucket; an alert when too few, unless there are hardly any."""
    count = lambda df, name: df.select(bucket, "order_no").distinct().groupBy(bucket).agg(F.count("*").alias(name))
    both = count(ledger, "ledger_orders").join(count(log, "log_orders"), bucket, "left").fillna(0, ["log_orders"])
    return both.withColumn("ratio", zero_ratio("log_orders", "ledger_orders")).withColumn(
        "alert", (F.col("ledger_orders") > min_orders) & (F.col("ratio") < ratio))


def co_download_recommend(downloads: DataFrame, device: str, game: str, k: int = CO_DOWNLOADS) -> DataFrame:
    """For each game the ``k`` games most often downloaded on the same devices, as one text."""
    best = co_usage_top(downloads, device, game, k)
    text = F.array_join(F.sort_array(F.collect_set(F.col("other").cast("string"))), "|")  # at most k values
    return best.groupBy(F.col("item").alias(game)).agg(text.alias("recommended"))


def recent_games(logins: DataFrame) -> DataFrame:
    """Last login and its channel per member and game."""
    last = logins.groupBy("member_id", "game_id").agg(F.max(F.struct("day", "channel_id")).alias("_l"))
    return last.select("member_id", "game_id", F.col("_l.day").alias("last_day"), F.col("_l.channel_id").alias("channel_id"))


def installed_apps(reports: DataFrame) -> DataFrame:
    """Latest status per device and app."""
    return last_row(reports, ["device_id", "pkg_name"], ["opera_ts", "report_id"])


def role_latest(roles: DataFrame) -> DataFrame:
    """Latest state of each role."""
    return last_row(roles, ["role_id"], ["update_ts", "event_id"])
