"""Cohorts: who registered on a day, and what they did n days later.

One core for retention, lifetime value and payers: both sides are reduced to one row per entity and
day before they meet, so an entity with very many events costs no more than its days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from playlens.functions.cleanse import zero_ratio
from playlens.operators.activity import activation_kpi
from playlens.operators.aggregates import count_distinct, pivot_offsets, zero_filled_union
from playlens.operators.bounds import between_days
from playlens.operators.joins import band_expand, calendar
from playlens.operators.payments import new_pay_kpi

# --- fixed values: days after registration that the reports show --------------------------------
RETENTION_OFFSETS = [*range(15), 29, 44, 59, 89, 119, 149, 179]
PACKAGE_RETENTION_OFFSETS = [*range(1, 15), 29]
REALTIME_OFFSETS = [1, 2, 6, 29]
SDK_OFFSETS = [1, 2, 3, 4, 5, 6, 14, 29]
CARD_OFFSETS = [1, 2, 3, 4, 5, 6, 14, 29]
COMMON_SDK_OFFSETS = [1, 2, 6, 14, 29]
LTV_DAYS = [*range(1, 16), 30, 45, 60, 90, 180]
AD_LTV_DAYS = [1, 2, 3, 7, 30]
ALLIANCE_LTV_DAYS = [1, 3, 7, 30]
PAY_WATCH_DAYS = 15
# ------------------------------------------------------------------------------------------------


def cohort_days(cohort: DataFrame, events: DataFrame, on: list[str], keys: list[str], entity: list[str],
                cohort_day: str, event_day: str, offsets: Sequence[int] | None = None,
                how: str = "inner") -> DataFrame:
    """One row per cohort member and active day, with ``dur`` days since ``cohort_day``.

    ``on`` are the join columns (the entity, and game or channel where the report asks for them).
    """
    members = cohort.select(*dict.fromkeys([*keys, cohort_day, *entity, *on])).distinct()
    days = events.select(*on, event_day).distinct()
    joined = members.join(days, on, how).withColumn("dur", F.datediff(event_day, cohort_day))
    return joined.filter(F.col("dur").isin(list(offsets))) if offsets is not None else joined


def retention(cohort: DataFrame, events: DataFrame, on: list[str], keys: list[str], entity: list[str],
              cohort_day: str = "reg_day", event_day: str = "day", offsets: Sequence[int] = RETENTION_OFFSETS,
              name: str = "retained_{}", start: str | None = None, end: str | None = None) -> DataFrame:
    """Members seen again n days later, one column per n; ``start`` and ``end`` bound the cohort days.

    Member rows and event days are distinct, so each joined row is a distinct (member, day): no third distinct.
    """
    cohort, events = between_days(cohort, cohort_day, start, end), between_days(events, event_day, start, end, max(offsets))
    pairs = cohort_days(cohort, events, on, keys, entity, cohort_day, event_day, offsets)
    return pivot_offsets(pairs, [*keys, cohort_day], "dur", list(offsets), F.lit(1), name)


def _within(n: int, allow_pre_reg: bool) -> Column:
    """Days counted in an n-day value. Spending before registration counts only when asked for, and never on day one."""
    if n == 1:
        return F.col("dur") == 0
    return F.col("dur") <= n - 1 if allow_pre_reg else F.col("dur").between(0, n - 1)


def cohort_value(cohort: DataFrame, orders: DataFrame, on: list[str], keys: list[str], cohort_day: str = "reg_day",
                 days: Sequence[int] = LTV_DAYS, allow_pre_reg: bool = False, measure: str = "cents",
                 name: str = "ltv_{}", total: str | None = None, how: str = "left", start: str | None = None, end: str | None = None) -> DataFrame:
    """Cumulative order value n days after registration, in cents; ``start`` and ``end`` bound the cohort days.

    A ``total`` sums all orders of a member, so then orders are not bounded.
    """
    cohort = between_days(cohort, cohort_day, start, end)
    if not total:
        orders = between_days(orders, "day", None if allow_pre_reg else start, end, max(days) - 1)
    members = cohort.select(*dict.fromkeys([*keys, cohort_day, *on])).distinct()
    spent = orders.groupBy(*on, "day").agg(F.sum(measure).alias("_spent"))
    pairs = members.join(spent, on, how).withColumn("dur", F.datediff("day", cohort_day))
    columns = [F.sum(F.when(_within(n, allow_pre_reg), F.col("_spent")).otherwise(0)).cast("long").alias(name.format(n)) for n in days]
    if total:
        columns.append(F.coalesce(F.sum("_spent"), F.lit(0)).cast("long").alias(total))
    return pairs.groupBy(*keys, cohort_day).agg(*columns)


def payers_by_cohort_day(cohort: DataFrame, orders: DataFrame, on: list[str], keys: list[str], cohort_day: str = "reg_day",
                         offsets: Sequence[int] = RETENTION_OFFSETS, start: str | None = None, end: str | None = None) -> DataFrame:
    """Members who paid on each day after registration; cohorts without payers stay with zeros."""
    cohort, orders = between_days(cohort, cohort_day, start, end), between_days(orders, "day", start, end, max(offsets))
    pairs = cohort_days(cohort, orders, on, keys, on, cohort_day, "day", how="left")
    return pivot_offsets(pairs, [*keys, cohort_day], "dur", list(offsets), F.lit(1), "payers_{}")


def cumulative_payers(cohort: DataFrame, orders: DataFrame, on: list[str], keys: list[str], cohort_day: str, last_day: str,
                      width: int = PAY_WATCH_DAYS) -> DataFrame:
    """Running payers and amount per cohort for each of the first days, without gaps.

    A payer counts from the first paid day on. Sums per cohort and day come first; only those are spread over the days.
    """
    members = cohort.select(*dict.fromkeys([*keys, cohort_day, *on])).distinct()
    spent = orders.groupBy(*on, "day").agg(F.sum("cents").alias("cents"))
    pairs = members.join(spent, on).filter(F.datediff("day", cohort_day).between(0, width))
    first = F.min("day").over(W.partitionBy(*keys, cohort_day, *on))  # at most one row per day of the span
    daily = pairs.withColumn("_first", first).groupBy(*keys, cohort_day, "day").agg(
        F.sum("cents").alias("cents"), F.count_if(F.col("day") == F.col("_first")).alias("new"))
    # the few days of a cohort fit in one row, which is then spread over the span
    cohorts = daily.groupBy(*keys, cohort_day).agg(F.collect_list(F.struct("day", "cents", "new")).alias("_days"))
    dense = band_expand(cohorts, cohort_day, width, "day", last_day)
    upto = lambda field: F.aggregate(
        F.filter("_days", lambda d: d["day"] <= F.col("day")), F.lit(0).cast("long"), lambda total, d: total + d[field])
    return dense.select(*keys, cohort_day, (F.datediff("day", cohort_day) + 1).alias("day_no"), upto("new").alias("payers"), upto("cents").alias("pay_cents"))


def ltv_net(cohort: DataFrame, orders: DataFrame, proxy: DataFrame, shares: DataFrame, costs: DataFrame, devices: DataFrame,
            game: str = "game_id", cohort_day: str = "reg_day", days: Sequence[int] = LTV_DAYS) -> DataFrame:
    """Value per registration day and game, less recharges by proxy, before (``b``) and after (``a``) the revenue share.

    ``orders`` (account, day, cents); ``proxy`` (game, day, proxy_cents); ``shares`` (game, month, rate_bp: ten-thousandths);
    ``costs`` (game, day, cost_cents) of the first day. Rates are those of the month of the order or booking.
    """
    rate = shares.select(game, F.col("month").alias("_month"), "rate_bp")
    month = lambda d: F.trunc(F.col(d), "month")
    members = cohort.select(game, cohort_day, "account").distinct()
    spent = orders.groupBy("account", "day").agg(F.sum("cents").alias("cents"))
    def cohort_sum(pairs, measure, prefix):
        # after-share values are in cents times ten-thousandths, so all sums are whole numbers
        share = F.coalesce(F.col("rate_bp"), F.lit(0)) * F.col(measure)
        cols = []
        for n in days:
            cols += [F.sum(F.when(_within(n, False), F.col(measure)).otherwise(0)).alias(f"{prefix}b{n}"),
                     F.sum(F.when(_within(n, False), share).otherwise(0)).alias(f"{prefix}a{n}")]
        return pairs.groupBy(game, cohort_day).agg(*cols)
    paid = members.join(spent, "account").withColumn("dur", F.datediff("day", cohort_day)).withColumn("_month", month("day"))
    value = cohort_sum(paid.groupBy(game, cohort_day, "dur", "_month").agg(F.sum("cents").alias("cents")).join(rate, [game, "_month"], "left"), "cents", "v_")
    size = members.groupBy(game, cohort_day).agg(F.count("*").alias("accounts"))
    booked = proxy.groupBy(game, "day").agg(F.sum("proxy_cents").alias("proxy_cents")).withColumn("_month", month("day")).join(rate, [game, "_month"], "left")
    # a booking day counts for the cohort days of the longest span before it: an equi-join, not all days of a game by all
    serves = F.sequence(F.date_sub("day", max(days) - 1), F.col("day"), F.expr("interval 1 day"))
    spread = booked.withColumn(cohort_day, F.explode(serves)).join(size.select(game, cohort_day), [game, cohort_day]).withColumn("dur", F.datediff("day", cohort_day))
    less = cohort_sum(spread, "proxy_cents", "p_")
    cost = costs.groupBy(game, F.col("day").alias(cohort_day)).agg(F.sum("cost_cents").alias("publish_cost"))
    dev = devices.groupBy(game, cohort_day).agg(F.sum("devices").alias("devices"))
    out = size
    for part in (value, less, cost, dev):
        out = out.join(part, [game, cohort_day], "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    nets = [(zero(f"v_{k}{n}") - zero(f"p_{k}{n}")).cast("long").alias(f"{k}_{n}") for k in "ba" for n in days]
    return out.select(game, cohort_day, "accounts", zero("devices").alias("devices"), zero("publish_cost").alias("publish_cost"), *nets)


def dense_retention(first_days: DataFrame, events: DataFrame, on: list[str], keys: list[str], dim: DataFrame, start: str, end: str,
                    offsets: Sequence[int] = SDK_OFFSETS) -> DataFrame:
    """Retention of first-login cohorts for every (key, day) of the calendar, zero where nobody came."""
    got = retention(first_days, events, on, keys, on, "first_day", "day", offsets)
    spine = calendar(dim.select(*keys).distinct(), start, end, "first_day")
    return spine.join(got, [*keys, "first_day"], "left").fillna(0, [f"retained_{n}" for n in offsets])


ALLIANCE_MEASURES = [
    "regi_accounts", "active_devices", "pay_cents", "new_pay_accounts", "new_pay_cents", "new_pay_devices", "dau_accounts",
    *(f"retained_{n}" for n in REALTIME_OFFSETS), *(f"ltv_{n}" for n in ALLIANCE_LTV_DAYS),
]


def alliance_kpi(actives: DataFrame, regs: DataFrame, logins: DataFrame, orders: DataFrame, keys: list[str]) -> DataFrame:
    """Registrations, activations, payments, active accounts, retention and value per day and ``keys`` (game and bag).

    Payments belong to where the account registered. Retention and value stand at the day of registration.
    """
    by = [*keys, "day"]
    spent = orders.groupBy("account", "day").agg(F.sum("cents").alias("pay_cents"))
    parts = [
        count_distinct(regs.withColumn("day", F.col("reg_day")), by, ["account"], "regi_accounts"),
        activation_kpi(actives, keys, "day"),
        spent.join(regs.select(*keys, "account").distinct(), "account").groupBy(*by).agg(F.sum("pay_cents").alias("pay_cents")),
        new_pay_kpi(orders, regs, keys),
        count_distinct(logins, by, ["account"], "dau_accounts"),
        retention(regs, logins, ["account"], keys, ["account"], offsets=REALTIME_OFFSETS).withColumnRenamed("reg_day", "day"),
        cohort_value(regs, orders, ["account"], keys, days=ALLIANCE_LTV_DAYS, how="inner").withColumnRenamed("reg_day", "day"),
    ]
    return zero_filled_union(parts, by, ALLIANCE_MEASURES)


def retention_rates(df: DataFrame, base: str, offsets: Sequence[int]) -> DataFrame:
    return df.withColumns({f"rate_{n}": zero_ratio(f"retained_{n}", base) for n in offsets})
