"""Settlement: daily performance, monthly shares, profit, costs, store ranking, dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.operators.aggregates import zero_filled_union
from playlens.operators.joins import ladder_rate, range_lookup, valid_on

# --- fixed values -------------------------------------------------------------------------------
STORE_PAY_TYPE = 5
UNPAID = 0
IOS_SYSTEM = 2
BILL_PERCENT = {3: 0.0627, 2: 0.0336}
STORE_FEE = 0.3
TEN_THOUSAND = 10_000
PERCENT_OF_WATER = 99 / 100
# ------------------------------------------------------------------------------------------------


def performance_first(regs: DataFrame, orders: DataFrame, games: DataFrame, managers: DataFrame) -> DataFrame:
    """Daily recharge, test recharge and registrations per game, channel and pay type, with the manager.

    A row of the spine is an account with a registration or an order of the game that day; money goes to the
    channels where the account registered. ``orders`` carry ``is_sandbox``; ``managers`` (package, day-free) one
    or more names per package, of which the greatest counts.
    """
    spine = (
        regs.select(F.col("reg_day").alias("day"), "account", "game_id")
        .unionByName(orders.select("day", "account", "game_id")).distinct()
    )
    paid = orders.filter("status = 4").groupBy("day", "account", "game_id", "pay_type").agg(
        F.sum("cents").alias("cents"), F.sum(F.when(F.col("is_sandbox"), F.col("cents")).otherwise(0)).alias("box"))
    # one row per account and channel; its days are as few as the calendar has
    homes = regs.groupBy("account", "medium", "site", "package").agg(F.collect_set("reg_day").alias("_days"))
    rows = spine.join(paid, ["day", "account", "game_id"], "left").join(homes, "account")
    keys = ["day", "game_id", "medium", "site", "package", "pay_type"]
    rows = rows.withColumn("pay_type", F.coalesce("pay_type", F.lit(UNPAID)))
    # money counts once per registration day of the account in the channel
    times = lambda m: F.coalesce(F.sum(F.col(m) * F.size("_days")), F.lit(0))
    water = rows.groupBy(*keys).agg(
        times("cents").alias("pay_water"), times("box").alias("box_water"), F.count_if(F.array_contains("_days", F.col("day"))).alias("_reg"))
    water = water.withColumnRenamed("_reg", "regi_num")
    head = managers.groupBy("package").agg(F.max("manager").alias("manager"))
    return water.join(games, "game_id").join(head, "package", "left").fillna("", ["manager"])


def monthly_share(net: DataFrame, contracts: DataFrame, ladder: DataFrame, game: str) -> DataFrame:
    """Share and slotting fee per month and game by the contract in force.

    ``net`` (game, month, net): recharge less that by proxy, in cents; ``contracts`` (contract_id, game, my_rate,
    division_rule, slotting_fee, start_month, end_month): rule 1 is fixed, others step up a ladder of net water
    that starts at ``my_rate``; ``ladder`` (contract_id, threshold, rate). Valid from start (included) to end (excluded).
    """
    terms = contracts.select(game, "contract_id", "my_rate", "division_rule", "slotting_fee", "start_month", "end_month")
    in_force = range_lookup(net, terms, [game], "month", "start_month", "end_month")
    steps = ladder.unionByName(contracts.select("contract_id", F.lit(0).cast("long").alias("threshold"), F.col("my_rate").alias("rate")))
    looked = in_force.withColumn("_net", F.greatest(F.col("net"), F.lit(0)))  # below zero counts as the first step
    rated = ladder_rate(looked, steps, ["contract_id"], "_net", "threshold")
    rate = F.when(F.col("division_rule") == 1, F.col("my_rate")).otherwise(F.coalesce("rate", F.lit(0)))
    return rated.select(game, "month", F.coalesce("slotting_fee", F.lit(0)).alias("slotting_fee"), rate.alias("division_rule"))


def performance_second(daily: DataFrame, proxy: DataFrame, contracts: DataFrame, child_contracts: DataFrame, ladder: DataFrame) -> DataFrame:
    """Monthly share per child game: the child's own contract, else the parent's, else nothing."""
    keys = ["month", "parent_game_id", "child_game_id"]
    month = F.trunc("day", "month").alias("month")
    water = daily.select(month, "parent_game_id", "child_game_id", F.col("pay_water").alias("net"), F.lit(True).alias("seen"))
    less = proxy.select(month, "parent_game_id", "child_game_id", (-F.col("proxy_cents")).alias("net"), F.lit(None).cast("boolean").alias("seen"))
    # one shuffle of the days serves the parents, the children and the result
    monthly = water.unionByName(less).groupBy(*keys).agg(F.sum("net").alias("net"), F.max("seen").alias("seen")).filter("seen")
    by = lambda game: monthly.groupBy(game, "month").agg(F.sum("net").alias("net"))
    parent = monthly_share(by("parent_game_id"), contracts, ladder, "parent_game_id").withColumnsRenamed({"slotting_fee": "p_fee", "division_rule": "p_rule"})
    child = monthly_share(by("child_game_id"), child_contracts, ladder, "child_game_id").withColumnsRenamed({"slotting_fee": "c_fee", "division_rule": "c_rule"})
    pick = lambda a, b: F.coalesce(F.col(a), F.col(b), F.lit(0))
    return monthly.join(parent, ["parent_game_id", "month"], "left").join(child, ["child_game_id", "month"], "left").select(
        *keys, pick("c_fee", "p_fee").alias("slotting_fee"), pick("c_rule", "p_rule").alias("division_rule"))


def bill_percent(bill_type) -> Column:
    out = None
    for code, percent in BILL_PERCENT.items():
        hit = F.col(bill_type) == code
        out = F.when(hit, percent) if out is None else out.when(hit, percent)
    return out.otherwise(0.0)


def profit(daily: DataFrame) -> DataFrame:
    """Developer's cost and our profit in cents.

    ``daily`` (pay_water, apple_water, behalf_water, behalf_cost, publish_cost, slotting_fee, division_rule, bill_type).
    Of the water net of proxies, the developer gets what channel fee, our share and tax leave; we keep 99 %
    less the developer's cost, publishing, proxies and the store's fee.
    """
    net = F.col("pay_water") - F.col("behalf_water")
    fee, share = F.col("slotting_fee") / TEN_THOUSAND, F.col("division_rule") / TEN_THOUSAND
    cost = net * (1 - fee) * (1 - share) * (1 - bill_percent("bill_type"))
    kept = net * PERCENT_OF_WATER - cost - F.col("publish_cost") - F.col("behalf_cost") - (F.col("apple_water") - F.col("behalf_water")) * STORE_FEE
    return daily.withColumns({"cp_cost": F.round(cost).cast("long"), "profit": F.round(kept).cast("long")})


def publish_cost(agents: DataFrame, ads: DataFrame, agent_audits: DataFrame, ad_audits: DataFrame, start: str, end: str) -> DataFrame:
    """Publishing cost per game, channel and day with the time of the latest change.

    Costs of agents and of ads (the latter only with status 1); the change is the latest audit, else the update.
    Taken are costs changed, made or due within the days.
    """
    def changed(costs, audits):
        latest = audits.groupBy("cost_id").agg(F.max("audit_day").alias("audit_day"))
        return costs.join(latest, "cost_id", "left").withColumn("changed", F.coalesce("audit_day", "update_day")).drop("audit_day")
    both = changed(agents, agent_audits).unionByName(changed(ads.filter("status = 1"), ad_audits))
    lo, hi = F.lit(start).cast("date"), F.lit(end).cast("date")
    due = F.col("changed").between(lo, hi) | F.col("created").between(lo, hi) | F.col("cost_day").between(lo, hi)
    rows = both.filter(due & (F.col("status") == 1))
    return rows.groupBy("cost_day", "game_id", "medium", "site", "package").agg(
        F.sum("cost_cents").alias("publish_cost"), F.max("changed").alias("changed"))


def performance_feedback(daily: DataFrame) -> DataFrame:
    """Own and store recharge and registrations per game and day, iOS games only."""
    store = F.col("pay_type") == STORE_PAY_TYPE
    return daily.filter(F.col("system_type") == IOS_SYSTEM).groupBy("game_id", "day").agg(
        F.sum(F.when(store, 0).otherwise(F.col("pay_water"))).alias("own_water"),
        F.sum(F.when(store, F.col("pay_water")).otherwise(0)).alias("store_water"), F.sum("regi_num").alias("regi_num"))


def expand_purchases(purchases: DataFrame) -> DataFrame:
    """Ranking purchases as one row per day, the cost on the first day only."""
    days = purchases.withColumn("day", F.explode(F.sequence("start_day", "end_day", F.expr("interval 1 day"))))
    return days.withColumn("cost_cents", F.when(F.col("day") == F.col("start_day"), F.col("cost_cents")).otherwise(0))


def rank_effect(purchases: DataFrame, regs: DataFrame, orders: DataFrame, shares: DataFrame) -> DataFrame:
    """Per ranking day: recharge of those who registered then, the developer's part, and profit after the purchase.

    ``shares`` (game_id, month, percent) apply by the month of the order.
    """
    days = expand_purchases(purchases).groupBy("game_id", "day").agg(F.sum("cost_cents").alias("cost_cents"))
    born = regs.select("game_id", "account", F.col("reg_day")).distinct()
    ranked = born.join(days.select("game_id", F.col("day").alias("reg_day")), ["game_id", "reg_day"], "left_semi")
    spent = orders.groupBy("account", F.trunc("day", "month").alias("month")).agg(F.sum("cents").alias("cents"))
    monthly = ranked.join(spent, "account").groupBy("game_id", "reg_day", "month").agg(F.sum("cents").alias("cents"))
    shared = monthly.join(shares, ["game_id", "month"], "left").withColumn("_own", F.col("cents") * F.coalesce("percent", F.lit(0)))
    value = shared.groupBy("game_id", F.col("reg_day").alias("day")).agg(F.sum("cents").alias("recharge"), F.sum("_own").alias("_own"))
    out = days.join(value, ["game_id", "day"], "left").fillna(0, ["recharge", "_own"])
    own = F.round(F.col("_own") / 100).cast("long")
    return out.select("game_id", "day", "cost_cents", "recharge", (F.col("recharge") - own).alias("cp_cost"), (own - F.col("cost_cents")).alias("profit"))


def rank_effect_monthly(purchases: DataFrame, regs: DataFrame, orders: DataFrame, shares: DataFrame) -> DataFrame:
    """Per ranking purchase and month of recharge: what those who registered on its days paid, the developer's part, and
    profit; the purchase itself counts in the month it starts."""
    spent = orders.groupBy("account", F.trunc("day", "month").alias("month")).agg(F.sum("cents").alias("cents"))
    born = regs.select("game_id", "account", "reg_day").distinct()
    # per game, registration day and month first: only these sums meet the purchases
    monthly = born.join(spent, "account").groupBy("game_id", F.col("reg_day").alias("day"), "month").agg(F.sum("cents").alias("cents"))
    days = purchases.select("rank_id", "game_id", F.explode(F.sequence("start_day", "end_day", F.expr("interval 1 day"))).alias("day"))
    paid = days.join(monthly, ["game_id", "day"]).join(shares, ["game_id", "month"], "left").groupBy("rank_id", "game_id", "month").agg(
        F.sum("cents").alias("recharge"), F.sum(F.col("cents") * F.coalesce("percent", F.lit(0))).alias("own"))
    bought = purchases.select("rank_id", "game_id", F.trunc("start_day", "month").alias("month"), F.col("cost_cents"))
    whole = zero_filled_union([paid, bought], ["rank_id", "game_id", "month"], ["recharge", "own", "cost_cents"])
    own = F.round(F.col("own") / 100).cast("long")
    return whole.select("rank_id", "game_id", "month", "cost_cents", "recharge", (F.col("recharge") - own).alias("cp_cost"), (own - F.col("cost_cents")).alias("profit"))


def day_report(kpi: DataFrame, actions: DataFrame, keys: list[str]) -> DataFrame:
    """The day's KPIs with the actions of the same key; days without actions stay."""
    numbers = [c for c in actions.columns if c not in keys]
    return kpi.join(actions, keys, "left").fillna(0, numbers)


def package_dimension(medium_packages: DataFrame, channel_packages: DataFrame) -> DataFrame:
    """Versioned package dimension from media (always valid) and channels (valid by their settings)."""
    always = medium_packages.withColumns({
        "promotion_mode": F.lit(""), "mstart_date": F.lit("2016-01-01").cast("date"), "mend_date": F.lit("9999-01-01").cast("date")})
    by_setting = channel_packages.withColumn("medium_account", F.lit(""))
    return always.unionByName(by_setting).distinct()


def restate(facts: DataFrame, dim: DataFrame, key: str, day: str, attributes: list[str]) -> DataFrame:
    """Facts with the dimension's current attributes in place of those stored with them."""
    bare = facts.drop(*attributes)
    fresh = valid_on(bare, dim.select(key, "mstart_date", "mend_date", *attributes), [key], day, [("mstart_date", "mend_date")])
    return fresh.fillna("", attributes)


def alliance_dimension(bags: DataFrame) -> DataFrame:
    """One row per alliance bag."""
    return bags.groupBy("bag").agg(*[F.max(c).alias(c) for c in bags.columns if c != "bag"])
