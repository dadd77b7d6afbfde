"""Promoters: who owns an account, daily and to-date results, rebates, devices."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.functions.cleanse import platform_default, valid_device
from playlens.operators.aggregates import count_distinct, zero_filled_union
from playlens.operators.joins import ladder_ranges, range_lookup
from playlens.operators.keyed import first_day_rows, first_row, running_total, sliced_row_number
from playlens.session import write_stage

# --- fixed values -------------------------------------------------------------------------------
SETTLED = (4, 8)
FIRST_CHARGE, REPEAT_CHARGE, DIRECT_CHARGE = (1, 3), (2, 4), 6
ACTIVE_STATUS = (0, 1)
BY_PACKAGE, BY_BINDING = 8, 6
REBATE_APPROVED, REBATE_SPECIAL, REBATE_FIXED = 3, 2, 1
RULE_OWN, RULE_SUBS = 3, 4
DEVICE_VALID_DAYS = 15
# ------------------------------------------------------------------------------------------------


def active_promoters(promoters: DataFrame) -> DataFrame:
    return promoters.filter(F.col("status").isin(*ACTIVE_STATUS) & (F.col("member_grade") == 1))


def account_owner_map(regs: DataFrame, promoters: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per account: first registration, earliest owner, day of the first paid order (which binds it).

    An owner is written in the registration, or follows from the promotion code (package registrations), or
    from the bound member's name.
    """
    named = F.coalesce(F.col("owner_id"), F.lit(0)) != 0
    coded = F.coalesce(F.col("expand_code"), F.lit("")) != ""
    source = regs.select("account", "reg_ts", "resource", "owner_id", "expand_code", "bind_name")
    pick = lambda df: df.select("account", "reg_ts", F.when(named, F.col("owner_id")).otherwise(F.col("_member")).alias("owner"))
    by_code = promoters.select(F.col("code").alias("_code"), F.col("member_id").alias("_member"))
    by_name = promoters.select(F.col("username").alias("bind_name"), F.col("member_id").alias("_member"))
    coded_rows = source.filter((F.col("resource") == BY_PACKAGE) & coded).withColumn("_code", F.regexp_replace("expand_code", r"\.", ""))
    bound = source.filter((F.col("resource") == BY_BINDING) | ((F.col("resource") == BY_PACKAGE) & ~coded & ~named))
    candidates = (
        source.filter(named).select("account", "reg_ts", F.col("owner_id").alias("owner"))
        .unionByName(pick(coded_rows.join(by_code, "_code"))).unionByName(pick(bound.join(by_name, "bind_name")))
    )
    owners = candidates.groupBy("account").agg(F.min(F.struct("reg_ts", "owner")).alias("_o")).select(
        "account", F.col("_o.owner").alias("owner"), F.to_date("_o.reg_ts").alias("relate_day"))
    first = first_row(regs.select("account", "game_id", "channel_id", "os", "resource", "reg_day", "reg_ts", "reg_id"), ["account"], ["reg_ts", "reg_id"])
    paid = orders.filter("status = 4").groupBy("account").agg(F.min(F.struct("order_ts", "order_no", "prod_type")).alias("_p"))
    paid = paid.select("account", F.to_date("_p.order_ts").alias("bind_day"), F.col("_p.prod_type").alias("_prod"))
    kind = F.when(F.col("_prod").isin(*FIRST_CHARGE), 2).when(F.col("resource") == BY_PACKAGE, 1).otherwise(3)
    return first.join(owners, "account").join(paid, "account", "left").withColumn("kind", kind).select(
        "account", "game_id", "channel_id", "os", "reg_day", "owner", "relate_day", "bind_day", "kind")


def _settled(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("status").isin(*SETTLED))


def _added(accounts: DataFrame, day: str, keys: list[str], name: str) -> DataFrame:
    return accounts.filter(F.col(day).isNotNull()).groupBy(F.col("owner").alias("member_id"), F.col(day).alias("day"), *keys).agg(F.count("*").alias(name))


def promoter_extend(accounts: DataFrame, promoters: DataFrame) -> DataFrame:
    """Accounts bound and accounts registered per promoter, day, game, platform."""
    keys = ["game_id", "os"]
    whole = zero_filled_union([_added(accounts, "bind_day", keys, "add_users"), _added(accounts, "relate_day", keys, "add_regi_accounts")],
                              ["member_id", "day", *keys], ["add_users", "add_regi_accounts"])
    return whole.join(active_promoters(promoters).select("member_id", "username"), "member_id")


def promoter_deals(accounts: DataFrame, orders: DataFrame, promoters: DataFrame) -> DataFrame:
    """Recharge, rebate, deals and new users per promoter, day, game, channel, platform of the account."""
    keys = ["game_id", "channel_id", "os"]
    home = accounts.select("account", F.col("os").alias("_os"))
    placed = _settled(orders).drop("os").join(home, "account", "left").withColumn("os", F.coalesce("_os", F.lit(0)))
    deals = placed.groupBy("member_id", "day", *keys).agg(
        F.sum("cents").alias("rec_cents"), F.sum("rebate_cents").alias("reb_cents"), F.count("*").alias("deals"))
    whole = zero_filled_union([deals, _added(accounts, "bind_day", keys, "add_users")], ["member_id", "day", *keys], ["rec_cents", "reb_cents", "deals", "add_users"])
    return whole.join(active_promoters(promoters).select("member_id", "username"), "member_id")


def promoter_account_orders(accounts: DataFrame, orders: DataFrame, promoters: DataFrame) -> DataFrame:
    """Each settled order with its account: how it registered, kind of recharge, and whether it made a new user.

    An order makes a new user when the account was not bound before it, and its owner is the one who gets the rebate.
    """
    a = accounts.select("account", "owner", "bind_day", "kind", F.col("channel_id").alias("reg_channel"))
    rows = _settled(orders).join(a, "account").join(active_promoters(promoters).select("member_id", "username"), "member_id")
    prod = F.col("prod_type")
    recharge = F.when(prod.isin(*FIRST_CHARGE), 0).when(prod.isin(*REPEAT_CHARGE), 1).when(prod == DIRECT_CHARGE, 2).otherwise(100)
    adds = F.when(F.col("bind_day").isNull() | (F.col("bind_day") < F.col("day")) | (F.col("owner") != F.col("member_id")), 0).otherwise(1)
    return rows.select(
        "day", "member_id", "username", "account", "order_no", "status", "cents", "rebate_cents", "reg_channel",
        F.when(F.col("kind") == 1, 1).otherwise(2).alias("reg_type"), recharge.alias("rec_type"), adds.alias("is_user_add"))


def promoter_account_info(accounts: DataFrame, logins: DataFrame, promoters: DataFrame) -> DataFrame:
    """Owned accounts with their last login and whether they ever paid."""
    last = logins.groupBy("account").agg(F.max("day").alias("last_login_day"))
    owned = accounts.filter(F.coalesce("owner", F.lit(0)) != 0)
    names = promoters.select(F.col("member_id").alias("owner"), "username")
    return owned.join(names, "owner").join(last, "account", "left").select(
        "account", "owner", "username", "game_id", F.when(F.col("kind") == 1, 1).otherwise(2).alias("user_type"), "relate_day", "last_login_day",
        F.when(F.col("bind_day").isNull(), 0).otherwise(1).alias("is_recharge"), "os")


def _charge_kinds(measure: str = "cents") -> dict[str, F.Column]:
    prod = F.col("prod_type")
    by_other = (F.col("member_id") != F.col("user_id")) & prod.isin(*REPEAT_CHARGE) & (F.col("member_id") != 0) & (F.col("user_id") != 0)
    part = lambda cond: F.sum(F.when(cond, F.col(measure)).otherwise(0))
    return {"first": part(prod.isin(*FIRST_CHARGE)), "repeat": part(prod.isin(*REPEAT_CHARGE) & ~by_other), "by_player": part(by_other), "direct": part(prod == DIRECT_CHARGE)}


def promoter_account_totals(accounts: DataFrame, orders: DataFrame, promoters: DataFrame) -> DataFrame:
    """To-date income per account by kind of recharge; a player's own repeat recharge is split from the promoter's."""
    sums = _settled(orders).filter(F.col("prod_type").isin(1, 2, 3, 4, 6)).groupBy("member_id", "account", "game_id").agg(
        *[c.alias(f"{k}_cents") for k, c in _charge_kinds().items()], F.sum("rebate_cents").alias("rebate_cents"), F.sum("cents").alias("total_cents"))
    a = accounts.select("account", "reg_day", F.when(F.col("kind") == 1, "package").otherwise("bought").alias("resource"))
    return sums.join(a, "account").join(active_promoters(promoters).select("member_id", "username"), "member_id")


def promoter_game_totals(accounts: DataFrame, orders: DataFrame, promoters: DataFrame, icons: DataFrame) -> DataFrame:
    """To-date accounts and income per promoter, game, channel, platform, with the icon of the game.

    ``icons`` (game_id, status, child_game_id, icon): the game's icon is that of its child of least status.
    """
    keys = ["member_id", "game_id", "channel_id", "os_name"]
    home = accounts.select("account", "channel_id", platform_default(F.when(F.col("os") == 1, "android").when(F.col("os") == 2, "ios")).alias("os_name"))
    income = _settled(orders).drop("channel_id").join(home, "account").groupBy(*keys).agg(
        F.sum("cents").alias("income"), F.sum(F.when(F.col("prod_type") == DIRECT_CHARGE, F.col("cents")).otherwise(0)).alias("direct_income"),
        F.sum("rebate_cents").alias("rebate"), F.count("*").alias("deals"))
    owned = accounts.join(home.select("account", "os_name"), "account").withColumn("member_id", F.col("owner")).groupBy(*keys).agg(
        F.count("*").alias("accounts"), F.count("bind_day").alias("deal_accounts"))
    icon = first_row(icons, ["game_id"], ["status", "child_game_id"]).select("game_id", "icon")
    whole = zero_filled_union([income, owned], keys, ["accounts", "deal_accounts", "income", "direct_income", "rebate", "deals"])
    return whole.join(icon, "game_id").join(active_promoters(promoters).select("member_id", "username"), "member_id")


def promoter_login_detail(accounts: DataFrame, logins: DataFrame, promoters: DataFrame) -> DataFrame:
    seen = logins.select("account", F.col("day").alias("login_day")).distinct()
    members = promoters.filter("status = 0 and member_grade = 1").select(F.col("member_id").alias("owner"), "username")
    return seen.join(accounts.select("account", "owner", "game_id", "channel_id", "os"), "account").join(members, "owner")


def promoter_report(accounts: DataFrame, orders: DataFrame, promoters: DataFrame) -> DataFrame:
    """Income by kind of recharge, rebates and new users per promoter, day, game, channel."""
    keys = ["member_id", "day", "game_id", "channel_id"]
    money, rebate = _charge_kinds(), _charge_kinds("rebate_cents")
    income = _settled(orders).groupBy(*keys).agg(
        *[c.alias(f"{k}_income") for k, c in money.items()], rebate["direct"].alias("direct_rebate"), rebate["by_player"].alias("player_rebate"))
    measures = ["first_income", "repeat_income", "by_player_income", "direct_income", "direct_rebate", "player_rebate", "add_users"]
    whole = zero_filled_union([income, _added(accounts, "bind_day", ["game_id", "channel_id"], "add_users")], keys, measures)
    info = active_promoters(promoters).select("member_id", "owner_id", "username", "group_id")
    total = F.col("first_income") + F.col("repeat_income") + F.col("by_player_income") + F.col("direct_income")
    return whole.join(info, "member_id").withColumn("income", total)


def promoter_operations(accounts: DataFrame, orders: DataFrame, promoters: DataFrame, day: str) -> DataFrame:
    """Results up to ``day`` per promoter, alone and with the sub-accounts, and the month's income of the subs."""
    upto = F.lit(day).cast("date")
    settled = _settled(orders).filter(F.col("day") <= upto)
    own = settled.groupBy("member_id").agg(
        F.sum("cents").alias("income"), F.sum("rebate_cents").alias("rebate"),
        F.sum(F.when(F.col("day") >= F.trunc(upto, "month"), F.col("cents")).otherwise(0)).alias("month_income"))
    held = accounts.filter(F.col("reg_day") <= upto).groupBy(F.col("owner").alias("member_id")).agg(
        F.count(F.when(F.col("kind") == 1, 1)).alias("package_regs"), F.count(F.when(F.col("kind") == 2, 1)).alias("bought_accounts"),
        F.count(F.when(F.col("bind_day") <= upto, 1)).alias("deal_accounts"), F.count("*").alias("accounts"))
    measures = ["income", "rebate", "month_income", "package_regs", "bought_accounts", "deal_accounts", "accounts"]
    alone = zero_filled_union([own, held, promoters.select("member_id")], ["member_id"], measures)
    links = promoters.select("member_id", "owner_id", "created")
    below = alone.join(links, "member_id").filter("owner_id <> 0").groupBy(F.col("owner_id").alias("member_id")).agg(
        *[F.sum(m).alias(f"sub_{m}") for m in ("income", "rebate", "month_income", "deal_accounts", "accounts")],
        F.count(F.when(F.col("created") <= upto, 1)).alias("sub_accounts_no"))
    subs = ["sub_income", "sub_rebate", "sub_month_income", "sub_deal_accounts", "sub_accounts", "sub_accounts_no"]
    out = alone.join(below, "member_id", "left").fillna(0, subs).join(active_promoters(promoters).select("member_id", "username"), "member_id")
    plus = lambda m: (F.col(m) + F.col(f"sub_{m}")).alias(f"all_{m}")
    return out.select("member_id", "username", *measures, *subs, plus("income"), plus("rebate"), plus("accounts"))


def promoter_day(orders: DataFrame, promoters: DataFrame) -> DataFrame:
    """Income, rebate and accounts that bought for the first time from the promoter, per day."""
    money = _settled(orders).groupBy("member_id", "day").agg(F.sum("cents").alias("day_income"), F.sum("rebate_cents").alias("day_profit"))
    first = orders.filter("status = 4").groupBy("member_id", "account").agg(F.min("day").alias("day"))
    added = first.groupBy("member_id", "day").agg(F.count("*").alias("day_add_users"))
    whole = zero_filled_union([money, added], ["member_id", "day"], ["day_income", "day_profit", "day_add_users"])
    return whole.join(active_promoters(promoters).select("member_id"), "member_id", "left_semi")


def promoter_running(orders: DataFrame) -> DataFrame:
    """Income and rebate of each promoter from the beginning up to each day."""
    return running_total(_settled(orders), ["member_id"], "day", ["cents", "rebate_cents"])


def sub_promoter_daily(accounts: DataFrame, orders: DataFrame, promoters: DataFrame) -> DataFrame:
    """New users and income of sub-promoters per day and channel, with their number under the owner (by age)."""
    live = active_promoters(promoters).filter("owner_id <> 0")
    numbered = sliced_row_number(live, ["owner_id"], "created", ["member_id"], "seq", unit="month").select("member_id", "owner_id", "username", "created", "seq")
    income = _settled(orders).groupBy("member_id", "day", "channel_id").agg(F.sum("cents").alias("income"))
    whole = zero_filled_union([_added(accounts, "bind_day", ["channel_id"], "add_users"), income], ["member_id", "day", "channel_id"], ["add_users", "income"])
    owner = promoters.select(F.col("member_id").alias("owner_id"), F.col("username").alias("owner_name"))
    return whole.join(numbered, "member_id").join(owner, "owner_id")


def rebate_base(detail: DataFrame, excluded_channels: DataFrame) -> DataFrame:
    """Monthly recharge per member, game, recharge type and discount, without excluded channels."""
    kept = detail.join(excluded_channels.select("channel_id"), "channel_id", "left_anti")
    return kept.groupBy("ym", "member_id", "game_id", "recharge_type", "discount").agg(F.sum("cents").alias("cents"))


def rebate_detail(base: DataFrame, promoters: DataFrame, tiers: DataFrame, tariff_games: DataFrame) -> DataFrame:
    """Rebates by three tariffs: specially approved, then special games, then fixed.

    ``tiers`` (kind 2 approved / 1 special / 0 fixed, group_num, recharge_type, min_number, scale percent, exclude_discount,
    tel, max_number for approved ones); ``tariff_games`` (kind, group_num, game_id). Discounts that a tariff excludes do not count for it.
    Approved tariffs look at the member's amount of the game and name the member; special ones at the member's
    total of the game, fixed ones at the member's total of all games left. What an earlier tariff took is not rebated again.
    """
    keys = ["ym", "member_id", "game_id", "recharge_type"]
    graded = promoters.filter("member_grade = 1").select("member_id", "username", (F.col("status") + 1).alias("user_type"))
    base = write_stage(base.join(graded, "member_id"), "rebate-base")  # every tariff reads it
    def without_excluded(kind):
        dropped = tiers.filter((F.col("kind") == kind) & F.col("exclude_discount").isNotNull()).select(F.col("exclude_discount").alias("discount")).distinct()
        return base.join(dropped, "discount", "left_anti")
    def amounts(rows):
        return rows.groupBy(*keys, "username", "user_type").agg(F.sum("cents").alias("cents"))
    def of_games(kind, ranges):
        return ranges.join(tariff_games.filter(F.col("kind") == kind).drop("kind"), "group_num")
    def result(rows, number):
        return rows.select(*keys, "username", "user_type", "cents", F.lit(number).alias("rebate_type"), F.col("scale"),
                           F.round(F.col("cents") * F.col("scale") / 100).cast("long").alias("rebate_cents"))
    approved_tiers = of_games(2, tiers.filter("kind = 2").select("group_num", "recharge_type", "min_number", "max_number", "scale", F.col("tel").alias("username")))
    approved = range_lookup(amounts(without_excluded(2)), approved_tiers, ["game_id", "recharge_type", "username"], "cents", "min_number", "max_number").select(
        *keys, "username", "user_type", "cents", "scale")
    approved = write_stage(approved, "rebate-approved")
    taken = approved.select("member_id", "game_id").distinct()
    special_tiers = of_games(1, ladder_ranges(tiers.filter("kind = 1").select("group_num", "recharge_type", "min_number", "scale"), ["group_num", "recharge_type"], "min_number"))
    left = amounts(without_excluded(1)).join(taken, ["member_id", "game_id"], "left_anti")
    special = range_lookup(left, special_tiers.select("game_id", "recharge_type", "low", "high", "scale"), ["game_id", "recharge_type"], "cents", "low", "high")
    special_games = tariff_games.filter("kind = 1").select("game_id").distinct()
    rest = amounts(base).join(taken, ["member_id", "game_id"], "left_anti").join(special_games, "game_id", "left_anti")
    month = rest.groupBy("ym", "member_id", "recharge_type").agg(F.sum("cents").alias("month_cents"))
    fixed_tiers = ladder_ranges(tiers.filter("kind = 0").select("recharge_type", "min_number", "scale"), ["recharge_type"], "min_number").select("recharge_type", "low", "high", "scale")
    rated = range_lookup(month, fixed_tiers, ["recharge_type"], "month_cents", "low", "high")
    fixed = rest.join(rated, ["ym", "member_id", "recharge_type"])
    return reduce(DataFrame.unionByName, [result(approved, REBATE_APPROVED), result(special, REBATE_SPECIAL), result(fixed, REBATE_FIXED)])


def sub_rebate(counted: DataFrame, monthly: DataFrame, cumulative: DataFrame, promoters: DataFrame, own_rule: DataFrame | None, subs_rule: DataFrame) -> DataFrame:
    """Rebate on the recharge of direct sub-promoters.

    Members qualify by their own month and to-date amounts (rule 3), else by the number of subs above a monthly amount
    (rule 4). ``counted`` are the amounts that rebates are paid on; ``own_rule`` None leaves rule 3 out.
    All amounts (member_id, ym, cents); rules per month: (ym, month_number, accumulated_number, scale) and
    (ym, sub_month_number, sub_number, scale).
    """
    links = promoters.select("member_id", "owner_id").filter("owner_id <> 0")
    below = counted.join(links, "member_id").groupBy(F.col("owner_id").alias("member_id"), "ym").agg(
        F.count("*").alias("subs"), F.sum("cents").alias("sub_cents"))
    own = counted.select("member_id", "ym").join(monthly, ["member_id", "ym"]).join(
        cumulative.select("member_id", "ym", F.col("cents").alias("to_date_cents")), ["member_id", "ym"])
    own = own.join(below, ["member_id", "ym"], "left").fillna(0, ["subs", "sub_cents"])
    def paid(rows, number):
        return rows.select("member_id", "ym", "cents", "to_date_cents", "subs", "sub_cents", F.lit(number).alias("rebate_type"), "scale",
                           F.round(F.col("sub_cents") * F.col("scale") / 100).cast("long").alias("rebate_cents"))
    qualified = None
    if own_rule is not None:
        hit = own.join(own_rule, "ym").filter("cents >= month_number and to_date_cents >= accumulated_number")
        qualified = paid(hit, RULE_OWN)
    strong = monthly.join(links, "member_id").join(subs_rule, "ym").filter("cents >= sub_month_number").groupBy(
        F.col("owner_id").alias("member_id"), "ym", "sub_number", "scale").agg(F.count("*").alias("strong")).filter(F.col("strong") >= F.col("sub_number"))
    by_subs = own.join(strong.select("member_id", "ym", "scale"), ["member_id", "ym"])
    if qualified is None:
        return paid(by_subs, RULE_OWN)
    rest = by_subs.join(qualified.select("member_id", "ym"), ["member_id", "ym"], "left_anti")
    return qualified.unionByName(paid(rest, RULE_SUBS))


def device_ownership(logins: DataFrame, regs: DataFrame, orders: DataFrame, device: str = "imei") -> DataFrame:
    """The package a device belongs to, its latest activities, recharge, and until when it is valid.

    The first package seen with a device owns it; activity under other packages is ignored. Valid until 15 days after the latest activity.
    """
    rows = lambda df, ts, **c: df.filter(valid_device(device) & (F.col("package") != "")).select(device, "package", F.col(ts).alias("_ts"), F.to_date(ts).alias("_day"), *[v.alias(k) for k, v in c.items()])
    none, zero = F.lit(None).cast("date"), F.lit(0).cast("long")
    every = reduce(DataFrame.unionByName, [
        rows(logins, "login_ts", login=F.to_date("login_ts"), regi=none, recharge=none, cents=zero),
        rows(regs, "reg_ts", login=none, regi=F.to_date("reg_ts"), recharge=none, cents=zero),
        rows(orders, "order_ts", login=none, regi=none, recharge=F.to_date("order_ts"), cents=F.col("cents")),
    ])
    # per device and package first: a handful of rows per device remain to pick the owner from
    per = every.groupBy(device, "package").agg(
        F.min("_ts").alias("_first"), F.max("login").alias("last_login"), F.max("regi").alias("last_regi"), F.max("recharge").alias("last_recharge"),
        F.sum("cents").alias("recharge_cents"), F.date_add(F.max("_day"), DEVICE_VALID_DAYS).alias("valid_until"))
    return first_row(per, [device], ["_first", "package"]).drop("_first")


def sub_package_stats(actives: DataFrame, regs: DataFrame, logins: DataFrame, orders: DataFrame, keys: list[str]) -> DataFrame:
    """Devices, addresses, accounts, payments and new payers per day and promotion package.

    Each input is read once: its rows name their entities by kind, one aggregate makes them distinct, one counts them.
    """
    by = [*keys, "day"]
    device, account = F.when(valid_device("imei"), F.col("imei")), F.col("account")
    born = regs.select("account", F.col("reg_day").alias("day"), F.lit(True).alias("_new")).distinct()
    paid = orders.filter("status = 4").join(born, ["account", "day"], "left")
    def named(df, cents=None, **kinds):
        entities = F.array(*[F.struct(F.lit(kind).alias("kind"), entity.cast("string").alias("entity")) for kind, entity in kinds.items()])
        return df.select(*by, (F.lit(0) if cents is None else F.col(cents)).cast("long").alias("cents"), F.inline(entities))
    rows = (
        named(actives, active_devices=device, active_ips=F.col("ip"))
        .unionByName(named(regs.withColumn("day", F.col("reg_day")), regi_accounts=account, regi_devices=device))
        .unionByName(named(logins, login_accounts=account, login_devices=device))
        .unionByName(named(paid, "cents", pay_accounts=account, pay_devices=device, new_pay_accounts=F.when(F.col("_new"), account)))
    )
    per = rows.groupBy(*by, "kind", "entity").agg(F.sum("cents").alias("cents"), F.count("*").alias("n"))
    distinct = lambda kind: F.count_if((F.col("kind") == kind) & F.col("entity").isNotNull()).alias(kind)
    total = lambda measure, which, name: F.coalesce(F.sum(F.when(which, F.col(measure))), F.lit(0)).alias(name)
    paying, new = F.col("kind") == "pay_accounts", (F.col("kind") == "new_pay_accounts") & F.col("entity").isNotNull()
    kinds = ["active_devices", "active_ips", "regi_accounts", "regi_devices", "login_accounts", "login_devices", "pay_devices", "new_pay_accounts"]
    return per.groupBy(*by).agg(*map(distinct, kinds), total("cents", paying, "pay_cents"), total("n", paying, "orders"), total("cents", new, "new_pay_cents"))


def common_sdk_daily(accounts: DataFrame, logins: DataFrame, orders: DataFrame) -> DataFrame:
    """New accounts, active users, payers and amounts; those of an account's first paying day count as new.

    ``accounts`` (account, game_id, channel_id, reg_day), ``logins`` and ``orders`` of these accounts with the same keys.
    """
    by = ["game_id", "channel_id", "day"]
    paid = orders.groupBy("account", *by).agg(F.sum("cents").alias("cents"))
    first = first_day_rows(paid, ["account"], "day")
    parts = [
        count_distinct(accounts.withColumn("day", F.col("reg_day")), by, ["account"], "new_accounts"), count_distinct(logins, by, ["account"], "active_users"),
        first.groupBy(*by).agg(F.count("*").alias("new_payers"), F.sum("cents").alias("new_pay_cents")),
        paid.groupBy(*by).agg(F.count("*").alias("payers"), F.sum("cents").alias("pay_cents")),
    ]
    return zero_filled_union(parts, by, ["new_accounts", "active_users", "new_payers", "new_pay_cents", "payers", "pay_cents"])


def common_sdk_area(orders: DataFrame) -> DataFrame:
    by = ["game_id", "channel_id", "day", "area"]
    return orders.groupBy(*by, "account").agg(F.sum("cents").alias("cents")).groupBy(*by).agg(F.count("*").alias("payers"), F.sum("cents").alias("pay_cents"))
