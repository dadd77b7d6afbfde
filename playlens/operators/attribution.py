"""Ad attribution: click -> activation -> registration -> order, and the reports built on it."""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.functions.cleanse import valid_device, zero_ratio
from playlens.operators.activity import new_devices
from playlens.operators.aggregates import subtract, zero_filled_union
from playlens.operators.keyed import asof_latest, first_row, last_row, match_once
from playlens.session import write_stage

# --- fixed values: matching chains by platform (1 Android, 2 iOS), best evidence first ----------
CHAINS = {
    2: [["device"], ["ip", "dev_type", "sys_version"], ["ip", "dev_type"], ["ip"]],
    1: [["device"], ["android_id"]],
}
CLICK_DAYS, ACTIVATION_DAYS = 6, 30
ANDROID = 1
AD_MEASURES = ["clicks", "click_devices", "actives", "regis", "regi_devices", "new_regi_devices", "pay_cents", "payers", "new_payers", "new_pay_cents"]
# ------------------------------------------------------------------------------------------------


def device_name(device: str = "device") -> Column:
    """What a device is known by, or null. An Android device without a usable ``device`` is known by its android id."""
    return F.when(valid_device(device), F.col(device)).when(
        (F.col("os") == ANDROID) & (F.col("android_id") != ""), F.concat(F.lit("android:"), F.col("android_id")))


def first_activations(actives: DataFrame, device: str = "device") -> DataFrame:
    """A device activates once per game, ever."""
    rows = actives.withColumn("_known", device_name(device)).filter(F.col("_known").isNotNull())
    return first_row(rows, ["game_id", "_known"], ["active_ts", "active_id"]).drop("_known")


def attribute_activation(actives: DataFrame, clicks: DataFrame, days: int = CLICK_DAYS, chains=CHAINS) -> DataFrame:
    """(active_id, click_id, rule): each activation with its click, each click used once.

    Rule by rule, best evidence first; within a rule activations in order of time each take the latest
    free click of the same game and the ``days`` before. What matched leaves both sides before the next rule.
    Both inputs carry game_id, os, the fields of the rules, an id and a time.
    """
    a, c = _narrow(actives, clicks, chains)
    found: DataFrame | None = None
    for step in range(_steps(chains)):
        won = _rule(a, c, found, step, days, chains)
        found = won if found is None else found.unionByName(won)
    return found


def _steps(chains) -> int:
    return max(len(chain) for chain in chains.values())


def _narrow(actives: DataFrame, clicks: DataFrame, chains) -> tuple[DataFrame, DataFrame]:
    """What all rules read, written once."""
    fields = sorted({f for chain in chains.values() for rule in chain for f in rule})
    narrow = lambda df, ident, ts: df.select("game_id", "os", *fields, ident, ts)
    return write_stage(narrow(actives, "active_id", "active_ts"), "attribution-actives"), write_stage(narrow(clicks, "click_id", "click_ts"), "attribution-clicks")


def _rule(actives: DataFrame, clicks: DataFrame, taken: DataFrame | None, step: int, days: int, chains) -> DataFrame:
    """Matches of one step of the chains among what ``taken`` has not matched; the platforms' rules of a step go together."""
    # the evidence is one text, null when a part lacks
    evidence = F.lit(None).cast("string")
    for os, chain in chains.items():
        if step < len(chain):
            parts = [F.when(F.col(f) != "", F.col(f)) for f in chain[step]]
            evidence = F.when(F.col("os") == os, F.concat(*[x for p in parts for x in (p, F.lit("\x1f"))])).otherwise(evidence)
    usable = lambda df: df.withColumn("evidence", evidence).filter(F.col("evidence").isNotNull())
    free_a, free_c = usable(actives), usable(clicks)
    if taken is not None:
        free_a = free_a.join(taken.select("active_id"), "active_id", "left_anti")
        free_c = free_c.join(taken.select("click_id"), "click_id", "left_anti")
    won = match_once(free_a, free_c, ["os", "game_id", "evidence"], ("active_ts", "active_id"), ("click_ts", "click_id"), days)
    # written, as every later rule reads it twice
    return write_stage(won.withColumn("rule", F.lit(step + 1)), f"attribution-rule-{step + 1}")


def first_changed_day(since: date, step: int, days: int) -> date:
    """The first day whose matches by the rule of ``step`` (from 0) can change when events of ``since`` and later do.

    Activations from ``since`` on take clicks of the ``days`` before, which the next rule then may or may not use.
    """
    return since - timedelta(days=days * step)


def days_needed(since: date, days: int = CLICK_DAYS, chains=CHAINS) -> date:
    """The first day of clicks, activations and matches that :func:`rematch` reads."""
    return first_changed_day(since, _steps(chains), days)


def rematch(actives: DataFrame, clicks: DataFrame, known: DataFrame, since: date, days: int = CLICK_DAYS, chains=CHAINS) -> DataFrame:
    """Matches (active_id, click_id, rule, day) anew, after events of ``since`` and later days came or went.

    ``known`` are the matches before, with the day of the activation. All inputs need only reach back to
    :func:`days_needed`. What the rules matched before their first changed day stands, and its clicks are gone. A rule starts
    there with the clicks of the ``days`` before that are still free: older ones could not be taken any more. So the
    result equals :func:`attribute_activation` over everything, for activations since the last rule's first changed day.
    """
    a, c = _narrow(actives, clicks, chains)
    old = write_stage(known.select("active_id", "click_id", "rule", "day"), "attribution-known")
    steps, by_day = _steps(chains), a.select("active_id", F.to_date("active_ts").alias("day"))
    final: DataFrame | None = None
    for step in range(steps):
        first = F.lit(first_changed_day(since, step, days))
        stands = old.filter((F.col("rule") == step + 1) & (F.col("day") < first))
        taken = stands if final is None else final.unionByName(stands)
        won = _rule(a.filter(F.to_date("active_ts") >= first), c.filter(F.to_date("click_ts") >= F.date_sub(first, days)), taken.drop("day"), step, days, chains)
        final = taken.unionByName(won.join(by_day, "active_id").select(*taken.columns))
    return final.filter(F.col("day") >= F.lit(first_changed_day(since, steps - 1, days)))


def attributed_activations(actives: DataFrame, clicks: DataFrame, matches: DataFrame, click_fields: list[str]) -> DataFrame:
    """Matched activations with the fields of their click."""
    won = matches.join(clicks.select("click_id", "click_ts", *[F.col(f).alias(f"click_{f}") for f in click_fields]), "click_id")
    return actives.join(won, "active_id")


def attribute_registration(regs: DataFrame, activations: DataFrame, carried: list[str], days: int = ACTIVATION_DAYS) -> DataFrame:
    """First registration of each account with its activation: by device, else by Android id.

    ``activations`` hold one row per game and device. A registration counts up to ``days`` days after the
    activation; ``new_device`` tells that both fell on one day.
    """
    accounts = first_row(regs, ["account"], ["reg_ts", "reg_id"])
    fields = ["active_id", *carried]
    act = activations.select("game_id", "device", "android_id", "active_ts", *fields)
    timely = (F.col("reg_ts") >= F.col("active_ts")) & (F.datediff("reg_ts", "active_ts") <= days)
    known = accounts.filter(valid_device("device"))
    by_device = known.join(act.drop("android_id"), ["game_id", "device"]).filter(timely).withColumn("rule", F.lit(1))
    rest = accounts.join(by_device.select("account"), "account", "left_anti").filter(F.col("android_id") != "")
    usable = act.drop("device").filter(F.col("android_id") != "")
    by_android = asof_latest(rest, usable, ["game_id", "android_id"], "reg_ts", "active_ts", fields, ["active_id"]).filter(timely).withColumn("rule", F.lit(2))
    return by_device.unionByName(by_android).withColumn("new_device", F.to_date("reg_ts") == F.to_date("active_ts"))


def attribute_order(orders: DataFrame, registrations: DataFrame, carried: list[str]) -> DataFrame:
    """Orders of attributed accounts, each order once; ``new_payer`` when paid on the registration day."""
    once = orders.dropDuplicates(["account", "order_no", "order_ts"])
    owners = registrations.select("account", F.to_date("reg_ts").alias("reg_day"), *carried)
    return once.join(owners, "account").withColumn("new_payer", F.col("reg_day") == F.to_date("order_ts"))


def refresh_clicks(clicks: DataFrame, used: DataFrame, keys: list[str]) -> DataFrame:
    """Free clicks, only the latest of each device (its time and package replace earlier ones), with their number."""
    free = clicks.join(used.select("click_id"), "click_id", "left_anti")
    counts = free.groupBy(*keys).agg(F.count("*").alias("clicks"))
    return last_row(free, keys, ["click_ts", "click_id"]).join(counts, keys)


def ad_channel_stats(clicks: DataFrame, activations: DataFrame, regs: DataFrame, orders: DataFrame, keys: list[str]) -> DataFrame:
    """All stages of attributed traffic per day and ``keys`` (game, package, creative levels). Inputs carry ``day``.

    One cube: every source is read once, summed per (keys, day, stage, entity), and these rows once more per (keys, day).
    """
    by = [*keys, "day"]
    none, device = F.lit(None).cast("string"), F.when(valid_device("device"), F.col("device"))
    def facts(df, stage, entity=none, new=F.lit(False), cents=F.lit(0).cast("long")):
        return df.select(*by, F.lit(stage).alias("stage"), entity.alias("entity"), new.alias("new"), cents.alias("cents"))
    whole = facts(clicks, "click", device).unionByName(facts(activations, "active")).unionByName(
        facts(regs, "regi", device, F.col("new_device"))).unionByName(facts(orders, "pay", F.col("account"), F.col("new_payer"), F.col("cents")))
    new_cents = F.sum(F.when(F.col("new"), F.col("cents")).otherwise(0))
    entities = whole.groupBy(*by, "stage", "entity").agg(F.count(F.lit(1)).alias("n"), F.max("new").alias("new"), F.sum("cents").alias("cents"), new_cents.alias("new_cents"))
    at = lambda stage, value=F.lit(1), cond=F.lit(True): F.coalesce(F.sum(F.when((F.col("stage") == stage) & cond, value)), F.lit(0)).cast("long")
    known, new = F.col("entity").isNotNull(), F.col("new")
    return entities.groupBy(*by).agg(
        at("click", F.col("n")).alias("clicks"), at("click", cond=known).alias("click_devices"), at("active", F.col("n")).alias("actives"),
        at("regi", F.col("n")).alias("regis"), at("regi", cond=known).alias("regi_devices"), at("regi", cond=known & new).alias("new_regi_devices"),
        at("pay", F.col("cents")).alias("pay_cents"), at("pay").alias("payers"), at("pay", cond=new).alias("new_payers"), at("pay", F.col("new_cents")).alias("new_pay_cents"))


def natural_kpi(total: DataFrame, attributed: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """What advertising does not explain: total less attributed."""
    part = attributed.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])
    return subtract(total, part, keys, measures)


def merged_ad_kpi(total: DataFrame, attributed: DataFrame, keys: list[str], split: list[str], measures: list[str]) -> DataFrame:
    """Attributed rows per package and one natural row per game and day in one table."""
    natural = natural_kpi(total, attributed, keys, measures)
    natural = natural.select(*keys, *[F.lit("").alias(c) for c in split], *measures, F.lit(True).alias("is_natural"))
    return attributed.select(*keys, *split, *measures, F.lit(False).alias("is_natural")).unionByName(natural)


# --- fixed values: measures of the merged table ---------------------------------------------------
MERGED_DEVICES = ["actives", "active_regi_devices", "second_login_devices", "regi_devices", "new_regi_devices", "pay_devices", "new_pay_devices",
                  "retained_1", "retained_3", "retained_7"]
MERGED_SUMS = ["requests", "downloads", "pay_cents", "new_pay_cents"]
MERGED_VIEWERS = {"requests": "request_uv", "downloads": "download_uv"}
MERGED_OFFSETS = {1: "retained_1", 2: "retained_3", 6: "retained_7"}  # days after registration
MERGED = [*MERGED_SUMS, *MERGED_VIEWERS.values(), *MERGED_DEVICES]
# --------------------------------------------------------------------------------------------------


def merged_ad_facts(landings: DataFrame, actives: DataFrame, regs: DataFrame, orders: DataFrame, logins: DataFrame, new_regs: DataFrame) -> DataFrame:
    """Facts of the merged table: scope, game_id, day, package, measure, entity, cents.

    ``landings`` (type, ip), ``actives`` (active_id, device), ``regs`` (device) and ``orders`` (device, new_payer, cents) carry scope
    (``ad``, or ``all`` without a package), game_id, day and package, so that both scopes meet logins and first registrations in one pass;
    ``logins`` (game_id, device, day); ``new_regs`` (game_id, device, day): the first registration of a device for a game.
    """
    place = ["scope", "game_id", "day", "package"]
    def facts(df, *measures):
        """One row per measure whose condition holds, from one reading of ``df``: (measure, condition, entity, cents)."""
        held = [F.when(cond, F.struct(F.lit(m).alias("measure"), entity.cast("string").alias("entity"), cents.alias("cents"))) for m, cond, entity, cents in measures]
        return df.select(*place, F.inline(F.array(*held))).filter("measure IS NOT NULL")
    device, always, one, none = F.col("device"), F.lit(True), F.lit(1).cast("long"), F.lit(0).cast("long")
    has = valid_device("device")
    reg_days = regs.filter(has).select(*place, "device").distinct()
    born = new_regs.select("game_id", "device", F.col("day").alias("born"))
    known = reg_days.join(born, ["game_id", "device"], "left").withColumn("is_first", F.coalesce(F.col("born") == F.col("day"), F.lit(False)))
    per_day = logins.filter(has).groupBy("game_id", "device", F.col("day").alias("login_day")).agg(F.count(F.lit(1)).alias("times"))
    # only the days that count meet the logins
    looked = known.filter("is_first").withColumn("dur", F.explode(F.array(*map(F.lit, (0, *MERGED_OFFSETS)))))
    back = looked.withColumn("login_day", F.date_add("day", F.col("dur"))).join(per_day, ["game_id", "device", "login_day"])
    come_back = reg_days.select("scope", "game_id", "day", "device").distinct()
    payer = F.when(has, device)
    parts = [
        facts(landings, ("requests", F.col("type") == 4, F.col("ip"), one), ("downloads", F.col("type") == 2, F.col("ip"), one)),
        facts(actives, ("actives", always, F.col("active_id"), none)),
        facts(actives.filter(has).join(come_back, ["scope", "game_id", "day", "device"], "left_semi"), ("active_regi_devices", always, device, none)),
        facts(known, ("regi_devices", always, device, none), ("new_regi_devices", F.col("is_first"), device, none)),
        facts(back, ("second_login_devices", (F.col("dur") == 0) & (F.col("times") >= 2), device, none), *[(name, F.col("dur") == n, device, none) for n, name in MERGED_OFFSETS.items()]),
        facts(orders, ("pay_cents", always, payer, F.col("cents")), ("pay_devices", payer.isNotNull(), payer, none),
              ("new_pay_cents", F.col("new_payer"), payer, F.col("cents")), ("new_pay_devices", F.col("new_payer") & payer.isNotNull(), payer, none)),
    ]
    return reduce(DataFrame.unionByName, parts)


def merged_ad_table(facts: DataFrame) -> DataFrame:
    """Attributed rows per package, and a natural row per game and day: all less attributed, in the same two aggregates.

    Rows without any measure are left out.
    """
    place = ["scope", "game_id", "day", "package"]
    entities = facts.groupBy(*place, "measure", "entity").agg(F.sum("cents").alias("cents"))
    at = lambda name, value: F.coalesce(F.sum(F.when(F.col("measure") == name, value)), F.lit(0)).cast("long")
    columns = [at(m, F.col("cents")).alias(m) for m in MERGED_SUMS] + [at(m, F.lit(1)).alias(uv) for m, uv in MERGED_VIEWERS.items()] + [at(m, F.lit(1)).alias(m) for m in MERGED_DEVICES]
    sums = entities.groupBy(*place).agg(*columns)
    # an attributed row is itself, and taken off its game's natural row
    rows = F.array(F.struct(F.col("package").alias("of"), F.lit(False).alias("is_natural"), F.lit(1).alias("sign")), F.struct(F.lit("").alias("of"), F.lit(True).alias("is_natural"), F.lit(-1).alias("sign")))
    natural = F.array(F.struct(F.lit("").alias("of"), F.lit(True).alias("is_natural"), F.lit(1).alias("sign")))
    both = sums.select("*", F.inline(F.when(F.col("scope") == "ad", rows).otherwise(natural)))
    return both.groupBy("game_id", "day", F.col("of").alias("package"), "is_natural").agg(
        *[F.sum(F.col(m) * F.col("sign")).alias(m) for m in MERGED]).filter(" or ".join(f"{m} <> 0" for m in MERGED))


def ad_device_cohorts(regs: DataFrame, logins: DataFrame, orders: DataFrame, keys: list[str], offsets=(1, 2, 6, 29), days=(1, 2, 3, 7)) -> DataFrame:
    """Attributed devices by the day of their first registration under the keys: who came back under the same keys, and
    what they paid there since: ``ltv_n`` over n days, all (``total_cents``), and paying devices.

    ``regs`` (keys, device, reg_day), ``logins`` (keys, device, day), ``orders`` (keys, device, day, cents).
    """
    from playlens.operators.cohort import cohort_days  # cohorts build on activity, and activity on matching
    on = [*keys, "device"]
    known = valid_device("device")
    members = regs.filter(known).groupBy(*on).agg(F.min("reg_day").alias("reg_day"))
    back = cohort_days(members, logins, on, keys, ["device"], "reg_day", "day", offsets)
    spent = orders.filter(known).groupBy(*on, "day").agg(F.sum("cents").alias("cents"))
    paid = members.join(spent, on).withColumn("dur", F.datediff("day", "reg_day")).filter("dur >= 0")
    by = [*keys, "reg_day"]
    come = back.groupBy(*by).agg(*[F.count(F.when(F.col("dur") == n, 1)).alias(f"retained_{n}") for n in offsets])
    per_device = paid.groupBy(*by, "device").agg(*[F.sum(F.when(F.col("dur") < n, F.col("cents")).otherwise(0)).alias(f"ltv_{n}") for n in days], F.sum("cents").alias("total_cents"))
    value = per_device.groupBy(*by).agg(*[F.sum(f"ltv_{n}").alias(f"ltv_{n}") for n in days], F.sum("total_cents").alias("total_cents"), F.count(F.lit(1)).alias("paying_devices"))
    size = members.groupBy(*by).agg(F.count(F.lit(1)).alias("devices"))
    measures = ["devices", *[f"retained_{n}" for n in offsets], *[f"ltv_{n}" for n in days], "total_cents", "paying_devices"]
    return zero_filled_union([size, come, value], by, measures)


def natural_cohorts(every: DataFrame, attributed: DataFrame, logins: DataFrame, orders: DataFrame, keys: list[str], days=(1, 7, 30)) -> DataFrame:
    """Retention, value, all money and paying accounts of the cohorts of ``every``, less those of ``attributed``.

    Both (keys, account, reg_day). An account's share of either is its own, so one pass over logins and orders serves both: each
    cohort row carries +1 where it is one of all, -1 where it is attributed.
    """
    from playlens.operators.cohort import REALTIME_OFFSETS, cohort_days
    member = ["account", *keys, "reg_day"]
    signed = every.select(*member).distinct().withColumn("sign", F.lit(1)).unionByName(attributed.select(*member).distinct().withColumn("sign", F.lit(-1)))
    by = [*keys, "reg_day"]
    natural = signed.groupBy(*member).agg(F.sum("sign").alias("sign"))
    back = natural.join(cohort_days(natural, logins, ["account"], by, ["account"], "reg_day", "day", REALTIME_OFFSETS), ["account", *by])
    come = back.groupBy(*by).agg(*[F.sum(F.when(F.col("dur") == n, F.col("sign")).otherwise(0)).alias(f"retained_{n}") for n in REALTIME_OFFSETS])
    spent = orders.groupBy("account", "day").agg(F.sum("cents").alias("cents"))
    paid = natural.join(spent, "account").withColumn("dur", F.datediff("day", "reg_day"))
    worth = F.col("cents") * F.col("sign")
    each = paid.groupBy(*member, "sign").agg(*[F.sum(F.when(F.col("dur").between(0, n - 1), worth).otherwise(0)).alias(f"recharge_{n}") for n in days], F.sum(worth).alias("recharge_total"))
    value = each.groupBy(*by).agg(*[F.sum(f"recharge_{n}").alias(f"recharge_{n}") for n in days], F.sum("recharge_total").alias("recharge_total"), F.sum("sign").alias("recharge_accounts"))
    cohorts = every.select(*by).distinct()
    return zero_filled_union([cohorts, come, value], by, [*[f"retained_{n}" for n in REALTIME_OFFSETS], *[f"recharge_{n}" for n in days], "recharge_total", "recharge_accounts"])


def reward_network_audit(reports: DataFrame, actives: DataFrame, regs: DataFrame) -> DataFrame:
    """Activations a reward network reports, checked against our own logs, per game and day.

    reported: reports; unique: distinct devices; matched: activated with us that day; unmatched: never
    activated up to that day; repeat_both / repeat_own: activated with us before, and reported before or
    not required; registered, new_registered: registered that day, and for the first time. Sums for the
    network and what remains: ``natural`` = all activations less matched, at least zero.
    """
    keys = ["game_id", "imei", "day"]
    daily = reports.groupBy(*keys).agg(F.count("*").alias("reports"))
    own_days = actives.select(*keys).distinct()
    own_first = actives.groupBy("game_id", "imei").agg(F.min("day").alias("own_first"))
    reported_first = reports.groupBy("game_id", "imei").agg(F.min("day").alias("reported_first"))
    reg_days = regs.select("game_id", "imei", F.col("reg_day").alias("day")).distinct()
    reg_first = regs.groupBy("game_id", "imei").agg(F.min("reg_day").alias("reg_first"))
    seen = (
        daily.join(own_days.withColumn("own", F.lit(True)), keys, "left").join(own_first, ["game_id", "imei"], "left")
        .join(reported_first, ["game_id", "imei"]).join(reg_days.withColumn("reg", F.lit(True)), keys, "left")
        .join(reg_first, ["game_id", "imei"], "left")
    )
    matched = F.col("own").isNotNull()
    unmatched = ~matched & (F.col("own_first").isNull() | (F.col("own_first") > F.col("day")))
    repeat = ~matched & (F.col("own_first") < F.col("day"))
    again = repeat & (F.col("reported_first") < F.col("day"))
    registered = F.col("reg").isNotNull()
    n = lambda cond, name: F.sum(F.when(cond, 1).otherwise(0)).cast("long").alias(name)
    audit = seen.groupBy("game_id", "day").agg(
        F.sum("reports").alias("reported"), F.count("*").alias("unique_devices"), n(matched, "matched"), n(unmatched, "unmatched"),
        n(repeat, "repeat_own"), n(again, "repeat_both"), n(registered, "registered"),
        n(registered & (F.col("reg_first") == F.col("day")), "new_registered"),
    )
    total = own_days.groupBy("game_id", "day").agg(F.count("*").alias("active_devices"))
    out = audit.join(total, ["game_id", "day"], "left").fillna(0, ["active_devices"])
    return out.withColumn("natural", F.greatest(F.col("active_devices") - F.col("matched"), F.lit(0)))


def repair_new_device(details: DataFrame, keys: list[str], device: str = "imei") -> DataFrame:
    """Detail rows with the new-device flag computed afresh from all rows."""
    first = new_devices(details, keys, device).select(*keys, device, F.col("day").alias("_first"))
    return details.join(first, [*keys, device], "left").withColumn(
        "is_new_device", F.coalesce(F.col("reg_day") == F.col("_first"), F.lit(False))).drop("_first")


def ad_click_detail(clicks: DataFrame, networks: list[int], media: DataFrame, buyers: DataFrame) -> DataFrame:
    """Clicks of the given networks with the tag, the medium's name and the buyer."""
    chosen = clicks.filter(F.col("network").isin(networks))
    return chosen.join(media, "network", "left").join(buyers, "package", "left").fillna("", ["medium_tag", "medium_name", "buyer"])


def conversion_rates(stats: DataFrame) -> DataFrame:
    return stats.withColumns({"active_rate": zero_ratio("actives", "clicks"), "regi_rate": zero_ratio("regis", "actives"), "pay_rate": zero_ratio("payers", "regis")})
