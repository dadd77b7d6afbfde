"""Activity: activations, new devices and accounts, active users, clicks, funnel, sessions.

``start`` and ``end`` bound the days of a report, both included; the bounds reach the scans of its events. What is first ever needs all
history, unless ``firsts`` gives it: keys with ``first_ts`` and ``first_day``, as ``bounds.firsts_between`` reads them for these days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from playlens.functions.cleanse import time_bucket, valid_device, zero_ratio
from playlens.operators.aggregates import histogram, zero_filled_union
from playlens.operators.bounds import between_days
from playlens.operators.joins import calendar

# --- fixed values: report buckets ---------------------------------------------------------------
LOGIN_TIMES_EDGES = [1, 2, 3, 4, 5, 6, 11]
LOGIN_TIMES_NAMES = ["times_1", "times_2", "times_3", "times_4", "times_5", "times_6_10", "times_11"]
ACCOUNTS_EDGES = [1, 2, 6, 11, 21, 51, 101, 201]
ACCOUNTS_NAMES = ["acc_1", "acc_2_5", "acc_6_10", "acc_11_20", "acc_21_50", "acc_51_100", "acc_101_200", "acc_201"]
AGE_EDGES = [*range(15), 15, 30, 45, 60, 90, 120, 150, 180]
AGE_NAMES = [*[f"age_{n}" for n in range(1, 16)], "age_16_30", "age_31_45", "age_46_60", "age_61_90", "age_91_120",
             "age_121_150", "age_151_180", "age_181"]
CLICK_SHOW, CLICK_DOWNLOAD, CLICK_PAGE, CLICK_REQUEST = 1, 2, 3, 4
CLICK_KINDS = {CLICK_SHOW: "show", CLICK_DOWNLOAD: "download", CLICK_PAGE: "page", CLICK_REQUEST: "request"}
# ------------------------------------------------------------------------------------------------


def first_seen(events: DataFrame, keys: list[str], ts: str, name: str = "first_ts") -> DataFrame:
    return events.groupBy(*keys).agg(F.min(ts).alias(name))


def _firsts(events: DataFrame, keys: list[str], ts: str, start: str | None, end: str | None, firsts: DataFrame | None) -> DataFrame:
    """Keys with ``first_ts`` and its ``day``, of the days."""
    found = first_seen(events, keys, ts) if firsts is None else firsts.select(*keys, "first_ts")
    return between_days(found.withColumn("day", F.to_date("first_ts")), "day", start, end)


def activation_kpi(actives: DataFrame, keys: list[str], grain: str, device: str = "imei",
                   start: str | None = None, end: str | None = None, firsts: DataFrame | None = None) -> DataFrame:
    """Devices by the bucket of their first activation for the key."""
    first = _firsts(actives.filter(valid_device(device)), [*keys, device], "active_ts", start, end, firsts)
    return first.groupBy(*keys, time_bucket("first_ts", grain).alias(grain)).agg(F.count("*").alias("active_devices"))


def new_devices(regs: DataFrame, keys: list[str], device: str = "imei",
                start: str | None = None, end: str | None = None, firsts: DataFrame | None = None) -> DataFrame:
    """Devices with the time of their first registration for the key: new on that day, never again."""
    return _firsts(regs.filter(valid_device(device)), [*keys, device], "reg_ts", start, end, firsts)


def new_device_kpi(regs: DataFrame, keys: list[str], grain: str, device: str = "imei",
                   start: str | None = None, end: str | None = None, firsts: DataFrame | None = None) -> DataFrame:
    new = new_devices(regs, keys, device, start, end, firsts)
    return new.groupBy(*keys, time_bucket("first_ts", grain).alias(grain)).agg(F.count("*").alias("new_devices"))


def new_account_kpi(regs: DataFrame, keys: list[str], device: str = "imei",
                    start: str | None = None, end: str | None = None, firsts: DataFrame | None = None) -> DataFrame:
    """Accounts registered on devices that are new that day."""
    new = new_devices(regs, keys, device, start, end, firsts).select(*keys, device, "day")
    same_day = between_days(regs, "reg_day", start, end).withColumn("day", F.col("reg_day")).join(new, [*keys, device, "day"], "left_semi")
    accounts = same_day.select(*keys, "day", "account").distinct()
    return accounts.groupBy(*keys, "day").agg(F.count("*").alias("new_accounts"))


def registered_device_kpi(regs: DataFrame, keys: list[str], device: str = "imei", start: str | None = None, end: str | None = None) -> DataFrame:
    regs = between_days(regs, "reg_day", start, end)
    seen = regs.filter(valid_device(device)).select(*keys, F.col("reg_day").alias("day"), device).distinct()
    return seen.groupBy(*keys, "day").agg(F.count("*").alias("registered_devices"))


def active_and_registered(regs: DataFrame, actives: DataFrame, keys: list[str], device: str = "imei",
                          start: str | None = None, end: str | None = None, firsts: DataFrame | None = None) -> DataFrame:
    """New devices that also activated on their day."""
    new = new_devices(regs, keys, device, start, end, firsts).select(*keys, device, "day")
    both = new.join(between_days(actives, "day", start, end).select(*keys, device, "day"), [*keys, device, "day"], "left_semi")
    return both.groupBy(*keys, "day").agg(F.count("*").alias("active_registered"))


def active_users(logins: DataFrame, keys: list[str], grain: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Distinct accounts and devices per bucket."""
    logins = between_days(logins, "day", start, end)
    bucket = time_bucket("login_ts", grain).alias(grain)
    def distinct(column, name):
        kept = logins.filter(F.col(column) != "").select(*keys, bucket, column).distinct()
        return kept.groupBy(*keys, grain).agg(F.count("*").alias(name))
    return zero_filled_union([distinct("account", "dau_accounts"), distinct("imei", "dau_devices")],
                             [*keys, grain], ["dau_accounts", "dau_devices"])


def trailing_users(logins: DataFrame, keys: list[str], start: str, end: str, days: int = 30) -> DataFrame:
    """For each day of the range, distinct accounts and devices of that day and the ``days`` before it.

    A seen day counts up to the day before the next one, so an entity counts once on each day: a step up where
    that span begins and one down after it. The steps are summed per key and day, then run up over the calendar.
    """
    lo, hi = F.lit(start).cast("date"), F.lit(end).cast("date")
    reaching = logins.filter(F.col("day").between(F.date_sub(lo, days), hi))
    def steps(column, name):
        seen = reaching.filter(F.col(column) != "").select(*keys, column, F.col("day").alias("_seen")).distinct()
        following = F.lead("_seen").over(W.partitionBy(*keys, column).orderBy("_seen"))
        spans = seen.select(*keys, F.greatest("_seen", lo).alias("_first"), F.least(F.date_add("_seen", days), hi, F.date_sub(following, 1)).alias("_last"))
        up, down = F.struct(F.col("_first").alias("day"), F.lit(1).alias("step")), F.struct(F.date_add("_last", 1).alias("day"), F.lit(-1).alias("step"))
        return spans.filter("_first <= _last").select(*keys, F.inline(F.array(up, down))).groupBy(*keys, "day").agg(F.sum("step").alias(name))
    names = ["mau_accounts", "mau_devices"]
    changes = zero_filled_union([steps("account", names[0]), steps("imei", names[1])], [*keys, "day"], names)
    spine = calendar(changes.select(*keys).distinct(), lo, hi).withColumns({n: F.lit(0).cast("long") for n in names})
    dense = zero_filled_union([spine, changes.filter(F.col("day") <= hi)], [*keys, "day"], names)
    upto = W.partitionBy(*keys).orderBy("day").rowsBetween(W.unboundedPreceding, 0)
    return dense.select(*keys, "day", *[F.sum(n).over(upto).alias(n) for n in names]).filter(" or ".join(f"{n} > 0" for n in names))


def new_login(regs: DataFrame, logins: DataFrame, keys: list[str], start: str | None = None, end: str | None = None,
              firsts: dict[str, DataFrame] | None = None) -> DataFrame:
    """New devices and accounts that logged in on their first day; ``firsts`` by entity (``imei``, ``account``)."""
    logins = between_days(logins, "day", start, end)
    def count(entity, name):
        known = firsts[entity] if firsts else None
        first = _firsts(regs.filter(F.col(entity) != ""), [*keys, entity], "reg_ts", start, end, known).select(*keys, entity, "day")
        seen = first.join(logins.select(*keys, entity, "day"), [*keys, entity, "day"], "left_semi")
        return seen.groupBy(*keys, "day").agg(F.count("*").alias(name))
    return zero_filled_union([count("imei", "new_login_devices"), count("account", "new_login_accounts")],
                             [*keys, "day"], ["new_login_devices", "new_login_accounts"])


def second_login_device(regs: DataFrame, logins: DataFrame, keys: list[str], device: str = "imei",
                        start: str | None = None, end: str | None = None, firsts: DataFrame | None = None) -> DataFrame:
    """New devices with at least two logins on their day."""
    logins = between_days(logins, "day", start, end)
    times = logins.filter(valid_device(device)).groupBy(*keys, device, "day").agg(F.count("*").alias("times")).filter("times >= 2")
    new = new_devices(regs, keys, device, start, end, firsts).select(*keys, device, "day")
    return times.join(new, [*keys, device, "day"], "left_semi").groupBy(*keys, "day").agg(F.count("*").alias("second_login_devices"))


def login_frequency_hist(logins: DataFrame, keys: list[str], regs: DataFrame | None = None, device: str = "imei",
                         start: str | None = None, end: str | None = None, firsts: DataFrame | None = None) -> DataFrame:
    """Devices by logins of the day; with ``regs`` only devices that are new that day."""
    times = between_days(logins, "day", start, end).groupBy(*keys, "day", device).agg(F.count("*").alias("times"))
    if regs is not None:
        new = new_devices(regs, keys, device, start, end, firsts).select(*keys, device, "day")
        times = times.join(new, [*keys, device, "day"], "left_semi")
    return histogram(times, [*keys, "day"], "times", LOGIN_TIMES_EDGES, LOGIN_TIMES_NAMES)


def accounts_per_device_hist(regs: DataFrame, keys: list[str], device: str = "imei", start: str | None = None, end: str | None = None) -> DataFrame:
    """Devices by accounts registered on a day; accounts without a usable device id beside them."""
    regs = between_days(regs, "reg_day", start, end)
    usable = F.when(valid_device(device), F.col(device)).otherwise("")
    rows = regs.select(*keys, F.col("reg_day").alias("day"), usable.alias("_dev"), "account").distinct()
    # the group without an id may be huge, but it is only counted
    counts = rows.groupBy(*keys, "day", "_dev").agg(F.count("*").alias("n"))
    has = F.col("_dev") != ""
    hist = histogram(counts, [*keys, "day"], "n", ACCOUNTS_EDGES, ACCOUNTS_NAMES, F.when(has, 1).otherwise(0))
    none = counts.groupBy(*keys, "day").agg(F.sum(F.when(has, 0).otherwise(F.col("n"))).alias("no_device_accounts"))
    return hist.join(none, [*keys, "day"])


def age_split(facts: DataFrame, regs: DataFrame, keys: list[str], measure: str | None = None, start: str | None = None, end: str | None = None) -> DataFrame:
    """Accounts (or the sum of ``measure``) per day by days since the account registered for the game.

    ``facts`` (keys, account, day[, measure]). Several registrations of one account each count in
    their own bucket, as in the report.
    """
    facts = between_days(facts, "day", start, end)
    born = regs.select(*keys, "account", "reg_day").distinct()
    if measure:
        daily = facts.groupBy(*keys, "account", "day").agg(F.sum(measure).alias("_m"))
    else:
        daily = facts.select(*keys, "account", "day").distinct().withColumn("_m", F.lit(1))
    aged = daily.join(born, [*keys, "account"], "left").withColumn("_age", F.datediff("day", "reg_day"))
    highs = [*AGE_EDGES[1:], None]
    bucket = None
    for low, high, name in zip(AGE_EDGES, highs, AGE_NAMES):
        inside = (F.col("_age") >= low) & (F.col("_age") < high) if high is not None else F.col("_age") >= low
        bucket = F.when(inside, name) if bucket is None else bucket.when(inside, name)
    labelled = aged.withColumn("_bucket", F.when(F.col("_age").isNull(), "age_unknown").otherwise(bucket)).filter(F.col("_bucket").isNotNull())
    if not measure:
        labelled = labelled.select(*keys, "day", "account", "_bucket", "_m").distinct()
    names = [*AGE_NAMES, "age_unknown"]
    return labelled.groupBy(*keys, "day").agg(*[F.sum(F.when(F.col("_bucket") == n, F.col("_m")).otherwise(0)).cast("long").alias(n) for n in names])


def online_time(online: DataFrame, keys: list[str], start: str | None = None, end: str | None = None) -> DataFrame:
    """Seconds online and sessions per day. Reports with one start are one session up to the latest end."""
    if start is not None:
        online = online.filter(F.col("start_ts") >= F.lit(start).cast("timestamp"))
    if end is not None:
        online = online.filter(F.col("start_ts") < F.date_add(F.lit(end).cast("date"), 1).cast("timestamp"))
    sessions = online.groupBy(*keys, "start_ts").agg(F.max("end_ts").alias("end_ts"))
    seconds = F.unix_timestamp("end_ts") - F.unix_timestamp("start_ts")
    return sessions.groupBy(*keys, F.to_date("start_ts").alias("day")).agg(F.sum(seconds).alias("online_seconds"), F.count("*").alias("sessions"))


def click_kpi(clicks: DataFrame, keys: list[str], start: str | None = None, end: str | None = None) -> DataFrame:
    """Views and distinct addresses per kind of click. Distinct rows are formed once for all kinds."""
    per_ip = between_days(clicks, "day", start, end).groupBy(*keys, "day", "type", "ip").agg(F.count("*").alias("pv"))
    columns = []
    for code, kind in CLICK_KINDS.items():
        hit = F.col("type") == code
        columns += [F.sum(F.when(hit, F.col("pv")).otherwise(0)).alias(f"{kind}_pv"), F.sum(F.when(hit, 1).otherwise(0)).cast("long").alias(f"{kind}_uv")]
    return per_ip.groupBy(*keys, "day").agg(*columns)


def publish_funnel(clicks: DataFrame, actives: DataFrame, regs: DataFrame, orders: DataFrame, keys: list[str],
                   start: str | None = None, end: str | None = None, owned: bool = False) -> DataFrame:
    """Show, download, page, request, activation, registration and payment in one table per day.

    Payments belong to every channel where the account registered; with ``owned`` to the one that owns the order
    (``payments.owned_orders``), so that the channels' sums are the revenue.
    """
    on_day = lambda df, day="day": between_days(df, day, start, end)
    one = F.lit(1).cast("long")
    kinds = on_day(clicks).select(*keys, "day", *[F.when(F.col("type") == c, one).alias(f"{k}s") for c, k in CLICK_KINDS.items()])
    active = on_day(actives).select(*keys, "day", one.alias("activations"))
    reg = on_day(regs, "reg_day").select(*keys, F.col("reg_day").alias("day"), one.alias("registrations"))
    paid = F.max(F.when(F.col("status") == 4, 1).otherwise(0)).alias("paid")
    if owned:
        from playlens.operators.payments import owned_orders
        daily = owned_orders(on_day(orders), regs, keys).groupBy(*keys, "account", "day").agg(F.sum("cents").alias("cents"), paid)
    else:
        home = regs.select(*keys, "account").distinct()
        daily = on_day(orders).groupBy("account", "day").agg(F.sum("cents").alias("cents"), paid).join(home, "account")
    pay = daily.select(*keys, "day", F.col("cents").alias("pay_cents"), F.col("paid").cast("long").alias("payers"))
    measures = [*[f"{k}s" for k in CLICK_KINDS.values()], "activations", "registrations", "pay_cents", "payers"]
    # rows of all sources are added up together, in each task first: one shuffle instead of one a source and another
    return zero_filled_union([kinds, active, reg, pay], [*keys, "day"], measures)


def sdk_daily_funnel(logins: DataFrame, homes: DataFrame, orders: DataFrame, keys: list[str], dim: DataFrame, start: str, end: str) -> DataFrame:
    """Active, new, paying users and four ratios for every key and day of the calendar.

    ``homes`` (account, keys) tells where an account belongs; a user is new on the first ever login day.
    """
    lo, hi = F.lit(start).cast("date"), F.lit(end).cast("date")
    days = logins.select("account", "day").distinct()
    placed = days.filter(F.col("day").between(lo, hi)).join(homes, "account")
    active = placed.groupBy(*keys, "day").agg(F.count("*").alias("active_users"))
    first = days.groupBy("account").agg(F.min("day").alias("day")).filter(F.col("day").between(lo, hi))
    paid_days = orders.select("account", "day").distinct().withColumn("_paid", F.lit(1))
    new = first.join(homes, "account").join(paid_days, ["account", "day"], "left")
    new = new.groupBy(*keys, "day").agg(F.count("*").alias("new_users"), F.coalesce(F.sum("_paid"), F.lit(0)).alias("new_payers"))
    pay = orders.groupBy(*keys, "day", "account").agg(F.sum("cents").alias("cents")).groupBy(*keys, "day").agg(
        F.count("*").alias("payers"), F.sum("cents").alias("pay_cents")).filter(F.col("day").between(lo, hi))
    spine = calendar(dim.select(*keys).distinct(), start, end)
    measures = ["active_users", "new_users", "new_payers", "payers", "pay_cents"]
    out = zero_filled_union([spine, active, new, pay], [*keys, "day"], measures)
    return out.withColumns({
        "new_pay_rate": zero_ratio("new_payers", "new_users"), "active_pay_rate": zero_ratio("payers", "active_users"),
        "cents_per_active": zero_ratio("pay_cents", "active_users"), "cents_per_payer": zero_ratio("pay_cents", "payers"),
    })
