"""Activity, clicks and funnels."""

from __future__ import annotations

from pyspark.sql import functions as F

from playlens.functions.cleanse import valid_orders
from playlens.operators import activity, bounds
from playlens.operators.aggregates import roll_up
from playlens.plans import plan
from playlens.session import work_folder
from playlens.sources import roles

PACKAGE = ["game_id", "medium", "site", "package"]
PK = ", ".join(PACKAGE)
NEW_DEV = "(SELECT {k}, imei, min(ts) AS first_ts, CAST(min(ts) AS DATE) AS day FROM g_regs WHERE imei <> '' GROUP BY {k}, imei)"


def _text_hour(df):
    """Hours as text, so that the check does not depend on time zones of clients."""
    return df.withColumn("hour", F.date_format("hour", "yyyy-MM-dd HH:mm:ss"))


HOUR = "strftime(date_trunc('hour', {}), '%Y-%m-%d %H:%M:%S') AS hour"


@plan("activation_kpi_hour_package", f"SELECT {PK}, {HOUR.format('first_ts')}, count(*) AS active_devices FROM (SELECT {PK}, imei, min(ts) AS first_ts FROM g_actives WHERE imei <> '' GROUP BY ALL) GROUP BY ALL")
def activation_kpi_hour_package(spark, sf):
    return _text_hour(activity.activation_kpi(roles.actives(spark, sf), PACKAGE, "hour"))


@plan("activation_kpi_day_package", f"SELECT {PK}, CAST(first_ts AS DATE) AS day, count(*) AS active_devices FROM (SELECT {PK}, imei, min(ts) AS first_ts FROM g_actives WHERE imei <> '' GROUP BY ALL) GROUP BY ALL")
def activation_kpi_day_package(spark, sf):
    """Rolled up from hours: first-seen rows add up over time."""
    hourly = activity.activation_kpi(roles.actives(spark, sf), PACKAGE, "hour")
    return roll_up(hourly.withColumn("day", F.to_date("hour")), [*PACKAGE, "day"], ["active_devices"])


@plan("activation_kpi_hour_game", f"SELECT game_id, {HOUR.format('first_ts')}, count(*) AS active_devices FROM (SELECT game_id, imei, min(ts) AS first_ts FROM g_actives WHERE imei <> '' GROUP BY ALL) GROUP BY ALL")
def activation_kpi_hour_game(spark, sf):
    return _text_hour(activity.activation_kpi(roles.actives(spark, sf), ["game_id"], "hour"))


@plan("activation_kpi_day_game", "SELECT game_id, CAST(first_ts AS DATE) AS day, count(*) AS active_devices FROM (SELECT game_id, imei, min(ts) AS first_ts FROM g_actives WHERE imei <> '' GROUP BY ALL) GROUP BY ALL")
def activation_kpi_day_game(spark, sf):
    return activity.activation_kpi(roles.actives(spark, sf), ["game_id"], "day")


@plan("new_device_kpi_package", f"SELECT {PK}, day, count(*) AS new_devices FROM {NEW_DEV.format(k=PK)} GROUP BY ALL")
def new_device_kpi_package(spark, sf):
    return activity.new_device_kpi(roles.regs(spark, sf), PACKAGE, "day")


@plan("new_device_kpi_game", f"SELECT game_id, day, count(*) AS new_devices FROM {NEW_DEV.format(k='game_id')} GROUP BY ALL")
def new_device_kpi_game(spark, sf):
    return activity.new_device_kpi(roles.regs(spark, sf), ["game_id"], "day")


@plan("new_device_kpi_package_hour", f"SELECT {PK}, {HOUR.format('first_ts')}, count(*) AS new_devices FROM {NEW_DEV.format(k=PK)} GROUP BY ALL")
def new_device_kpi_package_hour(spark, sf):
    return _text_hour(activity.new_device_kpi(roles.regs(spark, sf), PACKAGE, "hour"))


@plan("new_device_kpi_game_hour", f"SELECT game_id, {HOUR.format('first_ts')}, count(*) AS new_devices FROM {NEW_DEV.format(k='game_id')} GROUP BY ALL")
def new_device_kpi_game_hour(spark, sf):
    return _text_hour(activity.new_device_kpi(roles.regs(spark, sf), ["game_id"], "hour"))


@plan("new_account_kpi", f"SELECT r.game_id, r.day, count(DISTINCT r.account) AS new_accounts FROM g_regs r JOIN {NEW_DEV.format(k='game_id')} n ON n.game_id = r.game_id AND n.imei = r.imei AND n.day = r.day GROUP BY ALL")
def new_account_kpi(spark, sf):
    return activity.new_account_kpi(roles.regs(spark, sf), ["game_id"])


@plan("registered_device_kpi", f"SELECT {PK}, day, count(DISTINCT imei) AS registered_devices FROM g_regs WHERE imei <> '' GROUP BY ALL")
def registered_device_kpi(spark, sf):
    return activity.registered_device_kpi(roles.regs(spark, sf), PACKAGE)


@plan("active_and_registered", f"SELECT game_id, day, count(*) AS active_registered FROM {NEW_DEV.format(k='game_id')} n WHERE EXISTS (SELECT 1 FROM g_actives a WHERE a.game_id = n.game_id AND a.imei = n.imei AND a.day = n.day) GROUP BY ALL")
def active_and_registered(spark, sf):
    return activity.active_and_registered(roles.regs(spark, sf), roles.actives(spark, sf), ["game_id"])


@plan("dau_day_package", f"SELECT {PK}, day, count(DISTINCT account) AS dau_accounts, count(DISTINCT CASE WHEN imei <> '' THEN imei END) AS dau_devices FROM g_logins GROUP BY ALL")
def dau_day_package(spark, sf):
    return activity.active_users(roles.logins(spark, sf), PACKAGE, "day")


@plan("dau_hour_game", f"SELECT game_id, {HOUR.format('ts')}, count(DISTINCT account) AS dau_accounts, count(DISTINCT CASE WHEN imei <> '' THEN imei END) AS dau_devices FROM g_logins GROUP BY ALL")
def dau_hour_game(spark, sf):
    return _text_hour(activity.active_users(roles.logins(spark, sf), ["game_id"], "hour"))


@plan("dau_day_game", "SELECT game_id, day, count(DISTINCT account) AS dau_accounts, count(DISTINCT CASE WHEN imei <> '' THEN imei END) AS dau_devices FROM g_logins GROUP BY ALL")
def dau_day_game(spark, sf):
    return activity.active_users(roles.logins(spark, sf), ["game_id"], "day")


@plan("dau_hour_package", f"SELECT {PK}, {HOUR.format('ts')}, count(DISTINCT account) AS dau_accounts, count(DISTINCT CASE WHEN imei <> '' THEN imei END) AS dau_devices FROM g_logins GROUP BY ALL")
def dau_hour_package(spark, sf):
    return _text_hour(activity.active_users(roles.logins(spark, sf), PACKAGE, "hour"))


@plan("mau", """SELECT l.game_id, d.day, count(DISTINCT l.account) AS mau_accounts, count(DISTINCT CASE WHEN l.imei <> '' THEN l.imei END) AS mau_devices
 FROM (SELECT CAST(x AS DATE) AS day FROM generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY) t(x)) d
 JOIN g_logins l ON l.day <= d.day AND l.day >= d.day - 30 GROUP BY ALL""")
def mau(spark, sf):
    return activity.trailing_users(roles.logins(spark, sf), ["game_id"], roles.TEST_START, roles.TEST_END)


@plan("new_login", """SELECT game_id, day, CAST(sum(d) AS BIGINT) AS new_login_devices, CAST(sum(a) AS BIGINT) AS new_login_accounts FROM (
 SELECT n.game_id, n.day, count(*) AS d, 0 AS a FROM (SELECT game_id, imei, min(day) AS day FROM g_regs WHERE imei <> '' GROUP BY ALL) n
  WHERE EXISTS (SELECT 1 FROM g_logins l WHERE l.game_id = n.game_id AND l.imei = n.imei AND l.day = n.day) GROUP BY ALL
 UNION ALL SELECT n.game_id, n.day, 0, count(*) FROM (SELECT game_id, account, min(day) AS day FROM g_regs GROUP BY ALL) n
  WHERE EXISTS (SELECT 1 FROM g_logins l WHERE l.game_id = n.game_id AND l.account = n.account AND l.day = n.day) GROUP BY ALL) GROUP BY ALL""")
def new_login(spark, sf):
    return activity.new_login(roles.regs(spark, sf), roles.logins(spark, sf), ["game_id"])


@plan("second_login_device", f"""SELECT n.medium, n.day, count(*) AS second_login_devices FROM {NEW_DEV.format(k='medium')} n
 JOIN (SELECT medium, imei, day FROM g_logins GROUP BY ALL HAVING count(*) >= 2) t ON t.medium = n.medium AND t.imei = n.imei AND t.day = n.day GROUP BY ALL""")
def second_login_device(spark, sf):
    return activity.second_login_device(roles.regs(spark, sf), roles.logins(spark, sf), ["medium"])


TIMES = ", ".join(f"CAST(count(CASE WHEN {c} THEN 1 END) AS BIGINT) AS {n}" for c, n in zip(
    ["n = 1", "n = 2", "n = 3", "n = 4", "n = 5", "n BETWEEN 6 AND 10", "n >= 11"], activity.LOGIN_TIMES_NAMES))


@plan("login_frequency_hist", f"SELECT medium, day, {TIMES} FROM (SELECT medium, day, imei, count(*) AS n FROM g_logins GROUP BY ALL) GROUP BY ALL")
def login_frequency_hist(spark, sf):
    return activity.login_frequency_hist(roles.logins(spark, sf), ["medium"])


@plan("login_frequency_hist_new", f"""SELECT medium, day, {TIMES} FROM (SELECT l.medium, l.day, l.imei, count(*) AS n FROM g_logins l
 JOIN {NEW_DEV.format(k='medium')} x ON x.medium = l.medium AND x.imei = l.imei AND x.day = l.day GROUP BY ALL) GROUP BY ALL""")
def login_frequency_hist_new(spark, sf):
    return activity.login_frequency_hist(roles.logins(spark, sf), ["medium"], roles.regs(spark, sf))


ACC = ", ".join(f"CAST(count(CASE WHEN imei <> '' AND {c} THEN 1 END) AS BIGINT) AS {n}" for c, n in zip(
    ["n = 1", "n BETWEEN 2 AND 5", "n BETWEEN 6 AND 10", "n BETWEEN 11 AND 20", "n BETWEEN 21 AND 50", "n BETWEEN 51 AND 100", "n BETWEEN 101 AND 200", "n >= 201"],
    activity.ACCOUNTS_NAMES))


@plan("accounts_per_device_hist", f"""SELECT medium, day, {ACC}, CAST(sum(CASE WHEN imei = '' THEN n ELSE 0 END) AS BIGINT) AS no_device_accounts
 FROM (SELECT medium, day, imei, count(DISTINCT account) AS n FROM g_regs GROUP BY ALL) GROUP BY ALL""")
def accounts_per_device_hist(spark, sf):
    return activity.accounts_per_device_hist(roles.regs(spark, sf), ["medium"])


def _age_cases():
    out = [(f"age = {n}", f"age_{n + 1}") for n in range(15)]
    for low, high, name in [(15, 29, "age_16_30"), (30, 44, "age_31_45"), (45, 59, "age_46_60"), (60, 89, "age_61_90"), (90, 119, "age_91_120"),
                            (120, 149, "age_121_150"), (150, 179, "age_151_180"), (180, 99999, "age_181")]:
        out.append((f"age BETWEEN {low} AND {high}", name))
    return [*out, ("age IS NULL", "age_unknown")]


AGE_COUNT = ", ".join(f"CAST(count(DISTINCT CASE WHEN {c} THEN account END) AS BIGINT) AS {n}" for c, n in _age_cases())
AGE_SUM = ", ".join(f"CAST(sum(CASE WHEN {c} THEN cents ELSE 0 END) AS BIGINT) AS {n}" for c, n in _age_cases())
AGED = """SELECT l.*, date_diff('day', r.reg_day, l.day) AS age FROM {t} l LEFT JOIN (SELECT DISTINCT game_id, account, reg_day FROM g_regs) r USING (game_id, account)"""
VISIBLE = "age IS NULL OR age >= 0"


@plan("dau_by_registration_age", f"SELECT game_id, day, {AGE_COUNT} FROM ({AGED.format(t='g_logins')}) WHERE {VISIBLE} GROUP BY ALL")
def dau_by_registration_age(spark, sf):
    return activity.age_split(roles.logins(spark, sf), roles.regs(spark, sf), ["game_id"])


@plan("payers_by_age", f"SELECT game_id, day, {AGE_COUNT} FROM ({AGED.format(t='(SELECT * FROM g_paid WHERE status = 4)')}) WHERE {VISIBLE} GROUP BY ALL")
def payers_by_age(spark, sf):
    orders = valid_orders(roles.game_orders(spark, sf), refunds=False)
    return activity.age_split(orders, roles.regs(spark, sf), ["game_id"])


@plan("revenue_by_age", f"SELECT game_id, day, {AGE_SUM} FROM ({AGED.format(t='g_paid')}) WHERE {VISIBLE} GROUP BY ALL")
def revenue_by_age(spark, sf):
    orders = valid_orders(roles.game_orders(spark, sf))
    return activity.age_split(orders, roles.regs(spark, sf), ["game_id"], "cents")


ONLINE = "SELECT account, game_id, date_trunc('hour', ts) AS start_ts, ts AS end_ts FROM ev WHERE event_type IN ('view', 'click')"


@plan("online_time", f"""SELECT account, game_id, CAST(start_ts AS DATE) AS day, CAST(sum(epoch(date_trunc('second', end_ts)) - epoch(start_ts)) AS BIGINT) AS online_seconds, count(*) AS sessions
 FROM (SELECT account, game_id, start_ts, max(end_ts) AS end_ts FROM ({ONLINE}) GROUP BY ALL) GROUP BY ALL""")
def online_time(spark, sf):
    ev = roles.events(spark, sf).filter(F.col("event_type").isin("view", "click"))
    return activity.online_time(ev.select("account", "game_id", F.date_trunc("hour", "ts").alias("start_ts"), F.col("ts").alias("end_ts")), ["account", "game_id"])


@plan("first_login_new_users", "SELECT day, medium, count(*) AS new_users FROM (SELECT account, arg_min(medium, (ts, event_id)) AS medium, min(day) AS day FROM g_logins GROUP BY account) GROUP BY ALL")
def first_login_new_users(spark, sf):
    from playlens.operators.keyed import first_row
    first = first_row(roles.logins(spark, sf).select("account", "day", "medium", "ts", "event_id"), ["account"], ["ts", "event_id"])
    return first.groupBy("day", "medium").agg(F.count("*").alias("new_users"))


@plan("sdk_daily_funnel", """WITH homes AS (SELECT DISTINCT account, game_id, medium FROM g_regs),
 d AS (SELECT DISTINCT account, day FROM g_logins),
 a AS (SELECT game_id, medium, day, count(*) AS active_users FROM d JOIN homes USING (account) GROUP BY ALL),
 n AS (SELECT h.game_id, h.medium, f.day, count(*) AS new_users, count(o.account) AS new_payers FROM (SELECT account, min(day) AS day FROM d GROUP BY account) f JOIN homes h USING (account)
   LEFT JOIN (SELECT DISTINCT account, day FROM g_paid WHERE status = 4) o USING (account, day) GROUP BY ALL),
 p AS (SELECT game_id, medium, day, count(DISTINCT account) AS payers, CAST(sum(cents) AS BIGINT) AS pay_cents FROM g_paid WHERE status = 4 GROUP BY ALL),
 s AS (SELECT DISTINCT game_id, medium, CAST(x AS DATE) AS day FROM homes, generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY) t(x)),
 k AS (SELECT game_id, medium, day FROM s UNION SELECT game_id, medium, day FROM a UNION SELECT game_id, medium, day FROM n UNION SELECT game_id, medium, day FROM p),
 j AS (SELECT game_id, medium, day, coalesce(active_users, 0) AS active_users, coalesce(new_users, 0) AS new_users, coalesce(new_payers, 0) AS new_payers,
   coalesce(payers, 0) AS payers, coalesce(pay_cents, 0) AS pay_cents FROM k LEFT JOIN a USING (game_id, medium, day) LEFT JOIN n USING (game_id, medium, day) LEFT JOIN p USING (game_id, medium, day))
 SELECT *, CASE WHEN new_users = 0 THEN 0 ELSE round(new_payers / new_users, 6) END AS new_pay_rate, CASE WHEN active_users = 0 THEN 0 ELSE round(payers / active_users, 6) END AS active_pay_rate,
  CASE WHEN active_users = 0 THEN 0 ELSE round(pay_cents / active_users, 6) END AS cents_per_active, CASE WHEN payers = 0 THEN 0 ELSE round(pay_cents / payers, 6) END AS cents_per_payer FROM j""")
def sdk_daily_funnel(spark, sf):
    keys = ["game_id", "medium"]
    homes = roles.regs(spark, sf).select("account", *keys).distinct()
    orders = valid_orders(roles.game_orders(spark, sf), refunds=False)
    return activity.sdk_daily_funnel(roles.logins(spark, sf), homes, orders, keys, homes, roles.TEST_START, roles.TEST_END)


def _click_cols():
    return ", ".join(f"CAST(count(CASE WHEN type = {c} THEN 1 END) AS BIGINT) AS {n}_pv, CAST(count(DISTINCT CASE WHEN type = {c} THEN ip END) AS BIGINT) AS {n}_uv" for c, n in activity.CLICK_KINDS.items())


@plan("click_kpi_package", f"SELECT {PK}, day, {_click_cols()} FROM g_clicks GROUP BY ALL")
def click_kpi_package(spark, sf):
    return activity.click_kpi(roles.clicks(spark, sf), PACKAGE)


@plan("click_kpi_game", f"SELECT game_id, day, {_click_cols()} FROM g_clicks GROUP BY ALL")
def click_kpi_game(spark, sf):
    return activity.click_kpi(roles.clicks(spark, sf), ["game_id"])


FUNNEL = ["shows", "downloads", "pages", "requests", "activations", "registrations", "pay_cents", "payers"]


def _funnel_part(select, **given):
    return "SELECT " + select + ", " + ", ".join(f"{given.get(m, '0')} AS {m}" for m in FUNNEL)


@plan("publish_funnel", f"SELECT game_id, medium, day, {', '.join(f'CAST(sum({m}) AS BIGINT) AS {m}' for m in FUNNEL)} FROM ("
    + " UNION ALL ".join([
        _funnel_part("game_id, medium, day", shows="count(CASE WHEN type = 1 THEN 1 END)", downloads="count(CASE WHEN type = 2 THEN 1 END)", pages="count(CASE WHEN type = 3 THEN 1 END)", requests="count(CASE WHEN type = 4 THEN 1 END)") + " FROM g_clicks GROUP BY game_id, medium, day",
        _funnel_part("game_id, medium, day", activations="count(*)") + " FROM g_actives GROUP BY game_id, medium, day",
        _funnel_part("game_id, medium, day", registrations="count(*)") + " FROM g_regs GROUP BY game_id, medium, day",
        _funnel_part("h.game_id, h.medium, o.day", pay_cents="sum(o.cents)", payers="count(DISTINCT CASE WHEN o.status = 4 THEN o.account END)")
        + " FROM g_paid o JOIN (SELECT DISTINCT game_id, medium, account FROM g_regs) h USING (account) GROUP BY h.game_id, h.medium, o.day",
    ]) + ") GROUP BY ALL")
def publish_funnel(spark, sf):
    return activity.publish_funnel(roles.clicks(spark, sf), roles.actives(spark, sf), roles.regs(spark, sf), valid_orders(roles.game_orders(spark, sf)), ["game_id", "medium"])


# --- reports of some days, from the index of first times ----------------------------------------------------
LOADS = ["day < DATE'2024-01-10'", "day >= DATE'2024-01-08' AND day < DATE'2024-01-21'", "day >= DATE'2024-01-20' OR day < DATE'2024-01-04'"]
WEEK = ("2024-01-08", "2024-01-21")
IN_WEEK = "day BETWEEN DATE '2024-01-08' AND DATE '2024-01-21'"


def _index(spark, rows, keys, ts, kind, payload=()):
    """Loads that overlap, the middle of the month first: an earlier row that comes later replaces the first one."""
    path = work_folder(spark, "firsts")
    for i, load in enumerate([LOADS[1], LOADS[0], LOADS[2]]):
        bounds.update_firsts(rows.filter(load).withColumn("first_ts", F.col(ts)), path, i, keys, ["first_ts", *payload[:1]], list(payload[1:]))
    return bounds.firsts_between(spark, path, f"{kind}, first_ts timestamp" + "".join(f", {p} {dict(rows.dtypes)[p]}" for p in payload), *WEEK)


PACKAGE_KIND = "game_id int, medium string, site string, package string, imei string"


@plan("activation_kpi_indexed", f"SELECT {PK}, day, count(*) AS active_devices FROM (SELECT {PK}, imei, CAST(min(ts) AS DATE) AS day FROM g_actives WHERE imei <> '' GROUP BY ALL) WHERE {IN_WEEK} GROUP BY ALL")
def activation_kpi_indexed(spark, sf):
    actives = roles.actives(spark, sf).filter("imei <> ''")
    return activity.activation_kpi(actives, PACKAGE, "day", start=WEEK[0], end=WEEK[1], firsts=_index(spark, actives, [*PACKAGE, "imei"], "active_ts", PACKAGE_KIND))


@plan("new_device_kpi_indexed", f"SELECT * FROM (SELECT {PK}, day, count(*) AS new_devices FROM {NEW_DEV.format(k=PK)} GROUP BY ALL) WHERE {IN_WEEK}")
def new_device_kpi_indexed(spark, sf):
    regs = roles.regs(spark, sf).filter("imei <> ''")
    firsts = _index(spark, regs.withColumn("day", F.col("reg_day")), [*PACKAGE, "imei"], "reg_ts", PACKAGE_KIND)
    return activity.new_device_kpi(regs, PACKAGE, "day", start=WEEK[0], end=WEEK[1], firsts=firsts)


@plan("second_login_device_indexed", f"""SELECT n.medium, n.day, count(*) AS second_login_devices FROM {NEW_DEV.format(k='medium')} n
 JOIN (SELECT medium, imei, day FROM g_logins GROUP BY ALL HAVING count(*) >= 2) t ON t.medium = n.medium AND t.imei = n.imei AND t.day = n.day WHERE n.{IN_WEEK} GROUP BY ALL""")
def second_login_device_indexed(spark, sf):
    regs = roles.regs(spark, sf).filter("imei <> ''")
    firsts = _index(spark, regs.withColumn("day", F.col("reg_day")), ["medium", "imei"], "reg_ts", "medium string, imei string")
    return activity.second_login_device(regs, roles.logins(spark, sf), ["medium"], start=WEEK[0], end=WEEK[1], firsts=firsts)


@plan("first_login_new_users_indexed", f"SELECT * FROM (SELECT day, medium, count(*) AS new_users FROM (SELECT account, arg_min(medium, (ts, event_id)) AS medium, min(day) AS day FROM g_logins GROUP BY account) GROUP BY ALL) WHERE {IN_WEEK}")
def first_login_new_users_indexed(spark, sf):
    firsts = _index(spark, roles.logins(spark, sf), ["account"], "login_ts", "account string", ("event_id", "medium"))
    return firsts.groupBy(F.col("first_day").alias("day"), "medium").agg(F.count("*").alias("new_users"))


# --- money at the owner of an order -----------------------------------------------------------------------
OWNED = """own AS (SELECT o.*, f.game_id AS own_game, f.medium AS own_medium, f.reg_day AS own_day, f.event_id AS own_reg FROM g_paid o LEFT JOIN LATERAL (
  SELECT r.game_id, r.medium, r.reg_day, r.event_id FROM g_regs r WHERE r.account = o.account
  ORDER BY r.ts > o.ts, CASE WHEN r.ts <= o.ts THEN -epoch_us(r.ts) ELSE epoch_us(r.ts) END, CASE WHEN r.ts <= o.ts THEN -r.event_id ELSE r.event_id END LIMIT 1) f ON TRUE)"""


@plan("publish_funnel_owned", f"WITH {OWNED} SELECT game_id, medium, day, {', '.join(f'CAST(sum({m}) AS BIGINT) AS {m}' for m in FUNNEL)} FROM ("
    + " UNION ALL ".join([
        _funnel_part("game_id, medium, day", shows="count(CASE WHEN type = 1 THEN 1 END)", downloads="count(CASE WHEN type = 2 THEN 1 END)", pages="count(CASE WHEN type = 3 THEN 1 END)", requests="count(CASE WHEN type = 4 THEN 1 END)") + " FROM g_clicks GROUP BY game_id, medium, day",
        _funnel_part("game_id, medium, day", activations="count(*)") + " FROM g_actives GROUP BY game_id, medium, day",
        _funnel_part("game_id, medium, day", registrations="count(*)") + " FROM g_regs GROUP BY game_id, medium, day",
        _funnel_part("own_game, own_medium, day", pay_cents="sum(cents)", payers="count(DISTINCT CASE WHEN status = 4 THEN account END)") + " FROM own GROUP BY own_game, own_medium, day",
    ]) + ") GROUP BY ALL")
def publish_funnel_owned(spark, sf):
    return activity.publish_funnel(roles.clicks(spark, sf), roles.actives(spark, sf), roles.regs(spark, sf), valid_orders(roles.game_orders(spark, sf)), ["game_id", "medium"], owned=True)
