"""Ad attribution."""

from __future__ import annotations

from pyspark.sql import functions as F

from playlens.functions.cleanse import device_hash, valid_orders
from playlens.operators import attribution, cohort
from playlens.operators.aggregates import zero_filled_union
from playlens.operators.keyed import first_row
from playlens.plans import plan, within_query
from playlens.session import write_stage
from playlens.sources import roles


def _traits(df):
    return df.withColumns({
        "device": F.when(F.col("imei") == "", "").otherwise(device_hash("imei")),
        "dev_type": F.concat(F.lit("t"), F.col("user_id") % 5), "sys_version": F.concat(F.lit("v"), F.col("user_id") % 3),
    })


def event_log(spark, sf):
    """The events of the four kinds with their traits, parsed once per query and kept by kind: a reader opens its own kind's files alone."""
    def parsed():
        rows = _traits(roles.events(spark, sf)).filter(F.col("event_type").isin("view", "click", "signup", "purchase"))
        return write_stage(rows.drop("expand_channel", "medium", "site"), "ad-log", ["event_type"])
    return within_query(f"ad-log {sf}", parsed)


def logins(spark, sf):
    return roles.as_logins(event_log(spark, sf))


def own_regs(spark, sf):
    return roles.as_regs(event_log(spark, sf)).withColumnRenamed("event_id", "reg_id")


def accounts(spark, sf):
    """First registrations."""
    rows = own_regs(spark, sf).select("account", "game_id", "device", "reg_day", "reg_ts", "reg_id")
    return within_query(f"ad-accounts {sf}", lambda: write_stage(first_row(rows, ["account"], ["reg_ts", "reg_id"]), "ad-accounts"))


def paid(spark, sf):
    return within_query(f"ad-paid {sf}", lambda: write_stage(valid_orders(roles.as_game_orders(event_log(spark, sf))), "ad-paid"))


def ad_clicks(spark, sf):
    c = roles.as_clicks(event_log(spark, sf)).withColumnRenamed("event_id", "click_id")
    return c.withColumns({"network": (F.col("k") % 4 + 1).cast("int"), "idea_id": F.concat(F.lit("i"), F.col("k") % 6),
                          "level1": F.concat(F.lit("a"), F.col("k") % 3), "level2": F.concat(F.lit("b"), F.col("k") % 5)})


def ad_actives(spark, sf):
    return _detail("actives", spark, sf)


def _detail(kind: str, spark, sf: str):
    """The detail tables are written once per query, however many of its parts read them."""
    return within_query(f"ad-{kind} {sf}", lambda: _written(kind, spark, sf))


def _written(kind: str, spark, sf: str):
    if kind == "matches":
        return attribution.attribute_activation(ad_actives(spark, sf), ad_clicks(spark, sf))
    if kind == "actives":
        rows = roles.as_actives(event_log(spark, sf)).withColumnRenamed("event_id", "active_id")
        found = attribution.first_activations(rows.select("active_id", "active_ts", "day", "game_id", "os", "device", "android_id", "ip", "dev_type", "sys_version"))
    elif kind == "activations":
        found = attribution.attributed_activations(ad_actives(spark, sf), ad_clicks(spark, sf), matches(spark, sf), CLICK_FIELDS)
    else:
        found = attribution.attribute_registration(own_regs(spark, sf), activations(spark, sf), CARRIED)
    return write_stage(found, f"ad-{kind}")


def matches(spark, sf):
    return _detail("matches", spark, sf)


def activations(spark, sf):
    return _detail("activations", spark, sf)


CLICK_FIELDS = ["package", "network", "idea_id", "level1", "level2"]
CARRIED = [f"click_{f}" for f in CLICK_FIELDS]


def registrations(spark, sf):
    return _detail("registrations", spark, sf)


def orders(spark, sf):
    return attribution.attribute_order(paid(spark, sf), registrations(spark, sf), CARRIED)


def _rule_sql(os: int, step: int, fields: list[str], earlier: list[str]) -> str:
    """Matching of one rule as SQL: the height of a running sum that never falls below zero names the partner."""
    keys = ", ".join(["game_id", *fields])
    given = " AND ".join(f"{f} <> ''" for f in fields)
    skip = lambda col: "".join(f" AND {col} NOT IN (SELECT {col} FROM {e})" for e in earlier)
    n = f"m{os}_{step}"
    return f"""{n}_b AS (SELECT {keys}, day, 0 AS kind, click_ts AS ts, click_id AS id FROM ad_c WHERE os = {os} AND {given}{skip('click_id')}
   UNION ALL SELECT {keys}, day, 1, active_ts, active_id FROM ad_a WHERE os = {os} AND {given}{skip('active_id')}),
 {n}_s AS (SELECT *, sum(1 - 2 * kind) OVER (PARTITION BY {keys} ORDER BY day, kind, ts, id ROWS UNBOUNDED PRECEDING) AS s FROM {n}_b),
 {n}_l AS (SELECT *, least(0, min(s) OVER (PARTITION BY {keys} ORDER BY day, kind, ts, id ROWS UNBOUNDED PRECEDING)) AS low FROM {n}_s),
 {n}_h AS (SELECT *, CASE WHEN kind = 0 THEN s - low ELSE s + 1 - lag(low, 1, 0) OVER (PARTITION BY {keys} ORDER BY day, kind, ts, id) END AS h FROM {n}_l),
 {n}_p AS (SELECT *, lag(kind) OVER w AS pk, lag(id) OVER w AS pid, lag(day) OVER w AS pday FROM {n}_h WHERE h > 0 WINDOW w AS (PARTITION BY {keys}, h ORDER BY day, kind, ts, id)),
 {n} AS MATERIALIZED (SELECT id AS active_id, pid AS click_id, {step} AS rule FROM {n}_p WHERE kind = 1 AND pk = 0 AND date_diff('day', pday, day) <= 6)"""


def chain_sql(clicks: str | None = None) -> str:
    """The chain from clicks to orders; ``clicks`` is another SELECT for its clicks."""
    traits = "CASE WHEN imei = '' THEN '' ELSE upper(md5(upper(imei))) END AS device, 't' || (user_id % 5) AS dev_type, 'v' || (user_id % 3) AS sys_version"
    clicks = clicks or f"SELECT *, event_id AS click_id, {traits}, CAST(k % 4 + 1 AS INT) AS network, 'i' || (k % 6) AS idea_id, 'a' || (k % 3) AS level1, 'b' || (k % 5) AS level2 FROM g_clicks"
    parts = [f"""ad_c AS MATERIALIZED ({clicks}),
 ad_a AS MATERIALIZED (SELECT * FROM (SELECT *, event_id AS active_id, {traits}, row_number() OVER (PARTITION BY game_id, CASE WHEN imei <> '' THEN imei ELSE 'android:' || android_id END ORDER BY ts, event_id) AS rn FROM g_actives WHERE imei <> '' OR (os = 1 AND android_id <> '')) WHERE rn = 1)"""]
    names = []
    for os, chain in attribution.CHAINS.items():
        earlier = []
        for i, fields in enumerate(chain, 1):
            parts.append(_rule_sql(os, i, fields, earlier))
            earlier.append(f"m{os}_{i}")
        names += earlier
    parts.append("ad_m AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT * FROM {n}" for n in names) + ")")
    parts.append("""ad_x AS MATERIALIZED (SELECT a.*, m.click_id, m.rule, c.package AS click_package, c.network AS click_network, c.idea_id AS click_idea_id, c.level1 AS click_level1, c.level2 AS click_level2
   FROM ad_a a JOIN ad_m m USING (active_id) JOIN ad_c c ON c.click_id = m.click_id),
 ad_acc AS (SELECT * FROM (SELECT *, event_id AS reg_id, """ + traits + """, row_number() OVER (PARTITION BY account ORDER BY ts, event_id) AS rn FROM g_regs) WHERE rn = 1),
 ad_r1 AS (SELECT r.account, r.game_id, r.device, r.reg_ts, r.reg_id, x.active_id, x.active_ts, x.click_package, x.click_network, x.click_idea_id, x.click_level1, x.click_level2, 1 AS rule
   FROM ad_acc r JOIN ad_x x USING (game_id, device) WHERE r.device <> '' AND r.reg_ts >= x.active_ts AND date_diff('day', x.day, r.day) <= 30),
 ad_r2 AS (SELECT r.account, r.game_id, r.device, r.reg_ts, r.reg_id, x.active_id, x.active_ts, x.click_package, x.click_network, x.click_idea_id, x.click_level1, x.click_level2, 2 AS rule
   FROM ad_acc r JOIN ad_x x USING (game_id, android_id) WHERE r.android_id <> '' AND x.active_ts <= r.reg_ts AND r.account NOT IN (SELECT account FROM ad_r1)
   QUALIFY row_number() OVER (PARTITION BY r.account ORDER BY x.active_ts DESC, x.active_id DESC) = 1 AND date_diff('day', x.day, r.day) <= 30),
 ad_r AS MATERIALIZED (SELECT *, CAST(reg_ts AS DATE) = CAST(active_ts AS DATE) AS new_device FROM (SELECT * FROM ad_r1 UNION ALL SELECT * FROM ad_r2)),
 ad_o AS MATERIALIZED (SELECT o.*, r.click_package, r.click_network, r.click_idea_id, r.click_level1, r.click_level2, CAST(r.reg_ts AS DATE) AS reg_day, CAST(r.reg_ts AS DATE) = o.day AS new_payer FROM g_paid o JOIN ad_r r USING (account))""")
    return "WITH " + ",\n ".join(parts) + "\n"


CHAIN = chain_sql()


@plan("attribute_activation", CHAIN + "SELECT active_id, click_id, rule FROM ad_m")
def attribute_activation(spark, sf):
    return attribution.attribute_activation(ad_actives(spark, sf), ad_clicks(spark, sf))


@plan("attribute_registration", CHAIN + "SELECT account, game_id, reg_id, active_id, click_package, rule, new_device FROM ad_r")
def attribute_registration(spark, sf):
    return registrations(spark, sf).select("account", "game_id", "reg_id", "active_id", "click_package", "rule", "new_device")


@plan("attribute_order", CHAIN + "SELECT order_no, account, cents, click_package, click_network, new_payer FROM ad_o")
def attribute_order(spark, sf):
    return orders(spark, sf).select("order_no", "account", "cents", "click_package", "click_network", "new_payer")


@plan("click_dedup_refresh", CHAIN + """SELECT game_id, device, click_id, package, n AS clicks FROM (SELECT *, count(*) OVER (PARTITION BY game_id, device) AS n,
  row_number() OVER (PARTITION BY game_id, device ORDER BY click_ts DESC, click_id DESC) AS rn2 FROM ad_c WHERE device <> '' AND click_id NOT IN (SELECT click_id FROM ad_m)) WHERE rn2 = 1""")
def click_dedup_refresh(spark, sf):
    clicks = ad_clicks(spark, sf).filter("device <> ''")
    return attribution.refresh_clicks(clicks, matches(spark, sf), ["game_id", "device"]).select("game_id", "device", "click_id", "package", "clicks")


def _stats_sql(keys: str) -> str:
    m = attribution.AD_MEASURES
    def part(select, source, **given):
        return f"SELECT {select}, " + ", ".join(f"{given.get(x, '0')} AS {x}" for x in m) + f" FROM {source} GROUP BY ALL"
    plain = keys
    won = ", ".join(k if k == "game_id" else f"click_{k} AS {k}" for k in keys.split(", "))
    parts = [
        part(plain + ", day", "ad_c", clicks="count(*)", click_devices="count(DISTINCT CASE WHEN device <> '' THEN device END)"),
        part(won + ", day", "ad_x", actives="count(*)"),
        part(won + ", CAST(reg_ts AS DATE) AS day", "ad_r", regis="count(*)", regi_devices="count(DISTINCT CASE WHEN device <> '' THEN device END)",
             new_regi_devices="count(DISTINCT CASE WHEN device <> '' AND new_device THEN device END)"),
        part(won + ", day", "ad_o", pay_cents="sum(cents)", payers="count(DISTINCT account)", new_payers="count(DISTINCT CASE WHEN new_payer THEN account END)",
             new_pay_cents="sum(CASE WHEN new_payer THEN cents ELSE 0 END)"),
    ]
    return f"SELECT {keys}, day, " + ", ".join(f"CAST(sum({x}) AS BIGINT) AS {x}" for x in m) + " FROM (" + " UNION ALL ".join(parts) + ") GROUP BY ALL"


def _renamed(df):
    """The package, network and creative of the click are those of all that follows from it."""
    return df.drop(*CLICK_FIELDS).withColumnsRenamed(dict(zip(CARRIED, CLICK_FIELDS)))


def stats(spark, sf, keys):
    regs = _renamed(registrations(spark, sf)).withColumn("day", F.to_date("reg_ts"))
    return attribution.ad_channel_stats(ad_clicks(spark, sf), _renamed(activations(spark, sf)), regs, _renamed(orders(spark, sf)), keys)


@plan("ad_channel_stats", CHAIN + _stats_sql("game_id, package, network, idea_id"))
def ad_channel_stats(spark, sf):
    return stats(spark, sf, ["game_id", "package", "network", "idea_id"])


LEVELS = "game_id, package, network, idea_id, level1, level2"


@plan("ad_channel_stats_levels", CHAIN + _stats_sql(LEVELS))
def ad_channel_stats_levels(spark, sf):
    """Down to the third creative level."""
    return stats(spark, sf, LEVELS.split(", "))


@plan("ad_conversion", CHAIN + f"""SELECT *, CASE WHEN clicks = 0 THEN 0 ELSE round(actives / clicks, 6) END AS active_rate, CASE WHEN actives = 0 THEN 0 ELSE round(regis / actives, 6) END AS regi_rate,
  CASE WHEN regis = 0 THEN 0 ELSE round(payers / regis, 6) END AS pay_rate FROM ({_stats_sql('network')})""")
def ad_conversion(spark, sf):
    return attribution.conversion_rates(stats(spark, sf, ["network"]))


TOTAL = """(SELECT game_id, day, CAST(sum(a) AS BIGINT) AS actives, CAST(sum(r) AS BIGINT) AS regis, CAST(sum(p) AS BIGINT) AS pay_cents FROM (
  SELECT game_id, day, 1 AS a, 0 AS r, 0 AS p FROM ad_a UNION ALL SELECT game_id, day, 0, 1, 0 FROM ad_acc UNION ALL SELECT game_id, day, 0, 0, cents FROM g_paid) GROUP BY ALL)"""
PART = """(SELECT game_id, day, {extra}CAST(sum(a) AS BIGINT) AS actives, CAST(sum(r) AS BIGINT) AS regis, CAST(sum(p) AS BIGINT) AS pay_cents FROM (
  SELECT game_id, day, click_package AS package, 1 AS a, 0 AS r, 0 AS p FROM ad_x UNION ALL SELECT game_id, CAST(reg_ts AS DATE), click_package, 0, 1, 0 FROM ad_r
  UNION ALL SELECT game_id, day, click_package, 0, 0, cents FROM ad_o) GROUP BY ALL)"""
MEASURES = ["actives", "regis", "pay_cents"]
REST = ", ".join(f"CAST(t.{m} - coalesce(x.{m}, 0) AS BIGINT) AS {m}" for m in MEASURES)


def totals(spark, sf):
    count = lambda df, name, day="day": df.groupBy("game_id", F.col(day).alias("day")).agg(F.count("*").alias(name))
    pay = paid(spark, sf).groupBy("game_id", "day").agg(F.sum("cents").alias("pay_cents"))
    return zero_filled_union([count(ad_actives(spark, sf), "actives"), count(accounts(spark, sf), "regis", "reg_day"), pay], ["game_id", "day"], MEASURES)


def by_package(spark, sf):
    full = stats(spark, sf, ["game_id", "package"]).select("game_id", "package", "day", *MEASURES)
    return full.filter("actives <> 0 or regis <> 0 or pay_cents <> 0")


@plan("natural_kpi", CHAIN + f"SELECT t.game_id, t.day, {REST} FROM {TOTAL} t LEFT JOIN {PART.format(extra='')} x USING (game_id, day)")
def natural_kpi(spark, sf):
    return attribution.natural_kpi(totals(spark, sf), by_package(spark, sf), ["game_id", "day"], MEASURES)


@plan("merged_ad_kpi", CHAIN + f"""SELECT game_id, day, package, actives, regis, pay_cents, FALSE AS is_natural FROM {PART.format(extra='package, ')} WHERE actives <> 0 OR regis <> 0 OR pay_cents <> 0
  UNION ALL SELECT t.game_id, t.day, '', {REST}, TRUE FROM {TOTAL} t LEFT JOIN {PART.format(extra='')} x USING (game_id, day)""")
def merged_ad_kpi(spark, sf):
    return attribution.merged_ad_kpi(totals(spark, sf), by_package(spark, sf), ["game_id", "day"], ["package"], MEASURES)


def _ad_cohort_sql():
    ret = ", ".join(f"CAST(count(DISTINCT CASE WHEN d = {n} THEN account END) AS BIGINT) AS retained_{n}" for n in cohort.REALTIME_OFFSETS)
    ltv = ", ".join(f"CAST(sum(CASE WHEN {'d = 0' if n == 1 else f'd BETWEEN 0 AND {n - 1}'} THEN cents ELSE 0 END) AS BIGINT) AS ltv_{n}" for n in cohort.AD_LTV_DAYS)
    return f"""SELECT * FROM (SELECT c.game_id, c.package, c.reg_day, {ltv}, CAST(coalesce(sum(cents), 0) AS BIGINT) AS total_cents FROM
   (SELECT a.*, o.cents, date_diff('day', a.reg_day, o.day) AS d FROM (SELECT game_id, click_package AS package, account, CAST(reg_ts AS DATE) AS reg_day FROM ad_r) a LEFT JOIN g_paid o USING (account)) c GROUP BY ALL) v
  JOIN (SELECT game_id, package, reg_day, {ret} FROM (SELECT a.*, date_diff('day', a.reg_day, l.day) AS d FROM
   (SELECT game_id, click_package AS package, account, CAST(reg_ts AS DATE) AS reg_day FROM ad_r) a LEFT JOIN g_logins l USING (account)) GROUP BY ALL) r USING (game_id, package, reg_day)"""


@plan("ad_retention_ltv", CHAIN + _ad_cohort_sql())
def ad_retention_ltv(spark, sf):
    keys = ["game_id", "package"]
    regs = _renamed(registrations(spark, sf)).withColumn("reg_day", F.to_date("reg_ts")).select(*keys, "account", "reg_day")
    value = cohort.cohort_value(regs, paid(spark, sf), ["account"], keys, days=cohort.AD_LTV_DAYS, total="total_cents")
    back = cohort.retention(regs, logins(spark, sf), ["account"], keys, ["account"], offsets=cohort.REALTIME_OFFSETS)
    return value.join(back, [*keys, "reg_day"], "left").fillna(0, [f"retained_{n}" for n in cohort.REALTIME_OFFSETS])


def _device_cohort_sql():
    back = ", ".join(f"CAST(sum(CASE WHEN d = {n} THEN 1 ELSE 0 END) AS BIGINT) AS retained_{n}" for n in cohort.REALTIME_OFFSETS)
    value = ", ".join(f"CAST(sum(CASE WHEN d < {n} THEN cents ELSE 0 END) AS BIGINT) AS ltv_{n}" for n in (1, 2, 3, 7))
    names = [*(f"retained_{n}" for n in cohort.REALTIME_OFFSETS), *(f"ltv_{n}" for n in (1, 2, 3, 7)), "total_cents", "paying_devices"]
    return f"""SELECT game_id, package, reg_day, devices, {', '.join(f'CAST(coalesce({n}, 0) AS BIGINT) AS {n}' for n in names)} FROM (SELECT game_id, package, reg_day, count(*) AS devices FROM dev GROUP BY ALL)
  LEFT JOIN (SELECT game_id, package, reg_day, {back} FROM (SELECT DISTINCT dev.*, date_diff('day', reg_day, l.day) AS d FROM dev JOIN (SELECT game_id, package, day, upper(md5(upper(imei))) AS device FROM g_logins WHERE imei <> '') l USING (game_id, package, device)) GROUP BY ALL) USING (game_id, package, reg_day)
  LEFT JOIN (SELECT game_id, package, reg_day, {value}, CAST(sum(cents) AS BIGINT) AS total_cents, count(DISTINCT device) AS paying_devices FROM (
    SELECT dev.*, o.cents, date_diff('day', reg_day, o.day) AS d FROM dev JOIN (SELECT game_id, click_package AS package, day, cents, CASE WHEN imei = '' THEN '' ELSE upper(md5(upper(imei))) END AS device FROM ad_o) o USING (game_id, package, device)) WHERE d >= 0 GROUP BY ALL) USING (game_id, package, reg_day)"""


@plan("ad_device_retention_ltv", CHAIN.rstrip() + ",\n dev AS MATERIALIZED (SELECT game_id, click_package AS package, device, CAST(min(reg_ts) AS DATE) AS reg_day FROM ad_r WHERE device <> '' GROUP BY ALL)\n" + _device_cohort_sql())
def ad_device_retention_ltv(spark, sf):
    """Devices count where they registered, and come back under the channel of their own login."""
    regs = _renamed(registrations(spark, sf)).withColumn("reg_day", F.to_date("reg_ts"))
    back = logins(spark, sf).select("game_id", "package", "device", "day")
    return attribution.ad_device_cohorts(regs, back, _renamed(orders(spark, sf)), ["game_id", "package"])


def _merged_sql():
    m = attribution.MERGED
    def part(scope, package, source, **given):
        return f"SELECT '{scope}' AS scope, game_id, day, {package} AS package, " + ", ".join(f"{given.get(x, '0')} AS {x}" for x in m) + f" FROM {source} GROUP BY ALL"
    count = lambda cond: f"count(CASE WHEN {cond} THEN 1 END)"
    dev = lambda cond="TRUE": f"count(DISTINCT CASE WHEN device <> '' AND {cond} THEN device END)"
    parts = []
    for scope, pk, landings, act, reg, pay in (("ad", "package", "(SELECT * FROM g_clicks WHERE package <> '')", "mk_act", "mk_reg", "mk_pay"), ("all", "''", "g_clicks", "mk_act_all", "mk_reg_all", "mk_pay_all")):
        parts += [
            part(scope, pk, landings, requests=count("type = 4"), downloads=count("type = 2"), request_uv="count(DISTINCT CASE WHEN type = 4 THEN ip END)", download_uv="count(DISTINCT CASE WHEN type = 2 THEN ip END)"),
            part(scope, pk, act, actives="count(*)", active_regi_devices=dev(f"(game_id, day, device) IN (SELECT (game_id, day, device) FROM {reg})")),
            part(scope, pk, reg, regi_devices=dev(), new_regi_devices=dev("is_first"), second_login_devices=dev("is_first AND times >= 2"),
                 **{name: dev(f"is_first AND back_{n}") for n, name in attribution.MERGED_OFFSETS.items()}),
            part(scope, pk, pay, pay_cents="sum(cents)", new_pay_cents="sum(CASE WHEN new_payer THEN cents ELSE 0 END)", pay_devices=dev(), new_pay_devices=dev("new_payer")),
        ]
    hashed = "CASE WHEN imei = '' THEN '' ELSE upper(md5(upper(imei))) END"
    backs = ", ".join(f"EXISTS (SELECT 1 FROM mk_l l WHERE l.game_id = r.game_id AND l.device = r.device AND l.day = r.day + {n}) AS back_{n}" for n in attribution.MERGED_OFFSETS)
    marks = f"(r.game_id, r.device, r.day) IN (SELECT (game_id, device, day) FROM mk_first) AS is_first, coalesce((SELECT l.n FROM mk_l l WHERE l.game_id = r.game_id AND l.device = r.device AND l.day = r.day), 0) AS times, {backs}"
    head = f""",
 mk_first AS MATERIALIZED (SELECT game_id, {hashed} AS device, min(day) AS day FROM g_regs WHERE imei <> '' GROUP BY ALL), mk_l AS MATERIALIZED (SELECT game_id, {hashed} AS device, day, count(*) AS n FROM g_logins WHERE imei <> '' GROUP BY ALL),
 mk_act AS (SELECT *, click_package AS package FROM (SELECT * EXCLUDE (package) FROM ad_x)), mk_act_all AS (SELECT * FROM ad_a),
 mk_reg AS MATERIALIZED (SELECT r.*, {marks} FROM (SELECT game_id, click_package AS package, device, CAST(reg_ts AS DATE) AS day FROM ad_r) r),
 mk_reg_all AS MATERIALIZED (SELECT r.*, {marks} FROM (SELECT game_id, device, day FROM ad_acc) r),
 mk_pay AS (SELECT game_id, click_package AS package, day, cents, new_payer, {hashed} AS device FROM ad_o),
 mk_pay_all AS (SELECT o.game_id, o.day, o.cents, coalesce(a.day = o.day, FALSE) AS new_payer, {hashed.replace('imei', 'o.imei')} AS device FROM g_paid o LEFT JOIN ad_acc a USING (account)),
 mk AS MATERIALIZED ({' UNION ALL '.join(parts)})
"""
    sums = ", ".join(f"CAST(sum({x}) AS BIGINT) AS {x}" for x in m)
    rest = ", ".join(f"CAST(sum(CASE WHEN scope = 'all' THEN {x} ELSE -{x} END) AS BIGINT) AS {x}" for x in m)
    both = f"SELECT game_id, day, package, FALSE AS is_natural, {sums} FROM mk WHERE scope = 'ad' GROUP BY ALL UNION ALL SELECT game_id, day, '', TRUE, {rest} FROM mk GROUP BY ALL"
    return CHAIN.rstrip() + head + f"SELECT * FROM ({both}) WHERE {' OR '.join(f'{x} <> 0' for x in m)}"


@plan("merged_ad_kpi_full", _merged_sql())
def merged_ad_kpi_full(spark, sf):
    """All measures; landings count for a package where it is known."""
    def scoped(ad, every, *columns):
        of = lambda df, scope, package: df.select(F.lit(scope).alias("scope"), "game_id", "day", package.alias("package"), *columns)
        return of(ad, "ad", F.col("package")).unionByName(of(every, "all", F.lit("")))

    landings, firsts = roles.as_clicks(event_log(spark, sf)), accounts(spark, sf).withColumnRenamed("reg_day", "day")
    born = firsts.select("account", F.col("day").alias("born"))
    every = paid(spark, sf).join(born, "account", "left").withColumn("new_payer", F.coalesce(F.col("born") == F.col("day"), F.lit(False)))
    new_regs = own_regs(spark, sf).filter("device <> ''").groupBy("game_id", "device").agg(F.min("reg_day").alias("day"))
    won = _renamed(registrations(spark, sf)).withColumn("day", F.to_date("reg_ts"))
    return attribution.merged_ad_table(attribution.merged_ad_facts(
        scoped(landings.filter("package <> ''"), landings, "type", "ip"), scoped(_renamed(activations(spark, sf)), ad_actives(spark, sf), "active_id", "device"),
        scoped(won, firsts, "device"), scoped(_renamed(orders(spark, sf)), every, "device", "new_payer", "cents"), logins(spark, sf), new_regs))


NATURAL = {f"retained_{n}": n for n in cohort.REALTIME_OFFSETS}
NATURAL_DAYS = (1, 7, 30)


def _natural_cohort_sql():
    back = ", ".join(f"count(DISTINCT CASE WHEN d = {n} THEN account END) AS {m}" for m, n in NATURAL.items())
    value = ", ".join(f"sum(CASE WHEN {'d = 0' if n == 1 else f'd BETWEEN 0 AND {n - 1}'} THEN cents ELSE 0 END) AS recharge_{n}" for n in NATURAL_DAYS)
    names = [*NATURAL, *(f"recharge_{n}" for n in NATURAL_DAYS), "recharge_total", "recharge_accounts"]
    def of(source):
        return f"""(SELECT game_id, reg_day, {', '.join(f'coalesce({n}, 0) AS {n}' for n in names)} FROM (SELECT DISTINCT game_id, reg_day FROM {source})
  LEFT JOIN (SELECT game_id, reg_day, {back} FROM (SELECT r.*, date_diff('day', r.reg_day, l.day) AS d FROM {source} r JOIN g_logins l USING (account)) GROUP BY ALL) USING (game_id, reg_day)
  LEFT JOIN (SELECT game_id, reg_day, {value}, sum(cents) AS recharge_total, count(DISTINCT account) AS recharge_accounts FROM (SELECT r.*, o.cents, date_diff('day', r.reg_day, o.day) AS d FROM {source} r JOIN g_paid o USING (account)) GROUP BY ALL) USING (game_id, reg_day))"""
    rest = ", ".join(f"CAST(t.{n} - coalesce(x.{n}, 0) AS BIGINT) AS {n}" for n in names)
    return CHAIN.rstrip() + f""",
 n_all AS MATERIALIZED (SELECT game_id, account, day AS reg_day FROM ad_acc), n_ad AS MATERIALIZED (SELECT game_id, account, CAST(reg_ts AS DATE) AS reg_day FROM ad_r)
 SELECT game_id, reg_day, {rest} FROM {of('n_all')} t LEFT JOIN {of('n_ad')} x USING (game_id, reg_day)"""


@plan("natural_retention", _natural_cohort_sql())
def natural_retention(spark, sf):
    """Retention and value of accounts that no advertisement brought: all first registrations less the attributed ones."""
    won = registrations(spark, sf).withColumn("reg_day", F.to_date("reg_ts")).select("account", "game_id", "reg_day")
    return attribution.natural_cohorts(accounts(spark, sf), won, logins(spark, sf), paid(spark, sf), ["game_id"], NATURAL_DAYS)


@plan("reward_network_audit", """WITH rep AS (SELECT game_id, imei, day FROM g_clicks WHERE type IN (1, 2) AND imei <> ''), d AS (SELECT game_id, imei, day, count(*) AS n FROM rep GROUP BY ALL),
 own AS (SELECT DISTINCT game_id, imei, day FROM g_actives WHERE imei <> ''), reg AS (SELECT DISTINCT game_id, imei, day FROM g_regs WHERE imei <> ''),
 f AS (SELECT d.*, EXISTS (SELECT 1 FROM own o WHERE o.game_id = d.game_id AND o.imei = d.imei AND o.day = d.day) AS mt,
  EXISTS (SELECT 1 FROM own o WHERE o.game_id = d.game_id AND o.imei = d.imei AND o.day < d.day) AS ob,
  EXISTS (SELECT 1 FROM rep o WHERE o.game_id = d.game_id AND o.imei = d.imei AND o.day < d.day) AS rb,
  EXISTS (SELECT 1 FROM reg o WHERE o.game_id = d.game_id AND o.imei = d.imei AND o.day = d.day) AS rg,
  EXISTS (SELECT 1 FROM reg o WHERE o.game_id = d.game_id AND o.imei = d.imei AND o.day < d.day) AS rgb FROM d),
 a AS (SELECT game_id, day, CAST(sum(n) AS BIGINT) AS reported, count(*) AS unique_devices, count(*) FILTER (mt) AS matched, count(*) FILTER (NOT mt AND NOT ob) AS unmatched,
  count(*) FILTER (NOT mt AND ob) AS repeat_own, count(*) FILTER (NOT mt AND ob AND rb) AS repeat_both, count(*) FILTER (rg) AS registered, count(*) FILTER (rg AND NOT rgb) AS new_registered FROM f GROUP BY ALL)
 SELECT a.*, coalesce(t.n, 0) AS active_devices, greatest(coalesce(t.n, 0) - matched, 0) AS "natural" FROM a LEFT JOIN (SELECT game_id, day, count(*) AS n FROM own GROUP BY ALL) t USING (game_id, day)""")
def reward_network_audit(spark, sf):
    known = F.col("imei") != ""
    reports = roles.clicks(spark, sf).filter(F.col("type").isin(1, 2) & known)
    return attribution.reward_network_audit(reports, roles.actives(spark, sf).filter(known), roles.regs(spark, sf).filter(known))


@plan("one_time_repairs", """SELECT event_id, game_id, coalesce(day = min(CASE WHEN imei <> '' THEN day END) OVER (PARTITION BY game_id, imei), FALSE) AS is_new_device, upper(md5(upper(imei))) AS device_hash FROM g_regs""")
def one_time_repairs(spark, sf):
    fixed = attribution.repair_new_device(roles.regs(spark, sf), ["game_id"])
    return fixed.select("event_id", "game_id", "is_new_device", device_hash("imei").alias("device_hash"))


@plan("ad_click_detail", """SELECT c.event_id AS click_id, c.game_id, c.package, CAST(c.k % 4 + 1 AS INT) AS network, coalesce('tag' || n.n_nationkey, '') AS medium_tag, coalesce(n.n_name, '') AS medium_name, coalesce(s.s_name, '') AS buyer
  FROM g_clicks c LEFT JOIN nation n ON n.n_nationkey = c.k % 4 + 1 LEFT JOIN supplier s ON 'p' || s.s_suppkey = c.package WHERE c.k % 4 + 1 IN (1, 3)""")
def ad_click_detail(spark, sf):
    media = roles.table(spark, sf, "nation").select(F.col("n_nationkey").cast("int").alias("network"), F.concat(F.lit("tag"), "n_nationkey").alias("medium_tag"), F.col("n_name").alias("medium_name"))
    buyers = roles.table(spark, sf, "supplier").select(F.concat(F.lit("p"), "s_suppkey").alias("package"), F.col("s_name").alias("buyer"))
    out = attribution.ad_click_detail(ad_clicks(spark, sf), [1, 3], media, buyers)
    return out.select("click_id", "game_id", "package", "network", "medium_tag", "medium_name", "buyer")
