"""Retention and lifetime value."""

from __future__ import annotations

from pyspark.sql import functions as F

from playlens.functions.cleanse import valid_orders
from playlens.operators import activity, cohort
from playlens.plans import plan
from playlens.sources import roles

PACKAGE = ["game_id", "medium", "site", "package"]


def _pivot_sql(source: str, keys: str, offsets, name="retained_{}", value="1") -> str:
    cols = ", ".join(f"CAST(sum(CASE WHEN dur = {n} THEN {value} ELSE 0 END) AS BIGINT) AS {name.format(n)}" for n in offsets)
    return f"SELECT {keys}, {cols} FROM ({source}) WHERE dur IN ({', '.join(map(str, offsets))}) GROUP BY {keys}"


def _ltv_cols(days, value="cents", name="ltv_{}") -> str:
    cond = lambda n: "dur = 0" if n == 1 else f"dur BETWEEN 0 AND {n - 1}"
    return ", ".join(f"CAST(sum(CASE WHEN {cond(n)} THEN {value} ELSE 0 END) AS BIGINT) AS {name.format(n)}" for n in days)


def paid(spark, sf):
    return valid_orders(roles.game_orders(spark, sf))


ACCOUNT_PAIRS = """SELECT DISTINCT r.game_id, r.medium, r.site, r.package, r.reg_day, r.account, date_diff('day', r.reg_day, l.day) AS dur
  FROM g_regs r JOIN g_logins l ON r.account = l.account"""


@plan("account_retention", _pivot_sql(ACCOUNT_PAIRS, "game_id, medium, site, package, reg_day", cohort.RETENTION_OFFSETS))
def account_retention(spark, sf):
    return cohort.retention(roles.regs(spark, sf), roles.logins(spark, sf), ["account"], PACKAGE, ["account"])


@plan("device_retention_package", _pivot_sql("""SELECT DISTINCT r.game_id, r.medium, r.site, r.package, r.reg_day, r.imei, date_diff('day', r.reg_day, l.day) AS dur
  FROM g_regs r JOIN g_logins l USING (game_id, medium, site, package, imei) WHERE r.imei <> ''""",
    "game_id, medium, site, package, reg_day", cohort.PACKAGE_RETENTION_OFFSETS))
def device_retention_package(spark, sf):
    regs = roles.regs(spark, sf).filter("imei <> ''")
    return cohort.retention(regs, roles.logins(spark, sf), [*PACKAGE, "imei"], PACKAGE, ["imei"], offsets=cohort.PACKAGE_RETENTION_OFFSETS)


@plan("device_retention_game", _pivot_sql("""SELECT DISTINCT r.game_id, g.parent_game_id, g.system_type, g.group_id, r.reg_day, r.imei, date_diff('day', r.reg_day, l.day) AS dur
  FROM g_regs r JOIN g_logins l USING (game_id, imei) JOIN g_games g ON g.child_game_id = r.game_id AND g.state = 0 WHERE r.imei <> ''""",
    "game_id, parent_game_id, system_type, group_id, reg_day", cohort.RETENTION_OFFSETS))
def device_retention_game(spark, sf):
    regs = roles.regs(spark, sf).filter("imei <> ''")
    games = roles.games(spark, sf).filter("state = 0").drop("state").withColumnRenamed("child_game_id", "game_id")
    # the dimension joins the finished counts: one row per game and day, not per device
    counts = cohort.retention(regs, roles.logins(spark, sf), ["game_id", "imei"], ["game_id"], ["imei"])
    return counts.join(games, "game_id")


@plan("register_login_count", """SELECT game_id, reg_day, count(*) AS regi_logins FROM (SELECT DISTINCT r.game_id, r.medium, r.site, r.package, r.reg_day, r.account
  FROM g_regs r JOIN g_logins l ON r.account = l.account AND r.reg_day = l.day) GROUP BY ALL""")
def register_login_count(spark, sf):
    pairs = cohort.cohort_days(roles.regs(spark, sf), roles.logins(spark, sf), ["account"], PACKAGE, ["account"], "reg_day", "day", [0])
    return pairs.groupBy("game_id", "reg_day").agg(F.count("*").alias("regi_logins"))


@plan("sdk_retention", f"""WITH firsts AS (SELECT account, min(day) AS first_day FROM g_logins GROUP BY account),
 homes AS (SELECT DISTINCT account, game_id, medium FROM g_regs),
 got AS ({_pivot_sql('''SELECT DISTINCT h.game_id, h.medium, f.first_day, f.account, date_diff('day', f.first_day, l.day) AS dur
   FROM firsts f JOIN homes h USING (account) JOIN g_logins l USING (account)''', 'game_id, medium, first_day', cohort.SDK_OFFSETS)}),
 spine AS (SELECT DISTINCT game_id, medium, CAST(d AS DATE) AS first_day FROM g_regs, generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY) t(d))
 SELECT s.game_id, s.medium, s.first_day, {', '.join(f'coalesce(retained_{n}, 0) AS retained_{n}' for n in cohort.SDK_OFFSETS)}
 FROM spine s LEFT JOIN got USING (game_id, medium, first_day)""")
def sdk_retention(spark, sf):
    regs, logins = roles.regs(spark, sf), roles.logins(spark, sf)
    homes = regs.select("account", "game_id", "medium").distinct()
    firsts = logins.groupBy("account").agg(F.min("day").alias("first_day")).join(homes, "account")
    return cohort.dense_retention(firsts, logins, ["account"], ["game_id", "medium"], homes, roles.TEST_START, roles.TEST_END)


@plan("card_retention", _pivot_sql("""SELECT DISTINCT r.game_id, r.package, r.reg_day, r.account, date_diff('day', r.reg_day, l.day) AS dur
  FROM g_regs r JOIN g_logins l USING (account) WHERE r.package <> ''""", "game_id, package, reg_day", cohort.CARD_OFFSETS))
def card_retention(spark, sf):
    regs = roles.regs(spark, sf).filter("package <> ''")
    return cohort.retention(regs, roles.logins(spark, sf), ["account"], ["game_id", "package"], ["account"], offsets=cohort.CARD_OFFSETS)


@plan("common_sdk_retention", _pivot_sql("""SELECT DISTINCT l.game_id, a.medium, a.reg_day, l.account, date_diff('day', a.reg_day, l.day) AS dur
  FROM (SELECT account, min(day) AS reg_day, min(medium) AS medium FROM g_regs GROUP BY account) a JOIN g_logins l USING (account)""",
    "game_id, medium, reg_day", cohort.COMMON_SDK_OFFSETS))
def common_sdk_retention(spark, sf):
    accounts = roles.regs(spark, sf).groupBy("account").agg(F.min("reg_day").alias("reg_day"), F.min("medium").alias("medium"))
    # the game is that of the login, so it is part of the event side
    seen = roles.logins(spark, sf).select("account", "game_id", "day").distinct()
    pairs = seen.join(accounts, "account").withColumn("dur", F.datediff("day", "reg_day")).filter(F.col("dur").isin(cohort.COMMON_SDK_OFFSETS))
    from playlens.operators.aggregates import pivot_offsets
    return pivot_offsets(pairs, ["game_id", "medium", "reg_day"], "dur", cohort.COMMON_SDK_OFFSETS, F.lit(1), "retained_{}")


LTV_SOURCE = """SELECT r.*, o.cents, date_diff('day', r.reg_day, o.day) AS dur
  FROM (SELECT DISTINCT game_id, medium, site, package, reg_day, account FROM g_regs) r LEFT JOIN g_paid o ON o.account = r.account"""


@plan("ltv", f"SELECT game_id, medium, site, package, reg_day, {_ltv_cols(cohort.LTV_DAYS)}, CAST(coalesce(sum(cents), 0) AS BIGINT) AS all_cents FROM ({LTV_SOURCE}) GROUP BY ALL")
def ltv(spark, sf):
    return cohort.cohort_value(roles.regs(spark, sf), paid(spark, sf), ["account"], PACKAGE, total="all_cents")


@plan("ltv_pre_reg", "SELECT game_id, reg_day, " + ", ".join(
    f"CAST(sum(CASE WHEN {'dur = 0' if n == 1 else f'dur <= {n - 1}'} THEN cents ELSE 0 END) AS BIGINT) AS ltv_{n}" for n in (1, 3, 7, 30))
    + """ FROM (SELECT r.*, o.cents, date_diff('day', r.reg_day, o.day) AS dur FROM (SELECT DISTINCT game_id, reg_day, account FROM g_regs) r
    LEFT JOIN g_paid o ON o.account = r.account) GROUP BY ALL""")
def ltv_pre_reg(spark, sf):
    return cohort.cohort_value(roles.regs(spark, sf), paid(spark, sf), ["account"], ["game_id"], days=(1, 3, 7, 30), allow_pre_reg=True)


LEDGER_COHORT = "(SELECT account, game_id, min(reg_day) AS reg_day FROM l_regs GROUP BY account, game_id)"


@plan("ledger_retention", _pivot_sql(f"SELECT DISTINCT r.game_id, r.reg_day, r.account, date_diff('day', r.reg_day, o.day) AS dur FROM {LEDGER_COHORT} r JOIN l_orders o USING (account)",
    "game_id, reg_day", cohort.RETENTION_OFFSETS))
def ledger_retention(spark, sf):
    born = roles.account_regs(spark, sf).groupBy("account", "game_id").agg(F.min("reg_day").alias("reg_day"))
    return cohort.retention(born, roles.ledger(spark, sf), ["account"], ["game_id"], ["account"])


@plan("ltv_net", f"""WITH shares AS (SELECT CAST(g AS INT) AS game_id, CAST(m AS DATE) AS month, CAST((g * 300 + month(m) * 100) % 9000 AS BIGINT) AS rate_bp
   FROM (SELECT DISTINCT game_id AS g, date_trunc('month', day) AS m FROM l_orders)),
 proxy AS (SELECT game_id, day, sum(cents // 10) AS proxy_cents FROM l_orders WHERE status = 4 AND prod_type = 2 GROUP BY ALL),
 regs AS (SELECT account, game_id, min(reg_day) AS reg_day FROM l_regs GROUP BY ALL),
 paid AS (SELECT account, day, sum(cents) AS cents FROM l_orders WHERE status = 4 GROUP BY ALL),
 v AS (SELECT r.game_id, r.reg_day, p.cents, p.cents * coalesce(s.rate_bp, 0) AS a, date_diff('day', r.reg_day, p.day) AS dur FROM regs r JOIN paid p USING (account)
   LEFT JOIN shares s ON s.game_id = r.game_id AND s.month = date_trunc('month', p.day)),
 x AS (SELECT r.game_id, r.reg_day, p.proxy_cents AS cents, p.proxy_cents * coalesce(s.rate_bp, 0) AS a, date_diff('day', r.reg_day, p.day) AS dur
   FROM (SELECT DISTINCT game_id, reg_day FROM regs) r JOIN proxy p USING (game_id) LEFT JOIN shares s ON s.game_id = r.game_id AND s.month = date_trunc('month', p.day)),
 n AS (SELECT game_id, reg_day, cents, a, dur FROM v UNION ALL SELECT game_id, reg_day, -cents, -a, dur FROM x
   UNION ALL SELECT DISTINCT game_id, reg_day, 0, 0, 0 FROM regs),
 size AS (SELECT game_id, reg_day, count(*) AS accounts FROM regs GROUP BY ALL),
 cost AS (SELECT game_id, day AS reg_day, sum(cents // 50) AS publish_cost FROM l_orders WHERE status = 0 GROUP BY ALL),
 vals AS (SELECT game_id, reg_day, {_ltv_cols((1, 7, 30, 90, 180), 'cents', 'b_{}')}, {_ltv_cols((1, 7, 30, 90, 180), 'a', 'a_{}')} FROM n GROUP BY ALL)
 SELECT vals.*, CAST(accounts AS BIGINT) AS accounts, CAST(accounts // 2 AS BIGINT) AS devices, CAST(coalesce(publish_cost, 0) AS BIGINT) AS publish_cost
 FROM vals JOIN size USING (game_id, reg_day) LEFT JOIN cost USING (game_id, reg_day)""")
def ltv_net(spark, sf):
    led = roles.ledger(spark, sf)
    month = F.trunc("day", "month")
    shares = led.select("game_id", month.alias("month")).distinct().withColumn(
        "rate_bp", ((F.col("game_id") * 300 + F.month("month") * 100) % 9000).cast("long"))
    proxy = led.filter("status = 4 and prod_type = 2").select("game_id", "day", F.expr("cents div 10").alias("proxy_cents"))
    costs = led.filter("status = 0").select("game_id", "day", F.expr("cents div 50").alias("cost_cents"))
    born = roles.account_regs(spark, sf).groupBy("account", "game_id").agg(F.min("reg_day").alias("reg_day"))
    devices = born.groupBy("game_id", "reg_day").agg(F.expr("count(*) div 2").alias("devices"))
    return cohort.ltv_net(born, led.filter("status = 4"), proxy, shares, costs, devices, days=(1, 7, 30, 90, 180))


@plan("cumulative_payers", """WITH regs AS (SELECT DISTINCT game_id, medium, reg_day, account FROM g_regs),
 pairs AS (SELECT r.*, o.day, sum(o.cents) AS cents FROM regs r JOIN g_paid o USING (account) WHERE date_diff('day', r.reg_day, o.day) BETWEEN 0 AND 15 GROUP BY ALL),
 firsts AS (SELECT game_id, medium, reg_day, account, min(day) AS first_day FROM pairs GROUP BY ALL),
 spine AS (SELECT c.*, CAST(c.reg_day + CAST(i AS INT) AS DATE) AS day, i + 1 AS day_no FROM (SELECT DISTINCT game_id, medium, reg_day FROM pairs) c, range(16) t(i)
   WHERE c.reg_day + CAST(i AS INT) <= DATE '2024-01-30')
 SELECT s.game_id, s.medium, s.reg_day, CAST(s.day_no AS INT) AS day_no,
  (SELECT count(*) FROM firsts f WHERE f.game_id = s.game_id AND f.medium = s.medium AND f.reg_day = s.reg_day AND f.first_day <= s.day) AS payers,
  CAST((SELECT coalesce(sum(cents), 0) FROM pairs p WHERE p.game_id = s.game_id AND p.medium = s.medium AND p.reg_day = s.reg_day AND p.day <= s.day) AS BIGINT) AS pay_cents
 FROM spine s""")
def cumulative_payers(spark, sf):
    return cohort.cumulative_payers(roles.regs(spark, sf), paid(spark, sf), ["account"], ["game_id", "medium"], "reg_day", roles.TEST_END)


@plan("payers_by_cohort_day", "SELECT game_id, reg_day, " + ", ".join(f"CAST(count(CASE WHEN dur = {n} THEN 1 END) AS BIGINT) AS payers_{n}" for n in cohort.RETENTION_OFFSETS)
    + """ FROM (SELECT DISTINCT r.game_id, r.reg_day, r.account, date_diff('day', r.reg_day, o.day) AS dur FROM g_regs r LEFT JOIN
    (SELECT * FROM g_paid WHERE status = 4) o USING (account)) GROUP BY ALL""")
def payers_by_cohort_day(spark, sf):
    return cohort.payers_by_cohort_day(roles.regs(spark, sf), paid(spark, sf).filter("status = 4"), ["account"], ["game_id"])


def _alliance_sql():
    given = lambda expr: ", ".join(f"{expr.get(c, '0')} AS {c}" for c in cohort.ALLIANCE_MEASURES)
    group = "GROUP BY game_id, medium, day"
    live = "(SELECT * FROM g_paid WHERE order_no NOT IN (SELECT order_no FROM g_receipts WHERE sandbox = 1 AND state = 3))"
    sold = f"(SELECT account, day, sum(cents) AS cents FROM {live} WHERE status = 4 GROUP BY ALL)"
    born = "(SELECT DISTINCT game_id, medium, day AS reg_day, account FROM g_regs)"
    dur = "date_diff('day', r.reg_day, x.day)"
    ret = {f"retained_{n}": f"count(DISTINCT CASE WHEN dur = {n} THEN account END)" for n in cohort.REALTIME_OFFSETS}
    ltv = {f"ltv_{n}": f"sum(CASE WHEN dur BETWEEN 0 AND {n - 1} THEN cents ELSE 0 END)" for n in cohort.ALLIANCE_LTV_DAYS}
    whole = " UNION ALL ".join([
        f"SELECT game_id, medium, day, {given({'regi_accounts': 'count(DISTINCT account)'})} FROM g_regs {group}",
        f"SELECT game_id, medium, day, {given({'active_devices': 'count(*)'})} FROM (SELECT game_id, medium, CAST(min(ts) AS DATE) AS day FROM g_actives WHERE imei <> '' GROUP BY game_id, medium, imei) {group}",
        f"SELECT game_id, medium, day, {given({'pay_cents': 'sum(cents)'})} FROM (SELECT DISTINCT game_id, medium, account FROM g_regs) h JOIN (SELECT account, day, cents FROM {live}) o USING (account) {group}",
        f"SELECT game_id, medium, day, {given({'new_pay_accounts': 'count(*)', 'new_pay_cents': 'sum(cents)'})} FROM (SELECT DISTINCT game_id, medium, day, account FROM g_regs) r JOIN {sold} s USING (account, day) {group}",
        f"SELECT game_id, medium, day, {given({'new_pay_devices': 'count(DISTINCT imei)'})} FROM (SELECT * FROM g_regs WHERE imei <> '') r JOIN {sold} s USING (account, day) {group}",
        f"SELECT game_id, medium, day, {given({'dau_accounts': 'count(DISTINCT account)'})} FROM g_logins {group}",
        f"SELECT game_id, medium, day, {given(ret)} FROM (SELECT r.game_id, r.medium, r.reg_day AS day, r.account, {dur} AS dur FROM {born} r JOIN g_logins x ON x.account = r.account) {group}",
        f"SELECT game_id, medium, day, {given(ltv)} FROM (SELECT r.game_id, r.medium, r.reg_day AS day, x.cents, {dur} AS dur FROM {born} r JOIN {live} x ON x.account = r.account) {group}",
    ])
    sums = ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in cohort.ALLIANCE_MEASURES)
    return f"""SELECT a.*, coalesce(n.parent_game_id, 0) AS parent_game_id FROM (SELECT game_id, medium, day, {sums} FROM ({whole}) GROUP BY ALL) a
     LEFT JOIN g_games n ON n.child_game_id = a.game_id AND n.state = 0"""


@plan("alliance_kpi", _alliance_sql())
def alliance_kpi(spark, sf):
    from playlens.functions.cleanse import drop_sandbox
    orders = drop_sandbox(paid(spark, sf), roles.receipts(spark, sf))
    kpi = cohort.alliance_kpi(roles.actives(spark, sf), roles.regs(spark, sf), roles.logins(spark, sf), orders, ["game_id", "medium"])
    games = roles.games(spark, sf).filter("state = 0").select(F.col("child_game_id").alias("game_id"), "parent_game_id")
    return kpi.join(games, "game_id", "left").fillna(0, ["parent_game_id"])
