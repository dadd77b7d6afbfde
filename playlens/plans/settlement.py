"""Settlement and cost."""

from __future__ import annotations

from pyspark.sql import functions as F

from playlens.functions.cleanse import mark_sandbox, valid_orders
from playlens.operators import activity, payments, settlement
from playlens.operators.aggregates import roll_up
from playlens.operators.joins import valid_on
from playlens.plans import plan
from playlens.plans.activity import PACKAGE, PK
from playlens.session import write_stage
from playlens.sources import roles

GAMES = "(SELECT * FROM g_games WHERE state = 0)"


def games(spark, sf):
    return roles.games(spark, sf).filter("state = 0").select(F.col("child_game_id").cast("int").alias("game_id"), "parent_game_id", "system_type", "group_id")


def performance(spark, sf):
    orders = mark_sandbox(valid_orders(roles.game_orders(spark, sf)), roles.receipts(spark, sf))
    managers = roles.packages(spark, sf).select("package", F.col("head_people").alias("manager"))
    return settlement.performance_first(roles.regs(spark, sf), orders, games(spark, sf), managers)


FIRST = f"""WITH pf_p AS (SELECT day, account, game_id, pay_type, sum(cents) AS c, sum(CASE WHEN order_no IN (SELECT order_no FROM g_receipts WHERE state = 3) THEN cents ELSE 0 END) AS b
   FROM g_paid WHERE status = 4 GROUP BY ALL),
 pf_s AS (SELECT day, account, game_id FROM g_regs UNION SELECT day, account, game_id FROM g_paid),
 pf_j AS (SELECT s.day, s.game_id, h.medium, h.site, h.package, coalesce(p.pay_type, 0) AS pay_type, s.account, h.reg_day, coalesce(c, 0) AS c, coalesce(b, 0) AS b
   FROM pf_s s LEFT JOIN pf_p p USING (day, account, game_id) JOIN (SELECT DISTINCT account, reg_day, medium, site, package FROM g_regs) h ON h.account = s.account),
 pf AS (SELECT a.*, g.parent_game_id, g.system_type, g.group_id, coalesce(s.s_name, '') AS manager FROM (
   SELECT day, game_id, medium, site, package, pay_type, CAST(sum(c) AS BIGINT) AS pay_water, CAST(sum(b) AS BIGINT) AS box_water, count(DISTINCT CASE WHEN reg_day = day THEN account END) AS regi_num FROM pf_j GROUP BY ALL) a
   JOIN {GAMES} g ON g.child_game_id = a.game_id LEFT JOIN supplier s ON 'p' || s.s_suppkey = a.package)
"""


@plan("performance_first", FIRST + "SELECT * FROM pf")
def performance_first(spark, sf):
    return performance(spark, sf)


@plan("performance_feedback", FIRST + """SELECT game_id, day, CAST(sum(CASE WHEN pay_type = 5 THEN 0 ELSE pay_water END) AS BIGINT) AS own_water,
  CAST(sum(CASE WHEN pay_type = 5 THEN pay_water ELSE 0 END) AS BIGINT) AS store_water, CAST(sum(regi_num) AS BIGINT) AS regi_num FROM pf WHERE system_type = 2 GROUP BY ALL""")
def performance_feedback(spark, sf):
    return settlement.performance_feedback(performance(spark, sf))


# --- monthly shares on the ledger of several years --------------------------------------------------
ITEM = f"""WITH it AS (SELECT i.child_game_id, g.parent_game_id, i.day, sum(i.cents) AS pay_water, sum(CASE WHEN i.flag = 'A' THEN i.cents ELSE 0 END) AS apple_water,
   sum(CASE WHEN i.discount > 8 THEN i.cents // 4 ELSE 0 END) AS behalf_water FROM l_items i JOIN {GAMES} g USING (child_game_id) GROUP BY ALL),
 con AS (SELECT b AS contract_id, b AS parent_game_id, b * 100 AS my_rate, b % 2 AS division_rule, b * 10 AS slotting_fee, DATE '1995-01-01' AS start_month, DATE '2000-01-01' AS end_month FROM (SELECT DISTINCT parent_game_id AS b FROM g_games)
   UNION ALL SELECT b + 1000, b, b * 120, 0, b * 12, DATE '2000-01-01', DATE '2001-06-01' FROM (SELECT DISTINCT parent_game_id AS b FROM g_games)),
 ccon AS (SELECT child_game_id + 100000 AS contract_id, child_game_id, 4321 AS my_rate, CAST(child_game_id % 2 AS INT) AS division_rule, 77 AS slotting_fee, DATE '1997-01-01' AS start_month, DATE '1999-01-01' AS end_month FROM {GAMES} WHERE child_game_id % 5 = 0),
 lad AS (SELECT contract_id, 1000000 AS threshold, my_rate + 500 AS rate FROM con UNION ALL SELECT contract_id, 30000000, my_rate + 1500 FROM con
   UNION ALL SELECT contract_id, 5000000, my_rate + 700 FROM ccon),
 stp AS (SELECT * FROM lad UNION ALL SELECT contract_id, 0, my_rate FROM con UNION ALL SELECT contract_id, 0, my_rate FROM ccon),
 pm AS (SELECT parent_game_id, CAST(date_trunc('month', day) AS DATE) AS month, sum(pay_water - behalf_water) AS net FROM it GROUP BY ALL),
 cm AS (SELECT child_game_id, CAST(date_trunc('month', day) AS DATE) AS month, sum(pay_water - behalf_water) AS net FROM it GROUP BY ALL),
 pr AS (SELECT m.parent_game_id, m.month, c.slotting_fee, CASE WHEN c.division_rule = 1 THEN c.my_rate ELSE (SELECT arg_max(rate, threshold) FROM stp WHERE stp.contract_id = c.contract_id AND threshold <= greatest(m.net, 0)) END AS rule
   FROM pm m JOIN con c ON c.parent_game_id = m.parent_game_id AND m.month >= c.start_month AND m.month < c.end_month),
 cr AS (SELECT m.child_game_id, m.month, c.slotting_fee, CASE WHEN c.division_rule = 1 THEN c.my_rate ELSE (SELECT arg_max(rate, threshold) FROM stp WHERE stp.contract_id = c.contract_id AND threshold <= greatest(m.net, 0)) END AS rule
   FROM cm m JOIN ccon c ON c.child_game_id = m.child_game_id AND m.month >= c.start_month AND m.month < c.end_month),
 ps AS (SELECT k.month, k.parent_game_id, k.child_game_id, coalesce(cr.slotting_fee, pr.slotting_fee, 0) AS slotting_fee, coalesce(cr.rule, pr.rule, 0) AS division_rule
   FROM (SELECT DISTINCT CAST(date_trunc('month', day) AS DATE) AS month, parent_game_id, child_game_id FROM it) k LEFT JOIN pr USING (parent_game_id, month) LEFT JOIN cr USING (child_game_id, month))
"""


def item_days(spark, sf):
    g = roles.games(spark, sf).filter("state = 0").select("child_game_id", "parent_game_id")
    daily = roles.items(spark, sf).groupBy("child_game_id", "day").agg(
        F.sum("cents").alias("pay_water"), F.sum(F.when(F.col("flag") == "A", F.col("cents")).otherwise(0)).alias("apple_water"),
        F.sum(F.when(F.col("discount") > 8, F.expr("cents div 4")).otherwise(0)).alias("behalf_water"))
    # the first step's result is a stored table, from which shares and profit are computed
    return write_stage(daily.join(g, "child_game_id"), "performance-days")


def shares(spark, sf, daily):
    d = lambda x: F.lit(x).cast("date")
    p, b = roles.games(spark, sf).select("parent_game_id").distinct(), F.col("parent_game_id")
    contract = lambda cid, rate, rule, fee, start, end: F.struct(
        cid.cast("long").alias("contract_id"), rate.cast("int").alias("my_rate"), rule.cast("int").alias("division_rule"), fee.cast("int").alias("slotting_fee"), d(start).alias("start_month"), d(end).alias("end_month"))
    contracts = p.select("parent_game_id", F.inline(F.array(
        contract(b, b * 100, b % 2, b * 10, "1995-01-01", "2000-01-01"), contract(b + 1000, b * 120, F.lit(0), b * 12, "2000-01-01", "2001-06-01"))))
    c = F.col("child_game_id")
    child = roles.games(spark, sf).filter((F.col("state") == 0) & (c % 5 == 0)).select(
        (c + 100000).alias("contract_id"), "child_game_id", F.lit(4321).alias("my_rate"), (c % 2).cast("int").alias("division_rule"), F.lit(77).alias("slotting_fee"), d("1997-01-01").alias("start_month"), d("1999-01-01").alias("end_month"))
    step = lambda df, amount, more: df.select("contract_id", F.lit(amount).cast("long").alias("threshold"), (F.col("my_rate") + more).alias("rate"))
    ladder = step(contracts, 1_000_000, 500).unionByName(step(contracts, 30_000_000, 1500)).unionByName(step(child, 5_000_000, 700))
    # one base step per contract comes from the contract itself
    proxy = daily.select("day", "parent_game_id", "child_game_id", F.col("behalf_water").alias("proxy_cents"))
    return settlement.performance_second(daily, proxy, contracts, child, ladder)


@plan("performance_second", ITEM + "SELECT * FROM ps")
def performance_second(spark, sf):
    return shares(spark, sf, item_days(spark, sf))


@plan("profit", ITEM + """, pre AS (SELECT it.child_game_id, it.day, it.pay_water, it.apple_water, it.behalf_water, it.behalf_water // 20 AS behalf_cost, it.pay_water // 10 AS publish_cost,
   coalesce(slotting_fee, 0) AS slotting_fee, coalesce(division_rule, 0) AS division_rule, CASE it.parent_game_id % 4 WHEN 3 THEN 0.0627::DOUBLE WHEN 2 THEN 0.0336::DOUBLE ELSE 0.0::DOUBLE END AS bill
   FROM it LEFT JOIN ps ON ps.child_game_id = it.child_game_id AND ps.month = date_trunc('month', it.day)),
 cst AS (SELECT *, (pay_water - behalf_water) * (1 - slotting_fee / 10000::DOUBLE) * (1 - division_rule / 10000::DOUBLE) * (1 - bill) AS cost FROM pre)
 SELECT child_game_id, day, CAST(round(cost) AS BIGINT) AS cp_cost,
  CAST(round((pay_water - behalf_water) * 0.99::DOUBLE - cost - publish_cost - behalf_cost - (apple_water - behalf_water) * 0.3::DOUBLE) AS BIGINT) AS profit FROM cst""")
def profit(spark, sf):
    stored = item_days(spark, sf)
    daily = stored.withColumns({"month": F.trunc("day", "month"), "bill_type": F.col("parent_game_id") % 4,
                                              "behalf_cost": F.expr("behalf_water div 20"), "publish_cost": F.expr("pay_water div 10")})
    joined = daily.join(shares(spark, sf, stored).drop("parent_game_id"), ["child_game_id", "month"], "left").fillna(0, ["slotting_fee", "division_rule"])
    return settlement.profit(joined).select("child_game_id", "day", "cp_cost", "profit")


COST_SQL = """(SELECT order_no * 10 + line_no AS cost_id, child_game_id AS game_id, 'm' || (package_no % 4) AS medium, 's' || (package_no % 3) AS site, 'p' || package_no AS package, day AS cost_day,
   day + CAST(quantity AS INT) AS update_day, day - CAST(quantity AS INT) AS created, cents // 100 AS cost_cents, CASE WHEN tax = 0 THEN 0 ELSE 1 END AS status FROM l_items WHERE {})"""
AUDIT_SQL = "(SELECT order_no * 10 + line_no AS cost_id, max(day + CAST(discount AS INT) * 9) AS audit_day FROM l_items WHERE quantity % 3 = 0 GROUP BY ALL)"


def _costs(spark, sf):
    q = F.col("quantity")
    cost_id = (F.col("order_no") * 10 + F.col("line_no")).alias("cost_id")
    items = roles.items(spark, sf)
    pkg = F.col("package_no")
    rows = items.select(
        cost_id, F.col("child_game_id").alias("game_id"), F.concat(F.lit("m"), pkg % 4).alias("medium"), F.concat(F.lit("s"), pkg % 3).alias("site"), F.concat(F.lit("p"), pkg).alias("package"),
        F.col("day").alias("cost_day"), F.date_add("day", q).alias("update_day"), F.date_sub("day", q).alias("created"), F.expr("cents div 100").alias("cost_cents"),
        F.when(F.col("tax") == 0, 0).otherwise(1).alias("status"), "flag")
    audits = items.filter(q % 3 == 0).select(cost_id, F.date_add("day", F.col("discount") * 9).alias("audit_day"))
    return rows, audits


@plan("publish_cost", f"""WITH u AS (SELECT a.*, coalesce(x.audit_day, a.update_day) AS changed FROM {COST_SQL.format("flag <> 'N'")} a LEFT JOIN {AUDIT_SQL} x USING (cost_id)
   UNION ALL SELECT a.*, coalesce(x.audit_day, a.update_day) FROM {COST_SQL.format("flag = 'N' AND tax > 0")} a LEFT JOIN {AUDIT_SQL} x USING (cost_id)),
 c AS (SELECT cost_day, game_id, medium, site, package, CAST(sum(cost_cents) AS BIGINT) AS publish_cost, max(changed) AS changed FROM u WHERE status = 1 AND
  (changed BETWEEN DATE '1998-01-01' AND DATE '1998-12-31' OR created BETWEEN DATE '1998-01-01' AND DATE '1998-12-31' OR cost_day BETWEEN DATE '1998-01-01' AND DATE '1998-12-31') GROUP BY ALL)
 SELECT c.*, coalesce(p.promotion_channel, '') AS promotion_channel, coalesce(p.head_people, '') AS head_people FROM c JOIN {GAMES} g ON g.child_game_id = c.game_id
  LEFT JOIN g_packages p ON p.package = c.package AND c.cost_day BETWEEN p.mstart_date AND p.mend_date""")
def publish_cost(spark, sf):
    rows, audits = _costs(spark, sf)
    agents, ads = rows.filter("flag <> 'N'").drop("flag"), rows.filter("flag = 'N'").drop("flag")
    cost = settlement.publish_cost(agents, ads, audits, audits, "1998-01-01", "1998-12-31")
    known = cost.join(games(spark, sf).select("game_id"), "game_id", "left_semi")
    return valid_on(known, roles.packages(spark, sf), ["package"], "cost_day", [("mstart_date", "mend_date")]).fillna("", ["promotion_channel", "head_people"])


@plan("rank_effect", """WITH buy AS (SELECT CAST(p_partkey AS INT) AS game_id, DATE '2024-01-01' + CAST(p_size % 10 AS INT) AS s, DATE '2024-01-01' + CAST(p_size % 10 + p_partkey % 7 AS INT) AS e, CAST(p_retailprice * 100 AS BIGINT) AS cost FROM part),
 d AS (SELECT game_id, day, CAST(sum(CASE WHEN day = s THEN cost ELSE 0 END) AS BIGINT) AS cost_cents FROM (SELECT *, CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS day FROM buy) GROUP BY ALL),
 v AS (SELECT r.game_id, r.reg_day AS day, sum(o.cents) AS recharge, sum(o.cents * (r.game_id * 5 + 10)) AS own FROM (SELECT DISTINCT game_id, account, reg_day FROM g_regs) r JOIN (SELECT * FROM g_paid WHERE status = 4) o USING (account) GROUP BY ALL)
 SELECT d.game_id, d.day, cost_cents, CAST(coalesce(recharge, 0) AS BIGINT) AS recharge, CAST(coalesce(recharge, 0) - round(coalesce(own, 0) / 100) AS BIGINT) AS cp_cost, CAST(round(coalesce(own, 0) / 100) - cost_cents AS BIGINT) AS profit
 FROM d LEFT JOIN v USING (game_id, day)""")
def rank_effect(spark, sf):
    p = roles.table(spark, sf, "part")
    first = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("p_size") % 10).cast("int"))
    buy = p.select(F.col("p_partkey").cast("int").alias("game_id"), first.alias("start_day"), F.date_add(first, (F.col("p_partkey") % 7).cast("int")).alias("end_day"), F.round(F.col("p_retailprice") * 100).cast("long").alias("cost_cents"))
    orders = valid_orders(roles.game_orders(spark, sf), refunds=False)
    percent = roles.regs(spark, sf).select("game_id").distinct().select("game_id", F.lit("2024-01-01").cast("date").alias("month"), (F.col("game_id") * 5 + 10).cast("long").alias("percent"))
    return settlement.rank_effect(buy, roles.regs(spark, sf), orders, percent)


@plan("rank_effect_monthly", """WITH buy AS (SELECT p_partkey AS rank_id, CAST(p_partkey % 10 AS INT) AS game_id, DATE '2024-01-01' + CAST(p_size % 10 AS INT) AS s, DATE '2024-01-01' + CAST(p_size % 10 + p_partkey % 7 AS INT) AS e, CAST(p_retailprice * 100 AS BIGINT) AS cost FROM part),
 m AS (SELECT r.game_id, r.reg_day, CAST(date_trunc('month', o.day) AS DATE) AS month, sum(o.cents) AS c FROM (SELECT DISTINCT game_id, account, reg_day FROM g_regs) r JOIN (SELECT * FROM g_paid WHERE status = 4) o USING (account) GROUP BY ALL),
 u AS (SELECT b.rank_id, b.game_id, m.month, m.c AS recharge, m.c * (b.game_id * 5 + 10) AS own, 0 AS cost FROM buy b JOIN m ON m.game_id = b.game_id AND m.reg_day BETWEEN b.s AND b.e
   UNION ALL SELECT rank_id, game_id, CAST(date_trunc('month', s) AS DATE), 0, 0, cost FROM buy),
 g AS (SELECT rank_id, game_id, month, CAST(sum(cost) AS BIGINT) AS cost_cents, CAST(sum(recharge) AS BIGINT) AS recharge, CAST(round(sum(own) / 100) AS BIGINT) AS own FROM u GROUP BY ALL)
 SELECT rank_id, game_id, month, cost_cents, recharge, recharge - own AS cp_cost, own - cost_cents AS profit FROM g""")
def rank_effect_monthly(spark, sf):
    p = roles.table(spark, sf, "part")
    first = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("p_size") % 10).cast("int"))
    buy = p.select(F.col("p_partkey").alias("rank_id"), (F.col("p_partkey") % 10).cast("int").alias("game_id"), first.alias("start_day"),
                   F.date_add(first, (F.col("p_partkey") % 7).cast("int")).alias("end_day"), F.round(F.col("p_retailprice") * 100).cast("long").alias("cost_cents"))
    orders = valid_orders(roles.game_orders(spark, sf), refunds=False)
    percent = roles.regs(spark, sf).select("game_id").distinct().select("game_id", F.lit("2024-01-01").cast("date").alias("month"), (F.col("game_id") * 5 + 10).cast("long").alias("percent"))
    return settlement.rank_effect_monthly(buy, roles.regs(spark, sf), orders, percent)


@plan("rollup_migration", f"SELECT game_id, day, CAST(sum(n) AS BIGINT) AS new_devices FROM (SELECT {PK}, day, count(*) AS n FROM (SELECT {PK}, imei, min(day) AS day FROM g_regs WHERE imei <> '' GROUP BY ALL) GROUP BY ALL) GROUP BY ALL")
def rollup_migration(spark, sf):
    return roll_up(activity.new_device_kpi(roles.regs(spark, sf), PACKAGE, "day"), ["game_id", "day"], ["new_devices"])


@plan("day_report", f"""SELECT k.*, coalesce(a.pay_cents, 0) AS pay_cents, coalesce(a.payers, 0) AS payers FROM (SELECT {PK}, day, count(DISTINCT imei) AS registered_devices FROM g_regs WHERE imei <> '' GROUP BY ALL) k
 LEFT JOIN (SELECT {PK}, day, CAST(sum(cents) AS BIGINT) AS pay_cents, count(DISTINCT CASE WHEN status = 4 THEN account END) AS payers FROM g_paid GROUP BY ALL) a USING ({PK}, day)""")
def day_report(spark, sf):
    kpi = activity.registered_device_kpi(roles.regs(spark, sf), PACKAGE)
    pay = payments.pay_kpi(valid_orders(roles.game_orders(spark, sf)), PACKAGE, "day")
    return settlement.day_report(kpi, pay.select(*PACKAGE, "day", "pay_cents", F.col("pay_accounts").alias("payers")), [*PACKAGE, "day"])


@plan("package_dimension", """SELECT 'p' || s_suppkey AS package, 'agent' || s_nationkey AS promotion_channel, 'merchant' || (s_suppkey % 9) AS medium_account, s_name AS head_people, '' AS promotion_mode, DATE '2016-01-01' AS mstart_date, DATE '9999-01-01' AS mend_date FROM supplier
  UNION SELECT 'q' || p_partkey, p_brand, '', p_name, p_type, DATE '2016-01-01' + CAST(p_size AS INT), DATE '2024-01-01' + CAST(p_size AS INT) FROM part""")
def package_dimension(spark, sf):
    s, p = roles.table(spark, sf, "supplier"), roles.table(spark, sf, "part")
    media = s.select(F.concat(F.lit("p"), "s_suppkey").alias("package"), F.concat(F.lit("agent"), "s_nationkey").alias("promotion_channel"), F.concat(F.lit("merchant"), F.col("s_suppkey") % 9).alias("medium_account"), F.col("s_name").alias("head_people"))
    day = lambda start: F.date_add(F.lit(start).cast("date"), F.col("p_size"))
    channels = p.select(F.concat(F.lit("q"), "p_partkey").alias("package"), F.col("p_brand").alias("promotion_channel"), F.col("p_name").alias("head_people"), F.col("p_type").alias("promotion_mode"), day("2016-01-01").alias("mstart_date"), day("2024-01-01").alias("mend_date"))
    return settlement.package_dimension(media, channels)


@plan("dim_refresh", f"""SELECT k.*, coalesce(p.promotion_channel, '') AS promotion_channel, coalesce(p.head_people, '') AS head_people FROM (SELECT {PK}, day, count(DISTINCT imei) AS registered_devices FROM g_regs WHERE imei <> '' GROUP BY ALL) k
 LEFT JOIN g_packages p ON p.package = k.package AND k.day BETWEEN p.mstart_date AND p.mend_date""")
def dim_refresh(spark, sf):
    kpi = activity.registered_device_kpi(roles.regs(spark, sf), PACKAGE)
    stale = kpi.withColumns({"promotion_channel": F.lit("old"), "head_people": F.lit("old")})
    return settlement.restate(stale, roles.packages(spark, sf), "package", "day", ["promotion_channel", "head_people"])


@plan("alliance_dim", "SELECT s_nationkey AS bag, max(s_suppkey % 3) AS platform, max(s_name) AS company, max('h' || s_suppkey) AS head_people FROM supplier GROUP BY ALL")
def alliance_dim(spark, sf):
    bags = roles.table(spark, sf, "supplier").select(F.col("s_nationkey").alias("bag"), (F.col("s_suppkey") % 3).alias("platform"), F.col("s_name").alias("company"), F.concat(F.lit("h"), "s_suppkey").alias("head_people"))
    return settlement.alliance_dimension(bags)


@plan("ad_stats_restate", """SELECT c.game_id, c.package, c.day, c.clicks, coalesce(p.promotion_channel, '') AS promotion_channel FROM (SELECT game_id, package, day, count(*) AS clicks FROM g_clicks WHERE day = DATE '2024-01-15' GROUP BY ALL) c
  LEFT JOIN g_packages p ON p.package = c.package AND c.day BETWEEN p.mstart_date AND p.mend_date""")
def ad_stats_restate(spark, sf):
    """One day's statistics with today's dimension; the other days are not read."""
    one_day = roles.clicks(spark, sf).filter("day = DATE'2024-01-15'")
    stats = one_day.groupBy("game_id", "package", "day").agg(F.count("*").alias("clicks")).withColumn("promotion_channel", F.lit("old"))
    return settlement.restate(stats, roles.packages(spark, sf), "package", "day", ["promotion_channel"])
