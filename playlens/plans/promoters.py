"""Promoters and rebates."""

from __future__ import annotations

from pyspark.sql import functions as F

from playlens.functions.cleanse import valid_orders
from playlens.operators import promoters
from playlens.plans import plan, within_query
from playlens.session import write_stage
from playlens.sources import roles

OWNER = """WITH cand AS (SELECT account, reg_ts, owner_id AS owner FROM l_regs WHERE coalesce(owner_id, 0) <> 0
   UNION ALL SELECT r.account, r.reg_ts, CASE WHEN coalesce(r.owner_id, 0) <> 0 THEN r.owner_id ELSE p.member_id END FROM l_regs r JOIN l_promoters p ON p.code = replace(r.expand_code, '.', '') WHERE r.resource = 8 AND r.expand_code IS NOT NULL
   UNION ALL SELECT r.account, r.reg_ts, CASE WHEN coalesce(r.owner_id, 0) <> 0 THEN r.owner_id ELSE p.member_id END FROM l_regs r JOIN l_promoters p ON p.username = r.bind_name WHERE r.resource = 6
   UNION ALL SELECT r.account, r.reg_ts, p.member_id FROM l_regs r JOIN l_promoters p ON p.username = r.bind_name WHERE r.resource = 8 AND r.expand_code IS NULL AND coalesce(r.owner_id, 0) = 0),
 own AS (SELECT account, arg_min(owner, (reg_ts, owner)) AS owner, CAST(min(reg_ts) AS DATE) AS relate_day FROM cand GROUP BY account),
 fst AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY account ORDER BY reg_ts, reg_id) AS rn FROM l_regs) WHERE rn = 1),
 bnd AS (SELECT account, CAST(min(order_ts) AS DATE) AS bind_day, arg_min(prod_type, (order_ts, order_no)) AS prod FROM l_orders WHERE status = 4 GROUP BY account),
 am AS MATERIALIZED (SELECT f.account, f.game_id, f.channel_id, f.os, f.reg_day, o.owner, o.relate_day, b.bind_day, CASE WHEN b.prod IN (1, 3) THEN 2 WHEN f.resource = 8 THEN 1 ELSE 3 END AS kind
   FROM fst f JOIN own o USING (account) LEFT JOIN bnd b USING (account)),
 act AS (SELECT * FROM l_promoters WHERE status IN (0, 1) AND member_grade = 1),
 so AS (SELECT * FROM l_orders WHERE status IN (4, 8))
"""


def account_map(spark, sf):
    return promoters.account_owner_map(roles.account_regs(spark, sf), roles.promoters(spark, sf), roles.ledger(spark, sf))


def base(spark, sf):
    """The account map is a detail table: written once per query."""
    return within_query("account-map", lambda: write_stage(account_map(spark, sf), "account-map")), roles.ledger(spark, sf), roles.promoters(spark, sf)


def logins(spark, sf):
    return roles.ledger(spark, sf).select("account", "day")


@plan("account_owner_map", OWNER + "SELECT * FROM am")
def account_owner_map(spark, sf):
    return account_map(spark, sf)


@plan("promoter_extend", OWNER + """SELECT u.*, p.username FROM (SELECT member_id, day, game_id, os, CAST(sum(a) AS BIGINT) AS add_users, CAST(sum(r) AS BIGINT) AS add_regi_accounts FROM (
  SELECT owner AS member_id, bind_day AS day, game_id, os, 1 AS a, 0 AS r FROM am WHERE bind_day IS NOT NULL UNION ALL SELECT owner, relate_day, game_id, os, 0, 1 FROM am) GROUP BY ALL) u JOIN act p USING (member_id)""")
def promoter_extend(spark, sf):
    accounts, _, members = base(spark, sf)
    return promoters.promoter_extend(accounts, members)


@plan("promoter_deals", OWNER + """SELECT u.*, p.username FROM (SELECT member_id, day, game_id, channel_id, os, CAST(sum(c) AS BIGINT) AS rec_cents, CAST(sum(r) AS BIGINT) AS reb_cents, CAST(sum(d) AS BIGINT) AS deals, CAST(sum(a) AS BIGINT) AS add_users FROM (
  SELECT o.member_id, o.day, o.game_id, o.channel_id, coalesce(m.os, 0) AS os, o.cents AS c, o.rebate_cents AS r, 1 AS d, 0 AS a FROM so o LEFT JOIN am m USING (account)
  UNION ALL SELECT owner, bind_day, game_id, channel_id, os, 0, 0, 0, 1 FROM am WHERE bind_day IS NOT NULL) GROUP BY ALL) u JOIN act p USING (member_id)""")
def promoter_deals(spark, sf):
    return promoters.promoter_deals(*base(spark, sf))


@plan("promoter_account_orders", OWNER + """SELECT o.day, o.member_id, p.username, o.account, o.order_no, o.status, o.cents, o.rebate_cents, m.channel_id AS reg_channel, CASE WHEN m.kind = 1 THEN 1 ELSE 2 END AS reg_type,
  CASE WHEN prod_type IN (1, 3) THEN 0 WHEN prod_type IN (2, 4) THEN 1 WHEN prod_type = 6 THEN 2 ELSE 100 END AS rec_type,
  CASE WHEN m.bind_day IS NULL OR m.bind_day < o.day OR m.owner <> o.member_id THEN 0 ELSE 1 END AS is_user_add FROM so o JOIN am m USING (account) JOIN act p USING (member_id)""")
def promoter_account_orders(spark, sf):
    return promoters.promoter_account_orders(*base(spark, sf))


@plan("promoter_account_info", OWNER + """SELECT m.account, m.owner, p.username, m.game_id, CASE WHEN m.kind = 1 THEN 1 ELSE 2 END AS user_type, m.relate_day, l.last_login_day, CASE WHEN m.bind_day IS NULL THEN 0 ELSE 1 END AS is_recharge, m.os
  FROM am m JOIN l_promoters p ON p.member_id = m.owner LEFT JOIN (SELECT account, max(day) AS last_login_day FROM l_orders GROUP BY account) l ON l.account = m.account WHERE m.owner <> 0""")
def promoter_account_info(spark, sf):
    accounts, _, members = base(spark, sf)
    return promoters.promoter_account_info(accounts, logins(spark, sf), members)


PLAYER = "member_id <> user_id AND prod_type IN (2, 4) AND member_id <> 0 AND user_id <> 0"


@plan("promoter_account_totals", OWNER + f"""SELECT t.*, m.reg_day, CASE WHEN m.kind = 1 THEN 'package' ELSE 'bought' END AS resource, p.username FROM (SELECT member_id, account, game_id,
  CAST(sum(CASE WHEN prod_type IN (1, 3) THEN cents ELSE 0 END) AS BIGINT) AS first_cents, CAST(sum(CASE WHEN prod_type IN (2, 4) AND NOT ({PLAYER}) THEN cents ELSE 0 END) AS BIGINT) AS repeat_cents,
  CAST(sum(CASE WHEN {PLAYER} THEN cents ELSE 0 END) AS BIGINT) AS by_player_cents, CAST(sum(CASE WHEN prod_type = 6 THEN cents ELSE 0 END) AS BIGINT) AS direct_cents,
  CAST(sum(rebate_cents) AS BIGINT) AS rebate_cents, CAST(sum(cents) AS BIGINT) AS total_cents FROM so WHERE prod_type IN (1, 2, 3, 4, 6) GROUP BY ALL) t JOIN am m USING (account) JOIN act p USING (member_id)""")
def promoter_account_totals(spark, sf):
    return promoters.promoter_account_totals(*base(spark, sf))


@plan("promoter_game_totals", OWNER + """, hm AS (SELECT account, channel_id, CASE os WHEN 1 THEN 'android' ELSE 'ios' END AS os_name FROM am)
 SELECT u.*, i.icon, p.username FROM (SELECT member_id, game_id, channel_id, os_name, CAST(sum(n) AS BIGINT) AS accounts, CAST(sum(b) AS BIGINT) AS deal_accounts, CAST(sum(c) AS BIGINT) AS income, CAST(sum(dc) AS BIGINT) AS direct_income, CAST(sum(r) AS BIGINT) AS rebate, CAST(sum(d) AS BIGINT) AS deals FROM (
  SELECT o.member_id, o.game_id, h.channel_id, h.os_name, 0 AS n, 0 AS b, o.cents AS c, CASE WHEN prod_type = 6 THEN cents ELSE 0 END AS dc, rebate_cents AS r, 1 AS d FROM so o JOIN hm h USING (account)
  UNION ALL SELECT m.owner, m.game_id, h.channel_id, h.os_name, 1, CASE WHEN m.bind_day IS NULL THEN 0 ELSE 1 END, 0, 0, 0, 0 FROM am m JOIN hm h USING (account)) GROUP BY ALL) u
 JOIN (SELECT CAST(p_partkey % 20 AS INT) AS game_id, arg_min(p_name, (p_size, p_partkey)) AS icon FROM part GROUP BY ALL) i USING (game_id) JOIN act p USING (member_id)""")
def promoter_game_totals(spark, sf):
    icons = roles.table(spark, sf, "part").select((F.col("p_partkey") % 20).cast("int").alias("game_id"), F.col("p_size").alias("status"), F.col("p_partkey").alias("child_game_id"), F.col("p_name").alias("icon"))
    return promoters.promoter_game_totals(*base(spark, sf), icons)


@plan("promoter_login_detail", OWNER + "SELECT DISTINCT l.account, l.day AS login_day, m.owner, m.game_id, m.channel_id, m.os, p.username FROM l_orders l JOIN am m USING (account) JOIN l_promoters p ON p.member_id = m.owner AND p.status = 0 AND p.member_grade = 1")
def promoter_login_detail(spark, sf):
    accounts, _, members = base(spark, sf)
    return promoters.promoter_login_detail(accounts, logins(spark, sf), members)


REPORT = ["first_income", "repeat_income", "by_player_income", "direct_income", "direct_rebate", "player_rebate", "add_users"]


@plan("promoter_report", OWNER + f"""SELECT u.*, p.owner_id, p.username, p.group_id, first_income + repeat_income + by_player_income + direct_income AS income FROM (SELECT member_id, day, game_id, channel_id, {', '.join(f'CAST(sum({c}) AS BIGINT) AS {c}' for c in REPORT)} FROM (
  SELECT member_id, day, game_id, channel_id, CASE WHEN prod_type IN (1, 3) THEN cents ELSE 0 END AS first_income, CASE WHEN prod_type IN (2, 4) AND NOT ({PLAYER}) THEN cents ELSE 0 END AS repeat_income,
   CASE WHEN {PLAYER} THEN cents ELSE 0 END AS by_player_income, CASE WHEN prod_type = 6 THEN cents ELSE 0 END AS direct_income, CASE WHEN prod_type = 6 THEN rebate_cents ELSE 0 END AS direct_rebate,
   CASE WHEN {PLAYER} THEN rebate_cents ELSE 0 END AS player_rebate, 0 AS add_users FROM so
  UNION ALL SELECT owner, bind_day, game_id, channel_id, 0, 0, 0, 0, 0, 0, 1 FROM am WHERE bind_day IS NOT NULL) GROUP BY ALL) u JOIN act p USING (member_id)""")
def promoter_report(spark, sf):
    return promoters.promoter_report(*base(spark, sf))


DAY = "1999-06-17"


@plan("promoter_operations", OWNER + f"""SELECT a.*, coalesce(b.sub_income, 0) AS sub_income, coalesce(b.sub_rebate, 0) AS sub_rebate, coalesce(b.sub_month_income, 0) AS sub_month_income, coalesce(b.sub_deal_accounts, 0) AS sub_deal_accounts,
   coalesce(b.sub_accounts, 0) AS sub_accounts, coalesce(b.sub_accounts_no, 0) AS sub_accounts_no, a.income + coalesce(b.sub_income, 0) AS all_income, a.rebate + coalesce(b.sub_rebate, 0) AS all_rebate, a.accounts + coalesce(b.sub_accounts, 0) AS all_accounts
 FROM (SELECT x.*, p.username FROM one x JOIN act p USING (member_id)) a LEFT JOIN (SELECT p.owner_id AS member_id, CAST(sum(income) AS BIGINT) AS sub_income, CAST(sum(rebate) AS BIGINT) AS sub_rebate, CAST(sum(month_income) AS BIGINT) AS sub_month_income,
   CAST(sum(deal_accounts) AS BIGINT) AS sub_deal_accounts, CAST(sum(accounts) AS BIGINT) AS sub_accounts, count(CASE WHEN p.created <= DATE '{DAY}' THEN 1 END) AS sub_accounts_no FROM one JOIN l_promoters p USING (member_id) WHERE p.owner_id <> 0 GROUP BY ALL) b USING (member_id)"""
    .replace("SELECT a.*", f""", one AS (SELECT p.member_id, CAST(coalesce(o.income, 0) AS BIGINT) AS income, CAST(coalesce(o.rebate, 0) AS BIGINT) AS rebate, CAST(coalesce(o.month_income, 0) AS BIGINT) AS month_income, coalesce(h.package_regs, 0) AS package_regs,
   coalesce(h.bought_accounts, 0) AS bought_accounts, coalesce(h.deal_accounts, 0) AS deal_accounts, coalesce(h.accounts, 0) AS accounts FROM l_promoters p
   LEFT JOIN (SELECT member_id, sum(cents) AS income, sum(rebate_cents) AS rebate, sum(CASE WHEN day >= DATE '1999-06-01' THEN cents ELSE 0 END) AS month_income FROM so WHERE day <= DATE '{DAY}' GROUP BY ALL) o USING (member_id)
   LEFT JOIN (SELECT owner AS member_id, count(CASE WHEN kind = 1 THEN 1 END) AS package_regs, count(CASE WHEN kind = 2 THEN 1 END) AS bought_accounts, count(CASE WHEN bind_day <= DATE '{DAY}' THEN 1 END) AS deal_accounts, count(*) AS accounts FROM am WHERE reg_day <= DATE '{DAY}' GROUP BY ALL) h USING (member_id))
 SELECT a.*""", 1))
def promoter_operations(spark, sf):
    return promoters.promoter_operations(*base(spark, sf), DAY)


@plan("promoter_day", OWNER + """SELECT member_id, day, CAST(sum(i) AS BIGINT) AS day_income, CAST(sum(r) AS BIGINT) AS day_profit, CAST(sum(n) AS BIGINT) AS day_add_users FROM (
  SELECT member_id, day, cents AS i, rebate_cents AS r, 0 AS n FROM so UNION ALL SELECT member_id, min(day), 0, 0, 1 FROM l_orders WHERE status = 4 GROUP BY member_id, account) WHERE member_id IN (SELECT member_id FROM act) GROUP BY ALL""")
def promoter_day(spark, sf):
    return promoters.promoter_day(roles.ledger(spark, sf), roles.promoters(spark, sf))


@plan("promoter_running", """SELECT member_id, day, CAST(sum(cents) AS BIGINT) AS cents, CAST(sum(rebate_cents) AS BIGINT) AS rebate_cents, CAST(sum(sum(cents)) OVER w AS BIGINT) AS total_cents, CAST(sum(sum(rebate_cents)) OVER w AS BIGINT) AS total_rebate_cents
  FROM l_orders WHERE status IN (4, 8) GROUP BY member_id, day WINDOW w AS (PARTITION BY member_id ORDER BY day)""")
def promoter_running(spark, sf):
    return promoters.promoter_running(roles.ledger(spark, sf))


@plan("sub_promoter_daily", OWNER + """SELECT u.*, s.owner_id, s.username, s.created, s.seq, o.username AS owner_name FROM (SELECT member_id, day, channel_id, CAST(sum(a) AS BIGINT) AS add_users, CAST(sum(c) AS BIGINT) AS income FROM (
  SELECT owner AS member_id, bind_day AS day, channel_id, 1 AS a, 0 AS c FROM am WHERE bind_day IS NOT NULL UNION ALL SELECT member_id, day, channel_id, 0, cents FROM so) GROUP BY ALL) u
 JOIN (SELECT *, row_number() OVER (PARTITION BY owner_id ORDER BY created, member_id) AS seq FROM act WHERE owner_id <> 0) s USING (member_id) JOIN l_promoters o ON o.member_id = s.owner_id""")
def sub_promoter_daily(spark, sf):
    return promoters.sub_promoter_daily(*base(spark, sf))


# --- tariffs: small tables of the rebate contract, the approved ones per member --------------------
TIERS = [(0, 0, 0, 0, 5, None), (0, 0, 0, 5_000_000, 8, None), (0, 0, 0, 20_000_000, 10, None), (0, 0, 1, 0, 4, None), (0, 0, 1, 8_000_000, 7, None),
         (1, 1, 0, 0, 12, 10), (1, 1, 0, 6_000_000, 15, 10), (1, 1, 1, 1_000_000, 13, 10)]
TARIFF_GAMES = [(1, 1, 3), (1, 1, 5), (2, 2, 3), (2, 2, 7)]
DETAIL = """det AS MATERIALIZED (SELECT strftime(o.day, '%Y%m') AS ym, o.member_id, CAST(i.child_game_id % 20 AS INT) AS game_id, CAST(o.order_no % 2 AS INT) AS recharge_type, o.channel_id, i.discount, i.cents
   FROM l_orders o JOIN l_items i USING (order_no) WHERE o.status = 4)"""


def detail(spark, sf):
    o = roles.ledger(spark, sf).filter("status = 4").select("order_no", "member_id", "channel_id", F.date_format("day", "yyyyMM").alias("ym"))
    i = roles.items(spark, sf).select("order_no", (F.col("child_game_id") % 20).cast("int").alias("game_id"), "discount", "cents")
    return o.join(i, "order_no").withColumn("recharge_type", (F.col("order_no") % 2).cast("int"))


def tariffs(spark, sf):
    columns = "kind int, group_num int, recharge_type int, min_number long, scale int, exclude_discount int"
    general = spark.createDataFrame(TIERS, columns)
    named = roles.promoters(spark, sf).filter("member_id % 10 = 2").select(
        F.lit(2).alias("kind"), F.lit(2).alias("group_num"), F.explode(F.array(F.lit(0), F.lit(1))).alias("recharge_type"), F.lit(0).cast("long").alias("min_number"), F.lit(20).alias("scale"),
        F.lit(9).alias("exclude_discount"), F.col("username").alias("tel"), F.lit(15_000_000).cast("long").alias("max_number"))
    return general.unionByName(named, allowMissingColumns=True), spark.createDataFrame(TARIFF_GAMES, "kind int, group_num int, game_id int")


def _tier_values():
    return ", ".join(f"({', '.join('NULL' if v is None else str(v) for v in t)})" for t in TIERS)


@plan("rebate_detail", f"""WITH {DETAIL}, tier AS (SELECT *, lead(min_number) OVER (PARTITION BY kind, recharge_type ORDER BY min_number) AS max_number FROM (VALUES {_tier_values()}) t(kind, group_num, recharge_type, min_number, scale, ex)),
 bs AS MATERIALIZED (SELECT d.ym, d.member_id, d.game_id, d.recharge_type, d.discount, sum(d.cents) AS cents, p.username, p.status + 1 AS user_type FROM det d JOIN l_promoters p USING (member_id) WHERE p.member_grade = 1 AND d.channel_id <> 6 GROUP BY ALL),
 ap AS MATERIALIZED (SELECT *, 20 AS scale, 3 AS rebate_type FROM (SELECT ym, member_id, game_id, recharge_type, username, user_type, sum(cents) AS cents FROM bs WHERE discount <> 9 GROUP BY ALL) WHERE game_id IN (3, 7) AND member_id % 10 = 2 AND cents < 15000000),
 sp AS (SELECT a.*, t.scale, 2 AS rebate_type FROM (SELECT ym, member_id, game_id, recharge_type, username, user_type, sum(cents) AS cents FROM bs WHERE discount <> 10 GROUP BY ALL) a
   JOIN tier t ON t.kind = 1 AND t.recharge_type = a.recharge_type AND a.cents >= t.min_number AND (t.max_number IS NULL OR a.cents < t.max_number) WHERE a.game_id IN (3, 5) AND NOT EXISTS (SELECT 1 FROM ap WHERE ap.member_id = a.member_id AND ap.game_id = a.game_id)),
 rs AS (SELECT *, sum(cents) OVER (PARTITION BY ym, member_id, recharge_type) AS mon FROM (SELECT ym, member_id, game_id, recharge_type, username, user_type, sum(cents) AS cents FROM bs GROUP BY ALL) a
   WHERE game_id NOT IN (3, 5) AND NOT EXISTS (SELECT 1 FROM ap WHERE ap.member_id = a.member_id AND ap.game_id = a.game_id)),
 fx AS (SELECT r.* EXCLUDE (mon), t.scale, 1 AS rebate_type FROM rs r JOIN tier t ON t.kind = 0 AND t.recharge_type = r.recharge_type AND r.mon >= t.min_number AND (t.max_number IS NULL OR r.mon < t.max_number))
 SELECT ym, member_id, game_id, recharge_type, username, user_type, CAST(cents AS BIGINT) AS cents, rebate_type, scale, CAST(round(cents * scale / 100) AS BIGINT) AS rebate_cents FROM (SELECT * FROM ap UNION ALL BY NAME SELECT * FROM sp UNION ALL BY NAME SELECT * FROM fx)""")
def rebate_detail(spark, sf):
    excluded = spark.createDataFrame([(6,)], "channel_id int")
    tiers, tariff_games = tariffs(spark, sf)
    return promoters.rebate_detail(promoters.rebate_base(detail(spark, sf), excluded), roles.promoters(spark, sf), tiers, tariff_games)


SUB = f"""WITH {DETAIL}, mon AS (SELECT member_id, ym, sum(cents) AS cents FROM det WHERE channel_id <> 6 GROUP BY ALL),
 cum AS (SELECT member_id, ym, sum(cents) OVER (PARTITION BY member_id ORDER BY ym) AS td FROM mon),
 cnt AS (SELECT member_id, ym, sum(cents) AS cents FROM det WHERE channel_id <> 6 {{skip}} GROUP BY ALL),
 blw AS (SELECT p.owner_id AS member_id, c.ym, count(*) AS subs, sum(c.cents) AS sc FROM cnt c JOIN l_promoters p USING (member_id) WHERE p.owner_id <> 0 GROUP BY ALL),
 own AS (SELECT m.member_id, m.ym, CAST(m.cents AS BIGINT) AS cents, CAST(u.td AS BIGINT) AS to_date_cents, coalesce(b.subs, 0) AS subs, CAST(coalesce(b.sc, 0) AS BIGINT) AS sub_cents FROM cnt c JOIN mon m USING (member_id, ym) JOIN cum u USING (member_id, ym) LEFT JOIN blw b USING (member_id, ym)),
 str AS (SELECT p.owner_id AS member_id, m.ym FROM mon m JOIN l_promoters p USING (member_id) WHERE p.owner_id <> 0 AND m.cents >= 30000000 GROUP BY ALL HAVING count(*) >= 1)
"""
RESULT = "CAST(round(sub_cents * scale / 100) AS BIGINT) AS rebate_cents"


def _sub_inputs(spark, sf, skip_special: bool):
    from playlens.operators.keyed import running_total
    # a stage table: months of members and games, small beside the order lines
    rows = detail(spark, sf).filter("channel_id <> 6").groupBy("member_id", "ym", "game_id").agg(F.sum("cents").alias("cents"))
    rows = write_stage(rows, "rebate-months")
    monthly = rows.groupBy("member_id", "ym").agg(F.sum("cents").alias("cents"))
    cumulative = running_total(rows, ["member_id"], "ym", ["cents"]).select("member_id", "ym", F.col("total_cents").alias("cents"))
    counted = rows.filter(~F.col("game_id").isin(3, 5)) if skip_special else rows
    counted = counted.groupBy("member_id", "ym").agg(F.sum("cents").alias("cents"))
    months = monthly.select("ym").distinct()
    own_rule = months.select("ym", F.lit(40_000_000).alias("month_number"), F.lit(100_000_000).alias("accumulated_number"), F.lit(2).alias("scale"))
    subs_rule = months.select("ym", F.lit(30_000_000).alias("sub_month_number"), F.lit(1).alias("sub_number"), F.lit(1).alias("scale"))
    return counted, monthly, cumulative, roles.promoters(spark, sf), own_rule, subs_rule


@plan("sub_rebate", SUB.format(skip="AND game_id NOT IN (3, 5)") + f""", r3 AS (SELECT *, 3 AS rebate_type, 2 AS scale FROM own WHERE cents >= 40000000 AND to_date_cents >= 100000000)
 SELECT *, {RESULT} FROM (SELECT * FROM r3 UNION ALL SELECT o.*, 4, 1 FROM own o JOIN str USING (member_id, ym) WHERE NOT EXISTS (SELECT 1 FROM r3 WHERE r3.member_id = o.member_id AND r3.ym = o.ym))""")
def sub_rebate(spark, sf):
    return promoters.sub_rebate(*_sub_inputs(spark, sf, True))


@plan("sub_rebate_second_type", SUB.format(skip="") + f"SELECT *, {RESULT} FROM (SELECT o.*, 3 AS rebate_type, 1 AS scale FROM own o JOIN str USING (member_id, ym))")
def sub_rebate_second_type(spark, sf):
    counted, monthly, cumulative, members, _, subs_rule = _sub_inputs(spark, sf, False)
    return promoters.sub_rebate(counted, monthly, cumulative, members, None, subs_rule)


@plan("device_ownership", """WITH u AS (SELECT imei, package, ts, day AS l, NULL AS r, NULL AS p, 0 AS c, day FROM g_logins UNION ALL SELECT imei, package, ts, NULL, day, NULL, 0, day FROM g_regs
   UNION ALL SELECT imei, package, ts, NULL, NULL, day, cents, day FROM g_paid WHERE status = 4),
 v AS (SELECT imei, package, min(ts) AS f, max(l) AS last_login, max(r) AS last_regi, max(p) AS last_recharge, CAST(sum(c) AS BIGINT) AS recharge_cents, max(day) + 15 AS valid_until FROM u WHERE imei <> '' AND package <> '' GROUP BY ALL)
 SELECT imei, package, last_login, last_regi, last_recharge, recharge_cents, valid_until FROM (SELECT *, row_number() OVER (PARTITION BY imei ORDER BY f, package) AS rn FROM v) WHERE rn = 1""")
def device_ownership(spark, sf):
    orders = valid_orders(roles.game_orders(spark, sf), refunds=False)
    return promoters.device_ownership(roles.logins(spark, sf), roles.regs(spark, sf), orders)


STATS = {"active_devices": ("g_actives", "count(DISTINCT CASE WHEN imei <> '' THEN imei END)"), "active_ips": ("g_actives", "count(DISTINCT ip)"), "regi_accounts": ("g_regs", "count(DISTINCT account)"),
         "regi_devices": ("g_regs", "count(DISTINCT CASE WHEN imei <> '' THEN imei END)"), "login_accounts": ("g_logins", "count(DISTINCT account)"), "login_devices": ("g_logins", "count(DISTINCT CASE WHEN imei <> '' THEN imei END)"),
         "pay_cents": ("pd", "sum(cents)"), "orders": ("pd", "count(*)"), "pay_devices": ("pd", "count(DISTINCT CASE WHEN imei <> '' THEN imei END)"), "new_pay_cents": ("nw", "sum(cents)"), "new_pay_accounts": ("nw", "count(DISTINCT account)")}


def _stats_sql():
    parts = " UNION ALL ".join("SELECT package, day, " + ", ".join((e if n == m else "0") + f" AS {n}" for n in STATS) + f" FROM {s} GROUP BY ALL" for m, (s, e) in STATS.items())
    return f"""WITH pd AS (SELECT * FROM g_paid WHERE status = 4), nw AS (SELECT * FROM pd WHERE EXISTS (SELECT 1 FROM g_regs r WHERE r.account = pd.account AND r.day = pd.day))
     SELECT package, day, {', '.join(f'CAST(sum({n}) AS BIGINT) AS {n}' for n in STATS)} FROM ({parts}) GROUP BY ALL"""


@plan("sub_package_stats", _stats_sql())
def sub_package_stats(spark, sf):
    orders = valid_orders(roles.game_orders(spark, sf), refunds=False)
    return promoters.sub_package_stats(roles.actives(spark, sf), roles.regs(spark, sf), roles.logins(spark, sf), orders, ["package"])


@plan("common_sdk_daily", """WITH a AS (SELECT account, min(game_id) AS game_id, min(channel_id) AS channel_id, min(reg_day) AS day FROM l_regs GROUP BY account),
 l AS (SELECT o.account, o.game_id, a.channel_id, o.day FROM l_orders o JOIN a USING (account)), p AS (SELECT o.account, o.game_id, a.channel_id, o.day, sum(cents) AS cents FROM l_orders o JOIN a USING (account) WHERE status = 4 GROUP BY ALL)
 SELECT game_id, channel_id, day, CAST(sum(na) AS BIGINT) AS new_accounts, CAST(sum(au) AS BIGINT) AS active_users, CAST(sum(np) AS BIGINT) AS new_payers, CAST(sum(nc) AS BIGINT) AS new_pay_cents, CAST(sum(py) AS BIGINT) AS payers, CAST(sum(pc) AS BIGINT) AS pay_cents FROM (
  SELECT game_id, channel_id, day, count(DISTINCT account) AS na, 0 AS au, 0 AS np, 0 AS nc, 0 AS py, 0 AS pc FROM a GROUP BY ALL UNION ALL SELECT game_id, channel_id, day, 0, count(DISTINCT account), 0, 0, 0, 0 FROM l GROUP BY ALL
  UNION ALL SELECT game_id, channel_id, day, 0, 0, count(*), sum(cents), 0, 0 FROM (SELECT *, dense_rank() OVER (PARTITION BY account ORDER BY day) AS rk FROM p) WHERE rk = 1 GROUP BY ALL
  UNION ALL SELECT game_id, channel_id, day, 0, 0, 0, 0, count(*), sum(cents) FROM p GROUP BY ALL) GROUP BY ALL""")
def common_sdk_daily(spark, sf):
    led = roles.ledger(spark, sf)
    accounts = roles.account_regs(spark, sf).groupBy("account").agg(F.min("game_id").alias("game_id"), F.min("channel_id").alias("channel_id"), F.min("reg_day").alias("reg_day"))
    sdk = led.drop("channel_id").join(accounts.select("account", "channel_id"), "account")
    return promoters.common_sdk_daily(accounts, sdk, sdk.filter("status = 4"))


@plan("common_sdk_area", "SELECT game_id, channel_id, day, 'area' || pay_type AS area, count(DISTINCT account) AS payers, CAST(sum(cents) AS BIGINT) AS pay_cents FROM l_orders WHERE status = 4 GROUP BY ALL")
def common_sdk_area(spark, sf):
    return promoters.common_sdk_area(roles.ledger(spark, sf).filter("status = 4").withColumn("area", F.concat(F.lit("area"), "pay_type")))
