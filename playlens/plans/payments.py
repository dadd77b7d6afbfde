"""Payments."""

from __future__ import annotations

from pyspark.sql import functions as F

from playlens.functions.cleanse import mark_sandbox, valid_orders
from playlens.operators import payments
from playlens.plans import plan
from playlens.plans.activity import HOUR, OWNED, PACKAGE, PK, _text_hour
from playlens.sources import roles


def paid(spark, sf, refunds=True):
    return valid_orders(roles.game_orders(spark, sf), refunds)


PAY = "CAST(sum(cents) AS BIGINT) AS pay_cents, count(DISTINCT CASE WHEN status = 4 THEN account END) AS pay_accounts, count(DISTINCT CASE WHEN status = 4 AND imei <> '' THEN imei END) AS pay_devices"


@plan("pay_kpi_hour_package", f"SELECT {PK}, {HOUR.format('ts')}, {PAY} FROM g_paid GROUP BY ALL")
def pay_kpi_hour_package(spark, sf):
    return _text_hour(payments.pay_kpi(paid(spark, sf), PACKAGE, "hour"))


@plan("pay_kpi_day_package", f"SELECT {PK}, day, {PAY} FROM g_paid GROUP BY ALL")
def pay_kpi_day_package(spark, sf):
    return payments.pay_kpi(paid(spark, sf), PACKAGE, "day")


@plan("pay_kpi_hour_game", f"SELECT game_id, {HOUR.format('ts')}, {PAY} FROM g_paid GROUP BY ALL")
def pay_kpi_hour_game(spark, sf):
    return _text_hour(payments.pay_kpi(paid(spark, sf), ["game_id"], "hour"))


@plan("pay_kpi_day_game", f"SELECT game_id, day, {PAY} FROM g_paid GROUP BY ALL")
def pay_kpi_day_game(spark, sf):
    return payments.pay_kpi(paid(spark, sf), ["game_id"], "day")


@plan("new_pay_kpi", """WITH s AS (SELECT account, day, sum(cents) AS cents FROM g_paid WHERE status = 4 GROUP BY ALL),
 b AS (SELECT DISTINCT game_id, account, imei, reg_day AS day FROM g_regs), j AS (SELECT b.*, s.cents FROM b JOIN s USING (account, day))
 SELECT game_id, day, count(*) AS new_pay_accounts, CAST(sum(c) AS BIGINT) AS new_pay_cents, any_value(d) AS new_pay_devices FROM
  (SELECT game_id, day, account, max(cents) AS c FROM j GROUP BY ALL) JOIN (SELECT game_id, day, count(DISTINCT CASE WHEN imei <> '' THEN imei END) AS d FROM j GROUP BY ALL) USING (game_id, day) GROUP BY ALL""")
def new_pay_kpi(spark, sf):
    return payments.new_pay_kpi(paid(spark, sf), roles.regs(spark, sf), ["game_id"])


TOTALS = """(SELECT r.game_id, r.medium, r.reg_day, r.account, sum(o.cents) AS c, count(DISTINCT o.day) AS n FROM (SELECT DISTINCT game_id, medium, reg_day, account FROM g_regs) r JOIN g_paid o USING (account) GROUP BY ALL)"""
AMOUNTS = [("c < 100", 0), ("c >= 100 AND c < 5000", 1), ("c >= 5000 AND c < 10000", 2), ("c >= 10000 AND c < 30000", 3), ("c >= 30000 AND c < 50000", 4),
           ("c >= 50000 AND c < 100000", 5), ("c >= 100000 AND c < 200000", 6), ("c >= 200000 AND c < 300000", 7), ("c >= 300000 AND c < 500000", 8),
           ("c >= 500000 AND c < 1000000", 9), ("c >= 1000000 AND c < 3000000", 10), ("c >= 3000000", 11)]
DAYS = [("n = 1", 0), ("n = 2", 1), ("n = 3", 2), ("n = 4", 3), ("n = 5", 4), ("n BETWEEN 6 AND 10", 5), ("n BETWEEN 11 AND 20", 6), ("n > 20", 7)]


def _hist_cols(cases, names):
    return ", ".join(f"CAST(count(CASE WHEN {c} THEN 1 END) AS BIGINT) AS {names[i]}" for c, i in cases)


@plan("pay_amount_hist", f"SELECT game_id, medium, reg_day, {_hist_cols(AMOUNTS, payments.AMOUNT_NAMES)} FROM {TOTALS} GROUP BY ALL")
def pay_amount_hist(spark, sf):
    return payments.pay_amount_hist(paid(spark, sf), roles.regs(spark, sf), ["game_id", "medium"])


@plan("pay_days_hist", f"SELECT game_id, medium, reg_day, {_hist_cols(DAYS, payments.PAY_DAYS_NAMES)} FROM {TOTALS} GROUP BY ALL")
def pay_days_hist(spark, sf):
    return payments.pay_days_hist(paid(spark, sf), roles.regs(spark, sf), ["game_id", "medium"])


@plan("new_pay_kpi_owned", f"""WITH {OWNED}, s AS (SELECT own_game AS game_id, account, day, sum(cents) AS cents FROM own WHERE status = 4 AND own_day = day GROUP BY ALL),
 j AS (SELECT s.*, b.imei FROM s JOIN (SELECT DISTINCT game_id, account, imei, reg_day AS day FROM g_regs) b USING (game_id, account, day))
 SELECT game_id, day, count(DISTINCT account) AS new_pay_accounts, CAST((SELECT sum(cents) FROM s WHERE s.game_id = j.game_id AND s.day = j.day) AS BIGINT) AS new_pay_cents,
  count(DISTINCT CASE WHEN imei <> '' THEN imei END) AS new_pay_devices FROM j GROUP BY game_id, day""")
def new_pay_kpi_owned(spark, sf):
    return payments.new_pay_kpi(paid(spark, sf), roles.regs(spark, sf), ["game_id"], owned=True)


@plan("pay_amount_hist_owned", f"""WITH {OWNED} SELECT game_id, medium, reg_day, {_hist_cols(AMOUNTS, payments.AMOUNT_NAMES)} FROM (
  SELECT own_game AS game_id, own_medium AS medium, own_day AS reg_day, account, sum(cents) AS c FROM own WHERE own_day IS NOT NULL GROUP BY ALL) GROUP BY ALL""")
def pay_amount_hist_owned(spark, sf):
    return payments.pay_amount_hist(paid(spark, sf), roles.regs(spark, sf), ["game_id", "medium"], owned=True)


@plan("member_spend", """WITH s AS (SELECT member_id, count(CASE WHEN status = 4 THEN 1 END) AS orders, CAST(sum(CASE WHEN status = 4 THEN cents ELSE 0 END) AS BIGINT) AS recharge_cents,
   CAST(sum(CASE WHEN status = 8 THEN -cents ELSE cents END) AS BIGINT) AS paid_cents, max(CASE WHEN status = 4 THEN day END) AS last_pay_day FROM l_orders WHERE status IN (4, 8) GROUP BY ALL),
 b AS (SELECT member_id, CAST(sum(CASE WHEN order_no % 4 = 3 THEN -1 ELSE 1 END) AS BIGINT) AS accounts FROM l_orders WHERE status = 0 GROUP BY ALL)
 SELECT coalesce(s.member_id, b.member_id) AS member_id, coalesce(orders, 0) AS orders, coalesce(recharge_cents, 0) AS recharge_cents, coalesce(paid_cents, 0) AS paid_cents,
  last_pay_day, coalesce(accounts, 0) AS accounts FROM s FULL JOIN b ON s.member_id = b.member_id""")
def member_spend(spark, sf):
    led = roles.ledger(spark, sf)
    bindings = led.filter("status = 0").select("member_id", F.when(F.col("order_no") % 4 == 3, -1).otherwise(1).cast("long").alias("change"))
    return payments.member_spend(led, bindings)


MODES = """(SELECT p_partkey AS game_id, p_partkey % 3 + 1 AS mode, DATE '2024-01-06' AS modifytime_2, p_partkey % 3 + 4 AS mode_2,
  CASE WHEN p_partkey % 2 = 0 THEN DATE '2024-01-12' END AS modifytime_3, p_partkey % 3 + 7 AS mode_3,
  CASE WHEN p_partkey % 4 = 0 THEN DATE '2024-01-20' END AS modifytime_4, p_partkey % 3 + 10 AS mode_4 FROM part WHERE p_size > 10)"""


def modes(spark, sf):
    k = F.col("p_partkey")
    d = lambda x: F.lit(x).cast("date")
    return roles.table(spark, sf, "part").filter("p_size > 10").select(
        k.alias("game_id"), (k % 3 + 1).alias("mode"), d("2024-01-06").alias("modifytime_2"), (k % 3 + 4).alias("mode_2"),
        F.when(k % 2 == 0, d("2024-01-12")).alias("modifytime_3"), (k % 3 + 7).alias("mode_3"),
        F.when(k % 4 == 0, d("2024-01-20")).alias("modifytime_4"), (k % 3 + 10).alias("mode_4"))


MODE_CHANGES = [("modifytime_2", "mode_2"), ("modifytime_3", "mode_3"), ("modifytime_4", "mode_4")]


@plan("mode_revenue", f"""SELECT o.day, r.game_id, r.publish_mode, CAST(sum(o.cents) AS BIGINT) AS pay_cents, CAST(sum(CASE WHEN o.box THEN o.cents ELSE 0 END) AS BIGINT) AS box_cents FROM (
  SELECT b.*, coalesce(CASE WHEN m.modifytime_4 IS NOT NULL AND reg_day >= m.modifytime_4 THEN m.mode_4 WHEN m.modifytime_3 IS NOT NULL AND reg_day >= m.modifytime_3 THEN m.mode_3
   WHEN reg_day >= m.modifytime_2 THEN m.mode_2 ELSE m.mode END, 0) AS publish_mode FROM (SELECT DISTINCT game_id, account, reg_day FROM g_regs) b LEFT JOIN {MODES} m USING (game_id)) r
 JOIN (SELECT *, order_no IN (SELECT order_no FROM g_receipts WHERE state = 3) AS box FROM g_paid WHERE status = 4) o USING (account) GROUP BY ALL""")
def mode_revenue(spark, sf):
    orders = mark_sandbox(paid(spark, sf, refunds=False), roles.receipts(spark, sf))
    return payments.mode_revenue(orders, roles.regs(spark, sf), modes(spark, sf), MODE_CHANGES)


@plan("sdk_bills", """SELECT o.day, o.game_id, coalesce(h.channel_id, 0) AS channel_id, coalesce(h.os, 0) AS os, coalesce(g.company, '') AS company, CAST(sum(o.cents) AS BIGINT) AS cents
 FROM (SELECT * FROM l_orders WHERE status = 4) o LEFT JOIN (SELECT account, min(channel_id) AS channel_id, min(os) AS os FROM l_regs GROUP BY account) h USING (account)
 LEFT JOIN (SELECT CAST(p_partkey AS INT) AS game_id, p_brand AS company FROM part) g ON g.game_id = o.game_id GROUP BY ALL""")
def sdk_bills(spark, sf):
    homes = roles.account_regs(spark, sf).groupBy("account").agg(F.min("channel_id").alias("channel_id"), F.min("os").alias("os"))
    games = roles.table(spark, sf, "part").select(F.col("p_partkey").cast("int").alias("game_id"), F.col("p_brand").alias("company"))
    return payments.sdk_bills(roles.ledger(spark, sf).filter("status = 4"), homes, games)


EARNED = """(SELECT member_id, day, CAST(pay_type AS BIGINT) AS points FROM l_orders WHERE status = 0
  UNION ALL SELECT member_id, day, CASE WHEN cents * 3 > 0 AND cents * 3 <= 10000 THEN 1 ELSE cents * 3 // 10000 END FROM l_orders WHERE status = 4)"""


def _earned(spark, sf):
    led = roles.ledger(spark, sf)
    return payments.points(led.filter("status = 0").withColumn("points", F.col("pay_type")), led, 3)


@plan("app_points_quota", f"""SELECT member_id, CAST(sum(p) AS BIGINT) AS points, CAST(sum(d) AS BIGINT) AS downloads, CAST(sum(s) AS BIGINT) AS spend_cents FROM (
  SELECT member_id, points AS p, 0 AS d, 0 AS s FROM {EARNED} UNION ALL SELECT member_id, 0, 1, 0 FROM l_orders WHERE status = 8
  UNION ALL SELECT member_id, 0, 0, cents FROM l_orders WHERE status = 4) GROUP BY ALL""")
def app_points_quota(spark, sf):
    led = roles.ledger(spark, sf)
    return payments.points_quota(_earned(spark, sf), led.filter("status = 8"), led)


@plan("app_points_issued", f"SELECT day, CAST(sum(points) AS BIGINT) AS points, CAST(sum(sum(points)) OVER (ORDER BY day) AS BIGINT) AS points_to_date FROM {EARNED} GROUP BY day")
def app_points_issued(spark, sf):
    return payments.points_issued(_earned(spark, sf))
