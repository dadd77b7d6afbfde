"""Finance, reconciliation, recommendation."""

from __future__ import annotations

from pyspark.sql import functions as F

from playlens.operators import finance
from playlens.plans import plan
from playlens.sources import roles

FIN = """WITH fo AS (SELECT order_no, member_id, day, day + CAST(order_no % 40 AS INT) AS refund_day, cents AS list_cents, CAST(order_no % 3 + 1 AS INT) AS quantity, cents * (80 + order_no % 21) // 100 AS pay_cents,
   order_no % 1000 AS credit_cents, order_no % 500 AS coin_cents, status, prod_type, pay_type, game_id, channel_id, CAST(round(100 * (cents * (80 + order_no % 21) // 100 + order_no % 1000 + (order_no % 500) / 10) / ((order_no % 3 + 1) * cents)) AS BIGINT) AS percent FROM l_orders),
 ft AS (SELECT order_no * 10 + line_no AS coupon_id, (order_no * 10 + line_no) * 2 AS tran_id, CASE WHEN line_no % 3 = 0 THEN -order_no ELSE order_no END AS order_id, cents // 10 AS amount_org, cents // 10 AS amount, 0 AS kind, day, day + 30 AS refund_day, NULL AS request_no FROM l_items WHERE discount > 0
   UNION ALL SELECT order_no * 10 + line_no, (order_no * 10 + line_no) * 2 + 1, CASE WHEN tax = 0 THEN 0 ELSE order_no END, cents // 10, cents // 20, 1, day + quantity, NULL, order_no FROM l_items WHERE discount > 0 AND quantity % 2 = 0)
"""


def fin_orders(spark, sf):
    n = F.col("order_no")
    return roles.ledger(spark, sf).select(
        "order_no", "member_id", "day", F.date_add("day", (n % 40).cast("int")).alias("refund_day"), F.col("cents").alias("list_cents"), (n % 3 + 1).cast("int").alias("quantity"),
        F.expr("cents * (80 + order_no % 21) div 100").alias("pay_cents"), (n % 1000).alias("credit_cents"), (n % 500).alias("coin_cents"), "status", "prod_type", "pay_type", "game_id", "channel_id")


def fin_trans(spark, sf):
    i = roles.items(spark, sf).filter("discount > 0")
    cid, n = F.col("order_no") * 10 + F.col("line_no"), F.col("order_no")
    issue = i.select(cid.alias("coupon_id"), (cid * 2).alias("tran_id"), F.when(F.col("line_no") % 3 == 0, -n).otherwise(n).alias("order_id"), F.expr("cents div 10").alias("amount_org"), F.expr("cents div 10").alias("amount"),
                     F.lit(0).alias("kind"), "day", F.date_add("day", 30).alias("refund_day"), F.lit(None).cast("long").alias("request_no"))
    use = i.filter("quantity % 2 = 0").select(cid.alias("coupon_id"), (cid * 2 + 1).alias("tran_id"), F.when(F.col("tax") == 0, 0).otherwise(n).alias("order_id"), F.expr("cents div 10").alias("amount_org"), F.expr("cents div 20").alias("amount"),
                     F.lit(1).alias("kind"), F.date_add("day", F.col("quantity")).alias("day"), F.lit(None).cast("date").alias("refund_day"), n.alias("request_no"))
    return issue.unionByName(use)


def fin_receipts(spark, sf):
    return roles.ledger(spark, sf).filter("pay_type = 5").select("order_no", F.lit(1).alias("sandbox"), F.when(F.col("order_no") % 2 == 0, 3).otherwise(1).alias("state"))


BOX = "(SELECT order_no FROM l_orders WHERE pay_type = 5 AND order_no % 2 = 0)"


@plan("coupon_ledger", FIN + """SELECT day, CAST(sum(a) AS BIGINT) AS recharge_coupon, CAST(sum(b) AS BIGINT) AS plan_coupon, CAST(sum(c) AS BIGINT) AS recharge_cash, CAST(sum(d) AS BIGINT) AS refund_coupon, CAST(sum(e) AS BIGINT) AS refund_cash FROM (
  SELECT day, sum(CASE WHEN order_id > 0 THEN amount_org ELSE 0 END) AS a, sum(CASE WHEN order_id < 0 THEN amount_org ELSE 0 END) AS b, 0 AS c, 0 AS d, 0 AS e FROM ft WHERE kind = 0 GROUP BY day
  UNION ALL SELECT t.day, 0, 0, round(sum(t.amount_org * o.percent) / 100), 0, 0 FROM ft t JOIN fo o ON o.order_no = t.order_id AND o.status IN (4, 8) WHERE t.kind = 0 AND t.order_id > 0 GROUP BY t.day
  UNION ALL SELECT t.refund_day, 0, 0, 0, sum(t.amount_org), round(sum(t.amount_org * o.percent) / 100) FROM ft t JOIN fo o ON o.order_no = t.order_id AND o.status = 8 WHERE t.kind = 0 GROUP BY t.refund_day) GROUP BY day""")
def coupon_ledger(spark, sf):
    return finance.coupon_ledger(fin_trans(spark, sf), fin_orders(spark, sf), [4])


@plan("coupon_remaining", FIN + """SELECT l.day, CAST(sum(l.amount) AS BIGINT) AS remaining, CAST(round(sum(l.amount * o.percent) / 100) AS BIGINT) AS remaining_cash
  FROM (SELECT coupon_id, arg_max(amount, (day, tran_id, amount)) AS amount, max(day) AS day FROM ft WHERE day < DATE '1999-06-01' GROUP BY ALL) l JOIN ft i ON i.coupon_id = l.coupon_id AND i.kind = 0 AND i.order_id > 0 JOIN fo o ON o.order_no = i.order_id AND o.status = 4 GROUP BY l.day""")
def coupon_remaining(spark, sf):
    return finance.coupon_remaining(fin_trans(spark, sf), fin_orders(spark, sf), [4], "1999-06-01")


@plan("recharge_refund_totals", FIN + f"""SELECT *, list - refund_list AS net_list, paid - refund_paid AS net_paid FROM (SELECT day, CAST(sum(a) AS BIGINT) AS list, CAST(sum(b) AS BIGINT) AS paid, CAST(sum(c) AS BIGINT) AS orders, CAST(sum(d) AS BIGINT) AS refund_list, CAST(sum(e) AS BIGINT) AS refund_paid, CAST(sum(f) AS BIGINT) AS refund_orders FROM (
  SELECT day, list_cents * quantity AS a, pay_cents AS b, 1 AS c, 0 AS d, 0 AS e, 0 AS f FROM fo WHERE status IN (4, 8) AND order_no NOT IN {BOX} UNION ALL SELECT refund_day, 0, 0, 0, list_cents * quantity, pay_cents, 1 FROM fo WHERE status = 8) GROUP BY day)""")
def recharge_refund_totals(spark, sf):
    return finance.recharge_refund_totals(fin_orders(spark, sf), fin_receipts(spark, sf))


NAMES = "(SELECT CAST(p_partkey AS INT) AS game_id, p_name AS game_name FROM part)"


def names(spark, sf):
    games = roles.table(spark, sf, "part").select(F.col("p_partkey").cast("int").alias("game_id"), F.col("p_name").alias("game_name"))
    channels = roles.table(spark, sf, "nation").select(F.col("n_nationkey").alias("channel_id"), F.col("n_name").alias("channel_name"))
    groups = roles.table(spark, sf, "part").filter("p_size > 20").select(F.col("p_partkey").cast("int").alias("game_id"), (F.col("p_size") % 7).alias("channel_id"), F.col("p_type").alias("group_name"))
    return games, channels, groups


@plan("export_orders", FIN + f"""SELECT x.order_no, x.game_id, x.channel_id, CASE WHEN prod_type IN (1, 2, 5) THEN '首充' WHEN prod_type = 4 THEN '续充' ELSE '直充' END AS charge, x.pay_type, x.state, x.day, x.state_day, x.list_cents * x.quantity AS list_total, x.pay_cents,
  n.game_name, c.n_name AS channel_name, coalesce(g.p_type, '运营组') AS group_name FROM (SELECT *, '订单完成' AS state, day AS state_day FROM fo WHERE status IN (4, 8) AND order_no NOT IN {BOX} UNION ALL SELECT *, '退款完成', refund_day FROM fo WHERE status = 8) x
  JOIN {NAMES} n ON n.game_id = x.game_id JOIN nation c ON c.n_nationkey = x.channel_id LEFT JOIN part g ON g.p_partkey = x.game_id AND g.p_size % 7 = x.channel_id AND g.p_size > 20""")
def export_orders(spark, sf):
    return finance.export_orders(fin_orders(spark, sf), fin_receipts(spark, sf), *names(spark, sf))


@plan("export_coupons_added", FIN + f"""SELECT t.coupon_id, t.order_id, n.game_name, t.day, t.amount_org, CAST(round(t.amount_org * o.percent / 100) AS BIGINT) AS cash_value FROM ft t JOIN fo o ON o.order_no = t.order_id AND o.status IN (4, 8) JOIN {NAMES} n ON n.game_id = o.game_id WHERE t.kind = 0 AND t.order_id > 0""")
def export_coupons_added(spark, sf):
    return finance.export_coupons_added(fin_trans(spark, sf), fin_orders(spark, sf), names(spark, sf)[0])


@plan("export_coupons_used", FIN + """SELECT u.coupon_id, i.order_id AS issue_order, u.request_no, CASE u.request_no % 5 WHEN 0 THEN '未发送' WHEN 1 THEN 'CP付款成功' WHEN 2 THEN 'CP付款失败' WHEN 3 THEN '重试中' ELSE '重试失败' END AS state,
  CASE WHEN u.order_id = 0 THEN '纯代金券' ELSE '混合支付' END AS pay_kind, u.day, u.amount_org - u.amount AS used, CAST(round((u.amount_org - u.amount) * o.percent / 100) AS BIGINT) AS cash_value
  FROM ft u JOIN ft i ON i.coupon_id = u.coupon_id AND i.kind = 0 JOIN fo o ON o.order_no = i.order_id WHERE u.kind = 1""")
def export_coupons_used(spark, sf):
    requests = roles.ledger(spark, sf).select(F.col("order_no").alias("request_no"), (F.col("order_no") % 5).cast("int").alias("send_state"))
    return finance.export_coupons_used(fin_trans(spark, sf), fin_orders(spark, sf), requests)


@plan("source_reconcile", """SELECT b.month, b.n AS ledger_orders, coalesce(a.n, 0) AS log_orders, round(coalesce(a.n, 0) / b.n, 6) AS ratio, b.n > 5 AND round(coalesce(a.n, 0) / b.n, 6) < 0.8 AS alert
  FROM (SELECT CAST(date_trunc('month', day) AS DATE) AS month, count(DISTINCT order_no) AS n FROM l_orders GROUP BY ALL) b
  LEFT JOIN (SELECT CAST(date_trunc('month', day) AS DATE) AS month, count(DISTINCT order_no) AS n FROM l_items WHERE flag = 'N' GROUP BY ALL) a USING (month)""")
def source_reconcile(spark, sf):
    month = F.trunc("day", "month").alias("month")
    log = roles.items(spark, sf).filter("flag = 'N'").select("order_no", month)
    return finance.source_reconcile(log, roles.ledger(spark, sf).select("order_no", month), "month")


CO = """(SELECT a.k AS item, b.k AS other, count(*) AS n FROM (SELECT DISTINCT user_id, k FROM ev WHERE event_type = 'click') a JOIN (SELECT DISTINCT user_id, k FROM ev WHERE event_type = 'click') b ON a.user_id = b.user_id AND a.k <> b.k GROUP BY ALL)"""


def downloads(spark, sf):
    return roles.clicks(spark, sf).select("user_id", "k")


@plan("co_usage_counts", f"SELECT * FROM {CO}")
def co_usage_counts(spark, sf):
    from playlens.operators.joins import co_usage
    return co_usage(downloads(spark, sf), "user_id", "k")


@plan("co_download_recommend", f"""SELECT item AS k, string_agg(o, '|' ORDER BY o) AS recommended FROM (SELECT item, CAST(other AS VARCHAR) AS o, row_number() OVER (PARTITION BY item ORDER BY n DESC, other) AS rn FROM {CO}) WHERE rn <= 80 GROUP BY item""")
def co_download_recommend(spark, sf):
    return finance.co_download_recommend(downloads(spark, sf), "user_id", "k")


@plan("recent_games", "SELECT member_id, game_id, max(day) AS last_day, arg_max(channel_id, (day, channel_id)) AS channel_id FROM (SELECT member_id, channel_id, day, CAST(order_no % 9 AS INT) AS game_id FROM l_orders) GROUP BY ALL")
def recent_games(spark, sf):
    return finance.recent_games(roles.ledger(spark, sf).withColumn("game_id", (F.col("order_no") % 9).cast("int")))


@plan("installed_apps", """SELECT user_id AS device_id, 'app' || (k % 12) AS pkg_name, status, report_id FROM (SELECT user_id, k, CAST(event_id % 3 AS INT) AS status, event_id AS report_id,
  row_number() OVER (PARTITION BY user_id, k % 12 ORDER BY ts DESC, event_id DESC) AS rn FROM ev) WHERE rn = 1""")
def installed_apps(spark, sf):
    e = roles.events(spark, sf).select(F.col("user_id").alias("device_id"), F.concat(F.lit("app"), F.col("k") % 12).alias("pkg_name"), (F.col("event_id") % 3).cast("int").alias("status"), F.col("ts").alias("opera_ts"), F.col("event_id").alias("report_id"))
    return finance.installed_apps(e).drop("opera_ts")


@plan("role_latest", "SELECT user_id * 10 + k % 3 AS role_id, k AS level, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id * 10 + k % 3 ORDER BY ts DESC, event_id DESC) AS rn FROM ev) WHERE rn = 1")
def role_latest(spark, sf):
    e = roles.events(spark, sf).select((F.col("user_id") * 10 + F.col("k") % 3).alias("role_id"), F.col("k").alias("level"), F.col("ts").alias("update_ts"), "event_id")
    return finance.role_latest(e).drop("update_ts")
