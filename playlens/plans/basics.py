"""Building blocks on their own: expressions, joins, aggregates, windows, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from playlens.functions import cleanse as c
from playlens.operators import aggregates, joins, keyed
from playlens.plans import plan
from playlens.sources import roles, tables


# --- expressions ---------------------------------------------------------------------------------
@plan("norm_account", "SELECT c_custkey, lower(trim(' ' || upper(c_name) || ' ')) AS account FROM customer")
def norm_account(spark, sf):
    raw = F.concat(F.lit(" "), F.upper("c_name"), F.lit(" "))
    return roles.table(spark, sf, "customer").select("c_custkey", c.norm_account(raw).alias("account"))


@plan("split_channel", "SELECT event_id, medium, site, package FROM ev")
def split_channel(spark, sf):
    return roles.events(spark, sf).select("event_id", "medium", "site", "package")


@plan("split_device", "SELECT event_id, imei, android_id FROM ev")
def split_device(spark, sf):
    return roles.events(spark, sf).select("event_id", "imei", "android_id")


@plan("valid_device", "SELECT p_partkey, p_size > 5 AS valid FROM part")
def valid_device(spark, sf):
    size = F.col("p_size")
    raw = F.when(size == 1, None).when(size == 2, "").when(size == 3, "0" * 32).when(size == 4, "00000000-0000-0000-0000-000000000000").when(
        size == 5, "5284047f4ffb4e04824a2fd1d1f0cd62").otherwise(F.md5("p_name"))
    return roles.table(spark, sf, "part").select("p_partkey", c.valid_device(raw).alias("valid"))


@plan("device_hash", """SELECT p_partkey, CASE WHEN os = 1 AND net IN (17, 18) THEN upper(md5(md5(p_name))) WHEN os = 1 OR net IN (5, 6, 7, 8) THEN upper(md5(p_name))
  ELSE upper(md5(substr(u, 1, 8) || '-' || substr(u, 9, 4) || '-' || substr(u, 13, 4) || '-' || substr(u, 17, 4) || '-' || substr(u, 21, 12))) END AS hash
  FROM (SELECT p_partkey, p_name, upper(md5(p_name)) AS u, p_size % 19 AS net, p_partkey % 2 + 1 AS os FROM part)""")
def device_hash(spark, sf):
    p = roles.table(spark, sf, "part")
    return p.select("p_partkey", c.device_hash(F.md5("p_name"), F.col("p_size") % 19, (F.col("p_partkey") % 2 + 1)).alias("hash"))


@plan("published_only", "SELECT event_id, game_id FROM ev WHERE game_id IN (SELECT game_id FROM g_published)")
def published_only(spark, sf):
    return c.published_only(roles.events(spark, sf).select("event_id", "game_id"), roles.published(spark, sf)).select("event_id", "game_id")


@plan("valid_orders", "SELECT order_no, account, status, cents FROM g_paid")
def valid_orders(spark, sf):
    return c.valid_orders(roles.game_orders(spark, sf)).select("order_no", "account", "status", "cents")


@plan("drop_sandbox", "SELECT order_no, cents FROM g_orders WHERE order_no NOT IN (SELECT order_no FROM g_receipts WHERE sandbox = 1 AND state = 3)")
def drop_sandbox(spark, sf):
    return c.drop_sandbox(roles.game_orders(spark, sf), roles.receipts(spark, sf)).select("order_no", "cents")


@plan("mark_sandbox", "SELECT order_no, order_no IN (SELECT order_no FROM g_receipts WHERE sandbox = 1 AND state = 3) AS is_sandbox FROM g_orders")
def mark_sandbox(spark, sf):
    return c.mark_sandbox(roles.game_orders(spark, sf), roles.receipts(spark, sf)).select("order_no", "is_sandbox")


@plan("os_normalise", "SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'android' WHEN 1 THEN 'ios' ELSE 'wp' END AS os, CASE p_size % 4 WHEN 0 THEN 'android' WHEN 1 THEN 'ios' ELSE 'UNKNOW' END AS report_os FROM part")
def os_normalise(spark, sf):
    os = c.os_normalise(F.col("p_size") % 4)
    return roles.table(spark, sf, "part").select("p_partkey", os.alias("os"), c.platform_default(os).alias("report_os"))


@plan("epoch_any", "SELECT event_id, CAST(date_trunc('second', ts) AS DATE) AS day, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS seconds FROM events")
def epoch_any(spark, sf):
    e = roles.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    raw = F.when(F.col("event_id") % 2 == 0, F.unix_timestamp("ts").cast("string")).otherwise(F.unix_millis("ts").cast("string"))
    t = c.epoch_any(raw)
    return e.select("event_id", F.to_date(t).alias("day"), F.unix_timestamp(t).alias("seconds"))


@plan("guards", "SELECT c_custkey, TRUE AS key_is_number, FALSE AS name_is_number, c_custkey % 2 = 0 AS is_time FROM customer")
def guards(spark, sf):
    t = F.when(F.col("c_custkey") % 2 == 0, "2024-01-31 10:00:00").otherwise("2024-13-31 10:00:00")
    return roles.table(spark, sf, "customer").select("c_custkey", c.is_number("c_custkey").alias("key_is_number"), c.is_number("c_name").alias("name_is_number"), c.is_time(t).alias("is_time"))


@plan("quarantine", "SELECT event_id, length(package) <= 2 AS is_valid FROM ev")
def quarantine(spark, sf):
    good, bad = c.quarantine(roles.events(spark, sf).select("event_id", "package"), F.length("package") <= 2)
    return good.select("event_id", F.lit(True).alias("is_valid")).unionByName(bad.select("event_id", F.lit(False).alias("is_valid")))


@plan("package_id_parts", """SELECT p_partkey, p_size % 3 <> 2 AS is_valid, CASE WHEN p_size % 3 <> 2 THEN CAST(1000 + p_partkey % 50000 AS INT) ELSE 0 END AS game_id,
  CASE p_size % 3 WHEN 0 THEN 'medium' WHEN 1 THEN 'channel' ELSE '' END AS kind FROM part""")
def package_id_parts(spark, sf):
    game = (F.col("p_partkey") % 50000 + 1000).cast("string")
    raw = F.when(F.col("p_size") % 3 == 0, F.concat(game, F.lit("M19006"))).when(F.col("p_size") % 3 == 1, F.concat(game, F.lit("Q12003a"))).otherwise(F.concat(game, F.lit("X1")))
    return roles.table(spark, sf, "part").select("p_partkey", c.package_id_parts(raw).alias("p")).select("p_partkey", "p.*").fillna({"game_id": 0, "kind": ""})


@plan("time_bucket", "SELECT event_id, strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS hour, CAST(ts AS DATE) AS day, strftime(ts, '%Y-%m') AS month FROM events")
def time_bucket(spark, sf):
    return roles.events(spark, sf).select(
        "event_id", F.date_format(c.time_bucket("ts", "hour"), "yyyy-MM-dd HH").alias("hour"), c.time_bucket("ts", "day").alias("day"), F.date_format(c.time_bucket("ts", "month"), "yyyy-MM").alias("month"))


PAY_NAMES = {"1": "card", "2": "wallet", "3": "coin", "5": "store"}


@plan("decode_pay_type", """SELECT o_orderkey, CASE a WHEN '1' THEN 'card' WHEN '2' THEN 'wallet' WHEN '3' THEN 'coin' WHEN '5' THEN 'store' ELSE 'unknown' END || '|' ||
  CASE b WHEN '1' THEN 'card' WHEN '2' THEN 'wallet' WHEN '3' THEN 'coin' WHEN '5' THEN 'store' ELSE 'unknown' END AS names FROM (SELECT o_orderkey, substr(o_orderpriority, 1, 1) AS a, CAST(o_custkey % 6 AS VARCHAR) AS b FROM orders)""")
def decode_pay_type(spark, sf):
    code = F.concat(F.substring("o_orderpriority", 1, 1), (F.col("o_custkey") % 6).cast("string"))
    return roles.table(spark, sf, "orders").select("o_orderkey", c.decode_pay_type(code, PAY_NAMES).alias("names"))


@plan("split_promo", "SELECT c_custkey, c_mktsegment AS promo_code, CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE '' END AS user_code FROM customer")
def split_promo(spark, sf):
    raw = F.when(F.col("c_custkey") % 2 == 0, F.concat("c_mktsegment", F.lit("~"), "c_name")).otherwise(F.col("c_mktsegment"))
    return roles.table(spark, sf, "customer").select("c_custkey", c.split_promo(raw).alias("p")).select("c_custkey", "p.*")


# --- scans -----------------------------------------------------------------------------------------
@plan("facts_between", "SELECT event_id, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-09'")
def facts_between(spark, sf):
    return tables.facts_between(roles.table(spark, sf, "events"), "ts", "2024-01-05", "2024-01-08").select("event_id", "user_id")


@plan("dim_snapshot", "SELECT package, head_people, mstart_date, mend_date, promotion_channel FROM g_packages")
def dim_snapshot(spark, sf):
    """Written as a snapshot, then read back."""
    from playlens.session import work_folder
    from playlens.sinks.tables import write_snapshot
    path = work_folder(spark, "dim")
    write_snapshot(roles.packages(spark, sf), path)
    return tables.read_snapshot(spark, path)


# --- joins -----------------------------------------------------------------------------------------
@plan("join_parent_game", "SELECT e.event_id, g.parent_game_id, g.system_type, g.group_id FROM ev e JOIN g_games g ON g.child_game_id = e.game_id AND g.state = 0")
def join_parent_game(spark, sf):
    g = roles.games(spark, sf).filter("state = 0").withColumnRenamed("child_game_id", "game_id").drop("state")
    return roles.events(spark, sf).select("event_id", "game_id").join(g, "game_id").drop("game_id")


@plan("left_fill", "SELECT c.c_custkey, coalesce(o.n, 0) AS n, coalesce(o.cents, 0) AS cents FROM customer c LEFT JOIN (SELECT member_id, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents FROM l_orders WHERE status = 8 GROUP BY ALL) o ON o.member_id = c.c_custkey")
def left_fill(spark, sf):
    o = roles.ledger(spark, sf).filter("status = 8").groupBy(F.col("member_id").alias("c_custkey")).agg(F.count("*").alias("n"), F.sum("cents").alias("cents"))
    return joins.left_fill(roles.table(spark, sf, "customer").select("c_custkey"), o, ["c_custkey"], {"n": 0, "cents": 0})


@plan("anti_join", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def anti_join(spark, sf):
    o = roles.table(spark, sf, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return roles.table(spark, sf, "customer").select("c_custkey").join(o, "c_custkey", "left_anti")


@plan("semi_join", "SELECT event_id FROM g_logins l WHERE EXISTS (SELECT 1 FROM g_regs r WHERE r.game_id = l.game_id AND r.account = l.account AND r.day = l.day)")
def semi_join(spark, sf):
    keys = ["game_id", "account", "day"]
    return roles.logins(spark, sf).join(roles.regs(spark, sf).withColumn("day", F.col("reg_day")).select(*keys), keys, "left_semi").select("event_id")


@plan("calendar_spine", "SELECT s_suppkey, CAST(d AS DATE) AS day FROM supplier, generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY) t(d)")
def calendar_spine(spark, sf):
    return joins.calendar(roles.table(spark, sf, "supplier").select("s_suppkey"), roles.TEST_START, roles.TEST_END)


@plan("valid_on", "SELECT e.event_id, p.promotion_channel, p.head_people FROM ev e LEFT JOIN g_packages p ON p.package = e.package AND e.day BETWEEN p.mstart_date AND p.mend_date")
def valid_on(spark, sf):
    e = roles.events(spark, sf).select("event_id", "package", "day")
    return joins.valid_on(e, roles.packages(spark, sf), ["package"], "day", [("mstart_date", "mend_date")]).drop("package", "day")


@plan("band_join", "SELECT b.game_id, CAST(c.d AS DATE) AS on_day, CAST(sum(b.cents) AS BIGINT) AS cents FROM (SELECT game_id, day, sum(cents) AS cents FROM g_paid GROUP BY ALL) b JOIN generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY) c(d) ON c.d >= b.day AND c.d <= b.day + 15 GROUP BY ALL")
def band_join(spark, sf):
    daily = c.valid_orders(roles.game_orders(spark, sf)).groupBy("game_id", "day").agg(F.sum("cents").alias("cents"))
    return joins.band_expand(daily, "day", 15, "on_day", roles.TEST_END).groupBy("game_id", "on_day").agg(F.sum("cents").alias("cents"))


LADDER = [(0, 0, 10), (0, 10_000_000, 12), (0, 30_000_000, 15), (1, 5_000_000, 20), (1, 25_000_000, 25), (2, 0, 7)]
LADDER_VALUES = ", ".join(str(x) for x in LADDER)


def _ladder(spark):
    return spark.createDataFrame(LADDER, "grp int, threshold long, rate int")


def _graded(spark, sf):
    return roles.ledger(spark, sf).select("order_no", "cents", (F.col("member_id") % 3).cast("int").alias("grp"))


@plan("tier_lookup", f"""SELECT o.order_no, r.rate FROM l_orders o JOIN (SELECT *, lead(threshold) OVER (PARTITION BY grp ORDER BY threshold) AS high FROM (VALUES {LADDER_VALUES}) t(grp, threshold, rate)) r
  ON r.grp = o.member_id % 3 AND o.cents >= r.threshold AND (r.high IS NULL OR o.cents < r.high)""")
def tier_lookup(spark, sf):
    ranges = joins.ladder_ranges(_ladder(spark), ["grp"], "threshold").drop("threshold")
    return joins.range_lookup(_graded(spark, sf), ranges, ["grp"], "cents", "low", "high").select("order_no", "rate")


@plan("ladder_lookup", f"SELECT o.order_no, coalesce((SELECT arg_max(rate, threshold) FROM (VALUES {LADDER_VALUES}) t(grp, threshold, rate) WHERE t.grp = o.member_id % 3 AND t.threshold <= o.cents), 0) AS rate FROM l_orders o")
def ladder_lookup(spark, sf):
    return joins.ladder_rate(_graded(spark, sf), _ladder(spark), ["grp"], "cents", "threshold").select("order_no", "rate").fillna(0)


@plan("contract_in_force", """SELECT i.order_no, i.line_no, CASE WHEN i.day < DATE '2000-01-01' THEN 10 ELSE 20 END AS rate FROM l_items i WHERE i.day >= DATE '1996-01-01' AND i.day < DATE '2001-07-01'""")
def contract_in_force(spark, sf):
    """Contracts hold from their first month to before their last."""
    d = lambda x: F.lit(x).cast("date")
    span = lambda a, b, r: F.struct(d(a).alias("start_month"), d(b).alias("end_month"), F.lit(r).alias("rate"))
    contracts = roles.table(spark, sf, "part").select(F.col("p_partkey").alias("child_game_id"), F.inline(F.array(span("1996-01-01", "2000-01-01", 10), span("2000-01-01", "2001-07-01", 20))))
    items = roles.items(spark, sf).select("order_no", "line_no", "child_game_id", F.trunc("day", "month").alias("month"))
    return joins.range_lookup(items, contracts, ["child_game_id"], "month", "start_month", "end_month").select("order_no", "line_no", "rate")


@plan("epoch_pick", """SELECT game_id, from_day, lead(from_day, 1, DATE '9999-12-31') OVER (PARTITION BY game_id ORDER BY from_day) AS to_day, publish_mode FROM (
  SELECT p_partkey AS game_id, DATE '0001-01-01' AS from_day, p_partkey % 3 + 1 AS publish_mode FROM part WHERE p_size > 10 UNION ALL SELECT p_partkey, DATE '2024-01-06', p_partkey % 3 + 4 FROM part WHERE p_size > 10
  UNION ALL SELECT p_partkey, DATE '2024-01-12', p_partkey % 3 + 7 FROM part WHERE p_size > 10 AND p_partkey % 2 = 0 UNION ALL SELECT p_partkey, DATE '2024-01-20', p_partkey % 3 + 10 FROM part WHERE p_size > 10 AND p_partkey % 4 = 0)""")
def epoch_pick(spark, sf):
    from playlens.plans.payments import MODE_CHANGES, modes
    return joins.epoch_ranges(modes(spark, sf), ["game_id"], "mode", MODE_CHANGES, "publish_mode")


@plan("hierarchy", "SELECT m.member_id, m.owner_id, CASE WHEN m.owner_id = 0 THEN m.username ELSE o.username END AS owner_name FROM l_promoters m LEFT JOIN l_promoters o ON o.member_id = m.owner_id")
def hierarchy(spark, sf):
    return joins.hierarchy(roles.promoters(spark, sf)).select("member_id", "owner_id", "owner_name")


@plan("asof_latest", """SELECT l.event_id, arg_max(r.event_id, (r.ts, r.event_id)) AS reg_id FROM g_logins l JOIN g_regs r ON r.account = l.account AND r.ts <= l.ts GROUP BY l.event_id""")
def asof_latest(spark, sf):
    regs = roles.regs(spark, sf).select("account", F.col("event_id").alias("reg_id"), "reg_ts")
    logins = roles.logins(spark, sf).select("account", "event_id", "login_ts")
    return keyed.asof_latest(logins, regs, ["account"], "login_ts", "reg_ts", ["reg_id"], ["reg_id"]).select("event_id", "reg_id")


# --- aggregates --------------------------------------------------------------------------------------
@plan("count_distinct", "SELECT game_id, count(DISTINCT account) AS n FROM ev GROUP BY game_id")
def count_distinct(spark, sf):
    return aggregates.count_distinct(roles.events(spark, sf), ["game_id"], ["account"], "n")


@plan("count_distinct_columns", "SELECT game_id, count(DISTINCT (account, ip, day)) AS n FROM ev GROUP BY game_id")
def count_distinct_columns(spark, sf):
    return aggregates.count_distinct(roles.events(spark, sf), ["game_id"], ["account", "ip", "day"], "n")


@plan("count_distinct_if", "SELECT day, count(DISTINCT CASE WHEN event_type = 'view' THEN account END) AS viewers, count(DISTINCT CASE WHEN event_type = 'click' THEN account END) AS clickers FROM ev GROUP BY day")
def count_distinct_if(spark, sf):
    """One distinct of (day, kind, account) serves all conditions."""
    seen = roles.events(spark, sf).filter(F.col("event_type").isin("view", "click")).select("day", "event_type", "account").distinct()
    kind = lambda t: F.count(F.when(F.col("event_type") == t, 1))
    return seen.groupBy("day").agg(kind("view").alias("viewers"), kind("click").alias("clickers"))


@plan("pivot_sum", "SELECT member_id, " + ", ".join(f"CAST(sum(CASE WHEN pay_type = {n} THEN cents ELSE 0 END) AS BIGINT) AS type_{n}" for n in range(1, 6)) + " FROM l_orders WHERE pay_type BETWEEN 1 AND 5 GROUP BY member_id")
def pivot_sum(spark, sf):
    return aggregates.pivot_offsets(roles.ledger(spark, sf), ["member_id"], "pay_type", [1, 2, 3, 4, 5], F.col("cents"), "type_{}")


@plan("zero_filled_union", "SELECT day, CAST(sum(r) AS BIGINT) AS regs, CAST(sum(l) AS BIGINT) AS logins FROM (SELECT day, 1 AS r, 0 AS l FROM g_regs UNION ALL SELECT day, 0, 1 FROM g_logins) GROUP BY day")
def zero_filled_union(spark, sf):
    r = roles.regs(spark, sf).groupBy(F.col("reg_day").alias("day")).agg(F.count("*").alias("regs"))
    l = roles.logins(spark, sf).groupBy("day").agg(F.count("*").alias("logins"))
    return aggregates.zero_filled_union([r, l], ["day"], ["regs", "logins"])


@plan("bucket_label", "SELECT order_no, CASE WHEN cents >= 30000000 THEN 'high' WHEN cents >= 10000000 THEN 'middle' ELSE 'low' END AS label FROM l_orders")
def bucket_label(spark, sf):
    return roles.ledger(spark, sf).select("order_no", aggregates.bucket_label(F.col("cents"), [0, 10_000_000, 30_000_000], ["low", "middle", "high"]).alias("label"))


@plan("histogram", "SELECT game_id, count(CASE WHEN n BETWEEN 1 AND 5 THEN 1 END) AS few, count(CASE WHEN n BETWEEN 6 AND 9 THEN 1 END) AS some, count(CASE WHEN n >= 10 THEN 1 END) AS many FROM (SELECT game_id, account, count(*) AS n FROM ev GROUP BY ALL) GROUP BY game_id")
def histogram(spark, sf):
    per = roles.events(spark, sf).groupBy("game_id", "account").agg(F.count("*").alias("n"))
    return aggregates.histogram(per, ["game_id"], "n", [1, 6, 10], ["few", "some", "many"])


@plan("first_last_touch", "SELECT account, min(day) AS first_day, max(day) AS last_day, arg_min(medium, (ts, event_id)) AS first_medium, arg_max(medium, (ts, event_id)) AS last_medium FROM ev GROUP BY account")
def first_last_touch(spark, sf):
    order = F.struct("ts", "event_id")
    return roles.events(spark, sf).groupBy("account").agg(
        F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.min_by("medium", order).alias("first_medium"), F.max_by("medium", order).alias("last_medium"))


@plan("set_text", "SELECT medium, string_agg(DISTINCT CAST(game_id AS VARCHAR), '|' ORDER BY CAST(game_id AS VARCHAR)) AS games FROM ev GROUP BY medium")
def set_text(spark, sf):
    """The games are distinct before they are collected: the set is bounded by the catalogue."""
    return aggregates.set_text(roles.events(spark, sf).select("medium", "game_id").distinct(), ["medium"], "game_id", "games")


@plan("ladder_text", f"SELECT grp, string_agg(threshold || '=' || rate, '|' ORDER BY threshold) AS ladder, (SELECT count(*) FROM l_orders o WHERE o.member_id % 3 = grp) AS orders FROM (VALUES {LADDER_VALUES}) t(grp, threshold, rate) GROUP BY grp")
def ladder_text(spark, sf):
    """Steps of a ladder in order as one text, whatever the partitioning."""
    step = F.concat_ws("=", "threshold", "rate")
    text = _ladder(spark).groupBy("grp").agg(F.sort_array(F.collect_list(F.struct("threshold", step.alias("s")))).alias("_s"))
    counts = _graded(spark, sf).groupBy("grp").agg(F.count("*").alias("orders"))
    return text.join(counts, "grp").select("grp", F.array_join(F.col("_s.s"), "|").alias("ladder"), "orders")


CONTRACT_STEPS = "(SELECT p_brand AS contract, p_size * 1000 AS threshold, CAST(max(p_partkey % 90) AS INT) AS rate FROM part GROUP BY ALL)"


def contract_steps(spark, sf):
    """Ladders of contracts: a contract for each brand, a step for each of its sizes."""
    p = roles.table(spark, sf, "part")
    return p.groupBy(F.col("p_brand").alias("contract"), (F.col("p_size") * 1000).alias("threshold")).agg(F.max(F.col("p_partkey") % 90).cast("int").alias("rate"))


@plan("contract_ladder_text", f"SELECT contract, string_agg(threshold || '=' || rate, '|' ORDER BY threshold) AS ladder FROM {CONTRACT_STEPS} GROUP BY contract")
def contract_ladder_text(spark, sf):
    return aggregates.ladder_text(contract_steps(spark, sf), ["contract"], "threshold", "rate", "ladder")


@plan("contract_next_bound", f"SELECT contract, threshold, rate, lead(threshold) OVER (PARTITION BY contract ORDER BY threshold) AS high FROM {CONTRACT_STEPS}")
def contract_next_bound(spark, sf):
    return joins.ladder_ranges(contract_steps(spark, sf), ["contract"], "threshold").drop("low")


@plan("zero_ratio", "SELECT s_suppkey, CASE WHEN coalesce(n, 0) = 0 THEN 0 ELSE round(r / n, 6) END AS return_rate FROM supplier LEFT JOIN (SELECT l_suppkey, count(*) AS n, count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS r FROM lineitem GROUP BY l_suppkey) ON l_suppkey = s_suppkey")
def zero_ratio(spark, sf):
    n = roles.table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.count("*").alias("n"), F.count(F.when(F.col("l_returnflag") == "R", 1)).alias("r"))
    return roles.table(spark, sf, "supplier").select("s_suppkey").join(n, "s_suppkey", "left").select("s_suppkey", c.zero_ratio("r", "n").alias("return_rate"))


@plan("weighted_sum", "SELECT l_suppkey, CAST(round(sum(CAST(round(l_extendedprice * 100) AS BIGINT) * (100 - CAST(round(l_discount * 100) AS INT))) / 100) AS BIGINT) AS net_cents FROM lineitem GROUP BY l_suppkey")
def weighted_sum(spark, sf):
    """Whole cents times whole percent: exact, whatever the order of summing."""
    return roles.items(spark, sf).groupBy(F.col("package_no").alias("l_suppkey")).agg(F.round(F.sum(F.col("cents") * (100 - F.col("discount"))) / 100).cast("long").alias("net_cents"))


@plan("signed_sum", "SELECT member_id, CAST(sum(CASE WHEN status = 8 THEN -cents ELSE cents END) AS BIGINT) AS net FROM l_orders WHERE status IN (4, 8) GROUP BY member_id")
def signed_sum(spark, sf):
    return roles.ledger(spark, sf).filter("status in (4, 8)").groupBy("member_id").agg(F.sum(c.signed_cents("cents", "status")).alias("net"))


@plan("roll_up", "SELECT game_id, day, CAST(sum(cents) AS BIGINT) AS cents FROM g_paid GROUP BY ALL")
def roll_up(spark, sf):
    fine = c.valid_orders(roles.game_orders(spark, sf)).groupBy("game_id", "medium", "day").agg(F.sum("cents").alias("cents"))
    return aggregates.roll_up(fine, ["game_id", "day"], ["cents"])


@plan("subtract", "SELECT day, count(*) - count(CASE WHEN event_type = 'click' THEN 1 END) AS n FROM ev GROUP BY day")
def subtract(spark, sf):
    e = roles.events(spark, sf)
    n = lambda df: df.groupBy("day").agg(F.count("*").alias("n"))
    return aggregates.subtract(n(e), n(e.filter("event_type = 'click'")), ["day"], ["n"])


# --- windows -----------------------------------------------------------------------------------------
@plan("first_row", "SELECT account, event_id, game_id FROM (SELECT *, row_number() OVER (PARTITION BY account ORDER BY ts, event_id) AS rn FROM g_regs) WHERE rn = 1")
def first_row(spark, sf):
    return keyed.first_row(roles.regs(spark, sf).select("account", "reg_ts", "event_id", "game_id"), ["account"], ["reg_ts", "event_id"]).drop("reg_ts")


@plan("first_day_rows", "SELECT account, event_id FROM (SELECT *, dense_rank() OVER (PARTITION BY account ORDER BY day) AS rk FROM g_paid) WHERE rk = 1")
def first_day_rows(spark, sf):
    paid = c.valid_orders(roles.game_orders(spark, sf)).select("account", "event_id", "day")
    return keyed.first_day_rows(paid, ["account"], "day").select("account", "event_id")


@plan("running_total", "SELECT game_id, day, CAST(sum(cents) AS BIGINT) AS cents, CAST(sum(sum(cents)) OVER (PARTITION BY game_id ORDER BY day) AS BIGINT) AS total_cents FROM g_paid GROUP BY game_id, day")
def running_total(spark, sf):
    return keyed.running_total(c.valid_orders(roles.game_orders(spark, sf)), ["game_id"], "day", ["cents"])


@plan("group_total", "SELECT order_no, CAST(sum(cents) OVER (PARTITION BY member_id, game_id) AS BIGINT) AS member_cents FROM l_orders")
def group_total(spark, sf):
    return keyed.with_group_total(roles.ledger(spark, sf).select("order_no", "member_id", "game_id", "cents"), ["member_id", "game_id"], "cents", "member_cents").select("order_no", "member_cents")


@plan("top_k", "SELECT game_id, order_no, rank FROM (SELECT game_id, order_no, row_number() OVER (PARTITION BY game_id ORDER BY cents DESC, order_no) AS rank FROM g_orders) WHERE rank <= 5")
def top_k(spark, sf):
    return keyed.top_k(roles.game_orders(spark, sf).select("game_id", "order_no", "cents"), ["game_id"], [F.desc("cents"), F.asc("order_no")], 5).select("game_id", "order_no", F.col("rank").cast("long").alias("rank"))


@plan("next_tier_bound", f"SELECT grp, threshold, rate, lead(threshold) OVER (PARTITION BY grp ORDER BY threshold) AS high, (SELECT count(*) FROM l_orders o WHERE o.member_id % 3 = grp) AS orders FROM (VALUES {LADDER_VALUES}) t(grp, threshold, rate)")
def next_tier_bound(spark, sf):
    counts = _graded(spark, sf).groupBy("grp").agg(F.count("*").alias("orders"))
    return joins.ladder_ranges(_ladder(spark), ["grp"], "threshold").drop("low").join(counts, "grp")


@plan("sliced_row_number", "SELECT event_id, row_number() OVER (PARTITION BY game_id ORDER BY ts, event_id) AS seq FROM ev")
def sliced_row_number(spark, sf):
    return keyed.sliced_row_number(roles.events(spark, sf).select("event_id", "game_id", "ts"), ["game_id"], "ts", ["event_id"], "seq", unit="hour").select("event_id", "seq")


@plan("representative", "SELECT p_brand, arg_min(p_name, (p_size, p_partkey)) AS p_name FROM part GROUP BY p_brand")
def representative(spark, sf):
    p = roles.table(spark, sf, "part").select("p_brand", "p_size", "p_partkey", "p_name")
    return keyed.first_row(p, ["p_brand"], ["p_size", "p_partkey"]).select("p_brand", "p_name")


# --- sort and sets -------------------------------------------------------------------------------------
@plan("global_sort", "SELECT package, mstart_date, promotion_channel FROM g_packages ORDER BY package, mstart_date")
def global_sort(spark, sf):
    return roles.packages(spark, sf).select("package", "mstart_date", "promotion_channel").orderBy("package", "mstart_date")


@plan("first_probe", "SELECT imei, min(day) AS day FROM g_regs WHERE imei <> '' GROUP BY imei")
def first_probe(spark, sf):
    """What a per-row probe with ``limit 1`` asks, for all keys at once."""
    return roles.regs(spark, sf).filter("imei <> ''").groupBy("imei").agg(F.min("reg_day").alias("day"))


@plan("union_all", "SELECT account, day FROM g_regs UNION ALL SELECT account, day FROM g_logins")
def union_all(spark, sf):
    return roles.regs(spark, sf).select("account", F.col("reg_day").alias("day")).unionByName(roles.logins(spark, sf).select("account", "day"))


@plan("union_distinct", "SELECT account, day FROM g_regs UNION SELECT account, day FROM g_logins")
def union_distinct(spark, sf):
    return union_all(spark, sf).distinct()


@plan("distinct_rows", "SELECT DISTINCT account, game_id, day FROM g_logins")
def distinct_rows(spark, sf):
    return roles.logins(spark, sf).select("account", "game_id", "day").dropDuplicates()


@plan("scalar_functions", """SELECT event_id, substr(CAST(day AS VARCHAR), 1, 7) AS month, day + 7 AS week_on, date_diff('day', DATE '2024-01-01', day) AS days_in, lpad(CAST(k AS VARCHAR), 4, '0') AS code,
  replace(ip, '.', '') AS digits, round(cents / 100, 1) AS yuan, CASE WHEN account LIKE 'acc1%' THEN 'one' ELSE 'other' END AS prefix FROM ev""")
def scalar_functions(spark, sf):
    return roles.events(spark, sf).select(
        "event_id", F.substring(F.col("day").cast("string"), 1, 7).alias("month"), F.date_add("day", 7).alias("week_on"), F.datediff("day", F.lit("2024-01-01").cast("date")).alias("days_in"),
        F.lpad(F.col("k").cast("string"), 4, "0").alias("code"), F.regexp_replace("ip", r"\.", "").alias("digits"), F.round((F.col("cents") / 100).cast("decimal(18,4)"), 1).cast("double").alias("yuan"),
        F.when(F.col("account").like("acc1%"), "one").otherwise("other").alias("prefix"))
