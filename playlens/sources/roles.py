"""The roles of the shared test tables: which rows play registrations, logins, orders and so on.

Each role is a projection of a whole table. ``ROLE_SQL`` holds the same projections as SQL for the
side-by-side check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.functions.cleanse import split_channel, split_device

TEST_START, TEST_END = "2024-01-01", "2024-01-30"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def as_events(ev: DataFrame) -> DataFrame:
    """The event log with the fields that game logs carry. Works on streams too."""
    # each step is a column before the next uses it, so that JSON and text are parsed once per row
    base = ev.select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "user_id",
        F.round(F.col("value") * 100).cast("long").alias("cents"), F.get_json_object("props", "$.k").cast("int").alias("k"))
    k, user = F.col("k"), F.col("user_id")
    channel = (
        F.when(k % 11 == 0, None).when(k % 13 == 0, "").when(k % 17 == 0, "m1")
        .otherwise(F.concat(F.lit("m"), k % 4, F.lit("_s"), k % 3, F.lit("_p"), k % 20))
    )
    device = F.when(user % 29 == 0, "").otherwise(
        F.concat(F.lit("d"), F.floor(user / 3).cast("long"), F.lit("&a"), F.floor(user / 6).cast("long"), F.lit("&"))
    )
    raw = base.withColumns({"expand_channel": channel, "device": device})
    ch, dv = split_channel("expand_channel"), split_device("device")
    return raw.select(
        "event_id", "ts", F.to_date("ts").alias("day"), "event_type", "k", "user_id",
        F.concat(F.lit("acc"), user).alias("account"), (k % 10).alias("game_id"), "expand_channel",
        ch["medium"].alias("medium"), ch["site"].alias("site"), ch["package"].alias("package"),
        dv["imei"].alias("imei"), dv["android_id"].alias("android_id"),
        F.concat(F.lit("10.0."), user % 16, F.lit("."), k % 8).alias("ip"),
        (user % 2 + 1).cast("int").alias("os"), "cents",
    )


def events(spark, sf_dir) -> DataFrame:
    return as_events(table(spark, sf_dir, "events"))


def _of_type(ev: DataFrame, kind: str, ts: str) -> DataFrame:
    return ev.filter(F.col("event_type") == kind).withColumn(ts, F.col("ts"))


def as_regs(ev: DataFrame) -> DataFrame:
    return _of_type(ev, "signup", "reg_ts").withColumnRenamed("day", "reg_day")


def regs(spark, sf_dir) -> DataFrame:
    return as_regs(events(spark, sf_dir))


def as_logins(ev: DataFrame) -> DataFrame:
    return _of_type(ev, "view", "login_ts")


def logins(spark, sf_dir) -> DataFrame:
    return as_logins(events(spark, sf_dir))


def as_actives(ev: DataFrame) -> DataFrame:
    return _of_type(ev, "view", "active_ts")


def actives(spark, sf_dir) -> DataFrame:
    return as_actives(events(spark, sf_dir))


def as_clicks(ev: DataFrame) -> DataFrame:
    return _of_type(ev, "click", "click_ts").withColumn("type", (F.col("event_id") % 4 + 1).cast("int"))


def clicks(spark, sf_dir) -> DataFrame:
    return as_clicks(events(spark, sf_dir))


def as_game_orders(ev: DataFrame) -> DataFrame:
    eid = F.col("event_id")
    return _of_type(ev, "purchase", "order_ts").withColumns({
        "order_no": eid,
        "status": F.when(eid % 10 == 0, 8).when(eid % 10 == 1, 0).otherwise(4),
        "prod_type": F.when(eid % 9 == 0, 1).otherwise(6),
        "pay_type": (eid % 6).cast("int"),
    })


def game_orders(spark, sf_dir) -> DataFrame:
    return as_game_orders(events(spark, sf_dir))


def receipts(spark, sf_dir) -> DataFrame:
    """Store receipts: some orders are test purchases, a few of them not yet settled."""
    eid = F.col("event_id")
    return game_orders(spark, sf_dir).filter(eid % 17 == 0).select(
        "order_no", F.lit(1).alias("sandbox"), F.when(eid % 51 == 0, 1).otherwise(3).alias("state")
    )


def published(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "part").filter(F.col("p_partkey") % 10 != 7).select((F.col("p_partkey") % 10).cast("int").alias("game_id")).distinct()


def games(spark, sf_dir) -> DataFrame:
    """Child games with parent, platform, group."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("child_game_id"),
        F.regexp_extract("p_brand", r"(\d+)", 1).cast("int").alias("parent_game_id"),
        (F.col("p_size") % 2 + 1).alias("system_type"), (F.col("p_size") % 5).alias("group_id"),
        F.when(F.col("p_partkey") % 13 == 8, 1).otherwise(0).alias("state"),
    )


def packages(spark, sf_dir) -> DataFrame:
    """Packages with two validity spans each, before and from 15 January 2024."""
    s = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("p"), "s_suppkey").alias("package"), F.col("s_name").alias("head_people"),
        F.concat(F.lit("c"), "s_nationkey").alias("old"), F.concat(F.lit("c"), (F.col("s_nationkey") + 1)).alias("new"),
    )
    d = lambda x: F.lit(x).cast("date")
    span = lambda a, b, c: F.struct(d(a).alias("mstart_date"), d(b).alias("mend_date"), F.col(c).alias("promotion_channel"))
    spans = F.array(span("2016-01-01", "2024-01-14", "old"), span("2024-01-15", "9999-01-01", "new"))
    return s.select("package", "head_people", F.inline(spans))


def ledger(spark, sf_dir) -> DataFrame:
    """The recharge ledger over several years."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    return table(spark, sf_dir, "orders").select(
        key.alias("order_no"), cust.alias("member_id"),
        F.concat(F.lit("ga"), cust * 7 + key % 5).alias("account"),
        F.col("o_orderdate").cast("timestamp").alias("order_ts"), F.to_date("o_orderdate").alias("day"),
        F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"),
        F.when(F.col("o_orderstatus") == "F", 4).when(F.col("o_orderstatus") == "P", 8).otherwise(0).alias("status"),
        (key % 6 + 1).cast("int").alias("prod_type"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("pay_type"),
        (key % 7).cast("int").alias("channel_id"), (cust % 20).cast("int").alias("game_id"),
        F.round(F.col("o_totalprice")).cast("long").alias("rebate_cents"),
        F.when(key % 3 == 0, cust + 1).otherwise(cust).alias("user_id"),
        (key % 2 + 1).cast("int").alias("os"),
    )


def items(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_no"), F.col("l_partkey").alias("child_game_id"),
        F.col("l_suppkey").alias("package_no"), F.col("l_linenumber").alias("line_no"),
        F.to_date("l_shipdate").alias("day"), F.round(F.col("l_extendedprice") * 100).cast("long").alias("cents"),
        F.round(F.col("l_discount") * 100).cast("int").alias("discount"),
        F.round(F.col("l_tax") * 100).cast("int").alias("tax"), F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_returnflag").alias("flag"),
    )


def promoters(spark, sf_dir) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.alias("member_id"), F.floor(key / 10).cast("long").alias("owner_id"), F.col("c_name").alias("username"),
        F.col("c_nationkey").alias("group_id"), (key % 3).cast("int").alias("status"),
        F.when(F.col("c_acctbal") > 0, 1).otherwise(0).alias("member_grade"),
        F.date_add(F.lit("1995-01-01").cast("date"), (key % 1000).cast("int")).alias("created"),
        F.concat(F.lit("code"), key).alias("code"),
    )


def account_regs(spark, sf_dir) -> DataFrame:
    """Registrations of promoted accounts: the open orders of the ledger, several per account."""
    l = ledger(spark, sf_dir).filter(F.col("status") == 0)
    n = F.col("order_no")
    return l.select(
        "account", "game_id", "channel_id", "os", F.col("order_ts").alias("reg_ts"), F.col("day").alias("reg_day"), n.alias("reg_id"),
        F.when(n % 3 == 0, 8).when(n % 3 == 1, 6).otherwise(1).alias("resource"),
        F.when(n % 4 == 0, F.col("member_id")).alias("owner_id"),
        F.when((n % 3 == 0) & (n % 2 == 0), F.concat(F.lit("code"), "member_id")).alias("expand_code"),
        F.concat(F.lit("Customer#"), F.lpad(F.col("member_id").cast("string"), 9, "0")).alias("bind_name"),
    )


_EVENT_SQL = """ev0 AS (
  SELECT event_id, ts, CAST(ts AS DATE) AS day, event_type, user_id,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k, CAST(round(value * 100) AS BIGINT) AS cents
  FROM events),
ev AS (
  SELECT event_id, ts, day, event_type, k, user_id, 'acc' || user_id AS account, k % 10 AS game_id,
    CASE WHEN k % 11 = 0 OR k % 13 = 0 THEN '21' WHEN k % 17 = 0 THEN 'm1' ELSE 'm' || (k % 4) END AS medium,
    CASE WHEN k % 11 = 0 OR k % 13 = 0 OR k % 17 = 0 THEN '' ELSE 's' || (k % 3) END AS site,
    CASE WHEN k % 11 = 0 OR k % 13 = 0 OR k % 17 = 0 THEN '' ELSE 'p' || (k % 20) END AS package,
    CASE WHEN user_id % 29 = 0 THEN '' ELSE 'd' || (user_id // 3) END AS imei,
    CASE WHEN user_id % 29 = 0 THEN '' ELSE 'a' || (user_id // 6) END AS android_id,
    '10.0.' || (user_id % 16) || '.' || (k % 8) AS ip, CAST(user_id % 2 + 1 AS INT) AS os, cents
  FROM ev0)"""

# name of the role -> its SQL, in order of dependence
ROLE_SQL = {
    "ev": _EVENT_SQL,
    "g_regs": "g_regs AS (SELECT *, day AS reg_day, ts AS reg_ts FROM ev WHERE event_type = 'signup')",
    "g_logins": "g_logins AS (SELECT *, ts AS login_ts FROM ev WHERE event_type = 'view')",
    "g_actives": "g_actives AS (SELECT *, ts AS active_ts FROM ev WHERE event_type = 'view')",
    "g_clicks": "g_clicks AS (SELECT *, ts AS click_ts, CAST(event_id % 4 + 1 AS INT) AS type FROM ev WHERE event_type = 'click')",
    "g_orders": """g_orders AS (SELECT *, ts AS order_ts, event_id AS order_no,
      CASE WHEN event_id % 10 = 0 THEN 8 WHEN event_id % 10 = 1 THEN 0 ELSE 4 END AS status,
      CASE WHEN event_id % 9 = 0 THEN 1 ELSE 6 END AS prod_type, CAST(event_id % 6 AS INT) AS pay_type
      FROM ev WHERE event_type = 'purchase')""",
    "g_paid": """g_paid AS (SELECT * REPLACE (CASE WHEN status = 8 THEN -cents ELSE cents END AS cents)
      FROM g_orders WHERE status IN (4, 8) AND prod_type = 6)""",
    "g_receipts": """g_receipts AS (SELECT order_no, 1 AS sandbox, CASE WHEN order_no % 51 = 0 THEN 1 ELSE 3 END AS state
      FROM g_orders WHERE order_no % 17 = 0)""",
    "g_published": "g_published AS (SELECT DISTINCT CAST(p_partkey % 10 AS INT) AS game_id FROM part WHERE p_partkey % 10 <> 7)",
    "g_games": """g_games AS (SELECT p_partkey AS child_game_id, CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INT) AS parent_game_id,
      p_size % 2 + 1 AS system_type, p_size % 5 AS group_id, CASE WHEN p_partkey % 13 = 8 THEN 1 ELSE 0 END AS state FROM part)""",
    "g_packages": """g_packages AS (
      SELECT 'p' || s_suppkey AS package, s_name AS head_people, DATE '2016-01-01' AS mstart_date, DATE '2024-01-14' AS mend_date,
             'c' || s_nationkey AS promotion_channel FROM supplier
      UNION ALL SELECT 'p' || s_suppkey, s_name, DATE '2024-01-15', DATE '9999-01-01', 'c' || (s_nationkey + 1) FROM supplier)""",
    "l_orders": """l_orders AS (SELECT o_orderkey AS order_no, o_custkey AS member_id,
      'ga' || (o_custkey * 7 + o_orderkey % 5) AS account, o_orderdate AS order_ts, CAST(o_orderdate AS DATE) AS day,
      CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
      CASE o_orderstatus WHEN 'F' THEN 4 WHEN 'P' THEN 8 ELSE 0 END AS status, CAST(o_orderkey % 6 + 1 AS INT) AS prod_type,
      CAST(substr(o_orderpriority, 1, 1) AS INT) AS pay_type, CAST(o_orderkey % 7 AS INT) AS channel_id,
      CAST(o_custkey % 20 AS INT) AS game_id, CAST(round(o_totalprice) AS BIGINT) AS rebate_cents,
      CASE WHEN o_orderkey % 3 = 0 THEN o_custkey + 1 ELSE o_custkey END AS user_id,
      CAST(o_orderkey % 2 + 1 AS INT) AS os FROM orders)""",
    "l_items": """l_items AS (SELECT l_orderkey AS order_no, l_partkey AS child_game_id, l_suppkey AS package_no, l_linenumber AS line_no,
      CAST(l_shipdate AS DATE) AS day, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
      CAST(round(l_discount * 100) AS INT) AS discount, CAST(round(l_tax * 100) AS INT) AS tax,
      CAST(l_quantity AS INT) AS quantity, l_returnflag AS flag FROM lineitem)""",
    "l_promoters": """l_promoters AS (SELECT c_custkey AS member_id, c_custkey // 10 AS owner_id, c_name AS username,
      c_nationkey AS group_id, CAST(c_custkey % 3 AS INT) AS status, CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END AS member_grade,
      DATE '1995-01-01' + CAST(c_custkey % 1000 AS INT) AS created, 'code' || c_custkey AS code FROM customer)""",
    "l_regs": """l_regs AS (SELECT account, game_id, channel_id, os, order_ts AS reg_ts, day AS reg_day, order_no AS reg_id,
      CASE WHEN order_no % 3 = 0 THEN 8 WHEN order_no % 3 = 1 THEN 6 ELSE 1 END AS resource,
      CASE WHEN order_no % 4 = 0 THEN member_id END AS owner_id,
      CASE WHEN order_no % 3 = 0 AND order_no % 2 = 0 THEN 'code' || member_id END AS expand_code,
      'Customer#' || lpad(CAST(member_id AS VARCHAR), 9, '0') AS bind_name FROM l_orders WHERE status = 0)""",
}


def with_roles(sql: str) -> str:
    """The query with the roles as common table expressions in front."""
    head = ",\n".join(ROLE_SQL.values())
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {head},\n{body[5:]}"
    return f"WITH {head}\n{body}"
