"""Logs, sinks and streams: each writes to the shared folder what a feed would bring, and reads back the result."""

from __future__ import annotations

import time

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from playlens.functions.cleanse import ANDROID_RAW_NETWORKS, IOS_HASHED_NETWORKS, norm_account, split_channel, split_device, valid_orders
from playlens.operators import cohort
from playlens.plans import plan
from playlens.plans.attribution import CHAIN, chain_sql
from playlens.session import work_folder
from playlens.sinks import deltas, state, tables as sink
from playlens.sources import logs, roles
from playlens.streaming import jobs


# --- raw logs ------------------------------------------------------------------------------------------
def _text(ts):
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def tagged_lines(ev):
    """Events as the lines that game servers log; every 50th is cut short."""
    bar = lambda tag, *fields: F.concat_ws("|", F.concat(_text("ts"), F.lit(f",120 [INFO] stat: {tag}")), *[f if not isinstance(f, str) else F.lit(f) for f in fields])
    account = F.concat(F.lit(" "), F.upper("account"), F.lit(" "))
    t, game, chan = _text("ts"), F.col("game_id").cast("string"), F.coalesce("expand_channel", F.lit(""))
    device = F.when(F.col("imei") == "", "").otherwise(F.concat("imei", F.lit("&"), "android_id", F.lit("&m")))
    eid = F.col("event_id").cast("string")
    kinds = {
        "signup": bar("bi_regi", "r1", "", account, game, t, "8", "7", "", "", "", F.col("os").cast("string"), "code", chan, device, F.col("ip")),
        "view": bar("bi_login", "r1", "", account, t, "", chan, device, game, F.col("ip")),
        "purchase": bar("bi_order", "r1", eid, "", "", account, t, game, "7", "", (F.col("cents") / 100).cast("decimal(18,2)").cast("string"), "", "", "", "", "", "0", "", "",
                        F.when(F.col("event_id") % 10 == 0, "8").otherwise("4"), "", "", "6", "", device, "", "0", "a1", "role"),
        "click": bar("bi_channel", (F.col("event_id") % 4 + 1).cast("string"), chan, F.col("ip"), t, game),
        "error": bar("bi_active", game, "7", "", chan, t, F.col("ip"), F.col("os").cast("string"), device, "", "10.1", "phone"),
    }
    line = F.lit(None).cast("string")
    for kind, value in kinds.items():
        line = F.when(F.col("event_type") == kind, value).otherwise(line)
    cut = F.when(F.col("event_id") % 50 == 7, F.substring_index(line, "|", 3)).otherwise(line)
    return ev.select(cut.alias("value"))


def _log_folder(spark, sf):
    path = work_folder(spark, "lines")
    tagged_lines(roles.events(spark, sf)).write.text(path)
    return path


WHOLE = "event_id % 50 <> 7"
SECOND = "strftime(ts, '%Y-%m-%d %H:%M:%S')"


@plan("read_log_regi", f"SELECT account, game_id, {SECOND} AS reg_ts, medium, site, package, imei, android_id, ip FROM g_regs WHERE {WHOLE}")
def read_log_regi(spark, sf):
    r = logs.read_tagged_log(spark, _log_folder(spark, sf), "bi_regi").filter("is_valid")
    ch, dv = split_channel("expand_channel"), split_device("device")
    return r.select(norm_account("account").alias("account"), "game_id", _text("reg_ts").alias("reg_ts"), ch["medium"].alias("medium"), ch["site"].alias("site"), ch["package"].alias("package"),
                    dv["imei"].alias("imei"), dv["android_id"].alias("android_id"), "ip")


@plan("read_log_login", f"SELECT account, game_id, {SECOND} AS login_ts FROM g_logins WHERE {WHOLE}")
def read_log_login(spark, sf):
    r = logs.read_tagged_log(spark, _log_folder(spark, sf), "bi_login").filter("is_valid")
    return r.select(norm_account("account").alias("account"), "game_id", _text("login_ts").alias("login_ts"))


@plan("read_log_order", f"SELECT CAST(event_id AS VARCHAR) AS order_no, account, cents, CASE WHEN event_id % 10 = 0 THEN 8 ELSE 4 END AS status, 6 AS prod_type FROM g_orders WHERE {WHOLE}")
def read_log_order(spark, sf):
    from playlens.functions.cleanse import order_cents
    r = logs.read_tagged_log(spark, _log_folder(spark, sf), "bi_order").filter("is_valid")
    return r.select("order_no", norm_account("account").alias("account"), order_cents("ori_price", "total_amt").alias("cents"), "status", "prod_type")


@plan("read_log_click", f"SELECT type, ip, {SECOND} AS click_ts, game_id FROM g_clicks WHERE {WHOLE}")
def read_log_click(spark, sf):
    r = logs.read_tagged_log(spark, _log_folder(spark, sf), "bi_channel").filter("is_valid")
    return r.select("type", "ip", _text("click_ts").alias("click_ts"), "game_id")


@plan("read_log_active", f"SELECT game_id, {SECOND} AS active_ts, imei, CAST(os AS VARCHAR) AS os FROM ev WHERE event_type = 'error' AND {WHOLE}")
def read_log_active(spark, sf):
    r = logs.read_tagged_log(spark, _log_folder(spark, sf), "bi_active").filter("is_valid")
    return r.select("game_id", _text("active_ts").alias("active_ts"), split_device("device")["imei"].alias("imei"), "os")


@plan("malformed_lines", "SELECT event_type AS kind, count(*) AS n FROM ev WHERE event_id % 50 = 7 GROUP BY event_type")
def malformed_lines(spark, sf):
    from functools import reduce
    lines = logs.read_lines(spark, _log_folder(spark, sf))
    tags = {"signup": "bi_regi", "view": "bi_login", "purchase": "bi_order", "click": "bi_channel", "error": "bi_active"}
    bad = [logs.parse_tagged(lines, tag).filter("not is_valid").select(F.lit(kind).alias("kind")) for kind, tag in tags.items()]
    return reduce(lambda a, b: a.unionByName(b), bad).groupBy("kind").agg(F.count("*").alias("n"))


def ad_lines(spark, sf, package=None, agent=None, device=None):
    """Click reports in the dialect of each network; some are no JSON at all."""
    c = roles.clicks(spark, sf)
    package = F.concat("game_id", F.lit("000M19006")) if package is None else package
    agent = F.lit("ua") if agent is None else agent
    sent = device or (lambda code: F.col("imei"))
    js = None
    n = F.col("event_id") % 13
    second, milli = F.unix_timestamp("ts").cast("string"), F.unix_millis(F.date_trunc("second", "ts")).cast("string")
    for i, net in enumerate(logs.AD_NETWORKS):
        code = F.when(F.col("os") == 1, net["android"][0]).otherwise(net["ios"][0])
        fields = {"pkg_id": package, ("app_type" if net["code"] == 6 else "os"): code, net["device"]: sent(net["code"]), net["time"]: second if i % 2 else milli}
        if net["code"] == 17:
            fields["idfa"] = sent(net["code"])
        if net["adv_id"] is not None:
            fields["adv_id"] = F.lit(str(net["adv_id"]))
        for role, value in {"callback": F.lit("cb"), "idea": F.lit("idea"), "level1": F.lit("l1"), "level2": F.lit("l2"), "ip": F.col("ip"), "ua": agent}.items():
            if net[role]:
                fields[net[role]] = value
        text = F.concat(F.lit(net["tag"]), F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()])))
        js = F.when(n == i, text) if js is None else js.when(n == i, text)
    return c.select(js.otherwise("bi_adv_uc_click{broken").alias("value"))


CODES = [net["code"] for net in logs.AD_NETWORKS]


@plan("parse_ad_clicks", f"SELECT [{', '.join(map(str, CODES))}][event_id % 13 + 1] AS network, CASE os WHEN 1 THEN 'android' ELSE 'ios' END AS os, imei AS device_id, {SECOND} AS click_ts, game_id || '000M19006' AS pkg_id, "
      f"CASE WHEN [{', '.join(map(str, CODES))}][event_id % 13 + 1] IN (2, 4, 8, 18, -1) THEN ip ELSE '' END AS ip FROM g_clicks WHERE event_id % 13 <> 12")
def parse_ad_clicks(spark, sf):
    path = work_folder(spark, "ad-lines")
    ad_lines(spark, sf).write.text(path)
    clicks = logs.parse_ad_clicks(logs.read_lines(spark, path)).filter("is_valid")
    return clicks.select("network", "os", "device_id", _text("click_ts").alias("click_ts"), "pkg_id", "ip")


_WITH_AGENT = ", ".join(str(net["code"]) for net in logs.AD_NETWORKS if net["ua"])
PARSED_CLICKS = f"""SELECT event_id AS click_id, game_id, os, day, date_trunc('second', ts) AS click_ts, '' AS android_id, package, CAST(k % 4 + 1 AS INT) AS network, 'i' || (k % 6) AS idea_id,
  CASE WHEN imei = '' THEN '' WHEN os = 1 AND net IN (17, 18) THEN upper(md5(imei)) ELSE upper(md5(upper(imei))) END AS device, CASE WHEN net IN ({_WITH_AGENT}) THEN ip ELSE '' END AS ip,
  CASE WHEN net IN ({_WITH_AGENT}) THEN 't' || (user_id % 5) ELSE '' END AS dev_type, CASE WHEN net IN ({_WITH_AGENT}) THEN 'v' || (user_id % 3) ELSE '' END AS sys_version
  FROM (SELECT *, [{', '.join(map(str, CODES))}][event_id % 13 + 1] AS net FROM g_clicks WHERE event_id % 13 <> 12)"""


@plan("attribute_parsed_clicks", chain_sql(PARSED_CLICKS) + "SELECT active_id, click_id, rule FROM ad_m")
def attribute_parsed_clicks(spark, sf):
    """From the networks' JSON lines to matches: ids hashed as each network does, devices told by their user agent."""
    from playlens.operators.attribution import attribute_activation
    from playlens.plans.attribution import ad_actives
    hashing = lambda code: F.when((F.col("os") == 2) & F.lit(code in IOS_HASHED_NETWORKS) | (F.col("os") == 1) & F.lit(code not in ANDROID_RAW_NETWORKS), F.when(F.col("imei") == "", "").otherwise(F.md5(F.upper("imei")))).otherwise(F.col("imei"))
    agent = F.concat(F.lit("t"), F.col("user_id") % 5, F.lit(" v"), F.col("user_id") % 3)
    path = work_folder(spark, "ad-lines")
    ad_lines(spark, sf, F.concat(1_000 + F.col("game_id"), F.lit("M"), 1_000_000 + F.col("event_id")), agent, hashing).write.text(path)
    parsed = logs.clicks_to_match(logs.parse_ad_clicks(logs.read_lines(spark, path)))
    clicks = parsed.withColumns({"game_id": F.col("game_id") - 1_000, "click_id": F.substring_index("pkg_id", "M", -1).cast("long") - 1_000_000})
    return attribute_activation(ad_actives(spark, sf), clicks)


@plan("parse_landing_requests", f"SELECT 'm' || (k % 4) AS medium, 's' || (k % 3) AS site, 'p' || (k % 20) AS package, game_id, {SECOND} AS click_ts, ip FROM g_clicks WHERE event_id % 5 <> 0")
def parse_landing_requests(spark, sf):
    status = F.when(F.col("event_id") % 5 == 0, '404').otherwise('200')
    line = F.concat(F.lit("1.1.1.1 - - ["), F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(" +0800] \"GET /Ssxy/loadComplete?p=m"), F.col("k") % 4, F.lit("_s"), F.col("k") % 3, F.lit("_p"), F.col("k") % 20,
                    F.lit("&g="), "game_id", F.lit(" HTTP/1.0\" "), status, F.lit(" 12 \"-\" \"agent\" "), "ip", F.lit(", 10.9.9.9"))
    path = work_folder(spark, "access")
    roles.clicks(spark, sf).select(line.alias("value")).write.text(path)
    hits = logs.parse_landing_requests(logs.read_lines(spark, path))
    return hits.withColumn("click_ts", _text("click_ts")).drop("type")


@plan("parse_money_master", f"SELECT game_id, imei, {SECOND} AS ts, CASE WHEN event_id % 2 = 0 THEN 'bi_adv_money_click' ELSE 'bi_adv_money_active' END AS adv_name FROM g_clicks WHERE event_id % 7 <> 0")
def parse_money_master(spark, sf):
    name = F.when(F.col("event_id") % 2 == 0, "bi_adv_money_click").otherwise("bi_adv_money_active")
    game = F.when(F.col("event_id") % 7 == 0, "none").otherwise(F.col("game_id").cast("string"))
    report = F.to_json(F.struct(game.alias("game_id"), F.lit("1M2").alias("pkg_id"), F.lit("5").alias("app_id"), _text("ts").alias("ts"), "imei", "ip", name.alias("adv_name")))
    path = work_folder(spark, "money")
    roles.clicks(spark, sf).select(F.concat(F.lit("x "), report).alias("value")).write.text(path)
    r = logs.parse_money_master(logs.read_lines(spark, path))
    return r.select("game_id", "imei", _text("ts").alias("ts"), "adv_name")


@plan("parse_role_events", f"SELECT 'r' || user_id AS role_id, account, game_id, k AS level, {SECOND} AS update_ts FROM g_logins")
def parse_role_events(spark, sf):
    role = F.to_json(F.struct(F.concat(F.lit("r"), "user_id").alias("roleid"), F.lit("n").alias("rolename"), "account", F.col("game_id").alias("gameid"), F.lit("s").alias("serverid"), F.col("k").alias("level"), _text("ts").alias("updatetime")))
    path = work_folder(spark, "roles")
    roles.logins(spark, sf).select(F.concat(F.lit("BI_ROLE"), role).alias("value")).write.text(path)
    r = logs.parse_role_events(logs.read_lines(spark, path))
    return r.select("role_id", "account", "game_id", "level", _text("update_ts").alias("update_ts"))


@plan("explode_error_log", f"SELECT imei, 'c' || (k % 5 + n) AS code, {SECOND} AS error_ts FROM ev, range(3) t(n) WHERE event_type = 'error' AND n < k % 4")
def explode_error_log(spark, sf):
    error = lambda i: F.struct(F.concat(F.lit("c"), F.col("k") % 5 + i).alias("code"), F.lit("m").alias("message"), _text("ts").alias("time"))
    data = F.slice(F.array(error(0), error(1), error(2)), 1, F.col("k") % 4)
    path = work_folder(spark, "errors")
    e = roles.events(spark, sf).filter("event_type = 'error'")
    e.select(F.to_json(F.struct("imei", F.lit("p").alias("platform"), F.lit("1").alias("version"), data.alias("data"))).alias("value")).write.text(path)
    r = logs.explode_error_log(logs.read_lines(spark, path))
    return r.select("imei", "code", _text("error_ts").alias("error_ts"))


# --- sinks -----------------------------------------------------------------------------------------------
def _halves(spark, sf):
    """Daily revenue per game and medium in two loads, one from each half of the months' pay types."""
    paid = valid_orders(roles.game_orders(spark, sf))
    load = lambda cond: paid.filter(cond).groupBy("day", "game_id", "medium").agg(F.sum("cents").alias("cents"), F.max("event_id").alias("last_id"))
    return load("pay_type < 3"), load("pay_type >= 3")


HALVES = """WITH a AS (SELECT day, game_id, medium, CAST(sum(cents) AS BIGINT) AS cents, max(event_id) AS last_id FROM g_paid WHERE pay_type < 3 GROUP BY ALL),
 b AS (SELECT day, game_id, medium, CAST(sum(cents) AS BIGINT) AS cents, max(event_id) AS last_id FROM g_paid WHERE pay_type >= 3 GROUP BY ALL), """
KEYS = ["day", "game_id", "medium"]


def _two_loads(spark, sf, rules):
    a, b = _halves(spark, sf)
    path = work_folder(spark, "table")
    for load in (a, b):
        sink.upsert(load, path, KEYS, rules, ["day"])
    return spark.read.parquet(path)


BOTH = "SELECT day, game_id, medium, {} FROM a FULL JOIN b USING (day, game_id, medium)"


@plan("upsert_replace", HALVES[:-2] + BOTH.format("coalesce(b.cents, a.cents) AS cents, coalesce(b.last_id, a.last_id) AS last_id"))
def upsert_replace(spark, sf):
    return _two_loads(spark, sf, {"cents": sink.REPLACE, "last_id": sink.REPLACE})


@plan("upsert_add", HALVES[:-2] + BOTH.format("coalesce(a.cents, 0) + coalesce(b.cents, 0) AS cents, coalesce(a.last_id, b.last_id) AS last_id"))
def upsert_add(spark, sf):
    return _two_loads(spark, sf, {"cents": sink.ADD, "last_id": sink.KEEP})


@plan("upsert_greatest", HALVES[:-2] + BOTH.format("greatest(a.cents, b.cents) AS cents, greatest(a.last_id, b.last_id) AS last_id"))
def upsert_greatest(spark, sf):
    return _two_loads(spark, sf, {"cents": sink.GREATEST, "last_id": sink.GREATEST})


@plan("upsert_add_if", """WITH a AS (SELECT member_id, max(day) AS last_day, CAST(sum(cents) AS BIGINT) AS cents FROM l_orders WHERE status = 4 AND pay_type < 3 GROUP BY ALL), b AS (SELECT * FROM l_orders WHERE status = 4 AND pay_type >= 3),
 s AS (SELECT b.member_id, max(b.day) AS last_day, CAST(sum(CASE WHEN a.last_day IS NULL OR b.day >= a.last_day THEN b.cents ELSE 0 END) AS BIGINT) AS cents FROM b LEFT JOIN a USING (member_id) GROUP BY b.member_id)
 SELECT coalesce(a.member_id, s.member_id) AS member_id, greatest(a.last_day, s.last_day) AS last_day, coalesce(a.cents, 0) + coalesce(s.cents, 0) AS cents, CAST(coalesce(a.member_id, s.member_id) % 8 AS INT) AS part FROM a FULL JOIN s ON a.member_id = s.member_id""")
def upsert_add_if(spark, sf):
    led = roles.ledger(spark, sf).filter("status = 4").withColumn("part", (F.col("member_id") % 8).cast("int"))
    path = work_folder(spark, "table")
    rules = {"cents": sink.add_if("last_day"), "last_day": sink.GREATEST}
    first = led.filter("pay_type < 3").groupBy("part", "member_id").agg(F.max("day").alias("last_day"), F.sum("cents").alias("cents"))
    sink.upsert(first, path, ["part", "member_id"], rules, ["part"])
    sink.upsert(led.filter("pay_type >= 3").select("part", "member_id", F.col("day").alias("last_day"), "cents"), path, ["part", "member_id"], rules, ["part"])
    return spark.read.parquet(path)


@plan("append_detail", "SELECT game_id, imei, min(event_id) AS event_id FROM (SELECT game_id, imei, event_id, row_number() OVER (PARTITION BY game_id, imei ORDER BY CASE WHEN day < DATE '2024-01-10' THEN 0 ELSE 1 END, ts, event_id) AS rn FROM g_regs) WHERE rn = 1 GROUP BY ALL")
def append_detail(spark, sf):
    regs = roles.regs(spark, sf).select("game_id", "imei", "reg_ts", "event_id", "reg_day")
    path = work_folder(spark, "detail")
    for part in ("reg_day < DATE'2024-01-10'", "reg_day >= DATE'2024-01-08'"):  # the loads overlap
        sink.append_detail(regs.filter(part), path, ["game_id", "imei"], ["reg_ts", "event_id"])
    return spark.read.parquet(path).select("game_id", "imei", "event_id")


@plan("replace_date_range", """SELECT day, game_id, n FROM (SELECT day, game_id, count(*) AS n FROM g_logins GROUP BY ALL) WHERE day NOT BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'
  UNION ALL SELECT day, game_id, count(*) FROM g_clicks WHERE day BETWEEN DATE '2024-01-10' AND DATE '2024-01-11' GROUP BY ALL""")
def replace_date_range(spark, sf):
    """10th to 12th are replaced by clicks, of which the 12th has none to give: it must be empty after."""
    daily = lambda df: df.groupBy("day", "game_id").agg(F.count("*").alias("n"))
    path = work_folder(spark, "table")
    sink.overwrite_partitions(daily(roles.logins(spark, sf)), path, ["day"])
    sink.replace_date_range(daily(roles.clicks(spark, sf).filter("day <> DATE'2024-01-12'")), path, "day", "2024-01-10", "2024-01-12")
    return spark.read.parquet(path)


@plan("update_matching", HALVES[:-2] + "SELECT a.day, a.game_id, a.medium, coalesce(b.cents, a.cents) AS cents, a.last_id FROM a LEFT JOIN b USING (day, game_id, medium)")
def update_matching(spark, sf):
    a, b = _halves(spark, sf)
    path = work_folder(spark, "table")
    rules = {"cents": sink.REPLACE, "last_id": sink.KEEP}
    sink.upsert(a, path, KEYS, rules, ["day"])
    sink.update_matching(b, path, KEYS, rules, ["day"])
    return spark.read.parquet(path)


@plan("overwrite_partitions", """SELECT day, game_id, medium, cents FROM (SELECT day, game_id, medium, CAST(sum(cents) AS BIGINT) AS cents FROM g_paid WHERE pay_type < 3 GROUP BY ALL) WHERE day < DATE '2024-01-20'
  UNION ALL SELECT day, game_id, medium, CAST(sum(cents) AS BIGINT) FROM g_paid WHERE pay_type >= 3 AND day >= DATE '2024-01-20' GROUP BY ALL""")
def overwrite_partitions(spark, sf):
    a, b = _halves(spark, sf)
    path = work_folder(spark, "stage")
    sink.overwrite_partitions(a.drop("last_id"), path, ["day"])
    sink.overwrite_partitions(b.drop("last_id").filter("day >= DATE'2024-01-20'"), path, ["day"])
    return spark.read.parquet(path)


@plan("csv_report", "SELECT member_id, count(*) AS orders, CAST(sum(cents) AS BIGINT) AS cents FROM l_orders WHERE status = 4 GROUP BY member_id")
def csv_report(spark, sf):
    path = work_folder(spark, "report")
    sink.write_csv(roles.ledger(spark, sf).filter("status = 4").groupBy("member_id").agg(F.count("*").alias("orders"), F.sum("cents").alias("cents")), path)
    return spark.read.schema("member_id long, orders long, cents long").option("header", True).csv(path)


@plan("append_table", "SELECT event_id, day FROM g_regs UNION ALL SELECT event_id, day FROM g_logins")
def append_table(spark, sf):
    path = work_folder(spark, "log")
    sink.append_table(roles.regs(spark, sf).select("event_id", F.col("reg_day").alias("day")), path, ["day"])
    sink.append_table(roles.logins(spark, sf).select("event_id", "day"), path, ["day"])
    return spark.read.parquet(path)


# --- streams -----------------------------------------------------------------------------------------------
FILE_ROWS = 500_000  # of the event table to a file of a micro-batch


def batch_files(spark, sf):
    """Files that a micro-batch consists of: one, or as many as keep the tasks of a large table's batches busy."""
    return max(1, roles.table(spark, sf, "events").count() // (3 * FILE_ROWS))


def event_stream(spark, sf, files=("event_id % 3 = 1", "event_id % 3 = 0", "event_id % 3 = 2"), shifted=None):
    """The event table as a stream of files; the files of a micro-batch hold the rows of one condition.

    By default every batch spans all days, so most rows come late. ``shifted`` changes the raw table first.
    """
    path = work_folder(spark, "stream")
    add_files(spark, sf, path, files, shifted)
    return roles.as_events(logs.stream_folder(spark, path, roles.table(spark, sf, "events").schema, max_files=batch_files(spark, sf)))


def add_files(spark, sf, path, files, shifted=None):
    """More files for a stream that reads ``path``; the source takes files in order of their time.

    Rows are dealt out evenly, so a condition with many rows fills all files of its batch.
    """
    ev, n = roles.table(spark, sf, "events"), batch_files(spark, sf)
    ev = shifted(ev) if shifted else ev
    for condition in files:
        time.sleep(1.1)  # times are in seconds
        rows = ev.filter(condition)
        (rows.coalesce(1) if n == 1 else rows.repartition(n)).write.mode("append").parquet(path)


def run(stream, each, spark):
    jobs.start(stream, each, work_folder(spark, "checkpoint")).awaitTermination()


def run_to_table(stream, spark):
    out = work_folder(spark, "out")
    jobs.write_stream(stream, out, work_folder(spark, "checkpoint")).awaitTermination()
    return spark.read.parquet(out)


@plan("stream_demultiplex", f"SELECT event_type AS kind, count(*) FILTER ({WHOLE}) AS n, count(*) FILTER (NOT ({WHOLE})) AS malformed FROM ev GROUP BY event_type")
def stream_demultiplex(spark, sf):
    tags = {"signup": "bi_regi", "view": "bi_login", "purchase": "bi_order", "click": "bi_channel", "error": "bi_active"}
    out = work_folder(spark, "tags")
    run(tagged_lines(event_stream(spark, sf)), jobs.demultiplex(out, list(tags.values())), spark)
    from functools import reduce
    count = lambda kind, table, name: deltas.read_deltas(spark, f"{out}/{table}").agg(F.count("*").alias(name)).withColumn("kind", F.lit(kind))
    parts = [count(kind, tag, "n") for kind, tag in tags.items()] + [count(kind, f"{tag}_malformed", "malformed") for kind, tag in tags.items()]
    whole = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)
    return whole.groupBy("kind").agg(F.sum("n").alias("n"), F.sum("malformed").alias("malformed"))


DAYS = ("ts < DATE'2024-01-09'", "ts >= DATE'2024-01-09' AND ts < DATE'2024-01-21'", "ts >= DATE'2024-01-21'")


@plan("stream_dedup", "SELECT event_id AS order_no, account, cents FROM g_orders")
def stream_dedup(spark, sf):
    """Every order is reported again half an hour later; it is known for as long as the rule says."""
    orders = roles.as_game_orders(event_stream(spark, sf, DAYS)).select("order_no", "account", "cents", "ts")
    twice = orders.withColumn("late", F.explode(F.array(F.lit(0), F.lit(30)))).select("order_no", "account", "cents", (F.col("ts") + F.make_dt_interval(mins="late")).alias("ts"))
    return run_to_table(jobs.dedup_within(twice, ["order_no"], "ts", jobs.ORDER_TTL).drop("ts"), spark)


@plan("stream_dau", "SELECT game_id, day, count(DISTINCT account) AS dau_accounts FROM g_logins GROUP BY ALL")
def stream_dau(spark, sf):
    """What was seen is stored by day; the counts of the batches add up."""
    return _dau(spark, event_stream(spark, sf))


def _dau(spark, events):
    logins = events.filter("event_type = 'view'").select("account", "game_id", "day")
    out, keys = work_folder(spark, "dau"), ["game_id", "day"]
    run(logins, jobs.distinct_counts(out, keys, ["account"], "day", "dau_accounts"), spark)
    rules = {"dau_accounts": sink.ADD}
    deltas.fold(spark, out, keys, rules, 0)  # the first batch as base
    return deltas.read_merged(spark, out, keys, rules)


@plan("stream_dau_late", "SELECT game_id, CAST(CASE WHEN event_id % 7 = 0 THEN day - 60 ELSE day END AS DATE) AS day, count(DISTINCT account) AS dau_accounts FROM g_logins GROUP BY ALL")
def stream_dau_late(spark, sf):
    """A seventh of the rows is 60 days old and comes after all others, and again after that."""
    old = lambda ev: ev.withColumn("ts", F.when(F.col("event_id") % 7 == 0, F.col("ts") - F.expr("INTERVAL 60 DAYS")).otherwise(F.col("ts")))
    return _dau(spark, event_stream(spark, sf, ("event_id % 7 <> 0", "event_id % 7 = 0", "event_id % 7 = 0 OR event_id % 5 = 0"), old))


@plan("stream_first_seen", "SELECT game_id, strftime(date_trunc('hour', f), '%Y-%m-%d %H') AS hour, count(*) AS active_devices FROM (SELECT game_id, imei, min(ts) AS f FROM g_actives WHERE imei <> '' GROUP BY ALL) GROUP BY ALL")
def stream_first_seen(spark, sf):
    """Files arrive in any order; the signed changes still sum to the batch result."""
    actives = event_stream(spark, sf).filter("event_type = 'view' and imei <> ''").select("game_id", "imei", "ts")
    out = work_folder(spark, "first-seen")
    run(actives, jobs.first_seen(out, ["game_id", "imei"], "ts"), spark)
    changes = deltas.read_deltas(spark, f"{out}/changes")
    return changes.groupBy("game_id", F.date_format("hour", "yyyy-MM-dd HH").alias("hour")).agg(F.sum("change").alias("active_devices")).filter("active_devices <> 0")


@plan("stream_cohort_pay", "SELECT r.medium, r.reg_day, date_diff('day', r.reg_day, o.day) AS dur, CAST(sum(o.cents) AS BIGINT) AS cents FROM (SELECT DISTINCT account, medium, reg_day FROM g_regs) r JOIN (SELECT * FROM g_orders WHERE status = 4) o USING (account) GROUP BY ALL")
def stream_cohort_pay(spark, sf):
    orders = roles.as_game_orders(event_stream(spark, sf)).filter("status = 4").select("account", "day", "cents")
    out = work_folder(spark, "cohort")
    each = lambda df, batch: deltas.add_batch(df.groupBy("medium", "reg_day", "dur").agg(F.sum("cents").alias("cents")), out, batch)
    run(jobs.with_cohort(orders, roles.regs(spark, sf), ["medium"]), each, spark)
    return deltas.read_merged(spark, out, ["medium", "reg_day", "dur"], {"cents": sink.ADD})


@plan("stream_realtime_retention", "SELECT r.game_id, r.reg_day, " + ", ".join(f"CAST(count(DISTINCT CASE WHEN l.day = r.reg_day + {n} THEN r.account END) AS BIGINT) AS retained_{n}" for n in cohort.REALTIME_OFFSETS)
      + " FROM (SELECT DISTINCT game_id, account, reg_day FROM g_regs) r JOIN g_logins l ON l.account = r.account WHERE date_diff('day', r.reg_day, l.day) IN (1, 2, 6, 29) GROUP BY ALL")
def stream_realtime_retention(spark, sf):
    from playlens.operators.aggregates import pivot_offsets
    logins = event_stream(spark, sf).filter("event_type = 'view'").select("account", "day")
    out = work_folder(spark, "retention")
    def each(rows, batch):
        once = state.advance(rows, f"{out}/seen", batch, ["account"], F.lit(1), "max", F.col("day")).withColumnRenamed(state.PART, "day")
        back = jobs.realtime_retention(once, roles.regs(spark, sf), ["game_id"], cohort.REALTIME_OFFSETS)
        deltas.add_batch(pivot_offsets(back, ["game_id", "reg_day"], "dur", cohort.REALTIME_OFFSETS, F.lit(1), "retained_{}"), out, batch)
    run(logins, each, spark)
    return deltas.read_merged(spark, out, ["game_id", "reg_day"], {f"retained_{n}": sink.ADD for n in cohort.REALTIME_OFFSETS})


@plan("stream_registration_match", "SELECT r.event_id AS reg_id, a.event_id AS active_id FROM g_regs r JOIN g_actives a ON a.game_id = r.game_id AND a.account = r.account AND r.ts >= a.ts AND r.ts <= a.ts + INTERVAL 2 DAY")
def stream_registration_match(spark, sf):
    side = lambda kind, ident, ts: event_stream(spark, sf).filter(F.col("event_type") == kind).select("game_id", "account", F.col("event_id").alias(ident), F.col("ts").alias(ts))
    joined = jobs.join_within(side("signup", "reg_id", "reg_ts"), side("view", "active_id", "active_ts"), ["game_id", "account"], "reg_ts", "active_ts", 2, "40 days")
    return run_to_table(joined.select("reg_id", "active_id"), spark)


def _attributed(spark, sf):
    """Matches after a stream of clicks and activations, the first batches folded on the way."""
    from playlens.plans.attribution import _traits
    ev = _traits(event_stream(spark, sf)).filter("event_type in ('view', 'click')").withColumn("is_click", F.col("event_type") == "click")
    out = work_folder(spark, "attribution")
    each = jobs.attribution(out)
    def folded(rows, batch):
        each(rows, batch)
        if batch == 1:
            jobs.fold_matches(spark, out, 1)
    run(ev, folded, spark)
    return out


@plan("stream_attribution", CHAIN + "SELECT active_id, click_id, rule FROM ad_m")
def stream_attribution(spark, sf):
    """Whatever comes in which batch, the end is that of the batch operator."""
    return jobs.read_matches(spark, _attributed(spark, sf)).drop("day")


@plan("stream_attribution_changes", CHAIN + "SELECT m.rule, a.day, count(*) AS matches FROM ad_m m JOIN ad_a a USING (active_id) GROUP BY ALL")
def stream_attribution_changes(spark, sf):
    """What batches added and took back sums up to the matches."""
    changes = deltas.read_deltas(spark, f"{_attributed(spark, sf)}/changes")
    return changes.groupBy("rule", "day").agg(F.sum("sign").alias("matches")).filter("matches <> 0")


@plan("stream_session_time", """SELECT account, CAST(start_ts AS DATE) AS day, CAST(sum(epoch(date_trunc('second', e)) - epoch(start_ts)) AS BIGINT) AS online_seconds, count(*) AS sessions FROM
  (SELECT account, date_trunc('hour', ts) AS start_ts, max(ts) AS e FROM ev WHERE event_type IN ('view', 'click') GROUP BY ALL) GROUP BY ALL""")
def stream_session_time(spark, sf):
    online = event_stream(spark, sf).filter("event_type in ('view', 'click')").select("account", F.date_trunc("hour", "ts").alias("start_ts"), F.col("ts").alias("end_ts"))
    out = work_folder(spark, "sessions")
    run(online, jobs.session_time(out, ["account"]), spark)
    changes = deltas.read_deltas(spark, f"{out}/changes")
    return changes.groupBy("account", F.to_date("start_ts").alias("day")).agg(F.sum("seconds").alias("online_seconds"), F.sum("sessions").cast("long").alias("sessions"))


@plan("stream_late_dimension", "SELECT e.event_id, s.s_name FROM g_regs e JOIN supplier s ON 'p' || s.s_suppkey = e.package")
def stream_late_dimension(spark, sf):
    """The dimension knows nothing in the first batch; its rows wait and are met later."""
    calls = []
    def read_dim(s):
        calls.append(1)
        dim = roles.table(s, sf, "supplier").select(F.concat(F.lit("p"), "s_suppkey").alias("package"), "s_name")
        return dim if len(calls) > 1 else dim.limit(0)
    regs = event_stream(spark, sf).filter("event_type = 'signup'").select("event_id", "package")
    out = work_folder(spark, "late")
    run(regs, jobs.late_dimension(out, read_dim, "package", "event_id long, package string"), spark)
    return deltas.read_deltas(spark, f"{out}/known").select("event_id", "s_name")


@plan("stream_published", """WITH f AS (SELECT *, CASE WHEN day < DATE '2024-01-09' THEN 0 WHEN day < DATE '2024-01-21' THEN 1 ELSE 2 END AS batch FROM ev),
  a AS (SELECT game_id, min(batch) AS batch FROM f WHERE event_type = 'error' AND event_id % 97 = 1 GROUP BY ALL)
  SELECT event_id, game_id FROM f WHERE event_type = 'view' AND (game_id IN (SELECT game_id FROM g_published WHERE game_id % 2 = 0) OR EXISTS (SELECT 1 FROM a WHERE a.game_id = f.game_id AND a.batch <= f.batch))""")
def stream_published(spark, sf):
    """Games of even number are known from the start; some reports in the stream announce others."""
    ev = event_stream(spark, sf, DAYS).withColumn("is_announcement", F.col("event_type") == "error").filter("event_type = 'view' OR event_type = 'error' AND event_id % 97 = 1")
    out = work_folder(spark, "published")
    run(ev.select("event_id", "game_id", "is_announcement"), jobs.published_in_stream(out, lambda s: roles.published(s, sf).filter("game_id % 2 = 0")), spark)
    return deltas.read_deltas(spark, f"{out}/facts").select("event_id", "game_id")


@plan("stream_recovered", "SELECT game_id, strftime(date_trunc('hour', f), '%Y-%m-%d %H') AS hour, count(*) AS active_devices FROM (SELECT game_id, imei, min(ts) AS f FROM g_actives WHERE imei <> '' GROUP BY ALL) GROUP BY ALL")
def stream_recovered(spark, sf):
    """A stream that fails after it wrote a batch, before that counted as done, and goes on from its checkpoint with more files."""
    path, out, checkpoint = work_folder(spark, "stream"), work_folder(spark, "recovered"), work_folder(spark, "checkpoint")
    add_files(spark, sf, path, ("event_id % 2 = 1", "event_id % 4 = 0"))
    stream = lambda: roles.as_events(logs.stream_folder(spark, path, roles.table(spark, sf, "events").schema, max_files=1)).filter("event_type = 'view' and imei <> ''").select("game_id", "imei", "ts")
    each = jobs.first_seen(out, ["game_id", "imei"], "ts")
    def failing(rows, batch):
        each(rows, batch)
        if batch == 1:
            raise RuntimeError("the machine is lost")
    try:
        jobs.start(stream(), failing, checkpoint).awaitTermination()
    except StreamingQueryException:
        add_files(spark, sf, path, ("event_id % 4 = 2",))
        jobs.start(stream(), each, checkpoint).awaitTermination()
    changes = deltas.read_deltas(spark, f"{out}/changes")
    return changes.groupBy("game_id", F.date_format("hour", "yyyy-MM-dd HH").alias("hour")).agg(F.sum("change").alias("active_devices")).filter("active_devices <> 0")


@plan("stream_replayed_batch", "SELECT game_id, count(*) AS n FROM g_clicks GROUP BY game_id")
def stream_replayed_batch(spark, sf):
    """Every batch is written twice, as after a restart: it must count once."""
    clicks = event_stream(spark, sf).filter("event_type = 'click'").select("game_id")
    out = work_folder(spark, "replay")
    def each(df, batch):
        counts = df.groupBy("game_id").agg(F.count("*").alias("n"))
        deltas.add_batch(counts, out, batch)
        deltas.add_batch(counts, out, batch)
    run(clicks, each, spark)
    return deltas.read_merged(spark, out, ["game_id"], {"n": sink.ADD})
