"""Raw logs: tagged positional lines, JSON reports, web access lines.

Every parser is a plain projection, so the same function serves ``spark.read`` and ``readStream``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlens.functions.cleanse import device_hash, epoch_any, is_number, package_id_parts, split_agent, split_channel

# --- fixed values: 0-based positions of the fields of each log tag ------------------------------
LAYOUTS: dict[str, dict[str, tuple[int, str]]] = {
    "bi_regi": {
        "account": (3, "string"), "game_id": (4, "int"), "reg_ts": (5, "timestamp"),
        "resource": (6, "int"), "channel_id": (7, "int"), "os": (11, "string"),
        "expand_code": (12, "string"), "expand_channel": (13, "string"),
        "device": (14, "string"), "ip": (15, "string"),
    },
    "bi_login": {
        "account": (3, "string"), "login_ts": (4, "timestamp"), "expand_channel": (6, "string"),
        "device": (7, "string"), "game_id": (8, "int"),
    },
    "bi_active": {
        "game_id": (1, "int"), "channel_id": (2, "int"), "expand_channel": (4, "string"),
        "active_ts": (5, "timestamp"), "ip": (6, "string"), "os": (7, "string"),
        "device": (8, "string"), "sys_version": (10, "string"), "dev_type": (11, "string"),
    },
    "bi_order": {
        "order_no": (2, "string"), "account": (5, "string"), "order_ts": (6, "timestamp"),
        "game_id": (7, "int"), "channel_id": (8, "int"), "ori_price": (10, "decimal(18,2)"),
        "total_amt": (13, "decimal(18,2)"), "rebate": (16, "decimal(18,2)"),
        "promoter_id": (18, "int"), "status": (19, "int"), "prod_type": (22, "int"),
        "device": (24, "string"), "white_list": (26, "string"), "area": (27, "string"),
        "role": (28, "string"),
    },
    "bi_channel": {
        "type": (1, "int"), "expand_channel": (2, "string"), "ip": (3, "string"),
        "click_ts": (4, "timestamp"), "game_id": (5, "int"),
    },
    "bi_pubgame": {"game_id": (1, "int")},
    "bi_accountonline": {
        "account": (1, "string"), "game_key": (2, "string"), "channel_id": (3, "string"),
        "start_ts": (4, "timestamp"), "end_ts": (5, "timestamp"),
    },
    "bi_appdownload": {
        "device_id": (1, "string"), "uid": (2, "string"), "download_ts": (3, "timestamp"),
        "game_id": (4, "int"), "channel_id": (5, "int"),
    },
    "bi_install_app": {
        "device_id": (1, "string"), "pkg_name": (2, "string"), "app_name": (3, "string"),
        "status": (4, "int"), "opera_ts": (5, "timestamp"), "platform": (6, "string"),
    },
}
# a line must carry these to be a record at all
REQUIRED = {
    "bi_regi": ("account", "game_id", "reg_ts"),
    "bi_login": ("account", "login_ts"),
    "bi_active": ("game_id", "active_ts"),
    "bi_order": ("order_no", "account", "order_ts", "status", "prod_type"),
    "bi_channel": ("type", "click_ts", "game_id"),
    "bi_pubgame": ("game_id",),
    "bi_accountonline": ("account", "start_ts", "end_ts"),
    "bi_appdownload": ("device_id", "game_id"),
    "bi_install_app": ("device_id", "pkg_name", "opera_ts"),
}

# one row per ad network: code, tag in the line, adv_id in a shared line, field names, platform codes
_AD_FIELDS = ("code", "tag", "adv_id", "device", "time", "callback", "idea", "level1", "level2", "ip", "ua", "android", "ios")
AD_NETWORKS = [dict(zip(_AD_FIELDS, row)) for row in [
    (1, "bi_adv_momo_click", None, "imei", "ts", "callback", None, None, None, None, None, ("0", "2"), ("1",)),
    (2, "bi_adv_baidu_click", None, "imei", "ts", "callback_url", "aid", "uid", "pid", "ip", "ua", ("2",), ("1",)),
    (3, "bi_adv_jinretoutiao_click", None, "imei", "timestamp", "callback", "cid", None, "adid", None, None, ("0",), ("1",)),
    (4, "bi_adv_aiqiyi_click", None, "udid", "ts", None, None, None, None, "ip", "ua", ("2",), ("1",)),
    (5, "bi_adv_uc_click", None, "imei", "time", "callback", "cid", None, "aid", None, None, ("1",), ("0",)),
    (6, "bi_adv_guangdiantong_click", None, "muid", "click_time", "callback", None, None, None, None, None, ("android",), ("ios",)),
    (7, "bi_adv_medium_click", 7, "imei", "time", "callback", "cid", None, "aid", None, None, ("1",), ("0",)),
    (8, "bi_adv_medium_click", 8, "imei", "ts", "callback", None, None, None, "ip", "ua", ("0",), ("1",)),
    (9, "bi_adv_medium_click", 9, "imei", "ts", "callback", None, None, None, None, None, ("0",), ("1",)),
    (17, "bi_adv_medium_click", 17, "imei", "qt", "callback", None, None, None, None, None, ("android",), ("ios",)),
    (18, "bi_adv_medium_click", 18, "devid", "ts", "callback", None, None, None, "ip", "ua", ("0",), ("1",)),
    (-1, "bi_adv_medium_click", -1, "imei", "ts", None, None, None, None, "ip", "ua", ("0",), ("1",)),
]]
_AD_KEYS = (
    "pkg_id", "os", "app_type", "imei", "udid", "muid", "idfa", "devid", "ts", "timestamp", "time", "click_time",
    "qt", "callback", "callback_url", "aid", "uid", "pid", "cid", "adid", "ip", "ua", "androidid", "androidID",
    "adv_id", "channel_main_id", "channel_name",
)
LANDING_PATTERN = r'GET /Ssxy/loadComplete\?p=([A-Za-z0-9_|]+)&g=(\d+)'
ACCESS_TIME_PATTERN = r"\[(\d{2}/[A-Za-z]{3}/\d{4}:\d{2}:\d{2}:\d{2})"
LANDING_REQUEST = 4
# ------------------------------------------------------------------------------------------------


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text logs as column ``value``; many small files are packed into few tasks by the scan."""
    return spark.read.text(path)


def stream_kafka(spark: SparkSession, servers: str, topics: str, max_per_trigger: int | None = None, fail_on_data_loss: bool = True) -> DataFrame:
    """All tags of the event topics as column ``value`` (needs the Kafka connector on the class path).

    Records that expired before they were read stop the stream, unless told otherwise.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topics)
        .option("failOnDataLoss", "true" if fail_on_data_loss else "false")
    )
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load().select(F.col("value").cast("string").alias("value"))


def stream_folder(spark: SparkSession, path: str, schema: T.StructType, glob: str | None = None, max_files: int | None = None) -> DataFrame:
    """Files of a folder as a stream."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def _typed(field: Column, kind: str) -> Column:
    blank_to_null = F.when(F.trim(field) == "", None).otherwise(F.trim(field))
    if kind == "string":
        return field
    if kind == "timestamp":
        # an all-zero time of the logs means "none"; try_ keeps malformed values as null
        return F.try_to_timestamp(blank_to_null, F.lit("yyyy-MM-dd HH:mm:ss"))
    return blank_to_null.try_cast(kind)


def parse_tagged(lines: DataFrame, tag: str, line: str = "value") -> DataFrame:
    """Lines of one tag as typed columns, with ``is_valid`` and the source line kept for quarantine."""
    layout = LAYOUTS[tag]
    fields = F.split(F.col(line), r"\|", -1)
    tagged = lines.filter(F.substring_index(F.col(line), "|", 1).contains(tag)).select(F.col(line).alias("line"), fields.alias("f"))
    columns = [_typed(F.get("f", F.lit(pos)), kind).alias(name) for name, (pos, kind) in layout.items()]
    parsed = tagged.select("line", *columns)
    complete = F.lit(True)
    for name in REQUIRED[tag]:
        value = F.col(name)
        ok = value.isNotNull() & (F.trim(value) != "") if layout[name][1] == "string" else value.isNotNull()
        complete = complete & ok
    return parsed.withColumn("is_valid", F.coalesce(complete, F.lit(False)))


def read_tagged_log(spark: SparkSession, path: str, tag: str) -> DataFrame:
    return parse_tagged(read_lines(spark, path), tag)


def _json_after(col: Column) -> Column:
    """The JSON object of a line, whatever stands before it."""
    return F.regexp_extract(col, r"(?s)(\{.*)", 1)


def parse_ad_clicks(lines: DataFrame, line: str = "value") -> DataFrame:
    """Click reports of all ad networks in one schema; malformed ones have ``is_valid`` false."""
    value = F.col(line)
    js = lines.filter(value.contains("bi_adv_")).select(value.alias("line"), _json_after(value).alias("js"))
    # json_tuple parses once and tells names apart that differ only by case
    names = [f"j_{i}" for i in range(len(_AD_KEYS))]
    js = js.select("line", F.json_tuple("js", *_AD_KEYS).alias(*names))
    j = {k: F.col(n) for k, n in zip(_AD_KEYS, names)}
    conditions = []
    for n in AD_NETWORKS:
        hit = F.col("line").contains(n["tag"])
        if n["adv_id"] is not None:
            hit = hit & (j["adv_id"].try_cast("int") == n["adv_id"])
        conditions.append((n, F.coalesce(hit, F.lit(False))))

    def choose(of, default):
        out = None
        for n, hit in conditions:
            out = F.when(hit, of(n)) if out is None else out.when(hit, of(n))
        return out.otherwise(default)

    blank = F.lit("")
    named = lambda field: lambda n: F.coalesce(j[n[field]], blank) if n[field] else blank
    raw_os = lambda n: F.lower(F.coalesce(j["app_type"] if n["code"] == 6 else j["os"], blank))

    def platform(n):
        code = raw_os(n)
        if n["code"] == 6:
            return F.when(code.contains("android"), "android").when(code.contains("ios"), "ios").otherwise("wp")
        return F.when(code.isin(*n["android"]), "android").when(code.isin(*n["ios"]), "ios").otherwise("wp")

    def device(n):
        if n["code"] == 17:
            return F.when(raw_os(n) == "ios", j["idfa"]).when(raw_os(n) == "android", j["imei"]).otherwise(blank)
        return j[n["device"]]

    def android_id(n):
        if n["code"] == 3:
            return F.when(platform(n) == "android", F.coalesce(j["androidid"], blank)).otherwise(blank)
        if n["code"] == 17:
            return F.when(platform(n) == "android", F.coalesce(j["androidID"], blank)).otherwise(blank)
        return blank

    is_channel = F.col("network") == -1
    out = js.select(
        "line",
        F.coalesce(j["pkg_id"], blank).alias("pkg_id"),
        choose(platform, blank).alias("os"),
        choose(device, blank).alias("device_id"),
        choose(lambda n: epoch_any(j[n["time"]]), F.lit(None).cast("timestamp")).alias("click_ts"),
        choose(named("callback"), blank).alias("callback"),
        choose(lambda n: F.lit(n["code"]), F.lit(100)).alias("network"),
        choose(named("idea"), blank).alias("idea_id"),
        choose(named("level1"), blank).alias("level1"),
        choose(named("level2"), blank).alias("level2"),
        choose(named("ip"), blank).alias("ip"),
        choose(named("ua"), blank).alias("ua"),
        j["channel_main_id"].alias("_main"),
        j["channel_name"].alias("_name"),
        choose(android_id, blank).alias("android_id"),
    )
    return out.select(
        *[c for c in out.columns if c not in ("_main", "_name", "android_id")],
        F.when(is_channel, F.coalesce(F.col("_main").try_cast("int"), F.lit(0))).otherwise(0).alias("main_channel_id"),
        F.when(is_channel, F.coalesce("_name", blank)).otherwise(blank).alias("channel_name"),
        "android_id",
        ((F.col("network") != 100) & F.col("click_ts").isNotNull() & F.col("device_id").isNotNull() & (F.col("pkg_id") != "")).alias("is_valid"),
    )


def clicks_to_match(parsed: DataFrame) -> DataFrame:
    """Parsed click reports with the fields that ad attribution goes by: game_id, os (1, 2), device, dev_type, sys_version.

    The game is that of the package id; reports with another id are left out. The device is the common hash of what the
    network sent, empty where it sent none.
    """
    package, agent = package_id_parts("pkg_id"), split_agent("ua")
    os = F.when(F.col("os") == "ios", 2).otherwise(1)
    return parsed.filter("is_valid").withColumns({"_p": package, "_a": agent, "os": os}).filter("_p.is_valid").select(
        *[c for c in parsed.columns if c not in ("android_id", "os")], "os", F.col("_p.game_id").alias("game_id"),
        F.when(F.col("device_id") == "", "").otherwise(device_hash("device_id", "network", "os")).alias("device"),
        F.col("_a.dev_type").alias("dev_type"), F.col("_a.sys_version").alias("sys_version"), F.when(F.col("os") == 1, F.col("android_id")).otherwise("").alias("android_id"))


def parse_landing_requests(lines: DataFrame, line: str = "value") -> DataFrame:
    """Landing-page loads of an access log; failed requests (404) are dropped."""
    value = F.col(line)
    hits = lines.filter(~value.contains('HTTP/1.0" 404') & value.rlike(LANDING_PATTERN))
    quoted = F.split(value, '"', -1)
    channel = split_channel(F.regexp_extract(value, LANDING_PATTERN, 1))
    return hits.select(
        channel["medium"].alias("medium"), channel["site"].alias("site"), channel["package"].alias("package"),
        F.regexp_extract(value, LANDING_PATTERN, 2).try_cast("int").alias("game_id"),
        F.try_to_timestamp(F.regexp_extract(value, ACCESS_TIME_PATTERN, 1), F.lit("dd/MMM/yyyy:HH:mm:ss")).alias("click_ts"),
        F.lit(LANDING_REQUEST).alias("type"),
        F.trim(F.element_at(F.split(F.coalesce(F.get(quoted, F.lit(6)), F.lit("")), ","), 1)).alias("ip"),
    )


def parse_money_master(lines: DataFrame, line: str = "value") -> DataFrame:
    """Click and activation reports of a reward network; reports without numeric ids are dropped."""
    schema = "game_id string, pkg_id string, app_id string, ts string, imei string, ip string, adv_name string"
    value = F.col(line)
    reports = lines.filter(value.contains("bi_adv_money_click") | value.contains("bi_adv_money_active"))
    r = reports.select(F.from_json(_json_after(value), schema).alias("r")).select("r.*")
    return r.filter(is_number("game_id") & is_number("app_id")).select(
        F.col("game_id").cast("int").alias("game_id"), "pkg_id", F.col("app_id").cast("int").alias("app_id"),
        F.try_to_timestamp("ts", F.lit("yyyy-MM-dd HH:mm:ss")).alias("ts"), "imei", "ip", "adv_name",
    )


def parse_role_events(lines: DataFrame, line: str = "value") -> DataFrame:
    schema = "roleid string, rolename string, account string, gameid int, serverid string, level int, updatetime string"
    value = F.col(line)
    r = lines.filter(value.contains("BI_ROLE")).select(F.from_json(_json_after(value), schema).alias("r")).select("r.*")
    return r.filter(F.col("roleid").isNotNull()).select(
        F.col("roleid").alias("role_id"), F.col("rolename").alias("role_name"), "account",
        F.col("gameid").alias("game_id"), F.col("serverid").alias("server_id"), "level",
        F.try_to_timestamp("updatetime", F.lit("yyyy-MM-dd HH:mm:ss")).alias("update_ts"),
    )


def explode_error_log(reports: DataFrame, payload: str = "value") -> DataFrame:
    """One row per error of a device report."""
    schema = "imei string, platform string, version string, data array<struct<code:string, message:string, time:string>>"
    r = reports.select(F.from_json(_json_after(F.col(payload)), schema).alias("r")).select("r.*")
    return r.select("imei", "platform", "version", F.explode("data").alias("e")).select(
        "imei", "platform", "version", "e.code", "e.message",
        F.try_to_timestamp("e.time", F.lit("yyyy-MM-dd HH:mm:ss")).alias("error_ts"),
    )
