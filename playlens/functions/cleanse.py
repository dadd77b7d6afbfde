"""Column expressions that clean raw log fields. Built-in functions only, so all stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------------------------
DEFAULT_MEDIUM = "21"
NO_ACCOUNT = "no_acc"
PACKAGE_ID_PATTERN = r"^\d{4,5}[MQ]\d{4,7}[a-z]?$"
# device ids that only stand for "no id": all zeros, plain or hashed
EMPTY_DEVICE_PATTERN = r"^[0-]*$"
EMPTY_DEVICE_HASHES = (
    "9F89C84A559F573636A47FF8DAED0D33",
    "CD9E459EA708A948D5C2F5A6CA8838CF",
    "5284047F4FFB4E04824A2FD1D1F0CD62",
)
# networks that send the id of an iOS device already hashed
IOS_HASHED_NETWORKS = (5, 6, 7, 8)
# networks that send the id of an Android device unhashed
ANDROID_RAW_NETWORKS = (17, 18)
ANDROID, IOS = 1, 2
PAID, REFUNDED = 4, 8
DIRECT_RECHARGE = 6
MAX_MEDIUM_LENGTH, MAX_SITE_LENGTH, MAX_PACKAGE_LENGTH = 10, 10, 12
# ------------------------------------------------------------------------------------------------


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def norm_account(col) -> Column:
    """Account names compare without case and outer blanks."""
    return F.lower(F.trim(_c(col)))


def split_channel(col, null_medium: str = DEFAULT_MEDIUM) -> Column:
    """``medium_site_package`` as a struct; fewer than three parts name only the medium."""
    value = _c(col)
    parts = F.split(value, "_", -1)
    whole = F.size(parts) >= 3
    unnamed = value.isNull() | (value == NO_ACCOUNT)
    medium = (
        F.when(unnamed, F.lit(null_medium))
        .when(value == "", F.lit(DEFAULT_MEDIUM))
        .otherwise(F.element_at(parts, 1))
    )
    tail = lambda i: F.when(whole & ~unnamed, F.get(parts, F.lit(i))).otherwise(F.lit(""))
    return F.struct(medium.alias("medium"), tail(1).alias("site"), tail(2).alias("package"))


def channel_fits(medium, site, package) -> Column:
    """Parts longer than the report columns are not a channel (see :func:`quarantine`)."""
    return (
        (F.length(_c(medium)) <= MAX_MEDIUM_LENGTH)
        & (F.length(_c(site)) <= MAX_SITE_LENGTH)
        & (F.length(_c(package)) <= MAX_PACKAGE_LENGTH)
    )


def split_device(col) -> Column:
    """``imei&android_id&mac`` as a struct; a value without ``&`` is one id of at most 36 letters."""
    value = F.coalesce(_c(col), F.lit(""))
    parts = F.split(value, "&", -1)
    joined, n = value.contains("&"), F.size(parts)
    at = lambda i: F.coalesce(F.get(parts, F.lit(i)), F.lit(""))
    imei = F.when(~joined, F.substring(value, 1, 36)).when(n == 3, at(0)).otherwise("")
    android = F.when(joined & (n == 3), at(1)).when(joined & (n == 2), at(0)).otherwise("")
    mac = F.when(joined & (n == 3), at(2)).when(joined & (n == 2), at(1)).otherwise("")
    return F.struct(imei.alias("imei"), android.alias("android_id"), mac.alias("mac"))


def valid_device(col) -> Column:
    value = F.coalesce(F.trim(_c(col)), F.lit(""))
    return ~value.rlike(EMPTY_DEVICE_PATTERN) & ~F.upper(value).isin(*EMPTY_DEVICE_HASHES)


def dash_id(col) -> Column:
    """A 32-letter id in the 8-4-4-4-12 form; others unchanged."""
    value = _c(col)
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    dashed = F.concat_ws("-", *[F.substring(value, a, n) for a, n in cuts])
    return F.when(F.length(value) == 32, dashed).otherwise(value)


def device_hash(col, network=None, os=None) -> Column:
    """The common form of a device id: MD5 in capitals of the dashed (iOS) or plain (Android) id.

    Networks that already send a hash are only put in capitals. Without ``network`` the id is one
    of our own logs: hashed by its length.
    """
    value = F.upper(F.coalesce(_c(col), F.lit("")))
    hashed = F.upper(F.md5(dash_id(value)))
    if network is None:
        return hashed
    network, os = _c(network), _c(os)
    sent_hashed = ((os == IOS) & network.isin(*IOS_HASHED_NETWORKS)) | (
        (os == ANDROID) & ~network.isin(*ANDROID_RAW_NETWORKS)
    )
    raw_android = F.upper(F.md5(F.coalesce(_c(col), F.lit(""))))
    return F.when(sent_hashed, value).when(os == ANDROID, raw_android).otherwise(hashed)


def split_agent(col) -> Column:
    """``iPhone 10.3.3``: device type and system version; both empty unless the text is two words parted by one space."""
    value = F.coalesce(_c(col), F.lit(""))
    pattern = r"^([^ ]*) ([^ ]+) *$"
    return F.struct(F.regexp_extract(value, pattern, 1).alias("dev_type"), F.regexp_extract(value, pattern, 2).alias("sys_version"))


def order_cents(ori, total) -> Column:
    """List price plus total amount, nulls as zero, in cents."""
    zero = F.lit(0).cast("decimal(18,2)")
    as_money = lambda c: F.coalesce(_c(c).cast("decimal(18,2)"), zero)
    return ((as_money(ori) + as_money(total)) * 100).cast("long")


def signed_cents(cents, status) -> Column:
    """Refunds count negative."""
    return F.when(_c(status) == REFUNDED, -_c(cents)).otherwise(_c(cents))


def valid_orders(orders: DataFrame, refunds: bool = True) -> DataFrame:
    """Paid (and refunded) direct recharges with an account, one row per order number and status."""
    wanted = [PAID, REFUNDED] if refunds else [PAID]
    kept = orders.filter(
        F.col("status").isin(*wanted)
        & (F.col("prod_type") == DIRECT_RECHARGE)
        & F.col("account").isNotNull()
        & F.col("order_ts").isNotNull()
    )
    return kept.dropDuplicates(["order_no", "status"]).withColumn("cents", signed_cents("cents", "status"))


def mark_sandbox(orders: DataFrame, receipts: DataFrame) -> DataFrame:
    """Flag orders whose store receipt is a test purchase."""
    tests = receipts.filter((F.col("sandbox") == 1) & (F.col("state") == 3)).select("order_no").distinct()
    return orders.join(tests.withColumn("is_sandbox", F.lit(True)), "order_no", "left").withColumn(
        "is_sandbox", F.coalesce("is_sandbox", F.lit(False))
    )


def drop_sandbox(orders: DataFrame, receipts: DataFrame) -> DataFrame:
    tests = receipts.filter((F.col("sandbox") == 1) & (F.col("state") == 3)).select("order_no").distinct()
    return orders.join(tests, "order_no", "left_anti")


def published_only(facts: DataFrame, published: DataFrame) -> DataFrame:
    return facts.join(published.select("game_id").distinct(), "game_id", "left_semi")


def os_normalise(col, android=("0", "android"), ios=("1", "ios"), other: str = "wp") -> Column:
    """The platform name of a network's platform code; each network has its own codes."""
    value = F.lower(F.trim(_c(col).cast("string")))
    return F.when(value.isin(*android), "android").when(value.isin(*ios), "ios").otherwise(other)


def platform_default(col) -> Column:
    """Report form of a platform: unknown unless iOS or Android."""
    value = F.lower(F.trim(_c(col)))
    return F.when(value.isin("ios", "android"), value).otherwise("UNKNOW")


def epoch_any(col) -> Column:
    """Seconds (10 digits) or milliseconds as a timestamp; null when not a number."""
    text = F.trim(_c(col).cast("string"))
    number = text.try_cast("long")
    return F.when(F.length(text) == 10, F.timestamp_seconds(number)).otherwise(F.timestamp_millis(number))


def is_number(col) -> Column:
    return F.coalesce(_c(col).cast("string").rlike(r"^\d+$"), F.lit(False))


def is_time(col) -> Column:
    return F.coalesce(
        _c(col).rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$")
        & F.try_to_timestamp(_c(col), F.lit("yyyy-MM-dd HH:mm:ss")).isNotNull(),
        F.lit(False),
    )


def quarantine(df: DataFrame, is_valid: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that satisfy the rule, and the others (a null verdict counts as a breach)."""
    verdict = F.coalesce(is_valid, F.lit(False))
    return df.filter(verdict), df.filter(~verdict)


def package_id_parts(col) -> Column:
    """Game id and kind (medium or channel) of a package id; all null when not a package id."""
    value = _c(col)
    valid = value.rlike(PACKAGE_ID_PATTERN)
    game = F.regexp_extract(value, r"^(\d+)", 1).try_cast("int")
    kind = F.when(value.contains("M"), "medium").otherwise("channel")
    return F.struct(
        valid.alias("is_valid"),
        F.when(valid, game).alias("game_id"),
        F.when(valid, kind).alias("kind"),
    )


def time_bucket(col, grain: str) -> Column:
    if grain == "day":
        return F.to_date(_c(col))
    if grain not in ("hour", "month"):
        raise ValueError(f"unknown grain: {grain}")
    return F.date_trunc(grain, _c(col))


def decode_pay_type(col, names: dict[str, str], unknown: str = "unknown", whole_from: int = 6) -> Column:
    """Names of a pay-type code: each letter of a short code, or a long code as one.

    ``names`` is a code table fixed by the payment provider, hence a map literal.
    """
    value = _c(col)
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    name_of = lambda code: F.coalesce(F.element_at(table, code), F.lit(unknown))
    letters = F.filter(F.split(value, ""), lambda x: x != "")
    short = F.array_join(F.transform(letters, name_of), "|")
    return F.when(F.coalesce(F.length(value), F.lit(0)) == 0, F.lit(unknown)).when(
        F.length(value) >= whole_from, name_of(value)
    ).otherwise(short)


def split_promo(col) -> Column:
    """``promo~user``: code of the promoter and of the sub-promoter."""
    value = F.coalesce(_c(col), F.lit(""))
    parts = F.split(value, "~", -1)
    promo = F.when(F.length(value) > 1, F.element_at(parts, 1)).otherwise("")
    user = F.coalesce(F.get(parts, F.lit(1)), F.lit(""))
    return F.struct(promo.alias("promo_code"), user.alias("user_code"))


def zero_ratio(num, den, digits: int = 6) -> Column:
    """``num / den``, zero when there is nothing to divide by."""
    num, den = _c(num), _c(den)
    return F.when(F.coalesce(den, F.lit(0)) == 0, F.lit(0.0)).otherwise(
        F.round(num.cast("double") / den.cast("double"), digits)
    )
