"""Each shared rule on hand-made rows."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from playlens.functions import cleanse as c


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expr.alias("y")).collect()]


def test_account_is_case_and_blank_free(spark):
    assert column(spark, [" ABC ", "abc", None], c.norm_account("x")) == ["abc", "abc", None]


def test_channel_forms(spark):
    got = column(spark, [None, "", "no_acc", "a", "a_b", "a_b_c", "a_b_c_d"], c.split_channel("x"))
    assert [tuple(r) for r in got] == [("21", "", ""), ("21", "", ""), ("21", "", ""), ("a", "", ""), ("a", "", ""), ("a", "b", "c"), ("a", "b", "c")]


def test_channel_null_medium_is_a_parameter(spark):
    got = column(spark, [None, "no_acc", ""], c.split_channel("x", null_medium="no_acc"))
    assert [r.medium for r in got] == ["no_acc", "no_acc", "21"]


def test_overlong_channel_goes_to_quarantine(spark):
    df = spark.createDataFrame([("m", "s", "p" * 13), ("m", "s", "p" * 12), ("m" * 11, "s", "p"), (None, "s", "p")], "medium string, site string, package string")
    good, bad = c.quarantine(df, c.channel_fits("medium", "site", "package"))
    assert (good.count(), bad.count()) == (1, 3)


def test_device_parts(spark):
    long = "X" * 40
    got = column(spark, ["1&2&3", "2&3", "&&", "ABC", long, None], c.split_device("x"))
    assert [tuple(r) for r in got] == [("1", "2", "3"), ("", "2", "3"), ("", "", ""), ("ABC", "", ""), ("X" * 36, "", ""), ("", "", "")]


def test_empty_devices(spark):
    values = ["0" * 32, "00000000-0000-0000-0000-000000000000", "", None, "000000000000000", "5284047f4ffb4e04824a2fd1d1f0cd62", "A0", "862187030168340"]
    assert column(spark, values, c.valid_device("x")) == [False] * 6 + [True, True]


def test_device_hash_forms(spark):
    ios = "4CB796F3009A4E6C85276ADA2D395151"
    dashed = "4CB796F3-009A-4E6C-8527-6ADA2D395151"
    want = hashlib.md5(dashed.encode()).hexdigest().upper()
    assert column(spark, [ios, ios.lower(), dashed], c.device_hash("x")) == [want] * 3
    md5 = hashlib.md5(b"862187030168340").hexdigest()
    assert column(spark, ["862187030168340"], c.device_hash("x", F.lit(17), F.lit(1))) == [md5.upper()]
    assert column(spark, [md5], c.device_hash("x", F.lit(1), F.lit(1))) == [md5.upper()]
    assert column(spark, ["abc"], c.device_hash("x", F.lit(5), F.lit(2))) == ["ABC"]
    assert column(spark, [dashed], c.device_hash("x", F.lit(3), F.lit(2))) == [want]


def test_orders_status_kind_duplicates_nulls(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [("1", "a", t, 4, 6, "1.00", None), ("1", "a", t, 4, 6, "1.00", None), ("2", "a", t, 8, 6, "2.00", "0.50"), ("3", "a", t, 0, 6, "9.00", None), ("4", "a", t, 4, 1, "9.00", None),
            ("5", None, t, 4, 6, "9.00", None), ("6", "a", None, 4, 6, "9.00", None), ("7", "a", t, 4, 6, None, "3.00")]
    df = spark.createDataFrame(rows, "order_no string, account string, order_ts timestamp, status int, prod_type int, ori string, tot string")
    df = df.withColumn("cents", c.order_cents("ori", "tot"))
    assert sorted((r.order_no, r.cents) for r in c.valid_orders(df).collect()) == [("1", 100), ("2", -250), ("7", 300)]
    assert sorted(r.order_no for r in c.valid_orders(df, refunds=False).collect()) == ["1", "7"]


def test_sandbox_orders(spark):
    o = spark.createDataFrame([(1,), (2,), (3,)], "order_no int")
    r = spark.createDataFrame([(1, 1, 3), (1, 1, 3), (2, 1, 1), (3, 0, 3)], "order_no int, sandbox int, state int")
    assert sorted(x.order_no for x in c.drop_sandbox(o, r).collect()) == [2, 3]
    assert {x.order_no: x.is_sandbox for x in c.mark_sandbox(o, r).collect()} == {1: True, 2: False, 3: False}


def test_epochs(spark):
    got = column(spark, ["1704103200", "1704103200123", "x", ""], c.epoch_any("x"))
    assert got[0] == dt.datetime(2024, 1, 1, 10) and got[1].replace(microsecond=0) == got[0] and got[2:] == [None, None]


def test_guards(spark):
    assert column(spark, ["12", "1a", "", None], c.is_number("x")) == [True, False, False, False]
    assert column(spark, ["2024-01-01 00:00:00", "2024-13-01 00:00:00", "2024-01-01", None], c.is_time("x")) == [True, False, False, False]


def test_package_ids(spark):
    got = column(spark, ["4151M19006", "5235Q12003a", "12M1", "4151X19006", None], c.package_id_parts("x"))
    assert [(r.game_id, r.kind) for r in got] == [(4151, "medium"), (5235, "channel"), (None, None), (None, None), (None, None)]


def test_pay_types(spark):
    names = {"1": "a", "2": "b", "123456": "long"}
    assert column(spark, ["1", "12", "19", "123456", "", None, "999999"], c.decode_pay_type("x", names)) == ["a", "a|b", "a|unknown", "long", "unknown", "unknown", "unknown"]


def test_promo_code(spark):
    got = column(spark, ["p~u", "p~", "p", "pp", "", None], c.split_promo("x"))
    assert [tuple(r) for r in got] == [("p", "u"), ("p", ""), ("", ""), ("pp", ""), ("", ""), ("", "")]


def test_ratio_without_base(spark):
    df = spark.createDataFrame([(1, 2), (1, 0), (1, None)], "a int, b int")
    assert [r[0] for r in df.select(c.zero_ratio("a", "b")).collect()] == [0.5, 0.0, 0.0]


def test_unknown_grain_is_refused():
    with pytest.raises(ValueError):
        c.time_bucket("x", "week")


def test_user_agents_of_two_words(spark):
    from playlens.functions.cleanse import split_agent
    cases = {"iPhone 10.3.3": ("iPhone", "10.3.3"), "a b ": ("a", "b"), " x": ("", "x"), "one": ("", ""), "a b c": ("", ""), "": ("", ""), "a  b": ("", "")}
    rows = spark.createDataFrame([(k,) for k in cases] + [(None,)], "ua string").select("ua", split_agent("ua").alias("a")).collect()
    assert {r.ua: (r.a.dev_type, r.a.sys_version) for r in rows} == {**cases, None: ("", "")}
