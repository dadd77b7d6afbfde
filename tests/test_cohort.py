import datetime as dt

from playlens.operators import activity, cohort, payments
from playlens.sources import roles

D = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)


def frames(spark):
    regs = spark.createDataFrame([("a", 1, D(0)), ("a", 1, D(0)), ("a", 2, D(3)), ("b", 1, D(0)), ("c", 1, D(5))], "account string, game_id int, reg_day date")
    logins = spark.createDataFrame([("a", D(0)), ("a", D(1)), ("a", D(1)), ("a", D(29)), ("b", D(1)), ("c", D(4)), ("x", D(1))], "account string, day date")
    return regs, logins


def test_retention_counts_members_once(spark):
    regs, logins = frames(spark)
    got = {(r.game_id, r.reg_day): (r.retained_0, r.retained_1, r.retained_29) for r in cohort.retention(regs, logins, ["account"], ["game_id"], ["account"]).collect()}
    assert got == {(1, D(0)): (1, 2, 1)}  # a on game 2 came back on days that no report shows; c only before registering


def test_value_before_registration_counts_only_when_asked(spark):
    regs = spark.createDataFrame([("a", 1, D(5))], "account string, game_id int, reg_day date")
    orders = spark.createDataFrame([("a", D(4), 10), ("a", D(5), 100), ("a", D(6), 1000), ("a", D(34), 5000), ("a", D(35), 7)], "account string, day date, cents long")
    row = lambda pre: cohort.cohort_value(regs, orders, ["account"], ["game_id"], days=(1, 2, 30), allow_pre_reg=pre, total="t").first()
    assert row(False)[2:] == (100, 1100, 6100, 6117)
    assert row(True)[2:] == (100, 1110, 6110, 6117)


def test_value_never_falls_with_n_when_orders_are_positive(spark, sf):
    orders = roles.game_orders(spark, sf).filter("status = 4")
    got = cohort.cohort_value(roles.regs(spark, sf), orders, ["account"], ["game_id"])
    for r in got.collect():
        values = [r[f"ltv_{n}"] for n in cohort.LTV_DAYS]
        assert values == sorted(values)


def test_retention_is_at_most_the_cohort(spark, sf):
    regs = roles.regs(spark, sf)
    size = {(r.game_id, r.reg_day): r["n"] for r in regs.select("game_id", "reg_day", "account").distinct().groupBy("game_id", "reg_day").count().withColumnRenamed("count", "n").collect()}
    for r in cohort.retention(regs, roles.logins(spark, sf), ["account"], ["game_id"], ["account"]).collect():
        assert all(r[f"retained_{n}"] <= size[(r.game_id, r.reg_day)] for n in cohort.RETENTION_OFFSETS)


def test_result_does_not_depend_on_partitioning(spark, sf):
    run = lambda n: sorted(cohort.retention(roles.regs(spark, sf).repartition(n), roles.logins(spark, sf).repartition(n), ["account"], ["game_id"], ["account"]).collect())
    assert run(1) == run(7)


def test_new_device_is_new_once_per_key(spark):
    t = lambda n, h=0: dt.datetime(2024, 1, 1, h) + dt.timedelta(days=n)
    regs = spark.createDataFrame([("d", 1, "p", t(0), D(0), "a"), ("d", 1, "q", t(1), D(1), "b"), ("", 1, "p", t(0), D(0), "c"), ("0" * 15, 1, "p", t(0), D(0), "d")],
                                 "imei string, game_id int, package string, reg_ts timestamp, reg_day date, account string")
    game = activity.new_device_kpi(regs, ["game_id"], "day").collect()
    assert [(r.day, r.new_devices) for r in game] == [(D(0), 1)]
    assert activity.new_device_kpi(regs, ["game_id", "package"], "day").count() == 2
    assert [(r.day, r.new_accounts) for r in activity.new_account_kpi(regs, ["game_id"]).collect()] == [(D(0), 1)]


def test_pay_histogram_edges(spark):
    regs = spark.createDataFrame([(str(i), 1, D(0)) for i in range(5)], "account string, game_id int, reg_day date")
    orders = spark.createDataFrame([("0", D(0), 99), ("1", D(0), 100), ("2", D(0), 4999), ("2", D(1), 1), ("3", D(0), 3_000_000), ("4", D(0), -50)], "account string, day date, cents long")
    r = payments.pay_amount_hist(orders, regs, ["game_id"]).first()
    assert (r.pay_lt_1, r.pay_1_50, r.pay_50_100, r.pay_30000) == (2, 1, 1, 1)


def test_points_rounding(spark):
    orders = spark.createDataFrame([(1, D(0), 10, 4), (1, D(0), 10_000, 4), (1, D(0), 39_999, 4), (1, D(0), 0, 4), (1, D(0), 99_999, 0)], "member_id int, day date, cents long, status int")
    none = spark.createDataFrame([], "member_id int, day date, points long")
    # 0.01 of 100 yuan is 1; below one counts as one; above is cut
    assert sorted(r.points for r in payments.points(none, orders, 1).collect()) == [0, 1, 1, 3]


def test_sessions_with_overlapping_reports(spark):
    t = lambda m: dt.datetime(2024, 1, 1, 10, m)
    online = spark.createDataFrame([("a", t(0), t(5)), ("a", t(0), t(9)), ("a", t(0), t(7)), ("a", t(20), t(21))], "account string, start_ts timestamp, end_ts timestamp")
    r = activity.online_time(online, ["account"]).first()
    assert (r.online_seconds, r.sessions) == (600, 2)


def test_bounds_of_cohorts_change_no_row_within_them(spark, sf):
    regs, logins, orders = roles.regs(spark, sf), roles.logins(spark, sf), roles.game_orders(spark, sf)
    start, end = D(5), D(9)
    inside = lambda df: sorted(r for r in df.collect() if start <= r.reg_day <= end)
    bounds = {"start": str(start), "end": str(end)}
    by = (["account"], ["game_id"])
    assert inside(cohort.retention(regs, logins, *by, ["account"])) == sorted(cohort.retention(regs, logins, *by, ["account"], **bounds).collect())
    for pre in (False, True):
        assert inside(cohort.cohort_value(regs, orders, *by, allow_pre_reg=pre)) == sorted(cohort.cohort_value(regs, orders, *by, allow_pre_reg=pre, **bounds).collect())
    assert inside(cohort.cohort_value(regs, orders, *by, total="t")) == sorted(cohort.cohort_value(regs, orders, *by, total="t", **bounds).collect())
    assert inside(cohort.payers_by_cohort_day(regs, orders, *by)) == sorted(cohort.payers_by_cohort_day(regs, orders, *by, **bounds).collect())


def test_bounds_reach_the_scan(spark, tmp_path, capsys):
    regs, logins = frames(spark)
    regs.write.parquet(f"{tmp_path}/regs")
    logins.write.parquet(f"{tmp_path}/logins")
    read = lambda name: spark.read.parquet(f"{tmp_path}/{name}")
    cohort.retention(read("regs"), read("logins"), ["account"], ["game_id"], ["account"], offsets=[1, 29], start="2024-01-02", end="2024-01-04").explain("formatted")
    plan = capsys.readouterr().out
    assert "GreaterThanOrEqual(reg_day,2024-01-02), LessThanOrEqual(reg_day,2024-01-04)" in plan
    assert "GreaterThanOrEqual(day,2024-01-02), LessThanOrEqual(day,2024-02-02)" in plan


def test_trailing_users_count_once_a_day(spark):
    rows = [("a", "d1", D(-40)), ("a", "d1", D(-3)), ("a", "d1", D(1)), ("a", "", D(2)), ("b", "d1", D(2)), ("c", "d2", D(99))]
    logins = spark.createDataFrame([(1, *r) for r in rows], "game_id int, account string, imei string, day date")
    got = {(r.day - D(0)).days: (r.mau_accounts, r.mau_devices) for r in activity.trailing_users(logins, ["game_id"], "2024-01-01", "2024-01-06", days=3).collect()}
    want = {}
    for n in range(6):
        near = [r for r in rows if D(n - 3) <= r[2] <= D(n)]
        if near:
            want[n] = len({r[0] for r in near}), len({r[1] for r in near if r[1]})
    assert got == want


def test_bounds_give_the_days_of_the_whole_report_and_reach_the_scan(spark, sf, tmp_path):
    start, end = "2024-01-09", "2024-01-17"
    tables = {}
    for name, day in (("regs", "reg_day"), ("logins", "day"), ("clicks", "day"), ("orders", "day"), ("actives", "day")):
        rows = roles.game_orders(spark, sf).filter("status in (4, 8)") if name == "orders" else getattr(roles, name)(spark, sf)
        rows.withColumn("folder", rows[day]).drop(day).withColumnRenamed("folder", day).repartition(1).write.partitionBy(day).parquet(str(tmp_path / name))
        tables[name] = spark.read.parquet(str(tmp_path / name))
    regs, logins, clicks, orders, actives = (tables[n] for n in ("regs", "logins", "clicks", "orders", "actives"))
    key = ["game_id"]
    reports = {
        "registered_device_kpi": (lambda **b: activity.registered_device_kpi(regs, key, **b), "day"),
        "active_users": (lambda **b: activity.active_users(logins, key, "day", **b), "day"),
        "new_account_kpi": (lambda **b: activity.new_account_kpi(regs, key, **b), "day"),
        "active_and_registered": (lambda **b: activity.active_and_registered(regs, actives, key, **b), "day"),
        "new_login": (lambda **b: activity.new_login(regs, logins, key, **b), "day"),
        "second_login_device": (lambda **b: activity.second_login_device(regs, logins, ["medium"], **b), "day"),
        "login_frequency_hist": (lambda **b: activity.login_frequency_hist(logins, key, **b), "day"),
        "accounts_per_device_hist": (lambda **b: activity.accounts_per_device_hist(regs, key, **b), "day"),
        "age_split": (lambda **b: activity.age_split(logins, regs, key, **b), "day"),
        "click_kpi": (lambda **b: activity.click_kpi(clicks, key, **b), "day"),
        "publish_funnel": (lambda **b: activity.publish_funnel(clicks, actives, regs, orders, key, **b), "day"),
        "publish_funnel_owned": (lambda **b: activity.publish_funnel(clicks, actives, regs, orders, key, owned=True, **b), "day"),
        "pay_kpi": (lambda **b: payments.pay_kpi(orders, key, "day", **b), "day"),
        "new_pay_kpi": (lambda **b: payments.new_pay_kpi(orders, regs, key, **b), "day"),
        "pay_amount_hist": (lambda **b: payments.pay_amount_hist(orders, regs, key, **b), "reg_day"),
    }
    for name, (report, day) in reports.items():
        whole = report().filter(f"{day} between date'{start}' and date'{end}'")
        some = report(start=start, end=end)
        assert sorted(map(repr, some.collect())) == sorted(map(repr, whole.select(*some.columns).collect())), name
        plan = some._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(" in plan and "2024-01-09" in plan, name


def test_first_times_by_loads_equal_those_from_scratch(spark, sf):
    from playlens.operators import bounds
    from playlens.session import work_folder
    regs = roles.regs(spark, sf).filter("imei <> ''").withColumnRenamed("reg_ts", "first_ts")
    keys, shape = ["game_id", "imei"], "game_id int, imei string, first_ts timestamp, event_id long"
    loads = ["reg_day >= date'2024-01-11'", "reg_day < date'2024-01-15'", "event_id % 2 = 0", "event_id % 2 = 0"]
    pieces, scratch = work_folder(spark, "pieces"), work_folder(spark, "scratch")
    for i, load in enumerate(loads):
        bounds.update_firsts(regs.filter(load), pieces, i, keys, ["first_ts", "event_id"])
    bounds.update_firsts(regs, scratch, 0, keys, ["first_ts", "event_id"])
    rows = lambda path, *days: sorted(map(tuple, bounds.firsts_between(spark, path, shape, *days).collect()))
    assert rows(pieces) == rows(scratch) and len(rows(pieces)) == regs.select(*keys).distinct().count()
    week = bounds.firsts_between(spark, pieces, shape, "2024-01-03", "2024-01-05")
    assert sorted(map(tuple, week.collect())) == [r for r in rows(scratch) if dt.date(2024, 1, 3) <= r[-1] <= dt.date(2024, 1, 5)]
    assert {f.split("first_day=")[1][:10] for f in week.inputFiles()} <= {"2024-01-03", "2024-01-04", "2024-01-05"}


def test_owned_money_adds_up_to_the_revenue(spark):
    t = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    regs = spark.createDataFrame([("a", 1, "m", t(1), D(1), 1), ("a", 1, "m", t(1), D(1), 2), ("a", 2, "n", t(5), D(5), 3), ("b", 1, "m", t(2), D(2), 4)],
                                 "account string, game_id int, medium string, reg_ts timestamp, reg_day date, event_id long")
    orders = spark.createDataFrame([("a", t(0), 1, 4), ("a", t(1), 10, 4), ("a", t(4), 100, 4), ("a", t(5), 1000, 4), ("b", t(9), -7, 8), ("x", t(3), 5, 4)],
                                   "account string, order_ts timestamp, cents long, status int")
    got = payments.owned_orders(orders, regs, ["game_id", "medium"])
    assert sorted((r.account, r.cents, r.game_id, r.medium) for r in got.collect()) == [
        ("a", 1, 1, "m"), ("a", 10, 1, "m"), ("a", 100, 1, "m"), ("a", 1000, 2, "n"), ("b", -7, 1, "m"), ("x", 5, None, None)]
