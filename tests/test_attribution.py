import datetime as dt

import duckdb
import pandas as pd

from playlens.operators import attribution
from playlens.plans import CHECKS, PLANS
from playlens.plans import attribution as plans
from playlens.sources import roles

T = lambda d, h: dt.datetime(2024, 1, 1 + d, h)
SHAPE = "game_id int, os int, device string, ip string, dev_type string, sys_version string, android_id string"


def run(spark, actives, clicks):
    a = spark.createDataFrame(actives, f"active_id int, active_ts timestamp, {SHAPE}")
    c = spark.createDataFrame(clicks, f"click_id int, click_ts timestamp, {SHAPE}")
    return {tuple(r) for r in attribution.attribute_activation(a, c).collect()}


def test_chain_uses_best_evidence_and_each_side_once(spark):
    actives = [(1, T(6, 10), 1, 2, "D1", "ip1", "t", "v", ""), (2, T(6, 11), 1, 2, "D2", "ip1", "t", "v", ""), (3, T(6, 12), 1, 2, "D3", "ip1", "t2", "v", ""),
               (4, T(6, 13), 1, 1, "A1", "ip1", "t", "v", "and"), (5, T(6, 13), 2, 2, "D1", "ip1", "t", "v", "")]
    clicks = [(1, T(5, 1), 1, 2, "D1", "ip1", "t", "v", ""), (2, T(5, 2), 1, 2, "X", "ip1", "t", "v", ""), (3, T(5, 3), 1, 2, "", "ip1", "", "", ""), (4, T(5, 4), 1, 1, "Z", "ip1", "t", "v", "and")]
    assert run(spark, actives, clicks) == {(1, 1, 1), (2, 2, 2), (3, 3, 4), (4, 4, 2)}


def test_window_of_seven_days(spark):
    a = lambda i, d, dev: (i, T(d, 10), 1, 2, dev, "", "", "", "")
    c = lambda i, d, dev: (i, T(d, 10), 1, 2, dev, "", "", "", "")
    assert run(spark, [a(1, 6, "x"), a(2, 7, "y")], [c(1, 0, "x"), c(2, 0, "y")]) == {(1, 1, 1)}


def test_device_activates_once_per_game(spark):
    rows = [(1, T(0, 1), 1, "x"), (2, T(1, 1), 1, "x"), (3, T(1, 1), 2, "x"), (4, T(1, 1), 1, "0000000"), (5, T(1, 1), 1, "")]
    android = [(6, T(1, 2), 1, "", 1, "A"), (7, T(1, 3), 1, None, 1, "A"), (8, T(1, 2), 1, "", 2, "A"), (9, T(1, 2), 1, "", 1, "")]
    df = spark.createDataFrame([(*r, 1, "") for r in rows] + android, "active_id int, active_ts timestamp, game_id int, device string, os int, android_id string")
    assert sorted(r.active_id for r in attribution.first_activations(df).collect()) == [1, 3, 6]


def test_registration_by_device_then_android_id(spark):
    acts = spark.createDataFrame([(1, T(0, 5), 1, "D", "A"), (2, T(2, 5), 1, "E", "A")], "active_id int, active_ts timestamp, game_id int, device string, android_id string")
    regs = spark.createDataFrame(
        [(1, "u1", T(0, 9), 1, "D", "A"), (2, "u1", T(1, 9), 1, "D", "A"), (3, "u2", T(3, 9), 1, "none", "A"), (4, "u3", T(0, 1), 1, "D", ""), (5, "u4", T(1, 1), 1, "none", "A")],
        "reg_id int, account string, reg_ts timestamp, game_id int, device string, android_id string")
    got = {(r.account, r.active_id, r.rule, r.new_device) for r in attribution.attribute_registration(regs, acts, []).collect()}
    assert got == {("u1", 1, 1, True), ("u2", 2, 2, False), ("u4", 1, 2, False)}


def test_whole_chain_matches_step_by_step_run(spark, sf):
    """All rules over the shared tables against plain Python, rule by rule."""
    from tests.test_keyed import greedy
    a = [r.asDict() for r in plans.ad_actives(spark, sf).collect()]
    c = [r.asDict() for r in plans.ad_clicks(spark, sf).collect()]
    used_a, used_c, want = set(), set(), set()
    for step in range(4):
        found = set()
        for os, chain in attribution.CHAINS.items():
            if step < len(chain):
                key = lambda r: (r["game_id"], *[r[f] for f in chain[step]])
                full = lambda r: r["os"] == os and all(r[f] for f in chain[step])
                found |= greedy([(r["active_id"], key(r), r["active_ts"]) for r in a if full(r) and r["active_id"] not in used_a],
                                [(r["click_id"], key(r), r["click_ts"]) for r in c if full(r) and r["click_id"] not in used_c], 6)
        used_a |= {x for x, _ in found}
        used_c |= {y for _, y in found}
        want |= {(x, y, step + 1) for x, y in found}
    got = {tuple(r) for r in attribution.attribute_activation(plans.ad_actives(spark, sf), plans.ad_clicks(spark, sf)).select("active_id", "click_id", "rule").collect()}
    assert got == want and len(got) > 0


def test_reward_audit_classes(spark):
    D = lambda n: dt.date(2024, 1, 1 + n)
    shape = "game_id int, imei string, day date"
    reports = spark.createDataFrame([(1, "m", D(5)), (1, "m", D(5)), (1, "u", D(5)), (1, "r", D(5)), (1, "b", D(5)), (1, "b", D(3))], shape)
    actives = spark.createDataFrame([(1, "m", D(5)), (1, "r", D(2)), (1, "b", D(1)), (1, "n", D(5)), (1, "o", D(5))], shape)
    regs = spark.createDataFrame([(1, "m", D(5)), (1, "r", D(5)), (1, "r", D(2))], "game_id int, imei string, reg_day date")
    r = {x.day: x for x in attribution.reward_network_audit(reports, actives, regs).collect()}[D(5)]
    assert (r.reported, r.unique_devices, r.matched, r.unmatched, r.repeat_own, r.repeat_both, r.registered, r.new_registered, r["natural"]) == (5, 4, 1, 1, 2, 1, 2, 1, 2)


def events_at(folder, n, kinds):
    """Own rows: users that come back, other kinds of events."""
    rows = [{"event_id": i, "ts": dt.datetime(2024, 1, 1) + dt.timedelta(hours=i * 7 % 239, seconds=i), "user_id": i * 11 % 23, "event_type": kinds[i * 13 % 31 % len(kinds)],
             "value": i / 8, "props": '{"k": %d}' % (i % 37)} for i in range(n)]
    types = {"event_id": "int64", "user_id": "int64", "value": "float64", "props": "str", "event_type": "str", "ts": "datetime64[us]"}
    pd.DataFrame(rows, columns=list(types)).astype(types).to_parquet(f"{folder}/events.parquet")
    return str(folder)


def test_merged_table_parses_events_once(spark, tmp_path, monkeypatch):
    folder, parsed, parse = events_at(tmp_path, 1200, ["view", "click", "signup", "purchase", "error"]), [], roles.as_events
    monkeypatch.setattr(roles, "as_events", lambda ev: parsed.append(1) or parse(ev))
    got = PLANS["merged_ad_kpi_full"](spark, folder).toPandas()
    assert len(parsed) == 1
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet'")
    want = con.sql(CHECKS["merged_ad_kpi_full"]).df()
    rows = lambda df: sorted((tuple(str(v)[:10] if c == "day" else None if pd.isna(v) else v for c, v in r.items()) for r in df[sorted(df.columns)].to_dict("records")), key=repr)
    assert len(want) > 100 and (want.retained_1 != 0).any() and (want.new_pay_cents != 0).any() and rows(got) == rows(want)


def test_merged_table_of_few_kinds(spark, tmp_path):
    (tmp_path / "none").mkdir()
    assert PLANS["merged_ad_kpi_full"](spark, events_at(tmp_path / "none", 60, ["error"])).count() == 0
    got = PLANS["merged_ad_kpi_full"](spark, events_at(tmp_path, 60, ["click"])).selectExpr("sum(requests) AS requests", "sum(actives) AS actives").first()
    assert got.requests > 0 and got.actives == 0
