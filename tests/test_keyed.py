"""Sliced operators against plain step-by-step versions."""

import datetime as dt
import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from playlens.operators import joins, keyed

T0 = dt.datetime(2024, 1, 1)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def greedy(takers, givers, days):
    """Takers in order of (time, id); each takes the latest free giver of its day or up to ``days`` days before."""
    used, out = set(), set()
    for tid, key, t in sorted(takers, key=lambda x: (x[2], x[0])):
        fits = [(g, gid) for gid, k, g in givers if k == key and gid not in used and g.date() <= t.date() and (t.date() - g.date()).days <= days]
        if fits:
            gid = max(fits)[1]
            used.add(gid)
            out.add((tid, gid))
    return out


def run_match(spark, takers, givers, days, unit="hour"):
    a = spark.createDataFrame(takers, "tid int, k string, t timestamp")
    b = spark.createDataFrame(givers, "gid int, k string, g timestamp")
    return {tuple(r) for r in keyed.match_once(a, b, ["k"], ("t", "tid"), ("g", "gid"), days, unit).collect()}


def test_match_equals_greedy_on_random_data(spark):
    for seed in range(4):
        rnd = random.Random(seed)
        takers = [(i, rnd.choice("abc"), at(rnd.randrange(0, 12 * 1440, 7))) for i in range(60)]
        givers = [(i, rnd.choice("aabd"), at(rnd.randrange(0, 12 * 1440, 7))) for i in range(60)]
        assert run_match(spark, takers, givers, 3) == greedy(takers, givers, 3)


def test_match_with_one_hot_key(spark):
    rnd = random.Random(9)
    takers = [(i, "hot", at(rnd.randrange(0, 4 * 1440))) for i in range(300)]
    givers = [(i, "hot", at(rnd.randrange(0, 4 * 1440))) for i in range(250)]
    got = run_match(spark, takers, givers, 6, "minute")
    assert got == greedy(takers, givers, 6)
    assert len({a for a, _ in got}) == len({b for _, b in got}) == len(got)


def test_match_window_edges(spark):
    takers = [(1, "a", at(7 * 1440)), (2, "b", at(7 * 1440)), (3, "c", at(10))]
    givers = [(1, "a", at(1440 + 5)), (2, "b", at(5)), (3, "c", at(900))]  # 6 days, 7 days, later on the same day
    assert run_match(spark, takers, givers, 6) == {(1, 1), (3, 3)}


def test_two_takers_for_one_giver(spark):
    assert run_match(spark, [(1, "a", at(10)), (2, "a", at(20))], [(7, "a", at(5))], 6) == {(1, 7)}


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 3000)), min_size=1, max_size=25), st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 3000)), min_size=1, max_size=25))
def test_asof_equals_scan(spark, left, right):
    l = [(i, k, at(m)) for i, (k, m) in enumerate(left)]
    r = [(i, k, at(m)) for i, (k, m) in enumerate(right)]
    want = {}
    for i, k, t in l:
        fits = [(u, str(j), j) for j, kk, u in r if kk == k and u <= t]
        if fits:
            want[i] = max(fits, key=lambda x: (x[0], f"{{{x[2]}}}"))[2]
    got = keyed.asof_latest(spark.createDataFrame(l, "lid int, k string, t timestamp"), spark.createDataFrame(r, "rid int, k string, u timestamp"), ["k"], "t", "u", ["rid"], ["rid"])
    assert {x.lid: x.rid for x in got.collect()} == want


def test_sliced_row_number_is_row_number_in_any_order(spark):
    rnd = random.Random(1)
    rows = [(i, "hot" if rnd.random() < 0.8 else "cold", at(rnd.randrange(0, 500))) for i in range(400)]
    want, seen = {}, {}
    for i, k, t in sorted(rows, key=lambda x: (x[1], x[2], x[0])):
        seen[k] = seen.get(k, 0) + 1
        want[i] = seen[k]
    df = spark.createDataFrame(rows, "i int, k string, t timestamp")
    for parts in (1, 7):
        got = keyed.sliced_row_number(df.repartition(parts), ["k"], "t", ["i"], "n", "hour")
        assert {r.i: r.n for r in got.collect()} == want


def test_first_and_last_row(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, None)], "k string, o int, v string")
    assert {tuple(r) for r in keyed.first_row(df, ["k"], ["o"]).collect()} == {("a", 1, "y"), ("b", 5, None)}
    assert {tuple(r) for r in keyed.last_row(df, ["k"], ["o"]).collect()} == {("a", 2, "x"), ("b", 5, None)}


def test_co_usage_equals_pairs_for_any_blocking(spark):
    rnd = random.Random(3)
    rows = {(f"d{rnd.randrange(30)}", rnd.randrange(40)) for _ in range(300)} | {("hot", i) for i in range(40)}
    want = {}
    for d, a in rows:
        for e, b in rows:
            if d == e and a != b:
                want[(a, b)] = want.get((a, b), 0) + 1
    df = spark.createDataFrame(list(rows) * 2, "d string, g int")
    for blocks, chunk in ((1, 1000), (3, 8)):
        got = {(r["item"], r["other"]): r["n"] for r in joins.co_usage(df, "d", "g", blocks, chunk).collect()}
        assert got == want


def test_tiers_below_at_and_above(spark):
    ladder = spark.createDataFrame([(1, 100, 5), (1, 200, 7)], "c int, thr int, rate int")
    facts = spark.createDataFrame([(1, 99), (1, 100), (1, 199), (1, 200), (1, 999), (2, 500)], "c int, amt int")
    got = {(r.c, r.amt): r.rate for r in joins.ladder_rate(facts, ladder, ["c"], "amt", "thr").collect()}
    assert got == {(1, 99): None, (1, 100): 5, (1, 199): 5, (1, 200): 7, (1, 999): 7, (2, 500): None}


def test_validity_ends_are_inside(spark):
    d = lambda x: dt.date(2024, 1, x)
    dim = spark.createDataFrame([("p", d(5), d(9), "old"), ("p", d(10), d(20), "new")], "p string, s date, e date, v string")
    facts = spark.createDataFrame([("p", d(x)) for x in (4, 5, 9, 10, 20, 21)] + [("q", d(5))], "p string, day date")
    got = {(r.p, r.day.day): r.v for r in joins.valid_on(facts, dim, ["p"], "day", [("s", "e")]).collect()}
    assert got == {("p", 4): None, ("p", 5): "old", ("p", 9): "old", ("p", 10): "new", ("p", 20): "new", ("p", 21): None, ("q", 5): None}


def test_epochs_before_at_after_a_change(spark):
    dim = spark.createDataFrame([(1, 9, dt.date(2024, 1, 5), 8, None, None)], "g int, mode int, d2 date, m2 int, d3 date, m3 int")
    spans = joins.epoch_ranges(dim, ["g"], "mode", [("d2", "m2"), ("d3", "m3")], "m").orderBy("from_day").collect()
    assert [(s.from_day, s.to_day, s.m) for s in spans] == [(dt.date(1, 1, 1), dt.date(2024, 1, 5), 9), (dt.date(2024, 1, 5), dt.date(9999, 12, 31), 8)]


def test_top_k_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    got = keyed.top_k(df, ["k"], [F.desc("v")], 2)
    assert got.count() == 6
    assert "WindowGroupLimit" in got._jdf.queryExecution().executedPlan().toString()


def test_asof_ties_by_number(spark):
    t = dt.datetime(2024, 1, 1, 5)
    l = spark.createDataFrame([(1, "k", t)], "lid int, k string, t timestamp")
    r = spark.createDataFrame([(9, "k", t), (10, "k", t)], "rid int, k string, u timestamp")
    assert [x.rid for x in keyed.asof_latest(l, r, ["k"], "t", "u", ["rid"], ["rid"]).collect()] == [10]


def test_last_tier_has_no_end(spark):
    ladder = spark.createDataFrame([("a", 0, 1), ("a", 100, 2)], "grp string, threshold long, rate int")
    facts = spark.createDataFrame([("a", 99), ("a", 100), ("a", 10**15)], "grp string, cents long")
    assert sorted(x.rate for x in joins.ladder_rate(facts, ladder, ["grp"], "cents", "threshold").collect()) == [1, 2, 2]


def co_counts(rows):
    from collections import Counter, defaultdict
    by = defaultdict(set)
    for e, i in rows:
        by[e].add(i)
    return Counter((a, b) for items in by.values() for a in items for b in items if a != b)


def test_best_co_used_items_without_all_pairs(spark, monkeypatch):
    """Exact with ties, in bands and blocks, and far fewer pairs where use is skewed."""
    import random

    from playlens.operators import joins
    rng = random.Random(4)
    weights = [1 / (i + 1) for i in range(300)]
    rows = {(e, i) for e in range(250) for i in rng.choices(range(300), weights, k=25)}
    df = spark.createDataFrame([*rows, *list(rows)[:50]], "e int, i int")
    counts = co_counts(rows)
    want = {}
    for (a, b), n in counts.items():
        want.setdefault(a, []).append((-n, b))
    want = {a: [(b, -n) for n, b in sorted(best)[:3]] for a, best in want.items()}
    formed, plain = [], joins._products
    def counted(*args):
        parts = plain(*args).cache()
        formed.append(parts.groupBy("item", "other").count().count())
        return parts
    monkeypatch.setattr(joins, "_products", counted)
    def best(**how):
        formed.clear()
        got = {}
        for r in sorted(joins.co_usage_top(df, "e", "i", 3, **how).collect(), key=lambda r: r["rank"]):
            got.setdefault(r.item, []).append((r.other, r.n))
        return got
    assert best() == want
    assert best(step=1_000) == want and sum(formed) == len(counts)  # one band
    assert best(step=2, blocks=3, chunk=60) == want and len(formed) > 2 and sum(formed) < 0.8 * len(counts)
    assert joins.co_usage_top(df.limit(0), "e", "i", 3).count() == 0
