"""Streams in several batches give what one batch gives."""

import datetime as dt
import random

from pyspark.sql import functions as F

from playlens.operators import attribution
from playlens.session import work_folder
from playlens.sinks import deltas, state
from playlens.sources import logs
from playlens.streaming import jobs

T = lambda h, m=0: dt.datetime(2024, 1, 1, h, m)


def stream_of(spark, batches, shape):
    """One file per batch, read in the order written."""
    import time
    path = work_folder(spark, "in")
    for rows in batches:
        spark.createDataFrame(rows, shape).coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)  # files are taken by the second of their time
    return logs.stream_folder(spark, path, spark.createDataFrame([], shape).schema, max_files=1)


def changes(spark, stream, job):
    out = work_folder(spark, "out")
    jobs.start(stream, job(out), work_folder(spark, "cp")).awaitTermination()
    return deltas.read_deltas(spark, f"{out}/changes").collect()


def test_late_earlier_activation_takes_back_its_hour(spark):
    s = stream_of(spark, [[(1, "x", T(10)), (1, "y", T(10))], [(1, "x", T(8, 30)), (1, "x", T(9))], [(1, "y", T(10, 5)), (1, "y", T(9))]], "game_id int, imei string, ts timestamp")
    rows = changes(spark, s, lambda out: jobs.first_seen(out, ["game_id", "imei"], "ts"))
    assert sorted((r.imei, r.hour.hour, r.change) for r in rows) == [("x", 8, 1), ("x", 10, -1), ("x", 10, 1), ("y", 9, 1), ("y", 10, -1), ("y", 10, 1)]


def test_session_adds_only_what_the_end_moved(spark):
    s = stream_of(spark, [[("a", T(10), T(10, 5))], [("a", T(10), T(10, 3)), ("a", T(10), T(10, 9))], [("a", T(11), T(11, 1))]], "account string, start_ts timestamp, end_ts timestamp")
    rows = changes(spark, s, lambda out: jobs.session_time(out, ["account"]))
    assert sorted((r.start_ts.hour, r.seconds, r.sessions) for r in rows) == [(10, 240, 0), (10, 300, 1), (11, 60, 1)]


def test_waiting_rows_meet_the_dimension_later(spark):
    dims = [[], [("p1", "one")], [("p1", "one"), ("p2", "two")]]
    calls = iter(dims)
    read = lambda s: s.createDataFrame(next(calls), "k string, name string")
    s = stream_of(spark, [[(1, "p1"), (2, "p2")], [(3, "p1")], [(4, "p3")]], "i int, k string")
    out = work_folder(spark, "dim")
    jobs.start(s, jobs.late_dimension(out, read, "k", "i int, k string"), work_folder(spark, "cp")).awaitTermination()
    assert sorted((r.i, r.name) for r in deltas.read_deltas(spark, f"{out}/known").collect()) == [(1, "one"), (2, "two"), (3, "one")]


def test_announced_games_count_from_their_batch_on(spark):
    s = stream_of(spark, [[(1, 7, False), (2, 8, False)], [(0, 8, True), (3, 8, False)], [(4, 8, False), (5, 9, False)]], "i int, game_id int, is_announcement boolean")
    out = work_folder(spark, "pub")
    static = lambda sp: sp.createDataFrame([(7,)], "game_id int")
    jobs.start(s, jobs.published_in_stream(out, static), work_folder(spark, "cp")).awaitTermination()
    assert sorted(r.i for r in deltas.read_deltas(spark, f"{out}/facts").collect()) == [1, 3, 4]


def test_streamed_attribution_matches_a_click_of_a_later_batch_and_uses_it_once(spark):
    shape = "event_id long, ts timestamp, is_click boolean, game_id int, os int, device string, ip string, dev_type string, sys_version string, android_id string"
    row = lambda i, h, click, dev: (i, T(h), click, 1, 2, dev, "", "", "", "")
    s = stream_of(spark, [[row(1, 1, True, "x"), row(2, 2, False, "x"), row(3, 3, False, "y")], [row(4, 1, True, "y"), row(5, 4, False, "x")]], shape)
    out = work_folder(spark, "attr")
    jobs.start(s, jobs.attribution(out), work_folder(spark, "cp")).awaitTermination()
    assert sorted((r.active_id, r.click_id) for r in jobs.read_matches(spark, out).collect()) == [(2, 1), (3, 4)]


SHORT = {2: [["device"], ["ip"]], 1: [["device"], ["android_id"]]}


def events_of_days(seed, n, days):
    rng = random.Random(seed)
    return [(i, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rng.randrange(days * 24 * 60)), rng.random() < 0.6, rng.randint(1, 2), rng.randint(1, 2),
             rng.choice(["", *"ABCDEFGH"]), rng.choice(["", "1.1", "1.2", "1.3"]), "t", "v", rng.choice(["", "a", "b"])) for i in range(n)]


SHAPE = "event_id long, ts timestamp, is_click boolean, game_id int, os int, device string, ip string, dev_type string, sys_version string, android_id string"


def whole(spark, rows, days, chains):
    df = spark.createDataFrame(rows, SHAPE)
    clicks = df.filter("is_click").withColumnsRenamed({"event_id": "click_id", "ts": "click_ts"})
    actives = attribution.first_activations(df.filter("not is_click").withColumnsRenamed({"event_id": "active_id", "ts": "active_ts"}))
    return sorted((r.active_id, r.click_id, r.rule) for r in attribution.attribute_activation(actives, clicks, days, chains).collect())


def test_any_split_into_batches_ends_at_the_batch_result(spark):
    """Late clicks take over activations, late activations replace later ones, and batches reach back beyond the window of the one before."""
    rows = events_of_days(5, 400, 40)
    rng = random.Random(9)
    recent = sorted(rows, key=lambda r: r[1] + dt.timedelta(days=rng.random() * 4))  # mostly in order, up to four days late
    late = [r for r in recent if r[0] % 23 == 0]
    orderly = [r for r in recent if r[0] % 23]
    batches = [orderly[:150], orderly[150:260], orderly[260:330], orderly[330:], late]
    out = work_folder(spark, "split")
    each, seen = jobs.attribution(out, 1, SHORT), []
    for i, batch in enumerate(batches):
        each(spark.createDataFrame(batch, SHAPE), i)
        if i == 2:
            each(spark.createDataFrame(batch, SHAPE), i)  # a batch that runs twice
            jobs.fold_matches(spark, out, 1)
        seen += batch
        assert sorted((r.active_id, r.click_id, r.rule) for r in jobs.read_matches(spark, out).collect()) == whole(spark, seen, 1, SHORT)
    signed = deltas.read_deltas(spark, f"{out}/changes").groupBy("active_id", "click_id", "rule").agg(F.sum("sign").alias("n")).filter("n <> 0").collect()
    assert sorted((r.active_id, r.click_id, r.rule) for r in signed) == whole(spark, rows, 1, SHORT) and {r.n for r in signed} == {1}


def test_a_batch_reads_the_days_of_its_window_only(spark, monkeypatch):
    out = work_folder(spark, "window")
    each = jobs.attribution(out, 1, SHORT)
    rows = sorted(events_of_days(6, 200, 30), key=lambda r: r[1])
    each(spark.createDataFrame(rows[:150], SHAPE), 0)
    read, plain = [], state.read_parts
    def watched(spark, path, schema, part, wanted=None):
        got = plain(spark, path, schema, part, wanted)
        read.extend((path.rsplit("/", 1)[1], f.split(f"{part}=")[1].split("/")[0]) for f in got.inputFiles())
        return got
    monkeypatch.setattr(state, "read_parts", watched)
    batch = [r for r in rows[150:] if r[1] > dt.datetime(2024, 1, 27)]
    each(spark.createDataFrame(batch, SHAPE), 1)
    since = min(r[1] for r in batch).date()  # or a day before, where a device's activation was replaced: none here
    days = {day for table, day in read if table in ("clicks", "actives", "matches")}
    assert days and min(days) >= str(attribution.days_needed(since, 1, SHORT)) == str(since - dt.timedelta(days=2))


def test_state_is_merged_by_touched_parts_and_folded(spark):
    path, shape = work_folder(spark, "state"), "k int, v int"
    step = lambda rows, i: sorted(tuple(r) for r in state.advance(spark.createDataFrame(rows, shape), path, i, ["k"], F.col("v"), "min", F.col("k") % 2).select("k", "old", "new").collect())
    assert step([(1, 5), (1, 7), (2, 3), (None, 1), (4, None)], 0) == [(1, None, 5), (2, None, 3)]
    assert step([(1, 6), (2, 1), (3, 9)], 1) == [(2, 3, 1), (3, None, 9)] == step([(1, 6), (2, 1), (3, 9)], 1)  # the same when it runs again
    state.fold_state(spark, path, ["k"], "min", 1)
    assert step([(1, 4), (2, 2)], 2) == [(1, 5, 4)]
    assert sorted((r.k, r.value) for r in state.read_state(spark, path, ["k"], "min").collect()) == [(1, 4), (2, 1), (3, 9)]


def test_counts_of_days_long_past(spark):
    out = work_folder(spark, "dau")
    each = jobs.distinct_counts(out, ["game", "day"], ["account"], "day", "n")
    day = lambda n: dt.date(2024, 3, 1) - dt.timedelta(days=n)
    for i, rows in enumerate([[("a", 1, day(0)), ("b", 1, day(0))], [("a", 1, day(60)), ("a", 1, day(0))], [("a", 1, day(60)), ("c", 1, day(60))]]):
        each(spark.createDataFrame(rows, "account string, game int, day date"), i)
    got = deltas.read_deltas(spark, f"{out}/deltas").groupBy("day").agg(F.sum("n").alias("n")).collect()
    assert {r.day: r.n for r in got} == {day(0): 2, day(60): 2}


def test_malformed_lines_are_kept_apart(spark):
    lines = ["2024-01-01 00:00:00,1 [INFO] s: bi_regi|r||ABC|12|2024-01-01 10:00:00|8|7||||ios|c|a_b_c|dev|1.1.1.1", "2024-01-01 [INFO] s: bi_regi|r||ABC|x|2024-01-01 10:00:00",
             "2024-01-01 [INFO] s: bi_regi|r", "", "2024-01-01 [INFO] s: bi_login|r||a|0000-00-00 00:00:00"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = logs.parse_tagged(df, "bi_regi")
    assert sorted((r.is_valid, r.game_id) for r in got.collect() if r.is_valid) == [(True, 12)]
    assert got.filter(~F.col("is_valid")).count() == 2
    assert [r.is_valid for r in logs.parse_tagged(df, "bi_login").collect()] == [False]


def test_micro_batches_of_large_tables_are_several_files(spark, sf, monkeypatch):
    from playlens.plans import feeds
    from playlens.sources import roles

    rows = roles.table(spark, sf, "events").count()
    assert feeds.batch_files(spark, sf) == 1
    monkeypatch.setattr(feeds, "FILE_ROWS", rows // 12)
    n = feeds.batch_files(spark, sf)
    assert n >= 4
    seen = {}
    feeds.run(feeds.event_stream(spark, sf), lambda df, batch: seen.update({batch: ([r.event_id for r in df.select("event_id").collect()], len(df.inputFiles()))}), spark)
    assert [{i % 3 for i in ids} for ids, _ in (seen[b] for b in sorted(seen))] == [{1}, {0}, {2}]
    assert sum(len(ids) for ids, _ in seen.values()) == rows


def test_a_part_is_written_by_few_tasks_and_null_keys_change_nothing(spark):
    import os

    rows = spark.createDataFrame([(i % 3, f"k{i % 50}", i) for i in range(400)] + [(1, None, -5), (None, "k1", -6), (2, "k2", None)], "d int, k string, v int").repartition(8)
    path = work_folder(spark, "parts")
    state.write_parts(rows.filter("d IS NOT NULL").withColumnRenamed("d", "part"), path, 0)
    assert {sum(f.endswith(".parquet") for f in os.listdir(f"{path}/part={p}/batch_id=0")) for p in range(3)} == {1}
    moved = state.advance(rows, work_folder(spark, "state"), 0, ["k"], F.col("v"), "min", F.col("d")).collect()
    want = {}
    for i in range(400):
        want.setdefault((i % 3, f"k{i % 50}"), i)
    assert {(r.part, r.k): r.new for r in moved} == want
