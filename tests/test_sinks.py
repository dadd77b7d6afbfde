import datetime as dt

import pytest

from playlens.session import work_folder
from playlens.sinks import deltas, tables

D = lambda n: dt.date(2024, 1, 1 + n)
SHAPE = "day date, k int, v long"


def df(spark, rows, shape=SHAPE):
    return spark.createDataFrame(rows, shape)


def rows(frame):
    return sorted(tuple(r) for r in frame.select(*sorted(frame.columns)).collect())


def test_upsert_leaves_other_partitions_alone(spark):
    path = work_folder(spark, "t")
    tables.upsert(df(spark, [(D(0), 1, 10), (D(1), 1, 20)]), path, ["day", "k"], {"v": tables.ADD}, ["day"])
    before = set(tables.folders(spark, path))
    files = lambda: {f for f in spark.read.parquet(path).inputFiles() if "day=2024-01-01" in f}
    old = files()
    tables.upsert(df(spark, [(D(1), 1, 5), (D(1), 2, 1), (D(2), 1, 7)]), path, ["day", "k"], {"v": tables.ADD}, ["day"])
    assert files() == old and before < set(tables.folders(spark, path))
    assert rows(spark.read.parquet(path)) == [(D(0), 1, 10), (D(1), 1, 25), (D(1), 2, 1), (D(2), 1, 7)]


def test_upsert_needs_partition_in_keys(spark):
    with pytest.raises(ValueError):
        tables.upsert(df(spark, []), "/tmp/none", ["k"], {"v": tables.ADD}, ["day"])


def test_add_if_looks_at_the_stored_date(spark):
    old = df(spark, [(1, D(5), 100)], "k int, d date, v long")
    new = df(spark, [(1, D(4), 7), (1, D(5), 10), (1, D(6), 1), (2, D(1), 3)], "k int, d date, v long")
    got = tables.combined(old, new, ["k"], {"d": tables.GREATEST, "v": tables.add_if("d")})
    assert rows(got) == [(D(1), 2, 3), (D(6), 1, 111)]


def test_replace_orders_new_rows_by_version(spark):
    old, new = df(spark, [(D(0), 1, 1)]), df(spark, [(D(0), 1, 5), (D(0), 1, 3)])
    assert rows(tables.combined(old, new, ["day", "k"], {"v": tables.REPLACE}, version="v")) == [(D(0), 1, 5)]
    assert rows(tables.combined(old, new, ["day", "k"], {"v": tables.KEEP})) == [(D(0), 1, 1)]


def test_replayed_batch_counts_once_and_folding_keeps_sums(spark):
    path = work_folder(spark, "d")
    one = df(spark, [(1, 5), (2, 1)], "k int, v long")
    for batch in (0, 1, 1, 2):
        deltas.add_batch(one, path, batch)
    rules = {"v": tables.ADD}
    assert rows(deltas.read_merged(spark, path, ["k"], rules)) == [(1, 15), (2, 3)]
    deltas.fold(spark, path, ["k"], rules, 1)
    deltas.add_batch(one, path, 1)  # replay of a folded batch
    assert rows(deltas.read_merged(spark, path, ["k"], rules)) == [(1, 15), (2, 3)]
    deltas.add_batch(one, path, 3)
    deltas.fold(spark, path, ["k"], rules, 3)
    assert rows(deltas.read_merged(spark, path, ["k"], rules)) == [(1, 20), (2, 4)]


def test_replaced_range_empties_days(spark):
    path = work_folder(spark, "r")
    tables.overwrite_partitions(df(spark, [(D(n), 1, n) for n in range(4)]), path, ["day"])
    tables.replace_date_range(df(spark, [(D(1), 9, 9), (D(3), 8, 8)]), path, "day", "2024-01-02", "2024-01-03")
    assert rows(spark.read.parquet(path)) == [(D(0), 1, 0), (D(1), 9, 9), (D(3), 1, 3)]


def test_detail_keeps_first_row_of_key(spark):
    path = work_folder(spark, "a")
    shape = "k int, t int, v string"
    tables.append_detail(df(spark, [(1, 5, "late"), (1, 2, "first")], shape), path, ["k"], ["t"])
    tables.append_detail(df(spark, [(1, 1, "earlier but after"), (2, 9, "new")], shape), path, ["k"], ["t"])
    assert rows(spark.read.parquet(path)) == [(1, 2, "first"), (2, 9, "new")]


def test_empty_rerun_clears_the_batch(spark):
    path = work_folder(spark, "e")
    deltas.write_delta(df(spark, [(1, 5)], "k int, v long"), path, 0)
    deltas.write_delta(df(spark, [], "k int, v long"), path, 0)
    assert deltas.read_deltas(spark, path, "k int, v long").count() == 0


def test_version_order_is_that_of_its_type(spark):
    old, new = df(spark, [(D(0), 1, 1)]), df(spark, [(D(0), 1, 9), (D(0), 1, 10)])
    assert rows(tables.combined(old, new, ["day", "k"], {"v": tables.REPLACE}, version="v")) == [(D(0), 1, 10)]


def test_waiting_rows_of_a_rerun_batch(spark):
    from playlens.streaming.jobs import late_dimension

    path = work_folder(spark, "late")
    dims = [df(spark, [], "k int, name string"), df(spark, [(1, "n")], "k int, name string")]
    row, none = df(spark, [(1, 7)], "k int, v int"), df(spark, [], "k int, v int")
    for batch, dim, new in ((0, 0, row), (0, 1, row), (1, 1, none)):
        late_dimension(path, lambda s: dims[dim], "k", "k int, v int")(new, batch)
    assert [(r.k, r.v, r.name) for r in deltas.read_deltas(spark, f"{path}/known").collect()] == [(1, 7, "n")]
