"""Versioned tables and figures kept up to date by changes."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from estrella.operators import deltas
from estrella.session import work_path
from estrella.sources.snapshots import Conflict, Snapshots


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def store(spark):
    return Snapshots(spark, work_path(spark))


def frame(spark, rows, schema="k int, p string, v int"):
    return spark.createDataFrame(rows, schema)


def test_readers_keep_their_version(spark, store):
    assert store.open().number == 0
    store.update(lambda c: c.replace("t", frame(spark, [(1, "a", 1)]), ["p"]))
    old = store.open()
    store.update(lambda c: c.append("t", frame(spark, [(2, "b", 2)])))
    store.update(lambda c: c.replace("t", frame(spark, [(3, None, 3)]), ["p"]))
    assert [_rows(store.open(n).read("t")) for n in (1, 2, 3)] == [[(1, "a", 1)], [(1, "a", 1), (2, "b", 2)], [(3, None, 3)]]
    assert _rows(old.read("t")) == [(1, "a", 1)]


def test_tables_change_together_or_not_at_all(spark, store):
    store.update(lambda c: (c.replace("a", frame(spark, [(1, "x", 1)])), c.replace("b", frame(spark, [(1, "x", 1)]))))
    change = store.begin()
    change.replace("a", frame(spark, [(2, "x", 2)]))
    assert _rows(store.open().read("a")) == [(1, "x", 1)]  # written, not published
    assert _rows(change.now.read("a")) == [(2, "x", 2)]
    change.append("b", frame(spark, [(2, "x", 2)]))
    assert _rows(store.open().read("b")) == [(1, "x", 1)]
    change.publish()
    assert _rows(store.open().read("a")) == [(2, "x", 2)] and store.open().read("b").count() == 2


@pytest.mark.parametrize("step", ["write", "manifest", "rename"])
def test_a_job_that_stops_leaves_the_old_version(spark, store, monkeypatch, step):
    store.update(lambda c: c.replace("t", frame(spark, [(1, "a", 1)]), ["p"]))

    def stop(*args, **kwargs):
        raise KeyboardInterrupt

    change = store.begin()
    if step == "write":
        with monkeypatch.context() as m:
            m.setattr(Snapshots, "_write", stop)
            with pytest.raises(KeyboardInterrupt):
                change.upsert("t", frame(spark, [(1, "b", 9)]), ["k"], ["v"])
    else:
        change.upsert("t", frame(spark, [(1, "b", 9)]), ["k"], ["v"])
        if step == "rename":  # the manifest lies aside, but not under its name
            store._fs.create(store._hadoop.Path(f"{store.root}/manifests/.half")).close()
    assert _rows(store.open().read("t")) == [(1, "a", 1)]
    # and the same job runs again from the start
    store.update(lambda c: c.upsert("t", frame(spark, [(1, "b", 9)]), ["k"], ["v"]))
    assert _rows(store.open().read("t")) == [(1, "b", 9)]
    assert store.vacuum() and _rows(store.open().read("t")) == [(1, "b", 9)]
    assert store.vacuum() == []


def test_two_writers(spark, store):
    store.update(lambda c: c.replace("t", frame(spark, [(1, "a", 1)])))
    one, two = store.begin(), store.begin()
    one.append("t", frame(spark, [(2, "a", 2)]))
    two.append("t", frame(spark, [(3, "a", 3)]))
    one.publish()
    with pytest.raises(Conflict):
        two.publish()
    raced = []

    def work(change):
        if not raced:
            raced.append(store.update(lambda c: c.append("t", frame(spark, [(4, "a", 4)]))))
        change.append("t", frame(spark, [(3, "a", 3)]))

    assert store.update(work) == 4 and raced == [3]
    assert [r[0] for r in _rows(store.open().read("t"))] == [1, 2, 3, 4]


def test_upsert_replaces_touched_folders_only(spark, store):
    rows = [(i, None if i % 5 == 4 else f"p/{i % 5} ü", i) for i in range(50)]
    store.update(lambda c: c.replace("t", frame(spark, rows), ["p"]))
    before = store.open().tables["t"].folders
    batch = [(1, "p/2 ü", -1), (4, "p/9", -4), (100, None, 100)]  # moves, a new folder, the NULL folder
    counts = []
    store.update(lambda c: counts.append(c.upsert("t", frame(spark, batch), ["k"], ["v"])))
    after = store.open().tables["t"].folders
    want = {k: (k, p, v) for k, p, v in rows} | {k: (k, p, v) for k, p, v in batch}
    assert _rows(store.open().read("t")) == sorted(want.values(), key=str)
    assert {v for v in before if before[v] == after.get(v)} == {("p/0 ü",), ("p/3 ü",)}
    assert counts == [4]
    assert _rows(store.open().read("t", lambda v: v[0] is None)) == sorted((r for r in want.values() if r[1] is None), key=str)


def test_an_empty_table_and_an_emptied_folder(spark, store):
    store.update(lambda c: c.replace("t", frame(spark, []), ["p"]))
    assert store.open().read("t").collect() == [] and store.open().read("t").columns == ["k", "p", "v"]
    store.update(lambda c: c.upsert("t", frame(spark, [(1, "a", 1)]), ["k"], ["v"]))
    store.update(lambda c: c.upsert("t", frame(spark, [(1, "b", 2)]), ["k"], ["v"]))
    assert set(store.open().tables["t"].folders) == {("b",)}
    store.update(lambda c: c.drop("t"))
    assert "t" not in store.open()


def _files(store, name):
    paths = [p for some in store.open().tables[name].folders.values() for p in some]
    return {r[0] for p in paths for r in store.spark.read.parquet(p).selectExpr("input_file_name()").distinct().collect()}


@pytest.mark.parametrize("partition", [[], ["p"]])
def test_merge_rewrites_no_file(spark, store, partition):
    rnd = random.Random(7)
    rows = {i: (i, None if i % 4 == 3 else f"p {i % 4}", i) for i in range(1000)}
    store.update(lambda c: c.replace("t", frame(spark, list(rows.values())).repartition(3), partition))
    for turn in range(2):
        batch = {k: (k, rnd.choice(["p 0", "p 9", None]), -k * 10 - turn) for k in rnd.sample(range(1100), 5)}
        old = _files(store, "t")
        store.update(lambda c, batch=batch: c.merge("t", frame(spark, list(batch.values())), ["k"], ["p", "v"]))
        rows |= batch
        assert old <= _files(store, "t")  # every file is still there
        assert _rows(store.open().read("t")) == sorted(rows.values(), key=str)
        pinned = store.open()
    assert store.open().tables["t"].gone
    if partition:  # folders that are read alone
        assert _rows(store.open().read("t", lambda v: v[0] == "p 0")) == sorted((r for r in rows.values() if r[1] == "p 0"), key=str)
    holes = len(store.open().tables["t"].holed)
    counts = []
    store.update(lambda c: counts.append(c.compact("t")))
    table = store.open().tables["t"]
    assert holes and counts[0] and not table.gone and not table.holed
    assert _rows(store.open().read("t")) == _rows(pinned.read("t")) == sorted(rows.values(), key=str)
    store.update(lambda c: c.upsert("t", frame(spark, [(5, "x", 5)]), ["k"], ["p", "v"]))
    rows[5] = (5, "x", 5)
    assert _rows(store.open().read("t")) == sorted(rows.values(), key=str)


def test_upsert_after_merge_and_new_keys_only(spark, store):
    rows = {i: (i, f"p{i % 3}", i) for i in range(30)}
    store.update(lambda c: c.replace("t", frame(spark, list(rows.values())), ["p"]))
    store.update(lambda c: c.merge("t", frame(spark, [(100, "p0", 1)]), ["k"], ["v"]))
    assert not store.open().tables["t"].gone  # nothing went
    store.update(lambda c: c.merge("t", frame(spark, [(0, "p0", -1), (1, "p1", -1)]), ["k"], ["v"]))
    store.update(lambda c: c.upsert("t", frame(spark, [(3, "p0", -3)]), ["k"], ["v"]))
    rows |= {100: (100, "p0", 1), 0: (0, "p0", -1), 1: (1, "p1", -1), 3: (3, "p0", -3)}
    assert _rows(store.open().read("t")) == sorted(rows.values(), key=str)
    assert all("_p0=p1" in p for p in store.open().tables["t"].holed)


FIGURES = deltas.Figures(
    "f", ("g",), {"total": "x"}, {"pedidos": "o", "clientes": "c"}, {"d": ("primero", "ultimo"), "c": ("c_min", "c_max")}, buckets=4
)
SCHEMA = "k int, g string, x decimal(12,2), o int, c int, d date"


def recomputed(df):
    return df.groupBy("g").agg(
        F.count(F.lit(1)).alias("filas"),
        F.coalesce(F.sum("x"), F.lit(0)).cast("decimal(22,2)").alias("total"),
        F.count_distinct("o").alias("pedidos"),
        F.count_distinct("c").alias("clientes"),
        F.min("d").alias("primero"),
        F.max("d").alias("ultimo"),
        F.min("c").alias("c_min"),
        F.max("c").alias("c_max"),
    )


@pytest.mark.parametrize("seed", [1, 2])
def test_figures_equal_a_recompute(spark, store, seed):
    rnd = random.Random(seed)

    def row(k):
        pick = lambda n: rnd.choice([None, *range(n)])
        day = f"2020-01-{rnd.randint(1, 28):02d}" if rnd.random() < 0.9 else None
        return (k, rnd.choice(["a", "b", "c", "hot", "hot", None]), pick(50), pick(6), pick(3), day)

    def made(rows):
        return spark.createDataFrame(list(rows), "k int, g string, x int, o int, c int, d string").selectExpr(
            "k", "g", "CAST(x AS DECIMAL(12,2)) x", "o", "c", "CAST(d AS DATE) d"
        )

    now = {k: row(k) for k in range(60)}
    store.update(lambda c: deltas.start(c, FIGURES, made(now.values())))
    for size in (1, 25, 60):
        batch = {k: row(k) for k in rnd.sample(range(90), size)}
        if size == 60:  # a group that loses all its rows
            now_a = [k for k, r in now.items() if r[1] == "a"]
            batch |= {k: (k, "b", 1, 1, 1, None) for k in now_a}
            batch = {k: r if r[1] != "a" else (*r[:1], "c", *r[2:]) for k, r in batch.items()}
        changes = deltas.upsert_changes(made(now.values()), made(batch.values()), ["k"])
        before = store.open()
        store.update(lambda c, changes=changes: deltas.apply(c, FIGURES, changes))
        touched = {now[k][1] for k in batch if k in now} | {r[1] for r in batch.values()}
        now |= batch
        got = deltas.read(store.open(), FIGURES)
        assert _rows(got) == _rows(recomputed(made(now.values())).select(*got.columns))
        old, new = before.tables["f"].folders, store.open().tables["f"].folders
        same = [v for v in old if old[v] == new.get(v)]
        assert len(touched) >= 4 or same
    store.update(lambda c: deltas.compact(c, FIGURES))
    assert _rows(deltas.read(store.open(), FIGURES)) == _rows(recomputed(made(now.values())).select(*FIGURES.columns()))
    pairs = defaultdict(int)
    for r in now.values():
        pairs[r[1], r[3]] += r[3] is not None
    assert store.open().read("f__o").count() == sum(1 for n in pairs.values() if n)
    # back to nothing
    store.update(lambda c: deltas.apply(c, FIGURES, deltas.signed(made(now.values()), -1)))
    assert deltas.read(store.open(), FIGURES).collect() == []
    with pytest.raises(ValueError):
        store.update(lambda c: deltas.apply(c, FIGURES, deltas.signed(made([now[0]]), -1)))


def test_no_changes(spark, store):
    empty = spark.createDataFrame([], SCHEMA)
    store.update(lambda c: deltas.start(c, FIGURES, empty))
    assert deltas.read(store.open(), FIGURES).collect() == []
    counts = []
    store.update(lambda c: counts.append(deltas.apply(c, FIGURES, deltas.signed(empty, 1))))
    assert counts == [0]
