"""Sketches that add up, the key filter, and a ledger with several writers."""

import math
import random

import pytest
from pyspark.sql import functions as F

from estrella.operators import keyfilter, ledger, sketches
from estrella.session import materialize, work_path
from estrella.sources.atomic import create_once


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def numbers(spark):
    rnd = random.Random(1)
    rows = [(i % 2, rnd.choice([None, rnd.gauss(0, 1000), rnd.expovariate(0.01), 0.0]), f"v{int(rnd.paretovariate(1)) % 500}") for i in range(6000)]
    return materialize(spark.createDataFrame(rows, "run int, x double, t string"))


def test_the_merge_is_the_sketch_of_both(spark, numbers):
    parts = [sketches.sketch(numbers.filter(F.col("run") == r), ["x", "t"]) for r in (0, 1)]
    whole = sketches.sketch(numbers, ["x", "t"])
    assert _rows(sketches.merge(*parts)) == _rows(whole)
    assert _rows(sketches.merge(whole, sketches.sketch(numbers.limit(0), ["x", "t"]))) == _rows(whole)


def test_estimates(spark, numbers):
    made = materialize(sketches.sketch(numbers, ["x", "t"]))
    distinct = {r["campo"]: r["distintos"] for r in sketches.distinct_counts(made).collect()}
    exact = numbers.agg(F.count_distinct("x"), F.count_distinct("t")).first()
    assert abs(distinct["x"] - exact[0]) < 0.06 * exact[0] and abs(distinct["t"] - exact[1]) < 0.06 * exact[1] + 2
    points = [0.0, 0.1, 0.5, 0.9, 1.0]
    found = sketches.quantiles(made, points).collect()
    assert [r["campo"] for r in found] == ["x"]
    values = sorted(r["x"] for r in numbers.filter("x IS NOT NULL").collect())
    for point, got in zip(points, found[0]["q"], strict=True):
        want = values[math.floor(point * (len(values) - 1))]
        assert abs(got - want) <= 0.02 * abs(want)
    counts = {r["t"]: r["count"] for r in numbers.groupBy("t").count().collect()}
    asked = spark.createDataFrame([("t", v) for v in [*counts, "nobody"]], "campo string, valor string")
    veces = {r["valor"]: r["veces"] for r in sketches.frequencies(made, asked).collect()}
    assert all(counts[v] <= veces[v] <= counts[v] + 30 for v in counts) and veces["nobody"] <= 30


def test_drift(spark, numbers):
    before = materialize(sketches.sketch(numbers.filter("run = 0"), ["x"]))
    same = sketches.sketch(numbers.filter("run = 1"), ["x"])
    moved = sketches.sketch(numbers.filter("run = 1").withColumn("x", F.col("x") * 50), ["x"])
    assert sketches.drift(before, before).first()["deriva"] == 0
    assert sketches.drift(before, same).first()["deriva"] < 0.1 < 1 < sketches.drift(before, moved).first()["deriva"]


def test_key_filter(spark):
    blocks = keyfilter.blocks_for(4000)
    old = materialize(spark.range(3000).selectExpr("id AS a", "CASE WHEN id % 100 = 0 THEN NULL ELSE CAST(id % 7 AS STRING) END AS b", "id AS v"))
    parts = [keyfilter.build(old.filter(test), ["a", "b"], blocks) for test in ("a < 1000", "a >= 1000")]
    known = materialize(keyfilter.merge(*parts))
    assert _rows(known) == _rows(keyfilter.build(old, ["a", "b"], blocks))
    whole = old.filter("b IS NOT NULL")
    assert keyfilter.passing_share(whole, known, ["a", "b"], blocks).first()[:] == (2970, 2970)
    others = whole.withColumn("a", F.col("a") + 10**6)
    assert keyfilter.passing_share(others, known, ["a", "b"], blocks).first()["dudosas"] < 0.02 * 2970
    source = spark.createDataFrame(
        [(1, "1", -1), (5000, "x", 2), (5000, "x", 1), (2, "9", 3), (None, "x", 4), (None, "x", 4), (100, None, 5)], "a long, b string, v long"
    )
    fresh, after = keyfilter.insert_new(old, source, ["a", "b"], known, blocks)
    assert _rows(fresh) == sorted([(5000, "x", 1), (2, "9", 3), (None, "x", 4), (None, "x", 4), (100, None, 5)], key=str)
    again, _ = keyfilter.insert_new(old.unionByName(fresh), source, ["a", "b"], after, blocks)
    assert _rows(again) == sorted([(None, "x", 4), (None, "x", 4), (100, None, 5)], key=str)


def test_an_empty_filter(spark):
    none = spark.createDataFrame([], "a long, v long")
    known = keyfilter.build(none, ["a"], 1)
    fresh, after = keyfilter.insert_new(none, spark.createDataFrame([(1, 2)], "a long, v long"), ["a"], known, 1)
    assert _rows(fresh) == [(1, 2)] and after.count() == 1


def test_two_writers_lose_nothing(spark):
    root = work_path(spark)
    one, two = ledger.SharedLedger(spark, root=root), ledger.SharedLedger(spark, root=root)
    assert (one.writer, two.writer) == (0, 1)
    seen = []
    for turn in range(4):
        for book in (one, two):
            with book.run("carga", f"turn {turn}") as run:
                seen.append(run.log_id)
            with pytest.raises(ZeroDivisionError), book.run(f"own {book.writer}") as run:
                seen.append(run.log_id)
                raise ZeroDivisionError
    assert len(set(seen)) == 16
    one.publish()
    runs = {r["log_id"]: r for r in ledger.fold_runs(two.event_table()).collect()}
    assert set(runs) == set(seen)  # both writers' runs
    scripts = {r["script_nombre"]: r for r in two.script_table().collect()}
    assert set(scripts) == {"carga", "own 0", "own 1"} and scripts["carga"]["script_desc"] == "turn 0"
    assert {runs[i]["script_id"] for i in runs} == {r["script_id"] for r in scripts.values()}
    times = [runs[i]["fecha_inicio"] for i in sorted(runs)]
    assert times == sorted(times) or max(abs((a - b).total_seconds()) for a, b in zip(times, sorted(times), strict=True)) < 0.01
    assert ledger.latest_run(ledger.fold_runs(one.event_table()), one.script_table(), "own 1").first().log_id == max(i for i in seen if runs[i]["resultado"] == "ERROR")


def test_a_file_is_made_once(spark):
    path = f"{work_path(spark)}/entry"
    assert create_once(spark, path, "first") and not create_once(spark, path, "second")
    assert spark.read.text(path).first()[0] == "first"
