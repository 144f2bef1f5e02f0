import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from estrella.operators import ranking


def _frame(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "k long, v long").repartition(3)


def _plain(df, tiles):
    return df.select(
        "k",
        "v",
        F.rank().over(Window.orderBy(F.desc("v"))).cast("long").alias("rk"),
        F.ntile(tiles).over(Window.orderBy("v", "k")).alias("t"),
    )


def _check(spark, values, tiles=5):
    df = _frame(spark, values)
    got = ranking.rank_and_tile(df, "v", "k", rank_as="rk", tile_as="t", tiles=tiles)
    assert got.columns == ["k", "v", "rk", "t"]
    assert sorted(got.collect()) == sorted(_plain(df, tiles).collect())


def test_ranges_spread_over_partitions(spark):
    df = _frame(spark, [1] * 400)
    placed = ranking._place(df, [F.col("v"), F.col("k")])
    assert placed.select("_part").distinct().count() == 4


@pytest.mark.parametrize("n", [1, 2, 3, 5, 11, 500])
def test_distinct_values(spark, n):
    _check(spark, random.Random(n).sample(range(10 * n), n))


def test_one_value_holds_a_third_of_all_rows(spark):
    rng = random.Random(7)
    _check(spark, [42] * 300 + [rng.randrange(100) for _ in range(600)])


def test_all_values_equal_spread_over_partitions(spark):
    _check(spark, [1] * 200, tiles=3)


def test_fewer_rows_than_tiles(spark):
    _check(spark, [5, 5, 9], tiles=7)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=st.lists(st.integers(-3, 3), min_size=1, max_size=60), tiles=st.integers(1, 9))
def test_equals_plain_window(spark, values, tiles):
    _check(spark, values, tiles)


def test_a_small_input_equals_the_plain_window(spark):
    df = spark.range(10).select(F.col("id").alias("k"), (F.col("id") % 3).alias("v"))
    got = ranking.rank_and_tile(df, "v", "k", rank_as="rk", tile_as="t")
    assert sorted(got.collect()) == sorted(_plain(df, 5).collect())


def test_row_number_is_dense_and_ordered(spark):
    df = _frame(spark, [3, 1, 2, 1, 3, 3, 0] * 20)
    got = ranking.global_row_number(df, ["v", "k"], "n").orderBy("n").collect()
    assert [r.n for r in got] == list(range(1, 141))
    assert [(r.v, r.k) for r in got] == sorted((r.v, r.k) for r in got)


def test_quantiles_match_the_exact_percentile(spark):
    rng = random.Random(3)
    df = _frame(spark, [rng.randrange(50) for _ in range(101)] + [17] * 60).withColumn("g", F.col("k") % 3)
    df = df.withColumn("w", F.when(F.col("g") > 0, F.col("v") * 0.1))
    points = (0.0, 0.1, 0.25, 0.5, 0.75, 1.0)
    places = F.array(*[F.lit(p) for p in points])
    for column in ("v", "w"):
        want = {r.g: r.p for r in df.groupBy("g").agg(F.percentile(column, places).alias("p")).collect() if r.p}
        got = ranking.quantiles(df, ["v", "w"], points, by=["g"]).filter(F.col("campo") == column).collect()
        assert {r.g: r.q for r in got} == {g: pytest.approx(p) for g, p in want.items()}


def test_quantiles_do_not_depend_on_the_partitions(spark):
    df = spark.range(1000).select((F.rand(1) * 1000).alias("v"))
    few = ranking.quantiles(df.coalesce(1), ["v"], (0.25, 0.75)).first().q
    assert ranking.quantiles(df.repartition(7), ["v"], (0.25, 0.75)).first().q == few


def test_quantiles_of_decimals_and_of_nothing(spark):
    df = spark.range(11).selectExpr("cast(id as decimal(10,2)) v")
    assert ranking.quantiles(df, ["v"], (0.25, 0.5)).first().q == [2.5, 5.0]
    assert ranking.quantiles(df.filter("v < 0"), ["v"], (0.5,)).collect() == []


def test_first_per_key_limits_before_the_shuffle(spark, capsys):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, "z")], "k string, o int, p string")
    first = ranking.first_per_key(df, ["k"], ["o"])
    assert sorted(tuple(r) for r in first.collect()) == [("a", 1, "y"), ("b", 5, "z")]
    first.explain()
    plan = capsys.readouterr().out
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_drop_repeats_equals_first_per_key(spark):
    data = [("a", 1, 2), ("a", 1, 1), ("b", 1, 5), (None, 1, 4), (None, 1, 3), (None, None, 0)]
    df = spark.createDataFrame(data, "k string, j int, o int")
    got = ranking.drop_repeats(df, ["k", "j"], ["o"])
    want = ranking.first_per_key(df, ["k", "j"], ["o"])
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert got.count() == 4


def test_drop_repeats_leaves_unique_rows_alone(spark):
    df = spark.range(5)
    assert ranking.drop_repeats(df, ["id"], ["id"]) is df


def test_top_k_and_latest(spark):
    df = spark.createDataFrame([(1, 10, "a"), (2, 30, "b"), (3, 30, "c")], "k int, v int, n string")
    assert [r.k for r in ranking.top_k(df, "v", 2, "k").collect()] == [2, 3]
    assert ranking.latest_by(df.withColumn("g", F.lit(1)), ["g"], "k", ["n"]).first().n == "c"
