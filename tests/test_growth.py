"""What is shuffled and written on the way does not outgrow the input."""

from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from estrella.operators import deltas, facts, metrics, sketches
from estrella.session import fit_partitions, shuffle_partitions, work_path
from estrella.sources import snapshots
from estrella.sources.snapshots import Snapshots


def _seen(monkeypatch, module):
    """Columns of the intermediates that a module writes."""
    columns, write = [], module.materialize
    monkeypatch.setattr(module, "materialize", lambda df: columns.append(df.columns) or write(df))
    return columns


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_shuffle_partitions_follow_the_rows(spark):
    before = shuffle_partitions(spark)
    try:
        fit_partitions(spark, 1000)
        assert shuffle_partitions(spark) == before
        fit_partitions(spark, 36_000_000)
        assert shuffle_partitions(spark) == 36
        fit_partitions(spark, 5_000_000)
        assert shuffle_partitions(spark) == 36
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", str(before))


def test_headers_bring_the_fact_only_what_it_takes(spark, monkeypatch):
    seen = _seen(monkeypatch, facts)
    lines = spark.createDataFrame([(1, 7, Decimal(2), 3, Decimal(0))] * 2, "order_id long, product_id long, unit_price decimal(10,4), quantity int, discount decimal(5,4)")
    orders = spark.createDataFrame([(1, 5, date(2020, 1, 2), "x", Decimal(9))], "order_id long, customer_id long, order_date date, note string, freight decimal(12,2)")
    keys = [
        facts.DimKey(spark.createDataFrame([(7, 70)], "nk long, sk_producto long"), "nk", "sk_producto", "product_id", True),
        facts.DimKey(spark.createDataFrame([(5, 50)], "nk long, sk_cliente long"), "nk", "sk_cliente", "customer_id"),
    ]
    fact = facts.load_fact(lines, orders, keys)
    assert seen == [["order_id", "sk_tiempo", "sk_cliente", "flete_prorrateado"]]
    got = fact.select("sk_tiempo", "sk_cliente", "sk_empleado", "sk_producto", "flete_prorrateado", "monto_neto").collect()
    assert [tuple(r) for r in got] == [(20200102, 50, None, 70, Decimal("4.5"), Decimal("6"))] * 2


def test_merge_writes_the_batch_once(spark, monkeypatch):
    store = Snapshots(spark, work_path(spark))
    store.update(lambda c: c.replace("t", spark.range(300).selectExpr("id k", "id v", "id w").repartition(3)))
    batch = spark.range(290, 310).selectExpr("id k", "-id v", "0L w")
    seen = _seen(monkeypatch, snapshots)
    store.update(lambda c: c.merge("t", batch, ["k"], ["v", "w"]))
    assert seen and not any({"k", "v"} & set(columns) for columns in seen)
    want = [(i, i, i) for i in range(290)] + [(i, -i, 0) for i in range(290, 310)]
    assert _rows(store.open().read("t")) == sorted(want, key=str)
    # a merge that keeps a column, onto files with holes; a NULL key is no key
    part = spark.createDataFrame([(5, 1), (295, 2), (400, 3), (None, 4)], "k long, v long")
    for _ in range(2):
        store.update(lambda c: c.merge("t", part.filter("k IS NOT NULL"), ["k"], ["v"]))
    store.update(lambda c: c.merge("t", part.filter("k IS NULL").withColumn("w", F.lit(9).cast("long")), ["k"], ["v", "w"]))
    want = [(k, {5: 1, 295: 2}.get(k, v), w) for k, v, w in want] + [(400, 3, None), (None, 4, 9)]
    assert _rows(store.open().read("t")) == sorted(want, key=str)


def test_changes_are_made_once_for_all_figures(spark, monkeypatch):
    figures = deltas.Figures("f", ("g",), {"total": "x"}, {"pedidos": "o"}, buckets=2)
    rows = spark.createDataFrame([(1, "a", 5, 1), (2, "a", 6, 1), (3, "b", 7, 2)], "k int, g string, x long, o int")
    store = Snapshots(spark, work_path(spark))
    store.update(lambda c: deltas.start(c, figures, rows))
    seen = _seen(monkeypatch, deltas)
    batch = spark.createDataFrame([(2, "b", 1, 3)], rows.schema)
    store.update(lambda c: deltas.apply(c, figures, deltas.upsert_changes(rows, batch, ["k"])))
    assert seen[0] == ["g", "x", "o", deltas.SIGN]
    assert _rows(deltas.read(store.open(), figures)) == [("a", 1, 5, 1), ("b", 2, 8, 2)]


def test_product_sums_shuffle_pairs_without_amounts(spark, capsys):
    rows = [(1, 1, 2, Decimal(5)), (1, 1, 3, Decimal(6)), (1, 2, 1, None), (None, 3, 4, Decimal(1)), (2, None, 1, Decimal(2))]
    fact = spark.createDataFrame(rows, "sk_producto long, nk_order_id long, cantidad int, monto_neto decimal(18,4)")
    sums = metrics.product_sums(fact)
    assert _rows(sums) == sorted([(1, 2, 6, Decimal(11)), (None, 1, 4, Decimal(1)), (2, 0, 1, Decimal(2))], key=str)
    sums.explain()
    keys = [line for line in capsys.readouterr().out.splitlines() if "Exchange hashpartitioning(" in line and "nk_order_id" in line]
    assert keys
    sums.explain(True)
    assert "count(distinct" not in capsys.readouterr().out


def test_sketch_counts_slots_by_number(spark, capsys):
    df = spark.createDataFrame([(1, "x"), (-3, None), (1, "y")], "n int, t string")
    made = sketches.sketch(df, ["n", "t"])
    totals = made.groupBy("campo", "clase").agg(F.count(F.lit(1)), F.sum(F.when(F.col("clase") != "D", F.col("peso"))))
    assert _rows(totals) == [("n", "D", 2, None), ("n", "F", 8, 12), ("n", "Q", 2, 3), ("t", "D", 2, None), ("t", "F", 8, 8)]
    assert made.filter("clase = 'Q' AND casilla < 0").count() == 1 and made.filter("clase = 'D' AND peso < 1").isEmpty()
    assert dict(made.dtypes) == {"campo": "string", "clase": "string", "casilla": "bigint", "peso": "bigint"}
    made.explain()
    assert "HashAggregate(keys=[c#" in capsys.readouterr().out
