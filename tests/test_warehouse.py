from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField

from estrella.operators import calendar, catalog, dims, facts, history, ledger, marts, metrics, upsert


def _set(df):
    return {tuple(r) for r in df.collect()}


def test_calendar_names_and_weeks(spark):
    days = spark.createDataFrame([(date(2021, 1, 2),), (date(2020, 12, 28),)], "fecha date")
    got = {r.sk_tiempo: r for r in calendar.describe_days(days).collect()}
    assert (got[20210102].nombre_dia, got[20210102].es_fin_de_semana, got[20210102].semana_anio) == ("Sábado", True, 53)
    assert (got[20201228].nombre_mes, got[20201228].dia_semana, got[20201228].trimestre) == ("Diciembre", 1, 4)


def test_calendar_range_covers_all_dates(spark):
    df = spark.createDataFrame(
        [(date(2020, 1, 5), date(2020, 1, 9), None), (date(2020, 1, 6), None, date(2020, 1, 3)), (None, date(2019, 1, 1), None)],
        "a date, b date, c date",
    )
    assert [r.dia for r in calendar.calendar_range(df, "a", ["b", "c"]).orderBy("fecha").collect()] == list(range(3, 10))
    assert calendar.calendar_range(df.limit(0), "a").count() == 0


def test_insert_new_first_wins(spark):
    target = spark.createDataFrame([(1, "old")], "k int, v string")
    source = spark.createDataFrame([(1, "x"), (2, "b"), (2, "a")], "k int, v string")
    assert _set(upsert.insert_new(target, source, ["k"], ["v"])) == {(1, "old"), (2, "a")}


def test_upsert_takes_nulls_and_keeps_other_columns(spark):
    target = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "k int, v string, own int")
    source = spark.createDataFrame([(1, None), (3, "c")], "k int, v string")
    once = upsert.upsert(target, source, ["k"], ["v"])
    assert _set(once) == {(1, None, 5), (2, "b", 6), (3, "c", None)}
    assert _set(upsert.upsert(once, source, ["k"], ["v"])) == _set(once)
    whole = upsert.upsert(target.drop("own"), source, ["k"], ["v"])
    assert _set(whole) == {(1, None), (2, "b"), (3, "c")}


def test_small_batch_does_not_shuffle_a_large_target(spark, tmp_path, capsys):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("id k", "id v", "id own").write.parquet(path)
    batch = spark.range(90, 110).selectExpr("id k", "-id v")
    merged = upsert.upsert(spark.read.parquet(path), batch, ["k"], ["v"])
    assert merged.count() == 110 and merged.filter("v < 0 AND own IS NOT NULL").count() == 10
    merged.explain()
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin [k" in plan and "LeftAnti" in plan and "LeftSemi" in plan


def test_surrogate_keys_stay_stable(spark):
    first = dims.load_dim(spark.createDataFrame([("b",), ("a",)], "nk string"), "nk", "sk")
    assert _set(first.select("nk", "sk")) == {("a", 1), ("b", 2)}
    more = spark.createDataFrame([("c",), ("a",), ("0",)], "nk string")
    grown = dims.load_dim(more, "nk", "sk", first)
    assert _set(grown.select("nk", "sk")) == {("a", 1), ("b", 2), ("0", 3), ("c", 4)}
    few = upsert.assign_keys(first, more, "nk", "sk")
    assert _set(few.select("nk", "sk")) == {("a", 1), ("0", 3), ("c", 4)}


def test_hierarchy(spark):
    staged = spark.createDataFrame([(1, None), (2, 1), (3, 9)], "employee_id int, reports_to int")
    dim = dims.load_dim(staged.select(F.col("employee_id").alias("nk")), "nk", "sk")
    linked = dims.resolve_parent(dim, staged, "nk", "employee_id", "reports_to", "sk", "boss")
    assert _set(linked.select("nk", "boss")) == {(1, None), (2, 1), (3, None)}


def test_backfill_only_where_missing(spark):
    df = spark.createDataFrame([(1, "x", None), (2, "x", 9), (3, "y", None)], "id int, c string, fk int")
    lookup = spark.createDataFrame([("x", 7)], "name string, sk int")
    assert _set(upsert.fill_missing(df, lookup, ("c", "name"), "fk", "sk")) == {(1, "x", 7), (2, "x", 9), (3, "y", None)}


def test_ensure_columns(spark):
    df = upsert.ensure_columns(spark.range(1), [StructField("n", StringType()), StructField("id", StringType())])
    assert df.dtypes == [("id", "bigint"), ("n", "string")]


@pytest.fixture
def star(spark):
    dim = lambda data, schema: spark.createDataFrame(data, schema)
    days = calendar.describe_days(dim([(date(2020, 1, 1),), (date(2020, 2, 1),)], "fecha date"))
    products = dim([(1, 10), (2, 20), (3, 30)], "sk_producto long, nk_product_id int")
    customers = dim([(1, "A", 5), (2, "B", None)], "sk_cliente long, nk_customer_id string, sk_pais long")
    orders = dim(
        [(1, "A", date(2020, 1, 1), Decimal("10.00")), (2, "Z", date(2020, 2, 1), None), (3, "A", None, Decimal("1.00"))],
        "order_id int, customer_id string, order_date date, freight decimal(10,2)",
    )
    price = "order_id int, product_id int, unit_price decimal(10,4), quantity int, discount decimal(5,4)"
    lines = dim(
        [(1, 10, "2.5", 3, "0.1"), (1, 20, "1", 1, "0"), (1, 99, "1", 1, "0"), (2, 10, "4", 2, "0.25"), (3, 10, "1", 1, "0")],
        "order_id int, product_id int, unit_price string, quantity int, discount string",
    ).select("order_id", "product_id", F.col("unit_price").cast("decimal(10,4)"), "quantity", F.col("discount").cast("decimal(5,4)"))
    assert price
    keys = lambda required: [
        facts.DimKey(products, "nk_product_id", "sk_producto", "product_id", True),
        facts.DimKey(customers, "nk_customer_id", "sk_cliente", "customer_id", required),
    ]
    return {"days": days, "products": products, "customers": customers, "orders": orders, "lines": lines, "keys": keys}


def test_fact_measures_and_optional_customer(star):
    fact = facts.load_fact(star["lines"], star["orders"], star["keys"](False), star["days"])
    got = {(r.nk_order_id, r.sk_producto): r for r in fact.collect()}
    assert set(got) == {(1, 1), (1, 2), (2, 1)}
    first = got[(1, 1)]
    assert (first.monto_bruto, first.monto_descuento, first.monto_neto) == (Decimal("7.5"), Decimal("0.75"), Decimal("6.75"))
    assert first.flete_prorrateado == Decimal("3.3333") and got[(2, 1)].flete_prorrateado == 0
    assert got[(2, 1)].sk_cliente is None and got[(2, 1)].sk_empleado is None


def test_required_customer_drops_orphans(star):
    fact = facts.load_fact(star["lines"], star["orders"], star["keys"](True))
    assert {r.nk_order_id for r in fact.collect()} == {1}
    row = facts.footprint("f", star["lines"], fact, "FK").first()
    assert (row.registros_leidos, row.registros_insertados, row.registros_rechazados, row.decision) == (5, 2, 3, "CARGADO_PARCIAL")
    assert facts.load_status(facts.footprint("f", star["lines"], fact, "FK")).first().resultado == "WARNING"


def test_null_keys_go_around_the_lookup(spark):
    rows = spark.createDataFrame([(1, "A"), (2, None), (3, "Z"), (4, None)], "id int, k string")
    lookup = spark.createDataFrame([("A", 7)], "k string, sk long")
    for how, want in (("left", {(1, 7), (2, None), (3, None), (4, None)}), ("inner", {(1, 7)})):
        assert _set(facts._looked_up(rows, lookup, "k", how).select("id", "sk")) == want


def test_left_out_lines_are_rejected_with_a_reason(star):
    keys = star["keys"](True)
    fact = facts.load_fact(star["lines"], star["orders"], keys)
    gone = facts.rejected_lines("t", star["lines"], star["orders"], keys).collect()
    assert len(gone) == star["lines"].count() - fact.count() and all(r.motivo_rechazo for r in gone)


def test_a_customer_stays_when_the_calendar_lacks_a_day(spark):
    days = calendar.describe_days(spark.createDataFrame([(date(2020, 2, 1),)], "fecha date"))
    fact = spark.createDataFrame(
        [(1, 10, 20200101, Decimal("5")), (1, 11, 20200201, Decimal("7")), (2, 12, 20200101, Decimal("1"))],
        "sk_cliente long, nk_order_id int, sk_tiempo int, monto_neto decimal(18,4)",
    )
    row = metrics.customer_sums(fact, days).collect()
    assert [(r.sk_cliente, r.total_pedidos, r.total_lineas, r.monto_total_neto, r.primer_pedido) for r in row] == [
        (1, 1, 1, Decimal("7"), date(2020, 2, 1))
    ]
    assert [(r.sk_cliente, r.fecha) for r in history.first_sale(fact, days, "sk_cliente").collect()] == [(1, date(2020, 2, 1))]


def test_an_order_of_two_customers_counts_once_per_country(spark):
    customers = spark.createDataFrame([(1, 5), (2, 5), (3, 6), (4, None)], "sk_cliente long, sk_pais long")
    fact = spark.createDataFrame(
        [(1, 10, Decimal("1")), (2, 10, Decimal("2")), (3, 10, Decimal("4"))], "sk_cliente long, nk_order_id int, monto_neto decimal(18,4)"
    )
    got = {r.sk_pais: (r.total_clientes, r.total_pedidos, r.monto_neto) for r in marts.country_sums(customers, fact).collect()}
    assert got == {5: (2, 1, Decimal("3")), 6: (1, 1, Decimal("4"))}


def test_metrics_with_and_without_idle_keys(star):
    fact = facts.load_fact(star["lines"], star["orders"], star["keys"](False), star["days"])
    everyone = {r.sk_cliente: r for r in metrics.customer_metrics(fact, star["days"], star["customers"]).collect()}
    assert everyone[2].total_lineas == 0 and everyone[2].monto_promedio_pedido is None and everyone[2].dias_como_cliente is None
    assert everyone[1].total_pedidos == 1 and everyone[1].dias_como_cliente == 0
    assert {r.sk_cliente for r in metrics.customer_metrics(fact, star["days"]).collect()} == {1}
    ranks = {r.sk_producto: r.rank_revenue for r in metrics.product_metrics(fact, star["products"]).collect()}
    assert ranks == {1: 1, 2: 2, 3: 3}


def test_marts(spark, star):
    fact = facts.load_fact(star["lines"], star["orders"], star["keys"](False), star["days"])
    period = marts.sales_by_period(fact, star["days"]).orderBy("mes").collect()
    assert [(r.nombre_mes, r.total_pedidos, r.total_clientes, r.total_productos) for r in period] == [("Enero", 1, 1, 2), ("Febrero", 1, 0, 1)]
    countries = spark.createDataFrame([(5, "X"), (6, "Y")], "sk_pais long, country_name string")
    geo = {r.sk_pais: r for r in marts.sales_by_country(countries, star["customers"], fact).collect()}
    assert geo[5].pct_monto_global == 100 and geo[6].total_clientes == 0 and geo[6].pct_monto_global == 0
    nothing = marts.sales_by_country(countries, star["customers"], fact.limit(0)).collect()
    assert {r.pct_monto_global for r in nothing} == {0}
    report = dict(_set(marts.coverage(marts.sales_by_period(fact, star["days"]))))
    assert report["Período desde"] == "2020-01" and report["Revenue neto total (USD)"] == "13.75"


HISTORY = "nk string, sk int, city string, fecha_desde date, fecha_hasta date, es_vigente boolean"


@pytest.fixture
def versions(spark):
    return spark.createDataFrame(
        [
            ("A", 1, "Rome", date(2019, 1, 1), date(2019, 5, 31), False),
            ("A", 1, "Oslo", date(2019, 6, 1), None, True),
            ("B", 2, None, date(2019, 1, 1), None, True),
            ("C", 3, "Lima", date(2021, 1, 1), None, True),
        ],
        HISTORY,
    )


def test_history_merge(spark, versions):
    dim = spark.createDataFrame([("A", 1, "Bonn"), ("B", 2, None), ("C", 3, "Cali"), ("D", 4, "Kyiv")], "nk string, sk int, city string")
    effective = F.lit("2020-03-01").cast("date")
    merged = history.merge_history(versions, dim, "nk", "sk", ["city"], effective)
    got = {(r.nk, r.city): (str(r.fecha_desde), str(r.fecha_hasta), r.es_vigente) for r in merged.collect()}
    assert got[("A", "Rome")] == ("2019-01-01", "2019-05-31", False)
    assert got[("A", "Oslo")] == ("2019-06-01", "2020-02-29", False)
    assert got[("A", "Bonn")] == ("2020-03-01", "None", True)
    assert got[("B", None)][2] and got[("C", "Lima")][2] and ("C", "Cali") not in got
    assert got[("D", "Kyiv")] == ("2020-03-01", "None", True)
    again = history.merge_history(merged, dim, "nk", "sk", ["city"], effective)
    assert _set(again) == _set(merged)
    late = history.merge_conflicts(versions, dim, "nk", ["city"], effective, "h")
    assert [r.clave_registro for r in late.collect()] == ["C"]
    assert history.broken_versions(merged, "nk").count() == 0


def test_versions_at_a_date(spark, versions):
    rows = spark.createDataFrame(
        [(1, "A", date(2018, 1, 1)), (2, "A", date(2019, 5, 31)), (3, "A", date(2025, 1, 1)), (4, "B", date(2019, 1, 1)), (5, "Z", date(2020, 1, 1))],
        "id int, nk string, d date",
    )
    got = history.version_at(rows, versions, "nk", "d", ["city", "sk"])
    assert {r.id: (r.city_vigente, r.sk_vigente) for r in got.collect()} == {
        1: (None, None), 2: ("Rome", 1), 3: ("Oslo", 1), 4: (None, 2), 5: (None, None),
    }


def test_a_hot_key_with_many_versions(spark):
    versions = spark.range(400).select(
        F.lit("A").alias("nk"),
        F.col("id").alias("n"),
        F.date_add(F.lit("2019-01-01").cast("date"), F.col("id").cast("int")).alias("fecha_desde"),
        F.date_add(F.lit("2019-01-01").cast("date"), F.col("id").cast("int")).alias("fecha_hasta"),
    )
    rows = spark.range(2000).select(
        "id", F.lit("A").alias("nk"), F.date_add(F.lit("2018-12-31").cast("date"), (F.col("id") % 500).cast("int")).alias("d")
    )
    got = {r.id: r.n_vigente for r in history.version_at(rows, versions, "nk", "d", ["n"]).collect()}
    assert got == {i: (i % 500 - 1 if 1 <= i % 500 <= 400 else None) for i in range(2000)}


def test_effective_date_of_an_empty_batch(spark):
    empty = spark.createDataFrame([], "d date")
    default = F.lit("2020-01-01").cast("date")
    assert str(spark.range(1).select(history.effective_date(empty, "d", default).alias("e")).first().e) == "2020-01-01"


def test_partitioned_upsert_moves_rows_between_years(spark, tmp_path):
    path = str(tmp_path / "fact")
    schema = "k int, v int, y int"
    spark.createDataFrame([(1, 1, 2019), (2, 2, 2020), (3, 3, 2021)], schema).write.partitionBy("y").parquet(path)
    source = spark.createDataFrame([(1, 10, 2020), (4, 40, 2022)], schema)
    assert upsert.upsert_partitions(path, source, ["k"], ["v"], ["y"]) == [(2019,), (2020,), (2022,)]
    want = {(1, 10, 2020), (2, 2, 2020), (3, 3, 2021), (4, 40, 2022)}
    assert _set(spark.read.parquet(path)) == want
    upsert.upsert_partitions(path, source, ["k"], ["v"], ["y"])
    assert _set(spark.read.parquet(path)) == want


def test_partitioned_upsert_keeps_the_null_partition(spark, tmp_path):
    path = str(tmp_path / "fact")
    schema = "k int, v int, y int"
    spark.createDataFrame([(1, 1, 2000), (2, 2, None), (5, 5, None)], schema).write.partitionBy("y").parquet(path)
    source = spark.createDataFrame([(3, 3, None), (5, 50, 2000)], schema)
    upsert.upsert_partitions(path, source, ["k"], ["v"], ["y"])
    assert _set(spark.read.parquet(path)) == {(1, 1, 2000), (2, 2, None), (3, 3, None), (5, 50, 2000)}
    away = spark.createDataFrame([(2, 2, 2000), (3, 3, 2000)], schema)
    upsert.upsert_partitions(path, away, ["k"], ["v"], ["y"])
    assert _set(spark.read.parquet(path)) == {(1, 1, 2000), (2, 2, 2000), (3, 3, 2000), (5, 50, 2000)}


def test_ledger(spark):
    book = ledger.Ledger(spark)
    with book.run("a", "first", "x") as run:
        run.rows, run.status = 5, "WARNING"
    with pytest.raises(ZeroDivisionError), book.run("b"):
        raise ZeroDivisionError("no")
    with book.run("a"):
        pass
    runs, scripts = ledger.fold_runs(book.event_table()), book.script_table()
    assert [r.resultado for r in runs.orderBy("log_id").collect()] == ["WARNING", "ERROR", "OK"]
    kpis = ledger.run_kpis(runs).first()
    assert (kpis.total_ejecuciones, kpis.ok, kpis.warnings, kpis.errores, kpis.total_registros_proc) == (3, 1, 1, 1, 5)
    report = {r.script_nombre: r for r in ledger.inventory_report(scripts, runs).collect()}
    assert report["a"].veces_ejecutado == 2 and report["a"].ultimo_resultado == "OK"
    assert ledger.latest_run(runs, scripts, "a").first().log_id == 3


def test_running_job_has_no_end(spark):
    events = spark.createDataFrame([(1, 1, 0, None, "EN_PROCESO", None, None)], ledger.EVENT_SCHEMA)
    row = ledger.fold_runs(events).first()
    assert row.fecha_fin is None and row.resultado == "EN_PROCESO"


def test_catalog(spark):
    df = spark.createDataFrame([], "id int, fk int")
    tables = {"t": (df, catalog.TableInfo("dim", ("id",), {"fk": ("p", "id")})), "u": (df, catalog.TableInfo("dqm"))}
    entries = catalog.catalog(spark, tables)
    assert [tuple(r) for r in catalog.catalog_summary(entries).collect()] == [("dqm", "u", 2, 0, 0), ("dim", "t", 2, 1, 1)]
    with pytest.raises(ValueError):
        catalog.catalog(spark, {"t": (df, catalog.TableInfo("nowhere"))})
