"""The whole life of a small warehouse, from CSV files to marts."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from estrella.operators import catalog, ledger
from estrella.plans import reports, retail
from estrella.plans import retail_tables as spec

CUSTOMERS = [
    "ALPHA;Alpha Foods;Ann;Owner;Road 1;Bonn;NULL;1;Germany;1;NULL",
    "BRAVO;Bravo Deli;Bob;Owner;Road 2;Puebla;NULL;2;MX;2;NULL",
    "CHARL;Charlie Co;Cid;Buyer;Road 3;Lima;NULL;3;Peru;3;NULL",
    "DELTA;Delta Ltd;Dee;Buyer;Road 4;Munich;BY;4;Germany;4;NULL",
    "ECHOS;Echo Shop;Eve;Buyer;Road 5;Leon;NULL;5;Mexico;5;NULL",
    "FOXTR;Fox Trot;Fay;Buyer;Road 6;Graz;NULL;6;Austria;6;NULL",
]
EMPLOYEES = [
    "1,Lopez,Mia,Manager,Ms.,1960-01-02 00:00:00.000,1990-01-01 00:00:00.000,S,C,NULL,1,USA,1,1,0xFF,notes,NULL,p",
    "2,Smith,Jon,Seller,Mr.,1970-01-02 00:00:00.000,1992-01-01 00:00:00.000,S,C,NULL,1,USA,1,1,0xFF,notes,1,p",
]
PRODUCTS = [
    "1,Tea,1,1,box,18.00,39,0,10,0",
    "2,Jam,1,2,jar,10.005,17,40,25,0",
    "3,Salt,2,2,bag,2.50,17,40,25,1",
]
ORDERS = [
    "1,ALPHA,2,1996-07-04 00:00:00.000,1996-08-01 00:00:00.000,1996-07-16 00:00:00.000,1,30.00,n,a,c,NULL,1,Germany",
    "2,BRAVO,1,1996-07-05 00:00:00.000,1996-08-02 00:00:00.000,NULL,2,9.99,n,a,c,NULL,1,Mexico",
    "3,ALPHA,2,1997-01-10 00:00:00.000,1997-02-10 00:00:00.000,1997-01-12 00:00:00.000,1,0.00,n,a,c,NULL,1,Germany",
    "4,CHARL,2,1997-03-01 00:00:00.000,1997-04-01 00:00:00.000,1997-03-02 00:00:00.000,9,5.00,n,a,c,NULL,1,Peru",
]
DETAILS = ["1,1,18.00,10,0", "1,2,10.00,5,0.1", "2,3,2.50,4,0", "3,1,18.00,2,0.25", "4,2,10.00,1,0", "4,3,2.50,8,0"]


def _write(folder, name, header, lines):
    path = folder / f"{name}.csv"
    path.write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")
    return str(path)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    first = {
        "categories": _write(folder, "categories", "a,b,c,d", ["1,Drinks,Teas,0xAA", "2,Food,Spreads,0xBB"]),
        "customers": _write(folder, "customers", ";".join("abcdefghijk"), CUSTOMERS),
        "employees": _write(folder, "employees", ",".join("abcdefghijklmnopqr"), EMPLOYEES),
        "employee_territories": _write(folder, "et", "a,b", ["1,01581", "2,01730"]),
        "order_details": _write(folder, "od", "a,b,c,d,e", DETAILS),
        "orders": _write(folder, "orders", ",".join("abcdefghijklmn"), ORDERS),
        "products": _write(folder, "products", ",".join("abcdefghij"), PRODUCTS),
        "regions": _write(folder, "regions", "a,b", ["1,East"]),
        "shippers": _write(folder, "shippers", "a,b,c", ["1,Fast,1", "2,Slow,2"]),
        "suppliers": _write(folder, "suppliers", ",".join("abcdefghijkl"), ["1,Farm,x,x,x,x,NULL,1,Peru,1,NULL,NULL", "2,Mine,x,x,x,x,NULL,1,UK,1,NULL,NULL"]),
        "territories": _write(folder, "territories", "a,b,c", ["01581,West,1", "01730,Bed,1"]),
    }
    row = ['""'] * len(spec.RAW_COLUMNS["world_data"])

    def country(name, capital, gdp, latitude):
        cells = dict(zip(spec.RAW_COLUMNS["world_data"], row, strict=True))
        cells.update(country=f'"{name}"', capital_major_city=f'"{capital}"', gdp=f'"{gdp}"', latitude=f'"{latitude}"', longitude='"10.5"', population='"1,234"')
        return ",".join(cells.values())

    world = [
        country("Germany", "Berlin", "$3,845,630,030,824 ", "51.2"),
        country("Mexico", "M�xico", "$1,258", "23.6"),
        country("Peru", "Lima", "", "-9.2"),
        country("Chad", "N Djamena", "$11", "15.4"),
    ]
    second = {
        "customers": _write(folder, "c2", ",".join("abcdefghijk"), ["ALPHA,Alpha Group,Ann,Owner,Road 1,Bonn,NULL,1,Germany,1,NULL", "GOLFS,Golf Shop,Gus,Owner,R,Lima,NULL,1,Peru,1,NULL"]),
        "orders": _write(folder, "o2", ",".join("abcdefghijklmn"), [
            "5,XXXXX,2,1998-01-01 00:00:00.000,1998-01-29 00:00:00.000,1998-01-09 00:00:00.000,1,8.00,n,a,c,AK,1,USA",
            "6,GOLFS,1,1998-01-02 00:00:00.000,1998-01-30 00:00:00.000,1998-01-07 00:00:00.000,1,7.00,n,a,c,NULL,1,Peru",
            "3,ALPHA,2,1998-01-03 00:00:00.000,1998-02-01 00:00:00.000,1998-01-07 00:00:00.000,1,3.00,n,a,c,NULL,1,Germany",
        ]),
        "order_details": _write(folder, "od2", "a,b,c,d,e", ["5,1,18.00,1,0.15", "5,2,10,1,0", "6,3,3.00,2,0", "3,1,20.00,2,0.5"]),
        "products": _write(folder, "p2", ",".join("abcdefghij"), ["1,Tea,1,1,box,27.00,80,0,25,0"]),
        "customers_score": _write(folder, "s2", "a;b", ["ALPHA;5", "BRAVO;3", "BRAVO;0", "CHARL;1", "ZZZZZ;2"]),
        "world_data": _write(folder, "w2", ",".join(spec.RAW_COLUMNS["world_data"]), world),
    }
    root = str(tmp_path_factory.mktemp("warehouse"))
    house = retail.RetailWarehouse(spark, root, date(2026, 6, 16))
    house.load_first(retail.read_batch(spark, first, 1))
    after_first = {n: house.table(n).collect() for n in ("dwm_cliente", "dwm_producto", "enr_cliente")}
    fact_first = house.fact().collect()
    # a new application continues where the first one stopped
    house = retail.RetailWarehouse(spark, root, date(2026, 6, 20), batch=1)
    house.apply_batch(retail.read_batch(spark, second, 2))
    marts = house.build_marts()
    house.second = second
    return house, after_first, fact_first, marts


def test_first_load(built):
    house, after, fact, _ = built
    assert len(fact) == 6
    line = next(r for r in fact if r.nk_order_id == 1 and r.precio_unitario == Decimal("10"))
    assert line.monto_neto == Decimal("45.0000") and line.flete_prorrateado == Decimal("15.0000")
    order4 = [r for r in fact if r.nk_order_id == 4]
    assert all(r.sk_shipper is None for r in order4)
    starts = {r.nk_customer_id: str(r.fecha_desde) for r in after["dwm_cliente"]}
    assert starts["ALPHA"] == "1996-07-04" and starts["DELTA"] == "2026-06-16"
    assert {r.segmento for r in after["enr_cliente"]} == {"PREMIUM", "REGULAR", "BAJO"}


def test_cleaning_and_typing(built):
    house = built[0]
    customers = {r.nk_customer_id: r for r in house.table("dim_cliente").collect()}
    assert customers["BRAVO"].country == "Mexico" and customers["BRAVO"].region is None
    assert {r.territory_id for r in house.table("tmp_territories").collect()} == {"01581", "01730"}
    first = house.spark.read.parquet(f"{house.root}/tmp_products/batch=1")
    assert {str(r.unit_price) for r in first.collect()} == {"18.0000", "10.0100", "2.5000"}


def test_field_rules_and_references(built):
    house = built[0]
    results = house._dqm("dqm_validacion_campo")
    found = {(r.tabla, r.campo, r.control): (r.resultado, r.cant_errores) for r in results.collect()}
    assert results.filter(F.col("tabla").startswith("txt_") & (F.col("control") != "POST_LIMPIEZA_SIN_MX")).count() == 38
    assert results.filter(F.col("tabla").startswith("txt2_")).count() == 12
    assert results.filter("control = 'INTEGRIDAD_REFERENCIAL'").count() == 11
    assert found[("txt_customers", "country", "VALOR_INCONSISTENTE")] == ("WARNING", 1)
    assert found[("txt_customers", "country", "POST_LIMPIEZA_SIN_MX")] == ("OK", 0)
    assert found[("tmp_orders", "ship_via", "INTEGRIDAD_REFERENCIAL")] == ("ERROR", 1)
    assert found[("txt2_customers_score", "score", "Score entre 1 y 5")] == ("ERROR", 1)


def test_indicators_and_gate(built):
    house = built[0]
    found = house._dqm("dqm_indicador")
    assert found.count() == 21 + 9 + 4
    values = {(r.tabla, r.indicador): r for r in found.collect()}
    assert values[("tmp_orders", "PCT_ORDER_SIN_SHIPPER")].valor_calculado == 25
    assert values[("tmp2_orders", "PCT_FK_CLIENTE_INVALIDA")].valor_calculado == Decimal("66.6667")
    assert [r.indicador for r in house.gate().collect()] == ["PCT_ORDER_SIN_SHIPPER"]


def test_rejects_are_kept_once(built):
    rejects = {(r.tabla_origen, r.clave_registro): r.motivo_rechazo for r in built[0]._dqm("dqm_registro_rechazado").collect()}
    assert rejects[("tmp2_orders", "5")] == "Cliente inexistente en DWA: XXXXX"
    assert rejects[("txt2_customers_score", "BRAVO")].startswith("Score invalido: valor 0")


def test_batch_updates(built):
    house = built[0]
    customers = {r.nk_customer_id: r for r in house.table("dim_cliente").collect()}
    assert customers["ALPHA"].company_name == "Alpha Group" and customers["ALPHA"].sk_cliente == 1
    assert customers["GOLFS"].sk_cliente == 7
    assert (customers["ALPHA"].customer_score_segmento, customers["BRAVO"].customer_score_segmento) == ("ALTO", "MEDIO")
    assert customers["CHARL"].customer_score_segmento == "BAJO" and customers["DELTA"].customer_score is None
    assert customers["FOXTR"].sk_pais is None and customers["DELTA"].sk_pais == customers["ALPHA"].sk_pais
    fact = {(r.nk_order_id, str(r.precio_unitario)): r for r in house.fact().collect()}
    assert len(fact) == 7 and not any(o == 5 for o, _ in fact)
    moved = fact[(3, "20.0000")]
    assert moved.sk_tiempo == 19980103 and moved.anio == 1998 and moved.monto_neto == Decimal("20.0000")
    loads = {r.tabla_destino: r for r in house._dqm("dqm_carga_dwa").orderBy("log_id").collect()}
    last = loads["dwa_fact_ventas"]
    assert (last.registros_leidos, last.registros_insertados, last.decision) == (4, 2, "CARGADO_PARCIAL")


def test_history_after_the_batch(built):
    house = built[0]
    versions = {(r.nk_customer_id, r.company_name): (str(r.fecha_desde), str(r.fecha_hasta), r.es_vigente) for r in house.table("dwm_cliente").collect()}
    assert versions[("ALPHA", "Alpha Foods")] == ("1996-07-04", "1997-12-31", False)
    assert versions[("ALPHA", "Alpha Group")] == ("1998-01-01", "None", True)
    prices = {(r.nk_product_id, str(r.precio_lista)): r.es_vigente for r in house.table("dwm_producto").collect()}
    assert prices[(1, "18.0000")] is False and prices[(1, "27.0000")] is True


def test_marts_and_reports(built):
    house, _, _, marts = built
    counts = {n: df.count() for n, df in marts.items()}
    assert counts == {
        "dp_ventas_por_periodo": 3, "dp_ventas_por_cliente": 7, "dp_ventas_por_producto": 3,
        "dp_ventas_por_empleado": 2, "dp_ventas_geografico": 4,
    }
    geo = {r.country_name: r for r in marts["dp_ventas_geografico"].collect()}
    assert geo["Germany"].gdp == Decimal("3845630030824.00") and geo["Peru"].gdp is None and geo["Chad"].total_clientes == 0
    assert geo["Mexico"].population == 1234
    total = sum(r.pct_monto_global for r in geo.values())
    assert abs(total - 100) < Decimal("0.001")
    assert [r.anio for r in reports.years(marts["dp_ventas_por_periodo"]).collect()] == [1996, 1997, 1998]
    top = reports.top_customers(marts["dp_ventas_por_cliente"], house.fact(), 1998).collect()
    assert {r.company_name for r in top} == {"Alpha Group", "Golf Shop"}
    ranked = reports.employee_ranking(marts["dp_ventas_por_empleado"], house.table("dim_empleado"), house.fact(), 1998).collect()
    assert [(r.nombre_completo, r.rank_empleado) for r in ranked] == [("Jon Smith", 1), ("Mia Lopez", 2)]


def test_country_correction_reaches_the_marts(built):
    house = built[0]
    fixes = house.spark.createDataFrame([("Mexico", "México"), ("Chad", None)], "country_name string, capital_major_city string")
    house.correct_countries(fixes)
    assert {r.capital_major_city for r in house.table("dim_pais").collect()} == {"Berlin", "México", "Lima", "N Djamena"}
    mart = house.table("dp_ventas_por_cliente")
    assert {r.capital_major_city for r in mart.filter("country = 'Mexico'").collect()} == {"México"}
    assert "México" in {r.capital_major_city for r in house.table("dp_ventas_geografico").collect()}


def test_ledger_of_the_whole_life(built):
    house = built[0]
    runs = house.runs()
    states = {r.script_nombre: r.ultimo_resultado for r in ledger.inventory_report(house.scripts(), runs).collect()}
    assert states["validacion_txt"] == "WARNING" and states["integridad_referencial"] == "ERROR"
    assert states["integridad_novedades"] == "WARNING" and states["actualizacion_dwa"] == "WARNING"
    assert states["carga_data_products"] == "OK"
    assert runs.filter("resultado = 'EN_PROCESO'").count() == 0
    assert runs.count() == runs.select("log_id").distinct().count()


def test_catalog_describes_every_table_once(built):
    house = built[0]
    entries = house.publish_catalog()
    first = entries.count()
    assert house.publish_catalog().count() == first
    summary = {r.nombre_tabla: r for r in catalog.catalog_summary(entries).collect()}
    assert set(summary) == set(retail.table_infos())
    assert (summary["fact_ventas"].pks, summary["fact_ventas"].fks) == (2, 5)
    assert summary["dp_ventas_geografico"].columnas == 16 and summary["txt2_world_data"].columnas == 35


def test_the_same_batch_again_changes_nothing(built):
    house = built[0]
    names = ["dim_cliente", "dim_producto", "dim_tiempo", "dwm_cliente", "dwm_producto", "enr_cliente", "enr_producto"]

    def state():
        found = {n: sorted(map(str, house.table(n).select(sorted(house.table(n).columns)).collect())) for n in names}
        found["fact"] = sorted(map(str, house.fact().collect()))
        found["rejects"] = house._dqm("dqm_registro_rechazado").count()
        return found

    before = state()
    house.apply_batch(retail.read_batch(house.spark, house.second, 2))
    assert state() == before
