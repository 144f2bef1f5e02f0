"""The same results as plain SQL over the given tables."""

from __future__ import annotations

CUT = "2000-01-01"
OVERLAP = "1999-07-01"
NO_SALES_DATE = "2000-06-30"
REPORT_YEAR = 1998

# ---- shared table expressions ----------------------------------------------------------------

RAW = {
    "raw_customers": """
        SELECT CAST(c_custkey AS VARCHAR) AS customer_id, ' ' || c_name || '  ' AS company_name,
               CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'NULL' WHEN c_mktsegment = 'FURNITURE' THEN ''
                    ELSE c_mktsegment END AS contact_title,
               CAST(c_nationkey AS VARCHAR) AS country,
               CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS balance,
               CAST(CAST(abs(CAST(c_acctbal AS DECIMAL(12,2))) * 100 AS BIGINT) // 160000 AS VARCHAR) AS score
        FROM customer""",
    "raw_products": """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, p_brand AS supplier_id,
               p_type AS category_id, CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) AS unit_price,
               CASE WHEN p_size <= 40 THEN '0' WHEN p_size <= 47 THEN '1' ELSE '2' END AS discontinued
        FROM part""",
    "raw_orders": """
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
               strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '.000' AS order_date,
               CASE WHEN o_orderstatus = 'F' THEN 'pending'
                    ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '.000' END AS required_date,
               CASE WHEN o_orderstatus = 'P' THEN 'NULL'
                    ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '.000' END AS shipped_date,
               CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '' ELSE o_orderpriority[1] END AS ship_via,
               '$' || format('{:,}', CAST(CAST(o_totalprice AS DECIMAL(12,2)) * 100 AS BIGINT) // 100) || '.' ||
               lpad(CAST(CAST(CAST(o_totalprice AS DECIMAL(12,2)) * 100 AS BIGINT) % 100 AS VARCHAR), 2, '0') AS freight
        FROM orders""",
    "raw_lines": """
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS product_id,
               CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) AS unit_price,
               CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS quantity,
               CAST(CAST(l_discount AS DECIMAL(4,2)) AS VARCHAR) AS discount, l_returnflag AS return_flag
        FROM lineitem""",
}

STAGED = {
    "countries": """
        SELECT n_name AS country_name, 'N' || n_nationkey AS abbreviation, 'Capital of ' || n_name AS capital_major_city,
               r_name AS region, CAST(n_nationkey * 3 - 36 AS DECIMAL(12,8)) AS latitude,
               CASE WHEN r_name <> 'MIDDLE EAST' THEN CAST(n_nationkey * 7 - 84 AS DECIMAL(12,8)) END AS longitude
        FROM nation LEFT JOIN region ON r_regionkey = n_regionkey""",
    "customers": """
        SELECT c_custkey AS nk_customer_id, c_name AS company_name, c_mktsegment AS contact_title,
               'City ' || c_nationkey AS city, r_name AS region, n_name AS country,
               CAST(c_acctbal AS DECIMAL(12,2)) AS balance
        FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey""",
    "sellers": """
        SELECT s_suppkey AS employee_id, split_part(s_name, '#', 1) AS first_name, split_part(s_name, '#', 2) AS last_name,
               'Seller' AS title, n_name AS country, CASE WHEN s_suppkey // 10 > 0 THEN s_suppkey // 10 END AS reports_to
        FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey""",
    "shippers": """
        SELECT DISTINCT CAST(o_orderpriority[1] AS INTEGER) AS nk_shipper_id, substring(o_orderpriority, 3) AS company_name
        FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED'""",
    "products": """
        SELECT p_partkey AS product_id, p_name AS product_name, CAST(p_retailprice AS DECIMAL(10,4)) AS unit_price,
               p_type AS category_id, p_brand AS supplier_id, CASE WHEN p_size > 45 THEN 1 ELSE 0 END AS discontinued
        FROM part""",
    "ords": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
               CAST(o_orderdate AS DATE) + 28 AS required_date,
               CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) + 7 END AS shipped_date,
               CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN CAST(o_orderpriority[1] AS INTEGER) END AS ship_via,
               CAST(o_totalprice AS DECIMAL(12,2)) AS freight
        FROM orders""",
    "all_lines": """
        SELECT l_orderkey AS order_id, l_partkey AS product_id, l_suppkey AS employee_id,
               CAST(l_extendedprice AS DECIMAL(10,4)) AS unit_price, CAST(l_quantity AS INTEGER) AS quantity,
               CAST(l_discount AS DECIMAL(5,4)) AS discount, l_linenumber AS line_number,
               l_returnflag AS return_flag, l_linestatus AS line_status, CAST(l_shipdate AS DATE) AS ship_date
        FROM lineitem""",
    "lines": """
        SELECT * FROM all_lines
        QUALIFY row_number() OVER (PARTITION BY order_id, product_id
            ORDER BY employee_id, unit_price, quantity, discount, line_number, return_flag, line_status, ship_date) = 1""",
}


def _days(source: str) -> str:
    return f"""
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS sk_tiempo, d AS fecha, year(d) AS anio, quarter(d) AS trimestre,
               month(d) AS mes,
               ['Enero','Febrero','Marzo','Abril','Mayo','Junio','Julio','Agosto','Septiembre','Octubre',
                'Noviembre','Diciembre'][month(d)] AS nombre_mes,
               week(d) AS semana_anio, day(d) AS dia, isodow(d) AS dia_semana,
               ['Lunes','Martes','Miércoles','Jueves','Viernes','Sábado','Domingo'][isodow(d)] AS nombre_dia,
               CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS es_fin_de_semana
        FROM ({source})"""


ALL_DAYS = """SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d
    FROM (SELECT min(least(order_date, coalesce(required_date, order_date), coalesce(shipped_date, order_date))) AS lo,
                 max(greatest(order_date, coalesce(required_date, order_date), coalesce(shipped_date, order_date))) AS hi
          FROM ords)"""

FACT_SELECT = """
    SELECT CAST(strftime(o.order_date, '%Y%m%d') AS INTEGER) AS sk_tiempo, c.sk_cliente, e.sk_empleado, p.sk_producto,
           s.sk_shipper, l.order_id AS nk_order_id, l.quantity AS cantidad, l.unit_price AS precio_unitario,
           l.discount AS descuento,
           CAST((2 * CAST(o.freight * 10000 AS BIGINT) + n.n) // (2 * n.n) AS DECIMAL(18,0))
               * CAST(0.0001 AS DECIMAL(5,4)) AS flete_prorrateado,
           CAST(l.quantity * l.unit_price AS DECIMAL(18,4)) AS monto_bruto,
           CAST(l.quantity * l.unit_price * l.discount AS DECIMAL(18,4)) AS monto_descuento,
           CAST(l.quantity * l.unit_price * (1 - l.discount) AS DECIMAL(18,4)) AS monto_neto
    FROM {lines} l JOIN {orders} o USING (order_id)
    JOIN (SELECT order_id, count(*) AS n FROM {lines} GROUP BY order_id) n USING (order_id)
    JOIN dim_product p ON p.nk_product_id = l.product_id
    {customer} ON c.nk_customer_id = o.customer_id
    LEFT JOIN dim_employee e ON e.nk_employee_id = l.employee_id
    LEFT JOIN dim_shipper s ON s.nk_shipper_id = o.ship_via"""

STAR = {
    "calendar": _days(ALL_DAYS),
    "dim_country": "SELECT *, row_number() OVER (ORDER BY country_name) AS sk_pais FROM countries",
    "dim_customer": """
        SELECT c.*, p.sk_pais,
               CASE WHEN ceil(balance / 2000) BETWEEN 1 AND 5 THEN CAST(ceil(balance / 2000) AS INTEGER) END AS customer_score,
               CASE WHEN ceil(balance / 2000) IN (4, 5) THEN 'ALTO' WHEN ceil(balance / 2000) = 3 THEN 'MEDIO'
                    WHEN ceil(balance / 2000) IN (1, 2) THEN 'BAJO' END AS customer_score_segmento,
               row_number() OVER (ORDER BY nk_customer_id) AS sk_cliente
        FROM customers c LEFT JOIN dim_country p ON p.country_name = c.country""",
    "dim_employee0": """
        SELECT employee_id AS nk_employee_id, trim(first_name || ' ' || last_name) AS nombre_completo, title, country,
               row_number() OVER (ORDER BY employee_id) AS sk_empleado, reports_to FROM sellers""",
    "dim_employee": """
        SELECT e.nk_employee_id, e.nombre_completo, e.title, e.country, e.sk_empleado, b.sk_empleado AS reports_to_sk
        FROM dim_employee0 e LEFT JOIN dim_employee0 b ON b.nk_employee_id = e.reports_to""",
    "dim_product": """
        SELECT product_id AS nk_product_id, product_name, unit_price AS precio_lista, discontinued,
               category_id AS category_name, lower(category_id) AS category_description, upper(supplier_id) AS supplier_name,
               'NATION_' || split_part(supplier_id, '#', 2) AS supplier_country, c.sk_pais AS sk_pais_supplier,
               row_number() OVER (ORDER BY product_id) AS sk_producto
        FROM products LEFT JOIN dim_country c ON c.country_name = 'NATION_' || split_part(supplier_id, '#', 2)""",
    "dim_shipper": "SELECT *, row_number() OVER (ORDER BY nk_shipper_id) AS sk_shipper FROM shippers",
    "fact": FACT_SELECT.format(lines="lines", orders="ords", customer="LEFT JOIN dim_customer c"),
    "dim_product_unsold": "SELECT sk_producto FROM dim_product UNION ALL SELECT max(sk_producto) + 1 FROM dim_product",
    "fact_2001": "SELECT * FROM fact WHERE sk_tiempo BETWEEN 20010101 AND 20011231",
    "fact_year": f"SELECT * FROM fact WHERE sk_tiempo BETWEEN {REPORT_YEAR}0101 AND {REPORT_YEAR}1231",
}


def _customer_metrics(fact: str, keep_all: bool) -> str:
    source = f"dim_customer d LEFT JOIN {fact} f USING (sk_cliente)" if keep_all else f"{fact} f"
    return f"""
        SELECT *, CASE tile WHEN 5 THEN 'PREMIUM' WHEN 1 THEN 'BAJO' ELSE 'REGULAR' END AS segmento FROM (
            SELECT *, ntile(5) OVER (ORDER BY monto_total_neto, sk_cliente) AS tile FROM (
                SELECT sk_cliente, count(DISTINCT nk_order_id) AS total_pedidos, count(nk_order_id) AS total_lineas,
                       coalesce(sum(monto_neto), 0) AS monto_total_neto,
                       {_ratio('sum(monto_neto)', 'count(DISTINCT nk_order_id)')} AS monto_promedio_pedido,
                       min(strptime(CAST(f.sk_tiempo AS VARCHAR), '%Y%m%d')::DATE) AS primer_pedido,
                       max(strptime(CAST(f.sk_tiempo AS VARCHAR), '%Y%m%d')::DATE) AS ultimo_pedido,
                       max(strptime(CAST(f.sk_tiempo AS VARCHAR), '%Y%m%d')::DATE)
                         - min(strptime(CAST(f.sk_tiempo AS VARCHAR), '%Y%m%d')::DATE) AS dias_como_cliente
                FROM {source} GROUP BY sk_cliente))"""


def _product_metrics(fact: str, keep_all: bool, products: str = "dim_product") -> str:
    source = f"{products} d LEFT JOIN {fact} f USING (sk_producto)" if keep_all else f"{fact} f"
    return f"""
        SELECT *, CASE tile WHEN 5 THEN 'TOP' WHEN 1 THEN 'LOW' ELSE 'MID' END AS performance FROM (
            SELECT *, rank() OVER (ORDER BY revenue_total DESC) AS rank_revenue,
                   ntile(5) OVER (ORDER BY revenue_total, sk_producto) AS tile FROM (
                SELECT sk_producto, count(DISTINCT nk_order_id) AS total_pedidos,
                       coalesce(sum(cantidad), 0) AS total_unidades, coalesce(sum(monto_neto), 0) AS revenue_total,
                       {_ratio('sum(monto_neto)', 'count(DISTINCT nk_order_id)')} AS revenue_promedio_pedido
                FROM {source} GROUP BY sk_producto))"""


def _ratio(amount: str, count: str) -> str:
    """Half-up to four decimals in whole numbers, given an amount with four decimals."""
    return (
        f"CASE WHEN {count} > 0 THEN ((2 * CAST({amount} * 10000 AS HUGEINT) + {count}) // (2 * {count})) / 10000.0 END"
    )


def _pct(part: str, whole: str, scale: int) -> str:
    """Percentage half-up in whole numbers; zero for an empty whole."""
    unit = 10**scale
    return (
        f"CASE WHEN {whole} > 0 THEN CAST((200 * {unit} * CAST({part} AS HUGEINT) + {whole}) // (2 * {whole}) AS BIGINT)"
        f" / {unit}.0 ELSE 0 END"
    )


def _period(fact: str) -> str:
    return f"""
        SELECT anio, trimestre, mes, nombre_mes, count(DISTINCT nk_order_id) AS total_pedidos, count(*) AS total_lineas,
               count(DISTINCT sk_cliente) AS total_clientes, count(DISTINCT sk_producto) AS total_productos,
               sum(monto_bruto) AS monto_bruto, sum(monto_descuento) AS monto_descuento, sum(monto_neto) AS monto_neto,
               sum(flete_prorrateado) AS flete_total, {_ratio('sum(monto_neto)', 'count(DISTINCT nk_order_id)')} AS ticket_promedio
        FROM {fact} JOIN calendar USING (sk_tiempo) GROUP BY anio, trimestre, mes, nombre_mes"""


METRICS = {
    "enr_customer": _customer_metrics("fact", True),
    "enr_product": _product_metrics("fact", True),
    "m_period": _period("fact"),
    "m_customer": """
        SELECT c.sk_cliente, nk_customer_id, company_name, city, country, p.country_name AS country_name_pais,
               p.capital_major_city, customer_score, customer_score_segmento, segmento, total_pedidos, total_lineas,
               monto_total_neto AS monto_neto, monto_promedio_pedido, primer_pedido, ultimo_pedido, dias_como_cliente,
               rank() OVER (ORDER BY monto_total_neto DESC) AS rank_cliente
        FROM dim_customer c LEFT JOIN dim_country p USING (sk_pais) LEFT JOIN enr_customer e ON e.sk_cliente = c.sk_cliente""",
    "m_product": """
        SELECT d.sk_producto, nk_product_id, product_name, category_name, supplier_name, supplier_country, precio_lista,
               discontinued, performance, rank_revenue, total_pedidos, total_unidades, revenue_total, revenue_promedio_pedido
        FROM dim_product d LEFT JOIN enr_product e USING (sk_producto)""",
}


def _seller(fact: str) -> str:
    return f"""
        SELECT e.sk_empleado, nk_employee_id, nombre_completo, title, coalesce(total_pedidos, 0) AS total_pedidos,
               coalesce(total_clientes, 0) AS total_clientes, coalesce(neto, 0) AS monto_neto, monto_promedio,
               rank() OVER (ORDER BY coalesce(neto, 0) DESC) AS rank_empleado
        FROM dim_employee e LEFT JOIN (
            SELECT sk_empleado, count(DISTINCT nk_order_id) AS total_pedidos, count(DISTINCT sk_cliente) AS total_clientes,
                   sum(monto_neto) AS neto, {_ratio('sum(monto_neto)', 'count(DISTINCT nk_order_id)')} AS monto_promedio
            FROM {fact} GROUP BY sk_empleado) v USING (sk_empleado)"""


def _sold_per_country(fact: str) -> str:
    """Customers, orders and amount of the countries whose customers bought; every order once per country."""
    return f"""
        SELECT sk_pais, count(DISTINCT sk_cliente) AS compradores, count(DISTINCT nk_order_id) AS total_pedidos, sum(monto_neto) AS neto
        FROM {fact} JOIN dim_customer USING (sk_cliente) WHERE sk_pais IS NOT NULL GROUP BY sk_pais"""


def _geo(fact: str, join: str) -> str:
    """Share of the total with four decimals, half-up in whole numbers. A left join also counts idle customers."""
    people = "compradores" if join == "JOIN" else "coalesce(vecinos, 0)"
    cents = "CAST(coalesce(neto, 0) * 10000 AS HUGEINT)"
    return f"""
        WITH sold AS ({_sold_per_country(fact)}),
             lives AS (SELECT sk_pais, count(*) AS vecinos FROM dim_customer WHERE sk_pais IS NOT NULL GROUP BY sk_pais),
             whole AS (SELECT coalesce(sum(CAST(neto * 10000 AS HUGEINT)), 0) AS cents FROM sold)
        SELECT dim_country.*, {people} AS total_clientes, coalesce(total_pedidos, 0) AS total_pedidos, coalesce(neto, 0) AS monto_neto,
               CASE WHEN whole.cents > 0 THEN CAST((2000000 * {cents} + whole.cents) // (2 * whole.cents) AS BIGINT) / 10000.0 ELSE 0 END
                   AS pct_monto_global
        FROM whole, dim_country {join} sold USING (sk_pais) LEFT JOIN lives USING (sk_pais)"""


HISTORY = {
    "hist": f"""
        SELECT nk_customer_id, c.sk_cliente, company_name, city, region, country,
               coalesce(f.fecha, DATE '{NO_SALES_DATE}') AS fecha_desde
        FROM dim_customer c LEFT JOIN (
            SELECT sk_cliente, min(strptime(CAST(sk_tiempo AS VARCHAR), '%Y%m%d')::DATE) AS fecha
            FROM fact GROUP BY sk_cliente) f USING (sk_cliente)
        WHERE balance < 9000""",
    "news": """
        SELECT nk_customer_id, sk_cliente, company_name, CASE WHEN balance < 0 THEN 'Moved' ELSE city END AS city,
               CASE WHEN balance < 0 AND contact_title = 'BUILDING' THEN NULL ELSE region END AS region, country
        FROM dim_customer""",
    "eff": f"SELECT coalesce(min(order_date), DATE '{CUT}') AS f FROM ords WHERE order_date >= DATE '{CUT}'",
    "changed": """
        SELECT h.nk_customer_id, h.fecha_desde >= f AS late FROM hist h JOIN news n USING (nk_customer_id), eff
        WHERE h.company_name IS DISTINCT FROM n.company_name OR h.city IS DISTINCT FROM n.city
           OR h.region IS DISTINCT FROM n.region OR h.country IS DISTINCT FROM n.country""",
    "merged": """
        SELECT h.nk_customer_id, sk_cliente, company_name, city, region, country, fecha_desde,
               CASE WHEN c.late = false THEN f - 1 END AS fecha_hasta,
               CASE WHEN c.late = false THEN 0 ELSE 1 END AS es_vigente
        FROM hist h LEFT JOIN changed c USING (nk_customer_id), eff
        UNION ALL
        SELECT n.nk_customer_id, sk_cliente, company_name, city, region, country, f, NULL, 1
        FROM news n, eff
        WHERE n.nk_customer_id IN (SELECT nk_customer_id FROM changed WHERE NOT late)
           OR n.nk_customer_id NOT IN (SELECT nk_customer_id FROM hist)""",
    "seen": f"""
        SELECT 0 AS lote, fecha_desde AS fecha, nk_customer_id, sk_cliente, company_name, city, region, country FROM hist
        UNION ALL SELECT 1, f, nk_customer_id, sk_cliente, company_name, city, region, country FROM news, eff
        UNION ALL SELECT 2, DATE '{OVERLAP}', nk_customer_id, sk_cliente, company_name,
               CASE WHEN balance < 4000 THEN 'Late' ELSE city END, region, country
        FROM dim_customer WHERE contact_title IN ('BUILDING', 'MACHINERY')""",
    "turns": """
        SELECT *, row(company_name, city, region, country) AS state,
               lag(row(company_name, city, region, country)) OVER (PARTITION BY nk_customer_id ORDER BY fecha) AS earlier,
               row_number() OVER (PARTITION BY nk_customer_id ORDER BY fecha) AS nth
        FROM (SELECT * FROM seen QUALIFY row_number() OVER (PARTITION BY nk_customer_id, fecha ORDER BY lote DESC) = 1)""",
    "spliced": """
        SELECT nk_customer_id, sk_cliente, company_name, city, region, country, fecha AS fecha_desde,
               lead(fecha) OVER (PARTITION BY nk_customer_id ORDER BY fecha) - 1 AS fecha_hasta,
               CASE WHEN lead(fecha) OVER (PARTITION BY nk_customer_id ORDER BY fecha) IS NULL THEN 1 ELSE 0 END AS es_vigente
        FROM turns WHERE nth = 1 OR state IS DISTINCT FROM earlier""",
}

BATCH = {
    "batch_orders": f"SELECT * REPLACE (CAST(freight * 2 AS DECIMAL(12,2)) AS freight) FROM ords WHERE order_date >= DATE '{OVERLAP}'",
    "batch_lines": "SELECT * FROM lines WHERE order_id IN (SELECT order_id FROM batch_orders)",
    "batch_fact": FACT_SELECT.format(
        lines="batch_lines", orders="batch_orders", customer="JOIN (SELECT * FROM dim_customer WHERE balance >= 0) c"
    ),
    "base_fact": f"SELECT * FROM fact WHERE sk_tiempo < {CUT.replace('-', '')}",
    "upserted": """
        SELECT * FROM base_fact b
        WHERE NOT EXISTS (SELECT 1 FROM batch_fact n WHERE n.nk_order_id = b.nk_order_id AND n.sk_producto = b.sk_producto)
        UNION ALL SELECT * FROM batch_fact""",
}

EVENTS = {
    "runs": """
        SELECT event_id AS log_id, user_id AS script_id, ts AS fecha_inicio, CASE WHEN event_type <> 'click' THEN ts END AS fecha_fin,
               CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARNING' WHEN 'click' THEN 'EN_PROCESO' ELSE 'OK' END AS resultado,
               CAST(floor(value) AS BIGINT) AS registros_proc, props AS detalle
        FROM events""",
    "scripts": """
        SELECT DISTINCT user_id AS script_id, 'script_' || user_id AS script_nombre, 'Proceso script_' || user_id AS script_desc,
               CASE WHEN user_id < 50 THEN 'adquisicion' ELSE 'ingenieria' END AS etapa
        FROM events""",
}

BLOCKS = {**RAW, **STAGED, **STAR, **METRICS, **HISTORY, **BATCH, **EVENTS}


def _with(body: str) -> str:
    """Prefix the shared expressions the text mentions, directly or through one another."""
    import re

    def mentions(text: str) -> set[str]:
        return {n for n in BLOCKS if re.search(rf"\b{n}\b", text)}

    needed: set[str] = set()
    todo = mentions(body)
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            todo |= mentions(BLOCKS[name]) - needed - {name}
    parts = [f"{n} AS ({BLOCKS[n].strip()})" for n in BLOCKS if n in needed]
    return f"WITH {', '.join(parts)} {body}" if parts else body


# ---- rules -----------------------------------------------------------------------------------

_INT = r"'[0-9]+'"
_NUM = r"'[0-9]+(\.[0-9]+)?'"
_DATE = r"'[0-9]{4}-[0-9]{2}-[0-9]{2}'"


def _full(column: str, pattern: str) -> str:
    return f"regexp_full_match({column}, {pattern})"


def _rule(table, source, field, control, bad, severity="ERROR", good="Sin errores", text="", unique=None, info=False):
    """One rule as a SELECT. ``unique`` adds repeated keys."""
    count = f"(SELECT count(*) FROM {source} WHERE {bad})" if bad else "0"
    if unique:
        count += f" + (SELECT count(*) FROM (SELECT {unique} FROM {source} GROUP BY {unique} HAVING count(*) > 1))"
    state = "'OK'" if info else f"CASE WHEN n = 0 THEN 'OK' ELSE '{severity}' END"
    shown = f"'{text}: ' || n"
    return (
        f"SELECT '{table}' AS tabla, '{field}' AS campo, '{control}' AS control, {state} AS resultado, "
        f"CAST(n AS BIGINT) AS cant_errores, CASE WHEN n = 0 THEN '{good}' ELSE {shown} END AS detalle "
        f"FROM (SELECT {count} AS n)"
    )


def _blank(c: str) -> str:
    return f"({c} IS NULL OR {c} = '')"


def _blank_trim(c: str) -> str:
    return f"({c} IS NULL OR trim({c}) = '')"


def _batch1() -> str:
    c, p, o, d = "raw_customers", "raw_products", "raw_orders", "raw_lines"
    nulls = {"good": "Sin nulos", "text": "Hay registros nulos"}
    twice = {"good": "Sin duplicados", "text": "Hay claves duplicadas"}
    key = {"good": "PK válida", "text": "PK inválida"}
    number = f"(NOT {_full('unit_price', _NUM)} OR TRY_CAST(unit_price AS DECIMAL(38,10)) < 950)"
    dates = {"text": "Hay fechas inválidas"}
    parts = [
        _rule("txt_customers", c, "customer_id", "NOT NULL", _blank("customer_id"), **nulls),
        _rule("txt_customers", c, "customer_id", "SIN_DUPLICADOS", None, unique="customer_id", **twice),
        _rule("txt_customers", c, "customer_id", "LONGITUD_3", "length(customer_id) <> 3", text="Hay valores con longitud distinta de 3"),
        _rule("txt_customers", c, "contact_title", "NOT NULL", _blank("contact_title"), **nulls),
        _rule("txt_customers", c, "country", "VALOR_INCONSISTENTE", "country = '7'", "WARNING", text="Hay registros con valor 7"),
        _rule("txt_customers", c, "balance", "ES_NUMERICO", f"NOT {_full('balance', _NUM)}", text="Hay valores no numéricos"),
        _rule("txt_customers", c, "country", "SIN_DUPLICADOS", None, unique="country", **twice),
        _rule("txt_products", p, "product_id", "NOT NULL + SIN_DUPLICADOS", _blank("product_id"), unique="product_id", **key),
        _rule("txt_products", p, "product_name", "NOT NULL + SIN_DUPLICADOS", _blank("product_name"), unique="product_name", **key),
        _rule("txt_products", p, "discontinued", "VALOR_0_O_1", "discontinued NOT IN ('0','1')", text="Valores inválidos"),
        _rule("txt_products", p, "product_id", "CASTEABLE_A_ENTERO", f"NOT {_full('trim(product_id)', _INT)}", text="Hay valores no enteros"),
        _rule("txt_products", p, "unit_price", "CASTEABLE_A_ENTERO", f"NOT {_full('trim(unit_price)', _INT)}", text="Hay valores no enteros"),
        _rule("txt_products", p, "unit_price", "PRECIO_MINIMO", number, text="Hay valores fuera de rango"),
        *[
            _rule("txt_orders", o, f, "FORMATO_FECHA", f"{f} <> 'NULL' AND NOT regexp_matches({f}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')", **dates)
            for f in ("order_date", "required_date", "shipped_date")
        ],
        _rule("txt_orders", o, "ship_via", "ES_ENTERO_O_NULL", f"ship_via <> 'NULL' AND NOT {_full('trim(ship_via)', _INT)}", text="Hay valores no enteros"),
        _rule("txt_orders", o, "shipped_date", "NULOS_ESPERADOS", "shipped_date IS NULL OR shipped_date = 'NULL'", good="Nulos esperados", text="Nulos esperados. Cantidad", info=True),
        _rule("txt_orders", o, "freight", "ES_NUMERICO_POSITIVO", f"NOT {_full('freight', _NUM)} OR TRY_CAST(freight AS DECIMAL(38,10)) < 0", text="Hay valores fuera de rango"),
        _rule("txt_order_details", d, "order_id+product_id", "PK_COMPUESTA_SIN_DUPLICADOS", None, unique="order_id, product_id", **twice),
        _rule("txt_order_details", d, "discount", "RANGO_DESCUENTO", f"NOT {_full('discount', _NUM)} OR TRY_CAST(discount AS DECIMAL(38,10)) NOT BETWEEN 0 AND 0.05", "WARNING", text="Hay valores fuera de rango"),
        _rule("txt_order_details", d, "quantity", "ENTERO_POSITIVO", f"NOT {_full('quantity', _INT)} OR TRY_CAST(quantity AS BIGINT) < 1", text="Hay enteros fuera de rango"),
        _rule("txt_order_details", d, "return_flag", "VALOR_A_O_N", "return_flag NOT IN ('A','N')", text="Valores inválidos"),
    ]
    return " UNION ALL ".join(parts)


def _batch2() -> str:
    c, p, o, d = "raw_customers", "raw_products", "raw_orders", "raw_lines"
    date = f"{_blank_trim('shipped_date')} OR NOT regexp_matches(trim(shipped_date), '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')"
    parts = [
        _rule("txt2_customers", c, "customer_id", "PK no nula y largo 3", f"{_blank_trim('customer_id')} OR length(trim(customer_id)) <> 3", text="Hay valores con longitud distinta de 3"),
        _rule("txt2_customers", c, "contact_title", "Titulo obligatorio", _blank_trim("contact_title"), text="El campo es obligatorio"),
        _rule("txt2_customers", c, "score", "Score entre 1 y 5", f"NOT {_full('trim(score)', _INT)} OR TRY_CAST(trim(score) AS BIGINT) NOT BETWEEN 1 AND 5", text="Hay enteros fuera de rango"),
        _rule("txt2_orders", o, "order_id", "PK numerica no nula", f"{_blank_trim('order_id')} OR NOT {_full('trim(order_id)', _INT)}", text="La clave debe ser numérica"),
        _rule("txt2_orders", o, "ship_via", "PK numerica no nula", f"{_blank_trim('ship_via')} OR NOT {_full('trim(ship_via)', _INT)}", text="La clave debe ser numérica"),
        _rule("txt2_orders", o, "order_id", "Duplicados de PK", None, unique="order_id", good="Sin duplicados", text="Hay claves duplicadas"),
        _rule("txt2_orders", o, "shipped_date", "Fecha valida", date, text="Hay fechas inválidas"),
        _rule("txt2_order_details", d, "order_id/unit_price", "PK compuesta numerica", f"NOT {_full('trim(order_id)', _INT)} OR NOT {_full('trim(unit_price)', _INT)}", text="La clave debe ser numérica"),
        _rule("txt2_order_details", d, "order_id/product_id", "Duplicados de PK compuesta", None, unique="order_id, product_id", good="Sin duplicados", text="Hay claves duplicadas"),
        _rule("txt2_order_details", d, "quantity", "Cantidad positiva", f"NOT {_full('trim(quantity)', _INT)} OR TRY_CAST(trim(quantity) AS BIGINT) < 1", text="Hay enteros fuera de rango"),
        _rule("txt2_order_details", d, "discount", "Descuento entre 0 y 1", f"NOT {_full('trim(discount)', _NUM)} OR TRY_CAST(trim(discount) AS DECIMAL(38,10)) NOT BETWEEN 0 AND 1", text="Hay valores fuera de rango"),
        _rule("txt2_products", p, "discontinued", "Flag 0/1", "trim(discontinued) NOT IN ('0','1')", text="Valores inválidos"),
    ]
    return " UNION ALL ".join(parts)


def _offenders() -> str:
    def one(table, source, key, field, control, bad):
        return f"SELECT '{table}' AS tabla, '{field}' AS campo, '{control}' AS control, CAST({key} AS VARCHAR) AS clave_registro, {field} AS valor FROM {source} WHERE {bad}"

    c = ("txt_customers", "raw_customers", "customer_id")
    p = ("txt_products", "raw_products", "product_id")
    o = ("txt_orders", "raw_orders", "order_id")
    d = ("txt_order_details", "raw_lines", "order_id || '/' || product_id")
    date = "{0} <> 'NULL' AND NOT regexp_matches({0}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')"
    return " UNION ALL ".join(
        [
            one(*c, "customer_id", "NOT NULL", _blank("customer_id")),
            one(*c, "customer_id", "LONGITUD_3", "length(customer_id) <> 3"),
            one(*c, "contact_title", "NOT NULL", _blank("contact_title")),
            one(*c, "country", "VALOR_INCONSISTENTE", "country = '7'"),
            one(*c, "balance", "ES_NUMERICO", f"NOT {_full('balance', _NUM)}"),
            one(*p, "product_id", "NOT NULL + SIN_DUPLICADOS", _blank("product_id")),
            one(*p, "product_name", "NOT NULL + SIN_DUPLICADOS", _blank("product_name")),
            one(*p, "discontinued", "VALOR_0_O_1", "discontinued NOT IN ('0','1')"),
            one(*p, "product_id", "CASTEABLE_A_ENTERO", f"NOT {_full('product_id', _INT)}"),
            one(*p, "unit_price", "CASTEABLE_A_ENTERO", f"NOT {_full('unit_price', _INT)}"),
            one(*p, "unit_price", "PRECIO_MINIMO", f"NOT {_full('unit_price', _NUM)} OR TRY_CAST(unit_price AS DECIMAL(38,10)) < 950"),
            *[one(*o, f, "FORMATO_FECHA", date.format(f)) for f in ("order_date", "required_date", "shipped_date")],
            one(*o, "ship_via", "ES_ENTERO_O_NULL", f"ship_via <> 'NULL' AND NOT {_full('ship_via', _INT)}"),
            one(*d, "discount", "RANGO_DESCUENTO", f"NOT {_full('discount', _NUM)} OR TRY_CAST(discount AS DECIMAL(38,10)) NOT BETWEEN 0 AND 0.05"),
            one(*d, "quantity", "ENTERO_POSITIVO", f"NOT {_full('quantity', _INT)} OR TRY_CAST(quantity AS BIGINT) < 1"),
            one(*d, "return_flag", "VALOR_A_O_N", "return_flag NOT IN ('A','N')"),
            one(*o, "freight", "ES_NUMERICO_POSITIVO", f"NOT {_full('freight', _NUM)} OR TRY_CAST(freight AS DECIMAL(38,10)) < 0"),
        ]
    )


def _rollup(results: str, soften: bool = False, extra: str = "") -> str:
    if soften:
        state = "CASE WHEN errores > 0 THEN 'WARNING' ELSE 'OK' END"
    else:
        state = "CASE WHEN errores > 0 THEN 'ERROR' WHEN warnings > 0 THEN 'WARNING' ELSE 'OK' END"
    return (
        f"SELECT {state} AS resultado, 'Errores: ' || errores || ' | Warnings: ' || warnings AS detalle, errores, warnings, "
        f"registros_proc{extra} FROM (SELECT count(*) FILTER (WHERE resultado = 'ERROR') AS errores, "
        f"count(*) FILTER (WHERE resultado = 'WARNING') AS warnings, count(*) AS registros_proc FROM ({results}))"
    )


def _profile(table: str, source: str, columns: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS tabla, '{c}' AS campo, count(*) AS total_registros, count(*) FILTER (WHERE {null}) AS cant_nulos, "
        f"count(DISTINCT {c}) AS cant_distintos, min({c}) AS valor_min, max({c}) AS valor_max FROM {source}"
        for c, null in columns.items()
    )


def _profiles() -> str:
    def blank(*names):
        return {n: _blank(n) for n in names}

    word = "({0} IS NULL OR {0} = 'NULL')"
    customers = blank("customer_id", "company_name", "country", "balance")
    customers["contact_title"] = "(contact_title IS NULL OR contact_title IN ('', 'NULL'))"
    orders = {**blank("order_id", "customer_id", "ship_via"), **{n: word.format(n) for n in ("order_date", "shipped_date")}}
    return " UNION ALL ".join(
        [
            _profile("txt_customers", "raw_customers", customers),
            _profile("txt_products", "raw_products", blank("product_id", "product_name", "category_id", "unit_price", "discontinued")),
            _profile("txt_orders", "raw_orders", orders),
            _profile("txt_order_details", "raw_lines", {n: f"{n} IS NULL" for n in ("quantity", "discount", "unit_price")}),
        ]
    )


# ---- integrity and indicators ----------------------------------------------------------------

_SOLVENT = "SELECT nk_customer_id FROM customers WHERE balance >= 0"
_CURRENT = "SELECT product_id FROM products WHERE discontinued = 0"
_FAST = "SELECT nk_shipper_id FROM shippers WHERE nk_shipper_id < 5"
_KNOWN = "SELECT country_name FROM countries WHERE region <> 'ASIA'"
_SENIOR = "SELECT employee_id FROM sellers WHERE country < 'NATION_5'"

_FKS = {
    "order_customer": ("tmp_orders", "ords", "customer_id", _SOLVENT, "order_id"),
    "order_shipper": ("tmp_orders", "ords", "ship_via", _FAST, "order_id"),
    "line_order": ("tmp_order_details", "all_lines", "order_id", "SELECT order_id FROM ords", "order_id"),
    "line_product": ("tmp_order_details", "all_lines", "product_id", _CURRENT, "product_id"),
    "product_category": ("tmp_products", "products", "category_id", "SELECT p_type FROM part", "product_id"),
    "product_brand": ("tmp_products", "products", "supplier_id", "SELECT p_brand FROM part", "product_id"),
    "customer_country": ("tmp_customers", "customers", "country", _KNOWN, "nk_customer_id"),
    "seller_boss": ("tmp_employees", "sellers", "reports_to", _SENIOR, "employee_id"),
}


def _fk_checks() -> str:
    parts = []
    for table, source, column, known, _ in _FKS.values():
        bad = f"{column} IS NOT NULL AND {column} NOT IN ({known})"
        parts.append(
            f"SELECT '{table}' AS tabla, '{column}' AS campo, 'INTEGRIDAD_REFERENCIAL' AS control, "
            f"CASE WHEN n = 0 THEN 'OK' ELSE 'ERROR' END AS resultado, n AS cant_errores, "
            f"CASE WHEN n = 0 THEN 'Todos los {column} existen' ELSE n || ' registros con {column} inválido' END AS detalle "
            f"FROM (SELECT count(*) AS n FROM {source} WHERE {bad})"
        )
    return " UNION ALL ".join(parts)


def _indicator(table, field, name, value, warn, error, worst="ERROR") -> str:
    shown = f"'{field}'" if field else "CAST(NULL AS VARCHAR)"
    return (
        f"SELECT '{table}' AS tabla, {shown} AS campo, '{name}' AS indicador, CAST(v AS DOUBLE) AS valor_calculado, "
        f"CAST({warn} AS DOUBLE) AS umbral_warning, CAST({error} AS DOUBLE) AS umbral_error, "
        f"CASE WHEN v > {error} THEN '{worst}' WHEN v > {warn} THEN 'WARNING' ELSE 'OK' END AS resultado FROM ({value})"
    )


def _share(table, source, field, name, bad, warn=0, error=0, scale=2, only="true") -> str:
    value = f"SELECT {_pct(f'count(*) FILTER (WHERE {bad})', 'count(*)', scale)} AS v FROM {source} WHERE {only}"
    return _indicator(table, field, name, value, warn, error)


def _fk_shares() -> str:
    def one(name, label, warn=0, error=0, scale=2, null="skip", also=""):
        table, source, column, known, _ = _FKS[name]
        inside = f"{column} IN ({known}{also})"
        bad = f"({column} IS NULL OR NOT {inside})" if null == "bad" else f"({column} IS NOT NULL AND NOT {inside})"
        return _share(table, source, column, label, bad, warn, error, scale, f"{column} IS NOT NULL" if null == "out" else "true")

    extra = " UNION ALL SELECT product_id FROM products WHERE discontinued = 1 AND unit_price > 950"
    return " UNION ALL ".join(
        [
            one("order_customer", "PCT_FK_CLIENTE_INVALIDA", scale=4, null="bad"),
            one("order_shipper", "PCT_ORDER_SIN_SHIPPER"),
            one("order_shipper", "PCT_SHIPPER_O_NULO", scale=4, null="bad"),
            one("order_shipper", "PCT_SHIPPER_INFORMADO", scale=4, null="out"),
            one("line_order", "PCT_OD_SIN_ORDER"),
            one("line_product", "PCT_OD_SIN_PRODUCTO"),
            one("line_product", "PCT_FK_PRODUCTO_INVALIDA", scale=4, null="bad", also=extra),
            one("product_category", "PCT_PROD_SIN_CATEGORY"),
            one("product_brand", "PCT_PROD_SIN_SUPPLIER"),
            one("customer_country", "PCT_CLIENTE_SIN_PAIS", error=25),
            one("seller_boss", "PCT_REPORTS_TO_INVALIDO"),
        ]
    )


def _nulls() -> str:
    staged = "(SELECT * REPLACE (CASE WHEN contact_title <> 'BUILDING' THEN contact_title END AS contact_title) FROM customers)"
    c, o, e = "tmp_customers", "tmp_orders", "tmp_employees"
    return " UNION ALL ".join(
        [
            _share(c, staged, "company_name", "PCT_NULOS", "company_name IS NULL"),
            _share(c, staged, "contact_title", "PCT_NULOS", "contact_title IS NULL", 10, 30),
            _share(c, staged, "country", "PCT_NULOS", "country IS NULL", 10, 30),
            _share(o, "ords", "order_date", "PCT_NULOS", "order_date IS NULL"),
            _share(o, "ords", "shipped_date", "PCT_NULOS", "shipped_date IS NULL"),
            _share(o, "ords", "ship_via / shipped_date", "PCT_NULOS", "ship_via IS NULL OR shipped_date IS NULL"),
            _share(e, "sellers", "first_name / last_name", "PCT_NULOS", "first_name IS NULL OR last_name IS NULL"),
        ]
    )


def _business() -> str:
    p, d = ("tmp_products", "products"), ("tmp_order_details", "all_lines")
    shipped = "(SELECT l.ship_date, o.order_date FROM all_lines l LEFT JOIN ords o USING (order_id))"
    return " UNION ALL ".join(
        [
            _share(*p, "unit_price", "PCT_PRECIO_NEGATIVO", "unit_price < 0", 0, 1),
            _share(*p, "unit_price", "PCT_PRECIO_BASE", "unit_price = 900 AND discontinued = 0", 0, 5),
            _share(*p, "discontinued", "PCT_VALOR_INVALIDO", "discontinued NOT IN (0, 1)"),
            _share(*d, "unit_price", "PCT_PRECIO_NEGATIVO", "unit_price < 0"),
            _share(*d, "unit_price", "PCT_PRECIO_CERO", "unit_price = 0", 1, 5),
            _share(*d, "quantity", "PCT_CANTIDAD_INVALIDA", "quantity <= 0"),
            _share(*d, "discount", "PCT_DESCUENTO_INVALIDO", "discount < 0 OR discount > 0.05"),
            _share("tmp_orders", shipped, "shipped_date", "PCT_SHIPPED_BEFORE_ORDER", "ship_date < order_date", 0, 1),
        ]
    )


def _outlier(table, source, column, base, counted, width, lower=False) -> str:
    x = f"CAST({column} AS DOUBLE)"
    fence = f"SELECT quantile_cont({x}, 0.25) AS q1, quantile_cont({x}, 0.75) AS q3, count(*) AS total FROM {source} WHERE {base}"
    low = f" OR {x} < greatest(0, q1 - {width} * (q3 - q1))" if lower else ""
    bad = f"count(*) FILTER (WHERE ({counted}) AND ({x} > q3 + {width} * (q3 - q1){low}))"
    value = f"SELECT {_pct(bad, 'any_value(total)', 2)} AS v FROM {source}, ({fence})"
    return _indicator(table, column, "PCT_OUTLIERS", value, 5, 15)


def _outliers() -> str:
    return " UNION ALL ".join(
        [
            _outlier("tmp_customers", "customers", "balance", "balance > 0", "true", 0.5, True),
            _outlier("tmp_orders", "ords", "freight", "freight IS NOT NULL", "freight IS NOT NULL", 0.25),
            _outlier("tmp_order_details", "all_lines", "unit_price", "unit_price > 0", "unit_price > 0", 0.4),
            _outlier("tmp_order_details", "all_lines", "quantity", "quantity > 0", "quantity > 0", 3),
        ]
    )


def _differences() -> str:
    pairs = [
        ("tmp_orders", "raw_orders", "ords"),
        ("tmp_order_details", "raw_lines", "lines"),
        ("tmp_products", "raw_products", "products"),
        ("tmp_customers", "raw_customers", f"({_SOLVENT})"),
    ]
    return " UNION ALL ".join(
        _indicator(t, None, "DIFF_COUNT_TXT_VS_TMP", f"SELECT abs((SELECT count(*) FROM {a}) - (SELECT count(*) FROM {b})) AS v", 0, 0, "WARNING")
        for t, a, b in pairs
    )


def _gate() -> str:
    def last(n):
        return f"(SELECT max(log_id) FROM runs WHERE script_id = {n})"

    return (
        f"SELECT tabla, indicador, valor_calculado, resultado, 'script_1' AS detectado_en FROM ({_business()}) "
        f"WHERE resultado = 'ERROR' AND {last(1)} IS NOT NULL UNION ALL "
        f"SELECT tabla, indicador, valor_calculado, resultado, 'script_2' FROM ({_fk_shares()}) "
        f"WHERE resultado = 'ERROR' AND {last(2)} IS NOT NULL"
    )


def _footprints() -> str:
    def one(table, read, loaded, reason, decision=None):
        verdict = f"'{decision}'" if decision else (
            "CASE WHEN a = b THEN 'CARGADO' WHEN b > 0 THEN 'CARGADO_PARCIAL' ELSE 'RECHAZADO' END"
        )
        return (
            f"SELECT '{table}' AS tabla_destino, a AS registros_leidos, b AS registros_insertados, a - b AS registros_rechazados, "
            f"{verdict} AS decision, CASE WHEN a > b THEN '{reason}' END AS motivo_rechazo "
            f"FROM (SELECT (SELECT count(*) FROM {read}) AS a, (SELECT count(*) FROM {loaded}) AS b)"
        )

    return " UNION ALL ".join(
        [
            one("dwa_dim_cliente", "customers", "dim_customer", "Clientes excluidos"),
            one("dwa_dim_producto", "products", "dim_product", "Productos excluidos"),
            one("dwa_fact_ventas", "batch_lines", "batch_fact", "Lineas con FK invalida"),
            one("dwa_dim_pais", "countries", "dim_country", "", "CORREGIDO"),
        ]
    )


# ---- text forms ------------------------------------------------------------------------------

_FACT_OUT = """SELECT CAST(sk_tiempo AS BIGINT) AS sk_tiempo, sk_cliente, sk_empleado, sk_producto, sk_shipper, nk_order_id,
    CAST(cantidad AS BIGINT) AS cantidad, CAST(precio_unitario AS DOUBLE) AS precio_unitario, CAST(descuento AS DOUBLE) AS descuento,
    CAST(flete_prorrateado AS DOUBLE) AS flete_prorrateado, CAST(monto_bruto AS DOUBLE) AS monto_bruto,
    CAST(monto_descuento AS DOUBLE) AS monto_descuento, CAST(monto_neto AS DOUBLE) AS monto_neto FROM {0}"""

_CALENDAR_OUT = """SELECT CAST(sk_tiempo AS BIGINT) AS sk_tiempo, CAST(fecha AS VARCHAR) AS fecha, anio, trimestre, mes, nombre_mes,
    semana_anio, dia, dia_semana, nombre_dia, CAST(es_fin_de_semana AS BIGINT) AS es_fin_de_semana FROM {0}"""

_PERIOD_OUT = """SELECT anio, trimestre, mes, nombre_mes, total_pedidos, total_lineas, total_clientes, total_productos,
    CAST(monto_bruto AS DOUBLE) AS monto_bruto, CAST(monto_descuento AS DOUBLE) AS monto_descuento, CAST(monto_neto AS DOUBLE) AS monto_neto,
    CAST(flete_total AS DOUBLE) AS flete_total, ticket_promedio FROM ({0})"""

_ENR_CUSTOMER_OUT = """SELECT sk_cliente, total_pedidos, total_lineas, CAST(monto_total_neto AS DOUBLE) AS monto_total_neto,
    monto_promedio_pedido, CAST(primer_pedido AS VARCHAR) AS primer_pedido, CAST(ultimo_pedido AS VARCHAR) AS ultimo_pedido,
    dias_como_cliente, segmento FROM ({0})"""

_ENR_PRODUCT_OUT = """SELECT sk_producto, total_pedidos, CAST(total_unidades AS BIGINT) AS total_unidades,
    CAST(revenue_total AS DOUBLE) AS revenue_total, revenue_promedio_pedido, rank_revenue, performance FROM ({0})"""

_HISTORY_OUT = """SELECT nk_customer_id, sk_cliente, company_name, city, region, country, CAST(fecha_desde AS VARCHAR) AS fecha_desde,
    CAST(fecha_hasta AS VARCHAR) AS fecha_hasta, CAST(es_vigente AS BIGINT) AS es_vigente FROM {0}"""

_CUSTOMER_OUT = """SELECT sk_cliente, nk_customer_id, company_name, city, country, country_name_pais, capital_major_city,
    CAST(customer_score AS BIGINT) AS customer_score, customer_score_segmento, segmento, total_pedidos, total_lineas,
    CAST(monto_neto AS DOUBLE) AS monto_neto, monto_promedio_pedido, CAST(primer_pedido AS VARCHAR) AS primer_pedido,
    CAST(ultimo_pedido AS VARCHAR) AS ultimo_pedido, dias_como_cliente, rank_cliente FROM m_customer"""

_GEO_OUT = """SELECT country_name, CAST(monto_neto AS DOUBLE) AS monto_neto, total_clientes, total_pedidos,
    CAST(pct_monto_global AS DOUBLE) AS pct_monto_global, CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude
    FROM ({0}) WHERE latitude IS NOT NULL AND longitude IS NOT NULL"""

_SELLER_OUT = """SELECT {1} CAST(monto_neto AS DOUBLE) AS monto_neto, total_pedidos, total_clientes, title, nombre_completo,
    rank_empleado FROM ({0})"""

_SCORE_BAD = "NOT coalesce(TRY_CAST(trim(score) AS BIGINT) BETWEEN 1 AND 5, false)"
_SCORE_REJECTS = f"""SELECT 'txt2_customers_score' AS tabla_origen, customer_id AS clave_registro,
    'Score invalido: valor ' || score || '. La regla de calidad exige score entre 1 y 5.' AS motivo_rechazo,
    'RECHAZADO' AS decision FROM raw_customers WHERE {_SCORE_BAD}"""

_FIRST = """(SELECT * EXCLUDE (balance), row_number() OVER (ORDER BY nk_customer_id) AS sk_cliente
    FROM customers WHERE balance >= 5000)"""
_NEWS = """(SELECT * EXCLUDE (balance) REPLACE (lower(contact_title) AS contact_title, nullif(city, 'City 3') AS city)
    FROM customers WHERE balance < 6000)"""


def _dim_merge(overwrite: bool) -> str:
    fresh = f"""SELECT n.*, row_number() OVER (ORDER BY nk_customer_id) + (SELECT max(sk_cliente) FROM {_FIRST}) AS sk_cliente
        FROM {_NEWS} n WHERE nk_customer_id NOT IN (SELECT nk_customer_id FROM {_FIRST})"""
    if overwrite:
        kept = f"""SELECT f.nk_customer_id, coalesce(n.company_name, f.company_name) AS company_name,
            CASE WHEN n.nk_customer_id IS NULL THEN f.contact_title ELSE n.contact_title END AS contact_title,
            CASE WHEN n.nk_customer_id IS NULL THEN f.city ELSE n.city END AS city,
            CASE WHEN n.nk_customer_id IS NULL THEN f.region ELSE n.region END AS region,
            CASE WHEN n.nk_customer_id IS NULL THEN f.country ELSE n.country END AS country, f.sk_cliente
            FROM {_FIRST} f LEFT JOIN {_NEWS} n USING (nk_customer_id)"""
    else:
        kept = f"SELECT * FROM {_FIRST}"
    return f"{kept} UNION ALL BY NAME {fresh}"


def _ledger_fold() -> str:
    return """SELECT log_id, script_id, strftime(fecha_inicio, '%Y-%m-%d %H:%M:%S') AS fecha_inicio,
        strftime(fecha_fin, '%Y-%m-%d %H:%M:%S') AS fecha_fin, resultado,
        CASE WHEN fecha_fin IS NOT NULL THEN detalle END AS detalle,
        CASE WHEN fecha_fin IS NOT NULL THEN registros_proc END AS registros_proc FROM runs"""


def _catalog_rows() -> str:
    keys = {
        "txt_customers": (["customer_id"], []),
        "txt_products": (["product_id"], ["category_id"]),
        "txt_orders": (["order_id"], ["customer_id"]),
        "txt_order_details": (["order_id", "product_id"], ["order_id"]),
    }
    profiled = _profiles()
    pk = " OR ".join(f"(tabla = '{t}' AND campo = '{c}')" for t, (p, _) in keys.items() for c in p)
    fk = " OR ".join(f"(tabla = '{t}' AND campo = '{c}')" for t, (_, f) in keys.items() for c in f)
    return (
        f"SELECT tabla AS nombre_tabla, campo AS nombre_columna, 'string' AS tipo_dato, CAST(CASE WHEN {pk} THEN 1 ELSE 0 END AS BIGINT) AS es_pk, "
        f"CAST(CASE WHEN {fk} THEN 1 ELSE 0 END AS BIGINT) AS es_fk, total_registros, cant_nulos, cant_distintos FROM ({profiled})"
    )


_EUROPE = "CASE WHEN region = 'EUROPE' THEN -1 ELSE sk_pais END"

_ORACLES = {
    "norm_text_nulls": """SELECT CAST(customer_id AS BIGINT) AS customer_id, trim(company_name) AS company_name,
        nullif(trim(contact_title), 'NULL') AS contact_title,
        CAST(sign(CAST(balance AS DECIMAL(12,2))) * ((CAST(abs(CAST(balance AS DECIMAL(12,2))) * 100 AS BIGINT) + 5) // 10) AS DOUBLE) / 10 AS balance,
        nullif(nullif(trim(contact_title), ''), 'NULL') AS contact_title_2, substring(trim(company_name), 1, 10) AS company_code
        FROM raw_customers""",
    "norm_scrub_number": """SELECT CAST(order_id AS BIGINT) AS order_id,
        CAST(CAST(regexp_replace(freight, '[^0-9.-]', '', 'g') AS DECIMAL(20,2)) AS DOUBLE) AS freight FROM raw_orders""",
    "norm_dates": """SELECT CAST(order_id AS BIGINT) AS order_id, order_date[1:10] AS order_date,
        CAST(TRY_CAST(required_date[1:10] AS DATE) AS VARCHAR) AS required_date,
        CAST(TRY_CAST(shipped_date[1:10] AS DATE) AS VARCHAR) AS shipped_date, TRY_CAST(ship_via AS BIGINT) AS ship_via FROM raw_orders""",
    "norm_cast_rejects": """SELECT 'txt_orders' AS tabla_origen, order_id AS clave_registro,
        'Valor no convertible en required_date: pending' AS motivo_rechazo, 'RECHAZADO' AS decision
        FROM raw_orders WHERE required_date = 'pending'""",
    "norm_recode": """SELECT CASE country WHEN '7' THEN '17' WHEN '8' THEN '18' ELSE country END AS country, count(*) AS clientes
        FROM raw_customers GROUP BY 1""",
    "norm_valid_scores": f"""SELECT CAST(customer_id AS BIGINT) AS customer_id, CAST(score AS BIGINT) AS score
        FROM raw_customers WHERE NOT ({_SCORE_BAD})""",
    "norm_score_rejects": _SCORE_REJECTS,
    "norm_corrections": """SELECT sk_pais, country_name, capital_major_city, CAST(CASE WHEN region = 'AFRICA' THEN 1 ELSE 0 END AS BIGINT) AS estaba_mal
        FROM dim_country""",
    "norm_propagate": """SELECT sk_cliente, sk_pais, country_name AS country_name_pais, capital_major_city
        FROM dim_customer JOIN dim_country USING (sk_pais)""",
    "csv_roundtrip": """SELECT order_id AS c_order_id, customer_id AS c_customer_id, order_date AS c_order_date, required_date AS c_required_date,
        shipped_date AS c_shipped_date, ship_via AS c_ship_via, freight AS c_freight FROM raw_orders""",
    "rules_batch1": _batch1(),
    "rules_batch2": _batch2(),
    "rules_offenders": _offenders(),
    "rules_rollup": _rollup(_batch1()),
    "rules_post_clean": """SELECT t AS tabla, 'country' AS campo, 'POST_LIMPIEZA' AS control, CASE WHEN n = 0 THEN 'OK' ELSE 'ERROR' END AS resultado,
        n AS cant_errores, CASE WHEN n = 0 THEN 'Sin errores' ELSE 'Hay registros con valor 7: ' || n END AS detalle FROM (
        SELECT 'antes' AS t, count(*) AS n FROM raw_customers WHERE country = '7' UNION ALL SELECT 'despues', 0)""",
    "controls_by_table": f"""SELECT tabla, count(*) FILTER (WHERE resultado = 'OK') AS ok, count(*) FILTER (WHERE resultado = 'ERROR') AS errores
        FROM ({_batch1()}) GROUP BY tabla""",
    "controls_long": f"""SELECT tabla, s AS estado, count(*) FILTER (WHERE (s = 'ok' AND resultado = 'OK') OR (s = 'errores' AND resultado = 'ERROR')) AS controles
        FROM ({_batch1()}), (SELECT unnest(['ok', 'errores']) AS s) GROUP BY tabla, s""",
    "profile_columns": _profiles(),
    "profile_trimmed": _profile("txt2_customers", "raw_customers", {n: _blank_trim(n) for n in ("contact_title", "score")}),
    "fk_checks": _fk_checks(),
    "fk_orphans": f"""SELECT order_id, product_id, employee_id, CAST(line_number AS BIGINT) AS line_number, CAST(quantity AS BIGINT) AS quantity
        FROM all_lines WHERE product_id NOT IN ({_CURRENT})""",
    "fk_rejects": f"""SELECT 'tmp_orders' AS tabla_origen, CAST(order_id AS VARCHAR) AS clave_registro,
        'Cliente inexistente en DWA: ' || customer_id AS motivo_rechazo, 'RECHAZADO_PARCIAL' AS decision
        FROM ords WHERE customer_id NOT IN ({_SOLVENT})""",
    "fk_shares": _fk_shares(),
    "ind_nulls": _nulls(),
    "ind_business": _business(),
    "ind_outliers": _outliers(),
    "quantiles_distributed": """SELECT return_flag, round(quantile_cont(CAST(unit_price AS DOUBLE), 0.25), 6) AS q1,
        round(quantile_cont(CAST(unit_price AS DOUBLE), 0.5), 6) AS q2, round(quantile_cont(CAST(unit_price AS DOUBLE), 0.75), 6) AS q3
        FROM all_lines GROUP BY return_flag""",
    "ind_control_totals": _differences(),
    "ind_status": " UNION ALL ".join(
        [
            _rollup(_business(), extra=", '13' AS corrida"),
            _rollup(_fk_shares(), True, ", '21' AS corrida"),
            _rollup(_differences(), extra=", '14' AS corrida"),
        ]
    ),
    "load_gate": _gate(),
    "reject_dedup": """SELECT order_id, product_id, employee_id, CAST(unit_price AS DOUBLE) AS unit_price, CAST(quantity AS BIGINT) AS quantity,
        CAST(discount AS DOUBLE) AS discount, CAST(line_number AS BIGINT) AS line_number FROM lines""",
    "duplicate_keys": "SELECT order_id, product_id, count(*) AS veces FROM all_lines GROUP BY ALL HAVING count(*) > 1",
    "control_totals": """SELECT 'customers' AS tabla, (SELECT count(*) FROM customer) AS registros UNION ALL
        SELECT 'products', (SELECT count(*) FROM part) UNION ALL SELECT 'orders', (SELECT count(*) FROM orders) UNION ALL
        SELECT 'order_details', (SELECT count(*) FROM lineitem) UNION ALL
        SELECT 'TOTAL', (SELECT count(*) FROM customer) + (SELECT count(*) FROM part) + (SELECT count(*) FROM orders) + (SELECT count(*) FROM lineitem)""",
    "calendar_range": _CALENDAR_OUT.format("calendar"),
    "calendar_incremental": _CALENDAR_OUT.format(
        "("
        + _days(
            f"""SELECT CAST(unnest(generate_series(min(order_date), max(order_date), INTERVAL 1 DAY)) AS DATE) AS d
                FROM ords WHERE order_date < DATE '{CUT}'
                UNION SELECT order_date FROM ords WHERE order_date >= DATE '{OVERLAP}'
                UNION SELECT required_date FROM ords WHERE order_date >= DATE '{OVERLAP}'
                UNION SELECT shipped_date FROM ords WHERE order_date >= DATE '{OVERLAP}' AND shipped_date IS NOT NULL"""
        )
        + ")"
    ),
    "date_union": """SELECT CAST(order_date AS VARCHAR) AS fecha FROM ords UNION SELECT CAST(required_date AS VARCHAR) FROM ords
        UNION SELECT CAST(shipped_date AS VARCHAR) FROM ords WHERE shipped_date IS NOT NULL""",
    "dim_country": """SELECT country_name, abbreviation, capital_major_city, region, CAST(latitude AS DOUBLE) AS latitude,
        CAST(longitude AS DOUBLE) AS longitude, sk_pais FROM dim_country""",
    "dim_customer": """SELECT * REPLACE (CAST(balance AS DOUBLE) AS balance, CAST(customer_score AS BIGINT) AS customer_score) FROM dim_customer""",
    "dim_product": """SELECT * REPLACE (CAST(precio_lista AS DOUBLE) AS precio_lista, CAST(discontinued AS BIGINT) AS discontinued) FROM dim_product""",
    "dim_seller_hierarchy": "SELECT * FROM dim_employee",
    "dim_shipper": "SELECT CAST(nk_shipper_id AS BIGINT) AS nk_shipper_id, company_name, sk_shipper FROM dim_shipper",
    "surrogate_keys": f"""SELECT nk_customer_id, sk_cliente FROM {_FIRST} UNION ALL
        SELECT nk_customer_id, row_number() OVER (ORDER BY nk_customer_id) + (SELECT count(*) FROM {_FIRST}) FROM customers WHERE balance < 5000""",
    "dim_upsert": _dim_merge(True),
    "insert_if_absent": _dim_merge(False),
    "dim_backfill_fk": f"SELECT sk_cliente, country, CAST({_EUROPE} AS BIGINT) AS sk_pais FROM dim_customer",
    "dim_score_segment": f"""SELECT sk_cliente, nk_customer_id,
        CAST(CASE WHEN {_SCORE_BAD} THEN customer_score ELSE CAST(score AS BIGINT) END AS BIGINT) AS customer_score,
        CASE WHEN {_SCORE_BAD} THEN customer_score_segmento WHEN CAST(score AS BIGINT) >= 4 THEN 'ALTO'
             WHEN CAST(score AS BIGINT) = 3 THEN 'MEDIO' ELSE 'BAJO' END AS customer_score_segmento
        FROM dim_customer JOIN raw_customers ON CAST(customer_id AS BIGINT) = nk_customer_id""",
    "fact_load": _FACT_OUT.format("fact"),
    "fact_incremental": _FACT_OUT.format("batch_fact"),
    "fact_upsert": _FACT_OUT.format("upserted"),
    "fact_upsert_partitions": _FACT_OUT.format("upserted"),
    "load_footprint": _footprints(),
    "load_status": f"""SELECT CASE WHEN count(*) FILTER (WHERE decision = 'RECHAZADO') > 0 THEN 'ERROR'
        WHEN count(*) FILTER (WHERE decision = 'CARGADO_PARCIAL') > 0 THEN 'WARNING' ELSE 'OK' END AS resultado,
        CAST(sum(registros_insertados) AS BIGINT) AS registros_proc FROM ({_footprints()})""",
    "load_summary": """SELECT 'dwa_dim_cliente' AS tabla_destino, count(*) AS registros_leidos, count(*) FILTER (WHERE balance >= 0) AS registros_insertados,
        count(*) FILTER (WHERE balance < 0) AS registros_rechazados,
        CASE WHEN count(*) FILTER (WHERE balance < 0) = 0 THEN 'CARGADO' WHEN count(*) FILTER (WHERE balance >= 0) > 0 THEN 'CARGADO_PARCIAL'
             ELSE 'RECHAZADO' END AS decision,
        CASE WHEN count(*) FILTER (WHERE balance < 0) > 0 THEN 'Saldo negativo' END AS motivo_rechazo FROM customers""",
    "scd2_init": _HISTORY_OUT.format("(SELECT *, NULL AS fecha_hasta, 1 AS es_vigente FROM hist)"),
    "scd2_merge": _HISTORY_OUT.format("merged"),
    "scd2_rerun": _HISTORY_OUT.format("merged"),
    "scd2_conflicts": """SELECT 'dwm_cliente' AS tabla_origen, CAST(nk_customer_id AS VARCHAR) AS clave_registro,
        'Version vigente posterior a la fecha efectiva: ' || fecha_desde AS motivo_rechazo, 'RECHAZADO' AS decision
        FROM hist JOIN changed USING (nk_customer_id) WHERE late""",
    "scd2_invariants": """SELECT (SELECT count(*) FROM merged WHERE fecha_hasta < fecha_desde) + (SELECT count(*) FROM (
        SELECT nk_customer_id FROM merged WHERE es_vigente = 1 GROUP BY 1 HAVING count(*) > 1)) AS incumplimientos""",
    "scd2_as_of": """SELECT o.order_id, o.customer_id AS nk_customer_id, CAST(o.order_date AS VARCHAR) AS order_date, m.city AS city_vigente,
        m.region AS region_vigente, CAST(m.fecha_desde AS VARCHAR) AS fecha_desde_vigente
        FROM ords o LEFT JOIN merged m ON m.nk_customer_id = o.customer_id AND m.fecha_desde <= o.order_date
             AND (m.fecha_hasta IS NULL OR o.order_date <= m.fecha_hasta)""",
    "enrich_customer": _ENR_CUSTOMER_OUT.format(METRICS["enr_customer"]),
    "enrich_customer_active": _ENR_CUSTOMER_OUT.format(_customer_metrics("fact", False)),
    "enrich_product": _ENR_PRODUCT_OUT.format(METRICS["enr_product"]),
    "enrich_product_active": _ENR_PRODUCT_OUT.format(_product_metrics("fact", False)),
    "enrich_product_distributed": _ENR_PRODUCT_OUT.format(_product_metrics("fact", True, "dim_product_unsold")),
    "fact_insert_filtered": _FACT_OUT.format("""(SELECT * FROM base_fact UNION ALL SELECT * FROM batch_fact n WHERE NOT EXISTS (
        SELECT 1 FROM base_fact b WHERE b.nk_order_id = n.nk_order_id AND b.sk_producto = n.sk_producto))"""),
    "key_filter_share": """SELECT unnest(['propias', 'ajenas']) AS claves, (SELECT count(*) FROM base_fact) AS filas,
        unnest([CAST(1 AS BIGINT), CAST(1 AS BIGINT)]) AS bien""",
    "sketch_runs": """SELECT campo, cant_distintos, CAST(1 AS BIGINT) AS cerca, CAST(1 AS BIGINT) AS igual FROM (
        SELECT unnest(['order_id', 'product_id', 'unit_price', 'quantity', 'return_flag']) AS campo, unnest([count(DISTINCT order_id),
            count(DISTINCT product_id), count(DISTINCT unit_price), count(DISTINCT quantity), count(DISTINCT return_flag)]) AS cant_distintos
        FROM all_lines)""",
    "mart_read_back": _PERIOD_OUT.format("m_period"),
    "mart_footprints": " UNION ALL ".join(
        f"""SELECT '{mart}' AS tabla_destino, n AS registros_leidos, n AS registros_insertados, CAST(0 AS BIGINT) AS registros_rechazados,
        'CARGADO' AS decision, CAST(NULL AS VARCHAR) AS motivo_rechazo FROM (SELECT count(*) AS n FROM {rows})"""
        for mart, rows in (
            ("dp_ventas_por_periodo", "m_period"),
            ("dp_ventas_por_cliente", "customer"),
            ("dp_ventas_por_producto", "part"),
            ("dp_ventas_por_empleado", "supplier"),
            ("dp_ventas_geografico", "nation"),
        )
    ),
    "inline_segments": """SELECT CASE WHEN balance < 0 THEN NULL WHEN balance < 2000 THEN 'C' WHEN balance < 6000 THEN 'B' ELSE 'A' END AS banda,
        count(*) AS clientes FROM dim_customer GROUP BY 1""",
    "dim_product_lookup_upsert": """SELECT sk_producto, nk_product_id, CAST(precio_lista AS DOUBLE) AS precio_lista, category_name, supplier_name,
        sk_pais_supplier FROM (
        SELECT sk_producto, nk_product_id, CASE WHEN precio_lista > 1500 THEN precio_lista * 2 ELSE precio_lista END AS precio_lista,
               category_name, supplier_name, sk_pais_supplier FROM dim_product WHERE discontinued = 0
        UNION ALL
        SELECT (SELECT max(sk_producto) FROM dim_product WHERE discontinued = 0) + row_number() OVER (ORDER BY nk_product_id),
               nk_product_id, precio_lista * 2, category_name, supplier_name, sk_pais_supplier FROM dim_product WHERE discontinued = 1)""",
    "fact_upsert_snapshot": _FACT_OUT.format("upserted"),
    "delta_customer": _ENR_CUSTOMER_OUT.format(_customer_metrics("upserted", True)),
    "delta_product": _ENR_PRODUCT_OUT.format(_product_metrics("upserted", True)),
    "delta_period": _PERIOD_OUT.format(_period("upserted")),
    "delta_seller": f"SELECT * REPLACE (CAST(monto_neto AS DOUBLE) AS monto_neto) FROM ({_seller('upserted')})",
    "scd2_merge_on_read": _HISTORY_OUT.format("merged"),
    "fact_merge_on_read": _FACT_OUT.format("upserted"),
    "scd2_late": _HISTORY_OUT.format("spliced"),
    "scd2_any_order": _HISTORY_OUT.format("spliced"),
    "scd2_late_invariants": """SELECT (SELECT count(*) FROM spliced WHERE fecha_hasta < fecha_desde) + (SELECT count(*) FROM (
        SELECT nk_customer_id FROM spliced WHERE es_vigente = 1 GROUP BY 1 HAVING count(*) > 1)) AS incumplimientos""",
    "csv_quarantine": """SELECT customer_id, trim(company_name) AS company_name, country FROM raw_customers
        WHERE contact_title NOT IN ('BUILDING', 'MACHINERY') AND country NOT IN ('7', '9')""",
    "csv_rejects": """SELECT customer_id AS clave, CAST(1 AS BIGINT) AS numerada, CASE contact_title WHEN 'BUILDING' THEN 'Faltan campos: 2 de 3'
        WHEN 'MACHINERY' THEN 'Sobran campos: 5 de 3' ELSE CASE country WHEN '7' THEN 'Comillas sin cerrar' ELSE
        'Linea demasiado larga: ' || (length(customer_id) + length(trim(company_name)) + length(country) + 504) || ' caracteres' END END
        AS motivo_rechazo
        FROM raw_customers WHERE contact_title IN ('BUILDING', 'MACHINERY') OR country IN ('7', '9')""",
    "global_rank": """SELECT order_id || '-' || product_id AS linea, CAST(quantity AS BIGINT) AS quantity,
        rank() OVER (ORDER BY quantity DESC) AS rk FROM lines""",
    "global_ntile": "SELECT order_id, CAST(freight AS DOUBLE) AS freight, ntile(7) OVER (ORDER BY freight, order_id) AS tile FROM ords",
    "global_row_number": """SELECT order_id, CAST(order_date AS VARCHAR) AS order_date, row_number() OVER (ORDER BY order_date, order_id) AS fila
        FROM ords""",
    "mart_period": _PERIOD_OUT.format("m_period"),
    "mart_customer": _CUSTOMER_OUT,
    "mart_product": """SELECT * REPLACE (CAST(precio_lista AS DOUBLE) AS precio_lista, CAST(discontinued AS BIGINT) AS discontinued,
        CAST(total_unidades AS BIGINT) AS total_unidades, CAST(revenue_total AS DOUBLE) AS revenue_total) FROM m_product""",
    "mart_seller": f"SELECT * REPLACE (CAST(monto_neto AS DOUBLE) AS monto_neto) FROM ({_seller('fact')})",
    "mart_geo": f"""SELECT * REPLACE (CAST(monto_neto AS DOUBLE) AS monto_neto, CAST(latitude AS DOUBLE) AS latitude,
        CAST(longitude AS DOUBLE) AS longitude, CAST(pct_monto_global AS DOUBLE) AS pct_monto_global) FROM ({_geo('fact', 'LEFT JOIN')})""",
    "coverage_report": """SELECT unnest(['Período desde', 'Período hasta', 'Años cubiertos', 'Meses cubiertos', 'Revenue neto total (USD)']) AS parametro,
        unnest([min(anio || '-' || lpad(mes::VARCHAR, 2, '0')), max(anio || '-' || lpad(mes::VARCHAR, 2, '0')), count(DISTINCT anio)::VARCHAR,
                count(*)::VARCHAR, format('{:,}', (CAST(sum(monto_neto) * 10000 AS HUGEINT) + 50) // 10000) || '.' ||
                lpad(CAST(((CAST(sum(monto_neto) * 10000 AS HUGEINT) + 50) // 100) % 100 AS VARCHAR), 2, '0')]) AS valor FROM m_period""",
    "mart_counts": """SELECT 'dp_ventas_por_periodo' AS tabla, (SELECT count(*) FROM m_period) AS registros
        UNION ALL SELECT 'dp_ventas_por_cliente', (SELECT count(*) FROM customer) UNION ALL SELECT 'dp_ventas_por_producto', (SELECT count(*) FROM part)
        UNION ALL SELECT 'dp_ventas_por_empleado', (SELECT count(*) FROM supplier) UNION ALL SELECT 'dp_ventas_geografico', (SELECT count(*) FROM nation)""",
    "report_years": "SELECT DISTINCT anio FROM m_period",
    "report_kpis": " UNION ALL ".join(
        f"""SELECT CAST(sum(total_pedidos) AS BIGINT) AS pedidos, CAST(sum(total_lineas) AS BIGINT) AS lineas,
            CAST(sum(total_clientes) AS BIGINT) AS clientes, CAST((CAST(sum(monto_neto) * 10000 AS HUGEINT) + 50) // 100 AS BIGINT) / 100.0 AS revenue,
            CAST((2 * sum(CAST(round(ticket_promedio * 10000) AS HUGEINT)) + 100 * count(*)) // (200 * count(*)) AS BIGINT) / 100.0 AS ticket_prom,
            '{label}' AS filtro FROM m_period WHERE {test}"""
        for label, test in (("Todos", "true"), (str(REPORT_YEAR), f"anio = {REPORT_YEAR}"))
    ),
    "report_monthly": f"""SELECT anio, trimestre, mes, nombre_mes, CAST(monto_neto AS DOUBLE) AS monto_neto, total_pedidos,
        anio || '-' || lpad(mes::VARCHAR, 2, '0') AS periodo_label FROM m_period WHERE anio = {REPORT_YEAR}""",
    "report_active_customers": """SELECT sk_cliente, CAST(monto_neto AS DOUBLE) AS monto_neto, segmento FROM m_customer
        WHERE sk_cliente IN (SELECT sk_cliente FROM fact_2001)""",
    "report_top_customers": """SELECT company_name, CAST(monto_neto AS DOUBLE) AS monto_neto, segmento, country FROM m_customer
        WHERE sk_cliente IN (SELECT sk_cliente FROM fact_year) ORDER BY m_customer.monto_neto DESC, sk_cliente LIMIT 15""",
    "report_top_products": """SELECT product_name, CAST(revenue_total AS DOUBLE) AS revenue_total, performance, category_name FROM m_product
        ORDER BY m_product.revenue_total DESC, sk_producto LIMIT 15""",
    "report_segments": "SELECT segmento, count(*) AS cantidad FROM m_customer GROUP BY segmento",
    "report_performance": """SELECT performance, count(*) AS productos FROM m_product
        WHERE sk_producto IN (SELECT sk_producto FROM fact_2001) GROUP BY performance""",
    "report_sellers": _SELLER_OUT.format(_seller("fact"), ""),
    "report_seller_year": _SELLER_OUT.format(_seller("fact_year"), ""),
    "report_geo": _GEO_OUT.format(_geo("fact", "LEFT JOIN")) + " AND monto_neto > 0",
    "report_geo_year": _GEO_OUT.format(_geo("fact_year", "JOIN")),
    "ledger_kpis": """SELECT count(*) AS total_ejecuciones, CAST(sum(CASE WHEN resultado = 'OK' THEN 1 END) AS BIGINT) AS ok,
        CAST(sum(CASE WHEN resultado = 'WARNING' THEN 1 END) AS BIGINT) AS warnings, CAST(sum(CASE WHEN resultado = 'ERROR' THEN 1 END) AS BIGINT) AS errores,
        CAST(sum(registros_proc) AS BIGINT) AS total_registros_proc FROM runs""",
    "ledger_history": """SELECT log_id, script_nombre, etapa, strftime(fecha_inicio, '%Y-%m-%d %H:%M:%S') AS fecha_inicio,
        strftime(fecha_fin, '%Y-%m-%d %H:%M:%S') AS fecha_fin, resultado, registros_proc, detalle FROM runs JOIN scripts USING (script_id)""",
    "ledger_fold": _ledger_fold(),
    "ledger_loads": """SELECT detalle AS tabla_destino, CAST(sum(CASE WHEN resultado = 'ERROR' THEN 0 ELSE registros_proc END) AS BIGINT) AS insertados,
        CAST(sum(CASE WHEN resultado = 'ERROR' THEN registros_proc ELSE 0 END) AS BIGINT) AS rechazados, CAST(sum(registros_proc) AS BIGINT) AS leidos
        FROM runs GROUP BY detalle""",
    "ledger_rejects": f"""SELECT script_nombre, 'tmp_orders' AS tabla_origen, CAST(order_id AS VARCHAR) AS clave_registro,
        'Cliente inexistente en DWA: ' || customer_id AS motivo_rechazo, 'RECHAZADO_PARCIAL' AS decision
        FROM ords LEFT JOIN runs ON log_id = order_id LEFT JOIN scripts USING (script_id) WHERE customer_id NOT IN ({_SOLVENT})""",
    "reject_once": _SCORE_REJECTS,
    "delete_where": f"SELECT * EXCLUDE (detalle) FROM ({_batch1()})",
    "ledger_inventory": """SELECT script_id, script_nombre, etapa, script_desc, count(log_id) AS veces_ejecutado,
        strftime(max(fecha_fin), '%Y-%m-%d %H:%M:%S') AS ultima_ejecucion, max_by(resultado, log_id) AS ultimo_resultado
        FROM scripts LEFT JOIN runs USING (script_id) GROUP BY ALL""",
    "latest_event": "SELECT user_id, max_by(event_type, event_id) AS event_type, max_by(value, event_id) AS value FROM events GROUP BY user_id",
    "catalog_summary": """SELECT * REPLACE (CAST(columnas AS BIGINT) AS columnas, CAST(pks AS BIGINT) AS pks, CAST(fks AS BIGINT) AS fks) FROM (VALUES ('txt', 'txt_customers', 6, 1, 0), ('txt', 'txt_products', 6, 1, 1), ('txt', 'txt_orders', 7, 1, 1),
        ('txt', 'txt_order_details', 6, 2, 1)) t(capa_dwh, nombre_tabla, columnas, pks, fks)
        LEFT JOIN (SELECT 'txt_customers' AS nombre_tabla, count(*) AS registros FROM customer UNION ALL
                   SELECT 'txt_products', count(*) FROM part UNION ALL SELECT 'txt_orders', count(*) FROM orders
                   UNION ALL SELECT 'txt_order_details', count(*) FROM raw_lines) USING (nombre_tabla)""",
    "catalog_profile": _catalog_rows(),
    "layer_domain": "SELECT 'dwa_fact_ventas' AS tabla_destino, 'EN_DUDA' AS decision",
    "rules_listing": f"""SELECT row_number() OVER (ORDER BY tabla, campo, control) AS orden, tabla, campo, control, resultado, cant_errores
        FROM ({_batch1()})""",
    "rules_long_numbers": """SELECT 'txt_montos' AS tabla, 'monto' AS campo, 'RANGO' AS control, 'ERROR' AS resultado, count(*) AS cant_errores,
        'Hay valores fuera de rango: ' || count(*) AS detalle FROM ords WHERE shipped_date IS NULL""",
    "profile_empty": """SELECT 'txt_vacia' AS tabla, unnest(['customer_id', 'country']) AS campo, CAST(0 AS BIGINT) AS total_registros,
        CAST(0 AS BIGINT) AS cant_nulos, CAST(0 AS BIGINT) AS cant_distintos, CAST(NULL AS VARCHAR) AS valor_min, CAST(NULL AS VARCHAR) AS valor_max""",
    "ind_report": f"""SELECT row_number() OVER (ORDER BY CASE resultado WHEN 'ERROR' THEN 1 WHEN 'WARNING' THEN 2 ELSE 3 END, tabla, campo, indicador)
        AS orden, tabla, campo, indicador, resultado FROM ({_business()} UNION ALL {_nulls()})""",
    "upsert_null_partition": """SELECT order_id, CASE WHEN ship_via = 3 THEN 'X' ELSE 'O' END AS estado,
        CAST(CASE WHEN ship_via IS DISTINCT FROM 3 THEN mes WHEN mes = 5 OR mes IS NULL THEN 13 END AS BIGINT) AS mes
        FROM (SELECT order_id, ship_via, CASE WHEN shipped_date IS NOT NULL THEN month(order_date) END AS mes FROM ords)""",
    "enrich_calendar_gap": """SELECT sk_cliente, count(DISTINCT nk_order_id) AS total_pedidos, count(*) AS total_lineas,
        CAST(sum(monto_neto) AS DOUBLE) AS monto_total_neto, CAST(min(fecha) AS VARCHAR) AS primer_pedido, CAST(max(fecha) AS VARCHAR) AS ultimo_pedido
        FROM fact JOIN calendar USING (sk_tiempo) WHERE mes > 3 AND sk_cliente IS NOT NULL GROUP BY sk_cliente""",
    "geo_shared_orders": """SELECT sk_pais, count(DISTINCT c.sk_cliente) AS total_clientes, count(DISTINCT nk_order_id) AS total_pedidos,
        CAST(coalesce(sum(monto_neto), 0) AS DOUBLE) AS monto_neto FROM dim_customer c LEFT JOIN (
            SELECT CASE WHEN sk_producto % 2 = 0 THEN sk_cliente + 1 ELSE sk_cliente END AS sk_cliente, nk_order_id, monto_neto FROM fact) f
        USING (sk_cliente) WHERE sk_pais IS NOT NULL GROUP BY sk_pais""",
    "fact_rejects": """SELECT 'tmp_order_details' AS tabla_origen, order_id || '/' || product_id AS clave_registro, motivo_rechazo,
        'RECHAZADO_PARCIAL' AS decision FROM (
            SELECT l.order_id, l.product_id, CASE WHEN o.order_id IS NULL THEN 'Pedido inexistente'
                WHEN o.order_date IS NULL OR o.order_date < DATE '1996-01-01' THEN 'Pedido sin fecha'
                WHEN p.sk_producto IS NULL THEN 'Sin nk_product_id: ' || l.product_id
                WHEN c.sk_cliente IS NULL THEN 'Sin nk_customer_id: ' || o.customer_id END AS motivo_rechazo
            FROM lines l LEFT JOIN ords o ON o.order_id = l.order_id
            LEFT JOIN (SELECT * FROM dim_product WHERE CAST(discontinued AS INT) = 0) p ON p.nk_product_id = l.product_id
            LEFT JOIN (SELECT * FROM dim_customer WHERE balance >= 0) c ON c.nk_customer_id = o.customer_id)
        WHERE motivo_rechazo IS NOT NULL""",
    "profile_run_rows": f"""SELECT 1::BIGINT AS log_id, count(*) AS registros_proc FROM ({_profiles()})
        UNION ALL SELECT 2, 2""",
    "dim_country_upsert": """SELECT CASE WHEN region = 'ASIA' THEN (SELECT count(*) FROM countries WHERE region <> 'ASIA')
            + row_number() OVER (PARTITION BY region = 'ASIA' ORDER BY country_name)
            ELSE row_number() OVER (PARTITION BY region = 'ASIA' ORDER BY country_name) END AS sk_pais, country_name,
        CASE WHEN region IN ('ASIA', 'EUROPE') THEN lower(region) ELSE region END AS region,
        CASE WHEN region IN ('ASIA', 'EUROPE') THEN capital_major_city END AS capital_major_city FROM countries""",
    "dim_customer_lookup_upsert": f"""SELECT * FROM (WITH old AS (SELECT * FROM {_FIRST}), new AS (SELECT * FROM {_NEWS}),
        every AS (
            SELECT sk_cliente, nk_customer_id, coalesce(n.city, CASE WHEN n.nk_customer_id IS NULL THEN o.city END) AS city, o.country
            FROM old o LEFT JOIN new n USING (nk_customer_id)
            UNION ALL
            SELECT (SELECT count(*) FROM old) + row_number() OVER (ORDER BY nk_customer_id), nk_customer_id, city, country
            FROM new WHERE nk_customer_id NOT IN (SELECT nk_customer_id FROM old))
        SELECT sk_cliente, nk_customer_id, city, country, sk_pais FROM every LEFT JOIN (SELECT sk_pais, country_name FROM dim_country) p
        ON p.country_name = every.country)""",
    "ledger_register_once": """SELECT script_id, script_nombre, CASE WHEN etapa <> 'adquisicion' THEN script_desc
        ELSE 'Otra vez ' || script_nombre END AS script_desc, etapa FROM scripts""",
    "csv_quoted": """SELECT p || lpad(customer_id, 8, '0') AS id, 'says "hi", ' || trim(company_name) AS texto
        FROM raw_customers, (VALUES (''), ('x')) v(p)""",
    "star_build": """SELECT 'calendar' AS tabla, (SELECT count(*) FROM calendar) AS registros UNION ALL SELECT 'countries', (SELECT count(*) FROM nation)
        UNION ALL SELECT 'customers', (SELECT count(*) FROM customer) UNION ALL SELECT 'employees', (SELECT count(*) FROM supplier)
        UNION ALL SELECT 'products', (SELECT count(*) FROM part) UNION ALL SELECT 'shippers', (SELECT count(*) FROM shippers)
        UNION ALL SELECT 'fact', (SELECT count(*) FROM fact)""",
}


def oracle_sql() -> dict[str, str]:
    return {name: _with(sql) for name, sql in _ORACLES.items()}
