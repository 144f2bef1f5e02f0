"""Every operator run over the given tables. Each entry has the shape (spark, directory) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, DecimalType, IntegerType, ShortType

from estrella.functions import numbers as num
from estrella.functions import text as txt
from estrella.operators import (
    calendar,
    catalog,
    deltas,
    dims,
    facts,
    history,
    indicators,
    integrity,
    keyfilter,
    ledger,
    marts,
    metrics,
    profile,
    ranking,
    rules,
    sketches,
    staging,
    upsert,
)
from estrella.plans import reports
from estrella.plans.sample import Source
from estrella.plans.star import (
    Star,
    build_star,
    country_dim,
    customer_dim,
    employee_dim,
    product_dim,
    star_of,
    write_fact,
)
from estrella.session import work_path
from estrella.sources import files
from estrella.sources.snapshots import Snapshots

CUT = "2000-01-01"
OVERLAP = "1999-07-01"
NO_SALES_DATE = "2000-06-30"
REPORT_YEAR = 1998
TRACKED = ["company_name", "city", "region", "country"]

Query = Callable[[SparkSession, str], DataFrame]
_registry: dict[str, Query] = {}


def query(fn: Callable[[Source], DataFrame]) -> Callable[[Source], DataFrame]:
    _registry[fn.__name__] = lambda spark, directory: portable(fn(Source(spark, directory)))
    return fn


def registry() -> dict[str, Query]:
    return dict(_registry)


def portable(df: DataFrame) -> DataFrame:
    """Types that compare equal across engines: double, bigint and text."""
    out = []
    for f in df.schema.fields:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DecimalType):
            column = column.cast("double")
        elif isinstance(f.dataType, (IntegerType, ShortType)):
            column = column.cast("bigint")
        elif isinstance(f.dataType, BooleanType):
            column = column.cast("int").cast("bigint")
        elif isinstance(f.dataType, DateType):
            column = column.cast("string")
        out.append(column.alias(f.name))
    return df.select(*out)


def star(src: Source) -> Star:
    return star_of(src.spark, src, src.directory)


def union(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# ---- staging ---------------------------------------------------------------------------------


@query
def norm_text_nulls(src: Source) -> DataFrame:
    """Both null rules of a batch on the same column, and a narrow rounding, in one pass."""
    raw = src.raw_customers().withColumns({"contact_title_2": F.col("contact_title"), "company_code": F.col("company_name")})
    return staging.stage(
        raw,
        [
            staging.Field("customer_id", "bigint"),
            staging.Field("company_name"),
            staging.Field("contact_title"),
            staging.Field("balance", "decimal(14,4)", via="decimal(12,1)"),
            staging.Field("contact_title_2", nulls=("", "NULL")),
            staging.Field("company_code", "char(10)"),
        ],
    )


@query
def norm_scrub_number(src: Source) -> DataFrame:
    return staging.stage(
        src.raw_orders(), [staging.Field("order_id", "bigint"), staging.Field("freight", "decimal(20,2)", scrub=True)]
    )


@query
def norm_dates(src: Source) -> DataFrame:
    return staging.stage(
        src.raw_orders(),
        [
            staging.Field("order_id", "bigint"),
            staging.Field("order_date", "date"),
            staging.Field("required_date", "date", nulls=("",), prefix_date=True),
            staging.Field("shipped_date", "date", nulls=("", "NULL"), prefix_date=True),
            staging.Field("ship_via", "int", nulls=("",)),
        ],
    )


@query
def norm_cast_rejects(src: Source) -> DataFrame:
    fields = [
        staging.Field("required_date", "date", nulls=("",), prefix_date=True),
        staging.Field("ship_via", "int", nulls=("",)),
    ]
    return staging.cast_rejects("txt_orders", src.raw_orders(), fields, ["order_id"])


@query
def norm_recode(src: Source) -> DataFrame:
    cleaned = src.raw_customers().withColumn("country", txt.recode(F.col("country"), {"7": "17", "8": "18"}))
    return cleaned.groupBy("country").agg(F.count(F.lit(1)).alias("clientes"))


@query
def norm_valid_scores(src: Source) -> DataFrame:
    ok, _ = _scores(src)
    return staging.stage(ok, [staging.Field("customer_id", "bigint"), staging.Field("score", "int")])


@query
def norm_score_rejects(src: Source) -> DataFrame:
    return _scores(src)[1]


def _scores(src: Source) -> tuple[DataFrame, DataFrame]:
    score = F.col("score")
    return staging.split_valid(
        "txt2_customers_score", src.raw_customers(), staging.valid_score(score), ["customer_id"], staging.score_reason(score)
    )


def _corrupt_countries(src: Source) -> DataFrame:
    broken = F.regexp_replace("capital_major_city", "N", txt.REPLACEMENT_CHARACTER)
    hurt = F.col("region") == "AFRICA"
    return country_dim(src).withColumn("capital_major_city", F.when(hurt, broken).otherwise(F.col("capital_major_city")))


@query
def norm_corrections(src: Source) -> DataFrame:
    broken = _corrupt_countries(src)
    fixes = src.countries().filter(F.col("region") == "AFRICA").select("country_name", "capital_major_city")
    fixed = staging.apply_corrections(broken, "country_name", fixes, ["capital_major_city"])
    flags = broken.select("country_name", txt.is_corrupt(F.col("capital_major_city")).alias("estaba_mal"))
    return fixed.select("sk_pais", "country_name", "capital_major_city").join(flags, "country_name")


@query
def norm_propagate(src: Source) -> DataFrame:
    s = star(src)
    stale = s.customers.select("sk_cliente", "sk_pais").join(
        _corrupt_countries(src).select("sk_pais", F.col("country_name").alias("country_name_pais"), "capital_major_city"),
        "sk_pais",
    )
    affected = s.countries.filter(F.col("region") == "AFRICA")
    return staging.propagate(
        stale, affected, "sk_pais", {"country_name_pais": "country_name", "capital_major_city": "capital_major_city"}
    )


@query
def csv_roundtrip(src: Source) -> DataFrame:
    raw = src.raw_orders()
    path = work_path(src.spark)
    files.write_raw_csv(raw, path, sep=";")
    return files.read_raw_csv(src.spark, path, [f"c_{n}" for n in raw.columns], sep=";")


@query
def csv_quoted(src: Source) -> DataFrame:
    """Comma files whose fields hold commas, quotes and leading zeros; a second write appends."""
    padded = F.lpad(F.col("customer_id"), 8, "0")
    raw = src.raw_customers().select(padded.alias("id"), F.concat(F.lit('says "hi", '), F.trim("company_name")).alias("texto"))
    path = work_path(src.spark)
    files.write_raw_csv(raw, path, sep=",")
    read = files.read_raw_csv(src.spark, path, ["id", "texto"], sep=",")
    table = work_path(src.spark)
    files.overwrite(read.limit(0), table)
    files.overwrite(read, table)
    files.append(read.withColumn("id", F.concat(F.lit("x"), F.col("id"))), table)
    return src.spark.read.parquet(table)


def _broken_csv(src: Source) -> str:
    """Customers as comma lines; some lack a field, have one too many, leave a quote open or are too long."""
    text = F.concat_ws(",", "customer_id", F.concat(F.lit('"'), F.trim("company_name"), F.lit('"')), "country")
    line = (
        F.when(F.col("contact_title") == "BUILDING", F.concat_ws(",", "customer_id", "country"))
        .when(F.col("contact_title") == "MACHINERY", F.concat(text, F.lit(",x,y")))
        .when(F.col("country") == "7", F.concat(text, F.lit('"')))
        .when(F.col("country") == "9", F.concat(text, F.repeat(F.lit("z"), 500)))
        .otherwise(text)
    )
    path = work_path(src.spark)
    # one file for every country, each with its header
    src.raw_customers().select(F.col("country").alias("p"), line.alias("value")).write.partitionBy("p").option("header", True).option(
        "quote", "\u0000"
    ).option("escapeQuotes", False).option("sep", "\u0001").csv(path)
    return f"{path}/*"


@query
def csv_quarantine(src: Source) -> DataFrame:
    """Good lines of files with bad ones."""
    good, _ = files.import_csv(src.spark, _broken_csv(src), ["customer_id", "company_name", "country"], longest=400)
    return good


@query
def csv_rejects(src: Source) -> DataFrame:
    """The bad lines with their reasons."""
    _, rejects = files.import_csv(src.spark, _broken_csv(src), ["customer_id", "company_name", "country"], longest=400)
    return rejects.select(F.substring_index("texto", ",", 1).alias("clave"), "motivo_rechazo", (F.col("linea") > 1).alias("numerada"))


# ---- rules and profiles ----------------------------------------------------------------------


def _rules_batch1(src: Source) -> list:
    return [
        (
            "txt_customers",
            src.raw_customers(),
            [
                rules.not_null("customer_id"),
                rules.unique(["customer_id"], "SIN_DUPLICADOS"),
                rules.length_is("customer_id", 3, "LONGITUD_3"),
                rules.not_null("contact_title"),
                rules.forbidden("country", "7"),
                rules.numeric("balance"),
                rules.unique(["country"], "SIN_DUPLICADOS"),
            ],
        ),
        (
            "txt_products",
            src.raw_products(),
            [
                rules.primary_key("product_id"),
                rules.primary_key("product_name"),
                rules.in_set("discontinued", ["0", "1"], "VALOR_0_O_1"),
                rules.castable_int("product_id"),
                rules.castable_int("unit_price"),
                rules.numeric_between("unit_price", 950, None, "PRECIO_MINIMO"),
            ],
        ),
        (
            "txt_orders",
            src.raw_orders(),
            [
                rules.date_prefix("order_date"),
                rules.date_prefix("required_date"),
                rules.date_prefix("shipped_date"),
                rules.int_or_null("ship_via"),
                rules.expected_nulls("shipped_date"),
                rules.numeric_between("freight", 0, None, "ES_NUMERICO_POSITIVO"),
            ],
        ),
        (
            "txt_order_details",
            src.raw_lines(),
            [
                rules.unique(["order_id", "product_id"], "PK_COMPUESTA_SIN_DUPLICADOS"),
                rules.numeric_between("discount", 0, 0.05, "RANGO_DESCUENTO", num.WARNING),
                rules.int_between("quantity", 1, None, "ENTERO_POSITIVO"),
                rules.in_set("return_flag", ["A", "N"], "VALOR_A_O_N"),
            ],
        ),
    ]


@query
def rules_batch1(src: Source) -> DataFrame:
    return rules.check_all(_rules_batch1(src))


@query
def rules_batch2(src: Source) -> DataFrame:
    return rules.check_all(
        [
            (
                "txt2_customers",
                src.raw_customers(),
                [
                    rules.length_is("customer_id", 3, "PK no nula y largo 3", needed=True),
                    rules.required("contact_title", "Titulo obligatorio"),
                    rules.int_between("score", 1, 5, "Score entre 1 y 5", trimmed=True),
                ],
            ),
            (
                "txt2_orders",
                src.raw_orders(),
                [
                    rules.numeric_key(["order_id"], "PK numerica no nula"),
                    rules.numeric_key(["ship_via"], "PK numerica no nula"),
                    rules.unique(["order_id"], "Duplicados de PK"),
                    rules.date_prefix("shipped_date", "Fecha valida", needed=True),
                ],
            ),
            (
                "txt2_order_details",
                src.raw_lines(),
                [
                    rules.numeric_key(["order_id", "unit_price"], "PK compuesta numerica"),
                    rules.unique(["order_id", "product_id"], "Duplicados de PK compuesta", joiner="/"),
                    rules.int_between("quantity", 1, None, "Cantidad positiva", trimmed=True),
                    rules.numeric_between("discount", 0, 1, "Descuento entre 0 y 1", trimmed=True),
                ],
            ),
            (
                "txt2_products",
                src.raw_products(),
                [rules.in_set("discontinued", ["0", "1"], "Flag 0/1", trimmed=True)],
            ),
        ]
    )


@query
def rules_offenders(src: Source) -> DataFrame:
    """Every bad row of every row rule with the value, in all four tables."""
    keys = {
        "txt_customers": ["customer_id"],
        "txt_products": ["product_id"],
        "txt_orders": ["order_id"],
        "txt_order_details": ["order_id", "product_id"],
    }
    return union(*[rules.offenders(name, df, keys[name], found) for name, df, found in _rules_batch1(src)])


@query
def rules_listing(src: Source) -> DataFrame:
    """Rule results in order, the place being a column."""
    return rules.listing(rules_batch1(src)).select("orden", "tabla", "campo", "control", "resultado", "cant_errores")


@query
def rules_long_numbers(src: Source) -> DataFrame:
    """Range rule over texts of which some are too long for any number type."""
    long = F.when(F.col("shipped_date").isNull(), F.concat(F.lit("1"), F.repeat(F.lit("0"), F.lit(40)))).otherwise(F.lit("5"))
    orders = src.orders().select("order_id", long.alias("monto"))
    return rules.check("txt_montos", orders, [rules.numeric_between("monto", 0, 10, "RANGO")])


@query
def rules_rollup(src: Source) -> DataFrame:
    return rules.roll_up(rules_batch1(src))


@query
def rules_post_clean(src: Source) -> DataFrame:
    checked = rules.forbidden("country", "7", "POST_LIMPIEZA", num.ERROR)
    cleaned = src.raw_customers().withColumn("country", txt.recode(F.col("country"), {"7": "17"}))
    before = rules.check("antes", src.raw_customers(), [checked])
    return union(before, rules.check("despues", cleaned, [checked]))


@query
def controls_by_table(src: Source) -> DataFrame:
    return ledger.controls_by_table(rules_batch1(src))


@query
def controls_long(src: Source) -> DataFrame:
    return ledger.controls_long(rules_batch1(src))


def _profiles(src: Source) -> DataFrame:
    return profile.profile_all(
        [
            (
                "txt_customers",
                src.raw_customers(),
                {"customer_id": ("",), "company_name": ("",), "contact_title": ("", "NULL"), "country": ("",), "balance": ("",)},
            ),
            (
                "txt_products",
                src.raw_products(),
                {"product_id": ("",), "product_name": ("",), "category_id": ("",), "unit_price": ("",), "discontinued": ("",)},
            ),
            (
                "txt_orders",
                src.raw_orders(),
                {"order_id": ("",), "customer_id": ("",), "order_date": ("NULL",), "shipped_date": ("NULL",), "ship_via": ("",)},
            ),
            ("txt_order_details", src.raw_lines(), {"quantity": (), "discount": (), "unit_price": ()}),
        ]
    )


@query
def profile_columns(src: Source) -> DataFrame:
    return profile.listing(_profiles(src))


@query
def sketch_runs(src: Source) -> DataFrame:
    """Sketches of two runs: their merge is the sketch of all rows, and close to the exact distinct counts."""
    columns = ["order_id", "product_id", "unit_price", "quantity", "return_flag"]
    lines = src.all_lines().select(*columns)
    returned = F.col("return_flag") == "R"
    path = work_path(src.spark)
    runs = [files.overwrite(sketches.sketch(lines.filter(test), columns), f"{path}/{i}") for i, test in enumerate((returned, ~returned))]
    merged = sketches.merge(*runs)
    whole = sketches.sketch(lines, columns).withColumnRenamed("peso", "_peso")
    same = merged.join(whole, ["campo", "clase", "casilla"], "full_outer").groupBy("campo").agg(
        F.min(F.col("peso").eqNullSafe(F.col("_peso"))).alias("igual")
    )
    exact = profile.profile("tmp_order_details", lines, {c: () for c in columns}).select("campo", "cant_distintos")
    near = F.abs(F.col("distintos") - F.col("cant_distintos")) <= 0.06 * F.col("cant_distintos")
    return same.join(sketches.distinct_counts(merged), "campo").join(exact, "campo").select("campo", "cant_distintos", near.alias("cerca"), "igual")


@query
def profile_empty(src: Source) -> DataFrame:
    """An empty table has a row of zeros per column."""
    nobody = src.raw_customers().filter(F.col("customer_id") == "no such customer")
    return profile.profile("txt_vacia", nobody, {"customer_id": ("",), "country": ("",)})


@query
def profile_run_rows(src: Source) -> DataFrame:
    """Profile rows of one of two logged runs."""
    logged = union(_profiles(src).withColumn("log_id", F.lit(1)), profile_trimmed(src).withColumn("log_id", F.lit(2)))
    return union(*[profile.rows_of_run(logged, run).withColumn("log_id", F.lit(run)) for run in (1, 2)])


@query
def profile_trimmed(src: Source) -> DataFrame:
    wanted = {"contact_title": profile.BLANK_TRIMMED, "score": profile.BLANK_TRIMMED}
    return profile.profile("txt2_customers", src.raw_customers(), wanted)


# ---- integrity and indicators ----------------------------------------------------------------


def _solvent(src: Source) -> DataFrame:
    """Customers with no negative balance; orders of the others are orphans against this table."""
    return src.customers().filter(F.col("balance") >= 0)


def _foreign_keys(src: Source, together: bool = True) -> dict[str, integrity.ForeignKey]:
    current = src.products().filter(F.col("discontinued") == 0)
    known_countries = src.countries().filter(F.col("region") != "ASIA")
    senior = src.sellers().filter(F.col("country") < "NATION_5")
    fast = src.shippers().filter(F.col("nk_shipper_id") < 5)
    fk = integrity.ForeignKey
    orders, lines, products = src.orders(), src.all_lines(), src.products()
    checks = {
        "order_customer": fk("tmp_orders", orders, "customer_id", _solvent(src), "nk_customer_id", "order_id"),
        "order_shipper": fk("tmp_orders", orders, "ship_via", fast, "nk_shipper_id", "order_id"),
        "line_order": fk("tmp_order_details", lines, "order_id", orders, "order_id", "order_id"),
        "line_product": fk("tmp_order_details", lines, "product_id", current, "product_id", "product_id"),
        "product_category": fk("tmp_products", products, "category_id", src.categories(), "category_id", "product_id"),
        "product_brand": fk("tmp_products", products, "supplier_id", src.brands(), "supplier_id", "product_id"),
        "customer_country": fk("tmp_customers", src.customers(), "country", known_countries, "country_name", "nk_customer_id"),
        "seller_boss": fk("tmp_employees", src.sellers(), "reports_to", senior, "employee_id", "employee_id"),
    }
    return integrity.count_together(checks) if together else checks


@query
def fk_checks(src: Source) -> DataFrame:
    return integrity.check_foreign_keys(list(_foreign_keys(src).values()))


@query
def fk_orphans(src: Source) -> DataFrame:
    return _foreign_keys(src, together=False)["line_product"].orphans().select("order_id", "product_id", "employee_id", "line_number", "quantity")


@query
def fk_rejects(src: Source) -> DataFrame:
    return integrity.reject_orphans(_foreign_keys(src, together=False)["order_customer"], "Cliente inexistente en DWA: ")


@query
def fk_shares(src: Source) -> DataFrame:
    keys = _foreign_keys(src)
    discontinued = src.products().filter((F.col("discontinued") == 1) & (F.col("unit_price") > 950))
    line = keys["line_product"]
    either = integrity.ForeignKey(line.table, line.child, line.column, line.parent, line.parent_key, also=((discontinued, "product_id"),), counted=line.counted)
    share = indicators.foreign_key_share
    return union(
        share(keys["order_customer"], "PCT_FK_CLIENTE_INVALIDA", scale=4, null_is_orphan=True),
        share(keys["order_shipper"], "PCT_ORDER_SIN_SHIPPER"),
        share(keys["order_shipper"], "PCT_SHIPPER_O_NULO", scale=4, null_is_orphan=True),
        share(keys["order_shipper"], "PCT_SHIPPER_INFORMADO", scale=4, only_present=True),
        share(keys["line_order"], "PCT_OD_SIN_ORDER"),
        share(keys["line_product"], "PCT_OD_SIN_PRODUCTO"),
        share(either, "PCT_FK_PRODUCTO_INVALIDA", scale=4, null_is_orphan=True),
        share(keys["product_category"], "PCT_PROD_SIN_CATEGORY"),
        share(keys["product_brand"], "PCT_PROD_SIN_SUPPLIER"),
        share(keys["customer_country"], "PCT_CLIENTE_SIN_PAIS", warn=0, error=25),
        share(keys["seller_boss"], "PCT_REPORTS_TO_INVALIDO"),
    )


def _staged(src: Source) -> DataFrame:
    return src.customers().withColumn("contact_title", F.when(F.col("contact_title") != "BUILDING", F.col("contact_title")))


@query
def ind_nulls(src: Source) -> DataFrame:
    nulls = indicators.null_share
    return union(
        indicators.shares(
            "tmp_customers",
            _staged(src),
            [nulls("company_name"), nulls("contact_title", warn=10, error=30), nulls("country", warn=10, error=30)],
        ),
        indicators.shares(
            "tmp_orders", src.orders(), [nulls("order_date"), nulls("shipped_date"), nulls("ship_via / shipped_date", "ship_via", "shipped_date")]
        ),
        indicators.shares("tmp_employees", src.sellers(), [nulls("first_name / last_name", "first_name", "last_name")]),
    )


@query
def ind_business(src: Source) -> DataFrame:
    share = indicators.Share
    lines = src.all_lines()
    orders = src.orders().select("order_id", "order_date")
    shipped = lines.select("order_id", "ship_date").join(orders, "order_id", "left")
    return union(
        indicators.shares(
            "tmp_products",
            src.products(),
            [
                share("unit_price", "PCT_PRECIO_NEGATIVO", lambda: F.col("unit_price") < 0, 0, 1),
                share("unit_price", "PCT_PRECIO_BASE", lambda: (F.col("unit_price") == 900) & (F.col("discontinued") == 0), 0, 5),
                share("discontinued", "PCT_VALOR_INVALIDO", lambda: ~F.col("discontinued").isin(0, 1)),
            ],
        ),
        indicators.shares(
            "tmp_order_details",
            lines,
            [
                share("unit_price", "PCT_PRECIO_NEGATIVO", lambda: F.col("unit_price") < 0),
                share("unit_price", "PCT_PRECIO_CERO", lambda: F.col("unit_price") == 0, 1, 5),
                share("quantity", "PCT_CANTIDAD_INVALIDA", lambda: F.col("quantity") <= 0),
                share("discount", "PCT_DESCUENTO_INVALIDO", lambda: (F.col("discount") < 0) | (F.col("discount") > 0.05)),
            ],
        ),
        indicators.shares(
            "tmp_orders", shipped, [share("shipped_date", "PCT_SHIPPED_BEFORE_ORDER", lambda: F.col("ship_date") < F.col("order_date"), 0, 1)]
        ),
    )


@query
def ind_outliers(src: Source) -> DataFrame:
    outliers, column = indicators.Outliers, F.col
    present = lambda: column("freight").isNotNull()
    positive = lambda: column("unit_price") > 0
    sold = lambda: column("quantity") > 0
    return union(
        indicators.outlier_shares("tmp_customers", src.customers(), [outliers("balance", lambda: column("balance") > 0, width=0.5, lower=True)]),
        indicators.outlier_shares("tmp_orders", src.orders(), [outliers("freight", present, present, width=0.25)]),
        indicators.outlier_shares(
            "tmp_order_details", src.all_lines(), [outliers("unit_price", positive, positive, width=0.4), outliers("quantity", sold, sold)]
        ),
    )


@query
def quantiles_distributed(src: Source) -> DataFrame:
    """Exact quartiles of line amounts, per return flag."""
    found = ranking.quantiles(src.all_lines(), ["unit_price"], (0.25, 0.5, 0.75), by=["return_flag"])
    return found.select("return_flag", *[F.round(F.col("q")[i], 6).alias(f"q{i + 1}") for i in range(3)])


@query
def ind_report(src: Source) -> DataFrame:
    """Indicators worst first, the place being a column."""
    return indicators.report(union(ind_business(src), ind_nulls(src))).select("orden", "tabla", "campo", "indicador", "resultado")


@query
def ind_control_totals(src: Source) -> DataFrame:
    diff = indicators.count_difference
    return union(
        diff("tmp_orders", src.raw_orders(), src.orders()),
        diff("tmp_order_details", src.raw_lines(), src.lines()),
        diff("tmp_products", src.raw_products(), src.products()),
        diff("tmp_customers", src.raw_customers(), _solvent(src)),
    )


@query
def ind_status(src: Source) -> DataFrame:
    strict = rules.roll_up(ind_business(src)).withColumn("corrida", F.lit("13"))
    soft = rules.roll_up(fk_shares(src), soften=True).withColumn("corrida", F.lit("21"))
    return union(strict, soft, rules.roll_up(ind_control_totals(src)).withColumn("corrida", F.lit("14")))


@query
def load_gate(src: Source) -> DataFrame:
    """Blocking indicators of the latest run of each script, with the runs taken from events."""
    runs, scripts = _runs(src), _scripts(src)
    names = ["script_1", "script_2"]
    first = ind_business(src).withColumn("log_id", ledger.latest_run(runs, scripts, names[0]).scalar())
    second = fk_shares(src).withColumn("log_id", ledger.latest_run(runs, scripts, names[1]).scalar())
    return indicators.gate(union(first, second), runs, scripts, names)


@query
def reject_dedup(src: Source) -> DataFrame:
    """First line per order and product, where the source repeats the pair."""
    return src.lines().select("order_id", "product_id", "employee_id", "unit_price", "quantity", "discount", "line_number")


@query
def duplicate_keys(src: Source) -> DataFrame:
    return upsert.duplicate_keys(src.all_lines(), ["order_id", "product_id"])


@query
def control_totals(src: Source) -> DataFrame:
    return files.control_total(
        {"customers": src.raw_customers(), "products": src.raw_products(), "orders": src.raw_orders(), "order_details": src.raw_lines()}
    )


# ---- dimensions ------------------------------------------------------------------------------


@query
def calendar_range(src: Source) -> DataFrame:
    return calendar.calendar_range(src.orders(), "order_date", ["required_date", "shipped_date"])


@query
def calendar_incremental(src: Source) -> DataFrame:
    old = calendar.calendar_range(src.orders().filter(F.col("order_date") < CUT), "order_date")
    batch = src.orders().filter(F.col("order_date") >= OVERLAP)
    return calendar.add_missing_days(old, calendar.calendar_of_dates(batch, ["order_date", "required_date", "shipped_date"]))


@query
def date_union(src: Source) -> DataFrame:
    orders = src.orders()
    return calendar.union_dates(
        [orders.select(F.col(c).alias("fecha")).filter("fecha IS NOT NULL") for c in ("order_date", "required_date", "shipped_date")]
    )


@query
def dim_country(src: Source) -> DataFrame:
    return country_dim(src)


@query
def dim_customer(src: Source) -> DataFrame:
    return customer_dim(src, star(src).countries)


@query
def dim_product(src: Source) -> DataFrame:
    return product_dim(src, star(src).countries)


@query
def dim_seller_hierarchy(src: Source) -> DataFrame:
    return employee_dim(src)


@query
def dim_shipper(src: Source) -> DataFrame:
    return dims.load_dim(src.shippers(), "nk_shipper_id", "sk_shipper")


def _first_customers(src: Source) -> DataFrame:
    rich = src.customers().filter(F.col("balance") >= 5000).drop("balance")
    return upsert.assign_keys(None, rich, "nk_customer_id", "sk_cliente")


def _customer_news(src: Source) -> DataFrame:
    news = src.customers().filter(F.col("balance") < 6000).drop("balance")
    return news.withColumns({"contact_title": F.lower("contact_title"), "city": F.nullif(F.col("city"), F.lit("City 3"))})


@query
def surrogate_keys(src: Source) -> DataFrame:
    """Known customers keep their key, new ones continue after the highest."""
    return upsert.assign_keys(_first_customers(src), src.customers(), "nk_customer_id", "sk_cliente").select(
        "nk_customer_id", "sk_cliente"
    )


@query
def dim_upsert(src: Source) -> DataFrame:
    return dims.upsert_dim(
        _first_customers(src), _customer_news(src), "nk_customer_id", "sk_cliente", ["company_name", "contact_title", "city", "region", "country"]
    )


@query
def insert_if_absent(src: Source) -> DataFrame:
    return dims.load_dim(_customer_news(src), "nk_customer_id", "sk_cliente", _first_customers(src))


@query
def dim_country_upsert(src: Source) -> DataFrame:
    """Countries of a batch change known ones, come new, and bring a column the dimension lacks."""
    first = dims.load_dim(src.countries().filter(F.col("region") != "ASIA").drop("capital_major_city"), "country_name", "sk_pais")
    batch = src.countries().filter(F.col("region").isin("ASIA", "EUROPE")).withColumn("region", F.lower("region"))
    merged = dims.upsert_dim(first, batch, "country_name", "sk_pais", ["region", "capital_major_city"])
    return merged.select("sk_pais", "country_name", "region", "capital_major_city")


@query
def dim_customer_lookup_upsert(src: Source) -> DataFrame:
    """Changed and new customers with their country's key looked up, then missing keys filled."""
    place = star(src).countries.select(F.col("country_name").alias("country"), "sk_pais")
    known = _first_customers(src).join(place.filter(F.col("sk_pais") > 10), "country", "left")
    news = _customer_news(src).join(place.filter(F.col("sk_pais") > 5), "country", "left")
    merged = dims.upsert_dim(known, news, "nk_customer_id", "sk_cliente", ["company_name", "contact_title", "city", "region", "country", "sk_pais"])
    filled = dims.backfill_country(merged, place.withColumnRenamed("country", "country_name"), "country", "sk_pais")
    return filled.select("sk_cliente", "nk_customer_id", "city", "country", "sk_pais")


@query
def dim_product_lookup_upsert(src: Source) -> DataFrame:
    """New and dearer products with category, supplier and the supplier's country looked up."""
    s = star(src)
    known = s.products.filter(~F.col("discontinued"))
    flat = product_dim(src, s.countries).drop("sk_producto")
    news = flat.filter((F.col("precio_lista") > 1500) | F.col("discontinued"))
    news = news.withColumn("precio_lista", (F.col("precio_lista") * 2).cast("decimal(10,4)"))
    columns = [c for c in flat.columns if c != "nk_product_id"]
    merged = dims.upsert_dim(known, news, "nk_product_id", "sk_producto", columns)
    return merged.select("sk_producto", "nk_product_id", "precio_lista", "category_name", "supplier_name", "sk_pais_supplier")


@query
def inline_segments(src: Source) -> DataFrame:
    """Customers by a small table that is written in the program."""
    bands = files.inline_rows(src.spark, [(0, 2000, "C"), (2000, 6000, "B"), (6000, 10**9, "A")], "desde long, hasta long, banda string")
    met = star(src).customers.join(F.broadcast(bands), (F.col("balance") >= F.col("desde")) & (F.col("balance") < F.col("hasta")), "left")
    return met.groupBy("banda").agg(F.count(F.lit(1)).alias("clientes"))


@query
def dim_backfill_fk(src: Source) -> DataFrame:
    s = star(src)
    partial = s.customers.withColumn("sk_pais", F.when(F.col("region") == "EUROPE", F.lit(-1)))
    return dims.backfill_country(partial, s.countries, "country", "sk_pais").select("sk_cliente", "country", "sk_pais")


@query
def dim_score_segment(src: Source) -> DataFrame:
    scores = norm_valid_scores(src)
    known = star(src).customers.select("sk_cliente", "nk_customer_id", "customer_score", "customer_score_segmento")
    return dims.attach_score(known, scores, ("nk_customer_id", "customer_id"))


# ---- facts -----------------------------------------------------------------------------------


@query
def fact_load(src: Source) -> DataFrame:
    s = star(src)
    return facts.load_fact(s.lines, src.orders(), s.keys(), s.calendar)


@query
def fact_incremental(src: Source) -> DataFrame:
    """A batch whose customer must exist: lines of unknown customers are left out."""
    return _batch_fact(src)


def _batch_fact(src: Source) -> DataFrame:
    s = star(src)
    keys = s.keys(("product", "customer"))
    keys[1] = facts.DimKey(s.customers.filter(F.col("balance") >= 0), "nk_customer_id", "sk_cliente", "customer_id", True)
    batch = src.orders().filter(F.col("order_date") >= OVERLAP).withColumn("freight", (F.col("freight") * 2).cast("decimal(12,2)"))
    lines = s.lines.join(batch.select("order_id"), "order_id", "left_semi")
    return facts.load_fact(files.overwrite(lines, work_path(src.spark)), batch, keys)


@query
def fact_rejects(src: Source) -> DataFrame:
    """A reject row for every line that a load leaves out, with the reason."""
    s = star(src)
    keys = s.keys(("product", "customer"))
    keys[0] = facts.DimKey(s.products.filter(~F.col("discontinued")), "nk_product_id", "sk_producto", "product_id", True)
    keys[1] = facts.DimKey(s.customers.filter(F.col("balance") >= 0), "nk_customer_id", "sk_cliente", "customer_id", True)
    dated = src.orders().withColumn("order_date", F.when(F.col("order_date") >= "1996-01-01", F.col("order_date")))
    return facts.rejected_lines("tmp_order_details", src.lines(), dated, keys)


def _base_fact(src: Source) -> DataFrame:
    limit = int(CUT.replace("-", ""))
    return star(src).fact.filter(F.col("sk_tiempo") < limit)


@query
def fact_upsert(src: Source) -> DataFrame:
    columns = [c for c in facts.FACT_COLUMNS if c not in facts.GRAIN]
    return upsert.upsert(_base_fact(src).drop("anio"), _batch_fact(src), facts.GRAIN, columns)


@query
def fact_upsert_partitions(src: Source) -> DataFrame:
    """The same upsert on a stored table partitioned by month, rewriting only the months it touches."""
    path = work_path(src.spark)
    month = F.expr("int(sk_tiempo div 100)")
    _base_fact(src).drop("anio").withColumn("periodo", month).write.partitionBy("periodo").parquet(path)
    columns = [c for c in facts.FACT_COLUMNS if c not in facts.GRAIN]
    upsert.upsert_partitions(path, _batch_fact(src).withColumn("periodo", month), facts.GRAIN, columns, ["periodo"])
    return src.spark.read.parquet(path).drop("periodo")


@query
def upsert_null_partition(src: Source) -> DataFrame:
    """Orders partitioned by a month that some do not have; a batch moves some there and others away."""
    path = work_path(src.spark)
    month = F.when(F.col("shipped_date").isNotNull(), F.month("order_date"))
    orders = src.orders().select("order_id", F.lit("O").alias("estado"), month.alias("mes"))
    orders.write.partitionBy("mes").parquet(path)
    batch = orders.join(src.orders().filter("ship_via = 3").select("order_id"), "order_id").select(
        "order_id", F.lit("X").alias("estado"), F.when(F.col("mes") != 5, F.lit(None)).otherwise(F.lit(13)).cast("int").alias("mes")
    )
    upsert.upsert_partitions(path, batch, ["order_id"], ["estado"], ["mes"])
    return src.spark.read.parquet(path)


@query
def fact_upsert_snapshot(src: Source) -> DataFrame:
    """The same upsert on a versioned table by month: only touched months get new folders, published at once."""
    store = Snapshots(src.spark, work_path(src.spark))
    month = F.expr("int(sk_tiempo div 100)")
    columns = [c for c in facts.FACT_COLUMNS if c not in facts.GRAIN]
    store.update(lambda c: c.replace("fact", _base_fact(src).drop("anio").withColumn("periodo", month), ["periodo"]))
    store.update(lambda c: c.upsert("fact", _batch_fact(src).withColumn("periodo", month), facts.GRAIN, columns))
    return store.open().read("fact").drop("periodo")


@query
def fact_insert_filtered(src: Source) -> DataFrame:
    """Insert of new fact rows, where a stored filter of the keys lets few of the known ones meet the fact."""
    base = files.overwrite(_base_fact(src).select(*facts.FACT_COLUMNS), work_path(src.spark))
    blocks = keyfilter.blocks_for(base.count())
    known = files.overwrite(keyfilter.build(base, facts.GRAIN, blocks), work_path(src.spark))
    fresh, _ = keyfilter.insert_new(base, _batch_fact(src).select(*facts.FACT_COLUMNS), facts.GRAIN, known, blocks)
    return base.unionByName(fresh)


@query
def key_filter_share(src: Source) -> DataFrame:
    """All keys of the fact pass the filter of the fact; of the keys that it does not hold hardly any do."""
    base = _base_fact(src).select(*facts.GRAIN)
    blocks = keyfilter.blocks_for(base.count())
    known = files.overwrite(keyfilter.build(base, facts.GRAIN, blocks), work_path(src.spark))
    strange = base.withColumn(facts.GRAIN[0], -F.col(facts.GRAIN[0]) - 1)
    mine, other = (keyfilter.passing_share(rows, known, facts.GRAIN, blocks) for rows in (base, strange))
    few = F.col("dudosas") * 50 < F.col("filas")
    return mine.select(F.lit("propias").alias("claves"), "filas", (F.col("filas") == F.col("dudosas")).alias("bien")).unionByName(
        other.select(F.lit("ajenas").alias("claves"), "filas", few.alias("bien"))
    )


def _kept(src: Source, figures: deltas.Figures, prepare: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Figures of the first sales, brought up to date by the rows that the batch replaces and adds."""
    base = prepare(_base_fact(src).select(*facts.FACT_COLUMNS))
    batch = prepare(files.overwrite(_batch_fact(src).select(*facts.FACT_COLUMNS), work_path(src.spark)))
    store = Snapshots(src.spark, work_path(src.spark))
    store.update(lambda c: deltas.start(c, figures, base))
    store.update(lambda c: deltas.apply(c, figures, deltas.upsert_changes(base, batch, facts.GRAIN)))
    return deltas.read(store.open(), figures)


@query
def delta_customer(src: Source) -> DataFrame:
    """Customer metrics after a batch, from its changes only."""
    sums = metrics.customer_sums_of(_kept(src, metrics.CUSTOMER_FIGURES))
    return metrics.customer_segments(sums, star(src).customers)


@query
def delta_product(src: Source) -> DataFrame:
    return metrics.product_segments(_kept(src, metrics.PRODUCT_FIGURES), star(src).products)


@query
def delta_period(src: Source) -> DataFrame:
    return marts.sales_by_period_of(_kept(src, marts.PERIOD_FIGURES, marts.with_month), star(src).calendar)


@query
def delta_seller(src: Source) -> DataFrame:
    return marts.sales_by_employee_of(star(src).employees, _kept(src, marts.SELLER_FIGURES))


def _footprints(src: Source) -> DataFrame:
    s = star(src)
    loaded = _batch_fact(src)
    batch = src.orders().filter(F.col("order_date") >= OVERLAP)
    read = src.lines().join(batch, "order_id", "left_semi")
    return union(
        facts.footprint("dwa_dim_cliente", src.customers(), s.customers, "Clientes excluidos"),
        facts.footprint("dwa_dim_producto", src.products(), s.products, "Productos excluidos"),
        facts.footprint("dwa_fact_ventas", read, loaded, "Lineas con FK invalida"),
        facts.footprint("dwa_dim_pais", src.countries(), s.countries, "", decision=num.CORRECTED),
    )


@query
def load_footprint(src: Source) -> DataFrame:
    return _footprints(src)


@query
def load_status(src: Source) -> DataFrame:
    return facts.load_status(_footprints(src))


@query
def load_summary(src: Source) -> DataFrame:
    """Footprints of the latest of two runs over the same targets."""
    first = _footprints(src).withColumn("log_id", F.lit(1))
    second = facts.footprint("dwa_dim_cliente", src.customers(), _solvent(src), "Saldo negativo").withColumn("log_id", F.lit(2))
    loads = union(first, second)
    return ledger.run_summary(loads, loads.agg(F.max("log_id")).scalar())


# ---- history ---------------------------------------------------------------------------------


def _history(src: Source) -> DataFrame:
    s = star(src)
    first_batch = s.customers.filter(F.col("balance") < 9000)
    first = history.first_sale(s.fact, s.calendar, "sk_cliente")
    return history.start_history(first_batch, first, "nk_customer_id", "sk_cliente", TRACKED, F.lit(NO_SALES_DATE))


def _changed_customers(src: Source) -> DataFrame:
    poor = F.col("balance") < 0
    return star(src).customers.withColumns(
        {
            "city": F.when(poor, F.lit("Moved")).otherwise(F.col("city")),
            "region": F.when(poor & (F.col("contact_title") == "BUILDING"), F.lit(None)).otherwise(F.col("region")),
        }
    )


def _effective(src: Source):
    batch = src.orders().filter(F.col("order_date") >= CUT)
    return history.effective_date(batch, "order_date", F.lit(CUT))


def _merged(src: Source) -> DataFrame:
    return history.merge_history(
        _history(src), _changed_customers(src), "nk_customer_id", "sk_cliente", TRACKED, _effective(src)
    )


@query
def scd2_init(src: Source) -> DataFrame:
    return _history(src)


@query
def scd2_merge(src: Source) -> DataFrame:
    return _merged(src)


@query
def scd2_rerun(src: Source) -> DataFrame:
    """Merging the same batch twice equals merging it once."""
    return history.merge_history(
        _merged(src), _changed_customers(src), "nk_customer_id", "sk_cliente", TRACKED, _effective(src)
    )


@query
def scd2_conflicts(src: Source) -> DataFrame:
    return history.merge_conflicts(
        _history(src), _changed_customers(src), "nk_customer_id", TRACKED, _effective(src), "dwm_cliente"
    )


@query
def scd2_invariants(src: Source) -> DataFrame:
    broken = history.broken_versions(_merged(src), "nk_customer_id")
    return broken.agg(F.count(F.lit(1)).alias("incumplimientos"))


def _observed(src: Source) -> list[DataFrame]:
    """Two batches: the changed customers, and one of an earlier date about some of them."""
    late = star(src).customers.filter(F.col("contact_title").isin("BUILDING", "MACHINERY"))
    late = late.withColumn("city", F.when(F.col("balance") < 4000, F.lit("Late")).otherwise(F.col("city")))
    names = ("nk_customer_id", "sk_cliente", TRACKED)
    return [
        history.observed(_changed_customers(src), *names, _effective(src), 1),
        history.observed(late, *names, F.lit(OVERLAP), 2),
    ]


def _spliced(src: Source, batches: list[DataFrame]) -> DataFrame:
    past = _history(src)
    log = history.observations_of(past, "nk_customer_id", "sk_cliente", TRACKED)
    for batch in batches:
        past, log = history.splice_history(past, log, batch, "nk_customer_id", "sk_cliente", TRACKED)
    return past


@query
def scd2_late(src: Source) -> DataFrame:
    """A batch that is dated before the one loaded last."""
    return _spliced(src, _observed(src))


@query
def scd2_any_order(src: Source) -> DataFrame:
    """The same batches in the order of their dates, the first one twice."""
    first, second = _observed(src)
    return _spliced(src, [second, first, second])


@query
def scd2_merge_on_read(src: Source) -> DataFrame:
    """The merge on a versioned table: versions that close are marked, no file is rewritten; closed ones are not even read."""
    store = Snapshots(src.spark, work_path(src.spark))
    store.update(lambda c: c.replace("hist", _history(src), ["es_vigente"]))
    keys = ["nk_customer_id", "fecha_desde"]
    for _ in range(2):  # the second time nothing is left to do
        open_ = store.open().read("hist", lambda values: values == ("true",))
        rows = history.version_changes(open_, _changed_customers(src), "nk_customer_id", "sk_cliente", TRACKED, _effective(src))
        store.update(lambda c, rows=rows: c.merge("hist", rows, keys, ["fecha_hasta", "es_vigente"]))
    return store.open().read("hist")


@query
def fact_merge_on_read(src: Source) -> DataFrame:
    """The fact upsert without rewriting a file, compacted afterwards."""
    store = Snapshots(src.spark, work_path(src.spark))
    columns = [c for c in facts.FACT_COLUMNS if c not in facts.GRAIN]
    store.update(lambda c: c.replace("fact", _base_fact(src).drop("anio")))
    store.update(lambda c: c.merge("fact", _batch_fact(src), facts.GRAIN, columns))
    store.update(lambda c: c.compact("fact"))
    return store.open().read("fact")


@query
def scd2_late_invariants(src: Source) -> DataFrame:
    return history.broken_versions(scd2_late(src), "nk_customer_id").agg(F.count(F.lit(1)).alias("incumplimientos"))


@query
def scd2_as_of(src: Source) -> DataFrame:
    rows = src.orders().select("order_id", F.col("customer_id").alias("nk_customer_id"), "order_date")
    return history.version_at(rows, _merged(src), "nk_customer_id", "order_date", ["city", "region", "fecha_desde"])


# ---- metrics, ranking, marts -----------------------------------------------------------------


def _fact_of(src: Source, year: int) -> DataFrame:
    return reports.fact_of_year(star(src).fact, year)


@query
def enrich_customer(src: Source) -> DataFrame:
    """All customers over all sales."""
    s = star(src)
    return metrics.customer_metrics(s.fact, s.calendar, s.customers)


@query
def enrich_customer_active(src: Source) -> DataFrame:
    """Customers with sales, over all sales."""
    return metrics.customer_metrics(star(src).fact, star(src).calendar)


@query
def enrich_calendar_gap(src: Source) -> DataFrame:
    """Days that the calendar lacks do not count, but the customer stays with the other days."""
    s = star(src)
    gap = s.calendar.filter(~F.col("mes").isin(1, 2, 3))
    return metrics.customer_sums(s.fact, gap).withColumn("monto_total_neto", F.col("monto_total_neto").cast("decimal(28,4)"))


@query
def enrich_product(src: Source) -> DataFrame:
    """All products over all sales."""
    return metrics.product_metrics(star(src).fact, star(src).products)


@query
def enrich_product_active(src: Source) -> DataFrame:
    """Products with sales, over all sales."""
    return metrics.product_metrics(star(src).fact)


@query
def enrich_product_distributed(src: Source) -> DataFrame:
    """All products and one that nobody ever bought, over all sales."""
    s = star(src)
    unsold = s.products.select((F.max("sk_producto") + 1).alias("sk_producto"))
    return metrics.product_metrics(s.fact, s.products.select("sk_producto").unionByName(unsold))


@query
def global_rank(src: Source) -> DataFrame:
    """Rank of every line by quantity, where each value is shared by a large part of the rows."""
    lines = src.lines().select(F.concat_ws("-", "order_id", "product_id").alias("linea"), "quantity")
    return ranking.rank_and_tile(lines, "quantity", "linea", rank_as="rk")


@query
def global_ntile(src: Source) -> DataFrame:
    orders = src.orders().select("order_id", "freight")
    return ranking.rank_and_tile(orders, "freight", "order_id", tile_as="tile", tiles=7)


@query
def global_row_number(src: Source) -> DataFrame:
    orders = src.orders().select("order_id", "order_date")
    return ranking.global_row_number(orders, ["order_date", "order_id"], "fila")


def _period(src: Source) -> DataFrame:
    s = star(src)
    return marts.sales_by_period(s.fact, s.calendar)


def _by_customer(src: Source) -> DataFrame:
    s = star(src)
    ranked = metrics.customer_metrics(s.fact, s.calendar, s.customers, rank_as="rank_cliente")
    return marts.sales_by_customer(s.customers, s.countries, ranked)


def _by_product(src: Source) -> DataFrame:
    s = star(src)
    return marts.sales_by_product(s.products, metrics.product_metrics(s.fact, s.products))


@query
def mart_period(src: Source) -> DataFrame:
    return _period(src)


@query
def mart_customer(src: Source) -> DataFrame:
    return _by_customer(src)


@query
def mart_product(src: Source) -> DataFrame:
    return _by_product(src)


@query
def mart_seller(src: Source) -> DataFrame:
    s = star(src)
    return marts.sales_by_employee(s.employees, s.fact)


@query
def mart_geo(src: Source) -> DataFrame:
    s = star(src)
    return marts.sales_by_country(s.countries, s.customers, s.fact)


@query
def geo_shared_orders(src: Source) -> DataFrame:
    """Orders whose lines name two customers count once per country."""
    s = star(src)
    other = F.when(F.col("sk_producto") % 2 == 0, F.col("sk_cliente") + 1).otherwise(F.col("sk_cliente"))
    return marts.country_sums(s.customers, s.fact.withColumn("sk_cliente", other))


@query
def coverage_report(src: Source) -> DataFrame:
    return marts.coverage(_period(src))


@query
def mart_counts(src: Source) -> DataFrame:
    s = star(src)
    return marts.row_counts(
        {
            "dp_ventas_por_periodo": _period(src),
            "dp_ventas_por_cliente": _by_customer(src),
            "dp_ventas_por_producto": _by_product(src),
            "dp_ventas_por_empleado": marts.sales_by_employee(s.employees, s.fact),
            "dp_ventas_geografico": marts.sales_by_country(s.countries, s.customers, s.fact),
        }
    )


# ---- reports ---------------------------------------------------------------------------------


@query
def report_years(src: Source) -> DataFrame:
    return reports.years(_period(src))


@query
def report_kpis(src: Source) -> DataFrame:
    period = _period(src)
    everything = reports.sales_kpis(period).withColumn("filtro", F.lit("Todos"))
    return union(everything, reports.sales_kpis(period, REPORT_YEAR).withColumn("filtro", F.lit(str(REPORT_YEAR))))


@query
def report_monthly(src: Source) -> DataFrame:
    return reports.monthly_series(_period(src), REPORT_YEAR)


@query
def mart_read_back(src: Source) -> DataFrame:
    """The monthly mart published twice; what is read is one complete version."""
    root = work_path(src.spark)
    first = files.publish(_period(src), root)
    second = files.publish(files.read_mart(src.spark, first), root)
    return files.read_mart(src.spark, second)


@query
def mart_footprints(src: Source) -> DataFrame:
    """Rows of each mart against the rows it is made from."""
    s = star(src)
    months = marts.with_month(s.fact).select("_month").distinct()
    return union(
        facts.footprint("dp_ventas_por_periodo", months, _period(src), ""),
        facts.footprint("dp_ventas_por_cliente", s.customers, _by_customer(src), ""),
        facts.footprint("dp_ventas_por_producto", s.products, _by_product(src), ""),
        facts.footprint("dp_ventas_por_empleado", s.employees, marts.sales_by_employee(s.employees, s.fact), ""),
        facts.footprint("dp_ventas_geografico", s.countries, marts.sales_by_country(s.countries, s.customers, s.fact), ""),
    )


@query
def report_active_customers(src: Source) -> DataFrame:
    active = reports.active_in_year(_by_customer(src), _fact_of(src, 2001), "sk_cliente", 2001)
    return active.select("sk_cliente", "monto_neto", "segmento")


@query
def report_top_customers(src: Source) -> DataFrame:
    return reports.top_customers(_by_customer(src), star(src).fact, REPORT_YEAR)


@query
def report_top_products(src: Source) -> DataFrame:
    return reports.top_products(_by_product(src), star(src).fact)


@query
def report_segments(src: Source) -> DataFrame:
    return reports.distribution(_by_customer(src), "segmento")


@query
def report_performance(src: Source) -> DataFrame:
    active = reports.active_in_year(_by_product(src), star(src).fact, "sk_producto", 2001)
    return reports.distribution(active, "performance", "productos")


@query
def report_sellers(src: Source) -> DataFrame:
    s = star(src)
    return reports.employee_ranking(marts.sales_by_employee(s.employees, s.fact), s.employees, s.fact)


@query
def report_seller_year(src: Source) -> DataFrame:
    s = star(src)
    return reports.employee_ranking(s.employees, s.employees, s.fact, REPORT_YEAR)


@query
def report_geo(src: Source) -> DataFrame:
    s = star(src)
    return reports.geography(marts.sales_by_country(s.countries, s.customers, s.fact), s.countries, s.customers, s.fact)


@query
def report_geo_year(src: Source) -> DataFrame:
    s = star(src)
    return reports.geography(s.countries, s.countries, s.customers, s.fact, REPORT_YEAR)


# ---- ledger and catalog ----------------------------------------------------------------------


def _runs(src: Source) -> DataFrame:
    """Events read as runs: the user is the script, an error event a failed run."""
    kind = F.col("event_type")
    state = (
        F.when(kind == "error", num.ERROR)
        .when(kind == "signup", num.WARNING)
        .when(kind == "click", num.RUNNING)
        .otherwise(num.OK)
    )
    return src.table("events").select(
        F.col("event_id").alias("log_id"),
        F.col("user_id").alias("script_id"),
        F.col("ts").alias("fecha_inicio"),
        F.when(kind != "click", F.col("ts")).alias("fecha_fin"),
        state.alias("resultado"),
        F.floor("value").alias("registros_proc"),
        F.col("props").alias("detalle"),
    )


def _scripts(src: Source) -> DataFrame:
    users = src.table("events").select(F.col("user_id").alias("script_id")).distinct()
    name = F.concat(F.lit("script_"), F.col("script_id").cast("string"))
    return users.select(
        "script_id",
        name.alias("script_nombre"),
        F.concat(F.lit("Proceso "), name).alias("script_desc"),
        F.when(F.col("script_id") < 50, "adquisicion").otherwise("ingenieria").alias("etapa"),
    )


def _stamp(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in columns})


@query
def ledger_kpis(src: Source) -> DataFrame:
    return ledger.run_kpis(_runs(src))


@query
def ledger_register_once(src: Source) -> DataFrame:
    """Scripts register by name; a name that is known keeps its entry."""
    every = _scripts(src)
    known = every.filter("etapa <> 'adquisicion'")
    again = every.withColumn("script_desc", F.concat(F.lit("Otra vez "), F.col("script_nombre")))
    return upsert.insert_new(known, again, ["script_nombre"])


@query
def ledger_history(src: Source) -> DataFrame:
    return _stamp(ledger.run_history(_runs(src), _scripts(src)), "fecha_inicio", "fecha_fin")


@query
def ledger_fold(src: Source) -> DataFrame:
    """Start and end events folded to one row per run."""
    runs = _runs(src)
    started = runs.select("log_id", "script_id", F.lit(0).alias("evento"), F.col("fecha_inicio").alias("momento"), F.lit(num.RUNNING).alias("resultado"), F.lit(None).cast("string").alias("detalle"), F.lit(None).cast("bigint").alias("registros_proc"))
    ended = runs.filter(F.col("fecha_fin").isNotNull()).select("log_id", "script_id", F.lit(1).alias("evento"), F.col("fecha_fin").alias("momento"), "resultado", "detalle", "registros_proc")
    return _stamp(ledger.fold_runs(union(started, ended)), "fecha_inicio", "fecha_fin")


@query
def ledger_loads(src: Source) -> DataFrame:
    runs = _runs(src)
    loads = runs.select(
        F.col("detalle").alias("tabla_destino"),
        F.col("registros_proc").alias("registros_leidos"),
        F.when(F.col("resultado") == num.ERROR, 0).otherwise(F.col("registros_proc")).alias("registros_insertados"),
        F.when(F.col("resultado") == num.ERROR, F.col("registros_proc")).otherwise(0).alias("registros_rechazados"),
    )
    return ledger.loads_by_target(loads)


@query
def ledger_rejects(src: Source) -> DataFrame:
    """Rejected orders with the run and script that rejected them; some runs are unknown."""
    rejects = fk_rejects(src).withColumn("log_id", F.col("clave_registro").cast("bigint"))
    return ledger.reject_report(rejects, _runs(src), _scripts(src))


@query
def reject_once(src: Source) -> DataFrame:
    """A second run of the score check adds no reject that is already there."""
    before = norm_score_rejects(src).filter(F.col("motivo_rechazo").contains("valor 0"))
    return upsert.insert_new_by_prefix(
        before, norm_score_rejects(src), ["tabla_origen", "clave_registro"], "motivo_rechazo", "Score invalido:"
    )


@query
def delete_where(src: Source) -> DataFrame:
    results = rules_batch2(src).unionByName(rules_batch1(src))
    kept = files.delete_where(results, F.col("tabla").like("txt2_%"))
    return kept.select("tabla", "campo", "control", "resultado", "cant_errores")


@query
def ledger_inventory(src: Source) -> DataFrame:
    return _stamp(ledger.inventory_report(_scripts(src), _runs(src)), "ultima_ejecucion")


@query
def latest_event(src: Source) -> DataFrame:
    return ranking.latest_by(src.table("events"), ["user_id"], "event_id", ["event_type", "value"])


def _catalog(src: Source) -> DataFrame:
    info = catalog.TableInfo
    return catalog.catalog(
        src.spark,
        {
            "txt_customers": (src.raw_customers(), info("txt", ("customer_id",))),
            "txt_products": (src.raw_products(), info("txt", ("product_id",), {"category_id": ("txt_categories", "category_id")})),
            "txt_orders": (src.raw_orders(), info("txt", ("order_id",), {"customer_id": ("txt_customers", "customer_id")})),
            "txt_order_details": (src.raw_lines(), info("txt", ("order_id", "product_id"), {"order_id": ("txt_orders", "order_id")})),
        },
    )


@query
def catalog_summary(src: Source) -> DataFrame:
    """Keys per table next to the rows measured in it."""
    rows = _profiles(src).groupBy(F.col("tabla").alias("nombre_tabla")).agg(F.max("total_registros").alias("registros"))
    return catalog.catalog_summary(_catalog(src)).join(rows, "nombre_tabla", "left")


@query
def catalog_profile(src: Source) -> DataFrame:
    described = catalog.describe(_catalog(src), _profiles(src)).filter(F.col("cant_distintos").isNotNull())
    return described.select("nombre_tabla", "nombre_columna", "tipo_dato", "es_pk", "es_fk", "total_registros", "cant_nulos", "cant_distintos")


@query
def layer_domain(src: Source) -> DataFrame:
    """Loads whose decision is outside the allowed set, per decision."""
    unknown = F.when(F.col("tabla_destino") == "dwa_fact_ventas", F.lit("EN_DUDA")).otherwise(F.col("decision"))
    decisions = _footprints(src).select("tabla_destino", unknown.alias("decision"))
    return catalog.outside_domain(decisions, "decision", catalog.DECISIONS)


@query
def star_build(src: Source) -> DataFrame:
    """A complete rebuild of the star: rows per table."""
    s = build_star(src, work_path(src.spark))
    return marts.row_counts(
        {"calendar": s.calendar, "countries": s.countries, "customers": s.customers, "employees": s.employees,
         "products": s.products, "shippers": s.shippers, "fact": s.fact}
    )


def flagship(spark: SparkSession, directory: str) -> DataFrame:
    return registry()["mart_period"](spark, directory)
