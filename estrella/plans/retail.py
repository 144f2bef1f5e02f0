"""The whole warehouse life: first load, incremental batch, marts, with quality control and ledger.

Every step is a set of lazy frames; a step ends when its tables are written. Dimensions, history,
metrics and marts are written per batch next to their older versions; the fact is one table
partitioned by year of which a batch rewrites only the years it touches.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from contextlib import contextmanager
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from estrella.functions import numbers as num
from estrella.functions import text as txt
from estrella.operators import (
    calendar,
    catalog,
    dims,
    facts,
    history,
    indicators,
    integrity,
    ledger,
    marts,
    metrics,
    profile,
    rules,
    staging,
    upsert,
)
from estrella.operators.ranking import drop_repeats, first_per_key
from estrella.plans import retail_tables as spec
from estrella.plans.star import write_fact
from estrella.session import materialize, scratch
from estrella.sources import files

CUSTOMER_TRACKED = ["company_name", "city", "region", "country"]
PRODUCT_TRACKED = ["product_name", "precio_lista", "discontinued"]
CUSTOMER_ATTRIBUTES = ["company_name", "contact_name", "contact_title", "city", "region", "country", "sk_pais"]
PRODUCT_ATTRIBUTES = [
    "product_name", "precio_lista", "discontinued", "category_name", "category_description", "supplier_name",
    "supplier_country", "sk_pais_supplier",
]
COUNTRY_ATTRIBUTES = [
    "abbreviation", "capital_major_city", "currency_code", "population", "gdp", "life_expectancy",
    "unemployment_rate", "urban_population", "latitude", "longitude",
]

GATE_STEPS = ["validacion_ingesta", "validacion_integracion"]


class RawBatch(dict[str, DataFrame]):
    """Raw text tables by name, and the lines of their files that could not be read."""

    def __init__(self) -> None:
        super().__init__()
        self.rejects: dict[str, DataFrame] = {}


def read_batch(spark: SparkSession, paths: Mapping[str, str], batch: int) -> RawBatch:
    """Raw text tables from CSV files; ``paths`` maps table names to files. Bad lines do not stop a batch, they become its rejects."""
    separators = spec.SEPARATORS[batch]
    read = RawBatch()
    for name, path in paths.items():
        read[name], read.rejects[name] = files.import_csv(spark, path, spec.RAW_COLUMNS[name], separators.get(name, ","))
    return read


class RetailWarehouse:
    """A warehouse under ``root``. ``batch`` is the number of batches already applied there."""

    def __init__(self, spark: SparkSession, root: str, as_of: date, batch: int = 0, country_names: Mapping[str, str] | None = None):
        self.spark = spark
        self.root = root
        self.as_of = F.lit(as_of).cast("date")
        self.batch = batch
        self.country_names = dict(country_names or {})
        self.ledger = ledger.Ledger(spark)
        if files.exists(spark, f"{root}/dqm_script_inventory"):
            self.ledger.resume(self._dqm("dqm_script_inventory"), self._dqm("dqm_execution_log"))
        self._saved_events = 0
        self._schemas: dict[str, StructType] = {}

    # ---- tables ---------------------------------------------------------------------------

    def table(self, name: str) -> DataFrame:
        """Latest complete version of a table."""
        for number in range(self.batch + 1, 0, -1):
            path = f"{self.root}/{name}/batch={number}"
            if files.exists(self.spark, path):
                if path not in self._schemas:
                    self._schemas[path] = self.spark.read.parquet(path).schema
                return self.spark.read.schema(self._schemas[path]).parquet(path)
        raise LookupError(f"table {name} has not been loaded")

    def fact(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/fact_ventas")

    def _store(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{name}/batch={self.batch + 1}"
        df.write.mode("overwrite").parquet(path)
        self._schemas[path] = df.schema
        return self.spark.read.schema(df.schema).parquet(path)

    def _dqm(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}")

    def _log(self, name: str, rows: DataFrame, run: ledger.Run) -> DataFrame:
        """Append control rows of a run and return them as written."""
        files.append(rows.withColumn("log_id", F.lit(run.log_id).cast("bigint")), f"{self.root}/{name}")
        return self._dqm(name).filter(F.col("log_id") == run.log_id)

    def _reject(self, rejects: DataFrame, run: ledger.Run) -> None:
        """Append rejects that are not there yet, so that a batch can be run again."""
        if files.exists(self.spark, f"{self.root}/dqm_registro_rechazado"):
            known = self._dqm("dqm_registro_rechazado").select("tabla_origen", "clave_registro", "motivo_rechazo")
            rejects = rejects.join(known, known.columns, "left_anti")
        self._log("dqm_registro_rechazado", rejects.distinct(), run)

    @contextmanager
    def _step(self, name: str, description: str, stage: str):
        """A run in the ledger; what it writes besides tables is deleted when it ends."""
        try:
            with scratch(self.spark), self.ledger.run(name, description, stage) as run:
                yield run
        finally:
            self._save_ledger()

    def _save_ledger(self) -> None:
        fresh = self.ledger.events[self._saved_events :]
        self._saved_events = len(self.ledger.events)
        if fresh:
            files.append(self.spark.createDataFrame(fresh, ledger.EVENT_SCHEMA), f"{self.root}/dqm_execution_log")
        files.overwrite(self.ledger.script_table(), f"{self.root}/dqm_script_inventory")

    def runs(self) -> DataFrame:
        return ledger.fold_runs(self._dqm("dqm_execution_log"))

    def scripts(self) -> DataFrame:
        return self._dqm("dqm_script_inventory")

    @staticmethod
    def _close(run: ledger.Run, summary: DataFrame, rows: str = "registros_proc") -> None:
        row = summary.first()
        run.status, run.rows = row["resultado"], row[rows]
        run.detail = row["detalle"] if "detalle" in summary.columns else None

    # ---- first batch ----------------------------------------------------------------------

    def load_first(self, raw: Mapping[str, DataFrame], strict: bool = False) -> None:
        raw = self._import(raw, "txt", "importacion", "adquisicion")
        self._validate("validacion_txt", raw, spec.first_batch_rules(), "txt")
        self._profile("perfilado_txt", {t: (raw[t], c) for t, c in spec.FIRST_PROFILES.items()}, "txt")
        raw["customers"] = self._clean_countries(raw["customers"])
        staged = self._stage_first(raw)
        self._check_references(staged)
        self._measure_first(raw, staged)
        blockers = self.gate(strict)
        self._load_star(staged)
        self._start_histories()
        self._recompute(staged=None)
        self.batch += 1
        self.blockers = blockers

    def _import(self, raw: Mapping[str, DataFrame], prefix: str, name: str, stage: str) -> dict[str, DataFrame]:
        """Mirror the files as text tables, so that they are parsed once; later steps read columns."""
        with self._step(name, "Lectura de archivos CSV", stage) as run:
            mirrored = {table: self._store(f"{prefix}_{table}", df) for table, df in raw.items()}
            if isinstance(raw, RawBatch):
                bad = [
                    rows.select(
                        F.lit(f"{prefix}_{table}").alias("tabla_origen"),
                        F.concat_ws(":", F.substring_index("archivo", "/", -1), "linea").alias("clave_registro"),
                        "motivo_rechazo",
                        F.lit(num.REJECTED).alias("decision"),
                    )
                    for table, rows in raw.rejects.items()
                ]
                found = materialize(upsert.union_all(bad))
                if not found.isEmpty():
                    self._reject(found, run)
            counts = files.control_total(mirrored)
            run.rows = counts.filter(F.col("tabla") == "TOTAL").first()["registros"]
            return mirrored

    def _validate(self, name: str, raw: Mapping[str, DataFrame], wanted: Mapping[str, Sequence[rules.Rule]], prefix: str) -> None:
        with self._step(name, f"Reglas de campo sobre {prefix}", "adquisicion") as run:
            results = rules.check_all([(f"{prefix}_{t}", raw[t], found) for t, found in wanted.items()])
            self._close(run, rules.roll_up(self._log("dqm_validacion_campo", results, run)))

    def _profile(self, name: str, tables: Mapping[str, tuple[DataFrame, Mapping]], prefix: str) -> None:
        with self._step(name, f"Perfilado de {prefix}", "adquisicion") as run:
            found = profile.profile_all([(f"{prefix}_{t}", df, columns) for t, (df, columns) in tables.items()])
            run.rows = self._log("dqm_perfilado", found, run).count()

    def _clean_countries(self, customers: DataFrame) -> DataFrame:
        with self._step("limpieza_datos", "Unifica nombres de pais", "adquisicion") as run:
            cleaned = customers.withColumn("country", txt.recode(F.col("country"), {"MX": "Mexico"}))
            checked = rules.forbidden("country", "MX", "POST_LIMPIEZA_SIN_MX", num.ERROR)
            results = self._log("dqm_validacion_campo", rules.check("txt_customers", cleaned, [checked]), run)
            self._close(run, rules.roll_up(results))
            return cleaned

    def _stage(self, raw: Mapping[str, DataFrame], batch: int, run: ledger.Run) -> dict[str, DataFrame]:
        raw_prefix, prefix = ("txt", "tmp") if batch == 1 else ("txt2", "tmp2")
        staged, rejects = {}, []
        for name, df in raw.items():
            fields = spec.staged_fields(name, batch)
            if any(f.type != "string" for f in fields):
                rejects.append(staging.cast_rejects(f"{raw_prefix}_{name}", df, fields, spec.KEYS[name]))
            staged[name] = self._store(f"{prefix}_{name}", staging.stage(df, fields))
        self._reject(upsert.union_all(rejects), run)
        return staged

    def _stage_first(self, raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        with self._step("migracion_tipada", "De texto a tablas tipadas", "adquisicion") as run:
            staged = self._stage(raw, 1, run)
            run.rows = marts.row_counts(staged).agg(F.sum("registros")).first()[0]
            return staged

    def _link(self, staged: Mapping[str, DataFrame], link: spec.Link) -> integrity.ForeignKey:
        return integrity.ForeignKey(
            f"tmp_{link.child}", staged[link.child], link.column, staged[link.parent], link.parent_key, link.key
        )

    def _check_references(self, staged: Mapping[str, DataFrame]) -> None:
        with self._step("integridad_referencial", "Claves foraneas entre tablas tipadas", "adquisicion") as run:
            links = integrity.count_together({f"{k.child}.{k.column}": self._link(staged, k) for k in spec.LINKS})
            results = integrity.check_foreign_keys(list(links.values()))
            self._close(run, rules.roll_up(self._log("dqm_validacion_campo", results, run)))

    def _measure_first(self, raw: Mapping[str, DataFrame], staged: Mapping[str, DataFrame]) -> None:
        with self._step(GATE_STEPS[0], "Indicadores de ingesta", "ingenieria") as run:
            self._close(run, rules.roll_up(self._log("dqm_indicador", intake_indicators(staged), run)))
        with self._step(GATE_STEPS[1], "Indicadores de integracion", "ingenieria") as run:
            links = integrity.count_together({f"{k.child}.{k.column}": self._link(staged, k) for k in spec.LINKS})
            shares = [indicators.foreign_key_share(links[f"{child}.{c}"], name) for child, c, name in spec.LINK_SHARES]
            gaps = [
                indicators.count_difference(f"tmp_{t}", raw[t], staged[t])
                for t in ("orders", "order_details", "products", "customers")
            ]
            self._close(run, rules.roll_up(self._log("dqm_indicador", indicators.all_of([*shares, *gaps]), run)))

    def gate(self, strict: bool = False) -> DataFrame:
        return indicators.gate(self._dqm("dqm_indicador"), self.runs(), self.scripts(), GATE_STEPS, strict)

    def _load_star(self, staged: Mapping[str, DataFrame]) -> None:
        with self._step("carga_dwa", "Dimensiones y hechos", "ingenieria") as run:
            days = calendar.calendar_range(staged["orders"], "order_date", ["required_date", "shipped_date"])
            days = self._store("dim_tiempo", days)
            shippers = self._store("dim_shipper", dims.load_dim(shipper_rows(staged), "nk_shipper_id", "sk_shipper"))
            customers = self._store("dim_cliente", dims.load_dim(customer_rows(staged), "nk_customer_id", "sk_cliente"))
            keyed = dims.load_dim(employee_rows(staged), "nk_employee_id", "sk_empleado")
            linked = dims.resolve_parent(
                keyed, staged["employees"], "nk_employee_id", "employee_id", "reports_to", "sk_empleado", "reports_to_sk"
            )
            employees = self._store("dim_empleado", linked)
            base = product_rows(staged["products"], staged["categories"], staged["suppliers"])
            products = self._store("dim_producto", dims.load_dim(base, "nk_product_id", "sk_producto"))

            keys = self._fact_keys(customers, customer_required=False)
            lines = self._first_lines(staged)
            write_fact(facts.load_fact(lines, staged["orders"], keys, days), f"{self.root}/fact_ventas")
            loads = [
                facts.footprint("dwa_dim_tiempo", days, days, ""),
                facts.footprint("dwa_dim_shipper", staged["shippers"], shippers, ""),
                facts.footprint("dwa_dim_cliente", staged["customers"], customers, ""),
                facts.footprint("dwa_dim_empleado", staged["employees"], employees, ""),
                facts.footprint("dwa_dim_producto", staged["products"], products, ""),
                facts.footprint(
                    "dwa_fact_ventas", staged["order_details"], self.fact(), "Lineas sin fecha, sin producto o repetidas"
                ),
            ]
            self._close(run, facts.load_status(self._log("dqm_carga_dwa", upsert.union_all(loads), run)))

    def _first_lines(self, staged: Mapping[str, DataFrame]) -> DataFrame:
        """One line per order and product."""
        lines = staged["order_details"]
        order = [c for c in lines.columns if c not in ("order_id", "product_id")]
        return self._store("tmp_lineas", drop_repeats(lines, ["order_id", "product_id"], order))

    def _fact_keys(self, customers: DataFrame, customer_required: bool) -> list[facts.DimKey]:
        key = facts.DimKey
        return [
            key(self.table("dim_producto"), "nk_product_id", "sk_producto", "product_id", True),
            key(customers, "nk_customer_id", "sk_cliente", "customer_id", customer_required),
            key(self.table("dim_empleado"), "nk_employee_id", "sk_empleado", "employee_id"),
            key(self.table("dim_shipper"), "nk_shipper_id", "sk_shipper", "ship_via"),
        ]

    def _start_histories(self) -> None:
        with self._step("memoria_inicial", "Primera version de clientes y productos", "ingenieria") as run:
            for name, dim, key, surrogate, tracked in self._history_specs():
                first = history.first_sale(self.fact(), self.table("dim_tiempo"), surrogate)
                started = history.start_history(self.table(dim), first, key, surrogate, tracked, self.as_of)
                stored = self._store(name, started)
                self._log("dqm_carga_dwa", facts.footprint(name, self.table(dim), stored, ""), run)

    @staticmethod
    def _history_specs():
        return [
            ("dwm_cliente", "dim_cliente", "nk_customer_id", "sk_cliente", CUSTOMER_TRACKED),
            ("dwm_producto", "dim_producto", "nk_product_id", "sk_producto", PRODUCT_TRACKED),
        ]

    # ---- second batch ---------------------------------------------------------------------

    def apply_batch(self, raw: Mapping[str, DataFrame]) -> None:
        """Apply changes and new orders; lines of unknown customers are rejected, the rest is loaded."""
        raw = self._import(raw, "txt2", "importacion_novedades", "actualizacion")
        self._validate("validacion_txt2", raw, spec.second_batch_rules(), "txt2")
        trimmed = {t: (raw[t], {c: profile.BLANK_TRIMMED for c in cols}) for t, cols in spec.SECOND_PROFILES.items()}
        self._profile("perfilado_txt2", trimmed, "txt2")
        staged = self._stage_second(raw)
        self._check_batch(staged)
        self._update_star(staged)
        self._merge_histories(staged)
        self._recompute(staged)
        self.batch += 1

    def _stage_second(self, raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        with self._step("migracion_tipada2", "Novedades de texto a tablas tipadas", "actualizacion") as run:
            score = F.col("score")
            valid, rejects = staging.split_valid(
                "txt2_customers_score", raw["customers_score"], staging.valid_score(score), ["customer_id"], staging.score_reason(score)
            )
            self._reject(rejects, run)
            staged = self._stage({**raw, "customers_score": valid}, 2, run)
            run.rows = marts.row_counts(staged).agg(F.sum("registros")).first()[0]
            return staged

    def _check_batch(self, staged: Mapping[str, DataFrame]) -> None:
        """References against the warehouse; orphans become rejects and the load may go on."""
        with self._step("integridad_novedades", "Claves foraneas de las novedades", "actualizacion") as run:
            fk = integrity.ForeignKey
            customers, employees = self.table("dim_cliente"), self.table("dim_empleado")
            order_customer = fk("tmp2_orders", staged["orders"], "customer_id", customers, "nk_customer_id", "order_id")
            line_product = fk(
                "tmp2_order_details", staged["order_details"], "product_id", self.table("dim_producto"), "nk_product_id",
                also=((staged["products"], "product_id"),),
            )
            share = indicators.foreign_key_share
            found = indicators.all_of(
                [
                    share(order_customer, "PCT_FK_CLIENTE_INVALIDA", scale=4, null_is_orphan=True),
                    share(
                        fk("tmp2_orders", staged["orders"], "employee_id", employees, "nk_employee_id"),
                        "PCT_FK_EMPLEADO_INVALIDA", scale=4, only_present=True,
                    ),
                    share(line_product, "PCT_FK_PRODUCTO_INVALIDA", scale=4, null_is_orphan=True),
                    share(
                        fk("tmp2_customers_score", staged["customers_score"], "customer_id", customers, "nk_customer_id"),
                        "PCT_SCORE_CLIENTE_INVALIDO", 0, 5, scale=4, null_is_orphan=True,
                    ),
                ]
            )
            logged = self._log("dqm_indicador", found, run)
            # fixed value: the wording of the reject reason
            self._reject(integrity.reject_orphans(order_customer, "Cliente inexistente en DWA: "), run)
            self._close(run, rules.roll_up(logged, soften=True))

    def _update_star(self, staged: Mapping[str, DataFrame]) -> None:
        with self._step("actualizacion_dwa", "Altas, cambios y bajas logicas", "actualizacion") as run:
            world = self._named_countries(staged["world_data"], "country").withColumnRenamed("country", "country_name")
            world = first_row(world.filter(F.col("country_name").isNotNull()).select("country_name", *COUNTRY_ATTRIBUTES), "country_name")
            try:
                known = self.table("dim_pais")
                countries = dims.upsert_dim(known, world, "country_name", "sk_pais", COUNTRY_ATTRIBUTES)
            except LookupError:
                countries = dims.load_dim(world, "country_name", "sk_pais")
            countries = self._store("dim_pais", countries)
            place = countries.select("country_name", "sk_pais")

            news = self._with_country(customer_rows(staged), place, "country", "sk_pais")
            customers = dims.upsert_dim(
                self.table("dim_cliente"), first_row(news, "nk_customer_id"), "nk_customer_id", "sk_cliente", CUSTOMER_ATTRIBUTES
            )
            customers = self._fill_country(customers, place, "country", "sk_pais")
            scores = first_row(staged["customers_score"], "customer_id")
            customers = dims.attach_score(customers, scores, ("nk_customer_id", "customer_id"))
            customers = self._store("dim_cliente", customers)

            lookups = self.table("tmp_categories"), self.table("tmp_suppliers")
            rows_in = self._with_country(product_rows(staged["products"], *lookups), place, "supplier_country", "sk_pais_supplier")
            products = dims.upsert_dim(
                self.table("dim_producto"), first_row(rows_in, "nk_product_id"), "nk_product_id", "sk_producto", PRODUCT_ATTRIBUTES
            )
            products = self._fill_country(products, place, "supplier_country", "sk_pais_supplier")
            self._store("dim_producto", products)

            days = calendar.calendar_of_dates(staged["orders"], ["order_date", "required_date", "shipped_date"])
            self._store("dim_tiempo", calendar.add_missing_days(self.table("dim_tiempo"), days))

            keys = self._fact_keys(customers, customer_required=True)
            lines = self._first_lines(staged)
            rows = facts.load_fact(lines, staged["orders"], keys)
            batch = materialize(rows.withColumn("anio", F.expr("int(sk_tiempo div 10000)")))
            columns = [c for c in facts.FACT_COLUMNS if c not in facts.GRAIN]
            upsert.upsert_partitions(f"{self.root}/fact_ventas", batch, facts.GRAIN, columns, ["anio"])
            loads = [
                facts.footprint("dwa_dim_pais", staged["world_data"], world, "Paises sin nombre o repetidos"),
                facts.footprint("dwa_dim_cliente", staged["customers"], first_row(news, "nk_customer_id"), "Clientes repetidos"),
                facts.footprint("dwa_dim_producto", staged["products"], first_row(rows_in, "nk_product_id"), "Productos repetidos"),
                facts.footprint("dwa_fact_ventas", staged["order_details"], batch, "Lineas de ordenes con FK invalida"),
            ]
            self._reject(facts.rejected_lines("tmp2_order_details", lines, staged["orders"], keys), run)
            self._close(run, facts.load_status(self._log("dqm_carga_dwa", upsert.union_all(loads), run)))

    def _named_countries(self, df: DataFrame, column: str) -> DataFrame:
        """Country names in the spelling of the country table."""
        return df.withColumn(column, txt.recode(F.col(column), self.country_names)) if self.country_names else df

    def _with_country(self, df: DataFrame, place: DataFrame, column: str, foreign_key: str) -> DataFrame:
        found = place.select(F.col("country_name").alias("_name"), F.col("sk_pais").alias(foreign_key))
        named = self._named_countries(df.withColumn("_name", F.col(column)), "_name")
        return named.join(found, "_name", "left").drop("_name")

    def _fill_country(self, df: DataFrame, place: DataFrame, column: str, foreign_key: str) -> DataFrame:
        named = self._named_countries(df.withColumn("_name", F.col(column)), "_name")
        return dims.fill_missing(named, place, ("_name", "country_name"), foreign_key, "sk_pais").drop("_name")

    def _merge_histories(self, staged: Mapping[str, DataFrame]) -> None:
        with self._step("memoria_novedades", "Versiones de clientes y productos", "actualizacion") as run:
            for name, dim, key, surrogate, tracked in self._history_specs():
                effective = history.effective_date(staged["orders"], "order_date", self.as_of)
                late = history.merge_conflicts(self.table(name), self.table(dim), key, tracked, effective, name)
                self._reject(late, run)
                merged = history.merge_history(self.table(name), self.table(dim), key, surrogate, tracked, effective)
                stored = self._store(name, merged)
                opened = stored.filter("es_vigente").filter(F.col("fecha_desde") == effective)
                self._log("dqm_carga_dwa", facts.footprint(name, opened, opened, ""), run)

    # ---- metrics and marts ----------------------------------------------------------------

    def _recompute(self, staged: Mapping[str, DataFrame] | None) -> None:
        name = "enriquecimiento" if staged is None else "enriquecimiento_novedades"
        with self._step(name, "Metricas por cliente y producto", "ingenieria") as run:
            days = self.table("dim_tiempo")
            customers = self._store("enr_cliente", metrics.customer_metrics(self.fact(), days, self.table("dim_cliente")))
            products = self._store("enr_producto", metrics.product_metrics(self.fact(), self.table("dim_producto")))
            for target, read, written in (
                ("enr_cliente", self.table("dim_cliente"), customers),
                ("enr_producto", self.table("dim_producto"), products),
            ):
                self._log("dqm_carga_dwa", facts.footprint(target, read, written, ""), run)
            run.rows = customers.count() + products.count()

    def build_marts(self) -> dict[str, DataFrame]:
        """Write the five flat data products."""
        with self._step("carga_data_products", "Tablas planas de publicacion", "publicacion") as run:
            fact, days = self.fact(), self.table("dim_tiempo")
            customers, countries = self.table("dim_cliente"), self.table("dim_pais")
            built = {
                "dp_ventas_por_periodo": marts.sales_by_period(fact, days),
                "dp_ventas_por_cliente": marts.sales_by_customer(customers, countries, self.table("enr_cliente")),
                "dp_ventas_por_producto": marts.sales_by_product(self.table("dim_producto"), self.table("enr_producto")),
                "dp_ventas_por_empleado": marts.sales_by_employee(self.table("dim_empleado"), fact),
                "dp_ventas_geografico": marts.sales_by_country(countries, customers, fact),
            }
            # a new version next to the old one: readers see the old marts until the new ones are complete
            stored = {name: self._store(name, df) for name, df in built.items()}
            # what each mart has a row for
            sources = {
                "dp_ventas_por_periodo": marts.with_month(fact).select("_month").distinct(),
                "dp_ventas_por_cliente": customers,
                "dp_ventas_por_producto": self.table("dim_producto"),
                "dp_ventas_por_empleado": self.table("dim_empleado"),
                "dp_ventas_geografico": countries,
            }
            loads = [facts.footprint(name, sources[name], df, "") for name, df in stored.items()]
            self._log("dqm_carga_dwa", upsert.union_all(loads), run)
            run.rows = marts.row_counts(stored).agg(F.sum("registros")).first()[0]
            return stored

    def publish_catalog(self) -> DataFrame:
        """Describe the columns of every table that exists; known columns keep their entry."""
        found = {}
        for name, info in table_infos().items():
            try:
                found[name] = (self._current(name), info)
            except LookupError:
                continue
        with self._step("metadata_publicacion", "Catalogo de columnas", "publicacion") as run:
            entries = catalog.catalog(self.spark, found)
            path = f"{self.root}/met_entidades"
            if files.exists(self.spark, path):
                entries = entries.join(self._dqm("met_entidades"), ["nombre_tabla", "nombre_columna"], "left_anti")
            files.append(materialize(entries), path)
            written = self._dqm("met_entidades")
            run.rows = written.count()
            return written

    def _current(self, name: str) -> DataFrame:
        try:
            return self.table(name)
        except LookupError:
            if files.exists(self.spark, f"{self.root}/{name}"):
                return self._dqm(name)
            raise

    def correct_countries(self, corrections: DataFrame) -> DataFrame:
        """Repair country texts by natural key and refresh the marts that copied them.

        ``corrections`` has ``country_name``, the new ``capital_major_city`` (NULL keeps the old one)
        and optionally ``new_country_name``.
        """
        with self._step("correccion_paises", "Repara textos y los propaga", "publicacion") as run:
            broken = self.table("dim_pais")
            fixed = staging.apply_corrections(broken, "country_name", corrections, ["capital_major_city"])
            if "new_country_name" in corrections.columns:
                names = corrections.select("country_name", "new_country_name").filter("new_country_name IS NOT NULL")
                joined = fixed.join(names, "country_name", "left")
                fixed = joined.withColumn("country_name", F.coalesce("new_country_name", "country_name")).select(*broken.columns)
            # the corrected dimension is a new version, so the old one can still be read
            fixed = self._store("dim_pais", fixed)
            self.batch += 1
            touched = broken.join(corrections, "country_name", "left_semi").select("sk_pais")
            dim = fixed.join(touched, "sk_pais", "left_semi")
            targets = {
                "dp_ventas_geografico": {"country_name": "country_name", "capital_major_city": "capital_major_city"},
                "dp_ventas_por_cliente": {"country_name_pais": "country_name", "capital_major_city": "capital_major_city"},
            }
            for name, columns in targets.items():
                mart = self.table(name)
                if name == "dp_ventas_por_cliente":
                    keyed = mart.join(self.table("dim_cliente").select("sk_cliente", "sk_pais"), "sk_cliente")
                else:
                    keyed = mart
                refreshed = staging.propagate(keyed, dim, "sk_pais", columns).select(*mart.columns)
                changed = materialize(keyed.join(touched, "sk_pais", "left_semi"))
                self._store(name, refreshed)
                self._log("dqm_carga_dwa", facts.footprint(name, changed, changed, "", num.CORRECTED), run)
            self._log("dqm_carga_dwa", facts.footprint("dwa_dim_pais", dim, dim, "", num.CORRECTED), run)
            return fixed


def table_infos() -> dict[str, catalog.TableInfo]:
    """Layer, keys and references of every table of the warehouse."""
    info = catalog.TableInfo
    links: dict[str, dict[str, tuple[str, str]]] = {}
    for link in spec.LINKS:
        links.setdefault(link.child, {})[link.column] = (f"tmp_{link.parent}", link.parent_key)
    infos = {}
    for name in spec.FIRST_BATCH:
        infos[f"txt_{name}"] = info("txt")
        infos[f"tmp_{name}"] = info("tmp", tuple(spec.KEYS[name]), links.get(name))
    for name in spec.SECOND_BATCH:
        infos[f"txt2_{name}"] = info("txt")
        infos[f"tmp2_{name}"] = info("tmp", tuple(spec.KEYS[name]))
    country = {"sk_pais": ("dim_pais", "sk_pais")}
    customer = {"sk_cliente": ("dim_cliente", "sk_cliente")}
    product = {"sk_producto": ("dim_producto", "sk_producto")}
    boss = {"reports_to_sk": ("dim_empleado", "sk_empleado")}
    origin = {"sk_pais_supplier": ("dim_pais", "sk_pais")}
    sale = {
        "sk_tiempo": ("dim_tiempo", "sk_tiempo"),
        **customer,
        "sk_empleado": ("dim_empleado", "sk_empleado"),
        **product,
        "sk_shipper": ("dim_shipper", "sk_shipper"),
    }
    run = {"log_id": ("dqm_execution_log", "log_id")}
    infos |= {
        "dim_tiempo": info("dim", ("sk_tiempo",)),
        "dim_pais": info("dim", ("sk_pais",)),
        "dim_cliente": info("dim", ("sk_cliente",), country),
        "dim_empleado": info("dim", ("sk_empleado",), boss),
        "dim_producto": info("dim", ("sk_producto",), origin),
        "dim_shipper": info("dim", ("sk_shipper",)),
        "fact_ventas": info("fact", tuple(facts.GRAIN), sale),
        "dwm_cliente": info("memoria", ("nk_customer_id", "fecha_desde"), customer),
        "dwm_producto": info("memoria", ("nk_product_id", "fecha_desde"), product),
        "enr_cliente": info("enriquecimiento", ("sk_cliente",), customer),
        "enr_producto": info("enriquecimiento", ("sk_producto",), product),
        "dp_ventas_por_periodo": info("dp", ("anio", "mes")),
        "dp_ventas_por_cliente": info("dp", ("sk_cliente",), customer),
        "dp_ventas_por_producto": info("dp", ("sk_producto",), product),
        "dp_ventas_por_empleado": info("dp", ("sk_empleado",), {"sk_empleado": ("dim_empleado", "sk_empleado")}),
        "dp_ventas_geografico": info("dp", ("sk_pais",), country),
        "dqm_script_inventory": info("dqm", ("script_id",)),
        "dqm_execution_log": info("dqm", ("log_id", "evento"), {"script_id": ("dqm_script_inventory", "script_id")}),
        "dqm_validacion_campo": info("dqm", (), run),
        "dqm_perfilado": info("dqm", (), run),
        "dqm_indicador": info("dqm", (), run),
        "dqm_carga_dwa": info("dqm", (), run),
        "dqm_registro_rechazado": info("dqm", (), run),
    }
    return infos


def first_row(df: DataFrame, key: str) -> DataFrame:
    """One row per key so that an upsert is well defined."""
    return first_per_key(df, [key], [c for c in df.columns if c != key])


def shipper_rows(staged: Mapping[str, DataFrame]) -> DataFrame:
    return staged["shippers"].withColumnRenamed("shipper_id", "nk_shipper_id")


def customer_rows(staged: Mapping[str, DataFrame]) -> DataFrame:
    return staged["customers"].select(
        F.col("customer_id").alias("nk_customer_id"), "company_name", "contact_name", "contact_title", "city", "region", "country"
    )


def employee_rows(staged: Mapping[str, DataFrame]) -> DataFrame:
    return staged["employees"].select(
        F.col("employee_id").alias("nk_employee_id"),
        txt.full_name(F.col("first_name"), F.col("last_name")).alias("nombre_completo"),
        "title",
        "hire_date",
        "city",
        "country",
    )


def product_rows(products: DataFrame, categories: DataFrame, suppliers: DataFrame) -> DataFrame:
    flat = dims.denormalize(
        products,
        [
            dims.Reference(categories, ("category_id", "category_id"), {"category_name": "category_name", "description": "category_description"}),
            dims.Reference(suppliers, ("supplier_id", "supplier_id"), {"company_name": "supplier_name", "country": "supplier_country"}),
        ],
    )
    return flat.select(
        F.col("product_id").alias("nk_product_id"),
        "product_name",
        F.col("unit_price").alias("precio_lista"),
        (F.col("discontinued") == 1).alias("discontinued"),
        "category_name",
        "category_description",
        "supplier_name",
        "supplier_country",
    )


def intake_indicators(staged: Mapping[str, DataFrame]) -> DataFrame:
    """Null, business-rule and outlier indicators of the typed tables."""
    share, nulls, outliers = indicators.Share, indicators.null_share, indicators.Outliers

    def when(test: str):
        return lambda: F.expr(test)

    def table(name: str, wanted) -> DataFrame:
        return indicators.shares(f"tmp_{name}", staged[name], wanted)

    bosses = integrity.ForeignKey("tmp_employees", staged["employees"], "reports_to", staged["employees"], "employee_id")
    return indicators.all_of(
        [
            table("shippers", [nulls("company_name")]),
            table("categories", [nulls("category_name")]),
            table("suppliers", [nulls("company_name")]),
            table("customers", [nulls("company_name"), nulls("country", warn=10, error=30)]),
            table("employees", [nulls("first_name / last_name", "first_name", "last_name")]),
            indicators.foreign_key_share(bosses, "PCT_REPORTS_TO_INVALIDO"),
            table(
                "products",
                [
                    nulls("product_name"),
                    share("unit_price", "PCT_PRECIO_NEGATIVO", when("unit_price < 0"), 0, 1),
                    share("unit_price", "PCT_PRECIO_CERO", when("unit_price = 0 AND discontinued = 0"), 0, 5),
                    share("discontinued", "PCT_VALOR_INVALIDO", when("discontinued NOT IN (0, 1)")),
                ],
            ),
            indicators.outlier_shares("tmp_products", staged["products"], [outliers("unit_price", when("unit_price > 0"), lower=True)]),
            table(
                "orders",
                [
                    nulls("order_date"),
                    share("shipped_date", "PCT_SHIPPED_BEFORE_ORDER", when("shipped_date < order_date"), 0, 1),
                ],
            ),
            indicators.outlier_shares("tmp_orders", staged["orders"], [outliers("freight", when("freight >= 0"), when("freight IS NOT NULL"))]),
            table(
                "order_details",
                [
                    share("unit_price", "PCT_PRECIO_NEGATIVO", when("unit_price < 0")),
                    share("unit_price", "PCT_PRECIO_CERO", when("unit_price = 0"), 1, 5),
                    share("quantity", "PCT_CANTIDAD_INVALIDA", when("quantity <= 0")),
                    share("discount", "PCT_DESCUENTO_INVALIDO", when("discount < 0 OR discount > 1")),
                ],
            ),
            indicators.outlier_shares(
                "tmp_order_details",
                staged["order_details"],
                [outliers(c, when(f"{c} > 0"), when(f"{c} > 0")) for c in ("unit_price", "quantity")],
            ),
        ]
    )
