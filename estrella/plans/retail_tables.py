"""Tables of the order-entry source: raw columns, staged types, rules and references.

The names and types are the fixed data contract of the source files and of the warehouse.
"""

from __future__ import annotations

from dataclasses import dataclass

from estrella.functions import numbers as num
from estrella.operators import rules
from estrella.operators.staging import Field

# Columns of the source files, in file order.
RAW_COLUMNS = {
    "categories": ["category_id", "category_name", "description", "picture"],
    "customers": [
        "customer_id", "company_name", "contact_name", "contact_title", "address", "city", "region", "postal_code",
        "country", "phone", "fax",
    ],
    "employees": [
        "employee_id", "last_name", "first_name", "title", "title_of_courtesy", "birth_date", "hire_date", "address",
        "city", "region", "postal_code", "country", "home_phone", "extension", "photo", "notes", "reports_to",
        "photo_path",
    ],
    "employee_territories": ["employee_id", "territory_id"],
    "order_details": ["order_id", "product_id", "unit_price", "quantity", "discount"],
    "orders": [
        "order_id", "customer_id", "employee_id", "order_date", "required_date", "shipped_date", "ship_via",
        "freight", "ship_name", "ship_address", "ship_city", "ship_region", "ship_postal_code", "ship_country",
    ],
    "products": [
        "product_id", "product_name", "supplier_id", "category_id", "quantity_per_unit", "unit_price",
        "units_in_stock", "units_on_order", "reorder_level", "discontinued",
    ],
    "regions": ["region_id", "region_description"],
    "shippers": ["shipper_id", "company_name", "phone"],
    "suppliers": [
        "supplier_id", "company_name", "contact_name", "contact_title", "address", "city", "region", "postal_code",
        "country", "phone", "fax", "homepage",
    ],
    "territories": ["territory_id", "territory_description", "region_id"],
    "customers_score": ["customer_id", "score"],
    "world_data": [
        "country", "density_p_km2", "abbreviation", "agricultural_land_pct", "land_area_km2", "armed_forces_size",
        "birth_rate", "calling_code", "capital_major_city", "co2_emissions", "cpi", "cpi_change_pct", "currency_code",
        "fertility_rate", "forested_area_pct", "gasoline_price", "gdp", "gross_primary_education_enrollment_pct",
        "gross_tertiary_education_enrollment_pct", "infant_mortality", "largest_city", "life_expectancy",
        "maternal_mortality_ratio", "minimum_wage", "official_language", "out_of_pocket_health_expenditure",
        "physicians_per_thousand", "population", "population_labor_force_participation_pct", "tax_revenue_pct",
        "total_tax_rate", "unemployment_rate", "urban_population", "latitude", "longitude",
    ],
}

# Separators other than the comma.
SEPARATORS = {1: {"customers": ";"}, 2: {"customers_score": ";"}}

FIRST_BATCH = [t for t in RAW_COLUMNS if t not in ("customers_score", "world_data")]
SECOND_BATCH = ["customers", "orders", "order_details", "products", "customers_score", "world_data"]

# Staged types; columns not named here are text.
TYPES = {
    "categories": {"category_id": "int"},
    "customers": {"customer_id": "char(5)"},
    "employees": {"employee_id": "int", "birth_date": "date", "hire_date": "date", "reports_to": "int"},
    "employee_territories": {"employee_id": "int"},
    "order_details": {
        "order_id": "int",
        "product_id": "int",
        "unit_price": "decimal(10,4)",
        "quantity": "int",
        "discount": "decimal(5,4)",
    },
    "orders": {
        "order_id": "int",
        "customer_id": "char(5)",
        "employee_id": "int",
        "order_date": "date",
        "required_date": "date",
        "shipped_date": "date",
        "ship_via": "int",
        "freight": "decimal(10,4)",
    },
    "products": {
        "product_id": "int",
        "supplier_id": "int",
        "category_id": "int",
        "unit_price": "decimal(10,4)",
        "units_in_stock": "int",
        "units_on_order": "int",
        "reorder_level": "int",
        "discontinued": "int",
    },
    "regions": {"region_id": "int"},
    "shippers": {"shipper_id": "int"},
    "suppliers": {"supplier_id": "int"},
    "territories": {"region_id": "int"},
    "customers_score": {"customer_id": "char(5)", "score": "int"},
    "world_data": {
        "density_p_km2": "decimal(14,4)",
        "agricultural_land_pct": "decimal(10,4)",
        "land_area_km2": "decimal(18,4)",
        "gdp": "decimal(20,2)",
        "life_expectancy": "decimal(10,4)",
        "population": "bigint",
        "unemployment_rate": "decimal(10,4)",
        "urban_population": "bigint",
        "latitude": "decimal(12,8)",
        "longitude": "decimal(12,8)",
    },
}

# The first batch rounds these through a narrower type.
NARROW = {
    "products": {"unit_price": "decimal(10,2)", "units_in_stock": "smallint", "units_on_order": "smallint",
                 "reorder_level": "smallint", "discontinued": "smallint"},
    "orders": {"freight": "decimal(10,2)"},
    "order_details": {"unit_price": "decimal(10,2)", "quantity": "smallint", "discount": "decimal(4,2)"},
}

# Text keys stored exactly as they arrive in the first batch.
KEPT = {"territories": ["territory_id"], "employee_territories": ["territory_id"]}

# World data columns that are kept.
WORLD_TEXT = ["country", "abbreviation", "capital_major_city", "currency_code"]

# Where the second batch also reads the null word as missing.
NULL_WORD_TOO = {"region", "ship_region", "shipped_date"}


def staged_fields(table: str, batch: int) -> list[Field]:
    types = TYPES[table]
    if table == "world_data":
        return [
            Field(c, types.get(c, "string"), nulls=("",), scrub=c in types)
            for c in RAW_COLUMNS[table]
            if c in types or c in WORLD_TEXT
        ]
    if batch == 1:
        narrow = NARROW.get(table, {})
        return [
            Field(c, types.get(c, "string"), via=narrow.get(c), keep=c in KEPT.get(table, ()))
            for c in RAW_COLUMNS[table]
        ]
    return [
        Field(
            c,
            types.get(c, "string"),
            nulls=("", "NULL") if c in NULL_WORD_TOO else ("",),
            prefix_date=types.get(c) == "date",
        )
        for c in RAW_COLUMNS[table]
    ]


KEYS = {
    "categories": ["category_id"],
    "customers": ["customer_id"],
    "employees": ["employee_id"],
    "employee_territories": ["employee_id", "territory_id"],
    "order_details": ["order_id", "product_id"],
    "orders": ["order_id"],
    "products": ["product_id"],
    "regions": ["region_id"],
    "shippers": ["shipper_id"],
    "suppliers": ["supplier_id"],
    "territories": ["territory_id"],
    "customers_score": ["customer_id"],
    "world_data": ["country"],
}


def first_batch_rules() -> dict[str, list[rules.Rule]]:
    nn, uq, pk = rules.not_null, rules.unique, rules.primary_key
    no_duplicates, composite = "SIN_DUPLICADOS", "PK_COMPUESTA_SIN_DUPLICADOS"
    positive = "ES_NUMERICO_POSITIVO"
    return {
        "categories": [nn("category_id"), uq(["category_id"], no_duplicates), rules.castable_int("category_id"), nn("category_name")],
        "customers": [
            nn("customer_id"),
            uq(["customer_id"], no_duplicates),
            rules.length_is("customer_id", 5, "LONGITUD_5"),
            nn("company_name"),
            rules.forbidden("country", "MX"),
        ],
        "employees": [
            nn("employee_id"),
            uq(["employee_id"], no_duplicates),
            rules.date_prefix("birth_date"),
            rules.int_or_null("reports_to"),
            nn("last_name"),
        ],
        "products": [
            nn("product_id"),
            uq(["product_id"], no_duplicates),
            nn("product_name"),
            rules.in_set("discontinued", ["0", "1"], "VALOR_0_O_1"),
            rules.numeric("unit_price"),
        ],
        "orders": [
            nn("order_id"),
            uq(["order_id"], no_duplicates),
            nn("customer_id"),
            rules.expected_nulls("shipped_date"),
            rules.numeric_between("freight", 0, None, positive),
        ],
        "order_details": [
            uq(["order_id", "product_id"], composite),
            rules.numeric_between("discount", 0, 1, "RANGO_0_A_1", num.WARNING),
            rules.int_between("quantity", 1, None, "ENTERO_POSITIVO"),
            rules.numeric_between("unit_price", 0, None, positive),
        ],
        "suppliers": [pk("supplier_id"), nn("company_name")],
        "shippers": [pk("shipper_id"), nn("company_name")],
        "regions": [pk("region_id"), nn("region_description")],
        "territories": [pk("territory_id"), rules.castable_int("region_id", null_word=True)],
        "employee_territories": [
            uq(["employee_id", "territory_id"], composite),
            rules.castable_int("employee_id", null_word=True),
        ],
    }


def second_batch_rules() -> dict[str, list[rules.Rule]]:
    return {
        "customers": [rules.length_is("customer_id", 5, "PK no nula y largo 5", needed=True)],
        "orders": [
            rules.numeric_key(["order_id"], "PK numerica no nula"),
            rules.unique(["order_id"], "Duplicados de PK"),
            rules.date_prefix("order_date", "Fecha valida", needed=True),
        ],
        "products": [
            rules.numeric_key(["product_id"], "PK numerica no nula"),
            rules.in_set("discontinued", ["0", "1"], "Flag 0/1", trimmed=True),
        ],
        "order_details": [
            rules.numeric_key(["order_id", "product_id"], "PK compuesta numerica"),
            rules.unique(["order_id", "product_id"], "Duplicados de PK compuesta", joiner="/"),
            rules.int_between("quantity", 1, None, "Cantidad positiva", trimmed=True),
            rules.numeric_between("discount", 0, 1, "Descuento entre 0 y 1", trimmed=True),
        ],
        "customers_score": [rules.int_between("score", 1, 5, "Score entre 1 y 5", trimmed=True)],
        "world_data": [rules.required("country", "Pais obligatorio")],
    }


# Profiled columns and the texts counted as null besides NULL itself.
FIRST_PROFILES = {
    "categories": {c: ("",) for c in ("category_id", "category_name", "description")},
    "customers": {"customer_id": ("",), "country": ("",), "city": ("",), "region": ("", "NULL")},
    "employees": {"employee_id": ("",), "birth_date": ("NULL",), "hire_date": ("NULL",), "reports_to": ("NULL",)},
    "employee_territories": {"employee_id": ("",), "territory_id": ("",)},
    "order_details": {c: ("",) for c in ("order_id", "product_id", "unit_price", "quantity", "discount")},
    "orders": {"order_id": ("",), "customer_id": ("",), "order_date": ("NULL",), "shipped_date": ("NULL",), "freight": ("",), "ship_country": ("",)},
    "products": {c: ("",) for c in ("product_id", "product_name", "unit_price", "units_in_stock", "discontinued")},
    "regions": {"region_id": ("",), "region_description": ("",)},
    "shippers": {"shipper_id": ("",), "company_name": ("",)},
    "suppliers": {"supplier_id": ("",), "company_name": ("",), "country": ("",)},
    "territories": {"territory_id": ("",), "region_id": ("",)},
}
SECOND_PROFILES = {
    "customers": ["customer_id"],
    "orders": ["order_id", "customer_id"],
    "order_details": ["order_id"],
    "products": ["product_id"],
    "customers_score": ["score"],
    "world_data": ["country"],
}


@dataclass(frozen=True)
class Link:
    """``child.column`` refers to ``parent.parent_key``; orphans are listed by ``key``."""

    child: str
    column: str
    parent: str
    parent_key: str
    key: str


LINKS = [
    Link("territories", "region_id", "regions", "region_id", "territory_id"),
    Link("products", "supplier_id", "suppliers", "supplier_id", "product_id"),
    Link("products", "category_id", "categories", "category_id", "product_id"),
    Link("orders", "customer_id", "customers", "customer_id", "order_id"),
    Link("orders", "employee_id", "employees", "employee_id", "order_id"),
    Link("orders", "ship_via", "shippers", "shipper_id", "order_id"),
    Link("order_details", "order_id", "orders", "order_id", "order_id"),
    Link("order_details", "product_id", "products", "product_id", "product_id"),
    Link("employees", "reports_to", "employees", "employee_id", "employee_id"),
    Link("employee_territories", "employee_id", "employees", "employee_id", "employee_id"),
    Link("employee_territories", "territory_id", "territories", "territory_id", "territory_id"),
]

# Indicator name per checked reference of the first batch.
LINK_SHARES = [
    ("order_details", "order_id", "PCT_OD_SIN_ORDER"),
    ("order_details", "product_id", "PCT_OD_SIN_PRODUCTO"),
    ("orders", "ship_via", "PCT_ORDER_SIN_SHIPPER"),
    ("products", "category_id", "PCT_PROD_SIN_CATEGORY"),
    ("products", "supplier_id", "PCT_PROD_SIN_SUPPLIER"),
]
