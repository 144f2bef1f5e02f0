"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
Each time covers building the plan, any written intermediate and the full result. ``star_build``
rebuilds the whole star; the mart and report queries read the star stored in this session, whose
first build is ``star_first``.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.queries import registry  # noqa: E402
from estrella.plans.sample import Source  # noqa: E402
from estrella.plans.star import star_of  # noqa: E402
from estrella.session import build_session, release_materialized  # noqa: E402

HEADLINE = [
    "rules_batch1",
    "rules_offenders",
    "profile_columns",
    "norm_text_nulls",
    "fk_checks",
    "fk_shares",
    "ind_business",
    "ind_outliers",
    "quantiles_distributed",
    "star_build",
    "fact_load",
    "fact_upsert",
    "fact_upsert_partitions",
    "dim_upsert",
    "scd2_init",
    "scd2_merge",
    "scd2_as_of",
    "enrich_customer",
    "enrich_product",
    "global_rank",
    "global_ntile",
    "mart_period",
    "mart_customer",
    "mart_product",
    "mart_seller",
    "mart_geo",
    "report_top_customers",
    "report_geo_year",
    "ledger_inventory",
]


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry()
    times: dict[str, float] = {}

    start = time.perf_counter()
    star_of(spark, Source(spark, directory), directory)
    times["star_first"] = round(time.perf_counter() - start, 3)
    for name in HEADLINE:
        start = time.perf_counter()
        queries[name](spark, directory).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    release_materialized(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(directory).name.removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
