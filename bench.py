"""Time the two loads and the reports; prints one JSON line.

    BENCH_SF_DIR  folder of the test tables (default /root/testdata/sf0.1)
    BENCH_CPUS    local threads (default 8)

The operational tables are first written as Parquet (not timed), as the loads of
a deployment also start from existing tables.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from chronostar.catalog.lab import FULL_TS, INC_ID, INC_TS  # noqa: E402
from chronostar.catalog.queries import CHANNELS  # noqa: E402
from chronostar.plans import reports  # noqa: E402
from chronostar.plans.jobs import full_load, incremental_load  # noqa: E402
from chronostar.schemas import SOURCE  # noqa: E402
from chronostar.session import build_session  # noqa: E402
from chronostar.sources.fixtures import FixtureSource  # noqa: E402
from chronostar.sources.extracts import read_extract
from chronostar.sources.tables import ParquetSource  # noqa: E402
from chronostar.sources.warehouse import Warehouse  # noqa: E402


def prepare(spark, sf_dir: str, root: str) -> None:
    for snapshot in (1, 2):
        fixtures = FixtureSource(spark, sf_dir, snapshot)
        for table in SOURCE:
            fixtures.table(table).write.parquet(f"{root}/source{snapshot}/{table}")
        micros = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
        extract = fixtures.extract().drop("_seq")
        extract.write.option("header", True).option("timestampNTZFormat", micros).csv(f"{root}/extract{snapshot}")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    root = tempfile.mkdtemp(prefix="bench-")
    prepare(spark, sf_dir, root)

    times: dict[str, float] = {}

    def timed(name: str, run) -> None:
        start = time.perf_counter()
        run()
        times[name] = round(time.perf_counter() - start, 3)

    store = Warehouse(spark, f"{root}/warehouse")
    first, second = ParquetSource(spark, f"{root}/source1"), ParquetSource(spark, f"{root}/source2")

    def extract(snapshot: int):
        return read_extract(spark, f"{root}/extract{snapshot}")

    timed("full_load", lambda: full_load(store, first, extract(1), FULL_TS, "full"))
    timed("incremental_load", lambda: incremental_load(store, second, extract(2), INC_ID, INC_TS, "inc"))

    star = {t: store.star(t) for t in ("fact_sales", "dim_user", "dim_course", "dim_date", "dim_traffic_source")}
    fact, days = star["fact_sales"], star["dim_date"]
    for name, df in {
        "revenue_by_quarter": reports.revenue_by_quarter(fact, days),
        "traffic_source_pivot": reports.traffic_source_pivot(fact, days, star["dim_traffic_source"], CHANNELS),
        "top_selling_courses": reports.top_selling_courses(fact, star["dim_course"]),
        "filtered_revenue": reports.filtered_revenue(
            fact, star["dim_user"], star["dim_course"], days, categories=("ECONOMY", "PROMO", "STANDARD")
        ),
    }.items():
        timed(name, lambda df=df: df.write.format("noop").mode("overwrite").save())

    print(
        json.dumps(
            {
                "metric": "full load, incremental load and reports",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
