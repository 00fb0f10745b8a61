"""Times headline queries and prints one JSON line.

BENCH_SF_DIR (default sf0.1) and BENCH_CPUS choose the data and the cores. Each
query runs once to warm up and is then timed end to end, from building the
DataFrame to writing every row to a sink that discards them.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "energy_by_sector_share",
    "energy_long_by_authority",
    "renewables_long",
    "emissions_by_sector",
    "emissions_by_year",
    "heating_share_by_rule",
    "unpivot_drop_nulls",
    "cast_marker",
    "share_of_total",
    "share_within_group",
    "total_by_day",
    "total_two_keys",
    "join_then_count",
    "join_points_in_areas",
    "pivot_sum_by_year",
    "filter_latest_year_of_other",
    "row_ids_of_distinct",
    "profile_columns",
    "classify_documents",
    "readings_daily_by_end_time",
    "station_generation",
    "write_csv_with_nulls",
]


def main() -> None:
    from wattshed.catalogue import CATALOGUE
    from wattshed.session import session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
        "spark.driver.memory": "8g",
    }
    if not os.environ.get("SPARK_CHECKPOINT_DIR"):
        conf["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="wattshed-bench-")
    spark = session("wattshed-bench", f"local[{cpus}]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        for run in ("warm", "timed"):
            start = time.perf_counter()
            CATALOGUE[name].run(spark, folder).write.format("noop").mode("overwrite").save()
            if run == "timed":
                times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale[1]) if scale else None,
            }
        )
    )


if __name__ == "__main__":
    main()
