"""Times the registered queries on ``$BENCH_SF_DIR`` with ``$BENCH_CPUS`` threads.

Prints one JSON line. Each query runs three times over all rows into a no-op sink. The first run
warms up the JVM and the generated code; the better of the others counts. The time includes building
the plan, and for the warehouse load all writes.
"""

from __future__ import annotations

import json
import os
import sys
import time

from lodgestar.session import build_session
from validation.queries import all_queries

HEADLINE = [
    "scan_listings_csv",
    "scan_calendar_csv",
    "scan_review_text_split",
    "sentiment_rating",
    "dim_room_type",
    "dim_neighbourhood",
    "dim_date",
    "dim_host",
    "join_reviews_listings",
    "left_join_calendar",
    "fact_reviews",
    "star_joined",
    "reviews_by_year_pivot",
    "reviews_by_year_city",
    "avg_price_by_month_pivot",
    "host_ratings",
    "top_hosts_per_group",
    "top_hosts_sql",
    "warehouse_full_load",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.driver.memory": "8g",
            # Python call sites for error messages cost several calls per column expression.
            "spark.python.sql.dataFrameDebugging.enabled": "false",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    seconds = {}
    for name in names:
        runs = []
        for _ in range(3):
            start = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs[1:]), 3)
    result = {
        "metric": "total_query_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
