"""Time headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), and
BENCH_RUNS (default 3) after one warm-up run. Every result is produced in
full and thrown away by the no-op sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from catalog import QUERIES
from plumbline.session import get_session

HEADLINE = (
    "marketplace_spend_on_spine",
    "marketplace_spend",
    "internet_circuits",
    "health_claims",
    "claims_totals_per_zip",
    "four_way_claims_join",
    "fleet_costs",
    "federal_surplus",
    "state_surplus",
    "certified_businesses",
    "positions_and_salary",
    "temporary_staff",
    "employee_residences",
    "facilities",
    "utilities_and_maintenance",
    "retiree_payments",
    "retirement_employers",
    "travel_spend",
    "free_text_location",
    "first_listed_word_in_documents",
    "first_row_per_key",
    "row_numbers_by_several_columns",
    "footer_rows_skipped",
    "spelling_map_replacement",
    "null_profile",
    "county_all_years",
    "city_year_table_21_22",
    "out_of_state_summary",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = get_session(
        "bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
        spark__ui__enabled="false",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="plumbline-bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline queries, sum of medians", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
