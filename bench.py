"""Time the headline queries; prints one JSON line.

Reads BENCH_SF_DIR (default /root/testdata/sf0.1) and runs on local[BENCH_CPUS]. Each
query is run once to warm up and then BENCH_RUNS times (default 3); the median counts.
With query name prefixes as arguments, those queries are timed instead.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from larkspur.plans import QUERIES
from larkspur.session import build_session

HEADLINE = [
    "a02_group_count",
    "a04_multi_aggregate",
    "a11_distinct_tuples",
    "a14_median_per_year",
    "a17_list_frequency_shell",
    "a19_top_value_counts",
    "a24_box_plot",
    "a25_values_per_key",
    "a26_duplicated_rows",
    "a31_type_profile_per_label",
    "c05_accent_folding",
    "c10_locale_price",
    "c16_html_to_text",
    "j01_inner_using",
    "j03_multiway_top_actors",
    "j04_left_star_with_defaults",
    "j05_currency_lookup",
    "j09_overlapping_intervals",
    "j10_ip_location",
    "n01_json_to_columns",
    "q13_stage_sales",
    "q15_sales_flat",
    "q10_upsert",
    "s12_partitioned_json_sink",
    "t03_top_customers_of_year",
    "w01_rank_rows_in_partition",
    "w04_dense_rank_rows",
    "w05_top3_customers_per_nation",
    "w05_topk_per_genre_year",
    "w07_row_number_dedup",
    "x03_running_word_count",
    "x08_event_enrichment",
    "x09_star_load",
    "x25_hourly_views_by_browser_os",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [q for q in sorted(QUERIES) if any(q.startswith(p) for p in sys.argv[1:])] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times = {}
    for name in names:
        seconds(name)
        times[name] = round(statistics.median(seconds(name) for _ in range(runs)), 3)
    result = {
        "metric": "sum of median query times",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
