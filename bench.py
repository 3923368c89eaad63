"""Time the headline queries: BENCH_SF_DIR and BENCH_CPUS choose the data and the cores. Prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from reelsift.session import build_session  # noqa: E402
from workload import REGISTRY  # noqa: E402
from workload.registry import Tables  # noqa: E402

HEADLINE = [
    "m1_trending_with_details",
    "m3_tag_statistics",
    "m4_top_tags",
    "m5_category_distribution",
    "m6_monthly_categories",
    "m7_by_genre",
    "m9_by_country",
    "m10_best_trailers",
    "m11_coverage",
    "k1_raw_catalogue",
    "k2_enriched_catalogue",
    "k3_trending_cleaned",
    "k4_merged_videos",
    "j9_title_in_text",
    "j11_best_with_ties",
    "f22_rounded",
    "f31_first_match",
    "f32_last_match",
    "f33_catalogue_genres",
    "d3_tag_bridge",
    "d6_artist_genres",
    "n1_first_in_order",
    "n5_dense_ids",
    "e4_mixed_precedence",
    "s13_upserted",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    tables = Tables(spark, folder)
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        runs = []
        for _ in range(repeats + 1):
            start = time.perf_counter()
            REGISTRY[name].run(tables).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        # The first run warms the JVM.
        seconds[name] = round(statistics.median(runs[1:] or runs), 4)
        print(f"{name} {seconds[name]:.3f}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
