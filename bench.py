"""Time the headline queries, the better of two runs each after a warm-up, and print one JSON line.

``queries`` are whole times, ``build`` the part before the result is asked for: planning and eager steps.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from stockline.catalog import QUERIES  # noqa: E402

HEADLINE = [
    "group_day_rollup", "trailing_sum", "ts_agg_mc", "ts_agg_br", "ts_agg_cat_lv2", "ts_agg_cat_lv2_br",
    "ts_agg_mc_rows", "consc_mc_br", "consc_cat_lv2_ds", "basic_features", "lat_long", "promo_onehot",
    "freq_cut_categorical", "baseline_grouping_sets", "eval_metrics", "combine_features", "dbscan_clusters",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("stockline-bench")
             .config("spark.sql.shuffle.partitions", cpus)
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "16g")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/lineitem.parquet").count()

    def run(name: str) -> tuple[float, float]:
        began = time.perf_counter()
        df = QUERIES[name](spark, folder)
        built = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - began, 3), round(built - began, 3)

    run(HEADLINE[0])
    seconds, build = {}, {}
    for name in sys.argv[1:] or HEADLINE:
        seconds[name], build[name] = min(run(name), run(name))
        print(name, seconds[name], build[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "build": build, "sf": float(os.path.basename(folder.rstrip("/")).removeprefix("sf") or 0)}))


if __name__ == "__main__":
    main()
