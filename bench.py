"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 1).
Each query runs once to warm up the session as a whole (at the smallest scale) and then BENCH_RUNS times
at the wanted scale; the median is reported. Execution is forced with the noop sink. The forecasting round is not
among them: on the rows of the model table it grows some thirty trees, which takes minutes at sf0.1.
"""

import json
import os
import statistics
import sys
import time

from checks import QUERIES
from shelfwise.session import spark_session

HEADLINE = [
    "promotion_sales_report",
    "promo_interval_expand",
    "best_offer_per_day",
    "best_offer_whole_row",
    "promo_age_latest",
    "offers_by_split",
    "outlier_repair",
    "daily_sales_agg",
    "modal_price",
    "mean_area_price",
    "median_by_item",
    "median_by_store_type",
    "panel_history_week",
    "panel_union_distinct",
    "feature_table",
    "model_table_report",
    "extra_features",
    "low_sales_series",
    "label_encode",
    "weight_by_row",
    "eligibility",
    "sell_through_by_warehouse",
    "validation_report",
    "corr_top10",
    "corr_matrix",
    "period_text_parse",
    "stream_incremental_ingest",
    "item_ridge_fits",
]


def force(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = spark_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": str(4 * int(cpus)),
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "20g"),
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    warm = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    seconds = {}
    for name in names:
        force(QUERIES[name](spark, warm if os.path.isdir(warm) else sf_dir))
        taken = []
        for _ in range(runs):
            start = time.time()
            force(QUERIES[name](spark, sf_dir))
            taken.append(time.time() - start)
        seconds[name] = round(statistics.median(taken), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
