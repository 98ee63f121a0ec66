"""Wall time of the headline queries: prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores. Every query runs once to warm up and
then BENCH_RUNS times (2 by default) into a sink that takes all rows; the best time counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tidemill.plans import load_all
from tidemill.plans.registry import QUERIES, TWINS
from tidemill.session import build_session

HEADLINE = [
    "order_payments_mart", "join_bridge", "join_composite_three", "rate_change", "agg_having", "pivot_matrix", "dedup_on_keys",
    "upsert_by_key", "dq_unique", "correlated_counts", "top3_cross_counts", "moving_average_halfday", "observed_predicted_union",
    "running_volume", "downsample_series", "boxplot_summary", "describe_profile", "kruskal_h", "corr_matrix", "acf",
    "seasonal_decompose", "performance_ratios", "knn_exact", "knn_classify", "silhouette", "dbscan", "tokenize_basic",
    "preprocess_text", "bag_of_words", "encode_pad", "page_fields", "stream_nested_json",
]


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def best(run, runs: int) -> float:
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return min(times)


def yardstick(sf_dir: str, names: list[str], cpus: int) -> dict[str, float]:
    """DuckDB's time for the SQL twin of each query on the same tables, where the package is there."""
    try:
        import duckdb
    except ImportError:
        return {}
    con = duckdb.connect(config={"threads": cpus})
    for file in os.listdir(sf_dir):
        if file.endswith(".parquet"):
            con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{file}'")
    return {n: round(best(lambda: con.execute(TWINS[n]).fetchall(), 1), 3) for n in names if n in TWINS}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    load_all()
    spark = build_session(
        f"local[{cpus}]", "bench", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g", spark__log__level="ERROR",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        run = lambda: drain(QUERIES[name](spark, sf_dir))  # noqa: E731,B023
        run()
        seconds[name] = round(best(run, runs), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, warm wall time", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir).removeprefix("sf"), "duckdb": yardstick(sf_dir, names, cpus),
    }))


if __name__ == "__main__":
    main()
