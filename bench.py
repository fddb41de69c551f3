"""Wall time of the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma-separated subset).
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from tastegraph.plans import load
from tastegraph.session import build_session

HEADLINE = ("item_cf", "user_cf", "content_recommend", "portrait_recommend", "user_portrait",
            "item_neighbours", "user_neighbours", "item_pair_stats", "keywords_textrank",
            "tag_merge", "item_features", "dataset_stats", "eval_rmse", "ratings_capped",
            "graph_components", "ad_kpis", "ad_log_parse", "geo_business_table", "factor_topk",
            "als_explicit", "als_all_users", "stream_batch_counts")


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES")
    spark = build_session("bench", f"local[{cpus}]", int(cpus) * 2, {
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tastegraph-bench-"), "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    registry = load().QUERIES
    spark.read.parquet(f"{root}/lineitem.parquet").write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in (names.split(",") if names else HEADLINE):
        start = time.perf_counter()
        registry[name](spark, root).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": os.path.basename(root.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
