"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR is the data folder, BENCH_CPUS the local cores.
"""

import json
import os
import time

from threadglean.plans.workload import QUERIES
from threadglean.session import get_spark

HEADLINE = [
    "thread_ranking", "joined_analysis", "mask_bodies", "parse_comments", "dedup_posts",
    "posts_comments_join", "new_summaries_anti", "append_defaults", "summary_upsert",
    "summarize_default", "sentiment_default", "dq_suite", "dq_by_community", "top3_views",
    "thread_emotions", "text_blocks", "report_body", "log_summarize_metrics", "error_rate_5m",
]
# Timed and listed too, but not part of the total, which stays comparable over time.
OTHERS = ["mask_by_lookup", "dq_incremental", "markdown_reports", "classify_learned", "error_rate_sliding"]


def seconds(spark, sf_dir, name):
    begin = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = get_spark("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
                      spark__ui__enabled="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    seconds(spark, sf_dir, "dq_not_null")  # start-up is not part of a query
    best = {name: round(min(seconds(spark, sf_dir, name) for _ in range(runs)), 3)
            for name in HEADLINE + OTHERS}
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(best[name] for name in HEADLINE), 3),
                      "unit": "sec", "queries": best, "sf": os.path.basename(sf_dir.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
