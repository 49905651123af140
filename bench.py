"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR: input folder (default /root/testdata/sf0.1). BENCH_CPUS: local cores.
Every query is planned, staged and run to a sink that discards its rows.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from casewatch.plans.registry import QUERIES  # noqa: E402
from casewatch.session import local_session  # noqa: E402

HEADLINE = (
    "daily_counts",
    "gap_fill",
    "rolling_zscore",
    "holt_winters_fit",
    "isolation_forest",
    "anomaly_table",
    "flatten_reports",
    "dedup_reports",
    "merge_labels",
    "make_batches",
    "categorize_rules",
    "categorize_mapinpandas",
    "embed_documents",
    "vector_upsert",
    "knn_topk",
    "context_interval_join",
    "context_topn",
    "explain_extractive",
    "faithfulness",
    "categorization_accuracy",
    "stream_ingest",
    "stream_daily_counts",
)
WARM_UP = ("anomaly_table", "faithfulness")


def run(spark, name, folder):
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, shuffle_partitions=int(cores) if cores.isdigit() else 8, app="bench")
    for name in WARM_UP:  # JVM start-up and first compilation are not part of any query
        run(spark, name, folder)
    seconds = {name: round(run(spark, name, folder), 3) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "total wall time of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
