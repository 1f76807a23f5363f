"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and print one JSON line.

Each query runs once, whole result, into Spark's no-op sink. The index that the searches read is built before them.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

from termloom import local_session
from termloom.plans.registered import QUERIES, stored_index

HEADLINE = (
    "build_index", "index_append", "stream_index", "doc_term_counts", "doc_norms", "stemmed_counts", "postings_lists",
    "term_idf", "bool_expr", "bool_expr_paren", "bool_bulk", "vector_search", "vector_topk", "vector_ranked",
    "vector_bulk", "vector_bulk_bucketed", "vector_conversations", "pages_text", "link_edges", "crawl_reach",
    "crawl_index",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, memory="16g", shared=tempfile.mkdtemp(prefix="bench-"))
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    # The start of Spark and the index that the searches share are paid for, and timed, apart.
    start = time.time()
    spark.read.parquet(f"{folder}/documents.parquet").groupBy("lang").count().collect()
    apart = {"start": round(time.time() - start, 3)}
    start = time.time()
    stored_index(spark, folder)
    apart["stored_index"] = round(time.time() - start, 3)
    for name in HEADLINE:
        start = time.time()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    scale = re.search(r"sf([0-9.]+)", folder)
    result = {
        "metric": "total time of headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "apart": apart, "sf": float(scale.group(1)) if scale else None,
    }
    print(json.dumps(result), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
