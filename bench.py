"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sourceloom.plans.queries import QUERIES  # noqa: E402
from sourceloom.plans.session import local_session  # noqa: E402

HEADLINE = ("chunk_report", "functions_all", "functions_java", "functions_python", "syntax_gate", "skip_report", "calls",
            "called_by", "point_ids", "line_metrics", "complexity", "doc_clean_block", "truncate_tokens", "hash_embed",
            "mean_pool", "l2_normalize", "cosine_topk_filtered", "nearest_points", "changed_files", "upsert")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, partitions=2 * int(cpus) if cpus.isdigit() else 16)
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total query time", "value": total, "unit": "sec", "queries": seconds,
                      "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
