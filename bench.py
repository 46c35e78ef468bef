"""Times headline queries; one JSON line. BENCH_SF_DIR and BENCH_CPUS choose data and cores."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from scriptorium.plans.queries import QUERIES  # noqa: E402
from scriptorium.session import local_session, ship  # noqa: E402

HEADLINE = ("line_scan", "line_audit", "carry_forward", "work_statistics", "segment", "regex_candidates", "gazetteer_context",
            "merge_entities", "kb_surfaces", "eval_strict", "pilot_sample", "export_manifest")


def main() -> None:
    data = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = ship(local_session(os.environ.get("BENCH_CPUS", "8")))
    spark.sparkContext.setLogLevel("OFF")
    spark.read.parquet(f"{data}/documents.parquet").selectExpr("sum(length(text))").collect()  # start-up is not timed
    took = {}
    for name in HEADLINE:
        began = time.time()
        QUERIES[name](spark, data).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "headline_queries_wall", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took,
                      "sf": os.path.basename(data.rstrip("/"))}))


if __name__ == "__main__":
    main()
