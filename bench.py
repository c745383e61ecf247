"""Headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import time

from lodestone import catalog
from lodestone.session import local_session

NAMES = ["dense_topk", "hybrid_topk", "near_dup_pairs", "greedy_chunks", "section_parents", "latest_per_group", "quote_containment", "garble_score"]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    found = {}
    for name in NAMES:
        started = time.time()
        catalog.queries()[name](spark, sf).write.format("noop").mode("overwrite").save()
        found[name] = round(time.time() - started, 3)
    print(json.dumps({"metric": "headline_queries", "value": round(sum(found.values()), 3), "unit": "sec", "queries": found, "sf": sf}))


if __name__ == "__main__":
    main()
