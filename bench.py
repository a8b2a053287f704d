"""Times the headline queries and prints one JSON line.

Every query is carried out in full: all its rows go to Spark's no-op sink. Each builds the
derived tables that it reads itself, so its time does not depend on the queries before it.
"""

from __future__ import annotations

import json
import os
import sys
import time

from linkweave.plans import fixtures
from linkweave.plans.queries import QUERIES
from linkweave.session import build_session, drop_stored

HEADLINES = [
    "upsert_latest_wins", "blocks", "candidate_pairs", "best_targets", "classified_targets", "pair_attributes",
    "training_set", "undersample", "scoring_set", "pair_scores", "top_k_with_fallback",
    "export_assembly", "no_match_export", "field_values", "auto_approve", "term_counts",
    "tfidf_terms", "pair_cosine", "name_frequency",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINES
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cores}]",
            "spark.sql.shuffle.partitions": cores,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        fixtures.forget()
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    drop_stored(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
