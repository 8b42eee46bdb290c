"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``: one JSON line.

Shared tables (index, judgements, runs) are built first and timed apart, as a
search engine builds its index once.  Every query is then run to completion
without collecting its rows.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = (
    "analyze", "postings", "bm25_search", "bm25_scores", "bm25_turns", "spell_correct", "feedback_terms",
    "expansion_terms", "bm25_expanded", "ltr_features", "lambda_gradients", "lambdamart_rank",
    "random_forest_rank", "rerank_coverage", "annotated_ranking", "eval_map", "eval_bpref", "eval_ndcg",
    "eval_report", "experiment", "fnc_score_folds",
)


def main() -> None:
    from pyspark.sql import SparkSession

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("passagerank-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    from passagerank.registry import QUERIES
    from passagerank.testbed import Testbed

    bed = Testbed(spark, sf_dir)
    build = {}
    for name in ("index", "qrels", "run", "tied_run", "ltr_rows"):
        start = time.perf_counter()
        getattr(bed, name)
        build[name] = round(time.perf_counter() - start, 3)

    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "build": build,
                "sf": Path(sf_dir).name,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
