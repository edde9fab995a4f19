"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` (default sf0.1), ``BENCH_CPUS`` (default all cores) and
``BENCH_QUERIES`` (comma separated) choose what runs. Every query is consumed
completely, in this order; those under ``REPEAT_BELOW`` seconds run three times
and report the median. The written tables that later steps
share (standardized mails, vectors) are timed where they are built:
``q_standardize`` is the whole run from the raw feeds, ``stage_mails`` and
``stage_vectors`` the tables the other queries read.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from mailrisk.session import build_session
from workload import queries, tables

HEADLINE = (
    "q_standardize", "stage_mails", "q_standardize_summary", "q_clean_text", "q_clean_html",
    "q_parse_email", "q_metadata_features", "q_model_input", "q_missing", "q_length_histogram",
    "q_duplicate_stats", "q_cleaned_dedup", "q_top_terms", "q_split", "q_vocabulary", "stage_vectors",
    "q_tfidf", "q_naive_bayes", "q_metrics", "q_roc", "q_near_duplicates", "q_score",
    "q_explain_text", "q_explain_metadata", "q_score_pasted", "q_lr_text", "q_svm",
    "q_lr_text_metadata", "q_csv_ingest", "q_score_stream", "q_svd", "q_random_forest",
    "q_dedup_benchmark", "q_source_holdout",
)
REPEAT_BELOW = 10.0
STAGES = {
    "stage_mails": lambda spark, folder: tables.mails(spark, folder).limit(0),
    "stage_vectors": lambda spark, folder: queries.vector_table(spark, folder)[0].limit(0),
}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "*")
    chosen = [name for name in os.environ.get("BENCH_QUERIES", "").split(",") if name]
    spark = build_session(
        "bench", master=f"local[{cpus}]",
        **{
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "16",
            # The given files have one row group each.
            tables.SPREAD: "true",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()

    def timed(name: str) -> float:
        start = time.perf_counter()
        result = (STAGES.get(name) or queries.QUERIES[name])(spark, folder)
        result.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds: dict[str, float] = {}
    for name in chosen or HEADLINE:
        taken = [timed(name)]
        while name not in STAGES and taken[0] < REPEAT_BELOW and len(taken) < 3:
            taken.append(timed(name))
        seconds[name] = round(statistics.median(taken), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    scale = folder.rstrip("/").rsplit("sf", 1)[-1]
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))
    spark.stop()


if __name__ == "__main__":
    main()
