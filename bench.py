"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from loanweave.session import build_session

HEADLINE = (
    "interaction_rank",
    "temporal_split",
    "user_stats",
    "sparsity",
    "catalog_with_counts",
    "clean_title_author_publisher",
    "normalize_subject",
    "rare_author_encoding",
    "subject_tfidf",
    "char_ngram_tfidf",
    "user_author_matrix",
    "user_subject_tfidf",
    "user_embedding_mean",
    "popular_unseen_topk",
    "map_at_10_popularity",
    "embedding_scores_topk",
    "item_item_cf_topk",
    "user_user_cf_topk",
    "subject_canonical_map",
    "cmf_side_half_step",
    "cmf_predict_topk",
    "cmf_fit_recommend",
    "als_recommend",
    "full_training_submission",
    "recommend_with_fallback",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = os.environ.get("BENCH_QUERIES")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": 2 * cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    from loanweave import checks

    checks.load()
    names = only.split(",") if only else HEADLINE
    # one small run first, so that no query pays for starting the workers
    checks.RUNS["normalize_subject"](spark, folder).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        start = time.perf_counter()
        checks.RUNS[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        if os.environ.get("BENCH_VERBOSE"):
            print(name, times[name], flush=True)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
