"""Headline queries, timed; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from matchloom.plans import eval_queries, match_queries, profile_queries, shared
from matchloom.session import local_session

HEADLINE = [
    "flagship_metrics", "bm25_products", "tfidf_char_top5", "tfidf_word1_top5", "tfidf_word12_top5", "bm25_top5",
    "dense_top5", "normalize_text_articles", "idf_words", "token_freq", "vocabulary_coverage", "length_stats",
    "duplicate_groups", "pattern_shares", "reranked_top5",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    known = {**match_queries.QUERIES, **profile_queries.QUERIES, **eval_queries.QUERIES}
    spark.range(1000).selectExpr("sum(id)").collect()
    took = {}
    for name in HEADLINE:
        shared.forget()                      # every query pays for its own index
        spark.catalog.clearCache()
        start = time.perf_counter()
        known[name][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - start, 3)
        print(name, took[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_time_headline_queries", "value": round(sum(took.values()), 3), "unit": "sec",
                      "queries": took, "sf": sf_dir.rstrip("/").split("sf")[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
