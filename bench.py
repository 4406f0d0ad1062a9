"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lexharbor.session import local_session  # noqa: E402
from lexharbor.verify import inputs as I  # noqa: E402
from lexharbor.verify.queries import QUERIES  # noqa: E402

HEADLINE = ("tokenize", "analyze_en_stem", "postings", "term_stats", "search_term",
            "search_phrase", "search_fuzzy", "search_prefix", "search_topk", "search_ranked",
            "search_batch", "snippets_merged", "fragments", "lang_detect", "upsert",
            "remove_prefix", "fold_changes", "suggest_terms")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, memory=os.environ.get("BENCH_MEMORY", "16g"),
                          partitions=2 * int(cpus) if cpus.isdigit() else 16)
    times: dict[str, float] = {}

    start = time.time()
    I.stored_index(spark, sf_dir)
    times["index_build"] = round(time.time() - start, 3)
    for name in names:
        start = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)

    n_docs = I.table(spark, sf_dir, "documents").count()
    n_queries = {"term": I.words(spark, sf_dir).count(),
                 "phrase": I.phrase_queries(spark, sf_dir).count(),
                 "fuzzy": I.typo_queries(spark, sf_dir).count()}
    rates = {"docs_per_sec_index": round(n_docs / times["index_build"], 1)}
    for kind, n in n_queries.items():
        if f"search_{kind}" in times:
            rates[f"sec_per_1000_{kind}_queries"] = round(1000 * times[f"search_{kind}"] / n, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "rates": rates,
                      "sf": sf_dir.rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
