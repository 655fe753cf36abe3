"""Time the headline queries: one warm-up, then the median of three runs into the noop sink.

Prints one JSON line. BENCH_SF_DIR names the tables, BENCH_CPUS the cores, BENCH_QUERIES (comma-separated, or
"all") a selection, BENCH_RUNS the number of timed runs.
"""

import json
import os
import statistics
import sys
import time

from checks import QUERIES
from checks.compare import local_session

HEADLINE = [
    # the ten analytic queries
    "articles_by_author", "title_contains", "works_of_top_authors", "top_venue_in_year", "h_index",
    "years_with_min_articles", "years_with_cited_articles", "i10_index", "topical_venues", "venues_of_affiliation",
    # relations and tables
    "enrich_authors", "resolve_edges", "child_parent_edges", "edge_properties", "drop_edges_both",
    "recount_in_degree", "adjacency_lists", "author_table", "article_table", "venue_article_lists", "graph_edges",
    # documents
    "author_embed", "document_sections", "sections_as_coded", "tag_keywords", "embed_citations",
    "documents_end_to_end",
]


def run_once(spark, name, folder):
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    seconds = {}
    # The JVM compiles much of what the queries share during this first round.
    for name in names:
        run_once(spark, name, folder)
    for name in names:
        seconds[name] = round(statistics.median(run_once(spark, name, folder) for _ in range(runs)), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "sum of median query times", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
