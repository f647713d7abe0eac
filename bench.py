"""Headline queries, timed. Prints one JSON line."""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from paperloom.plans.catalog import QUERIES  # noqa: E402
from paperloom.session import local_session  # noqa: E402

HEADLINE = [
    "b1_tokens", "b3_drop_subtrees", "b6_sections_by_heading", "b10_document_sentences", "c2_citation_spans", "c4_bracket_filter",
    "c9_placeholder_spans", "c10_reindex", "c17_containment", "d2_venue", "d11_dedup_authors", "d18_best_dates", "d19_section_paths",
    "d23_table_cells", "e5_unify_layouts", "e6_flatten_sentences", "e8_reading_order", "f5_replace_outputs", "f6_token_windows", "g3_upsert",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8)
    spark.range(1000).selectExpr("sum(id)").collect()
    times = {}
    for name in HEADLINE:
        start = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    line = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/"))[2:]}
    print(json.dumps(line))


if __name__ == "__main__":
    main()
