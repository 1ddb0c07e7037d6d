"""Time the headline queries, or those named as arguments, and print one JSON line.

The derived inputs are landed before the clock starts; each query is then run
to completion (every column computed, the rows thrown away). The better of two
runs counts, so that class loading is not measured.
"""

from __future__ import annotations

import json
import os
import sys
import time

from bibspark.session import build_session
from checks import feed
from checks.queries import QUERIES

INPUTS = [
    feed.prepared_rows, feed.works, feed.responses, feed.authorship_cells, feed.grant_cells, feed.count_cells,
    feed.enriched_rows, feed.search_pages,
]
HEADLINE = [
    "scan_csv", "search_feed_records", "next_link", "format_doi", "coerce_table", "flatten_work",
    "parse_json_cell", "norm_raw_search", "norm_publications", "norm_authorships", "norm_authors",
    "norm_authorship_institutions", "norm_institutions", "norm_authorship_countries", "norm_funding",
    "norm_funders", "norm_citation_counts", "dedupe_keep_first", "dedupe_keep_last",
    "resume_anti_join", "enrich_left_join", "enrich_status", "exclude_existing", "upsert_update",
    "load_tables", "sink_fanout", "split_part_ids", "search_slice", "page_slice", "top_n_per_type",
    "incremental_refresh", "stream_incremental", "key_quality_counts",
]
RUNS = 2


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        f"local[{cpus}]", "bench", spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false", spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
        # tables this small would otherwise be one task each
        spark__sql__files__maxPartitionBytes="4m", spark__sql__adaptive__advisoryPartitionSizeInBytes="2m",
    )
    spark.sparkContext.setLogLevel("ERROR")
    started = time.time()
    for land in INPUTS:
        land(spark, sf)
    landing = round(time.time() - started, 3)
    times = {}
    for name in names:
        best = float("inf")
        for _ in range(RUNS):
            start = time.time()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            best = min(best, time.time() - start)
        times[name] = round(best, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf.rstrip("/")), "landing_sec": landing,
        "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
