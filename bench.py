"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables' folder and ``BENCH_CPUS`` the local cores. Each query is
run once to warm up and then timed over whole results, written to the no-op sink.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from askmill.session import drop_work, session_builder
from catalog import QUERIES

HEADLINE = [
    "instruction_pairs",
    "user_answer_instructions",
    "consolidate_answers",
    "dedup_keep_first",
    "distinct_full_rows",
    "distinct_pair_count",
    "pending_two_sources",
    "unseen_single_key",
    "lookup_by_pair",
    "relate_replies",
    "relate_replies_split",
    "page_paragraphs",
    "page_hrefs",
    "answer_records",
    "link_extract",
    "topics_to_answers",
    "batches",
    "csv_roundtrip",
    "csv_by_name",
    "stream_ingest",
    "stream_answers",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES")
    spark = (
        session_builder("askmill-bench", shuffle_partitions=2 * int(cpus) if cpus.isdigit() else 16)
        .master(f"local[{cpus}]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="askmill-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        begin = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begin

    times = {}
    for name in wanted.split(",") if wanted else HEADLINE:
        run(name)
        times[name] = round(run(name), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    drop_work(spark)
    spark.stop()


if __name__ == "__main__":
    main()
