"""Time the headline queries on one machine and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from kinloom.catalogue import QUERIES, load_all  # noqa: E402
from kinloom.session import build_session  # noqa: E402

HEADLINE = [
    "id_people",
    "gr01_components",
    "id03_component_election",
    "id04_email_election",
    "id05_email_only",
    "id07_resolve_batch",
    "ex01_exact_match",
    "sm02_similar_topk",
    "er01_entities",
    "en01_enrich_by_email",
    "en02_enrich_by_hash",
    "dt00_clean_dates",
    "dt06_to_utc",
    "dd01_dedupe_latest",
    "dd02_first_per_key",
    "jn01_star_left",
    "jn03_latest_dimension",
    "jn06_two_key_join",
    "src03_fixed_width",
    "snk08_bounded_files",
    "up01_upsert_some_columns",
    "up07_regenerate_ids",
    "up08_duplicate_emails",
    "lg02_retry_summary",
    "lg03_minute_bins",
    "lg06_alarm_states",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    load_all()
    names = sys.argv[1:] or HEADLINE
    if names == ["all"]:
        names = list(QUERIES)
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "20g",
            "spark.driver.host": "127.0.0.1",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="kinloom-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["ag01_count_by_source"](spark, folder).collect()  # start-up is not a query
    seconds: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total seconds over headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
