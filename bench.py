"""Time the headline queries and print one JSON line.

Each query runs once untimed on the smallest scale, so that no time is spent on class loading and
code generation, and then once to the end (all columns of all rows) on ``$BENCH_SF_DIR``.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import QUERIES
from rostrum.session import session

HEADLINE = (
    "scrub_texts", "transliterate", "char_positions", "url_resolve", "fix_types", "date_parse",
    "nickname_lookup", "house_first_name", "house_first_name_shuffled", "state_map", "new_politicians",
    "new_politicians_shuffled", "senate_roster_xml", "senate_votes_xml", "house_votes_xml",
    "house_votes_amended", "house_roster_html", "house_roll_index_html", "bill_details_html",
    "cosponsors_html", "page_links", "landed_bills", "votes_clean", "votes_errors", "bills_clean",
    "cosponsors_clean", "house_clean", "house_new", "senate_clean", "stream_votes_clean",
)


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(
        "bench", f"local[{cpus}]", spark_sql_shuffle_partitions=cpus, spark_driver_memory="8g",
        spark_ui_enabled="false", spark_ui_showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    warm = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        if os.path.isdir(warm):
            run(spark, name, warm)
        seconds[name] = round(run(spark, name, sf_dir), 3)
    print(json.dumps({
        "metric": "total wall time of the headline queries", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir)[2:], "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
