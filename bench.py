"""Times the headline queries and prints one JSON line."""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from contract import load
from trendmill.session import build_session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "unified_signals", "bronze_papers_xml", "term_frequency", "trending_signals",
    "source_summary", "tech_velocity", "quality_log", "merge_upsert", "as_of_version",
    "enrich_apply", "enrich_candidates", "stream_upsert",
    "q01_trending", "q02_accelerating", "q03_source_activity", "q04_daily_volume",
    "q05_top_terms", "q06_overlap", "q07_emerging", "q08_sentiment", "q09_authors", "q10_quality",
]


def main(names):
    spark = build_session(
        "bench", f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, _ = load()
    queries["table_row_counts"](spark, FOLDER).collect()
    seconds = {}
    for name in names or HEADLINE:
        start = time.time()
        queries[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall clock",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": FOLDER.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
