"""Run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "video_stats", "fresh_video_stats", "speaker_stats", "dataset_overview", "training_funnel", "duration_quantiles", "duration_bands",
    "wer_histogram", "conf_levels", "speaker_balance", "tier_by_region", "vocabulary", "vocab_fallback", "top_mined", "explorer_page",
    "interval_max_overlap", "region_semijoin", "silence_islands", "session_windows", "av_consensus", "cosine_links", "cosine_top1",
    "wer_turns", "latest_wins", "coverage", "star_join", "pricing_summary", "as_of",
]


def main() -> None:
    from tallyloom.queries import QUERIES
    from tallyloom.session import local_session

    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="bench")
    spark.sparkContext.setLogLevel("ERROR")
    small = Path(sf_dir).parent / "sf0.001"
    for name in HEADLINE if small.is_dir() else HEADLINE[:1]:  # compiled and loaded once before the clock starts
        QUERIES[name](spark, str(small) if small.is_dir() else sf_dir).write.format("noop").mode("overwrite").save()
    took = {}
    for name in HEADLINE:
        began = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - began, 3)
    spark.stop()
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": Path(sf_dir).name.removeprefix("sf")}))


if __name__ == "__main__":
    main()
