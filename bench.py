"""Benchmark: run the registered queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (no collect), after
an untimed warm-up pass of every query over the sf0.01 tables. Prints one JSON line:
{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from searchlens.registry import QUERIES  # noqa: E402
from searchlens.session import local_session  # noqa: E402

# The jobs of the original system and the operators they are built from.
HEADLINE = (
    "hot_by_type", "hot_by_type_all_regions", "hot_total", "hot_lines", "hot_lines_split_types", "hot_payload",
    "video_rollup", "unique_searchers", "search_counts", "join_counts_titles",
    "assoc_top_videos", "assoc_top_videos_by_id", "preference_profile", "pref_payload",
    "heat_score", "heat_payload", "voice_scores", "editorial_sample", "editorial_payload",
    "kids_catalog_codes", "kids_play_rank", "title_search_code", "calendar", "log_dates",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in (os.environ.get("BENCH_QUERIES", "").split(",")) if n] or list(QUERIES)
    # BENCH_EVENTLOG_DIR: write Spark's event log there (stage and task times, without the UI).
    log_dir = os.environ.get("BENCH_EVENTLOG_DIR")
    extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir} if log_dir else None
    spark = local_session(cores=cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus)),
                          extra_conf=extra)

    plans: dict[str, dict[str, int]] = {}

    def run(name: str) -> float:
        spark.sparkContext.setJobGroup(name, name)
        t0 = time.perf_counter()
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        elapsed = time.perf_counter() - t0
        # Static plan shape (before AQE re-plans): shuffles and broadcasts.
        tree = df._jdf.queryExecution().executedPlan().toString()
        shuffle = r"(?<!Broadcast)Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)"
        plans[name] = {"shuffles": len(re.findall(shuffle, tree)),
                       "broadcasts": tree.count("BroadcastExchange")}
        return elapsed

    # Untimed warm-up: every query once on the smaller tables (other data, so
    # nothing is cached), so the timed runs measure steady-state execution
    # rather than class loading and JIT compilation of each code shape.
    warm_dir = os.environ.get("BENCH_WARMUP_SF_DIR", os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.01"))
    if not os.path.isdir(warm_dir) or os.path.abspath(warm_dir) == os.path.abspath(sf_dir):
        warm_dir = sf_dir
    for name in names:
        QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    timings = {n: round(run(n), 3) for n in names}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "headline_seconds": round(sum(timings[n] for n in HEADLINE if n in timings), 3),
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "warmup": f"each query once, untimed, on {warm_dir}",
        "plans": {n: plans[n] for n in names},
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
