"""Time the load and the headline queries; prints one JSON line.

The warehouse is loaded once from ``$BENCH_SF_DIR``; each query is then timed on the loaded
tables, the best of three runs counting, as the reference numbers are from warm runs.
"""

from __future__ import annotations

import hashlib
import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from claimloom.registry import QUERIES, loaded  # noqa: E402
from claimloom.session import build_session  # noqa: E402

HEADLINE = [
    "q1_top_providers_yoy", "q2_diagnosis_category_spend", "q3_member_utilization", "q4_denial_rate",
    "q5_oon_cost_comparison", "q6_monthly_volume", "q6b_processed_volume", "q7_member_cohort",
    "q8_provider_ytd_threshold", "m3_volume_from_summary", "dq8_quality_report", "b5_source_balance",
    "d5_scd2_events", "l1_resolve_claims", "l6_insert_fact_claim_line",
]
RUNS = 3


def calibration(spark) -> dict[str, float]:
    """Seconds of two fixed pieces of work that no code of this library is in, to set machines and rounds beside each other."""
    found = {"sha256_256_mb": [], "sum_of_hashes_100_m": []}
    for _ in range(RUNS):
        started = time.perf_counter()
        hashlib.sha256(bytes(256 << 20)).digest()
        found["sha256_256_mb"].append(time.perf_counter() - started)
        started = time.perf_counter()
        spark.range(100_000_000).selectExpr("sum(xxhash64(id) % 1000) as s").collect()
        found["sum_of_hashes_100_m"].append(time.perf_counter() - started)
    return {name: round(min(runs), 4) for name, runs in found.items()}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.showConsoleProgress": "false", "spark.log.level": "ERROR",
            # a few megabytes per table: keep them in enough pieces for all cores
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
        },
    )
    fixed = calibration(spark)
    started = time.perf_counter()
    loaded(spark, folder)
    load_seconds = time.perf_counter() - started
    seconds = {}
    for name in HEADLINE:
        runs = []
        for _ in range(RUNS):
            started = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - started)
        seconds[name] = round(min(runs), 4)
    total = round(sum(seconds.values()), 4)
    seconds = {"load_all_tables": round(load_seconds, 4), **seconds}
    scale = Path(folder).name.removeprefix("sf")
    print(json.dumps({
        "metric": "sum of query seconds on the loaded warehouse", "value": total, "unit": "sec",
        "load": round(load_seconds, 4), "calibration": fixed, "queries": seconds, "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
