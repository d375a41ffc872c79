"""Benchmark the headline queries; prints ONE JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_QUERIES (comma list to override the headline set).

Each query is built and then executed to completion into Spark's ``noop``
sink, so the time covers the whole plan (and any materialised
intermediates) without shipping rows to Python.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "career_summary",
    "dedupe_prefer_flagged",
    "latest_per_key",
    "patch_join",
    "outer_block_assembly",
    "panel_build",
    "cohort_frame",
    "describe",
    "box_stats",
    "histogram",
    "corr_matrix",
    "audit_duplicates",
    "summary_counters",
    "impute_scale",
    "regression_metrics",
    "ridge_cv",
    "pca_fit",
    "page_links",
    "text_fields",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE

    from panelwright.plans.catalogue import QUERIES
    from panelwright.session import drop_scratch, get_session

    spark = get_session(app="panelwright-bench", master=f"local[{cpus}]", shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", max(8, cpus * 2))))
    # Warm the JVM (class loading, codegen caches) on the smallest data; untimed.
    QUERIES["career_summary"](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name in names:
        t0 = time.perf_counter()
        try:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
        except Exception as exc:  # noqa: BLE001 - one failing query must not lose the others' timings
            errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"

    sf = sf_dir.rsplit("sf", 1)[-1] if "sf" in sf_dir else sf_dir
    out = {
        "metric": "total_query_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    drop_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
