"""Benchmark the headline queries.

Runs at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints one JSON line:
``{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}``.

Each query is run to completion through the ``noop`` sink (no collect to
Python).  Every query runs ``$BENCH_REPEAT`` times (default 2); ``queries``
has the best time, ``cold`` the first one (it also pays for class loading and
JIT compilation of its code paths) and ``warm`` the last.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.plans import catalog  # noqa: E402
from tessera.session import local_session  # noqa: E402

HEADLINE = [
    "num_summary",
    "num_residue_sums",
    "num_min_abs_dev",
    "txt_word_count",
    "txt_word_count_line_folded",
    "txt_word_count_salted",
    "txt_top_words",
    "txt_word_frequency",
    "sel_kcenter",
    "sel_kmeanspp",
    "sel_coreset_kmeans",
    "sel_kcenter_blocks",
    "sel_diversify_score",
    "vec_nearest_center",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cpus, shuffle_partitions=max(8, int(cpus) if cpus.isdigit() else 8))
    qs = catalog.queries()
    run(qs["num_summary"](spark, sf_dir))  # warm-up
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "2")))
    times: dict[str, float] = {}
    cold: dict[str, float] = {}
    warm: dict[str, float] = {}
    for name in HEADLINE:
        taken = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            run(qs[name](spark, sf_dir))
            taken.append(round(time.perf_counter() - t0, 3))
        times[name], cold[name], warm[name] = min(taken), taken[0], taken[-1]
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "cold": cold,
        "warm": warm,
        "sf": float(m.group(1)) if m else sf_dir,
    }
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
