"""Benchmark: the ETL to the stored mart, then the dashboard questions.

Prints one JSON line. Each step runs once cold (first run in the JVM: it pays
code generation and JIT warm-up) and then warm; ``value`` is the warm total,
the cold times are reported alongside.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from windshear.plans import etl, queries  # noqa: E402
from windshear.plans.catalog import CATALOG  # noqa: E402
from windshear.session import local_session, scratch_dir  # noqa: E402
from windshear.sources import fixtures as fx  # noqa: E402
from windshear.sources.mart import read_mart, write_mart  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
LO, HI = "2024-01-01 00:00", "2034-01-01 00:00"
FIRST, LAST = "2024-01-01", "2033-12-31"


def _sf(path: str) -> float | str:
    m = re.search(r"sf([0-9.]+)", path)
    return float(m.group(1)) if m else path


def _timed(fn):
    t = time.perf_counter()
    fn()
    return time.perf_counter() - t


def main() -> None:
    spark = local_session(cores=CPUS, shuffle_partitions=CPUS, app="windshear-bench",
                          **{"spark.ui.showConsoleProgress": "false"})
    cfg = fx.FIXTURE_CONFIG
    raw = lambda: fx.raw_inputs(spark, SF_DIR)
    base = scratch_dir(spark).rstrip("/") + f"/bench-{uuid.uuid4().hex}"

    steps = {}
    runs = {"n": 0}

    def etl_write():
        runs["n"] += 1
        write_mart(etl.build_mart(*raw(), cfg), f"{base}/mart{runs['n']}")

    steps["etl_mart_write"] = etl_write
    mart_path = lambda: f"{base}/mart{runs['n']}"

    def over_mart(fn):
        return lambda: fn(read_mart(spark, mart_path())).collect()

    qs = {
        "q1_wind_rose_dep": lambda m: queries.wind_rose(m, "departure", LO, HI),
        "q1_wind_rose_arr": lambda m: queries.wind_rose(m, "arrival", LO, HI),
        "q2_delay_dep": lambda m: queries.airport_delay_count(m, "departure", LO, HI),
        "q2_delay_arr": lambda m: queries.airport_delay_count(m, "arrival", LO, HI),
        "q3_crosswind_dep": lambda m: queries.crosswind_interruptions(m, "departure", LO, HI),
        "q3_crosswind_arr": lambda m: queries.crosswind_interruptions(m, "arrival", LO, HI),
        "q4_delay_map": lambda m: queries.delay_map(m, cfg.hub, "departure", FIRST, LAST),
        "q5_bars": lambda m: queries.interruption_bars(m, "arrival", FIRST, LAST),
        "q6_wind_rose_days": lambda m: queries.wind_rose_days(m, "arrival", FIRST, LAST),
    }
    for name, fn in qs.items():
        steps[f"{name}_mart"] = over_mart(fn)

    # The same questions as registered in the catalogue: computed straight from
    # the tables through the weighted plan (no stored mart).
    direct = {}
    for name in ("wind_rose_departure", "wind_rose_arrival", "airport_delay_departure", "airport_delay_arrival",
                 "crosswind_departure", "crosswind_arrival", "delay_map", "interruption_bars", "wind_rose_days"):
        direct[f"{name}_from_tables"] = (lambda n: lambda: CATALOG[n](spark, SF_DIR).collect())(name)

    cold = {k: round(_timed(f), 3) for k, f in steps.items()}
    warm = {k: round(_timed(f), 3) for k, f in steps.items()}
    direct_cold = {k: round(_timed(f), 3) for k, f in direct.items()}
    direct_warm = {k: round(_timed(f), 3) for k, f in direct.items()}
    out = {
        "metric": "etl_plus_mart_questions_warm_total",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": {**warm, **direct_warm},
        "cold": {**cold, **direct_cold},
        "etl_plus_mart_questions_cold_total": round(sum(cold.values()), 3),
        "from_tables_warm_total": round(sum(direct_warm.values()), 3),
        "from_tables_cold_total": round(sum(direct_cold.values()), 3),
        "sf": _sf(SF_DIR),
        "cpus": CPUS,
        "config": {"shuffle_partitions": CPUS, "aqe": True, "weather_dedupe": cfg.weather_dedupe,
                   "hub": cfg.hub},
    }
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
