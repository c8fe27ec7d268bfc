"""Benchmark: the full cycle at one scale, then the five reference queries.

Runs at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints one JSON line. Stage timings cover bronze
ingestion (documents written), silver (quality, de-duplication, corridor
KPIs, zones; silver and quarantine written, report observed on the same
pass), gold (dimensions, keys, conformed fact written) and the two physical
layouts. Query timings are the median of 5 runs after a warm-up pass over
all queries and one warm-up run per query, executed into the ``noop`` sink,
on the optimised layout (control layout alongside).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from viaduct.plans import layout  # noqa: E402
from viaduct.plans.registry import reference_queries  # noqa: E402
from viaduct.plans.warehouse import Warehouse  # noqa: E402
from viaduct.session import build_session  # noqa: E402

RUNS = 5


def timed(fn):
    t0 = time.perf_counter()
    out = fn()
    return out, time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(
        f"local[{cpus}]",
        app_name="viaduct-bench",
        shuffle_partitions=cpus,
        extra_conf={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")},
    )
    spark.sparkContext.setLogLevel("ERROR")
    w = Warehouse(spark, sf_dir)
    stages = {}

    docs, stages["bronze_ingest"] = timed(lambda: w.documents)
    n_docs = docs.count()

    def silver():
        s = w.silver
        report = w.write_quarantine()
        return s, report

    (silver_df, report), stages["silver_pipeline"] = timed(silver)
    gold, stages["gold_build"] = timed(lambda: w.gold)
    n_fact = gold.fact_servicio.count()
    _, stages["layouts"] = timed(lambda: (w.layouts, w.dimension_tables))

    qs = reference_queries(w, w.dimension_tables)
    # one unmeasured pass over every query and layout warms the JVM (JIT) for
    # the query path as a whole; each query then gets its own warm-up run
    for build in qs.values():
        for fact in w.layouts.values():
            build(fact).write.format("noop").mode("overwrite").save()
    times = {}
    for name, build in qs.items():
        for lay, fact in w.layouts.items():
            df = build(fact)
            df.write.format("noop").mode("overwrite").save()
            runs = []
            for _ in range(RUNS):
                t0 = time.perf_counter()
                build(fact).write.format("noop").mode("overwrite").save()
                runs.append(time.perf_counter() - t0)
            times[(name, lay)] = statistics.median(runs)

    queries = {k: round(v, 3) for k, v in stages.items()}
    for (name, lay), sec in times.items():
        key = name.lower() if lay == layout.OPTIMISED else f"{name.lower()}_control"
        queries[key] = round(sec, 3)
    q_total = sum(times[(n, layout.OPTIMISED)] for n in qs)
    total = sum(stages.values()) + q_total
    out = {
        "metric": "full_cycle_plus_queries_sec",
        "value": round(total, 3),
        "unit": "sec",
        "queries": queries,
        "sf": float(sf_dir.rstrip("/").rsplit("/sf", 1)[-1]),
        "rows_input": n_docs,
        "rows_fact": n_fact,
        "silver_rows_per_sec": round(n_docs / stages["silver_pipeline"], 1),
        "bronze_rows_per_sec": round(n_docs / stages["bronze_ingest"], 1),
        "gold_fact_rows_per_sec": round(n_fact / stages["gold_build"], 1),
        "layout_ratio_control_over_optimised": {
            n.lower(): round(times[(n, layout.CONTROL)] / times[(n, layout.OPTIMISED)], 2) for n in qs
        },
        "rejected_by_rule": {k: v for k, v in report.items() if k.startswith("R")},
        "cpus": cpus,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
