"""Benchmark the headline reports.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=4 python bench.py [query ...]

Each headline query runs on ``local[$BENCH_CPUS]``: one cold run, then
``$BENCH_REPEAT`` warm runs (median reported). Each run builds the plan from
the star tables and performs one action (``collect`` of the small report).
Also recorded per report: Spark jobs per run and shuffle exchanges in the
final adaptive plan (reused exchanges not counted), and, unless
``BENCH_COMPARE=0``, the same reports in the flat window + count(distinct)
form. ``pipeline_all_reports`` times the whole flow once: facts folded and
stored once, then all six reports from one plan (``pipeline_one_by_one``: a stored
copy of the facts, then one plan per report). ``BENCH_LOOP=1`` adds the original
per-cycle loop form of the by-cycle report (1 + 18 x cycles jobs; slow).
Prints ONE JSON line.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from donorlens.operators.parties import attribute_spec  # noqa: E402
from donorlens.plans.checks import plan_text  # noqa: E402
from donorlens.plans.queries import QUERIES, tables_for  # noqa: E402
from donorlens.session import build_session  # noqa: E402
from tools.alt_forms import flat_report, loop_report_by_cycle  # noqa: E402

HEADLINE = [
    "report_by_cycle",
    "report_by_cycle_by_party",
    "report_top_candidates",
    "report_top_committees",
    "report_by_sector",
    "report_by_sector_by_party",
    "report_by_sector_pivot",
    "report_by_cycle_as_coded",
    "report_by_cycle_by_party_as_coded",
]

COMPARE = {
    "flat_by_cycle": lambda spark, d: flat_report(tables_for(spark, d).contributions, ["cycle"]),
    "flat_by_cycle_by_party": lambda spark, d: flat_report(attribute_spec(tables_for(spark, d)),
                                                           ["cycle", "party"], keep="party IS NOT NULL"),
}


def _shuffles(df) -> int:
    text = plan_text(df, "simple")
    final = text.split("== Initial Plan ==")[0]
    return sum(1 for ln in final.splitlines()
               if "Exchange " in ln and "ReusedExchange" not in ln and "BroadcastExchange" not in ln
               and "ShuffleQueryStage" not in ln)


def _run(spark, fn, sf_dir, tag):
    sc = spark.sparkContext
    sc.setJobGroup(tag, tag)
    t0 = time.perf_counter()
    df = fn(spark, sf_dir)
    rows = df.collect()
    elapsed = time.perf_counter() - t0
    jobs = len(sc.statusTracker().getJobIdsForGroup(tag))
    return elapsed, len(rows), jobs, df


def _shuffle_bytes_by_group(evdir: str) -> dict[str, int]:
    """Shuffle bytes written per job group, from the Spark event log."""
    stage_group, out = {}, {}
    for path in glob.glob(os.path.join(evdir, "**", "events*"), recursive=True) + \
            glob.glob(os.path.join(evdir, "local-*")):
        if os.path.isdir(path):
            continue
        with open(path) as fh:
            for line in fh:
                e = json.loads(line)
                if e["Event"] == "SparkListenerJobStart":
                    group = (e.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in e.get("Stage IDs", []):
                        stage_group[sid] = group
                elif e["Event"] == "SparkListenerStageCompleted":
                    info = e["Stage Info"]
                    group = stage_group.get(info["Stage ID"])
                    for acc in info.get("Accumulables", []):
                        if acc.get("Name") == "internal.metrics.shuffle.write.bytesWritten" and group:
                            out[group] = out.get(group, 0) + int(acc.get("Value", 0))
    return out


def measure(spark, fn, sf_dir, name, repeat):
    cold, rows, jobs, df = _run(spark, fn, sf_dir, f"{name}-cold")
    warm = [_run(spark, fn, sf_dir, f"{name}-w{i}")[0] for i in range(repeat)]
    return {"cold": round(cold, 3), "warm": round(statistics.median(warm) if warm else cold, 3),
            "rows": rows, "jobs": jobs, "shuffles": _shuffles(df)}


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "4"))
    repeat = int(os.environ.get("BENCH_REPEAT", "5"))
    names = sys.argv[1:] or HEADLINE
    evdir = tempfile.mkdtemp(prefix="bench-evlog-", dir=os.environ.get("BENCH_TMP", "/tmp"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=2 * cpus,
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g"),
                                 "spark.eventLog.enabled": "true", "spark.eventLog.dir": evdir,
                                 "spark.eventLog.compress": "false"})
    # JVM start-up and first code generation are not part of any report's
    # first run: warm the session with one unrelated small job.
    from pyspark.sql import functions as F
    spark.range(100000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id")).collect()
    detail = {name: measure(spark, QUERIES[name], sf_dir, name, repeat) for name in names}
    compare = {}
    if os.environ.get("BENCH_COMPARE", "1") != "0":
        compare = {name: measure(spark, fn, sf_dir, name, min(repeat, 2)) for name, fn in COMPARE.items()}
    # The original program's flow: load once, then every report. Here: the facts are folded and
    # stored once (shared storage), and all six reports come from that copy in one plan.
    from donorlens.plans import reports as R, shared
    t0 = time.perf_counter()
    for report in shared.all_reports(shared.store(shared.fold(tables_for(spark, sf_dir)))).values():
        report.collect()
    pipeline = round(time.perf_counter() - t0, 3)
    # the same with one plan per report over a stored copy of the contributions
    t0 = time.perf_counter()
    stored = R.materialise(tables_for(spark, sf_dir))
    for _, report in R.generate_reports(stored):
        report.collect()
    one_by_one = round(time.perf_counter() - t0, 3)
    if os.environ.get("BENCH_LOOP") == "1":
        t0 = time.perf_counter()
        loop_report_by_cycle(tables_for(spark, sf_dir).contributions)
        compare["loop_by_cycle_as_coded"] = {"cold": round(time.perf_counter() - t0, 3)}
    spark.stop()
    shuffle_bytes = _shuffle_bytes_by_group(evdir)
    for group in (detail, compare):
        for name, d in group.items():
            if f"{name}-cold" in shuffle_bytes:
                d["shuffle_write_bytes"] = shuffle_bytes[f"{name}-cold"]
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_reports_total_warm_median",
        "value": round(sum(d["warm"] for d in detail.values()), 3),
        "unit": "sec",
        "queries": {k: d["warm"] for k, d in detail.items()},
        "detail": detail,
        "compare": compare,
        "pipeline_all_reports": pipeline,
        "pipeline_one_by_one": one_by_one,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
