"""Benchmark: the whole warehouse run, the micro-batch KPIs and the read layer.

Runs at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]``
and prints one JSON line. ``value`` is the warehouse run (staging -> dims ->
facts -> quality gate -> summaries, every stage written to Parquet), the
counterpart of the reference's end-to-end run time.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from mercato.plans import reads as R  # noqa: E402
from mercato.plans.pipeline import read_warehouse, run_microbatch, run_pipeline  # noqa: E402
from mercato.session import get_session  # noqa: E402
from mercato.sources.fixtures import Fixtures  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    out = tempfile.mkdtemp(prefix="mercato-bench-", dir=os.environ.get("BENCH_OUT", "/tmp"))
    t0 = time.perf_counter()
    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")}
    if os.environ.get("BENCH_EVENT_LOG") == "1":  # stage/task times, written to this run's scratch folder
        os.makedirs(f"{out}/eventlog", exist_ok=True)
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{out}/eventlog"})
    spark = get_session(f"local[{cpus}]", shuffle_partitions=cpus, extra=extra)
    # JVM warm-up (class loading, first code generation) is not part of the run
    spark.read.parquet(f"{sf_dir}/region.parquet").count()
    spark.sql("SELECT 1").collect()
    session_s = time.perf_counter() - t0
    fx = Fixtures(spark, sf_dir, partitions=dict.fromkeys(("lineitem", "orders", "events"), cpus))  # files of one row group

    t = time.perf_counter()
    log = run_pipeline(spark, fx, f"{out}/warehouse", parallel=int(os.environ.get("BENCH_PARALLEL_JOBS", "4")),
                       land_raw=os.environ.get("BENCH_LAND_RAW", "1") == "1")
    pipeline_s = time.perf_counter() - t
    steps = {k[5:]: v for k, v in log.seconds.items() if k.startswith("wall.")}

    queries: dict[str, float] = {f"step.{k}": round(v, 3) for k, v in steps.items()}
    queries.update({k: v for k, v in log.seconds.items() if not k.startswith("wall.")})

    # micro-batch KPIs over every 5-minute window of the events table
    t = time.perf_counter()
    mlog = run_microbatch(spark, fx, f"{out}/microbatch")
    microbatch_s = time.perf_counter() - t
    queries.update({f"microbatch.{k}": v for k, v in mlog.seconds.items()})

    # read layer on the written warehouse
    wh = read_warehouse(spark, f"{out}/warehouse")
    reads = {
        "list_sales": lambda: R.list_sales(wh["fact_order_items"]),
        "list_products": lambda: R.list_products(wh["dim_products"]),
        "monthly_sales": lambda: R.monthly_sales(wh["agg_sales_monthly"]),
        "top_products": lambda: R.top_products(wh["agg_inventory"]),
        "daily_sales": lambda: R.daily_sales(wh["agg_sales_daily"]),
        "top_sellers": lambda: R.top_sellers(wh["fact_order_items"], wh["dim_sellers"]),
        "sales_by_state": lambda: R.sales_by_state(wh["fact_order_items"], wh["dim_customers"]),
        "payments_breakdown": lambda: R.payments_breakdown(wh["agg_payment_methods"]),
        "installment_distribution": lambda: R.installment_distribution(wh["fact_order_payments"]),
        "monthly_reviews": lambda: R.monthly_reviews(wh["agg_reviews_monthly"]),
        "score_distribution": lambda: R.score_distribution(wh["fact_order_reviews"]),
        "recent_comments": lambda: R.recent_comments(wh["fact_order_reviews"]),
    }
    t_reads = time.perf_counter()
    for name, fn in reads.items():
        t = time.perf_counter()
        fn().collect()
        queries[f"read.{name}"] = round(time.perf_counter() - t, 3)
    reads_s = time.perf_counter() - t_reads

    result = {
        "metric": "warehouse_run_seconds",
        "value": round(pipeline_s, 3),
        "unit": "sec",
        "queries": queries,
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "rows": log.rows,
        "read_layer_seconds": round(reads_s, 3),
        "microbatch_seconds": round(microbatch_s, 3),
        "session_start_seconds": round(session_s, 3),
        "cpus": cpus,
        "out": out,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
