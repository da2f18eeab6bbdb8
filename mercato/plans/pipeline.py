"""Whole batch run: load raw -> staging -> dimensions -> facts -> quality gate -> summaries.

Each stage is *written* (Parquet under ``root``) and the next stage reads
what was written. That cuts the lineage at every stage boundary: a lost
executor recomputes at most one stage from files in the shared store, and
the summaries, which reuse each fact several times, scan compact Parquet
instead of re-running the cleaning and joins. The quality gate runs after
the facts and before any summary, from the control totals that the writes
themselves took (``sources.ledger``); a failure raises and leaves the previous
summaries untouched. ``publish_pipeline`` runs all of it in a folder of its own
and shows readers the whole result at once, after all gates.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from ..operators.quality import QualityError, assert_keys
from ..sources.ledger import Ledger, Totals
from ..sources.publishing import Run, Version, prune, resolve
from ..sources.sinks import write_counted
from .build import WarehouseBuild

# Within a layer the tables are listed largest first: concurrent jobs are submitted in this
# order, so the long writes start immediately and the small ones fill the gaps.
RAW_TABLES = ["order_items_raw", "order_reviews_raw", "orders_raw", "order_payments_raw", "customers_raw",
              "geolocation_raw", "products_raw", "sellers_raw", "product_category_name_translation_raw"]
STAGING = ["order_items", "reviews_typed", "orders", "payments", "customers", "products", "geolocation",
           "sellers", "translation"]
DIMENSIONS = ["dim_customers", "dim_sellers", "dim_products", "dim_date"]
FACTS = ["fact_order_items", "fact_order_reviews", "fact_order_payments"]
SUMMARIES = ["agg_sales_daily", "agg_sales_monthly", "agg_inventory", "agg_payment_methods", "agg_reviews_monthly"]
# Output files are sorted inside by the date key: tight Parquet min/max stats for date filters.
SORT_WITHIN = {f: ["order_purchase_date_key"] for f in FACTS}


# Control totals of the tables that a ledger follows, and the staged table that each fact is made of.
TOTALS = {"order_items": Totals(["price", "freight_value"]), "payments": Totals(["payment_value"]),
          "fact_order_items": Totals(["price", "freight_value"], ["order_id", "product_id"], ["price"]),
          "fact_order_payments": Totals(["payment_value"], ["order_id"])}
MADE_OF = {"fact_order_items": "order_items", "fact_order_payments": "payments"}
FILLED = ["fact_order_items", "dim_customers", "dim_products", "dim_date"]


def assert_ledger(ledger: Ledger) -> None:
    """The gate before the summaries, from the ledger alone: totals balance, tables have rows, no NULL keys or negative prices."""
    ledger.balance(MADE_OF)
    failed = [f"FAILED: {check} = {value}" for check, value, passed in ledger.checks(FILLED) if not passed]
    if failed:
        raise QualityError("Quality checks failed:\n" + "\n".join(failed))


class StageLog:
    def __init__(self):
        self.ledger = Ledger()
        self.seconds: dict[str, float] = {}
        self.rows: dict[str, int] = {}

    def run(self, name: str, fn: Callable[[], int | None]) -> None:
        t = time.perf_counter()
        n = fn()
        self.seconds[name] = round(time.perf_counter() - t, 3)
        if n is not None:
            self.rows[name] = n

    def run_all(self, tasks: Mapping[str, Callable[[], int | None]], parallel: int, layer: str | None = None) -> None:
        """Run independent writes as concurrent Spark jobs (one driver thread each).

        Tables of one layer do not depend on each other; submitting their jobs
        together keeps every core busy while a small table's job is in its
        single-task stages. Errors propagate after all submitted jobs end.
        """
        t = time.perf_counter()
        if parallel <= 1:
            for name, fn in tasks.items():
                self.run(name, fn)
        else:
            with ThreadPoolExecutor(max_workers=parallel) as pool:
                futures = [pool.submit(self.run, name, fn) for name, fn in tasks.items()]
                for f in futures:
                    f.result()
        if layer:
            self.seconds[f"wall.{layer}"] = round(self.seconds.get(f"wall.{layer}", 0) + time.perf_counter() - t, 3)


def run_pipeline(spark: SparkSession, raw: Mapping[str, DataFrame], root: str, *,
                 build_kw: dict | None = None, gate: bool = True, parallel: int = 4,
                 land_raw: bool = True) -> StageLog:
    """Run every stage, writing to ``root/<layer>/<table>``; returns timings and row counts.

    ``parallel``: how many independent table writes of one layer run as
    concurrent Spark jobs (1 = strictly one after the other).
    ``land_raw``: write the raw text tables first (step 1 of the run) and
    clean from that copy; with False the cleaners read the sources directly.
    """
    log = StageLog()
    root = root.rstrip("/")

    def stage(names, layer, frames, sort=None, step=None):
        def put(n):
            rows, rules, finish = (w.flow(n) if layer == "dw" else None) or (frames(n), None, lambda df: df)
            return log.ledger.write(rows, f"{root}/{layer}/{n}", n, TOTALS.get(n, Totals()), rules, finish,
                                    sort_within=(sort or {}).get(n))
        log.run_all({f"{layer}.{n}": (lambda n=n: put(n)) for n in names}, parallel, step)
        return {n: spark.read.parquet(f"{root}/{layer}/{n}") for n in names}

    # 1. load: raw text tables as delivered, written once (the cleaners read these)
    loaded = stage(RAW_TABLES, "raw", lambda n: raw[n], step="load") if land_raw else raw
    src = WarehouseBuild(loaded, **(build_kw or {}))
    # 2. staging: cleaned, typed, deduplicated
    staged = stage(STAGING, "staging", lambda n: getattr(src, n), step="staging")
    # 3. the warehouse reads the written staging tables
    w = WarehouseBuild(loaded, **(build_kw or {}))
    w.__dict__.update(staged)
    # 4. dimensions and facts (both read only staging)
    written = stage(FACTS + DIMENSIONS, "dw", lambda n: getattr(w, n), SORT_WITHIN, step="dimensions_facts")
    w.__dict__.update(written)
    # 5. quality gate before any summary is replaced
    if gate:
        log.run("wall.quality_gate", lambda: assert_ledger(log.ledger))
    # 6. summaries (monthly rolls up the written daily table)
    w.__dict__.update(stage([n for n in SUMMARIES if n != "agg_sales_monthly"], "dw", lambda n: getattr(w, n),
                            step="aggregates"))
    stage(["agg_sales_monthly"], "dw", lambda n: getattr(w, n), step="aggregates")
    log.ledger.frame(spark).coalesce(1).write.mode("overwrite").parquet(f"{root}/ledger")  # a few rows a table
    return log


def key_gate(orphans: str = "fail") -> Callable[[Mapping[str, DataFrame]], Mapping]:
    """Primary and foreign keys of a warehouse's dimensions and facts; ``orphans="report"`` only notes unknown foreign keys."""
    return lambda tables: assert_keys({n: tables[n] for n in DIMENSIONS + FACTS}, orphans)


def publish_pipeline(spark: SparkSession, raw: Mapping[str, DataFrame], root: str, *, keep: int = 3,
                     orphans: str = "fail", **kw) -> tuple[Version, StageLog]:
    """``run_pipeline`` in a new version's folder, published after every gate has passed.

    Readers (``read_warehouse``) stay on the version before until then; a run that
    fails, or dies at any point, changes nothing for them. The ``keep`` newest
    versions remain readable. Facts whose foreign keys miss their dimension stop
    the run, or are noted in the version with ``orphans="report"``.
    """
    run = Run(spark, root)
    log = run_pipeline(spark, raw, run.folder, **kw)
    for name in DIMENSIONS + FACTS + SUMMARIES:
        path = f"{run.folder}/dw/{name}"
        run.adopt(name, [path], spark.read.parquet(path).schema)
    timed: dict[str, Version] = {}
    log.run("wall.publish", lambda: timed.update(version=run.publish(key_gate(orphans), {"rows": log.rows})))
    prune(spark, root, keep)
    return timed["version"], log


def read_warehouse(spark: SparkSession, root: str, number: int | None = None) -> dict[str, DataFrame]:
    """The written dimension, fact and summary tables, for the read layer: of a published version (the current one by
    default), or of a root that ``run_pipeline`` wrote in place."""
    root = root.rstrip("/")
    version = resolve(spark, root, number)
    if version is not None:
        return {n: version.read(spark, n) for n in DIMENSIONS + FACTS + SUMMARIES}
    return {n: spark.read.parquet(f"{root}/dw/{n}") for n in DIMENSIONS + FACTS + SUMMARIES}


MICROBATCH_RELEASE = ["orders", "order_items", "order_payments", "order_reviews"]


def run_microbatch(spark: SparkSession, raw: Mapping[str, DataFrame], root: str, minutes: int = 5,
                   anchor=None, parallel: int = 4) -> StageLog:
    """Micro-batch formulation end to end: inventory, released batches, KPIs, roll-ups.

    The released batches are written once (the hand-over the producer makes
    through the landing folder) and every KPI reads them, so the window
    assignment and numbering run once instead of once per consumer.
    Independent tables of a step are written as concurrent jobs.
    """
    from .build import MicroBatchBuild
    from .microbatch import batch_orders, release_children

    log = StageLog()
    root = root.rstrip("/")
    mb = MicroBatchBuild(raw, minutes, anchor)

    def put(frames: Mapping[str, Callable[[], DataFrame]], step: str, **kw) -> dict[str, DataFrame]:
        log.run_all({name: (lambda name=name: write_counted(frames[name](), f"{root}/{name}", **kw))
                     for name in frames}, parallel, step)
        return {name: spark.read.parquet(f"{root}/{name}") for name in frames}

    first = put({"inventory": lambda: mb.inventory,
                 "batches/orders": lambda: batch_orders(mb.orders, minutes=minutes, anchor=mb.anchor)}, "release")
    mb.__dict__["inventory"] = first["inventory"]
    orders_b = first["batches/orders"]
    children = release_children(orders_b, {"order_items": mb.items, "order_payments": raw["stream_order_payments"],
                                            "order_reviews": raw["stream_order_reviews"]})
    kids = put({f"batches/{k}": (lambda v=v: v) for k, v in children.items()}, "release", sort_within=["batch_id"])
    mb.__dict__["batches"] = {"orders": orders_b, **{k.split("/")[1]: v for k, v in kids.items()}}
    kpis = put({"batch_summary": lambda: mb.batch_summary,
                "batch_inventory_details": lambda: mb.batch_inventory_details}, "kpis")
    mb.__dict__.update(kpis)
    mb.__dict__["daily_summary"] = put({"daily_summary": lambda: mb.daily_summary}, "rollups")["daily_summary"]
    put({"monthly_summary": lambda: mb.monthly_summary, "run_summary": lambda: mb.run_summary}, "rollups")
    return log
