"""Structured Streaming form of the 5-minute micro-batch consumer.

Two consumers are provided:

``start_batch_consumer``
    File-source stream over the manifests of landed batches. The producer
    (``land_batches``) writes each batch's items, payments, reviews and orders,
    partitioned by ``batch_id``, and last a manifest with their row counts; both
    replace what an earlier landing of the same batch left. A manifest is what
    the stream watches, so a batch without one is not seen. Inside
    ``foreachBatch`` the landed rows are counted against the manifest; the exact
    KPIs (distinct counts, anti joins) of the complete batches are written with a
    per-batch partition overwrite, then an incomplete batch stops the query
    before the trigger commits, so that a restart takes it up again and nothing
    is lost or counted twice. A finished batch's four parts are then moved to
    the archive, where a replay finds them. ``maxFilesPerTrigger`` bounds the
    batches, and so all driver work, of a trigger.

``start_window_kpis``
    Event-time stream over raw orders: 5-minute tumbling windows aligned to
    the same anchor as the batch formulation, a watermark for late rows,
    append mode (a window is emitted once, when the watermark passes it).
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..plans.microbatch import BATCH, batch_inventory_details, batch_summary
from ..sources.sinks import append_batch

CHILDREN = ("order_items", "order_payments", "order_reviews")
LAND_ORDER = CHILDREN + ("orders",)
MANIFEST = T.StructType([*(T.StructField(f"{t}_rows", T.LongType()) for t in LAND_ORDER), T.StructField("batch_id", T.LongType())])


class IncompleteBatch(ValueError):
    """Landed rows differ from a batch's manifest."""


def _replace_batches(df: DataFrame, path: str) -> None:
    df.hint("rebalance", "batch_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)


def land_batches(batches: Mapping[str, DataFrame], landing: str) -> None:
    """Producer: replace the given batches in ``landing/<table>/batch_id=<n>/``; their manifests come last.

    ``batches`` should be written tables (e.g. ``run_microbatch``'s ``batches/*``):
    each of the four writes would otherwise recompute the window assignment.
    Landing a batch again leaves it as if landed once.
    """
    landing = landing.rstrip("/")
    for name in LAND_ORDER:
        _replace_batches(batches[name], f"{landing}/{name}")
    counts = [batches[name].groupBy("batch_id").agg(F.count("*").alias("n")).withColumn("part", F.lit(name)) for name in LAND_ORDER]
    tagged = reduce(DataFrame.unionByName, counts)
    manifest = tagged.groupBy(F.col("batch_id").cast("long").alias("batch_id")).agg(*[
        F.coalesce(F.sum(F.when(F.col("part") == name, F.col("n"))), F.lit(0)).alias(f"{name}_rows") for name in LAND_ORDER])
    # a batch without orders is no batch: its children are released with their orders
    _replace_batches(manifest.where("orders_rows > 0"), f"{landing}/manifest")


def _batch_dirs(spark: SparkSession, base: str | None) -> set[int]:
    """Batches that have a folder under ``base``: one listing."""
    if base is None:
        return set()
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(path)] if fs.exists(path) else []
    return {int(n.split("=")[1]) for n in names if n.startswith("batch_id=")}


def _landed(spark: SparkSession, bases: list[str], schema: T.StructType, ids: set[int]) -> DataFrame:
    """Rows of the given batches only, each from the first of ``bases`` that has it."""
    frames, left = [], set(ids)
    for base in bases:
        here = left & _batch_dirs(spark, base)
        left -= here
        if here:
            frames.append(spark.read.schema(schema).option("basePath", base).parquet(
                *[f"{base}/batch_id={i}" for i in sorted(here)]).select(*schema.names))
    return reduce(DataFrame.unionByName, frames) if frames else spark.createDataFrame([], schema)


def _archive(spark: SparkSession, landing: str, archive: str, ids: set[int]) -> None:
    """Moves the four parts of finished batches; a part that is moved already stays where it is."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for name in LAND_ORDER:
        for i in sorted(ids & _batch_dirs(spark, f"{landing}/{name}")):
            old, new = (jvm.org.apache.hadoop.fs.Path(f"{root}/{name}/batch_id={i}") for root in (landing, archive))
            fs = old.getFileSystem(conf)
            fs.delete(new, True)  # of an earlier landing
            fs.mkdirs(new.getParent())
            if not fs.rename(old, new):
                raise OSError(f"cannot move {old} to {new}")


def start_batch_consumer(spark: SparkSession, landing: str, sink: str, checkpoint: str,
                         schemas: Mapping[str, T.StructType], inventory: DataFrame, customers: DataFrame,
                         products: DataFrame, sellers: DataFrame, *, available_now: bool = True,
                         processing_time: str | None = None, max_files_per_trigger: int = 64,
                         archive_dir: str | None = None) -> StreamingQuery:
    """Start the landed-batch consumer; KPIs go to ``sink/batch_summary`` and ``sink/batch_inventory_details``.

    ``schemas``: the four landed tables' schemas (each including ``batch_id``,
    ``window_start``, ``window_end``). ``inventory`` and the reference-key
    tables are static inputs: pass written tables, since every trigger reads them.
    ``max_files_per_trigger``: batches taken up at a time.
    """
    landing, sink = landing.rstrip("/"), sink.rstrip("/")
    archive = archive_dir.rstrip("/") if archive_dir else None
    reader = spark.readStream.schema(MANIFEST).option("maxFilesPerTrigger", max_files_per_trigger)
    if archive:  # the manifests themselves: Spark moves them once a later trigger has committed
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", f"{archive}/manifest")
    stream = reader.parquet(f"{landing}/manifest")

    def process(manifests: DataFrame, epoch_id: int) -> None:
        # a row for each batch of the trigger, at most max_files_per_trigger
        promised = {r["batch_id"]: tuple(r[f"{t}_rows"] for t in LAND_ORDER) for r in manifests.collect()}
        if not promised:
            return
        batches = {t: _landed(spark, [f"{root}/{t}" for root in (landing, archive) if root], schemas[t], set(promised))
                   for t in LAND_ORDER}
        found = {t: {r["batch_id"]: r["count"] for r in df.groupBy("batch_id").count().collect()} for t, df in batches.items()}
        complete = {i for i, n in promised.items() if n == tuple(found[t].get(i, 0) for t in LAND_ORDER)}
        if complete:
            whole = {t: df.where(F.col("batch_id").isin(sorted(complete))) for t, df in batches.items()}
            append_batch(batch_summary(whole, inventory, customers, products, sellers), f"{sink}/batch_summary")
            append_batch(batch_inventory_details(whole["order_items"], inventory), f"{sink}/batch_inventory_details")
            if archive:
                _archive(spark, landing, archive, complete)
        if len(complete) < len(promised):
            raise IncompleteBatch(f"landed rows differ from the manifest in batches {sorted(set(promised) - complete)}")

    w = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    if processing_time:
        w = w.trigger(processingTime=processing_time)
    elif available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def anchor_micros_of(orders: DataFrame, ts: str = "order_purchase_timestamp") -> int:
    """Epoch microseconds of the first purchase, as the session reads zone-less times (one scalar)."""
    return int(orders.agg(F.unix_micros(F.min(F.col(ts)).cast("timestamp"))).first()[0])


def window_start_offset(anchor_micros: int, minutes: int = 5) -> str:
    """``startTime`` argument that aligns Spark's epoch-based windows with an anchor instant."""
    return f"{anchor_micros % (minutes * 60 * 1_000_000)} microseconds"


def window_kpis(orders: DataFrame, anchor_micros: int, minutes: int = 5, watermark: str = "10 minutes",
                ts: str = "order_purchase_timestamp") -> DataFrame:
    """Watermarked tumbling-window KPIs of an orders stream (or a static frame, for comparison).

    Zone-less timestamps are read as UTC instants (the session zone is pinned
    to UTC), since watermarks need ``TIMESTAMP``. Customers are made distinct in
    a first grouping by window and customer, whose state is spread over all
    tasks; the second has one counter pair for each window.
    """
    width = f"{minutes} minutes"
    t = F.col(ts).cast("timestamp")
    by_customer = (orders.withColumn("__ts", t).withWatermark("__ts", watermark)
                   .groupBy(F.window("__ts", width, width, window_start_offset(anchor_micros, minutes)).alias("w"), "customer_id")
                   .agg(F.count("*").alias("n")))
    return by_customer.groupBy("w").agg(F.sum("n").alias("orders"), F.count("customer_id").alias("unique_customers")).select(
        F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("w.end").cast("timestamp_ntz").alias("window_end"), "orders", "unique_customers")


def start_window_kpis(spark: SparkSession, source: str, schema: T.StructType, sink: str, checkpoint: str,
                      anchor_micros: int, minutes: int = 5, watermark: str = "10 minutes",
                      max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Stream raw order files through ``window_kpis`` into Parquet (append mode)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    kpis = window_kpis(reader.parquet(source), anchor_micros, minutes, watermark)
    return (kpis.writeStream.outputMode("append").format("parquet").option("path", sink)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def landed_schemas(batches: Mapping[str, DataFrame]) -> dict[str, T.StructType]:
    """Schemas of the landed tables as the file source will see them."""
    out = {}
    for name, df in batches.items():
        assert all(c in df.columns for c in BATCH)
        out[name] = df.schema
    return out


def enrich_items_stream(items: DataFrame, inventory: DataFrame) -> DataFrame:
    """Stream-static left join: every streamed item row with its (product, seller) stock.

    NULL keys match NULL keys, as in the batch form; the static side is re-read
    per trigger, so it should be a written table.
    """
    inv = inventory.select(F.col("product_id").alias("__p"), F.col("seller_id").alias("__s"),
                           "stock_qty", "reorder_level", "stock_status")
    cond = F.col("product_id").eqNullSafe(F.col("__p")) & F.col("seller_id").eqNullSafe(F.col("__s"))
    return items.join(inv, cond, "left").drop("__p", "__s")


def orphan_rows_stream(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Stream-static anti join: streamed rows whose key has no parent; NULL keys are orphans."""
    return child.join(parent.select(F.col(key).alias("__k")), F.col(key) == F.col("__k"), "left_anti")


def release_items_stream(orders: DataFrame, items: DataFrame, anchor_micros: int, minutes: int = 5,
                         watermark: str = "10 minutes", max_delay: str = "10 minutes",
                         order_ts: str = "order_purchase_timestamp", item_ts: str = "item_ts") -> DataFrame:
    """Stream-stream release (I3): each item joined to its order, tagged with the order's window.

    Both sides carry event time and a watermark, and the join condition bounds
    the item's time to ``[order time, order time + max_delay]``, so Spark can
    drop join state once the watermark passes that bound (no unbounded state).
    """
    width = f"{minutes} minutes"
    o = (orders.withColumn("__ots", F.col(order_ts).cast("timestamp")).withWatermark("__ots", watermark)
         .withColumn("__w", F.window("__ots", width, width, window_start_offset(anchor_micros, minutes)))
         .select(F.col("order_id").alias("__oid"), "__ots",
                 F.col("__w.start").cast("timestamp_ntz").alias("window_start"),
                 F.col("__w.end").cast("timestamp_ntz").alias("window_end")))
    i = items.withColumn("__its", F.col(item_ts).cast("timestamp")).withWatermark("__its", watermark)
    cond = ((F.col("order_id") == F.col("__oid")) & (F.col("__its") >= F.col("__ots"))
            & (F.col("__its") <= F.col("__ots") + F.expr(f"INTERVAL {max_delay}")))
    return i.join(o, cond, "inner").select("window_start", "window_end", *items.columns)
