import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from mercato.plans import microbatch as M
from mercato.plans.build import MicroBatchBuild
from mercato.streaming.microbatch_stream import (
    land_batches, landed_schemas, start_batch_consumer, start_window_kpis, window_kpis,
)


def _static(spark, df, path):
    """Static stream inputs are tables, not plans recomputed on every trigger."""
    df.write.parquet(path)
    return spark.read.parquet(path)


def _consumer(spark, refs, mb, d, **kw):
    schemas = landed_schemas(mb.batches)
    return start_batch_consumer(spark, f"{d}/landing", f"{d}/sink", f"{d}/ckpt", schemas, refs["inventory"],
                                refs["customers"], refs["products"], refs["sellers"], **kw)


def test_stream_equals_batch_with_restart_and_replay(spark, fx, tmp_path):
    d = str(tmp_path)
    mb = MicroBatchBuild(fx)
    b = {k: _static(spark, v, f"{d}/released/{k}") for k, v in mb.batches.items()}  # the producer's output
    mb.__dict__["batches"] = b
    refs = {"inventory": _static(spark, mb.inventory, f"{d}/static/inventory"),
            "customers": _static(spark, fx["ref_customers"], f"{d}/static/customers"),
            "products": _static(spark, fx["ref_products"], f"{d}/static/products"),
            "sellers": _static(spark, fx["ref_sellers"], f"{d}/static/sellers")}
    land_batches({k: v.filter("batch_id <= 30") for k, v in b.items()}, f"{d}/landing")
    _consumer(spark, refs, mb, d, max_files_per_trigger=16).awaitTermination()
    first = spark.read.parquet(f"{d}/sink/batch_summary")
    assert first.count() == 30
    # restart on the same checkpoint: nothing new, nothing reprocessed
    q = _consumer(spark, refs, mb, d)
    q.awaitTermination()
    assert all(p["numInputRows"] == 0 for p in q.recentProgress)
    # more batches land; then a fresh checkpoint replays everything: partitions overwritten, not duplicated
    land_batches({k: v.filter("batch_id > 30 AND batch_id <= 60") for k, v in b.items()}, f"{d}/landing")
    _consumer(spark, refs, mb, d).awaitTermination()
    d2 = str(tmp_path / "replay")
    start_batch_consumer(spark, f"{d}/landing", f"{d}/sink", d2, landed_schemas(b), refs["inventory"],
                         refs["customers"], refs["products"], refs["sellers"]).awaitTermination()
    streamed = spark.read.parquet(f"{d}/sink/batch_summary")
    batch = mb.batch_summary.filter("batch_id <= 60")  # KPIs of a batch depend on that batch's rows only
    assert streamed.count() == batch.count() == 60
    assert streamed.select(*batch.columns).exceptAll(batch).count() == 0


def test_window_kpis_stream_matches_batch_and_drops_late_rows(spark, fx, tmp_path):
    orders = fx["stream_orders"]
    anchor = orders.agg(F.min("order_purchase_timestamp")).collect()[0][0]
    anchor_us = int((anchor - dt.datetime(1970, 1, 1)).total_seconds() * 1_000_000)
    src = str(tmp_path / "src")
    # the stream must arrive in event-time order: four time-ordered files, written one after the other
    ordered = orders.withColumn("__q", F.ntile(4).over(Window.orderBy("order_purchase_timestamp")))  # small fixture
    for q_ in range(1, 5):
        ordered.filter(F.col("__q") == q_).drop("__q").coalesce(1).write.mode("append").parquet(src)
    q = start_window_kpis(spark, src, orders.schema, str(tmp_path / "out"), str(tmp_path / "ck"), anchor_us,
                          max_files_per_trigger=1)
    q.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    expected = M.window_counts(M.assign_windows(orders))
    # append mode emits a window once the watermark (max event time - 10 min) has passed its end
    n_emitted = got.count()
    assert n_emitted > 0
    mism = got.join(expected.withColumnRenamed("orders", "b"), ["window_start", "window_end"]).filter("orders <> b")
    assert mism.count() == 0
    assert got.join(expected, ["window_start", "window_end"], "left_anti").count() == 0
    # a row later than the watermark is dropped when it arrives in a later micro-batch
    late = orders.limit(1).withColumn("order_purchase_timestamp", F.lit(anchor).cast("timestamp_ntz"))
    late.write.mode("append").parquet(src)
    q = start_window_kpis(spark, src, orders.schema, str(tmp_path / "out"), str(tmp_path / "ck"), anchor_us)
    q.awaitTermination()
    again = spark.read.parquet(str(tmp_path / "out"))
    first_window = again.filter(F.col("window_start") == F.lit(anchor).cast("timestamp_ntz")).collect()
    assert len(first_window) == 1 and first_window[0]["orders"] == 1


def test_static_window_kpis_equal_batch_counts(spark, fx):
    orders = fx["stream_orders"]
    anchor = orders.agg(F.min("order_purchase_timestamp")).collect()[0][0]
    anchor_us = int((anchor - dt.datetime(1970, 1, 1)).total_seconds() * 1_000_000)
    k = window_kpis(orders, anchor_us).select("window_start", "orders")
    b = M.window_counts(M.assign_windows(orders)).select("window_start", "orders")
    assert k.exceptAll(b).count() == 0 and b.exceptAll(k).count() == 0


def test_stream_static_enrichment_and_orphans(spark, fx, tmp_path):
    from mercato.streaming.microbatch_stream import enrich_items_stream, orphan_rows_stream
    items, orders = fx["stream_order_items"], fx["stream_orders"]
    inv = _static(spark, M.inventory_snapshot(items), str(tmp_path / "inv"))
    refs = _static(spark, fx["ref_customers"], str(tmp_path / "cust"))
    items.write.parquet(str(tmp_path / "items"))
    orders.write.parquet(str(tmp_path / "orders"))
    s_items = spark.readStream.schema(items.schema).parquet(str(tmp_path / "items"))
    s_orders = spark.readStream.schema(orders.schema).parquet(str(tmp_path / "orders"))
    q1 = enrich_items_stream(s_items, inv).writeStream.format("memory").queryName("enriched_t").start()
    q2 = orphan_rows_stream(s_orders, refs, "customer_id").writeStream.format("memory").queryName("orphans_t").start()
    for q in (q1, q2):
        q.processAllAvailable()
        q.stop()
    enriched = spark.table("enriched_t")
    expected = M.items_with_inventory(items, inv)
    assert enriched.exceptAll(expected).count() == 0 and expected.exceptAll(enriched).count() == 0
    from mercato.operators.relational import orphans
    assert spark.table("orphans_t").count() == orphans(orders, refs, "customer_id").count()


def _small(spark, fx, d, n):
    mb = MicroBatchBuild(fx)
    b = {k: _static(spark, v.filter(f"batch_id <= {n}"), f"{d}/released/{k}") for k, v in mb.batches.items()}
    refs = {"inventory": _static(spark, mb.inventory, f"{d}/inv"), "customers": fx["ref_customers"],
            "products": fx["ref_products"], "sellers": fx["ref_sellers"]}
    mb.__dict__["batches"] = b
    return mb, b, refs


def test_consumed_batches_are_archived_whole(spark, fx, tmp_path):
    d = str(tmp_path)
    mb, b, refs = _small(spark, fx, d, 6)
    # each batch lies in several files; a trigger takes one batch
    land_batches({k: v.repartition(3).filter("batch_id <= 3") for k, v in b.items()}, f"{d}/landing")
    _consumer(spark, refs, mb, d, max_files_per_trigger=1, archive_dir=f"{d}/processed").awaitTermination()
    for table in ("orders", "order_items", "order_payments", "order_reviews"):
        ids = {r[0] for r in b[table].filter("batch_id <= 3").select("batch_id").distinct().collect()}
        assert {int(p.name.split("=")[1]) for p in (tmp_path / "processed" / table).glob("batch_id=*")} == ids
        assert not list((tmp_path / "landing" / table).glob("batch_id=*"))
    land_batches({k: v.filter("batch_id > 3") for k, v in b.items()}, f"{d}/landing")
    _consumer(spark, refs, mb, d, archive_dir=f"{d}/processed").awaitTermination()
    got, want = spark.read.parquet(f"{d}/sink/batch_summary"), mb.batch_summary
    assert got.count() == 6 and got.select(*want.columns).exceptAll(want).count() == 0
    # a replay from a fresh checkpoint finds the parts in the archive
    land_batches({k: v.filter("batch_id = 1") for k, v in b.items()}, f"{d}/again")
    start_batch_consumer(spark, f"{d}/again", f"{d}/sink2", f"{d}/ckpt2", landed_schemas(b), refs["inventory"], refs["customers"],
                         refs["products"], refs["sellers"], archive_dir=f"{d}/processed").awaitTermination()
    assert spark.read.parquet(f"{d}/sink2/batch_summary").count() == 1


def test_landing_twice_is_landing_once(spark, fx, tmp_path):
    d = str(tmp_path)
    mb, b, refs = _small(spark, fx, d, 3)
    for _ in range(2):
        land_batches(b, f"{d}/landing")
    _consumer(spark, refs, mb, d).awaitTermination()
    got, want = spark.read.parquet(f"{d}/sink/batch_summary"), mb.batch_summary
    assert got.count() == 3 and got.select(*want.columns).exceptAll(want).count() == 0


def test_incomplete_batch_is_left_alone(spark, fx, tmp_path):
    import shutil

    import pytest
    d = str(tmp_path)
    mb, b, refs = _small(spark, fx, d, 3)
    land_batches(b, f"{d}/landing")
    some = b["order_items"].agg(F.max("batch_id")).first()[0]
    part = tmp_path / "landing" / "order_items" / f"batch_id={some}"
    shutil.copytree(part, tmp_path / "kept")
    for f in part.glob("*"):
        f.unlink()
    with pytest.raises(Exception, match="differ from the manifest"):
        _consumer(spark, refs, mb, d).awaitTermination()
    assert spark.read.parquet(f"{d}/sink/batch_summary").filter(F.col("batch_id") == some).count() == 0
    shutil.copytree(tmp_path / "kept", part, dirs_exist_ok=True)
    _consumer(spark, refs, mb, d).awaitTermination()  # the same trigger again
    got, want = spark.read.parquet(f"{d}/sink/batch_summary"), mb.batch_summary
    assert got.count() == 3 and got.select(*want.columns).exceptAll(want).count() == 0
    # children without their orders and manifest are not taken up
    b["order_items"].write.mode("append").partitionBy("batch_id").parquet(f"{d}/other/order_items")
    assert not (tmp_path / "other" / "manifest").exists()


def test_stream_stream_release_matches_batch(spark, fx, tmp_path):
    from mercato.streaming.microbatch_stream import release_items_stream
    orders = fx["stream_orders"]
    events = fx.table("events").select(F.col("event_id").alias("order_id"), F.col("ts").alias("item_ts"))
    items = fx["stream_order_items"].join(events, "order_id")  # items carry their event time
    anchor = orders.agg(F.min("order_purchase_timestamp")).collect()[0][0]
    anchor_us = int((anchor - dt.datetime(1970, 1, 1)).total_seconds() * 1_000_000)
    for name, df in (("o", orders), ("i", items)):
        ordered = df.withColumn("__q", F.ntile(3).over(Window.orderBy(df.columns[-1] if name == "i"
                                                                     else "order_purchase_timestamp")))
        for q_ in range(1, 4):
            ordered.filter(F.col("__q") == q_).drop("__q").coalesce(1).write.mode("append").parquet(str(tmp_path / name))
    so = spark.readStream.schema(orders.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "o"))
    si = spark.readStream.schema(items.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "i"))
    q = (release_items_stream(so, si, anchor_us).writeStream.format("memory").queryName("released_t")
         .outputMode("append").start())
    q.processAllAvailable()
    q.stop()
    got = spark.table("released_t").select("window_start", "order_id", "price")
    expected = M.release_batches(orders, fx["stream_order_items"], fx["stream_order_payments"],
                                 fx["stream_order_reviews"])["order_items"].select("window_start", "order_id", "price")
    assert got.count() == expected.count() > 0
    assert got.exceptAll(expected).count() == 0
