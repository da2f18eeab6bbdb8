"""SparkSession construction with the settings every job in this package relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings the library's results depend on (see README "Pinned settings").
PINNED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "mercato", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the pinned settings.

    On a cluster ``master`` stays ``None`` so spark-submit decides; tests and the
    bench pass ``local[N]``.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in PINNED.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
