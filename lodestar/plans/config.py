"""Session settings for local runs (tests, bench). Clusters use spark-submit."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", app: str = "lodestar") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # A folder of this machine only serves local masters, and only where the session has none.
    sc = spark.sparkContext
    if sc.master.startswith("local[") and not sc.getCheckpointDir() and not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lodestar-ckpt-"))
    return spark
