"""Session settings and the shared work folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

#: Tells the folders of this process from those of others.
RUN = uuid.uuid4().hex[:12]


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    memory: str = "4g",
    checkpoint_dir: str | None = None,
) -> SparkSession:
    """A session with the settings this package relies on.

    On a cluster, master, sizing and spark.checkpoint.dir come from spark-submit; only local runs pass them.
    """
    builder = (
        SparkSession.builder.appName("tallybook")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # The cache holds one micro-batch at a time and is read a few times: speed over size.
        .config("spark.sql.inMemoryColumnarStorage.compressed", "false")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
        builder = builder.config("spark.driver.memory", memory)
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder that spark.checkpoint.dir names; it goes when the application ends."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    root = f"{base.rstrip('/')}/tallybook/{spark.sparkContext.applicationId}-{RUN}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    # Only paths that exist are taken in.
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return f"{root}/{name}-{uuid.uuid4().hex}"
