"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Rows one task may sort for one key before the key is split (see operators.hotkeys). Two bounds
# follow for N input rows: at most N / ROWS_PER_TASK keys can be hot, and their split points
# number at most twice that, so the broadcast of both stays in the megabytes even for 10^12 rows.
ROWS_PER_TASK = 4_000_000


def build_session(app: str = "basketry", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are designed for.

    Adaptive execution supplies run-time broadcast decisions, coalescing and skew-join splitting.
    The RocksDB provider keeps deduplication state off the JVM heap.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def beside(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    """A session with the settings of ``spark`` and these."""
    session = spark.newSession()
    for key, value in (spark.conf.getAll | settings).items():
        if spark.conf.isModifiable(key):
            session.conf.set(key, value)
    return session


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only in local mode may that setting be absent; a temporary folder is then made and recorded in
    the session for later calls. On a cluster a folder of one machine would not do.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("basketry.scratch.dir", None)
    if not root:
        if not re.match(r"local(\[.*\])?$", spark.conf.get("spark.master", "none")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="basketry-")
        spark.conf.set("basketry.scratch.dir", root)
    return os.path.join(root, f"{label}-{uuid.uuid4().hex}")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage where several branches would otherwise recompute an expensive input. The files
    outlive lost executors, and unlike a cached frame they keep column pruning and pushdown.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
