"""Spark session helpers.

On a cluster the session is built by the platform; ``ensure_checkpoint_dir``
only fills ``spark.checkpoint.dir`` when it is unset (local runs and tests),
so jobs always cut lineage into the shared folder the cluster names.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # keep Arrow batches small: one batch holds whole html pages
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "regesto") -> SparkSession:
    """Session for tests and the local bench (never used on a cluster)."""
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.driver.memory", os.environ.get("REGESTO_DRIVER_MEMORY", "8g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder: the context's, else ``spark.checkpoint.dir``; only a local master may
    do without one and gets a scratch folder, because on a cluster every executor would write to
    its own disk."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        master = spark.sparkContext.master
        if not re.match(r"local(\[|$)", master):
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        conf = tempfile.mkdtemp(prefix="regesto-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf)
    spark.sparkContext.setCheckpointDir(conf)
    return conf
