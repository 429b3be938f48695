"""Session helpers: a local session for tests and the shared checkpoint folder.

On a cluster the session is created by the platform; nothing here overrides
settings that are already present.  ``checkpoint_dir`` reads
``spark.checkpoint.dir`` from the session and only sets one when it is unset
(the local-test case).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings we want for every run.  ``setdefault`` semantics: a value already
# present in the cluster configuration wins.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Packages are large blobs: keep Arrow batches small so a batch of
    # archives fits in Python worker memory — at most 64 rows and at most
    # 256 MiB per batch, whichever comes first.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "64",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(256 * 1024 * 1024),
    # A thousand paths (the files of a stream's batch, the partitions of what it
    # published) are listed in this many tasks, not in one each.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    # Opening a small file costs as much as reading so many bytes: with Spark's
    # 4 MB a task would have four to 32 images, however small.
    "spark.sql.files.openCostInBytes": str(64 * 1024),
    # checkpoints go when the tables they hold are no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "figpairs") -> SparkSession:
    """Local session for tests and benchmarks (never used on a cluster)."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
    )
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Uses ``spark.checkpoint.dir`` when the cluster names one.  Only when it is
    unset on a local master (tests) a fresh folder under the system temp dir is
    made; on a cluster that is an error.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="figpairs-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for an intermediate table inside the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    return os.path.join(base.rstrip("/"), "tables", name) if "://" not in base else base.rstrip("/") + "/tables/" + name
