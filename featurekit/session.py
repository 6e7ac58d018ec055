"""Session helpers: a local session for tests/bench, and the checkpoint folder.

On a cluster the session is built by the caller; the library only reads
``spark.checkpoint.dir`` from it and sets a folder of its own when none is set.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "featurekit") -> SparkSession:
    """A local session configured like the tests and the bench expect."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder; create a scratch one only if none is configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        # Local runs and tests only: a cluster names a shared folder in spark.checkpoint.dir.
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="featurekit-ckpt-", dir=os.environ.get("TMPDIR", "/tmp")))
    else:
        raise RuntimeError("featurekit needs spark.checkpoint.dir set to a folder shared by the cluster "
                           "(fitted state and k-NN rounds are checkpointed there)")
    return sc.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder, cutting its lineage.

    Used for fitted state (encoding tables, KNN donors) that must survive executor loss
    and outlive the fitting job.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet in the shared checkpoint folder and read again, so that later passes
    read only the columns they need."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/frame-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
