"""Spark session helpers.

The engine never hard-codes cluster settings; ``build_session`` is for tests,
the bench and local use.  On a cluster the caller's session is used as is and
only ``checkpoint_dir`` reads ``spark.checkpoint.dir`` from it.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "talentlens") -> SparkSession:
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    spark = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_FALLBACK: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Without the setting, a local run (``local`` or ``local[n]``, where driver and
    executors are one process) gets a scratch folder of its own, once per
    application; any other master is an error.  The folder is registered with
    ``SparkContext.setCheckpointDir`` (the conf key itself is not modifiable at
    runtime).
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = _FALLBACK.get(sc.applicationId)
        if path is None:
            path = tempfile.mkdtemp(prefix="talentlens-ckpt-", dir="/tmp")
            _FALLBACK[sc.applicationId] = path
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss); never a local checkpoint."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt to every core if its input is too small for a full split each (one row group is one task, whatever it costs to read on).

    For steps whose work on a row is far dearer than moving it.  An input of more than a split for each core stays as it is.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    return df.repartition(cores) if int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) < cores * split else df


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
