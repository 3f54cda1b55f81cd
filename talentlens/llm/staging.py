"""Tables in the folder that all executors share, and connected components over them."""

from __future__ import annotations

import gc
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir


def shared_path(spark: SparkSession, what: str) -> str:
    """A new path under ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def stage(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: later steps survive lost executors."""
    spark = df.sparkSession
    path = shared_path(spark, what)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, what: str, buckets: int, by: str, then: str) -> tuple[DataFrame, Callable[[], None]]:
    """``stage`` in buckets of the column ``by``: grouping or joining by it doesn't shuffle the table again.

    Each task writes its rows itself, nothing is shuffled.  The second item forgets the table's name
    in the session's catalog; call it when all that reads the table is done.  The files stay.
    """
    spark = df.sparkSession
    name, path = f"spark_catalog.default.{what}_{uuid.uuid4().hex}", shared_path(spark, what)
    buckets = min(buckets, int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")))
    df.write.bucketBy(buckets, by).sortBy(by, then).option("compression", "zstd").option("path", path).format("parquet").saveAsTable(name)
    return spark.table(name), lambda: spark.sql(f"DROP TABLE IF EXISTS {name}") and None


def small_batches(spark: SparkSession) -> None:
    """Batches between Spark and Python that suit whole texts, unless the session has its own setting.

    Spark's default of 10,000 rows makes batches of tens of megabytes out of documents, several of
    which each Python worker and the JVM hold at a time.
    """
    for key, default, value in (("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "1000"), ("spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "8388608b")):
        if spark.conf.get(key) == default:
            spark.conf.set(key, value)


def columns_to_keep(docs: DataFrame, keep: list[str] | None, new: list[str]) -> list[str]:
    """The columns of ``docs`` (or those named) that an operator hands on: a column that bears a new one's name gives way to it."""
    return [c for c in (docs.columns if keep is None else keep) if c.lower() not in new]


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of finished steps, whose results are staged.

    Spark drops them once the driver's garbage collection finds their plans unused; that takes two rounds.
    """
    for _ in range(3):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the undirected edges (a, b): root is the least node it can reach.

    Alternates large-star and small-star steps; each round's edges go to a shared table, so lineage
    stays short.  A node with very many edges is only aggregated with map-side combining and joined
    on its one minimum, which adaptive execution splits.
    """
    current = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = _mark(current)
    for _ in range(rounds):
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = stage(large, "edges")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        current = stage(small.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
        before, mark = mark, _mark(current)
        if mark == before:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
    raise RuntimeError(f"components didn't settle in {rounds} rounds")
