"""Exact order statistics without a single-partition sort.

``sorted[i]`` for chosen 0-based positions ``i`` (per group) is found with a
distributed prefix sum over the *frequency table* of the column:

1. ``groupBy(group, value).count()`` — map-side combined, so a hot value
   costs one row per map task;
2. range-partition the distinct (group, value) pairs and checkpoint them
   reliably so the layout is fixed; total each (partition, group);
3. a prefix sum of the totals by group gives each partition's offset, a window
   *within* each partition adds the running count; the value whose cumulative
   range covers position ``i`` is ``sorted[i]``.

No task ever holds more than its range of distinct values, or one group's totals
(a row for each partition).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

def grouped_describe(long: DataFrame, group_col: str = "g", value_col: str = "v",
                     partitions: int | None = None) -> DataFrame:
    """Per group: n, min, max, mean, sample std (0 for n = 1), interpolated median and
    p25/p75/p90 = ``sorted[int(n·p)]``.  Output ``(g, stat, value)``; nulls ignored.
    """
    spark = long.sparkSession
    data = long.select(F.col(group_col).cast("string").alias("g"), F.col(value_col).cast("double").alias("v")) \
               .where(F.col("v").isNotNull())
    basics = data.groupBy("g").agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("min"), F.max("v").alias("max"),
        F.avg("v").alias("mean"), F.coalesce(F.stddev_samp("v"), F.lit(0.0)).alias("std"))
    freq = data.groupBy("g", "v").agg(F.count(F.lit(1)).alias("c"))
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid = cut_lineage(freq.repartitionByRange(parts, "g", "v").withColumn("pid", F.spark_partition_id()))
    totals = laid.groupBy("g", "pid").agg(F.sum("c").alias("t"))          # partitions × groups rows
    before = Window.partitionBy("g").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("g", "pid", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("offset"))
    w = Window.partitionBy("pid", "g").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = laid.withColumn("run", F.sum("c").over(w)).join(offsets, ["g", "pid"])
    cum = running.withColumn("hi", F.col("offset") + F.col("run")).withColumn("lo", F.col("hi") - F.col("c"))
    n = F.col("n")
    wanted = basics.select("g", F.explode(F.array(
        F.struct(F.lit("p25").alias("stat"), F.floor(n * 0.25).cast("long").alias("pos")),
        F.struct(F.lit("p75").alias("stat"), F.floor(n * 0.75).cast("long").alias("pos")),
        F.struct(F.lit("p90").alias("stat"), F.floor(n * 0.90).cast("long").alias("pos")),
        F.struct(F.lit("_m1").alias("stat"), F.floor((n - 1) / 2).cast("long").alias("pos")),
        F.struct(F.lit("_m2").alias("stat"), F.floor(n / 2).cast("long").alias("pos")),
    )).alias("w")).select(F.col("g").alias("wg"), "w.stat", "w.pos")
    picked = cum.join(wanted, (F.col("g") == F.col("wg")) & (F.col("pos") >= F.col("lo"))
                      & (F.col("pos") < F.col("hi"))).select("g", "stat", F.col("v").alias("value"))
    median = picked.where(F.col("stat").startswith("_")).groupBy("g").agg(
        (F.sum("value") / F.count(F.lit(1))).alias("value")).select("g", F.lit("median").alias("stat"), "value")
    pcts = picked.where(~F.col("stat").startswith("_"))
    head = basics.select("g", F.explode(F.array(*[
        F.struct(F.lit(s).alias("stat"), F.col(s).cast("double").alias("value"))
        for s in ("n", "min", "max", "mean", "std")])).alias("s")).select("g", "s.stat", "s.value")
    return head.unionByName(median).unionByName(pcts)
