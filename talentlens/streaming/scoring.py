"""Structured Streaming over candidate files.

Everything up to the final score is row-local, so the same plan runs on
``readStream``: new JSONL files are parsed with the explicit schema,
flattened, featurised and scored per micro-batch.  Two sinks:

* ``stream_scores`` — append every scored row (id, scores) to Parquet;
* ``stream_topk`` — a running top-k kept with ``foreachBatch``: each batch's
  own top-k (TakeOrdered) is merged with the previous top-k snapshot, so the
  state is k rows regardless of stream volume.  Snapshots are written per
  batch id, so a replayed batch overwrites its own snapshot (idempotent), and
  only the last few are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import DEFAULT, RankConfig
from ..operators.flatten import flatten
from ..plans.pipeline import score_candidates
from ..sources.files import classify_lines

SCORE_COLUMNS = ("candidate_id", "suspicion_score", "is_honeypot", "behavioral_score", "model_score", "final_score")


def _lines(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None) -> DataFrame:
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(source_dir)


def scored_stream(spark: SparkSession, source_dir: str, cfg: RankConfig = DEFAULT,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Lines → same blank-skip / quarantine rules as the batch loader → scores."""
    good, _ = classify_lines(_lines(spark, source_dir, max_files_per_trigger), cfg.signals_key)
    return score_candidates(flatten(good, cfg.signals_key), cfg).select(*SCORE_COLUMNS)


def quarantine_stream(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint: str,
                      cfg: RankConfig = DEFAULT) -> StreamingQuery:
    """Malformed / non-object lines of the stream, appended to Parquet."""
    _, bad = classify_lines(_lines(spark, source_dir, None), cfg.signals_key)
    return (bad.writeStream.format("parquet").option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(availableNow=True).start(sink_dir))


def stream_scores(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint: str,
                  cfg: RankConfig = DEFAULT, available_now: bool = True) -> StreamingQuery:
    q = (scored_stream(spark, source_dir, cfg).writeStream.format("parquet")
         .option("checkpointLocation", checkpoint).outputMode("append"))
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="10 seconds")
    return q.start(sink_dir)


def _latest_snapshot(spark: SparkSession, out_dir: str, before: int | None = None) -> DataFrame | None:
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(out_dir)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root) or not any(s.getPath().getName().startswith("batch_id=") for s in fs.listStatus(root)):
        return None                                        # no snapshot yet; a damaged one is an error
    snaps = spark.read.parquet(out_dir)
    if before is not None:
        snaps = snaps.where(F.col("batch_id") < before)
    last = snaps.agg(F.max("batch_id")).collect()[0][0]
    return None if last is None else snaps.where(F.col("batch_id") == last).drop("batch_id")


def _prune_snapshots(spark: SparkSession, out_dir: str, keep_from: int) -> None:
    """Drop snapshot folders ``batch_id < keep_from`` (Hadoop FS, any scheme)."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(out_dir)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("batch_id=") and int(name.split("=", 1)[1]) < keep_from:
            fs.delete(st.getPath(), True)


def stream_topk(spark: SparkSession, source_dir: str, out_dir: str, checkpoint: str, k: int = 100,
                cfg: RankConfig = DEFAULT, max_files_per_trigger: int | None = 1, keep: int = 3) -> StreamingQuery:
    """Running top-k; the last ``keep`` (≥ 2) snapshots are retained so a replayed batch finds its predecessor."""
    keep = max(keep, 2)

    def merge(batch: DataFrame, batch_id: int) -> None:
        cand = batch.select("candidate_id", "final_score")
        prev = _latest_snapshot(batch.sparkSession, out_dir, before=batch_id)   # replay-safe
        if prev is not None:
            cand = cand.unionByName(prev.select("candidate_id", "final_score"))
        top = (cand.orderBy(F.desc_nulls_last("final_score"), F.asc("candidate_id")).limit(k)
                   .withColumn("batch_id", F.lit(batch_id)))
        top.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(out_dir)
        _prune_snapshots(batch.sparkSession, out_dir, batch_id - keep + 1)

    return (scored_stream(spark, source_dir, cfg, max_files_per_trigger).writeStream
            .foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def read_topk(spark: SparkSession, out_dir: str) -> DataFrame:
    snap = _latest_snapshot(spark, out_dir)
    if snap is None:
        return spark.createDataFrame([], "candidate_id string, final_score double")
    return snap
