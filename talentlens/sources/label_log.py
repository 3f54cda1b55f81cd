"""A log of labels that survives replays and broken runs.

Layout under the log's path::

    chunks/chunk=<name>/attempt=<id>/part-*.parquet     what one append wrote
    commits/<number>.json                               one line: the chunk, the attempt, its rows

An append writes its rows under an attempt of its own and then creates the next commit file.  Creating a file that
must not exist yet is atomic, so the numbers order all appends, also those of writers that run side by side.
Rows without a commit don't exist: an append that dies half-way leaves nothing behind but files that nobody
reads.  Of several labels of a candidate the one with the highest commit number holds, so a chunk that is
appended twice, or a task that runs twice, leaves one label for each candidate.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMMIT_SCHEMA = "number long, chunk string, attempt string, rows long"
_ROW_SCHEMA = "candidate_id string, llm_score int, llm_reasoning string, chunk string, attempt string"


class LabelLog:
    """Labels under one path of any Hadoop file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _file(self, name: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self) -> bool:
        p, fs = self._file("commits")
        return fs.exists(p)

    def commits(self) -> DataFrame:
        """Every commit: number, chunk, attempt, rows."""
        if not self.exists():
            return self.spark.createDataFrame([], COMMIT_SCHEMA)
        return self.spark.read.schema(COMMIT_SCHEMA).json(f"{self.path}/commits")

    def _commit(self, chunk: str, attempt: str, rows: int) -> int:
        number = (self.commits().agg(F.max("number")).first()[0] or 0) + 1
        while True:
            p, fs = self._file(f"commits/{number:015d}.json")
            try:
                out = fs.create(p, False)
            except Exception:  # noqa: BLE001  py4j wraps the file system's own errors
                if not fs.exists(p):
                    raise
                number += 1                                          # another writer was first
                continue
            try:
                out.write(bytearray(json.dumps({"number": number, "chunk": chunk, "attempt": attempt, "rows": rows}).encode() + b"\n"))
            finally:
                out.close()
            return number

    def write_attempt(self, labels: DataFrame, chunk: str) -> tuple[str, int]:
        """Write labels that no reader sees before they are committed: (attempt, rows)."""
        from ..operators.labeling import clean_reasoning
        from ..operators.metrics import RunMetrics
        attempt, seen = uuid.uuid4().hex, RunMetrics()
        clean = labels.select("candidate_id", F.col("llm_score").cast("int").alias("llm_score"),
                              clean_reasoning(F.coalesce("llm_reasoning", F.lit(""))).alias("llm_reasoning"))
        seen.watch(clean, "chunk").write.parquet(f"{self.path}/chunks/chunk={chunk}/attempt={attempt}")
        return attempt, seen.of("chunk")["rows"]

    def append(self, labels: DataFrame, chunk: str | None = None) -> int:
        """Write and commit labels under a chunk's name (a new one by default); returns the commit's number.

        The name may hold letters, digits, ``-`` and ``_``.
        """
        chunk = chunk or uuid.uuid4().hex
        if not chunk.replace("-", "").replace("_", "").isalnum():
            raise ValueError(f"not a chunk's name: {chunk!r}")
        attempt, rows = self.write_attempt(labels, chunk)
        return self._commit(chunk, attempt, rows)

    def labels(self) -> DataFrame:
        """(candidate_id, llm_score, llm_reasoning): the last committed label of each candidate."""
        commits = self.commits()
        try:
            rows = self.spark.read.schema(_ROW_SCHEMA).option("basePath", f"{self.path}/chunks").parquet(f"{self.path}/chunks")
        except AnalysisException:
            rows = self.spark.createDataFrame([], _ROW_SCHEMA)
        held = rows.join(commits.select("number", "chunk", "attempt"), ["chunk", "attempt"])
        last = held.groupBy("candidate_id").agg(F.max(F.struct("number", "llm_score", "llm_reasoning")).alias("l"))
        return last.select("candidate_id", "l.llm_score", "l.llm_reasoning")

    def compact(self) -> int:
        """Commit the held labels as one chunk and remove all that came before, dead attempts included; returns the number.

        For a time when nobody else appends.
        """
        p, fs = self._file("chunks")
        dead = [f"chunks/{s.getPath().getName()}" for s in fs.listStatus(p)] if fs.exists(p) else []
        number = self.append(self.labels(), f"compact-{uuid.uuid4().hex}")
        for s in fs.listStatus(self._file("commits")[0]):
            if s.getPath().getName() < f"{number:015d}.json":
                fs.delete(s.getPath(), False)
        for name in dead:
            fs.delete(self._file(name)[0], True)
        return number
