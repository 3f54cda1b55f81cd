"""Sharding by sampled splitters: shards of near equal bytes.

Rows are ordered by a hash of their text and, among equal texts, by a hash of the row.
A sample in which a row's chance grows with its size gives quantile boundaries; rows are
partitioned into ranges between them.  Exact sizes of the ranges follow from one
aggregation; ranges that came out overfull are sampled again, more densely, and
subdivided, also inside a group of equal texts.  The running size along all ranges, known
from the ranges' totals and a window inside each range, then places every row: shard s
takes the s-th equal part of all bytes.

A group of equal texts stays in one shard unless it is larger than ``TOLERANCE`` of a
shard; only then do its rows go wherever the running size puts them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .staging import columns_to_keep, shared_path, stage
from .text import tidy

SHARDS = 8
LEAST_RANGES, RANGE_BYTES, MOST_RANGES = 64, 512 << 20, 100_000
#: Sampled rows of a range.
SAMPLES = 64
#: A range is overfull beyond so many times its share.
OVERFULL = 2.0
TOLERANCE = 0.01
LAW = "bytes"


def _draw(meta: DataFrame, per_byte: float) -> pa.Table:
    """Keys and weights of rows drawn with a chance of ``per_byte`` for each of their bytes."""
    u = F.pmod(F.xxhash64("seq", "k", F.lit("draw")), F.lit(1 << 52)) / float(1 << 52)
    return meta.where(u < F.col("size") * per_byte).select("h", "k", F.greatest(F.col("size").cast("double"), F.lit(1 / per_byte)).alias("w")).toArrow()


def _boundaries(sample: pa.Table, pieces: int) -> list[tuple[int, int]]:
    """Keys that cut the sample into ``pieces`` of equal weight.

    A boundary goes to the start of its group of equal texts, unless the group spans several pieces.
    """
    h, k, w = (sample.column(c).to_numpy() for c in ("h", "k", "w"))
    if not len(h):
        return []
    order = np.lexsort((k, h))
    h, k, total = h[order], k[order], np.cumsum(w[order])
    at = np.unique(np.searchsorted(total, total[-1] * np.arange(1, pieces) / pieces))
    lowest, out = -(1 << 63), []
    for i in at[at < len(h)].tolist():
        key = int(h[i])
        out.append((key, int(k[i])) if out and out[-1][0] == key else (key, lowest))
    return out


def range_of(h: np.ndarray, k: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Number of boundaries at or before each key; ``bounds`` has sorted rows (h, k)."""
    out = np.searchsorted(bounds[:, 0], h, "right")
    tied = out > np.searchsorted(bounds[:, 0], h, "left")
    for value in np.unique(h[tied]).tolist():
        rows = np.flatnonzero(tied & (h == value))
        lo, hi = (np.searchsorted(bounds[:, 0], value, side) for side in ("left", "right"))
        out[rows] = lo + np.searchsorted(bounds[lo:hi, 1], k[rows], "right")
    return out


def _ranged(meta: DataFrame, bounds: list[tuple[int, int]]) -> DataFrame:
    shared = meta.sparkSession.sparkContext.broadcast(np.array(bounds, np.int64).reshape(-1, 2))       # MOST_RANGES at most, by OVERFULL

    def run(batches):
        for batch in batches:
            place = range_of(batch.column(1).to_numpy(), batch.column(2).to_numpy(), shared.value)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place, pa.int32())], names=[*batch.schema.names, "range"])

    return meta.select("seq", "h", "k", "size").mapInArrow(tidy(run), "seq long, h long, k long, size long, range int")


def assign(staged: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(seq, shard, slot) for every row of (seq, h, k, size)."""
    meta = staged.select("seq", "h", "k", "size")
    total, _ = meta.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    ranges = min(max(LEAST_RANGES, -(-total // RANGE_BYTES)), MOST_RANGES)
    target = max(total / ranges, 1.0)
    bounds = _boundaries(_draw(meta, SAMPLES / target), ranges)
    density = SAMPLES / target
    for _ in range(6):
        ranged = _ranged(meta, bounds)
        sizes = {r["range"]: (r["bytes"], r["rows"]) for r in ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")).toArrow().to_pylist()}
        full = sorted(r for r, (size, rows) in sizes.items() if size > OVERFULL * target and rows > 1)
        if not full:
            break
        density *= 8
        over = ranged.where(F.col("range").isin(full))
        sample = _draw(over, density)
        place = range_of(sample.column("h").to_numpy(), sample.column("k").to_numpy(), np.array(bounds, np.int64).reshape(-1, 2))
        more = set(bounds)
        for r in full:
            more |= set(_boundaries(sample.filter(pa.array(place == r)), int(np.ceil(sizes[r][0] / target))))
        if len(more) == len(bounds):
            break
        bounds = sorted(more)
    order = sorted(sizes)
    offsets = staged.sparkSession.createDataFrame(
        [(r, int(b), int(n)) for r, b, n in zip(order, np.cumsum([0, *(sizes[x][0] for x in order)])[:-1], np.cumsum([0, *(sizes[x][1] for x in order)])[:-1], strict=True)],
        "range int, bytes_before long, rows_before long")
    in_range = Window.partitionBy("range").orderBy("h", "k", "seq")
    group = Window.partitionBy("range", "h")
    placed = (ranged.withColumn("upto", F.sum("size").over(in_range.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("row", F.row_number().over(in_range))
              .withColumn("group_size", F.sum("size").over(group)).withColumn("group_upto", F.min(F.col("upto") - F.col("size")).over(group))
              .join(F.broadcast(offsets), "range"))                                            # MOST_RANGES rows at most, but for subdivisions
    snapped = F.col("group_size") <= F.lit(TOLERANCE * total / shards)
    at = F.col("bytes_before") + F.when(snapped, F.col("group_upto") + F.col("group_size") / 2).otherwise(F.col("upto") - F.col("size") / 2)      # its middle
    placed = placed.select("seq", F.least(F.lit(shards - 1), F.floor(at * shards / F.lit(float(max(total, 1))))).cast("int").alias("shard"),
                           (F.col("rows_before") + F.col("row") - 1).alias("nth"))
    placed = stage(placed, "places")
    first = placed.groupBy("shard").agg(F.min("nth").alias("first"))
    return placed.join(F.broadcast(first), "shard").select("seq", "shard", (F.col("nth") - F.col("first")).alias("slot"))      # a row for each shard


def shard(docs: DataFrame, text: str = "text", shards: int = SHARDS) -> DataFrame:
    """The rows of ``docs`` with ``size``, ``text_crc32``, ``shard`` and ``slot`` (from 0 in each shard, without gaps).

    A row's size is its text's UTF-8 bytes and one more; a null text counts as empty.  Rows that
    repeat, and rows without an id, each have a slot of their own.  Columns of ``docs`` that bear one of
    the new names give way to it.  An empty table gives an empty table.
    """
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    kept = columns_to_keep(docs, None, ["size", "text_crc32", "shard", "slot"])
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)], (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"),
                       F.monotonically_increasing_id().alias("seq"), F.xxhash64(body).alias("h"))
    staged = stage(rows, "rows").withColumn("k", F.xxhash64("seq", F.lit("row")))
    places = assign(staged, shards)
    return staged.join(places, "seq").select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)], "size", "text_crc32", "shard", "slot")


def write(docs: DataFrame, path: str, text: str = "text", shards: int = SHARDS) -> None:
    """Write the rows of ``docs`` as Parquet, one folder ``shard=s`` for each shard, in the order of their slots within a file."""
    shard(docs, text, shards).sortWithinPartitions("shard", "slot").write.partitionBy("shard").option("compression", "zstd").parquet(path)


def digests(docs: DataFrame) -> DataFrame:
    """Write the shards to the shared folder and tell what they hold."""
    path = shared_path(docs.sparkSession, "shards")
    write(docs, path)
    schema = "doc_id long, size long, text_crc32 long, slot long, shard int"
    return docs.sparkSession.read.schema(schema).parquet(path).select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
