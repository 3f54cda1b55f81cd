"""Centroid clustering of integer vectors through a VA-file.

Every dimension is cut into 64 cells; a vector's approximation is its six-bit cell number in each
dimension.  For one set of centroids a lookup table holds, for every dimension and cell, the least and
the greatest part of the squared distance to each centroid.  Adding up a vector's entries gives an
interval for each of its distances; only centroids whose interval starts at or below the least upper
end can be nearest.  Where just one is left, the approximation has decided; where intervals overlap the
full vector is fetched and the exact distances to those centroids are compared (equal distances: the
centroid with the smaller number).

Cells are equally wide between the least and greatest component of a bounded sample (``SAMPLE``
vectors); that bears on how many intervals overlap, never on the result, because the ends of each cell
are the least and greatest values that all vectors have in it.

A centroid's update needs the sum of its full vectors, so approximation and vector lie side by side
in one staged table and a round is one scan of it without a shuffle of vectors: a task adds up its
vectors by cluster, and k rows of sums a task are grouped.  Only k x dims numbers and the ends of the
cells reach the driver.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import columns_to_keep, stage
from .text import tidy

DIMS = 64
CENTROIDS = 40
ROUNDS = 5
SCALE = 256
SEED = 2
#: Cells of a dimension: six bits.  On the test vectors (64 components, 40 centroids) 4 to 12 intervals overlap
#: on average; with 16 cells nearly all 40 do, with 128 cells two.
CELLS = 64
#: Vectors whose range is cut into cells.
SAMPLE = 4096
#: Components of greater size make squared distances that a 64-bit integer can't hold.
LARGEST = 1 << 27
#: Vectors handled at once.
BLOCK = 1024


class Clusters(NamedTuple):
    """``rows``: the kept columns, cluster and distance of each vector; ``centroids``: the final ones, in order."""

    rows: DataFrame
    centroids: np.ndarray


def integer_vectors(vectors: DataFrame, column: str, keep: list[str], dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """The rows whose ``column`` has exactly ``dims`` components, all finite, as (k0, k1, ..., v).

    ``v`` holds floor(scale * x) of each component as little-endian 32-bit integers.
    """
    whole = F.col(f"`{column}`").cast("array<double>")
    kept = vectors.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], whole.alias("x")).where(F.size("x") == dims)
    names = [f"k{i}" for i in range(len(keep))]

    def run(batches):
        for batch in batches:
            x = batch.column(len(names))
            x = x.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)   # a null becomes NaN
            ok = np.isfinite(x).all(axis=1)
            v = np.floor(x[ok] * scale)
            if len(v) and np.abs(v).max() > LARGEST:
                raise ValueError(f"a component times {scale} is beyond {LARGEST}: its squared distance may not fit 64 bits")
            rows = batch.filter(pa.array(ok))
            yield pa.RecordBatch.from_arrays([*rows.columns[:len(names)], fixed(v.astype("<i4"))], names=[*names, "v"])

    schema = ", ".join([*(f"{n} {kept.schema[i].dataType.simpleString()}" for i, n in enumerate(names)), "v binary"])
    return kept.mapInArrow(tidy(run), schema)


def fixed(rows: np.ndarray) -> pa.Array:
    """Each row's bytes as one binary value."""
    size = rows.itemsize * rows.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(np.arange(0, (len(rows) + 1) * size, size, dtype=np.int32)), pa.py_buffer(np.ascontiguousarray(rows))])


def matrix(column: pa.Array, dtype: str, width: int) -> np.ndarray:
    """The rows of a binary column whose values have ``width`` numbers each."""
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros((0, width), dtype)
    at = np.frombuffer(offsets, np.int32)[[column.offset, column.offset + len(column)]]
    return np.frombuffer(data, np.uint8)[at[0]:at[1]].view(dtype).reshape(-1, width)


def _cells(v: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Cell number of every component: how many borders of its dimension are at or below it."""
    return np.stack([np.searchsorted(b, column, "right") for b, column in zip(borders, v.T, strict=True)], axis=1).astype(np.uint8)


def approximate(vectors: DataFrame, borders: np.ndarray) -> DataFrame:
    """``cells`` beside the columns of ``vectors``: the approximation of ``v``, a byte for each dimension."""
    names, dims = vectors.columns, len(borders)

    def run(batches):
        for batch in batches:
            v = matrix(batch.column(names.index("v")), "<i4", dims)
            yield pa.RecordBatch.from_arrays([*batch.columns, fixed(_cells(v, borders))], names=[*names, "cells"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in vectors.schema.fields), "cells binary"])
    return vectors.mapInArrow(tidy(run), schema)


def cell_ends(vectors: DataFrame, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and greatest component in each cell of each dimension, over all vectors; an empty cell has 0."""
    dims = len(borders)
    place = np.arange(dims) * CELLS

    def run(batches):
        low, high = np.full(dims * CELLS, np.iinfo(np.int32).max, np.int32), np.full(dims * CELLS, np.iinfo(np.int32).min, np.int32)
        for batch in batches:
            v = matrix(batch.column(0), "<i4", dims)
            at = (_cells(v, borders) + place).ravel()
            np.minimum.at(low, at, v.ravel())
            np.maximum.at(high, at, v.ravel())
        some = np.flatnonzero(low <= high)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(low[some]), pa.array(high[some])], names=["cell", "low", "high"])

    ends = vectors.select("v").mapInArrow(tidy(run), "cell int, low int, high int").groupBy("cell").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    low, high = np.zeros(dims * CELLS, np.int64), np.zeros(dims * CELLS, np.int64)
    for cell, a, b in ends.collect():                              # dims x CELLS rows at most
        low[cell], high[cell] = a, b
    return low.reshape(dims, CELLS), high.reshape(dims, CELLS)


def lookup_table(centroids: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """[dimension, cell]: least parts of the squared distance to each centroid, then the greatest parts."""
    below, above = low[:, :, None] - centroids.T[:, None, :], centroids.T[:, None, :] - high[:, :, None]
    nearest = np.maximum(np.maximum(below, above), 0) ** 2
    farthest = np.maximum(np.abs(below), np.abs(above)) ** 2
    table = np.concatenate([nearest, farthest], axis=2)
    return table.astype(np.int32) if table.max(axis=(1, 2), initial=0).sum() < 1 << 31 else table


class _Assigner:
    """Nearest centroid of each vector; ``fetched`` counts the vectors whose full components were needed for it."""

    def __init__(self, centroids: np.ndarray, low: np.ndarray, high: np.ndarray):
        self.centroids = centroids
        self.table = lookup_table(centroids, low, high)
        self.fetched = 0

    def assign(self, cells: np.ndarray, v: np.ndarray) -> np.ndarray:
        ends = self.table[0].take(cells[:, 0], axis=0)
        for table, cell in zip(self.table[1:], cells.T[1:], strict=True):
            ends += table.take(cell, axis=0)
        least, most = np.split(ends, 2, axis=1)
        overlap = least <= most.min(axis=1)[:, None]
        cluster = overlap.argmax(axis=1)
        open_rows = np.flatnonzero(overlap.sum(axis=1) > 1)
        self.fetched += len(open_rows)
        if len(open_rows):
            full, overlap = v[open_rows].astype(np.int64), overlap[open_rows]
            best, chosen = np.full(len(full), np.iinfo(np.int64).max), np.zeros(len(full), np.int64)
            for c, centroid in enumerate(self.centroids):
                at = np.flatnonzero(overlap[:, c])
                d = ((full[at] - centroid) ** 2).sum(axis=1)
                closer = d < best[at]
                best[at[closer]], chosen[at[closer]] = d[closer], c
            cluster[open_rows] = chosen
        return cluster


def _assigned(batches, dims: int, centroids: np.ndarray, low: np.ndarray, high: np.ndarray):
    """(batch, first row, vectors, clusters) block by block; the last two columns are v and cells."""
    assigner = _Assigner(centroids, low, high)
    for batch in batches:
        v, cells = matrix(batch.column(batch.num_columns - 2), "<i4", dims), matrix(batch.column(batch.num_columns - 1), "u1", dims)
        for i in range(0, len(v), BLOCK):
            yield batch, i, v[i:i + BLOCK], assigner.assign(cells[i:i + BLOCK], v[i:i + BLOCK])


def cluster_sums(vectors: DataFrame, centroids: np.ndarray, low: np.ndarray, high: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Count and componentwise sum of the vectors nearest to each centroid that has any."""
    k, dims = centroids.shape

    def run(batches):
        sums, counts = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for _, _, v, cluster in _assigned(batches, dims, centroids, low, high):
            order = np.argsort(cluster, kind="stable")
            some, first = np.unique(cluster[order], return_index=True)
            sums[some] += np.add.reduceat(v[order], first, axis=0, dtype=np.int64)
            counts += np.bincount(cluster, minlength=k)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(counts[some]), *(pa.array(sums[some, d]) for d in range(dims))], names=["cluster", "n", *names])

    names = [f"s{d}" for d in range(dims)]
    found = vectors.select("v", "cells").mapInArrow(tidy(run), ", ".join(["cluster int", "n long", *(f"{s} long" for s in names)]))
    return {r[0]: (r[1], list(r[2:])) for r in found.groupBy("cluster").agg(F.sum("n"), *[F.sum(s) for s in names]).collect()}   # k rows at most


def first_centroids(vectors: DataFrame, id_column: str, k: int, seed: int, dims: int) -> np.ndarray:
    """The ``k`` vectors with the least sha256 of ``seed:id``; a null id comes last, repeated ids go by the vector's bytes."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_column).cast("string")), 256)
    rows = vectors.select(key.alias("key"), "v").orderBy(F.col("key").asc_nulls_last(), "v").limit(k).collect()
    return np.array([np.frombuffer(r.v, "<i4") for r in rows], np.int64).reshape(len(rows), dims)


def _borders(vectors: DataFrame, dims: int) -> np.ndarray:
    """Inner borders of the cells, from ``SAMPLE`` vectors chosen by their hash, whatever the layout."""
    rows = vectors.orderBy(F.xxhash64("k0", "v"), "v").limit(SAMPLE).select("v").collect()
    sample = np.array([np.frombuffer(r.v, "<i4") for r in rows], np.int64).reshape(len(rows), dims)
    if not len(sample):
        return np.zeros((dims, CELLS - 1), np.int64)
    return np.ceil(np.linspace(sample.min(axis=0), sample.max(axis=0) + 1, CELLS + 1, axis=1)[:, 1:-1]).astype(np.int64)


def cluster(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding", keep: list[str] | None = None, *,
            k: int = CENTROIDS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: int = SEED) -> Clusters:
    """Lloyd's rounds in whole numbers, from ``k`` vectors chosen by the hash of their id.

    Rows whose vector is null, has another number of components, or a null, NaN or infinite one, are left
    out.  Repeated rows count as often as they come.  Fewer than ``k`` vectors make as many centroids;
    an empty table gives no rows and no centroids.  An input column named cluster or distance gives way to
    the result's.  Components whose size, scaled, exceeds ``LARGEST`` are an error.
    """
    keep = columns_to_keep(vectors, keep, ["cluster", "distance"])
    rows = stage(integer_vectors(vectors, column, [id_column, *keep], dims, scale), "vectors")
    centroids, borders = first_centroids(rows, "k0", k, seed, dims), _borders(rows, dims)
    low, high = cell_ends(rows, borders)
    approximated = stage(approximate(rows.drop("k0"), borders), "approximations")
    if len(centroids):
        for _ in range(rounds):
            for c, (n, sums) in cluster_sums(approximated, centroids, low, high).items():
                centroids[c] = [s // n for s in sums]
    names = [f"k{i + 1}" for i in range(len(keep))]

    def run(batches):
        for batch, i, v, found in _assigned(batches, dims, centroids, low, high):
            distance = ((v - centroids[found]) ** 2).sum(axis=1)
            part = batch.slice(i, len(v))
            yield pa.RecordBatch.from_arrays([*part.columns[:len(names)], pa.array(found.astype(np.int32)), pa.array(distance)], names=[*names, "cluster", "distance"])

    schema = ", ".join([*(f"{n} {approximated.schema[n].dataType.simpleString()}" for n in names), "cluster int", "distance long"])
    done = approximated.select(*names, "v", "cells").mapInArrow(tidy(run), schema)
    return Clusters(done.select(*[F.col(n).alias(c) for n, c in zip(names, keep, strict=True)], "cluster", "distance"), centroids)


def digests(vectors: DataFrame) -> DataFrame:
    found = cluster(vectors, keep=["vec_id"])
    rows = stage(found.rows, "clusters")
    sums = dict(rows.groupBy("cluster").agg(F.sum("distance")).collect())                            # k rows at most
    facts = [(c, sums[c], sum(sums.values()), hashlib.sha256(",".join(map(str, found.centroids[c].tolist())).encode()).hexdigest()) for c in sorted(sums)]
    facts = rows.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
