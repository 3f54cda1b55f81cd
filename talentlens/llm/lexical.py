"""Ranked lexical search through bags of words that documents share.

Items are the stated query set: blocks of them, with at most ``BLOCK_TERMS`` item terms or so, meet all documents.

1. Every document is reduced to its bag: which terms of the item vocabulary it holds, and how often,
   beside n, the number of all its terms.  N, L and the document frequencies are counted over all documents.
2. Documents with equal bags and equal m score alike for every item.  They are grouped by a hash of both, and
   within it by the bag and m themselves; a class keeps its ``top`` least doc_ids (no result can hold more of
   them), chosen by a group limit in each task before the shuffle.
3. Each class is scored once, through an index from term to items.  A task keeps, for each item, the
   ``top`` best members of its classes; those of all tasks are ranked in one more window.

A document without any term of the vocabulary scores nothing and leaves after step 1.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .staging import stage
from .text import ALNUM_BYTES, LOWER_AZ, slices, tidy, word_spans

TOP = 10
#: Item terms (distinct within an item) of one block of items; their vocabulary and index are broadcast.
BLOCK_TERMS = 2_000_000
#: Scores (of classes by items) held at once.
SCORES = 1 << 16


def words_of(raw: np.ndarray, bounds: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All terms of a slice as one Arrow array, and the first one of each document."""
    raw = LOWER_AZ[raw]
    starts, ends, first = word_spans(raw, bounds, ALNUM_BYTES)
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    inside = ALNUM_BYTES[raw]
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(raw[inside])]), first


def item_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item, terms): the distinct terms of each item, sorted; an item without any has an empty list."""

    def run(batches):
        for batch in batches:
            for row, raw, bounds in slices(batch, "text"):
                words, first = words_of(raw, bounds)
                terms = [sorted(set(words[a:b].to_pylist())) for a, b in zip(first[:-1], first[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(terms)), pa.array(terms, pa.list_(pa.binary()))], names=["item", "terms"])

    packed = items.select(F.col(f"`{item_id}`").alias("item"), F.col(f"`{text}`").cast("string").alias("text"))
    return packed.mapInArrow(tidy(run), f"item {packed.schema[0].dataType.simpleString()}, terms array<binary>")


class _Index:
    """The vocabulary of a block of items, and the items that hold each of its terms."""

    def __init__(self, terms: list[list[bytes]]):
        holders: dict[bytes, list[int]] = {}
        for i, held in enumerate(terms):
            for t in held:
                holders.setdefault(t, []).append(i)
        self.vocabulary = pa.array(list(holders), pa.large_binary())
        self.n_items = len(terms)
        self.items = np.fromiter((i for held in holders.values() for i in held), np.int64)
        self.first = np.concatenate([[0], np.cumsum([len(held) for held in holders.values()], dtype=np.int64)]).astype(np.int64)


def bags(docs: DataFrame, vocabulary: pa.Array) -> DataFrame:
    """(doc, n, bag) of (doc, text): n counts all terms; ``bag`` holds the sorted pairs (place in the vocabulary, occurrences), 32 bits each."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    size = max(1, len(vocabulary))

    def run(batches):
        known = shared.value
        for batch in batches:
            for row, raw, bounds in slices(batch, "text"):
                words, first = words_of(raw, bounds)
                place = pc.index_in(words, value_set=known)
                at = np.flatnonzero(pc.is_valid(place).to_numpy(zero_copy_only=False))
                doc = np.searchsorted(first, at, "right") - 1
                key, tf = np.unique(doc * size + place.drop_null().to_numpy(), return_counts=True)
                pairs = np.stack([key % size, tf], axis=1).astype("<i4")
                offsets = (np.searchsorted(key, np.arange(len(bounds)) * size) * 8).astype(np.int32)
                bag = pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(pairs)])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(bounds) - 1), pa.array(np.diff(first)), bag], names=["doc", "n", "bag"])

    return docs.select("doc", "text").mapInArrow(tidy(run), f"doc {docs.schema['doc'].dataType.simpleString()}, n long, bag binary")


def _pairs(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(pairs, first): the bags of a column laid end to end; bag i has pairs ``first[i]:first[i + 1]``."""
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    held = np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    return held.view("<i4").reshape(-1, 2), (bounds - bounds[0]) // 8


def document_frequencies(bagged: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term of the vocabulary."""

    def run(batches):
        count = np.zeros(size, np.int64)
        for batch in batches:
            if len(batch):
                count += np.bincount(_pairs(batch.column(0))[0][:, 0], minlength=size)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(count[some])], names=["term", "df"])

    counted = bagged.select("bag").mapInArrow(tidy(run), "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))
    found = counted.toArrow()                                      # a row for each term of the block at most
    out = np.zeros(size, np.int64)
    out[found["term"].to_numpy()] = found["df"].to_numpy()
    return out


def classes(bagged: DataFrame, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """(m, bag, members): documents that score alike, with the ``top`` least of their ids (null ids last), as rows."""
    m = F.expr(f"100 - 90 + (90 * n * {n_docs}L) div {max(1, n_terms)}L").alias("m")
    rows = bagged.where(F.length("bag") > 0).select("doc", m, "bag").withColumn("h", F.xxhash64("m", "bag"))
    order = Window.partitionBy("h", "m", "bag").orderBy(F.col("doc").asc_nulls_last())
    least = rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top)
    return least.groupBy("h", "m", "bag").agg(F.sort_array(F.collect_list(F.struct("place", "doc"))).alias("members")).select("m", "bag", F.col("members.doc").alias("members"))


def _best(scores: np.ndarray, top: int) -> np.ndarray:
    """Rows whose score is among the ``top`` greatest, ties of the last one included."""
    if len(scores) <= top:
        return np.arange(len(scores))
    return np.flatnonzero(scores >= np.partition(scores, len(scores) - top)[len(scores) - top])


def score_classes(grouped: DataFrame, index: _Index, weights: np.ndarray, top: int) -> DataFrame:
    """(item, score, doc): for each item the best members of the classes of each task, ``top`` at least if it has as many."""
    shared = grouped.sparkSession.sparkContext.broadcast((index.items, index.first, index.n_items, weights))
    doc_type = grouped.schema["members"].dataType.elementType
    doc_arrow = to_arrow_type(doc_type)

    def run(batches):
        items, first, n_items, w = shared.value
        best: list[list] = [[] for _ in range(n_items)]            # of each item: (-score, null id last, id)
        step = max(1, SCORES // n_items)
        for batch in batches:
            m, members = batch.column(0).to_numpy(), batch.column(2)
            for a in range(0, len(batch), step):
                part = batch.column(1).slice(a, step)
                pairs, begin = _pairs(part)
                term, tf = pairs[:, 0], pairs[:, 1].astype(np.int64)
                row = np.repeat(np.arange(len(part)), np.diff(begin))
                gain = w[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[a + row]))
                holders = first[term + 1] - first[term]
                at = np.arange(holders.sum()) + np.repeat(first[term] - np.cumsum(holders) + holders, holders)
                scores = np.zeros(len(part) * n_items, np.int64)
                np.add.at(scores, np.repeat(row * n_items, holders) + items[at], np.repeat(gain, holders))
                scores = scores.reshape(len(part), n_items)
                floor = np.array([-held[top - 1][0] if len(held) >= top else 1 for held in best])
                for i in np.flatnonzero((scores >= floor).any(axis=0)).tolist():
                    found = np.flatnonzero(scores[:, i] >= floor[i])
                    found = found[_best(scores[found, i], top)]
                    held = best[i] + [(-s, d is None, d) for r, s in zip(found.tolist(), scores[found, i].tolist(), strict=True) for d in members[a + r].as_py()]
                    best[i] = sorted(held, key=lambda x: x if x[2] is not None else (*x[:2], 0))[:top]
        flat = [(i, -s, d) for i, held in enumerate(best) for s, _, d in held]
        columns = list(zip(*flat, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()), pa.array(columns[2], doc_arrow)], names=["item", "score", "doc"])

    return grouped.select("m", "bag", "members").mapInArrow(tidy(run), f"item int, score long, doc {doc_type.simpleString()}")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): for each row of ``items`` its ``top`` best documents, equal scores by ascending doc_id.

    Documents and items may be null, empty or of any length; one without a term takes no part.  Repeated
    rows are documents (items) of their own.  A null doc_id comes after all others of its score.
    Empty tables give an empty table.  Other columns of the tables are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc"), F.col(f"`{text}`").cast("string").alias("text"))
    queries = stage(item_terms(items, item_id, text).where(F.size("terms") > 0), "items")
    total = queries.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = -(-total // block_terms)
    id_type, doc_type = (f.dataType.simpleString() for f in (queries.schema["item"], rows.schema["doc"]))
    out = spark.createDataFrame([], f"item_id {id_type}, rank int, doc_id {doc_type}, score long")
    for b in range(blocks):
        held = queries.where(F.pmod(F.xxhash64("item", "terms"), F.lit(blocks)) == b).toArrow()      # about block_terms terms
        index = _Index(held["terms"].to_pylist())
        bagged = stage(bags(rows, index.vocabulary), "bags")
        n_docs, n_terms = bagged.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = document_frequencies(bagged, len(index.vocabulary))
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * f + 1))) for f in df.tolist()], np.int64)
        found = stage(score_classes(classes(bagged, n_docs, n_terms, top), index, weights, top), "best")
        place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc").asc_nulls_last()))
        ranked = found.withColumn("rank", place).where(F.col("rank") <= top)
        names = spark.createDataFrame(pa.table({"item": pa.array(range(len(held)), pa.int32()), "item_id": held["item"]}))
        out = out.union(ranked.join(F.broadcast(names), "item").select("item_id", "rank", F.col("doc").alias("doc_id"), "score"))
    return out
