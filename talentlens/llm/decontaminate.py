"""Benchmark decontamination by winnowing.

Words are lower-cased alphanumeric runs.  Every k-gram of words is hashed and the
least hash of each sliding window of ``window - k + 1`` k-grams is kept, on both
sides; two texts that share a span of ``window`` words therefore share a kept
k-gram at the same place of the span.  Test and training fingerprints are joined;
each hit is extended to the windows of words around it, which are looked up whole
among the windows of the benchmark.

Items shorter than a window count as one window of their own length and get
fingerprints of that length's own layout, so no item escapes.

The benchmark is the stated query set.  It is cut into blocks of at most
``BLOCK_WORDS`` words (one item at least); each block's tables are broadcast, and
every document is matched with all blocks in one pass over the corpus, without a
shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import columns_to_keep
from .text import ALNUM_BYTES, LOWER_AZ, U64, Rolling, bytes_of, covered, mix, slices, tidy, winnow, word_hashes, word_spans

WINDOW = 10
GRAM = 5
BLOCK_WORDS = 2_000_000


def _words(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    raw = LOWER_AZ[raw]
    starts, ends, first = word_spans(raw, bounds, ALNUM_BYTES)
    return word_hashes(raw, starts, ends), first


def _inside(n: int, first: np.ndarray, length: int) -> np.ndarray:
    """Mask of the n window starts whose window of ``length`` words lies in one document."""
    step = np.zeros(n + 1, np.int32)
    begin, end = first[:-1], first[1:] - length + 1
    some = end > begin
    np.add.at(step, begin[some], 1)
    np.add.at(step, end[some], -1)
    return np.cumsum(step[:-1]) > 0


@dataclass
class Layout:
    """Fingerprints and windows of the benchmark items whose windows have ``length`` words."""
    length: int
    gram: int
    prints: np.ndarray           # sorted kept k-gram hashes
    windows: np.ndarray          # sorted distinct window hashes
    item_first: np.ndarray       # items of window i: items[item_first[i]:item_first[i + 1]]
    items: np.ndarray            # places in the block's list of item ids


@dataclass
class Block:
    ids: list
    layouts: list[Layout]


def build_block(ids: list, texts: list[str], window: int = WINDOW, gram: int = GRAM) -> Block:
    raw, bounds = bytes_of(pa.array(texts, pa.large_string()))
    words, first = _words(raw, bounds)
    sizes = np.diff(first)
    layouts = []
    for length in sorted({min(int(s), window) for s in sizes if s}):
        chosen = np.flatnonzero(np.minimum(sizes, window) == length)
        own = np.concatenate([words[first[i]:first[i + 1]] for i in chosen])
        own_first = np.concatenate([[0], np.cumsum(sizes[chosen])])
        g = min(gram, length)
        rolling = Rolling(own)
        ok = _inside(len(own) - length + 1, own_first, length)
        starts = np.flatnonzero(ok)
        hashes = mix(rolling.window(starts, starts + length))
        owner = chosen[np.searchsorted(own_first, starts, "right") - 1]
        order = np.lexsort((owner, hashes))
        hashes, owner = hashes[order], owner[order]
        distinct, at = np.unique(hashes, return_index=True)
        grams = mix(rolling.every(g))
        prints = np.unique(grams[winnow(grams, length - g + 1, own_first, g)])
        layouts.append(Layout(length, g, prints, distinct, np.append(at, len(hashes)), owner))
    return Block(ids, layouts)


def _member(sorted_values: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Place of each value among the sorted ones, or -1."""
    if not len(sorted_values):
        return np.full(len(values), -1, np.int64)
    at = np.searchsorted(sorted_values, values)
    at[at == len(sorted_values)] = 0
    return np.where(sorted_values[at] == values, at, -1)


def match(block: Block, words: np.ndarray, first: np.ndarray, rolling: Rolling, kept: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(span starts, span ends, documents, items) of all windows of the block that occur in the documents."""
    spans, owners = [], []
    for lay in block.layouts:
        if len(words) < lay.length:
            continue
        key = (lay.length, lay.gram)
        if key not in kept:
            grams = mix(rolling.every(lay.gram))
            at = winnow(grams, lay.length - lay.gram + 1, first, lay.gram)
            kept[key] = at, grams[at]
        at, prints = kept[key]
        hits = at[_member(lay.prints, prints) >= 0]                      # the join of fingerprints
        if not len(hits):
            continue
        around = np.unique((hits[:, None] - np.arange(lay.length - lay.gram + 1)).ravel())
        around = around[(around >= 0) & (around + lay.length <= len(words))]
        doc = np.searchsorted(first, around, "right") - 1
        ok = around + lay.length <= first[doc + 1]
        around, doc = around[ok], doc[ok]
        place = _member(lay.windows, mix(rolling.window(around, around + lay.length)))      # extended to whole windows
        found = place >= 0
        around, doc, place = around[found], doc[found], place[found]
        spans.append((around, around + lay.length))
        pairs = np.unique(np.stack([doc, place], 1), axis=0) if len(doc) else np.zeros((0, 2), np.int64)
        counts = lay.item_first[pairs[:, 1] + 1] - lay.item_first[pairs[:, 1]]
        begin = np.repeat(lay.item_first[pairs[:, 1]] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
        owners.append((np.repeat(pairs[:, 0], counts), lay.items[begin + np.arange(counts.sum())]))
    cat = lambda parts, i: np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64)
    return cat(spans, 0), cat(spans, 1), cat(owners, 0), cat(owners, 1)


def _blocks(benchmark: DataFrame, item_id: str, text: str, block_words: int, window: int, gram: int):
    """Blocks of the benchmark, one in the driver's memory at a time."""
    ids, texts, size = [], [], 0
    rows = benchmark.select(F.col(item_id).alias("i"), F.col(text).cast("string").alias("t")).where(F.col("t").isNotNull())
    for row in rows.toLocalIterator():
        n = len(row.t) // 2 + 1                                           # words at most
        if ids and size + n > block_words:
            yield build_block(ids, texts, window, gram)
            ids, texts, size = [], [], 0
        ids.append(row.i)
        texts.append(row.t)
        size += n
    if ids:
        yield build_block(ids, texts, window, gram)


def find(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", benchmark_text: str = "text",
         keep: list[str] | None = None, window: int = WINDOW, gram: int = GRAM, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs`` with ``n_words``, ``n_hit``, ``spans`` (hit runs of words as [start, end) pairs) and ``items``.

    ``items`` holds the ids, as strings and sorted, of the items with a window that occurs in the
    document.  A null or empty text has no words; a null or wordless item has no windows; items with
    equal windows are all reported; repeated rows get the same result each.  An empty benchmark
    hits nothing.
    """
    sc = docs.sparkSession.sparkContext
    blocks = [sc.broadcast(b) for b in _blocks(benchmark, item_id, benchmark_text, block_words, window, gram)]
    keep = columns_to_keep(docs, keep, ["n_words", "n_hit", "spans", "items"])
    kept = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], F.col(f"`{text}`").cast("string").alias("dec_text"))
    names = [f"k{i}" for i in range(len(keep))]

    def run(batches):
        for batch in batches:
            for row, raw, bounds in slices(batch, "dec_text"):
                n = len(bounds) - 1
                words, first = _words(raw, bounds)
                rolling, prints = Rolling(words), {}
                begins, ends, items = [], [], [set() for _ in range(n)]
                for shared in blocks:
                    block = shared.value
                    s, e, doc, item = match(block, words, first, rolling, prints)
                    begins.append(s)
                    ends.append(e)
                    for d, i in zip(doc.tolist(), item.tolist(), strict=True):
                        items[d].add(str(block.ids[i]))
                hit = covered(np.concatenate([np.zeros(0, np.int64), *begins]), np.concatenate([np.zeros(0, np.int64), *ends]), len(words))
                total = np.concatenate([[0], np.cumsum(hit)])
                edge = np.zeros(len(words) + 1, bool)
                edge[first] = True
                before = np.concatenate([[False], hit[:-1]]) if len(hit) else hit
                after = np.concatenate([hit[1:], [False]]) if len(hit) else hit
                s = np.flatnonzero(hit & (~before | edge[:-1]))
                e = np.flatnonzero(hit & (~after | edge[1:])) + 1
                doc = np.searchsorted(first, s, "right") - 1
                flat = np.stack([s - first[doc], e - first[doc]], 1).ravel()
                spans = pa.ListArray.from_arrays(pa.array(2 * np.searchsorted(doc, np.arange(n + 1)), pa.int32()), pa.array(flat, pa.int64()))
                part = batch.slice(row, n)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:len(keep)], pa.array(np.diff(first), pa.int64()), pa.array(total[first[1:]] - total[first[:-1]], pa.int64()), spans,
                     pa.array([sorted(x) for x in items], pa.list_(pa.string()))], names=[*names, "n_words", "n_hit", "spans", "items"])

    schema = ", ".join([*(f"{n} {kept.schema[i].dataType.simpleString()}" for i, n in enumerate(names)),
                        "n_words long, n_hit long, spans array<long>, items array<string>"])
    return kept.mapInArrow(tidy(run), schema).select(*[F.col(n).alias(c) for n, c in zip(names, keep, strict=True)], "n_words", "n_hit", "spans", "items")


def digests(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = find(docs, benchmark, keep=["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
