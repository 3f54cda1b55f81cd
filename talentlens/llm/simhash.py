"""SimHash near-duplicates through deletion-variant signatures.

A 64-bit fingerprint is cut into two 32-bit segments.  Two fingerprints at three or
fewer differing bits differ by at most one bit in one of the segments.  Every segment
is indexed under its 32 one-wildcard variants (one bit blanked); two segments that
differ by at most one bit share a variant, so an equality grouping on (wildcard,
segment with the bit blanked) brings every such pair together, where the distance of
the whole fingerprints is verified.

Copies collapse before the index: it holds distinct fingerprints only.  Within one
variant's group links are verified by growing one linked cluster after another, and
only a spanning tree of each cluster is written, never all pairs.  A group of more
than ``BLOCK`` fingerprints is written out in blocks whose pairs are compared by
separate tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import columns_to_keep, connected, stage
from .text import U64, canonical, slices, tidy

SHINGLE = 3
DISTANCE = 3
SEED = 42
BLOCK = 40_000

_P1, _P2, _P3 = U64(0x9E3779B185EBCA87), U64(0xC2B2AE3D27D4EB4F), U64(0x165667B19E3779F9)
_P4, _P5 = U64(0x85EBCA77C2B2AE63), U64(0x27D4EB2F165667C5)


def _rotl(x, r):
    return (x << U64(r)) | (x >> U64(64 - r))


def _round(acc, lane):
    return _rotl(acc + lane * _P2, 31) * _P1


def xxh64(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = SEED) -> np.ndarray:
    """XXH64 of every span of the bytes."""
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    lane8 = np.ndarray((len(raw) + 1,), "<u8", padded, strides=(1,))
    lane4 = np.ndarray((len(raw) + 5,), "<u4", padded, strides=(1,))
    mask = (1 << 64) - 1
    at, size = starts.astype(np.int64), (ends - starts).astype(np.int64)
    h = np.full(len(at), (seed + int(_P5)) & mask, U64)
    long = np.flatnonzero(size >= 32)
    if len(long):
        pos, stripes = at[long].copy(), size[long] // 32
        first = seed + int(_P1) + int(_P2), seed + int(_P2), seed, seed - int(_P1)
        acc = [np.full(len(long), x & mask, U64) for x in first]
        live = np.arange(len(long))
        while len(live):
            for k in range(4):
                acc[k][live] = _round(acc[k][live], lane8[pos[live] + 8 * k])
            pos[live] += 32
            stripes[live] -= 1
            live = live[stripes[live] > 0]
        x = _rotl(acc[0], 1) + _rotl(acc[1], 7) + _rotl(acc[2], 12) + _rotl(acc[3], 18)
        for k in range(4):
            x = (x ^ _round(U64(0), acc[k])) * _P1 + _P4
        h[long] = x
        at = at.copy()
        at[long] = pos
    h += size.astype(U64)
    rest = ends - at
    live = np.flatnonzero(rest >= 8)
    while len(live):
        h[live] = _rotl(h[live] ^ _round(U64(0), lane8[at[live]]), 27) * _P1 + _P4
        at[live] += 8
        rest[live] -= 8
        live = live[rest[live] >= 8]
    live = np.flatnonzero(rest >= 4)
    h[live] = _rotl(h[live] ^ (lane4[at[live]].astype(U64) * _P1), 23) * _P2 + _P3
    at[live] += 4
    rest[live] -= 4
    live = np.flatnonzero(rest > 0)
    while len(live):
        h[live] = _rotl(h[live] ^ (padded[at[live]].astype(U64) * _P5), 11) * _P1
        at[live] += 1
        rest[live] -= 1
        live = live[rest[live] > 0]
    h ^= h >> U64(33)
    h *= _P2
    h ^= h >> U64(29)
    h *= _P3
    return h ^ (h >> U64(32))


def fingerprints(raw: np.ndarray, bounds: np.ndarray, shingle: int = SHINGLE) -> np.ndarray:
    """SimHash of each document of a slice."""
    text, starts, ends, first = canonical(raw, bounds, lower=True)
    n_words = np.diff(first)
    count = np.where(n_words >= shingle, n_words - shingle + 1, np.minimum(n_words, 1))
    offset = np.concatenate([[0], np.cumsum(count)])
    doc = np.repeat(np.arange(len(count)), count)
    begin = np.arange(offset[-1]) - offset[doc] + first[doc]
    h = xxh64(text, starts[begin], ends[np.minimum(begin + shingle, first[doc + 1]) - 1])
    out = np.zeros(len(count), U64)
    some = np.flatnonzero(count)
    if len(some):
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, offset[some], axis=0, dtype=np.int32)
        major = (2 * ones > count[some][:, None]).astype(np.uint8)
        out[some] = np.packbits(major, axis=1, bitorder="little").view("<u8").ravel()
    return out


def _spanning(values: np.ndarray, distance: int) -> tuple[list, list]:
    """Links of a spanning forest of the graph of values at ``distance`` or fewer bits."""
    a, b, rest = [], [], values
    while len(rest) > 1:
        root, rest, frontier = rest[0], rest[1:], [rest[0]]
        while frontier and len(rest):
            near = np.bitwise_count(rest ^ frontier.pop()) <= distance
            if near.any():
                found = rest[near]
                rest = rest[~near]
                a.append(np.full(len(found), root))
                b.append(found)
                frontier.extend(found)
    return a, b


def _group_links(distance: int, block: int):
    """Arrow function over (key, fp) sorted by key: links of each group, or the blocks of a group too large for one task."""

    def rows(kind, a, b, part=None):
        n = len(a)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, kind, np.int8)), pa.array(np.asarray(a).view(np.int64)), pa.array(np.asarray(b).view(np.int64)),
             pa.array(np.zeros(n, np.int32) if part is None else part, pa.int32())], names=["kind", "a", "b", "part"])

    def run(batches):
        held_key, held, parts = None, [], 0

        def close():
            if held_key is None:
                return
            values = np.unique(np.concatenate(held)) if held else np.zeros(0, U64)
            if parts:
                if len(values):
                    yield rows(1, np.full(len(values), held_key, np.int64), values, np.full(len(values), parts, np.int32))
            elif len(values) > 1:
                a, b = _spanning(values, distance)
                if a:
                    yield rows(0, np.concatenate(a), np.concatenate(b))

        for batch in batches:
            key = batch.column(0).to_numpy()
            fp = batch.column(1).to_numpy().view(U64)
            if not len(key):
                continue
            cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
            begin, size = cut[:-1], np.diff(cut)
            # groups that lie wholly inside the batch; the last may go on in the next one
            if key[0] == held_key:
                held.append(fp[:size[0]])
                begin, size = begin[1:], size[1:]
                if sum(map(len, held)) >= block:
                    yield rows(1, np.full(sum(map(len, held)), held_key, np.int64), np.concatenate(held), np.full(sum(map(len, held)), parts, np.int32))
                    held, parts = [], parts + 1
            if not len(begin):
                continue
            yield from close()
            begin, size, last = begin[:-1], size[:-1], begin[-1]
            held_key, held, parts = key[last], [fp[last:]], 0
            a, b = [], []
            for k in (2, 3):                                       # the many small groups, all at once
                s = begin[size == k]
                for i in range(k):
                    for j in range(i + 1, k):
                        near = np.bitwise_count(fp[s + i] ^ fp[s + j]) <= distance
                        a.append(fp[s + i][near])
                        b.append(fp[s + j][near])
            for s, k in zip(begin[size > 3].tolist(), size[size > 3].tolist(), strict=True):
                more = _spanning(np.unique(fp[s:s + k]), distance)
                a += more[0]
                b += more[1]
            if a and sum(map(len, a)):
                yield rows(0, np.concatenate(a), np.concatenate(b))
        yield from close()

    return run


_LINKS = "kind byte, a long, b long, part int"


def links(distinct: DataFrame, distance: int = DISTANCE, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fp`` that connect exactly what distance links connect."""
    if distance > 3:
        raise ValueError("two segments with one wildcard find up to three differing bits")
    variants = (distinct.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("w"))
                .selectExpr("fp", "w", "shiftrightunsigned(fp, 32 * shiftright(w, 5)) & 4294967295L AS segment")
                .selectExpr("shiftleft(cast(w AS bigint), 32) | (segment & ~shiftleft(1L, w & 31)) AS key", "fp"))
    found = stage(variants.repartition("key").sortWithinPartitions("key").mapInArrow(tidy(_group_links(distance, block)), _LINKS), "links")
    near = found.where("kind = 0").select("a", "b")
    blocks = found.where("kind = 1").select(F.col("a").alias("key"), F.col("b").alias("fp"), "part")
    parts = blocks.groupBy("key").agg(F.max("part").alias("last"))
    pairs = (blocks.join(parts, "key").select("key", "fp", "part", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("other"))
             .select(F.xxhash64("key", F.least("part", "other"), F.greatest("part", "other")).alias("key"), "fp"))
    crossed = pairs.repartition("key").sortWithinPartitions("key").mapInArrow(tidy(_group_links(distance, 1 << 62)), _LINKS)
    return near.union(crossed.select("a", "b"))


def fingerprint_rows(docs: DataFrame, text: str = "text", keep: list[str] | None = None, shingle: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` with ``fp``, the signed 64-bit SimHash of the whole text (null or wordless: 0)."""
    keep = columns_to_keep(docs, keep, ["fp"])
    kept = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], F.col(f"`{text}`").cast("string").alias("sim_text"))
    names = [f"k{i}" for i in range(len(keep))]

    def run(batches):
        for batch in batches:
            for row, raw, bounds in slices(batch, "sim_text"):
                part = batch.slice(row, len(bounds) - 1)
                yield pa.RecordBatch.from_arrays([*part.columns[:len(keep)], pa.array(fingerprints(raw, bounds, shingle).view(np.int64))], names=[*names, "fp"])

    schema = ", ".join([*(f"{n} {kept.schema[i].dataType.simpleString()}" for i, n in enumerate(names)), "fp long"])
    return kept.mapInArrow(tidy(run), schema).select(*[F.col(n).alias(c) for n, c in zip(names, keep, strict=True)], "fp")


def hex64(c: str | Column) -> Column:
    return F.lower(F.lpad(F.hex(c), 16, "0"))


def _roots(rows: DataFrame, order, distance: int) -> tuple[DataFrame, DataFrame]:
    """(fp, root) of every distinct fingerprint, and (root, least) with the least ``order`` of its component."""
    distinct = rows.groupBy("fp").agg(F.min(order).alias("least"))
    roots = connected(links(distinct.select("fp"), distance))
    rooted = stage(distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "roots")
    return rooted.select("fp", "root"), rooted.groupBy("root").agg(F.min("least").alias("least"))


def components(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fp, component_id) of every row: the least doc_id that links reach, the own one included.

    Wordless, empty and null texts share fingerprint zero and link like any other.  Repeated rows come
    back as often as they came.  A null doc_id takes part in linking, but never names a component unless
    the whole component has none (then component_id is null).  An empty table gives an empty table.
    """
    rows = stage(fingerprint_rows(docs, text, ["doc_id"], shingle), "fingerprints")
    by_fp, least = _roots(rows, "doc_id", distance)
    return rows.join(by_fp.join(least, "root").select("fp", F.col("least").alias("component_id")), "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the row with the least doc_id stays.

    Of rows that share that id, or have none, one stays; a null id comes after every other.
    """
    packed = docs.select(F.struct("*").alias("row"), F.col(f"`{text}`").alias("text"))
    rows = stage(fingerprint_rows(packed, "text", ["row"], shingle)
                 .select("row", "fp", F.coalesce(F.col("row.doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("id"), F.monotonically_increasing_id().alias("seq")), "rows")
    _, least = _roots(rows, F.struct("id", "seq"), distance)
    kept = rows.join(least.select(F.col("least.seq").alias("seq")), "seq", "left_semi")
    return kept.select("row.*")


def digests(docs: DataFrame) -> DataFrame:
    return components(docs).select("doc_id", hex64("fp").alias("fingerprint"), "component_id")
