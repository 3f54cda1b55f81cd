"""Suffix-array dedup by blockwise construction over a difference cover.

Every byte of a document that lies in a ``length``-byte string which also starts
anywhere else, in the same or in another document, is removed.

The suffixes at a difference cover (``v`` = q*q + q + 1 places, q + 1 of them chosen, so
that any two places meet at a common shift below ``v`` with both in the cover) are ranked
first: by the fingerprint of the ``length - v + 1`` bytes that follow, and within equal
ones by the fingerprint of the wider stretch from ``v`` bytes before to ``v`` bytes after.
Fingerprints cut the suffixes into buckets; one bucket is sorted at a time, so memory is
bounded by the bucket and not by the corpus.  Ranks put ties where texts are equal, which
is all that removal asks of the order.

Two strings of ``length`` bytes that are equal tie at a cover place.  Where a whole
stretch ties with another, all its strings are decided by the ranks alone.  Only the
suffixes up to ``v`` before a cover place that ties narrowly but not widely stay open:
near the ends of copied passages.  Those are sorted, again bucket by bucket, by all
``length`` bytes.  One member stands for all that tie widely, so a group of many copies is
never gathered; tasks merge their own ties before anything is shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import columns_to_keep, release, stage
from .text import U64, Rolling, covered, difference_cover, mix, slices, tidy

LENGTH = 400
#: v = 133, 12 places of the cover.
COVER_Q = 11
#: Bytes of text whose cover suffixes make up a bucket.
BUCKET_BYTES = 8 << 20
MIN_BUCKETS = 256
#: Bytes of text whose suffixes a task merges before they are shuffled.
FLUSH_BYTES = 8 << 20

_PLACE = np.dtype([("seq", "<i8"), ("pos", "<i4")])
_MULTI = 1 << 30          # flag in pos: stands for several ties of its task
_WANTED = 1 << 29         # flag in pos: the document asks whether this suffix ties
_POS = _WANTED - 1
_BUCKET_SCHEMA = "bucket int, cls binary, grp binary, n int, places binary, n_done int, done binary"


def _pack(places: np.ndarray) -> bytes:
    seqs = np.diff(places["seq"], prepend=np.int64(0))
    return pa.Codec("zstd", compression_level=1).compress(seqs.tobytes() + np.ascontiguousarray(places["pos"]).tobytes(), asbytes=True) if len(places) else b""


def _unpack(data: bytes, n: int) -> np.ndarray:
    out = np.zeros(n, _PLACE)
    if n:
        raw = pa.Codec("zstd").decompress(data, decompressed_size=12 * n, asbytes=True)
        out["seq"] = np.cumsum(np.frombuffer(raw, "<i8", n))
        out["pos"] = np.frombuffer(raw, "<i4", n, 8 * n)
    return out


class _Buckets:
    """Collects suffixes of one task and gives them out by bucket, ties of the task merged."""

    def __init__(self, buckets: int):
        self.buckets, self.parts = buckets, []

    def add(self, bucket_hash: np.ndarray, cls: np.ndarray, grp: np.ndarray, places: np.ndarray) -> None:
        bucket = (((bucket_hash >> U64(32)) * U64(self.buckets)) >> U64(32)).astype(np.int32)
        self.parts.append((bucket, cls.astype(np.uint32), grp, places))

    def flush(self):
        bucket, cls, grp, places = (np.concatenate(c) for c in zip(*self.parts, strict=True))
        self.parts = []
        if not len(bucket):
            return
        order = np.lexsort((grp, cls, bucket))
        same = (bucket[order[1:]] == bucket[order[:-1]]) & (cls[order[1:]] == cls[order[:-1]]) & (grp[order[1:]] == grp[order[:-1]])
        later = order[1:][same]
        head = order[np.concatenate([[True], ~same])]
        size = np.diff(np.concatenate([np.flatnonzero(np.concatenate([[True], ~same])), [len(order)]]))
        places["pos"][head[size > 1]] |= _MULTI
        is_head = np.ones(len(bucket), bool)
        is_head[later] = False
        kept = np.argsort(np.where(is_head, bucket, self.buckets), kind="stable")[:len(head)]
        done = later[np.argsort(later, kind="stable")]
        done = done[np.argsort(bucket[done], kind="stable")]
        edge = np.arange(self.buckets + 1)
        cut, cut_done = np.searchsorted(bucket[kept], edge), np.searchsorted(bucket[done], edge)
        rows = []
        for b in np.flatnonzero(np.diff(cut)).tolist():
            k, d = kept[cut[b]:cut[b + 1]], done[cut_done[b]:cut_done[b + 1]]
            rows.append((b, cls[k].tobytes(), grp[k].tobytes(), len(k), _pack(places[k]), len(d), _pack(places[d])))
        for a in range(0, len(rows), 64):
            columns = list(zip(*rows[a:a + 64], strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.binary(), pa.int32(), pa.binary()), strict=True)],
                                             names=["bucket", "cls", "grp", "n", "places", "n_done", "done"])


def _cover_suffixes(length: int, q: int, buckets: int):
    v, cover = difference_cover(q)
    width = length - v + 1

    def run(batches):
        out, size = _Buckets(buckets), 0
        for batch in batches:
            seqs = batch.column(0).to_numpy()
            for row, raw, bounds in slices(batch, "body"):
                n = np.diff(bounds)
                at = np.sort((np.arange(0, int(n.max()) // v + 1)[:, None] * v + cover).ravel())
                count = np.where(n >= length, np.searchsorted(at, n - width, "right"), 0)
                first = np.concatenate([[0], np.cumsum(count)])
                doc = np.repeat(np.arange(len(n)), count)
                p = at[np.arange(first[-1]) - first[doc]]
                begin, end = bounds[doc], bounds[doc + 1]
                rolling = Rolling(raw)
                narrow = mix(rolling.window(begin + p, begin + p + width))
                lo, hi = np.maximum(begin + p - v, begin), np.minimum(begin + p + v + width, end)
                shape = (begin + p - lo).astype(U64) * U64(1 << 20) + (hi - begin - p).astype(U64)
                wide = mix(rolling.window(lo, hi) + mix(shape))
                places = np.zeros(len(p), _PLACE)
                places["seq"], places["pos"] = seqs[row + doc], p
                out.add(narrow, narrow & U64(0xFFFFFFFF), wide, places)
                size += len(raw)
                if size >= FLUSH_BYTES:
                    yield from out.flush()
                    size = 0
        if out.parts:
            yield from out.flush()

    return run


def _sort_buckets(cover: bool):
    """Arrow function over rows sorted by bucket: sorts one bucket at a time and tells which places tie.

    Of cover suffixes: ``kind`` 1 ties widely, 2 stays open, 3 ties widely and stands for its ties where
    others stay open.  Of open suffixes: the wanted ones that tie.
    """

    def settle(rows):
        cls = np.concatenate([np.frombuffer(r["cls"], np.uint32) for r in rows])
        grp = np.concatenate([np.frombuffer(r["grp"], np.uint64) for r in rows])
        places = np.concatenate([_unpack(r["places"], r["n"]) for r in rows])
        done = np.concatenate([_unpack(r["done"], r["n_done"]) for r in rows])
        order = np.lexsort((grp, cls))
        cls, grp, places = cls[order], grp[order], places[order]
        new_cls = np.concatenate([[True], cls[1:] != cls[:-1]])
        new_grp = new_cls | np.concatenate([[True], grp[1:] != grp[:-1]])
        group = np.cumsum(new_grp) - 1
        ties = (np.bincount(group)[group] > 1) | (places["pos"] & _MULTI > 0)
        if cover:
            in_class = np.cumsum(new_cls) - 1
            open_ = (np.bincount(in_class[new_grp])[in_class] > 1) & new_grp
            kind = ties * 1 + open_ * 2
            done_kind = np.ones(len(done), np.int8)
        else:
            kind = (ties & (places["pos"] & _WANTED > 0)) * 1
            done_kind = (done["pos"] & _WANTED > 0) * 1
        places, kind = np.concatenate([places, done]), np.concatenate([kind, done_kind])
        at = np.flatnonzero(kind)
        for a in range(0, len(at), 50_000):
            some = at[a:a + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(places["seq"][some]), pa.array((places["pos"][some] & _POS).astype(np.int64) << 2 | kind[some])],
                names=["seq", "entry"])

    def run(batches):
        held = []
        for batch in batches:
            for r in batch.to_pylist():
                if held and held[0]["bucket"] != r["bucket"]:
                    yield from settle(held)
                    held = []
                held.append(r)
        if held:
            yield from settle(held)

    return run


def _spans(entries: np.ndarray, n: int, v: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """What the widely tied cover places of one document of n bytes cover."""
    p = entries[entries & 1 > 0] >> 2
    return np.maximum(p - v, 0), np.minimum(p + v + width, n)


def _open_suffixes(length: int, q: int, buckets: int):
    v, _ = difference_cover(q)
    width = length - v + 1

    def run(batches):
        out, size = _Buckets(buckets), 0
        for batch in batches:
            seqs = batch.column(0).to_numpy()
            entries = batch.column(2)
            for row, raw, bounds in slices(batch, "body"):
                n, parts = np.diff(bounds), []
                for i in range(len(n)):
                    own = entries[row + i].values.to_numpy()
                    p = own[own & 2 > 0] >> 2
                    starts = np.flatnonzero(covered(np.maximum(p - v + 1, 0), np.minimum(p, n[i] - length) + 1, int(n[i])))
                    lo, hi = _spans(own, int(n[i]), v, width)
                    inside = np.concatenate([[0], np.cumsum(covered(lo, hi, int(n[i])))])
                    wanted = inside[starts + length] - inside[starts] < length
                    places = np.zeros(len(starts), _PLACE)
                    places["seq"], places["pos"] = seqs[row + i], starts | np.where(wanted, _WANTED, 0)
                    parts.append((starts + bounds[i], places))
                at = np.concatenate([s for s, _ in parts])
                one, two = (mix(Rolling(raw, k).window(at, at + length)) for k in (0, 1))
                out.add(one, two >> U64(32), one, np.concatenate([x for _, x in parts]))
                size += 8 * len(at)
                if size >= FLUSH_BYTES:
                    yield from out.flush()
                    size = 0
        if out.parts:
            yield from out.flush()

    return run


def _cut(keep_n: int, length: int, q: int):
    v, _ = difference_cover(q)
    width = length - v + 1
    names = [f"k{i}" for i in range(keep_n)]

    def run(batches):
        for batch in batches:
            column = {c: batch.column(batch.schema.get_field_index(c)) for c in ("entries", "more")}
            for row, raw, bounds in slices(batch, "body"):
                data, n = raw.tobytes(), np.diff(bounds)
                kept, removed, spans = [], [], []
                for i in range(len(n)):
                    size = int(n[i])
                    ties, more = (column[c][row + i] for c in ("entries", "more"))
                    own = data[bounds[i]:bounds[i + 1]]
                    if not ties.is_valid:                       # nothing of it ties even narrowly
                        kept.append(own)
                        removed.append(0)
                        spans.append([])
                        continue
                    lo, hi = _spans(ties.values.to_numpy(), size, v, width)
                    p = more.values.to_numpy() >> 2 if more.is_valid else np.zeros(0, np.int64)
                    gone = covered(np.concatenate([lo, p]), np.concatenate([hi, p + length]), size)
                    kept.append(np.frombuffer(own, np.uint8)[~gone].tobytes())
                    removed.append(int(gone.sum()))
                    spans.append(np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))))
                part = batch.slice(row, len(n))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:keep_n], pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.list_(pa.int64())), pa.array(kept, pa.binary())],
                    names=[*names, "n_bytes", "n_removed", "spans", "kept"])

    return run


def dedup(docs: DataFrame, text: str = "text", keep: list[str] | None = None, length: int = LENGTH, q: int = COVER_Q) -> DataFrame:
    """The rows of ``docs`` (columns ``keep``) with ``n_bytes``, ``n_removed``, ``spans`` (removed runs as start, end, start, end ...) and ``kept`` (bytes).

    Strings are judged on the input.  A null text counts as empty; texts shorter than ``length`` keep all
    their bytes.  Every row is a document of its own: rows that repeat, with one doc_id or none, are copies
    of each other.  An empty table gives an empty table.  A text may have up to 512 MB (places have 29 bits).
    """
    spark = docs.sparkSession
    keep = columns_to_keep(docs, keep, ["n_bytes", "n_removed", "spans", "kept"])
    if length - difference_cover(q)[0] < 1:
        raise ValueError("the difference cover must be shorter than the strings")
    body = F.col(f"`{text}`").cast("string")
    rows = stage(docs.select(F.monotonically_increasing_id().alias("seq"), body.alias("body"), *[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)]), "rows")
    total = rows.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    buckets = max(MIN_BUCKETS, total // BUCKET_BYTES)

    def sorted_by_bucket(suffixes, cover):
        return suffixes.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(tidy(_sort_buckets(cover)), "seq long, entry long")

    def by_document(places, name):
        return places.groupBy("seq").agg(F.collect_list("entry").alias(name))

    long_enough = rows.where(F.octet_length("body") >= length)
    entries = stage(by_document(sorted_by_bucket(
        long_enough.select("seq", "body").mapInArrow(tidy(_cover_suffixes(length, q, buckets)), _BUCKET_SCHEMA), True), "entries"), "ties")
    release(spark)
    undecided = entries.where(F.exists("entries", lambda e: e.bitwiseAND(2) > 0))
    more = stage(by_document(sorted_by_bucket(
        long_enough.select("seq", "body").join(undecided, "seq").select("seq", "body", "entries")
        .mapInArrow(tidy(_open_suffixes(length, q, buckets)), _BUCKET_SCHEMA), False), "more"), "ends")
    release(spark)
    names = [f"k{i}" for i in range(len(keep))]
    types = [rows.schema[n].dataType.simpleString() for n in names]
    out = (rows.join(entries, "seq", "left").join(more, "seq", "left").select(*names, "body", "entries", "more")
           .mapInArrow(tidy(_cut(len(keep), length, q)), "".join(f"{n} {t}, " for n, t in zip(names, types, strict=True)) + "n_bytes long, n_removed long, spans array<long>, kept binary"))
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, keep, strict=True)], "n_bytes", "n_removed", "spans", "kept")


def digests(docs: DataFrame) -> DataFrame:
    return dedup(docs, keep=["doc_id"]).select("doc_id", "n_bytes", "n_removed", F.expr("CAST(size(spans) DIV 2 AS BIGINT)").alias("n_spans"),
                                               F.sha2("kept", 256).alias("kept_sha256"))
