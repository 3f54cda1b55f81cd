"""MinHash near-duplicates with circulant signatures and exact verification.

A shingle's hash is a point of a circle of 2^32 places: the first permutation puts it there.  The second
permutation orders the places; signature coordinate k is the least rank among a document's
points after the circle was shifted by k.  So two permutations, not K, give K = 128 coordinates.  Four
successive coordinates (16 bits of each) make a band key of 64 bits, and documents that share a band
key are candidates.  At a similarity of 0.8 a pair shares none of its 32 bands with a probability of
(1 - 0.8^4)^32, less than 5 in 10^8, and is as a rule linked through others as well.

Documents with equal shingle sets are one class; only classes go on.  Links are confirmed on the full
sets, in two steps that never write all pairs of a group:

1. In every band group the members are compared with one of them, the pivot: first within each task's own
   groups, then among the pivots that the tasks report.  Confirmed links join classes to components.
2. Groups that still hold more than one component are gone through again, and pairs of different
   components that may link (sizes and signatures allow it) are confirmed where they meet, each in the group of the
   first band that it shares.  First the signatures alone tell which members have such a pair; only those send
   their texts, and only links come back, so rows grow with the members, not with their pairs.  A group of more than
   ``BLOCK`` classes is dealt in blocks whose pairs are compared by separate tasks; what is one component already
   isn't compared with itself.

Sets travel as texts.  In the first step one text of each pair goes to the pivot's task, and a pivot of many
pairs is copied to as many tasks as it needs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import columns_to_keep, connected, stage
from .text import U64, Rolling, bytes_of, canonical, mix, slices, tidy, word_hashes

SHINGLE = 4
#: Links have 100 * |intersection| >= SIMILARITY * |union|.
SIMILARITY = 80
ROWS, BANDS = 4, 32
#: Coordinates of 128 that agree where similarity is 0.8: 102 on average, fewer than 64 with a probability below 10^-14.
AGREE = 64
#: Classes whose band groups a task looks through at once; members of a block of a large group, and their shingles.
CHUNK, BLOCK, BLOCK_SHINGLES = 32_768, 4_096, 2_000_000
#: Pairs of one pivot that a task confirms.
SHARE = 1_000


def shingle_sets(raw: np.ndarray, bounds: np.ndarray, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): the sorted distinct shingle hashes of each document of a slice, end to end."""
    text, starts, ends, first = canonical(raw, bounds, lower=True)
    n_words = np.diff(first)
    count = np.where(n_words >= shingle, n_words - shingle + 1, np.minimum(n_words, 1))
    offset = np.concatenate([[0], np.cumsum(count)])
    doc = np.repeat(np.arange(len(count)), count)
    begin = np.arange(offset[-1]) - offset[doc] + first[doc]
    h = mix(Rolling(word_hashes(text, starts, ends), 1).window(begin, np.minimum(begin + shingle, first[doc + 1])))
    for a, b in zip(offset[:-1].tolist(), offset[1:].tolist(), strict=True):
        h[a:b].sort()
    fresh = np.ones(len(h), bool)
    fresh[1:] = h[1:] != h[:-1]
    fresh[offset[:-1][count > 0]] = True
    kept = np.concatenate([[0], np.cumsum(fresh)])
    return h[fresh], kept[offset]


def _order(x: np.ndarray) -> np.ndarray:
    """The second permutation: the rank of each place of the circle (in place)."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def signatures(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """[document, coordinate]: 16 bits of each coordinate; an empty set has zeros."""
    points = (mix(h * U64(0x9E3779B97F4A7C15) + U64(1)) >> U64(32)).astype(np.uint32)
    out = np.zeros((len(first) - 1, ROWS * BANDS), np.uint16)
    some = np.flatnonzero(np.diff(first))
    if len(some):
        for k in range(ROWS * BANDS):
            least = np.minimum.reduceat(_order(points + np.uint32(k)), first[some])
            out[some, k] = least & np.uint32(0xFFFF)
    return out


def set_rows(texts: DataFrame, shingle: int) -> DataFrame:
    """(seq, n, key, sig) of (seq, text): set size, a 128-bit hash of the set, and the signature."""

    def run(batches):
        for batch in batches:
            for row, raw, bounds in slices(batch, "text"):
                h, first = shingle_sets(raw, bounds, shingle)
                key = np.zeros((len(bounds) - 1, 2), U64)
                some = np.flatnonzero(np.diff(first))
                if len(some):
                    for i, salt in enumerate((0xA24BAED4963EE407, 0x9FB21C651E98DF25)):
                        key[some, i] = np.add.reduceat(mix(h ^ U64(salt)), first[some])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(key)), pa.array(np.diff(first)), _fixed(key), _fixed(signatures(h, first))], names=["seq", "n", "key", "sig"])

    return texts.mapInArrow(tidy(run), "seq long, n long, key binary, sig binary")


def _fixed(rows: np.ndarray) -> pa.Array:
    size = rows.itemsize * rows.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(np.arange(0, (len(rows) + 1) * size, size, dtype=np.int32)), pa.py_buffer(np.ascontiguousarray(rows))])


def _signature_matrix(column: pa.Array) -> np.ndarray:
    raw, _ = bytes_of(column)
    return raw.view(np.uint16).reshape(len(column), ROWS * BANDS)


def _long_enough(n: np.ndarray, m: np.ndarray, similarity: int) -> np.ndarray:
    return 100 * np.minimum(n, m) >= similarity * np.maximum(n, m)


def _band_keys(sig: np.ndarray) -> np.ndarray:
    """[class, band]: one key for band and coordinates."""
    return mix(sig.view(U64) + np.arange(1, BANDS + 1, dtype=U64) * U64(0x9E3779B97F4A7C15))


def _local_stars(similarity: int):
    """Arrow function over (rep, n, sig): pairs with the pivot of each band group of a chunk
    (kind 0), the pivots by band key (kind 1), and the members of groups of two or more (kind 2), whether or not they may link with the pivot."""

    def chunk(rep, n, sig):
        keys = _band_keys(sig)
        pivots, pairs = [], []
        for band in range(BANDS):
            order = np.lexsort((rep, keys[:, band]))
            k = keys[order, band]
            new = np.concatenate([[True], k[1:] != k[:-1]])
            lead = order[np.flatnonzero(new)]
            pivots.append((keys[lead, band].view(np.int64), rep[lead]))
            rest = np.flatnonzero(~new)
            to = lead[np.cumsum(new) - 1][rest]
            pairs.append(np.stack([to, order[rest]], axis=1))
        pairs = np.unique(np.concatenate(pairs), axis=0)
        met = rep[np.unique(pairs)]
        yield _rows(2, met, met)
        pairs = pairs[_long_enough(n[pairs[:, 0]], n[pairs[:, 1]], similarity)]
        pairs = pairs[_agree(sig[pairs[:, 0]], sig[pairs[:, 1]])]
        yield _rows(0, rep[pairs[:, 0]], rep[pairs[:, 1]])
        for key, lead in pivots:
            yield _rows(1, key, lead)

    def run(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) >= CHUNK:
                yield from close(held)
                held = []
        if held:
            yield from close(held)

    def close(held):
        parts = [b for b in held if len(b)]
        if parts:
            yield from chunk(np.concatenate([b.column(0).to_numpy() for b in parts]), np.concatenate([b.column(1).to_numpy() for b in parts]), np.concatenate([_signature_matrix(b.column(2)) for b in parts]))

    return run


def _agree(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).sum(axis=1) >= AGREE


_STARS = "kind byte, a long, b long"


def _rows(kind: int, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int8)), pa.array(a), pa.array(b)], names=["kind", "a", "b"])


def _global_stars(batches):
    """(a, b) with the first member of each group as a, from (key, rep) sorted by both."""
    key = pivot = None
    for batch in batches:
        k, rep = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(k):
            continue
        new = np.concatenate([[k[0] != key], k[1:] != k[:-1]])
        lead = np.concatenate([[-1 if pivot is None else pivot], rep[new]])[np.cumsum(new)]
        rest = ~new & (lead != rep)
        yield pa.RecordBatch.from_arrays([pa.array(lead[rest]), pa.array(rep[rest])], names=["a", "b"])
        key, pivot = k[-1], lead[-1]


def confirm(pairs: DataFrame, texts: DataFrame, shingle: int, similarity: int) -> DataFrame:
    """Those of the distinct ``pairs`` (a, b) whose full sets link; ``texts`` has (seq, text)."""
    size = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / SHARE).cast("int").alias("copies"))
    members = (pairs.join(size.where("copies > 1"), "a", "left")
               .select(F.col("b").alias("seq"), "a", F.pmod(F.xxhash64("b"), F.coalesce("copies", F.lit(1))).cast("int").alias("copy"), "b"))
    pivots = size.select(F.col("a").alias("seq"), "a", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), F.lit(None).cast("long"))
    sent = members.union(pivots).join(texts.hint("merge"), "seq").select("a", "copy", "b", "text")

    def run(batches):
        held = None, None
        for batch in batches:
            a, copy, none = batch.column(0).to_numpy(), batch.column(1).to_numpy(), np.asarray(batch.column(2).is_null())
            b = batch.column(2).fill_null(-1).to_numpy()
            out = []
            for row, raw, bounds in slices(batch, "text"):
                h, first = shingle_sets(raw, bounds, shingle)
                for i in range(len(bounds) - 1):
                    r, own = row + i, h[first[i]:first[i + 1]]
                    if none[r]:
                        held = (a[r], copy[r]), own.copy()
                    elif held[0] == (a[r], copy[r]):
                        common = np.intersect1d(held[1], own, assume_unique=True).size
                        if common and 100 * common >= similarity * (len(held[1]) + len(own) - common):
                            out.append(r)
            yield pa.RecordBatch.from_arrays([pa.array(a[out]), pa.array(b[out])], names=["a", "b"])

    dealt = sent.repartition("a", "copy").sortWithinPartitions("a", "copy", F.col("b").asc_nulls_first())
    return dealt.mapInArrow(tidy(run), "a long, b long")


def _groups(batches):
    """One batch for each group of rows that agree in the first column, from batches sorted by it."""
    key, held = None, []
    for batch in batches:
        k = batch.column(0).to_numpy()
        if not len(k):
            continue
        cut = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1], [True]]))
        for s, e in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            if k[s] != key:
                if held:
                    yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                key, held = k[s], []
            held.append(batch.slice(s, e - s))
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _candidates(group: pa.RecordBatch, similarity: int):
    """(i, others) of a group (pair, key, side, component, rep, n, sig): pairs of different components that may link and share no earlier band.

    Side 0 is compared with side 1; in a group of side 2 all are compared with one another.  ``component`` is read anew
    for each i, so that links found on the way count.
    """
    side, component, n = group.column(2).to_numpy(), group.column(3).to_numpy().copy(), group.column(5).to_numpy()
    sig = _signature_matrix(group.column(6))
    bands = sig.view(U64)
    band = int(np.flatnonzero(_band_keys(sig[:1])[0] == U64(group.column(1)[0].as_py() & ((1 << 64) - 1)))[0])
    left, right = (np.arange(len(n)),) * 2 if side[0] == 2 else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
    for i in left.tolist():
        other = right[(component[right] != component[i]) & _long_enough(n[right], n[i], similarity)]
        other = other[other > i] if side[0] == 2 else other
        other = other[_agree(sig[other], sig[i])]
        if len(other):
            other = other[~(bands[other, :band] == bands[i, :band]).any(axis=1)]
        if len(other):
            yield component, i, other


def _members_with_pairs(similarity: int):
    """Arrow function over a group's rows (``_candidates``): those members that have a pair to be confirmed."""

    def run(batches):
        for group in _groups(batches):
            met = np.zeros(len(group), bool)
            for _, i, other in _candidates(group, similarity):
                met[i] = True
                met[other] = True
            kept = group.filter(pa.array(met))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1), kept.column(2), kept.column(4)], names=["pair", "key", "side", "rep"])

    return run


def _group_links(shingle: int, similarity: int):
    """Arrow function over a group's rows with their texts: links that join its components."""

    def run(batches):
        for group in _groups(batches):
            parts, ends = [], [np.zeros(1, np.int64)]
            for _, raw, bounds in slices(group, "text"):
                h, first = shingle_sets(raw, bounds, shingle)
                parts.append(h)
                ends.append(first[1:] + ends[-1][-1])
            h, first = np.concatenate(parts), np.concatenate(ends)
            rep, a, b = group.column(4).to_numpy(), [], []
            for component, i, other in _candidates(group, similarity):
                own, sizes = h[first[i]:first[i + 1]], first[other + 1] - first[other]
                theirs = np.concatenate([h[first[j]:first[j + 1]] for j in other.tolist()])
                place = np.minimum(np.searchsorted(own, theirs), len(own) - 1)
                common = np.add.reduceat((own[place] == theirs).astype(np.int64), np.cumsum(sizes) - sizes)
                for j in other[100 * common >= similarity * (len(own) + sizes - common)].tolist():
                    if component[i] != component[j]:
                        a.append(rep[i])
                        b.append(rep[j])
                        component[component == component[j]] = component[i]
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def open_links(sets: DataFrame, texts: DataFrame, component: DataFrame, shingle: int, similarity: int, block: int | None = None) -> DataFrame:
    """Links (a, b) that join what classes in one band group but in different components (``component``: node, root) have in common.

    ``sets`` has the classes' seq, n and sig, ``texts`` seq and text.
    """
    block = BLOCK if block is None else block

    def run(batches):
        for batch in batches:
            sig = _signature_matrix(batch.column(3))
            keys = _band_keys(sig).view(np.int64).ravel() if len(sig) else np.zeros(0, np.int64)
            at = pa.array(np.repeat(np.arange(len(batch)), BANDS))
            yield pa.RecordBatch.from_arrays([pa.array(keys), *(batch.column(c).take(at) for c in (1, 0, 2))], names=["key", "root", "rep", "n"])

    rooted = stage(sets.withColumnRenamed("seq", "rep").join(component.withColumnRenamed("node", "rep"), "rep").select("rep", "root", "n", "sig"), "rooted")
    index = rooted.mapInArrow(tidy(run), "key long, root long, rep long, n long")
    parts = index.groupBy("key", "root").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("n"))
    mixed = stage(parts.groupBy("key").agg(F.count(F.lit(1)).alias("roots"), F.sum("members").alias("members"), F.sum("n").alias("n")).where("roots > 1"), "mixed")
    # a component with more than a block of a group's members has blocks of its own, the others share blocks
    blocks_of = F.greatest(F.ceil(F.col("members") / block), F.ceil(F.col("n") / BLOCK_SHINGLES)).cast("int")
    large = parts.join(mixed, "key", "left_semi").select("key", "root", blocks_of.alias("own")).where("own > 1")
    members = (index.join(mixed.select("key", blocks_of.alias("shared")), "key").join(large, ["key", "root"], "left")
               .select("key", "root", "rep", F.when(F.col("own").isNull(), F.pmod(F.xxhash64("root", F.lit(1)), "shared"))
                       .otherwise(F.pmod(F.xxhash64("rep"), "own")).cast("int").alias("part"), F.when(F.col("own").isNotNull(), F.col("root")).otherwise(-1).alias("alone")))
    members = stage(members, "members")
    blocks = members.select("key", "alone", "part").distinct()
    one, two = (blocks.select("key", F.struct("alone", "part").alias(c)) for c in "xy")
    meet = one.join(two, "key").where("x < y AND (x.alone < 0 OR x.alone <> y.alone) OR x = y AND x.alone < 0")
    pair = F.xxhash64("key", "x", "y")
    sides = (meet.where("x <> y").select("key", pair.alias("pair"), F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("x").alias("b")), F.struct(F.lit(1).alias("side"), F.col("y").alias("b")))).alias("s"))
             .union(meet.where("x = y").select("key", pair.alias("pair"), F.struct(F.lit(2).alias("side"), F.col("x").alias("b")).alias("s"))))
    sides = sides.select("key", "pair", "s.side", "s.b.alone", "s.b.part")
    dealt = members.join(sides, ["key", "alone", "part"]).select("pair", "key", "side", "rep")
    group = ["pair", "key", "side", "root", "rep", "n", "sig"]
    asked = dealt.join(rooted, "rep").select(*group).repartition("pair").sortWithinPartitions("pair")
    needed = stage(asked.mapInArrow(tidy(_members_with_pairs(similarity)), "pair long, key long, side int, rep long"), "needed")
    full = needed.join(rooted, "rep").join(texts.withColumnRenamed("seq", "rep").hint("merge"), "rep").select(*group, "text").repartition("pair").sortWithinPartitions("pair")
    return full.mapInArrow(tidy(_group_links(shingle, similarity)), "a long, b long")


def components(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", keep: list[str] | None = None, *, shingle: int = SHINGLE, similarity: int = SIMILARITY) -> DataFrame:
    """The kept columns (all by default), n_shingles and component_id of every row: the least doc_id that links reach, the own one included.

    A null, empty or wordless text has no shingles and no links.  Repeated rows come back as often as they
    came.  A null doc_id takes part in linking but names a component only if that has no other id (component_id is null then).
    Columns named n_shingles or component_id give way.  An empty table gives an empty table.
    The bands are laid out for similarities of 80 in 100 or more; less is an error.
    """
    if similarity < 80:
        raise ValueError("the bands find similarities of 80 in 100 or more")
    keep = columns_to_keep(docs, keep, ["n_shingles", "component_id"])
    rows = stage(docs.select(F.struct(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)]).alias("row"), F.col(f"`{doc_id}`").alias("id"),
                             F.col(f"`{text}`").cast("string").alias("text"), F.monotonically_increasing_id().alias("seq")), "documents")
    sets = stage(set_rows(rows.select("seq", "text"), shingle), "sets")
    some = sets.where("n > 0")
    # classes of equal sets: the copy with the least number stands for all
    rep_of = stage(some.groupBy("key").agg(F.min("seq").alias("rep")), "classes")
    reps = some.join(rep_of.select(F.col("rep").alias("seq")), "seq", "left_semi").select(F.col("seq").alias("rep"), "n", "sig")
    stars = stage(reps.mapInArrow(tidy(_local_stars(similarity)), _STARS), "stars")
    leads = stars.where("kind = 1").select(F.col("a").alias("key"), F.col("b").alias("rep"))
    across = leads.repartition("key").sortWithinPartitions("key", "rep").mapInArrow(tidy(_global_stars), "a long, b long")
    pairs = stage(stars.where("kind = 0").select("a", "b").union(across).distinct(), "pairs")
    seen = stage(pairs.select(F.explode(F.array("a", "b")).alias("node")).union(stars.where("kind = 2").select("a")).distinct(), "seen")
    # all texts are shuffled once, for the members of groups; what follows moves only those
    texts = stage(rows.select("seq", "text").join(seen.select(F.col("node").alias("seq")).hint("merge"), "seq"), "texts")
    links = stage(confirm(pairs, texts, shingle, similarity), "links")
    roots = stage(seen.join(connected(links), "node", "left").select("node", F.coalesce("root", "node").alias("root")), "roots")
    more = open_links(some.select("seq", "n", "sig"), texts, roots, shingle, similarity)
    names = [roots.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}")) for c in "ab"]
    joined = connected(more.join(names[0], "a").join(names[1], "b").select(F.col("root_a").alias("a"), F.col("root_b").alias("b")))
    last = roots.join(joined.select(F.col("node").alias("root"), F.col("root").alias("r")), "root", "left").select("node", F.coalesce("r", "root").alias("root"))
    rooted = rep_of.join(last.withColumnRenamed("node", "rep"), "rep", "left").select("key", F.coalesce("root", "rep").alias("root"))
    by_set = some.select("seq", "n", "key").join(rooted, "key").select("seq", "n", "root").union(sets.where("n = 0").select("seq", "n", F.lit(None).cast("long")))
    by_row = stage(by_set.join(rows.select("seq", "row", "id"), "seq"), "by_row")
    least = by_row.where("root IS NOT NULL").groupBy("root").agg(F.min("id").alias("least"))
    return by_row.join(least, "root", "left").select(*[F.col(f"row.k{i}").alias(c) for i, c in enumerate(keep)], F.col("n").alias("n_shingles"),
                                                     F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("least")).alias("component_id"))


def digests(docs: DataFrame) -> DataFrame:
    return components(docs, keep=["doc_id"]).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
