"""Substring dedup with suffix automata of reference shards.

A window of ``window`` words is removed from a document when a document with a smaller
doc_id holds the same words.  Anchors (16-word grams, the least hash among the grams of
each window) occur at the same place of equal windows.  The first document that holds
an anchor is its reference; reference passages are cut into shards of ``SHARD_WORDS``
words of one document, so an automaton has a fixed size.  Every other document with an
anchor of a shard is streamed through the shard's suffix automaton around its anchors;
matching statistics of ``window`` or more mark words.  A shard that very many documents
share is copied to several tasks, each with a part of the documents.

Windows around an anchor that its reference doesn't hold may still occur in yet another
document.  These are keyed whole, and the second round streams them through automata of
their own first holders, which settles every window.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import columns_to_keep, release, stage
from .text import Rolling, canonical, covered, mix, slices, tidy, winnow, word_hashes, word_spans

WINDOW = 50
GRAM = 16
SHARD_WORDS = 256
#: Anchors of one shard that go to one copy of its automaton.
SHARE = 200
NO_ID = (1 << 63) - 1


class SuffixAutomaton:
    """Suffix automaton of one sequence of word hashes."""

    def __init__(self, words: list[int]):
        self.next, self.link, self.length = [{}], [-1], [0]
        nxt, link, length, last = self.next, self.link, self.length, 0
        for c in words:
            cur = len(nxt)
            nxt.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p != -1 and c not in nxt[p]:
                nxt[p][c] = cur
                p = link[p]
            if p != -1:
                q = nxt[p][c]
                if length[p] + 1 == length[q]:
                    link[cur] = q
                else:
                    clone = len(nxt)
                    nxt.append(nxt[q].copy())
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p != -1 and nxt[p].get(c) == q:
                        nxt[p][c] = clone
                        p = link[p]
                    link[q] = link[cur] = clone
            last = cur

    def matches(self, words: list[int], least: int) -> list[int]:
        """Places t where the longest match that ends with word t has ``least`` words or more."""
        nxt, link, length, state, size, out = self.next, self.link, self.length, 0, 0, []
        for t, c in enumerate(words):
            if c in nxt[state]:
                state = nxt[state][c]
                size += 1
            else:
                while state != -1 and c not in nxt[state]:
                    state = link[state]
                if state == -1:
                    state = size = 0
                else:
                    size = length[state] + 1
                    state = nxt[state][c]
            if size >= least:
                out.append(t)
        return out


def _keyed(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """k0.. (the columns to keep), id, seq (the number of the row, tells rows of one id apart), body."""
    return docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)],
                       F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"),
                       F.monotonically_increasing_id().alias("seq"), F.col(f"`{text}`").cast("string").alias("body"))


def _anchors(window: int, gram: int):
    def run(batches):
        for batch in batches:
            for row, raw, bounds in slices(batch, "body"):
                starts, ends, first = word_spans(raw, bounds)
                words = word_hashes(raw, starts, ends)
                grams = mix(Rolling(words).every(gram))
                at = winnow(grams, window - gram + 1, first, gram)
                doc = np.searchsorted(first, at, "right") - 1
                part = batch.slice(row, len(bounds) - 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grams[at].view(np.int64)), part.column(0).take(pa.array(doc)), part.column(1).take(pa.array(doc)), pa.array((at - first[doc]).astype(np.int32))],
                    names=["anchor", "id", "seq", "pos"])

    return run


def _entries(anchors: DataFrame) -> DataFrame:
    """(id, seq, entries) of every document with an anchor that documents of different ids hold.

    An entry is the anchor's place, its reference shard and the number of copies of that shard.
    """
    place = F.struct("id", "seq", "pos")
    classes = (anchors.groupBy("anchor").agg(F.min(place).alias("ref"), F.max("id").alias("top"), F.count(F.lit(1)).alias("n")).where("ref.id < top")
               .select("anchor", "ref", "n", F.struct("ref.id", "ref.seq", F.floor(F.col("ref.pos") / SHARD_WORDS).cast("int").alias("block")).alias("shard")))
    classes = stage(classes, "classes")
    copies = classes.groupBy("shard").agg(F.ceil(F.sum("n") / SHARE).cast("int").alias("copies"))
    live = classes.join(copies, "shard").select("anchor", "ref", "shard", "copies")
    return (anchors.join(live, "anchor")
            .select("id", "seq", F.struct("pos", F.col("shard.id").alias("r"), F.col("shard.seq").alias("rs"), F.col("shard.block").alias("block"), "copies",
                                          (F.struct("id", "seq", "pos") == F.col("ref")).alias("is_ref")).alias("e"))
            .groupBy("id", "seq").agg(F.collect_list("e").alias("entries")))


def _passages(words: np.ndarray, entries: list[dict], id_: int, seq: int, window: int, gram: int):
    """Reference passages (kind 2, one per copy) and query runs (kind 3) of one document."""
    reach, n = window - gram, len(words)
    refs, queries = {}, {}
    for e in entries:
        if e["is_ref"]:
            refs[e["block"]] = e["copies"]
        else:
            queries.setdefault((e["r"], e["rs"], e["block"], e["copies"]), set()).add(e["pos"])
    for block, copies in refs.items():
        lo, hi = max(0, block * SHARD_WORDS - reach), min(n, (block + 1) * SHARD_WORDS + window)
        passage = words[lo:hi].tobytes()
        for copy in range(copies):
            yield 2, id_, seq, block, copy, id_, seq, lo, passage
    for (r, rs, block, copies), places in queries.items():
        copy = (id_ * 31 + seq) % copies
        lo = hi = None                                     # window starts of the run so far
        for p in [*sorted(places), None]:
            if p is not None and hi is not None and p - reach <= hi + 1:
                hi = p
                continue
            if hi is not None:
                begin, end = max(0, lo), min(n, hi + window)
                if end - begin >= window:
                    yield 3, r, rs, block, copy, id_, seq, begin, words[begin:end].tobytes()
            if p is not None:
                lo, hi = p - reach, p


_PASSAGE = ["r", "rs", "block", "copy", "id", "seq", "start", "words"]
_PASSAGE_TYPES = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
_PASSAGE_SCHEMA = "r long, rs long, block int, copy int, id long, seq long, start int, words binary"


def _spread(keep_n: int, window: int, gram: int, with_text: bool, rejoin: bool = True):
    """From documents with their entries: their text (kind 0 without entries, 1 with), and passages."""
    names = [f"k{i}" for i in range(keep_n)]

    def run(batches):
        for batch in batches:
            entries_col = batch.column(batch.schema.get_field_index("entries"))
            ids, seqs = (batch.column(batch.schema.get_field_index(c)) for c in ("id", "seq"))
            for row, raw, bounds in slices(batch, "body"):
                n = len(bounds) - 1
                part = batch.slice(row, n)
                text, starts, ends, first = canonical(raw, bounds)
                entries = entries_col.slice(row, n)
                has = entries.is_valid().to_numpy(zero_copy_only=False)
                out = []
                if has.any():
                    words = word_hashes(text, starts, ends)
                    for i in np.flatnonzero(has).tolist():
                        out += _passages(words[first[i]:first[i + 1]], entries[i].as_py(), ids[row + i].as_py(), seqs[row + i].as_py(), window, gram)
                columns = [list(c) for c in zip(*out, strict=True)] if out else [[] for _ in range(9)]
                if with_text:
                    data = text.tobytes() if rejoin else raw.tobytes()
                    texts = ([data[starts[a]:ends[b - 1]] if b > a else b"" for a, b in zip(first[:-1], first[1:], strict=True)] if rejoin
                             else [data[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)])
                    empty = [pa.nulls(n, t) for t in _PASSAGE_TYPES]
                    empty[4], empty[5] = part.column(batch.schema.get_field_index("id")), part.column(batch.schema.get_field_index("seq"))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(has.astype(np.int32)), *part.columns[:keep_n], pa.array(np.diff(first)), pa.array(texts, pa.binary()).cast(pa.string()), *empty],
                        names=["kind", *names, "n_words", "body", *_PASSAGE])
                m = len(columns[0])
                for a in range(0, m, 5000):
                    b = min(a + 5000, m)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(columns[0][a:b], pa.int32()),
                         *([pa.nulls(b - a, batch.schema.field(i).type) for i in range(keep_n)] + [pa.nulls(b - a, pa.int64()), pa.nulls(b - a, pa.string())] if with_text else []),
                         *[pa.array(c[a:b], t) for c, t in zip(columns[1:], _PASSAGE_TYPES, strict=True)]],
                        names=["kind", *([*names, "n_words", "body"] if with_text else []), *_PASSAGE])

    return run


def _stream(window: int):
    """Rows sorted by shard copy, the reference first: hit runs of words (kind 0) and unmatched windows (kind 1)."""

    def run(batches):
        shard, automaton = None, None
        for batch in (b.slice(a, 500) for b in batches for a in range(0, len(b), 500)):
            runs, missed = [], []
            for kind, *key, id_, seq, start, words in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tokens = np.frombuffer(words, np.uint64)
                if kind == 2:
                    if key != shard:
                        shard, automaton = key, SuffixAutomaton(tokens.tolist())
                    continue
                ends = np.array(automaton.matches(tokens.tolist(), window), np.int64) if key == shard else np.zeros(0, np.int64)
                hit = np.zeros(len(tokens) - window + 1, bool)
                hit[ends - window + 1] = True
                if id_ > key[0] and len(ends):
                    inside = covered(ends - window + 1, ends + 1, len(tokens))
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], inside.astype(np.int8), [0]])))
                    runs += [(id_, seq, start + s, start + e) for s, e in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)]
                left = np.flatnonzero(~hit)
                if len(left):
                    missed.append((mix(Rolling(tokens).every(window))[left].view(np.int64), id_, seq, start + left))
            n = len(runs)
            if n:
                i, g, s, e = zip(*runs, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array([0] * n, pa.int32()), pa.nulls(n, pa.int64()), pa.array(i, pa.int64()), pa.array(g, pa.int64()), pa.array(s, pa.int32()), pa.array(e, pa.int32())],
                                                 names=["kind", "anchor", "id", "seq", "pos", "stop"])
            if missed:
                keys, i, g, p = zip(*missed, strict=True)
                sizes = [len(k) for k in keys]
                n = sum(sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ones(n, np.int32)), pa.array(np.concatenate(keys)), pa.array(np.repeat(np.array(i, np.int64), sizes)), pa.array(np.repeat(np.array(g, np.int64), sizes)),
                     pa.array(np.concatenate(p).astype(np.int32)), pa.nulls(n, pa.int32())], names=["kind", "anchor", "id", "seq", "pos", "stop"])

    return run


def _streamed(passages: DataFrame, window: int) -> DataFrame:
    shard = ["r", "rs", "block", "copy"]
    return (passages.select("kind", *_PASSAGE).repartition(*shard).sortWithinPartitions(*shard, "kind")
            .mapInArrow(tidy(_stream(window)), "kind int, anchor long, id long, seq long, pos int, stop int"))


def _cut(keep_n: int, rejoin: bool = True):
    """Texts with their hit runs: what is left of them."""
    names = [f"k{i}" for i in range(keep_n)]

    def run(batches):
        for batch in batches:
            spans_col = batch.column(batch.schema.get_field_index("spans"))
            for row, raw, bounds in slices(batch, "body"):
                n = len(bounds) - 1
                part = batch.slice(row, n)
                starts, ends, first = word_spans(raw, bounds)
                begins, stops = [], []
                for i, spans in enumerate(spans_col.slice(row, n).to_pylist()):
                    for s in spans or ():
                        begins.append(first[i] + s["pos"])
                        stops.append(first[i] + s["stop"])
                gone = covered(np.array(begins, np.int64), np.array(stops, np.int64), len(starts))
                total = np.concatenate([[0], np.cumsum(gone)])
                data = raw.tobytes()
                texts = []
                for a, b in zip(first[:-1], first[1:], strict=True):
                    if not rejoin and total[b] == total[a]:
                        texts.append(data[bounds[len(texts)]:bounds[len(texts) + 1]])
                        continue
                    left = np.flatnonzero(~gone[a:b]) + a
                    texts.append(b" ".join([data[s:e] for s, e in zip(starts[left].tolist(), ends[left].tolist(), strict=True)]))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:keep_n], part.column(batch.schema.get_field_index("n_words")), pa.array(total[first[1:]] - total[first[:-1]], pa.int64()), pa.array(texts, pa.binary()).cast(pa.string())],
                    names=[*names, "n_words", "n_removed", "kept_text"])

    return run


def dedup(docs: DataFrame, text: str = "text", keep: list[str] | None = None, window: int = WINDOW, gram: int = GRAM,
          rejoin: bool = True) -> DataFrame:
    """The rows of ``docs`` (columns ``keep``) with ``n_words``, ``n_removed`` and ``kept_text`` (kept words, joined by one space).

    Without ``rejoin``, texts that lose nothing stay as they are (null: empty), with all their blanks.

    Windows are judged on the input.  Null and empty texts have no words; texts shorter than a window
    keep all of theirs.  A null doc_id comes after every other.  Rows of one doc_id never remove words
    from each other, whether their texts are the same or not.  An empty table gives an empty table.
    """
    keep = columns_to_keep(docs, keep, ["n_words", "n_removed", "kept_text"])
    rows = stage(_keyed(docs, text, keep), "rows")
    types = [f.dataType.simpleString() for f in rows.schema.fields[:len(keep)]]
    kept_schema = "".join(f"k{i} {t}, " for i, t in enumerate(types))
    anchors = stage(rows.select("id", "seq", "body").mapInArrow(tidy(_anchors(window, gram)), "anchor long, id long, seq long, pos int"), "anchors")
    spread = stage(rows.join(_entries(anchors), ["id", "seq"], "left").select(*[f"k{i}" for i in range(len(keep))], "id", "seq", "body", "entries")
                   .mapInArrow(tidy(_spread(len(keep), window, gram, True, rejoin)), f"kind int, {kept_schema}n_words long, body string, {_PASSAGE_SCHEMA}"), "passages")
    release(docs.sparkSession)
    first = stage(_streamed(spread.where("kind >= 2"), window), "matches")
    missed = first.where("kind = 1").select("anchor", "id", "seq", "pos").distinct()
    second = (spread.where("kind = 1").select("id", "seq", "body").join(_entries(missed), ["id", "seq"])
              .mapInArrow(tidy(_spread(0, window, window, False)), f"kind int, {_PASSAGE_SCHEMA}"))
    hits = first.where("kind = 0").union(_streamed(second, window).where("kind = 0"))
    spans = hits.groupBy("id", "seq").agg(F.collect_set(F.struct("pos", "stop")).alias("spans"))
    names = [f"k{i}" for i in range(len(keep))]
    cut = (spread.where("kind = 1").select(*names, "n_words", "body", "id", "seq").join(spans, ["id", "seq"], "left").select(*names, "n_words", "body", "spans")
           .mapInArrow(tidy(_cut(len(keep), rejoin)), f"{kept_schema}n_words long, n_removed long, kept_text string"))
    clean = spread.where("kind = 0").select(*names, "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("body").alias("kept_text"))
    return clean.union(cut).select(*[F.col(n).alias(c) for n, c in zip(names, keep, strict=True)], "n_words", "n_removed", "kept_text")


def digests(docs: DataFrame) -> DataFrame:
    return dedup(docs, keep=["doc_id"]).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
