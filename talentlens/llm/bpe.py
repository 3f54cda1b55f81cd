"""Byte-level BPE encoding and decoding by corpus-level merge replay.

The corpus is replayed block by block.  The distinct pre-tokens of a block that
have not been met before are laid end to end as one sequence of byte tokens; an
inverted index holds, for every merge that applies somewhere, the positions
where it does.  Merges are taken in rank order from a heap; each one is applied
at all its positions and only the pairs left and right of a touched position are
looked up anew.  Every pre-token ends up with the ids that merging it alone, the
lowest rank first and leftmost first, would give.

The vocabulary is a rank file; its path is a parameter, its content is broadcast
(a fixed file of some hundred kilobytes, however large the corpus is).  No
special tokens are known to encoding.
"""

from __future__ import annotations

import base64
import functools
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import columns_to_keep
from .text import tidy

#: Distinct pre-tokens that a worker remembers between blocks, in each of two generations.
CACHE_WORDS = 400_000
#: Characters of text, and new pre-tokens, replayed together.
BLOCK_CHARS = 1 << 20
BLOCK_WORDS = 40_000
#: Documents whose texts and ids are held as Python objects at once.
BATCH_ROWS = 256


class MergeReplay:
    def __init__(self, rank_lines: bytes, pattern: str):
        pairs = [line.split() for line in rank_lines.splitlines() if line]
        ranks = {base64.b64decode(a): int(b) for a, b in pairs}
        self.pattern, self.ranks = pattern, ranks
        self.byte_ids = [ranks[bytes([b])] for b in range(256)]
        size = max(ranks.values()) + 1
        self.tokens = [b""] * size
        for token, r in ranks.items():
            self.tokens[r] = token
        self.shift = size.bit_length()
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @functools.cached_property
    def find(self):
        import regex

        return regex.compile(self.pattern).findall

    @functools.cached_property
    def merges(self) -> dict[int, int]:
        """Merged id by pair of ids: every way to cut a token into two tokens."""
        out, get = {}, self.ranks.get
        for token, r in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = get(token[:cut]), get(token[cut:])
                if a is not None and b is not None:
                    out[a << self.shift | b] = r
        return out

    @functools.cached_property
    def first_merges(self) -> np.ndarray:
        """Rank of every pair of bytes, or -1; 256 stands for the fence between words."""
        table = np.full((257, 257), -1, np.int32)
        for a in range(256):
            for b in range(256):
                table[a, b] = self.ranks.get(bytes([a, b]), -1)
        return table

    def learn(self, words: list[str]) -> None:
        """Replay the merges over all ``words`` at once and remember their ids as little-endian bytes."""
        get, shift = self.merges.get, self.shift
        raw = [w.encode() for w in words]
        for w, r in zip(words, raw, strict=True):
            if r in self.ranks:                  # a word that is a token stays whole
                self.known[w] = self.ranks[r].to_bytes(4, "little")
        rest = [x for x in zip(words, raw, strict=True) if x[0] not in self.known]
        if not rest:
            return
        words, raw = zip(*rest, strict=True)
        sizes = np.array([len(r) + 1 for r in raw], np.int64)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        seen = np.full(int(bounds[-1]), 256, np.int32)           # bytes, a fence after each word
        inside = np.ones(len(seen), bool)
        inside[bounds[1:] - 1] = False
        seen[inside] = np.frombuffer(b"".join(raw), np.uint8)
        ids = np.where(inside, np.array([*self.byte_ids, -1], np.int64)[seen], -1).tolist()
        n = len(ids)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        rank_at = self.first_merges[seen[:-1], seen[1:]]
        at = np.flatnonzero(rank_at >= 0)
        at = at[np.argsort(rank_at[at], kind="stable")]
        ranks, cut = np.unique(rank_at[at], return_index=True)
        index = {r: p.tolist() for r, p in zip(ranks.tolist(), np.split(at, cut[1:]), strict=True)} if len(at) else {}
        merge_at = [*rank_at.tolist(), -1]       # the merge that applies to a token and the one after it
        heap = list(index)
        heapq.heapify(heap)
        while heap:
            rank = heapq.heappop(heap)
            places = index.pop(rank)
            places.sort()
            held = -1                            # up to here an earlier merge goes first in this word
            again: list[int] = []
            for i in places:
                if merge_at[i] != rank:          # gone, or merged with another neighbour
                    continue
                if i < held:
                    again.append(i)
                    continue
                j = after[i]
                k = after[j]
                ids[i] = rank
                ids[j] = -2                      # gone
                merge_at[j] = -1
                after[i] = k
                before[k] = i
                c = ids[k]
                r = get(rank << shift | c) if c >= 0 else None
                if r is None:
                    merge_at[i] = -1
                else:
                    merge_at[i] = r
                    if r in index:
                        index[r].append(i)
                    else:
                        index[r] = [i]
                        heapq.heappush(heap, r)
                    if r < rank:
                        held = ids.index(-1, i)
                h = before[i]                    # before the first token: the last fence
                c = ids[h]
                if c >= 0:
                    r = get(c << shift | rank)
                    if r is None:
                        merge_at[h] = -1
                    else:
                        merge_at[h] = r
                        if r in index:
                            index[r].append(h)
                        else:
                            index[r] = [h]
                            heapq.heappush(heap, r)
                        if r < rank:
                            held = ids.index(-1, i)
            if again:
                if rank in index:
                    index[rank] += again
                else:
                    index[rank] = again
                    heapq.heappush(heap, rank)
        flat = np.array(ids, np.int64)
        live = flat >= 0
        packed = flat[live].astype("<u4").tobytes()
        ends = np.concatenate([[0], np.cumsum(live)])[bounds] * 4
        for w, s, e in zip(words, ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            self.known[w] = packed[s:e]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text as little-endian unsigned 32-bit integers."""
        known, out, at = self.known, [], 0
        while at < len(texts):
            size, end = 0, at
            while end < len(texts) and (end == at or size + len(texts[end]) <= BLOCK_CHARS):
                size += len(texts[end])
                end += 1
            split = [self.find(t) for t in texts[at:end]]
            if len(known) > CACHE_WORDS:
                self.older, self.known = known, {}
                known = self.known
            older = self.older
            fresh = []
            for w in {w for words in split for w in words}:
                if w not in known:
                    if w in older:
                        known[w] = older[w]
                    else:
                        fresh.append(w)
            for a in range(0, len(fresh), BLOCK_WORDS):
                self.learn(fresh[a:a + BLOCK_WORDS])
            look = known.__getitem__
            out += [b"".join(map(look, words)) for words in split]
            at = end
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@functools.lru_cache(maxsize=4)
def replay_of(rank_lines: bytes, pattern: str) -> MergeReplay:
    """One replay for each vocabulary in a worker, kept from task to task."""
    return MergeReplay(rank_lines, pattern)


def encode(docs: DataFrame, rank_path: str, pattern: str, text: str = "text", keep: list[str] | None = None, decoded: bool = False) -> DataFrame:
    """The rows of ``docs`` (columns ``keep``) with ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit integers).

    With ``decoded`` they also have the bytes that those ids decode to.  A null text counts as empty and
    has no tokens.  Rows stay as they are: repeated rows are encoded alike, an empty table gives an
    empty table, and no other column is read.
    """
    with open(rank_path, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast((f.read(), pattern))
    new = ["n_tokens", "ids", *(["decoded"] if decoded else [])]
    keep = columns_to_keep(docs, keep, new)
    kept = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], F.col(f"`{text}`").cast("string").alias("bpe_text"))
    names = [f"k{i}" for i in range(len(keep))]

    def run(batches):
        replay = replay_of(*model.value)
        for batch in (b.slice(a, BATCH_ROWS) for b in batches for a in range(0, len(b), BATCH_ROWS)):
            ids = replay.encode(batch.column(len(keep)).fill_null("").to_pylist())
            back = [pa.array([replay.decode(x) for x in ids], pa.binary())] if decoded else []
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keep)], pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()), *back], names=[*names, *new])

    schema = ", ".join([*(f"{n} {kept.schema[i].dataType.simpleString()}" for i, n in enumerate(names)), "n_tokens long, ids binary", *(["decoded binary"] if decoded else [])])
    return kept.mapInArrow(tidy(run), schema).select(*[F.col(n).alias(c) for n, c in zip(names, keep, strict=True)], *new)


def decode(encoded: DataFrame, rank_path: str, pattern: str, ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """The rows of ``encoded`` with ``decoded`` (bytes) in place of the ids; null ids decode to nothing."""
    with open(rank_path, "rb") as f:
        model = encoded.sparkSession.sparkContext.broadcast((f.read(), pattern))
    keep = columns_to_keep(encoded, keep or [c for c in encoded.columns if c != ids], ["decoded"])
    kept = encoded.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], F.col(f"`{ids}`").alias("bpe_ids"))

    def run(batches):
        replay = replay_of(*model.value)
        for batch in (b.slice(a, BATCH_ROWS) for b in batches for a in range(0, len(b), BATCH_ROWS)):
            decoded = [replay.decode(x or b"") for x in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], pa.array(decoded, pa.binary())],
                                             names=[*(f"k{i}" for i in range(len(keep))), "decoded"])

    schema = ", ".join([*(f"k{i} {kept.schema[i].dataType.simpleString()}" for i in range(len(keep))), "decoded binary"])
    return kept.mapInArrow(tidy(run), schema).select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "decoded")


def digests(docs: DataFrame, rank_path: str, pattern: str, text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encoding, and decoding of those ids, of every document."""
    both = encode(docs, rank_path, pattern, text, ["doc_id"], decoded=True)
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
