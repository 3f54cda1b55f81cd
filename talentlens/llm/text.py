"""Vectorised text helpers that run inside Spark tasks.

All functions work on one slice of an Arrow batch: the UTF-8 bytes of its
documents laid end to end, with the start and end of each document.  Nothing
here knows about Spark; the operators call it from ``mapInArrow``.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64


def give_back() -> None:
    """Give freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)              # glibc only
    if trim:
        trim(0)


def tidy(run):
    """An Arrow function that gives the memory it freed back to the system at its end.

    Python workers live on from task to task and stage to stage; what their allocators keep counts
    against the executor all the while.
    """
    def tidied(batches):
        yield from run(batches)
        give_back()

    return tidied


#: Text bytes handled at once; one longer document is handled alone.
SLICE_BYTES = 1 << 20

#: Separators of ``[^\x20\x09-\x0D]+`` words.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
WORD_BYTES = ~SPACES
#: Bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` words, after A-Z became a-z.
ALNUM_BYTES = np.ones(256, bool)
ALNUM_BYTES[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = False
LOWER_AZ = np.arange(256, dtype=np.uint8)
LOWER_AZ[0x41:0x5B] += 0x20

_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def string_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    col = batch.column(batch.schema.get_field_index(name))
    if pa.types.is_null(col.type):
        return pa.array([""] * len(col), pa.string())
    return col.fill_null("") if col.null_count else col


def bytes_of(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bounds): document i is ``bytes[bounds[i]:bounds[i + 1]]``."""
    kind = np.int64 if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else np.int32
    _, offsets, data = col.buffers()
    if len(col) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    bounds = np.frombuffer(offsets, kind)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0]:bounds[-1]], bounds - bounds[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, bounds) of runs of rows with about ``limit`` bytes of text."""
    raw, bounds = bytes_of(string_column(batch, column))
    row, n = 0, len(bounds) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(bounds, bounds[row] + limit, "right")) - 1)
        yield row, raw[bounds[row]:bounds[end]], bounds[row:end + 1] - bounds[row]
        row = end


def word_spans(raw: np.ndarray, bounds: np.ndarray, in_word: np.ndarray = WORD_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): byte spans of all words; document i has words ``first[i]:first[i + 1]``."""
    is_word = np.zeros(len(raw) + 1, bool)
    np.take(in_word, raw, out=is_word[:-1])
    begins = is_word[:-1].copy()
    begins[1:] &= ~is_word[:-2]
    edges = bounds[1:-1]
    edges = edges[edges < len(raw)]
    begins[edges] = is_word[edges]
    stops = is_word[:-1].copy()
    stops[:-1] &= ~is_word[1:-1]
    last = edges[edges > 0] - 1
    stops[last] = is_word[last]
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash."""
    h = h ^ (h >> U64(33))
    h *= U64(0xFF51AFD7ED558CCD)
    h ^= h >> U64(33)
    h *= U64(0xC4CEB9FE1A85EC53)
    h ^= h >> U64(33)
    return h


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _running_product(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, U64)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """First ``n`` powers of a base and of its inverse modulo 2**64."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, SLICE_BYTES + 1024)
        have = _POWERS[base] = tuple(_running_product(b, size) for b in (base, pow(base, -1, 2**64)))
    return have


class Rolling:
    """Hashes of any windows of a sequence, from one running sum modulo 2**64."""

    def __init__(self, values: np.ndarray, which: int = 0):
        self.base = _BASES[which]
        up, self.down = powers(len(values) + 1, self.base)
        self.sums = np.zeros(len(values) + 1, U64)
        np.cumsum((values.astype(U64) + U64(1)) * up[:len(values)], out=self.sums[1:])

    def window(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) * self.down[starts]

    def every(self, length: int) -> np.ndarray:
        """Windows of one length at every start."""
        n = len(self.sums) - length
        return (self.sums[length:] - self.sums[:n]) * self.down[:n] if n > 0 else np.zeros(0, U64)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    h = Rolling(raw).window(starts, ends)
    return mix(h + (ends - starts).astype(U64) * U64(0x9FB21C651E98DF25))


def slide_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:len(out) - step], out[step:])
        have += step
    return out


def winnow(values: np.ndarray, width: int, first: np.ndarray, span: int) -> np.ndarray:
    """Positions that hold the leftmost minimum of some window of ``width`` hashes.

    ``values[i]`` is the hash of the ``span`` items from i; ``first`` bounds the documents
    in items.  Windows lie within one document.  Equal stretches choose equal places.
    """
    if len(values) < width:
        return np.zeros(0, np.int64)
    bits = max(24, len(values).bit_length())       # the same for all slices of usual size
    low = U64((1 << bits) - 1)
    keyed = (values & ~low) | np.arange(len(values), dtype=U64)
    least = slide_min(keyed, width)
    ok = np.zeros(len(least) + 1, np.int32)
    size = width + span - 1                      # items that a window spans
    begin, end = first[:-1], first[1:] - size + 1
    some = end > begin
    np.add.at(ok, begin[some], 1)
    np.add.at(ok, end[some], -1)
    kept = least[np.cumsum(ok[:-1]) > 0]
    if not len(kept):
        return np.zeros(0, np.int64)
    at = (kept & low).astype(np.int64)
    return at[np.concatenate([[True], at[1:] != at[:-1]])]     # a sliding minimum never moves left


def sums_by(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``values`` over ``first[i]:first[i + 1]``; empty stretches give 0."""
    total = np.zeros((len(values) + 1, *values.shape[1:]), np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, axis=0, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Boolean mask over n places of the union of spans."""
    step = np.zeros(n + 1, np.int32)
    np.add.at(step, starts, 1)
    np.add.at(step, ends, -1)
    return np.cumsum(step[:-1]) > 0


def canonical(raw: np.ndarray, bounds: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text with its words joined by single spaces: (bytes, word starts, word ends, first word by document)."""
    starts, ends, first = word_spans(raw, bounds)
    sizes = ends - starts
    new_starts = np.zeros(len(sizes), np.int64)
    np.cumsum(sizes[:-1] + 1, out=new_starts[1:])
    total = int(new_starts[-1] + sizes[-1]) if len(sizes) else 0
    out = np.full(total, 0x20, np.uint8)
    keep = WORD_BYTES[raw]
    place = np.ones(total, bool)
    if len(sizes) > 1:
        place[new_starts[1:] - 1] = False
    out[place] = raw[keep]
    if lower:
        out = LOWER_AZ[out]
    return out, new_starts, new_starts + sizes, first


@functools.cache
def difference_cover(q: int) -> tuple[int, np.ndarray]:
    """(v, D) with v = q*q + q + 1 for a prime q: every difference modulo v is one of D's.

    Singer's construction: the zeros of a linear recurrence of order three over the field of q elements.
    """
    v = q * q + q + 1
    for a in range(q):
        for b in range(q):
            for c in range(1, q):
                s = [0, 0, 1]
                while len(s) < v:
                    s.append((a * s[-1] + b * s[-2] + c * s[-3]) % q)
                d = [i for i, x in enumerate(s) if x == 0]
                if len(d) == q + 1 and len({(x - y) % v for x in d for y in d}) == v:
                    return v, np.array(d, np.int64)
    raise ValueError(f"no difference cover for {q}")
