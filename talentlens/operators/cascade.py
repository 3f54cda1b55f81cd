"""Cascade sampling of any size (L2): quotas from counts, selection by cut-off keys.

Every row has a mask of the buckets that it fits and a random-looking hexadecimal key.  A bucket takes the rows
with the least (key, id) among those that fit it and that no earlier bucket took.  Of the rows with one mask every
bucket therefore takes a run that follows the last one's: the whole sample is told by one cut-off (key, id) for each bucket.

A cut-off is found by descending through counts of rows by mask and the next digits of their keys, two at a
time; where few rows are left, they are looked at themselves.  The driver sees those counts (64 masks x 256
prefixes a step) and at most ``LEAF`` keys for each cut-off; the rows are selected in Spark.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIGITS, KEY_LENGTH = 2, 32
#: Distinct rows under a prefix that are looked at one by one.
LEAF = 10_000
#: Beyond every (key, id); no bucket's quota ends before the rows do.
END = ("~", "")


class KeyCounts:
    """Counts of (candidate_id, key, mask) rows by mask and prefix of the key, taken when they are first needed."""

    def __init__(self, rows: DataFrame):
        self.rows, self._levels, self._leaves = rows, {}, {}
        self.whole = sum(self.level("").values(), Counter())
        self.masks = sorted(self.whole)

    def level(self, prefix: str) -> dict[str, Counter]:
        """Of each continuation of the prefix: rows by mask."""
        if prefix not in self._levels:
            digits = F.substring("key", len(prefix) + 1, DIGITS)
            found: dict[str, Counter] = {}
            for mask, d, n in self.under(prefix).groupBy("mask", digits.alias("d")).agg(F.count(F.lit(1))).collect():
                found.setdefault(d, Counter())[mask] = n
            self._levels[prefix] = found
        return self._levels[prefix]

    def leaf(self, prefix: str) -> list[tuple]:
        """(key, id, mask, rows) under a prefix with few of them, in order."""
        if prefix not in self._leaves:
            self._leaves[prefix] = sorted(map(tuple, self.under(prefix).groupBy("key", "candidate_id", "mask").agg(F.count(F.lit(1))).collect()))
        return self._leaves[prefix]

    def under(self, prefix: str) -> DataFrame:
        return self.rows.where(F.col("key").startswith(prefix)) if prefix else self.rows

    def total(self, prefix: str) -> Counter:
        return self.level(prefix[:-DIGITS])[prefix[-DIGITS:]] if prefix else self.whole

    def few(self, prefix: str) -> bool:
        return len(prefix) + DIGITS > KEY_LENGTH or sum(self.total(prefix).values()) <= LEAF

    def upto(self, mask: int, cut: tuple | None, prefix: str = "") -> int:
        """Rows of a mask under a prefix that lie at or before a cut-off."""
        n = self.total(prefix)[mask]
        if cut is None or not n:
            return 0
        start = cut[0][:len(prefix)]
        if start != prefix:
            return n if start > prefix else 0
        if self.few(prefix):
            return sum(c for k, i, m, c in self.leaf(prefix) if m == mask and (k, i) <= cut)
        at = cut[0][len(prefix):len(prefix) + DIGITS]
        before = sum(c[mask] for d, c in self.level(prefix).items() if d < at)
        return before + (self.upto(mask, cut, prefix + at) if at in self.level(prefix) else 0)

    def beyond(self, cuts: dict[int, tuple | None], prefix: str = "") -> int:
        return sum(self.total(prefix)[m] - self.upto(m, cut, prefix) for m, cut in cuts.items())

    def nth(self, n: int, cuts: dict[int, tuple | None]) -> tuple:
        """The n-th (key, id) of the rows of some masks beyond their cut-offs; there must be as many."""
        prefix = ""
        while not self.few(prefix):
            for d in sorted(self.level(prefix)):
                here = self.beyond(cuts, prefix + d)
                if here >= n:
                    prefix += d
                    break
                n -= here
        for k, i, m, c in self.leaf(prefix):
            if m in cuts and (cuts[m] is None or (k, i) > cuts[m]):
                n -= c
                if n <= 0:
                    return k, i
        raise AssertionError("fewer rows than counted")


def cut_offs(counts: KeyCounts, buckets: int, target_total: int) -> list[tuple | None]:
    """One (key, id) for each bucket: it takes what fits it up to there; None where it takes nothing.

    Every bucket has the quota ⌊target / buckets⌋ and what the earlier ones left over.
    """
    quota, carry, out = target_total // buckets, 0, []
    taken: dict[int, tuple | None] = dict.fromkeys(counts.masks)
    for b in range(buckets):
        limit, fitting = quota + carry, {m: cut for m, cut in taken.items() if m >> b & 1}
        there = counts.beyond(fitting)
        cut = None if limit <= 0 or not there else END if there <= limit else counts.nth(limit, fitting)
        picked = 0 if cut is None else sum(max(0, counts.upto(m, cut) - counts.upto(m, old)) for m, old in fitting.items())
        carry = limit - picked
        for m, old in fitting.items():
            taken[m] = max(filter(None, (old, cut)), default=None)
        out.append(cut)
    return out


def bucket_of(cuts: list[tuple | None], names: tuple[str, ...]) -> Column:
    """The bucket that takes a row of (candidate_id, key, mask), or null."""
    chosen = F.lit(None).cast("string")
    for b, cut in reversed(list(enumerate(cuts))):
        if cut is not None:
            upto = (F.col("key") < cut[0]) | ((F.col("key") == cut[0]) & (F.col("candidate_id") <= cut[1]))
            chosen = F.when((F.col("mask").bitwiseAND(1 << b) != 0) & upto, F.lit(names[b])).otherwise(chosen)
    return chosen
