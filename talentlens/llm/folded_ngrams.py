"""Kneser-Ney over characters folded into 64 classes, in memory.

No query uses it: ``quality`` counts whole code points in Spark.  It is the plain form of the
same estimate for a model that fits into one process, and its tests hold the formulas.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np

ORDER = 4
CLASSES = 64


@functools.cache
def _classes() -> np.ndarray:
    """Class by code point; 0 is the padding before a text."""
    table = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isspace():
            k = 1
        elif ch.isdigit():
            k = 2
        elif ch.isalpha():
            low = ord(ch.lower()[0])
            k = 16 + low - 97 if 97 <= low <= 122 else 42 + low % 21
        elif c < 128:
            k = 3 + c % 12
        else:
            k = 63
        table[c] = k
    return table


def codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(4-gram code of every character with the three before it, bounds by document)."""
    pad = " " * (ORDER - 1)
    a = _classes()[np.frombuffer((pad + pad.join(texts) + pad).encode("utf-32-le", "surrogatepass"), "<u4")].astype(np.int32)
    sizes = np.array([len(t) for t in texts], np.int64)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    start = bounds[:-1] + (ORDER - 1) * (1 + np.arange(len(texts)))
    place = np.ones(len(a), np.int8)
    if len(texts):
        edge = np.zeros(len(a) + 1, np.int32)
        np.add.at(edge, start, 1)
        np.add.at(edge, start + sizes, -1)
        place = np.cumsum(edge[:-1])
    a[place == 0] = 0
    code = a.copy()
    for k in range(1, ORDER):
        code[k:] |= a[:-k] << (6 * k)
    return code[place > 0], bounds


def _discounts(counts: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts of 1, 2 and 3 or more."""
    n = np.array([0, *((counts == k).sum() for k in range(1, 5))], float)
    if n[1] == 0 or n[2] == 0:
        return np.array([0, 0.5, 0.5, 0.5])
    y = n[1] / (n[1] + 2 * n[2])
    d = [k - (k + 1) * y * n[k + 1] / n[k] if n[k] else 0.5 for k in range(1, 4)]
    return np.clip([0, *d], [0, 0.05, 0.05, 0.05], [0, 1, 2, 3])


@dataclass
class KneserNey:
    """By order: sorted n-gram codes, their probabilities and plain counts; sorted contexts, their back-off weights and plain counts."""
    grams: list[np.ndarray]
    probs: list[np.ndarray]
    counts: list[np.ndarray]
    contexts: list[np.ndarray]
    weights: list[np.ndarray]
    context_counts: list[np.ndarray]

    @classmethod
    def build(cls, code: np.ndarray, count: np.ndarray) -> KneserNey:
        order = np.argsort(code)
        grams, plain, mass = [code[order].astype(np.int64)], [count[order].astype(np.int64)], [count[order].astype(np.int64)]
        for n in range(ORDER - 1, 0, -1):                       # lower orders count the distinct classes before them
            lower, place, before = np.unique(grams[0] & ((1 << 6 * n) - 1), return_inverse=True, return_counts=True)
            plain.insert(0, np.bincount(place, plain[0]).astype(np.int64))
            grams.insert(0, lower)
            mass.insert(0, before)
        model = cls([g.astype(np.int32) for g in grams], [], plain, [], [], [])
        for n in range(ORDER):
            d = _discounts(mass[n])
            context, place = np.unique(grams[n] >> 6, return_inverse=True)
            total = np.bincount(place, mass[n])
            weight = np.bincount(place, d[np.minimum(mass[n], 3)]) / total
            below = model.probs[n - 1][np.searchsorted(grams[n - 1], grams[n] & ((1 << 6 * n) - 1))] if n else 1 / CLASSES
            model.probs.append((mass[n] - d[np.minimum(mass[n], 3)]) / total[place] + weight[place] * below)
            model.contexts.append(context.astype(np.int32))
            model.weights.append(weight)
            model.context_counts.append(np.bincount(place, plain[n]).astype(np.int64))
        return model

    def probabilities(self, code: np.ndarray, n: int = ORDER) -> np.ndarray:
        """Probability of the last class of every code after the n - 1 classes before it."""
        if n == 0:
            return np.full(len(code), 1 / CLASSES)
        at, known = _find(self.grams[n - 1], code)
        out = self.probs[n - 1][at]
        new = np.flatnonzero(~known)
        if len(new):
            place, held = _find(self.contexts[n - 1], code[new] >> 6)
            out[new] = np.where(held, self.weights[n - 1][place], 1.0) * self.probabilities(code[new] & ((1 << 6 * (n - 1)) - 1), n - 1)
        return out

    def held_out_bits(self, code: np.ndarray, first: np.ndarray) -> np.ndarray:
        """-log2 of the probabilities of the documents' characters, each without its own document's evidence.

        An n-gram or context that no other document has counts as unseen.  Only n-grams whose count
        is no greater than the document's length can be such, and those of a longer n-gram's parts are among them.
        """
        size = np.diff(first)
        doc, length = np.repeat(np.arange(len(size)), size), np.repeat(size, size)
        at, known = _find(self.grams[-1], code)
        out = self.probs[-1][at]
        rare = np.flatnonzero(~known | (self.counts[-1][at] <= length))
        if len(rare):
            out[rare] = self._without_own(code[rare], doc[rare], length[rare], ORDER)
        return -np.log2(out)

    def _without_own(self, code: np.ndarray, doc: np.ndarray, length: np.ndarray, n: int) -> np.ndarray:
        if n == 0:
            return np.full(len(code), 1 / CLASSES)
        at, known = _find(self.grams[n - 1], code)
        elsewhere = known & (self.counts[n - 1][at] > _times(doc, code))
        place, held = _find(self.contexts[n - 1], code >> 6)
        held &= self.context_counts[n - 1][place] > _times(doc, code >> 6)
        lower = code & ((1 << 6 * (n - 1)) - 1)
        below = self.probabilities(lower, n - 1)
        if n > 1:
            down, known_below = _find(self.grams[n - 2], lower)
            rare = np.flatnonzero(~known_below | (self.counts[n - 2][down] <= length))
        else:
            rare = np.arange(0)
        if len(rare):
            below[rare] = self._without_own(lower[rare], doc[rare], length[rare], n - 1)
        return np.where(elsewhere, self.probs[n - 1][at], np.where(held, self.weights[n - 1][place], 1.0) * below)


def _find(sorted_codes: np.ndarray, codes_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, whether it is there) of every code."""
    at = np.minimum(np.searchsorted(sorted_codes, codes_), len(sorted_codes) - 1)
    return at, sorted_codes[at] == codes_


def _times(doc: np.ndarray, values: np.ndarray) -> np.ndarray:
    """How often each document has each of its values."""
    _, place, n = np.unique(doc.astype(np.int64) << 24 | values, return_inverse=True, return_counts=True)
    return n[place]
