"""Language identification: multinomial naive Bayes over hashed character n-grams.

Fitting counts n-grams (n = 1, 2, 3) of lower-cased letters, hashed into a fixed
number of buckets, for each language; tasks add up their whole partition before
anything is shuffled.  The log-probability matrix has ``buckets`` rows and one
column per language, so its size is fixed by a parameter and not by the corpus;
it is broadcast.  Scoring looks the n-grams of a batch up in the matrix and adds
the rows of each document.
"""

from __future__ import annotations

import functools
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import columns_to_keep
from .text import tidy

ORDERS = (1, 2, 3)
BUCKETS = 1 << 16
MAX_LANGUAGES = 400
SLICE_CHARS = 1 << 20


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """crc32 of the id's text modulo 4 is 2; a null id is never held out."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string")) % 4 == 2, F.lit(False))


@functools.cache
def _letters() -> np.ndarray:
    """Lower-case letter by code point; 32 for everything that isn't a letter."""
    table = np.full(0x110000, 32, np.uint32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def ngrams(texts: list[str], buckets: int = BUCKETS):
    """(indices, bounds, has_letter): bucket of each n-gram, per order, and the documents' bounds in them.

    N-grams without a letter get the index ``buckets``.  Two blanks between documents keep
    every n-gram within one of them.
    """
    joined = "  " + "  ".join(texts) + "  "
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    a = _letters()[code]
    is_letter = a != 32
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = 2 + np.cumsum(sizes + 2) - 2
    begins = ends - sizes
    bounds = np.concatenate([begins - 2, [len(code) - 2]])
    out = []
    for n in ORDERS:
        m = len(a) - 2
        h = np.full(m, n, np.uint32)
        any_letter = np.zeros(m, bool)
        for k in range(n):
            h = h * np.uint32(0x01000193) + a[k:k + m] * np.uint32(0x9E3779B1)
            any_letter |= is_letter[k:k + m]
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(13)
        index = (h % np.uint32(buckets)).astype(np.int32)
        index[~any_letter] = buckets
        out.append(index)
    count = np.concatenate([[0], np.cumsum(is_letter)])
    return out, bounds, count[ends] > count[begins]


def _runs(texts: list[str]):
    at = 0
    while at < len(texts):
        size, end = 0, at
        while end < len(texts) and (end == at or size + len(texts[end]) <= SLICE_CHARS):
            size += len(texts[end])
            end += 1
        yield at, texts[at:end]
        at = end


@dataclass
class LanguageModel:
    languages: list[str]
    log_probs: np.ndarray          # (buckets + 1, languages); the last row is for n-grams without a letter
    log_prior: np.ndarray

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        langs, scores = [], []
        for _, run in _runs(texts):
            index, bounds, has_letter = ngrams(run, len(self.log_probs) - 1)
            total = np.zeros((len(run), len(self.languages)))
            for one in index:
                total += np.add.reduceat(self.log_probs[one], bounds[:-1], axis=0, dtype=np.float64)
            total += self.log_prior
            best = total.argmax(axis=1) if len(self.languages) else np.zeros(len(run), int)
            for i, known in enumerate(has_letter):
                if not known or not self.languages:
                    langs.append("und")
                    scores.append(0.0)
                else:
                    langs.append(self.languages[best[i]])
                    scores.append(float(1 / np.exp(np.minimum(total[i] - total[i, best[i]], 0)).sum()))
        return langs, scores


def fit(rows: DataFrame, text: str = "text", lang: str = "lang", buckets: int = BUCKETS, smoothing: float = 0.5) -> LanguageModel:
    """Learn from all rows whose text and language aren't null."""
    rows = rows.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(text).cast("string"), F.col(lang).cast("string"))

    def count(batches):
        totals = defaultdict(lambda: np.zeros(buckets + 1, np.int64))
        docs: dict[str, int] = defaultdict(int)
        for batch in batches:
            by_lang = defaultdict(list)
            for t, g in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                by_lang[g].append(t)
            for g, texts in by_lang.items():
                docs[g] += len(texts)
                for _, run in _runs(texts):
                    for one in ngrams(run, buckets)[0]:
                        totals[g] += np.bincount(one, minlength=buckets + 1)
        for g, n in totals.items():
            n[buckets] = docs[g]                       # the last place carries the number of documents
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([g] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(n[at], pa.int64())],
                                             names=["lang", "bucket", "n"])

    counted = rows.mapInArrow(tidy(count), "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    got = counted.toArrow()
    languages = sorted(set(got.column("lang").to_pylist()))
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"{len(languages)} languages; the matrix is laid out for {MAX_LANGUAGES} at most")
    counts = np.zeros((buckets + 1, len(languages)))
    place = {g: i for i, g in enumerate(languages)}
    counts[got.column("bucket").to_numpy(), [place[g] for g in got.column("lang").to_pylist()]] = got.column("n").to_numpy()
    docs, counts = counts[buckets].copy(), counts[:buckets] + smoothing
    log_probs = np.vstack([np.log(counts / counts.sum(axis=0)), np.zeros(len(languages))]).astype(np.float32)
    return LanguageModel(languages, log_probs, np.log(docs / max(docs.sum(), 1)))


def predict(docs: DataFrame, model: LanguageModel, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The rows of ``docs`` with ``lang_pred`` and ``score`` (the posterior probability of that language).

    A text that is null, empty or without a letter gets ``und`` and 0; so do all texts if nothing
    could be learned.  Rows stay as they are; only the text is read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = columns_to_keep(docs, keep, ["lang_pred", "score"])
    kept = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], F.col(f"`{text}`").cast("string").alias("lid_text"))
    names = [f"k{i}" for i in range(len(keep))]

    def run(batches):
        for batch in batches:
            langs, scores = shared.value.predict(batch.column(len(keep)).fill_null("").to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             names=[*names, "lang_pred", "score"])

    schema = ", ".join([*(f"{n} {kept.schema[i].dataType.simpleString()}" for i, n in enumerate(names)), "lang_pred string", "score double"])
    return kept.mapInArrow(tidy(run), schema).select(*[F.col(n).alias(c) for n, c in zip(names, keep, strict=True)], "lang_pred", "score")
