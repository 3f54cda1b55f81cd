"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a document are the distinct hashes of its words, word pairs and pairs
that skip one word.  Training reads a sample of labelled rows whose size is a
parameter (``max_rows``); feature extraction is spread over the cluster, and the
online pass, which is sequential by nature, runs over that bounded sample in one
task.  Per-coordinate learning rates and the L1 term leave a few thousand weights;
scoring broadcasts them (never more than ``1 << BITS`` of them).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import columns_to_keep
from .text import ALNUM_BYTES, LOWER_AZ, U64, mix, slices, tidy, word_hashes, word_spans

BITS = 20
MAX_ROWS = 16_000
THRESHOLD = 0.3
BIAS = 0


@dataclass(frozen=True)
class Ftrl:
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 4.0
    l2: float = 0.0
    epochs: int = 4


def feature_streams(raw: np.ndarray, bounds: np.ndarray):
    """(hashes, document bounds) of the words, word pairs and skip-grams of a slice."""
    raw = LOWER_AZ[raw]
    starts, ends, first = word_spans(raw, bounds, ALNUM_BYTES)
    h = word_hashes(raw, starts, ends)
    shift = U64(64 - BITS)
    yield (h >> shift).astype(np.int64), first
    for step, salt in ((1, 0xA24BAED4963EE407), (2, 0x9FB21C651E98DF25)):
        pairs = mix(h[:-step] * U64(3) + h[step:] * U64(5) + U64(salt)) if len(h) > step else np.zeros(0, U64)
        begin = np.minimum(first[:-1], len(pairs))
        end = np.clip(first[1:] - step, begin, len(pairs))
        inside = np.zeros(len(pairs) + 1, np.int32)
        np.add.at(inside, begin, 1)
        np.add.at(inside, end, -1)
        ok = np.cumsum(inside[:-1]) > 0
        yield (pairs[ok] >> shift).astype(np.int64), np.concatenate([[0], np.cumsum(end - begin)])


def distinct_features(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features, bounds): the distinct features of each document, in order; the bias is in each."""
    n = len(bounds) - 1
    keys = [np.arange(n, dtype=np.int64) << BITS | BIAS]
    for features, first in feature_streams(raw, bounds):
        doc = np.repeat(np.arange(n, dtype=np.int64), np.diff(first))
        keys.append(doc << BITS | features)
    flat = np.unique(np.concatenate(keys))
    return (flat & ((1 << BITS) - 1)).astype(np.int32), np.searchsorted(flat >> BITS, np.arange(n + 1))


def ftrl(features: list[np.ndarray], labels: np.ndarray, p: Ftrl) -> np.ndarray:
    """Weights after ``epochs`` passes over the rows in the given order."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)

    def weights(z, n):
        return np.where(np.abs(z) <= p.l1, 0.0, (np.sign(z) * p.l1 - z) / ((p.beta + np.sqrt(n)) / p.alpha + p.l2))

    for _ in range(p.epochs):
        for at, y in zip(features, labels, strict=True):
            zi, ni = z[at], n[at]
            w = weights(zi, ni)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y
            grown = ni + g * g
            z[at] = zi + g - (np.sqrt(grown) - np.sqrt(ni)) / p.alpha * w
            n[at] = grown
    return weights(z, n)


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, params: Ftrl = Ftrl(), text: str = "text", label: str = "toxic") -> tuple[np.ndarray, np.ndarray]:
    """(feature, weight) arrays, learned from documents that ``labels`` marks 0 or 1.

    At most about ``max_rows`` rows are used, chosen by a hash of their id.  Without labelled
    rows there are no weights and every score is 0.5.  Labels that are null are left out; of
    several labels of one id, the largest counts.
    """
    labels = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg((F.max(label) > 0).cast("int").alias("y"))
    rows = labels.count()
    u = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("sample")), F.lit(1 << 30))
    sample = labels.where(u < int((1 << 30) * min(1.0, max_rows / max(rows, 1))))
    chosen = docs.select("doc_id", F.col(text).cast("string").alias("tox_text")).join(F.broadcast(sample), "doc_id")      # bounded by max_rows
    keyed = chosen.select(F.xxhash64(F.col("doc_id").cast("string"), F.lit("order")).alias("k"), "y", "tox_text")

    def extract(batches):
        for batch in batches:
            for row, raw, bounds in slices(batch, "tox_text"):
                features, first = distinct_features(raw, bounds)
                part = batch.slice(row, len(bounds) - 1)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([features[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)], pa.binary())],
                    names=["k", "y", "features"])

    def learn(batches):
        got = [(k, f, y) for b in batches for k, y, f in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True)]
        got.sort(key=lambda r: r[:2])
        w = ftrl([np.frombuffer(f, np.int32) for _, f, _ in got], np.array([y for *_, y in got], float), params)
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(w[at], pa.float64())], names=["feature", "weight"])

    features = keyed.mapInArrow(tidy(extract), "k long, y int, features binary")
    got = features.repartition(1).mapInArrow(tidy(learn), "feature int, weight double").toArrow()
    return got.column("feature").to_numpy(), got.column("weight").to_numpy()


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], text: str = "text", keep: list[str] | None = None,
          threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` with ``score`` (0 to 1) and ``predicted`` (1 if the score reaches ``threshold``).

    Null and empty texts get the bias alone.  Every distinct feature of the whole text counts once.
    Rows stay as they are; only the text is read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = columns_to_keep(docs, keep, ["score", "predicted"])
    kept = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], F.col(f"`{text}`").cast("string").alias("tox_text"))
    names = [f"k{i}" for i in range(len(keep))]

    def run(batches):
        weights = np.zeros(1 << BITS)
        weights[shared.value[0]] = shared.value[1]
        for batch in batches:
            for row, raw, bounds in slices(batch, "tox_text"):
                n = len(bounds) - 1
                keys = []
                for features, first in feature_streams(raw, bounds):
                    hit = np.flatnonzero(weights[features])                # few features have a weight
                    doc = np.searchsorted(first, hit, "right") - 1
                    keys.append(doc << BITS | features[hit])
                flat = np.unique(np.concatenate(keys))
                total = weights[BIAS] + np.bincount(flat >> BITS, weights[flat & ((1 << BITS) - 1)], minlength=n)[:n]
                p = 1 / (1 + np.exp(-np.clip(total, -35, 35)))
                part = batch.slice(row, n)
                yield pa.RecordBatch.from_arrays([*part.columns[:len(keep)], pa.array(p, pa.float64()), pa.array((p >= threshold).astype(np.int32), pa.int32())],
                                                 names=[*names, "score", "predicted"])

    schema = ", ".join([*(f"{n} {kept.schema[i].dataType.simpleString()}" for i, n in enumerate(names)), "score double", "predicted int"])
    return kept.mapInArrow(tidy(run), schema).select(*[F.col(n).alias(c) for n, c in zip(names, keep, strict=True)], "score", "predicted")
