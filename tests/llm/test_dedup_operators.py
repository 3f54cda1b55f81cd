"""Suffix-array dedup, substring dedup and SimHash against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from talentlens.llm import simhash, substring_dedup, suffix_dedup
from talentlens.llm.text import difference_cover, slices, winnow

SCHEMA = "doc_id long, text string"
WORD = r"[^\x20\x09-\x0D]+"


def passages(rng, unit, join, lengths):
    """Documents that share whole, cut and edited passages, and the usual odd rows."""
    shared = [unit(rng.randint(*lengths)) for _ in range(10)]
    docs = []
    for i in range(70):
        parts = unit(rng.randint(0, lengths[0]))
        for _ in range(rng.randint(0, 3)):
            s = list(rng.choice(shared))
            if rng.random() < .5:
                s = s[rng.randint(0, lengths[0] // 4):][:rng.randint(lengths[0] // 2, lengths[1])]
            if rng.random() < .4 and s:
                s[rng.randrange(len(s))] = f"#{i}"
            parts = parts + s + unit(rng.randint(0, lengths[0]))
        docs.append((i * 7 % 70, join.join(parts)))
    long = unit(lengths[1] * 8)
    docs += [(500, join.join(long)), (501, join.join(long[lengths[0]:5 * lengths[1]] + long[:2 * lengths[1]])), (502, None), (503, ""), (504, "x"),
             (505, join.join(["x"] * 3 * lengths[0])), (506, join.join(["x"] * 2 * lengths[0])), (None, join.join(long[:2 * lengths[1]])),
             docs[3], (docs[4][0], join.join(shared[0] + unit(3)))]
    return docs


def same(got, expected):
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(expected, key=key)


def test_difference_cover_meets_every_pair_of_places():
    for q in (2, 3, 5, 7, 11, 13):
        v, cover = difference_cover(q)
        assert v == q * q + q + 1 and len(cover) == q + 1
        assert {(a - b) % v for a in cover.tolist() for b in cover.tolist()} == set(range(v))


def test_winnow_keeps_a_place_of_every_window_and_the_same_one_in_equal_windows():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 40, 300).astype(np.uint64) << np.uint64(40)
    values[200:260] = values[20:80]
    kept = set(winnow(values, 7, np.array([0, 150, 304]), 5).tolist())
    for a in [*range(0, 150 - 7 - 5 + 2), *range(150, 300 - 7 - 5 + 1)]:
        assert kept & set(range(a, a + 7))
    for a in range(20, 73):
        assert {x - a for x in kept if a <= x < a + 7} & {x - a - 180 for x in kept if a + 180 <= x < a + 187}


def removed_bytes(docs, length):
    texts = [(t or "").encode() for _, t in docs]
    count = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (d, _), t in zip(docs, texts, strict=True):
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if count[t[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        out.append((d, len(t), sum(gone), sum(g and not p for g, p in zip(gone, [False, *gone], strict=False)),
                    hashlib.sha256(bytes(x for x, g in zip(t, gone, strict=True) if not g)).hexdigest()))
    return out


def test_suffix_dedup(spark):
    rng = random.Random(5)
    docs = passages(rng, lambda n: [rng.choice("abcdefgh é") for _ in range(n)], "", (300, 900))
    docs += [(600, "ab" * 250), (601, "q" * 400), (602, "z" * 399 + "y")]
    got = suffix_dedup.digests(spark.createDataFrame(docs, SCHEMA))
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    same(got.collect(), removed_bytes(docs, 400))


def test_suffix_dedup_keeps_columns_and_real_bytes(spark):
    docs = spark.createDataFrame([(1, "a" * 30 + "bcdefghij", "x", 1), (2, "a" * 30, "y", 2)], "doc_id long, text string, id string, kept long")
    got = {r.doc_id: r for r in suffix_dedup.dedup(docs, length=20, q=3).collect()}
    assert got[1].id == "x" and bytes(got[1].kept) == b"bcdefghij" and got[1].spans == [0, 30]
    assert bytes(got[2].kept) == b"" and got[2].n_removed == 30
    assert suffix_dedup.dedup(docs.limit(0)).count() == 0


def removed_words(docs, window):
    key = lambda d: 1 << 63 if d is None else d
    words = [re.findall(WORD, t or "") for _, t in docs]
    first = {}
    for (d, _), w in zip(docs, words, strict=True):
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            first[k] = min(first.get(k, 1 << 64), key(d))
    out = []
    for (d, _), w in zip(docs, words, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < key(d):
                gone[i:i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("share", [2000, 3])
def test_substring_dedup(spark, monkeypatch, share):
    monkeypatch.setattr(substring_dedup, "SHARE", share)            # few anchors to a copy: shards are copied
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]
    docs = passages(rng, lambda n: [rng.choice(vocabulary) for _ in range(n)], "  ", (40, 120))
    same(substring_dedup.digests(spark.createDataFrame(docs, SCHEMA)).collect(), removed_words(docs, 50))


def test_substring_dedup_finds_what_the_first_holder_of_an_anchor_lacks(spark):
    """Documents 2 and 3 share a window whose anchors all occur first in document 1, in other company."""
    rng = random.Random(8)
    fresh = lambda n: [f"u{rng.randrange(10**9)}" for _ in range(n)]
    core, left = fresh(30), fresh(40)
    docs = [(1, " ".join(fresh(40) + core + fresh(40))), (2, " ".join(left + core + fresh(9))), (3, " ".join(fresh(5) + left + core + fresh(9)))]
    expected = removed_words(docs, 50)
    assert [r[2] for r in expected] == [0, 0, 70]
    same(substring_dedup.digests(spark.createDataFrame(docs, SCHEMA)).collect(), expected)


def test_substring_dedup_can_leave_untouched_texts_as_they_are(spark):
    rows = spark.createDataFrame([(1, " a\n b ", 7), (2, None, 8)], "doc_id long, text string, n_words long")
    got = {r.doc_id: r for r in substring_dedup.dedup(rows, rejoin=False).collect()}
    assert got[1].kept_text == " a\n b " and got[1].n_words == 2 and got[2].kept_text == ""
    assert {r.doc_id: r.kept_text for r in substring_dedup.dedup(rows).collect()}[1] == "a b"
    assert substring_dedup.dedup(rows.limit(0)).count() == 0


def simhash_of(text):
    raw = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    words = re.findall(WORD.encode(), raw)
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def simhash_components(docs):
    fp = [simhash_of(t) for _, t in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if (fp[i] ^ fp[j]).bit_count() <= 3:
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [(d, f"{fp[i]:016x}", least.get(find(i))) for i, (d, _) in enumerate(docs)]


def near_copies():
    rng = random.Random(3)
    base = [[f"w{rng.randrange(300)}" for _ in range(60)] for _ in range(6)]
    docs = []
    for i in range(250):
        words = list(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = f"v{rng.randrange(300)}"
        docs.append((i, " ".join(words)))
    return docs + [(900, None), (901, ""), (902, " \t"), (903, "a"), (None, "A"), (904, "a b"), (3, docs[5][1])]


def test_xxh64_of_every_length():
    rng = random.Random(3)
    parts = [bytes(rng.randrange(256) for _ in range(n)) for n in range(140)]
    bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    got = simhash.xxh64(np.frombuffer(b"".join(parts), np.uint8), bounds[:-1], bounds[1:])
    assert [int(x) for x in got] == [xxhash.xxh64_intdigest(p, 42) for p in parts]


def test_fingerprints_in_slices_of_any_size():
    texts = ["Ab c  é\tÉ " * n + "x" * (n % 3) for n in range(40)] + [None, "", " "]
    batch = pa.record_batch({"t": pa.array(texts)})
    for limit in (1, 100, 10_000):
        got = [int(x) for _, raw, bounds in slices(batch, "t", limit) for x in simhash.fingerprints(raw, bounds)]
        assert got == [simhash_of(t) for t in texts]


@pytest.mark.parametrize("block", [40_000, 5])
def test_simhash_components(spark, monkeypatch, block):
    monkeypatch.setattr(simhash.links, "__defaults__", (3, block))   # small blocks: groups are compared in pairs of blocks
    docs = near_copies()
    same(simhash.digests(spark.createDataFrame(docs, SCHEMA)).collect(), simhash_components(docs))


def test_simhash_keeps_one_of_each_component(spark):
    docs = near_copies()[:-1]
    docs.append(docs[5])
    got = simhash.keep_one(spark.createDataFrame([(d, t, "x") for d, t in docs], SCHEMA + ", fp string"))
    assert got.columns == ["doc_id", "text", "fp"]
    expected = {c for _, _, c in simhash_components(docs)}
    kept = [r.doc_id for r in got.collect()]
    assert len(kept) == len(set(kept)) and set(kept) == expected
    assert simhash.keep_one(got.limit(0)).count() == 0


@pytest.mark.parametrize("operator", ["suffix", "substring"])
def test_rows_without_ids_are_told_apart_though_hashes_of_their_texts_collide(spark, operator):
    """A long and a short text of one 32-bit hash, both without an id: only the long one's copied passage goes."""
    passage = " ".join(f"passage{i}" for i in range(60))
    number = spark.range(200_000).select(F.col("id").cast("string").alias("i"))
    long, short = (number.select(F.concat(F.lit(t), "i").alias(c)).withColumn("h", F.hash(c)) for c, t in (("a", passage + " "), ("b", "own words ")))
    pairs = long.join(short, "h").select("a", "b").collect()
    assert pairs
    docs = [(1, passage), *((None, t) for pair in pairs for t in pair)]
    rows = spark.createDataFrame(docs, SCHEMA)
    if operator == "suffix":
        same(suffix_dedup.digests(rows).collect(), removed_bytes(docs, 400))
    else:
        same(substring_dedup.digests(rows).collect(), removed_words(docs, 50))
