"""Centroid clustering, ranked search and MinHash against brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from talentlens.llm import centroids, lexical, minhash

SCHEMA = "doc_id long, text string"
WORD = r"[^\x20\x09-\x0D]+"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def vectors(rng, n, dims, spread=0.4):
    middles = rng.normal(0, 1, (6, dims))
    out = [(i * 7 % n, (middles[rng.integers(6)] + rng.normal(0, spread, dims)).tolist()) for i in range(n)]
    bad = [(n, None), (n + 1, []), (n + 2, [1.0] * (dims - 1)), (n + 3, [1.0] * (dims - 1) + [None]), (n + 4, [float("nan")] + [0.0] * (dims - 1)),
           (n + 5, [float("inf")] * dims)]
    return [*out, *bad, out[3], out[3], (None, out[5][1]), (n + 6, [40.0] * dims)]


def plain_clusters(rows, k, rounds, seed=2, scale=256):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v and len(v) == len(rows[0][1]) and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest()))
    middles = [list(v) for _, v in order[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, m, strict=True)), c) for c, m in enumerate(middles))
    for _ in range(rounds):
        found = [near(v)[1] for _, v in kept]
        for c in range(len(middles)):
            own = [v for (_, v), f in zip(kept, found, strict=True) if f == c]
            if own:
                middles[c] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    return [(i, near(v)[1], near(v)[0]) for i, v in kept], middles


@pytest.mark.parametrize("dims,block", [(8, 1024), (5, 3)])
def test_clusters_equal_plain_rounds(spark, monkeypatch, dims, block):
    monkeypatch.setattr(centroids, "BLOCK", block)
    monkeypatch.setattr(centroids, "SAMPLE", 40)                    # most vectors lie beyond the sample's cells
    rows = vectors(np.random.default_rng(4), 150, dims)
    table = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, cluster string, extra int").repartition(5)
    got = centroids.cluster(table, k=12, rounds=3, dims=dims)
    assert got.rows.columns == ["vec_id", "embedding", "extra", "cluster", "distance"]
    expected, middles = plain_clusters(rows, 12, 3)
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got.rows.select("vec_id", "cluster", "distance").collect()), key=key) == sorted(expected, key=key)
    assert got.centroids.tolist() == middles


def test_clusters_of_few_vectors_and_of_none(spark):
    rows = spark.createDataFrame([(1, [0.5, 0.0]), (2, [0.5, 0.0]), (3, [9.0, 9.0])], "vec_id long, embedding array<float>")
    got = centroids.cluster(rows, k=40, dims=2)
    found = {r.vec_id: (r.cluster, r.distance) for r in got.rows.collect()}
    assert len(got.centroids) == 3 and found[1] == found[2] and found[1][1] == found[3][1] == 0        # the tie goes to the smaller number
    assert centroids.cluster(rows.limit(0), dims=2).rows.count() == 0
    assert centroids.digests(rows).count() == 0                    # none has 64 components
    huge = spark.createDataFrame([(1, [1e30, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="may not fit 64 bits"):
        centroids.cluster(huge, dims=2)


def test_intervals_hold_the_exact_distances():
    rng = np.random.default_rng(2)
    v, middles = rng.integers(-90, 90, (300, 7)), rng.integers(-90, 90, (9, 7))
    borders = np.sort(rng.integers(-60, 60, (7, centroids.CELLS - 1)))
    cells = centroids._cells(v, borders)
    low, high = np.zeros((7, centroids.CELLS), int), np.zeros((7, centroids.CELLS), int)
    for d in range(7):
        for c in set(cells[:, d].tolist()):
            low[d, c], high[d, c] = v[cells[:, d] == c, d].min(), v[cells[:, d] == c, d].max()
    ends = sum(t[c] for t, c in zip(centroids.lookup_table(middles, low, high), cells.T, strict=True))
    exact = ((v[:, None] - middles) ** 2).sum(axis=2)
    assert (ends[:, :9] <= exact).all() and (exact <= ends[:, 9:]).all()
    one = centroids._Assigner(middles, low, high)
    assert one.assign(cells, v).tolist() == exact.argmin(axis=1).tolist() and 0 < one.fetched < 300


def plain_search(docs, items, top=10):
    bags = [(d, Counter(re.findall(TERM, lower(t)))) for d, t in docs]
    n_docs, total = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * f + 1))) for t, f in df.items()}
    out = []
    for item, text in items:
        terms = set(re.findall(TERM, lower(text)))
        scored = []
        for d, b in bags:
            m = 10 + 90 * sum(b.values()) * n_docs // max(1, total)
            s = sum(w[t] * (1_000_000_000 * b[t] // (1000 * b[t] + 8 * m)) for t in terms if t in b)
            scored += [(-s, d is None, d or 0)] * (s > 0)
        out += [(item, r, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scored)[:top], 1)]
    return out


def search_tables():
    rng = random.Random(6)
    words = ["the", "of", "Über", "naïve", "x1", *[f"w{i}" for i in range(80)]]
    text = lambda n: " ".join(rng.choice(words[:5] if rng.random() < .4 else words) + rng.choice(["", ",", "-", "\n"]) for _ in range(n))
    docs = [(i * 3 % 200, text(rng.randint(1, 60))) for i in range(200)]
    copy = text(40)
    docs += [(1000 + i, copy) for i in range(60)] + [(2000 - i, copy.upper() if i % 2 else copy + " unseen") for i in range(30)]
    docs += [(None, copy), (None, copy), (3000, None), (3001, ""), (3002, "!!!"), (3003, "ü" * 5000), docs[4], (docs[5][0], docs[6][1])]
    items = [(i, text(rng.randint(2, 25))) for i in range(25)] + [(90, copy), (91, None), (92, ""), (93, "absent words"), (94, "THE the The"), (94, "ü" * 5000)]
    return docs, items


@pytest.mark.parametrize("block,scores", [(2_000_000, 1 << 16), (60, 40)])
def test_search_equals_plain_search(spark, monkeypatch, block, scores):
    monkeypatch.setattr(lexical, "SCORES", scores)
    docs, items = search_tables()
    docs_table = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], SCHEMA + ", score int, item string").repartition(6)
    got = lexical.search(docs_table, spark.createDataFrame(items, "item_id long, text string"), block_terms=block)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(plain_search(docs, items), key=key)


def test_search_in_empty_tables(spark):
    docs, items = spark.createDataFrame([("a", "one two")], "doc_id string, text string"), spark.createDataFrame([(1, "two")], "item_id int, text string")
    assert [tuple(r) for r in lexical.search(docs, items).collect()] == [(1, 1, "a", math.floor(1000 * math.log(4 / 3)) * (1_000_000_000 // 1800))]
    assert lexical.search(docs.limit(0), items).count() == 0
    assert lexical.search(docs, items.limit(0)).count() == 0
    assert lexical.search(docs, items.withColumn("text", items.text.substr(9, 9))).count() == 0


def test_documents_of_one_bag_are_one_class(spark):
    docs, items = search_tables()
    index = lexical._Index([sorted({t.encode() for t in re.findall(TERM, lower(x))}) for _, x in items])
    bagged = lexical.bags(spark.createDataFrame(docs, SCHEMA).withColumnRenamed("doc_id", "doc"), index.vocabulary)
    found = lexical.classes(bagged, 100, 1000, 10).collect()
    assert max(len(r.members) for r in found) == 10 and len({(r.m, bytes(r.bag)) for r in found}) == len(found)
    assert [r.members for r in found if 1000 in r.members] == [list(range(1000, 1010))]


def plain_components(docs, similarity=80):
    sets = []
    for _, t in docs:
        w = re.findall(WORD, lower(t))
        sets.append({tuple(w[i:i + 4]) for i in range(max(1, len(w) - 3))} if w else set())
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= similarity * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    ids = [least.get(find(i)) for i in range(len(docs))]
    return [(d, len(s), c, d == c) for (d, _), s, c in zip(docs, sets, ids, strict=True)]


def near_texts(n=260):
    """Chains of edits: members of a group lie around the limit, and many link only through others."""
    rng = random.Random(11)
    base = [[f"w{rng.randrange(4000)}" for _ in range(rng.choice([5, 12, 60, 200]))] for _ in range(8)]
    docs = []
    for i in range(n):
        words = list(base[rng.randrange(8)])
        for _ in range(rng.randint(0, max(1, len(words) // 25))):
            words[rng.randrange(len(words))] = f"v{rng.randrange(9999)}"
        if rng.random() < .2:
            words += [f"t{rng.randrange(9999)}" for _ in range(len(words) // 6)]
        docs.append((i * 11 % n, (" ".join(words)).title() if i % 5 == 0 else "\n".join(words)))
    docs += [(900, None), (901, ""), (902, " \t"), (903, "a"), (None, "A"), (904, "a b"), (905, "a b c"), (906, "a B c"), (907, "a b c a b c a b c"), (908, "b c a b c a"),
             (None, docs[9][1]), (None, "quite alone here now"), docs[3], (docs[4][0], docs[5][1]), (909, "z " * 4000), (910, "z " * 9)]
    return docs


def test_signature_coordinates_agree_as_often_as_sets_overlap():
    rng = np.random.default_rng(1)
    hits = []
    for seed in range(40):
        h = rng.integers(0, 1 << 63, 1200, dtype=np.uint64)
        a, b = np.sort(h[:900]), np.sort(h[100:1000])                # 800 of 1000
        sig = minhash.signatures(np.concatenate([a, b]), np.array([0, 900, 1800]))
        hits.append((sig[0] == sig[1]).mean())
    assert abs(np.mean(hits) - 0.8) < 0.02 and min(hits) > minhash.AGREE / 128


@pytest.mark.parametrize("chunk,block,share", [(32_768, 4_096, 1_000), (7, 4, 3)])
def test_minhash_components(spark, monkeypatch, chunk, block, share):
    monkeypatch.setattr(minhash, "CHUNK", chunk)
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "SHARE", share)
    docs = near_texts()
    got = minhash.digests(spark.createDataFrame(docs, SCHEMA).repartition(4))
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    key = lambda r: tuple((x is None, x) for x in r)
    expected = plain_components(docs)
    assert sum(c != d for d, _, c, _ in expected) > 100
    assert sorted(map(tuple, got.collect()), key=key) == sorted(expected, key=key)


@pytest.mark.parametrize("block", [4_096, 2])
def test_open_groups_link_all_components_that_share_a_link(spark, block):
    """Whether components share blocks or have blocks of their own."""
    docs = [(i, t) for i, (_, t) in enumerate(near_texts(120))]
    words = [re.findall(WORD, lower(t)) for _, t in docs]
    sets = [{tuple(w[i:i + 4]) for i in range(max(1, len(w) - 3))} if w else set() for w in words]
    root = {i: i if i % 3 else 0 for i in range(len(docs))}          # a third is one component already
    table = spark.createDataFrame(docs, "seq long, text string")
    rows = minhash.set_rows(table, 4).where("n > 0").select("seq", "n", "sig")
    got = [tuple(r) for r in minhash.open_links(rows, table, spark.createDataFrame(list(root.items()), "node long, root long"), 4, 80, block).collect()]
    linked = {(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets) if root[i] != root[j] and a and 100 * len(a & b) >= 80 * len(a | b)}
    assert got and set(got) <= linked

    def joined(links):
        least = dict(root)
        for _ in root:
            for a, b in links:
                x, y = least[a], least[b]
                if x != y:
                    least = {k: min(x, y) if v in (x, y) else v for k, v in least.items()}
        return least

    assert joined(got) == joined(linked)


def test_minhash_keeps_columns_and_takes_empty_tables(spark):
    rows = spark.createDataFrame([(1, "a b c d e", "x", 7), (2, "A b c d e", "y", 8)], "doc_id long, text string, n string, component_id int")
    got = minhash.components(rows)
    assert got.columns == ["doc_id", "text", "n", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect())) == [(1, "a b c d e", "x", 2, 1), (2, "A b c d e", "y", 2, 1)]
    assert minhash.components(rows.limit(0)).count() == 0
    with pytest.raises(ValueError, match="80 in 100"):
        minhash.components(rows, similarity=70)
