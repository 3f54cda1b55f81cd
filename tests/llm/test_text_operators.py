"""Language ID, decontamination, quality rules, BPE and toxicity."""

import base64
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from talentlens.llm import bpe, decontaminate, language_id, quality, toxicity
from talentlens.llm.queries import VOCABULARY
from talentlens.llm.staging import bucketed
from talentlens.llm.text import slices
from talentlens.session import read_table

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string"
ODD = [(900, None), (901, ""), (902, " \n\t"), (903, "x"), (None, "plain words here"), (903, "x")]


def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


def test_language_id_on_held_out_documents(spark):
    docs = read_table(spark, SF, "documents")
    model = language_id.fit(docs.where(~language_id.held_out()))
    got = language_id.predict(docs, model, keep=["doc_id", "lang"]).where(language_id.held_out()).collect()
    assert len(got) > 200 and sum(r.lang == r.lang_pred for r in got) > 0.97 * len(got)
    assert all(0 <= r.score <= 1 for r in got)
    empty = {r.doc_id: r for r in language_id.predict(odd(spark), model).collect()}
    assert all(empty[i].lang_pred == "und" and empty[i].score == 0 for i in (900, 901, 902)) and empty[903].lang_pred in model.languages
    assert language_id.predict(docs.limit(0), model).count() == 0


def test_language_model_of_nothing(spark):
    model = language_id.fit(spark.createDataFrame([], SCHEMA + ", lang string"))
    assert model.languages == [] and {r.lang_pred for r in language_id.predict(odd(spark), model).collect()} == {"und"}


def test_language_ngrams_stay_within_documents():
    index, bounds, has_letter = language_id.ngrams(["ab", "", "1", "c"])
    assert has_letter.tolist() == [True, False, False, True]
    alone = [language_id.ngrams([t])[0] for t in ("ab", "", "1", "c")]
    for n, one in enumerate(index):
        for i in range(4):
            part = one[bounds[i]:bounds[i + 1]]
            assert sorted(part[part < language_id.BUCKETS]) == sorted(x for x in alone[i][n] if x < language_id.BUCKETS)


def plain_hits(docs, items):
    find = lambda t: re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", bytes(c + 32 if 65 <= c <= 90 else c for c in (t or "").encode()))
    windows = {}
    for i, t in items:
        w = find(t)
        k = min(10, len(w))
        for a in range(len(w) - k + 1 if k else 0):
            windows.setdefault(tuple(w[a:a + k]), set()).add(str(i))
    out = []
    for d, t in docs:
        w, held = find(t), set()
        hit = [False] * len(w)
        for k in {len(x) for x in windows}:
            for a in range(len(w) - k + 1):
                if (own := windows.get(tuple(w[a:a + k]))):
                    held |= own
                    hit[a:a + k] = [True] * k
        out.append((d, len(w), sum(hit), sorted(held)))
    return out


@pytest.mark.parametrize("block_words", [2_000_000, 30])
def test_decontamination(spark, block_words):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)]
    some = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(some(rng.choice([1, 2, 4, 6, 9, 10, 11, 30])) if i > 3 else some(25))) for i in range(25)]
    items += [(90, None), (91, ""), (92, "..."), (93, items[0][1]), (94, "Aa a aa " * 8)]
    docs = []
    for i in range(120):
        words = some(rng.randint(0, 60))
        if rng.random() < .6:
            cut = rng.choice(items[:25])[1].split()
            a = rng.randint(0, max(0, len(cut) - 8))
            words[len(words) // 2:len(words) // 2] = cut[a:a + rng.randint(5, 30)]
        docs.append((i, ", ".join(words).upper() if i % 3 else " ".join(words)))
    docs += [*ODD, (800, "aa A aA " * 30)]
    got = decontaminate.find(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id long, text string"), keep=["doc_id"], block_words=block_words).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in got), key=key) == sorted(plain_hits(docs, items), key=key)
    assert all(sum(e - s for s, e in zip(r.spans[::2], r.spans[1::2], strict=True)) == r.n_hit for r in got)


def test_decontamination_without_items(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r.contaminated for r in decontaminate.digests(odd(spark), none).collect()} == {False}
    assert decontaminate.digests(odd(spark).limit(0), none).count() == 0


def plain_base(t):
    t = t or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    n = len(words)
    threes = Counter(tuple(words[i:i + 3]) for i in range(n - 2))
    repeat = [False] * n
    for i in range(n - 2):
        if threes[tuple(words[i:i + 3])] > 1:
            repeat[i:i + 3] = [True] * 3
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return [n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), dup, sum(repeat)]


def test_quality_base_counts():
    rng = random.Random(2)
    bits = ["a", "b", "é", "# ", "\n", "  ", "a b c ", "x\n", "\r\n", "$|", "\t"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 60))) for _ in range(300)] + [None, "", "\n", "a\na\na\n", "\n\na", "a b c a b c"]
    got = []
    for _, raw, bounds in slices(pa.record_batch({"t": pa.array(texts)}), "t", 300):
        base = quality.base_counts(raw, bounds)
        got += [list(r) for r in zip(*(base[c].tolist() for c in quality.BASE), strict=True)]
    assert got == [plain_base(t) for t in texts]


def test_kneser_ney_probabilities_sum_to_one():
    code, _ = quality.codes(["the cat sat", "on the mat", "a", "xyz 123!"])
    seen, n = np.unique(code, return_counts=True)
    model = quality.KneserNey.build(seen, n)
    for context in (0, int(seen[3]) >> 6, int(seen[9]) >> 6, 63 << 12 | 5 << 6 | 1, 777):
        assert model.probabilities((np.arange(64) | context << 6).astype(np.int32)).sum() == pytest.approx(1)


def test_quality_leaves_a_document_s_own_evidence_out():
    """Equal to a model that treats what no other document has as unseen, position by position."""
    texts = ["the cat sat on the mat", "the mat", "zq zq zq xx", "cat"]
    code, first = quality.codes(texts)
    seen, n = np.unique(code, return_counts=True)
    model = quality.KneserNey.build(seen, n)

    def others(i, value, size):
        part = [(c >> 0) & ((1 << 6 * size) - 1) for d in range(len(texts)) if d != i for c in code[first[d]:first[d + 1]].tolist()]
        return value in part

    def context_of_others(i, value, size):
        return value in [(c & ((1 << 6 * size) - 1)) >> 6 for d in range(len(texts)) if d != i for c in code[first[d]:first[d + 1]].tolist()]

    def probability(i, c, size):
        if size == 0:
            return 1 / 64
        c &= (1 << 6 * size) - 1
        if others(i, c, size):
            return model.probs[size - 1][np.searchsorted(model.grams[size - 1], c)]
        weight = model.weights[size - 1][np.searchsorted(model.contexts[size - 1], c >> 6)] if context_of_others(i, c >> 6, size) else 1.0
        return weight * probability(i, c, size - 1)

    expected = [-np.log2(probability(i, int(c), 4)) for i in range(len(texts)) for c in code[first[i]:first[i + 1]]]
    assert model.held_out_bits(code, first) == pytest.approx(expected)


def test_quality_rejects_noise_and_keeps_prose(spark):
    docs = read_table(spark, SF, "documents")
    rng = random.Random(1)
    noise = [(10_000 + i, " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(6)) for _ in range(80)), "en") for i in range(5)]
    rows = docs.select("doc_id", "text", "lang").union(spark.createDataFrame([*noise, (10_100, None, None), (10_101, "", "en")], "doc_id long, text string, lang string"))
    got = {r.doc_id: r for r in quality.judge(rows, keep=["doc_id"]).collect()}
    assert len(got) == docs.count() + 7
    assert not any(got[i].kept for i in (*range(10_000, 10_005), 10_100, 10_101)) and got[10_100].base_failed
    passed = [r for i, r in got.items() if i < 10_000 and not r.base_failed]
    assert sum(r.kept for r in passed) > 0.95 * len(passed)
    for r in docs.limit(50).collect():
        assert [got[r.doc_id][c] for c in quality.BASE] == plain_base(r.text)
    assert quality.judge(docs.limit(0)).count() == 0


def plain_perplexity(rows):
    """Modified Kneser-Ney over code points, by dictionaries: the perplexity of each of (text, lang)."""
    order, pad, out = quality.ORDER, chr(quality.PADDING), [None] * len(rows)
    for lang in {g for _, g in rows}:
        grams = {i: [(pad * (order - 1) + t)[j:j + order] for j in range(len(t))] for i, (t, g) in enumerate(rows) if g == lang and t}
        if not grams:
            continue
        mass = {order: Counter(g for own in grams.values() for g in own)}
        for n in range(order - 1, 0, -1):
            mass[n] = Counter(g[1:] for g in mass[n + 1])
        discount, total, freed = {}, {}, {}
        for n, m in mass.items():
            c = Counter(m.values())
            y = c[1] / (c[1] + 2 * c[2]) if c[1] and c[2] else None
            discount[n] = {k: 0.5 if y is None or not c[k] else min(max(k - (k + 1) * y * c[k + 1] / c[k], 0.05), k) for k in (1, 2, 3)}
            total[n], freed[n] = Counter(), Counter()
            for g, k in m.items():
                total[n][g[:-1]] += k
                freed[n][g[:-1]] += discount[n][min(k, 3)]
        had = {n: {i: {g[order - n:] for g in own} for i, own in grams.items()} for n in mass}
        many = {n: Counter(g for own in had[n].values() for g in own) for n in mass}
        many_contexts = {n: Counter(c for own in had[n].values() for c in {g[:-1] for g in own}) for n in mass}

        def p(g):
            n, c = len(g), g[:-1]
            if not n:
                return 1 / (len(mass[1]) + 1)
            return (mass[n][g] - discount[n][min(mass[n][g], 3)]) / total[n][c] + freed[n][c] / total[n][c] * p(g[1:])

        def q(g):
            n, c = len(g), g[:-1]
            if not n or many[n][g] > 1:
                return p(g)
            return (freed[n][c] / total[n][c] if many_contexts[n][c] > 1 else 1) * q(g[1:])

        for i, own in grams.items():
            out[i] = 2 ** (-sum(np.log2(q(g)) for g in own) / len(own))
    return out


def test_quality_perplexity_is_that_of_a_plain_model(spark, monkeypatch):
    """Over whole code points, in blocks of few texts, copies and empty texts among them."""
    rng = random.Random(3)
    rows = [("".join(rng.choice("abAB é.語\U0001f600\n") for _ in range(rng.randint(0, 80))), rng.choice(["x", "y"])) for _ in range(60)]
    rows += [("", "x"), ("aa", "z"), ("語語語", "x"), (rows[0][0], "y"), *rows[:5]]
    monkeypatch.setattr(quality, "SLICE", 200)
    monkeypatch.setattr(quality, "BLOCK_BYTES", 700)
    docs = spark.createDataFrame([(i, t, g) for i, (t, g) in enumerate(rows)], "doc_id long, text string, lang string").repartition(3)
    packed = quality.blocks(docs.select(F.col("text").alias("body"), F.xxhash64("lang").alias("key")))
    assert packed.select("block").distinct().count() > 3
    got = {r.doc_id: r.perplexity for r in quality.judge(docs, keep=["doc_id"]).collect()}
    for i, expected in enumerate(plain_perplexity(rows)):
        assert got[i] == (None if expected is None else pytest.approx(expected)), rows[i]


def test_quality_rejects_word_salad_and_turned_case(spark):
    """Texts with their words shuffled, of random words of the corpus, and with their case turned: folded classes told none of them from prose."""
    docs = read_table(spark, "/root/testdata/sf0.1", "documents").where("lang = 'en' AND doc_id % 2 = 0").select("doc_id", "text", "lang")
    rng, rows = random.Random(5), []
    real = [r.text for r in docs.where("length(text) > 1500 AND length(text) < 6000").orderBy("doc_id").limit(60).collect()]
    words = sorted({w for t in real for w in t.split()})
    for i, t in enumerate(real[::3]):
        rows.append((10_000_000 + i, " ".join(rng.sample(t.split(), len(t.split()))), "en"))
        rows.append((20_000_000 + i, " ".join(rng.choices(words, k=300)), "en"))
        rows.append((30_000_000 + i, t.swapcase(), "en"))
    got = [r for r in quality.judge(docs.union(spark.createDataFrame(rows, "doc_id long, text string, lang string")), keep=["doc_id"]).collect() if not r.base_failed]
    kept = [[r.kept for r in got if r.doc_id // 10_000_000 == k] for k in range(4)]
    assert sum(kept[0]) > 0.9 * len(kept[0])
    assert all(len(k) > 10 and sum(k) < 0.3 * len(k) for k in kept[1:]), [sum(k) / len(k) for k in kept]


def test_quality_brings_the_scores_to_the_texts(spark, monkeypatch):
    """Texts are written once and not shuffled; a block gets its scores in a few rows, not in one for each n-gram."""
    monkeypatch.setattr(quality, "SLICE", 1000)
    monkeypatch.setattr(quality, "BLOCK_BYTES", 2000)
    rng = random.Random(9)
    docs = spark.createDataFrame([(i, "".join(rng.choice("abcd \U0001f600") for _ in range(90)), f"l{i % 2}") for i in range(200)], "k0 long, body string, lang string").repartition(2)
    packed, drop = bucketed(quality.blocks(docs.withColumn("key", F.xxhash64("lang"))), "texts", 4, "block", "first")
    grams = quality.count_ngrams(packed)
    scores = quality.fit(grams).cache()
    measured = quality.measure(packed, scores, {"k0": "bigint"})
    plan = measured._jdf.queryExecution().executedPlan().toString().splitlines()
    scan = next(i for i, line in enumerate(plan) if "Bucketed: true" in line)
    group = max(i for i, line in enumerate(plan[:scan]) if "CoGroups" in line)
    assert not any("Exchange" in line for line in plan[group:scan])
    found = quality.tables(scores.coalesce(1)).collect()
    pairs = {(b, quality._hash([np.array([ord(c)], np.uint64) for c in r.gram], np.array([r.key]))[0]): r.bits for r in scores.collect() for b in r.blocks}
    got = {(r.block, h): x for r in found for h, x in zip(np.frombuffer(r.hashes, np.uint64), np.frombuffer(r.bits), strict=True)}
    assert got == pairs and len(found) == packed.select("block").distinct().count() > 5
    assert sorted(r.k0 for r in measured.collect()) == list(range(200))
    drop()
    scores.unpersist()
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("texts_")]


def test_quality_scores_of_hashes_with_equal_low_bits():
    h = np.array([(i << 40) + (i % 3) for i in range(300)], np.uint64)
    table = quality._Scores([h[:200].tobytes(), h[200:].tobytes()], [np.arange(200.0).tobytes(), np.arange(200.0, 300.0).tobytes()])
    asked = np.concatenate([h[::-1], h])
    assert table.of(asked).tolist() == [*range(299, -1, -1), *range(300)]
    with pytest.raises(RuntimeError):
        table.of(h + np.uint64(7))
    assert len(quality._Scores([], []).of(h[:0])) == 0


def test_quality_takes_any_number_of_languages(spark):
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.expr("concat('text ', id, ' of a language')").alias("text"), F.col("id").cast("string").alias("lang"))
    assert quality.judge(docs, keep=["doc_id"]).where("perplexity IS NOT NULL").count() == 1000


@pytest.mark.parametrize("junk", ["letters", "boilerplate"])
def test_quality_rejects_a_hot_source_of_junk(spark, junk):
    """A third of the documents is junk: it goes, prose stays."""
    docs = read_table(spark, SF, "documents").where("lang = 'en'").select("doc_id", "text", "lang")
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9)))
    one = " ".join(word() for _ in range(120))
    rows = [(10_000 + i, one if junk == "boilerplate" else " ".join(word() for _ in range(120)), "en") for i in range(docs.count() // 2)]
    got = quality.judge(docs.union(spark.createDataFrame(rows, "doc_id long, text string, lang string")), keep=["doc_id"]).where("NOT base_failed").collect()
    planted, prose = [r.kept for r in got if r.doc_id >= 10_000], [r.kept for r in got if r.doc_id < 10_000]
    assert len(planted) == len(rows) and sum(planted) < 0.01 * len(planted) and sum(prose) > 0.9 * len(prose)


def test_quality_band_of_few_and_of_equal_values():
    for bits, n in (([2.0], [1]), ([2.0, 2.4], [1, 1]), ([2.0, 2.01, 2.1], [1, 1, 1]), ([2.0], [1000])):
        least, most = quality.band(np.array(bits), np.array(n))
        assert least < min(bits) and max(bits) < most


@pytest.fixture(scope="module")
def vocabulary():
    path = public_tokenizers.path(VOCABULARY)
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return path, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_merge_replay_equals_tiktoken(vocabulary):
    path, reference = vocabulary
    with open(path, "rb") as f:
        replay = bpe.MergeReplay(f.read(), public_tokenizers.PATTERN)
    rng = random.Random(1)
    texts = ["".join(rng.choice("aaabbbccch tionéß漢🙂\n '") for _ in range(rng.randint(0, 200))) for _ in range(500)] + ["", "a", "<|endoftext|>", "ab" * 500, "a" * 700]
    got = replay.encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [reference.encode_ordinary(t) for t in texts]
    assert [replay.decode(x) for x in got] == [t.encode() for t in texts]


def test_bpe_digests(spark, vocabulary):
    path, reference = vocabulary
    docs = read_table(spark, SF, "documents").select("doc_id", "text").limit(200).union(odd(spark))
    rows = docs.collect()
    got = bpe.encode(spark.createDataFrame(rows, SCHEMA).withColumn("n_tokens", F.lit("x")), path, public_tokenizers.PATTERN).collect()
    by_text = {r.text: r for r in got}
    assert len(got) == len(rows)
    for r in rows:
        ids = reference.encode_ordinary(r.text or "")
        assert by_text[r.text].n_tokens == len(ids) and np.frombuffer(by_text[r.text].ids, "<u4").tolist() == ids
    assert bpe.digests(docs.limit(0), path, public_tokenizers.PATTERN).count() == 0


def test_toxicity_learns_marked_words(spark):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(400)]
    rows, labels = [], []
    for i in range(900):
        text = [rng.choice(words) for _ in range(rng.randint(5, 120))]
        toxic = i % 5 == 0
        if toxic:
            text.insert(rng.randrange(len(text)), rng.choice(["scum", "moron"]))
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows + ODD, SCHEMA)
    marked = spark.createDataFrame([*labels, (3, None), (None, 1), (77_777, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, marked.where("doc_id % 4 <> 2 OR doc_id IS NULL"))
    got = toxicity.score(docs.where("doc_id % 4 = 2 AND doc_id < 900"), model).collect()
    truth = dict(labels)
    assert sum(r.predicted == truth[r.doc_id] for r in got) >= 0.99 * len(got) and len(model[0]) < 5000
    odd_scores = toxicity.score(odd(spark), model).collect()
    assert all(0 <= r.score <= 1 and r.predicted == 0 for r in odd_scores) and len(odd_scores) == len(ODD)
    assert toxicity.score(docs.limit(0), model).count() == 0
    untaught = toxicity.fit(docs, marked.limit(0))
    assert {r.score for r in toxicity.score(odd(spark), untaught).collect()} == {0.5}


def test_toxicity_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = read_table(spark, sf, "documents"), read_table(spark, sf, "labels")
    model = toxicity.fit(docs, labels.where(~language_id.held_out()))
    got = toxicity.score(docs, model, keep=["doc_id"]).join(labels, "doc_id").where(language_id.held_out()).collect()
    caught = sum(r.predicted for r in got if r.toxic) / sum(r.toxic for r in got)
    wrong = sum(r.predicted for r in got if not r.toxic) / sum(1 - r.toxic for r in got)
    assert caught > 0.8 and wrong < 0.02
