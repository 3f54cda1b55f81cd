"""The registered queries' columns, and the pipeline against brute force on a small fixture."""

import random

import pytest
from test_dedup_operators import removed_words, simhash_components
from test_text_operators import plain_hits

import corpus_pipeline
from talentlens.llm import language_id, toxicity
from talentlens.llm.queries import ORACLE, QUERIES

COLUMNS = {
    "op1_": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op2_": ["doc_id", "held_out", "lang_pred", "score"],
    "op3_": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op4_": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op5_": ["doc_id", "fingerprint", "component_id"],
    "op6_": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op7_": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op8_": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op9_": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op10_": ["doc_id", "held_out", "score", "predicted"],
    "op11_": ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"],
    "op12_": ["item_id", "rank", "doc_id", "score"],
    "op13_": ["doc_id", "n_shingles", "component_id", "kept"],
}


def test_every_operator_has_one_query_and_sql_only_for_queries():
    assert sorted(q[:q.index("_") + 1] for q in QUERIES) == sorted(COLUMNS)
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_returns_its_columns_for_every_row(spark, name):
    sf = "/root/testdata/sf0.001"
    got = QUERIES[name](spark, sf)
    assert got.columns[:len(COLUMNS[name[:name.index("_") + 1]])] == COLUMNS[name[:name.index("_") + 1]]
    if not name.startswith("op12_"):                            # a ranking: at most ten rows an item
        table = {"op7_": "pages", "op11_": "embeddings"}.get(name[:name.index("_") + 1], "documents")
        assert got.count() == spark.read.parquet(f"{sf}/{table}.parquet").count()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(12)
    vocabulary = [f"w{i}" for i in range(500)]
    some = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage, item = some(70), some(20)
    docs, labels = [], []
    for i in range(240):
        words = some(rng.randint(20, 150))
        if i % 6 == 0:
            words.insert(5, "scum")
        if i % 11 == 1:
            words[10:10] = passage
        if i % 17 == 2:
            words[3:3] = item[:rng.randint(10, 20)]
        docs.append((i, "\n".join([" ".join(words[:9]), " ".join(words[9:])]), "en", "s", 0))
        labels.append((i, 1, int(i % 6 == 0)))
    docs += [(300, docs[7][1], "en", "s", 0), (301, docs[8][1] + " tail", "en", "s", 0), (302, None, None, None, None), (303, "", "en", "s", 0), (304, " ".join(passage), "en", "s", 0), docs[9]]
    sf = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, " ".join(item))], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    return sf, docs, " ".join(item)


def test_stages_and_run(spark, tables):
    sf, rows, item = tables
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.fit(docs, labels.where(~language_id.held_out()))
    toxic = {r.doc_id for r in toxicity.score(docs, model).where("predicted = 1").collect()}
    marked = {i for i, t, *_ in rows if t and "scum" in t.split()}
    assert toxic <= marked and len(toxic) > 0.9 * len(marked)
    left = [(i, t) for i, t, *_ in rows if i not in toxic]
    components = simhash_components(left)
    kept = {}
    for (i, t), (_, _, c) in zip(left, components, strict=True):
        if i == c:
            kept[i] = t
    left = sorted(kept.items())
    texts = []
    for (i, t), (_, n, removed, _) in zip(left, removed_words(left, 50), strict=True):
        if removed == 0:
            texts.append((i, t or ""))
        elif removed < n:
            texts.append((i, None))                       # cut; its words are checked below
    cut = {i for i, t in texts if t is None}
    assert cut
    seen = docs
    for name, apply in corpus_pipeline.STAGES[:3]:
        seen = apply(spark, seen, sf)
        assert seen.columns == docs.columns, name
    got = {r.doc_id: r for r in seen.collect()}
    assert set(got) == {i for i, _ in texts}
    assert all(got[i].text == t for i, t in texts if t is not None)
    assert all(got[i].n_chars == len(got[i].text) for i in got)
    for i in cut:
        words = kept[i].split()
        n, removed = next((n, r) for d, n, r, _ in removed_words(left, 50) if d == i)
        assert len(got[i].text.split()) == n - removed and set(got[i].text.split()) <= set(words)
    clean = {d for d, _, hit, _ in plain_hits([(i, r.text) for i, r in got.items()], [(1, item)]) if not hit}
    assert clean != set(got)
    result = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id for r in result} == clean and all(r.exact for r in result)


def test_pipeline_of_nothing_and_of_more_columns(spark, tables, tmp_path):
    sf, _, _ = tables
    docs = spark.read.parquet(f"{sf}/documents.parquet").selectExpr("*", "'a' AS score", "1 AS fp", "'b' AS id", "2 AS n_words", "3 AS spans", "4 AS row")
    for name, apply in corpus_pipeline.STAGES[:4]:
        out = apply(spark, docs, sf)
        assert out.columns == docs.columns, name
        first = out.where("doc_id = 1").first()
        assert (first.score, first.fp, first.id, first.n_words, first.spans, first.row) == ("a", 1, "b", 2, 3, 4), name
        assert apply(spark, docs.limit(0), sf).count() == 0
    assert corpus_pipeline.STAGES[4][1](spark, docs.limit(0), sf).count() == 0
