import pytest
from conftest import base_record, records_df, with_profile, with_signals

from talentlens.operators.features import FEATURE_COLUMNS, add_features
from talentlens.operators.flatten import flatten


def feats(spark, recs):
    return {r.candidate_id: r for r in add_features(flatten(records_df(spark, recs))).collect()}


def test_55_features(spark):
    df = add_features(flatten(records_df(spark, [base_record()])))
    assert len(FEATURE_COLUMNS) == 55 and len(set(FEATURE_COLUMNS)) == 55
    assert [c for c in df.columns if c.startswith("feat_")] == FEATURE_COLUMNS


def test_substring_semantics(spark):
    rec = base_record()
    rec["career_history"][0]["description"] = "Owned the roadmap; ran A/B testing on storage"
    rec["career_history"][1]["description"] = "job search page; search for talent"
    r = feats(spark, [rec])["CAND_0000001"]
    # "map" hits roadmap, "rag" hits storage; both a/b keywords count (distinct keywords)
    assert r.feat_dim2_retrieval_kw_count >= 2
    assert r.feat_dim2_production_kw_count == 2
    assert r.feat_dim3_search_system_exp == 0       # false-positive phrases stripped
    assert r.feat_dim3_retrieval_desc_count == r.feat_dim2_retrieval_kw_count


def test_title_case_and_strip_rules(spark):
    rec = with_profile(base_record(), current_title="Retail Manager", current_company="TCS ")
    rec["career_history"][0]["company"] = " tcs "
    rec["career_history"][1]["company"] = "Infosys"
    r = feats(spark, [rec])["CAND_0000001"]
    assert r.feat_dim1_is_ai_title == 1            # "ai" inside "retail"
    assert r.feat_dim6_current_consulting == 0     # current value is not stripped
    assert r.feat_dim6_consulting_only == 1 and r.feat_dim6_consulting_ratio == 1.0   # history is stripped


def test_empty_history_ratios(spark):
    r = feats(spark, [base_record(career_history=[])])["CAND_0000001"]
    assert r.feat_dim6_consulting_only == 0 and r.feat_dim6_consulting_ratio == 0.0
    assert r.feat_dim1_eng_title_ratio == 0.0 and r.feat_dim1_ever_eng_title == 0


@pytest.mark.parametrize("days,score", [(30, 1.0), (31, 0.8), (60, 0.8), (61, 0.5), (90, 0.5), (91, 0.3),
                                        (120, 0.3), (121, 0.1)])
def test_notice_ladder(spark, days, score):
    r = feats(spark, [with_signals(base_record(), notice_period_days=days)])["CAND_0000001"]
    assert r.feat_dim7_notice_score == score


def test_skill_trust_branches(spark):
    def sk(n, prof, endorse):
        return [{"name": f"s{i}", "proficiency": prof, "endorsements": endorse} for i in range(n)]
    recs = [base_record(1, skills=sk(2, "beginner", 0)),        # adv 0 → .5
            base_record(2, skills=sk(6, "expert", 2)),          # adv 6, avg 2 → .2
            base_record(3, skills=sk(4, "advanced", 10)),       # adv 4, avg 10 → 1.0
            base_record(4, skills=sk(3, "advanced", 1))]        # else → .6
    f = feats(spark, recs)
    assert [f[f"CAND_000000{i}"].feat_dim4_skill_trust_score for i in range(1, 5)] == [0.5, 0.2, 1.0, 0.6]


def test_assessment_avg_and_lists(spark):
    rec = with_signals(base_record(), skill_assessment_scores={})
    rec["skills"] = [{"name": "Python "}, {"name": "FAISS"}, {"name": "OpenCV"}, {"name": "python"}]
    r = feats(spark, [rec])["CAND_0000001"]
    assert r.feat_dim4_assessment_avg == -1.0
    assert r.feat_dim4_must_have_count == 3            # python (stripped) twice + faiss
    assert r.feat_dim4_irrelevant_count == 1 and r.feat_dim4_has_python == 1
    assert r.feat_dim4_relevant_ratio == 3 / 5


def test_experience_band(spark):
    r = feats(spark, [with_profile(base_record(), years_of_experience=7.0)])["CAND_0000001"]
    assert r.feat_dim5_exp_band_score == 1.0 and r.feat_dim5_in_ideal_range == 1


def test_history_items_strip_all_python_whitespace(spark):
    rec = base_record()
    rec["career_history"][0]["company"] = "\ttcs "
    rec["career_history"][1]["company"] = "　infosys\n"
    r = feats(spark, [rec])["CAND_0000001"]
    assert r.feat_dim6_consulting_only == 1


def test_keyword_groups_hold_every_keyword_and_only_texts_with_the_guard():
    from talentlens.config import DEFAULT as cfg
    from talentlens.functions import text as X
    for words in (cfg.production_keywords, cfg.retrieval_keywords, cfg.research_keywords, cfg.wrapper_keywords, ("a", "ab", "abc"), ()):
        words = tuple(dict.fromkeys(words))
        plan = X.keyword_plan(words)
        assert sorted(k for _, members in plan for k in members) == sorted(words)
        assert all(guard in k for guard, members in plan if guard is not None for k in members)
        assert sum(len(m) if g is None else 1 for g, m in plan) <= len(words)
        short = X._shortest(words)
        assert all(any(s in k for s in short) for k in words)
    assert X._shortest(("search", "vector search", "map", "search")) == ["search", "map"]


def test_keyword_counts_equal_plain_counts(spark):
    import random

    from talentlens.config import DEFAULT as cfg
    from talentlens.functions import text as X
    rng = random.Random(2)
    sets = (cfg.production_keywords, cfg.retrieval_keywords, cfg.research_keywords, cfg.wrapper_keywords, ("é", "日本", "日本語"), ("a.b", "%", "_", "\\"))
    words = [k for s in sets for k in s]
    texts = [None, "", *words, *("".join(rng.choice([*words, " ", "ing", "xsearchx", "roadmap"])[:rng.randint(1, 30)] for _ in range(rng.randint(1, 9))) for _ in range(400))]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", *[X.count_substrings("t", s).alias(f"n{i}") for i, s in enumerate(sets)], *[X.bool_int(X.any_substring("t", s)).alias(f"a{i}") for i, s in enumerate(sets)])
    for r in got.collect():
        counts = [sum(k in (r.t or "") for k in dict.fromkeys(s)) if r.t is not None else 0 for s in sets]
        assert [r[f"n{i}"] for i in range(len(sets))] == counts and [r[f"a{i}"] for i in range(len(sets))] == [int(c > 0) for c in counts]


def test_keyword_features_run_no_interpreted_scan_for_each_keyword(spark):
    from conftest import SF001

    from talentlens.operators import features
    from talentlens.plans import pipeline as PL
    plan = features.add_features(PL.flat_candidates(spark, SF001)).select(*features.dimension_columns(2))._jdf.queryExecution().executedPlan().toString()
    assert "lambdafunction(Contains" not in plan and "lambdafunction(contains" not in plan.lower() and "Contains(" in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_small_inputs_are_spread_and_large_ones_stay(spark):
    from talentlens.session import read_table, spread
    docs = read_table(spark, "/root/testdata/sf0.001", "documents")
    assert spread(docs).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        assert "Exchange" not in spread(docs)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
