"""The 55 explainable features in 8 dimensions.

Every feature is a row-local native expression over the flat table.  The
pipeline is three narrow projections:

1. lower-cased / split helper columns, computed once (so ``lower`` is not
   re-inlined per keyword set),
2. base features,
3. features derived from base features (ratios, composite, trust score),

followed by dropping the helpers.  Catalyst keeps the stages apart whenever
collapsing them would duplicate a non-trivial expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..config import DEFAULT, RankConfig
from ..functions import text as X
from ..functions.numeric import clip, ladder

HELPERS = {
    "_title": lambda: X.lower0("profile_current_title"),
    "_desc": lambda: X.lower0("career_all_descriptions"),
    "_headline": lambda: X.lower0("profile_headline"),
    "_summary": lambda: X.lower0("profile_summary"),
    "_skills": lambda: X.lower0("skills_names"),
    "_titles": lambda: X.split_items(X.lower0("career_all_titles")),
    "_comps": lambda: X.split_items(X.lower0("career_all_companies")),
    "_skill_items": lambda: X.split_items(X.lower0("skills_names")),
    "_company": lambda: X.lower0("profile_current_company"),
    "_degree": lambda: X.lower0("edu_highest_degree"),
    "_location": lambda: X.lower0("profile_location"),
    "_fields": lambda: X.lower0("edu_fields"),
}


def _int(c: Column) -> Column:
    return X.bool_int(c)


def base_features(cfg: RankConfig = DEFAULT) -> dict[str, Column]:
    t, desc, skills = "_title", "_desc", "_skills"
    titles, comps, items = "_titles", "_comps", "_skill_items"
    years = F.coalesce(F.col("profile_years_of_exp"), F.lit(0.0)).cast("double")
    z = (years - F.lit(cfg.ideal_years)) / F.lit(cfg.ideal_years_sigma)
    adv = F.col("skills_advanced_count")
    return {
        # D1 role & title
        "feat_dim1_is_eng_title": _int(X.in_set(t, cfg.engineering_titles)),
        "feat_dim1_is_ai_title": _int(X.any_substring(t, C.AI_TITLE_WORDS)),
        "feat_dim1_is_non_eng_title": _int(X.in_set(t, cfg.non_engineering_titles)),
        "feat_dim1_ever_eng_title": _int(X.any_member(titles, cfg.engineering_titles)),
        "feat_dim1_eng_title_ratio": X.member_ratio(titles, cfg.engineering_titles),
        "feat_dim1_is_senior": _int(X.any_substring(t, C.SENIOR_TITLE_WORDS)),
        # D2 production ML
        "feat_dim2_production_kw_count": X.count_substrings(desc, cfg.production_keywords).cast("long"),
        "feat_dim2_retrieval_kw_count": X.count_substrings(desc, cfg.retrieval_keywords).cast("long"),
        "feat_dim2_research_kw_count": X.count_substrings(desc, cfg.research_keywords).cast("long"),
        "feat_dim2_wrapper_kw_count": X.count_substrings(desc, cfg.wrapper_keywords).cast("long"),
        "feat_dim2_summary_production": _int(X.any_substring("_summary", cfg.production_keywords)),
        # D3 retrieval domain
        "feat_dim3_retrieval_skill_count": X.count_substrings(skills, cfg.retrieval_keywords).cast("long"),
        "feat_dim3_headline_retrieval": _int(X.any_substring("_headline", C.RETRIEVAL_CORE_WORDS)
                                             | X.any_substring("_summary", C.RETRIEVAL_CORE_WORDS)),
        "feat_dim3_recommendation_exp": _int(F.contains(desc, F.lit("recommendation"))),
        "feat_dim3_search_system_exp": _int(X.strip_then_contains(desc, C.SEARCH_FALSE_POSITIVES, "search")),
        # D4 technical stack
        "feat_dim4_must_have_count": X.count_members(items, cfg.must_have_skills).cast("long"),
        "feat_dim4_nice_to_have_count": X.count_members(items, cfg.nice_to_have_skills).cast("long"),
        "feat_dim4_irrelevant_count": X.count_members(items, cfg.irrelevant_skills).cast("long"),
        "feat_dim4_has_python": _int(F.array_contains(items, "python")),
        "feat_dim4_total_skills": F.coalesce(F.col("skills_count"), F.lit(0)).cast("long"),
        "feat_dim4_assessment_avg": _assessment_avg(F.col("sig_assessment_scores")),
        # D5 experience band
        "feat_dim5_years_exp": years,
        "feat_dim5_exp_band_score": F.exp(F.lit(-0.5) * (z * z)),
        "feat_dim5_in_ideal_range": _int(years.between(cfg.ideal_range[0], cfg.ideal_range[1])),
        "feat_dim5_too_junior": _int(years < F.lit(cfg.too_junior_below)),
        "feat_dim5_too_senior": _int(years > F.lit(cfg.too_senior_above)),
        # D6 company & career type
        "feat_dim6_current_consulting": _int(X.in_set("_company", cfg.consulting_firms)),
        "feat_dim6_consulting_only": _int(X.all_members(comps, cfg.consulting_firms)),
        "feat_dim6_consulting_ratio": X.member_ratio(comps, cfg.consulting_firms),
        "feat_dim6_product_company_count": X.count_distinct_members(comps, cfg.product_companies).cast("long"),
        "feat_dim6_avg_tenure": F.coalesce(F.col("career_avg_tenure_months"), F.lit(0.0)).cast("double"),
        # D7 location & logistics
        "feat_dim7_is_india": _int(X.lower0("profile_country") == F.lit("india")),
        "feat_dim7_preferred_city": _int(X.any_substring("_location", cfg.preferred_cities)),
        "feat_dim7_tier1_city": _int(X.any_substring("_location", cfg.tier1_cities)),
        "feat_dim7_notice_period": F.coalesce(F.col("sig_notice_period_days"), F.lit(180)).cast("long"),
        "feat_dim7_willing_relocate": _int(F.col("sig_willing_relocate")),
        "feat_dim7_workmode_score": X.lookup(X.lower0("sig_work_mode"), C.WORKMODE_SCORE, 0.5),
        "feat_dim7_salary_reasonable": _int(_salary_ok()),
        # D8 education
        "feat_dim8_best_tier": X.lookup(X.lower0("edu_best_tier"), C.TIER_NUMBER, 4).cast("long"),
        "feat_dim8_relevant_field": _int(X.any_substring("_fields", C.RELEVANT_FIELDS)),
        "feat_dim8_has_grad_degree": _int(X.in_set("_degree", C.GRAD_DEGREES)),
        # skill trust inputs kept for the next stage
        "_adv": adv,
    }


def _assessment_avg(m: Column) -> Column:
    vals = F.map_values(m)
    n = F.size(vals)
    return F.when(m.isNotNull() & (n > 0),
                  F.aggregate(vals, F.lit(0.0), lambda a, v: a + v) / n).otherwise(F.lit(-1.0))


def _salary_ok() -> Column:
    lo = F.coalesce(F.col("sig_salary_min"), F.lit(0.0))
    hi = F.coalesce(F.col("sig_salary_max"), F.lit(0.0))
    return (lo <= hi) & (hi <= F.lit(60.0)) & (lo >= F.lit(10.0))


def derived_features(cfg: RankConfig = DEFAULT) -> dict[str, Column]:
    f = F.col
    prod, research = f("feat_dim2_production_kw_count"), f("feat_dim2_research_kw_count")
    must, irr = f("feat_dim4_must_have_count"), f("feat_dim4_irrelevant_count")
    adv = f("_adv")
    endorse = F.coalesce(f("skills_total_endorsements"), F.lit(0))
    avg_end = endorse / F.greatest(adv, F.lit(1))           # only read when adv > 0
    relevant_ratio = must / (must + irr + F.lit(1))
    return {
        "feat_dim2_shipped_ml": _int((prod > 0) & X.any_substring("_desc", C.ML_WORDS)),     # the keywords are counted already
        "feat_dim2_production_ratio": prod / (prod + research + F.lit(1)),
        "feat_dim3_retrieval_desc_count": f("feat_dim2_retrieval_kw_count"),
        "feat_dim3_retrieval_composite": (
            (clip(f("feat_dim2_retrieval_kw_count"), 0, 5) / F.lit(5)) * F.lit(0.4)
            + (clip(f("feat_dim3_retrieval_skill_count"), 0, 5) / F.lit(5)) * F.lit(0.2)
            + f("feat_dim3_headline_retrieval") * F.lit(0.2)
            + f("feat_dim3_recommendation_exp") * F.lit(0.1)
            + f("feat_dim3_search_system_exp") * F.lit(0.1)
        ),
        "feat_dim4_relevant_ratio": relevant_ratio,
        "feat_dim4_skill_trust_score": (
            F.when(adv == 0, F.lit(0.5))
             .when((adv >= 6) & (avg_end < 3), F.lit(0.2))
             .when((adv >= 4) & (avg_end >= 10), F.lit(1.0))
             .otherwise(F.lit(0.6))
        ),
        "feat_dim4_advanced_relevant": (adv * relevant_ratio).cast("long"),
        "feat_dim4_relevant_skill_duration": F.coalesce(f("skills_avg_duration"), F.lit(0.0)) * relevant_ratio,
        "feat_dim6_has_product_exp": (f("feat_dim6_product_company_count") > 0).cast("long"),
        "feat_dim6_is_title_chaser": ((f("feat_dim6_avg_tenure") < 18.0) & (f("career_num_jobs") >= 3)).cast("long"),
        "feat_dim6_career_consistency": f("feat_dim1_eng_title_ratio"),
        "feat_dim7_notice_score": ladder(f("feat_dim7_notice_period"), C.NOTICE_LADDER, C.NOTICE_DEFAULT),
        "feat_dim8_good_institution": (f("feat_dim8_best_tier") <= 2).cast("long"),
        "feat_dim8_tier_score": X.lookup(f("feat_dim8_best_tier"), C.TIER_SCORE, 0.3),
    }


# output order: dimension by dimension, as documented
FEATURE_COLUMNS = [
    "feat_dim1_is_eng_title", "feat_dim1_is_ai_title", "feat_dim1_is_non_eng_title",
    "feat_dim1_ever_eng_title", "feat_dim1_eng_title_ratio", "feat_dim1_is_senior",
    "feat_dim2_production_kw_count", "feat_dim2_retrieval_kw_count", "feat_dim2_research_kw_count",
    "feat_dim2_wrapper_kw_count", "feat_dim2_production_ratio", "feat_dim2_shipped_ml",
    "feat_dim2_summary_production",
    "feat_dim3_retrieval_desc_count", "feat_dim3_retrieval_skill_count", "feat_dim3_headline_retrieval",
    "feat_dim3_recommendation_exp", "feat_dim3_search_system_exp", "feat_dim3_retrieval_composite",
    "feat_dim4_must_have_count", "feat_dim4_nice_to_have_count", "feat_dim4_irrelevant_count",
    "feat_dim4_has_python", "feat_dim4_total_skills", "feat_dim4_relevant_ratio",
    "feat_dim4_skill_trust_score", "feat_dim4_advanced_relevant", "feat_dim4_relevant_skill_duration",
    "feat_dim4_assessment_avg",
    "feat_dim5_years_exp", "feat_dim5_exp_band_score", "feat_dim5_in_ideal_range",
    "feat_dim5_too_junior", "feat_dim5_too_senior",
    "feat_dim6_current_consulting", "feat_dim6_consulting_only", "feat_dim6_consulting_ratio",
    "feat_dim6_product_company_count", "feat_dim6_has_product_exp", "feat_dim6_avg_tenure",
    "feat_dim6_is_title_chaser", "feat_dim6_career_consistency",
    "feat_dim7_is_india", "feat_dim7_preferred_city", "feat_dim7_tier1_city",
    "feat_dim7_notice_period", "feat_dim7_notice_score", "feat_dim7_willing_relocate",
    "feat_dim7_workmode_score", "feat_dim7_salary_reasonable",
    "feat_dim8_best_tier", "feat_dim8_good_institution", "feat_dim8_relevant_field",
    "feat_dim8_has_grad_degree", "feat_dim8_tier_score",
]


def dimension_columns(dim: int) -> list[str]:
    return [c for c in FEATURE_COLUMNS if c.startswith(f"feat_dim{dim}_")]


def add_features(flat: DataFrame, cfg: RankConfig = DEFAULT) -> DataFrame:
    """The flat table plus all 55 ``feat_*`` columns."""
    base_cols = list(flat.columns)
    staged = flat.select("*", *[fn().alias(n) for n, fn in HELPERS.items()])
    staged = staged.select("*", *[c.alias(n) for n, c in base_features(cfg).items()])
    staged = staged.select("*", *[c.alias(n) for n, c in derived_features(cfg).items()])
    return staged.select(*base_cols, *FEATURE_COLUMNS)
