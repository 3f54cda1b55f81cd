"""DuckDB oracle SQL for the registered queries.

This is a second, independent formulation used only for checking: the flat
candidate table is derived *relationally* (window + GROUP BY + string_agg) from
the driver tables, whereas the Spark engine builds nested records and
flattens them with array functions.  Decimal literals are written as DOUBLE
so both engines do the same IEEE arithmetic.
"""

from __future__ import annotations

from .. import config as C
from ..config import DEFAULT, RubricConfig
from ..sources import fixture_pools as P


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def lst(values) -> str:
    return "[" + ", ".join(q(v) if isinstance(v, str) else repr(v) for v in values) + "]"


def inlist(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def d(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def pick(pool, expr: str) -> str:
    return f"{lst(pool)}[(({expr}) % {len(pool)}) + 1]"


def lower0(c: str) -> str:
    return f"lower(coalesce({c}, ''))"


def any_sub(text: str, kws) -> str:
    return f"(len(list_filter({lst(dict.fromkeys(kws))}, lambda w: contains({text}, w))) > 0)"


def count_sub(text: str, kws) -> str:
    return f"CAST(len(list_filter({lst(dict.fromkeys(kws))}, lambda w: contains({text}, w))) AS BIGINT)"


def ws_chars() -> str:
    from ..functions.text import PY_WHITESPACE
    return " || ".join(f"chr({ord(ch)})" for ch in PY_WHITESPACE)


def pystrip(x: str) -> str:
    return f"trim({x}, {ws_chars()})"


def items(c: str) -> str:
    return f"list_filter(list_transform(string_split({lower0(c)}, '|'), lambda x: {pystrip('x')}), lambda x: x <> '')"


def count_mem(it: str, values) -> str:
    return f"CAST(len(list_filter({it}, lambda x: x IN {inlist(values)})) AS BIGINT)"


def b(cond: str) -> str:
    return f"CAST(coalesce({cond}, false) AS BIGINT)"


def case_map(expr: str, pairs, default) -> str:
    whens = " ".join(f"WHEN {expr} = {q(k) if isinstance(k, str) else k} THEN "
                     f"{d(v) if isinstance(v, float) else v}" for k, v in pairs)
    dflt = d(default) if isinstance(default, float) else default
    return f"(CASE {whens} ELSE {dflt} END)"


def ladder(expr: str, steps, default) -> str:
    whens = " ".join(f"WHEN {expr} <= {bound} THEN {d(score)}" for bound, score in steps)
    return f"(CASE {whens} ELSE {d(default)} END)"


def scaled_half_even(x: str, scale: float) -> str:
    """Same error-free rounding as the engine (see functions.numeric.scaled_half_even)."""
    sc = d(float(scale))
    t = f"(({x}) * {d(134217729.0)})"
    hi = f"({t} - ({t} - ({x})))"
    lo = f"(({x}) - {hi})"
    p = f"(({x}) * {sc})"
    e = f"(({hi} * {sc} - {p}) + {lo} * {sc})"
    tie = f"({p} - floor({p}) = {d(0.5)})"
    return (f"CAST(CASE WHEN {tie} AND {e} > 0 THEN ceil({p}) WHEN {tie} AND {e} < 0 THEN floor({p}) "
            f"ELSE round_even({p}, 0) END AS DOUBLE)")


def r9(expr: str) -> str:
    return f"CAST(round_even(({expr}) * {d(1e9)}, 0) / {d(1e9)} AS DOUBLE)"


# ---------------------------------------------------------------------------
# flat candidate table
# ---------------------------------------------------------------------------

def number(order_key: str) -> str:
    whens = " ".join(f"WHEN {order_key} % {P.BLOCK} < {upto} THEN {sub}" for sub, upto in enumerate(P.BLOCK_CUTS))
    return f"(({order_key} // {P.BLOCK}) * 7 + CASE {whens} END)"


def flat_ctes() -> str:
    k = "k"
    deg1, deg2 = pick(P.DEGREES, "k"), pick(P.DEGREES, "k + 3")
    tier1, tier2 = pick(P.TIERS, "k"), pick(P.TIERS, "k + 2")
    deg_rank = lambda e: case_map(f"lower({e})", C.DEGREE_RANK, 1)
    tier_rank = lambda e: case_map(f"lower({e})", C.TIER_RANK, 0)
    years = (f"CASE WHEN k % 5 = 0 THEN CAST(k % 180 AS DOUBLE) / {d(10.0)} "
             f"ELSE CAST((CAST(coalesce(total_months, 0) AS BIGINT) * 10) // 12 AS DOUBLE) / {d(10.0)} END")
    last_active = ("CASE WHEN k % 41 = 0 THEN 'not-a-date' WHEN k % 19 = 0 THEN '2022-06-01' "
                   "ELSE strftime(DATE '2026-06-01' - CAST((k * 29) % 260 AS INTEGER), '%Y-%m-%d') END")
    return f"""
ord AS (
  SELECT {number('o_orderkey')} AS k, o_custkey AS ck, o_orderkey AS ok, o_orderdate AS od,
         row_number() OVER (PARTITION BY {number('o_orderkey')} ORDER BY o_orderdate, o_orderkey) AS rn
  FROM orders),
jobs AS (
  SELECT k, rn, ck,
    CASE WHEN k % 11 = 0 THEN {pick(P.CONSULTING, 'ok')} ELSE {pick(P.COMPANIES, 'ok')} END AS company,
    {pick(P.TITLES, 'k + 3 * (rn - 1)')} AS title,
    {pick(P.INDUSTRIES, 'ok')} AS industry,
    {pick(P.DESCRIPTIONS, 'ok + rn')} AS description,
    CAST(CASE WHEN k % 23 = 0 THEN 260 + ok % 40 WHEN k % 13 = 0 THEN 6 + ok % 10 ELSE 6 + ok % 40 END AS DOUBLE) AS dur,
    (rn = 1 OR (k % 37 = 0 AND rn = 2)) AS is_current,
    CASE WHEN ok % 53 = 0 THEN '10000+' WHEN ok % 47 <> 0 THEN {pick(P.COMPANY_SIZES, 'ok')} END AS size_text,
    CASE WHEN ok % 61 = 0 THEN strftime(od, '%m/%d/%Y') ELSE strftime(od, '%Y-%m-%d') END AS start_text
  FROM ord),
cr AS (
  SELECT k, arg_min(ck, rn) AS ck,
    string_agg(title, '|' ORDER BY rn) AS titles,
    string_agg(company, '|' ORDER BY rn) AS companies,
    string_agg(industry, '|' ORDER BY rn) AS industries,
    string_agg(description, chr(10) ORDER BY rn) AS descriptions,
    count(*) AS n_jobs, sum(dur) AS total_months,
    arg_max(company, rn) FILTER (WHERE is_current) AS cur_company,
    arg_max(title, rn) FILTER (WHERE is_current) AS cur_title
  FROM jobs GROUP BY k),
parts AS (
  SELECT l_orderkey, CAST(ceil(count(*) / {P.ORDER_ITEMS}) AS BIGINT) AS parts FROM lineitem GROUP BY l_orderkey),
dealt AS (
  SELECT l.*, (l.l_partkey * 31 + l.l_suppkey * 17 + l.l_linenumber) % p.parts AS part
  FROM lineitem l JOIN parts p ON l.l_orderkey = p.l_orderkey),
numbered AS (
  SELECT *, CASE WHEN part = 0 THEN {number('l_orderkey')} ELSE (l_orderkey * 1048576 + part) * 7 + 6 END AS k FROM dealt),
li AS (
  SELECT k, l_partkey, l_suppkey, l_quantity,
    row_number() OVER (PARTITION BY k ORDER BY l_orderkey, l_linenumber, l_partkey,
                       l_suppkey, l_extendedprice, l_quantity) AS rn
  FROM numbered),
sk AS (
  SELECT k, rn, {pick(P.SKILLS, 'l_partkey')} AS name,
    CASE WHEN k % 17 = 0 THEN 'expert' ELSE {pick(P.LEVELS, 'l_partkey // 7')} END AS prof,
    CAST(CASE WHEN k % 17 = 0 THEN 0 ELSE CAST(trunc(l_quantity) AS BIGINT) END AS DOUBLE) AS endorse,
    CAST((l_suppkey * 3) % 60 AS DOUBLE) AS dur
  FROM li),
sa AS (
  SELECT k, string_agg(lower(name), '|' ORDER BY rn) AS names, count(*) AS n_sk,
    count(*) FILTER (WHERE lower(prof) IN ('advanced', 'expert')) AS adv,
    sum(endorse) AS endorse, sum(dur) AS dur_total, arg_min(name, rn) AS first_skill
  FROM sk GROUP BY k),
history AS (
  SELECT coalesce(cr.k, sa.k) AS k, cr.* EXCLUDE (k), sa.* EXCLUDE (k) FROM cr FULL OUTER JOIN sa ON cr.k = sa.k
  UNION ALL BY NAME SELECT c_custkey * 7 + 5 AS k, c_custkey AS ck FROM customer),
cbase AS (
  SELECT h.*, c.c_mktsegment, c.c_name FROM history h LEFT JOIN customer c ON c.c_custkey = h.ck),
cand AS (
  SELECT
    'CAND_' || CASE WHEN k < 1000000 THEN lpad(CAST(k AS VARCHAR), 7, '0') ELSE CAST(k AS VARCHAR) END AS candidate_id,
    {pick(P.HEADLINES, 'k')} AS profile_headline,
    {pick(P.DESCRIPTIONS, 'k * 5')} AS profile_summary,
    {pick(P.LOCATIONS, 'k * 3')} AS profile_location,
    {pick(P.COUNTRIES, 'k * 3')} AS profile_country,
    {years} AS profile_years_of_exp,
    {pick(P.TITLES, 'k')} AS profile_current_title,
    CASE WHEN k % 11 = 0 THEN {pick(P.CONSULTING, 'k')} ELSE {pick(P.COMPANIES, 'k')} END AS profile_current_company,
    {pick(P.COMPANY_SIZES, 'k')} AS profile_company_size,
    c_mktsegment AS profile_current_industry,
    coalesce(titles, '') AS career_all_titles,
    coalesce(companies, '') AS career_all_companies,
    coalesce(industries, '') AS career_all_industries,
    coalesce(descriptions, '') AS career_all_descriptions,
    CAST(coalesce(n_jobs, 0) AS INTEGER) AS career_num_jobs,
    CAST(coalesce(total_months, 0) AS BIGINT) AS career_total_months,
    coalesce(total_months, {d(0.0)}) / greatest(coalesce(n_jobs, 0), 1) AS career_avg_tenure_months,
    coalesce(cur_company, '') AS career_current_company,
    coalesce(cur_title, '') AS career_current_title,
    coalesce(names, '') AS skills_names,
    CAST(coalesce(n_sk, 0) AS INTEGER) AS skills_count,
    CAST(coalesce(adv, 0) AS INTEGER) AS skills_advanced_count,
    CAST(coalesce(endorse, 0) AS BIGINT) AS skills_total_endorsements,
    coalesce(dur_total, {d(0.0)}) / greatest(coalesce(n_sk, 0), 1) AS skills_avg_duration,
    CASE WHEN k % 10 = 0 THEN '' WHEN k % 2 = 0 THEN {deg1}
         WHEN {deg_rank(deg2)} > {deg_rank(deg1)} THEN {deg2} ELSE {deg1} END AS edu_highest_degree,
    CASE WHEN k % 10 = 0 THEN '' WHEN k % 2 = 0 THEN {tier1}
         WHEN {tier_rank(tier2)} > {tier_rank(tier1)} THEN {tier2} ELSE {tier1} END AS edu_best_tier,
    CASE WHEN k % 10 = 0 THEN '' WHEN k % 2 = 0 THEN {pick(P.FIELDS, 'k')}
         ELSE {pick(P.FIELDS, 'k')} || '|' || {pick(P.FIELDS, 'k + 1')} END AS edu_fields,
    CAST(CASE WHEN k % 10 = 0 THEN 0 WHEN k % 2 = 0 THEN 2000 + k % 30 ELSE 2003 + k % 30 END AS INTEGER) AS edu_latest_end_year,
    CAST((k * 37) % 101 AS DOUBLE) AS sig_profile_completeness,
    strftime(DATE '2023-01-01' + CAST((k * 13) % 1000 AS INTEGER), '%Y-%m-%d') AS sig_signup_date,
    {last_active} AS sig_last_active_date,
    (k % 2 = 0) AS sig_open_to_work,
    CAST(k % 97 AS INTEGER) AS sig_profile_views_30d,
    CAST(k % 6 AS INTEGER) AS sig_applications_30d,
    CAST((k * 7) % 101 AS DOUBLE) / {d(100.0)} AS sig_response_rate,
    CAST((k * 11) % 140 AS DOUBLE) AS sig_avg_response_hours,
    CASE WHEN k % 7 = 0 THEN CAST([] AS VARCHAR[]) WHEN k % 9 = 0 THEN ['Blockchain']
         WHEN coalesce(n_sk, 0) > 0 THEN [first_skill] ELSE CAST([] AS VARCHAR[]) END AS assess_keys,
    CASE WHEN k % 7 = 0 THEN CAST([] AS DOUBLE[]) WHEN k % 9 = 0 THEN [{d(50.0)}]
         WHEN coalesce(n_sk, 0) > 0 THEN [CAST((k * 31) % 101 AS DOUBLE)] ELSE CAST([] AS DOUBLE[]) END AS assess_vals,
    CAST((k * 13) % 500 AS INTEGER) AS sig_connection_count,
    CAST((k * 3) % 200 AS INTEGER) AS sig_endorsements,
    CAST({pick(P.NOTICE_DAYS, 'k')} AS INTEGER) AS sig_notice_period_days,
    CAST(8 + k % 30 + CASE WHEN k % 14 = 0 THEN 17 ELSE 0 END AS DOUBLE) AS sig_salary_min,
    CAST(8 + k % 30 + k % 12 AS DOUBLE) AS sig_salary_max,
    {pick(P.WORK_MODES, 'k')} AS sig_work_mode,
    (k % 3 = 0) AS sig_willing_relocate,
    CAST(CASE WHEN k % 4 = 0 THEN -1 ELSE k % 101 END AS DOUBLE) AS sig_github_score,
    CAST((k * 17) % 250 AS INTEGER) AS sig_search_appear_30d,
    CAST(k % 15 AS INTEGER) AS sig_saved_recruiters_30d,
    CAST((k * 3) % 101 AS DOUBLE) / {d(100.0)} AS sig_interview_completion,
    CASE WHEN k % 5 = 0 THEN {d(-1.0)} ELSE CAST((k * 9) % 101 AS DOUBLE) / {d(100.0)} END AS sig_offer_acceptance,
    (k % 3 = 0) AS sig_verified_email,
    (k % 4 = 0) AS sig_verified_phone,
    (k % 5 = 0) AS sig_linkedin_connected
  FROM cbase)"""


# ---------------------------------------------------------------------------
# features, rules, engagement, scores
# ---------------------------------------------------------------------------

def feature_ctes(cfg=DEFAULT) -> str:
    years = "coalesce(profile_years_of_exp, 0.0)"
    prod, res = "feat_dim2_production_kw_count", "feat_dim2_research_kw_count"
    must, irr = "feat_dim4_must_have_count", "feat_dim4_irrelevant_count"
    adv = "skills_advanced_count"
    rr = "(CAST(must AS DOUBLE) / (must + irr + 1))".replace("must", must).replace("irr", irr)
    avg_end = f"(CAST(coalesce(skills_total_endorsements, 0) AS DOUBLE) / greatest({adv}, 1))"
    clip5 = lambda c: f"(CAST(least(greatest({c}, 0), 5) AS DOUBLE) / 5)"
    engs = cfg.engineering_titles
    return f"""
h AS (
  SELECT *,
    {lower0('profile_current_title')} AS _title,
    {lower0('career_all_descriptions')} AS _desc,
    {lower0('profile_headline')} AS _headline,
    {lower0('profile_summary')} AS _summary,
    {lower0('skills_names')} AS _skills,
    {items('career_all_titles')} AS _titles,
    {items('career_all_companies')} AS _comps,
    {items('skills_names')} AS _items,
    {lower0('profile_location')} AS _location
  FROM cand),
f1 AS (
  SELECT *,
    {b(f'_title IN {inlist(engs)}')} AS feat_dim1_is_eng_title,
    {b(any_sub('_title', C.AI_TITLE_WORDS))} AS feat_dim1_is_ai_title,
    {b(f'_title IN {inlist(cfg.non_engineering_titles)}')} AS feat_dim1_is_non_eng_title,
    {b(count_mem('_titles', engs) + ' > 0')} AS feat_dim1_ever_eng_title,
    CASE WHEN len(_titles) > 0 THEN CAST({count_mem('_titles', engs)} AS DOUBLE) / len(_titles) ELSE {d(0.0)} END
      AS feat_dim1_eng_title_ratio,
    {b(any_sub('_title', C.SENIOR_TITLE_WORDS))} AS feat_dim1_is_senior,
    {count_sub('_desc', cfg.production_keywords)} AS feat_dim2_production_kw_count,
    {count_sub('_desc', cfg.retrieval_keywords)} AS feat_dim2_retrieval_kw_count,
    {count_sub('_desc', cfg.research_keywords)} AS feat_dim2_research_kw_count,
    {count_sub('_desc', cfg.wrapper_keywords)} AS feat_dim2_wrapper_kw_count,
    {b(any_sub('_desc', C.ML_WORDS) + ' AND ' + any_sub('_desc', cfg.production_keywords))} AS feat_dim2_shipped_ml,
    {b(any_sub('_summary', cfg.production_keywords))} AS feat_dim2_summary_production,
    {count_sub('_skills', cfg.retrieval_keywords)} AS feat_dim3_retrieval_skill_count,
    {b(any_sub('_headline', C.RETRIEVAL_CORE_WORDS) + ' OR ' + any_sub('_summary', C.RETRIEVAL_CORE_WORDS))}
      AS feat_dim3_headline_retrieval,
    {b("contains(_desc, 'recommendation')")} AS feat_dim3_recommendation_exp,
    {b("contains(replace(replace(_desc, 'job search', ''), 'search for', ''), 'search')")} AS feat_dim3_search_system_exp,
    {count_mem('_items', cfg.must_have_skills)} AS feat_dim4_must_have_count,
    {count_mem('_items', cfg.nice_to_have_skills)} AS feat_dim4_nice_to_have_count,
    {count_mem('_items', cfg.irrelevant_skills)} AS feat_dim4_irrelevant_count,
    {b("list_contains(_items, 'python')")} AS feat_dim4_has_python,
    CAST(coalesce(skills_count, 0) AS BIGINT) AS feat_dim4_total_skills,
    CASE WHEN len(assess_vals) > 0 THEN list_sum(assess_vals) / len(assess_vals) ELSE {d(-1.0)} END AS feat_dim4_assessment_avg,
    {years} AS feat_dim5_years_exp,
    exp({d(-0.5)} * ((({years} - {d(cfg.ideal_years)}) / {d(cfg.ideal_years_sigma)})
                     * (({years} - {d(cfg.ideal_years)}) / {d(cfg.ideal_years_sigma)}))) AS feat_dim5_exp_band_score,
    {b(f'{years} BETWEEN {d(cfg.ideal_range[0])} AND {d(cfg.ideal_range[1])}')} AS feat_dim5_in_ideal_range,
    {b(f'{years} < {d(cfg.too_junior_below)}')} AS feat_dim5_too_junior,
    {b(f'{years} > {d(cfg.too_senior_above)}')} AS feat_dim5_too_senior,
    {b(f"{lower0('profile_current_company')} IN {inlist(cfg.consulting_firms)}")} AS feat_dim6_current_consulting,
    {b(f"len(_comps) > 0 AND {count_mem('_comps', cfg.consulting_firms)} = len(_comps)")} AS feat_dim6_consulting_only,
    CASE WHEN len(_comps) > 0 THEN CAST({count_mem('_comps', cfg.consulting_firms)} AS DOUBLE) / len(_comps)
         ELSE {d(0.0)} END AS feat_dim6_consulting_ratio,
    {count_mem('list_distinct(_comps)', cfg.product_companies)} AS feat_dim6_product_company_count,
    CAST(coalesce(career_avg_tenure_months, 0.0) AS DOUBLE) AS feat_dim6_avg_tenure,
    {b(f"{lower0('profile_country')} = 'india'")} AS feat_dim7_is_india,
    {b(any_sub('_location', cfg.preferred_cities))} AS feat_dim7_preferred_city,
    {b(any_sub('_location', cfg.tier1_cities))} AS feat_dim7_tier1_city,
    CAST(coalesce(sig_notice_period_days, 180) AS BIGINT) AS feat_dim7_notice_period,
    {b('sig_willing_relocate')} AS feat_dim7_willing_relocate,
    {case_map(lower0('sig_work_mode'), C.WORKMODE_SCORE, 0.5)} AS feat_dim7_workmode_score,
    {b('coalesce(sig_salary_min, 0.0) <= coalesce(sig_salary_max, 0.0) AND coalesce(sig_salary_max, 0.0) <= 60.0 AND coalesce(sig_salary_min, 0.0) >= 10.0')}
      AS feat_dim7_salary_reasonable,
    CAST({case_map(lower0('edu_best_tier'), C.TIER_NUMBER, 4)} AS BIGINT) AS feat_dim8_best_tier,
    {b(any_sub(lower0('edu_fields'), C.RELEVANT_FIELDS))} AS feat_dim8_relevant_field,
    {b(f"{lower0('edu_highest_degree')} IN {inlist(C.GRAD_DEGREES)}")} AS feat_dim8_has_grad_degree
  FROM h),
feat AS (
  SELECT *,
    CAST({prod} AS DOUBLE) / ({prod} + {res} + 1) AS feat_dim2_production_ratio,
    feat_dim2_retrieval_kw_count AS feat_dim3_retrieval_desc_count,
    {clip5('feat_dim2_retrieval_kw_count')} * {d(0.4)} + {clip5('feat_dim3_retrieval_skill_count')} * {d(0.2)}
      + feat_dim3_headline_retrieval * {d(0.2)} + feat_dim3_recommendation_exp * {d(0.1)}
      + feat_dim3_search_system_exp * {d(0.1)} AS feat_dim3_retrieval_composite,
    {rr} AS feat_dim4_relevant_ratio,
    CASE WHEN {adv} = 0 THEN {d(0.5)} WHEN {adv} >= 6 AND {avg_end} < 3 THEN {d(0.2)}
         WHEN {adv} >= 4 AND {avg_end} >= 10 THEN {d(1.0)} ELSE {d(0.6)} END AS feat_dim4_skill_trust_score,
    CAST(trunc({adv} * {rr}) AS BIGINT) AS feat_dim4_advanced_relevant,
    coalesce(skills_avg_duration, 0.0) * {rr} AS feat_dim4_relevant_skill_duration,
    CAST(feat_dim6_product_company_count > 0 AS BIGINT) AS feat_dim6_has_product_exp,
    CAST(feat_dim6_avg_tenure < 18.0 AND career_num_jobs >= 3 AS BIGINT) AS feat_dim6_is_title_chaser,
    feat_dim1_eng_title_ratio AS feat_dim6_career_consistency,
    {ladder('feat_dim7_notice_period', C.NOTICE_LADDER, C.NOTICE_DEFAULT)} AS feat_dim7_notice_score,
    CAST(feat_dim8_best_tier <= 2 AS BIGINT) AS feat_dim8_good_institution,
    {case_map('feat_dim8_best_tier', C.TIER_SCORE, 0.3)} AS feat_dim8_tier_score
  FROM f1)"""


def rule_exprs(cfg=DEFAULT, has_features: bool = True) -> dict[str, str]:
    years, end, months, adv = "profile_years_of_exp", "edu_latest_end_year", "career_total_months", "skills_advanced_count"
    em = f"({years} * 12)"
    names = "string_split(skills_names, '|')"
    unclaimed = f"len(list_filter(assess_keys, lambda a: NOT list_contains({names}, lower(a)))) > 0"
    bombed = f"({adv} >= 3 AND len(assess_vals) > 0 AND list_max(assess_vals) < 30)"
    r4 = ("(feat_dim1_is_non_eng_title = 1 AND (feat_dim2_production_kw_count >= 2 OR feat_dim2_retrieval_kw_count >= 2))"
          if has_features and cfg.include_title_rule else "false")
    return {
        "rule_1_exp_vs_education": f"({end} > 0 AND {years} > ({cfg.current_year} - {end}) + 2)",
        "rule_2_career_vs_experience": f"({months} > {em} * {d(1.5)} OR ({em} > 0 AND {months} < {em} * {d(0.3)}))",
        "rule_3_skill_stuffing": f"({adv} >= 8 AND skills_total_endorsements <= 2)",
        "rule_4_title_description_mismatch": r4,
        "rule_5_salary_inversion": "(sig_salary_min > sig_salary_max AND sig_salary_max > 0)",
        "rule_6_signup_after_activity": "coalesce(TRY_CAST(sig_signup_date AS DATE) > TRY_CAST(sig_last_active_date AS DATE), false)",
        "rule_7_impossible_assessment": f"(CASE WHEN coalesce(skills_names, '') = '' THEN false ELSE coalesce(({unclaimed}) OR {bombed}, false) END)",
        "rule_8_tenure_anomaly": f"(career_avg_tenure_months > 240 AND {years} < 10)",
    }


def suspicion_expr(rules: dict[str, str], cfg=DEFAULT) -> str:
    terms = [f"CAST({n} AS DOUBLE) * {d(w)}" for n, w in zip(rules, cfg.rule_weights)]
    return f"least({' + '.join(terms)}, {d(1.0)})"


def scored_ctes(cfg=DEFAULT, rub: RubricConfig = RubricConfig(), source: str = "feat",
                has_features: bool = True) -> str:
    rules = rule_exprs(cfg, has_features)
    rule_cols = ",\n    ".join(f"{e} AS {n}" for n, e in rules.items())
    days = (f"greatest(date_diff('day', coalesce(TRY_CAST(sig_last_active_date AS DATE), DATE '{cfg.missing_activity_date}'),"
            f" DATE '{cfg.reference_date}'), 0)")
    rr = "coalesce(sig_response_rate, 0.0)"
    tf = ladder("coalesce(sig_avg_response_hours, 999.0)", C.RESPONSE_TIME_LADDER, C.RESPONSE_TIME_DEFAULT)
    bd = lambda c: f"CAST(coalesce({c}, false) AS DOUBLE)"
    w = cfg.component_weights
    sat = rub.saturation
    base = (f"CAST(round_even({d(5.0)} * ({d(rub.title_weight)} * greatest(feat_dim1_is_eng_title, feat_dim1_is_ai_title)"
            f" + {d(rub.retrieval_weight)} * (CAST(least(feat_dim3_retrieval_desc_count, {sat}) AS DOUBLE) / {sat})"
            f" + {d(rub.production_weight)} * (CAST(least(feat_dim2_production_kw_count, {sat}) AS DOUBLE) / {sat})"
            f" + {d(rub.band_weight)} * feat_dim5_exp_band_score"
            f" + {d(rub.product_weight)} * feat_dim6_has_product_exp), 0) AS BIGINT)")
    nr = "feat_dim3_retrieval_desc_count = 0"
    c_cons = "feat_dim6_consulting_only = 1"
    c_off = f"(feat_dim4_irrelevant_count >= {rub.offdomain_min_irrelevant} AND {nr})"
    c_stuff = f"(feat_dim4_must_have_count >= {rub.stuffer_min_must_have} AND {nr} AND feat_dim2_production_kw_count = 0)"
    c_inact = f"(days_inactive > {rub.inactive_days})"
    capped = "rubric_base"
    capped = f"(CASE WHEN {c_cons} THEN least({capped}, {rub.consulting_cap}) ELSE {capped} END)"
    capped = f"(CASE WHEN {c_off} THEN least({capped}, {rub.offdomain_cap}) ELSE {capped} END)"
    capped = f"(CASE WHEN {c_stuff} THEN least({capped}, {rub.stuffer_cap}) ELSE {capped} END)"
    capped = f"(CASE WHEN {c_inact} THEN {capped} - {rub.inactive_penalty} ELSE {capped} END)"
    notes = (f"list_filter([CASE WHEN {c_cons} THEN 'consulting-only career' END,"
             f" CASE WHEN {c_off} THEN 'off-domain skills without retrieval work' END,"
             f" CASE WHEN {c_stuff} THEN 'keyword-heavy skills without evidence' END,"
             f" CASE WHEN {c_inact} THEN 'inactive for over six months' END], lambda x: x IS NOT NULL)")
    return f"""
rl AS (
  SELECT *,
    {rule_cols}
  FROM {source}),
sus AS (
  SELECT *, {suspicion_expr(rules, cfg)} AS suspicion_score FROM rl),
eng AS (
  SELECT *, suspicion_score > {d(cfg.honeypot_threshold)} AS is_honeypot,
    {days} AS days_inactive,
    {tf} AS time_factor
  FROM sus),
comp AS (
  SELECT *,
    {ladder('days_inactive', C.RECENCY_LADDER, C.RECENCY_DEFAULT)} AS recency_score,
    {rr} * {d(0.7)} + {rr} * time_factor * {d(0.3)} AS responsiveness_score,
    {bd('sig_open_to_work')} * {d(0.35)} + CAST(coalesce(sig_applications_30d, 0) > 0 AS DOUBLE) * {d(0.20)}
      + coalesce(sig_profile_completeness, 0.0) / {d(100.0)} * {d(0.25)}
      + least(coalesce(sig_saved_recruiters_30d, 0) / {d(10.0)}, {d(1.0)}) * {d(0.20)} AS engagement_score,
    coalesce(sig_interview_completion, 0.5) * {d(0.6)}
      + (CASE WHEN sig_offer_acceptance = -1 THEN {d(0.5)} ELSE coalesce(sig_offer_acceptance, 0.5) END) * {d(0.4)}
      AS reliability_score,
    {bd('sig_verified_email')} * {d(0.4)} + {bd('sig_verified_phone')} * {d(0.3)} + {bd('sig_linkedin_connected')} * {d(0.3)}
      AS verification_score,
    {base} AS rubric_base
  FROM eng),
beh AS (
  SELECT *,
    least(greatest(recency_score * {d(w[0])} + responsiveness_score * {d(w[1])} + engagement_score * {d(w[2])}
      + reliability_score * {d(w[3])} + verification_score * {d(w[4])}, {d(cfg.score_floor)}), {d(cfg.score_ceiling)})
      AS behavioral_score,
    CAST(greatest(least({capped}, 5), 0) AS BIGINT) AS llm_score,
    'rubric base ' || CAST(rubric_base AS VARCHAR)
      || CASE WHEN len({notes}) > 0 THEN '; ' || array_to_string({notes}, '; ') ELSE '' END AS llm_reasoning
  FROM comp),
fin AS (
  SELECT *,
    least(greatest(CAST(llm_score AS DOUBLE) / {d(5.0)}, {d(0.0)}), {d(1.0)}) AS model_score,
    CAST(NOT is_honeypot AS DOUBLE) * ({d(1.0)} - suspicion_score * {d(cfg.suspicion_penalty)}) AS penalty
  FROM beh),
scored AS (
  SELECT *,
    round_even(model_score * behavioral_score * penalty * {d(1e4)}, 0) / {d(1e4)} AS final_score
  FROM fin)"""


def explain_ctes(cfg=DEFAULT, k: int | None = None) -> str:
    k = k or cfg.top_k
    products = inlist(cfg.product_companies)
    first_product = (f"list_filter(string_split(coalesce(career_all_companies, ''), '|'),"
                     f" lambda c: lower({pystrip('c')}) IN {products})[1]")
    years = "coalesce(profile_years_of_exp, 0.0)"
    one_dec = f"printf('%.1f', {scaled_half_even(years, 10)} / {d(10.0)})"
    pct = f"CAST(CAST(round_even(rr * {d(100.0)}, 0) AS BIGINT) AS VARCHAR) || '%'"
    company = "coalesce(profile_current_company, 'their current company')"
    concern_list = ("list_filter(["
                    "CASE WHEN feat_dim7_is_india = 0 THEN 'located outside India (' || coalesce(profile_country, 'unknown') || ')' END, "
                    "CASE WHEN sig_notice_period_days > 90 THEN CAST(sig_notice_period_days AS VARCHAR) || '-day notice period exceeds preferred 30 days' END, "
                    "CASE WHEN feat_dim6_consulting_only > 0 THEN 'consulting-only background' END, "
                    "CASE WHEN feat_dim2_production_kw_count = 0 THEN 'no evidence of production ML deployment in career history' END"
                    "], lambda x: x IS NOT NULL)")
    beh_list = ("list_filter(["
                f"CASE WHEN rr >= 0.7 THEN {pct} || ' recruiter response rate' "
                f"WHEN rr < 0.2 THEN 'low recruiter response rate (' || {pct} || ')' END, "
                "CASE WHEN notice <= 30 THEN CAST(notice AS VARCHAR) || '-day notice period' "
                "WHEN notice > 90 THEN 'extended ' || CAST(notice AS VARCHAR) || '-day notice period' END"
                "], lambda x: x IS NOT NULL)")
    return f"""
topk AS (
  SELECT *, row_number() OVER (ORDER BY final_score DESC NULLS LAST, candidate_id ASC) AS rank
  FROM scored ORDER BY final_score DESC NULLS LAST, candidate_id ASC LIMIT {k}),
ex1 AS (
  SELECT *, coalesce(sig_response_rate, 0.5) AS rr, CAST(coalesce(sig_notice_period_days, 30) AS BIGINT) AS notice,
    {first_product} AS first_product, {concern_list} AS concerns
  FROM topk),
ex2 AS (
  SELECT *,
    coalesce(profile_current_title, 'Professional') || ' with ' || {one_dec} || ' years experience ' ||
    CASE WHEN feat_dim6_has_product_exp > 0 AND first_product IS NOT NULL
           THEN 'including product company experience at ' || first_product
         WHEN feat_dim6_consulting_only > 0 THEN 'currently at ' || {company} || ' (consulting)'
         ELSE 'at ' || {company} END AS frag1,
    CASE WHEN feat_dim3_retrieval_desc_count >= 3 AND feat_dim2_production_kw_count >= 3
           THEN 'career demonstrates hands-on ranking/retrieval system deployment'
         WHEN feat_dim3_retrieval_desc_count >= 2 THEN 'has relevant search and retrieval experience'
         WHEN feat_dim2_production_kw_count >= 3 THEN 'strong production ML experience though not specifically in retrieval'
         ELSE 'limited direct retrieval or production ML experience' END AS frag2,
    CASE WHEN len({beh_list}) > 0 THEN array_to_string({beh_list}, '; ') ELSE 'moderate engagement signals' END AS frag3,
    CASE WHEN len(concerns) = 0 THEN ''
         WHEN rank <= {cfg.minor_concern_rank} THEN 'Minor concern: ' || concerns[1] || '.'
         ELSE 'Notable gap: ' || array_to_string(concerns[1:2], '; ') || '.' END AS concern
  FROM ex1),
ex3 AS (
  SELECT *, frag1 || '; ' || frag2 || '; ' || frag3 || '.' || CASE WHEN concern = '' THEN '' ELSE ' ' || concern END AS full_text
  FROM ex2),
submission AS (
  SELECT candidate_id, CAST(rank AS INTEGER) AS rank,
    min(final_score) OVER (ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS score,
    CASE WHEN length(full_text) > {cfg.max_reasoning_chars}
         THEN substring(full_text, 1, {cfg.max_reasoning_chars - 3}) || '...' ELSE full_text END AS reasoning
  FROM ex3)"""


def with_ctes(*parts: str) -> str:
    return "WITH " + ",".join(p.strip().rstrip(",") for p in parts if p.strip())


def core(cfg=DEFAULT) -> str:
    """flat → features → scores (no explanation)."""
    return with_ctes(flat_ctes(), feature_ctes(cfg), scored_ctes(cfg))


def core_explained(cfg=DEFAULT, k: int | None = None) -> str:
    return with_ctes(flat_ctes(), feature_ctes(cfg), scored_ctes(cfg), explain_ctes(cfg, k))
