from conftest import base_record, records_df, with_profile

from talentlens.operators.flatten import flatten


def one(spark, rec):
    return flatten(records_df(spark, [rec])).collect()[0]


def test_defaults_for_missing_and_empty(spark):
    rec = {"candidate_id": "CAND_0000009", "profile": {}, "career_history": [], "skills": [], "education": []}
    r = one(spark, rec)
    assert r.career_all_titles == "" and r.career_num_jobs == 0 and r.career_avg_tenure_months == 0.0
    assert r.skills_names == "" and r.skills_avg_duration == 0.0
    assert r.edu_highest_degree == "" and r.edu_best_tier == "" and r.edu_latest_end_year == 0
    assert r.sig_notice_period_days == 0 and r.sig_open_to_work is False and r.sig_assessment_scores == {}
    assert r.profile_years_of_exp == 0.0


def test_explicit_null_is_lenient(spark):
    rec = with_profile(base_record(), years_of_experience=None, current_title=None)
    r = one(spark, rec)
    assert r.profile_years_of_exp == 0.0 and r.profile_current_title == ""


def test_career_concat_totals_and_last_current(spark):
    rec = base_record()
    rec["career_history"][1]["is_current"] = True          # two current jobs: the last wins
    r = one(spark, rec)
    assert r.career_all_titles == "Software Engineer|Intern"
    assert r.career_all_descriptions == "shipped features\nwrote tests"
    assert r.career_total_months == 70 and r.career_avg_tenure_months == 35.0
    assert r.career_current_title == "Intern" and r.career_current_company == "Beta"


def test_skill_names_lower_and_counts(spark):
    rec = base_record(skills=[
        {"name": "PyTorch", "proficiency": "Expert", "endorsements": 3, "duration_months": 10},
        {"name": "a|b", "proficiency": "beginner", "endorsements": 1, "duration_months": 20},
    ])
    r = one(spark, rec)
    assert r.skills_names == "pytorch|a|b"            # a pipe inside a name splits later (X6)
    assert r.skills_count == 2 and r.skills_advanced_count == 1
    assert r.skills_total_endorsements == 4 and r.skills_avg_duration == 15.0


def test_degree_and_tier_argmax_first_wins(spark):
    rec = base_record(education=[
        {"degree": "Certificate", "tier": "tier_3", "field_of_study": "A", "end_year": 2010},
        {"degree": "Diploma", "tier": "Tier_1", "field_of_study": "B", "end_year": 2012},
        {"degree": "M.Tech", "tier": "tier_1", "field_of_study": "C", "end_year": 2030},
        {"degree": "MBA", "tier": "tier_1", "field_of_study": "D", "end_year": 2011},
    ])
    r = one(spark, rec)
    assert r.edu_highest_degree == "M.Tech"      # M.Tech and MBA tie at 4: first wins
    assert r.edu_best_tier == "Tier_1"           # original case of the first best tier
    assert r.edu_fields == "A|B|C|D" and r.edu_latest_end_year == 2030


def test_unlisted_degree_ranks_below_diploma(spark):
    rec = base_record(education=[{"degree": "Certificate"}, {"degree": "Diploma"}])
    assert one(spark, rec).edu_highest_degree == "Diploma"


def test_company_size_falls_back_to_legacy_key(spark):
    rec = base_record()
    rec["profile"].pop("current_company_size")
    rec["profile"]["company_size"] = "11-50"
    assert one(spark, rec).profile_company_size == "11-50"
