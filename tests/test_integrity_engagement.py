import pytest
from conftest import base_record, records_df, with_profile, with_signals

from talentlens.operators import engagement, integrity
from talentlens.operators.features import add_features
from talentlens.operators.flatten import flatten


def scored(spark, recs, features=True):
    flat = flatten(records_df(spark, recs))
    df = add_features(flat) if features else flat
    return {r.candidate_id: r for r in integrity.add_integrity(df, keep_rules=True).collect()}


def test_exact_point_seven_is_not_flagged(spark):
    # R1 (0.4) + R2 (0.3): 10 years claimed, graduated 2024, career 70 months vs 120 claimed... → both fire
    rec = with_profile(base_record(), years_of_experience=10.0)
    rec["education"][0]["end_year"] = 2024
    rec["career_history"][0]["duration_months"] = 300
    r = scored(spark, [rec])["CAND_0000001"]
    assert r.rule_1_exp_vs_education and r.rule_2_career_vs_experience
    assert r.suspicion_score == 0.7 and r.is_honeypot is False


def test_weighted_sum_is_left_to_right_doubles(spark):
    from pyspark.sql import functions as F
    from talentlens.operators.integrity import RULE_NAMES, suspicion
    # rules 5, 7, 8 only: 0.2 + 0.2 + 0.2 = 0.6000000000000001 > 0.6 ; rules 1+2 = 0.7 exactly
    rows = [tuple(i in (4, 6, 7) for i in range(8)), tuple(i in (0, 1) for i in range(8))]
    df = spark.createDataFrame(rows, ", ".join(f"{n} boolean" for n in RULE_NAMES))
    out = [r.s for r in df.select(suspicion([F.col(n) for n in RULE_NAMES]).alias("s")).collect()]
    assert out[0] == 0.2 + 0.2 + 0.2 and out[0] > 0.6
    assert out[1] == 0.7


def test_salary_and_assessment_rules(spark):
    rec = with_signals(base_record(), expected_salary_range_inr_lpa={"min": 40, "max": 30},
                       skill_assessment_scores={"Rust": 90})
    r = scored(spark, [rec])["CAND_0000001"]
    assert r.rule_5_salary_inversion and r.rule_7_impossible_assessment
    assert r.suspicion_score == 0.4 and not r.is_honeypot


def test_bad_dates_and_missing_skills(spark):
    rec = with_signals(base_record(skills=[]), signup_date="2025-01-01", last_active_date="not-a-date",
                       skill_assessment_scores={"Python": 10})
    r = scored(spark, [rec])["CAND_0000001"]
    assert not r.rule_6_signup_after_activity and not r.rule_7_impossible_assessment


def test_title_rule_needs_features(spark):
    rec = with_profile(base_record(), current_title="Marketing Manager")
    rec["career_history"][0]["description"] = "deployed to production with docker on aws"
    assert scored(spark, [rec])["CAND_0000001"].rule_4_title_description_mismatch
    assert not scored(spark, [rec], features=False)["CAND_0000001"].rule_4_title_description_mismatch


@pytest.mark.parametrize("days,score", [(7, 1.0), (8, 0.9), (30, 0.9), (31, 0.7), (60, 0.7), (61, 0.5),
                                        (90, 0.5), (91, 0.3), (180, 0.3), (181, 0.1)])
def test_recency_ladder(spark, days, score):
    import datetime
    d = (datetime.date(2026, 6, 1) - datetime.timedelta(days=days)).isoformat()
    df = engagement.add_engagement(flatten(records_df(spark, [with_signals(base_record(), last_active_date=d)])),
                                   keep_components=True)
    assert df.collect()[0].recency_score == score


@pytest.mark.parametrize("hours,factor", [(12, 1.0), (13, 0.9), (48, 0.9), (49, 0.7), (96, 0.7), (97, 0.5)])
def test_response_time_ladder(spark, hours, factor):
    rec = with_signals(base_record(), avg_response_time_hours=hours, recruiter_response_rate=1.0)
    r = engagement.add_engagement(flatten(records_df(spark, [rec])), keep_components=True).collect()[0]
    assert r.responsiveness_score == pytest.approx(0.7 + factor * 0.3)


def test_missing_activity_and_clamp(spark):
    rec = with_signals(base_record(), last_active_date="", recruiter_response_rate=0.0, open_to_work_flag=False,
                       applications_submitted_30d=0, profile_completeness_score=0, saved_by_recruiters_30d=0,
                       interview_completion_rate=0.0, offer_acceptance_rate=0.0, verified_email=False,
                       linkedin_connected=False)
    r = engagement.add_engagement(flatten(records_df(spark, [rec])), keep_components=True).collect()[0]
    assert r.recency_score == 0.1 and r.behavioral_score == 0.1      # 0.025 clamped up to the floor


def test_missing_time_and_notice_default_to_best_bucket(spark):
    """The loader turns missing values into 0, so the later 999/180 fallbacks never apply."""
    from talentlens.operators.features import add_features
    rec = base_record()
    del rec["signals"]["avg_response_time_hours"]
    del rec["signals"]["notice_period_days"]
    rec["signals"]["recruiter_response_rate"] = 1.0
    flat = flatten(records_df(spark, [rec]))
    r = engagement.add_engagement(add_features(flat), keep_components=True).collect()[0]
    assert r.responsiveness_score == 1.0 and r.feat_dim7_notice_score == 1.0


def test_future_graduation_and_zero_years(spark):
    """An end year in the future makes rule 1 fire; X11: 0 years with career months makes rule 2 fire."""
    rec = with_profile(base_record(), years_of_experience=2.0)
    rec["education"][0]["end_year"] = 2030
    r = scored(spark, [rec])["CAND_0000001"]
    assert r.rule_1_exp_vs_education
    rec = with_profile(base_record(), years_of_experience=0.0)
    r = scored(spark, [rec])["CAND_0000001"]
    assert r.rule_2_career_vs_experience
