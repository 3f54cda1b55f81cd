"""Nested candidate record schema and the flat column list.

Integers of the JSON document are read as DOUBLE and cast where consumed
(``int()`` semantics: truncation toward zero).
"""

from __future__ import annotations

from pyspark.sql import types as T

PROFILE = T.StructType([
    T.StructField("anonymized_name", T.StringType()),
    T.StructField("headline", T.StringType()),
    T.StructField("summary", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("years_of_experience", T.DoubleType()),
    T.StructField("current_title", T.StringType()),
    T.StructField("current_company", T.StringType()),
    T.StructField("current_company_size", T.StringType()),
    T.StructField("company_size", T.StringType()),
    T.StructField("current_industry", T.StringType()),
])

JOB = T.StructType([
    T.StructField("company", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("start_date", T.StringType()),
    T.StructField("end_date", T.StringType()),
    T.StructField("duration_months", T.DoubleType()),
    T.StructField("is_current", T.BooleanType()),
    T.StructField("industry", T.StringType()),
    T.StructField("company_size", T.StringType()),
    T.StructField("description", T.StringType()),
])

EDUCATION = T.StructType([
    T.StructField("institution", T.StringType()),
    T.StructField("degree", T.StringType()),
    T.StructField("field_of_study", T.StringType()),
    T.StructField("start_year", T.DoubleType()),
    T.StructField("end_year", T.DoubleType()),
    T.StructField("grade", T.StringType()),
    T.StructField("tier", T.StringType()),
])

SKILL = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("proficiency", T.StringType()),
    T.StructField("endorsements", T.DoubleType()),
    T.StructField("duration_months", T.DoubleType()),
])

CERTIFICATION = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("issuer", T.StringType()),
    T.StructField("year", T.DoubleType()),
])

LANGUAGE = T.StructType([
    T.StructField("language", T.StringType()),
    T.StructField("proficiency", T.StringType()),
])

SALARY = T.StructType([T.StructField("min", T.DoubleType()), T.StructField("max", T.DoubleType())])

SIGNALS = T.StructType([
    T.StructField("profile_completeness_score", T.DoubleType()),
    T.StructField("signup_date", T.StringType()),
    T.StructField("last_active_date", T.StringType()),
    T.StructField("open_to_work_flag", T.BooleanType()),
    T.StructField("profile_views_received_30d", T.DoubleType()),
    T.StructField("applications_submitted_30d", T.DoubleType()),
    T.StructField("recruiter_response_rate", T.DoubleType()),
    T.StructField("avg_response_time_hours", T.DoubleType()),
    T.StructField("skill_assessment_scores", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("connection_count", T.DoubleType()),
    T.StructField("endorsements_received", T.DoubleType()),
    T.StructField("notice_period_days", T.DoubleType()),
    T.StructField("expected_salary_range_inr_lpa", SALARY),
    T.StructField("preferred_work_mode", T.StringType()),
    T.StructField("willing_to_relocate", T.BooleanType()),
    T.StructField("github_activity_score", T.DoubleType()),
    T.StructField("search_appearance_30d", T.DoubleType()),
    T.StructField("saved_by_recruiters_30d", T.DoubleType()),
    T.StructField("interview_completion_rate", T.DoubleType()),
    T.StructField("offer_acceptance_rate", T.DoubleType()),
    T.StructField("verified_email", T.BooleanType()),
    T.StructField("verified_phone", T.BooleanType()),
    T.StructField("linkedin_connected", T.BooleanType()),
])


def candidate_schema(signals_key: str = "signals") -> T.StructType:
    return T.StructType([
        T.StructField("candidate_id", T.StringType()),
        T.StructField("profile", PROFILE),
        T.StructField("career_history", T.ArrayType(JOB)),
        T.StructField("education", T.ArrayType(EDUCATION)),
        T.StructField("skills", T.ArrayType(SKILL)),
        T.StructField("certifications", T.ArrayType(CERTIFICATION)),
        T.StructField("languages", T.ArrayType(LANGUAGE)),
        T.StructField(signals_key, SIGNALS),
    ])


PROFILE_COLUMNS = [
    "candidate_id", "profile_headline", "profile_summary", "profile_location", "profile_country",
    "profile_years_of_exp", "profile_current_title", "profile_current_company",
    "profile_company_size", "profile_current_industry",
]
CAREER_COLUMNS = [
    "career_all_titles", "career_all_companies", "career_all_industries", "career_all_descriptions",
    "career_num_jobs", "career_total_months", "career_avg_tenure_months",
    "career_current_company", "career_current_title",
]
SKILL_COLUMNS = [
    "skills_names", "skills_count", "skills_advanced_count", "skills_total_endorsements",
    "skills_avg_duration",
]
EDUCATION_COLUMNS = ["edu_highest_degree", "edu_best_tier", "edu_fields", "edu_latest_end_year"]
SIGNAL_COLUMNS = [
    "sig_profile_completeness", "sig_signup_date", "sig_last_active_date", "sig_open_to_work",
    "sig_profile_views_30d", "sig_applications_30d", "sig_response_rate", "sig_avg_response_hours",
    "sig_assessment_scores", "sig_connection_count", "sig_endorsements", "sig_notice_period_days",
    "sig_salary_min", "sig_salary_max", "sig_work_mode", "sig_willing_relocate", "sig_github_score",
    "sig_search_appear_30d", "sig_saved_recruiters_30d", "sig_interview_completion",
    "sig_offer_acceptance", "sig_verified_email", "sig_verified_phone", "sig_linkedin_connected",
]
FLAT_COLUMNS = PROFILE_COLUMNS + CAREER_COLUMNS + SKILL_COLUMNS + EDUCATION_COLUMNS + SIGNAL_COLUMNS
