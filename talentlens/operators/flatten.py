"""Nested candidate record → 52-column flat table.

One ``select`` of native array/struct expressions per record: no explode, no
shuffle, no UDF.  Missing or null fields take the documented defaults
(lenient mode: an explicit null is treated like a missing key).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from .. import schema as S
from ..functions.text import lookup


def _s(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def _d(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0)).cast("double")


def _i(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0)).cast("int")


def _b(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def profile_columns(rec: str = "") -> list[Column]:
    """Id + profile projection."""
    p = F.col("profile")
    return [
        _s(F.col("candidate_id")).alias("candidate_id"),
        _s(p["headline"]).alias("profile_headline"),
        _s(p["summary"]).alias("profile_summary"),
        _s(p["location"]).alias("profile_location"),
        _s(p["country"]).alias("profile_country"),
        _d(p["years_of_experience"]).alias("profile_years_of_exp"),
        _s(p["current_title"]).alias("profile_current_title"),
        _s(p["current_company"]).alias("profile_current_company"),
        # the schema's field is current_company_size; older records use company_size
        _s(F.coalesce(p["current_company_size"], p["company_size"])).alias("profile_company_size"),
        _s(p["current_industry"]).alias("profile_current_industry"),
    ]


def career_columns() -> list[Column]:
    """Career text concatenation, aggregates and the current job."""
    jobs = F.coalesce(F.col("career_history"), F.array().cast(T.ArrayType(S.JOB)))
    n = F.size(jobs)
    total = F.aggregate(jobs, F.lit(0.0), lambda acc, j: acc + F.coalesce(j["duration_months"], F.lit(0.0)))
    current = F.try_element_at(F.filter(jobs, lambda j: F.coalesce(j["is_current"], F.lit(False))), F.lit(-1))
    return [
        F.array_join(F.transform(jobs, lambda j: _s(j["title"])), "|").alias("career_all_titles"),
        F.array_join(F.transform(jobs, lambda j: _s(j["company"])), "|").alias("career_all_companies"),
        F.array_join(F.transform(jobs, lambda j: _s(j["industry"])), "|").alias("career_all_industries"),
        F.array_join(F.transform(jobs, lambda j: _s(j["description"])), "\n").alias("career_all_descriptions"),
        n.alias("career_num_jobs"),
        total.cast("long").alias("career_total_months"),
        (total / F.greatest(n, F.lit(1))).alias("career_avg_tenure_months"),
        _s(current["company"]).alias("career_current_company"),
        _s(current["title"]).alias("career_current_title"),
    ]


def skill_columns() -> list[Column]:
    """Lower-cased skill names and skill aggregates."""
    sk = F.coalesce(F.col("skills"), F.array().cast(T.ArrayType(S.SKILL)))
    n = F.size(sk)
    adv = F.size(F.filter(sk, lambda s: F.lower(_s(s["proficiency"])).isin("advanced", "expert")))
    endorse = F.aggregate(sk, F.lit(0.0), lambda acc, s: acc + F.coalesce(s["endorsements"], F.lit(0.0)))
    dur = F.aggregate(sk, F.lit(0.0), lambda acc, s: acc + F.coalesce(s["duration_months"], F.lit(0.0)))
    return [
        F.array_join(F.transform(sk, lambda s: F.lower(_s(s["name"]))), "|").alias("skills_names"),
        n.alias("skills_count"),
        adv.alias("skills_advanced_count"),
        endorse.cast("long").alias("skills_total_endorsements"),
        (dur / F.greatest(n, F.lit(1))).alias("skills_avg_duration"),
    ]


def _argmax_first(arr: Column, score_fn, value_fn) -> Column:
    """Value of the first element with the maximal score; '' for an empty array."""
    scores = F.transform(arr, score_fn)
    pos = F.array_position(scores, F.array_max(scores))
    return F.when(F.size(arr) > 0, value_fn(F.element_at(arr, pos.cast("int")))).otherwise(F.lit(""))


def education_columns() -> list[Column]:
    """Highest degree, best tier (first wins), fields, latest end year."""
    ed = F.coalesce(F.col("education"), F.array().cast(T.ArrayType(S.EDUCATION)))
    degree = _argmax_first(
        ed, lambda e: lookup(F.lower(_s(e["degree"])), C.DEGREE_RANK, 1), lambda e: _s(e["degree"]))
    tier = _argmax_first(
        ed, lambda e: lookup(F.lower(F.coalesce(e["tier"], F.lit("unknown"))), C.TIER_RANK, 0),
        lambda e: F.coalesce(e["tier"], F.lit("unknown")))
    latest = F.greatest(F.array_max(F.transform(ed, lambda e: F.coalesce(e["end_year"], F.lit(0.0)))), F.lit(0.0))
    return [
        degree.alias("edu_highest_degree"),
        tier.alias("edu_best_tier"),
        F.array_join(F.transform(ed, lambda e: _s(e["field_of_study"])), "|").alias("edu_fields"),
        latest.cast("int").alias("edu_latest_end_year"),
    ]


def signal_columns(signals_key: str = "signals") -> list[Column]:
    """24 behavioural signal columns with coercion and defaults."""
    s = F.col(signals_key)
    sal = s["expected_salary_range_inr_lpa"]
    return [
        _d(s["profile_completeness_score"]).alias("sig_profile_completeness"),
        _s(s["signup_date"]).alias("sig_signup_date"),
        _s(s["last_active_date"]).alias("sig_last_active_date"),
        _b(s["open_to_work_flag"]).alias("sig_open_to_work"),
        _i(s["profile_views_received_30d"]).alias("sig_profile_views_30d"),
        _i(s["applications_submitted_30d"]).alias("sig_applications_30d"),
        _d(s["recruiter_response_rate"]).alias("sig_response_rate"),
        _d(s["avg_response_time_hours"]).alias("sig_avg_response_hours"),
        F.coalesce(s["skill_assessment_scores"], F.create_map().cast("map<string,double>")).alias("sig_assessment_scores"),
        _i(s["connection_count"]).alias("sig_connection_count"),
        _i(s["endorsements_received"]).alias("sig_endorsements"),
        _i(s["notice_period_days"]).alias("sig_notice_period_days"),
        _d(sal["min"]).alias("sig_salary_min"),
        _d(sal["max"]).alias("sig_salary_max"),
        _s(s["preferred_work_mode"]).alias("sig_work_mode"),
        _b(s["willing_to_relocate"]).alias("sig_willing_relocate"),
        _d(s["github_activity_score"]).alias("sig_github_score"),
        _i(s["search_appearance_30d"]).alias("sig_search_appear_30d"),
        _i(s["saved_by_recruiters_30d"]).alias("sig_saved_recruiters_30d"),
        _d(s["interview_completion_rate"]).alias("sig_interview_completion"),
        _d(s["offer_acceptance_rate"]).alias("sig_offer_acceptance"),
        _b(s["verified_email"]).alias("sig_verified_email"),
        _b(s["verified_phone"]).alias("sig_verified_phone"),
        _b(s["linkedin_connected"]).alias("sig_linkedin_connected"),
    ]


def flatten(candidates: DataFrame, signals_key: str = "signals") -> DataFrame:
    """The full 52-column flat table in one projection."""
    return candidates.select(
        *profile_columns(), *career_columns(), *skill_columns(),
        *education_columns(), *signal_columns(signals_key),
    )
