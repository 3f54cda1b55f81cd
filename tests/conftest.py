import json
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[*]").appName("talentlens-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tl-test-ckpt-", dir="/tmp"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s


def base_record(k: int = 1, **over) -> dict:
    """A complete, well-formed candidate record; ``over`` replaces top-level keys."""
    rec = {
        "candidate_id": f"CAND_{k:07d}",
        "profile": {"headline": "Backend developer", "summary": "builds services", "location": "Pune, Maharashtra",
                    "country": "India", "years_of_experience": 6.0, "current_title": "Software Engineer",
                    "current_company": "Acme", "current_company_size": "51-200", "current_industry": "Technology"},
        "career_history": [
            {"company": "Acme", "title": "Software Engineer", "duration_months": 40, "is_current": True,
             "industry": "Technology", "description": "shipped features"},
            {"company": "Beta", "title": "Intern", "duration_months": 30, "is_current": False,
             "industry": "Technology", "description": "wrote tests"},
        ],
        "education": [{"degree": "B.Tech", "field_of_study": "Computer Science", "end_year": 2018, "tier": "tier_2"}],
        "skills": [{"name": "Python", "proficiency": "advanced", "endorsements": 12, "duration_months": 30}],
        "signals": {"profile_completeness_score": 80, "signup_date": "2024-01-01", "last_active_date": "2026-05-30",
                    "open_to_work_flag": True, "applications_submitted_30d": 2, "recruiter_response_rate": 0.5,
                    "avg_response_time_hours": 10, "skill_assessment_scores": {"Python": 70},
                    "notice_period_days": 30, "expected_salary_range_inr_lpa": {"min": 20, "max": 30},
                    "preferred_work_mode": "hybrid", "willing_to_relocate": True, "github_activity_score": 40,
                    "saved_by_recruiters_30d": 3, "interview_completion_rate": 0.8, "offer_acceptance_rate": 0.6,
                    "verified_email": True, "verified_phone": False, "linkedin_connected": True},
    }
    rec.update(over)
    return rec


def records_df(spark, records):
    from talentlens.schema import candidate_schema
    lines = [json.dumps(r) for r in records]
    return spark.read.schema(candidate_schema()).json(spark.sparkContext.parallelize(lines, 1))


def with_profile(rec, **p):
    rec = json.loads(json.dumps(rec))
    rec["profile"].update(p)
    return rec


def with_signals(rec, **s):
    rec = json.loads(json.dumps(rec))
    rec["signals"].update(s)
    return rec
