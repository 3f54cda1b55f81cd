"""Behavioural (engagement) score, B1–B7: five components, weighted, clamped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..config import DEFAULT, RankConfig
from ..functions.numeric import clip, ladder

COMPONENTS = ("recency_score", "responsiveness_score", "engagement_score",
              "reliability_score", "verification_score")


def days_since_active(cfg: RankConfig = DEFAULT) -> Column:
    """Days from last activity (bad/missing date → fixed old date) to the reference date, ≥ 0."""
    last = F.coalesce(F.try_to_date(F.col("sig_last_active_date")),
                      F.lit(cfg.missing_activity_date).cast("date"))
    return F.greatest(F.datediff(F.lit(cfg.reference_date).cast("date"), last), F.lit(0))


def components(cfg: RankConfig = DEFAULT) -> dict[str, Column]:
    f = F.col
    rr = F.coalesce(f("sig_response_rate"), F.lit(0.0))
    hours = F.coalesce(f("sig_avg_response_hours"), F.lit(999.0))
    time_factor = ladder(hours, C.RESPONSE_TIME_LADDER, C.RESPONSE_TIME_DEFAULT)
    open_ = F.coalesce(f("sig_open_to_work"), F.lit(False)).cast("double")
    applying = (F.coalesce(f("sig_applications_30d"), F.lit(0)) > 0).cast("double")
    complete = F.coalesce(f("sig_profile_completeness"), F.lit(0.0)) / F.lit(100.0)
    interest = F.least(F.coalesce(f("sig_saved_recruiters_30d"), F.lit(0)) / F.lit(10.0), F.lit(1.0))
    interview = F.coalesce(f("sig_interview_completion"), F.lit(0.5))
    offer = F.when(f("sig_offer_acceptance") == -1, F.lit(0.5)) \
             .otherwise(F.coalesce(f("sig_offer_acceptance"), F.lit(0.5)))
    b = lambda c: F.coalesce(f(c), F.lit(False)).cast("double")
    return {
        "recency_score": ladder(days_since_active(cfg), C.RECENCY_LADDER, C.RECENCY_DEFAULT),
        "responsiveness_score": rr * 0.7 + rr * time_factor * 0.3,
        "engagement_score": open_ * 0.35 + applying * 0.20 + complete * 0.25 + interest * 0.20,
        "reliability_score": interview * 0.6 + offer * 0.4,
        "verification_score": b("sig_verified_email") * 0.4 + b("sig_verified_phone") * 0.3
                              + b("sig_linkedin_connected") * 0.3,
    }


def combine(cfg: RankConfig = DEFAULT) -> Column:
    """Weighted sum of the component columns, clamped to [floor, ceiling]."""
    total = None
    for name, w in zip(COMPONENTS, cfg.component_weights):
        term = F.col(name) * F.lit(w)
        total = term if total is None else total + term
    return clip(total, cfg.score_floor, cfg.score_ceiling)


def add_engagement(df: DataFrame, cfg: RankConfig = DEFAULT, keep_components: bool = False) -> DataFrame:
    staged = df.select("*", *[c.alias(n) for n, c in components(cfg).items()])
    staged = staged.withColumn("behavioral_score", combine(cfg))
    return staged if keep_components else staged.drop(*COMPONENTS)


def extremes(scored: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` best and ``n`` worst by behavioural score (id breaks ties)."""
    top = scored.orderBy(F.desc("behavioral_score"), F.asc("candidate_id")).limit(n) \
                .withColumn("side", F.lit("top"))
    bottom = scored.orderBy(F.asc("behavioral_score"), F.asc("candidate_id")).limit(n) \
                   .withColumn("side", F.lit("bottom"))
    return top.unionByName(bottom)


def recency_from_events(events: DataFrame, reference_date: str, user_col: str = "user_id",
                        ts_col: str = "ts") -> DataFrame:
    """B1 over an activity log: last activity per user → days inactive → recency score.

    ``max(ts)`` per user is map-side combined, so a user holding a third of the
    log costs one partial row per map task.
    """
    last = events.groupBy(user_col).agg(F.max(ts_col).alias("last_active"))
    days = F.greatest(F.datediff(F.lit(reference_date).cast("date"), F.to_date("last_active")), F.lit(0))
    return last.select(user_col, F.date_format("last_active", "yyyy-MM-dd").alias("last_active_date"),
                       days.alias("days_inactive"),
                       ladder(days, C.RECENCY_LADDER, C.RECENCY_DEFAULT).alias("recency_score"))
