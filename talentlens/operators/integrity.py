"""Weighted integrity rules ("honeypot" detection), R1–R12.

Rules are boolean column expressions; the suspicion score is their weighted
sum *in rule order* with IEEE double additions (so exact-threshold ties behave
as in the reference arithmetic), clipped at 1.0.  Summaries are a single
aggregation pass (map-side partial aggregation, one row out).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, RankConfig

RULE_NAMES = (
    "rule_1_exp_vs_education",
    "rule_2_career_vs_experience",
    "rule_3_skill_stuffing",
    "rule_4_title_description_mismatch",
    "rule_5_salary_inversion",
    "rule_6_signup_after_activity",
    "rule_7_impossible_assessment",
    "rule_8_tenure_anomaly",
)


def rules(cfg: RankConfig = DEFAULT, has_features: bool = True) -> dict[str, Column]:
    f = F.col
    years = f("profile_years_of_exp")
    end = f("edu_latest_end_year")
    exp_months = years * 12
    months = f("career_total_months")
    adv = f("skills_advanced_count")
    r1 = (end > 0) & (years > (F.lit(cfg.current_year) - end) + 2)
    r2 = (months > exp_months * 1.5) | ((exp_months > 0) & (months < exp_months * 0.3))
    r3 = (adv >= 8) & (f("skills_total_endorsements") <= 2)
    if has_features and cfg.include_title_rule:
        r4 = (f("feat_dim1_is_non_eng_title") == 1) & (
            (f("feat_dim2_production_kw_count") >= 2) | (f("feat_dim2_retrieval_kw_count") >= 2))
    else:
        r4 = F.lit(False)
    r5 = (f("sig_salary_min") > f("sig_salary_max")) & (f("sig_salary_max") > 0)
    signup, last = F.try_to_date(f("sig_signup_date")), F.try_to_date(f("sig_last_active_date"))
    r6 = F.coalesce(signup > last, F.lit(False))
    scores = f("sig_assessment_scores")
    names = F.split(f("skills_names"), r"\|")
    unclaimed = F.exists(F.map_keys(scores), lambda k: ~F.array_contains(names, F.lower(k)))
    bombed = (adv >= 3) & (F.size(scores) > 0) & (F.array_max(F.map_values(scores)) < 30)
    r7 = F.when(F.coalesce(f("skills_names"), F.lit("")) == "", F.lit(False)) \
          .otherwise(F.coalesce(unclaimed | bombed, F.lit(False)))
    r8 = (f("career_avg_tenure_months") > 240) & (years < 10)
    return dict(zip(RULE_NAMES, (r1, r2, r3, r4, r5, r6, r7, r8)))


def suspicion(flags: list[Column], cfg: RankConfig = DEFAULT) -> Column:
    """Left-to-right weighted sum of the flags, clipped at 1.0."""
    total = None
    for flag, w in zip(flags, cfg.rule_weights):
        term = flag.cast("double") * F.lit(w)
        total = term if total is None else total + term
    return F.least(total, F.lit(1.0))


def add_integrity(df: DataFrame, cfg: RankConfig = DEFAULT, keep_rules: bool = False) -> DataFrame:
    """Adds ``suspicion_score`` and ``is_honeypot`` (R9–R10), optionally the rule flags."""
    has_features = "feat_dim1_is_non_eng_title" in df.columns
    r = rules(cfg, has_features)
    staged = df.select("*", *[c.alias(n) for n, c in r.items()])
    staged = staged.withColumn("suspicion_score", suspicion([F.col(n) for n in RULE_NAMES], cfg))
    staged = staged.withColumn("is_honeypot", F.col("suspicion_score") > F.lit(cfg.honeypot_threshold))
    return staged if keep_rules else staged.drop(*RULE_NAMES)


def rule_counts(with_rules: DataFrame) -> DataFrame:
    """Totals flagged and per rule, as ``(rule, violations)`` rows (one aggregation)."""
    aggs = [F.sum(F.col("is_honeypot").cast("long")).alias("flagged")]
    aggs += [F.sum(F.col(n).cast("long")).alias(n) for n in RULE_NAMES]
    wide = with_rules.agg(*aggs)
    names = ["flagged", *RULE_NAMES]
    stack = "stack({}, {}) as (rule, violations)".format(
        len(names), ", ".join(f"'{n}', coalesce({n}, 0L)" for n in names))
    return wide.selectExpr(stack)


def most_suspicious(scored: DataFrame, n: int = 5) -> DataFrame:
    """Suspicion > 0, highest first (id ascending on ties), first ``n``."""
    return (scored.where(F.col("suspicion_score") > 0)
            .orderBy(F.desc("suspicion_score"), F.asc("candidate_id")).limit(n))
