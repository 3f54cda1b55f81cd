"""Registered queries: name → Spark plan over the driver tables, and its oracle SQL.

Every query reads the whole driver tables (through the candidate fixture or
directly) and returns a DataFrame with explicitly aliased columns.  Doubles
that come out of transcendental functions or multi-row sums are rounded
half-even to 9 decimals on both sides, so the comparison is not at the mercy of
summation order or a last-ulp libm difference.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..config import DEFAULT
from ..functions.numeric import round_half_even
from ..operators import engagement, features, integrity, labeling, metrics
from ..operators.engagement import COMPONENTS
from ..operators.features import dimension_columns
from ..operators.integrity import RULE_NAMES
from ..sources import files as FS
from . import oracle as O
from . import pipeline as PL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def r9(c) -> Column:
    return round_half_even(F.col(c) if isinstance(c, str) else c, 9)


# ---------------------------------------------------------------------------
# shared Spark frames (each query builds its own lazy plan)
# ---------------------------------------------------------------------------

def flat(spark, sf):
    return PL.flat_candidates(spark, sf)


def feats(spark, sf):
    return features.add_features(flat(spark, sf))


def scored_with_rules(spark, sf):
    df = integrity.add_integrity(feats(spark, sf), keep_rules=True)
    df = engagement.add_engagement(df, keep_components=True)
    return PL.with_model_score(df).withColumn("final_score", PL.ranking.final_score())


def scored(spark, sf):
    return PL.score_candidates(flat(spark, sf))


CORE = O.core()
EXPLAINED = O.core_explained()

# ---------------------------------------------------------------------------
# P: flatten
# ---------------------------------------------------------------------------

_PROFILE = S.PROFILE_COLUMNS
_CAREER = ["candidate_id", *S.CAREER_COLUMNS]
_SKILLS = ["candidate_id", *S.SKILL_COLUMNS]
_EDU = ["candidate_id", *S.EDUCATION_COLUMNS]
_SIG_SCALAR = [c for c in S.SIGNAL_COLUMNS if c != "sig_assessment_scores"]


def _cast_ints(cols: list[str], ints: set[str]):
    return [F.col(c).cast("long").alias(c) if c in ints else F.col(c) for c in cols]


_INTS = {"career_num_jobs", "career_total_months", "skills_count", "skills_advanced_count",
         "skills_total_endorsements", "edu_latest_end_year", "sig_profile_views_30d", "sig_applications_30d",
         "sig_connection_count", "sig_endorsements", "sig_notice_period_days", "sig_search_appear_30d",
         "sig_saved_recruiters_30d"}


def _sql_select(cols: list[str], source: str = "cand", base: str = CORE) -> str:
    sel = ", ".join(f"CAST({c} AS BIGINT) AS {c}" if c in _INTS else c for c in cols)
    return f"{base}\nSELECT {sel} FROM {source}"


for _name, _cols in [("flatten_profile", _PROFILE), ("flatten_career", _CAREER),
                     ("flatten_skills", _SKILLS), ("flatten_education", _EDU)]:
    def _mk(cols):
        return lambda spark, sf: flat(spark, sf).select(*_cast_ints(cols, _INTS))
    register(_name, _sql_select(_cols))(_mk(_cols))


@register("flatten_signals", _sql_select(["candidate_id"] + _SIG_SCALAR).replace(
    " FROM cand", ", array_to_string(assess_keys, '|') AS assessment_keys, "
                  "coalesce(list_sum(assess_vals), 0.0) AS assessment_total FROM cand"))
def q_flatten_signals(spark, sf):
    m = F.col("sig_assessment_scores")
    return flat(spark, sf).select(
        "candidate_id", *_cast_ints(_SIG_SCALAR, _INTS),
        F.array_join(F.map_keys(m), "|").alias("assessment_keys"),
        F.aggregate(F.map_values(m), F.lit(0.0), lambda a, v: a + v).alias("assessment_total"))


# ---------------------------------------------------------------------------
# D: features per dimension
# ---------------------------------------------------------------------------

_ROUNDED = {"feat_dim5_exp_band_score"}

for _dim in range(1, 9):
    _cols = dimension_columns(_dim)
    _sql = CORE + "\nSELECT candidate_id, " + ", ".join(
        (O.r9(c) + f" AS {c}") if c in _ROUNDED else c for c in _cols) + " FROM feat"

    def _mkf(cols):
        return lambda spark, sf: feats(spark, sf).select(
            "candidate_id", *[r9(c).alias(c) if c in _ROUNDED else F.col(c) for c in cols])
    register(f"features_dim{_dim}", _sql)(_mkf(_cols))


# ---------------------------------------------------------------------------
# R: integrity
# ---------------------------------------------------------------------------

@register("integrity_rules", CORE + "\nSELECT candidate_id, " + ", ".join(
    f"CAST({n} AS BIGINT) AS {n}" for n in RULE_NAMES) + " FROM scored")
def q_integrity_rules(spark, sf):
    return scored_with_rules(spark, sf).select("candidate_id", *[F.col(n).cast("long").alias(n) for n in RULE_NAMES])


@register("integrity_suspicion", CORE + "\nSELECT candidate_id, suspicion_score, is_honeypot FROM scored")
def q_integrity_suspicion(spark, sf):
    return scored(spark, sf).select("candidate_id", "suspicion_score", "is_honeypot")


@register("integrity_counts", CORE + "\nSELECT * FROM (SELECT 'flagged' AS rule, CAST(sum(CAST(is_honeypot AS BIGINT)) AS BIGINT) AS violations FROM scored"
          + "".join(f" UNION ALL SELECT '{n}', CAST(sum(CAST({n} AS BIGINT)) AS BIGINT) FROM scored" for n in RULE_NAMES) + ")")
def q_integrity_counts(spark, sf):
    return integrity.rule_counts(scored_with_rules(spark, sf)).select("rule", F.col("violations").cast("long"))


@register("suspicious_top", CORE + "\nSELECT candidate_id, suspicion_score, profile_current_title FROM scored "
          "WHERE suspicion_score > 0 ORDER BY suspicion_score DESC, candidate_id LIMIT 5")
def q_suspicious_top(spark, sf):
    return integrity.most_suspicious(scored(spark, sf)).select("candidate_id", "suspicion_score", "profile_current_title")


# ---------------------------------------------------------------------------
# B: engagement
# ---------------------------------------------------------------------------

@register("engagement_components", CORE + "\nSELECT candidate_id, " + ", ".join(COMPONENTS) + " FROM scored")
def q_engagement_components(spark, sf):
    return scored_with_rules(spark, sf).select("candidate_id", *COMPONENTS)


@register("engagement_score", CORE + "\nSELECT candidate_id, behavioral_score FROM scored")
def q_engagement_score(spark, sf):
    return scored(spark, sf).select("candidate_id", "behavioral_score")


@register("engagement_extremes", CORE + """
SELECT * FROM (SELECT candidate_id, behavioral_score, sig_last_active_date, 'top' AS side FROM scored
               ORDER BY behavioral_score DESC, candidate_id LIMIT 5)
UNION ALL
SELECT * FROM (SELECT candidate_id, behavioral_score, sig_last_active_date, 'bottom' AS side FROM scored
               ORDER BY behavioral_score ASC, candidate_id LIMIT 5)""")
def q_engagement_extremes(spark, sf):
    return engagement.extremes(scored(spark, sf)).select("candidate_id", "behavioral_score", "sig_last_active_date", "side")


@register("engagement_summary", CORE + f"""
SELECT count(*) AS n, {O.r9('avg(behavioral_score)')} AS mean, {O.r9('stddev_samp(behavioral_score)')} AS std,
       min(behavioral_score) AS min, max(behavioral_score) AS max FROM scored""")
def q_engagement_summary(spark, sf):
    s = scored(spark, sf)
    return s.agg(F.count(F.lit(1)).alias("n"), r9(F.avg("behavioral_score")).alias("mean"),
                 r9(F.stddev_samp("behavioral_score")).alias("std"),
                 F.min("behavioral_score").alias("min"), F.max("behavioral_score").alias("max"))


# ---------------------------------------------------------------------------
# L7 rubric, K: final score and ranking, E: explanations
# ---------------------------------------------------------------------------

@register("rubric_score", CORE + "\nSELECT candidate_id, rubric_base, llm_score, llm_reasoning FROM scored")
def q_rubric_score(spark, sf):
    comp = labeling.rubric_components()
    return feats_scored(spark, sf).select("candidate_id", comp["rubric_base"].alias("rubric_base"),
                                          comp["llm_score"].alias("llm_score"), comp["llm_reasoning"].alias("llm_reasoning"))


def feats_scored(spark, sf):
    return integrity.add_integrity(feats(spark, sf))


@register("final_score", CORE + "\nSELECT candidate_id, model_score, behavioral_score, penalty, final_score, is_honeypot FROM scored")
def q_final_score(spark, sf):
    return scored(spark, sf).select("candidate_id", "model_score", "behavioral_score",
                                    PL.ranking.penalty().alias("penalty"), "final_score", "is_honeypot")


@register("rank_topk", EXPLAINED + "\nSELECT candidate_id, rank, score FROM submission")
def q_rank_topk(spark, sf):
    return PL.rank_pipeline(spark, sf).select("candidate_id", "rank", "score")


@register("explain_topk", EXPLAINED + "\nSELECT candidate_id, rank, score, reasoning FROM submission")
def q_explain_topk(spark, sf):
    return PL.rank_pipeline(spark, sf)


@register("flagged_in_topk", EXPLAINED + "\nSELECT CAST(count(*) FILTER (WHERE is_honeypot) AS BIGINT) AS flagged_in_top FROM topk")
def q_flagged_in_topk(spark, sf):
    top = PL.ranking.assign_rank(PL.ranking.top_k(scored(spark, sf), DEFAULT.top_k))
    return PL.ranking.flagged_in_top(top)


@register("model_score_distribution", CORE + f"""
SELECT 'summary' AS part, NULL AS candidate_id, min(model_score) AS min, max(model_score) AS max,
  {O.r9('avg(model_score)')} AS mean, {O.r9('stddev_samp(model_score)')} AS std FROM scored
UNION ALL SELECT * FROM (SELECT 'top', candidate_id, model_score, model_score, model_score, model_score FROM scored
  ORDER BY model_score DESC, candidate_id LIMIT 10)
UNION ALL SELECT * FROM (SELECT 'bottom', candidate_id, model_score, model_score, model_score, model_score FROM scored
  ORDER BY model_score ASC, candidate_id LIMIT 5)""")
def q_model_score_distribution(spark, sf):
    """M5: min/max/mean/std plus the 10 highest and 5 lowest model scores."""
    from ..operators.model import score_distribution
    s = scored(spark, sf)
    summary = score_distribution(s).select(F.lit("summary").alias("part"), F.lit(None).cast("string").alias("candidate_id"),
                                           "min", "max", r9("mean").alias("mean"), r9("std").alias("std"))
    m = F.col("model_score")
    pick = lambda df, part: df.select(F.lit(part).alias("part"), "candidate_id", m.alias("min"), m.alias("max"),
                                      m.alias("mean"), m.alias("std"))
    top = pick(s.orderBy(F.desc("model_score"), F.asc("candidate_id")).limit(10), "top")
    bottom = pick(s.orderBy(F.asc("model_score"), F.asc("candidate_id")).limit(5), "bottom")
    return summary.unionByName(top).unionByName(bottom)


@register("stage_summary", CORE + "\nSELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{st}' AS stage, count(*) AS rows, {O.r9(f'avg({c})')} AS mean, {O.r9(f'stddev_samp({c})')} AS std, "
    f"min({c}) AS min, max({c}) AS max FROM scored" for st, c in PL.STAGE_SCORES.items()) + ")")
def q_stage_summary(spark, sf):
    """K9: all stages from one pass."""
    return metrics.summaries(scored(spark, sf), PL.STAGE_SCORES).select("stage", "rows", r9("mean").alias("mean"), r9("std").alias("std"), "min", "max")


_OBSERVED = "".join(f" UNION ALL SELECT 'scored', '{c}_{f}', {O.r9(f'CAST({g}({c}) AS DOUBLE)')} FROM scored"
                    for c in PL.STAGE_SCORES.values() for f, g in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max")))


@register("rank_run_metrics", EXPLAINED + f"""
SELECT 'scored' AS stage, 'rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM scored
UNION ALL SELECT 'scored', 'flagged', CAST(count(*) FILTER (WHERE is_honeypot) AS DOUBLE) FROM scored{_OBSERVED}
UNION ALL SELECT 'top', 'rows', CAST(count(*) AS DOUBLE) FROM topk
UNION ALL SELECT 'top', 'flagged', CAST(count(*) FILTER (WHERE is_honeypot) AS DOUBLE) FROM topk
UNION ALL SELECT 'top', 'final_score_mean', {O.r9('avg(final_score)')} FROM topk
UNION ALL SELECT 'top', 'final_score_std', {O.r9('stddev_samp(final_score)')} FROM topk
UNION ALL SELECT 'top', 'final_score_min', min(final_score) FROM topk
UNION ALL SELECT 'top', 'final_score_max', max(final_score) FROM topk""")
def q_rank_run_metrics(spark, sf):
    """K9 while the ranking itself runs: no pass but the one that writes the submission."""
    seen = metrics.RunMetrics()
    FS.write_submission(PL.rank_candidates(scored(spark, sf), metrics=seen), FS.scratch_path(spark, "submission"))
    return seen.report(spark).select("stage", "metric", r9("value").alias("value"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from . import more_queries  # noqa: F401  (registers the remaining groups)
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    from . import more_queries  # noqa: F401
    return dict(ORACLE)
