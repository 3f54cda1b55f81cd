"""Score combination and deterministic top-k (M4, K1–K8; K9 is in ``metrics``).

``top_k`` has two levels: every task keeps its own k best rows (a group limit
before the shuffle), ``FUNNELS`` groups of tasks keep theirs, and an
``orderBy(...).limit(k)`` merges the ``FUNNELS`` × k rows that are left.  No
global sort, no shuffle of the table, and no single task that gets k rows of
every other.
Ranks, the monotone repair and explanations run on those k rows only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, RankConfig
from ..functions.numeric import clip, nan_to_null, round_half_even


#: Groups of tasks that each keep their k best rows.
FUNNELS = 64


def normalise_model_score(raw: Column) -> Column:
    """M4: raw 0–5 prediction → [0, 1]."""
    return clip(raw / F.lit(5.0), 0.0, 1.0)


def penalty(cfg: RankConfig = DEFAULT) -> Column:
    """K1: zero for flagged rows, graduated by suspicion otherwise."""
    return (~F.col("is_honeypot")).cast("double") * (F.lit(1.0) - F.col("suspicion_score") * F.lit(cfg.suspicion_penalty))


def final_score(cfg: RankConfig = DEFAULT, model_col: str = "model_score") -> Column:
    """K2: round(model × behaviour × penalty, 4), half-even on the scaled value."""
    raw = F.col(model_col) * F.col("behavioral_score") * penalty(cfg)
    return round_half_even(raw, cfg.score_decimals)


def top_k(scored: DataFrame, k: int, score_col: str = "final_score", id_col: str = "candidate_id") -> DataFrame:
    """K3: score descending (NaN treated as missing → last), id ascending, first k."""
    order = [F.desc_nulls_last(score_col), F.asc(id_col)]
    salted = scored.withColumn(score_col, nan_to_null(F.col(score_col))).withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(FUNNELS)))
    first = salted.withColumn("_rn", F.row_number().over(Window.partitionBy("_salt").orderBy(*order))).where(F.col("_rn") <= k)
    return first.drop("_salt", "_rn").orderBy(*order).limit(k)


def assign_rank(top: DataFrame, score_col: str = "final_score", id_col: str = "candidate_id") -> DataFrame:
    """K4: dense 1..k sequence over the (already limited) rows."""
    w = Window.orderBy(F.desc_nulls_last(score_col), F.asc(id_col))
    return top.withColumn("rank", F.row_number().over(w))


def monotone(ranked: DataFrame, score_col: str = "score") -> DataFrame:
    """K5: score_i := min(score_i, score_{i-1}) — running minimum by rank."""
    w = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return ranked.withColumn(score_col, F.min(score_col).over(w))


def flagged_in_top(ranked: DataFrame) -> DataFrame:
    """K7: number of flagged rows among the top k."""
    return ranked.agg(F.coalesce(F.sum(F.col("is_honeypot").cast("long")), F.lit(0)).alias("flagged_in_top"))


def output_violations(ranked: DataFrame, source_ids: DataFrame, k: int) -> DataFrame:
    """K8: output assertions as violation rows (empty = all pass).

    Checks row count, rank set, distinct ids, non-increasing score and that
    every id exists in the source (the source is probed with the broadcast k
    ids, so it is scanned but never shuffled or collected).
    """
    checks = ranked.agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("candidate_id").alias("ids"),
        F.min("rank").alias("rmin"), F.max("rank").alias("rmax"), F.countDistinct("rank").alias("ranks"),
    )
    w = Window.orderBy("rank")
    increases = ranked.withColumn("prev", F.lag("score").over(w)).where(F.col("score") > F.col("prev"))
    from .audit import audit_unknown_ids
    unknown = audit_unknown_ids(ranked, source_ids)
    basic = checks.select(F.explode(F.array(
        F.when(F.col("n") != k, F.lit("row_count")),
        F.when((F.col("ranks") != F.col("n")) | (F.col("rmin") != 1) | (F.col("rmax") != F.col("n")), F.lit("rank_set")),
        F.when(F.col("ids") != F.col("n"), F.lit("duplicate_id")),
    )).alias("check")).where(F.col("check").isNotNull()).withColumn("detail", F.lit(""))
    inc = increases.select(F.lit("score_increases").alias("check"),
                           F.concat(F.lit("rank "), F.col("rank").cast("string")).alias("detail"))
    unk = unknown.select(F.lit("unknown_id").alias("check"), F.col("candidate_id").alias("detail"))
    return basic.unionByName(inc).unionByName(unk)
