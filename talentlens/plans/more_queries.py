"""Registered queries: sampling and labels (L), training (N/M), audits (V/Q), profile (G)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from .. import schema as S
from ..config import DEFAULT, TrainConfig
from ..operators import audit, json_schema, labeling, model, profile, trees
from ..operators.features import FEATURE_COLUMNS
from ..sources import fixture_pools as P
from . import oracle as O
from . import pipeline as PL
from ..session import cut_lineage
from ..sources import files as FS
from ..sources.label_log import LabelLog
from .queries import CORE, EXPLAINED, feats_scored, flat, r9, register, scored

SAMPLE_TOTAL = 600
SEED = "42"

# ---------------------------------------------------------------------------
# L: sampling and labels
# ---------------------------------------------------------------------------


def _mask_sql(cfg=DEFAULT) -> dict[str, str]:
    return {
        "relevant": "(feat_dim1_is_ai_title = 1 AND feat_dim3_retrieval_skill_count >= 2 AND feat_dim5_years_exp BETWEEN 4 AND 12)",
        "plausible": "(feat_dim1_is_eng_title = 1 AND feat_dim4_total_skills >= 5 AND feat_dim5_years_exp BETWEEN 3 AND 15)",
        "edge": "coalesce(regexp_matches(lower(profile_current_title), 'data engineer|qa|junior|intern'), false)",
        "irrelevant": "(feat_dim1_is_non_eng_title = 1)",
        "suspicious": f"(suspicion_score > {O.d(cfg.suspicious_threshold)})",
        "random": "true",
    }


def cascade_sql(total: int = SAMPLE_TOTAL, seed: str = SEED) -> str:
    quota = total // len(labeling.BUCKETS)
    masks = _mask_sql()
    parts = [f"sbase AS (SELECT candidate_id, md5('{seed}:' || candidate_id) AS skey, "
             + ", ".join(f"coalesce({m}, false) AS m_{b}" for b, m in masks.items()) + " FROM scored)"]
    for i, b in enumerate(labeling.BUCKETS):
        excl = " AND candidate_id NOT IN (SELECT candidate_id FROM picked_{})".format(i - 1) if i else ""
        limit = f"{quota * (i + 1)} - " + (f"(SELECT count(*) FROM picked_{i - 1})" if i else "0")
        parts.append(
            f"b{i} AS (SELECT candidate_id, '{b}' AS bucket FROM ("
            f"SELECT candidate_id, row_number() OVER (ORDER BY skey, candidate_id) AS rn FROM sbase "
            f"WHERE m_{b}{excl}) WHERE rn <= {limit})")
        union = " UNION ALL ".join(f"SELECT * FROM b{j}" for j in range(i + 1))
        parts.append(f"picked_{i} AS ({union})")
    parts.append(f"sample AS (SELECT * FROM picked_{len(labeling.BUCKETS) - 1})")
    return ",\n".join(parts)


SAMPLED = CORE + ",\n" + cascade_sql()


def sample_frame(spark, sf) -> DataFrame:
    return labeling.cascade_sample(scored(spark, sf), SAMPLE_TOTAL, SEED)


def labelled_sample(spark, sf) -> DataFrame:
    """Rubric labels of the cascade sample joined to the scored rows."""
    s = scored(spark, sf)
    sample = labeling.cascade_sample(s, SAMPLE_TOTAL, SEED)
    comp = labeling.rubric_components()
    picked = PL.flatten(FS.fetch_by_ids(PL.fixture_candidates(spark, sf), sample), DEFAULT.signals_key)
    rows = PL.score_candidates(picked).join(F.broadcast(sample), "candidate_id")      # features of the sampled rows only, SAMPLE_TOTAL at most
    # bounded by the sample size; written once so CV / fits don't re-run the cascade
    return cut_lineage(rows.withColumn("rubric_base", comp["rubric_base"]).withColumn("llm_score", comp["llm_score"]))


@register("sample_cascade", SAMPLED + "\nSELECT candidate_id, bucket FROM sample")
def q_sample_cascade(spark, sf):
    return sample_frame(spark, sf)


@register("sample_seeded", CORE + f"\nSELECT candidate_id, final_score FROM scored ORDER BY md5('{SEED}:' || candidate_id), candidate_id LIMIT 100")
def q_sample_seeded(spark, sf):
    return labeling.seeded_sample(scored(spark, sf), 100, SEED).select("candidate_id", "final_score")


@register("labels_pending", SAMPLED + "\nSELECT candidate_id, bucket FROM sample WHERE candidate_id NOT IN "
          "(SELECT candidate_id FROM sample WHERE bucket IN ('relevant', 'plausible'))")
def q_labels_pending(spark, sf):
    sample = sample_frame(spark, sf)
    done = sample.where(F.col("bucket").isin("relevant", "plausible"))
    return labeling.pending(sample, done)


@register("label_log", f"""{CORE},
part AS (SELECT candidate_id, llm_score, CAST(right(candidate_id, 1) AS INTEGER) % 3 AS k FROM scored)
SELECT candidate_id, CAST(CASE k WHEN 1 THEN 5 - llm_score ELSE llm_score END AS INTEGER) AS llm_score, CASE k WHEN 1 THEN 'again' ELSE 'first' END AS llm_reasoning FROM part""")
def q_label_log(spark, sf):
    """Three chunks of labels of all candidates; one is appended again with other labels, a repeated one and a dead one change nothing."""
    comp = labeling.rubric_components()
    all_labels = feats_scored(spark, sf).select("candidate_id", comp["llm_score"].alias("llm_score"), F.lit("first").alias("llm_reasoning"),
                                                (F.right("candidate_id", F.lit(1)).cast("int") % 3).alias("k"))
    all_labels = spark.read.parquet(FS.stage_parquet(all_labels, FS.scratch_path(spark, "labels")))
    log = LabelLog(spark, FS.scratch_path(spark, "label-log"))
    part = lambda k: all_labels.where(F.col("k") == k).drop("k")
    for k in range(3):
        log.append(part(k), f"part-{k}")
    log.append(part(0), "part-0")
    log.append(part(1).withColumn("llm_score", 5 - F.col("llm_score")).withColumn("llm_reasoning", F.lit("again")), "part-1")
    log.write_attempt(part(2).withColumn("llm_reasoning", F.lit("dead")), "part-2")                  # never committed
    return log.labels()


@register("label_distribution", SAMPLED + "\nSELECT llm_score AS label, count(*) AS n FROM scored "
          "WHERE candidate_id IN (SELECT candidate_id FROM sample) GROUP BY llm_score")
def q_label_distribution(spark, sf):
    return labeling.label_distribution(labelled_sample(spark, sf))


@register("label_join", SAMPLED + "\nSELECT s.candidate_id, s.llm_score, s.feat_dim5_years_exp, s.feat_dim3_retrieval_composite, "
          "s.feat_dim4_skill_trust_score FROM scored s JOIN sample USING (candidate_id)")
def q_label_join(spark, sf):
    picked = F.broadcast(sample_frame(spark, sf))                          # SAMPLE_TOTAL rows at most
    feats_df = PL.score_candidates(flat(spark, sf).join(picked, "candidate_id", "left_semi"))      # features of the sampled rows only
    return model.label_join(feats_df, labeling.rubric_labels(feats_df)).select(
        "candidate_id", F.col("llm_score").cast("long").alias("llm_score"), "feat_dim5_years_exp",
        "feat_dim3_retrieval_composite", "feat_dim4_skill_trust_score")


@register("constant_features", SAMPLED + "\nSELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, (min({c}) IS NULL OR min({c}) = max({c})) AS constant FROM scored "
    f"WHERE candidate_id IN (SELECT candidate_id FROM sample)" for c in FEATURE_COLUMNS) + ")")
def q_constant_features(spark, sf):
    return model.constant_columns(labelled_sample(spark, sf), FEATURE_COLUMNS)


FOLDED = SAMPLED + f""",
folded AS (SELECT candidate_id, CAST((row_number() OVER (ORDER BY md5('{SEED}:' || candidate_id), candidate_id) - 1) % 5 AS INTEGER) AS fold FROM sample)"""


@register("fold_assignment", FOLDED + "\nSELECT candidate_id, fold FROM folded")
def q_fold_assignment(spark, sf):
    return model.with_folds(sample_frame(spark, sf), 5, SEED).select("candidate_id", "fold")


@register("regression_metrics", FOLDED + f"""
SELECT fold,
  {O.r9('sqrt(avg((CAST(rubric_base AS DOUBLE) - llm_score) * (CAST(rubric_base AS DOUBLE) - llm_score)))')} AS rmse,
  {O.r9('avg(abs(CAST(rubric_base AS DOUBLE) - llm_score))')} AS mae, count(*) AS n
FROM scored JOIN folded USING (candidate_id) GROUP BY fold""")
def q_regression_metrics(spark, sf):
    ls = model.with_folds(labelled_sample(spark, sf), 5, SEED).select(
        "candidate_id", "fold", F.col("rubric_base").cast("double").alias("prediction"),
        F.col("llm_score").cast("double").alias("llm_score"))
    m = model.regression_metrics(ls, "llm_score", group="fold")
    return m.select("fold", r9("rmse").alias("rmse"), r9("mae").alias("mae"), "n")


@register("calibration_by_label", SAMPLED + f"""
SELECT llm_score AS label, {O.r9('avg(CAST(rubric_base AS DOUBLE))')} AS mean_pred,
  CAST(min(rubric_base) AS DOUBLE) AS min_pred, CAST(max(rubric_base) AS DOUBLE) AS max_pred, count(*) AS n
FROM scored WHERE candidate_id IN (SELECT candidate_id FROM sample) GROUP BY llm_score""")
def q_calibration_by_label(spark, sf):
    ls = labelled_sample(spark, sf).select(F.col("rubric_base").cast("double").alias("prediction"), "llm_score")
    c = model.calibration(ls)
    return c.select("label", r9("mean_pred").alias("mean_pred"), "min_pred", "max_pred", "n")


# rows-only: fitted models, pluggable teacher, prompt rendering

@register("gbt_cv")
def q_gbt_cv(spark, sf):
    train = labelled_sample(spark, sf)
    cols = model.usable_columns(train, FEATURE_COLUMNS)
    return model.cross_validate(train.withColumn("llm_score", F.col("llm_score").cast("double")), cols,
                                TrainConfig())


@register("gbt_score")
def q_gbt_score(spark, sf):
    train = labelled_sample(spark, sf).withColumn("llm_score", F.col("llm_score").cast("double"))
    cols = model.usable_columns(train, FEATURE_COLUMNS)
    fitted = model.fit(train, cols, TrainConfig())
    all_rows = PL.featurize(flat(spark, sf))
    out = model.score(fitted, all_rows, cols).withColumn("final_score", PL.ranking.final_score())
    return PL.rank_candidates(out)


def _stated_nodes() -> list[tuple]:
    """A model that a rule states, so that SQL can state it too: twelve trees of two splits over the features in turn."""
    pick = lambda i: FEATURE_COLUMNS[i % len(FEATURE_COLUMNS)]
    rows = []
    for i in range(12):
        value = lambda k: ((i * 7 + k * 5) % 11 - 4) / 4
        samples = 100 + i
        rows += [(i, 1.0 if i == 0 else 0.25, 0, pick(5 * i), i % 4 * 0.5, 1, 2, value(0), 1.0 + i, 2 * samples),
                 (i, 1.0 if i == 0 else 0.25, 1, None, None, None, None, value(1), None, samples),
                 (i, 1.0 if i == 0 else 0.25, 2, pick(5 * i + 3), i % 3 + 0.25, 3, 4, value(2), 0.5 * i, samples),
                 (i, 1.0 if i == 0 else 0.25, 3, None, None, None, None, value(3), None, 10),
                 (i, 1.0 if i == 0 else 0.25, 4, None, None, None, None, value(4), None, 90 + i)]
    return rows


def _nodes_sql() -> str:
    null = lambda x, as_: f"CAST({'NULL' if x is None else O.q(x) if isinstance(x, str) else x} AS {as_})"
    kinds = ("INTEGER", "DOUBLE", "INTEGER", "VARCHAR", "DOUBLE", "INTEGER", "INTEGER", "DOUBLE", "DOUBLE", "BIGINT")
    values = ", ".join("(" + ", ".join(null(x, k) for x, k in zip(r, kinds, strict=True)) + ")" for r in _stated_nodes())
    return f'node(tree, weight, node, feature, threshold, "left", "right", value, gain, samples) AS (VALUES {values})'


_WALK_SQL = (CORE.replace("WITH ", "WITH RECURSIVE ", 1) + f""",
{_nodes_sql()},
model_input AS (SELECT candidate_id, MAP({O.lst(FEATURE_COLUMNS)}, [{", ".join(f"coalesce(CAST({c} AS DOUBLE), -1.0)" for c in FEATURE_COLUMNS)}]) AS x FROM feat),
walk AS (SELECT candidate_id, tree, 0 AS here FROM model_input, (SELECT DISTINCT tree FROM node)
  UNION ALL SELECT walk.candidate_id, walk.tree, CASE WHEN x[feature] <= threshold THEN "left" ELSE "right" END
  FROM walk JOIN node ON node.tree = walk.tree AND node.node = walk.here AND node.feature IS NOT NULL JOIN model_input USING (candidate_id)),
raw AS (SELECT candidate_id, sum(weight * value) AS p FROM walk JOIN node ON node.tree = walk.tree AND node.node = walk.here WHERE node.feature IS NULL GROUP BY candidate_id)""")


@register("tree_table_score", f"""{_WALK_SQL}
SELECT candidate_id, {O.r9('p')} AS raw_model_score, {O.r9('least(greatest(p / 5.0, 0.0), 1.0)')} AS model_score FROM raw""")
def q_tree_table_score(spark, sf):
    """M3: a model given as a table of nodes scores every candidate."""
    nodes = spark.createDataFrame(_stated_nodes(), trees.NODE_SCHEMA)
    scored_rows = model.score(trees.model_from_nodes(nodes, FEATURE_COLUMNS), PL.featurize(flat(spark, sf)), FEATURE_COLUMNS)
    return scored_rows.select("candidate_id", r9("raw_model_score").alias("raw_model_score"), r9("model_score").alias("model_score"))


@register("gbt_score_agreement", CORE + "\nSELECT candidate_id, TRUE AS agrees FROM cand")
def q_gbt_score_agreement(spark, sf):
    """M3 of a fitted model: MLlib's prediction and a walk of the exported nodes agree for every candidate."""
    train = labelled_sample(spark, sf).withColumn("llm_score", F.col("llm_score").cast("double"))
    cols = model.usable_columns(train, FEATURE_COLUMNS)
    fitted = model.fit(train, cols, TrainConfig(max_iter=8))
    rows = model.score(fitted, PL.featurize(flat(spark, sf)), cols)
    walked = trees.expression(trees.node_table(fitted, cols), "__x_")
    return model.impute(rows, cols).select("candidate_id", (F.abs(walked - F.col("raw_model_score")) < 1e-9).alias("agrees"))


@register("tree_table_importances", f"""{_WALK_SQL},
f AS (SELECT unnest({O.lst(FEATURE_COLUMNS)}) AS feature),
reached AS (SELECT tree, here AS node, count(*) AS n FROM walk GROUP BY tree, here),
s AS (SELECT feature, sum(gain * coalesce(n, 0)) AS total, avg(gain) AS mean, count(*) AS splits FROM node LEFT JOIN reached USING (tree, node) WHERE feature IS NOT NULL GROUP BY feature)
SELECT feature, {O.r9('coalesce(total / sum(total) OVER (), 0.0)')} AS importance, {O.r9('coalesce(mean / sum(mean) OVER (), 0.0)')} AS gain_importance,
  CAST(coalesce(splits, 0) AS BIGINT) AS splits FROM f LEFT JOIN s USING (feature)""")
def q_tree_table_importances(spark, sf):
    """N7 of a model given as a table of nodes: each split weighs what reaches it of all candidates."""
    rows = model.impute(PL.featurize(flat(spark, sf)), FEATURE_COLUMNS)
    nodes = trees.cover(spark.createDataFrame(_stated_nodes(), trees.NODE_SCHEMA), rows)
    return trees.importances(nodes, FEATURE_COLUMNS).select("feature", r9("importance").alias("importance"), r9("gain_importance").alias("gain_importance"), "splits")


@register("feature_importances")
def q_feature_importances(spark, sf):
    train = labelled_sample(spark, sf).withColumn("llm_score", F.col("llm_score").cast("double"))
    cols = model.usable_columns(train, FEATURE_COLUMNS)
    fitted = model.fit(train, cols, TrainConfig())
    return spark.createDataFrame(model.importances(fitted, cols), "feature string, importance double")


PROMPT = ("Rate this candidate from 0 to 5 for the role below and answer as JSON "
          "{\"score\": n, \"reasoning\": \"...\"}.\nROLE: {JOB_DESCRIPTION}\nCANDIDATE: {CANDIDATE_JSON}")


def _prompts(spark, sf) -> DataFrame:
    """Prompts of the sampled records, each a line of JSON with a key that the schema doesn't know and a null."""
    raw = PL.fixture_candidates(spark, sf)
    line = F.to_json(F.struct(*raw.columns, F.lit("kept").alias("extra"), F.lit(None).cast("string").alias("nothing")), {"ignoreNullFields": "false"})
    pend = FS.fetch_by_ids(raw, sample_frame(spark, sf))                                            # SAMPLE_TOTAL rows at most
    return labeling.render_prompts(pend.select("candidate_id", line.alias("value")), PROMPT, "Senior engineer for search and ranking systems")


@register("teacher_prompts", SAMPLED + """
SELECT candidate_id, profile_headline AS headline, career_num_jobs AS jobs, 'kept' AS extra, true AS has_null, true AS framed
FROM cand WHERE candidate_id IN (SELECT candidate_id FROM sample)""")
def q_teacher_prompts(spark, sf):
    """What each prompt holds of its raw record."""
    body = F.split_part("prompt", F.lit("CANDIDATE: "), F.lit(2))
    return _prompts(spark, sf).select(
        "candidate_id", F.get_json_object(body, "$.profile.headline").alias("headline"),
        F.json_array_length(F.get_json_object(body, "$.career_history")).alias("jobs"), F.get_json_object(body, "$.extra").alias("extra"),
        F.contains(body, F.lit('"nothing": null')).alias("has_null"),
        F.contains("prompt", F.lit("ROLE: Senior engineer for search and ranking systems\nCANDIDATE: {\n")).alias("framed"))


def _teacher(prompts):
    """A stand-in teacher with many forms of reply, by the candidate's number; fails as a whole for a batch with number 9 modulo 10."""
    out = []
    for p in prompts:
        n = int(re.search(r'"candidate_id": "CAND_0*([0-9]+)"', p)[1])
        form, score = n % 10, n % 6
        if form == 9:
            raise ConnectionError("refused")
        out.append({0: '```json\n{"score": %d, "reasoning": "fenced"}\n```', 1: '\n\t```\n{"score": %d, "reasoning": "blank first"}```', 2: '{"score": "%d", "reasoning": "text score"}',
                    3: '{"score": %d, "reasoning": "then"} more', 4: '{"score": %d, "reasoning": {"a": 1}}', 5: '{"score": %d}', 6: '{"score": %d.7, "reasoning": "cut"}',
                    7: 'score %d', 8: '{"score": "high", "reasoning": "%d"}'}[form] % score)
    return out


@register("teacher_parse", SAMPLED + f"""
, replied AS (SELECT candidate_id, CAST(substr(candidate_id, 6) AS BIGINT) AS n FROM sample)
SELECT candidate_id, CAST(CASE WHEN n % 10 IN (3, 5, 7, 9) THEN 1 ELSE n % 6 END AS INTEGER) AS llm_score,
  CASE n % 10 WHEN 0 THEN 'fenced' WHEN 1 THEN 'blank first' WHEN 2 THEN 'text score' WHEN 6 THEN 'cut' ELSE 'Error' END AS reasoning
FROM replied WHERE n % 10 NOT IN (4, 8)""")
def q_teacher_parse(spark, sf):
    """Labels from a teacher whose replies take many forms and whose calls fail for some records."""
    labels = labeling.teacher_labels(_prompts(spark, sf), _teacher, pause=0.0)
    return labels.select("candidate_id", "llm_score", F.when(F.col("llm_reasoning").startswith("Error: "), F.lit("Error")).otherwise(F.col("llm_reasoning")).alias("reasoning"))


_REPLY_FORMS = ("'```json\\n{\"score\": ' || n % 6 || ', \"reasoning\": \"fenced\"}\\n```'", "'\\n ```{\"score\": ' || n % 6 || ', \"reasoning\": \"blank first\"}```\\n'",
                "'{\"score\": \" ' || n % 6 || '\", \"reasoning\": \"text score\"}'", "'I think ' || n % 6", "'{\"score\": null, \"reasoning\": \"none\"}'", "'{\"score\": 4}'",
                "'{\"score\": ' || n % 6 || '.9, \"reasoning\": \"cut\"}'", "'{\"score\": 4, \"reasoning\": \"r\"} so'", "'{\"score\": \"4.5\", \"reasoning\": \"r\"}'", "NULL",
                "'{\"reasoning\": \"yes\", \"score\": true}'", "'[4]'")


@register("stored_replies", f"""{CORE}, replied AS (SELECT candidate_id, CAST(substr(candidate_id, 6) AS BIGINT) AS k, CAST(substr(candidate_id, 6) AS BIGINT) % 12 AS form FROM cand)
SELECT candidate_id, CAST(CASE WHEN form IN (0, 1, 2, 6) THEN k % 6 ELSE 1 END AS INTEGER) AS llm_score, CASE form WHEN 0 THEN 'fenced' WHEN 1 THEN 'blank first'
  WHEN 2 THEN 'text score' WHEN 6 THEN 'cut' WHEN 10 THEN 'yes' WHEN 5 THEN 'Error: Missing keys in LLM response' ELSE 'Error: the reply is no JSON object' END AS llm_reasoning
FROM replied WHERE form NOT IN (4, 8)""")
def q_stored_replies(spark, sf):
    """L6 on stored replies, one for each candidate, in twelve forms."""
    n = F.substr("candidate_id", F.lit(6)).cast("long")
    forms = " ".join(f"WHEN {i} THEN {f}" for i, f in enumerate(_REPLY_FORMS))
    replies = flat(spark, sf).select("candidate_id", n.alias("n")).select("candidate_id", F.expr(f"CASE n % 12 {forms} END").alias("response"))
    return labeling.parse_responses(spark.read.parquet(FS.stage_parquet(replies, FS.scratch_path(spark, "replies"))))


# ---------------------------------------------------------------------------
# V/Q: audits on the ranked submission with injected defects
# ---------------------------------------------------------------------------

def defective_cells(spark, sf) -> DataFrame:
    """Submission cells from the real ranking, with defects placed by rank arithmetic."""
    sub = PL.rank_pipeline(spark, sf)
    w = Window.orderBy("rank")
    s = (sub.withColumn("prev_id", F.lag("candidate_id").over(w)).withColumn("next_id", F.lead("candidate_id").over(w))
            .withColumn("prev_score", F.lag("score").over(w)).withColumn("prev_reason", F.lag("reasoning").over(w)))
    r = F.col("rank")
    flagged = audit.flagged_without_features(flat(spark, sf)).agg(F.min("candidate_id")).first()[0]
    cid = (F.when(r == 77, F.coalesce(F.lit(flagged), F.col("candidate_id"))).when(r == 5, F.col("prev_id")).when(r == 9, F.lit("CAND_12")).when(r == 33, F.col("next_id"))
            .when(r == 34, F.col("prev_id")).when(r == 60, F.lit("CAND_9999999")).when(r == 70, F.lit(""))
            .otherwise(F.col("candidate_id")))
    score = (F.when(r == 21, F.col("prev_score") + 0.5).when(r == 34, F.col("prev_score")).otherwise(F.col("score")))
    score_s = F.when(r == 17, F.lit("n/a")).otherwise(F.format_string("%.4f", score))
    rank_s = (F.when(r == 13, F.lit("013")).when(r == 25, F.lit("101")).when(r == 29, F.lit("28"))
               .otherwise(r.cast("string")))
    reason = (F.when(r == 40, F.lit("")).when(r == 45, F.col("prev_reason")).when(r == 82, F.lit("")).when(r == 50, F.lit("ok"))
               .otherwise(F.col("reasoning")))
    # k rows, written once: every audit reads the same cells without re-ranking
    return cut_lineage(s.select(cid.alias("candidate_id"), rank_s.alias("rank"), score_s.alias("score"),
                                reason.alias("reasoning"), (r + 1).cast("long").alias("row_num")))


NF_RULES = O.rule_exprs(has_features=False)
FLAGGED_NF = ("flagged_nf AS (SELECT candidate_id FROM cand WHERE least("
              + " + ".join(f"CAST(({e}) AS DOUBLE) * {O.d(w)}" for e, w in zip(NF_RULES.values(), DEFAULT.rule_weights))
              + f", {O.d(1.0)}) > {O.d(DEFAULT.honeypot_threshold)})")


CELLS_SQL = EXPLAINED + ",\n" + FLAGGED_NF + """,
lagged AS (
  SELECT *, lag(candidate_id) OVER (ORDER BY rank) AS prev_id, lead(candidate_id) OVER (ORDER BY rank) AS next_id,
    lag(score) OVER (ORDER BY rank) AS prev_score, lag(reasoning) OVER (ORDER BY rank) AS prev_reason
  FROM submission),
cells AS (
  SELECT
    CASE WHEN rank = 5 THEN prev_id WHEN rank = 9 THEN 'CAND_12' WHEN rank = 33 THEN next_id WHEN rank = 34 THEN prev_id
         WHEN rank = 60 THEN 'CAND_9999999' WHEN rank = 70 THEN ''
         WHEN rank = 77 THEN coalesce((SELECT min(candidate_id) FROM flagged_nf), candidate_id) ELSE candidate_id END AS candidate_id,
    CASE WHEN rank = 13 THEN '013' WHEN rank = 25 THEN '101' WHEN rank = 29 THEN '28' ELSE CAST(rank AS VARCHAR) END AS rank,
    CASE WHEN rank = 17 THEN 'n/a' ELSE printf('%.4f', CASE WHEN rank = 21 THEN prev_score + CAST(0.5 AS DOUBLE)
         WHEN rank = 34 THEN prev_score ELSE score END) END AS score,
    CASE WHEN rank = 40 THEN '' WHEN rank = 45 THEN prev_reason WHEN rank = 82 THEN '' WHEN rank = 50 THEN 'ok' ELSE reasoning END AS reasoning,
    CAST(rank + 1 AS BIGINT) AS row_num
  FROM lagged),
cv AS (
  SELECT *, PYSTRIP(coalesce(candidate_id, '')) AS cid, PYSTRIP(coalesce(rank, '')) AS rank_s,
    CASE WHEN regexp_matches(PYSTRIP(coalesce(rank, '')), '^(0|-?[1-9][0-9]*)$') THEN TRY_CAST(PYSTRIP(rank) AS BIGINT) END AS rank_i,
    TRY_CAST(PYSTRIP(coalesce(score, '')) AS DOUBLE) AS score_d
  FROM cells),
typed AS (
  SELECT PYSTRIP(candidate_id) AS candidate_id, TRY_CAST(PYSTRIP(rank) AS INTEGER) AS rank,
    TRY_CAST(PYSTRIP(score) AS DOUBLE) AS score, reasoning, row_num FROM cells)"""
CELLS_SQL = re.sub(r"PYSTRIP\(([^()]*(?:\([^()]*\))?[^()]*)\)", lambda m: O.pystrip(m.group(1)), CELLS_SQL)


VIOLATIONS_BODY = f"""
  SELECT 'row_count' AS "check", 'error' AS severity, CAST(0 AS BIGINT) AS row_num, 'found ' || CAST(count(*) AS VARCHAR) AS detail
    FROM cv HAVING count(*) <> 100
  UNION ALL SELECT 'id_required', 'error', row_num, '' FROM cv WHERE cid = ''
  UNION ALL SELECT 'id_pattern', 'error', row_num, cid FROM cv WHERE cid <> '' AND NOT regexp_matches(cid, '{C.CANDIDATE_ID_PATTERN}')
  UNION ALL SELECT 'id_duplicate', 'error', row_num, cid FROM (
    SELECT cid, row_num, row_number() OVER (PARTITION BY cid ORDER BY row_num) AS occ FROM cv
    WHERE regexp_matches(cid, '{C.CANDIDATE_ID_PATTERN}')) WHERE occ > 1
  UNION ALL SELECT 'rank_not_integer', 'error', row_num, rank_s FROM cv WHERE rank_i IS NULL
  UNION ALL SELECT 'rank_range', 'error', row_num, rank_s FROM cv WHERE rank_i IS NOT NULL AND NOT rank_i BETWEEN 1 AND 100
  UNION ALL SELECT 'rank_duplicate', 'error', row_num, rank_s FROM (
    SELECT rank_s, row_num, row_number() OVER (PARTITION BY rank_i ORDER BY row_num) AS occ FROM cv
    WHERE rank_i BETWEEN 1 AND 100) WHERE occ > 1
  UNION ALL SELECT 'score_not_float', 'error', row_num, {O.pystrip("coalesce(score, '')")} FROM cv WHERE score_d IS NULL
  UNION ALL SELECT 'rank_missing', 'error', CAST(0 AS BIGINT), CAST(r AS VARCHAR) FROM range(1, 101) t(r)
    WHERE r NOT IN (SELECT rank_i FROM cv WHERE rank_i BETWEEN 1 AND 100)
  UNION ALL SELECT 'score_increase', 'error', row_num, 'rank ' || CAST(rank_i AS VARCHAR) || ' < rank ' || CAST(r2 AS VARCHAR)
    FROM ordered WHERE s2 IS NOT NULL AND score_d < s2
  UNION ALL SELECT 'tie_order', 'error', row_num, cid || ' > ' || c2
    FROM ordered WHERE s2 IS NOT NULL AND score_d = s2 AND cid > c2"""
ORDERED_CTE = """ordered AS (
  SELECT cid, rank_i, score_d, row_num,
    lead(score_d) OVER (ORDER BY rank_i, row_num) AS s2, lead(cid) OVER (ORDER BY rank_i, row_num) AS c2,
    lead(rank_i) OVER (ORDER BY rank_i, row_num) AS r2
  FROM cv WHERE rank_i IS NOT NULL AND score_d IS NOT NULL AND cid <> ''),
typed AS ("""
CELLS_SQL = CELLS_SQL.replace("typed AS (", ORDERED_CTE)
VSQL = CELLS_SQL + f"\nSELECT * FROM ({VIOLATIONS_BODY})"


@register("audit_contract", VSQL)
def q_audit_contract(spark, sf):
    return audit.validate_cells(defective_cells(spark, sf))


@register("audit_missing_ranks", CELLS_SQL.replace("typed AS (", "x AS (") +
          "\nSELECT CAST(r AS BIGINT) AS missing_rank FROM range(1, 101) t(r) WHERE r NOT IN (SELECT rank_i FROM cv WHERE rank_i BETWEEN 1 AND 100)")
def q_audit_missing_ranks(spark, sf):
    return audit.check_missing_ranks(defective_cells(spark, sf)).select(F.col("detail").cast("long").alias("missing_rank"))


@register("audit_flagged", CELLS_SQL +
          "\nSELECT candidate_id, rank FROM typed WHERE candidate_id IN (SELECT candidate_id FROM flagged_nf)")
def q_audit_flagged(spark, sf):
    sub = audit.typed(defective_cells(spark, sf))
    return audit.audit_flagged(sub, audit.flagged_without_features(flat(spark, sf)))


@register("audit_titles", CELLS_SQL + f"""
SELECT t.rank, t.candidate_id, c.profile_current_title, c.profile_current_industry,
  lower(coalesce(c.profile_current_title, '')) IN {O.inlist(C.AUDIT_NON_ENG_TITLES)} AS flagged
FROM typed t JOIN cand c USING (candidate_id) WHERE t.rank <= 10""")
def q_audit_titles(spark, sf):
    return audit.audit_titles(audit.typed(defective_cells(spark, sf)), flat(spark, sf))


@register("audit_reasoning", CELLS_SQL + """
SELECT 'empty' AS issue, rank FROM typed WHERE reasoning IS NULL OR reasoning = ''
UNION ALL SELECT 'duplicate', rank FROM (SELECT rank, row_number() OVER (PARTITION BY coalesce(reasoning, '') ORDER BY row_num) AS occ
  FROM typed) WHERE occ > 1
UNION ALL SELECT 'short', rank FROM typed WHERE length(reasoning) BETWEEN 1 AND 29""")
def q_audit_reasoning(spark, sf):
    return audit.audit_reasoning(audit.typed(defective_cells(spark, sf)))


@register("audit_review_sample", CELLS_SQL + f"""
SELECT candidate_id, rank, score FROM typed ORDER BY md5('{SEED}:' || candidate_id), candidate_id LIMIT 10""")
def q_audit_review_sample(spark, sf):
    return audit.review_sample(audit.typed(defective_cells(spark, sf)), 10, SEED).select("candidate_id", "rank", "score")


@register("audit_scores", CELLS_SQL + f"""
SELECT min(score) AS min, max(score) AS max, {O.r9('avg(score)')} AS mean, {O.r9('stddev_samp(score)')} AS std,
  {O.r9('median(score)')} AS median, count(DISTINCT score) AS unique_scores,
  {O.r9('arg_min(score, row_num) - arg_max(score, row_num)')} AS spread
FROM typed""")
def q_audit_scores(spark, sf):
    s = audit.audit_scores(audit.typed(defective_cells(spark, sf)))
    return s.select("min", "max", r9("mean").alias("mean"), r9("std").alias("std"), r9("median").alias("median"),
                    "unique_scores", r9("spread").alias("spread"))


@register("audit_ids", CELLS_SQL + "\nSELECT DISTINCT candidate_id FROM typed WHERE candidate_id NOT IN (SELECT candidate_id FROM cand)")
def q_audit_ids(spark, sf):
    return audit.audit_unknown_ids(audit.typed(defective_cells(spark, sf)), flat(spark, sf))


SUMMARY_SQL = CELLS_SQL + f""",
violations AS ({VIOLATIONS_BODY}),
layers AS (
  SELECT 'contract' AS layer, CASE WHEN (SELECT count(*) FROM violations) = 0 THEN 'PASS' ELSE 'FAIL' END AS status
  UNION ALL SELECT 'flagged', CASE WHEN (SELECT count(*) FROM typed WHERE candidate_id IN (SELECT candidate_id FROM flagged_nf)) = 0
    THEN 'PASS' ELSE 'FAIL' END
  UNION ALL SELECT 'titles', CASE WHEN (SELECT count(*) FROM typed t JOIN cand c USING (candidate_id)
    WHERE t.rank <= 10 AND lower(coalesce(c.profile_current_title, '')) IN {O.inlist(C.AUDIT_NON_ENG_TITLES)}) = 0
    THEN 'PASS' ELSE 'FAIL' END
  UNION ALL SELECT 'reasoning', CASE WHEN (SELECT count(*) FROM typed WHERE reasoning IS NULL OR length(reasoning) < 30)
    + (SELECT count(*) FROM (SELECT row_number() OVER (PARTITION BY coalesce(reasoning, '') ORDER BY row_num) AS occ FROM typed) WHERE occ > 1) = 0
    THEN 'PASS' ELSE 'FAIL' END
  UNION ALL SELECT 'spread', CASE WHEN (SELECT arg_min(score, row_num) - arg_max(score, row_num) FROM typed) < 0.01 THEN 'WARN' ELSE 'PASS' END
  UNION ALL SELECT 'scores', CASE WHEN (SELECT count(DISTINCT score) FROM typed) >= 10 THEN 'PASS' ELSE 'FAIL' END
  UNION ALL SELECT 'ids', CASE WHEN (SELECT count(*) FROM typed WHERE candidate_id NOT IN (SELECT candidate_id FROM cand)) = 0
    THEN 'PASS' ELSE 'FAIL' END)
SELECT layer, status FROM layers
UNION ALL SELECT 'overall', CASE WHEN count(*) FILTER (WHERE status = 'FAIL') = 0 THEN 'PASS' ELSE 'FAIL' END FROM layers"""


@register("audit_summary", SUMMARY_SQL)
def q_audit_summary(spark, sf):
    cells = defective_cells(spark, sf)
    sub = audit.typed(cells)
    fl = flat(spark, sf)
    return audit.layer_summary(
        audit.validate_cells(cells), audit.audit_flagged(sub, audit.flagged_without_features(fl)),
        audit.audit_titles(sub, fl), audit.audit_reasoning(sub), audit.audit_scores(sub),
        audit.audit_unknown_ids(sub, fl))


@register("output_assertions", EXPLAINED + f""",
broken AS (SELECT CASE WHEN rank = 3 THEN 'CAND_0' || candidate_id ELSE candidate_id END AS candidate_id, rank FROM submission WHERE rank <> 7)
SELECT 'unknown_id' AS "check", candidate_id AS detail FROM broken WHERE candidate_id NOT IN (SELECT candidate_id FROM cand)
UNION ALL SELECT 'row_count', '' FROM broken HAVING count(*) <> {DEFAULT.top_k}
UNION ALL SELECT 'rank_set', '' FROM broken HAVING max(rank) <> count(*)""")
def q_output_assertions(spark, sf):
    """K8 on a ranking that lost a row and got an id that isn't in the source."""
    broken = PL.rank_pipeline(spark, sf).where("rank <> 7").withColumn(
        "candidate_id", F.when(F.col("rank") == 3, F.concat(F.lit("CAND_0"), F.col("candidate_id"))).otherwise(F.col("candidate_id")))
    return PL.ranking.output_violations(broken, flat(spark, sf), DEFAULT.top_k)


def _conformance_sql(nulls: str = "") -> str:
    """``nulls``: condition under which a null job size also isn't one of the listed (as in a schema document)."""
    profs = O.inlist(audit.PROFICIENCY)
    modes = O.inlist(audit.WORK_MODES)
    date = "'^[0-9]{4}-[0-9]{2}-[0-9]{2}$'"
    counts = ", ".join(c for c in ("sig_profile_views_30d", "sig_applications_30d", "sig_connection_count", "sig_endorsements", "sig_search_appear_30d", "sig_saved_recruiters_30d"))
    edu = "k % 10 <> 0"
    checks = {
        "required_keys": "SELECT count(*) FROM cand WHERE candidate_id IS NULL",
        "profile_required": "SELECT count(*) FROM cbase WHERE c_name IS NULL OR c_mktsegment IS NULL",
        "job_required": "SELECT count(DISTINCT k) FROM jobs WHERE size_text IS NULL OR company IS NULL OR title IS NULL OR start_text IS NULL",
        "education_required": f"SELECT count(*) FROM cbase WHERE {edu} AND k % 43 = 0",
        "skill_required": "SELECT count(DISTINCT k) FROM sk WHERE name IS NULL OR prof IS NULL OR endorse IS NULL",
        "certification_required": "SELECT count(*) FROM cbase WHERE k % 16 = 0",
        "language_required": "SELECT count(*) FROM cbase WHERE k % 51 = 0",
        "signals_required": f"SELECT count(*) FROM cand WHERE sig_signup_date IS NULL OR sig_last_active_date IS NULL OR least({counts}) IS NULL",
        "candidate_id_pattern": f"SELECT count(*) FROM cand WHERE NOT regexp_matches(candidate_id, '{C.CANDIDATE_ID_PATTERN}')",
        "years_range": "SELECT count(*) FROM cand WHERE NOT profile_years_of_exp BETWEEN 0 AND 50",
        "company_size_enum": f"SELECT count(*) FROM cand WHERE profile_company_size NOT IN {O.inlist(audit.COMPANY_SIZES)}",
        "career_items": "SELECT count(*) FROM cand WHERE NOT career_num_jobs BETWEEN 1 AND 10",
        "job_dates": f"SELECT count(DISTINCT k) FROM jobs WHERE NOT regexp_matches(start_text, {date})",
        "job_duration": "SELECT count(DISTINCT k) FROM jobs WHERE dur < 0",
        "job_company_size_enum": f"SELECT count(DISTINCT k) FROM jobs WHERE size_text NOT IN {O.inlist(audit.COMPANY_SIZES)}{nulls}",
        "education_items": "SELECT count(*) FROM cbase WHERE CASE WHEN k % 10 = 0 THEN 0 WHEN k % 2 = 0 THEN 1 ELSE 2 END > 5",
        "start_year_range": f"SELECT count(*) FROM cbase WHERE {edu} AND NOT CASE WHEN k % 53 = 0 THEN 1950 ELSE 1996 + k % 30 END BETWEEN 1970 AND 2030",
        "end_year_range": "SELECT count(*) FROM cand WHERE edu_latest_end_year > 0 AND NOT edu_latest_end_year BETWEEN 1970 AND 2035",
        "tier_enum": f"SELECT count(*) FROM cand WHERE edu_best_tier <> '' AND edu_best_tier NOT IN {O.inlist(audit.TIERS)}",
        "proficiency_enum": f"SELECT count(DISTINCT k) FROM sk WHERE prof NOT IN {profs}",
        "skill_numbers": "SELECT count(DISTINCT k) FROM sk WHERE endorse < 0 OR dur < 0",
        "language_proficiency_enum": f"SELECT count(*) FROM cbase WHERE k % 3 = 0 AND {O.pick(P.LANGUAGE_LEVELS, 'k')} NOT IN {O.inlist(audit.LANGUAGE_PROFICIENCY)}",
        "completeness_range": "SELECT count(*) FROM cand WHERE NOT sig_profile_completeness BETWEEN 0 AND 100",
        "signal_dates": f"SELECT count(*) FROM cand WHERE NOT regexp_matches(sig_signup_date, {date}) OR NOT regexp_matches(sig_last_active_date, {date})",
        "counts_range": f"SELECT count(*) FROM cand WHERE least({counts}) < 0",
        "response_rate_range": "SELECT count(*) FROM cand WHERE NOT sig_response_rate BETWEEN 0 AND 1",
        "response_time_range": "SELECT count(*) FROM cand WHERE sig_avg_response_hours < 0",
        "interview_rate_range": "SELECT count(*) FROM cand WHERE NOT sig_interview_completion BETWEEN 0 AND 1",
        "offer_rate_range": "SELECT count(*) FROM cand WHERE NOT sig_offer_acceptance BETWEEN -1 AND 1",
        "notice_range": "SELECT count(*) FROM cand WHERE NOT sig_notice_period_days BETWEEN 0 AND 180",
        "salary_range": "SELECT count(*) FROM cand WHERE sig_salary_min < 0 OR sig_salary_max < 0",
        "work_mode_enum": f"SELECT count(*) FROM cand WHERE sig_work_mode NOT IN {modes}",
        "github_range": "SELECT count(*) FROM cand WHERE NOT sig_github_score BETWEEN -1 AND 100",
        "assessment_range": "SELECT count(*) FROM cand WHERE len(list_filter(assess_vals, lambda v: NOT v BETWEEN 0 AND 100)) > 0",
    }
    return CORE + "\nSELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{n}' AS rule, CAST(({q}) AS BIGINT) AS violations" for n, q in checks.items()) + ")"


@register("schema_document", _conformance_sql(" OR size_text IS NULL"))
def q_schema_document(spark, sf):
    """Q12 from a schema document read from a file, over every candidate's line of JSON."""
    path = FS.write_json_rows(spark, [audit.declared_schema()], FS.scratch_path(spark, "schema"))
    document = json_schema.load(spark, path)
    raw = PL.fixture_candidates(spark, sf)
    lines = raw.select(F.to_json(F.struct(*raw.columns), {"ignoreNullFields": "false"}).alias("value"))
    groups = audit.conformance_groups([r.name for r in json_schema.compile_schema(document).rules])
    return json_schema.conformance(lines, document, groups=groups).select("rule", F.col("violations").cast("long"))


@register("schema_conformance", _conformance_sql())
def q_schema_conformance(spark, sf):
    return audit.schema_conformance(PL.fixture_candidates(spark, sf)).select("rule", F.col("violations").cast("long"))


# ---------------------------------------------------------------------------
# G: dataset profile
# ---------------------------------------------------------------------------

def _prof(df: DataFrame) -> DataFrame:
    return df.select("section", "metric", F.coalesce("key", F.lit("")).alias("key"), r9("value").alias("value"))


def _topn(section, metric, key_expr, source, n=None, where="true") -> str:
    lim = f" ORDER BY n DESC, key ASC LIMIT {n}" if n else ""
    return (f"SELECT '{section}' AS section, '{metric}' AS metric, CAST(key AS VARCHAR) AS key, CAST(n AS DOUBLE) AS value "
            f"FROM (SELECT {key_expr} AS key, count(*) AS n FROM {source} WHERE {where} GROUP BY 1{lim})")


def _scalar(section, metric, key, expr, source) -> str:
    return f"SELECT '{section}' AS section, '{metric}' AS metric, '{key}' AS key, CAST(({expr}) AS DOUBLE) AS value FROM {source}"


def _describe(section, metric, long_source, key_prefix=True) -> str:
    """SQL for grouped_describe over a (g, v) relation."""
    key = "g || '.' || stat" if key_prefix else "stat"
    ranked = (f"(SELECT g, v, row_number() OVER (PARTITION BY g ORDER BY v) - 1 AS pos, "
              f"count(*) OVER (PARTITION BY g) AS n FROM {long_source})")
    basic = " UNION ALL ".join(
        f"SELECT g, '{st}' AS stat, CAST({expr} AS DOUBLE) AS value FROM {long_source} GROUP BY g"
        for st, expr in (("n", "count(*)"), ("min", "min(v)"), ("max", "max(v)"), ("mean", "avg(v)"),
                         ("std", "coalesce(stddev_samp(v), 0.0)")))
    pcts = " UNION ALL ".join(
        f"SELECT g, '{st}', v FROM {ranked} WHERE pos = CAST(floor(n * CAST({p} AS DOUBLE)) AS BIGINT)"
        for st, p in (("p25", 0.25), ("p75", 0.75), ("p90", 0.9)))
    return f"""SELECT '{section}' AS section, '{metric}' AS metric, {key} AS key, value FROM (
  {basic}
  UNION ALL SELECT g, 'median', avg(v) FROM {ranked} WHERE pos = (n - 1) // 2 OR pos = n // 2 GROUP BY g
  UNION ALL {pcts})"""


def _bins() -> str:
    y = "profile_years_of_exp"
    whens = " ".join(f"WHEN {y} < {b} THEN '{label}'" for b, label in C.EXPERIENCE_BINS)
    return f"(CASE {whens} ELSE '{C.EXPERIENCE_TOP_BIN}' END)"


EDU_ENTRIES = (f"edu_e AS (SELECT k, {O.pick(P.TIERS, 'k')} AS tier, {O.pick(P.DEGREES, 'k')} AS degree, "
               f"{O.pick(P.FIELDS, 'k')} AS field FROM customer_k WHERE k % 10 <> 0 UNION ALL "
               f"SELECT k, {O.pick(P.TIERS, 'k + 2')}, {O.pick(P.DEGREES, 'k + 3')}, {O.pick(P.FIELDS, 'k + 1')} "
               f"FROM customer_k WHERE k % 10 <> 0 AND k % 2 <> 0)")

SIG_LONG = "sig_long AS (" + " UNION ALL ".join(
    f"SELECT '{name}' AS g, CAST({col} AS DOUBLE) AS v FROM cand" + (f" WHERE {col} <> -1" if sentinel is not None else "")
    for (name, sentinel), col in zip(profile.SIGNAL_STATS, [
        "sig_profile_completeness", "sig_response_rate", "sig_avg_response_hours", "sig_notice_period_days",
        "sig_interview_completion", "sig_search_appear_30d", "sig_saved_recruiters_30d", "sig_github_score",
        "sig_offer_acceptance"])) + ")"

PROFILE_BASE = CORE + ",\ncustomer_k AS (SELECT k FROM cbase),\n" + EDU_ENTRIES + ",\n" + SIG_LONG + \
    ",\nyears_long AS (SELECT 'years' AS g, profile_years_of_exp AS v FROM cand)"

PROFILE_SECTIONS = {
    "profile_overview": [
        _scalar("overview", "total_candidates", "", "count(*)", "cand"),
        _scalar("overview", "india_percentage", "",
                "CASE WHEN count(*) > 0 THEN CAST(count(*) FILTER (WHERE profile_country = 'India') AS DOUBLE) / count(*) * 100 ELSE 0 END",
                "cand"),
    ],
    "profile_value_counts": [
        _topn("distribution", "title", "profile_current_title", "cand", 20),
        _topn("distribution", "industry", "profile_current_industry", "cand", 20),
        _topn("distribution", "country", "profile_country", "cand", 20),
    ],
    "profile_experience": [
        _topn("experience", "bin", _bins(), "cand"),
        _describe("experience", "years", "years_long", key_prefix=False),
    ],
    "profile_skills": [
        _scalar("skills", "unique_skills", "", "count(DISTINCT name)", "sk"),
        _topn("skills", "top_skill", "name", "sk", 50),
        _topn("skills", "proficiency", "prof", "sk"),
        _topn("skills", "skills_per_candidate", "skills_count", "cand"),
    ] + [
        _scalar("skills", "critical_coverage", g, f"count(DISTINCT k) FILTER (WHERE lower(name) IN {O.inlist(vals)})", "sk")
        for g, vals in C.PROFILE_SKILL_GROUPS
    ],
    "profile_companies": [
        _topn("companies", "top_company", "profile_current_company", "cand", 30),
        _scalar("companies", "current_consulting", "",
                f"count(*) FILTER (WHERE lower(profile_current_company) IN {O.inlist(C.PROFILE_CONSULTING)})", "cand"),
        _scalar("companies", "only_consulting", "", "count(*)",
                f"(SELECT k FROM jobs GROUP BY k HAVING bool_and(lower(company) IN {O.inlist(C.PROFILE_CONSULTING)}))"),
    ],
    "profile_signals": [
        _describe("signals", "stat", "sig_long"),
        _scalar("signals", "count", "open_to_work", "count(*) FILTER (WHERE sig_open_to_work)", "cand"),
        _scalar("signals", "count", "no_github", "count(*) FILTER (WHERE sig_github_score = -1)", "cand"),
        _scalar("signals", "count", "verified_email", "count(*) FILTER (WHERE sig_verified_email)", "cand"),
        _scalar("signals", "count", "verified_phone", "count(*) FILTER (WHERE sig_verified_phone)", "cand"),
        _scalar("signals", "count", "linkedin_connected", "count(*) FILTER (WHERE sig_linkedin_connected)", "cand"),
        _scalar("signals", "count", "inactive_more_than_90_days",
                "count(*) FILTER (WHERE date_diff('day', TRY_CAST(sig_last_active_date AS DATE), DATE '2026-06-01') BETWEEN 91 AND 180)", "cand"),
        _scalar("signals", "count", "inactive_more_than_180_days",
                "count(*) FILTER (WHERE date_diff('day', TRY_CAST(sig_last_active_date AS DATE), DATE '2026-06-01') > 180)", "cand"),
    ],
    "profile_career": [
        _topn("career", "jobs_per_candidate", "career_num_jobs", "cand"),
        _topn("career", "top_industry", "industry", "jobs", 20),
        _scalar("career", "mean_job_duration", "", "coalesce(avg(dur), 0.0)", "jobs"),
        _scalar("career", "with_current_job", "", "count(DISTINCT k) FILTER (WHERE is_current)", "jobs"),
    ],
    "profile_education": [
        _topn("education", "tier", "tier", "edu_e"),
        _topn("education", "top_degree", "degree", "edu_e", 20),
        _topn("education", "top_field", "field", "edu_e", 20),
        _scalar("education", "cs_related", "", "count(DISTINCT k) FILTER (WHERE " + " OR ".join(
            f"contains(lower(field), '{f}')" for f in C.PROFILE_CS_FIELDS) + ")", "edu_e"),
    ],
    "profile_integrity": [
        _scalar("integrity", "indicator", "salary_inversion", "count(*) FILTER (WHERE sig_salary_min > sig_salary_max)", "cand"),
        _scalar("integrity", "indicator", "experience_vs_education_mismatch",
                "count(*) FILTER (WHERE edu_latest_end_year > 0 AND profile_years_of_exp > (2026 - edu_latest_end_year) + 2)", "cand"),
        _scalar("integrity", "indicator", "career_duration_mismatch",
                "count(*) FILTER (WHERE career_total_months > profile_years_of_exp * 12 * CAST(1.5 AS DOUBLE) "
                "OR career_total_months < profile_years_of_exp * 12 * CAST(0.3 AS DOUBLE))", "cand"),
        _scalar("integrity", "indicator", "skill_stuffer", "count(*)",
                "(SELECT k FROM sk GROUP BY k HAVING count(*) FILTER (WHERE prof IN ('advanced', 'expert')) >= 8 "
                "AND count(*) FILTER (WHERE prof IN ('advanced', 'expert') AND endorse = 0) >= 6)"),
    ],
}

PROFILE_FNS = {
    "profile_overview": lambda raw: profile.overview(raw),
    "profile_value_counts": lambda raw: profile.distributions(raw),
    "profile_experience": lambda raw: profile.experience(raw),
    "profile_skills": lambda raw: profile.skills(raw),
    "profile_companies": lambda raw: profile.companies(raw),
    "profile_signals": lambda raw: profile.signals(raw),
    "profile_career": lambda raw: profile.career(raw),
    "profile_education": lambda raw: profile.education(raw),
    "profile_integrity": lambda raw: profile.integrity_indicators(raw),
}


def _profile_sql(parts: list[str]) -> str:
    body = "\nUNION ALL ".join(f"SELECT * FROM ({p})" for p in parts)
    return PROFILE_BASE + f"\nSELECT section, metric, coalesce(key, '') AS key, {O.r9('value')} AS value FROM (\n{body})"


for _name, _parts in PROFILE_SECTIONS.items():
    def _mkp(fn):
        return lambda spark, sf: _prof(fn(PL.fixture_candidates(spark, sf)))
    register(_name, _profile_sql(_parts))(_mkp(PROFILE_FNS[_name]))


register("profile_full", _profile_sql([p for parts in PROFILE_SECTIONS.values() for p in parts]))(
    lambda spark, sf: _prof(profile.full_profile(PL.fixture_candidates(spark, sf))))


# ---------------------------------------------------------------------------
# S: file sources / sinks and streaming, over files Spark derives from the tables
# ---------------------------------------------------------------------------

from ..streaming import scoring as ST  # noqa: E402
from .queries import ORACLE  # noqa: E402


def _jsonl_copy(spark, sf, gzip=False) -> str:
    """The fixture candidates written as JSONL under the shared scratch folder, by as many tasks as read them."""
    path = FS.scratch_path(spark, "candidates-jsonl")
    return FS.write_jsonl(PL.fixture_candidates(spark, sf), path, gzip=gzip)


_NUMBER = "CAST(substr(candidate_id, 6) AS BIGINT)"


@register("jsonl_quarantine", CORE + f"""
SELECT CASE {_NUMBER} % 50 WHEN 1 THEN 'malformed' WHEN 2 THEN 'not_object' WHEN 3 THEN 'profile.years_of_experience' WHEN 4 THEN 'skills'
  WHEN 5 THEN 'career_history' WHEN 6 THEN 'signals.notice_period_days' ELSE 'good' END AS reason,
  count(*) AS n, {O.r9('sum(CASE WHEN ' + _NUMBER + ' % 50 IN (1, 2, 3, 4, 5, 6) THEN 0 WHEN ' + _NUMBER + ' % 50 = 7 THEN 7 ELSE profile_years_of_exp END)')} AS years
FROM cand GROUP BY 1""")
def q_jsonl_quarantine(spark, sf):
    """S1–S4 over lines with injected faults: counts by reason, and the years that the good records hold."""
    raw = PL.fixture_candidates(spark, sf)
    case = F.pmod(F.substring("candidate_id", 6, 20).cast("long"), F.lit(50))

    def line(**parts):
        return F.to_json(F.struct(*[parts.get(c, F.col(c)).alias(c) for c in raw.columns]), {"ignoreNullFields": "false"})

    plain = F.to_json(F.struct(*raw.columns))
    years = lambda v: F.col("profile").withField("years_of_experience", v)
    value = (F.when(case == 1, F.concat(F.lit("{"), plain)).when(case == 2, F.concat(F.lit("["), plain, F.lit("]")))
             .when(case == 3, line(profile=years(F.lit("abc")))).when(case == 4, line(skills=F.lit("python")))
             .when(case == 5, line(career_history=F.array(F.lit(5)))).when(case == 6, line(signals=F.col("signals").withField("notice_period_days", F.lit(None).cast("int"))))
             .when(case == 7, F.to_json(F.struct(*[years(F.lit("7")).alias(c) if c == "profile" else F.col(c) for c in raw.columns]))).otherwise(plain))
    path = FS.write_lines(raw.select(value.alias("value")), FS.scratch_path(spark, "faulty-jsonl"))
    good, bad = FS.stage_candidates(spark, path)
    held = good.select(F.lit("good").alias("reason"), F.col("profile.years_of_experience").alias("y")).union(bad.select("reason", F.lit(0.0)))
    return held.groupBy("reason").agg(F.count(F.lit(1)).alias("n"), r9(F.sum("y")).alias("years"))


@register("jsonl_flatten_career", ORACLE["flatten_career"])
def q_jsonl_flatten_career(spark, sf):
    from ..operators.flatten import flatten
    good, _ = FS.read_candidates(spark, _jsonl_copy(spark, sf))
    cols = ["candidate_id", *S.CAREER_COLUMNS]
    ints = {"career_num_jobs", "career_total_months"}
    return flatten(good).select(*[F.col(c).cast("long").alias(c) if c in ints else F.col(c) for c in cols])


@register("jsonl_gzip_skills", ORACLE["flatten_skills"])
def q_jsonl_gzip_skills(spark, sf):
    from ..operators.flatten import flatten
    good, _ = FS.read_candidates(spark, _jsonl_copy(spark, sf, gzip=True))
    return flatten(good).select("candidate_id", "skills_names", F.col("skills_count").cast("long"),
                                F.col("skills_advanced_count").cast("long"),
                                F.col("skills_total_endorsements").cast("long"), "skills_avg_duration")


@register("stream_scores", CORE + "\nSELECT candidate_id, suspicion_score, behavioral_score, final_score FROM scored")
def q_stream_scores(spark, sf):
    src = _jsonl_copy(spark, sf)
    sink, ckpt = FS.scratch_path(spark, "stream-sink"), FS.scratch_path(spark, "stream-ckpt")
    ST.stream_scores(spark, src, sink, ckpt).awaitTermination()
    return spark.read.parquet(sink).select("candidate_id", "suspicion_score", "behavioral_score", "final_score")


@register("stream_topk", CORE + "\nSELECT candidate_id, final_score FROM scored "
          "ORDER BY final_score DESC NULLS LAST, candidate_id LIMIT 100")
def q_stream_topk(spark, sf):
    src = _jsonl_copy(spark, sf)
    out, ckpt = FS.scratch_path(spark, "stream-topk"), FS.scratch_path(spark, "stream-topk-ckpt")
    ST.stream_topk(spark, src, out, ckpt, k=DEFAULT.top_k).awaitTermination()
    return ST.read_topk(spark, out)


@register("submission_csv", EXPLAINED + "\nSELECT candidate_id, rank, score, reasoning FROM submission")
def q_submission_csv(spark, sf):
    folder = FS.write_submission(PL.rank_pipeline(spark, sf), FS.scratch_path(spark, "submission"))
    return FS.read_submission(spark, FS.single_csv_file(spark, folder))


FILE_SQL = CELLS_SQL.replace("FROM lagged),\ncv AS", "FROM lagged WHERE rank <> 90),\ncv AS") + f"""
SELECT 'header' AS "check", 'error' AS severity, CAST(1 AS BIGINT) AS row_num, 'candidate_id,rank,score,reason' AS detail
UNION ALL SELECT 'column_count', 'error', CAST(91 AS BIGINT), 'cells 5' FROM submission WHERE rank = 90
UNION ALL SELECT * FROM ({VIOLATIONS_BODY}) WHERE "check" <> 'row_count'"""


@register("submission_file_contract", FILE_SQL)
def q_submission_file_contract(spark, sf):
    """The defective submission as a CSV file with a wrong header, a quoted newline, and a row of five cells."""
    cells = defective_cells(spark, sf)
    quoted = lambda c: F.concat(F.lit('"'), F.replace(F.coalesce(c, F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))
    reason = F.when(F.col("row_num") == 3, F.concat(F.col("reasoning"), F.lit("\n"))).otherwise(F.col("reasoning"))
    line = F.concat_ws(",", *[quoted(c) for c in (F.col("candidate_id"), F.col("rank"), F.col("score"), reason)])
    line = F.when(F.col("row_num") == 91, F.concat(line, F.lit(",more"))).otherwise(line)
    head = spark.createDataFrame([(1, "candidate_id,rank,score,reason")], "row_num long, value string")
    rows = head.union(cells.select("row_num", line.alias("value")))
    folder = FS.scratch_path(spark, "defective-submission")
    rows.coalesce(1).sortWithinPartitions("row_num").select("value").write.text(folder)      # a file of a hundred rows
    return audit.validate_rows(spark, FS.single_csv_file(spark, folder), "submission.csv")


# ---------------------------------------------------------------------------
# T/B operators on the driver's own long texts and activity log
# ---------------------------------------------------------------------------

from ..functions import text as X  # noqa: E402
from ..operators import engagement as EN  # noqa: E402
from ..session import read_table, spread  # noqa: E402

# a taxonomy taken from the documents' own (invented) vocabulary
TEXT_TAXONOMY = ("tion", "ing", "the", "ere", "and", "ou", "nt", "sh", "ly", "qz")


def _doc_counts(spark, sf, docs=None, *keep):
    docs = spread((read_table(spark, sf, "documents") if docs is None else docs).select("doc_id", *keep, "text")).select("doc_id", *keep, X.lower0("text").alias("t"))
    return docs.select(
        "doc_id", *keep,
        X.count_substrings("t", DEFAULT.retrieval_keywords).cast("long").alias("retrieval_kw"),
        X.count_substrings("t", DEFAULT.production_keywords).cast("long").alias("production_kw"),
        X.bool_int(X.any_substring("t", C.AI_TITLE_WORDS)).alias("mentions_ai"),
        X.count_substrings("t", TEXT_TAXONOMY).cast("long").alias("text_kw"))


_DOC_SQL = (f"docs AS (SELECT doc_id, lower(coalesce(text, '')) AS t FROM documents), "
            f"doc_counts AS (SELECT doc_id, {O.count_sub('t', DEFAULT.retrieval_keywords)} AS retrieval_kw, "
            f"{O.count_sub('t', DEFAULT.production_keywords)} AS production_kw, "
            f"{O.b(O.any_sub('t', C.AI_TITLE_WORDS))} AS mentions_ai, {O.count_sub('t', TEXT_TAXONOMY)} AS text_kw FROM docs)")


@register("text_keyword_counts", f"WITH {_DOC_SQL} SELECT * FROM doc_counts")
def q_text_keyword_counts(spark, sf):
    return _doc_counts(spark, sf)


@register("text_quality_calibration", f"""WITH {_DOC_SQL}
SELECT l.quality AS label, {O.r9('avg(CAST(d.text_kw AS DOUBLE))')} AS mean_text_kw,
  {O.r9('avg(CAST(d.retrieval_kw AS DOUBLE))')} AS mean_retrieval_kw, count(*) AS n
FROM doc_counts d JOIN labels l USING (doc_id) GROUP BY l.quality""")
def q_text_quality_calibration(spark, sf):
    labels = read_table(spark, sf, "labels").select("doc_id", "quality")
    docs = read_table(spark, sf, "documents").join(labels, "doc_id")                     # count keywords in labelled documents only
    return _doc_counts(spark, sf, docs, "quality").groupBy(F.col("quality").alias("label")).agg(
        r9(F.avg(F.col("text_kw").cast("double"))).alias("mean_text_kw"),
        r9(F.avg(F.col("retrieval_kw").cast("double"))).alias("mean_retrieval_kw"),
        F.count(F.lit(1)).alias("n"))


EVENTS_REF = "2024-02-01"


@register("events_recency", f"""
SELECT user_id, strftime(max(ts), '%Y-%m-%d') AS last_active_date,
  CAST(greatest(date_diff('day', CAST(max(ts) AS DATE), DATE '{EVENTS_REF}'), 0) AS INTEGER) AS days_inactive,
  {O.ladder("greatest(date_diff('day', CAST(max(ts) AS DATE), DATE '" + EVENTS_REF + "'), 0)", C.RECENCY_LADDER, C.RECENCY_DEFAULT)} AS recency_score
FROM events GROUP BY user_id""")
def q_events_recency(spark, sf):
    return EN.recency_from_events(read_table(spark, sf, "events"), EVENTS_REF)


_BLANK = "CAST(substr(candidate_id, 6) AS BIGINT) % 90 = 7"
_IMPUTED = ("feat_dim1_eng_title_ratio", "feat_dim4_skill_trust_score", "feat_dim5_years_exp", "feat_dim7_salary_reasonable")


def _with_gaps(df: DataFrame) -> DataFrame:
    """Feature rows with missing inputs by arithmetic on the id: all of them, one as null, one as NaN."""
    number = F.substring("candidate_id", 6, 20).cast("long")
    gap = {c: F.when(F.pmod(number, F.lit(90)) == 7, F.lit(None)).when(F.pmod(number, F.lit(11 + i)) == 3, F.lit(float("nan")) if i % 2 else F.lit(None))
           .otherwise(F.col(c).cast("double")) for i, c in enumerate(_IMPUTED)}
    blank = {c: F.when(F.pmod(number, F.lit(90)) != 7, F.col(c).cast("double")) for c in FEATURE_COLUMNS if c not in gap}
    return df.select("candidate_id", *[(gap | blank)[c].alias(c) for c in FEATURE_COLUMNS])


@register("model_contract", CORE + f"\nSELECT CAST(count(*) FILTER (WHERE {_BLANK}) AS BIGINT) AS all_missing_rows, "
          f"CAST({len(FEATURE_COLUMNS)} AS BIGINT) AS n_features FROM feat")
def q_model_contract(spark, sf):
    """M1: every model input present (else KeyError) and rows with all inputs missing."""
    df = _with_gaps(scored(spark, sf))
    model.check_contract(df, FEATURE_COLUMNS)
    return model.all_missing_rows(df, FEATURE_COLUMNS).select(
        F.coalesce("all_missing_rows", F.lit(0)).cast("long").alias("all_missing_rows"),
        F.lit(len(FEATURE_COLUMNS)).cast("long").alias("n_features"))


@register("model_imputation", CORE + "\nSELECT candidate_id, " + ", ".join(
    f"CASE WHEN {_BLANK} OR CAST(substr(candidate_id, 6) AS BIGINT) % {11 + i} = 3 THEN CAST(-1 AS DOUBLE) ELSE CAST({c} AS DOUBLE) END AS {c}"
    for i, c in enumerate(_IMPUTED)) + " FROM feat")
def q_model_imputation(spark, sf):
    """M2: missing and NaN inputs become -1."""
    return model.impute(_with_gaps(scored(spark, sf)), list(_IMPUTED)).select("candidate_id", *[F.col(f"__x_{c}").alias(c) for c in _IMPUTED])
