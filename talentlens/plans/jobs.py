"""Job-level plans that mirror the reference's entry points, as Spark jobs.

* :func:`rank_job`     — candidates file → ranked, explained top-k CSV (+ output checks)
* :func:`label_job`    — cascade sample → pending → teacher → appended labels
* :func:`train_job`    — labels ⋈ features → constant drop → CV → fit → artefacts
* :func:`qa_job`       — submission contract + quality audits → layer summary
* :func:`profile_job`  — dataset profile report

Each reads its inputs from files (or frames), never collects a table to the
driver, and writes its outputs with the DataFrame writer.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, RankConfig, RubricConfig, TrainConfig
from ..operators import audit, labeling, model, profile, trees
from ..operators.features import FEATURE_COLUMNS
from ..operators.flatten import flatten
from ..operators.metrics import RunMetrics
from ..session import cut_lineage
from ..sources import files as FS
from ..sources.label_log import LabelLog
from . import pipeline as PL


def rank_job(spark: SparkSession, candidates_path: str, out_path: str, cfg: RankConfig = DEFAULT,
             model_path: str | None = None, metrics: RunMetrics | None = None) -> dict:
    """Rank a candidates file; the result says what was read, skipped, scored and chosen, and how long each phase took.

    All counts come from the two actions that stage the records and rank them (``metrics``), not from passes of their
    own.  A run that exceeds ``cfg.budget_seconds`` says so (``over_budget``) and warns at the phase's end; it isn't cut off.
    """
    metrics = metrics or RunMetrics(cfg.budget_seconds)
    # one JSON parse; scoring and the id check read the staged table
    staged, ranked_path = FS.scratch_path(spark, "candidates-staged"), FS.scratch_path(spark, "ranked")
    good, _ = FS.stage_candidates(spark, candidates_path, cfg.signals_key, out=staged, metrics=metrics)
    metrics.mark("load")
    flat = flatten(good, cfg.signals_key)
    scorer, cols = (model.load(model_path) if model_path else (None, None))
    scored = PL.score_candidates(flat, cfg, scorer, cols)
    ranked = spark.read.parquet(FS.stage_parquet(PL.rank_candidates(scored, cfg, metrics=metrics), ranked_path))      # k rows
    metrics.mark("rank")
    FS.write_submission(ranked, out_path, cfg.score_decimals)
    violations = PL.ranking.output_violations(ranked, flat, cfg.top_k).collect()   # ≤ k rows
    FS.drop_path(spark, staged)
    FS.drop_path(spark, ranked_path)
    metrics.mark("check")
    load, top = metrics.of("load"), metrics.of("top")
    return {"lines": metrics.of("lines")["rows"], "records": load["rows"], "skipped": load["rows"] - load["usable"],
            "skipped_by_reason": {k.removeprefix("skipped "): n for k, n in load.items() if k.startswith("skipped ") and n},
            "scored": metrics.of("scored"), "flagged_in_top": top["flagged"], "score_range": (top["final_score_min"], top["final_score_max"]),
            "seconds": dict(metrics.seconds), "elapsed": metrics.elapsed, "over_budget": metrics.over_budget,
            "violations": [r.asDict() for r in violations], "output": out_path}


def label_job(spark: SparkSession, candidates_path: str, labels_path: str, target_total: int = 3000,
              teacher: Callable[[list[str]], list[str]] | None = None, template: str = "", job_text: str = "",
              cfg: RankConfig = DEFAULT, rubric: RubricConfig = RubricConfig(), chunk: int = 200, pause: float = 5.0) -> DataFrame:
    """Label the pending part of the cascade sample; a teacher's labels are committed ``chunk`` records at a time.

    ``labels_path`` is a label log (or a CSV of earlier labels, which then only counts as labelled): a job that dies
    keeps its committed chunks, and one that is run again labels what is still pending.
    """
    log = LabelLog(spark, labels_path)
    staged = FS.scratch_path(spark, "candidates-staged")
    raw, _ = FS.stage_candidates(spark, candidates_path, cfg.signals_key, out=staged, keep_text=True)     # one parse, many passes
    scored = PL.featurize(flatten(raw, cfg.signals_key), cfg)
    sample = labeling.cascade_sample(scored, target_total, cfg=cfg)
    todo = labeling.pending(sample, FS.read_labels(spark, labels_path))
    if teacher is None:
        log.append(labeling.rubric_labels(FS.fetch_by_ids(scored, todo), rubric, cfg))
    else:
        records = cut_lineage(FS.fetch_by_ids(raw.select("candidate_id", "value"), todo))      # target_total lines at most
        parts = -(-target_total // chunk)
        for part in range(parts):                       # what is labelled stays, whatever happens to the rest
            own = records.where(F.pmod(F.xxhash64("candidate_id"), F.lit(parts)) == part)
            log.append(labeling.teacher_labels(labeling.render_prompts(own, template, job_text), teacher, pause=pause))
    FS.drop_path(spark, staged)
    return labeling.label_distribution(FS.read_labels(spark, labels_path))


def train_job(spark: SparkSession, candidates_path: str, labels_path: str, model_path: str,
              tc: TrainConfig = TrainConfig(), cfg: RankConfig = DEFAULT) -> dict:
    staged = FS.scratch_path(spark, "candidates-staged")
    raw, _ = FS.stage_candidates(spark, candidates_path, cfg.signals_key, out=staged)
    labels = FS.read_labels(spark, labels_path)
    # features are row-local: restrict to labelled ids first, then featurise
    labelled_raw = FS.fetch_by_ids(raw, labels)
    feats = PL.featurize(flatten(labelled_raw, cfg.signals_key), cfg)
    train = cut_lineage(model.bounded_labels(model.label_join(feats, labels, tc.label_col), tc))
    FS.drop_path(spark, staged)
    cols = model.usable_columns(train, FEATURE_COLUMNS)                           # N2–N3
    folds = model.cross_validate(train, cols, tc).collect()                      # N4–N6 (k rows)
    fitted = model.fit(train, cols, tc)                                          # N5
    model.save(fitted, model_path, cols)                                         # S12
    FS.stage_parquet(trees.node_table(fitted, cols), model_path + "_nodes")       # the same model for any engine
    importances = model.importances(fitted, cols)                                # N7
    pred = fitted.transform(model.impute(train, cols))
    calib = [r.asDict() for r in model.calibration(pred, tc.label_col).collect()]   # N8 (≤ 6 rows)
    dist = [r.asDict() for r in labeling.label_distribution(train, tc.label_col).collect()]
    cv_rmse = sum(r["rmse"] for r in folds) / len(folds)
    cv_mae = sum(r["mae"] for r in folds) / len(folds)
    config = {"feature_columns": cols, "n_features": len(cols), "training_samples": train.count(),
              "cv_rmse": cv_rmse, "cv_mae": cv_mae}
    report = {"cv_scores": [r.asDict() for r in folds],
              "feature_importances": [{"feature": f, "importance": i} for f, i in importances],
              "hyperparameters": {"maxIter": tc.max_iter, "maxDepth": tc.max_depth, "stepSize": tc.step_size,
                                  "subsamplingRate": tc.subsampling_rate, "featureSubsetStrategy": tc.feature_subset,
                                  "minInstancesPerNode": tc.min_instances_per_node, "seed": tc.seed},
              "training_samples": config["training_samples"], "score_distribution": dist, "calibration": calib}
    FS.write_json_rows(spark, [config], model_path + "_feature_config")           # S12
    FS.write_json_rows(spark, [report], model_path + "_training_report")          # S13
    return {"config": config, "report": report}


def qa_job(spark: SparkSession, submission_path: str, candidates_path: str, cfg: RankConfig = DEFAULT) -> DataFrame:
    staged = FS.scratch_path(spark, "candidates-staged")
    raw, _ = FS.stage_candidates(spark, candidates_path, cfg.signals_key, out=staged)     # read by three audits
    flat = flatten(raw, cfg.signals_key)
    contract = cut_lineage(audit.validate_file(spark, submission_path, cfg.top_k))   # Q1
    header, cells, _ = audit.read_cells(spark, submission_path)
    sub = cut_lineage(audit.typed(cells))                                            # ≤ k rows, read once
    summary = cut_lineage(audit.layer_summary(                                       # a row for each layer
        contract, audit.audit_flagged(sub, audit.flagged_without_features(flat, cfg)),
        audit.audit_titles(sub, flat), audit.audit_reasoning(sub), audit.audit_scores(sub),
        audit.audit_unknown_ids(sub, flat)))
    FS.drop_path(spark, staged)
    return summary


def profile_job(spark: SparkSession, candidates_path: str, out_path: str, cfg: RankConfig = DEFAULT) -> str:
    staged = FS.scratch_path(spark, "candidates-staged")
    raw, _ = FS.stage_candidates(spark, candidates_path, cfg.signals_key, out=staged)     # scanned by the profile passes
    out = FS.write_profile(profile.full_profile(raw, cfg.signals_key), out_path)
    FS.drop_path(spark, staged)
    return out
