"""Run metrics: numbers that a job takes on the side equal those of separate passes."""
import json
import logging

import pytest
from conftest import base_record
from pyspark.sql import functions as F

from talentlens.config import RankConfig
from talentlens.operators import metrics as M
from talentlens.plans import jobs
from talentlens.sources import files as FS


@pytest.fixture(scope="module")
def lines(spark, tmp_path_factory):
    good = [base_record(i, profile={**base_record()["profile"], "years_of_experience": i % 20}) for i in range(1, 151)]
    wrong = [base_record(900, skills="none"), base_record(901, profile=[1]), [1, 2]]
    text = [json.dumps(r) for r in good] + ["", "  ", "{broken"] + [json.dumps(r) for r in wrong]
    path = tmp_path_factory.mktemp("run") / "candidates.jsonl"
    path.write_text("\n".join(text) + "\n", encoding="utf-8")
    return str(path)


def test_rank_job_reports_what_it_read_skipped_scored_and_chose(spark, lines):
    seen = M.RunMetrics(1e9)
    out = jobs.rank_job(spark, lines, FS.scratch_path(spark, "sub"), metrics=seen)
    assert (out["lines"], out["records"], out["skipped"]) == (156, 154, 4)
    assert out["skipped_by_reason"] == {"malformed": 1, "not_object": 1, "skills": 1, "profile": 1}
    assert out["scored"]["rows"] == 150 and out["violations"] == [] and not out["over_budget"]
    assert set(out["seconds"]) == {"load", "rank", "check"} and out["elapsed"] == pytest.approx(sum(out["seconds"].values()))
    ranked = FS.read_submission(spark, out["output"])
    low, high = ranked.agg(F.min("score"), F.max("score")).first()
    assert out["score_range"] == (low, high) and out["flagged_in_top"] == 0
    report = {(r.stage, r.metric): r.value for r in seen.report(spark).collect()}
    assert report["load", "usable"] == 150 and report["top", "rows"] == 100 and ("seconds", "rank") in report


def test_a_run_over_its_budget_warns(spark, lines, caplog):
    with caplog.at_level(logging.WARNING, "talentlens"):
        out = jobs.rank_job(spark, lines, FS.scratch_path(spark, "sub"), RankConfig(budget_seconds=0.0))
    assert out["over_budget"] and "the budget is 0.0 s" in caplog.text


def test_metrics_of_a_plan_add_no_scan_and_keep_columns_pruned(spark, lines):
    from talentlens.operators.flatten import flatten
    from talentlens.plans import pipeline as PL
    good, _ = FS.stage_candidates(spark, lines)
    scored = PL.score_candidates(flatten(good))
    plain, watched = PL.rank_candidates(scored), PL.rank_candidates(scored, metrics=M.RunMetrics())
    explained = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert explained(watched).count("FileScan") == explained(plain).count("FileScan") == 1
    assert explained(watched).count("Exchange") == explained(plain).count("Exchange")
    assert plain.collect() == watched.collect()


def test_observed_numbers_equal_those_of_a_pass(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 10 > 0, F.col("id") * 0.5).alias("x"), (F.col("id") % 3 == 0).alias("hit"))
    seen = M.RunMetrics()
    seen.watch(df, "s", ["x"], hits=M.count_of(F.col("hit"))).write.format("noop").mode("overwrite").save()
    got = seen.of("s")
    exact = df.agg(F.count(F.lit(1)), F.avg("x"), F.stddev_samp("x"), F.min("x"), F.max("x"), F.count_if("hit")).first()
    assert [got[k] for k in ("rows", "x_mean", "x_std", "x_min", "x_max", "hits")] == pytest.approx(list(exact))
    with pytest.raises(ValueError, match="watched already"):
        seen.watch(df, "s")
    one = M.summaries(df, {"a": "x", "b": "x"}).collect()
    assert [r.stage for r in one] == ["a", "b"] and tuple(one[0])[1:] == pytest.approx(list(exact)[:5])
    assert M.summaries(df.limit(0), {"a": "x"}).collect()[0].rows == 0


def test_signals_are_looked_for_without_a_pass_of_their_own(spark, lines):
    with pytest.raises(FS.SignalsMissing):
        FS.stage_candidates(spark, lines, "other_key")
