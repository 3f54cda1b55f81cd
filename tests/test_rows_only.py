"""Brute-force checks for the registered queries that have no SQL oracle (sf0.001)."""
import functools
import json
import math

import pytest
from conftest import SF001

from talentlens.operators import labeling, model
from talentlens.plans import more_queries as MQ
from talentlens.plans.queries import oracle_sql, queries

ROWS_ONLY = {"gbt_cv", "gbt_score", "feature_importances"}


@pytest.fixture(autouse=True)
def few_trees(monkeypatch):
    """The queries fit 300 trees; a few show the same here."""
    monkeypatch.setattr(MQ, "TrainConfig", functools.partial(MQ.TrainConfig, max_iter=5))


def test_rows_only_set_is_exactly_the_model_queries():
    assert set(queries()) - set(oracle_sql()) == ROWS_ONLY


def test_registered_fits_are_full_size():
    from talentlens.config import TrainConfig
    assert TrainConfig().max_iter == 300 and TrainConfig().max_labels >= 3000


def test_folds_are_balanced(spark):
    sizes = [r["count"] for r in model.with_folds(MQ.sample_frame(spark, SF001), 5, "42").groupBy("fold").count().collect()]
    assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_gbt_cv_folds_partition_the_sample(spark):
    rows = queries()["gbt_cv"](spark, SF001).collect()
    sample = MQ.sample_frame(spark, SF001).count()
    assert sorted(r.fold for r in rows) == [0, 1, 2, 3, 4]
    assert sum(r.n for r in rows) == sample
    assert all(math.isfinite(r.rmse) and 0 <= r.mae <= r.rmse for r in rows)


def test_feature_importances_normalised(spark):
    rows = queries()["feature_importances"](spark, SF001).collect()
    assert rows and abs(sum(r.importance for r in rows) - 1.0) < 1e-9
    assert [r.importance for r in rows] == sorted((r.importance for r in rows), reverse=True)


def test_gbt_score_is_a_valid_ranking(spark):
    rows = queries()["gbt_score"](spark, SF001).orderBy("rank").collect()
    assert [r.rank for r in rows] == list(range(1, 101))
    assert all(0.0 <= r.score <= 1.0 for r in rows)
    assert all(a.score >= b.score for a, b in zip(rows, rows[1:]))
    assert len({r.candidate_id for r in rows}) == 100


REPLIES = {
    "plain": ('{"score": 4, "reasoning": "r"}', (4, "r")), "fence": ('```json\n{"score": 2, "reasoning": "r"}\n```', (2, "r")),
    "blank": ('\n \u00a0```\n{"score": 3, "reasoning": "r"}```\n', (3, "r")), "text": ('{"score": "4", "reasoning": "r"}', (4, "r")),
    "cut": ('{"score": 4.9, "reasoning": ""}', (4, "")), "true": ('{"score": true, "reasoning": "r"}', (1, "r")),
    "half": ('{"score": "4.5", "reasoning": "r"}', None), "null": ('{"score": null, "reasoning": "r"}', None), "object": ('{"score": 4, "reasoning": {}}', None),
    "list": ('["score", "reasoning"]', None), "trail": ('{"score": 4, "reasoning": "r"} so', (1, "Error")), "keys": ('{"score": 4}', (1, "Error")),
    "none": (None, (1, "Error")), "words": ("I think 4", (1, "Error"))}


def test_replies_are_read_as_python_reads_them(spark):
    rows = spark.createDataFrame([(k, r) for k, (r, _) in REPLIES.items() if k != "list"], "candidate_id string, response string")
    got = {r.candidate_id: (r.llm_score, "Error" if r.llm_reasoning.startswith("Error: ") else r.llm_reasoning) for r in labeling.parse_responses(rows).collect()}
    assert got == {k: v for k, (_, v) in REPLIES.items() if v is not None}
    more = {"nan": ('{"score": NaN, "reasoning": "r"}', (1, "Error")), "twice": ('{"score": 1, "score": 2, "reasoning": "r"}', (1, "Error")), "blank": ("", (1, "Error")),
            "big": ('{"score": 99999999999, "reasoning": "r"}', None), "sign": ('{"score": " -1_0 ", "reasoning": "é\\n\\"x\\""}', (-10, 'é\n"x"')), "deep": ('{"score": [4], "reasoning": "r"}', None),
            "neg": ('{"reasoning": "r", "score": -4.9}', (-4, "r")), "fences": ('```\n{"score": 1, "reasoning": "```"}\n```', (1, "```")), "array": ("[1]", (1, "Error")),
            "two": ('{"score": 1, "reasoning": "r"}, {"score": 2}', (1, "Error")), "trick": ('{"score": 1, "reasoning": "r"}], [{}', (1, "Error")),
            "key": ('{"score": 1, "reasoning": "r"}, "y": 1', (1, "Error"))}
    rows = spark.createDataFrame([(k, r) for k, (r, _) in more.items()], "candidate_id string, response string")
    parsed = labeling.parse_responses(rows)
    got = {r.candidate_id: (r.llm_score, "Error" if r.llm_reasoning.startswith("Error: ") else r.llm_reasoning) for r in parsed.collect()}
    assert got == {k: v for k, (_, v) in more.items() if v is not None}
    assert "Python" not in parsed._jdf.queryExecution().executedPlan().toString()
    assert labeling.parse_responses(rows.limit(0)).count() == 0


def test_one_failing_record_keeps_the_others(spark):
    def teacher(prompts):
        if any("bad" in p for p in prompts):
            raise ConnectionError("refused")
        return ['{"score": 5, "reasoning": "%s"}' % p for p in prompts]

    prompts = spark.createDataFrame([(f"c{i}", "bad" if i == 3 else f"p{i}") for i in range(8)], "candidate_id string, prompt string").coalesce(1)
    got = {r.candidate_id: (r.llm_score, r.llm_reasoning) for r in labeling.teacher_labels(prompts, teacher, pause=0).collect()}
    assert got == {f"c{i}": (1, "Error: refused") if i == 3 else (5, f"p{i}") for i in range(8)}


def test_a_job_that_breaks_off_keeps_its_labels_and_resumes(spark, tmp_path):
    from talentlens.plans import jobs
    from talentlens.plans import pipeline as PL
    from talentlens.sources import files as FS
    src = FS.write_jsonl(PL.fixture_candidates(spark, SF001), FS.scratch_path(spark, "label-src"))
    labels, flag = FS.scratch_path(spark, "labels"), str(tmp_path / "broken")

    def teacher(prompts, flag=flag):
        import os
        if len(prompts) > 3 and not os.path.exists(flag) and any('"CAND_0000' in p for p in prompts[3:4]):
            open(flag, "w").close()
            os._exit(1)                                   # the worker dies: this part of the job fails
        return ['{"score": 3, "reasoning": "fine"}' for _ in prompts]

    try:
        jobs.label_job(spark, src, labels, target_total=60, teacher=teacher, template="{CANDIDATE_JSON}", chunk=20, pause=0)
    except Exception:  # noqa: BLE001  a task may be retried or not, by the master's setting
        pass
    dist = {r.label: r.n for r in jobs.label_job(spark, src, labels, target_total=60, teacher=teacher, template="{CANDIDATE_JSON}", chunk=20, pause=0).collect()}
    assert dist == {3: 60}


def test_prompts_hold_the_raw_record(spark):
    raw = {"candidate_id": "c1", "unknown": {"é": None}, "skills": [1]}
    rows = spark.createDataFrame([("c1", json.dumps(raw))], "candidate_id string, value string")
    got = labeling.render_prompts(rows, "{JOB_DESCRIPTION}:{CANDIDATE_JSON}", "job").first().prompt
    assert got == "job:" + json.dumps(raw, indent=2)
