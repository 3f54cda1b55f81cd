"""End-to-end jobs over the fixture written as JSONL (the reference's input format)."""
import pytest
from conftest import SF001

from talentlens.config import DEFAULT, TrainConfig
from talentlens.operators import model
from talentlens.plans import jobs
from talentlens.plans import pipeline as PL
from talentlens.sources import files as FS


@pytest.fixture(scope="module")
def jsonl(spark):
    return FS.write_jsonl(PL.fixture_candidates(spark, SF001), FS.scratch_path(spark, "jobs-jsonl"))


def test_rank_then_qa(spark, jsonl):
    out = FS.scratch_path(spark, "sub")
    res = jobs.rank_job(spark, jsonl, out)
    assert res["skipped"] == 0 and res["violations"] == []
    csv = FS.single_csv_file(spark, out)
    with open(csv.replace("file:", ""), encoding="utf-8") as fh:
        head = fh.readline().strip()
    assert head == '"candidate_id","rank","score","reasoning"'
    summary = {r.layer: r.status for r in jobs.qa_job(spark, csv, jsonl).collect()}
    assert summary["contract"] == "PASS" and summary["ids"] == "PASS" and "overall" in summary


def test_label_train_and_score(spark, jsonl):
    labels = FS.scratch_path(spark, "labels")
    dist = {r.label: r.n for r in jobs.label_job(spark, jsonl, labels, target_total=60).collect()}
    assert sum(dist.values()) == 60
    # resume: nothing pending any more, so a second run appends nothing
    dist2 = {r.label: r.n for r in jobs.label_job(spark, jsonl, labels, target_total=60).collect()}
    assert dist2 == dist
    model_path = FS.scratch_path(spark, "model")
    out = jobs.train_job(spark, jsonl, labels, model_path, TrainConfig(max_iter=3, folds=3))
    assert out["config"]["training_samples"] == 60 and len(out["report"]["cv_scores"]) == 3
    fitted, cols = model.load(model_path)
    scored = PL.score_candidates(PL.flat_candidates(spark, SF001), DEFAULT, fitted, cols)
    assert scored.where("model_score < 0 or model_score > 1").count() == 0


def test_profile_job(spark, jsonl):
    out = jobs.profile_job(spark, jsonl, FS.scratch_path(spark, "profile"))
    rows = spark.read.json(out)
    assert rows.where("metric = 'total_candidates'").collect()[0].value == spark.read.json(jsonl).count()


def test_no_machine_local_scratch_on_a_cluster():
    from types import SimpleNamespace

    from talentlens.session import checkpoint_dir
    conf = SimpleNamespace(get=lambda key, default=None: default)
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        spark = SimpleNamespace(sparkContext=SimpleNamespace(getConf=lambda: conf, master=master, applicationId="x"))
        with pytest.raises(RuntimeError):
            checkpoint_dir(spark)
