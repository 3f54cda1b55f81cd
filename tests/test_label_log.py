"""The label log: replays, broken appends, writers side by side, and the label job over it."""
import json
from concurrent.futures import ThreadPoolExecutor

import pytest
from conftest import base_record

from talentlens.plans import jobs
from talentlens.sources import files as FS
from talentlens.sources.label_log import LabelLog

SCHEMA = "candidate_id string, llm_score int, llm_reasoning string"


@pytest.fixture
def log(spark):
    return LabelLog(spark, FS.scratch_path(spark, "log"))


def held(log):
    return {r.candidate_id: (r.llm_score, r.llm_reasoning) for r in log.labels().collect()}


def rows(spark, *labels):
    return spark.createDataFrame([tuple(x) for x in labels], SCHEMA)


def test_an_empty_log(spark, log):
    assert held(log) == {} and log.commits().count() == 0 and not log.exists()
    assert FS.read_labels(spark, log.path).count() == 0


def test_a_chunk_appended_twice_leaves_one_label(spark, log):
    chunk = rows(spark, ("a", 3, "x\ny"), ("b", 1, None), ("b", 1, None))
    assert [log.append(chunk, "c1"), log.append(chunk, "c1")] == [1, 2]
    assert held(log) == {"a": (3, "x y"), "b": (1, "")}
    log.append(rows(spark, ("b", 5, "later")), "c2")
    assert held(log) == {"a": (3, "x y"), "b": (5, "later")}
    log.append(chunk, "c1")                                          # a late replay is the last word on what it holds
    assert held(log) == {"a": (3, "x y"), "b": (1, "")}
    assert [tuple(r)[0] for r in log.commits().orderBy("number").collect()] == [1, 2, 3, 4]
    assert FS.read_labels(spark, log.path).count() == 2


def test_an_append_that_dies_leaves_nothing(spark, log, monkeypatch):
    log.append(rows(spark, ("a", 2, "ok")), "c1")
    broken = rows(spark, ("a", 0, "lost"), ("z", 4, "lost")).repartition(2).selectExpr(
        "candidate_id", "if(candidate_id = 'z', raise_error('worker lost'), llm_score) AS llm_score", "llm_reasoning")
    with pytest.raises(Exception, match="worker lost"):
        log.append(broken, "c2")
    monkeypatch.setattr(LabelLog, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost")))
    with pytest.raises(RuntimeError, match="driver lost"):
        log.append(rows(spark, ("a", 1, "written, not committed")), "c2")
    monkeypatch.undo()
    assert held(log) == {"a": (2, "ok")}
    log.append(rows(spark, ("z", 4, "again")), "c2")
    assert held(log) == {"a": (2, "ok"), "z": (4, "again")}


def test_writers_side_by_side_get_numbers_of_their_own(spark, log):
    with ThreadPoolExecutor(4) as pool:
        numbers = list(pool.map(lambda i: log.append(rows(spark, (f"c{i}", i % 5, "x"), ("same", i % 5, str(i))), f"w{i}"), range(8)))
    assert sorted(numbers) == list(range(1, 9)) and len(held(log)) == 9
    assert held(log)["same"][1] == str(numbers.index(8))


def test_compaction_keeps_the_labels_and_drops_the_rest(spark, log):
    for i in range(3):
        log.append(rows(spark, ("a", i, "x"), (f"b{i}", i, "y")), "c")
    log.write_attempt(rows(spark, ("dead", 1, "")), "d")
    before = held(log)
    assert log.compact() == 4 and held(log) == before and log.commits().count() == 1
    fs, p = log._file("chunks")[1], log._file("chunks")[0]
    assert len(list(fs.listStatus(p))) == 1
    log.append(rows(spark, ("a", 4, "new")), "c")
    assert held(log)["a"] == (4, "new")
    with pytest.raises(ValueError, match="chunk's name"):
        log.append(rows(spark), "a/b")


def test_a_label_job_that_breaks_off_resumes_without_second_labels(spark, tmp_path):
    path = tmp_path / "c.jsonl"
    path.write_text("\n".join(json.dumps(base_record(i)) for i in range(1, 31)), encoding="utf-8")
    labels, calls = FS.scratch_path(spark, "job-log"), tmp_path / "calls"

    def teacher(prompts, broken):
        with open(calls, "a", encoding="utf-8") as fh:
            fh.write("".join("x\n" for _ in prompts))
        if broken and len(calls.read_text(encoding="utf-8").split()) > 12:
            import os
            os._exit(1)                                              # the worker goes, and the job with it
        return ['{"score": 2, "reasoning": "r"}'] * len(prompts)

    job = lambda broken: jobs.label_job(spark, str(path), labels, 30, lambda p: teacher(p, broken), "{CANDIDATE_JSON}", chunk=5, pause=0)
    with pytest.raises(Exception):
        job(True)
    kept = held(LabelLog(spark, labels))
    assert 0 < len(kept) < 30
    assert {r.label: r.n for r in job(False).collect()} == {2: 30}
    log = LabelLog(spark, labels)
    assert log.commits().agg({"rows": "sum"}).first()[0] == 30        # nobody was labelled twice
