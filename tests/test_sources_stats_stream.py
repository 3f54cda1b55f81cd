import gzip
import json
import os
import random
import tempfile

import pytest
from conftest import SF001, base_record, records_df, with_signals

from talentlens.operators.stats import grouped_describe
from talentlens.sources import files as FS


def write_lines(lines, gz=False):
    d = tempfile.mkdtemp(prefix="tl-jsonl-", dir="/tmp")
    p = os.path.join(d, "cands.jsonl" + (".gz" if gz else ""))
    data = ("\n".join(lines) + "\n").encode()
    with (gzip.open(p, "wb") if gz else open(p, "wb")) as fh:
        fh.write(data)
    return p


LINES = [json.dumps(base_record(1)), "", "   ", "\t", "{bad", "[1]", "{}", json.dumps(base_record(2))]


@pytest.mark.parametrize("gz", [False, True])
def test_jsonl_quarantine(spark, gz):
    good, bad = FS.read_candidates(spark, write_lines(LINES, gz))
    assert sorted(r.candidate_id or "" for r in good.collect()) == ["", "CAND_0000001", "CAND_0000002"]
    assert sorted(r.reason for r in bad.collect()) == ["malformed", "not_object"]


def changed(k=3, **parts):
    rec = base_record(k)
    for path, value in parts.items():
        *way, last = path.split("__")
        at = rec
        for w in way:
            at = at[int(w)] if w.isdigit() else at[w]
        at[last] = value
    return rec


REJECTED = [
    ({"profile": None}, "profile"), ({"profile": []}, "profile"), ({"profile__years_of_experience": None}, "profile.years_of_experience"),
    ({"profile__years_of_experience": "abc"}, "profile.years_of_experience"), ({"skills": "python"}, "skills"), ({"skills": 5}, "skills"),
    ({"skills": ["python"]}, "skills"), ({"career_history": {"a": 1}}, "career_history"), ({"career_history__0__title": None}, "career_history"),
    ({"career_history__0__duration_months": "7"}, "career_history"), ({"career_history__1__description": 5}, "career_history"),
    ({"skills__0__endorsements": None}, "skills"), ({"skills__0__name": None}, "skills"), ({"education__0__tier": None}, "education"),
    ({"education__0__end_year": "2018"}, "education"), ({"signals": None}, "signals"), ({"signals": "x"}, "signals"),
    ({"signals__notice_period_days": None}, "signals.notice_period_days"), ({"signals__github_activity_score": "high"}, "signals.github_activity_score"),
    ({"signals__expected_salary_range_inr_lpa": None}, "signals.expected_salary_range_inr_lpa"),
    ({"signals__expected_salary_range_inr_lpa": {"min": "x", "max": 3}}, "signals.expected_salary_range_inr_lpa.min")]
KEPT = [{"candidate_id": None}, {"profile__headline": None}, {"skills": None}, {"skills": []}, {"education": {}}, {"career_history": ""},
        {"profile__years_of_experience": "7"}, {"profile__years_of_experience": True}, {"signals__notice_period_days": "30"},
        {"career_history__0__duration_months": 2.5}, {"signals__skill_assessment_scores": None}]


def test_faulty_lines_are_kept_compressed(spark, monkeypatch):
    """The lines that jsonl_quarantine writes and reads back take a part of their bytes on disk, in files of a bounded number of lines."""
    from talentlens.plans import more_queries as MQ
    numbers = dict(profile_views_received_30d=1, connection_count=1, endorsements_received=1, search_appearance_30d=1)
    records, staged, stage = records_df(spark, [with_signals(base_record(k), **numbers) for k in range(1, 101)]), [], FS.stage_candidates
    monkeypatch.setattr(MQ.PL, "fixture_candidates", lambda *_: records)
    monkeypatch.setattr(FS, "LINES_A_FILE", 40, raising=False)
    monkeypatch.setattr(FS, "stage_candidates", lambda s, path: staged.append(path) or stage(s, path))
    got = {r.reason: (r.n, r.years) for r in MQ.q_jsonl_quarantine(spark, "").collect()}
    faults = ("malformed", "not_object", "profile.years_of_experience", "skills", "career_history", "signals.notice_period_days")
    assert got == dict.fromkeys(faults, (2, 0.0)) | {"good": (88, 86 * 6.0 + 2 * 7.0)}
    lines = [r.value for r in spark.read.text(staged[0]).collect()]
    files = [os.path.getsize(os.path.join(staged[0], f)) for f in os.listdir(staged[0]) if f.startswith("part-")]
    assert len(lines) == 100 and len(files) == 3 and sum(files) * 5 < sum(len(x.encode()) + 1 for x in lines)


def test_strict_loader_rejects_what_can_t_be_used(spark):
    lines = [json.dumps(changed(**c)) for c, _ in REJECTED] + [json.dumps(changed(**c)) for c in KEPT]
    good, bad = FS.read_candidates(spark, write_lines(lines))
    reasons = {r.value: r.reason for r in bad.collect()}
    assert [reasons.get(line) for line in lines] == [why for _, why in REJECTED] + [None] * len(KEPT)
    assert good.count() == len(KEPT)
    lenient, none = FS.read_candidates(spark, write_lines(lines), strict=False)
    assert lenient.count() == len(lines) and none.count() == 0


def test_numbers_in_text_are_numbers(spark):
    good, _ = FS.read_candidates(spark, write_lines([json.dumps(changed(**{"profile__years_of_experience": "7"}))]))
    assert good.select("profile.years_of_experience").first()[0] == 7.0


def test_input_without_the_signals_key_is_an_error(spark):
    rec = base_record(1)
    rec["other_signals"] = rec.pop("signals")
    path = write_lines([json.dumps(rec)])
    for load in (FS.read_candidates, FS.stage_candidates):
        with pytest.raises(FS.SignalsMissing):
            load(spark, path)
    assert FS.stage_candidates(spark, path, "other_signals")[0].count() == 1
    assert FS.stage_candidates(spark, write_lines([]))[0].count() == 0


def test_staging_scans_and_parses_once(spark):
    path = write_lines(LINES)
    tagged = FS.tag_lines(spark.read.text(path))
    plan = tagged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1 and plan.lower().count("parsejson") == 1
    for frame in FS.read_candidates(spark, path):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan text") == 1 and plan.lower().count("parsejson") == 1        # no condition repeats the parse
    good, bad = FS.stage_candidates(spark, path)
    assert (good.count(), bad.count()) == (3, 2)


def test_a_folder_of_gzip_files_is_spread(spark):
    folder = os.path.dirname(write_lines([json.dumps(base_record(i)) for i in range(40)], gz=True))
    assert FS._read_text(spark, folder, 5).rdd.getNumPartitions() == 5


def test_missing_file(spark):
    with pytest.raises(FileNotFoundError):
        FS.read_candidates(spark, "/tmp/definitely-missing-dir/cands.jsonl")


def test_labels_roundtrip_and_unreadable(spark):
    path = FS.scratch_path(spark, "labels")
    df = spark.createDataFrame([("CAND_0000001", 4, 'multi\nline "quoted"')], "candidate_id string, llm_score int, llm_reasoning string")
    FS.append_labels(df, path)
    FS.append_labels(df, path)
    back = FS.read_labels(spark, path).collect()
    assert len(back) == 2 and back[0].llm_reasoning == 'multi line "quoted"'
    assert FS.read_labels(spark, "/tmp/no-such-labels-dir").count() == 0


def test_exact_order_statistics_with_hot_value(spark):
    rnd = random.Random(7)
    vals = [5.0] * 400 + [rnd.randint(0, 1000) / 10 for _ in range(800)]     # one value holds a third
    df = spark.createDataFrame([("a", v) for v in vals] + [("b", 1.0), ("b", 3.0)], "g string, v double")
    got = {(r.g, r.stat): r.value for r in grouped_describe(df).collect()}
    s = sorted(vals)
    n = len(s)
    assert got[("a", "p25")] == s[int(n * 0.25)] and got[("a", "p90")] == s[int(n * 0.9)]
    assert got[("a", "median")] == (s[(n - 1) // 2] + s[n // 2]) / 2
    assert got[("b", "median")] == 2.0 and got[("b", "n")] == 2


def test_stream_matches_batch(spark):
    from talentlens.plans import pipeline as PL
    from talentlens.streaming import scoring as ST
    src = FS.write_jsonl(PL.fixture_candidates(spark, SF001).repartition(3), FS.scratch_path(spark, "src"))
    sink, ck = FS.scratch_path(spark, "sink"), FS.scratch_path(spark, "ck")
    ST.stream_scores(spark, src, sink, ck).awaitTermination()
    streamed = {r.candidate_id: r.final_score for r in spark.read.parquet(sink).collect()}
    batch = {r.candidate_id: r.final_score for r in PL.score_candidates(PL.flat_candidates(spark, SF001)).collect()}
    assert streamed == batch
    out, ck2 = FS.scratch_path(spark, "topk"), FS.scratch_path(spark, "ck2")
    ST.stream_topk(spark, src, out, ck2, k=10).awaitTermination()
    top = sorted(((-r.final_score, r.candidate_id) for r in ST.read_topk(spark, out).collect()))
    assert top == sorted((-s, c) for c, s in batch.items())[:10]


from hypothesis import given, settings, strategies as st  # noqa: E402


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(min_value=-5, max_value=5), min_size=1, max_size=40))
def test_order_statistics_property(spark, vals):
    df = spark.createDataFrame([("g", float(v)) for v in vals], "g string, v double")
    got = {r.stat: r.value for r in grouped_describe(df).collect()}
    s = sorted(float(v) for v in vals)
    n = len(s)
    assert got["n"] == n and got["min"] == s[0] and got["max"] == s[-1]
    assert got["p25"] == s[int(n * 0.25)] and got["p75"] == s[int(n * 0.75)] and got["p90"] == s[int(n * 0.9)]
    assert got["median"] == (s[(n - 1) // 2] + s[n // 2]) / 2


def test_stream_quarantines_bad_lines(spark):
    from talentlens.streaming import scoring as ST
    src = os.path.dirname(write_lines(LINES))
    sink, ck = FS.scratch_path(spark, "qsink"), FS.scratch_path(spark, "qck")
    ST.stream_scores(spark, src, sink, ck).awaitTermination()
    ids = sorted(r.candidate_id or "" for r in spark.read.parquet(sink).collect())
    assert ids == ["", "CAND_0000001", "CAND_0000002"]          # "{}" is an object: kept, as in batch
    qs, qck = FS.scratch_path(spark, "qbad"), FS.scratch_path(spark, "qbadck")
    ST.quarantine_stream(spark, src, qs, qck).awaitTermination()
    assert sorted(r.reason for r in spark.read.parquet(qs).collect()) == ["malformed", "not_object"]


def test_damaged_snapshot_is_an_error(spark, tmp_path):
    from talentlens.streaming import scoring as ST
    assert ST._latest_snapshot(spark, str(tmp_path / "none")) is None
    (tmp_path / "s" / "batch_id=0").mkdir(parents=True)
    (tmp_path / "s" / "batch_id=0" / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        ST._latest_snapshot(spark, str(tmp_path / "s")).collect()
