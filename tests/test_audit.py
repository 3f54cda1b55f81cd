import os
import tempfile

import pytest

from talentlens.operators import audit

HEADER = '"candidate_id","rank","score","reasoning"'


def rows(n=100, score=lambda i: 1.0 - i / 1000):
    return [f'"CAND_{i:07d}","{i}","{score(i):.4f}","reason number {i} long enough text here"' for i in range(1, n + 1)]


def write(lines, name="team_x.csv", encoding="utf-8"):
    d = tempfile.mkdtemp(prefix="tl-sub-", dir="/tmp")
    p = os.path.join(d, name)
    with open(p, "w", encoding=encoding) as fh:
        fh.write("\n".join(lines) + "\n")
    return p


def checks(spark, path):
    return sorted({r.check for r in audit.validate_file(spark, path).collect()})


def test_valid_file_passes(spark):
    assert checks(spark, write([HEADER] + rows())) == []


def test_blank_rows_are_ignored(spark):
    r = rows()
    assert checks(spark, write([HEADER] + r[:50] + ["", " , , , "] + r[50:])) == []


@pytest.mark.parametrize("mutate,expected", [
    (lambda r: r[:-1], {"row_count", "rank_missing"}),
    (lambda r: r[:9] + ['"CAND_12","10","0.9900","x x x x x x x x x x x x x x x x"'] + r[10:], {"id_pattern"}),
    (lambda r: r[:9] + [r[8].replace('"9"', '"10"', 1)] + r[10:], {"id_duplicate"}),
    (lambda r: r[:9] + [r[9].replace('"10"', '"9"', 1)] + r[10:], {"rank_duplicate", "rank_missing"}),
    (lambda r: r[:4] + [r[4].replace('"5"', '"05"', 1)] + r[5:], {"rank_not_integer", "rank_missing"}),
    (lambda r: r[:4] + [r[4].replace('"5"', '"105"', 1)] + r[5:], {"rank_range", "rank_missing", "score_increase"}),
    (lambda r: r[:4] + [r[4].replace('"0.9950"', '"abc"', 1)] + r[5:], {"score_not_float"}),
    (lambda r: r[:4] + [r[4].replace('"0.9950"', '"0.9999"', 1)] + r[5:], {"score_increase"}),
    (lambda r: r[:4] + [r[4] + ',"extra"'] + r[5:], {"column_count", "rank_missing"}),
    (lambda r: r[:3] + ['"CAND_0000005","4","0.9960","x x x x x x x x x x x x x x x x x"',
                        '"CAND_0000004","5","0.9960","y y y y y y y y y y y y y y y y y"'] + r[5:], {"tie_order"}),
])
def test_each_contract_check(spark, mutate, expected):
    assert set(checks(spark, write([HEADER] + mutate(rows())))) == expected


def test_header_filename_and_encoding(spark):
    assert checks(spark, write(['"id","rank","score","reasoning"'] + rows())) == ["header"]
    assert "filename_extension" in checks(spark, write([HEADER] + rows(), name="team.txt"))
    assert "encoding" in checks(spark, write([HEADER] + rows() + ["café"], encoding="latin-1"))


def test_quoted_reasoning_with_commas_and_quotes(spark):
    r = rows()
    r[3] = '"CAND_0000004","4","0.9960","said ""great fit"", strong, ranked"'
    path = write([HEADER] + r)
    assert checks(spark, path) == []
    _, cells, _ = audit.read_cells(spark, path)
    got = cells.where("row_num = 5").collect()[0].reasoning
    assert got == 'said "great fit", strong, ranked'


@pytest.mark.parametrize("first", ["candidate_id,rank,score,reasoning,", "candidate_id,rank,score,reasoning,,,", ""])
def test_header_is_the_first_row_cell_by_cell(spark, first):
    lines = [first] + ([HEADER] if not first else []) + rows()
    assert "header" in checks(spark, write(lines))


def test_quoted_newline_belongs_to_its_cell(spark):
    r = rows()
    r[3] = '"CAND_0000004","4","0.9960","one line\nand another, long enough"'
    assert checks(spark, write([HEADER] + r)) == []


def test_rows_of_tabs_are_blank(spark):
    r = rows()
    assert checks(spark, write([HEADER] + r[:50] + ["\t", '"\t",,,'] + r[50:])) == []


@pytest.mark.parametrize("score,ok", [("0.9950d", False), ("0x1p3", False), ("1_0", False), ("9.95e-1", True), ("+.995", True), ("", False), ("1__0", False)])
def test_scores_as_python_reads_them(spark, score, ok):
    r = rows()
    r[4] = r[4].replace('"0.9950"', f'"{score}"', 1)
    found = checks(spark, write([HEADER] + r))
    assert ("score_not_float" not in found) if ok or score == "1_0" else found == ["score_not_float"]


def test_nan_compares_with_nothing(spark):
    r = rows()
    for i in (49, 99):
        r[i] = r[i].replace(f'"{1.0 - (i + 1) / 1000:.4f}"', '"nan"', 1)
    assert checks(spark, write([HEADER] + r)) == []


def test_empty_file_and_missing_texts(spark):
    assert checks(spark, write([])) == ["header", "rank_missing", "row_count"]           # one blank line
    sub = spark.createDataFrame([("a", 1, 1.0, "", 2), ("b", 2, 0.9, None, 3), ("c", 3, 0.8, "short", 4)],
                                "candidate_id string, rank int, score double, reasoning string, row_num long")
    assert sorted((r.issue, r["rank"]) for r in audit.audit_reasoning(sub).collect()) == [("duplicate", 2), ("empty", 1), ("empty", 2), ("short", 3)]


def test_a_bad_title_fails_the_whole_and_a_narrow_spread_warns(spark):
    none = spark.createDataFrame([], audit.VIOLATION)
    titles = spark.createDataFrame([(1, True)], "rank int, flagged boolean")
    scores = spark.createDataFrame([(50, 0.001)], "unique_scores long, spread double")
    got = {r.layer: r.status for r in audit.layer_summary(none, none, titles, none, scores, none).collect()}
    assert got["titles"] == "FAIL" and got["overall"] == "FAIL" and got["spread"] == "WARN" and got["scores"] == "PASS"
    got = {r.layer: r.status for r in audit.layer_summary(none, none, titles.limit(0), none, scores, none).collect()}
    assert got["overall"] == "PASS"


def test_declared_schema_of_a_good_record(spark):
    from conftest import base_record, records_df
    good = base_record()
    good["profile"]["anonymized_name"] = "A"
    for j in good["career_history"]:
        j.update(start_date="2020-01-01", end_date=None, company_size="10001+")
    good["profile"]["current_company_size"] = "10001+"
    for e in good["education"]:
        e.update(institution="I", start_year=2014)
    good["signals"].update(profile_views_received_30d=1, connection_count=1, endorsements_received=0, search_appearance_30d=2, offer_acceptance_rate=-0.5)
    df = records_df(spark, [good])
    assert {r.rule: r.violations for r in audit.schema_conformance(df).collect() if r.violations} == {}
    bad = base_record()
    bad["languages"] = [{"language": "x", "proficiency": "fluent"}]
    bad["career_history"][0].update(start_date="01/02/2020", duration_months=-1, company_size="10000+")
    bad["signals"].update(github_activity_score=101, expected_salary_range_inr_lpa={"min": -1, "max": 3}, connection_count=-4)
    found = {r.rule for r in audit.schema_conformance(records_df(spark, [bad])).collect() if r.violations}
    assert {"language_proficiency_enum", "job_dates", "job_duration", "job_company_size_enum", "github_range", "salary_range", "counts_range",
            "profile_required", "education_required", "signals_required"} <= found


def test_taxonomy_sizes():
    from talentlens import config as C
    sizes = [len(C.ENGINEERING_TITLES), len(C.NON_ENGINEERING_TITLES), len(C.PRODUCTION_KEYWORDS),
             len(C.RETRIEVAL_KEYWORDS), len(C.RESEARCH_KEYWORDS), len(C.WRAPPER_KEYWORDS), len(C.CONSULTING_FIRMS),
             len(C.MUST_HAVE_SKILLS), len(C.NICE_TO_HAVE_SKILLS), len(C.IRRELEVANT_SKILLS),
             len(C.PREFERRED_CITIES), len(C.TIER1_CITIES)]
    assert sizes == [22, 15, 26, 36, 10, 6, 19, 23, 12, 25, 2, 10]
    assert len(C.PRODUCT_COMPANIES) == 45        # the platform's own name is left out (README)
