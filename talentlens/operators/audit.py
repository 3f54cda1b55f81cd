"""Submission contract validation (V1–V10) and quality audits (Q1–Q12).

Every check emits violation rows ``(check, severity, row_num, detail)``; an
empty frame means "pass".  ``row_num`` is the 1-based file row (the header is
row 1).  Checks on the submission work on its ≤ k rows; checks that need the
candidate table join the k submission rows against it (``left_semi`` /
``left_anti`` with the small side broadcast), so the candidate table is only
scanned, never collected.
"""

from __future__ import annotations

import functools
import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import config as C
from ..config import DEFAULT, RankConfig
from ..functions.text import py_float, py_strip
from .labeling import sample_key

VIOLATION = "check string, severity string, row_num long, detail string"
RANK_TEXT = r"^(0|-?[1-9][0-9]*)$"


def _v(df: DataFrame, check: str, severity: str, detail: Column) -> DataFrame:
    return df.select(F.lit(check).alias("check"), F.lit(severity).alias("severity"),
                     F.col("row_num").cast("long").alias("row_num"), detail.cast("string").alias("detail"))


# ---------------------------------------------------------------------------
# sources: raw submission cells
# ---------------------------------------------------------------------------

#: Bytes beyond which a submission is not read: a hundred rows never need as much.
MAX_FILE_BYTES = 64 << 20


def _parse(batches):
    """Rows of a whole CSV file: quoted newlines belong to their cell, blank data rows are dropped before numbering."""
    import csv
    import io

    import pandas as pd

    for batch in batches:
        out = []
        for length, content in zip(batch["length"], batch["content"], strict=True):
            if length > MAX_FILE_BYTES:
                out.append(("oversize", 0, [str(length)]))
                continue
            try:
                rows = list(csv.reader(io.StringIO(bytes(content).decode("utf-8"), newline="")))
            except UnicodeDecodeError:
                out.append(("encoding", 0, []))
                continue
            except csv.Error as e:
                out.append(("unreadable", 0, [str(e)]))
                continue
            if rows:
                out.append(("header", 1, rows[0]))
            data = [r for r in rows[1:] if any(cell.strip() for cell in r)]
            out += [("row", 2 + i, r) for i, r in enumerate(data)]
        yield pd.DataFrame(out, columns=["kind", "row_num", "cells"])


def read_rows(spark: SparkSession, path: str) -> DataFrame:
    """``(kind, row_num, cells)`` of one submission file; ``kind`` is header, row, or what keeps the file from being read."""
    files = spark.read.format("binaryFile").load(path)
    small = files.select("length", F.when(F.col("length") <= MAX_FILE_BYTES, F.col("content")).alias("content"))
    return small.mapInPandas(_parse, "kind string, row_num long, cells array<string>")


def read_cells(spark: SparkSession, path: str) -> tuple[list[str] | None, DataFrame, DataFrame]:
    """``(header, cells, bad_rows)`` of a submission file.

    ``cells`` holds the rows of exactly four cells with their file row numbers, ``bad_rows`` the others.
    """
    return _split_rows(read_rows(spark, path))


def _split_rows(rows: DataFrame) -> tuple[list[str] | None, DataFrame, DataFrame]:
    header = rows.where("kind = 'header'").select("cells").first()
    body = rows.where("kind = 'row'")
    c = F.col("cells")
    cells = body.where(F.size(c) == 4).select(c[0].alias("candidate_id"), c[1].alias("rank"), c[2].alias("score"), c[3].alias("reasoning"), "row_num")
    return None if header is None else list(header["cells"]), cells, body.where(F.size(c) != 4).select("row_num", F.size(c).alias("cells"))


def file_checks(path: str, header: list[str] | None, faults: list[tuple[str, str]] = ()) -> list[tuple[str, str, int, str]]:
    """V1/V2: filename, encoding, emptiness, header.  The header is the first row of the file, cell by cell."""
    out = []
    stem, ext = os.path.splitext(os.path.basename(path))
    if ext.lower() != ".csv":
        out.append(("filename_extension", "error", 0, "filename must use a .csv extension"))
    elif not stem:
        out.append(("filename_stem", "error", 0, "filename must be the participant id"))
    for kind, detail in faults:
        out.append((kind, "error", 0, "file must be UTF-8" if kind == "encoding" else detail[:200]))
    if faults:
        return out
    if header is None:
        out.append(("empty_file", "error", 1, "row 1 must be the header"))
    elif tuple(header) != C.SUBMISSION_HEADER:
        out.append(("header", "error", 1, ",".join(header)))
    return out


# ---------------------------------------------------------------------------
# V3–V10 on cells
# ---------------------------------------------------------------------------

def _checked(cells: DataFrame) -> DataFrame:
    """Cells with their parsed forms and what needs other rows: earlier occurrences, and the next row by rank."""
    cid = py_strip(F.coalesce(F.col("candidate_id"), F.lit("")))
    rank = py_strip(F.coalesce(F.col("rank"), F.lit("")))
    score = py_strip(F.coalesce(F.col("score"), F.lit("")))
    c = cells.select("row_num", cid.alias("cid"), rank.alias("rank_s"), score.alias("score_s"),
                     F.when(rank.rlike(RANK_TEXT), rank.try_cast("long")).alias("rank_i"), py_float(score).alias("score_d"))
    valid = F.col("cid").rlike(C.CANDIDATE_ID_PATTERN)
    in_order = F.col("rank_i").isNotNull() & F.col("score_d").isNotNull() & (F.col("cid") != "")
    # the submission's rows only; k of them unless the row count is wrong
    by_rank = Window.partitionBy("in_order").orderBy("rank_i", "row_num")
    return (c.withColumn("id_occ", F.row_number().over(Window.partitionBy("cid").orderBy("row_num")))
             .withColumn("rank_occ", F.row_number().over(Window.partitionBy("rank_i").orderBy("row_num")))
             .withColumn("valid_id", valid).withColumn("in_order", in_order)
             .withColumn("next", F.lead(F.struct("score_d", "cid", "rank_i")).over(by_rank)))


def _row_checks(k: int) -> Column:
    """All checks of one row as an array of (check, detail); null where a check passes."""
    cid, rank, rank_s, score, nxt = (F.col(c) for c in ("cid", "rank_i", "rank_s", "score_d", "next"))

    def bad(check: str, when: Column, detail: Column) -> Column:
        return F.when(when, F.struct(F.lit(check).alias("check"), detail.cast("string").alias("detail")))

    numbers = F.col("in_order") & nxt.isNotNull() & ~F.isnan(score) & ~F.isnan(nxt["score_d"])     # a NaN compares with nothing
    return F.array_compact(F.array(
        bad("id_required", cid == "", F.lit("")),
        bad("id_pattern", (cid != "") & ~F.col("valid_id"), cid),
        bad("id_duplicate", F.col("valid_id") & (F.col("id_occ") > 1), cid),
        bad("rank_not_integer", rank.isNull(), rank_s),
        bad("rank_range", ~rank.between(1, k), rank_s),
        bad("rank_duplicate", rank.between(1, k) & (F.col("rank_occ") > 1), rank_s),
        bad("score_not_float", score.isNull(), F.col("score_s")),
        bad("score_increase", numbers & (score < nxt["score_d"]),
            F.concat(F.lit("rank "), rank.cast("string"), F.lit(" < rank "), nxt["rank_i"].cast("string"))),
        bad("tie_order", numbers & (score == nxt["score_d"]) & (cid > nxt["cid"]), F.concat(cid, F.lit(" > "), nxt["cid"]))))


def check_row_count(cells: DataFrame, bad_rows: DataFrame | None = None, expected: int = 100) -> DataFrame:
    """V3: non-blank data rows (including malformed ones) must equal ``expected``."""
    n = cells.select("row_num")
    if bad_rows is not None:
        n = n.unionByName(bad_rows.select("row_num"))
    agg = n.agg(F.count(F.lit(1)).alias("n"))
    return agg.where(F.col("n") != expected).select(
        F.lit("row_count").alias("check"), F.lit("error").alias("severity"), F.lit(0).cast("long").alias("row_num"),
        F.concat(F.lit("found "), F.col("n").cast("string")).alias("detail"))


def check_cell_count(bad_rows: DataFrame) -> DataFrame:
    """V4: rows whose cell count is not four."""
    return _v(bad_rows, "column_count", "error", F.concat(F.lit("cells "), F.col("cells").cast("string")))


def check_missing_ranks(cells: DataFrame, k: int = 100) -> DataFrame:
    """V8: ranks 1..k never seen (``spark.range`` anti-join)."""
    rank = py_strip(F.coalesce(F.col("rank"), F.lit("")))
    seen = cells.where(rank.rlike(RANK_TEXT)).select(rank.try_cast("long").alias("id")).where(F.col("id").between(1, k))
    missing = cells.sparkSession.range(1, k + 1).join(seen, "id", "left_anti")
    return missing.select(F.lit("rank_missing").alias("check"), F.lit("error").alias("severity"),
                          F.lit(0).cast("long").alias("row_num"), F.col("id").cast("string").alias("detail"))


def check_rows(cells: DataFrame, k: int = 100) -> DataFrame:
    """Every check of a row in one projection over one set of windows."""
    found = _checked(cells).select("row_num", F.explode(_row_checks(k)).alias("v"))
    return found.select("v.check", F.lit("error").alias("severity"), F.col("row_num").cast("long").alias("row_num"), "v.detail")


def validate_cells(cells: DataFrame, bad_rows: DataFrame | None = None, k: int = 100) -> DataFrame:
    """V3–V10 over string cells."""
    out = check_row_count(cells, bad_rows, k)
    if bad_rows is not None:
        out = out.unionByName(check_cell_count(bad_rows))
    return out.unionByName(check_rows(cells, k)).unionByName(check_missing_ranks(cells, k))


def validate_file(spark: SparkSession, path: str, k: int = 100) -> DataFrame:
    """Q1: the whole contract (V1–V10) for a CSV file, as violation rows.  What can't be read isn't checked further."""
    return validate_rows(spark, path, path, k)


def validate_rows(spark: SparkSession, path: str, name: str, k: int = 100) -> DataFrame:
    """The contract for the file at ``path`` as if it had the given name."""
    rows = read_rows(spark, path)
    faults = [(r["kind"], (list(r["cells"]) or [""])[0]) for r in rows.where("kind NOT IN ('header', 'row')").collect()]     # one for each file
    header, cells, bad = _split_rows(rows)
    head = spark.createDataFrame(file_checks(name, header, faults), VIOLATION)
    return head if faults or header is None else head.unionByName(validate_cells(cells, bad, k))


# ---------------------------------------------------------------------------
# Q2–Q10 on a typed submission
# ---------------------------------------------------------------------------

def typed(cells: DataFrame) -> DataFrame:
    return cells.select(py_strip("candidate_id").alias("candidate_id"),
                        py_strip("rank").try_cast("int").alias("rank"),
                        py_float(py_strip("score")).alias("score"), "reasoning", "row_num")


def _known(sub: DataFrame, source: DataFrame) -> DataFrame:
    """Submitted ids present in ``source``: the big side is probed with the broadcast submission
    (a file of at most ``MAX_FILE_BYTES``, or k ranked rows), so it is scanned, never shuffled."""
    ids = sub.select("candidate_id").distinct()
    return source.select("candidate_id").join(F.broadcast(ids), "candidate_id", "left_semi")


def audit_flagged(sub: DataFrame, flagged_ids: DataFrame) -> DataFrame:
    """Q2: submitted ids that the integrity rules flag (with their rank)."""
    hit = _known(sub, flagged_ids)
    return sub.join(hit, "candidate_id", "left_semi").select("candidate_id", "rank")


def audit_titles(sub: DataFrame, flat: DataFrame, top: int = 10) -> DataFrame:
    """Q3: top ranks joined to candidates; titles in the audit set are flagged."""
    head = sub.where(F.col("rank") <= top).select("candidate_id", "rank")
    info = flat.select("candidate_id", "profile_current_title", "profile_current_industry")
    j = info.join(F.broadcast(head), "candidate_id")
    return j.select("rank", "candidate_id", "profile_current_title", "profile_current_industry",
                    F.lower(F.coalesce("profile_current_title", F.lit(""))).isin(*C.AUDIT_NON_ENG_TITLES).alias("flagged"))


def audit_reasoning(sub: DataFrame, min_chars: int = 30) -> DataFrame:
    """Q4–Q6: empty, duplicate (2nd+ in file order) and short explanations.

    An empty cell is a missing text: missing texts duplicate each other and aren't short.
    """
    r = F.col("reasoning")
    empty = sub.where(r.isNull() | (r == "")).select(F.lit("empty").alias("issue"), "rank")
    dup = sub.withColumn("occ", F.row_number().over(Window.partitionBy(F.coalesce(r, F.lit(""))).orderBy("row_num"))) \
             .where(F.col("occ") > 1).select(F.lit("duplicate").alias("issue"), "rank")
    short = sub.where(F.length(r).between(1, min_chars - 1)).select(F.lit("short").alias("issue"), "rank")
    return empty.unionByName(dup).unionByName(short)


def review_sample(sub: DataFrame, n: int = 10, seed: str = "42") -> DataFrame:
    """Q7: ``n`` rows for manual review (md5 order), shown by rank."""
    return sub.orderBy(sample_key(seed), "candidate_id").limit(n).orderBy("rank")


def audit_scores(sub: DataFrame) -> DataFrame:
    """Q8–Q9: min, max, mean, sample std, interpolated median, unique count, first−last spread."""
    w_first = F.min_by("score", "row_num")
    w_last = F.max_by("score", "row_num")
    return sub.agg(F.min("score").alias("min"), F.max("score").alias("max"), F.avg("score").alias("mean"),
                   F.stddev_samp("score").alias("std"), F.median("score").alias("median"),
                   F.countDistinct("score").alias("unique_scores"), (w_first - w_last).alias("spread"))


def audit_unknown_ids(sub: DataFrame, source_ids: DataFrame) -> DataFrame:
    """Q10: submitted ids absent from the source (anti-join of two ≤ k-row frames)."""
    return sub.select("candidate_id").distinct().join(_known(sub, source_ids), "candidate_id", "left_anti")


def layer_summary(contract: DataFrame, flagged: DataFrame, titles: DataFrame, reasoning: DataFrame,
                  scores: DataFrame, unknown: DataFrame, min_unique: int = 10, min_spread: float = 0.01) -> DataFrame:
    """Q9/Q11: PASS or FAIL for each layer, WARN for a narrow score spread, and the overall verdict.

    Any failed layer fails the whole, a bad title among the top ranks included; a narrow spread doesn't.
    """
    def layer(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("layer"), F.when(F.col("n") == 0, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"))

    score_layers = scores.select(F.explode(F.array(
        F.struct(F.lit("scores").alias("layer"), F.when(F.col("unique_scores") >= min_unique, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status")),
        F.struct(F.lit("spread").alias("layer"), F.when(F.col("spread") < min_spread, F.lit("WARN")).otherwise(F.lit("PASS")).alias("status")))).alias("s")).select("s.*")
    layers = (layer(contract, "contract").unionByName(layer(flagged, "flagged"))
              .unionByName(layer(titles.where("flagged"), "titles")).unionByName(layer(reasoning, "reasoning"))
              .unionByName(score_layers).unionByName(layer(unknown, "ids")))
    overall = layers.agg(F.when(F.sum((F.col("status") == "FAIL").cast("long")) == 0, F.lit("PASS"))
                         .otherwise(F.lit("FAIL")).alias("status")).select(F.lit("overall").alias("layer"), "status")
    return layers.unionByName(overall)


# ---------------------------------------------------------------------------
# Q12 declared-schema conformance on raw nested records
# ---------------------------------------------------------------------------

# FIXED VALUES of the declared record schema
PROFICIENCY = ("beginner", "intermediate", "advanced", "expert")
LANGUAGE_PROFICIENCY = ("basic", "conversational", "professional", "native")
WORK_MODES = ("remote", "hybrid", "onsite", "flexible")
TIERS = ("tier_1", "tier_2", "tier_3", "tier_4", "unknown")
COMPANY_SIZES = ("1-10", "11-50", "51-200", "201-500", "501-1000", "1001-5000", "5001-10000", "10001+")
REQUIRED = {
    "profile": ("anonymized_name", "headline", "summary", "location", "country", "years_of_experience", "current_title", "current_company",
                "current_company_size", "current_industry"),
    "job": ("company", "title", "start_date", "duration_months", "is_current", "industry", "company_size", "description"),
    "education": ("institution", "degree", "field_of_study", "start_year", "end_year"),
    "skill": ("name", "proficiency", "endorsements"),
    "certification": ("name", "issuer", "year"),
    "language": ("language", "proficiency"),
    "signals": ("profile_completeness_score", "signup_date", "last_active_date", "open_to_work_flag", "profile_views_received_30d",
                "applications_submitted_30d", "recruiter_response_rate", "avg_response_time_hours", "skill_assessment_scores", "connection_count",
                "endorsements_received", "notice_period_days", "expected_salary_range_inr_lpa", "preferred_work_mode", "willing_to_relocate",
                "github_activity_score", "search_appearance_30d", "saved_by_recruiters_30d", "interview_completion_rate", "offer_acceptance_rate",
                "verified_email", "verified_phone", "linkedin_connected"),
}
COUNTS = ("profile_views_received_30d", "applications_submitted_30d", "connection_count", "endorsements_received", "search_appearance_30d", "saved_by_recruiters_30d")


def conformance_rules(signals_key: str = "signals") -> dict[str, Column]:
    """Violation predicates per record for the declared (never enforced) constraints.

    A key that must be there but may be null (a job's end date, a grade) can't be told from a missing
    one in a typed record and isn't checked.
    """
    p, s = F.col("profile"), F.col(signals_key)
    jobs, ed, sk = F.col("career_history"), F.col("education"), F.col("skills")
    certs, langs, salary = F.col("certifications"), F.col("languages"), s["expected_salary_range_inr_lpa"]
    out_of = lambda v, lo, hi: v.isNotNull() & ~v.between(lo, hi)
    below = lambda v, lo=0: v.isNotNull() & (v < lo)
    other = lambda v, values: v.isNotNull() & ~v.isin(*values)
    not_date = lambda v: v.isNotNull() & ~F.coalesce(v.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & v.try_cast("date").isNotNull(), F.lit(False))
    some = lambda items, test: F.exists(F.coalesce(items, F.array()), test)

    def lacks(item: Column, what: str) -> Column:
        return functools.reduce(lambda a, b: a | b, [item[c].isNull() for c in REQUIRED[what]])

    return {
        "required_keys": p.isNull() | jobs.isNull() | ed.isNull() | sk.isNull() | s.isNull() | F.col("candidate_id").isNull(),
        "profile_required": p.isNotNull() & lacks(p, "profile"),
        "job_required": some(jobs, lambda j: lacks(j, "job")),
        "education_required": some(ed, lambda e: lacks(e, "education")),
        "skill_required": some(sk, lambda x: lacks(x, "skill")),
        "certification_required": some(certs, lambda x: lacks(x, "certification")),
        "language_required": some(langs, lambda x: lacks(x, "language")),
        "signals_required": s.isNotNull() & (lacks(s, "signals") | salary["min"].isNull() | salary["max"].isNull()),
        "candidate_id_pattern": ~F.coalesce(F.col("candidate_id"), F.lit("")).rlike(C.CANDIDATE_ID_PATTERN),
        "years_range": out_of(p["years_of_experience"], 0.0, 50.0),
        "company_size_enum": other(p["current_company_size"], COMPANY_SIZES),
        "career_items": jobs.isNotNull() & ~F.size(jobs).between(1, 10),
        "job_dates": some(jobs, lambda j: not_date(j["start_date"]) | not_date(j["end_date"])),
        "job_duration": some(jobs, lambda j: below(j["duration_months"])),
        "job_company_size_enum": some(jobs, lambda j: other(j["company_size"], COMPANY_SIZES)),
        "education_items": ed.isNotNull() & (F.size(ed) > 5),
        "start_year_range": some(ed, lambda e: out_of(e["start_year"], 1970.0, 2030.0)),
        "end_year_range": some(ed, lambda e: out_of(e["end_year"], 1970.0, 2035.0)),
        "tier_enum": some(ed, lambda e: other(e["tier"], TIERS)),
        "proficiency_enum": some(sk, lambda x: other(x["proficiency"], PROFICIENCY)),
        "skill_numbers": some(sk, lambda x: below(x["endorsements"]) | below(x["duration_months"])),
        "language_proficiency_enum": some(langs, lambda x: other(x["proficiency"], LANGUAGE_PROFICIENCY)),
        "completeness_range": out_of(s["profile_completeness_score"], 0.0, 100.0),
        "signal_dates": not_date(s["signup_date"]) | not_date(s["last_active_date"]),
        "counts_range": functools.reduce(lambda a, b: a | b, [below(s[c]) for c in COUNTS]),
        "response_rate_range": out_of(s["recruiter_response_rate"], 0.0, 1.0),
        "response_time_range": below(s["avg_response_time_hours"]),
        "interview_rate_range": out_of(s["interview_completion_rate"], 0.0, 1.0),
        "offer_rate_range": out_of(s["offer_acceptance_rate"], -1.0, 1.0),
        "notice_range": out_of(s["notice_period_days"], 0.0, 180.0),
        "salary_range": below(salary["min"]) | below(salary["max"]),
        "work_mode_enum": other(s["preferred_work_mode"], WORK_MODES),
        "github_range": out_of(s["github_activity_score"], -1.0, 100.0),
        "assessment_range": F.exists(F.map_values(F.coalesce(s["skill_assessment_scores"], F.create_map().cast("map<string,double>"))),
                                     lambda v: ~v.between(0.0, 100.0)),
    }


def schema_conformance(raw: DataFrame, signals_key: str = "signals") -> DataFrame:
    """Q12: ``(rule, violations)`` counts in one aggregation."""
    rules = conformance_rules(signals_key)
    wide = raw.agg(*[F.sum(F.coalesce(c, F.lit(False)).cast("long")).alias(n) for n, c in rules.items()])
    stack = "stack({}, {}) as (rule, violations)".format(
        len(rules), ", ".join(f"'{n}', coalesce({n}, 0L)" for n in rules))
    return wide.selectExpr(stack)


def declared_schema(signals_key: str = "signals") -> dict:
    """The declared record schema as a JSON Schema document, for ``json_schema``; a file of one's own serves as well."""
    text, flag, date = {"type": "string"}, {"type": "boolean"}, {"type": "string", "format": "date"}
    whole = lambda lo=0, hi=None: {"type": "integer", "minimum": lo} | ({} if hi is None else {"maximum": hi})
    number = lambda lo=0, hi=None: {"type": "number", "minimum": lo} | ({} if hi is None else {"maximum": hi})
    listed = lambda values: {"type": "string", "enum": list(values)}
    or_null = lambda s: s | {"type": [s["type"], "null"]}

    def record(what: str, required: tuple = (), **special: dict) -> dict:
        return {"type": "object", "required": [*REQUIRED[what], *required], "properties": {c: text for c in REQUIRED[what]} | special}

    def several(items: dict, **bounds: int) -> dict:
        return {"type": "array", "items": items} | bounds

    flags = ("open_to_work_flag", "willing_to_relocate", "verified_email", "verified_phone", "linkedin_connected")
    signals = record(
        "signals", profile_completeness_score=number(0, 100), signup_date=date, last_active_date=date, recruiter_response_rate=number(0, 1),
        avg_response_time_hours=number(), skill_assessment_scores={"type": "object", "additionalProperties": number(0, 100)}, notice_period_days=whole(0, 180),
        expected_salary_range_inr_lpa={"type": "object", "required": ["min", "max"], "properties": {"min": number(), "max": number()}},
        preferred_work_mode=listed(WORK_MODES), github_activity_score=number(-1, 100), interview_completion_rate=number(0, 1), offer_acceptance_rate=number(-1, 1),
        **dict.fromkeys(flags, flag), **dict.fromkeys(COUNTS, whole()))
    return {"type": "object", "required": ["candidate_id", "profile", "career_history", "education", "skills", signals_key], "properties": {
        "candidate_id": {"type": "string", "pattern": C.CANDIDATE_ID_PATTERN},
        "profile": record("profile", years_of_experience=number(0, 50), current_company_size=listed(COMPANY_SIZES)),
        "career_history": several(record("job", ("end_date",), start_date=date, end_date=or_null(date), duration_months=whole(), is_current=flag,
                                         company_size=listed(COMPANY_SIZES)), minItems=1, maxItems=10),
        "education": several(record("education", start_year=whole(1970, 2030), end_year=whole(1970, 2035), grade=or_null(text), tier=listed(TIERS)), minItems=0, maxItems=5),
        "skills": several(record("skill", proficiency=listed(PROFICIENCY), endorsements=whole(), duration_months=whole()), minItems=0),
        "certifications": several(record("certification", year={"type": "integer"})),
        "languages": several(record("language", proficiency=listed(LANGUAGE_PROFICIENCY))),
        signals_key: signals}}


def conformance_groups(rule_names: list[str], signals_key: str = "signals") -> dict[str, list[str]]:
    """The names of ``conformance_rules`` and the compiled rules of the declared schema that each of them stands for."""
    s = signals_key
    parts = {"job": "career_history[]", "education": "education[]", "skill": "skills[]", "certification": "certifications[]", "language": "languages[]", "signals": s, "profile": "profile"}
    some = lambda paths, words: [f"{p}: {w}" for p in paths for w in words if f"{p}: {w}" in rule_names]
    out = {"required_keys": [n for n in rule_names if n.startswith(": required")] + some(["candidate_id", "profile", "career_history", "education", "skills", s], ["type"])}
    for part, path in parts.items():
        out[f"{part}_required"] = [n for n in rule_names if n.startswith(f"{path}: required")] + some([f"{path}.{c}" for c in REQUIRED[part]], ["type"])
    salary = [f"{s}.expected_salary_range_inr_lpa.{x}" for x in ("min", "max")]
    out["signals_required"] += [n for n in rule_names if n.startswith(f"{s}.expected_salary_range_inr_lpa: required")] + some(salary, ["type"])
    bounds = ["minimum", "maximum"]
    return out | {
        "candidate_id_pattern": some(["candidate_id"], ["type", "pattern"]), "years_range": some(["profile.years_of_experience"], bounds),
        "company_size_enum": some(["profile.current_company_size"], ["enum"]), "career_items": some(["career_history"], ["minItems", "maxItems"]),
        "job_dates": some(["career_history[].start_date", "career_history[].end_date"], ["format"]), "job_duration": some(["career_history[].duration_months"], bounds),
        "job_company_size_enum": some(["career_history[].company_size"], ["enum"]), "education_items": some(["education"], ["minItems", "maxItems"]),
        "start_year_range": some(["education[].start_year"], bounds), "end_year_range": some(["education[].end_year"], bounds), "tier_enum": some(["education[].tier"], ["enum"]),
        "proficiency_enum": some(["skills[].proficiency"], ["enum"]), "skill_numbers": some(["skills[].endorsements", "skills[].duration_months"], bounds),
        "language_proficiency_enum": some(["languages[].proficiency"], ["enum"]), "completeness_range": some([f"{s}.profile_completeness_score"], bounds),
        "signal_dates": some([f"{s}.signup_date", f"{s}.last_active_date"], ["format"]), "counts_range": some([f"{s}.{c}" for c in COUNTS], bounds),
        "response_rate_range": some([f"{s}.recruiter_response_rate"], bounds), "response_time_range": some([f"{s}.avg_response_time_hours"], bounds),
        "interview_rate_range": some([f"{s}.interview_completion_rate"], bounds), "offer_rate_range": some([f"{s}.offer_acceptance_rate"], bounds),
        "notice_range": some([f"{s}.notice_period_days"], bounds), "salary_range": some(salary, bounds), "work_mode_enum": some([f"{s}.preferred_work_mode"], ["enum"]),
        "github_range": some([f"{s}.github_activity_score"], bounds), "assessment_range": some([f"{s}.skill_assessment_scores{{}}"], bounds)}


def flagged_without_features(flat: DataFrame, cfg: RankConfig = DEFAULT) -> DataFrame:
    """Ids flagged when the rules run on the flat table alone (title rule inactive)."""
    from .integrity import add_integrity
    return add_integrity(flat, cfg).where("is_honeypot").select("candidate_id")
