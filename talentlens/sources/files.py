"""File sources and sinks.

* JSONL candidates are read as text, blank lines dropped, and each line is
  parsed once, to a VARIANT.  Validity rules and the typed record both come from
  that value in one projection; what a rule rejects goes to quarantine with the
  rule's name.
* Gzip input is unsplittable, so it is repartitioned right after the read.
* Sinks write through the DataFrame writer; the submission CSV quotes every
  field including the header.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import py_strip
from ..operators.metrics import RunMetrics, count_of
from ..schema import candidate_schema
from ..session import checkpoint_dir

LABEL_SCHEMA = "candidate_id string, llm_score int, llm_reasoning string"
SUBMISSION_SCHEMA = "candidate_id string, rank int, score double, reasoning string"

#: Parts of the signals that are read as numbers.
SIGNAL_NUMBERS = (
    "profile_completeness_score", "profile_views_received_30d", "applications_submitted_30d", "recruiter_response_rate", "avg_response_time_hours",
    "connection_count", "endorsements_received", "notice_period_days", "expected_salary_range_inr_lpa.min", "expected_salary_range_inr_lpa.max",
    "github_activity_score", "search_appearance_30d", "saved_by_recruiters_30d", "interview_completion_rate", "offer_acceptance_rate")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory (never machine-local on a cluster)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def _read_text(spark: SparkSession, path: str, partitions: int | None) -> DataFrame:
    return _spread_gzip(_text_lines(spark, path), partitions)


def _text_lines(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.text(path)
    except AnalysisException as e:                      # S5
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise FileNotFoundError(f"Cannot find data file at {path}") from e
        raise


def _spread_gzip(lines: DataFrame, partitions: int | None) -> DataFrame:
    if any(f.endswith(".gz") for f in lines.inputFiles()):      # S2: one task per gzip file → spread it
        lines = lines.repartition(partitions or lines.sparkSession.sparkContext.defaultParallelism)
    return lines


#: The texts and numbers that are read from the records of each history.
HISTORIES = {
    "career_history": (("title", "company", "industry", "description"), ("duration_months",)),
    "skills": (("name", "proficiency"), ("endorsements", "duration_months")),
    "education": (("degree", "tier", "field_of_study"), ("end_year",)),
}


def _parts(signals_key: str) -> dict[str, str]:
    """The parts of a record that rules look at, as SQL over its VARIANT ``v``; each is taken out once.

    Casting to a struct of variants gives null for what is no object (for lists: no list of objects).
    """
    fields = lambda names: ", ".join(f"{n}: variant" for n in names)
    salary = "expected_salary_range_inr_lpa"
    parts = {"profile": "try_variant_get(v, '$.profile', 'struct<years_of_experience: variant>')",
             "signals": f"try_variant_get(v, '$.{signals_key}', 'struct<{fields(n for n in SIGNAL_NUMBERS if '.' not in n)}>')",
             salary: f"try_variant_get(v, '$.{signals_key}.{salary}', 'struct<min: variant, max: variant>')"}
    return parts | {path: f"try_variant_get(v, '$.{path}', 'array<struct<{fields(texts + numbers)}>>')" for path, (texts, numbers) in HISTORIES.items()}


def _rules(signals_key: str) -> dict[str, str]:
    """What makes a record unusable, as SQL over its ``_parts``; the first that holds names the reason.

    A missing key takes its default.  A key that is there must be usable: an object where an object is
    needed, a list of objects (or something empty) for the three histories, texts and numbers inside them,
    and something that reads as a number, ``"7"`` included, for the other numbers.
    """
    # a copy of the whole part, made only for records whose part isn't of the form that is needed
    whole = lambda path: f"variant_get(v, '$.{path}', 'variant')"
    not_number = lambda x: f"{x} IS NOT NULL AND try_variant_get({x}, '$', 'double') IS NULL"
    not_text = lambda x: f"({x} IS NOT NULL AND schema_of_variant({x}) <> 'STRING')"
    no_count = lambda x: f"({x} IS NOT NULL AND NOT schema_of_variant({x}) RLIKE '^(BIGINT|DOUBLE|DECIMAL|BOOLEAN)')"

    def no_object(part: str, path: str) -> str:
        return f"CASE WHEN {part} IS NULL THEN {whole(path)} IS NOT NULL ELSE false END"

    def bad_history(path: str) -> str:
        texts, numbers = HISTORIES[path]
        empty = f"coalesce(to_json({whole(path)}) IN ('null', '{{}}', '[]', '\"\"', '0', 'false'), false)"
        wrong = " OR ".join(["x IS NULL", *(not_text(f"x.{t}") for t in texts), *(no_count(f"x.{n}") for n in numbers)])
        return f"CASE WHEN {path} IS NULL THEN {whole(path)} IS NOT NULL AND NOT {empty} ELSE exists({path}, x -> {wrong}) END"

    salary = "expected_salary_range_inr_lpa"
    rules = {"profile": no_object("profile", "profile"), "profile.years_of_experience": not_number("profile.years_of_experience")}
    rules |= {path: bad_history(path) for path in HISTORIES}
    rules |= {signals_key: no_object("signals", signals_key), f"{signals_key}.{salary}": no_object(salary, f"{signals_key}.{salary}")}
    return rules | {f"{signals_key}.{n}": not_number(n if "." in n else f"signals.{n}") for n in SIGNAL_NUMBERS}


def tag_lines(lines: DataFrame, signals_key: str = "signals", strict: bool = True) -> DataFrame:
    """``(value, reason, r, has_signals)`` of every line that isn't blank, from one parse.

    ``reason`` is null for a usable record; ``malformed`` (not JSON), ``not_object``, or with ``strict`` the
    name of the part that can't be used.
    """
    text = lines.where(py_strip(F.col("value")) != "")                   # S3 (Python strip semantics)
    v = text.select("value", F.try_parse_json(F.col("value")).alias("v"))
    schema = candidate_schema(signals_key).simpleString()
    parts = v.select("value", "v", F.expr("v IS NOT NULL AND try_variant_get(v, '$', 'struct<candidate_id: variant>') IS NULL").alias("no_object"),
                     F.expr(f"try_variant_get(v, '$', '{schema}')").alias("r"), *[F.expr(x).alias(n) for n, x in _parts(signals_key).items()])
    cases = ["WHEN v IS NULL THEN 'malformed'", "WHEN no_object THEN 'not_object'"]
    if strict:
        cases += [f"WHEN {test} THEN '{name}'" for name, test in _rules(signals_key).items()]
    return parts.select("value", F.expr(f"CASE {' '.join(cases)} END").alias("reason"), "r", F.col("signals").isNotNull().alias("has_signals"))


class SignalsMissing(ValueError):
    """No record of the input has the configured signals key."""

    def __init__(self, key: str):
        super().__init__(f"no record has an object under {key!r}; name the key that holds the signals (signals_key)")


def _split_tagged(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    # a condition on the reason would be pushed below the parse and repeat it; a list that is empty for other lines isn't
    only = lambda ok, *cols: tagged.select(F.explode(F.when(ok, F.array(F.struct(*cols)))).alias("k")).select("k.*")
    reason = F.col("reason")
    return only(reason.isNull(), "r").select("r.*"), only(reason.isNotNull(), "value", "reason")


def classify_lines(lines: DataFrame, signals_key: str = "signals", strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """S3–S4 on a frame of text lines (batch or streaming): ``(good records, quarantine)``."""
    return _split_tagged(tag_lines(lines, signals_key, strict))


def read_candidates(spark: SparkSession, path: str, signals_key: str = "signals", strict: bool = True,
                    partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``(good records, quarantine of (value, reason))``.

    Raises ``SignalsMissing`` if there are good records and none has the signals key: their signals
    would silently be all defaults.  Both frames scan the file; ``stage_candidates`` scans it once.  The look for
    the key ends at the first record that has it.
    """
    lines = _text_lines(spark, path)
    probe = tag_lines(lines, signals_key, strict).select("reason", "has_signals")
    if probe.where("reason IS NULL AND has_signals").isEmpty() and not probe.where("reason IS NULL").isEmpty():
        raise SignalsMissing(signals_key)
    return _split_tagged(tag_lines(_spread_gzip(lines, partitions), signals_key, strict))


def skip_reasons(signals_key: str = "signals") -> list[str]:
    """Every reason for which a line can be skipped."""
    return ["malformed", "not_object", *_rules(signals_key)]


def stage_candidates(spark: SparkSession, path: str, signals_key: str = "signals", strict: bool = True,
                     out: str | None = None, keep_text: bool = False, metrics: RunMetrics | None = None) -> tuple[DataFrame, DataFrame]:
    """S1–S4 with one scan and one parse: good records and quarantine in one Parquet table.

    Rows are partitioned by ``_ok``; later passes read the typed columns of the good partition and the
    quarantine separately.  Returns ``(good, quarantine)``; raises ``SignalsMissing`` as ``read_candidates`` does.
    With ``keep_text`` the good records also have their line, as ``value``.  While it writes, the job counts lines
    (``lines``: rows) and records (``load``: rows, usable, with_signals, and one number for each skip reason) in ``metrics``.
    """
    metrics = metrics or RunMetrics()
    ok = F.col("reason").isNull()
    tagged = metrics.watch(tag_lines(metrics.watch(_read_text(spark, path, None), "lines"), signals_key, strict), "load",
                           usable=count_of(ok), with_signals=count_of(ok & F.col("has_signals")),
                           **{f"skipped {r}": count_of(F.col("reason") == r) for r in skip_reasons(signals_key)})
    out = out or scratch_path(spark, "candidates-staged")
    rows = tagged.select(F.when(ok, F.col("r")).alias("r"), F.when(~ok | F.lit(keep_text), F.col("value")).alias("value"), "reason", "has_signals", ok.alias("_ok"))
    bloom(rows.write.mode("overwrite").partitionBy("_ok"), "r.candidate_id").parquet(out)
    staged = spark.read.schema(f"r {candidate_schema(signals_key).simpleString()}, value string, reason string, has_signals boolean, _ok boolean").parquet(out)
    good, seen = staged.where("_ok"), metrics.of("load")
    if seen["usable"] and not seen["with_signals"]:
        raise SignalsMissing(signals_key)
    return good.select("r.*", *(["value"] if keep_text else [])), staged.where("NOT _ok").select("value", "reason")


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a staged folder (Hadoop FS, any scheme)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def stage_parquet(df: DataFrame, path: str, mode: str = "overwrite", looked_up: str | None = None) -> str:
    """Write once to Parquet so later jobs get column pruning and predicate pushdown; see ``bloom`` for ``looked_up``."""
    bloom(df.write.mode(mode), looked_up).parquet(path)
    return path


def bloom(writer, column: str | None):
    """Have every row group written with a Bloom filter of ``column``, so that ``fetch_by_ids`` skips the groups without its ids."""
    if column:                                                      # adaptive: the smallest of several sizes that fits the group's ids
        return writer.option(f"parquet.bloom.filter.enabled#{column}", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
    return writer


def write_jsonl(df: DataFrame, path: str, gzip: bool = False) -> str:
    w = df.write.mode("overwrite")
    if gzip:
        w = w.option("compression", "gzip")
    w.json(path)
    return path


#: Lines in one file of ``write_lines``; a compressed file is read by one task as a whole.
LINES_A_FILE = 10_000


def write_lines(lines: DataFrame, path: str) -> str:
    """One text column as compressed text, in files small enough to be dealt evenly to the tasks that read them.

    Deflated rather than gzipped: a reader spreads gzip input by a shuffle of all its lines (S2), which so many files don't need.
    """
    lines.write.option("compression", "deflate").option("maxRecordsPerFile", LINES_A_FILE).text(path)
    return path


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """S6 (+L4): a label CSV, or a :class:`~.label_log.LabelLog`; what can't be read gives an empty frame."""
    from .label_log import LabelLog
    log = LabelLog(spark, path)
    if log.exists():
        return log.labels()
    try:
        return (spark.read.schema(LABEL_SCHEMA).option("header", True).option("escape", '"')
                .option("mode", "PERMISSIVE").csv(path))
    except AnalysisException:
        return spark.createDataFrame([], LABEL_SCHEMA)


def append_labels(labels: DataFrame, path: str, fmt: str = "csv") -> None:
    """Append label rows to plain files (newlines in the reasoning become spaces); ``LabelLog`` is safe to replay."""
    from ..operators.labeling import clean_reasoning
    clean = labels.select("candidate_id", F.col("llm_score").cast("int"),
                          clean_reasoning(F.coalesce("llm_reasoning", F.lit(""))).alias("llm_reasoning"))
    w = clean.write.mode("append")
    if fmt == "csv":
        w.option("header", True).option("quoteAll", True).option("escape", '"').csv(path)
    else:
        w.parquet(path)


def read_submission(spark: SparkSession, path: str) -> DataFrame:
    """Typed submission."""
    return spark.read.schema(SUBMISSION_SCHEMA).option("header", True).option("escape", '"').csv(path)


def write_submission(ranked: DataFrame, path: str, decimals: int = 4) -> str:
    """Header + every field quoted; k rows → one file (``coalesce(1)`` on ≤ k rows)."""
    out = ranked.select("candidate_id", F.col("rank").cast("int").alias("rank"),
                        F.format_string(f"%.{decimals}f", F.col("score")).alias("score"), "reasoning")
    (out.orderBy("rank").coalesce(1).write.mode("overwrite").option("header", True).option("quoteAll", True)
        .option("escape", '"').csv(path))
    return path


def single_csv_file(spark: SparkSession, folder: str) -> str:
    """Path of the one part file a ``coalesce(1)`` write produced (Hadoop FS, any scheme)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    parts = [s.getPath().toString() for s in fs.listStatus(p) if s.getPath().getName().startswith("part-")]
    if len(parts) != 1:
        raise RuntimeError(f"expected one part file in {folder}, found {len(parts)}")
    return parts[0]


#: Ids that a fetch pushes down to the scan as a condition.
FETCH_IDS = 10_000


def records_by_ids(raw: DataFrame, ids: DataFrame) -> DataFrame:
    """Raw records whose id is in ``ids`` (semi-join; adaptive execution broadcasts what turns out small)."""
    return raw.join(ids.select("candidate_id").distinct(), "candidate_id", "left_semi")


def fetch_by_ids(raw: DataFrame, ids: DataFrame) -> DataFrame:
    """S9 for a few ids of many records: up to ``FETCH_IDS`` ids become a condition that reaches the scan; more are joined.

    Over a table staged with a Bloom filter of the id, row groups (and pages) that hold none of the ids aren't read,
    in whatever order its rows are.  Null ids match nothing, as in the join.
    """
    found = [r[0] for r in ids.select("candidate_id").where("candidate_id IS NOT NULL").distinct().limit(FETCH_IDS + 1).collect()]
    if len(found) > FETCH_IDS:
        return records_by_ids(raw, ids)
    return raw.where(F.col("candidate_id").isin(found)) if found else raw.where(F.lit(False))


def write_json_rows(spark: SparkSession, rows: list[dict], path: str) -> str:
    """Small artefacts (feature config, training report) as JSON lines."""
    spark.createDataFrame([(json.dumps(r),) for r in rows], "value string").coalesce(1) \
        .write.mode("overwrite").text(path)
    return path


def write_profile(profile_rows: DataFrame, path: str) -> str:
    """Long-format profile report as JSON."""
    profile_rows.write.mode("overwrite").json(path)
    return path
