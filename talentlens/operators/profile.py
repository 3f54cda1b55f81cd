"""Dataset profile (G1–G15) over raw nested candidate records.

Every section is a distributed aggregation emitting long-format rows
``(section, metric, key, value)``; the full profile is their union.  Counts
go through ``groupBy`` with map-side partial aggregation (a hot value such as
one title held by a third of all rows costs one row per map task), top-n
lists through ``orderBy(desc(n), asc(key)).limit(n)`` (TakeOrdered, no global
sort).  Ties are broken by key ascending (first-seen order is not defined on a
distributed scan).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..session import cut_lineage
from .stats import grouped_describe

SCHEMA = "section string, metric string, key string, value double"


def _rows(df: DataFrame, section: str, metric: str, key: Column, value: Column) -> DataFrame:
    return df.select(F.lit(section).alias("section"), F.lit(metric).alias("metric"),
                     key.cast("string").alias("key"), value.cast("double").alias("value"))


def _s(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def value_counts(df: DataFrame, expr: Column, section: str, metric: str, top: int | None = None) -> DataFrame:
    """Counts per value, optionally the top-n (count desc, value asc)."""
    counts = df.select(expr.alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    if top:
        counts = counts.orderBy(F.desc("n"), F.asc("key")).limit(top)
    return _rows(counts, section, metric, F.col("key"), F.col("n"))


def overview(raw: DataFrame) -> DataFrame:
    """Total count and the India share."""
    country = F.col("profile")["country"]
    agg = raw.agg(F.count(F.lit(1)).alias("total"),
                  F.sum((country == "India").cast("long")).alias("india"))
    pct = F.when(F.col("total") > 0, F.col("india") / F.col("total") * 100).otherwise(F.lit(0.0))
    return _rows(agg, "overview", "total_candidates", F.lit(""), F.col("total")).unionByName(
        _rows(agg, "overview", "india_percentage", F.lit(""), pct))


def distributions(raw: DataFrame) -> DataFrame:
    """G1: title, industry, country top 20."""
    p = F.col("profile")
    return (value_counts(raw, _s(p["current_title"]), "distribution", "title", 20)
            .unionByName(value_counts(raw, _s(p["current_industry"]), "distribution", "industry", 20))
            .unionByName(value_counts(raw, _s(p["country"]), "distribution", "country", 20)))


def experience_bin(years: Column) -> Column:
    expr = None
    for bound, label in C.EXPERIENCE_BINS:
        expr = F.when(years < bound, F.lit(label)) if expr is None else expr.when(years < bound, F.lit(label))
    return expr.otherwise(F.lit(C.EXPERIENCE_TOP_BIN))


def experience(raw: DataFrame) -> DataFrame:
    """G3 bins + G4 exact stats of years of experience."""
    years = F.coalesce(F.col("profile")["years_of_experience"], F.lit(0.0))
    bins = value_counts(raw, experience_bin(years), "experience", "bin")
    stats = grouped_describe(raw.select(F.lit("years").alias("g"), years.alias("v")))
    return bins.unionByName(_rows(stats, "experience", "years", F.col("stat"), F.col("value")))


def skills(raw: DataFrame) -> DataFrame:
    """G5 (names, proficiency), G6 (skills per candidate) and G7 (critical-skill coverage)."""
    sk = raw.select(F.explode(F.coalesce(F.col("skills"), F.array())).alias("s"))
    names = sk.select(_s(F.col("s")["name"]).alias("name"))
    unique = _rows(names.agg(F.countDistinct("name").alias("u")), "skills", "unique_skills", F.lit(""), F.col("u"))
    top = value_counts(names, F.col("name"), "skills", "top_skill", 50)
    prof = value_counts(sk, _s(F.col("s")["proficiency"]), "skills", "proficiency")
    per = value_counts(raw, F.size(F.coalesce(F.col("skills"), F.array())), "skills", "skills_per_candidate")
    lowered = F.transform(F.coalesce(F.col("skills"), F.array()), lambda s: F.lower(_s(s["name"])))
    cover = raw.agg(*[F.sum(F.arrays_overlap(lowered, F.array(*[F.lit(v) for v in vals])).cast("long")).alias(g)
                      for g, vals in C.PROFILE_SKILL_GROUPS])
    cov_rows = None
    for g, _ in C.PROFILE_SKILL_GROUPS:
        r = _rows(cover, "skills", "critical_coverage", F.lit(g), F.coalesce(F.col(g), F.lit(0)))
        cov_rows = r if cov_rows is None else cov_rows.unionByName(r)
    return unique.unionByName(top).unionByName(prof).unionByName(per).unionByName(cov_rows)


def companies(raw: DataFrame) -> DataFrame:
    """Top 30 current companies; currently consulting; only consulting (non-empty career)."""
    current = _s(F.col("profile")["current_company"])
    jobs = F.coalesce(F.col("career_history"), F.array())
    consult = list(C.PROFILE_CONSULTING)
    agg = raw.agg(
        F.sum(F.lower(current).isin(*consult).cast("long")).alias("cur"),
        F.sum(((F.size(jobs) > 0) & F.forall(jobs, lambda j: F.lower(_s(j["company"])).isin(*consult))).cast("long")).alias("only"))
    return (value_counts(raw, current, "companies", "top_company", 30)
            .unionByName(_rows(agg, "companies", "current_consulting", F.lit(""), F.coalesce(F.col("cur"), F.lit(0))))
            .unionByName(_rows(agg, "companies", "only_consulting", F.lit(""), F.coalesce(F.col("only"), F.lit(0)))))


SIGNAL_STATS = (
    ("profile_completeness_score", None), ("recruiter_response_rate", None), ("avg_response_time_hours", None),
    ("notice_period_days", None), ("interview_completion_rate", None), ("search_appearance_30d", None),
    ("saved_by_recruiters_30d", None), ("github_activity_score", -1.0), ("offer_acceptance_rate", -1.0),
)


def signals(raw: DataFrame, signals_key: str = "signals") -> DataFrame:
    """G9 stats (nulls and −1 sentinels excluded), G10 flags, G11 inactivity."""
    s = F.col(signals_key)
    pairs = []
    for name, sentinel in SIGNAL_STATS:
        v = s[name]
        if sentinel is not None:
            v = F.when(v != sentinel, v)
        pairs.append(F.struct(F.lit(name).alias("g"), v.cast("double").alias("v")))
    long = raw.select(F.explode(F.array(*pairs)).alias("p")).select("p.g", "p.v")
    stats = grouped_describe(long)
    stat_rows = _rows(stats, "signals", "stat", F.concat(F.col("g"), F.lit("."), F.col("stat")), F.col("value"))
    flag = lambda c: F.sum(F.coalesce(c, F.lit(False)).cast("long"))
    last = F.try_to_date(s["last_active_date"], "yyyy-MM-dd")
    days = F.datediff(F.lit("2026-06-01").cast("date"), last)
    agg = raw.agg(
        flag(s["open_to_work_flag"]).alias("open_to_work"),
        F.sum((s["github_activity_score"] == -1).cast("long")).alias("no_github"),
        flag(s["verified_email"]).alias("verified_email"),
        flag(s["verified_phone"]).alias("verified_phone"),
        flag(s["linkedin_connected"]).alias("linkedin_connected"),
        F.sum(((days > 90) & (days <= 180)).cast("long")).alias("inactive_more_than_90_days"),
        F.sum((days > 180).cast("long")).alias("inactive_more_than_180_days"),
    )
    out = stat_rows
    for c in ("open_to_work", "no_github", "verified_email", "verified_phone", "linkedin_connected",
              "inactive_more_than_90_days", "inactive_more_than_180_days"):
        out = out.unionByName(_rows(agg, "signals", "count", F.lit(c), F.coalesce(F.col(c), F.lit(0))))
    return out


def career(raw: DataFrame) -> DataFrame:
    """G6 jobs per candidate, G12 industries over jobs, mean job duration, has-current count."""
    jobs = F.coalesce(F.col("career_history"), F.array())
    exploded = raw.select(F.explode(jobs).alias("j"))
    per = value_counts(raw, F.size(jobs), "career", "jobs_per_candidate")
    ind = value_counts(exploded, _s(F.col("j")["industry"]), "career", "top_industry", 20)
    dur = exploded.agg(F.avg(F.coalesce(F.col("j")["duration_months"], F.lit(0.0))).alias("m"))
    cur = raw.agg(F.sum(F.exists(jobs, lambda j: F.coalesce(j["is_current"], F.lit(False))).cast("long")).alias("c"))
    return (per.unionByName(ind)
            .unionByName(_rows(dur, "career", "mean_job_duration", F.lit(""), F.coalesce(F.col("m"), F.lit(0.0))))
            .unionByName(_rows(cur, "career", "with_current_job", F.lit(""), F.coalesce(F.col("c"), F.lit(0)))))


def education(raw: DataFrame) -> DataFrame:
    """Tiers, top-20 degrees and fields over entries; CS-related candidates."""
    ed = F.coalesce(F.col("education"), F.array())
    ex = raw.select(F.explode(ed).alias("e"))
    fields = list(C.PROFILE_CS_FIELDS)
    cs = raw.agg(F.sum(F.exists(ed, lambda e: F.exists(
        F.array(*[F.lit(f) for f in fields]), lambda k: F.contains(F.lower(_s(e["field_of_study"])), k))).cast("long")).alias("c"))
    return (value_counts(ex, F.coalesce(F.col("e")["tier"], F.lit("unknown")), "education", "tier")
            .unionByName(value_counts(ex, _s(F.col("e")["degree"]), "education", "top_degree", 20))
            .unionByName(value_counts(ex, _s(F.col("e")["field_of_study"]), "education", "top_field", 20))
            .unionByName(_rows(cs, "education", "cs_related", F.lit(""), F.coalesce(F.col("c"), F.lit(0)))))


def integrity_indicators(raw: DataFrame, signals_key: str = "signals") -> DataFrame:
    """The profile's own (looser) indicator definitions."""
    s = F.col(signals_key)
    sal = s["expected_salary_range_inr_lpa"]
    lo, hi = F.coalesce(sal["min"], F.lit(0.0)), F.coalesce(sal["max"], F.lit(0.0))
    years = F.coalesce(F.col("profile")["years_of_experience"], F.lit(0.0))
    ed = F.coalesce(F.col("education"), F.array())
    latest = F.greatest(F.coalesce(F.array_max(F.transform(ed, lambda e: F.coalesce(e["end_year"], F.lit(0.0)))),
                                   F.lit(0.0)), F.lit(0.0))
    jobs = F.coalesce(F.col("career_history"), F.array())
    months = F.aggregate(jobs, F.lit(0.0), lambda a, j: a + F.coalesce(j["duration_months"], F.lit(0.0)))
    sk = F.coalesce(F.col("skills"), F.array())
    adv = F.filter(sk, lambda x: x["proficiency"].isin("advanced", "expert"))
    zero = F.filter(adv, lambda x: F.coalesce(x["endorsements"], F.lit(0.0)) == 0)
    agg = raw.agg(
        F.sum((lo > hi).cast("long")).alias("salary_inversion"),
        F.sum(((latest > 0) & (years > (F.lit(2026) - latest) + 2)).cast("long")).alias("experience_vs_education_mismatch"),
        F.sum(((months > years * 12 * 1.5) | (months < years * 12 * 0.3)).cast("long")).alias("career_duration_mismatch"),
        F.sum(((F.size(adv) >= 8) & (F.size(zero) >= 6)).cast("long")).alias("skill_stuffer"),
    )
    out = None
    for c in ("salary_inversion", "experience_vs_education_mismatch", "career_duration_mismatch", "skill_stuffer"):
        r = _rows(agg, "integrity", "indicator", F.lit(c), F.coalesce(F.col(c), F.lit(0)))
        out = r if out is None else out.unionByName(r)
    return out


def full_profile(raw: DataFrame, signals_key: str = "signals") -> DataFrame:
    """Every section, in three passes over the candidates instead of one per section.

    1. one ``agg`` for all scalar counts (overview, coverage, flags, inactivity,
       consulting, current jobs, CS fields, integrity indicators, job durations);
    2. one ``explode`` of ``(section, metric, key)`` structs per candidate (its own
       categorical values plus one per skill, job and education entry) and a
       single ``groupBy(section, metric, key).count()`` — map-side combined, so
       a hot value is one partial row per task; the (small) count table is
       checkpointed and each metric's top-n is a TakeOrdered over it;
    3. one ``grouped_describe`` over years and all signals.
    """
    p = F.col("profile")
    s = F.col(signals_key)
    jobs = F.coalesce(F.col("career_history"), F.array())
    sk = F.coalesce(F.col("skills"), F.array())
    ed = F.coalesce(F.col("education"), F.array())
    consult = list(C.PROFILE_CONSULTING)

    # ---- pass 1: scalar counts
    lowered = F.transform(sk, lambda x: F.lower(_s(x["name"])))
    last = F.try_to_date(s["last_active_date"], "yyyy-MM-dd")
    days = F.datediff(F.lit("2026-06-01").cast("date"), last)
    flag = lambda c: F.sum(F.coalesce(c, F.lit(False)).cast("long"))
    fields = [F.lit(f) for f in C.PROFILE_CS_FIELDS]
    sal = s["expected_salary_range_inr_lpa"]
    lo, hi = F.coalesce(sal["min"], F.lit(0.0)), F.coalesce(sal["max"], F.lit(0.0))
    years = F.coalesce(p["years_of_experience"], F.lit(0.0))
    latest = F.greatest(F.coalesce(F.array_max(F.transform(ed, lambda e: F.coalesce(e["end_year"], F.lit(0.0)))),
                                   F.lit(0.0)), F.lit(0.0))
    months = F.aggregate(jobs, F.lit(0.0), lambda a, j: a + F.coalesce(j["duration_months"], F.lit(0.0)))
    adv = F.filter(sk, lambda x: x["proficiency"].isin("advanced", "expert"))
    zero = F.filter(adv, lambda x: F.coalesce(x["endorsements"], F.lit(0.0)) == 0)
    scalars = [  # (section, metric, key, aggregate)
        ("overview", "total_candidates", "", F.count(F.lit(1))),
        ("companies", "current_consulting", "", F.sum(F.lower(_s(p["current_company"])).isin(*consult).cast("long"))),
        ("companies", "only_consulting", "", F.sum(((F.size(jobs) > 0) & F.forall(
            jobs, lambda j: F.lower(_s(j["company"])).isin(*consult))).cast("long"))),
        ("signals", "count", "open_to_work", flag(s["open_to_work_flag"])),
        ("signals", "count", "no_github", F.sum((s["github_activity_score"] == -1).cast("long"))),
        ("signals", "count", "verified_email", flag(s["verified_email"])),
        ("signals", "count", "verified_phone", flag(s["verified_phone"])),
        ("signals", "count", "linkedin_connected", flag(s["linkedin_connected"])),
        ("signals", "count", "inactive_more_than_90_days", F.sum(((days > 90) & (days <= 180)).cast("long"))),
        ("signals", "count", "inactive_more_than_180_days", F.sum((days > 180).cast("long"))),
        ("career", "with_current_job", "", F.sum(F.exists(jobs, lambda j: F.coalesce(j["is_current"], F.lit(False))).cast("long"))),
        ("education", "cs_related", "", F.sum(F.exists(ed, lambda e: F.exists(
            F.array(*fields), lambda k: F.contains(F.lower(_s(e["field_of_study"])), k))).cast("long"))),
        ("integrity", "indicator", "salary_inversion", F.sum((lo > hi).cast("long"))),
        ("integrity", "indicator", "experience_vs_education_mismatch",
         F.sum(((latest > 0) & (years > (F.lit(2026) - latest) + 2)).cast("long"))),
        ("integrity", "indicator", "career_duration_mismatch",
         F.sum(((months > years * 12 * 1.5) | (months < years * 12 * 0.3)).cast("long"))),
        ("integrity", "indicator", "skill_stuffer", F.sum(((F.size(adv) >= 8) & (F.size(zero) >= 6)).cast("long"))),
    ] + [("skills", "critical_coverage", g, F.sum(F.arrays_overlap(lowered, F.array(*[F.lit(v) for v in vals])).cast("long")))
         for g, vals in C.PROFILE_SKILL_GROUPS]
    names = [f"a{i}" for i in range(len(scalars))]
    wide = raw.agg(*[F.coalesce(a, F.lit(0)).alias(n) for (_, _, _, a), n in zip(scalars, names)],
                   F.sum((p["country"] == "India").cast("long")).alias("india"),
                   F.sum(months).alias("dur_sum"), F.sum(F.size(jobs)).alias("dur_n"))
    cells = [F.struct(F.lit(sec).alias("section"), F.lit(met).alias("metric"), F.lit(key).alias("key"),
                      F.col(n).cast("double").alias("value")) for (sec, met, key, _), n in zip(scalars, names)]
    total = F.col(names[0])
    cells.append(F.struct(F.lit("overview").alias("section"), F.lit("india_percentage").alias("metric"), F.lit("").alias("key"),
                          F.when(total > 0, F.coalesce(F.col("india"), F.lit(0)) / total * 100).otherwise(F.lit(0.0))
                          .cast("double").alias("value")))
    cells.append(F.struct(F.lit("career").alias("section"), F.lit("mean_job_duration").alias("metric"), F.lit("").alias("key"),
                          F.when(F.col("dur_n") > 0, F.col("dur_sum") / F.col("dur_n")).otherwise(F.lit(0.0))
                          .cast("double").alias("value")))
    scalar_rows = wide.select(F.explode(F.array(*cells)).alias("c")).select("c.*")

    # ---- pass 2: every categorical count in one groupBy
    def kv(section, metric, key):
        return F.struct(F.lit(section).alias("section"), F.lit(metric).alias("metric"), key.cast("string").alias("key"))

    per_candidate = F.array(
        kv("distribution", "title", _s(p["current_title"])),
        kv("distribution", "industry", _s(p["current_industry"])),
        kv("distribution", "country", _s(p["country"])),
        kv("experience", "bin", experience_bin(years)),
        kv("skills", "skills_per_candidate", F.size(sk)),
        kv("companies", "top_company", _s(p["current_company"])),
        kv("career", "jobs_per_candidate", F.size(jobs)),
    )
    keys = F.concat(
        per_candidate,
        F.transform(sk, lambda x: kv("skills", "top_skill", _s(x["name"]))),
        F.transform(sk, lambda x: kv("skills", "proficiency", _s(x["proficiency"]))),
        F.transform(jobs, lambda j: kv("career", "top_industry", _s(j["industry"]))),
        F.transform(ed, lambda e: kv("education", "tier", F.coalesce(e["tier"], F.lit("unknown")))),
        F.transform(ed, lambda e: kv("education", "top_degree", _s(e["degree"]))),
        F.transform(ed, lambda e: kv("education", "top_field", _s(e["field_of_study"]))),
    )
    counts = cut_lineage(raw.select(F.explode(keys).alias("k")).select("k.*")
                         .groupBy("section", "metric", "key").agg(F.count(F.lit(1)).alias("n")))
    tops = {"title": 20, "industry": 20, "country": 20, "top_skill": 50, "top_company": 30,
            "top_industry": 20, "top_degree": 20, "top_field": 20}
    cat_rows = None
    for metric in ("title", "industry", "country", "bin", "top_skill", "proficiency", "skills_per_candidate",
                   "top_company", "jobs_per_candidate", "top_industry", "tier", "top_degree", "top_field"):
        part = counts.where(F.col("metric") == metric)
        if metric in tops:
            part = part.orderBy(F.desc("n"), F.asc("key")).limit(tops[metric])
        part = part.select("section", "metric", "key", F.col("n").cast("double").alias("value"))
        cat_rows = part if cat_rows is None else cat_rows.unionByName(part)
    unique = counts.where(F.col("metric") == "top_skill").agg(F.count(F.lit(1)).alias("u")) \
                   .select(F.lit("skills").alias("section"), F.lit("unique_skills").alias("metric"),
                           F.lit("").alias("key"), F.col("u").cast("double").alias("value"))

    # ---- pass 3: exact statistics for years and every signal in one describe
    pairs = [F.struct(F.lit("years").alias("g"), years.cast("double").alias("v"))]
    for name, sentinel in SIGNAL_STATS:
        v = s[name]
        if sentinel is not None:
            v = F.when(v != sentinel, v)
        pairs.append(F.struct(F.lit(name).alias("g"), v.cast("double").alias("v")))
    stats = grouped_describe(raw.select(F.explode(F.array(*pairs)).alias("p")).select("p.g", "p.v"))
    stat_rows = stats.select(
        F.when(F.col("g") == "years", F.lit("experience")).otherwise(F.lit("signals")).alias("section"),
        F.when(F.col("g") == "years", F.lit("years")).otherwise(F.lit("stat")).alias("metric"),
        F.when(F.col("g") == "years", F.col("stat")).otherwise(F.concat(F.col("g"), F.lit("."), F.col("stat"))).alias("key"),
        F.col("value").cast("double").alias("value"))
    return scalar_rows.unionByName(cat_rows).unionByName(unique).unionByName(stat_rows)
