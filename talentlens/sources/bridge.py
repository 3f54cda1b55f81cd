"""Candidate fixture: nested candidate records derived from the driver tables.

Every order is one job and every line item one skill of exactly one candidate;
nothing is left out.  Order keys are dealt to candidates in blocks of
``BLOCK`` keys, cut into candidates of 1, 2, 3, 6 and 11 jobs, so the size of a
candidate doesn't depend on how many orders a customer has.  An order with more
than ``ORDER_ITEMS`` line items spreads them over further candidates without a
career.  Every customer also is a candidate without any history.  The rest of a
record is arithmetic on the candidate's number over literal pools (see
``fixture_pools``).

The work is one pass over ``orders``, one over ``lineitem`` (and one that counts
each order's items), and joins on keys that are unique on one side.  Only narrow
rows are shuffled: an order takes its customer's name along, jobs and skills go to
their candidate's task as they were read, are sorted there once, and each candidate
is put together from the two sorted streams; no assembled record is moved or sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..session import read_table
from . import fixture_pools as P
from .files import scratch_path, stage_parquet


def _pick(pool, expr: Column) -> Column:
    """``pool[expr % len(pool)]`` with a literal array (constant-folded)."""
    arr = F.array(*[F.lit(v) for v in pool])
    return arr[F.pmod(expr, F.lit(len(pool))).cast("int")]


def _dbl(c: Column) -> Column:
    return c.cast("double")


def candidate_number(order_key: str) -> Column:
    """Number of the candidate that an order belongs to: seven numbers for each block of keys, five of them for orders."""
    whens = " ".join(f"WHEN pmod({order_key}, {P.BLOCK}) < {upto} THEN {sub}" for sub, upto in enumerate(P.BLOCK_CUTS))
    return F.expr(f"CAST(floor({order_key} / {P.BLOCK}) AS BIGINT) * 7 + CASE {whens} END").cast("long")


def career_rows(orders: DataFrame, *more: str) -> DataFrame:
    """One row per candidate with its jobs: all orders, by date and key; ``P.BLOCK_CUTS`` bounds a candidate's.

    ``ck`` and the columns ``more`` are the first job's.
    """
    by = ["o_orderdate", "o_orderkey"]
    ordered = orders.select("o_custkey", *by, *more, candidate_number("o_orderkey").alias("k"))
    ranked = ordered.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy(*by)))
    rn, k, ok = F.col("rn"), F.col("k"), F.col("o_orderkey")
    return _listed(ranked.select(
        "k", rn, F.col("o_custkey").alias("ck"), *by, *more,
        F.struct(
            F.when(F.pmod(k, F.lit(11)) == 0, _pick(P.CONSULTING, ok))
             .otherwise(_pick(P.COMPANIES, ok)).alias("company"),
            _pick(P.TITLES, k + 3 * (rn - 1)).alias("title"),
            F.when(F.pmod(ok, F.lit(61)) == 0, F.date_format("o_orderdate", "MM/dd/yyyy"))
             .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("start_date"),
            F.lit(None).cast("string").alias("end_date"),
            _dbl(F.when(F.pmod(k, F.lit(23)) == 0, 260 + F.pmod(ok, F.lit(40)))
                 .when(F.pmod(k, F.lit(13)) == 0, 6 + F.pmod(ok, F.lit(10)))
                 .otherwise(6 + F.pmod(ok, F.lit(40)))).alias("duration_months"),
            ((rn == 1) | ((F.pmod(k, F.lit(37)) == 0) & (rn == 2))).alias("is_current"),
            _pick(P.INDUSTRIES, ok).alias("industry"),
            F.when(F.pmod(ok, F.lit(53)) == 0, F.lit("10000+"))
             .when(F.pmod(ok, F.lit(47)) != 0, _pick(P.COMPANY_SIZES, ok)).alias("company_size"),
            _pick(P.DESCRIPTIONS, ok + rn).alias("description"),
        ).alias("job"),
    ), by, "job", "career_history").select("k", "ck", *more, "career_history")


def skill_rows(lineitem: DataFrame) -> DataFrame:
    """One row per candidate with its skills: all line items of the candidate's orders.

    A large order's items are dealt by their part and supplier; one candidate gets about ``P.ORDER_ITEMS``.
    The large orders are written as a table first: where they are few, as is usual, they are
    broadcast by their size and the items aren't shuffled for them.
    """
    order_cols = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
    items = lineitem.select(*order_cols)
    large = (items.groupBy("l_orderkey").agg(F.ceil(F.count(F.lit(1)) / P.ORDER_ITEMS).cast("long").alias("parts"))
             .where("parts > 1"))
    large = items.sparkSession.read.schema(large.schema).parquet(stage_parquet(large, scratch_path(items.sparkSession, "large-orders")))
    part = F.when(F.col("parts").isNull(), F.lit(0)).otherwise(F.expr("pmod(l_partkey * 31 + l_suppkey * 17 + l_linenumber, parts)"))
    dealt = items.join(large, "l_orderkey", "left").withColumn("part", part.cast("long"))
    spill = (F.col("l_orderkey") * (1 << 20) + F.col("part")) * 7 + 6
    numbered = dealt.withColumn("k", F.when(F.col("part") == 0, candidate_number("l_orderkey")).otherwise(spill))
    ranked = numbered.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy(*order_cols)))
    k, pk = F.col("k"), F.col("l_partkey")
    stuffer = F.pmod(k, F.lit(17)) == 0
    return _listed(ranked.select(
        "k", "rn", *order_cols,
        F.struct(
            _pick(P.SKILLS, pk).alias("name"),
            F.when(stuffer, F.lit("expert"))
             .otherwise(_pick(P.LEVELS, F.floor(pk / 7))).alias("proficiency"),
            _dbl(F.when(stuffer, F.lit(0)).otherwise(F.col("l_quantity").cast("int"))).alias("endorsements"),
            _dbl(F.pmod(F.col("l_suppkey") * 3, F.lit(60))).alias("duration_months"),
        ).alias("skill"),
    ), order_cols, "skill", "skills").select("k", "skills")


def _listed(rows: DataFrame, by: list[str], item: str, out: str) -> DataFrame:
    """Per candidate: its row of ``rn`` 1 with its items as an array, in the order ``by`` that numbered them.

    A window in the order that the rows already have; an aggregation would sort them again, one buffer a row.
    """
    whole = Window.partitionBy("k").orderBy(*by).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return rows.withColumn(out, F.collect_list(item).over(whole)).where("rn = 1")


def candidate_id(k: Column) -> Column:
    """``CAND_`` and the number, padded to seven digits; a longer number keeps all of its digits."""
    digits = k.cast("string")
    return F.concat(F.lit("CAND_"), F.when(F.length(digits) < 7, F.lpad(digits, 7, "0")).otherwise(digits))


def candidates(spark: SparkSession, sf_dir: str, signals_key: str = "signals") -> DataFrame:
    """Nested candidate records (schema ``schema.candidate_schema``)."""
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    orders = read_table(spark, sf_dir, "orders")
    lineitem = read_table(spark, sf_dir, "lineitem")

    named = customer.withColumnRenamed("c_custkey", "ck")
    known = (named.where("ck IS NOT NULL").groupBy("ck")
             .agg(F.collect_list(F.struct("c_name", "c_mktsegment")).alias("people")))     # more than one where a key repeats
    orders = orders.select("o_custkey", "o_orderkey", "o_orderdate").join(known, F.col("o_custkey") == F.col("ck"), "left").drop("ck")
    careers = career_rows(orders, "people")
    skills = skill_rows(lineitem)
    alone = named.select((F.col("ck") * 7 + 5).alias("k"), "ck").join(named, "ck", "left")

    base = (
        careers.join(skills, "k", "full_outer").select("k", "ck", "career_history", "skills", F.explode_outer("people").alias("person"))
        .select("k", "ck", "career_history", "skills", "person.*").unionByName(alone, allowMissingColumns=True)
    )
    k = F.col("k")
    career = F.coalesce(F.col("career_history"), F.array().cast(T.ArrayType(S.JOB)))
    skills_arr = F.coalesce(F.col("skills"), F.array().cast(T.ArrayType(S.SKILL)))
    total_months = F.aggregate(career, F.lit(0.0), lambda acc, j: acc + j["duration_months"])
    years = F.when(F.pmod(k, F.lit(5)) == 0, _dbl(F.pmod(k, F.lit(180))) / F.lit(10.0)) \
             .otherwise(_dbl(F.floor(total_months * 10 / 12)) / F.lit(10.0))

    def edu(offset_deg, offset_tier, offset_field, year_add):
        return F.struct(
            F.when(F.pmod(k, F.lit(43)) != 0, F.concat(F.lit("Institute "), F.pmod(k, F.lit(9)).cast("string"))).alias("institution"),
            _pick(P.DEGREES, k + offset_deg).alias("degree"),
            _pick(P.FIELDS, k + offset_field).alias("field_of_study"),
            _dbl(F.when(F.pmod(k, F.lit(53)) == 0, 1950).otherwise(1996 + F.pmod(k, F.lit(30)) + year_add)).alias("start_year"),
            _dbl(2000 + F.pmod(k, F.lit(30)) + year_add).alias("end_year"),
            F.lit(None).cast("string").alias("grade"),
            _pick(P.TIERS, k + offset_tier).alias("tier"),
        )

    education = (
        F.when(F.pmod(k, F.lit(10)) == 0, F.array().cast(T.ArrayType(S.EDUCATION)))
         .when(F.pmod(k, F.lit(2)) == 0, F.array(edu(0, 0, 0, 0)))
         .otherwise(F.array(edu(0, 0, 0, 0), edu(3, 2, 1, 3)))
    )

    first_skill = F.try_element_at(skills_arr, F.lit(1))["name"]
    assessments = (
        F.when(F.pmod(k, F.lit(7)) == 0, F.create_map().cast("map<string,double>"))
         .when(F.pmod(k, F.lit(9)) == 0, F.create_map(F.lit("Blockchain"), F.lit(50.0)))
         .when(F.size(skills_arr) > 0, F.create_map(first_skill, _dbl(F.pmod(k * 31, F.lit(101)))))
         .otherwise(F.create_map().cast("map<string,double>"))
    )
    last_active = (
        F.when(F.pmod(k, F.lit(41)) == 0, F.lit("not-a-date"))
         .when(F.pmod(k, F.lit(19)) == 0, F.lit("2022-06-01"))
         .otherwise(F.date_format(F.date_sub(F.lit("2026-06-01").cast("date"),
                                             F.pmod(k * 29, F.lit(260)).cast("int")), "yyyy-MM-dd"))
    )
    sal_base = 8 + F.pmod(k, F.lit(30))
    signals = F.struct(
        _dbl(F.pmod(k * 37, F.lit(101))).alias("profile_completeness_score"),
        F.date_format(F.date_add(F.lit("2023-01-01").cast("date"),
                                 F.pmod(k * 13, F.lit(1000)).cast("int")), "yyyy-MM-dd").alias("signup_date"),
        last_active.alias("last_active_date"),
        (F.pmod(k, F.lit(2)) == 0).alias("open_to_work_flag"),
        _dbl(F.pmod(k, F.lit(97))).alias("profile_views_received_30d"),
        _dbl(F.pmod(k, F.lit(6))).alias("applications_submitted_30d"),
        (_dbl(F.pmod(k * 7, F.lit(101))) / F.lit(100.0)).alias("recruiter_response_rate"),
        _dbl(F.pmod(k * 11, F.lit(140))).alias("avg_response_time_hours"),
        assessments.alias("skill_assessment_scores"),
        _dbl(F.pmod(k * 13, F.lit(500))).alias("connection_count"),
        _dbl(F.pmod(k * 3, F.lit(200))).alias("endorsements_received"),
        _dbl(_pick(P.NOTICE_DAYS, k)).alias("notice_period_days"),
        F.struct(
            _dbl(sal_base + F.when(F.pmod(k, F.lit(14)) == 0, 17).otherwise(0)).alias("min"),
            _dbl(sal_base + F.pmod(k, F.lit(12))).alias("max"),
        ).alias("expected_salary_range_inr_lpa"),
        _pick(P.WORK_MODES, k).alias("preferred_work_mode"),
        (F.pmod(k, F.lit(3)) == 0).alias("willing_to_relocate"),
        _dbl(F.when(F.pmod(k, F.lit(4)) == 0, -1).otherwise(F.pmod(k, F.lit(101)))).alias("github_activity_score"),
        _dbl(F.pmod(k * 17, F.lit(250))).alias("search_appearance_30d"),
        _dbl(F.pmod(k, F.lit(15))).alias("saved_by_recruiters_30d"),
        (_dbl(F.pmod(k * 3, F.lit(101))) / F.lit(100.0)).alias("interview_completion_rate"),
        F.when(F.pmod(k, F.lit(5)) == 0, F.lit(-1.0))
         .otherwise(_dbl(F.pmod(k * 9, F.lit(101))) / F.lit(100.0)).alias("offer_acceptance_rate"),
        (F.pmod(k, F.lit(3)) == 0).alias("verified_email"),
        (F.pmod(k, F.lit(4)) == 0).alias("verified_phone"),
        (F.pmod(k, F.lit(5)) == 0).alias("linkedin_connected"),
    )
    profile = F.struct(
        F.col("c_name").alias("anonymized_name"),
        _pick(P.HEADLINES, k).alias("headline"),
        _pick(P.DESCRIPTIONS, k * 5).alias("summary"),
        _pick(P.LOCATIONS, k * 3).alias("location"),
        _pick(P.COUNTRIES, k * 3).alias("country"),
        years.alias("years_of_experience"),
        _pick(P.TITLES, k).alias("current_title"),
        F.when(F.pmod(k, F.lit(11)) == 0, _pick(P.CONSULTING, k))
         .otherwise(_pick(P.COMPANIES, k)).alias("current_company"),
        _pick(P.COMPANY_SIZES, k).alias("current_company_size"),
        F.lit(None).cast("string").alias("company_size"),
        F.col("c_mktsegment").alias("current_industry"),
    )
    certifications = F.when(F.pmod(k, F.lit(8)) == 0, F.array(F.struct(
        F.lit("Cloud practitioner").alias("name"), F.when(F.pmod(k, F.lit(16)) != 0, F.lit("Board")).alias("issuer"), F.lit(2020.0).alias("year")))) \
        .otherwise(F.array().cast(T.ArrayType(S.CERTIFICATION)))
    languages = F.when(F.pmod(k, F.lit(3)) == 0, F.array(F.struct(
        F.when(F.pmod(k, F.lit(51)) != 0, F.lit("English")).alias("language"), _pick(P.LANGUAGE_LEVELS, k).alias("proficiency")))) \
        .otherwise(F.array().cast(T.ArrayType(S.LANGUAGE)))
    return base.select(
        candidate_id(k).alias("candidate_id"),
        profile.alias("profile"),
        career.alias("career_history"),
        education.alias("education"),
        skills_arr.alias("skills"),
        certifications.alias("certifications"),
        languages.alias("languages"),
        signals.alias(signals_key),
    )
