import pytest
from pyspark.sql import functions as F

from talentlens.operators import explain, ranking

MOCK = {
    "profile_current_title": "Senior ML Engineer", "profile_years_of_exp": 7.2,
    "profile_current_company": "Flipkart", "feat_dim6_has_product_exp": 1,
    "career_all_companies": "Flipkart|TCS", "feat_dim3_retrieval_desc_count": 4,
    "feat_dim2_production_kw_count": 5, "sig_response_rate": 0.88, "sig_notice_period_days": 30,
    "feat_dim7_is_india": 1, "feat_dim6_consulting_only": 0, "profile_country": "India",
}
SCHEMA = ("profile_current_title string, profile_years_of_exp double, profile_current_company string, "
          "feat_dim6_has_product_exp long, career_all_companies string, feat_dim3_retrieval_desc_count long, "
          "feat_dim2_production_kw_count long, sig_response_rate double, sig_notice_period_days int, "
          "feat_dim7_is_india long, feat_dim6_consulting_only long, profile_country string, rank int")


def reason(spark, row, rank):
    vals = dict(row, rank=rank)
    df = spark.createDataFrame([tuple(vals[c.split()[0]] for c in SCHEMA.split(", "))], SCHEMA)
    return df.select(explain.reasoning().alias("r")).collect()[0].r


def test_golden_rank_1(spark):
    assert reason(spark, MOCK, 1) == (
        "Senior ML Engineer with 7.2 years experience including product company experience at Flipkart; "
        "career demonstrates hands-on ranking/retrieval system deployment; 88% recruiter response rate; "
        "30-day notice period.")


def test_golden_rank_95(spark):
    row = dict(MOCK, feat_dim2_production_kw_count=0, sig_response_rate=0.15)
    assert reason(spark, row, 95) == (
        "Senior ML Engineer with 7.2 years experience including product company experience at Flipkart; "
        "has relevant search and retrieval experience; low recruiter response rate (15%); 30-day notice period. "
        "Notable gap: no evidence of production ML deployment in career history.")


def test_minor_concern_and_consulting(spark):
    row = dict(MOCK, feat_dim6_has_product_exp=0, feat_dim6_consulting_only=1, feat_dim7_is_india=0,
               profile_country="Singapore", sig_notice_period_days=120, sig_response_rate=0.5)
    r = reason(spark, row, 3)
    assert "currently at Flipkart (consulting)" in r
    assert r.endswith("Minor concern: located outside India (Singapore).")
    assert "extended 120-day notice period" in r


@pytest.mark.parametrize("extra,expect_len", [(0, None), (400, 300)])
def test_truncation(spark, extra, expect_len):
    row = dict(MOCK, profile_current_title="T" * (10 + extra))
    r = reason(spark, row, 1)
    if expect_len:
        assert len(r) == 300 and r.endswith("...")
    else:
        assert len(r) <= 300 and not r.endswith("...")


def test_half_even_formatting(spark):
    assert reason(spark, dict(MOCK, profile_years_of_exp=0.25), 1).startswith("Senior ML Engineer with 0.2 years")
    assert reason(spark, dict(MOCK, profile_years_of_exp=0.35), 1).startswith("Senior ML Engineer with 0.3 years")


def _scores(spark, rows):
    return spark.createDataFrame(rows, "candidate_id string, final_score double")


def test_topk_ties_nan_and_short_input(spark):
    df = _scores(spark, [("CAND_0000003", 0.5), ("CAND_0000001", 0.5), ("CAND_0000002", float("nan")),
                         ("CAND_0000004", 0.9)])
    out = ranking.assign_rank(ranking.top_k(df, 10)).orderBy("rank").collect()
    assert [r.candidate_id for r in out] == ["CAND_0000004", "CAND_0000001", "CAND_0000003", "CAND_0000002"]
    assert [r.rank for r in out] == [1, 2, 3, 4]


def test_final_score_rounding_half_even(spark):
    df = spark.createDataFrame([(0.00125, 1.0, False, 0.0)], "model_score double, behavioral_score double, "
                                                             "is_honeypot boolean, suspicion_score double")
    assert df.select(ranking.final_score().alias("s")).collect()[0].s == 0.0012


def test_monotone_repair(spark):
    df = spark.createDataFrame([(1, 0.9), (2, 0.95), (3, 0.5)], "rank int, score double")
    assert [r.score for r in ranking.monotone(df).orderBy("rank").collect()] == [0.9, 0.9, 0.5]


def test_rank_plan_is_take_ordered_without_python(spark):
    from conftest import SF001
    from talentlens.plans.pipeline import rank_pipeline
    plan = rank_pipeline(spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan and "PythonUDF" not in plan


def test_partition_invariance(spark):
    from conftest import SF001
    from talentlens.plans import pipeline as PL
    flat = PL.flat_candidates(spark, SF001)
    a = PL.rank_candidates(PL.score_candidates(flat.repartition(1))).collect()
    b = PL.rank_candidates(PL.score_candidates(flat.repartition(8, "candidate_id"))).collect()
    assert a == b and len(a) == 100


def test_fixture_uses_every_order_and_line_item(spark):
    from conftest import SF001
    from pyspark.sql import functions as F
    from talentlens.session import read_table
    from talentlens.sources import bridge
    c = bridge.candidates(spark, SF001)
    jobs, skills, n, ids, most = c.agg(F.sum(F.size("career_history")), F.sum(F.size("skills")), F.count(F.lit(1)), F.countDistinct("candidate_id"),
                                       F.max(F.size("career_history"))).first()
    assert jobs == read_table(spark, SF001, "orders").count()
    assert skills == read_table(spark, SF001, "lineitem").count()
    assert n == ids and most == 11


def test_fixture_splits_hot_customers_and_hot_orders(spark, tmp_path):
    """A customer with a third of all orders and an order with a third of all items fill many candidates."""
    from conftest import SF001
    from pyspark.sql import functions as F
    from talentlens.session import read_table
    from talentlens.sources import bridge, fixture_pools as P
    orders = read_table(spark, SF001, "orders")
    items = read_table(spark, SF001, "lineitem")
    orders.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(1).cast(orders.schema["o_custkey"].dataType)).otherwise(F.col("o_custkey"))) \
        .write.parquet(f"{tmp_path}/orders.parquet")
    items.withColumn("l_orderkey", F.when(F.col("l_partkey") % 3 == 0, F.lit(7).cast(items.schema["l_orderkey"].dataType)).otherwise(F.col("l_orderkey"))) \
        .write.parquet(f"{tmp_path}/lineitem.parquet")
    read_table(spark, SF001, "customer").write.parquet(f"{tmp_path}/customer.parquet")
    c = bridge.candidates(spark, str(tmp_path))
    jobs, skills, most_jobs, most_skills = c.agg(F.sum(F.size("career_history")), F.sum(F.size("skills")), F.max(F.size("career_history")), F.max(F.size("skills"))).first()
    assert (jobs, skills) == (orders.count(), items.count())
    assert most_jobs == 11 and most_skills < 6 * P.ORDER_ITEMS
    assert c.select("candidate_id").distinct().count() == c.count()


def test_fixture_moves_no_assembled_record(spark):
    """Jobs, skills and names are shuffled as narrow rows; lists and records stay in the task that puts them together."""
    import re
    from conftest import SF001
    from talentlens.sources import bridge
    plan = bridge.candidates(spark, SF001)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    moved = re.findall(r"\) (?:Exchange|Sort)\nInput \[\d+\]: \[(.*)\]", plan)
    assert moved and not [m for m in moved if re.search(r"career_history|skills|job#|skill#", m)]
    assert "RoundRobin" not in plan and not re.search(r"collect_list\((?:struct\(rn|job|skill)[^\n]*Aggregate", plan)


def test_fixture_joins_every_customer_of_a_key(spark, tmp_path):
    """Repeated customer keys give a candidate for each name, orders without a customer one without a name."""
    import datetime
    at = datetime.datetime(2020, 1, 1)
    from talentlens.sources import bridge
    spark.createDataFrame([(1, "a", "X"), (1, "b", "Y"), (2, "c", "Z")], "c_custkey long, c_name string, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(0, 1, at), (1, 2, at), (2, None, at), (3, 9, at)], "o_orderkey long, o_custkey long, o_orderdate timestamp").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(0, 1, 5, 1, 1.0, 1.0), (0, 2, 4, 1, 1.0, 1.0), (24, 1, 3, 1, 1.0, 1.0)],
                          "l_orderkey long, l_linenumber long, l_partkey long, l_suppkey long, l_extendedprice double, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = sorted((r.candidate_id, r.profile.anonymized_name or "", len(r.career_history), len(r.skills)) for r in bridge.candidates(spark, str(tmp_path)).collect())
    # keys 0 / 1, 2 / 3 go to the numbers 0, 1 and 2, key 24 to 8; customers 1 and 2 alone are 12 (each name twice) and 19
    assert got == [("CAND_0000000", "a", 1, 2), ("CAND_0000000", "b", 1, 2), ("CAND_0000001", "c", 2, 0), ("CAND_0000002", "", 1, 0), ("CAND_0000008", "", 0, 1),
                   *[("CAND_0000012", n, 0, 0) for n in "aabb"], ("CAND_0000019", "c", 0, 0)]


def test_long_candidate_numbers_keep_their_digits(spark):
    from pyspark.sql import functions as F
    from talentlens.sources import bridge
    ids = [r[0] for r in spark.createDataFrame([(7,), (12345678,), (12345679,)], "k long").select(bridge.candidate_id(F.col("k"))).collect()]
    assert ids == ["CAND_0000007", "CAND_12345678", "CAND_12345679"]


def test_topk_carries_only_explanation_inputs(spark):
    """Column pruning keeps the top-k funnel narrow (k rows per task × these columns)."""
    import re
    from conftest import SF001
    from talentlens.plans.pipeline import rank_pipeline
    df = rank_pipeline(spark, SF001)
    s = df._jdf.queryExecution().explainString(
        df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    m = re.search(r"TakeOrderedAndProject\nInput \[(\d+)\]", s)
    assert m and int(m.group(1)) <= 16
