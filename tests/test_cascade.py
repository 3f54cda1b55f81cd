"""Cascade sampling from counts: the same sample as the plain cascade, whatever fits the driver."""
import hashlib
import random

import pytest

from talentlens.operators import cascade

SCHEMA = "candidate_id string, key string, mask int"


def plain(rows, buckets, target):
    quota, carry, picked = target // buckets, 0, {}
    for b in range(buckets):
        limit = quota + carry
        own = [i for _, i, m in sorted((k, i, m) for i, k, m in rows) if m >> b & 1 and i not in picked][:max(limit, 0)]
        picked |= dict.fromkeys(own, b)
        carry = limit - len(own)
    return picked


@pytest.mark.parametrize("leaf,digits,target", [(10_000, 3, 60), (4, 1, 60), (4, 1, 0), (4, 1, 5), (30, 2, 299), (4, 1, 10_000), (1, 1, 3)])
def test_cut_offs_take_what_the_plain_cascade_takes(spark, monkeypatch, leaf, digits, target):
    monkeypatch.setattr(cascade, "LEAF", leaf)
    monkeypatch.setattr(cascade, "DIGITS", digits)
    rng = random.Random(leaf * target + digits)
    rows = [(f"c{i}", hashlib.md5(f"{i % 190}".encode()).hexdigest(), rng.choice([1, 2, 3, 4, 8, 9, 12, 15, 0])) for i in range(200)]     # some keys tie
    df = spark.createDataFrame(rows, SCHEMA).coalesce(2)
    counts = cascade.KeyCounts(df)
    cuts = cascade.cut_offs(counts, 4, target)
    got = df.select("candidate_id", cascade.bucket_of(cuts, ("0", "1", "2", "3")).alias("b")).where("b IS NOT NULL").collect()
    assert {r.candidate_id: int(r.b) for r in got} == plain(rows, 4, target)
    assert all(len(x) <= max(leaf, 2) for p, x in counts._leaves.items() if len(p) + digits <= cascade.KEY_LENGTH)


def test_an_empty_table_and_a_repeated_id(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert cascade.cut_offs(cascade.KeyCounts(empty), 4, 10) == [None] * 4
    same = spark.createDataFrame([("a", "0" * 32, 1)] * 50 + [("b", "f" * 32, 1)], SCHEMA)
    assert cascade.cut_offs(cascade.KeyCounts(same), 1, 10) == [("0" * 32, "a")]


def test_only_sampled_rows_get_all_features_for_their_labels(spark, monkeypatch):
    from conftest import SF001
    from talentlens.plans import more_queries as Q
    seen, real = [], Q.PL.score_candidates
    monkeypatch.setattr(Q, "SAMPLE_TOTAL", 60)
    s = Q.scored(spark, SF001)
    monkeypatch.setattr(Q.PL, "score_candidates", lambda flat, *a, **k: seen.append(flat) or real(flat, *a, **k))
    got = Q.labelled_sample(spark, SF001)
    comp = Q.labeling.rubric_components()
    plain = s.join(Q.sample_frame(spark, SF001), "candidate_id").withColumn("rubric_base", comp["rubric_base"]).withColumn("llm_score", comp["llm_score"])
    assert seen[1].count() == 60 < s.count()               # the first call scores for the masks of the sample
    assert got.columns == plain.columns and sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
