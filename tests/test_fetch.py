"""Fetches by id read few row groups of a staged table."""
import json

import pytest
from conftest import base_record
from pyspark.sql import functions as F

from talentlens.sources import files as FS


def rows_read(df):
    """Rows that the scan of an executed plan handed on, before any filter of Spark's own."""
    df.collect()
    plan, total = df._jdf.queryExecution().executedPlan(), 0
    leaves = plan.collectLeaves()
    for i in range(leaves.size()):
        total += leaves.apply(i).metrics().apply("numOutputRows").value()
    return total


@pytest.fixture(scope="module")
def staged(spark):
    rows = spark.range(60_000).select(F.concat(F.lit("CAND_"), F.lpad(F.pmod(F.col("id") * 7919, F.lit(60_000)).cast("string"), 7, "0")).alias("candidate_id"),
                                      F.sha2(F.col("id").cast("string"), 256).alias("value")).coalesce(1)      # ids in no order
    path = FS.scratch_path(spark, "fetch")
    FS.bloom(rows.write.option("parquet.block.size", 200_000).option("parquet.page.size", 50_000), "candidate_id").parquet(path)
    return spark.read.parquet(path)


def ids(spark, *numbers):
    return spark.createDataFrame([(None if n is None else f"CAND_{n:07d}",) for n in numbers], "candidate_id string")


def test_a_small_id_set_reads_few_rows(spark, staged):
    wanted = ids(spark, 5, 31_000, 31_000, 99_999, None)
    got = FS.fetch_by_ids(staged, wanted)
    assert sorted(r.candidate_id for r in got.collect()) == ["CAND_0000005", "CAND_0031000"]
    assert rows_read(got) < 60_000 / 4
    assert rows_read(FS.fetch_by_ids(staged, ids(spark, *range(100_000, 100_030)))) < 60_000 / 4          # ids inside every group's range, but in none


def test_any_number_of_ids(spark, staged, monkeypatch):
    assert FS.fetch_by_ids(staged, ids(spark)).count() == FS.fetch_by_ids(staged, ids(spark, None)).count() == 0
    many = ids(spark, *range(0, 1_000, 2))
    expected = sorted(map(tuple, FS.records_by_ids(staged, many).collect()))
    assert len(expected) == 500 and sorted(map(tuple, FS.fetch_by_ids(staged, many).collect())) == expected
    monkeypatch.setattr(FS, "FETCH_IDS", 100)
    assert sorted(map(tuple, FS.fetch_by_ids(staged, many).collect())) == expected


def test_staged_candidates_have_the_filter_and_push_the_ids_down(spark, tmp_path):
    (tmp_path / "c.jsonl").write_text("\n".join(json.dumps(base_record(i)) for i in range(1, 40)), encoding="utf-8")
    out = FS.scratch_path(spark, "staged")
    good, _ = FS.stage_candidates(spark, str(tmp_path / "c.jsonl"), out=out, keep_text=True)
    got = FS.fetch_by_ids(good.select("candidate_id", "value"), ids(spark, 3, 4, 777))
    assert [r.candidate_id for r in got.orderBy("candidate_id").collect()] == ["CAND_0000003", "CAND_0000004"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "In(r.candidate_id" in plan.replace("`", "")
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(next(iter(good.inputFiles())))
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(path, spark._jsc.hadoopConfiguration()))
    try:
        columns = reader.getFooter().getBlocks().get(0).getColumns()
        offsets = {columns.get(i).getPath().toDotString(): columns.get(i).getBloomFilterOffset() for i in range(columns.size())}
    finally:
        reader.close()
    assert offsets["r.candidate_id"] > 0 and offsets["value"] <= 0
