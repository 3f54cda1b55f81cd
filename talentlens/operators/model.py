"""Model training and batch scoring with Spark MLlib.

The label table is a bounded sample (``TrainConfig.max_labels``); joins with it carry no
hint, adaptive execution broadcasts it where it is small.  Folds are a column: the labelled
ids in md5 order, dealt in turn, so their sizes differ by at most one.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import TrainConfig
#: A fit runs some thousand small jobs over the labelled rows, which max_labels bounds: one partition suits them.
FIT_PARTITIONS = 1


def label_join(features: DataFrame, labels: DataFrame, label_col: str = "llm_score") -> DataFrame:
    """Inner equi-join of features and labels on candidate_id."""
    lab = labels.select("candidate_id", F.col(label_col).cast("double").alias(label_col))
    return features.join(lab, "candidate_id")


def feature_columns(df: DataFrame, prefix: str = "feat_") -> list[str]:
    """Feature selection by prefix, in frame order."""
    return [c for c in df.columns if c.startswith(prefix)]


def constant_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Columns with ≤ 1 distinct non-null value (or all null), in one min/max pass.

    Returns ``(feature, constant)`` rows.
    """
    aggs = []
    for c in cols:
        aggs += [F.min(c).cast("double").alias(f"mn__{c}"), F.max(c).cast("double").alias(f"mx__{c}")]
    wide = df.agg(*aggs)
    pairs = ", ".join(
        f"'{c}', (`mn__{c}` IS NULL OR `mn__{c}` = `mx__{c}`)" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {pairs}) as (feature, constant)")


def usable_columns(df: DataFrame, cols: list[str]) -> list[str]:
    const = {r["feature"] for r in constant_columns(df, cols).where("constant").collect()}
    return [c for c in cols if c not in const]


def bounded_labels(train: DataFrame, tc: TrainConfig = TrainConfig(), id_col: str = "candidate_id") -> DataFrame:
    """The first ``tc.max_labels`` labelled rows in md5 order: the documented bound of what a model is fitted on."""
    return train.orderBy(F.md5(F.concat(F.lit(f"{tc.fold_seed}:"), F.col(id_col))), id_col).limit(tc.max_labels)


def with_folds(train: DataFrame, n_folds: int = 5, seed: str = "42", id_col: str = "candidate_id") -> DataFrame:
    """``fold`` = place in md5 order of the (bounded) labelled ids modulo n: balanced and independent of partitions."""
    w = Window.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col))), F.col(id_col))
    ids = train.select(id_col).withColumn("fold", ((F.row_number().over(w) - 1) % n_folds).cast("int"))
    return train.join(ids, id_col)


def impute(df: DataFrame, cols: list[str]) -> DataFrame:
    """M2: NaN/NULL → -1.0 for every model input."""
    return df.select("*", *[F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(-1.0)), F.lit(-1.0)).alias(f"__x_{c}")
                            for c in cols])


def _pipeline(cols: list[str], tc: TrainConfig) -> Pipeline:
    assembler = VectorAssembler(inputCols=[f"__x_{c}" for c in cols], outputCol="features", handleInvalid="keep")
    gbt = GBTRegressor(
        featuresCol="features", labelCol=tc.label_col, predictionCol="prediction",
        maxIter=tc.max_iter, maxDepth=tc.max_depth, stepSize=tc.step_size,
        subsamplingRate=tc.subsampling_rate, featureSubsetStrategy=tc.feature_subset,
        minInstancesPerNode=tc.min_instances_per_node, seed=tc.seed,
    )
    return Pipeline(stages=[assembler, gbt])


def regression_metrics(pred: DataFrame, label_col: str = "llm_score", group: str | None = None) -> DataFrame:
    """RMSE and MAE (optionally per group) in one aggregation."""
    err = F.col("prediction") - F.col(label_col)
    aggs = [F.sqrt(F.avg(err * err)).alias("rmse"), F.avg(F.abs(err)).alias("mae"), F.count(F.lit(1)).alias("n")]
    return pred.groupBy(group).agg(*aggs) if group else pred.agg(*aggs)


def cross_validate(train: DataFrame, cols: list[str], tc: TrainConfig = TrainConfig()) -> DataFrame:
    """K fits on the folds' complements; per-fold RMSE/MAE rows (k rows, computed here)."""
    data = with_folds(impute(bounded_labels(train, tc), cols), tc.folds, tc.fold_seed).coalesce(FIT_PARTITIONS).cache()
    spark = train.sparkSession

    def one(k: int) -> tuple:
        model = _pipeline(cols, tc).fit(data.where(F.col("fold") != k))
        m = regression_metrics(model.transform(data.where(F.col("fold") == k)), tc.label_col).first()
        return k, m["rmse"], m["mae"], m["n"]

    try:                                             # the folds' many small jobs run side by side
        data.count()
        with ThreadPoolExecutor(tc.folds) as pool:
            rows = list(pool.map(inheritable_thread_target(spark)(one), range(tc.folds)))
    finally:
        data.unpersist()
    return spark.createDataFrame(rows, "fold int, rmse double, mae double, n long")


def fit(train: DataFrame, cols: list[str], tc: TrainConfig = TrainConfig()) -> PipelineModel:
    """Final fit on the labelled rows, ``tc.max_labels`` at most."""
    return _pipeline(cols, tc).fit(impute(bounded_labels(train, tc), cols).coalesce(FIT_PARTITIONS))


def importances(model: PipelineModel, cols: list[str]) -> list[tuple[str, float]]:
    """Feature importances, highest first (a list of at most #features pairs)."""
    imp = model.stages[-1].featureImportances.toArray()
    return sorted(zip(cols, [float(x) for x in imp]), key=lambda p: (-p[1], p[0]))


def calibration(pred: DataFrame, label_col: str = "llm_score") -> DataFrame:
    """Per true label: mean/min/max/count of the prediction."""
    return pred.groupBy(F.col(label_col).alias("label")).agg(
        F.avg("prediction").alias("mean_pred"), F.min("prediction").alias("min_pred"),
        F.max("prediction").alias("max_pred"), F.count(F.lit(1)).alias("n")).orderBy("label")


def check_contract(df: DataFrame, cols: list[str]) -> None:
    """M1: every model input must exist."""
    missing = sorted(set(cols) - set(df.columns))
    if missing:
        raise KeyError(f"Missing feature columns: {missing}")


def all_missing_rows(df: DataFrame, cols: list[str]) -> DataFrame:
    """M1 warning input: rows whose every model input is NULL/NaN (count)."""
    cond = None
    for c in cols:
        miss = F.col(c).isNull() | F.isnan(F.col(c).cast("double"))
        cond = miss if cond is None else cond & miss
    return df.agg(F.sum(cond.cast("long")).alias("all_missing_rows"))


def score(model: PipelineModel, df: DataFrame, cols: list[str]) -> DataFrame:
    """M2–M4: impute, predict (MLlib broadcasts the trees), normalise to [0, 1]."""
    check_contract(df, cols)
    pred = model.transform(impute(df, cols))
    keep = [c for c in df.columns]
    return pred.select(*keep, F.col("prediction").alias("raw_model_score"),
                       F.least(F.greatest(F.col("prediction") / 5.0, F.lit(0.0)), F.lit(1.0)).alias("model_score"))


def score_distribution(scored: DataFrame, col: str = "model_score") -> DataFrame:
    """M5: min/max/mean/sample std of a score column."""
    return scored.agg(F.min(col).alias("min"), F.max(col).alias("max"),
                      F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"))


def save(model: PipelineModel, path: str, cols: list[str]) -> None:
    """Persisted pipeline; the assembler keeps the column order."""
    model.write().overwrite().save(path)


def load(path: str) -> tuple[PipelineModel, list[str]]:
    """Load the pipeline and recover the ordered input columns from the assembler."""
    model = PipelineModel.load(path)
    cols = [c[len("__x_"):] for c in model.stages[0].getInputCols()]
    return model, cols
