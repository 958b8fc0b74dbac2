"""Profitability model on the registry: features, split, fit, score, AUC.

* Label: 1 iff ``profit > threshold`` (NULL profit gives 0).
* ``supplier_count``: 0 when the supplier list is NULL or blank, else the
  number of delimiter-separated fields (trailing empty fields count).
* NULL (and NaN) revenue and supplier_count become 0; profit is not filled.
* Split: by a hash of ``corporate_id`` (first four hex digits mod 10), so the
  same company always lands on the same side whatever the partitioning.
* Model: Spark ML logistic regression on ``[revenue, supplier_count]``, by
  default ``lr_max_iter`` steps of Spark ML's optimizer. ``Params.fit="irls"``
  runs iteratively reweighted least squares to convergence instead (Spark ML's
  generalized linear regression): each step is one aggregate of the normal
  equations, a 3 x 3 matrix whatever the number of rows. Its result does not
  depend on step counts, so anyone can repeat it; the default agrees with it
  when given enough steps.
* Labels that a line separates have no finite maximum: such runs are reported
  as ``separable_labels``, with the model of the last step and its AUC.
* AUC: ``BinaryClassificationEvaluator`` plus an exact rank-sum AUC computed
  with a distributed prefix sum (range partitions, per-partition offsets), as
  a cross-check that needs no single-task global sort.
"""

from __future__ import annotations

import re
import uuid
from datetime import datetime, timezone

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression, GeneralizedLinearRegressionModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from corpreg.params import Params
from corpreg.session import materialize

IRLS_MAX_ITER, IRLS_TOLERANCE = 40, 1e-9


class MissingModelError(LookupError):
    """No saved model of the wanted version or time."""


RUNS = StructType(
    [
        StructField("run_id", StringType(), False),
        StructField("model_version", StringType(), False),
        StructField("estimator_class", StringType(), False),
        StructField("max_iterations", LongType(), False),
        StructField("area_under_roc", DoubleType(), True),
        StructField("baseline_accuracy", DoubleType(), False),
        StructField("status", StringType(), False),
        StructField("train_rows", LongType(), False),
        StructField("test_rows", LongType(), False),
        StructField("model_path", StringType(), True),
        StructField("finished_at", TimestampType(), False),
    ]
)


def profit_features(registry: DataFrame, params: Params = Params()) -> DataFrame:
    label = F.when(F.col("profit") > params.profit_threshold, 1).otherwise(0)
    sup = F.col("top_suppliers")
    count = F.when(sup.isNull() | (F.trim(sup) == ""), 0).otherwise(
        F.size(F.split(sup, _regex_literal(params.supplier_delimiter)))
    )
    return (
        registry.withColumn(params.label_col, label)
        .withColumn("supplier_count", count)
        .fillna(0, subset=["revenue", "supplier_count"])
    )


def _regex_literal(s: str) -> str:
    """The delimiter as a regex matching it literally (``split`` takes a regex)."""
    return re.escape(s)


def split_column(params: Params = Params()):
    """'train' / 'test' by a hash of the whole id: its MD5, of which the first
    52 bits are compared with ``train_fraction`` of their range (a double holds
    52 bits exactly, so any fraction is met as it is given)."""
    drawn = F.conv(F.substring(F.md5(F.col("corporate_id")), 1, 13), 16, 10).cast("double")
    return F.when(drawn < F.lit(params.train_fraction * 16.0**13), "train").otherwise("test")


def with_split(df: DataFrame, params: Params = Params()) -> DataFrame:
    return df.withColumn("split", split_column(params))


def train_test_split(df: DataFrame, params: Params = Params()) -> tuple[DataFrame, DataFrame]:
    s = split_column(params)
    return df.where(s == "train"), df.where(s == "test")


def random_split(df: DataFrame, params: Params = Params()) -> tuple[DataFrame, DataFrame]:
    """Sampling split as in ``randomSplit`` (depends on partitioning)."""
    a, b = df.randomSplit([params.train_fraction, 1 - params.train_fraction], seed=params.split_seed)
    return a, b


def assembler(params: Params = Params()) -> VectorAssembler:
    return VectorAssembler(inputCols=list(params.feature_cols), outputCol="features")


def profit_vectors(features: DataFrame, params: Params = Params()) -> DataFrame:
    return assembler(params).transform(features)


def profit_pipeline(params: Params = Params()) -> Pipeline:
    if params.fit == "irls":
        model = GeneralizedLinearRegression(
            featuresCol="features", labelCol=params.label_col, family="binomial", link="logit", linkPredictionCol="score",
            maxIter=IRLS_MAX_ITER, tol=IRLS_TOLERANCE,
        )
    elif params.fit == "logistic":
        model = LogisticRegression(featuresCol="features", labelCol=params.label_col, maxIter=params.lr_max_iter)
    else:
        raise ValueError(f"unknown fit {params.fit!r}")
    return Pipeline(stages=[assembler(params), model])


def fit_profit_model(train: DataFrame, params: Params = Params()) -> PipelineModel:
    return profit_pipeline(params).fit(train)


def model_summary(model: PipelineModel, train_rows: int) -> dict:
    lr = model.stages[-1]
    coef = lr.coefficients.toArray().tolist()
    return {
        "intercept": float(lr.intercept),
        "coefficients": [float(c) for c in coef],
        "train_rows": int(train_rows),
    }


def score(model: PipelineModel, test: DataFrame, params: Params = Params()) -> DataFrame:
    """``test`` with ``probability_1``, ``score`` (log-odds) and ``prediction`` (0 or 1)."""
    pred = model.transform(test)
    if isinstance(model.stages[-1], GeneralizedLinearRegressionModel):
        return pred.withColumn("probability_1", F.col("prediction")).withColumn(
            "prediction", F.when(F.col("score") > 0, 1.0).otherwise(0.0)
        )
    return pred.withColumn("probability_1", vector_to_array("probability")[1]).withColumn(
        "score", vector_to_array("rawPrediction")[1]
    )


def separates(scored: DataFrame, params: Params = Params()) -> bool:
    """Whether every positive scores above every negative."""
    own = lambda y: F.when(F.col(params.label_col) == y, F.col("score"))
    row = scored.agg(F.min(own(1)).alias("low"), F.max(own(0)).alias("high")).first()
    return row["low"] is not None and row["high"] is not None and row["low"] > row["high"]


def evaluator_auc(predictions: DataFrame, params: Params = Params()) -> float:
    raw = "rawPrediction" if "rawPrediction" in predictions.columns else "score"
    ev = BinaryClassificationEvaluator(
        rawPredictionCol=raw, labelCol=params.label_col, metricName="areaUnderROC"
    )
    return float(ev.evaluate(predictions))


def rank_sum_auc(scored: DataFrame, label_col: str, score_col: str = "score") -> DataFrame:
    """Exact ROC AUC (ties count one half) as a one-row DataFrame.

    AUC = sum over scores s of pos(s) * (neg below s + neg(s) / 2) / (P * N).
    "neg below s" is a prefix sum over the sorted distinct scores, computed
    without a global single-task window: distinct scores are range
    partitioned, each partition sums its negatives, the small per-partition
    totals give each partition's offset, and a window inside each partition
    finishes the prefix.
    """
    per_score = scored.groupBy(F.col(score_col).alias("s")).agg(
        F.sum(F.when(F.col(label_col) == 1, 1).otherwise(0)).cast("double").alias("pos"),
        F.sum(F.when(F.col(label_col) == 1, 0).otherwise(1)).cast("double").alias("neg"),
    )
    # written once: both branches below must see the same partition ids
    ranged = materialize(per_score.repartitionByRange("s").withColumn("pid", F.spark_partition_id()), "auc")
    totals = ranged.groupBy("pid").agg(F.sum("neg").alias("part_neg"))
    offsets = totals.withColumn(
        "offset",
        F.coalesce(
            F.sum("part_neg").over(Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)
        ),
    ).select("pid", "offset")
    within = Window.partitionBy("pid").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    # offsets has one row per partition: a bounded broadcast
    prefixed = ranged.join(F.broadcast(offsets), "pid").withColumn(
        "neg_below", F.col("offset") + F.coalesce(F.sum("neg").over(within), F.lit(0.0))
    )
    agg = prefixed.agg(
        F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2)).alias("u"),
        F.sum("pos").alias("p"),
        F.sum("neg").alias("n"),
    )
    return agg.select(
        F.when((F.col("p") > 0) & (F.col("n") > 0), F.col("u") / (F.col("p") * F.col("n"))).alias("auc_rank"),
        F.col("p").cast("bigint").alias("positives"),
        F.col("n").cast("bigint").alias("negatives"),
    )


def run_training(
    registry: DataFrame,
    params: Params = Params(),
    model_path: str | None = None,
    runs_path: str | None = None,
) -> dict:
    """Whole training run. Returns ``{version, accuracy, baseline, status, ...}``.

    Empty registry: version ``N/A``, accuracy 0.0. One-class labels: no fit,
    accuracy None and status ``degenerate_labels``. The AUC is always the
    measured one.
    """
    spark = registry.sparkSession
    feats = profit_features(registry, params).persist()
    try:
        train, test = train_test_split(feats, params)
        counts = {
            r["split"]: (r["n"], r["labels"])
            for r in with_split(feats, params)
            .groupBy("split")
            .agg(F.count(F.lit(1)).alias("n"), F.collect_set(params.label_col).alias("labels"))
            .collect()
        }
        n_train, train_labels = counts.get("train", (0, []))
        n_test, _ = counts.get("test", (0, []))
        run_id = uuid.uuid4().hex
        result = {
            "run_id": run_id,
            "version": "N/A",
            "accuracy": 0.0,
            "baseline": params.baseline_accuracy,
            "status": "empty_registry",
            "train_rows": int(n_train),
            "test_rows": int(n_test),
            "model_path": None,
        }
        if n_train + n_test == 0:
            pass
        elif len(set(train_labels)) < 2 or n_test == 0:
            result.update(status="degenerate_labels", accuracy=None, version=f"v_run_{run_id[:8]}")
        else:
            model = fit_profit_model(train, params)
            auc = evaluator_auc(score(model, test, params), params)
            status = "separable_labels" if separates(score(model, train, params), params) else "ok"
            result.update(status=status, accuracy=auc, version=f"v_run_{run_id[:8]}")
            result.update(model_summary(model, n_train))
            if model_path:
                model.write().overwrite().save(model_path)
                result["model_path"] = model_path
        if runs_path:
            training_runs_row(spark, result, params).coalesce(1).write.mode("append").parquet(runs_path)
        return result
    finally:
        feats.unpersist()


def training_runs_row(spark, result: dict, params: Params = Params()) -> DataFrame:
    row = (
        result["run_id"],
        result["version"],
        "GeneralizedLinearRegression" if params.fit == "irls" else "LogisticRegression",
        IRLS_MAX_ITER if params.fit == "irls" else int(params.lr_max_iter),
        None if result["accuracy"] is None else float(result["accuracy"]),
        float(params.baseline_accuracy),
        result["status"],
        int(result["train_rows"]),
        int(result["test_rows"]),
        result.get("model_path"),
        datetime.now(timezone.utc).replace(tzinfo=None),
    )
    return spark.createDataFrame([row], RUNS)


def load_profit_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def model_run(runs: DataFrame, version: str | None = None, at: datetime | None = None) -> dict:
    """The newest run of the runs table that saved a model: of ``version``, or
    finished no later than ``at``, or of all. Raises :class:`MissingModelError`."""
    found = runs.where(F.col("model_path").isNotNull())
    if version is not None:
        found = found.where(F.col("model_version") == version)
    if at is not None:
        found = found.where(F.col("finished_at") <= F.lit(at))
    row = found.orderBy(F.desc("finished_at"), F.desc("run_id")).first()
    if row is None:
        wanted = f"version {version}" if version is not None else f"a time up to {at}" if at is not None else "any version"
        raise MissingModelError(f"the runs table holds no saved model for {wanted}")
    return row.asDict()


def score_saved(
    features: DataFrame, runs: DataFrame, params: Params = Params(), version: str | None = None, at: datetime | None = None
) -> DataFrame:
    """``features`` scored by a saved model (see :func:`model_run`), with its ``model_version``."""
    run = model_run(runs, version, at)
    return score(load_profit_model(run["model_path"]), features, params).withColumn("model_version", F.lit(run["model_version"]))


__all__ = [
    "IRLS_MAX_ITER",
    "RUNS",
    "MissingModelError",
    "evaluator_auc",
    "fit_profit_model",
    "load_profit_model",
    "model_run",
    "model_summary",
    "profit_features",
    "profit_pipeline",
    "profit_vectors",
    "random_split",
    "rank_sum_auc",
    "run_training",
    "score",
    "score_saved",
    "separates",
    "split_column",
    "train_test_split",
    "training_runs_row",
    "with_split",
]
