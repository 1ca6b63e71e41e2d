"""Gradient-boosted regression of the surge multiplier with Spark ML.

Training rows are the feature table with the noise-free label formula as
target.  The split is a hash of the row key, so it does not depend on how
the data is partitioned; medians for imputation and the scaler are fitted
on the training side only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonefare.config import DEFAULT, FEATURE_COLUMNS, PricingConfig
from zonefare.functions.features import clip_prediction, confidence
from zonefare.sources.tables import is_folder

LABEL = "actual_multiplier"


def to_training_frame(features: DataFrame, label) -> DataFrame:
    """Features as doubles (booleans to 0/1) in model order, label
    defaulting to 1.0 when null."""
    cols = [F.col(c).cast("double").alias(c) for c in FEATURE_COLUMNS]
    return features.select("zone_id", "city", "timestamp", *cols,
                           F.coalesce(label, F.lit(1.0)).alias(LABEL))


def split(df: DataFrame, train_pct: int = 80, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    h = F.pmod(F.xxhash64(F.lit(seed), "zone_id", "timestamp"), F.lit(100))
    return df.filter(h < train_pct), df.filter(h >= train_pct)


def portable_split(zone, timestamp, train_pct: int = 80, seed: int = 42):
    """Whether a row is on the training side: md5 of seed, zone and epoch second, which any SQL engine computes alike."""
    text = F.concat_ws(":", F.lit(str(seed)), zone, F.unix_seconds(timestamp).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % 100 < train_pct


def build_pipeline(cfg: PricingConfig = DEFAULT, max_iter: int | None = None) -> Pipeline:
    imputed = [f"{c}_imp" for c in FEATURE_COLUMNS]
    return Pipeline(stages=[
        Imputer(strategy="median", inputCols=list(FEATURE_COLUMNS), outputCols=imputed),
        VectorAssembler(inputCols=imputed, outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
        GBTRegressor(featuresCol="features", labelCol=LABEL, predictionCol="prediction",
                     maxIter=max_iter or cfg.gbt_max_iter, maxDepth=cfg.gbt_max_depth,
                     stepSize=cfg.gbt_step_size, subsamplingRate=cfg.gbt_subsampling_rate,
                     featureSubsetStrategy=cfg.gbt_feature_subset,
                     minInstancesPerNode=cfg.gbt_min_instances_per_node, seed=cfg.seed),
    ])


@dataclass
class Trained:
    model: PipelineModel
    train_rows: int
    test: DataFrame


def train(frame: DataFrame, cfg: PricingConfig = DEFAULT, max_iter: int | None = None,
          min_rows: int | None = None) -> Trained:
    """Fit the pipeline on the training split.

    The booster makes one pass per tree, so the training rows are
    checkpointed into the session's shared checkpoint folder first: the
    feature lineage is cut, and a lost executor re-reads the checkpoint
    instead of recomputing rides, history and baselines.
    """
    from zonefare.session import checkpoint_dir
    checkpoint_dir(frame.sparkSession)
    tr, te = split(frame, 80, cfg.seed)
    tr = tr.checkpoint(eager=True)
    n = tr.count()
    need = cfg.training_min_samples if min_rows is None else min_rows
    if n < need:
        raise ValueError(f"only {n} training rows, need at least {need}")
    model = build_pipeline(cfg, max_iter).fit(tr)
    return Trained(model, n, te)


def metrics(model: PipelineModel, test: DataFrame, cfg: PricingConfig = DEFAULT) -> DataFrame:
    """MAE and R2 of the clipped prediction on the test rows (one row)."""
    return error_metrics(model.transform(test), cfg)


def error_metrics(predicted: DataFrame, cfg: PricingConfig = DEFAULT) -> DataFrame:
    """MAE and R2 of a clipped `prediction` against the label (one row)."""
    p = predicted.withColumn(
        "p", F.least(F.greatest(F.col("prediction"), F.lit(1.0)), F.lit(cfg.multiplier_max)))
    y, yhat = F.col(LABEL), F.col("p")
    stats = p.agg(F.count(F.lit(1)).alias("test_rows"),
                  F.avg(F.abs(y - yhat)).alias("mae"),
                  F.sum((y - yhat) ** 2).alias("sse"),
                  (F.sum(y * y) - F.sum(y) * F.sum(y) / F.count(F.lit(1))).alias("sst"))
    return stats.select("test_rows", F.round("mae", 4).alias("mae"),
                        F.round(F.lit(1.0) - F.col("sse") / F.col("sst"), 4).alias("r2"))


def importances(spark: SparkSession, model: PipelineModel, top: int = 5) -> DataFrame:
    """Feature importances of the booster, highest first."""
    imp = model.stages[-1].featureImportances.toArray().tolist()
    df = spark.createDataFrame(list(zip(FEATURE_COLUMNS, map(float, imp))),
                               "feature string, importance double")
    return df.orderBy(F.desc("importance"), "feature").limit(top)


def score(model: PipelineModel, features: DataFrame, cfg: PricingConfig = DEFAULT) -> DataFrame:
    """Model prediction per feature row, clipped to [1, max] and rounded."""
    frame = to_training_frame(features, F.lit(None).cast("double"))
    p = model.transform(frame).select("zone_id", "city", "timestamp", "prediction")
    return p.withColumn("ml_prediction", clip_prediction(F.col("prediction"), cfg))


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_or_none(spark: SparkSession, path: str) -> PipelineModel | None:
    """The saved model, or None if there is none at the path; a damaged model is an error."""
    return PipelineModel.load(path) if is_folder(spark, path) else None


def predict_or_fallback(model: PipelineModel | None, features: DataFrame,
                        cfg: PricingConfig = DEFAULT) -> DataFrame:
    """ml_prediction, ml_confidence and ml_available per feature row.  Without a
    model every row gets (1.0, 0.0, false): the confidence of zero keeps the
    prediction from overriding the rule price."""
    keys = ("zone_id", "city", "timestamp")
    if model is None:
        return features.select(*keys, F.lit(1.0).alias("ml_prediction"), F.lit(0.0).alias("ml_confidence"),
                               F.lit(False).alias("ml_available"))
    p = model.transform(to_training_frame(features, F.lit(None).cast("double")))
    ml = clip_prediction(F.col("prediction"), cfg)
    return p.select(*keys, ml.alias("ml_prediction"),
                    confidence(F.col("demand_last_1min"), F.col("historical_avg_demand"), ml).alias("ml_confidence"),
                    F.lit(True).alias("ml_available"))
