"""Random-forest forecast model (ML5-ML8)."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.functions import constants as K
from airshed.ml import forest
from airshed.ml.dataset import SAMPLE_KEY, checked, split
from airshed.session import checkpoint_dir

# MLlib caps tree depth at 30; the upstream forest grows unlimited depth, bounded in
# practice by the minimum leaf size.
MAX_DEPTH = 30
# Statistics of the nodes that one pass over the data splits. Each task of the pass holds as much, so an
# executor holds this times its cores; the splits found do not depend on it.
NODE_STATS_MB = 256


def build_pipeline(num_trees: int = K.RF_TREES, max_depth: int = MAX_DEPTH,
                   seed: int = K.RF_SEED) -> Pipeline:
    """ML5 as an MLlib pipeline: features in the fixed order -> RF(140 trees, min leaf 5, 50 % rows, all
    features). ``train`` grows the same kind of forest with ``airshed.ml.forest``, as MLlib keeps all nodes on the
    driver and broadcasts them to every executor; the tests hold one against the other."""
    assembler = VectorAssembler(inputCols=K.FEATURE_ORDER, outputCol="features",
                                handleInvalid="error")
    rf = RandomForestRegressor(featuresCol="features", labelCol="aqi_target",
                               predictionCol="prediction", numTrees=num_trees,
                               maxDepth=max_depth, minInstancesPerNode=K.RF_MIN_LEAF,
                               subsamplingRate=K.RF_SUBSAMPLE, featureSubsetStrategy="all",
                               seed=seed,
                               # deep trees: keep node ids cached (checkpointed every 10
                               # levels); every running task holds node statistics of this size
                               cacheNodeIds=True, checkpointInterval=10, maxMemoryInMB=NODE_STATS_MB)
    return Pipeline(stages=[assembler, rf])


def _as_features(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in K.FEATURE_ORDER})


@dataclass
class Trained:
    model: forest.Forest
    n_samples: int
    n_stations: int
    mae: float
    r2: float
    first_time: str | None = None  # of the samples' hours, UTC
    last_time: str | None = None
    trained_at: str | None = None


def evaluate(predictions: DataFrame, label: str = "aqi_target") -> tuple[float, float]:
    """ML6: MAE and R2 in one aggregate (R2 is NaN for fewer than two different targets)."""
    y, e = F.col(label).cast("double"), F.col("prediction") - F.col(label)
    mae, mse, var = predictions.agg(F.avg(F.abs(e)), F.avg(e * e), F.var_pop(y)).first()
    if mae is None:
        return float("nan"), float("nan")
    return float(mae), float(1 - mse / var) if var else float("nan")


def train(samples: DataFrame, num_trees: int = K.RF_TREES, max_depth: int = MAX_DEPTH,
          split_keys=SAMPLE_KEY) -> Trained:
    """ML3-ML7: gate, split, fit, evaluate on the hold-out."""
    checkpoint_dir(samples.sparkSession)
    # The sample join feeds the size gate, the fit and the evaluation: it is materialised once in the
    # shared checkpoint folder.
    samples = samples.checkpoint(eager=True)
    hour = F.date_format(F.col("time").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    n, stations, first, last = samples.agg(F.count("*"), F.count_distinct("station"), F.min(hour),
                                           F.max(hour)).first()
    checked(n)
    train_df, test_df = split(samples, keys=split_keys)
    model = forest.fit(_as_features(train_df), "aqi_target", K.FEATURE_ORDER, num_trees, max_depth, K.RF_MIN_LEAF,
                       K.RF_SUBSAMPLE, K.RF_SEED)
    mae, r2 = evaluate(model.transform(_as_features(test_df)))
    return Trained(model, n, stations, mae, r2, first, last, datetime.now(timezone.utc).isoformat())


def metrics_frame(spark: SparkSession, t: Trained) -> DataFrame:
    """ML7: one-row metadata document."""
    weights = t.model.importances
    found = {f: round(float(v), 4) for f, v in zip(K.FEATURE_ORDER, weights, strict=True)}
    return spark.createDataFrame(
        [(t.trained_at, t.first_time, t.last_time, t.n_samples, t.n_stations, round(t.mae, 3), round(t.r2, 4),
          "RandomForestRegressor", "forecast", "us_aqi (at t + horizon_h)", list(K.FEATURE_ORDER),
          list(K.HORIZONS), found)],
        "trained_at string, first_time string, last_time string, n_samples long, n_stations long, mae double, "
        "r2 double, model_type string, task string, target string, feature_order array<string>, "
        "horizons_h array<int>, importances map<string,double>")


def importances(spark: SparkSession, t: Trained) -> DataFrame:
    """ML7 / AGG10: feature importances (4 decimals), descending."""
    imp = t.model.importances
    rows = [(f, float(round(float(v), 4))) for f, v in zip(K.FEATURE_ORDER, imp)]
    return (forest.local_frame(spark, rows, [("feature", pa.string()), ("importance", pa.float64())])
                  .orderBy(F.desc("importance"), "feature"))


def top_importances(spark: SparkSession, t: Trained, k: int = 5) -> DataFrame:
    """AGG10: the top-k listing."""
    return importances(spark, t).limit(k)


def save(t: Trained, path: str, spark: SparkSession | None = None) -> None:
    """ML8: persist the fitted forest (overwrite) and, given a session, its one-row
    metadata document (samples, MAE, R2, feature order, horizons) as JSON next to it."""
    t.model.save(path)
    if spark is not None:
        metrics_frame(spark, t).write.mode("overwrite").json(f"{path}_meta")


def load(path: str) -> forest.Forest:
    """ML8: reload; a missing model is a clear error, never a silent default."""
    try:
        return forest.load(SparkSession.active(), path)
    except Exception as e:  # noqa: BLE001
        raise FileNotFoundError(
            f"No forecast model in {path}; make one with airshed.ml.model.train and save") from e
