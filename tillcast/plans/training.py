"""MLlib training, scoring and persistence.

Two boosted-tree regressors stand in for the two gradient-boosting
libraries: model A is depth-wise (depth 6, rate 0.1), model B is a shallower,
slower-learning variant (depth 5 ≈ 31 leaves, rate 0.05).  Early stopping
looks for the best round on the chronological validation rows, with patience.
MLlib gives the same capability, not the same numbers as other libraries.

Data-parallel: every fit is an MLlib job over the partitioned feature table;
the only driver-side values are the fitted models and the feature-importance
vector (one number per feature).
"""

from __future__ import annotations

import math
import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from tillcast.config import CONFIDENCE_LEVELS, EARLY_STOP_ROUNDS, MODEL_A, MODEL_B, SEARCH_SPACE_A, SEARCH_SPACE_B, SEARCH_TRIALS
from tillcast.operators import evaluation
from tillcast.session import ensure_checkpoint_dir, written

NUMERIC = ("int", "bigint", "double", "float", "smallint", "tinyint")


def feature_columns(df: DataFrame, target: str = "total_revenue", exclude: Sequence[str] = ("date",)) -> list[str]:
    """Model inputs: every numeric column but the target, plus the indexed store (51 for the training frame)."""
    skip = set(exclude) | {target, "position", "split"}
    cols = [n for n, t in df.dtypes if (t in NUMERIC or t.startswith("decimal")) and n not in skip]
    return (["store_id_index"] if "store_id" in df.columns else []) + cols


def gbt_pipeline(feature_cols: Sequence[str], target: str = "total_revenue", params: Mapping | None = None) -> Pipeline:
    """StringIndexer (sorted labels, unseen → error) → VectorAssembler → GBTRegressor."""
    p = dict(MODEL_A if params is None else params)
    stages = [
        StringIndexer(inputCol="store_id", outputCol="store_id_index", stringOrderType="alphabetAsc",
                      handleInvalid="error"),
        VectorAssembler(inputCols=list(feature_cols), outputCol="features", handleInvalid="keep"),
        GBTRegressor(featuresCol="features", labelCol=target, checkpointInterval=10, **p),
    ]
    return Pipeline(stages=stages)


def best_round(losses: Sequence[float], patience: int = EARLY_STOP_ROUNDS) -> int:
    """Round (from 1) with the lowest loss before ``patience`` rounds pass without a gain."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def fit(labeled: DataFrame, params: Mapping | None = None, target: str = "total_revenue",
        patience: int = EARLY_STOP_ROUNDS) -> PipelineModel:
    """Boost on the train rows, and keep the rounds up to the best one on the validation rows.

    All rounds are fitted once; the loss after each round is measured on the
    validation rows (``evaluateEachIteration``, one pass), and the fitted
    ensemble is cut to its best rounds (:func:`first_rounds`).  Without
    validation rows all rounds stay.

    The train rows come in at most one partition per core: each partition
    sends the statistics of all nodes, features and bins at every level.
    """
    ensure_checkpoint_dir(labeled.sparkSession)
    p = dict(MODEL_A if params is None else params)
    cols = feature_columns(labeled, target)
    train, held = (labeled.where(F.col("split") == s) for s in ("train", "validation"))
    train = train.coalesce(max(1, labeled.sparkSession.sparkContext.defaultParallelism))
    model = gbt_pipeline(cols, target, p).fit(train)
    if held.isEmpty():
        return model
    prepared = PipelineModel(model.stages[:-1]).transform(held)
    rounds = best_round(model.stages[-1].evaluateEachIteration(prepared, "squared"), patience)
    return PipelineModel([*model.stages[:-1], first_rounds(model.stages[-1], rounds)])


def first_rounds(model: GBTRegressionModel, rounds: int) -> GBTRegressionModel:
    """The ensemble of the first ``rounds`` trees of a fitted one.

    Boosting adds trees one after the other, so this equals a fit with
    ``maxIter=rounds`` and the same seed.  All trees stay if there are no more.
    """
    if rounds < 1:
        raise ValueError("rounds must be at least 1")
    if rounds >= model.getNumTrees:
        return model
    sc = SparkSession.active().sparkContext
    regression = sc._jvm.org.apache.spark.ml.regression
    fitted = model._java_obj
    all_trees, all_weights = fitted.trees(), fitted.treeWeights()
    trees = sc._gateway.new_array(regression.DecisionTreeRegressionModel, rounds)
    weights = sc._gateway.new_array(sc._jvm.double, rounds)
    for i in range(rounds):
        trees[i], weights[i] = all_trees[i], all_weights[i]
    cut = regression.GBTRegressionModel(model.uid, trees, weights, model.numFeatures)
    settings = fitted.extractParamMap().put(fitted.maxIter(), rounds)
    return GBTRegressionModel._from_java(fitted.copyValues(cut, settings))


def score(model: PipelineModel, df: DataFrame, name: str, target: str = "total_revenue") -> DataFrame:
    """Long predictions (date, store_id, split, model, actual, prediction)."""
    out = model.transform(df)
    return out.select("date", "store_id", "split", F.lit(name).alias("model"),
                      F.col(target).alias("actual"), F.col("prediction"))


def importance(spark: SparkSession, model: PipelineModel, feature_cols: Sequence[str], name: str) -> DataFrame:
    """(model, feature, importance) — one value per feature."""
    vec = model.stages[-1].featureImportances.toArray().tolist()
    return spark.createDataFrame([(name, f, float(v)) for f, v in zip(feature_cols, vec)],
                                 "model string, feature string, importance double")


def _drawn(space: Mapping, rng: random.Random, seed: int) -> dict:
    """One random parameter set from a search space of either model."""
    p: dict = {"seed": seed}
    for name, (low, high) in space.items():
        if name == "stepSize":
            p[name] = 10 ** rng.uniform(math.log10(low), math.log10(high))
        elif name == "numLeaves":  # MLlib bounds depth, not leaves
            p["maxDepth"] = max(1, math.ceil(math.log2(rng.randint(low, high))))
        elif name == "featureSubset":
            p["featureSubsetStrategy"] = str(round(rng.uniform(low, high), 2))
        elif isinstance(low, int):
            p[name] = rng.randint(low, high)
        else:
            p[name] = rng.uniform(low, high)
    return p


def random_search(labeled: DataFrame, space: Mapping = SEARCH_SPACE_A, trials: int = SEARCH_TRIALS,
                  seed: int = 42, target: str = "total_revenue") -> tuple[dict, DataFrame]:
    """Seeded random search of either model's space by validation RMSE (trials × one fit with early stopping).

    Returns the best parameters and a (trial, params, rounds, rmse) table.
    """
    rng = random.Random(seed)
    spark = labeled.sparkSession
    rows, best = [], (float("inf"), None)
    val = labeled.where(F.col("split") == "validation")
    for t in range(trials):
        p = _drawn(space, rng, seed)
        m = fit(labeled, p, target)
        rmse = evaluation.regression_metrics(score(m, val, "trial", target)).where(
            F.col("metric") == "rmse").select("value").first()[0]
        rows.append((t, str(p), m.stages[-1].getNumTrees, float(rmse)))
        if rmse < best[0]:
            best = (rmse, p)
    return best[1], spark.createDataFrame(rows, "trial int, params string, rounds int, rmse double")


def halving_search(labeled: DataFrame, space: Mapping = SEARCH_SPACE_A, trials: int = SEARCH_TRIALS, seed: int = 42,
                   target: str = "total_revenue", rungs: int = 4, shrink: int = 3,
                   parallelism: int = 4) -> tuple[dict, DataFrame]:
    """The draws of :func:`random_search`, thinned by successive halving with concurrent fits.

    Every draw is first fitted for a few rounds; on each of the ``rungs`` the
    best ``1 / shrink`` (rounded up) by validation RMSE go on with ``shrink``
    times as many rounds, so that only the last ones get all of theirs.  A draw
    that has had all its rounds keeps its result.  The inputs are indexed and
    assembled once; ``parallelism`` fits share the cluster (each is a chain
    of small jobs that cannot fill it).  Results do not depend on it.

    Returns the best parameters and a table (trial, rung, params, rounds,
    best_round, rmse, kept) with a row per trial and rung it took part in.
    Ties go to the earlier draw.  Without validation rows it raises.
    """
    if trials < 1 or rungs < 1 or shrink < 2:
        raise ValueError("a search needs at least one trial, one rung and shrinking by 2")
    spark = labeled.sparkSession
    ensure_checkpoint_dir(spark)
    rng = random.Random(seed)
    drawn = [_drawn(space, rng, seed) for _ in range(trials)]
    train, held = (labeled.where(F.col("split") == s) for s in ("train", "validation"))
    if held.isEmpty():
        raise ValueError("the search needs validation rows")
    inputs = Pipeline(stages=gbt_pipeline(feature_columns(labeled, target), target).getStages()[:-1]).fit(train)
    train, held = (written(inputs.transform(x).select("features", target), "search-input") for x in (train, held))
    train = train.coalesce(max(1, spark.sparkContext.defaultParallelism))

    def tried(job: tuple[int, int]) -> tuple[int, float]:
        trial, rounds = job
        model = gbt_pipeline([], target, drawn[trial] | {"maxIter": rounds}).getStages()[-1].fit(train)
        losses = model.evaluateEachIteration(held, "squared")
        best = best_round(losses)
        return best, math.sqrt(losses[best - 1])

    most = max(p["maxIter"] for p in drawn)
    rows, done, alive = [], {}, list(range(trials))
    pool = ThreadPool(max(1, min(parallelism, trials)))
    try:
        for rung in range(rungs):
            budget = math.ceil(most / shrink ** (rungs - 1 - rung))
            jobs = [(t, min(budget, drawn[t]["maxIter"])) for t in alive]
            new = [j for j in jobs if j not in done]
            done.update(zip(new, pool.map(inheritable_thread_target(spark)(tried), new, chunksize=1)))
            ranked = sorted(jobs, key=lambda j: (done[j][1], j[0]))
            kept = {t for t, _ in ranked[: 1 if rung == rungs - 1 else math.ceil(len(ranked) / shrink)]}
            rows += [(t, rung, str(drawn[t]), n, *done[t, n], t in kept) for t, n in jobs]
            alive = sorted(kept)
    finally:
        pool.close()
    table = spark.createDataFrame(
        rows, "trial int, rung int, params string, rounds int, best_round int, rmse double, kept boolean")
    return drawn[alive[0]], table


def select_features(labeled: DataFrame, threshold: float = 0.001, target: str = "total_revenue") -> DataFrame:
    """Random-forest importances (100 trees, seed 42) at or above ``threshold``."""
    cols = feature_columns(labeled, target)
    pipe = Pipeline(stages=[
        StringIndexer(inputCol="store_id", outputCol="store_id_index", stringOrderType="alphabetAsc"),
        VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="keep"),
        RandomForestRegressor(featuresCol="features", labelCol=target, numTrees=100, seed=42),
    ])
    model = pipe.fit(labeled)
    imp = importance(labeled.sparkSession, model, cols, "random_forest")
    return imp.where(F.col("importance") >= threshold)


@dataclass
class Bundle:
    """What a training run leaves behind: fitted pipelines, ensemble weights, feature list, and its tables."""

    models: dict[str, PipelineModel]
    weights: dict[str, float]
    features: list[str]
    tables: dict[str, DataFrame]


def train_all(spark: SparkSession, labeled: DataFrame, target: str = "total_revenue", search_trials: int = 0) -> Bundle:
    """Both models, searched first (by halving) where ``search_trials`` is positive, and their weighted ensemble.

    Tables: ``predictions`` (test rows of every model), ``held_out`` (the
    validation rows likewise), ``metrics``, ``weights``, ``importance``, ``trials``.
    """
    cols = feature_columns(labeled, target)
    chosen, trials = {"model_a": MODEL_A, "model_b": MODEL_B}, []
    if search_trials:
        for name, space in (("model_a", SEARCH_SPACE_A), ("model_b", SEARCH_SPACE_B)):
            chosen[name], tried = halving_search(labeled, space, search_trials, target=target)
            trials.append(tried.withColumn("model", F.lit(name)))
    # each fit is a chain of small jobs that cannot fill the cluster, so the models are fitted side by side
    pool = ThreadPool(len(chosen))
    try:
        fitted = pool.map(inheritable_thread_target(spark)(lambda p: fit(labeled, p, target)), chosen.values(), chunksize=1)
    finally:
        pool.close()
    models = dict(zip(chosen, fitted))
    scored = labeled.where(F.col("split").isin("validation", "test"))
    preds = written(reduce(DataFrame.unionByName, [score(m, scored, name, target) for name, m in models.items()]), "scored")
    metrics = evaluation.regression_metrics(preds, ["split", "model"])
    weights = evaluation.ensemble_weights(metrics.where(F.col("split") == "validation"))
    weights = written(weights, "weights")
    ens = evaluation.ensemble_predictions(preds.where(F.col("split") == "test"), weights)
    metrics = metrics.unionByName(evaluation.regression_metrics(ens, ["split", "model"]))
    held = F.col("split") == "validation"
    tables = {
        "predictions": preds.where(F.col("split") == "test").unionByName(ens),
        "held_out": preds.where(held).unionByName(evaluation.ensemble_predictions(preds.where(held), weights)),
        "metrics": metrics,
        "weights": weights,
        "importance": reduce(DataFrame.unionByName, [importance(spark, m, cols, name) for name, m in models.items()]),
    }
    if trials:
        tables["trials"] = reduce(DataFrame.unionByName, trials)
    # one row per model
    return Bundle(models, {r.model: r.weight for r in weights.collect()}, cols, tables)


def save(model: PipelineModel, path: str) -> None:
    """Persist a fitted pipeline (indexer, assembler, trees) to any Hadoop path."""
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    """S10."""
    return PipelineModel.load(path)


def save_bundle(spark: SparkSession, bundle: Bundle, path: str) -> None:
    """Models, ensemble weights and feature list under one folder."""
    for name, model in bundle.models.items():
        save(model, f"{path}/models/{name}")
    rows = [(name, float(bundle.weights[name])) for name in bundle.models]
    spark.createDataFrame(rows, "model string, weight double").write.mode("overwrite").parquet(f"{path}/weights")
    features = list(enumerate(bundle.features))
    spark.createDataFrame(features, "position int, feature string").write.mode("overwrite").parquet(f"{path}/features")


def load_bundle(spark: SparkSession, path: str) -> Bundle:
    """The inverse of :func:`save_bundle` (without tables)."""
    weights = {r.model: r.weight for r in spark.read.parquet(f"{path}/weights").collect()}
    features = [r.feature for r in spark.read.parquet(f"{path}/features").orderBy("position").collect()]
    return Bundle({name: load(f"{path}/models/{name}") for name in weights}, weights, features, {})


# ---------------------------------------------------------------------------
# run table
# ---------------------------------------------------------------------------
RUN_SCHEMA = ("run_id string, started timestamp, status string, train_rows bigint, validation_rows bigint, test_rows bigint, "
              "features int, model string, metric string, value double")


def run_rows(spark: SparkSession, labeled: DataFrame, bundle: Bundle, run_id: str, started: datetime,
             status: str = "FINISHED") -> DataFrame:
    """One row per test metric of a run, with the run's id, start, status, split sizes and number of features."""
    sizes = labeled.groupBy().agg(*[F.count_if(F.col("split") == s).alias(f"{s}_rows") for s in ("train", "validation", "test")])
    run = sizes.select(
        F.lit(run_id).alias("run_id"), F.lit(started).alias("started"), F.lit(status).alias("status"), "*",
        F.lit(len(bundle.features)).alias("features"))
    test = bundle.tables["metrics"].where(F.col("split") == "test").select("model", "metric", "value")
    return run.crossJoin(test)  # one row per run


def append_run(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def best_run(runs: DataFrame, metric: str = "rmse", model: str = "ensemble") -> DataFrame:
    """Finished run with the lowest value of a model's metric (highest for r2; ties: the later run)."""
    m = runs.where((F.col("status") == "FINISHED") & (F.col("metric") == metric) & (F.col("model") == model))
    order = F.desc("value") if metric == "r2" else F.asc("value")
    return m.orderBy(order, F.desc("started"), "run_id").limit(1).select("run_id", "started", "value")


def latest_run(runs: DataFrame) -> DataFrame:
    """The finished run that started last."""
    done = runs.where(F.col("status") == "FINISHED").select("run_id", "started").distinct()
    return done.orderBy(F.desc("started"), "run_id").limit(1)


# ---------------------------------------------------------------------------
# forecast job
# ---------------------------------------------------------------------------
def model_forecast(bundle: Bundle, history: DataFrame, horizon: int = 30, target: str = "total_revenue") -> DataFrame:
    """``date, store_id, model, predicted_sales, lower_bound, upper_bound`` for every store and coming day.

    Stores that training never saw are scored as the first known one and
    keep their name.  Inputs are aligned to the trained features (absent
    ones 0).  Every model of the bundle and the weighted ensemble get rows.
    """
    from tillcast.operators import forecast

    spark = history.sparkSession
    first = next(iter(bundle.models.values()))
    known = spark.createDataFrame([(x,) for x in first.stages[0].labels], "store_id string")
    frame = forecast.forecast_frame(history, horizon, target)
    named = forecast.map_unknown(frame.withColumn("_store", F.col("store_id")), "store_id", known)
    inputs = [c for c in bundle.features if c != "store_id_index"]
    aligned = forecast.align_features(named, ["date", "_store", "store_id", *inputs])
    parts = [m.transform(aligned).select("date", F.col("_store").alias("store_id"), F.lit(name).alias("model"),
                                         F.lit(None).cast("double").alias("actual"), "prediction")
             for name, m in bundle.models.items()]
    preds = reduce(DataFrame.unionByName, parts)
    weights = spark.createDataFrame(list(bundle.weights.items()), "model string, weight double")
    preds = preds.unionByName(evaluation.ensemble_predictions(preds, weights))
    return forecast.with_band(preds.select("date", "store_id", "model", F.col("prediction").alias("predicted_sales")))


def forecast_intervals(bundle: Bundle, preds: DataFrame, levels: Sequence[float] = CONFIDENCE_LEVELS) -> DataFrame:
    """A forecast of :func:`model_forecast` with ``lower_{level}, upper_{level}`` for each confidence level.

    Widths are split-conformal, from each model's residuals on the validation
    rows of the store (of all stores where a store has too few).  They come
    from predictions one step ahead with known features, and so are narrow for
    far days, whose features are constant.
    """
    from tillcast.operators import diagnostics, forecast

    return forecast.with_intervals(preds, written(diagnostics.residuals(bundle.tables["held_out"]), "residuals"), levels)
