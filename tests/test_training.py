import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from tillcast.operators import evaluation, split as S
from tillcast.plans import training

SMALL = "/root/testdata/sf0.001"
QUICK = {"maxIter": 4, "maxDepth": 2, "seed": 42}


@pytest.fixture(scope="module")
def store_days(spark):
    from tillcast.plans.registry import store_daily_of
    from tillcast.session import materialize

    return materialize(store_daily_of(spark, SMALL).fillna(0, ["is_holiday"]))


@pytest.fixture(scope="module")
def labeled(store_days):
    from tillcast.session import materialize

    return materialize(S.chronological_split(store_days, target="total_revenue"))


@pytest.fixture(scope="module")
def bundle(spark, labeled):
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(training, "MODEL_A", QUICK)
        patch.setattr(training, "MODEL_B", QUICK | {"stepSize": 0.3})
        return training.train_all(spark, labeled)


def test_best_round_waits_out_its_patience():
    losses = [10, 9, 9.5, 9.4, 8, 8.5, 8.4, 8.3, 7]
    assert training.best_round(losses, 2) == 2 and training.best_round(losses, 3) == 5 and training.best_round(losses, 50) == 9


def test_fit_keeps_rounds_after_a_small_gain(labeled):
    """A 1 % rule would stop where gains are small; patience keeps boosting while the loss still falls."""
    params = {"maxIter": 12, "maxDepth": 3, "stepSize": 0.02, "seed": 42}
    slow = training.fit(labeled, params)
    prepared = training.PipelineModel(slow.stages[:-1]).transform(labeled.where("split = 'validation'"))
    losses = slow.stages[-1].evaluateEachIteration(prepared, "squared")
    assert len(losses) == slow.stages[-1].getNumTrees
    assert losses[-1] == min(losses)  # refitted up to the best round, the last trees being the best ones


def test_cut_ensemble_equals_a_refit(spark, labeled):
    """The first trees of a fitted ensemble are the ensemble of a shorter fit, also once saved and loaded."""
    params = {"maxIter": 6, "maxDepth": 3, "stepSize": 0.3, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.7", "seed": 42}
    cols = training.feature_columns(labeled)
    train = labeled.where("split = 'train'")
    whole = training.gbt_pipeline(cols, params=params).fit(train)
    short = training.gbt_pipeline(cols, params=params | {"maxIter": 3}).fit(train)
    cut = training.PipelineModel([*whole.stages[:-1], training.first_rounds(whole.stages[-1], 3)])
    assert cut.stages[-1].getNumTrees == 3 and cut.stages[-1].getMaxIter() == 3
    assert cut.stages[-1].treeWeights == short.stages[-1].treeWeights
    path = tempfile.mkdtemp(prefix="tillcast-cut-") + "/model"
    training.save(cut, path)
    rows = [sorted((r.date, r.store_id, r.prediction) for r in training.score(m, labeled, "m").collect())
            for m in (short, cut, training.load(path))]
    assert rows[0] == rows[1] == rows[2]
    assert training.first_rounds(whole.stages[-1], 9) is whole.stages[-1]
    with pytest.raises(ValueError):
        training.first_rounds(whole.stages[-1], 0)


def test_one_fit_per_model(labeled, monkeypatch):
    fits = []
    fit = training.GBTRegressor._fit
    monkeypatch.setattr(training.GBTRegressor, "_fit", lambda self, data: fits.append(1) or fit(self, data))
    model = training.fit(labeled, {"maxIter": 8, "maxDepth": 6, "stepSize": 1.0, "seed": 42})
    assert fits == [1] and model.stages[-1].getNumTrees < 8  # overfits soon, so rounds are cut


def test_both_search_spaces(labeled):
    a = {"maxIter": (2, 3), "maxDepth": (2, 3), "stepSize": (0.05, 0.3), "subsamplingRate": (0.8, 1.0),
         "featureSubset": (0.6, 1.0), "minInfoGain": (0.0, 0.1)}
    b = {"numLeaves": (3, 8), "stepSize": (0.05, 0.3), "maxIter": (2, 3), "minInstancesPerNode": (10, 50),
         "subsamplingRate": (0.6, 1.0), "featureSubset": (0.6, 1.0)}
    for space in (a, b):
        best, trials = training.random_search(labeled, space, trials=2)
        rows = trials.collect()
        assert len(rows) == 2 and str(best) == min(rows, key=lambda r: r.rmse).params and best["maxDepth"] in (2, 3)


def test_halving_search(labeled):
    """Each rung keeps its best third; the results are those of fits of their own, whatever runs at once."""
    space = {"maxIter": (4, 9), "maxDepth": (1, 3), "stepSize": (0.05, 0.5), "subsamplingRate": (0.8, 1.0)}
    best, table = training.halving_search(labeled, space, trials=5, rungs=2, parallelism=4)
    rows = table.collect()
    again = training.halving_search(labeled, space, trials=5, rungs=2, parallelism=1)
    assert again[0] == best and again[1].collect() == rows
    rungs = [[r for r in rows if r.rung == k] for k in (0, 1)]
    assert [len(x) for x in rungs] == [5, 2] and {r.trial for r in rungs[1]} == {r.trial for r in rungs[0] if r.kept}
    for rung, n in zip(rungs, (2, 1)):
        assert [r.trial for r in sorted(rung, key=lambda r: (r.rmse, r.trial))[:n]] == sorted(
            (r.trial for r in rung if r.kept), key=lambda t: next((r.rmse, t) for r in rung if r.trial == t))
    assert str(best) == next(r.params for r in rungs[1] if r.kept)
    assert max(r.rounds for r in rungs[0]) < max(r.rounds for r in rungs[1])
    model = training.fit(labeled, best)
    rmse = evaluation.regression_metrics(training.score(model, labeled.where("split = 'validation'"), "m")).where("metric = 'rmse'")
    last = next(r for r in rungs[1] if r.kept)
    assert model.stages[-1].getNumTrees == last.best_round and abs(rmse.first().value - last.rmse) < 1e-6 * last.rmse


def test_halving_search_needs_validation_rows(labeled):
    with pytest.raises(ValueError):
        training.halving_search(labeled.where("split = 'train'"), trials=2)
    with pytest.raises(ValueError):
        training.halving_search(labeled, trials=0)


def test_ensemble_follows_from_predictions(bundle):
    preds = bundle.tables["predictions"].toPandas().pivot(index=["date", "store_id"], columns="model", values="prediction")
    w = bundle.weights
    assert abs(sum(w.values()) - 1) < 1e-9 and min(w.values()) > 0
    blend = sum(preds[m] * w[m] for m in w)
    assert (preds["ensemble"] - blend).abs().max() < 1e-3
    rmse = {r.model: r.value for r in bundle.tables["metrics"].where("split = 'test' and metric = 'rmse'").collect()}
    again = {r.model: r.value for r in evaluation.regression_metrics(bundle.tables["predictions"]).where("metric = 'rmse'").collect()}
    assert rmse.keys() == again.keys() and all(abs(rmse[m] - again[m]) < 1e-6 for m in rmse)
    sums = bundle.tables["importance"].groupBy("model").agg(F.sum("importance").alias("s")).collect()
    assert all(abs(r.s - 1) < 1e-9 for r in sums)


def test_bundle_round_trip_and_forecast(spark, bundle, store_days):
    path = tempfile.mkdtemp(prefix="tillcast-bundle-")
    training.save_bundle(spark, bundle, path)
    again = training.load_bundle(spark, path)
    assert again.weights == bundle.weights and again.features == bundle.features
    some = store_days.agg(F.max("store_id")).first()[0]
    odd = store_days.where(F.col("store_id") == some).withColumn("store_id", F.lit("store_999"))
    history = store_days.unionByName(odd)
    got = training.model_forecast(again, history, horizon=120)
    n = history.select("store_id").distinct().count()
    assert got.count() == 120 * n * 3
    assert got.where("lower_bound > predicted_sales and predicted_sales > 0").isEmpty()
    assert got.where("store_id = 'store_999'").count() == 360
    wide = got.toPandas().pivot(index=["date", "store_id"], columns="model", values="predicted_sales")
    assert (wide["ensemble"] - sum(wide[m] * w for m, w in again.weights.items())).abs().max() < 1e-3


def test_feature_selection_and_scaling(spark, labeled):
    from tillcast.operators import encoding, features

    picked = training.select_features(labeled.select("date", "store_id", "total_revenue", "quantity_sold", "profit", "split"))
    names = {r.feature: r.importance for r in picked.collect()}
    assert names and min(names.values()) >= 0.001 and set(names) <= {"store_id_index", "quantity_sold", "profit"}
    scaler = encoding.fit_scaler(labeled, ["profit"])
    m = scaler.first()
    back = encoding.inverse_scale(encoding.apply_scaler(labeled, scaler, ["profit"]), "profit", m["mean"], m["std"])
    a, b = (sorted(r.profit for r in df.select("profit").collect()) for df in (labeled, back))
    assert max(abs(x - y) for x, y in zip(a, b)) < 1e-6
    gaps = spark.createDataFrame([(1.0, 5), (None, 7), (3.0, None)], "x double, y int")
    assert sorted((r.x, r.y) for r in features.fill_mean(gaps, ["x", "y"]).collect()) == [(1.0, 5), (2.0, 7), (3.0, 6)]
    encoder = encoding.fit_label_encoder(labeled, "store_id")
    coded = encoding.apply_label_encoder(labeled, encoder, "store_id")
    assert coded.where("store_id_index is null").isEmpty()
    unseen = labeled.limit(1).withColumn("store_id", F.lit("store_x"))
    with pytest.raises(Exception, match="unseen label"):
        encoding.apply_label_encoder(unseen, encoder, "store_id").collect()
    assert encoding.apply_label_encoder(unseen, encoder, "store_id", strict=False).first().store_id_index is None


def test_run_table(spark, labeled, bundle):
    path = tempfile.mkdtemp(prefix="tillcast-runs-")
    first = training.run_rows(spark, labeled, bundle, "a", dt.datetime(2024, 1, 1))
    training.append_run(first, path)
    training.append_run(first.withColumn("run_id", F.lit("b")).withColumn("started", F.lit(dt.datetime(2024, 1, 2))).withColumn(
        "value", F.col("value") + 1), path)
    training.append_run(first.withColumn("run_id", F.lit("c")).withColumn("started", F.lit(dt.datetime(2024, 1, 3))).withColumn(
        "status", F.lit("FAILED")).withColumn("value", F.lit(0.0)), path)
    runs = spark.read.parquet(path)
    assert training.best_run(runs).first().run_id == "a" and training.latest_run(runs).first().run_id == "b"
    assert training.best_run(runs, "r2").first().run_id == "b"
    r = runs.where("run_id = 'a'").first()
    assert r.train_rows + r.validation_rows + r.test_rows == labeled.count() and r.features == len(bundle.features)


def test_forecast_intervals_hold_the_prediction(bundle, store_days):
    preds = training.model_forecast(bundle, store_days, horizon=2)
    rows = training.forecast_intervals(bundle, preds).collect()
    assert len(rows) == preds.count() and {r.model for r in rows} == {"model_a", "model_b", "ensemble"}
    for r in rows:
        assert r.lower_80 <= r.predicted_sales <= r.upper_80 and r.upper_80 - r.lower_80 > 0
        assert r.lower_95 is None or (r.lower_95 <= r.lower_80 and r.upper_95 >= r.upper_80)


def test_training_takes_a_partition_per_core(spark, labeled, monkeypatch):
    """Every partition sends the statistics of all nodes at each level, so there are no more than cores."""
    seen = []
    fit = training.GBTRegressor._fit
    monkeypatch.setattr(training.GBTRegressor, "_fit", lambda self, data: seen.append(data.rdd.getNumPartitions()) or fit(self, data))
    model = training.fit(labeled.repartition(60), QUICK)
    assert model.stages[-1].getNumTrees <= QUICK["maxIter"]
    assert seen and seen[0] <= spark.sparkContext.defaultParallelism


def test_forecast_reads_the_training_run_history(spark, monkeypatch):
    """The forecast's history is the training run's store-day table, built once for both."""
    from tillcast.operators import cleaning
    from tillcast.plans import q_more

    built = []
    build = cleaning.build_store_daily
    monkeypatch.setattr(cleaning, "build_store_daily", lambda *tables: built.append(1) or build(*tables))
    monkeypatch.setattr(training, "MODEL_A", QUICK)
    monkeypatch.setattr(training, "MODEL_B", QUICK | {"stepSize": 0.3})
    monkeypatch.setattr(q_more, "_BUNDLES", {})
    assert q_more._model_forecast(spark, SMALL).count() > 0
    assert built == [1]
