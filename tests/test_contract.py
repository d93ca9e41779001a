"""The registered queries: results against DuckDB, and plan shapes."""

import re

import pytest
from compare import differences, duck
from conftest import SF_DIR
from pyspark.sql import functions as F

import __spark_entry__ as contract
from signalframe.catalog import oracle
from signalframe.catalog import queries as catalog
from signalframe.operators import forecast, prepare, profile
from signalframe.plans import flows
from signalframe.plans.staging import stage
from signalframe.sources import files

QUERIES, ORACLES = catalog.QUERIES, oracle.ORACLES
MODELS = ["gbt_forecast", "forecast_report", "feature_importance", "sequence_forecast"]


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_but_the_models_has_sql():
    assert set(QUERIES) - set(ORACLES) == set(MODELS) and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert differences(df.toArrow(), con.sql(ORACLES[name]).to_arrow_table()) == []


@pytest.fixture(scope="module")
def trained(spark):
    return catalog.trained(spark, SF_DIR)


def test_trees_keep_their_contract(spark, con, trained):
    scored, metrics, weights = trained
    frame = scored.toPandas()
    assert len(frame) > 100 and frame.predicted.notna().all()
    error = ((frame.actual - frame.predicted) ** 2).mean()
    assert error < ((frame.actual - frame.actual.mean()) ** 2).mean() * 1.05
    assert weights.toPandas().importance.sum() == pytest.approx(1, abs=1e-4)
    con.register("predictions", scored.toArrow())
    want = con.execute("SELECT count(*), sqrt(avg(error * error)), avg(abs_error), quantile_cont(error, 0.5) FROM predictions").fetchone()
    got = metrics.first()
    assert (got.n, got.rmse, got.mae, got.median_error) == pytest.approx(want)
    bins = profile.histogram(scored, "error").toPandas()
    assert bins.n.sum() == len(frame) and bins.low.iloc[0] == pytest.approx(frame.error.min())


def test_sequences_keep_their_contract(spark, trained):
    assert len(QUERIES["sequence_forecast"](spark, SF_DIR).toPandas()) == trained[0].count() - 24


def test_length_is_the_best_on_the_held_rows(spark, tmp_path):
    rows = spark.range(1500).select(
        (F.col("id") % 97 / 97.0).alias("x"), (F.col("id") % 31 / 31.0).alias("z"), (F.col("id") >= 1200).alias("held"))
    table = forecast.assemble(rows.withColumn("y", F.sin(6 * F.col("x")) + F.col("z") * F.col("z")), ["x", "z"])
    settings = {"depth": 3, "rate": 0.1, "trees": 80}
    model = forecast.fit_trees(table, "y", "held", patience=20, **settings)
    whole = forecast.learner("y", 80, 3, 0.1, 42).fit(table.where(~F.col("held")))
    errors = whole.evaluateEachIteration(table.where("held"), "squared")
    own = model.evaluateEachIteration(table.where("held"), "squared")[-1]
    assert model.getNumTrees > 20 and own == pytest.approx(min(errors[: model.getNumTrees]), rel=1e-9) and own <= min(errors) * 1.05
    forecast.save_model(model, str(tmp_path / "model"))
    again = forecast.load_model(str(tmp_path / "model"))
    assert again.getNumTrees == model.getNumTrees


def test_a_cut_model_is_the_shorter_fit(spark, tmp_path):
    rows = spark.range(400).select((F.col("id") % 17).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"), F.sin("id").alias("c"))
    table = stage(forecast.assemble(rows.withColumn("y", F.col("a") * 2 + F.col("b") * F.col("c")), ["a", "b", "c"]))
    long, short = (forecast.learner("y", n, 3, 0.1, 7).fit(table) for n in (12, 5))
    cut = forecast.first_trees(long, 5)
    pairs = zip(cut.transform(table).orderBy("a", "b", "c").collect(), short.transform(table).orderBy("a", "b", "c").collect())
    assert all(x.predicted == y.predicted for x, y in pairs)
    assert cut.featureImportances == short.featureImportances and cut.getNumTrees == 5
    forecast.save_model(cut, str(tmp_path / "m"))
    assert forecast.load_model(str(tmp_path / "m")).transform(table).agg(F.sum("predicted")).first() == cut.transform(table).agg(F.sum("predicted")).first()


def test_best_length_waits_for_the_patience():
    assert forecast.best_length([5, 4, 4.5, 4.4, 3, 3.5, 3.4], 3) == (5, False)
    assert forecast.best_length([5, 4, 4.5, 4.4, 4.2, 3], 3) == (2, True)


def test_scalers_turn_predictions_back(spark, tmp_path):
    rows = catalog.daily(spark, SF_DIR).select("ts", "n", "target")
    flows.store_split(rows, "ts", "target", str(tmp_path), "20240101_000000")
    scaled, scalers = (files.latest_run(spark, str(tmp_path), name) for name in ("rows", "scalers"))
    back = prepare.unscale(scaled.select("ts", F.col("target").alias("predicted")), scalers, "target", ["predicted"])
    both = back.join(rows, "ts").agg(F.max(F.abs(F.col("predicted") - F.col("target")) / F.col("target"))).first()[0]
    assert both < 1e-9 and back.count() == rows.count()


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and len(df.columns) == 39


def read_schema(df) -> str:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return " ".join(re.findall(r"ReadSchema: struct<([^>]*)>", plan))


def test_scans_read_only_what_they_need(spark):
    assert "value" not in read_schema(QUERIES["theme_counts"](spark, SF_DIR))
    assert "o_comment" not in read_schema(QUERIES["records_by_month"](spark, SF_DIR))
    assert read_schema(QUERIES["bucket_weather_15min"](spark, SF_DIR)).count("event_type") == 0
