"""Splits, scaling, joins, profiles, correlation and quantiles on small frames."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from signalframe.operators import articles, buckets, correlate, joins, prepare, profile, themes
from signalframe.plans.quantiles import exact_quantiles

START = datetime(2021, 1, 1)


@pytest.fixture(scope="module")
def series_table(spark):
    rows = [(START + timedelta(days=i), float(i % 17), 3.0, float(i * 2 % 31)) for i in range(800)]
    return spark.createDataFrame(rows, "t timestamp_ntz, a double, c double, y double").repartition(4).cache()


@pytest.mark.parametrize("strategy", list(prepare.SPLITS))
def test_splits_are_complete_disjoint_and_repeatable(series_table, strategy):
    split = prepare.SPLITS[strategy](series_table, "t")
    parts = {r["part"]: r["count"] for r in split.groupBy("part").count().collect()}
    assert sum(parts.values()) == 800 and split.select("t").distinct().count() == 800
    assert 0.1 < parts["test"] / 800 < 0.3
    again = prepare.SPLITS[strategy](series_table.repartition(7), "t")
    assert split.exceptAll(again).count() == 0


def test_month_split_takes_whole_months(series_table):
    split = prepare.split_month_based(series_table, "t")
    per_month = split.groupBy(F.year("t").alias("y"), F.month("t").alias("m")).agg(F.countDistinct("part").alias("k"), F.min("part").alias("p")).collect()
    assert all(r.k == 1 for r in per_month)
    tested = pd.Series([r.y for r in per_month if r.p == "test"]).value_counts().to_dict()
    assert tested == {2021: 2, 2022: 2, 2023: 1}


def test_seasonal_block_is_one_run_in_the_middle(series_table):
    pdf = prepare.split_seasonal_block(series_table, "t").toPandas().sort_values("t")
    pdf["season"] = (pdf.t.dt.month % 12 + 3) // 3 % 4
    for _, group in pdf.groupby([pdf.t.dt.year, "season"]):
        n, block = len(group), int(len(group) * 0.2)
        start = n // 2 - block // 2
        assert (group.part == "test").tolist() == [start <= i < start + block for i in range(n)]


def test_scaling_uses_train_rows_only(series_table):
    split = prepare.split_random(series_table, "t")
    pdf, got = split.toPandas(), prepare.scale_split(split, ["a", "c"], "y").toPandas()
    train = pdf[pdf.part == "train"]
    both = pdf.merge(got, on="t", suffixes=("", "_s"))
    np.testing.assert_allclose(both.a_s, (both.a - train.a.mean()) / train.a.std(ddof=0))
    np.testing.assert_allclose(both.c_s, 0.0)
    np.testing.assert_allclose(both.y_s, (both.y - train.y.min()) / (train.y.max() - train.y.min()))


def test_quantiles_match_numpy(spark):
    for values in ([1.0], [4.0, 1.0], [3.0, 1.0, 2.0], [5.0, 5.0, 5.0, 1.0], np.random.default_rng(1).normal(size=501).tolist()):
        df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
        got = {r.probability: r.value for r in exact_quantiles(df, ["v"], [0.0, 0.25, 0.5, 0.75, 1.0]).collect()}
        assert [got[p] for p in sorted(got)] == pytest.approx(list(np.quantile(values, [0, .25, .5, .75, 1])))


def test_quantiles_through_the_bracket(spark):
    """Many values, one of which holds a third of all rows."""
    mixed = (F.xxhash64("id") % 1_000_003) / 7.0
    df = spark.range(400_000, numPartitions=8).select(F.when(F.col("id") % 3 == 0, 11.5).otherwise(mixed).alias("v")).cache()
    got = exact_quantiles(df, ["v"], [0.01, 0.25, 0.5, 0.999]).orderBy("probability").collect()
    values = np.array([r[0] for r in df.collect()])
    assert [r.value for r in got] == pytest.approx(list(np.quantile(values, [0.01, 0.25, 0.5, 0.999])))


def test_describe(spark):
    pdf = pd.DataFrame({"a": [1.0, 2, 3, 10], "b": [5, 5, 5, 5]})
    got = {r.feature: r for r in profile.describe(spark.createDataFrame(pdf)).collect()}
    want = pdf.describe()
    for c in pdf:
        assert [got[c][k] for k in ("count", "mean", "std", "min", "q25", "q50", "q75", "max")] == pytest.approx(want[c].tolist())


def test_correlation_is_pairwise_complete(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame(rng.normal(size=(400, 4)), columns=list("abcd"))
    pdf["b"] += 1e6 + pdf.a * 5
    pdf["k"] = 0.1
    pdf.loc[rng.random(400) < 0.3, "a"] = np.nan
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None).values.tolist(), "a double, b double, c double, d double, k double").repartition(6)
    want = pdf.corr()
    got = correlate.correlation_matrix(df).collect()
    assert len(got) == 10
    for r in got:
        expected = want.loc[r.feature_a, r.feature_b]
        assert r.r is None if np.isnan(expected) else r.r == pytest.approx(expected, abs=1e-9)
    against = {r.feature: r.r for r in correlate.target_correlation(df, "b").collect()}
    assert against["k"] is None and against["b"] == pytest.approx(1) and against["a"] == pytest.approx(want.loc["a", "b"])


def test_correlated_pairs_skip_identical_columns(spark):
    df = spark.createDataFrame([(float(i), float(i), -float(i) + (i % 3)) for i in range(50)], "a double, b double, c double")
    got = correlate.correlated_pairs(correlate.correlation_matrix(df)).collect()
    assert {(r.feature_a, r.feature_b) for r in got} == {("a", "c"), ("b", "c")}


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 0, 1, 5, 10, 10]], "v double")
    got = [r.n for r in profile.histogram(df, "v", 5).orderBy("bin").collect()]
    assert got == np.histogram([0, 0, 1, 5, 10, 10], bins=5)[0].tolist()
    flat = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    rows = profile.histogram(flat, "v", 4).orderBy("bin").collect()
    assert [r.n for r in rows] == [0, 0, 2, 0] and rows[0].low == 1.5


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (0.0, 1.0), (4.0, 3.0), (2.0, 2.5), (None, 1.0)], "actual double, predicted double")
    m = profile.regression_metrics(df).first()
    y, p = np.array([1, 0, 4, 2]), np.array([2, 1, 3, 2.5])
    assert m.n == 4 and m.mse == pytest.approx(((y - p) ** 2).mean()) and m.median_error == pytest.approx(np.median(y - p))
    assert m.r2 == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert m.mean_percent_error == pytest.approx(np.mean([-100, 25, -25]))


def test_partials_fold_to_the_direct_result(spark):
    rng = np.random.default_rng(5)
    rows = [(START + timedelta(seconds=int(s)), str(int(s) % 5), float(v)) for s, v in zip(rng.integers(0, 20000, 3000), rng.normal(1e7, 1, 3000))]
    df = spark.createDataFrame(rows, "t timestamp_ntz, batch string, v double")
    folded = buckets.merge_partials(buckets.partial_rollup(df, "t", ["v"], keys=["batch"]), ["v"], "1 hour").orderBy("time_bucket").collect()
    pdf = pd.DataFrame(rows, columns=["t", "batch", "v"]).set_index("t").v.resample("1h")
    np.testing.assert_allclose([r.v_std for r in folded], pdf.std(), rtol=1e-7)
    np.testing.assert_allclose([r.v_mean for r in folded], pdf.mean(), rtol=1e-12)
    assert [r.article_count for r in folded] == pdf.count().tolist()


def test_weather_names_without_a_multi_aggregate_column(spark):
    df = spark.createDataFrame([(START, 1.0, 2.0, 7), (START, 3.0, 4.0, 7)], "timestamp timestamp_ntz, `Power demand` double, pres double, hour int")
    assert buckets.bucket_weather(df).first().asDict() == {"timestamp": START, "Power demand": 4.0, "pres": 3.0}


def test_merge_refuses_disjoint_series(spark):
    left = spark.createDataFrame([(START, 1)], "t timestamp_ntz, v int")
    right = spark.createDataFrame([(START + timedelta(days=9), 1)], "s timestamp_ntz, v int")
    with pytest.raises(Exception, match="share no time range"):
        joins.merge_on_time(left, right, "t", "s").collect()
    assert joins.merge_on_time(left, right.where("v > 5"), "t", "s").count() == 0
    joined = joins.merge_on_time(left, left.withColumnRenamed("t", "s"), "t", "s")
    assert joined.columns == ["t", "v", "v_weather"] and joined.count() == 1


def test_partials_fold_in_one_aggregate(spark):
    df = spark.createDataFrame([(START, "a", 1.0)], "t timestamp_ntz, batch string, v double")
    folded = buckets.merge_partials(buckets.partial_rollup(df, "t", ["v"], keys=["batch"]), ["v"], "1 hour")
    assert "Window" not in folded._jdf.queryExecution().executedPlan().toString()


def test_new_records_keep_repeats_inside_the_batch(spark):
    batch = spark.createDataFrame([("a",), ("b",), ("b",)], "GKGRECORDID string")
    stored = spark.createDataFrame([("a",), ("a",)], "GKGRECORDID string")
    assert [r[0] for r in joins.new_records(batch, stored).collect()] == ["b", "b"]


def test_category_counts_list_every_category(spark):
    counts = spark.createDataFrame([("POWER_CUT", 3), ("XYZ", 9), ("SCHOOL", 1)], "theme string, n bigint")
    got = {r.category: (r.n, r.pct) for r in themes.category_counts(counts).collect()}
    assert len(got) == 9 and got["Energy"] == (3, 75.0) and got["Education"] == (1, 25.0) and got["Health"] == (0, 0.0)


def test_hot_interval(spark):
    """A third of all rows in one interval and one theme."""
    hot = F.when(F.col("id") % 3 == 0, F.lit("POWER,1;POWER,2")).otherwise(F.concat(F.lit("T"), (F.col("id") % 500).cast("string"), F.lit(",1;")))
    df = spark.range(90_000, numPartitions=6).select(hot.alias("V2Themes"))
    top = themes.top_themes(themes.theme_counts(df), 1).first()
    assert (top.theme, top.n) == ("POWER", 60_000)


def test_row_sample_is_repeatable(spark):
    df = spark.range(1000)
    a = articles.row_sample(df, 50, "id", seed=42).collect()
    b = articles.row_sample(df.repartition(9), 50, "id", seed=42).collect()
    assert a == b and a != articles.row_sample(df, 50, "id").collect() and len(a) == 50


def test_large_samples_are_selected_without_one_task(spark, monkeypatch):
    monkeypatch.setattr(articles, "TOP_ROWS", 10)
    monkeypatch.setattr(articles, "DIGITS", 1)
    df = spark.range(900).select(F.when(F.col("id") % 9 > 0, F.col("id")).alias("id")).repartition(5)  # a ninth without a key
    draw = F.md5(F.concat(F.lit("42-"), F.col("id").cast("string")))
    for n in (11, 100, 450, 899, 900, 2000):
        got = articles.row_sample(df, n, "id", seed=42)
        assert "TakeOrdered" not in got._jdf.queryExecution().executedPlan().toString()
        key = lambda r: (r.id is not None, r.id or 0)
        assert sorted(got.collect(), key=key) == sorted(df.orderBy(draw, "id").limit(n).collect(), key=key), n
        first = articles.row_sample(df, n, "id")
        assert sorted(first.collect(), key=key) == sorted(df.orderBy("id").limit(n).collect(), key=key), n
