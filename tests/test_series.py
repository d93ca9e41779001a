"""Row-order operators against pandas, with blocks small enough to be crossed."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from signalframe.operators import prepare, series
from signalframe.plans.ordered import nearest_values, number_rows, trailing_windows

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(7)
    n = 700
    steps = np.cumsum(rng.integers(1, 6, n))
    pdf = pd.DataFrame({"t": [START + timedelta(minutes=15 * int(s)) for s in steps],
                        "c": rng.integers(0, 50, n), "x": rng.normal(size=n), "y": rng.normal(size=n)})
    pdf.loc[rng.random(n) < 0.4, "x"] = np.nan
    pdf.loc[:4, "x"] = np.nan
    pdf.loc[200:330, "x"] = np.nan
    pdf.loc[n - 6:, "x"] = np.nan
    pdf.loc[rng.random(n) < 0.02, "y"] = np.nan
    return pdf


@pytest.fixture(scope="module")
def table(spark, frame):
    schema = pa.schema([("t", pa.timestamp("us")), ("c", pa.int64()), ("x", pa.float64()), ("y", pa.float64())])
    rows = spark.createDataFrame(pa.Table.from_pandas(frame, schema=schema, preserve_index=False))
    return rows.repartition(5).cache()


def column(df, name, order="t"):
    return [r[name] for r in df.orderBy(order).collect()]


def same(got, want):
    np.testing.assert_allclose(np.array([np.nan if v is None else v for v in got], dtype=float),
                               np.asarray(want, dtype=float), rtol=1e-12, atol=1e-12)


def test_number_rows(table, frame):
    assert column(number_rows(table, "t"), "row_no") == list(range(len(frame)))


def test_number_rows_per_key(table):
    keyed = table.withColumn("k", F.col("c") % 3)
    got = number_rows(keyed, "t", ["k"]).groupBy("k").agg(F.min("row_no"), F.max("row_no"), F.count("*"), F.countDistinct("row_no")).collect()
    assert all(r[1] == 0 and r[2] == r[3] - 1 == r[4] - 1 for r in got)


@pytest.mark.parametrize("block_rows", [12, 13, 64, 4096])
def test_trailing_windows_cross_blocks(table, frame, block_rows):
    numbered = number_rows(table, "t")
    got = trailing_windows(numbered, "row_no", 11, lambda w: {
        "m": series.rolling_mean(F.col("c"), w, 12, full=True)}, block_rows=block_rows)
    same(column(got, "m"), frame.c.rolling(12).mean())
    assert got.count() == len(frame)


def test_volume_features(table, frame):
    got = series.volume_features(table, "t", "c")
    same(column(got, "prev_article_count"), frame.c.shift(1).fillna(0))
    same(column(got, "article_volume_spike"), (frame.c > frame.c.rolling(12).mean() * 1.5).astype(int))


def test_moving_average(table, frame):
    same(column(series.moving_average(table, "t", "c"), "moving_avg_3"), frame.c.rolling(3, min_periods=1).mean())


def test_nearest_values(table, frame):
    forward = nearest_values(table, "t", {"p": F.col("x")})
    same(column(forward, "p"), frame.x.ffill())
    both = nearest_values(table, "t", {"p": F.col("x")}, {"f": F.col("x"), "g": F.col("y")}, head=True)
    same(column(both, "p"), frame.x.ffill().bfill())
    same(column(both, "f"), frame.x.bfill())
    same(column(both, "g"), frame.y.bfill())


def test_ffill_limited(table, frame):
    same(column(series.ffill_limited(table, "t", ["x"]), "x"), frame.x.ffill(limit=3))


def test_interpolate_only_where_much_is_missing(table, frame):
    got = series.interpolate_linear(table, "t", ["x", "y"])
    same(column(got, "x"), frame.x.interpolate(method="linear", limit_direction="both"))
    same(column(got, "y"), frame.y)


def test_mean_fill(table, frame):
    same(column(series.mean_fill(table, ["x", "y"]), "x"), frame.x.fillna(frame.x.mean()))


def test_densify_and_gap_fill(table, frame):
    named = table.select(F.col("t").alias("time_bucket"), F.col("c").alias("article_count"), "x", F.col("y").alias("y_sum"))
    dense = series.densify_spine(named)
    filled = series.gap_fill(dense)
    ref = frame.rename(columns={"t": "time_bucket", "c": "article_count", "y": "y_sum"}).set_index("time_bucket")
    ref = ref.reindex(pd.date_range(ref.index.min(), ref.index.max(), freq="15min"))
    assert dense.count() == len(ref)
    same(column(filled, "article_count", "time_bucket"), ref.article_count.fillna(0))
    same(column(filled, "x", "time_bucket"), ref.x.ffill().bfill().fillna(0))
    same(column(filled, "y_sum", "time_bucket"), ref.y_sum.fillna(0))
    assert filled.agg(F.sum("article_count")).first()[0] == frame.c.sum()


def test_gap_fill_recomputes_calendar_and_keeps_keys_apart(spark):
    rows = [("a", START, 1.0, 0), ("a", START + timedelta(hours=1), None, None), ("b", START, None, None),
            ("b", START + timedelta(hours=1), 5.0, 1)]
    df = spark.createDataFrame(rows, "k string, time_bucket timestamp_ntz, v double, hour int")
    got = series.gap_fill(df, keys=["k"], recompute_calendar=True).orderBy("k", "time_bucket").collect()
    assert [(r.k, r.v, r.hour) for r in got] == [("a", 1.0, 0), ("a", 1.0, 1), ("b", 5.0, 0), ("b", 5.0, 1)]


def test_spine_with_given_bounds(spark):
    df = spark.createDataFrame([(START, 1)], "time_bucket timestamp_ntz, v int")
    dense = series.densify_spine(df, start="2023-12-31 23:00:00", end="2024-01-31 23:45:00")
    assert dense.count() == 31 * 96 + 4
    assert dense.where("v is not null").count() == 1


def test_tail_validation_and_thinning(table, frame):
    marks = column(series.tail_validation(table, "t"), "part")
    assert marks == ["fit"] * 560 + ["validation"] * 140
    assert series.thin_rows(table, "t", step=1).count() == len(frame)
    assert column(series.thin_rows(table, "t"), "c") == frame.c.iloc[::4].tolist()


def test_sequences(table, frame):
    got = prepare.sequence_windows(table, "t", ["c", "y"], "c", rows=24).orderBy("t").collect()
    assert len(got) == len(frame) - 24
    for i in (0, 100, len(got) - 1):
        assert [s[0] for s in got[i].sequence] == frame.c.iloc[i:i + 24].tolist()
        assert got[i].target == frame.c.iloc[i + 24]


def test_sequences_do_not_cross_holes(spark):
    days = [d for d in range(200) if d not in (40, 41, 90) and not 120 <= d < 130]
    rows = spark.createDataFrame([(datetime(2024, 1, 1) + timedelta(days=d), float(d)) for d in days], "t timestamp_ntz, c double")
    got = {r.t: [s[0] for s in r.sequence] for r in prepare.sequence_windows(rows, "t", ["c"], "c", rows=24, max_gap="1 day").collect()}
    want = {datetime(2024, 1, 1) + timedelta(days=d): [float(x) for x in range(d - 24, d)] for d in days if all(x in days for x in range(d - 24, d + 1)) and d >= 24}
    assert got == want and want
    assert prepare.sequence_windows(rows, "t", ["c"], "c", rows=24).count() == len(days) - 24
