"""Parsing of single fields: every branch, on hand-written rows."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from signalframe import config
from signalframe.functions import clock, score, text
from signalframe.operators import articles


def values(spark, rows, expr, schema="v string"):
    return [r[0] for r in spark.createDataFrame([(r,) for r in rows], schema).select(expr).collect()]


def test_event_time(spark):
    rows = ["20240229101500", "20230229000000", "20240101", "nan", None, "20240101101500.0", "20240101246060",
            "2024010110150099", "20240101101560", "00000101000000", "2024-01-01 10:"]
    got = values(spark, rows, text.event_time("v"))
    moment = datetime(2024, 1, 1, 10, 15)
    assert got == [datetime(2024, 2, 29, 10, 15), None, None, None, None, moment, None, moment, None, None, None]


def test_record_themes(spark):
    rows = ["TAX_A,1;TAX_A,9;;b;", None, "", " Lead,4;X"]
    assert values(spark, rows, text.record_themes("v")) == [["tax_a", "b"], [], [], [" lead", "x"]]


def test_theme_mentions(spark):
    rows = ["A,1;B,2; A,3 ;;", "TAX,55", "  ", None, ",5;B"]
    assert values(spark, rows, text.theme_mentions("v")) == [["A", "B", "A"], ["TAX", "55"], [], None, ["", "B"]]


def test_first_category(spark):
    rows = ["env_oil", "econ_energy", "power_outage", "xyz", "public_school", "water"]
    got = values(spark, rows, text.first_category(F.col("v")))
    assert got == ["Energy", "Economic", "Energy", None, "Social", "Environment"]


def test_flags_take_first_category_only(spark):
    rows = spark.createDataFrame([(["econ_energy", "water"],), ([],)], "themes array<string>")
    flags = [r.asDict() for r in articles.theme_flags(rows).drop("themes").collect()]
    assert {k for k, v in flags[0].items() if v} == {"theme_Economic", "theme_Environment"}
    assert sum(flags[1].values()) == 0


def test_tone(spark):
    rows = spark.createDataFrame(
        [("1,2,3,4,5,6,7",), ("-1.5, 2 ,3,4,5,.5",), ("1,2",), ("a,2,3,4,5,6",), (None,), ("1,2,3,4,5,6d",), ("1e2,0,0,0,0,0,x",)],
        "V2Tone string")
    got = [list(r) for r in articles.tone_metrics(rows).drop("V2Tone").collect()]
    zero = [0.0] * 6
    assert got == [[1, 2, 3, 4, 5, 6], [-1.5, 2, 3, 4, 5, 0.5], zero, zero, zero, zero, [100, 0, 0, 0, 0, 0]]


def test_entities(spark):
    rows = spark.createDataFrame(
        [("KILL#3##1;kill#5#;WOUND#x;ARREST#2",), (None,), ("",), ("NOHASH;7",), ("A#1.0;B# 4 ",), ("A#1;B#2",)], "Counts string")
    got = [tuple(r) for r in articles.entity_stats(rows).drop("Counts").collect()]
    assert got == [(7, 2), (0, 0), (0, 0), (0, 0), (4, 1), (3, 2)]


def test_amounts(spark):
    rows = spark.createDataFrame([("10,mw,3;bad,x;20.5,y",), (None,), ("x",), ("-4,a;",), ("1_000,a;5d,b;3,c",)], "Amounts string")
    got = [tuple(r) for r in articles.amount_stats(rows).drop("Amounts").collect()]
    assert got == [(15.25, 20.5, 2), (0.0, 0.0, 0), (0.0, 0.0, 0), (-4.0, -4.0, 1), (3.0, 3.0, 1)]


def test_impact_score(spark):
    import math

    schema = "avg_amount double, amount_count int, entity_count bigint, theme_Energy int, theme_Infrastructure int, theme_Environment int, tone_negative double"
    rows = [(9.0, 1, 5, 0, 0, 0, 3.0), (0.0, 0, 5, 0, 0, 0, 3.0), (0.0, 0, 0, 1, 1, 1, 2.0), (-3.0, 2, 5, 0, 0, 0, 0.0),
            (1e9, 1, 0, 1, 1, 1, 90.0), (0.0, 0, 0, 0, 0, 0, 9.0)]
    got = [r[0] for r in spark.createDataFrame(rows, schema).select(score.impact_score()).collect()]
    want = [1 + math.log1p(9), 1 + math.log1p(5), 2 * 1.5 * 1.3 * 2, None, 100.0, 1.0]
    assert got == pytest.approx(want)


def test_context_flags(spark):
    rows = spark.createDataFrame([(["oil_production", "peak_demand"],), ([],)], "themes array<string>")
    parity = articles.context_tags(rows).drop("themes").collect()
    full = articles.context_tags(rows, parity=False).drop("themes").collect()
    assert {k for k, v in parity[0].asDict().items() if v} == {"energy_supply", "energy_demand"}
    assert {k for k, v in full[0].asDict().items() if v} == {"energy_supply", "energy_demand", "fossil_fuel"}
    assert sum(full[1]) == 0


def test_day_period_wraps(spark):
    hours = list(range(24))
    got = values(spark, hours, clock.day_period(F.col("v")), "v int")
    assert got[0:5] == ["Night"] * 5 and got[5:12] == ["Morning"] * 7
    assert got[12:17] == ["Afternoon"] * 5 and got[17:22] == ["Evening"] * 5 and got[22:] == ["Night"] * 2


def test_season_codes(spark):
    days = [datetime(2023, m, 1) for m in range(1, 13)]
    got = values(spark, days, clock.season_code("v"), "v timestamp_ntz")
    assert got == [1, 1, 2, 2, 2, 3, 3, 3, 0, 0, 0, 1]


def test_location_filter_ignores_case_and_nulls(spark):
    rows = spark.createDataFrame(
        [(1, "new DELHI", None), (2, None, "x delhi"), (3, "Paris", None), (4, None, None)],
        "id int, Locations string, V2Locations string")
    assert [r.id for r in articles.location_filter(rows).orderBy("id").collect()] == [1, 2]


def test_conform_columns(spark):
    rows = spark.createDataFrame([(1, 0)], "theme_ENERGY int, theme_social int")
    assert articles.conform_columns(rows, ["theme_Energy", "theme_Social"]).columns == ["theme_Energy", "theme_Social"]
    with pytest.raises(ValueError, match="theme_Health"):
        articles.conform_columns(rows, ["theme_Health"])


def test_parse_time_column_falls_back_to_text(spark):
    rows = spark.createDataFrame([("a", "2024-01-01 00:05:00"), ("b", "bad")], "name string, moment string")
    got = articles.parse_time_column(rows).collect()
    assert [r.moment for r in got] == [datetime(2024, 1, 1, 0, 5)]
    with pytest.raises(ValueError):
        articles.parse_time_column(rows.select("name"))


def test_category_dictionary_is_complete():
    assert len(config.CATEGORIES) == 9 and len(config.RAW_COLUMNS) == 27 and len(config.FEATURE_COLUMNS) == 39
    assert len(config.ENERGY_KEYWORDS) == 32
