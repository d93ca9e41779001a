"""Article, weather and daily tables derived from ``events`` and ``orders``.

The text is Spark SQL; ``to_duckdb`` gives the same query for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalframe import config

K = "CAST(regexp_extract(props,'([0-9]+)',1) AS BIGINT) AS k"

ARTICLES = f"""
SELECT concat(date_format(ts,'yyyyMMddHHmmss'), '-', CAST(event_id AS STRING)) AS GKGRECORDID,
  CASE WHEN event_id % 97 = 0 THEN '20240230000000' WHEN event_id % 101 = 0 THEN '20240101'
       ELSE date_format(ts,'yyyyMMddHHmmss') END AS DATE,
  CASE WHEN event_id % 11 = 0 THEN NULL
       WHEN event_type = 'view' THEN concat('4#New DELHI, India#IN#', CAST(user_id AS STRING))
       ELSE '1#Paris#FR#0' END AS Locations,
  CASE WHEN event_type = 'click' THEN '4#Old Delhi, India#IN#9' ELSE NULL END AS V2Locations,
  CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 31 = 0 THEN 'TAX_FNCACT,55' ELSE concat(
    CASE k % 9 WHEN 0 THEN 'ELECTION' WHEN 1 THEN 'ECON_TAXES' WHEN 2 THEN 'RELIGION' WHEN 3 THEN 'ENV_OIL'
      WHEN 4 THEN 'POWER_OUTAGE' WHEN 5 THEN 'WB_TRANSPORT' WHEN 6 THEN 'HEALTH_PANDEMIC'
      WHEN 7 THEN 'EDU_SCHOOL' ELSE 'UNMAPPED_XYZ' END, ',', CAST(k AS STRING), ';',
    CASE WHEN event_type = 'error' THEN 'PROTEST,12;PROTEST,40;'
      WHEN event_type = 'click' THEN ' WATER_SUPPLY,7;CROP_PRODUCTION,9' ELSE '' END) END AS V2Themes,
  CASE WHEN event_id % 23 = 0 THEN NULL WHEN event_id % 17 = 0 THEN '1.0,2.0'
       WHEN event_id % 19 = 0 THEN 'a,b,c,d,e,f' ELSE concat(
    CAST(k - 50 AS STRING), '.25,', CAST(k % 13 AS STRING), '.5,', CAST(user_id % 11 AS STRING), '.75,',
    CAST(k % 17 AS STRING), '.5,', CAST(k % 29 AS STRING), '.25,', CAST(user_id % 7 AS STRING), '.5,',
    CAST(100 + k AS STRING)) END AS V2Tone,
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE concat('KILL#', CAST(k AS STRING), '##1;WOUND#',
    CAST(user_id AS STRING), '##1;kill#', CAST(k + 1 AS STRING), '##1;BAD#1.5#x') END AS Counts,
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE concat(CAST(k AS STRING), ',megawatt,12;oops,unit,1;',
    CAST(user_id * 100 AS STRING), ',rupees,40;') END AS Amounts
FROM (SELECT event_id, ts, user_id, event_type, {K} FROM events) e
"""

WEATHER = f"""
SELECT ts AS datetime, value AS `Power demand`, CAST(k AS DOUBLE) / 4 AS temp, CAST(k % 20 AS DOUBLE) AS dwpt,
  CASE WHEN event_id % 29 = 0 THEN NULL ELSE CAST(user_id % 101 AS DOUBLE) END AS rhum,
  CAST((user_id * 7) % 360 AS DOUBLE) AS wdir, CAST(k % 31 AS DOUBLE) / 2 AS wspd,
  1000.0E0 + CAST(k % 25 AS DOUBLE) AS pres, value AS moving_avg_3
FROM (SELECT event_id, ts, user_id, value, {K} FROM events) e
"""

DAILY = """
SELECT o_orderdate AS ts, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS target,
  CASE WHEN dayofmonth(o_orderdate) % 7 < 5 THEN NULL ELSE CAST(max(o_custkey) AS DOUBLE) END AS b, 1.0E0 AS c
FROM orders GROUP BY o_orderdate
"""


#: Records with a theme for each word of a document: hundreds of themes a record, and some in nearly all records.
WORDY = """
SELECT doc_id, concat(array_join(transform(filter(split(regexp_replace(text, '[^A-Za-z]+', ' '), ' '), w -> w <> ''),
    w -> concat(upper(w), ',', length(w))), ';'), ';') AS V2Themes FROM documents
"""

USER_SERIES = """
SELECT user_id, window(ts, '15 minutes').start AS time_bucket, count(*) AS article_count FROM events GROUP BY user_id, window(ts, '15 minutes')
"""

#: A row for every second that has events: more rows than one block of a series.
SECONDS = "SELECT CAST(date_trunc('second', ts) AS TIMESTAMP_NTZ) AS t, sum(CAST(value AS DECIMAL(18,4))) AS total FROM events GROUP BY 1"


def to_duckdb(sql: str) -> str:
    return sql.replace("date_format(ts,'yyyyMMddHHmmss')", "strftime(ts,'%Y%m%d%H%M%S')").replace("`", '"')


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derived(source: DataFrame, sql: str, name: str) -> DataFrame:
    return source.sparkSession.sql(sql.replace(f"FROM {name}", "FROM {source}"), source=source)


def derive(spark: SparkSession, sf_dir: str, sql: str, name: str) -> DataFrame:
    return derived(table(spark, sf_dir, name), sql, name)


def articles_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, ARTICLES, "events")


def weather_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, WEATHER, "events")


def daily_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, DAILY, "orders")


def raw_records(articles: DataFrame, *more) -> DataFrame:
    """Articles widened to all 27 raw columns."""
    have = set(articles.columns)
    return articles.select(*more, *[F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in config.RAW_COLUMNS])
