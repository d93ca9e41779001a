"""The registered queries in DuckDB SQL, written from the described results.

``STEPS`` are named sub-queries; ``oracle`` puts the ones a query needs in
front of it as a WITH list.
"""

from __future__ import annotations

import re

from signalframe import config
from signalframe.catalog import fixtures as fx

ID = "GKGRECORDID"
NUM = r" *[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)? *"
STEPS: dict[str, str] = {}
ORACLES: dict[str, str] = {}


def r(expr: str, name: str | None = None, places: int = 6) -> str:
    """Rounded, without negative zero."""
    name = name or expr.strip('"').split(".")[-1]
    return f'CASE WHEN round({expr}, {places}) = 0 THEN 0.0::DOUBLE ELSE round({expr}, {places}) END AS "{name}"'


def rs(*names: str) -> str:
    return ", ".join(r(f'"{n}"', n) for n in names)


def names(*columns: str) -> str:
    return ", ".join(f'"{c}"' for c in columns)


def with_steps(sql: str) -> str:
    """Prefix a query with the steps it mentions, directly or through other steps."""
    needed: list[str] = []

    def visit(body: str, seen: tuple[str, ...] = ()) -> None:
        for name, step in STEPS.items():
            if name not in needed and name not in seen and re.search(rf"\b(FROM|JOIN)\s+{name}\b", body):
                visit(step, (*seen, name))
                needed.append(name)

    visit(sql)
    return ("WITH " + ",\n".join(f"{n} AS ({STEPS[n]})" for n in needed) + "\n" if needed else "") + sql


def oracle(name: str, sql: str) -> None:
    ORACLES[name] = with_steps(sql)


# --- pieces --------------------------------------------------------------------

def category_case(text: str) -> str:
    """First category whose keywords occur in lower-case text."""
    tests = " ".join(f"WHEN regexp_matches({text}, '{'|'.join(w.lower() for w in words)}') THEN '{c}'"
                     for c, words in config.THEME_CATEGORIES.items())
    return f"CASE {tests} END"


def period_case(hour: str) -> str:
    return (f"CASE WHEN {hour} BETWEEN 5 AND 11 THEN 'Morning' WHEN {hour} BETWEEN 12 AND 16 THEN 'Afternoon' "
            f"WHEN {hour} BETWEEN 17 AND 21 THEN 'Evening' WHEN {hour} >= 22 OR {hour} <= 4 THEN 'Night' END")


def quarter(ts: str) -> str:
    return f"time_bucket(INTERVAL '15 minutes', {ts})"


def news_aggregates(columns: list[str]) -> list[str]:
    sql = {"sum": "coalesce(sum({0}), 0)", "mean": "avg({0})", "min": "min({0})", "max": "max({0})", "std": "stddev_samp({0})"}
    whole = {*FLAGS, "entity_count", "entity_variety", "amount_count", *config.CONTEXTS}
    out = []
    for c in columns:
        for kind in config.NEWS_AGGREGATES.get(c, []):
            expr = sql[kind].format(f'"{c}"')
            if c in whole and kind == "sum":
                expr = f"CAST({expr} AS BIGINT)"
            out.append(f'{expr} AS "{c}_{kind}"')
    return out


FLAGS = [f"theme_{c}" for c in config.CATEGORIES]
TONES = [f"tone_{m}" for m in config.TONE_METRICS]
ARTICLE_FEATURES = [*FLAGS, *TONES, "entity_count", "entity_variety", "avg_amount", "max_amount", "amount_count",
                    "energy_impact_score", "energy_amount", "infrastructure_amount", "environment_amount"]
NEWS_COLUMNS = [f"{c}_{k}" for c in config.NEWS_AGGREGATES if c in ARTICLE_FEATURES for k in config.NEWS_AGGREGATES[c]]
WHOLE_NEWS = [c for c in NEWS_COLUMNS if (c.startswith(("theme_", "entity_", "amount_count")) and not c.endswith("_mean"))]
REAL_NEWS = [c for c in NEWS_COLUMNS if c not in WHOLE_NEWS]
WEATHER_COLUMNS = ["Power demand_sum", "temp_mean", "temp_min", "temp_max", "dwpt_mean", "rhum_mean", "wdir_mean",
                   "wspd_mean", "wspd_max", "pres_mean"]
TARGET = "Power demand_sum"

# --- steps: inputs ----------------------------------------------------------------

STEPS["art"] = fx.to_duckdb(fx.ARTICLES)
STEPS["wx"] = fx.to_duckdb(fx.WEATHER)
STEPS["daily"] = fx.to_duckdb(fx.DAILY)
STEPS["located"] = """SELECT * FROM art
  WHERE coalesce(regexp_matches(Locations, '(?i)delhi'), false) OR coalesce(regexp_matches(V2Locations, '(?i)delhi'), false)"""


def dated(source: str) -> str:
    stamp = "lpad(DATE, 14, '0')"
    return f"""SELECT * FROM (SELECT *, CASE WHEN regexp_full_match({stamp}, '[0-9]{{14}}')
    THEN try_strptime({stamp}, '%Y%m%d%H%M%S') END AS datetime FROM {source}) WHERE datetime IS NOT NULL"""


def parsed(source: str) -> str:
    """Flags, tone, entities and amounts of every row of a table."""
    flags = ", ".join(f"CAST(coalesce(list_contains(cats, '{c}'), false) AS INTEGER) AS theme_{c}" for c in config.CATEGORIES)
    tones = ", ".join(f"CASE WHEN tone_ok THEN CAST(string_split(V2Tone, ',')[{i + 1}] AS DOUBLE) ELSE 0.0 END AS tone_{m}"
                      for i, m in enumerate(config.TONE_METRICS))
    category = category_case("lower(split_part(x, ',', 1))")
    return f"""SELECT * EXCLUDE (cats, tone_ok, nums, ents),
    {flags}, {tones},
    CAST(coalesce(list_sum(ents), 0) AS BIGINT) AS entity_count, CAST(len(ents) AS INTEGER) AS entity_variety,
    CASE WHEN len(nums) > 0 THEN list_avg(nums) ELSE 0.0 END AS avg_amount,
    CASE WHEN len(nums) > 0 THEN list_max(nums) ELSE 0.0 END AS max_amount,
    CAST(len(nums) AS INTEGER) AS amount_count
  FROM (SELECT s.*,
      list_transform(list_filter(string_split(V2Themes, ';'), lambda x: x <> ''), lambda x: {category}) AS cats,
      coalesce(regexp_matches(V2Tone, '^({NUM},){{5}}{NUM}(,|$)'), false) AS tone_ok,
      coalesce(list_filter(list_transform(string_split(Amounts, ';'), lambda x:
        CASE WHEN regexp_full_match(split_part(x, ',', 1), '{NUM}') THEN CAST(split_part(x, ',', 1) AS DOUBLE) END),
        lambda v: v IS NOT NULL), []) AS nums,
      coalesce(e.ents, []) AS ents
    FROM {source} s LEFT JOIN (
      SELECT {ID}, list(n) AS ents FROM (
        SELECT {ID}, lower(split_part(x, '#', 1)) AS entity, arg_max(CAST(split_part(x, '#', 2) AS BIGINT), i) AS n
        FROM (SELECT {ID}, unnest(string_split(Counts, ';')) AS x, generate_subscripts(string_split(Counts, ';'), 1) AS i FROM {source})
        WHERE regexp_full_match(split_part(x, '#', 2), ' *[+-]?[0-9]+ *') GROUP BY ALL)
      GROUP BY {ID}) e USING ({ID}))"""


def scored(source: str) -> str:
    return f"""SELECT *, CASE WHEN raw IS NOT NULL THEN least(raw, 100.0) END AS energy_impact_score,
    theme_Energy * avg_amount AS energy_amount, theme_Infrastructure * avg_amount AS infrastructure_amount,
    theme_Environment * avg_amount AS environment_amount, CAST(1 AS INTEGER) AS article_count
  FROM (SELECT *,
    (CASE WHEN amount_count > 0 THEN (CASE WHEN avg_amount > -1 THEN 1 + ln(1 + least(avg_amount, 10000)) END)
          WHEN entity_count > 0 THEN 1 + ln(1 + least(entity_count, 1000)) ELSE 1.0 END)
    * CASE WHEN theme_Energy > 0 THEN 2.0 ELSE 1.0 END * CASE WHEN theme_Infrastructure > 0 THEN 1.5 ELSE 1.0 END
    * CASE WHEN theme_Environment > 0 THEN 1.3 ELSE 1.0 END
    * CASE WHEN theme_Energy > 0 AND tone_negative > 0 THEN 1 + tone_negative * 0.5 ELSE 1.0 END AS raw FROM {source})"""


def context_columns(themes: str, parity: bool) -> str:
    cols = []
    for name, words in config.CONTEXT_KEYWORDS.items():
        if parity and name not in config.PARITY_CONTEXTS:
            cols.append(f"CAST(0 AS INTEGER) AS {name}")
        else:
            hits = f"list_filter({themes}, lambda t: regexp_matches(t, '{'|'.join(words)}'))"
            cols.append(f"CAST(coalesce(len({hits}) > 0, false) AS INTEGER) AS {name}")
    return ", ".join(cols)


LOWER_THEMES = "list_transform(list_filter(string_split(V2Themes, ';'), lambda x: x <> ''), lambda x: lower(split_part(x, ',', 1)))"

STEPS["art_dated"] = dated("art")
STEPS["loc_dated"] = dated("located")
STEPS["parsed_all"] = parsed("art")
STEPS["parsed_dated"] = parsed("art_dated")
STEPS["parsed_loc"] = parsed("loc_dated")
STEPS["full_dated"] = scored("parsed_dated")
STEPS["full_loc"] = scored("parsed_loc")
STEPS["news"] = (f"SELECT {quarter('datetime')} AS time_bucket, {', '.join(news_aggregates(ARTICLE_FEATURES))}, "
                 "count(*) AS article_count FROM full_loc GROUP BY 1")
STEPS["weather"] = f"""SELECT {quarter('datetime')} AS timestamp, sum("Power demand") AS "Power demand_sum",
  avg(temp) AS temp_mean, min(temp) AS temp_min, max(temp) AS temp_max, avg(dwpt) AS dwpt_mean, avg(rhum) AS rhum_mean,
  avg(wdir) AS wdir_mean, avg(wspd) AS wspd_mean, max(wspd) AS wspd_max, avg(pres) AS pres_mean FROM wx GROUP BY 1"""
STEPS["merged"] = f"""SELECT timestamp AS datetime, {', '.join(f'coalesce("{c}", 0) AS "{c}"' for c in WEATHER_COLUMNS)},
  {', '.join(f'coalesce("{c}", 0) AS "{c}"' for c in [*NEWS_COLUMNS, 'article_count'])}
  FROM weather JOIN news ON timestamp = time_bucket"""

INDICATORS = ["tone_volatility", "energy_event_magnitude", "energy_impact_index", "energy_crisis_indicator",
              "weather_alert_indicator", "social_event_indicator", "infrastructure_stress",
              "political_crisis_indicator", "economic_impact_indicator"]
STEPS["indicated"] = """SELECT *, tone_tone_max - tone_tone_min AS tone_volatility,
  theme_Energy_sum * CASE WHEN avg_amount_sum > -1 THEN ln(1 + avg_amount_sum) END AS energy_event_magnitude,
  energy_impact_score_sum AS energy_impact_index,
  theme_Energy_sum * tone_negative_max AS energy_crisis_indicator,
  theme_Environment_sum * abs(tone_tone_min) AS weather_alert_indicator,
  theme_Social_sum * article_count / 100 AS social_event_indicator,
  theme_Infrastructure_sum * tone_negative_max AS infrastructure_stress,
  theme_Political_sum * tone_negative_max AS political_crisis_indicator,
  theme_Economic_sum * (tone_tone_max - tone_tone_min) AS economic_impact_indicator FROM news"""


def calendar(ts: str) -> str:
    dow = f"(isodow({ts}) - 1)"
    return f"""CAST(hour({ts}) AS INTEGER) AS hour, CAST({dow} AS INTEGER) AS day_of_week,
  CAST({dow} >= 5 AS INTEGER) AS is_weekend, CAST(hour({ts}) BETWEEN 9 AND 17 AND {dow} < 5 AS INTEGER) AS is_business_hours,
  CAST(month({ts}) AS INTEGER) AS month, CAST(day({ts}) AS INTEGER) AS day,
  sin(2 * pi() * hour({ts}) / 24) AS hour_sin, cos(2 * pi() * hour({ts}) / 24) AS hour_cos,
  sin(2 * pi() * {dow} / 7) AS day_of_week_sin, cos(2 * pi() * {dow} / 7) AS day_of_week_cos"""


CALENDAR = ["hour", "day_of_week", "is_weekend", "is_business_hours", "month", "day"]
CYCLES = ["hour_sin", "hour_cos", "day_of_week_sin", "day_of_week_cos"]
STEPS["voluminous"] = """SELECT *, coalesce(lag(article_count) OVER w, 0) AS prev_article_count,
  article_count - coalesce(lag(article_count) OVER w, 0) AS article_count_change,
  CAST(coalesce(count(*) OVER w12 = 12 AND article_count > 1.5 * avg(article_count) OVER w12, false) AS INTEGER) AS article_volume_spike
  FROM indicated WINDOW w AS (ORDER BY time_bucket), w12 AS (ORDER BY time_bucket ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)"""
STEPS["features"] = f"SELECT {names(*config.FEATURE_COLUMNS)} FROM (SELECT *, {calendar('time_bucket')} FROM voluminous)"
STEPS["spine"] = """SELECT unnest(generate_series(a, b, INTERVAL '15 minutes')) AS time_bucket
  FROM (SELECT min(time_bucket) AS a, max(time_bucket) AS b FROM news)"""


def filled(table: str, carried: list[str], zeroed: list[str]) -> str:
    cols = [f'coalesce("{c}", 0) AS "{c}"' for c in zeroed] + [
        f'coalesce(last_value("{c}" IGNORE NULLS) OVER f, first_value("{c}" IGNORE NULLS) OVER b, 0) AS "{c}"' for c in carried]
    return f"""SELECT time_bucket, {', '.join(cols)} FROM spine LEFT JOIN {table} USING (time_bucket)
  WINDOW f AS (ORDER BY time_bucket ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         b AS (ORDER BY time_bucket ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"""


KEPT = [c for c in config.FEATURE_COLUMNS if c != "time_bucket"]
KEPT_ZEROED = [c for c in KEPT if c.endswith("_sum") or c == "article_count"]
KEPT_CARRIED = [c for c in KEPT if c not in KEPT_ZEROED]
KEPT_WHOLE = ["article_count", "article_count_change", "article_volume_spike",
              *[c for c in KEPT if c in WHOLE_NEWS], *CALENDAR]
KEPT_REAL = [c for c in KEPT if c not in KEPT_WHOLE]
STEPS["dense"] = filled("features", KEPT_CARRIED, KEPT_ZEROED)

STEPS["mentions"] = """SELECT *, CASE WHEN contains(V2Themes, ';') THEN string_split(V2Themes, ';') ELSE string_split(V2Themes, ',') END AS parts
  FROM art"""
STEPS["mention"] = """SELECT DATE, split_part(trim(x), ',', 1) AS theme
  FROM (SELECT DATE, unnest(parts) AS x FROM mentions) WHERE trim(x) <> ''"""
STEPS["themes"] = "SELECT theme, count(*) AS n FROM mention GROUP BY theme"
STEPS["categories"] = "SELECT unnest([" + ", ".join(f"'{c}'" for c in config.CATEGORIES) + "]) AS category"
STEPS["period_rows"] = f"""SELECT period, category, count(*) AS n FROM (
  SELECT {period_case('hour(datetime)')} AS period, {category_case('lower(theme)')} AS category
  FROM (SELECT *, CASE WHEN regexp_full_match(lpad(DATE, 14, '0'), '[0-9]{{14}}')
      THEN try_strptime(lpad(DATE, 14, '0'), '%Y%m%d%H%M%S') END AS datetime FROM mention)
  WHERE datetime IS NOT NULL) GROUP BY ALL"""
STEPS["periods"] = f"""SELECT p.period, c.category, coalesce(n, 0) AS n
  FROM (SELECT DISTINCT {period_case('hour(datetime)')} AS period FROM art_dated) p CROSS JOIN categories c
  LEFT JOIN period_rows k ON k.period = p.period AND k.category = c.category"""

STEPS["predicted"] = """SELECT * FROM (SELECT ts, actual, lag(actual) OVER (ORDER BY ts) AS predicted
    FROM (SELECT ts, (target - min(target) OVER ()) / (max(target) OVER () - min(target) OVER ()) AS actual FROM daily))
  WHERE predicted IS NOT NULL"""
STEPS["errors"] = """SELECT *, actual - predicted AS error, abs(actual - predicted) AS abs_error,
  CASE WHEN actual <> 0 THEN (actual - predicted) / actual * 100 END AS percent_error FROM predicted"""
STEPS["months_test"] = """SELECT y, m FROM (
  SELECT y, m, row_number() OVER (PARTITION BY y ORDER BY md5(concat('42-', y, '-', m))) AS rk, count(*) OVER (PARTITION BY y) AS k
  FROM (SELECT DISTINCT year(ts) AS y, month(ts) AS m FROM daily)) WHERE rk <= greatest(1, floor(k * 0.2))"""
STEPS["by_month"] = """SELECT d.*, CASE WHEN t.y IS NULL THEN 'train' ELSE 'test' END AS part
  FROM daily d LEFT JOIN months_test t ON t.y = year(ts) AND t.m = month(ts)"""
STEPS["by_draw"] = """SELECT *, CASE WHEN substr(md5('42-' || strftime(ts, '%Y-%m-%d %H:%M:%S')), 1, 8) < '33333333'
  THEN 'test' ELSE 'train' END AS part FROM daily"""
STEPS["by_season"] = """SELECT * EXCLUDE (y, season, pos, k),
  CASE WHEN pos >= k // 2 - CAST(floor(k * 0.2) AS BIGINT) // 2
        AND pos < k // 2 - CAST(floor(k * 0.2) AS BIGINT) // 2 + CAST(floor(k * 0.2) AS BIGINT) THEN 'test' ELSE 'train' END AS part
  FROM (SELECT *, row_number() OVER (PARTITION BY y, season ORDER BY ts) - 1 AS pos, count(*) OVER (PARTITION BY y, season) AS k
    FROM (SELECT *, year(ts) AS y, ((month(ts) % 12 + 3) // 3) % 4 AS season FROM daily))"""

# --- scans, sources, sinks -----------------------------------------------------------

have = [ID, "DATE", "Locations", "V2Locations", "V2Themes", "V2Tone", "Counts", "Amounts"]
oracle("scan_gkg_tsv", "SELECT " + ", ".join(c if c in have else f"CAST(NULL AS VARCHAR) AS {c}" for c in config.RAW_COLUMNS) + " FROM art")
ORACLES["scan_gkg_zip"] = ORACLES["scan_gkg_tsv"]
oracle("scan_csv_table", f"SELECT ts, n, {rs('target', 'b', 'c')} FROM daily")
oracle("parse_time_column", f"""SELECT date_trunc('second', datetime) AS datetime, {r('"Power demand"', 'power')}, {rs('temp')} FROM wx WHERE dwpt <> 7""")
oracle("conform_columns", f"SELECT datetime, {ID}, {names(*[f'theme_{c}' for c in config.LOAD_CATEGORIES])} FROM parsed_dated")
oracle("union_batches", f"""SELECT {ID}, DATE, V2Tone, CAST(NULL AS VARCHAR) AS Counts FROM art WHERE V2Locations IS NOT NULL
UNION ALL BY NAME SELECT {ID}, DATE, Counts FROM art WHERE V2Locations IS NULL
UNION ALL BY NAME SELECT {ID}, V2Locations FROM art""")
STEPS["intervals"] = """SELECT t AS interval_start, strftime(t, '%Y%m%d%H%M%S') AS stamp, strftime(t, '%Y%m%d%H%M%S') || '.gkg.csv.zip' AS file_name
  FROM (SELECT unnest(generate_series(a, b, INTERVAL '15 minutes')) AS t
    FROM (SELECT date_trunc('day', min(ts)) AS a, date_trunc('day', max(ts)) + INTERVAL '1 day' - INTERVAL '15 minutes' AS b FROM events))"""
oracle("interval_manifest", "SELECT CAST(interval_start AS TIMESTAMP) AS interval_start, stamp, file_name FROM intervals")
oracle("batch_plan", """SELECT CAST(s AS DATE) AS batch_start, CAST(least(s + INTERVAL '90 days', b) AS DATE) AS batch_end,
  'batch_' || strftime(s, '%Y%m%d') || '_to_' || strftime(least(s + INTERVAL '90 days', b), '%Y%m%d') || '.csv' AS file_name
FROM (SELECT unnest(generate_series(a, b, INTERVAL '91 days')) AS s, b
  FROM (SELECT date_trunc('day', min(o_orderdate))::TIMESTAMP AS a, date_trunc('day', max(o_orderdate))::TIMESTAMP AS b FROM orders))""")
oracle("resume_point", """SELECT CAST(max(e) AS DATE) AS last_end, CAST(max(e) + INTERVAL '1 day' AS DATE) AS next_start
FROM (SELECT max(o_orderdate) AS e FROM orders GROUP BY o_custkey HAVING o_custkey % 5 <> 0)""")
oracle("pending_files", f"""SELECT md5(file_name) AS file_key, CAST(interval_start AS TIMESTAMP) AS interval_start, stamp, file_name FROM intervals
WHERE interval_start NOT IN (SELECT {quarter('datetime')} FROM loc_dated)""")
oracle("write_table", f"""SELECT ts, n, {rs('target', 'b')}, CAST(year(ts) AS INTEGER) AS year FROM daily
UNION ALL SELECT ts, n, {rs('target', 'b')}, CAST(year(ts) AS INTEGER) FROM daily WHERE b IS NOT NULL""")
runs = [("month_based", "20240101_000000", "by_month"), ("month_based", "20240102_000000", "by_month"), ("fully_random", "20240101_000000", "by_draw")]


def run_rows(kept) -> str:
    return " UNION ALL ".join(f"SELECT '{s}' AS strategy, '{label}' AS run, part, ts, n, {rs('target')} FROM {t}" for s, label, t in kept)


oracle("write_split_tables", run_rows(runs))
oracle("latest_run", run_rows(runs[1:]))

# --- per-record work --------------------------------------------------------------------

oracle("location_filter", f"SELECT {ID}, Locations, V2Locations FROM located")
oracle("event_time", f"SELECT {ID}, DATE, datetime FROM art_dated")
oracle("row_sample_half", f"""SELECT * FROM (SELECT l_orderkey::VARCHAR || '-' || l_linenumber::VARCHAR AS line, l_partkey FROM lineitem)
ORDER BY md5('{config.SEED}-' || line), line LIMIT (SELECT count(*) // 2 FROM lineitem)""")
oracle("row_sample", f"""(SELECT {ID}, DATE, 'first' AS kind FROM art ORDER BY {ID} LIMIT 500)
UNION ALL (SELECT {ID}, DATE, 'random' AS kind FROM art ORDER BY md5('42-' || {ID}), {ID} LIMIT 500)""")
oracle("record_themes", f"SELECT DISTINCT {ID}, theme FROM (SELECT {ID}, unnest({LOWER_THEMES}) AS theme FROM art)")
oracle("theme_flags", f"SELECT {ID}, {names(*FLAGS)} FROM parsed_all")
oracle("tone_metrics", f"SELECT {ID}, {rs(*TONES)} FROM parsed_all")
oracle("entity_counts", f"SELECT {ID}, entity_count, entity_variety FROM parsed_all")
oracle("amount_stats", f"SELECT {ID}, {rs('avg_amount', 'max_amount')}, amount_count FROM parsed_all")
oracle("impact_score", f"SELECT {ID}, {rs('energy_impact_score')} FROM full_dated")
oracle("context_tags", f"""SELECT {ID}, true AS parity, {context_columns(LOWER_THEMES, True)} FROM art
UNION ALL SELECT {ID}, false AS parity, {context_columns(LOWER_THEMES, False)} FROM art""")
oracle("amount_interactions", f"SELECT {ID}, article_count, {rs('energy_amount', 'infrastructure_amount', 'environment_amount')} FROM full_dated")
plain = [c for c in config.FEATURE_COLUMNS if c not in ("article_count_change", "article_volume_spike")]
plain_real = [c for c in plain if c in KEPT_REAL]
oracle("select_features", f"""SELECT {names(*[c for c in plain if c not in plain_real])}, {rs(*plain_real)}
FROM (SELECT *, {calendar('time_bucket')} FROM indicated)""")
oracle("calendar_features", f"SELECT event_id, ts, {names(*CALENDAR)}, {rs(*CYCLES)} FROM (SELECT event_id, ts, {calendar('ts')} FROM events)")
oracle("model_time_features", f"""SELECT o_orderkey, o_orderdate, CAST(hour(o_orderdate) AS INTEGER) AS hour,
  CAST(isodow(o_orderdate) - 1 AS INTEGER) AS dayofweek, CAST(month(o_orderdate) AS INTEGER) AS month,
  CAST(dayofyear(o_orderdate) AS INTEGER) AS dayofyear, CAST(isodow(o_orderdate) >= 6 AS INTEGER) AS is_weekend,
  CAST(hour(o_orderdate) // 6 AS INTEGER) AS quarter_of_day,
  {r('sin(2 * pi() * hour(o_orderdate) / 24)', 'hour_sin')}, {r('cos(2 * pi() * hour(o_orderdate) / 24)', 'hour_cos')},
  {r('sin(2 * pi() * dayofyear(o_orderdate) / 365)', 'day_of_year_sin')}, {r('cos(2 * pi() * dayofyear(o_orderdate) / 365)', 'day_of_year_cos')}
FROM orders""")
oracle("day_period", f"SELECT {period_case('hour(datetime)')} AS time_period, count(*) AS n FROM art_dated GROUP BY 1")
oracle("crisis_indicators", f"SELECT time_bucket, {rs(*INDICATORS)} FROM indicated")
oracle("crisis_indicators_fallback", f"""SELECT {quarter('datetime')} AS time_bucket, 0.0::DOUBLE AS tone_volatility,
  {r('CAST(sum(theme_Energy) AS DOUBLE) * count(*)', 'energy_event_magnitude')}, {r('CAST(sum(theme_Energy) AS DOUBLE) * 0.5', 'energy_crisis_indicator')},
  {r('CAST(sum(theme_Environment) AS DOUBLE) * 0.5', 'weather_alert_indicator')}, 0.0::DOUBLE AS social_event_indicator,
  0.0::DOUBLE AS infrastructure_stress, 0.0::DOUBLE AS political_crisis_indicator, 0.0::DOUBLE AS economic_impact_indicator
FROM parsed_dated GROUP BY 1""")
oracle("context_indicators", f"""SELECT {quarter('datetime')} AS time_bucket,
  {r('CAST(sum(energy_supply) AS DOUBLE) * max(tone_negative)', 'supply_disruption_indicator')},
  CAST(sum(energy_demand) * count(*) AS BIGINT) AS demand_spike_indicator,
  {r('CAST(sum(energy_price) AS DOUBLE) * (max(tone_tone) - min(tone_tone))', 'price_volatility_indicator')},
  {r('CAST(sum(energy_infrastructure) AS DOUBLE) * max(tone_negative)', 'infrastructure_failure_indicator')},
  CAST(sum(weather_event) AS BIGINT) AS weather_impact_indicator
FROM (SELECT *, {context_columns(LOWER_THEMES, False)} FROM full_dated) GROUP BY 1""")
oracle("prediction_errors", f"SELECT ts, {rs('actual', 'predicted', 'error', 'abs_error', 'percent_error')} FROM errors")

# --- joins ---------------------------------------------------------------------------------

weather_plain = [c for c in WEATHER_COLUMNS if c != "temp_mean"]
oracle("merge_on_time", f"""SELECT time_bucket, article_count, theme_Energy_sum, {r('tone_tone_mean', 'temp_mean')},
  {r('weather.temp_mean', 'temp_mean_weather')}, {rs(*weather_plain)} FROM news JOIN weather ON time_bucket = timestamp""")
oracle("range_overlap", """SELECT s AS overlap_start, e AS overlap_end,
  (SELECT count(*) FROM news WHERE time_bucket BETWEEN s AND e) AS left_rows,
  (SELECT count(*) FROM weather WHERE timestamp BETWEEN s AND e) AS right_rows
FROM (SELECT greatest(a, c) AS s, least(b, d) AS e
  FROM (SELECT min(time_bucket) AS a, max(time_bucket) AS b FROM news),
       (SELECT min(timestamp) AS c, max(timestamp) AS d FROM weather))""")
oracle("merge_zero_filled", f"""SELECT time_bucket AS datetime, article_count, {r('coalesce(tone_tone_std, 0)', 'tone_tone_std')},
  {r('coalesce(tone_tone_mean, 0)', 'temp_mean_y')}, {r('coalesce(temp_mean, 0)', 'temp_mean_x')},
  {', '.join(r(f'coalesce("{c}", 0)', c) for c in weather_plain)} FROM news JOIN weather ON time_bucket = timestamp""")
oracle("densify_spine", f"""SELECT CAST(time_bucket AS TIMESTAMP) AS time_bucket, article_count, theme_Energy_sum, {r('tone_tone_mean', 'temp_mean')}
FROM spine LEFT JOIN news USING (time_bucket)""")
oracle("new_records", f"SELECT {ID}, DATE, V2Tone FROM art WHERE {ID} NOT IN (SELECT {ID} FROM loc_dated)")

# --- aggregations ---------------------------------------------------------------------------

contexts = ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}_sum, max({c}) AS {c}_max" for c in config.CONTEXTS)
oracle("bucket_news_15min", f"""SELECT time_bucket, article_count, {names(*WHOLE_NEWS)}, {rs(*REAL_NEWS)}, c.* EXCLUDE (tb)
FROM news JOIN (SELECT {quarter('datetime')} AS tb, {contexts} FROM (SELECT *, {context_columns(LOWER_THEMES, True)} FROM full_loc) GROUP BY 1) c
ON c.tb = time_bucket""")
parts = [f"{r(e.format(c), f'{c}_{k}')}" for c in ("tone_tone", "avg_amount")
         for k, e in (("sum", "sum({0})"), ("mean", "avg({0})"), ("min", "min({0})"), ("max", "max({0})"), ("std", "stddev_samp({0})"))]
oracle("merge_partials", f"SELECT time_bucket(INTERVAL '1 hour', datetime) AS time_bucket, count(*) AS article_count, {', '.join(parts)} FROM full_dated GROUP BY 1")
oracle("bucket_weather_15min", f"""SELECT timestamp, {rs(*WEATHER_COLUMNS)}, {rs('cloud_mean')}
FROM weather JOIN (SELECT {quarter('datetime')} AS t, avg(pres - temp) AS cloud_mean FROM wx GROUP BY 1) ON t = timestamp""")
oracle("theme_counts", "SELECT theme, n FROM themes")
oracle("unique_themes", "SELECT count(*) AS themes, CAST(sum(n) AS BIGINT) AS mentions FROM themes")
STEPS["wordy"] = """SELECT upper(w) AS theme, count(*) AS n
  FROM (SELECT unnest(string_split(regexp_replace(text, '[^A-Za-z]+', ' ', 'g'), ' ')) AS w FROM documents) WHERE w <> '' GROUP BY 1"""
oracle("wordy_theme_counts", "SELECT theme, n FROM wordy")
CATEGORY_TOTALS = f"""SELECT c.category, CAST(coalesce(sum(t.n), 0) AS BIGINT) AS n FROM categories c
  LEFT JOIN (SELECT {category_case('lower(theme)')} AS category, n FROM themes) t ON t.category = c.category GROUP BY 1"""
oracle("category_counts", f"""SELECT category, n, {r('CASE WHEN sum(n) OVER () > 0 THEN n * 100.0::DOUBLE / sum(n) OVER () ELSE 0.0 END', 'pct')}
FROM ({CATEGORY_TOTALS})""")
oracle("wordy_category_counts", f"""SELECT category, n, {r('CASE WHEN sum(n) OVER () > 0 THEN n * 100.0::DOUBLE / sum(n) OVER () ELSE 0.0 END', 'pct')}
FROM ({CATEGORY_TOTALS.replace('themes', 'wordy')})""")
STEPS["energy_themes"] = f"SELECT theme, n FROM themes WHERE regexp_matches(upper(theme), '{'|'.join(config.ENERGY_KEYWORDS)}')"
oracle("keyword_themes", "SELECT theme, n FROM energy_themes")
flag_rows = " UNION ALL ".join(f"SELECT period, '{c}' AS category, CAST(sum(theme_{c}) AS BIGINT) AS n FROM spans GROUP BY 1" for c in config.CATEGORIES)
STEPS["spans"] = f"SELECT {period_case('hour(datetime)')} AS period, * FROM parsed_dated UNION ALL SELECT 'All', * FROM parsed_dated"
oracle("flag_category_sums", flag_rows)
oracle("period_category_counts", "SELECT period, category, n FROM periods")
shares = ", ".join(r(f"CASE WHEN sum({p}) OVER () > 0 THEN {p} / sum({p}) OVER () END", p) for p in config.DAY_PERIODS)
wide = ", ".join(f"CAST(sum(n) FILTER (period = '{p}') AS DOUBLE) AS {p}" for p in config.DAY_PERIODS)
oracle("period_category_pivot", f"""SELECT category, {shares}, total, row_number() OVER (ORDER BY total DESC, category)::INTEGER AS rank
FROM (SELECT category, {wide}, CAST(sum(n) AS BIGINT) AS total FROM periods GROUP BY category)""")
profile_columns = [*have, "datetime", *FLAGS, *TONES, "entity_count", "entity_variety", "avg_amount", "max_amount",
                   "amount_count", "energy_impact_score", "article_count", "energy_amount", "infrastructure_amount", "environment_amount"]
counted = {"records": "count(*)", **{f"null_{c}": f"count(*) - count({c})" for c in profile_columns},
           **{f"flag_{c}": f"sum({c})" for c in FLAGS}, "extreme_tone": "count(*) FILTER (abs(tone_tone) > 10)",
           "no_theme": f"count(*) FILTER ({' + '.join(FLAGS)} = 0)"}
valued = {"first_time": "epoch(min(datetime))", "last_time": "epoch(max(datetime))", "tone_mean": "avg(tone_tone)",
          "tone_mean_all_rows": "sum(tone_tone) / count(*)", "tone_min": "min(tone_tone)", "tone_max": "max(tone_tone)",
          "positive_max": "max(tone_positive)", "negative_max": "max(tone_negative)"}
pairs = [f"{{'metric': '{k}', 'value': CAST({e} AS DOUBLE), 'pct': {f'CAST({e} AS DOUBLE) * 100 / count(*)' if k in counted else 'CAST(NULL AS DOUBLE)'}}}"
         for k, e in {**counted, **valued}.items()]
oracle("quality_profile", f"""SELECT m.metric AS metric, {r('m.value', 'value')}, {r('m.pct', 'pct')}
FROM (SELECT unnest([{', '.join(pairs)}]) AS m FROM full_dated)""")
oracle("records_by_month", f"""SELECT level, label, n, {r('n * 100.0::DOUBLE / sum(n) OVER (PARTITION BY level)', 'pct')} FROM (
  SELECT 'month' AS level, strftime(o_orderdate, '%Y-%m') AS label, count(*) AS n FROM orders GROUP BY ALL
  UNION ALL SELECT 'year', strftime(o_orderdate, '%Y'), count(*) FROM orders GROUP BY ALL)""")
nulls = " UNION ALL ".join(f"SELECT '{c}' AS feature, count(*) - count({c}) AS nulls, count(*) AS rows FROM art" for c in have)
oracle("null_counts", f"""SELECT feature, nulls, {r('nulls::DOUBLE / rows', 'fraction')} FROM ({nulls})
UNION ALL SELECT '(all)', CAST(sum(nulls) AS BIGINT), {r('sum(nulls)::DOUBLE / sum(rows)', 'fraction')} FROM ({nulls})""")


def statistics(table: str, columns: list[str], quartiles: bool) -> str:
    def one(c: str) -> str:
        x = f'CAST("{c}" AS DOUBLE)'
        cols = [f"'{c}' AS feature", r(f"avg({x})", "mean"), r(f"min({x})", "min"), r(f"max({x})", "max"), r(f"stddev_samp({x})", "std")]
        if quartiles:
            cols += [f"count({x}) AS count"] + [r(f"quantile_cont({x}, {p})", f"q{round(p * 100)}") for p in (0.25, 0.5, 0.75)]
        else:
            cols.append(f"count(*) - count({x}) AS missing")
        return f"SELECT {', '.join(cols)} FROM {table}"
    return " UNION ALL ".join(one(c) for c in columns)


oracle("feature_statistics", statistics("news", [*NEWS_COLUMNS, "article_count"], False))
oracle("describe", statistics("wx", ["Power demand", "temp", "dwpt", "rhum", "wdir", "wspd", "pres", "moving_avg_3"], True))


def cells(table: str, key: str, columns: list[str]) -> str:
    listed = ", ".join(f"{{'c': {i}, 'v': CAST(\"{c}\" AS DOUBLE)}}" for i, c in enumerate(columns))
    return f"SELECT {key} AS k, u.c AS c, u.v AS v FROM (SELECT {key}, unnest([{listed}]) AS u FROM {table}) WHERE u.v IS NOT NULL"


def pair_table(cell_table: str, columns: list[str]) -> str:
    listed = "[" + ", ".join(f"'{c}'" for c in columns) + "]"
    return f"""SELECT {listed}[a.c + 1] AS feature_a, {listed}[b.c + 1] AS feature_b,
  CASE WHEN min(a.v) < max(a.v) AND min(b.v) < max(b.v) THEN corr(a.v, b.v) END AS r
  FROM {cell_table} a JOIN {cell_table} b ON a.k = b.k AND a.c < b.c GROUP BY a.c, b.c"""


NEWS_ALL, BOTH = [*NEWS_COLUMNS, "article_count"], [*NEWS_COLUMNS, "article_count", *WEATHER_COLUMNS]
STEPS["joined"] = "SELECT * FROM news JOIN weather ON time_bucket = timestamp"
STEPS["joined_cells"] = cells("joined", "time_bucket", BOTH)
STEPS["news_cells"] = cells("news", "time_bucket", NEWS_ALL)
STEPS["news_pairs"] = pair_table("news_cells", NEWS_ALL)
oracle("correlation_matrix", f"SELECT feature_a, feature_b, {rs('r')} FROM ({pair_table('joined_cells', BOTH)})")
MERGED_ALL = [*WEATHER_COLUMNS, *NEWS_COLUMNS, "article_count"]
STEPS["against_target"] = " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, CASE WHEN min("{c}") < max("{c}") THEN corr("{c}", "{TARGET}") END AS r FROM merged""" for c in MERGED_ALL)
oracle("target_correlation", f"SELECT feature, {rs('r')} FROM against_target")
oracle("correlated_pairs", f"SELECT feature_a, feature_b, {rs('r')} FROM news_pairs WHERE abs(r) > 0.8 AND round(r, 9) <> 1")
oracle("hour_and_dow_profile", f"""SELECT 'hour' AS kind, CAST(hour(time_bucket) AS INTEGER) AS slot, {r('avg(article_count)', 'mean_value')} FROM news GROUP BY ALL
UNION ALL SELECT 'day_of_week', CAST(isodow(time_bucket) - 1 AS INTEGER), {r('avg(article_count)', 'mean_value')} FROM news GROUP BY ALL""")
oracle("split_month_profile", """SELECT CAST(m AS INTEGER) AS month, coalesce(train, 0) AS train, coalesce(test, 0) AS test
FROM (SELECT unnest(range(1, 13)) AS m) LEFT JOIN
  (SELECT month(ts) AS k, count(*) FILTER (part = 'train') AS train, count(*) FILTER (part = 'test') AS test FROM by_month GROUP BY 1) ON k = m""")


def binned(table: str, value: str, bins: int) -> str:
    """Bin counts; a single value gets a range of one around it."""
    source = f"(SELECT CAST({value} AS DOUBLE) AS v FROM {table})"
    edges = f"(SELECT min(v) - CASE WHEN min(v) = max(v) THEN 0.5 ELSE 0 END AS a, max(v) + CASE WHEN min(v) = max(v) THEN 0.5 ELSE 0 END AS b FROM {source})"
    return f"""SELECT CAST(i AS INTEGER) AS bin, {r(f'a + i * ((b - a) / {bins})', 'low')}, {r(f'a + (i + 1) * ((b - a) / {bins})', 'high')}, coalesce(n, 0) AS n
FROM {edges}, (SELECT unnest(range({bins})) AS i)
LEFT JOIN (SELECT least(floor((v - a) / ((b - a) / {bins})), {bins - 1}) AS j, count(*) AS n FROM {source}, {edges} GROUP BY 1) ON j = i"""


oracle("histogram", binned("errors", "error", 50))
oracle("theme_sum_histogram", " UNION ALL ".join(
    f"SELECT *, '{c}' AS category FROM ({binned('news', f'theme_{c}_sum', 10)})" for c in config.LOAD_CATEGORIES))
oracle("regression_metrics", f"""SELECT count(*) AS n, {r('avg(error * error)', 'mse')}, {r('sqrt(avg(error * error))', 'rmse')},
  {r('avg(abs_error)', 'mae')}, {r('1 - sum(error * error) / (var_pop(actual) * count(*))', 'r2')}, {r('avg(error)', 'mean_error')},
  {r('quantile_cont(error, 0.5)', 'median_error')}, {r('max(error)', 'max_error')}, {r('min(error)', 'min_error')},
  {r('avg(abs_error)', 'mean_abs_error')}, {r('avg(percent_error)', 'mean_percent_error')},
  {r('quantile_cont(percent_error, 0.5)', 'median_percent_error')} FROM errors""")

# --- windows ------------------------------------------------------------------------------------

oracle("volume_change", "SELECT time_bucket, article_count, prev_article_count, article_count_change FROM voluminous")
oracle("volume_spike", "SELECT time_bucket, article_count, article_volume_spike FROM voluminous")
oracle("moving_average_3", f"""SELECT timestamp, {rs(TARGET)}, {rs('moving_avg_3')} FROM
  (SELECT *, avg("{TARGET}") OVER (ORDER BY timestamp ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS moving_avg_3 FROM weather)""")
oracle("gap_fill", f"""SELECT CAST(time_bucket AS TIMESTAMP) AS time_bucket, article_count, theme_Energy_sum, {rs('tone_tone_mean', 'tone_tone_std', 'max_amount_max')}
FROM ({filled('news', ['tone_tone_mean', 'tone_tone_std', 'max_amount_max'], ['article_count', 'theme_Energy_sum'])})""")


def limited(source: str, columns: list[str]) -> str:
    cols = ", ".join(f"last_value({c} IGNORE NULLS) OVER w AS {c}" for c in columns)
    return f"SELECT * REPLACE ({cols}) FROM {source} WINDOW w AS (ORDER BY ts ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)"


def lined(source: str, columns: list[str]) -> str:
    """Straight line between the neighbours, for columns with more than 5% missing."""
    cols = []
    for c in columns:
        pa, va, pb, vb = (f"last_value(CASE WHEN {c} IS NOT NULL THEN pos END IGNORE NULLS) OVER f", f"last_value({c} IGNORE NULLS) OVER f",
                          f"first_value(CASE WHEN {c} IS NOT NULL THEN pos END IGNORE NULLS) OVER b", f"first_value({c} IGNORE NULLS) OVER b")
        cols.append(f"""CASE WHEN {c} IS NOT NULL THEN {c} WHEN (count(*) OVER () - count({c}) OVER ()) / count(*) OVER () > 0.05
      THEN coalesce({va} + ({vb} - {va}) * (pos - {pa}) / ({pb} - {pa}), {va}, {vb}) END AS {c}""")
    return f"""SELECT * EXCLUDE (pos) REPLACE ({', '.join(cols)}) FROM (SELECT *, row_number() OVER (ORDER BY ts) AS pos FROM {source})
  WINDOW f AS (ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), b AS (ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"""


def averaged(source: str, columns: list[str]) -> str:
    return f"SELECT * REPLACE ({', '.join(f'coalesce({c}, avg({c}) OVER ()) AS {c}' for c in columns)}) FROM {source}"


DAILY = f"ts, n, {rs('target', 'b', 'c')}"
oracle("ffill_limited", f"SELECT {DAILY} FROM ({limited('daily', ['b', 'c'])})")
oracle("interpolate_linear", f"SELECT {DAILY} FROM ({lined('daily', ['b', 'c'])})")
oracle("mean_fill", f"SELECT {DAILY} FROM ({averaged('daily', ['b', 'c'])})")
STEPS["imputed_a"] = limited("daily", ["target", "b", "c"])
STEPS["imputed_b"] = lined("imputed_a", ["target", "b", "c"])
oracle("impute", f"SELECT {DAILY} FROM ({averaged('imputed_b', ['target', 'b', 'c'])})")
oracle("sequence_windows", f"""SELECT a.ts AS ts, {r('a.target', 'target')}, CAST(24 - (a.pos - b.pos) AS INTEGER) AS step, {r('CAST(b.n AS DOUBLE)', 'n')}, {r('b.c', 'c')}
FROM (SELECT *, row_number() OVER (ORDER BY ts) AS pos FROM daily) a
JOIN (SELECT *, row_number() OVER (ORDER BY ts) AS pos FROM daily) b ON b.pos BETWEEN a.pos - 24 AND a.pos - 1 WHERE a.pos > 24""")
GAPS = """(SELECT *, row_number() OVER (ORDER BY ts) AS pos, max(gap) OVER (ORDER BY ts ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) AS widest
FROM (SELECT *, ts - lag(ts) OVER (ORDER BY ts) AS gap FROM by_month WHERE part = 'train'))"""
oracle("sequence_windows_guarded", f"""SELECT a.ts AS ts, {r('a.target', 'target')}, CAST(24 - (a.pos - b.pos) AS INTEGER) AS step, {r('CAST(b.n AS DOUBLE)', 'n')}, {r('b.c', 'c')}
FROM {GAPS} a JOIN {GAPS} b ON b.pos BETWEEN a.pos - 24 AND a.pos - 1 WHERE a.pos > 24 AND a.widest <= INTERVAL 1 DAY""")
oracle("tail_validation", f"""SELECT ts, {rs('target')}, CASE WHEN pos > k - floor(0.2 * k) THEN 'validation' ELSE 'fit' END AS part
FROM (SELECT *, row_number() OVER (ORDER BY ts) AS pos, count(*) OVER () AS k FROM by_month WHERE part = 'train')""")
oracle("thin_rows", """SELECT time_bucket, article_count FROM (SELECT *, row_number() OVER (ORDER BY time_bucket) - 1 AS pos FROM news)
WHERE pos % 4 = 0""")

# --- sorts, limits, top-k, sets --------------------------------------------------------------------

oracle("top_themes", """(SELECT theme, n, 'all' AS kind FROM themes ORDER BY n DESC, theme LIMIT 20)
UNION ALL (SELECT theme, n, 'energy' AS kind FROM energy_themes ORDER BY n DESC, theme LIMIT 15)""")
STEPS["top15"] = "SELECT feature, r FROM against_target WHERE r IS NOT NULL ORDER BY abs(r) DESC, feature LIMIT 15"
order = "[datetime" + "]"
STEPS["merged_cells"] = cells("merged", "datetime", MERGED_ALL)
merged_names = "[" + ", ".join(f"'{c}'" for c in MERGED_ALL) + "]"
oracle("top_correlated", f"""SELECT feature_a, feature_b, {rs('r')} FROM ({pair_table('merged_cells', MERGED_ALL)})
WHERE feature_a IN (SELECT feature FROM top15) AND feature_b IN (SELECT feature FROM top15)""")
weather_list = ", ".join(f"'{c}'" for c in WEATHER_COLUMNS)
oracle("top_correlated_by_source", f"""SELECT feature, {rs('r')}, source, CAST(place AS INTEGER) AS place FROM (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY abs(r) DESC, feature) AS place
  FROM (SELECT *, CASE WHEN feature IN ({weather_list}) THEN 'left' ELSE 'right' END AS source FROM top15)) WHERE place <= 3""")
oracle("select_by_correlation", f"SELECT feature, {rs('r')} FROM against_target WHERE abs(r) > 0.02 AND feature <> '{TARGET}'")
oracle("time_sort", f"SELECT datetime, article_count, {rs('temp_mean')} FROM merged ORDER BY datetime")
oracle("split_union_keys", "SELECT ts FROM by_month WHERE part = 'train' UNION SELECT ts FROM by_month WHERE part = 'test'")

# --- split, scale ---------------------------------------------------------------------------------------

oracle("split_month_based", f"SELECT ts, {rs('target')}, part FROM by_month")
oracle("split_random", f"SELECT ts, {rs('target')}, part FROM by_draw")
oracle("split_seasonal_block", f"SELECT ts, {rs('target')}, part FROM by_season")
oracle("split_metadata", """SELECT 'seasonal_block' AS strategy, part, CAST(year(ts) AS INTEGER) AS year,
  CASE WHEN month(ts) IN (12, 1, 2) THEN 'Winter' WHEN month(ts) IN (3, 4, 5) THEN 'Spring' WHEN month(ts) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season,
  CAST(month(ts) AS INTEGER) AS month, count(*) AS rows FROM by_season GROUP BY ALL""")
train = "FILTER (part = 'train') OVER ()"
oracle("standard_scale", f"""SELECT ts, part, {r(f'(n - avg(n) {train}) / stddev_pop(n) {train}', 'n')}, {r(f'c - avg(c) {train}', 'c')} FROM by_month""")
oracle("minmax_target", f"""SELECT ts, part, {r(f'(target - min(target) {train}) / (max(target) {train} - min(target) {train})', 'target')} FROM by_month""")

# --- streaming ----------------------------------------------------------------------------------------------

oracle("stream_new_records", f"SELECT {ID}, datetime, {names(*FLAGS)}, {rs('tone_tone')}, entity_count, {rs('avg_amount')} FROM parsed_dated")
ORACLES["stream_bucket_15min"] = ORACLES["bucket_news_15min"]

# --- whole jobs ------------------------------------------------------------------------------------------------

oracle("news_features", f"SELECT CAST(time_bucket AS TIMESTAMP) AS time_bucket, {names(*KEPT_WHOLE)}, {rs(*KEPT_REAL)} FROM dense")
oracle("model_table", f"""SELECT CAST(time_bucket AS TIMESTAMP) AS time_bucket, {names(*KEPT_WHOLE)}, {rs(*KEPT_REAL)}, {rs(*WEATHER_COLUMNS, 'moving_avg_3')}
FROM dense JOIN (SELECT *, avg("{TARGET}") OVER (ORDER BY timestamp ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS moving_avg_3 FROM weather)
  ON time_bucket = timestamp""")
oracle("theme_report", """SELECT 'themes' AS kind, theme AS name, n FROM themes UNION ALL SELECT 'energy_themes', theme, n FROM energy_themes
UNION ALL SELECT 'periods', concat_ws('/', period, category), n FROM periods
UNION ALL SELECT 'totals', category, CAST(sum(n) AS BIGINT) FROM periods GROUP BY category
UNION ALL SELECT 'categories', category, n FROM (""" + CATEGORY_TOTALS + ")")
STEPS["user_rows"] = f"SELECT user_id, {quarter('ts')} AS time_bucket, count(*) AS article_count FROM events GROUP BY 1, 2"
oracle("user_volume_change", f"""SELECT user_id, time_bucket, article_count, lag(article_count, 1, 0) OVER w AS prev_article_count,
  article_count - lag(article_count, 1, 0) OVER w AS article_count_change,
  CAST(coalesce(count(*) OVER (w ROWS BETWEEN {config.SPIKE_ROWS - 1} PRECEDING AND CURRENT ROW) = {config.SPIKE_ROWS}
    AND article_count > {config.SPIKE_FACTOR} * avg(article_count) OVER (w ROWS BETWEEN {config.SPIKE_ROWS - 1} PRECEDING AND CURRENT ROW), false) AS INTEGER) AS article_volume_spike
FROM user_rows WINDOW w AS (PARTITION BY user_id ORDER BY time_bucket)""")
oracle("second_moving_average", f"""SELECT t, {rs('total')}, {r('avg(total) OVER (ORDER BY t ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)', 'moving_avg_3')}
FROM (SELECT date_trunc('second', ts) AS t, CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS total FROM events GROUP BY 1)""")
