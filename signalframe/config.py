"""Names, word lists and thresholds that results depend on.

Everything here is data, not logic.  Every operator takes these values as
defaults and accepts other ones as arguments.
"""

# --- Fixed values: the 27 columns of a raw article record, in file order ------
RAW_COLUMNS = [
    "GKGRECORDID", "DATE", "SourceCollectionIdentifier", "SourceCommonName",
    "DocumentIdentifier", "Counts", "V2Counts", "Themes", "V2Themes", "Locations",
    "V2Locations", "Persons", "V2Persons", "Organizations", "V2Organizations",
    "V2Tone", "Dates", "GCAM", "SharingImage", "RelatedImages", "SocialImageEmbeds",
    "SocialVideoEmbeds", "Quotations", "AllNames", "Amounts", "TranslationInfo", "Extras",
]

# --- Fixed values: columns the article parser needs --------------------------
PARSER_COLUMNS = ["DATE", "V2Themes", "V2Tone", "Counts", "Amounts"]

# --- Fixed values: text tokens that mean "missing" in a raw file -------------
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# --- Fixed values: theme categories and keywords, first match wins -----------
THEME_CATEGORIES = {
    "Political": ["ELECTION", "GOVERN", "POLIT", "DEMO", "LEG", "VOTE", "PARLIAMENT",
                  "PRESIDENT", "MINISTER"],
    "Economic": ["ECON", "MARKET", "TRADE", "BUSINESS", "FINANC", "TAX", "INVEST", "GDP",
                 "INFLATION"],
    "Religious": ["RELIG", "MUSLIM", "HINDU", "SIKH", "TEMPLE", "CHURCH", "MOSQUE", "FAITH",
                  "GOD"],
    "Energy": ["ENERGY", "POWER", "ELECTRIC", "OIL", "GAS", "COAL", "FUEL", "RENEWABLE", "GRID"],
    "Infrastructure": ["INFRA", "TRANSPORT", "CONSTRUCT", "BUILDING", "ROAD", "HIGHWAY", "RAIL",
                       "AIRPORT"],
    "Health": ["HEALTH", "COVID", "DISEASE", "PANDEMIC", "HOSPITAL", "MEDIC", "VACCINE", "DRUG"],
    "Social": ["SOCIAL", "PROTEST", "RALLY", "CELEBR", "FESTIVAL", "COMMUNITY", "SOCIETY",
               "PUBLIC", "CITIZEN"],
    "Environment": ["ENV", "CLIMATE", "WEATHER", "POLLUT", "WATER", "GREEN", "ECOLOGY",
                    "TEMPERATURE"],
    "Education": ["EDU", "SCHOOL", "UNIVERSITY", "STUDENT", "LEARNING", "COLLEGE", "TEACHER",
                  "PROFESSOR"],
}
CATEGORIES = list(THEME_CATEGORIES)

# --- Fixed values: categories carried into the 15-minute table ---------------
LOAD_CATEGORIES = ["Energy", "Environment", "Infrastructure", "Social", "Health", "Political",
                   "Economic"]

# --- Fixed values: words that mark a theme as relevant to energy use ---------
ENERGY_KEYWORDS = [
    "POWER", "ENERGY", "ELECTRIC", "GRID", "OUTAGE", "BLACKOUT", "LOAD", "CONSUMPTION",
    "WEATHER", "TEMPERATURE", "HEAT", "COLD", "WINTER", "SUMMER", "RAINFALL",
    "FESTIVAL", "CELEBRATION", "EVENT", "HOLIDAY", "GATHERING",
    "INFRA", "CONSTRUCTION", "DEVELOPMENT",
    "PROTEST", "RALLY", "STRIKE", "DISRUPTION",
    "OFFICE", "WORKPLACE", "WORK", "BUSINESS", "INDUSTRY",
]

# --- Fixed values: context flags and their keywords --------------------------
CONTEXT_KEYWORDS = {
    "energy_supply": ["production", "output", "generation", "supply"],
    "energy_demand": ["consumption", "demand", "usage", "load"],
    "energy_price": ["price", "cost", "tariff", "rate", "economic"],
    "energy_policy": ["policy", "regulation", "law", "government", "subsidy"],
    "energy_infrastructure": ["grid", "blackout", "outage", "infrastructure", "plant", "station"],
    "renewable_energy": ["solar", "wind", "hydro", "renewable", "clean energy", "green energy"],
    "fossil_fuel": ["oil", "gas", "coal", "petroleum", "diesel", "gasoline"],
    "weather_event": ["storm", "hurricane", "temperature", "heat", "cold", "snow", "rain"],
}
CONTEXTS = list(CONTEXT_KEYWORDS)
PARITY_CONTEXTS = ["energy_supply", "energy_demand"]

# --- Fixed values: the six leading tone numbers ------------------------------
TONE_METRICS = ["tone", "positive", "negative", "polarity", "activity", "self_ref"]

# --- Fixed values: hour ranges of the day periods (Night wraps) --------------
DAY_PERIODS = {"Morning": (5, 11), "Afternoon": (12, 16), "Evening": (17, 21), "Night": (22, 4)}

# --- Fixed values: aggregates of the 15-minute news table, per column --------
NEWS_AGGREGATES = {
    **{f"theme_{c}": ["sum", "max", "mean"] for c in LOAD_CATEGORIES},
    "tone_tone": ["mean", "min", "max", "std"],
    "tone_negative": ["max", "mean"],
    "tone_positive": ["max", "mean"],
    "tone_polarity": ["mean", "max"],
    "tone_activity": ["mean", "max"],
    "entity_count": ["sum", "mean"],
    "entity_variety": ["sum", "max"],
    "avg_amount": ["mean", "max", "sum"],
    "max_amount": ["max", "mean"],
    "amount_count": ["sum"],
    "energy_impact_score": ["mean", "max", "sum"],
    **{c: ["sum", "max"] for c in CONTEXTS},
    "energy_amount": ["sum", "max"],
    "infrastructure_amount": ["sum", "max"],
    "environment_amount": ["sum", "max"],
}

# --- Fixed values: aggregates of the 15-minute weather table, per column -----
WEATHER_AGGREGATES = {
    "Power demand": ["sum"],
    "temp": ["mean", "min", "max"],
    "dwpt": ["mean"],
    "rhum": ["mean"],
    "wdir": ["mean"],
    "wspd": ["mean", "max"],
    "pres": ["mean"],
}
WEATHER_SKIPPED = ["datetime", "timestamp", "year", "month", "day", "hour", "minute"]

# --- Fixed values: columns kept in the 15-minute feature table, in order -----
FEATURE_COLUMNS = [
    "time_bucket", "article_count", "article_count_change", "article_volume_spike",
    "tone_tone_mean", "tone_negative_max", "tone_positive_max", "tone_volatility",
    "tone_polarity_mean", "tone_activity_mean",
    "theme_Energy_sum", "theme_Environment_sum", "theme_Infrastructure_sum",
    "theme_Social_sum", "theme_Health_sum", "theme_Political_sum", "theme_Economic_sum",
    "theme_Energy_max", "theme_Environment_max", "theme_Infrastructure_max",
    "entity_count_sum", "entity_variety_max", "max_amount_max",
    "energy_crisis_indicator", "weather_alert_indicator",
    "social_event_indicator", "infrastructure_stress",
    "political_crisis_indicator", "economic_impact_indicator",
    "hour", "day_of_week", "is_weekend", "is_business_hours",
    "month", "day", "hour_sin", "hour_cos", "day_of_week_sin", "day_of_week_cos",
]

# --- Fixed values: sizes and thresholds --------------------------------------
PLACE = "Delhi"
BATCH_DAYS = 90
SPIKE_ROWS = 12
SPIKE_FACTOR = 1.5
SEQUENCE_ROWS = 24
FILL_LIMIT = 3
INTERPOLATE_ABOVE = 0.05
TEST_FRACTION = 0.2
VALIDATION_FRACTION = 0.2
SEED = 42
CORRELATION_THRESHOLD = 0.2
PAIR_THRESHOLD = 0.8
TOP_CORRELATED = 15
HISTOGRAM_BINS = 50
THIN_STEP = 4
SEASON_NAMES = {1: "Winter", 2: "Spring", 3: "Summer", 0: "Fall"}
