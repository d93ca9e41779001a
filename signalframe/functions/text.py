"""Parsing of the delimited text fields of an article record.

All expressions are built-in functions, so they stay inside the JVM.  Word
tests use ``contains`` (a byte search) rather than a regex alternation.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from signalframe import config

NUMBER = r" *[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)? *"
STAMP = r"^(?:(?!0000)([0-9]{4})([0-9]{2})([0-9]{2})([0-9]{2})([0-9]{2})([0-9]{2})|(?s:.*))$"
BLANKS = " \t\n\r\u000b\u000c"
ENTITY_TYPE = "struct<entity:string,n:bigint>"


def as_column(value: str | Column) -> Column:
    return F.col(f"`{value}`") if isinstance(value, str) else value


def null_if_missing(value: str | Column, tokens: Iterable[str] = config.MISSING_TOKENS) -> Column:
    """Text whose whole value is a "missing" token becomes NULL."""
    value = as_column(value)
    return F.when(~value.isin(list(tokens)), value)


def to_number(text: Column) -> Column:
    """Plain decimal text to double, anything else to NULL (no '1.5d', no 'NaN').

    The pattern also spares the cast its slow failure path.
    """
    return F.when(text.rlike(f"^{NUMBER}$"), text.try_cast("double"))


def to_integer(text: Column) -> Column:
    """Whole-number text to bigint, anything else to NULL."""
    return F.when(text.rlike("^ *[+-]?[0-9]+ *$"), text.try_cast("bigint"))


def event_time(date: str | Column) -> Column:
    """``YYYYMMDDHHMMSS`` text to a zone-less timestamp, NULL when not a real time.

    Short text is padded with zeros on the left, what follows 14 digits is cut.
    """
    digits = F.lpad(as_column(date), 14, "0")
    return F.regexp_replace(digits, STAMP, "$1-$2-$3 $4:$5:$6").try_cast("timestamp_ntz")


def record_themes(v2themes: str | Column) -> Column:
    """Distinct lower-cased theme names of one record; empty array when NULL."""
    parts = F.filter(F.split(as_column(v2themes), ";"), lambda x: x != "")
    names = F.array_distinct(F.transform(parts, lambda x: F.lower(F.substring_index(x, ",", 1))))
    return F.coalesce(names, F.array().cast("array<string>"))


def theme_mentions(themes: str | Column) -> Column:
    """Every theme mention of one record, case kept and repeats kept.

    The text is cut at ``;`` when it has one, otherwise at ``,``.
    """
    themes = as_column(themes)
    parts = F.when(themes.contains(";"), F.split(themes, ";")).otherwise(F.split(themes, ","))
    trimmed = F.transform(parts, lambda x: F.btrim(x, F.lit(BLANKS)))
    return F.transform(F.filter(trimmed, lambda x: x != ""), lambda x: F.substring_index(x, ",", 1))


def contains_any(text: Column, words: Iterable[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(w) for w in words])


def first_category(
    name: Column, categories: Mapping[str, list[str]] = config.THEME_CATEGORIES
) -> Column:
    """First category, in dictionary order, with a keyword inside a lower-case theme name."""
    tests = {c: contains_any(name, [w.lower() for w in words]) for c, words in categories.items()}
    return F.coalesce(*[F.when(test, c) for c, test in tests.items()])


def tone_parts(v2tone: str | Column) -> Column:
    """Pieces of the tone text, NULL unless the first six are all numbers."""
    text = as_column(v2tone)
    return F.when(text.rlike(f"^({NUMBER},){{5}}{NUMBER}(,|$)"), F.split(text, ","))


def entity_entries(counts: str | Column) -> Column:
    """Readable ``TYPE#n#...`` entries as (entity, n), last entry first."""
    def entry(x: Column) -> Column:
        number = F.substring_index(F.substring_index(x, "#", 2), "#", -1)
        return F.struct(F.lower(F.substring_index(x, "#", 1)).alias("entity"),
                        F.when(x.contains("#"), to_integer(number)).alias("n"))

    entries = F.transform(F.split(as_column(counts), ";"), entry)
    return F.reverse(F.filter(entries, lambda e: e["n"].isNotNull()))


def first_per_entity(entries: Column, names: Column) -> Column:
    """Of entries listed last first, the first of each entity; empty array when NULL."""
    unique = F.size(F.array_distinct(names)) == F.size(names)
    kept = F.filter(entries, lambda e, i: F.array_position(names, e["entity"]) == i + 1)
    return F.coalesce(F.when(unique, entries).otherwise(kept), F.array().cast(f"array<{ENTITY_TYPE}>"))


def amount_values(amounts: str | Column) -> Column:
    """The number in front of each ``value,object,offset`` entry, bad ones skipped."""
    read = F.transform(F.split(as_column(amounts), ";"), lambda x: to_number(F.substring_index(x, ",", 1)))
    return F.coalesce(F.filter(read, lambda v: v.isNotNull()), F.array().cast("array<double>"))


def array_sum(values: Column, kind: str) -> Column:
    return F.aggregate(values, F.lit(0).cast(kind), lambda acc, v: acc + v)
