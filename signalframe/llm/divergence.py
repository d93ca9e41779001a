"""Quality rules by distribution divergence, in DataFrame functions only."""

from __future__ import annotations

import math
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalframe.llm.common import SPACES
from signalframe.plans.staging import stage

#: Words in a repetition window.
WINDOW = 5
#: Common words that a language's reference keeps, and the candidates among which they are counted exactly.
COMMON, CANDIDATES, LONGEST_COMMON = 32, 200, 6
#: Items that the sketch of frequent words keeps for each language; words above 1 in 3,000 are found for certain.
TRACKED = 4096
#: Least size of a text, and of a language's whole collection, for its histogram to be judged or to judge others.
LEAST_CHARS, LEAST_WORDS, REFERENCE_WORDS = 200, 50, 400
#: Greatest Jensen-Shannon distances (base 2, between 0 and 1) of a text that is kept; a short
#: text strays from its language by chance, so the word limit grows by WORD_NOISE / sqrt(words).
CLASS_LIMIT, WORD_LIMIT, WORD_NOISE = 0.36, 0.15, 3.2

#: Character classes of what is no white space, besides capitals, other letters, and what none of them holds.
#: They are counted in what is left without letters and white space, which is little; letters are the rest.
CLASSES = {"digit": r"\p{N}", "mark": r"[\p{P}&&[^#%&*@/\\_]]"}
UPPER, NO_LETTERS = r"[\p{Lu}\p{Lt}]", r"[\p{L}\p{M}\x20\x09-\x0D]+"
N_CLASSES = len(CLASSES) + 3


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once for each row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeated_words(words: Column) -> Column:
    """Number of words that lie in a window of WINDOW words found twice or more, the first one included.

    Windows are 64-bit hashes.  Only if two are equal are they sorted with
    their positions; neighbours that agree are the repeats, and each of these
    windows adds the words that the one before did not cover.
    """

    def covered(windows: Column) -> Column:
        placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
        return let(placed, lambda s: F.aggregate(
            F.sort_array(F.transform(
                F.filter(s, lambda e, i: (F.get(s, i + 1)["h"] == e["h"]) | ((i > 0) & (F.get(s, F.greatest(i - 1, F.lit(0)))["h"] == e["h"]))),
                lambda e: e["at"],
            )),
            F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
            lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n")),
            lambda a: a["n"],
        ))

    def of(w: Column) -> Column:
        every = F.transform(w, lambda x, i: F.xxhash64(x, *[F.get(w, i + k) for k in range(1, WINDOW)]))
        return F.slice(every, 1, F.greatest(F.size(w) - (WINDOW - 1), F.lit(0)))

    windows = of(words)
    count = let(windows, lambda w: F.when(F.size(F.array_distinct(w)) < F.size(w), covered(w)).otherwise(0))
    return F.coalesce(count, F.lit(0)).cast("long")


def base_columns(text: Column, words: Column) -> dict[str, Column]:
    """The counts of the base rules; ``text`` is not null and ``words`` a computed array."""
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": repeated_words(words),
    }


def class_counts(text: Column, solid: Column) -> Column:
    """Characters of each class; white space does not count, so scripts without spaces compare.

    ``solid`` is the number of characters that are no white space.
    """
    upper = F.regexp_count(text, F.lit(UPPER)).cast("long")

    def counts(odd: Column) -> Column:
        parts = [F.regexp_count(odd, F.lit(p)).cast("long") for p in CLASSES.values()]
        return F.array(upper, *parts, F.length(odd).cast("long"))

    return let(let(F.regexp_replace(text, NO_LETTERS, ""), counts), lambda c: F.array(
        F.get(c, F.lit(0)), solid - F.get(c, F.lit(0)) - F.get(c, F.lit(3)), F.get(c, F.lit(1)), F.get(c, F.lit(2)),
        F.get(c, F.lit(3)) - F.get(c, F.lit(1)) - F.get(c, F.lit(2))))


def plain_words(text: Column) -> Column:
    """Runs of letters in lower case, and empty strings at the ends."""
    return F.split(F.lower(text), r"[^\p{L}\p{M}]+")


def may_be_common(word: Column) -> Column:
    """Common words are short in every language; this spares the sketch the long tail of others."""
    return F.length(word).between(1, LONGEST_COMMON)


def runs(words: Column) -> Column:
    """Each distinct word of a sorted array with its number."""
    starts = F.filter(F.transform(words, lambda w, i: F.when((i == 0) | (F.get(words, i - 1) != w), i)), lambda i: i.isNotNull())
    return let(starts, lambda b: F.transform(b, lambda at, k: F.struct(
        F.get(words, at).alias("word"), (F.coalesce(F.get(b, k + 1), F.size(words)) - at).cast("long").alias("n"))))


def frequent_words(docs: DataFrame) -> list[str]:
    """Words that may be among the commonest of some language: one sketch a language, folded in each task.

    CANDIDATES words for each value of ``lang`` pass through the driver.
    """
    words = docs.filter("lang is not null").select("lang", F.explode(F.filter(plain_words(F.coalesce("text", F.lit(""))), may_be_common)).alias("word"))
    sketch = words.groupBy("lang").agg(F.expr(f"approx_top_k(word, {CANDIDATES}, {TRACKED})").alias("top"))
    return sorted(r[0] for r in sketch.select(F.explode("top.item")).distinct().collect())


def histograms(docs: DataFrame, candidates: list[str]) -> DataFrame:
    """For each row of ``docs`` the base counts, class counts, number of plain words and counts of candidate words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.filter(F.split(text, SPACES), lambda w: w != "")
    base = let(words, lambda w: F.struct(*[c.alias(n) for n, c in base_columns(text, w).items()]))

    def common(found: Column) -> Column:
        counted = let(F.sort_array(F.filter(found, lambda w: w.isin(candidates))), runs)
        n = F.size(found) - F.size(F.filter(F.array(F.get(found, F.lit(0)), F.element_at(found, -1)), lambda w: w == ""))
        return F.struct(F.greatest(n, F.lit(0)).cast("long").alias("n"), (counted if candidates else F.expr("cast(array() as array<struct<word:string,n:bigint>>)")).alias("common"))

    counted = docs.select("doc_id", "lang", text.alias("text"), base.alias("base"), let(plain_words(text), common).alias("plain"))
    return counted.select("doc_id", "lang", "base", class_counts(F.col("text"), F.col("base.word_chars")).alias("classes"), "plain")


class Reference(NamedTuple):
    """Shares of the character classes and of the common words of a language."""

    classes: list[float]
    words: dict[str, float]


def references(found: DataFrame) -> dict[str, Reference]:
    """The reference of each language with REFERENCE_WORDS words or more, over all documents.

    For each value of ``lang`` a row of class sums and COMMON words pass through the driver.
    """
    labelled = found.filter("lang is not null")
    sums = labelled.groupBy("lang").agg(
        F.sum("plain.n").alias("words"), *[F.sum(F.get("classes", F.lit(i))).alias(f"c{i}") for i in range(N_CLASSES)])
    counted = labelled.select("lang", F.inline("plain.common")).groupBy("lang", "word").agg(F.sum("n").alias("n"))
    ranked = counted.groupBy("lang").agg(F.slice(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "word"))), 1, COMMON).alias("top"))
    rows = sums.filter(F.col("words") >= REFERENCE_WORDS).join(ranked, "lang", "left").collect()
    return {
        r["lang"]: Reference(
            [r[f"c{i}"] / max(1, sum(r[f"c{k}"] for k in range(N_CLASSES))) for i in range(N_CLASSES)],
            {w["word"]: -w["n"] / r["words"] for w in r["top"] or []})
        for r in rows
    }


def _part(p: Column, q: Column) -> Column:
    """One value's part of the divergence, doubled: p log p/m + q log q/m with m the mean of p and q."""
    m = (p + q) / 2
    return F.when(p > 0, p * F.log2(p / m)).otherwise(0.0) + F.when(q > 0, q * F.log2(q / m)).otherwise(0.0)


def _distance(doubled: Column) -> Column:
    return F.sqrt(F.greatest(doubled / 2, F.lit(0.0)))


def class_distance(classes: Column, reference: Reference) -> Column:
    total = F.greatest(F.aggregate(classes, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(1))
    return _distance(sum(_part(F.get(classes, F.lit(i)) / total, F.lit(q)) for i, q in enumerate(reference.classes)))


def word_distance(plain: Column, reference: Reference) -> Column:
    """Distance over the reference's common words and one value for all other words.

    A common word that the text lacks adds its own share; the fold puts the
    true part in its place for those that the text has.
    """
    if not reference.words:
        return F.lit(0.0)
    shares = F.create_map(*[F.lit(x) for pair in reference.words.items() for x in pair])
    total, all_common = F.greatest(plain["n"], F.lit(1)), math.fsum(reference.words.values())
    known = F.transform(F.filter(plain["common"], lambda c: c["word"].isin(list(reference.words))), lambda c: F.struct(
        (c["n"] / total).alias("p"), F.try_element_at(shares, c["word"]).alias("q")))
    folded = F.aggregate(
        known, F.struct(F.lit(all_common).alias("d"), F.lit(0.0).alias("p")),
        lambda a, c: F.struct(
            (a["d"] + _part(c["p"], c["q"]) - c["q"]).alias("d"), (a["p"] + c["p"]).alias("p")),
    )
    return let(folded, lambda a: _distance(a["d"] + _part(1 - a["p"], F.lit(max(0.0, 1 - all_common)))))


def judged(found: DataFrame, known: dict[str, Reference]) -> DataFrame:
    """The rows of ``histograms`` with base_failed, the distances to the nearest reference, and kept."""
    base, plain, classes = F.col("base"), F.col("plain"), F.col("classes")
    failed = (base["n_words"] < 10) | (100 * base["n_repeat_words"] > 20 * base["n_words"])
    nearest = [F.least(*cs, F.lit(2.0)) if cs else F.lit(None).cast("double") for cs in (
        [class_distance(classes, r) for r in known.values()], [word_distance(plain, r) for r in known.values()])]
    comparable = F.col("lang").isNull() | F.col("lang").isin(list(known))
    long_enough = base["word_chars"] >= LEAST_CHARS
    common = sorted({w for r in known.values() for w in r.words})
    speaks = (plain["n"] >= LEAST_WORDS) & F.exists(plain["common"], lambda c: c["word"].isin(common))
    out = found.withColumns({
        "base_failed": failed,
        "class_distance": F.when(comparable & long_enough, nearest[0]),
        "word_distance": F.when(comparable & speaks, nearest[1]),
    })
    word_limit = WORD_LIMIT + WORD_NOISE / F.sqrt(F.greatest(plain["n"], F.lit(1)))
    strays = (F.col("class_distance") > CLASS_LIMIT) | (F.col("word_distance") > word_limit)
    return out.withColumn("kept", ~F.col("base_failed") & ~F.coalesce(strays, F.lit(False)))


def verdicts(found: DataFrame) -> DataFrame:
    """Judge every row of ``histograms``; the references are those of the rows that pass those of all rows."""
    first = references(found)
    known = {**first, **references(judged(found, first).filter("kept"))}
    return judged(found, known).select("doc_id", "base.*", "base_failed", "class_distance", "word_distance", "kept")


def quality_rules(docs: DataFrame) -> DataFrame:
    """Base rules and divergence from the languages' references for documents (doc_id, text, lang).

    The references are the shares of character classes and of the commonest
    words in all documents of each value of ``lang``, taken twice: over all rows,
    and over those that pass by the first.  A document that passes
    the base rules (10 words, at most a fifth of them in repeated windows) is
    rejected if its classes, or its common words, lie further than the limits
    from those of every language.

    Not judged by classes: texts below LEAST_CHARS characters.  Not judged by
    words: texts below LEAST_WORDS words, and texts that hold no common word of
    any language, as theirs may be one without reference.  Not judged at all:
    documents whose ``lang`` has a reference neither of its own nor, being null,
    any at all.  Null and empty texts have no words and fail the base rules.  A
    row is judged by itself, so repeated ids, ties and copies need no rule; an
    empty table gives an empty result.  A text of any length is read whole, in
    time proportional to it (times its logarithm if windows repeat).

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, and the two distances (null where not judged).  Runs
    jobs; the counts of each document are stored in the shared folder.
    """
    docs = docs.select("doc_id", "text", "lang")
    found = stage(histograms(docs, frequent_words(docs)), "histograms")
    return verdicts(found)
