"""Language identification: known words first, then shorter and shorter character n-grams."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from signalframe.llm.common import map_texts

#: Documents of each language, about, that the model is fitted on.
SAMPLE = 2_000
#: Words, and n-grams of each length, that the model keeps of each language.
WORDS, GRAMS = 20_000, 10_000
#: Lengths of the n-grams, from which an unseen word backs off.
LONGEST = 5
#: Words whose scores a task remembers.
REMEMBERED = 300_000
#: What a gram costs, in logarithms, for each character that it is shorter than the longest.
BACKOFF = 0.4

UNDETERMINED = "und"
_LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> Counter[str]:
    """The runs of letters of a text in lower case, as ``\\p{L}+`` finds them in ``fit``; other numerals are no letters."""
    found = Counter(_LETTERS.findall(text.lower()))
    for mixed in [w for w in found if not w.isalpha()]:
        n = found.pop(mixed)
        for word in "".join(c if c.isalpha() else " " for c in mixed).split():
            found[word] += n
    return found


def held_out(ids: Column) -> Column:
    """Whether crc32 of the id as text leaves no remainder by 5; a null id counts as empty text."""
    return F.crc32(F.coalesce(ids.cast("string"), F.lit("")).cast("binary")) % 5 == 0


class Model:
    """Log-frequencies of words and n-grams: a row of a matrix for each, a column for each language."""

    def __init__(self, languages: list[str], words: dict[str, dict[str, int]], grams: dict[str, dict[str, int]], totals: dict[str, int]):
        self.languages = languages
        place = {x: k for k, x in enumerate(languages)}
        sums: dict[int, list[int]] = defaultdict(lambda: [0] * len(languages))
        for gram, found in grams.items():
            for language, n in found.items():
                sums[len(gram)][place[language]] += n
        self.grams = {g: self._row(found, place, sums[len(g)]) for g, found in grams.items()}
        self.known = {w: k for k, w in enumerate(words)}
        self.rows = np.zeros((len(words) + REMEMBERED, len(languages)))
        for k, found in enumerate(words.values()):
            self.rows[k] = self._row(found, place, [totals.get(x, 0) for x in languages])
        self.place = dict(self.known)

    @staticmethod
    def _row(found: dict[str, int], place: dict[str, int], totals: list[int]) -> np.ndarray:
        row = np.array([math.log(0.5 / (n + 1)) for n in totals])
        for language, n in found.items():
            row[place[language]] = math.log((n + 0.5) / (totals[place[language]] + 1))
        return row

    def word(self, word: str) -> int:
        """The row of a word; that of an unseen one is the mean of its longest known n-grams, from left to right."""
        at = self.place.get(word)
        if at is None:
            if len(self.place) == len(self.rows):
                self.place = dict(self.known)
            at = self.place[word] = len(self.place)
            self.rows[at] = self._backed_off(f"^{word}$")
        return at

    def _backed_off(self, text: str) -> np.ndarray:
        total, found = np.zeros(len(self.languages)), 0
        for start in range(len(text)):
            for length in range(min(LONGEST, len(text) - start), 0, -1):
                row = self.grams.get(text[start : start + length])
                if row is not None:
                    total, found = total + row - BACKOFF * (LONGEST - length), found + 1
                    break
        return total / max(1, found)

    def predict(self, text: str) -> tuple[str, float]:
        """The likeliest language and its posterior, all languages alike before; of equal ones the first by name."""
        words = words_of(text)
        if not words or not self.languages:
            return UNDETERMINED, 0.0
        score = np.zeros(len(self.languages))
        kinds, counts = list(words), np.array(list(words.values()), float)
        for start in range(0, len(kinds), REMEMBERED // 2):  # rows that are forgotten meanwhile have been added
            score += counts[start : start + REMEMBERED // 2] @ self.rows[[self.word(w) for w in kinds[start : start + REMEMBERED // 2]]]
        best = int(np.argmax(score))
        return self.languages[best], float(1 / np.exp(np.minimum(score - score[best], 0)).sum())


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from the rows of ``docs`` (doc_id, text, lang) whose lang is not null.  Runs jobs.

    About ``sample`` documents of each language, drawn by the hash of their id,
    are counted.  Of each language the WORDS most frequent words and the GRAMS
    most frequent n-grams of each length reach the driver and the tasks.
    """
    docs = docs.filter("lang is not null and text is not null")
    sizes = {r["lang"]: r["count"] for r in docs.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], {}, {}, {})
    share = F.coalesce(*[F.when(F.col("lang") == x, F.lit(min(1.0, sample / n))) for x, n in sizes.items()])
    parts = 1 << 24
    chosen = docs.filter(F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(parts)) < share * parts)
    split = F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0)))
    counted = chosen.select("lang", split.alias("word")).groupBy("lang", "word").agg(F.count("*").alias("n")).persist()
    try:
        totals = {r["lang"]: r["n"] for r in counted.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
        words = _most(counted.select("lang", F.lit(0).alias("length"), F.col("word").alias("entry"), "n"), WORDS)
        marked = F.concat(F.lit("^"), "word", F.lit("$"))
        grams = []
        for length in range(1, LONGEST + 1):
            starts = F.sequence(F.lit(1), F.length(marked) - length + 1)
            cut = F.transform(starts, lambda s, k=length: F.substring(marked, s, F.lit(k)))
            grams.append(counted.filter(F.length(marked) >= length).select("lang", F.lit(length).alias("length"), F.explode(cut).alias("entry"), "n"))
        found = grams[0]
        for more in grams[1:]:
            found = found.union(more)
        return Model(languages, words, _most(found.groupBy("lang", "length", "entry").agg(F.sum("n").alias("n")), GRAMS), totals)
    finally:
        counted.unpersist()


def _most(counts: DataFrame, most: int) -> dict[str, dict[str, int]]:
    """The most frequent entries of each language and length."""
    order = W.partitionBy("lang", "length").orderBy(F.desc("n"), "entry")
    out: dict[str, dict[str, int]] = defaultdict(dict)
    for row in counts.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= most).collect():
        out[row["entry"]][row["lang"]] = row["n"]
    return out


def predictions(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score (posterior, 0 to 1) of every text of ``docs`` (doc_id, text).

    Null texts, texts without letters, and all texts of an empty model are
    "und" with score 0.  Rows that repeat are each predicted.
    """

    def step(texts: list[str]) -> dict[str, object]:
        found = [model.predict(t) for t in texts]
        return {"lang_pred": [f[0] for f in found], "score": [f[1] for f in found]}

    return map_texts(docs.select("doc_id", "text"), step, "lang_pred string, score double")
