"""Severity of toxic language by ordinal regression with cumulative links."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalframe.llm import linear
from signalframe.llm.common import map_texts
from signalframe.plans.staging import stage

#: Labelled documents, about, of either label that the model is fitted on.
SAMPLE = 10_000
#: Candidates for features: those whose counts tell the labels apart best.
FEATURES = 4_000
#: Logarithm of how much more frequent a feature must be in toxic documents.
ODDS = 3.0
#: Words or beginnings of words that fewer toxic texts of the sample hold are no features.
LEAST = 5
#: Lengths of the beginnings of words that are features beside whole words.
PREFIXES = (4, 5, 6)
#: Grades above 0, by the weight of telling words in a toxic document against its length.
GRADES = 3
#: Words whose features a task remembers.
REMEMBERED = 300_000

_WORD = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*" for n in PREFIXES if len(word) > n)]


class Vectors:
    """Sparse rows of texts: for each kept feature, the logarithm of 1 + its occurrences."""

    def __init__(self, features: list[str]):
        self.place = {f: k for k, f in enumerate(features)}
        self.memory: dict[str, tuple[int, ...]] = {}

    def of(self, word: str) -> tuple[int, ...]:
        found = self.memory.get(word)
        if found is None:
            if len(self.memory) >= REMEMBERED:
                self.memory.clear()
            found = self.memory[word] = tuple(self.place[f] for f in word_features(word) if f in self.place)
        return found

    def row(self, text: str) -> tuple[np.ndarray, np.ndarray, int]:
        """Columns, values, and the number of words."""
        words = _WORD.findall(text.lower())
        hits = [found for w in words if (found := self.of(w))]
        counts = Counter(k for found in hits for k in found)
        return np.array(list(counts), np.int64), np.log1p(np.array(list(counts.values()), float)), len(words)


def distinct_texts(sample: DataFrame) -> DataFrame:
    """One row for all documents of the sample (text, toxic) with the same words; toxic if any is."""
    words = F.sha2(F.array_join(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0)), " "), 256)
    return sample.groupBy(words.alias("words")).agg(F.max("toxic").alias("toxic"), F.min("text").alias("text")).drop("words")


def telling(sample: DataFrame) -> list[str]:
    """Features that are frequent in toxic and rare in other texts of the sample (text, toxic).  Runs a job.

    The value of a feature is the signed root of the likelihood ratio that it
    gives the label; at most FEATURES names reach the driver.
    """
    words = sample.select("toxic", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0)))).alias("word"))
    n = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if not n.get(0) or not n.get(1):
        return []
    of_word = words.groupBy("word").agg(F.sum("toxic").alias("t"), F.count("*").alias("all"))
    names = F.array(F.col("word"), *[F.when(F.length("word") > k, F.concat(F.substring("word", 1, k), F.lit("*"))) for k in PREFIXES])
    named = of_word.select(F.explode(F.array_compact(names)).alias("name"), "t", "all")
    counts = named.groupBy("name").agg(F.sum("t").alias("t"), F.sum("all").alias("all")).filter(F.col("t") >= LEAST)
    odds = F.log((F.col("t") + 0.5) / n[1] / ((F.col("all") - F.col("t") + 0.5) / n[0]))
    best = counts.select("name", "t", "all", odds.alias("odds"), (odds * F.col("t")).alias("gain")).filter(F.col("odds") > ODDS).orderBy(F.desc("gain"), "name").limit(FEATURES)
    return folded({r["name"]: (r["t"], r["all"]) for r in best.collect()})


def folded(counts: dict[str, tuple[int, int]]) -> list[str]:
    """Names of features (name to occurrences in toxic and in all texts), one for each set of texts along a word.

    A word and its beginnings that count the same occur in the same texts; of
    them the longest beginning is kept, else the word.
    """
    left = set()
    for name, count in counts.items():
        begins = [b for b in word_features(name.rstrip("*"))[1:] if counts.get(b) == count]
        if name.endswith("*"):
            left.update(begins)
        elif begins:
            left.update((name, *begins[:-1]))
    return [name for name in counts if name not in left]


def graded(share: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Grade 0 for what is not toxic; for toxic documents, the part of their shares that theirs falls into."""
    if not (toxic > 0).any():
        return np.zeros(len(toxic), np.int64)
    cuts = np.quantile(share[toxic > 0], np.arange(1, GRADES) / GRADES)
    return np.where(toxic > 0, 1 + np.searchsorted(cuts, share, side="right"), 0)


class Model:
    """Kept features, their weights, and the ascending thresholds that share them."""

    def __init__(self, features: list[str], weights: np.ndarray, thresholds: np.ndarray):
        self.vectors, self.weights, self.thresholds = Vectors(features), weights, thresholds

    def exceeding(self, text: str) -> np.ndarray:
        """P(grade > k) for every k."""
        columns, values, _ = self.vectors.row(text)
        return linear.sigmoid(self.weights[columns] @ values - self.thresholds)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from documents (doc_id, text) with labels (doc_id, toxic 0 or 1).  Runs jobs.

    About ``sample`` labels of either kind are drawn by the hash of the id, so
    the table that is sent to all tasks, and the rows of the one task that
    fits, are bounded by twice that number.  Copies count once.  Every feature
    that tells the labels apart is fitted, so a word weighs something even if
    it mostly occurs beside others.  Ids that repeat in the labels count as
    toxic if any says so.  Rare labels weigh as much as frequent ones
    do together.  Without both kinds the severity is 0 everywhere.
    """
    marks = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in marks.groupBy("toxic").count().collect()}
    either = [marks.filter((F.col("toxic") == k) & linear.drawn(F.col("doc_id"), sample / sizes[k])) for k in (0, 1) if sizes.get(k)]
    if len(either) < 2:
        return Model([], np.zeros(0), np.full(GRADES, 50.0))
    drawn = F.broadcast(stage(either[0].union(either[1]), "toxic-labels"))
    texts = docs.select("doc_id", "text").join(drawn, "doc_id").select("toxic", F.coalesce("text", F.lit("")).alias("text"))
    texts = stage(distinct_texts(texts), "toxic-sample")
    features = telling(texts)
    vectors = Vectors(features)

    def step(found: list[str]) -> dict[str, object]:
        rows = [vectors.row(t) for t in found]
        return {"i": [r[0] for r in rows], "v": [r[1] for r in rows], "n_words": [r[2] for r in rows]}

    def train(frame: pd.DataFrame) -> pd.DataFrame:
        toxic = frame.toxic.to_numpy()
        rows = linear.Rows(list(frame.i), list(frame.v), len(features))
        grade = graded(rows.times(np.ones(rows.columns)) / (1 + np.log1p(frame.n_words.to_numpy())), toxic)
        per_label = np.bincount(toxic, minlength=2)
        weights, thresholds = linear.fit_cumulative(rows, grade, GRADES + 1, 1 / per_label[toxic], penalty=1e-5, steps=1500)
        return pd.DataFrame({"k": np.arange(len(features) + GRADES), "x": np.concatenate([weights, thresholds])})

    found = map_texts(texts, step, "i array<long>, v array<double>, n_words long")
    x = {r["k"]: r["x"] for r in linear.in_one_task(found, train, "k long, x double").collect()}
    return Model(features, np.array([x.get(k, 0.0) for k in range(len(features))]), np.array([x.get(len(features) + k, 50.0) for k in range(GRADES)]))


def severities(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, severity (expected grade, 0 to GRADES), grade (the likeliest) and toxic (P(grade > 0) of a half or more).

    Every row of ``docs`` (doc_id, text) is scored by its whole text; null and
    empty texts have no features and the thresholds' severity.
    """

    def step(texts: list[str]) -> dict[str, object]:
        above = np.array([model.exceeding(t) for t in texts]).reshape(len(texts), -1)
        each = -np.diff(np.hstack([np.ones((len(texts), 1)), above, np.zeros((len(texts), 1))]), axis=1)
        return {"severity": above.sum(axis=1), "grade": each.argmax(axis=1), "toxic": above[:, 0] >= 0.5}

    return map_texts(docs.select("doc_id", "text"), step, "severity double, grade int, toxic boolean")
