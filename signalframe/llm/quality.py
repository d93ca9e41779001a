"""Document quality from weak labellers, expectation-maximisation and a hashed linear scorer."""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import Counter
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalframe.llm import linear
from signalframe.llm.common import UNSPACED, map_texts

#: Columns of the hashed features.
COLUMNS = 1 << 12
#: Documents, about, that the scorer is fitted on.
SAMPLE = 20_000
#: Column that the scorer adds.
SCORE = "__quality"
#: Marks that prose seldom holds.
MARKS = "#%&$*|{}<>=_~^\\@"


#: Signs that may end a plain word.
ENDS = ".,;:?'\")\u2019\u201d\u00bb\u3001\u3002\uff0c\uff01\uff1f\uff1a\uff1b\u300d\u300f\uff09\u060c\u061b\u061f\u0964\u037e\u00b7"
#: Signs that may begin one.
STARTS = "\"'(\u2018\u201c\u00ab\u00bf\u00a1\u300c\u300e\uff08"
#: What ends a sentence.
STOPS = (". ", ".\n", "? ", "! ", "\u3002", "\uff01", "\uff1f", "\u061f", "\u0964", "\u037e")
_SIGN = re.compile(f"[{UNSPACED}]")
_UNIT = re.compile(rf"[{re.escape(STARTS)}]*[{UNSPACED}][{re.escape(ENDS)}]*|[^\s{UNSPACED}]+")
_CODE_LINE = re.compile(
    r"\s*(?:(?://|#|/\*|\*|--).*|.*[;{}]|[)\]}]+[;,]*|[\w.:>-]+\(.*\)[;:,]?|[\w.\[\]\"'*&<>:, ]+[-+*/%|&^:]?= ?\S.*"
    r"|(?:def|class|if|elif|else|for|while|try|except|with|func|fn|function|public|private|static|switch|case)\b.*[:{(,]"
    r"|(?:return|import|from|package|use|using|raise|throw|break|continue|end|do|done|fi|pass)\b[\w\s.,()*+\"'\[\]/:-]*)\s*")


def units(text: str) -> list[str]:
    """Words as white space parts them; in scripts without spaces each character, with the punctuation around it."""
    return _UNIT.findall(text) if _SIGN.search(text) else text.split()


def is_plain(unit: str) -> bool:
    """Whether a unit is letters, or one character of a script without spaces, but for punctuation around it.

    Signs that combine with the letter before (vowels, tones) go with it.
    """
    bare = unit.strip(ENDS + STARTS)
    return bare.isalpha() or bool(bare) and all(c.isalpha() or unicodedata.category(c)[0] == "M" for c in bare)


def is_code(text: str) -> bool:
    """Whether a text is made like a program: brackets that balance, and most lines in the form of statements."""
    pairs = [(text.count(a), text.count(b)) for a, b in ("()", "[]", "{}")]
    if not any(a and b for a, b in pairs) or any(abs(a - b) > 0.1 * (a + b) for a, b in pairs):
        return False
    lines = [line for line in text.split("\n") if line.strip()]
    return sum(1 for line in lines if _CODE_LINE.fullmatch(line)) >= 0.7 * len(lines)


def votes(text: str) -> str:
    """A letter for each heuristic labeller: G(ood), B(ad) or - (no opinion).

    Faults: many marks, many cells, many words with odd signs, shouting,
    exclamation, repeated words, few different words, repeated lines.  Merits:
    plain lower-case words, varied words, sentences.  Most labellers speak for
    one class only.  Words are ``units``; in scripts without spaces variety is
    that of three characters in a row.  Programs are not blamed for marks
    and odd signs and count as plain.
    """
    words = units(text)
    n = len(words)
    if not n:
        return "-" * 11
    shouted = sum(map(str.isupper, words)) / n
    repeated = sum(map(eq, words, words[1:])) / n
    plain = sum(map(is_plain, words)) / n
    kinds = set(zip(words, words[1:], words[2:])) if n >= 20 and _SIGN.search(text) else set(words)
    different = len(kinds) / n**0.5  # grows with the root of the length in prose
    ends = sum(map(text.count, STOPS)) + (text.rstrip()[-1:] in ".!?")
    marked = sum(map(text.count, MARKS)) > 0.2 * n
    program = (marked or plain < 0.7) and is_code(text)
    lines = [line for line in text.split("\n") if len(line) > 20]
    faults = [
        marked and not program, text.count("|") > 0.1 * n, plain < 0.7 and not program, shouted > 0.3 and n >= 5, text.count("!") > 0.2 * n and n >= 5,
        repeated > 0.2 and n >= 5, different < 1.5 and n >= 20, len(lines) >= 6 and len(set(lines)) < 0.2 * len(lines),
    ]
    merits = [(program or plain > 0.9) and shouted < 0.1 and repeated < 0.05, repeated < 0.05 and different > 3 and n >= 20, 0.02 < ends / n < 0.5 and plain > 0.8]
    return "".join("-B"[f] for f in faults) + "".join("-G"[m] for m in merits)


def expectation_maximisation(patterns: dict[str, int], rounds: int = 200) -> tuple[dict[str, float], pd.DataFrame]:
    """Posterior probability of "good" for each pattern of votes, and the accuracies of the labellers.

    Labellers are taken as independent given the class.  A labeller is how often
    it votes in either class, re-estimated with the share of good documents from
    the posteriors of all documents until they stay.  The start says that a
    labeller votes often where it is right (0.9 for merits, 0.3 for faults, of
    which a document has few) and seldom where it is wrong; one pseudo document
    keeps chances off zero and one.  Accuracy is the share of its votes that
    agree with the posterior.
    """
    columns = ["labeller", "accuracy", "votes"]
    if not patterns:
        return {}, pd.DataFrame(columns=columns)
    names, count = list(patterns), np.array(list(patterns.values()), float)
    cast = np.array([[c != "-" for c in p] for p in names], float)
    merit = np.array([any(p[k] == "G" for p in names) for k in range(cast.shape[1])])
    if_good, if_bad, prior = np.where(merit, 0.9, 0.02), np.where(merit, 0.3, 0.3), 0.8

    def posterior() -> np.ndarray:
        good = cast @ np.log(if_good) + (1 - cast) @ np.log(1 - if_good) + np.log(prior)
        return linear.sigmoid(good - cast @ np.log(if_bad) - (1 - cast) @ np.log(1 - if_bad) - np.log(1 - prior))

    for _ in range(rounds):
        post = posterior()
        good, bad = count * post, count * (1 - post)
        if_good, if_bad = (good @ cast + 0.5) / (good.sum() + 1), (bad @ cast + 0.5) / (bad.sum() + 1)
        before, prior = prior, (good.sum() + 1) / (count.sum() + 2)
        if abs(prior - before) < 1e-9:
            break
    post = posterior()
    agreed = np.where(merit, (count * post) @ cast, (count * (1 - post)) @ cast)
    return dict(zip(names, post.tolist())), pd.DataFrame(dict(zip(columns, (range(len(merit)), agreed / np.maximum(1, count @ cast), count @ cast))))


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed columns and weights of a text: odd signs at the ends of words, case, repeats, variety, length.

    Each is a share of the words, drawn towards zero for short texts.  Programs
    have no signs and count as plain.
    """
    words = units(text)
    n = len(words)
    if not n:
        return np.empty(0, np.int64), np.empty(0)
    signs, plain = sum(map(text.count, MARKS)), sum(map(is_plain, words))
    program = (signs > 0.2 * n or plain < 0.7 * n) and is_code(text)
    found = {} if program else {f"last {c}": k for c, k in Counter("".join([w[-1] for w in words])).items() if not c.isalnum()}
    if not program:
        found |= {f"first {c}": k for c, k in Counter("".join([w[0] for w in words])).items() if not c.isalnum()}
        found |= {f"sign {c}": text.count(c) for c in MARKS + "!"}
    found |= {"shouted": sum(map(str.isupper, words)), "repeated": sum(map(eq, words, words[1:])), "few": 0 if program or _SIGN.search(text) else max(0, n - len(set(words)))}
    found |= {"plain": n if program else plain, f"length {n.bit_length()}": n}
    index = [zlib.crc32(key.encode("utf-8", "surrogatepass")) % COLUMNS for key, k in found.items() if k]
    return np.array(index, np.int64), np.array([min(1.0, k / n) * n / (n + 5) for k in found.values() if k])


def fit(docs: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, pd.DataFrame]:
    """Weights of the scorer (intercept last) and the table of labellers.  Runs jobs.

    Vote patterns are counted over all documents; at most 2**11 counts reach
    the driver.  The scorer is fitted to the posterior labels of about
    ``sample`` documents, drawn by the hash of their id.
    """
    texts = docs.select("doc_id", "text")
    voted = map_texts(texts.select("text"), lambda xs: {"votes": [votes(x) for x in xs]}, "votes string")
    patterns = {r["votes"]: r["count"] for r in voted.groupBy("votes").count().collect()}
    posterior, labellers = expectation_maximisation(patterns)
    if not patterns:
        return np.zeros(COLUMNS + 1), labellers

    def step(xs: list[str]) -> dict[str, object]:
        made = [features(x) for x in xs]
        return {"i": [m[0] for m in made], "v": [m[1] for m in made], "target": [float(posterior.get(votes(x), 0.5)) for x in xs]}

    def train(frame: pd.DataFrame) -> pd.DataFrame:
        rows = linear.Rows(list(frame.i), list(frame.v), COLUMNS)
        weights = linear.fit_logistic(rows, frame.target.to_numpy())
        return pd.DataFrame({"i": np.arange(len(weights)), "w": weights})

    share = sample / sum(patterns.values())
    drawn = map_texts(texts.filter(linear.drawn(F.col("doc_id"), share)), step, "i array<long>, v array<double>, target double")
    weights = np.zeros(COLUMNS + 1)
    for row in linear.in_one_task(drawn, train, "i long, w double").filter("w <> 0").collect():
        weights[row.i] = row.w
    return weights, labellers


def scored(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows and columns of ``docs`` (doc_id, text) with SCORE, the scorer's probability of "good".

    Nulls and empty texts get no vote and the intercept's score.  Rows that
    repeat a doc_id are scored by their own text.  Runs the jobs of ``fit``.
    """
    weights, _ = fit(docs, sample)
    body, intercept = weights[:-1], weights[-1]

    def step(xs: list[str]) -> dict[str, object]:
        logits = [float(body[i] @ v) + intercept for i, v in (features(x) for x in xs)]
        return {SCORE: pa.array(linear.sigmoid(np.array(logits)))}

    return map_texts(docs.withColumn("__text", F.col("text")), step, f"{SCORE} double", "__text")
