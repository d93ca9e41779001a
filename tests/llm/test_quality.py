import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from samples import AWKWARD, documents, prose

from signalframe.llm import linear, quality


def junk(k):
    words = prose(60, k).split()
    return [" ".join(w + "###%%%***&&&"[3 * (n % 4) : 3 * (n % 4) + 3] for n, w in enumerate(words)), " ".join(w.upper() + "!!" for w in words), " | ".join(words), " ".join([words[0]] * 60)][k % 4]


def test_expectation_maximisation_finds_the_labellers():
    draw = np.random.default_rng(1)
    good = draw.random(20_000) < 0.85
    chance = [(0.01, 0.4), (0.02, 0.3), (0.0, 0.25), (0.9, 0.1), (0.8, 0.2)]  # of a vote, in good and bad
    cast = np.array([draw.random(len(good)) < np.where(good, g, b) for g, b in chance]).T
    votes = ["".join("BBBGG"[k] if c else "-" for k, c in enumerate(row)) for row in cast]
    posterior, labellers = quality.expectation_maximisation({v: votes.count(v) for v in set(votes)})
    right = np.mean((np.array([posterior[v] for v in votes]) > 0.5) == good)
    truth = [good[cast[:, k]].mean() if k > 2 else 1 - good[cast[:, k]].mean() for k in range(5)]
    assert right > 0.93 and np.allclose(labellers.accuracy, truth, atol=0.06)
    assert quality.expectation_maximisation({})[0] == {}


def test_keeps_prose_and_rejects_junk(spark):
    texts = [junk(k) if k % 8 == 0 or k % 8 == 3 else prose(20 + k % 300, k) for k in range(400)]
    texts = [junk(k // 8) if k % 8 == 0 else t for k, t in enumerate(texts)]
    bad = [k % 8 == 0 or k % 8 == 3 for k in range(400)]
    docs = documents(spark, texts)
    out = quality.scored(docs)
    assert out.columns == [*docs.columns, quality.SCORE]
    got = {r.doc_id: r[quality.SCORE] >= 0.5 for r in out.collect()}
    assert [got[k] for k in range(400)] == [not b for b in bad]


def test_agrees_with_labels(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    both = quality.scored(docs).join(labels, "doc_id").select("quality", quality.SCORE).toPandas()
    assert ((both[quality.SCORE] >= 0.5) == (both.quality == 1)).mean() > 0.97


def test_awkward_rows(spark):
    out = quality.scored(documents(spark, AWKWARD)).collect()
    assert len(out) == len(AWKWARD) and all(0 <= r[quality.SCORE] <= 1 for r in out)
    assert quality.scored(documents(spark, [])).count() == 0
    assert quality.scored(documents(spark, ["a b.", "a b.", None], [None, None, 1])).count() == 3


def test_logistic_fits_soft_targets():
    draw = np.random.default_rng(0)
    x = draw.normal(size=(2000, 3))
    target = linear.sigmoid(x @ [1.0, -2.0, 0.5] + 0.3)
    rows = linear.Rows([np.arange(3)] * 2000, list(x), 3)
    assert np.allclose(linear.fit_logistic(rows, target, 0, 2000), [1, -2, 0.5, 0.3], atol=0.05)
    assert isinstance(quality.expectation_maximisation({"B-G": 3})[1], pd.DataFrame)
