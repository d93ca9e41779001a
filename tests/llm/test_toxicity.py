import numpy as np
from samples import AWKWARD, documents, prose

from signalframe.llm import linear, toxicity

INSULTS = ["grobalus", "zanktor", "mufferel"]


def corpus(n=600):
    texts, toxic = [], []
    for k in range(n):
        words = prose(40 + k % 120, k).split()
        if k % 5 == 0:
            for j in range(1 + k % 4):
                words.insert((7 * j + k) % len(words), INSULTS[(k + j) % 3] + ("en" if k % 2 else ""))
        texts.append(" ".join(words))
        toxic.append(int(k % 5 == 0))
    return texts, toxic


def labels(spark, toxic, ids=None):
    ids = range(len(toxic)) if ids is None else ids
    return spark.createDataFrame([(i, t, "clash") for i, t in zip(ids, toxic)], "doc_id long, toxic int, text string")


def test_cumulative_links_recover_the_model():
    draw = np.random.default_rng(0)
    x = draw.normal(size=(6000, 2))
    latent = x @ [1.5, -1.0] + draw.logistic(size=6000)
    grade = np.searchsorted([-1.0, 0.5, 2.0], latent)
    w, t = linear.fit_cumulative(linear.Rows([np.arange(2)] * 6000, list(x), 2), grade, 4, np.ones(6000), 0, 1500)
    assert np.allclose(w, [1.5, -1.0], atol=0.15) and np.allclose(t, [-1, 0.5, 2], atol=0.15) and (np.diff(t) > 0).all()


def test_finds_insults_it_was_not_shown_whole(spark):
    texts, toxic = corpus()
    shown = [k for k in range(600) if k % 7]
    docs = documents(spark, texts)
    model = toxicity.fit(docs, labels(spark, [toxic[k] for k in shown], shown))
    out = {r.doc_id: r for r in toxicity.severities(docs, model).collect()}
    assert [out[k].toxic for k in range(600)] == [bool(t) for t in toxic]
    one, many = toxicity.severities(documents(spark, [prose(50, 1) + " grobalus", prose(50, 1) + " grobalus zanktoren mufferel" * 3]), model).collect()
    assert 0 <= one.severity < many.severity <= toxicity.GRADES and one.grade <= many.grade


def test_awkward_rows(spark):
    texts, toxic = corpus(100)
    docs = documents(spark, [*texts, *AWKWARD], [*range(100), *range(1000, 1000 + len(AWKWARD))])
    marks = labels(spark, [*toxic, None, 1, 0], [*range(100), 1000, None, 50])
    out = toxicity.severities(docs, toxicity.fit(docs, marks)).collect()
    assert len(out) == docs.count() and not any(r.toxic for r in out if r.doc_id >= 1000)


def test_one_label_or_none(spark):
    docs = documents(spark, ["a b", None])
    for marks in ([0, 0], [1, 1], []):
        out = toxicity.severities(docs, toxicity.fit(docs, labels(spark, marks))).collect()
        assert [r.toxic for r in out] == [False, False] and all(r.severity < 1e-6 for r in out)
    assert toxicity.severities(docs.limit(0), toxicity.fit(docs, labels(spark, []))).count() == 0


def test_words_beside_others_are_telling_too(spark):
    """Three of four words always stand beside grobalus in what is labelled; alone they must tell as well."""
    beside = ["zanktor", "mufferel", "plimbost"]
    texts, toxic = [], []
    for k in range(400):
        words = prose(40 + k % 60, k).split()
        if k % 5 == 0:
            for j, word in enumerate(["grobalus", beside[k // 5 % 3]]):
                words.insert((11 * j + k) % len(words), word)
        texts.append(" ".join(words))
        toxic.append(int(k % 5 == 0))
    texts += [f"{prose(60, 1000 + k)} {' '.join(beside[: k % 3 + 1] * 3)}" for k in range(12)]
    docs = documents(spark, texts)
    out = {r.doc_id: r.toxic for r in toxicity.severities(docs, toxicity.fit(docs, labels(spark, toxic))).collect()}
    assert [out[k] for k in range(len(texts))] == [bool(t) for t in toxic] + [True] * 12


def test_copies_count_once(spark):
    rows = [(f"{prose(30, k)} grobalus", 1) for k in range(6)] + [("Vunderlo, kest", 1), ("vunderlo  kest", 1)] * 10 + [(prose(30, 100 + k), 0) for k in range(40)]
    names = toxicity.telling(toxicity.distinct_texts(spark.createDataFrame(rows, "text string, toxic int")))
    assert names == ["grobal*"]
