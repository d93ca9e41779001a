import zlib

from pyspark.sql import functions as F
from samples import AWKWARD, documents

from signalframe.llm import langid
from signalframe.llm.queries import LLM_QUERIES


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    out = LLM_QUERIES["op8_word_backoff"](spark, sf_dir).toPandas()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang").toPandas()
    both = out.merge(docs, on="doc_id")
    assert (both.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in both.doc_id]).all()
    assert (both[both.held_out].lang_pred == both[both.held_out].lang).mean() > 0.98 and both.score.between(0, 1).all()


def trained(spark):
    rows = [(k, t, x) for k, (t, x) in enumerate([("the river and the house", "en"), ("the mouse in the house", "en"), ("der fluss und das haus", "de"), ("die maus im haus und der hund", "de")] * 5)]
    return langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def test_words_first_then_shorter_grams(spark):
    model = trained(spark)
    assert model.languages == ["de", "en"]
    row = model.rows[model.word("haus")]
    assert row[0] > row[1] and "hausen" not in model.known
    assert model.predict("hausen fluss")[0] == "de" and model.predict("The THE rivers")[0] == "en"
    unseen = model.rows[model.word("qqqq")]
    assert unseen.shape == (2,)


def test_a_full_memory_changes_nothing(spark):
    model = trained(spark)
    texts = ["hausen mausen flussen hundert", "riverside mousehole houses", "xyz"]
    want = [model.predict(t) for t in texts]
    model.rows, model.place = model.rows[: len(model.known) + langid.REMEMBERED], dict(model.known)
    for k in range(3):
        model.word(f"filler{k}")
    model.rows = model.rows[: len(model.place) + 1]
    assert [model.predict(t) for t in texts] == want


def test_awkward_rows(spark):
    out = {r.doc_id: r for r in langid.predictions(documents(spark, AWKWARD), trained(spark)).collect()}
    assert all((out[k].lang_pred, out[k].score) == ("und", 0.0) for k in (0, 1, 2, 3, 12))
    assert all(0 <= r.score <= 1 for r in out.values()) and len(out) == len(AWKWARD)
    nothing = langid.fit(spark.createDataFrame([(1, None, "en"), (2, "x", None)], "doc_id long, text string, lang string"))
    assert [r.lang_pred for r in langid.predictions(documents(spark, ["some words"]), nothing).collect()] == ["und"]
    assert langid.predictions(documents(spark, []), nothing).count() == 0
    held = spark.createDataFrame([(None,), (1,)], "doc_id long").select(langid.held_out(F.col("doc_id")).alias("h")).collect()
    assert [r.h for r in held] == [True, zlib.crc32(b"1") % 5 == 0]
