import pytest
from pyspark.sql import functions as F
from compare import differences, duck
from samples import AWKWARD, documents, edited, prose
from test_decontaminate import brute as leaked
from test_oddsketch import brute as near
from test_packing import check
from test_quality import junk
from test_recipes import brute as copies

import corpus_pipeline
from signalframe.llm import packing
from signalframe.llm.queries import LLM_ORACLES, LLM_QUERIES


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    items = [prose(20 + k, 70 + k) for k in range(5)]
    texts = [prose(60 + k, k) for k in range(120)]
    for k in range(0, 60, 6):
        texts += [texts[k], texts[k].replace(" ", "  "), edited(texts[k], 0.02, k), junk(k)]
    texts += [f"{prose(30, 500 + k)} {item} {prose(30, 600 + k)}" for k, item in enumerate(items)] + AWKWARD
    documents(spark, texts).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), list(enumerate(texts)), items


def test_stages_equal_brute_force(spark, tables):
    folder, rows, items = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, held = docs.columns, dict(rows)
    for k, (_, step) in enumerate(corpus_pipeline.STAGES[:4]):
        docs = step(spark, docs, folder)
        assert docs.columns == columns
        now = {r.doc_id for r in docs.collect()}
        before = sorted(held.items())
        if k == 0:
            bad = {120 + 4 * n + 3 for n in range(10)}
            assert not now & bad and set(range(120)) <= now
        elif k == 1:
            assert now == {r[0] for r in copies(before) if r[3]}
        elif k == 2:
            assert now == {r[0] for r in near(before, 5, 80) if r[3]}
        else:
            assert now == set(held) - {i for i, _ in leaked(items, [t for _, t in before], [i for i, _ in before])}
        held = {i: held[i] for i in now}
    counts = docs.select("doc_id", packing.token_count(docs.text).alias("n")).collect()
    check(corpus_pipeline.STAGES[4][1](spark, docs, folder).collect(), [tuple(r) for r in counts], packing.CAPACITIES)


def test_run_takes_all_stages(spark, tables):
    folder, rows, _ = tables
    out = corpus_pipeline.run(spark, folder).collect()
    assert 100 < len({r.doc_id for r in out}) < len(rows)


def test_repeated_rows_and_empty_tables(spark, tables):
    folder, *_ = tables
    docs = documents(spark, ["same text here", "same  text here", "other text", None, "same text here"], [1, 1, 1, 2, 5])
    out = corpus_pipeline.exact_stage(spark, docs, folder).collect()
    assert sorted((r.doc_id, " ".join((r.text or "").split())) for r in out) == [(1, "other text"), (1, "same text here"), (2, "")]
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, docs.limit(0), folder).count() == 0


def test_decisions_hold_for_rows_not_for_ids(spark, tables):
    folder, _, items = tables
    a, b = prose(60, 901), prose(60, 902)
    near_a = edited(a + " " + prose(200, 903), 0.005, 1)
    texts = [(3, a), (5, a), (5, b), (None, "x y z"), (None, "x  y z"), (7, "x y z"), (None, "x y z"), (None, items[0]), (5, items[1]), (None, ""), (None, None)]

    def after(step, rows):
        docs = documents(spark, [t for _, t in rows], [i for i, _ in rows]).withColumn("row_key", F.lit(1))
        out = step(spark, docs, folder)
        assert out.columns == docs.columns
        return sorted(((r.doc_id, " ".join((r.text or "").split())) for r in out.collect()), key=repr)

    one = after(corpus_pipeline.exact_stage, texts)
    assert one == sorted([(3, a), (5, b), (7, "x y z"), (None, items[0]), (5, items[1]), (None, "")], key=repr)
    long_a = a + " " + prose(200, 903)
    two = after(corpus_pipeline.near_stage, [(None, long_a), (9, near_a), (8, long_a), (8, b), (None, b + " q"), (None, None), (1, " ")])
    assert two == sorted([(8, " ".join(long_a.split())), (8, b), (None, ""), (1, "")], key=repr)
    three = after(corpus_pipeline.benchmark_stage, [(None, f"{a} {items[0]} {b}"), (5, items[1]), (5, b), (None, a)])
    assert three == sorted([(5, b), (None, a)], key=repr)


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    assert differences(LLM_QUERIES[name](spark, sf_dir).toArrow(), duck(sf_dir).sql(LLM_ORACLES[name]).to_arrow_table()) == []


@pytest.mark.parametrize("name", sorted(set(LLM_QUERIES) - set(LLM_ORACLES)))
def test_queries_return_a_row_for_each_input(spark, sf_dir, name):
    out = LLM_QUERIES[name](spark, sf_dir)
    table, key = ("pages", "page_id") if "page_id" in out.columns else ("documents", "doc_id")
    there = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    if name.startswith(("op6", "op9")):
        assert out.join(there, key, "left_anti").count() == 0 and out.count() > 0
    else:
        assert out.count() == there.count() and out.select(key).distinct().count() == there.select(key).distinct().count()
