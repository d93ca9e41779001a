"""Base rules against plain Python, references and verdicts on small cases."""

import random
import re

import pytest
from pyspark.sql import functions as F
from samples import AWKWARD, documents, prose

from signalframe.llm import divergence as d

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)} if len(words) < 3000 else None
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": 0 if covered is None else len(covered),
    }


CASES = [
    *AWKWARD, "a b c d e a b c d e", "x x x x x x x x", "a b c d e f a b c d e f b c d e f g", "l\nl\n\n \nl \nl", "# | <x> & % *$ #",
    "\U0001F600 \U0001F600 é", "one\x85two\xa0three", "a b c d", "a b c d e", " ".join("pqrst" * 50), "line one two three four five\n" * 40,
]


def test_base_counts_equal_a_plain_count(spark):
    docs = documents(spark, CASES).withColumn("lang", F.lit(None).cast("string"))
    rows = {r["doc_id"]: r for r in d.quality_rules(docs).collect()}
    assert len(rows) == len(CASES)
    for i, text in enumerate(CASES):
        want = brute(text)
        assert {k: rows[i][k] for k in want} == want, (i, text and text[:60])
        failed = want["n_words"] < 10 or 100 * want["n_repeat_words"] > 20 * want["n_words"]
        assert rows[i]["base_failed"] == failed and not (failed and rows[i]["kept"])


def labelled(spark, rows):
    return spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate(rows)], "doc_id long, text string, lang string")


def with_function_words(seed, n=300):
    words = prose(n, seed).split()
    return " ".join(("ta", "na", "ko", "pi")[(i * 7 + seed) % 4] if i % 3 == 0 else w for i, w in enumerate(words))


def mixed(words, n, seed):
    draw = random.Random(seed)
    return " ".join(draw.choice(words) for _ in range(n))


ARABIC = mixed("كان يوم جميل في المدينة و ذهب الناس إلى السوق من أجل الخبز".split(), 120, 1)
CHINESE = "， ".join("城市里的人们早上去市场买面包然后回家" + chr(0x4E00 + 37 * k) * 2 for k in range(40))
CODE = "\n".join(f"def step_{k}(x{k}, y{k}):\n    total_{k} = x{k} * {k} + y{k}\n    return [total_{k} for _ in range({k})]" for k in range(30))


def test_divergent_texts_go_and_clean_ones_of_any_script_stay(spark):
    clean = [(with_function_words(s), "en") for s in range(40)]
    others = [(ARABIC, None), (CHINESE, "zh"), (CODE, "py"), (with_function_words(77), None), ("ta na ko pi " + prose(12, 3), "en")]
    digits = " ".join(str(10**9 + 7919 * k * k) for k in range(200))
    stuffed = " ".join(f"ta {w}" if i % 2 else f"ta ta ta {w}" for i, w in enumerate(prose(150, 8).split()))
    junk = [(digits, "en"), (" ".join(w + "&%$#" for w in with_function_words(50).split()), "en"),
            (with_function_words(51).upper(), "en"), (stuffed, "en")]
    docs = labelled(spark, [*clean, *others, *junk])
    kept = {r["doc_id"]: r["kept"] for r in d.quality_rules(docs).collect()}
    assert [i for i in range(len(clean) + len(others)) if not kept[i]] == []
    assert [i for i in range(len(clean) + len(others), len(kept)) if kept[i]] == []


def test_copies_ties_and_empty_tables(spark):
    text = with_function_words(5)
    rows = d.quality_rules(labelled(spark, [(text, "en")] * 5)).drop("doc_id").distinct().collect()
    assert len(rows) == 1 and rows[0]["kept"]
    empty = d.quality_rules(documents(spark, [], []).withColumn("n_words", F.lit(1)))
    assert empty.count() == 0
    assert [c for c in empty.columns][:8] == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "class_distance"]


def test_distances_equal_the_formula(spark):
    import math

    def jsd(p, q):
        m = [(a + b) / 2 for a, b in zip(p, q)]
        kl = lambda x: sum(a * math.log2(a / c) for a, c in zip(x, m) if a > 0)
        return math.sqrt((kl(p) + kl(q)) / 2)

    reference = d.Reference([0.05, 0.9, 0.0, 0.04, 0.01], {"the": 0.1, "of": 0.05, "in": 0.01})
    row = spark.range(1).select(
        F.array(*[F.lit(x) for x in (3, 80, 5, 0, 12)]).alias("classes"),
        F.expr("named_struct('n', 50L, 'common', array(named_struct('word', 'the', 'n', 9L), named_struct('word', 'no', 'n', 4L), named_struct('word', 'in', 'n', 1L)))").alias("plain"))
    got = row.select(d.class_distance(F.col("classes"), reference), d.word_distance(F.col("plain"), reference)).first()
    assert got[0] == pytest.approx(jsd([0.03, 0.8, 0.05, 0.0, 0.12], reference.classes))
    assert got[1] == pytest.approx(jsd([0.18, 0.0, 0.02, 0.8], [0.1, 0.05, 0.01, 0.84]))


def test_runs_without_python_workers(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = d.histograms(docs, ["the"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
