import hashlib
import re

from pyspark.sql import functions as F
from samples import AWKWARD, documents, prose

from signalframe.llm import recipes


def brute(rows):
    texts = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in rows]
    out = []
    for i, t in texts:
        same = [j for j, u in texts if u == t]
        named = [j for j in same if j is not None]
        keep = min(named) if named else None
        out.append((i, keep, len(same), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


def rows(df):
    return sorted([tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()], key=repr)


def texts():
    long = prose(3000, 1)
    return [*AWKWARD, long, long.replace(" ", "\n\t"), long + "x", "x" + long, long[:9000], *[prose(60, 2)] * 40, "z" * 20_000, "z" * 20_001]


def test_equals_brute_force(spark):
    t = texts()
    ids = list(range(len(t)))[::-1]
    assert rows(recipes.exact_duplicates(documents(spark, t, ids))) == brute(list(zip(ids, t)))


def test_digests_that_collide_are_resolved(spark):
    t = texts()
    found = recipes.exact_duplicates(documents(spark, t), digest=lambda c: F.substring(F.md5(c), 1, 1).cast("binary"))
    assert rows(found) == brute(list(enumerate(t)))


def test_repeated_and_missing_ids(spark):
    data = [(None, "a"), (None, "a"), (3, "b"), (3, "b"), (None, "b"), (2, "c")]
    found = recipes.exact_duplicates(documents(spark, [t for _, t in data], [i for i, _ in data]))
    assert rows(found) == brute(data)


def test_empty_table(spark):
    assert recipes.exact_duplicates(documents(spark, [])).count() == 0


def test_chunks_follow_the_content(spark):
    long = prose(8000, 3)
    both = {r.doc_id: r.chunks for r in recipes.document_chunks(documents(spark, [long, "inserted words " + long])).collect()}
    assert "".join(both[0]) == long and len(both[0]) > 20 and max(map(len, both[0])) <= 8192
    assert len(set(both[0]) & set(both[1])) > 0.8 * len(both[0])


def test_no_python_in_the_plan(spark):
    plan = recipes.exact_duplicates(documents(spark, ["a", "a"]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
