import duckdb
import pytest
from helpers import ODD_TEXTS, docs, prose
from pyspark.sql import functions as F

from tallow.llm import mixing as M


def brute_targets(sizes, weights=M.WEIGHTS, most=M.MAX_EPOCHS):
    """Share by weight, cap, share the excess again, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(most * sizes[s] for s in capped)
        target = {s: most * sizes[s] if s in capped else left * w[s] / sum(w[x] for x in free) for s in names}
        over = [s for s in free if target[s] > most * sizes[s]]
        if not over:
            return target
        capped |= set(over)


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, prose(i, 1 + i % 40), "en", ["a", "b", "c", None, "hot", "hot", "hot"][i % 7]) for i in range(400)]
    rows += [(1000 + i, t, "en", "odd") for i, t in enumerate(ODD_TEXTS)] + [(2000, None, None, "empty"), (5, "x y", "en", "b"), (5, "x y", "en", "b")]
    return docs(spark, rows)


def test_targets_match_iterated_sharing(spark, corpus):
    rows = M.mix_report(corpus).collect()
    sizes = {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    expected = brute_targets(sizes)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(expected[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
    for s in sizes:
        assert sum(r["taken"] for r in rows if r["source"] == s) == round(expected[s])


def test_equals_sql(spark, corpus):
    got = M.mix_report(corpus)
    con = duckdb.connect()
    documents = corpus.toPandas()  # noqa: F841 - read by DuckDB
    want = con.sql(M.ORACLE_SQL)
    cols = sorted(want.columns)
    assert sorted(map(str, want.project(", ".join(cols)).fetchall())) == sorted(
        str(tuple(r)) for r in got.select(*cols).collect())


def test_mixed_documents_hold_the_words_taken(spark, corpus):
    report = {}
    for r in M.mix_report(corpus).collect():
        report[r["doc_id"]] = report.get(r["doc_id"], 0) + r["taken"]
    mixed = M.mix_documents(corpus)
    assert mixed.schema.simpleString() == corpus.schema.simpleString()
    words = {r[0]: r[1] for r in mixed.groupBy("doc_id").agg(F.sum(M.word_count(F.col("text")))).collect()}
    for d, n in report.items():
        assert words.get(d, 0) == n
    assert mixed.where("doc_id = 2000").count() == 1  # wordless documents stay once


def test_empty_table(spark, corpus):
    assert M.mix_report(corpus.limit(0)).count() == 0 and M.mix_documents(corpus.limit(0)).count() == 0


def test_native(spark, corpus):
    plan = M.mix_report(corpus)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
