import random

import numpy as np
from helpers import ODD_TEXTS, docs

from tallow.llm import language_id as L

SYLLABLES = {"en": "th ing er on the and of wh", "de": "sch ung ein der ich und keit pf", "fr": "eau oux tre que les ment oi é",
             "es": "ción ando que los ez ñ lla ar", "xx": "zzy qua kko vvi"}


def text(lang, seed):
    r = random.Random(f"{lang}{seed}")
    parts = SYLLABLES[lang].split()
    return " ".join("".join(r.choice(parts) for _ in range(r.randint(1, 3))) for _ in range(r.randint(8, 60)))


def corpus(spark):
    rows = [(i, text(lang, i), lang) for i, lang in enumerate(list(SYLLABLES) * 120)]
    return rows, docs(spark, rows)


def test_held_out_accuracy(spark):
    rows, d = corpus(spark)
    truth = {r[0]: r[2] for r in rows}
    held = [r for r in L.language_report(d).collect() if r["held_out"]]
    assert len(held) > 100 and sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in held)


def test_labels_of_held_out_rows_are_not_learned(spark):
    rows, d = corpus(spark)
    from pyspark.sql import functions as F
    poisoned = d.withColumn("lang", F.when(L.held_out(F.col("doc_id")), F.lit("poison")).otherwise(F.col("lang")))
    key = lambda r: r["doc_id"]
    assert sorted(L.language_report(d).collect(), key=key) == sorted(L.language_report(poisoned).collect(), key=key)


def test_odd_rows(spark):
    _, d = corpus(spark)
    odd = docs(spark, [(9000 + i, t) for i, t in enumerate([*ODD_TEXTS, "123 !?"])] + [(None, "the thing"), (9000, None)])
    got = L.language_report(d.union(odd).withColumnRenamed("source", "score")).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == d.count() + odd.count() and by[9000]["lang_pred"] == "und" and by[9010]["lang_pred"] == "und"


def test_without_labels_one_language_and_empty(spark):
    none = docs(spark, [(i, "some words") for i in range(9)])
    assert {(r["lang_pred"], r["score"]) for r in L.language_report(none).collect()} == {("und", 0.0)}
    one = docs(spark, [(i, "some words", "en") for i in range(9)])
    assert {r["lang_pred"] for r in L.language_report(one).collect()} == {"en"}
    assert L.language_report(none.limit(0)).count() == 0


def test_families():
    assert L.family_of("de") == L.family_of("en-GB") != L.family_of("fr") and L.family_of("zz") == "zz"


def test_very_long_texts_count_whole(spark):
    counts = L.gram_counts("the " * 100_000)
    assert counts.max() >= 100_000 and (L.unpacked(L.packed(counts)) == counts).all()
    few = L.gram_counts("the thing")
    assert len(L.packed(few)) == 2 * L.DIMENSIONS and (L.unpacked(L.packed(few)) == few).all()
    rows, d = corpus(spark)
    long = docs(spark, [(9000, text("fr", 1) + " " + " ".join(text("de", i) for i in range(3000)), "de"), (9003, "the " * 100_000, "en")])
    got = {r["doc_id"]: r["lang_pred"] for r in L.language_report(d.union(long)).collect()}
    assert got[9000] == "de" and got[9003] == "en"


def test_ties_go_to_the_first_language(spark):
    same = docs(spark, [(i, "la la la", "en" if i % 2 else "de") for i in range(60)])
    got = L.language_report(same).collect()
    assert len({(r["lang_pred"], r["score"]) for r in got}) == 1 and got[0]["lang_pred"] in ("de", "en")
    machine = L.Machine("de", "en", np.zeros(2, np.float32), 0.0, 1.0)
    assert L.Model._best(["de", "en"], [machine], np.zeros(2, np.float32)) == ("de", 0.5)
