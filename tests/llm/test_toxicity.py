import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from helpers import ODD_TEXTS, docs, prose
from pyspark.sql import functions as F

from tallow.llm import toxicity as X
from tallow.llm.common import filesystem, joined, materialize, qualified


def test_nearest_equals_brute_force():
    r = np.random.RandomState(0)
    v, n = 120, 1500
    examples = [(i, int(r.rand() < .2), {int(t): int(r.randint(1, 4)) for t in r.choice(v, r.randint(0, 12))}) for i in range(n)]
    index = X.build_index({str(i): i for i in range(v)}, np.log(1 + n / r.randint(3, 500, v)), examples)
    dense = np.zeros((n, v))
    for i, (_, _, counts) in enumerate(examples):
        t, w = index.vector(counts)
        dense[i, t] = w
    for _ in range(200):
        t, w = index.vector({int(t): int(r.randint(1, 4)) for t in r.choice(v, r.randint(1, 9))})
        row, sim = index.nearest(t, w, 15)
        exact = np.round(dense[:, t] @ w, 9)
        want = np.lexsort((np.arange(n), -exact))[:15]
        want = want[exact[want] > 0]
        assert row.tolist() == want.tolist() and np.allclose(sim, exact[want])


def test_isotonic_is_monotone():
    x, y = X.isotonic([(0.1, 0), (0.2, 1), (0.3, 0), (0.4, 1), (0.4, 1)])
    assert (np.diff(x) > 0).all() and (np.diff(y) >= 0).all()
    x, y = X.isotonic([(0.1, 0)] * 9 + [(0.1, 1)])
    assert len(x) == 1 and y[0] == 0.1  # equal votes are one step


def corpus(spark):
    rows = [(i, prose(i, 40) + (f" grobian{'aeiou'[i % 5]}k" if i % 4 == 0 else "")) for i in range(600)]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(600)] + [(10 ** 6, 1, 1), (3, 1, None)],
                                   "doc_id bigint, quality int, toxic int")
    return docs(spark, rows), labels, rows


def test_held_out_accuracy_and_evidence(spark):
    d, labels, _ = corpus(spark)
    got = X.toxicity_report(d, labels).collect()
    held = [r for r in got if r["held_out"]]
    assert held and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert sum(r["predicted"] == (r["doc_id"] % 4 == 0) for r in held) >= 0.97 * len(held)
    assert all(len(r["evidence_ids"]) == len(r["evidence_similarity"]) <= X.NEIGHBOURS for r in got)
    assert any(r["evidence_ids"] for r in got if r["predicted"])


def test_odd_texts_and_stage(spark):
    d, labels, _ = corpus(spark)
    odd = docs(spark, [(10 ** 4 + i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, "x")])
    every = d.union(odd).withColumnRenamed("lang", "score")
    assert X.toxicity_report(every, labels).count() == every.count()
    out = X.drop_toxic(every, labels)
    assert out.schema.simpleString() == every.schema.simpleString()
    assert out.where("doc_id >= 10000 OR doc_id IS NULL").count() == len(ODD_TEXTS) + 1
    assert out.where((F.col("doc_id") % 4 == 0) & (F.col("doc_id") < 600)).count() < 10


def test_without_labels_and_empty(spark):
    d, labels, _ = corpus(spark)
    assert {r["score"] for r in X.toxicity_report(d, labels.limit(0)).collect()} == {0.0}
    assert X.toxicity_report(d.limit(0), labels).count() == 0


def test_small_label_set_is_searched_and_its_insults_dropped(spark):
    sf = "/root/testdata/sf0.001"
    d, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    insults = {r[0] for r in d.where(r"text RLIKE '(?i)\\b(idiot|loser|clown|disgusting)'").select("doc_id").collect()}
    got = {r["doc_id"]: r for r in X.toxicity_report(d, labels).collect()}
    left = {r[0] for r in X.drop_toxic(d, labels).select("doc_id").collect()}
    assert len(insults) == 8 and not insults & left
    assert len(left) > 0.8 * d.count()
    assert all(got[i]["evidence_ids"] for i in insults) and len({r["score"] for r in got.values()}) > 2


def test_every_term_counts_and_rare_stems_are_terms():
    w = X.term_weights(68, 10, np.array([1., 1., 4., 60.]), np.array([0., 1., 4., 9.]))
    assert (w > 0).all() and w[2] == w.max()
    assert "achlich~" in X.terms_of("achlichae".encode())


def test_mapped_index_is_the_index_that_was_written(spark, scratch):
    r = np.random.RandomState(1)
    examples = [(i, int(r.rand() < .3), {int(t): int(r.randint(1, 4)) for t in r.choice(900, r.randint(0, 60))}) for i in range(1200)]
    index = X.build_index({str(i): i for i in range(900)}, np.log(1 + 1200 / r.randint(3, 500, 900)), examples)
    folder = qualified(spark, scratch)
    filesystem(folder)[0].create_dir(filesystem(folder)[1], recursive=True)
    names = index.write(folder)
    mapped = X.Index.mapped(names)
    for a in X.Index.ARRAYS:
        kept, got = np.asarray(getattr(index, a)), np.asarray(getattr(mapped, a))
        assert kept.dtype == got.dtype and np.array_equal(kept, got), a
    # The large arrays, which every worker needs, are files in memory and not copies.
    assert all(isinstance(getattr(mapped, a).base, np.memmap) for a in ("terms", "postings"))
    some = [index.own(i) for i in range(0, 1200, 40)]
    for (rows, sims), (rows2, sims2) in zip(index.neighbours(some), mapped.neighbours(some), strict=True):
        assert np.array_equal(rows, rows2) and np.array_equal(sims, sims2)


def test_index_is_made_once_for_all_workers(spark, monkeypatch):
    d, labels, _ = corpus(spark)
    model = X.fit(d, labels)
    assert model.n == 600 - sum(zlib.crc32(str(i).encode()) % 5 == 0 for i in range(600))
    monkeypatch.setattr(X, "read_index", None)  # no worker needs it any more
    assert model.index().neighbours(model.index().vectors(["grobianak"]))[0][0].size


def test_keys_of_terms():
    terms = ["", "a", "é", "sch~", *map(str, range(200))]
    assert X.term_keys(terms).tolist() == [X.term_key(t) for t in terms] and X.term_keys([]).dtype == np.int64


def test_examples_are_read_in_parts_and_not_held_twice(spark):
    r = np.random.RandomState(2)
    rows = [(int(i), int(i % 3 == 0), sorted(r.choice(500, r.randint(0, 9), replace=False).tolist())) for i in r.permutation(300)]
    as_bytes = lambda x, kind: np.array(x, kind).tobytes()
    table = materialize(spark.createDataFrame(
        [(i, y, len(t), 70000 if i == 5 and t else 1, bytearray(as_bytes(t, "<i4")), bytearray(as_bytes([70000 if i == 5 else 1] * len(t), "<u4")))
         for i, y, t in rows], "doc_id bigint, y int, size bigint, most bigint, terms binary, counts binary").repartition(4), "test")
    monkey, X.EXAMPLE_ROWS = X.EXAMPLE_ROWS, 7
    try:
        ids, y, sizes, vectors = X._example_table(table._tallow_path)
    finally:
        X.EXAMPLE_ROWS = monkey
    rows.sort()
    assert ids.tolist() == [i for i, _, _ in rows] and y.tolist() == [y for _, y, _ in rows]
    assert sizes.tolist() == [len(t) for _, _, t in rows] and vectors[0].tolist() == [x for _, _, t in rows for x in t]
    assert vectors[1].max(initial=0) == (70000 if rows[5][2] else 1)
    X.Index(np.arange(500), np.ones(500), ids, y, sizes, vectors)
    assert vectors == []  # given up to the index, which has its own order


def test_words_of_a_task_are_not_kept_by_the_index(spark):
    d, labels, rows = corpus(spark)
    index = X.fit(d, labels).index()
    reader = X.Terms(index.keys)
    texts = [t for _, t in rows[:9]]
    for (t, w), (t2, w2) in zip(index.vectors(texts), index.vectors(texts, reader), strict=True):
        assert np.array_equal(t, t2) and np.array_equal(w, w2)
    assert reader.known and not any(isinstance(x, X.Terms) for x in vars(index).values())


def test_texts_read_together_have_the_terms_of_their_words(monkeypatch):
    texts = [t or "" for t in ODD_TEXTS] + [prose(i, 30) for i in range(40)] + [
        "ΑΣ'Α ΟΔΟΣ İstanbul", " Straße, straße! ", "a-b_c\x00d\x1ce\u2028f", "Überlänge überlängen", "x" * 3 + "\n" * 3, "kara karane karanen"] + [""]
    want = []
    for t in texts:
        words = Counter(t.lower().encode().translate(X._TO_SPACE).split())
        want.append(Counter())
        for w, c in words.items():
            want[-1].update({x: c for x in X.terms_of(w)})
    keys = np.unique(X.term_keys([x for w in want[::2] for x in w]))  # some terms are unknown
    for chunk in (1 << 20, 60):
        monkeypatch.setattr(X, "CHUNK_BYTES", chunk)
        free, known = X.Terms(), X.Terms(keys)
        for got, at, w in zip(free.counts(texts), known.counts(texts), want, strict=True):
            by_key = {X.term_key(x): c for x, c in w.items()}
            assert got[0].tolist() == sorted(by_key) and got[1].tolist() == [by_key[x] for x in sorted(by_key)]
            by_key = {x: c for x, c in by_key.items() if x in set(keys.tolist())}
            assert keys[at[0]].tolist() == sorted(by_key) and at[1].tolist() == [by_key[x] for x in sorted(by_key)]
        # No object for each word: those would lie about in a worker's memory after its task.
        assert known.known and all(isinstance(a, np.ndarray) for a in known.known)


def test_terms_that_queries_share_are_one_product(monkeypatch):
    monkeypatch.setattr(X, "COLUMNS", 3)
    r = np.random.RandomState(3)
    v, n = 60, 3000
    examples = [(i, int(r.rand() < .2), {int(t): int(r.randint(1, 4)) for t in r.choice(v, r.randint(0, 4))}) for i in range(n)]
    index = X.build_index({str(i): i for i in range(v)}, np.log(1 + n / r.randint(3, 500, v)), examples)
    asked = [index.vector({int(t): 1 for t in [0, 1, 2, 3, 4, *r.choice(v, 3)]}) for _ in range(100)] + [index.vector({7: 1}), index.vector({})]
    assert not index.in_head.any()
    left = [t[some].tolist() for (t, _), (_, some) in zip(asked, index.heads(asked), strict=True)]
    assert all(not set(t) & {0, 1, 2, 3, 4} for t in left) and any(left)
    dense = np.zeros((n, v))
    for i, (_, _, counts) in enumerate(examples):
        t, w = index.vector(counts)
        dense[i, t] = w
    without = [int(x) for x in r.randint(0, n, len(asked))]
    for (t, w), x, (row, sim) in zip(asked, without, index.neighbours(asked, without), strict=True):
        exact = np.round(dense[:, t] @ w, 9)
        exact[x] = 0
        want = np.lexsort((np.arange(n), -exact))[:X.NEIGHBOURS]
        want = want[exact[want] > 0]
        assert row.tolist() == want.tolist() and np.allclose(sim, exact[want])


def test_a_group_of_queries_reads_few_postings_and_finds_the_exact_nearest(monkeypatch):
    monkeypatch.setattr(X, "PART", 128)
    monkeypatch.setattr(X, "SCAN", 50)
    r = np.random.RandomState(4)
    n, words, read = 1500, 300, []

    def text(i):  # of one of two languages; each word comes with its twin, a beginning no other word has
        low = 0 if i % 3 else words // 2
        some = low + np.minimum(r.geometric(.03, 40), words // 2) - 1
        return {int(t) + twin: int(c) for t, c in Counter(some.tolist()).items() for twin in (0, words)}

    idf = np.tile(np.log(1 + n / r.randint(3, 500, words)), 2)
    examples = [(i, int(r.rand() < .2), text(i)) for i in range(n)]
    examples[7] = (7, 0, {**examples[7][2], words: 9})  # this word's twin differs in one example
    index = X.build_index({str(i): i for i in range(2 * words)}, idf, examples)
    assert index.same[words] != index.same[0] and (index.same[1:words] == index.same[words + 1:]).all()
    monkeypatch.setattr(index, "_read", lambda b, s, w: (read.append(int(s.sum())), X.Index._read(index, b, s, w))[1])
    asked = [index.vector(text(i)) for i in range(400)] + [index.vector({})]
    found = index.neighbours(asked)
    assert sum(read) < 0.2 * sum(int(index.df[t].sum()) for t, _ in asked)
    dense = np.zeros((n, 2 * words))
    for i, (_, _, counts) in enumerate(examples):
        t, w = index.vector(counts)
        dense[i, t] = w
    for (t, w), (row, sim) in zip(asked, found, strict=True):
        exact = np.round(dense[:, t] @ w, 9)
        want = np.lexsort((np.arange(n), -exact))[:X.NEIGHBOURS]
        want = want[exact[want] > 0]
        assert np.allclose(sim, exact[want], atol=2e-9) and np.allclose(exact[row], exact[want], atol=2e-9)


def test_batches_are_joined_up_to_a_size():
    batches = [pa.RecordBatch.from_arrays([pa.array([i] * k, pa.int64())], names=["x"]) for i, k in enumerate((3, 0, 4, 9, 1, 1))]
    sizes = lambda *a: [b.num_rows for b in joined(iter(batches), *a)]
    assert sizes(8) == [7, 9, 2] and sizes(100) == [18] and sizes(100, 60) == [7, 9, 2] and sizes(1) == [3, 0, 4, 9, 1, 1]
    assert [x for b in joined(iter(batches), 5) for x in b.column(0).to_pylist()] == [0] * 3 + [2] * 4 + [3] * 9 + [4, 5]
    assert list(joined(iter([]), 5)) == []
