import random
from itertools import combinations

import numpy as np
import pytest
from helpers import ODD_TEXTS, docs, prose

from tallow.llm import near_dedup as N
from tallow.llm.components import components


def brute(rows, k, percent=80):
    sets = {}
    for at, (d, t) in enumerate(rows):
        w = (t or "").encode().lower().split()
        s = frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()
        sets[at] = s
    node = [d for d, _ in rows]
    parent = {d: d for d in node}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sets, 2):
        i = len(sets[a] & sets[b])
        if i and 100 * i >= percent * (len(sets[a]) + len(sets[b]) - i):
            x, y = find(node[a]), find(node[b])
            parent[max(x, y)] = min(x, y)
    return sorted((d, len(sets[at]), find(d)) for at, d in enumerate(node))


def edited(text, seed, rate):
    r = random.Random(seed)
    return " ".join(w if r.random() > rate else f"w{r.randint(0, 10 ** 6)}" for w in text.split())


def found(spark, rows, k):
    got = N.near_duplicates(docs(spark, rows), shingle=k)
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect())


@pytest.fixture(scope="module")
def rows():
    base, other = prose(1, 150), prose(2, 60)
    out = [(i, edited(base, i, 0.02)) for i in range(100, 160)]  # near copies around the threshold
    out += [(i, edited(other, i, 0.005 * (i % 8))) for i in range(200, 240)]
    out += [(i, prose(i, 5 + i % 90)) for i in range(300, 360)]
    out += [(i, base) for i in range(400, 430)] + [(430 + i, t) for i, t in enumerate(ODD_TEXTS)]
    return out + [(500, "One two three"), (501, "one TWO three"), (502, "one two three four"), (503, "É a b c"), (504, "é a b c")]


@pytest.mark.parametrize("k", [4, 5])
@pytest.mark.parametrize("small", [2, 16])
def test_equals_brute_force(spark, rows, k, small, monkeypatch):
    monkeypatch.setattr(N, "SMALL", small)  # 2: all larger buckets go by blocks
    monkeypatch.setattr(N, "BLOCK", 8)
    assert found(spark, rows, k) == brute(rows, k)


@pytest.mark.parametrize("small", [2, 16])
def test_rows_that_repeat_an_id_are_one_node(spark, rows, small, monkeypatch):
    monkeypatch.setattr(N, "SMALL", small)
    monkeypatch.setattr(N, "BLOCK", 8)
    a, b = prose(11, 80), prose(12, 80)
    assert [c for *_, c in found(spark, [(1, a), (5, a), (0, b), (5, b)], 4)] == [0] * 4
    r = random.Random(3)
    again = rows + [(r.choice(rows)[0], r.choice(rows)[1]) for _ in range(25)]
    again += [(600, edited(a, i, 0.01)) for i in range(12)] + [(601 + i, edited(a, 50 + i, 0.03)) for i in range(12)]
    again += [(600, a), (600, a[:200]), (700, ""), (700, a), (701, None), (701, " "), (702, None), (702, b)]
    assert found(spark, again, 4) == brute(again, 4)


def test_very_long_texts_and_clashing_columns(spark):
    long = prose(21, 60_000)
    rows = [(9, long), (3, edited(long, 1, 0.01)), (4, prose(22, 60_000)), (-2 ** 63, "a b c d e"), (2 ** 63 - 1, "a b c d e")]
    clash = docs(spark, rows).withColumnsRenamed({"lang": "component_id", "source": "text_hash", "n_chars": "set_id"})
    got = N.near_duplicates(clash, shingle=4).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == brute(rows, 4)
    out = N.drop_near_duplicates(clash)
    assert out.columns == clash.columns and sorted(r[0] for r in out.collect()) == [-2 ** 63, 3, 4]


def test_sketch_estimates_similarity_and_is_full():
    r = np.random.RandomState(0)
    a = r.randint(0, 2 ** 62, 400).astype(np.uint64)
    b = np.concatenate([a[:300], r.randint(0, 2 ** 62, 100).astype(np.uint64)])
    agree = np.mean(N.sketch(a, 2000) == N.sketch(b, 2000))
    assert abs(agree - 300 / 500) < 0.05
    one = N.sketch(a[:1], 64)
    assert len(one) == 64 and (one != np.uint64(2 ** 64 - 1)).all()


def test_components_of_long_paths_and_hubs(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(200, 260)] + [(260, 259), (50, 50)]
    df = spark.createDataFrame(edges, "u bigint, v bigint").repartition(4)
    got = dict(map(tuple, components(df).collect()))
    assert all(got[i] == 100 for i in range(100, 141)) and all(got[i] == 7 for i in [7, *range(200, 261)])


def test_stage_keeps_one_of_each_group_and_odd_rows(spark, rows):
    extra = docs(spark, [*rows, (300, prose(300, 5)), (None, prose(1, 150)), (None, None)]).withColumnRenamed("lang", "kept")
    out = N.drop_near_duplicates(extra)
    assert out.schema.simpleString() == extra.schema.simpleString()
    ids = [r["doc_id"] for r in out.collect()]
    want = brute(rows, 5)
    assert sorted(i for i in ids if i is not None) == sorted(d for d, _, c in want if c == d) and ids.count(None) == 2


def test_empty_table(spark, rows):
    d = docs(spark, rows).limit(0)
    assert N.near_duplicates(d).count() == 0 and N.drop_near_duplicates(d).count() == 0
