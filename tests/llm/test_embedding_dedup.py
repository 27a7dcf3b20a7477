import math

import numpy as np
import pytest

from tallow.llm import embedding_dedup as E

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(x != 0 for x in v)


def brute(rows, cosine=E.COSINE):
    """Links between distinct (id, label, vector); rows sharing an id share a component."""
    nodes = sorted({(i, lab, tuple(float(x) for x in v)) for i, v, lab in rows if i is not None and lab is not None and usable(v)})
    parent = {i: i for i, *_ in rows}
    links = dict.fromkeys(nodes, 0)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, a in enumerate(nodes):
        for b in nodes[n + 1:]:
            if a[1] == b[1] and len(a[2]) == len(b[2]):
                x, y = np.array(a[2]), np.array(b[2])
                if x @ y / math.sqrt(x @ x) / math.sqrt(y @ y) >= cosine:
                    links[a] += 1
                    links[b] += 1
                    p, q = find(a[0]), find(b[0])
                    parent[max(p, q)] = min(p, q)
    out = []
    for i, v, lab in rows:
        n = links.get((i, lab, tuple(float(x) for x in v)), 0) if lab is not None and usable(v) and i is not None else 0
        out.append((i, n, None if i is None else find(i), i is None or find(i) == i))
    return sorted(out, key=str)


def result(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted([tuple(r) for r in E.near_duplicates(df, **kw).collect()], key=str)


def cluster(r, centre, n, noise, dim):
    return [(centre + noise * r.normal(size=dim)).astype(np.float32).tolist() for _ in range(n)]


@pytest.fixture(scope="module")
def rows():
    r = np.random.RandomState(0)
    dim, vecs = 16, []
    for noise in (0.02, 0.1, 0.25, 0.4):  # around the threshold: sparse chains and dense groups
        for _ in range(3):
            vecs += cluster(r, r.normal(size=dim), 12, noise, dim)
    vecs += cluster(r, np.zeros(dim), 60, 1.0, dim)
    copy = cluster(r, r.normal(size=dim), 1, 0.1, dim)[0]
    out = [(1000 - i, v, i % 2) for i, v in enumerate(vecs)]
    out += [(2000 + i, copy, 1) for i in range(20)] + [(2050, [2 * x for x in copy], 1), (2051, [-x for x in copy], 1)]
    out += [(3000, None, 0), (3001, [], 0), (3002, [0.0] * dim, 0), (3003, [float("nan")] + [1.0] * (dim - 1), 0),
            (3004, [float("inf")] * dim, 1), (3005, [None] + copy[1:], 1), (3006, copy, None), (None, copy, 1),
            (3007, [1.0, 2.0], 1), (3008, [1.01, 2.0], 1), (3009, [1.0], 1), (3010, [3.0], 1), (3011, [-3.0], 1)]
    out += [(4000, vecs[0], 0), (4000, vecs[40], 0), (4000, vecs[40], 0), (4001, vecs[100], 1), (4001, copy, 1)]
    return out


@pytest.mark.parametrize("blocks", [1, 4, 16])
def test_equals_brute_force(spark, rows, blocks):
    assert result(spark, rows, blocks=blocks) == brute(rows)


@pytest.mark.parametrize("chunk, most", [(7, 7), (3, 40)])
def test_chunks_and_tiles_change_nothing(spark, rows, monkeypatch, chunk, most):
    monkeypatch.setattr(E, "TILE", 5)
    monkeypatch.setattr(E, "CHUNK", chunk)
    monkeypatch.setattr(E, "MAX_CHUNK", most)
    assert result(spark, rows) == brute(rows)


def test_other_thresholds(spark, rows):
    assert result(spark, rows, cosine=0.8) == brute(rows, 0.8)


def test_a_linked_pair_is_within_the_budget_of_some_block():
    r = np.random.RandomState(3)
    base = r.normal(size=(500, 24)) * np.linspace(3, 0.1, 24)
    unit = E.units([x.tobytes() for x in base], 24, "<f8")
    space = E.Subspaces(24, 0.93, 4, np.cov(unit.T))
    near = base + 0.3 * r.normal(size=base.shape) * np.abs(base)
    other = E.units([x.tobytes() for x in near], 24, "<f8")
    linked = np.einsum("ij,ij->i", unit, other) >= 0.93
    ok = space.within(space.rotate(unit), space.rotate(other)).any(axis=1)
    assert linked.sum() > 50 and ok[linked].all() and math.isclose(space.budget.sum(), 0.14 * (1 + E.SLACK))


def test_empty_table_clashing_columns_and_doubles(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    assert E.near_duplicates(df.limit(0)).count() == 0
    odd = df.selectExpr("vec_id", "cast(embedding as array<double>) embedding", "label", "1 AS key", "2 AS id", "3 AS n_links", "4 AS block")
    assert sorted([tuple(r) for r in E.near_duplicates(odd).collect()], key=str) == brute(rows)


def test_no_usable_vector(spark):
    assert result(spark, [(1, None, 0), (2, [0.0], 0)]) == [(1, 0, 1, True), (2, 0, 2, True)]
