import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from helpers import ODD_TEXTS, docs, prose

from tallow.llm import lexical_search as L

TERM = re.compile(L.TERM)


def tokens(text):
    return TERM.findall((text or "").translate(str.maketrans(L.UPPER, L.LOWER)))


def brute(rows, items, depth):
    counts = [(d, Counter(tokens(t))) for d, t in rows]
    counts = [(d, c) for d, c in counts if c]
    n_docs, total = len(counts), sum(c.total() for _, c in counts)
    df = Counter(w for _, c in counts for w in c)
    terms = {}
    for i, t in items:
        terms.setdefault(i, set()).update(tokens(t))
    out = set()
    for i, words in terms.items():
        scored = []
        for d, c in counts:
            m = 50 + (50 * c.total() * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                    * ((10 ** 9 * c[w]) // (1000 * c[w] + 20 * m)) for w in words if c[w])
            if s > 0:
                scored.append((-s, d is None, d if d is not None else 0))
        for rank, (s, null, d) in enumerate(sorted(scored)[:depth], 1):
            out.add((i, rank, None if null else d, -s))
    return out


def items_table(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, text string").repartition(2)


def ranked(df):
    rows = [tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.fixture(scope="module")
def rows():
    out = [(i, prose(i, 5 + i % 60)) for i in range(150)]
    out += [(200 + i, prose(3, 30)) for i in range(20)]  # ties, settled by id
    out += [(300 + i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, prose(3, 30)), (None, None), (7, prose(7, 12)), (7, prose(7, 12))]
    out += [(400, "Kara-LONE: kara!\tlone\x00x"), (401, "É kara é"), (402, prose(9, 4000)), (-5, prose(3, 30))]
    return out


@pytest.fixture(scope="module")
def items():
    return [(i, prose(1000 + i, 3 + 4 * i)) for i in range(6)] + [
        (50, None), (51, "  ..."), (52, "kara"), (52, "LONE É"), (None, "kara miran"), (53, prose(3, 30)),
        (54, " ".join(f"w{j}" for j in range(90)) + " " + prose(4, 40))]


@pytest.mark.parametrize("depth", [3, 50])
def test_equals_brute_force(spark, rows, items, depth, monkeypatch):
    monkeypatch.setattr(L, "CHUNK", 8)
    got = ranked(L.rank_documents(docs(spark, rows), items_table(spark, items), depth))
    assert got == brute(rows, items, depth)


def test_batches_of_items_give_the_same_ranks(spark, rows, items, monkeypatch):
    monkeypatch.setattr(L, "ITEM_TERMS", 40)
    got = ranked(L.rank_documents(docs(spark, rows), items_table(spark, items), 5))
    assert got == brute(rows, items, 5)


def test_masks_below_the_floor_are_not_scored():
    r = np.random.RandomState(1)
    n, size = 2000, 30
    lists = [np.unique(r.randint(0, size, r.randint(1, 12))) for _ in range(n)]
    terms = np.concatenate(lists)
    block = L.Block(np.arange(n), np.zeros(n, bool), r.randint(5, 50, n), np.array([len(x) for x in lists]), terms,
                    np.ones(len(terms), np.int64), r.randint(1, 9000, size), n, 20 * n)
    item = np.arange(0, size, 3)
    best, every = L.Best(10), L.Best(10)
    scored = block.search(item, best)
    every.add(block.scores(np.arange(n), np.isin(np.arange(size), item)), block.ids, block.null)
    assert scored < n / 2 and (best.ids == every.ids).all() and (best.scores == every.scores).all()


def test_terms_are_the_maximal_matches():
    r = random.Random(0)
    for _ in range(300):
        text = "".join(chr(r.choice([*range(0, 128), 0xE9, 0xA0, 0x4E2D, 0x1F600, 0x2003])) for _ in range(40))
        assert [t.decode() for t in L.terms_of(text.encode())] == tokens(text)


def test_empty_tables_and_clashing_columns(spark, rows, items):
    d, i = docs(spark, rows), items_table(spark, items)
    assert L.rank_documents(d.limit(0), i).count() == 0 and L.rank_documents(d, i.limit(0)).count() == 0
    odd = d.withColumnRenamed("lang", "score").withColumnRenamed("source", "item_id").withColumnRenamed("n_chars", "terms")
    clash = i.selectExpr("*", "1 AS rank", "2 AS doc_id", "'x' AS term")
    assert ranked(L.rank_documents(odd, clash, 5)) == brute(rows, items, 5)
