import hashlib
import re

import pytest
from helpers import ODD_TEXTS, docs, prose

from tallow.llm import spotsigs as S


def brute_signatures(text):
    """Each anchor before a content word, with the CHAIN content words after it."""
    words = re.sub(r"[^\w|]+|_", " ", (text or "").lower()).split()
    if not words:
        return frozenset()
    anchors = {*S.ANCHORS, S.START}
    words = [S.START, *words]
    words = [w for i, w in enumerate(words) if not (w in anchors and i + 1 < len(words) and words[i + 1] in anchors)]
    pieces, run = [], 0
    for w in words:
        run = 0 if w in anchors else run + 1
        if w in anchors or not pieces:
            pieces.append([])
        elif run > S.RUN:
            pieces.append([S.START])
            run = 1
        pieces[-1].append(w)
    out = set()
    for i, p in enumerate(pieces):
        following = pieces[i + 1][1:] if i + 1 < len(pieces) else []
        out.add(" ".join([*p, *following][:S.CHAIN + 1]))
    return frozenset(out)


def likeness(a, b):
    return 1.0 if not a | b else len(a & b) / len(a | b)


@pytest.fixture(scope="module")
def rows():
    text = "The cat sat on the mat of a house and the dog | saw it in der Garten. "
    out = [(i * 3, text * (1 + i % 3) + prose(i, 20) + " the end of the " + prose(i + 1, 9)) for i in range(60)]
    out += [(1000 + i, t) for i, t in enumerate(ODD_TEXTS)] + [(7, "the"), (8, "of the and"), (13, "The, cat"), (10, "cat the"), (11, out[0][1])]
    out += [(2000 + i, f"{out[i][1]} the last words") for i in range(5)]
    return out


def test_report_equals_brute_force(spark, rows):
    got = {r["doc_id"]: r for r in S.fingerprint_report(docs(spark, rows)).collect()}
    ordered = sorted(rows)
    assert len(got) == len(rows)
    prints = {}
    for i, (d, t) in enumerate(ordered):
        t, following = t or "", ordered[(i + 1) % len(ordered)][1] or ""
        cut = len(t) // 4
        edited = t[:len(t) - cut] + following[:cut]
        r, mine = got[d], brute_signatures(t)
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["near_edited"] == pytest.approx(likeness(mine, brute_signatures(edited)))
        assert r["near_next"] == pytest.approx(likeness(mine, brute_signatures(following)))
        assert prints.setdefault(r["fingerprint"], mine) == mine
        assert (r["fingerprint"] == r["edited_fingerprint"]) == (mine == brute_signatures(edited))
    assert len(prints) == len({brute_signatures(t) for _, t in rows})


def test_similar_documents_equal_brute_force(spark, rows):
    pairs, member = S.similar_documents(docs(spark, rows), 0.6)
    sets = {d: brute_signatures(t) for d, t in rows}
    reps = {}
    for d in sorted(sets):
        if sets[d]:
            reps.setdefault(sets[d], d)
    ids = sorted(reps.values())
    want = {frozenset((a, b)) for a in ids for b in ids if a < b and likeness(sets[a], sets[b]) >= 0.6}
    assert {frozenset((r["a"], r["b"])) for r in pairs.collect()} == want and want
    assert dict(map(tuple, member.collect())) == {d: reps.get(sets[d], d) for d in sets}


def test_every_part_of_texts_without_anchors_counts(spark):
    """Cyrillic, Chinese and code: texts that differ anywhere but in their first words differ."""
    def words(stem, n, start):
        return [f"{stem}{i * 7919 % 5003}" for i in range(start, start + n)]
    rows = []
    for stem in ("слово", "文本", "var_"):
        head = words(stem, 2, 0)
        rows += [(len(rows), " ".join(head + words(stem, 298, 500))), (len(rows) + 1, " ".join(head + words(stem, 298, 2000)))]
    got = {r["doc_id"]: r for r in S.fingerprint_report(docs(spark, rows)).collect()}
    assert len({r["fingerprint"] for r in got.values()}) == len(rows)
    assert all(got[i]["near_next"] < 0.1 for i in (0, 2, 4))
    assert all(0.4 < r["near_edited"] < 0.9 for r in got.values())


def test_very_long_text_and_ties(spark):
    long = "word number of the list " * 40_000
    rows = [(1, long), (1, long), (1, long + "end"), (2, None)]
    got = S.fingerprint_report(docs(spark, rows)).collect()
    assert len(got) == 4 and len({r["fingerprint"] for r in got}) == 3
    assert sum(r["n_chars"] == len(long) for r in got) == 2


def test_one_document_repeats_nulls_and_empty(spark):
    one = S.fingerprint_report(docs(spark, [(1, "the cat sat here")])).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    odd = S.fingerprint_report(docs(spark, [(None, "a b"), (3, "x y"), (3, "x y"), (3, None)]).withColumnRenamed("lang", "sigs")).collect()
    assert len(odd) == 4
    assert S.fingerprint_report(docs(spark, [(1, "x")]).limit(0)).count() == 0


def test_trie_pattern():
    words = ["a", "an", "and", "the", "|"]
    pattern = re.compile(S.trie_pattern(words))
    assert all(pattern.fullmatch(w) for w in words) and not any(pattern.fullmatch(w) for w in ("th", "ands", "", "b"))


def test_native(spark, rows):
    plan = S.fingerprint_report(docs(spark, rows))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
