import hashlib
import random
import re
import zlib
from functools import cache

import pytest
from pyspark.sql import functions as F

from tallow.llm import conversation_repair as C

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
WHITE = " \t\n\x0b\x0c\r"
MOVES = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}


def cheapest(rows):
    """Least (cost, audit) with its lines, by recursion over rows, states and inserted turns."""
    @cache
    def go(i, state, inserted):
        found = []
        if i == len(rows) and state in ("", "a"):
            found.append((0, "", ()))
        if inserted < 2:
            for x, name in (("u", "user"), ("a", "assistant")):
                if (state, x) in MOVES:
                    c, a, lines = go(i, x, inserted + 1)
                    found.append((c + 5, "I" + a, (f"{name}:", *lines)))
        if i < len(rows):
            role, text, must_go, cut = rows[i]
            c, a, lines = go(i + 1, state, 0)
            found.append((c + 2, "D" + a, lines))
            if not must_go:
                extra = 5 if cut else 0
                if (state, role[:1]) in MOVES and role:
                    c, a, lines = go(i + 1, role[:1], 0)
                    found.append((c + extra, "K" + a, (f"{role}:{text}", *lines)))
                for x, name in (("u", "user"), ("a", "assistant")):
                    if (state, x) in MOVES:
                        c, a, lines = go(i + 1, x, 0)
                        found.append((c + extra + 1, "R" + a, (f"{name}:{text}", *lines)))
        return min(found, key=lambda f: f[:2]) if found else (10 ** 9, "", ())
    return go(0, "", 0)


def brute(rows):
    """Expected reports of ``(conv_id, turn, role, text, live)`` rows in order of their turns."""
    out = {}
    for conv in {r[0] for r in rows}:
        live = [r for r in rows if r[0] == conv and r[4]]
        seen, steps, n = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, _, role, text, _ in live:
            bare = text.strip(WHITE)
            fault = ("blank" if not bare else "duplicate" if (role, text) in seen else
                     "truncated" if bare[-1] not in ".!?" else None)
            seen.add((role, text))
            if fault:
                n[fault] += 1
            steps.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        turns = [r[1] for r in live if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [r[2][:1] for r in live]
        illegal = sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:], strict=False))
        cost, audit, lines = cheapest(tuple(steps))
        out[conv] = (gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def in_order(df):
    """Live and dropped rows as the operator orders them, read back for the brute force."""
    rows = df.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
                     "live").withColumn("h", F.xxhash64("role", "text")).collect()
    rows.sort(key=lambda r: (r["turn"] is not None, r["turn"] or 0, r["h"]))
    return [tuple(r)[:5] for r in rows]


def reports(df):
    rows = df.collect()
    found = {r["conv_id"]: (r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"], r["audit"], r["repaired_sha256"])
             for r in rows}
    assert len(found) == len(rows)
    return found


def conversations(seed, n, longest=9):
    r = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "well", "", " \t", "Go on.", "so... \n", "中文。", "x" * 3000 + "."]
    out = []
    for c in range(n):
        turn = r.randint(-2, 3)
        for _ in range(r.randint(1, longest)):
            out.append((c, turn, r.choice(["user", "assistant", "user", "assistant", "system", "tool", "User", ""]), r.choice(texts)))
            turn += r.choice([0, 1, 1, 1, 2])
    return out


ODD = [(None, 1, "user", "Hi."), (None, None, None, None), (None, None, "assistant", "Yes."), (700, None, "user", None),
       (701, None, "user", "A."), (701, None, "user", "A."), (701, 2 ** 62, "assistant", "B."), (702, 1, "system", "S.")]


@pytest.fixture(scope="module")
def table(spark):
    alternating = [(900, i, ("user", "assistant")[i % 2], f"Line {i}.") for i in range(60)]
    shifted = [(901, i, ("assistant", "user")[i % 2], f"Line {i}" + ("." if i % 7 else "")) for i in range(61)]
    rows = conversations(1, 60) + conversations(2, 3, 40)[:60] + alternating + shifted + ODD
    df = spark.createDataFrame(rows, SCHEMA).withColumn("live", F.crc32(F.concat_ws(":", "conv_id", "turn", "role")) % 9 != 0)
    return df.repartition(3)


@pytest.mark.parametrize("piece", [1, 4, 1024])
def test_equals_brute_force(spark, table, piece, monkeypatch):
    monkeypatch.setattr(C, "PIECE", piece)  # 1: every row is a piece of its own
    expected = brute(in_order(table))
    got = reports(C.repair_report(table, F.col("live")))
    assert got == expected


def test_repaired_turns_are_what_the_digest_is_of(spark, table, monkeypatch):
    monkeypatch.setattr(C, "PIECE", 5)
    turns = C.repaired_turns(table, F.col("live")).orderBy("pos", "k").collect()
    lines = {}
    for t in turns:
        lines.setdefault(t["conv_id"], []).append(t)
        assert (t["turn"] is None or t["edit"] != "I") and t["edit"] in "KRI"
    for conv, report in reports(C.repair_report(table, F.col("live"))).items():
        mine = lines.get(conv, [])
        assert hashlib.sha256("\n".join(f"{t['role']}:{t['text']}" for t in mine).encode()).hexdigest() == report[-1]
        assert re.fullmatch("(s?(ua)+)?", "".join(t["role"][:1] for t in mine))


def test_vectors_soon_differ_by_constants_only():
    r = random.Random(5)
    alike = 0
    for _ in range(100):
        rows = [(r.choice("sua"), r.random() < 0.2, r.random() < 0.2) for _ in range(60)]
        shapes = set()
        for end in [(0, 0, 0, 0), (0, 10, 5, 0), (9, 0, 3, 7)]:
            v = C.sweep(rows, end)[0]
            shapes.add(tuple(x - min(v) for x in v))
        alike += len(shapes) == 1
    assert alike >= 95


def test_damage(spark):
    rows = conversations(3, 120)
    expected = []
    for c, t, role, text in rows:
        harm = zlib.crc32(f"{c}:{t}".encode()) % 20
        text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
        expected += [(c, t, "user" if harm == 4 else role, text, harm != 0)] * (2 if harm == 3 else 1)
    df = spark.createDataFrame(rows, SCHEMA)
    found = C.damaged(df)
    assert sorted(tuple(r)[:5] for r in found.collect()) == sorted(expected)
    assert reports(C.damage_report(df)) == brute(in_order(found))


def test_empty_table_all_dropped_and_clashing_columns(spark, table):
    assert C.repair_report(table.limit(0)).count() == 0 and C.repaired_turns(table.limit(0)).count() == 0
    none = reports(C.repair_report(table, F.lit(False)))
    assert set(none.values()) == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())} and len(none) == len(brute(in_order(table)))
    odd = table.selectExpr("*", "1 AS kind", "2 AS piece", "'x' AS blank", "3 AS pos", "4 AS salt")
    assert reports(C.repair_report(odd, F.col("live"))) == brute(in_order(table))
