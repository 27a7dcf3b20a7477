import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import ODD_TEXTS, docs, prose
from tokenizers import Tokenizer

from tallow.llm import common
from tallow.llm import packing as P
from tallow.llm import token_files as TF
from tallow.llm import tokens as K


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(K.vocabulary_path())


def ids_of(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, K.END_ID], "<u4")


ODD = [*ODD_TEXTS, "it's I'LL don't.", "ẞtraße ﬁne İstanbul ŉa ǅ Å", "<|endoftext|>x <|startoftext|> <|ENDOFTEXT|>", "Σίσυφος ΟΔΟΣ.",
       "1234 5a6 ...,, a.,b a1. b#.", "ª º µm", "a\xa0b​c\x85d", "a\nb\r\nc\td\x0be\x0cf"]


def test_word_cache_equals_the_tokenizer(tokenizer):
    with open(K.vocabulary_path(), encoding="utf-8") as f:
        fast = K.WordTokenizer(f.read())
    r = random.Random(0)
    texts = [t or "" for t in ODD] + ["".join(r.choice("aAbBéÉßİ.,'’sS \n\t ́Σς123#|<>ﬁ中") for _ in range(r.randint(0, 40))) for _ in range(1500)]
    got = fast.encode_batch(texts)
    for t, g in zip(texts, got, strict=True):
        assert g == ids_of(tokenizer, t)[:-1].tobytes(), t


def rows():
    out = [(i * 7 % 1009, prose(i, 5 + i % 120), "en", ["a", "b", None, "hot", "hot", "hot"][i % 6]) for i in range(500)]
    return out + [(2000 + i, t, None, "odd") for i, t in enumerate(ODD)] + [(3000, prose(1, 5000), "en", "long"), (3, "x y", "en", "b"), (3, "x y", "en", "b")]


def test_token_files_round_trip(spark, tokenizer):
    every = rows()
    got = sorted(map(tuple, TF.token_report(docs(spark, every)).collect()))
    start, want = 0, []
    for d, t, *_ in sorted(every, key=lambda r: (r[0], r[1] or "")):
        x = ids_of(tokenizer, t)
        want.append((d, start, len(x), zlib.crc32(x.tobytes())))
        start += len(x)
    assert got == sorted(want)


def test_token_files_null_ids_and_empty(spark, scratch):
    d = docs(spark, [(None, "a b"), (None, None), (5, "c")])
    got = sorted(TF.token_report(d).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None, None, 5] and got[0]["start"] == 0
    assert TF.token_report(d.limit(0)).count() == 0


def test_file_pair_is_memory_mapped(spark, scratch, tokenizer):
    files = TF.write_token_files(docs(spark, rows()[:40]), scratch).collect()
    f = TF.TokenFile(files[0]["bin"], files[0]["idx"])
    assert isinstance(f.ids, np.memmap) and f.ids.dtype == np.dtype("<u2") and f.offsets[0] == f.base
    texts = {r[0]: r[1] for r in rows()[:40]}
    assert (f.document(0) == ids_of(tokenizer, texts[int(f.doc_ids[0])])).all()


def check_pieces(pieces, every, tokenizer):
    by_doc, by_sequence = {}, {}
    for r in pieces:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    texts = {}
    for d, t, *_ in every:
        texts.setdefault(d, []).append(ids_of(tokenizer, t))
    for d, xs in texts.items():
        assert sum(r["length"] for r in by_doc[d]) == sum(map(len, xs))
        if len(xs) == 1:
            at = 0
            for r in sorted(by_doc[d], key=lambda r: r["start"]):
                assert r["start"] == at and r["doc_tokens"] == len(xs[0])
                assert r["ids_crc32"] == zlib.crc32(xs[0][at:at + r["length"]].tobytes())
                at += r["length"]
    assert set(by_doc) == set(texts)
    for s in by_sequence.values():
        at = 0
        for r in sorted(s, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at == P.CAPACITY or at < P.CAPACITY and at & (at - 1) == 0
    return by_sequence


@pytest.mark.parametrize("range_tokens", [1 << 20, 8000])
def test_packing_covers_every_id_once_and_keeps_proportions(spark, tokenizer, range_tokens):
    every = rows()
    pieces = P.pack_documents(docs(spark, every), range_tokens=range_tokens).collect()
    sequences = check_pieces(pieces, every, tokenizer)
    total, whole = {}, sum(r["length"] for r in pieces)
    for r in pieces:
        total[r["source"]] = total.get(r["source"], 0) + r["length"]
    if range_tokens == 1 << 20:  # one partition: at every window each source is close to its share
        had, all_had = dict.fromkeys(total, 0), 0
        for s in sorted(sequences):
            for r in sequences[s]:
                had[r["source"]] += r["length"]
                all_had += r["length"]
            assert all(abs(had[x] - total[x] / whole * all_had) <= 3 * P.MIN_PIECE for x in total)


def test_schedule_carries_deficits():
    plan = P.schedule([1000, 1000, 48], [1000, 1000, 48], 2048, [0, 0, 0], [256] * 8, min_piece=32)
    assert all(sum(n for _, n in w) == 256 for w in plan)
    assert sum(n for w in plan for s, n in w if s == 2) == 48
    owed = P.schedule([600, 600], [1, 1], 2, [400, -400], [400, 400, 400], min_piece=32)
    first = dict(owed[0])
    assert first.get(0, 0) >= 380 and sum(n for w in owed for s, n in w if s == 1) == 600


def test_sequences_and_window_sizes(spark, tokenizer):
    every = rows()[:60]
    pieces = P.pack_documents(docs(spark, every), with_ids=True)
    whole = P.sequences(pieces).collect()
    assert sum(r["n_tokens"] for r in whole) == sum(len(ids_of(tokenizer, r[1])) for r in every)
    assert all(len(r["ids"]) == 2 * r["n_tokens"] for r in whole)
    assert P.window_sizes(2048 * 2 + 13) == [2048, 2048, 8, 4, 1] and P.window_sizes(0) == []


def test_packing_odd_rows_and_empty(spark, tokenizer):
    d = docs(spark, [(None, "a"), (None, None), (1, None)]).withColumnRenamed("lang", "ids")
    assert sum(r["length"] for r in P.pack_documents(d).collect()) == 4
    assert P.pack_documents(d.limit(0)).count() == 0


def test_chunks_keep_rows_and_bound_bytes():
    texts = [prose(i, 1 + i % 90) for i in range(400)] + ["", "x" * 9000, ""]
    rows = pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], ["i", "t"])
    got = list(K.chunks([rows.slice(0, 150), rows.slice(150, 0), rows.slice(150)], 4000))
    assert pa.Table.from_batches(got).to_pydict() == rows.to_pydict()
    sizes = [sum(map(len, b.column(1).to_pylist())) for b in got]
    assert all(s >= 4000 for s in sizes[:-1]) and sorted(sizes)[-2] < 8000 + max(map(len, texts[:400]))
    assert list(K.chunks([], 10)) == []


def test_texts_of_many_chunks_and_marks_equal_the_tokenizer(spark, tokenizer, monkeypatch):
    marks = [*"!#$&(*+-/:;<=>?@[]^_`{|}~%,.", "!!", ".,", "'s", "-'", "'", "...", "%%%", "<|", "|>"]
    texts = [f"{w}{m} {m}{w} {m} {w}{m}{w}" for w in ("Straße", "émeu", "xyz", "ĮO", "İx", "") for m in marks]
    monkeypatch.setattr(K, "CHUNK_BYTES", 300)
    monkeypatch.setattr(K, "OUT_ROWS", 2)
    src, task, _ = K.token_task(docs(spark, list(enumerate(texts))), ["doc_id"])
    rows = pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], src.columns)
    got = pa.Table.from_batches(task([rows.slice(0, 70), rows.slice(70)]))
    assert got["doc_id"].to_pylist() == list(range(len(texts)))
    for t, n, x in zip(texts, got["n_tokens"].to_pylist(), got["ids"].to_pylist(), strict=True):
        want = ids_of(tokenizer, t)
        assert n == len(want) and x == want.astype("<u2").tobytes(), t


def test_token_files_take_one_python_step(spark, scratch, monkeypatch):
    plans, kept = {}, TF.materialize
    monkeypatch.setattr(TF, "materialize", lambda df, name: (plans.update({name: df._jdf.queryExecution().toString()}), kept(df, name))[1])
    TF.write_token_files(docs(spark, rows()[:20]), scratch)
    assert plans["token_manifest"].split("Physical Plan")[1].count("MapInArrow") == 1


def test_sums_of_runs():
    r = random.Random(5)
    size = np.array([r.randrange(5) for _ in range(50)])
    runs = np.array([r.randrange(50) for _ in range(3000)])
    ends = np.array([0, 0, *sorted(r.randrange(3001) for _ in range(40)), 3000, 3000])
    old, K.RUNS = K.RUNS, 64
    try:
        got = K._sums(size, runs, ends)
    finally:
        K.RUNS = old
    assert got.tolist() == [size[runs[a:b]].sum() for a, b in zip(ends[:-1], ends[1:])]
    assert K._sums(size, runs[:0], np.array([0, 0])).tolist() == [0]


def test_workers_give_memory_back(spark, monkeypatch):
    freed = []
    monkeypatch.setattr(K, "release_memory", lambda: freed.append(1))
    monkeypatch.setattr(K, "CHUNK_BYTES", 200)
    _, run, _ = K.token_task(docs(spark, [(1, "a")]), ["doc_id"])
    batch = pa.RecordBatch.from_arrays([pa.array(range(9)), pa.array([prose(i, 30) for i in range(9)])], names=["doc_id", "t"])
    assert sum(b.num_rows for b in run(iter([batch]))) == 9 and len(freed) > 2
    resident = lambda: int(next(x for x in open("/proc/self/status") if x.startswith("RssAnon")).split()[1])
    # Objects are freed but for a few, so that little of the heap's top can go without help.
    kept = [x for i, x in enumerate([bytes(600 + i % 7) for i in range(200_000)]) if i % 997 == 0]
    before = resident()
    common.release_memory()
    assert kept and before - resident() > 60_000
