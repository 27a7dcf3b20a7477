import base64
import hashlib
import io
import random

import pytest
from pyspark.sql import types as T

from tallow.llm import warc as W

PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType())])


def pages(spark, rows):
    return spark.createDataFrame(rows, PAGES).repartition(4)


def rows_of(n=300):
    r = random.Random(4)
    out = [(i, f"http://www.Host{r.randint(0, 9)}.example.com/p{r.randint(0, 40)}?b=2&a={r.randint(0, 3)}", f"<p>{'copy' if i % 3 == 0 else i}</p>" * (i % 7))
           for i in range(n)]
    return out + [(1000, None, None), (1001, "", ""), (1002, "::::", "x" * 70000), (None, "http://a.example/", "only"), (1003, "http://a.example/\nb", "é中"),
                  (None, "http://a.example/", "<p>copy</p>" * 3), (5, rows_dup(out)[1], rows_dup(out)[2])]


def rows_dup(out):
    return out[5]


def brute(rows):
    first = {}
    for p, _, h in rows:
        b = (h or "").encode()
        if p is not None:
            first[b] = min(p, first.get(b, p))
    out = []
    for p, _, h in rows:
        b = (h or "").encode()
        to = first.get(b) if first.get(b) != p else None
        digest = base64.b32encode(hashlib.sha1(b).digest()).decode()
        out.append((str(p), len(b), digest, "response" if to is None else "revisit", to))
    return sorted(out, key=str)


def test_round_trip(spark):
    rows = rows_of()
    got = [(str(r["page_id"]), *r[1:5]) for r in W.page_report(pages(spark, rows)).collect()]
    assert sorted(got, key=str) == brute(rows)


@pytest.mark.parametrize("fan_in", [2, 3, 64])
def test_merge_in_passes_gives_one_global_order(spark, scratch, fan_in, monkeypatch):
    monkeypatch.setattr(W, "BLOCK_CAPTURES", 4)
    monkeypatch.setattr(W, "ARCHIVE_BYTES", 3000)
    rows = rows_of()
    blocks = W.index_archives(W.write_archives(pages(spark, rows), scratch), scratch, run_captures=16)
    assert blocks.select("run").distinct().count() > 9
    got = W.merge_runs(blocks, scratch, fan_in=fan_in, range_captures=40).orderBy("range_no", "position").collect()
    keys = [(r["url_key"], r["time"], float("inf") if r["page_id"] is None else r["page_id"]) for r in got]
    assert len(got) == len(rows) and keys == sorted(keys)
    assert len({r["range_no"] for r in got}) > 1
    assert sorted(str(r["page_id"]) for r in got) == sorted(str(r[0]) for r in rows)


def test_loser_tree_merges_any_number_of_runs():
    r = random.Random(0)
    for k in range(0, 14):
        runs = [sorted((f"{r.randint(0, 50):03d}", str(i)) for _ in range(r.randint(0, 20))) for i in range(k)]
        got = list(W.loser_tree([iter(x) for x in runs]))
        assert [g[0] for g in got] == sorted(x[0] for run in runs for x in run)


def test_records_are_plain_gzip_members():
    import gzip
    a, b = W.warc_record(1, "http://x/", 0, b"<p>", None), W.warc_record(2, None, 1, b"<p>", 1)
    raw = gzip.decompress(a + b)
    assert raw.count(b"WARC/1.1") == 2 and b"WARC-Refers-To: <urn:page:1>" in raw
    found = [W.parse_record(m) for _, _, m in W.members(io.BytesIO(a + b), chunk=7)]
    assert [f["type"] for f in found] == ["response", "revisit"] and found[1]["bytes"] == 3 and found[1]["url"] is None
    with pytest.raises(ValueError):
        list(W.members(io.BytesIO(a + b[:-5])))


def test_url_keys():
    assert W.url_key("http://WWW.Example.COM:8080/A?b=1&a=2") == "com,example:8080)/a?a=2&b=1"
    assert W.url_key(None) == W.url_key("") == "" and W.url_key("http://[bad") == "http://[bad"


def test_empty_table(spark):
    assert W.page_report(pages(spark, rows_of()).limit(0)).count() == 0


def test_ids_of_64_bits(spark):
    ids = [0, -1, 10 ** 12, 2 ** 60, 2 ** 63 - 1, -2 ** 63]
    pages = spark.createDataFrame([(i, "http://a.org/", f"<p>{i % 3}") for i in ids], "page_id bigint, url string, html string")
    got = {r["page_id"]: r for r in W.page_report(pages).collect()}
    assert set(got) == set(ids)
    assert all(r["time"].startswith("20") for r in got.values())
    assert all((r["record_type"] == "response") == (i == min(j for j in ids if j % 3 == i % 3)) for i, r in got.items())
