"""WARC archives of pages and the external merge of their capture index.

1. *Archive.* Spark finds, by payload digest, the page each payload is first
   seen in (the least page id); the others become revisit records. Tasks write
   gzip members, one per record, to archive files of about ARCHIVE_BYTES.
2. *Index.* Each archive is read back record by record; every RUN_CAPTURES
   captures are sorted by URL key, time and page id and written as a run: lines
   in compressed blocks of BLOCK_CAPTURES. A row per block (first and last key,
   place in its file) is the sparse index.
3. *Merge.* Passes merge groups of up to FAN_IN runs. Spark sorts the block
   keys of a group into ranges of a bounded number of captures; one task per
   group and range merges its k run segments with a loser tree, reading a block
   at a time. Each pass writes longer runs; the last returns the captures in
   global order, ``(range_no, position)``.

File names are unique per task attempt and every pass commits its rows as a
table first, so files that lost attempts left are never read.

Defined cases: null html is an empty payload, a null URL has the empty URL key
and sorts first; null page ids never are responses for others and sort last.
Rows that repeat a page id with the same payload are all responses. An empty
table gives no archives and an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import json
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallow.llm.common import bounded_batches, drop_table, filesystem, materialize, new_file, qualified, shared_folder
from tallow.sources.tables import delete_path

ARCHIVE_BYTES = 256 << 20
RUN_CAPTURES, BLOCK_CAPTURES = 1 << 16, 512
FAN_IN, RANGE_CAPTURES = 64, 1 << 16
MIN_REVISIT_BYTES = 0
GZIP_LEVEL = 1
CRLF = "\r\n"
# Captures without a time: 2025-01-01T00:00:00Z plus the page id in seconds, of which
# what exceeds ten years is left out, so that ids of 64 bits have a time, too.
EPOCH, SPAN = 1_735_689_600, 315_360_000


def url_key(url: str | None) -> str:
    """Sort-friendly form: reversed host, then port, path and query, lower case."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return url.lower()
    labels = host.lower().split(".")
    if len(labels) > 2 and labels[0] == "www":
        labels = labels[1:]
    key = ",".join(reversed(labels)) + (f":{port}" if port else "") + ")" + (parts.path or "/").lower()
    return key + ("?" + "&".join(sorted(parts.query.lower().split("&"))) if parts.query else "")


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def page_of(urn: str | None) -> int | None:
    n = urn[len("<urn:page:"):-1] if urn else "null"
    return None if n == "null" else int(n)


def iso(seconds: int) -> str:
    import datetime as dt
    return dt.datetime.fromtimestamp(seconds, dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def warc_record(page_id: int | None, url: str | None, seconds: int, payload: bytes, refers_to: int | None) -> bytes:
    """One gzip member: a response, or a revisit (HTTP headers only) if ``refers_to`` is given."""
    http = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: {len(payload)}{CRLF}{CRLF}".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {iso(seconds)}"]
    if url is not None:
        # A line break would end the header; percent-encoded it is the same URL.
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head.append(f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: {record_id(refers_to)}",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    z = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
    return z.compress((CRLF.join(head) + CRLF * 2).encode() + block + (CRLF * 2).encode()) + z.flush()


def members(f, chunk: int = 1 << 20) -> Iterator[tuple[int, int, bytes]]:
    """``(offset, length, content)`` of the gzip members of an open file, in order."""
    offset, buffer = 0, b""
    while True:
        z, parts, used = zlib.decompressobj(31), [], 0
        while not z.eof:
            if not buffer:
                buffer = f.read(chunk)
                if not buffer:
                    if used:
                        raise ValueError("the archive ends within a record")
                    return
            parts.append(z.decompress(buffer))
            used += len(buffer) - len(z.unused_data)
            buffer = z.unused_data
        yield offset, used, b"".join(parts)
        offset += used


def parse_record(raw: bytes) -> dict:
    """Headers and, from the HTTP part, the payload's length and digest.

    A response's payload is digested anew and must match its header.
    """
    head, _, rest = raw.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split(CRLF)[1:])
    block = rest[:int(headers["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n":
        raise ValueError(f"record {headers['WARC-Record-ID']} has a wrong length")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(dict(x.split(": ", 1) for x in http.decode().split(CRLF)[1:])["Content-Length"])
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    if headers["WARC-Type"] == "response" and (len(payload) != length or sha1_base32(payload) != digest):
        raise ValueError(f"record {headers['WARC-Record-ID']} is damaged")
    return {"page_id": page_of(headers["WARC-Record-ID"]), "url": headers.get("WARC-Target-URI"), "time": headers["WARC-Date"],
            "type": headers["WARC-Type"], "digest": digest, "bytes": length, "refers_to": page_of(headers.get("WARC-Refers-To"))}


# -- 1. archive ---------------------------------------------------------------

def write_archives(pages: DataFrame, folder: str, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write a record per row of ``pages``; returns ``path``, one row per archive."""
    bounded_batches(pages.sparkSession)
    raw = pages.select(F.col("page_id").cast("long"), "url", F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"))
    raw = raw.withColumn("digest", F.sha1("payload"))
    # Payloads seen more than once, by digest; written, so that a join can split a hot one.
    seen = raw.where(F.length("payload") >= min_bytes).groupBy("digest").agg(
        F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1")
    seen = materialize(seen.drop("n"), "payloads")
    placed = raw.join(seen, "digest", "left").select(
        "page_id", "url", "payload",
        F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("first_id")), F.col("first_id")).alias("refers_to"))
    folder = qualified(pages.sparkSession, folder)
    fs, p = filesystem(folder)
    fs.create_dir(p, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, sink, size = [], None, 0
        try:
            for b in batches:
                for row in b.to_pylist():
                    if sink is None or size >= ARCHIVE_BYTES:
                        if sink:
                            sink.close()
                        names.append(new_file(folder, "captures", ".warc.gz"))
                        sink, size = filesystem(folder)[0].open_output_stream(filesystem(names[-1])[1], compression=None), 0
                    record = warc_record(row["page_id"], row["url"], EPOCH + (row["page_id"] or 0) % SPAN, row["payload"], row["refers_to"])
                    sink.write(record)
                    size += len(record)
        finally:
            if sink:
                sink.close()
        if names:
            yield pa.RecordBatch.from_arrays([pa.array(names)], names=["path"])

    out = materialize(placed.mapInArrow(write, "path string"), "archives")
    drop_table(seen)
    return out


# -- 2. index -----------------------------------------------------------------

BLOCKS = pa.schema([("run", pa.string()), ("path", pa.string()), ("start", pa.int64()), ("length", pa.int64()),
                    ("captures", pa.int64()), ("first_key", pa.string()), ("last_key", pa.string())])
BLOCKS_DDL = "run string, path string, start bigint, length bigint, captures bigint, first_key string, last_key string"
Capture = tuple[str, str]  # the sort key and the line it belongs to


def capture(found: dict, archive: str, offset: int, length: int) -> Capture:
    """The sort key orders by URL key, time, page id (none last) and place."""
    page = "~" if found["page_id"] is None else f"{found['page_id'] + (1 << 63):020d}"
    key = "\t".join([url_key(found["url"]).replace("\t", "%09"), found["time"], page, archive.rsplit("/", 1)[-1], f"{offset:015d}"])
    return key, json.dumps(found | {"file": archive, "offset": offset, "length": length})


class RunWriter:
    """Writes captures in key order as compressed blocks; ``rows`` describe the blocks."""

    def __init__(self, folder: str, run: str | None = None):
        self.path = new_file(folder, "run", ".cdx")
        self.run, self.rows, self.block, self.at = run or self.path, [], [], 0
        self.sink = filesystem(folder)[0].open_output_stream(filesystem(self.path)[1])

    def add(self, item: Capture) -> None:
        self.block.append(item)
        if len(self.block) == BLOCK_CAPTURES:
            self.flush()

    def flush(self) -> None:
        if self.block:
            raw = zlib.compress(json.dumps(self.block).encode(), 1)
            self.sink.write(raw)
            self.rows.append((self.run, self.path, self.at, len(raw), len(self.block), self.block[0][0], self.block[-1][0]))
            self.at, self.block = self.at + len(raw), []

    def close(self) -> list[tuple]:
        self.flush()
        self.sink.close()
        return self.rows


def _block_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), BLOCKS, strict=True)], schema=BLOCKS)


def index_archives(archives: DataFrame, folder: str, run_captures: int = RUN_CAPTURES) -> DataFrame:
    """Read every archive and write its captures as sorted runs; returns their blocks."""
    folder = qualified(archives.sparkSession, folder)
    fs, p = filesystem(folder)
    fs.create_dir(p, recursive=True)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Capture] = []

        def run() -> pa.RecordBatch:
            held.sort()
            writer = RunWriter(folder)
            for item in held:
                writer.add(item)
            held.clear()
            return _block_batch(writer.close())

        for b in batches:
            for archive in b.column(0).to_pylist():
                fs, path = filesystem(archive)
                with fs.open_input_stream(path, compression=None) as f:
                    for offset, length, raw in members(f):
                        held.append(capture(parse_record(raw), archive, offset, length))
                        if len(held) >= run_captures:
                            yield run()
        if held:
            yield run()

    return materialize(archives.repartition(max(1, archives.count())).mapInArrow(index, BLOCKS_DDL), "runs")


# -- 3. merge -----------------------------------------------------------------

def loser_tree(runs: list[Iterator[Capture]]) -> Iterator[Capture]:
    """Merge sorted iterators: each inner node keeps the loser of its match, and a
    new head replays only the matches on its way to the root."""
    k = len(runs)
    done = None
    head: list[Capture | None] = [next(r, done) for r in runs]
    tree = [-1] * max(1, k)  # inner nodes 1..k-1 hold losers, node 0 the winner

    def less(a: int, b: int) -> bool:
        if head[a] is done or head[b] is done:
            return head[a] is not done
        return (head[a][0], a) < (head[b][0], b)

    def play(node: int) -> int:
        if node >= k:
            return node - k
        left, right = play(2 * node), play(2 * node + 1)
        winner, loser = (left, right) if less(left, right) else (right, left)
        tree[node] = loser
        return winner

    if not k:
        return
    winner = play(1) if k > 1 else 0
    while head[winner] is not done:
        yield head[winner]
        head[winner] = next(runs[winner], done)
        node = (winner + k) // 2
        while node:
            if less(tree[node], winner):
                tree[node], winner = winner, tree[node]
            node //= 2


def segment(blocks: list[dict], low: str | None, high: str | None) -> Iterator[Capture]:
    """The captures of one run's blocks with ``low <= key < high``, a block at a time."""
    for b in sorted(blocks, key=lambda b: b["first_key"]):
        fs, path = filesystem(b["path"])
        with fs.open_input_file(path) as f:
            raw = f.read_at(b["length"], b["start"])
        for key, line in json.loads(zlib.decompress(raw)):
            if (low is None or key >= low) and (high is None or key < high):
                yield key, line


def _ranged(blocks: DataFrame, ranges: int) -> DataFrame:
    """Blocks with the ranges of their group that they reach into, and the ranges' bounds."""
    ends = blocks.select("grp", "path", "start", F.explode(F.array("first_key", "last_key")).alias("key"))
    # Range numbers are Spark's own; written at once, they stay what they are.
    ends = materialize(ends.repartitionByRange(ranges, "grp", "key").withColumn("range_no", F.spark_partition_id()), "range_ends")
    reach = ends.groupBy("path", "start").agg(F.min("range_no").alias("lo"), F.max("range_no").alias("hi"))
    bounds = ends.groupBy("grp", "range_no").agg(F.min("key").alias("low"))
    after = Window.partitionBy("grp").orderBy("range_no")
    bounds = bounds.withColumn("high", F.lead("low").over(after)).withColumn(
        "low", F.when(F.lag("low").over(after).isNotNull(), F.col("low")))
    spread = blocks.join(reach, ["path", "start"]).withColumn("range_no", F.explode(F.sequence("lo", "hi"))).drop("lo", "hi")
    return spread.join(bounds, ["grp", "range_no"])


def _merger(emit: Callable) -> Callable:
    def merge(key: tuple, blocks: pa.Table) -> pa.Table:
        by_run: dict[str, list[dict]] = {}
        for b in blocks.to_pylist():
            by_run.setdefault(b["run"], []).append(b)
        some = blocks.slice(0, 1).to_pylist()[0]
        runs = [segment(by_run[r], some["low"], some["high"]) for r in sorted(by_run)]
        return emit(key[0].as_py(), key[1].as_py(), loser_tree(runs))
    return merge


CAPTURES = pa.schema([("range_no", pa.int64()), ("position", pa.int64()), ("url_key", pa.string()), ("time", pa.string()),
                      ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                      ("record_type", pa.string()), ("refers_to", pa.int64()), ("file", pa.string()), ("offset", pa.int64()),
                      ("length", pa.int64())])
CAPTURES_DDL = ("range_no bigint, position bigint, url_key string, time string, page_id bigint, url string, payload_bytes bigint, "
                "payload_digest string, record_type string, refers_to bigint, file string, offset bigint, length bigint")


def _captures(group: int, range_no: int, merged: Iterator[Capture]) -> pa.Table:
    rows = []
    for i, (key, line) in enumerate(merged):
        c = json.loads(line)
        rows.append((range_no, i, key.split("\t", 1)[0], c["time"], c["page_id"], c["url"], c["bytes"], c["digest"], c["type"],
                     c["refers_to"], c["file"], c["offset"], c["length"]))
    cols = zip(*rows, strict=True) if rows else [()] * len(CAPTURES)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(cols, CAPTURES, strict=True)], schema=CAPTURES)


def merge_runs(blocks: DataFrame, folder: str, fan_in: int = FAN_IN, range_captures: int = RANGE_CAPTURES) -> DataFrame:
    """All captures of the runs in global order, by ``range_no`` and ``position``."""
    folder = qualified(blocks.sparkSession, folder)

    def longer_run(group: int, range_no: int, merged: Iterator[Capture]) -> pa.Table:
        writer = RunWriter(folder, f"group-{group:012d}")
        for item in merged:
            writer.add(item)
        rows = writer.close()
        return pa.Table.from_batches([_block_batch(rows)]) if rows else BLOCKS.empty_table()

    while True:
        runs, captures = blocks.agg(F.countDistinct("run"), F.coalesce(F.sum("captures"), F.lit(0))).first()
        ranges = max(1, -(-captures // range_captures))
        # Groups of at most fan_in runs: runs numbered in the order of their names.
        numbers = blocks.select("run").distinct()
        numbers = numbers.withColumn("grp", F.floor((F.row_number().over(Window.orderBy("run")) - 1) / fan_in))
        grouped = _ranged(blocks.join(numbers, "run"), ranges).groupBy("grp", "range_no")
        if runs <= fan_in:
            return grouped.applyInArrow(_merger(_captures), CAPTURES_DDL)
        blocks = materialize(grouped.applyInArrow(_merger(longer_run), BLOCKS_DDL), "runs")


def capture_histories(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Archive ``pages`` in ``folder`` (one in the shared store), index the archives,
    and return every capture in global order of URL key and time."""
    folder = folder or shared_folder(pages.sparkSession, "llm", "warc")
    blocks = index_archives(write_archives(pages, folder), folder)
    return merge_runs(blocks, folder)


def page_report(pages: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` and place of every page.

    The archives and runs are removed once the report is written; use
    :func:`capture_histories` with a folder of one's own to keep them.
    """
    folder = shared_folder(pages.sparkSession, "llm", "warc")
    report = capture_histories(pages, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
                                                     "url_key", "time", "range_no", "position")
    report = materialize(report, "page_report")
    delete_path(pages.sparkSession, folder)
    return report
