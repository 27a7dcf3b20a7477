"""Token ids as flat binary files with 64-bit document offsets, memory-mapped.

A data set is a folder of file pairs, one per range of document ids:

* ``.bin``: the token ids of the range's documents, end to end, as
  little-endian unsigned integers of 2 or 4 bytes;
* ``.idx``: the header ``TOKIDX1`` and a zero byte, then four unsigned 64-bit
  integers (bytes per id, documents, documents with a null id, ids before this
  file in the data set), the document ids (signed 64-bit) and one more offset
  than documents (unsigned 64-bit, from the data set's first id).

Spark sorts documents into ranges by id; each task writes its ``.bin`` and the
documents' lengths. The bases are prefix sums over one row per file; a second
pass over the files writes the offsets. Names are unique per task attempt, and
only files named in the committed manifest are ever read.

Null texts have only their end id. Null ids come first; repeated rows are
documents of their own, in the order of their texts. An empty table gives no
files.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallow.llm.common import filesystem, materialize, new_file, qualified, shared_folder
from tallow.llm.tokens import crc_of, id_width, token_task

MAGIC = b"TOKIDX1\0"
READ_BATCH = 4096
MANIFEST = "part int, bin string, lengths string, docs bigint, nulls bigint, tokens bigint"


def write_token_files(docs: DataFrame, folder: str, path: str | None = None) -> DataFrame:
    """Write ``docs (doc_id, text)`` to ``folder``; returns the manifest, one row per file."""
    width = id_width(path)
    ranged = (docs.select(F.col("doc_id").cast("long"), "text")
              .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text"))
    folder = qualified(docs.sparkSession, folder)
    filesystem(folder)[0].create_dir(filesystem(folder)[1], recursive=True)

    texts, encode, _ = token_task(ranged, ["doc_id"], path)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = new_file(folder, "tokens", ".bin")
        fs, p = filesystem(name)
        ids, lengths, nulls, sink = [], [], 0, None
        try:
            for b in encode(batches):
                sink = sink or fs.open_output_stream(p)
                nulls += b.column(0).null_count
                ids.append(b.column(0).fill_null(0).to_numpy(zero_copy_only=False))
                lengths.append(b.column(1).to_numpy(zero_copy_only=False))
                for x in b.column(2):
                    sink.write(x.as_buffer())
        finally:
            if sink:
                sink.close()
        if sink is None:
            return
        n = np.concatenate(lengths).astype("<u8")
        with fs.open_output_stream(f"{p}.len") as out:
            out.write(np.concatenate(ids).astype("<i8").tobytes())
            out.write(n.tobytes())
        row = [TaskContext.get().partitionId(), name, f"{name}.len", len(n), nulls, int(n.sum())]
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _MANIFEST_TYPES, strict=True)],
                                         names=_MANIFEST_NAMES)

    manifest = materialize(texts.mapInArrow(write, MANIFEST), "token_manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = manifest.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))

    def offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                fs, p = filesystem(r["lengths"])
                raw = _read(fs, p)
                n = np.frombuffer(raw, "<u8", r["docs"], 8 * r["docs"])
                name = new_file(folder, "tokens", ".idx")
                with fs.open_output_stream(filesystem(name)[1]) as out:
                    out.write(MAGIC)
                    out.write(np.array([width, r["docs"], r["nulls"], r["base"]], "<u8").tobytes())
                    out.write(raw[:8 * r["docs"]])
                    out.write((np.uint64(r["base"]) + np.concatenate([[0], np.cumsum(n)]).astype("<u8")).tobytes())
                yield pa.RecordBatch.from_pylist([{"part": r["part"], "bin": r["bin"], "idx": name}], schema=_PAIR)

    files = max(1, manifest.count())
    return materialize(based.repartition(files).mapInArrow(offsets, "part int, bin string, idx string"), "token_files")


_MANIFEST_NAMES = [f.split()[0] for f in MANIFEST.split(", ")]
_MANIFEST_TYPES = [pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
_PAIR = pa.schema([("part", pa.int32()), ("bin", pa.string()), ("idx", pa.string())])


def _read(fs: pafs.FileSystem, path: str) -> bytes:
    with fs.open_input_file(path) as f:
        return f.read()


class TokenFile:
    """One pair of files: document ids, global offsets and memory-mapped ids."""

    def __init__(self, bin_uri: str, idx_uri: str):
        fs, p = filesystem(idx_uri)
        raw = _read(fs, p)
        if raw[:8] != MAGIC:
            raise ValueError(f"not a token index: {idx_uri}")
        self.width, docs, self.nulls, self.base = np.frombuffer(raw, "<u8", 4, 8).tolist()
        self.doc_ids = np.frombuffer(raw, "<i8", docs, 40)
        self.offsets = np.frombuffer(raw, "<u8", docs + 1, 40 + 8 * docs).astype(np.int64)
        fs, p = filesystem(bin_uri)
        kind = f"<u{self.width}"
        if isinstance(fs, pafs.LocalFileSystem):
            self.ids = np.memmap(p, kind, "r") if self.offsets[-1] > self.base else np.zeros(0, kind)
        else:
            self.ids = np.frombuffer(_read(fs, p), kind)

    def __len__(self) -> int:
        return len(self.doc_ids)

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.offsets[i] - self.base:self.offsets[i + 1] - self.base]


def read_token_files(spark: SparkSession, files: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the files."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                f = TokenFile(r["bin"], r["idx"])
                for lo in range(0, len(f), READ_BATCH):
                    at = range(lo, min(len(f), lo + READ_BATCH))
                    start, end = f.offsets[lo:at.stop], f.offsets[lo + 1:at.stop + 1]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(f.doc_ids[lo:at.stop], pa.int64(), mask=np.arange(lo, at.stop) < f.nulls),
                         pa.array(start), pa.array(end - start),
                         pa.array([crc_of(f.document(i)) for i in at], pa.int64())], schema=schema)

    return files.repartition(max(1, files.count())).mapInArrow(
        read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_report(docs: DataFrame) -> DataFrame:
    """Write all of ``docs`` to a folder in the shared store and read it back."""
    spark = docs.sparkSession
    files = write_token_files(docs, shared_folder(spark, "llm", "token_files"))
    return read_token_files(spark, files)
