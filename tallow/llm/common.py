"""Helpers shared by the training-data operators.

Words, here and in every operator that says "words", are the runs
``[^\\x20\\x09-\\x0D]+``. Python's ``bytes.split()`` splits on exactly those
six ASCII white-space characters, so it is the tokenizer inside tasks.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallow.session import let_workers_import, shared_dir
from tallow.sources.tables import delete_path

WORD = r"[^\x20\x09-\x0D]+"
WHITE = " \t\n\x0b\x0c\r"
# Rows of one Arrow batch: documents can be 100 KB and more, so a batch of
# Spark's default 10,000 rows could be a gigabyte.
BATCH_ROWS = "512"
# Batches that are put together have so many bytes at most, if they are more than one.
JOINED_BYTES = 16 << 20
ARROW = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(),
         "string": pa.string(), "binary": pa.binary()}
ARROW |= {f"array<{k}>": pa.list_(t) for k, t in ARROW.items()}


def bounded_batches(spark: SparkSession) -> None:
    """Prepare for tasks on whole documents: small Arrow batches, this package importable."""
    let_workers_import(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage at a table that survives lost executors, and fixes
    results that a second evaluation could change (range boundaries, file
    names).
    """
    spark = df.sparkSession
    path = shared_folder(spark, "llm", name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tallow_path = path
    return out


def drop_table(df: DataFrame) -> None:
    """Delete a table made by :func:`materialize` that nothing reads any more."""
    path = getattr(df, "_tallow_path", None)
    if path:
        delete_path(df.sparkSession, path)


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a folder or file in the shared store, for tasks.

    Hadoop's names of S3 are pyarrow's ``s3``. A path without a scheme is refused:
    Spark would look for it in the cluster's default store, a task on its own disk.
    """
    scheme, colon, rest = uri.partition(":")
    if not colon or "/" in scheme:
        raise ValueError(f"{uri} names no file system; use shared_folder")
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    return pafs.FileSystem.from_uri(("s3" if scheme in ("s3a", "s3n") else scheme) + colon + rest)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of the store in which Spark finds it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()


def shared_folder(spark: SparkSession, *parts: str) -> str:
    """A fresh folder in the shared store, with its scheme, so that tasks find it, too."""
    return qualified(spark, shared_dir(spark, *parts))


def read_shared(path: str, columns: list[str] | None = None) -> pa.Table:
    """All rows of a table of :func:`materialize` whose size is bounded, read within a task."""
    return pa.concat_tables(pq.read_table(p, filesystem=fs, columns=columns) for fs, p in _files(path))


def shared_batches(path: str, columns: list[str], rows: int) -> Iterator[pa.RecordBatch]:
    """The rows of :func:`read_shared`, in its order, at most so many at a time."""
    for fs, p in _files(path):
        with fs.open_input_file(p) as f:
            yield from pq.ParquetFile(f).iter_batches(rows, columns=columns)


def _files(path: str) -> list[tuple[pafs.FileSystem, str]]:
    fs, p = filesystem(path)
    return [(fs, f.path) for f in sorted(fs.get_file_info(pafs.FileSelector(p)), key=lambda f: f.path) if f.path.endswith(".parquet")]


def new_file(folder: str, stem: str, suffix: str) -> str:
    """A file name no other task attempt uses.

    Writers return their file names as rows; a reader opens only files whose
    rows were committed, so what a lost or repeated attempt left is never read.
    """
    return f"{folder.rstrip('/')}/{stem}-{uuid.uuid4().hex}{suffix}"


def per_document(df: DataFrame, fn: Callable[[str], tuple], schema: str,
                 keep: list[str], text: str = "text") -> DataFrame:
    """``fn(text)`` for each row in Arrow batches; null texts count as empty.

    ``keep`` are the input columns carried along; ``schema`` the DDL of the
    values that ``fn`` returns, in order.
    """
    return per_batch(df, lambda texts: map(fn, texts), schema, keep, text)


def per_batch(df: DataFrame, fn: Callable[[list[str]], Iterable[tuple]], schema: str,
              keep: list[str], text: str = "text", rows: int = 0) -> DataFrame:
    """:func:`per_document` with a ``fn`` that takes the texts of a batch.

    With ``rows`` it takes those of several batches, see :func:`joined`.
    """
    src = df.select(*[F.col(f"`{c}`") for c in keep], F.coalesce(F.col(text).cast("string"), F.lit("")).alias("__text"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1])
    names, types = zip(*[(n, ARROW[t]) for n, t in (f.split() for f in schema.split(", "))], strict=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in joined(batches, rows) if rows else batches:
            found = list(fn(b.column(b.num_columns - 1).to_pylist()))
            cols = list(zip(*found, strict=True)) if found else [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], *[pa.array(c, t) for c, t in zip(cols, types, strict=True)]],
                names=[*b.schema.names[:-1], *names])
        b = found = cols = None
        release_memory()

    return src.mapInArrow(run, f"{kept}, {schema}")


def joined(batches: Iterable[pa.RecordBatch], rows: int, size: int = JOINED_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, put together as long as they have at most so many rows and bytes."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if held and (sum(h.num_rows for h in held) + b.num_rows > rows or sum(h.nbytes for h in held) + b.nbytes > size):
            yield pa.concat_batches(held)
            held = []
        held.append(b)
    if held:
        yield pa.concat_batches(held)


def release_memory() -> None:
    """Give freed memory back to the system.

    Called at a task's end: workers outlive tasks and stages, a machine has several,
    and Arrow and the C library keep what they were given for later.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library
    if trim:
        trim(0)


def spread_key(*parts: Column | str) -> Column:
    """A uniform 32-digit hex key that every engine computes alike (MD5)."""
    return F.md5(F.concat_ws(":", *[F.lit(p) if isinstance(p, str) else
                                    F.coalesce(p.cast("string"), F.lit("null")) for p in parts]))


def key_bucket(key: Column, buckets: int) -> Column:
    """The equal-width range of a :func:`spread_key` that ``key`` falls in."""
    return F.floor(F.conv(F.substring(key, 1, 8), 16, 10).cast("long") * F.lit(buckets) / F.lit(2 ** 32)).cast("int")


def prefix_sums(df: DataFrame, group: str, key: str, order: list[str], value: str,
                out: str, buckets: int, attach: DataFrame | None = None) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows of the group before this one.

    Rows of a group run by ``key`` (a :func:`spread_key`), then ``order``. The
    key is uniform, so its equal-width ranges split a hot group evenly: sums
    within a range by a window, the ranges' bases by a second window over one
    row per group and range. ``attach`` has one row per group, whose other
    columns are added too; it rides on the bases, so no row of ``df`` is dealt
    out by group alone.
    """
    code = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-"))  # null is a group, too
    ranged = df.withColumn("__range", key_bucket(F.col(key), buckets)).withColumn("__group", code)
    sums = ranged.groupBy("__group", "__range").agg(F.sum(value).alias("__sum"))
    w = Window.partitionBy("__group").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("__group", "__range", F.coalesce(F.sum("__sum").over(w), F.lit(0)).alias("__base"))
    if attach is not None:
        bases = bases.join(attach.withColumn("__group", code).drop(group), "__group")
    inner = (Window.partitionBy("__group", "__range").orderBy(key, *order)
             .rowsBetween(Window.unboundedPreceding, -1))
    return (ranged.withColumn("__before", F.coalesce(F.sum(value).over(inner), F.lit(0)))
            .join(bases, ["__group", "__range"])
            .withColumn(out, F.col("__base") + F.col("__before"))
            .drop("__group", "__range", "__before", "__base"))


def ranges_for(spark: SparkSession) -> int:
    """Ranges a group is split into: a few for each shuffle partition."""
    return 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
