"""Embedding near-dedup by a subspace pigeonhole join.

Vectors with equal labels and a cosine of at least COSINE are linked. Scaled to
length 1, two linked vectors are at a squared distance of at most
``2 * (1 - COSINE)``, and a rotation keeps distances. The rotated coordinates are
split into BLOCKS blocks, each with a share of that squared distance in proportion
to its share of the variance. If every block's distance were above its share, the
whole would be too far; so each linked pair lies within the share of some block.

1. Equal vectors of a label form one class; classes are compared, and count with
   the copies they hold.
2. The rotation is the principal axes of SAMPLE classes, dealt round to the
   blocks, so that every block starts with an axis of great spread. Any rotation
   gives the same result; the sample only decides how well cells separate.
3. Range join in each block: cells are intervals of the block's first coordinate,
   as wide as the block's radius, so a partner is in the own cell or the next.
   A class is at home in its cell and a guest in the next one.
4. Cells with more than CHUNK rows are split into chunks (of up to MAX_CHUNK rows in
   very large cells, to limit their copies); each pair of chunks is a task of
   bounded size, dealt out by itself. There the block's distance selects candidates, and only
   candidates are compared as whole vectors, in double precision.
5. A pair is taken where it first appears: in the first block whose share it
   keeps to. So the union needs no list of pairs, and links are counted as they
   are found. Tasks return one row per class: its links there, and the smallest
   member it is connected with there, from which components follow. A group of
   near copies never becomes a table of pairs.

Within one label the vectors in adjacent cells are compared block-wise; where
vectors have no structure at all (isotropic noise) the cells thin them out only
by a constant factor, as for every exact join on such data.

Null labels, null, empty and zero vectors and those with null or non-finite
components link with nothing; neither do vectors of different lengths. Rows that
repeat an id and its vector are one vector and get the same result. Rows that
give an id different vectors count each for their own vector and share one
component. Rows without an id get no links and a null component, and are kept;
they count for nobody. Ties need no rule: links have no order. Very long vectors
work like others (a rotation costs the square of the length). Other columns are
ignored. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallow.llm.common import materialize
from tallow.llm.components import components
from tallow.session import let_workers_import
from tallow.sources.tables import delete_path

COSINE = 0.93
BLOCKS = 4
CHUNK, MAX_CHUNK = 4096, 16384  # rows of a cell that one task takes from each side; more in larger cells
SIDES = 32     # chunks of a cell before they grow
TILE = 1024    # rows compared at once within a task
SAMPLE = 2000  # classes that the rotation is fitted on
SLACK = 1e-4   # relative room for rounding in the distances that select candidates

CELL = ["label", "dim", "block", "cell"]
CLASSES = "label bigint, dim int, id bigint, key binary, copies bigint, vec binary"


def _kind(vectors: DataFrame) -> str:
    """The numpy type that vectors are kept in: that of the column's elements, float or else double."""
    return "<f4" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "<f8"


def _usable(vectors: DataFrame, kind: str) -> DataFrame:
    """``vec_id, label, dim, key, vec``; the key is null where a vector links with nothing."""
    src = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"),
                         F.col("embedding").cast("array<float>" if kind == "<f4" else "array<double>"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, labels, lists = b.columns
            sizes = lists.value_lengths().fill_null(0).to_numpy()
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(kind) + 0  # nulls are NaN; no negative zero
            ends = np.cumsum(sizes)
            keys, vecs = [], []
            for ok, label, end, size in zip((ids.is_valid().to_numpy(False) & labels.is_valid().to_numpy(False)),
                                            labels.to_pylist(), ends, sizes, strict=True):
                v = flat[end - size:end]
                if ok and size and np.isfinite(v).all() and v.any():
                    data = v.tobytes()
                    keys.append(hashlib.blake2b(data, digest_size=16, salt=label.to_bytes(16, "little", signed=True)).digest())
                    vecs.append(data)
                else:
                    keys.append(None)
                    vecs.append(None)
            yield pa.RecordBatch.from_arrays([ids, labels, pa.array(sizes, pa.int32()), pa.array(keys, pa.binary()),
                                              pa.array(vecs, pa.binary())],
                                             names=["vec_id", "label", "dim", "key", "vec"])

    return src.mapInArrow(run, "vec_id bigint, label bigint, dim int, key binary, vec binary")


def units(vecs: list[bytes], dim: int, kind: str) -> np.ndarray:
    """Unit vectors, in double precision, of equally long ones of elements ``kind``."""
    x = np.frombuffer(b"".join(vecs), kind).reshape(-1, dim).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _covariance(classes: DataFrame, dim: int, kind: str) -> np.ndarray:
    """Covariance of the unit vectors of SAMPLE classes, those of the least digests."""
    rows = classes.where(F.col("dim") == dim).orderBy("key", "label").limit(SAMPLE).select("vec").collect()
    u = units([r["vec"] for r in rows], dim, kind)
    return np.cov(u.T, bias=True).reshape(dim, dim)


class Subspaces:
    """A rotation, its blocks and each block's squared-distance budget."""

    def __init__(self, dim: int, cosine: float, blocks: int, covariance: np.ndarray | None = None):
        blocks = min(blocks, dim)
        if covariance is None:
            axes = np.linalg.qr(np.random.RandomState(dim).normal(size=(dim, dim)))[0]
            spread = np.ones(dim)
        else:
            spread, axes = np.linalg.eigh(covariance)
            spread, axes = np.maximum(spread[::-1], 0), axes[:, ::-1]
        order = np.concatenate([np.arange(b, dim, blocks) for b in range(blocks)])
        self.axes = axes[:, order]
        ends = np.cumsum([len(range(b, dim, blocks)) for b in range(blocks)])
        self.spans = [(int(e - len(range(b, dim, blocks))), int(e)) for b, e in enumerate(ends)]
        share = np.array([spread[b::blocks].sum() for b in range(blocks)])
        share = share / max(share.sum(), 1e-300) + 0.01 / blocks  # no block without any budget
        self.budget = 2 * (1 - cosine) * (1 + SLACK) * share / share.sum()

    def rotate(self, x: np.ndarray) -> np.ndarray:
        return (x @ self.axes).astype(np.float32)

    def cells(self, rotated: np.ndarray, block: int) -> np.ndarray:
        return np.floor(rotated[:, self.spans[block][0]].astype(np.float64) / (1.00001 * np.sqrt(self.budget[block]))).astype(np.int64)

    def within(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For pairs of rotated rows, whether each block's distance keeps to its budget."""
        d = a.astype(np.float64) - b
        d *= d
        return np.stack([d[:, lo:hi].sum(axis=1) for lo, hi in self.spans], axis=1) <= self.budget


def _homes(classes: DataFrame, spaces: dict[int, Subspaces], cosine: float, blocks: int, kind: str) -> DataFrame:
    """Each class in the cells of all blocks: at home in one, a guest in the next."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = dict(spaces)
        for b in batches:
            dims = b.column(1).to_numpy()
            for dim in np.unique(dims):
                if dim not in made:
                    made[dim] = Subspaces(int(dim), cosine, blocks)
                part = b.filter(pa.array(dims == dim))
                rotated = made[dim].rotate(units(part.column(5).to_pylist(), int(dim), kind))
                data = pa.array([r.tobytes() for r in rotated], pa.binary())
                for block in range(len(made[dim].spans)):
                    cell = made[dim].cells(rotated, block)
                    for guest in (0, 1):
                        yield pa.RecordBatch.from_arrays(
                            [*part.columns, data, pa.array(np.full(len(cell), block), pa.int32()), pa.array(cell + guest, pa.int64()),
                             pa.array(np.full(len(cell), bool(guest)))],
                            names=[*part.schema.names, "rotated", "block", "cell", "guest"])

    return classes.mapInArrow(run, f"{CLASSES}, rotated binary, block int, cell bigint, guest boolean")


def _split_cells(placed: DataFrame, chunk: int, most: int) -> DataFrame:
    """Chunks of homes ``h`` and guests ``g`` of every cell that has more than one of either."""
    sizes = placed.groupBy(*CELL).agg(F.sum((~F.col("guest")).cast("int")).alias("homes"),
                                      F.sum(F.col("guest").cast("int")).alias("guests"))
    size = F.least(F.lit(most), F.greatest(F.lit(chunk), F.ceil(F.col("homes") / SIDES)))
    chunks = lambda c: F.greatest(F.lit(1), F.ceil(F.col(c) / size)).cast("int")
    return sizes.select(*CELL, chunks("homes").alias("h"), chunks("guests").alias("g")).where("h > 1 OR g > 1")


def _tasks(placed: DataFrame, split: DataFrame) -> DataFrame:
    """Rows of ``placed`` dealt to pairs of chunks ``(one, other)`` of their cell.

    Chunks are numbered homes first. A pair has a home chunk as ``one`` and any
    later chunk as ``other``; pairs within ``one`` are compared where ``other`` is
    the first guest chunk. There is always a guest chunk, if an empty one. Tasks
    are keyed as one value, so that those of a cell are not dealt out together.
    """
    salt = F.xxhash64("key")
    own = F.when(F.col("guest"), F.col("h") + F.pmod(salt, F.col("g"))).otherwise(F.pmod(salt, F.col("h"))).cast("int")
    numbered = placed.join(split, CELL, "left").fillna(1, ["h", "g"]).withColumn("own", own)
    earlier = F.transform(F.sequence(F.lit(0), F.least("own", "h") - 1), lambda i: F.struct(i.alias("one"), F.col("own").alias("other")))
    later = F.transform(F.sequence(F.col("own") + 1, F.col("h") + F.col("g") - 1), lambda j: F.struct(F.col("own").alias("one"), j.alias("other")))
    none = F.array().cast("array<struct<one:int,other:int>>")
    pairs = F.concat(F.when(F.col("own") > 0, earlier).otherwise(none), F.when(~F.col("guest"), later).otherwise(none))
    dealt = numbered.withColumn("pair", F.explode(pairs)).select(*placed.columns, "h", "own", "pair.one", "pair.other")
    return dealt.withColumn("task", F.struct(*CELL, "one", "other"))


def _union(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of the paired elements; a set's root is its least element."""
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root[:] = up


def _pairs(space: Subspaces, block: int, rotated: np.ndarray, rows: np.ndarray, cols: np.ndarray,
           triangle: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of ``rows`` and ``cols`` within the block's budget that no earlier block takes."""
    lo, hi = space.spans[block]
    radius = np.sqrt(space.budget[block])
    first = rotated[:, lo]
    rows, cols = rows[np.argsort(first[rows], kind="stable")], cols[np.argsort(first[cols], kind="stable")]
    part = rotated[:, lo:hi]
    square = np.einsum("ij,ij->i", part, part)
    limit = np.float32(space.budget[block] + 1e-5)
    for i in range(0, len(rows), TILE):
        r = rows[i:i + TILE]
        # Rows run by the first coordinate, so their partners are one stretch of the columns.
        a = np.searchsorted(first[cols], first[r[0]] - radius * 1.001, "left")
        a = i if triangle else a
        z = np.searchsorted(first[cols], first[r[-1]] + radius * 1.001, "right")
        for j in range(a, z, TILE):
            c = cols[j:min(z, j + TILE)]
            x, y = np.nonzero(square[r][:, None] + square[c][None, :] - 2 * (part[r] @ part[c].T) <= limit)
            if triangle:
                once = i + x < j + y
                x, y = x[once], y[once]
            x, y = r[x], c[y]
            for k in range(0, len(x), 16 * TILE):
                p, q = x[k:k + 16 * TILE], y[k:k + 16 * TILE]
                ok = space.within(rotated[p], rotated[q])
                # The first block in whose budget the pair is takes it.
                mine = ok[:, block] & ~ok[:, :block].any(axis=1)
                yield p[mine], q[mine]


def _links(spaces: dict[int, Subspaces], cosine: float, blocks: int, kind: str):
    """Links of one task: per class its linked copies and the least class connected with it."""
    def find(task: pa.Table) -> pa.Table:
        task = task.combine_chunks()
        dim, block, h, one, other = (task.column(c)[0].as_py() for c in ("dim", "block", "h", "one", "other"))
        space = spaces.get(dim) or Subspaces(dim, cosine, blocks)
        ids = task.column("id").to_numpy()
        order = np.lexsort((np.array(task.column("key").to_pylist(), dtype="S16"), ids))
        task, ids = task.take(pa.array(order)), ids[order]
        unit = units(task.column("vec").to_pylist(), dim, kind)
        rotated = np.frombuffer(b"".join(task.column("rotated").to_pylist()), np.float32).reshape(-1, dim)
        copies, own = task.column("copies").to_numpy(), task.column("own").to_numpy()
        homes, others = np.flatnonzero(own == one), np.flatnonzero(own == other)
        count, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
        jobs = [(homes, others, False)]
        if other == h:
            jobs.append((homes, homes, True))
        for rows, cols, triangle in jobs:
            if not len(rows) or not len(cols):
                continue
            for p, q in _pairs(space, block, rotated, rows, cols, triangle):
                linked = np.einsum("ij,ij->i", unit[p], unit[q]) >= cosine
                p, q = p[linked], q[linked]
                np.add.at(count, p, copies[q])
                np.add.at(count, q, copies[p])
                _union(root, p, q)
        some = np.flatnonzero(count)
        return pa.table({"id": pa.array(ids[some], pa.int64()), "key": task.column("key").take(pa.array(some)),
                         "links": pa.array(count[some], pa.int64()), "least": pa.array(ids[root[some]], pa.int64())})
    return find


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, blocks: int = BLOCKS) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors``."""
    spark = vectors.sparkSession
    let_workers_import(spark)
    kind = _kind(vectors)
    rows = materialize(_usable(vectors, kind), "vectors")
    nodes = rows.where("key IS NOT NULL").groupBy("label", "dim", "key", "vec_id").agg(F.first("vec").alias("vec"))
    classes = materialize(nodes.groupBy("label", "dim", "key").agg(
        F.min("vec_id").alias("id"), F.count("*").alias("copies"), F.first("vec").alias("vec")).select(
        "label", "dim", "id", "key", "copies", "vec"), "vector_classes")

    # The most frequent length gets principal axes, any other a fixed rotation.
    common = classes.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    spaces = {}
    if common:
        spaces[common["dim"]] = Subspaces(common["dim"], cosine, blocks, _covariance(classes, common["dim"], kind))
    placed = _homes(classes, spaces, cosine, blocks, kind)
    split = materialize(_split_cells(placed, CHUNK, MAX_CHUNK), "split_cells")
    found = materialize(_tasks(placed, split).groupBy("task").applyInArrow(
        _links(spaces, cosine, blocks, kind), "id bigint, key binary, links bigint, least bigint"), "vector_links")

    # Classes that share an id belong together, too.
    repeated = (rows.where("key IS NOT NULL").groupBy("vec_id").agg(F.min("key").alias("a"), F.max("key").alias("b")).where("a <> b")
                .select("vec_id"))
    of_repeated = (rows.where("key IS NOT NULL").join(repeated, "vec_id").select("vec_id", "key").distinct()
                   .join(classes.select("key", "id"), "key"))
    edges = found.select(F.col("id").alias("u"), F.col("least").alias("v")).union(
        of_repeated.select(F.col("vec_id").alias("u"), F.col("id").alias("v")))
    label = components(edges)
    counts = found.groupBy("key").agg(F.sum("links").alias("links"))
    result = (classes.select("key", "id", "copies").join(counts, "key", "left").join(label, "id", "left")
              .select("key", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n"),
                      F.coalesce("component", "id").alias("component")))
    out = (rows.select("vec_id", "key").join(result, "key", "left")
           .select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
                   F.coalesce("component", "vec_id").alias("component_id"))
           .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))
    out = materialize(out, "vector_report")
    for t in (rows, classes, split, found):
        delete_path(spark, t._tallow_path)
    return out
