"""Mixture-controlled packing: deficit round-robin over source queues.

All documents are cut into pieces that fill sequences of CAPACITY tokens; each
sequence holds the sources in the proportions of the whole corpus, so that all
sources run out together.

Documents get a hash-random key; equal-width key ranges of about RANGE_TOKENS
tokens are the partitions, each with a like share of every source. A partition
fills its windows by deficit round-robin: each window credits every source with
its share of the window; a source whose credit reaches MIN_PIECE (or the
rest of its queue) is served up to its credit; what a source is owed, or has
had too much, is carried to the next window. Across partitions the deficits
come from prefix sums: a source's credit at the start of a partition is its
share of all tokens before it, less the source's own tokens before it.

The tokens left at a partition's end are cut at the binary digits of their
number into sequences that are powers of two long, so nothing is padded.

Null texts are one end id; null sources a source of their own. Repeated rows
are packed as documents of their own. An empty table gives no pieces.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallow.llm.common import key_bucket, materialize, spread_key
from tallow.llm.tokens import crc_of, id_width, token_table

CAPACITY = 2048
RANGE_TOKENS = 1 << 20
MIN_PIECE = 128
# Sequences are numbered from this much times their partition.
NUMBERS = 1 << 24
SUPER = 1024

PIECES = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()),
                    ("offset", pa.int64()), ("ids", pa.binary())])


def window_sizes(total: int, capacity: int = CAPACITY) -> list[int]:
    """Full windows, then the powers of two that make up the rest."""
    rest = total % capacity
    return [capacity] * (total // capacity) + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]


def schedule(queued: list[int], share: list[int], whole: int, credit: list[int],
             sizes: list[int], min_piece: int = MIN_PIECE) -> list[list[tuple[int, int]]]:
    """For each window, the ``(source, tokens)`` served in turn.

    ``queued`` are the tokens waiting per source, ``share`` of ``whole`` its
    target, ``credit`` what it is owed at the start, in units of 1 / whole
    tokens, so that all sums are exact integers.
    """
    left, credit, turn, out = list(queued), list(credit), 0, []
    n = len(left)
    for size in sizes:
        space, served = size, []
        for s in range(n):
            credit[s] += share[s] * size

        def serve(s: int, most: int) -> int:
            take = min(most, left[s], space)
            if take > 0:
                left[s] -= take
                credit[s] -= take * whole
                served.append((s, take))
            return max(take, 0)

        for s in [*range(turn, n), *range(turn)]:
            owed = credit[s] // whole
            if owed >= min(min_piece, left[s]):
                space -= serve(s, owed)
        while space:  # the most indebted sources fill up the window
            s = max((s for s in range(n) if left[s]), key=lambda s: (credit[s], -s))
            space -= serve(s, max(credit[s] // whole, min_piece))
        turn = (turn + 1) % n
        out.append(served)
    return out


def _packer(width: int, capacity: int, with_ids: bool):
    kind = f"<u{width}"

    def pack(key: tuple, docs: pa.Table, sources: pa.Table) -> pa.Table:
        part = key[0].as_py()
        if not docs.num_rows:
            return PIECES.empty_table()
        info = {r["code"]: r for r in sources.to_pylist()}
        docs = docs.sort_by([("code", "ascending"), ("key", "ascending"), ("doc_id", "ascending"), ("ids", "ascending")])
        codes = docs.column("code").to_pylist()
        names = list(dict.fromkeys(codes))
        doc_ids, labels = docs.column("doc_id").to_pylist(), docs.column("source").to_pylist()
        ids = [np.frombuffer(x, kind) for x in docs.column("ids").to_pylist()]
        at = {c: codes.index(c) for c in names}  # a source's next document, and the token in it
        inside = dict.fromkeys(names, 0)
        queued = dict.fromkeys(names, 0)
        for c, x in zip(codes, ids, strict=True):
            queued[c] += len(x)
        whole = info[names[0]]["whole"]
        credit = [info[c]["share"] * info[c]["all_before"] - whole * info[c]["own_before"] for c in names]
        sizes = window_sizes(sum(queued.values()), capacity)
        plan = schedule([queued[c] for c in names], [info[c]["share"] for c in names], whole, credit, sizes)
        rows = []
        for w, served in enumerate(plan):
            offset = 0
            for s, n in served:
                c = names[s]
                while n:
                    i = at[c]
                    take = min(n, len(ids[i]) - inside[c])
                    piece = ids[i][inside[c]:inside[c] + take]
                    rows.append((doc_ids[i], labels[i], inside[c], take, crc_of(piece), len(ids[i]),
                                 part * NUMBERS + w, offset, piece.tobytes() if with_ids else None))
                    offset, n, inside[c] = offset + take, n - take, inside[c] + take
                    if inside[c] == len(ids[i]):
                        at[c], inside[c] = i + 1, 0
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), PIECES, strict=True)],
                                    schema=PIECES)
    return pack


def _before(sums: DataFrame, group: list[str], value: str, out: str) -> DataFrame:
    """Running sums over ``part``, in two levels so that no window holds all parts."""
    sums = sums.withColumn("__super", F.floor(F.col("part") / SUPER))
    top = sums.groupBy(*group, "__super").agg(F.sum(value).alias("__top"))
    up = Window.partitionBy(*group).orderBy("__super").rowsBetween(Window.unboundedPreceding, -1)
    top = top.withColumn("__base", F.coalesce(F.sum("__top").over(up), F.lit(0))).drop("__top")
    low = Window.partitionBy(*group, "__super").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inner = F.coalesce(F.sum(value).over(low), F.lit(0))
    return (sums.withColumn("__inner", inner).join(top, [*group, "__super"])
            .withColumn(out, F.col("__base") + F.col("__inner")).drop("__super", "__inner", "__base"))


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY,
                   range_tokens: int = RANGE_TOKENS, with_ids: bool = False) -> DataFrame:
    """The pieces (:data:`PIECES`) of all documents; ``ids`` only on request."""
    spark = docs.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2048")
    keyed = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), "text").withColumn(
        "code", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("-"))).withColumn(
        "key", spread_key("pack", F.col("doc_id"), F.xxhash64("text")))
    tokens = materialize(token_table(keyed, ["doc_id", "source", "code", "key"], path), "tokens")
    whole = tokens.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    parted = tokens.withColumn("part", key_bucket(F.col("key"), max(1, -(-whole // range_tokens))).cast("long"))

    sums = materialize(parted.groupBy("part", "code").agg(F.sum("n_tokens").alias("own")), "token_sums")
    per_source = sums.groupBy("code").agg(F.sum("own").alias("share"))
    own = _before(sums, ["code"], "own", "own_before")
    every = sums.groupBy("part").agg(F.sum("own").alias("all")).withColumn("one", F.lit(0))
    every = _before(every, ["one"], "all", "all_before").select("part", "all_before")
    credit = (own.join(per_source, "code").join(every, "part").withColumn("whole", F.lit(whole))
              .select("part", "code", "share", "own_before", "all_before", "whole"))
    out = ", ".join(f"`{f.name}` {t}" for f, t in zip(
        PIECES, ["bigint", "string", *["bigint"] * 6, "binary"], strict=True))
    packed = (parted.select("part", "doc_id", "source", "code", "key", "ids").groupBy("part")
              .cogroup(credit.groupBy("part")).applyInArrow(_packer(id_width(path), capacity, with_ids), out))
    return packed if with_ids else packed.drop("ids")


def sequences(pieces: DataFrame) -> DataFrame:
    """``sequence_id, n_tokens, ids`` from pieces made ``with_ids``."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("p")).select(
        "sequence_id", "n_tokens", F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))
