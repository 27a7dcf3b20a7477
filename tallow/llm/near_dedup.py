"""MinHash near-dedup by fast similarity sketching, banding and exact checks.

A document's set holds the 64-bit hashes of its distinct word shingles. The
sketch (Dahlgaard, Knudsen and Thorup, 2017) throws the whole set into BINS
bins, round after round: in round i every element goes to one hashed bin with
the value i plus a hashed fraction, a bin keeps its least value, and the rounds
end once all bins are full. Rounds from BINS on put every element into bin
i - BINS, so the sketch is full after 2 * BINS rounds even for one element.
Bins agree with probability equal to the Jaccard similarity, as for MinHash,
with as good concentration, at the price of about one pass.

BANDS bands of BINS / BANDS bins are the candidate buckets: a pair at
similarity 0.8 meets in none with probability 6e-7. Links are confirmed on the
full sets. Within a bucket not all pairs are compared:

1. Equal sets form classes; only a representative of each is compared.
2. Every member is checked against the bucket's hub, the member with most
   company over all its buckets. For copies of one original that is about
   always the original.
3. After contracting the confirmed links, members outside the hub's component
   are checked against all members of other components: in small buckets as
   pairs, in large ones block by block, each cell holding two bounded blocks
   and returning only confirmed links.

So no link between different components goes unchecked, whatever a bucket's
size, and links inside a component, which cannot change it, are not expanded.

Null or wordless texts have an empty set and link to nothing; null ids link to
nothing and stay their own. Rows that repeat an id are one node, whatever their
texts: it has the links of each, and all its rows get one component. Equal sets
go to their smallest id. Very long texts are compared whole. Other columns,
whatever their names, are ignored or, by :func:`drop_near_duplicates`, carried
along. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallow.llm.common import bounded_batches, drop_table, materialize, per_document
from tallow.llm.components import components

SHINGLE, PERCENT = 5, 80
BINS, BANDS = 180, 36
# Buckets of up to so many members are compared as pairs, larger ones in
# blocks of BLOCK members.
SMALL, BLOCK = 16, 256
SALTS = 16

_M1, _M2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_FRACTION = np.uint64(40)


def mixed(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles; A-Z in lower case."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, number), np.uint64, len(number))[ids]
    width = min(k, len(words))
    with np.errstate(over="ignore"):
        acc = np.full(len(words) - width + 1, width, np.uint64)
        for j in range(width):
            acc = mixed(acc * _STEP + hashed[j:len(words) - width + 1 + j])
    return np.unique(acc)


def sketch(elements: np.ndarray, bins: int = BINS) -> np.ndarray:
    """The fast similarity sketch of a non-empty set of 64-bit hashes."""
    n, empty = len(elements), np.uint64(2 ** 64 - 1)
    out = np.full(bins, empty)
    done = 0
    with np.errstate(over="ignore"):
        while done < 2 * bins and (out == empty).any():
            # Values carry their round, so several rounds at once give the same minima.
            rounds = np.arange(done, min(2 * bins, done + max(1, 4096 // n)), dtype=np.uint64)
            x = mixed(elements[None, :] ^ mixed((rounds + np.uint64(1)) * _STEP)[:, None])
            target = ((x >> _FRACTION) * np.uint64(bins) >> np.uint64(24)).astype(np.int64)
            fixed = rounds >= bins
            target[fixed] = (rounds[fixed] - np.uint64(bins)).astype(np.int64)[:, None]
            value = (rounds[:, None] << _FRACTION) | (x & ((np.uint64(1) << _FRACTION) - np.uint64(1)))
            np.minimum.at(out, target.reshape(-1), value.reshape(-1))
            done += len(rounds)
    return out


def band_keys(values: np.ndarray, bands: int = BANDS) -> np.ndarray:
    rows = values.reshape(bands, -1)
    with np.errstate(over="ignore"):
        acc = mixed(np.arange(1, bands + 1, dtype=np.uint64) * _STEP)
        for j in range(rows.shape[1]):
            acc = mixed(acc * _STEP + rows[:, j])
    return acc.view(np.int64)


def linked(common, a, b, percent: int = PERCENT):
    """Whether ``common`` shared elements link sets of sizes a and b."""
    return 100 * common >= percent * (a + b - common)


def _sketches(docs: DataFrame, k: int) -> DataFrame:
    def one(text: str) -> tuple:
        s = shingle_set(text, k)
        if not len(s):
            return 0, None, []
        return len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest(), band_keys(sketch(s)).tolist()

    return per_document(docs, one, "n_shingles bigint, set_id binary, bands array<bigint>", ["doc_id", "text_hash"])


def _one_node(sketches: DataFrame, classes: DataFrame) -> DataFrame:
    """``doc_id, id, least``: the classes of each id whose rows have different texts, and the least of them."""
    rows = sketches.where("doc_id IS NOT NULL")
    repeated = (rows.groupBy("doc_id").agg(F.min("text_hash").alias("a"), F.max("text_hash").alias("b"))
                .where("a <> b").select("doc_id"))
    own = (rows.where("n_shingles > 0").select("doc_id", "set_id").join(repeated, "doc_id", "left_semi").distinct()
           .join(classes.select("set_id", "id"), "set_id").select("doc_id", "id"))
    least = own.groupBy("doc_id").agg(F.min("id").alias("least"))
    # One id may have very many texts: its rows are dealt to SALTS tasks.
    salted = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return (own.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
            .join(salted, ["doc_id", "salt"]).select("doc_id", "id", "least"))


def _confirmed(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The rows of ``pairs (a, b)`` whose full sets are similar enough, as ``(u, v)``."""
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")

    def check(batches):
        import pyarrow as pa
        last, last_set = None, None
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x = shingle_set(a, k)
                if b != last:
                    last, last_set = b, shingle_set(b, k)
                common = len(np.intersect1d(x, last_set, assume_unique=True))
                keep.append(common > 0 and linked(common, len(x), len(last_set), percent))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["u", "v"]).filter(pa.array(keep))

    return both.mapInArrow(check, "u bigint, v bigint")


def _cell_links(k: int, percent: int):
    """Links of one cell between its queries and its members of other components."""
    def links(cell: pd.DataFrame) -> pd.DataFrame:
        sets = {t: shingle_set(t, k) for t in cell["text"].unique()}
        queries, members = cell[cell["query"]], cell[~cell["query"]]
        q_ids, q_comp = queries["id"].to_numpy(), queries["comp"].to_numpy()
        q_sets = [sets[t] for t in queries["text"]]
        q_size = np.array([len(s) for s in q_sets], np.int64)
        found: set[tuple[int, int]] = set()
        reached: set[tuple[int, int]] = set()
        if len(queries):
            everything = np.concatenate(q_sets)
            owner = np.repeat(np.arange(len(q_ids)), q_size)
            order = np.argsort(everything, kind="stable")
            everything, owner = everything[order], owner[order]
            for d, comp, s in zip(members["id"], members["comp"], members["text"].map(sets), strict=True):
                lo, hi = np.searchsorted(everything, s, "left"), np.searchsorted(everything, s, "right")
                runs = hi - lo
                at = np.repeat(lo - np.concatenate([[0], np.cumsum(runs)[:-1]]), runs) + np.arange(runs.sum())
                common = np.bincount(owner[at], minlength=len(q_ids))
                for i in np.flatnonzero(linked(common, q_size, len(s), percent) & (q_comp != comp) & (common > 0)):
                    # One link from a query to a component is enough.
                    if (int(q_ids[i]), int(comp)) not in reached:
                        reached.add((int(q_ids[i]), int(comp)))
                        found.add((int(q_ids[i]), int(d)))
        return pd.DataFrame(sorted(found), columns=["u", "v"], dtype="int64")
    return links


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``."""
    bounded_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text"),
                       F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("text_hash"))
    sketches = materialize(_sketches(docs, shingle), "sketches")
    usable = sketches.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = materialize(usable.groupBy("set_id").agg(
        F.min("doc_id").alias("id"), F.min_by("bands", "doc_id").alias("bands"),
        F.first("n_shingles").alias("n")), "classes")
    one_node = materialize(_one_node(sketches, classes), "one_node")

    # Buckets with company.
    banded = classes.select("id", "n", F.explode("bands").alias("key"))
    keys = materialize(banded.groupBy("key").agg(F.count("*").alias("m")).where("m > 1"), "keys")
    members = materialize(banded.join(keys, "key"), "members")
    met = members.select(F.col("id").alias("doc_id")).distinct()
    # A repeated row once; an id with different texts has a row for each.
    texts = materialize(docs.join(met.hint("merge"), "doc_id", "left_semi").groupBy("doc_id", "text_hash")
                        .agg(F.first("text").alias("text")).select("doc_id", "text"), "texts")

    # Every member against its bucket's hub.
    company = members.groupBy("id").agg(F.sum(F.col("m") - 1).alias("company"))
    rank = F.struct(F.col("company"), (-F.col("id")).alias("minus_id"), F.col("n").alias("hub_n"))
    hubs = materialize(members.join(company, "id").groupBy("key").agg(F.max(rank).alias("r"))
                       .select("key", (-F.col("r.minus_id")).alias("hub"), F.col("r.hub_n").alias("hub_n")), "hubs")
    similar_size = (100 * F.least("n", "hub_n")) >= percent * F.greatest("n", "hub_n")
    star = (members.join(hubs, "key").where((F.col("id") != F.col("hub")) & similar_size)
            .select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct())
    same = one_node.where("id <> least").select(F.col("id").alias("u"), F.col("least").alias("v"))
    first = materialize(_confirmed(star, texts, shingle, percent).union(same), "hub_links")

    # What is left: members outside the hub's component.
    label = materialize(components(first), "first_labels")
    comp_of = label.select("id", F.col("component").alias("comp"))
    hub_comp = hubs.join(label.select(F.col("id").alias("hub"), F.col("component").alias("c")), "hub", "left").select(
        "key", "hub", "hub_n", F.coalesce("c", "hub").alias("hub_comp"))
    placed = materialize(members.join(comp_of, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
                         .join(hub_comp, "key").withColumn("query", F.col("comp") != F.col("hub_comp")), "placed")
    left = placed.groupBy("key").agg(F.sum(F.col("query").cast("int")).alias("queries")).where("queries > 0")
    open_ = placed.where("m > 2").join(left, "key")  # in a bucket of two, the hub was the only partner
    second = _small_buckets(open_, texts, shingle, percent).union(_large_buckets(open_, texts, shingle, percent))
    second = materialize(second, "other_links")

    final = materialize(components(first.union(second)), "labels")
    of_class = (classes.select("set_id", "id").join(final, "id", "left")
                .select("set_id", F.coalesce("component", "id").alias("component")))
    of_class = materialize(of_class, "class_labels")
    of_id = (one_node.where("id = least").join(final, "id", "left")
             .select("doc_id", F.coalesce("component", "id").alias("component")))
    with_set = F.expr("n_shingles > 0 AND doc_id IS NOT NULL")
    out = (sketches.where(with_set).select("doc_id", "n_shingles", "set_id").join(of_class, "set_id").drop("set_id")
           .union(sketches.where(~with_set).select("doc_id", "n_shingles").join(of_id, "doc_id", "left"))
           .withColumn("component_id", F.coalesce("component", "doc_id"))
           .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))
    out = materialize(out.select("doc_id", "n_shingles", "component_id", "kept"), "near_duplicates")
    for t in (sketches, classes, one_node, keys, members, texts, hubs, first, label, placed, second, final, of_class):
        drop_table(t)
    return out


def _small_buckets(open_: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Links between members of different components, by pairs of at most SMALL members."""
    small = open_.where(F.col("m") <= SMALL)
    queries = small.where("query").select("key", F.col("id").alias("a"), F.col("comp").alias("comp_a"), F.col("n").alias("n_a"))
    # The hub was checked, but for other texts that repeat its id.
    others = small.where("id <> hub OR n <> hub_n").select("key", F.col("id").alias("b"), F.col("comp").alias("comp_b"),
                                             F.col("n").alias("n_b"), F.col("query").alias("query_b"))
    pairs = queries.join(others, "key").where(
        (F.col("comp_a") != F.col("comp_b")) & (~F.col("query_b") | (F.col("a") < F.col("b")))
        & (100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")))
    return _confirmed(pairs.select("a", "b").distinct(), texts, k, percent)


def _large_buckets(open_: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The same for larger buckets, by cells of two blocks of about BLOCK members."""
    large = (open_.where(F.col("m") > SMALL)
             .withColumn("m_blocks", F.ceil(F.col("m") / BLOCK).cast("int"))
             .withColumn("q_blocks", F.ceil(F.col("queries") / BLOCK).cast("int"))
             .withColumn("h", F.xxhash64("id")))
    own_m, own_q = F.pmod("h", "m_blocks").cast("int"), F.pmod(F.xxhash64("h"), F.col("q_blocks")).cast("int")
    upto = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    as_member = large.select("key", "id", "comp", F.lit(False).alias("query"), own_m.alias("mb"), upto("q_blocks").alias("qb"))
    as_query = large.where("query").select("key", "id", "comp", "query", upto("m_blocks").alias("mb"), own_q.alias("qb"))
    cells = as_member.union(as_query.select(as_member.columns))
    filled = cells.join(texts.withColumnRenamed("doc_id", "id"), "id")
    return filled.groupBy("key", "mb", "qb").applyInPandas(_cell_links(k, percent), "u bigint, v bigint")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group, columns unchanged.

    Rows that repeat a kept id are reduced to one; rows with a null id stay.
    """
    found = near_duplicates(docs)
    dropped = found.where("NOT kept").select("doc_id").distinct()
    # The dropped ids grow with the documents, so they are joined by a shuffle at
    # every size; the first row of an id is taken in the same partitions.
    stay = docs.where(F.col("doc_id").isNotNull()).join(dropped.hint("merge"), "doc_id", "left_anti")
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))
    once = stay.select("*", first.alias("__row")).where(F.col("__row") == 1).drop("__row")
    return once.select(docs.columns).union(docs.where(F.col("doc_id").isNull()))
