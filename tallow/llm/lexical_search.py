"""Ranked lexical search by presence-mask grouping.

Every document is ranked for every item by an integer BM25-like score; the
best DEPTH of each item come out. Terms are the runs of ASCII letters and
digits and of all non-ASCII characters, with A-Z lower-cased.

1. One pass over the texts writes an index: per document its length and the
   frequencies of the terms that some item holds. Everything later reads the
   index only.
2. Document counts per term, of all documents, come from the index.
3. Each task walks its documents in blocks. A block has one bitmap per term;
   stacking an item's bitmaps and packing them across terms gives every
   document's presence mask over the item's terms. Documents are grouped by
   mask. A mask's maximum score is the sum of its terms' greatest impacts in the
   block; masks are evaluated from the highest maximum down until the next one
   is below the score at rank DEPTH, which the task carries from block to block.
   Equal scores rank by id, so a mask whose maximum equals that score is still
   evaluated: what is skipped cannot be in the result.
4. Each task returns at most DEPTH documents an item; these meet in salted
   groups of an item first, then by item.

Items go in batches of about ITEM_TERMS (item, term) rows, which is all that the
driver and the tasks hold of them; each batch is one run of the steps above, so
any number of items works in bounded memory.

Null or term-less texts count nowhere and are never ranked. Rows that repeat an
item id are one item with the terms of all its rows, and null item ids are one
item. Rows that repeat a document are ranked each; a null document id ranks
after the others of its score. Very long texts are one document like any other,
and very long items only have longer masks. An item without terms, or an empty
table, gives no rows. Other columns of the tables are ignored, whatever their
names.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallow.llm.common import bounded_batches, materialize
from tallow.sources.tables import delete_path

DEPTH = 50
BLOCK = 4096          # documents whose bitmaps a task holds at once
CHUNK = 256           # documents scored between two looks at the threshold
ITEM_TERMS = 20_000   # (item, term) rows of one batch of items
SALTS = 64

# Fixed values of the score.
SCALE, K_TF, K_LEN, BASE_LEN, PART_LEN = 1_000_000_000, 1000, 20, 50, 50
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# A-Z to lower case, every other ASCII character that is no letter or digit to a blank.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))

INDEX = "doc_id bigint, n bigint, terms array<int>, tfs array<int>"
HITS = "item int, doc_id bigint, score bigint"


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, in order."""
    return text.translate(_FOLD).split()


def _item_terms(items: DataFrame) -> DataFrame:
    """Distinct ``(item_id, term)``."""
    low = F.translate(F.col("text").cast("string"), UPPER, LOWER)
    return items.select(F.col("item_id").cast("long").alias("item_id"),
                        F.explode(F.regexp_extract_all(low, F.lit(TERM), F.lit(0))).alias("term")).distinct()


def _index(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Length and frequencies of ``vocabulary`` for every document that has a term."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                      F.col("text").cast("string").cast("binary").alias("text")).where("text IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.keys()
        for b in batches:
            keep, lengths, ids, tfs, ends = [], [], [], [], [0]
            for row, text in enumerate(b.column(1)):
                counts = Counter(terms_of(text.as_py()))
                if counts:
                    keep.append(row)
                    lengths.append(counts.total())
                    for w in counts.keys() & known:
                        ids.append(vocabulary[w])
                        tfs.append(counts[w])
                    ends.append(len(ids))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(keep, pa.int64())), pa.array(lengths, pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int32()))],
                names=["doc_id", "n", "terms", "tfs"])

    return src.mapInArrow(run, INDEX)


def _statistics(index: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """Documents, all their terms, and per vocabulary term the documents that hold it."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, docs, total = np.zeros(size, np.int64), 0, 0
        for b in batches:
            docs += b.num_rows
            total += int(b.column(1).to_numpy().sum())
            held += np.bincount(b.column(2).flatten().to_numpy(), minlength=size)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-1, -2], some]), pa.int32()),
                                          pa.array(np.concatenate([[docs, total], held[some]]), pa.int64())],
                                         names=["term", "n"])

    sums = dict(index.mapInArrow(partial, "term int, n bigint").groupBy("term").agg(F.sum("n")).collect())
    df = np.array([sums.get(t, 0) for t in range(size)], np.int64)
    return sums.get(-1, 0), sums.get(-2, 0), df


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    """``floor(1000 * ln((2N + 2) / (2df + 1)))``, at least 0."""
    return np.array([max(0, math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1)))) for d in df], np.int64)


class Best:
    """The DEPTH best documents of an item so far; equal scores by id, null ids last."""

    def __init__(self, depth: int):
        self.depth = depth
        self.scores = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int64)
        self.null = np.zeros(0, bool)

    def floor(self) -> int:
        """A document must score this much to come in."""
        return int(self.scores[-1]) if len(self.scores) == self.depth else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        ok = scores >= self.floor()
        scores, ids, null = (np.concatenate([a, b[ok]]) for a, b in
                             ((self.scores, scores), (self.ids, ids), (self.null, null)))
        first = np.lexsort((ids, null, -scores))[:self.depth]
        self.scores, self.ids, self.null = scores[first], ids[first], null[first]


class Block:
    """Documents of a block: postings by document, a bitmap and the greatest impact per term."""

    def __init__(self, ids, null, n, counts, terms, tfs, weight, n_docs, total):
        self.ids, self.null = ids, null
        self.starts = np.concatenate([[0], np.cumsum(counts)])
        owner = np.repeat(np.arange(len(ids)), counts)
        m = 100 - BASE_LEN + (PART_LEN * n * n_docs) // total
        self.terms = terms
        self.impact = weight[terms] * ((SCALE * tfs) // (K_TF * tfs + K_LEN * m[owner]))
        self.slot = np.full(len(weight), -1, np.int64)
        present = np.unique(terms)
        self.slot[present] = np.arange(len(present))
        self.bits = np.zeros((len(present), len(ids)), bool)
        self.bits[self.slot[terms], owner] = True
        self.most = np.zeros(len(present), np.int64)
        np.maximum.at(self.most, self.slot[terms], self.impact)

    def masks(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Documents with any of the terms, the distinct masks as bits, and each document's mask."""
        rows = self.bits[slots]
        some = np.flatnonzero(rows.any(axis=0))
        packed = np.packbits(rows[:, some], axis=0).T
        width = -packed.shape[1] % 8
        words = np.ascontiguousarray(np.pad(packed, ((0, 0), (0, width)))).view(np.uint64)
        if words.shape[1] == 1:
            distinct, of = np.unique(words[:, 0], return_inverse=True)
            distinct = distinct[:, None]
        else:
            distinct, of = np.unique(words, axis=0, return_inverse=True)
        bits = np.unpackbits(np.ascontiguousarray(distinct).view(np.uint8), axis=1)[:, :len(slots)]
        return some, bits, of.reshape(-1)

    def scores(self, docs: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Exact scores of ``docs`` over the terms marked in ``wanted``."""
        counts = self.starts[docs + 1] - self.starts[docs]
        before = np.cumsum(counts) - counts
        at = np.repeat(self.starts[docs] - before, counts) + np.arange(counts.sum())
        owner = np.repeat(np.arange(len(docs)), counts)
        hit = wanted[self.slot[self.terms[at]]]
        out = np.zeros(len(docs), np.int64)
        np.add.at(out, owner[hit], self.impact[at[hit]])
        return out

    def search(self, item_terms: np.ndarray, best: Best) -> int:
        """Bring the block's documents into ``best``; returns how many were scored."""
        slots = self.slot[item_terms]
        slots = slots[slots >= 0]
        if not len(slots):
            return 0
        some, bits, of = self.masks(slots)
        most = bits.astype(np.int64) @ self.most[slots]
        by_most = np.argsort(-most, kind="stable")
        place = np.empty(len(most), np.int64)
        place[by_most] = np.arange(len(most))
        order = np.argsort(place[of], kind="stable")
        some, ceiling = some[order], most[of[order]]
        wanted = np.zeros(len(self.bits), bool)
        wanted[slots] = True
        done = 0
        while done < len(some) and ceiling[done] >= best.floor():
            # Masks run from the highest maximum down, so the rest is cut where it falls below the floor.
            end = min(done + CHUNK, int(np.searchsorted(-ceiling, -best.floor(), side="right")))
            docs = some[done:end]
            best.add(self.scores(docs, wanted), self.ids[docs], self.null[docs])
            done = end
        return done


def _search(index: DataFrame, item_terms: list[np.ndarray], weight: np.ndarray,
            n_docs: int, total: int, depth: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(depth) for _ in item_terms]
        waiting: list[pa.RecordBatch] = []

        def flush():
            t = pa.Table.from_batches(waiting).combine_chunks()
            ids = t.column(0).combine_chunks()
            lists = t.column(2).combine_chunks()
            block = Block(ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False),
                          t.column(1).to_numpy(), lists.value_lengths().to_numpy(), lists.flatten().to_numpy(),
                          t.column(3).combine_chunks().flatten().to_numpy().astype(np.int64), weight, n_docs, total)
            for terms, b in zip(item_terms, best, strict=True):
                block.search(terms, b)
            waiting.clear()

        for b in batches:
            if b.num_rows:
                waiting.append(b)
            if sum(w.num_rows for w in waiting) >= BLOCK:
                flush()
        if waiting:
            flush()
        for i, b in enumerate(best):
            if len(b.ids):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(b.ids), i), pa.int32()), pa.array(b.ids, pa.int64(), mask=b.null),
                     pa.array(b.scores, pa.int64())], names=["item", "doc_id", "score"])

    return index.mapInArrow(run, HITS)


def _ranked(hits: DataFrame, depth: int) -> DataFrame:
    """The best ``depth`` rows of each item, through salted groups of it first."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    part = Window.partitionBy("item", "salt").orderBy(*order)
    whole = Window.partitionBy("item").orderBy(*order)
    some = (hits.withColumn("salt", F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALTS)))
            .withColumn("part_rank", F.row_number().over(part)).where(F.col("part_rank") <= depth))
    return (some.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= depth)
            .select("item", "rank", "doc_id", "score"))


def rank_documents(docs: DataFrame, items: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``item_id, rank, doc_id, score`` of the ``depth`` best documents of every item."""
    spark = docs.sparkSession
    bounded_batches(spark)
    wanted = materialize(_item_terms(items), "item_terms")
    batches = max(1, math.ceil(wanted.count() / ITEM_TERMS))
    batch_of = F.pmod(F.xxhash64("item_id"), F.lit(batches))
    out = None
    for i in range(batches):
        rows = wanted.where(batch_of == i).collect()  # about ITEM_TERMS rows
        part = _one_batch(docs, rows, depth)
        out = part if out is None else out.union(part)
    delete_path(spark, wanted._tallow_path)
    return out


def _one_batch(docs: DataFrame, rows: list, depth: int) -> DataFrame:
    spark = docs.sparkSession
    words = sorted({r["term"].encode() for r in rows})
    vocabulary = {w: i for i, w in enumerate(words)}
    by_item: dict[int | None, list[int]] = {}
    for r in rows:
        by_item.setdefault(r["item_id"], []).append(vocabulary[r["term"].encode()])
    item_ids = list(by_item)
    terms = [np.sort(np.array(by_item[i], np.int64)) for i in item_ids]
    index = materialize(_index(docs, vocabulary), "term_index")
    n_docs, total, df = _statistics(index, len(words))
    hits = _search(index, terms, weights(n_docs, df), n_docs, max(total, 1), depth)
    names = spark.createDataFrame(list(enumerate(item_ids)), "item int, item_id bigint")
    out = materialize(_ranked(hits, depth).join(names, "item").select("item_id", "rank", "doc_id", "score"), "ranked")
    delete_path(spark, index._tallow_path)
    return out


_SQL_TOKENS = f"regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')"
ORACLE_SQL = f"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, {_SQL_TOKENS} AS terms FROM documents WHERE text IS NOT NULL),
postings AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM texts) GROUP BY r, term),
sizes AS (SELECT r, doc_id, CAST(len(terms) AS BIGINT) AS n FROM texts WHERE len(terms) > 0),
total AS (SELECT CAST(count(*) AS BIGINT) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM sizes),
weighted AS (SELECT term, CAST(floor(1000 * ln((2 * big_n + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
             FROM postings, total GROUP BY term, big_n),
wanted AS (SELECT DISTINCT item_id, unnest({_SQL_TOKENS}) AS term FROM benchmark),
scores AS (SELECT i.item_id, s.doc_id, s.r,
                  CAST(sum(w * (({SCALE} * p.tf) // ({K_TF} * p.tf + {K_LEN} * (100 - {BASE_LEN}
                    + (({PART_LEN} * s.n * big_n) // big_l))))) AS BIGINT) AS score
           FROM wanted i JOIN postings p USING (term) JOIN weighted USING (term) JOIN sizes s USING (r), total
           GROUP BY i.item_id, s.doc_id, s.r)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank,
       doc_id, score
FROM scores WHERE score > 0
QUALIFY rank <= {DEPTH}"""
