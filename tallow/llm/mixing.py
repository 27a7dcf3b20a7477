"""Mix sources to target weights by exact token budgets [native].

Each document gets a hash-random key; within its source, documents run in
key order, a distributed prefix sum of their sizes gives each its interval,
and the source is cut at exactly its budget. A budget above the source's
size repeats whole epochs first.

Only DataFrame operations: the size is the number of words, the key an MD5
of the id. Sources are few (one row each in the target table); documents of
a hot source are split by key range (:func:`tallow.llm.common.prefix_sums`).

Null sources form a source of their own, ranked last; null texts have size
0. Repeated rows are documents of their own. An empty table, or one without
words, gives targets of 0 and takes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallow.llm.common import WORD, materialize, prefix_sums, ranges_for, spread_key

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS,
                   max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: ``source, source_size, target``.

    A target stops at ``max_epochs`` times the source's size and the excess is
    shared again by weight. The fixed point is a water level: with sources in
    order of cap per weight, the first k are capped, where the level that the
    rest of the total gives the rest of the weights is at most the next cap.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    per = per.withColumn("w", weight).withColumn("cap", F.lit(max_epochs) * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    # Weights are small integers held as doubles: their sums are exact.
    open_w = F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    per = per.withColumn("level", left / open_w)
    # Levels never fall while sources are capped, so the level of the first
    # source that it does not cap holds for all that follow.
    per = per.withColumn("open", F.col("cap") / F.col("w") > F.col("level"))
    level = F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("w"), "source_size", "level"))).over(everything)
    target = F.when(level.isNull() | ~F.col("open"), F.col("cap").cast("double")).otherwise(F.col("w") * level["level"])
    return per.select("source", "source_size", target.alias("target"))


def mix(df: DataFrame, size: Column, id_col: str = "doc_id", source_col: str = "source",
        keep: list[str] | None = None, weights: tuple[int, ...] = WEIGHTS,
        max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """``id, size, source, source_size, target, epochs, cut, taken`` for every row.

    ``epochs`` whole passes are taken, and of the pass that the budget ends in
    the first ``cut`` words; ``taken`` is their sum. ``keep`` are further
    columns of ``df``, carried through.
    """
    keep = keep or []
    sized = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").alias("source"),
                      size.alias("size"), *[F.col(f"`{c}`") for c in keep])
    targets = source_targets(sized.select("source", "size"), weights, max_epochs)
    keyed = sized.withColumn("__key", spread_key(seed, F.col("id")))
    joined = prefix_sums(keyed, "source", "__key", ["id", "size"], "size", "__start",
                         ranges_for(df.sparkSession), attach=targets)
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    rest = budget - epochs * F.col("source_size")
    cut = F.least(F.col("size"), F.greatest(rest - F.col("__start"), F.lit(0))).cast("long")
    return (joined.withColumn("epochs", epochs).withColumn("cut", cut)
            .withColumn("taken", (F.col("epochs") * F.col("size") + F.col("cut")).cast("long"))
            .drop("__key", "__start").withColumnRenamed("id", id_col))


def mix_report(docs: DataFrame) -> DataFrame:
    """``doc_id, size, source_size, target, taken``, plus ``epochs, cut, source``."""
    sized = materialize(docs.select("doc_id", "source", word_count(F.col("text")).alias("words")), "mix")
    return mix(sized, F.col("words"))


def mix_documents(docs: DataFrame) -> DataFrame:
    """The mixed corpus, columns unchanged: each document once per whole epoch.

    The document that its source's budget ends in keeps only the words within
    the budget, joined by single spaces, with ``n_chars`` to match. Documents
    without words count towards no budget and stay once.
    """
    names = docs.columns
    at = {c: f"c{i}" for i, c in enumerate(names)}
    src = docs.select(*[F.col(f"`{c}`").alias(a) for c, a in at.items()], "doc_id", "source", "text")
    mixed = mix(src, word_count(F.col("text")), keep=list(at.values()))
    empty = F.col("size") == 0
    whole = F.when(empty, 1).otherwise(F.col("epochs") + (F.col("cut") == F.col("size")).cast("int"))
    part = F.when(~empty & (F.col("cut") > 0) & (F.col("cut") < F.col("size")), 1).otherwise(0)
    copies = (mixed.withColumn("__whole", whole).withColumn("__copies", (whole + part).cast("int"))
              .where("__copies > 0")
              .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))))
    is_part = F.col("__copy") > F.col("__whole")
    head = F.array_join(F.slice(F.regexp_extract_all(F.col(at["text"]), F.lit(WORD), F.lit(0)),
                                F.lit(1), F.col("cut").cast("int")), " ")
    copies = copies.withColumn("__text", F.when(is_part, head).otherwise(F.col(at["text"])))
    value = {"text": F.col("__text"),
             "n_chars": F.when(is_part, F.length("__text")).otherwise(F.col(at.get("n_chars", "__whole")))}
    types = dict(docs.dtypes)
    return copies.select(*[value.get(c, F.col(a)).cast(types[c]).alias(c) for c, a in at.items()])


# The same mix in SQL: the key is an MD5, so both engines cut at the same words.
ORACLE_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size
  FROM documents),
per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w
  FROM sized GROUP BY source),
ranked AS (
  SELECT *, {MAX_EPOCHS} * source_size AS cap, ({MAX_EPOCHS} * source_size)::DOUBLE / w AS ratio FROM per),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0))::DOUBLE
            / (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS level
  FROM ranked
  WINDOW before AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
first_open AS (
  SELECT level FROM levels WHERE ratio > level ORDER BY ratio, source_size, level LIMIT 1),
targets AS (
  SELECT source, source_size,
         CASE WHEN ratio > level THEN w * (SELECT level FROM first_open) ELSE cap::DOUBLE END AS target
  FROM levels),
placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, CAST(round(t.target) AS BIGINT) AS budget, s.source,
         coalesce(sum(s.size) OVER (PARTITION BY s.source
           ORDER BY md5('{SEED}:' || coalesce(CAST(s.doc_id AS VARCHAR), 'null')), s.doc_id, s.size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
cut AS (
  SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM placed)
SELECT doc_id, source, size, source_size, target, CAST(epochs AS BIGINT) AS epochs,
       CAST(least(size, greatest(budget - epochs * source_size - start, 0)) AS BIGINT) AS cut,
       CAST(epochs * size + least(size, greatest(budget - epochs * source_size - start, 0)) AS BIGINT) AS taken
FROM cut
"""
