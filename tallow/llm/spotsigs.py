"""SpotSigs document fingerprints and their likeness [native].

A spot signature is a common word (the anchor) with the CHAIN content words
that follow it, common words in between skipped. A document's fingerprint is
the set of its spot signatures; likeness is the Jaccard similarity of two sets.
Boilerplate has few common words and so few signatures; prose has many.

Everything is DataFrame and SQL functions. The text is normalised to words
parted by single spaces; of anchors in a row only the last stays, so one split
before each anchor gives pieces ``anchor content content ...``; a piece with
fewer than CHAIN content words is completed from the next one. After every RUN
content words without an anchor a START is set, which opens a new chain: texts
in languages without known anchors, code and lists have signatures all along.

Defined cases: the start of the text counts as an anchor, so that every text
with a word has a signature; a chain at the end of the text may be shorter.
Null, empty and wordless texts have the empty set; two empty sets have
likeness 1, an empty and a non-empty one 0. Rows with equal ids are ordered by
their texts; null ids come first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallow.llm.common import materialize

CHAIN, RUN = 2, 4
THRESHOLD = 0.8
# The anchors, common words of English, German, French and
# Spanish, and the bar that opens a table cell.
ANCHORS = (
    "the a an of and to in is that it for on with as was be by this are at from or "
    "der die das und ist von zu mit den im ein eine auf nicht sich des dem er sie "
    "le la les des et en un une est que du pour dans qui sur au par avec ce "
    "el los las de y que se del por con una para es su lo no al |").split()
START = "^"


def trie_pattern(words: list[str]) -> str:
    """A regular expression for any of ``words`` that tries each letter once."""
    def build(ws: list[str]) -> str:
        heads: dict[str, list[str]] = {}
        for w in ws:
            if w:
                heads.setdefault(w[0], []).append(w[1:])
        def quote(c: str) -> str:
            return c if c.isalnum() else "\\" + c
        parts = [quote(c) + build(rest) for c, rest in sorted(heads.items())]
        if not parts:
            return ""
        body = parts[0] if len(parts) == 1 and "" not in ws else "(?:" + "|".join(parts) + ")"
        return body + "?" if "" in ws else body
    return build(sorted(set(words)))


_ANCHOR = trie_pattern([*ANCHORS, START])


def with_signatures(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``: the sorted array of distinct signature hashes of column ``text``."""
    words = F.trim(F.regexp_replace(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}|]+", " "))
    spaced = F.concat(F.lit(START + " "), F.col("__words"))
    # Of anchors in a row the look-ahead lets all but the last go.
    single = F.regexp_replace(spaced, rf"(?<![^ ])(?:{_ANCHOR}) (?=(?:{_ANCHOR})(?: |$))", "")
    content = rf"(?!(?:{_ANCHOR})(?: |$))"
    started = F.regexp_replace(single, rf"(?<![^ ])((?:{content}[^ ]++ ){{{RUN}}}){content}", f"$1{START} ")
    pieces = F.split(started, rf" (?=(?:{_ANCHOR})(?: |$))")

    def signature(piece: Column, following: Column) -> Column:
        # The next piece's content words complete a chain that its anchor cuts short.
        rest = F.when(F.instr(following, " ") > 0, F.concat(F.lit(" "), F.substr(following, F.instr(following, " ") + 1)))
        return F.xxhash64(F.substring_index(F.concat(piece, F.coalesce(rest, F.lit(""))), " ", CHAIN + 1))

    following = F.slice("__pieces", F.lit(2), F.size("__pieces"))
    sigs = F.array_sort(F.array_distinct(F.zip_with("__pieces", following, signature)))
    return (df.withColumn("__words", words).withColumn("__pieces", pieces)
            .withColumn(out, F.when(F.col("__words") == "", F.array().cast("array<bigint>")).otherwise(sigs))
            .drop("__words", "__pieces"))


def digest(sigs: Column) -> Column:
    """The fingerprint as one string: SHA-256 over the sorted signatures."""
    return F.sha2(F.array_join(sigs.cast("array<string>"), ","), 256)


def length_partition(size: Column, threshold: float = THRESHOLD) -> Column:
    """Sets as similar as ``threshold`` lie in the same or in neighbouring partitions."""
    return F.floor(F.log(F.greatest(size, F.lit(1))) / -F.log(F.lit(threshold)) + 1e-9).cast("int")


def likeness(a: Column, b: Column, floor: float = 0.0) -> Column:
    """Jaccard similarity of two arrays of distinct signatures, 0 where set sizes rule out ``floor``."""
    few, many = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    common = F.size(F.array_intersect(a, b))
    return (F.when(many == 0, 1.0).when((few == 0) | (few < floor * many), 0.0)
            .otherwise(common / (few + many - common)).cast("double"))


def similar_documents(df: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Similar pairs ``(a, b, likeness)`` of class representatives, and ``(doc_id, representative)``.

    Equal fingerprints form a class. Signatures are ordered by how few classes
    hold them; two sets as similar as the threshold share one of the first
    ``n - ceil(threshold * n) + 1`` of that order, so only those are joined on,
    within length partitions, and the exact likeness is taken of what meets.
    """
    sigs = materialize(with_signatures(df.select("doc_id", "text"), "text", "sigs")
                       .withColumn("fingerprint", digest(F.col("sigs"))).select("doc_id", "sigs", "fingerprint"), "spotsigs")
    classes = materialize(sigs.where(F.size("sigs") > 0).groupBy("fingerprint").agg(
        F.min("doc_id").alias("id"), F.first("sigs").alias("sigs")), "spotsig_classes")
    one = classes.select("id", F.size("sigs").alias("n"), F.explode("sigs").alias("sig"))
    ranked = one.join(one.groupBy("sig").agg(F.count("*").alias("df")), "sig").withColumn(
        "rank", F.row_number().over(Window.partitionBy("id").orderBy("df", "sig")))
    prefix = (ranked.where("df > 1").where(F.col("rank") <= F.col("n") - F.ceil(threshold * F.col("n") - 1e-9) + 1)
              .withColumn("part", length_partition(F.col("n"), threshold)))
    left = prefix.select("sig", F.explode(F.array("part", F.col("part") + 1)).alias("part"), F.col("id").alias("a"), F.col("n").alias("n_a"))
    right = prefix.select("sig", "part", F.col("id").alias("b"), F.col("n").alias("n_b"))
    meet = (left.join(right, ["part", "sig"])
            .where((F.struct("n_a", "a") < F.struct("n_b", "b")) & (F.col("n_a") >= threshold * F.col("n_b")))
            .select("a", "b").distinct())
    sets = classes.select("id", "sigs")
    pairs = (meet.join(sets.select(F.col("id").alias("a"), F.col("sigs").alias("x")), "a")
             .join(sets.select(F.col("id").alias("b"), F.col("sigs").alias("y")), "b")
             .withColumn("likeness", likeness(F.col("x"), F.col("y"), threshold))
             .where(F.col("likeness") >= threshold).select("a", "b", "likeness"))
    member = sigs.join(classes.select("fingerprint", "id"), "fingerprint", "left").select(
        "doc_id", F.coalesce("id", "doc_id").alias("representative"))
    return pairs, member


def with_next(docs: DataFrame) -> tuple[DataFrame, Window]:
    """``doc_id, text, bucket, order, stop``: documents in id ranges, each range
    closed by a copy of the document that follows it (``stop``), and the window
    whose ``lead`` is the next document; the first follows the last.

    The bounds are quantiles, one range per shuffle partition, so a range has
    about as many documents as any other however ids are spread.
    """
    spark = docs.sparkSession
    order = F.coalesce(F.col("doc_id").cast("long"), F.lit(-2 ** 63))  # null ids first
    keyed = docs.select("doc_id", "text", order.alias("order"))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = keyed.agg(F.percentile_approx("order", [i / ranges for i in range(1, ranges)] or [0.5], 100 * ranges)).first()[0]
    bounds = F.array(*[F.lit(c) for c in sorted(set(cuts or []))]).cast("array<bigint>")
    ranged = keyed.withColumn("bucket", F.size(F.filter(bounds, lambda b: b <= F.col("order"))))
    # One row per range, of which there are as many as shuffle partitions.
    firsts = sorted(tuple(r) for r in ranged.groupBy("bucket").agg(F.min("order")).collect())
    closing = [(first, firsts[i - 1][0]) for i, (_, first) in enumerate(firsts)]
    stops = spark.createDataFrame(closing, "order bigint, bucket int")
    copies = keyed.join(F.broadcast(stops), "order").select("doc_id", "text", "order", "bucket", F.lit(True).alias("stop"))
    every = ranged.withColumn("stop", F.lit(False)).select(copies.columns).union(copies)
    return every, Window.partitionBy("bucket").orderBy("stop", "order", "text")


def fingerprint_report(docs: DataFrame) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and likenesses.

    The edited text has its last quarter replaced by the beginning of the next
    document. One shuffle brings neighbours together; signatures are made after it.
    """
    every, neighbours = with_next(docs)
    every = every.withColumn("text", F.coalesce("text", F.lit("")))
    paired = every.withColumn("next_text", F.lead("text").over(neighbours))
    signed = with_signatures(paired, "text", "sigs").withColumn("next_sigs", F.lead("sigs").over(neighbours)).where("NOT stop")
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), (F.col("n_chars") - cut).cast("int")), F.substr("next_text", F.lit(1), cut))
    signed = signed.withColumn("n_chars", F.length("text").cast("long")).withColumn("edited", edited)
    both = with_signatures(signed, "edited", "edited_sigs")
    return both.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                       digest(F.col("sigs")).alias("fingerprint"), digest(F.col("edited_sigs")).alias("edited_fingerprint"),
                       likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"),
                       likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"))
