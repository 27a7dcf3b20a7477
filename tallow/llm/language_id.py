"""Language ID in two levels: family first, then one-versus-one linear SVMs.

Features are hashed byte n-grams of the whole lower-cased text, square roots
of their counts scaled to unit length. Families are told apart by one linear
support vector machine per pair of families, languages within the predicted
family by one per pair of its languages. Each machine's margin becomes a
probability by a logistic curve; pairwise probabilities are averaged.

The model is fitted on a bounded sample: about EXAMPLES labelled texts in all,
as many of each language, chosen by MD5 of the id. Only the text is an input.

Null texts, and texts without a letter, are ``und`` with score 0; without any
labelled row everything is. With one learned language every other text gets it.
Repeated rows score alike; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallow.llm.common import bounded_batches, per_document, spread_key

EXAMPLES = 4000
DIMENSIONS = 4096
GRAMS = (1, 2, 3, 4)
PENALTY, STEPS = 10.0, 150
UNKNOWN = "und"
# Families of ISO 639-1 languages. A language not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "baltic": "lt lv",
    "celtic": "ga gd cy br",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz tk ky",
    "indic": "hi bn mr ne pa gu ur",
    "semitic": "ar he mt am",
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}
# Everything of ASCII but letters becomes a space.
_LETTERS = bytes(c if c > 127 or chr(c).isalpha() else 32 for c in range(256))


def family_of(lang: str) -> str:
    return _FAMILY.get(lang.lower().split("-")[0], lang)


def gram_counts(text: str) -> np.ndarray:
    """Counts of hashed byte n-grams."""
    raw = text.lower().encode().translate(_LETTERS)
    b = np.frombuffer(b" " + b" ".join(raw.split()) + b" ", np.uint8).astype(np.uint32)
    out = np.zeros(DIMENSIONS, np.int64)
    shift = np.uint32(32 - (DIMENSIONS - 1).bit_length())
    code = np.zeros(len(b), np.uint32)
    for n in GRAMS:
        if len(b) < n:
            break
        code = code[:len(b) - n + 1] * np.uint32(0x01000193) + b[n - 1:] + np.uint32(n)
        out += np.bincount((code * np.uint32(0x9E3779B1)) >> shift, minlength=DIMENSIONS)
    return out


def packed(counts: np.ndarray) -> bytes:
    """Counts as 16-bit integers, or as 32-bit ones where a very long text needs them."""
    return counts.astype("<u2" if counts.max(initial=0) < 2 ** 16 else "<u4").tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u2" if len(raw) == 2 * DIMENSIONS else "<u4")


def unit(counts: np.ndarray) -> np.ndarray:
    x = np.sqrt(counts.astype(np.float32))
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-9)


@dataclass
class Machine:
    """A linear SVM for class ``a`` (positive) against class ``b``."""
    a: str
    b: str
    weights: np.ndarray
    bias: float
    slope: float

    def probability(self, x: np.ndarray) -> float:
        """That ``x`` is of class ``a``."""
        return float(1 / (1 + np.exp(-np.clip(self.slope * (x @ self.weights + self.bias), -30, 30))))


def train(a: str, b: str, x: np.ndarray, is_a: np.ndarray) -> Machine:
    """Squared hinge loss with L2 penalty, by accelerated gradient steps."""
    y = np.where(is_a, 1.0, -1.0).astype(np.float32)
    each = np.where(is_a, 0.5 / max(1, is_a.sum()), 0.5 / max(1, (~is_a).sum())).astype(np.float32) * PENALTY
    z = np.concatenate([x, np.ones((len(x), 1), np.float32)], axis=1)
    w = velocity = np.zeros(z.shape[1], np.float32)
    step = 1 / (1 + 2 * 2 * PENALTY)  # rows have squared length 2, weights sum to PENALTY
    for k in range(STEPS):
        slack = np.maximum(0, 1 - y * (z @ velocity))
        new = velocity - step * (velocity - 2 * z.T @ (each * slack * y))
        velocity = new + k / (k + 3) * (new - w)
        w = new
    margin = y * (z @ w)
    slope = max(np.linspace(0.5, 8, 31), key=lambda s: -float((each * np.log1p(np.exp(-s * margin))).sum()) - 0.01 * s)
    return Machine(a, b, w[:-1], float(w[-1]), float(slope))


@dataclass
class Model:
    families: list[Machine]
    languages: dict[str, list[Machine]]
    members: dict[str, list[str]]

    @staticmethod
    def _best(names: list[str], machines: list[Machine], x: np.ndarray) -> tuple[str, float]:
        if len(names) == 1:
            return names[0], 1.0
        vote = dict.fromkeys(names, 0.0)
        for m in machines:
            p = m.probability(x)
            vote[m.a] += p
            vote[m.b] += 1 - p
        best = min(names, key=lambda n: (-vote[n], n))
        return best, vote[best] / (len(names) - 1)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.members or not text or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        x = unit(gram_counts(text))
        family, p = self._best(sorted(self.members), self.families, x)
        language, q = self._best(self.members[family], self.languages[family], x)
        return language, p * q


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, lang: str = "lang") -> Model:
    """Learn from labelled rows that are not held out."""
    bounded_batches(docs.sparkSession)
    labelled = docs.select("doc_id", F.col(lang).cast("string").alias("y"), "text").where(
        F.col("y").isNotNull() & ~held_out(F.col("doc_id")) & F.col("text").isNotNull())
    counts = {r["y"]: r["n"] for r in labelled.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return Model([], {}, {})
    share = max(1.0, EXAMPLES / len(counts))
    part = F.conv(F.substring(spread_key("language", F.col("doc_id")), 1, 8), 16, 10).cast("long") / F.lit(2.0 ** 32)
    rate = F.create_map(*[v for y, n in counts.items() for v in (F.lit(y), F.lit(share / n))])
    sample = labelled.where(part < rate[F.col("y")])
    rows = per_document(sample, lambda t: (packed(gram_counts(t)),), "grams binary", ["y"]).collect()
    rows.sort(key=lambda r: (r["y"], bytes(r["grams"])))  # sums of floats depend on their order
    x = unit(np.array([unpacked(r["grams"]) for r in rows]).reshape(-1, DIMENSIONS))
    y = np.array([r["y"] for r in rows])
    members: dict[str, list[str]] = {}
    for code in sorted(set(y.tolist())):
        members.setdefault(family_of(code), []).append(code)
    of_family = np.array([family_of(c) for c in y])

    def pairs(names: list[str], label: np.ndarray) -> list[Machine]:
        return [train(a, b, x[at], label[at] == a) for a, b in combinations(names, 2)
                for at in [np.flatnonzero((label == a) | (label == b))]]

    return Model(pairs(sorted(members), of_family), {f: pairs(m, y) for f, m in members.items()}, members)


def predict(df: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """``keep``, ``lang_pred`` and ``score`` of every row."""
    bounded_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)  # a few vectors of DIMENSIONS floats
    return per_document(df, lambda t: shared.value.predict(t), "lang_pred string, score double", keep, text)


def language_report(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document."""
    found = predict(docs.select("doc_id", "text"), fit(docs), ["doc_id"])
    return found.withColumn("held_out", held_out(F.col("doc_id")))
