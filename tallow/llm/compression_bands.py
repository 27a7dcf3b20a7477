"""Quality rules: zstandard compression bands with length-specific limits.

A text is rejected when it compresses too well (repetitive) or too badly
(incompressible). Ratios (compressed / raw UTF-8 bytes) are taken over the
whole text and over fixed chunks that cover all of it; the limits depend on the
length of the text or chunk, because zstandard's frame overhead and window make
short texts look random and long ones repetitive.

Null and empty texts have no words, fail the base rules and have ratio 0.
Rows are independent: repeated rows give repeated results, an empty table an
empty result. Columns besides the id and the text are not read.
"""

from __future__ import annotations

import functools
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallow.llm.common import WHITE, bounded_batches, per_document

SYMBOLS = "#*$%&|<>"
LEVEL = 3
CHUNK_BYTES = 4096


class Band(NamedTuple):
    """Limits for texts of fewer than ``below`` bytes."""
    below: float
    low: float
    high: float


# Natural text in 4 KB and more compresses to 0.35-0.55 at level 3; below
# about 1 KB the frame and the untrained tables cost up to a third more.
# Prose repeated within its window falls under 0.25, base64 or binary noise
# stays over 0.75.
WHOLE = (Band(256, 0.30, 1.60), Band(1024, 0.33, 0.88), Band(4096, 0.30, 0.78), Band(float("inf"), 0.25, 0.72))
# Chunks: clean ones of 4 KB measure 0.39-0.49, of 1-4 KB up to 0.58, of
# 256 bytes to 1 KB up to 0.74; base64 of these sizes 0.76, 0.77 and 0.82 or more.
CHUNK = (Band(1024, 0.33, 0.78), Band(4096, 0.30, 0.68), Band(float("inf"), 0.15, 0.65))
# A rest of fewer bytes belongs to the chunk before it.
LEAST_CHUNK = 256
# Share of a text's bytes in chunks outside CHUNK from which the text is rejected.
MAX_BAD_CHUNKS = 0.25

SCHEMA = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
          "base_failed boolean, kept boolean, whole_ratio double, min_chunk_ratio double, "
          "max_chunk_ratio double, bad_chunks double, verdict string")


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more in the text."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1]
    _, which, count = np.unique(pairs[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
    start = np.flatnonzero(count[which] > 1)
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[start + k] = True
    return int(covered.sum())


def base_metrics(text: str) -> tuple[int, int, int, int, int]:
    words = text.encode().split()
    lines = [x for x in text.split("\n") if x.strip(WHITE)]
    return (len(words), len(text) - sum(map(text.count, WHITE)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(words))


@functools.cache
def _compressor():
    import zstandard
    return zstandard.ZstdCompressor(level=LEVEL)


def chunk_bounds(size: int) -> list[int]:
    """Where the chunks of a text of ``size`` bytes begin, and its end; they cover all of it."""
    starts = list(range(0, size, CHUNK_BYTES))
    if len(starts) > 1 and size - starts[-1] < LEAST_CHUNK:
        starts.pop()
    return [*starts, size]


def ratios(raw: bytes) -> tuple[float, list[float]]:
    """Ratio of the whole text, and of each chunk (of a short text: none)."""
    if not raw:
        return 0.0, []
    z = _compressor()
    cuts = chunk_bounds(len(raw)) if len(raw) >= CHUNK_BYTES else []
    return len(z.compress(raw)) / len(raw), [len(z.compress(raw[a:b])) / (b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def band_verdict(size: int, whole: float, chunks: list[float]) -> tuple[str, float]:
    """``ok`` or the rule that rejects, and the share of bytes in chunks out of band."""
    band = next(b for b in WHOLE if size < b.below)
    cuts, bad = chunk_bounds(size), 0.0
    for r, a, b in zip(chunks, cuts, cuts[1:], strict=False):
        limits = next(c for c in CHUNK if b - a < c.below)
        bad += 0 if limits.low <= r <= limits.high else (b - a) / size
    if whole < band.low:
        return "repetitive", bad
    if whole > band.high:
        return "incompressible", bad
    return ("chunks" if bad >= MAX_BAD_CHUNKS else "ok"), bad


def judge(text: str) -> tuple:
    n_words, word_chars, symbols, dup_lines, repeats = base_metrics(text)
    failed = n_words < 50 or 100 * repeats > 50 * n_words
    raw = text.encode()
    whole, chunks = ratios(raw)
    verdict, bad = band_verdict(len(raw), whole, chunks)
    return (n_words, word_chars, symbols, dup_lines, repeats, failed, not failed and verdict == "ok",
            whole, min(chunks, default=whole), max(chunks, default=whole), bad,
            "base" if failed else verdict)


def compression_bands(df: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Metrics, ratios and verdict of each row; ``keep`` are carried along."""
    bounded_batches(df.sparkSession)
    return per_document(df, judge, SCHEMA, keep, text)


def quality_report(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: id, base metrics, ratios and verdict."""
    return compression_bands(df.select(id_col, text), [id_col], text)


def keep_quality(docs: DataFrame) -> DataFrame:
    """``docs`` without the rejected rows, columns unchanged."""
    names = docs.columns
    marked = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)],
                         F.col("`text`").alias("t"))
    judged = compression_bands(marked, marked.columns[:-1], "t")
    return judged.where("kept").select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
