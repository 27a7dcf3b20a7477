"""Toxicity by nearest labelled examples: exact TF-IDF cosine, block-max index.

Fit (on a bounded sample of labelled rows, :data:`MAX_EXAMPLES`): Spark counts
in how many toxic and other examples each term occurs; every term counts, with
its idf and, as a weight, its chi-square with the label, at every size of the
label set. Terms are words and their beginnings of 4 to 7 letters, so an
inflected form that no example has still meets its stem.

The term table and the examples are tables in the shared folder; one task makes
the index of these at most MAX_EXAMPLES rows and writes its arrays as files. Tasks
map them into memory, so the workers of a machine share one copy, whose pages the
system can drop. The calibration is taken in tasks, too.

Search: the examples are ordered so that alike ones are neighbours, and cut into
blocks of equal size. Alike texts meet some blocks at a time in a matrix product of
the terms that enough of both have; the postings of other terms are read. When texts are few, bounds spare
some of that: for each frequent term and block the index holds the largest weight, so what the terms
not yet scored can add is known beforehand. Only examples that can reach the
k best are compared by their whole vectors. The result is the exact k nearest,
ties to the lower example number.

Score: votes weighted by squared cosine, shrunk to the share of toxic examples
(of those without any term, if there are any), then calibrated by isotonic regression over
leave-one-out votes. The neighbours are returned as evidence.

Null and empty texts, and texts without vocabulary terms, get that share
calibrated; without any labelled rows every score is 0. Repeated rows score
alike; ids are never an input.
"""

from __future__ import annotations

import functools
import math
import os
import tempfile
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallow.llm.common import (bounded_batches, drop_table, filesystem, materialize, new_file, per_batch, read_shared,
                               shared_batches, shared_folder, spread_key)

# The examples: so many labelled rows at most, those with the lowest MD5 keys.
MAX_EXAMPLES = 20_000
STEMS = (4, 5, 6, 7)
NEIGHBOURS = 15
BLOCK = 256
# A term's weight is its idf times this and its chi-square with the label, so
# that terms tied to the label lead and every term counts.
PLAIN_WEIGHT = 0.5
# Terms of so many examples have block peaks; others are always scored.
OFTEN = 64
FIRST_TERMS, GROWTH = 128, 8
# Terms of this share of the examples are held as a matrix. So many queries meet
# so many examples, which lie one after another, in a matrix product.
HEAD_SHARE, QUERIES, PART, SLACK = 0.08, 256, 1024, 2e-5
# So many examples at most are compared by their whole vectors before all terms are scored.
MAX_NEAR = 24
# Reading a posting takes as long as so many products of a query and an example, and
# as writing so many values of a column. So many columns are held at a time.
PRODUCT, COPIED, COLUMNS = 600, 50, 512
# Postings written at a time.
SCAN = 1 << 15
# Alike examples share blocks: each goes to the nearest of so many of them.
SEEDS = 64
# Texts scored at a time.
TEXTS = 2048
# Text whose terms are counted at a time.
CHUNK_BYTES = 4 << 20
EXAMPLE_ROWS = 1024
# Arrays in files of fewer bytes are read, not mapped.
MAPPED = 1 << 16
# A vote of this weight goes to the base share, so that one faint neighbour
# does not decide alone.
PRIOR_WEIGHT = 0.05
MAX_CALIBRATION = 2_000

SCHEMA = "score double, predicted int, evidence_ids array<bigint>, evidence_similarity array<double>"
_TO_SPACE = bytes.maketrans(bytes(range(33, 48)) + bytes(range(58, 65)) + bytes(range(91, 97)) + bytes(range(123, 127)),
                            b" " * 32)


def terms_of(word: bytes) -> list[str]:
    """The word and its beginnings: what :class:`Terms` counts."""
    w = word.decode()
    return [w, *[w[:n] + "~" for n in STEMS if len(w) >= n]]


class Terms:
    """Counts the terms of texts, those of some texts at once.

    A term is its position in the sorted ``keys``, terms not in it are left out;
    without ``keys`` it is its :func:`term_key`. ``known`` are the words of the last
    texts, as arrays: their keys, ascending, and where each word's terms begin and end
    in a third.
    """

    def __init__(self, keys: np.ndarray | None = None):
        self.keys, self.known = keys, []

    def counts(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text its distinct terms, ascending, and their counts."""
        out: list[tuple[np.ndarray, np.ndarray]] = []
        some: list[bytes] = []
        size = 0
        for text in texts:
            some.append(text.lower().encode().translate(_TO_SPACE))
            size += len(some[-1])
            if size >= CHUNK_BYTES:
                out += self._counts(some)
                some, size = [], 0
        return out + self._counts(some) if some else out

    def _counts(self, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        parts = pc.ascii_split_whitespace(pa.array(texts, pa.large_binary()).view(pa.large_string()))
        coded, n = parts.flatten().dictionary_encode(), np.diff(parts.offsets.to_numpy())
        del parts
        words = coded.dictionary
        begin, end, terms = self._terms(words)
        # Each text's distinct words, and how often it has them.
        word, times = _counted(np.repeat(np.arange(len(texts)), n) * len(words) + coded.indices.to_numpy())
        text, word = np.divmod(word, max(1, len(words)))
        at, n = begin[word], end[word] - begin[word]
        text, times, term = np.repeat(text, n), np.repeat(times, n), terms[_positions(at, n)]
        if self.keys is None:
            names, term = np.unique(term, return_inverse=True)
        width = max(1, len(names) if self.keys is None else len(self.keys))
        key = text * width + term
        order = np.argsort(key)
        key, times = key[order], times[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        counts = np.add.reduceat(times, first) if len(first) else times
        text, term = np.divmod(key[first], width)
        if self.keys is None:
            term = names[term]
        cuts = np.searchsorted(text, np.arange(len(texts) + 1)).tolist()
        return [(term[i:j], counts[i:j]) for i, j in zip(cuts, cuts[1:], strict=False)]

    def _terms(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the terms of each of the distinct words begin and end in an array, and this."""
        own = term_keys(words.to_numpy(zero_copy_only=False))
        begin, end, terms = np.zeros(len(own), np.int64), np.zeros(len(own), np.int64), np.zeros(0, np.int64)
        new = np.ones(len(own), bool)
        if self.known:
            keys, *where, terms = self.known
            at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
            new = keys[at] != own
            begin, end = (x[at] for x in where)
        fresh = words.filter(pa.array(new))
        length = pc.utf8_length(fresh).to_numpy()
        owner, found = [np.flatnonzero(length)], [own[new][length > 0]]  # white space at a text's ends leaves an empty word
        for n in STEMS:
            long = length >= n
            stems = pc.utf8_slice_codeunits(fresh.filter(pa.array(long)), 0, n).dictionary_encode()
            keys = term_keys(stems.dictionary.to_numpy(zero_copy_only=False) + "~")
            owner.append(np.flatnonzero(long))
            found.append(keys[stems.indices.to_numpy()])
        owner, found = np.concatenate(owner), np.concatenate(found)
        if self.keys is not None:
            order = np.argsort(found)  # neighbours are looked up one after another
            owner, found = owner[order], found[order]
            at = np.searchsorted(self.keys, found)
            hit = at < len(self.keys)
            hit[hit] = self.keys[at[hit]] == found[hit]
            owner, found = owner[hit], at[hit]
        order, n = np.argsort(owner, kind="stable"), np.bincount(owner, minlength=len(fresh))
        end[new] = len(terms) + np.cumsum(n)
        begin[new] = end[new] - n
        terms = np.concatenate([terms, found[order]])
        if len(own):  # keep this text's words alone
            order, n = np.argsort(own), end - begin
            begin, n = begin[order], n[order]
            kept = np.cumsum(n)
            self.known = [own[order], kept - n, kept, terms[_positions(begin, n)]]
            back = np.empty(len(own), np.int64)
            back[order] = np.arange(len(own))
            begin, end, terms = self.known[1][back], self.known[2][back], self.known[3]
        return begin, end, terms


def _counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values, ascending, and how many there are of each."""
    values = np.sort(values)
    begin = np.flatnonzero(np.diff(values, prepend=-1))
    return values[begin], np.diff(begin, append=len(values))


def _positions(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The positions of runs that begin at ``begin`` and have ``size`` values, end to end."""
    ends = np.cumsum(size)
    return np.repeat(begin - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)


def _row_and_weight(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows and weights of some of :attr:`Index.pairs`."""
    return pairs.view("<u4")[1::2], pairs.view("<f4")[::2]


def _cut(values: np.ndarray, most: int) -> list[np.ndarray]:
    """The values, so many at a time."""
    return [values[i:i + most] for i in range(0, len(values), most)]


def _runs(chosen: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The runs of chosen cells of each row, without those that hold nothing.

    Cell ``[r, p]`` holds ``cuts[r, p]`` to ``cuts[r, p + 1]``. Where the runs begin and
    end, and where those of each row begin among them.
    """
    edge = np.diff(chosen.astype(np.int8), prepend=0, append=0, axis=1)
    row, at = np.nonzero(edge == 1)
    begin, end = cuts[row, at], cuts[np.nonzero(edge == -1)]
    row, begin, end = (x[begin < end] for x in (row, begin, end))
    return begin, end, np.searchsorted(row, np.arange(len(chosen) + 1))


class Index:
    """A block-max inverted index over unit vectors, and the vectors themselves.

    Examples are numbered as given; inside, ``number[r]`` is the number of the
    one in row r, rows being ordered so that alike examples share blocks. Term
    t has the key ``keys[t]``, its rows in ``postings[start[t]:start[t + 1]]`` and its weight in each,
    to single precision, beside them in ``weights``; the example of row r is
    ``terms/own_levels[first[r]:first[r + 1]]``. A level is a count c, of weight
    ``(1 + log(c)) * idf / norm``. ``peak[slot[t], b]`` is the largest weight of a
    frequent term in block b, and ``cuts[slot[t], p]`` is where its postings of part p
    begin, a part being PART rows. Term ``same[t]`` has the same weights in the same
    rows as t, as a long word and its beginnings often have.
    """

    # What an index is made of; :meth:`mapped` has these as files.
    ARRAYS = ("keys", "idf", "ids", "toxic", "base", "log_tf", "df", "in_head", "column", "number", "row", "first", "terms",
              "own_levels", "start", "norm", "postings", "slot", "peak", "cuts", "same", "pairs", "matrix")

    def __init__(self, keys: np.ndarray, idf: np.ndarray, ids: np.ndarray, toxic: np.ndarray,
                 sizes: np.ndarray, vectors: list[np.ndarray]):
        """Examples whose ``sizes`` ascending terms and their counts lie one after another.

        ``vectors`` are these terms and counts. The list is emptied, so that they
        are not held beside the index that is made of them.
        """
        (terms, counts), n = vectors, len(ids)
        vectors.clear()
        self.keys, self.idf, self.ids, self.toxic = keys, idf, ids, toxic
        empty, most = sizes == 0, int(counts.max(initial=0))
        self.base = float(toxic[empty].mean()) if empty.any() else float(toxic.mean()) if n else 0.0
        self.log_tf = np.concatenate([[0.0], 1 + np.log(np.arange(1, most + 1))])
        self.df = np.bincount(terms, minlength=len(idf))
        self.in_head = self.df >= max(OFTEN, HEAD_SHARE * n)
        self.column = np.cumsum(self.in_head) - 1
        self.number = self._order(sizes, terms, counts)
        self.row = np.argsort(self.number)
        begin = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        sizes = sizes[self.number]
        self.first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.terms = np.empty(len(terms), np.int32)
        self.own_levels = np.empty(len(terms), np.uint16 if most < 2 ** 16 else np.uint32)
        for r, (at, size) in enumerate(zip(begin[self.number].tolist(), sizes.tolist(), strict=True)):
            to = slice(self.first[r], self.first[r + 1])
            self.terms[to], self.own_levels[to] = terms[at:at + size], counts[at:at + size]
        del terms, counts
        self._postings(n, sizes)

    def _order(self, sizes: np.ndarray, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Example numbers by the seed that is nearest by frequent terms; alike seeds follow each other."""
        n = len(sizes)
        seeds = np.unique(np.linspace(0, n - 1, min(n, SEEDS)).astype(int)) if n else []
        begin = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        by_column = np.zeros((int(self.in_head.sum()), len(seeds)), np.float32)

        def frequent(e: int) -> tuple[np.ndarray, np.ndarray]:
            at = slice(begin[e], begin[e + 1])
            some = np.flatnonzero(self.in_head[terms[at]])
            t, c = terms[at][some], counts[at][some]
            return self.column[t], self.log_tf[c] * self.idf[t]

        for i, e in enumerate(seeds):
            columns, w = frequent(e)
            by_column[columns, i] = w / max(math.sqrt(float(w @ w)), 1e-9)
        alike, left = by_column.T @ by_column, list(range(1, len(seeds)))
        chain = [0] if n else []
        while left:
            chain.append(left.pop(int(np.argmax(alike[chain[-1], left]))))
        by_column = by_column[:, chain]
        nearest = np.zeros(n, np.int64)
        for e in range(n):
            columns, w = frequent(e)
            nearest[e] = np.argmax(w @ by_column[columns])
        return np.argsort(nearest, kind="stable")

    def _postings(self, n: int, sizes: np.ndarray) -> None:
        self.start = np.concatenate([[0], np.cumsum(self.df)]).astype(np.int64)
        self.norm, fill = np.zeros(n), self.start[:-1].copy()
        self.postings = np.empty(len(self.terms), np.uint16 if n < 2 ** 16 else np.int64)
        self.weights = np.empty(len(self.terms), np.float32)
        for r in range(0, n, BLOCK):  # some examples at a time: no second copy is held
            at = slice(self.first[r], self.first[min(n, r + BLOCK)])
            row, t = np.repeat(np.arange(r, min(n, r + BLOCK)), sizes[r:r + BLOCK]), self.terms[at]
            w = self.log_tf[self.own_levels[at]] * self.idf[t]
            norm = np.sqrt(np.bincount(row - r, w ** 2, min(n - r, BLOCK)))
            norm[norm == 0] = 1
            self.norm[r:r + BLOCK] = norm
            order = np.argsort(t, kind="stable")
            found, begin, runs = np.unique(t[order], return_index=True, return_counts=True)
            to = np.repeat(fill[found] - begin, runs) + np.arange(len(order))
            self.postings[to], self.weights[to] = row[order], (w / norm[row - r])[order]
            fill[found] += runs
        often = np.flatnonzero(self.df >= OFTEN)
        self.slot = np.full(len(self.idf), -1, np.int32)
        self.slot[often] = np.arange(len(often))
        self.peak = np.zeros((len(often), max(1, -(-n // BLOCK))), np.float32)
        parts = [*range(0, n, PART), n]
        self.cuts = np.empty((len(often), len(parts)), np.int64)
        for i, t in enumerate(often.tolist()):
            at = slice(self.start[t], self.start[t + 1])
            rows = self.postings[at].astype(np.int64)  # ascending, so a block's are together
            begin = np.flatnonzero(np.diff(rows // BLOCK, prepend=-1))
            self.cuts[i] = self.start[t] + np.searchsorted(rows, parts)
            # Rounded up, so that single precision stays a bound.
            self.peak[i, rows[begin] // BLOCK] = np.maximum.reduceat(self.weights[at], begin) * (1 + 1e-6)

        self.same = self._same(n)

    def _same(self, n: int) -> np.ndarray:
        """For each term the first with the same postings and weights."""
        mark, code = np.random.RandomState(0).randint(2 ** 63, size=n).astype(np.uint64), np.zeros(len(self.df), np.uint64)
        for terms in self._term_ranges(np.arange(len(self.df))):
            at = slice(self.start[terms[0]], self.start[terms[-1] + 1])
            x = mark[self.postings[at]] * (self.weights[at].view(np.uint32).astype(np.uint64) * np.uint64(2) + np.uint64(1))
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x)])
            code[terms] = np.diff(sums[self.start[terms[0]:terms[-1] + 2] - at.start])
        order = np.lexsort((code, self.df))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(self.df[order]) != 0) | (code[order[1:]] != code[order[:-1]])
        # Equal sums are a hint only: what they point at is compared.
        for some in self._term_ranges(np.flatnonzero(~new), order):
            df = self.df[order[some]]
            a, b = (_positions(self.start[order[i]], df) for i in (some, some - 1))
            differ = (self.postings[a] != self.postings[b]) | (self.weights[a] != self.weights[b])
            new[np.repeat(some, df)[differ]] = True
        out = np.empty(len(order), np.int32)
        out[order] = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))] if len(order) else order
        return out

    def _term_ranges(self, some: np.ndarray, of: np.ndarray | None = None) -> list[np.ndarray]:
        """The terms ``some``, or ``of[some]``, in ranges that have about SCAN * 16 postings."""
        ends = np.cumsum(self.df[some if of is None else of[some]])
        return [x for x in np.split(some, np.flatnonzero(np.diff(ends // (16 * SCAN))) + 1) if len(x)]

    def write(self, folder: str) -> list[str]:
        """Write the arrays to the shared folder; the names of their files, in the order of ARRAYS."""
        names = []
        for a in self.ARRAYS:
            names.append(new_file(folder, a, ".npy"))
            fs, p = filesystem(names[-1])
            with fs.open_output_stream(p) as out:
                if a in ("matrix", "pairs"):  # bit by bit: they are as large as all postings
                    kind, shape = ("<f4", (int(self.in_head.sum()), len(self.ids))) if a == "matrix" else ("<u8", self.postings.shape)
                    np.lib.format.write_array_header_1_0(out, {"descr": kind, "fortran_order": False, "shape": shape})
                    for some in self._matrix_rows() if a == "matrix" else self._some_pairs():
                        out.write(some.astype(kind).tobytes())
                else:
                    np.save(out, np.asarray(getattr(self, a)))
        return names

    @classmethod
    def mapped(cls, names: list[str]) -> Index:
        """The index that :meth:`write` wrote, its arrays mapped into memory."""
        index = cls.__new__(cls)
        for a, name in zip(cls.ARRAYS, names, strict=True):
            setattr(index, a, _mapped(name))
        index.base = float(index.base)
        return index

    def vector(self, counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        t = np.fromiter(sorted(counts), np.int64, len(counts))
        return self.unit(t, np.array([counts[i] for i in t.tolist()], np.int64))

    def unit(self, t: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The unit vector of terms ``t`` that occur ``c`` times."""
        w = (1 + np.log(c)) * self.idf[t]
        norm = math.sqrt(float(w @ w))
        return (t, w / norm) if norm else (t[:0], w[:0])

    def own(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """The unit vector of an example."""
        at = slice(self.first[self.row[number]], self.first[self.row[number] + 1])
        return self.unit(self.terms[at].astype(np.int64), self.own_levels[at].astype(np.int64))

    def nearest(self, t: np.ndarray, w: np.ndarray, k: int, without: int = -1,
                head: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and cosines of the exact k nearest examples with a cosine over 0.

        ``head`` is what :meth:`heads` gives for the query. Rare terms are
        scored at once, the others in falling order of what they can add. As no
        weight is negative, the k-th best so far is a bound of the k-th cosine; what
        is left can add no more to an example than its block's peaks. When few
        examples can reach the k-th, their whole vectors decide.
        """
        n = len(self.ids)
        if not len(t) or not n:
            return np.zeros(0, np.int64), np.zeros(0)
        head, left = head or next(self.heads([(t, w)]))
        without = int(self.row[without]) if 0 <= without < n else -1
        slot = self.slot[t]
        often = np.flatnonzero(left & (slot >= 0))
        adds = w[often, None].astype(np.float32) * self.peak[slot[often]]
        order = np.argsort(-adds.max(axis=1, initial=0), kind="stable")
        often, adds = often[order], adds[order]
        now, done = np.concatenate([np.flatnonzero(left & (slot < 0)), often[:FIRST_TERMS]]), FIRST_TERMS
        part, near = head + self._added(t[now], w[now]) if len(now) else head, None
        if without >= 0:
            part[without] = -np.inf
        while True:
            have = part if near is None else part[near]
            # Sums in single precision may differ in their last digits.
            least = np.partition(have, len(have) - k)[len(have) - k] - SLACK if len(have) > k else -SLACK
            need = least - adds[done:].sum(axis=0)  # what an example of each block has to have by now
            near = np.flatnonzero(part >= np.repeat(need, BLOCK)[:n]) if near is None else near[have >= need[self.block[near]]]
            if len(near) <= MAX_NEAR or done >= len(often):
                break
            more = often[done:GROWTH * done]
            part += self._added(t[more], w[more])
            done *= GROWTH
        if done >= len(often):  # all is scored: an example without a term of the query has nothing
            near = near[part[near] > 0]
        near = near[near != without]
        sims = np.round(self._whole(near, t, w * self.idf[t]), 9)
        found = self.number[near]
        found, sims = found[sims > 0], sims[sims > 0]
        if len(found) > k:  # the k-th value and all ties with it
            best = sims >= np.partition(sims, -k)[-k]
            found, sims = found[best], sims[best]
        best = np.lexsort((found, -sims))[:k]
        return found[best], sims[best]

    def heads(self, vectors: list[tuple[np.ndarray, np.ndarray]], rest: bool = False):
        """For each vector what some of its terms add to each cosine, and which terms are left.

        These are terms that are in so many of the vectors, and of the examples of
        some part, that a matrix product takes less than reading their postings for each
        vector. In the parts where it would not, their postings are read. With ``rest`` so
        are those of all other terms, none is left, and terms of the same postings count as one.
        """
        m, sizes = len(vectors), [len(t) for t, _ in vectors]
        terms, weight = np.concatenate([t for t, _ in vectors]), np.concatenate([w for _, w in vectors]).astype(np.float32)
        owner = np.repeat(np.arange(m), sizes)
        if rest and len(terms):
            key = owner * len(self.same) + self.same[terms]
            order = np.argsort(key)
            key = key[order]
            first = np.flatnonzero(np.diff(key, prepend=-1))
            weight = np.add.reduceat(weight[order], first)
            owner, terms = np.divmod(key[first], len(self.same))
        slot, left = self.slot[terms], np.ones(len(terms), bool)
        often, times = _counted(slot[slot >= 0])
        cuts, in_head = self.cuts[often], self.in_head[self.often[often]]
        rows = np.diff(np.append(np.arange(0, len(self.ids), PART), len(self.ids)))
        # The postings of a term that has no column yet are read once to make it.
        product = (times - ~in_head)[:, None] * np.diff(cuts) > (m / PRODUCT + 1 / COPIED) * rows
        shared = np.flatnonzero(product.any(axis=1))
        often, cuts, in_head, product = often[shared], cuts[shared], in_head[shared], product[shared]
        out, runs = np.zeros((m, len(self.ids)), np.float32), []
        if len(often):
            column = np.minimum(np.searchsorted(often, slot), len(often) - 1)
            hit = np.flatnonzero(often[column] == slot)
            left[hit] = False
            column = column[hit]
            asked = np.zeros((len(often), m), np.float32)
            asked[column, owner[hit]] = weight[hit]
            for p, size in enumerate(rows.tolist()):
                for some in _cut(np.flatnonzero(product[:, p]), COLUMNS):
                    out[:, p * PART:p * PART + size] += asked[some].T @ self._columns(often[some], in_head[some], p, size)
            begin, end, first = _runs(~product, cuts)
            n = first[column + 1] - first[column]
            run = _positions(first[column], n)
            runs.append((np.repeat(owner[hit], n), begin[run], end[run] - begin[run], np.repeat(weight[hit], n)))
        if rest:
            runs.append((owner[left], self.start[terms[left]], self.df[terms[left]], weight[left]))
            left[:] = False
        if runs:
            owner, begin, size, weight = map(np.concatenate, zip(*runs, strict=True))
            order = np.argsort(owner.astype(np.min_scalar_type(m)), kind="stable")
            begin, size, weight = begin[order], size[order], weight[order]
            ends = np.cumsum(np.bincount(owner, minlength=m)).tolist()
            for i, (lo, hi) in enumerate(zip([0, *ends], ends, strict=False)):
                out[i] += self._read(begin[lo:hi], size[lo:hi], weight[lo:hi])
        end = 0
        for row, size in zip(out, sizes, strict=True):
            yield row, np.zeros(size, bool) if rest else left[end:(end := end + size)]

    def _columns(self, slots: np.ndarray, in_head: np.ndarray, part: int, size: int) -> np.ndarray:
        """The weights of frequent terms in the examples of a part."""
        out = np.zeros((len(slots), size), np.float32)
        out[in_head] = self.matrix[self.column[self.often[slots[in_head]]], part * PART:part * PART + size]
        made = np.flatnonzero(~in_head)
        begin, end = self.cuts[slots[made], part], self.cuts[slots[made], part + 1]
        at = _positions(begin, end - begin)
        row, weight = _row_and_weight(self.pairs.take(at))
        out.reshape(-1)[np.repeat(made * size - part * PART, end - begin) + row] = weight
        return out

    @functools.cached_property
    def often(self) -> np.ndarray:
        """The frequent terms: that of each slot."""
        return np.flatnonzero(self.slot >= 0)

    def _asked_heads(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        asked = np.zeros((len(vectors), len(self.matrix)), np.float32)
        for i, (t, w) in enumerate(vectors):
            at = self.in_head[t]
            asked[i, self.column[t[at]]] = w[at]
        return asked

    def _groups(self, vectors: list):
        """The positions of the vectors, in groups of QUERIES that are alike by frequent terms."""
        asked, left = self._asked_heads(vectors), np.arange(len(vectors))
        while len(left):
            order = np.argsort(-(asked[left] @ asked[left[0]]), kind="stable")
            yield left[order[:QUERIES]].tolist()
            left = left[np.sort(order[QUERIES:])]

    @functools.cached_property
    def pairs(self) -> np.ndarray:
        """Each posting and its weight in one number, so that they are read at once."""
        return np.concatenate([np.zeros(0, np.uint64), *self._some_pairs()])

    def _some_pairs(self):
        for i in range(0, len(self.postings), SCAN):
            yield self.postings[i:i + SCAN].astype(np.uint64) << np.uint64(32) | self.weights[i:i + SCAN].view(np.uint32)

    @functools.cached_property
    def matrix(self) -> np.ndarray:
        """The most frequent terms' weights in every example."""
        m = np.empty((int(self.in_head.sum()), len(self.ids)), np.float32)
        for i, row in enumerate(self._matrix_rows()):
            m[i] = row
        return m

    def _matrix_rows(self):
        for t in np.flatnonzero(self.in_head).tolist():
            at, row = slice(self.start[t], self.start[t + 1]), np.zeros(len(self.ids), np.float32)
            row[self.postings[at]] = self.weights[at]
            yield row

    def _added(self, t: np.ndarray, w: np.ndarray) -> np.ndarray:
        """What the terms' postings add to the cosine of each example, to single precision."""
        order = np.argsort(t)  # as they lie in memory
        t = t[order]
        return self._read(self.start[t], self.df[t], w[order].astype(np.float32))

    def _read(self, begin: np.ndarray, size: np.ndarray, w: np.ndarray) -> np.ndarray:
        """What runs of postings, each of one term, add to the cosine of each example."""
        if not size.sum():
            return np.zeros(len(self.ids))
        row, weight = _row_and_weight(self.pairs.take(_positions(begin, size), mode="clip"))  # all valid, so none is clipped
        return np.bincount(row, weight * np.repeat(w, size), len(self.ids))

    def _whole(self, rows: np.ndarray, t: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Cosines of the examples ``rows``, by their whole vectors."""
        if not len(rows):
            return np.zeros(0)
        asked, is_asked = self.asked
        asked[t], is_asked[t] = q, True
        runs = list(map(slice, self.first[rows].tolist(), self.first[rows + 1].tolist()))
        terms = np.concatenate([self.terms[r] for r in runs])
        # Few bytes a term, so this look-up is the fast one; all terms are valid, so none is clipped.
        hit = np.flatnonzero(np.take(is_asked, terms, mode="clip"))
        is_asked[t] = False
        size = self.first[rows + 1] - self.first[rows]
        ends = np.cumsum(size)
        hits = np.diff(np.searchsorted(hit, ends), prepend=0)  # of each row, one after another
        level = self.own_levels[hit + np.repeat(self.first[rows] - ends + size, hits)]
        return np.bincount(np.repeat(np.arange(len(rows)), hits), asked[terms[hit]] * self.log_tf[level], len(rows)) / self.norm[rows]

    @functools.cached_property
    def asked(self) -> tuple[np.ndarray, np.ndarray]:
        """A query's weights, and whether a term is the query's, while its cosines are taken."""
        return np.zeros(len(self.idf)), np.zeros(len(self.idf), bool)

    @functools.cached_property
    def block(self) -> np.ndarray:
        return np.arange(len(self.ids)) // BLOCK

    def vectors(self, texts: list[str], reader: Terms | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """The texts' unit vectors; ``reader``, made of ``keys``, remembers words."""
        return [self.unit(*c) for c in (reader or Terms(self.keys)).counts(texts)]

    def neighbours(self, vectors: list, without=None) -> list:
        """The :data:`NEIGHBOURS` nearest of each vector."""
        found: list = [None] * len(vectors)
        for group in self._groups(vectors):
            # Of what many queries leave to each the bounds spare too little to be worth their while.
            for i, head in zip(group, self.heads([vectors[i] for i in group], len(group) >= QUERIES // 4), strict=True):
                found[i] = self.nearest(*vectors[i], NEIGHBOURS, -1 if without is None else without[i], head)
        return found

    def votes(self, vectors: list, without=None):
        for rows, sims in self.neighbours(vectors, without):
            yield self.vote(rows, sims) if len(rows) else self.base

    def vote(self, rows: np.ndarray, sims: np.ndarray) -> float:
        weight = sims ** 2
        return float((weight @ self.toxic[rows] + PRIOR_WEIGHT * self.base) / (weight.sum() + PRIOR_WEIGHT))


def _mapped(name: str) -> np.ndarray:
    fs, p = filesystem(name)
    if not isinstance(fs, pafs.LocalFileSystem):  # a copy in the worker's temporary folder
        with tempfile.TemporaryDirectory() as folder:
            local = os.path.join(folder, "array.npy")
            pafs.copy_files(p, local, source_filesystem=fs, destination_filesystem=pafs.LocalFileSystem())
            return _opened(local)  # which stays readable while it is mapped
    return _opened(p)


def _opened(path: str) -> np.ndarray:
    a = np.load(path, mmap_mode="r") if os.path.getsize(path) > MAPPED else np.load(path)
    return np.asarray(a)


def build_index(vocabulary: dict[str, int], idf: np.ndarray, examples: list[tuple[int, int, dict[int, int]]]) -> Index:
    """``examples``: id, label and term counts over the vocabulary, in order."""
    ordered = [sorted(e[2].items()) for e in examples]
    return Index(term_keys(list(vocabulary)), idf, np.array([e[0] for e in examples], np.int64),
                 np.array([e[1] for e in examples], float), np.array([len(o) for o in ordered], np.int64),
                 [np.array([t for o in ordered for t, _ in o], np.int32), np.array([c for o in ordered for _, c in o], np.int64)])


def isotonic(points: list[tuple[float, float]]) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators; returns the knots of a monotone curve.

    Equal votes share a pool from the start, so the knots' votes all differ.
    """
    tied: dict[float, list[float]] = {}  # vote total, label total, count
    for x, y in points:
        tied[x] = [a + b for a, b in zip(tied.get(x, (0.0, 0.0, 0)), (x, y, 1), strict=True)]
    pools: list[list[float]] = []
    for x in sorted(tied):
        pools.append(tied[x])
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    return np.array([p[0] / p[2] for p in pools]), np.array([p[1] / p[2] for p in pools])


@dataclass
class Model:
    """The files of the index in the shared folder, and the calibration."""
    files: tuple[str, ...]
    n: int
    steps: tuple[np.ndarray, np.ndarray] = field(default_factory=lambda: (np.zeros(1), np.zeros(1)))

    def index(self) -> Index:
        """The index, mapped by each worker once."""
        return _load_index(self.files)

    def calibrated(self, vote: float) -> float:
        return float(np.interp(vote, *self.steps))


@functools.lru_cache(maxsize=1)
def _term_table(path: str) -> tuple[np.ndarray, ...]:
    """``term, df, toxic`` of all terms, by term."""
    t = read_shared(path)
    columns = [t.column(c).to_numpy() for c in ("term", "df", "toxic")]
    order = np.argsort(columns[0])
    return tuple(c[order] for c in columns)


@functools.lru_cache(maxsize=1)
def _load_index(files: tuple[str, ...]) -> Index:
    return Index.mapped(list(files))


def read_index(terms: str, examples: str, n: int, n_toxic: int) -> Index:
    """The index of the tables at ``terms`` and ``examples``, of ``n`` examples."""
    keys, df, toxic = _term_table(terms)
    _term_table.cache_clear()
    return Index(keys, term_weights(n, n_toxic, df.astype(float), toxic.astype(float)), *_example_table(examples))


def _example_table(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Ids and labels by id, and the sizes, and the terms and counts, of their vectors."""
    t = read_shared(path, ["doc_id", "y", "size", "most"])
    order = np.argsort(t.column("doc_id").to_numpy(), kind="stable")
    sizes = t.column("size").to_numpy()
    # Where the vector of each row of the table goes.
    begin = np.empty(len(order), np.int64)
    begin[order] = np.cumsum(sizes[order]) - sizes[order]
    most = pc.max(t.column("most")).as_py() or 0
    numbers, counts = np.empty(sizes.sum(), np.int32), np.empty(sizes.sum(), np.uint16 if most < 2 ** 16 else np.uint32)
    row = 0
    for b in shared_batches(path, ["terms", "counts"], EXAMPLE_ROWS):  # a few rows at a time beside the arrays
        for x, c in zip(b.column(0), b.column(1), strict=True):
            at = slice(begin[row], begin[row] + sizes[row])
            numbers[at], counts[at] = np.frombuffer(x.as_buffer(), np.int32), np.frombuffer(c.as_buffer(), np.uint32)
            row += 1
    pa.default_memory_pool().release_unused()  # what the reading took
    return t.column("doc_id").to_numpy()[order], t.column("y").to_numpy()[order].astype(float), sizes[order], [numbers, counts]


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Model:
    """Learn from labelled rows whose ``crc32(doc_id) mod 5`` is not 0.

    Tasks write the terms and the examples as tables and take the calibration's
    votes; the driver gets two counts and at most MAX_CALIBRATION votes.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = (labels.select(F.col("doc_id").cast("long"), F.col(label).cast("int").alias("y"))
            .where(F.col("y").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
            .groupBy("doc_id").agg(F.max("y").alias("y"))
            .orderBy(spread_key("examples", F.col("doc_id")), "doc_id").limit(MAX_EXAMPLES))
    # At most MAX_EXAMPLES rows of 12 bytes: a proven bound for the broadcast.
    chosen = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(rows), "doc_id")
    # Of equal texts one example is enough: copies would vouch for their chance words.
    chosen = chosen.groupBy(F.sha2(F.coalesce("text", F.lit("")), 256)).agg(
        F.min(F.struct("doc_id", "y", "text")).alias("r")).select("r.*")
    reader = Terms()

    def terms(texts: list[str]):
        return ((t.tolist(), c.tolist()) for t, c in reader.counts(texts))

    vectors = materialize(per_batch(chosen, terms, "terms array<bigint>, counts array<bigint>", ["doc_id", "y"]), "toxicity")
    per_term = materialize(vectors.select("y", F.explode("terms").alias("term")).groupBy("term")
                           .agg(F.count("*").cast("int").alias("df"), F.sum("y").cast("int").alias("toxic")), "toxicity_terms")
    n, n_toxic = vectors.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    terms_path = per_term._tallow_path

    def numbered(batches):
        keys = _term_table(terms_path)[0]
        for b in batches:
            ts, cs, most = [], [], []
            for t, c in zip(b.column(2), b.column(3), strict=True):
                # Terms are in ascending order of their keys, as are the numbers.
                ts.append(np.searchsorted(keys, t.values.to_numpy()).astype(np.int32).tobytes())
                cs.append(c.values.to_numpy().astype(np.uint32).tobytes())
                most.append(int(c.values.to_numpy().max(initial=0)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([len(t) // 4 for t in ts], pa.int64()), pa.array(most, pa.int64()),
                 pa.array(ts, pa.binary()), pa.array(cs, pa.binary())], names=["doc_id", "y", "size", "most", "terms", "counts"])

    found = materialize(vectors.mapInArrow(numbered, "doc_id bigint, y int, size bigint, most bigint, terms binary, counts binary"),
                        "toxicity_examples")
    drop_table(vectors)
    vectors_path, folder = found._tallow_path, shared_folder(spark, "llm", "toxicity_index")
    filesystem(folder)[0].create_dir(filesystem(folder)[1], recursive=True)

    def made(batches):
        for b in batches:
            for _ in range(b.num_rows):
                yield pa.RecordBatch.from_arrays([pa.array([read_index(terms_path, vectors_path, n, n_toxic).write(folder)])], names=["files"])

    files = spark.range(0, 1, 1, 1).mapInArrow(made, "files array<string>").first()[0]
    drop_table(per_term)
    drop_table(found)
    model = Model(tuple(files), n)
    model.steps = _calibration(spark, model)
    return model


def _calibration(spark, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic steps over leave-one-out votes of at most MAX_CALIBRATION examples, taken in tasks."""
    some = np.unique(np.linspace(0, model.n - 1, min(model.n, MAX_CALIBRATION)).astype(int)) if model.n else np.zeros(0, int)
    if not len(some):
        return model.steps

    def votes(batches):
        index = model.index()
        for b in batches:
            asked = [int(some[i]) for i in b.column(0).to_pylist()]
            found = index.votes([index.own(i) for i in asked], asked)
            yield pa.RecordBatch.from_arrays([pa.array([round(v, 9) for v in found], pa.float64()), pa.array(index.toxic[asked])],
                                             names=["vote", "toxic"])

    tasks = min(len(some), spark.sparkContext.defaultParallelism)
    return isotonic([tuple(r) for r in spark.range(0, len(some), 1, tasks).mapInArrow(votes, "vote double, toxic double").collect()])


def term_key(term: str) -> int:
    """64 bits that stand for a term; among a million terms two are alike with probability 3e-8."""
    return xxhash.xxh3_64_intdigest(term) - 2 ** 63


def term_keys(terms: Iterable[str]) -> np.ndarray:
    """The :func:`term_key` of each term."""
    # Less 2 ** 63, modulo 2 ** 64, is the top bit turned over.
    return (np.array(list(map(xxhash.xxh3_64_intdigest, terms)), np.uint64) ^ np.uint64(2 ** 63)).view(np.int64)


def term_weights(n: int, n_toxic: int, df: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Idf times the chi-square (Yates) of the 2x2 table term or not, toxic or not."""
    apart = np.maximum(np.abs(toxic * (n - n_toxic) - (df - toxic) * n_toxic) - n / 2, 0)
    chi2 = n * apart ** 2 / np.maximum(df * (n - df) * n_toxic * (n - n_toxic), 1e-9)
    return (np.log((1 + n) / (1 + df)) + 1) * (PLAIN_WEIGHT + chi2)


def held_out(doc_id) -> F.Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def score(df: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """``score, predicted`` and evidence of each row; ``keep`` are carried along."""
    bounded_batches(df.sparkSession)

    readers: list[Terms] = []  # of a task, so that its words go with it: workers outlive tasks and stages

    def judge(texts: list[str]):
        index = model.index()
        if not readers:
            readers.append(Terms(index.keys))
        for rows, sims in index.neighbours(index.vectors(texts, readers[0])):
            p = model.calibrated(index.vote(rows, sims) if len(rows) else index.base)
            yield p, int(p >= 0.5), index.ids[rows].tolist(), sims.tolist()

    # Alike texts are searched together, and of more texts more are alike.
    return per_batch(df, judge, SCHEMA, keep, text, TEXTS)


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` and evidence of every document."""
    found = score(docs.select("doc_id", "text"), fit(docs, labels), ["doc_id"])
    return found.withColumn("held_out", F.coalesce(held_out(F.col("doc_id")), F.lit(False)))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents predicted toxic, columns unchanged."""
    model, names = fit(docs, labels), docs.columns
    marked = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], F.col("`text`").alias("t"))
    judged = score(marked, model, marked.columns[:-1], "t").where("predicted = 0")
    return judged.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
