"""Token ids of whole texts, each word of a chunk encoded once.

The tokenizer splits texts at white space before anything else, so a text's
ids are its words' ids in order, and it lower-cases. Texts go in chunks of
about CHUNK_BYTES: Arrow splits a chunk into words and numbers its distinct
ones, the tokenizers library encodes these, and the texts' ids are gathered.
Nothing is kept from one chunk to the next.
The vocabulary travels as a broadcast string: its size is that of a file
given by parameter, and executors need no copy of their own.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallow.llm.common import bounded_batches, release_memory

DEFAULT_VOCABULARY = "word_bpe_49k.json"
END_ID = 1
# Text encoded at a time, distinct words that go to the library at a time, words
# gathered at a time, and rows of a batch that is given out.
CHUNK_BYTES = 16 << 20
GROUP = 8192
RUNS = 1 << 16
OUT_ROWS = 512
# Byte-level vocabularies write printable Latin-1 bytes as themselves and the
# others as the letters from U+0100 on, in order. A space parts words here.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_OTHERS = [b for b in range(256) if b not in _PRINTABLE]
_LETTERS = np.array([b if b in _PRINTABLE or b == 32 else 256 + _OTHERS.index(b) for b in range(256)], "<u2")
# Latin letters (up to U+012F) make one piece, a run of ASCII marks after them
# another; apostrophes have rules of their own.
_LATIN = "[A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f]+"
_MARKS = r"[!-&(-/:-@\[-`{-~]*"


def vocabulary_path(name: str = DEFAULT_VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class WordTokenizer:
    """Ids of texts as unsigned 32-bit integers."""

    def __init__(self, definition: str):
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_str(definition)
        # The library's model by itself, for words as they stand after its normaliser.
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        end = self.tokenizer.model.end_of_word_suffix
        vocabulary = self.tokenizer.get_vocab()
        self.is_end = np.zeros(max(vocabulary.values()) + 1, bool)
        if end:
            self.is_end[[i for t, i in vocabulary.items() if t.endswith(end)]] = True

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of runs of Latin letters, or of marks, end to end; and how many each has."""
        ids, sizes = [], []
        for i in range(0, len(pieces), GROUP):
            some = pieces[i:i + GROUP]
            text = _LETTERS[np.frombuffer(" ".join(some).lower().encode(), np.uint8)].tobytes().decode("utf-16-le")
            got = np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(self.is_end[got])
            if len(ends) == len(some) and ends[-1] == len(got) - 1:  # the last id of each piece, and no other, ends a word
                n = np.diff(ends, prepend=-1)
            else:
                each = [self._whole(p) for p in some]
                got, n = np.concatenate(each), np.array(list(map(len, each)), np.int64)
            ids.append(got)
            sizes.append(n)
        return np.concatenate([np.zeros(0, np.uint32), *ids]), np.concatenate([np.zeros(0, np.int64), *sizes])

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where each of the distinct words' ids begin and how many they are."""
        is_plain = pc.match_substring_regex(words, f"^{_LATIN}{_MARKS}$")
        plain, rest = words.filter(is_plain), words.filter(pc.invert(is_plain)).to_pylist()
        letters, marks = (pc.replace_substring_regex(plain, p, "", max_replacements=1).dictionary_encode()
                          for p in (f"{_MARKS}$", f"^{_LATIN}"))
        known = letters.dictionary.to_pylist() + marks.dictionary.to_pylist()
        ids, n = self._pieces([p for p in known if p])
        sizes = np.zeros(len(known), np.int64)
        sizes[[i for i, p in enumerate(known) if p]] = n
        pieces = np.column_stack([letters.indices.to_numpy(), marks.indices.to_numpy() + len(letters.dictionary)]).ravel()
        ids = [_gathered(ids, np.cumsum(sizes) - sizes, sizes, pieces)]
        where = is_plain.to_numpy(zero_copy_only=False)
        size = np.zeros(len(words), np.int64)
        size[where] = sizes[pieces].reshape(-1, 2).sum(axis=1)
        each = []
        for i in range(0, len(rest), GROUP):  # other words take the whole tokenizer
            got = [e.ids for e in self.tokenizer.encode_batch_fast(rest[i:i + GROUP], add_special_tokens=False)]
            each += map(len, got)
            ids.append(np.fromiter(chain.from_iterable(got), np.uint32))
        size[~where] = each
        order = np.argsort(~where, kind="stable")  # as the ids lie
        begin = np.empty(len(words), np.int64)
        begin[order] = np.cumsum(size[order]) - size[order]
        return np.concatenate(ids), begin, size

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The texts' ids end to end, and how many each text has."""
        # A text that may hold a special token, which is told apart by case, takes the whole tokenizer.
        special = np.flatnonzero(pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False))
        # The tokenizer's normaliser lower-cases as well.
        words = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        coded, ends = words.flatten().dictionary_encode(), words.offsets.to_numpy()
        del words  # a chunk's words are many, so none are held longer than needed
        codes = coded.indices.to_numpy()
        ids, begin, size = self._words(coded.dictionary)
        sizes, ids = _sums(size, codes, ends - ends[0]), _gathered(ids, begin, size, codes)
        if len(special):
            each = np.split(ids, np.cumsum(sizes)[:-1])
            for i in special.tolist():
                each[i] = self._whole(texts[i].as_py())
                sizes[i] = len(each[i])
            ids = np.concatenate(each)
        return ids, sizes

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        ids, sizes = self.encode(pa.array(texts, pa.string()))
        return [x.tobytes() for x in np.split(ids, np.cumsum(sizes)[:-1])] if texts else []


def _sums(size: np.ndarray, runs: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The sums of ``size[run]`` over the runs from each of ``ends`` to the next."""
    out = np.zeros(len(ends) - 1, np.int64)
    for i in range(0, len(runs), RUNS):  # some at a time: all words' sizes are many times the texts'
        before = np.concatenate([[0], np.cumsum(size[runs[i:i + RUNS]])])
        out += np.diff(before[np.clip(ends - i, 0, len(before) - 1)])
    return out


def _gathered(values: np.ndarray, begin: np.ndarray, size: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """The values of the runs, which begin at ``begin[run]`` and have ``size[run]`` values, end to end."""
    out = np.empty(sum(int(size[runs[i:i + RUNS]].sum()) for i in range(0, len(runs), RUNS)), values.dtype)
    at = 0
    for i in range(0, len(runs), RUNS):
        some = runs[i:i + RUNS]
        n = size[some]
        to = np.cumsum(n)
        out[at:at + to[-1]] = values[np.repeat(begin[some] - to + n, n) + np.arange(to[-1])]
        at += to[-1]
    return out


_LOADED: dict[int, WordTokenizer] = {}


def encoder(spark: SparkSession, path: str | None = None) -> Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]:
    """A function for tasks: :meth:`WordTokenizer.encode`, without an end id."""
    with open(path or vocabulary_path(), encoding="utf-8") as f:
        definition = spark.sparkContext.broadcast(f.read())

    def encode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        text = definition.value
        key = hash(text)
        if key not in _LOADED:
            _LOADED[key] = WordTokenizer(text)
        return _LOADED[key].encode(texts)

    return encode


def chunks(batches: Iterable[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The rows in order, in batches of ``most`` bytes in the last column or more.

    They have at most twice as many bytes and one text; the last batch may have fewer.
    """
    held: list[pa.RecordBatch] = []
    size = 0
    for b in batches:
        ends = np.cumsum(pc.binary_length(b.column(b.num_columns - 1)).to_numpy(), dtype=np.int64)
        cuts = [0, *(np.flatnonzero(np.diff(ends // most)) + 1).tolist(), b.num_rows]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            if hi > lo:
                held.append(b.slice(lo, hi - lo))
                size += int(ends[hi - 1] - (ends[lo - 1] if lo else 0))
            if size >= most:
                yield pa.concat_batches(held)
                held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def id_width(path: str | None = None) -> int:
    """Bytes of an unsigned id: 2 for vocabularies of up to 65,536 ids, else 4."""
    from tokenizers import Tokenizer
    return 2 if Tokenizer.from_file(path or vocabulary_path()).get_vocab_size() <= 1 << 16 else 4


def token_task(df: DataFrame, keep: list[str], path: str | None = None, text: str = "text",
               end_id: int | None = END_ID) -> tuple[DataFrame, Callable, str]:
    """The rows, task and schema that :func:`token_table` is made of.

    A task that goes on with the ids calls this one itself: a step of its own would
    be a second Python worker beside each tokenizer.
    """
    bounded_batches(df.sparkSession)
    encode, width = encoder(df.sparkSession, path), id_width(path)
    src = df.select(*keep, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("__text"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1])
    names = [*src.columns[:-1], "n_tokens", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, CHUNK_BYTES):
            (ids, n), others = encode(b.column(b.num_columns - 1)), b.columns[:-1]
            b = None
            for lo in range(0, len(n), OUT_ROWS):
                some = n[lo:lo + OUT_ROWS]
                ends = np.cumsum(some)
                now, ids = ids[:ends[-1]], ids[ends[-1]:]
                if end_id is not None:
                    now, some = np.insert(now, ends, end_id), some + 1
                yield pa.RecordBatch.from_arrays([*[c.slice(lo, OUT_ROWS) for c in others], pa.array(some, pa.int64()),
                                                  _binary(now.astype(f"<u{width}"), some)], names=names)
            ids = n = others = now = some = None
            release_memory()

    return src, run, f"{kept}, n_tokens bigint, ids binary"


def token_table(df: DataFrame, keep: list[str], path: str | None = None, text: str = "text",
                end_id: int | None = END_ID) -> DataFrame:
    """``keep``, ``n_tokens`` and ``ids``: little-endian unsigned ids of :func:`id_width` bytes.

    Null texts count as empty; each document ends with ``end_id``.
    """
    src, run, schema = token_task(df, keep, path, text, end_id)
    return src.mapInArrow(run, schema)


def _binary(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The values end to end as one binary value of each size."""
    offsets = np.concatenate([[0], np.cumsum(sizes) * values.itemsize]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def crc_of(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4"))
