"""Token ids of whole texts, each distinct word tokenised once per worker."""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shipped, slices, trim

#: Words, and bytes of words and ids, that one generation of a task's memory holds.
MEMO_WORDS, MEMO_BYTES = 300_000, 48 << 20
END_ID = 1
CAPACITY = 4096

#: How a tokenizer must prepare texts so that words can be tokenised apart. Fixed values of its file.
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
#: The same parts in a lower-case ASCII word without an apostrophe.
UNITS = re.compile(rb"[a-z]+|[0-9]|[^a-z0-9]+")
#: Words of lower-case letters of one code point each, up to U+00FF.
LETTERS = "^[a-z\u00df-\u00f6\u00f8-\u00ff]+$"
#: Bytes that have no printable Latin-1 letter are shown by the letters from U+0100 on, in order. A fixed rule of such vocabularies.
BYTE_LETTERS = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255))}
del BYTE_LETTERS[32]
#: A character that parts words in one call of the tokenizer, in hardly any text, and the letter that stands for its byte.
MARK, MARK_LETTER = "\0", "\u0100"


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class Ids:
    """Ids of numbered words in one array."""

    def __init__(self) -> None:
        self.pool = np.zeros(1 << 16, dtype=np.uint32)
        self.used = self.filled = 0
        self.start = np.zeros(1 << 14, dtype=np.int64)
        self.count = np.zeros(1 << 14, dtype=np.int64)

    def put(self, numbers: np.ndarray, counts: np.ndarray, flat: np.ndarray) -> None:
        if not len(numbers):
            return
        need, top = self.used + len(flat), int(numbers.max()) + 1
        while need > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while top > len(self.start):
            self.start, self.count = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.count))
        self.pool[self.used:need] = flat
        self.start[numbers] = self.used + np.cumsum(counts) - counts
        self.count[numbers] = counts
        self.used = need

    def get(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts of the words' ids, and the ids themselves in a row."""
        sizes = self.count[numbers]
        ends = np.cumsum(sizes)
        return sizes, self.pool[np.repeat(self.start[numbers] - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)]


class Tokens:
    """Token ids of many words in one call: they are joined by marks, at whose ids the result is cut."""

    def __init__(self, tokenizer, mark: str, letters: dict[int, str] | None = None) -> None:
        self.tokenizer, self.between, self.letters = tokenizer, f" {mark} ", letters
        ids = tokenizer.encode(mark, add_special_tokens=False).ids
        self.mark = ids[0] if len(ids) == 1 else None

    def of(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Counts of ids and the ids."""
        counts, flat = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.uint32)]
        for a in range(0, len(words), 1000):
            part = words[a:a + 1000]
            text = self.between.encode().join(part).decode() if self.letters is None else self.between.join(
                [w.decode("latin-1").translate(self.letters) for w in part])
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.uint32)
            marks = np.flatnonzero(ids == self.mark) if self.mark is not None else ()
            if len(marks) == len(part) - 1:  # no word holds a mark itself
                counts.append(np.diff(np.concatenate([[-1], marks, [len(ids)]])) - 1)
                flat.append(np.delete(ids, marks))
            else:
                for ids, n in whole_texts(self.tokenizer, [w.decode() for w in part]):
                    counts.append(n)
                    flat.append(ids)
        return np.concatenate(counts), np.concatenate(flat)


def whole_texts(tokenizer, texts_: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and counts of ids of texts, some at a time."""
    for a in range(0, len(texts_), 100):
        got = [e.ids for e in tokenizer.encode_batch_fast(texts_[a:a + 100], add_special_tokens=False)]
        yield np.array([i for ids in got for i in ids], dtype=np.uint32), np.array([len(ids) for ids in got], dtype=np.int64)


class WordIds:
    """Ids of texts by a tokenizer of any kind.

    A tokenizer that lower-cases, drops white space and never joins across it (see `SPLIT`) is asked for words only: texts are
    cut at ASCII white space, different words of a batch are looked up once, and ASCII words are put together from runs of
    letters, digits and other signs. What has been looked up is remembered for two generations: what is asked for again moves
    to the new one, the rest goes with the old one. Texts with `<|`, where special tokens may begin, and all texts of other
    tokenizers go to the tokenizer whole.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_str(vocabulary)
        state = lambda part: json.loads(part.__getstate__()) if part is not None else {}
        first = (state(self.tokenizer.pre_tokenizer).get("pretokenizers") or [{}])[0]
        self.by_words = ([n["type"] for n in state(self.tokenizer.normalizer).get("normalizers", [])] == NORMALIZERS
                         and first.get("behavior") == "Removed" and first.get("invert") is True and first.get("pattern") == {"Regex": SPLIT}
                         and bool(getattr(self.tokenizer.model, "end_of_word_suffix", None)))
        self.any = self.letters = self.accents = None
        if self.by_words:
            # lower-case letters of one code point need no normalisation; what stands for their bytes goes to the same model
            lean = Tokenizer(self.tokenizer.model)
            lean.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            self.any, self.letters, self.accents = Tokens(self.tokenizer, MARK), Tokens(lean, MARK_LETTER), Tokens(lean, MARK_LETTER, BYTE_LETTERS)
        self.clear()

    def clear(self) -> None:
        self.words: dict[bytes, int] = {}
        self.old_words: dict[bytes, int] = {}
        self.ids, self.old_ids = Ids(), Ids()
        self.bytes = 0

    def turn(self) -> None:
        """Begins a new generation where the present one is full."""
        if len(self.words) > MEMO_WORDS or self.bytes + 4 * self.ids.used > MEMO_BYTES:
            self.old_words, self.old_ids = self.words, self.ids
            self.words, self.ids, self.bytes = {}, Ids(), 0

    def numbers(self, different: pa.Array) -> np.ndarray:
        """Numbers of different words; those that are not known yet become known."""
        words = different.to_pylist()
        found = np.fromiter(map(self.words.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        new = np.flatnonzero(found < 0)
        if len(new):
            fresh = list(map(words.__getitem__, new.tolist()))
            numbers = range(len(self.words), len(self.words) + len(fresh))
            found[new] = numbers
            self.words.update(zip(fresh, numbers))
            self.learn(different.take(pa.array(new)), fresh, found[new])
        return found

    def learn(self, words: pa.Array, values: list[bytes], numbers: np.ndarray) -> None:
        """Ids of new words (as a column and as a list): from the old generation, from their parts, or from the tokenizer."""
        self.bytes += len(words) * 200 + int(pc.sum(pc.binary_length(words)).as_py() or 0)
        before = np.fromiter(map(self.old_words.get, values, repeat(-1)), dtype=np.int64, count=len(values))
        kept = before >= 0
        self.ids.put(numbers[kept], *self.old_ids.get(before[kept]))
        text = words.cast(pa.string() if pa.types.is_binary(words.type) else pa.large_string())
        plain = pc.string_is_ascii(text).to_numpy(zero_copy_only=False)
        letters = pc.match_substring_regex(text, LETTERS).to_numpy(zero_copy_only=False) & ~kept
        parted = plain & ~pc.match_substring(text, "'").to_numpy(zero_copy_only=False) & ~kept & ~letters
        joined, parts, lengths = [], [], []
        for i in np.flatnonzero(parted).tolist():
            found = UNITS.findall(values[i])
            if len(found) > 1:
                joined.append(i)
                parts.extend(found)
                lengths.append(len(found))
        whole = ~kept & ~letters
        whole[joined] = False
        for which, tokenizer in ((letters & plain, self.letters), (letters & ~plain, self.accents), (whole, self.any)):
            at = np.flatnonzero(which)
            self.ids.put(numbers[at], *tokenizer.of(list(map(values.__getitem__, at.tolist()))))
        if joined:
            coded = pa.array(parts, words.type).dictionary_encode()
            counts, flat = self.ids.get(self.numbers(coded.dictionary)[coded.indices.to_numpy()])
            self.ids.put(numbers[joined], np.add.reduceat(counts, np.cumsum(lengths) - lengths), flat)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array and the bounds of each text in it; null is empty."""
        column = pc.fill_null(column, "")
        if not self.by_words:
            got = list(whole_texts(self.tokenizer, column.to_pylist()))
            counts = np.concatenate([np.zeros(1, dtype=np.int64), *(n for _, n in got)])
            return np.concatenate([np.zeros(0, dtype=np.uint32), *(ids for ids, _ in got)]), np.cumsum(counts)
        special = pc.match_substring(column, "<|")
        odd = np.flatnonzero(special.to_numpy(zero_copy_only=False)).tolist()
        lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.if_else(special, "", column) if odd else column))
        coded = lists.flatten().cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).dictionary_encode()
        self.turn()
        counts, ids = self.ids.get(self.numbers(coded.dictionary)[coded.indices.to_numpy()])
        offsets = lists.offsets.to_numpy()
        bounds = np.concatenate([[0], np.cumsum(counts)])[offsets - offsets[0]]
        if odd:
            parts = [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
            for k in odd:
                parts[k] = np.array(self.tokenizer.encode(column[k].as_py(), add_special_tokens=False).ids, dtype=np.uint32)
            bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
            ids = np.concatenate(parts)
        return ids, bounds


@contextmanager
def encoder(vocabulary: str) -> Iterator[WordIds]:
    """An encoder for one task. Workers outlive it and share an executor's memory, so nothing of it stays behind."""
    words = WordIds(vocabulary)
    trim()  # what reading the vocabulary has left
    try:
        yield words
    finally:
        words.clear()
        words.tokenizer = words.any = words.letters = words.accents = None
        trim()


def sizes(column: pa.Array) -> np.ndarray:
    """Bytes of the texts of a column."""
    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def documents(ids: np.ndarray, bounds: np.ndarray, end_id: int | None) -> Iterator[np.ndarray]:
    """The ids of each text, with `end_id` behind them."""
    tail = np.array([] if end_id is None else [end_id], dtype=np.uint32)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        yield np.concatenate([ids[a:b], tail])


def pieces(docs: DataFrame, *, key: str = "doc_id", text: str = "text", vocabulary: str | None = None,
           end_id: int | None = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """One row for each piece of a document: `key`, `piece`, `start`, `length`, `ids_crc32` (little-endian 32-bit ids).

    A document is its ids and `end_id`; only longer ones than `capacity` are cut, every piece but the last is full. Null
    and empty texts have the end id alone. Repeated rows are cut each; further columns are not looked at.
    """
    spark = shipped(docs.sparkSession)
    with open(vocabulary or default_vocabulary(), encoding="utf-8") as file:
        held = spark.sparkContext.broadcast(file.read())
    kind = pa.list_(pa.struct([("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]))

    @F.arrow_udf("array<struct<piece:int,start:long,length:long,ids_crc32:long>>")
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        with encoder(held.value) as words:
            for column in batches:
                out = []
                for a, b in slices(sizes(column), 1 << 20):
                    for ids in documents(*words.encode(column.slice(a, b - a)), end_id):
                        out.append([{"piece": k, "start": s, "length": len(part := ids[s:s + capacity]),
                                     "ids_crc32": zlib.crc32(part.astype("<u4").tobytes())}
                                    for k, s in enumerate(range(0, len(ids), capacity))])
                yield pa.array(out, kind)

    return docs.select(key, F.explode(cut.asNondeterministic()(F.col(text))).alias("_p")).select(key, "_p.*")
