"""Benchmark decontamination with suffix arrays over shards of the training words.

Each task turns slices of its documents into one array of word numbers, sorts the suffixes that can start a match, and
finds every benchmark suffix in it by binary search. A document lies whole in one shard, so no match is cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE_BYTES, shipped, slices, staged, texts, words

WINDOW = 10
#: Most benchmark words that are sent to the tasks at once; a larger benchmark is searched in several blocks.
BLOCK_WORDS = 2_000_000

FOUND = "struct<n_words:long,spans:array<struct<start:long,stop:long>>,item_ids:array<string>>"
LEAK = "struct<n_words:long,n_hit:long,n_items:long,items_sha256:string,contaminated:boolean," \
       "spans:array<struct<start:long,stop:long>>,item_ids:array<string>>"


class TestSuffixes:
    """The windows of a block of benchmark items as packed word numbers, ready for binary search."""

    __test__ = False

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        numbers: dict[tuple[int, ...], list[int]] = {}
        self.item_ids = [item for item, _ in items]
        for k, (_, item_words) in enumerate(items):
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in item_words]
            size = min(window, len(ids))
            for at in range(len(ids) - size + 1 if size else 0):
                held = numbers.setdefault(tuple(ids[at:at + size]), [])
                if not held or held[-1] != k:
                    held.append(k)
        self.sizes = np.array([len(w) for w in numbers], dtype=np.int64)
        self.bits = max(1, (len(self.vocabulary)).bit_length())
        padded = np.zeros((len(numbers), window), dtype=np.int64)
        for row, w in enumerate(numbers):
            padded[row, :len(w)] = w
        top = padded.copy()
        top[np.arange(window)[None, :] >= self.sizes[:, None]] = (1 << self.bits) - 1
        self.low, self.high = self.pack(padded), self.pack(top)
        pairs = padded[self.sizes > 1, :2]
        self.pairs = np.unique((pairs[:, 0] << self.bits) | pairs[:, 1])
        self.singles = np.unique(padded[self.sizes == 1, 0])
        self.shortest = int(self.sizes.min()) if len(numbers) else window
        self.item_from = np.concatenate([[0], np.cumsum([len(v) for v in numbers.values()])]).astype(np.int64)
        self.item_of = np.array([k for v in numbers.values() for k in v], dtype=np.int64)

    def pack(self, ids: np.ndarray) -> list[np.ndarray]:
        """Rows of word numbers as a few integers each that sort the same way."""
        per = 62 // self.bits
        out = []
        for at in range(0, self.window, per):
            key = np.zeros(len(ids), dtype=np.int64)
            for j in range(at, min(at + per, self.window)):
                key = (key << self.bits) | ids[:, j]
            out.append(key)
        return out


def suffix_array(ids: np.ndarray, tests: TestSuffixes) -> tuple[np.ndarray, list[np.ndarray]]:
    """Starts of the suffixes that can begin a benchmark window, in the order of their first `window` words.

    A word outside the benchmark (number 0) ends every match, so suffixes with fewer words before it than the shortest
    window cannot match, nor can those whose first two words start no window.
    """
    n = len(ids)
    zero = np.flatnonzero(ids == 0)
    at = np.flatnonzero(ids)
    left = zero[np.searchsorted(zero, at)] - at
    at, left = at[left >= tests.shortest], left[left >= tests.shortest]
    padded = np.concatenate([ids, np.zeros(tests.window, dtype=ids.dtype)])
    pair = (padded[at].astype(np.int64) << tests.bits) | padded[at + 1]
    good = np.zeros(len(at), dtype=bool)
    if len(tests.pairs):
        good = tests.pairs[np.minimum(np.searchsorted(tests.pairs, pair), len(tests.pairs) - 1)] == pair
    if len(tests.singles):
        good |= np.isin(padded[at], tests.singles)
    at = at[good]
    keys = tests.pack(padded[at[:, None] + np.arange(tests.window)[None, :]].astype(np.int64)) if n else tests.pack(
        np.zeros((0, tests.window), dtype=np.int64))
    order = np.lexsort(keys[::-1])
    return at[order], [k[order] for k in keys]


def search(keys: list[np.ndarray], wanted: list[np.ndarray], after: bool) -> np.ndarray:
    """First place in the sorted rows `keys` that is not below (`after`: that is above) each wanted row."""
    lo = np.zeros(len(wanted[0]), dtype=np.int64)
    hi = np.full(len(wanted[0]), len(keys[0]), dtype=np.int64)
    while (open_ := lo < hi).any():
        mid = np.minimum((lo + hi) >> 1, len(keys[0]) - 1)
        less = np.zeros(len(lo), dtype=bool)
        equal = np.ones(len(lo), dtype=bool)
        for key, want in zip(keys, wanted):
            less |= equal & (key[mid] < want)
            equal &= key[mid] == want
        down = less | (equal if after else False)
        lo = np.where(open_ & down, mid + 1, lo)
        hi = np.where(open_ & ~down, mid, hi)
    return lo


def occurrences(ids: np.ndarray, tests: TestSuffixes) -> tuple[np.ndarray, np.ndarray]:
    """(place, window) of every occurrence of a benchmark window in the shard."""
    at, keys = suffix_array(ids, tests)
    if not len(at) or not len(tests.sizes):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    lo, hi = search(keys, tests.low, False), search(keys, tests.high, True)
    counts = np.maximum(hi - lo, 0)
    which = np.repeat(np.arange(len(counts)), counts)
    inside = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
    return at[np.repeat(lo, counts) + inside], which


def scan(shard: list[bytes | None], tests: TestSuffixes) -> list[tuple[int, list[tuple[int, int]], list[str]]]:
    """Per document of a shard: number of words, hit word ranges, ids of the items found."""
    parts, starts, total = [], [], 0
    get = tests.vocabulary.get
    for text in shard:
        found = words(text) if text else []
        starts.append(total)
        parts.append(np.fromiter(map(get, found, repeat(0)), dtype=np.int32, count=len(found)))
        parts.append(np.zeros(1, dtype=np.int32))
        total += len(found) + 1
    begin = np.array(starts + [total], dtype=np.int64)
    out: list = [(int(n), [], []) for n in np.diff(begin) - 1]
    place, window = occurrences(np.concatenate(parts) if parts else np.zeros(0, dtype=np.int32), tests)
    if not len(place):
        return out
    edge = np.zeros(total + 1, dtype=np.int32)
    np.add.at(edge, place, 1)
    np.add.at(edge, place + tests.sizes[window], -1)
    hit = (np.cumsum(edge) > 0).astype(np.int8)
    change = np.diff(np.concatenate([[0], hit]))
    first, last = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    owner = np.searchsorted(begin, first, side="right") - 1
    for doc, a, b in zip(owner.tolist(), first.tolist(), last.tolist()):
        out[doc][1].append((a - starts[doc], b - starts[doc]))
    seen = np.unique(np.stack([np.searchsorted(begin, place, side="right") - 1, window]), axis=1)
    sizes = np.diff(tests.item_from)[seen[1]]
    inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    item = tests.item_of[np.repeat(tests.item_from[seen[1]], sizes) + inside]
    both = np.unique(np.stack([np.repeat(seen[0], sizes), item]), axis=1)
    for doc, k in zip(both[0].tolist(), both[1].tolist()):
        out[doc][2].append(tests.item_ids[k])
    return out


def _merge(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of two lists of word ranges."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(a + b):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out


def _search_udf(held):
    """Column function over (text, what earlier blocks found): the same with this block's findings added."""
    @F.arrow_udf(FOUND)
    def find(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        tests = held.value
        kind = pa.struct([("n_words", pa.int64()),
                          ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                          ("item_ids", pa.list_(pa.string()))])
        for column, before in batches:
            values, lengths = texts(column)
            rows = []
            for a, b in slices(lengths, SLICE_BYTES):
                rows += scan(values[a:b], tests)
            out = []
            for (n, spans, items), old in zip(rows, before.to_pylist()):
                if old and old["item_ids"]:
                    spans = _merge(spans, [(s["start"], s["stop"]) for s in old["spans"]])
                    items = list(set(items) | set(old["item_ids"]))
                out.append({"n_words": n, "spans": [{"start": s, "stop": e} for s, e in spans],
                            "item_ids": sorted(set(items))})
            yield pa.array(out, type=kind)
    return find.asNondeterministic()  # so that a later filter does not make Spark run it twice


def blocks(benchmark: DataFrame, item: str, text: str, most: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """Items with their words, in lists of at most `most` words (a longer item stands alone); one block at a time.

    Rows without words say nothing and are left out; an item without id counts under the empty text.
    """
    held: list[tuple[str, list[bytes]]] = []
    size = 0
    rows = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("i"), F.col(text).alias("t"))
    for row in rows.where(F.col("t").isNotNull()).toLocalIterator():
        found = words(row.t.encode())
        if held and size + len(found) > most:
            yield held
            held, size = [], 0
        if found:
            held.append((row.i, found))
            size += len(found)
    yield held


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item: str = "item_id",
                  item_text: str = "text", window: int = WINDOW, out: str = "leak",
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """`docs` with a struct column `out`: words, hit words, items found, digest of their ids, hit word ranges.

    A hit is any word inside an occurrence of `window` consecutive words of an item (a shorter item: the whole of it).
    Documents stay where they are: no shuffle. The benchmark goes to the tasks in blocks of `block_words`; from the second
    block on the findings so far are staged, so that one block at a time is in memory.

    Null and empty texts have no words and no hits; an empty benchmark hits nothing; repeated rows are each answered; a
    column already called `out` is replaced.
    """
    spark = shipped(docs.sparkSession)
    found = "_found_" + out
    result = docs.withColumn(found, F.lit(None).cast(FOUND))
    for k, block in enumerate(blocks(benchmark, item, item_text, block_words)):
        if k:
            result = staged(result)
        held = spark.sparkContext.broadcast(TestSuffixes(block, window))
        result = result.withColumn(found, _search_udf(held)(F.col(text), F.col(found)))
    span = F.col(found)["spans"]
    items = F.col(found)["item_ids"]
    hit = F.aggregate(span, F.lit(0).cast("long"), lambda acc, s: acc + s["stop"] - s["start"])
    return result.withColumn(out, F.struct(
        F.col(found)["n_words"].alias("n_words"), hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (F.size(span) > 0).alias("contaminated"), span.alias("spans"),
        items.alias("item_ids"))).drop(found)


def keep_clean(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item: str = "item_id", item_text: str = "text",
               window: int = WINDOW) -> DataFrame:
    """Rows of `docs` without a word of the benchmark's windows."""
    seen = decontaminate(docs, benchmark, text=text, item=item, item_text=item_text, window=window, out="_leak")
    return seen.where(~F.col("_leak")["contaminated"]).select(*docs.columns)
