"""How far the sources of a language are from each other and from the whole: term counts in stripes, divergences in integers.

Every task folds whole documents into stripes, one for each (language, term): in how many documents the term is, and how often in
each source. A full table of stripes is spilled, stripes of equal key are merged in key order, and merged stripes of frequent
terms emit what each of them adds to the divergences. Nothing depends on the number of documents but the counts themselves.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import shipped, slices, staged, texts

#: A term is kept by a language in which so many documents hold it.
LEAST_DOCUMENTS = 3
#: Terms listed for a group.
TOP_TERMS = 200
#: Whole of the probabilities; they are integers.
ONE = 1_000_000_000
#: Entries (a term's count in a source) that a task holds before it spills.
SPILL_ENTRIES = 1_000_000
#: Stripes of an Arrow batch.
ROWS = 20_000
#: Bytes of text that are cut into terms at once.
CHUNK_BYTES = 4 << 20
#: Cells of a term by source table that one numpy step handles.
CELLS = 1 << 20

#: A-Z become a-z; letters and all bytes from 0x80 stay; every other byte parts terms.
TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

STRIPE = "lang string, term binary, documents long, sources array<string>, counts array<long>"
_STRIPE = pa.schema([("lang", pa.string()), ("term", pa.binary()), ("documents", pa.int64()), ("sources", pa.list_(pa.string())),
                     ("counts", pa.list_(pa.int64()))])
_FOUND = pa.schema([("lang", pa.string()), ("source", pa.string()), ("other", pa.string()), ("term", pa.binary()), ("value", pa.int64())])


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in lists that stay small for very long texts."""
    start = 0
    while start < len(text):
        stop = start + CHUNK_BYTES
        part = text[start:stop].translate(TERM_BYTES)
        if stop < len(text):  # back to the last boundary; a term longer than the chunk is taken with all its rest
            cut = part.rfind(b" ")
            while cut < 0 and stop < len(text):
                stop += CHUNK_BYTES
                part = text[start:stop].translate(TERM_BYTES)
                cut = part.rfind(b" ")
            if cut >= 0 and stop < len(text):
                stop, part = start + cut + 1, part[:cut]
        yield part.split()
        start = stop


class Stripes:
    """The stripes of one task, (language, term) to [documents, {source: count}], held by column: what is in a document is added
    to the counter of its language and to that of its source, and a spill turns the columns into stripes."""

    def __init__(self) -> None:
        self.languages: dict[str, tuple[Counter, dict[str, Counter]]] = {}

    def add(self, lang: str, source: str, text: bytes) -> None:
        documents, counts = self.languages.setdefault(lang, (Counter(), {}))
        total = counts.setdefault(source, Counter())
        distinct: set[bytes] = set()
        for found in terms(text):
            total.update(found)
            distinct.update(found)
        documents.update(distinct)

    def entries(self) -> int:
        return sum(len(c) for _, counts in self.languages.values() for c in counts.values())

    def spill(self) -> Iterator[pa.RecordBatch]:
        for lang, (documents, counts) in self.languages.items():
            names = pa.array(list(counts), pa.string())
            # a row without a term says which sources there are: a group without terms is a group
            yield _rows([lang], pa.array([None], pa.binary()), [0], [0, len(names)], names, np.zeros(len(names), dtype=np.int64))
            place = dict(zip(documents, range(len(documents))))
            at, of, n = [], [], []
            for number, found in enumerate(counts.values()):
                at.append(np.fromiter(map(place.__getitem__, found), dtype=np.int64, count=len(found)))
                n.append(np.fromiter(found.values(), dtype=np.int64, count=len(found)))
                of.append(np.full(len(found), number))
            at, of, n = np.concatenate(at), np.concatenate(of), np.concatenate(n)
            order = np.argsort(at, kind="stable")
            of, n, ends = of[order], n[order], np.concatenate([[0], np.cumsum(np.bincount(at, minlength=len(place)))])
            found, held = pa.array(list(documents), pa.binary()), np.fromiter(documents.values(), dtype=np.int64, count=len(documents))
            for a in range(0, len(place), ROWS):
                b = min(a + ROWS, len(place))
                part = slice(ends[a], ends[b])
                yield _rows([lang] * (b - a), found.slice(a, b - a), held[a:b], ends[a:b + 1] - ends[a], names.take(pa.array(of[part])), n[part])
        self.languages = {}


def _rows(langs, terms_, documents, ends, sources: pa.Array, counts) -> pa.RecordBatch:
    ends = pa.array(ends, pa.int32())
    return pa.RecordBatch.from_arrays([
        pa.array(langs, pa.string()), terms_, pa.array(documents, pa.int64()), pa.ListArray.from_arrays(ends, sources),
        pa.ListArray.from_arrays(ends, pa.array(counts, pa.int64()))], schema=_STRIPE)


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = Stripes()
    for batch in batches:
        langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        values, lengths = texts(batch.column(2))
        for a, b in slices(lengths):
            for lang, source, text in zip(langs[a:b], sources[a:b], values[a:b]):
                held.add(lang, source, text or b"")
            if held.entries() >= SPILL_ENTRIES:
                yield from held.spill()
    yield from held.spill()


def _merge(least: int):
    """A function over stripes in key order: those of one key become one, and those of terms in fewer documents end here.

    Only what is known of the last key is carried from batch to batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried: pa.RecordBatch | None = None

        def merged(batch: pa.RecordBatch) -> pa.RecordBatch:
            lang, term, documents, sources, counts = batch.columns
            n = batch.num_rows
            new = np.ones(n, dtype=bool)
            for column in (lang, term):
                filled = pc.fill_null(column, b"" if column is term else "")  # no term is empty
                differs = pc.not_equal(filled.slice(1), filled.slice(0, n - 1)).to_numpy(zero_copy_only=False)
                new[1:] = differs if column is lang else new[1:] | differs
            group = np.cumsum(new) - 1
            sizes = np.diff(sources.offsets.to_numpy())
            names = sources.flatten().dictionary_encode()
            width = max(1, len(names.dictionary))
            cell = np.repeat(group, sizes) * width + names.indices.to_numpy()
            cells, at = np.unique(cell, return_inverse=True)
            summed = np.zeros(len(cells), dtype=np.int64)
            np.add.at(summed, at, counts.flatten().to_numpy())
            held = np.zeros(int(group[-1]) + 1, dtype=np.int64)
            np.add.at(held, group, documents.to_numpy())
            first = pa.array(np.flatnonzero(new))
            ends = np.concatenate([[0], np.cumsum(np.bincount(cells // width, minlength=len(held)))])
            return _rows(lang.take(first), term.take(first), held, ends, names.dictionary.take(pa.array(cells % width)), summed)

        def kept(batch: pa.RecordBatch) -> pa.RecordBatch:
            return batch.filter(pc.or_(pc.is_null(batch.column(1)), pc.greater_equal(batch.column(2), least)))

        for batch in batches:
            if not batch.num_rows:
                continue
            if carried is not None:
                batch = pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([x, y.cast(x.type)]) for x, y in zip(carried.columns, batch.columns)], schema=_STRIPE)
            batch = merged(batch)
            carried = batch.slice(batch.num_rows - 1)
            if batch.num_rows > 1:
                yield kept(batch.slice(0, batch.num_rows - 1))
        if carried is not None:
            yield kept(carried)

    return run


def stripes(docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source", least: int = LEAST_DOCUMENTS) -> DataFrame:
    """Rows of `STRIPE`, staged: one for each language and term that `least` of its documents hold, and one for each language
    with a null term that lists all its sources.

    Nulls count as empty texts; repeated rows are documents of their own; further columns are not looked at.
    """
    shipped(docs.sparkSession)
    empty = F.lit("")
    folded = docs.select(F.coalesce(F.col(lang).cast("string"), empty).alias("lang"), F.coalesce(F.col(source).cast("string"), empty).alias("source"),
                         F.col(text).alias("text")).mapInArrow(_fold, STRIPE)
    dealt = folded.repartition("lang", "term").sortWithinPartitions("lang", "term")
    return staged(dealt.mapInArrow(_merge(least), STRIPE))


def share(counts: np.ndarray, whole: np.ndarray | int) -> np.ndarray:
    """1 + floor(ONE * (counts + 1) / whole), exactly, by long division with three digits at a time."""
    rest = counts.astype(np.int64) + 1
    quotient = rest // whole
    rest = rest % whole
    for _ in range(3):
        quotient = quotient * 1000 + rest * 1000 // whole
        rest = rest * 1000 % whole
    return 1 + quotient


class Sources:
    """The groups of one language in one task, and what the stripes that pass by add to their divergences."""

    def __init__(self, key: tuple[str, int], top: int) -> None:
        self.key, self.top = key, top
        self.names: list[str] = []
        self.totals: list[int] = []
        self.kept: list[tuple[bytes, list[str], list[int]]] = []
        self.at: dict[str, int] | None = None

    def group(self, name: str, total: int, terms_kept: int, whole: int) -> None:
        self.names.append(name)
        self.totals.append(total)
        self.v, self.n = terms_kept, whole

    def start(self) -> None:
        """All groups are known once the first stripe comes."""
        m = len(self.names)
        self.at = {s: i for i, s in enumerate(self.names)}
        self.width = max(1, 4 * CELLS // max(1, m))
        self.best: list[list[tuple[int, bytes]]] = [[] for _ in range(m)]
        self.sums = np.zeros((m, m) if m <= self.width else (0, 0), dtype=np.int64)

    def rows(self, sources: list, others: list | None, found: list | None, values: list) -> pa.RecordBatch:
        none = [None] * len(values)
        return pa.RecordBatch.from_arrays([
            pa.array([self.key[0]] * len(values), pa.string()), pa.array(sources, pa.string()), pa.array(others or none, pa.string()),
            pa.array(found or none, pa.binary()), pa.array(values, pa.int64())], schema=_FOUND)

    def pairs(self, first: int, table: np.ndarray) -> pa.RecordBatch:
        s, t = np.nonzero(np.arange(len(self.names))[:, None] != first + np.arange(table.shape[1])[None, :])
        return self.rows([self.names[i] for i in s], [self.names[first + j] for j in t], None, table[s, t].tolist())

    def stripe(self, term: bytes, sources: list[str], counts: list[int]) -> Iterator[pa.RecordBatch]:
        if self.at is None:
            self.start()
        self.kept.append((term, sources, counts))
        if len(self.kept) * len(self.names) >= CELLS:
            yield from self.step()

    def step(self) -> Iterator[pa.RecordBatch]:
        """Takes the stripes in hand: adds to the sums of the pairs and keeps the best terms of every group."""
        if not self.kept:
            return
        m = len(self.names)
        counts = np.zeros((len(self.kept), m), dtype=np.int64)
        for row, (_, sources, found) in enumerate(self.kept):
            counts[row, [self.at[s] for s in sources]] = found
        p = share(counts, (np.array(self.totals, dtype=np.int64) + self.v)[None, :])
        q = share(counts.sum(axis=1), self.n + self.v)[:, None]
        for first in range(0, m, self.width):
            part = np.zeros((m, min(self.width, m - first)), dtype=np.int64)
            for j in range(part.shape[1]):
                base = p[:, first + j:first + j + 1]
                part[:, j] = ((p - base) ** 2 // base).sum(axis=0)
            if m <= self.width:
                self.sums += part
            else:  # too many sources to hold a table of all their pairs until the language ends
                yield self.pairs(first, part)
        gain, ok = (p - q) ** 2 // q, (counts > 0) & (p > q)
        for j in range(m):
            rows = np.flatnonzero(ok[:, j])
            if len(rows) > 4 * self.top:  # the others cannot be among the first
                rows = rows[gain[rows, j] >= np.partition(gain[rows, j], len(rows) - self.top)[len(rows) - self.top]]
            best = self.best[j]
            best.extend((-int(gain[i, j]), self.kept[i][0]) for i in rows)
            if len(best) > self.top:
                best.sort()
                del best[self.top:]
        self.kept = []

    def close(self) -> Iterator[pa.RecordBatch]:
        if self.at is None:
            self.start()
        yield from self.step()
        if len(self.sums):
            yield self.pairs(0, self.sums)
        for name, best in zip(self.names, self.best):
            if best:
                yield self.rows([name] * len(best), None, [t for _, t in best], [-g for g, _ in best])


def _emit(top: int):
    """A function over batches that hold, for each (language, salt), its group rows first and then stripes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here: Sources | None = None
        for batch in batches:
            for lang, salt, kind, source, n, v, whole, term, sources, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if here is None or here.key != (lang, salt):
                    if here is not None:
                        yield from here.close()
                    here = Sources((lang, salt), top)
                if kind == 0:
                    here.group(source, n, v, whole)
                else:
                    yield from here.stripe(term, sources, counts)
        if here is not None:
            yield from here.close()

    return run


def divergences(found: DataFrame, *, top: int = TOP_TERMS) -> DataFrame:
    """`lang`, `source`, `part`, `item`, `value`, `rank` out of staged `stripes`.

    Part `pair` compares a group with each other source of its language over all terms that the language keeps; part `term`
    lists the `top` terms that the group has more of than the language. Ties go to the item that is first in UTF-8. A language
    that keeps no term has pairs of value 0; an empty table gives no rows.
    """
    spark = shipped(found.sparkSession)
    kept = found.where("term is not null")
    groups = found.where("term is null").select("lang", F.explode("sources").alias("source"))
    counted = kept.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("c")).groupBy("lang", F.col("c.sources").alias("source")) \
        .agg(F.sum("c.counts").alias("n"))
    sizes = kept.groupBy("lang").agg(F.count("*").alias("v"))
    each = groups.join(counted, ["lang", "source"], "left").join(sizes, "lang", "left") \
        .select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("v", F.lit(0)).alias("v"))
    each = each.join(each.groupBy("lang").agg(F.sum("n").alias("whole")), "lang")
    salts = max(2, spark.sparkContext.defaultParallelism)
    salt = F.pmod(F.xxhash64("term"), F.lit(salts)).cast("int")
    heads = each.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).select(
        "lang", "salt", F.lit(0).alias("kind"), "source", "n", "v", "whole", F.lit(None).cast("binary").alias("term"),
        F.lit(None).cast("array<string>").alias("sources"), F.lit(None).cast("array<bigint>").alias("counts"))
    none = F.lit(None).cast("bigint")
    bodies = kept.select("lang", salt.alias("salt"), F.lit(1).alias("kind"), F.lit(None).cast("string").alias("source"), none.alias("n"),
                         none.alias("v"), none.alias("whole"), "term", "sources", "counts")
    dealt = heads.unionByName(bodies).repartition("lang", "salt").sortWithinPartitions("lang", "salt", "kind", "source", "term")
    parts = staged(dealt.mapInArrow(_emit(top), "lang string, source string, other string, term binary, value long"))
    pairs = parts.where("other is not null").groupBy("lang", "source", F.col("other").alias("item")).agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    listed = parts.where("term is not null").select("lang", "source", F.col("term").cast("string").alias("item"), "value")
    return pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank")).unionByName(
        listed.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        .select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))
