"""Language identification with bit-sliced Bloom filters over character n-grams.

One table holds the filters of all languages side by side: row r is a bit mask, bit l of it belongs to language l. The AND
of the k rows an n-gram hashes to is the set of all languages that contain it, read in one go. A document's count for a
language is the number of its n-grams with that bit, less the hits that false positives explain.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, shipped, slices, staged, texts

SIZES = (3, 4)
HASHES = 3
#: Rows of the filter table, a power of two; the table is what goes to the tasks.
FILTER_ROWS = 1 << 20
#: The filters are fitted on about this many different texts of each language, whole ones, chosen by a hash.
FIT_ROWS = 2_000
#: An n-gram belongs to a language that holds at least this part of its highest rate in any language.
SHARE = 0.25
#: An n-gram of a language is in so many of its texts, or in this part of them where that is fewer.
FEWEST, PART = 2, 0.2
#: Bytes of text that one numpy step handles: it makes some hundred bytes of each.
STEP_BYTES = 1 << 20

VERDICT = "struct<lang_pred:string,score:double,coverage:double>"
_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Code point -> the same if it is a letter or mark, else a space."""
    if not _LETTERS:
        table = np.full(0x110000, 32, dtype=np.uint32)
        alpha = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
        table[alpha] = np.flatnonzero(alpha)
        _LETTERS.append(table)
    return _LETTERS[0]


def normal(batch: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points of all texts in one array, runs of other characters as one space; owner of each place."""
    parts, counts = [], []
    for text in batch:
        part = f" {text.decode('utf-8', 'replace').lower()} " if text else "  "
        parts.append(part)
        counts.append(len(part))
    points = letters()[np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    owner = np.repeat(np.arange(len(batch), dtype=np.int32), counts)
    space = points == 32
    keep = np.ones(len(points), dtype=bool)
    keep[1:] = ~(space[1:] & space[:-1] & (owner[1:] == owner[:-1]))
    return points[keep], owner[keep]


def ngrams(points: np.ndarray, owner: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` characters inside a text, and the texts they belong to."""
    n = len(points) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int32)
    wide = points.astype(np.uint64)
    value = np.full(n, size, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j in range(size):
            value = value * np.uint64(0x100000001B3) + wide[j:j + n]
    inside = owner[:n] == owner[size - 1:]
    return mix(value[inside]), owner[:n][inside]


@dataclass
class Filters:
    """The filter table, its languages (bit l is langs[l]), the false-positive rate of each, and the commonest one."""

    langs: list[str]
    table: np.ndarray
    false_rate: np.ndarray
    default: int
    sizes: tuple[int, ...] = SIZES
    hashes: int = HASHES

    def rows(self, hashed: np.ndarray) -> list[np.ndarray]:
        """The table rows of each n-gram."""
        bits, mask = 64 // self.hashes, np.uint64(len(self.table) - 1)
        return [((hashed >> np.uint64(bits * j)) & mask).astype(np.int64) for j in range(self.hashes)]

    def languages(self, hashed: np.ndarray) -> np.ndarray:
        """Per n-gram, the mask of all languages that contain it."""
        found = None
        for at in self.rows(hashed):
            found = self.table[at] if found is None else found & self.table[at]
        return found

    def counts(self, batch: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: corrected count of every language, number of n-grams, whether there is a letter."""
        points, owner = normal(batch)
        n, total = len(batch), np.zeros(len(batch))
        hits = np.zeros((len(batch), len(self.langs)))
        for size in self.sizes:
            hashed, of = ngrams(points, owner, size)
            mask = self.languages(hashed)
            bounds = np.searchsorted(of, np.arange(n + 1))
            total += np.diff(bounds)
            for k in range(len(self.langs)):
                running = np.concatenate([[0], np.cumsum((mask >> self.table.dtype.type(k)) & 1, dtype=np.int64)])
                hits[:, k] += np.diff(running[bounds])
        letter = np.bincount(owner[points != 32], minlength=n) > 0
        return np.clip((hits - total[:, None] * self.false_rate) / (1 - self.false_rate), 0, None), total, letter


def _count_ngrams(sizes: tuple[int, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(language, n-gram) with occurrences and documents, summed within each slice."""
        for batch in batches:
            values, lengths = texts(batch.column(0))
            names = batch.column(1).to_pylist()
            for a, b in slices(lengths, STEP_BYTES):
                points, owner = normal(values[a:b])
                langs, which = np.unique(np.array(names[a:b], dtype=object).astype(str), return_inverse=True)
                for size in sizes:
                    hashed, of = ngrams(points, owner, size)
                    for k, lang in enumerate(langs.tolist()):
                        mine = which[of] == k
                        order = np.lexsort((of[mine], hashed[mine]))
                        h, o = hashed[mine][order], of[mine][order]
                        if not len(h):
                            continue
                        new = np.concatenate([[True], h[1:] != h[:-1]])
                        fresh = new | np.concatenate([[True], o[1:] != o[:-1]])
                        at = np.flatnonzero(new)
                        yield pa.RecordBatch.from_arrays([
                            pa.array([lang] * len(at), pa.string()), pa.array(h[at].view(np.int64)), pa.array(np.diff(np.append(at, len(h)))),
                            pa.array(np.add.reduceat(fresh.astype(np.int64), at))], names=["l", "h", "k", "d"])
    return run


def fit(labelled: DataFrame, *, text: str = "text", lang: str = "lang", sizes: tuple[int, ...] = SIZES,
        filter_rows: int = FILTER_ROWS, fit_rows: int = FIT_ROWS, share: float = SHARE) -> Filters:
    """Filters of every language of `labelled`; rows without language or text teach nothing.

    A language is learned from about `fit_rows` of its different texts, or from all where it has fewer, however rare it is
    among the rows. Copies count once: they are told by a hash, inside the tasks first. The n-grams of the sample are counted per
    language, and the filter rows they set are folded by the tasks. What comes to the driver has at most `filter_rows` rows of
    16 bytes, and a row per language.
    """
    shipped(labelled.sparkSession)
    rows = labelled.select(F.col(text).alias("t"), F.col(lang).alias("l")).where("t is not null and l is not null").withColumn("h", F.xxhash64("t"))
    sizes_in = {r.l: r.n for r in rows.select("l", "h").distinct().groupBy("l").agg(F.count("*").alias("n")).collect()}
    if not sizes_in:
        sample = rows.limit(0).select("t", "l")
    else:
        rate = F.create_map(*[F.lit(x) for v, n in sizes_in.items() for x in (v, int((1 << 30) * min(1.0, fit_rows / n)))])
        chosen_rows = rows.where(F.pmod(F.xxhash64(F.lit(1), "h"), F.lit(1 << 30)) < rate[F.col("l")])
        sample = staged(chosen_rows.groupBy("l", "h").agg(F.first("t").alias("t")).select("t", "l"))
    counted = sample.mapInArrow(_count_ngrams(sizes), "l string, h long, k long, d long") \
        .groupBy("l", "h").agg(F.sum("k").alias("k"), F.sum("d").alias("d"))
    sizes_of = {r.l: (r.k, r.n) for r in sample.groupBy("l").agg(F.sum(F.length("t")).alias("k"), F.count("*").alias("n")).collect()}
    langs = sorted(sizes_of)
    if len(langs) > 64:
        raise ValueError("a mask has room for 64 languages")
    width = next(w for w in (8, 16, 32, 64) if len(langs) <= w)
    table = np.zeros(filter_rows, dtype=f"uint{width}")
    out = Filters(langs, table, np.zeros(len(langs)), 0, sizes)
    if not langs:
        return out
    out.default = max(range(len(langs)), key=lambda i: sizes_of[langs[i]][1])
    at = {v: i for i, v in enumerate(langs)}
    rate = F.create_map(*[F.lit(x) for v in langs for x in (v, float(max(1, sizes_of[v][0])))])
    fewest = F.create_map(*[F.lit(x) for v in langs for x in (v, min(FEWEST, math.ceil(PART * sizes_of[v][1])))])
    rated = counted.withColumn("p", F.col("k") / rate[F.col("l")])
    chosen = rated.groupBy("h").agg(F.max("p").alias("top"), F.collect_list(F.struct("l", "p", "d")).alias("all"))
    chosen = chosen.select("h", F.filter("all", lambda x: (x["p"] >= share * F.col("top"))
                                         & (x["d"] >= fewest[x["l"]]))["l"].alias("ls")).where("size(ls) > 0")
    bit = F.create_map(*[F.lit(x) for i, v in enumerate(langs) for x in (v, i)])
    masked = chosen.select("h", F.aggregate("ls", F.lit(0).cast("long"),
                                            lambda acc, v: acc.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit[v]))).alias("m"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Filter rows that each n-gram sets, with its mask."""
        for batch in batches:
            hashed, mask = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
            at = out.rows(hashed.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(at)), pa.array(np.tile(mask, len(at)))], ["r", "m"])

    rows_set = masked.mapInArrow(place, "r long, m long").groupBy("r").agg(F.bit_or("m").alias("m")).toArrow()
    table[rows_set["r"].to_numpy()] = rows_set["m"].to_numpy().view(np.uint64).astype(table.dtype)
    fill = np.array([((table >> table.dtype.type(k)) & 1).mean() for k in range(len(langs))])
    out.false_rate = np.minimum(fill ** out.hashes, 0.99)
    return out


def verdicts(batch: list[bytes | None], filters: Filters) -> list[dict]:
    """Language, score and coverage of each text."""
    if not filters.langs:
        return [{"lang_pred": "und", "score": 0.0, "coverage": 0.0} for _ in batch]
    counts, total, letter = filters.counts(batch)
    out = []
    for row, n, has in zip(counts, total, letter):
        if not has:
            out.append({"lang_pred": "und", "score": 0.0, "coverage": 0.0})
            continue
        best = int(row.argmax())
        rest = float(np.delete(row, best).max()) if len(row) > 1 else 0.0
        if row[best] <= 0:
            best = filters.default
        share = float(row[best] / (row[best] + rest)) if row[best] > 0 else 0.0
        out.append({"lang_pred": filters.langs[best], "score": share, "coverage": float(min(1.0, row[best] / n)) if n else 0.0})
    return out


def identify(docs: DataFrame, filters: Filters, *, text: str = "text", out: str = "language") -> DataFrame:
    """`docs` with a struct column `out`: `lang_pred`, `score`, `coverage`, from the whole text alone.

    `score` is the winner's part of the two best corrected counts (0 if no language has a hit), `coverage` the part of the
    text's n-grams that the winner contains. Ties go to the language first in order; a text without a hit gets the
    commonest language with score 0. Null texts and texts without a letter are `und`. Repeated rows are each answered; a
    column already called `out` is replaced; without any learned language every text is `und`.
    """
    held = shipped(docs.sparkSession).sparkContext.broadcast(filters)

    @F.arrow_udf(VERDICT)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            values, lengths = texts(column)
            rows: list[dict] = []
            for a, b in slices(lengths, STEP_BYTES):
                rows += verdicts(values[a:b], held.value)
            yield pa.array(rows, pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("coverage", pa.float64())]))

    return docs.withColumn(out, run.asNondeterministic()(F.col(text)))


def keep_identified(docs: DataFrame, filters: Filters, *, text: str = "text", least: float = 0.2) -> DataFrame:
    """Rows of `docs` whose text is in one of the learned languages: not `und`, and at least `least` of its n-grams known.

    Where no language was learned there is nothing to judge by, and all rows stay.
    """
    if not filters.langs:
        return docs
    name = "_language"
    return identify(docs, filters, text=text, out=name).where(
        (F.col(name)["lang_pred"] != "und") & (F.col(name)["coverage"] >= least)).select(*docs.columns)
