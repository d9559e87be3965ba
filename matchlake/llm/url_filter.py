"""URL filters: rules by host and path, and for all other URLs the ratio of two character language models.

The URLs that the rules accept and reject teach one variable-order Markov model each: counts of all their character windows, from
one character to `ORDER`, smoothed by Witten-Bell: a longer context hands down to the next shorter one as much as it has
different followers. A URL's score is the difference of the two log-likelihoods for each character; a fifth of the taught URLs is
kept from the counts and calibrates where scores part.

URLs travel in packets. What a packet needs to know is asked once for each window in it, so a window that is in every URL
is a row for each packet and not for each URL, and nothing of the models is held whole anywhere.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shipped, staged, texts

#: (verdict, host, path) of the rules.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Characters of the longest window: the last one and its context.
ORDER = 6
#: Characters of the alphabet: ASCII; others are percent-encoded bytes.
ALPHABET = 128
START, END = 2, 3
#: Bytes of URLs that travel together, unless one alone is longer.
PACKET_BYTES = 1 << 19
#: Taught URLs whose hash is 0 modulo this are kept for the calibration.
FOLDS = 5
#: Cells of the calibration's histogram, and the score its ends stand for.
BINS, SPAN = 4096, 8.0

SAFE = bytes(c if 32 < c < 127 else 0 for c in range(256))


def host_of(url: Column) -> Column:
    """What is between the first `://` and the next `/`, `?` or `#`, A-Z lower-cased; empty without `://`."""
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(F.substring(url, F.instr(url, "://") + 3, F.length(url)), "#", 1))
    host = F.substring_index(F.substring_index(rest, "?", 1), "/", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to `?` or `#`; empty without `://`."""
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(F.substring(url, F.instr(url, "://") + 3, F.length(url)), "#", 1))
    plain = F.substring_index(rest, "?", 1)
    return F.coalesce(F.when(F.instr(plain, "/") > 0, F.substring(plain, F.instr(plain, "/"), F.length(plain))), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, at, below in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):  # later ones are asked first
        fits = ((host == at) | F.endswith(host, F.lit("." + at))) & F.startswith(path, F.lit(below))
        rule, verdict = F.when(fits, F.lit(at + below)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def characters(url: bytes) -> np.ndarray:
    """A URL in the alphabet, an end behind it."""
    plain = url if not url.translate(None, SAFE.replace(b"\0", b"")) else b"".join(
        bytes([c]) if SAFE[c] else b"%%%02X" % c for c in url)
    return np.frombuffer(plain + bytes([END]), dtype=np.uint8).astype(np.int64)


def windows(urls: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The longest window at every character of the URLs (short ones are filled up with starts), and the bounds of each URL."""
    parts = []
    for url in urls:
        c = np.concatenate([np.full(ORDER - 1, START, dtype=np.int64), characters(url)])
        keys = np.zeros(len(c) - ORDER + 1, dtype=np.int64)
        for k in range(ORDER):
            keys = keys * ALPHABET + c[k:k + len(keys)]
        parts.append(keys)
    bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    return (np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)), bounds


def suffix(keys: np.ndarray, size: int) -> np.ndarray:
    """The last `size` characters of windows, with their number above them: one key for windows of all sizes."""
    return keys % ALPHABET ** size + (size << 56)


def packets(pages: DataFrame, *, key: str = "page_id", url: str = "url", taught: Column | None = None) -> DataFrame:
    """Rows in packets: `packet`, `ids`, `urls` and `classes` (1 accepted, 0 rejected, null: neither), staged."""
    spark = shipped(pages.sparkSession)
    told = F.lit(None).cast("string") if taught is None else taught
    rows = pages.select(F.col(key).alias("id"), F.col(url).cast("string").alias("url"),
                        F.when(told == "allow", 1).when(told == "block", 0).cast("int").alias("class"))
    id_type = rows.schema["id"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 36, [], 0

        def emit() -> pa.RecordBatch:
            nonlocal number, held, size
            ids, urls, classes = (pa.concat_arrays([b.column(j) for b in held]) for j in range(3))
            ends = pa.array([0, len(ids)], pa.int32())
            out = pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *(
                pa.ListArray.from_arrays(ends, x) for x in (ids, urls, classes))], names=["packet", "ids", "urls", "classes"])
            number, held, size = number + 1, [], 0
            return out

        for batch in batches:
            lengths = texts(batch.column(1))[1] + 8
            total, start = np.cumsum(lengths), 0
            while start < batch.num_rows:
                base = int(total[start - 1]) if start else 0
                stop = max(start + 1, int(np.searchsorted(total, base + PACKET_BYTES - size, side="right")))
                stop = min(stop, batch.num_rows)
                held.append(batch.slice(start, stop - start))
                size += int(total[stop - 1]) - base
                if size >= PACKET_BYTES or stop < batch.num_rows:
                    yield emit()
                start = stop
        if held:
            yield emit()

    return staged(rows.mapInArrow(pack, f"packet long, ids array<{id_type}>, urls array<string>, classes array<int>"))


def _fold_of(urls: list[bytes]) -> np.ndarray:
    return np.array([zlib.crc32(u) % FOLDS for u in urls], dtype=np.int64)


def _urls(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes], np.ndarray]]:
    """Row, URLs and classes (-1: none) of each packet of a batch."""
    for row in range(batch.num_rows):
        urls = [u.encode() if u else b"" for u in batch.column("urls")[row].as_py()]
        yield row, urls, np.array([-1 if c is None else c for c in batch.column("classes")[row].as_py()])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of all sizes in the accepted and rejected URLs of each packet that are not kept for the calibration."""
    kind = pa.schema([("gram", pa.int64()), ("accepted", pa.int64()), ("rejected", pa.int64())])
    for batch in batches:
        for _, urls, classes in _urls(batch):
            use = (classes >= 0) & (_fold_of(urls) != 0) & np.array([len(u) > 0 for u in urls], dtype=bool)
            found, bounds = windows([u for u, ok in zip(urls, use) if ok])
            good = np.repeat(classes[use], np.diff(bounds)).astype(np.int64)
            for size in range(1, ORDER + 1):
                grams, at = np.unique(suffix(found, size), return_inverse=True)
                accepted = np.bincount(at, weights=good, minlength=len(grams)).astype(np.int64)
                every = np.bincount(at, minlength=len(grams)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(grams), pa.array(accepted), pa.array(every - accepted)], schema=kind)


def context_of(gram: Column) -> Column:
    """The window without its last character; one of a size less."""
    size = F.shiftright(gram, 56)
    return F.shiftright(gram.bitwiseAND(F.lit((1 << 56) - 1)), 7) + F.shiftleft(size - 1, 56)


def shorter(gram: Column, size: int) -> Column:
    """Windows of `size` characters without their first one."""
    return gram.bitwiseAND(F.lit(ALPHABET ** (size - 1) - 1)) + F.lit((size - 1) << 56)


def fit(packed: DataFrame) -> DataFrame:
    """Counts of the windows in accepted and rejected URLs with those of their contexts: `gram`, `context`, `accepted`,
    `rejected`, and of the context the sums and the numbers of different followers. Staged; it grows with the taught URLs."""
    shipped(packed.sparkSession)
    counts = packed.select("urls", "classes").mapInArrow(_count, "gram long, accepted long, rejected long") \
        .groupBy("gram").agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))
    return staged(counts.select("gram", context_of(F.col("gram")).alias("context"), "accepted", "rejected"))


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different windows of each packet."""
    kind = pa.schema([("packet", pa.int64()), ("window", pa.int64())])
    for batch in batches:
        for row, urls, _ in _urls(batch):
            found = np.unique(windows([u for u in urls if u])[0])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), batch.column(0)[row].as_py(), dtype=np.int64)),
                                              pa.array(found)], schema=kind)


def window_scores(asked: DataFrame, counts: DataFrame) -> DataFrame:
    """`window`, `ratio` (log odds of its last character after the others, accepted against rejected) for different windows.

    The windows of a size have at most `ALPHABET` rows for a context and for a shorter window, so no join has a hot key.
    """
    followers = counts.groupBy("context").agg(
        F.sum("accepted").alias("sum_a"), F.sum("rejected").alias("sum_r"),
        F.count_if(F.col("accepted") > 0).alias("kinds_a"), F.count_if(F.col("rejected") > 0).alias("kinds_r"))
    sizes = [F.col("window").bitwiseAND(F.lit(ALPHABET ** k - 1)) + F.lit(k << 56) for k in range(1, ORDER + 1)]
    grams = asked.select(F.explode(F.array(*sizes)).alias("gram")).distinct()
    known = staged(grams.withColumn("context", context_of(F.col("gram"))).join(counts.drop("context"), "gram", "left")
                   .join(followers, "context", "left").na.fill(0))

    def given(k: int) -> DataFrame:
        return known.where(F.shiftright("gram", 56) == k)

    def smooth(count: str, total: str, kinds: str, lower: Column) -> Column:
        whole = F.col(total) + F.col(kinds)
        return F.when(whole == 0, lower).otherwise((F.col(count) + F.col(kinds) * lower) / whole)

    base = F.lit(1.0 / ALPHABET)
    level = given(1).select("gram", smooth("accepted", "sum_a", "kinds_a", base).alias("a"), smooth("rejected", "sum_r", "kinds_r", base).alias("r"))
    for k in range(2, ORDER + 1):
        low = level.select(F.col("gram").alias("low"), F.col("a").alias("low_a"), F.col("r").alias("low_r"))
        level = given(k).withColumn("low", shorter(F.col("gram"), k)).join(low, "low").select(
            "gram", smooth("accepted", "sum_a", "kinds_a", F.col("low_a")).alias("a"), smooth("rejected", "sum_r", "kinds_r", F.col("low_r")).alias("r"))
    return level.select(F.col("gram").bitwiseAND(F.lit((1 << 56) - 1)).alias("window"), (F.log("a") - F.log("r")).alias("ratio"))


def scores(packed: DataFrame, counts: DataFrame) -> DataFrame:
    """`id`, `url`, `class`, `score` of every row of the packets: the mean log odds of a character, null for empty URLs."""
    shipped(packed.sparkSession)
    asked = staged(packed.select("packet", "urls", "classes").mapInArrow(_asked, "packet long, window long"))
    known = window_scores(asked.select("window").distinct(), counts)
    answers = asked.join(known, "window").groupBy("packet").agg(F.collect_list(F.struct("window", "ratio")).alias("known"))
    id_type = packed.schema["ids"].dataType.elementType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, urls, _ in _urls(batch):
                known = batch.column("known")[row].values
                values = np.full(len(urls), np.nan)
                some = [i for i, u in enumerate(urls) if u]
                if some:
                    keys, ratios = known.field("window").to_numpy(zero_copy_only=False), known.field("ratio").to_numpy(zero_copy_only=False)
                    turn = np.argsort(keys)
                    found, bounds = windows([urls[i] for i in some])
                    each = ratios[turn[np.searchsorted(keys, found, sorter=turn)]]
                    values[some] = np.add.reduceat(each, bounds[:-1]) / np.diff(bounds)
                columns = [batch.column(name)[row].values for name in ("ids", "urls", "classes")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(values, pa.float64(), mask=np.isnan(values))],
                                                 names=["id", "url", "class", "score"])

    return packed.join(answers, "packet", "left").select("ids", "urls", "classes", "known") \
        .mapInArrow(score, f"id {id_type}, url string, class int, score double")


def threshold(scored: DataFrame) -> float | None:
    """Where scores of taught URLs kept from the counts part best: the middle of the cut with the least sum of the two error
    rates. None where one of the classes has no such URL. Only a histogram of fixed size comes to the driver."""
    kept = scored.where(F.col("class").isNotNull() & F.col("score").isNotNull() & (F.crc32(F.encode("url", "UTF-8")) % FOLDS == 0))
    cell = F.least(F.greatest(F.floor((F.col("score") + SPAN) * (BINS / (2 * SPAN))), F.lit(0)), F.lit(BINS - 1))
    table = np.zeros((2, BINS))
    for c, b, n in kept.groupBy("class", cell.alias("b")).count().collect():
        table[c, b] = n
    if not table.sum(axis=1).all():
        return None
    table /= table.sum(axis=1, keepdims=True)
    lost = np.concatenate([[0], np.cumsum(table[1])])  # accepted ones below the cut
    let = 1 - np.concatenate([[0], np.cumsum(table[0])])  # rejected ones above it
    best = np.flatnonzero(lost + let <= (lost + let).min() + 1e-12)
    return float((best[0] + best[-1]) / 2 * (2 * SPAN / BINS) - SPAN)


def judge(pages: DataFrame, *, rules: Sequence[tuple[str, str, str]] = RULES, key: str = "page_id", url: str = "url") -> DataFrame:
    """`key`, `host`, `path`, `rule`, `verdict` (allow or block) and `score` for every row.

    The longest rule that fits decides. All other URLs are blocked if their score is below the calibrated threshold. Null and
    empty URLs have no score and are allowed, as are all where the rules reject or accept too few URLs to teach and
    calibrate both models. Null keys and repeated rows are kept; further columns are not looked at; an empty table gives no rows.
    Rules are part of the plan, so there should be some hundreds at most.
    """
    here = F.col(url).cast("string")
    taught = rule_of(host_of(here), path_of(here), rules)[1]
    packed = packets(pages, key=key, url=url, taught=taught)
    scored = staged(scores(packed, fit(packed)))
    cut = threshold(scored)
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rule, said = rule_of(F.col("host"), F.col("path"), rules)
    ratio = F.when(F.col("score") < (-math.inf if cut is None else cut), "block").otherwise("allow")
    return scored.withColumns({"host": host, "path": path}).select(
        F.col("id").alias(key), "host", "path", rule.alias("rule"), F.coalesce(said, ratio).alias("verdict"), "score")
