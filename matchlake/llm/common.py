"""Helpers shared by the operators: staged tables, bounded slices of Arrow batches, words and label folds."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most bytes of text that one numpy step handles, unless one text alone is longer.
SLICE_BYTES = 8 << 20

#: Most rows and bytes of an Arrow batch between Spark and Python.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20

#: A-Z become a-z; digits, letters and all bytes from 0x80 stay; every other byte parts words.
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
                   for c in range(256))


_SHIPPED: set[str] = set()


def shipped(spark: SparkSession) -> SparkSession:
    """Sends this package's code to the Python workers, once per application; they need not have it on their path.

    Arrow batches get at most `BATCH_ROWS` rows and `BATCH_BYTES`: texts are long, and a batch is held in several places at once.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(tempfile.mkdtemp(prefix="matchlake-"), "matchlake_llm.zip")
        with zipfile.ZipFile(path, "w") as out:
            for folder in (top, os.path.join(top, "llm")):
                for name in sorted(os.listdir(folder)):
                    if name.endswith(".py"):
                        out.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), os.path.dirname(top)))
        context.addPyFile(path)
        _SHIPPED.add(context.applicationId)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A new folder name under `spark.checkpoint.dir`; only a local master may leave that setting unset."""
    root = spark.conf.get("spark.checkpoint.dir", "")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="matchlake-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/matchlake-llm/{uuid.uuid4().hex}"


def staged(df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """`df` written to the shared folder and read again: lineage ends here and lost executors cost no recomputation."""
    path = shared_folder(df.sparkSession)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bits that a filter of keys has for each of them, and at most.
KEY_BITS, MOST_KEY_BITS = 16, 1 << 26


def key_filter(keys: DataFrame, key: str) -> Callable[[Column], Column]:
    """A test of columns that is true for every key of `keys` and for few others (2 in 100 while bits last, more beyond).

    A table of two bits for each key goes to the tasks: wide rows that surely have no partner need not cross the network, or lie on
    disk, to find that out. Keys are still compared by the join that follows.
    """
    n = keys.count()
    bits = min(MOST_KEY_BITS, 1 << max(10, (n * KEY_BITS - 1).bit_length() if n else 0))
    hashed = F.xxhash64(F.col(key))
    at = F.explode(F.array(hashed.bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned(hashed, 32).bitwiseAND(F.lit(bits - 1)))).alias("at")
    held = keys.select(at).groupBy(F.shiftright("at", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(at & 63 AS INT))")).alias("bits")).toArrow()
    table = np.zeros(bits // 64, dtype=np.uint64)
    table[held["word"].to_numpy()] = held["bits"].to_numpy().view(np.uint64)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            x = np.asarray(column.to_numpy(zero_copy_only=False), dtype=np.int64).view(np.uint64)
            found = np.ones(len(x), dtype=np.uint64)
            for place in (x & np.uint64(bits - 1), (x >> np.uint64(32)) & np.uint64(bits - 1)):
                found &= table[place >> np.uint64(6)] >> (place & np.uint64(63))
            yield pa.array(found == 1)

    test = F.arrow_udf(run, "boolean")
    return lambda column: test(F.xxhash64(column))


def trim() -> None:
    """Gives memory that a batch has left free back to the system; workers live on from task to task."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def slices(lengths: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose lengths add up to at most `most`; a longer row stands alone."""
    if not len(lengths):
        return
    total = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    start = 0
    while start < len(lengths):
        stop = int(np.searchsorted(total, total[start] + most, side="right")) - 1
        stop = max(stop, start + 1)
        yield start, stop
        start = stop
    trim()


def texts(column: pa.Array) -> tuple[list[bytes | None], np.ndarray]:
    """UTF-8 bytes of a text column (None for null) and their lengths."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.cast(pa.binary() if not pa.types.is_large_string(column.type) else pa.large_binary()).to_pylist()
    return values, np.fromiter((len(v) if v else 0 for v in values), dtype=np.int64, count=len(values))


def words(text: bytes) -> list[bytes]:
    """Lower-cased runs of letters, digits and non-ASCII bytes."""
    return text.translate(WORD_BYTES).split()


def fold(id_column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; a null id counts as the empty text."""
    return F.crc32(F.encode(F.coalesce(F.col(id_column).cast("string"), F.lit("")), "UTF-8")) % folds


def bounded_sample(df: DataFrame, rows: int, n: int, *keys: str) -> DataFrame:
    """About `rows` of `n` rows, chosen by a hash of `keys`: the same rows whatever the partitioning."""
    if n <= rows:
        return df
    return df.where(F.pmod(F.xxhash64(*keys), F.lit(1 << 30)) < int((1 << 30) * rows / n))


def mix(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """Well spread 64-bit values (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = values.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))
