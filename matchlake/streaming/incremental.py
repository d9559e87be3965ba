"""Incremental silver load as a stream over the landed files."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..sources import journal
from ..sources.storage import VersionedTable, upsert_partitions


def stream_upsert(spark: SparkSession, source: DataFrame, table: VersionedTable, key: Sequence[str], checkpoint: str,
                  transform: Callable[[DataFrame], DataFrame] = lambda df: df) -> int:
    """Process everything that has arrived, batch by batch, and stop.

    Each micro-batch is transformed and upserted by key into the next version of the table. A batch that is replayed
    after a failure deletes and inserts the same keys again, so the table ends up the same.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        table.upsert(transform(batch), key)

    query = (source.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return query.lastProgress["batchId"] if query.lastProgress else -1


def upsert_once(spark: SparkSession, batch: DataFrame, batch_id: int, path: str, key: Sequence[str], partition: str, name: str,
                moving: bool = True) -> bool:
    """Upsert a micro-batch of the stream ``name`` unless the table has it already.

    The number of the batch is noted by the very swap that puts its rows in place, so a batch that comes again after a failure
    is either finished or skipped, whatever it holds. False if it was skipped.
    """
    journal.recover(spark, path)
    if batch_id <= journal.notes(spark, path).get(name, -1):
        return False
    upsert_partitions(spark, path, batch, key, partition, moving, {name: batch_id})
    return True


def stream_upsert_partitions(spark: SparkSession, source: DataFrame, path: str, key: Sequence[str], partition: str, checkpoint: str,
                             transform: Callable[[DataFrame], DataFrame] = lambda df: df, moving: bool = True) -> int:
    """As ``stream_upsert``, exactly once, into a partitioned table of which a batch rewrites only the partitions it touches.

    Inside a batch the same key may come once only. With ``moving`` a key may come back in another partition, and leaves the old
    one; the keys and partition values of the table are read for that. The checkpoint names the stream.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        upsert_once(spark, transform(batch), batch_id, path, key, partition, checkpoint, moving)

    query = (source.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return query.lastProgress["batchId"] if query.lastProgress else -1


def landed_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)
