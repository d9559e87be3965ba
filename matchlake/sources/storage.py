"""Where intermediate tables live, versioned tables, partition replacement, publishing."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..operators.upsert import delete_insert
from . import journal
from .journal import file_system as _file_system


#: Bytes of files, and bytes of measured rows, up to which a side of a join is broadcast.
PLANNED_BROADCAST, MEASURED_BROADCAST = 256 << 10, 10 << 20
#: Partition values that a task writes side by side; with more of them it sorts its rows.
OPEN_FILES = 16


#: Bytes of match tables for each partition of a shuffle, and bytes of files that a task reads and that partitions are joined up to.
#: Files are packed: rows of a task are many times as large, and must be sorted and folded in its memory at any size of the input.
DEALT_BYTES, TASK_BYTES = 4 << 20, 16 << 20


def _bytes(text: str) -> int:
    """A size as Spark writes it, in bytes if it has no unit."""
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", text.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def fit_partitions(spark: SparkSession, *tables: str) -> None:
    """As many partitions as the tables need, so that what a task holds does not grow with them. More of them in the session stay."""
    size = 0
    for path in tables:
        fs, table = _file_system(spark, path)
        size += fs.getContentSummary(table).getLength() if fs.exists(table) else 0
    if int(spark.conf.get("spark.sql.shuffle.partitions")) < (wanted := size // DEALT_BYTES):
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))


def configure(spark: SparkSession) -> None:
    """Session settings the plans rely on."""
    for limit in ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes"):
        if _bytes(spark.conf.get(limit)) > TASK_BYTES:
            spark.conf.set(limit, str(TASK_BYTES))
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # rows that lie by match are joined by match and player where they are
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    # a task that writes few seasons keeps a file open for each, and does not sort its rows by season first
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", str(OPEN_FILES))
    # a plan knows the sizes of files, which may be packed fifty times smaller than the rows that a broadcast makes of them; so it
    # broadcasts what is small even then, and the rest once its rows have been measured
    planned = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    if planned > PLANNED_BROADCAST:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(PLANNED_BROADCAST))
        if spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None) is None:
            spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", str(min(planned, MEASURED_BROADCAST)))
    try:
        # call-site capture on every column expression costs seconds on wide plans
        spark.conf.set("spark.python.sql.dataFrameDebugging.enabled", "false")
    except Exception:  # a fixed setting in this Spark build
        pass


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir`` of the session.

    Only a local master may fall back to a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="matchlake-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def workspace(spark: SparkSession) -> str:
    """A fresh folder inside the shared folder, removed when the session's JVM ends."""
    path = f"{shared_folder(spark)}/matchlake-{spark.sparkContext.applicationId}-{uuid.uuid4().hex[:12]}"
    fs, root = _file_system(spark, path)
    fs.mkdirs(root)
    fs.deleteOnExit(root)
    return path


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table that nothing reads any more."""
    fs, folder = _file_system(spark, path)
    fs.delete(folder, True)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), rebalance: bool = True) -> None:
    """Overwrite a parquet table. Rows are rebalanced by partition value first, so hot values are split over several
    files and small ones share a task. Without ``rebalance`` they do not cross the network for that, and every task writes a
    file for each value it has: for large rows and few values."""
    writer = (df.hint("rebalance", *partition_by) if partition_by and rebalance else df).write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).mode("overwrite").parquet(path)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` written down once, so that a join with them knows how large they are."""
    path = f"{workspace(df.sparkSession)}/{name}"
    write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class VersionedTable:
    """A parquet table that is replaced by writing the next version; readers take the newest complete one.

    A version counts once its ``_SUCCESS`` marker exists, so a lost job leaves the previous version in place and a table
    can be rewritten from its own content.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _versions(self) -> list[int]:
        jvm = self.spark._jvm
        fs, root = _file_system(self.spark, self.path)
        if not fs.exists(root):
            return []
        done = []
        for status in fs.listStatus(root):
            name = status.getPath().getName()
            marker = jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
            if name.startswith("v=") and fs.exists(marker):
                done.append(int(name[2:]))
        return sorted(done)

    def version(self) -> int | None:
        found = self._versions()
        return found[-1] if found else None

    def read(self) -> DataFrame | None:
        newest = self.version()
        return None if newest is None else self.spark.read.parquet(f"{self.path}/v={newest:08d}")

    def write(self, df: DataFrame, partition_by: Sequence[str] = ()) -> int:
        following = (self.version() or 0) + 1
        write_table(df, f"{self.path}/v={following:08d}", partition_by)
        self._drop_before(following - 1)
        return following

    def _drop_before(self, version: int) -> None:
        """Remove versions older than ``version``; the one before the newest stays for readers that have opened it."""
        fs, _ = _file_system(self.spark, self.path)
        for old in self._versions():
            if old < version:
                fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/v={old:08d}"), True)

    def upsert(self, batch: DataFrame, key: Sequence[str] | str) -> int:
        current = self.read()
        return self.write(batch if current is None else delete_insert(current, batch, key))


#: Folder that stands for a NULL partition value.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def folder_state(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and times of the tables in a folder; differs when a table has been written anew."""
    fs, root = _file_system(spark, path)
    return tuple(sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(root)))


def stored(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    """The table at ``path`` with the types of ``schema`` and whatever further columns it has; None if there is none.

    The schema is given, so that partition values keep their type: a text ``01`` does not turn into a number, and a table
    that has only NULL partitions can be read. A swap that was cut short is finished first.
    """
    if journal.recover(spark, path):
        spark.catalog.refreshByPath(path)
    fs, root = _file_system(spark, path)
    if not fs.exists(root) or not any(s.isDirectory() or s.getPath().getName().startswith("part-") for s in fs.listStatus(root)):
        return None
    known = set(schema.names)
    more = [f for f in spark.read.parquet(path).schema if f.name not in known]
    return spark.read.schema(StructType([*schema.fields, *more])).parquet(path)


def _swap_partitions(spark: SparkSession, staged: str, path: str, column: str, emptied: Callable[[str], bool],
                     notes: Mapping | None = None) -> None:
    """Put the staged partitions in the place of those of ``path`` and remove those in scope that have no rows any more."""
    fs, source = _file_system(spark, staged)
    _, target = _file_system(spark, path)
    fs.mkdirs(target)
    fresh = {s.getPath().getName() for s in fs.listStatus(source) if s.getPath().getName().startswith(f"{column}=")}
    gone = [s.getPath().getName() for s in fs.listStatus(target) if s.getPath().getName().startswith(f"{column}=")]
    journal.swap(spark, path, {f"{staged}/{name}": f"{path}/{name}" for name in fresh},
                 [f"{path}/{name}" for name in gone if name not in fresh and emptied(unquote(name.split("=", 1)[1]))], notes)
    spark.catalog.refreshByPath(path)


def _merge_partitions(spark: SparkSession, path: str, batch: DataFrame, partition: str, kept: Callable[[DataFrame], DataFrame],
                      emptied: Callable[[str], bool], scope: Column | None = None, more: DataFrame | None = None,
                      notes: Mapping | None = None) -> None:
    """Rewrite the partitions that the batch, ``scope`` or ``more`` touches: what ``kept`` leaves of their old rows, and the batch."""
    current = stored(spark, path, batch.schema)
    staged = journal.staging(path)
    if current is None:
        write_table(batch, staged, [partition])
    else:
        touched = batch.select(F.col(partition).alias("_touched")).distinct()
        if scope is not None:
            touched = touched.union(current.filter(F.coalesce(scope, F.lit(False))).select(F.col(partition).alias("_touched")))
        if more is not None:
            touched = touched.union(more)
        near = current.join(touched.distinct(), current[partition].eqNullSafe(F.col("_touched")), "left_semi")
        write_table(kept(near).unionByName(batch, allowMissingColumns=True), staged, [partition])
    _swap_partitions(spark, staged, path, partition, emptied, notes)


def replace_table(spark: SparkSession, path: str, df: DataFrame, partition_by: Sequence[str] = (), notes: Mapping | None = None,
                  rebalance: bool = True) -> None:
    """Put a new table in the place of the one at ``path``, which it may have been read from."""
    journal.recover(spark, path)
    staged = journal.staging(path)
    write_table(df, staged, partition_by, rebalance)
    journal.swap(spark, path, {staged: path}, notes=notes)
    spark.catalog.refreshByPath(path)


def replace_scope(spark: SparkSession, path: str, batch: DataFrame, scope: str, lo=None, hi=None,
                  seasons: Sequence | None = None) -> None:
    """Reload a bronze table: everything, whole seasons, or a closed date window.

    Rows inside the scope go, the batch is added, all others stay, also in partitions that both share and where the date
    is NULL. ``seasons`` names the seasons that are reloaded, those of the batch if not given; a season with an empty reload
    loses its rows. ``season`` and ``date`` tables are partitioned by ``_season_id`` / ``_fixture_date``. The new content is
    complete before the old one is touched, so a batch may read the table it replaces.
    """
    if scope == "global":
        replace_table(spark, path, batch)
        return
    column = {"season": "_season_id", "date": "_fixture_date"}[scope]
    if scope == "date":
        inside = F.col(column).between(F.lit(str(lo)).cast("date"), F.lit(str(hi)).cast("date"))
        _merge_partitions(spark, path, batch, column, lambda old: old.filter(~F.coalesce(inside, F.lit(False))),
                          lambda v: str(lo) <= v <= str(hi), inside)
    elif seasons is None:
        _merge_partitions(spark, path, batch, column, lambda old: old.limit(0), lambda v: False)
    else:
        inside = F.col(column).isin(*seasons) if seasons else F.lit(False)
        names = {str(v) for v in seasons}
        _merge_partitions(spark, path, batch, column, lambda old: old.filter(~F.coalesce(inside, F.lit(False))),
                          lambda v: v in names, inside)


def upsert_partitions(spark: SparkSession, path: str, batch: DataFrame, key: Sequence[str], partition: str, moving: bool = False,
                      notes: Mapping | None = None, keys: DataFrame | None = None) -> None:
    """delete+insert that rewrites only the partitions the batch touches, NULL being one of them.

    The key must contain, or determine, the partition column, unless rows may be ``moving``: then the partitions that hold a
    key of the batch so far are rewritten too (keys and partition column of the table are read for that). Which partitions
    are touched is a semi join, so nothing is collected; a missing table is created. ``notes`` are stored with the swap.
    ``keys`` names what is replaced where that is more than the batch has rows for: keys and the partitions they may be in.
    """
    replaced = (batch if keys is None else keys).select(*key).distinct()
    held, left = None if keys is None else keys.select(F.col(partition).alias("_touched")).distinct(), set()
    if moving and (current := stored(spark, path, batch.schema)) is not None:
        old = current.select(*key, partition).join(replaced, list(key), "left_semi").select(F.col(partition).alias("_touched")).distinct()
        held = old if held is None else held.union(old).distinct()
    if held is not None:
        # no more values than the table has folders; those that lose all their rows are removed
        left = {NULL_FOLDER if r[0] is None else str(r[0]) for r in held.toLocalIterator()}
    _merge_partitions(spark, path, batch, partition, lambda old: old.join(replaced, list(key), "left_anti").select(*old.columns),
                      lambda v: v in left, more=held, notes=notes)


def publish(spark: SparkSession, tables: dict[str, DataFrame], target: str, schemas: Sequence[str] | None = None,
            views: dict[str, str] | None = None) -> DataFrame:
    """Copy ``schema.table`` relations into ``target``, register views, return (table_name, row_count).

    All copies are complete before the first one takes its place, and one journal moves them all: readers that open the target
    through ``recover_published`` see all tables of this call or none.
    """
    target, counts = target.rstrip("/"), None
    journal.recover(spark, target)
    staged = journal.staging(target)
    names = [n for n in sorted(tables) if not schemas or n.split(".")[0] in schemas]
    for name in names:
        tables[name].write.parquet(f"{staged}/{name}")
        one = spark.read.parquet(f"{staged}/{name}").agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        # taken before the folder moves; a row a table
        one = spark.createDataFrame(one.collect(), one.schema)
        counts = one if counts is None else counts.unionByName(one)
    journal.swap(spark, target, {f"{staged}/{n}": f"{target}/{n.replace('.', '/')}" for n in names})
    spark.catalog.refreshByPath(target)
    for view, sql in (views or {}).items():
        spark.sql(sql).createOrReplaceTempView(view)
    return counts


def recover_published(spark: SparkSession, target: str) -> None:
    """Finish a publication that was cut short after it had been decided, or forget one that had not."""
    if journal.recover(spark, target.rstrip("/")):
        spark.catalog.refreshByPath(target)
