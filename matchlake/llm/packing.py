"""Packing pieces into as few sequences as possible by linear grouping.

The lengths of all pieces are counted; there are at most `capacity` different ones, so the whole plan is made from that
histogram. Large lengths are cut into groups of equal cardinality and rounded up to the longest of their group. For these
few sizes the linear programme over configurations is solved by column generation. Every slot then takes an actual piece of
its group, which never is longer, and the small pieces go best-fit into what is left. A piece finds its place by its length
and its rank among the pieces of that length.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import shipped, staged

GROUPS = 96
#: Lengths from this part of the capacity on are large.
LARGE = 1 / 3
#: Steps of the linear programme; what it has then is used, the rest goes best-fit.
STEPS = 1500


def best_configuration(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable way to fill a sequence with pieces of these sizes, and how many of each it takes."""
    gain, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    smallest = int(sizes.min())
    for room in range(smallest, capacity + 1):
        fits = room >= sizes
        option = np.where(fits, gain[np.maximum(room - sizes, 0)] + values, -1.0)
        k = int(option.argmax())
        if option[k] > gain[room - 1] + 1e-12:
            gain[room], choice[room] = option[k], k
        else:
            gain[room] = gain[room - 1]
    counts, room = np.zeros(len(sizes)), capacity
    while room >= smallest:
        if choice[room] < 0:
            room -= 1
            continue
        counts[choice[room]] += 1
        room -= int(sizes[choice[room]])
    return float(gain[capacity]), counts


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, steps: int = STEPS) -> list[tuple[np.ndarray, int]]:
    """Few configurations and how often to use each, covering at most the demand: the optimum of the relaxed problem,
    rounded down."""
    k = len(sizes)
    basis = np.diag((capacity // sizes).astype(float))
    inverse = np.linalg.inv(basis)
    amount = inverse @ demand
    for step in range(steps):
        duals = inverse.sum(axis=0)
        value, column = best_configuration(sizes, np.maximum(duals, 0), capacity)
        if value <= 1 + 1e-7:
            break
        enter = inverse @ column
        ratio = np.where(enter > 1e-9, amount / np.where(enter > 1e-9, enter, 1), np.inf)
        leave = int(ratio.argmin())
        if not np.isfinite(ratio[leave]):
            break
        basis[:, leave] = column
        if step % 50 == 49:
            inverse = np.linalg.inv(basis)
        else:
            row = inverse[leave] / enter[leave]
            inverse = inverse - np.outer(enter, row)
            inverse[leave] = row
        amount = np.maximum(inverse @ demand, 0)
    return [(basis[:, j].astype(np.int64), int(amount[j] + 1e-6)) for j in range(k) if int(amount[j] + 1e-6) > 0]


class Plan:
    """Runs of places: pieces of one length, from one rank on, put `per` a sequence into sequences in a row."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.rows: list[tuple[int, int, int, int, int]] = []  # length, first rank, first sequence, per sequence, offset
        self.sequences = 0
        self.room: dict[int, list[tuple[int, int]]] = {}  # room left -> (first sequence, how many)
        self.rooms: list[int] = []

    def leave(self, room: int, first: int, count: int) -> None:
        if room <= 0 or count <= 0:
            return
        if room not in self.room:
            self.room[room] = []
            insort(self.rooms, room)
        self.room[room].append((first, count))

    def best_fit(self, length: int, rank: int, count: int) -> None:
        """Puts pieces of one length, each into the fullest sequence that takes it."""
        while count:
            at = bisect_left(self.rooms, length)
            if at == len(self.rooms):
                need = -(-count // (self.capacity // length))
                self.leave(self.capacity, self.sequences, need)
                self.sequences += need
                continue
            room = self.rooms[at]
            first, free = self.room[room].pop()
            if not self.room[room]:
                del self.room[room]
                del self.rooms[at]
            per = min(room // length, count)
            used = min(free, count // per)
            self.rows.append((length, rank, first, per, self.capacity - room))
            self.leave(room - per * length, first, used)
            self.leave(room, first + used, free - used)
            rank, count = rank + used * per, count - used * per

    def substitute(self, taken: list[tuple[np.ndarray, int]], groups: list[list[list[int]]]) -> None:
        """Fills the slots of the configurations from the groups' (length, rank, count) runs, which shrink."""
        for column, times in taken:
            parts = [(self.sequences, times, 0)]  # sequences in a row with equal use
            self.sequences += times
            for g, slots in enumerate(column.tolist()):
                for _ in range(slots):
                    later = []
                    for first, count, used in parts:
                        while count and groups[g]:
                            run = groups[g][0]
                            n = min(count, run[2])
                            self.rows.append((run[0], run[1], first, 1, used))
                            later.append((first, n, used + run[0]))
                            run[1], run[2] = run[1] + n, run[2] - n
                            first, count = first + n, count - n
                            if not run[2]:
                                groups[g].pop(0)
                        if count:
                            later.append((first, count, used))
                    parts = later
            for first, count, used in parts:
                self.leave(self.capacity - used, first, count)


def plan(histogram: dict[int, int], capacity: int, groups: int = GROUPS, large: float = LARGE) -> Plan:
    """Places for all pieces of a histogram of lengths (1 to `capacity`)."""
    out = Plan(capacity)
    rest: list[tuple[int, int, int]] = []
    big = [(n, c) for n, c in sorted(histogram.items(), reverse=True) if n >= large * capacity and n < capacity]
    total = sum(c for _, c in big)
    runs: list[list[list[int]]] = [[]]
    share, filled = -(-total // max(1, groups)), 0
    for length, count in big:
        rank = 0
        while count:
            if filled == share:
                runs.append([])
                filled = 0
            n = min(count, share - filled)
            runs[-1].append([length, rank, n])
            rank, count, filled = rank + n, count - n, filled + n
    if total:
        sizes = np.array([g[0][0] for g in runs], dtype=np.int64)
        same, of = np.unique(sizes, return_inverse=True)
        merged: list[list[list[int]]] = [[] for _ in same]
        for g, k in zip(runs, of.tolist()):
            merged[k] += g
        demand = np.array([sum(r[2] for r in g) for g in merged], dtype=float)
        out.substitute(configurations(same, demand, capacity), merged)
        rest += [tuple(r) for g in merged for r in g]
    rest += [(n, 0, c) for n, c in histogram.items() if n < large * capacity or n == capacity]
    for length, rank, count in sorted(rest, reverse=True):
        out.best_fit(length, rank, count)
    return out


def _local_rank(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The task, and each row's rank among the rows of equal length that the task has had so far."""
    part, seen = TaskContext.get().partitionId(), Counter()
    for column in batches:
        ranks = []
        for n in column.to_pylist():
            ranks.append(seen[n])
            seen[n] += 1
        yield pa.StructArray.from_arrays([pa.array([part] * len(ranks), pa.int32()), pa.array(ranks, pa.int64())], ["part", "rank"])


def pack(pieces: DataFrame, *, length: str = "length", capacity: int = 4096, groups: int = GROUPS) -> DataFrame:
    """`pieces` with `sequence_id` and `offset`: places in sequences of at most `capacity`, none overlapping, no gaps.

    Lengths are 1 to `capacity`; a null or other length is an error of the caller and raises. The driver sees one count for
    each length, and the tasks get a plan of some thousand runs, whatever the number of rows. Equal lengths are numbered
    within each task first, so a length that a third of all rows share needs no task of its own. An empty table gives an
    empty result; columns already called `sequence_id` or `offset` are replaced; ties and repeated rows each get a place.
    """
    spark = shipped(pieces.sparkSession)
    # what makes the pieces has Python workers of its own; staged, theirs have ended before those of the ranks begin
    rows = staged(staged(pieces.drop("sequence_id", "offset")).withColumn("_r",
        F.arrow_udf(_local_rank, "struct<part:int,rank:long>").asNondeterministic()(F.col(length).cast("long"))))
    rows = rows.withColumns({"_part": F.col("_r.part"), "_rank": F.col("_r.rank"), "_n": F.col(length).cast("long")})
    counts = rows.groupBy("_n", "_part").agg(F.count("*").alias("_k"))
    histogram = {r["_n"]: r["k"] for r in counts.groupBy("_n").agg(F.sum("_k").alias("k")).collect()}
    if any(n is None or not 1 <= n <= capacity for n in histogram):
        raise ValueError("lengths must be from 1 to the capacity")
    found = plan(histogram, capacity, groups)
    runs = np.array(sorted(found.rows), dtype=np.int64).reshape(-1, 5)
    held = spark.sparkContext.broadcast(runs)
    before = Window.partitionBy("_n").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("_n", "_part", F.coalesce(F.sum("_k").over(before), F.lit(0)).alias("_base"))

    @F.arrow_udf("struct<sequence_id:long,offset:long>")
    def place(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        runs_ = held.value
        keys = (runs_[:, 0] << 48) | runs_[:, 1]
        for n, rank in batches:
            n, rank = n.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False)
            run = runs_[np.searchsorted(keys, (n << 48) | rank, side="right") - 1]
            inside = rank - run[:, 1]
            yield pa.StructArray.from_arrays([pa.array(run[:, 2] + inside // run[:, 3]), pa.array(run[:, 4] + inside % run[:, 3] * n)],
                                             ["sequence_id", "offset"])

    return rows.join(bases, ["_n", "_part"]).withColumn("_at", place.asNondeterministic()("_n", F.col("_rank") + F.col("_base"))) \
        .select(*[c for c in pieces.columns if c not in ("sequence_id", "offset")], "_at.sequence_id", "_at.offset")
