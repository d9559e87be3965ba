"""Packed token-id matrices: best-fit decreasing with a segment tree over the room left in open sequences.

Each task packs its own documents, a window of bounded size at a time, so ids never move between machines. A sequence is one
row of the matrix: fixed-width little-endian ids, the cumulative segment lengths, and the places where positions restart.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shipped, slices
from .tokens import CAPACITY, END_ID, default_vocabulary, documents, encoder, sizes

#: Ids that a task packs at a time.
WINDOW_IDS = 4 << 20
MATRIX = "sequence_id long, n_ids int, ids binary, cu_seqlens array<int>, position_resets array<int>, " \
         "segments array<struct<doc:long,piece:int,start:long,length:int,offset:int>>"


class RoomTree:
    """Open sequences by the room they have left; finds the least room that is enough, going down a segment tree."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, sequence: int) -> None:
        self.open[room].append(sequence)
        node = room + self.leaves
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """(room, sequence) of the fullest sequence with room for `length`, taken out; None if there is none."""
        node = length + self.leaves
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.leaves
        while node:
            self.count[node] -= 1
            node >>= 1
        return room, self.open[room].pop()


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Sequence and offset of each length, and the number of sequences; ties in the order given."""
    tree, used = RoomTree(capacity), 0
    sequence, offset = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    for k in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[k])
        found = tree.take(n)
        if found is None:
            found, used = (capacity, used), used + 1
        room, sequence[k] = found
        offset[k] = capacity - room
        if room > n:
            tree.add(room - n, found[1])
    return sequence, offset, used


def matrices(held: list[tuple[int | None, np.ndarray]], capacity: int, first: int, width: str) -> tuple[list[dict], int]:
    """Matrix rows of a window of documents, and how many."""
    pieces = [(doc, k, s, ids[s:s + capacity]) for doc, ids in held for k, s in enumerate(range(0, len(ids), capacity))]
    sequence, offset, n = best_fit_decreasing(np.array([len(p[3]) for p in pieces], dtype=np.int64), capacity)
    rows: list[list] = [[] for _ in range(n)]
    for k in np.lexsort((offset, sequence)).tolist():
        rows[sequence[k]].append(k)
    out = []
    for s, members in enumerate(rows):
        ids = np.concatenate([pieces[k][3] for k in members])
        ends = np.cumsum([len(pieces[k][3]) for k in members])
        out.append({"sequence_id": first + s, "n_ids": len(ids), "ids": ids.astype(width).tobytes(),
                    "cu_seqlens": [0, *ends.tolist()], "position_resets": [0, *ends[:-1].tolist()],
                    "segments": [{"doc": pieces[k][0], "piece": pieces[k][1], "start": pieces[k][2], "length": len(pieces[k][3]),
                                  "offset": int(offset[k])} for k in members]})
    return out, n


def pack_matrices(docs: DataFrame, *, key: str = "doc_id", text: str = "text", vocabulary: str | None = None,
                  end_id: int | None = END_ID, capacity: int = CAPACITY, id_bytes: int = 2) -> DataFrame:
    """Rows of `MATRIX`: every id of every document once, in sequences of at most `capacity`.

    Documents longer than `capacity` are split without loss; the last piece may be shorter. `id_bytes` is 2 or 4. Null and
    empty texts have the end id alone; without an end id they have nothing and no segment. Null keys and repeated rows are
    carried along; further columns are not looked at; an empty table gives no sequence.
    """
    spark = shipped(docs.sparkSession)
    with open(vocabulary or default_vocabulary(), encoding="utf-8") as file:
        held = spark.sparkContext.broadcast(file.read())
    width = {2: "<u2", 4: "<u4"}[id_bytes]
    kind = pa.schema([("sequence_id", pa.int64()), ("n_ids", pa.int32()), ("ids", pa.binary()), ("cu_seqlens", pa.list_(pa.int32())),
                      ("position_resets", pa.list_(pa.int32())), ("segments", pa.list_(pa.struct([
                          ("doc", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32()), ("offset", pa.int32())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, window, size = TaskContext.get().partitionId() << 36, [], 0

        def emit() -> Iterator[pa.RecordBatch]:
            nonlocal first, window, size
            rows, n = matrices(window, capacity, first, width)
            first, window, size = first + n, [], 0
            for a in range(0, len(rows), 500):
                yield pa.RecordBatch.from_pylist(rows[a:a + 500], kind)

        with encoder(held.value) as words:
            for batch in batches:
                keys = batch.column(0).to_pylist()
                column = batch.column(1)
                for a, b in slices(sizes(column), 2 << 20):
                    for doc, ids in zip(keys[a:b], documents(*words.encode(column.slice(a, b - a)), end_id)):
                        window.append((doc, ids))
                        size += len(ids)
                    if size >= WINDOW_IDS:
                        yield from emit()
        if window:
            yield from emit()

    return docs.select(F.col(key).cast("long"), F.col(text)).mapInArrow(run, MATRIX)


def segments_of(matrix: DataFrame, *, id_bytes: int = 2) -> DataFrame:
    """One row for each segment of stored matrix rows, its ids cut out again at the cumulative lengths."""
    shipped(matrix.sparkSession)
    width = {2: "<u2", 4: "<u4"}[id_bytes]
    kind = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                      ("ids_crc32", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("n_segments", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for sequence, ids, bounds, segments in zip(*(c.to_pylist() for c in batch.columns)):
                row = np.frombuffer(ids, dtype=width).astype("<u4")
                for a, b, s in zip(bounds[:-1], bounds[1:], segments):
                    out.append({"doc_id": s["doc"], "piece": s["piece"], "start": s["start"], "length": b - a,
                                "ids_crc32": zlib.crc32(row[a:b].tobytes()), "sequence_id": sequence, "offset": a,
                                "n_segments": len(segments)})
            yield pa.RecordBatch.from_pylist(out, kind)

    return matrix.select("sequence_id", "ids", "cu_seqlens", "segments").mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, n_segments int")
