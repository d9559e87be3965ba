"""Hard negatives: for an anchor and each of its positives, the best rows of other labels whose score is within given shares.

Anchors are dealt into clusters of near directions. For a cluster, the rows of a block are sorted once by the most that any member
can score with them: the row's norm times the cosine of its angle to the cluster's centre, less the cluster's widest angle.
All members walk that list from its head in steps, and a member stops where the bound falls below what it still needs:
from there on no row can be among its answers. Answers are exact; bad clusters only make walks longer.

Blocks of rows lie in tasks; groups of anchors, the smaller side, are sent to every block and pass by one at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import shipped, staged

#: Positives of an anchor, negatives of a positive, and the shares of the positive's score (in percent) that negatives may have.
POSITIVES, NEGATIVES, LEAST, MOST = 5, 3, 50, 95
#: Components are multiplied by this and rounded down.
SCALE = 256
#: Anchors of a group, rows of a chunk, rows of a block (on average), and rows of a step of the walk.
GROUP, CHUNK, BLOCK, STEP = 256, 4096, 1 << 17, 1024
#: Anchors that the cluster centres are fitted on, and centres at most.
FIT_ANCHORS, CENTRES = 16_384, 4096

ROWS = "id long, label int, dim int, vector binary, anchor boolean"
_ROWS = pa.schema([("id", pa.int64()), ("label", pa.int32()), ("dim", pa.int32()), ("vector", pa.binary()), ("anchor", pa.bool_())])
PACKED = "block int, kind int, part long, dim int, n int, ids binary, labels binary, vectors binary, extra string"
_PACKED = pa.schema([("block", pa.int32()), ("kind", pa.int32()), ("part", pa.int64()), ("dim", pa.int32()), ("n", pa.int32()),
                     ("ids", pa.binary()), ("labels", pa.binary()), ("vectors", pa.binary()), ("extra", pa.string())])
#: Components beyond this are taken for it, so that they fit in 64 bits.
EDGE = 2.0 ** 62
LOWEST, HIGHEST = -(2 ** 63), 2 ** 63 - 1


def _quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole components as bytes, two a component where that is enough, else eight; rows that take no part are left out."""
    for batch in batches:
        column = batch.column(2)
        bounds = column.offsets.to_numpy().astype(np.int64)
        values = column.values.slice(bounds[0], bounds[-1] - bounds[0]).to_numpy(zero_copy_only=False).astype(np.float64)
        bounds = bounds - bounds[0]
        bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
        fine = column.is_valid().to_numpy(zero_copy_only=False) & (bad[bounds[1:]] == bad[bounds[:-1]])
        with np.errstate(over="ignore", invalid="ignore"):
            whole = np.clip(np.nan_to_num(np.floor(values * float(SCALE)), posinf=EDGE, neginf=-EDGE), -EDGE, EDGE).astype("<i8")
        short = whole.astype("<i2")
        wide = np.concatenate([[0], np.cumsum((whole != short) | (short == -(2 ** 15)))])
        rows = np.flatnonzero(fine)
        spans = [(int(bounds[i]), int(bounds[i + 1])) for i in rows]
        taken = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays([
            batch.column(0).take(taken), batch.column(1).take(taken), pa.array([b - a for a, b in spans], pa.int32()),
            pa.array([(short if wide[a] == wide[b] else whole)[a:b].tobytes() for a, b in spans], pa.binary()),
            batch.column(3).take(taken)], schema=_ROWS)


def matrix(vectors: list[bytes], dim: int) -> np.ndarray:
    """Rows of whole components, in 16 bits if all rows are."""
    if not dim or not vectors:
        return np.zeros((len(vectors), dim), dtype=np.int16)
    if all(len(v) == 2 * dim for v in vectors):
        return np.frombuffer(b"".join(vectors), dtype="<i2").reshape(-1, dim)
    return np.array([np.frombuffer(v, dtype="<i2" if len(v) == 2 * dim else "<i8") for v in vectors], dtype=np.int64)


def _pack(most: int, kind: int):
    """Rows in order of (block, length of the vector) become packed rows of at most `most`, one block and length each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held, part = None, [], 0

        def emit() -> pa.RecordBatch:
            nonlocal held, part
            (block, dim), n = here, len(held)
            ids, labels, vectors, extra = zip(*held)
            out = pa.RecordBatch.from_pylist([{
                "block": block, "kind": kind, "part": part, "dim": dim, "n": n, "ids": np.array(ids, dtype="<i8").tobytes(),
                "labels": np.array(labels, dtype="<i4").tobytes(), "vectors": matrix(vectors, dim).tobytes(),
                "extra": ";".join(extra) if extra[0] is not None else None}], _PACKED)
            held, part = [], part + 1
            return out

        for batch in batches:
            for block, dim, id_, label, vector, extra in zip(*(c.to_pylist() for c in batch.columns)):
                if held and (here != (block, dim) or len(held) >= most):
                    yield emit()
                here = (block, dim)
                held.append((id_, label, vector, extra))
        if held:
            yield emit()

    return run


def unpacked(n: int, dim: int, ids: bytes, labels: bytes, vectors: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    kind = "<i2" if len(vectors) == 2 * n * dim else "<i8"
    whole = np.frombuffer(vectors, dtype=kind).reshape(n, dim) if dim else np.zeros((n, 0), dtype=np.int16)
    return np.frombuffer(ids, "<i8"), np.frombuffer(labels, "<i4"), whole


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole rows: in single or double precision where these hold every sum, else in Python integers;
    products beyond 64 bits are taken for the last number of 64 bits."""
    most = max(1, a.shape[1])
    for x in (a, b):
        most *= float(np.abs(x.astype(np.float64)).max(initial=0))
    for kind, whole in ((np.float32, 2.0 ** 24), (np.float64, 2.0 ** 53)):
        if most < whole:
            return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)
    if most < 2.0 ** 62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    exact = a.astype(np.int64).astype(object) @ b.astype(np.int64).astype(object).T
    return np.clip(exact, LOWEST, HIGHEST).astype(np.int64)


class Best:
    """The first `k` rows of each of many lists: higher scores first, then smaller ids."""

    def __init__(self, lists: int, k: int) -> None:
        self.k = k
        self.last = np.full(lists, LOWEST, dtype=np.int64)
        self.rows: dict[int, list[tuple[int, int]]] = {}

    def add(self, which: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Offers rows to lists."""
        if not len(which):
            return
        order = np.lexsort((ids, -scores.astype(np.float64), which))  # exact order within a list is made below
        which, scores, ids = which[order], scores[order], ids[order]
        starts = np.flatnonzero(np.concatenate([[True], which[1:] != which[:-1]]))
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(which)]):
            keep = slice(a, b) if np.abs(scores[a:b]).max() >= 2 ** 53 else slice(a, min(b, a + self.k))
            mine = self.rows.setdefault(int(which[a]), [])
            mine.extend((-int(s), int(i)) for s, i in zip(scores[keep], ids[keep]))
            mine.sort()
            del mine[self.k:]
            if len(mine) == self.k:
                self.last[which[a]] = -mine[-1][0]


class Block:
    """The rows of one block, by length of vectors."""

    def __init__(self) -> None:
        self.chunks: dict[int, list[tuple]] = {}
        self.rows: dict[int, tuple] = {}

    def add(self, dim: int, chunk: tuple) -> None:
        self.chunks.setdefault(dim, []).append(chunk)

    def of(self, dim: int) -> tuple | None:
        """Ids, labels, vectors and norms of the rows of a length."""
        if dim in self.chunks:
            ids, labels, vectors = (np.concatenate(x) for x in zip(*self.chunks.pop(dim)))
            self.rows[dim] = ids, labels, vectors, norms(vectors)
        return self.rows.get(dim)


def norms(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", vectors, vectors, dtype=np.float64))


def walk(anchors: np.ndarray, rows: tuple) -> Iterator[tuple[np.ndarray, float]]:
    """The rows of a block in the order of their bound for a cluster, in steps: their positions, and what a member of norm 1 can
    score at most with any of them or of those behind them."""
    _, _, vectors, norm = rows
    own = norms(anchors)
    unit = anchors[own > 0] / own[own > 0, None]
    centre = unit.sum(axis=0)
    length = float(np.sqrt(centre @ centre))
    bound = norm.copy()
    if length > 1e-9:
        centre = centre / length
        widest = float(np.arccos(np.clip(unit @ centre, -1, 1)).max())
        cosine = (vectors @ centre) / np.where(norm > 0, norm, 1)
        bound = norm * np.cos(np.maximum(0, np.arccos(np.clip(cosine, -1, 1)) - widest))
    bound = bound + norm * 1e-6 + 1e-9  # rounding of angles makes no bound too small
    order = np.argsort(-bound, kind="stable")
    for a in range(0, len(order), STEP):
        yield order[a:a + STEP], float(bound[order[a]])


def positives_of(group: tuple, rows: tuple, k: int) -> Best:
    """The `k` best rows of an anchor's own label in a block."""
    ids, labels, anchors = group
    norm, best, active = norms(anchors), Best(len(ids), k), np.arange(len(ids))
    for part, bound in walk(anchors, rows):
        active = active[norm[active] * bound >= best.last[active]]
        if not len(active):
            break
        part = part[np.isin(rows[1][part], labels[active])]
        if not len(part):
            continue
        scores = product(anchors[active], rows[2][part])
        a, b = np.nonzero((rows[1][part][None, :] == labels[active][:, None]) & (rows[0][part][None, :] != ids[active][:, None])
                          & (scores >= best.last[active][:, None]))
        best.add(active[a], scores[a, b], rows[0][part[b]])
    return best


def negatives_of(group: tuple, rows: tuple, of: np.ndarray, low: np.ndarray, high: np.ndarray, k: int) -> Best:
    """The `k` best rows of other labels within each span of scores: from `low` to `high`, for the anchor at place `of`."""
    ids, labels, anchors = group
    norm, best, active = norms(anchors), Best(len(of), k), np.flatnonzero(low <= high)
    for part, bound in walk(anchors, rows):
        needed = np.maximum(best.last, low)
        active = active[norm[of[active]] * bound >= needed[active]]
        if not len(active):
            break
        members, at = np.unique(of[active], return_inverse=True)
        scores = product(anchors[members], rows[2][part])
        other = (rows[1][part][None, :] != labels[members][:, None]) & (rows[0][part][None, :] != ids[members][:, None])
        scores = np.where(other, scores, LOWEST)[at]
        a, b = np.nonzero((scores >= needed[active][:, None]) & (scores <= high[active][:, None]) & other[at])
        best.add(active[a], scores[a, b], rows[0][part[b]])
    return best


def centres(vectors: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means of a bounded sample."""
    v = vectors.astype(np.float64)
    v = v / np.maximum(np.sqrt((v * v).sum(axis=1, keepdims=True)), 1e-12)
    out = v[np.random.default_rng(11).permutation(len(v))[:k]]
    for _ in range(rounds):
        nearest = np.concatenate([(v[a:a + 1024] @ out.T).argmax(axis=1) for a in range(0, len(v), 1024)])
        sums = np.zeros_like(out)
        np.add.at(sums, nearest, v)
        size = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        out = np.where(size > 1e-9, sums / np.maximum(size, 1e-12), out)
    return out


def clustered(anchors: DataFrame) -> DataFrame:
    """Anchors with their cluster; the centres are fitted on at most about `FIT_ANCHORS` anchors, chosen by a hash.

    Vectors of a length that the sample does not hold are one cluster.
    """
    n = anchors.count()
    share = min(1.0, FIT_ANCHORS / max(1, n))
    sample = anchors.where(F.pmod(F.xxhash64("id", "label", "vector"), F.lit(1 << 30)) < int((1 << 30) * share)) \
        .select("dim", "vector").limit(2 * FIT_ANCHORS).toArrow()
    dims, vectors = sample.column("dim").to_pylist(), sample.column("vector").to_pylist()
    found: dict[int, np.ndarray] = {}
    for dim in set(dims) - {0}:
        members = [v for d, v in zip(dims, vectors) if d == dim]
        found[dim] = centres(matrix(members, dim), max(1, min(CENTRES, len(members), round(n * len(members) / len(dims) / GROUP))))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, vectors = batch.column("dim").to_numpy(zero_copy_only=False), batch.column("vector").to_pylist()
            cluster = np.zeros(batch.num_rows, dtype=np.int32)
            for dim in set(dims.tolist()) & set(found):
                rows = np.flatnonzero(dims == dim)
                cluster[rows] = (matrix([vectors[i] for i in rows], dim) @ found[dim].T).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cluster)], names=[*batch.schema.names, "cluster"])

    return anchors.mapInArrow(assign, f"{ROWS}, cluster int")


def _meet(answer, schema: pa.Schema):
    """A function over batches that hold, for each block, its chunks of rows first and then groups of anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, block = None, Block()
        for batch in batches:
            for row in range(batch.num_rows):
                at, kind, _, dim, n, ids, labels, vectors, extra = (c[row].as_py() for c in batch.columns)
                if at != here:
                    here, block = at, Block()
                members = unpacked(n, dim, ids, labels, vectors)
                if kind == 0:
                    block.add(dim, members)
                elif (rows := block.of(dim)) is not None and (found := answer(members, rows, extra.split(";"))):
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)

    return run


def _send(groups: DataFrame, chunks: DataFrame, blocks: int) -> DataFrame:
    """Every group of anchors to every block, behind the block's rows."""
    sent = groups.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return chunks.unionByName(sent).repartitionById(blocks, F.col("block")).sortWithinPartitions("block", "kind", "dim", "part")


def mine(rows: DataFrame, is_anchor: Column, *, key: str = "vec_id", vector: str = "embedding", label: str = "label",
         positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST, most: int = MOST) -> DataFrame:
    """`anchor_id`, `positive_id`, `rank`, `negative_id`, `positive_score`, `negative_score`.

    Scores are inner products of the components times `SCALE`, rounded down. An anchor's positives are the `positives` best
    other rows of its label; for each, the `negatives` best rows of other labels are listed that score from `least` to `most`
    percent of the positive. Ties go to the smaller id. Rows with a null id, label or vector or a component that is null or not
    finite take no part; equal rows count once; rows that share an id are rows of their own but never each other's answer.
    Vectors of another length have no score with an anchor. Other columns are not looked at. No anchor, no row.
    """
    spark = shipped(rows.sparkSession)
    plain = dict(rows.dtypes)[vector] in ("array<float>", "array<double>")
    quantised = rows.select(
        F.col(key).cast("long").alias("id"), F.col(label).cast("int").alias("label"),
        (F.col(vector) if plain else F.col(vector).cast("array<double>")).alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor")).where("id is not null and label is not null").mapInArrow(_quantise, ROWS)
    kept = staged(quantised.groupBy("id", "label", "dim", "vector").agg(F.bool_or("anchor").alias("anchor")))
    asked = staged(clustered(kept.where("anchor")).withColumn("list", F.monotonically_increasing_id()))
    blocks = max(spark.sparkContext.defaultParallelism, -(-kept.count() // BLOCK))
    place = F.pmod(F.xxhash64("id", "label", "vector"), F.lit(blocks)).cast("int")
    chunks = staged(kept.select(place.alias("block"), "dim", "id", "label", "vector", F.lit(None).cast("string").alias("extra"))
                    .repartitionById(blocks, F.col("block")).sortWithinPartitions("block", "dim").mapInArrow(_pack(CHUNK, 0), PACKED))

    def grouped(anchors: DataFrame) -> DataFrame:
        """Groups of one cluster; ranges of (cluster, id) keep a large cluster from becoming one task."""
        return anchors.repartitionByRange("dim", "cluster", "id").sortWithinPartitions("dim", "cluster", "id") \
            .select(F.col("cluster").alias("block"), "dim", "id", "label", "vector", "extra").mapInArrow(_pack(GROUP, 1), PACKED)

    first = pa.schema([("list", pa.int64()), ("positive", pa.int64()), ("score", pa.int64())])

    def find_positives(group: tuple, block: tuple, extra: list[str]) -> list[tuple]:
        return [(int(extra[a]), i, -s) for a, x in positives_of(group, block, positives).rows.items() for s, i in x]

    near = _send(grouped(asked.withColumn("extra", F.col("list").cast("string"))), chunks, blocks) \
        .mapInArrow(_meet(find_positives, first), "list long, positive long, score long")
    best = Window.partitionBy("list").orderBy(F.desc("score"), "positive")
    told = near.withColumn("place", F.row_number().over(best)).where(F.col("place") <= positives) \
        .groupBy("list").agg(F.array_join(F.collect_list(F.concat_ws(" ", "positive", "score")), ",").alias("found"))
    told = staged(asked.join(told, "list").withColumn("extra", F.concat_ws(":", "list", "found")))
    second = pa.schema([("list", pa.int64()), ("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64()),
                        ("negative_id", pa.int64()), ("negative_score", pa.int64())])

    def find_negatives(group: tuple, block: tuple, extra: list[str]) -> list[tuple]:
        asked = [(a, int(number), *map(int, x.split())) for a, one in enumerate(extra)
                 for number, found in [one.split(":")] for x in found.split(",")]
        low, high = (np.array([f(s) for _, _, _, s in asked], dtype=np.int64)
                     for f in (lambda s: -(-least * s // 100), lambda s: most * s // 100))
        got = negatives_of(group, block, np.array([a for a, _, _, _ in asked], dtype=np.int64), low, high, negatives)
        return [(asked[w][1], int(group[0][asked[w][0]]), asked[w][2], asked[w][3], i, -s) for w, x in got.rows.items() for s, i in x]

    hard = Window.partitionBy("list", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return _send(grouped(told), chunks, blocks).mapInArrow(
        _meet(find_negatives, second),
        "list long, anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long") \
        .withColumn("rank", F.row_number().over(hard)).where(F.col("rank") <= negatives) \
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
