"""Nearest neighbours by inner product over robust-pruned directed graphs, one for each shard.

Equal vectors are one node. Nodes are dealt into shards of bounded size by a hash. In a shard, nodes join the graph in
batches: a greedy search from the medoid proposes neighbours, relaxed distance pruning keeps near and diverse ones, and edges
back are pruned the same way. A query goes through every shard's graph with a beam, and what it finds is scored again in
double precision. Vectors get one more component so that all have the same norm: nearest then means largest inner product.
A shard holds vectors of one band of norms, scaled to 1 at most, so that long vectors elsewhere do not drown short ones in rounding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import shipped, staged

#: Nodes of a shard's graph, on average.
SHARD_NODES = 8192
DEGREE = 32
RELAX = 1.2
BUILD_BEAM, SEARCH_BEAM = 64, 96
#: Nodes that a search opens in one step, and nodes that join the graph together.
WIDTH, BATCH = 4, 512
#: Decimal powers that the norms of a band span.
BAND = 2
#: Queries that go to a shard together.
QUERY_BLOCK = 4096

INDEX = "shard int, dim int, n int, vectors binary, ids binary, id_from binary, graph binary, entry int, copies int"


def beam_search(points: np.ndarray, graph: np.ndarray, entry: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and squared distances of the `beam` nearest nodes found for each query (id -1 where there are fewer)."""
    q, n = len(queries), len(points)
    ids = np.full((q, beam), -1, dtype=np.int64)
    far = np.full((q, beam), np.inf, dtype=np.float32)
    opened = np.ones((q, beam), dtype=bool)
    seen = np.zeros((q, n + 1), dtype=bool)
    seen[:, n] = True
    ids[:, 0], far[:, 0], opened[:, 0] = entry, ((queries - points[entry]) ** 2).sum(axis=1), False
    seen[:, entry] = True
    active = np.arange(q)
    while len(active):
        mine, distance, done = ids[active], far[active], opened[active]
        next_ = np.argsort(np.where(done, np.inf, distance), axis=1, kind="stable")[:, :WIDTH]
        rows = np.arange(len(active))[:, None]
        chosen = np.where(done[rows, next_], -1, mine[rows, next_])
        opened[active[:, None], next_] = True
        around = np.where(chosen[:, :, None] >= 0, graph[np.maximum(chosen, 0)], -1).reshape(len(active), -1)
        around = np.where(around < 0, n, around)
        around = np.sort(around, axis=1)
        around[:, 1:][around[:, 1:] == around[:, :-1]] = n
        around = np.where(seen[active[:, None], around], n, around)
        seen[active[:, None], around] = True
        near = np.full(around.shape, np.inf, dtype=np.float32)
        a, b = np.nonzero(around < n)
        gap = points[around[a, b]] - queries[active[a]]
        near[a, b] = np.einsum("ij,ij->i", gap, gap)
        all_ids = np.concatenate([mine, np.where(around < n, around, -1)], axis=1)
        all_far = np.concatenate([distance, near], axis=1)
        all_open = np.concatenate([opened[active], around >= n], axis=1)
        order = np.argsort(all_far, axis=1, kind="stable")[:, :beam]
        ids[active], far[active], opened[active] = all_ids[rows, order], all_far[rows, order], all_open[rows, order]
        active = active[~opened[active].all(axis=1)]
    return ids, far


def robust_prune(points: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, degree: int, relax: float) -> np.ndarray:
    """Neighbours of each node out of its candidates (-1 where none): the nearest first, and none that a chosen one covers,
    being nearer to it by the factor `relax` than to the node."""
    candidates = np.sort(np.where(candidates == nodes[:, None], -1, candidates), axis=1)
    candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = -1
    alive = candidates >= 0
    at = points[np.maximum(candidates, 0)]
    gap = at - points[nodes][:, None, :]
    distance = np.where(alive, np.einsum("ijk,ijk->ij", gap, gap), np.inf)
    norm = np.einsum("ijk,ijk->ij", at, at)
    between = norm[:, :, None] + norm[:, None, :] - 2 * (at @ at.transpose(0, 2, 1))
    out = np.full((len(nodes), degree), -1, dtype=np.int64)
    rows = np.arange(len(nodes))
    for k in range(degree):
        best = np.where(alive, distance, np.inf).argmin(axis=1)
        some = alive[rows, best]
        if not some.any():
            break
        out[some, k] = candidates[rows, best][some]
        alive &= ~((relax * relax * between[rows, best] <= distance) & some[:, None])
        alive[rows, best] = False
    return out


def build(points: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, relax: float = RELAX, batch: int = BATCH) -> tuple[np.ndarray, int]:
    """Graph over `points` (a row of neighbours for each, -1 where there are fewer) and the node where searches begin."""
    n = len(points)
    graph = np.full((n, degree), -1, dtype=np.int64)
    entry = int(((points - points.mean(axis=0)) ** 2).sum(axis=1).argmin())
    order = np.random.default_rng(7).permutation(n)
    order = np.concatenate([[entry], order[order != entry]])
    first = order[:min(n, 128)]
    graph[first] = robust_prune(points, first, np.tile(first, (len(first), 1)), degree, relax)
    done = len(first)
    while done < n:
        nodes = order[done:done + min(batch, done)]
        found, _ = beam_search(points, graph, entry, points[nodes], beam)
        graph[nodes] = robust_prune(points, nodes, found, degree, relax)
        done += len(nodes)
        back_to, back_from = graph[nodes].ravel(), np.repeat(nodes, degree)
        back_from, back_to = back_from[back_to >= 0], back_to[back_to >= 0]
        turn = np.argsort(back_to, kind="stable")
        back_to, back_from = back_to[turn], back_from[turn]
        targets, start, count = np.unique(back_to, return_index=True, return_counts=True)
        wide = int(count.max())
        more = np.full((len(targets), wide), -1, dtype=np.int64)
        more[np.repeat(np.arange(len(targets)), count), np.arange(len(back_to)) - np.repeat(start, count)] = back_from
        both = np.concatenate([graph[targets], more], axis=1)
        both = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), axis=1)
        full = (both >= 0).sum(axis=1) > degree
        graph[targets[~full]] = both[~full][:, :degree]
        over = np.flatnonzero(full)
        for a in range(0, len(over), 1024):
            part = over[a:a + 1024]
            graph[targets[part]] = robust_prune(points, targets[part], _nearest(points, targets[part], both[part], 3 * degree), degree, relax)
    return graph, entry


def _nearest(points: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, most: int) -> np.ndarray:
    """The `most` nearest candidates of each node; pruning takes the nearest first and has room for fewer."""
    if candidates.shape[1] <= most:
        return candidates
    gap = points[np.maximum(candidates, 0)] - points[nodes][:, None, :]
    distance = np.where(candidates >= 0, np.einsum("ijk,ijk->ij", gap, gap), np.inf)
    return np.take_along_axis(candidates, np.argsort(distance, axis=1, kind="stable")[:, :most], axis=1)


def augmented(vectors: np.ndarray, queries: bool = False) -> np.ndarray:
    """Vectors scaled to norms of 1 at most (queries: of 1), with one more component that makes all norms equal (0 for queries)."""
    if not len(vectors):
        return np.zeros((0, vectors.shape[1] + 1), dtype=np.float32)
    peak = np.abs(vectors).max(axis=1, keepdims=True) if queries else np.abs(vectors).max()
    scaled = vectors / peak  # squares neither overflow nor vanish
    norm = np.einsum("ij,ij->i", scaled, scaled, dtype=np.float64)
    scaled = scaled / (np.sqrt(norm)[:, None] if queries else np.sqrt(norm.max()))
    last = np.zeros(len(vectors)) if queries else np.sqrt(np.maximum(1 - norm / norm.max(), 0))
    return np.concatenate([scaled, last[:, None]], axis=1).astype(np.float32)


def band_of(vector: str) -> Column:
    """Number of the band that a usable vector's norm is in."""
    v = F.col(vector)
    peak = F.array_max(F.transform(v, F.abs))
    square = F.aggregate(F.transform(v, lambda x: (x / peak) * (x / peak)), F.lit(0.0), lambda a, x: a + x)
    return F.floor((F.log10(peak) + F.log10(square) / 2) / BAND).cast("int")


def usable(vector: str) -> Column:
    """Whether a vector takes part: not null or empty, all components finite numbers, not all zero."""
    c = F.col(vector)
    fine = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(c.isNotNull() & fine & F.exists(c, lambda x: x != 0), F.lit(False))


def index(rows: DataFrame, *, key: str = "vec_id", vector: str = "embedding", copies: int = 21, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """Graphs of all usable vectors, one row a shard, staged in the shared folder.

    Every row is in the index through its vector's node. A node lists the `copies` smallest keys of its vector, which are all
    that a search for fewer nearest can return, since ties go to the smaller key. Vectors of other lengths, and of
    norms in another band, have graphs of their own. Null keys are left out; an empty table gives an index without rows.
    """
    spark = shipped(rows.sparkSession)
    good = rows.select(F.col(key).cast("long").alias("i"), F.col(vector).cast("array<double>").alias("v")).where("i is not null").where(usable("v"))
    named = good.withColumns({"h1": F.xxhash64("v"), "h2": F.xxhash64(F.lit(1), "v")})
    first = Window.partitionBy("h1", "h2").orderBy("i")
    few = named.withColumn("r", F.row_number().over(first)).where(F.col("r") <= copies)
    nodes = staged(few.groupBy("h1", "h2").agg(F.sort_array(F.collect_list("i")).alias("ids"), F.first(F.when(F.col("r") == 1, F.col("v")), True).alias("v")))
    group = F.concat_ws(":", F.size("v"), band_of("v"))
    sizes = {r.g: r.n for r in nodes.groupBy(group.alias("g")).agg(F.count("*").alias("n")).collect()}
    start, base = {}, 0
    for name in sorted(sizes):
        start[name] = (base, -(-sizes[name] // shard_nodes))
        base += start[name][1]
    if not base:
        return spark.createDataFrame([], INDEX)
    lookup = F.create_map(*[F.lit(x) for g, (a, _) in start.items() for x in (g, a)])
    width = F.create_map(*[F.lit(x) for g, (_, m) in start.items() for x in (g, m)])
    shard = lookup[group] + F.pmod(F.xxhash64("h1", "h2"), width[group]).cast("int")
    kind = pa.schema([("shard", pa.int32()), ("dim", pa.int32()), ("n", pa.int32()), ("vectors", pa.binary()), ("ids", pa.binary()),
                      ("id_from", pa.binary()), ("graph", pa.binary()), ("entry", pa.int32()), ("copies", pa.int32())])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for s, v, i in zip(*(c.to_pylist() for c in batch.columns)):
                held.setdefault(s, []).append((v, i))
        for s, members in sorted(held.items()):
            vectors = np.array([v for v, _ in members], dtype=np.float64)
            graph, entry = build(augmented(vectors))
            ids = np.array([x for _, i in members for x in i], dtype=np.int64)
            bounds = np.concatenate([[0], np.cumsum([len(i) for _, i in members])]).astype(np.int64)
            yield pa.RecordBatch.from_pylist([{
                "shard": s, "dim": vectors.shape[1], "n": len(vectors), "vectors": vectors.tobytes(), "ids": ids.tobytes(),
                "id_from": bounds.tobytes(), "graph": graph.astype(np.int32).tobytes(), "entry": entry, "copies": copies}], kind)

    dealt = nodes.select(shard.alias("shard"), "v", "ids").repartitionById(base, F.col("shard"))
    return staged(dealt.mapInArrow(make, INDEX))


def search(graphs: DataFrame, queries: DataFrame, k: int, *, key: str = "vec_id", vector: str = "embedding",
           beam: int = SEARCH_BEAM, query_block: int = QUERY_BLOCK) -> DataFrame:
    """`query_id`, `rank`, `vec_id`, `score`: the `k` rows with the largest inner products found for each query.

    A query never finds its own key; there are fewer rows where there are fewer candidates; ties go to the smaller key.
    Queries that are not usable, or whose length no graph has, have no result; repeated queries are answered once. An index
    that lists `k` or fewer copies of a vector could miss some and is refused.
    """
    shipped(queries.sparkSession)
    copies = graphs.agg(F.min("copies")).first()[0]
    if copies is not None and k >= copies:
        raise ValueError(f"an index for {k} nearest needs copies={k + 1} or more, this one has {copies}")
    asked = staged(queries.select(F.col(key).cast("long").alias("q"), F.col(vector).cast("array<double>").alias("v"))
                   .where("q is not null").where(usable("v")).dropDuplicates(["q"]))
    n = max(1, -(-asked.count() // query_block))
    block = F.pmod(F.xxhash64("q"), F.lit(n)).cast("int")
    packed = asked.groupBy(F.size("v").alias("dim"), block.alias("block")).agg(F.collect_list(F.struct("q", "v")).alias("asked"))
    sent = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).join(packed, ["dim", "block"])
    shards = max(1, graphs.count())
    kind = pa.schema([("q", pa.int64()), ("found", pa.list_(pa.struct([("score", pa.float64()), ("id", pa.int64())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                r = {name: batch.column(j)[row] for j, name in enumerate(batch.schema.names)}
                count, dim = r["n"].as_py(), r["dim"].as_py()
                vectors = np.frombuffer(r["vectors"].as_buffer(), dtype=np.float64).reshape(count, dim)
                ids, bounds = np.frombuffer(r["ids"].as_buffer(), dtype=np.int64), np.frombuffer(r["id_from"].as_buffer(), dtype=np.int64)
                graph = np.frombuffer(r["graph"].as_buffer(), dtype=np.int32).reshape(count, -1).astype(np.int64)
                points, asked_ = augmented(vectors), r["asked"].as_py()
                for a in range(0, len(asked_), BATCH):
                    part = asked_[a:a + BATCH]
                    question = np.array([x["v"] for x in part], dtype=np.float64)
                    nodes, _ = beam_search(points, graph, r["entry"].as_py(), augmented(question, queries=True), max(beam, k + 1))
                    out = []
                    for x, v, mine in zip(part, question, nodes):
                        mine = mine[mine >= 0]
                        score = vectors[mine] @ v
                        sizes = bounds[mine + 1] - bounds[mine]
                        which = np.repeat(np.arange(len(mine)), sizes)
                        found = ids[np.repeat(bounds[mine], sizes) + np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)]
                        value = score[which]
                        other = found != x["q"]
                        found, value = found[other], value[other]
                        top = np.lexsort((found, -value))[:k]
                        out.append({"q": x["q"], "found": [{"score": float(value[t]), "id": int(found[t])} for t in top]})
                    yield pa.RecordBatch.from_pylist(out, kind)

    got = sent.select("n", "dim", "vectors", "ids", "id_from", "graph", "entry", "asked").repartition(shards * n) \
        .mapInArrow(run, "q long, found array<struct<score:double,id:long>>")
    best = got.groupBy("q").agg(F.flatten(F.collect_list("found")).alias("all")) \
        .select("q", F.slice(F.array_sort(F.transform("all", lambda x: F.struct((-x["score"]).alias("less"), x["id"].alias("id")))), 1, k).alias("top"))
    return best.select(F.col("q").alias("query_id"), F.posexplode("top").alias("at", "hit")) \
        .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.id").alias("vec_id"), (-F.col("hit.less")).alias("score"))
