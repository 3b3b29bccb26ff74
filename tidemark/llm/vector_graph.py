"""Nearest neighbours by hierarchical navigable small-world graphs, one per shard of the vectors.

Vectors are dealt to shards by a hash. A shard's graph has layers, each a flat array of neighbour
numbers (-1 where there is none): layer 0 holds every vector, and each layer above the share of 1 / LINKS
of the one below that a seeded draw puts there. The vectors of higher layers come first, so that a
layer is a leading part of the numbering and needs no table. Vectors enter in batches: a batch
descends the layers together, takes its neighbours from a beam search of what is there and from
itself, keeps those that are nearer to it than to a neighbour already kept, and is linked back. A
shard is a row with its vectors and arrays, stored in the shared folder.

To search, the queries stream past each shard in blocks of bounded size and descend its layers
together; a beam over layer 0 gives the candidates, whose cosines are computed anew from the original
vectors in double precision. The shards' results are merged by score.

Equal vectors are one point of the graph, which carries the smallest k + 1 ids: with ties going to
the smaller id, no other row of theirs can be among k results.

Defined cases: vectors that are missing, empty, zero or hold a missing or non-finite component take no
part, and rows without an id neither; vectors of unlike length are never compared; repeated rows
count once, and an id with several vectors is a query with each of them, its own id never among its
results; with fewer than k candidates all are returned; other columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import stored

LINKS = 16  # neighbours a vector chooses; layer 0 keeps twice as many
EF_BUILD = 48
EF_SEARCH = 96
BATCH = 256  # vectors that enter a graph together
AT_ONCE = 4  # candidates of a beam whose neighbours are looked at in one step
QUERY_BLOCK = 512
SHARD_ROWS = 4096, 1 << 18  # least and most vectors of a shard
SHARDS = 64  # wanted, between these bounds
MOST_TASKS = 10_000


def scaled(vectors: np.ndarray) -> np.ndarray:
    """The vectors by a power of two each, exactly, so that no norm overflows or vanishes."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1, initial=0))
    return np.ldexp(vectors, -exponent[:, None])


def cosines(vectors: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Row by row."""
    dot = (vectors * queries).sum(axis=-1)
    return dot / (np.sqrt((vectors * vectors).sum(axis=-1)) * np.sqrt((queries * queries).sum(axis=-1)))


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = scaled(vectors)
    return (vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))).astype(np.float32)


@dataclass
class Graph:
    """``layers[l]`` has a row of neighbour numbers for each of the vectors on layer l, the first ones."""

    points: np.ndarray
    layers: list[np.ndarray]

    def beam(
        self, queries: np.ndarray, entries: np.ndarray, width: int, layer: int, present: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """(numbers, similarities) of the nearest ``width`` found on a layer, nearest first, -1 where fewer."""
        n, links = len(queries), self.layers[layer]
        seen = np.zeros((n, present + 1), bool)  # the last column is for -1
        seen[:, -1] = True
        found = np.full((n, width + AT_ONCE * links.shape[1]), -1, np.int64)
        near = np.full(found.shape, -np.inf, np.float32)
        spread = np.zeros(found.shape, bool)
        found[:, : entries.shape[1]] = entries
        near[:, : entries.shape[1]] = np.einsum("qed,qd->qe", self.points[entries], queries)
        near[found < 0] = -np.inf
        np.put_along_axis(seen, entries, True, axis=1)
        at_once = min(AT_ONCE, width)
        active = np.arange(n)
        while len(active):
            part = np.where(spread[active, :width], -np.inf, near[active, :width])
            best = np.argpartition(-part, at_once - 1, axis=1)[:, :at_once]
            good = np.take_along_axis(part, best, axis=1) > -np.inf
            active, best, good = (x[good.any(axis=1)] for x in (active, best, good))
            if not len(active):
                break
            rows = active[:, None]
            source = np.where(good, found[rows, best], -1)
            spread[rows, best] |= good
            next_to = np.where(source[:, :, None] >= 0, links[source], -1).reshape(len(active), -1)
            next_to[seen[rows, next_to]] = -1
            next_to.sort(axis=1)  # one number from two sources counts once
            next_to[:, 1:][next_to[:, 1:] == next_to[:, :-1]] = -1
            seen[rows, next_to] = True
            close = np.full(next_to.shape, -np.inf, np.float32)
            r, c = np.nonzero(next_to >= 0)
            close[r, c] = np.einsum("md,md->m", self.points[next_to[r, c]], queries[active[r]])
            found[active, width : width + next_to.shape[1]], near[active, width : width + next_to.shape[1]] = next_to, close
            spread[active, width:] = False
            order = np.argsort(-near[active], axis=1, kind="stable")[:, :width]
            for table in (found, near, spread):
                table[active, :width] = np.take_along_axis(table[active], order, axis=1)
            found[active, width:], near[active, width:] = -1, -np.inf
        order = np.argsort(-near[:, :width], axis=1, kind="stable")
        return np.take_along_axis(found[:, :width], order, axis=1), np.take_along_axis(near[:, :width], order, axis=1)

    def search(self, queries: np.ndarray, width: int = EF_SEARCH) -> np.ndarray:
        """Numbers of the candidates of each query, nearest first, -1 where fewer."""
        entries = np.zeros((len(queries), 1), np.int64)
        for layer in range(len(self.layers) - 1, 0, -1):
            entries, _ = self.beam(queries, entries, 1, layer, len(self.layers[layer]))
        return self.beam(queries, entries, width, 0, len(self.points))[0]

    def _chosen(self, who: np.ndarray, others: np.ndarray, most: int) -> np.ndarray:
        """Of each point's candidates (-1: none) the kept ones: first those nearer to it than to a kept one."""
        out = np.full((len(who), most), -1, np.int64)
        for begin in range(0, len(who), 128):
            rows = slice(begin, begin + 128)
            vectors = self.points[others[rows]]
            near = np.einsum("qcd,qd->qc", vectors, self.points[who[rows]])
            near[others[rows] < 0] = -np.inf
            order = np.argsort(-near, axis=1, kind="stable")
            near = np.take_along_axis(near, order, axis=1)
            ids = np.take_along_axis(others[rows], order, axis=1)
            vectors = np.take_along_axis(vectors, order[:, :, None], axis=1)
            between = vectors @ vectors.transpose(0, 2, 1)
            kept = np.zeros(near.shape, bool)
            count = np.zeros(len(ids), np.int64)
            for c in range(near.shape[1]):
                hidden = (kept[:, :c] & (between[:, c, :c] > near[:, c : c + 1])).any(axis=1)
                kept[:, c] = ~hidden & (near[:, c] > -np.inf) & (count < most)
                count += kept[:, c]
            # Places left go to the nearest of the others.
            rank = np.where(kept, 0, 1) + np.where(near == -np.inf, 2, 0)
            first = np.argsort(rank, axis=1, kind="stable")[:, :most]
            chosen = np.where(np.take_along_axis(near, first, axis=1) > -np.inf, np.take_along_axis(ids, first, axis=1), -1)
            out[rows, : chosen.shape[1]] = chosen
        return out

    def _link(self, layer: int, new: np.ndarray, candidates: np.ndarray) -> None:
        links = self.layers[layer]
        chosen = self._chosen(new, candidates, LINKS)
        links[new, :LINKS] = chosen
        source, target = np.repeat(new, LINKS), chosen.ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        whom, first, count = np.unique(target, return_index=True, return_counts=True)
        have = (links[whom] >= 0).sum(axis=1)
        room = have + count <= links.shape[1]
        step = np.arange(len(target)) - np.repeat(first, count)
        fits = np.repeat(room, count)
        links[target[fits], (np.repeat(have, count) + step)[fits]] = source[fits]
        whom, first, count = whom[~room], first[~room], count[~room]
        for begin in range(0, len(whom), 512):
            part = slice(begin, begin + 512)
            wide = np.full((len(whom[part]), int(count[part].max())), -1, np.int64)
            inside = np.arange(wide.shape[1]) < count[part][:, None]
            wide[inside] = source[np.repeat(first[part], count[part]) + (np.cumsum(inside, axis=1) - 1)[inside]]
            both = np.concatenate((links[whom[part]], wide), axis=1)
            near = np.einsum("qcd,qd->qc", self.points[both], self.points[whom[part]])
            near[both < 0] = -np.inf
            nearest = np.argsort(-near, axis=1, kind="stable")[:, : 2 * links.shape[1]]
            links[whom[part]] = self._chosen(whom[part], np.take_along_axis(both, nearest, axis=1), links.shape[1])


def drawn_layers(n: int, seed: int = 7) -> np.ndarray:
    """How many points each layer holds, from layer 0 up."""
    level = np.floor(-np.log(1 - np.random.default_rng(seed).random(n)) / math.log(LINKS)).astype(int)
    return np.array([(level >= i).sum() for i in range(int(level.max(initial=0)) + 1)])


def build_graph(vectors: np.ndarray, seed: int = 7) -> Graph:
    """A graph over vectors whose order is random, as an order by hash is."""
    counts = drawn_layers(len(vectors), seed)
    layers = [np.full((int(c), LINKS * (1 + (i == 0))), -1, np.int32) for i, c in enumerate(counts)]
    graph = Graph(_unit(vectors), layers)
    begin = 1
    while begin < len(vectors):
        end = min(len(vectors), begin + min(BATCH, begin))
        new = np.arange(begin, end)
        queries = graph.points[new]
        within = queries @ queries.T
        np.fill_diagonal(within, -np.inf)
        entries = np.zeros((len(new), 1), np.int64)
        for layer in range(len(layers) - 1, -1, -1):
            here = new < counts[layer]
            present = min(begin, int(counts[layer]))
            passing = np.empty((len(new), 1), np.int64)
            if (~here).any():
                found, _ = graph.beam(queries[~here], entries[~here], 1, layer, present)
                passing[~here] = found
            if here.any():
                found, _ = graph.beam(queries[here], entries[here], EF_BUILD, layer, present)
                passing[here] = found[:, :1]
                mates = within[np.ix_(here, here)]
                nearest = np.argsort(-mates, axis=1, kind="stable")[:, : min(LINKS, len(mates) - 1)]
                graph._link(layer, new[here], np.concatenate((found, new[here][nearest]), axis=1))
            entries = passing
        begin = end
    return graph


# --- on DataFrames ------------------------------------------------------------------------------


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, v): each id's vectors in double precision, those that take part, once each."""
    v = F.col("embedding").cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return (
        embeddings.select(F.col("vec_id").cast("long"), v.alias("v"))
        .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))
        .distinct()
    )


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), size)


SHARD = "size int, shard int, n int, ids array<array<bigint>>, vectors binary, layers array<int>, links binary"


def _built(key: tuple, table: pa.Table) -> pa.Table:
    size, shard = (k.as_py() for k in key)
    table = table.sort_by("place")
    vectors = _matrix(table.column("v"), size)
    graph = build_graph(vectors)
    flat = np.concatenate([layer.ravel() for layer in graph.layers]).astype("<i4")
    row = [size, shard, len(vectors), table.column("ids").to_pylist(), vectors.astype("<f8").tobytes(),
           [len(layer) for layer in graph.layers], flat.tobytes()]
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.list_(pa.int64())), pa.binary(), pa.list_(pa.int32()), pa.binary()]
    names = ["size", "shard", "n", "ids", "vectors", "layers", "links"]
    return pa.table({n: pa.array([x], k) for n, x, k in zip(names, row, kinds)})


def read_shard(row: dict) -> tuple[Graph, np.ndarray]:
    """A stored shard's graph and its original vectors."""
    vectors = np.frombuffer(row["vectors"], "<f8").reshape(row["n"], row["size"])
    flat, layers, at = np.frombuffer(row["links"], "<i4"), [], 0
    for i, count in enumerate(row["layers"]):
        width = LINKS * (1 + (i == 0))
        layers.append(flat[at : at + count * width].reshape(count, width))
        at += count * width
    return Graph(_unit(vectors), layers), vectors


def build_shards(vectors: DataFrame, k: int, rows: int | None = None) -> DataFrame:
    """The index of ``usable`` vectors: a row per shard, stored. ``rows`` are a shard's vectors, about."""
    smallest = W.partitionBy("v").orderBy("vec_id")
    points = stored(
        vectors.withColumn("nth", F.row_number().over(smallest)).where(F.col("nth") <= k + 1)
        .groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).withColumn("place", F.xxhash64("v")),
        "graph-points")
    if rows is None:
        rows = min(max(SHARD_ROWS[0], points.count() // SHARDS), SHARD_ROWS[1])
    sizes = stored(
        points.groupBy(F.size("v").alias("size")).agg(F.ceil(F.count("*") / rows).alias("shards")), "graph-sizes")
    dealt = points.withColumn("size", F.size("v")).join(sizes, "size").select(
        "size", F.pmod(F.xxhash64("place", F.lit(1)), F.col("shards")).cast("int").alias("shard"), "v", "ids", "place")
    # A shard is little to read and much to build: as many partitions as shards, not as few as the bytes ask for.
    number = min(sizes.agg(F.sum("shards")).first()[0] or 1, MOST_TASKS)
    dealt = dealt.repartition(number, "size", "shard")
    return stored(dealt.groupBy("size", "shard").applyInArrow(_built, SHARD), "graph-shards")


FOUND = "query_id bigint, nth bigint, vec_id bigint, score double"


def _query_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Queries of one length after the other, packed into blocks."""
    for batch in batches:
        sizes = batch.column("size").to_numpy()
        for size in np.unique(sizes).tolist():
            same = batch.filter(pa.array(sizes == size))
            for begin in range(0, len(same), QUERY_BLOCK):
                part = same.slice(begin, QUERY_BLOCK)
                data = _matrix(part.column("v"), size).astype("<f8").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([size], pa.int32()), pa.array([part.column("vec_id").to_pylist()], pa.list_(pa.int64())),
                     pa.array([part.column("place").to_pylist()], pa.list_(pa.int64())), pa.array([data], pa.binary())],
                    ["size", "query_ids", "places", "queries"])


def _nearest(graph: Graph, vectors: np.ndarray, ids: list[list[int]], asked: dict, k: int) -> list[tuple]:
    queries = np.frombuffer(asked["queries"], "<f8").reshape(len(asked["query_ids"]), -1)
    exact, own = scaled(vectors), scaled(queries)
    found = graph.search(_unit(queries))
    out = []
    for i, (query, place) in enumerate(zip(asked["query_ids"], asked["places"])):
        candidates = found[i][found[i] >= 0]
        scores = cosines(exact[candidates], own[i])
        best: list[tuple[float, int]] = []
        for score, c in zip(scores.tolist(), candidates.tolist()):
            best += [(-score, v) for v in ids[c] if v != query]
        out += [(query, place, v, -score) for score, v in sorted(best)[:k]]
    return out


def nearest_neighbours(embeddings: DataFrame, queries: DataFrame, k: int, rows: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest rows of ``embeddings`` found to each row of ``queries``.

    Both have vec_id and embedding; a row with the query's own id is no candidate.
    """
    vectors = usable(embeddings)
    shards = build_shards(vectors, k, rows)
    asked = usable(queries).select("vec_id", "v", F.size("v").alias("size"), F.xxhash64("v").alias("place"))
    packed = stored(
        asked.sortWithinPartitions("size").mapInArrow(
            _query_blocks, "size int, query_ids array<bigint>, places array<bigint>, queries binary"),
        "graph-queries").withColumn("block", F.monotonically_increasing_id())
    # Blocks of queries past shards: what is dealt out again is the blocks, each of bounded size.
    sent = packed.join(shards.select("size", "shard"), "size")
    index = shards.withColumns({"block": F.lit(-1).cast("long")})
    number = min(max(1, shards.count()), MOST_TASKS)
    both = index.unionByName(sent, allowMissingColumns=True).repartition(number, "size", "shard")
    both = both.sortWithinPartitions("size", "shard", "block")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph = vectors = ids = None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["block"] < 0:
                    (graph, vectors), ids = read_shard(row), row["ids"]
                    continue
                rows_found = _nearest(graph, vectors, ids, row, k)
                columns = list(zip(*rows_found)) or [()] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.float64()))],
                    ["query_id", "nth", "vec_id", "score"])

    found = both.mapInArrow(search, FOUND)
    # An id that stands in several shards, with several vectors, counts with its nearest.
    found = found.groupBy("query_id", "nth", "vec_id").agg(F.max("score").alias("score"))
    by_score = W.partitionBy("query_id", "nth").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
