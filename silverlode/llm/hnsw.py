"""Approximate nearest neighbours by inner product: one navigable small-world graph per shard, results merged."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverlode.llm.common import stored

K = 20
# Every query visits every shard, so shards are as large as a task can build in a minute.
SHARD_ROWS = 16384
# Components of all vectors of a shard, so that long vectors fit a task too.
SHARD_VALUES = 1 << 23
# Links of a node on the upper levels; the lowest level has twice as many.
LINKS = 16
# Earlier nodes that compete for the links of a new node, and nodes that a search keeps open.
BUILD_WIDTH = 64
SEARCH_WIDTH = 240
# Queries that one task runs through one shard.
QUERY_BLOCK = 4096
# Walks that step together; each marks the nodes of the shard that it has seen.
WALKS = 256

GRAPH = "shard long, entry int, rows int, width int, limit double, vectors binary, keys binary, levels binary, neighbours binary"


class Graph(NamedTuple):
    """Levels of a graph as flat arrays: row ``i`` of ``neighbours[level]`` holds the links of node i, -1 where none."""

    entry: int
    vectors: np.ndarray
    neighbours: list[np.ndarray]


def _lifted(vectors: np.ndarray, limit: float) -> np.ndarray:
    """One more component makes all lengths equal, so that nearest by distance is largest by inner product."""
    rest = np.sqrt(np.maximum(limit**2 - (vectors.astype(np.float64) ** 2).sum(axis=1), 0))
    return np.hstack([vectors, rest[:, None].astype(np.float32)])


def _spread(order: np.ndarray, closeness: np.ndarray, vectors: np.ndarray, most: int) -> list[int]:
    """Of candidates by falling closeness those that are closer to the node than to any already chosen; then the closest others."""
    chosen: list[int] = []
    passed: list[int] = []
    among = vectors[order] @ vectors[order].T
    places: list[int] = []
    for place in range(len(order)):
        if len(chosen) == most:
            break
        if all(among[place, p] < closeness[place] for p in places):
            chosen.append(int(order[place]))
            places.append(place)
        else:
            passed.append(int(order[place]))
    return chosen + passed[: most - len(chosen)]


def build_graph(vectors: np.ndarray, seed: int) -> Graph:
    """Insert nodes in order: each links to a spread-out choice of its nearest earlier nodes, and they link back.

    Levels are drawn with the usual exponential rule from ``seed``. Candidates among
    earlier nodes are exact, from blocks of products, as a shard is small.
    """
    n = len(vectors)
    random = np.random.default_rng(seed)
    height = np.minimum((-np.log(1 - random.random(n)) / np.log(LINKS)).astype(int), 8)
    neighbours = []
    for level in range(int(height.max()) + 1):
        nodes = np.flatnonzero(height >= level)
        most = 2 * LINKS if level == 0 else LINKS
        links: list[list[int]] = [[] for _ in range(n)]
        for start in range(0, len(nodes), 512):
            block = nodes[start : start + 512]
            scores = vectors[block] @ vectors[nodes[: start + len(block)]].T
            for row, node in enumerate(block):
                earlier = start + row
                if not earlier:
                    continue
                own = scores[row, :earlier]
                best = np.argpartition(-own, BUILD_WIDTH - 1)[:BUILD_WIDTH] if earlier > BUILD_WIDTH else np.arange(earlier)
                best = best[np.argsort(-own[best], kind="stable")]
                links[node] = _spread(nodes[best], own[best], vectors, LINKS)
                for other in links[node]:
                    links[other].append(int(node))
                    if len(links[other]) > most:
                        around = np.array(links[other])
                        near = vectors[around] @ vectors[other]
                        order = np.argsort(-near, kind="stable")
                        links[other] = _spread(around[order], near[order], vectors, most)
        flat = np.full((n, most), -1, np.int32)
        for node in nodes:
            flat[node, : len(links[node])] = links[node]
        neighbours.append(flat)
    return Graph(int(np.argmax(height)), vectors, neighbours)


def _greedy(graph: Graph, queries: np.ndarray) -> np.ndarray:
    """Where each query enters the lowest level: on every level above it steps to the nearest linked node until none is nearer."""
    nodes = np.full(len(queries), graph.entry)
    scores = queries @ graph.vectors[graph.entry]
    for links in reversed(graph.neighbours[1:]):
        moving = np.arange(len(queries))
        while len(moving):
            around = links[nodes[moving]]
            near = np.einsum("qnd,qd->qn", graph.vectors[around], queries[moving])
            near[around < 0] = -np.inf
            best = near.argmax(axis=1)
            value = near[np.arange(len(moving)), best]
            nearer = value > scores[moving]
            nodes[moving[nearer]] = around[nearer, best[nearer]]
            scores[moving[nearer]] = value[nearer]
            moving = moving[nearer]
    return nodes


def search_graph(graph: Graph, queries: np.ndarray, width: int) -> list[np.ndarray]:
    """For each query the nodes that a best-first walk keeps, nearest first: greedy on the upper levels, ``width`` nodes on the lowest.

    All queries take their steps together: each opens the nearest node it keeps and has not opened, until there is none.
    """
    vectors, links = graph.vectors, graph.neighbours[0]
    entries = _greedy(graph, queries)
    found: list[np.ndarray] = [entries[:0]] * len(queries)
    walking = np.arange(len(queries))
    seen = np.zeros((len(queries), len(vectors)), bool)
    seen[walking, entries] = True
    kept = np.full((len(queries), width), -1, np.int32)
    scores = np.full((len(queries), width), -np.inf, np.float32)
    kept[:, 0] = entries
    scores[:, 0] = np.einsum("qd,qd->q", vectors[entries], queries)
    to_open = scores.copy()  # without those that were opened
    worst = scores.min(axis=1)
    while len(walking):
        row = np.arange(len(walking))
        best = to_open.argmax(axis=1)
        done = to_open[row, best] == -np.inf
        if done.any():
            for at in np.flatnonzero(done):
                order = np.argsort(-scores[at], kind="stable")
                found[walking[at]] = kept[at, order][kept[at, order] >= 0]
            left = ~done
            walking, queries = walking[left], queries[left]
            kept, scores, to_open, worst = kept[left], scores[left], to_open[left], worst[left]
            continue
        around = links[kept[row, best]]
        to_open[row, best] = -np.inf
        of, column = np.nonzero((around >= 0) & ~seen[walking[:, None], around])
        node = around[of, column]
        seen[walking[of], node] = True
        near = np.einsum("nd,nd->n", vectors[node], queries[of])
        good = near > worst[of]
        of, node, near = of[good], node[good], near[good]
        if not len(of):
            continue
        # One row for each walk that gains nodes, with places for as many as the walk that gains most.
        gaining, first, gains = np.unique(of, return_index=True, return_counts=True)
        line = np.repeat(np.arange(len(gaining)), gains)
        place = width + np.arange(len(of)) - np.repeat(first, gains)
        wide = ((0, 0), (0, int(gains.max())))
        all_kept = np.pad(kept[gaining], wide, constant_values=-1)
        all_scores = np.pad(scores[gaining], wide, constant_values=-np.inf)
        all_open = np.pad(to_open[gaining], wide, constant_values=-np.inf)
        all_kept[line, place] = node
        all_scores[line, place] = all_open[line, place] = near
        stays = np.argpartition(-all_scores, width - 1, axis=1)[:, :width]
        kept[gaining] = np.take_along_axis(all_kept, stays, 1)
        scores[gaining] = np.take_along_axis(all_scores, stays, 1)
        to_open[gaining] = np.take_along_axis(all_open, stays, 1)
        worst[gaining] = scores[gaining].min(axis=1)
    return found


def usable(vector: Column) -> Column:
    """True for vectors with a non-zero component and without null or non-finite ones."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def distinct_vectors(table: DataFrame, k: int, id_column: str, vector_column: str) -> DataFrame:
    """Each different vector once: ``key``, ``dim``, ``vector`` and ``ids``, the smallest k + 1 ids that have it.

    More copies cannot be among the k nearest of any query, not even of one of
    them. Their number is cut before the shuffle, so a vector that a third of the
    rows share arrives as k + 1 rows per task.
    """
    rows = table.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<float>").alias("vector"))
    rows = rows.filter(F.col("id").isNotNull() & usable(F.col("vector")))
    # Adding zero makes -0.0 and 0.0 one vector.
    rows = rows.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0).cast("float"))).distinct()
    first = Window.partitionBy("vector").orderBy("id")
    rows = rows.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= k + 1)
    found = rows.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    return found.select(F.size("vector").alias("dim"), "vector", "ids", F.monotonically_increasing_id().alias("key"))


def build_index(vectors: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per shard with its graph as flat arrays; every vector is in exactly one shard.

    ``vectors`` has ``key``, ``dim`` and ``vector``. Shards are hash groups of about ``shard_rows``
    vectors of one dimension each (fewer if these are long), so their number grows with the table.
    """
    sizes = {r["dim"]: r["n"] for r in vectors.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = [(dim, -(-n // max(1, min(shard_rows, SHARD_VALUES // dim)))) for dim, n in sizes.items()]
    shards = F.create_map(*[F.lit(x) for pair in counts for x in pair]) if counts else F.create_map().cast("map<int,int>")
    place = F.pmod(F.xxhash64("key"), F.coalesce(shards[F.col("dim")], F.lit(1)))
    placed = vectors.select("key", "vector", (F.col("dim").cast("long") * (1 << 32) + place).alias("shard"))

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("key")
        plain = np.stack(rows["vector"].to_numpy()).astype(np.float32)
        limit = float(np.sqrt((plain.astype(np.float64) ** 2).sum(axis=1).max()))
        lifted = _lifted(plain, limit)
        shard = int(rows["shard"].iloc[0])
        graph = build_graph(lifted, shard % 2**32)
        levels = np.array([a.shape[1] for a in graph.neighbours], np.int32)
        return pd.DataFrame(
            [
                (
                    shard,
                    graph.entry,
                    len(plain),
                    lifted.shape[1],
                    limit,
                    lifted.tobytes(),
                    rows["key"].to_numpy(np.int64).tobytes(),
                    levels.tobytes(),
                    b"".join(a.tobytes() for a in graph.neighbours),
                )
            ],
            columns=[c.split()[0] for c in GRAPH.split(", ")],
        )

    return placed.groupBy("shard").applyInPandas(build, GRAPH)


def _load(row: pd.Series) -> tuple[Graph, np.ndarray]:
    n, width = int(row["rows"]), int(row["width"])
    vectors = np.frombuffer(row["vectors"], np.float32).reshape(n, width)
    flat = np.frombuffer(row["neighbours"], np.int32)
    neighbours, at = [], 0
    for links in np.frombuffer(row["levels"], np.int32).tolist():
        neighbours.append(flat[at : at + n * links].reshape(n, links))
        at += n * links
    return Graph(int(row["entry"]), vectors, neighbours), np.frombuffer(row["keys"], np.int64)


def _search(k: int, width: int):
    def run(_, index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": np.zeros(0, np.int64), "key": np.zeros(0, np.int64), "score": np.zeros(0)})
        if not len(index) or not len(queries):
            return empty
        graph, keys = _load(index.iloc[0])
        exact = graph.vectors[:, :-1].astype(np.float64)
        parts = [empty]
        for start in range(0, len(queries), WALKS):
            some = queries.iloc[start : start + WALKS]
            vectors = np.stack(some["vector"].to_numpy()).astype(np.float32)
            # Its own vector may be among them, and the copies of one vector count as one here.
            found = [f[: k + 1] for f in search_graph(graph, np.pad(vectors, ((0, 0), (0, 1))), width)]
            of = np.repeat(np.arange(len(some)), [len(f) for f in found])
            nodes = np.concatenate(found)
            scores = (exact[nodes] * vectors[of].astype(np.float64)).sum(axis=1)
            parts.append(pd.DataFrame({"query_id": some["query_id"].to_numpy()[of], "key": keys[nodes], "score": scores}))
        return pd.concat(parts, ignore_index=True)

    return run


def nearest(
    table: DataFrame,
    queries: DataFrame,
    k: int = K,
    width: int = SEARCH_WIDTH,
    shard_rows: int = SHARD_ROWS,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the k rows of ``table`` with the largest inner products.

    Queries are rows of the same shape; a row is no neighbour of the query of its
    own id. Ties go to the smaller id. Vectors that are null, empty, zero or hold
    null or non-finite components take no part on either side; neither do null
    ids. Vectors meet those of their own dimension only. Repeated rows count once.
    An empty side gives no rows.

    Every block of queries visits every shard, and each shard gives k + 1 vectors
    for a query, which are merged per query.
    """
    vectors = stored(distinct_vectors(table, k, id_column, vector_column))
    index = stored(build_index(vectors, shard_rows))
    shards = index.select(F.col("shard").alias("to_shard"), (F.col("width") - 1).alias("dim"))
    wanted = queries.select(F.col(id_column).cast("long").alias("query_id"), F.col(vector_column).cast("array<float>").alias("vector"))
    wanted = wanted.filter(F.col("query_id").isNotNull() & usable(F.col("vector"))).distinct().withColumn("dim", F.size("vector"))
    blocks = max(1, -(-wanted.count() // QUERY_BLOCK))
    wanted = wanted.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
    by_shard = wanted.join(shards, "dim").select("to_shard", "block", "query_id", "vector")
    copies = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    hits = copies.groupBy("shard", "block").cogroup(by_shard.groupBy("to_shard", F.col("block").alias("of_block")))
    hits = hits.applyInPandas(_search(k, width), "query_id long, key long, score double")

    # Of one query, so many different vectors hold the k nearest rows, with its own row left out; ties at the end all stay.
    place = F.rank().over(Window.partitionBy("query_id").orderBy(F.col("score").desc()))
    few = hits.withColumn("place", place).filter(F.col("place") <= k + 1)
    rows = few.join(vectors.select("key", F.explode("ids").alias("vec_id")), "key").filter(F.col("vec_id") != F.col("query_id"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
