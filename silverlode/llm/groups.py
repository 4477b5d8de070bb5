"""Connected components of a graph of links, by union-find within tasks and star contraction between them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.llm.common import stored


def _union_find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch, each node with the smallest node that the links of the batch connect it to."""
    for batch in batches:
        root: dict[int, int] = {}

        def find(node: int) -> int:
            top = node
            while root.get(top, top) != top:
                top = root[top]
            while root.get(node, node) != top:
                root[node], node = top, root[node]
            return top

        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = find(a), find(b)
            if a != b:
                root[max(a, b)] = min(a, b)
        nodes = list(root)
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.int64()), pa.array([find(n) for n in nodes], pa.int64())], names=["node", "root"]
        )


def _large_star(links: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node to the smallest one around it."""
    both = links.unionByName(links.select(F.col("root").alias("node"), F.col("node").alias("root")))
    least = both.groupBy("node").agg(F.min("root").alias("least"))
    larger = both.filter(F.col("root") > F.col("node")).join(least, "node")
    return larger.select(F.col("root").alias("node"), F.least("node", "least").alias("root")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = links.groupBy("node").agg(F.min("root").alias("least"))
    smaller = links.join(least, "node").filter(F.col("root") != F.col("least"))
    moved = smaller.select(F.col("root").alias("node"), F.col("least").alias("root"))
    return moved.unionByName(least.select("node", F.col("least").alias("root"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest connected node) of all linked nodes but the roots.

    ``links`` has two long columns. Tasks first merge their own links by
    union-find; then stars are contracted until nothing changes, which takes a
    logarithm of the longest path in rounds. Each round is written to the shared
    scratch folder. Only a count and a checksum per round reach the driver; a node
    with very many links is split by adaptive joins.
    """
    names = links.columns
    pairs = links.select(F.col(names[0]).alias("a"), F.col(names[1]).alias("b")).filter("a <> b")
    current = stored(pairs.mapInArrow(_union_find, "node long, root long").filter("node <> root").distinct())
    state = None
    while True:
        seen = current.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("node", "root"))).first()
        if seen == state or seen[0] == 0:
            return current
        state = seen
        current = stored(_small_star(_large_star(current)))
