"""Connected components of a table of links.

Up to LOCAL_LINKS links, a number that is checked, are one task's work; more are
settled by alternating large and small stars, round by round. Both give the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

#: Links that one task may hold: two longs each, and as much again for their labels.
LOCAL_LINKS = 2_000_000


def labels(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and the smallest node that each is linked with: least labels along links, then along labels, until nothing changes."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], least)
        np.minimum.at(new, label[b], least)
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            return nodes, nodes[label]
        label = new


def _in_one_task(links: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column("u").to_numpy(), b.column("v").to_numpy()) for b in batches]
        if parts:
            nodes, component = labels(*(np.concatenate(x) for x in zip(*parts)))
            for k in range(0, len(nodes), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(nodes[k : k + 50_000]), pa.array(component[k : k + 50_000])], ["node", "component"])

    return links.select("u", "v").coalesce(1).mapInArrow(run, "node long, component long")


def components(links: DataFrame) -> DataFrame:
    """node, component for every node of links (u, v longs): the smallest node that it is linked with, over any number of links.

    Each round hangs neighbours below the smallest of them; it ends when every
    tree is a star. Minima are partial aggregates, so a node with many links
    costs its links, not their square. Nothing is collected. links is read twice.
    """
    if links.count() <= LOCAL_LINKS:
        return _in_one_task(links)
    edges = cut(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "edges")
    while True:  # each round lowers a label or ends; their number grows with the logarithm of the links
        # done: each node has one parent, and no parent has one itself
        state = edges.agg(F.count("*").alias("n"), F.countDistinct("u").alias("d")).first()
        if state["n"] == state["d"] and edges.alias("a").join(edges.select(F.col("u").alias("v")).distinct(), "v", "left_semi").isEmpty():
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select("v", "v").distinct())
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = cut(large, "edges")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        edges = cut(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "edges")
