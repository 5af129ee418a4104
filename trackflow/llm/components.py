"""Connected components of links, without gathering links on the driver."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackflow.llm.shared import cut_lineage


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same components as links from each node to the smallest of its component here."""
    nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = index[: len(a)], index[len(a) :]
    label = np.arange(len(nodes))
    while True:
        of_left, of_right = label[left], label[right]
        least = np.minimum(of_left, of_right)
        if (of_left == of_right).all():
            break
        np.minimum.at(label, of_left, least)
        np.minimum.at(label, of_right, least)
        while (label != (shorter := label[label])).any():
            label = shorter
    inner = label != np.arange(len(nodes))
    return nodes[inner], nodes[label[inner]]


def _contract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each partition's links as stars; a partition is folded batch by batch."""
    a = b = np.empty(0, np.int64)
    for frame in frames:
        new = frame.to_numpy(np.int64)
        a, b = stars(np.concatenate([a, new[:, 0]]), np.concatenate([b, new[:, 1]]))
    yield pd.DataFrame({"a": a, "b": b})


def connected(links: DataFrame) -> DataFrame:
    """``node, component_id`` of all linked nodes; the id is the smallest node of the component.

    ``links`` has long columns ``a`` and ``b``. Each round sends every node to the least of its
    neighbours, ties the other neighbours to that one, and follows one more step; it ends when
    every node has one neighbour and no neighbour has one of its own.
    """
    pairs = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    pairs = pairs.where("a > b").mapInPandas(_contract, "a long, b long").where("a > b").distinct()
    pairs = cut_lineage(pairs)
    while True:
        least = cut_lineage(pairs.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")))
        nodes = least.select(F.col("a").alias("b"), F.col("m").alias("next"))
        several = not least.where("n > 1").isEmpty()
        if not several and pairs.join(nodes, "b", "left_semi").isEmpty():
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("component_id"))
        own = least.select("a", F.col("m").alias("b"))
        rest = pairs.join(least.select("a", "m"), "a").where("b <> m")
        tied = rest.select(F.col("b").alias("a"), F.col("m").alias("b"))
        known = own.unionByName(tied)
        shorter = known.join(nodes, "b", "left").select("a", F.coalesce("next", "b").alias("b"))
        pairs = cut_lineage(shorter.mapInPandas(_contract, "a long, b long").distinct())
