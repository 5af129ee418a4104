"""Exact top-k by inner product: a KD-tree per shard, leaves in order of their bounds.

Rows are dealt to shards by hash; each shard is split at medians of its widest dimension until
leaves are small, and each leaf keeps its tight bounding box. For a block of queries the best
product that any point of each box could have is computed; each query takes leaves from the
highest bound down and stops when the bound falls below its k-th best score. Each query block
first meets one shard; the k-th scores found there go with it to all others.

Defined results: vectors that are null, empty, or hold null or non-finite components take no
part, nor do rows with a null id. Exact repeats of a row count once. Vectors of another length
than the query's are no candidates. Scores beyond the range of a long are held at its ends.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackflow.llm.neardup import usable
from trackflow.llm.shared import cut_lineage

K = 10
SHARD_ROWS = 8_192
BLOCK_ROWS = 256
LEAF = 128
LONG = np.iinfo(np.int64)
NONE = float("-inf")


def scaled(embedding: Column) -> Column:
    """Components as whole numbers: floor(1024 * x)."""
    return F.transform(embedding.cast("array<double>"), lambda x: F.floor(x * 1024).cast("long"))


def leaves(points: np.ndarray) -> list[np.ndarray]:
    """Places of the points of each leaf: median splits of the widest dimension."""
    done, open_ = [], [np.arange(len(points))]
    while open_:
        part = open_.pop()
        if len(part) <= LEAF:
            done.append(part)
            continue
        own = points[part].astype(np.float64)
        widest = int((own.max(axis=0) - own.min(axis=0)).argmax())
        order = np.argpartition(own[:, widest], len(part) // 2)
        open_ += [part[order[: len(part) // 2]], part[order[len(part) // 2 :]]]
    return done


def _tree(frame: pd.DataFrame) -> pd.DataFrame:
    points = np.stack(frame["vector"].to_list()).astype(np.int64)
    parts = leaves(points)
    order = np.concatenate(parts)
    narrow = np.int16 if np.abs(points.astype(np.float64)).max() < 2**15 else np.int64
    return pd.DataFrame(
        {
            "shard": frame["shard"].iloc[:1].to_numpy(),
            "size": frame["size"].iloc[:1].to_numpy(),
            "ids": [frame["vec_id"].to_numpy("<i8")[order].tobytes()],
            "points": [points[order].astype(narrow).tobytes()],
            "low": [np.stack([points[p].min(axis=0) for p in parts]).astype(narrow).tobytes()],
            "high": [np.stack([points[p].max(axis=0) for p in parts]).astype(narrow).tobytes()],
            "cuts": [np.cumsum([0, *map(len, parts)]).tolist()],
        }
    )


def _block(frame: pd.DataFrame) -> pd.DataFrame:
    vectors = np.stack(frame["vector"].to_list()).astype("<i8")
    return pd.DataFrame(
        {
            "block": frame["block"].iloc[:1].to_numpy(),
            "size": frame["size"].iloc[:1].to_numpy(),
            "query_ids": [frame["vec_id"].to_numpy("<i8").tobytes()],
            "queries": [vectors.tobytes()],
        }
    )


class Best:
    """The k best of each query: higher scores first, then smaller ids."""

    def __init__(self, query_ids: np.ndarray, k: int):
        self.ids = np.full((len(query_ids), k), LONG.max)
        self.scores = np.full((len(query_ids), k), NONE, object)
        self.query_ids, self.k = query_ids, k

    def add(self, which: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        scores = np.where(ids[None] == self.query_ids[which][:, None], NONE, scores)
        all_scores = np.hstack([self.scores[which].astype(scores.dtype), scores])
        all_ids = np.hstack([self.ids[which], np.broadcast_to(ids, scores.shape)])
        order = np.lexsort((all_ids, -all_scores), axis=1)[:, : self.k]
        self.scores[which] = np.take_along_axis(all_scores, order, 1)
        self.ids[which] = np.take_along_axis(all_ids, order, 1)


def search(row, k: int) -> pd.DataFrame:
    """The best of one shard for one block of queries."""
    size = row.size_
    ids = np.frombuffer(row.ids, "<i8")
    kind = np.int16 if len(row.points) == 2 * size * len(ids) else np.int64
    points, low, high = (
        np.frombuffer(x, kind).reshape(-1, size) for x in (row.points, row.low, row.high)
    )
    query_ids = np.frombuffer(row.query_ids, "<i8")
    queries = np.frombuffer(row.queries, "<i8").reshape(-1, size)
    largest = np.abs(queries.astype(float)).max() * max(1, np.abs(points.astype(float)).max())
    number = np.float64 if largest * size < 2.0**52 else object  # exact either way
    queries = queries.astype(number)
    bounds = np.maximum(queries, 0) @ high.astype(number).T
    bounds = bounds + np.minimum(queries, 0) @ low.astype(number).T
    order = np.argsort(-bounds, axis=1, kind="stable")
    floor = np.array([NONE if math.isnan(x) else int(x) for x in row.floor], object)
    best = Best(query_ids, k)
    best.scores = best.scores.astype(number)
    active = np.arange(len(queries))
    for step in range(bounds.shape[1]):
        leaf = order[active, step]
        kth = np.maximum(best.scores[active, -1], floor[active].astype(number))
        live = bounds[active, leaf] >= kth
        active, leaf = active[live], leaf[live]
        if not len(active):
            break
        for one in np.unique(leaf):
            which = active[leaf == one]
            cut = slice(row.cuts[one], row.cuts[one + 1])
            best.add(which, queries[which] @ points[cut].astype(number).T, ids[cut])
    found = best.scores != NONE
    scores = [min(max(int(s), LONG.min), LONG.max) for s in best.scores[found]]
    return pd.DataFrame(
        {
            "query_id": np.repeat(query_ids, found.sum(axis=1)),
            "vec_id": best.ids[found],
            "score": np.array(scores, np.int64),
        }
    )


def _search(k: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.rename(columns={"size": "size_"}).itertuples(index=False):
                yield search(row, k)

    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best other rows of each row chosen as query.

    ``vectors`` has ``vec_id`` and ``embedding``; ``is_query`` is a condition on ``vec_id``.
    """
    rows = cut_lineage(
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
        .where(F.col("vec_id").isNotNull() & usable(F.col("embedding").cast("array<double>")))
        .select("vec_id", scaled(F.col("embedding")).alias("vector"))
        .distinct()
        .withColumn("size", F.size("vector"))
    )
    shards = max(1, math.ceil(rows.count() / SHARD_ROWS))
    trees = cut_lineage(
        rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(shards)))
        .groupBy("shard", "size")
        .applyInPandas(
            _tree,
            "shard long, size int, ids binary, points binary, low binary, high binary, "
            "cuts array<long>",
        )
    )
    chosen = rows.where(is_query)
    blocks = max(1, math.ceil(chosen.count() / BLOCK_ROWS))
    queries = cut_lineage(
        chosen.withColumn("block", F.pmod(F.xxhash64("vec_id", "vector", "size"), F.lit(blocks)))
        .groupBy("block", "size")
        .applyInPandas(_block, "block long, size int, query_ids binary, queries binary")
    )
    schema = "query_id long, vec_id long, score long"
    home = F.pmod(F.col("block"), F.lit(shards).cast("long"))
    ids = F.col("query_ids")
    first = cut_lineage(
        queries.withColumn("shard", home)
        .withColumn("floor", F.array_repeat(F.lit(float("nan")), (F.length(ids) / 8).cast("int")))
        .join(trees, ["shard", "size"])
        .mapInPandas(_search(k), schema)
    )
    kth = (
        first.groupBy("query_id")
        .agg(F.count("*").alias("n"), F.min("score").alias("floor"))
        .where(F.col("n") >= k)
        .drop("n")
    )
    wide = (
        chosen.join(kth.withColumnRenamed("query_id", "vec_id"), "vec_id", "left")
        .withColumn("block", F.pmod(F.xxhash64("vec_id", "vector", "size"), F.lit(blocks)))
        .groupBy("block", "size")
        .applyInPandas(
            _block_with_floor,
            "block long, size int, query_ids binary, queries binary, floor array<double>",
        )
    )
    others = F.filter(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")), lambda s: s != home)
    rest = (
        cut_lineage(wide)
        .withColumn("shard", F.explode(others))
        .join(trees, ["shard", "size"])
        .mapInPandas(_search(k), schema)
    )
    return _ranked(first.unionByName(rest), k).select("query_id", "rank", "vec_id", "score")


def _block_with_floor(frame: pd.DataFrame) -> pd.DataFrame:
    """A block with each query's k-th score so far, rounded down where a double cannot hold it."""
    floor = frame["floor"].astype(float).map(lambda x: x - abs(x) * 2.0**-50)
    return _block(frame).assign(floor=[floor.tolist()])
