"""A uniform shuffle of rows into shards of exact sizes, by a communication matrix.

Rows are dealt to input partitions by hash. How many rows each partition sends to each shard is
drawn from the multivariate hypergeometric law, which is the law of these counts under a uniform
permutation of all rows. Each partition permutes its rows and sends the first ones to the first
shard, and so on; each shard permutes what it gets, in parts whose sizes are counted.

Random order comes from hashes of the row and a seed, so a repeated or recovered task gives the
same result. Only counts by partition pass through the driver: one number for each
``PARTITION_ROWS`` rows.

Defined results: shard sizes are at most one apart. Null values are values like others. Equal
rows are interchangeable and each gets its own place. An empty table gives no rows.
"""

from __future__ import annotations

import math
import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARDS = 8
PARTITION_ROWS = 20_000
SEED = 20_240_601


def hypergeometric(rng: random.Random, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` from ``good + bad`` are good: the inverse of the law, searched from
    its mode outwards, so that numbers of any size take about as many steps as it spreads."""
    low, high = max(0, draws - bad), min(good, draws)
    mode = min(max((draws + 1) * (good + 1) // (good + bad + 2), low), high)

    def choose(n: int, k: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    top = math.exp(choose(good, mode) + choose(bad, draws - mode) - choose(good + bad, draws))
    left = rng.random() - top
    up = down = mode
    p_up = p_down = top
    while left > 0 and (up < high or down > low):
        if up < high:
            p_up *= (good - up) * (draws - up) / ((up + 1) * (bad - draws + up + 1))
            up += 1
            left -= p_up
            if left <= 0:
                return up
        if down > low:
            p_down *= down * (bad - draws + down) / ((good - down + 1) * (draws - down + 1))
            down -= 1
            left -= p_down
            if left <= 0:
                return down
    return mode


def communication_matrix(sizes: list[int], shards: list[int], seed: int) -> list[list[int]]:
    """Rows: partitions of the given sizes; columns: shards of the given sizes."""
    rng = random.Random(seed)
    room, matrix = list(shards), []
    for size in sizes:
        row, left, total = [], size, sum(room)
        for place in room:
            count = hypergeometric(rng, place, total - place, left) if left else 0
            row.append(count)
            left, total = left - count, total - place
        room = [a - b for a, b in zip(room, row, strict=True)]
        matrix.append(row)
    return matrix


def _random(salt: int, columns: list[str]) -> Column:
    return F.xxhash64(F.lit(SEED + salt), *columns)


def shuffle_into_shards(rows: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """The rows as ``row``, with ``shard`` and ``slot`` (gapless from 0 in each shard).

    ``row`` is a struct of all input columns, so that no name can clash. Columns must be
    hashable: not maps.
    """
    columns = rows.columns
    quoted = [f"`{c}`" for c in columns]
    packed = rows.select(F.struct(*quoted).alias("row"), _random(0, quoted).alias("mark"))
    counted = rows.select(_random(0, quoted).alias("mark"))
    total = counted.count()
    parts = max(1, math.ceil(total / PARTITION_ROWS))
    part = F.pmod("mark", F.lit(parts)).cast("int")
    sizes = {r[0]: r[1] for r in counted.groupBy(part.alias("part")).count().collect()}
    wanted = [total // shards + (s < total % shards) for s in range(shards)]
    order = sorted(sizes)
    matrix = communication_matrix([sizes[p] for p in order], wanted, seed)
    plan = [
        (p, [sum(row[: n + 1]) for n in range(shards)])
        for p, row in zip(order, matrix, strict=True)
    ]
    bounds = rows.sparkSession.createDataFrame(plan, "part int, bounds array<long>")
    first = Window.partitionBy("part").orderBy("shuffled", "row")
    sent = (
        packed.withColumn("part", part)
        .withColumn("shuffled", F.xxhash64(F.lit(seed + 1), "row"))
        .withColumn("rank", F.row_number().over(first))
        .join(bounds, "part")
        .withColumn("shard", F.size(F.filter("bounds", lambda b: b < F.col("rank"))))
        .withColumn("shuffled", F.xxhash64(F.lit(seed + 2), "row", "part"))
        .withColumn("chunk", F.pmod(F.xxhash64(F.lit(seed + 3), "row"), F.lit(parts)))
        .select("row", "shard", "chunk", "shuffled")
    )
    before = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        sent.groupBy("shard", "chunk")
        .agg(F.count("*").alias("n"))
        .select("shard", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    )
    second = Window.partitionBy("shard", "chunk").orderBy("shuffled", "row")
    return (
        sent.withColumn("place", F.row_number().over(second))
        .join(starts, ["shard", "chunk"])
        .select("row", "shard", (F.col("start") + F.col("place") - 1).alias("slot"))
    )
