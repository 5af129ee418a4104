"""Packing documents into sequences: patterns of few lengths, fitted to the length histogram.

1. Every document is encoded and closed by the end id; longer ones are cut into pieces.
2. Patterns of two to four present lengths that fill a sequence are enumerated, the last length
   always the largest that still fits. Non-negative least squares fits how often each pattern is
   used to the histogram of lengths; counts are rounded so that errors carry from pattern to
   pattern, and never use more pieces than there are.
3. What is left over is packed by best fit on the histogram, longest first.
4. The plan is a table of slots: pieces of one length with ranks in a range go to given places.
   Each piece gets its rank in its length from counts by (length, salt), so a length that holds
   any share of the rows is split over tasks.

Only the histogram, with as many rows as a sequence has tokens at most, and the plan, whose size
depends on the number of different lengths, pass through the driver.

Defined results: a null or empty text is one piece, the end id alone. Repeated rows are separate
documents. An empty table gives no pieces.
"""

from __future__ import annotations

import bisect
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackflow.llm.bpe import library_encoder
from trackflow.llm.shared import cut_lineage, per_text

SEQUENCE = 4096
GRID = 96
NARROW_GRID = 12
STEPS = 150
ROWS_PER_SALT = 20_000
END_ID = 1
RANK_BITS = 44

Slot = tuple[int, int, int, int, int, int]  # length, first rank, ranks, repeats, sequence, offset


def pieces(
    docs: DataFrame, vocabulary: str, capacity: int = SEQUENCE, with_ids: bool = False
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids``."""
    shipped = docs.sparkSession.sparkContext.broadcast(vocabulary)
    end = np.array([END_ID], "<u4").tobytes()

    def cut(text: str) -> list[tuple]:
        data = library_encoder(shipped.value).encode_bytes(text) + end
        rows = []
        for n, at in enumerate(range(0, len(data), 4 * capacity)):
            part = data[at : at + 4 * capacity]
            row = (n, at // 4, len(part) // 4, zlib.crc32(part))
            rows.append((*row, np.frombuffer(part, "<u4").tolist()) if with_ids else row)
        return rows

    schema = "piece int, start long, length long, ids_crc32 long"
    schema += ", ids array<long>" * with_ids
    return per_text(docs, schema, cut, done=library_encoder.cache_clear)


def patterns(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> np.ndarray:
    """Rows of four indexes into ``lengths``, descending; -1 where a pattern has fewer."""

    def last(room: np.ndarray) -> np.ndarray:
        return np.searchsorted(lengths, room, "right") - 1

    def grid(size: int) -> np.ndarray:
        share = (np.arange(min(size, len(lengths))) + 0.5) / min(size, len(lengths))
        places = np.searchsorted(np.cumsum(counts) / counts.sum(), share)
        return np.unique(np.minimum(places, len(lengths) - 1))

    every = np.arange(len(lengths))
    one = np.stack([every, last(capacity - lengths)])
    a, b = (x.ravel() for x in np.meshgrid(every, grid(GRID), indexing="ij"))
    two = np.stack([a, b, last(capacity - lengths[a] - lengths[b])])
    narrow = grid(NARROW_GRID)
    a, b, c = (x.ravel() for x in np.meshgrid(every, narrow, narrow, indexing="ij"))
    three = np.stack([a, b, c, last(capacity - lengths[a] - lengths[b] - lengths[c])])
    found = []
    for part in (one, two, three):
        part = np.sort(part[:, part.min(axis=0) >= 0], axis=0)[::-1]
        found.append(np.vstack([part, np.full((4 - len(part), part.shape[1]), -1)]).T)
    return np.unique(np.vstack(found), axis=0)


def fit(found: np.ndarray, counts: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Non-negative least squares of pattern uses against the histogram.

    Multiplicative steps keep every value non-negative; errors of the histogram are weighed by
    one over the count, and patterns start the lower the more room they waste.
    """
    used = found >= 0
    index = np.where(used, found, 0)
    weight = 1.0 / np.maximum(counts, 1.0)

    def down(x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(counts))
        for k in range(found.shape[1]):
            total += np.bincount(index[:, k], x * used[:, k], len(counts))
        return total

    def up(y: np.ndarray) -> np.ndarray:
        return (y[index] * used).sum(axis=1)

    wanted = up(weight * counts)
    x = np.exp(-room / 8.0) + 1e-9
    x *= counts.sum() / down(x).sum()
    for _ in range(STEPS):
        x *= wanted / np.maximum(up(weight * down(x)), 1e-12)
    return x


def plan(histogram: dict[int, int], capacity: int = SEQUENCE) -> tuple[list[Slot], int]:
    """Slots for all pieces of the histogram, and the number of sequences."""
    lengths = np.array(sorted(histogram), np.int64)
    total = np.array([histogram[n] for n in lengths.tolist()], np.int64)
    left, taken = total.copy(), np.zeros_like(total)
    slots: list[Slot] = []
    sequences = 0
    inner = int(np.searchsorted(lengths, capacity))
    bins: list[tuple[int, int, list[tuple[int, int]]]] = []  # room, number of bins, contents
    if inner < len(lengths):
        bins.append((0, int(left[inner]), [(inner, 1)]))
        left[inner] = 0
    if inner:
        found = patterns(lengths[:inner], total[:inner], capacity)
        if len(found):
            size = np.where(found >= 0, lengths[np.maximum(found, 0)], 0).sum(axis=1)
            uses = fit(found, total[:inner].astype(float), capacity - size)
            whole = np.floor(np.cumsum(uses)).astype(np.int64)
            whole = np.diff(whole, prepend=0)
            for p in np.flatnonzero(whole).tolist():
                ids, each = np.unique(found[p][found[p] >= 0], return_counts=True)
                n = int(min(whole[p], (left[ids] // each).min()))
                if n:
                    left[ids] -= n * each
                    contents = list(zip(ids.tolist(), each.tolist(), strict=True))
                    bins.append((int(capacity - size[p]), n, contents))
    for room, n, contents in best_fit(bins, lengths.tolist(), left.tolist(), capacity):
        offset = 0
        for i, each in contents:
            length = int(lengths[i])
            slots.append((length, int(taken[i]), n * each, each, sequences, offset))
            taken[i] += n * each
            offset += each * length
        sequences += n
    assert (taken == total).all()
    return slots, sequences


def best_fit(bins: list, lengths: list[int], left: list[int], capacity: int) -> list:
    """Bins with the leftover pieces added: longest first, into the least room that fits."""
    rooms: dict[int, list] = {}
    for room, n, contents in bins:
        rooms.setdefault(room, []).append((n, contents))
    order = sorted(rooms)
    done = []

    def put(room: int, n: int, contents: list) -> None:
        if room not in rooms:
            bisect.insort(order, room)
            rooms[room] = []
        rooms[room].append((n, contents))

    for i in range(len(lengths) - 1, -1, -1):
        length, count = lengths[i], left[i]
        while count:
            at = bisect.bisect_left(order, length)
            if at == len(order):
                fits = capacity // length
                if count >= fits:
                    put(capacity - fits * length, count // fits, [(i, fits)])
                if count % fits:
                    put(capacity - count % fits * length, 1, [(i, count % fits)])
                break
            room = order[at]
            n, contents = rooms[room].pop()
            if not rooms[room]:
                del rooms[room], order[at]
            each = min(room // length, max(1, count // n))
            into = min(n, count // each)
            if into < n:
                put(room, n - into, contents)
            put(room - each * length, into, [*contents, (i, each)])
            count -= each * into
    for room, groups in rooms.items():
        done += [(room, n, contents) for n, contents in groups]
    return done


def pack(cut: DataFrame, capacity: int = SEQUENCE) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``; ``cut`` needs ``doc_id, piece, length``."""
    rows = cut_lineage(cut)
    salts = max(1, math.ceil(rows.count() / ROWS_PER_SALT))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    counted = cut_lineage(salted.groupBy("length", "salt").agg(F.count("*").alias("n")))
    histogram = {r[0]: r[1] for r in counted.groupBy("length").agg(F.sum("n")).collect()}
    slots, _ = plan(histogram, capacity)
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = counted.select(
        "length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")
    )
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        salted.withColumn("place", F.row_number().over(within) - 1)
        .join(starts, ["length", "salt"])
        .withColumn("rank", F.col("first") + F.col("place"))
        .drop("first", "place", "salt")
    )
    return _placed(ranked, slots)


def _placed(ranked: DataFrame, slots: list[Slot]) -> DataFrame:
    """Look each (length, rank) up in the slots, which are sorted by both."""
    shape = np.array(sorted(slots), np.int64).reshape(-1, 6)
    shipped = ranked.sparkSession.sparkContext.broadcast(shape)
    fields = [f for f in ranked.schema.fields if f.name != "rank"]
    names = [f.name for f in fields]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        by = shipped.value
        keys = by[:, 0] << RANK_BITS | by[:, 1]
        for frame in frames:
            rank = frame["rank"].to_numpy(np.int64)
            wanted = frame["length"].to_numpy(np.int64) << RANK_BITS | rank
            slot = by[np.searchsorted(keys, wanted, "right") - 1]
            past = rank - slot[:, 1]
            out = frame[names].copy()
            out["sequence_id"] = slot[:, 4] + past // slot[:, 3]
            out["offset"] = slot[:, 5] + past % slot[:, 3] * slot[:, 0]
            yield out

    return ranked.mapInPandas(place, f"{schema}, sequence_id long, offset long")
