"""Reading the points of a place and a time from a table in index order.

A box of longitude, latitude and time is cut into ranges of the space-time key: the cube of all
keys of a year is split into eighths, the largest piece that lies partly in the box first, until
enough pieces are there. Each piece is one range of keys. Years and ranges become predicates
that prune folders and skip row groups; what the cells leave at the edges goes by the columns.
"""

from __future__ import annotations

import calendar
import heapq
import math
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackflow.functions.spacetime import BITS

RANGES = 64

Cells = tuple[int, int, int]  # of longitude, latitude and time


def _cell(fraction: float, bits: int) -> int:
    return min(max(math.floor(fraction * (1 << bits)), 0), (1 << bits) - 1)


def _year_cell(ts: datetime, bits: int) -> int:
    seconds = (ts.timetuple().tm_yday - 1) * 86400 + ts.hour * 3600 + ts.minute * 60 + ts.second
    return (seconds << bits) // ((366 if calendar.isleap(ts.year) else 365) * 86400)


def key_ranges(low: Cells, high: Cells, bits: int = BITS, most: int = RANGES) -> list:
    """Ranges ``(first, last)`` of keys that cover all cells from ``low`` to ``high``.

    There are at most about ``most`` of them; they are exact when that is enough.
    """

    def piece(level: int, corner: Cells, first: int) -> tuple | None:
        """A cube as (is inside, size, first key, last key, corner); None outside the box."""
        size = 1 << (bits - level)
        ends = [c + size - 1 for c in corner]
        if any(c > h or e < at for c, e, at, h in zip(corner, ends, low, high)):
            return None
        inside = all(at <= c and e <= h for c, e, at, h in zip(corner, ends, low, high))
        return inside, level, corner, first

    done, open_pieces = [], []

    def put(found: tuple | None) -> None:
        if found is not None:
            inside, level, corner, first = found
            (done.append if inside else lambda p: heapq.heappush(open_pieces, p))(
                (level, first, corner)
            )

    put(piece(0, (0, 0, 0), 0))
    while open_pieces and len(done) + len(open_pieces) < most:
        level, first, corner = heapq.heappop(open_pieces)
        half = 1 << (bits - level - 1)
        for part in range(8):
            moved = tuple(c + half * (part >> axis & 1) for axis, c in enumerate(corner))
            put(piece(level + 1, moved, first + part * half**3))
    merged: list[list[int]] = []
    for first, level in sorted((first, level) for level, first, _ in done + open_pieces):
        last = first + (1 << 3 * (bits - level)) - 1
        if merged and merged[-1][1] + 1 == first:
            merged[-1][1] = last
        else:
            merged.append([first, last])
    return [tuple(found) for found in merged]


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def points_within(
    points: DataFrame,
    west: float,
    south: float,
    east: float,
    north: float,
    begin: datetime,
    end: datetime,
    bits: int = BITS,
    most: int = RANGES,
) -> DataFrame:
    """The points of a box, borders included; ``west`` above ``east`` goes round the world.

    ``points`` has ``lon, lat, time, time_bin, st_key``, best from a table written in index order.
    """
    if west > east:
        halves = [(west, 180.0), (-180.0, east)]
    else:
        halves = [(west, east)]
    cells = (1 << bits) - 1
    years = {begin.year, end.year}
    spans = [
        (
            year, year,
            _year_cell(begin, bits) if year == begin.year else 0,
            _year_cell(end, bits) if year == end.year else cells,
        )
        for year in sorted(years)
    ]
    if end.year - begin.year > 1:
        spans.append((begin.year + 1, end.year - 1, 0, cells))
    wanted = []
    for first_year, last_year, first, last in spans:
        ranges = [
            found
            for left, right in halves
            for found in key_ranges(
                (_cell((left + 180) / 360, bits), _cell((south + 90) / 180, bits), first),
                (_cell((right + 180) / 360, bits), _cell((north + 90) / 180, bits), last),
                bits,
                most,
            )
        ]
        if ranges:
            keys = _any([F.col("st_key").between(low, high) for low, high in ranges])
            wanted.append(F.col("time_bin").between(first_year, last_year) & keys)
    if not wanted or begin > end or south > north:
        return points.where(F.lit(False))
    exact = (
        _any([F.col("lon").between(left, right) for left, right in halves])
        & F.col("lat").between(south, north)
        & F.col("time").between(F.lit(begin), F.lit(end))
    )
    in_years = F.col("time_bin").between(begin.year, end.year)
    return points.where(in_years).where(_any(wanted)).where(exact)
