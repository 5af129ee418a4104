"""Key ranges of boxes, and the points they find."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from trackflow.operators.features import st_index
from trackflow.operators.ranges import key_ranges, points_within


def interleaved(x, y, t, bits):
    return sum(
        (x >> b & 1) << 3 * b | (y >> b & 1) << 3 * b + 1 | (t >> b & 1) << 3 * b + 2
        for b in range(bits)
    )


@pytest.mark.parametrize("most", [1, 8, 40, 10_000])
def test_ranges_cover_the_box(most):
    rng, bits = random.Random(most), 4
    for _ in range(20):
        low = tuple(rng.randrange(16) for _ in range(3))
        high = tuple(rng.randint(at, 15) for at in low)
        inside = {
            interleaved(x, y, t, bits)
            for x in range(low[0], high[0] + 1)
            for y in range(low[1], high[1] + 1)
            for t in range(low[2], high[2] + 1)
        }
        ranges = key_ranges(low, high, bits, most)
        covered = {key for first, last in ranges for key in range(first, last + 1)}
        assert inside <= covered and len(ranges) <= most + 7
        assert all(a[1] + 1 < b[0] for a, b in zip(ranges, ranges[1:]))
        if most == 10_000:
            assert covered == inside


def test_points_of_boxes_equal_a_plain_filter(spark):
    rng = random.Random(6)
    start = datetime.datetime(2019, 11, 1)
    rows = [
        (i, rng.uniform(-180, 180), rng.uniform(-90, 90),
         start + datetime.timedelta(seconds=rng.randrange(10**8)))
        for i in range(3000)
    ]
    rows += [(3000, 180.0, 90.0, datetime.datetime(2020, 12, 31, 23, 59, 59)), (3001, None, 1.0, None)]
    points = st_index(
        spark.createDataFrame(rows, "id int, lon double, lat double, time timestamp_ntz")
    ).cache()
    boxes = [
        (-10.0, -20.0, 60.0, 45.5, datetime.datetime(2020, 2, 1), datetime.datetime(2020, 2, 9)),
        (-180.0, -90.0, 180.0, 90.0, start, datetime.datetime(2023, 1, 1)),
        (150.0, -30.0, -150.0, 30.0, datetime.datetime(2019, 12, 30), datetime.datetime(2022, 1, 2)),
        (5.0, 5.0, 5.0, 5.0, start, start),
        (0.0, 10.0, 1.0, 5.0, start, datetime.datetime(2023, 1, 1)),
    ]
    for west, south, east, north, begin, end in boxes:
        lon = F.col("lon")
        around = lon.between(west, east) if west <= east else (lon >= west) | (lon <= east)
        plain = points.where(
            around & F.col("lat").between(south, north) & F.col("time").between(begin, end)
        )
        for most in (1, 64):
            found = points_within(points, west, south, east, north, begin, end, most=most)
            assert sorted(r.id for r in found.collect()) == sorted(r.id for r in plain.collect())
