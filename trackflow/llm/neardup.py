"""Near-duplicate vectors of equal label, by int8 tile products with error bounds.

1. Equal vectors of one label become one class with a count, so copies are never paired.
2. Classes are laid out by label and projection and cut into tiles. A tile has its vectors, their
   int8 form with a scale, and the length of each vector's quantisation error. Tiles whose boxes
   of projections are further apart than linked vectors can be are never paired.
3. A tile pair's int8 product, plus the bound that the two errors allow, tells which pairs may
   reach the threshold; only those are computed again in double precision.
4. Each tile pair gives counts per class and its links folded to stars, never a list of all
   pairs; components follow from the stars.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components, and
rows with a null label, link with nothing; vectors of different lengths do not link. Each row of
the input gives one row. Rows that share a vec_id are the same node of the link graph. A null
vec_id is a component of its own with a null id, not kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackflow.llm.components import connected, stars
from trackflow.llm.shared import cut_lineage

THRESHOLD = 0.98
TILE = 2048
BOX = 8
SLACK = 1e-9
PAIRS_AT_ONCE = 20_000


def usable(vector: Column) -> Column:
    """Not null, and neither empty nor with null or non-finite components."""
    bad = F.exists(
        vector,
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))),
    )
    return F.coalesce((F.size(vector) > 0) & ~bad, F.lit(False))


def _units(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def directions(size: int) -> np.ndarray:
    """A few fixed orthonormal directions; projections on them part tiles."""
    wide = np.random.default_rng(7).normal(size=(size, min(BOX, size)))
    return np.linalg.qr(wide)[0]


def quantise(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 vectors, their scales, and upper bounds of the lengths of their errors."""
    scale = np.abs(units).max(axis=1) / 127.0
    small = np.rint(units / scale[:, None]).astype(np.int8)
    error = units - small * scale[:, None]
    return small, scale, np.sqrt((error * error).sum(axis=1)) + SLACK


def possible(a: tuple, b: tuple, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs whose cosine may reach the threshold."""
    exact = np.float32 if a[0].shape[1] * 127**2 < 2**24 else np.float64
    product = (a[0].astype(exact) @ b[0].astype(exact).T).astype(np.float64)
    product *= a[1][:, None] * b[1][None]
    ea, eb = a[2][:, None], b[2][None]
    # |uv - u'v'| <= |du||v'| + |u'||dv| + |du||dv| with |u'| <= 1 + |du|
    return np.nonzero(product + (ea + eb + 3 * ea * eb) >= threshold - SLACK)


def linked(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, threshold: float):
    """Those of the pairs whose cosine, in double precision, is at least the threshold."""
    keep = np.zeros(len(i), bool)
    na = np.sqrt((a * a).sum(axis=1))
    nb = np.sqrt((b * b).sum(axis=1))
    for at in range(0, len(i), PAIRS_AT_ONCE):
        p, q = i[at : at + PAIRS_AT_ONCE], j[at : at + PAIRS_AT_ONCE]
        dot = np.einsum("nd,nd->n", a[p], b[q])
        keep[at : at + PAIRS_AT_ONCE] = dot / (na[p] * nb[q]) >= threshold
    return i[keep], j[keep]


def _tiles(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Consecutive rows of one label and length, at most TILE, as one row of packed arrays."""
    held: list = []

    def packed() -> pd.DataFrame:
        vectors = np.stack([row.vector for row in held]).astype(np.float64)
        projected = _units(vectors) @ directions(vectors.shape[1])
        first = held[0]
        single = (vectors.astype(np.float32) == vectors).all()
        return pd.DataFrame(
            {
                "label": [first.label],
                "size": [first.size_],
                "tile": [first.hi],
                "node": [np.array([r.node for r in held], "<i8").tobytes()],
                "copies": [np.array([r.copies for r in held], "<i8").tobytes()],
                "hi": [np.array([r.hi for r in held], "<i8").tobytes()],
                "lo": [np.array([r.lo for r in held], "<i8").tobytes()],
                "vectors": [vectors.astype(np.float32 if single else np.float64).tobytes()],
                "low": [projected.min(axis=0)],
                "high": [projected.max(axis=0)],
            }
        )

    for frame in frames:
        for row in frame.rename(columns={"size": "size_"}).itertuples(index=False):
            if held and (
                len(held) == TILE or (held[0].label, held[0].size_) != (row.label, row.size_)
            ):
                yield packed()
                held = []
            held.append(row)
    if held:
        yield packed()


def _unpack(row, side: str) -> dict:
    node = np.frombuffer(getattr(row, f"node_{side}"), "<i8")
    raw = getattr(row, f"vectors_{side}")
    kind = np.float32 if len(raw) == 4 * len(node) * row.size_ else np.float64
    vectors = np.frombuffer(raw, kind).reshape(len(node), row.size_).astype(np.float64)
    part = {k: np.frombuffer(getattr(row, f"{k}_{side}"), "<i8") for k in ("copies", "hi", "lo")}
    units = _units(vectors)
    return part | {"node": node, "units": units, "vectors": vectors, "small": quantise(units)}


def _compare(threshold: float):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.rename(columns={"size": "size_"}).itertuples(index=False):
                yield compared(row)

    def compared(row) -> pd.DataFrame:
        a = _unpack(row, "a")
        same = row.tile_a == row.tile_b
        b = a if same else _unpack(row, "b")
        i, j = possible(a["small"], b["small"], threshold)
        if same:
            i, j = i[i < j], j[i < j]
        # the vectors, not their units, so that the double precision is that of the definition
        i, j = linked(a["vectors"], b["vectors"], i, j, threshold)
        counts = []
        for x, p, y, q in ((a, i, b, j), (b, j, a, i)):
            links = np.bincount(p, y["copies"][q], len(x["node"])).astype(np.int64)
            some = np.flatnonzero(links)
            counts.append(
                {"hi": x["hi"][some], "lo": x["lo"][some], "n": links[some], "a": 0, "b": 0}
            )
        node, root = stars(a["node"][i], b["node"][j])
        counts.append({"hi": 0, "lo": 0, "n": np.zeros(len(node), np.int64), "a": node, "b": root})
        return pd.concat([pd.DataFrame(c) for c in counts])

    return run


def near_duplicates(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row."""
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("node"),
        F.col(label).alias("label"),
        F.col(embedding).cast("array<double>").alias("vector"),
    )
    fit = usable(F.col("vector")) & F.col("label").isNotNull() & F.col("node").isNotNull()
    fit = fit & F.exists("vector", lambda x: x != 0)
    keyed = rows.withColumn("fit", F.coalesce(fit, F.lit(False)))
    keyed = keyed.withColumn("hi", F.when(F.col("fit"), F.xxhash64("label", "vector")))
    keyed = keyed.withColumn("lo", F.when(F.col("fit"), F.xxhash64("vector", "label")))
    classes = cut_lineage(
        keyed.where("fit")
        .groupBy("label", "hi", "lo")
        .agg(
            F.min("node").alias("node"),
            F.count("*").alias("copies"),
            F.first("vector").alias("vector"),
        )
        .withColumn("size", F.size("vector"))
    )
    counted, links = _links(classes, threshold)
    extra = classes.select("hi", "lo", "copies", F.col("node").alias("first"))
    extra = extra.join(counted, ["hi", "lo"], "left")
    extra = extra.join(links.withColumnRenamed("node", "first"), "first", "left").select(
        "hi",
        "lo",
        (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
        F.coalesce("component_id", "first").alias("component_id"),
    )
    own = keyed.drop("vector", "label", "fit").join(extra, ["hi", "lo"], "left")
    return own.select(
        F.col("node").alias("vec_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "node").alias("component_id"),
        F.coalesce(F.coalesce("component_id", "node") == F.col("node"), F.lit(False)).alias("kept"),
    )


def _links(classes: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Counts of links by class, and the components of their nodes."""
    label = classes.schema["label"].dataType.simpleString()
    along = F.aggregate(
        "vector",
        F.struct(F.lit(0.0).alias("along"), F.lit(0.0).alias("square"), F.lit(1).alias("sign")),
        lambda s, x: F.struct(
            (s["along"] + x * s["sign"]).alias("along"),
            (s["square"] + x * x).alias("square"),
            (-s["sign"]).alias("sign"),
        ),
    )
    tiles = cut_lineage(
        classes.withColumn("s", along)
        .withColumn("along", F.try_divide("s.along", F.sqrt("s.square")))
        .drop("s")
        .repartitionByRange("label", "size", "along", "hi")
        .sortWithinPartitions("label", "size", "along", "hi")
        .mapInPandas(
            _tiles,
            f"label {label}, size int, tile long, node binary, copies binary, hi binary, "
            "lo binary, vectors binary, low array<double>, high array<double>",
        )
    )
    boxes = tiles.select("label", "size", "tile", "low", "high")

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(
            *(F.col(c).alias(c if c in ("label", "size") else f"{c}_{name}") for c in df.columns)
        )

    reach = 2 - 2 * threshold + SLACK  # the square of the distance of linked unit vectors
    gap = F.aggregate(
        F.zip_with(
            F.zip_with("low_a", "high_b", lambda x, y: x - y),
            F.zip_with("low_b", "high_a", lambda x, y: x - y),
            lambda x, y: F.greatest(x, y, F.lit(0.0)),
        ),
        F.lit(0.0),
        lambda s, x: s + x * x,
    )
    near = (
        side(boxes, "a")
        .join(side(boxes, "b"), ["label", "size"])
        .where((F.col("tile_a") <= F.col("tile_b")) & (gap <= reach))
        .select("label", "size", "tile_a", "tile_b")
    )
    full = tiles.drop("low", "high")
    found = cut_lineage(
        near.join(side(full, "a"), ["label", "size", "tile_a"])
        .join(side(full, "b"), ["label", "size", "tile_b"])
        .mapInPandas(_compare(threshold), "hi long, lo long, n long, a long, b long")
    )
    counted = found.where("n > 0").groupBy("hi", "lo").agg(F.sum("n").alias("n"))
    return counted, connected(found.where("n = 0 and a <> b").select("a", "b"))
