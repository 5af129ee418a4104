"""The normalised message as XML: elements are picked and put together, their text stays.

Whatever the message holds beyond the named fields survives where the rules keep its parent:
children of tracks, positions and origins that no schema names, attributes, entities, CDATA.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackflow.functions import regular
from trackflow.functions.nodes import children, first_named, named
from trackflow.functions.xml import (
    DETAIL_FIELDS,
    GEODETIC_POSITION,
    HEADER_FIELDS,
    LOCAL_POSITION,
    POINT_FIELDS,
    TRACK_POINT,
    VIDEO_INFORMATION,
)
from trackflow.operators.hold import hold


def _outer(nodes: Column) -> Column:
    return F.array_join(F.transform(nodes, lambda node: node["outer"]), "")


def _element(name: str, content: Column, attributes: str = "") -> Column:
    return F.concat(F.lit(f"<{name}{attributes}>"), content, F.lit(f"</{name}>"))


def _kept(node: Column) -> Column:
    """Video information is dropped; everything else in a track stays."""
    return ~((node["name"] == "items") & node["type"].eqNullSafe(VIDEO_INFORMATION))


def _inner_of(nodes: Column, name: str) -> Column:
    return children(first_named(nodes, name)["inner"])


def _position(node: Column) -> Column:
    return first_named(node["detail"], "pointDetailPosition")


def _is_local(node: Column) -> Column:
    return _position(node)["type"].eqNullSafe(LOCAL_POSITION)


# What a node of a track gets, one level of the message after the other.  Each is a step of its
# own: nested in one expression they would be too deep for the analyzer.
_LEVELS: list[tuple[str, Callable[[Column], Column]]] = [
    (
        "fields",
        lambda node: F.when(
            (node["name"] == "items") & node["type"].eqNullSafe(TRACK_POINT),
            children(node["inner"]),
        ),
    ),
    (
        "detail",
        lambda node: F.when(
            node["fields"].isNotNull(), _inner_of(node["fields"], "TrackPointDetail")
        ),
    ),
    ("local", lambda node: F.when(_is_local(node), children(_position(node)["inner"]))),
    (
        "system",
        lambda node: F.when(node["local"].isNotNull(), _inner_of(node["local"], "localSystem")),
    ),
    (
        "origin",
        lambda node: F.when(node["system"].isNotNull(), _inner_of(node["system"], "origin")),
    ),
]


def _point_xml(node: Column) -> Column:
    """A track point with exactly the named fields; a local position gives way to its origin."""
    leaves = [first_named(node["fields"], name)["outer"] for name in POINT_FIELDS]
    inner = [first_named(node["detail"], name)["outer"] for name in DETAIL_FIELDS[:2]]
    geodetic = _element(
        "pointDetailPosition", _outer(node["origin"]), f' type="{GEODETIC_POSITION}"'
    )
    position = F.when(node["origin"].isNotNull(), geodetic).otherwise(_position(node)["outer"])
    detail = _element("TrackPointDetail", F.concat(*inner, position))
    return _element("items", F.concat(*leaves, detail), f' type="{TRACK_POINT}"')


def _each_node(tracks: Column, use: Callable[[Column], Column]) -> Column:
    return F.transform(tracks, lambda nodes: F.transform(nodes, use))


def _with(name: str, value: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda node: node.withField(name, value(node))


def _step(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Replace or add a column, computed once."""
    return hold(df.withColumn("made", value).drop(name), "made", name)


def message_nodes(df: DataFrame, xml: str = "xml") -> DataFrame:
    """Add ``nodes``: the child elements of each message."""
    rooted = df.withColumn("made", F.get(children(F.col(xml)), 0)["inner"])
    return _step(hold(rooted, "made", "nodes"), "nodes", children(F.col("nodes")))


def track_nodes(df: DataFrame) -> DataFrame:
    """Replace ``nodes`` by ``tracks``: the child elements of each track."""
    tracks = F.transform(
        named(F.col("nodes"), "tracks"), lambda track: children(track["inner"])
    )
    return hold(df.withColumn("made", tracks), "made", "tracks")


def raw_items(df: DataFrame) -> DataFrame:
    """Replace ``wanted``, the text of a message or null, by ``raw_items``: per track the inner
    text of every item, as it stands in the message."""
    found = track_nodes(message_nodes(df, "wanted").drop("wanted")).drop("nodes")
    items = F.transform(
        "tracks",
        lambda nodes: F.struct(
            F.transform(named(nodes, "items"), lambda item: item["inner"]).alias("items")
        ),
    )
    return found.withColumn("raw_items", items).drop("tracks")


def rewrite(valid: DataFrame) -> DataFrame:
    """Add ``headers`` and ``tracks`` to valid messages, the text of all that normal form keeps.

    ``headers`` has the header elements, ordered by name as the fields are.  ``tracks`` has an
    array per track with ``name``, ``type`` and ``xml`` of each child that stays.  Regular messages
    are cut into tiles, all others into their nodes.
    """
    xml, tiles = F.col("xml"), F.col("_tiles")
    tiled = hold(valid.withColumn("made", regular.normal_form(xml)), "made", "_tiles")
    found = message_nodes(tiled.withColumn("_odd", F.when(tiles.isNull(), xml)), "_odd")
    found = track_nodes(found.drop("_odd"))
    headers = F.flatten(F.array(*(named(F.col("nodes"), name) for name in HEADER_FIELDS)))
    outer = F.transform(headers, lambda node: node["outer"])
    outer = F.when(tiles.isNotNull(), regular.headers_of(tiles)).otherwise(outer)
    found = found.withColumn("headers", outer)
    kept = F.transform("tracks", lambda nodes: F.filter(nodes, _kept))
    found = found.drop("nodes").withColumn("tracks", kept)
    for name, value in _LEVELS:
        found = _step(found, "tracks", _each_node(F.col("tracks"), _with(name, value)))
    written = _each_node(
        F.col("tracks"),
        lambda node: F.struct(
            node["name"].alias("name"),
            node["type"].alias("type"),
            F.when(node["fields"].isNotNull(), _point_xml(node))
            .otherwise(node["outer"])
            .alias("xml"),
        ),
    )
    cut = F.array(regular.children_of(tiles))
    written = F.when(tiles.isNotNull(), cut).otherwise(written)
    return _step(found, "tracks", written).drop("_tiles")


def track_children(rewritten: DataFrame, keys: list[str]) -> DataFrame:
    """One row per child of a normalised track: ``track_idx, child_idx, name, type, xml``."""
    tracks = rewritten.select(*keys, F.posexplode("tracks").alias("track_idx", "nodes"))
    nodes = tracks.select(*keys, "track_idx", F.posexplode("nodes").alias("child_idx", "node"))
    return nodes.select(*keys, "track_idx", "child_idx", "node.*")


def to_track_xml(valid: DataFrame) -> DataFrame:
    """Write each valid message in normal form as one XML text, ``track_xml``."""
    rewritten = rewrite(valid)
    tracks = F.transform(
        "tracks",
        lambda nodes: _element(
            "tracks", F.array_join(F.transform(nodes, lambda node: node["xml"]), "")
        ),
    )
    content = F.array_join(F.concat("headers", tracks), "")
    return rewritten.withColumn("track_xml", _element("TrackMessage", content)).drop("headers", "tracks")
