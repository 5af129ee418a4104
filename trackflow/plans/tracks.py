"""From XML documents to normalised messages and track points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackflow.functions import plain, regular
from trackflow.functions.xml import TRACK_SCHEMA, VIDEO_INFORMATION
from trackflow.operators.assembly import repair_documents
from trackflow.operators.features import PAYLOAD, point_columns, st_index, track_points
from trackflow.operators.hold import hold
from trackflow.operators.normalize import check_messages, normalize, split_valid
from trackflow.operators.parsing import parse_messages


def valid_messages(documents: DataFrame, schema: str = TRACK_SCHEMA) -> DataFrame:
    """Repair, parse, keep the valid messages."""
    return split_valid(parse_messages(repair_documents(documents), schema))[0]


def normalized_messages(
    documents: DataFrame, schema: str = TRACK_SCHEMA, raw: bool = True
) -> DataFrame:
    """Repair, parse, keep the valid messages, normalise."""
    return normalize(valid_messages(documents, schema), raw)


def _validity(xml: Column) -> Column:
    """Whether a message is valid; null for one that needs the parser."""
    return (
        F.when(plain.is_plain(xml), True)
        .when(plain.is_plain(xml, incomplete=True), False)
        .when(regular.is_regular(xml), True)
        .when(regular.is_regular(xml, incomplete=True), False)
    )


def valid_documents(documents: DataFrame) -> DataFrame:
    """Repaired documents that give a valid message, as text; only those neither plain nor regular
    are parsed."""
    xml = F.col("xml")
    known = hold(repair_documents(documents).withColumn("_form", _validity(xml)), "_form", "_valid")
    kept = known.where("_valid IS NULL OR _valid").withColumn("_text", xml)
    checked = check_messages(
        parse_messages(kept.withColumn("xml", F.when(F.col("_valid").isNull(), xml)))
    )
    valid = checked.where("_valid OR reject_reason IS NULL")
    return valid.select(
        *[F.col("_text").alias("xml") if name == "xml" else name for name in documents.columns]
    )


def rejected_messages(documents: DataFrame, schema: str = TRACK_SCHEMA) -> DataFrame:
    """Documents that give no valid message, whole, with the reason."""
    texts = repair_documents(documents)
    if schema == TRACK_SCHEMA:  # these are valid
        texts = texts.where(~plain.is_plain(F.col("xml")))
    _, rejected = split_valid(parse_messages(texts, schema))
    return rejected.drop("msg", "parse_error")


def _cut_or_parsed(texts: DataFrame, cut: Column) -> DataFrame:
    """Valid messages, parsed where ``cut`` is null; no text means a message that is not valid."""
    held = hold(texts.withColumn("_known", cut), "_known", "_cut")
    kept = held.where("_cut IS NULL OR _cut != ''")
    parsed = F.when(F.col("_cut").isNull(), F.col("xml"))
    checked = check_messages(parse_messages(kept.withColumn("xml", parsed)))
    valid = checked.where("_cut IS NOT NULL OR reject_reason IS NULL")
    return valid.drop("reject_reason", "missing_fields")


def _items_of(messages: DataFrame, documents: DataFrame, tracks: Column) -> DataFrame:
    """One row an item of the tracks, with its places and the keys of the documents."""
    keys = [name for name in documents.columns if name not in PAYLOAD]
    by_track = messages.select(*keys, F.posexplode(tracks).alias("track_idx", "_track"))
    return by_track.select(
        *keys,
        "track_idx",
        F.col("_track.track_uuid").alias("track_uuid"),
        F.posexplode("_track.items").alias("item_idx", "item"),
    )


def message_points(documents: DataFrame, schema: str = TRACK_SCHEMA) -> DataFrame:
    """Track points of the valid messages; only messages neither plain nor regular are parsed.

    The items of the others are cut into cells, those of a parsed one put into cells too, so
    that all give their points in one pass and one row an item.
    """
    if schema != TRACK_SCHEMA:
        return track_points(normalized_messages(documents, schema, raw=False))
    xml, cut = F.col("xml"), F.col("_cut")
    cells = repair_documents(documents).withColumn("_built", plain.items_as_cells(xml))
    known = F.coalesce(
        F.when(plain.is_cut(xml, F.col("_cells")), F.col("_cells")),
        F.when(plain.is_plain(xml, incomplete=True), ""),
        regular.items_as_cells(xml),
        F.when(regular.is_regular(xml, incomplete=True), ""),
    )
    normalized = normalize(_cut_or_parsed(hold(cells, "_built", "_cells"), known), raw=False)
    tracks = F.when(cut.isNotNull(), plain.cut_tracks(cut, VIDEO_INFORMATION)).otherwise(
        plain.parsed_tracks(F.col("msg.tracks"))
    )
    items = _items_of(normalized, documents, tracks)
    item = F.col("item")
    return items.where(plain.is_point_cells(item)).select(
        *items.columns[:-1], *point_columns(plain.point_of(item))
    )


def routed_items(documents: DataFrame) -> DataFrame:
    """The items that normalised messages keep: ``item`` has ``_type``, ``raw`` and ``item_no``.

    The same rows as ``message_items`` of ``normalized_messages``, without the fields of track
    points; only messages that are not regular are parsed.
    """
    xml, cut = F.col("xml"), F.col("_cut")
    known = F.coalesce(
        regular.items_as_raw(xml), F.when(regular.is_regular(xml, incomplete=True), "")
    )
    normalized = normalize(_cut_or_parsed(repair_documents(documents), known))

    def routed(track: Column) -> Column:
        items = F.transform(
            track["items"], lambda item: F.struct(item["_type"], item["raw"], item["item_no"])
        )
        return F.struct(track["trackUUID"].alias("track_uuid"), items.alias("items"))

    tracks = F.when(cut.isNotNull(), regular.raw_tracks(cut, VIDEO_INFORMATION)).otherwise(
        F.transform("msg.tracks", routed)
    )
    return _items_of(normalized, documents, tracks)


def indexed_track_points(documents: DataFrame, schema: str = TRACK_SCHEMA) -> DataFrame:
    """Track points of the valid messages with their space-time key."""
    return st_index(message_points(documents, schema))
