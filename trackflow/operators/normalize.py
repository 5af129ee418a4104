"""Normalisation of track messages: nested projections inside each message row, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackflow.functions.xml import (
    DETAIL_FIELDS,
    GEODETIC_POSITION,
    HEADER_FIELDS,
    LOCAL_POSITION,
    POINT_FIELDS,
    POSITION_FIELDS,
    TRACK_POINT,
    VIDEO_INFORMATION,
)
from trackflow.operators.rewrite import raw_items


def project_header(messages: DataFrame) -> DataFrame:
    """Keep the four header fields and the tracks, in this order."""
    kept = [F.col("msg")[name].alias(name) for name in [*HEADER_FIELDS, "tracks"]]
    return messages.withColumn("msg", F.struct(*kept))


def is_kept(item: Column) -> Column:
    """Video information is dropped; an item without a type is kept."""
    return ~item["_type"].eqNullSafe(VIDEO_INFORMATION)


def is_point(item: Column) -> Column:
    return item["_type"].eqNullSafe(TRACK_POINT)


def _is_local(position: Column) -> Column:
    return position["_type"].eqNullSafe(LOCAL_POSITION)


def geodetic_position(position: Column) -> Column:
    """Put the origin of its local system in the place of a local Cartesian position."""
    origin = position["localSystem"]["origin"]
    nothing = F.lit(None).cast("string")
    no_system = F.lit(None).cast(
        "struct<origin:struct<latitude:string,longitude:string,elevation:string>>"
    )
    replaced = F.struct(
        F.lit(GEODETIC_POSITION).alias("_type"),
        *[origin[name].alias(name) for name in POSITION_FIELDS],
        *[nothing.alias(name) for name in ("x", "y", "z")],
        no_system.alias("localSystem"),
    )
    return F.when(_is_local(position), replaced).otherwise(position)


def project_detail(detail: Column) -> Column:
    """Keep the three detail fields, the position in geodetic form."""
    fields = [detail[name].alias(name) for name in DETAIL_FIELDS[:2]]
    position = geodetic_position(detail["pointDetailPosition"]).alias("pointDetailPosition")
    return F.when(detail.isNotNull(), F.struct(*fields, position))


def project_item(item: Column, raw: Column, item_no: Column) -> Column:
    """A track point keeps exactly its named fields; any other item keeps its raw content.

    ``item_no`` is the position among all items of the track, dropped ones included.
    """
    point = is_point(item)
    fields = [F.when(point, item[name]).alias(name) for name in POINT_FIELDS]
    detail = F.when(point, project_detail(item["TrackPointDetail"])).alias("TrackPointDetail")
    from_origin = F.when(point, _is_local(item["TrackPointDetail"]["pointDetailPosition"]))
    return F.struct(
        item["_type"].alias("_type"),
        *fields,
        detail,
        from_origin.alias("position_is_origin"),
        F.when(~point, raw).alias("raw"),
        item_no.alias("item_no"),
    )


def missing_children(item: Column) -> Column:
    """Names of the required children a track point lacks; empty for other items."""
    detail = item["TrackPointDetail"]
    position = detail["pointDetailPosition"]
    required = [(name, item[name].isNull()) for name in POINT_FIELDS]
    required.append(("TrackPointDetail", detail.isNull()))
    required += [(name, detail.isNotNull() & detail[name].isNull()) for name in DETAIL_FIELDS]
    local = _is_local(position)
    system = position["localSystem"]
    required.append(("localSystem", local & system.isNull()))
    required.append(("origin", local & system.isNotNull() & system["origin"].isNull()))
    names = F.array_compact(
        F.array(*[F.when(absent, F.lit(name)) for name, absent in required])
    )
    return F.when(is_point(item), names).otherwise(F.array().cast("array<string>"))


def with_missing_fields(messages: DataFrame) -> DataFrame:
    """Add the sorted names of required children that any track point of the message lacks."""
    tracks = F.coalesce(F.col("msg.tracks"), F.array())
    per_item = F.flatten(
        F.transform(
            tracks,
            lambda track: F.flatten(
                F.transform(F.coalesce(track["items"], F.array()), missing_children)
            ),
        )
    )
    return messages.withColumn("missing_fields", F.array_sort(F.array_distinct(per_item)))


def reject_reason() -> Column:
    missing = F.concat(F.lit("missing_child:"), F.array_join("missing_fields", ","))
    return F.coalesce("parse_error", F.when(F.size("missing_fields") > 0, missing))


def check_messages(messages: DataFrame) -> DataFrame:
    """Add ``reject_reason``: NULL for a message that parsed and has every required child."""
    return with_missing_fields(messages).withColumn("reject_reason", reject_reason())


def split_valid(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Whole messages that are valid, and those that are not, with their reason."""
    checked = check_messages(messages)
    valid = checked.where("reject_reason IS NULL").drop("reject_reason", "missing_fields")
    return valid, checked.where("reject_reason IS NOT NULL")


def route_items(messages: DataFrame, raw: bool = True) -> DataFrame:
    """Drop video information; project track points; keep any other item unchanged.

    The raw text of an item that is no track point comes from the text of its message, cut into
    elements, and pairs up with the parsed item by position.  Only messages that have such items
    are cut; ``raw=False``, for those who need track points only, cuts none.
    """
    other_items = F.exists(
        "msg.tracks",
        lambda track: F.exists(track["items"], lambda item: is_kept(item) & ~is_point(item)),
    )
    if raw:
        held = raw_items(messages.withColumn("wanted", F.when(other_items, F.col("xml"))))
    else:
        none = F.lit(None).cast("array<struct<items: array<string>>>")
        held = messages.withColumn("raw_items", none)

    def route(track: Column, index: Column) -> Column:
        raw = F.get("raw_items", index)["items"]
        paired = F.transform(
            track["items"],
            lambda item, i: F.struct(
                item.alias("item"), F.get(raw, i).alias("raw"), i.alias("item_no")
            ),
        )
        kept = F.filter(paired, lambda pair: is_kept(pair["item"]))
        items = F.transform(
            kept, lambda pair: project_item(pair["item"], pair["raw"], pair["item_no"])
        )
        return F.struct(
            track["trackUUID"].alias("trackUUID"),
            F.size(track["items"]).alias("n_items"),
            items.alias("items"),
        )

    tracks = F.transform(F.col("msg.tracks"), route)
    return held.withColumn("msg", F.col("msg").withField("tracks", tracks)).drop("raw_items")


def normalize(valid_messages: DataFrame, raw: bool = True) -> DataFrame:
    """Header whitelist and item routing on valid messages."""
    return route_items(project_header(valid_messages), raw)
