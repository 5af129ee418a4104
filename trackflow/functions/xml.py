"""Schemas and column expressions for track messages in XML."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Element names of a track message.
HEADER_FIELDS = ["messageSecurity", "msgCreatedTime", "stanagVersion", "senderId"]
POINT_FIELDS = [
    "trackItemUUID",
    "trackItemSecurity",
    "trackItemTime",
    "trackItemSource",
    "trackItemComment",
    "trackPointPosition",
    "trackPointSpeed",
    "trackPointCourse",
    "trackPointType",
    "trackPointSource",
    "trackPointObjectMask",
]
DETAIL_FIELDS = ["pointDetailVelocity", "pointDetailCovarianceMatrix", "pointDetailPosition"]
POSITION_FIELDS = ["latitude", "longitude", "elevation"]
TRACK_POINT = "TrackPoint"
VIDEO_INFORMATION = "VideoInformation"
LOCAL_POSITION = "LocalCartesianPosition"
GEODETIC_POSITION = "GeodeticPosition"
TOKEN_REPAIRS = {"AUTOMATIC ESTIMATED": "AUTOMATIC_ESTIMATED"}

CORRUPT = "_corrupt_record"

_POSITION = "struct<latitude:string,longitude:string,elevation:string>"
_DETAIL_POSITION = (
    "struct<_type:string,latitude:string,longitude:string,elevation:string,"
    f"x:string,y:string,z:string,localSystem:struct<origin:{_POSITION}>>"
)
_POINT = ",".join(
    f"{name}:{_POSITION if name == 'trackPointPosition' else 'string'}" for name in POINT_FIELDS
)
_ITEM = (
    f"struct<_type:string,{_POINT},TrackPointDetail:struct<pointDetailVelocity:string,"
    f"pointDetailCovarianceMatrix:string,pointDetailPosition:{_DETAIL_POSITION}>>"
)

# Every leaf is text: NULL then means "element missing" and '' means "element empty".
TRACK_SCHEMA = (
    ",".join(f"{name} array<string>" for name in HEADER_FIELDS)
    + f",tracks array<struct<trackUUID:string,items:array<{_ITEM}>>>,{CORRUPT} string"
)

# The header, and of the tracks their ids, for those who need no items.
HEADER_SCHEMA = (
    ",".join(f"{name} array<string>" for name in HEADER_FIELDS)
    + f",tracks array<struct<trackUUID:string>>,{CORRUPT} string"
)

XML_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def repair_tokens(xml: Column, repairs: dict[str, str] | None = None) -> Column:
    """Replace each broken token by its valid spelling."""
    for broken, valid in (TOKEN_REPAIRS if repairs is None else repairs).items():
        xml = F.replace(xml, F.lit(broken), F.lit(valid))
    return xml
