"""Explicit schemas; streams never infer one."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


EVENTS = _struct(
    event_id=T.LongType(),
    ts=T.TimestampNTZType(),
    user_id=T.LongType(),
    event_type=T.StringType(),
    value=T.DoubleType(),
    props=T.StringType(),
)

EVENT_STREAM = T.StructType(
    [T.StructField(f.name, T.TimestampType() if f.name == "ts" else f.dataType) for f in EVENTS]
)
"""Watermarks need TIMESTAMP; the stored values are read as instants in UTC."""

CART_EVENT = _struct(
    event_type=T.StringType(),
    user_id=T.StringType(),
    sku=T.StringType(),
    quantity=T.IntegerType(),
    time=T.TimestampType(),
)

CATALOG_EVENT = _struct(
    event_type=T.StringType(),
    user_id=T.StringType(),
    time=T.TimestampType(),
    product_id=T.StringType(),
)

GAME_EVENT = _struct(
    event_type=T.StringType(),
    event_time=T.TimestampType(),
    player_id=T.StringType(),
    nickname=T.StringType(),
    game_id=T.StringType(),
    player_ids=T.ArrayType(T.StringType()),
    map_id=T.StringType(),
    region_id=T.StringType(),
    game_type=T.StringType(),
)

PERSON = _struct(name=T.StringType(), age=T.IntegerType())

# Fixed values.
GAME_TYPES = ("OneVsOne", "TwoVsTwo", "ThreeVsThree", "FourVsFour")
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
