"""Record schemas. Reads are always given one of these; nothing is inferred.

Fixed values: the field names are those the source sends.
"""

from __future__ import annotations

from pyspark.sql import types as T

ALBUM = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("total_tracks", T.LongType()),
        T.StructField("release_date", T.StringType()),
        T.StructField("album_group", T.StringType()),
        T.StructField(
            "images",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("url", T.StringType()),
                        T.StructField("height", T.LongType()),
                        T.StructField("width", T.LongType()),
                    ]
                )
            ),
        ),
        T.StructField(
            "external_urls", T.StructType([T.StructField("spotify", T.StringType())])
        ),
    ]
)

TRACK = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("track_number", T.LongType()),
        T.StructField("is_playable", T.BooleanType()),
        T.StructField("duration_ms", T.LongType()),
        T.StructField("explicit", T.BooleanType()),
        T.StructField(
            "external_urls", T.StructType([T.StructField("spotify", T.StringType())])
        ),
        T.StructField("album_id", T.StringType()),
    ]
)

# Arrival order of a record. ``parent_ord`` is the arrival order of its parent,
# as a path from the outermost source inwards, so one column serves any depth.
ORDINAL = T.StructType(
    [
        T.StructField("parent_ord", T.ArrayType(T.LongType())),
        T.StructField("page_offset", T.LongType()),
        T.StructField("pos", T.LongType()),
    ]
)
ORDINAL_COLUMNS = tuple(ORDINAL.names)


def page(record: T.StructType | None = None) -> T.StructType:
    """One response body: a page of ``record``s of one parent, or of VARIANT values with all their fields."""
    return T.StructType(
        [
            T.StructField("parent_id", T.StringType()),
            T.StructField("parent_ord", T.LongType()),
            T.StructField("offset", T.LongType()),
            T.StructField("limit", T.LongType()),
            T.StructField("total", T.LongType()),
            T.StructField("items", T.ArrayType(record or T.VariantType())),
        ]
    )


def raw(record: T.StructType) -> T.StructType:
    """One raw row as it is cleaned: a record and its arrival order."""
    return T.StructType(ORDINAL.fields + record.fields)


def landed(record: T.StructType | None = None, key: str | None = None) -> T.StructType:
    """One raw (bronze) row as it is stored: arrival order, the parent's key as ``key``, and the whole record."""
    keys = [T.StructField(key, T.StringType())] if key else []
    return T.StructType([*ORDINAL.fields, *keys, T.StructField("record", record or T.VariantType())])
