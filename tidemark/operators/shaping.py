"""Unwrap, flatten, rename and select."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FAILFAST = {"mode": "FAILFAST"}

# Fixed value: the white space JSON allows before a document.
JSON_SPACE = " \t\r\n"


def quoted(name: str) -> str:
    """``name`` as one column reference, even if it holds dots."""
    return "`" + name.replace("`", "``") + "`"


def record_field(df: DataFrame, name: str, record: str = "record", kind: str = "string") -> Column:
    """A field of the column ``record``, a struct or a VARIANT; NULL where a VARIANT lacks it."""
    return _field(F.col(quoted(record)), df.schema[record].dataType, name, kind)


def _field(record: Column, of: T.DataType, name: str, kind: str = "string") -> Column:
    if isinstance(of, T.VariantType):
        escaped = name.replace("\\", "\\\\").replace('"', '\\"')
        return F.variant_get(record, f'$["{escaped}"]', kind)
    return record.getField(name).cast(kind)


def item_fields(pages: DataFrame, names: Sequence[str]) -> DataFrame:
    """``pages`` whose items are structs of these fields only, as strings; as many items as before."""
    of = pages.schema["items"].dataType.elementType
    narrow = F.transform("items", lambda item: F.struct(*[_field(item, of, n).alias(n) for n in names]))
    return pages.withColumn("items", narrow)


def _marked(text: Column) -> Column:
    """An array of a JSON document and an end mark.

    The parser stops after one value and would pass over text that follows. In
    this array that text makes the document corrupt or the length other than two.
    """
    return F.concat(F.lit("["), text, F.lit(",null]"))


def _sole(parsed: Column) -> Column:
    """The document of a parsed ``_marked`` array; anything but one document raises."""
    refused = F.raise_error(F.lit("JSON document without items, or with text after it"))
    # A lambda, so that the parse is evaluated once.
    checked = F.transform(
        F.array(parsed),
        lambda p: F.coalesce(F.when(F.size(p) == 2, F.get(p, F.lit(0))), refused),
    )
    return F.get(checked, F.lit(0))


def json_record(text: Column, record: T.StructType) -> Column:
    """The one record that ``text`` is; anything else raises."""
    return _sole(F.from_json(_marked(text), T.ArrayType(record), FAILFAST))


def json_items(text: Column, record: T.StructType) -> Column:
    """The records of one whole JSON document, as an array.

    A document is an array of records, an object wrapping them under
    ``items``, or one record. Anything else raises: corrupt or empty text, null
    ``items``, and text after the document.
    """

    def parsed(shape: T.DataType) -> Column:
        return F.from_json(_marked(text), T.ArrayType(shape), FAILFAST)

    records = T.ArrayType(record)
    wrapper = T.StructType([T.StructField("items", records)])
    # Test the shape first: under FAILFAST, parsing an array as an object raises.
    # The keys of a corrupt object are NULL, which leaves it to the last parse.
    return _sole(
        F.when(F.ltrim(text, F.lit(JSON_SPACE)).startswith("["), parsed(records))
        .when(F.array_contains(F.json_object_keys(text), "items"), parsed(wrapper)["items"])
        .otherwise(F.transform(parsed(record), lambda r: F.when(r.isNotNull(), F.array(r))))
    )


def unwrap_json(
    df: DataFrame, text: str, record: T.StructType, keep: Sequence[str] = ()
) -> DataFrame:
    """One row per record of the JSON documents in ``text``, with its ``pos`` in the document."""
    items = json_items(F.col(quoted(text)), record)
    exploded = df.select(
        *[F.col(quoted(c)) for c in keep], F.posexplode(items).alias("pos", "item")
    )
    return exploded.select(*keep, F.col("pos").cast("bigint").alias("pos"), "item.*")


def explode_items(pages: DataFrame, *keys: Column) -> DataFrame:
    """``item`` per item of ``pages``, with its arrival order and the page's ``keys``.

    ``pages`` has ``parent_ord`` (a path), ``offset`` and ``items``. A page
    without items gives no rows.
    """
    exploded = pages.select(
        "parent_ord",
        F.col("offset").cast("bigint").alias("page_offset"),
        F.posexplode("items").alias("pos", "item"),
        *keys,
    )
    return exploded.withColumn("pos", F.col("pos").cast("bigint"))


def unwrap_items(df: DataFrame) -> DataFrame:
    """Records of a frame that wraps them under ``items``; any other frame as it is.

    A wrapped frame is one of pages: ``pos`` is the place in ``items``, and
    ``parent_ord`` and ``offset`` are taken from the page where it has them.
    """
    if "items" not in df.columns:
        return df
    if "offset" not in df.columns:
        df = df.withColumn("offset", F.lit(0))
    if "parent_ord" not in df.columns:
        df = df.withColumn("parent_ord", F.array().cast("array<bigint>"))
    elif not isinstance(df.schema["parent_ord"].dataType, T.ArrayType):
        df = df.withColumn("parent_ord", F.array(F.col("parent_ord").cast("bigint")))
    return explode_items(df).select("parent_ord", "page_offset", "pos", "item.*")


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Every leaf of nested structs as a column named by its path; arrays stay whole."""

    def leaves(schema: T.StructType, path: tuple[str, ...]):
        for field in schema.fields:
            here = (*path, field.name)
            if isinstance(field.dataType, T.StructType):
                yield from leaves(field.dataType, here)
            else:
                yield F.col(".".join(map(quoted, here))).alias(sep.join(here))

    return df.select(*leaves(df.schema, ()))


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename columns; names the frame does not have are ignored."""
    return df.withColumnsRenamed(dict(names))


def select_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep ``columns`` in this order; a missing one is an analysis error."""
    return df.select(*[F.col(quoted(c)) for c in columns])


def require_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Raise if one of ``columns`` is NULL in every row (one aggregate pass)."""
    seen = df.agg(
        *[F.bool_or(F.col(quoted(c)).isNotNull()).alias(f"c{i}") for i, c in enumerate(columns)]
    ).first()
    missing = [c for c, ok in zip(columns, seen) if not ok]
    if missing:
        raise ValueError(f"no record has a value for: {', '.join(missing)}")
    return df
