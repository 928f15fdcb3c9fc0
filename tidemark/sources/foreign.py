"""Parquet that others wrote, with the physical types of its footer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import files

#: How a nanosecond leaf is meant: an instant, or a time without zone.
INSTANT, LOCAL = "instant", "local"

Kinds = dict | list | str | None


def _footer(spark: SparkSession, path: str) -> object:
    """The message type of a file, or of the first file of a folder."""
    jvm = spark.sparkContext._jvm
    first = next((name for name, _, length in files.walk(spark, path) if length), path)
    source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(
        jvm.org.apache.hadoop.fs.Path(first), spark.sparkContext._jsc.hadoopConfiguration()
    )
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
    try:
        return reader.getFooter().getFileMetaData().getSchema()
    finally:
        reader.close()


def _kinds(field: object, kind: T.DataType) -> Kinds:
    """Where nanoseconds are below a field: by name in a struct, the element's in an array; None if nowhere."""
    if isinstance(kind, T.StructType):
        group = field.asGroupType() if hasattr(field, "asGroupType") else field
        inner = {f.name: _kinds(group.getType(f.name), f.dataType) for f in kind.fields}
        return {name: k for name, k in inner.items() if k is not None} or None
    if isinstance(kind, T.ArrayType):
        if field.isPrimitive():
            element = field
        else:
            repeated = field.asGroupType().getType(0)
            # a list of three levels; in one of two the repeated field is the element itself
            single = not repeated.isPrimitive() and repeated.asGroupType().getFieldCount() == 1
            element = repeated.asGroupType().getType(0) if single else repeated
        found = _kinds(element, kind.elementType)
        return None if found is None else [found]
    if isinstance(kind, T.LongType) and field.isPrimitive():
        meant = str(field.getLogicalTypeAnnotation())
        if meant.startswith("TIMESTAMP(NANOS"):
            return INSTANT if meant.endswith("true)") else LOCAL
    return None


def _restored(value: Column, kind: T.DataType, nanos: Kinds) -> Column:
    if isinstance(nanos, dict):
        fields = [_restored(value.getField(f.name), f.dataType, nanos.get(f.name)).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(nanos, list):
        return F.transform(value, lambda x: _restored(x, kind.elementType, nanos[0]))
    if nanos is None:
        return value
    floored = F.call_function("div", value, F.lit(1000)) - F.when(value % 1000 < 0, 1).otherwise(0)
    if nanos == INSTANT:
        return F.timestamp_micros(floored)
    # days and the rest of a day, so that no time zone takes part
    day = F.lit(86_400_000_000)
    rest = F.pmod(floored, day)
    days = F.call_function("div", floored - rest, day).cast("int")
    seconds = (rest.cast("decimal(18,0)") / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)")
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return start + F.make_dt_interval(days, F.lit(0), F.lit(0), seconds)


def read(spark: SparkSession, path: str) -> DataFrame:
    """A file or folder of files with one schema, nanoseconds floored to microseconds."""
    # the setting is for inference alone, in a session of its own
    inference = spark.newSession()
    inference.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    schema = inference.read.parquet(files.literal(path)).schema
    rows = spark.read.schema(schema).parquet(files.literal(path))
    nanos = _kinds(_footer(spark, path), schema)
    if not nanos:
        return rows
    return rows.select(*[_restored(rows[f"`{f.name.replace('`', '``')}`"], f.dataType, nanos.get(f.name)).alias(f.name) for f in schema.fields])
