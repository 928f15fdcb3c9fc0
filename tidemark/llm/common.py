"""What the operators share: words, Arrow maps over slices, staged tables, held-out rows."""

from __future__ import annotations

import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.staging import new_folder

#: Rows that one call of a mapping function sees, whatever the Arrow batch holds.
SLICE_ROWS = 256

#: ASCII white space, as bytes.split() and the contracts have it.
SPACE = r"\x20\x09-\x0D"


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*columns)


def lower_words(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text with A-Z in lower case; none for None."""
    return text.lower().split() if text else []


def utf8(column: pa.Array) -> list[bytes | None]:
    """The values of a string column as UTF-8, not decoded."""
    return column.cast(pa.binary()).to_pylist()


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application, as its functions run there."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(context._temp_dir) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def arrow_map(
    df: DataFrame, each: Callable[[pa.RecordBatch], dict | None], schema: T.StructType, rows: int = SLICE_ROWS
) -> DataFrame:
    """``each`` on slices of a few rows; it returns the output columns by name, as lists or arrays.

    Memory per task is one Arrow batch (64 MB at most, or one row) and the slice's results.
    """
    ship(df.sparkSession)
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                out = each(batch.slice(start, rows))
                if out is not None:
                    arrays = [
                        v.cast(f.type) if isinstance(v, pa.Array) else pa.array(v, f.type)
                        for v, f in ((out[n], arrow.field(n)) for n in names)
                    ]
                    yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.mapInArrow(run, schema)


def with_column(df: DataFrame, name: str, kind: T.DataType, keep: list[str] | None = None) -> tuple[list[str], T.StructType]:
    """The columns of ``df`` to keep (all, but one called ``name``), and the schema with ``name`` added."""
    kept = [c for c in (df.columns if keep is None else keep) if c != name]
    return kept, T.StructType([*(df.schema[c] for c in kept), T.StructField(name, kind)])


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a table in the shared folder, read back: lineage ends here, and rows are fixed."""
    path = new_folder(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remainder(modulus: int, key: str = "doc_id") -> Column:
    """crc32 of the key as text, modulo; NULL for a NULL key."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % modulus


def is_remainder(modulus: int, wanted: int, key: str = "doc_id") -> Column:
    """True where the remainder is ``wanted``; a NULL key has no remainder."""
    return F.coalesce(remainder(modulus, key) == wanted, F.lit(False))
