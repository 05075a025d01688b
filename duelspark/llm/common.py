"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duelspark.session import materialize, table_path

__all__ = ["read", "materialize", "parts", "spread", "raw_bytes", "pieces", "chunked_by_rows", "schema_with", "unused", "numbered"]

WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def numbered(df: DataFrame, *wanted: str) -> tuple[DataFrame, list[str]]:
    """``df`` with its columns called c0, c1, ..., so that columns an operator adds under other names
    clash with none, and the new names of the ``wanted`` columns."""
    places = {c.lower(): f"c{i}" for i, c in enumerate(df.columns)}
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]), [places[c.lower()] for c in wanted]


def parts(rows: int, per_part: int) -> int:
    """Number of parts of about ``per_part`` rows: grows with the input, never below one."""
    return max(1, math.ceil(rows / per_part))


def spread(n: int | Column, *cols: str | Column) -> Column:
    """A part number from 0 to ``n`` - 1 that depends only on the row's values."""
    return F.pmod(F.xxhash64(*cols), n if isinstance(n, Column) else F.lit(n)).cast("int")


def raw_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; a null is an empty text."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def pieces(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that Python objects of one batch stay few."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def chunked_by_rows(docs: DataFrame, per_chunk: int, *key: str) -> tuple[DataFrame, int]:
    """``docs`` with a column ``_chunk``: groups of about ``per_chunk`` rows by a hash of ``key``."""
    n = parts(docs.count(), per_chunk)
    return docs.withColumn("_chunk", spread(n, *key)), n


def schema_with(df: DataFrame, **columns: str) -> T.StructType:
    """The schema of ``df`` plus columns of the given types (a new object)."""
    more = df.sparkSession.range(0).selectExpr(*[f"CAST(NULL AS {t}) AS {c}" for c, t in columns.items()]).schema
    return T.StructType([*df.schema.fields, *more.fields])
