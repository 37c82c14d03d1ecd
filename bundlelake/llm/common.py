"""Pieces the training-data operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bundlelake.session import scratch

#: A word, for Spark's and for DuckDB's regular expressions.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A plain column used twice is inlined twice when Catalyst merges projections;
    a lambda's argument is not.
    """
    return F.get(F.transform(F.array(value), body), 0)


def words_of(text: Column) -> Column:
    """All words of a text in order; none for null."""
    return F.coalesce(
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.array().cast("array<string>")
    )


def count_words(text: Column) -> Column:
    """Number of words of a text as a long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def stored(frame: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Cuts the lineage: what follows restarts from files every executor can read.
    """
    path = scratch(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def quoted_name(column: str) -> str:
    """A column's name for SQL: a dot in it is no field."""
    return f"`{column.replace('`', '``')}`"


def quoted(column: str) -> Column:
    return F.col(quoted_name(column))


def own_name(frame: DataFrame, name: str) -> str:
    """A column name that clashes with none of the frame's."""
    taken = {c.lower() for c in frame.columns}
    return name if name.lower() not in taken else f"{name}_{uuid.uuid4().hex[:8]}"


def with_arrow(
    frame: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    helpers: list[str], into: str, kind: str,
) -> DataFrame:
    """The frame with what ``run`` makes of it: without the helper columns, with ``into`` at the end.

    Other columns travel under plain names, since Spark finds no column with a dot in its name when
    it sends rows to Python.
    """
    kept = [f for f in frame.schema.fields if f.name not in helpers]
    plain = {f.name: f"_c{k}" for k, f in enumerate(kept)}
    names = [*plain.values(), "_made"]

    def renamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in run(batches):
            yield out.rename_columns(names)

    fields = [T.StructField(plain[f.name], f.dataType) for f in kept]
    made = T.StructType([*fields, T.StructField("_made", T.DataType.fromDDL(kind))])
    sent = frame.select(*[quoted(c).alias(plain.get(c, c)) for c in frame.columns])
    return sent.mapInArrow(renamed, made).toDF(*[f.name for f in kept], into)


def slices(
    batches: Iterator[pa.RecordBatch], text: str, max_bytes: int = 4 << 20
) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into slices of about ``max_bytes`` of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(text)
        ends = pa.compute.fill_null(pa.compute.binary_length(column), 0).to_numpy().cumsum()
        first = 0
        while first < batch.num_rows:
            before = int(ends[first - 1]) if first else 0
            last = max(first + 1, int(ends.searchsorted(before + max_bytes, "right")))
            yield batch.slice(first, last - first)
            first = last
