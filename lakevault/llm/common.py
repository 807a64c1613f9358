"""Small helpers the operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakevault.session import work_folder


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame once to the shared work folder and read it from there.

    This cuts the lineage in a way that survives lost executors, and gives the plans above
    true sizes, so that Spark decides about broadcasts on measured figures.
    """
    spark = df.sparkSession
    path = work_folder(spark, f"llm-{purpose}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def compacted(df: DataFrame, purpose: str, rows_per_file: int = 200_000) -> DataFrame:
    """``stored`` for narrow results of a shuffle: as few files as its rows ask for, not one per partition.

    The rows are cached while they are counted and written; a lost executor's share is computed again.
    """
    kept = df.persist()
    try:
        return stored(kept.coalesce(shards_for(row_count(kept), rows_per_file)), purpose)
    finally:
        kept.unpersist()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def row_count(df: DataFrame) -> int:
    return df.agg(F.count(F.lit(1))).first()[0]


def shards_for(rows: int, per_shard: int) -> int:
    """How many hash shards keep each one near ``per_shard`` distinct keys; grows with the data."""
    return max(1, -(-rows // per_shard))


def arrow_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of Arrow batches as Python values; whole numbers stay whole next to nulls."""
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def arrow_batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 256) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of ``size`` rows."""
    held: list[tuple] = []

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    for row in rows:
        held.append(row)
        if len(held) == size:
            yield made()
            held.clear()
    if held:
        yield made()


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def whole(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """A whole-number column as int64 (0 for null) and where it is not null; nothing passes through floats."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64, copy=False), flat.is_valid().to_numpy(zero_copy_only=False)


def nullable(values: np.ndarray, valid: np.ndarray) -> pa.Array:
    """The reverse of ``whole``."""
    return pa.array(values, pa.int64(), mask=~np.asarray(valid, bool))
