"""The batch loads as streams: each run takes what is new and stops (``availableNow``)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakevault.operators.ordered import first_per_key
from lakevault.operators.staging import StageSpec, stage
from lakevault.operators.vault import HubSpec, LinkSpec, SatSpec, key_rows, sat_rows
from lakevault.sources.tables import Lake


def read_table_stream(spark: SparkSession, path: str, schema) -> DataFrame:
    """New Parquet files under a path (a folder, or a glob for single files)."""
    return spark.readStream.schema(schema).parquet(path)


def _run(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> None:
    query = (
        stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start())
    query.awaitTermination()


def ingest_files(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Append new files' rows to a folder; the sink's own log makes each batch count once."""
    query = (
        stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start())
    query.awaitTermination()


def load_vault_stream(
    stream: DataFrame, lake: Lake, spec: StageSpec, targets: Sequence[HubSpec | LinkSpec | SatSpec], checkpoint: str,
) -> None:
    """Stage each micro-batch and append what the vault does not hold yet. A batch that is repeated
    after a failure finds its rows stored and adds nothing."""

    def load(batch: DataFrame, _: int) -> None:
        staged = stage(batch, spec)
        for target in targets:
            stored = lake.holding("raw_vault", target.name, target.pk, staged) if lake.exists("raw_vault", target.name) else None
            if isinstance(target, SatSpec):
                lake.append("raw_vault", target.name, sat_rows(staged, stored, target))
            else:
                lake.append("raw_vault", target.name, key_rows(staged, stored, target), bucket_by=target.pk)

    _run(stream, checkpoint, load)


def merge_stream(
    stream: DataFrame, lake: Lake, layer: str, table: str, keys: Sequence[str], event_time: str,
    checkpoint: str, late_by: str | None = None,
) -> None:
    """Merge by key; of repeated keys in one micro-batch the newest row counts.

    With ``late_by`` repeats that arrive within that time of each other are dropped before the
    merge, against a state the watermark keeps small. Spark then also drops rows that are later
    than ``late_by``, so set it only where the source promises that limit; without it every row is
    merged, however late.
    """
    if late_by is not None:
        zoned = stream.withColumn("_event_time", F.col(event_time).cast("timestamp"))
        stream = zoned.withWatermark("_event_time", late_by).dropDuplicatesWithinWatermark(
            list(keys)).drop("_event_time")

    def merge(batch: DataFrame, _: int) -> None:
        whole_row = F.xxhash64(*batch.columns)
        newest = first_per_key(batch, list(keys), [F.col(event_time).desc(), whole_row])
        lake.merge(layer, table, newest, keys, check=False)

    _run(stream, checkpoint, merge)
