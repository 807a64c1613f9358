"""Bloom filters over the keys of a table's files, so that a small delta reads only files that may hold its keys.

An insert-only table gains files with every load and never changes one. For each file (or part of one
that a task has read) a filter over the hashes of its key column is kept beside the table, twenty bits a
key. Filters of new files are made when keys are first looked up; the key column of a file is read once
for it. A filter that says no is right, one that says yes is wrong for about one key in ten thousand: every
key of a delta is asked of every file, so errors have to be rarer than files are many.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: keys of a delta up to which files are chosen; they are sent to the tasks that hold the filters
MOST_KEYS = 10_000
#: files from which choosing pays
LEAST_FILES = 64
BITS, HASHES = 20, 14

_FILTER = "file string, n_keys long, bits binary"
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _slots(hashes: np.ndarray, size: int) -> np.ndarray:
    """The bits of each hash in a filter of ``size`` bits, one row per hash function."""
    with np.errstate(over="ignore"):
        second = (hashes ^ (hashes >> np.uint64(33))) * _STEP | np.uint64(1)
        return np.stack([((hashes + np.uint64(i) * second) >> np.uint64(3)) % np.uint64(size) for i in range(HASHES)])


def made(hashes: np.ndarray) -> bytes:
    """A filter over hashes."""
    size = -(-max(64, BITS * len(hashes)) // 8) * 8
    bits = np.zeros(size, bool)
    bits[_slots(hashes, size)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def may_hold(bits: bytes, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes a filter does not rule out."""
    raw = np.frombuffer(bits, np.uint8)
    slots = _slots(hashes, len(raw) * 8)
    return ((raw[slots >> np.uint64(3)] >> (slots & np.uint64(7)).astype(np.uint8)) & 1).all(axis=0)


def filters_of(rows: DataFrame, key: str) -> DataFrame:
    """One filter per file and task of ``rows``, which are read from files."""
    schema = pa.schema([("file", pa.string()), ("n_keys", pa.int64()), ("bits", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        for batch in batches:
            files = batch.column(0).dictionary_encode()
            hashes = batch.column(1).to_numpy().view(np.uint64)
            number = files.indices.to_numpy()
            for i, name in enumerate(files.dictionary.to_pylist()):
                held.setdefault(name, []).append(hashes[number == i])
        found = [(name, np.concatenate(parts)) for name, parts in held.items()]
        columns = [[n for n, _ in found], [len(h) for _, h in found], [made(h) for _, h in found]]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return rows.select(F.col("_metadata.file_path").alias("file"), F.xxhash64(key).alias("hash")).mapInArrow(work, _FILTER)


def files_holding(filters: DataFrame, hashes: list[int]) -> list[str]:
    """The files that may hold some of the hashes."""
    wanted = np.array(hashes, np.int64).view(np.uint64)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [n for n, bits in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if may_hold(bits, wanted).any()]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], names=["file"])

    return [r[0] for r in filters.select("file", "bits").mapInArrow(work, "file string").distinct().collect()]
