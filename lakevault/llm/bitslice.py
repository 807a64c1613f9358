"""Exact top-k inner products over a bit-sliced index of quantised vectors.

Components become the integers ``floor(scale * x)``. The index holds, per block of rows and per
component, the component's offset from the block's minimum as bit slices: bit map ``b`` has a bit
for every row whose offset has bit ``b``. A query adds slices: every set bit of a query component
adds that component's slices at its weight, complemented where the component is negative. Maps of
equal weight are added three at a time with bit arithmetic (a sum map and a carry map), until one
map per weight is left: the score's own slices. The best rows are then selected from the most
significant slice downward, and where the last places are tied the boundary rows are resolved by
their exact score and id. Sums are exact integers, so the whole result is exact.

A stated set of queries meets all rows in blocks: both are dealt into blocks by hash, the index
blocks are copied once per block of queries, and a task holds one block of each. Only the best rows
of each pair of blocks leave a task.

Defined results
---------------
* a vector that is null or holds a null, NaN or infinite component takes no part, as row or query
* an id with several valid vectors stands for the smallest of them; a null id takes no part
* vectors of different length: a missing component counts as 0
* fewer rows than k: all; ties go to the smaller id; no rows or no queries: an empty result
* a component must fit into 40 bits after scaling, and a score into 62; anything larger raises
* other columns are not read
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakevault.llm.common import compacted, row_count, shards_for, stored

#: rows in one index block, queries in one query block
ROWS_PER_BLOCK = 65_536
QUERIES_PER_BLOCK = 512
LARGEST = 2**40

INDEX = "block int, n_rows long, ids binary, base array<long>, depth array<int>, slices binary"


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 256.0) -> DataFrame:
    """``(vec_id, q)``: integer components of the vectors that take part, one row per id."""
    v = F.col("v")
    finite = F.forall(v, lambda x: F.coalesce((F.abs(x) < F.lit(float("inf"))) & ~F.isnan(x), F.lit(False)))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.filter(F.col("vec_id").isNotNull() & v.isNotNull()).filter(finite)
    one = rows.groupBy("vec_id").agg(F.min("v").alias("v"))
    return one.select("vec_id", F.transform("v", lambda x: F.floor(x * F.lit(scale))).alias("q"))


def _matrix(column: pd.Series, width: int | None = None) -> np.ndarray:
    width = max([len(x) for x in column], default=0) if width is None else width
    out = np.zeros((len(column), width), np.int64)
    for row, x in zip(out, column):
        row[: len(x)] = x
    if out.size and np.abs(out).max() > LARGEST:
        raise ValueError("a component is too large for the index")
    return out


def build_block(ids: np.ndarray, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimum and number of slices per component, and all slices (64 rows in a word)."""
    base = matrix.min(axis=0) if matrix.size else np.zeros(matrix.shape[1], np.int64)
    offset = matrix - base
    depth = np.array([int(x).bit_length() for x in offset.max(axis=0)], np.int32) if matrix.size else np.zeros(matrix.shape[1], np.int32)
    words = -(-len(ids) // 64)
    slices = np.zeros((int(depth.sum()), words * 8), np.uint8)
    at = 0
    for j, d in enumerate(depth):
        for b in range(d):
            packed = np.packbits(((offset[:, j] >> b) & 1).astype(np.uint8), bitorder="little")
            slices[at, : len(packed)] = packed
            at += 1
    return base, depth, slices.view("<u8")


def _build(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values("vec_id")
    ids, matrix = frame["vec_id"].to_numpy(), _matrix(frame["q"])
    base, depth, slices = build_block(ids, matrix)
    row = (int(frame["block"].iloc[0]), len(ids), ids.astype("<i8").tobytes(), base.tolist(), depth.tolist(), slices.tobytes())
    return pd.DataFrame([row], columns=["block", "n_rows", "ids", "base", "depth", "slices"])


def build_index(rows: DataFrame, blocks: int) -> DataFrame:
    """The stored index of ``quantised`` rows: one row per block."""
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    return stored(dealt.groupBy("block").applyInPandas(_build, INDEX), "bitslices")


def add_slices(query: np.ndarray, base: np.ndarray, depth: np.ndarray, slices: np.ndarray) -> tuple[int, list[np.ndarray | None]]:
    """A constant and the score's slices, least significant first (None: a map without bits)."""
    starts = np.concatenate([[0], np.cumsum(depth)])
    constant, by_weight = 0, {}
    for j in np.flatnonzero(query).tolist():
        q, d, lo = int(query[j]), int(depth[j]), int(starts[j])
        # a negative component counts down from the largest offset that d bits can hold
        constant += q * (int(base[j]) + ((1 << d) - 1 if q < 0 else 0))
        for bit in range(abs(q).bit_length()):
            if abs(q) >> bit & 1:
                for b in range(d):
                    by_weight.setdefault(bit + b, []).append((lo + b, q < 0))
    out: list[np.ndarray | None] = []
    carried: list[np.ndarray] = []
    weight = 0
    while by_weight or carried:
        wanted = by_weight.pop(weight, [])
        rows = np.array([r for r, _ in wanted], np.int64)
        maps = slices[rows] if len(rows) else np.zeros((0, slices.shape[1]), np.uint64)
        flip = np.array([f for _, f in wanted], bool)
        maps[flip] = ~maps[flip]
        maps = np.concatenate([maps, *carried]) if carried else maps
        carried = []
        while len(maps) > 2:
            third = len(maps) // 3
            a, b, c, rest = maps[:third], maps[third : 2 * third], maps[2 * third : 3 * third], maps[3 * third :]
            half = a ^ b
            carried.append((a & b) | (half & c))
            maps = np.concatenate([half ^ c, rest]) if len(rest) else half ^ c
        if len(maps) == 2:
            carried.append((maps[0] & maps[1])[None])
            maps = (maps[0] ^ maps[1])[None]
        out.append(maps[0] if len(maps) else None)
        weight += 1
    return constant, out


def _positions(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def _bits(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def _scores(maps: list[np.ndarray | None], at: np.ndarray) -> np.ndarray:
    total = np.zeros(len(at), np.int64)
    word, bit = at >> 6, (at & 63).astype(np.uint64)
    for weight, m in enumerate(maps):
        if m is not None:
            total += ((m[word] >> bit) & np.uint64(1)).astype(np.int64) << weight
    return total


def select_top(maps: list[np.ndarray | None], k: int, ids: np.ndarray, skip: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and sums of the ``k`` best rows, walking the slices from the top."""
    words = next((len(m) for m in maps if m is not None), -(-len(ids) // 64))
    open_ = np.full(words, np.uint64(0xFFFFFFFFFFFFFFFF))
    if len(ids) % 64:
        open_[-1] = np.uint64((1 << (len(ids) % 64)) - 1)
    if skip is not None:
        own = int(np.searchsorted(ids, skip))
        if own < len(ids) and ids[own] == skip:
            open_[own >> 6] &= ~np.uint64(1 << (own & 63))
    sure = np.zeros(words, np.uint64)
    for m in reversed(maps):
        if m is None:
            continue
        ahead = open_ & m
        n = _bits(sure) + _bits(ahead)
        if n <= k:
            sure |= ahead
            open_ &= ~m
        else:
            open_ = ahead
        if n == k:
            open_[:] = 0
            break
    chosen, boundary = _positions(sure), _positions(open_)
    # rows left open are tied; ids are ascending, so the first of them have the smallest
    at = np.concatenate([chosen, boundary[: k - len(chosen)]])
    return at, _scores(maps, at)


def _search(k: int):
    def work(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for block in left.itertuples():
            ids = np.frombuffer(block.ids, "<i8")
            base, depth = np.array(block.base, np.int64), np.array(block.depth, np.int64)
            slices = np.frombuffer(block.slices, "<u8").reshape(int(depth.sum()), -(-len(ids) // 64))
            for query in right.itertuples():
                q = np.zeros(len(base), np.int64)
                n = min(len(base), len(query.q))
                q[:n] = query.q[:n]
                constant, maps = add_slices(q, base, depth, slices)
                if len(maps) > 62:
                    raise ValueError("a score is too large for the index")
                at, total = select_top(maps, k, ids, int(query.vec_id))
                out.append(pd.DataFrame({"query_id": int(query.vec_id), "vec_id": ids[at], "score": total + constant}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")

    return work


def top_k(rows: DataFrame, queries: DataFrame, k: int = 5, rows_per_block: int = ROWS_PER_BLOCK, queries_per_block: int = QUERIES_PER_BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: the best rows of each query, its own id left out.

    ``rows`` and ``queries`` are frames of ``quantised``.
    """
    blocks = shards_for(row_count(rows), rows_per_block)
    query_blocks = shards_for(row_count(queries), queries_per_block)
    index = build_index(rows, blocks)
    copies = index.withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    dealt = queries.withColumn("query_block", F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).cast("int"))
    dealt = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    near = copies.groupBy("block", "query_block").cogroup(dealt.groupBy("block", "query_block")).applyInPandas(_search(k), "query_id long, vec_id long, score long")
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search_table(vectors: DataFrame, asked: Column, k: int = 5) -> DataFrame:
    """``top_k`` over a table, the rows that fulfil ``asked`` (on ``vec_id``) being the queries."""
    rows = compacted(quantised(vectors), "quantised")
    return top_k(rows, rows.filter(asked), k)
