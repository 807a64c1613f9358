"""Exact dedup against a minimal perfect hash over the digests of everything seen before.

History is reduced to its distinct digests, dealt to shards by hash and, per shard, numbered
without gaps by a minimal perfect hash (levels of bit maps: a key settles on the first level
where no other key wants its bit; its number is the count of set bits before it). The slot of a
number holds the full digest, the locator of the winning row and the size of its group. A new
digest goes to the one slot it could have and is a repeat only if all bytes agree there: then it
takes the slot's winner and adds to its group. Digests that are not members are grouped among
themselves before they are looked up.

Defined results
---------------
* a null text is the empty text; empty texts are equal to each other
* ids keep all 64 bits; negative and null ones are ordinary
* a null id is never a winner while the group has another id; a group of null ids keeps one row
  and its ``keep_id`` is null
* rows repeated as a whole (same id and text) are copies: one of them is kept
* only the id and text columns are read, so other columns may have any name; ``keep_first`` returns
  them all as they are
* a very long text is one digest
* empty history: every digest is grouped afresh; empty documents: an empty result
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakevault.llm.common import compacted, nullable, row_count, shards_for, stored, text_of, unused, whole

#: distinct digests in one shard of the index: 48 bytes each in the slots
KEYS_PER_SHARD = 100_000
#: bits per remaining key on each level of the hash
GAMMA = 2.0
DIGEST_BYTES = 32
#: a group of at least this part of all rows is hot; there are at most as many such groups
HOT_PARTS = 1000

OUTCOME = "digest binary, keep_id long, group_size long"
_OUTCOME = pa.schema([("digest", pa.binary()), ("keep_id", pa.int64()), ("group_size", pa.int64())])
INDEX = "shard int, n_keys long, level_bits array<long>, bits binary, digests binary, winners binary, has_winner binary, sizes binary"
_MIX_1, _MIX_2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def normalised(text: Column) -> Column:
    """White space runs become one space."""
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, digest, n)``: rows of the same id and text are counted, not repeated."""
    digest = F.unhex(F.sha2(normalised(text_of(text_col)), 256))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), digest.alias("digest"))
    return rows.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("n"))


def _words(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hash words of each digest (rows of 32 bytes); every byte takes part."""
    parts = np.ascontiguousarray(rows).view("<u8").reshape(len(rows), -1)
    return parts[:, 0] ^ (parts[:, 2] * _MIX_1), (parts[:, 1] ^ (parts[:, 3] * _MIX_2)) | np.uint64(1)


def _place(first: np.ndarray, step: np.ndarray, level: int, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = first + step * np.uint64(level + 1)
        h ^= h >> np.uint64(33)
        h *= _MIX_1
        h ^= h >> np.uint64(29)
        h *= _MIX_2
        h ^= h >> np.uint64(32)
    return (h % np.uint64(bits)).astype(np.int64)


def _as_rows(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), DIGEST_BYTES)


def build_shard(keys: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Bits per level, all levels' bit map, and each key's slot. ``keys``: distinct digests."""
    first, step = _words(keys)
    left, sizes, maps, at = np.arange(len(keys)), [], [], np.empty(len(keys), np.int64)
    base = 0
    while len(left):
        if len(sizes) == 200:
            raise ValueError("digests are not distinct")
        bits = max(64, int(GAMMA * len(left)))
        place = _place(first[left], step[left], len(sizes), bits)
        alone = np.bincount(place, minlength=bits) == 1
        settled = alone[place]
        at[left[settled]] = base + place[settled]
        left = left[~settled]
        sizes.append(bits)
        maps.append(alone)
        base += bits
    bitmap = np.concatenate(maps) if maps else np.zeros(0, bool)
    rank = np.cumsum(bitmap) - 1
    return sizes, bitmap, rank[at] if len(keys) else at


def probe_shard(sizes: list[int], bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The only slot each key could have, or -1."""
    first, step = _words(keys)
    rank, slot, left, base = np.cumsum(bitmap) - 1, np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
    for level, bits in enumerate(sizes):
        place = base + _place(first[left], step[left], level, bits)
        hit = bitmap[place]
        slot[left[hit]] = rank[place[hit]]
        left = left[~hit]
        base += bits
    return slot


def _build(table: pa.Table) -> pa.Table:
    keys = _as_rows(table["digest"])
    sizes, bitmap, slot = build_shard(keys)
    n = len(keys)
    digests_, winners, has, counts = np.empty_like(keys), np.zeros(n, "<i8"), np.zeros(n, np.uint8), np.empty(n, "<i8")
    digests_[slot], counts[slot] = keys, whole(table["size"])[0]
    winners[slot], has[slot] = whole(table["winner"])
    row = (table["shard"][0].as_py(), n, sizes, np.packbits(bitmap).tobytes(), digests_.tobytes(), winners.tobytes(), has.tobytes(), counts.tobytes())
    kinds = [pa.int32(), pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 5]
    names = ["shard", "n_keys", "level_bits", "bits", "digests", "winners", "has_winner", "sizes"]
    return pa.table({name: pa.array([value], kind) for name, value, kind in zip(names, row, kinds)})


def _grouped(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(F.min("doc_id").alias("winner"), F.sum("n").alias("size"))


def _with_shard(df: DataFrame, shards: int) -> DataFrame:
    return df.withColumn("shard", F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int"))


def build_index(winners: DataFrame, shards: int) -> DataFrame:
    """The stored index over ``winners`` (``digest, winner, size``): one row per shard.

    A shard holds distinct digests only and there are as many shards as the count asks for, so a
    shard is bounded whatever the number of copies.
    """
    return stored(_with_shard(winners, shards).groupBy("shard").applyInArrow(_build, INDEX), "digest-index")


def _looked_up(index: pa.Table, asked: pa.Table) -> pa.Table:
    """The groups of one shard: a member adds to its slot, a nonmember is a group of its own."""
    keys = _as_rows(asked["digest"])
    size, (winner, known) = whole(asked["size"])[0], whole(asked["winner"])
    if not index.num_rows:
        return pa.table([asked["digest"].combine_chunks(), nullable(winner, known), pa.array(size)], schema=_OUTCOME)
    row = index.slice(0, 1).to_pylist()[0]
    sizes = row["level_bits"]
    bitmap = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=sum(sizes)).astype(bool)
    held = np.frombuffer(row["digests"], np.uint8).reshape(-1, DIGEST_BYTES)
    total, keep, has = np.frombuffer(row["sizes"], "<i8").copy(), np.frombuffer(row["winners"], "<i8").copy(), np.frombuffer(row["has_winner"], np.uint8).astype(bool)
    slot = probe_shard(sizes, bitmap, keys)
    seen = (slot >= 0) & (held[np.maximum(slot, 0)] == keys).all(axis=1)
    at = slot[seen]
    total[at] += size[seen]  # asked digests are distinct, so a slot is met once
    late = ~has[at]  # history knew no id for this text
    keep[at[late]], has[at[late]] = winner[seen][late], known[seen][late]
    new = ~seen
    digest = [*map(bytes, held), *map(bytes, keys[new])]
    kept = nullable(np.concatenate([keep, winner[new]]), np.concatenate([has, known[new]]))
    return pa.table([pa.array(digest, pa.binary()), kept, pa.array(np.concatenate([total, size[new]]))], schema=_OUTCOME)


def decide(history: DataFrame, incoming: DataFrame) -> DataFrame:
    """``(digest, keep_id, group_size)`` over both, the winner of history standing."""
    winners = compacted(_grouped(history), "digest-winners")
    shards = shards_for(max(row_count(winners), row_count(incoming)), KEYS_PER_SHARD)
    index = build_index(winners, shards)
    asked = _with_shard(_grouped(incoming), shards)
    return index.groupBy("shard").cogroup(asked.groupBy("shard")).applyInArrow(_looked_up, OUTCOME)


def dedup_rows(history: DataFrame, incoming: DataFrame) -> DataFrame:
    """One row per row of both: ``doc_id, digest, keep_id, group_size, kept``.

    ``history`` and ``incoming`` are frames of ``digests``. Most texts occur once and need no answer.
    A group of a thousandth of all rows or more is hot: there are at most ``HOT_PARTS`` of them, so
    their answers are broadcast and their rows stay where they are; all others are joined by digest.
    """
    rows = history.unionByName(incoming)
    groups = stored(decide(history, incoming).filter("group_size > 1"), "digest-groups")
    total = rows.agg(F.sum("n")).first()[0] or 0
    hot = F.col("group_size") >= max(2, total // HOT_PARTS)
    told = rows.join(F.broadcast(groups.filter(hot)), "digest", "left")
    plain = told.filter("group_size IS NULL").select(*rows.columns).join(groups.filter(~hot), "digest", "left")
    joined = told.filter("group_size IS NOT NULL").unionByName(plain)
    alone = F.col("group_size").isNull()
    answered = joined.withColumns({"keep_id": F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")), "group_size": F.coalesce("group_size", F.lit(1).cast("long"))})
    copies = answered.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    return copies.select("doc_id", "digest", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"))


def earlier_and_later(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split digests at the middle of the id range: what was seen before, and what comes now.

    Every id of history is smaller than every new one, so history's winner is the group's smallest id.
    """
    low, high = rows.agg(F.min("doc_id"), F.max("doc_id")).first()
    middle = 0 if low is None else (low + high) // 2
    before = F.coalesce(F.col("doc_id") <= F.lit(middle), F.lit(False))
    return rows.filter(before), rows.filter(~before)


def dedup_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``dedup_rows`` over a whole table, its earlier half being the history."""
    rows = compacted(digests(docs, id_col, text_col), "digests")
    return dedup_rows(*earlier_and_later(rows))


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one per text, all columns as they are.

    Decisions are joined by id and digest, both null-safe, and rows repeated as a whole are reduced
    to one afterwards (same partitioning, no further shuffle).
    """
    id_, digest, own = (unused(docs, c) for c in ("kept_id", "kept_digest", "own_digest"))
    kept = dedup_documents(docs).filter("kept").select(F.col("doc_id").alias(id_), F.col("digest").alias(digest))
    kept = compacted(kept, "digests-kept")
    marked = docs.withColumn(own, F.unhex(F.sha2(normalised(text_of()), 256)))
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col(own) == F.col(digest))
    return marked.join(kept, same, "left_semi").dropDuplicates(["doc_id", own]).drop(own)
