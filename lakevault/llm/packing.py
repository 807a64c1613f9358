"""Best-fit packing of documents into sequences, finished by a swap-based local search.

Documents become token ids closed by one end id; only those longer than a sequence are cut, into
full pieces after a possibly shorter first one. Pieces are dealt at random into groups of bounded
size, as many as the count asks for; in a group every piece goes to the fullest bin that takes it,
longest first. Then bins are emptied: from the least filled bin documents move to others, one is
exchanged for a shorter one or two for a shorter one, always so that the fuller bin gets fuller.
Every step raises the sum of squared fills, so the search ends; it stops when no bin can be saved.

Only piece records (no ids) are shuffled. A group holds at most a fixed number of pieces in
expectation, whatever their documents.

Defined results
---------------
* a null or empty text is the end id alone; ids keep all 64 bits, a null id is carried
* rows repeated as a whole are packed as often as they occur
* a very long text is cut into pieces like any other
* other columns are not read; further columns of pieces are carried under any name but the two added;
  empty documents give an empty result
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakevault.llm import tokens
from lakevault.llm.common import arrow_batches, arrow_rows, row_count, shards_for, stored, unused

CAPACITY = 2048
#: pieces packed together; a group wastes at most a fraction of one sequence
PIECES_PER_GROUP = 32_768
END_ID = 0

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_points(length: int, capacity: int = CAPACITY) -> list[int]:
    """Where the pieces of a document of ``length`` ids begin, and its end."""
    first = length % capacity or min(length, capacity)
    return [0, *range(first, length + 1, capacity)]


def document_pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids``."""

    kinds = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    schema = pa.schema(kinds + [("ids", pa.binary())] * with_ids)

    def pieces(rows: Iterator[tuple]) -> Iterator[tuple]:
        encode = tokens.encoder(tokenizer)
        end = np.array([END_ID], np.uint32)
        for doc_id, text in rows:
            ids = np.concatenate([encode(text), end]).astype("<u4")
            cuts = cut_points(len(ids), capacity)
            for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
                raw = ids[a:b].tobytes()
                yield (doc_id, piece, a, b - a, zlib.crc32(raw), *[raw] * with_ids)

    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return read.mapInArrow(lambda batches: arrow_batches(pieces(arrow_rows(batches)), schema, 1024), PIECE + ", ids binary" * with_ids)


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Longest first, each into the fullest bin that takes it; a bit map finds that bin."""
    bins: list[list[int]] = []
    by_space: dict[int, list[int]] = {}
    spaces = 0  # bit s is set if some bin has s free
    for item in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[item])
        fitting = spaces >> need
        if fitting:
            space = need + (fitting & -fitting).bit_length() - 1
            b = by_space[space].pop()
            if not by_space[space]:
                spaces ^= 1 << space
            bins[b].append(item)
        else:
            space, b = capacity, len(bins)
            bins.append([item])
        if space > need:
            by_space.setdefault(space - need, []).append(b)
            spaces |= 1 << (space - need)
    return bins


def improve(bins: list[list[int]], lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Empty the least filled bins by moves and exchanges that raise the squared fill."""
    total = int(lengths.sum())
    least = -(-total // capacity)
    fill = [int(lengths[b].sum()) for b in bins]
    full = [b for b, f in zip(bins, fill) if f == capacity]
    open_ = sorted(((f, b) for f, b in zip(fill, bins) if f < capacity), key=lambda x: x[0])
    bins_, used = [b for _, b in open_], np.array([f for f, _ in open_], np.int64)
    # every document of the open bins: its length and its bin
    item = np.array([i for b in bins_ for i in b], np.int64)
    size = lengths[item].astype(np.int64) if len(item) else np.zeros(0, np.int64)
    home = np.repeat(np.arange(len(bins_)), [len(b) for b in bins_])
    alive = len(bins_)
    victims = np.argsort(used, kind="stable")
    for victim in victims.tolist():
        if len(full) + alive <= least:
            break
        while used[victim] and _step(victim, size, home, used, capacity):
            pass
        alive -= not used[victim]
    out = [[] for _ in bins_]
    for i, h in zip(item.tolist(), home.tolist()):
        out[h].append(i)
    return full + [b for b in out if b]


def _step(victim: int, size: np.ndarray, home: np.ndarray, used: np.ndarray, capacity: int) -> bool:
    """One improving step away from ``victim``; the one that moves most. False: there is none."""
    own = np.flatnonzero(home == victim)
    takes = (home != victim) & (used[home] >= used[victim])
    other = np.flatnonzero(takes)
    space = capacity - used
    space_at = space[home[other]]
    best = (0, None)
    targets = np.flatnonzero((used >= used[victim]) & (space > 0))
    targets = targets[targets != victim]
    for x in own.tolist():
        if len(targets) and (ok := targets[space[targets] >= size[x]]).size and size[x] > best[0]:
            best = (int(size[x]), ((x,), None, int(ok[np.argmin(space[ok])])))
    groups = [(x,) for x in own.tolist()] + [(x, y) for i, x in enumerate(own.tolist()) for y in own.tolist()[i + 1 :]]
    for group in groups if len(other) else []:
        gain = size[list(group)].sum() - size[other]
        gain = np.where((gain > 0) & (gain <= space_at), gain, 0)
        at = int(np.argmax(gain))
        if gain[at] > best[0]:
            best = (int(gain[at]), (group, int(other[at]), int(home[other[at]])))
    if best[1] is None:
        return False
    gain, (group, back, target) = best
    home[list(group)] = target
    if back is not None:
        home[back] = victim
    used[victim] -= gain
    used[target] += gain
    return True


def pack(lengths: np.ndarray, capacity: int = CAPACITY) -> list[list[int]]:
    """Bins of item numbers."""
    return improve(best_fit(lengths, capacity), lengths, capacity)


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, per_group: int = PIECES_PER_GROUP) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to stored pieces; any further columns stay."""
    groups, group = shards_for(row_count(pieces), per_group), unused(pieces, "packing_group")
    dealt = pieces.withColumn(group, F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)).cast("int"))

    def work(table: pa.Table) -> pa.Table:
        lengths = table["length"].to_numpy()
        bins = pack(lengths, capacity)
        order = np.array([i for b in bins for i in b], np.int64)
        counts = [len(b) for b in bins]
        ends = np.cumsum(lengths[order])
        begins = ends - lengths[order]
        first = np.repeat(begins[np.cumsum([0, *counts[:-1]])], counts)
        number = np.repeat(np.arange(len(bins)), counts) + (table[group][0].as_py() << 32)
        packed = table.take(order).drop_columns([group])
        return packed.append_column("sequence_id", pa.array(number, pa.int64())).append_column("offset", pa.array(begins - first, pa.int64()))

    schema = ", ".join(f"`{name}` {kind}" for name, kind in pieces.dtypes) + ", sequence_id long, offset long"
    return dealt.groupBy(group).applyInArrow(work, schema)


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack: one row per piece with its place."""
    pieces = stored(document_pieces(docs, tokenizer, capacity, with_ids=with_ids), "pieces")
    return pack_pieces(pieces, capacity)
