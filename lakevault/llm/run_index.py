"""Long repeats across documents, by matching statistics against run-length indexes.

A window is ``WIDTH`` bytes of one document. A byte is removed if a window that covers it also starts
in a document with a smaller id. The work is dealt by content, so that no document has to meet all
others:

1. Texts are laid down in blocks of a few MB. Each window is named by the least hash of its
   ``ANCHOR``-byte substrings; equal windows have equal names, and neighbouring windows of one name
   form a segment, every window of which has that name.
2. Blocks send their distinct names to shards, which send back one bit per name: do two documents have
   it? Segments of other names hold no repeat.
3. Blocks send the distinct segments that are left, with the smallest id that holds them, to shards.
   A shard takes the segment with the smallest id of each name, its leader, and builds the Burrows-
   Wheeler transform of all leaders in run-length form: run heads, run starts and the suffix positions
   of the first and last row of each run, nothing per row. All other segments are streamed through it
   from their right end: a row whose run has the wanted symbol is followed, else the match goes on from
   the nearest run end above or below with the longer common extension. Where the matching statistic
   reaches ``WIDTH``, the leader is the smallest document with that window.
4. Windows that their leader does not have are compared with each other, by the order of their first
   ``WIDTH`` symbols, and get the smallest id of their like. If a shard is left with more than
   ``REST_BYTES`` of them (one very frequent phrase in ever new contexts), they leave the shard and are
   grouped by their whole content by Spark.
5. The smallest ids go back to the blocks, which mark and cut.

Texts are dealt once and stay where they are (a bucketed table); names, segments and answers travel.
A copied segment travels once per block, and is streamed once per shard.

Defined results
---------------
* a null text is empty; texts shorter than a window lose nothing
* a null id counts as the largest id there is; rows with one id are never smaller than each other,
  so neither loses bytes to the other; rows repeated as a whole are kept as they are
* bytes, not characters, are removed: what is kept is binary and need not be valid UTF-8
* very long texts are a block of their own; other columns are not read; an empty table gives an empty
  result
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakevault.llm.common import shards_for, stored, text_of
from lakevault.session import work_folder

WIDTH = 50
ANCHOR = 24
#: text of one block, and of the documents whose names or segments meet in one shard
BLOCK_BYTES = 4 << 20
NAMES_BYTES = 16 << 20
SEGMENTS_BYTES = 4 << 20
#: windows of a segment; only periodic texts have longer ones
LONGEST = 256
REST_BYTES = 32 << 20
NULL_ID = 2**63 - 1

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)]


# --- names and segments of a block ---


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on; data must be followed by seven more bytes."""
    out = np.empty(len(data) - 7, "<u8")
    for shift in range(8):
        part = np.frombuffer(data, "<u8", count=(len(data) - shift) // 8, offset=shift)
        out[shift::8] = part[: len(out[shift::8])]
    return out


def window_names(data: np.ndarray, width: int = WIDTH, anchor: int = ANCHOR) -> np.ndarray:
    """The least anchor hash of every window of ``data`` (bytes)."""
    if len(data) < width:
        return np.empty(0, np.uint64)
    words = _words(data)
    count = len(data) - anchor + 1
    with np.errstate(over="ignore"):
        h = np.zeros(count, np.uint64)
        at = 0
        while at < anchor:  # whole words; the last one may overlap the one before
            step = min(at, anchor - 8)
            h += words[step : step + count]
            h *= _ODD[(at // 8) % 3]
            h ^= h >> np.uint64(31)
            at += 8
    span, least = width - anchor + 1, h
    reach = 1
    while reach * 2 <= span:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < span:
        least = np.minimum(least[: len(least) - (span - reach)], least[span - reach :])
    with np.errstate(over="ignore"):
        return least * _ODD[3]  # minima are small numbers; names are spread over all of them


class Block:
    """The texts of one block, and their segments in the order of their names."""

    def __init__(self, texts: list[bytes], width: int, anchor: int):
        self.data = b"".join(texts)
        self.width = width
        lengths = np.array([len(t) for t in texts], np.int64)
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths
        names = window_names(np.frombuffer(self.data, np.uint8), width, anchor)
        doc = np.repeat(np.arange(len(texts)), lengths)[: len(names)]
        inside = np.arange(len(names)) + width <= self.ends[doc] if len(names) else np.empty(0, bool)
        edge = np.empty(len(names), bool)
        edge[:1] = True
        edge[1:] = (names[1:] != names[:-1]) | (doc[1:] != doc[:-1]) | (inside[1:] != inside[:-1])
        first = np.flatnonzero(edge)
        size = np.diff(np.append(first, len(names)))
        real = inside[first] if len(first) else np.empty(0, bool)
        first, size = first[real], size[real]
        pieces = -(-size // LONGEST)
        part = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        at = np.repeat(first, pieces) + part * LONGEST
        n = np.minimum(np.repeat(size, pieces) - part * LONGEST, LONGEST)
        order = np.argsort(names[at], kind="stable")
        self.at, self.n = at[order], n[order]  # where a segment begins, and its windows
        self.name, self.doc = names[self.at], doc[self.at]
        self.group = np.flatnonzero(np.append(True, self.name[1:] != self.name[:-1])) if len(self.name) else np.empty(0, np.int64)

    def distinct_names(self) -> tuple[np.ndarray, np.ndarray]:
        """The names, ascending, and whether two documents of the block have them."""
        if not len(self.name):
            return self.name, np.empty(0, bool)
        return self.name[self.group], np.minimum.reduceat(self.doc, self.group) != np.maximum.reduceat(self.doc, self.group)

    def distinct_segments(self, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Of the segments with a shared name: which they are, the number of each one's content, the contents."""
        sizes = np.diff(np.append(self.group, len(self.name)))
        kept = np.flatnonzero(np.repeat(shared, sizes))
        found: dict[bytes, int] = {}
        data, tail = self.data, self.width - 1
        number = [found.setdefault(data[a : a + n + tail], len(found)) for a, n in zip(self.at[kept].tolist(), self.n[kept].tolist())]
        return kept, np.array(number, np.int64), list(found)


def _shard(names: np.ndarray, shards: int) -> np.ndarray:
    """Ascending with the names."""
    return ((names >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _cells(names: np.ndarray, shards: int) -> Iterator[tuple[int, int, int]]:
    """``(shard, from, to)`` over ascending names."""
    own = _shard(names, shards)
    edges = np.flatnonzero(np.append(True, own[1:] != own[:-1])) if len(own) else own
    for a, b in zip(edges.tolist(), np.append(edges[1:], len(own)).tolist()):
        yield int(own[a]), a, b


# --- the index ---


def suffix_order(symbols: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Positions in the order of the rest of their segment, then by position. ``left``: symbols up to
    the segment's separator, which is symbol 0."""
    n = len(symbols)
    key = np.zeros(n, np.int64)
    for t in range(7):
        key <<= 9
        key[: n - t] |= np.where(left[: n - t] >= t, symbols[t:], 0)
    reach, most = 7, int(left.max()) + 1
    while True:
        order = np.argsort(key)
        ordered = key[order]
        new = np.append(True, ordered[1:] != ordered[:-1])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)
        if new.all() or reach >= most:
            return order if new.all() else np.argsort(rank * n + np.arange(n))
        key = rank * np.int64(n + 2)
        key[: n - reach] += np.where(left[: n - reach] >= reach, rank[reach:], 0)
        reach *= 2


class RunLengthIndex:
    """A run-length Burrows-Wheeler transform of byte strings with sampled run ends."""

    def __init__(self, texts: list[bytes]):
        lengths = np.array([len(t) + 1 for t in texts], np.int64)
        joined = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
        n = len(joined)
        ends = np.repeat(np.cumsum(lengths) - 1, lengths)
        self.left = ends - np.arange(n)
        symbols = joined.astype(np.int64) + 1
        symbols[self.left == 0] = 0
        self.words = _words(np.append(joined, np.zeros(8, np.uint8)))
        order = suffix_order(symbols, self.left)
        transform = symbols[order - 1]
        self.starts = np.flatnonzero(np.append(True, transform[1:] != transform[:-1]))
        self.heads = transform[self.starts]
        last = np.append(self.starts[1:], n) - 1
        self.lengths = last - self.starts + 1
        self.sample_first, self.sample_last = order[self.starts], order[last]
        # runs by symbol: how many of it come before, and where its rows begin
        self.by_symbol = np.lexsort((self.starts, self.heads))
        self.n = n
        self.keys = self.heads[self.by_symbol] * (n + 1) + self.starts[self.by_symbol]
        before = np.empty(len(self.starts), np.int64)
        before[self.by_symbol] = np.cumsum(self.lengths[self.by_symbol]) - self.lengths[self.by_symbol]
        self.follow = before  # rows are ordered by symbol first, so the count over all smaller symbols is included

    def _common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Length of the common extension of the suffixes at a and b, ``most`` at most."""
        most = np.minimum(most, self.left[a])
        found = np.zeros(len(a), np.int64)
        open_ = np.flatnonzero(most > 0)
        while len(open_):
            x = self.words[a[open_] + found[open_]] ^ self.words[b[open_] + found[open_]]
            with np.errstate(over="ignore"):
                same = np.bitwise_count((x & (~x + np.uint64(1))) - np.uint64(1)).astype(np.int64) >> 3
            found[open_] += same
            open_ = open_[(same == 8) & (found[open_] < most[open_])]
        return np.minimum(found, most)

    def matching_statistics(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """For every position of the texts, laid end to end, the length of its longest match; and the offsets."""
        lengths = np.array([len(t) for t in texts], np.int64)
        offsets = np.cumsum(lengths) - lengths
        symbols = np.frombuffer(b"".join(texts), np.uint8).astype(np.int64) + 1
        statistics = np.zeros(len(symbols), np.int64)
        by_length = np.argsort(-lengths, kind="stable")
        ascending, right = -lengths[by_length], (offsets + lengths)[by_length] - 1
        row, pos, length = np.full(len(texts), -1), np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        for step in range(int(lengths.max(initial=0))):
            active = int(np.searchsorted(ascending, -step, "left"))
            where = right[:active] - step
            symbol = symbols[where]
            run = np.searchsorted(self.starts, np.maximum(row[:active], 0), "right") - 1
            fits = (self.heads[run] == symbol) & (row[:active] >= 0)
            go = np.flatnonzero(fits)
            row[go] = self.follow[run[go]] + row[go] - self.starts[run[go]]
            pos[go] -= 1
            length[go] += 1
            jump = np.flatnonzero(~fits)
            if len(jump):
                self._jump(jump, symbol[jump], row, pos, length)
            statistics[where] = length[:active]
        return statistics, offsets

    def _jump(self, jump: np.ndarray, symbol: np.ndarray, row: np.ndarray, pos: np.ndarray, length: np.ndarray) -> None:
        """Go on from the nearest run of the wanted symbol above or below, whichever shares more."""
        next_ = np.searchsorted(self.keys, symbol * (self.n + 1) + np.maximum(row[jump], 0), "right")
        above = self.by_symbol[np.maximum(next_ - 1, 0)]
        below = self.by_symbol[np.minimum(next_, len(self.by_symbol) - 1)]
        has_above = (next_ > 0) & (self.heads[above] == symbol)
        has_below = (next_ < len(self.by_symbol)) & (self.heads[below] == symbol)
        up = np.where(has_above, self._common(self.sample_last[above], pos[jump], length[jump]), -1)
        down = np.where(has_below, self._common(self.sample_first[below], pos[jump], length[jump]), -1)
        take_up = up >= down
        common = np.where(take_up, up, down)
        run = np.where(take_up, above, below)
        known = common >= 0
        row[jump] = np.where(known, self.follow[run] + np.where(take_up, self.lengths[run] - 1, 0), -1)
        pos[jump] = np.where(known, np.where(take_up, self.sample_last[run], self.sample_first[run]) - 1, 0)
        length[jump] = np.where(known, common + 1, 0)


def like_windows(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """For every position of the texts, laid end to end with one separator each, a number that windows
    with equal bytes share; and the offsets."""
    lengths = np.array([len(t) + 1 for t in texts], np.int64)
    data = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
    n = len(data)

    def numbered(key: np.ndarray) -> np.ndarray:
        order = np.argsort(key)
        ordered = key[order]
        out = np.empty(n, np.int64)
        out[order] = np.cumsum(np.append(True, ordered[1:] != ordered[:-1]))
        return out

    rank, reach = numbered(_words(np.append(data, np.zeros(7, np.uint8)))), 8
    while reach < width:
        step = min(reach, width - reach)
        key = rank * np.int64(n + 1)
        key[: n - step] += rank[step:]
        rank, reach = numbered(key), reach + step
    return rank, np.cumsum(lengths) - lengths


def smallest_holders(names: np.ndarray, owners: np.ndarray, texts: list[bytes], width: int, rest_bytes: int):
    """For every window of every text, the smallest owner among the texts that hold it.

    Returns runs ``(text, from, to, owner)`` as four arrays, sorted by text, and the windows
    ``(text, window)`` that are too many to be compared here.
    """
    windows = np.array([len(t) - width + 1 for t in texts], np.int64)
    order = np.lexsort((-windows, owners, names))
    leads = np.append(True, names[order][1:] != names[order][:-1])
    leader_of = np.empty(len(texts), np.int64)
    leader_of[order] = order[leads][np.cumsum(leads) - 1]
    others = np.flatnonzero(leader_of != np.arange(len(texts)))
    at = np.cumsum(windows) - windows
    holder = np.repeat(owners, windows)
    open_ = np.empty(0, np.int64)
    if len(others):
        leaders = np.unique(leader_of[others])
        index = RunLengthIndex([texts[i] for i in leaders])
        statistics, offsets = index.matching_statistics([texts[i] for i in others])
        size = windows[others]
        inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        found = statistics[np.repeat(offsets, size) + inner] >= width
        place = np.repeat(at[others], size) + inner
        holder[place] = np.where(found, np.repeat(owners[leader_of[others]], size), holder[place])
        left = np.flatnonzero(np.add.reduceat(~found, np.cumsum(size) - size))
        # a text alone under its name has nobody to share what its leader lacks
        _, back, times = np.unique(names[others[left]], return_inverse=True, return_counts=True)
        open_ = others[left[times[back] > 1]]
        missing = np.zeros(len(holder), bool)
        missing[place] = ~found
    far: tuple[np.ndarray, np.ndarray] = (np.empty(0, np.int64), np.empty(0, np.int64))
    if len(open_):
        size = windows[open_]
        inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        place = np.repeat(at[open_], size) + inner
        real = missing[place]
        if sum(len(texts[i]) for i in open_) > rest_bytes:
            far = np.repeat(open_, size)[real], inner[real]
        else:
            like, offsets = like_windows([texts[i] for i in open_], width)
            like = like[np.repeat(offsets, size) + inner][real]
            order = np.argsort(like, kind="stable")
            edge = np.flatnonzero(np.append(True, like[order][1:] != like[order][:-1]))
            least = np.minimum.reduceat(holder[place[real]][order], edge)
            holder[place[real][order]] = np.repeat(least, np.diff(np.append(edge, len(order))))
    text = np.repeat(np.arange(len(texts)), windows)
    edge = np.flatnonzero(np.append(True, (holder[1:] != holder[:-1]) | (text[1:] != text[:-1])))
    runs = text[edge], edge - at[text[edge]], np.append(edge[1:], len(text)) - at[text[edge]], holder[edge]
    return runs, far


# --- Spark ---

_NAMES = "shard int, block long, names binary, twice binary"
_BITS = "block long, shard int, n int, payload binary"
_SEGMENTS = "shard int, block long, first int, names binary, sizes binary, owners binary, payload binary"
_ANSWERS = "block long, segment binary, begin binary, stop binary, owner binary, far_segment int, far_begin int, far_owner long, far_window binary"
_OUT = "doc_id long, n_bytes long, spans array<struct<start:long,stop:long>>, kept binary"


def _arrow(schema: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in schema.split(", "))])


def _table(rows, schema: str) -> pa.Table:
    kind = _arrow(schema)
    columns = list(zip(*rows)) or [[] for _ in kind]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, kind)], schema=kind)


def _raw(column, kind) -> list[np.ndarray]:
    return [np.frombuffer(x, kind) for x in column.to_pylist()]


def _sorted_texts(docs: pa.Table) -> tuple[list, list[bytes]]:
    """Ids and texts of a block in one order for all passes."""
    docs = docs.sort_by("row")
    return docs["doc_id"].to_pylist(), docs["text"].to_pylist()


def _block_of(docs: pa.Table, answers: pa.Table, width: int, anchor: int):
    """A block's ids, texts and segments, and which names are shared."""
    ids, texts = _sorted_texts(docs)
    block = Block(texts, width, anchor)
    bits = answers.filter(pc.is_valid(answers["n"])).sort_by("shard")
    parts = [np.unpackbits(np.frombuffer(p, np.uint8), count=n).astype(bool) for p, n in zip(bits["payload"].to_pylist(), bits["n"].to_pylist())]
    return ids, texts, block, np.concatenate(parts) if parts else np.empty(0, bool)


def _laid_down(docs: DataFrame, id_col: str, text_col: str, block_bytes: int) -> tuple[DataFrame, int]:
    """The texts in blocks, as a table bucketed by block, and their bytes."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).cast("binary").alias("text"), F.spark_partition_id().alias("part"))
    kind = pa.schema([("block", pa.int64()), ("row", pa.int32()), ("doc_id", pa.int64()), ("text", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = filled = row = 0
        for batch in batches:
            blocks, numbers = [], []
            part = batch.column(2)[0].as_py() if batch.num_rows else 0
            for size in pc.binary_length(batch.column(1)).to_pylist():
                if filled and filled + size > block_bytes:
                    block, filled, row = block + 1, 0, 0
                blocks.append((part << 31) + block)
                numbers.append(row)
                filled, row = filled + max(1, size), row + 1
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array(numbers, pa.int32()), batch.column(0), batch.column(1)], schema=kind)

    blocks = rows.mapInArrow(work, "block long, row int, doc_id long, text binary")
    name = f"repeat_blocks_{uuid.uuid4().hex[:12]}"
    size = docs.agg(F.sum(F.octet_length(text_of(text_col)).cast("long"))).first()[0] or 0
    # a bucket is a task of every later pass; blocks are whole, so buckets of a few of them are even enough
    buckets = max(8, shards_for(size, 2 * block_bytes))
    blocks.write.bucketBy(buckets, "block").option("path", work_folder(spark, name)).option("compression", "zstd").format("parquet").saveAsTable(name)
    return spark.table(name), size


def repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    anchor: int = ANCHOR,
    block_bytes: int = BLOCK_BYTES,
    names_bytes: int = NAMES_BYTES,
    segments_bytes: int = SEGMENTS_BYTES,
    rest_bytes: int = REST_BYTES,
) -> DataFrame:
    """``doc_id, n_bytes, spans, kept``: the removed byte spans of every document and what is left of it."""
    if not 8 <= anchor <= width:
        raise ValueError("an anchor has 8 bytes at least and fits into a window")
    texts, size = _laid_down(docs, id_col, text_col, block_bytes)
    name_shards, segment_shards = shards_for(size, names_bytes), shards_for(size, segments_bytes)

    def names(table: pa.Table) -> pa.Table:
        distinct, twice = Block(_sorted_texts(table)[1], width, anchor).distinct_names()
        block = table["block"][0].as_py()
        return _table([(s, block, distinct[a:b].tobytes(), np.packbits(twice[a:b]).tobytes()) for s, a, b in _cells(distinct, name_shards)], _NAMES)

    def shared(table: pa.Table) -> pa.Table:
        cells = _raw(table["names"], np.uint64)
        twice = [np.unpackbits(t, count=len(c)) for t, c in zip(_raw(table["twice"], np.uint8), cells)]
        every = np.concatenate(cells)
        order = np.argsort(every)
        edge = np.flatnonzero(np.append(True, every[order][1:] != every[order][:-1]))
        times = np.diff(np.append(edge, len(every)))
        both = (times > 1) | (np.maximum.reduceat(np.concatenate(twice)[order], edge) > 0)
        out = np.empty(len(every), bool)
        out[order] = np.repeat(both, times)
        at = np.append(0, np.cumsum([len(c) for c in cells]))
        blocks, shard = table["block"].to_pylist(), table["shard"][0].as_py()
        return _table([(b, shard, len(c), np.packbits(out[at[i] : at[i + 1]]).tobytes()) for i, (b, c) in enumerate(zip(blocks, cells))], _BITS)

    def segments(table: pa.Table, bits: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _table([], _SEGMENTS)
        ids, _, block, held = _block_of(table, bits, width, anchor)
        kept, number, contents = block.distinct_segments(held)
        order = np.array([NULL_ID if i is None else i for i in ids], np.int64)
        owner = np.full(len(contents), NULL_ID, np.int64)
        np.minimum.at(owner, number, order[block.doc[kept]])
        name = np.empty(len(contents), np.uint64)
        name[number] = block.name[kept]
        sizes = np.array([len(c) for c in contents], np.int32)
        own = table["block"][0].as_py()
        return _table([(s, own, a, name[a:b].tobytes(), sizes[a:b].tobytes(), owner[a:b].tobytes(), b"".join(contents[a:b])) for s, a, b in _cells(name, segment_shards)], _SEGMENTS)

    def answers(table: pa.Table) -> pa.Table:
        found: dict[bytes, int] = {}
        numbers = []
        for sizes, payload in zip(_raw(table["sizes"], np.int32), table["payload"].to_pylist()):
            ends = np.cumsum(sizes).tolist()
            numbers.append(np.array([found.setdefault(payload[a:b], len(found)) for a, b in zip([0, *ends], ends)], np.int64))
        every = np.concatenate(numbers)
        owner, name = np.full(len(found), NULL_ID, np.int64), np.empty(len(found), np.uint64)
        np.minimum.at(owner, every, np.concatenate(_raw(table["owners"], np.int64)))
        name[every] = np.concatenate(_raw(table["names"], np.uint64))
        texts = list(found)
        (text, begin, stop, holder), (far_text, far_window) = smallest_holders(name, owner, texts, width, rest_bytes)
        edge = np.searchsorted(text, np.arange(len(texts) + 1))
        far_edge = np.searchsorted(far_text, np.arange(len(texts) + 1))
        rows = []
        for block, first, number in zip(table["block"].to_pylist(), table["first"].to_pylist(), numbers):
            times = edge[number + 1] - edge[number]
            pick = np.arange(times.sum()) + np.repeat(edge[number] - (np.cumsum(times) - times), times)
            segment = np.repeat(first + np.arange(len(number)), times)
            rows.append((block, segment.astype(np.int32).tobytes(), begin[pick].astype(np.int32).tobytes(), stop[pick].astype(np.int32).tobytes(), holder[pick].tobytes(), None, None, None, None))
            for i in np.flatnonzero(far_edge[number + 1] > far_edge[number]).tolist():
                whole = texts[number[i]]
                for w in far_window[far_edge[number[i]] : far_edge[number[i] + 1]].tolist():
                    rows.append((block, None, None, None, None, first + i, w, int(owner[number[i]]), whole[w : w + width]))
        return _table(rows, _ANSWERS)

    def cut(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table([pa.array([], f.type) for f in _OUT_KIND], schema=_OUT_KIND)
        ids, texts, block, held = _block_of(table, answers, width, anchor)
        kept, number, contents = block.distinct_segments(held)
        order = np.array([NULL_ID if i is None else i for i in ids], np.int64)
        told = answers.filter(pc.is_valid(answers["owner"]))
        segment, begin, stop = (np.concatenate([np.empty(0, np.int32), *_raw(told[c], np.int32)]) for c in ("segment", "begin", "stop"))
        holder = np.concatenate([np.empty(0, np.int64), *_raw(told["owner"], np.int64)])
        by = np.argsort(segment, kind="stable")
        edge = np.searchsorted(segment[by], np.arange(len(contents) + 1))
        times = edge[number + 1] - edge[number]
        pick = by[np.arange(times.sum()) + np.repeat(edge[number] - (np.cumsum(times) - times), times)]
        place, reader = np.repeat(block.at[kept], times), np.repeat(order[block.doc[kept]], times)
        goes = holder[pick] < reader
        change = np.zeros(len(block.data) + 1, np.int64)
        np.add.at(change, (place + begin[pick])[goes], 1)
        np.add.at(change, (place + stop[pick])[goes] + width - 1, -1)
        gone = np.cumsum(change[:-1]) > 0
        data = np.frombuffer(block.data, np.uint8)
        spans, left = [], []
        for a, b, text in zip(block.starts.tolist(), block.ends.tolist(), texts):
            mark = gone[a:b]
            if not mark.any():
                spans.append([])
                left.append(text)
                continue
            edges = np.flatnonzero(np.diff(np.concatenate([[False], mark, [False]]).astype(np.int8))).tolist()
            spans.append([{"start": x, "stop": y} for x, y in zip(edges[::2], edges[1::2])])
            left.append(data[a:b][~mark].tobytes())
        return pa.table([pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.array(spans, _OUT_KIND[2].type), pa.array(left, pa.binary())], schema=_OUT_KIND)

    bits = stored(texts.groupBy("block").applyInArrow(names, _NAMES).groupBy("shard").applyInArrow(shared, _BITS), "repeat-names")
    sent = texts.groupBy("block").cogroup(bits.groupBy("block")).applyInArrow(segments, _SEGMENTS)
    found = stored(sent.groupBy("shard").applyInArrow(answers, _ANSWERS), "repeat-answers")
    near = found.filter("owner IS NOT NULL").select("block", "segment", "begin", "stop", "owner")
    far = found.filter("far_window IS NOT NULL")
    least = far.groupBy("far_window").agg(F.min("far_owner").alias("least"))
    far = far.join(least, "far_window").select("block", *_packed_far())
    told = bits.unionByName(near.unionByName(far), allowMissingColumns=True)
    return texts.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(cut, _OUT)


_OUT_KIND = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), ("kept", pa.binary())])


def _little(column, digits: int):
    """A whole number as little-endian bytes."""
    shifts = [F.lpad(F.hex(F.shiftright(column, 8 * i).bitwiseAND(F.lit(255))), 2, "0") for i in range(digits)]
    return F.unhex(F.concat(*shifts))


def _packed_far():
    """Answers about single windows in the form of the others."""
    return (
        _little(F.col("far_segment"), 4).alias("segment"),
        _little(F.col("far_begin"), 4).alias("begin"),
        _little(F.col("far_begin") + 1, 4).alias("stop"),
        _little(F.col("least"), 8).alias("owner"),
    )
