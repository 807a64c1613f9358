"""A trie over the turns of conversations, held as a z-fast trie.

Conversations are strings whose symbols are turns. The name of a prefix is a 128-bit hash over the
name of the prefix before it and the next turn's role and text, so two conversations agree up to a
depth exactly when their names there agree. Equal conversations are one path with many members.

The trie is compacted: a node stands for its edge, the depths ``(top, length]``, and begins to differ
from others of its kind at ``length``, its extent. In a z-fast trie a node is found by its handle, the
name at the depth in ``(top, length]`` that the largest power of two divides. A fat binary search
probes the handles of a path at the likewise fattest depth of what is left of its range: a hit whose
extent is a prefix of the path raises the lower end to that extent, a hit whose extent is not ends the
search above that node, a miss lowers the upper end. So the place where a path leaves the trie is found
in log2(turns) probes, each one join over all paths of a batch.

Paths are put in by batches in the order of a hash, each ``GROWTH`` times what is there, the first of
``FIRST`` paths. New paths that leave at one edge are a group, and the group with the node it splits
becomes a few new nodes. As the paths that are there are a random sample, a group has about ``GROWTH``
paths times a logarithm, whatever conversations share.

Sums over subtrees go up the compacted trie by doubling: log2 of its height rounds. In the end every
edge is expanded to its depths.

Defined results
---------------
* null roles and texts are empty; null turns come first; equal turn numbers are ordered by role, then
  text; rows repeated as a whole are turns of their own
* rows with a null conversation id are no conversation
* conversations without turns (only where ``ids`` names them) end at the root; without any
  conversation there is no node
* very long texts are hashed whole; a conversation is one row of 20 bytes a turn; other columns are not read
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakevault.llm.common import arrow_batches, arrow_rows, row_count, stored

FIRST = 256
GROWTH = 32
NAME = 16
#: ids joined into one piece of the text that a digest is taken over
IDS_PER_PIECE = 4096

_PATH = "names array<binary>, chars array<int>"
_NODE = f"node binary, top int, length int, parent binary, edge binary, handle binary, {_PATH}, above long"
_KINDS = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "array<binary>": pa.list_(pa.binary()), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64())}
_ROOT = b""


def _kind(schema: str) -> pa.Schema:
    return pa.schema([(name, _KINDS[kind]) for name, kind in (c.split() for c in schema.split(", "))])


def fattest(low: int, high: int) -> int:
    """The number in ``(low, high]`` that the largest power of two divides."""
    return high & (-1 << ((low ^ high).bit_length() - 1))


def _fattest(low: str, high: str) -> Column:
    """``fattest`` of two columns."""
    kept = f"(length(bin(cast({low} ^ {high} as long))) - 1)"
    return F.expr(f"shiftleft(shiftright({high}, {kept}), {kept})")


def _name_at(depth: Column) -> Column:
    """The name of a path at a depth: empty at the root, null beyond its end."""
    return F.when(depth == 0, F.lit(_ROOT)).otherwise(F.get("names", depth - 1))


def _code_points(chars: str) -> Column:
    return F.expr(f"aggregate({chars}, 0L, (s, x) -> s + x)")


# --- conversations to paths ---


def _chained(rows: Iterator[tuple]) -> Iterator[tuple]:
    """``(conv_id, names, chars)`` of rows ``(conv_id, role, text)`` that come sorted; a null role is no turn."""
    key, names, chars, last = None, [], [], _ROOT
    for conv, role, text in rows:
        if conv != key:
            if key is not None:
                yield key, names, chars
            key, names, chars, last = conv, [], [], _ROOT
        if role is None:
            continue
        said = role.encode()
        last = hashlib.blake2b(last + len(said).to_bytes(8, "little") + said + text.encode(), digest_size=NAME).digest()
        names.append(last)
        chars.append(len(text))
    if key is not None:
        yield key, names, chars


def paths(turns: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """``conv_id, names, chars`` for ``turns(conv_id, turn, role, text)``; ``ids(conv_id)`` adds those without turns."""
    out = f"conv_id long, {_PATH}"
    rows = turns.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long"), F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    if ids is not None:
        rows = rows.unionByName(ids.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long")), allowMissingColumns=True)
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(lambda b: arrow_batches(_chained(arrow_rows(b)), _kind(out)), out)


# --- the trie ---


class _Path:
    """A new path, or an existing edge, below ``top``."""

    def __init__(self, names: list[bytes], chars: list[int], top: int):
        self.names, self.chars, self.top, self.length = names, chars, top, top + len(names)

    def name(self, depth: int) -> bytes:
        return self.names[depth - self.top - 1]


def _shared(a: _Path, b: _Path, low: int) -> int:
    """The depth down to which two paths agree; they do at ``low``."""
    high = min(a.length, b.length)
    while low < high:
        middle = (low + high + 1) // 2
        if a.name(middle) == b.name(middle):
            low = middle
        else:
            high = middle - 1
    return low


def grown(members: list[_Path], parent: bytes, above: int) -> Iterator[tuple]:
    """The nodes of all ``members``, which leave one node by one edge."""
    members = sorted(members, key=lambda p: p.names)
    open_ = [(0, len(members), members[0].top, parent, above)]
    while open_:
        a, b, top, parent, above = open_.pop()
        first = members[a]
        length = _shared(first, members[b - 1], top + 1)
        names, chars = (x[top - first.top : length - first.top] for x in (first.names, first.chars))
        node, below = names[-1], above + sum(chars)
        yield node, top, length, parent, names[0], first.name(fattest(top, length)), names, chars, above
        while a < b and members[a].length == length:
            a += 1
        while a < b:
            stop = a + 1
            while stop < b and members[stop].name(length + 1) == members[a].name(length + 1):
                stop += 1
            open_.append((a, stop, length, node, below))
            a = stop


def _insert(new: pa.Table, there: pa.Table) -> pa.Table:
    """The node of one edge, and what a batch makes of it."""
    if not new.num_rows:
        return there
    top, parent, above = (new[c][0].as_py() for c in ("top", "parent", "above"))
    members = [_Path(n, c, top) for t in (new, there) for n, c in zip(t["names"].to_pylist(), t["chars"].to_pylist())]
    rows = grown(members, parent, above)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _kind(_NODE))], schema=_kind(_NODE))


def locate(batch: DataFrame, nodes: DataFrame) -> DataFrame:
    """Fat binary search: ``batch`` with ``exit``, the depth of the deepest node whose extent it begins with."""
    longest = batch.agg(F.max(F.size("names"))).first()[0] or 0
    rounds = int(longest).bit_length()
    known = nodes.select("handle", "node", F.col("top").alias("node_top"), F.col("length").alias("node_length"))
    state = batch.withColumns({"exit": F.lit(0), "high": F.size("names")})
    for _ in range(rounds):
        # a finished path probes for its own end and ignores the answer
        depth = F.when(F.col("exit") < F.col("high"), _fattest("exit", "high")).otherwise(F.lit(0))
        state = state.withColumn("depth", depth).withColumn("probe", F.when(F.col("depth") > 0, _name_at(F.col("depth"))).otherwise(F.col("end")))
        hit = F.col("node").isNotNull() & (F.col("depth") > 0)
        begins = hit & (_name_at(F.col("node_length")) == F.col("node"))
        joined = state.join(known, F.col("probe") == F.col("handle"), "left")
        low = F.when(begins, F.col("node_length")).when(hit, F.col("node_top")).otherwise(F.col("exit"))
        high = F.when(begins | (F.col("depth") == 0), F.col("high")).when(hit, F.col("node_top")).otherwise(F.col("depth") - 1)
        state = joined.withColumns({"exit": low, "high": high}).select(*batch.columns, "exit", "high")
    return state


def build(distinct: DataFrame, first: int = FIRST, growth: int = GROWTH) -> DataFrame:
    """The nodes below the root over ``distinct(end, names, chars)``, paths of at least one turn, each once."""
    total = row_count(distinct)
    nodes = distinct.sparkSession.createDataFrame([], _NODE)
    spread = F.pmod(F.xxhash64("end"), F.lit(1 << 30))
    done = 0
    while done < 1 << 30:
        upto = min(1 << 30, -(-(first << 30) // max(1, total)) if not done else done * growth)
        batch = distinct.filter((spread >= done) & (spread < upto))
        found = locate(batch, nodes) if done else batch.withColumn("exit", F.lit(0))
        new = found.filter(F.size("names") > F.col("exit")).select(
            _name_at(F.col("exit") + 1).alias("edge"),
            F.col("exit").alias("top"),
            _name_at(F.col("exit")).alias("parent"),
            F.expr("slice(names, exit + 1, size(names))").alias("names"),
            F.expr("slice(chars, exit + 1, size(chars))").alias("chars"),
            _code_points("slice(chars, 1, exit)").alias("above"),
        )
        grown_ = new.groupBy("edge").cogroup(nodes.groupBy("edge")).applyInArrow(_insert, _NODE)
        nodes = stored(grown_, "trie")
        done = upto
    return nodes


_EDGE = "node binary, top int, parent binary, before array<long>, above long, own long"


def _edges(rows: Iterator[tuple]) -> Iterator[tuple]:
    for node, top, parent, chars, above in rows:
        sums = list(accumulate(chars, initial=0))
        yield node, top, parent, sums[:-1], above, sums[-1]


def subtree_sums(nodes: DataFrame) -> DataFrame:
    """``nodes(node, parent, members, least, chars_all, own, leaves)`` with each value over the whole subtree.

    After round k a value covers the descendants less than 2^k levels below, and ``parent`` is the
    ancestor 2^k levels above.
    """
    sums = {"members": F.sum, "least": F.min, "chars_all": F.sum, "own": F.sum, "leaves": F.sum}
    state = nodes.select("node", "parent", *sums)
    while True:
        state = stored(state, "trie-sums")
        linked = state.filter("parent IS NOT NULL")
        if not linked.limit(1).count():
            return state.drop("parent")
        below = linked.groupBy(F.col("parent").alias("node")).agg(*(f(c).alias(f"{c}_below") for c, f in sums.items()))
        up = state.select(F.col("node").alias("parent"), F.col("parent").alias("far"))
        # only what has a parent looks for its next one: roots would meet under one null key
        farther = linked.join(up, "parent", "left").select("node", F.col("far").alias("parent"), *sums).unionByName(state.filter("parent IS NULL"))
        both = farther.join(below, "node", "left")
        merged = [F.least(F.col(c), F.col(f"{c}_below")) if f is F.min else F.col(c) + F.coalesce(F.col(f"{c}_below"), F.lit(0)) for c, f in sums.items()]
        state = both.select("node", "parent", *(m.alias(c) for m, c in zip(merged, sums)))


def _pieces(rows: Iterator[tuple]) -> Iterator[tuple]:
    """``(end, first, text)``: the ids of sorted ``(end, conv_id)`` joined, piece by piece."""
    key, ids = None, []
    for end, conv in rows:
        if ids and (end != key or len(ids) == IDS_PER_PIECE):
            yield key, ids[0], ",".join(map(str, ids))
            ids = []
        key = end
        ids.append(conv)
    if ids:
        yield key, ids[0], ",".join(map(str, ids))


def _digests(rows: Iterator[tuple]) -> Iterator[tuple]:
    key, sha, any_ = None, hashlib.sha256(), False
    for end, text in rows:
        if any_ and end != key:
            yield key, sha.hexdigest()
            sha, any_ = hashlib.sha256(), False
        sha.update(("," if any_ else "").encode() + text.encode())
        key, any_ = end, True
    if any_:
        yield key, sha.hexdigest()


def end_digests(ends: DataFrame) -> DataFrame:
    """``(node, ends_sha256)``: the digest of the ascending ids that end at a node.

    A digest is sequential; the text under it is joined by ranges of ids first, so that the task of a
    conversation with very many copies reads a row per ``IDS_PER_PIECE`` of them.
    """
    piece, digest = pa.schema([("end", pa.binary()), ("first", pa.int64()), ("text", pa.string())]), pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())])
    ranged = ends.select("end", "conv_id").repartitionByRange("end", "conv_id").sortWithinPartitions("end", "conv_id")
    joined = ranged.mapInArrow(lambda b: arrow_batches(_pieces(arrow_rows(b)), piece), "end binary, first long, text string")
    ordered = joined.repartition("end").sortWithinPartitions("end", "first").select("end", "text")
    return ordered.mapInArrow(lambda b: arrow_batches(_digests(arrow_rows(b)), digest), "node binary, ends_sha256 string")


def trie(turns: DataFrame, ids: DataFrame | None = None, first: int = FIRST, growth: int = GROWTH) -> DataFrame:
    """One row per depth of every edge, root included: ``conv_id`` (smallest member), ``depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    ``saved_tokens`` are the code points that storing a shared turn once saves, over the subtree.
    """
    spark = turns.sparkSession
    every = stored(paths(turns, ids).withColumn("end", _name_at(F.size("names"))), "trie-paths")
    distinct = stored(every.filter("size(names) > 0").select("end", "names", "chars").dropDuplicates(["end"]), "trie-distinct")
    nodes = build(distinct, first, growth).select("node", "top", "parent", "chars", "above")
    below = nodes.mapInArrow(lambda b: arrow_batches(_edges(arrow_rows(b)), _kind(_EDGE)), _EDGE)
    if not every.isEmpty():
        below = below.unionByName(spark.createDataFrame([(_ROOT, -1, None, [0], 0, 0)], _EDGE))
    below = stored(below, "trie-edges")
    children = below.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("children"))
    ending = every.groupBy(F.col("end").alias("node")).agg(F.count(F.lit(1)).alias("members"), F.min("conv_id").alias("least"), F.sum(_code_points("chars")).alias("chars_all"))
    full = below.join(children, "node", "left").join(ending, "node", "left").select(
        "node", "top", "parent", "before", "above", "own", F.coalesce("children", F.lit(0)).cast("long").alias("children"),
        F.coalesce("members", F.lit(0)).cast("long").alias("members"), "least", F.coalesce("chars_all", F.lit(0)).cast("long").alias("chars_all"),
        F.when(F.col("children").isNull(), 1).otherwise(0).cast("long").alias("leaves"),
    )
    full = stored(full, "trie-nodes")
    summed = stored(subtree_sums(full), "trie-summed")
    shape = full.select("node", "top", "parent", "before", "above", "children")
    parents = summed.select(F.col("node").alias("parent"), F.col("least").alias("parent_least"))
    rows = shape.join(summed, "node").join(parents, "parent", "left").join(end_digests(every), "node", "left")
    deep = rows.select("*", F.posexplode("before").alias("step", "so_far"))
    last = F.col("step") == F.size("before") - 1
    return deep.select(
        F.col("least").alias("conv_id"),
        (F.col("top") + 1 + F.col("step")).cast("long").alias("depth"),
        F.when(F.col("step") > 0, F.col("least")).otherwise(F.col("parent_least")).alias("parent_conv_id"),
        F.col("members").alias("n_convs"),
        F.when(last, F.col("children")).otherwise(F.lit(1)).cast("long").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("chars_all") - F.col("members") * (F.col("above") + F.col("so_far")) - (F.col("own") - F.col("so_far"))).alias("saved_tokens"),
        F.when(last & F.col("ends_sha256").isNotNull(), F.col("ends_sha256")).otherwise(F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
