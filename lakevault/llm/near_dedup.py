"""Near-duplicate documents by weighted MinHash drawn with darts.

A document is the weighted set of its five-word shingles, the weight being the count. Each shingle
owns a strip of an endless board (weight upwards, time onwards) on which darts lie at places hashed
from the shingle alone. A document sees the darts below its weight; each dart has a coordinate, and
the earliest dart of a coordinate is the document's sample there. Two documents agree on a coordinate
with the probability of their weighted Jaccard similarity. The board is thrown region by region (time
in growing steps, weight in doubling ones), each region's number of darts by one inverted Poisson
draw, until every coordinate of the document has its dart: few throws per shingle instead of one
per shingle and coordinate.

Samples are joined in bands. Documents with equal shingles are one node. In every bucket of a band
all nodes are compared with one leader (a star, never all pairs), by their exact weighted Jaccard
similarity, the leader being the node with the most company over all buckets. What is then connected
needs no more comparison; where a bucket still holds several components, the nodes outside its
largest component are compared, block by block, with all nodes of other components. So every pair of nodes that shares a bucket is either verified or already connected,
without a limit on the size of buckets.

Defined results
---------------
* words are runs of letters, digits and underscores in lower case; a text of fewer than five words
  is one shingle; null texts, empty ones and those without words are equal to each other
* a null id never names a class that has another id; ids may repeat; every row is judged by itself
* of a class the row with the smallest id stays, on ties the one with the smallest text hash; rows
  repeated as a whole are reduced to one
* other columns are not read; an empty table gives an empty result
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakevault.llm.common import compacted, stored, text_of, unused
from lakevault.llm.components import components
from lakevault.llm.shingles import mixed, shingle_hashes, word_hashes

BANDS, ROWS = 25, 8
SIMILARITY = 0.8
#: documents signed together hold about this many shingles
BATCH_SHINGLES = 150_000
#: nodes of a bucket compared together
BLOCK = 64
#: the first step of time; steps double up to the last one
FIRST_STEP, LAST_STEP = 2.0**-6, 8.0
#: mean number of darts from which a region is thrown in parts
MOST_MEAN = 50

SKETCH = "row long, doc_id long, text_hash long, digest binary, n long, bands array<long>, shingles binary"


def _uniform(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(11)) * (1.0 / 2**53)


def _salted(h: np.ndarray, *salts: int) -> np.ndarray:
    for salt in salts:
        h = mixed(h ^ np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64))
    return h


def _poisson(u: np.ndarray, mean: float) -> np.ndarray:
    """Counts of Poisson draws by inversion at uniform numbers."""
    p = c = np.exp(-mean)
    table = [c]
    while c < 1 - 2.0**-53 and len(table) < 200:
        p *= mean / len(table)
        c += p
        table.append(c)
    return np.searchsorted(np.array(table), u, side="right")


def dart_signatures(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, documents: int, coordinates: int) -> np.ndarray:
    """Samples (documents x coordinates) of weighted sets, given as flat arrays of their elements.

    Every document has an element of positive weight.
    """
    out = np.zeros((documents, coordinates), np.uint64)
    empty = np.ones(documents * coordinates, bool)
    missing = np.full(documents, coordinates)
    start, step, level = 0.0, FIRST_STEP, 0
    flat = out.reshape(-1)
    while len(owner):
        shift, low, high, which = 0, 0.0, 1.0, np.arange(len(owner))
        hits = []
        while len(which):
            parts = max(1, int(np.ceil(step * (high - low) / MOST_MEAN)))
            width = (high - low) / parts
            for part in range(parts):
                floor = low + part * width
                reached = which if part == 0 else which[weight[which] > floor]
                if not len(reached):
                    break
                base = _salted(element[reached], level, shift, *([part] if parts > 1 else []))
                count = _poisson(_uniform(base), step * width)
                thrown = np.repeat(np.arange(len(reached)), count)
                if len(thrown):
                    first = np.cumsum(count) - count
                    number = (np.arange(len(thrown)) - first[thrown]).astype(np.uint64)
                    dart = mixed(base[thrown] + (number + np.uint64(1)) * np.uint64(0xD1342543DE82EF95))
                    place = _salted(dart, 1)
                    seen = floor + _uniform(place) * width < weight[reached[thrown]]
                    hits.append((owner[reached[thrown[seen]]], dart[seen]))
            shift, low, high = shift + 1, high, high * 2
            which = which[weight[which] > low]
        if hits:
            doc, dart = (np.concatenate(x) for x in zip(*hits))
            at = doc * coordinates + (_salted(dart, 2) % np.uint64(coordinates)).astype(np.int64)
            new = empty[at]
            at, dart = at[new], dart[new]
            # the earliest dart of a coordinate is written last
            order = np.lexsort((dart, _uniform(_salted(dart, 3))))[::-1]
            flat[at[order]] = dart[order]
            places = np.unique(at)
            empty[places] = False
            missing -= np.bincount(places // coordinates, minlength=documents)
            if not missing.all():
                going = missing[owner] > 0
                owner, element, weight = owner[going], element[going], weight[going]
        start, level = start + step, level + 1
        if start >= step and step < LAST_STEP:
            step = start
    return out


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One key per band, distinct between bands."""
    out = np.empty((len(signatures), bands), np.uint64)
    for b in range(bands):
        key = np.full(len(signatures), b + 1, np.uint64)
        for r in range(rows):
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + signatures[:, b * rows + r])
        out[:, b] = key
    return out.view(np.int64)


def sketch(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One stored row per document: band keys, its shingles (32-bit, sorted, repeated), their digest."""
    import hashlib

    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("digest", pa.binary()), ("n", pa.int64()), ("bands", pa.list_(pa.int64())), ("shingles", pa.binary())])

    def signed(held: list, first: int) -> pa.RecordBatch:
        pairs = [np.unique(s, return_counts=True) for _, _, s in held]
        some = [i for i, (s, _) in enumerate(pairs) if len(s)]
        keys: list = [[]] * len(held)
        if some:
            element = np.concatenate([pairs[i][0] for i in some])
            weight = np.concatenate([pairs[i][1] for i in some]).astype(float)
            owner = np.repeat(np.arange(len(some)), [len(pairs[i][0]) for i in some])
            for i, k in zip(some, band_keys(dart_signatures(owner, element, weight, len(some), bands * rows), bands, rows)):
                keys[i] = k.tolist()
        digests = [hashlib.blake2b(s.tobytes() + c.astype("<i8").tobytes(), digest_size=16).digest() for s, c in pairs]
        ids, hashes, shingles = zip(*held)
        short = [np.sort((s >> np.uint64(32)).astype("<u4")).tobytes() for s in shingles]
        columns = [range(first, first + len(held)), ids, hashes, digests, [len(s) for s in shingles], keys, short]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, held, size = TaskContext.get().partitionId() << 33, [], 0
        for batch in batches:
            for doc_id, text_hash, text in zip(*batch.columns):
                shingles = shingle_hashes(word_hashes(text.as_py()))
                held.append((doc_id.as_py(), text_hash.as_py(), shingles))
                size += len(shingles) + 1
                if size >= BATCH_SHINGLES or len(held) == 1000:
                    yield signed(held, row)
                    row, held, size = row + len(held), [], 0
        if held:
            yield signed(held, row)

    text = text_of(text_col)
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    return stored(read.mapInArrow(work, SKETCH), "sketch")


def weighted_jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Similarity of two sorted arrays with repeats, as multisets."""
    x, nx = np.unique(a, return_counts=True)
    y, ny = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    common = int(np.minimum(nx[i], ny[j]).sum())
    return common / (len(a) + len(b) - common) if len(a) or len(b) else 1.0


def _similar(pairs: DataFrame, sketches: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``(a, b)`` whose exact similarity reaches ``similarity``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, left, right = batch.columns
            same = [weighted_jaccard(np.frombuffer(x.as_buffer(), "<u4"), np.frombuffer(y.as_buffer(), "<u4")) >= similarity for x, y in zip(left, right)]
            yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"]).filter(pa.array(same, pa.bool_()))

    left = sketches.select(F.col("row").alias("a"), F.col("shingles").alias("left"))
    right = sketches.select(F.col("row").alias("b"), F.col("shingles").alias("right"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return compacted(joined.mapInArrow(work, "a long, b long"), "similar")


def _near_sizes(similarity: float, one: str, other: str):
    """Sizes that could reach the similarity at all."""
    return F.least(one, other) >= F.lit(similarity) * F.greatest(one, other)


def node_links(nodes: DataFrame, sketches: DataFrame, similarity: float) -> DataFrame | None:
    """Roots of connected nodes: ``(node, root)``. ``nodes``: ``row, n, bands``, one per distinct text."""
    entries = compacted(nodes.select("row", "n", F.explode("bands").alias("key")), "band-entries")
    shared = entries.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    full = compacted(entries.join(shared, "key"), "band-buckets")
    # the leader of a bucket is its node with the most company: the original among its edited copies
    company = full.groupBy("row").agg(F.sum("members").alias("company"))
    full = compacted(full.drop("members").join(company, "row"), "band-company")
    leaders = full.groupBy("key").agg(F.max(F.struct("company", "row", "n")).alias("leader"))
    full = compacted(full.join(leaders, "key").select("key", "row", "n", F.col("leader.row").alias("leader"), F.col("leader.n").alias("leader_n")), "band-leaders")
    star = full.filter(F.col("row") != F.col("leader")).filter(_near_sizes(similarity, "n", "leader_n"))
    star = compacted(star.select(F.least("leader", "row").alias("a"), F.greatest("leader", "row").alias("b")).distinct(), "star")
    # The shingles of nodes that share a bucket at all are cut out once. These nodes are a share of the
    # corpus, so this is a merge join at every size, never a broadcast.
    asked = full.select("row").distinct().hint("merge")
    sketches = stored(sketches.select("row", "shingles").join(asked, "row", "left_semi"), "needed-shingles")
    linked = _similar(star, sketches, similarity)
    roots = components(linked)

    # buckets that hold more than one component: what is outside the largest meets all the others
    named = full.join(roots.select(F.col("node").alias("row"), "root"), "row", "left").select("key", "row", "n", F.coalesce("root", "row").alias("root"))
    named = compacted(named, "band-components")
    sizes = named.groupBy("key", "root").agg(F.count(F.lit(1)).alias("size"))
    largest = sizes.groupBy("key").agg(F.max(F.struct("size", "root")).alias("top"), F.count(F.lit(1)).alias("parts")).filter("parts > 1")
    apart = named.join(largest.select("key", F.col("top.root").alias("main")), "key")
    return components(linked.union(_across(apart, sketches, similarity)))


def _across(apart: DataFrame, sketches: DataFrame, similarity: float) -> DataFrame:
    """Similar pairs between components of a bucket: ``apart`` has ``key, row, root, main``.

    Members are dealt into blocks of about ``BLOCK``, those outside the main component apart from those
    inside. A cell is a pair of blocks with at least one outside; shingles are sent once per cell, not
    once per pair, and a task holds one cell.
    """
    sizes = apart.groupBy("key").agg(*[F.ceil(F.count_if(c) / F.lit(BLOCK)).cast("int").alias(x) for x, c in (("outer", F.col("root") != F.col("main")), ("inner", F.col("root") == F.col("main")))])
    place = F.pmod(F.xxhash64("row"), F.greatest(F.when(F.col("root") == F.col("main"), F.col("inner")).otherwise(F.col("outer")), F.lit(1))).cast("int")
    dealt = apart.join(sizes, "key").withColumn("place", place)
    outer, inner = (F.sequence(F.lit(0), F.col(x) - 1) for x in ("outer", "inner"))
    of_main = F.transform(outer, lambda i: F.struct(F.lit(1).alias("kind"), i.alias("i"), F.col("place").alias("j")))
    of_outer = F.concat(
        F.transform(outer, lambda j: F.struct(F.lit(0).alias("kind"), F.least("place", j).alias("i"), F.greatest("place", j).alias("j"))),
        F.transform(inner, lambda j: F.struct(F.lit(1).alias("kind"), F.col("place").alias("i"), j.alias("j"))),
    )
    cells = dealt.select("key", "row", "root", "place", F.explode(F.when(F.col("root") == F.col("main"), of_main).otherwise(of_outer)).alias("cell"))
    sent = cells.join(sketches.select("row", "shingles"), "row").select("key", F.col("cell.kind").alias("kind"), F.col("cell.i").alias("i"), F.col("cell.j").alias("j"), "row", "root", "place", "shingles")

    def compared(members: list[tuple]) -> Iterator[tuple[int, int]]:
        """Pairs of one cell; two different blocks of the outside meet only each other."""
        kind, i, j = members[0][1:4]
        held = [(row, root, place, *np.unique(np.frombuffer(raw, "<u4"), return_counts=True)) for *_, row, root, place, raw in members]
        for at, (row, root, place, x, nx) in enumerate(held):
            total = nx.sum()
            for other, other_root, other_place, y, ny in held[at + 1 :]:
                if root == other_root or kind == 0 and i < j and place == other_place:
                    continue
                both = total + ny.sum()
                if min(total, ny.sum()) < similarity * max(total, ny.sum()):
                    continue
                _, p, q = np.intersect1d(x, y, assume_unique=True, return_indices=True)
                common = np.minimum(nx[p], ny[q]).sum()
                if common >= similarity * (both - common):
                    yield min(row, other), max(row, other)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members: list[tuple] = []
        for batch in batches:
            found = []
            for one in zip(*(c.to_pylist() for c in batch.columns)):
                if members and members[0][:4] != one[:4]:
                    found += compared(members)
                    members = []
                members.append(one)
            if found:
                yield _pairs(found)
        if members and (found := [*compared(members)]):
            yield _pairs(found)

    ordered = sent.repartition("key", "kind", "i", "j").sortWithinPartitions("key", "kind", "i", "j", "row")
    return compacted(ordered.mapInArrow(work, "a long, b long"), "similar-across")


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"])


def classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, text_hash, class_id, class_size, kept``.

    ``class_id`` is the smallest id of the class; ``kept`` marks the row that stays (and rows that
    repeat it as a whole).
    """
    sketches = sketch(docs)
    best = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    same = sketches.groupBy("digest").agg(F.min("row").alias("row"), F.min(best).alias("first"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    same = compacted(same, "distinct-sketches")
    roots = node_links(same.select("row", "n", "bands"), sketches, similarity)
    named = same.join(roots.withColumnRenamed("node", "row"), "row", "left").select("digest", "first", "copies", F.coalesce("root", "row").alias("root"))
    named = compacted(named, "named-sketches")
    groups = named.groupBy("root").agg(F.min("first").alias("keeper"), F.sum("copies").alias("class_size"))
    by_digest = named.select("digest", "root").join(groups, "root").drop("root")
    own = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    return sketches.select("doc_id", "text_hash", "digest").join(by_digest, "digest").select(
        "doc_id", "text_hash", F.col("keeper.doc_id").alias("class_id"), "class_size", own.eqNullSafe(F.col("keeper")).alias("kept")
    )


def keep_one(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row of every class, all columns as they are."""
    id_, kept_hash, own = (unused(docs, c) for c in ("kept_id", "kept_hash", "own_hash"))
    kept = compacted(classes(docs, similarity).filter("kept").select(F.col("doc_id").alias(id_), F.col("text_hash").alias(kept_hash)), "near-kept")
    marked = docs.withColumn(own, F.xxhash64(text_of()))
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col(own) == F.col(kept_hash))
    return marked.join(kept, same, "left_semi").dropDuplicates(["doc_id", own]).drop(own)
