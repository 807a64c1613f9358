r"""Secret scan with corpus-wide ownership frequency.

Every whole text is scanned once for secrets of known form (assignments, access keys, long hex) and
for further candidates: long runs that mix digits and letters. Each find carries a hash of its value.
The hashes are then counted over the whole corpus by distinct repository and owner. A repository is a
distinct text (whitespace aside), however many rows and owners have copies of it. A value is a copied
example if ``WIDE_REPOSITORIES`` repositories carry it, whoever owns them, or if several owners carry it
and none of them has all of its repositories; so a copy of a whole text does not make its values
examples. A value that is no example and looks random is live-looking. Known forms are always reported,
with that verdict; candidates are added to the spans only if they are live-looking. Both counts are
returned next to the spans, one number per span.

Counting is pre-aggregated on (value, owner, repository) before every shuffle, so a value that a third
of all documents carry arrives as a few rows. Finds join their counts by hash; Spark splits that join
if a value is hot. Texts are read once and never shuffled.

Spans are in code points, the end exclusive. Those of one kind are leftmost and do not overlap.

Defined results
---------------
* a null or empty text has no finds; a null owner counts as one more owner
* rows repeated as a whole give equal rows; rows of equal text count as one repository
* ids may repeat or be null: rows are told apart by a number given while scanning
* other columns are not read; an empty table gives an empty result
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakevault.llm.common import arrow_batches, arrow_rows, compacted, stored

# fixed values: the known forms and the least length of what they find
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_LEAST, ACCESS_LEAST = 8, 16
KINDS = ("assign", "access", "hex", "candidate")

#: further candidates: unbroken runs of at least this length that hold digits and letters
CANDIDATE = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}")
#: bits per character from which a value counts as random
RANDOM_BITS = 3.0
#: owners from which a value counts as a copied example, unless one of them has all its repositories
WIDE_OWNERS = 2
#: repositories from which a value counts as a copied example, also within one owner
WIDE_REPOSITORIES = 5

FOUND = "row long, doc_id long, owner string, repository long, n_assign long, n_access long, n_hex long, base_sha256 string, finds array<struct<start:int,kind:int,end:int,value:long,random:boolean>>"


def bits_per_character(value: str) -> float:
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) if n else 0.0


def _value(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def known_finds(text: str) -> list[tuple[int, int, int, str]]:
    """``(start, kind, end, value)`` of the known forms, by start and kind."""
    found = [(m.start(), 0, m.end(), m[1]) for m in ASSIGN.finditer(text) if len(m[1]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(found)


def candidate_finds(text: str, known: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    """Runs that mix digits and letters and touch no known find."""
    out, taken = [], iter([*known, (len(text) + 1, 0, len(text) + 1, "")])
    ahead, covered = next(taken), 0
    for m in CANDIDATE.finditer(text):
        value = m[0]
        if not (re.search(r"\d.*\d", value) and re.search(r"[A-Za-z].*[A-Za-z]", value)):
            continue
        while ahead[0] < m.end() and ahead[0] <= len(text):
            covered, ahead = max(covered, ahead[2]), next(taken)
        if covered <= m.start():
            out.append((m.start(), 3, m.end(), value))
    return out


def joined(finds: list[tuple]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end, *_ in finds)


def scan(docs: DataFrame, id_col: str = "doc_id", owner_col: str = "source", text_col: str = "text") -> DataFrame:
    """One stored row per document: counts and digest of the known forms, and all finds."""
    find = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("value", pa.int64()), ("random", pa.bool_())])
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("owner", pa.string()), ("repository", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base_sha256", pa.string()), ("finds", pa.list_(find))])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for row, (doc_id, owner, text) in enumerate(arrow_rows(batches), TaskContext.get().partitionId() << 33):
            known = known_finds(text)
            kinds = Counter(kind for _, kind, _, _ in known)
            finds = [
                {"start": start, "kind": kind, "end": end, "value": _value(value), "random": bits_per_character(value) >= RANDOM_BITS}
                for start, kind, end, value in known + candidate_finds(text, known)
            ]
            yield (row, doc_id, owner, _value(" ".join(text.split())) if finds else None, kinds[0], kinds[1], kinds[2], hashlib.sha256(joined(known).encode()).hexdigest(), finds)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return arrow_batches(found(batches), schema, 1000)

    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(owner_col).cast("string").alias("owner"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return stored(read.mapInArrow(work, FOUND), "secret-finds")


def ownership(finds: DataFrame) -> DataFrame:
    """``(value, repositories, owners, most)`` over the corpus, from rows ``(value, owner, repository)``.

    ``most`` is how many of the repositories the owner with most of them has.
    """
    places = finds.groupBy("value", "owner", "repository").agg(F.count(F.lit(1)).alias("n"))
    by_owner = places.groupBy("value", "owner").agg(F.count(F.lit(1)).alias("held"))
    owners = by_owner.groupBy("value").agg(F.count(F.lit(1)).alias("owners"), F.max("held").alias("most"))
    by_repository = finds.groupBy("value", "repository").agg(F.count(F.lit(1)).alias("n"))
    return by_repository.groupBy("value").agg(F.count(F.lit(1)).alias("repositories")).join(owners, "value")


def judge(found: DataFrame, wide_owners: int = WIDE_OWNERS, wide_repositories: int = WIDE_REPOSITORIES) -> DataFrame:
    """Every scanned row with ``spans``, their ``repositories`` and ``owners``, ``n_live`` and ``n_example``."""
    finds = found.select("row", "repository", "owner", F.explode("finds").alias("f"))
    finds = finds.select("row", "repository", "owner", "f.*")
    known = finds.select("row", "start", "kind", "end", "value", "random").join(ownership(finds), "value")
    example = (F.col("repositories") >= wide_repositories) | (F.col("owners") >= wide_owners) & (F.col("most") < F.col("repositories"))
    marked = known.withColumn("example", example).withColumn("live", F.col("random") & ~F.col("example"))
    per_row = marked.filter(F.col("live") | (F.col("kind") < KINDS.index("candidate"))).groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("start", "kind", "end", "repositories", "owners"))).alias("kept"),
        F.sum(F.col("live").cast("long")).alias("n_live"),
        F.sum(F.col("example").cast("long")).alias("n_example"),
    )
    per_row = compacted(per_row, "secret-spans")
    names = F.array(*[F.lit(k) for k in KINDS])
    text = F.transform("kept", lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")))
    spans = F.coalesce(F.array_join(text, ","), F.lit(""))
    rows = found.select("row", "doc_id", "n_assign", "n_access", "n_hex", "base_sha256").join(per_row, "row", "left")
    counts = [F.coalesce(F.concat_ws(",", F.col(f"kept.{c}").cast("array<string>")), F.lit("")).alias(c) for c in ("repositories", "owners")]
    counts += [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_live", "n_example")]
    return rows.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", spans.alias("spans"), *counts)


def scan_table(docs: DataFrame) -> DataFrame:
    return judge(scan(docs))
