"""WARC archives: pages written as records, whole-file gzip streams normalised record by record.

1. Spark writes every page as one WARC record into gzip streams that run over a whole file.
2. The normaliser inflates each such stream once, front to back, writes every record as a gzip
   member of its own and next to the archive a sidecar index of the members' offsets.
3. Records are read back through the index, member by member.

Records are copied through in pieces, so a normalising task holds one piece and one header, however
long the archive or a record is; reading back holds one record. A file appears under its final name only when it is complete, and a repeated
task writes the same bytes again, so lost executors do no harm. Archives lie in the shared work
folder, opened by ``pyarrow.fs`` (local or mounted folders, HDFS, S3, GCS); pages are read by Spark.

Defined results
---------------
* null html is an empty payload; a null or empty url leaves out the target; line breaks and other
  control characters of a url are percent-encoded
* equal payloads of at least ``revisit_from`` bytes: the largest page id is the response, others
  revisit it; smaller payloads are always responses
* rows repeated as a whole: each is a record; those that carry the response's id are responses
* ids keep all 64 bits; a null page id never is the response of a group that has another id; it comes back as null
* other columns are not read; empty pages give no archives and an empty result
"""

from __future__ import annotations

import contextlib
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakevault.llm.common import arrow_batches, arrow_rows, stored
from lakevault.session import work_folder

PIECE = 1 << 20
LEVEL = 6
REVISIT_FROM = 1000

# fixed values of the format
END = "\r\n\r\n"
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _line(name: str, value: Column) -> Column:
    """A header line; none for a null value."""
    return F.coalesce(F.concat(F.lit(f"\r\n{name}: "), value.cast("string")), F.lit(""))


def _target(url: Column) -> Column:
    clean = url
    for code in [*range(0x20), 0x20, 0x7F]:
        clean = F.replace(clean, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    odd = url.rlike(r"[\x00-\x20\x7f]")
    return F.when(url != "", F.when(odd, clean).otherwise(url))


def page_records(pages: DataFrame, date: str = "2024-01-01T00:00:00Z", revisit_from: int = REVISIT_FROM) -> DataFrame:
    """One row per page, its WARC record as ``record``, without the closing empty lines."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("size", F.octet_length("payload")).withColumn("same", F.when(F.col("size") >= revisit_from, F.sha2("payload", 256)))
    keepers = rows.filter("same IS NOT NULL").groupBy("same").agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n")).filter("n > 1 AND keeper IS NOT NULL").drop("n")
    keepers = stored(keepers, "warc-keepers")
    joined = rows.join(keepers, "same", "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("keeper")), F.col("keeper"))
    revisit = refers.isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit(END))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    head = F.concat(
        F.lit(VERSION),
        _line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", _target(F.col("url"))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.sha1("payload"))),
        _line("X-Payload-Length", F.col("size")),
        _line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), refers.cast("string"), F.lit(">"))),
        _line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", F.octet_length("block")),
        F.lit(END),
    )
    return joined.withColumn("block", block).select(F.concat(head, F.col("block")).alias("record"))


def write_streams(records: DataFrame, folder: str) -> None:
    """Whole-file gzip streams of records; the record end of the format is the writer's line end."""
    records.select("record").write.option("lineSep", END).option("compression", "gzip").text(folder)


def _open_fs(uri: str):
    from pyarrow import fs

    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", re.sub(r"^file:/+", "file:///", uri)))


@contextlib.contextmanager
def _published(uri: str) -> Iterator[BinaryIO]:
    """A stream into a file that takes its name when it is complete."""
    fs, path = _open_fs(uri)
    folder, _, name = path.rpartition("/")
    fs.create_dir(folder, recursive=True)
    draft = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with fs.open_output_stream(draft, compression=None) as out:
        yield out
    fs.move(draft, path)


def _header(stream: io.BufferedReader) -> bytes | None:
    """The header with its closing empty line; None at the end of the archive."""
    lines = []
    while True:
        line = stream.readline()
        if not line:
            if lines:
                raise ValueError("the archive ends inside a header")
            return None
        if line == b"\r\n":
            if lines:
                return b"".join(lines) + line
            continue
        lines.append(line)


def _fields(header: bytes) -> dict[str, str]:
    first, *lines = header.decode("utf-8", "replace").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError(f"no WARC record begins with {first[:40]!r}")
    return {name.strip().lower(): value.strip() for name, _, value in (x.partition(":") for x in lines if x)}


def normalise(source: str, target: str, level: int = LEVEL) -> tuple[int, int]:
    """Rewrite one archive member by member, with ``target.idx`` beside it: records and bytes."""
    fs, path = _open_fs(source)
    count = offset = 0
    with fs.open_input_stream(path, compression=None) as raw, _published(target) as out, _published(f"{target}.idx") as index:
        stream = io.BufferedReader(gzip.GzipFile(fileobj=raw, mode="rb"), PIECE)
        while (header := _header(stream)) is not None:
            fields = _fields(header)
            left, begun = int(fields["content-length"]), offset
            packer = zlib.compressobj(level, zlib.DEFLATED, 31)
            offset += out.write(packer.compress(header))
            while left:
                if not (piece := stream.read(min(left, PIECE))):
                    raise ValueError(f"{source} ends inside a record")
                left -= len(piece)
                offset += out.write(packer.compress(piece))
            if stream.read(4) != b"\r\n\r\n":
                raise ValueError(f"a record of {source} is not closed")
            offset += out.write(packer.compress(b"\r\n\r\n") + packer.flush())
            index.write(f"{begun}\t{offset - begun}\t{fields['warc-type']}\t{fields['warc-record-id']}\n".encode())
            count += 1
    return count, offset


def _files(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """Paths of files, packed into tasks by their size; contents are not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path", "length")


def normalise_folder(spark: SparkSession, streams: str, archives: str, level: int = LEVEL) -> DataFrame:
    """Normalise every stream of a folder: ``(path, records, bytes)`` per archive."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path in frame["path"]:
                target = f"{archives}/{path.rpartition('/')[2].removesuffix('.gz').removesuffix('.txt')}.warc.gz"
                yield pd.DataFrame([(target, *normalise(path, target, level))], columns=["path", "records", "bytes"])

    return stored(_files(spark, streams, "*.gz").mapInPandas(work, "path string, records long, bytes long"), "warc-normalised")


def members(archive: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of every record, fetched by the sidecar index."""
    fs, path = _open_fs(archive)
    with fs.open_input_stream(f"{path}.idx", compression=None) as index, fs.open_input_file(path) as data:
        for line in io.BufferedReader(index):
            offset, length, kind, record_id = line.decode().rstrip("\n").split("\t")
            data.seek(int(offset))
            content = zlib.decompress(data.read(int(length)), 31)
            header, _, rest = content.partition(b"\r\n\r\n")
            fields = _fields(header)
            if (fields["warc-type"], fields["warc-record-id"]) != (kind, record_id):
                raise ValueError(f"the index of {archive} does not fit at {offset}")
            yield fields, rest[: int(fields["content-length"])]


def _page(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_records(spark: SparkSession, archives: str, with_payload: bool = False, batch: int = 500) -> DataFrame:
    """Every record of normalised archives; a response's size and digest come from its payload."""

    kinds = [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
    schema = pa.schema(kinds + [("payload", pa.binary())] * with_payload)

    def records(rows: Iterator[tuple]) -> Iterator[tuple]:
        for path, _ in rows:
            for fields, block in members(path):
                payload = block.partition(b"\r\n\r\n")[2]
                digest, size = fields["warc-payload-digest"].removeprefix("sha1:"), int(fields["x-payload-length"])
                if fields["warc-type"] == "response" and (hashlib.sha1(payload).hexdigest(), len(payload)) != (digest, size):
                    raise ValueError(f"a payload of {path} does not fit its digest")
                yield (_page(fields["warc-record-id"]), size, digest, fields["warc-type"], _page(fields.get("warc-refers-to")), *[payload] * with_payload)

    return _files(spark, archives, "*.warc.gz").mapInArrow(lambda b: arrow_batches(records(arrow_rows(b)), schema, batch), RECORD + ", payload binary" * with_payload)


def archive_pages(pages: DataFrame) -> str:
    """Write, normalise: the folder of the normalised archives and their indexes."""
    spark = pages.sparkSession
    streams, archives = work_folder(spark, "llm-warc-streams"), work_folder(spark, "llm-warc")
    write_streams(page_records(pages), streams)
    normalise_folder(spark, streams, archives)
    return archives
