"""WARC: whole archives read back, single records by their offset, the odd cases."""

import gzip
import glob
import hashlib
import zlib

import pytest

from lakevault.llm import warc as op
from lakevault.session import work_folder

SCHEMA = "page_id long, url string, html string, record string, size int, same string"


def _rows():
    big = "<p>" + "same \r\n\r\nWARC/1.1\r\n" * 200
    rows = [(i, f"http://x/{i}", f"page {i} " + "é\U0001f600" * i, "x", 1, "y") for i in range(40)]
    rows += [(100 + i, "http://same", big, "x", 1, "y") for i in range(7)] + [(106, "http://same", big, "x", 1, "y"), (None, "http://same", big, "x", 1, "y")]
    rows += [(200, None, None, None, None, None), (201, "", "", "x", 1, "y"), (202, "a b\r\nWARC-Type: fake", "short", "x", 1, "y"), (203, "u", "short", "x", 1, "y"), (None, "u", "n" * 2000, "x", 1, "y"), (204, "u", "z" * 3_000_000, "x", 1, "y")]
    return rows + [(300, "u", "k" * 999, "x", 1, "y"), (301, "u", "k" * 999, "x", 1, "y"), (302, "u", "é" * 500, "x", 1, "y"), (303, "u", "é" * 500, "x", 1, "y")]


def _want(rows):
    out = []
    for page_id, _, html, *_ in rows:
        data = (html or "").encode()
        same = [r[0] for r in rows if (r[2] or "") == (html or "") and r[0] is not None]
        keeper = max(same) if same and len(data) >= 1000 else page_id
        revisit = keeper != page_id
        out.append((page_id, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", keeper if revisit else None))
    return sorted(out, key=repr)


def test_pages_read_back(spark):
    rows = _rows()
    archives = op.archive_pages(spark.createDataFrame(rows, SCHEMA).repartition(3))
    got = op.read_records(spark, archives, with_payload=True).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=repr) == _want(rows)
    texts = {r[0]: r[2] or "" for r in rows if r[0] is not None}
    assert all(r.payload.decode() == texts[r.page_id] for r in got if r.record_type == "response" and r.page_id is not None)
    seen = 0
    for path in glob.glob(f"{archives.removeprefix('file:')}/*.warc.gz"):
        whole, pieces = gzip.open(path).read(), b""
        raw = open(path, "rb").read()
        for line in open(path + ".idx"):
            offset, length, kind, record_id = line.rstrip("\n").split("\t")
            member = zlib.decompress(raw[int(offset) : int(offset) + int(length)], 31)
            assert member.startswith(b"WARC/1.1\r\n") and member.endswith(b"\r\n\r\n") and f"WARC-Record-ID: {record_id}".encode() in member
            head = member.split(b"\r\n\r\n")[0]
            assert head.count(b"WARC-Type") == 1 + (b"fake" in head)
            pieces += member
            seen += 1
        assert pieces == whole
    assert seen == len(rows)


def test_broken_streams_are_refused(spark, tmp_path):
    good = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\n"
    for name, data in (("cut", good[:-6]), ("open", good[:-4] + b"xxxx"), ("odd", b"HELLO\r\n\r\n")):
        path = tmp_path / f"{name}.gz"
        path.write_bytes(gzip.compress(data))
        with pytest.raises(ValueError):
            op.normalise(str(path), str(tmp_path / f"{name}.warc.gz"))
        assert not (tmp_path / f"{name}.warc.gz").exists()
    path = tmp_path / "two.gz"
    path.write_bytes(gzip.compress(good) + gzip.compress(good))
    assert op.normalise(str(path), str(tmp_path / "two.warc.gz"))[0] == 2


def test_empty_table(spark):
    assert op.read_records(spark, op.archive_pages(spark.createDataFrame([], SCHEMA))).collect() == []
