import base64
import hashlib

import pytest

from factpanel.llm import warc
from factpanel.llm.common import new_path

EVIL = (
    "x WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.1\r\n"
)
ROWS = [
    (1, "u", "aé", "x"), (2, None, "aé", "x"), (3, "u\r\nWARC-Type: bad", EVIL, "x"), (4, "é", EVIL, "x"), (5, "u", "", "x"),
    (6, "u", None, "x"), (7, "u", "WARC/1.1\r\n", "x"), (8, "u", EVIL * 500, "x"), (9, "u", "z\r\n\r\n", "x"),
    (9, "u", "z\r\n\r\n", "x"), (9, "u", "z\r\n\r\n", "x"), (None, "u", "no id", "x"),
    (10, "u", EVIL + "WARC/1.1\r\n\r\n\r\nWARC/1.1\r\nContent-Length: 0\r\n\r\n\r\n\r\n", "x"),
    *[(100 + i, "u", f"p{i % 40}" * (i % 7), "x") for i in range(150)],
]
KINDS = "page_id long, url string, html string, kind string"


def expected():
    keep: dict = {}
    for page, _, html, _ in ROWS:
        keep[html or ""] = max(keep.get(html or "", -1), -1 if page is None else page)
    made, seen = [], set()
    for page, _, html, _ in ROWS:
        html = html or ""
        first = keep[html] == (-1 if page is None else page) and (page, html) not in seen
        seen.add((page, html))
        digest = base64.b32encode(hashlib.sha1(html.encode()).digest()).decode()
        made.append((page, len(html.encode()), digest, "response" if first else "revisit", None if first else keep[html]))
    return sorted(made, key=str)


@pytest.mark.parametrize(("files", "split"), [(1, "128m"), (3, "128m"), (2, "4k"), (1, "20k")])
def test_archives_tell_the_pages(spark, conf, files, split):
    conf(spark__sql__files__maxPartitionBytes=split, spark__sql__files__openCostInBytes="1k")
    pages = spark.createDataFrame(ROWS, KINDS).repartition(files)
    assert sorted(map(tuple, warc.write_and_read(pages).collect()), key=str) == expected()


def test_payloads_come_back(spark, conf):
    path = new_path(spark, "warc")
    warc.write_archives(spark.createDataFrame(ROWS, KINDS).repartition(2), path)
    conf(spark__sql__files__maxPartitionBytes="4k", spark__sql__files__openCostInBytes="1k")
    found = [r.payload for r in warc.read_payloads(spark, path).collect()]
    assert sorted(found) == sorted({html or "" for _, _, html, _ in ROWS})


@pytest.mark.parametrize(("first", "later"), [("4k", "128m"), ("128m", "4k")])
def test_splits_may_differ_between_reads(spark, conf, monkeypatch, first, later):
    """The archives are read twice; the second read may be split in another way."""
    path, read, reads = new_path(spark, "warc"), warc._segments, []
    warc.write_archives(spark.createDataFrame(ROWS, KINDS).repartition(2), path)
    conf(spark__sql__files__maxPartitionBytes=first, spark__sql__files__openCostInBytes="1k")

    def segments(spark, path):
        reads.append(path)
        if len(reads) > 1:
            spark.conf.set("spark.sql.files.maxPartitionBytes", later)
        return read(spark, path)

    monkeypatch.setattr(warc, "_segments", segments)
    found = warc.read_records(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert len(reads) == 2 and sorted(map(tuple, found), key=str) == expected()


def test_files_are_valid_archives(spark, tmp_path):
    path = f"{tmp_path}/warc"
    warc.write_archives(spark.createDataFrame(ROWS[:8], KINDS).coalesce(1), path)
    (file,) = [f for f in (tmp_path / "warc").iterdir() if f.name.startswith("part-")]
    data, at, n = file.read_bytes(), 0, 0
    while at < len(data):
        assert data[at : at + 10] == b"WARC/1.1\r\n"
        head, _, _ = data[at:].partition(b"\r\n\r\n")
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        at += len(head) + 4 + int(fields[b"Content-Length"])
        assert data[at : at + 4] == b"\r\n\r\n"
        at, n = at + 4, n + 1
    assert n == 8


def test_no_pages(spark):
    assert warc.write_and_read(spark.createDataFrame([], KINDS)).collect() == []


@pytest.mark.parametrize("end", ["\u0085", "\u2028", "\u2029", "\n", "\r", "\x0b", "\x0c"])
def test_line_ends_of_any_kind_in_a_url(spark, end):
    rows = [(1, "a", "one", "x"), (2, f"u{end}Content-Length: 1", "two", "x"), (3, "b", f"th{end}Content-Length: 1", "x"), (4, "c", "four", "x")]
    found = {r.page_id: r for r in warc.write_and_read(spark.createDataFrame(rows, KINDS).coalesce(1)).collect()}
    assert sorted(found) == [1, 2, 3, 4]
    for page, _, html, _ in rows:
        assert found[page].payload_bytes == len(html.encode())
        assert found[page].payload_digest == base64.b32encode(hashlib.sha1(html.encode()).digest()).decode()


def _archive(spark, tmp_path):
    path = f"{tmp_path}/warc"
    warc.write_archives(spark.createDataFrame(ROWS[:8], KINDS).coalesce(1), path)
    (file,) = [f for f in (tmp_path / "warc").iterdir() if f.name.startswith("part-")]
    for other in (tmp_path / "warc").iterdir():
        if other.name.endswith(".crc"):
            other.write_bytes(b"")
    data = file.read_bytes()
    return data, lambda changed: (tmp_path / "other.warc").write_bytes(changed), str(tmp_path / "other.warc")


def test_damaged_archives_raise(spark, tmp_path):
    data, put, path = _archive(spark, tmp_path)
    put(data)
    assert warc.read_records(spark, path).count() == 8
    for changed in (data[:-3], data[: len(data) // 2], b"x" + data, data + b"more", data.replace(b"Content-Length: 0", b"Content-Length: 2", 1)):
        put(changed)
        with pytest.raises(ValueError, match="end at"):
            warc.read_records(spark, path)
    put(data.replace("a\u00e9".encode(), b"xyz", 1))
    with pytest.raises(Exception, match="differs from the digest"):
        warc.read_records(spark, path).collect()
