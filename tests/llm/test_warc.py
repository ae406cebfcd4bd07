"""Packages against zipfile and plain Python: directories, ranges, round trips, odd rows."""

import base64
import collections
import hashlib
import io
import random
import zipfile
import zlib

import pyarrow as pa
import pytest

from affinis.llm import warc

PAGES = "page_id long, url string, html string, payload string, key int, row int"


def package(members, comment=b"", method=zipfile.ZIP_STORED):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as z:
        for name, data in members.items():
            z.writestr(name, data)
        z.comment = comment
    return out.getvalue()


def read_back(raw):
    source = pa.BufferReader(raw)
    return {m.name: source.read_at(m.size, warc.data_start(source, m)) for m in warc.directory(source)}


MEMBERS = {"archive/a.warc.gz": b"x" * 1000, "indexes/é.cdx": b"", "datapackage.json": b"{}", "archive/b": bytes(range(256)) * 9}


@pytest.mark.parametrize("comment", [b"", b"a comment that holds PK\x05\x06 and more" + b"." * 40])
def test_directory_of_a_package(comment):
    assert read_back(package(MEMBERS, comment)) == MEMBERS
    assert read_back(b"something before" + package({})) == {}


def test_zip64_directory(monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 300)  # sizes and offsets above it go to the ZIP64 fields
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 3)
    raw = package(MEMBERS)
    assert warc.END64 in raw and warc.LOCATOR64 in raw
    assert read_back(raw) == MEMBERS


def test_broken_and_compressed_packages_are_errors():
    raw = package(MEMBERS)
    for bad in (b"", b"no zip", raw[:-1], raw[: len(raw) // 2]):
        with pytest.raises((ValueError, OSError)):
            warc.directory(pa.BufferReader(bad))
    with pytest.raises(ValueError):
        warc.directory(pa.BufferReader(package(MEMBERS, method=zipfile.ZIP_DEFLATED)))


def test_record_round_trip():
    for target in ("5", None, "a b:\r\n\x00é"):
        payload = "Été\r\n\r\nWARC/1.1\r\n".encode() * 50
        digest = warc.digest_of(payload)
        raw = zlib.decompress(warc.record(warc.urn(target, digest), "http://a/\r\nX: y", digest, len(payload), payload), 31)
        fields, block = warc.parse(raw)
        assert block.endswith(payload) and raw.endswith(b"\r\n\r\n") and "x" not in fields
        assert warc.target_of(fields["warc-record-id"]) == target
        assert warc.payload_of(fields, block) == (len(payload), digest)
        with pytest.raises(ValueError):
            warc.payload_of(fields, block.replace(b"W", b"V"))
    raw = zlib.decompress(warc.record(warc.urn("7", digest, 3), None, digest, 9, None, warc.urn("8", digest)), 31)
    fields, block = warc.parse(raw)
    assert fields["warc-type"] == "revisit" and warc.target_of(fields["warc-refers-to"]) == "8"
    assert warc.payload_of(fields, block) == (9, digest)


def brute(rows, smallest=0):
    best = {}
    for page_id, _, html, *_ in rows:
        key = html or ""
        best[key] = max(best.get(key, (False, 0)), (page_id is not None, page_id or 0))
    out, done = [], set()
    for page_id, _, html, *_ in rows:
        key = html or ""
        data = key.encode()
        mine = (page_id is not None, page_id or 0)
        first = len(data) < smallest or (mine == best[key] and key not in done)
        if mine == best[key]:
            done.add(key)
        refers = None if first or not best[key][0] else best[key][1]
        out.append((page_id, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if first else "revisit", refers))
    return collections.Counter(out)


def rows_of(n, seed):
    draw = random.Random(seed)
    rows = [(i, f"http://h/{i}", draw.choice([None, "", "<p>a</p>", f"<p>{i}</p>", "é" * draw.randrange(50)])) for i in range(n)]
    rows += [(3, "http://same", "<p>same</p>")] * 40 + [(None, None, "<p>only null ids</p>")] * 5 + [(None, "u", "<p>a</p>")] * 3
    rows += [(n + 1, f"http://{i}", "<p>a</p>") for i in range(3)] + [(900, "long", "<b>" + "long text " * 300_000)]
    return [(*r, "clash", 1, 2) for r in rows]


@pytest.mark.parametrize("smallest", [0, 9])
def test_records_read_back(spark, smallest, tmp_path):
    rows = rows_of(300, 1)
    df = spark.createDataFrame(rows, PAGES).repartition(4)
    got = warc.archived(df, f"{tmp_path}/w", smallest=smallest)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert collections.Counter(tuple(r) for r in got.collect()) == brute(rows, smallest)


def test_pages_without_repeats_and_no_pages(spark, tmp_path):
    rows = [(i, "u", f"<p>{i}</p>", "c", 1, 2) for i in range(50)]
    df = spark.createDataFrame(rows, PAGES)
    assert collections.Counter(tuple(r) for r in warc.archived(df, f"{tmp_path}/a").collect()) == brute(rows)
    assert warc.archived(df.limit(0), f"{tmp_path}/b").collect() == []


def test_packages_are_zip_files_and_ranges_hold_whole_records(spark, tmp_path):
    rows = rows_of(40, 2)
    packages = warc.write_packages(spark.createDataFrame(rows, PAGES).repartition(2), f"{tmp_path}/p", package_records=17)
    assert packages.agg({"records": "sum", "*": "count"}).first()["sum(records)"] == len(rows)
    assert packages.agg({"records": "max"}).first()[0] == 17 and packages.count() > len(rows) // 17
    for line in warc.index_lines(packages, f"{tmp_path}/p").collect():
        with open(f"{tmp_path}/p/{line.package}", "rb") as file:
            file.seek(line.start)
            assert warc.parse(zlib.decompress(file.read(line.length), 31))[0]["warc-date"] == warc.DATE
    for name in {r.package for r in packages.collect()}:
        with zipfile.ZipFile(f"{tmp_path}/p/{name}") as z:
            assert sorted(z.namelist()) == [warc.ARCHIVE, warc.INDEX] and z.testzip() is None
            assert {i.compress_type for i in z.infolist()} == {zipfile.ZIP_STORED}
