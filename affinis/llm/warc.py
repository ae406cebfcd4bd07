"""WARC archives packed in ZIP files, read by ranges without extraction; duplicate payloads are written as revisits.

Writing. Each task writes packages of up to ``PACKAGE_RECORDS`` records: ZIP files with the stored (not compressed) members ``archive/data.warc.gz``, whose
records are gzip members of their own, and ``indexes/index.cdx``, one line a record: target, archive member, offset and length in
it. Of the records of one payload, that of the largest id is a response and holds it; the others are revisits, which name
the response, its digest and the length of the payload, and hold none.

Reading. A package is opened at its end: the end record of the central directory, or the ZIP64 one that a locator points to, gives the
directory; its entries, with 64-bit sizes and offsets from their ZIP64 fields, give the members. Members must be stored, so a record
is a range of the package: start of the member's data plus the offset from the index. The index lines are dealt over the tasks, and
each record is read by its range alone, inflated, parsed and checked against its digest.

Defined results. A null or empty payload has no bytes and is a payload like others. Records of equal ids and payloads: one of them (by a stored row
number) is the response. Null ids are below all others; the ``refers_to`` of a revisit whose response has no id is null. Extra
columns don't matter. An empty table writes no package and gives no rows. Packages are named by tasks; the table of packages holds
those of tasks that ended well, so a task that ran twice leaves at most a file that nothing refers to.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinis.operators.staging import materialize, staging_root

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
DATE = "2000-01-01T00:00:00Z"
SMALLEST = 0
RANGE_BYTES = 16 << 20
ROWS_AT_ONCE = 256
PACKAGE_RECORDS = 100_000
TAIL = 1 << 16
INDEX_CHUNK = 1 << 20

# fixed values of the ZIP format: signatures and marks
LOCAL, CENTRAL, END, END64, LOCATOR64 = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
MARK32, MARK16, EXTRA64 = 0xFFFFFFFF, 0xFFFF, 0x0001


def place(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder that all executors share, whatever store it is in."""
    return (pafs.LocalFileSystem(), uri) if uri.startswith("/") else pafs.FileSystem.from_uri(uri)


def digest_of(payload: bytes) -> str:
    """Upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- ZIP directories

@dataclass(frozen=True)
class Member:
    """A stored file in a package: where its local header is, and its size."""

    name: str
    header: int
    size: int


def _wide(extra: bytes, size: int, packed: int, header: int) -> tuple[int, int, int]:
    """Sizes and offset of a directory entry: those that don't fit into 32 bits are in its ZIP64 field, in this order."""
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<HH", extra, at)
        if kind == EXTRA64:
            body, k = extra[at + 4: at + 4 + length], 0
            values = [size, packed, header]
            for i in range(3):
                if values[i] == MARK32:
                    values[i] = struct.unpack_from("<Q", body, k)[0]
                    k += 8
            return values[0], values[1], values[2]
        at += 4 + length
    return size, packed, header


def directory(source) -> list[Member]:
    """The members of a ZIP package, from its end; only the end records and the central directory are read.

    ``source`` has ``size()`` and ``read_at(bytes, offset)``. Compressed or encrypted members are an error, since they have no ranges.
    """
    length = source.size()
    start = max(0, length - TAIL - 22)
    tail = source.read_at(length - start, start)
    at = tail.rfind(END)
    while at >= 0:
        # a comment may hold the mark, too; the right one ends where the file ends
        if at + 22 <= len(tail) and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] == len(tail):
            break
        at = tail.rfind(END, 0, at)
    if at < 0:
        raise ValueError("no end record: not a ZIP file, or cut short")
    entries, size, offset = struct.unpack_from("<HII", tail, at + 10)
    if at + start >= 20 and (entries == MARK16 or MARK32 in (size, offset)):
        locator = source.read_at(20, start + at - 20)
        if locator[:4] == LOCATOR64:
            record = source.read_at(56, struct.unpack_from("<Q", locator, 8)[0])
            if record[:4] != END64:
                raise ValueError("the ZIP64 locator points to no end record")
            entries, size, offset = struct.unpack_from("<QQQ", record, 32)
    listing, found, at = source.read_at(size, offset), [], 0
    for _ in range(entries):
        if listing[at: at + 4] != CENTRAL:
            raise ValueError("the central directory is broken")
        flags, method = struct.unpack_from("<HH", listing, at + 8)
        packed, whole = struct.unpack_from("<II", listing, at + 20)
        n_name, n_extra, n_comment = struct.unpack_from("<HHH", listing, at + 28)
        header = struct.unpack_from("<I", listing, at + 42)[0]
        name = listing[at + 46: at + 46 + n_name].decode()
        extra = listing[at + 46 + n_name: at + 46 + n_name + n_extra]
        whole, packed, header = _wide(extra, whole, packed, header)
        if not name.endswith("/"):
            if method or flags & 1:
                raise ValueError(f"{name} is not stored as it is")
            found.append(Member(name, header, whole))
        at += 46 + n_name + n_extra + n_comment
    return found


def data_start(source, member: Member) -> int:
    """Offset of a member's first byte: after its local header, whose lengths may differ from the directory's."""
    head = source.read_at(30, member.header)
    if head[:4] != LOCAL:
        raise ValueError(f"no local header of {member.name}")
    return member.header + 30 + sum(struct.unpack_from("<HH", head, 26))


# --- records

def _line(value: str | None) -> str:
    """A header's value in one line."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value or "")


def record(name: str, url: str | None, digest: str, size: int, payload: bytes | None, refers_to: str | None = None,
           date: str = DATE) -> bytes:
    """A WARC record as a gzip member: a response with its payload, or a revisit (``payload`` None) of the record ``refers_to``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload or b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{name}>",
            f"WARC-Date: {date}", f"WARC-Target-URI: {_line(url)}", f"WARC-Payload-Digest: sha1:{digest}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    raw = "\r\n".join(head).encode() + block + b"\r\n\r\n"
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def urn(target: str | None, digest: str, suffix: str | int | None = None) -> str:
    """Name of a record: its target (hexadecimal, since it may hold anything; ``-``: null), digest, and what tells equal ones."""
    return f"urn:x-record:{_written(target)}:{digest}" + (f":{suffix}" if suffix is not None else "")


def target_of(name: str) -> str | None:
    """The target that a record's name holds."""
    found = name.strip("<>").split(":")[2]
    return None if found == "-" else bytes.fromhex(found[1:]).decode()


def _written(target: str | None) -> str:
    return "-" if target is None else "=" + target.encode().hex()


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and block of an inflated WARC record."""
    head, split, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not split or not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    length = int(fields["content-length"])
    if len(rest) < length:
        raise ValueError("a WARC record is cut short")
    return fields, rest[:length]


def payload_of(fields: dict[str, str], block: bytes) -> tuple[int, str]:
    """Length and digest of a record's full payload; a response's are taken from its bytes and held against its headers."""
    http, _, payload = block.partition(b"\r\n\r\n")
    told = next(int(v) for k, _, v in (x.partition(b":") for x in http.split(b"\r\n")) if k.strip().lower() == b"content-length")
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    if fields["warc-type"] == "response" and (len(payload), digest_of(payload)) != (told, digest):
        raise ValueError(f"the payload of {fields['warc-record-id']} differs from its digest")
    return told, digest


# --- tables

def _order(column: Column) -> Column:
    """Sorts null below all values."""
    return F.struct(column.isNotNull().alias("there"), column.alias("id"))


def plan_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html",
                 smallest: int = SMALLEST) -> tuple[DataFrame, DataFrame]:
    """``(responses, revisits)``: ``page_id, url`` with ``payload``, or with ``row, size, sha1`` and the response's id ``ref_id``.

    ``named`` tells responses that revisits refer to. Only keys and lengths are stored. Payloads are told by their SHA-256; those of
    fewer than ``smallest`` bytes are all responses.
    """
    data = F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary")
    mark = F.xxhash64(F.col(page_id), F.col(page_id).isNull(), F.col(url), F.col(url).isNull())
    keyed = pages.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"), data.alias("payload"),
                         F.unhex(F.sha2(data, 256)).alias("key"), mark.alias("mark"))
    # numbers are taken from the stored rows, so they stay the same however often these are read
    keys = materialize(keyed.select("page_id", "url", "key", "mark", F.octet_length("payload").cast("long").alias("size"),
                                    F.sha1("payload").alias("sha1")), "page-keys")
    keys = materialize(keys.withColumn("row", F.monotonically_increasing_id()), "page-rows")
    large = keys.where(F.col("size") >= smallest)
    # rows of one payload, id and address first: these can't be told apart when payloads are read again
    alike = large.groupBy("key", "page_id", "mark").agg(F.max("row").alias("row"), F.count(F.lit(1)).alias("alike"))
    best = alike.groupBy("key").agg(F.max(F.struct(_order(F.col("page_id")).alias("order"), "row", "mark", "alike")).alias("best"),
                                    F.sum("alike").alias("rows")).where("rows > 1")
    best = materialize(best.select("key", F.col("best.order.id").alias("ref_id"), F.col("best.row").alias("ref_row"),
                                   F.col("best.mark").alias("ref_mark"), F.col("best.alike").alias("ref_alike")), "repeated-payloads")
    revisits = keys.join(best, "key").where(F.col("row") != F.col("ref_row")).select(
        "row", "page_id", "url", "size", "sha1", "ref_id")
    columns = ["key", "page_id", "url", "payload"]
    if best.isEmpty():
        return keyed.select(*columns, F.lit(False).alias("named")), revisits
    # payloads travel once, to be held against the repeated ones
    told = keyed.join(best, "key", "left").where(F.col("ref_row").isNull() | (
        F.col("page_id").eqNullSafe(F.col("ref_id")) & (F.col("mark") == F.col("ref_mark"))))
    named = F.col("ref_row").isNotNull().alias("named")
    if best.where("ref_alike > 1").isEmpty():
        return told.select(*columns, named), revisits
    several = F.coalesce("ref_alike", F.lit(1)) > 1
    one = told.where(several).groupBy("key").agg(*[F.first(c).alias(c) for c in columns[1:]], F.lit(True).alias("named"))
    return told.where(~several).select(*columns, named).unionByName(one), revisits


class PackageWriter:
    """One package: records are added, and closing it writes the index and the directory."""

    def __init__(self, folder: str):
        fs, root = place(folder)
        fs.create_dir(root, recursive=True)
        self.name = f"package-{uuid.uuid4().hex}.zip"
        self.stream = fs.open_output_stream(f"{root}/{self.name}")
        self.package = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED)
        self.member = self.package.open(ARCHIVE, "w", force_zip64=True)
        self.lines: list[bytes] = []
        self.offset = 0

    def add(self, target: str | None, raw: bytes) -> None:
        self.member.write(raw)
        self.lines.append(f"{_written(target)} {ARCHIVE} {self.offset} {len(raw)}\n".encode())
        self.offset += len(raw)

    def close(self) -> pa.RecordBatch:
        """The row of the table of packages."""
        self.member.close()
        with self.package.open(INDEX, "w", force_zip64=True) as index:
            index.write(b"".join(self.lines))
        self.package.close()
        self.stream.close()
        return pa.RecordBatch.from_pydict({"package": [self.name], "records": [len(self.lines)]})


def write_packages(pages: DataFrame, folder: str, package_records: int = PACKAGE_RECORDS, **options) -> DataFrame:
    """Write the packages of all rows to ``folder`` (a path or URI that all executors reach); ``(package, records)``, stored."""
    responses, revisits = plan_records(pages, **options)
    rows = responses.drop("key").unionByName(revisits, allowMissingColumns=True)
    rows = rows.withColumns({c: F.col(c).cast("string") for c in ("page_id", "ref_id")})

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package = None
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS_AT_ONCE):
                for row in batch.slice(k, ROWS_AT_ONCE).to_pylist():
                    package = package or PackageWriter(folder)
                    package.add(row["page_id"], _record_of(row))
                    if len(package.lines) == package_records:
                        yield package.close()
                        package = None
        if package:
            yield package.close()

    return materialize(rows.mapInArrow(write, "package string, records long"), "packages")


def _record_of(row: dict) -> bytes:
    if row["payload"] is not None:
        digest = digest_of(row["payload"])
        name = urn(row["page_id"], digest, None if row["named"] else uuid.uuid4().hex)
        return record(name, row["url"], digest, len(row["payload"]), row["payload"])
    digest = base64.b32encode(bytes.fromhex(row["sha1"])).decode()
    return record(urn(row["page_id"], digest, row["row"]), row["url"], digest, row["size"], None, urn(row["ref_id"], digest))


def index_lines(packages: DataFrame, folder: str) -> DataFrame:
    """``(package, start, length)`` of every record in the packages named by ``packages (package)``, from their indexes."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = place(folder)
        for batch in batches:
            for name in batch.column("package").to_pylist():
                with fs.open_input_file(f"{root}/{name}") as source:
                    members, bases = {m.name: m for m in directory(source)}, {}
                    for path, index in members.items():
                        if not path.startswith("indexes/"):
                            continue
                        at, end, rest = data_start(source, index), index.size, b""
                        for k in range(0, end, INDEX_CHUNK):
                            full, _, rest = (rest + source.read_at(min(INDEX_CHUNK, end - k), at + k)).rpartition(b"\n")
                            found = [x.decode().split(" ") for x in full.split(b"\n") if x]
                            for archive in {x[1] for x in found} - set(bases):
                                bases[archive] = data_start(source, members[archive])
                            yield pa.RecordBatch.from_arrays([
                                pa.array([name] * len(found), pa.string()),
                                pa.array([bases[x[1]] + int(x[2]) for x in found], pa.int64()),
                                pa.array([int(x[3]) for x in found], pa.int64())], names=["package", "start", "length"])

    return packages.select("package").repartition("package").mapInArrow(read, "package string, start long, length long")


def read_records(packages: DataFrame, folder: str, kind: str = "long", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` of every record, each read by its range."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = place(folder)
        name = source = None
        for batch in batches:
            out = []
            for at in batch.to_pylist():
                if at["package"] != name:
                    if source is not None:
                        source.close()
                    name, source = at["package"], fs.open_input_file(f"{root}/{at['package']}")
                fields, block = parse(zlib.decompress(source.read_at(at["length"], at["start"]), 31))
                size, digest = payload_of(fields, block)
                target, refers_to = (target_of(fields[k]) if k in fields else None for k in ("warc-record-id", "warc-refers-to"))
                out.append((target, size, digest, fields["warc-type"], refers_to))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(
                (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()))], names=names)
        if source is not None:
            source.close()

    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    lines = index_lines(packages, folder)
    # neighbours are read by one task, and a large package by several
    dealt = lines.repartition("package", F.call_function("div", F.col("start"), F.lit(range_bytes).cast("long")))
    found = dealt.sortWithinPartitions("package", "start").mapInArrow(
        read, "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string")
    return found.withColumns({c: F.col(c).cast(kind) for c in ("page_id", "refers_to")})


def archived(pages: DataFrame, folder: str | None = None, page_id: str = "page_id", **options) -> DataFrame:
    """Write the packages (to a new folder in the shared one, if none is given) and read every record back from them."""
    folder = folder or f"{staging_root(pages.sparkSession)}/affinis/warc-{uuid.uuid4().hex}"
    kind = pages.schema[page_id].dataType.simpleString()
    return read_records(write_packages(pages, folder, page_id=page_id, **options), folder, kind)
