"""WARC records in ZIP packages: written by tasks, found by directory, read by range.

A package is a ZIP file with two members that are stored, not compressed: the records,
each one a gzip member of its own, and an index of JSON lines with the place of every
record inside the first. So a record is read by seeking to it, and no package is ever
unpacked or read from end to end.

Writing. Of records with equal payloads of at least ``min_bytes`` bytes, the one with
the smallest id is a response, the others are revisits that refer to it and carry the
header of the answer without its body. Payloads are grouped by hashes, on the map side
first; a payload that a thousandth of all rows share is matched by broadcast. Each task
streams its rows into packages of about ``package_bytes`` and names the finished ones; a
task that runs again writes files of other names, and only files named by tasks that
came to their end are read, so lost executors leave nothing behind but unread files.

Reading. For every package a task finds the end of the central directory from the last
bytes, follows the ZIP64 locator where numbers do not fit, walks the directory in
pieces, and skips the local headers to where stored members begin. Index members become
rows of record places, which are dealt out by stretches of ``RANGE_BYTES``; a task reads
the records of its stretch by ranges, neighbours in one request.

Folders are reached from tasks through ``pyarrow.fs`` (local or shared disks, s3, gs,
hdfs). The table of pages itself is read by Spark alone.

Defined cases: a null payload is empty, and empty payloads are equal to each other; a
null id sorts last and reads back as null; rows that repeat id and payload of a
response are responses too; a null address is left out; control characters, spaces and
everything else that an address cannot hold are percent-encoded in headers; an empty
table makes no package and reads back as an empty table; compressed members are listed
but not read, and a package whose records have no index, or that is cut off, ends the
job with its name; other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimflow.llm.common import BROADCAST_ROWS, join_counted
from claimflow.session import materialise, shared_dir

RECORDS, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PACKAGE_BYTES = 1 << 30
#: Bytes of records that one reading task takes in a row, and of one request.
RANGE_BYTES, REQUEST_BYTES = 64 << 20, 4 << 20
#: Bytes of a directory or an index read at once.
BLOCK_BYTES = 1 << 20
#: Bytes of payloads that leave a task in one batch.
BATCH_BYTES = 16 << 20
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
NO_ID = "urn:x-no-id:"
ID = "urn:x-id:"

# --- ZIP packages ---------------------------------------------------------------

LOCAL, CENTRAL, END, END64, LOCATOR, DESCRIPTOR = (
    b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x07\x08",
)
WIDE, WIDE_SHORT = 0xFFFFFFFF, 0xFFFF
#: Flags: sizes follow the data; names are UTF-8.
STREAMED, UTF8 = 0x0008, 0x0800
#: 1 January 1980, the first day a ZIP file knows.
FIRST_DAY = 0x21


class Package:
    """Writes a ZIP file of stored members to a stream that cannot go back."""

    def __init__(self, out: BinaryIO):
        self.out, self.at, self.members = out, 0, []
        self.name = b""

    def put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def open(self, name: str) -> None:
        self.name, self.head, self.crc = name.encode(), self.at, 0
        # sizes come behind the data, as 64-bit numbers, which the empty extra field announces
        extra = struct.pack("<HHQQ", 1, 16, 0, 0)
        self.put(LOCAL + struct.pack("<HHHHHIIIHH", 45, STREAMED | UTF8, 0, 0, FIRST_DAY, 0, WIDE, WIDE, len(self.name), len(extra)))
        self.put(self.name + extra)
        self.start = self.at

    def write(self, data: bytes) -> int:
        """Adds to the open member; returns the place inside it."""
        place = self.at - self.start
        self.crc = zlib.crc32(data, self.crc)
        self.put(data)
        return place

    def close_member(self) -> None:
        size = self.at - self.start
        self.put(DESCRIPTOR + struct.pack("<IQQ", self.crc, size, size))
        self.members.append((self.name, self.crc, size, self.head))

    def close(self, wide: bool = False) -> None:
        """The central directory; with 64-bit numbers where needed, or always if ``wide``."""
        start = self.at
        for name, crc, size, head in self.members:
            long = wide or size >= WIDE or head >= WIDE
            extra = struct.pack("<HHQQQ", 1, 24, size, size, head) if long else b""
            size, head = (WIDE, WIDE) if long else (size, head)
            fixed = struct.pack("<HHHHHHIIIHHHHHII", 45, 45, STREAMED | UTF8, 0, 0, FIRST_DAY, crc, size, size, len(name), len(extra), 0, 0, 0, 0, head)
            self.put(CENTRAL + fixed + name + extra)
        n, length, end = len(self.members), self.at - start, self.at
        long = wide or n >= WIDE_SHORT or start >= WIDE or length >= WIDE
        if long:
            self.put(END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, n, n, length, start))
            self.put(LOCATOR + struct.pack("<IQI", 0, end, 1))
            n, length, start = WIDE_SHORT, WIDE, WIDE
        self.put(END + struct.pack("<HHHHIIH", 0, 0, n, n, length, start, 0))


def _read_at(file, at: int, n: int) -> bytes:
    file.seek(at)
    return file.read(n)


def directory_of(file, size: int) -> tuple[int, int, int]:
    """Start, length and number of entries of the central directory."""
    tail_at = max(0, size - 22 - 0xFFFF)
    tail = _read_at(file, tail_at, size - tail_at)
    at = tail.rfind(END)
    while at >= 0 and (at + 22 > len(tail) or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
        at = tail.rfind(END, 0, at)  # the signature may stand in a comment
    if at < 0:
        raise ValueError("no end of a central directory")
    disk, first, _, entries, length, start = struct.unpack_from("<HHHHII", tail, at + 4)
    if WIDE_SHORT in (entries, disk, first) or WIDE in (length, start):
        locator = _read_at(file, tail_at + at - 20, 20)
        if locator[:4] == LOCATOR:
            record = _read_at(file, struct.unpack_from("<IQI", locator, 4)[1], 56)
            if record[:4] != END64:
                raise ValueError("no ZIP64 record where its locator points")
            _, _, _, _, _, _, entries, length, start = struct.unpack_from("<QHHIIQQQQ", record, 4)
            return start, length, entries
    if disk or first:
        raise ValueError("packages in several volumes are not read")
    return start, length, entries


def members_of(file, size: int) -> Iterator[dict]:
    """Name, method, size, CRC and first byte of all members, the directory read in pieces."""
    at, length, entries = directory_of(file, size)
    end, held = at + length, b""
    for _ in range(entries):
        need = 46
        while True:
            if len(held) >= 46:
                if held[:4] != CENTRAL:
                    raise ValueError("broken central directory")
                n, e, c = struct.unpack_from("<HHH", held, 28)
                need = 46 + n + e + c
            if len(held) >= need:
                break
            more = _read_at(file, at, min(max(BLOCK_BYTES, need), end - at))
            if not more:
                raise ValueError("central directory is cut off")
            at, held = at + len(more), held + more
        flags, method = struct.unpack_from("<HH", held, 8)
        crc, packed, whole = struct.unpack_from("<III", held, 16)
        head = struct.unpack_from("<I", held, 42)[0]
        name, extra, held = held[46 : 46 + n], held[46 + n : 46 + n + e], held[need:]
        while len(extra) >= 4:
            kind, m = struct.unpack_from("<HH", extra)
            if kind == 1:
                numbers = list(struct.unpack_from(f"<{m // 8}Q", extra, 4))
                # only the numbers that do not fit are there, in this order
                whole = numbers.pop(0) if whole == WIDE else whole
                packed = numbers.pop(0) if packed == WIDE else packed
                head = numbers.pop(0) if head == WIDE else head
            extra = extra[4 + m :]
        local = _read_at(file, head, 30)
        if local[:4] != LOCAL:
            raise ValueError("no local header where the directory points")
        n, e = struct.unpack_from("<HH", local, 26)
        yield {
            "member": name.decode("utf-8" if flags & UTF8 else "cp437"), "stored": method == 0 and not flags & 1,
            "start": head + 30 + n + e, "size": packed, "crc": crc,
        }


# --- WARC records ---------------------------------------------------------------


def base32_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def id_uri(value: str | None) -> str:
    return NO_ID if value is None else ID + urllib.parse.quote(value, safe="")


def uri_id(uri: str | None) -> str | None:
    return urllib.parse.unquote(uri[len(ID) :]) if uri is not None and uri.startswith(ID) else None


def header_uri(url: str) -> str:
    """An address as a header can hold it."""
    return urllib.parse.quote(url, safe="!#$%&'()*+,/:;=?@[]~")


def record(id_: str | None, url: str | None, payload: bytes, refers_to: str | None) -> tuple[bytes, dict]:
    """One WARC record, and what the index says of it."""
    digest = base32_digest(payload)
    kind = "response" if refers_to is None else "revisit"
    answer = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = answer if refers_to is not None else answer + payload
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{id_uri(id_)}>", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {header_uri(url)}")
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {SAME_PAYLOAD}", f"WARC-Refers-To: <{refers_to}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n", {"id": id_uri(id_), "type": kind, "digest": digest}


def _headers(data: bytes) -> tuple[str, dict[str, str], int]:
    """First line, fields in lower case, and where the rest begins."""
    end = data.find(b"\r\n\r\n")
    if end < 0:
        raise ValueError("a header has no end")
    first, *lines = data[:end].decode("utf-8").split("\r\n")
    pairs = (line.split(":", 1) for line in lines if ":" in line)
    return first, {k.strip().lower(): v.strip() for k, v in pairs}, end + 4


def parse(data: bytes) -> dict:
    """A record as written by ``record``: type, id, address, referent, payload, bytes and digest.

    Bytes and digest are those of the full payload. A response's are computed from what
    was read and compared with its headers; a revisit has those of the answer it repeats.
    """
    first, fields, at = _headers(data)
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    block = data[at : at + int(fields["content-length"])]
    if len(block) != int(fields["content-length"]):
        raise ValueError("a record is cut off")
    _, answer, body = _headers(block)
    named = fields["warc-payload-digest"].removeprefix("sha1:")
    known = fields["warc-type"] == "revisit"
    payload = None if known else block[body:]
    digest = named if known else base32_digest(payload)
    if digest != named:
        raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")
    strip = lambda v: v[1:-1] if v else None
    return {
        "record_type": fields["warc-type"], "record_uri": strip(fields["warc-record-id"]), "url": fields.get("warc-target-uri"),
        "refers_to_uri": strip(fields.get("warc-refers-to")), "payload": payload,
        "payload_bytes": int(answer["content-length"]) if known else len(payload), "payload_digest": digest,
    }


# --- writing --------------------------------------------------------------------


def _file_system(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def new_folder(spark: SparkSession) -> str:
    """A folder below the shared one, deleted when the driver ends."""
    path = f"{shared_dir(spark)}/packages/{uuid.uuid4().hex}"
    made = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = made.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    system.mkdirs(made)
    system.deleteOnExit(made)
    return path


def with_referents(pages: DataFrame, id_: str, payload: str, min_bytes: int = 0, url: str | None = None) -> DataFrame:
    """id, url, payload and first: the id of the response that the row repeats, itself where it is one."""
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_).alias("id"), (F.col(url).cast("string") if url else F.lit(None).cast("string")).alias("url"), body.alias("payload")
    )
    rows = rows.withColumn("k1", F.unhex(F.sha1("payload"))).withColumn("k2", F.xxhash64("payload"))
    long_enough = rows.filter(F.octet_length("payload") >= min_bytes)
    firsts = long_enough.groupBy("k1", "k2").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"))
    # only payloads met more than once: a hash, an id and a count each
    firsts = materialise(firsts.filter("copies > 1 AND first IS NOT NULL"))
    if firsts.count() <= BROADCAST_ROWS:
        joined = rows.join(F.broadcast(firsts), ["k1", "k2"], "left")
    else:
        joined = join_counted(rows, firsts, ["k1", "k2"], "copies", "left")
    return joined.select("id", "url", "payload", "first")


def _write(folder: str, package_bytes: int, wide: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _file_system(folder)
        package, index, path = None, [], ""

        def finished() -> pa.RecordBatch:
            package.close_member()
            package.open(INDEX)
            for line in index:
                package.write(line)
            package.close_member()
            package.close(wide)
            package.out.close()
            row = [[path], [len(index)], [package.at]]
            return pa.RecordBatch.from_arrays([pa.array(v) for v in row], ["path", "n_records", "n_bytes"])

        for batch in batches:
            columns = [batch.column(c) for c in ("id", "url", "payload", "first")]
            for i in range(batch.num_rows):
                id_, url, payload, first = (c[i].as_py() for c in columns)
                if package is None:
                    # a name of its own for each attempt
                    path = f"{uuid.uuid4().hex}.wacz"
                    package, index = Package(system.open_output_stream(f"{root}/{path}")), []
                    package.open(RECORDS)
                raw, said = record(id_, url, payload, id_uri(first) if first is not None and first != id_ else None)
                packed = gzip.compress(raw, 6, mtime=0)
                said["offset"], said["length"] = package.write(packed), len(packed)
                index.append(json.dumps(said, separators=(",", ":")).encode() + b"\n")
                if package.at >= package_bytes:
                    yield finished()
                    package = None
        if package is not None:
            yield finished()

    return run


def write_packages(
    pages: DataFrame,
    folder: str,
    id_: str = "page_id",
    payload: str = "html",
    url: str | None = "url",
    min_bytes: int = 0,
    package_bytes: int = PACKAGE_BYTES,
    wide: bool = False,
) -> DataFrame:
    """Write all rows as WARC records; a written table of packages: path, n_records, n_bytes.

    Paths are relative to the folder. ``wide`` writes 64-bit directories even where 32 bits do.
    """
    rows = with_referents(pages, id_, payload, min_bytes, url)
    text = rows.select(F.col("id").cast("string"), "url", "payload", F.col("first").cast("string"))
    return materialise(text.mapInArrow(_write(folder, package_bytes, wide), "path string, n_records long, n_bytes long"))


# --- reading --------------------------------------------------------------------

MEMBERS = "path string, member string, stored boolean, start long, size long, crc long"
PLACES = "path string, at long, length long"
READ = (
    "path string, at long, record_id string, record_type string, url string, refers_to string, "
    "payload_bytes long, payload_digest string, payload binary"
)


def members(packages: DataFrame, folder: str) -> DataFrame:
    """All members of packages (path, n_bytes): name, whether stored, first byte, size, CRC."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _file_system(folder)
        names = [c.split()[0] for c in MEMBERS.split(", ")]
        for batch in batches:
            for path, size in zip(batch.column("path").to_pylist(), batch.column("n_bytes").to_pylist(), strict=True):
                with system.open_input_file(f"{root}/{path}") as file:
                    try:
                        found = [{"path": path, **m} for m in members_of(file, size)]
                    except (ValueError, struct.error) as broken:
                        raise ValueError(f"{path}: {broken}") from broken
                yield pa.RecordBatch.from_arrays([pa.array([m[n] for m in found], k) for n, k in zip(names, _MEMBER_KINDS, strict=True)], names)

    return packages.select("path", "n_bytes").mapInArrow(run, MEMBERS)


_MEMBER_KINDS = [pa.string(), pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.int64()]


def _lines(file, start: int, size: int) -> Iterator[bytes]:
    """The lines of a stored member, read in blocks."""
    at, end, rest = start, start + size, b""
    while at < end:
        more = _read_at(file, at, min(BLOCK_BYTES, end - at))
        if not more:
            raise ValueError("an index is cut off")
        at += len(more)
        *lines, rest = (rest + more).split(b"\n")
        yield from lines
    if rest:
        yield rest


def places(packages: DataFrame, folder: str) -> DataFrame:
    """Where every record lies in its package: path, at, length; from the index members."""
    listed = members(packages, folder).filter("stored")
    by_path = listed.groupBy("path").agg(
        F.max(F.when(F.col("member") == RECORDS, F.struct("start", "size"))).alias("records"),
        F.max(F.when(F.col("member") == INDEX, F.struct("start", "size"))).alias("index"),
    )
    flat = by_path.select("path", F.col("records.start").alias("start"), F.col("index.start").alias("index"), F.col("index.size").alias("size"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _file_system(folder)
        for batch in batches:
            for row in batch.to_pylist():
                if row["start"] is None or row["size"] is None:
                    raise ValueError(f"{row['path']}: no stored records with a stored index")
                with system.open_input_file(f"{root}/{row['path']}") as file:
                    at, length = [], []
                    for line in _lines(file, row["index"], row["size"]):
                        place = json.loads(line)
                        at.append(row["start"] + place["offset"])
                        length.append(place["length"])
                columns = [pa.array([row["path"]] * len(at)), pa.array(at, pa.int64()), pa.array(length, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["path", "at", "length"])

    return flat.mapInArrow(run, PLACES)


def _ranges(rows: Iterator[tuple[str, int, int]]) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """Neighbouring records of one package, as many as one request may hold."""
    path, group = None, []
    for p, at, n in rows:
        near = group and p == path and at == sum(group[-1]) and at + n - group[0][0] <= REQUEST_BYTES
        if group and not near:
            yield path, group
            group = []
        path = p
        group.append((at, n))
    if group:
        yield path, group


def _read(folder: str, with_payload: bool):
    names = [c.split()[0] for c in READ.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _file_system(folder)
        asked = (r for b in batches for r in zip(*[b.column(c).to_pylist() for c in ("path", "at", "length")], strict=True))
        file, opened, rows, held = None, None, [], 0
        for path, group in _ranges(asked):
            if path != opened:
                if file:
                    file.close()
                file, opened = system.open_input_file(f"{root}/{path}"), path
            first = group[0][0]
            data = _read_at(file, first, sum(group[-1]) - first)
            for at, n in group:
                try:
                    r = parse(gzip.decompress(data[at - first : at - first + n]))
                except (ValueError, EOFError, OSError, zlib.error) as broken:
                    raise ValueError(f"{path}, byte {at}: {broken}") from broken
                payload = r["payload"] if with_payload else None
                rows.append(
                    (path, at, uri_id(r["record_uri"]), r["record_type"], r["url"], uri_id(r["refers_to_uri"]), r["payload_bytes"], r["payload_digest"], payload)
                )
                held += len(payload or b"")
            if held >= BATCH_BYTES or len(rows) >= 10_000:
                yield table(rows)
                rows, held = [], 0
        if file:
            file.close()
        yield table(rows)

    return run


def read_records(packages: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """All records of packages (path relative to the folder, n_bytes), in no order."""
    found = places(packages, folder)
    stretch = F.floor(F.col("at") / F.lit(RANGE_BYTES))
    dealt = found.repartition("path", stretch).sortWithinPartitions("path", "at")
    return dealt.mapInArrow(_read(folder, with_payload), READ)


def list_packages(spark: SparkSession, folder: str) -> DataFrame:
    """The packages of a folder, without reading them. Use the table of ``write_packages`` where there is one."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.wacz").load(folder)
    return found.select(F.element_at(F.split("path", "/"), -1).alias("path"), F.col("length").alias("n_bytes"))
