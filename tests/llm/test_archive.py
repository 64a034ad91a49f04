"""WARC records in ZIP packages."""

import base64
import gzip
import hashlib
import io
import os
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from claimflow.llm import archive

SHAPE = "page_id long, url string, html string, id string, k1 string, first int, copies string, payload int, path string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", 1, "c", 2, "d") for r in rows], SHAPE)


def brute(rows, min_bytes=0):
    payloads = [(i, u, (h or "").encode()) for i, u, h in rows]
    out = []
    for i, _, p in payloads:
        same = [j for j, _, q in payloads if q == p and j is not None] if len(p) >= min_bytes else []
        first = min(same, default=None)
        revisit = first is not None and first != i
        digest = base64.b32encode(hashlib.sha1(p).digest()).decode()
        out.append((i, len(p), digest, "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def read(packages, folder):
    found = archive.read_records(packages, folder).collect()
    return found, sorted(
        [
            (None if r["record_id"] is None else int(r["record_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"],
             None if r["refers_to"] is None else int(r["refers_to"]))
            for r in found
        ],
        key=str,
    )


LONG = "<p>" + "ü 漢 🙂 \r\n\r\n WARC/1.1\r\n" * 100_000
ROWS = [
    (3, "http://a/ b\r\nWARC-Type: x", "<html>é</html>"), (1, None, "<html>é</html>"), (1, None, "<html>é</html>"),
    (2, "http://b", None), (4, "", ""), (None, "http://c", ""), (None, "http://d", "alone"), (5, "http://e", LONG), (9, "http://f", LONG),
]


@pytest.mark.parametrize("min_bytes,package_bytes,wide", [(0, 1 << 30, False), (10, 2_000, True), (10**9, 1, True)])
def test_round_trip(spark, min_bytes, package_bytes, wide):
    rng = random.Random(min_bytes)
    rows = ROWS + [(100 + i, f"http://x/{i}", f"page {rng.randint(0, 40)}") for i in range(200)]
    rows += [(1000 + i, "http://hot", "one text of a third of all rows") for i in range(200)]
    folder = archive.new_folder(spark)
    packages = archive.write_packages(table(spark, rows).repartition(4), folder, min_bytes=min_bytes, package_bytes=package_bytes, wide=wide)
    found, got = read(packages, folder)
    assert got == brute(rows, min_bytes)
    assert packages.agg(F.sum("n_records")).first()[0] == len(rows)
    text = {r["payload_digest"]: r["payload"] for r in found if r["record_type"] == "response"}
    for _, _, h in rows:
        digest = base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()
        assert bytes(text[digest]).decode() == (h or "")
    assert {r["url"] for r in found if r["record_id"] == "3"} == {"http://a/%20b%0D%0AWARC-Type:%20x"}
    assert {r["url"] for r in found if r["record_id"] == "1"} == {None}
    listed = archive.list_packages(spark, folder)
    assert sorted(map(tuple, listed.collect())) == sorted(map(tuple, packages.select("path", "n_bytes").collect()))


def test_packages_are_zip_files_and_warc_files(spark):
    folder = archive.new_folder(spark)
    packages = archive.write_packages(table(spark, ROWS).coalesce(1), folder)
    (path, n, size), = packages.collect()
    place = f"{folder}/{path}".removeprefix("file://")
    assert os.path.getsize(place) == size and n == len(ROWS)
    with zipfile.ZipFile(place) as z:
        assert z.testzip() is None
        assert {(i.filename, i.compress_type) for i in z.infolist()} == {(archive.RECORDS, 0), (archive.INDEX, 0)}
        whole = gzip.decompress(z.read(archive.RECORDS))
    heads = whole.count(b"WARC/1.1\r\nWARC-Type: re")
    assert heads == len(ROWS)


def repackaged(spark, folder, comment=b"", compressed=False, index=True):
    """The same members in a package that another program wrote."""
    packages = archive.write_packages(table(spark, ROWS).coalesce(1), folder)
    place = f"{folder}/{packages.first()['path']}".removeprefix("file://")
    other = os.path.join(os.path.dirname(place), "other.wacz")
    with zipfile.ZipFile(place) as z, zipfile.ZipFile(other, "w") as out:
        out.writestr("pages/ü.txt", b"x" * 1000, zipfile.ZIP_DEFLATED)
        for i in range(300):
            out.writestr(f"extra/{i}", b"")
        kind = zipfile.ZIP_DEFLATED if compressed else zipfile.ZIP_STORED
        with out.open(zipfile.ZipInfo(archive.RECORDS), "w", force_zip64=True) as member:
            member.write(z.read(archive.RECORDS))
        if index:
            out.writestr(archive.INDEX, z.read(archive.INDEX), kind)
        out.comment = comment
    return spark.createDataFrame([("other.wacz", os.path.getsize(other))], "path string, n_bytes long")


@pytest.mark.parametrize("comment", [b"", b"a comment with PK\x05\x06 in it and some bytes behind it" + b"." * 500])
def test_packages_of_other_programs(spark, comment, monkeypatch):
    folder = archive.new_folder(spark)
    packages = repackaged(spark, folder, comment)
    assert read(packages, folder)[1] == brute(ROWS)
    listed = archive.members(packages, folder).collect()
    assert len(listed) == 303 and [r["member"] for r in listed if not r["stored"]] == ["pages/ü.txt"]


def test_directories_are_walked_in_pieces(tmp_path, monkeypatch):
    monkeypatch.setattr(archive, "BLOCK_BYTES", 50)
    out = io.BytesIO()
    package = archive.Package(out)
    for i in range(50):
        package.open(f"m/{i}")
        package.write(b"x" * i)
        package.close_member()
    package.close(wide=True)
    found = list(archive.members_of(io.BytesIO(out.getvalue()), package.at))
    assert [(m["member"], m["size"]) for m in found] == [(f"m/{i}", i) for i in range(50)]
    assert [out.getvalue()[m["start"] : m["start"] + m["size"]] for m in found] == [b"x" * i for i in range(50)]


@pytest.mark.parametrize("what", ["compressed", "no index", "cut off", "changed"])
def test_broken_packages_are_named(spark, what):
    folder = archive.new_folder(spark)
    packages = repackaged(spark, folder, compressed=what == "compressed", index=what != "no index")
    place = f"{folder}/other.wacz".removeprefix("file://")
    if what == "cut off":
        size = os.path.getsize(place) // 2
        os.truncate(place, size)
        packages = packages.withColumn("n_bytes", F.lit(size).cast("long"))
    if what == "changed":
        at = archive.places(packages, folder).agg(F.min("at")).first()[0]
        with open(place, "r+b") as f:
            f.seek(at + 40)
            f.write(b"\0\0\0\0")
    with pytest.raises(Exception, match="other.wacz"):
        archive.read_records(packages, folder).count()


def test_no_rows(spark):
    folder = archive.new_folder(spark)
    packages = archive.write_packages(table(spark, []), folder)
    assert packages.count() == 0 and archive.read_records(packages, folder).count() == 0
