"""WARC archives packaged in ZIP files: write, locate and range-read without extraction.

A package holds ``archive/data.warc.gz`` (one gzip member per record) and
``indexes/index.cdxj`` (offset and length of every record), both stored, not
deflated, so a record's place in the package is known.  The reader parses the
end record, the ZIP64 records and the central directory, finds the stored
members from their local headers and reads single records by range.  Listing
and reading are separate Spark steps: records of one large package are dealt
out over many tasks.

Packages are reached through pyarrow file systems by URI.  A package is listed
only by the task that finished it, so leftovers of lost tasks are never read.

Defined results: a null html is an empty payload; a null url leaves the header
out; a null page id is written as ``null`` and read back as null; of records
with equal payloads of ``min_bytes`` or more those with the smallest page id
are responses (all of them, if rows repeat) and the others revisit it; a
package that is cut short, deflated or has a wrong digest is an error; a
package without index is scanned record by record; extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import struct
import urllib.parse
import uuid
import zipfile
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._stage import shared_path, stage
from .token_counts import open_store

PACKAGE_BYTES = 32 << 20
READ_BYTES = 8 << 20
ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
# Fixed values of the WARC and ZIP formats.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END, END64, LOCATOR64, CENTRAL, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(page_id, url, payload: bytes, refers_to, digest: str) -> bytes:
    """One WARC record; ``refers_to`` makes it a revisit, whose block ends with the HTTP header."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{'null' if page_id is None else page_id}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        head.append("WARC-Target-URI: " + urllib.parse.quote(url, safe="!#$%&'()*+,/:;=?@[]~"))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Headers, block parts and type of one uncompressed record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    h = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = rest[:int(h["content-length"])]
    if len(block) < int(h["content-length"]):
        raise ValueError("record cut short")
    http, _, payload = block.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in http.split(b"\r\n")[1:])}
    page = h["warc-record-id"].removeprefix("<urn:page:").removesuffix(">")
    refers = h.get("warc-refers-to", "").removeprefix("<urn:page:").removesuffix(">")
    digest = h["warc-payload-digest"].removeprefix("sha1:")
    if h["warc-type"] == "response":
        if payload_digest(payload) != digest:
            raise ValueError(f"page {page}: payload differs from its digest")
        size = len(payload)
    else:
        size = int(fields[b"content-length"])
    return {"page_id": None if page == "null" else int(page), "payload_bytes": size, "payload_digest": digest,
            "record_type": h["warc-type"], "refers_to": int(refers) if refers else None, "url": h.get("warc-target-uri")}


class PackageWriter:
    """Collects records of one package (bounded by the caller) and writes it at once."""

    def __init__(self):
        self.data, self.index = io.BytesIO(), []

    def add(self, page_id, url, payload, refers_to, digest):
        z = zlib.compressobj(3, zlib.DEFLATED, 31)
        raw = z.compress(record_bytes(page_id, url, payload, refers_to, digest)) + z.flush()
        self.index.append((page_id, self.data.tell(), len(raw)))
        self.data.write(raw)

    def package(self, zip64: bool = False) -> bytes:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
            lines = "".join(f"{p} 19700101000000 " + json.dumps({"offset": o, "length": n}) + "\n" for p, o, n in self.index)
            for name, content in ((ARCHIVE, self.data.getvalue()), (INDEX, lines.encode())):
                with z.open(zipfile.ZipInfo(name), "w", force_zip64=zip64) as member:
                    member.write(content)
        return out.getvalue()


def write_packages(records: DataFrame, folder: str, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Write ``page_id, url, html, refers_to`` rows; returns the finished packages ``file, n`` (written)."""
    def run(batches):
        store, root = open_store(folder)
        store.create_dir(root, recursive=True)
        writer = None

        def finished():
            name = f"{uuid.uuid4().hex}.zip"
            with store.open_output_stream(f"{root.rstrip('/')}/{name}") as out:
                out.write(writer.package())
            return pa.RecordBatch.from_pydict({"file": [f"{folder.rstrip('/')}/{name}"], "n": [len(writer.index)]})

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to")]
            for page_id, url, html, refers in zip(*cols):
                writer = writer or PackageWriter()
                payload = (html or "").encode()
                writer.add(page_id, url, payload, refers, payload_digest(payload))
                if writer.data.tell() >= package_bytes:
                    yield finished()
                    writer = None
        if writer:
            yield finished()

    return stage(records.mapInArrow(run, "file string, n long"), "warc-packages")


def central_directory(src, size: int) -> list[dict]:
    """Members of a ZIP file read through ``src`` (seek and read), ZIP64 included."""
    def read(at, n):
        src.seek(at)
        got = src.read(n)
        if len(got) < n:
            raise ValueError("ZIP file cut short")
        return got

    tail_at = max(0, size - 22 - 0xFFFF)
    tail = read(tail_at, size - tail_at)
    e = tail.rfind(END)
    if e < 0:
        raise ValueError("no ZIP end record")
    count, length, start = struct.unpack("<10xHII", tail[e:e + 20])
    at = tail_at + e - 20
    if (count == 0xFFFF or length == 0xFFFFFFFF or start == 0xFFFFFFFF) and at >= 0 and read(at, 4) == LOCATOR64:
        end64 = struct.unpack("<8xQ", read(at, 16))[0]
        head = read(end64, 56)
        if head[:4] != END64:
            raise ValueError("no ZIP64 end record")
        count, length, start = struct.unpack("<32xQQQ", head)
    d, out, p = read(start, length), [], 0
    for _ in range(count):
        if d[p:p + 4] != CENTRAL:
            raise ValueError("damaged central directory")
        method, packed, full, n, m, k, offset = struct.unpack("<10xH8xIIHHH8xI", d[p:p + 46])
        name = d[p + 46:p + 46 + n].decode("utf-8", "replace")
        extra, x = d[p + 46 + n:p + 46 + n + m], 0
        while x + 4 <= len(extra):
            kind, width = struct.unpack("<HH", extra[x:x + 4])
            if kind == 1:  # 64-bit values stand only for fields that are full
                values = iter(struct.unpack(f"<{width // 8}Q", extra[x + 4:x + 4 + width // 8 * 8]))
                full = next(values) if full == 0xFFFFFFFF else full
                packed = next(values) if packed == 0xFFFFFFFF else packed
                offset = next(values) if offset == 0xFFFFFFFF else offset
            x += 4 + width
        out.append({"name": name, "method": method, "packed": packed, "size": full, "offset": offset})
        p += 46 + n + m + k
    for member in out:
        local = read(member["offset"], 30)
        if local[:4] != LOCAL:
            raise ValueError(f"{member['name']}: no local header")
        n, m = struct.unpack("<26xHH", local)
        member["data"] = member["offset"] + 30 + n + m
    return out


def gzip_members(src, start: int, size: int):
    """Offset and length of each gzip member of a range, read once in pieces."""
    at, begun, z = 0, 0, zlib.decompressobj(31)
    pending = b""
    while at < size or pending:
        if not pending:
            src.seek(start + at)
            pending = src.read(min(1 << 20, size - at))
            at += len(pending)
        z.decompress(pending)
        pending = z.unused_data if z.eof else b""
        if z.eof:
            end = at - len(pending)
            yield begun, end - begun
            begun, z = end, zlib.decompressobj(31)


def list_records(packages: DataFrame) -> DataFrame:
    """``file, offset, length`` of every record of every package, from indexes where there are any."""
    def run(batches):
        for batch in batches:
            for f in batch.column("file").to_pylist():
                store, path = open_store(f)
                size = store.get_file_info(path).size
                with store.open_input_file(path) as src:
                    members = central_directory(src, size)
                    stored = [m for m in members if m["name"].startswith("archive/") and not m["name"].endswith("/")]
                    index = next((m for m in members if m["name"].startswith("indexes/") and m["name"].endswith(".cdxj")), None)
                    if any(m["method"] for m in stored + [index] * bool(index)):
                        raise ValueError(f"{f}: archive members must be stored")
                    if index and len(stored) == 1:
                        src.seek(index["data"])
                        lines = src.read(index["size"]).decode().splitlines()
                        found = [json.loads(x.split(" ", 2)[2]) for x in lines if x]
                        places = [(stored[0]["data"] + x["offset"], x["length"]) for x in found]
                    else:
                        places = [(m["data"] + o, n) for m in stored for o, n in gzip_members(src, m["data"], m["size"])]
                for a in range(0, len(places), 10_000):
                    part = np.array(places[a:a + 10_000], np.int64).reshape(-1, 2)
                    yield pa.RecordBatch.from_arrays([pa.array([f] * len(part), pa.string()), pa.array(part[:, 0]), pa.array(part[:, 1])],
                                                     ["file", "offset", "length"])

    return packages.select("file").distinct().mapInArrow(run, "file string, offset long, length long")


def read_records(places: DataFrame) -> DataFrame:
    """Range-read and parse the records of ``file, offset, length`` rows."""
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "file", "offset"]

    def run(batches):
        src, opened = None, None
        for batch in batches:
            rows = []
            for f, o, n in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length"))):
                if f != opened:
                    if src is not None:
                        src.close()
                    store, path = open_store(f)
                    src, opened = store.open_input_file(path), f
                src.seek(o)
                raw = src.read(n)
                if len(raw) < n:
                    raise ValueError(f"{f}: record at {o} cut short")
                try:
                    r = parse_record(zlib.decompress(raw, 31))
                except (ValueError, KeyError, zlib.error) as err:
                    raise ValueError(f"{f}: record at {o}: {err}") from err
                rows.append((*(r[k] for k in names[:6]), f, o))
            cols = list(zip(*rows)) if rows else [[]] * 8
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    spread = places.repartition(places.sparkSession.sparkContext.defaultParallelism * 2, "file",
                                F.floor(F.col("offset") / READ_BYTES)).sortWithinPartitions("file", "offset")
    return spread.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, "
                                  "refers_to long, url string, file string, offset long")


def with_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id, url, html, refers_to``: null for responses, the response's page for revisits."""
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    body = F.coalesce("html", F.lit("")).cast("binary")
    p = p.withColumn("d", F.sha1(body)).withColumn("b", F.octet_length(body))
    keys = stage(p.select("page_id", "d", "b"), "warc-digests")
    first = (keys.where(F.col("b") >= min_bytes).groupBy("d", "b").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last"),
                                                                   F.count_if(F.col("page_id").isNull()).alias("nulls")))
    first = first.where("first IS NOT NULL AND (first < last OR nulls > 0)").select("d", "b", "first")
    revisits = (keys.join(first, ["d", "b"]).where("page_id IS NULL OR page_id > first")
                .select(F.col("page_id").alias("rp"), F.col("d").alias("rd"), "first").distinct())
    return p.join(revisits, F.col("page_id").eqNullSafe(F.col("rp")) & (F.col("d") == F.col("rd")), "left").select(
        "page_id", "url", "html", F.col("first").alias("refers_to"))


def round_trip(pages: DataFrame) -> DataFrame:
    """Write every page into packages and read them all back."""
    spark = pages.sparkSession
    packages = write_packages(with_revisits(pages), shared_path(spark, "warc"))
    return read_records(stage(list_records(packages), "warc-places"))
