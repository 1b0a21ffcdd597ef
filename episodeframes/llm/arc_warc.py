"""Legacy archives to WARC: ARC files are parsed by version-specific header lines and declared lengths.

Version 1 lines hold URL, IP address, date, type and length; version 2 adds result code, checksum, location, offset and
file name before the length. Each ARC file is read twice by a Spark task: once for an index (payload digest, page, place)
and once to be rewritten. Between the two, Spark groups the index by digest and picks the record that stays a response;
groups with a large share of all records are joined by broadcast, and the decisions travel to the files sorted by place,
so no group of equal payloads is gathered and a task holds one record at a time. Identifiers are name-based UUIDs of (archive, record number), dates come from the 14-digit ARC date, types
from the URL and block, digests from the payload.

Defined results: a null html is an empty payload; equal payloads of min_bytes and more have one response, that of the
largest page_id (nulls smallest, of repeated ids the last place); blanks in a URL are percent-encoded and a null URL is
``urn:page:<page_id>``; an empty table gives no archives. Other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, join_groups, materialize, partitions_for, scratch_path

ARC_FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"),
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
INDEX = "path string, no long, page_id long, url string, date string, digest string, n long"
PAGE_HEADER, TARGET_HEADER = "X-Page-Id", "X-Refers-To-Page-Id"


def member(data: bytes) -> bytes:
    """One gzip member, as archives have for each record."""
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def open_stream(uri: str) -> io.BufferedIOBase:
    fs, path = pafs.FileSystem.from_uri(uri)
    raw = io.BufferedReader(fs.open_input_file(path), 1 << 20)
    return gzip.GzipFile(fileobj=raw) if raw.peek(2)[:2] == b"\x1f\x8b" else raw


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def arc_record(version: int, url: str, date: str, kind: str, block: bytes, status: str = "200", name: str = "-", offset: int = 0) -> bytes:
    values = {
        "URL": url, "IP-address": "0.0.0.0", "Archive-date": date, "Content-type": kind, "Result-code": status, "Checksum": "-", "Location": "-",
        "Offset": str(offset), "Filename": name, "Archive-length": str(len(block))
    }
    return " ".join(values[f] for f in ARC_FIELDS[version]).encode() + b"\n" + block + b"\n"


def arc_filedesc(version: int, name: str, date: str) -> bytes:
    block = f"{version} 0 pages\n{' '.join(ARC_FIELDS[version])}\n\n".encode()
    return arc_record(version, f"filedesc://{name}", date, "text/plain", block, name=name)


def read_arc(stream: io.BufferedIOBase) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(version, header fields, block) of every record; the first record, filedesc, declares the version."""
    version = 0
    while line := stream.readline():
        if not line.strip():
            continue
        parts = line.decode("utf-8", "surrogateescape").rstrip("\r\n").split(" ")
        block = stream.read(int(parts[-1]))
        if len(block) != int(parts[-1]):
            raise ValueError("an ARC record is shorter than it declares")
        if not version:
            if not parts[0].startswith("filedesc:"):
                raise ValueError("an ARC file begins with a filedesc record")
            version = int(block.split(b" ", 1)[0])
        if version not in ARC_FIELDS or len(parts) != len(ARC_FIELDS[version]):
            raise ValueError(f"not a header line of ARC version {version}: {len(parts)} fields")
        yield version, dict(zip(ARC_FIELDS[version], parts, strict=True)), block


def http_parts(block: bytes) -> tuple[bytes, dict[str, str], bytes]:
    """Header bytes, header fields and payload of an HTTP message; no header: all is payload."""
    if not block.startswith(b"HTTP/"):
        return b"", {}, block
    head, gap, payload = block.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode("utf-8", "replace").split("\r\n")[1:] if ": " in x)
    return head + gap, fields, payload


def warc_date(arc_date: str) -> str:
    d = arc_date.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def record_id(path: str, no: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{path}#{no}')}>"


def warc_record(kind: str, identifier: str, date: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [
        ("WARC-Type", kind), ("WARC-Record-ID", identifier), ("WARC-Date", date), *headers, ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"),
        ("Content-Length", str(len(block)))
    ]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines).encode("utf-8", "surrogateescape") + b"\r\n" + block + b"\r\n\r\n"


def converted(path: str, no: int, fields: dict[str, str], block: bytes, decision: dict | None) -> bytes:
    """The WARC record for record ``no`` of an ARC file."""
    url, date, identifier = fields["URL"], warc_date(fields["Archive-date"]), record_id(path, no)
    if url.startswith("filedesc:"):
        body = f"software: episodeframes\r\nformat: WARC File Format 1.1\r\nconformsTo: ARC {block.split(b' ', 1)[0].decode()}\r\n".encode()
        return warc_record(
            "warcinfo", identifier, date, [("WARC-Filename", url.removeprefix("filedesc://")), ("Content-Type", "application/warc-fields")], body
        )
    head, _, payload = http_parts(block)
    common = [("WARC-Target-URI", url), ("WARC-IP-Address", fields["IP-address"]), ("WARC-Payload-Digest", f"sha1:{sha1_base32(payload)}")]
    if not head:
        return warc_record("resource", identifier, date, [*common, ("Content-Type", fields["Content-type"])], block)
    common.append(("Content-Type", "application/http; msgtype=response"))
    if decision is None or decision["keep_path"] is None or (decision["keep_path"], decision["keep_no"]) == (path, no):
        return warc_record("response", identifier, date, common, block)
    target = [
        ("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(decision["keep_path"], decision["keep_no"])),
        ("WARC-Refers-To-Target-URI", decision["keep_url"]), ("WARC-Refers-To-Date", warc_date(decision["keep_date"]))
    ]
    if decision["keep_page"] is not None:
        target.append((TARGET_HEADER, str(decision["keep_page"])))
    return warc_record("revisit", identifier, date, common + target, head)


def read_warc(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of every record."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("not the first line of a WARC record")
        fields = {}
        while (line := stream.readline()).strip():
            k, _, v = line.decode("utf-8", "surrogateescape").rstrip("\r\n").partition(": ")
            fields[k] = v
        yield fields, stream.read(int(fields["Content-Length"]))


class Output:
    """A file under the name of this attempt."""

    def __init__(self, uri: str):
        fs, path = pafs.FileSystem.from_uri(uri)
        fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.uri, self.file, self.at = uri, fs.open_output_stream(path, compression=None, buffer_size=1 << 20), 0

    def write(self, data: bytes) -> None:
        self.file.write(data)
        self.at += len(data)


def _write_arc(folder: str, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, out = TaskContext.get().partitionId(), None
        version = 1 + part % 2
        for batch in batches:
            for page, url, html in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if out is None:
                    name = f"part-{part:06d}-{uuid.uuid4().hex}.arc.gz"
                    out = Output(f"{folder}/{name}")
                    out.write(member(arc_filedesc(version, name, date)))
                payload = (html or "").encode()
                mark = "" if page is None else f"{PAGE_HEADER}: {page}\r\n"
                block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{mark}Content-Length: {len(payload)}\r\n\r\n".encode() + payload
                address = f"urn:page:{page}" if not url else re.sub(r"[\s\x00-\x20]", lambda x: "".join(f"%{b:02X}" for b in x[0].encode()), url)
                out.write(member(arc_record(version, address, date, "text/html", block, name=name, offset=out.at)))
        if out:
            out.file.close()
            yield pa.RecordBatch.from_arrays([pa.array([out.uri])], ["path"])

    return run


def write_arc(
    pages: DataFrame, folder: str, date: str = "20240101000000", page_id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """One ARC file a partition, versions 1 and 2 in turn; returns their paths."""
    bounded_batches(pages.sparkSession)
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    return materialize(rows.mapInArrow(_write_arc(folder, date), "path string"), "arc-files")


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column(0).to_pylist():
            rows = []
            with open_stream(path) as f:
                for no, (_, fields, block) in enumerate(read_arc(f)):
                    _, http, payload = http_parts(block)
                    page = http.get(PAGE_HEADER)
                    if http:
                        rows.append((path, no, page and int(page), fields["URL"], fields["Archive-date"], sha1_base32(payload), len(payload)))
                    else:
                        rows.append((path, no, None, fields["URL"], fields["Archive-date"], None, None))
                    if len(rows) == 4096:
                        yield _index_batch(rows)
                        rows = []
            if rows:
                yield _index_batch(rows)


def _index_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["path", "no", "page_id", "url", "date", "digest", "n"]
    )


def _convert(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, records, out = None, None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["path"] != path:
                    if out:
                        out.file.close()
                        yield pa.RecordBatch.from_arrays([pa.array([out.uri])], ["path"])
                    path = row["path"]
                    records = enumerate(read_arc(open_stream(path)))
                    out = Output(f"{folder}/{path.rsplit('/', 1)[1].removesuffix('.gz').removesuffix('.arc')}-{uuid.uuid4().hex}.warc.gz")
                no, (_, fields, block) = next(records)
                if no != row["no"]:
                    raise ValueError(f"record {no} of {path} has no decision")
                out.write(member(converted(path, no, fields, block, row)))
        if out:
            out.file.close()
            yield pa.RecordBatch.from_arrays([pa.array([out.uri])], ["path"])

    return run


def spread(paths: DataFrame) -> DataFrame:
    return paths.repartition(partitions_for(paths.sparkSession), "path")


def convert_archives(arc_paths: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """WARC files for ARC files (a table of paths); equal payloads become revisits. Returns the paths written."""
    spark = arc_paths.sparkSession
    index = materialize(spread(arc_paths).mapInArrow(_index, INDEX), "arc-index")
    names = {"page_id": "keep_page", "path": "keep_path", "no": "keep_no", "url": "keep_url", "date": "keep_date"}
    shared = F.coalesce(F.col("n") >= min_bytes, F.lit(False))  # records without a payload have no digest
    groups = index.filter(shared).groupBy("digest", "n").agg(F.max(F.struct(*names)).alias("keep"), F.count(F.lit(1)).alias("copies"))
    groups = materialize(groups.select("digest", "n", "copies", *(F.col(f"keep.{a}").alias(b) for a, b in names.items())), "arc-groups")
    held = join_groups(index.filter(shared).select("path", "no", "digest", "n"), groups, ["digest", "n"], "copies")
    alone = index.filter(~shared).select("path", "no", *(F.lit(None).cast(groups.schema[c].dataType).alias(c) for c in names.values()))
    decided = held.select("path", "no", *names.values()).unionByName(alone)
    dealt = decided.repartition(partitions_for(spark), "path").sortWithinPartitions("path", "no")
    return materialize(dealt.mapInArrow(_convert(folder), "path string"), "warc-files")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column(0).to_pylist():
            rows = []
            with open_stream(path) as f:
                for fields, block in read_warc(f):
                    if fields["WARC-Type"] not in ("response", "revisit"):
                        continue
                    _, http, payload = http_parts(block)
                    digest, revisit = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"] == "revisit"
                    if not revisit and sha1_base32(payload) != digest:
                        raise ValueError(f"a payload in {path} doesn't have its digest")
                    page, target = http.get(PAGE_HEADER), fields.get(TARGET_HEADER)
                    size = int(http["Content-Length"]) if revisit else len(payload)
                    rows.append(
                        (
                            page and int(page), size, digest, fields["WARC-Type"], target and int(target), fields["WARC-Record-ID"],
                            fields["WARC-Target-URI"]
                        )
                    )
                    if len(rows) == 4096:
                        yield _record_batch(rows)
                        rows = []
            if rows:
                yield _record_batch(rows)


def _record_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string())
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "target_uri"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def read_archives(warc_paths: DataFrame) -> DataFrame:
    """A row per response and revisit record of the archives."""
    return spread(warc_paths).mapInArrow(
        _read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, target_uri string"
    )


def archives_query(spark: SparkSession, pages: DataFrame) -> DataFrame:
    arc = write_arc(pages, scratch_path(spark, "arc"))
    return read_archives(convert_archives(arc, scratch_path(spark, "warc")))
