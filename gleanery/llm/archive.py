"""Legacy ARC archives converted to WARC.

An ARC file starts with a file description that names its version; each record is a
header line, whose fields depend on the version and end with the length of the
content, and that many bytes.  The converter reads all files twice: once for a
digest of each payload, once to write WARC records with identifiers made from file and
place, timestamps from the header, types from the URL's scheme, and digests.  Of the
records whose payloads are equal and not small, the one with the least key is a
response; the others revisit it and keep their HTTP header only.

Tasks write files under names of their own and hand back one row per file.  Only
files in these stored rows are read, so repeated attempts do no harm.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.sources.scratch import written

#: Payloads shorter than this are never revisits; a file is closed after so many records or bytes.
MIN_REVISIT, MOST_RECORDS, MOST_BYTES = 100, 5_000, 32_000_000
DATE = "20250101000000"

#: The fields of a header line, by version.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
_IDS = uuid.UUID("5b0cf0f4-5f5e-4f0e-9a0e-2d9c7d1a6a11")
_KEY, _REFERS = "X-Row-Key", "X-Refers-To-Row-Key"


@dataclass
class Record:
    """A record of an ARC file; *place* counts from 0, the file description."""

    place: int
    url: str
    ip: str
    date: str
    mime: str
    content: bytes

    @property
    def http(self) -> bool:
        return self.content[:5] == b"HTTP/"

    def parts(self) -> tuple[bytes, bytes]:
        """HTTP header with its blank line, and payload; other content is all payload."""
        if not self.http:
            return b"", self.content
        head, blank, payload = self.content.partition(b"\r\n\r\n")
        return head + blank, payload


def read_arc(file: BinaryIO) -> Iterator[Record]:
    """The records of an ARC file of version 1 or 2, the file description first."""
    version, place = None, 0
    while line := file.readline():
        if not line.strip():
            continue
        fields = line.decode("latin-1").rstrip("\r\n").split(" ")
        if version is None and not fields[0].startswith("filedesc:"):
            raise ValueError("an ARC file starts with its description")
        if version is not None and len(fields) != len(FIELDS[version].split(" ")):
            raise ValueError(f"record {place}: {len(fields)} fields in a header of version {version}")
        length = int(fields[-1])
        content = file.read(length)
        if len(content) != length:
            raise ValueError(f"record {place} has {len(content)} of {length} bytes")
        if version is None:
            version = int(content.split(b" ", 1)[0])
            if version not in FIELDS:
                raise ValueError(f"ARC version {version}")
        yield Record(place, *fields[:4], content)
        place += 1


def arc_record(version: int, url: str, mime: str, content: bytes, date: str = DATE, ip: str = "0.0.0.0") -> bytes:
    extra = "200 - - 0 - " if version == 2 else ""
    return f"{url} {ip} {date} {mime} {extra}{len(content)}\n".encode("latin-1") + content + b"\n"


def arc_description(version: int, name: str, date: str = DATE) -> bytes:
    return arc_record(version, f"filedesc://{name}", "text/plain", f"{version} 0 unknown\n{FIELDS[version]}\n".encode(), date)


def _url(url: str | None) -> str:
    """*url* without blanks or other signs that a header line can't hold."""
    return quote(url, safe="%:/?#[]@!$&'()*+,;=~") if url else "unknown:"


def _record_id(file: str, place: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(_IDS, f'{file}#{place}')}>"


def _warc_date(date: str) -> str:
    d = (date + "00000101000000"[len(date) :])[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:]}Z"


class _Files:
    """Gzipped files, one member per record, closed after so many records or bytes."""

    def __init__(self, root: str, suffix: str, begin=None):
        self._fs, self._folder = fs.FileSystem.from_uri(root)
        self._fs.create_dir(self._folder, recursive=True)
        self._suffix, self._begin, self._out = suffix, begin, None
        self.done: list[tuple[str, int]] = []

    def add(self, record: bytes) -> None:
        if self._out is None:
            self._name = f"{uuid.uuid4().hex}.{self._suffix}.gz"
            self._out, self._n, self._bytes = self._fs.open_output_stream(f"{self._folder}/{self._name}", compression=None), 0, 0
            if self._begin:
                self._out.write(gzip.compress(self._begin(self._name), 6, mtime=0))
        self._out.write(gzip.compress(record, 6, mtime=0))
        self._n, self._bytes = self._n + 1, self._bytes + len(record)
        if self._n >= MOST_RECORDS or self._bytes >= MOST_BYTES:
            self.close()

    def close(self) -> None:
        if self._out is not None:
            self._out.close()
            self.done.append((self._name, self._n))
            self._out = None

    def rows(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"file": pa.array([f for f, _ in self.done], pa.string()), "n": pa.array([n for _, n in self.done], pa.int64())})


def _opened(root: str, file: str) -> BinaryIO:
    store, folder = fs.FileSystem.from_uri(root)
    return gzip.GzipFile(fileobj=store.open_input_stream(f"{folder}/{file}", compression=None))


def _by_file(rows: DataFrame, files: int) -> DataFrame:
    """A number of partitions is given, or so little data would be gathered into one task."""
    return rows.repartition(max(1, files), "file")


def write_arcs(pages: DataFrame, root: str, key: str = "page_id", url: str = "url", html: str = "html", versions: tuple[int, ...] = (1, 2)) -> DataFrame:
    """Pages as HTTP responses in ARC files below *root*, tasks taking turns with *versions*; returns rows (file, n).

    NULL html is an empty payload, a NULL or empty URL is ``unknown:``, a NULL key is left out.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        version = versions[TaskContext.get().partitionId() % len(versions)]
        out = _Files(root, "arc", lambda name: arc_description(version, name))
        for batch in batches:
            for k, u, h in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                payload = (h or "").encode()
                lines = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}"]
                lines += [] if k is None else [f"{_KEY}: {k}"]
                out.add(arc_record(version, _url(u), "text/html", "\r\n".join([*lines, "", ""]).encode() + payload))
        out.close()
        yield out.rows()

    kept = pages.select(F.col(key).cast("bigint"), url, html)
    return written(kept.mapInArrow(run, "file string, n bigint"), "arcs", compact=True)


def _header(block: bytes, name: str) -> str | None:
    found = re.search(rf"(?mi)^{re.escape(name)}: *([^\r\n]*)\r?$".encode(), block)
    return found[1].decode("latin-1") if found else None


def scan(spark: SparkSession, root: str, files: DataFrame) -> DataFrame:
    """Of each record of ARC *files*: file, place, key, url, date, payload_bytes and payload_digest (SHA-256, hex)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column("file").to_pylist():
                rows = []
                with _opened(root, file) as opened:
                    for r in read_arc(opened):
                        if r.place:
                            head, payload = r.parts()
                            key = _header(head, _KEY)
                            rows.append({"file": file, "place": r.place, "key": None if key is None else int(key), "url": r.url, "date": r.date, "payload_bytes": len(payload), "payload_digest": hashlib.sha256(payload).hexdigest()})
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    schema = pa.schema([("file", pa.string()), ("place", pa.int64()), ("key", pa.int64()), ("url", pa.string()), ("date", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])
    return _by_file(files, files.count()).mapInArrow(run, "file string, place bigint, key bigint, url string, date string, payload_bytes bigint, payload_digest string")


def revisits(records: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """Stored *records* with ``of``: for a revisit the record it refers to, else NULL.

    Of equal payloads the record with the least key is the response, then by file
    and place; NULL keys come last.
    """
    rank = F.struct(F.col("key").isNull().alias("last"), "key", "file", "place")
    large = records.filter(F.col("payload_bytes") >= min_bytes)
    first = large.groupBy("payload_digest").agg(F.min_by(F.struct("key", "file", "place", "url", "date"), rank).alias("of"), F.count("*").alias("copies"))
    repeated = first.filter("copies > 1").select("payload_digest", "of")
    itself = (F.col("of.file") == F.col("file")) & (F.col("of.place") == F.col("place")) | (F.col("payload_bytes") < min_bytes)
    # One row per digest on one side, so a digest that a third of all records share may be split by Spark.
    return records.join(repeated, "payload_digest", "left").withColumn("of", F.when(~itself, F.col("of")))


def _warc(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields if v is not None), f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode("latin-1") + block + b"\r\n\r\n"


def warc_record(file: str, r: Record, of: dict | None) -> bytes:
    """The WARC record equivalent to an ARC record; *of* is the record that it revisits."""
    ids = [("WARC-Record-ID", _record_id(file, r.place)), ("WARC-Date", _warc_date(r.date))]
    digest = lambda b: "sha256:" + hashlib.sha256(b).hexdigest()
    if not r.place:
        return _warc([("WARC-Type", "warcinfo"), *ids, ("WARC-Filename", file), ("Content-Type", "application/warc-fields")], f"software: arc converter\r\nformat: WARC File Format 1.1\r\ndescription: from {r.url}\r\n".encode("latin-1"))
    head, payload = r.parts()
    kind = "revisit" if of else "response" if r.http else "resource"
    block = head if of else r.content
    fields = [("WARC-Type", kind), *ids, ("WARC-Target-URI", r.url), ("WARC-IP-Address", None if r.ip == "0.0.0.0" else r.ip)]
    if of:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", _record_id(of["file"], of["place"])),
            ("WARC-Refers-To-Target-URI", of["url"]),
            ("WARC-Refers-To-Date", _warc_date(of["date"])),
            (_REFERS, None if of["key"] is None else str(of["key"])),
        ]
    fields += [("WARC-Payload-Digest", digest(payload)), ("WARC-Block-Digest", digest(block)), ("Content-Type", "application/http; msgtype=response" if r.http else r.mime)]
    return _warc(fields, block)


def convert(spark: SparkSession, root: str, files: DataFrame, into: str, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """WARC files below *into* for the ARC *files* below *root*; returns rows (file, n).  A file is the unit of work."""
    records = written(scan(spark, root, files), "records")
    # A record needs its decision only; most need none.
    decided = revisits(records, min_bytes).filter(F.col("of").isNotNull()).select("file", F.struct("place", "of").alias("decision"))
    grouped = decided.groupBy("file").agg(F.collect_list("decision").alias("decisions"))  # at most MOST_RECORDS each
    work = _by_file(files.select("file").join(grouped, "file", "left"), files.count())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Files(into, "warc")
        for batch in batches:
            for row in batch.to_pylist():
                of = {d["place"]: d["of"] for d in row["decisions"] or ()}
                with _opened(root, row["file"]) as opened:
                    for r in read_arc(opened):
                        out.add(warc_record(row["file"], r, of.get(r.place)))
        out.close()
        yield out.rows()

    return written(work.mapInArrow(run, "file string, n bigint"), "warcs", compact=True)


def read_warc(file: BinaryIO) -> Iterator[tuple[bytes, bytes]]:
    """Header and block of each record."""
    while line := file.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        head = [line]
        while (line := file.readline()).strip():
            head.append(line)
        header = b"".join(head)
        length = int(_header(header, "Content-Length"))
        block = file.read(length)
        if len(block) != length:
            raise ValueError("a record is cut off")
        yield header, block


def read_warcs(spark: SparkSession, root: str, files: DataFrame) -> DataFrame:
    """Rows of the records, but for descriptions, of WARC *files* below *root*.

    key, target_uri, record_type, payload_bytes, payload_digest (both of the full
    payload, also of a revisit), refers_to (the key of the response) and record_id.
    A payload that its digest doesn't fit is an error.
    """
    names = ("key", "target_uri", "record_type", "payload_bytes", "payload_digest", "refers_to", "record_id")
    kinds = dict.fromkeys(("key", "payload_bytes", "refers_to"), pa.int64())
    schema = pa.schema([(n, kinds.get(n, pa.string())) for n in names])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = lambda v: None if v is None else int(v)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                rows = []
                with _opened(root, name) as opened:
                    for header, block in read_warc(opened):
                        kind = _header(header, "WARC-Type")
                        if kind == "warcinfo":
                            continue
                        head, payload = Record(0, "", "", "", "", block).parts()
                        digest = _header(header, "WARC-Payload-Digest").removeprefix("sha256:")
                        if kind != "revisit" and hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError(f"{name}: a payload doesn't fit its digest")
                        size = len(payload) if kind != "revisit" else int(_header(head, "Content-Length"))
                        values = number(_header(head, _KEY)), _header(header, "WARC-Target-URI"), kind, size, digest, number(_header(header, _REFERS)), _header(header, "WARC-Record-ID")
                        rows.append(dict(zip(names, values, strict=True)))
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return _by_file(files, files.count()).mapInArrow(run, ", ".join(f"{n} {'bigint' if n in kinds else 'string'}" for n in names))
