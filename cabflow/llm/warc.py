"""WARC archives under Zstandard: one frame per record, the dictionary in a leading skippable frame.

Writing: each task writes its records to archives of its own in a shared folder (any file system
that Arrow opens by URI). The dictionary of an archive is fitted on its first records. A file has a
unique name and counts only once its row is in the manifest, a table that Spark commits; what a
lost or repeated task left behind is in no manifest and is never read.

Of records whose payloads are equal, and at least ``min_revisit`` bytes long, the one with the
smallest page id is a response, and the others are revisit records that refer to it: their blocks
keep the HTTP headers (with the length of the payload) and not the payload. The groups come from
a partial aggregate over digests; only digests that occur twice are joined back.

Reading: each archive is read in pieces of bounded size by one task. The dictionary frame is
loaded first, then each frame is decoded and its record checked: version line, mandatory headers,
Content-Length against the block, the closing blank lines, payload length and digest. What does
not hold raises ValueError with the file and the offset of the frame; so does, with the file, an
archive with another number of records than the manifest says.

Defined results: a null payload is empty; a null page id sorts first and stays null; rows that
repeat the page id of the response are responses too; line breaks in a URL are percent-encoded, and
a null URL has no header; an empty table gives no archive and no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow.llm import common

# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
MANDATORY = ("warc-type", "warc-record-id", "warc-date", "content-length")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: An archive is closed once it holds this many payload bytes.
ARCHIVE_BYTES = 256 << 20
#: First records, in bytes and number, that the dictionary of an archive is fitted on.
SAMPLE_BYTES, SAMPLE_RECORDS, DICTIONARY_BYTES = 1 << 20, 400, 32 << 10
READ_BYTES = 1 << 20
DATE = "2000-01-01T00:00:00Z"  # records carry no crawl date; a fixed one keeps runs alike

READ_SCHEMA = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def page_urn(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def page_of(urn: str) -> int | None:
    name = urn.removeprefix("<urn:page:").removesuffix(">")
    return None if name == "null" else int(name)


def build_record(page_id, url, payload: bytes, size: int, digest: str, refers_to, revisit: bool) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {page_urn(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if revisit:
        head += [f"WARC-Refers-To: {page_urn(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    return VERSION + b"\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def fit_dictionary(records: list[bytes]) -> bytes:
    """A dictionary from sample records; their plain text where they are too few to train on."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, records, k=200, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(records)[:DICTIONARY_BYTES]


class Archive:
    """One archive being written: samples first, then the dictionary frame and all records."""

    def __init__(self, folder: str):
        self.path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        self.records, self.payload_bytes, self.sample, self.sample_bytes = 0, 0, [], 0
        self.out = self.frames = None

    def add(self, record: bytes) -> None:
        self.records += 1
        self.payload_bytes += len(record)
        if self.out is not None:
            self.out.write(self.frames.compress(record))
            return
        self.sample.append(record)
        self.sample_bytes += len(record)
        if self.sample_bytes >= SAMPLE_BYTES or len(self.sample) >= SAMPLE_RECORDS:
            self._begin()

    def _begin(self) -> None:
        import zstandard

        raw = fit_dictionary(self.sample)
        system, path = _open(self.path)
        system.create_dir(path.rpartition("/")[0], recursive=True)
        self.out = system.open_output_stream(path, compression=None)
        packed = zstandard.ZstdCompressor(level=6).compress(raw)
        self.out.write(struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed)
        self.frames = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(raw), write_checksum=True)
        for r in self.sample:
            self.out.write(self.frames.compress(r))
        self.sample = []

    def close(self) -> tuple[str, int]:
        if self.out is None:
            self._begin()
        self.out.close()
        return self.path, self.records


def _writer(folder: str):
    def write(batches):
        archive, done = None, []
        for b in batches:
            for r in b.to_pylist():
                if archive is None:
                    archive = Archive(folder)
                revisit = r["revisit"]
                payload = b"" if revisit else r["payload"].encode()
                archive.add(
                    build_record(r["page_id"], r["url"], payload, r["size"], r["digest"], r["response"], revisit)
                )
                if archive.payload_bytes >= ARCHIVE_BYTES:
                    done.append(archive.close())
                    archive = None
        if archive is not None:
            done.append(archive.close())
        if done:
            yield pa.record_batch({"path": [p for p, _ in done], "records": [n for _, n in done]})

    return write


def write_archives(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_revisit: int = 100,
) -> DataFrame:
    """Write a record per row to archives in ``folder``; returns the manifest (path, records)."""
    common.prepare(pages.sparkSession)
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(
        common.key(id_col).cast("long").alias("page_id"),
        F.col(url_col).alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("size"),
        F.sha2(payload, 256).alias("digest"),
    )
    first = (
        rows.filter(F.col("size") >= min_revisit)
        .groupBy("digest")
        .agg(F.min("page_id").alias("response"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .drop("n")
    )
    told = rows.join(first, "digest", "left").select(
        common.unkey("page_id").alias("page_id"),
        "url",
        F.coalesce(F.col("page_id") != F.col("response"), F.lit(False)).alias("revisit"),
        common.unkey("response").alias("response"),
        "payload",
        "size",
        "digest",
    )
    return common.stage(told.mapInArrow(_writer(folder), "path string, records long"), "warc-manifest")


class Record(NamedTuple):
    offset: int  # of the frame in the archive
    headers: dict[str, str]  # by lower-case name
    block: bytes


def _frames(stream, where: str) -> Iterator[tuple[int, bytes]]:
    """(offset, decoded bytes) of each frame, through the dictionary of the leading frame."""
    import zstandard

    head = stream.read(8)
    raw, at, rest = None, 0, head
    if len(head) == 8 and struct.unpack("<I", head[:4])[0] == DICTIONARY_MAGIC:
        size = struct.unpack("<I", head[4:])[0]
        raw = stream.read(size)
        if len(raw) != size:
            raise ValueError(f"{where}: the dictionary frame ends early")
        at, rest = 8 + size, b""
        if raw[:4] == FRAME_MAGIC:
            raw = zstandard.ZstdDecompressor().decompress(raw)
    frames = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw)) if raw else zstandard.ZstdDecompressor()
    while True:
        rest = rest or stream.read(READ_BYTES)
        if not rest:
            return
        frame, parts, begin = frames.decompressobj(), [], at
        while not frame.eof:
            rest = rest or stream.read(READ_BYTES)
            if not rest:
                raise ValueError(f"{where}: the frame at {begin} ends early")
            try:
                parts.append(frame.decompress(rest))
            except zstandard.ZstdError as e:
                raise ValueError(f"{where}: the frame at {begin} does not decode: {e}") from e
            at += len(rest) - len(frame.unused_data)
            rest = frame.unused_data
        yield begin, b"".join(parts)


def parse_record(data: bytes, where: str) -> Record:
    head, blank, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not blank or not lines[0].startswith(b"WARC/1."):
        raise ValueError(f"{where}: no WARC header")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.decode("utf-8").partition(":")
        if not colon:
            raise ValueError(f"{where}: not a header line: {line[:80]!r}")
        headers[name.strip().lower()] = value.strip()
    if lost := [n for n in MANDATORY if n not in headers]:
        raise ValueError(f"{where}: headers are missing: {', '.join(lost)}")
    size = headers["content-length"]
    if not size.isdigit() or len(rest) != int(size) + 4 or rest[-4:] != b"\r\n\r\n":
        raise ValueError(f"{where}: Content-Length is {size}, and the block has {len(rest) - 4} bytes")
    return Record(0, headers, rest[:-4])


def read_archive(path: str) -> Iterator[Record]:
    """The records of one archive, checked."""
    system, name = _open(path)
    with system.open_input_stream(name, compression=None, buffer_size=READ_BYTES) as stream:
        for offset, data in _frames(stream, path):
            yield parse_record(data, f"{path} at {offset}")._replace(offset=offset)


def _payload(record: Record, where: str) -> tuple[bytes | None, int, str]:
    """(payload, or None for a revisit; its full length; its digest), checked where it is there."""
    http, blank, payload = record.block.partition(b"\r\n\r\n")
    told = next((v for n, _, v in (x.partition(b":") for x in http.split(b"\r\n")[1:]) if n.lower() == b"content-length"), None)
    digest = record.headers.get("warc-payload-digest", "").partition(":")[2]
    if not blank or told is None:
        raise ValueError(f"{where}: the HTTP headers are not whole")
    if record.headers["warc-type"] == "revisit":
        return None, int(told), digest
    found = hashlib.sha256(payload).hexdigest()
    if len(payload) != int(told) or digest != found:
        raise ValueError(f"{where}: the payload does not match its length or digest")
    return payload, len(payload), found


def _reader(with_payload: bool):
    def read(batches):
        for b in batches:
            for path, records in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                rows: list[dict] = []
                held = found = 0
                for r in read_archive(path):
                    found += 1
                    payload, size, digest = _payload(r, f"{path} at {r.offset}")
                    refers = r.headers.get("warc-refers-to")
                    row = {
                        "page_id": page_of(r.headers["warc-record-id"]),
                        "url": r.headers.get("warc-target-uri"),
                        "record_type": r.headers["warc-type"],
                        "refers_to": page_of(refers) if refers else None,
                        "payload_bytes": size,
                        "payload_digest": digest,
                    }
                    if with_payload:
                        row["payload"] = payload
                        held += size
                    rows.append(row)
                    if len(rows) >= 2000 or held >= READ_BYTES * 8:
                        yield pa.RecordBatch.from_pylist(rows, schema=_arrow_schema(with_payload))
                        rows, held = [], 0
                if found != records:
                    raise ValueError(f"{path}: the archive has {found} records, and the manifest {records}")
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_arrow_schema(with_payload))

    return read


def _arrow_schema(with_payload: bool) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string()}
    fields = [(n, kinds[t]) for n, t in (f.split() for f in READ_SCHEMA.split(", "))]
    return pa.schema(fields + [("payload", pa.binary())] * with_payload)


def read_archives(spark: SparkSession, manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of all archives of a manifest, an archive per task. ``payload`` (binary; null
    for a revisit) is left out on request; lengths and digests are checked either way."""
    archives = max(1, manifest.count())
    schema = READ_SCHEMA + (", payload binary" if with_payload else "")
    return manifest.select("path", "records").repartition(archives).mapInArrow(_reader(with_payload), schema)
