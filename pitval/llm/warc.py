"""WARC archives of individually compressed records that share a Zstandard dictionary.

A dictionary is built from a bounded sample of the records to be archived. Each archive
begins with a skippable frame (magic number 0x184D2A5D) that holds the dictionary; then
every record is one frame of its own, compressed with it, so a record can be read from its
offset alone given the first frame.

Of records with equal payloads of at least ``LEAST_REVISIT`` bytes, the one with the largest
page_id is a response and the others are revisits of it, without the payload; a revisit
keeps the payload's digest and length in its header. The digests of such payloads are
counted first (only digests that occur twice come out), so a payload that a third of the
pages share moves as often as any other.

A task writes archives of bounded size under fresh names and returns them as rows; these
are kept as a table, so files of a failed attempt are never read. Files are written and
read through ``pyarrow.fs``: the folder may be any file system it knows.

Defined cases: a null html is an empty payload; a null url leaves out the target header;
control characters in a url are percent-encoded. A null page_id is smaller than any. Rows
that repeat the largest page_id of equal payloads are responses all. An empty table makes
no archive.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitval.llm.common import hash_order, read, share_for
from pitval.session import materialize, scratch_path

LEAST_REVISIT = 1000
DICTIONARY_FRAME = 0x184D2A5D
DICTIONARY_BYTES = 64 << 10
#: Records, and bytes of each, that the dictionary is built from.
SAMPLE_RECORDS = 500
SAMPLE_BYTES = 16 << 10
ARCHIVE_BYTES = 32 << 20
READ_BYTES = 64 << 10
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"


def record_id(page_id: int | None) -> str:
    return "<urn:page:null>" if page_id is None else f"<urn:page:{page_id}>"


def page_of(record: str | None) -> int | None:
    name = (record or "").removeprefix("<urn:page:").removesuffix(">")
    return int(name) if name.removeprefix("-").isdigit() else None


def target(url: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC/1.1 record, uncompressed."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {target(url)}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: {record_id(refers_to)}")
    head.append("Content-Type: application/http; msgtype=response")
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """Kind, page, length and digest of the full payload, page referred to, and the payload (None for a revisit)."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    revisit = fields["WARC-Type"] == "revisit"
    size = next(int(line.split(b": ")[1]) for line in http.split(b"\r\n") if line.startswith(b"Content-Length: "))
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    if not revisit and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"the payload of {fields['WARC-Record-ID']} is damaged")
    return {
        "page_id": page_of(fields["WARC-Record-ID"]), "payload_bytes": size, "payload_digest": digest,
        "record_type": fields["WARC-Type"], "refers_to": page_of(fields.get("WARC-Refers-To")), "payload": None if revisit else payload,
    }


def build_dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary, or the samples themselves where there is too little to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def loaded(dictionary: bytes) -> zstandard.ZstdCompressionDict:
    return zstandard.ZstdCompressionDict(dictionary)


def place(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a uri; Hadoop's names of a store are turned into those of ``pyarrow.fs``."""
    if uri.startswith(("s3a://", "s3n://")):
        uri = "s3" + uri[3:]
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


class Archive:
    """An open archive; records are appended as frames."""

    def __init__(self, folder: str, dictionary: bytes):
        self.uri = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        system, path = place(self.uri)
        system.create_dir(path.rpartition("/")[0], recursive=True)
        self.out = system.open_output_stream(path)
        self.out.write(struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary)
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=loaded(dictionary))
        self.size, self.records = 8 + len(dictionary), 0

    def add(self, raw: bytes) -> None:
        frame = self.compressor.compress(raw)
        self.out.write(frame)
        self.size += len(frame)
        self.records += 1


def read_archive(uri: str) -> Iterator[bytes]:
    """The records of an archive in order."""
    system, path = place(uri)
    with system.open_input_stream(path) as source:
        magic, size = struct.unpack("<II", source.read(8))
        if magic != DICTIONARY_FRAME:
            raise ValueError(f"{uri} does not begin with a dictionary")
        decompressor = zstandard.ZstdDecompressor(dict_data=loaded(source.read(size)))
        data = source.read(READ_BYTES)
        while data:
            frame = decompressor.decompressobj()
            parts = []
            while True:
                parts.append(frame.decompress(data))
                if frame.eof:
                    data = frame.unused_data or source.read(READ_BYTES)
                    break
                data = source.read(READ_BYTES)
                if not data:
                    raise ValueError(f"{uri} ends within a record")
            yield b"".join(parts)


def with_references(pages: DataFrame) -> DataFrame:
    """page_id, url, html, and for revisits the page that holds the payload."""
    chosen = pages.select("page_id", F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    chosen = chosen.withColumn("digest", F.sha1(F.col("html").cast("binary")))
    shared = (
        chosen.where(F.octet_length("html") >= LEAST_REVISIT)
        .groupBy("digest")
        .agg(F.count("*").alias("copies"), F.max("page_id").alias("held_by"))
        .where("copies > 1")
        .select("digest", "held_by")
    )
    revisit = F.col("held_by").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("held_by"))
    return chosen.join(shared, "digest", "left").select(
        F.col("page_id").cast("long").alias("page_id"), "url", "html", F.when(revisit, F.col("held_by")).cast("long").alias("refers_to")
    )


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Archives ``pages`` in ``folder``; (path, records, bytes) of every archive, as a written table."""
    place_of = hash_order("page_id", "url")
    few = pages.where(place_of < share_for(SAMPLE_RECORDS, pages.count()))
    sample = few.select("page_id", "url", F.substring("html", 1, SAMPLE_BYTES).alias("html")).orderBy(place_of, "page_id", "url").limit(SAMPLE_RECORDS)
    samples = [record(r["page_id"], r["url"], (r["html"] or "").encode(), None, False) for r in sample.collect()]
    dictionary = build_dictionary(samples)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = None

        def closed() -> pa.RecordBatch:
            archive.out.close()
            return pa.RecordBatch.from_pydict({"path": [archive.uri], "records": [archive.records], "bytes": [archive.size]})

        for batch in batches:
            for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if archive is None:
                    archive = Archive(folder, dictionary)
                archive.add(record(page_id, url, html.encode(), refers_to, refers_to is not None))
                if archive.size >= ARCHIVE_BYTES:
                    yield closed()
                    archive = None
        if archive is not None:
            yield closed()

    made = with_references(pages).mapInArrow(work, "path string, records bigint, bytes bigint")
    return materialize(made, "warc-archives")


def read_archives(archives: DataFrame) -> DataFrame:
    """A row for every record of the archives, without its payload."""
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows: list[dict] = []
                for raw in read_archive(path):
                    rows.append(parse(raw))
                    rows[-1].pop("payload")
                    if len(rows) == 5000:
                        yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds, strict=True)], names)
                        rows = []
                yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds, strict=True)], names)

    # One archive a task: a row is a whole file's work.
    spread = archives.repartition(max(1, archives.count()), "path").select("path")
    return spread.mapInArrow(work, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint")


def op5(spark: SparkSession, folder: str) -> DataFrame:
    pages = read(spark, folder, "pages")
    return read_archives(write_archives(pages, scratch_path(spark, "warc")))


SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest FROM p),
g AS (SELECT payload_digest, max(page_id) AS held_by FROM d WHERE payload_bytes >= {LEAST_REVISIT} GROUP BY 1 HAVING count(*) > 1)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN held_by IS NULL OR held_by = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN held_by <> page_id THEN held_by END AS refers_to
FROM d LEFT JOIN g USING (payload_digest)
"""
