"""Web archives whose records are compressed one by one with a shared dictionary.

Each archive file opens with a skippable Zstandard frame that holds a dictionary;
every record is a frame of its own behind it, so a record can be read alone once
the dictionary is known. The dictionary is built from a bounded sample of the
archived payloads. Spark's text writer puts the frames into files: the bytes of a
frame are a row, and the line separator is an empty skippable frame, which readers
of Zstandard pass over. So files are committed like any other Spark output, on any
file system, and a task that runs again leaves no second copy.

Of equal payloads of 1,000 bytes or more, the page with the largest id is archived
whole and the others as revisits of it.

Defined results: a NULL html is an empty payload; a NULL url becomes an empty one; a
NULL page_id has no id header and comes back as NULL; pages that repeat the largest
id are responses as well.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.samples import bounded
from larder.llm.text import slices
from larder.sources.storage import Scratch

REVISIT_BYTES = 1000
# The dictionary is built from at most so many records, of at most so many bytes each.
SAMPLE_RECORDS = 2_000
SAMPLE_BYTES = 16_384
DICTIONARY_BYTES = 65_536
LEVEL = 3
READ_BYTES = 1 << 14

# Frame numbers of the Zstandard format. 0x184D2A5D marks a dictionary.
DICTIONARY_FRAME = 0x184D2A5D
EMPTY_FRAME = struct.pack("<II", 0x184D2A50, 0)
DATE = "2020-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMES = uuid.UUID("6f0e6a2c-52c5-4a8e-9d0a-0d1b6a7c9e11")

RECORDS = (
    "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"
)


def record_name(page: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMES, f'{page} {digest}')}>"


def record(page: int | None, url: str, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC 1.1 record. A revisit has the headers of its page, but not the payload."""
    digest = hashlib.sha1(payload)
    label = "sha1:" + base64.b32encode(digest.digest()).decode()
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_name(page, digest.hexdigest())),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", "".join(url.split())),
        ("WARC-Payload-Digest", label),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if page is not None:
        fields.append(("X-Page-Id", str(page)))
    if revisit:
        fields.append(("WARC-Profile", REVISIT_PROFILE))
        fields.append(("WARC-Refers-To", record_name(refers_to, digest.hexdigest())))
        fields.append(("X-Refers-To-Page", str(refers_to)))
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def parsed(data: bytes) -> tuple:
    """The row of RECORDS that a record holds."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    revisit = fields["WARC-Type"] == "revisit"
    if revisit:
        size = int(http.rpartition(b"Content-Length: ")[2])
        digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
        payload = None
    else:
        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
    page, target = fields.get("X-Page-Id"), fields.get("X-Refers-To-Page")
    return (
        None if page is None else int(page), fields["WARC-Target-URI"], payload, size, digest, fields["WARC-Type"],
        None if target is None else int(target),
    )


def build_dictionary(pages: DataFrame) -> bytes:
    """A dictionary from a bounded sample, chosen by a hash; empty if there is too little to learn from."""
    import zstandard

    some = pages.select("page_id", F.substring("html", 1, SAMPLE_BYTES).alias("html")).filter(F.length("html") > 0)
    some = bounded(some, F.xxhash64("page_id", "html"), SAMPLE_RECORDS, pages.count()).collect()
    samples = [record(r.page_id, "", r.html.encode(), None, False) for r in some]
    try:
        size = min(DICTIONARY_BYTES, max(256, sum(map(len, samples)) // 8))
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def archived(pages: DataFrame) -> DataFrame:
    """page_id, url, html, refers_to, revisit: what becomes of each page."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long"), F.coalesce("url", F.lit("")).alias("url"), html.alias("html"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("html", 256)))
    copies = (
        rows.filter(F.octet_length("html") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.max("page_id").alias("winner"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("digest", "winner")
    )
    met = rows.join(copies, "digest", "left")
    revisit = F.col("winner").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("winner"))
    return met.select("page_id", "url", "html", F.when(revisit, F.col("winner")).alias("refers_to"), revisit.alias("revisit"))


def write_archives(pages: DataFrame, path: str) -> None:
    """Write a folder of archive files, each a dictionary frame and one frame per record."""
    dictionary = build_dictionary(pages)

    def frames(batches):
        import zstandard

        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_content_size=True)
        opening = struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary
        for batch in batches:
            for part in slices(batch, "html"):
                rows = zip(*(part.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to", "revisit")))
                out = [compressor.compress(record(p, u, h.encode(), to, again)) for p, u, h, to, again in rows]
                if opening and out:
                    out, opening = [opening, *out], b""
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["frame"])

    framed = archived(pages).mapInArrow(frames, "frame binary")
    # A text column takes any bytes; only what reads it as text would mind.
    lines = framed.select(F.col("frame").cast("string").alias("value"))
    lines.write.option("lineSep", EMPTY_FRAME.decode()).text(path)


def frames_of(data: bytes):
    """Records of one archive file, whose frames are read one after the other."""
    import zstandard

    at, dictionary = 0, None
    while at < len(data):
        number, size = struct.unpack_from("<II", data, at)
        if number & 0xFFFFFFF0 == 0x184D2A50:
            if number == DICTIONARY_FRAME and at == 0 and size:
                dictionary = zstandard.ZstdCompressionDict(data[8 : 8 + size])
            at += 8 + size
            continue
        decompressor, out = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj(), []
        while not decompressor.eof:
            if at >= len(data):
                raise ValueError("the last record of an archive is cut off")
            piece = data[at : at + READ_BYTES]
            out.append(decompressor.decompress(piece))
            at += len(piece) - len(decompressor.unused_data)
        yield b"".join(out)


def read_archives(spark, path: str) -> DataFrame:
    """A row of RECORDS for each record in a folder of archive files."""

    def run(batches):
        for batch in batches:
            for data in batch.column("content"):
                rows, size = [], 0
                for found in frames_of(data.as_py()):
                    rows.append(parsed(found))
                    size += len(found)
                    if size > (4 << 20):
                        yield _records(rows)
                        rows, size = [], 0
                yield _records(rows)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.filter("length > 0").select("content").mapInArrow(run, RECORDS)


def _records(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64())
    columns = list(zip(*rows)) or [[]] * len(kinds)
    names = [field.split()[0] for field in RECORDS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def round_trip(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """Write archives, read them back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    path = scratch.path("archives")
    write_archives(pages, path)
    return read_archives(pages.sparkSession, path).drop("url", "payload")
