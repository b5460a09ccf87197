"""WARC archives compressed with Zstandard: one frame per record, dictionary in front.

An archive begins with a skippable frame (magic 0x184D2A5D) that holds the
dictionary, raw or compressed; each record is a frame of its own.  Spark's text
writer writes the archives, so that files appear only when their task commits:
the line end it adds after every row is the content of a skippable frame of one
byte, whose header ends the row.  Spark's binary file reader reads them back.

Records with equal payloads are stored once: the one with the largest page_id
is a response, the others are revisits that refer to it and have no payload.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DICTIONARY_MAGIC, FRAME_MAGIC, TRAINED_MAGIC = 0x184D2A5D, 0xFD2FB528, 0xEC30A437
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
#: Ends a row: header of a skippable frame of one byte, which the writer's line end fills.
ROW_END = struct.pack("<II", 0x184D2A50, 1)

#: Records per archive, and the records at its start and bytes that its dictionary is trained on.
ARCHIVE_RECORDS = 8192
SAMPLE_RECORDS, DICTIONARY_BYTES, LEVEL = 128, 16 << 10, 3
#: No clock is read: the date of capture is the caller's.
DATE = "2026-01-01T00:00:00Z"

MANDATORY = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")


def base32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def header_text(value: str) -> str:
    """A header's value on one line: control characters are percent-encoded."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in value)


def record(page_id: int | None, url: str | None, payload: bytes, sha1: str, refers_to: int | None, revisit: bool) -> bytes:
    """A record: version, headers, empty line, block, two line ends."""
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        *([f"WARC-Target-URI: {header_text(url)}"] if url is not None else []),
        f"WARC-Payload-Digest: sha1:{sha1}",
    ]
    block = payload
    if revisit:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:page:{refers_to}>",
            f"X-Payload-Length: {len(payload)}",
        ]
        block = b""
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def dictionary_of(samples: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Dictionary trained on records; too few or too short ones are the dictionary themselves."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(samples)[:DICTIONARY_BYTES] or b"WARC/1.1", dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def _archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of archives from rows of pages: a dictionary, then a frame per record, as often as archives fill."""
    compressor, written, waiting = None, 0, []

    def begin() -> list[bytes]:
        nonlocal compressor, written
        dictionary = dictionary_of(waiting)
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_content_size=True)
        head = zstandard.ZstdCompressor(level=LEVEL).compress(dictionary.as_bytes())
        rows = [struct.pack("<II", DICTIONARY_MAGIC, len(head)) + head, *map(compressor.compress, waiting)]
        written = len(waiting)
        waiting.clear()
        return rows

    def batch(rows: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r + ROW_END for r in rows], pa.binary())], ["row"])

    for b in batches:
        rows: list[bytes] = []
        for page_id, url, payload, sha1, refers_to, revisit in zip(*(b.column(i).to_pylist() for i in range(6)), strict=True):
            one = record(page_id, url, payload, base32(bytes.fromhex(sha1)), refers_to, revisit)
            if written == ARCHIVE_RECORDS:
                compressor = None
                written = 0
            if compressor:
                rows.append(compressor.compress(one))
                written += 1
            else:
                waiting.append(one)
                if len(waiting) == min(SAMPLE_RECORDS, ARCHIVE_RECORDS):
                    rows += begin()
            if len(rows) >= 1024:
                yield batch(rows)
                rows = []
        if rows:
            yield batch(rows)
    if waiting:
        yield batch(begin())


def revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, sha1, refers_to and revisit of every page.

    Of equal payloads, the row with the largest page_id is the response; rows
    that share that id too are all responses.  A null page_id is smaller than
    any number.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("sha1", F.sha1("payload"))
    first = rows.groupBy("sha1").agg(F.max("page_id").alias("refers_to"))
    revisit = ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    return rows.join(first, "sha1").select(
        "page_id", "url", "payload", "sha1", F.when(revisit, F.col("refers_to")).alias("refers_to"), revisit.alias("revisit")
    )


def write_archives(pages: DataFrame, folder: str) -> None:
    """Write all pages as archives into ``folder``; a task's archives appear together when it ends."""
    frames = revisits(pages).mapInArrow(_archives, "row binary")
    (
        frames.select(F.col("row").cast("string").alias("value"))
        .write.option("maxRecordsPerFile", ARCHIVE_RECORDS + 1)
        .option("compression", "none")
        .text(folder)
    )


class BadArchive(ValueError):
    """An archive or record that breaks the format."""


def frames(data: memoryview) -> Iterator[tuple[int, memoryview]]:
    """Magic number and bytes of every frame, by the lengths that frames and their blocks state."""
    at = 0
    while at < len(data):
        if at + 8 > len(data):
            raise BadArchive(f"{len(data) - at} bytes after the last frame")
        (magic,) = struct.unpack_from("<I", data, at)
        if magic in SKIPPABLE:
            end = at + 8 + struct.unpack_from("<I", data, at + 4)[0]
        elif magic == FRAME_MAGIC:
            end = _frame_end(data, at)
        else:
            raise BadArchive(f"no frame at byte {at}")
        if end > len(data):
            raise BadArchive(f"the frame at byte {at} is cut off")
        yield magic, data[at:end]
        at = end


def _frame_end(data: memoryview, at: int) -> int:
    """End of a Zstandard frame: its header, its blocks by their headers, its checksum if it has one."""
    flags = data[at + 4]
    single, checksum = flags >> 5 & 1, flags >> 2 & 1
    end = at + 5 + (not single) + (0, 1, 2, 4)[flags & 3] + ((1 if single else 0), 2, 4, 8)[flags >> 6]
    last = False
    while not last:
        if end + 3 > len(data):
            raise BadArchive(f"the frame at byte {at} is cut off")
        head = data[end] | data[end + 1] << 8 | data[end + 2] << 16
        last, kind, size = bool(head & 1), head >> 1 & 3, head >> 3
        if kind == 3:
            raise BadArchive(f"a block of the frame at byte {at} is of an unknown kind")
        end += 3 + (1 if kind == 1 else size)
    return end + 4 * checksum


def load_dictionary(frame: memoryview) -> zstandard.ZstdCompressionDict:
    """Dictionary of the leading skippable frame: as it is, or compressed as a frame."""
    content = bytes(frame[8:])
    if len(content) >= 4 and struct.unpack_from("<I", content)[0] == FRAME_MAGIC:
        content = zstandard.ZstdDecompressor().decompress(content)
    trained = len(content) >= 4 and struct.unpack_from("<I", content)[0] == TRAINED_MAGIC
    return zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT)


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record; its version, headers and lengths are validated."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not gap or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise BadArchive("no version or no end of the headers")
    pairs = [line.partition(":") for line in lines[1:]]
    if not all(colon and name.strip() == name and name for name, colon, _ in pairs):
        raise BadArchive("a header line without a name")
    headers = {name.lower(): value.strip() for name, _, value in pairs}
    if missing := [name for name in MANDATORY if name.lower() not in headers]:
        raise BadArchive(f"missing headers: {', '.join(missing)}")
    length = headers["content-length"]
    if not (length.isascii() and length.isdigit()) or int(length) + 4 != len(rest) or rest[-4:] != b"\r\n\r\n":
        raise BadArchive(f"the block isn't of {length} bytes and two line ends")
    return headers, rest[:-4]


def page_of(urn: str) -> int | None:
    number = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def read_records(content: bytes | memoryview) -> Iterator[dict]:
    """Records of one archive as rows; raises BadArchive at the first fault."""
    walk = frames(memoryview(content))
    try:
        magic, first = next(walk)
    except StopIteration:
        return
    if magic != DICTIONARY_MAGIC:
        raise BadArchive("no dictionary in front")
    decompressor = zstandard.ZstdDecompressor(dict_data=load_dictionary(first))
    for magic, frame in walk:
        if magic in SKIPPABLE:
            continue
        try:
            headers, block = parse(decompressor.decompress(frame))
        except zstandard.ZstdError as error:
            raise BadArchive(f"a frame can't be decoded: {error}") from error
        revisit = headers["warc-type"] == "revisit"
        stated = headers.get("warc-payload-digest", "").removeprefix("sha1:")
        if not revisit and stated != base32(hashlib.sha1(block).digest()):
            raise BadArchive(f"the digest of {headers['warc-record-id']} differs")
        yield {
            "page_id": page_of(headers["warc-record-id"]),
            "url": headers.get("warc-target-uri"),
            "payload": None if revisit else block,
            "payload_bytes": int(headers["x-payload-length"]) if revisit else len(block),
            "payload_digest": stated,
            "record_type": headers["warc-type"],
            "refers_to": page_of(headers["warc-refers-to"]) if revisit else None,
        }


FIELDS = [("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
SCHEMA = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _reader(payloads: bool):
    schema = pa.schema([f for f in FIELDS if payloads or f[0] != "payload"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                rows = []
                try:
                    for row in read_records(memoryview(content.as_buffer()).cast("B")):
                        rows.append(row if payloads else {k: v for k, v in row.items() if k != "payload"})
                        if len(rows) == 512:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows = []
                except BadArchive as error:
                    raise BadArchive(f"{path}: {error}") from error
                yield pa.RecordBatch.from_pylist(rows, schema)

    return read


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """Records of all archives of a folder; a fault in any fails the job with the file's name.

    Without ``payloads`` they are decoded and checked, but not returned.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("path", "content")
    schema = SCHEMA if payloads else SCHEMA.replace("payload binary, ", "")
    return files.mapInArrow(_reader(payloads), schema)
