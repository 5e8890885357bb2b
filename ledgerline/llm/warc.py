"""WARC archives under Zstandard: one frame per record, an optional dictionary in a leading skippable frame.

An archive is a value of a binary column, `archive` naming it: so writer and reader work on any store that Spark
reads and writes. `spark.read.format("binaryFile")` gives the same shape (path, content) for archives kept as files.
"""
from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

# Fixed values of the formats.
SKIPPABLE = 0x184D2A5D            # magic number of the frame that holds the dictionary
FRAME = 0xFD2FB528
DICTIONARY = 0xEC30A437
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
REQUIRED = ("WARC-Record-ID", "WARC-Type", "WARC-Date", "Content-Length")


class BadArchive(ValueError):
    """An archive or a record that breaks the format."""


def record_id(page: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMES, f'page:{page}')}>"


def base32_digest(hexadecimal: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hexadecimal)).decode()


def _clean(value: str) -> str:
    """A header value on one line."""
    return " ".join(value.split())


def make_record(page: int, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response with its payload, or a revisit, which has the HTTP header only."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    headers = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_id(page)),
               ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Target-URI", _clean(url or f"urn:page:{page}")),
               ("WARC-Payload-Digest", base32_digest(digest)), ("Content-Type", "application/http;msgtype=response"),
               ("X-Page-Id", str(page))]
    if refers_to is not None:
        headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to)),
                    ("X-Refers-To-Page-Id", str(refers_to))]
    headers.append(("Content-Length", str(len(block))))
    head = VERSION + b"\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in headers) + b"\r\n"
    return head + block + b"\r\n\r\n"


def train(samples: list[bytes], size: int = 16_384) -> bytes | None:
    """A dictionary from some records, None if there are too few to learn from."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return None


def pack(records: list[bytes], samples: int = 200) -> bytes:
    """An archive: dictionary of the first `samples` records, then a frame per record."""
    dictionary = train([r[:4096] for r in records[:samples]])
    out = []
    if dictionary:
        out.append(struct.pack("<II", SKIPPABLE, len(dictionary)) + dictionary)
    packer = zstandard.ZstdCompressor(level=3, write_checksum=True, write_content_size=True,
                                      dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    out += [packer.compress(r) for r in records]
    return b"".join(out)


def frame_end(data: memoryview, at: int) -> int:
    """Where the frame that begins at `at` ends, from its block headers."""
    try:
        parameters = zstandard.get_frame_parameters(data[at:at + 18])
        place = at + zstandard.frame_header_size(data[at:at + 18])
    except zstandard.ZstdError as e:
        raise BadArchive(f"no frame at byte {at}: {e}") from e
    last = False
    while not last:
        if place + 3 > len(data):
            raise BadArchive(f"the frame at byte {at} is cut off")
        head = int.from_bytes(data[place:place + 3], "little")
        last, kind, size = bool(head & 1), head >> 1 & 3, head >> 3
        if kind == 3:
            raise BadArchive(f"the frame at byte {at} has a block of unknown type")
        place += 3 + (1 if kind == 1 else size)
    place += 4 if parameters.has_checksum else 0
    if place > len(data):
        raise BadArchive(f"the frame at byte {at} is cut off")
    return place


def load_dictionary(data: memoryview) -> tuple[zstandard.ZstdCompressionDict | None, int]:
    """The dictionary of the leading skippable frame, plain or itself a frame, and where the records begin."""
    if len(data) < 8 or struct.unpack("<I", data[:4])[0] != SKIPPABLE:
        return None, 0
    size = struct.unpack("<I", data[4:8])[0]
    if 8 + size > len(data):
        raise BadArchive("the dictionary is cut off")
    raw = bytes(data[8:8 + size])
    if raw[:4] == struct.pack("<I", FRAME):
        raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
    if raw[:4] != struct.pack("<I", DICTIONARY):
        raise BadArchive("the leading frame holds no dictionary")
    return zstandard.ZstdCompressionDict(raw), 8 + size


def parse_record(record: bytes) -> dict:
    """Headers, HTTP header and payload of one record, after checks of version, headers, lengths and digest."""
    head, found, rest = record.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not found or lines[0] not in (b"WARC/1.0", b"WARC/1.1"):
        raise BadArchive("no WARC version line")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.decode("utf-8").partition(":")
        if not colon:
            raise BadArchive("a header line has no colon")
        headers[name.strip().lower()] = value.strip()
    missing = [k for k in REQUIRED if k.lower() not in headers]
    if missing:
        raise BadArchive(f"missing header {missing[0]}")
    if not headers["content-length"].isdigit() or len(rest) != int(headers["content-length"]) + 4:
        raise BadArchive("Content-Length is not the length of the block")
    if rest[-4:] != b"\r\n\r\n":
        raise BadArchive("the record doesn't end with two line ends")
    http, found, payload = rest[:-4].partition(b"\r\n\r\n")
    declared = next((x.split(b":")[1].strip() for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")), b"")
    if not found or not declared.isdigit():
        raise BadArchive("the block has no HTTP header with a length")
    kind = headers["warc-type"]
    if kind == "response" and int(declared) != len(payload):
        raise BadArchive("the payload hasn't the declared length")
    if kind == "revisit" and payload:
        raise BadArchive("a revisit has a payload")
    digest = headers.get("warc-payload-digest", "")
    try:
        hexadecimal = base64.b32decode(digest.removeprefix("sha1:")).hex()
    except ValueError as e:
        raise BadArchive("the payload digest can't be read") from e
    if kind == "response" and hashlib.sha1(payload).hexdigest() != hexadecimal:
        raise BadArchive("the payload hasn't the declared digest")
    return {"headers": headers, "type": kind, "payload": payload, "declared": int(declared), "digest": hexadecimal}


def unpack(archive: bytes) -> Iterator[tuple[int, dict | None, str | None]]:
    """(offset, record, error) for each frame. A bad record is passed over; a break in the frames ends the archive."""
    data = memoryview(archive)
    try:
        dictionary, at = load_dictionary(data)
    except (BadArchive, zstandard.ZstdError) as e:
        yield 0, None, str(e)
        return
    opener = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    while at < len(data):
        try:
            end = frame_end(data, at)
        except BadArchive as e:
            yield at, None, str(e)
            return
        try:
            record = opener.decompressobj().decompress(data[at:end])
            yield at, parse_record(record), None
        except (BadArchive, zstandard.ZstdError, UnicodeDecodeError) as e:
            yield at, None, str(e)
        at = end


def mark_revisits(pages: DataFrame, least: int = 1000) -> DataFrame:
    """`page_id`, `url`, `payload`, `digest` (SHA-1), `refers_to` (null for responses).

    Of equal payloads of at least `least` bytes the one with the largest page_id is the response. Rows that
    repeat that page_id with the same payload are responses too. Rows without a page_id are responses.
    Null html is an empty payload; a very long one is one value of a task, and its record one frame. An empty table gives an
    empty table; other columns are not looked at. The largest ids are found by an aggregate that combines before its shuffle;
    only digests that occur more than once are joined back.
    """
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    named = pages.select("page_id", "url", html.alias("payload"))
    same = F.sha2("payload", 256)
    owners = (named.where((F.octet_length("payload") >= least) & F.col("page_id").isNotNull())
              .groupBy(same.alias("same")).agg(F.max("page_id").alias("owner"), F.count("*").alias("n"))
              .where("n > 1").select("same", "owner"))
    return (named.withColumn("same", same).join(owners, "same", "left")
            .select("page_id", "url", "payload", F.sha1("payload").alias("digest"),
                    F.when(F.col("page_id") < F.col("owner"), F.col("owner")).alias("refers_to")))


def write_archives(pages: DataFrame, archive_bytes: int = 8_000_000) -> DataFrame:
    """`archive`, `content` from the rows of `mark_revisits`: archives of about `archive_bytes` of records each.

    A page without an id has the id -1 in its record.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def close() -> pa.RecordBatch:
            content = pack(held)
            name = hashlib.sha256(content).hexdigest()[:32] + ".warc.zst"
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([content], pa.binary())], ["archive", "content"])

        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "digest", "refers_to")]
            for i in range(batch.num_rows):
                page, url, payload, digest, refers = (c[i].as_py() for c in columns)
                held.append(make_record(-1 if page is None else page, url, payload, digest, refers))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield close()
                    held, size = [], 0
        if held:
            yield close()

    return pages.mapInArrow(run, "archive string, content binary")


def read_archives(archives: DataFrame, name_col: str = "archive", content_col: str = "content") -> DataFrame:
    """One row per record: `archive`, `offset`, `page_id`, `url`, `record_type`, `payload`, `payload_bytes`,
    `payload_digest` (hex), `refers_to`, `error`. A record that fails a check has its error and nulls; an archive
    that is cut off has one row with the error where it breaks. Null contents have no records.
    """
    names = ["archive", "offset", "page_id", "url", "record_type", "payload", "payload_bytes", "payload_digest",
             "refers_to", "error"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(),
             pa.int64(), pa.string()]

    def number(value: str | None) -> int | None:
        return int(value) if value and value.removeprefix("-").isdigit() else None

    def rows(name: str, content: bytes) -> Iterator[tuple]:
        for offset, record, error in unpack(content):
            if record is None:
                yield (name, offset, *[None] * 7, error)
                continue
            h = record["headers"]
            page = number(h.get("x-page-id"))
            yield (name, offset, None if page == -1 else page, h.get("warc-target-uri"), record["type"],
                   record["payload"], record["declared"], record["digest"], number(h.get("x-refers-to-page-id")), None)

    def table(held: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*held)) if held else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("archive"), batch.column("content")):
                held = []
                for row in rows(name.as_py(), content.as_py() or b""):
                    held.append(row)
                    if len(held) == 256:
                        yield table(held)
                        held = []
                yield table(held)

    return archives.select(F.col(name_col).alias("archive"), F.col(content_col).alias("content")).mapInArrow(
        run, "archive string, offset long, page_id long, url string, record_type string, payload binary, "
             "payload_bytes long, payload_digest string, refers_to long, error string")
