"""WARC archives of Zstandard frames: one frame a record, the dictionary in a leading skippable frame.

An archive is one value of a binary column, as spark.read.format("binaryFile") gives for files, so any store that Spark can
read serves. The writer turns rows into archives of bounded size, all with the one dictionary of the write; save() puts such
archives into files.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LARGE_ROWS, fits, in_batches, written

#: Magic number of the skippable frame that holds a dictionary, and of a plain frame (fixed values, little-endian).
DICT_MAGIC, FRAME_MAGIC = 0x184D2A5D, 0xFD2FB528
#: Bytes of records before compression after which an archive ends; a single larger record makes a larger archive.
ARCHIVE_BYTES = 8 << 20
#: Rows that the dictionary of a write is trained on, the bytes of each that count, and the bytes of the dictionary.
SAMPLE_ROWS, SAMPLE_BYTES, DICT_BYTES = 256, 4 << 10, 16 << 10
#: Largest record that the reader expands unless told otherwise; a frame header that states more is an error.
MAX_RECORD = 1 << 30
#: Bytes of an archive that the decoder gets at a time, so that what lies behind a frame is never copied as a whole.
STEP = 64 << 10
#: Digests of several rows (some 60 bytes each) up to which they are broadcast; more are dealt by digest and salt.
BROADCAST_DIGESTS, SALTS = 100_000, 16
#: Archives have no wall-clock time in them, so that equal input gives equal bytes.
DATE = "2020-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NEEDED = ("warc-type", "warc-record-id", "warc-date", "content-length")


class WarcError(ValueError):
    pass


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, str(page_id))}>"


def record(page_id: int | None, url: str | None, payload: bytes, size: int, digest: str, refers_to: int | None) -> bytes:
    """One WARC record: a response with its payload, or a revisit (payload empty, size and digest of the full one)."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url is not None else None),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"),
        ("WARC-Profile", PROFILE if revisit else None),
        ("WARC-Refers-To", record_id(refers_to) if revisit else None),
        ("X-Page-ID", page_id),
        ("X-Refers-To-Page-ID", refers_to),
        ("X-Payload-Length", size),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(block)),
    ]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head if v is not None)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def dictionary(records: list[bytes]) -> bytes:
    """A dictionary trained on records; where they are too few or too much alike, their first bytes as plain content."""
    try:
        return zstandard.train_dictionary(DICT_BYTES, records).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(records)[:DICT_BYTES]


def compress(records: list[bytes], trained: bytes, level: int = 3) -> bytes:
    """An archive: a skippable frame with the dictionary (itself compressed), then a frame a record."""
    tool = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(trained), write_content_size=True, write_checksum=True)
    packed = zstandard.ZstdCompressor(level=level).compress(trained)
    return b"".join([struct.pack("<II", DICT_MAGIC, len(packed)), packed, *map(tool.compress, records)])


def frames(archive: bytes, max_record: int = MAX_RECORD) -> Iterator[bytes]:
    """The content of each frame. WarcError where a frame is broken, cut off, or states no length or more than max_record. The
    archive is read once, in steps, so the time is in proportion to its bytes however many frames it has."""
    at, view, loaded = 0, memoryview(archive), None
    if len(archive) >= 8 and struct.unpack_from("<I", archive)[0] == DICT_MAGIC:
        size = struct.unpack_from("<I", archive, 4)[0]
        if 8 + size > len(archive):
            raise WarcError("the dictionary frame is cut off")
        data, at = bytes(view[8 : 8 + size]), 8 + size
        if data[:4] == struct.pack("<I", FRAME_MAGIC):  # the dictionary may be compressed itself
            try:
                data = zstandard.ZstdDecompressor().decompress(data, max_output_size=max_record)
            except zstandard.ZstdError as e:
                raise WarcError(f"the dictionary can't be read: {e}") from None
        loaded = zstandard.ZstdCompressionDict(data)
    tool = zstandard.ZstdDecompressor(dict_data=loaded) if loaded else zstandard.ZstdDecompressor()
    while at < len(archive):
        if len(archive) - at < 8:
            raise WarcError("bytes after the last frame")
        magic, size = struct.unpack_from("<II", archive, at)
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            if at + 8 + size > len(archive):
                raise WarcError("a skippable frame is cut off")
            at += 8 + size
            continue
        try:
            stated = zstandard.get_frame_parameters(view[at : at + 18]).content_size
            if stated > max_record:  # as an unknown size also is
                raise WarcError(f"frame states {stated} bytes")
            one, parts, fed = tool.decompressobj(), [], at
            while not one.eof and fed < len(archive):
                parts.append(one.decompress(view[fed : fed + STEP]))
                fed = min(fed + STEP, len(archive))
        except zstandard.ZstdError as e:
            raise WarcError(f"frame at {at}: {e}") from None
        content = b"".join(parts)
        if not one.eof or len(content) != stated:
            raise WarcError(f"frame at {at} is cut off")
        at = fed - len(one.unused_data)
        yield content


def parse(content: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of one record; WarcError if they are malformed or lengths or digests differ."""
    head, gap, rest = content.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8", "replace").split("\r\n")
    if not gap or not re.fullmatch(r"WARC/1\.[01]", first):
        raise WarcError("no WARC header")
    headers: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon or not re.fullmatch(r"[!#$%&'*+.^_`|~0-9A-Za-z-]+", name):
            raise WarcError(f"malformed header line {line[:80]!r}")
        if name.lower() in headers and name.lower() != "warc-concurrent-to":
            raise WarcError(f"header {name} twice")
        headers[name.lower()] = value.strip(" \t")
    if missing := [n for n in NEEDED if n not in headers]:
        raise WarcError(f"headers missing: {', '.join(missing)}")
    if not re.fullmatch(r"[0-9]+", headers["content-length"]) or int(headers["content-length"]) + 4 != len(rest) or rest[-4:] != b"\r\n\r\n":
        raise WarcError("Content-Length and block differ")
    block = rest[:-4]
    if (stated := headers.get("warc-block-digest", "")).startswith("sha1:") and stated[5:] != sha1_base32(block):
        raise WarcError("WARC-Block-Digest and block differ")
    return headers, block


def read_record(content: bytes) -> dict:
    """What a record says of its page; for responses, the payload and its size and digest are computed, not taken as stated."""
    headers, block = parse(content)
    kind, payload = headers["warc-type"], None
    number = lambda name: int(headers[name]) if re.fullmatch(r"-?[0-9]+", headers.get(name, "")) else None
    size, digest = number("x-payload-length"), headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
    if kind == "response":
        payload = block
        if headers.get("content-type", "").startswith("application/http"):
            http, gap, payload = block.partition(b"\r\n\r\n")
            if not gap or not http.startswith(b"HTTP/"):
                raise WarcError("no HTTP header in the block")
            stated = re.search(rb"(?mi)^content-length:[ \t]*([0-9]+)[ \t]*\r?$", http)
            if stated and int(stated[1]) != len(payload):
                raise WarcError("HTTP Content-Length and payload differ")
        found = sha1_base32(payload)
        if digest is not None and digest != found or size is not None and size != len(payload):
            raise WarcError("stated payload length or digest differ from the payload")
        size, digest = len(payload), found
    elif kind == "revisit" and (digest is None or size is None or "warc-refers-to" not in headers):
        raise WarcError("a revisit without digest, length or WARC-Refers-To")
    return {"page_id": number("x-page-id"), "url": headers.get("warc-target-uri"), "record_type": kind, "payload_bytes": size, "payload_digest": digest, "refers_to": number("x-refers-to-page-id"), "payload": payload}


def write_archives(
    df: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = 0, archive_bytes: int = ARCHIVE_BYTES, broadcast_digests: int = BROADCAST_DIGESTS
) -> DataFrame:
    """Archives (column content) with a record for each row.

    Of rows with equal payloads of at least `least` bytes, that with the smallest id is a response, the others revisit it;
    rows with shorter payloads are all responses. A null payload is empty. A null id is larger than any; rows that share the
    smallest id (repeated rows), or have only null ids, are all responses. A null URL leaves out its header; one with spaces
    or control characters is percent-encoded. Other columns are not written; an empty table gives no archives.

    Digests of several rows and their smallest ids come from a partial aggregation without payloads and are written. Up to
    broadcast_digests of them are broadcast, and payloads stay in the tasks that read them. More are joined by digest and
    salt, so that a digest which a third of all rows share meets its rows in SALTS tasks. Revisits drop their payload before
    Python sees it. Every archive of a write begins with the same dictionary, trained on SAMPLE_ROWS rows.
    """
    nothing = F.lit("").cast("binary")
    rows = df.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(payload_col).cast("binary"), nothing).alias("payload"))
    rows = rows.withColumns({"size": F.octet_length("payload").cast("long"), "sha1": F.unhex(F.sha1("payload"))})
    some = rows.select("page_id", "url", F.substring("payload", 1, SAMPLE_BYTES).alias("payload"), "size", "sha1").limit(SAMPLE_ROWS).collect()
    blank = record(None, None, b"", 0, sha1_base32(b""), None)
    trained = dictionary([blank, *(record(r.page_id, r.url, bytes(r.payload), r.size, base64.b32encode(r.sha1).decode(), None) for r in some)])
    # Only digests with several rows have anything to say.
    firsts = rows.where(F.col("size") >= least).groupBy("sha1").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 AND first IS NOT NULL")
    firsts = written(firsts.select("sha1", "first"), "warc-firsts")
    if fits(firsts, broadcast_digests):
        dealt = rows.join(F.broadcast(firsts), "sha1", "left")
    else:
        copies = firsts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        dealt = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")).join(copies.hint("merge"), ["sha1", "salt"], "left")
    again = F.when((F.col("size") >= least) & (F.col("page_id").isNull() | (F.col("page_id") > F.col("first"))), F.col("first"))
    dealt = dealt.select("page_id", "url", "size", "sha1", again.alias("refers_to"), F.when(again.isNull(), F.col("payload")).alias("payload"))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                page_id, url, n, sha1, refers_to, payload = (batch.column(k)[i].as_py() for k in range(6))
                held.append(record(page_id, url, payload or b"", n, base64.b32encode(sha1).decode(), refers_to))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([compress(held, trained)], pa.binary())], names=["content"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([compress(held, trained)], pa.binary())], names=["content"])

    return dealt.transform(in_batches, made, "content binary")


def read_archives(df: DataFrame, content_col: str = "content", payload: bool = True, max_record: int = MAX_RECORD) -> DataFrame:
    """A row for each record of the archives in content_col: page_id, url, record_type, payload_bytes, payload_digest,
    refers_to, payload (if asked for; null for revisits) and record_error.

    A record that fails validation is a row with record_error and nothing else; where a frame is broken, the rest of its
    archive can't be found and one such row stands for it; so does one for a record that states over max_record bytes.
    Archives without a leading dictionary are read as plain frames. Null or empty archives have no records. Other columns of
    df (a file's path, say) are repeated on each row, those named like results are replaced.
    """
    kinds = {"page_id": "long", "url": "string", "record_type": "string", "payload_bytes": "long", "payload_digest": "string", "refers_to": "long", **({"payload": "binary"} if payload else {}), "record_error": "string"}
    types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    keep = [c for c in df.columns if c not in kinds and c != content_col]
    schema = df.select(*keep).schema
    for name, kind in kinds.items():
        schema = schema.add(name, kind)

    def records(archive: bytes) -> Iterator[dict]:
        try:
            for content in frames(archive, max_record):
                try:
                    yield read_record(content)
                except WarcError as e:
                    yield {"record_error": str(e)}
        except WarcError as e:
            yield {"record_error": str(e)}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                held, size = [], 0

                def out(held=held, i=i):
                    same = [pa.repeat(batch.column(k)[i], len(held)) for k in range(len(keep))]
                    return pa.RecordBatch.from_arrays([*same, *(pa.array([r.get(n) for r in held], types[k]) for n, k in kinds.items())], names=schema.names)

                for r in records(batch.column(len(keep))[i].as_py() or b""):
                    held.append(r)
                    size += len(r.get("payload") or b"") * payload
                    if size > ARCHIVE_BYTES or len(held) >= 5000:
                        yield out()
                        held.clear()
                        size = 0
                if held:
                    yield out()

    return df.select(*keep, content_col).transform(in_batches, read, schema)


def save(archives: DataFrame, uri: str) -> None:
    """Writes each archive to a file of its own under uri (file:, hdfs:, s3:, gs: as pyarrow knows them); a name comes from
    the content, so a task that runs again writes the same file."""

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(uri)
        store.create_dir(root, recursive=True)
        for batch in batches:
            names = []
            for x in batch.column(0):
                data = x.as_py()
                name = f"{hashlib.sha1(data).hexdigest()}.warc.zst"
                part = f"{root}/.{name}.{uuid.uuid4().hex}"  # two attempts never write to one file
                with store.open_output_stream(part) as f:
                    f.write(data)
                store.move(part, f"{root}/{name}")
                names.append(name)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], names=["name"])

    archives.select("content").transform(in_batches, put, "name string").count()


def op1_warc(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    # Frames are compressed already.
    stored = written(write_archives(pages), "warc", compression="none", **LARGE_ROWS)
    return read_archives(stored, payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")



#: Base32 from the hexadecimal digest: each five hexadecimal digits are four characters.
OP1_SQL = """
WITH h AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS hex FROM pages),
v AS (SELECT page_id, n, hex, list_transform(range(8), lambda i: CAST('0x' || hex[5 * i + 1 : 5 * i + 5] AS INT)) AS parts FROM h),
d AS (SELECT page_id, n, hex, array_to_string(list_transform(range(32), lambda k:
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[((parts[k // 4 + 1] >> (15 - 5 * (k % 4))) & 31) + 1]), '') AS digest FROM v),
f AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS first FROM d)
SELECT page_id, n AS payload_bytes, digest AS payload_digest, CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first THEN first END AS refers_to FROM f
"""
