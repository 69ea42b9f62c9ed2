"""WARC archives: one gzip member for each record, written and read by Spark tasks.

Writing: the payload of a page is its HTML in UTF-8 (null: empty). Of pages with equal payloads of at least
`REVISIT_BYTES` bytes the one with the largest page_id becomes a response record, the others revisit records that refer to it
and hold no payload; rows that share that page_id are all responses. A task rolls over to a new archive after
`ARCHIVE_BYTES`. File names are new for each attempt and only those named in the manifest (a Parquet table) count, so a task
that runs twice leaves a file that nobody reads.

Reading is sequential and incremental: compressed blocks go through zlib as they are read, a record's block is as long as its
Content-Length says, its digests are compared where it states some (in base32 or hex, by any algorithm that hashlib knows), and
whatever does not fit raises an ArchiveError. A task holds one record at a time. Records of every type are read: an HTTP message is
taken apart only where the block is one, chunked bodies are put together, and of other blocks the whole block is the payload.

A page without an id has an empty id in its record and comes back with null; a null url is written as "about:blank".
Archives lie in the shared folder; other file systems must be known to pyarrow.fs.
"""

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posada.staging import Stage

REVISIT_BYTES = 1000
ARCHIVE_BYTES = 64 << 20
READ_BYTES = 1 << 18
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ID = re.compile(r"<urn:page:(-?\d*)>")


class ArchiveError(ValueError):
    """An archive that is cut short or does not hold what its headers say."""


def _digest(held: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(held).digest()).decode()


def record(page_id, url, payload: bytes, refers_to=None, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One record as a gzip member. refers_to: the page_id that a revisit record names."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    number = lambda i: f"<urn:page:{'' if i is None else i}>"
    place = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "about:blank")
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", number(page_id)),
            ("WARC-Date", date), ("WARC-Target-URI", place), ("Content-Type", "application/http;msgtype=response"),
            ("WARC-Block-Digest", _digest(block)), ("WARC-Payload-Digest", _digest(payload))]
    if refers_to is not None:
        head += [("WARC-Refers-To", number(refers_to)), ("WARC-Profile", _PROFILE)]
    head.append(("Content-Length", str(len(block))))
    lines = "".join(f"{k}: {v}\r\n" for k, v in head).encode()
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(b"WARC/1.1\r\n" + lines + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def members(stream):
    """The bytes of each gzip member of a stream, as iterators of decompressed blocks."""
    held, ended = b"", False

    def blocks():
        nonlocal held, ended
        unpacker = zlib.decompressobj(31)
        while not unpacker.eof:
            if not held:
                held = stream.read(READ_BYTES)
                if not held:
                    raise ArchiveError("archive ends inside a record")
            try:
                out = unpacker.decompress(held, READ_BYTES)
            except zlib.error as error:
                raise ArchiveError(f"not a gzip member: {error}") from error
            held = unpacker.unused_data if unpacker.eof else unpacker.unconsumed_tail
            if out:
                yield out
        ended = True

    while True:
        if not held:
            held = bytes(stream.read(READ_BYTES))
            if not held:
                return
        ended = False
        yield blocks()
        if not ended:
            raise ArchiveError("record was not read to its end")


def agrees(stated: str | None, *held: bytes) -> bool:
    """Whether a digest such as "sha1:..." is that of one of the values; True where none is stated."""
    if not stated:
        return True
    name, _, value = stated.partition(":")
    try:
        found = [hashlib.new(name.strip().lower(), x).digest() for x in held]
    except ValueError as error:
        raise ArchiveError(f"unknown digest {stated!r}") from error
    forms = {form for d in found for form in (d.hex(), base64.b32encode(d).decode().rstrip("=").lower())}
    return value.strip().rstrip("=").lower() in forms


def hex_digest(stated: str | None) -> str | None:
    """A stated digest in bare lower-case hex, whichever way it is written."""
    name, _, value = (stated or "").partition(":")
    value = value.strip().rstrip("=")
    if not value:
        return None
    try:
        size = hashlib.new(name.strip().lower()).digest_size
        return value.lower() if len(value) == 2 * size else base64.b32decode(value.upper() + "=" * (-len(value) % 8)).hex()
    except ValueError:
        return None


def unchunked(body: bytes) -> bytes:
    """A body whose transfer encoding is chunked, put together."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = body[at:end].split(b";")[0].strip()
        if end < 0 or not re.fullmatch(rb"[0-9A-Fa-f]+", size):
            raise ArchiveError("chunk without a size")
        count, at = int(size, 16), end + 2
        if not count:
            return b"".join(out)
        if body[at + count:at + count + 2] != b"\r\n":
            raise ArchiveError("chunk is not as long as its size")
        out.append(body[at:at + count])
        at += count + 2


def _header(lines: list[str]) -> dict[str, str]:
    """Names in lower case; a line that begins with white space carries on the one before."""
    head, last = {}, None
    for line in lines:
        if line[:1] in " \t" and last:
            head[last] += " " + line.strip()
        else:
            name, _, value = line.partition(":")
            last = name.strip().lower()
            head[last] = value.strip()
    return head


def _payload(head: dict, block: bytes) -> tuple[bytes | None, int | None]:
    """The payload, and its length where the record states it; revisit records hold none."""
    kind = head.get("warc-type")
    if not head.get("content-type", "").lower().startswith("application/http"):
        if not agrees(head.get("warc-payload-digest"), block):
            raise ArchiveError("payload digest differs")
        return block, len(block)
    first, _, body = block.partition(b"\r\n\r\n")
    http = _header(first.decode("iso-8859-1").split("\r\n")[1:])
    stated = http.get("content-length", "")
    size = int(stated) if stated.isdecimal() else None
    if kind == "revisit":
        return None, size
    payload = body
    if "chunked" in http.get("transfer-encoding", "").lower():
        payload = unchunked(body)
    elif kind == "response" and size is not None and size != len(body):
        raise ArchiveError("payload is not as long as its Content-Length")
    if not agrees(head.get("warc-payload-digest"), payload, body):
        raise ArchiveError("payload digest differs")
    return payload, len(payload)


def read_record(blocks) -> dict:
    """Headers in lower case, payload (None in revisit records) and its length, framed by Content-Length and checked by both
    digests."""
    held = bytearray()
    while (end := held.find(b"\r\n\r\n")) < 0:
        more = next(blocks, None)
        if more is None:
            raise ArchiveError("record without end of headers")
        held += more
    first, *lines = bytes(held[:end]).decode("utf-8", "replace").split("\r\n")
    if not first.startswith("WARC/"):
        raise ArchiveError(f"record begins with {first[:20]!r}")
    head = _header(lines)
    if not head.get("content-length", "").isdecimal():
        raise ArchiveError("record without Content-Length")
    length, start = int(head["content-length"]), end + 4
    while len(held) < start + length + 4:
        more = next(blocks, None)
        if more is None:
            raise ArchiveError("record is shorter than its Content-Length")
        held += more
    block = bytes(held[start:start + length])
    if bytes(held[start + length:]) != b"\r\n\r\n" or next(blocks, None) is not None:
        raise ArchiveError("record is longer than its Content-Length")
    if not agrees(head.get("warc-block-digest"), block):
        raise ArchiveError("block digest differs")
    payload, size = _payload(head, block)
    return {"head": head, "payload": payload, "payload_bytes": size}


def records(stream):
    for blocks in members(stream):
        yield read_record(blocks)


# --- on Spark -------------------------------------------------------------------------------------------------

def with_roles(pages: DataFrame) -> DataFrame:
    """page_id, url, html and refers_to, which is null for response records."""
    held = pages.select("page_id", "url", "html") \
        .withColumn("payload", F.coalesce(F.col("html").cast("binary"), F.lit("").cast("binary"))) \
        .withColumn("digest", F.when(F.octet_length("payload") >= REVISIT_BYTES, F.sha1("payload")))
    shared = held.where("digest IS NOT NULL").groupBy("digest").agg(F.max("page_id").alias("last"), F.count("*").alias("n")) \
        .where("n > 1").select("digest", "last")
    return held.join(shared, "digest", "left") \
        .withColumn("refers_to", F.when(F.col("last") != F.coalesce("page_id", F.col("last") - 1), F.col("last"))) \
        .select("page_id", "url", "payload", "refers_to")


def write_archives(pages: DataFrame, held: Stage, name: str = "archives") -> DataFrame:
    """Write all pages; returns the manifest: path, records and bytes of each archive."""
    folder = held.path(name)

    def run(batches):
        system, root = pyarrow.fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        path, out, count, size = None, None, 0, 0

        def manifest():
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([count], pa.int64()), pa.array([size], pa.int64())],
                                              names=["path", "records", "bytes"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "refers_to"))):
                if out is None:
                    path, count, size = f"{root}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = system.open_output_stream(path, compression=None)
                packed = record(*row)
                out.write(packed)
                count, size = count + 1, size + len(packed)
                if size >= ARCHIVE_BYTES:
                    out.close()
                    out = None
                    yield manifest()
        if out is not None:
            out.close()
            yield manifest()

    return held.put(with_roles(pages).mapInArrow(run, "path string, records bigint, bytes bigint"), f"{name}-manifest")


def read_archives(manifest: DataFrame, held: Stage, name: str = "archives", payload: bool = True) -> DataFrame:
    """A row for each record: page_id, url, payload_bytes, payload_digest (hex), record_type, refers_to, and the payload
    (null for revisit records) if wanted. What a foreign record does not state is null, its page_id too."""
    folder = held.path(name)
    columns = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint" \
        + (", payload binary" if payload else "")
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = [c.split()[0] for c in columns.split(", ")]

    def number(value):
        found = _ID.fullmatch(value or "")
        return int(found[1]) if found and found[1] else None

    def run(batches):
        system, _ = pyarrow.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, expected in zip(batch.column("path").to_pylist(), batch.column("records").to_pylist()):
                rows, seen, size = [], 0, 0
                with system.open_input_stream(path, compression=None) as stream:
                    for found in records(stream):
                        head = found["head"]
                        rows.append((number(head.get("warc-record-id")), head.get("warc-target-uri"), found["payload_bytes"],
                                     hex_digest(head.get("warc-payload-digest")), head.get("warc-type"),
                                     number(head.get("warc-refers-to")), found["payload"])[:len(names)])
                        seen, size = seen + 1, size + len(found["payload"] or b"")
                        if len(rows) >= 1000 or size >= READ_BYTES * 64:
                            yield _batch(rows, kinds, names)
                            rows, size = [], 0
                if seen != expected:
                    raise ArchiveError(f"{path} holds {seen} records of {expected}")
                if rows:
                    yield _batch(rows, kinds, names)

    archives = max(1, manifest.count())
    return manifest.repartition(archives, "path").mapInArrow(run, columns)


def _batch(rows, kinds, names):
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], names=names)
