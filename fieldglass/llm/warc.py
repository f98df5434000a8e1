"""WARC archives: a writer with revisit records for payloads seen before, and a sequential reader.

Writing: SHA-1 digests are counted with one narrow aggregate; the least page_id of each digest goes back by a join, which
Spark splits where a digest is hot.  Each partition writes its records, one gzip member each, to files in the folder that
all executors share; a file is closed at ``FILE_BYTES``.  The table of files, written when the job ends, names the files
of the tasks that counted.

Reading: a file is read in chunks of ``CHUNK`` bytes, members are decompressed as they come, records are framed by Content-Length, and block
and payload digests are verified; a wrong one is an error.

Defined results: a null html is an empty payload; payloads under ``least_bytes`` are always responses; of equal payloads
the row with the least page_id is the response, and so are repeated rows with that same page_id; rows without a page_id
are revisits of one that has it, and responses where none has; payloads of any length are one record; other columns play
no part; without rows there are no archives.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldglass.llm._shared import create, new_path, opened, stored

FILE_BYTES = 1 << 28
CHUNK = 1 << 16
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ROW = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def base32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}') if page_id is not None else uuid.uuid4()}>"


def record(page_id: int | None, url: str | None, payload: bytes, first: int | None, level: int = 6) -> bytes:
    """One gzip member: a response, or a revisit of the page first if that is given."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if first is not None else http + payload
    uri = "".join((url or "about:blank").split())
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if first is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha1:{base32(hashlib.sha1(payload).digest())}",
        f"WARC-Block-Digest: sha1:{base32(hashlib.sha1(block).digest())}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if first is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(first)}", f"X-Refers-To-Page-Id: {first}"]
    pack = zlib.compressobj(level, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + pack.flush()


def write(pages: DataFrame, least_bytes: int = 0, level: int = 6) -> DataFrame:
    """(path, records): the archives written."""
    folder = new_path(pages.sparkSession, "warc")
    given = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).cast("binary").alias("payload")).withColumn("digest", F.sha1("payload")).withColumn("bytes", F.octet_length("payload"))
    first = given.where(F.col("bytes") >= least_bytes).groupBy("digest", "bytes").agg(F.min("page_id").alias("first"))
    marked = given.join(first, ["digest", "bytes"], "left").select("page_id", "url", "payload", F.when(F.col("first") == F.col("page_id"), None).otherwise(F.col("first")).alias("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, path, n, size = None, "", 0, 0

        def closed() -> pa.RecordBatch:
            file.close()
            return pa.RecordBatch.from_pydict({"path": [path], "records": pa.array([n], pa.int64())})

        for batch in batches:
            for k in range(batch.num_rows):
                if file is None:
                    path, n, size = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    file = create(path)
                got = record(*(batch.column(c)[k].as_py() for c in ("page_id", "url", "payload", "first")), level)
                file.write(got)
                n, size = n + 1, size + len(got)
                if size >= FILE_BYTES:
                    yield closed()
                    file = None
        if file is not None:
            yield closed()

    return stored(marked.mapInArrow(run, "path string, records long"), "warc-files")


def members(file) -> Iterator[bytes]:
    """The decompressed gzip members of an open file, one after another."""
    unpack, parts, chunk, begun = zlib.decompressobj(31), [], b"", False
    while chunk or (chunk := file.read(CHUNK)):
        parts.append(unpack.decompress(chunk))
        chunk, begun = b"", True
        if unpack.eof:
            yield b"".join(parts)
            unpack, parts, chunk, begun = zlib.decompressobj(31), [], unpack.unused_data, False
    if begun:
        raise ValueError("the archive ends within a member")


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields, names in lower case, and the block, by its Content-Length and with its digest verified."""
    head, _, rest = member.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("no WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    n = int(fields["content-length"])
    block = rest[:n]
    if len(block) != n or rest[n:] != b"\r\n\r\n":
        raise ValueError("the record's length is wrong")
    _verify(fields.get("warc-block-digest"), block)
    return fields, block


def _verify(given: str | None, of: bytes) -> None:
    if given and given != f"sha1:{base32(hashlib.sha1(of).digest())}":
        raise ValueError(f"digest {given} is wrong")


def read(files: DataFrame) -> DataFrame:
    """A row for each record of the archives in files (path, records): _ROW.  An archive of more or fewer records than it
    was written with is an error."""

    def row(member: bytes) -> tuple:
        fields, block = parse(member)
        http, _, payload = block.partition(b"\r\n\r\n")
        number = lambda name: int(fields[name]) if name in fields else None
        kind, n = fields["warc-type"], len(payload)
        if kind == "response":
            _verify(fields["warc-payload-digest"], payload)
        else:
            n = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
        return number("x-page-id"), n, fields["warc-payload-digest"].removeprefix("sha1:"), kind, number("x-refers-to-page-id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
        names = [x.split()[0] for x in _ROW.split(", ")]
        for batch in batches:
            for path, records in zip(batch.column("path").to_pylist(), batch.column("records").to_pylist(), strict=True):
                with opened(path) as file:
                    rows, n = [], 0
                    for member in members(file):
                        rows.append(row(member))
                        n += 1
                        if len(rows) == 4096:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                            rows = []
                    if n != records:
                        raise ValueError(f"{path} has {n} records instead of {records}")
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    n = max(1, files.count())
    return files.select("path", "records").repartition(n).mapInArrow(run, _ROW)


def op6_warc(spark, sf_dir: str) -> DataFrame:
    return read(write(spark.read.parquet(f"{sf_dir}/pages.parquet"), least_bytes=0))
