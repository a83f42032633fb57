"""WARC records inside ZIP packages: written by tasks, read back by byte ranges.

A package is a ZIP file with two stored (uncompressed) members: ``archive/data.warc.gz``, one
gzip member per record, and ``indexes/index.cdxj``, one line per record with its offset and
length. Readers fetch the end of the file, parse the central directory (and the ZIP64 one where
it is needed), find the members, and then read only the ranges of the records they want;
nothing is extracted.

Packages are written below the shared folder under a name of their own for each attempt of a
task, and only the names that successful attempts return are read. A task goes on to a new
package above ``PACKAGE_BYTES``; reading is split into ranges of ``SPLIT_BYTES``.

Of pages with equal payloads the one with the largest id is a response record and the others
are revisit records that refer to it and hold no payload; their HTTP header states its length.

Edge cases. A null html is an empty payload. A page without id is a revisit if a page with id
has its payload, else a response; rows that repeat the largest id are all responses. Control
characters in a url are percent-encoded in the record. Further columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoreline.llm.common import slices, written
from shoreline.session import scratch_path

PACKAGE_BYTES = 256 << 20
SPLIT_BYTES = 8 << 20
#: Tasks that read splits; beyond that one reads several, one after the other.
MAX_READERS = 100_000
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, payload binary"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in base 32: five hexadecimal digits at a time are four digits of 32."""
    groups = [
        F.lpad(F.conv(F.substring(F.sha1(payload), 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)
    ]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def revisits_marked(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id``, ``url``, ``payload``, ``digest`` and ``refers_to`` (null for a response).

    Digests are reduced on the map side, so equal payloads cost a row per task; the join that
    follows can be split where one payload holds many of the rows.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", payload.alias("payload"))
    rows = rows.withColumn("digest", base32_sha1(F.col("payload")))
    large = rows.where(F.octet_length("payload") >= min_bytes)
    firsts = large.groupBy(F.col("digest").alias("known")).agg(F.max("page_id").alias("first_id"))
    joined = rows.join(firsts.hint("merge"), F.col("digest") == F.col("known"), "left")
    later = ~F.col("page_id").eqNullSafe(F.col("first_id")) & (F.octet_length("payload") >= min_bytes)
    return joined.select("page_id", "url", "payload", "digest", F.when(later, F.col("first_id")).alias("refers_to"))


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record as a gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}"]
    head += [f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        target = "".join(f"%{ord(c):02X}" if ord(c) < 33 or c in "%\x7f" else c for c in url)
        head.append(f"WARC-Target-URI: {target}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return gzip.compress("\r\n".join(head).encode() + block + b"\r\n\r\n", 6, mtime=0)


def write_packages(marked: DataFrame, folder: str) -> DataFrame:
    """Write the rows of ``revisits_marked`` below ``folder``; one row per package: ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        sink = None

        def close() -> pa.RecordBatch:
            data.close()
            package.writestr(INDEX, "".join(index))
            package.close()
            sink.close()
            return pa.RecordBatch.from_arrays([pa.array([name])], names=["path"])

        for batch in batches:
            for part in slices(batch, "payload"):
                for row in zip(*(part.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "refers_to"))):
                    if sink is None:
                        name = f"{uuid.uuid4().hex}.wacz"
                        sink = store.open_output_stream(f"{root}/{name}", compression=None)
                        package = zipfile.ZipFile(sink, "w", zipfile.ZIP_STORED)
                        data, index, size = package.open(DATA, "w", force_zip64=True), [], 0
                    packed = record(*row)
                    data.write(packed)
                    index.append(json.dumps({"id": row[0], "offset": size, "length": len(packed)}) + "\n")
                    size += len(packed)
                    if size >= PACKAGE_BYTES:
                        yield close()
                        sink = None
        if sink is not None:
            yield close()

    return written(marked.mapInArrow(run, "path string"), "packages")


def _read(file, start: int, size: int) -> bytes:
    file.seek(start)
    return file.read(size)


def directory(file, size: int) -> dict[str, tuple[int, int]]:
    """Start and size of the data of each stored member, from the central directory."""
    tail_start = max(0, size - 65_557)
    tail = _read(file, tail_start, size - tail_start)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("no end of central directory")
    entries, length, start = struct.unpack_from("<HII", tail, end + 10)
    locator = end - 20
    if locator >= 0 and tail[locator : locator + 4] == b"PK\x06\x07":
        (at,) = struct.unpack_from("<Q", tail, locator + 8)
        wide = _read(file, at, 56)
        if wide[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end of central directory")
        entries, length, start = struct.unpack_from("<QQQ", wide, 32)
    central, members, at = _read(file, start, length), {}, 0
    for _ in range(entries):
        if central[at : at + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        (method,) = struct.unpack_from("<H", central, at + 10)
        packed, plain, name_size, extra_size, comment_size = struct.unpack_from("<IIHHH", central, at + 20)
        (header,) = struct.unpack_from("<I", central, at + 42)
        name = central[at + 46 : at + 46 + name_size].decode()
        extra = central[at + 46 + name_size : at + 46 + name_size + extra_size]
        while len(extra) >= 4:
            kind, own = struct.unpack_from("<HH", extra)
            if kind == 1:  # ZIP64: only the values that do not fit above, in this order
                values = list(struct.unpack_from(f"<{own // 8}Q", extra, 4))
                plain = values.pop(0) if plain == 0xFFFFFFFF else plain
                packed = values.pop(0) if packed == 0xFFFFFFFF else packed
                header = values.pop(0) if header == 0xFFFFFFFF else header
            extra = extra[4 + own :]
        if method == 0:
            local = _read(file, header, 30)
            name_length, extra_length = struct.unpack_from("<HH", local, 26)
            members[name] = (header + 30 + name_length + extra_length, packed)
        at += 46 + name_size + extra_size + comment_size
    return members


def _splits(folder: str):
    """Ranges of consecutive records, from the indexes of the packages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column("path").to_pylist():
                path = f"{root}/{name}"
                with store.open_input_file(path) as file:
                    members = directory(file, file.size())
                    base, (at, size) = members[DATA][0], members[INDEX]
                    index = [json.loads(line) for line in _read(file, at, size).splitlines()]
                starts, lengths, total = [], [], 0
                for i, entry in enumerate(index):
                    starts.append(base + entry["offset"])
                    lengths.append(entry["length"])
                    total += entry["length"]
                    if total >= SPLIT_BYTES or i + 1 == len(index):
                        columns = [pa.array([name]), pa.array([starts], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int64()))]
                        yield pa.RecordBatch.from_arrays(columns, names=["path", "starts", "lengths"])
                        starts, lengths, total = [], [], 0

    return run


def parsed(member: bytes) -> tuple:
    """The values of ``RECORD``; payload length and digest of a response are checked."""
    head, _, rest = gzip.decompress(member).partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.lower().split(b"content-length: ")[1].split(b"\r\n")[0])
    kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")

    def number(name: str) -> int | None:
        text = fields.get(name, "<urn:page:>")[len("<urn:page:") : -1]
        return int(text) if text else None

    if kind == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"payload of {fields['warc-record-id']} is not what its record says")
    content = payload if kind == "response" else None
    return number("warc-record-id"), fields.get("warc-target-uri"), kind, number("warc-refers-to"), size, digest, content


def read_packages(spark: SparkSession, packages: DataFrame, folder: str) -> DataFrame:
    """All records of the packages, with the columns of ``RECORD``."""
    splits = written(packages.mapInArrow(_splits(folder), "path string, starts array<bigint>, lengths array<bigint>"), "splits")
    types = {"page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "refers_to": pa.int64()}
    types |= {"payload_bytes": pa.int64(), "payload_digest": pa.string(), "payload": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, starts, lengths in zip(*(batch.column(c).to_pylist() for c in ("path", "starts", "lengths"))):
                with store.open_input_file(f"{root}/{name}") as file:
                    data = _read(file, starts[0], starts[-1] + lengths[-1] - starts[0])
                rows = [parsed(data[s - starts[0] : s - starts[0] + n]) for s, n in zip(starts, lengths)]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), types.values())]
                yield pa.RecordBatch.from_arrays(columns, names=list(types))

    # A given number of partitions stays: by key alone the small rows, of megabytes each, would be merged into one task.
    tasks = min(max(1, splits.count()), MAX_READERS)
    return splits.repartition(tasks, "path", "starts").mapInArrow(run, RECORD)


def archived(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """The records of ``pages``, written as packages in the shared folder and read back."""
    folder = scratch_path(pages.sparkSession, "archives")
    packages = write_packages(revisits_marked(pages, min_bytes), folder)
    return read_packages(pages.sparkSession, packages, folder)
