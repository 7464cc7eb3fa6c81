"""WARC archives of pages, and a splittable reader of such archives.

A record is a gzip member of its own. Of records with equal payloads one is a response and
holds it, the others revisit it and hold headers only. The reader cuts archives into byte
ranges. A task scans its range for the bytes a gzip member begins with; a candidate counts if
it inflates to a whole WARC record, from the version line to the length its headers state.
From there members follow one another. A record belongs to the range it starts in, wherever
it ends.

Files are written and read by the tasks themselves, with pyarrow's file systems: the folder
has to be one that these know and all executors share (file, hdfs, s3, gs, abfs).
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfweek.sinks.files import forget, scratch_folder

from .scratch import settle

#: Compressed bytes of an archive, about, and of a range that is read at a time.
ARCHIVE_BYTES = 1 << 30
SPLIT_BYTES = 8 << 20
SPLITS_A_TASK = 2
#: Bytes read at a time where a record reaches beyond its range, and payload handed on at once.
_FURTHER = 1 << 20
_AT_ONCE = 8 << 20

# fixed values of the format
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
END = b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    """A WARC record; headers without a value are left out, and values are made such that
    they hold no line ends."""
    lines = ["WARC/1.1"]
    lines += [f"{k}: {''.join(c if c >= ' ' else quote(c) for c in v)}" for k, v in headers if v is not None]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + END + block + END


def http_response(payload_bytes: int, payload: bytes) -> bytes:
    head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    return f"{head}Content-Length: {payload_bytes}".encode() + END + payload


def member(data: bytes, level: int = 6) -> bytes:
    """``data`` as a gzip member. A gzip member inside it, which could be stored as it is, is
    parted within its first bytes, so that no reader takes it for one of the archive's."""
    packer, out, done = zlib.compressobj(level, zlib.DEFLATED, 31), [], 0
    at = data.find(MAGIC)
    while at >= 0:
        out += [packer.compress(data[done : at + 1]), packer.flush(zlib.Z_FULL_FLUSH)]
        done = at + 1
        at = data.find(MAGIC, done)
    return b"".join([*out, packer.compress(data[done:]), packer.flush()])


def parse(data: bytes) -> tuple[dict[str, str], bytes] | None:
    """Headers (names in lower case) and block of a whole record, or None if it is not one."""
    at = data.find(END)
    if at < 0 or not data.startswith(VERSION):
        return None
    headers = {}
    for line in data[:at].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        headers[name.strip().decode("utf-8", "replace").lower()] = value.strip().decode("utf-8", "replace")
    length = headers.get("content-length", "")
    block = data[at + len(END) : -len(END)]
    if not length.isdecimal() or int(length) != len(block) or not data.endswith(END):
        return None
    return headers, block


class Range:
    """Bytes of a file from ``start`` on; more are read as a record needs them."""

    def __init__(self, file, start: int, end: int, size: int):
        self.file, self.start, self.end, self.size = file, start, end, size
        self.data = file.read_at(min(size, end + len(MAGIC)) - start, start)

    def find(self, at: int) -> int | None:
        """Where the next candidate in the range begins."""
        found = self.data.find(MAGIC, at - self.start)
        found += self.start
        return found if self.start <= found < self.end else None

    def chunks(self, at: int) -> Iterator[bytes]:
        view, at = memoryview(self.data), at - self.start
        while at < len(view):
            yield bytes(view[at : at + (1 << 16)])
            at += 1 << 16
        at = self.start + len(view)
        while at < self.size:
            more = self.file.read_at(min(_FURTHER, self.size - at), at)
            yield more
            at += len(more)

    def decode(self, at: int) -> tuple[int, dict[str, str], bytes] | None:
        """Where the member at ``at`` ends, and its record; None if no record begins there."""
        unpacker, out, taken, seen = zlib.decompressobj(31), [], 0, b""
        try:
            for chunk in self.chunks(at):
                out.append(unpacker.decompress(chunk))
                taken += len(chunk)
                if len(seen) < len(VERSION):
                    seen += out[-1][: len(VERSION)]
                    if not VERSION.startswith(seen[: len(VERSION)]):
                        return None
                if unpacker.eof:
                    found = parse(b"".join(out))
                    return found and (at + taken - len(unpacker.unused_data), *found)
        except zlib.error:
            pass
        return None

    def records(self) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
        """(offset, length, headers, block) of the records that begin in the range."""
        at = self.find(self.start)
        while at is not None:
            found = self.decode(at)
            if found is None:
                at = self.find(at + 1)  # the bytes stood inside a member, or it is damaged
            else:
                yield at, found[0] - at, *found[1:]
                at = self.find(found[0])


def _file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    scheme, colon, rest = uri.partition(":")
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    return pafs.FileSystem.from_uri(f"{scheme.replace('s3a', 's3')}{colon}{rest}")


def _qualified(spark, folder: str) -> tuple[str, object, object]:
    """The folder with its scheme, as Hadoop sees it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    path = system.makeQualified(path)
    return path.toString(), system, path


def new_folder(spark) -> str:
    """A folder for archives beside the settled tables; it goes when the driver ends."""
    uri, system, path = _qualified(spark, f"{scratch_folder(spark)}/warc-{uuid.uuid4().hex}")
    system.deleteOnExit(path)
    return uri


_MEMBERS = "_row long, _id string, key binary, size long, digest string, record_id string, url string, member binary"


def _members(pages: DataFrame, id_col: str, url_col: str, payload_col: str, date: str) -> DataFrame:
    """Every page as the gzip member of a response."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for row, own, url, payload in zip(*(c for c in batch.columns)):
                row, own, url, payload = row.as_py(), own.as_py(), url.as_py(), payload.as_py() or b""
                key, digest = hashlib.sha256(payload).digest(), payload_digest(payload)
                name = uuid.UUID(bytes=hashlib.sha256(f"{row} {own} {digest}".encode()).digest()[:16])
                headers = [*_headers("response", f"<urn:uuid:{name}>", own, url, digest, date)]
                packed = member(record(headers, http_response(len(payload), payload)))
                rows.append((row, own, key, len(payload), digest, f"<urn:uuid:{name}>", url, packed))
                held += len(packed)
                if held >= _AT_ONCE:
                    yield _batch(rows, _KINDS)
                    rows, held = [], 0
            yield _batch(rows, _KINDS)

    numbered = pages.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col(id_col).cast("string").alias("_id"),
        F.col(url_col).cast("string").alias("url"),
        F.col(payload_col).cast("binary").alias("payload"),
    )
    return settle(numbered.mapInArrow(pack, _MEMBERS))


_KINDS = pa.schema(
    [
        ("_row", pa.int64()),
        ("_id", pa.string()),
        ("key", pa.binary()),
        ("size", pa.int64()),
        ("digest", pa.string()),
        ("record_id", pa.string()),
        ("url", pa.string()),
        ("member", pa.binary()),
    ]
)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), kind) for c, kind in zip(columns, schema.types)], schema=schema
    )


def _headers(kind: str, name: str, own: str | None, url: str | None, digest: str, date: str):
    yield from (
        ("WARC-Type", kind),
        ("WARC-Record-ID", name),
        ("WARC-Date", date),
        ("WARC-Target-URI", url),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Source-ID", None if own is None else quote(own, safe="")),
    )


def write_archives(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least: int = 0,
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Write a record per row of ``pages`` to new archives in ``folder`` and return their
    list, (path, bytes, records). Only listed archives are whole: a task that is tried again
    writes another file, and what the lost try has left is never listed.

    Of rows with equal payloads of at least ``least`` bytes the one with the smallest id (a
    null id last, the row read first among equals) becomes the response, the others revisits
    that name it; shorter payloads are all responses. A null payload is empty, text is
    written as UTF-8. A null url or id gives no header. Control characters in urls are
    percent-encoded. Repeated rows get records of their own. Other columns are not read. An
    empty table writes nothing.
    """
    uri, _, _ = _qualified(pages.sparkSession, folder)
    kind = pages.schema[id_col].dataType.simpleString()
    members = _members(pages, id_col, url_col, payload_col, date)
    own = F.col("_id").cast(kind)
    rank = F.struct(own.isNull().alias("none"), own.alias("id"), "_row", "_id", "record_id", "url")
    firsts = members.where(F.col("size") >= least).groupBy("key").agg(F.min(rank).alias("first"), F.count("*").alias("n"))
    firsts = firsts.where("n > 1").select("key", F.col("first").dropFields("id", "none").alias("first"))
    # a payload held by very many rows is a skewed key of a plain join
    joined = members.join(firsts, "key", "left").select(
        "_row", "_id", "size", "digest", "record_id", "url", "member", "first"
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, place = _file_system(uri)
        system.create_dir(place, recursive=True)
        name, out, done, upto, count = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}", None, [], 0, 0
        for batch in batches:
            for r in batch.to_pylist():
                first, packed = r["first"], r["member"]
                if first is not None and first["_row"] != r["_row"]:
                    headers = [
                        *_headers("revisit", r["record_id"], r["_id"], r["url"], r["digest"], date),
                        ("WARC-Profile", PROFILE),
                        ("WARC-Refers-To", first["record_id"]),
                        ("WARC-Refers-To-Target-URI", first["url"]),
                        ("WARC-Refers-To-Date", date),
                        ("Refers-To-Source-ID", None if first["_id"] is None else quote(first["_id"], safe="")),
                    ]
                    packed = member(record(headers, http_response(r["size"], b"")))
                if out is None:
                    file = f"{name}-{len(done):04d}.warc.gz"
                    out, upto, count = system.open_output_stream(f"{place}/{file}", compression=None), 0, 0
                out.write(packed)
                upto, count = upto + len(packed), count + 1
                if upto >= ARCHIVE_BYTES:
                    out.close()
                    done.append((f"{uri}/{file}", upto, count))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{uri}/{file}", upto, count))
        yield _batch(done, pa.schema([("path", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())]))

    listed = settle(joined.mapInArrow(write, "path string, bytes long, records long"))
    forget(members)
    return listed


def _payload(headers: dict[str, str], block: bytes) -> tuple[int, str, bytes, bool]:
    """Size and digest of the full payload, what the record holds of it, and whether that is
    what the record's headers say."""
    stated = headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
    if not headers.get("content-type", "").startswith("application/http"):
        return len(block), payload_digest(block), block, stated in (None, payload_digest(block))
    head, _, body = block.partition(END)
    if headers.get("warc-type") != "revisit":
        digest = payload_digest(body)
        return len(body), digest, body, stated in (None, digest)
    size = [v for k, _, v in (line.partition(b":") for line in head.split(b"\r\n")) if k.lower() == b"content-length"]
    return int(size[0]) if size and size[0].strip().isdigit() else None, stated, body, True


_RECORDS = pa.schema(
    [
        ("path", pa.string()),
        ("offset", pa.int64()),
        ("length", pa.int64()),
        ("record_type", pa.string()),
        ("record_id", pa.string()),
        ("target_uri", pa.string()),
        ("refers_to", pa.string()),
        ("source_id", pa.string()),
        ("refers_to_source_id", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("intact", pa.bool_()),
        ("payload", pa.binary()),
    ]
)


def read_archives(files: DataFrame, with_payload: bool = False, split_bytes: int | None = None) -> DataFrame:
    """A row per record of the archives listed in ``files`` (path, bytes): where it stands
    (path, offset, length), its type, ids and uri, size and digest of its full payload,
    ``intact`` (what is held has the digest stated), and the payload held on request.

    Ranges are cut anywhere, ``split_bytes`` each; a record is read once, by the task whose
    range it starts in. Damaged members are passed over: ``uncovered`` tells of them. Records
    of other types and writers are read as well; without HTTP headers the block is the
    payload. An empty list gives an empty result; other columns are not read.
    """
    split = split_bytes or SPLIT_BYTES
    ranges = files.where("bytes > 0").select(
        "path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split).cast("long"))).alias("start")
    )
    parts = max(1, -(-ranges.count() // SPLITS_A_TASK))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own in batch.to_pylist():
                system, place = _file_system(own["path"])
                with system.open_input_file(place) as file:
                    end = min(own["bytes"], own["start"] + split)
                    rows, held = [], 0
                    for at, length, headers, block in Range(file, own["start"], end, own["bytes"]).records():
                        size, digest, payload, intact = _payload(headers, block)
                        ids = [headers.get(k) for k in ("source-id", "refers-to-source-id")]
                        rows.append(
                            (
                                own["path"],
                                at,
                                length,
                                *[headers.get(f"warc-{k}") for k in ("type", "record-id", "target-uri", "refers-to")],
                                *[None if i is None else unquote(i) for i in ids],
                                size,
                                digest,
                                intact,
                                payload if with_payload else None,
                            )
                        )
                        held += len(payload) if with_payload else 0
                        if held >= _AT_ONCE:
                            yield _batch(rows, _RECORDS)
                            rows, held = [], 0
                    yield _batch(rows, _RECORDS)

    schema = (
        "path string, offset long, length long, record_type string, record_id string, target_uri string, "
        "refers_to string, source_id string, refers_to_source_id string, payload_bytes long, "
        "payload_digest string, intact boolean, payload binary"
    )
    return ranges.repartition(parts).mapInArrow(read, schema)


def uncovered(files: DataFrame, records: DataFrame) -> DataFrame:
    """(path, bytes, lost): bytes of each archive that belong to no record read."""
    read = records.groupBy("path").agg(F.sum("length").alias("_read"))
    lost = F.col("bytes") - F.coalesce("_read", F.lit(0))
    return files.select("path", "bytes").join(read, "path", "left").select("path", "bytes", lost.alias("lost"))
