"""Web archives: WARC records packed in ZIP files, read back by ranges without unpacking the ZIP.

A ZIP file holds a stored (not deflated) archive member ``archive/data.warc.gz``, in which each record is a gzip member
of its own, and a stored index ``indexes/index.cdxj`` with a line for each record. The reader parses the central
directory (that of ZIP64 too), finds the stored members, takes the records' places from the index, or walks the archive
where there is none, and reads runs of records by byte range, so that many tasks share one large file.

Tasks open files with ``pyarrow.fs``: local and mounted folders, S3, GCS and, where libhdfs is present, HDFS.
"""

from __future__ import annotations

import base64
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import new_path, staged

#: Stored bytes after which a task begins another ZIP file.
ARCHIVE_BYTES = 1 << 30
#: Bytes of records that one range read takes (a longer record is a read of its own), and bytes that a task reads.
RUN_BYTES, TASK_BYTES = 4 << 20, 64 << 20
#: Groups of equal payloads up to which they are broadcast: 1 M are about 60 MB.
BROADCAST_GROUPS = 1_000_000
WARC_DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = "archive string, offset long, length long, record_type string, record_id string, target_uri string, refers_to string, payload_digest string, payload_length long, payload binary"
_GZIP = 31  # zlib's window bits for a gzip member


def opened(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


# --- writing ---------------------------------------------------------------------------------------------------------


def with_revisits(pages: DataFrame, least: int = 1000) -> DataFrame:
    """``pages(page_id, url, html)`` as (page_id, url, payload, digest, shared, revisit, original): payload in UTF-8,
    its SHA-1, whether it is in a group of equal payloads of at least ``least`` bytes, whether the row revisits, and
    the page_id of the group's response. The response is the row of the largest page_id (nulls are smallest); of
    several rows of that page_id one."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha1("payload")))
    long = rows.where(F.octet_length("payload") >= least).groupBy("digest", "page_id").agg(F.count(F.lit(1)).alias("c"))
    top = F.max(F.struct("page_id", "c")).alias("t")
    groups = long.groupBy("digest").agg(top, F.sum("c").alias("n")).where("n > 1")
    groups = staged(groups.select("digest", F.col("t.page_id").alias("original"), F.col("t.c").alias("tied")), "groups")
    n, ties = groups.agg(F.count(F.lit(1)), F.count_if(F.col("tied") > 1)).first()
    small = F.broadcast(groups) if n <= BROADCAST_GROUPS else groups
    found = rows.join(small, "digest", "left").withColumn("shared", F.col("tied").isNotNull())
    at_top = F.col("page_id").eqNullSafe(F.col("original"))
    revisit = F.col("shared") & ~at_top
    columns = ["page_id", "url", "payload", "digest", "shared", "revisit", "original"]
    out = found.withColumn("revisit", revisit)
    if not ties:
        return out.select(columns)
    # Rows of one page_id and payload: one of them is the response. Their numbers are staged, so that they stay.
    odd = F.coalesce(at_top & (F.col("tied") > 1), F.lit(False))
    same = staged(out.where(odd).withColumn("number", F.monotonically_increasing_id()), "tied")
    first = same.groupBy("digest").agg(F.min("number").alias("number")).select("number", F.lit(True).alias("first"))
    same = same.join(F.broadcast(first) if ties <= BROADCAST_GROUPS else first, "number", "left").withColumn("revisit", F.col("first").isNull())
    return out.where(~odd).select(columns).unionByName(same.select(columns))


def _record(kind: str, record_id: str, url: bytes | None, digest: bytes, refers: str | None, payload: bytes, size: int) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {WARC_DATE}"]
    lines.append(f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}")
    if refers is not None:
        lines += [f"WARC-Refers-To: <{refers}>", f"WARC-Profile: {PROFILE}"]
    head = "\r\n".join(lines).encode()
    if url is not None:  # a header holds no blanks or control characters
        head += b"\r\nWARC-Target-URI: " + re.sub(rb"[\x00-\x20\x7f]", lambda m: b"%%%02X" % m[0][0], url)
    length = len(http) + len(payload)
    return b"".join((head, b"\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: %d\r\n\r\n" % length, http, payload, b"\r\n\r\n"))


class _Zip:
    """One ZIP file being written: the archive member as records come, the index at the end."""

    def __init__(self, folder: str):
        self.path = f"{folder}/{uuid.uuid4().hex}.zip"
        files, where = opened(self.path)
        files.create_dir(where.rsplit("/", 1)[0], recursive=True)
        self.out = files.open_output_stream(where)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED)
        self.member = self.zip.open("archive/data.warc.gz", "w", force_zip64=True)
        self.at, self.lines = 0, []

    def add(self, record: bytes, url: bytes | None, kind: str, level: int) -> None:
        packed = zlib.compress(record, level, wbits=_GZIP)
        self.member.write(packed)
        place = {"url": (url or b"").decode("utf-8", "replace"), "mime": "warc/revisit" if kind == "revisit" else "text/html", "offset": str(self.at), "length": str(len(packed)), "filename": "data.warc.gz"}
        self.lines.append(f"{place['url'] or '-'} 20240101000000 {json.dumps(place)}".replace("\n", "%0A").replace("\r", "%0D"))
        self.at += len(packed)

    def close(self) -> tuple[str, int]:
        self.member.close()
        with self.zip.open("indexes/index.cdxj", "w", force_zip64=True) as index:
            for line in sorted(self.lines):
                index.write(line.encode() + b"\n")
        self.zip.close()
        size = self.out.tell()
        self.out.close()
        return self.path, size


def write_archives(pages: DataFrame, folder: str, least: int = 1000, archive_bytes: int = ARCHIVE_BYTES, level: int = 4) -> DataFrame:
    """Writes a record for each row of ``pages(page_id, url, html)`` into ZIP files under ``folder`` and returns their
    (archive, bytes, records), staged.

    A response holds the payload (html in UTF-8, null: empty); rows that ``with_revisits`` calls revisits hold the HTTP
    header with the payload's length and refer to their response. Each attempt of a task writes files of new names and
    only those of attempts that succeed are in the table: a lost executor leaves files that no one reads. Null ids and
    urls, repeated rows and empty texts have records too; other columns are ignored; an empty table writes nothing.
    """
    rows = with_revisits(pages, least)

    def write(batches):
        out, done = None, []
        for batch in batches:
            for page, url, payload, digest, shared, revisit, original in zip(*[c.to_pylist() for c in batch.columns]):
                out = out or _Zip(folder)
                kind, size = ("revisit", len(payload)) if revisit else ("response", len(payload))
                name = lambda p: f"urn:page:{'' if p is None else p}:{digest.hex()}"  # noqa: B023,E731
                own = name(page) if shared and not revisit else f"urn:page:{'' if page is None else page}:{out.path[-36:-4]}-{len(out.lines)}"
                at = url.encode("utf-8", "surrogatepass") if url is not None else None
                out.add(_record(kind, own, at, digest, name(original) if revisit else None, b"" if revisit else payload, size), at, kind, level)
                if out.at >= archive_bytes:
                    done.append((*out.close(), len(out.lines)))
                    out = None
        if out:
            done.append((*out.close(), len(out.lines)))
        kinds = (pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], kind) for k, kind in enumerate(kinds)], ["archive", "bytes", "records"])

    return staged(rows.mapInArrow(write, "archive string, bytes long, records long"), "archives")


# --- reading ---------------------------------------------------------------------------------------------------------


def archives_in(spark: SparkSession, folder: str) -> DataFrame:
    """(archive, bytes) of the ZIP files under a folder, from its listing."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("recursiveFileLookup", "true").load(folder)
    return files.select(F.col("path").alias("archive"), F.col("length").alias("bytes"))


def _read(file, start: int, size: int) -> bytes:
    file.seek(start)
    out = file.read(size)
    if len(out) != size:
        raise ValueError(f"file ends before byte {start + size}")
    return out


def directory(file, size: int) -> list[tuple[str, int, int, int]]:
    """(name, method, first byte of the data, stored size) of each member, from the central directory."""
    tail_at = max(0, size - 65_557 - 20)  # longest comment, end record, ZIP64 locator
    tail = _read(file, tail_at, size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    while end >= 0 and (end + 22 > len(tail) or end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail)):
        end = tail.rfind(b"PK\x05\x06", 0, end)  # the signature inside the comment
    if end < 0:
        raise ValueError("no ZIP end record")
    count, length, first = struct.unpack_from("<HII", tail, end + 10)
    stop = tail_at + end  # where the directory ends, but for the ZIP64 records
    if end >= 20 and tail[end - 20 : end - 16] == b"PK\x06\x07":
        at = struct.unpack_from("<Q", tail, end - 20 + 8)[0]
        record = _read(file, at, 56)
        if record[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end record")
        count, length, first = struct.unpack_from("<QQQ", record, 32)
        stop = at
    shift = stop - length - first  # bytes before the ZIP, as of self-extracting files
    central, out, p = _read(file, first + shift, length), [], 0
    for _ in range(count):
        if central[p : p + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        flags, method = struct.unpack_from("<HH", central, p + 8)
        stored, full = struct.unpack_from("<II", central, p + 20)
        names, extras, comment = struct.unpack_from("<HHH", central, p + 28)
        local = struct.unpack_from("<I", central, p + 42)[0]
        name = central[p + 46 : p + 46 + names].decode("utf-8" if flags & 0x800 else "cp437")
        extra, q = central[p + 46 + names : p + 46 + names + extras], 0
        while q + 4 <= len(extra):
            kind, n = struct.unpack_from("<HH", extra, q)
            if kind == 1:  # ZIP64: those of the three that did not fit, in this order
                wide = iter(struct.unpack_from(f"<{n // 8}Q", extra, q + 4))
                full = next(wide) if full == 0xFFFFFFFF else full
                stored = next(wide) if stored == 0xFFFFFFFF else stored
                local = next(wide) if local == 0xFFFFFFFF else local
            q += 4 + n
        head = _read(file, local + shift, 30)
        if head[:4] != b"PK\x03\x04":
            raise ValueError(f"no local header of {name}")
        n, e = struct.unpack_from("<HH", head, 26)
        out.append((name, method, local + shift + 30 + n + e, stored))
        p += 46 + names + extras + comment
    return out


def _chunks(file, start: int, size: int, gz: bool = False, step: int = 1 << 20) -> Iterator[bytes]:
    """A member's bytes in pieces, unpacked where it is a .gz (of one or more gzip members)."""
    unpack = zlib.decompressobj(_GZIP) if gz else None
    for at in range(start, start + size, step):
        data = _read(file, at, min(step, start + size - at))
        while unpack is not None:
            yield unpack.decompress(data)
            data = unpack.unused_data
            if not unpack.eof:
                break
            unpack = zlib.decompressobj(_GZIP)
            if not data:
                break
        if unpack is None:
            yield data


def indexed(file, start: int, size: int, gz: bool) -> Iterator[tuple[str, int, int]]:
    """(file name, offset, length) of each line of a CDXJ index."""
    rest = b""
    for chunk in _chunks(file, start, size, gz):
        *lines, rest = (rest + chunk).split(b"\n")
        for line in [*lines]:
            if b"{" in line:
                place = json.loads(line[line.index(b"{") :])
                yield place["filename"].rsplit("/", 1)[-1], int(place["offset"]), int(place["length"])
    if b"{" in rest:
        place = json.loads(rest[rest.index(b"{") :])
        yield place["filename"].rsplit("/", 1)[-1], int(place["offset"]), int(place["length"])


def walked(file, start: int, size: int, gz: bool) -> Iterator[tuple[int, int]]:
    """(offset, length) of each record of an archive member without an index: gzip members are unpacked one after the
    other; of plain records only the headers are read."""
    if gz:
        unpack, first, at, step = zlib.decompressobj(_GZIP), 0, 0, 1 << 20
        while at < size:
            data = _read(file, start + at, min(step, size - at))
            at += len(data)
            while data:
                unpack.decompress(data)
                data = unpack.unused_data
                if unpack.eof:
                    yield first, at - len(data) - first
                    first, unpack = at - len(data), zlib.decompressobj(_GZIP)
        return
    at = 0
    while at < size:
        head = b""
        while b"\r\n\r\n" not in head and at + len(head) < size:
            head += _read(file, start + at + len(head), min(4096, size - at - len(head)))
        lines = head[: head.index(b"\r\n\r\n")]
        length = int(re.search(rb"(?im)^content-length:[ \t]*(\d+)", lines)[1])
        whole = min(len(lines) + 4 + length + 4, size - at)
        yield at, whole
        at += whole


def locate(archives: DataFrame) -> DataFrame:
    """Runs of records of ZIP files ``archives(archive)``: (archive, start, lengths), each of up to RUN_BYTES. Places
    come from the index members, or for archive members that no index names from a walk. An archive member that is
    deflated cannot be read by range and raises."""

    def runs(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                files, where = opened(path)
                with files.open_input_file(where) as file:
                    members = directory(file, file.size())
                    held = {name.rsplit("/", 1)[-1]: (name, method, at, size) for name, method, at, size in members if re.search(r"\.warc(\.gz)?$", name)}
                    for name, method, _, _ in held.values():
                        if method:
                            raise ValueError(f"{path}: {name} is compressed within the ZIP file")
                    found: dict[str, list] = {name: [] for name in held}
                    for name, method, at, size in members:
                        if re.search(r"\.cdxj?(\.gz)?$", name) and not method:
                            for of, offset, length in indexed(file, at, size, name.endswith(".gz")):
                                if of in found:
                                    found[of].append((offset, length))
                    for name, places in found.items():
                        _, _, at, size = held[name]
                        table = np.array(sorted(set(places)) or list(walked(file, at, size, name.endswith(".gz"))), np.int64).reshape(-1, 2)
                        if len(table):
                            yield _runs(path, table[:, 0] + at, table[:, 1])

    return archives.select("archive").mapInArrow(runs, "archive string, start long, lengths array<long>")


def _runs(path: str, start: np.ndarray, length: np.ndarray) -> pa.RecordBatch:
    """Places in order as runs without gaps of up to RUN_BYTES."""
    first, cuts = 0, [0]
    for i in range(1, len(start)):
        if start[i] != start[i - 1] + length[i - 1] or start[i] + length[i] - start[first] > RUN_BYTES:
            cuts.append(i)
            first = i
    offsets = pa.array([*cuts, len(start)], pa.int32())
    return pa.RecordBatch.from_arrays([pa.array([path] * len(cuts)), pa.array(start[cuts]), pa.ListArray.from_arrays(offsets, pa.array(length))], ["archive", "start", "lengths"])


def parse(record: bytes) -> tuple:
    """(type, id, uri, refers to, hex digest, payload length, payload) of one record; what it lacks is null."""
    head, _, block = record.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        key, _, value = line.partition(":")
        fields[key.lower()] = value.strip()
    block = block[: int(fields["content-length"])]
    size, payload = None, block
    if fields.get("content-type", "").startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
        told = re.search(rb"(?im)^content-length:[ \t]*(\d+)", http)
        size = int(told[1]) if told else None
    kind = fields.get("warc-type")
    if kind == "revisit":
        payload = None
    else:
        size = len(payload)
    digest = fields.get("warc-payload-digest", "")
    digest = base64.b32decode(digest[5:]).hex() if digest.startswith("sha1:") and len(digest) == 37 else None
    bare = lambda v: v.strip("<>") if v is not None else None
    return kind, bare(fields.get("warc-record-id")), fields.get("warc-target-uri"), bare(fields.get("warc-refers-to")), digest, size, payload


def read_records(archives: DataFrame, tasks: int | None = None) -> DataFrame:
    """The records of ``archives(archive, bytes)`` as RECORDS, read by range in about equal shares of TASK_BYTES.
    A revisit has no payload, the length is that of its HTTP header. An empty table gives no rows."""
    places = staged(locate(archives), "places")
    if tasks is None:
        tasks = int(-(-(archives.agg(F.sum("bytes")).first()[0] or 0) // TASK_BYTES))
    spread = places.repartition(max(1, tasks, min(places.count(), places.sparkSession.sparkContext.defaultParallelism)))

    def read(batches):
        names = [c.split()[0] for c in RECORDS.split(", ")]
        kinds = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.binary()]
        for batch in batches:
            for path, start, lengths in zip(*[c.to_pylist() for c in batch.columns]):
                files, where = opened(path)
                with files.open_input_file(where) as file:
                    data, at, rows = _read(file, start, sum(lengths)), 0, []
                for length in lengths:
                    record = data[at : at + length]
                    plain = zlib.decompress(record, _GZIP) if record[:2] == b"\x1f\x8b" else record
                    rows.append((path, start + at, length, *parse(plain)))
                    at += length
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)

    return spread.mapInArrow(read, RECORDS)


def resolved(records: DataFrame) -> DataFrame:
    """``records`` with the payload of its response in place of a revisit's null, joined by record id."""
    originals = records.where("record_type = 'response'").select(F.col("record_id").alias("refers_to"), F.col("payload").alias("_held"))
    out = records.join(originals, "refers_to", "left")
    return out.withColumn("payload", F.coalesce("payload", "_held")).select(records.columns)


def page_of(column: str) -> F.Column:
    """The page_id that a record id of ``write_archives`` begins with; null where the page had none."""
    return F.regexp_extract(column, r"^urn:page:(-?\d*):", 1).try_cast("long")


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes ``pages`` into archives and reads them back: a row per page. Length and digest of a response are those of
    the payload read, of a revisit those of its headers. See ``write_archives`` for odd rows."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    records = read_records(write_archives(pages, new_path(spark, "warc")))
    digest = F.when(F.col("record_type") == "revisit", F.col("payload_digest")).otherwise(F.sha1("payload"))
    return records.select(page_of("record_id").alias("page_id"), F.col("payload_length").alias("payload_bytes"), digest.alias("payload_digest"), "record_type", page_of("refers_to").alias("refers_to"))


SQL = """with p as (select page_id, coalesce(html, '') as h from pages), d as (select page_id, octet_length(encode(h)) as n, sha1(h) as s from p),
 r as (select *, max(page_id) over (partition by s) as top, row_number() over (partition by s, page_id) as k from d)
 select page_id, n::bigint as payload_bytes, s as payload_digest, case when n>=1000 and (k>1 or page_id is distinct from top) then 'revisit' else 'response' end as record_type,
  case when n>=1000 and (k>1 or page_id is distinct from top) then top end as refers_to from r"""
