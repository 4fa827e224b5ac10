"""WARC archives: a deterministic sharded writer, and a reader of what it committed.

Records are range-sorted by page_id: counts and bytes by range of ids give shard borders that depend on the rows alone. Each shard is
written as a sequence of files, rolled by compressed size; record ids, dates, digests and HTTP headers are made anew from the rows, so the
same rows give the same bytes. A file is written under a temporary name and then renamed; tasks that run twice write the same file. The
manifest, a table of the files with their sizes and digests, is itself committed by a rename when all is written, and readers take only what it lists.

Of records with equal payloads of at least `least` bytes, that with the smallest page_id is a response, the others are revisits of it.

Defined results: null html is the empty payload; a null page_id sorts after all others and is written without an id; of rows that repeat page_id and
payload the first is the response, the others revisit it; an empty table gives a manifest without files and an empty table; extra columns are ignored.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Raw bytes in a shard, about; compressed bytes after which a file is rolled; ranges in one count of ids.
SHARD_BYTES, ROLL_BYTES, RANGES = 16 << 20, 32 << 20, 4096
LEVEL, DATE = 6, "2024-01-01T00:00:00Z"
_SPACE = uuid.UUID("9a3c1f6e-7f0b-4b7e-9f5d-3c1a5f0e2d11")


def sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, copy: str = "") -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page_id}{copy}')}>"


def record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One gzip member with one record."""
    lines = [f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"]
    raw = "\r\n".join(["WARC/1.1", *lines, "", ""]).encode() + block + b"\r\n\r\n"
    press = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)  # 31: gzip, whose time field zlib leaves 0
    return press.compress(raw) + press.flush()


def page_record(page_id: int | None, url: str, payload: bytes, digest: str, refers: int | None, revisit: bool, copy: str = "") -> bytes:
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head if revisit else head + payload
    headers = [("WARC-Record-ID", record_id(page_id, copy)), ("WARC-Date", DATE), ("WARC-Target-URI", "".join(url.split()) or "about:blank"), ("Content-Type", "application/http; msgtype=response")]
    headers += [("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{sha1(block)}"), ("X-Payload-Length", str(len(payload)))]
    headers += [("X-Page-ID", str(page_id))] if page_id is not None else []
    if revisit:
        headers += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", record_id(refers))]
        headers += [("X-Refers-To-Page", str(refers))] if refers is not None else []
    return record("revisit" if revisit else "response", headers, block)


def _payloads(pages: DataFrame) -> DataFrame:
    """page_id, url, z, key (tells payloads apart), digest, n."""

    def each(batch):
        press, out = zstandard.ZstdCompressor(level=1), []
        for payload in batch.column(2):
            payload = payload.as_py()
            digest = hashlib.sha1(payload).digest()
            out.append((press.compress(payload), hashlib.blake2b(payload, digest_size=16).digest() + digest, base64.b32encode(digest).decode(), len(payload)))
        z, key, digest, n = zip(*out, strict=True)
        yield pa.record_batch({"page_id": batch.column(0).cast(pa.int64()), "url": batch.column(1).cast(pa.string()), "z": pa.array(z, pa.binary()), "key": pa.array(key, pa.binary()), "digest": digest, "n": pa.array(n, pa.int64())})

    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).cast("binary").alias("html"))
    return common.mapped(rows, each, "page_id long, url string, z binary, key binary, digest string, n long")


def borders(sizes: DataFrame, target: int = SHARD_BYTES) -> list[int]:
    """Ids at which a new shard begins, from page_id and n (bytes) of all records; counts of RANGES ranges at a time go to the driver."""
    ends = sizes.agg(F.min("page_id").alias("a"), F.max("page_id").alias("b")).first()
    if ends.a is None:
        return []

    def ranges(a: int, b: int) -> list[tuple[int, int, int]]:
        width = max(1, -(-(b - a + 1) // RANGES))
        inside = sizes.where(F.col("page_id").between(a, b)) if (a, b) != (ends.a, ends.b) else sizes.where("page_id is not null")
        got = inside.groupBy(F.floor((F.col("page_id").cast("decimal(20,0)") - F.lit(a)) / F.lit(width)).cast("long").alias("r")).agg(F.sum("n").alias("n"), F.count("*").alias("c")).collect()
        out = []
        for r in sorted(got, key=lambda r: r.r):
            low, size = a + r.r * width, r.n + 700 * r.c
            out += ranges(low, min(b, low + width - 1)) if size > 4 * target and width > 1 else [(low, low + width - 1, size)]
        return out

    out, load = [], 0
    for low, _, size in ranges(ends.a, ends.b):
        if load and load + size > target:
            out.append(low)
            load = 0
        load += size
    return out


def write(pages: DataFrame, folder: str, least: int = 0, roll: int = ROLL_BYTES, target: int = SHARD_BYTES) -> DataFrame:
    """Writes pages (page_id, url, html) under a folder that all executors reach (a URI); returns the committed manifest: file, records, bytes, sha256."""
    spark = pages.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path
    at = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    at.mkdirs(path(folder))
    if at.exists(path(f"{folder}/_manifest")):
        raise OSError(f"{folder} has a manifest already")
    facts = common.stored(_payloads(pages).select("page_id", "key", "n"), "warc-facts")
    firsts = facts.where(F.col("n") >= least).groupBy("key").agg(F.min("page_id").alias("first"), F.count("*").alias("copies")).where("copies > 1")
    firsts = common.stored(firsts.select("key", "first", F.lit(True).alias("shared")), "warc-firsts")
    marks = borders(facts, target)
    rows = _payloads(pages).join(firsts, "key", "left")
    shared = spark.sparkContext.broadcast(marks)  # 8 bytes a shard

    def place(batch):
        got = [bisect.bisect_right(shared.value, i) if i is not None else len(shared.value) for i in batch.column(0).to_pylist()]
        yield pa.record_batch([*batch.columns, pa.array(got, pa.int32())], names=[*batch.schema.names, "shard"])

    columns = "page_id long, url string, z binary, key binary, digest string, n long, first long, shared boolean"
    rows = common.mapped(rows.select(*(c.split()[0] for c in columns.split(", "))), place, f"{columns}, shard int")
    dealt = rows.repartitionByRange(len(marks) + 1, "shard").sortWithinPartitions("shard", F.asc_nulls_last("page_id"), "key", "url")

    def each(batches: Iterator[pa.RecordBatch], _schema=None) -> Iterator[pa.RecordBatch]:
        place, path = arrow_fs.FileSystem.from_uri(folder)
        out, shard, last, copies = None, None, None, 0
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for row in batch.to_pylist():
                if row["shard"] != shard:
                    if out:
                        yield out.commit()
                    shard, seq = row["shard"], 0
                    out = File(place, path, shard, seq)
                elif out.size >= roll:
                    yield out.commit()
                    seq += 1
                    out = File(place, path, shard, seq)
                same = (row["page_id"], row["key"], row["url"])
                again = last is not None and same[:2] == last[:2]
                copies = copies + 1 if again else 0
                revisit = bool(row["shared"]) and (row["page_id"] != row["first"] or again)
                out.add(page_record(row["page_id"], row["url"], unpack.decompress(row["z"]), row["digest"], row["first"] if revisit else None, revisit, f"/{copies}" if copies else ""))
                last = same
        if out:
            yield out.commit()

    tmp = f"{folder}/_manifest-{uuid.uuid4().hex}"
    dealt.mapInArrow(each, MANIFEST).write.json(tmp)
    for left in at.globStatus(path(f"{folder}/.part-*")) or ():  # temporary files of attempts that failed
        at.delete(left.getPath(), False)
    common.dropped(facts, firsts)
    if not at.rename(path(tmp), path(f"{folder}/_manifest")):
        raise OSError(f"{folder}: the manifest can't be committed")
    return spark.read.schema(MANIFEST).json(f"{folder}/_manifest")


MANIFEST = "file string, records long, bytes long, sha256 string"


class File:
    """One archive, under a temporary name until commit()."""

    def __init__(self, place: arrow_fs.FileSystem, folder: str, shard: int, seq: int):
        self.place, self.name = place, f"part-{shard:06d}-{seq:05d}.warc.gz"
        self.tmp, self.to = f"{folder}/.{self.name}-{uuid.uuid4().hex}", f"{folder}/{self.name}"
        self.out, self.size, self.records, self.digest = place.open_output_stream(self.tmp), 0, -1, hashlib.sha256()
        info = f"format: WARC File Format 1.1\r\nfilename: {self.name}\r\n".encode()
        self.add(record("warcinfo", [("WARC-Record-ID", record_id(None, self.name)), ("WARC-Date", DATE), ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")], info))

    def add(self, member: bytes) -> None:
        self.out.write(member)
        self.digest.update(member)
        self.size += len(member)
        self.records += 1

    def commit(self) -> pa.RecordBatch:
        self.out.close()
        if self.place.get_file_info(self.to).type != arrow_fs.FileType.NotFound:  # of an attempt that was lost after this; its bytes are the same, and not all stores rename onto a file
            self.place.delete_file(self.to)
        self.place.move(self.tmp, self.to)
        return pa.record_batch({"file": [self.name], "records": pa.array([self.records], pa.int64()), "bytes": pa.array([self.size], pa.int64()), "sha256": [self.digest.hexdigest()]})


def records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a gzipped archive, a record at a time."""
    press, raw, data = zlib.decompressobj(31), [], b""
    while True:
        data = data or stream.read(1 << 20)
        if not data:
            if raw and any(raw):
                raise EOFError("the archive ends within a record")
            return
        raw.append(press.decompress(data))
        data = press.unused_data
        if press.eof:
            head, _, rest = b"".join(raw).partition(b"\r\n\r\n")
            headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
            yield headers, rest[: int(headers["Content-Length"])]
            press, raw = zlib.decompressobj(31), []


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, url, payload (null for revisits) of every record of the files listed. Digests of responses are made from what was read and must agree with the headers."""

    def each(batches: Iterator[pa.RecordBatch], _schema=None) -> Iterator[pa.RecordBatch]:
        place, path = arrow_fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, load = [], 0
                with place.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for headers, block in records(stream):
                        if headers["WARC-Type"] == "warcinfo":
                            continue
                        revisit = headers["WARC-Type"] == "revisit"
                        payload = None if revisit else block.partition(b"\r\n\r\n")[2]
                        digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                        if payload is not None and sha1(payload) != digest:
                            raise ValueError(f"{name}: a payload doesn't have its digest")
                        number = lambda k: int(headers[k]) if k in headers else None  # noqa: B023, E731
                        rows.append({"page_id": number("X-Page-ID"), "payload_bytes": number("X-Payload-Length"), "payload_digest": digest, "record_type": headers["WARC-Type"], "refers_to": number("X-Refers-To-Page"), "url": headers["WARC-Target-URI"], "payload": payload})
                        load += len(payload or b"")
                        if load > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, load = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.binary())])
    files = manifest.select("file").repartition(max(1, manifest.sparkSession.sparkContext.defaultParallelism * 2))
    return files.mapInArrow(each, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary")
