"""WARC archives: a deterministic sharded writer and its reader.

Records are range-sorted by page id, payload digest and url. Where a shard begins follows from the bytes that stand before
it in this order, so the same input gives the same files however it is dealt to tasks: a first pass sums sizes by range,
a second finds the shards' first keys, and only those keys are brought to the driver. A shard has a 256th of all bytes, but
no less than ``LEAST_SHARD`` and no more than ``MOST_SHARD``; a page id of many rows, null included, may span several. A
task appends gzip members (one a record, no time stamps) to a file and rolls it when it reaches ``roll_bytes`` compressed.
A file is written under a name of its task attempt and renamed when complete; the manifest, written last by Spark,
lists the files that count, so a lost executor or a repeated task leaves nothing that a reader would see.

Of records with equal payloads the one of the largest page id is the response and the others revisit it. Which one is
known from an aggregate over digests; it travels to the writer as marker rows in the same range sort, so payloads are
shuffled once. A group of copies is aggregated before its shuffle and its marker rows join by digest, where Spark may
split a hot one.

Defined results: a null html is an empty payload; a null url leaves the header out; a null page id sorts first. With
``repeats``, as op6 has it, every row has its record, and all rows of the largest page id are responses; rows equal in
page id and payload are numbered by url, so that record ids stay unique. Without it the one of least url is written.
Rows equal in page id, payload and url lie in one shard. No table rows give an empty archive. Other columns are ignored.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import discard, scratch, written

ROLL_BYTES = 64 << 20
LEAST_SHARD, MOST_SHARD = 4 << 20, 256 << 20
#: Bytes that a record's headers count for.
HEAD_BYTES = 512
#: Fixed value: the profile of a revisit with an identical payload, from the WARC 1.1 standard.
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Fixed value, so that archives of equal input are equal.
DATE = "2020-01-01T00:00:00Z"
MANIFEST = "file string, first_page long, last_page long, records long, bytes long, sha256 string"
RECORDS = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"


def page_urn(page_id: int | None, digest: str, ordinal: int = 1) -> str:
    """The id of a page's record with this payload; rows equal in both have ordinals."""
    return f"<urn:x-page:{'' if page_id is None else page_id}/{digest}{f'/{ordinal}' if ordinal > 1 else ''}>"


def base32_sha1(data: bytes) -> str:
    import hashlib

    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisits: bool, date: str = DATE, ordinal: int = 1) -> bytes:
    """One record with its headers and digests."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisits else http + payload
    digest = base32_sha1(payload)
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisits else 'response'}", f"WARC-Record-ID: {page_urn(page_id, digest, ordinal)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c > " " else f"%{ord(c):02X}" for c in url))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    head.append(f"WARC-Block-Digest: sha1:{base32_sha1(block)}")
    if revisits:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {page_urn(refers_to, digest)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member without a time stamp."""
    import gzip

    return gzip.compress(data, 6, mtime=0)


class _Shard:
    """The files of one task."""

    def __init__(self, folder: str, part: int, roll_bytes: int):
        from pyarrow import fs

        self.fs, self.folder = fs.FileSystem.from_uri(folder)
        self.fs.create_dir(self.folder)
        self.part, self.roll_bytes, self.seq, self.out = part, roll_bytes, 0, None

    def add(self, page_id: int | None, data: bytes) -> None:
        import hashlib

        if self.out is None:
            self.name = f"part-{self.part:06d}-{self.seq:05d}.warc.gz"
            self.temp = f"{self.folder}/_{self.name}.{uuid.uuid4().hex}"
            self.out, self.sum = self.fs.open_output_stream(self.temp, compression=None), hashlib.sha256()
            self.first, self.n, self.size = page_id, 0, 0
        self.out.write(data)
        self.sum.update(data)
        self.last, self.n, self.size = page_id, self.n + 1, self.size + len(data)

    def full(self) -> bool:
        return self.out is not None and self.size >= self.roll_bytes

    def close(self) -> list[tuple]:
        """Renames the open file to its name; its manifest row."""
        if self.out is None:
            return []
        self.out.close()
        self.fs.move(self.temp, f"{self.folder}/{self.name}")
        self.out, self.seq = None, self.seq + 1
        return [(self.name, self.first, self.last, self.n, self.size, self.sum.hexdigest())]


def _prefix() -> Column:
    """Page id, null first, and payload digest as a text that sorts like them."""
    at = F.lpad(F.hex(F.col("page_id").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
    return F.concat(F.coalesce(at, F.lit("")), F.lit("/"), "_sha1")


def _key() -> Column:
    return F.concat(_prefix(), F.lit("/"), F.coalesce("url", F.lit("")))


def shard_starts(keyed: DataFrame, least: int = LEAST_SHARD, most: int = MOST_SHARD) -> list[str]:
    """The first key of each shard but the first: ``keyed`` (page_id, url, _sha1, _n) in order of keys is cut where the
    bytes before a row reach a multiple of a shard's bytes. They are no more than all bytes over ``least``."""
    total = keyed.agg(F.sum(F.col("_n") + HEAD_BYTES)).first()[0] or 0
    size = min(most, max(least, total // 256))
    if total <= size:
        return []
    ranged = keyed.select(_key().alias("key"), (F.col("_n") + HEAD_BYTES).alias("size")).repartitionByRange("key")
    ranged = written(ranged.withColumn("range", F.spark_partition_id()), "ranges")
    before, at = 0, []
    for r in ranged.groupBy("range").agg(F.sum("size").alias("size")).orderBy("range").collect():
        at.append((r.range, before))
        before += r.size
    offsets = keyed.sparkSession.createDataFrame(at, "range int, offset long")
    inside = F.sum("size").over(Window.partitionBy("range").orderBy("key").rowsBetween(Window.unboundedPreceding, -1))
    placed = ranged.join(F.broadcast(offsets), "range").withColumn("at", F.col("offset") + F.coalesce(inside, F.lit(0)))
    first = placed.groupBy(F.floor(F.col("at") / size).alias("shard")).agg(F.min("key").alias("key"))
    out = [r.key for r in first.orderBy("shard").collect()][1:]
    discard(ranged)
    return sorted(set(out))


def _shard_of(starts: list[str]):
    import numpy as np

    ordered = np.array([s.encode() for s in starts], object)

    @F.arrow_udf("int")
    def shard(keys: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(ordered, np.array([k.encode() for k in keys.to_pylist()], object), "right").astype(np.int32))

    return shard


def write_archive(
    pages: DataFrame, folder: str, roll_bytes: int = ROLL_BYTES, repeats: bool = False, least_shard: int = LEAST_SHARD, most_shard: int = MOST_SHARD
) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) below ``folder``, a URI all executors reach; the manifest, which also
    stands in ``folder``/_manifest as Parquet. Rows equal in page id and payload each have a record only with ``repeats``."""
    spark = pages.sparkSession
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"), F.sha1(html).alias("_sha1"))
    keyed = written(rows.select("page_id", "url", "_sha1", F.octet_length("html").cast("long").alias("_n")), "keys")
    leads = keyed.groupBy("_sha1", "_n").agg(F.max("page_id").alias("lead"), F.count("*").alias("_c")).where("_c > 1").drop("_c")
    markers = (
        keyed.join(leads, ["_sha1", "_n"])
        .where(~F.col("page_id").eqNullSafe(F.col("lead")))
        .select("page_id", F.lit(0).alias("kind"), "url", "_sha1", F.lit(None).cast("string").alias("html"), "lead")
    )
    records = rows.select("page_id", F.lit(1).alias("kind"), "url", "_sha1", "html", F.lit(None).cast("long").alias("lead"))
    starts = shard_starts(keyed, least_shard, most_shard)
    shard = _shard_of(starts)(_key()) if starts else F.lit(0)
    # rows of a page id and payload that lie in several shards are numbered on from one to the next
    split = spark.createDataFrame([(p,) for p in sorted({s[: s.index("/") + 41] for s in starts})], "prefix string")
    counted = keyed.withColumn("prefix", _prefix()).join(F.broadcast(split), "prefix").groupBy("prefix", shard.alias("shard")).agg(F.count("*").alias("n"))
    earlier: dict[tuple[int, str], int] = {}
    last, total = None, 0
    for r in counted.orderBy("prefix", "shard").collect() if starts else ():
        total = total if r.prefix == last else 0
        earlier[r.shard, r.prefix.partition("/")[0], r.prefix.partition("/")[2]] = total
        last, total = r.prefix, total + r.n
    n_shards = len(starts) + 1
    ordered = markers.unionByName(records).withColumn("shard", shard).repartitionById(n_shards, "shard").sortWithinPartitions("shard", "page_id", "_sha1", "kind", "url")
    names = [x.split()[0] for x in MANIFEST.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, done = None, []
        group, lead, ordinal = object(), None, 0
        for batch in batches:
            for page_id, kind, url, sha1, html, marked, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None or part != out.part:
                    done += out.close() if out else []
                    out, group = _Shard(folder, part, roll_bytes), object()
                if (page_id, sha1) != group:
                    group, lead = (page_id, sha1), None
                    ordinal = earlier.get((part, "" if page_id is None else f"{page_id + (1 << 63):016X}", sha1), 0)
                if kind == 0:
                    lead = marked
                    continue
                ordinal += 1
                if ordinal > 1 and not repeats:
                    continue
                if out.full():
                    done += out.close()
                out.add(page_id, member(record(page_id, url, html.encode(), lead, lead is not None, ordinal=ordinal)))
        done += out.close() if out else []
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)] if done else [pa.array([], t) for t in (pa.string(), *[pa.int64()] * 4, pa.string())], names=names)

    manifest = f"{folder}/_manifest"
    ordered.mapInArrow(run, MANIFEST).write.parquet(manifest)
    discard(keyed)
    return spark.read.schema(MANIFEST).parquet(manifest)


def _records(stream) -> Iterator[bytes]:
    """The gzip members of an open archive, one at a time."""
    import zlib

    held = stream.read(1 << 20)
    while held:
        d, out = zlib.decompressobj(31), []
        while not d.eof:
            if not held and not (held := stream.read(1 << 20)):
                raise ValueError("archive ends inside a record")
            out.append(d.decompress(held))
            held = d.unused_data
        yield b"".join(out)
        held = held or stream.read(1 << 20)


def parse(raw: bytes) -> tuple:
    """A row of RECORDS from a record; raises where a digest doesn't hold."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    h = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    block = rest[: int(h["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    n = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest = h["warc-payload-digest"].removeprefix("sha1:")
    page = lambda urn: int(n) if (n := urn[len("<urn:x-page:") : -1].partition("/")[0]) else None
    kind = h["warc-type"]
    if h["warc-block-digest"] != "sha1:" + base32_sha1(block) or kind == "response" and (len(payload) != n or base32_sha1(payload) != digest):
        raise ValueError(f"digest mismatch in {h['warc-record-id']}")
    refers = page(h["warc-refers-to"]) if kind == "revisit" else None
    return page(h["warc-record-id"]), h.get("warc-target-uri"), payload if kind == "response" else None, n, digest, kind, refers


def read_archive(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """The records (RECORDS) of the files that the manifest below ``folder`` lists; files are dealt to tasks by name
    and read as streams."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest")
    tasks = max(1, min(manifest.count(), 8 * spark.sparkContext.defaultParallelism))
    kinds = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    names = [x.split()[0] for x in RECORDS.split(", ")]

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        at, path = fs.FileSystem.from_uri(folder)
        for name in (x.as_py() for batch in batches for x in batch.column(0)):
            rows, size = [], 0
            with at.open_input_stream(f"{path}/{name}", compression=None) as stream:
                for raw in _records(stream):
                    row = parse(raw)
                    rows.append(row if payloads else (*row[:2], None, *row[3:]))
                    size += len(raw) if payloads else 200
                    if size > 4 << 20:
                        yield packed(rows)
                        rows, size = [], 0
            if rows:
                yield packed(rows)

    return manifest.select("file").repartition(tasks, "file").mapInArrow(run, RECORDS)


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes ``pages`` and reads the archive back, a record a row, without payloads."""
    folder = folder or scratch(pages.sparkSession, "warc")
    write_archive(pages, folder, repeats=True)
    return read_archive(pages.sparkSession, folder, payloads=False)
