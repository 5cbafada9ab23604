"""Landed report files to texts."""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def unzipped(files: DataFrame, suffix: str = ".txt") -> DataFrame:
    """(path, content): the first member of each archive whose name ends in ``suffix``; null where there is none or the
    archive can't be read, so that one bad file doesn't end the job."""

    def first(content: bytes) -> bytes | None:
        try:
            with zipfile.ZipFile(io.BytesIO(content)) as z:
                name = next((n for n in z.namelist() if n.lower().endswith(suffix)), None)
                return None if name is None else z.read(name)
        except zipfile.BadZipFile:
            return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [first(c.as_py()) for c in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["path", "content"])

    return files.select("path", "content").mapInArrow(run, "path string, content binary")


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """(path, text) of a folder's text files and of archives that hold one; bytes that aren't UTF-8 are replaced. Spark
    lists no files of zero bytes, so they have no row."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    kind = F.lower(F.substring_index("path", ".", -1))
    plain, packed = files.where(kind == "txt").select("path", "content"), unzipped(files.where(kind == "zip"))
    return plain.unionByName(packed).select("path", F.make_valid_utf8(F.col("content").cast("string")).alias("text"))


#: Rows of an archive's manifest.
MANIFEST = "path string, release_id string, ext string, url string, sha256 string, bytes long, canonical boolean, skipped boolean"


def archived(files: DataFrame, folder: str) -> DataFrame:
    """Writes ``files`` (release_id, ext, url, target, is_canonical, content) below ``folder`` at their targets, and gives
    their MANIFEST rows. A file that exists is never written again: its row tells what lies there, as skipped. Each file is
    written under a name of its attempt's own and linked to its place when complete, so that a task that is killed, repeated
    or run twice leaves each file once and whole. ``folder`` is one that all executors see.

    The rows say what was done when they were made, so ``archive`` writes them down at once."""
    base = folder.removeprefix("file://")

    def put(target: str, content: bytes) -> tuple[bytes, bool]:
        """What lies at the target now, and whether it did before."""
        import os
        import uuid

        path = os.path.join(base, target)
        if not os.path.exists(path):
            os.makedirs(os.path.dirname(path), exist_ok=True)
            tmp = os.path.join(os.path.dirname(path), f".{uuid.uuid4().hex}")
            try:
                with open(tmp, "wb") as f:
                    f.write(content)
                    f.flush()
                    os.fsync(f.fileno())
                os.link(tmp, path)  # fails where another attempt was first
                return content, False
            except FileExistsError:
                pass
            finally:
                if os.path.exists(tmp):
                    os.unlink(tmp)
        with open(path, "rb") as f:
            return f.read(), True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for batch in batches:
            rows = []
            for release, ext, url, target, canonical, content in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if content is None:
                    continue
                lies, before = put(target, content)
                rows.append((f"{folder}/{target}", release, ext, url, hashlib.sha256(lies).hexdigest(), len(lies), canonical, before))
            kinds = [*[pa.string()] * 5, pa.int64(), pa.bool_(), pa.bool_()]
            cols = zip(*rows, strict=True) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=[c.split()[0] for c in MANIFEST.split(", ")])

    return files.select("release_id", "ext", "url", "target", "is_canonical", "content").mapInArrow(run, MANIFEST)


def archive(files: DataFrame, folder: str, store: str) -> int:
    """``archived``, with the manifest kept as the table ``manifest`` of the store (``versions``), by path: a row that is there
    stays, also where its file was only found. A run that died after writing files and before the manifest is made good by the
    next one. The number of files that are new in the manifest."""
    from ..operators import versions

    spark = files.sparkSession
    done = archived(files, folder).withColumn("month", F.element_at(F.split("path", "/"), -2)).withColumn("archived_at", F.current_timestamp())
    place = f"{store}/data/manifest-rows/{uuid.uuid4().hex}"
    done.write.parquet(place)
    rows = spark.read.schema(done.schema).parquet(place)

    def add(change: versions.Change) -> None:
        change.merge("manifest", rows, "month", lambda old, new: old.unionByName(new.dropDuplicates(["path"]).join(old, "path", "left_anti")))

    before = versions.read(spark, store, versions.version(spark, store), "manifest", rows.schema).count()
    versions.transact(spark, store, add)
    return versions.read(spark, store, versions.version(spark, store), "manifest").count() - before


def damaged(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """(path, kind) of a manifest (path, sha256) whose file is missing (or empty) or other than what was archived."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    have = files.select("path", F.sha2("content", 256).alias("_found"))
    d = manifest.select("path", "sha256").join(have, "path", "left").where(~F.col("_found").eqNullSafe(F.col("sha256")))
    return d.select("path", F.when(F.col("_found").isNull(), "missing").otherwise("changed").alias("kind"))
