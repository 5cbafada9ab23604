"""Several tables under one pointer: a version lists the folders of every table's partitions, and a change publishes all
its tables at once or none.

A change writes only the partitions that it touches, into a folder of its own, and its version refers to the untouched
ones where they lie; so what it writes follows the batch, not the tables. A version is one small file, made under another
name and renamed where its number is still free (the rename refuses an existing file, as on HDFS and viewfs). Readers take
the greatest number and keep their files; a lost job leaves folders that no version lists. Where another change took the
number first, the work is done again on top of it.

``applied`` in a version tells the last batch of each stream that it holds, so that a replayed batch is recognised. A
version has an entry for each partition (for reports: a release), and these names pass through the driver, as they do for
any folder that Spark reads.
"""

from __future__ import annotations

import json
import time
import uuid
import zlib
from collections.abc import Callable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: The column that names a row's partition, in folders only.
PART = "store_part"
#: The partition of tables that have one only.
WHOLE = "all"
#: From so many partitions on a table keeps them in PACKS parts, dealt by their names, so that many small releases are
#: not as many files; a change then writes the parts of its releases, with the rows of others that lie there.
PACKED = 400
PACKS = 64
PACK = "~pack-"


class Conflict(Exception):
    """Another change published first."""


class Unchecked(Exception):
    """A check refused the version."""


@dataclass
class Version:
    number: int = 0
    #: By table: schema (JSON) and parts, the folder of each partition below the store's.
    tables: dict[str, dict] = field(default_factory=dict)
    applied: dict[str, int] = field(default_factory=dict)


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def numbers(spark: SparkSession, folder: str) -> list[int]:
    _, p, fs = _hadoop(spark, f"{folder}/_versions/v-*")
    return sorted(int(f.getPath().getName()[2:]) for f in fs.globStatus(p) or [])


def version(spark: SparkSession, folder: str, number: int | None = None) -> Version:
    """The version of this number, else the latest; an empty one where nothing is published."""
    if number is None:
        known = numbers(spark, folder)
        if not known:
            return Version()
        number = known[-1]
    jvm, p, fs = _hadoop(spark, f"{folder}/_versions/v-{number:010d}")
    stream = fs.open(p)
    try:
        told = json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Version(number, told["tables"], told["applied"])


def _claim(spark: SparkSession, folder: str, v: Version) -> None:
    """Publishes ``v``, unless its number is taken."""
    jvm, tmp, fs = _hadoop(spark, f"{folder}/_versions/.{uuid.uuid4().hex}")
    out = fs.create(tmp, True)
    out.write(bytearray(json.dumps({"tables": v.tables, "applied": v.applied}).encode()))
    out.close()
    rename_new(spark, tmp.toString(), f"{folder}/_versions/v-{v.number:010d}")


def rename_new(spark: SparkSession, old: str, new: str, keep: bool = False) -> None:
    """Renames a file or folder to a name that is free. Where it isn't: ``Conflict``, and ``old`` is deleted, unless to
    ``keep``."""
    jvm, src, fs = _hadoop(spark, old)
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(src.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(src, jvm.org.apache.hadoop.fs.Path(new), how)
    except Py4JJavaError as e:
        if "FileAlreadyExists" not in str(e.java_exception.getClass().getName()):
            raise
        if not keep:
            fs.delete(src, True)
        raise Conflict(new) from None


def part_of(value: Column) -> Column:
    """A value's partition: letters, digits and ``.-_`` as they are, others by their bytes."""
    coded = F.replace(F.replace(F.url_encode(value.cast("string")), F.lit("*"), F.lit("%2A")), F.lit("+"), F.lit("%20"))
    return F.coalesce(F.translate(coded, "%", "@"), F.lit("@null"))


def parts_of(rows: DataFrame, column: str) -> list[str]:
    return sorted(r.p for r in rows.select(part_of(F.col(column)).alias("p")).distinct().collect())


def pack_of(part: Column) -> Column:
    return F.concat(F.lit(PACK), F.crc32(part) % PACKS)


def pack(part: str) -> str:
    """``pack_of`` of a name."""
    return f"{PACK}{zlib.crc32(part.encode()) % PACKS}"


def _named(spark: SparkSession, names: list[str]) -> DataFrame:
    return F.broadcast(spark.createDataFrame([(n,) for n in names], "_part string"))


def read(spark: SparkSession, folder: str, v: Version, name: str, empty: StructType | None = None, parts: list[str] | None = None) -> DataFrame:
    """A version's table, or those of its partitions that are named; without rows where it has none."""
    told = v.tables.get(name)
    if told is None and empty is None:
        raise FileNotFoundError(f"{folder} has no table {name}")
    schema = StructType.fromJson(json.loads(told["schema"])) if told else empty
    lie = told["parts"] if told else {}
    if parts is not None and told and told.get("packed"):
        paths = [f"{folder}/{lie[p]}" for p in sorted({pack(n) for n in parts}) if p in lie]
        if not paths:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(*paths).join(_named(spark, parts), part_of(F.col(told["packed"])) == F.col("_part"), "left_semi")
    paths = [f"{folder}/{lie[p]}" for p in (sorted(lie) if parts is None else parts) if p in lie]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


class Change:
    """A new version in the making. ``on_step`` is told each step's name before it is done."""

    def __init__(self, spark: SparkSession, folder: str, on_step: Callable[[str], None] | None = None):
        self.spark, self.folder, self.on_step = spark, folder.rstrip("/"), on_step or (lambda name: None)
        self.base = version(spark, self.folder)
        self.next = Version(self.base.number + 1, {n: {**t, "parts": dict(t["parts"])} for n, t in self.base.tables.items()}, dict(self.base.applied))
        self.id = uuid.uuid4().hex

    def read(self, name: str, empty: StructType | None = None, parts: list[str] | None = None) -> DataFrame:
        """The table as this change leaves it so far."""
        return read(self.spark, self.folder, self.next, name, empty, parts)

    def replace(self, name: str, rows: DataFrame, by: str | None = None, touched: DataFrame | list[str] | None = None) -> DataFrame:
        """Partitions of the column ``by`` that ``rows`` or ``touched`` (with that column, or the partitions' names) have now
        hold ``rows`` alone; without ``by`` the whole table does. What was written, to be read on."""
        self.on_step(f"write {name}")
        table = self.next.tables.setdefault(name, {"parts": {}})
        table["schema"] = rows.schema.json()
        names = touched if touched is None or isinstance(touched, list) else parts_of(touched, by)
        part = F.lit(WHOLE) if by is None else part_of(F.col(by))
        if by is None:
            table.pop("packed", None)
        elif table.get("packed") or len({*table["parts"], *(names or [])}) > PACKED:
            rows, names, part = self._packed(name, table, rows, by, names or [])
        gone = list(table["parts"]) if by is None else names or []
        place = f"data/{name}/{self.id}-{len(gone)}-{uuid.uuid4().hex[:8]}"
        d = rows.withColumn(PART, part).hint("rebalance", PART)
        d.write.partitionBy(PART).parquet(f"{self.folder}/{place}")
        _, p, fs = _hadoop(self.spark, f"{self.folder}/{place}")
        made = {s.getPath().getName().split("=", 1)[1]: f"{place}/{s.getPath().getName()}" for s in fs.listStatus(p) if s.isDirectory() and "=" in s.getPath().getName()}
        for g in gone:
            table["parts"].pop(g, None)
        table["parts"].update(made)
        return read(self.spark, self.folder, Version(0, {name: {"schema": table["schema"], "parts": made}}), name)

    def _packed(self, name: str, table: dict, rows: DataFrame, by: str, names: list[str]) -> tuple[DataFrame, list[str], Column]:
        """What packed parts hold after partitions are replaced: ``rows``, the other rows of the parts that are written (all,
        where the table wasn't packed yet), these parts and their column."""
        if table["parts"]:
            names = sorted({*names, *parts_of(rows, by)})
            packs = sorted({pack(n) for n in names}) if table.get("packed") else list(table["parts"])
            lie = Version(0, {name: {"schema": table["schema"], "parts": {p: f for p, f in table["parts"].items() if p in set(packs)}}})
            old = read(self.spark, self.folder, lie, name)
            rows = rows.unionByName(old.join(_named(self.spark, names), part_of(F.col(by)) == F.col("_part"), "left_anti").select(rows.columns))
        else:
            packs = []
        table["packed"] = by
        return rows, packs, pack_of(part_of(F.col(by)))

    def merge(self, name: str, rows: DataFrame, by: str, how: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
        """Partitions that ``rows`` have become ``how(their old rows, rows)``; no other is read or written."""
        touched = parts_of(rows, by)
        return self.replace(name, how(self.read(name, rows.schema, touched), rows), by, touched)

    def alias(self, name: str, of: str) -> None:
        """``name`` is what ``of`` is, without a copy."""
        if of in self.next.tables:
            self.next.tables[name] = {**self.next.tables[of], "parts": dict(self.next.tables[of]["parts"])}

    def lend(self, name: str, of: str, parts: list[str], touched: list[str]) -> bool:
        """Of the partitions ``touched``, ``name`` has now ``parts``, as they lie in ``of``, without a copy. False, and nothing
        is done, where partitions don't lie by themselves."""
        source, table = self.next.tables.get(of), self.next.tables.get(name, {"parts": {}})
        if source is None or source.get("packed") or table.get("packed"):
            return False
        self.on_step(f"write {name}")
        kept = {p: f for p, f in table["parts"].items() if p not in set(touched)}
        self.next.tables[name] = {"schema": source["schema"], "parts": kept | {p: source["parts"][p] for p in parts if p in source["parts"]}}
        return True

    def commit(self) -> int:
        self.on_step("publish")
        _claim(self.spark, self.folder, self.next)
        return self.next.number


def transact(
    spark: SparkSession, folder: str, work: Callable[[Change], None], applied: tuple[str, int] | None = None, attempts: int = 5,
    on_step: Callable[[str], None] | None = None,
) -> int | None:
    """Publishes what ``work`` does to a change; the version's number, or None where the stream's batch ``applied`` (its
    name and number) is in the store already. Work that raises publishes nothing."""
    for k in range(attempts):
        change = Change(spark, folder, on_step)
        if applied and change.base.applied.get(applied[0], -1) >= applied[1]:
            return None
        work(change)
        if applied:
            change.next.applied[applied[0]] = applied[1]
        try:
            return change.commit()
        except Conflict:
            if k + 1 == attempts:
                raise
    raise AssertionError("attempts is at least 1")


def vacuum(spark: SparkSession, folder: str, keep: int = 3, older_than: float = 86_400.0) -> int:
    """Deletes all but the last ``keep`` versions and folders that none of these lists and that are older than so many
    seconds, so that changes in the making keep theirs; the number of folders deleted."""
    known = numbers(spark, folder)
    for n in known[:-keep]:
        _, p, fs = _hadoop(spark, f"{folder}/_versions/v-{n:010d}")
        fs.delete(p, False)
    used = {x for n in known[-keep:] for t in version(spark, folder, n).tables.values() for x in t["parts"].values()}
    _, p, fs = _hadoop(spark, f"{folder}/data")
    gone, old = 0, (time.time() - older_than) * 1000
    changes = [c.getPath() for t in fs.globStatus(p.suffix("/*")) or [] for c in fs.listStatus(t.getPath())]
    changes += [c.getPath() for c in fs.globStatus(p.suffix("/exports/*/*")) or []]
    for c in changes:
        base = c.toUri().getPath().split("/data/", 1)[-1]
        own = [s for s in fs.listStatus(c) if "=" in s.getPath().getName()]
        for s in own:
            if f"data/{base}/{s.getPath().getName()}" not in used and s.getModificationTime() < old:
                fs.delete(s.getPath(), True)
                gone += 1
    return gone
