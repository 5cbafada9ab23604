"""The observation store as versioned Parquet: upsert, replace, winners, views, export.

A table is a folder of numbered versions; ``publish`` writes a new one under another name and renames it when complete.
Readers take the greatest number, so they see the old or the new version whole, and a lost job leaves nothing they would
see. The last ``KEPT`` versions stay for readers that have begun. All merges are joins on keys, never loops over rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import versions
from .vintage import is_headline

KEPT = 3


def last_by_key(incoming: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Of rows with equal keys the one with the greatest ``order``."""
    w = Window.partitionBy(keys).orderBy(F.col(order).desc())
    return incoming.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def _same(keys: list[str]):
    out = F.lit(True)
    for k in keys:
        out = out & F.col(f"t.{k}").eqNullSafe(F.col(f"i.{k}"))
    return out


def upsert(target: DataFrame, incoming: DataFrame, keys: list[str], order: str) -> DataFrame:
    """``target`` with ``incoming`` merged in by key, later rows winning."""
    new = last_by_key(incoming, keys, order).select(target.columns)
    return target.alias("t").join(new.select(keys).alias("i"), _same(keys), "left_anti").unionByName(new)


def replace_release(target: DataFrame, incoming: DataFrame, keys: list[str], order: str) -> DataFrame:
    """``target`` with all rows of the incoming releases replaced."""
    new = last_by_key(incoming, keys, order).select(target.columns)
    # a release may hold a large share of the table, so its rows aren't dealt by release
    return target.join(F.broadcast(incoming.select("release_id").distinct()), "release_id", "left_anti").unionByName(new)


def keyed_update(target: DataFrame, updates: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """``target`` with ``columns`` taken from ``updates`` (unique by ``keys``) where they have the row."""
    new = updates.select(*[F.col(k).alias(f"_{k}") for k in keys], *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_hit"))
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
    d = target.join(new, on, "left")
    return d.select([F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in target.columns])


def latest_winner(releases: DataFrame, obs: DataFrame) -> DataFrame:
    """``releases`` with is_latest set on one a report month: those with observations first, then the latest version."""
    counts = obs.groupBy("release_id").agg(F.count("*").alias("_n"))
    d = releases.join(counts, "release_id", "left")
    w = Window.partitionBy("report_month").orderBy((F.coalesce("_n", F.lit(0)) > 0).desc(), F.col("version").desc(), F.col("release_datetime").desc(), "release_id")
    return d.withColumn("is_latest", F.row_number().over(w) == 1).select(releases.columns)


def observations_latest(obs: DataFrame, releases: DataFrame) -> DataFrame:
    # releases are few however many observations they have, and one may hold a large share of them
    return obs.join(F.broadcast(releases.where("is_latest").select("release_id")), "release_id")


def headline_view(obs: DataFrame, releases: DataFrame) -> DataFrame:
    """The stored view: headline rows of the latest releases, with labelled twins and null values."""
    return observations_latest(obs, releases).where(is_headline())


def balance_view(obs: DataFrame, releases: DataFrame, slugs: list[str]) -> DataFrame:
    return headline_view(obs, releases).where(F.col("table_slug").isin(slugs))


def _versions(spark: SparkSession, table: str) -> tuple:
    """The file system and the complete versions below ``table``, by number."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(table).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(path(f"{table}/v-*")) or []
    return fs, path, sorted((f.getPath().getName() for f in found), key=lambda n: int(n[2:]))


def publish(df: DataFrame, table: str) -> int:
    """Writes a new version of ``table`` (a path) for readers to see; its number of rows."""
    spark = df.sparkSession
    building = f"{table}/_building-{uuid.uuid4().hex}"
    df.write.parquet(building)
    fs, path, known = _versions(spark, table)
    number = int(known[-1][2:]) + 1 if known else 1
    while True:
        try:
            versions.rename_new(spark, building, f"{table}/v-{number:08d}", keep=True)
            break
        except versions.Conflict:  # another run took the number
            number += 1
    for old in known[: max(0, len(known) + 1 - KEPT)]:
        fs.delete(path(f"{table}/{old}"), True)
    return spark.read.parquet(f"{table}/v-{number:08d}").count()


def current(spark: SparkSession, table: str, empty: StructType | None = None) -> DataFrame:
    """The version that readers of ``table`` see, also where it is one of several tables under a pointer (``versions``);
    where nothing is published yet, no rows of the schema ``empty``."""
    folder, _, name = table.rpartition("/")
    if folder.endswith("/exports"):
        folder, name = folder.removesuffix("/exports"), f"exports/{name}"
    together = versions.version(spark, folder)
    if name in together.tables:
        return versions.read(spark, folder, together, name)
    known = _versions(spark, table)[2]
    if not known and empty is not None:
        return spark.createDataFrame([], empty)
    if not known:
        raise FileNotFoundError(f"{table} has no published version")
    return spark.read.parquet(f"{table}/{known[-1]}")


def export(frames: dict[str, DataFrame], folder: str) -> dict[str, int]:
    """Each frame as a published table below ``folder``; rows by name."""
    return {name: publish(df, f"{folder}/{name}") for name, df in frames.items()}
