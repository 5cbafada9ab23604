"""The update run from landed report files: files to cells, to observations of the published store.

Files lie where the catalog's archive plan puts them. Of a release the best format counts (XML, then text, then an
archive with a text). What can't be read or resolved is a row of the unmapped table, so that one bad report neither
stops the others nor disappears.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dims import alias_collisions, normalize_cells
from ..schemas import OBSERVATION, UNMAPPED, conform
from ..sources import landed, text_reports, xml_report
from .ingest import shared
from .update import Check, load, stream_id

FORMATS = ("xml", "txt", "zip")


@dataclass(frozen=True)
class Registry:
    """Short lists: the tables of XML and text reports, headings within national text tables, and the aliases (alias,
    slug) of attributes, commodities and units. A slug is an alias of itself."""

    xml_tables: DataFrame
    text_tables: DataFrame
    sections: DataFrame
    attributes: DataFrame
    commodities: DataFrame
    units: DataFrame

    def checked(self) -> Registry:
        """The registry with each slug among its aliases; an alias of two slugs is an error."""
        lists = {}
        for name in ("attributes", "commodities", "units"):
            d = getattr(self, name).select("alias", "slug")
            lists[name] = d.unionByName(d.select(F.col("slug").alias("alias"), "slug")).select(xml_report.normalize_label(F.col("alias")).alias("alias"), "slug").distinct()
            if twice := alias_collisions(lists[name]).first():
                raise ValueError(f"{name}: {twice['alias']!r} means {twice['n_slugs']} slugs")
        return Registry(**{f.name: lists.get(f.name, getattr(self, f.name)) for f in fields(self)})


def chosen(files: DataFrame, plan: DataFrame, releases: DataFrame) -> DataFrame:
    """(path, content, ext, release_id, report_month) of those ``files`` that the plan has as their release's best main
    file, whichever of a release's files are there."""
    rank = F.array_position(F.array(*[F.lit(x) for x in FORMATS]), F.col("ext"))
    best = plan.where("is_canonical").where(rank > 0).groupBy("release_id").agg(F.min_by(F.struct("target", "ext"), rank).alias("b"))
    best = best.select("release_id", "b.*").join(releases.select("release_id", "report_month"), "release_id")
    return files.select("path", "content", F.substring_index("path", "/", -2).alias("target")).join(best, "target").drop("target")


def parsed(files: DataFrame, registry: Registry) -> tuple[DataFrame, DataFrame]:
    """(observations, unmapped) of ``chosen`` files. A release's rows that agree in their key are left to the store."""
    spark = files.sparkSession
    here = shared(spark)

    def kept(d: DataFrame, name: str) -> DataFrame:
        d.write.parquet(f"{here}/{name}")
        return spark.read.schema(d.schema).parquet(f"{here}/{name}")

    files = kept(files, "files")
    release = files.select(F.col("path").alias("file"), "release_id", "report_month")
    raw = kept(xml_report.raw_cells(files.where("ext = 'xml'")), "raw")
    packed = landed.unzipped(files.where("ext = 'zip'"))
    content = files.where("ext = 'txt'").select("path", "content").unionByName(packed).withColumnRenamed("path", "file")
    texts = content.join(release, "file").select("release_id", "report_month", F.make_valid_utf8(F.col("content").cast("string")).alias("text"))

    r = registry.checked()
    of_xml = xml_report.cells(raw, r.xml_tables).join(release, "file").withColumn("source_format", F.lit("xml"))
    of_text = text_reports.cells(texts, r.text_tables, r.sections).withColumnRenamed("commodity", "raw_commodity").withColumn("source_format", F.lit("txt"))
    found = kept(of_xml.unionByName(of_text, allowMissingColumns=True), "cells")
    cells, misses = normalize_cells(found, r.attributes, r.commodities, r.units)
    obs = conform(cells.withColumns({"qa_status": F.lit("ok"), "parsed_at": F.current_timestamp()}), OBSERVATION)

    row = lambda d, slug, label, kind: d.select("release_id", slug.alias("table_slug"), label.alias("raw_label"), F.lit(kind).alias("kind"))
    none = F.lit(None).cast("string")
    problems = [
        misses,
        row(xml_report.structure_errors(raw, r.xml_tables).join(release, "file"), F.col("table_slug"), F.col("problem"), "structure"),
        row(xml_report.unread_tables(raw, r.xml_tables).where("kind = 'unknown'").join(release, "file"), none, F.col("title"), "table"),
        row(text_reports.structure_errors(texts, r.text_tables), F.col("table_slug"), F.col("problem"), "structure"),
        row(text_reports.unknown_tables(texts, r.text_tables), none, F.col("title"), "table"),
        row(texts.where("text IS NULL"), none, F.lit("no text in archive"), "structure"),
    ]
    unmapped = problems[0].select("release_id", "table_slug", "raw_label", "kind")
    for p in problems[1:]:
        unmapped = unmapped.unionByName(p)
    return obs, conform(unmapped.distinct(), UNMAPPED)


def top_unmapped(unmapped: DataFrame, k: int = 25, releases: DataFrame | None = None, era: str | None = None) -> DataFrame:
    """The ``k`` labels that most releases miss; with ``era``, of the ``releases`` of that era."""
    if era is not None:
        unmapped = unmapped.join(releases.where(F.col("format_era") == era).select("release_id"), "release_id", "left_semi")
    return unmapped.groupBy("kind", "raw_label").agg(F.countDistinct("release_id").alias("n")).orderBy(F.desc("n"), "kind", "raw_label").limit(k)


def priority_misses(unmapped: DataFrame, priority: list[str]) -> DataFrame:
    """Rows that a strict run must not pass over: anything but a unit in a priority table."""
    return unmapped.where(F.col("table_slug").isin(priority) & (F.col("kind") != "unit"))


def failed_releases(obs: DataFrame, unmapped: DataFrame, priority: list[str] | None) -> DataFrame:
    """(release_id, problem): releases with a miss in a priority table, and those without observations that have a problem
    of structure. Of several problems the first by text counts."""
    row = lambda d: d.select("release_id", F.concat_ws(": ", "table_slug", "kind", "raw_label").alias("problem"))
    bad = row(unmapped.where("kind = 'structure'").join(obs.select("release_id"), "release_id", "left_anti"))
    if priority:
        bad = bad.unionByName(row(priority_misses(unmapped, priority)))
    return bad.groupBy("release_id").agg(F.min("problem").alias("problem"))


def load_files(
    spark: SparkSession, files: DataFrame, plan: DataFrame, releases: DataFrame, registry: Registry, folder: str, priority: list[str] | None = None,
    strict: bool = True, check: Check | None = None, refuse: bool = False, applied: tuple[str, int] | None = None,
) -> int:
    """Loads files (path, content) into the store at ``folder``; its number of observations read. With ``priority``,
    a miss in one of these tables raises before anything is published; where not ``strict``, its release is recorded among
    the failures instead, as are releases that can't be read, and the others load. ``check`` and ``refuse`` as in ``load``."""
    obs, unmapped = parsed(chosen(files, plan, releases), registry)
    here = shared(spark)
    for name, d in (("obs", obs), ("unmapped", unmapped)):
        d.write.parquet(f"{here}/{name}")
    obs, unmapped = (spark.read.schema(d.schema).parquet(f"{here}/{n}") for n, d in (("obs", obs), ("unmapped", unmapped)))
    if strict and priority and (miss := priority_misses(unmapped, priority).first()):
        raise ValueError(f"{miss['release_id']}, {miss['table_slug']}: unknown {miss['kind']} {miss['raw_label']!r}")
    touched = obs.select("release_id").union(unmapped.select("release_id")).distinct()
    failures = None if strict else failed_releases(obs, unmapped, priority)
    load(spark, folder, obs, releases.join(touched, "release_id", "left_semi"), unmapped, failures, check, refuse, applied)
    return obs.count()


def run(
    spark: SparkSession, archive: str, releases: DataFrame, plan: DataFrame, registry: Registry, folder: str, checkpoint: str, priority: list[str] | None = None,
    strict: bool = True, check: Check | None = None, refuse: bool = False,
) -> int:
    """Loads report files that are new in ``archive`` (two levels deep, as planned) for the catalog's ``releases``;
    the number of batches. A batch that raises leaves the checkpoint where it was and is run again next time."""
    done: list[int] = []
    schema = "path string, modificationTime timestamp, length long, content binary"

    def one(batch: DataFrame, number: int) -> None:
        load_files(spark, batch, plan, releases, registry, folder, priority, strict, check, refuse, (stream_id(spark, checkpoint), number))
        done.append(number)

    stream = spark.readStream.format("binaryFile").schema(schema).load(f"{archive}/*")
    stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return len(done)
