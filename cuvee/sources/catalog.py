"""The release catalog: JSON pages decoded to releases, and where their files are archived."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SCHEMA = "pager struct<current_page:int,items_per_page:int,total_pages:int,total_results:int>, results array<struct<id:string,title:string,release_datetime:string,files:array<string>>>"
#: Eras by best available format, best first.
ERAS = (("xml", "xml"), ("txt", "txt"), ("zip", "txt"), ("pdf", "pdf_scan"))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed catalog pages, one JSON document a file."""
    return spark.read.schema(SCHEMA).option("multiLine", True).json(path)


def extension(url):
    return F.lower(F.substring_index(url, ".", -1))


def releases(pages: DataFrame, prefix: str = "report") -> DataFrame:
    """One row a release; where pages overlap the entry of the earlier page counts. The printed local time is kept as
    it is, without its zone."""
    d = pages.select(F.col("pager.current_page").alias("page"), F.posexplode("results").alias("pos", "r"))
    return entry_releases(d.select("page", "pos", "r.*"), prefix)


def entry_releases(entries: DataFrame, prefix: str = "report") -> DataFrame:
    """``releases`` of entries (page, pos, id, title, release_datetime, files), such as the data source gives."""
    first = Window.partitionBy("id").orderBy("page", "pos")
    d = entries.withColumn("_n", F.row_number().over(first)).where("_n = 1")
    versions = F.transform("files", lambda f: F.nullif(F.regexp_extract(f, r"(?i)v([0-9]+)\.[a-z]+$", 1), F.lit("")).cast("int"))
    d = d.select(
        F.col("id").alias("catalog_id"), "title", F.try_to_timestamp(F.left("release_datetime", F.lit(19)), F.lit("yyyy-MM-dd'T'HH:mm:ss")).alias("release_datetime"),
        "files", F.coalesce(F.array_max(versions), F.lit(1)).alias("version"),
    )
    era = F.lit(None).cast("string")
    for ext, name in ERAS:
        era = F.coalesce(era, F.when(F.array_contains(F.transform("files", extension), ext), name))
    day = F.date_format("release_datetime", "yyyy-MM-dd")
    tail = F.when(F.col("version") > 1, F.concat(F.lit("-v"), F.col("version").cast("string"))).otherwise("")
    return d.withColumns(
        {
            "release_id": F.concat(F.lit(f"{prefix}-"), day, tail),
            "report_month": F.to_date(F.trunc("release_datetime", "month")),
            "format_era": F.coalesce(era, F.lit("unknown")),
        }
    )


def file_for(ext: str):
    """The first file of an extension, or null."""
    return F.get(F.filter("files", lambda f: extension(f) == ext), F.lit(0))


def latest_ids(rel: DataFrame) -> DataFrame:
    """One winner a report month by the catalog's rule: version, then time."""
    return rel.groupBy("report_month").agg(F.max_by("release_id", F.struct("version", "release_datetime")).alias("release_id"))


def archive_plan(rel: DataFrame, canonical: str) -> DataFrame:
    """(release_id, url, ext, target, is_canonical): of a release's files of an extension the first whose base name
    matches ``canonical`` is the main file; others keep their names behind the release's id."""
    d = rel.select("release_id", "report_month", F.explode("files").alias("url")).withColumn("ext", extension("url"))
    base = F.substring_index("url", "/", -1)
    d = d.withColumns({"_base": base, "_hit": F.regexp_replace(base, r"\.[^.]*$", "").rlike(f"(?i)^(?:{canonical})$")})
    order = Window.partitionBy("release_id", "ext").orderBy(F.col("_hit").desc(), "url")
    d = d.withColumn("is_canonical", F.col("_hit") & (F.row_number().over(order) == 1))
    name = F.when(F.col("is_canonical"), F.concat_ws(".", "release_id", "ext")).otherwise(F.concat_ws("__", "release_id", "_base"))
    return d.select("release_id", "url", "ext", F.concat_ws("/", F.date_format("report_month", "yyyy-MM"), name).alias("target"), "is_canonical")
