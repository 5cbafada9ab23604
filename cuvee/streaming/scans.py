"""Scanned reports into the store: page texts to cells, repaired by the balance identities, with a worklist for review.

A page's recognised text is a file ``<release>-p<page>.txt``. Texts are kept whole, by release and page, as the store's
table ``pages`` of their reader; when a page arrives, all pages of its release are read again, since a release is replaced
as one. Nothing recognised is trusted: a column group's cells stand only where the identities hold or mend them, and what is
quarantined is listed in the table ``worklist``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ..operators import balance, store, versions
from ..operators.dims import normalize_cells
from ..schemas import OBSERVATION, UNMAPPED, conform
from ..sources import pages
from .ingest import shared
from .reports import Registry
from .update import Check, load, stream_id

ERA = "pdf_scan"
#: The first month whose pages have the known layout, and the printed label of a cell that was derived.
STRUCTURED_FROM = "1980-01-01"
DERIVED = "(derived from identity)"
PAGE = StructType([StructField("release_id", StringType()), StructField("page_no", IntegerType()), StructField("text", StringType())])
GROUP = ["release_id", "report_month", "table_slug", "region", "commodity", "marketing_year", "forecast_month"]


def page_texts(files: DataFrame) -> DataFrame:
    """(release_id, page_no, text) of files (path, content) named as pages; others are left out, bad bytes replaced."""
    name = lambda k: F.regexp_extract("path", r"([^/]+)-p([0-9]+)\.txt$", k)
    d = files.select(F.url_decode(name(1)).alias("release_id"), name(2).try_cast("int").alias("page_no"), F.make_valid_utf8(F.col("content").cast("string")).alias("text"))
    return d.where("release_id <> '' AND page_no IS NOT NULL")


def without_rows(releases: DataFrame, obs: DataFrame) -> DataFrame:
    """Scanned releases of the structured era that have no observations: those whose pages are to be found again."""
    old = releases.where((F.col("format_era") == ERA) & (F.col("report_month") >= STRUCTURED_FROM))
    return old.join(obs.select("release_id"), "release_id", "left_anti")


def repaired_observations(cells: DataFrame, first_reader: bool = True) -> DataFrame:
    """Observations of normalized ``cells``, repaired by column group. The first reader's derived cells are inserted where
    the page had none, and its cells outside all identities are ok; another reader's are left out, and warn."""
    one = store.last_by_key(cells.withColumn("_order", F.struct("page_no", "ln")), [*GROUP, "attribute"], "_order")
    own = F.struct("unit", "year_status", "raw_attribute")
    g = one.groupBy(*GROUP).agg(
        F.map_from_entries(F.collect_list(F.struct("attribute", "value"))).alias("vals"), F.map_from_entries(F.collect_list(F.struct(F.col("attribute"), own))).alias("_own"),
        F.min_by(F.struct("unit", "year_status", F.lit(DERIVED).alias("raw_attribute")), "attribute").alias("_first"),
    )
    d = balance.repaired(g, emit_derived=first_reader).select(*GROUP, "_own", "_first", F.explode("cells").alias("c"))
    told = F.coalesce(F.try_element_at("_own", F.col("c.attribute")), F.col("_first"))
    status = F.when((F.col("c.qa_status") == "warn") & F.lit(first_reader), "ok").otherwise(F.col("c.qa_status"))
    d = d.select(*GROUP, F.col("c.attribute").alias("attribute"), F.col("c.value").alias("value"), status.alias("qa_status"), told.alias("t"))
    return d.select(*GROUP, "attribute", "value", "qa_status", "t.*", F.lit("ocr").alias("source_format"), F.lit("").alias("raw_commodity"), F.current_timestamp().alias("parsed_at"))


def read(texts: DataFrame, releases: DataFrame, registry: Registry, first_reader: bool = True) -> tuple[DataFrame, DataFrame]:
    """(observations, unmapped) of page texts of ``releases``."""
    r = registry.checked()
    known = [row.alias for row in r.units.select("alias").collect()]
    titled = pages.located(texts.join(releases.select("release_id", "report_month"), "release_id"))
    found = pages.cells(titled, known).withColumns({"raw_commodity": F.col("commodity"), "raw_unit": F.col("unit")}).drop("commodity", "unit")
    cells, misses = normalize_cells(found, r.attributes, r.commodities, r.units)
    return conform(repaired_observations(cells, first_reader), OBSERVATION), conform(misses, UNMAPPED)


def worklist(obs: DataFrame) -> DataFrame:
    return obs.where("qa_status = 'quarantined'").select(*GROUP, "attribute", "value", "unit")


def load_pages(
    spark: SparkSession, texts: DataFrame, releases: DataFrame, registry: Registry, folder: str, first_reader: bool = True, missing_only: bool = False,
    check: Check | None = None, applied: tuple[str, int] | None = None,
) -> int | None:
    """Keeps page texts and loads their releases into the store at ``folder``, with ``missing_only`` those alone that have no
    observations yet; the version's number. Pages of releases that aren't of the scanned era are kept and not read."""
    table = "pages" if first_reader else "pages2"
    how = lambda old, new: store.upsert(old, new.withColumn("_order", F.xxhash64("text")), ["release_id", "page_no"], "_order")
    versions.transact(spark, folder, lambda c: c.merge(table, texts.select(PAGE.names), "release_id", how) and None, applied and (f"{applied[0]}/{table}", applied[1]))
    mine = releases.where(F.col("format_era") == ERA).join(texts.select("release_id"), "release_id", "left_semi")
    if missing_only:
        mine = without_rows(mine, store.current(spark, f"{folder}/observations", OBSERVATION))
    names = versions.parts_of(mine, "release_id")
    kept = versions.read(spark, folder, versions.version(spark, folder), table, PAGE, names)
    here = shared(spark)
    obs, unmapped = read(kept, mine, registry, first_reader)
    obs.write.parquet(f"{here}/obs")
    unmapped.write.parquet(f"{here}/unmapped")
    obs, unmapped = spark.read.schema(OBSERVATION).parquet(f"{here}/obs"), spark.read.schema(UNMAPPED).parquet(f"{here}/unmapped")
    if missing_only and not names:
        return None
    return load(spark, folder, obs, mine, unmapped, check=check, applied=applied, beside={"worklist": worklist(obs)})


def run(spark: SparkSession, archive: str, releases: DataFrame, registry: Registry, folder: str, checkpoint: str, first_reader: bool = True, missing_only: bool = False, check: Check | None = None) -> int:
    """Loads page texts that are new in ``archive``; the number of batches."""
    done: list[int] = []
    schema = "path string, modificationTime timestamp, length long, content binary"

    def one(batch: DataFrame, number: int) -> None:
        load_pages(spark, page_texts(batch), releases, registry, folder, first_reader, missing_only, check, (stream_id(spark, checkpoint), number))
        done.append(number)

    stream = spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", "*.txt").load(archive)
    stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return len(done)
