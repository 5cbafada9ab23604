"""Transcribed pages (JSON documents of sections, rows and values) to cells.

A document is ``{"sections": [{"commodity_heading": ..., "rows": [{"label": ..., "values": [number or null, ...]}]}]}``. Sections,
rows and values keep their positions; a value's column is its position among the page's columns, and values beyond the
last column are dropped. Nulls are illegible cells and stay as rows without a value. A document that isn't of this form gives
no cells and one row of ``malformed``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .pages import columns_of

SCHEMA = "sections array<struct<commodity_heading:string,rows:array<struct<label:string,values:array<double>>>>>, _bad string"


def _decoded(documents: DataFrame) -> DataFrame:
    how = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    return documents.withColumn("_d", F.from_json("document", SCHEMA, how))


def _broken() -> Column:
    return F.col("_d").isNull() | F.col("_d._bad").isNotNull() | F.col("_d.sections").isNull()


def values(documents: DataFrame) -> DataFrame:
    """(release_id, section, heading, row, label, place, value) of documents (release_id, document), positions from 0."""
    d = _decoded(documents).where(~_broken())
    d = d.select("release_id", F.posexplode("_d.sections").alias("section", "s"))
    d = d.select("release_id", "section", F.col("s.commodity_heading").alias("heading"), F.posexplode("s.rows").alias("row", "r"))
    return d.select("release_id", "section", "heading", "row", F.col("r.label").alias("label"), F.posexplode("r.values").alias("place", "value"))


def cells(documents: DataFrame) -> DataFrame:
    """``values`` of documents (release_id, report_month, document) with their columns: marketing_year, year_status and
    forecast_month."""
    d = values(documents).join(documents.select("release_id", columns_of("report_month").alias("_cols")), "release_id")
    d = d.where(F.col("place") < F.size("_cols")).withColumn("_c", F.get("_cols", F.col("place")))
    return d.select("release_id", "section", "heading", "row", "label", "place", "value", "_c.*")


def malformed(documents: DataFrame) -> DataFrame:
    """Rows for the unmapped table: documents that give no cells because of their form."""
    d = _decoded(documents).where(_broken() | F.col("document").isNull())
    return d.select("release_id", F.lit(None).cast("string").alias("table_slug"), F.lit("not a document of sections").alias("raw_label"), F.lit("structure").alias("kind"))
