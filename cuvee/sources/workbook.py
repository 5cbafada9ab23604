"""Sheets of another source, landed as CSV or Parquet, to (commodity, attribute, marketing_year, value)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import clean_number, normalize_label, two_digit_year


def _named(long: DataFrame, names: DataFrame, commodity: str) -> DataFrame:
    """Rows whose label is listed in ``names`` (alias, slug) and whose cell holds a number."""
    a = names.select(normalize_label(F.col("alias")).alias("_alias"), F.col("slug").alias("attribute"))
    d = long.withColumn("_alias", normalize_label(F.col("label"))).join(a, "_alias")
    d = d.select(F.lit(commodity).alias("commodity"), "attribute", "marketing_year", clean_number(F.col("cell")).alias("value"))
    return d.where("value IS NOT NULL AND marketing_year IS NOT NULL")


def attributes_by_row(sheet: DataFrame, label: str, names: DataFrame, commodity: str) -> DataFrame:
    """A sheet with an attribute a row and a year a column, headed such as 72/73."""
    years = [c for c in sheet.columns if c != label]
    long = sheet.select(F.col(label).cast("string").alias("label"), *[F.col(f"`{c}`").cast("string").alias(c) for c in years])
    long = long.unpivot("label", [F.col(f"`{c}`") for c in years], "_year", "cell")
    return _named(long.withColumn("marketing_year", two_digit_year(F.col("_year"))), names, commodity)


def years_by_row(sheet: DataFrame, year: str, names: DataFrame, commodity: str) -> DataFrame:
    """A sheet with a starting year a row and an attribute a column."""
    columns = [c for c in sheet.columns if c != year]
    start = F.col(year).cast("string").try_cast("int")
    my = F.concat(start.cast("string"), F.lit("/"), F.lpad(((start + 1) % 100).cast("string"), 2, "0"))
    long = sheet.select(my.alias("marketing_year"), *[F.col(f"`{c}`").cast("string").alias(c) for c in columns])
    return _named(long.unpivot("marketing_year", [F.col(f"`{c}`") for c in columns], "label", "cell"), names, commodity)
