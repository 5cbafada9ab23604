"""Keys and schemas of the vintage store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A series; the unit is deliberately not part of it.
SERIES = ("table_slug", "commodity", "region", "attribute")
MY = "marketing_year"
CARRIED = ("release_id", "year_status", "unit", "qa_status")

_TYPES = {"string": T.StringType(), "date": T.DateType(), "double": T.DoubleType(), "timestamp": T.TimestampType(), "int": T.IntegerType(), "boolean": T.BooleanType()}


def _schema(columns: str) -> T.StructType:
    """A schema of ``name type`` pairs, without a session."""
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in (c.split() for c in columns.split(", "))])


OBSERVATION = _schema(
    "release_id string, report_month date, table_slug string, region string, commodity string, attribute string, "
    "marketing_year string, year_status string, forecast_month string, value double, unit string, raw_attribute string, "
    "raw_commodity string, source_format string, qa_status string, parsed_at timestamp, fetched_at timestamp"
)
OBSERVATION_KEY = ("release_id", "table_slug", "region", "commodity", "attribute", "marketing_year", "forecast_month")
RELEASE = _schema(
    "release_id string, catalog_id string, title string, release_datetime timestamp, report_month date, version int, "
    "is_latest boolean, format_era string, fetched_at timestamp"
)
EXCEPTION = _schema(
    "release_id string, table_slug string, check_name string, severity string, detail string, observed double, expected double"
)
FAILURE = _schema("release_id string, problem string")
UNMAPPED = _schema("release_id string, table_slug string, raw_label string, kind string")


def series_keys(df: DataFrame) -> list[str]:
    """The series columns that are present."""
    return [c for c in SERIES if c in df.columns]


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in its order and types: missing ones null, others dropped; NaN becomes null."""
    out = []
    for f in schema:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        c = c.cast(f.dataType)
        out.append((F.when(~F.isnan(c), c) if isinstance(f.dataType, T.DoubleType) else c).alias(f.name))
    return df.select(out)
