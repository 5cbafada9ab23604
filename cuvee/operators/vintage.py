"""Headline values, revisions, finals, errors and the stocks-to-use ratio of vintage observations.

All functions map DataFrames to DataFrames lazily with built-in expressions. Chains are partitioned by series and
marketing year, so consecutive operators reuse one exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import CARRIED, MY, series_keys


def month_name(month: Column | str) -> Column:
    return F.date_format(month, "MMM")


def is_headline() -> Column:
    """Unlabelled rows and the column of the report's own month."""
    return (F.col("forecast_month") == "") | (F.col("forecast_month") == month_name("report_month"))


def current_values(obs: DataFrame) -> DataFrame:
    """One headline per series, marketing year and report; an unlabelled row wins over a labelled twin, and only then
    are null values dropped."""
    cell = [*series_keys(obs), MY, "report_month"]
    tie = [c for c in ("release_id",) if c in obs.columns]
    first = Window.partitionBy(cell).orderBy((F.col("forecast_month") != "").cast("int"), *tie, F.col("value").asc_nulls_last())
    kept = [c for c in CARRIED if c in obs.columns]
    return (
        obs.where(is_headline())
        .withColumn("_n", F.row_number().over(first))
        .where("_n = 1 AND value IS NOT NULL")
        .select(*cell, *kept, "value")
    )


def vintage_series(obs: DataFrame, marketing_years: list[str] | None = None) -> DataFrame:
    cur = current_values(obs if marketing_years is None else obs.where(F.col(MY).isin(marketing_years)))
    return cur


def mom_changes(obs: DataFrame) -> DataFrame:
    """Revision per headline. A projection printed beside another month's column is compared with that column, which
    may be null (a first print); everything else with the previous available report's headline."""
    cell = [*series_keys(obs), MY, "report_month"]
    kept = [c for c in CARRIED if c in obs.columns]
    head = is_headline()
    tie = [F.col(c) for c in ("release_id",) if c in obs.columns]
    labelled = (F.col("forecast_month") != "").cast("int")
    # one pass a cell; structs keep a printed null apart from no row
    rank = F.struct(labelled, *tie, F.coalesce(F.col("value"), F.lit(float("inf"))))
    cells = obs.groupBy(cell).agg(
        F.min_by(F.when(head, F.struct("value", *kept)), F.when(head, rank)).alias("h"),
        F.min_by(F.when(~head, F.struct("value")), F.when(~head, F.struct("forecast_month", *tie, F.coalesce(F.col("value"), F.lit(float("inf")))))).alias("c"),
    )
    cells = cells.where("h.value IS NOT NULL").select(*cell, *[F.col(f"h.{k}").alias(k) for k in kept], F.col("h.value").alias("value"), "c")
    chain = Window.partitionBy([*series_keys(obs), MY]).orderBy("report_month")
    within = (F.col("year_status") == "projection") & F.col("c").isNotNull()
    d = cells.withColumn("_last", F.lag("value").over(chain)).withColumn("_within", within)
    prev = F.when(F.col("_within"), F.col("c.value")).otherwise(F.col("_last"))
    d = d.select(*cell, *kept, "value", prev.alias("value_prev"), F.when(F.col("_within"), "within_report").otherwise("cross_release").alias("method"), "c", "_last", "_within")
    delta = F.col("value") - F.col("value_prev")
    return d.select(
        *cell,
        *kept,
        "value",
        "value_prev",
        delta.alias("delta"),
        (delta / F.nullif(F.abs("value_prev"), F.lit(0.0))).alias("pct_change"),
        "method",
        F.col("value_prev").isNull().alias("is_first_print"),
        F.when(F.col("_within"), F.col("c.value") - F.col("_last")).alias("reprint_revision"),
    )


def final_values(obs: DataFrame) -> DataFrame:
    """The last headline of each chain with its month and status, and the number of reports."""
    return finals_of(current_values(obs))


def finals_of(cur: DataFrame) -> DataFrame:
    return cur.groupBy([*series_keys(cur), MY]).agg(
        F.max_by("value", "report_month").alias("final_value"),
        F.max("report_month").alias("final_report_month"),
        F.max_by("year_status", "report_month").alias("final_year_status"),
        F.count("*").alias("n_reports"),
    )


def with_errors(cur: DataFrame) -> DataFrame:
    """``attach_errors`` of headlines and their own finals in one pass: the finals are those of the row's chain."""
    chain = Window.partitionBy([*series_keys(cur), MY]).orderBy("report_month").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    last = lambda c: F.last(c).over(chain)
    finals = {"final_value": last("value"), "final_report_month": last("report_month"), "final_year_status": last("year_status"), "n_reports": F.count(F.lit(1)).over(chain)}
    return _errors_against(cur.withColumns(finals))


def months_between(late: str, early: str) -> Column:
    return ((F.year(late) - F.year(early)) * 12 + F.month(late) - F.month(early)).cast("int")


def attach_errors(cur: DataFrame, finals: DataFrame) -> DataFrame:
    """Headlines with their final outcome; the error's denominator is signed."""
    return _errors_against(cur.join(finals, [*series_keys(cur), MY], "left"))


def _errors_against(d: DataFrame) -> DataFrame:
    return d.withColumns(
        {
            "pct_error": (F.col("value") - F.col("final_value")) / F.nullif("final_value", F.lit(0.0)),
            "horizon_months": months_between("final_report_month", "report_month"),
            "calendar_month": F.month("report_month").cast("int"),
        }
    )


def finalized(errors: DataFrame) -> DataFrame:
    return errors.where("final_year_status = 'actual' AND horizon_months > 0")


def stocks_to_use(obs: DataFrame) -> DataFrame:
    """ending_stocks / use_total, column by column, as a further attribute; null where use is 0 or null."""
    on = [c for c in (*[k for k in series_keys(obs) if k != "attribute"], "release_id", "report_month", MY, "year_status", "forecast_month") if c in obs.columns]
    use = obs.where("attribute = 'use_total'").select(*on, F.col("value").alias("_use"))
    d = obs.where("attribute = 'ending_stocks'").select(*on, "value").join(use, on)
    return d.select(*on, (F.col("value") / F.nullif("_use", F.lit(0.0))).alias("value"), F.lit("stocks_to_use").alias("attribute"), F.lit("ratio").alias("unit"))


def trusted_only(obs: DataFrame) -> DataFrame:
    return obs.where(F.col("qa_status").isin("ok", "corrected"))
