"""What leaves the store: the verification report with its persisted exceptions, and the named exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import EXCEPTION, conform
from .store import current, observations_latest, publish

EXCEPTION_KEY = ("release_id", "table_slug", "check_name", "detail")
#: The tables of the two exported balance sheets.
BALANCES = {"us_corn_balance": ["us_corn"], "us_soybeans_balance": ["us_soybeans", "us_soybean_meal", "us_soybean_oil"]}


def exceptions(findings: DataFrame) -> DataFrame:
    """One finding a key: the first by severity, observed and expected value, so a failure goes before a warning."""
    first = Window.partitionBy(*EXCEPTION_KEY).orderBy("severity", "observed", "expected")
    return conform(findings, EXCEPTION).withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")


def summary(findings: DataFrame) -> DataFrame:
    return findings.groupBy("check_name", "severity").agg(F.count("*").alias("n"))


def report(findings: DataFrame, folder: str) -> dict[str, int]:
    """Publishes all findings (``findings``) and one a key in place of the last report's (``qa_exceptions``) below ``folder``,
    writes them as CSV (``qa_report``), and returns their number by severity. The checks run once."""
    spark = findings.sparkSession
    publish(conform(findings, EXCEPTION), f"{folder}/findings")
    found = current(spark, f"{folder}/findings")
    publish(exceptions(found), f"{folder}/qa_exceptions")
    found.write.mode("overwrite").csv(f"{folder}/qa_report", header=True)
    return {r.severity: r.n for r in found.groupBy("severity").agg(F.count("*").alias("n")).collect()}


def exit_code(counts: dict[str, int]) -> int:
    """What a run ends with: 1 if anything failed that isn't verified."""
    return 1 if counts.get("fail") else 0


def exports(obs: DataFrame, releases: DataFrame, found: DataFrame) -> dict[str, DataFrame]:
    """The six tables for other projects, by name; ``store.export`` publishes them."""
    latest = observations_latest(obs, releases)
    balances = {name: latest.where(F.col("table_slug").isin(slugs)) for name, slugs in BALANCES.items()}
    return {"observations": latest, "observations_all_versions": obs, "releases": releases, "qa_exceptions": found, **balances}
