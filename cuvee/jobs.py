"""Jobs for a scheduler: ``python -m cuvee.jobs qa ...`` checks a store and ends with 1 where a check fails."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import quality, report, store, versions
from .schemas import MY, OBSERVATION, RELEASE, UNMAPPED
from .sources import config

#: Tables whose identities are checked beside the priority tables.
ALSO_CHECKED = ("us_wheat", "world_corn", "world_soybeans", "world_soybean_meal", "world_soybean_oil", "world_wheat")


def qa(spark: SparkSession, folder: str, priority: list[str], tables: list[str] | None = None, entries: list | None = None, other: DataFrame | None = None, csv: str | None = None) -> dict[str, int]:
    """Checks the store at ``folder`` and publishes the findings as its table qa_exceptions in place of the last ones, and as
    CSV; their number by severity. Identities are checked in ``tables``, in all tables if that is empty, and if it is None in
    the priority tables and ALSO_CHECKED. ``other`` (commodity, attribute, marketing_year, value) is another source."""
    now = versions.version(spark, folder)
    obs, releases, misses = (versions.read(spark, folder, now, n, s) for n, s in (("observations", OBSERVATION), ("releases", RELEASE), ("unmapped", UNMAPPED)))
    if tables is None:
        tables = [*priority, *ALSO_CHECKED]
    elif not tables:
        tables = sorted(r.table_slug for r in obs.select("table_slug").distinct().collect() if r.table_slug is not None)
    if other is None:
        other = spark.createDataFrame([], f"commodity string, attribute string, {MY} string, value double")
    findings = quality.run_all(obs, releases, misses, other, priority, entries or [], tables or [""])

    def persist(change: versions.Change) -> None:
        change.replace("qa_exceptions", report.exceptions(findings))
        change.alias("exports/qa_exceptions", "qa_exceptions")

    versions.transact(spark, folder, persist)
    found = store.current(spark, f"{folder}/qa_exceptions")
    if csv:
        found.write.mode("overwrite").csv(csv, header=True)
    return {r.severity: r.n for r in found.groupBy("severity").agg(F.count("*").alias("n")).collect()}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="cuvee.jobs")
    job = parser.add_subparsers(dest="job", required=True).add_parser("qa")
    job.add_argument("store")
    job.add_argument("--settings", help="YAML file with priority_tables")
    job.add_argument("--whitelist", help="YAML file of verified findings")
    job.add_argument("--other", help="Parquet of another source")
    job.add_argument("--csv", help="folder for the report")
    job.add_argument("--tables", nargs="+", help="tables whose identities are checked")
    job.add_argument("--all-tables", action="store_true")
    a = parser.parse_args(argv)
    spark = SparkSession.builder.appName("cuvee qa").getOrCreate()
    priority = config.settings(spark, a.settings).priority_tables if a.settings else []
    entries = config.whitelist(spark, a.whitelist) if a.whitelist else []
    counts = qa(spark, a.store, priority, [] if a.all_tables else a.tables, entries, spark.read.parquet(a.other) if a.other else None, a.csv)
    print(", ".join(f"{n} {k}" for k, n in sorted(counts.items())) or "no findings")
    return report.exit_code(counts)


if __name__ == "__main__":
    sys.exit(main())
