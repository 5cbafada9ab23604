"""Verification of the store: identities, reprint continuity, coverage, unmapped labels, another source, whitelist."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import MY
from .store import observations_latest
from .vintage import month_name

GROUP = ("release_id", "table_slug", "commodity", "region", MY, "forecast_month")
COLUMNS = ("release_id", "table_slug", "check_name", "severity", "detail", "observed", "expected")


def decimals(v: Column, cap: int = 10) -> Column:
    """Printed decimals of a value."""
    text = F.rtrim(F.format_string("%.10f", v), F.lit("0"))
    return F.least(F.char_length(F.substring_index(text, ".", -1)), F.lit(cap)).cast("int")


def tolerance(parts: list[Column]) -> Column:
    """Half a unit of the coarsest printed decimal among the parts, for each part (null ones count) and one more."""
    coarsest = F.coalesce(F.array_min(F.array_compact(F.array(*[F.when(p.isNotNull(), decimals(p)) for p in parts]))), F.lit(0))
    return F.pow(F.lit(10.0), -coarsest) * (len(parts) + 1) / 2


def check_identities(obs: DataFrame) -> DataFrame:
    """One aggregate a column group with, by attribute, its value and whether it has a row at all; then the three
    identities. Findings carry the tolerance instead of a formatted number."""
    names = ("beginning_stocks", "production", "imports", "supply_total", "domestic_total", "exports", "crush", "seed", "residual", "seed_and_residual", "use_total", "ending_stocks")
    is_ = {a: F.col("attribute") == a for a in names}
    g = obs.where(F.col("attribute").isin(*names)).groupBy(*GROUP).agg(
        *[F.max(F.when(is_[a], F.col("value"))).alias(a) for a in names], *[F.coalesce(F.bool_or(is_[a]), F.lit(False)).alias(f"has_{a}") for a in names]
    )
    v, has = F.col, lambda a: F.col(f"has_{a}")
    zero = lambda a: F.coalesce(v(a), F.lit(0.0))
    supply = ["beginning_stocks", "production", "imports"]
    soy = ["crush", "exports", "seed", "residual", "seed_and_residual"]
    plain = has("domestic_total")
    soy_tolerance = F.pow(F.lit(10.0), -F.coalesce(F.array_min(F.array_compact(F.array(*[F.when(v(a).isNotNull(), decimals(v(a))) for a in soy]))), F.lit(0)))
    soy_tolerance = soy_tolerance * (sum((has(a).cast("int") for a in soy), F.lit(0)) + 1) / 2

    def finding(name: str, when: Column, observed: Column, expected: Column, tol: Column) -> Column:
        return F.when(when, F.struct(F.lit(name).alias("check_name"), observed.alias("observed"), expected.alias("expected"), tol.alias("tolerance")))

    use_plain = F.when(has("exports"), v("domestic_total") + v("exports")).otherwise(v("domestic_total"))
    ready = has("supply_total") & has("beginning_stocks") & has("production") & has("imports")
    found = F.array_compact(
        F.array(
            finding("supply_identity", ready, v("supply_total"), v(supply[0]) + v(supply[1]) + v(supply[2]), tolerance([v(a) for a in supply])),
            finding("use_identity", has("use_total") & plain, v("use_total"), use_plain, tolerance([v("domestic_total"), v("exports")])),
            finding("use_identity", has("use_total") & ~plain & has("crush"), v("use_total"), sum((zero(a) for a in soy), F.lit(0.0)), soy_tolerance),
            finding("ending_identity", has("ending_stocks") & has("supply_total") & has("use_total"), v("ending_stocks"), v("supply_total") - v("use_total"), tolerance([v("supply_total"), v("use_total")])),
        )
    )
    f = g.select(*GROUP, F.explode(found).alias("f")).where(F.abs(F.col("f.observed") - F.col("f.expected")) > F.col("f.tolerance"))
    where = F.concat(F.concat_ws("/", "commodity", "region"), F.lit(" "), F.col(MY), F.lit(" "), F.when(F.col("forecast_month") == "", "base").otherwise(F.col("forecast_month")))
    return f.select("release_id", "table_slug", "f.check_name", F.lit("fail").alias("severity"), where.alias("detail"), "f.observed", "f.expected")


def check_continuity(obs: DataFrame, releases: DataFrame) -> DataFrame:
    """A report's column for the previous calendar month against that month's own report; one printed unit may differ.

    Both rows have the same series, year, month and label, so they meet in one window: observations stored by place are
    neither dealt anew nor sorted by more than a bucket at once, which a join by all these columns would do."""
    cur = observations_latest(obs, releases).where("year_status = 'projection'")
    keys = ["table_slug", "commodity", "region", MY, "attribute", "_month", "forecast_month"]
    own = F.col("forecast_month") == month_name("report_month")
    cur = cur.select("release_id", "report_month", *[k for k in keys if k != "_month"], "value", own.alias("_own"))
    cur = cur.withColumn("_month", F.when(F.col("_own"), F.col("report_month")).otherwise(F.add_months("report_month", -1))).dropna(subset=keys)
    before = F.collect_list(F.when(F.col("_own"), F.struct(F.col("value").alias("expected")))).over(Window.partitionBy(keys))
    d = cur.withColumn("_before", before).where(~F.col("_own")).select("release_id", *keys, "value", F.explode("_before").alias("_b")).select("*", "_b.expected")
    d = d.where(~F.col("value").eqNullSafe(F.col("expected")))
    unit = F.pow(F.lit(10.0), -F.least(decimals(F.col("value"), 6), decimals(F.col("expected"), 6)))
    d = d.where((F.abs(F.col("value") - F.col("expected")) > unit * 1.01) | F.col("value").isNull() | F.col("expected").isNull())
    text = F.concat(F.concat_ws("/", "commodity", "region"), F.lit(" "), F.col(MY), F.lit(" "), F.col("attribute"), F.lit(" prior-col("), F.col("forecast_month"), F.lit(")"))
    return d.select("release_id", "table_slug", F.lit("mom_continuity").alias("check_name"), F.lit("warn").alias("severity"), text.alias("detail"), F.col("value").alias("observed"), "expected")


def _plain(d: DataFrame, name: str, severity: Column, detail: Column, slug: Column | None = None) -> DataFrame:
    none = F.lit(None).cast("double")
    return d.select("release_id", (slug if slug is not None else F.lit("")).alias("table_slug"), F.lit(name).alias("check_name"), severity.alias("severity"), detail.alias("detail"), none.alias("observed"), none.alias("expected"))


def check_coverage(obs: DataFrame, releases: DataFrame, priority: list[str]) -> DataFrame:
    """Releases without observations, and releases without observations of priority tables."""
    # counted before the join, since releases are few and one's rows would all meet in a task
    known = obs.groupBy("release_id").agg(F.bool_or(F.col("table_slug").isin(priority)).alias("_any"))
    empty = releases.where(F.col("format_era").isin("xml", "txt")).join(known.select("release_id"), "release_id", "left_anti")
    known = known.where("NOT _any")
    return _plain(empty, "coverage", F.lit("fail"), F.concat("format_era", F.lit(" release has no observations"))).unionByName(
        _plain(known, "coverage", F.lit("fail"), F.lit("no priority-table observations"))
    )


def check_unmapped(misses: DataFrame, priority: list[str]) -> DataFrame:
    d = misses.where(F.col("table_slug").isin(priority))
    return _plain(d, "unmapped_label", F.when(F.col("kind") == "unit", "warn").otherwise("fail"), F.concat_ws(": ", "kind", "raw_label"), F.col("table_slug"))


def latest_actuals(obs: DataFrame) -> DataFrame:
    """The last actual value of a commodity's attribute and year; first that of each chain, which lies in one bucket, since
    such cells are few however many observations they have."""
    cell = ["commodity", "attribute", MY]
    order = [F.col("report_month").desc(), *map(F.col, ("release_id", "table_slug", "region", "forecast_month"))]
    last, of_chain = (Window.partitionBy(by).orderBy(*order) for by in (cell, ["table_slug", "region", *cell]))
    d = obs.where("year_status = 'actual' AND value IS NOT NULL").withColumn("_n", F.row_number().over(of_chain)).where("_n = 1")
    return d.withColumn("_n", F.row_number().over(last)).where("_n = 1").select(*cell, "value")


def check_cross_source(obs: DataFrame, other: DataFrame, percent: float = 0.5) -> DataFrame:
    """Latest actual values that differ from another source's by more than ``percent``."""
    d = latest_actuals(obs).join(other.select("commodity", "attribute", MY, F.col("value").alias("expected")), ["commodity", "attribute", MY])
    off = F.abs(F.col("value") - F.col("expected")) / F.greatest(F.abs("expected"), F.lit(1e-9)) * 100
    text = F.concat_ws(" ", "commodity", MY, "attribute")
    return d.where(off > percent).select(
        F.lit("(final)").alias("release_id"), F.concat(F.lit("us_"), "commodity").alias("table_slug"), F.lit("cross_source").alias("check_name"),
        F.lit("warn").alias("severity"), text.alias("detail"), F.col("value").alias("observed"), "expected",
    )


@dataclass(frozen=True)
class Verified:
    """A finding that was verified by hand."""

    check_name: str
    release_id: str | None = None
    detail_prefix: str | None = None
    detail_contains: str | None = None

    def matches(self) -> Column:
        m = F.col("check_name") == self.check_name
        if self.release_id:
            m = m & (F.col("release_id") == self.release_id)
        if self.detail_prefix:
            m = m & F.startswith("detail", F.lit(self.detail_prefix))
        if self.detail_contains:
            m = m & F.contains("detail", F.lit(self.detail_contains))
        return m


def apply_whitelist(findings: DataFrame, entries: list[Verified]) -> DataFrame:
    known = F.lit(False)
    for e in entries:
        known = known | F.coalesce(e.matches(), F.lit(False))
    return findings.withColumn("severity", F.when(known, "whitelisted").otherwise(F.col("severity")))


def run_all(obs: DataFrame, releases: DataFrame, misses: DataFrame, other: DataFrame, priority: list[str], entries: list[Verified], tables: list[str] | None = None) -> DataFrame:
    """All checks; quarantined cells are known failures and stay out of the identities."""
    mine = obs.where(F.col("table_slug").isin(tables or priority))
    parts = [
        check_identities(mine.where("qa_status <> 'quarantined'")),
        check_continuity(mine, releases),
        check_coverage(obs, releases, priority),
        check_unmapped(misses, priority),
        check_cross_source(obs, other),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return apply_whitelist(out, entries)
