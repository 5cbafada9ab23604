"""Configuration files (YAML): aliases by slug, tables, settings, and findings that were verified by hand. These are short,
hand-kept lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dataclasses import dataclass

from ..operators.quality import Verified
from .xml_report import MATRIX


def _loaded(spark: SparkSession, path: str) -> dict:
    """The file's content, read by Spark; an empty file is an empty mapping."""
    import yaml

    row = spark.read.text(path, wholetext=True).first()
    return (yaml.safe_load(row.value) if row else None) or {}


def aliases(spark: SparkSession, path: str, key: str) -> DataFrame:
    """(alias, slug) of a file {key: {slug: {aliases: [...]}}}, each slug among its own aliases."""
    listed = _loaded(spark, path).get(key) or {}
    rows = [(str(a), slug) for slug, spec in listed.items() for a in (slug, *((spec or {}).get("aliases") or []))]
    return spark.createDataFrame(rows, "alias string, slug string")


def whitelist(spark: SparkSession, path: str) -> list[Verified]:
    """The verified findings of a file {whitelist: [{check_name, release_id, detail_prefix, detail_contains}, ...]}; where
    there is no such file, none."""
    file = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(file):
        return []
    return [Verified(e["check_name"], e.get("release_id"), e.get("detail_prefix"), e.get("detail_contains")) for e in _loaded(spark, path).get("whitelist") or []]


#: A table's description. Patterns of one table are rows of their own, in order (place) of tables, then patterns.
SPEC = (
    "slug string, pattern string, place int, region string, commodity string, hint string, skip boolean, default_unit string, price_unit string, "
    f"matrices array<{MATRIX}>, txt_skip boolean, columns array<string>, first_section string"
)


def tables(spark: SparkSession, path: str) -> DataFrame:
    """SPEC rows of a file {tables: {slug: {title_patterns: [...], ...}}}. Patterns find titles in any case."""

    def matrix(m: dict) -> dict:
        units = m.get("fallback_units") or {}
        return {
            "commodity": m.get("commodity"), "unit": m.get("unit"), "unit_has": m.get("quantity_unit_must_contain"), "has": m.get("must_contain_attribute"),
            "has_not": m.get("must_not_contain_attribute"), "area": units.get("area"), "yield": units.get("yield"), "quantity": units.get("qty"),
        }

    rows = []
    for slug, spec in (_loaded(spark, path).get("tables") or {}).items():
        if not (spec or {}).get("title_patterns"):
            raise ValueError(f"{path}: {slug} has no title_patterns")
        for pattern in spec["title_patterns"]:
            rows.append(
                (
                    slug, f"(?i){pattern}", len(rows), spec.get("region", "united_states"), spec.get("commodity"), spec.get("sr_hint"), bool(spec.get("skip", False)),
                    spec.get("default_quantity_unit"), spec.get("price_unit"), [matrix(m or {}) for m in spec.get("matrices") or []] or None,
                    bool(spec.get("txt_skip", False)), spec.get("txt_columns") or None, spec.get("txt_initial_commodity"),
                )
            )
    return spark.createDataFrame(rows, SPEC)


def sections(spark: SparkSession, path: str) -> DataFrame:
    """(table_slug, alias, slug) of the headings within text tables (txt_sections) of the same file."""
    listed = (_loaded(spark, path).get("tables") or {}).items()
    rows = [(slug, str(k), v) for slug, spec in listed for k, v in ((spec or {}).get("txt_sections") or {}).items()]
    return spark.createDataFrame(rows, "table_slug string, alias string, slug string")


def resolved(titles: DataFrame, specs: DataFrame, hint: str = "hint") -> DataFrame:
    """``titles`` (title, and ``hint``, the report's number, if there) with slug and spec of the table that they name: of
    several the one of the same hint, then the first in order; null where none."""
    named = F.col(hint) if hint in titles.columns else F.lit(None).cast("string")
    d = titles.withColumns({"_title": F.trim(F.regexp_replace("title", r"\s+", " ")), "_named": named})
    once = d.select("_title", "_named").distinct()
    hit = once.join(F.broadcast(specs), F.expr("regexp_like(_title, pattern)"))
    rank = F.struct((~F.coalesce(F.col("_named") == F.col("hint"), F.lit(False))).alias("other"), "place")
    best = hit.groupBy("_title", "_named").agg(F.min_by(F.struct(*specs.columns), rank).alias("spec"))
    return d.join(best.withColumnsRenamed({"_title": "_t", "_named": "_n"}), F.col("_title").eqNullSafe(F.col("_t")) & F.col("_named").eqNullSafe(F.col("_n")), "left").drop("_title", "_named", "_t", "_n").withColumn("slug", F.col("spec.slug"))


@dataclass(frozen=True)
class Settings:
    """Folders (below the settings file's project where they are relative), the catalog's address, eras and priority tables."""

    paths: dict[str, str]
    base_url: str | None
    identifier: str | None
    sleep_seconds: float
    xml_start: str | None
    txt_start: str | None
    priority_tables: list[str]


def settings(spark: SparkSession, path: str, catalog: str = "catalog") -> Settings:
    """A file {paths: {...}, <catalog>: {base_url, identifier, sleep_seconds}, eras: {xml_start, txt_start}, priority_tables: [...]}
    in a folder of the project."""
    told = _loaded(spark, path)
    root = path.rstrip("/").rsplit("/", 2)[0]
    place = lambda p: p if p.startswith("/") or "://" in p else f"{root}/{p}"
    source, eras = told.get(catalog) or {}, told.get("eras") or {}
    return Settings(
        {k: place(str(v)) for k, v in (told.get("paths") or {}).items()}, source.get("base_url"), source.get("identifier"), float(source.get("sleep_seconds", 1.0)),
        eras.get("xml_start"), eras.get("txt_start"), list(told.get("priority_tables") or []),
    )
