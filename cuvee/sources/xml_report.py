"""XML reports: a small walk per file lists cells with the attributes around them; everything else is columns.

``tables`` is a short list (slug, pattern, place, region, commodity) with these optional columns: ``skip``;
``hint``, a report's number; ``default_unit`` and ``price_unit``; ``matrices``, what is known of a table's matrices by position (MATRIX). A commodity
that follows from a matrix's position must be proven by the matrix itself: see ``structure_errors``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import clean_number, month_abbreviation, normalize_label, parse_market_year, slugify_region

RAW = (
    "file string, report string, title string, subtitle string, matrices int, matrix int, names array<string>, "
    "context map<string,string>, units map<string,string>, raw_value string"
)
#: A matrix's own commodity and unit; what its quantity unit and its attributes must or must not contain; the units that
#: count where an attribute proves the matrix although its printed units don't.
MATRIX = "struct<commodity:string,unit:string,unit_has:string,has:string,has_not:string,area:string,yield:string,quantity:string>"
OPTIONAL = {"hint": "string", "skip": "boolean", "default_unit": "string", "price_unit": "string", "matrices": f"array<{MATRIX}>"}
YEAR = re.compile(r"\s*[0-9]{4}/[0-9]{2}\s*\(?\s*((Est|Proj)\.?)?\s*\)?\s*")
KEPT = {"attribute", "commodity", "region", "market_year", "forecast_month", "cell_value"}
#: Units by what a label says, first match first.
LABEL_UNITS = (
    (r"(?i)\(\$/bu\)", "$/bu"), (r"(?i)\(\$/cwt\)", "$/cwt"), (r"(?i)\(c/lb\)", "cents/lb"), (r"(?i)\(\$/s\.t\.\)", "$/ton"),
    (r"(?i)\(mil\.?\s*acres\)|acres \(mil\.?\)", "Million Acres"),
)


def _meaning(key: str, value: str) -> str | None:
    """What an attribute says: headers name a year or else a region, groups a commodity; None says nothing."""
    key = re.sub(r"\d+$", "", key)
    if key in ("region_header", "commodity_header", "attribute_group") and not value.strip():
        return None
    if key in ("region_header", "commodity_header"):
        return "market_year" if YEAR.fullmatch(value) else "region"
    if key == "market_year" and not YEAR.fullmatch(value):
        return None
    key = "commodity" if key == "attribute_group" else key
    return key if key in KEPT else None


def _cells(file: str, content: bytes) -> Iterator[tuple]:
    """One row a cell value: its report, matrix, and the attributes met on the way down. A file that isn't XML has one row
    without a title."""
    from xml.etree import ElementTree

    try:
        root = ElementTree.fromstring(content)
    except (ElementTree.ParseError, LookupError, ValueError):  # the latter two: encodings that are unknown or don't hold
        yield file, None, None, None, 0, None, [], {}, {}, None
        return
    for el in root.iter():
        el.tag = el.tag.rpartition("}")[2]
    for report in root.iter("Report"):
        name, title = report.get("Name") or report.get("name") or "", report.get("sub_report_title")
        if title is None or not re.fullmatch(r"sr\d+", name):
            continue
        subtitle = " ".join((report.get("sub_report_subtitle") or "").split()).strip("()")
        found = sorted((int(m[1]), c) for c in report if (m := re.fullmatch(r"matrix(\d+)", c.tag)))
        for k, (_, matrix) in enumerate(found):
            units: dict[str, dict[str, None]] = {}
            attributes: dict[str, None] = {}
            for el in matrix.iter():
                for key, v in el.attrib.items():
                    if (m := re.fullmatch(r"m\d+_unit_descr(\d+)", key)) and v.strip():
                        units.setdefault(m[1], {})[" ".join(v.split())] = None
                    elif key.startswith("attribute") and v.strip():
                        attributes[" ".join(v.split())] = None
            rows = {i: " ".join(v) for i, v in units.items()}
            todo = [(matrix, {})]
            while todo:
                el, ctx = todo.pop()
                ctx = {**ctx, **{m: v for a, v in el.attrib.items() if (m := _meaning(a, v))}}
                if el.tag == "Cell":
                    if "cell_value" in ctx:
                        value = ctx.pop("cell_value")
                        yield file, name, " ".join(title.split()), subtitle or None, len(found), k, list(attributes), ctx, rows, value
                else:
                    todo += [(c, ctx) for c in reversed(el)]


def raw_cells(files: DataFrame) -> DataFrame:
    """RAW rows of files (path, content) such as ``spark.read.format("binaryFile")`` gives; one file is one task's."""
    text = pa.map_(pa.string(), pa.string())
    kinds = [*[pa.string()] * 4, pa.int32(), pa.int32(), pa.list_(pa.string()), text, text, pa.string()]
    names = [c.split()[0] for c in RAW.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = [(*r[:7], list(r[7].items()), list(r[8].items()), r[9]) for r in _cells(path, content)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return files.select("path", "content").mapInArrow(run, RAW)


def _of_table(raw: DataFrame, tables: DataFrame) -> DataFrame:
    """Raw cells with ``t``, the table whose pattern matches their title and whose hint is their report, else the first, ``m``, what is known of their matrix,
    and ``u``, the matrix's units by role: three printed rows are area, yield and quantity, one is quantity."""
    tables = tables.withColumns({c: F.lit(None).cast(k) for c, k in OPTIONAL.items() if c not in tables.columns})
    hit = raw.select("title", "report").distinct().join(F.broadcast(tables), F.expr("regexp_like(title, pattern)"))
    # of several tables the one with the report's own number, then the first in order
    rank = F.struct((~F.coalesce(F.col("hint") == F.col("report"), F.lit(False))).alias("other"), "place")
    hit = hit.groupBy("title", "report").agg(F.min_by(F.struct("slug", "region", "commodity", *OPTIONAL), rank).alias("t"))
    keys = F.array_sort(F.transform(F.map_keys("units"), lambda k: k.cast("int")))
    unit = lambda k: F.try_element_at("units", F.get(keys, F.lit(k)).cast("string"))
    three = F.size("units") == 3
    u = F.struct(
        F.when(three, unit(0)).alias("area"), F.when(three, unit(1)).alias("yield"), F.when(three, unit(2)).when(F.size("units") == 1, unit(0)).alias("quantity")
    )
    d = raw.join(hit, ["title", "report"]).withColumns({"m": F.get("t.matrices", F.col("matrix")), "u": u})
    has = lambda c: F.coalesce(F.exists("names", lambda a: F.contains(F.lower(a), F.lower(F.col(c)))), F.lit(False))
    printed = F.coalesce(F.contains(normalize_label(F.coalesce("u.quantity", F.lit(""))), normalize_label(F.col("m.unit_has"))), F.lit(True))
    backup = has("m.has") & F.coalesce("m.area", "m.yield", "m.quantity").isNotNull()
    problem = (
        F.when((F.size("t.matrices") > 0) & (F.col("matrices") > F.size("t.matrices")), "more matrices than known")
        .when(has("m.has_not"), "forbidden attribute")
        .when(F.col("m.has").isNotNull() & ~has("m.has"), "attribute absent")
        .when(~printed & ~backup, "other quantity unit")
    )
    u = F.when(~printed, F.struct("m.area", "m.yield", "m.quantity")).otherwise(F.col("u"))
    d = d.withColumns({"problem": F.when(~F.coalesce("t.skip", F.lit(False)), problem), "u": u})
    return d.withColumn("u", F.col("u").withField("quantity", F.coalesce("m.unit", "u.quantity")))


def structure_errors(raw: DataFrame, tables: DataFrame) -> DataFrame:
    """(file, table_slug, matrix, problem): matrices that don't prove what their position promises. ``cells`` gives
    nothing of such a file, since a wrong commodity is worse than none."""
    d = _of_table(raw, tables).where("problem IS NOT NULL").select("file", F.col("t.slug").alias("table_slug"), "matrix", "problem")
    bad = raw.where("title IS NULL").select("file", F.lit(None).cast("string").alias("table_slug"), "matrix", F.lit("not XML").alias("problem"))
    return d.unionByName(bad).distinct()


def unread_tables(raw: DataFrame, tables: DataFrame) -> DataFrame:
    """(file, title, kind): titles that no table lists (unknown) or that a table skips (skipped)."""
    known = _of_table(raw, tables).where("t.skip").select("file", "title", F.lit("skipped").alias("kind"))
    patterns = tables.select("pattern")
    rest = raw.where("title IS NOT NULL").select("file", "title").distinct().join(F.broadcast(patterns), F.expr("regexp_like(title, pattern)"), "left_anti")
    return known.distinct().unionByName(rest.withColumn("kind", F.lit("unknown")))


def _unit(name: Column) -> Column:
    """A cell's unit: what its label says, a price's own, its role's, the table's, the subtitle's."""
    said = F.lit(None).cast("string")
    for pattern, unit in LABEL_UNITS:
        said = F.coalesce(said, F.when(F.regexp_like(name, F.lit(pattern)), F.lit(unit)))
    role = F.when(name.rlike("(?i)price"), F.col("t.price_unit")).when(name.rlike("(?i)^area|planted|harvested$"), F.col("u.area")).when(name.rlike("(?i)^yield"), F.col("u.yield"))
    return F.coalesce(said, role.otherwise(F.coalesce("u.quantity", "t.default_unit", "subtitle")))


def cells(raw: DataFrame, tables: DataFrame) -> DataFrame:
    """Cells of the reports whose title a table's pattern matches, but for skipped tables and files with structure
    errors. Without a table or a matrix's own, the commodity is that of the cell's surroundings."""
    d = _of_table(raw, tables).where(~F.coalesce("t.skip", F.lit(False)))
    d = d.join(structure_errors(raw, tables).select("file").distinct(), "file", "left_anti")
    of = lambda k: F.try_element_at("context", F.lit(k))
    blank = lambda c: F.trim(F.regexp_replace(c, r"\s+", " "))
    name, around = blank(of("attribute")), F.nullif(blank(of("commodity")), F.lit(""))
    d = d.select(
        "file", F.col("t.slug").alias("table_slug"), F.coalesce(slugify_region(F.nullif(of("region"), F.lit(""))), F.col("t.region")).alias("region"), "matrix",
        F.coalesce("m.commodity", around, "t.commodity").alias("raw_commodity"), name.alias("raw_attribute"), parse_market_year(of("market_year")).alias("_my"),
        F.coalesce(month_abbreviation(of("forecast_month")), F.lit("")).alias("forecast_month"), clean_number(F.col("raw_value")).alias("value"), _unit(name).alias("raw_unit"),
    )
    return d.where("_my IS NOT NULL AND raw_attribute <> ''").select(*[c for c in d.columns if c != "_my"], "_my.*")
