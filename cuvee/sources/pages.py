"""Scanned balance-sheet pages, as recognised text, to cells; and text lines from recognised boxes.

Lines of a page are rows; section and unit carry forward by window functions, and a line's value tokens meet the page's
columns by position. Pages are spread over tasks by (release_id, page_no).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import normalize_label, scanned_value
from ..operators.vintage import month_name

#: Printed label prefixes, scan confusions among them, and their attributes, first match first.
ROW_LABELS = (
    ("planted", "area_planted"), ("flanted", "area_planted"), ("harvested", "area_harvested"), ("yield per harv", "yield_per_harvested_acre"),
    ("yield per hary", "yield_per_harvested_acre"), ("acre", "yield_per_harvested_acre"), ("beginning stocks", "beginning_stocks"),
    ("production", "production"), ("froduction", "production"), ("imports", "imports"), ("inports", "imports"), ("supply, total", "supply_total"),
    ("supply total", "supply_total"), ("feed and residual", "feed_and_residual"), ("food, seed", "food_seed_industrial"), ("food seed", "food_seed_industrial"),
    ("crushings", "crush"), ("crush", "crush"), ("domestic, total", "domestic_total"), ("domestic total", "domestic_total"), ("donestic", "domestic_total"),
    ("domestic", "domestic_total"), ("exports", "exports"), ("seed", "seed"), ("residual", "residual"), ("use, total", "use_total"), ("use total", "use_total"),
    ("ending stocks", "ending_stocks"),
)
#: Units by the words that all stand in their line, first match first.
UNITS = (
    (("metric",), "Million Metric Tons"), (("bushel", "million"), "Million Bushels"), (("pound", "million"), "Million Pounds"),
    (("short ton",), "Thousand Short Tons"), (("tons",), "Thousand Short Tons"), (("acre",), "Million Acres"), (("bushel",), "Bushels"),
)
#: By table, the patterns of section headings and their commodities, first match first; the commodity of a
#: page's lines before any heading is that of SECTIONS_BEGIN.
SECTIONS = {
    "us_corn": ((r"(?i)^FEED\s*GRAINS", "feed_grains"), (r"(?i)^CORN", "corn")),
    "us_soybeans": ((r"(?i)^SOYBEANS\b", "soybeans"), (r"(?i)^SOYBEAN\s*OIL", "soybean_oil"), (r"(?i)^SOYBEAN\s*MEAL", "soybean_meal")),
}
SECTIONS_BEGIN = {"us_corn": "feed_grains", "us_soybeans": "soybeans"}
#: The first token of a row's reliability column, and the titles of pages that are read.
TOLERANCE = r"^[+±]|^t/?-|^to$|^/$|/=?-"
TITLES = (
    (r"(?i)U\W{0,3}[S5$]\W{0,3}\s*Feed\s+Gra[il1]ns?\s+and\s+C[o0]rn", "us_corn"),
    (r"(?i)U\W{0,3}[S5$]\W{0,3}\s*S[o0]ybeans?\s+and\s+Pr[o0]ducts", "us_soybeans"),
)
#: A page's title stands among so many characters.
TITLE_CHARS = 400


def columns_of(report_month: str) -> Column:
    """A page's columns (marketing_year, year_status, forecast_month): two years printed once and the new crop's, whose
    base rolls in May; May reports and those until July 1981 print one month of it, others the previous one too."""
    month, year = F.month(report_month), F.year(report_month)
    base = year - (month < 5).cast("int")
    my = lambda k: F.concat((base + k).cast("string"), F.lit("/"), F.lpad(((base + k + 1) % 100).cast("string"), 2, "0"))
    col = lambda k, status, m: F.struct(my(k).alias("marketing_year"), F.lit(status).alias("year_status"), m.alias("forecast_month"))
    now, last = col(0, "projection", month_name(report_month)), col(0, "projection", month_name(F.add_months(report_month, -1)))
    old = [col(-2, "actual", F.lit("")), col(-1, "estimate", F.lit(""))]
    single = (month == 5) | (F.col(report_month) < "1981-08-01")
    return F.when(single, F.array(*old, now)).otherwise(F.array(*old, last, now))


def _first_match(rules: tuple, test) -> Column:
    """The value of the first rule (needle, value) that passes."""
    table = F.array(*[F.struct(F.lit(n).alias("needle"), F.lit(v).alias("value")) for n, v in rules])
    return F.get(F.filter(table, lambda r: F.coalesce(test(r["needle"]), F.lit(False))), F.lit(0))["value"]


def located(pages: DataFrame) -> DataFrame:
    """The pages (release_id, report_month, page_no, text) whose title is known, with table_slug."""
    d = pages.withColumn("table_slug", _first_match(TITLES, lambda p: F.regexp_like(F.left("text", F.lit(TITLE_CHARS)), p)))
    return d.where("table_slug IS NOT NULL")


def _section(table: Column, line: Column) -> Column:
    """The commodity whose heading a line of a table's page is."""
    out = F.lit(None).cast("string")
    for slug, rules in SECTIONS.items():
        out = F.when(table == slug, _first_match(rules, lambda p: F.regexp_like(line, p))).otherwise(out)
    return out


def cells(pages: DataFrame, units: Sequence[str] = ()) -> DataFrame:
    """ParsedCell rows of pages (release_id, report_month, page_no, table_slug, text), with page_no and the line ln. Only a
    line that is one of the known ``units`` or says million or bushel changes the unit, to none where it names no unit."""
    d = pages.select("release_id", "report_month", "page_no", "table_slug", F.posexplode(F.split("text", "\n")).alias("ln", "line"))
    number = F.regexp_instr("line", F.lit(r"[0-9][0-9,]*\.?[0-9]*"))
    colon = F.instr("line", ":")
    cut = F.when(colon > 0, colon).when(number > 3, number).when((number == 0) & (F.trim("line") != ""), F.char_length("line") + 1)
    d = d.withColumns(
        {
            "label": F.when(cut.isNotNull(), F.substr("line", F.lit(1), cut - 1)),
            "zone": F.when(colon > 0, F.substr("line", colon + 1)).when(cut.isNotNull(), F.substr("line", cut)),
            "_section": _section(F.col("table_slug"), F.trim("line")),
        }
    )
    d = d.withColumn("_plain", F.trim(F.regexp_replace(normalize_label(F.col("label")), "[^a-z, ]", "")))
    d = d.withColumn("raw_attribute", _first_match(ROW_LABELS, lambda p: F.startswith("_plain", p)))
    d = d.withColumn("_said", normalize_label(F.when(F.col("zone") != "", F.col("zone")).otherwise(F.col("label"))))
    needles = tuple(("".join(f"(?=.*{w})" for w in ws), name) for ws, name in UNITS)
    names_unit = F.contains("_said", F.lit("million")) | F.contains("_said", F.lit("bushel")) | F.col("_said").isin([u.lower() for u in units])
    unit = F.when(F.col("raw_attribute").isNull() & names_unit, F.struct(_first_match(needles, lambda p: F.regexp_like("_said", p)).alias("name")))
    above = Window.partitionBy("release_id", "page_no").orderBy("ln").rowsBetween(Window.unboundedPreceding, 0)
    start = F.try_element_at(F.create_map(*[F.lit(x) for kv in SECTIONS_BEGIN.items() for x in kv]), "table_slug")
    d = d.withColumns({"commodity": F.coalesce(F.last("_section", ignorenulls=True).over(above), start), "unit": F.last(unit, ignorenulls=True).over(above)["name"]})
    d = d.where("raw_attribute IS NOT NULL")
    tokens = F.split(F.trim("zone"), r"\s+")
    stop = F.array_position(F.transform(tokens, lambda t: t.rlike(TOLERANCE)), F.lit(True))
    tokens = F.when(stop > 0, F.slice(tokens, F.lit(1), (stop - 1).cast("int"))).otherwise(tokens)
    own = ["release_id", "report_month", "page_no", "table_slug", "ln", "commodity", "raw_attribute", "unit"]
    d = d.select(*own, F.posexplode_outer(tokens).alias("_k", "token")).withColumn("value", scanned_value(F.col("token"))).where("value IS NOT NULL")
    line = Window.partitionBy("release_id", "page_no", "ln")
    at = line.orderBy("_k")
    d = d.withColumns({"_at": F.row_number().over(at), "_next": F.lead("value").over(at), "_n": F.count("*").over(line), "_cols": columns_of("report_month")})
    # a misread colon is a small number in front that explains one value too many
    odd = (F.col("_at") == 1) & (F.col("_n") > F.size("_cols")) & (F.abs("value") < 15) & (F.col("_next") > 100 * F.greatest(F.abs("value"), F.lit(1.0)))
    d = d.withColumn("_odd", F.coalesce(odd, F.lit(False)))
    d = d.withColumn("_at", F.col("_at") - F.max(F.col("_odd").cast("int")).over(line)).where("NOT _odd AND _at <= size(_cols)")
    col = F.get("_cols", F.col("_at") - 1)
    names = ("marketing_year", "year_status", "forecast_month")
    return d.select("release_id", "report_month", "table_slug", F.lit("united_states").alias("region"), "commodity", "raw_attribute", *[col[n].alias(n) for n in names], "value", "unit", "page_no", "ln")


def rebuilt_lines(boxes: DataFrame, tolerance: float = 14.0) -> DataFrame:
    """(page, text) from recognised boxes (page, x0, y0, x1, y1, text): boxes sorted by their centre's height join the
    current line while they lie within ``tolerance`` of its running centre; a line reads from left to right."""
    box = F.struct(((F.col("y0") + F.col("y1")) / 2).alias("y"), F.col("x0").cast("double").alias("x"), "text")
    d = boxes.groupBy("page").agg(F.sort_array(F.collect_list(box)).alias("b"))
    start = F.struct(F.array().cast("array<string>").alias("lines"), F.array().cast("array<struct<x:double,text:string>>").alias("cur"), F.lit(None).cast("double").alias("y"))
    read = lambda cur: F.array_join(F.transform(F.sort_array(cur), lambda t: t["text"]), " ")

    def step(a: Column, t: Column) -> Column:
        item = F.array(F.struct(t["x"].alias("x"), t["text"].alias("text")))
        joins = a["y"].isNull() | (F.abs(t["y"] - a["y"]) < tolerance)
        return F.struct(
            F.when(joins, a["lines"]).otherwise(F.concat(a["lines"], F.array(read(a["cur"])))).alias("lines"),
            F.when(joins, F.concat(a["cur"], item)).otherwise(item).alias("cur"),
            F.when(joins & a["y"].isNotNull(), (a["y"] + t["y"]) / 2).otherwise(t["y"]).alias("y"),
        )

    text = F.aggregate("b", start, step, lambda a: F.array_join(F.concat(a["lines"], F.array(read(a["cur"]))), "\n"))
    return d.select("page", text.alias("text"))
