"""Separator-ruled text reports: national tables to cells, relationally.

Lines are rows; the rules (runs of ``=``) number blocks, so that a table is a title above a rule, a header block and a
body block. Header tokens give columns with their places; body values are rows that take a column by order where a line
is full and by nearest place where it is short. Section, unit and wrapped labels carry forward by window functions.
World tables, whose columns the spec lists, take values by the places of the header's colons; years and regions carry
forward. ``specs`` is a short list (slug, pattern, place, region, commodity) with these optional columns: ``columns``, a
world table's attributes in order; ``skip``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import clean_number, month_abbreviation, normalize_label, slugify_region
from ..operators.vintage import month_name

YEAR = r"[0-9]{4}/[0-9]{2,4}"
MONTH = "(?i)January|February|March|April|May|June|July|August|September|October|November|December"
SHORT_MONTH = r"Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|June?|July?|Aug(?:ust)?|Sep(?:t(?:ember)?)?|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?"
#: Word beginnings that a world table's header must hold, whatever it cuts off.
HEADER_WORDS = ("beginni", "expor")
OPTIONAL = {"columns": "array<string>", "skip": "boolean"}
VALUE = r"(?i)[0-9,]+\.?[0-9]*\s{0,2}-\s{0,2}[0-9,]+\.?[0-9]*|-?[0-9][0-9,]*\.?[0-9]*|NA\b|N/A|---+|--"


def places(text: Column, pattern: str) -> Column:
    """Tokens of a pattern with their first character and the one after, counted from 0."""
    tokens, gaps = F.regexp_extract_all(text, F.lit(f"({pattern})"), 1), F.split(text, pattern)
    before = lambda i: F.aggregate(F.slice(gaps, F.lit(1), i + 1), F.lit(0), lambda a, g: a + F.char_length(g)) + F.aggregate(
        F.slice(tokens, F.lit(1), i), F.lit(0), lambda a, t: a + F.char_length(t)
    )
    return F.transform(tokens, lambda t, i: F.struct(t.alias("token"), before(i).alias("start"), (before(i) + F.char_length(t)).alias("stop")))


def _lines(files: DataFrame) -> DataFrame:
    d = files.select("release_id", "report_month", F.posexplode(F.split("text", r"\r?\n")).alias("ln", "line"))
    rule = F.col("line").rlike(r"^={20,}\s*$")
    w = Window.partitionBy("release_id").orderBy("ln")
    return d.withColumns({"rule": rule, "block": F.sum(rule.cast("int")).over(w)}).where("NOT rule").drop("rule")


def _headers(lines: DataFrame) -> DataFrame:
    """(release_id, block, title, title_unit): header blocks with the line above them, and the unit between."""
    size = lines.groupBy("release_id", "block").agg(F.count("*").alias("n"), F.max("block").over(Window.partitionBy("release_id")).alias("last"))
    head = size.where("block > 0 AND n <= 8 AND block < last").select("release_id", "block")
    end = Window.partitionBy("release_id", "block").orderBy(F.col("ln").desc())
    line = F.trim("line")
    above = lines.withColumn("k", F.row_number().over(end)).where("k <= 4").where(line != "")
    note = line.rlike(r"^\(.*\)$") | line.rlike("(?i)^(million|thousand)( |$)")
    title = above.groupBy("release_id", (F.col("block") + 1).alias("block")).agg(
        F.min_by(F.when(~note, line), F.when(~note, F.col("k"))).alias("title"), F.min(F.when(~note, F.col("k"))).alias("_at"),
        F.min_by(F.struct("k", F.btrim(line, F.lit("()")).alias("unit")), F.when(note, F.col("k"))).alias("_unit"),
    )
    plain = F.regexp_replace("title", r"\s", "")
    title = title.where(~F.contains("title", F.lit(":")) & (F.char_length(F.regexp_replace(plain, "[^0-9]", "")) <= 0.4 * F.char_length(plain)))
    title = title.withColumn("title_unit", F.when(F.col("_unit.k") < F.col("_at"), F.col("_unit.unit"))).drop("_at", "_unit")
    return head.join(title, ["release_id", "block"])


def _tables(lines: DataFrame, specs: DataFrame) -> DataFrame:
    """(release_id, block, title_unit, slug, region, commodity, columns, skip) of headers whose title a spec's pattern
    matches; the first in order wins."""
    specs = specs.withColumns({c: F.lit(None).cast(k) for c, k in OPTIONAL.items() if c not in specs.columns})
    found = _headers(lines).join(F.broadcast(specs), F.expr("regexp_like(title, pattern)"))
    found = found.groupBy("release_id", "block", "title_unit").agg(F.min_by(F.struct("slug", "region", "commodity", *OPTIONAL), "place").alias("t"))
    return found.select("release_id", "block", "title_unit", "t.*").withColumn("skip", F.coalesce("skip", F.lit(False)))


def _columns(lines: DataFrame, tables: DataFrame) -> DataFrame:
    """(release_id, block, col, mid, marketing_year, year_status, forecast_month) of each header."""
    head = lines.join(tables.select("release_id", "block"), ["release_id", "block"])
    g = head.groupBy("release_id", "block").agg(
        F.max_by("line", F.struct(F.regexp_count("line", F.lit(YEAR)), -F.col("ln"))).alias("years"), F.max_by("line", "ln").alias("status"),
        F.min_by(F.nullif(F.regexp_extract("line", rf"({YEAR})\s+Proj", 1), F.lit("")), F.when(F.col("line").rlike(rf"{YEAR}\s+Proj"), F.col("ln"))).alias("proj"),
    )
    mid = F.floor((F.col("p.start") + F.col("p.stop")) / 2).cast("int")
    near = F.substr("status", F.greatest(F.col("p.start") - 3, F.lit(1)), F.col("p.stop") - F.col("p.start") + 8)
    old = g.select("*", F.explode(places(F.col("years"), YEAR)).alias("p")).where(~F.substr("years", F.col("p.stop") + 1).rlike(r"^\s+Proj"))
    old = old.select("release_id", "block", mid.alias("mid"), F.col("p.token").alias("marketing_year"), F.when(F.contains(near, F.lit("Est")), "estimate").otherwise("actual").alias("year_status"), F.lit("").alias("forecast_month"))
    new = g.where("proj IS NOT NULL").select("*", F.explode(places(F.col("status"), MONTH)).alias("p"))
    new = new.select("release_id", "block", mid.alias("mid"), F.col("proj").alias("marketing_year"), F.lit("projection").alias("year_status"), month_abbreviation(F.col("p.token")).alias("forecast_month"))
    return old.unionByName(new).withColumn("col", F.row_number().over(Window.partitionBy("release_id", "block").orderBy("mid")))


def _rows(lines: DataFrame, tables: DataFrame, sections: DataFrame) -> DataFrame:
    """Body lines that hold values, with label, zone, commodity and unit. ``sections`` (alias, slug) names headings."""
    body = lines.join(tables.select("release_id", (F.col("block") + 1).alias("block"), "slug", "region", F.col("commodity").alias("first")), ["release_id", "block"])
    w = Window.partitionBy("release_id", "block").orderBy("ln")
    noted = F.max(F.startswith(F.trim("line"), F.lit("Note:")).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    body = body.withColumn("_noted", noted).where("_noted = 0 AND contains(line, ':')")
    colon = F.instr("line", ":")
    body = body.select("*", F.trim(F.regexp_replace(F.substr("line", F.lit(1), colon - 1), r"\s+", " ")).alias("label"), F.substr("line", colon + 1).alias("zone"), colon.alias("offset"))
    body = body.withColumns({"n": F.regexp_count("zone", F.lit(VALUE)), "_alias": normalize_label(F.col("label"))})
    body = body.join(F.broadcast(sections.select(F.col("alias").alias("_alias"), F.col("slug").alias("heading"))), "_alias", "left")
    heading = F.when(F.col("n") == 0, F.col("heading"))
    said = F.trim(F.col("zone"))
    unit = F.when((F.col("n") == 0) & said.rlike("(?i)^(million|thousand|bushels|metric|pounds|dollars|short)"), said)
    opened = (F.col("n") > 0) & F.col("zone").rlike(r"[0-9]\s{0,2}-(?![0-9]|\s{0,2}[0-9])")
    body = body.withColumns({"_heading": heading, "_unit": unit, "_open": opened})
    goes_on = (F.col("label") == "") & (F.col("n") > 0) & F.coalesce(F.lag("_open").over(w), F.lit(False))
    body = body.withColumn("_goes_on", goes_on)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    ends = ((F.col("n") > 0) | F.col("_heading").isNotNull()).cast("int")
    body = body.withColumns({"commodity": F.coalesce(F.last("_heading", ignorenulls=True).over(upto), F.col("first")), "unit": F.last("_unit", ignorenulls=True).over(upto), "_run": F.coalesce(F.sum(ends).over(before), F.lit(0)), "_more": F.when(F.lead("_goes_on").over(w), F.lead("zone").over(w))})
    # a wrapped label is all that stands since the last line with values or heading
    part = Window.partitionBy("release_id", "block", "_run").orderBy("ln").rowsBetween(Window.unboundedPreceding, 0)
    label = F.array_join(F.collect_list(F.when((F.col("label") != "") & F.col("_heading").isNull(), F.col("label"))).over(part), " ")
    body = body.withColumn("raw_attribute", label).where("n > 0 AND NOT _goes_on AND raw_attribute <> ''")
    return body.select("release_id", "report_month", "block", "ln", "slug", "region", "commodity", "unit", "raw_attribute", "zone", "offset", "_more")


def _world_headers(lines: DataFrame, tables: DataFrame) -> DataFrame:
    """World tables with ``label_end``, ``anchors`` (a column's place each) and ``problem`` where the header differs from
    what the spec lists. The line with the most colons rules the columns; one more may stand behind its last colon."""
    head = lines.join(tables.where("columns IS NOT NULL AND NOT skip"), ["release_id", "block"])
    colons = F.regexp_count("line", F.lit(":"))
    behind = ~F.rtrim("line").rlike(r"(:|^)$") & F.contains(F.lower("line"), F.lit("stock"))
    keys = ["release_id", "block", "title_unit", "slug", "commodity", "columns"]
    g = head.groupBy(keys).agg(
        F.max_by("line", F.struct(colons, -F.col("ln"))).alias("leaf"), F.max(behind).alias("behind"), F.lower(F.array_join(F.collect_list("line"), " ")).alias("all")
    )
    at = F.transform(places(F.col("leaf"), ":"), lambda p: p["start"])
    g = g.withColumn("at", at).withColumn("label_end", F.get("at", F.lit(0)))
    gaps = F.zip_with(F.slice("at", F.lit(1), F.greatest(F.size("at") - 1, F.lit(0))), F.slice("at", F.lit(2), F.size("at")), lambda a, b: F.floor((a + b) / 2).cast("int"))
    last = F.when(F.col("behind"), F.array(F.try_element_at("at", F.lit(-1)) + 5)).otherwise(F.array().cast("array<int>"))
    g = g.withColumn("anchors", F.when(F.size("at") > 0, F.concat(gaps, last)).otherwise(F.array().cast("array<int>")))
    problem = F.when(F.size("anchors") != F.size("columns"), "other number of columns")
    for word in HEADER_WORDS:
        problem = problem.when(~F.contains("all", F.lit(word)), f"header lacks {word}")
    return g.select(*keys, "label_end", "anchors", problem.alias("problem"))


def _world_cells(lines: DataFrame, tables: DataFrame) -> DataFrame:
    heads = _world_headers(lines, tables).where("problem IS NULL").withColumn("block", F.col("block") + 1)
    plain = lambda c: F.trim(F.regexp_replace(F.replace(c, F.lit(":"), F.lit(" ")), r"\s+", " "))
    d = lines.join(heads, ["release_id", "block"])
    w = Window.partitionBy("release_id", "block").orderBy("ln")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("_noted", F.max(F.startswith(F.ltrim("line"), F.lit("Note:")).cast("int")).over(upto)).where("_noted = 0")
    d = d.withColumns({"label": plain(F.substr("line", F.lit(1), F.col("label_end"))), "zone": F.substr("line", F.col("label_end") + 1)})
    year = rf"^({YEAR})\s*(?:\((Estimated|Projected)\))?\s*$"
    opens = plain(F.col("zone")).rlike(year)
    kind = F.regexp_extract(plain(F.col("zone")), year, 2)
    status = F.when(kind == "Estimated", "estimate").when(kind == "Projected", "projection").otherwise("actual")
    d = d.withColumns({"_opens": opens, "_y": F.when(opens, F.struct(F.regexp_extract(plain(F.col("zone")), year, 1).alias("my"), status.alias("status")))})
    d = d.withColumn("_y", F.last("_y", ignorenulls=True).over(upto)).withColumn("_n", F.when(F.col("_opens"), 0).otherwise(F.regexp_count("zone", F.lit(VALUE))))
    # a projected row may be one of a pair of months: the month alone below its region, or behind it
    projected = F.coalesce(F.col("_y.status") == "projection", F.lit(False)) & (F.col("_n") > 0)
    alone = projected & F.col("label").rlike(rf"(?i)^(?:{SHORT_MONTH})$")
    pair = rf"(?i)^(.+?)\s+({SHORT_MONTH})$"
    behind = projected & ~alone & F.col("label").rlike(pair)
    month = F.when(alone, F.col("label")).when(behind, F.regexp_extract("label", pair, 2))
    own = F.when(behind, F.regexp_extract("label", pair, 1)).when(~alone & (F.col("label") != ""), F.col("label"))
    d = d.withColumns({"_month": month_abbreviation(month), "_row": F.when(alone, "").otherwise(own)})
    d = d.withColumn("_near", F.last(F.when((F.col("_n") > 0) | F.col("_opens") | F.col("_y").isNotNull(), own), ignorenulls=True).over(upto))
    d = d.withColumn("_row", F.when(alone, F.col("_near")).otherwise(own)).where("_n > 0 AND _y IS NOT NULL AND _row IS NOT NULL")
    d = d.select("*", F.explode(places(F.col("zone"), VALUE)).alias("p"))
    center = F.col("label_end") + F.floor((F.col("p.start") + F.col("p.stop")) / 2)
    nearest = F.array_min(F.transform("anchors", lambda a, i: F.struct(F.abs(a - center).alias("far"), i.alias("i"))))["i"]
    when = F.when(F.col("_y.status") == "projection", F.coalesce("_month", month_name("report_month"))).otherwise(F.lit(""))
    return d.select(
        "release_id", "report_month", F.col("slug").alias("table_slug"), slugify_region(F.col("_row")).alias("region"), "commodity", F.get("columns", nearest).alias("raw_attribute"),
        F.col("_y.my").alias("marketing_year"), F.col("_y.status").alias("year_status"), when.alias("forecast_month"), clean_number(F.col("p.token")).alias("value"),
        F.trim("p.token").alias("raw_value"), F.col("title_unit").alias("raw_unit"),
    )


def structure_errors(files: DataFrame, specs: DataFrame) -> DataFrame:
    """(release_id, table_slug, problem) of tables whose header isn't what the spec lists; they give no cells."""
    lines = _lines(files)
    tables = _tables(lines, specs)
    wrong = _world_headers(lines, tables).where("problem IS NOT NULL").select("release_id", F.col("slug").alias("table_slug"), "problem")
    plain = tables.where("columns IS NULL AND NOT skip")
    none = plain.join(_columns(lines, plain).select("release_id", "block"), ["release_id", "block"], "left_anti")
    return wrong.unionByName(none.select("release_id", F.col("slug").alias("table_slug"), F.lit("header without years").alias("problem")))


def unknown_tables(files: DataFrame, specs: DataFrame) -> DataFrame:
    """(release_id, title) of tables with colons in their header that no spec's pattern matches."""
    lines = _lines(files)
    rest = _headers(lines).join(F.broadcast(specs.select("pattern")), F.expr("regexp_like(title, pattern)"), "left_anti")
    seen = lines.where("contains(line, ':')").select("release_id", "block").distinct()
    return rest.join(seen, ["release_id", "block"], "left_semi").select("release_id", F.trim(F.regexp_replace("title", r"\s+", " ")).alias("title")).distinct()


def cells(files: DataFrame, specs: DataFrame, sections: DataFrame) -> DataFrame:
    """ParsedCell rows of files (release_id, report_month, text). ``specs`` and ``sections`` (alias, slug), the headings
    within national tables, are short lists."""
    lines = _lines(files)
    tables = _tables(lines, specs)
    return _national_cells(lines, tables.where("columns IS NULL AND NOT skip"), sections).unionByName(_world_cells(lines, tables))


def _national_cells(lines: DataFrame, tables: DataFrame, sections: DataFrame) -> DataFrame:
    columns = _columns(lines, tables).select("release_id", (F.col("block") + 1).alias("block"), "col", "mid", "marketing_year", "year_status", "forecast_month")
    rows = _rows(lines, tables, sections)
    d = rows.select("*", F.posexplode(places(F.col("zone"), VALUE)).alias("k", "p"))
    line = ["release_id", "block", "ln"]
    width = columns.groupBy("release_id", "block").agg(F.count("*").alias("width"))
    d = d.join(width, ["release_id", "block"]).withColumns({"n": F.count("*").over(Window.partitionBy(line)), "_gap": F.col("p.start") - F.lag("p.stop").over(Window.partitionBy(line).orderBy("k"))})
    # one or two digits close behind a value are a footnote, as long as they explain too many values
    foot = F.coalesce((F.col("_gap") <= 2) & F.regexp_like("p.token", F.lit("^[0-9]{1,2}$")), F.lit(False))
    d = d.withColumn("_foot", foot).withColumn("_nth", F.sum(F.col("_foot").cast("int")).over(Window.partitionBy(line).orderBy("k")))
    d = d.where("NOT (_foot AND _nth <= n - width)")
    tail = F.substr("zone", F.col("p.stop") + 1)
    d = d.withColumns({"n": F.count("*").over(Window.partitionBy(line)), "k": F.row_number().over(Window.partitionBy(line).orderBy("k")), "_open": tail.rlike(r"^\s{0,2}-(?![0-9])")})
    d = d.withColumn("_which", F.sum(F.col("_open").cast("int")).over(Window.partitionBy(line).orderBy("k")))
    rest = F.try_element_at(F.regexp_extract_all("_more", F.lit(f"({VALUE})"), 1), F.col("_which").cast("int"))
    d = d.withColumn("raw_value", F.when(F.col("_open") & rest.isNotNull(), F.concat("p.token", F.lit(" - "), rest)).otherwise(F.trim("p.token")))
    full = d.where("n = width").join(columns.withColumnRenamed("col", "k"), ["release_id", "block", "k"])
    # a short line's values take the nearest columns; of values that meet in one, the nearest
    center = F.col("offset") + F.floor((F.col("p.start") + F.col("p.stop")) / 2)
    short = d.where("n <> width").join(columns, ["release_id", "block"]).withColumn("_far", F.abs(F.col("mid") - center))
    short = short.withColumn("_best", F.row_number().over(Window.partitionBy(*line, "k").orderBy("_far", "col"))).where("_best = 1")
    short = short.withColumn("_best", F.row_number().over(Window.partitionBy(*line, "col").orderBy("_far", "k"))).where("_best = 1")
    out = ["release_id", "report_month", F.col("slug").alias("table_slug"), "region", "commodity", "raw_attribute", "marketing_year", "year_status", "forecast_month", clean_number(F.col("raw_value")).alias("value"), "raw_value", F.col("unit").alias("raw_unit")]
    return full.select(out).unionByName(short.select(out))
