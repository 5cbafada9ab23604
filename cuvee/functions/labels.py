"""Labels and printed numbers as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Tokens that mean no value; characters that scans confuse with digits, and those digits.
NOT_AVAILABLE = ("", "na", "n/a", "--", "---", "tr", "neg")
CONFUSED = "ilI|{oOQDSsBZzgqGA?"
DIGITS = "1111100005582299647"
#: Order of attributes in displays, pinned regions, month cycle of a marketing year.
ATTRIBUTE_ORDER = (
    "area_planted", "area_harvested", "yield_per_harvested_acre", "beginning_stocks", "production", "imports", "supply_total", "feed_residual",
    "feed_and_residual", "food_seed_industrial", "ethanol_for_fuel", "crush", "seed", "residual", "domestic_total", "exports", "use_total",
    "ending_stocks", "stocks_to_use", "farm_price",
)
REGION_PINS = ("united_states", "world", "total_foreign", "china", "brazil", "argentina", "european_union", "major_exporters", "major_importers")
MONTH_CYCLE = ("May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec", "Jan", "Feb", "Mar", "Apr")
#: Units of prices, and short names of units.
PRICE_UNITS = ("usd_per_bushel", "usd_per_cwt", "usd_per_short_ton", "usd_per_metric_ton", "cents_per_pound", "usd_per_pound")
UNIT_NAMES = {
    "million_bushels": "mil bu", "bushels_per_acre": "bu/acre", "usd_per_bushel": "$/bu", "million_acres": "mil acres", "million_metric_tons": "MMT",
    "metric_tons_per_hectare": "t/ha", "million_cwt": "mil cwt", "usd_per_cwt": "$/cwt", "million_480lb_bales": "mil bales", "cents_per_pound": "c/lb",
    "thousand_short_tons": "k short tons", "usd_per_short_ton": "$/short ton", "million_pounds": "mil lb", "million_hectares": "mil ha",
    "thousand_acres": "k acres", "ratio": "ratio",
}


def normalize_label(c: Column) -> Column:
    """Lower case without footnote references at the end, surplus blanks, colons and final points or commas."""
    c = F.replace(c, F.lit("&amp;"), F.lit("&"))
    c = F.regexp_replace(c, r"(?:\s*(?:(?<![0-9])[0-9]{1,2}/)+[0-9]{0,2}|\s*\*)+\s*$", "")
    c = F.replace(F.trim(F.regexp_replace(c, r"\s+", " ")), F.lit(":"), F.lit(""))
    return F.lower(F.trim(F.rtrim(F.trim(c), F.lit(".,"))))


def slugify_region(c: Column) -> Column:
    c = F.regexp_replace(normalize_label(c), r"\s*(?:/[0-9]{1,2}|[0-9]{1,2}/)", "")
    return F.btrim(F.regexp_replace(c, "[^a-z0-9]+", "_"), F.lit("_"))


def clean_number(c: Column) -> Column:
    """The number that a cell prints: without footnotes, stars and thousands separators; a range of two numbers, signed
    or without a leading digit, is its midpoint; else null."""
    c = F.trim(F.replace(F.regexp_replace(F.trim(c), r"\s*[0-9]{1,2}/\s*$", ""), F.lit("*"), F.lit("")))
    one, tight = r"-?[0-9,]*\.?[0-9]+", F.regexp_replace(c, " ", "")
    low, high = (F.replace(F.regexp_extract(tight, f"^({one})-({one})$", k), F.lit(","), F.lit("")).try_cast("double") for k in (1, 2))
    number = F.when(c.rlike(f"^{one}$"), F.replace(c, F.lit(","), F.lit("")).try_cast("double"))
    return F.when(F.lower(c).isin(*NOT_AVAILABLE), F.lit(None)).otherwise(F.coalesce((low + high) / 2, number))


def parse_market_year(c: Column) -> Column:
    """struct(marketing_year, year_status) of a printed year such as 2025/26 Proj., or null."""
    pattern = r"^\s*([0-9]{4}/[0-9]{2})\s*\(?\s*(?:(Est|Proj)\.?)?\s*\)?\s*$"
    my, kind = F.regexp_extract(c, pattern, 1), F.regexp_extract(c, pattern, 2)
    status = F.when(kind == "Est", "estimate").when(kind == "Proj", "projection").otherwise("actual")
    return F.when(my != "", F.struct(my.alias("marketing_year"), status.alias("year_status")))


def month_abbreviation(c: Column) -> Column:
    """Three letters of an English month however it is printed; others pass."""
    names = F.create_map(*[F.lit(x) for m in MONTH_CYCLE for x in (m.lower(), m)])
    return F.coalesce(F.try_element_at(names, F.lower(F.left(F.trim(c), F.lit(3)))), c)


def mended_digits(c: Column) -> Column:
    """Digit look-alikes replaced, only in tokens that hold a digit and nothing but number-like characters."""
    like = "[0-9" + CONFUSED.replace("|", r"\|").replace("{", r"\{").replace("?", r"\?") + r",.\-]"
    return F.when(c.rlike(f"^{like}*[0-9]{like}*$"), F.translate(c, CONFUSED, DIGITS)).otherwise(c)


def scanned_value(c: Column) -> Column:
    """The number of a scanned token; one to three digits, a point and three digits are thousands."""
    c = mended_digits(c)
    return clean_number(F.when(c.rlike(r"^[0-9]{1,3}\.[0-9]{3}$"), F.replace(c, F.lit("."), F.lit(""))).otherwise(c))


def two_digit_year(c: Column) -> Column:
    """Marketing year of a label such as 72/73; from 73 on the start lies in the 1900s."""
    y = F.regexp_extract(c, "^([0-9]{2})/([0-9]{2})", 1).try_cast("int")
    start = F.when(y >= 73, 1900 + y).otherwise(2000 + y)
    return F.when(y.isNotNull(), F.concat(start.cast("string"), F.lit("/"), F.lpad(((y + 1) % 100).cast("string"), 2, "0")))


def attribute_rank(c: Column) -> Column:
    at = F.array_position(F.array(*[F.lit(a) for a in ATTRIBUTE_ORDER]), c)
    return F.when(at > 0, at - 1).otherwise(len(ATTRIBUTE_ORDER)).cast("int")


def region_rank(c: Column) -> Column:
    at = F.array_position(F.array(*[F.lit(a) for a in REGION_PINS]), c)
    return F.when(at > 0, at - 1).otherwise(len(REGION_PINS)).cast("int")


def dataset_label(slug: Column, commodity: Column) -> Column:
    scope = F.when(F.startswith(slug, F.lit("us_")), "US").otherwise("World")
    both = F.when(F.startswith(slug, F.lit("world_us_")), " (world & US)").otherwise("")
    return F.concat(scope, F.lit(" - "), F.initcap(F.replace(commodity, F.lit("_"), F.lit(" "))), both)


def unit_label(unit: Column) -> Column:
    """A unit's short name, else its words; empty where there is none."""
    names = F.create_map(*[F.lit(x) for kv in UNIT_NAMES.items() for x in kv])
    return F.coalesce(F.try_element_at(names, unit), F.replace(unit, F.lit("_"), F.lit(" ")), F.lit(""))


def pretty(name: Column) -> Column:
    words = F.lower(F.replace(name, F.lit("_"), F.lit(" ")))
    return F.concat(F.upper(F.left(words, F.lit(1))), F.substr(words, F.lit(2)))


def is_price(attribute: Column, unit: Column) -> Column:
    return F.coalesce(attribute == "farm_price", F.lit(False)) | F.coalesce(unit.isin(*PRICE_UNITS), F.lit(False))


def month_rank(c: Column) -> Column:
    """Place of a month in the marketing year's cycle; others last."""
    at = F.array_position(F.array(*[F.lit(m) for m in MONTH_CYCLE]), c)
    return F.when(at > 0, at - 1).otherwise(len(MONTH_CYCLE)).cast("int")


def cache_key(c: Column) -> Column:
    return F.left(F.sha1(c), F.lit(16))
