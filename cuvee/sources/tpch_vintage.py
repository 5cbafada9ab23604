"""Vintage observations made from the driver's order tables, with planted faults, and the same as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..operators.vintage import month_name

#: Suppliers of a region's part.
SUPPLIERS = 20
#: What all chains, series and column groups are parts of.
PLACE = ["table_slug", "commodity", "region"]
ATTRIBUTES = ("beginning_stocks", "production", "imports", "domestic_total", "exports", "supply_total", "use_total", "ending_stocks", "farm_price")


def _read(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*cols)


def observations(spark: SparkSession, sf_dir: str, parts: int | None = None) -> DataFrame:
    """All observations, those of superseded releases included, dealt by PLACE; to so many partitions with ``parts``.

    A printed row is the sums of a (report month, region, commodity, start); its chain is looked back on as a whole, before
    its attributes and columns become rows, and all further steps find the rows of a place in one partition."""
    line = _read(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate")
    places = (
        _read(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
        .join(F.broadcast(_read(spark, sf_dir, "nation", "n_nationkey", "n_regionkey")), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(F.broadcast(_read(spark, sf_dir, "region", "r_regionkey", "r_name")), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    # suppliers by number share a region's part, so that series grow with the tables; the first part has the bare name
    part = F.floor(F.col("s_suppkey") / SUPPLIERS).cast("long")
    name = F.concat(F.lower("r_name"), F.when(part > 0, F.concat(F.lit("_"), part)).otherwise(""))
    line = line.select(
        "l_orderkey", "l_suppkey", F.when(F.col("l_partkey") % 2 == 0, "corn").otherwise("wheat").alias("commodity"),
        (F.year("l_shipdate") - (F.month("l_shipdate") < 5).cast("int")).alias("start"), F.col("l_linenumber").cast("int").alias("n"), F.col("l_quantity").cast("double").alias("q"),
    )
    month = _read(spark, sf_dir, "orders", "o_orderkey", F.trunc("o_orderdate", "month").alias("report_month"))
    d = line.join(month, F.col("l_orderkey") == F.col("o_orderkey")).join(places.select("s_suppkey", name.alias("region")), F.col("l_suppkey") == F.col("s_suppkey"))
    age = (F.year("report_month") - F.col("start")) * 12 + F.month("report_month") - 5
    d = d.select("report_month", F.concat(F.lit("us_"), "commodity").alias("table_slug"), "region", "commodity", "start", age.alias("age"), "n", "q")
    d = d.where("age BETWEEN 0 AND 28 AND report_month <> DATE '1998-10-01'")
    d = d.repartition(parts, *PLACE) if parts else d.repartition(*PLACE)
    of = lambda *n: F.sum(F.when(F.col("n").isin(*n), F.col("q")).otherwise(0.0))
    d = d.groupBy(*PLACE, "start", "report_month", "age").agg(of(1).alias("b"), of(2, 3).alias("p"), of(4).alias("i"), of(5).alias("d"), of(6, 7).alias("e"))
    d = d.withColumns({"s": F.col("b") + F.col("p") + F.col("i"), "u": F.col("d") + F.col("e")})
    value = {
        "beginning_stocks": F.col("b"), "production": F.col("p"), "imports": F.col("i"), "domestic_total": F.col("d"), "exports": F.col("e"),
        "supply_total": F.col("s") + F.when(F.month("report_month") == 7, 100.0).otherwise(0.0), "use_total": F.col("u"),
        "ending_stocks": F.col("s") - F.col("u"), "farm_price": F.col("b") / 100.0,
    }
    d = d.select(*PLACE, "start", "report_month", "age", F.array(*[value[a] for a in ATTRIBUTES]).alias("now"))
    # every row holds all attributes, so their chains have the same months
    chain = Window.partitionBy(*PLACE, "start").orderBy("report_month")
    d = d.withColumns({"last": F.lag("now").over(chain), "last_month": F.lag("report_month").over(chain)})
    status = F.when(F.col("age") < 12, "projection").when(F.col("age") < 24, "estimate").otherwise("actual")
    d = d.withColumns({"year_status": status, "marketing_year": F.format_string("%04d/%02d", F.col("start"), (F.col("start") + 1) % 100)})
    projected = F.col("year_status") == "projection"
    column = lambda label, values: F.struct(label.alias("forecast_month"), values.alias("values"))
    later = F.when(F.month("report_month") == 9, 2.0).otherwise(0.0)
    none = F.array(*[F.lit(None).cast("double") for _ in ATTRIBUTES])
    printed = F.array(
        column(F.when(projected, month_name("report_month")).otherwise(""), F.col("now")),
        F.when(projected, column(month_name(F.coalesce(F.col("last_month"), F.add_months("report_month", -1))), F.transform(F.coalesce("last", none), lambda x: x + later))),
        F.when(~projected & (F.col("report_month") == "1999-03-01"), column(month_name("report_month"), F.transform("now", lambda x: x + 1.0))),
    )
    tails = F.when(F.col("report_month") == "1999-06-01", F.array(F.lit(""), F.lit("-v2"))).otherwise(F.array(F.lit("")))
    d = d.select(*PLACE, "marketing_year", "report_month", "year_status", F.explode(F.array_compact(printed)).alias("x"), tails.alias("tails"))
    d = d.select("*", F.explode("tails").alias("tail"))
    d = d.select("*", F.posexplode(F.col("x")["values"]).alias("k", "v"))
    d = d.withColumn("attribute", F.get(F.array(*[F.lit(a) for a in ATTRIBUTES]), F.col("k")))
    again = F.when((F.col("tail") != "") & (F.col("attribute") == "farm_price"), F.col("v") + 0.5).otherwise(F.col("v"))
    month = F.month("report_month")
    qa = (
        F.when((F.col("attribute") == "exports") & (month == 2), "quarantined")
        .when((F.col("attribute") == "imports") & (month == 3), "corrected")
        .when((F.col("attribute") == "farm_price") & (month == 4), "warn")
        .otherwise("ok")
    )
    unit = F.when(F.col("attribute") == "farm_price", F.when(F.col("report_month") < "1996-01-01", None).otherwise("usd_per_bu")).otherwise("million_bu")
    return d.select(
        F.concat(F.lit("report-"), F.col("report_month").cast("string"), "tail").alias("release_id"), "report_month", "table_slug", "region", "commodity", "attribute", "marketing_year",
        "year_status", F.col("x")["forecast_month"].alias("forecast_month"), again.alias("value"), unit.alias("unit"), qa.alias("qa_status"),
    )


def releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A release for each order month (the dropped month too), a second version of June 1999, winners not yet chosen."""
    months = _read(spark, sf_dir, "orders", F.trunc("o_orderdate", "month").alias("report_month")).distinct()
    one = months.select("report_month", F.explode(F.when(F.col("report_month") == "1999-06-01", F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("version"))
    return one.select(
        F.concat(F.lit("report-"), F.col("report_month").cast("string"), F.when(F.col("version") > 1, F.concat(F.lit("-v"), "version")).otherwise("")).alias("release_id"),
        "report_month",
        "version",
        F.date_add("report_month", 9 + F.col("version")).cast("timestamp").alias("release_datetime"),
        F.lit(False).alias("is_latest"),
        F.when(F.year("report_month") < 1998, "txt").otherwise("xml").alias("format_era"),
    )


SQL = """
base AS (
    SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS report_month, lower(r_name) || CASE WHEN s_suppkey // 20 > 0 THEN '_' || s_suppkey // 20 ELSE '' END AS region,
           CASE WHEN l_partkey % 2 = 0 THEN 'corn' ELSE 'wheat' END AS commodity,
           year(l_shipdate) - CASE WHEN month(l_shipdate) < 5 THEN 1 ELSE 0 END AS start, l_linenumber AS n, l_quantity AS q
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
), sums AS (
    SELECT report_month, region, commodity, start, (year(report_month) - start) * 12 + month(report_month) - 5 AS age,
           coalesce(sum(q) FILTER (n = 1), 0) AS b, coalesce(sum(q) FILTER (n IN (2, 3)), 0) AS p, coalesce(sum(q) FILTER (n = 4), 0) AS i,
           coalesce(sum(q) FILTER (n = 5), 0) AS d, coalesce(sum(q) FILTER (n IN (6, 7)), 0) AS e
    FROM base GROUP BY ALL
), cells AS (
    SELECT report_month, 'us_' || commodity AS table_slug, region, commodity,
           start || '/' || lpad(CAST((start + 1) % 100 AS VARCHAR), 2, '0') AS marketing_year,
           CASE WHEN age < 12 THEN 'projection' WHEN age < 24 THEN 'estimate' ELSE 'actual' END AS year_status, x.attribute, x.value
    FROM sums, unnest([
        {'attribute': 'beginning_stocks', 'value': b}, {'attribute': 'production', 'value': p}, {'attribute': 'imports', 'value': i},
        {'attribute': 'domestic_total', 'value': d}, {'attribute': 'exports', 'value': e},
        {'attribute': 'supply_total', 'value': b + p + i + CASE WHEN month(report_month) = 7 THEN 100.0::DOUBLE ELSE 0.0::DOUBLE END},
        {'attribute': 'use_total', 'value': d + e}, {'attribute': 'ending_stocks', 'value': b + p + i - (d + e)},
        {'attribute': 'farm_price', 'value': b / 100.0::DOUBLE}]) AS u(x)
    WHERE age BETWEEN 0 AND 28 AND report_month <> DATE '1998-10-01'
), lagged AS (
    SELECT *, lag(value) OVER w AS v0, lag(report_month) OVER w AS m0 FROM cells
    WINDOW w AS (PARTITION BY table_slug, commodity, region, marketing_year, attribute ORDER BY report_month)
), printed AS (
    SELECT report_month, table_slug, region, commodity, marketing_year, year_status, attribute, value,
           CASE WHEN year_status = 'projection' THEN strftime(report_month, '%b') ELSE '' END AS forecast_month FROM lagged
    UNION ALL SELECT report_month, table_slug, region, commodity, marketing_year, year_status, attribute,
           v0 + CASE WHEN month(report_month) = 9 THEN 2 ELSE 0 END,
           strftime(coalesce(m0, CAST(report_month - INTERVAL 1 MONTH AS DATE)), '%b') FROM lagged WHERE year_status = 'projection'
    UNION ALL SELECT report_month, table_slug, region, commodity, marketing_year, year_status, attribute, value + 1, strftime(report_month, '%b')
    FROM lagged WHERE year_status <> 'projection' AND report_month = DATE '1999-03-01'
), obs_all AS (
    SELECT 'report-' || CAST(report_month AS VARCHAR) || v.tail AS release_id, report_month, table_slug, region, commodity, attribute, marketing_year,
           year_status, forecast_month, value + CASE WHEN v.tail <> '' AND attribute = 'farm_price' THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS value,
           CASE WHEN attribute = 'farm_price' THEN CASE WHEN report_month < DATE '1996-01-01' THEN NULL ELSE 'usd_per_bu' END ELSE 'million_bu' END AS unit,
           CASE WHEN attribute = 'exports' AND month(report_month) = 2 THEN 'quarantined' WHEN attribute = 'imports' AND month(report_month) = 3 THEN 'corrected'
                WHEN attribute = 'farm_price' AND month(report_month) = 4 THEN 'warn' ELSE 'ok' END AS qa_status
    FROM printed JOIN (VALUES (''), ('-v2')) v(tail) ON v.tail = '' OR report_month = DATE '1999-06-01'
), rel AS (
    SELECT *, row_number() OVER (PARTITION BY report_month ORDER BY (release_id IN (SELECT release_id FROM obs_all)) DESC, version DESC, release_datetime DESC) = 1 AS is_latest
    FROM (
        SELECT 'report-' || CAST(m AS VARCHAR) || CASE WHEN v.version > 1 THEN '-v' || v.version ELSE '' END AS release_id, m AS report_month, v.version,
               CAST(m + CAST(9 + v.version AS INTEGER) AS TIMESTAMP) AS release_datetime, CASE WHEN year(m) < 1998 THEN 'txt' ELSE 'xml' END AS format_era
        FROM (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS m FROM orders) JOIN (VALUES (1), (2)) v(version) ON v.version = 1 OR m = DATE '1999-06-01'
    )
), obs AS (SELECT o.* FROM obs_all o JOIN rel USING (release_id) WHERE is_latest)
"""
