"""Vintage analytics on tiny frames: the documented cases of every operator group."""

import datetime as dt
import json
import math

import pytest
from pyspark.sql import functions as F

OBS = "release_id string, report_month date, attribute string, marketing_year string, year_status string, forecast_month string, value double"


def day(s):
    return dt.date.fromisoformat(s)


@pytest.fixture()
def obs(spark):
    rows = [
        ("r1", "2012-05-01", "ending_stocks", "2012/13", "projection", "May", 10.0), ("r1", "2012-05-01", "ending_stocks", "2012/13", "projection", "Apr", None),
        ("r2", "2012-06-01", "ending_stocks", "2012/13", "projection", "Jun", 12.0), ("r2", "2012-06-01", "ending_stocks", "2012/13", "projection", "May", 11.0),
        ("r4", "2012-08-01", "ending_stocks", "2012/13", "projection", "Aug", -6.0),
        ("r5", "2012-09-01", "ending_stocks", "2012/13", "estimate", "", -3.0), ("r5", "2012-09-01", "ending_stocks", "2012/13", "estimate", "Sep", 99.0),
        ("r6", "2012-10-01", "ending_stocks", "2012/13", "actual", "", 0.0), ("r7", "2012-11-01", "ending_stocks", "2012/13", "actual", "", 5.0),
        ("r7", "2012-11-01", "use_total", "2012/13", "actual", "", 0.0),
        ("r8", "2012-12-01", "ending_stocks", "2012/13", "actual", "", None), ("r8", "2012-12-01", "ending_stocks", "2012/13", "actual", "Dec", 7.0),
    ]
    return spark.createDataFrame([(r[0], day(r[1]), *r[2:]) for r in rows], OBS)


def test_headlines(obs):
    from cuvee.operators.vintage import current_values, vintage_series

    got = {(str(r.report_month), r.attribute): r.value for r in current_values(obs).collect()}
    assert got[("2012-09-01", "ending_stocks")] == -3.0  # the unlabelled twin
    assert ("2012-12-01", "ending_stocks") not in got  # an unlabelled null suppresses its labelled twin
    assert vintage_series(obs, ["1999/00"]).count() == 0


def test_revisions(obs):
    from cuvee.operators.vintage import mom_changes

    got = {str(r.report_month)[:7]: r for r in mom_changes(obs).where("attribute = 'ending_stocks'").collect()}
    assert got["2012-05"].method == "within_report" and got["2012-05"].is_first_print and got["2012-05"].delta is None
    assert (got["2012-06"].value_prev, got["2012-06"].reprint_revision) == (11.0, 1.0)
    assert got["2012-08"].method == "cross_release" and got["2012-08"].delta == -18.0  # the previous available report
    assert got["2012-09"].pct_change == pytest.approx(0.5)  # absolute denominator
    assert got["2012-11"].pct_change is None and got["2012-11"].delta == 5.0


def test_finals_errors_ratio(obs):
    from cuvee.operators import vintage as v

    cur = v.current_values(obs)
    fin = {r.attribute: r for r in v.final_values(obs).collect()}
    assert (fin["ending_stocks"].final_value, fin["ending_stocks"].n_reports) == (5.0, 6)
    err = {(r.attribute, str(r.report_month)[:7]): r for r in v.attach_errors(cur, v.final_values(obs)).collect()}
    assert err[("ending_stocks", "2012-08")].pct_error == pytest.approx(-2.2) and err[("ending_stocks", "2012-08")].horizon_months == 3
    assert err[("use_total", "2012-11")].pct_error is None
    assert v.stocks_to_use(obs).first().value is None


def test_bias(spark):
    from cuvee.operators.stats import bias_summary, horizon_bucket, wilcoxon_p

    rows = [("a", 1, x / 100) for x in range(1, 9)] + [("b", 1, x) for x in (-0.05, -0.04, -0.03, -0.02, -0.01, 0.01, 0.02, 0.03, 0.04, 0.0)]
    rows += [("c", 1, 0.5), ("d", 1, None)]
    got = {r.attribute: r for r in bias_summary(spark.createDataFrame(rows, "attribute string, calendar_month int, pct_error double")).collect()}
    assert got["a"].hit_rate_over == 1.0 and got["a"].wilcoxon_p == pytest.approx(2 / 2**8) and got["a"].t_stat > 0
    assert got["b"].wilcoxon_p > 0.05 and got["b"].hit_rate_over == 0.4
    assert got["c"].wilcoxon_p is None and got["c"].t_stat is None and got["c"].n == 1
    assert got["d"].n == 0 and got["d"].mean_pct_error is None
    assert wilcoxon_p(4, 0, 0) is None and wilcoxon_p(60, 900, 12.0) == pytest.approx(math.erfc(abs(900 - 915) / math.sqrt(60 * 61 * 121 / 24 - 0.25) / math.sqrt(2)))
    labels = spark.range(0, 30).select(horizon_bucket(F.col("id")).alias("b")).collect()
    assert [labels[i].b for i in (0, 1, 3, 4, 12, 13, 24, 25)] == [None, "1-3", "1-3", "4-6", "10-12", "13-18", "19-24", "25+"]


CORN = {"beginning_stocks": 100.0, "production": 900.0, "imports": 10.0, "supply_total": 1010.0, "domestic_total": 600.0, "exports": 300.0, "use_total": 900.0, "ending_stocks": 110.0}


def groups(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, commodity string, vals map<string,double>, vals2 map<string,double>")


def test_repair(spark):
    from cuvee.operators import balance

    cases = [
        CORN, {**CORN, "imports": None}, {k: v for k, v in CORN.items() if k not in ("supply_total", "imports")}, {**CORN, "production": 950.0},
        {**CORN, "use_total": 950.0}, {"use_total": 5.0, "price": 3.0}, {},
    ]
    soy = {"crush": 50.0, "exports": 20.0, "seed": 3.0, "residual": 2.0, "use_total": 75.0}
    g = groups(spark, [("corn", c, None) for c in cases] + [("soybeans", soy, None)])
    out = {r.id: {c.attribute: (c.value, c.qa_status) for c in r.cells} for r in balance.repaired(g).collect()}
    assert out[0] == {k: (v, "ok") for k, v in CORN.items()}
    assert out[1] == {k: (10.0, "corrected") if k == "imports" else (v, "ok") for k, v in CORN.items()}
    assert out[2]["supply_total"] == (1010.0, "corrected") and out[2]["imports"] == (10.0, "corrected")  # the ending identity unlocks the supply identity
    assert out[3]["production"][1] == "quarantined" and out[3]["exports"] == (300.0, "ok")
    assert out[5] == {"use_total": (5.0, "ok"), "price": (3.0, "warn")} and out[6] == {}
    assert {s for _, s in out[7].values()} == {"ok"}
    kept = {r.id: {c.attribute for c in r.cells} for r in balance.repaired(g, emit_derived=False).collect()}
    assert kept[2] == set(cases[2])
    got = {r.id: (r.ok, r.lone) for r in g.select("id", balance.identities_pass(g).alias("ok"), balance.lone_error().alias("lone")).collect()}
    assert got[0][0] and got[5][0] and got[7][0] and not got[4][0] and tuple(got[4][1]) == ("use_total", 900.0) and got[5][1] is None
    assert "Python" not in spark._jvm.PythonSQLUtils.explainString(balance.repaired(g)._jdf.queryExecution(), "simple")


def test_arbitration(spark):
    from cuvee.operators import balance

    wrong, lost = {**CORN, "production": 909.0}, {k: v for k, v in CORN.items() if k != "exports"}
    cases = [(CORN, CORN), (wrong, CORN), (CORN, wrong), ({"price": 3.0}, {"price": 4.0}), ({}, {"price": 4.0}), ({"price": None}, {"price": None}), (lost, CORN), (None, None)]
    g = groups(spark, [("corn", *c) for c in cases])
    out = {r.id: {c.attribute: (c.value, c.qa_status) for c in r.cells} for r in balance.arbitrated(g).collect()}
    assert out[0] == {k: (v, "ok") for k, v in CORN.items()}
    assert out[1]["production"] == (900.0, "corrected") and out[2]["production"] == (900.0, "ok")
    assert out[3] == {"price": (3.0, "quarantined")} and out[4] == {"price": (4.0, "warn")} and out[5] == {} == out[7]
    assert out[6]["exports"] == (300.0, "corrected")
    updates, inserts, worklist = balance.reconciled(g, ["id"])
    assert {(r.id, r.attribute) for r in inserts.collect()} == {(4, "price"), (6, "exports")}
    assert [(r.id, r.attribute) for r in worklist.collect()] == [(3, "price")] and updates.where("id = 1 AND attribute = 'production'").first().value == 900.0


def test_identity_checks(spark):
    from cuvee.operators.balance import column_groups, identities_pass
    from cuvee.operators.quality import Verified, apply_whitelist, check_identities

    def rows(vals, com, fm="May"):
        return [("r", "us_" + com, com, "us", "2012/13", fm, a, v) for a, v in vals.items()]

    soy = {"crush": 50.0, "exports": 20.0, "seed": 3.0, "residual": 2.0, "use_total": 95.0}
    rounded = {k: v / 10 for k, v in CORN.items()} | {"supply_total": 101.1}
    data = rows(CORN, "corn") + rows({**CORN, "supply_total": 1200.0}, "corn", "Jun") + rows(soy, "soybeans") + rows(rounded, "corn", "Jul")
    d = spark.createDataFrame(data, "release_id string, table_slug string, commodity string, region string, marketing_year string, forecast_month string, attribute string, value double")
    found = {(r.check_name, r.detail) for r in check_identities(d).collect()}
    assert found == {("supply_identity", "corn/us 2012/13 Jun"), ("ending_identity", "corn/us 2012/13 Jun"), ("use_identity", "soybeans/us 2012/13 May")}
    demoted = apply_whitelist(check_identities(d), [Verified("use_identity", detail_prefix="soy"), Verified("supply_identity", release_id="other")])
    assert {r.check_name: r.severity for r in demoted.collect()} == {"supply_identity": "fail", "ending_identity": "fail", "use_identity": "whitelisted"}
    g = column_groups(d, ["commodity", "forecast_month"])
    assert {(r.commodity, r.forecast_month): r.ok for r in g.select("commodity", "forecast_month", identities_pass(g).alias("ok")).collect()} == {("corn", "May"): True, ("corn", "Jun"): False, ("soybeans", "May"): False, ("corn", "Jul"): True}


def test_store(spark, tmp_path):
    from cuvee.operators import store

    old = spark.createDataFrame([("a", 1, 1.0), ("b", None, 2.0)], "release_id string, k int, value double")
    new = spark.createDataFrame([("b", None, 3.0, 1), ("b", None, 4.0, 2), ("c", 1, 5.0, 1)], "release_id string, k int, value double, seq int")
    once = store.upsert(old, new, ["release_id", "k"], "seq")
    twice = store.upsert(once, new, ["release_id", "k"], "seq")
    want = [("a", 1, 1.0), ("b", None, 4.0), ("c", 1, 5.0)]
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, twice.collect()), key=str) == want
    assert store.replace_release(once, new.where("release_id = 'c'"), ["release_id", "k"], "seq").count() == 3
    path = f"file://{tmp_path}/t"
    assert store.publish(old, path) == 2 and store.publish(once, path) == 3 and store.current(spark, path).count() == 3
    assert store.export({"x": old}, f"file://{tmp_path}/e") == {"x": 2}


def test_labels(spark):
    from cuvee.functions import labels as l

    def one(f, *texts):
        return [r.v for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(f(F.col("t")).alias("v")).collect()]

    assert one(l.normalize_label, "Beginning Stocks 2/", "Feed &amp; Residual *", " Use,  Total: ", "Avg. Price 2/7/", None) == ["beginning stocks", "feed & residual", "use, total", "avg. price", None]
    assert one(l.slugify_region, "United States 3/", "World 2/", "Former Soviet Union-12") == ["united_states", "world", "former_soviet_union_12"]
    assert one(l.clean_number, "1,234", "5.10-5.30", "NA", "--", "12.5 2/", "abc", "-3", "5.", None) == [1234.0, pytest.approx(5.2), None, None, 12.5, None, -3.0, None, None]
    assert [tuple(v) if v else None for v in one(l.parse_market_year, "2025/26 Proj.", "2024/25 (Est.)", "2023/24", "May")] == [("2025/26", "projection"), ("2024/25", "estimate"), ("2023/24", "actual"), None]
    assert one(l.month_abbreviation, "September", "sept", "May", "x") == ["Sep", "Sep", "May", "x"]
    assert one(l.scanned_value, "1.181", "l2O", "word", "7.5") == [1181.0, 120.0, None, 7.5]
    assert one(l.two_digit_year, "72/73", "73/74", "99/00", "x") == ["2072/73", "1973/74", "1999/00", None]


def test_normalize_cells(spark):
    from cuvee.operators.dims import alias_collisions, normalize_cells

    cells = spark.createDataFrame(
        [("r", "t", "Exports 2/", "Corn", "Bu"), ("r", "t", "Mystery", "Corn", "Bu"), ("r", "t", "Exports", "Corn", "Odd")],
        "release_id string, table_slug string, raw_attribute string, raw_commodity string, raw_unit string",
    )
    alias = lambda *p: spark.createDataFrame(list(p), "alias string, slug string")
    kept, misses = normalize_cells(cells, alias(("exports", "exports")), alias(("corn", "corn")), alias(("bu", "bushels")))
    assert {(r.attribute, r.unit) for r in kept.collect()} == {("exports", "bushels"), ("exports", None)}
    assert {(r.kind, r.raw_label) for r in misses.collect()} == {("attribute", "Mystery"), ("unit", "Odd")}
    assert alias_collisions(alias(("a", "x"), ("A:", "y"), ("b", "z"))).first().alias == "a"


def test_catalog(spark, tmp_path):
    from cuvee.sources import catalog

    url = "https://host/files/"
    entry = lambda i, t, *f: {"id": i, "title": "T", "release_datetime": t, "files": [url + x for x in f]}
    pages = [
        [entry("1", "2026-05-12T12:00:00+0000", "report0526v2.pdf", "report0526v2.xml"), entry("2", "2026-05-11T12:00:00+0000", "report0526.txt", "extra.txt")],
        [entry("2", "2026-05-11T12:00:00+0000", "dup.pdf"), entry("3", "1985-06-01T08:30:00+0000", "scan.pdf"), entry("4", "1990-01-01T00:00:00+0000")],
    ]
    for k, results in enumerate(pages):
        (tmp_path / f"p{k}.json").write_text(json.dumps({"pager": {"current_page": k, "items_per_page": 2, "total_pages": 2, "total_results": 4}, "results": results}))
    rel = catalog.releases(catalog.read_pages(spark, str(tmp_path)))
    got = {r.catalog_id: (r.release_id, r.version, r.format_era, str(r.report_month)) for r in rel.collect()}
    assert got == {
        "1": ("report-2026-05-12-v2", 2, "xml", "2026-05-01"), "2": ("report-2026-05-11", 1, "txt", "2026-05-01"),
        "3": ("report-1985-06-01", 1, "pdf_scan", "1985-06-01"), "4": ("report-1990-01-01", 1, "unknown", "1990-01-01"),
    }
    assert {r.release_id for r in catalog.latest_ids(rel).collect()} >= {"report-2026-05-12-v2", "report-1985-06-01"}
    plan = {r.url[len(url) :]: (r.target, r.is_canonical) for r in catalog.archive_plan(rel, r"report\d{4}(v\d+)?").collect()}
    assert plan["report0526.txt"] == ("2026-05/report-2026-05-11.txt", True) and plan["extra.txt"] == ("2026-05/report-2026-05-11__extra.txt", False)
    assert rel.where("catalog_id = '1'").select(catalog.file_for("xml").alias("f")).first().f.endswith("v2.xml")


def test_scanned_pages(spark):
    from cuvee.sources.pages import cells, columns_of, rebuilt_lines

    text = "FEED GRAINS\n:      Million metric tons\nProduction : 100.1 110.2 120 121.5 +/- 3\nCORN\n: Million bushels\nFroduction : 7,650 8,877 8.865 8,8O0\nEnding stocks 1 3,120 1,648 4,040 4,100\nnothing here"
    pages = spark.createDataFrame([("r", day("1985-06-01"), 1, "us_corn", text)], "release_id string, report_month date, page_no int, table_slug string, text string")
    got = {(r.commodity, r.raw_attribute, r.marketing_year, r.forecast_month): (r.value, r.unit) for r in cells(pages).collect()}
    assert got[("feed_grains", "production", "1985/86", "Jun")] == (121.5, "Million Metric Tons")
    assert got[("corn", "production", "1985/86", "May")] == (8865.0, "Million Bushels") and got[("corn", "production", "1985/86", "Jun")][0] == 8800.0
    assert got[("corn", "ending_stocks", "1983/84", "")][0] == 3120.0
    months = spark.createDataFrame([(day("1981-07-01"),), (day("1985-05-01"),), (day("1986-01-01"),)], "m date").select(columns_of("m").alias("c")).collect()
    assert [len(r.c) for r in months] == [3, 3, 4] and months[2].c[2].forecast_month == "Dec" and months[2].c[0].marketing_year == "1983/84"
    boxes = spark.createDataFrame([(1, 50, 0, 60, 10, "b"), (1, 0, 2, 10, 12, "a"), (1, 0, 40, 10, 50, "c")], "page int, x0 int, y0 int, x1 int, y1 int, text string")
    assert rebuilt_lines(boxes).first().text == "a b\nc"


XML = """<Root xmlns="any"><Report Name="sr12" sub_report_title="U.S. Feed Grain and Corn"><matrix2><m1 m2_unit_descr1="Million Bushels"><g attribute1="Exports 2/">
<h market_year1="2025/26 Proj." forecast_month1="June"><Cell cell_value1="1,200"/></h><h market_year1="2024/25 Est."><Cell cell_value1="1,100"/></h></g></m1></matrix2>
<matrix1><g attribute1="Yield"><h market_year1="2023/24"><Cell cell_value1="NA"/><Cell/></h></g></matrix1></Report><Report Name="cover"/></Root>"""


def test_xml_reports(spark):
    from cuvee.sources import xml_report as x

    files = spark.createDataFrame([("f.xml", bytearray(XML.encode()))], "path string, content binary")
    tables = spark.createDataFrame([("us_other", "Corn$", 2, "us", "x"), ("us_corn", "Feed Grain", 1, "united_states", "corn")], "slug string, pattern string, place int, region string, commodity string")
    got = {(r.matrix, r.raw_attribute, r.marketing_year): (r.table_slug, r.region, r.year_status, r.forecast_month, r.value, r.raw_unit) for r in x.cells(x.raw_cells(files), tables).collect()}
    assert got == {
        (1, "Exports 2/", "2025/26"): ("us_corn", "united_states", "projection", "Jun", 1200.0, "Million Bushels"),
        (1, "Exports 2/", "2024/25"): ("us_corn", "united_states", "estimate", "", 1100.0, "Million Bushels"),
        (0, "Yield", "2023/24"): ("us_corn", "united_states", "actual", "", None, None),
    }


def test_xml_tables_prove_themselves(spark):
    from cuvee.sources import xml_report as x

    def report(n, title, *matrices, sub=""):
        return f'<Report Name="sr{n}" sub_report_title="{title}" sub_report_subtitle="{sub}">' + "".join(f"<matrix{k}>{m}</matrix{k}>" for k, m in enumerate(matrices, 1)) + "</Report>"

    def rows(unit, *names):
        u = f'<u m1_unit_descr1="{unit}"/>' if unit else ""
        return u + "".join(f'<g attribute1="{n}"><h market_year1="2024/25"><Cell cell_value1="5"/></h></g>' for n in names)

    world = '<r region_header1="World 2/"><g attribute1="Output"><h commodity_header2="2023/24 Est."><Cell cell_value1="7"/></h></g><g attribute_group1="Soft" attribute1="Trade"><h market_year1="2024/25"><Cell cell_value1="8"/></h></g></r>'
    files = {
        "good": report(1, "Corn", rows("Metric Tons", "Exports"), rows("Million Bushels", "Exports", "Farm Price ($/bu)")) + report(2, "World", world, sub="(Million Tons)") + report(3, "Eggs", rows("", "x")) + report(4, "Other", rows("", "y")),
        "backup": report(1, "Corn", rows("Metric Tons", "Exports"), rows("Metric Tons", "Exports", "Farm Price ($/bu)", "Season Price")),
        "unproven": report(1, "Corn", rows("Metric Tons", "Exports"), rows("Million Bushels", "Exports")) + report(2, "World", world),
        "swapped": report(1, "Corn", rows("Metric Tons", "Farm Price ($/bu)")),
        "wrong unit": report(1, "Corn", rows("Bushels", "Exports")),
        "many": report(1, "Corn", *[rows("Metric Tons", "Exports")] * 3),
        "broken": "<Report>",
    }
    d = spark.createDataFrame([*((k, bytearray(f"<Root>{v}</Root>".encode())) for k, v in files.items()), ("odd", bytearray(b'<?xml version="1.0" encoding="none"?><a/>'))], "path string, content binary")
    first = {"commodity": "feed", "unit_has": "metric tons", "has_not": "Farm Price"}
    second = {"commodity": "corn", "unit_has": "Bushels", "has": "farm price ($/bu)", "area": "Acres", "yield": "Bushels", "quantity": "Million Bushels"}
    schema = f"slug string, pattern string, place int, region string, commodity string, skip boolean, price_unit string, matrices array<{x.MATRIX}>"
    fill = lambda m: {k: m.get(k) for k in ("commodity", "unit", "unit_has", "has", "has_not", "area", "yield", "quantity")}
    tables = spark.createDataFrame([("corn", "^Corn", 1, "us", None, False, "each", [fill(first), fill(second)]), ("world", "^World", 2, "world", "wheat", None, None, None), ("eggs", "Eggs", 3, "us", "eggs", True, None, None)], schema)
    raw = x.raw_cells(d).cache()
    problems = {(r.file, r.matrix): r.problem for r in x.structure_errors(raw, tables).collect()}
    assert problems == {("unproven", 1): "attribute absent", ("swapped", 0): "forbidden attribute", ("wrong unit", 0): "other quantity unit", **{("many", k): "more matrices than known" for k in range(3)}, ("broken", None): "not XML", ("odd", None): "not XML"}
    got = {(r.file, r.table_slug, r.raw_commodity, r.raw_attribute): (r.region, r.marketing_year, r.year_status, r.value, r.raw_unit) for r in x.cells(raw, tables).collect()}
    us = ("us", "2024/25", "actual", 5.0)
    assert got == {
        ("good", "corn", "feed", "Exports"): (*us, "Metric Tons"), ("good", "corn", "corn", "Exports"): (*us, "Million Bushels"), ("good", "corn", "corn", "Farm Price ($/bu)"): (*us, "$/bu"),
        ("good", "world", "wheat", "Output"): ("world", "2023/24", "estimate", 7.0, "Million Tons"), ("good", "world", "Soft", "Trade"): ("world", "2024/25", "actual", 8.0, "Million Tons"),
        ("backup", "corn", "feed", "Exports"): (*us, "Metric Tons"), ("backup", "corn", "corn", "Exports"): (*us, "Million Bushels"), ("backup", "corn", "corn", "Farm Price ($/bu)"): (*us, "$/bu"),
        ("backup", "corn", "corn", "Season Price"): (*us, "each"),
    }
    assert {(r.title, r.kind) for r in x.unread_tables(raw, tables).collect()} == {("Eggs", "skipped"), ("Other", "unknown")}


RULE = "=" * 60
TEXT = f"""
                 U.S. Corn Supply and Use  1/
                   (Million Bushels)
{RULE}
                      :  2003/04 :  2004/05  :   2005/06 Projections
      Item            :          :   Est.    :     May        June
{RULE}
CORN                  :
                      :      Million bushels
Beginning stocks      :    1,087        958        2,215      2,115
Yield per harvested   :
 acre                 :    142.2      160.4        148.0      148.0
Exports           2/  :    1,897 3    1,800        1,850      1,850
CCC inventory         :                                         1
Avg. price ($/bu)     :     2.42    1.95- 2.15    1.60 -     1.55 -
                      :                           2.00       1.95
{RULE}
Note: nothing here : 1 2 3 4
{RULE}
"""


def test_text_reports(spark):
    from cuvee.sources.text_reports import cells

    files = spark.createDataFrame([("r", day("2005-06-01"), TEXT)], "release_id string, report_month date, text string")
    specs = spark.createDataFrame([("us_corn", "(?i)U\\.S\\. Corn", 1, "united_states", "corn"), ("any", "Supply", 2, "x", "y")], "slug string, pattern string, place int, region string, commodity string")
    sections = spark.createDataFrame([("corn", "corn")], "alias string, slug string")
    got = {(r.raw_attribute, r.marketing_year, r.forecast_month): (r.value, r.year_status, r.raw_unit, r.table_slug) for r in cells(files, specs, sections).collect()}
    at = lambda a: [got.get((a, *c), (None,))[0] for c in (("2003/04", ""), ("2004/05", ""), ("2005/06", "May"), ("2005/06", "Jun"))]
    assert at("Beginning stocks") == [1087.0, 958.0, 2215.0, 2115.0] and at("Yield per harvested acre") == [142.2, 160.4, 148.0, 148.0]
    assert at("Exports 2/") == [1897.0, 1800.0, 1850.0, 1850.0] and at("CCC inventory") == [None, None, None, 1.0]
    assert at("Avg. price ($/bu)") == [2.42, pytest.approx(2.05), pytest.approx(1.8), pytest.approx(1.75)]
    assert got[("Exports 2/", "2004/05", "")][1:] == ("estimate", "Million bushels", "us_corn") and len(got) == 17


WORLD = f"""
                World Corn Supply and Use  1/
                   (Million Metric Tons)
{RULE}
                 :        Supply        :    Use     : Ending
    Region       :----------------------------------- : stocks
                 :Beginning: Production : Exports    :
                 :  stocks :            :            :
{RULE}
                 :            2003/04
                 :
World 2/         :   126.94     624.81       77.04     101.82
  Brazil  3/     :     0.61      42.00        5.00       NA
                 :            2005/06 (Projected)
Argentina     May:     1.00      20.00       13.00       0.90
              Jun:     1.10      20.50       13.50       0.95
South Africa     :
            May  :     2.00                              2.50
            Sept :     2.10       8.00        1.00       2.60
Mexico           :     3.00      21.00        0.01       3.20
{RULE}
Note: World 9/   :     9.00       9.00        9.00       9.00
"""


def test_world_text_reports(spark):
    from cuvee.sources import text_reports as t

    fewer = WORLD.replace("World Corn", "World Rice").replace("Exports", "Shipped")
    bare = f"World Corn Supply and Use\n{RULE}\nBeginning, exports, stocks\n{RULE}\nWorld 1 2 3 4\n{RULE}\n"
    files = spark.createDataFrame([("r", day("2005-06-01"), WORLD + TEXT), ("s", day("2005-06-01"), fewer + WORLD.replace("World Corn", "World Tea")), ("t", None, bare), ("u", None, None), ("v", None, "")], "release_id string, report_month date, text string")
    four, spec = ["beginning_stocks", "production", "exports", "ending_stocks"], "slug string, pattern string, place int, region string, commodity string, columns array<string>, skip boolean"
    specs = spark.createDataFrame([("world_corn", "World Corn", 1, "world", "corn", four, None), ("world_rice", "World Rice", 2, "world", "rice", four, False), ("us_corn", "U.S. Corn", 3, "united_states", "corn", None, None)], spec)
    sections = spark.createDataFrame([("corn", "corn")], "alias string, slug string")
    all_ = t.cells(files, specs, sections).collect()
    assert sum(r.table_slug == "us_corn" for r in all_) == 17 and {r.release_id for r in all_} == {"r"}
    got = {}
    for r in all_:
        if r.table_slug == "world_corn":
            got.setdefault((r.region, r.marketing_year, r.year_status, r.forecast_month), {})[r.raw_attribute] = r.value
            assert r.raw_unit == "Million Metric Tons" and r.commodity == "corn"
    row = lambda *v: {a: x for a, x in zip(four, v, strict=True) if x != "-"}
    assert got == {
        ("world", "2003/04", "actual", ""): row(126.94, 624.81, 77.04, 101.82), ("brazil", "2003/04", "actual", ""): row(0.61, 42.0, 5.0, None),
        ("argentina", "2005/06", "projection", "May"): row(1.0, 20.0, 13.0, 0.9), ("argentina", "2005/06", "projection", "Jun"): row(1.1, 20.5, 13.5, 0.95),
        ("south_africa", "2005/06", "projection", "May"): row(2.0, "-", "-", 2.5), ("south_africa", "2005/06", "projection", "Sep"): row(2.1, 8.0, 1.0, 2.6),
        ("mexico", "2005/06", "projection", "Jun"): row(3.0, 21.0, 0.01, 3.2),
    }
    assert {tuple(r) for r in t.structure_errors(files, specs).collect()} == {("s", "world_rice", "header lacks expor"), ("t", "world_corn", "other number of columns")}
    assert [tuple(r) for r in t.unknown_tables(files, specs).collect()] == [("s", "World Tea Supply and Use 1/")]


def test_landed_files(spark, tmp_path):
    import hashlib
    import zipfile

    from cuvee.sources.landed import damaged, texts

    (tmp_path / "a.txt").write_bytes(b"good \xff end")
    (tmp_path / "empty.txt").write_bytes(b"")
    (tmp_path / "bad.zip").write_bytes(b"no archive")
    for name, members in (("b.zip", {"x.csv": "1", "Y.TXT": "in zip", "z.txt": "later"}), ("c.zip", {"x.csv": "1"})):
        with zipfile.ZipFile(tmp_path / name, "w") as z:
            for m, c in members.items():
                z.writestr(m, c)
    got = {r.path.rpartition("/")[2]: r.text for r in texts(spark, f"file://{tmp_path}").collect()}
    assert got == {"a.txt": "good \ufffd end", "bad.zip": None, "b.zip": "in zip", "c.zip": None}
    path, sha = f"file:{tmp_path}/", lambda b: hashlib.sha256(b).hexdigest()
    manifest = spark.createDataFrame([(path + "a.txt", sha(b"good \xff end")), (path + "empty.txt", sha(b"")), (path + "c.zip", sha(b"x")), (path + "gone.txt", sha(b""))], "path string, sha256 string")
    assert {tuple(r) for r in damaged(spark, f"file://{tmp_path}", manifest).collect()} == {(path + "c.zip", "changed"), (path + "empty.txt", "missing"), (path + "gone.txt", "missing")}


def test_stream_ingests_each_file_once(spark, tmp_path):
    from cuvee.streaming.ingest import ingest

    land = tmp_path / "land"
    base = f"file://{tmp_path}"
    spark.range(5).coalesce(1).write.parquet(f"{base}/land")
    for want in (5, 5, 12):
        if want == 12:
            spark.range(7).coalesce(1).write.mode("append").parquet(f"{base}/land")
        ingest(spark, str(land), "id long", f"{base}/table", f"{base}/checkpoint")
        assert spark.read.schema("id long").parquet(f"{base}/table").count() == want


def test_t_tail():
    from cuvee.operators.stats import t_tail

    # closed forms: one degree of freedom is Cauchy, two are algebraic
    for t in (0.1, 0.7, 2.0, 12.7, 80.0):
        assert t_tail(t, 1) == pytest.approx(1 - 2 * math.atan(t) / math.pi, rel=1e-9)
        assert t_tail(t, 2) == pytest.approx(1 - t / math.sqrt(2 + t * t), rel=1e-7)
    assert t_tail(1.96, 100_000) == pytest.approx(0.05, abs=1e-4) and t_tail(0.0, 5) == 1.0


def test_workbook_sheets(spark):
    from cuvee.sources import workbook as w

    names = spark.createDataFrame([("Exports", "exports"), ("Ending Stocks", "ending_stocks")], "alias string, slug string")
    corn = spark.createDataFrame([("Exports 1/", "1,200", "NA"), ("Unknown", "1", "2"), ("Ending stocks", "5", "6.5")], "item string, `72/73` string, `99/00` string")
    got = {(r.attribute, r.marketing_year): r.value for r in w.attributes_by_row(corn, "item", names, "corn").collect()}
    assert got == {("exports", "2072/73"): 1200.0, ("ending_stocks", "2072/73"): 5.0, ("ending_stocks", "1999/00"): 6.5}
    soy = spark.createDataFrame([("1999", 7.0), ("note", 8.0)], "year string, exports double")
    assert [tuple(r) for r in w.years_by_row(soy, "year", names, "soybeans").collect()] == [("soybeans", "exports", "1999/00", 7.0)]


def test_update_run(spark, tmp_path):
    from cuvee.operators import store
    from cuvee.schemas import OBSERVATION
    from cuvee.streaming.update import run

    base = f"file://{tmp_path}"

    def land(release, version, value):
        row = {f.name: "x" for f in OBSERVATION if f.dataType.simpleString() == "string"} | {"release_id": release, "report_month": day("2026-05-01"), "value": value, "parsed_at": None, "fetched_at": None}
        d = spark.createDataFrame([tuple(row[n] for n in OBSERVATION.names)], OBSERVATION)
        d = d.select("*", F.lit(version).alias("version"), F.lit("2026-05-12").cast("timestamp").alias("release_datetime"), F.lit("xml").alias("format_era"))
        d.coalesce(1).write.mode("append").parquet(f"{base}/landing")

    go = lambda: run(spark, f"{base}/landing", f"{base}/store", f"{base}/checkpoint")
    land("r1", 1, 1.0)
    assert go() == 1 and go() == 0
    land("r1-v2", 2, 2.0)
    land("r1", 1, 3.0)
    assert go() == 1
    rel = {r.release_id: r.is_latest for r in store.current(spark, f"{base}/store/releases").collect()}
    assert rel == {"r1": False, "r1-v2": True}
    assert {(r.release_id, r.value) for r in store.current(spark, f"{base}/store/observations").collect()} == {("r1", 3.0), ("r1-v2", 2.0)}
    land("r2", 1, 4.0)
    assert go() == 1  # what earlier runs loaded stays
    assert {r.release_id for r in store.current(spark, f"{base}/store/observations").collect()} == {"r1", "r1-v2", "r2"}
    assert store.current(spark, f"{base}/store/releases").count() == 3


def test_report_run(spark, tmp_path):
    """Catalog to store: one release by XML, one by archived text, one broken; a corrected file replaces its release."""
    import zipfile

    from cuvee.operators import store
    from cuvee.sources import catalog
    from cuvee.streaming import reports

    base = f"file://{tmp_path}"
    entry = lambda i, t, *f: {"id": i, "title": "T", "release_datetime": t, "files": [f"https://host/{x}" for x in f]}
    found = [entry("1", "2026-05-12T12:00:00+0000", "rep0526.xml", "rep0526.txt"), entry("2", "2005-06-10T12:00:00+0000", "rep0605.zip"), entry("3", "2026-04-10T12:00:00+0000", "rep0426.xml"), entry("4", "2005-05-10T12:00:00+0000", "rep0505.zip")]
    (tmp_path / "page.json").write_text(json.dumps({"pager": {"current_page": 0, "items_per_page": 9, "total_pages": 1, "total_results": 4}, "results": found}))
    rel = catalog.releases(catalog.read_pages(spark, f"{base}/page.json")).cache()
    plan = catalog.archive_plan(rel, r"rep\d{4}").cache()
    target = {r.release_id: r.target for r in plan.where("ext <> 'txt'").collect()}

    def put(release, content, name=None):
        path = tmp_path / "archive" / target[release]
        path = path.with_name(name or path.name)
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content)

    def packed(member, text):
        import io

        z = io.BytesIO()
        with zipfile.ZipFile(z, "w") as out:
            out.writestr(member, text)
        return z.getvalue()

    xml, text = "report-2026-05-12", "report-2005-06-10"
    put(xml, XML.encode())
    put(xml, TEXT.encode(), "report-2026-05-12.txt")
    put(text, packed("a.txt", WORLD + TEXT))
    put("report-2026-04-10", b"<broken")
    put("report-2005-05-10", packed("a.csv", ""))
    lists = lambda *p: spark.createDataFrame(list(p), "alias string, slug string")
    tables = "slug string, pattern string, place int, region string, commodity string"
    four = ["beginning_stocks", "production", "exports", "ending_stocks"]
    registry = reports.Registry(
        spark.createDataFrame([("us_corn", "Feed Grain", 1, "united_states", "corn")], tables),
        spark.createDataFrame([("world_corn", "World Corn", 1, "world", "corn", four), ("us_corn", "U.S. Corn", 2, "united_states", "corn", None)], f"{tables}, columns array<string>"),
        lists(("corn", "corn")),
        lists(("Exports", "exports"), ("Beginning stocks", "beginning_stocks"), ("Yield", "yield"), ("Yield per harvested acre", "yield"), ("production", "production"), ("ending stocks", "ending_stocks")),
        lists(("Corn", "corn")),
        lists(("Million Bushels", "million_bushels")),
    )
    go = lambda **k: reports.run(spark, f"{base}/archive", rel, plan, registry, f"{base}/store", f"{base}/checkpoint", **k)
    with pytest.raises(Exception, match="us_corn"):
        go(priority=["us_corn"])
    assert go() == 1 and go() == 0
    obs = store.current(spark, f"{base}/store/observations")
    got = {(r.release_id, r.table_slug, r.region, r.attribute, r.marketing_year, r.forecast_month): (r.value, r.unit, r.source_format, str(r.report_month)) for r in obs.collect()}
    assert got[(xml, "us_corn", "united_states", "exports", "2025/26", "Jun")] == (1200.0, "million_bushels", "xml", "2026-05-01")
    assert got[(text, "world_corn", "argentina", "exports", "2005/06", "May")] == (13.0, None, "txt", "2005-06-01")
    assert got[(text, "us_corn", "united_states", "beginning_stocks", "2003/04", "")] == (1087.0, "million_bushels", "txt", "2005-06-01")
    assert {k[0] for k in got} == {xml, text}
    bad = {(r.release_id, r.table_slug, r.raw_label, r.kind) for r in store.current(spark, f"{base}/store/unmapped").collect()}
    assert bad == {
        ("report-2026-04-10", None, "not XML", "structure"), ("report-2005-05-10", None, "no text in archive", "structure"), (text, "us_corn", "CCC inventory", "attribute"),
        (text, "us_corn", "Avg. price ($/bu)", "attribute"), (text, "world_corn", "Million Metric Tons", "unit"),
    }
    assert reports.top_unmapped(store.current(spark, f"{base}/store/unmapped"), 1).first().n == 1
    latest = {r.release_id: r.is_latest for r in store.current(spark, f"{base}/store/releases").collect()}
    assert latest[xml] and latest[text] and len(latest) == 4
    with pytest.raises(ValueError, match="'corn' means 2"):
        reports.Registry(*[registry.xml_tables] * 3, registry.attributes, lists(("Corn", "corn"), ("CORN", "maize")), registry.units).checked()


def test_queries_match_their_sql(spark):
    """A few queries end to end against DuckDB on the smallest tables."""
    import os

    import duckdb

    from cuvee.plans import registry

    d = "/root/testdata/sf0.001"
    if not os.path.isdir(d):
        pytest.skip("no test tables here")
    con = duckdb.connect()
    for t in ("region", "nation", "supplier", "part", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    for name in ("revisions", "final_values", "qa_all_whitelisted", "upsert_merge"):
        df = registry.QUERIES[name](spark, d)
        cols = sorted(df.columns)
        want = con.execute(f"SELECT {', '.join(cols)} FROM ({registry.ORACLE[name]})").fetchall()
        assert sorted(map(repr, (tuple(r[c] for c in cols) for r in df.collect()))) == sorted(map(repr, want)), name
    assert registry.entry(spark, d).count() > 0


def test_scanned_tokens_and_ranges(spark):
    from cuvee.functions import labels as l

    one = lambda f, *xs: [r.v for r in spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, s string").select("i", f(F.col("s")).alias("v")).orderBy("i").collect()]
    assert one(l.scanned_value, "1g", "q5", "{2", "7?", "1T", "8,8O0", "So", "1|A", "$5") == [19.0, 95.0, 12.0, 77.0, None, 8800.0, None, 114.0, None]
    assert one(l.clean_number, ".90-1.10", "-5 - 10", "2.20 - 2.30", "106.2 *", "1,233.20 2/", "-.5", "1-2-3") == [1.0, 2.5, pytest.approx(2.25), 106.2, 1233.2, -0.5, None]
    assert one(l.unit_label, "million_bushels", "head_of_cattle", None) == ["mil bu", "head of cattle", ""] and one(l.pretty, "use_total") == ["Use total"]
    assert one(l.month_rank, "May", "Apr", "x") == [0, 11, 12] and one(l.attribute_rank, "farm_price", "x") == [19, 20] and one(l.region_rank, "world", "united_states", "x") == [1, 0, 9]
    prices = spark.createDataFrame([("farm_price", None), ("x", "usd_per_cwt"), ("x", None)], "a string, u string")
    assert [r.v for r in prices.select(l.is_price(F.col("a"), F.col("u")).alias("v")).collect()] == [True, True, False]


def test_tolerance_columns_and_titles(spark):
    import datetime

    from cuvee.sources import pages

    text = "CORN\n: Million bushels\nProduction : 7656 8500 +300 to -300\nExports : 1865 1900 t/-22 22\nImports : 5 6 7 8 21/=-21"
    d = spark.createDataFrame([("r", datetime.date(1985, 6, 1), 1, "us_corn", text)], "release_id string, report_month date, page_no int, table_slug string, text string")
    got = sorted((r.raw_attribute, r.value) for r in pages.cells(d).collect())
    assert got == [("exports", 1865.0), ("exports", 1900.0), ("imports", 5.0), ("imports", 6.0), ("imports", 7.0), ("imports", 8.0), ("production", 7656.0), ("production", 8500.0)]
    titled = spark.createDataFrame([(1, "x U.S. Feed Gra1ns and C0rn Supply"), (2, "U S Soybeans and Products"), (3, "y" * 400 + " U.S. Feed Grains and Corn"), (4, None)], "page_no int, text string")
    assert {(r.page_no, r.table_slug) for r in pages.located(titled).collect()} == {(1, "us_corn"), (2, "us_soybeans")}


def test_published_versions(spark, tmp_path):
    """Readers see the greatest complete version; older ones beyond the last few go."""
    from cuvee.operators import store

    path = f"file://{tmp_path}/t"
    with pytest.raises(FileNotFoundError):
        store.current(spark, path)
    for n in range(1, 6):
        assert store.publish(spark.range(n), path) == n
        (tmp_path / "t" / "_building-left-by-a-lost-job").mkdir(exist_ok=True)
        assert store.current(spark, path).count() == n
    assert sorted(p.name for p in (tmp_path / "t").glob("v-*")) == ["v-00000003", "v-00000004", "v-00000005"]


def test_report_and_config(spark, tmp_path):
    from cuvee.operators import report, store
    from cuvee.operators.quality import Verified
    from cuvee.schemas import EXCEPTION
    from cuvee.sources import config

    base = f"file://{tmp_path}"
    rows = [("r", "t", "c", "warn", "x", 1.0, 2.0), ("r", "t", "c", "fail", "x", 3.0, None), ("r", "t", "c", "fail", "x", None, 9.0), ("s", "", "d", "whitelisted", "y, \"z\"", None, None)]
    findings = spark.createDataFrame(rows, EXCEPTION)
    counts = report.report(findings, f"{base}/qa")
    assert counts == {"warn": 1, "fail": 2, "whitelisted": 1} and report.exit_code(counts) == 1 and report.exit_code({"warn": 3}) == 0
    kept = {r.release_id: (r.severity, r.observed, r.expected) for r in store.current(spark, f"{base}/qa/qa_exceptions").collect()}
    assert kept == {"r": ("fail", None, 9.0), "s": ("whitelisted", None, None)}
    assert spark.read.csv(f"{base}/qa/qa_report", header=True).count() == 4
    assert report.report(findings.limit(0), f"{base}/qa") == {} and store.current(spark, f"{base}/qa/qa_exceptions").count() == 0  # a full refresh
    assert {tuple(r) for r in report.summary(findings).collect()} == {("c", "warn", 1), ("c", "fail", 2), ("d", "whitelisted", 1)}

    (tmp_path / "w.yaml").write_text("whitelist:\n  - check_name: coverage\n    release_id: r1\n    reason: >\n      a notice\n  - check_name: mom_continuity\n    detail_contains: 'farm: price'\n")
    assert config.whitelist(spark, f"{base}/w.yaml") == [Verified("coverage", "r1"), Verified("mom_continuity", detail_contains="farm: price")]
    assert config.whitelist(spark, f"{base}/none.yaml") == []
    (tmp_path / "a.yaml").write_text("attributes:\n  exports:\n    aliases: [Exports, 'Total exports']\n  seed:\n")
    assert {tuple(r) for r in config.aliases(spark, f"{base}/a.yaml", "attributes").collect()} == {("exports", "exports"), ("Exports", "exports"), ("Total exports", "exports"), ("seed", "seed")}


VINTAGE = {"report_month": day("2026-05-01"), "table_slug": "us_corn", "region": "us", "commodity": "corn", "attribute": "exports", "marketing_year": "2025/26", "forecast_month": "May"}


def _batch(spark, *rows):
    """Observations and releases of (release, version, values)."""
    obs = [(r, VINTAGE["report_month"], VINTAGE["table_slug"], "us", "corn", "exports", "2025/26", "May", float(k), v) for r, _, values in rows for k, v in enumerate(values)]
    d = spark.createDataFrame(obs, "release_id string, report_month date, table_slug string, region string, commodity string, attribute string, marketing_year string, forecast_month string, k double, value double")
    d = d.withColumn("region", F.concat("region", F.col("k").cast("string"))).drop("k")
    rel = spark.createDataFrame([(r, VINTAGE["report_month"], n) for r, n, _ in rows], "release_id string, report_month date, version int")
    return d, rel


def test_update_is_one_transaction(spark, tmp_path):
    """A run that dies before any step publishes nothing; run again, it ends as if it had not died."""
    from cuvee.operators import store, versions
    from cuvee.streaming.update import load

    folder = f"file://{tmp_path}/s"
    load(spark, folder, *_batch(spark, ("r1", 1, [1.0, 2.0])), applied=("s", 0))
    state = lambda: {n: sorted(map(repr, store.current(spark, f"{folder}/{n}").collect())) for n in ("observations", "releases", "failures", "exports/observations", "exports/observations_all_versions", "exports/us_corn_balance", "exports/releases")}
    before, steps = state(), []
    batch = _batch(spark, ("r1-v2", 2, [3.0]), ("a*b/ü=%", 1, [4.0]))
    check = lambda o, r: o.limit(0).select("release_id", "table_slug")
    load(spark, f"{folder}-probe", *batch, check=check, on_step=steps.append)
    assert steps[-1] == "publish" and {"write observations", "write releases", "write failures", "check", "write exports/observations"} <= set(steps)
    for dies in range(len(steps)):
        left = [dies]

        def die(name, left=left):
            left[0] -= 1
            if left[0] < 0:
                raise RuntimeError(name)

        with pytest.raises(RuntimeError, match=steps[dies]):
            load(spark, folder, *batch, check=check, applied=("s", 1), on_step=die)
        assert state() == before and versions.version(spark, folder).number == 1
    assert load(spark, folder, *batch, check=check, applied=("s", 1)) == 2
    after = state()
    assert load(spark, folder, *_batch(spark, ("r1", 1, [9.0])), applied=("s", 1)) is None and state() == after  # a replay
    assert [(r.release_id, r.is_latest) for r in store.current(spark, f"{folder}/releases").orderBy("release_id").collect()] == [("a*b/ü=%", False), ("r1", False), ("r1-v2", True)]
    assert {r.release_id for r in store.current(spark, f"{folder}/exports/observations").collect()} == {"r1-v2"}
    assert store.current(spark, f"{folder}/observations").count() == 4


def test_update_writes_what_the_batch_touches(spark, tmp_path):
    from cuvee.operators import store, versions
    from cuvee.streaming.update import load

    folder = f"file://{tmp_path}/s"
    files = lambda: {p for p in (tmp_path / "s" / "data" / "observations").rglob("*.parquet")}
    load(spark, folder, *_batch(spark, *[(f"r{k}", 1, [float(k)] * 20) for k in range(12)]))
    first, old = files(), store.current(spark, f"{folder}/observations")
    assert len(first) >= 12
    load(spark, folder, *_batch(spark, ("r3", 1, [5.0]), ("new", 1, [6.0])))
    assert {p.parent.name for p in files() - first} == {"store_part=r3", "store_part=new"}
    now = {(r.release_id, r.value) for r in store.current(spark, f"{folder}/observations").collect()}
    assert now == {(f"r{k}", float(k)) for k in range(12) if k != 3} | {("r3", 5.0), ("new", 6.0)}
    assert old.where("release_id = 'r3'").count() == 20  # a reader keeps its version
    read = store.current(spark, f"{folder}/observations").inputFiles()
    assert len([f for f in read if any(str(p) in f for p in first)]) == 11  # the others lie where they lay
    assert versions.vacuum(spark, folder, keep=1, older_than=-10) > 0
    assert {(r.release_id, r.value) for r in store.current(spark, f"{folder}/observations").collect()} == now
    assert versions.vacuum(spark, folder, keep=1, older_than=-10) == 0


def test_changes_that_meet_are_done_again(spark, tmp_path):
    from cuvee.operators import versions

    folder = f"file://{tmp_path}/s"
    row = lambda k, v: spark.createDataFrame([(k, v)], "release_id string, v int")
    tries = []

    def work(change):
        tries.append(change.base.number)
        change.merge("t", row("a", 1), "release_id", lambda old, new: old.unionByName(new))
        if len(tries) == 1:  # another run is faster
            versions.transact(spark, folder, lambda c: c.merge("t", row("a", 2), "release_id", lambda old, new: old.unionByName(new)) and None)

    assert versions.transact(spark, folder, work) == 2 and tries == [0, 1]
    assert sorted(r.v for r in versions.read(spark, folder, versions.version(spark, folder), "t").collect()) == [1, 2]
    with pytest.raises(versions.Conflict):
        versions._claim(spark, folder, versions.Version(2))
    with pytest.raises(FileNotFoundError):
        versions.read(spark, folder, versions.Version(), "none")


def test_failed_and_refused_releases(spark, tmp_path):
    from cuvee.operators import store, versions
    from cuvee.streaming.update import load

    folder = f"file://{tmp_path}/s"
    obs, rel = _batch(spark, ("good", 1, [1.0, 2.0]), ("bad", 1, [3.0]))
    load(spark, folder, obs, rel, failures=spark.createDataFrame([("bad", "not XML")], "release_id string, problem string"))
    ids = lambda t: {r.release_id for r in store.current(spark, f"{folder}/{t}").collect()}
    assert ids("observations") == ids("releases") == {"good"} and ids("failures") == {"bad"}
    finding = lambda o, r: o.where("value > 50").select("release_id", "table_slug", F.lit("c").alias("check_name"), F.lit("fail").alias("severity"), F.lit("x").alias("detail"), F.col("value").alias("observed"), F.lit(None).cast("double").alias("expected"))
    with pytest.raises(versions.Unchecked, match="c of bad"):
        load(spark, folder, *_batch(spark, ("bad", 1, [99.0])), check=finding, refuse=True)
    assert ids("observations") == {"good"}
    load(spark, folder, *_batch(spark, ("bad", 1, [99.0])), check=finding)  # findings alone don't stop a run
    assert ids("observations") == {"good", "bad"} and ids("failures") == set() and ids("qa_exceptions") == ids("exports/qa_exceptions") == {"bad"}
    late, early = (_batch(spark, ("good", 1, [v]))[0].withColumn("loaded_at", F.lit(t)) for v, t in ((8.0, 2), (7.0, 1)))
    load(spark, folder, late.unionByName(early), rel.where("release_id = 'good'"))  # in order of date, not of rows
    assert [r.value for r in store.current(spark, f"{folder}/observations").where("release_id = 'good'").collect()] == [8.0]


def test_sections_and_units_of_pages(spark):
    """Headings are a table's own, also with marks behind them; a remark changes neither section nor unit."""
    from cuvee.sources.pages import cells

    corn = "FEED GRAINS\n: Million metric tons\nProduction : 1 2 3 4\nCORN2/\n: Million bushels\nExports : 5 6 7 8\nTons of meal\nImports : 1 1 1 1\nThousand sacks of million\nSeed : 2 2 2 2"
    soy = "Production : 1 2 3 4\nCORN equivalent of meal : 5\nExports : 5 6 7 8\nShort tons\nImports : 3 3 3 3"
    d = spark.createDataFrame([("r", day("1985-06-01"), 1, "us_corn", corn), ("r", day("1985-06-01"), 2, "us_soybeans", soy)], "release_id string, report_month date, page_no int, table_slug string, text string")
    got = {(r.page_no, r.raw_attribute): (r.commodity, r.unit) for r in cells(d, units=["short tons"]).where("forecast_month = 'Jun'").collect()}
    assert got[(1, "production")] == ("feed_grains", "Million Metric Tons") and got[(1, "exports")] == got[(1, "imports")] == ("corn", "Million Bushels")
    assert got[(1, "seed")] == ("corn", None)  # a unit that nobody knows is none
    assert got[(2, "exports")] == ("soybeans", None) and got[(2, "imports")] == ("soybeans", "Thousand Short Tons")


def test_scan_run(spark, tmp_path):
    """Page texts in two batches: a release is read again whole; what is off is mended or listed; another reader fills in."""
    from cuvee.operators import store
    from cuvee.sources.pages import ROW_LABELS
    from cuvee.streaming import reports, scans

    base = f"file://{tmp_path}"
    page = "U.S. Feed Grains and Corn\nCORN\n: Million bushels\nPlanted : 80 80 80\nBeginning stocks : 100 100 100\nProduction : {p} 900 900\nImports : 10 10 10\nSupply, total : 1010 1010 1010\nDomestic : 600 600 600\n{e}Use, total : 900 900 900\nEnding stocks : 110 110 110\n"
    soy = "U.S. Soybeans and Products\n: Million bushels\nExports : 20 20 20\n"
    one = lambda *names: spark.createDataFrame([(n, n) for n in names], "alias string, slug string")
    none = spark.createDataFrame([], "slug string, pattern string, place int, region string, commodity string")
    registry = reports.Registry(none, none, one("corn"), one(*dict(ROW_LABELS).values()), one("corn", "soybeans"), spark.createDataFrame([("Million Bushels", "million_bushels")], "alias string, slug string"))
    month = day("1985-05-01")
    releases = spark.createDataFrame([("r1", month, 1, "pdf_scan"), ("r2", month, 1, "pdf_scan"), ("r3", month, 1, "xml")], "release_id string, report_month date, version int, format_era string")

    def put(folder, name, text):
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / name).write_text(text)

    go = lambda folder, **k: scans.run(spark, f"{base}/{folder}", releases, registry, f"{base}/store", f"{base}/c-{folder}", **k)
    put("texts", "r1-p03.txt", page.format(p=900, e=""))
    put("texts", "r3-p01.txt", page.format(p=900, e=""))
    put("texts", "notes.txt", "no page")
    assert go("texts") == 1 and go("texts") == 0
    rows = lambda: {(r.release_id, r.commodity, r.marketing_year, r.attribute): (r.value, r.qa_status, r.unit) for r in store.current(spark, f"{base}/store/observations").collect()}
    first = rows()
    assert {k[0] for k in first} == {"r1"} and first[("r1", "corn", "1983/84", "exports")] == (300.0, "corrected", "million_bushels")
    assert first[("r1", "corn", "1983/84", "area_planted")][1] == "ok" and store.current(spark, f"{base}/store/worklist").count() == 0
    put("texts", "r1-p04.txt", soy)
    put("texts", "r1-p03.txt.part", "half")
    assert go("texts") == 1
    second = rows()
    assert {k: v for k, v in second.items() if k[1] == "corn"} == first and second[("r1", "soybeans", "1985/86", "exports")] == (20.0, "ok", "million_bushels")
    put("again", "r1-p03.txt", page.format(p=1, e=""))
    put("again", "r2-p03.txt", page.format(p=950, e="Exports : 300 300 300\n"))
    assert go("again", first_reader=False, missing_only=True) == 1
    third = rows()
    assert {k: v for k, v in third.items() if k[0] == "r1"} == second  # it had rows
    assert third[("r2", "corn", "1983/84", "production")][1] == "quarantined" and third[("r2", "corn", "1984/85", "production")][:2] == (900.0, "ok")
    assert third[("r2", "corn", "1983/84", "area_planted")][1] == "warn"
    todo = {(r.marketing_year, r.attribute) for r in store.current(spark, f"{base}/store/worklist").collect()}
    assert todo == {("1983/84", a) for a in ("beginning_stocks", "production", "imports", "supply_total")}


def test_repair_and_arbitration_show_every_status(spark):
    from cuvee.plans import registry

    d = "/root/testdata/sf0.001"
    for name in ("identity_repair", "reader_arbitration"):
        assert {r.qa_status for r in registry.QUERIES[name](spark, d).select("qa_status").distinct().collect()} == {"ok", "corrected", "warn", "quarantined"}, name
