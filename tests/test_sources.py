"""Catalog source, archive sink, files of table lists and settings, sections, pivots, the QA job."""

import datetime as dt
import json
import math

import pytest
from pyspark.sql import functions as F


def day(s):
    return dt.date.fromisoformat(s)


def land(folder, pages):
    folder.mkdir(exist_ok=True)
    for k, ids in enumerate(pages):
        rows = [{"id": i, "title": "T", "release_datetime": f"2026-01-{int(i):02d}T12:00:00+0000", "files": [f"https://h/rep{i}.xml"]} for i in ids]
        (folder / f"p{k}.json").write_text(json.dumps({"pager": {"current_page": k, "total_pages": len(pages)}, "results": rows}))


def test_catalog_source(spark, tmp_path):
    """Pages are read in parallel; a poll gives new ids only; a failing page is tried again and then an error."""
    from cuvee.sources import catalog
    from cuvee.sources.catalog_source import CatalogSource, CatalogStream, fetched

    spark.dataSource.register(CatalogSource)
    folder = tmp_path / "c"
    land(folder, [["5", "4"], ["4", "3"], ["2"]])
    path = f"file://{folder}/p{{page}}.json"
    read = spark.read.format("release_catalog").option("path", path).option("wait", 0).load()
    assert read.rdd.getNumPartitions() == 3 and sorted(r.id for r in read.collect()) == ["2", "3", "4", "4", "5"]
    rel = catalog.entry_releases(read).collect()
    assert sorted(r.release_id for r in rel) == [f"report-2026-01-0{k}" for k in (2, 3, 4, 5)] and {r.format_era for r in rel} == {"xml"}

    def poll():
        stream = spark.readStream.format("release_catalog").option("path", path).option("wait", 0).load()
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start().awaitTermination()
        return sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect())

    assert poll() == ["2", "3", "4", "5"] == poll()
    land(folder, [["7", "6"], ["5", "4"], ["3", "2"]])
    assert poll() == ["2", "3", "4", "5", "6", "7"]
    stream = CatalogStream({"path": path, "wait": "0"})
    rows, end = stream.read({"ids": ["2", "3", "4", "5"]})
    assert [r[2] for r in rows] == ["7", "6"] == [r[2] for r in stream.readBetweenOffsets({"ids": ["2", "3", "4", "5"]}, end)]
    assert list(stream.read(end)[0]) == [] and stream.initialOffset() == {"ids": []}
    (folder / "p2.json").write_text("{cut off")
    with pytest.raises(Exception, match="Expecting|JSON"):
        spark.read.format("release_catalog").option("path", path).option("wait", 0).option("retries", 1).load().collect()
    tries = []
    with pytest.raises(OSError):
        fetched(f"{tmp_path}/none-{{page}}", 0, 2, 0) or tries
    with pytest.raises(Exception, match="page"):
        CatalogStream({"path": "x"})


def test_archive_sink(spark, tmp_path):
    """Each file once, whole, never written again; a repeated or killed run leaves the manifest whole."""
    from cuvee.operators import versions
    from cuvee.sources import landed

    folder, store = f"file://{tmp_path}/a", f"file://{tmp_path}/s"
    rows = [("r1", "txt", "u1", "2026-01/r1.txt", True, b"one"), ("r1", "txt", "u2", "2026-01/r1__x.txt", False, b""), ("r2", "xml", "u3", "2026-02/r2.xml", True, b"two"), ("r3", "xml", "u4", "2026-02/r3.xml", True, None)]
    files = spark.createDataFrame(rows, "release_id string, ext string, url string, target string, is_canonical boolean, content binary")
    twice = files.unionByName(files).repartition(4)  # as two attempts of each task
    assert landed.archive(twice, folder, store) == 3
    lies = sorted(str(p.relative_to(tmp_path / "a")) for p in (tmp_path / "a").rglob("*") if p.is_file())
    assert lies == ["2026-01/r1.txt", "2026-01/r1__x.txt", "2026-02/r2.xml"]
    manifest = lambda: {r.path.rsplit("/", 1)[1]: (r.sha256, r.bytes, r.canonical) for r in versions.read(spark, store, versions.version(spark, store), "manifest").collect()}
    first = manifest()
    assert first["r1.txt"][1:] == (3, True) and first["r1__x.txt"][1:] == (0, False)
    other = files.withColumn("content", F.encode(F.lit("changed"), "UTF-8"))
    assert landed.archive(other.where("release_id <> 'r3'"), folder, store) == 0 and manifest() == first
    assert (tmp_path / "a/2026-01/r1.txt").read_bytes() == b"one"
    landed.archived(other.where("release_id = 'r3'"), folder).collect()  # a run that died before its manifest
    (tmp_path / "a/2026-02/.half").write_bytes(b"ha")
    assert landed.archive(files.where("release_id = 'r3'").withColumn("content", F.encode(F.lit("late"), "UTF-8")), folder, store) == 1
    assert manifest()["r3.xml"][1] == 7 and len(manifest()) == 4
    assert landed.archive(files.limit(0), folder, store) == 0
    listed = versions.read(spark, store, versions.version(spark, store), "manifest").withColumn("path", F.regexp_replace("path", "^file://", "file:"))
    assert landed.damaged(spark, folder, listed).collect() == [] or {r.kind for r in landed.damaged(spark, folder, listed).collect()} == {"missing"}  # empty files aren't listed


TABLES = r"""
tables:
  world_grains:
    title_patterns: ["World and U\\.\\s?S\\. Supply"]
    region: world
    sr_hint: sr08
    txt_skip: true
  world_grains_cont:
    title_patterns: ["World and U\\.\\s?S\\. Supply", "^GRAINS$"]
    region: world
    sr_hint: sr09
    matrices: [{}, {commodity: cotton, unit: Bales}]
  us_corn:
    title_patterns: ["Feed Grain and Corn"]
    matrices:
      - {commodity: feed_grains, quantity_unit_must_contain: Metric, must_not_contain_attribute: Farm Price}
      - {commodity: corn, must_contain_attribute: Farm Price, fallback_units: {area: Acres, yield: Bushels, qty: Million Bushels}}
    default_quantity_unit: Million Bushels
    txt_sections: {"LONG GRAIN": long, CORN: corn}
    txt_columns: [production, exports]
    skip: false
"""


def test_table_lists(spark, tmp_path):
    """A parser runs from files alone; two tables of one title are told apart by the report's number."""
    from cuvee.sources import config, xml_report

    (tmp_path / "config").mkdir()
    (tmp_path / "config/tables.yaml").write_text(TABLES)
    (tmp_path / "config/pipeline.yaml").write_text("paths: {raw: data/raw, db: /abs/x}\ncatalog: {base_url: https://h, identifier: i, sleep_seconds: 2}\neras: {xml_start: '2010-07-01', txt_start: '1995-01-01'}\npriority_tables: [us_corn]\n")
    specs = config.tables(spark, f"file://{tmp_path}/config/tables.yaml")
    by = {r.slug: r for r in specs.collect()}
    assert [r.place for r in specs.orderBy("place").collect()] == [0, 1, 2, 3] and by["world_grains"].txt_skip and by["us_corn"].columns == ["production", "exports"]
    m = by["us_corn"].matrices
    assert (m[0].unit_has, m[0].has_not, m[1].has, m[1].area, m[1].quantity) == ("Metric", "Farm Price", "Farm Price", "Acres", "Million Bushels") and by["us_corn"].region == "united_states"
    titles = spark.createDataFrame([("World  and U.S. Supply", "sr09"), ("World and U.S. Supply", "sr08"), ("World and U.S. Supply", None), ("grains", None), ("other", "sr09"), (None, None)], "title string, hint string")
    got = {(r.title, r.hint): r.slug for r in config.resolved(titles, specs).collect()}
    assert got == {("World  and U.S. Supply", "sr09"): "world_grains_cont", ("World and U.S. Supply", "sr08"): "world_grains", ("World and U.S. Supply", None): "world_grains", ("grains", None): "world_grains_cont", ("other", "sr09"): None, (None, None): None}
    report = '<R><Report Name="{n}" sub_report_title="World and U.S. Supply"><matrix1><g attribute1="Exports"><h market_year1="2025/26 Proj." forecast_month1="June" commodity1="Corn"><Cell cell_value1="1"/></h></g></matrix1></Report></R>'
    files = spark.createDataFrame([(n, report.format(n=n).encode()) for n in ("sr08", "sr09")], "path string, content binary")
    cells = xml_report.cells(xml_report.raw_cells(files), specs).collect()
    assert {(r.file, r.table_slug, r.region) for r in cells} == {("sr08", "world_grains", "world"), ("sr09", "world_grains_cont", "world")}
    assert {tuple(r) for r in config.sections(spark, f"file://{tmp_path}/config/tables.yaml").collect()} == {("us_corn", "LONG GRAIN", "long"), ("us_corn", "CORN", "corn")}
    s = config.settings(spark, f"file://{tmp_path}/config/pipeline.yaml")
    assert s.paths == {"raw": f"file://{tmp_path}/data/raw", "db": "/abs/x"} and (s.base_url, s.sleep_seconds, s.xml_start, s.priority_tables) == ("https://h", 2.0, "2010-07-01", ["us_corn"])
    (tmp_path / "config/bad.yaml").write_text("tables: {x: {region: world}}")
    with pytest.raises(ValueError, match="x has no title_patterns"):
        config.tables(spark, f"file://{tmp_path}/config/bad.yaml")


def test_sections(spark):
    from cuvee.sources import sections

    docs = [
        ("a", '{"sections": [{"commodity_heading": "CORN", "rows": [{"label": "x", "values": [1, null, 2.5, 4]}, {"label": "y", "values": []}]}, {"commodity_heading": "C", "rows": null}]}'),
        ("b", '{"sections": [{"commodity_heading": "CORN", "rows": [{"label": "x", "val'), ("c", None), ("d", "[]"), ("e", '{"sections": []}'), ("f", '{"sections": [{"rows": [{"values": ["no number"]}]}]}'),
    ]
    d = spark.createDataFrame([(i, day("1985-05-01"), t) for i, t in docs], "release_id string, report_month date, document string")
    got = [(r.release_id, r.section, r.row, r.place, r.value, r.marketing_year, r.forecast_month) for r in sections.cells(d).orderBy("place").collect()]
    assert got == [("a", 0, 0, 0, 1.0, "1983/84", ""), ("a", 0, 0, 1, None, "1984/85", ""), ("a", 0, 0, 2, 2.5, "1985/86", "May")]  # a fourth column is beyond the page
    assert {r.release_id for r in sections.malformed(d).collect()} == {"b", "c", "d", "f"}
    assert sections.cells(d.limit(0)).count() == sections.malformed(d.limit(0)).count() == 0


def test_pivots(spark):
    from cuvee.operators.stats import decade, pivoted, unpivoted

    d = spark.createDataFrame([("a", "May-Jun", 1.0), ("a", "May-Jun", 0.0), ("a", "Jun-Jul", None), ("b", "Jul", 1.0), ("c", None, 1.0), ("c", "x", None)], "attribute string, pair string, v double")
    wide = pivoted(d, ["attribute"], "pair", "v", 0.5)
    assert wide.columns == ["attribute", "Jul", "May-Jun"]  # columns without a value are none
    assert {tuple(r) for r in wide.collect()} == {("a", None, 0.0), ("b", 0.5, None), ("c", None, None)}
    assert {tuple(r) for r in unpivoted(wide, ["attribute"], "pair", "v").collect()} == {("a", "May-Jun", 0.0), ("b", "Jul", 0.5)}
    assert unpivoted(pivoted(d.limit(0), ["attribute"], "pair", "v"), ["attribute"], "pair", "v").columns == ["attribute", "pair", "v"]
    with pytest.raises(ValueError, match="more than 1"):
        pivoted(d, ["attribute"], "pair", "v", most=1)
    assert [r.d for r in spark.createDataFrame([(1999,), (2000,), (None,)], "y int").select(decade(F.col("y")).alias("d")).collect()] == ["1990s", "2000s", None]


def test_p_values_are_native(spark):
    """The expressions against the plain functions."""
    from cuvee.operators import stats

    ts = [(t, df) for t in (0.0, 0.1, 0.7, 2.0, 12.7) for df in (1, 2, 3, 4, 7, 10, 51, 300)]
    d = spark.createDataFrame(ts, "t double, df int").select("t", "df", stats.t_tail_of(F.col("t"), F.col("df")).alias("p"))
    assert "Python" not in spark._jvm.PythonSQLUtils.explainString(d._jdf.queryExecution(), "simple")
    for r in d.collect():
        assert r.p == pytest.approx(stats.t_tail(r.t, r.df), abs=1e-12), r
    big = spark.createDataFrame([(1.96, 5000)], "t double, df int").select(stats.t_tail_of(F.col("t"), F.col("df")).alias("p")).first().p
    assert big == pytest.approx(stats.t_tail(1.96, 5000), abs=1e-7)
    xs = spark.createDataFrame([(x,) for x in (0.0, 1e-9, 0.3, 1.0, 2.5, 4.0, 5.9, 7.0)], "x double").select("x", stats.erfc(F.col("x")).alias("v")).collect()
    assert all(r.v == pytest.approx(math.erfc(r.x), abs=2e-15) for r in xs)
    ways = {r.n: r.ways for r in stats.signed_rank_ways(spark).collect()}
    assert ways[3][:7] == [1, 1, 1, 2, 1, 1, 1] and sum(ways[10]) == 2**10 and len(ways) == stats.EXACT
    cases = [(6, 3.0, 0.0), (50, 600.0, 0.0), (60, 800.0, 0.0), (12, 10.5, 6.0), (4, 1.0, 0.0)]
    w = spark.createDataFrame(cases, "n int, w double, ties double").join(stats.signed_rank_ways(spark), "n", "left")
    for r in w.select("n", "w", "ties", stats._signed_rank_p(F.col("n"), F.col("w"), F.col("ties"), F.col("ways")).alias("p")).collect():
        want = stats.wilcoxon_p(r.n, r.w, r.ties)
        assert r.p is None if want is None else r.p == pytest.approx(want, rel=1e-9), r
    slopes = spark.createDataFrame([(10, 1.0), (2, 0.5), (10, None), (12, 0.25)], "n int, r2 double").select("r2", stats.slope_p(F.col("n"), F.col("r2")).alias("p")).collect()
    assert [r.p for r in slopes[:3]] == [0.0, None, None] and slopes[3].p == pytest.approx(stats.t_tail(math.sqrt(0.25 * 10 / 0.75), 10), abs=1e-12)


def test_qa_job(spark, tmp_path):
    """Findings are published in place of the last ones; the exit code says whether any fails."""
    from cuvee import jobs
    from cuvee.operators import store
    from cuvee.streaming.update import load

    folder = f"file://{tmp_path}/s"
    cell = lambda table, attribute, v: ("r1", day("2005-05-01"), table, "us", "corn", attribute, "2004/05", "actual", "", v, "ok")
    rows = [cell(t, a, v) for t in ("us_corn", "us_other") for a, v in (("beginning_stocks", 1.0), ("production", 2.0), ("imports", 0.0), ("supply_total", 30.0))]
    obs = spark.createDataFrame(rows, "release_id string, report_month date, table_slug string, region string, commodity string, attribute string, marketing_year string, year_status string, forecast_month string, value double, qa_status string")
    load(spark, folder, obs, spark.createDataFrame([("r1", day("2005-05-01"), 1, "txt")], "release_id string, report_month date, version int, format_era string"))
    assert jobs.qa(spark, folder, ["us_corn"]) == {"fail": 1}
    assert jobs.qa(spark, folder, ["us_corn"], []) == {"fail": 2}
    assert jobs.qa(spark, folder, ["us_corn"], ["us_wheat"]) == {} and store.current(spark, f"{folder}/exports/qa_exceptions").count() == 0
    (tmp_path / "config").mkdir()
    (tmp_path / "config/p.yaml").write_text("priority_tables: [us_corn]")
    args = ["qa", folder, "--settings", f"file://{tmp_path}/config/p.yaml", "--csv", f"file://{tmp_path}/csv"]
    assert jobs.main(args) == 1 and jobs.main([*args, "--tables", "us_wheat"]) == 0 and jobs.main([*args, "--all-tables"]) == 1
    assert spark.read.csv(f"file://{tmp_path}/csv", header=True).count() == 2
    (tmp_path / "w.yaml").write_text("whitelist: [{check_name: supply_identity}]")
    assert jobs.main([*args, "--whitelist", f"file://{tmp_path}/w.yaml"]) == 0


def test_small_labels(spark):
    from cuvee.functions.labels import dataset_label
    from cuvee.streaming.reports import top_unmapped

    d = spark.createDataFrame([("world_us_grains", "total_grains"), ("us_corn", "corn"), ("world_corn", "corn")], "s string, c string")
    assert [r.v for r in d.select(dataset_label(F.col("s"), F.col("c")).alias("v")).collect()] == ["World - Total Grains (world & US)", "US - Corn", "World - Corn"]
    un = spark.createDataFrame([("r1", "t", "x", "unit"), ("r2", "t", "x", "unit"), ("r2", "t", "y", "unit")], "release_id string, table_slug string, raw_label string, kind string")
    rel = spark.createDataFrame([("r1", "txt"), ("r2", "xml")], "release_id string, format_era string")
    assert [tuple(r) for r in top_unmapped(un, 5, rel, "txt").collect()] == [("unit", "x", 1)] and top_unmapped(un).first().n == 2
