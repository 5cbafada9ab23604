"""What the findings of round 3 would have shown on small tables."""

import datetime as dt

from pyspark.sql import functions as F


def test_p_value_of_a_constant_side(spark):
    """Where all next revisions are equal no residual is left, as the SQL has it."""
    from cuvee.operators import stats

    rows = [("a", float(k), -100.0) for k in range(1, 13)] + [("b", float(k), float(k % 3)) for k in range(1, 13)]
    pairs = spark.createDataFrame(rows, "attribute string, pct double, pct_next double")
    got = {r.attribute: r.p_value for r in stats.momentum_p(pairs).collect()}
    assert got["a"] == 0.0 and 0 < got["b"] < 1


def test_layouts_of_keys_that_make_numbers_of_noughts_and_fives(spark, tmp_path):
    """1500 + 3499 + 1 = 5000: a token keeps a digit, so the reader sees four numbers in every row."""
    from cuvee.plans import registry

    d = f"file://{tmp_path}"
    spark.createDataFrame([(k,) for k in (1, 3497, 3499, 3505, 3999, 4005)], "s_suppkey long").write.parquet(f"{d}/supplier.parquet")
    got = {(r.release_id, r.marketing_year, r.forecast_month): r.value for r in registry.scanned_layouts(spark, d).where("raw_attribute = 'exports'").collect()}
    columns = [("1983/84", ""), ("1984/85", ""), ("1985/86", "May"), ("1985/86", "Jun")]
    assert got == {(f"s{k}", *c): 1500.0 + k + j for k in (1, 3497, 3499, 3505, 3999, 4005) for j, c in enumerate(columns)}


def test_stored_observations_lie_by_place(spark):
    """Queries by cell, chain or series read buckets and don't deal the observations anew."""
    from cuvee.plans import registry

    d = "/root/testdata/sf0.001"
    for name in ("headline_values", "revisions", "forecast_errors", "revision_pairs", "bias_by_month", "momentum_spearman", "identity_repair"):
        plan = registry.QUERIES[name](spark, d)._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" not in plan, name


def test_errors_in_one_pass(spark):
    from cuvee.operators import vintage

    rows = [("s", "2025/26", dt.date(2026, m, 1), v, st) for m, v, st in ((1, 10.0, "projection"), (2, 0.0, "estimate"), (3, 8.0, "actual"))] + [("t", "2025/26", dt.date(2026, 1, 1), 1.0, "actual")]
    cur = spark.createDataFrame(rows, "attribute string, marketing_year string, report_month date, value double, year_status string")
    want = vintage.attach_errors(cur, vintage.finals_of(cur))
    assert sorted(map(tuple, vintage.with_errors(cur).select(want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_a_release_of_many_rows_is_not_one_task(spark):
    """Neither the replaced releases nor the winners deal observations by release."""
    from cuvee.operators import store

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        obs = spark.range(50).select(F.lit("r1").alias("release_id"), F.col("id").cast("double").alias("value"), F.lit(1).alias("seq"))
        rel = spark.createDataFrame([("r1", True), ("r2", False)], "release_id string, is_latest boolean")
        new = store.replace_release(obs.drop("seq"), obs.limit(1), ["release_id", "value"], "seq")
        assert new.count() == 1 and store.observations_latest(obs, rel).count() == 50
        for d in (new, store.observations_latest(obs, rel)):
            assert "SortMergeJoin" not in d._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_many_small_releases_share_files(spark, tmp_path, monkeypatch):
    """Beyond PACKED partitions a table has PACKS parts, in which releases are still replaced, merged and read by name."""
    from cuvee.operators import versions

    monkeypatch.setattr(versions, "PACKED", 5)
    monkeypatch.setattr(versions, "PACKS", 2)
    folder = f"file://{tmp_path}/s"
    rows = lambda **r: spark.createDataFrame(list(r.items()), "release_id string, v int")
    table = lambda parts=None: {r.release_id: r.v for r in versions.read(spark, folder, versions.version(spark, folder), "t", parts=parts).collect()}
    change = lambda f: versions.transact(spark, folder, lambda c: f(c) and None)
    change(lambda c: c.replace("t", rows(a=1, b=2, c=3), "release_id", ["a", "b", "c"]))
    assert len(list((tmp_path / "s" / "data" / "t").glob("*/store_part=*"))) == 3
    change(lambda c: c.replace("t", rows(b=5, d=4, e=6, f=7), "release_id", ["a", "b", "d", "e", "f"]))  # now packed; a goes
    want = {"b": 5, "c": 3, "d": 4, "e": 6, "f": 7}
    assert table() == want and set(versions.version(spark, folder).tables["t"]["parts"]) <= {"~pack-0", "~pack-1"}
    assert table(["c", "f", "none"]) == {"c": 3, "f": 7}
    change(lambda c: c.merge("t", rows(c=10, g=1), "release_id", lambda old, new: old.unionByName(new).groupBy("release_id").agg(F.max("v").cast("int").alias("v"))))
    want |= {"c": 10, "g": 1}
    assert table() == want
    change(lambda c: c.replace("t", rows(d=9), "release_id", ["e"]))  # rows count as named
    want["d"] = 9
    del want["e"]
    assert table() == want
    assert versions.vacuum(spark, folder, keep=1, older_than=-10) > 0 and table() == want


def test_exported_observations_are_not_written_again(spark, tmp_path):
    from cuvee.operators import store
    from cuvee.streaming.update import load

    folder, month = f"file://{tmp_path}/s", dt.date(2026, 5, 1)
    obs = lambda *r: spark.createDataFrame([(i, month, "us_corn", v) for i, v in r], "release_id string, report_month date, table_slug string, value double")
    rel = lambda *r: spark.createDataFrame([(i, month, n) for i, n in r], "release_id string, report_month date, version int")
    seen = lambda: {(r.release_id, r.value) for r in store.current(spark, f"{folder}/exports/observations").collect()}
    load(spark, folder, obs(("a", 1.0)), rel(("a", 1)))
    assert seen() == {("a", 1.0)}
    load(spark, folder, obs(("b", 2.0)), rel(("b", 2)))
    assert seen() == {("b", 2.0)} and not (tmp_path / "s" / "data" / "exports" / "observations").exists()


def test_the_sweeps_are_methods_that_the_jvm_compiles(spark):
    """HotSpot compiles no method of more than 8000 bytes; all turns in one stage are one of 52 thousand."""
    import re

    from cuvee.operators import balance

    rows = spark.createDataFrame([("r", "corn", "imports", 1.0)], "release_id string, commodity string, attribute string, value double")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = spark._jvm.PythonSQLUtils.explainString(balance.repaired(balance.column_groups(rows, ["release_id", "commodity"]))._jdf.queryExecution(), "codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < 8000


def test_groups_of_repeated_attributes(spark):
    """The greatest value counts, a null only where there is no other, and a hole stays an entry."""
    from cuvee.operators import balance

    rows = [("a", "x", 1.0, 2), ("a", "x", 3.0, 1), ("a", "x", None, 3), ("a", "y", None, 1), ("b", "x", float("nan"), 1), ("b", "x", 5.0, 2)]
    d = spark.createDataFrame(rows, "id string, attribute string, value double, seq int")
    got = {r.id: r.vals for r in balance.column_groups(d, ["id"]).collect()}
    assert got["a"] == {"x": 3.0, "y": None} and list(got["b"]) == ["x"] and got["b"]["x"] != got["b"]["x"]
    assert {r.id: r.vals for r in balance.column_groups(d, ["id"], "seq").collect()} == {"a": {"x": None, "y": None}, "b": {"x": 5.0}}


def test_repair_equals_its_sql_on_odd_values(spark):
    """Holes, signed zeros, NaN, infinities, unknown commodities and attributes outside identities."""
    import random

    import duckdb

    from cuvee.operators import balance
    from cuvee.plans import balance_sql

    rng, rows = random.Random(5), []
    numbers = [0.0, -0.0, 1.0, 2.0, 5.0, 7.0, 10.0, 40.0, -3.0, None, float("nan"), float("inf")]
    for k in range(1500):
        most = 9 if k % 3 else 12
        for a in (*balance.MEMBERS, "farm_price"):
            if rng.random() < 0.85:
                rows.append((k, rng.choice(["corn", "soybeans", None]) if k % 50 == 0 else ("corn", "soybeans")[k % 2], a, numbers[rng.randrange(most)]))
    d = spark.createDataFrame(rows, "id int, commodity string, attribute string, value double")
    got = balance.repaired(balance.column_groups(d, ["id", "commodity"])).select("id", "commodity", F.explode("cells").alias("c")).select("id", "commodity", "c.*")
    con = duckdb.connect()
    con.execute("CREATE TABLE d (id INTEGER, commodity VARCHAR, attribute VARCHAR, value DOUBLE)")
    con.executemany("INSERT INTO d VALUES (?, ?, ?, ?)", rows)
    want = con.execute(balance_sql.repair("FROM d", ["id", "commodity"])).fetchall()
    plain = lambda rs: sorted(repr((*r[:3], r[3] + 0.0 if r[3] is not None else None, r[4])) for r in rs)
    assert plain(map(tuple, got.collect())) == plain(want)


def test_checks_stay_with_the_stored_places(spark):
    """The continuity of reprints needs no shuffle of stored observations, and rows of a release don't meet in one task."""
    from cuvee.operators import quality
    from cuvee.plans import registry

    d = "/root/testdata/sf0.001"
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "hashpartitioning" not in plan(registry.qa_continuity(spark, d))
        obs, releases = registry._all(spark, d)
        assert plan(quality.check_coverage(obs, releases, ["us_corn"])).count("HashAggregate") == 4
        # the latest actuals: sorted by chain within buckets, and only chains' last rows beyond
        lines = [line for line in plan(quality.latest_actuals(obs)).splitlines() if "Exchange" in line or "Window [" in line]
        assert [("Exchange" in line) for line in lines] == [False, True, False]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_checks_equal_plain_joins(spark):
    """Repeated rows, nulls in keys and values, several places of a commodity, and releases without rows."""
    import random

    from pyspark.sql import Window

    from cuvee.operators import quality

    rng, rows = random.Random(7), []
    months = [dt.date(2026, m, 1) for m in (1, 2, 3)]
    for _ in range(2500):
        m, label = rng.randrange(3), rng.choice(["Jan", "Feb", "Mar", "", None])
        place = (f"us_{rng.choice('ab')}", rng.choice(["x", "y", None]), "corn")
        rows.append((f"r{m}", months[m], *place, rng.choice(["p", "q"]), "2025/26", rng.choice(["projection", "actual"]), label, rng.choice([None, 1.0, 1.1, 2.0, 3.5])))
    obs = spark.createDataFrame(rows, "release_id string, report_month date, table_slug string, region string, commodity string, attribute string, marketing_year string, year_status string, forecast_month string, value double")
    rel = spark.createDataFrame([("r0", True, "txt"), ("r1", True, "xml"), ("r2", False, "xml"), ("r9", True, "xml")], "release_id string, is_latest boolean, format_era string")
    cur = obs.join(rel.where("is_latest").select("release_id"), "release_id").where("year_status = 'projection'").withColumn("own", F.date_format("report_month", "MMM") == F.col("forecast_month"))
    keys = ["table_slug", "region", "commodity", "attribute", "marketing_year", "forecast_month"]
    prior = cur.where("NOT own").withColumn("month", F.add_months("report_month", -1))
    joined = prior.join(cur.where("own").select(*keys, F.col("report_month").alias("month"), F.col("value").alias("expected")), [*keys, "month"])
    off = "value IS DISTINCT FROM expected AND (value IS NULL OR expected IS NULL OR abs(value - expected) > pow(10, -least(d, e)) * 1.01)"
    joined = joined.withColumns({"d": quality.decimals(F.col("value"), 6), "e": quality.decimals(F.col("expected"), 6)}).where(off)
    got = quality.check_continuity(obs, rel)
    texts = lambda df, *c: sorted(map(repr, map(tuple, df.select(*c).collect())))
    assert got.count() > 20 and texts(got, "release_id", "table_slug", "observed", "expected") == texts(joined, "release_id", "table_slug", "value", "expected")
    w = Window.partitionBy("commodity", "attribute", "marketing_year").orderBy(F.col("report_month").desc(), "release_id", "table_slug", "region", "forecast_month", "value")
    last = obs.where("year_status = 'actual' AND value IS NOT NULL").dropDuplicates(["report_month", "release_id", "table_slug", "region", "attribute", "forecast_month"])
    want = last.withColumn("n", F.row_number().over(w)).where("n = 1").select("commodity", "attribute", "marketing_year", "value")
    assert texts(quality.latest_actuals(last), "commodity", "attribute", "value") == texts(want, "commodity", "attribute", "value")
    found = {(r.release_id, r.detail) for r in quality.check_coverage(obs.where("release_id <> 'r1'"), rel, ["us_a"]).collect()}
    assert found == {("r1", "xml release has no observations"), ("r9", "xml release has no observations")}
