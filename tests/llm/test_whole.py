"""Tests of findings: results that were less than the whole."""

import re

import pytest
from pyspark.sql import functions as F


# ---------------------------------------------------------------- 8, pipeline
def linked(docs, percent):
    """By document with words, the smallest document that links of ``percent`` reach."""
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))} for i, t in docs if (w := re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower()))}
    least = {i: i for i in sets}
    pairs = [(x, y) for x in sets for y in sets if x < y and 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y])]
    for _ in sets:
        for x, y in pairs:
            least[x] = least[y] = min(least[x], least[y])
    return least


@pytest.mark.parametrize("bucket", [32, 1])
def test_near_duplicates_at_80(spark, corpus, bucket, monkeypatch):
    import corpus_pipeline
    from cuvee.llm import minhash_dedup as m

    monkeypatch.setattr(m, "BUCKET", bucket)
    base = [f"v{k}" for k in range(160)]
    near = {k: " ".join("x" if i in range(20, 20 + 30 * k, 30) else w for i, w in enumerate(base)) for k in (3, 4)}
    docs = [(i, t) for i, t in corpus if t is None or t.isascii()] + [(900, " ".join(base)), (901, near[3]), (910, " ".join(base[::-1])), (911, " ".join(near[4].split()[::-1]))]
    want = linked(docs, 80)
    assert want[901] == 900 and want[911] == 911 and want != linked(docs, 85)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in m.near_duplicates(d, 80).collect()}
    assert got == {i: want.get(i, i) for i, _ in docs}
    left = corpus_pipeline.near_dedup(spark, d, "", percent=80)
    assert {r.doc_id for r in left.collect()} == {i for i, c in got.items() if i == c}


def test_bands_miss_nothing():
    from cuvee.llm import minhash_dedup as m

    assert m.banded(85) == (32, 6)
    for percent in (70, 80, 85, 95):
        bands, rows = m.banded(percent)
        assert bands * rows <= m.HASHES and (1 - (percent / 100) ** rows) ** bands <= m.MISS
    with pytest.raises(ValueError):
        m.banded(1)


# ---------------------------------------------------------------- 6
def test_warc_repeated_rows(spark, tmp_path):
    """A record for every row, as in the query's SQL."""
    import duckdb

    from cuvee.llm import queries, warc
    from cuvee.llm.oracle import OP6

    rows = [(1, "u1", "a"), (1, "u1", "a"), (1, "u2", "a"), (2, "v", "b"), (2, "w", "a"), (2, "v", "b"), (3, None, None), (3, "x", "")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    key = lambda r: tuple((v is None, v) for v in r)
    want = duckdb.sql(f"WITH pages AS (FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')) {OP6.strip().replace('WITH p AS', ', p AS', 1)}").fetchall()
    got = list(map(tuple, queries.op6_warc(spark, str(tmp_path)).collect()))
    assert len(got) == len(rows) and sorted(got, key=key) == sorted(want, key=key)
    # no url is lost, null page ids included, and record ids are unique and the referred ones exist
    pages = spark.createDataFrame([*rows, (None, "n1", "c"), (None, "n2", "c"), (None, "n2", "c"), (None, "n3", "a")], "page_id long, url string, html string")
    warc.write_archive(pages, f"file://{tmp_path}/a", repeats=True)
    back = warc.read_archive(spark, f"file://{tmp_path}/a").collect()
    assert sorted((r.page_id or 0, r.url or "") for r in back) == sorted((r.page_id or 0, r.url or "") for r in pages.collect())
    raws = [raw.decode() for f in (tmp_path / "a").glob("part-*.warc.gz") for raw in warc._records(f.open("rb"))]
    ids = [re.search(r"WARC-Record-ID: (\S+)", x)[1] for x in raws]
    assert len(set(ids)) == len(ids) == 12 and {m[1] for x in raws if (m := re.search(r"WARC-Refers-To: (\S+)", x))} <= set(ids)


# ---------------------------------------------------------------- 1
def test_license_stretches():
    """Finds as wide as the density allows, against alignment at every position."""
    import random

    from cuvee.llm.license_scan import COVERAGE, DENSITY, TEMPLATES, Scanner, Template, align, words_of

    mpl, rng = words_of(TEMPLATES["MPL-2.0/header"]), random.Random(4)
    at = mpl.index("2") + 2
    for k in (21, 26):
        found = Scanner().scan(" ".join(["before"] * 9 + mpl[:at] + [f"x{i}" for i in range(k)] + mpl[at:] + ["after"] * 9))[1]
        assert found == [("MPL-2.0/header", 9, 9 + len(mpl) + k, 1.0)]
    for name in ("MPL-2.0/header", "MIT/terms", "Proprietary/line"):
        t, hits = Template(name, TEMPLATES[name]), 0
        n = len(t.words)
        for _ in range(60):
            text = [rng.choice([*t.words, "y"]) for _ in range(rng.randint(0, n))]
            for _ in range(rng.randint(1, 3)):
                cut, gap = rng.randrange(n), rng.randint(0, int(0.7 * n))
                text += [w for w in t.words[:cut] if rng.random() > 0.08] + ["z"] * gap + t.words[cut:] + ["q"] * rng.randint(0, 3)
            want = set()
            for low in range(len(text)):
                pairs = align(t.words, text[low : low + int(n / DENSITY + 1e-9)])
                runs = [(i, j) for i in range(len(pairs)) for j in range(i, len(pairs)) if j + 1 - i >= COVERAGE * n and j + 1 - i >= DENSITY * (pairs[j][1] - pairs[i][1] + 1)]
                if runs:
                    i, j = max(runs, key=lambda r: (r[1] - r[0], -r[0]))
                    want.add((low + pairs[i][1], low + pairs[j][1] + 1, j + 1 - i, (j + 1 - i) / n))
            where = {w: [p for p, x in enumerate(text) if x == w] for w in set(text)}
            got = list(t.finds(text, where))
            assert len(got) == len(set(got)) and set(got) <= want, (name, text)
            assert {f for f in want if not any(g[2] >= f[2] and g[0] < f[1] and f[0] < g[1] for g in got)} == set(), (name, text)
            hits += bool(want)
        assert hits > 20


def test_license_names(spark):
    from cuvee.llm.license_scan import TEMPLATES, Scanner

    s = Scanner(named=True)
    for name, template in TEMPLATES.items():
        assert any(f[0] == name and f[3] == 1.0 for f in s.scan("before " + template + " after")[1]), name
    for text in ("Released under the GNU License", "This work is licensed under the GNU Lesser General Public License, version 3", "Licensed under CC BY-NC-SA 4.0", "This work is licensed under the GNU General Public License, version 1"):
        assert s.scan(text)[1] == [], text
    assert [f[0] for f in s.scan("Released by us under the MIT License")[1]] == ["MIT/line"]


def test_license_expressions_and_denials(spark):
    from cuvee.llm.license_scan import IDENTIFIERS, Scanner, scan

    s = Scanner(named=True, expressions=True)
    names = lambda t: [f[0].removesuffix("/identifier") for f in s.scan(t)[1]]
    head = "SPDX-License-Identifier: "
    assert s.scan(f"{head}MIT OR Apache-2.0")[1] == [("MIT/identifier", 0, 4, 1.0), ("Apache-2.0/identifier", 5, 8, 1.0)]
    for a in IDENTIFIERS:
        for b in IDENTIFIERS:
            if a != b:
                assert names(f"x\n// {head}({a} AND {b}) y") == [a, b], (a, b)
    assert names(f"{head}(GPL-2.0-only WITH Linux-syscall-note OR BSD-3-Clause) AND MIT\n") == ["GPL-2.0", "BSD-3-Clause", "MIT"]
    assert names(f"{head}LGPL-2.1-or-later OR MIT\n{head}ISC or other, MIT") == ["LGPL-2.1", "MIT", "ISC"]
    assert names(f"{head}MIT, Apache-2.0") == ["MIT"] and names(f"{head}CC-BY-NC-SA-4.0 OR MIT") == []
    assert names("Licensed under CC BY 4.0") == ["CC-BY-4.0/short"] and names("Licensed under CC BY-NC 4.0") == ["CC-BY-NC-4.0/line"]
    for text in (
        "This project is not licensed under the terms of the MIT license",
        "not licensed under the Apache License, Version 2.0",
        "It isn't yet released under the MIT License",
        "It isn\u2019t released under the MIT License",
    ):
        assert names(text) == [], text
    for text in ("We did not\nReleased under the MIT License", "Why not? Released under the MIT License", "not here: it is released under the MIT License"):
        assert names(text) == ["MIT/line"], text
    rows = [(1, f"{head}MIT OR ISC", "clash"), (1, f"{head}MIT OR ISC", "clash"), (None, None, "clash"), (3, "", "clash")]
    got = scan(spark.createDataFrame(rows, "doc_id long, text string, licenses string"), named=True, expressions=True).collect()
    assert sorted(len(r.licenses) for r in got) == [0, 0, 2, 2]
