"""The numbered operators against brute force, on texts with nulls, empties, ties, repeats and one very long text."""

import collections
import hashlib
import re
import string

import pytest
from pyspark.sql import functions as F

ASCII = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def clashing(docs):
    """Columns whose names the operators use themselves."""
    return docs.withColumns({c: F.lit("clash") for c in ("n_words", "kept", "score", "ids", "spans", "licenses", "m", "shard")})


# ---------------------------------------------------------------- 1
def test_patience_alignment():
    from cuvee.llm.license_scan import TEMPLATES, Scanner, align

    assert align(list("abcdefg"), list("xabcyefgz")) == [(0, 1), (1, 2), (2, 3), (4, 5), (5, 6), (6, 7)]
    assert align([], ["a"]) == [] and align(["a", "a"], ["a"]) == [(0, 0)]
    s = Scanner()
    text = "Intro words here. " + TEMPLATES["MIT/text"].replace("Software", "Program") + "\nAll rights reserved. All rights reserved. tail"
    n, found = s.scan(text)
    assert [f[0] for f in found] == ["MIT/text", "Proprietary/line", "Proprietary/line"] and found[0][1] == 3 and n == len(re.findall(r"[^\W_]+", text))
    assert s.scan("Released under the GNU License") == (5, [("MIT/line", 0, 5, 0.8)])
    assert s.scan("Released under some other terms entirely")[1] == [] and s.scan("") == (0, [])
    for name, template in TEMPLATES.items():
        assert any(f[0] == name and f[3] == 1.0 for f in s.scan("before " + template + " after")[1]), name


def test_probes_are_exact():
    """A text with the needed coverage always holds a probe."""
    from cuvee.llm.license_scan import TEMPLATES, Template

    for name, text in TEMPLATES.items():
        t = Template(name, text)
        assert sum(w not in t.probes for w in t.words) < t.coverage * len(t.words)


def test_license_scan_rows(spark, documents, empty):
    from cuvee.llm.license_scan import scan

    out = scan(clashing(documents))
    assert out.columns.count("n_words") == 1 and out.count() == documents.count()
    assert scan(empty).count() == 0
    extra = spark.createDataFrame([(1, "Released under the MIT License.")] * 2, "doc_id long, text string")
    assert [r.licenses[0].license for r in scan(extra).collect()] == ["MIT/line"] * 2


# ---------------------------------------------------------------- 2
def rule_truth(t):
    w = words(t)
    seen = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {p for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in (t or "").split("\n") if words(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w))


def test_quality_rules(spark, documents, corpus, empty):
    from cuvee.llm.quality_rules import apply_rules, judged

    got = {r.doc_id: r for r in judged(clashing(documents)).collect()}
    for i, t in corpus:
        g = got[i]
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words, g.base_failed) == rule_truth(t), i
        assert not (g.base_failed and g.kept)
    kept = apply_rules(documents)
    assert kept.columns == documents.columns and {r.doc_id for r in kept.collect()} == {i for i, g in got.items() if g.kept}
    assert judged(empty).count() == 0 and apply_rules(empty).count() == 0
    lines = spark.createDataFrame([(1, "a b\na b\n\n\n a b\nc")], "doc_id long, text string")
    assert judged(lines).first().n_dup_lines == 1
    assert "Python" not in documents.sparkSession._jvm.PythonSQLUtils.explainString(judged(documents)._jdf.queryExecution(), "simple")


# ---------------------------------------------------------------- 3
def test_quality_classifier(spark, empty):
    from cuvee.llm import quality_classifier as qc

    rng = __import__("random").Random(1)
    good = lambda: " ".join(rng.choice(["river", "stone", "walks", "under", "morning", "the", "and", "light"]) for _ in range(80))
    bad = lambda: " ".join(rng.choice(["$$$", "BUY", "### now", "%%%", "click", "!!1"]) for _ in range(80))
    rows = [(i, good() if i % 3 else bad()) for i in range(600)] + [(1000, None), (1001, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(600)] + [(5000, None)], "doc_id long, quality int")
    model = qc.train(docs, labels)
    out = {r.doc_id: r for r in qc.score(docs, model).collect()}
    held = [i for i in range(600) if __import__("zlib").crc32(str(i).encode()) % 5 == 0]
    assert sum(out[i].predicted == int(i % 3 > 0) for i in held) / len(held) > 0.97
    assert out[1000].score == out[1001].score and all(0 <= r.score <= 1 for r in out.values())
    assert qc.score(empty, model).count() == 0
    assert qc.train(empty, labels.limit(0)) == 0.5 and {r.score for r in qc.score(docs, 0.5).collect()} == {0.5}
    assert qc.train(docs, labels.where("quality = 1")) == 1.0


# ---------------------------------------------------------------- 4
def substring_truth(corpus):
    first = {}
    for i, t in sorted(corpus):
        w = words(t)
        for k in range(len(w) - 12):
            first.setdefault(tuple(w[k : k + 13]), i)
    out = {}
    for i, t in corpus:
        w = words(t)
        gone = {p for k in range(len(w) - 12) if first[tuple(w[k : k + 13])] < i for p in range(k, k + 13)}
        out[i] = (len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone))
    return out


@pytest.mark.parametrize("limits", [{}, {"shard": 5, "hot": 2}])
def test_substring_dedup(documents, corpus, empty, limits):
    from cuvee.llm.substring_dedup import removed

    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in removed(clashing(documents), **limits).collect()}
    assert got == substring_truth(corpus)
    assert removed(empty, **limits).count() == 0


def test_substring_dedup_repeated_rows(spark, documents):
    from cuvee.llm.substring_dedup import removed

    twice = documents.where("doc_id IN (40, 41, 42)").unionAll(documents.where("doc_id IN (41, 42)"))
    got = collections.Counter((r.doc_id, r.n_removed) for r in removed(twice).collect())
    assert set(got.values()) == {1, 2} and len(got) == 3
    nulls = spark.createDataFrame([(None, "a " * 20), (None, "a " * 20), (3, "a " * 20)], "doc_id long, text string")
    assert {r.n_removed for r in removed(nulls).collect()} == {0}


def test_fm_index():
    import numpy as np

    from cuvee.llm.fm_index import FMIndex

    rng = np.random.default_rng(0)
    for _ in range(40):
        seqs = [rng.integers(1, 4, rng.integers(1, 20)) for _ in range(rng.integers(1, 12))]
        own = rng.integers(0, 6, len(seqs))
        begin, flat = np.cumsum([0, *map(len, seqs)]), np.concatenate(seqs)
        f = FMIndex(flat, begin, own, 5)
        p = [(i, j, n) for i, s in enumerate(seqs) for j in range(len(s)) for n in (1, 3, 5) if j + n <= len(s)]
        got = f.statistics(flat, np.array([begin[i] + j for i, j, _ in p]), np.array([n for *_, n in p]), np.array([own[i] for i, *_ in p]))
        for (i, j, n), g in zip(p, got, strict=True):
            held = lambda pat, i=i: any(own[k] < own[i] and any(s[q : q + len(pat)].tolist() == pat for q in range(len(s))) for k, s in enumerate(seqs))
            assert g == max((m for m in range(1, n + 1) if held(seqs[i][j + n - m : j + n].tolist())), default=0)


def test_least_of_ranges():
    import numpy as np

    from cuvee.llm.fm_index import Least

    rng = np.random.default_rng(1)
    for n in (1, 5, 16, 17, 300):
        v = rng.integers(0, 50, n)
        low, high = np.array([(a, b) for a in range(n) for b in range(a + 1, n + 1)]).T
        assert Least(v).of(low, high).tolist() == [v[a:b].min() for a, b in zip(low, high, strict=True)]


# ---------------------------------------------------------------- 5
def test_byte_bpe(spark, documents, corpus, empty):
    import numpy as np
    import public_tokenizers as p
    import tiktoken

    from cuvee.llm import bpe

    path = p.path("byte_bpe_50k.tiktoken")
    t = tiktoken.Encoding("own", pat_str=p.PATTERN, mergeable_ranks=dict(bpe.read_ranks(path)), special_tokens={})
    odd = [(900, "a" * 700), (901, "\x00ab\x00 <|endoftext|> 'll"), (902, "%" * 333 + "  \n\n x")]
    docs = clashing(documents).select("doc_id", "text", "ids").unionByName(spark.createDataFrame([(*o, "c") for o in odd], "doc_id long, text string, ids string"))
    got = {r.doc_id: r for r in bpe.encode(docs, path, p.PATTERN).collect()}
    for i, x in [*corpus, *odd]:
        want = t.encode_ordinary(x or "")
        assert np.frombuffer(got[i].ids, "<u4").tolist() == want and got[i].n_tokens == len(want) and bytes(got[i].decoded) == (x or "").encode(), i
    assert bpe.encode(empty, path, p.PATTERN).count() == 0


# ---------------------------------------------------------------- 6
def test_warc(spark, tmp_path):
    from cuvee.llm import warc

    html = ["<p>a</p>", "", None, "<p>a</p>", "b" * 50000, "<p>a</p>", "é😀", "", "b" * 50000]
    rows = [(i, f"http://h/{i} x\r\n" if i % 2 else None, h) for i, h in enumerate(html)] + [(3, "http://again", "<p>a</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("lead", F.lit("clash"))
    folders = [f"file://{tmp_path}/{k}" for k in "ab"]
    manifests = [sorted(map(tuple, warc.write_archive(pages, f, roll_bytes=200).collect())) for f in folders]
    assert manifests[0] == manifests[1] and len(manifests[0]) > 2
    assert not [p for p in (tmp_path / "a").iterdir() if p.name.startswith("_part")]
    last = {}
    for i, h in enumerate(html):
        last[h or ""] = i
    got = {r.page_id: r for r in warc.read_archive(spark, folders[0]).collect()}
    assert len(got) == len(html) == warc.read_archive(spark, folders[0]).count()
    for i, h in enumerate(html):
        data, lead = (h or "").encode(), last[h or ""]
        g = got[i]
        assert (g.payload_bytes, g.payload_digest) == (len(data), warc.base32_sha1(data))
        assert (g.record_type, g.refers_to) == (("response", None) if lead == i else ("revisit", lead))
        assert g.record_type == "revisit" or bytes(g.payload) == data
    # a file that no manifest lists isn't read
    (tmp_path / "a" / "part-999999-00000.warc.gz").write_bytes(b"left by a lost task")
    assert warc.read_archive(spark, folders[0]).count() == len(html)
    assert warc.round_trip(pages.limit(0), f"file://{tmp_path}/none").count() == 0


def test_warc_digest_is_checked():
    from cuvee.llm import warc

    raw = warc.record(1, "http://x", b"payload", None, False)
    assert warc.parse(raw)[3] == 7
    with pytest.raises(ValueError):
        warc.parse(raw.replace(b"payload\r\n", b"pAyload\r\n"))


# ---------------------------------------------------------------- 7
def test_chat_format(spark):
    from cuvee.llm import chat

    rows = [
        (1, 0, "user", "hi <|end|> \\l \\"), (1, 1, "user", None), (1, 2, "assistant", "<|more|>😀 x"), (1, 3, "assistant", ""), (1, 4, "user", "bye"),
        (2, 1, "assistant", "</s>[INST] ok [/INST]"), (2, 0, "sys|tem<", "s"), (2, 0, "sys|tem<", "s"), (3, 0, None, None), (None, 5, "assistant", "n"),
    ]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit("clash"))
    made = chat.formatted(d)
    assert "Python" not in spark._jvm.PythonSQLUtils.explainString(made._jdf.queryExecution(), "simple")
    got = {r.conv_id: r for r in chat.read_back(made).collect()}
    out = {r.conv_id: r for r in made.collect()}
    for conv in (1, 2, 3, None):
        turns = sorted(((t, r or "", x or "") for c, t, r, x in rows if c == conv), key=lambda v: v)
        assert [(t.role, t.text) for t in got[conv].turns] == [v[1:] for v in turns], conv
        assert got[conv].loss_text == "".join(x for _, r, x in turns if r == "assistant")
        assert got[conv].formatted_chars == len(out[conv].formatted)
    assert out[1].formatted.count("<|role:") == 3
    assert chat.read_back(chat.formatted(d.limit(0))).count() == 0


# ---------------------------------------------------------------- 8
def near_truth(corpus, percent=85):
    sets = {}
    for i, t in corpus:
        w = words((t or "").translate(ASCII))
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))) if w else frozenset()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and sets[y]:
                both = len(sets[x] & sets[y])
                if 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both):
                    a, b = find(x), find(y)
                    parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


@pytest.mark.parametrize("bucket", [32, 1])
def test_near_duplicates(documents, corpus, empty, bucket, monkeypatch):
    from cuvee.llm import minhash_dedup as m

    monkeypatch.setattr(m, "BUCKET", bucket)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in m.near_duplicates(clashing(documents)).collect()}
    assert got == near_truth(corpus)
    assert {r.doc_id for r in m.deduplicated(documents).collect()} == {i for i, g in got.items() if g[2]}
    assert m.near_duplicates(empty).count() == 0


def test_large_bucket_of_a_chain(spark, monkeypatch):
    """A chain whose ends aren't linked to the bucket's smallest member is still one component."""
    from cuvee.llm import minhash_dedup as m

    monkeypatch.setattr(m, "BUCKET", 1)
    monkeypatch.setattr(m, "BLOCK", 4)
    base = [f"w{k}" for k in range(200)]
    chain = [(k, " ".join(base[3 * k : 3 * k + 120])) for k in range(10)]
    rows = [(100 - i, t) for i, t in chain] + [(500, None), (None, chain[0][1])]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in m.near_duplicates(d).collect()}
    want = near_truth([(100 - i, t) for i, t in chain] + [(500, None)])
    assert {k: v for k, v in got.items() if k is not None} == want and got[None] == (116, None, True)
    assert len({v[1] for k, v in want.items() if k < 500}) == 1


def test_bit_count_estimate(spark):
    import numpy as np

    from cuvee.llm import minhash_dedup as m

    s, rng = m.Sketcher(), np.random.default_rng(5)
    pool = rng.integers(0, 1 << 63, 1000).astype(np.uint64)
    (_, a), (_, b) = s.sketch(np.sort(pool[:900])), s.sketch(np.sort(pool[100:]))
    same = spark.createDataFrame([(a.tolist(), b.tolist())], "a array<long>, b array<long>").select(m.matches(F.col("a"), F.col("b")).alias("n")).first().n
    lanes = lambda x: [(int(v) >> k) & 3 for v in x.astype(np.uint64) for k in range(0, 64, 2)]
    assert same == sum(p == q for p, q in zip(lanes(a), lanes(b), strict=True))
    assert abs((same / m.HASHES - 0.25) / 0.75 - 0.8) < 0.15


# ---------------------------------------------------------------- 9
def contamination_truth(docs, items):
    w9 = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(ASCII))
    out = {}
    for i, t in docs:
        w, hit, names = w9(t), set(), set()
        for name, x in items:
            iw = w9(x)
            n = min(13, len(iw))
            for k in range(len(iw) - n + 1 if iw else 0):
                for p in range(len(w) - n + 1):
                    if w[p : p + n] == iw[k : k + n]:
                        hit |= set(range(p, p + n))
                        names.add("" if name is None else str(name))
        out[i] = (len(w), len(hit), len(names), sorted(names), bool(hit) and 20 * len(hit) >= len(w))
    return out


@pytest.mark.parametrize("large", [False, True])
def test_decontamination(spark, documents, corpus, empty, large, monkeypatch):
    from cuvee.llm import decontaminate as dc

    if large:
        monkeypatch.setattr(dc, "MAX_LITERALS", 1)
        monkeypatch.setattr(dc, "MAX_BROADCAST", 1)
    source = words(dict(corpus)[41])
    items = [(1, " ".join(source[30:75]).upper()), (2, "Wabc, the... of!"), (3, None), (10, " ".join(source[50:62])), (None, "the of and"), (7, "--"), (8, " ".join(source[30:75]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = [*corpus, (700, "The of, AND x"), (701, "...the OF and...the of and")]
    d = documents.select("doc_id", "text", F.lit("clash").alias("word"))
    d = d.unionByName(spark.createDataFrame([(*x, "c") for x in docs[-2:]], "doc_id long, text string, word string"))
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r["items"], r.contaminated) for r in dc.contamination(d, bench).collect()}
    want = contamination_truth(docs, items)
    assert got == want and sum(v[4] for v in want.values()) > 2
    assert {r.doc_id for r in dc.clean_documents(d, bench).collect()} == {i for i, v in want.items() if not v[4]}
    assert dc.contamination(empty, bench).count() == 0
    assert all(r.n_hit == 0 for r in dc.contamination(d, bench.limit(0)).collect())


def test_decontamination_of_a_large_benchmark(spark):
    """60,000 anchor words: neither counting nor searching shuffles the words of the documents."""
    from cuvee.llm import decontaminate as dc

    n = 60_000
    assert n > dc.MAX_LITERALS
    bench = spark.range(n).select(F.col("id").alias("item_id"), F.format_string("a%dx b%dx c%dx", "id", "id", "id").alias("text"))
    phrase = lambda k, w="abc": " ".join(f"{c}{k}x" for c in w)
    texts = {k: f"Some {phrase(k)}, words {phrase(n - 1 - k).upper()} and {phrase(k + 1000, 'ab')} of none {phrase(k)}" for k in range(50)}
    texts |= {100: None, 101: "", 102: phrase(5, "acb"), 103: " ".join(phrase(k) for k in range(3000))}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r["items"]) for r in dc.contamination(docs, bench).collect()}
    want = {k: (16, 9, 2, sorted([str(k), str(n - 1 - k)])) for k in range(50)}
    want |= {100: (0, 0, 0, []), 101: (0, 0, 0, []), 102: (3, 0, 0, []), 103: (9000, 9000, 3000, sorted(map(str, range(3000))))}
    assert got == want

    plan = lambda d: d._jdf.queryExecution().executedPlan().toString().splitlines()
    source = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    names = bench.select(F.explode(F.split("text", " ")).alias("word"))
    found = dc.written(names.where("word LIKE 'a%'"), "names")
    assert not any("Exchange" in x for x in plan(dc._candidates(source, found, 13)))
    lines = plan(dc.corpus_counts(source, dc.written(names, "names")))
    at = next(k for k, x in enumerate(lines) if "Generate explode" in x)
    above = [x for x in lines[:at] if "Exchange" in x or "partial_count" in x]
    assert "partial_count" in above[-1] and "Exchange" in above[-2]


def test_word_filter_holds_every_word(spark, monkeypatch):
    """No word is lost, also where the filter is too small for its words; few others pass where it isn't."""
    from cuvee.llm import decontaminate as dc

    names = spark.range(3000).select(F.concat(F.lit("w"), "id").alias("word"))
    other = spark.range(3000).select(F.concat(F.lit("x"), "id").alias("word"))
    for most, passed in ((1 << 25, 0.05), (1 << 10, 1.0)):
        monkeypatch.setattr(dc, "MAX_FILTER_BITS", most)
        known, bits = dc.word_filter(names)
        held = lambda d, known=known, bits=bits: d.where(dc._possible(F.col("word"), known, bits)).count()
        assert bits <= most and held(names) == 3000 and held(other) <= passed * 3000


# ---------------------------------------------------------------- 10
def pii_truth(t):
    from cuvee.llm.pii import luhn

    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", m.start(), m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 16 <= len(d := re.sub(r"\D", "", m[0])) <= 19 and luhn(d)]
    return out + [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(re.sub(r"\D", "", m[0])) <= 15]


def test_pii_base_spans():
    from cuvee.llm import pii

    rng = __import__("random").Random(9)
    for _ in range(20000):
        t = "".join(rng.choice("a1.@+- (%0987") for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(t) == pii_truth(t), t


def test_pii_linear_time():
    import time

    from cuvee.llm import pii

    began = time.time()
    pii.base_spans("a" * 300_000 + " x@y " + "1" * 300_000 + "." + "+1(" * 50_000)
    assert time.time() - began < 5


def test_pii(spark, documents, corpus, empty):
    from cuvee.llm import pii

    model = pii.train()
    got = {r.doc_id: r for r in pii.find(clashing(documents), model).collect()}
    for i, t in corpus:
        base = pii_truth(t or "")
        assert got[i].base_spans == ",".join(f"{k}:{a}:{b}" for k, a, b in base), i
        assert set(filter(None, got[i].base_spans.split(","))) <= set(filter(None, got[i].spans.split(",")))
        assert [got[i][f"n_{k}"] for k in pii.KINDS] == [sum(b[0] == k for b in base) for k in pii.KINDS]
    last = got[corpus[-1][0]].redacted
    assert last.startswith("Mail [EMAIL] or call [PHONE] now, card [CARD] at [IP]. ")
    assert pii.spans("write to joe (at) foo (dot) com", model)[1] == [("email", 9, 31)]
    assert pii.spans("on 2020-01-02 version 3 of isbn 978-0-1234-5678-9", model)[1] == []
    assert pii.find(empty, model).count() == 0


def test_boosted_trees_hold_out():
    import numpy as np

    from cuvee.llm import pii

    rng = np.random.default_rng(99)
    rows = [pii._example(rng) for _ in range(1000)]
    m = pii.train()
    y = np.array([r[4] for r in rows])
    chosen = m.probability(np.array([pii.features(*r[:4]) for r in rows])) >= m.threshold
    assert y[chosen].mean() > 0.97 and chosen[y == 1].mean() > 0.95


# ---------------------------------------------------------------- pipeline
def test_pipeline(spark, documents, corpus, tmp_path):
    import public_tokenizers as p
    import tiktoken

    import corpus_pipeline
    from cuvee.llm import bpe, pii
    from cuvee.llm.quality_rules import judged

    documents.withColumn("_hit", F.lit("clash")).write.parquet(f"{tmp_path}/documents.parquet")
    items = [(1, " ".join(words(dict(corpus)[42])[30:75]))]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontamination", "personal_data", "tokens"]
    kept = {r.doc_id for r in judged(documents).where("kept").collect()}
    docs = [(i, t) for i, t in corpus if i in kept]
    near = near_truth(docs, 80)
    docs = [(i, t) for i, t in docs if near[i][2]]
    bad = contamination_truth(docs, items)
    docs = [(i, t) for i, t in docs if not bad[i][4]]
    model = pii.train()
    enc = tiktoken.Encoding("own", pat_str=p.PATTERN, mergeable_ranks=dict(bpe.read_ranks(p.path("byte_bpe_50k.tiktoken"))), special_tokens={})
    want = {}
    for i, t in docs:
        clean = pii.redacted(t, pii.spans(t, model)[1])
        want[i] = (len(clean), hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in enc.encode_ordinary(clean))).hexdigest(), True)
    got = {r.doc_id: (r.n_chars, r.ids_sha256, r.round_trip) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert got == want and 5 < len(got) < len(corpus)
