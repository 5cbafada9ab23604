"""Operators 11 to 13 against brute force, the library and SQL."""

import hashlib
import random
import zlib

import duckdb
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from cuvee.llm import merkle, spelling, token_counts
from cuvee.llm.oracle import OP11, OP13
from cuvee.llm.queries import op11_spelling_variants, op12_token_counts, op13_merkle_manifest

DOC = "doc_id long, text string, lang string, source string, n_chars long"
JSON = public_tokenizers.path("byte_bpe_50k.json")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def sql_rows(sql, folder):
    con = duckdb.connect(config={"threads": 2})
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    return con.execute(sql)


@pytest.fixture()
def hard_docs(spark, corpus, tmp_path):
    """Copies, ties, repeated rows, nulls in every column, and columns with clashing names."""
    rng = random.Random(5)
    names = [None, "", "big", "big", "big", "é", "lone"]
    rows = [(i, t if i % 2 else t and t.replace(" ", "\n", 3), "en", rng.choice(names[:-1]), len(t or "")) for i, t in corpus]
    rows += [rows[5], rows[5], (None, "x\ny", None, None, None), (None, "x\ny", None, None, None), (990, "only one\n", "de", "lone", 9)]
    d = spark.createDataFrame(rows, DOC)
    for c in ("row", "word", "n", "place", "digest", "_text", "prefix_counts", "N_TOKENS", "run", "h"):
        d = d.withColumn(c, F.lit("clash"))
    d.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


# token counts


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(JSON)


@pytest.fixture(scope="module")
def counter():
    return token_counts.PrefixCounter(token_counts.read_vocabulary(JSON), public_tokenizers.PATTERN)


BITS = [
    "a", "b", "e", "th", "the", "in", "ing", "stor", "e", " ", "  ", "\n", "\t", " ", "　", "\x1c", "'s", "'re", "'", "'ll", "'S", "1", "23", "!", "--",
    "...", "é", "ß", "é", "中", "文", "😀", "🏽", "<|endoftext|>", "<|endo", "|>", "՘", "꟒", "-" * 40, "=" * 33, "_", "A",
]


def test_every_prefix_counts_as_the_library_counts_it(library, counter):
    rng = random.Random(1)
    texts = ["".join(rng.choice(BITS) for _ in range(rng.randint(0, 40))) for _ in range(400)]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0x80, 0x2000), rng.randrange(0xE000, 0x20000)])) for _ in range(40)) for _ in range(60)]
    texts += ["-" * 300, " " * 200 + "x", "\n" * 90 + " x", "acgt" * 60, "".join(rng.choices("acgt", k=300)), "store", "it's we'll", ""]
    for t in texts:
        n = token_counts.unpacked(token_counts.packed(counter.text_steps(t))).tolist()
        assert n == [len(e.ids) for e in library.encode_batch([t[:k] for k in range(len(t) + 1)], add_special_tokens=False)], t


def test_long_pieces_take_time_in_their_length(library, counter):
    rng = random.Random(2)
    for t in ("a" * 60_000, " " * 60_000 + "x", "中" * 30_000, "".join(rng.choices("aeionrst", k=60_000))):
        assert counter.text_steps(t).sum(dtype="int64") == len(library.encode(t, add_special_tokens=False).ids)


def test_steps_beyond_a_byte(counter):
    import numpy as np

    steps = np.array([1, 300, -299, 0], np.int32)
    assert token_counts.unpacked(token_counts.packed(steps)).tolist() == [0, 1, 301, 2, 2]


def test_caches_only_bound_memory(library, monkeypatch):
    monkeypatch.setattr(token_counts, "KEPT_PIECES", 3)
    monkeypatch.setattr(token_counts, "KEPT_PAIRS", 2)
    small = token_counts.PrefixCounter(token_counts.read_vocabulary(JSON), public_tokenizers.PATTERN)
    for t in ("some words of a text " * 3, "other words\n\n  again", "some words"):
        assert small.text_steps(t).sum() == len(library.encode(t, add_special_tokens=False).ids)


def test_counts_answer_budgets_without_encoding(spark, hard_docs, library):
    d = spark.read.parquet(f"{hard_docs}/documents.parquet").select("doc_id", "text", "row", F.lit(1).alias("N_Tokens"))
    t = token_counts.prefix_table(d, JSON, public_tokenizers.PATTERN)
    assert t.columns == ["doc_id", "text", "row", "n_bytes", "n_tokens", "prefix_counts"]
    got = t.withColumns({"fit": token_counts.longest_prefix(20), "at7": token_counts.count_at(F.lit(7))}).collect()
    assert len(got) == d.count()
    size = lambda s: len(library.encode(s, add_special_tokens=False).ids)
    for r in got:
        text = r.text or ""
        assert (r.n_bytes, r.n_tokens) == (len(text.encode()), size(text))
        assert r.at7 == (size(text[:7]) if len(text) >= 7 else None)
        k = max(k for k in range(min(len(text), 400) + 1) if size(text[:k]) <= 20)
        assert (r.fit.chars, r.fit.tokens) == (k, size(text[:k]))
    cut = token_counts.truncated(t, 20).collect()
    assert all(r.n_tokens <= 20 and size(r.text or "") == r.n_tokens and (r.text or "").encode().__len__() == r.n_bytes for r in cut)
    with pytest.raises(ValueError):
        token_counts.longest_prefix(-1)


def test_op12_over_whole_tables(spark, hard_docs, library):
    docs = spark.read.parquet(f"{hard_docs}/documents.parquet").select("doc_id", "text").collect()
    size = {r.text: len(library.encode(r.text or "", add_special_tokens=False).ids) for r in docs}
    want = [(r.doc_id, len((r.text or "").encode()), size[r.text], size[r.text] > 1024) for r in docs]
    assert rows_of(op12_token_counts(spark, hard_docs)) == sorted(want, key=repr)


def test_op12_of_an_empty_table(spark, empty, tmp_path):
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    assert op12_token_counts(spark, str(tmp_path)).collect() == []


# Merkle manifest


def hashed(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(r, text):
    told = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return hashed(*map(told, (r.doc_id, r.source, r.lang, r.n_chars, text)))


def manifest_by_hand(rows, fan=3):
    def tree(low):
        levels = [low]
        while len(levels[-1]) > 1:
            levels.append([hashed(*levels[-1][i : i + fan]) for i in range(0, len(levels[-1]), fan)])
        return levels

    def path(levels, i):
        out = []
        for nodes in levels[:-1]:
            a = i - i % fan
            out.append((i - a, [nodes[k] for k in range(a, min(a + fan, len(nodes))) if k != i]))
            i //= fan
        return out

    groups = {}
    for r in rows:
        groups.setdefault(r.source, []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in names:
        groups[g].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r, r.text)))
    trees = {g: tree([leaf(r, r.text) for r in groups[g]]) for g in names}
    crown = tree([trees[g][-1][0] for g in names])
    for at, g in enumerate(names):
        for i, r in enumerate(groups[g]):
            proof = path(trees[g], i) + path(crown, at)
            struck = r.text is not None and r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0
            d = leaf(r, r.text.replace("\n", "") if struck else r.text)
            for k, s in proof:
                d = hashed(*s[:k], d, *s[k:])
            yield r.doc_id, leaf(r, r.text), trees[g][-1][0], crown[-1][0], hashed(*[x for _, s in proof for x in s]), d, d == crown[-1][0]


@pytest.mark.parametrize("span", [1, 2, merkle.SPAN])
def test_manifest_over_whole_tables(spark, hard_docs, span, monkeypatch):
    monkeypatch.setattr(merkle.manifest, "__defaults__", (merkle.FAN, span))
    rows = spark.read.parquet(f"{hard_docs}/documents.parquet").collect()
    got = rows_of(op13_merkle_manifest(spark, hard_docs))
    assert got == sorted(manifest_by_hand(rows), key=repr)
    if span == merkle.SPAN:
        d = sql_rows(OP13, hard_docs)
        names = [c[0] for c in d.description]
        assert names == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
        ids = [r for r in d.fetchall() if r[0] is not None]  # SQL's crc of a null is null: those rows are left out
        assert sorted(ids, key=repr) == [r for r in got if r[0] is not None]


def test_store_holds_every_level(spark):
    d = spark.range(30).select(F.lit("a").alias("group"), F.col("id").alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("digest"), "id")
    proofs, nodes = merkle.manifest(d.withColumn("row", F.struct("id")), span=2)
    assert {(r.level, r.n) for r in nodes.select("level", "n").distinct().collect()} == {(1, 10), (2, 4), (3, 2), (4, 1)}
    assert sorted(r.place for r in nodes.where("level = 1").collect()) == list(range(10))
    p = proofs.where("row.id = 29").first()
    assert (p.place, p.n, len(p.siblings)) == (29, 30, 64 * 3) and p.above.n_groups == 1 and p.above.subroot == p.above.root


def test_other_fans(spark):
    d = spark.range(23).select((F.col("id") % 2).cast("string").alias("group"), F.col("id").alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    proofs, _ = merkle.manifest(d.withColumn("row", F.struct("key")), fan=2, span=3)
    assert proofs.select((merkle.fold("digest", 2) == F.col("above.root")).alias("ok")).distinct().collect() == [(True,)]


def test_op13_of_an_empty_table(spark, empty, tmp_path):
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    assert op13_merkle_manifest(spark, str(tmp_path)).collect() == []


# spelling variants


def near_by_hand(words):
    words, by = set(words), {}
    for w in words:
        by.setdefault(w, set()).add(w)
        for i in range(len(w)):
            by.setdefault((i, w[:i] + w[i + 1 :]), set()).add(w)
            by.setdefault(w[:i] + w[i + 1 :], set()).add(w)
    ordered = lambda a, b: (a, b) if (len(a), a) < (len(b), b) else (b, a)
    return {ordered(a, b) for v in by.values() for a in v for b in v if a != b and spelling.one_edit(*ordered(a, b))}


@pytest.mark.parametrize(("hot", "most"), [(10**6, 10**6), (20, 10**6), (20, 0), (1, 10**6)])
def test_near_pairs_are_all_pairs_at_one_edit(spark, hot, most):
    rng = random.Random(2)
    words = {"".join(rng.choices("ab", k=rng.randint(5, 11))) for _ in range(700)} | {"".join(rng.choices("abcdeéÿ", k=rng.randint(5, 8))) for _ in range(700)}
    words |= {"aaaaa", "aaaaaa", "aaaaaaa", "x" * 500, "x" * 501, "x" * 250 + "y" + "x" * 250}
    got = [(r.a, r.b) for r in spelling.near_pairs(spark.createDataFrame([(w,) for w in words], "word string"), hot, most).collect()]
    assert len(got) == len(set(got)) and {(a, b) if (len(a), a) < (len(b), b) else (b, a) for a, b in got} == near_by_hand(words)


def test_one_edit():
    assert spelling.one_edit("abc", "abcd") and spelling.one_edit("abc", "xabc") and spelling.one_edit("abc", "aXc")
    assert not spelling.one_edit("abc", "abc") and not spelling.one_edit("abc", "acb") and not spelling.one_edit("abc", "abcde")


def test_forms_and_roots(spark):
    n = {"aaaaa": 3, "aaaab": 6, "aaabb": 12, "aabbb": 24, "bbbbb": 5, "cbbbb": 7, "zzzzz": 4, "zzzzy": 8, "zzzzx": 8, "other": 3}
    got = {r.word: tuple(r)[1:] for r in spelling.variants(spark.createDataFrame(list(n.items()), "word string, n long")).collect()}
    assert got["aaaaa"] == ("aaaab", "aabbb", 3, 1, 6) and got["aaabb"] == ("aabbb", "aabbb", 12, 2, 24)
    assert got["aabbb"] == (None, "aabbb", 24, 1, None)
    assert got["zzzzz"] == ("zzzzx", "zzzzx", 4, 2, 8) and got["zzzzy"] == (None, "zzzzy", 8, 2, None)
    assert got["bbbbb"] == (None, "bbbbb", 5, 1, None) and got["other"] == (None, "other", 3, 0, None)


def test_op11_over_whole_tables(spark, tmp_path):
    rng = random.Random(4)
    base = ["".join(rng.choices("abcdefgh", k=rng.randint(4, 9))) for _ in range(150)]
    vary = lambda w: w if rng.random() < 0.8 else w[: (i := rng.randrange(len(w)))] + rng.choice(["", "é", "x", w[i : i + 1] * 2]) + w[i + 1 :]
    texts = [" ".join(rng.choice([str, str.upper, str.title])(vary(rng.choice(base))) for _ in range(200)) for _ in range(120)]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)] + [(i + 200, t, "en", "s", 1) for i, t in enumerate([None, "", "12 34", "q" * 30_000, "Ünïcödé ÷×÷ " * 5])]
    rows += [rows[0], rows[0], (None, texts[1], "en", None, None)]
    d = spark.createDataFrame(rows, DOC).withColumn("word", F.lit(1)).withColumn("N", F.lit(2)).withColumn("run", F.lit("x"))
    d.write.parquet(f"{tmp_path}/documents.parquet")
    got = rows_of(op11_spelling_variants(spark, str(tmp_path)))
    d = sql_rows(OP11, tmp_path)
    assert [c[0] for c in d.description] == ["word", "form", "root", "n", "n_near", "form_n"]
    assert got == sorted(d.fetchall(), key=repr) and sum(r[1] is not None for r in got) > 20


def test_op11_of_an_empty_table(spark, empty, tmp_path):
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    assert op11_spelling_variants(spark, str(tmp_path)).collect() == []
