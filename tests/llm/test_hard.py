"""Inputs made to break the operators: structured words, very long pieces, many spans, hot groups."""

import time

import pytest
from pyspark.sql import functions as F


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


# ---------------------------------------------------------------- words
def test_words_are_compared_as_words(spark):
    """Words that polynomial hashes modulo a power of two can't tell apart are other words."""
    from cuvee.llm import minhash_dedup, substring_dedup

    w = [thue_morse(n) for n in (1024, 2048, 4096)]
    other = [x.translate(str.maketrans("ab", "ba")) for x in w]
    docs = spark.createDataFrame([(1, " ".join(w * 5)), (2, " ".join(other * 5))], "doc_id long, text string")
    assert {(r.doc_id, r.component_id) for r in minhash_dedup.near_duplicates(docs).collect()} == {(1, 1), (2, 2)}
    assert {r.n_removed for r in substring_dedup.removed(docs).collect()} == {0}


def test_exact_windows():
    import random
    import re

    from cuvee.llm.wordhash import WordHasher, exact_windows

    rng = random.Random(2)
    texts = ["", "  ", "a", "A", "a b", "a b c d e"] + [" ".join(rng.choice("abcAé") for _ in range(rng.randint(0, 30))) for _ in range(200)]
    for lower in (False, True):
        sets = []
        for t in texts:
            w = re.findall(r"[^\x20\x09-\x0D]+", t.lower() if lower else t)
            sets.append({tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))} if w else set())
        got = exact_windows(WordHasher(lower).of([t.encode() for t in texts]), 5)
        for i in range(0, len(texts), 7):
            assert len(got[i]) == len(sets[i])
            for j in range(len(texts)):
                assert len(set(got[i].tolist()) & set(got[j].tolist())) == len(sets[i] & sets[j])


@pytest.mark.parametrize("sizes", [(512, 128), (4, 2), (4, 4)])
def test_hot_key_of_separate_clusters(spark, sizes, monkeypatch):
    """Clusters that share a hot key, each linked inside: every link is found in small blocks."""
    from test_ops import near_truth

    from cuvee.llm import minhash_dedup as m

    monkeypatch.setattr(m, "BUCKET", 1)
    monkeypatch.setattr(m, "BLOCK", sizes[0])
    monkeypatch.setattr(m, "FINE", sizes[1])
    shared = [f"s{k}" for k in range(140)]
    docs = []
    for c in range(6):
        own = [f"c{c}x{k}" for k in range(60)]
        for k in range(4):
            docs.append((c + 10 * k, " ".join(shared + own[: 60 - k])))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in m.near_duplicates(d).collect()}
    assert got == near_truth(docs) and len({v[1] for v in got.values()}) == 6


# ---------------------------------------------------------------- 10
def plain_spans(text, model):
    """Base spans, and of the scored candidates the best first, each compared with all taken before."""
    import numpy as np

    from cuvee.llm import pii

    base = pii.base_spans(text)
    new = [p for p in pii.proposals(text) if not any(p[1] < e and b < p[2] for _, b, e in base)]
    score = model.probability(np.array([pii.features(text, *p) for p in new])) if new else []
    added = []
    for i in np.argsort(-np.asarray(score), kind="stable"):
        if score[i] >= model.threshold and not any(new[i][1] < y and x < new[i][2] for _, x, y in added):
            added.append(new[i])
    return sorted(base + added, key=lambda s: (pii.KINDS.index(s[0]), s[1], s[2]))


def test_pii_spans_against_all_pairs():
    import random

    from cuvee.llm import pii

    rng, model = random.Random(5), pii.train()
    parts = ["call", "(415) 555-0134", "212-555-0177", "+1 415 555 0100", "card", "4111 1111 1111 1111", "joe (at) foo (dot) com", "a@b.org", "10.0.0.1", "2020-01-02", "isbn", "12 34 56", "1" * 30, "x"]
    found = 0
    for _ in range(300):
        text = " ".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        base, spans = pii.spans(text, model)
        assert spans == plain_spans(text, model), text
        found += len(spans) - len(base)
    assert found > 100


def test_pii_hard_texts(spark):
    """A text of zeros, and megabytes of telephone numbers in time that follows their length."""
    from cuvee.llm import pii

    assert pii.base_spans("0" * 5000 + ".1.2.3") == [("ip", 0, 5006)] and pii.base_spans("9" * 5000 + ".1.2.3") == []
    model, line = pii.train(), "call +1 (415) 555-0134 or 212-555-0177 or (212) 555-0199 now\n"
    began = time.time()
    base, spans = pii.spans(line * 50_000, model)
    assert len(base) == 50_000 and len(spans) == 150_000 and time.time() - began < 60
    for text in ("a at " * 100_000, "1 2 " * 100_000, "x at " + "b" * 500_000, "(at)b dot " * 50_000, "1" * 500_000 + "x"):
        pii.spans(text, model)
    assert time.time() - began < 90
    long_name = "n" * 200
    assert pii.spans(f"write to {long_name} (at) foo (dot) com", model)[1] in ([], [("email", 9, 9 + 200 + len(" (at) foo (dot) com"))])
    d = spark.createDataFrame([(1, "0" * 5000 + ".1.2.3"), (2, None)], "doc_id long, text string")
    assert {(r.doc_id, r.n_ip) for r in pii.find(d, model).collect()} == {(1, 1), (2, 0)}


# ---------------------------------------------------------------- 5
def test_very_long_pieces():
    """Pieces of a hundred thousand letters equal the library's ids, in time that follows their length."""
    import random

    import public_tokenizers as p
    import tiktoken

    from cuvee.llm import bpe

    ranks = bpe.read_ranks(p.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=p.PATTERN, mergeable_ranks=dict(ranks), special_tokens={})
    codec, rng = bpe.Codec(ranks, p.PATTERN), random.Random(3)
    texts = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n)) for n in (255, 256, 257, 384, 1000, 100_000)]
    texts += ["a" * 5000, "abcde" * 1000, "=" * 3000, "é" * 2000, "".join(rng.choices("ACGT", k=5000)), "".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(2000))]
    began = time.time()
    got = codec.encode(texts)
    assert time.time() - began < 60
    assert [x.tolist() for x in got] == [library.encode_ordinary(t) for t in texts]
    assert codec.decode(got) == [t.encode() for t in texts]
    # parts without a common token: encoded anew from a boundary, or from the start
    piece = texts[4].encode()
    for known in (400, 900):
        head = [codec.contracted([piece[:known]])[k].tolist() for k in (1, 2)]
        codec.extend(piece, *head, len(piece))
        assert head[1] == library.encode_ordinary(texts[4])
    assert not codec.joined([0, 3], [5, 6], [3, 4], [7, 6])


def test_decoding_in_blocks(monkeypatch):
    import public_tokenizers as p

    from cuvee.llm import bpe

    monkeypatch.setattr(bpe, "DECODE_IDS", 7)
    monkeypatch.setattr(bpe, "LEARN_BYTES", 16)
    codec = bpe.Codec(bpe.read_ranks(p.path("byte_bpe_50k.tiktoken")), p.PATTERN)
    texts = ["", "one two three four five six seven eight nine ten", "", "x\x00y", "😀 é " * 9]
    assert codec.decode(codec.encode(texts)) == [t.encode() for t in texts]


# ---------------------------------------------------------------- 6
def test_archives_are_equal(spark, tmp_path):
    """However the input is dealt to tasks, the same pages give the same files; shards split hot ids without repeating record ids."""
    import re

    from cuvee.llm import warc

    n = 200_000
    pages = spark.range(n).select(
        F.when(F.col("id") % 3 > 0, F.col("id") % 50_000).alias("page_id"), F.concat(F.lit("u"), F.col("id")).alias("url"),
        F.when(F.col("id") % 6 == 0, F.lit("hot")).otherwise(F.sha1(F.col("id").cast("string"))).alias("html"),
    )
    made = []
    for name, d in (("a", pages), ("b", pages.repartition(7)), ("c", pages.repartition(3, "url"))):
        made.append(sorted(map(tuple, warc.write_archive(d, f"file://{tmp_path}/{name}", repeats=True, least_shard=1 << 20).collect())))
    assert made[0] == made[1] == made[2] and len(made[0]) > 50
    assert sum(m[3] for m in made[0]) == n and max(m[3] for m in made[0]) < 3 * n / len(made[0])
    back = warc.read_archive(spark, f"file://{tmp_path}/a")
    assert back.select("url").distinct().count() == n
    ids = [x for f in (tmp_path / "a").glob("part-*.warc.gz") for raw in warc._records(f.open("rb")) for x in re.findall(rb"WARC-Record-ID: (\S+)", raw)]
    assert len(ids) == len(set(ids)) == n
    assert warc.shard_starts(pages.limit(0).select("page_id", "url", F.lit("").alias("_sha1"), F.lit(0).cast("long").alias("_n"))) == []


# ---------------------------------------------------------------- 7
def test_very_long_conversation(spark):
    """A hundred thousand turns, in time that follows their number."""
    from cuvee.llm import chat

    n = 100_000
    turn = F.col("id")
    rows = spark.range(n).select(
        F.lit(1).cast("long").alias("conv_id"), turn.alias("turn"), F.when(turn % 3 > 0, "assistant").otherwise("user").alias("role"), F.concat(F.lit("é<x\\ "), turn).alias("text")
    )
    began = time.time()
    back = chat.read_back(chat.formatted(rows)).select(F.size("turns").alias("n"), "loss_text", F.element_at("turns", -1)["text"].alias("last")).collect()
    assert time.time() - began < 60
    assert [(r.n, r.last) for r in back] == [(n, f"é<x\\ {n - 1}")]
    assert back[0].loss_text == "".join(f"é<x\\ {i}" for i in range(n) if i % 3)


# ---------------------------------------------------------------- 1
def test_license_back_to_back_and_noise():
    from cuvee.llm.license_scan import TEMPLATES, Scanner

    s = Scanner(named=True)
    for name in ("MIT/text", "BSD-3-Clause/text", "AGPL-3.0/notice"):
        n = s.scan(TEMPLATES[name])[0]
        assert s.scan(" ".join([TEMPLATES[name]] * 3))[1] == [(name, k * n, k * n + n, 1.0) for k in range(3)]
    noise = "license " * 50
    assert s.scan(noise + "Released under the MIT License " + noise)[1] == [("MIT/line", 50, 55, 1.0)]
    for text in ("All human rights activists reserved tickets", "licensed under the Apache tribe license of version 2 0", "SPDX-License-Identifier: CC-BY-NC-SA-4.0", "SPDX-License-Identifier: NOASSERTION"):
        assert s.scan(text)[1] == [], text
    assert [f[0] for f in s.scan("// SPDX-License-Identifier: GPL-3.0-only\n# SPDX-License-Identifier: (MIT OR Apache-2.0)")[1]] == ["GPL-3.0/identifier", "MIT/identifier"]
    bsd2 = TEMPLATES["BSD-2-Clause/text"]
    assert [f[0] for f in s.scan(bsd2)[1]] == ["BSD-2-Clause/text"]


# ---------------------------------------------------------------- 3
def test_rising():
    """Against the definition: at each point the greatest of the least means of the stretches that hold it."""
    import numpy as np

    from cuvee.llm.quality_classifier import rising

    rng = np.random.default_rng(3)
    for _ in range(50):
        x, y = np.sort(rng.integers(0, 12, 20)).astype(float), rng.integers(0, 2, 20).astype(float)
        got = np.interp(x, *rising(x, y))
        values = np.unique(x)
        for v in values:
            want = max(min(y[(x >= a) & (x <= b)].mean() for b in values if b >= v) for a in values if a <= v)
            assert abs(got[x == v][0] - want) < 1e-9
        assert (np.diff(got) >= -1e-12).all()


def test_classifier_repeated_and_long_rows(spark, monkeypatch):
    """Rows of one labelled id count up to the bound; a very long text is scored whole."""
    from cuvee.llm import quality_classifier as qc

    monkeypatch.setattr(qc, "CALIBRATION", 40)
    rows = [(i, ("river stone light morning " if i % 2 else "BUY $$$ click !!! ") * (20 + i % 7)) for i in range(300)]
    docs = spark.createDataFrame(rows + [rows[3]] * 500 + [(900, "river stone light morning " * 40_000), (None, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)] * 2, "doc_id long, quality int")
    model = qc.train(docs, labels)
    got = qc.score(docs, model).select("doc_id", "score", "predicted").collect()
    assert len(got) == 802 and {r.predicted for r in got if r.doc_id == 900} == {1} and len({r.score for r in got if r.doc_id == 3}) == 1
    assert all(r.predicted == r.doc_id % 2 for r in got if r.doc_id is not None and r.doc_id < 300)


# ---------------------------------------------------------------- pipeline
def test_pipeline_of_an_empty_table(spark, empty, tmp_path):
    import corpus_pipeline

    empty.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "a b c")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline_on_hard_texts(spark, tmp_path):
    """Digits without end, a very long piece and null texts go through all stages."""
    import corpus_pipeline

    words = " ".join(f"the river number {k} of a long walk and its stone" for k in range(30))
    rows = [(1, words + " " + "0" * 5000 + ".1.2.3"), (2, words[::-1] + " and the " + "xyz" * 2000), (3, None), (4, ""), (4, ""), (None, words + " of others")]
    d = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        d = stage(spark, d, "") if name != "decontamination" else corpus_pipeline.decontaminate.clean_documents(d, spark.createDataFrame([], "item_id long, text string"))
    got = corpus_pipeline.tokens(spark, d, "").collect()
    assert {r.doc_id for r in got} <= {1, 2, None} and all(r.round_trip for r in got)
    ids = corpus_pipeline.personal_data(spark, spark.createDataFrame(rows[:1], "doc_id long, text string"), "").first()
    assert "[IP]" in ids.text and "0000" not in ids.text
