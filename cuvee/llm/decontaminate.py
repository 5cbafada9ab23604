"""Benchmark decontamination: a prefix-filtered set join of documents with benchmark items.

An item's window is 13 consecutive words (an item of fewer is one window). Containment must be exact, so of a window's
words, ordered by rarity in the whole corpus, the first alone is a sufficient prefix: a document holds the window only
where it holds that rarest word. Documents meet items on these words, positions bound the possible overlap, and the
words around the meeting point are compared, so that the longest equal run of at least a window's length is what is hit.

Plan: one pass counts the benchmark's words over the corpus; a second finds the rare words inside each row, explodes
only those, with the 12 words on either side, joins them with the anchors and gathers hits by document. No text is
shuffled. Up to ``MAX_LITERALS`` distinct anchor words are compiled into the plan and ``MAX_BROADCAST`` anchors are
broadcast. Beyond, words are counted before they meet the vocabulary, so that only counts are shuffled; a Bloom filter of
the anchor words, of at most ``MAX_FILTER_BITS`` bits, tells the possible ones inside each row; and these are joined by a
shuffle, with null keys spread. What the filter lets through wrongly meets no anchor. Past an eighth of its bits in
anchor words it lets more through; results stay.

Defined results: null and empty texts, items without words and null ids are allowed (a document without words has no
hits; a null item_id counts as an item whose name is empty). Rows equal in doc_id and text count as one. Other columns
are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

WINDOW = 13
#: Separators of words, on text whose letters A-Z are not lower-cased yet.
APART = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
MAX_LITERALS = 50_000
MAX_BROADCAST = 50_000
#: Bits of the filter for each anchor word, and at most in all (4 MB).
FILTER_BITS, MAX_FILTER_BITS = 16, 1 << 25


def ascii_lower(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def _parts(text: Column) -> Column:
    """Words in their own case; an empty first or last part may stand for separators at an end."""
    return F.split(F.coalesce(text, F.lit("")), APART)


def _n_words(parts: str) -> Column:
    first, last = F.get(parts, F.lit(0)) == "", F.get(parts, F.size(parts) - 1) == ""
    n = F.size(parts) - first.cast("int") - last.cast("int")
    return F.greatest(n, F.lit(0)).cast("long")


def corpus_counts(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(word, corpus_n) of the vocabulary's words, over all words of all documents; words are lower-cased."""
    small = vocabulary.count() <= MAX_LITERALS
    words = docs.select(F.explode(_parts(F.col("text"))).alias("_w")).select(F.lower("_w").alias("word"))
    if small:
        words = words.join(F.broadcast(vocabulary), "word", "left_semi")
    counts = words.groupBy("word").agg(F.count("*").alias("corpus_n"))
    return counts if small else counts.join(vocabulary, "word", "left_semi")


def anchors(benchmark: DataFrame, docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(word, item_id, at, around, least): the rarest word of each window of each item, lower-cased, its place in the
    item, the item's words from 12 before it to 12 after it, and the window's length."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
        F.filter(_parts(ascii_lower(F.col("text"))), lambda x: x != "").alias("_iw"),
    ).where(F.size("_iw") > 0).distinct()
    items = written(items.withColumn("_item", F.xxhash64("item_id", F.array_join("_iw", " "))), "items")
    places = items.select("_item", F.posexplode("_iw").alias("at", "word")).withColumn("word", F.lower("word"))
    counts = corpus_counts(docs, written(places.select("word").distinct(), "vocabulary"))
    ranked = (
        places.join(counts, "word", "left")
        .groupBy("_item")
        .agg(F.sort_array(F.collect_list(F.struct("at", F.coalesce("corpus_n", F.lit(0)).alias("n"), "word"))).alias("_r"))
    )
    least = F.least(F.size("_iw"), F.lit(window))
    rank = F.transform("_r", lambda x: F.struct(x["n"], x["word"], x["at"]))
    first = F.transform(
        F.sequence(F.lit(1), F.size("_r") - F.col("least") + 1), lambda s: F.array_min(F.slice("_k", s, F.col("least")))["at"]
    )
    d = items.withColumn("least", least).join(ranked, "_item").withColumn("_k", rank)
    d = d.select("item_id", "_iw", "least", F.explode(F.array_distinct(first)).alias("at"))
    begin = F.greatest(F.col("at") - (window - 1), F.lit(0))
    return written(
        d.select(
            F.lower(F.get("_iw", F.col("at"))).alias("word"),
            "item_id",
            (F.col("at") - begin).alias("at"),
            F.slice("_iw", begin + 1, F.lit(2 * window - 1)).alias("around"),
            "least",
        ),
        "anchors",
    )


def _equal_run(step: int, window: int) -> Column:
    """Equal words in a row next to the meeting point, in the direction of ``step``."""

    def same(o: Column) -> Column:
        there = F.get("_ctx", F.col("_c") + o * step) == F.get("around", F.col("at") + o * step)
        return F.coalesce(there & (o < window), F.lit(False))

    return F.array_position(F.transform(F.sequence(F.lit(1), F.lit(window)), same), F.lit(False)).cast("int") - 1


def _probes(word: Column, bits: int) -> list[Column]:
    """Two places of a word in a filter of so many bits, a power of two."""
    h = F.xxhash64(word)
    return [h.bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(bits - 1))]


def word_filter(names: DataFrame) -> tuple[Column, int]:
    """(filter, bits): a Bloom filter of the words as one array of 64-bit numbers, a constant of the plan. The driver sees
    its numbers, ``MAX_FILTER_BITS`` / 64 at most, whatever the number of words."""
    bits = 1 << max(FILTER_BITS * names.count() - 1, 1 << 10).bit_length()
    bits = min(bits, MAX_FILTER_BITS)
    at = names.select(F.explode(F.array(*_probes(F.col("word"), bits))).alias("at"))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at").bitwiseAND(F.lit(63)).cast("int"))
    slots = at.groupBy(F.shiftright("at", 6).alias("slot")).agg(F.bit_or(one).alias("n"))
    full = [0] * (bits // 64)
    for r in slots.collect():
        full[r.slot] = r.n
    return F.split(F.lit(",".join(map(str, full))), ",").cast("array<long>"), bits


def _possible(word: Column, known: Column, bits: int) -> Column:
    """Whether the filter may hold the word; false for none of its words."""
    first, second = (F.getbit(F.get(known, F.shiftright(p, 6).cast("int")), p.bitwiseAND(F.lit(63)).cast("int")) == 1 for p in _probes(word, bits))
    return first & second


def _candidates(docs: DataFrame, found: DataFrame, window: int) -> DataFrame:
    """(doc_id, _text_key, n_words, _p): a row for each place of an anchor word, or one with a null place."""
    parts = docs.select("doc_id", F.xxhash64("text").alias("_key"), _parts(F.col("text")).alias("_w"))
    names = found.select("word").distinct()
    context = lambda i: F.struct(
        i.alias("i"),
        F.least(i, F.lit(window - 1)).alias("c"),
        F.slice("_w", F.greatest(i - (window - 1), F.lit(0)) + 1, window + F.least(i, F.lit(window - 1))).alias("ctx"),
    )
    listed = [r.word for r in names.limit(MAX_LITERALS + 1).collect()]
    if not listed:
        at = F.array().cast("array<int>")
    else:
        if len(listed) <= MAX_LITERALS:
            named = lambda w: w.isin(listed)
        else:
            known, bits = word_filter(names)
            named = lambda w: _possible(w, known, bits)
        at = F.filter(F.sequence(F.lit(0), F.size("_w") - 1), lambda i: named(F.lower(F.get("_w", i))))
    d = parts.withColumn("_at", at)
    d = d.select("doc_id", "_key", _n_words("_w").alias("n_words"), F.transform("_at", context).alias("_ps"))
    return d.select("doc_id", "_key", "n_words", F.explode_outer("_ps").alias("_p"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items (sorted as strings), contaminated."""
    found = anchors(benchmark, docs, window)
    d = _candidates(docs, found, window).select(
        "doc_id", "_key", "n_words", F.col("_p.i").alias("_i"), F.col("_p.c").alias("_c"),
        F.transform("_p.ctx", ascii_lower).alias("_ctx"),
    )
    key = F.lower(F.get("_ctx", F.col("_c")))
    small = found.count() <= MAX_BROADCAST
    if not small:  # a null meets nothing; spread over all tasks
        key = F.coalesce(key, F.concat(F.lit("\0"), F.col("doc_id").cast("string")))
    d = d.withColumn("word", key).join(F.broadcast(found) if small else found, "word", "left")
    d = d.withColumns({"_left": _equal_run(-1, window), "_right": _equal_run(1, window)})
    same = F.get("_ctx", F.col("_c")) == F.get("around", F.col("at"))
    hit = same & (F.col("_left") + F.col("_right") + 1 >= F.col("least"))
    d = d.groupBy("doc_id", "_key", "n_words").agg(
        F.collect_set(F.when(hit, F.struct((F.col("_i") - F.col("_left")).alias("s"), (F.col("_i") + F.col("_right")).alias("e")))).alias("_spans"),
        F.collect_set(F.when(hit, F.col("item_id"))).alias("_items"),
    )
    start = F.struct(F.lit(0).alias("total"), F.lit(-1).alias("end"))
    n_hit = F.aggregate(
        F.sort_array("_spans"),
        start,
        lambda a, x: F.struct(
            (a["total"] + F.greatest(F.lit(0), x["e"] - F.greatest(x["s"] - 1, a["end"]))).alias("total"),
            F.greatest(a["end"], x["e"]).alias("end"),
        ),
        lambda a: a["total"].cast("long"),
    )
    return d.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.sort_array("_items").alias("items"),
    ).withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose document is not contaminated; rows with a null doc_id are judged as one id."""
    bad = contamination(docs, benchmark).where("contaminated").select(F.col("doc_id").alias("_bad")).distinct()
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col("_bad")), "left_anti")
