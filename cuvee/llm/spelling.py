"""Spelling variants: words one edit apart, by a positional q-gram inverted index with a count filter.

A word of L code points, with marks at both ends, has L + Q - 1 grams at positions. One inserted, deleted or replaced code
point changes at most Q of the longer word's grams, moves those behind it by at most one position, and the length by at
most one. So near words share at least max(L, L') - 1 grams at equal or neighbouring positions: the count filter's bound.

**Index shards.** A word misses at most Q of its grams in that overlap, so one of its Q + 1 rarest (ordered by the number of
words that hold the gram, then by itself) is in it, and for both words of a pair the overlap's rarest gram is among those.
Words post these grams under (shorter length, gram, position in the shorter word): as the shorter or equal word at its own
length and position, and as the longer at a length less and this or the last position. All near pairs meet under one key.

**Within a key** the words' own inverted index (all their grams, by role and position) is made. For each shorter word the
postings of its grams, under the limits of length and position, are counted: the shorter lists are merged by a heap, the
longest ones, as many as the bound less one, only searched for what these give. Partners that come up as often as the bound
are compared code point by code point.

**Frequent keys** (more than ``HOT`` words) are split before any pairing: a pair's edit lies within one of the shorter
word's ``PARTS`` stretches, so the words outside it are equal; they are posted once a stretch under all that is outside.
Words that are still together then differ within one stretch only. Nothing is dropped. A key's list of words fits a task.

Counting words, ranking grams and finding pairs are Spark aggregates and joins with partial sums before the shuffle; no list
of words is collected. A word's grams are gathered in one row, so memory follows the longest word.

Defined results: null and empty texts have no words; a null doc_id is written as nothing in the crc; repeated rows count
each time; ties in n go to the word that comes first by code points. Other columns are ignored.
"""

from __future__ import annotations

import re
import string
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from heapq import merge
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, written

LETTERS = "A-Za-zÀ-ÿ"
LEAST_LENGTH = 5
LEAST_COUNT = 3
#: Code points of a gram, and the mark at a word's ends.
Q = 3
MARK = "\0"
#: Words under one key beyond which it is split, stretches of a word, and hot keys up to which they are broadcast.
HOT = 1000
PARTS = 8
MAX_BROADCAST = 100_000
#: Words that a task counts before it hands them on.
KEPT_WORDS = 500_000
#: Postings whose words a task pairs.
TASK_POSTINGS = 100_000
#: A word's form has at least so many times its occurrences.
RATIO = 2


def counted_runs(docs: DataFrame, column: str = "text", every: int = 97) -> DataFrame:
    """(word, n): every run of letters, A-Z lower-cased; runs whose crc32 with the document's id ``every`` divides lose the
    code point that it points at. Tasks count before the shuffle, at most ``KEPT_WORDS`` words at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = re.compile(f"[{LETTERS}]+").findall
        lower = {ord(a): ord(b) for a, b in zip(string.ascii_uppercase, string.ascii_lowercase, strict=True)}
        total: Counter[str] = Counter()

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                own: dict[str, int] = {}
                for w, n in Counter(found(text.as_py())).items():
                    low = w.lower() if w.isascii() else w.translate(lower)
                    own[low] = own.get(low, 0) + n
                name = f"{doc.as_py()}:".encode()
                first = zlib.crc32(name)
                for w, n in own.items():
                    h = zlib.crc32(w.encode(), first)
                    if h % every == 0:
                        w = w[: h % len(w)] + w[h % len(w) + 1 :]
                    total[w] += n
                if len(total) > KEPT_WORDS:
                    yield told()
                    total.clear()
        yield told()

    named = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce(F.col(column), F.lit("")))
    return named.mapInArrow(run, "word string, n long")


def vocabulary(words: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of ``words`` (word, n in parts) that are long and frequent enough."""
    long = words.where(F.char_length("word") >= least_length)
    return long.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _rarest(words: DataFrame, max_broadcast: int) -> DataFrame:
    """(word, len, grams): each word's Q + 1 rarest grams as structs gram, at. There are no more grams than the alphabet's
    letters to the power of Q, so the counted ones are mostly few enough to broadcast, and no gram is a hot key then."""
    marked = F.concat(F.lit(MARK * (Q - 1)), "word", F.lit(MARK * (Q - 1)))
    each = F.sequence(F.lit(0), F.char_length("word") + Q - 2)
    grams = F.transform(each, lambda i: F.struct(F.substring(marked, i + 1, F.lit(Q)).alias("gram"), i.alias("at")))
    d = words.select("word", F.explode(grams).alias("g")).select("word", "g.gram", "g.at")
    held = written(d.groupBy("gram").agg(F.count("*").alias("df")), "grams")
    ranked = d.join(F.broadcast(held) if held.count() <= max_broadcast else held, "gram").groupBy("word").agg(F.sort_array(F.collect_list(F.struct("df", "gram", "at"))).alias("r"))
    first = F.transform(F.slice("r", 1, Q + 1), lambda x: F.struct(x["gram"].alias("gram"), x["at"].alias("at")))
    return ranked.select("word", F.char_length("word").alias("len"), first.alias("grams"))


def _posted(words: DataFrame) -> DataFrame:
    """(len, gram, at, longer, word): the index's postings."""

    def keys(g: Column) -> Column:
        own = lambda less, back, longer: F.struct((F.col("len") - less).alias("len"), g["gram"].alias("gram"), (g["at"] - back).alias("at"), F.lit(longer).alias("longer"))
        return F.array(own(0, 0, False), own(1, 0, True), own(1, 1, True))

    return words.select("word", F.explode(F.flatten(F.transform("grams", keys))).alias("k")).select("k.*", "word")


def _outside() -> Column:
    """The keys of a posting under a frequent key: for each stretch of the shorter word, what is outside it."""
    size = F.least(F.col("len"), F.lit(PARTS))
    edge = lambda j: F.floor(j * F.col("len") / size).cast("int")
    tail = lambda j: F.col("len") - edge(j + 1)
    return F.transform(
        F.sequence(F.lit(0), size - 1),
        lambda j: F.struct(j.alias("part"), F.xxhash64(F.substring(F.col("word"), F.lit(1), edge(j)), F.lit(MARK), F.substring(F.col("word"), F.char_length("word") - tail(j) + 1, tail(j))).alias("rest")),
    )


def one_edit(a: str, b: str) -> bool:
    """Whether ``b``, no shorter than ``a``, differs from it by exactly one inserted, deleted or replaced code point."""
    n = len(a)
    if len(b) - n > 1 or a == b:
        return False
    k = 0
    while k < n and a[k] == b[k]:
        k += 1
    return a[k + 1 :] == b[k + 1 :] if n == len(b) else a[k:] == b[k + 1 :]


def _often(lists: list[list[int]], bound: int) -> Iterator[int]:
    """Numbers that are in at least ``bound`` of the sorted lists. One that is in so many is in one of the shorter lists,
    all but the longest ``bound`` - 1; those are merged by a heap, and the longest are searched for what they give."""
    lists.sort(key=len)
    cut = len(lists) - bound + 1
    for x, hits in groupby(merge(*lists[:cut]) if cut > 1 else lists[0]):
        n = sum(1 for _ in hits)
        for k in range(cut, len(lists)):
            if n >= bound or n + len(lists) - k < bound:
                break
            long = lists[k]
            at = bisect_left(long, x)
            n += at < len(long) and long[at] == x
        if n >= bound:
            yield x


def merged_pairs(shorter: list[str], longer: list[str]) -> Iterator[tuple[str, str]]:
    """Near pairs among the words of one key: ``shorter`` ones of one length, and ``longer`` ones of one code point more."""
    ends = MARK * (Q - 1)

    def indexed(words: list[str]) -> tuple[list[list], dict]:
        own, postings = [], {}
        for k, w in enumerate(words):
            marked = ends + w + ends
            grams = [(marked[i : i + Q], i) for i in range(len(w) + Q - 1)]
            for g in grams:
                postings.setdefault(g, []).append(k)
            own.append(grams)
        return own, postings

    own, same = indexed(shorter)
    more = indexed(longer)[1] if longer else {}
    for k, (w, grams) in enumerate(zip(shorter, own, strict=True)):
        # an edit in place moves nothing; only words behind this one, so that a pair comes once
        lists = [x for g in grams if (x := same[g])[-1] > k]
        if len(lists) >= len(w) - 1:
            for other in _often(lists, len(w) - 1):
                if other > k and one_edit(w, shorter[other]):
                    yield w, shorter[other]
        if more:
            # what follows an insertion moves by one
            lists = []
            for g, i in grams:
                here, next_ = more.get((g, i)), more.get((g, i + 1))
                if here or next_:
                    lists.append(sorted({*here, *next_}) if here and next_ else here or next_)
            if len(lists) >= len(w):
                for other in _often(lists, len(w)):
                    if one_edit(w, longer[other]):
                        yield w, longer[other]


def _paired(groups: DataFrame, n: int) -> DataFrame:
    """(a, b): near pairs of groups (shorter, longer: arrays of words) of ``n`` postings. Their bytes say little of the work
    in them, so they are spread by number."""
    groups = groups.repartition(max(2 * groups.sparkSession.sparkContext.defaultParallelism, n // TASK_POSTINGS + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[str, str]] = []
            for s, t in zip(batch.column(0), batch.column(1), strict=True):
                found.extend(merged_pairs(s.as_py(), t.as_py()))
            a, b = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string())], names=["a", "b"])

    return groups.mapInArrow(run, "a string, b string")


def _gathered(posted: DataFrame, key: list[str]) -> DataFrame:
    """Keys under which a pair may be, with their words by role."""
    named = F.collect_set(F.struct("longer", "word"))
    side = lambda longer: F.array_sort(F.transform(F.filter("_w", lambda x: x["longer"] == longer), lambda x: x["word"]))
    d = posted.groupBy(key).agg(named.alias("_w")).where("size(_w) > 1")
    return d.select(side(False).alias("shorter"), side(True).alias("longer")).where("size(shorter) > 0")


def near_pairs(words: DataFrame, hot: int = HOT, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """(a, b): all pairs of distinct ``words`` (column word) at one edit, each once; of unequal lengths a is the shorter."""
    key = ["len", "gram", "at"]
    posted = written(_posted(_rarest(words, max_broadcast)), "postings")
    total = posted.count()
    sizes = posted.groupBy(key).agg(F.count("*").alias("_size"))
    frequent = written(sizes.where(F.col("_size") > hot).select(key), "frequent")
    n = frequent.count()
    if not n:
        return _paired(_gathered(posted, key), total).distinct()
    beside = F.broadcast(frequent) if n <= max_broadcast else frequent
    calm = posted.join(beside, key, "left_anti")
    split = posted.join(beside, key, "left_semi").withColumn("_o", F.explode(_outside())).select(*key, "_o.*", "longer", "word")
    # a posting under several keys would meet the same words again; the outside alone decides
    split = split.select("len", "part", "rest", "longer", "word").distinct()
    both = _gathered(calm, key).unionByName(_gathered(split, ["len", "part", "rest"]))
    return _paired(both, total).distinct()


def variants(words: DataFrame, hot: int = HOT) -> DataFrame:
    """Per word of ``words`` (word, n): word, n, n_near, form, form_n and root. The form is the near word of largest n (the
    first by code points of equals) where that is at least RATIO times the word's own; the root is where forms end."""
    words = written(words.select("word", "n"), "vocabulary")
    pairs = near_pairs(words, hot)
    sided = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("_near")), F.struct(F.col("b").alias("word"), F.col("a").alias("_near")))).alias("p")).select("p.*")
    counted = sided.join(words.select(F.col("word").alias("_near"), F.col("n").alias("_near_n")), "_near")
    best = counted.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("_near_n")).alias("less"), F.col("_near").alias("form"))).alias("_b"))
    d = words.join(best, "word", "left")
    wins = F.coalesce(-F.col("_b.less") >= RATIO * F.col("n"), F.lit(False))
    d = written(
        d.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(wins, F.col("_b.form")).alias("form"), F.when(wins, -F.col("_b.less")).cast("long").alias("form_n")),
        "forms",
    )
    out = d.join(roots(d.where("form IS NOT NULL").select("word", "form")), "word", "left").withColumn("root", F.coalesce("root", "word"))
    return out.select("word", "form", "root", "n", "n_near", "form_n")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) where the chains of ``forms`` (word, form) end. n at least doubles along a chain, so chains are short
    and have no circles; each step doubles the reach."""
    reach = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = reach.select(F.col("word").alias("_via"), F.col("root").alias("_far"))
        d = written(reach.join(on, F.col("root") == F.col("_via"), "left").select("word", F.coalesce("_far", "root").alias("root"), F.col("_far").isNotNull().alias("_moved")), "roots")
        moved = not d.where("_moved").isEmpty()
        discard(reach)
        reach = d.drop("_moved")
        reach._scratch = d._scratch
        if not moved:
            return reach


def spelling_variants(docs: DataFrame, every: int = 97) -> DataFrame:
    """``variants`` of the words of ``docs`` (doc_id, text)."""
    return variants(vocabulary(counted_runs(docs, every=every)))
