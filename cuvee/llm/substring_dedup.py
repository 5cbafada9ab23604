"""Substring de-duplication: shards hold compressed FM-indexes in which streamed documents are searched backward.

A window is ``WINDOW`` consecutive words. Each has a minimizer, the least hash among its ``GRAM``-word runs; windows in
a row that share one form a stretch, and equal windows have equal minimizers wherever they stand. So minimizers deal
stretches to shards such that a window meets all its equals in one shard, and the work stays linear in the corpus:

1. one pass over the texts gives each document's minimizers and a cryptographic digest of its word sequence; of documents
   with equal sequences only the first goes on, the others are covered entirely;
2. minimizers are counted; those of a single document end here;
3. the stretches of the rest, as text, go to shards of about ``SHARD`` stretches; equal ones of a batch of documents
   travel once, with their places. A shard indexes its distinct stretches with their smallest documents and searches each
   backward from each place where a window may end: the matching statistic there is the number of words before it that an
   earlier document holds in a row. A stretch matched whole is covered whole, and of another the intervals whose statistic
   reaches ``WINDOW`` are reported;
4. intervals are gathered by document and the words they cover removed.

A minimizer of more than ``HOT`` documents would overfill a shard. Its windows are taken singly: equal ones are first
aggregated to one with their smallest document, then dealt to shards by their own hash and searched in the same way,
and their members join the result by that hash, where Spark may split a hot one.

Hashes only deal; in a shard words have exact numbers and are compared by them. Defined results: null texts have no
words; a document of fewer words than a window keeps all; a null doc_id neither removes nor loses words; rows equal in
doc_id and text give equal rows; rows of one doc_id with different texts count as one document, so that what is covered
in one is removed in each; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written
from .fm_index import FMIndex
from .wordhash import WordHasher, window_hashes

WINDOW, GRAM = 13, 5
SHARD = 8_000
HOT = 20_000
STRETCH = "shard long, n int, content binary, docs array<long>, places array<int>"
#: End of an interval that covers a whole document.
ALL = (1 << 31) - 1


def stretches(words: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, minimizer) of each stretch of a document."""
    grams = window_hashes(words, GRAM)
    width = window - GRAM + 1
    n = len(grams) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.arange(n) + np.lib.stride_tricks.sliding_window_view(grams, width).argmin(axis=1)
    first = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1])
    return first, np.diff(first, append=n), grams[at[first]]


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def _packed(docs: DataFrame) -> DataFrame:
    """(doc_id, text): texts compressed one by one before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            packed = pa.array([pack(t.as_buffer()) for t in batch.column(1)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), packed], names=["doc_id", "text"])

    return _texts(docs).mapInArrow(run, "doc_id long, text binary")


def _unpacked(packed: pa.Array) -> pa.Array:
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    return pa.array([unpack(t.as_buffer()) for t in packed], pa.binary()).cast(pa.string())


def _grams(docs: DataFrame) -> DataFrame:
    """(doc_id, sequence, mins) of documents with a window and an id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            names, mins, at = [], [], []
            for a, b, words in hasher.slices(batch.column(1)):
                hashes, begin = words.hashes(), words.begin
                for i in range(b - a):
                    w = hashes[begin[i] : begin[i + 1]]
                    if len(w) >= WINDOW:
                        names.append(words.name(i))
                        mins.append(np.unique(stretches(w)[2]).view(np.int64))
                        at.append(a + i)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(names, pa.string()), pa.array(mins, pa.list_(pa.int64()))], names=["doc_id", "sequence", "mins"]
            )

    return _texts(docs).where("doc_id IS NOT NULL").mapInArrow(run, "doc_id long, sequence string, mins array<long>")


def _shared(grams: DataFrame, hot: int) -> DataFrame:
    """(doc_id, m, crowded): minimizers that more than one row has. They are counted with a combine before the shuffle, and
    the rows of a frequent one meet its count in a join that Spark may split."""
    rows = grams.select(F.explode("mins").alias("m"), "doc_id")
    counts = written(rows.groupBy("m").agg(F.count("*").alias("c")).where("c > 1"), "counts")
    out = written(rows.join(counts, "m").select("doc_id", "m", (F.col("c") > hot).alias("crowded")), "shared")
    discard(counts)
    return out


def _cut(docs: DataFrame, wanted: DataFrame, shards: int, single: bool) -> DataFrame:
    """STRETCH rows of the stretches whose minimizers are wanted: (doc_id, ms). ``single`` takes each window alone, and
    its hash is its shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            ids = batch.column(0).to_numpy()
            found: dict[tuple[int, int, bytes], tuple[list[int], list[int]]] = {}
            for a, b, data, offsets in hasher.pieces(_unpacked(batch.column(1))):
                words = hasher.words(data, offsets)
                hashes, first_byte, end_byte, begin = words.hashes(), words.first, words.end, words.begin
                for i in range(b - a):
                    w = hashes[begin[i] : begin[i + 1]]
                    pos, n, mins = stretches(w)
                    mine = np.isin(mins.view(np.int64), np.asarray(batch.column(2)[a + i].values))
                    pos, n, mins = pos[mine], n[mine], mins[mine]
                    if not len(pos):
                        continue
                    if single:
                        pos = np.repeat(pos - np.cumsum(n) + n, n) + np.arange(n.sum())
                        n = np.ones(len(pos), np.int64)
                        shard = window_hashes(w, WINDOW)[pos].view(np.int64)
                    else:
                        shard = (mins >> np.uint64(1)).astype(np.int64) % shards
                    base = first_byte[begin[i]]
                    raw = data[base : end_byte[begin[i + 1] - 1]].tobytes()
                    begins, ends = first_byte[begin[i] + pos] - base, end_byte[begin[i] + pos + n + WINDOW - 2] - base
                    d = int(ids[a + i])
                    for h, k, p, x, y in zip(shard.tolist(), n.tolist(), pos.tolist(), begins.tolist(), ends.tolist(), strict=True):
                        docs_of, places = found.setdefault((h, k, raw[x:y]), ([], []))
                        docs_of.append(d)
                        places.append(p)
            if found:
                h, k, content = zip(*found, strict=True)
                docs_of, places = zip(*found.values(), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h, pa.int64()), pa.array(k, pa.int32()), pa.array(content, pa.binary()), pa.array(docs_of, pa.list_(pa.int64())), pa.array(places, pa.list_(pa.int32()))],
                    names=["shard", "n", "content", "docs", "places"],
                )

    return _packed(docs).join(wanted, "doc_id").select("doc_id", "text", "ms").mapInArrow(run, STRETCH)


def _numbered(contents: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, int]:
    """A shard's contents as numbers of their words from 1 on, where each content begins, and the number of words."""
    words = WordHasher().of(contents.to_pylist())
    codes, known = words.codes()
    return codes + 1, words.begin, len(known)


def search(least: np.ndarray, n: np.ndarray, contents: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]:
    """For each stretch of a shard, whose smallest document is ``least``: the smallest document with the same words,
    whether an earlier one holds it whole, and for the others the word intervals [b, e) of that smallest document which
    earlier ones hold in a row, where any has a window's length.

    The index holds the distinct stretches with their smallest documents, and each is searched backward from its end and,
    where it isn't held whole, from every other place at which a window may end.
    """
    words, begin, sigma = _numbered(contents)
    width = int(n.max()) + WINDOW - 1
    padded = np.zeros((len(n), width), np.int64)
    size = n + WINDOW - 1
    padded[np.arange(width)[None, :] < size[:, None]] = words
    # equal rows of words are one distinct stretch
    key = padded.view(np.dtype((np.void, 8 * width))).ravel()
    _, first, which = np.unique(key, return_index=True, return_inverse=True)
    own = np.full(len(first), np.iinfo(np.int64).max)
    np.minimum.at(own, which, least)
    size, n_of = size[first], n[first]
    starts = np.concatenate([[0], np.cumsum(size)])
    flat = words[np.arange(starts[-1]) + np.repeat(begin[first] - starts[:-1], size)]
    index = FMIndex(flat, starts, own, sigma)
    last = index.statistics(flat, starts[:-1], size, own)
    whole = last == size
    # a stretch's other ends: its first window's to its last but one's
    part = np.flatnonzero(~whole)
    more = n_of[part] - 1
    stretch = np.repeat(part, more)
    end = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more) + WINDOW
    stretch, end = np.concatenate([stretch, part]), np.concatenate([end, size[part]])
    length = np.concatenate([index.statistics(flat, starts[stretch[: more.sum()]], end[: more.sum()], own[stretch[: more.sum()]]), last[part]])
    hit = np.flatnonzero(length >= WINDOW)
    hit = hit[np.argsort(stretch[hit], kind="stable")]
    some, at = np.unique(stretch[hit], return_index=True)
    spans = {int(u): (end[h] - length[h], end[h]) for u, h in zip(some, np.split(hit, at[1:]), strict=True)} if len(hit) else {}
    rows = {int(r): spans[int(u)] for r, u in enumerate(which) if int(u) in spans}
    return own[which], whole[which], rows


def _shard_hits(table: pa.Table) -> pa.Table:
    docs, places = (table.column(c).combine_chunks() for c in ("docs", "places"))
    n = table.column("n").to_numpy().astype(np.int64)
    count = docs.value_lengths().to_numpy().astype(np.int64)
    row = np.repeat(np.arange(len(n)), count)
    d, p = docs.flatten().to_numpy(), places.flatten().to_numpy().astype(np.int64)
    own, whole, rows = search(np.minimum.reduceat(d, np.cumsum(count) - count), n, table.column("content"))
    full = whole[row] | (d > own[row])
    ids, begin, end = [d[full]], [p[full]], [p[full] + n[row[full]] + WINDOW - 1]
    for k in np.flatnonzero(~full & np.isin(row, list(rows))):
        b, e = rows[int(row[k])]
        ids.append(np.full(len(b), d[k]))
        begin.append(p[k] + b)
        end.append(p[k] + e)
    return pa.table({"doc_id": pa.array(np.concatenate(ids)), "b": pa.array(np.concatenate(begin).astype(np.int32)), "e": pa.array(np.concatenate(end).astype(np.int32))})


def repeated(docs: DataFrame, shard: int = SHARD, hot: int = HOT) -> DataFrame:
    """(doc_id, b, e): intervals of words that windows of an earlier document cover; e of a copy is ``ALL``."""
    grams = written(_grams(docs), "grams")
    firsts = grams.groupBy("sequence").agg(F.min("doc_id").alias("first"))
    seen = grams.select("sequence", "doc_id").join(firsts, "sequence")
    copies = seen.where("doc_id > first").select("doc_id", F.lit(0).alias("b"), F.lit(ALL).alias("e")).distinct()
    alone = grams.join(seen.where("doc_id > first").select("doc_id"), "doc_id", "left_anti")
    wanted = _shared(alone, hot)
    n_cool, n_hot = (wanted.where(c).count() for c in ("NOT crowded", "crowded"))
    shards = max(1, -(-(n_cool + n_hot) // shard))
    lists = lambda d: d.groupBy("doc_id").agg(F.collect_list("m").alias("ms"))
    hits = _cut(docs, lists(wanted.where("NOT crowded")), shards, False).groupBy("shard").applyInArrow(_shard_hits, "doc_id long, b int, e int")
    if n_hot:
        singles = _cut(docs, lists(wanted.where("crowded")), shards, True).withColumnRenamed("shard", "h")
        least = F.array_min("docs")
        kinds = singles.groupBy("h", "content").agg(F.min(least).alias("doc_id"))
        found = kinds.groupBy(F.pmod(F.col("h"), F.lit(shards)).alias("shard")).applyInArrow(_single_hits, "h long, content binary, least long")
        members = singles.join(found, ["h", "content"]).select("least", F.explode(F.arrays_zip("docs", "places")).alias("m"))
        more = members.where("m.docs > least").select(F.col("m.docs").alias("doc_id"), F.col("m.places").alias("b"), (F.col("m.places") + WINDOW).alias("e"))
        hits = hits.unionByName(more)
    return hits.unionByName(copies)


def _single_hits(table: pa.Table) -> pa.Table:
    """Each single window of a shard with the smallest document that holds it, by search."""
    flat, starts, sigma = _numbered(table.column("content"))
    index = FMIndex(flat, starts, table.column("doc_id").to_numpy(), sigma)
    low, high = np.zeros(len(starts) - 1, np.int64), np.full(len(starts) - 1, index.n, np.int64)
    for k in range(WINDOW - 1, -1, -1):
        low, high = index.extend(low, high, flat[starts[:-1] + k])
    return pa.table({"h": table.column("h"), "content": table.column("content"), "least": pa.array(index.least(low, high))})


def removed(docs: DataFrame, shard: int = SHARD, hot: int = HOT) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed, kept (the words left, joined by one space)."""
    spans = repeated(docs, shard, hot).groupBy("doc_id").agg(F.collect_list("b").alias("bs"), F.collect_list("e").alias("es"))
    d = _packed(docs).join(spans, "doc_id", "left").select("doc_id", "text", "bs", "es")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for a, b, data, offsets in hasher.pieces(_unpacked(batch.column(1))):
                words = hasher.words(data, offsets)
                first_byte, end_byte, begin = words.first, words.end, words.begin
                raw = data.tobytes()
                for i in range(b - a):
                    n = int(begin[i + 1] - begin[i])
                    gone = np.zeros(n + 1, np.int32)
                    if batch.column(2)[a + i].is_valid:
                        np.add.at(gone, np.minimum(batch.column(2)[a + i].values.to_numpy(), n), 1)
                        np.add.at(gone, np.minimum(batch.column(3)[a + i].values.to_numpy(), n), -1)
                    stay = np.flatnonzero(np.cumsum(gone[:-1]) == 0) + begin[i]
                    n_words.append(n)
                    n_removed.append(n - len(stay))
                    kept.append(b" ".join([raw[x:y] for x, y in zip(first_byte[stay].tolist(), end_byte[stay].tolist(), strict=True)]).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept"]
            )

    return d.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")
