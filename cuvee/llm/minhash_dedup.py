"""Near-duplicate documents by b-bit MinHash.

One pass over the texts makes, per document, the number of its distinct 5-word shingles, a cryptographic digest of its
lower-cased word sequence, a key for each of the bands that ``banded`` gives for the threshold, and the ``BITS`` low bits
of all minima, packed. Documents of equal sequences are collapsed to their smallest doc_id. Those that share a band key
are candidates; the share of equal low bits, corrected for chance collisions, estimates their similarity, and candidates
whose estimate lies within five standard deviations of the threshold or above are confirmed on their full sets, as words:
shingles are hashed (xxh3 of words) only to sketch and to count them. The threshold is a parameter; ``PERCENT`` is op8's. A pair at the threshold misses every band with probability (1 - t**rows)**bands = 3e-7 (32 bands
of 6 minima at 85 percent, 38 of 5 at 80) and the estimate with about as little. Links become components by star
contraction.

Large groups: a band key of up to ``BUCKET`` sets gives its pairs. A larger one gives a star of its members around its
smallest; only where its members are then not yet one component are they compared further, in blocks of ``BLOCK`` by
``BLOCK`` and in two steps. The first compares sizes and signatures, a hundred bytes a member, and lets those pass that come
near a member of another component. Only their texts are fetched, and the second step compares them, holding the sets of
2 * ``FINE`` members at a time; it emits nothing but links between different components. So pairs within a group are never
rows, and no link between components is lost.

Every iteration is written to the shared folder and its predecessor deleted. Defined results: null and texts without words have an empty set, are
kept and link with nothing; a null doc_id links with nothing and is kept; rows that share a doc_id are linked through
it; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, written
from .wordhash import WordHasher, Words, exact_windows, mixed, window_hashes

SHINGLE = 5
PERCENT = 85
HASHES, BITS = 192, 2
#: Bands are so many that a pair at the threshold misses all of them with this probability at most.
MISS = 4e-7
WORDS = HASHES * BITS // 64
BUCKET = 32
BLOCK, FINE = 2048, 128
#: Candidates are confirmed about this many bytes of text at a time.
CONFIRM_BYTES = 4 << 20
SKETCH = "doc_id long, n_shingles long, sequence string, keys array<long>, sig array<long>"


def banded(percent: int) -> tuple[int, int]:
    """(bands, rows): the most minima a band for which a pair at the threshold misses all bands as rarely as MISS."""
    fit = [r for r in range(1, HASHES + 1) if (1 - (percent / 100) ** r) ** (HASHES // r) <= MISS]
    if not 0 < percent <= 100 or not fit:
        raise ValueError(f"{HASHES} minima don't suffice for a threshold of {percent} percent")
    return HASHES // max(fit), max(fit)


def least_matches(percent: int = PERCENT, deviations: float = 5.0) -> int:
    """Equal b-bit minima that a pair at the threshold has but for ``deviations`` standard deviations: chance makes
    2**-BITS of the unequal minima agree."""
    chance = 2.0**-BITS
    p = chance + (1 - chance) * percent / 100
    return int(HASHES * p - deviations * (HASHES * p * (1 - p)) ** 0.5)


def shingle_sets(words: Words) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text of a slice."""
    hashes = words.hashes()
    for a, b in zip(words.begin[:-1], words.begin[1:], strict=True):
        w = hashes[a:b]
        yield np.unique(window_hashes(w, min(SHINGLE, len(w)))) if len(w) else w


class Sketcher:
    def __init__(self, percent: int = PERCENT):
        self.bands, self.rows = banded(percent)
        rng = np.random.default_rng(11)
        self.a = (rng.integers(0, 1 << 31, HASHES) * 2 + 1).astype(np.uint32)[:, None]
        self.b = rng.integers(0, 1 << 32, HASHES).astype(np.uint32)[:, None]
        self.shift = (np.arange(64 // BITS) * BITS).astype(np.uint64)

    def sketch(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Band keys and the packed low bits of the minima of a set that isn't empty."""
        h = (s >> np.uint64(32)).astype(np.uint32)
        low = np.full(HASHES, 0xFFFFFFFF, np.uint32)
        for at in range(0, len(h), 1024):
            part = h[None, at : at + 1024] ^ self.b
            part *= self.a
            part ^= part >> np.uint32(15)
            part *= np.uint32(0x2C1B3C6D)
            np.minimum(low, part.min(axis=1), out=low)
        keys = np.arange(self.bands, dtype=np.uint64)
        for row in low[: self.bands * self.rows].reshape(self.bands, self.rows).T:
            keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + row)
        bits = mixed(low.astype(np.uint64)) & np.uint64((1 << BITS) - 1)
        sig = np.bitwise_or.reduce(bits.reshape(WORDS, -1) << self.shift, axis=1)
        return keys.astype(np.int64), sig.astype(np.int64)


def sketches(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """SKETCH rows of all documents, written to the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, sketcher = WordHasher(lower=True), Sketcher(percent)
        for batch in batches:
            n, names, keys, sigs = [], [], [], []
            for _, _, words in hasher.slices(batch.column(1)):
                for i, s in enumerate(shingle_sets(words)):
                    n.append(len(s))
                    k, g = sketcher.sketch(s) if len(s) else (None, None)
                    names.append(words.name(i) if len(s) else None)
                    keys.append(k)
                    sigs.append(g)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(names, pa.string()), pa.array(keys, pa.list_(pa.int64())), pa.array(sigs, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "sequence", "keys", "sig"],
            )

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return written(d.mapInArrow(run, SKETCH), "sketches")


def matches(a: Column, b: Column) -> Column:
    """Equal b-bit minima of two signatures."""

    def unequal(x: Column, y: Column) -> Column:
        d = x.bitwiseXOR(y)
        folded = d
        for k in range(1, BITS):
            folded = folded.bitwiseOR(F.shiftrightunsigned(d, k))
        lanes = sum(1 << i for i in range(0, 64, BITS))
        return F.bit_count(folded.bitwiseAND(F.lit(lanes - (1 << 64) if lanes >> 63 else lanes)))

    diff = F.lit(0)
    for i in range(WORDS):
        diff = diff + unequal(F.get(a, F.lit(i)), F.get(b, F.lit(i)))
    return F.lit(HASHES) - diff


def packed_texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, packed): the whole texts of some documents, compressed one by one, written."""
    ids = written(ids, "ids")
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).join(ids, "doc_id", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([pack(t.as_buffer()) for t in batch.column(1)], pa.binary())], names=["doc_id", "packed"])

    out = written(d.mapInArrow(run, "doc_id long, packed binary"), "texts")
    discard(ids)
    return out


def confirmed(pairs: DataFrame, docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Those of ``pairs`` (a, b) whose full sets are similar enough, compared as words, written."""
    texts = packed_texts(docs, pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct())
    left, right = (texts.select(F.col("doc_id").alias(c), F.col("packed").alias(f"t{c}")) for c in "ab")

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack, hasher = zstandard.ZstdDecompressor().decompress, WordHasher(lower=True)

        def judged(held: list[bytes], rows: list[tuple[int, int]]) -> list[bool]:
            sets = exact_windows(hasher.of(held), SHINGLE)
            out = []
            for x, y in rows:
                both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                out.append(100 * both >= percent * (len(sets[x]) + len(sets[y]) - both))
            return out

        for batch in batches:
            ok: list[bool] = []
            known, held, rows, size = {}, [], [], 0
            for pair in zip(batch.column("ta").to_pylist(), batch.column("tb").to_pylist(), strict=True):
                for t in pair:
                    if t not in known:
                        known[t] = len(held)
                        held.append(unpack(t))
                        size += len(held[-1])
                rows.append((known[pair[0]], known[pair[1]]))
                if size > CONFIRM_BYTES:
                    ok += judged(held, rows)
                    known, held, rows, size = {}, [], [], 0
            ok += judged(held, rows)
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb")
    out = written(joined.mapInArrow(similar, "a long, b long").distinct(), "links")
    discard(texts)
    return out


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b); component is the smallest id reachable. Stars are contracted
    until nothing changes; a hub's neighbours meet in an aggregate of minima, never in one row."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    before, last = None, ()
    while True:
        # large star: larger neighbours of u move to the least around u
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = written(large, "stars")
        # small star: u and its smaller neighbours move to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        edges = written(small.where("u <> v").distinct(), "stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        discard(large, *last)
        last = (edges,)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(edges.select("v", "v").distinct())


def _near_in(sig: np.ndarray, size: np.ndarray, comp: np.ndarray, x: int, others: np.ndarray, percent: int, least: int) -> np.ndarray:
    """Those of ``others`` in another component than x whose size and signature allow a link with it."""
    near = others[(comp[others] != comp[x]) & (100 * np.minimum(size[others], size[x]) >= percent * np.maximum(size[others], size[x]))]
    d = sig[x] ^ sig[near]
    folded = d.copy()
    for k in range(1, BITS):
        folded |= d >> np.uint64(k)
    lanes = np.uint64(sum(1 << i for i in range(0, 64, BITS)))
    return near[HASHES - np.bitwise_count(folded & lanes).sum(axis=1, dtype=np.int64) >= least]


MEMBER = "key long, i int, j int, rep long, sig array<long>, n long, component long, mine int"


def _columns(table: pa.Table) -> tuple:
    """rep, signatures, sizes, components, and the rows of the first and of the second block."""
    sig = np.stack(table.column("sig").to_numpy(zero_copy_only=False)).astype(np.uint64)
    rep, size, comp, mine = (table.column(c).to_numpy() for c in ("rep", "n", "component", "mine"))
    left, right = (np.flatnonzero(mine == table.column(c)[0].as_py()) for c in "ij")
    return rep, sig, size, comp.copy(), left, right


def _near(hot: DataFrame, percent: int) -> DataFrame:
    """MEMBER rows of those members of each key that lie near one of another component. ``hot`` has key, rep, sig, n,
    component and c, the key's number of members."""
    blocks = F.ceil(F.col("c") / BLOCK).cast("int")
    d = hot.withColumn("mine", F.pmod(F.xxhash64("rep"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    d = d.withColumns({"i": F.least("mine", "other"), "j": F.greatest("mine", "other")})
    least, names = least_matches(percent), [x.split()[0] for x in MEMBER.split(", ")]

    def compare(table: pa.Table) -> pa.Table:
        _, sig, size, comp, left, right = _columns(table)
        keep = np.zeros(len(comp), bool)
        for x in left:
            near = _near_in(sig, size, comp, x, right, percent, least)
            keep[near] = True
            keep[x] |= len(near) > 0
        return table.filter(pa.array(keep)).select(names)

    return d.select(names).groupBy("key", "i", "j").applyInArrow(compare, MEMBER)


def _linked(near: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between different components among MEMBER rows with packed texts, by pair of blocks."""
    least = least_matches(percent)

    def compare(table: pa.Table) -> pa.Table:
        import zstandard

        unpack, hasher = zstandard.ZstdDecompressor().decompress, WordHasher(lower=True)
        rep, sig, size, comp, left, right = _columns(table)
        packed = table.column("packed")
        out: list[tuple[int, int]] = []
        for a in range(0, len(left), FINE):
            for b in range(0, len(right), FINE):
                pairs = [(x, y) for x in left[a : a + FINE] for y in _near_in(sig, size, comp, x, right[b : b + FINE], percent, least)]
                ids = sorted({v for pair in pairs for v in pair})
                sets = dict(zip(ids, exact_windows(hasher.of([unpack(packed[int(v)].as_buffer()) for v in ids]), SHINGLE), strict=True)) if ids else {}
                for x, y in pairs:
                    if comp[x] == comp[y]:
                        continue
                    both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                    if 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both):
                        out.append((int(rep[x]), int(rep[y])))
                        comp[comp == comp[y]] = comp[x]  # further pairs of these two components say nothing new
        return pa.table({"a": pa.array([p[0] for p in out], pa.int64()), "b": pa.array([p[1] for p in out], pa.int64())})

    return near.groupBy("key", "i", "j").applyInArrow(compare, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (smallest doc_id reachable by links, itself included), kept.
    Sets link whose Jaccard similarity is ``percent`` hundredths or more."""
    d = sketches(docs, percent)
    reps = d.where("sequence IS NOT NULL AND doc_id IS NOT NULL").groupBy("sequence").agg(F.min("doc_id").alias("rep"))
    reps = written(reps, "reps")
    own = d.join(reps, "sequence").where("doc_id = rep").select("rep", "keys", "sig", F.col("n_shingles").alias("n"))
    members = own.select("rep", F.explode("keys").alias("key"))
    shared = members.groupBy("key").agg(F.count("*").alias("c"), F.min("rep").alias("hub")).where("c > 1")
    buckets = written(members.join(shared, "key"), "buckets")
    groups = buckets.where(F.col("c") <= BUCKET).groupBy("key").agg(F.sort_array(F.collect_list("rep")).alias("g"))
    pairs = groups.select(F.posexplode("g").alias("k", "a"), "g").select("a", F.explode(F.slice("g", F.col("k") + 2, F.size("g"))).alias("b"))
    stars = buckets.where((F.col("c") > BUCKET) & (F.col("rep") != F.col("hub"))).select(F.col("hub").alias("a"), F.col("rep").alias("b"))
    pairs = pairs.unionByName(stars).where("a <> b").distinct()
    sigs = own.select("rep", "sig")
    likely = (
        pairs.join(sigs.select(F.col("rep").alias("a"), F.col("sig").alias("ga")), "a")
        .join(sigs.select(F.col("rep").alias("b"), F.col("sig").alias("gb")), "b")
        .where(matches(F.col("ga"), F.col("gb")) >= least_matches(percent))
        .select("a", "b")
    )
    likely = written(likely, "likely")
    links = confirmed(likely, docs, percent)
    found = written(components(links), "components")
    discard(likely, links)
    large = buckets.where(F.col("c") > BUCKET)
    if large.limit(1).count():
        large = large.join(own.select("rep", "sig", "n"), "rep").join(found, F.col("rep") == F.col("id"), "left").withColumn("component", F.coalesce("component", "rep"))
        large = written(large.select("key", "rep", "sig", "n", "component", "c"), "large")
        split = large.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("key")
        near = written(_near(large.join(split, "key", "left_semi"), percent), "near")
        discard(large)
        if near.limit(1).count():
            texts = packed_texts(docs, near.select(F.col("rep").alias("doc_id")).distinct())
            more = written(_linked(near.join(texts.withColumnRenamed("doc_id", "rep"), "rep"), percent), "links")
            if more.limit(1).count():
                again = more.unionByName(found.select(F.col("id").alias("a"), F.col("component").alias("b")))
                joined = written(components(again), "components")
                discard(found)
                found = joined
            discard(texts, more)
        discard(near)
    discard(buckets)
    out = d.select("doc_id", "n_shingles", "sequence").join(reps, "sequence", "left").join(found, F.col("rep") == F.col("id"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def deduplicated(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` whose document is the kept one of its component; rows with a null doc_id stay."""
    gone = near_duplicates(docs.select("doc_id", "text"), percent).where("NOT kept").select(F.col("doc_id").alias("_gone"))
    return docs.join(gone, F.col("doc_id") == F.col("_gone"), "left_anti")
