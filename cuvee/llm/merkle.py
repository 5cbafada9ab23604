"""Merkle dataset manifest: an external-memory node store of a tree a group (source) and one tree over the groups' roots.

Digests are lower-case hexadecimal SHA-256, and nodes hash their children's text. A leaf hashes a row's fields, each ``-``
if null, else byte count, ``:`` and value. In a group, leaves ascend by key; every FAN consecutive nodes (the last run may
have fewer, even one) become their parent while more than one remains, and a lone leaf is its group's root. The groups'
roots, in order of the group (null first, by bytes), make the last tree in the same way.

How it is built, so that no group, however large, is one task:

1. **leaf runs**: leaves (digest and key only, never the text) are range-sorted by group and key and written; a leaf's
   place in its group is its place in its run plus the group's leaves in earlier runs;
2. **levels**: a block is FAN ** SPAN consecutive nodes of a group. Tasks read blocks in order and keep only the nodes of
   the current run at each level, so a round makes SPAN levels, and the blocks' tops are the next round's nodes. All are
   rows of the store, Parquet by round and level;
3. **proofs**: from the top round down, a block's stored levels, the siblings above it and its lowest nodes are merged by
   coordinate (group, block, level, place); a node's siblings are read off the levels as its run goes by.

Rounds follow the size by FAN ** SPAN: two at 43 million leaves a group, three beyond. A task holds the upper levels of
one block, at most FAN ** SPAN / (FAN - 1) digests.

Defined results: nulls stand for themselves in any field (a null key is the smallest, a null group a group of its own),
empty texts are ``0:``; repeated rows are leaves of equal digests, each with its own place and proof, equal keys being in
order of their digests. An empty table has no groups and no root. Columns beyond those named are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, scratch, written

FAN = 3
SPAN = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Rows a task emits at a time.
BATCH = 4096


def leaf_digest(fields: list[Column]) -> Column:
    """A row's digest."""

    def told(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))

    return F.sha2(F.concat(*[told(c) for c in fields]), 256)


def _hash(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*[c.to_pylist() for c in b.columns], strict=True)


def _in_batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for r in rows:
        held.append(r)
        if len(held) == BATCH:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def _mapped(d: DataFrame, run, schema: T.StructType) -> DataFrame:
    """``d`` through ``run``, a function of an iterator of row tuples to one of row tuples."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _in_batches(run(_rows(batches)), arrow)

    return d.mapInArrow(go, schema)


def placed(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` as a written table, with place (from 0, in the group's order) and n (the group's rows)."""
    d = leaves = written(rows.withColumn("_row", F.monotonically_increasing_id()), "leaves")
    by = [group, *order, "_row"]
    # in a sorted run this id is the run's number and the row's place in it
    d = d.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_row", F.monotonically_increasing_id())
    d = runs = written(d.withColumns({"_run": F.shiftright("_row", 33), "_at": F.col("_row").bitwiseAND((1 << 33) - 1)}).drop("_row"), "runs")
    parts = d.groupBy(F.col("_run").alias("_r"), F.col(group).alias("_g")).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    whole = Window.partitionBy("_g")
    before = F.coalesce(F.sum("_n").over(whole.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = written(parts.withColumns({"_before": before, "n": F.sum("_n").over(whole)}), "offsets")
    d = d.join(parts, (F.col("_run") == F.col("_r")) & F.col(group).eqNullSafe(F.col("_g")))
    place = F.col("_at") - F.col("_first") + F.col("_before")
    out = written(d.withColumn("place", place).drop("_run", "_at", "_r", "_g", "_first", "_n", "_before"), "placed")
    discard(leaves, runs, parts)
    return out


def _raised(fan: int, span: int, base: int):
    """Rows (group, place, n, digest) in order of group, block and place, to the nodes of ``span`` levels above them."""
    block = fan**span

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        here = None
        size: list[int] = []
        held: list[list[str]] = []
        at: list[int] = []

        def up(level: int) -> Iterator[tuple]:
            """The parent of the run held at ``level``, and those that this completes."""
            while True:
                digest, held[level] = _hash(held[level]), []
                level += 1
                yield here[0], base + level, at[level], size[level], digest
                at[level] += 1
                if level == span:
                    return
                held[level].append(digest)
                if len(held[level]) < fan or size[level] == 1:
                    return

        def end() -> Iterator[tuple]:
            for level in range(span):
                if held[level] and size[level] > 1:
                    yield from up(level)

        for group, place, n, digest in rows:
            if here is None or here != (group, place // block):
                if here is not None:
                    yield from end()
                here = (group, place // block)
                size = [n]
                for _ in range(span):
                    size.append(-(-size[-1] // fan))
                held = [[] for _ in range(span)]
                at = [here[1] * fan ** (span - level) for level in range(span + 1)]
            held[0].append(digest)
            if len(held[0]) == fan and size[0] > 1:
                yield from up(0)
        if here is not None:
            yield from end()

    return run


def _extracted(fan: int, span: int, base: int):
    """A block's rows (group, block, kind, depth, place, n, digest, row, tail): first the siblings above it, then its
    stored levels from the top, then its lowest nodes; to (group, place, n, digest, row, siblings, above)."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        here, tail, levels, first, waiting = None, None, {}, {}, []

        def siblings(place: int, n: int) -> list[str]:
            """Those above the lowest level of the node at ``place``, up to its block's top."""
            out: list[str] = []
            level = 0
            while n > 1 and level < span:
                if level:
                    a = place - place % fan
                    stored, begin = levels[level], first[level]
                    out += [stored[k - begin] for k in range(a, min(a + fan, n)) if k != place]
                place, n, level = place // fan, -(-n // fan), level + 1
            return out

        def told() -> Iterator[tuple]:
            if waiting:
                above = "".join(siblings(waiting[0][0], waiting[0][1]))
                for k, (place, n, digest, row) in enumerate(waiting):
                    own = "".join(w[2] for j, w in enumerate(waiting) if j != k)
                    yield here[0], place, n, digest, row, own + above + tail["siblings"], tail["above"]
                waiting.clear()

        for group, block, kind, depth, place, n, digest, row, more in rows:
            if here is None or here != (group, block):
                yield from told()
                here, tail, levels, first = (group, block), None, {}, {}
            if kind == 0:
                tail = more
            elif kind == 1:
                level = -depth - base
                levels.setdefault(level, []).append(digest)
                first.setdefault(level, place)
            else:
                if waiting and waiting[0][0] // fan != place // fan:
                    yield from told()
                waiting.append((place, n, digest, row))
        yield from told()

    return run


@dataclass(frozen=True)
class Forest:
    """The trees of all groups. ``leaves``: group, place, n, digest and row (what was carried along); ``nodes``: group,
    level, place, n (nodes of that level) and digest, stored by round and level."""

    leaves: DataFrame
    nodes: DataFrame
    rounds: int
    fan: int
    span: int

    def roots(self) -> DataFrame:
        """(group, level, digest): the last node of each group."""
        low = self.leaves.where("n = 1").select("group", F.lit(0).alias("level"), "digest")
        return low.unionByName(self.nodes.where("n = 1").select("group", "level", "digest"))

    def proofs(self, above: DataFrame) -> DataFrame:
        """(group, place, n, digest, row, siblings, above) of every leaf: its siblings' digests up to its group's root,
        level by level, left to right, in one text, then ``above.siblings``. ``above`` has (group, level of its root,
        siblings, above) of each group, and is merged in where the group's top is."""
        block = self.fan**self.span
        of = above.select(F.struct("siblings", "above").alias("t")).schema["t"].dataType.simpleString()
        tails = None
        for r in reversed(range(self.rounds)):
            base = r * self.span
            top = F.expr(f"greatest(level - 1, 0) div {self.span}") == r
            t = above.where(top).select("group", F.lit(0).cast("long").alias("block"), F.struct("siblings", "above").cast(of).alias("tail"))
            t = t if tails is None else t.unionByName(tails)
            none = lambda kind: F.lit(None).cast(kind)
            row_type = self.leaves.schema["row"].dataType if r == 0 else T.StringType()
            low = self.leaves if r == 0 else self.nodes.where((F.col("level") == base) & (F.col("n") > 1)).withColumn("row", none("string"))
            inner = self.nodes.where((F.col("level") > base) & (F.col("level") < base + self.span) & (F.col("n") > 1))
            wide = F.expr(f"place div CAST(pow({self.fan}, {base + self.span} - level) AS BIGINT)")
            parts = t.select("group", "block", F.lit(0).alias("kind"), F.lit(0).alias("depth"), F.lit(0).cast("long").alias("place"), none("long").alias("n"), none("string").alias("digest"), none(row_type).alias("row"), "tail")
            parts = parts.unionByName(inner.select("group", wide.alias("block"), F.lit(1).alias("kind"), (-F.col("level")).alias("depth"), "place", "n", "digest", none(row_type).alias("row"), none(of).alias("tail")))
            parts = parts.unionByName(low.select("group", F.expr(f"place div {block}").alias("block"), F.lit(2).alias("kind"), F.lit(0).alias("depth"), "place", "n", "digest", "row", none(of).alias("tail")))
            parts = parts.repartition("group", "block").sortWithinPartitions("group", "block", "kind", "depth", "place")
            schema = T.StructType([self.leaves.schema["group"], *[T.StructField(c, k) for c, k in (("place", T.LongType()), ("n", T.LongType()), ("digest", T.StringType()), ("row", row_type), ("siblings", T.StringType()), ("above", above.schema["above"].dataType))]])
            found = _mapped(parts, _extracted(self.fan, self.span, base), schema)
            if r == 0:
                return found
            tails = written(found.select("group", F.col("place").alias("block"), F.struct("siblings", "above").cast(of).alias("tail")), "tails")
        raise AssertionError("a forest has at least one round")


def grown(rows: DataFrame, order: list[str], fan: int = FAN, span: int = SPAN) -> Forest:
    """The trees over ``rows`` (group, digest, row and the columns of ``order``)."""
    spark: SparkSession = rows.sparkSession
    leaves = placed(rows, "group", [*order, "digest"]).select("group", "place", "n", "digest", "row")
    store = scratch(spark, "nodes")
    schema = T.StructType([leaves.schema["group"], T.StructField("level", T.IntegerType()), T.StructField("place", T.LongType()), T.StructField("n", T.LongType()), T.StructField("digest", T.StringType())])
    low, r = leaves.drop("row"), 0
    while True:
        base = r * span
        block = F.expr(f"place div {fan**span}")
        ordered = low.select("group", "place", "n", "digest").repartition("group", block).sortWithinPartitions("group", "place")
        _mapped(ordered, _raised(fan, span, base), schema).write.partitionBy("level").parquet(f"{store}/round={r}")
        made = spark.read.schema(schema).option("basePath", store).parquet(f"{store}/round={r}")
        low = made.where((F.col("level") == base + span) & (F.col("n") > 1))
        r += 1
        if low.isEmpty():
            return Forest(leaves, spark.read.schema(schema).option("basePath", store).parquet(store), r, fan, span)


def manifest(rows: DataFrame, fan: int = FAN, span: int = SPAN) -> tuple[DataFrame, DataFrame]:
    """Proofs of ``rows`` (group, key, digest, row) and the store's nodes. A proof: group, place, n, digest, row, siblings
    (up to the root of all), above (struct group_place, n_groups, subroot, root)."""
    trees = grown(rows, ["key"], fan, span)
    subroots = written(trees.roots(), "subroots")
    one = subroots.select(F.lit(0).alias("group"), F.col("group").alias("key"), "digest", F.struct(F.col("group").alias("of"), "level").alias("row"))
    crown = grown(one, ["key"], fan, span)
    root = crown.roots().select("group", "level", F.lit("").alias("siblings"), F.struct(F.col("digest").alias("root")).alias("above"))
    top = crown.proofs(root).select(
        F.col("row.of").alias("group"), F.col("row.level").alias("level"), "siblings",
        F.struct(F.col("place").alias("group_place"), F.col("n").alias("n_groups"), F.col("digest").alias("subroot"), F.col("above.root").alias("root")).alias("above"),
    )
    return trees.proofs(written(top, "tops")), trees.nodes


def fold(digest: Column | str, fan: int = FAN) -> Column:
    """The root of all that a leaf of this digest has with the place and siblings of a row of ``manifest``'s proofs."""

    def climbed(d: str, at: int, place: int, n: int, siblings: str) -> tuple[str, int]:
        while n > 1:
            k, run = place % fan, min(fan, n - place // fan * fan)
            own = siblings[at : at + 64 * (run - 1)]
            at += 64 * (run - 1)
            d = _hash([own[: 64 * k], d, own[64 * k :]])
            place, n = place // fan, -(-n // fan)
        return d, at

    @F.arrow_udf(T.StringType())
    def run(d: pa.Array, place: pa.Array, n: pa.Array, group_place: pa.Array, n_groups: pa.Array, siblings: pa.Array) -> pa.Array:
        out = []
        for x, p, m, gp, gn, s in zip(*[c.to_pylist() for c in (d, place, n, group_place, n_groups, siblings)], strict=True):
            x, at = climbed(x, 0, p, m, s)
            out.append(climbed(x, at, gp, gn, s)[0])
        return pa.array(out, pa.string())

    return run(digest, "place", "n", "above.group_place", "above.n_groups", "siblings")


def document_leaves(docs: DataFrame, changed: Column | None = None) -> DataFrame:
    """``manifest``'s rows of documents: their group is the source, their key the doc_id. ``changed``, a text, adds the
    digest that the row would have with it to what is carried along, for checks against the manifest."""
    fields = [F.col(c) for c in FIELDS]
    digest = leaf_digest(fields)
    other = F.lit(None).cast("string") if changed is None else leaf_digest([changed if c == "text" else F.col(c) for c in FIELDS])
    return docs.select(F.col("source").alias("group"), F.col("doc_id").alias("key"), digest.alias("digest"), F.struct("doc_id", other.alias("changed")).alias("row"))
