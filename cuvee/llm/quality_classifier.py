"""Compression classifier: a text that a dictionary of good texts compresses better than one of bad texts is good.

Two zstandard dictionaries are built from labelled text. The difference of a text's compressed sizes under the two, over
the square root of its length (it grows with the length, its noise with the root), is the only measure; a calibration that
rises with it makes the probability of label 1: isotonic regression, with a share of ``SLOPE`` of a logistic one, so that
no two measures tie. Labels are read only from rows that are not held out; language, source and id are never inputs.

Bounds of the fit, independent of corpus size: ``PIECES`` pieces of ``PIECE_BYTES`` bytes a class, least hash first,
make a dictionary; ``CALIBRATION`` rows a class, of other ids and least hash first, calibrate on whole texts. Scoring handles every whole
text in Arrow batches without a shuffle.

Defined results: null and empty texts are scored as empty texts; rows without labels are only scored; rows whose id
repeats among the labels count with their greatest label; without labels of both classes every score is the share of
label 1 (0.5 without labels). Repeated rows give repeated results; columns named score or predicted are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .boosting import logistic

PIECES = 6000
PIECE_BYTES = 2000
CALIBRATION = 5000
DICTIONARY_BYTES = 262_144
LEVEL = 3
THRESHOLD = 0.3
SLOPE = 0.01


@dataclass
class Model:
    """Dictionaries, the isotonic calibration's corners (measure, probability), and the logistic one's weights."""

    good: bytes
    bad: bytes
    at: np.ndarray
    share: np.ndarray
    weights: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip(x * self.weights[0] + self.weights[1], -30, 30)
        return (1 - SLOPE) * np.interp(x, self.at, self.share) + SLOPE / (1 + np.exp(-z))


def rising(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression of y on x: the corners of its steps."""
    at, which, count = np.unique(x, return_inverse=True, return_counts=True)
    mean = np.bincount(which, y) / count
    steps: list[list[float]] = []  # mean, weight, first x, last x
    for x, m, n in zip(at.tolist(), mean.tolist(), count.tolist(), strict=True):
        steps.append([m, n, x, x])
        while len(steps) > 1 and steps[-2][0] >= steps[-1][0]:
            m, n, _, last = steps.pop()
            into = steps[-1]
            into[:] = [(into[0] * into[1] + m * n) / (into[1] + n), into[1] + n, into[2], last]
    return np.array([v for s in steps for v in s[2:]]), np.array([s[0] for s in steps for _ in range(2)])


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 5; 0 is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5, F.lit(0)).cast("int")


class Measurer:
    def __init__(self, good: bytes, bad: bytes):
        import zstandard as z

        self.by = [z.ZstdCompressor(level=LEVEL, dict_data=z.ZstdCompressionDict(d)) for d in (good, bad)]

    def measure(self, data: bytes) -> float:
        g, b = (len(c.compress(data)) for c in self.by)
        return (b - g) / max(len(data), 1) ** 0.5


def _labelled(docs: DataFrame, labels: DataFrame, folds: tuple[int, ...], limit: int) -> DataFrame:
    """(text, quality, _h) of at most ``limit`` labelled documents a class, whose ids fall in ``folds``."""
    known = labels.where(F.col("quality").isin(0, 1) & fold(F.col("doc_id")).isin(*folds)).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    known = known.withColumn("_h", F.xxhash64("doc_id"))
    picked = known.where("quality = 1").orderBy("_h", "doc_id").limit(limit).unionAll(known.where("quality = 0").orderBy("_h", "doc_id").limit(limit))
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(picked), "doc_id")


def _measured(d: DataFrame, good: bytes, bad: bytes) -> DataFrame:
    """``d`` (whose last column is a text) with that text's measure in its place."""
    schema = T.StructType([*d.schema.fields[:-1], T.StructField("_x", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = None
        for batch in batches:
            m = m or Measurer(good, bad)
            x = pa.array([m.measure(t.as_py().encode()) for t in batch.column(batch.num_columns - 1)], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], x], names=schema.names)

    return d.mapInArrow(run, schema)


def train(docs: DataFrame, labels: DataFrame) -> Model | float:
    """A model, or the constant score where one class has no labelled text."""
    import zstandard as z

    n = F.size(F.sequence(F.lit(1), F.char_length("text") + 1, F.lit(PIECE_BYTES)))
    at = F.explode(F.sequence(F.lit(0), n - 1)).alias("_at")
    pieces = _labelled(docs, labels, (1, 2), PIECES).where("text <> ''").select("quality", "_h", "doc_id", "text", at)
    pieces = pieces.select("quality", "_h", "doc_id", "_at", F.substr("text", F.col("_at") * PIECE_BYTES + 1, F.lit(PIECE_BYTES)).alias("piece"))
    dicts = []
    for quality in (1, 0):
        # ordered by the id's hash, so that whole documents go in until the bound is met
        rows = pieces.where(F.col("quality") == quality).orderBy("_h", "doc_id", "_at").limit(PIECES).select("piece").collect()
        samples = [s for s in (r.piece.encode() for r in rows) if s]
        if not samples:
            share = labels.where(F.col("quality").isin(0, 1) & (fold(F.col("doc_id")) != 0)).agg(F.avg("quality")).first()[0]
            return 0.5 if share is None else float(share)
        size = min(DICTIONARY_BYTES, max(256, sum(map(len, samples)) // 8))
        try:
            dicts.append(z.train_dictionary(size, samples).as_bytes())
        except z.ZstdError:  # too few samples to train on: their text itself
            dicts.append(b"\n".join(samples)[-DICTIONARY_BYTES:])
    measured = _measured(_labelled(docs, labels, (3, 4), CALIBRATION).select("quality", "_h", "doc_id", "text"), *dicts)
    rows = [r for k in (1, 0) for r in measured.where(F.col("quality") == k).orderBy("_h", "doc_id", "_x").limit(CALIBRATION).select("quality", "_x").collect()]
    if len({r.quality for r in rows}) < 2:
        share = labels.where(F.col("quality").isin(0, 1) & (fold(F.col("doc_id")) != 0)).agg(F.avg("quality")).first()[0]
        return 0.5 if share is None else float(share)
    x, y = np.array(sorted((r["_x"], float(r.quality)) for r in rows)).T
    mean, spread = x.mean(), x.std() + 1e-9
    w = logistic((x - mean)[:, None] / spread, y)
    return Model(*dicts, *rising(x, y), np.array([w[0] / spread, w[1] - w[0] * mean / spread]))


def score(docs: DataFrame, model: Model | float) -> DataFrame:
    """``docs`` with score and predicted."""
    kept = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
    if isinstance(model, float):
        d = docs.select(*kept, F.lit(model).alias("score"))
        return d.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
    d = docs.select(*kept, F.coalesce("text", F.lit("")).alias("_zstd_text"))
    schema = T.StructType([*d.schema.fields[:-1], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = None
        for batch in batches:
            m = m or Measurer(model.good, model.bad)
            x = np.array([m.measure(t.as_py().encode()) for t in batch.column(batch.num_columns - 1)], np.float64)
            p = model.score(x)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32))], names=schema.names)

    return d.mapInArrow(run, schema)
