"""Byte-level BPE: DuckDB recursive queries in each partition encode, an ordered aggregation decodes.

A text is cut by the vocabulary's pattern. Each partition keeps the distinct cuts (pieces) it met; new ones go to an
in-memory DuckDB as token-position rows. A piece that is a token is its own encoding; the others run through a
recursive query whose step joins neighbouring tokens with the merge table and contracts each piece's leftmost pair of
least rank, until no piece has a pair left. Documents are then sequences of piece numbers, and decoding joins token ids
with their bytes and concatenates them in order of position.

The recursion costs a piece's length times its number of contractions, so pieces of more than ``PART`` bytes run as
overlapping parts of that length and are put together exactly: a sequence of tokens is the encoding of its bytes if and
only if each two neighbours are the encoding of theirs, because the first contraction across any boundary would also come
first in those two alone. So where two overlapping parts have the same token at the same place, the first part's tokens
before it and the second's from it on are the encoding of both. Parts without such a place are encoded anew from a
boundary of the first, and longer ones if need be.

Bounds: the merge table follows from the vocabulary (50 thousand tokens here). Texts are taken by ``CHUNK_CHARS``
characters at a time, cut only between documents, new pieces by ``LEARN_BYTES``, ids to decode by ``DECODE_IDS``, and the
piece dictionary is emptied beyond ``DICTIONARY_PIECES``; all only bound memory, never what is encoded. DuckDB works in
memory and may not spill to the worker's disk.

Defined results: a null text is encoded as an empty one, to no ids. Repeated rows give repeated results. Other columns
are kept by ``encode``; columns named ids, n_tokens and decoded are replaced.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK_CHARS = 2_000_000
DICTIONARY_PIECES = 800_000
LEARN_BYTES = 1 << 20
DECODE_IDS = 1_000_000
#: Bytes of a part of a long piece; no less than twice the longest token.
PART = 256

#: One row a merge: tokens l and r, neighbours, become token m, whose number is its rank.
MERGES = """
CREATE TABLE merges AS
SELECT a.id AS l, b.id AS r, v.id AS m
FROM (SELECT id, hex, unnest(range(2, length(hex), 2)) AS cut FROM vocab) v
JOIN vocab a ON a.hex = substr(v.hex, 1, v.cut) JOIN vocab b ON b.hex = substr(v.hex, v.cut + 1)
"""

#: Rows are tokens at (piece << 32) + first byte, up to ``stop``; a step contracts one pair a piece.
ENCODE = """
WITH RECURSIVE whole AS MATERIALIZED (
    SELECT p.w, p.hex, v.id FROM pieces p LEFT JOIN vocab v ON v.hex = p.hex
), steps AS (
    SELECT (p.w << 32) + u.pos AS k, (p.w << 32) + u.pos + 1 AS stop, b.id AS tok, false AS done
    FROM whole p, unnest(range(length(p.hex) // 2)) u(pos) JOIN bytes b ON b.hex = substr(p.hex, 2 * u.pos + 1, 2)
    WHERE p.id IS NULL
    UNION ALL
    SELECT s.k, CASE WHEN s.k = b.k THEN b.stop ELSE s.stop END, CASE WHEN s.k = b.k THEN b.m ELSE s.tok END, b.w IS NULL
    FROM steps s LEFT JOIN (
        SELECT w, (w << 32) + (best & 4294967295) AS k, best >> 32 AS m,
               (w << 32) + (ends >> 32) AS mid, (w << 32) + (ends & 4294967295) AS stop
        FROM (
            SELECT a.k >> 32 AS w, min((m.m << 32) + (a.k & 4294967295)) AS best,
                   arg_min(((a.stop & 4294967295) << 32) + (z.stop & 4294967295), (m.m << 32) + (a.k & 4294967295)) AS ends
            FROM steps a JOIN steps z ON z.k = a.stop JOIN merges m ON m.l = a.tok AND m.r = z.tok
            WHERE NOT a.done AND NOT z.done
            GROUP BY a.k >> 32
        )
    ) b ON b.w = s.k >> 32
    WHERE NOT s.done AND (b.w IS NULL OR s.k <> b.mid)
)
SELECT k >> 32 AS w, k, tok FROM steps WHERE done
UNION ALL
SELECT w, w << 32, id FROM whole WHERE id IS NOT NULL
ORDER BY k
"""

DECODE = """
SELECT doc, string_agg(latin, '' ORDER BY pos) AS latin FROM stream s JOIN vocab v ON v.id = s.id GROUP BY doc
"""


def read_ranks(path: str) -> list[tuple[bytes, int]]:
    """A vocabulary file's tokens and ranks."""
    with open(path, "rb") as f:
        return [(base64.b64decode(a), int(b)) for a, b in (line.split() for line in f if line.strip())]


class Codec:
    """The vocabulary of one task in an in-memory DuckDB, and the pieces it has encoded so far."""

    def __init__(self, ranks: list[tuple[bytes, int]], pattern: str):
        import duckdb
        import regex

        self.cut = regex.compile(pattern).findall
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        self.part = max(PART, 2 * max(len(t) for t, _ in ranks))
        vocab = pa.table(
            {
                "id": pa.array([r for _, r in ranks], pa.int64()),
                "hex": [t.hex() for t, _ in ranks],
                # a byte as the character of that number, moved up so that none is NUL
                "latin": ["".join(chr(b + 256) for b in t) for t, _ in ranks],
            }
        )
        self.con.register("vocab_rows", vocab)
        self.con.execute("CREATE TABLE vocab AS SELECT * FROM vocab_rows")
        self.con.unregister("vocab_rows")
        self.con.execute(MERGES)
        self.con.execute("CREATE TABLE bytes AS SELECT id, hex FROM vocab WHERE length(hex) = 2")
        self.forget()

    def forget(self) -> None:
        import numpy as np

        self.known: dict[str, int] = {}
        self.flat = np.zeros(0, np.uint32)
        self.begin = np.zeros(1, np.int64)

    def contracted(self, pieces: list[bytes]) -> tuple:
        """The encodings of pieces, one after another, as arrays of piece, first byte and token."""
        rows = pa.table({"w": pa.array(range(len(pieces)), pa.int64()), "hex": [p.hex() for p in pieces]})
        self.con.register("pieces", rows)
        got = self.con.execute(ENCODE).fetchnumpy()
        self.con.unregister("pieces")
        return got["w"], got["k"] & 0xFFFFFFFF, got["tok"]

    def learn(self, pieces: list[str]) -> None:
        """Encodes pieces that are new, numbered on from those known."""
        import numpy as np

        todo, size = [], 0
        for i, p in enumerate(p.encode() for p in pieces):
            todo.append(p)
            size += len(p)
            if size >= LEARN_BYTES or i + 1 == len(pieces):
                long = [k for k, p in enumerate(todo) if len(p) > self.part]
                w, _, tok = self.contracted([b"" if len(p) > self.part else p for p in todo])
                n = np.bincount(w, minlength=len(todo))
                if long:
                    found = np.split(tok, np.cumsum(n)[:-1])
                    for k in long:
                        found[k] = self.long_piece(todo[k])
                        n[k] = len(found[k])
                    tok = np.concatenate(found)
                self.flat = np.concatenate([self.flat, tok.astype(np.uint32)])
                self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(n)])
                todo, size = [], 0

    def long_piece(self, piece: bytes):
        """The encoding of a piece of more than a part's bytes, from parts that overlap by half."""
        import numpy as np

        step = self.part // 2
        starts = list(range(0, len(piece) - self.part + 1, step))
        at: list = []
        tok: list = []
        for a in range(0, len(starts), LEARN_BYTES // self.part):
            group = starts[a : a + LEARN_BYTES // self.part]
            ends = [len(piece) if s == starts[-1] else s + self.part for s in group]
            w, pos, ids = self.contracted([piece[s:e] for s, e in zip(group, ends, strict=True)])
            cuts = np.searchsorted(w, np.arange(len(group) + 1))
            for s, b, e in zip(group, cuts[:-1], cuts[1:], strict=True):
                new_at, new_tok = (pos[b:e] + s).tolist(), ids[b:e].tolist()
                if s and not self.joined(at, tok, new_at, new_tok):
                    self.extend(piece, at, tok, s + self.part if s != starts[-1] else len(piece))
                elif not s:
                    at, tok = new_at, new_tok
        return np.array(tok, np.int64)

    @staticmethod
    def joined(at: list[int], tok: list[int], new_at: list[int], new_tok: list[int]) -> bool:
        """Puts an encoding that begins inside another's bytes behind it, where they have a token in common."""
        from bisect import bisect_left

        low = bisect_left(at, new_at[0])
        here = dict(zip(at[low:], zip(tok[low:], range(low, len(at)), strict=True), strict=True))
        for k, (p, t) in enumerate(zip(new_at, new_tok, strict=True)):
            if p in here and here[p][0] == t:
                i = here[p][1]
                at[i:], tok[i:] = new_at[k:], new_tok[k:]
                return True
        return False

    def extend(self, piece: bytes, at: list[int], tok: list[int], end: int) -> None:
        """Encodes on to ``end`` from boundaries of the encoding so far, further back each time, at last from the first."""
        from bisect import bisect_left

        back = self.part // 2
        while True:
            begin = at[max(bisect_left(at, at[-1] - back), 0)] if back < at[-1] else 0
            _, pos, ids = self.contracted([piece[begin:end]])
            new_at, new_tok = (pos + begin).tolist(), ids.tolist()
            if begin == 0:
                at[:], tok[:] = new_at, new_tok
                return
            if self.joined(at, tok, new_at, new_tok):
                return
            back *= 2

    def encode(self, texts: list[str]) -> list:
        """Each text's ids, as arrays of unsigned 32-bit integers."""
        import numpy as np

        if len(self.known) > DICTIONARY_PIECES:
            self.forget()
        cuts = [self.cut(t) for t in texts]
        known = self.known
        new = sorted(set().union(*cuts).difference(known))
        if new:
            known.update(zip(new, range(len(known), len(known) + len(new))))
            self.learn(new)
        out = []
        for c in cuts:
            w = np.fromiter(map(known.__getitem__, c), np.int64, len(c))
            first = self.begin[w]
            n = self.begin[w + 1] - first
            ends = np.cumsum(n)
            at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + n, n)
            out.append(self.flat[at])
        return out

    def decode(self, ids: list) -> list[bytes]:
        """Each sequence's bytes."""
        import numpy as np

        n = np.array([len(x) for x in ids], np.int64)
        flat, doc = np.concatenate([np.zeros(0, np.int64), *ids]).astype(np.int64), np.repeat(np.arange(len(ids)), n)
        out: list[list[bytes]] = [[] for _ in ids]
        for a in range(0, len(flat), DECODE_IDS):
            part = slice(a, a + DECODE_IDS)
            self.con.register("stream", pa.table({"doc": doc[part], "pos": np.arange(len(flat[part])), "id": flat[part]}))
            got = self.con.execute(DECODE).fetchall()
            self.con.unregister("stream")
            for d, latin in got:
                # two bytes a character in UTF-16; the upper ones are all 1
                out[d].append(latin.encode("utf-16-le")[::2])
        return [b"".join(x) for x in out]


#: The worker process's codec, kept for its next task.
_CODECS: dict = {}


def _task_codec(ranks: list[tuple[bytes, int]], pattern: str) -> Codec:
    key = (hash(tuple(ranks)), pattern)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(ranks, pattern)
    return _CODECS[key]


def _chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    begin = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= CHUNK_CHARS:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def encode(docs: DataFrame, ranks_path: str, pattern: str, column: str = "text") -> DataFrame:
    """``docs`` with ids (binary, little-endian unsigned 32-bit), n_tokens and decoded (binary, made from ids again). The vocabulary is read on
    the driver and sent to tasks; its size is fixed by the file."""
    ranks = docs.sparkSession.sparkContext.broadcast((read_ranks(ranks_path), pattern))
    kept = [c for c in docs.columns if c.lower() not in ("ids", "n_tokens", "decoded")]
    d = docs.select(*kept, F.coalesce(F.col(column), F.lit("")).alias("_bpe_text"))
    schema = T.StructType(
        [f for f in d.schema if f.name != "_bpe_text"]
        + [T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType()), T.StructField("decoded", T.BinaryType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        codec = None
        for batch in batches:
            codec = codec or _task_codec(*ranks.value)
            texts = batch.column(batch.num_columns - 1).to_pylist()
            for a, b in _chunks(texts):
                ids = codec.encode(texts[a:b])
                cols = [c.slice(a, b - a) for c in batch.columns[:-1]]
                raw = pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary())
                n = pa.array(np.array([len(x) for x in ids], np.int64))
                yield pa.RecordBatch.from_arrays([*cols, raw, n, pa.array(codec.decode(ids), pa.binary())], names=schema.names)

    return d.mapInArrow(run, schema)
