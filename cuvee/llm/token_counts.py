"""Token counts: prefix dynamic programming over byte-level BPE, stored as a table of exact counts at every prefix.

A sequence of tokens is the encoding of its bytes if and only if each two neighbours are the encoding of theirs. So the
encoding of a piece's first i bytes ends with the one token t, of length l, that the encoding of the first i - l bytes
may stand before, and one pass over the piece gives the count at every prefix: count[i] = count[i - l] + 1. Whether two
tokens may stand together follows from their merges, undone from the last to the first: they may not if a merge across
their boundary would have come before one that made them.

A text's prefix isn't only a prefix of its pieces, because the library cuts a prefix as a text of its own. Three cases
differ and are counted as the library would: a contraction cut short, white space whose last character still belonged to
the next piece, and a special token's string cut short, which is ordinary text. So the table answers every prefix.

The table is one binary value a document (``prefix_counts``): a byte 0 and one signed byte a code point, the step of the
count there; or a byte 1 and four bytes a step where one doesn't fit. Counts may fall as a text grows ("stor" is two tokens,
"store" one), so questions are answered from all steps: ``count_at`` gives the count of any prefix, ``longest_prefix`` the
longest within a budget, ``truncated`` cuts texts there. None encodes again.

Bounds: the merge table follows from the file; a task keeps at most ``KEPT_PIECES`` pieces and ``KEPT_CHARS`` of their code
points, ``KEPT_PAIRS`` answers about pairs, and a batch of texts; all only bound memory. A text takes time in its length,
also as one piece.

Defined results: a null text counts as an empty one, with 0 tokens. Repeated rows give repeated results. Columns named
n_bytes, n_tokens and prefix_counts, in any case, are replaced; all others are kept.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEPT_PIECES = 700_000
KEPT_CHARS = 14_000_000
KEPT_PAIRS = 1_000_000
#: Bytes of text whose pieces are learned together, and of a piece that the next one may share.
CHUNK_BYTES = 2_000_000
KEPT_PREFIX = 1000
ADDED = ("n_bytes", "n_tokens", "prefix_counts")


#: Fixed value: the cutting pattern of the vocabulary's library; contractions, words, numbers, other signs, white space.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Code points below which classes of characters are settled.
EARLY = 0x500


def _early_pattern() -> re.Pattern:
    """``PATTERN`` with its classes written out for characters below ``EARLY``."""

    def those(test) -> str:
        return "".join(re.escape(chr(c)) for c in range(EARLY) if test(unicodedata.category(chr(c))))

    letters, digits = those(lambda k: k[0] == "L"), those(lambda k: k[0] == "N")
    blanks = "".join(re.escape(c) for c in "\t\n\v\f\r \x85\xa0")
    return re.compile(f"'(?:[stmd]|re|ve|ll)| ?[{letters}]+| ?[{digits}]+| ?[^{blanks}{letters}{digits}]+|[{blanks}]+(?![^{blanks}])|[{blanks}]+")


def read_vocabulary(path: str) -> dict:
    """A tokenizer file's token numbers by their bytes, its merges as (left, right) in order of rank, and its special
    tokens. Settings that this module doesn't know are an error."""
    with open(path, encoding="utf-8") as f:
        told = json.load(f)
    model, cut = told["model"], told["pre_tokenizer"]
    plain = all(not model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    special = [t["content"] for t in told["added_tokens"]]
    loose = any(t[k] for t in told["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
    if model["type"] != "BPE" or not plain or told["normalizer"] or cut["type"] != "ByteLevel" or cut["add_prefix_space"] or loose:
        raise ValueError(f"{path}: not a plain byte-level BPE")
    # the file writes a byte as a printable character: itself where it is one, else the next free one from 256 on
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
    raw = lambda s: bytes(byte[c] for c in s)
    ids = {raw(s): i for s, i in model["vocab"].items()}
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    return {"ids": ids, "merges": [(ids[raw(a)], ids[raw(b)]) for a, b in merges], "special": special, "path": path}


class PrefixCounter:
    """Counts at the prefixes of texts, in one task."""

    def __init__(self, vocabulary: dict, pattern: str):
        import regex

        self.cut = regex.compile(pattern).findall
        self.quick, self.other = (_early_pattern().findall, re.compile(f"[^\0-{chr(EARLY - 1)}]")) if pattern == PATTERN else (self.cut, re.compile(""))
        self.ids: dict[bytes, int] = vocabulary["ids"]
        self.path: str = vocabulary["path"]
        self.own = None
        self.special = regex.compile("|".join(map(regex.escape, vocabulary["special"])) or "(?!)")
        self.blanks = regex.compile(r"\s{2,}(?=\S)")
        self.merge = {pair: rank for rank, pair in enumerate(vocabulary["merges"])}
        word = {i: b for b, i in self.ids.items()}
        #: The merge that made a token, and its parts; bytes were made before all merges.
        self.made = dict.fromkeys(word, -1)
        self.parts: dict[int, tuple[int, int]] = {}
        for rank, (a, b) in enumerate(vocabulary["merges"]):
            t = self.ids[word[a] + word[b]]
            if t in self.parts:
                raise ValueError("two merges make one token")
            self.made[t], self.parts[t] = rank, (a, b)
        #: Tokens that their own bytes are encoded as; the others never occur.
        self.live = {t for t in word if t not in self.parts}
        for t, (a, b) in self.parts.items():
            if a in self.live and b in self.live and self._meet(a, b, self.made[t]):
                self.live.add(t)
        #: Live tokens by their bytes, and lengths of those of three bytes and more by their last three, longest first.
        self.tokens = {b: t for b, t in self.ids.items() if t in self.live}
        ends: dict[bytes, set[int]] = {}
        for b in self.tokens:
            if len(b) > 2:
                ends.setdefault(b[-3:], set()).add(len(b))
        self.ends = {e: sorted(ls, reverse=True) for e, ls in ends.items()}
        self.forget()

    def forget(self) -> None:
        self.steps: dict[str, bytes | None] = {"": b""}
        self.wide: dict[str, list[int]] = {}
        self.chars = 0
        self.pairs: dict[tuple[int, int], bool] = {}
        self.lately: tuple[bytes, list[int], list[int]] = (b"", [0], [-1])

    def _meet(self, left: int, right: int, before: int) -> bool:
        """Whether no merge across the boundary of two neighbours comes before the merge ``before``, nor before those
        that made them."""
        after_tie = 0
        merge, made = self.merge, self.made
        first = before < len(merge)
        while True:
            rank = merge.get((left, right))
            if rank is not None and not (first and rank == before) and rank < before + after_tie:
                return False
            first = False
            a, b = made[left], made[right]
            if a < 0 and b < 0:
                return True
            # of equal merges the right one is later; undone on the right, an equal one across the boundary came earlier
            if a > b:
                left, before, after_tie = self.parts[left][1], a, 0
            else:
                right, before, after_tie = self.parts[right][0], b, 1

    def neighbours(self, left: int, right: int) -> bool:
        """Whether the encoding of the two tokens' bytes is these two."""
        key = (left, right)
        out = self.pairs.get(key)
        if out is None:
            if len(self.pairs) >= KEPT_PAIRS:
                self.pairs.clear()
            out = self.pairs[key] = self._meet(left, right, len(self.merge))
        return out

    def byte_counts(self, piece: bytes) -> list[int]:
        """The count at each of 0 to len(piece) bytes of a piece that isn't cut. What the piece before, in the order of
        learning, had in common with it is kept."""
        before, n, last = self.lately
        same = 0
        for a, b in zip(piece, before, strict=False):
            if a != b:
                break
            same += 1
        n, last = n[: same + 1], last[: same + 1]
        token, ends, pairs = self.tokens.get, self.ends.get, self.pairs
        for i in range(same + 1, len(piece) + 1):
            # the longest first; of two bytes and of one there is one length each
            for size in (*ends(piece[i - 3 : i], ()), 2) if i > 2 else (2,) if i > 1 else ():
                if size <= i:
                    t = token(piece[i - size : i])
                    if t is not None:
                        if size == i:
                            break
                        before = last[i - size]
                        fits = pairs.get((before, t))
                        if fits or (fits is None and self.neighbours(before, t)):
                            break
            else:
                size, t = 1, token(piece[i - 1 : i])
            last.append(t)
            n.append(n[i - size] + 1)
        self.lately = (piece, n, last) if len(piece) <= KEPT_PREFIX else (b"", [0], [-1])
        return n

    def counts(self, piece: str) -> list[int]:
        """The count at each prefix, by code points, of a piece as a text of its own."""
        if len(piece) < 4 and piece[:1] == "'" and len(piece) > 1 and piece[1:].isalpha():
            # a contraction: shorter prefixes are cut differently
            return [0, *(sum(self.byte_counts(p.encode())[-1] for p in self.cut(piece[:k])) for k in range(1, len(piece) + 1))]
        raw = piece.encode()
        n = self.byte_counts(raw)
        return n if len(raw) == len(piece) else [0, *(n[i] for i in range(1, len(raw) + 1) if i == len(raw) or raw[i] & 0xC0 != 0x80)]

    def learn(self, pieces: Iterable[str]) -> None:
        for p in sorted(pieces):
            n = self.counts(p)
            d = [b - a for a, b in pairwise(n)]
            try:
                self.steps[p] = array("b", d).tobytes()
            except OverflowError:
                self.steps[p] = None
                self.wide[p] = d
            self.chars += len(p)

    def learn_texts(self, texts: list[str]) -> None:
        """Learns the pieces of ``texts`` together, in order, so that they share what their beginnings have in common."""
        if len(self.steps) > KEPT_PIECES or self.chars > KEPT_CHARS:
            self.forget()
        self.learn(set().union(*map(self.pieces, texts)).difference(self.steps))

    def total(self, piece: str) -> int:
        return int(self.plain_steps([piece]).sum(dtype="int64"))

    def plain_steps(self, pieces: list[str]):
        """The steps of pieces, one after another, as an array."""
        import numpy as np

        known = self.steps
        self.learn(set(pieces).difference(known))
        found = list(map(known.__getitem__, pieces))
        if not self.wide or None not in found:
            return np.frombuffer(b"".join(found), np.int8)  # type: ignore[arg-type]
        return np.concatenate([np.array(self.wide[p], np.int32) if s is None else np.frombuffer(s, np.int8).astype(np.int32) for p, s in zip(pieces, found, strict=True)])

    def pieces(self, text: str) -> list[str]:
        """The library's cuts. Texts of characters below ``EARLY`` alone, whose classes no longer change, are cut by a
        simpler form of the pattern. Characters newer than this Python's tables may be letters to one library alone; texts
        that hold one are cut by the library itself."""
        if self.other.search(text) is None:
            return self.quick(text)
        if any(unicodedata.category(c) == "Cn" for c in set(text)):
            if self.own is None:
                from tokenizers import pre_tokenizers

                self.own = pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str
            return [text[a:b] for _, (a, b) in self.own(text)]
        return self.cut(text)

    def ordinary(self, text: str):
        """The steps of a text in which no string is special."""
        import numpy as np

        out = self.plain_steps(self.pieces(text))
        spots = [m.span() for m in self.blanks.finditer(text)]
        if spots:
            out = out.astype(np.int32)
            for a, b in spots:  # the prefix that ends here takes the whole run of white space as one piece
                more = self.total(text[a:b]) - self.total(text[a : b - 1]) - self.total(text[b - 1])
                out[b - 1] += more
                out[b] -= more
        return out

    def text_steps(self, text: str):
        """The steps of the count at each code point of ``text``."""
        import numpy as np

        if len(self.steps) > KEPT_PIECES or self.chars > KEPT_CHARS:
            self.forget()
        found = list(self.special.finditer(text))
        if not found:
            return self.ordinary(text)
        out, begin = [], 0
        for m in found:
            cut_short = self.ordinary(text[begin : m.end() - 1]).astype(np.int32)
            before = cut_short[: m.start() - begin].sum()
            out += [cut_short, [before + 1 - cut_short.sum()]]
            begin = m.end()
        return np.concatenate([*out, self.ordinary(text[begin:])]).astype(np.int32)


def packed(steps) -> bytes:
    """Steps as the stored value."""
    import numpy as np

    if steps.dtype == np.int8 or not len(steps) or (steps.min() >= -128 and steps.max() <= 127):
        return b"\0" + steps.astype(np.int8).tobytes()
    return b"\1" + steps.astype("<i4").tobytes()


def unpacked(value: bytes):
    """The counts at the prefixes of 0, 1, ... code points."""
    import numpy as np

    steps = np.frombuffer(value, np.int8, offset=1) if value[0] == 0 else np.frombuffer(value, "<i4", offset=1)
    return np.concatenate([np.zeros(1, np.int64), np.cumsum(steps, dtype=np.int64)])


def _chunks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about CHUNK_BYTES of text."""
    import numpy as np

    ends = np.cumsum(np.array([len(t.as_buffer()) for t in texts], np.int64))
    cuts = [0, *(np.flatnonzero(np.diff(ends // CHUNK_BYTES)) + 1).tolist(), len(texts)]
    yield from pairwise(cuts)


#: The worker process's counter, kept for its next task.
_COUNTERS: dict = {}


def _task_counter(vocabulary: dict, pattern: str) -> PrefixCounter:
    key = (vocabulary["path"], len(vocabulary["ids"]), hash(tuple(vocabulary["merges"])), pattern)
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = PrefixCounter(vocabulary, pattern)
    return _COUNTERS[key]


def prefix_table(docs: DataFrame, path: str, pattern: str, column: str = "text") -> DataFrame:
    """``docs`` with n_bytes (of the text in UTF-8), n_tokens and prefix_counts. The vocabulary is read on the driver and
    sent to tasks; its size is fixed by the file."""
    told = docs.sparkSession.sparkContext.broadcast((read_vocabulary(path), pattern))
    kept = [c for c in docs.columns if c.lower() not in ADDED]
    text = F.coalesce(F.col(column), F.lit(""))
    d = docs.select(*kept, F.octet_length(text).cast("long").alias("n_bytes"), text.alias("_counted_text"))
    schema = T.StructType([*d.schema[:-1], T.StructField("n_tokens", T.LongType()), T.StructField("prefix_counts", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = None
        for batch in batches:
            counter = counter or _task_counter(*told.value)
            n, stored = [], []
            texts = batch.column(batch.num_columns - 1)
            for a, b in _chunks(texts):
                some = texts[a:b].to_pylist()
                counter.learn_texts(some)
                for t in some:
                    steps = counter.text_steps(t)
                    n.append(int(steps.sum(dtype="int64")))
                    stored.append(packed(steps))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(n, pa.int64()), pa.array(stored, pa.binary())], names=schema.names)

    return d.mapInArrow(run, schema)


def count_at(at: Column | str, counts: Column | str = "prefix_counts") -> Column:
    """The number of tokens of the text's first ``at`` code points, from the table; null beyond the text or if null."""

    @F.arrow_udf(T.LongType())
    def run(stored: pa.Array, k: pa.Array) -> pa.Array:
        out = []
        for s, i in zip(stored.to_pylist(), k.to_pylist(), strict=True):
            n = unpacked(s) if s is not None and i is not None else ()
            out.append(int(n[i]) if i is not None and 0 <= i < len(n) else None)
        return pa.array(out, pa.int64())

    return run(counts, at)


def longest_prefix(budget: int, counts: Column | str = "prefix_counts") -> Column:
    """struct(chars, tokens) of the longest prefix, in code points, whose count is at most ``budget``."""

    @F.arrow_udf("struct<chars: long, tokens: long>")
    def run(stored: pa.Array) -> pa.Array:
        import numpy as np

        out = []
        for s in stored.to_pylist():
            if s is None:
                out.append(None)
                continue
            n = unpacked(s)
            k = int(np.flatnonzero(n <= budget)[-1])
            out.append({"chars": k, "tokens": int(n[k])})
        return pa.array(out, pa.struct([("chars", pa.int64()), ("tokens", pa.int64())]))

    if budget < 0:
        raise ValueError("a budget is at least 0")
    return run(counts)


def truncated(table: DataFrame, budget: int, column: str = "text") -> DataFrame:
    """``prefix_table``'s rows with the text cut to its longest prefix within ``budget``, and n_bytes and n_tokens of it;
    texts within it keep all. The table column goes, since it holds the whole text's counts."""
    d = table.withColumn("_fit", longest_prefix(budget))
    cut = F.substring(F.col(column), F.lit(1), F.col("_fit.chars").cast("int"))
    new = {column: cut, "n_bytes": F.octet_length(F.coalesce(cut, F.lit(""))).cast("long"), "n_tokens": F.col("_fit.tokens")}
    return d.select([new[c].alias(c) if c in new else F.col(c) for c in table.columns if c != "prefix_counts"])


def over_limit(limit: int) -> Column:
    return F.col("n_tokens") > limit
