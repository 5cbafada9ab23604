"""Personal data: generators propose spans, boosted trees choose among those that the base patterns don't settle.

Base kinds are found exactly as the fixed patterns below say, but in time linear in the text. Generators of high recall
propose further spans (addresses written with (at), telephone numbers without a plus sign, card numbers with other
separators); trees over format and context features score them and spans above the calibrated threshold are added where
they touch no chosen span. The trees are fitted on the driver from ``EXAMPLES`` generated examples with a fixed seed. A
candidate may be of any length; what a tree sees of its context are the three words before it among ``CONTEXT`` characters.
Numbers are taken with all groups that separators join, so a row of more digits than a card has is no candidate.

Each text is handled by itself in Arrow batches: no shuffle, and a hot source costs what its rows cost. Defined
results: a null text is empty and has no spans; offsets are code points, end exclusive; repeated rows give repeated
results; columns of the input are kept unless they are named as an added one.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .boosting import Boosted, fit

KINDS = ("email", "ip", "card", "phone")
EXAMPLES = 6000

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")

AT = re.compile(r"\x20?[\[({]\x20?(?:at|AT)\x20?[\])}]\x20?|\x20(?:at|AT)\x20(?=[A-Za-z0-9-]+\x20?[\[({]\x20?(?:dot|DOT))")
SPELT = re.compile(r"[A-Za-z0-9-]+(?:(?:\x20?[\[({]\x20?(?:dot|DOT)\x20?[\])}]\x20?|\x20(?:dot|DOT)\x20|\.)[A-Za-z0-9-]+)+")
GROUPS = re.compile(r"(?<![0-9A-Za-z.+/:-])\(?[0-9]+\)?(?:[\x20./-]{1,2}\(?[0-9]+\)?)+(?![0-9A-Za-z])")
RUN = re.compile(r"(?<![0-9A-Za-z.+/:-])[0-9]{9,}(?![0-9A-Za-z])")
CONTEXT = 40


def luhn(digits: str) -> bool:
    total = sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits)))
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _left(text: str, at: int, least: int) -> int:
    """Where the run of local-part characters that ends at ``at`` begins, not before ``least``."""
    while at > least and text[at - 1] in LOCAL:
        at -= 1
    return at


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base kinds, by kind as listed, then start."""
    out: list[tuple[str, int, int]] = []
    at, done = text.find("@"), 0
    while at >= 0:
        begin = _left(text, at, done)
        if begin < at and (m := DOMAIN.match(text, at + 1)):
            out.append(("email", begin, m.end()))
            done = m.end()
        at = text.find("@", at + 1)
    if not DIGIT.search(text):
        return out
    for m in DOTTED.finditer(text):
        parts, begin = m[0].split("."), m.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = begin + len(".".join(four))
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in four):
                out.append(("ip", begin, end))
            begin = end + 1
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(_digits(m[0])) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


def proposals(text: str) -> list[tuple[str, int, int]]:
    """Overlapping spans of high recall beyond the base kinds."""
    out = []
    if "at" in text or "AT" in text:
        done = 0
        for m in AT.finditer(text):
            begin, done = _left(text, m.start(), done), m.end()
            if begin < m.start() and (d := SPELT.match(text, m.end())):
                out.append(("email", begin, d.end()))
    if DIGIT.search(text):
        for m in (*GROUPS.finditer(text), *RUN.finditer(text)):
            n = len(_digits(m[0]))
            if 7 <= n <= 15:
                out.append(("phone", m.start(), m.end()))
            if 13 <= n <= 19:
                out.append(("card", m.start(), m.end()))
    return out


#: Words near a telephone number or a card number, and near other numbers.
PHONE_WORDS = ("call", "phone", "tel", "fax", "mobile", "cell", "whatsapp", "sms", "ring", "telefon", "téléphone", "teléfono", "handy")
CARD_WORDS = ("card", "visa", "mastercard", "amex", "payment", "karte", "carte", "tarjeta")
OTHER_WORDS = ("isbn", "order", "no", "id", "version", "page", "pp", "date", "invoice", "ref", "item", "build", "issn", "lot")
N_FEATURES = 19


def features(text: str, kind: str, begin: int, end: int) -> list[float]:
    """Format and context of a proposed span."""
    s, before = text[begin:end], re.findall(r"[^\W\d_]+", text[max(0, begin - CONTEXT) : begin].lower())[-3:]
    d = _digits(s)
    groups = [len(g) for g in re.findall("[0-9]+", s)]
    seps = re.findall(r"[^0-9()]+", s)
    near = lambda words: float(any(w in words for w in before))
    return [
        float(KINDS.index(kind)), float(len(s)), float(len(d)), float(len(groups)), float(max(groups, default=0)), float(min(groups, default=0)),
        float(groups[-1] if groups else 0), float(len(set(seps))), float(s.count(".")), float(s.count("-")), float(s.count("/")), float("(" in s),
        float(luhn(d)) if d else 0.0, float(len(set(d))), float(bool(re.match(r"(19|20)[0-9]{2}", s))), near(PHONE_WORDS), near(CARD_WORDS), near(OTHER_WORDS),
        float(bool(re.search(r"(?i)[\[({]", s))),
    ]


def _example(rng: np.random.Generator) -> tuple[str, str, int, int, int]:
    """A text with a proposed span: text, kind, start, end, whether it is personal data."""
    num = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    name = lambda: "".join(pick("abcdefghijklmnopqrstuvwxyz") for _ in range(int(rng.integers(3, 9))))
    filler = [name() for _ in range(3)]
    what = int(rng.integers(8))
    if what == 0:
        at, dot = pick([(" [at] ", " [dot] "), (" (at) ", " (dot) "), ("[at]", "[dot]"), (" at ", " [dot] "), ("(at)", ".")])
        kind, s, y = "email", f"{name()}{pick(['', '.' + name(), num(2)])}{at}{name()}{dot}{pick(['com', 'org', 'net', 'de'])}", 1
    elif what == 1:
        sep = pick([" ", "-", ".", " "])
        s = pick([f"({num(3)}) {num(3)}-{num(4)}", sep.join((num(3), num(3), num(4))), sep.join((pick("0") + num(1), num(2), num(2), num(2), num(2)))])
        kind, y = "phone", 1
        filler[-1] = pick([*PHONE_WORDS, filler[-1]])
    elif what == 2:
        d = num(pick([12, 14, 15]))
        d += next(c for c in "0123456789" if luhn(d + c))
        kind, y = "card", 1
        s = pick([d, pick([".", "  ", "/"]).join(d[i : i + 4] for i in range(0, len(d), 4))])
        filler[-1] = pick([*CARD_WORDS, filler[-1]])
    elif what == 3:
        kind, y = "phone", 0
        s = pick([f"{pick(['19', '20'])}{num(2)}-{num(2)}-{num(2)}", f"{num(2)}/{num(2)}/{pick(['19', '20'])}{num(2)}", f"{num(2)}.{num(2)}.20{num(2)}", f"20{num(2)} {num(2)} {num(2)}"])
    elif what == 4:
        kind, y, s = "phone", 0, pick([" ", ", "]).replace(",", "").join(num(int(rng.integers(2, 6))) for _ in range(int(rng.integers(2, 5))))
        filler[-1] = pick([*OTHER_WORDS, filler[-1]])
    elif what == 5:
        kind, y, s = pick(["phone", "card"]), 0, pick([num(int(rng.integers(9, 16))), f"978-{num(1)}-{num(4)}-{num(4)}-{num(1)}", f"{num(4)}-{num(4)}"])
        filler[-1] = pick([*OTHER_WORDS, filler[-1]])
    elif what == 6:
        d = num(16)
        while luhn(d):
            d = num(16)
        kind, y, s = "card", 0, pick([d, " ".join(d[i : i + 4] for i in range(0, 16, 4))])
    else:
        kind, y, s = "phone", 0, pick([f"{num(2)}.{num(2)}.{num(3)}.{num(4)}", f"{num(3)} / {num(4)}", f"{num(3)} {num(3)} {num(3)}"])
        filler[-1] = pick([*OTHER_WORDS, filler[-1]])
    lead = " ".join(filler) + " "
    return lead + s + " " + name(), kind, len(lead), len(lead) + len(s), y


def train(n: int = EXAMPLES, seed: int = 7) -> Boosted:
    """Trees over generated examples; a number written as bare digits counts as personal data only by its context."""
    rng = np.random.default_rng(seed)
    rows = [_example(rng) for _ in range(n)]
    return fit(np.array([features(*r[:4]) for r in rows]), np.array([float(r[4]) for r in rows]))


class Taken:
    """Intervals that may overlap, as a sorted list of disjoint ones."""

    def __init__(self):
        self.begins: list[int] = []
        self.ends: list[int] = []

    def _touching(self, b: int, e: int) -> tuple[int, int]:
        """The range of listed intervals that share a place with [b, e)."""
        low = bisect_left(self.ends, b + 1)
        return low, max(low, bisect_left(self.begins, e))

    def free(self, b: int, e: int) -> bool:
        low, high = self._touching(b, e)
        return low == high

    def add(self, b: int, e: int) -> None:
        low, high = self._touching(b, e)
        if low < high:
            b, e = min(b, self.begins[low]), max(e, self.ends[high - 1])
        self.begins[low:high], self.ends[low:high] = [b], [e]


def spans(text: str, model: Boosted) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(base spans, all spans), each by kind as listed, then start."""
    base = base_spans(text)
    taken = Taken()
    for _, b, e in base:
        taken.add(b, e)
    new = [p for p in proposals(text) if taken.free(p[1], p[2])]
    if not new:
        return base, base
    score = model.probability(np.array([features(text, *p) for p in new]))
    chosen = list(base)
    for i in np.argsort(-score, kind="stable"):
        k, b, e = new[i]
        if score[i] >= model.threshold and taken.free(b, e):
            taken.add(b, e)
            chosen.append((k, b, e))
    return base, sorted(chosen, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def listed(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{b}:{e}" for k, b, e in found)


def redacted(text: str, found: list[tuple[str, int, int]]) -> str:
    """``text`` with each span replaced by its kind in brackets; overlapping spans count as the one that begins first."""
    out, at = [], 0
    for k, b, e in sorted(found, key=lambda s: (s[1], -s[2])):
        if b >= at:
            out += [text[at:b], f"[{k.upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


ADDED = T.StructType([T.StructField(f"n_{k}", T.LongType()) for k in KINDS] + [T.StructField(c, T.StringType()) for c in ("base_spans", "spans", "redacted")])


def find(docs: DataFrame, model: Boosted | None = None, redact: bool = True) -> DataFrame:
    """``docs`` with n_email, n_ip, n_card, n_phone (of base spans), base_spans, spans (kind:start:end, comma-joined) and
    redacted (null unless ``redact``)."""
    model = model or train()
    kept = [c for c in docs.columns if c.lower() not in {f.name for f in ADDED}]
    d = docs.select(*kept, F.coalesce(F.col("text"), F.lit("")).alias("_pii_text"))
    schema = T.StructType([f for f in d.schema if f.name != "_pii_text"] + list(ADDED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(batch.num_columns - 1):
                text = text.as_py()
                base, all_ = spans(text, model)
                rows.append((*[sum(b[0] == k for b in base) for k in KINDS], listed(base), listed(all_), redacted(text, all_) if redact else None))
            new = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int64()] * 4 + [pa.string()] * 3, strict=True)] if rows else [pa.array([], t) for t in [pa.int64()] * 4 + [pa.string()] * 3]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *new], names=schema.names)

    return d.mapInArrow(run, schema)
