"""Chat formatting with Spark expressions only.

A conversation's turns are collected, sorted by turn, and adjacent turns of one role are merged. The template is

    <|role:NAME|>text<|more|>text<|end|>

with ``<|more|>`` between the texts of merged turns. In texts and names ``\\`` becomes ``\\b`` and ``<`` becomes ``\\l``
(``|`` becomes ``\\p`` in names), so no control string can occur inside them and reading back is exact. ``loss_spans``
holds the code points [start, end) of each assistant text.

A conversation is formatted in one row, as it is one training sample, in time that follows its length: offsets are summed
in blocks of ``BLOCK`` turns, since an array that grows inside an aggregate is copied at each step. Defined results: a null text or role is empty, null conversation ids form one conversation, turns of equal
number are ordered by role and text, an empty table gives no rows, and other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, NAMED, MORE, END = "<|role:", "|>", "<|more|>", "<|end|>"
LEARNED = "assistant"
BLOCK = 512


def _escaped(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def _plain(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def _blocks(items: Column | str) -> Column:
    """An array's elements in blocks."""
    last = F.greatest(F.ceil(F.size(items) / BLOCK) - 1, F.lit(0)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(items, k * BLOCK + 1, F.lit(BLOCK)))


def formatted(conversations: DataFrame) -> DataFrame:
    """Per conversation: conv_id, formatted, loss_spans (array of struct start, end)."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    d = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("_t"))
    n = F.size("_t")
    first = F.filter(
        F.sequence(F.lit(0), n - 1), lambda i: F.coalesce(F.get("_t", i)["role"] != F.get("_t", i - 1)["role"], F.lit(True))
    )
    d = d.select("conv_id", "_t", first.alias("_first"))
    merged = F.transform(
        "_first",
        lambda s, k: F.struct(
            F.get("_t", s)["role"].alias("role"),
            F.transform(F.slice("_t", s + 1, F.coalesce(F.get("_first", k + 1), n) - s), lambda t: _escaped(t["text"])).alias("texts"),
        ),
    )
    d = d.select("conv_id", merged.alias("_m"))
    name = lambda m: F.replace(_escaped(m["role"]), F.lit("|"), F.lit("\\p"))
    text = F.array_join(F.transform("_m", lambda m: F.concat(F.lit(HEAD), name(m), F.lit(NAMED), F.array_join(m["texts"], MORE), F.lit(END))), "")
    # where each text begins: lengths of all that stands before it
    pieces = F.flatten(
        F.transform(
            "_m",
            lambda m: F.transform(
                m["texts"],
                lambda x, k: F.struct(
                    F.when(k == 0, F.char_length(name(m)) + len(HEAD) + len(NAMED)).otherwise(len(MORE)).alias("before"),
                    F.char_length(x).alias("n"),
                    F.when(k == F.size(m["texts"]) - 1, len(END)).otherwise(0).alias("after"),
                    (m["role"] == LEARNED).alias("learned"),
                ),
            ),
        )
    )
    d = d.select("conv_id", text.alias("formatted"), pieces.alias("_p"))
    d = d.select("conv_id", "formatted", _blocks("_p").alias("_b"))
    length = lambda p: p["before"] + p["n"] + p["after"]
    before = F.transform("_b", lambda b: F.aggregate(b, F.lit(0), lambda a, p: a + length(p)))
    starts = F.aggregate(before, F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.get(a, F.size(a) - 1) + x)))
    d = d.select("conv_id", "formatted", "_b", starts.alias("_s"))
    none = F.array().cast("array<struct<start:int,end:int>>")

    def spans(block: Column, k: Column) -> Column:
        return F.aggregate(
            block,
            F.struct(F.get("_s", k).alias("at"), none.alias("spans")),
            lambda a, p: F.struct(
                (a["at"] + length(p)).alias("at"),
                F.when(
                    p["learned"],
                    F.concat(a["spans"], F.array(F.struct((a["at"] + p["before"]).alias("start"), (a["at"] + p["before"] + p["n"]).alias("end")))),
                )
                .otherwise(a["spans"])
                .alias("spans"),
            ),
            lambda a: a["spans"],
        )

    return d.select("conv_id", "formatted", F.flatten(F.transform("_b", spans)).alias("loss_spans"))


def read_back(chats: DataFrame) -> DataFrame:
    """From ``formatted``'s output alone: conv_id, turns (array of struct role, text), loss_text, formatted_chars."""
    parts = F.split("formatted", END.replace("|", r"\|"))
    d = chats.select("*", F.slice(parts, F.lit(1), F.size(parts) - 1).alias("_segments"))
    role = lambda s: F.regexp_extract(s, r"^<\|role:([^|]*)\|>", 1)
    turns = F.flatten(
        F.transform(
            "_segments",
            lambda s: F.transform(
                F.split(F.substr(s, F.char_length(role(s)) + len(HEAD) + len(NAMED) + 1), MORE.replace("|", r"\|")),
                lambda x: F.struct(_plain(F.replace(role(s), F.lit("\\p"), F.lit("|"))).alias("role"), _plain(x).alias("text")),
            ),
        )
    )
    # a block's stretch of the text is cut first, since finding a code point reads what stands before it
    stretch = lambda b: F.struct(
        b.alias("spans"), F.substr("formatted", F.get(b, F.lit(0))["start"] + 1, F.get(b, F.size(b) - 1)["end"] - F.get(b, F.lit(0))["start"]).alias("s"),
    )
    d = d.select("*", F.transform(_blocks("loss_spans"), stretch).alias("_cut"))
    text = lambda c: F.transform(
        c["spans"], lambda s: _plain(F.substr(c["s"], s["start"] - F.get(c["spans"], F.lit(0))["start"] + 1, s["end"] - s["start"]))
    )
    loss = F.array_join(F.transform("_cut", lambda c: F.array_join(text(c), "")), "")
    return d.select("conv_id", turns.alias("turns"), loss.alias("loss_text"), F.char_length("formatted").cast("long").alias("formatted_chars"))
