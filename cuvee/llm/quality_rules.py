"""Quality rules: one table of thresholds, compiled into one projection of built-in functions.

``measured`` adds the counts of each whole text and ``judged`` the verdict. Everything is evaluated inside the row by
built-in functions: no shuffle, no user function, and a hot source or a group of copies costs what its rows cost.

Defined results: a null or empty text has no words and fails ``n_words``; a text of blanks only likewise. Repeated
input rows give repeated output rows. Other columns of the input are kept; the names this module adds replace columns
of the same name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANK_CLASS, words_of

#: Frequent function words of the four languages of the corpus.
STOP_WORDS = (
    "the of and to in is that for it was on with as be by at are from this an or not have had but which you they were "
    "le la les de des du et en un une est que qui dans pour pas sur au par avec il elle ne se ce "
    "der die das und den von zu mit sich auf für ist im dem nicht ein eine als auch es "
    "el los las del y a que no una con por su para al lo como más o"
).split()


@dataclass(frozen=True)
class Rule:
    """``measure`` must lie within [low, high]; None leaves a side open."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


#: Production thresholds. A rule passes where its measure is null (a ratio over nothing).
RULES = (
    Rule("n_words", "n_words", low=50),
    Rule("repeat_ratio", "n_repeat_words / n_words", high=0.5),
    Rule("symbol_ratio", "n_symbols / n_words", high=0.25),
    Rule("shout_ratio", "n_exclaims / n_words", high=0.5),
    Rule("word_length", "word_chars / n_words", low=1.5, high=25.0),
    Rule("stop_word_ratio", "n_stop_words / n_words", low=0.02),
    Rule("dup_line_ratio", "n_dup_lines / n_lines", high=0.5),
    Rule("ellipsis_line_ratio", "n_ellipsis_lines / n_lines", high=0.5),
    Rule("bullet_line_ratio", "n_bullet_lines / n_lines", high=0.95),
)


def _count(text: Column, pattern: str) -> Column:
    """Characters of ``text`` outside which ``pattern``, a negated class, matches."""
    return F.char_length(F.regexp_replace(text, pattern, "")).cast("long")


def _packed(words: Column, windows: Column) -> Column:
    """Each 3-word window's hash with its position in the low part, sorted: equal windows become neighbours."""
    n = windows.cast("long")

    def one(i: Column) -> Column:
        h = F.shiftrightunsigned(F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)), 2)
        return h - h % n + i

    return F.sort_array(F.transform(F.sequence(F.lit(0), windows - 1), one))


def _twins(items: Column, key) -> Column:
    """Items whose key equals that of a neighbour."""
    return F.filter(
        items,
        lambda x, i: F.coalesce(key(x) == key(F.get(items, i - 1)), F.lit(False))
        | F.coalesce(key(x) == key(F.get(items, i + 1)), F.lit(False)),
    )


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the counts that the rules use.

    n_repeat_words sorts one 64-bit number a window; only windows that meet a neighbour there are compared as words,
    so the count is exact whatever the hash does.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    kept = [c for c in docs.columns if c.lower() not in ADDED]
    d = docs.select(*kept, text.alias("_text"), words_of(text).alias("_words"))
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike(f"[^{BLANK_CLASS}]"))
    d = d.select(
        *kept,
        "_words",
        F.size("_words").alias("_n"),
        F.char_length(F.concat_ws("", "_words")).cast("long").alias("word_chars"),
        _count(F.col("_text"), r"[^#*$%&|<>]+").alias("n_symbols"),
        _count(F.col("_text"), r"[^!]+").alias("n_exclaims"),
        lines.alias("_lines"),
        F.size(F.filter("_words", lambda x: F.lower(x).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
    )
    d = d.withColumn(
        "_sorted",
        F.when(F.col("_n") >= 4, _packed(F.col("_words"), F.col("_n") - 2)).otherwise(F.array().cast("array<bigint>")),
    )
    windows = F.greatest(F.col("_n") - 2, F.lit(1)).cast("long")
    near = _twins(F.col("_sorted"), lambda x: x - x % windows)
    d = d.withColumn(
        "_near",
        F.sort_array(
            F.transform(
                near,
                lambda x: F.struct(F.array_join(F.slice("_words", (x % windows).cast("int") + 1, 3), " ").alias("s"), (x % windows).cast("int").alias("p")),
            )
        ),
    )
    found = F.transform(_twins(F.col("_near"), lambda x: x["s"]), lambda x: F.array(x["p"], x["p"] + 1, x["p"] + 2))
    measures = F.struct(
        F.col("_n").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct(F.flatten(found))).cast("long").alias("n_repeat_words"),
        "n_exclaims",
        "n_stop_words",
        F.size("_lines").cast("long").alias("n_lines"),
        F.size(F.filter("_lines", lambda x: x.rlike(rf"(\.\.\.|…)[{BLANK_CLASS}]*$"))).cast("long").alias("n_ellipsis_lines"),
        F.size(F.filter("_lines", lambda x: x.rlike(rf"^[{BLANK_CLASS}]*[-*•][{BLANK_CLASS}]"))).cast("long").alias("n_bullet_lines"),
    )
    # filters on generated columns stay above them; pushed into a projection, they would repeat every measure
    return d.select(*kept, F.inline_outer(F.array(measures)))


ADDED = {
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_exclaims", "n_stop_words", "n_lines",
    "n_ellipsis_lines", "n_bullet_lines", "base_failed", "failed_rules", "kept",
}


def _holds(rule: Rule) -> Column:
    over, _, under = rule.measure.partition(" / ")
    value = F.try_divide(F.col(over).cast("double"), F.col(under).cast("double")) if under else F.col(over).cast("double")
    ok = F.lit(True)
    if rule.low is not None:
        ok = ok & (value >= rule.low)
    if rule.high is not None:
        ok = ok & (value <= rule.high)
    return F.coalesce(ok, F.lit(True))


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``measured`` with base_failed, failed_rules (their names, in table order) and kept."""
    d = measured(docs)
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    failed = F.array_compact(F.array(*[F.when(~_holds(r), F.lit(r.name)) for r in rules]).cast("array<string>"))
    return d.select("*", base.alias("base_failed"), failed.alias("failed_rules"), (~base & F.forall(failed, lambda _: F.lit(False))).alias("kept"))


def apply_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that every rule and the base tests pass, with the columns of ``docs``."""
    row = F.struct(*[F.col(c) for c in docs.columns]).alias("_row")
    d = judged(docs.select(F.col("text").alias("text"), row), rules)
    return d.where("kept").select("_row.*")
