"""Quality rules: a table of thresholds compiled into one native projection.

Each rule bounds one ratio of a document; `verdict()` turns the table into a single boolean expression over the measures of
`measures()`, which reads the text once (one split at white space, one at symbols, one at line ends). There is no user function,
no shuffle and no state: the plan is Scan -> Project, whatever the size of the input, and a huge document costs n log n of its words.

Defined results: a null or empty text has no words, so all measures are 0, ratios with a zero denominator are 0, base_failed is
true and kept false. Rows are judged one by one, so ties and repeated rows get equal verdicts; an empty table gives an empty result.
`measured()` returns only the id and its own columns; `accepted()` adds no column, so other columns can't clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import SPACE, bound

SYMBOLS = "[#*$%&|<>]"
#: Frequent function words of English, French, German and Spanish, lower case.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "was", "for", "it", "with", "as", "on", "be", "at", "by", "this", "are", "or", "from",
    "le", "la", "les", "de", "des", "du", "et", "un", "une", "est", "que", "qui", "dans", "pour", "par", "sur", "pas", "au", "avec", "ce",
    "der", "die", "das", "und", "ein", "eine", "ist", "von", "zu", "den", "dem", "mit", "sich", "im", "nicht", "auf", "für", "es", "auch", "des",
    "el", "los", "las", "y", "en", "por", "con", "una", "para", "se", "del", "al", "lo", "no", "su", "más", "como", "pero", "sus", "o",
)


@dataclass(frozen=True)
class Rule:
    """A document passes if low <= ratio <= high; None leaves that side open. ratio is SQL over the measures."""

    name: str
    ratio: str
    low: float | None = None
    high: float | None = None


#: Ratios are written as products, so that nothing is divided: 100 * part <= percent * whole.
RULES: tuple[Rule, ...] = (
    Rule("mean_word_chars_low", "word_chars - 2 * n_words", low=0),
    Rule("mean_word_chars_high", "word_chars - 15 * n_words", high=0),
    Rule("symbols_per_word", "100 * n_symbols - 30 * n_words", high=0),
    Rule("duplicate_lines", "100 * n_dup_lines - 60 * n_lines", high=0),
    Rule("stop_words", "1000 * n_stop_words - 20 * n_words", low=0),
)
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeat_words(words: Column) -> Column:
    """How many words lie in 3-word windows that the text has twice or more. Windows are sorted by a 64-bit hash, then by their words, then by
    their places; neighbours of equal words are repeats, and each repeated place covers what the one before it hasn't."""
    windows = F.transform(
        F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0))),
        lambda w, i: F.struct(F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)).alias("h"), w.alias("a"), F.get(words, i + 1).alias("b"), F.get(words, i + 2).alias("c"), i.alias("p")),
    )

    def places(s: Column) -> Column:
        equal = lambda x, e: (x["h"] == e["h"]) & (x["a"] == e["a"]) & (x["b"] == e["b"]) & (x["c"] == e["c"])
        same = lambda e, i: F.coalesce(equal(F.get(s, i - 1), e), F.lit(False)) | F.coalesce(equal(F.get(s, i + 1), e), F.lit(False))
        return F.sort_array(F.transform(F.filter(s, same), lambda e: e["p"]))

    start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
    covered = lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last"))
    return F.aggregate(bound(F.sort_array(windows), places), start, covered, lambda a: a["n"])


def measures(text: Column) -> Column:
    """One struct of the counts that rules refer to, all bigint."""
    text = F.coalesce(text, F.lit(""))

    def of_parts(parts: Column) -> Column:
        def of_words(words: Column) -> Column:
            return F.struct(
                F.size(words).cast("bigint").alias("n_words"),
                (F.length(text) - F.size(parts) + 1).cast("bigint").alias("word_chars"),
                _repeat_words(words).cast("bigint").alias("n_repeat_words"),
                F.size(F.filter(words, lambda w: F.lower(w).isin(*STOP_WORDS))).cast("bigint").alias("n_stop_words"),
            )

        return bound(F.filter(parts, lambda p: p != ""), of_words)

    def of_lines(lines: Column) -> Column:
        return F.struct(F.size(lines).cast("bigint").alias("n_lines"), (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"))

    return F.struct(
        bound(F.split(text, SPACE, -1), of_parts).alias("w"),
        bound(F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")), of_lines).alias("l"),
        (F.size(F.split(text, SYMBOLS, -1)) - 1).cast("bigint").alias("n_symbols"),
    )


def verdict(m: Column, rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """(base_failed, kept) over a struct of measures."""
    at = {"n_words": m["w"]["n_words"], "word_chars": m["w"]["word_chars"], "n_repeat_words": m["w"]["n_repeat_words"], "n_stop_words": m["w"]["n_stop_words"], "n_lines": m["l"]["n_lines"], "n_dup_lines": m["l"]["n_dup_lines"], "n_symbols": m["n_symbols"]}
    base = (at["n_words"] < MIN_WORDS) | (100 * at["n_repeat_words"] > MAX_REPEAT_PERCENT * at["n_words"])
    kept = ~base
    for rule in rules:
        value = _ratio(rule.ratio, at)
        kept = kept & (F.lit(True) if rule.low is None else value >= rule.low) & (F.lit(True) if rule.high is None else value <= rule.high)
    return base, kept


def _ratio(ratio: str, at: dict[str, Column]) -> Column:
    """A sum of signed terms `factor * measure` or `measure`."""
    total = F.lit(0).cast("bigint")
    for word in ratio.replace("- ", "+ -").split("+ "):
        sign, term = (-1, word.strip()[1:]) if word.strip().startswith("-") else (1, word.strip())
        factor, _, name = term.rpartition("*")
        total = total + sign * int(factor or 1) * at[name.strip()]
    return total


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, the base measures, base_failed and kept, a row for each row of docs."""
    base = docs.select(F.col(id_col).alias("doc_id"), measures(F.col(text_col)).alias("m"))
    failed, kept = verdict(F.col("m"), rules)
    inside = {"n_dup_lines": "m.l.n_dup_lines", "n_symbols": "m.n_symbols"}
    return base.select("doc_id", *(F.col(inside.get(c, f"m.w.{c}")).alias(c) for c in BASE), failed.alias("base_failed"), kept.alias("kept"))


def accepted(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of docs that pass every rule, with their columns as they are."""
    return docs.where(bound(measures(F.col(text_col)), lambda m: verdict(m, rules)[1]))
