"""Quality rules: a threshold table compiled into one projection of built-in functions.

Nulls: a null text has no words. An empty text or one of white space only has no words either; both fail the base
rule. Repeated rows and ties each get a row of their own. Extra columns may be named in ``keep``; columns of the
input never clash with those made here, as only ``id_col`` and ``text_col`` are read. An empty table gives no rows.
Texts of any length are read whole; the work for one text grows as n log n with its words. Write or cache the result before
filtering on it: Spark would push the condition below the projection and work out the measures once more for each mention.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """Keep a document only if ``low <= measure <= high``; a null bound or a null measure never rejects."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in a is that for it was on with as by be are this an at or from "
    "der die und das den von zu mit ist im für auf nicht ein eine dem des sich "
    "le la les des et en un une du est que qui dans pour pas au sur par "
    "el los las del y que se por con para una su al lo como"
).split()

#: The bounds lie far from running text in any script: they reject markup, tables, shouting and lists of junk.
DEFAULT_RULES = (
    Rule("too_many_symbols", "symbol_ratio", high=0.25),
    Rule("too_many_repeated_lines", "dup_line_ratio", high=0.5),
    Rule("words_too_short", "mean_word_length", low=1.5),
    Rule("words_too_long", "mean_word_length", high=20.0),
    Rule("too_few_letters", "letter_ratio", low=0.4),
    Rule("too_few_stop_words", "stop_word_ratio", low=0.005),
)

#: The white space that ends a word; an ASCII subset of what other classes call space.
_WS = "\t\n\u000b\u000c\r"
_SYMBOLS = "#*$%&|<>"


def _without(c: Column, chars: str) -> Column:
    return F.translate(c, chars, "")


def measures(text: Column) -> dict[str, Column]:
    """Columns over ``text``; those that build on others name them in ``words``, ``lines`` and ``places``."""
    flat = F.translate(text, _WS, " " * len(_WS))
    words = F.filter(F.split(flat, " "), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(F.translate(x, _WS, " " * len(_WS))) != "")
    return {"words": words, "lines": lines}


def _repeats(d: DataFrame) -> DataFrame:
    """Adds _places: where 3-word windows start that the text has twice or more; found by a 64-bit hash within one document.

    The hashes alone are sorted first. Only a text in which two neighbours are equal has its windows sorted with their
    places, too, and keeps those next to an equal one.
    """
    hashes = F.expr("CASE WHEN size(_words) >= 3 THEN transform(sequence(2, size(_words) - 1), i -> xxhash64(_words[i - 2], _words[i - 1], _words[i])) ELSE array() END")
    d = d.withColumn("_hashes", hashes).withColumn("_sorted", F.sort_array("_hashes"))
    d = d.withColumn("_twice", F.expr("exists(zip_with(slice(_sorted, 2, size(_sorted)), slice(_sorted, 1, greatest(size(_sorted) - 1, 0)), (a, b) -> a = b), x -> x)"))
    d = d.withColumn("_win", F.expr("CASE WHEN _twice THEN array_sort(transform(_hashes, (h, i) -> named_struct('h', h, 'i', i))) END"))
    kept = (
        "filter(_win, (x, j) -> (j > 0 AND x.h = _win[greatest(j - 1, 0)].h) OR (j < size(_win) - 1 AND x.h = _win[least(j + 1, size(_win) - 1)].h))"
    )
    return d.withColumn("_places", F.expr(f"CASE WHEN _twice THEN sort_array(transform({kept}, x -> x.i)) ELSE array() END"))


def quality_rules(
    docs: DataFrame,
    rules: tuple[Rule, ...] = DEFAULT_RULES,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: tuple[str, ...] = (),
    min_words: int = 50,
    max_repeat_percent: int = 50,
    stop_words: tuple[str, ...] = tuple(STOP_WORDS),
) -> DataFrame:
    """Measures, base verdict, the first rule that a document breaks, and whether it is kept.

    Columns: ``id_col``, ``keep``, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), base_failed,
    kept (boolean), then the ratios that the rules judge and ``broken`` (names of broken rules). No shuffle, one scan.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    m = measures(F.col("_text"))
    d = docs.select(id_col, *keep, text.alias("_text"))
    d = d.select("*", m["words"].alias("_words"), m["lines"].alias("_lines"))
    d = _repeats(d)
    covered = (
        "CASE WHEN size(_places) = 0 THEN 0 ELSE 3 + aggregate(zip_with(slice(_places, 2, size(_places)), slice(_places, 1, size(_places) - 1), "
        "(b, a) -> least(b - a, 3)), 0L, (s, x) -> s + x) END"
    )
    low = F.lower("_text")
    d = d.select(
        id_col,
        *keep,
        F.size("_words").cast("long").alias("n_words"),
        F.length(_without(F.col("_text"), " " + _WS)).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(_without(F.col("_text"), _SYMBOLS))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.expr(covered).cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.length(F.regexp_replace("_text", r"[^\p{L}]+", "")).cast("long").alias("n_letters"),
        F.size(F.filter(F.split(F.translate(low, _WS + ",.;:!?\"()", " " * (len(_WS) + 9)), " "), lambda w: w.isin(*stop_words))).cast("long").alias("n_stop_words"),
    )
    ratio = lambda a, b: F.try_divide(F.col(a).cast("double"), F.col(b).cast("double"))
    d = d.select(
        "*",
        ratio("n_symbols", "word_chars").alias("symbol_ratio"),
        ratio("n_dup_lines", "n_lines").alias("dup_line_ratio"),
        ratio("word_chars", "n_words").alias("mean_word_length"),
        ratio("n_letters", "word_chars").alias("letter_ratio"),
        ratio("n_stop_words", "n_words").alias("stop_word_ratio"),
        ((F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))).alias("base_failed"),
    )
    broken = F.array_compact(F.array(*[F.when(_breaks(r), F.lit(r.name)) for r in rules])) if rules else F.array().cast("array<string>")
    d = d.withColumn("broken", broken)
    first = [id_col, *keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    kept = (~F.col("base_failed") & (F.size("broken") == 0)).alias("kept")
    return d.select(*first, kept, "symbol_ratio", "dup_line_ratio", "mean_word_length", "letter_ratio", "stop_word_ratio", "broken")


def _breaks(r: Rule) -> Column:
    c, out = F.col(r.measure), F.lit(False)
    if r.low is not None:
        out = out | (c < r.low)
    if r.high is not None:
        out = out | (c > r.high)
    return F.coalesce(out, F.lit(False))
