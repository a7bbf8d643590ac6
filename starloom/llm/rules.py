"""Quality rules: a table of thresholds compiled into one projection, without user functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from starloom.llm.common import covered, let, text_of, windows_of, words_of

SYMBOLS = "#*$%&|<>"
WINDOW = 8
# Frequent function words of the four languages.
STOP_WORDS = ("the of and to in is that it for on was as with be by are this at from a an "
              "der die das und in zu den von mit ist auf für im ein eine nicht von "
              "le la les de des et à un une en que qui dans pour est sur par du "
              "el los las del y en un una que por con para se no al es lo").split()

# ratio, least, most (None: open)
THRESHOLDS = [
    ("n_words", 20, None),
    ("repeat_ratio", None, 0.30),
    ("mean_word_length", 2.0, 20.0),
    ("symbol_ratio", None, 0.10),
    ("stop_word_ratio", 0.02, None),
    ("dup_line_ratio", None, 0.50),
    ("upper_ratio", None, 0.50),
]
RATIOS = [
    ("repeat_ratio", "n_repeat_words", "n_words"),
    ("mean_word_length", "word_chars", "n_words"),
    ("symbol_ratio", "n_symbols", "word_chars"),
    ("stop_word_ratio", "n_stop_words", "n_words"),
    ("dup_line_ratio", "n_dup_lines", "n_lines"),
    ("upper_ratio", "n_upper", "word_chars"),
]


def removed_by(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def repeated_words(words: Column, n: int = WINDOW) -> Column:
    """Words inside n-word windows that occur at least twice in the text.

    Windows are told apart by 64-bit hashes.  Hashes are ordered once per text and equal
    neighbours marked, so the work stays n log n however often a text repeats itself.
    """

    def marked(hashes):
        ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(s):
            twin = F.filter(s, lambda p, k: F.get(s, k - 1)["h"].eqNullSafe(p["h"]) | F.get(s, k + 1)["h"].eqNullSafe(p["h"]))
            return F.array_sort(F.transform(twin, lambda p: p["i"]))

        return let(let(ordered, starts), lambda at: covered(at, lambda s, following: F.least(F.lit(n), F.coalesce(following - s, F.lit(n))).cast("bigint")))

    return let(windows_of(words, n), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("bigint")).otherwise(marked(h)))


def quality_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """The counts that the thresholds use, next to the given columns; a null text counts as empty."""
    whole = text_of(text)
    lines = F.filter(F.split(whole, "\n"), lambda line: F.btrim(line, F.lit(" \t\n\x0b\x0c\r")) != "")
    arrays = docs.withColumns({"_words": words_of(whole), "_lines": lines})
    stop = set(STOP_WORDS)
    return arrays.withColumns({
        "n_words": F.size("_words").cast("bigint"),
        "word_chars": removed_chars(whole),
        "n_symbols": removed_by(whole, SYMBOLS).cast("bigint"),
        "n_lines": F.size("_lines").cast("bigint"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
        "n_repeat_words": repeated_words(F.col("_words")),
        "n_stop_words": F.size(F.filter("_words", lambda w: F.lower(w).isin(*sorted(stop)))).cast("bigint"),
        "n_upper": F.length(F.regexp_replace(whole, "[^\\p{Lu}]+", "")).cast("bigint"),
    }).drop("_words", "_lines")


def removed_chars(whole: Column) -> Column:
    """Code points that are not blanks."""
    return F.length(F.regexp_replace(whole, "[\\x20\\x09-\\x0D]+", "")).cast("bigint")


def verdict(thresholds: list[tuple] = THRESHOLDS) -> Column:
    """One boolean expression from the table; a ratio over nothing is 0."""
    ratios = {name: F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0)) for name, a, b in RATIOS}
    checks = [F.lit(True)]
    for name, least, most in thresholds:
        value = ratios.get(name, F.col(name))
        checks += ([value >= least] if least is not None else []) + ([value <= most] if most is not None else [])
    return reduce(lambda a, b: a & b, checks)


def quality_rules(docs: DataFrame, text: str = "text", thresholds: list[tuple] = THRESHOLDS) -> DataFrame:
    """Statistics, ``base_failed`` and ``kept`` for every document.

    Null and empty texts have no words and fail.  Repeated rows are judged alike and each
    keeps its row.  Columns of the input that have the name of a statistic are replaced.
    """
    counted = quality_statistics(docs, text)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return counted.withColumns({"base_failed": failed, "kept": ~failed & verdict(thresholds)})
