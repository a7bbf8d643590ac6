"""Text expressions: answers, chunks, sections, fingerprints and JSON repair.

Nearly all are column expressions over the whole text.  The Arrow helpers at
the end work on one row at a time, where a shuffle would cost more than the
row's own work.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, StringType, StructField, StructType

from starloom.functions.alike import alike
from starloom.functions.rows import by_row, by_tokens

# ASCII punctuation, the articles, and the number, sentence and box patterns.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
ARTICLES = "(?U)\\b(a|an|the)\\b"
NUMBER = r"[-+]?\d+(?:,\d{3})*(?:\.\d+)?|\d+\.\d+"
SENTENCE_END = r"(?U)(?<!\d)[.!?]\s+"
# Without an alternative inside the star: the Java matcher calls itself for each one and runs out of stack on long answers.
BOXED = r"\\boxed\{([^{}]*(?:\{[^{}]*\}[^{}]*)*)\}"


def normalize_answer(text: Column) -> Column:
    """Lower-cased, without punctuation and articles, blanks collapsed; in that order."""
    plain = F.translate(F.lower(text), PUNCTUATION, "")
    return F.trim(F.regexp_replace(F.regexp_replace(plain, ARTICLES, " "), r"(?U)\s+", " "))


def answer_tokens(text: Column) -> Column:
    return F.filter(F.split(normalize_answer(text), " "), lambda t: t != "")


def last_number(text: Column) -> Column:
    found = F.regexp_extract_all(text, F.lit(NUMBER), F.lit(0))
    return F.replace(F.try_element_at(found, F.lit(-1)), F.lit(","), F.lit("")).try_cast("double")


def final_answer(text: Column) -> Column:
    """Content of the last box, else the last sentence."""
    boxed = F.regexp_extract_all(text, F.lit(BOXED), F.lit(1))
    sentences = F.filter(F.transform(F.split(text, SENTENCE_END), lambda s: _strip(s)), lambda s: s != "")
    return F.when(F.size(boxed) > 0, _strip(F.element_at(boxed, -1))).otherwise(
        F.coalesce(F.try_element_at(sentences, F.lit(-1)), F.lit(""))
    )


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def parse_digits(text: Column) -> Column:
    """Number, or a percentage as a fraction; otherwise null."""
    plain = F.trim(F.replace(text, F.lit(","), F.lit("")))
    share = F.regexp_extract(plain, r"^(.*?)\\?%$", 1).try_cast("double") / 100
    return F.coalesce(plain.try_cast("double"), share)


def numbers_close(a: Column, b: Column, absolute: float = 1e-6, relative: float = 0.0) -> Column:
    limit = F.greatest(F.lit(absolute), F.lit(relative) * F.greatest(F.abs(a), F.abs(b)))
    return F.abs(a - b) <= limit


def math_equal(prediction: Column, reference: Column) -> Column:
    """Equal as text, or as numbers within 1e-3 or one part in 1e9."""
    close = numbers_close(parse_digits(prediction), parse_digits(reference), 1e-3, 1e-9)
    return (prediction == reference) | F.coalesce(close, F.lit(False))


def word_count(text: Column) -> Column:
    """Whitespace token count; stands in for a model tokenizer and can be replaced by any expression."""
    return F.size(F.filter(F.split(text, r"\s+"), lambda t: t != ""))


def char_windows(text: Column, window: int) -> Column:
    """Overlapping character windows (20 shared when the window is longer than 20).

    Stops at the first window overrunning the end; a text that fits exactly
    still yields one more tail window.
    """
    step = window - 20 if window > 20 else window
    total = F.length(text)
    last = F.least(F.floor((total - window) / step) + 1, F.floor((total - 1) / step)).cast("int")
    cut = F.transform(F.sequence(F.lit(0), last), lambda i: F.substr(text, i * step + 1, F.lit(window)))
    return F.when(total <= window, F.array(text)).otherwise(cut)


def split_evenly(parts: Column, count: int) -> Column:
    """An array cut into ``count`` consecutive runs, the remainder going to the front ones."""
    n = F.size(parts)
    size, extra = F.floor(n / count).cast("int"), n % count
    runs = []
    for i in range(count):
        start = size * i + F.least(F.lit(i), extra)
        runs.append(F.array_join(F.slice(parts, start + 1, size + (F.lit(i) < extra).cast("int")), ""))
    return F.array(*runs)


def split_paragraph(text: Column, count: int = 2) -> Column:
    """Cut at full stops, else at commas, else anywhere, into ``count`` parts."""
    stops = F.regexp_extract_all(text, F.lit(r"(?s)[^.]*\.|[^.]+"), F.lit(0))
    commas = F.regexp_extract_all(text, F.lit(r"(?s)[^,]*,|[^,]+"), F.lit(0))
    letters = F.regexp_extract_all(text, F.lit(r"(?s)."), F.lit(0))
    parts = F.when(F.size(stops) > 1, stops).when(F.size(commas) > 1, commas).otherwise(letters)
    return split_evenly(parts, count)


def first_fitting(candidates: Column, limit: int, tokens=word_count) -> Column:
    """First candidate with fewer tokens than the limit; none raises."""
    fits = F.filter(candidates, lambda c: tokens(c) < limit)
    return F.when(F.size(fits) > 0, F.try_element_at(fits, F.lit(1))).otherwise(
        F.raise_error(F.lit("no candidate is below the token limit")).cast("string")
    )


def fingerprint(text: Column) -> Column:
    return F.sha2(text, 256)


def tagged_section(text: Column, tag: str = "CONTENT") -> Column:
    """Trimmed text between [TAG] and [/TAG]; null when absent."""
    pattern = rf"(?s)\[{tag}\](.*?)\[/{tag}\]"
    return F.when(text.rlike(pattern), _strip(F.regexp_extract(text, pattern, 1)))


def role_and_text(text: Column) -> Column:
    """``[ROLE]: text`` as a struct; without the mark the role is null and the text whole."""
    pattern = r"^\[([A-Z]+)\]:\s*(.+)"
    hit = text.rlike(pattern)
    return F.struct(F.when(hit, F.regexp_extract(text, pattern, 1)).alias("role"),
                    F.when(hit, F.regexp_extract(text, pattern, 2)).otherwise(text).alias("text"))


# Fixed value: one ballot line of a vote log.
BALLOT = r"(\w+)\(([^\)]+)\): \d+ \| I vote to eliminate (\w+)"
# Splits the log, so it has no group, and its dots are dots.
VOTE_CALL = r"\[[^\]]+\]. Say ONLY: I vote to eliminate \.\.\."


def vote_chunks(log: Column) -> Column:
    """(vote_round, text) of a log between the calls to vote; blank parts keep their number but are dropped."""
    parts = F.transform(F.split(log, VOTE_CALL),
                        lambda t, i: F.struct(F.concat(F.lit("vote_"), i.cast("string")).alias("vote_round"), F.trim(t).alias("text")))
    return F.filter(parts, lambda p: p["text"] != "")


def ballots(text: Column) -> Column:
    """Ballot lines as an array of (voter, role, target)."""
    voter, role, target = (F.regexp_extract_all(text, F.lit(BALLOT), F.lit(g)) for g in (1, 2, 3))
    return F.transform(
        F.arrays_zip(voter, role, target), lambda z: F.struct(z["0"].alias("voter"), z["1"].alias("role"), z["2"].alias("target")))


def is_json(text: Column) -> Column:
    """Exactly one JSON value.  The parser ignores what follows a value, so the text
    must also hold as the only element of a list and of an object."""
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))).isNotNull()
    member = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}"))).isNotNull()
    return F.coalesce(listed & member, F.lit(False))


def repair_json(text: Column) -> Column:
    """Drop one stray bracket at either end and comments outside quoted strings."""
    t = _strip(text)
    trimmed = (
        F.when(t.startswith("[{"), F.substr(t, F.lit(2)))
        .when(t.endswith("}]"), F.substr(t, F.lit(1), F.length(t) - 1))
        .when(t.startswith("{") & t.endswith("]"), F.concat(F.substr(t, F.lit(1), F.length(t) - 1), F.lit("}")))
        .otherwise(t)
    )
    return F.regexp_replace(trimmed, r"""("[^"\n]*"|'[^'\n]*')|[ \t]*(?:#|//)[^\n]*""", "$1")


def _section_names(keys: list[str]) -> dict[str, set[str]]:
    """Section name -> the marks of it that the keys ask for."""
    asked: dict[str, set[str]] = {}
    for key in keys:
        if key.startswith("[") and key.endswith("]"):
            asked.setdefault(key.strip("[/]"), set()).add(key)
    return asked


def _mended_section(text: str, name: str, asked: set[str]) -> str:
    """One scan finds the marks of a section in any case; then its start and its end are decided once.

    A mark that occurs in another case only takes the asked form.  A missing start goes to
    the top.  For a missing end, the last of several starts becomes the end unless a body
    that ends in a bracket follows it; otherwise the end follows the last bracket, and
    what stands around that last section goes.
    """
    start, end = f"[{name}]", f"[/{name}]"
    pieces = re.split(rf"(?i)(\[/?{re.escape(name)}\])", text)  # plain text and marks in turn
    written = set(pieces[1::2])
    for form in asked - written:
        pieces[1::2] = [form if mark.lower() == form.lower() else mark for mark in pieces[1::2]]
    if start not in pieces[1::2]:
        pieces = ["", start, "\n" + pieces[0], *pieces[1:]]
    if end in pieces[1::2]:
        return "".join(pieces)
    starts = [i for i in range(1, len(pieces), 2) if pieces[i] == start]
    body = "".join(pieces[starts[-1] + 1:])
    bracket = max(body.rfind("}"), body.rfind("]"))
    if bracket < 0 and len(starts) > 1:
        pieces[starts[-1]] = end
        return "".join(pieces)
    if not body.strip():
        return "".join(pieces)
    if bracket == len(body.rstrip()) - 1:
        return "".join(pieces) + "\n" + end
    return start + body[:bracket + 1] + "\n" + end


def repair_sections(text: Column, keys: list[str]) -> Column:
    """Repair the section marks of a text: case, missing halves, a start instead of the end.

    Keys without brackets are words whose case alone is set right.  An Arrow helper: the
    marks of a text are found once, where column expressions would search again per decision.
    """
    sections, words = _section_names(keys), [k for k in keys if not (k.startswith("[") and k.endswith("]"))]

    @F.pandas_udf(StringType())
    def repair(texts: pd.Series) -> pd.Series:
        def one(t):
            if t is None:
                return None
            for word in words:
                if word not in t:
                    t = re.sub(re.escape(word), lambda _: word, t, flags=re.IGNORECASE)
            for name, asked in sections.items():
                t = _mended_section(t, name, asked)
            return t

        return texts.map(one)

    return repair(text)


@F.pandas_udf(StringType())
def decode_unicode_escape(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else t.encode("utf-8").decode("unicode_escape", "ignore"))


def _halves(line: str) -> list[str]:
    """Two parts of an over-long line: by sentence, by clause, or in the middle."""
    for mark in ".,":
        pieces = [p + mark for p in line.split(mark)]
        pieces[-1] = pieces[-1][:-1]
        pieces = [p for p in pieces if p]
        if len(pieces) > 1:
            break
    else:
        pieces = list(line)
    middle = (len(pieces) + 1) // 2
    return ["".join(pieces[:middle]), "".join(pieces[middle:])]


def _within(line: str, budget: int) -> list[str]:
    """The line, or its halves halved again until each has at most ``budget`` words."""
    if len(line.split()) <= budget:
        return [line]
    return [piece for half in _halves(line) for piece in _within(half, budget)]


def _packed(text: str, budget: int) -> list[str]:
    """Cut points from the running word count: each chunk ends at the last piece that its budget reaches."""
    pieces = [piece for line in text.splitlines(keepends=True) for piece in _within(line, budget)]
    reached = np.cumsum([len(p.split()) for p in pieces])
    cuts = [0]
    while cuts[-1] < len(pieces):
        before = reached[cuts[-1] - 1] if cuts[-1] else 0
        cuts.append(int(np.searchsorted(reached, before + budget, side="right")))
    return ["".join(pieces[i:j]) for i, j in zip(cuts, cuts[1:])]


def pack_lines(text: Column, max_tokens: int, reserved: int = 0) -> Column:
    """Whole lines packed greedily into chunks under a token budget (100 kept back); longer lines are halved first."""
    budget = max_tokens - reserved - 100
    if budget < 1:
        raise ValueError("the budget leaves no room for a token")

    return by_row(lambda t: None if t is None else _packed(t, budget), ArrayType(StringType()))(text)


def _overlap_f1(p: Counter, e: Counter) -> float:
    same = (p & e).total()
    if not same:
        return 0.0
    precision, recall = same / p.total(), same / e.total()
    return 2 * precision * recall / (precision + recall)


@F.pandas_udf(DoubleType())
def token_f1(prediction: pd.Series, expected: pd.Series) -> pd.Series:
    """Multiset token F1 of two token arrays; no overlap is 0.

    The overlap concerns one row only, so it is counted where the row lies
    instead of shuffling every token of the corpus.
    """
    scores = [None if p is None or e is None else _overlap_f1(Counter(p), Counter(e)) for p, e in zip(prediction, expected)]
    return pd.Series(scores, dtype="float64")


@F.pandas_udf(DoubleType())
def best_token_f1(outputs: pd.Series, answers: pd.Series) -> pd.Series:
    """The best F1 of any output with any answer, both arrays of token arrays; null where one side has none."""

    def best(o, a):
        if o is None or a is None or not len(o) or not len(a):
            return None
        said, wanted = [Counter(x) for x in o], [Counter(x) for x in a]
        return max(_overlap_f1(x, y) for x in said for y in wanted)

    return pd.Series([best(o, a) for o, a in zip(outputs, answers)], dtype="float64")


def _clipped(a: list, b: list, n: int) -> tuple[int, int]:
    few, many = sorted((Counter(zip(*(t[i:] for i in range(n)))) for t in (a, b)), key=len)
    return sum(min(k, many[g]) for g, k in few.items() if g in many), max(len(a) - n + 1, 0)


BLEU_FIELDS = ["bleu_avg", "bleu1", "bleu2", "bleu3", "bleu4", "brevity_penalty"]


def _bleu(p: list, r: list) -> dict[str, float]:
    precisions = [m / t if t else 0.0 for m, t in (_clipped(p, r, n) for n in range(1, 5))]
    ratio = len(p) / len(r) if r else 0.0
    penalty = 1.0 if ratio > 1.0 else (math.exp(1 - 1 / ratio) if ratio > 0 else 0.0)
    mean = math.exp(sum(math.log(x) for x in precisions) / 4) if min(precisions) > 0 else 0.0
    return dict(zip(BLEU_FIELDS, (mean if penalty else 0.0, *precisions, penalty)))


def bleu(response: Column | str, reference: Column | str) -> Column:
    """BLEU precisions 1-4 of token arrays and their mean without the brevity penalty."""
    return by_tokens(_bleu, StructType([StructField(name, DoubleType()) for name in BLEU_FIELDS]))(response, reference)


def _common_length(a: list, b: list) -> int:
    """Longest common subsequence by bit-parallel rows: one big-integer step per token."""
    places: dict = {}
    for i, t in enumerate(a):
        places[t] = places.get(t, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for t in b:
        hit = row & places.get(t, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def _rouge_l(p: list, r: list) -> float:
    common = _common_length(p, r)
    return 2 * common / (len(p) + len(r)) if common else 0.0


def rouge_l(response: Column | str, reference: Column | str) -> Column:
    """F-measure of the longest common token subsequence."""
    return by_tokens(_rouge_l, DoubleType())(response, reference)


def similar_texts(a: str, b: str, threshold: float) -> Column:
    """Is the matching-block similarity of two text columns above the threshold?"""

    @F.pandas_udf(BooleanType())
    def above(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([alike(x, y, threshold) for x, y in zip(left, right)], dtype=bool)

    return above(F.col(a), F.col(b))
