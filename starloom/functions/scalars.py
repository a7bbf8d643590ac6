"""Column expressions used by the warehouse models."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F


def clean_money(c: Column) -> Column:
    """Currency text such as ``$1,234.50`` as a double; unreadable text is null."""
    return F.regexp_replace(c, "[$,]", "").try_cast("double")


def parse_timestamp(c: Column, formats: list[str]) -> Column:
    """First format that reads the text."""
    return F.coalesce(c.try_cast("timestamp_ntz"), *[F.try_to_timestamp(c, F.lit(f)).cast("timestamp_ntz") for f in formats])


def safe_key(c: Column) -> Column:
    """Join key for text: trimmed and lower-cased."""
    return F.lower(F.trim(c))


def flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def band(value: Column, bands: list[tuple[int | None, str]]) -> Column:
    """Label of the first band whose upper bound (exclusive) lies above the value; the last has none."""
    out = None
    for upper, label in bands[:-1]:
        out = F.when(value < upper, label) if out is None else out.when(value < upper, label)
    labelled = out.otherwise(bands[-1][1])
    return F.when(value.isNull(), F.lit(None).cast("string")).otherwise(labelled)


# Band limits and labels of the age and seniority dimensions.
AGE_BANDS = [(25, "Under 25"), (35, "25-34"), (45, "35-44"), (55, "45-54"), (None, "55+")]
SENIORITY_BANDS = [(2, "0-1"), (5, "2-4"), (10, "5-9"), (15, "10-14"), (20, "15-19"), (None, "20+")]


def whole_years(earlier: Column, later: Column) -> Column:
    """Completed years between two dates, counted forwards (an age is never negative for a past birth)."""
    not_reached = (F.month(later) * 100 + F.dayofmonth(later)) < (F.month(earlier) * 100 + F.dayofmonth(earlier))
    return F.year(later) - F.year(earlier) - not_reached.cast("int")


def gender_label(c: Column) -> Column:
    text = F.upper(F.coalesce(c, F.lit("")))
    return F.when(text.isin("M", "MALE"), "Male").when(text.isin("F", "FEMALE"), "Female").otherwise("Unknown")


def monday_week(d: Column) -> Column:
    """Week of year starting on Monday, days before the first Monday in week 0."""
    return F.floor((F.dayofyear(d) + 6 - F.weekday(d)) / 7).cast("int")


def month_of_period(period: Column) -> Column:
    """First day of a ``yyyy-MM`` period."""
    return F.to_date(F.concat(period, F.lit("-01")))


def whole_days(now: Column, then: Column) -> Column:
    """Completed 24-hour days between two timestamps."""
    seconds = F.unix_micros(now.cast("timestamp")) - F.unix_micros(then.cast("timestamp"))
    return F.floor(seconds / F.lit(86_400_000_000)).cast("long")


def guarded_ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom == 0, 0.0).otherwise(top.cast("double") / bottom)


def normalised_score(score: Column) -> Column:
    """Lower-is-better score mapped into 0..1; the failure mark -1 becomes 0."""
    return F.when(score == -1, 0.0).otherwise(1 / (1 + score))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def metadata_filter(wanted: dict) -> Column:
    """Condition for a mapping of column to value or list of values, AND-joined."""
    return all_of([F.col(k).isin(list(v)) if isinstance(v, (list, tuple, set)) else F.col(k) == F.lit(v)
                   for k, v in wanted.items()])


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def squared_distance(a: Column, b: Column) -> Column:
    gaps = F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return F.aggregate(gaps, F.lit(0.0), lambda s, v: s + v)


def answer_map(text: Column) -> Column:
    """``@name[value]`` answers as a map of strings; the last of several equal names wins."""
    cleaned = F.translate(text, ",", "")
    segments = F.filter(F.split(cleaned, "@"), lambda s: F.trim(s) != "")
    pairs = F.transform(F.transform(segments, _pieces), lambda p: F.struct(
        F.trim(F.element_at(p, 1)).alias("key"), F.regexp_replace(F.element_at(p, -1), ":", "").alias("value")))

    def last(ps: Column) -> Column:
        return F.filter(ps, lambda p, i: ~F.exists(F.slice(ps, i + 2, F.greatest(F.size(ps), F.lit(1))), lambda q: q["key"] == p["key"]))

    # bound as an element: named twice, the pairs would be made again for every one of them
    return F.transform(F.array(pairs), lambda ps: F.map_from_entries(last(ps)))[0]


def _pieces(segment: Column) -> Column:
    return F.filter(F.split(F.trim(segment), r"[\[\]]"), lambda p: p != "")


def fenced_blocks(text: Column, language: str = "json") -> Column:
    """Contents of the fenced code blocks of one language."""
    return F.regexp_extract_all(text, F.lit(rf"(?s)```{language}\s*\n(.*?)```"), F.lit(1))
