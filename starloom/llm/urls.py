"""URL filter: host rules first, then gradient-boosted trees on lexical features of the URL."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from starloom.llm.common import ascii_lower, let, saved

RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
SAMPLE = 200_000  # most labelled URLs that the trees are fitted on
TREES = {"maxIter": 12, "maxDepth": 4, "maxBins": 32, "stepSize": 0.3, "seed": 7}
SMOOTH = 20.0
LEXICAL = ["length", "host_length", "host_labels", "depth", "digit_ratio", "entropy", "parameters", "hyphens", "last_length"]
SUFFIXES = ["suffix_one", "suffix_two"]


def host_of(url: Column) -> Column:
    """Between the first :// and the next / ? # or end, lower-cased; empty without ://."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict."""
    rule, said = F.lit(None).cast("string"), F.lit(None).cast("string")
    for verdict, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        own, _, start = text.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith("/" + start)
        rule, said = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(verdict)).otherwise(said)
    return rule, said


def count_of(text: Column, kept: str) -> Column:
    return F.length(F.regexp_replace(text, f"[^{kept}]+", "")).cast("double")


def entropy(text: Column) -> Column:
    """Bits per character over the text's own characters."""

    def over(characters):
        n = F.size(characters).cast("double")
        share = lambda c: F.size(F.filter(characters, lambda x: x == c)) / n
        return F.aggregate(F.transform(F.array_distinct(characters), share), F.lit(0.0), lambda a, p: a - p * F.log2(p))

    return F.when(F.length(text) > 0, let(F.split(text, ""), lambda c: over(F.filter(c, lambda x: x != "")))).otherwise(0.0)


def lexical_features(urls: DataFrame) -> DataFrame:
    """Adds host, path, suffixes and the numeric features; a null url is an empty one."""
    url = F.coalesce("url", F.lit(""))
    parts = F.split("host", "\\.")
    out = urls.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    return out.withColumns({
        "length": F.length(url).cast("double"),
        "host_length": F.length("host").cast("double"),
        "host_labels": F.size(parts).cast("double"),
        "depth": count_of(F.col("path"), "/"),
        "digit_ratio": F.coalesce(F.try_divide(count_of(url, "0-9"), F.length(url).cast("double")), F.lit(0.0)),
        "entropy": entropy(url),
        "parameters": F.when(F.length(query) > 0, count_of(query, "&") + 1).otherwise(0.0),
        "hyphens": count_of(F.col("host"), "-"),
        "last_length": F.length(F.element_at(F.split("path", "/"), -1)).cast("double"),
        "suffix_one": F.element_at(parts, -1),
        "suffix_two": F.concat(F.element_at(parts, -1), F.lit("/"), F.get(F.split("path", "/"), F.lit(1))),
    })


def suffix_rates(train: DataFrame, suffix: str) -> tuple[DataFrame, float]:
    """Smoothed share of blocked URLs and log count per suffix."""
    mean = train.agg(F.avg("label")).first()[0] or 0.0
    rate = (F.sum("label") + SMOOTH * mean) / (F.count(F.lit(1)) + SMOOTH)
    table = train.groupBy(F.col(suffix).alias(f"_{suffix}")).agg(rate.alias(f"{suffix}_rate"), F.log1p(F.count(F.lit(1)).cast("double")).alias(f"{suffix}_count"))
    return saved(table, suffix), mean


def with_rates(rows: DataFrame, rates: dict) -> DataFrame:
    for suffix, (table, mean) in rates.items():
        rows = rows.join(table, F.col(suffix).eqNullSafe(F.col(f"_{suffix}")), "left").fillna({f"{suffix}_rate": mean, f"{suffix}_count": 0.0}).drop(f"_{suffix}")
    return rows


def bounded_sample(labelled: DataFrame, most: int = SAMPLE) -> DataFrame:
    """All labelled rows, or an even hashed share of them of about ``most`` rows."""
    n = labelled.count()
    return labelled if n <= most else labelled.filter(F.pmod(F.xxhash64("url"), F.lit(1 << 30)) < int((1 << 30) * most / n))


def fit_and_score(featured: DataFrame, labelled: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``block_score`` for all rows, from rows with a ``label`` of 1 (block) or 0 (allow).

    Without both labels there is nothing to learn: the score is then the share of blocked.
    """
    train = bounded_sample(labelled, sample)
    shares = train.agg(F.avg("label"), F.min("label"), F.max("label")).first()
    if shares[1] == shares[2]:
        return featured.withColumn("block_score", F.lit(float(shares[0] or 0.0)))
    rates = {s: suffix_rates(train, s) for s in SUFFIXES}
    inputs = LEXICAL + [f"{s}_{k}" for s in SUFFIXES for k in ("rate", "count")]
    assembler = VectorAssembler(inputCols=inputs, outputCol="_features")
    model = GBTClassifier(labelCol="label", featuresCol="_features", **TREES).fit(assembler.transform(with_rates(train, rates)).select("label", "_features"))
    scored = model.transform(assembler.transform(with_rates(featured, rates)))
    return scored.withColumn("block_score", vector_to_array("probability")[1]).drop("_features", "rawPrediction", "probability", "prediction")


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]] = RULES, sample: int = SAMPLE) -> DataFrame:
    """One verdict per page: the longest fitting rule's, else the trees'.

    The labelled URLs are those that a rule decides.  Null and malformed URLs have an empty
    host and path, fit no rule and are scored like any other; repeated rows keep their rows.
    """
    rows = lexical_features(pages.select("page_id", "url"))
    rule, said = matching_rule(F.col("host"), F.col("path"), rules)
    ruled = rows.withColumns({"rule": rule, "_said": said})
    labelled = ruled.filter(F.col("_said").isNotNull()).withColumn("label", (F.col("_said") == "block").cast("double"))
    scored = fit_and_score(ruled, saved(labelled, "labelled-urls"), sample)
    own = F.when(F.col("block_score") > 0.5, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("_said", own).alias("verdict"), "block_score")
