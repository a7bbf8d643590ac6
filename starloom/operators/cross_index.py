"""One question set over several indexes: route files to their index, search each, score again, merge."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from starloom.functions import scalars as S
from starloom.functions.rows import element_rows
from starloom.operators.retrieval import half_windows, index_of_path, top_per
from starloom.operators.vectors import top_k
from starloom.session import cut_lineage

# Token counts within which a file is indexed.
FEWEST, MOST = 10_000, 100_000_000


def letter_shares(text: Column) -> Column:
    """A text as the counts of the letters a to z: a plain stand-in for a model's embedding."""
    lower = F.lower(text)
    return F.array(*[(F.length(lower) - F.length(F.replace(lower, F.lit(chr(c))))).cast("double") for c in range(ord("a"), ord("z") + 1)])


def similarity(a: Column, b: Column) -> Column:
    return S.guarded_ratio(S.dot(a, b), F.sqrt(S.dot(a, a)) * F.sqrt(S.dot(b, b)))


def windows(text: Column, longest: int) -> Column:
    """The text, or the two overlapping parts that stand for one which is too long to embed."""
    return F.when(F.length(text) > longest, half_windows(text)).otherwise(F.array(text))


def cross_search(files: DataFrame, questions: DataFrame, path: str, text: str, question_id: str, question: str, tokens: Column,
                 embed: Callable[[Column], Column] = letter_shares, k: int = 5, recall: int = 10, longest: int = 8_000,
                 low: int = FEWEST, high: int = MOST, digits: int = 9) -> DataFrame:
    """(question, path, kind, score, rank): what every question finds over the indexes that the paths belong to.

    A file is routed by its path.  An index gives the k nearest of its files (``node``) and, as
    they are, those outside the token budget (``text``).  The results of all indexes are scored
    anew by their own text, a too long one by the better of its two parts, and the best
    ``recall`` per question stay; equal scores go to the lower path.  Of the unindexed texts
    only those that can stay are ever paired with a question.  Files of no index come back
    once, whole, without question and score (``whole``).
    """
    routed = files.select(F.col(path).alias("path"), F.col(text).alias("__text"), index_of_path(F.col(path)).alias("__index"), tokens.between(low, high).alias("__fits"))
    inside = routed.filter(F.col("__index") != "other")
    asked = cut_lineage(questions.select(question_id, embed(F.col(question)).alias("__vector")))
    nodes = inside.filter("__fits").select("path", "__index", embed(F.col("__text")).alias("__vector"))
    near = top_k(nodes, asked, "path", question_id, "__vector", k, digits=digits, per="__index").select(question_id, "path")
    pieces = element_rows(inside.filter("not __fits"), ["path"], windows(F.col("__text"), longest), "__piece")
    # two parts of one text may both be near, so twice as many give the best texts
    plain = top_k(pieces.select("path", embed(F.col("__piece")).alias("__vector")), asked, "path", question_id, "__vector", 2 * recall, digits=digits)
    plain = plain.groupBy(question_id, "path").agg(F.max("score").alias("score")).withColumn("kind", F.lit("text"))
    parts = element_rows(near.join(inside.select("path", "__text"), "path").join(asked, question_id), [question_id, "path", F.col("__vector").alias("__asked")],
                         windows(F.col("__text"), longest), "__piece")
    scored = parts.select(question_id, "path", F.round(similarity(embed(F.col("__piece")), F.col("__asked")), digits).alias("score"))
    nodes_again = scored.groupBy(question_id, "path").agg(F.max("score").alias("score")).withColumn("kind", F.lit("node"))
    found = plain.unionByName(nodes_again)
    best = top_per(found, question_id, [F.col("score").desc(), F.col("path")], recall)
    whole = routed.filter(F.col("__index") == "other").select(F.lit(None).cast(questions.schema[question_id].dataType).alias(question_id), "path",
                                                              F.lit(None).cast("double").alias("score"), F.lit("whole").alias("kind"), F.lit(None).cast("int").alias("rank"))
    return best.select(question_id, "path", "score", "kind", "rank").unionByName(whole)
