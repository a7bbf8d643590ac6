"""Scoring of answers, retrieval results and model predictions, all as aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from starloom.functions import scalars as S
from starloom.functions import text as T
from starloom.functions.rows import element_rows
from starloom.operators.ordering import running_total
from starloom.session import cut_lineage


def text_f1(prediction: Column, expected: Column) -> Column:
    return T.token_f1(T.answer_tokens(prediction), T.answer_tokens(expected))


def best_f1(df: DataFrame, key: str, prediction: str, expected: str, keep_below: float = 0.3) -> DataFrame:
    """Best F1 over all pairs of ``|``-separated answers and outputs; blank answers are skipped.

    The pairs of a row are met where the row lies, and only its best leaves; a row without an
    answer or an output gives none.  Rows under ``keep_below`` are marked as mismatches.
    """
    answers = F.filter(F.split(expected, r"\|"), lambda a: F.trim(a) != "")
    pieces = [F.transform(p, T.answer_tokens) for p in (F.split(prediction, r"\|"), answers)]
    scored = df.select(key, T.best_token_f1(*pieces).alias("f1")).filter(F.col("f1").isNotNull())
    return scored.groupBy(key).agg(F.max("f1").alias("score")).withColumn("is_mismatch", F.col("score") < keep_below)


def number_match(expected: Column, prediction: Column) -> Column:
    """1 when the numbers differ by at most 1e-6; a missing prediction scores 0."""
    return F.coalesce(T.numbers_close(expected, prediction).cast("double"), F.lit(0.0))


def score_answers(predictions: DataFrame, labels: DataFrame, key: str, literal: bool = False) -> DataFrame:
    """One row per labelled metric: is the predicted ``@name[value]`` right?

    Numbers match within 1e-6, text without regard to case.  ``literal`` keeps
    the published rule, in which a text metric counts when it differs.
    """
    wanted = labels.select(key, F.explode("common_answers").alias("m")).select(
        key, F.col("m")[0].alias("metric"), F.col("m")[1].alias("truth")
    )
    given = predictions.select(key, S.answer_map(F.translate("prediction", "{}'", "")).alias("answers"))
    rows = wanted.join(given, key).withColumn("said", F.try_element_at("answers", F.col("metric")))
    number, said = F.col("truth").try_cast("double"), F.col("said").try_cast("double")
    text = F.lower(F.replace("truth", F.lit(","), F.lit("")))
    spoken = F.lower(F.coalesce(F.col("said").try_cast("double").cast("string"), F.col("said")))
    same_text = (spoken != text) if literal else (spoken == text)
    right = F.when(number.isNotNull(), F.abs(said - number) < 1e-6).otherwise(same_text)
    return rows.select(key, "metric", F.coalesce(right, F.lit(False)).alias("is_correct"))


def three_accuracies(scored: DataFrame, key: str) -> DataFrame:
    """Share of fully right questions, pooled share of metrics, mean share per question; to 4 digits, half-even."""
    per = scored.groupBy(key).agg(F.sum(F.col("is_correct").cast("int")).alias("ok"), F.count(F.lit(1)).alias("n"))

    def shown(c):  # the first rounding removes the noise of the order of summation
        return F.bround(F.round(c, 10), 4)

    return per.agg(
        shown(F.avg((F.col("ok") == F.col("n")).cast("double"))).alias("accuracy_by_question"),
        shown(F.sum("ok") / F.sum("n")).alias("accuracy_by_sub_question"),
        shown(F.avg(F.col("ok") / F.col("n"))).alias("proportional_accuracy"),
    )


def retrieval_scores(found: DataFrame, references: DataFrame, key: str) -> DataFrame:
    """Recall, hit rate and reciprocal rank per question.

    ``found`` has (key, rank, text), ``references`` (key, reference); a node
    hits a reference that contains its text.  No nodes gives 0 everywhere.
    """
    # long references are grouped by fingerprint, the text itself is not a key
    marked = references.withColumn("__ref", F.sha2("reference", 256))
    pairs = marked.join(found, key, "left").select(
        key, "__ref", "rank", F.coalesce(F.col("reference").contains(F.col("text")), F.lit(False)).alias("hit")
    )
    per_reference = pairs.groupBy(key, "__ref").agg(
        F.max(F.col("hit").cast("int")).alias("hit"), F.min(F.when(F.col("hit"), F.col("rank"))).alias("rank")
    )
    return per_reference.groupBy(key).agg(
        F.avg("hit").alias("recall"), F.max("hit").cast("double").alias("hit_rate"),
        F.coalesce(1 / F.min("rank"), F.lit(0.0)).alias("mrr"),
    )


def benchmark_means(rows: DataFrame, metrics: list[str], error: str) -> DataFrame:
    """Means over the rows without an error, error share in percent over all rows."""
    good = F.col(error).isNull()
    return rows.agg(
        *[F.avg(F.when(good, F.col(m))).alias(f"mean_{m}") for m in metrics],
        (100.0 * F.count_if(~good) / F.count(F.lit(1))).alias("error_percent"),
    )


def metric_row(pairs: DataFrame, key: str, response: str, reference: str) -> DataFrame:
    """BLEU, ROUGE-L and response length per question, one wide row each."""
    tokens = [F.filter(F.split(c, r"\s+"), lambda t: t != "") for c in (response, reference)]
    return pairs.select(
        key, T.bleu(*tokens).alias("b"), T.rouge_l(*tokens).alias("rouge_l"), F.length(response).alias("response_length")
    ).select(key, "b.*", "rouge_l", "response_length")


def confusion(df: DataFrame, truth: str, prediction: str) -> DataFrame:
    return df.groupBy(F.col(truth).alias("truth"), F.col(prediction).alias("pred")).agg(F.count(F.lit(1)).alias("n"))


def classification_scores(df: DataFrame, truth: str, prediction: str) -> DataFrame:
    """Accuracy, F1 of the positive class and support-weighted F1 from the confusion counts.

    The positive class is 1 when 0 and 1 both occur, else the smaller of two.
    """
    cells = confusion(df, truth, prediction)
    sides = cells.select(F.explode(F.array(
        F.struct(F.col("truth").alias("label"), F.col("n").alias("support"), F.lit(0).cast("long").alias("called")),
        F.struct(F.col("pred").alias("label"), F.lit(0).cast("long").alias("support"), F.col("n").alias("called")),
    )).alias("s"), (F.col("truth") == F.col("pred")).alias("right"))
    per = sides.groupBy("s.label").agg(
        F.sum("s.support").alias("support"), F.sum("s.called").alias("called"),
        F.sum(F.when(F.col("right"), F.col("s.support")).otherwise(0)).alias("tp"),
    )
    f1 = S.guarded_ratio(2 * F.col("tp"), F.col("support") + F.col("called"))
    scored = per.withColumn("f1", f1)
    present = F.col("support") > 0
    zero_one = (F.count_if(present & (F.col("label") == 0)) > 0) & (F.count_if(present & (F.col("label") == 1)) > 0)
    return scored.agg(
        (F.sum("tp") / F.sum("support")).alias("accuracy"),
        F.when(zero_one, F.max(F.when(F.col("label") == 1, F.col("f1")))).when(
            F.count_if(present) == 2, F.min_by("f1", F.when(present, F.col("label")))
        ).alias("f1"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1_weighted"),
    )


def roc_auc(df: DataFrame, truth: str, score: str) -> DataFrame:
    """Area under the curve by rank sums, ties shared; counted per distinct score."""
    cells = df.groupBy(F.col(score).cast("double").alias("s")).agg(
        F.count_if(F.col(truth) == 1).alias("pos"), F.count_if(F.col(truth) != 1).alias("neg")
    )
    ordered = running_total(cells, [F.col("s").asc()], ["neg"])
    wins = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2))
    return ordered.agg((wins / (F.sum("pos").cast("double") * F.sum("neg"))).alias("roc_auc"))


def regression_scores(df: DataFrame, truth: str, prediction: str) -> DataFrame:
    def rms(gap):
        return F.sqrt(F.avg(gap * gap))

    return df.agg(rms(F.col(truth) - F.col(prediction)).alias("rmse"),
                  rms(F.log1p(truth) - F.log1p(prediction)).alias("log_rmse"))


def vote_report(logs: DataFrame, folder: str, file: str, log: str) -> DataFrame:
    """Per voting round of each game: share of good players voting for a known werewolf.

    Rates are rounded to two digits before they are averaged; the folder's
    first-round mean is attached to first rounds only.
    """
    parts = element_rows(logs, [folder, file], T.vote_chunks(F.col(log)), "__r")
    # a one-element explode evaluates the ballots once instead of once per use
    lines = element_rows(parts, [folder, file, "__r.vote_round"], F.array(T.ballots(F.col("__r.text"))), "b")
    wolves = F.transform(F.filter("b", lambda x: x["role"] == "Werewolf"), lambda x: x["voter"])
    others = F.filter("b", lambda x: x["role"] != "Werewolf")
    split = F.array(F.struct(wolves.alias("w"), others.alias("o"), F.size("b").alias("n")))
    sides = element_rows(lines, [folder, file, "vote_round"], split, "s")
    right = F.filter("s.o", lambda x: F.array_contains(F.col("s.w"), x["target"]))
    rates = cut_lineage(sides.filter(F.size("s.o") > 0).select(
        folder, file, "vote_round", F.bround(F.size(right) / F.size("s.o"), 2).alias("good_vote_rate"),
        F.concat(F.lit("_"), F.size("s.w").cast("string"), F.lit(" / "), F.col("s.n").cast("string")).alias("difficulty"),
    ))
    means = rates.groupBy(file).agg(F.avg("good_vote_rate").alias("avg_rate"))
    first = rates.filter("vote_round = 'vote_1'").groupBy(folder).agg(F.avg("good_vote_rate").alias("vote1_rate"))
    first = first.withColumn("vote_round", F.lit("vote_1"))
    return rates.join(means, file).join(first, [folder, "vote_round"], "left")


def token_costs(usage: DataFrame, prices: DataFrame, model: str, by: list[str]) -> DataFrame:
    """Tokens and cost per group; an unknown model's tokens count, its cost does not.

    Usage is summed per model before the prices are joined.  Rows without a
    model or without tokens are ignored.
    """
    used = usage.filter(F.col(model).isNotNull() & (F.col(model) != "") & (F.col("prompt_tokens") + F.col("completion_tokens") != 0))
    sums = used.groupBy(*dict.fromkeys([*by, model])).agg(
        F.sum("prompt_tokens").alias("p"), F.sum("completion_tokens").alias("c")
    )
    cost = (F.col("p") * F.col("prompt_price") + F.col("c") * F.col("completion_price")) / 1000
    return sums.join(prices, model, "left").groupBy(*by).agg(
        F.sum("p").alias("prompt_tokens"), F.sum("c").alias("completion_tokens"),
        F.coalesce(F.sum(cost), F.lit(0.0)).alias("total_cost"),
    )


def run_summary(runs: DataFrame, index: str, low_is_better: bool = False) -> DataFrame:
    """Best dev score, its first run, the test score there, mean and best test score.

    With lower-is-better, runs marked -1 cannot be best, but they count in the mean.
    """
    if low_is_better:
        dev, test = F.when(F.col("dev_score") != -1, F.col("dev_score")), F.when(F.col("dev_score") != -1, F.col("test_score"))
        place = F.when(dev.isNotNull(), F.struct(dev.alias("d"), F.col(index).alias("i")))
        best, top, at = F.min(dev), F.min(test), [F.min_by(c, place) for c in (index, "test_score")]
    else:
        place = F.struct(F.col("dev_score"), -F.col(index))
        best, top, at = F.max("dev_score"), F.max("test_score"), [F.max_by(c, place) for c in (index, "test_score")]
    return runs.agg(best.alias("best_dev_score"), at[0].alias("best_dev_score_idx"), at[1].alias("best_dev_test_score"),
                    F.avg("test_score").alias("avg_test_score"), top.alias("global_best_test_score"))
