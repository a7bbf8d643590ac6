"""Fact builders: transactions, daily counts, monthly snapshots and movements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from starloom.functions import scalars as S
from starloom.session import cut_lineage, small_side, spread


def interaction_counts(events: DataFrame, time: str, keys: list[str], kind: str, kinds: list[str]) -> DataFrame:
    """Counts per day, key and kind, one column per kind; rows without a readable time drop out."""
    known = events.withColumn("full_date", F.col(time).try_cast("timestamp").cast("date")).filter("full_date is not null")
    label = S.safe_key(F.col(kind))
    counts = [F.sum(S.flag(label == k)).alias(f"{k.replace('-', '_')}_count") for k in kinds]
    return known.groupBy("full_date", *keys, label.alias("interaction_type_name")).agg(
        F.count(F.lit(1)).alias("interaction_count"), *counts
    )


def customer_summary(purchases: DataFrame, customer: str, day: str, price: str) -> DataFrame:
    """Per customer and day: purchases, new / returning flags, frequency and average value.

    The grain is the day although the month is carried along, so a group holds
    one distinct day, or none when the day is unknown.
    """
    total, days = F.count(F.lit(1)), F.max(F.col(day).isNotNull().cast("int"))
    return purchases.groupBy(day, customer).agg(
        F.trunc(F.first(day), "MM").alias("month_start"),
        total.alias("total_purchases"),
        (total > 1).alias("returning_customer_flag"),
        (total == 1).alias("new_customer_flag"),
        S.guarded_ratio(total, days).alias("purchase_frequency"),
        F.avg(F.coalesce(F.col(price), F.lit(0.0))).alias("average_order_value"),
    )


def month_spine(contracts: DataFrame, start: str, end: str, continuous: bool = False) -> DataFrame:
    """Months in which a contract starts or ends; ``continuous`` fills the quiet months in between."""
    months = contracts.select(F.explode(F.array(F.trunc(start, "MM"), F.trunc(end, "MM"))).alias("month_date"))
    months = months.filter("month_date is not null").distinct()
    if not continuous:
        return months
    ends = months.agg(F.min("month_date").alias("a"), F.max("month_date").alias("b"))
    return ends.select(F.explode(F.expr("sequence(a, b, interval 1 month)")).alias("month_date"))


def active_months(contracts: DataFrame, start: str, end: str, continuous: bool = False) -> DataFrame:
    """One row per contract and spine month in which it is active; an open end lasts to the last spine month.

    Each contract lists its own months and meets the spine by equality, which
    replaces the BETWEEN join (a Cartesian product) of the literal form.
    """
    months = cut_lineage(month_spine(contracts, start, end, continuous))
    last = months.agg(F.max("month_date")).first()[0]
    if last is None:
        return contracts.withColumn("month_date", F.lit(None).cast("date")).limit(0)
    begin, finish = F.trunc(start, "MM"), F.coalesce(F.trunc(end, "MM"), F.lit(last))
    # a contract becomes as many rows as it has months, so few splits are spread first
    listed = spread(contracts.filter(F.col(start).isNotNull() & (begin <= finish))).withColumn(
        "month_date", F.explode(F.sequence(begin, finish, F.expr("interval 1 month")))
    )
    return listed if continuous else listed.join(small_side(months), "month_date", "left_semi")


def first_contract_per_month(active: DataFrame, person: str, start: str, tie: list[str]) -> DataFrame:
    """The earliest contract of each person and month, as an aggregate instead of a window."""
    others = [c for c in active.columns if c not in ("month_date", person)]
    pick = F.min_by(F.struct(*others), F.struct(F.col(start), *[F.col(t) for t in tie]))
    return active.groupBy("month_date", person).agg(pick.alias("__c")).select("month_date", person, "__c.*")


def movements(active: DataFrame, start: str, end: str, by: list[str]) -> DataFrame:
    """Contracts entering and leaving per month and group."""
    return active.groupBy("month_date", *by).agg(
        F.sum(S.flag(F.trunc(start, "MM") == F.col("month_date"))).alias("in_count"),
        F.sum(S.flag(F.trunc(end, "MM") == F.col("month_date"))).alias("out_count"),
    )


def absence_index(df: DataFrame, counters: list[str], name: str = "absence_index") -> DataFrame:
    """Sum of the frequency columns; one missing operand makes the whole sum 0."""
    total: Column = F.col(counters[0])
    for c in counters[1:]:
        total = total + F.col(c)
    return df.withColumn(name, F.coalesce(total, F.lit(0)))


def bradford_factor(spells: Column, days: Column) -> Column:
    """The usual index: squared number of spells times days absent."""
    return spells * spells * days


def cross_left(left: DataFrame, right: DataFrame, limit: int = 10_000) -> DataFrame:
    """Every left row with every row of a right side proven small; left rows stay when it is empty.

    Kept for parity with the unconditional left join; use a key where one exists.  The right
    side is packed into one row on an executor and sent to all tasks; more than ``limit`` rows
    raise, so what is sent is bounded.
    """
    if right.limit(limit + 1).count() > limit:
        raise ValueError(f"right side has more than {limit} rows: join on a key instead")
    packed = right.agg(F.collect_list(F.struct(*right.columns)).alias("__rows")).withColumn("__one", F.lit(0))
    joined = left.withColumn("__one", F.lit(0)).join(F.broadcast(packed), "__one")
    return joined.withColumn("__r", F.explode_outer("__rows")).select(*left.columns, "__r.*")


def year_over_year(monthly: DataFrame, month: str, by: list[str], value: str) -> DataFrame:
    """Value of the same month a year earlier and the difference; gaps give null, not a shifted month."""
    past = monthly.select(F.add_months(month, 12).alias(month), *by, F.col(value).alias(f"{value}_last_year"))
    return monthly.join(past, [month, *by], "left").withColumn(
        f"{value}_change", F.col(value) - F.col(f"{value}_last_year")
    )
