"""Dimension builders: distinct members, calendars and bands, each with a surrogate key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from starloom.functions import scalars as S
from starloom.operators.ordering import number_rows
from starloom.session import small_side


def distinct_members(df: DataFrame, *columns: Column) -> DataFrame:
    """Distinct rows whose first column is known."""
    members = df.select(*columns)
    return members.filter(F.col(members.columns[0]).isNotNull()).distinct()


def keyed(members: DataFrame, key: str, order: list[str] | None = None) -> DataFrame:
    """Members with a 1..n key in the order given (default: all columns)."""
    numbered = number_rows(members, order or members.columns, key)
    return numbered.select(key, *members.columns)


def union_members(frames: list[DataFrame]) -> DataFrame:
    """Distinct union of one-column frames, unknowns left out."""
    merged = reduce(DataFrame.unionByName, frames)
    return merged.filter(F.col(merged.columns[0]).isNotNull()).distinct()


def date_dimension(dates: DataFrame, column: str) -> DataFrame:
    """yyyymmdd key, year, month, day, ISO week, Monday week and weekday name of each distinct date."""
    d = F.col("full_date")
    days = dates.select(F.col(column).cast("date").alias("full_date")).filter(d.isNotNull()).distinct()
    return days.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"), "full_date",
        F.year(d).alias("year"), F.month(d).alias("month"), F.dayofmonth(d).alias("day"),
        F.weekofyear(d).alias("week_number"), S.monday_week(d).alias("monday_week"),
        F.date_format(d, "EEEE").alias("day_of_week"),
    )


def month_dimension(dates: DataFrame, column: str) -> DataFrame:
    """Numbered months with name, year and yyyy-MM label."""
    m = F.col("month")
    months = dates.select(F.trunc(F.col(column).cast("date"), "MM").alias("month")).filter(m.isNotNull()).distinct()
    return keyed(months, "date_key").select(
        "date_key", "month", F.date_format(m, "MMMM").alias("month_name"), F.year(m).alias("year"),
        F.date_format(m, "yyyy-MM").alias("year_month_key"),
    )


def band_dimension(df: DataFrame, date: Column, as_of: Column, bands, name: str) -> DataFrame:
    """Keyed bands present among the rows.  The date column is a parameter: seniority
    counts from the contract start, not from the birth date."""
    found = df.select(S.band(S.whole_years(date, as_of), bands).alias(name))
    return keyed(found.filter(F.col(name).isNotNull()).distinct(), f"{name}_key")


def contract_dimension(contracts: DataFrame, person: str, start: str, end: str) -> DataFrame:
    """Keyed contracts with an active / ended status."""
    rows = contracts.select(
        F.col(person).cast("string").alias("contract_identifier"),
        F.col(start).cast("date").alias("contract_start_date"),
        F.col(end).cast("date").alias("contract_end_date"),
    ).filter("contract_identifier is not null").distinct()
    status = F.when(F.col("contract_end_date").isNull(), "active").otherwise("ended")
    return keyed(rows.withColumn("contract_status", status), "contract_key")


def lookup_key(fact: DataFrame, dim: DataFrame, on: dict[str, str], key: str) -> DataFrame:
    """Left join adding a dimension's key; the dimension is broadcast only after its rows were counted."""
    side = dim.select(*[F.col(d).alias(f"__{key}_{d}") for d in on.values()], key)
    same = reduce(lambda a, b: a & b, [F.col(f) == F.col(f"__{key}_{d}") for f, d in on.items()])
    return fact.join(small_side(side), same, "left").drop(*[f"__{key}_{d}" for d in on.values()])
