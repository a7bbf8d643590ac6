"""Data-quality checks: keys, references, column tests, conformance and the verdict."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def key_uniqueness(df: DataFrame, table: str, key: str) -> DataFrame:
    """Rows minus distinct values, so every null counts as a duplicate; nulls are also counted alone."""
    return df.agg(
        F.lit(table).alias("table_name"), F.lit(key).alias("key_column"),
        (F.count(F.lit(1)) - F.count_distinct(F.col(key))).alias("duplicate_count"),
        F.count_if(F.col(key).isNull()).alias("null_count"),
    ).withColumn("is_unique", F.col("duplicate_count") == 0)


def orphan_count(fact: DataFrame, fk: str, dim: DataFrame, pk: str, name: str) -> DataFrame:
    """Fact rows whose reference has no target; a null reference is an orphan.

    References are counted before the join, so a hot key crosses it as one row.
    """
    used = fact.groupBy(F.col(fk).alias("__fk")).agg(F.count(F.lit(1)).alias("__n"))
    lost = used.join(dim.select(F.col(pk).alias("__pk")), F.col("__fk") == F.col("__pk"), "left_anti")
    return lost.agg(F.lit(name).alias("reference"), F.coalesce(F.sum("__n"), F.lit(0)).alias("orphan_count")).withColumn(
        "is_valid", F.col("orphan_count") == 0
    )


def not_null_failures(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Failing rows per column, all columns in one pass."""
    packed = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failures")) for c in columns])
    return packed.select(F.lit(table).alias("table_name"), F.explode(entries).alias("e")).select("table_name", "e.*")


def unique_failures(df: DataFrame, table: str, column: str) -> DataFrame:
    """Values occurring more than once; nulls are ignored here, unlike in the key check.

    Long texts are compared by fingerprint, so the shuffle carries 64 characters instead of the text.
    """
    value = F.col(column)
    if df.schema[column].dataType.typeName() == "string":
        value = F.when(F.length(value) > 64, F.sha2(value, 256)).otherwise(value)
    repeated = df.filter(F.col(column).isNotNull()).groupBy(value.alias("__v")).count().filter("count > 1")
    return repeated.agg(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"),
                        F.count(F.lit(1)).alias("failures"))


def type_family(kind: str) -> str:
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return "integer"
    if kind in ("float", "double") or kind.startswith("decimal"):
        return "decimal"
    if kind == "date" or kind.startswith("timestamp"):
        return "date"
    return "string" if kind == "string" else kind


def conformance(spark: SparkSession, tables: dict[str, DataFrame], spec: dict[str, dict[str, str]]) -> DataFrame:
    """Declared columns against the schemas found, one row per declared column."""
    rows = []
    for table, columns in spec.items():
        actual = dict(tables[table].dtypes) if table in tables else None
        for column, family in columns.items():
            if actual is None:
                status = "missing table"
            elif column not in actual:
                status = "missing column"
            else:
                status = "ok" if type_family(actual[column]) == family else "wrong type"
            rows.append((table, column, family, status))
    return spark.createDataFrame(rows, "table_name string, column_name string, declared string, status string")


def has_rows(df: DataFrame) -> bool:
    return not df.isEmpty()


def needs_met(schemas: dict[str, StructType], links: set[tuple[str, str]], needs: list[dict]) -> list[tuple]:
    """(item, kind, status, detail) for declared questions, KPIs and sources.

    A need lists its tables, its columns as table.column, and the table pairs a
    foreign key must connect.
    """
    good = {"question": "SUPPORTED", "kpi": "COMPUTABLE", "source": "INGESTED"}
    out = []
    for need in needs:
        lost = [t for t in need.get("tables", []) if t not in schemas]
        for ref in need.get("columns", []):
            table, column = ref.split(".")
            if table not in schemas or column not in schemas[table].names:
                lost.append(ref)
        lost += [f"{a}->{b}" for a, b in need.get("links", []) if (a, b) not in links]
        status = good[need["kind"]] if not lost else f"NOT {good[need['kind']]}"
        out.append((need["item"], need["kind"], status, ", ".join(lost)))
    return out


def report(parts: list[DataFrame]) -> DataFrame:
    """Long report table of (phase, item, check_name, status, details)."""
    columns = ["phase", "item", "check_name", "status", "details"]
    return reduce(DataFrame.unionByName, [p.select(*columns) for p in parts])


def verdict(rows: DataFrame) -> DataFrame:
    """ACCEPTED only if every row passes; an empty report is rejected."""
    return rows.agg(
        F.count(F.lit(1)).alias("checks"), F.count_if(F.col("status") != "PASS").alias("failed")
    ).withColumn("verdict", F.when((F.col("failed") == 0) & (F.col("checks") > 0), "ACCEPTED").otherwise("REJECTED"))


# Task types and required field names of an execution plan.
TASK_TYPES = ["INSTANTIATION", "CONNECTION_SETUP", "CREDENTIAL_REQUEST", "SCHEMA_CREATION", "DATA_INGESTION", "TRANSFORMATION"]
REQUIRED_FIELDS = ["task_id", "dependent_task_ids", "instruction", "task_type"]


def plan_errors(plan: DataFrame, task_types: list[str] = TASK_TYPES) -> DataFrame:
    """(task_id, problem) rows: missing fields, unknown type, no tool, unknown dependency."""
    missing = [F.when(F.col(c).isNull(), F.lit(f"missing {c}")) for c in REQUIRED_FIELDS]
    bad_type = F.when(~F.col("task_type").isin(task_types), F.lit("unknown task type"))
    no_tool = F.when((F.col("task_type") != "CREDENTIAL_REQUEST") & (F.coalesce(F.col("tool"), F.lit("")) == ""),
                     F.lit("missing tool"))
    own = plan.select("task_id", F.explode(F.array_compact(F.array(*missing, bad_type, no_tool))).alias("problem"))
    wanted = plan.select("task_id", F.explode("dependent_task_ids").alias("dep"))
    known = plan.select(F.col("task_id").alias("known"))
    dangling = wanted.join(known, F.col("dep") == F.col("known"), "left_anti")
    return own.unionByName(dangling.select("task_id", F.concat(F.lit("unknown dependency "), "dep").alias("problem")))
