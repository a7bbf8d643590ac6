"""Tables of the session catalog and of a JDBC database."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

# Fixed value: what a name may consist of.
IDENTIFIER = re.compile(r"^[a-zA-Z0-9_]+$")


def safe_identifier(name: str) -> str:
    """The name itself if it is letters, digits and underscores; anything else raises."""
    if not IDENTIFIER.match(name):
        raise ValueError(f"Invalid SQL identifier: '{name}'")
    return name


def list_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    """``schema.table`` of the base tables, sorted; views are left out."""
    found = spark.catalog.listTables(database) if database else spark.catalog.listTables()
    return sorted(f"{(t.namespace or ['default'])[-1]}.{t.name}" for t in found
                  if t.tableType not in ("VIEW", "TEMPORARY") and not t.isTemporary)


def inventory(tables: dict[str, DataFrame]) -> DataFrame:
    """Row and column counts per table, ordered by name."""
    parts = [tables[name].agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"),
                              F.lit(len(tables[name].columns)).cast("long").alias("column_count")) for name in sorted(tables)]
    return reduce(DataFrame.unionByName, parts)


def catalog_inventory(spark: SparkSession, database: str | None = None) -> DataFrame:
    return inventory({name: spark.table(name) for name in list_tables(spark, database)})


def table_columns(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    rows = [(name, i + 1, c, t) for name in sorted(tables) for i, (c, t) in enumerate(tables[name].dtypes)]
    return spark.createDataFrame(rows, "table_name string, position int, column_name string, dtype string")


def described(spark: SparkSession, name: str) -> DataFrame:
    """(position, column_name, dtype) of one table; no rows where the catalog has no such table."""
    dtypes = spark.table(name).dtypes if spark.catalog.tableExists(name) else []
    return spark.createDataFrame([(i, c, t) for i, (c, t) in enumerate(dtypes, 1)], "position int, column_name string, dtype string")


def verify_table(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def table_schema(spark: SparkSession, name: str) -> DataFrame:
    """As ``described``, for a table that must be there."""
    if not verify_table(spark, name):
        raise ValueError(f"the catalog holds no table named {name}")
    return described(spark, name)


# what a statement is made of: comments, quoted parts, the semicolon that ends it, an opening that nothing closes, and the rest
PIECE = re.compile(r"""(?P<comment>--[^\n]*|/\*.*?\*/)|'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`[^`]*`|(?P<end>;)|(?P<open>/\*|['"`])|[^;'"`/-]+|[-/]""", re.DOTALL)


def split_statements(text: str) -> list[str]:
    """Statements between semicolons that stand outside quotes and comments; what is comment only is none."""
    found, start, said = [], 0, False
    for piece in PIECE.finditer(text):
        if piece["open"]:
            raise ValueError(f"nothing closes {piece[0]} at {piece.start()}: {text[piece.start():piece.start() + 40]!r}")
        if piece["end"]:
            found += [text[start:piece.start()].strip()] if said else []
            start, said = piece.end(), False
        elif not piece["comment"]:
            said = said or not piece[0].isspace()
    return found + ([text[start:].strip()] if said else [])


def run_ddl(spark: SparkSession, statements: str | list[str]) -> int:
    """Run statements one by one; a list entry may itself hold several."""
    texts = [statements] if isinstance(statements, str) else statements
    single = [s for t in texts for s in split_statements(t)]
    for s in single:
        spark.sql(s)
    return len(single)


def run_query(spark: SparkSession, sql: str, **frames: DataFrame) -> DataFrame:
    """SQL over the catalog and the frames given by name."""
    return spark.sql(sql, **frames)


def fill_placeholders(template: str, results: dict[str, dict]) -> str:
    """``KEY_FROM_TASK_N`` replaced from the results of task N; case and underscores of the key do not matter."""

    def value(match):
        key, task = match.group(1), match.group(2)
        plain = {k.replace("_", "").lower(): v for k, v in results.get(task, {}).items()}
        found = plain.get(key.replace("_", "").lower())
        return match.group(0) if found is None else str(found)

    return re.sub(r"([A-Za-z][A-Za-z0-9_]*?)_FROM_TASK_(\w+)", value, template)


def jdbc_options(url: str, query: str, user: str, password: str, partition: tuple[str, int, int, int] | None = None) -> dict:
    """Reader options; ``partition`` (column, low, high, count) makes the read parallel."""
    options = {"url": url, "dbtable": f"({query}) AS q", "user": user, "password": password, "fetchsize": "10000"}
    if partition:
        column, low, high, count = partition
        options |= {"partitionColumn": safe_identifier(column), "lowerBound": str(low), "upperBound": str(high),
                    "numPartitions": str(count)}
    return options


def jdbc_tables_query(schema: str = "public") -> str:
    return ("SELECT table_schema, table_name FROM information_schema.tables WHERE table_type = 'BASE TABLE' "
            f"AND table_schema = '{safe_identifier(schema)}'")


def jdbc_columns_query(schema: str = "public") -> str:
    return ("SELECT table_schema, table_name, column_name, data_type, ordinal_position FROM information_schema.columns "
            f"WHERE table_schema = '{safe_identifier(schema)}'")


def jdbc_count_query(schema: str, table: str) -> str:
    return f'SELECT COUNT(*) AS row_count FROM "{safe_identifier(schema)}"."{safe_identifier(table)}"'


def jdbc_bounds_query(schema: str, table: str, column: str) -> str:
    return (f'SELECT MIN("{safe_identifier(column)}") AS low, MAX("{safe_identifier(column)}") AS high '
            f'FROM "{safe_identifier(schema)}"."{safe_identifier(table)}"')


def jdbc_counts_query(schema: str, tables: list[str]) -> str:
    """All counts by one query, so the database is asked once."""
    each = [f"SELECT '{safe_identifier(t)}' AS table_name, COUNT(*) AS row_count FROM \"{safe_identifier(schema)}\".\"{t}\"" for t in sorted(tables)]
    return " UNION ALL ".join(each)


@dataclass(frozen=True)
class Database:
    """Tables of one schema of a JDBC database; every name is checked before it enters a query."""

    spark: SparkSession
    url: str
    user: str
    password: str
    schema: str = "public"

    def read(self, query: str, partition: tuple[str, int, int, int] | None = None) -> DataFrame:
        return self.spark.read.format("jdbc").options(**jdbc_options(self.url, query, self.user, self.password, partition)).load()

    def tables(self) -> list[str]:
        """Names of the base tables, sorted."""
        return sorted(r.table_name for r in self.read(jdbc_tables_query(self.schema)).select("table_name").collect())

    def columns(self, table: str) -> DataFrame:
        """(position, column_name, dtype) of one table; no rows where there is no such table."""
        found = self.read(f"{jdbc_columns_query(self.schema)} AND table_name = '{safe_identifier(table)}'")
        return found.select(F.col("ordinal_position").cast("int").alias("position"), "column_name", F.col("data_type").alias("dtype"))

    def verify(self, table: str) -> bool:
        return not self.columns(table).isEmpty()

    def scan(self, table: str, column: str | None = None, parts: int = 16) -> DataFrame:
        """A table; with an integer ``column`` in as many parallel parts between its least and greatest value.

        Rows where the column is null belong to the first part.  An empty table is one part.
        """
        query = f'SELECT * FROM "{safe_identifier(self.schema)}"."{safe_identifier(table)}"'
        ends = self.read(jdbc_bounds_query(self.schema, table, column)).first() if column else None
        if ends is None or ends.low is None or ends.high == ends.low:
            return self.read(query)
        return self.read(query, (column, int(ends.low), int(ends.high) + 1, min(parts, int(ends.high) - int(ends.low) + 1)))

    def inventory(self) -> DataFrame:
        """Row counts of all tables, counted by the database."""
        names = self.tables()
        if not names:
            return self.spark.createDataFrame([], "table_schema string, table_name string, row_count bigint")
        return self.read(jdbc_counts_query(self.schema, names)).select(F.lit(self.schema).alias("table_schema"), "table_name", "row_count")


def jdbc_inventory(spark: SparkSession, url: str, user: str, password: str, schema: str = "public") -> DataFrame:
    """Tables of a database schema with their row counts."""
    return Database(spark, url, user, password, schema).inventory()
