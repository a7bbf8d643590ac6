"""File readers and profilers."""

from __future__ import annotations

import csv
import os

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from starloom.functions import text as T
from starloom.functions.rows import element_rows
from starloom.session import small_side

# Readable table extensions and the classes of corpus files.
TABLE_EXTENSIONS = (".csv", ".xlsx", ".xls")
DOC_SUFFIXES, CODE_SUFFIXES, ASSET_SUFFIXES = ["md"], ["py", "js", "css", "html"], ["json", "txt"]
EXPERIENCE_PREFIX = "New experience: "


def sniff_separator(spark: SparkSession, path: str, lines: int = 20) -> str:
    """Delimiter guessed from the first lines; a comma when nothing stands out."""
    sample = "\n".join(r.value for r in spark.read.text(path).limit(lines).collect())
    try:
        return csv.Sniffer().sniff(sample, delimiters=",;\t|").delimiter
    except csv.Error:
        return ","


def read_table(spark: SparkSession, path: str, sep: str | None = None, schema: str | None = None) -> DataFrame:
    """CSV with header; an explicit separator wins over sniffing, a declared schema over inference."""
    extension = os.path.splitext(path.rstrip("/"))[1].lower()
    if extension in (".xlsx", ".xls"):
        raise NotImplementedError("workbooks are profiled with workbook_profile; convert to CSV to load them")
    if extension not in TABLE_EXTENSIONS:
        raise ValueError(f"Unsupported file extension '{extension}'")
    reader = spark.read.option("header", True).option("sep", sep or sniff_separator(spark, path))
    reader = reader.option("multiLine", False).option("escape", '"')
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)


def file_schema(spark: SparkSession, path: str, sep: str | None = None) -> list[tuple[str, str]]:
    return read_table(spark, path, sep).dtypes


def file_rows(spark: SparkSession, path: str, sep: str | None = None) -> int:
    return read_table(spark, path, sep).count()


def profile(df: DataFrame) -> DataFrame:
    """(column, dtype, row_count, null_count) in one pass; wholly null columns are left out."""
    kinds = dict(df.dtypes)
    row = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    entries = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(kinds[c]).alias("dtype"), F.col(f"`{c}`").alias("null_count"))
        for c in df.columns
    ])
    out = row.select(F.col("__rows").alias("row_count"), F.explode(entries).alias("e"))
    return out.select("e.column_name", "e.dtype", "row_count", "e.null_count").filter("null_count < row_count")


def samples(df: DataFrame, n: int = 5, width: int | None = None) -> dict[str, list[str]]:
    """First values of each column as whole text; only a given ``width`` cuts them, with an ellipsis."""
    rows = df.limit(n).collect()

    def shown(value):
        text = str(value)
        return text[:width] + "…" if width is not None and len(text) > width else text

    return {c: [shown(r[c]) for r in rows] for c in df.columns}


def profile_cells(cells: DataFrame) -> DataFrame:
    """Column profile of long-form cells (file, sheet, column_name, position, value): rows, nulls and a type."""
    number, filled = F.col("value").try_cast("double").isNotNull(), F.col("value").isNotNull()
    return cells.groupBy("file", "sheet", "column_name").agg(
        F.min("position").alias("position"), F.count(F.lit(1)).alias("row_count"),
        F.count_if(~filled).alias("null_count"),
        F.when(F.count_if(filled) == 0, "null").when(F.count_if(filled & ~number) == 0, "double").otherwise("string").alias("dtype"),
    )


def workbook_cells(spark: SparkSession, path: str) -> DataFrame:
    """Cells of every sheet of every workbook, one task per batch of files; needs an Excel reader in the workers."""

    def read(batches):
        import io

        import pandas as pd

        for batch in batches:
            for name, content in zip(batch["path"], batch["content"]):
                for sheet, frame in pd.read_excel(io.BytesIO(content), sheet_name=None).items():
                    for i, c in enumerate(frame.columns):
                        values = frame[c].map(lambda v: None if pd.isna(v) else str(v))
                        yield pd.DataFrame({"file": name, "sheet": sheet, "column_name": str(c), "position": i, "value": values})

    schema = "file string, sheet string, column_name string, position int, value string"
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(read, schema)


def workbook_profile(spark: SparkSession, path: str) -> DataFrame:
    return profile_cells(workbook_cells(spark, path))


def stream_columns(catalogs: DataFrame, column: str) -> DataFrame:
    """(stream, field, type) of catalog documents; a nullable union takes its first other type.

    A document is ``{"streams": [{"name": .., "json_schema": {"properties": {..}}}]}``.
    """
    shape = "struct<streams: array<struct<name: string, json_schema: struct<properties: map<string, struct<type: string>>>>>>"
    streams = element_rows(catalogs, [], F.from_json(column, shape).getField("streams"), "s")
    fields = streams.select(F.col("s.name").alias("stream"), F.explode("s.json_schema.properties").alias("field", "t"))
    listed = F.from_json("t.type", "array<string>")
    kind = F.coalesce(F.try_element_at(F.filter(listed, lambda x: x != "null"), F.lit(1)), F.when(listed.isNull(), F.col("t.type")), F.lit("string"))
    return fields.select("stream", "field", kind.alias("type"))


def indexable(spark: SparkSession, path: str, content: str = "content") -> DataFrame:
    """Table for indexing from csv, json or txt; a missing content column raises."""
    extension = os.path.splitext(path.rstrip("/"))[1].lower()
    if extension == ".csv":
        df = read_table(spark, path)
    elif extension == ".json":
        df = spark.read.option("multiLine", True).json(path)
    elif extension == ".txt":
        whole = spark.read.text(path, wholetext=True).withColumn("file_path", F.input_file_name())
        return element_rows(whole, ["file_path"], line_chunks(F.col("value")), content)
    else:
        raise NotImplementedError(f"no reader for {extension}")
    if content not in df.columns:
        raise ValueError(f"Content column '{content}' not found")
    return df


def line_chunks(text: Column, size: int = 256) -> Column:
    """Line-separated text cut into pieces of at most ``size`` characters, no overlap."""
    lines = F.filter(F.split(text, "\n"), lambda s: F.trim(s) != "")
    return F.flatten(F.transform(lines, lambda s: F.transform(
        F.sequence(F.lit(0), ((F.length(s) - 1) / size).cast("int")), lambda i: F.substr(s, i * size + 1, F.lit(size)))))


def corpus(spark: SparkSession, folder: str) -> DataFrame:
    """Every file below a folder as (path, name, content, category), whole files."""
    files = spark.read.option("recursiveFileLookup", True).text(folder, wholetext=True)
    files = files.select(F.input_file_name().alias("path"), F.col("value").alias("content"))
    return files.withColumn("name", F.element_at(F.split("path", "/"), -1)).withColumn("category", file_category(F.col("path")))


def file_category(path: Column) -> Column:
    """docs, codes or assets by suffix; null for other files."""
    suffix = F.regexp_extract(path, r"\.([^./]+)$", 1)
    return F.when(suffix.isin(DOC_SUFFIXES), "docs").when(suffix.isin(CODE_SUFFIXES), "codes").when(
        suffix.isin(ASSET_SUFFIXES), "assets")


def corpus_stats(files: DataFrame, content: str = "content") -> DataFrame:
    """Documents and characters per category and in total."""
    return files.groupBy("category").agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.length(content)).alias("n_chars")).unionByName(
        files.agg(F.lit("total").alias("category"), F.count(F.lit(1)).alias("n_docs"), F.sum(F.length(content)).alias("n_chars"))
    )


def read_json_document(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).json(path)


def read_json_lines(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    return spark.read.schema(schema).json(path) if schema else spark.read.json(path)


def read_plain_csv(spark: SparkSession, path: str, header: bool = False) -> DataFrame:
    """All cells as text, no type inference."""
    return spark.read.option("header", header).csv(path)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their 0-based index in (file, offset) order.

    A line's index is its place inside the file block a task read plus the
    lines of the blocks before it.  Only block counts are ordered: no line is
    sorted, shuffled or copied.  Both reads split the same files the same way,
    so places and counts agree, also when a task runs again.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__start"),
        F.monotonically_increasing_id().alias("__id"),
    )
    blocks = lines.groupBy("__file", "__start").agg(F.count(F.lit(1)).alias("n"), F.min("__id").alias("__first"))
    # one row per file block (128 MB): the only place where an order over everything is needed
    before = Window.orderBy("__file", "__start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("__file", "__start", "__first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    joined = lines.join(small_side(offsets), ["__file", "__start"])
    return joined.select((F.col("__before") + F.col("__id") - F.col("__first")).alias("line_no"), "value")


def json_lines_subset(spark: SparkSession, path: str, schema: str, indices: DataFrame | None = None) -> DataFrame:
    """JSON lines with their index, optionally only those listed in ``indices`` (column line_no)."""
    lines = numbered_lines(spark, path)
    if indices is not None:
        lines = lines.join(indices.select("line_no").distinct(), "line_no", "left_semi")
    return lines.select("line_no", F.from_json("value", schema).alias("__j")).select("line_no", "__j.*")


def experiences_from_log(lines: DataFrame, schema: str, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """Experience rows of a log and the marked lines whose JSON cannot be read."""
    marked = lines.filter(F.col(column).contains(EXPERIENCE_PREFIX)).select(
        F.regexp_extract(column, rf"(?s)\Q{EXPERIENCE_PREFIX}\E(.*)$", 1).alias("body"))
    good = marked.filter(T.is_json(F.col("body")))
    return good.select(F.from_json("body", schema).alias("__e")).select("__e.*"), marked.filter(~T.is_json(F.col("body")))
