"""Python source files: classes, functions and globals, one Arrow helper per file."""

from __future__ import annotations

import ast

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

_NAMES = ArrayType(StringType())
_CLASS = StructType().add("name", StringType()).add("methods", _NAMES)
_FUNCTIONS = (ast.FunctionDef, ast.AsyncFunctionDef)


def _targets(node) -> list:
    return node.targets if isinstance(node, ast.Assign) else [node.target]


@F.pandas_udf(StructType().add("classes", ArrayType(_CLASS)).add("functions", _NAMES).add("globals", _NAMES).add("error", StringType()))
def symbols(sources: pd.Series) -> pd.DataFrame:
    """Top-level names of each source; a file that does not parse carries its error instead of failing the job."""
    rows = []
    for text in sources:
        try:
            body = ast.parse(text).body
        except (SyntaxError, ValueError) as problem:
            rows.append(([], [], [], str(problem)))
            continue
        classes = [{"name": n.name, "methods": [m.name for m in n.body if isinstance(m, _FUNCTIONS)]} for n in body if isinstance(n, ast.ClassDef)]
        functions = [n.name for n in body if isinstance(n, _FUNCTIONS)]
        names = [t.id for n in body if isinstance(n, (ast.Assign, ast.AnnAssign)) for t in _targets(n) if isinstance(t, ast.Name)]
        rows.append((classes, functions, names, None))
    return pd.DataFrame(rows, columns=["classes", "functions", "globals", "error"])


def file_symbols(files: DataFrame, path: str = "file", content: str = "content") -> DataFrame:
    """Files with their classes (name, methods), functions and globals."""
    return files.withColumn("__s", symbols(F.col(content))).select(F.col(path).alias("file"), "__s.*")
