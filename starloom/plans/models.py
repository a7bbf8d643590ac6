"""Named models that build on each other: order, selection, build, column tests, results."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from starloom.operators.quality import not_null_failures, unique_failures


@dataclass
class Model:
    name: str
    build: Callable[[Callable[[str], DataFrame]], DataFrame]
    refs: tuple[str, ...] = ()
    materialized: str = "view"
    unique: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()


@dataclass
class ModelSet:
    """Models over source frames.  A model's function receives ``ref`` and returns a DataFrame.

    A view stays a lazy plan; a table is written to ``folder`` and read back, so
    several consumers share the work and its lineage ends there.
    """

    spark: SparkSession
    sources: dict[str, DataFrame]
    folder: str | None = None
    models: dict[str, Model] = field(default_factory=dict)
    built: dict[str, DataFrame] = field(default_factory=dict)
    results: list[tuple] = field(default_factory=list)

    def model(self, name: str, refs: tuple[str, ...] = (), **options):
        def add(function):
            self.models[name] = Model(name, function, tuple(refs), **options)
            return function

        return add

    def sql_model(self, name: str, sql: str, refs: tuple[str, ...] = (), **options) -> None:
        """A model given as a SELECT; ``{name}`` in it stands for a reference."""
        self.models[name] = Model(name, lambda ref: self.spark.sql(sql, **{r: ref(r) for r in refs}), tuple(refs), **options)

    def ref(self, name: str) -> DataFrame:
        return self.sources[name] if name in self.sources else self.built[name]

    def order(self, wanted: set[str] | None = None) -> list[str]:
        """Run order; an unknown reference or a cycle is an error that names it."""
        seen: dict[str, int] = {}
        out: list[str] = []

        def visit(name, chain):
            if name in self.sources or seen.get(name) == 2:
                return
            if name not in self.models:
                raise KeyError(f"unknown model or source '{name}'")
            if seen.get(name) == 1:
                raise ValueError("cycle: " + " -> ".join([*chain, name]))
            seen[name] = 1
            for r in self.models[name].refs:
                visit(r, [*chain, name])
            seen[name] = 2
            out.append(name)

        for name in sorted(wanted or self.models):
            visit(name, [])
        return out

    def upstream(self, name: str) -> set[str]:
        found = {name}
        for r in self.models[name].refs:
            if r in self.models:
                found |= self.upstream(r)
        return found

    def downstream(self, name: str) -> set[str]:
        """The model and all that build on it: what a change makes stale."""
        found, grew = {name}, True
        while grew:
            more = {m.name for m in self.models.values() if found & set(m.refs)} - found
            found, grew = found | more, bool(more)
        return found

    def select(self, selector: str | None) -> set[str]:
        """All models, one, one with its ancestors (``+m``) or with its descendants (``m+``)."""
        if not selector:
            return set(self.models)
        name = selector.strip("+")
        if name not in self.models:
            raise ValueError(f"no model matches '{selector}'")
        chosen = {name}
        if selector.startswith("+"):
            chosen |= self.upstream(name)
        if selector.endswith("+"):
            chosen |= self.downstream(name)
        return chosen

    def run(self, selector: str | None = None) -> DataFrame:
        """Build the selection in order; a failure skips what depends on it.  Returns the result rows."""
        chosen, bad = self.select(selector), set()
        for name in self.order(chosen):
            if name not in chosen and name in self.built:
                continue
            model, begin = self.models[name], time.monotonic()
            if bad & set(model.refs):
                bad.add(name)
                self.results.append((name, "skipped", 0.0, "a reference failed"))
                continue
            try:
                frame = model.build(self.ref)
                if model.materialized == "table":
                    target = f"{self.folder.rstrip('/')}/{name}"
                    frame.write.mode("overwrite").parquet(target)
                    frame = self.spark.read.parquet(target)
                frame.createOrReplaceTempView(name)
                self.built[name] = frame
                self.results.append((name, "success", time.monotonic() - begin, model.materialized))
            except Exception as error:  # reported per model, like a build tool does
                bad.add(name)
                self.results.append((name, "error", time.monotonic() - begin, str(error).split("\n")[0][:300]))
        return self.get_results()

    def test(self) -> DataFrame:
        """unique and not_null tests of the built models: (model, column, test, failures, status)."""
        from pyspark.sql import functions as F

        parts = []
        for m in self.models.values():
            if m.name not in self.built:
                continue
            for c in m.unique:
                parts.append(unique_failures(self.built[m.name], m.name, c).withColumn("test", F.lit("unique")))
            if m.not_null:
                parts.append(not_null_failures(self.built[m.name], m.name, list(m.not_null)).withColumn("test", F.lit("not_null")))
        if not parts:
            return self.spark.createDataFrame([], "table_name string, column_name string, failures long, test string, status string")
        merged = parts[0]
        for p in parts[1:]:
            merged = merged.unionByName(p)
        return merged.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))

    def get_results(self) -> DataFrame:
        return self.spark.createDataFrame(self.results, "node string, status string, seconds double, message string")
