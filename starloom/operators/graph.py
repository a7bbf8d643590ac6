"""Triples, reachability, dependency levels and tree statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from starloom.session import cut_lineage

# Predicate and class words of the code graph.
IS, HAS_CLASS, HAS_FUNCTION, HAS_CLASS_METHOD = "is", "has_class", "has_function", "has_class_method"
HAS_CLASS_PROPERTY, HAS_DETAIL, IS_COMPOSITE_OF = "has_class_property", "has_detail", "isCompositeOf"
IS_AGGREGATE_OF = "isAggregateOf"
FILE_TYPES = {".py": "python", ".js": "javascript"}


def last_edges(triples: DataFrame) -> DataFrame:
    """One predicate per (subject, object): a later insert overwrites the earlier one."""
    return triples.groupBy("subject", "object").agg(
        F.max_by("predicate", "seq").alias("predicate"), F.max("seq").alias("seq")
    ).select("subject", "predicate", "object", "seq")


def _pattern(subject: str, predicate: str, object_: str) -> Column:
    wanted = {"subject": subject, "predicate": predicate, "object": object_}
    return reduce(lambda a, b: a & b, [F.col(k) == v for k, v in wanted.items() if v], F.lit(True))


def select(triples: DataFrame, subject: str = "", predicate: str = "", object_: str = "") -> DataFrame:
    """Triples matching the given parts; an empty part matches anything."""
    return triples.filter(_pattern(subject, predicate, object_))


def delete(triples: DataFrame, subject: str = "", predicate: str = "", object_: str = "") -> tuple[DataFrame, int]:
    """Remaining triples and the number removed; an empty pattern removes nothing."""
    if not (subject or predicate or object_):
        return triples, 0
    hit = _pattern(subject, predicate, object_)
    return triples.filter(~hit), triples.filter(hit).count()


def _spo(df: DataFrame, subject, predicate: str, object_) -> DataFrame:
    part = [F.lit(x) if isinstance(x, str) else x for x in (subject, predicate, object_)]
    return df.select(part[0].alias("subject"), part[1].alias("predicate"), part[2].alias("object"))


def _joined(*parts) -> Column:
    return F.concat_ws(":", *parts)


def _file_kind(path: Column) -> Column:
    suffix = F.regexp_extract(path, r"(\.[^./]+)$", 1)
    kind = F.lit("")
    for s, name in FILE_TYPES.items():
        kind = F.when(suffix == s, name).otherwise(kind)
    return kind


def file_triples(files: DataFrame) -> DataFrame:
    """Triples of files (file, classes array<struct<name,methods>>, functions, globals)."""
    files = cut_lineage(files)  # read by every part below
    f = F.col("file")
    classes = files.select("file", F.explode("classes").alias("c")).select("file", "c.name", "c.methods")
    methods = classes.select("file", "name", F.explode("methods").alias("m"))
    functions = files.select("file", F.explode("functions").alias("fn"))
    names = files.select("file", F.explode("globals").alias("g"))
    cls, method = _joined("file", "name"), _joined("file", "name", "m")
    parts = [
        _spo(files, f, IS, "source_code"), _spo(files, f, IS, _file_kind(f)),
        _spo(classes, f, HAS_CLASS, cls), _spo(classes, cls, IS, "class"),
        _spo(methods, cls, HAS_CLASS_METHOD, method), _spo(methods, method, IS, "class_method"),
        _spo(functions, f, HAS_FUNCTION, _joined("file", "fn")), _spo(functions, _joined("file", "fn"), IS, "function"),
        _spo(names, _joined("file", "g"), IS, "global_variable"),
    ]
    return reduce(DataFrame.unionByName, parts).distinct()


def class_triples(views: DataFrame) -> DataFrame:
    """Triples of class views (package ``file:Class``, maps of attributes and methods, names of compositions and aggregations).

    The classes that a class is composed of are known by their short names only; ``resolve_names``
    finds the whole ones.
    """
    views = cut_lineage(views)  # read by every part below
    file, package = F.split_part("package", F.lit(":"), F.lit(1)), F.col("package")
    attributes = views.select("package", F.explode("attributes").alias("k", "v"))
    methods = views.select("package", F.explode("methods").alias("k", "v"))
    prop = _joined("package", "k")
    parts = [
        _spo(views, file, IS, "source_code"), _spo(views, file, IS, _file_kind(file)),
        _spo(views, file, HAS_CLASS, package), _spo(views, package, IS, "class"),
        _spo(views, package, HAS_DETAIL, F.to_json(F.struct(*views.columns))),
        _spo(attributes, package, HAS_CLASS_PROPERTY, prop), _spo(attributes, prop, IS, "class_property"),
        _spo(attributes, prop, HAS_DETAIL, F.col("v")), _spo(methods, package, HAS_CLASS_METHOD, prop), _spo(methods, prop, IS, "class_method"),
        _spo(methods, prop, HAS_DETAIL, F.col("v")),
    ]
    for column, predicate in (("compositions", IS_COMPOSITE_OF), ("aggregations", IS_AGGREGATE_OF)):
        if column in views.columns:
            names = views.select("package", F.explode(column).alias("n"))
            parts.append(_spo(names, package, predicate, _joined(F.lit("?"), F.col("n"))))
    return reduce(DataFrame.unionByName, parts).distinct()


def relation_triples(relations: DataFrame) -> DataFrame:
    """``is<rel>Of`` for every relation, ``is<rel>On`` with the label where there is one."""
    labelled = relations.filter(F.coalesce(F.col("label"), F.lit("")) != "")
    of = _spo(relations, F.col("src"), F.concat(F.lit(IS), "relationship", F.lit("Of")), F.col("dest"))
    on = _spo(labelled, F.col("src"), F.concat(F.lit(IS), "relationship", F.lit("On")), _joined("dest", "label"))
    return of.unionByName(on)


def resolve_names(triples: DataFrame, predicate: str = IS_COMPOSITE_OF) -> DataFrame:
    """Objects ``?:Name`` replaced where exactly one class has that short name."""
    classes = select(triples, predicate=IS, object_="class").select("subject").distinct()
    short = F.when(F.instr("subject", ":") > 0, F.regexp_extract("subject", r"^[^:]*:(.*)$", 1)).otherwise(F.col("subject"))
    unique = classes.groupBy(short.alias("__short")).agg(F.count(F.lit(1)).alias("__n"), F.min("subject").alias("__full")).filter(
        "__n = 1"
    ).select("__short", "__full")
    open_name = F.when((F.col("predicate") == predicate) & F.col("object").startswith("?:"), F.expr("substring(object, 3)"))
    joined = triples.withColumn("__name", open_name).join(unique, F.col("__name") == F.col("__short"), "left")
    return joined.withColumn("object", F.coalesce("__full", "object")).drop("__name", "__short", "__full")


def class_view(triples: DataFrame, package: str) -> DataFrame:
    """Properties and methods of one class with their details where known."""
    members = select(triples, subject=package).filter(F.col("predicate").isin(HAS_CLASS_PROPERTY, HAS_CLASS_METHOD))
    details = select(triples, predicate=HAS_DETAIL).select(F.col("subject").alias("__s"), F.col("object").alias("detail"))
    return members.join(details, F.col("object") == F.col("__s"), "left").drop("__s")


def reachable(edges: DataFrame, sources: DataFrame, max_rounds: int = 10_000) -> DataFrame:
    """(node, depth) of every node reachable from ``sources`` (column node); edges are (src, dst).

    Breadth first: only the last frontier is joined, and nodes already visited
    leave by an anti-join.  A node reached over many edges is reduced to one row
    before the anti-join, so a hub does not multiply.
    """
    frontier = cut_lineage(sources.select("node").distinct().withColumn("depth", F.lit(0)))
    visited = frontier
    for depth in range(1, max_rounds + 1):
        step = edges.join(frontier.select(F.col("node").alias("src")), "src", "left_semi").select(F.col("dst").alias("node")).distinct()
        frontier = cut_lineage(step.join(visited, "node", "left_anti").withColumn("depth", F.lit(depth)))
        if frontier.isEmpty():
            return visited
        visited = visited.unionByName(frontier)  # every frontier is written once
    raise RuntimeError(f"no end after {max_rounds} rounds")


def dependency_levels(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, level) in run order; nodes on or behind a cycle get a null level.

    ``edges`` are (src needed by dst).  Each round drops the edges leaving the
    nodes just released; the next nodes are those edges' targets that keep no
    other edge.  Only edges still open are rewritten, and the rounds equal the
    depth of the graph.
    """
    known = nodes.select("node").distinct()
    inner = edges.join(known.withColumnRenamed("node", "dst"), "dst", "left_semi")
    open_edges = cut_lineage(inner.select("src", "dst").distinct())
    ready = cut_lineage(known.join(open_edges.select(F.col("dst").alias("node")), "node", "left_anti"))
    done, level = [], 0
    while not ready.isEmpty():
        done.append(ready.withColumn("level", F.lit(level)))
        sources = ready.withColumnRenamed("node", "src")
        released = open_edges.join(sources, "src", "left_semi").select(F.col("dst").alias("node")).distinct()
        open_edges = cut_lineage(open_edges.join(sources, "src", "left_anti"))
        ready = cut_lineage(released.join(open_edges.select(F.col("dst").alias("node")), "node", "left_anti"))
        level += 1
    if open_edges.isEmpty():
        return reduce(DataFrame.unionByName, done)
    placed = reduce(DataFrame.unionByName, done, known.limit(0).withColumn("level", F.lit(0)))
    return placed.unionByName(known.join(placed, "node", "left_anti").withColumn("level", F.lit(None).cast("int")))


DEEP = 64  # levels after which a tree is searched for cycles


def reject_cycles(links: DataFrame) -> None:
    """Raise when a chain of parents never ends; ``links`` holds (node, up).

    Every pass doubles the number of levels that a pointer spans, so after log2(n) passes
    only nodes above which there is a cycle still point anywhere.
    """
    ahead, span = cut_lineage(links.filter("up is not null")), 1
    nodes = links.count()
    while span <= nodes and not ahead.isEmpty():
        step = ahead.select(F.col("node").alias("__n"), F.col("up").alias("__u"))
        ahead, span = cut_lineage(ahead.join(step, F.col("up") == F.col("__n")).select("node", F.col("__u").alias("up"))), span * 2
    caught = ahead.select("node").first()
    if caught is not None:
        raise ValueError(f"the parents of node {caught[0]!r} form a cycle")


def node_totals(nodes: DataFrame) -> DataFrame:
    """Own and inherited reward of every tree node (node, parent, value, visits).

    Totals climb one level per round, summed per parent before the next join,
    so the root receives one row per child and not one per leaf.
    """
    links = nodes.select("node", F.col("parent").alias("up"))
    own = nodes.select("node", F.coalesce("value", F.lit(0.0)).alias("value"), F.coalesce("visits", F.lit(0)).cast("long").alias("visits"))
    parts, moving = [own], own
    while True:
        if len(parts) == DEEP:
            reject_cycles(links)
        climbed = moving.join(links, "node").filter("up is not null").groupBy(F.col("up").alias("node")).agg(
            F.sum("value").alias("value"), F.sum("visits").alias("visits"))
        moving = cut_lineage(climbed)
        if moving.isEmpty():
            break
        parts.append(moving)
    total = reduce(DataFrame.unionByName, parts).groupBy("node").agg(F.sum("value").alias("value"), F.sum("visits").alias("visits"))
    return total.withColumn("avg_value", F.when(F.col("visits") == 0, 0.0).otherwise(F.col("value") / F.col("visits")))


def distinct_instructions(nodes: DataFrame, instructions: str) -> DataFrame:
    """Nodes, instructions in all of them, and distinct instructions."""
    said = nodes.select("node", F.explode_outer(instructions).alias("__i"))
    per = said.groupBy("__i").agg(F.count(F.lit(1)).alias("__n"))
    return per.agg(F.coalesce(F.sum(F.when(F.col("__i").isNotNull(), F.col("__n"))), F.lit(0)).alias("instructions"),
                   F.count("__i").alias("distinct_instructions"))


# Exploration weight and the visit count standing in for none.
EXPLORE, UNVISITED = 1.4, 0.8


def upper_confidence(totals: DataFrame, parents: DataFrame) -> DataFrame:
    """Score of every non-root node: mean value plus an exploration bonus from the parent's visits."""
    up = totals.select(F.col("node").alias("parent"), F.col("visits").alias("parent_visits"))
    n = F.when(F.col("visits") > 0, F.col("visits").cast("double")).otherwise(F.lit(UNVISITED))
    score = F.col("value") / n + EXPLORE * F.sqrt(F.ln("parent_visits") / n)
    return totals.join(parents.filter("parent is not null").select("node", "parent"), "node").join(up, "parent").withColumn("uct", score)


def best_node(nodes: DataFrame, score: str) -> DataFrame:
    """Highest score; equal scores go to the node met first in preorder.

    ``place`` is a node's position among its siblings.  Only nodes holding the
    top score are compared, by their chain of positions from the root.
    """
    top = nodes.agg(F.max(score)).first()[0]
    links = nodes.select("node", F.col("parent").alias("__up"), F.col("place").alias("__pl"))
    chains = nodes.filter(F.col(score) == F.lit(top)).select(F.col("node").alias("best"), "parent", F.array("place").alias("path"))
    done = []
    while not chains.isEmpty():
        if len(done) == DEEP:
            reject_cycles(nodes.select("node", F.col("parent").alias("up")))
        done.append(chains.filter("parent is null").select("best", "path"))
        chains = cut_lineage(chains.filter("parent is not null").join(links, F.col("parent") == F.col("node")).select(
            "best", F.col("__up").alias("parent"), F.concat(F.array("__pl"), "path").alias("path")))
    return reduce(DataFrame.unionByName, done).agg(F.min_by("best", "path").alias("node")).withColumn(score, F.lit(top))
