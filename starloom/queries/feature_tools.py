"""Preprocessing and feature tools on the driver tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from starloom.operators import features as FE
from starloom.operators import scaling as SC
from starloom.queries import load, query


def _rounded(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(f"`{c}`"), digits) for c in columns})


def _lines(spark, sf):
    return load(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice", F.nullif("l_quantity", F.lit(25.0)).alias("qty"))


_LINES = "l AS (SELECT l_orderkey, l_partkey, l_extendedprice, nullif(l_quantity, 25.0) AS qty FROM lineitem)"


@query(f"""WITH {_LINES}, m AS (SELECT avg(qty) AS a, quantile_cont(qty, 0.5) AS b FROM l),
f AS (SELECT qty AS c FROM l WHERE qty IS NOT NULL GROUP BY qty ORDER BY count(*) DESC, qty LIMIT 1)
SELECT l_orderkey, l_partkey, l_extendedprice, round(coalesce(qty, a), 6) AS qty_mean, round(coalesce(qty, b), 6) AS qty_median,
 coalesce(qty, c) AS qty_mode, coalesce(qty, -1.0) AS qty_constant FROM l, m, f""")
def feat_fill(spark, sf):
    df = _lines(spark, sf)
    copies = df.select("l_orderkey", "l_partkey", "l_extendedprice", *[F.col("qty").alias(f"qty_{k}") for k in ("mean", "median", "mode", "constant")])
    for column, strategy in (("qty_mean", "mean"), ("qty_median", "median"), ("qty_mode", "most_frequent")):
        copies = SC.FillMissingValue([column], strategy).fit_transform(copies)
    copies = SC.FillMissingValue(["qty_constant"], "constant", -1.0).fit_transform(copies)
    return _rounded(copies, ["qty_mean", "qty_median"])


def _scaled(tool):
    def run(spark, sf):
        df = load(spark, sf, "part").select("p_partkey", "p_retailprice", F.col("p_size").cast("double"), F.lit(3.0).alias("same"))
        return _rounded(tool(["p_retailprice", "p_size", "same"]).fit_transform(df), ["p_retailprice", "p_size", "same"])

    return run


def _scale_sql(shift, divisor):
    def one(c):
        low, size = shift.format(c=c), divisor.format(c=c)
        return f"round(({c} - {low}) / (CASE WHEN {size} = 0 THEN 1 ELSE {size} END), 6) AS {c}"

    stats = ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}, avg({c}) AS mean_{c}, stddev_pop({c}) AS sd_{c}, max(abs({c})) AS top_{c}, "
                      f"quantile_cont({c}, 0.25) AS q1_{c}, quantile_cont({c}, 0.5) AS q2_{c}, quantile_cont({c}, 0.75) AS q3_{c}"
                      for c in ("p_retailprice", "p_size", "same"))
    return (f"WITH p AS (SELECT p_partkey, p_retailprice, CAST(p_size AS DOUBLE) AS p_size, 3.0::DOUBLE AS same FROM part), s AS (SELECT {stats} FROM p) "
            f"SELECT p_partkey, {', '.join(one(c) for c in ('p_retailprice', 'p_size', 'same'))} FROM p, s")


@query(_scale_sql("lo_{c}", "(hi_{c} - lo_{c})"))
def feat_minmax(spark, sf):
    return _scaled(SC.MinMaxScale)(spark, sf)


@query(_scale_sql("mean_{c}", "sd_{c}"))
def feat_standard(spark, sf):
    return _scaled(SC.StandardScale)(spark, sf)


@query(_scale_sql("0", "top_{c}"))
def feat_maxabs(spark, sf):
    return _scaled(SC.MaxAbsScale)(spark, sf)


@query(_scale_sql("q2_{c}", "(q3_{c} - q1_{c})"))
def feat_robust(spark, sf):
    return _scaled(SC.RobustScale)(spark, sf)


@query(f"""WITH {_LINES}, s AS (SELECT quantile_cont(l_extendedprice, 0.25) AS a, quantile_cont(l_extendedprice, 0.5) AS b, quantile_cont(l_extendedprice, 0.75) AS c,
 quantile_cont(qty, 0.25) AS d, quantile_cont(qty, 0.5) AS e, quantile_cont(qty, 0.75) AS f FROM l)
SELECT l_orderkey, l_partkey, round((l_extendedprice - b) / (c - a), 6) AS l_extendedprice, round((qty - e) / (f - d), 6) AS qty FROM l, s""")
def feat_robust_lines(spark, sf):
    """The same scaling on the large table, with nulls kept null."""
    return _rounded(SC.RobustScale(["l_extendedprice", "qty"]).fit_transform(_lines(spark, sf)), ["l_extendedprice", "qty"])


@query("""
WITH o AS (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS o_orderstatus, o_orderpriority FROM orders),
a AS (SELECT o_orderstatus AS v, row_number() OVER (ORDER BY o_orderstatus) - 1 AS code FROM (SELECT DISTINCT o_orderstatus FROM o WHERE o_orderstatus IS NOT NULL)),
b AS (SELECT o_orderpriority AS v, row_number() OVER (ORDER BY o_orderpriority) - 1 AS code FROM (SELECT DISTINCT o_orderpriority FROM o))
SELECT o_orderkey, CAST(a.code AS DOUBLE) AS o_orderstatus, CAST(b.code AS DOUBLE) AS o_orderpriority
FROM o LEFT JOIN a ON o_orderstatus = a.v LEFT JOIN b ON o_orderpriority = b.v""")
def feat_ordinal(spark, sf):
    df = load(spark, sf, "orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"), "o_orderpriority")
    return SC.OrdinalEncode(["o_orderstatus", "o_orderpriority"]).fit_transform(df)


@query("""
WITH c AS (SELECT c_custkey, nullif(c_mktsegment, 'MACHINERY') AS s FROM customer)
SELECT c_custkey, """ + ", ".join(f"CASE WHEN s = '{v}' THEN 1.0 ELSE 0.0 END::DOUBLE AS segment_{v}" for v in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"))
       + ", CASE WHEN s IS NULL THEN 1.0 ELSE 0.0 END::DOUBLE AS segment_nan FROM c")
def feat_onehot(spark, sf):
    df = load(spark, sf, "customer").select("c_custkey", F.nullif("c_mktsegment", F.lit("MACHINERY")).alias("segment"))
    return SC.OneHotEncode(["segment"]).fit_transform(df)


@query("""
WITH f AS (SELECT o_orderkey, nullif(o_orderstatus, 'F') AS s FROM orders WHERE o_orderstatus <> 'P'),
codes AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT coalesce(s, 'nan') AS v FROM f UNION SELECT 'unknown'))
SELECT o_orderkey, coalesce(c.code, (SELECT code FROM codes WHERE v = 'unknown')) AS status
FROM orders LEFT JOIN codes c ON coalesce(nullif(o_orderstatus, 'F'), 'nan') = c.v""")
def feat_label(spark, sf):
    """Fitted without one status, which is unknown when everything is encoded."""
    df = load(spark, sf, "orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("F")).alias("status"))
    known = load(spark, sf, "orders").filter("o_orderstatus <> 'P'").select(F.nullif("o_orderstatus", F.lit("F")).alias("status"))
    return SC.LabelEncode(["status"]).fit(known).transform(df)


@query(f"""WITH {_LINES}, x AS (SELECT l_orderkey, l_partkey, coalesce(qty, 0.0) AS a, l_extendedprice AS b FROM l)
SELECT l_orderkey, l_partkey, a AS "qty", b AS "l_extendedprice", round(a * a, 4) AS "qty^2", round(a * b, 4) AS "qty l_extendedprice", round(b * b, 2) AS "l_extendedprice^2" FROM x""")
def feat_poly(spark, sf):
    df = FE.PolynomialExpansion(["qty", "l_extendedprice", "l_partkey"], "l_partkey", 2).fit_transform(_lines(spark, sf))
    return _rounded(_rounded(df, ["qty^2", "qty l_extendedprice"], 4), ["l_extendedprice^2"], 2)


def _events(spark, sf):
    return load(spark, sf, "events").select("event_id", F.nullif("event_type", F.lit("error")).alias("kind"), "value", "user_id")


_EVENTS = "e AS (SELECT event_id, nullif(event_type, 'error') AS kind, value, user_id FROM events)"


@query(f"WITH {_EVENTS}, c AS (SELECT kind, count(*) AS kind_cnt FROM e WHERE kind IS NOT NULL GROUP BY kind) SELECT e.*, c.kind_cnt FROM e LEFT JOIN c ON e.kind = c.kind")
def feat_catcount(spark, sf):
    return FE.CatCount("kind").fit_transform(_events(spark, sf))


@query(f"""WITH {_EVENTS}, c AS (SELECT kind, round(avg(value), 6) AS kind_target_mean FROM e WHERE kind IS NOT NULL GROUP BY kind)
SELECT e.*, c.kind_target_mean FROM e LEFT JOIN c ON e.kind = c.kind""")
def feat_target_mean(spark, sf):
    return _rounded(FE.TargetMeanEncoder("kind", "value").fit_transform(_events(spark, sf)), ["kind_target_mean"])


def _hash_sql(key, salt):
    return f"CAST('0x' || substr(md5(CAST({key} AS VARCHAR) || '|{salt}'), 1, 8) AS BIGINT)"


@query(f"""WITH {_EVENTS}, f AS (SELECT *, {_hash_sql('event_id', 2021)} % 5 AS fold FROM e),
r AS (SELECT a.user_id, a.fold, coalesce((SELECT avg(b.value) FROM f b WHERE b.user_id = a.user_id AND b.fold <> a.fold), (SELECT avg(value) FROM f)) AS m, a.n
 FROM (SELECT user_id, fold, count(*) AS n FROM f GROUP BY ALL) a),
c AS (SELECT user_id, round(sum(m * n) / sum(n), 6) AS user_id_kf_target_mean FROM r GROUP BY user_id)
SELECT e.*, c.user_id_kf_target_mean FROM e LEFT JOIN c USING (user_id)""")
def feat_kfold(spark, sf):
    tool = FE.KFoldTargetMeanEncoder("user_id", "value", "event_id")
    return _rounded(tool.fit_transform(_events(spark, sf)), ["user_id_kf_target_mean"])


@query(f"""WITH {_EVENTS}, x AS (SELECT e.*, CAST(floor(value / 100) AS INTEGER) AS band FROM e),
a AS (SELECT kind AS v, row_number() OVER (ORDER BY kind NULLS LAST) - 1 AS r FROM (SELECT DISTINCT kind FROM x)),
b AS (SELECT band AS v, row_number() OVER (ORDER BY band NULLS LAST) - 1 AS r FROM (SELECT DISTINCT band FROM x))
SELECT event_id, kind, band, user_id, a.r * (SELECT count(*) FROM b) + b.r AS kind_band FROM x
JOIN a ON x.kind IS NOT DISTINCT FROM a.v JOIN b ON x.band IS NOT DISTINCT FROM b.v""")
def feat_catcross(spark, sf):
    """The user column has too many categories and stays uncrossed."""
    df = _events(spark, sf).select("event_id", "kind", F.floor(F.col("value") / 100).cast("int").alias("band"), "user_id")
    return FE.CatCross(["kind", "band", "event_id"], max_cat_num=100).fit_transform(df)


@query(f"""WITH {_EVENTS}, g AS (SELECT kind, round(avg(value), 6) AS value_mean_by_kind, round(stddev_samp(value), 6) AS value_std_by_kind,
 max(value) AS value_max_by_kind, count(DISTINCT value) AS value_nunique_by_kind FROM e WHERE kind IS NOT NULL GROUP BY kind)
SELECT e.*, g.* EXCLUDE (kind) FROM e LEFT JOIN g ON e.kind = g.kind""")
def feat_groupstat(spark, sf):
    df = FE.GroupStat("kind", "value", ["mean", "std", "max", "nunique"]).fit_transform(_events(spark, sf))
    return _rounded(df, ["value_mean_by_kind", "value_std_by_kind"])


@query(f"""WITH {_LINES}, x AS (SELECT l_orderkey, l_partkey, l_extendedprice, coalesce(qty, 0.0) AS q FROM l),
s AS (SELECT quantile_cont(q, 0.0) AS e0, quantile_cont(q, 0.2) AS e1, quantile_cont(q, 0.4) AS e2, quantile_cont(q, 0.6) AS e3, quantile_cont(q, 0.8) AS e4,
 quantile_cont(l_extendedprice, 0.2) AS p1, quantile_cont(l_extendedprice, 0.4) AS p2, quantile_cont(l_extendedprice, 0.6) AS p3, quantile_cont(l_extendedprice, 0.8) AS p4 FROM x)
SELECT l_orderkey, l_partkey, CAST((l_extendedprice >= p1)::INT + (l_extendedprice >= p2)::INT + (l_extendedprice >= p3)::INT + (l_extendedprice >= p4)::INT AS DOUBLE) AS l_extendedprice,
 CAST((q >= e1)::INT + (q >= e2)::INT + (q >= e3)::INT + (q >= e4)::INT AS DOUBLE) AS qty FROM x, s""")
def feat_bins(spark, sf):
    return FE.SplitBins(["l_extendedprice", "qty"]).fit_transform(_lines(spark, sf))


@query("""
WITH s AS (SELECT min(value) AS lo, max(value) AS hi FROM events)
SELECT event_id, CAST((value >= lo + (hi - lo) * 1 / 5)::INT + (value >= lo + (hi - lo) * 2 / 5)::INT + (value >= lo + (hi - lo) * 3 / 5)::INT
 + (value >= lo + (hi - lo) * 4 / 5)::INT AS DOUBLE) AS value FROM events, s""")
def feat_bins_uniform(spark, sf):
    return FE.SplitBins(["value"], "uniform").fit_transform(load(spark, sf, "events").select("event_id", "value"))


_MOVED = ", ".join(f"coalesce(sum(v * n) FILTER (k = {i}) / sum(n) FILTER (k = {i}), cs[{i + 1}])" for i in range(5))
_NEAREST = " + ".join(f"(v >= (cs[{i}] + cs[{i + 1}]) / 2)::INT" for i in range(1, 5))


@query(f"""
WITH RECURSIVE counted AS (SELECT coalesce(value, 0.0)::DOUBLE AS v, count(*) AS n FROM events GROUP BY ALL),
s AS (SELECT min(v) AS lo, max(v) AS hi, 1e-4 * (sum(v * v * n) / sum(n) - (sum(v * n) / sum(n)) ** 2) AS small FROM counted),
rounds AS (
  SELECT 0 AS i, list_transform(range(0, 5), lambda k: lo + (hi - lo) / 5 * (k + 0.5)) AS cs, CAST('infinity' AS DOUBLE) AS shift FROM s
  UNION ALL
  SELECT i + 1, moved, list_sum(list_transform(range(1, 6), lambda k: (moved[k] - cs[k]) ** 2)) FROM (
    SELECT i, cs, list_sort([{_MOVED}]) AS moved FROM (SELECT i, cs, v, n, {_NEAREST} AS k FROM rounds, counted, s WHERE shift > small AND i < 300) GROUP BY i, cs)),
last AS (SELECT cs FROM rounds ORDER BY i DESC LIMIT 1)
SELECT event_id, CAST({_NEAREST.replace("v >=", "coalesce(value, 0.0) >=")} AS DOUBLE) AS value FROM events, last""")
def feat_bins_kmeans(spark, sf):
    return FE.SplitBins(["value"], "kmeans").fit_transform(load(spark, sf, "events").select("event_id", "value"))


@query("""
WITH t AS (SELECT event_id, CASE WHEN event_type = 'error' THEN 'not a time' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS stamp FROM events),
p AS (SELECT *, TRY_CAST(stamp AS TIMESTAMP) AS x FROM t)
SELECT event_id, stamp, CAST(year(x) AS INTEGER) AS year, CAST(month(x) AS INTEGER) AS month, CAST(day(x) AS INTEGER) AS day, CAST(hour(x) AS INTEGER) AS hour,
 CAST(isodow(x) AS INTEGER) AS dayofweek, CASE WHEN isodow(x) >= 6 THEN 1 ELSE 0 END AS is_weekend FROM p""")
def feat_time(spark, sf):
    text = F.when(F.col("event_type") == "error", "not a time").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return FE.ExtractTimeComps("stamp").fit_transform(load(spark, sf, "events").select("event_id", text.alias("stamp")))


def _wide(spark, sf):
    p = load(spark, sf, "part")
    return p.select(
        "p_partkey", "p_name", F.col("p_partkey").cast("string").alias("code"), "p_type", "p_size", "p_retailprice",
        F.lit(None).cast("double").alias("empty"), F.lit(5).alias("same"),
        F.when(F.col("p_size") == 1, F.lit(float("-inf"))).otherwise(F.col("p_retailprice")).alias("endless"))


@query("""
WITH w AS (SELECT p_partkey, p_name, CAST(p_partkey AS VARCHAR) AS code, p_type, p_size, p_retailprice,
 CASE WHEN p_size = 1 THEN '-infinity'::DOUBLE ELSE p_retailprice END AS endless FROM part)
SELECT 'p_partkey' AS feature, count(DISTINCT p_partkey) > 1 AS kept FROM w
UNION ALL SELECT 'p_name', count(DISTINCT p_name) > 1 AND count(DISTINCT p_name) < count(*) FROM w
UNION ALL SELECT 'code', count(DISTINCT code) > 1 AND count(DISTINCT code) < count(*) FROM w
UNION ALL SELECT 'p_type', count(DISTINCT p_type) > 1 AND count(DISTINCT p_type) < count(*) FROM w
UNION ALL SELECT 'p_size', count(DISTINCT p_size) > 1 FROM w UNION ALL SELECT 'empty', false UNION ALL SELECT 'same', false
UNION ALL SELECT 'endless', count(DISTINCT endless) > 1 AND NOT bool_or(isinf(endless)) FROM w UNION ALL SELECT 'p_retailprice', true""")
def feat_select_general(spark, sf):
    df = _wide(spark, sf)
    kept = FE.GeneralSelection("p_retailprice").fit_transform(df).columns
    return spark.createDataFrame([(c, c in kept) for c in df.columns], "feature string, kept boolean")


@query("""
SELECT 'l_quantity' AS feature, var_pop(l_quantity) > 0.5 AS kept FROM lineitem UNION ALL SELECT 'l_discount', var_pop(l_discount) > 0.5 FROM lineitem
UNION ALL SELECT 'l_linenumber', var_pop(l_linenumber) > 0.5 FROM lineitem UNION ALL SELECT 'empty', false UNION ALL SELECT 'l_tax', true""")
def feat_select_variance(spark, sf):
    df = load(spark, sf, "lineitem").select("l_quantity", "l_discount", "l_linenumber", F.lit(None).cast("double").alias("empty"), "l_tax")
    kept = FE.VarianceBasedSelection("l_tax", 0.5).fit_transform(df).columns
    return spark.createDataFrame([(c, c in kept) for c in df.columns], "feature string, kept boolean")


@query()
def feat_select_tree(spark, sf):
    tool = FE.TreeBasedSelection("p_retailprice", "reg", trees=5, depth=4)
    df = load(spark, sf, "part").select("p_partkey", "p_size", F.lit(1.0).alias("same"), "p_retailprice")
    tool.fit(df)
    return spark.createDataFrame([(c, float(w), c in tool.kept) for c, w in tool.importances.items()], "feature string, importance double, kept boolean")


@query(f"""
SELECT l.doc_id, quality, toxic, CASE WHEN {_hash_sql('l.doc_id', 100)} % 100 < 20 THEN 'test'
 WHEN {_hash_sql('l.doc_id', '100-dev')} % 100 < 25 THEN 'dev' ELSE 'train' END AS split FROM labels l""")
def split_dataset(spark, sf):
    return FE.split_train_dev_test(load(spark, sf, "labels"), "doc_id")


@query(f"""
WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY {_hash_sql('doc_id', 42)}, doc_id) AS rn FROM documents)
SELECT doc_id, CASE WHEN rn <= 100 THEN 'sample' ELSE 'rest' END AS part FROM r""")
def sample_complement(spark, sf):
    chosen, rest = FE.seeded_sample(load(spark, sf, "documents").select("doc_id"), "doc_id", 100, 42)
    return chosen.withColumn("part", F.lit("sample")).unionByName(rest.withColumn("part", F.lit("rest")))


@query(f"""
SELECT source AS task, doc_id, n_chars FROM (SELECT source, doc_id, n_chars, row_number() OVER (PARTITION BY source ORDER BY {_hash_sql('doc_id', 7)}, doc_id) AS rn FROM documents) WHERE rn = 1""")
def one_row_per_task(spark, sf):
    return FE.one_row_per_task(load(spark, sf, "documents").select(F.col("source").alias("task"), "doc_id", "n_chars"), "task", "doc_id", 7)


@query("""
WITH d AS (SELECT doc_id, lang, nullif(source, 'src3') AS source, n_chars, nullif(quality, 0) AS quality FROM documents LEFT JOIN labels USING (doc_id))
SELECT count(DISTINCT lang) AS number_of_classes, 5::BIGINT AS number_of_features, count(*) AS number_of_instances,
 CAST(sum(CASE WHEN source IS NULL OR quality IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS instances_with_missing,
 CAST(sum((source IS NULL)::INT + (quality IS NULL)::INT) AS BIGINT) AS missing_values, 3::BIGINT AS numeric_features, 2::BIGINT AS symbolic_features FROM d""")
def dataset_info(spark, sf):
    d = load(spark, sf, "documents").join(load(spark, sf, "labels"), "doc_id", "left").select(
        "doc_id", "lang", F.nullif("source", F.lit("src3")).alias("source"), "n_chars", F.nullif("quality", F.lit(0)).alias("quality"))
    return SC.dataset_metadata(d, "lang")


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, '{f}' AS family, count(*) AS columns FROM information_schema.columns WHERE table_name = '{t}' AND data_type {c} HAVING count(*) > 0"
                          for t in ("orders", "lineitem", "events", "embeddings", "documents") for f, c in (
                              ("Category", "= 'VARCHAR'"), ("Numeric", "IN ('INTEGER', 'BIGINT', 'DOUBLE')"), ("Datetime", "LIKE 'TIMESTAMP%'"), ("Others", "LIKE '%[]'"))))
def column_info(spark, sf):
    rows = [(t, family, len(names)) for t in ("orders", "lineitem", "events", "embeddings", "documents")
            for family, names in SC.column_families(load(spark, sf, t)).items() if names]
    return spark.createDataFrame(rows, "table_name string, family string, columns long")


def _union(parts):
    return reduce(DataFrame.unionByName, parts)


@query(" UNION ALL ".join(f"SELECT '{c}' AS target, CASE WHEN count(DISTINCT {c}) = 2 THEN 'f1 binary' WHEN count(DISTINCT {c}) BETWEEN 3 AND 200 THEN 'f1 weighted' ELSE 'rmse' END AS metric FROM {t}"
                          for t, c in (("labels", "quality"), ("documents", "lang"), ("documents", "n_chars"), ("part", "p_brand"))))
def metric_choice(spark, sf):
    pairs = (("labels", "quality"), ("documents", "lang"), ("documents", "n_chars"), ("part", "p_brand"))
    counts = _union([load(spark, sf, t).agg(F.lit(c).alias("target"), F.count_distinct(F.col(c)).alias("n")) for t, c in pairs])
    return spark.createDataFrame([(r.target, SC.metric_for_classes(r.n)) for r in counts.collect()], "target string, metric string")
