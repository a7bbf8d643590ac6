"""Dimensions, facts and KPIs on the driver tables."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from starloom.functions import scalars as S
from starloom.operators import dimensions as D
from starloom.operators import facts as FA
from starloom.operators.ordering import number_rows, rank_rows
from starloom.queries import load, query
from starloom.session import cut_lineage

AS_OF = "2005-06-15"

SEASON_SQL = """CASE WHEN month({0}) IN (12, 1, 2) THEN 'Winter' WHEN month({0}) IN (3, 4, 5) THEN 'Spring'
 WHEN month({0}) IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END"""


def season(d):
    m = F.month(d)
    return F.when(m.isin(12, 1, 2), "Winter").when(m.isin(3, 4, 5), "Spring").when(m.isin(6, 7, 8), "Summer").otherwise("Autumn")


def contracts(spark, sf):
    """One contract per customer and order priority: first to last order, open when the last is recent."""
    o = load(spark, sf, "orders")
    last = F.max("o_orderdate")
    rows = o.groupBy(F.col("o_custkey").alias("person_id"), F.col("o_orderpriority").alias("category")).agg(
        F.min("o_orderdate").cast("date").alias("start_date"),
        F.when(last < F.lit("2001-01-01").cast("timestamp_ntz"), last.cast("date")).alias("end_date"),
    )
    birth = F.date_add(F.lit("1940-01-01").cast("date"), (F.col("person_id") * 37 % 20000).cast("int"))
    # spine, snapshot and dimensions all read the contracts: group the orders once
    return cut_lineage(rows.withColumn("birth_date", birth))


CONTRACTS = """contracts AS (
 SELECT o_custkey AS person_id, o_orderpriority AS category, CAST(min(o_orderdate) AS DATE) AS start_date,
  CASE WHEN max(o_orderdate) < TIMESTAMP '2001-01-01' THEN CAST(max(o_orderdate) AS DATE) END AS end_date,
  DATE '1940-01-01' + CAST(o_custkey * 37 % 20000 AS INTEGER) AS birth_date
 FROM orders GROUP BY o_custkey, o_orderpriority)"""

SPINE = """spine AS (
 SELECT DISTINCT CAST(date_trunc('month', start_date) AS DATE) AS m FROM contracts WHERE start_date IS NOT NULL
 UNION SELECT DISTINCT CAST(date_trunc('month', end_date) AS DATE) FROM contracts WHERE end_date IS NOT NULL)"""

ACTIVE = """active AS (
 SELECT s.m AS month_date, c.* FROM spine s JOIN contracts c
  ON s.m BETWEEN date_trunc('month', c.start_date) AND date_trunc('month', coalesce(c.end_date, s.m)))"""


def _band_sql(years, bands):
    cases = " ".join(f"WHEN {years} < {u} THEN '{b}'" for u, b in bands[:-1])
    return f"CASE {cases} ELSE '{bands[-1][1]}' END"


def _years_sql(a, b):
    return f"date_part('year', age({b}, {a}))"


@query("""
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date, CAST(year(d) AS INTEGER) AS year,
 CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day, CAST(week(d) AS INTEGER) AS week_number,
 CAST(strftime(d, '%W') AS INTEGER) AS monday_week, dayname(d) AS day_of_week
FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION SELECT CAST(l_shipdate AS DATE) FROM lineitem)
WHERE d IS NOT NULL""")
def dim_date(spark, sf):
    days = load(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("d")).union(
        load(spark, sf, "lineitem").select(F.col("l_shipdate").cast("date")))
    return D.date_dimension(days, "d")


@query("""
SELECT DISTINCT ts AS time_stamp, CAST(ts AS DATE) AS date, strftime(ts, '%Y-W%W') AS week FROM events WHERE ts IS NOT NULL""")
def dim_time_week(spark, sf):
    t = F.col("ts")
    week = F.concat(F.year(t).cast("string"), F.lit("-W"), F.lpad(S.monday_week(t).cast("string"), 2, "0"))
    return load(spark, sf, "events").filter(t.isNotNull()).select(
        t.alias("time_stamp"), t.cast("date").alias("date"), week.alias("week")).distinct()


@query("""
WITH m AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders
 UNION SELECT DISTINCT CAST(date_trunc('month', l_shipdate) AS DATE) FROM lineitem)
SELECT row_number() OVER (ORDER BY month) AS date_key, month, strftime(month, '%B') AS month_name,
 CAST(year(month) AS INTEGER) AS year, strftime(month, '%Y-%m') AS year_month_key FROM m WHERE month IS NOT NULL""")
def dim_month(spark, sf):
    days = load(spark, sf, "orders").select(F.col("o_orderdate").alias("d")).union(load(spark, sf, "lineitem").select("l_shipdate"))
    return D.month_dimension(days, "d")


@query("""
SELECT c_custkey AS customer_id, trim(c_name) AS name, nullif(c_mktsegment, 'BUILDING') AS company,
 CASE WHEN nullif(c_mktsegment, 'BUILDING') IS NOT NULL THEN 'B2B' ELSE 'consumer' END AS customer_segment,
 CASE WHEN upper(coalesce(left(c_mktsegment, 1), '')) IN ('M', 'MALE') THEN 'Male'
  WHEN upper(coalesce(left(c_mktsegment, 1), '')) IN ('F', 'FEMALE') THEN 'Female' ELSE 'Unknown' END AS gender
FROM customer""")
def dim_customer_segment(spark, sf):
    company = F.nullif("c_mktsegment", F.lit("BUILDING"))
    return load(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.trim("c_name").alias("name"), company.alias("company"),
        F.when(company.isNotNull(), "B2B").otherwise("consumer").alias("customer_segment"),
        S.gender_label(F.left("c_mktsegment", F.lit(1))).alias("gender"),
    )


@query("""
SELECT DISTINCT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, p_type AS product_category,
 p_brand AS brand_name, CAST(p_retailprice AS DOUBLE) AS list_price, CAST(p_size AS BIGINT) AS quantity,
 CAST(NULL AS VARCHAR) AS product_details FROM part""")
def dim_product(spark, sf):
    renamed = load(spark, sf, "part").select(
        F.col("p_partkey").alias("Uniqe Id"), F.col("p_name").alias("Product Name"), F.col("p_type").alias("Category"),
        F.col("p_brand").alias("Brand Name"), F.col("p_retailprice").alias("List Price"), F.col("p_size").alias("Quantity"))
    return renamed.select(
        F.col("`Uniqe Id`").cast("string").alias("product_id"), F.col("`Product Name`").alias("product_name"),
        F.col("Category").alias("product_category"), F.col("`Brand Name`").alias("brand_name"),
        F.col("`List Price`").cast("double").alias("list_price"), F.col("Quantity").cast("bigint").alias("quantity"),
        F.lit(None).cast("string").alias("product_details")).distinct()


@query("""
WITH s AS (SELECT n.n_name AS store_name FROM supplier JOIN nation n ON s_nationkey = n_nationkey
 UNION SELECT n.n_name FROM customer JOIN nation n ON c_nationkey = n_nationkey)
SELECT row_number() OVER (ORDER BY store_name) AS store_key, store_name FROM s WHERE store_name IS NOT NULL""")
def dim_store_union(spark, sf):
    n = load(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("store_name"))
    s = load(spark, sf, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select("store_name")
    c = load(spark, sf, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("store_name")
    return D.keyed(D.union_members([s, c]), "store_key")


@query("""
WITH s AS (SELECT DISTINCT p_type AS category FROM part WHERE p_type IS NOT NULL)
SELECT row_number() OVER (ORDER BY category) AS category_key, category FROM s""")
def dim_category(spark, sf):
    return D.keyed(D.distinct_members(load(spark, sf, "part"), F.col("p_type").alias("category")), "category_key")


@query("""
SELECT row_number() OVER (ORDER BY person_identifier) AS person_key, person_identifier, person_identifier AS individual_code,
 CAST(NULL AS VARCHAR) AS person_name
FROM (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS person_identifier FROM orders WHERE o_custkey IS NOT NULL)""")
def dim_person(spark, sf):
    people = D.distinct_members(load(spark, sf, "orders"), F.col("o_custkey").cast("string").alias("person_identifier"))
    return D.keyed(people, "person_key").select(
        "person_key", "person_identifier", F.col("person_identifier").alias("individual_code"),
        F.lit(None).cast("string").alias("person_name"))


@query(f"""WITH {CONTRACTS}, s AS (SELECT DISTINCT
 {_band_sql(_years_sql('birth_date', f"DATE '{AS_OF}'"), S.AGE_BANDS)} AS age_band FROM contracts WHERE birth_date IS NOT NULL)
SELECT row_number() OVER (ORDER BY age_band) AS age_band_key, age_band FROM s""")
def dim_age_band(spark, sf):
    return D.band_dimension(contracts(spark, sf), F.col("birth_date"), F.lit(AS_OF).cast("date"), S.AGE_BANDS, "age_band")


@query(f"""WITH {CONTRACTS}, s AS (SELECT DISTINCT
 {_band_sql(_years_sql('start_date', f"DATE '{AS_OF}'"), S.SENIORITY_BANDS)} AS seniority FROM contracts WHERE start_date IS NOT NULL)
SELECT row_number() OVER (ORDER BY seniority) AS seniority_key, seniority FROM s""")
def dim_seniority(spark, sf):
    return D.band_dimension(contracts(spark, sf), F.col("start_date"), F.lit(AS_OF).cast("date"), S.SENIORITY_BANDS, "seniority")


@query(f"""WITH {CONTRACTS}, s AS (SELECT DISTINCT CAST(person_id AS VARCHAR) AS contract_identifier,
 start_date AS contract_start_date, end_date AS contract_end_date,
 CASE WHEN end_date IS NULL THEN 'active' ELSE 'ended' END AS contract_status FROM contracts WHERE person_id IS NOT NULL)
SELECT row_number() OVER (ORDER BY contract_identifier, contract_start_date, contract_end_date NULLS LAST) AS contract_key, * FROM s""")
def dim_contract(spark, sf):
    return D.contract_dimension(contracts(spark, sf), "person_id", "start_date", "end_date")


@query(f"""
WITH cat AS (SELECT row_number() OVER (ORDER BY category) AS category_key, category
 FROM (SELECT DISTINCT p_type AS category FROM part WHERE p_type IS NOT NULL)),
j AS (SELECT l_orderkey AS order_id, l_linenumber AS line_number, o.o_custkey AS customer_key, p.p_partkey AS product_key,
  cat.category_key, CAST(strftime(o.o_orderdate, '%Y%m%d') AS INTEGER) AS date_key, {SEASON_SQL.format('o.o_orderdate')} AS season_key,
  l_extendedprice AS purchase_amount, 1 AS transaction_count, CASE WHEN l_discount > 0 THEN 1 ELSE 0 END AS discount_applied_count,
  CASE WHEN lower(l_returnflag) = 'r' THEN 1 ELSE 0 END AS return_count
 FROM lineitem LEFT JOIN orders o ON l_orderkey = o.o_orderkey LEFT JOIN part p ON l_partkey = p.p_partkey
 LEFT JOIN cat ON lower(trim(p.p_type)) = lower(trim(cat.category)))
SELECT row_number() OVER (ORDER BY order_id, line_number, product_key, purchase_amount, discount_applied_count, return_count) AS sales_key, * FROM j""")
def fact_sales_star(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    p = load(spark, sf, "part").select("p_partkey", S.safe_key(F.col("p_type")).alias("type_key"))
    cat = dim_category(spark, sf).withColumn("cat_text", S.safe_key(F.col("category")))
    lines = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_discount", "l_returnflag")
    joined = lines.join(o, F.col("l_orderkey") == F.col("o_orderkey"), "left").join(p, F.col("l_partkey") == F.col("p_partkey"), "left")
    keyed = D.lookup_key(joined, cat, {"type_key": "cat_text"}, "category_key")
    fact = keyed.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_number"), F.col("o_custkey").alias("customer_key"),
        F.col("p_partkey").alias("product_key"), "category_key", F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("date_key"),
        season(F.col("o_orderdate")).alias("season_key"), F.col("l_extendedprice").alias("purchase_amount"),
        F.lit(1).alias("transaction_count"), S.flag(F.col("l_discount") > 0).alias("discount_applied_count"),
        S.flag(F.lower("l_returnflag") == "r").alias("return_count"))
    order = ["order_id", "line_number", "product_key", "purchase_amount", "discount_applied_count", "return_count"]
    return number_rows(fact, order, "sales_key")


@query("""
WITH b AS (SELECT CAST(ts AS DATE) AS full_date, user_id, lower(trim(event_type)) AS interaction_type_name FROM events WHERE ts IS NOT NULL),
g AS (SELECT full_date, user_id, interaction_type_name, count(*) AS interaction_count,
 CAST(sum(CASE WHEN interaction_type_name = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS purchase_count,
 CAST(sum(CASE WHEN interaction_type_name = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS view_count,
 CAST(sum(CASE WHEN interaction_type_name = 'add-to-cart' THEN 1 ELSE 0 END) AS BIGINT) AS add_to_cart_count
 FROM b GROUP BY ALL)
SELECT row_number() OVER (ORDER BY full_date, user_id, interaction_type_name) AS interaction_fact_key, * FROM g""")
def fact_interaction_daily(spark, sf):
    counts = FA.interaction_counts(load(spark, sf, "events"), "ts", ["user_id"], "event_type", ["purchase", "view", "add-to-cart"])
    return number_rows(counts, ["full_date", "user_id", "interaction_type_name"], "interaction_fact_key")


@query("""
WITH pe AS (SELECT CAST(o_orderdate AS DATE) AS full_date, o_custkey AS customer_id, l_extendedprice AS price
 FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey),
g AS (SELECT full_date, customer_id, CAST(date_trunc('month', full_date) AS DATE) AS month_start, count(*) AS total_purchases,
 count(*) > 1 AS returning_customer_flag, count(*) = 1 AS new_customer_flag,
 CASE WHEN count(DISTINCT full_date) = 0 THEN 0.0 ELSE CAST(count(*) AS DOUBLE) / count(DISTINCT full_date) END AS purchase_frequency,
 round(avg(coalesce(price, 0.0)), 6) AS average_order_value FROM pe GROUP BY full_date, customer_id)
SELECT row_number() OVER (ORDER BY full_date, customer_id) AS customer_summary_fact_key, * FROM g""")
def fact_customer_summary(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("full_date"), F.col("o_custkey").alias("customer_id"))
    lines = load(spark, sf, "lineitem").select("l_orderkey", F.col("l_extendedprice").alias("price"))
    summary = FA.customer_summary(o.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left"), "customer_id", "full_date", "price")
    rounded = summary.withColumn("average_order_value", F.round("average_order_value", 6))
    return number_rows(rounded, ["full_date", "customer_id"], "customer_summary_fact_key")


@query("""
SELECT n_name AS state, c_mktsegment AS purchase_frequency_segment, CAST(floor(c_acctbal / 1000) AS INTEGER) AS balance_band,
 count(*) AS customer_count FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
GROUP BY n_name, c_mktsegment, CAST(floor(c_acctbal / 1000) AS INTEGER)""")
def fact_segmentation(spark, sf):
    c, n = load(spark, sf, "customer"), load(spark, sf, "nation").select("n_nationkey", "n_name")
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left").groupBy(
        F.col("n_name").alias("state"), F.col("c_mktsegment").alias("purchase_frequency_segment"),
        F.floor(F.col("c_acctbal") / 1000).cast("int").alias("balance_band")).agg(F.count(F.lit(1)).alias("customer_count"))


@query("""
SELECT event_id, CAST(c.c_custkey AS VARCHAR) AS customer_id, CAST(p.p_partkey AS VARCHAR) AS product_id, event_type AS interaction_type,
 CAST(NULL AS VARCHAR) AS promo_code, CAST(NULL AS DOUBLE) AS review_rating
FROM events LEFT JOIN customer c ON CAST(user_id AS VARCHAR) = CAST(c.c_custkey AS VARCHAR)
LEFT JOIN part p ON CAST(json_extract_string(props, '$.k') AS VARCHAR) = CAST(p.p_partkey AS VARCHAR)""")
def fact_commerce_interaction(spark, sf):
    e = load(spark, sf, "events").withColumn("user_text", F.col("user_id").cast("string")).withColumn("part_text", F.get_json_object("props", "$.k"))
    c = load(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("customer_id"))
    p = load(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("product_id"))
    return e.join(c, F.col("user_text") == F.col("customer_id"), "left").join(p, F.col("part_text") == F.col("product_id"), "left").select(
        "event_id", "customer_id", "product_id", F.col("event_type").alias("interaction_type"),
        F.lit(None).cast("string").alias("promo_code"), F.lit(None).cast("double").alias("review_rating"))


@query(f"""WITH {CONTRACTS}, {SPINE}, {ACTIVE}
SELECT month_date, count(DISTINCT person_id) AS headcount, count(*) AS active_contracts FROM active GROUP BY month_date""")
def snapshot_headcount(spark, sf):
    active = FA.active_months(contracts(spark, sf), "start_date", "end_date")
    return active.groupBy("month_date").agg(F.count_distinct(F.col("person_id")).alias("headcount"), F.count(F.lit(1)).alias("active_contracts"))


@query(f"""WITH {CONTRACTS}, bounds AS (SELECT min(date_trunc('month', start_date)) AS a,
 max(date_trunc('month', coalesce(end_date, start_date))) AS b, max(date_trunc('month', start_date)) AS c FROM contracts),
spine AS (SELECT CAST(unnest(generate_series(a, greatest(b, c), INTERVAL 1 MONTH)) AS DATE) AS m FROM bounds), {ACTIVE}
SELECT month_date, count(DISTINCT person_id) AS headcount FROM active GROUP BY month_date""")
def snapshot_headcount_calendar(spark, sf):
    active = FA.active_months(contracts(spark, sf), "start_date", "end_date", continuous=True)
    return active.groupBy("month_date").agg(F.count_distinct(F.col("person_id")).alias("headcount"))


@query(f"""WITH {CONTRACTS}, {SPINE}, {ACTIVE},
x AS (SELECT *, row_number() OVER (PARTITION BY month_date, person_id ORDER BY start_date, category) AS rn FROM active),
cat AS (SELECT dense_rank() OVER (ORDER BY category) AS category_key, category FROM (SELECT DISTINCT category FROM contracts)),
per AS (SELECT dense_rank() OVER (ORDER BY person_id) AS person_key, person_id FROM (SELECT DISTINCT person_id FROM contracts))
SELECT CAST(strftime(month_date, '%Y%m') AS INTEGER) AS month_key, person_key, category_key,
 {_band_sql(_years_sql('birth_date', 'month_date'), S.AGE_BANDS)} AS age_band,
 {_band_sql(_years_sql('start_date', 'last_day(month_date)'), S.SENIORITY_BANDS)} AS seniority, 1 AS headcount_flag
FROM x JOIN cat USING (category) JOIN per USING (person_id) WHERE rn = 1""")
def workforce_snapshot(spark, sf):
    c = contracts(spark, sf)
    first = FA.first_contract_per_month(FA.active_months(c, "start_date", "end_date"), "person_id", "start_date", ["category"])
    cat = D.keyed(c.select("category").distinct(), "category_key")
    per = D.keyed(c.select("person_id").distinct(), "person_key")
    fact = D.lookup_key(D.lookup_key(first, cat, {"category": "category"}, "category_key"), per, {"person_id": "person_id"}, "person_key")
    return fact.select(
        F.date_format("month_date", "yyyyMM").cast("int").alias("month_key"), "person_key", "category_key",
        S.band(S.whole_years(F.col("birth_date"), F.col("month_date")), S.AGE_BANDS).alias("age_band"),
        S.band(S.whole_years(F.col("start_date"), F.last_day("month_date")), S.SENIORITY_BANDS).alias("seniority"),
        F.lit(1).alias("headcount_flag"))


@query(f"""WITH {CONTRACTS}, {SPINE}, {ACTIVE}
SELECT month_date, category, CAST(sum(CASE WHEN date_trunc('month', start_date) = month_date THEN 1 ELSE 0 END) AS BIGINT) AS in_count,
 CAST(sum(CASE WHEN date_trunc('month', end_date) = month_date THEN 1 ELSE 0 END) AS BIGINT) AS out_count
FROM active GROUP BY month_date, category""")
def movement_in_out(spark, sf):
    return FA.movements(FA.active_months(contracts(spark, sf), "start_date", "end_date"), "start_date", "end_date", ["category"])


@query("""
WITH m AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month_date, l_returnflag AS category,
 round(sum(l_extendedprice), 2) AS salary_cost FROM lineitem GROUP BY ALL)
SELECT m.month_date, m.category, m.salary_cost, p.salary_cost AS salary_cost_last_year,
 round(m.salary_cost - p.salary_cost, 2) AS salary_cost_change
FROM m LEFT JOIN m p ON p.category = m.category AND p.month_date + INTERVAL 12 MONTH = m.month_date""")
def cost_evolution(spark, sf):
    monthly = load(spark, sf, "lineitem").groupBy(
        F.trunc("l_shipdate", "MM").alias("month_date"), F.col("l_returnflag").alias("category")
    ).agg(F.round(F.sum("l_extendedprice"), 2).alias("salary_cost"))
    yoy = FA.year_over_year(monthly, "month_date", ["category"], "salary_cost")
    return yoy.withColumn("salary_cost_change", F.round("salary_cost_change", 2))


@query("""
SELECT CAST(strftime(o_orderdate, '%Y-%m') || '-01' AS DATE) AS month_date, o_orderstatus AS period_type, count(*) AS payments,
 round(sum(o_totalprice), 2) AS salary_cost, CAST(NULL AS INTEGER) AS region_key FROM orders GROUP BY ALL""")
def monthly_salary_cost(spark, sf):
    period = F.date_format("o_orderdate", "yyyy-MM")
    return load(spark, sf, "orders").groupBy(S.month_of_period(period).alias("month_date"), F.col("o_orderstatus").alias("period_type")).agg(
        F.count(F.lit(1)).alias("payments"), F.round(F.sum("o_totalprice"), 2).alias("salary_cost")
    ).withColumn("region_key", F.lit(None).cast("int"))


def _absences(spark, sf):
    """Per person one counter per line position; a sum of exactly 25 stands for a missing counter."""
    lines = load(spark, sf, "lineitem").join(load(spark, sf, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    counters = [F.nullif(F.sum(F.when(F.col("l_linenumber") == i, F.col("l_quantity")).otherwise(0.0)).cast("long"), F.lit(25)).alias(f"freq_{i}")
                for i in range(1, 8)]
    return lines.groupBy(F.col("o_custkey").alias("person_id")).agg(*counters)


_FREQS = [f"freq_{i}" for i in range(1, 8)]
_ABSENCE = "absences AS (SELECT o_custkey AS person_id, " + ", ".join(
    f"nullif(CAST(sum(CASE WHEN l_linenumber = {i} THEN l_quantity ELSE 0.0 END) AS BIGINT), 25) AS freq_{i}" for i in range(1, 8)
) + " FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey)"


@query(f"""WITH {_ABSENCE} SELECT person_id, coalesce({' + '.join(_FREQS)}, 0) AS absence_index FROM absences""")
def absence_index(spark, sf):
    return FA.absence_index(_absences(spark, sf), _FREQS).select("person_id", "absence_index")


@query(f"""WITH {_ABSENCE}, i AS (SELECT person_id, coalesce({' + '.join(_FREQS)}, 0) AS absence_index FROM absences)
SELECT person_id, absence_index, rank() OVER (ORDER BY absence_index DESC) AS absence_rank FROM i""")
def absence_rank(spark, sf):
    return rank_rows(absence_index(spark, sf), "absence_index", "absence_rank")


@query("""
SELECT o_custkey AS person_id, CAST(count(DISTINCT l_orderkey) AS BIGINT) AS spells, CAST(sum(l_quantity) AS BIGINT) AS days,
 CAST(count(DISTINCT l_orderkey) * count(DISTINCT l_orderkey) * sum(l_quantity) AS BIGINT) AS bradford_factor
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey""")
def bradford_factor(spark, sf):
    lines = load(spark, sf, "lineitem").select("l_orderkey", "l_quantity").join(
        load(spark, sf, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    per_spell = lines.groupBy(F.col("o_custkey").alias("person_id"), "l_orderkey").agg(F.sum("l_quantity").alias("d"))
    per = per_spell.groupBy("person_id").agg(F.count(F.lit(1)).alias("spells"), F.sum("d").cast("long").alias("days"))
    return per.withColumn("bradford_factor", FA.bradford_factor(F.col("spells"), F.col("days")))


@query("""
SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month_date, p_type AS absence_type, CAST(sum(l_quantity) AS BIGINT) AS absence_days
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey WHERE l_shipdate IS NOT NULL GROUP BY ALL""")
def monthly_absence(spark, sf):
    lines = load(spark, sf, "lineitem").filter("l_shipdate is not null").select("l_partkey", "l_shipdate", "l_quantity")
    per_part = lines.groupBy("l_partkey", F.trunc("l_shipdate", "MM").alias("month_date")).agg(F.sum("l_quantity").alias("q"))
    kinds = load(spark, sf, "part").select("p_partkey", F.col("p_type").alias("absence_type"))
    return per_part.join(kinds, F.col("l_partkey") == F.col("p_partkey"), "left").groupBy("month_date", "absence_type").agg(
        F.sum("q").cast("long").alias("absence_days"))


@query("""SELECT c_custkey AS customer_id, r_name AS region FROM customer LEFT JOIN region ON 1 = 1""")
def cross_left_regions(spark, sf):
    regions = load(spark, sf, "region").select(F.col("r_name").alias("region"))
    return FA.cross_left(load(spark, sf, "customer").select(F.col("c_custkey").alias("customer_id")), regions)


@query("""
SELECT n_name AS store, p_brand AS brand, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
 round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL""")
def kpi_revenue_by_dims(spark, sf):
    lines = load(spark, sf, "lineitem").select("l_orderkey", "l_partkey", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("amount"))
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    c = load(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = load(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("store"))
    p = load(spark, sf, "part").select("p_partkey", F.col("p_brand").alias("brand"))
    return (
        lines.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(p, F.col("l_partkey") == F.col("p_partkey"))
        .join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("store", "brand", "year", "month").agg(F.round(F.sum("amount"), 4).alias("revenue"))
    )


@query("""
SELECT c_mktsegment AS segment, count(*) AS orders, round(sum(o_totalprice) / count(*), 4) AS average_order_value
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment""")
def kpi_aov(spark, sf):
    o, c = load(spark, sf, "orders").select("o_custkey", "o_totalprice"), load(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("c_mktsegment").alias("segment")).agg(
        F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice") / F.count(F.lit(1)), 4).alias("average_order_value"))


@query("""
SELECT p_type AS product, s_nationkey AS store, round(sum(l_quantity) / count(*), 6) AS average_quantity
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL""")
def kpi_avg_qty(spark, sf):
    lines = load(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_quantity")
    p = load(spark, sf, "part").select("p_partkey", F.col("p_type").alias("product"))
    s = load(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("store"))
    return lines.join(p, F.col("l_partkey") == F.col("p_partkey")).join(s, F.col("l_suppkey") == F.col("s_suppkey")).groupBy(
        "product", "store").agg(F.round(F.sum("l_quantity") / F.count(F.lit(1)), 6).alias("average_quantity"))


@query("""
SELECT l_returnflag AS flag, round(avg(CASE WHEN l_discount > 0 THEN 1.0 ELSE 0.0 END), 6) AS discount_rate,
 round(avg(CASE WHEN lower(l_linestatus) = 'o' THEN 1.0 ELSE 0.0 END), 6) AS promo_rate FROM lineitem GROUP BY l_returnflag""")
def kpi_discount_rate(spark, sf):
    return load(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("flag")).agg(
        F.round(F.avg(S.flag(F.col("l_discount") > 0)), 6).alias("discount_rate"),
        F.round(F.avg(S.flag(F.lower("l_linestatus") == "o")), 6).alias("promo_rate"))


@query("""
SELECT p_type AS category, CAST(sum(CASE WHEN lower(trim(event_type)) = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS purchases,
 CAST(sum(CASE WHEN lower(trim(event_type)) = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS views,
 round(CAST(sum(CASE WHEN lower(trim(event_type)) = 'purchase' THEN 1 ELSE 0 END) AS DOUBLE)
  / nullif(sum(CASE WHEN lower(trim(event_type)) = 'view' THEN 1 ELSE 0 END), 0), 6) AS conversion_rate
FROM events LEFT JOIN part ON CAST(json_extract_string(props, '$.k') AS BIGINT) = p_partkey GROUP BY p_type""")
def kpi_conversion_rate(spark, sf):
    kind = S.safe_key(F.col("event_type"))
    # events are counted per product first, so the join sees products and not events
    per_part = load(spark, sf, "events").groupBy(F.get_json_object("props", "$.k").cast("bigint").alias("part_id")).agg(
        F.sum(S.flag(kind == "purchase")).alias("p"), F.sum(S.flag(kind == "view")).alias("v"))
    parts = load(spark, sf, "part").select("p_partkey", F.col("p_type").alias("category"))
    return per_part.join(parts, F.col("part_id") == F.col("p_partkey"), "left").groupBy("category").agg(
        F.sum("p").alias("purchases"), F.sum("v").alias("views"),
        F.round(F.try_divide(F.sum("p").cast("double"), F.sum("v").cast("double")), 6).alias("conversion_rate"))


@query("""
SELECT n_name AS store, round(sum(CASE WHEN c_mktsegment = 'BUILDING' THEN 0 ELSE o_totalprice END) / sum(o_totalprice), 6) AS b2b_share
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY GROUPING SETS ((n_name), ())""")
def kpi_segment_share(spark, sf):
    o, c = load(spark, sf, "orders").select("o_custkey", "o_totalprice"), load(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = load(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("store"))
    joined = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    b2b = F.sum(F.when(F.col("c_mktsegment") == "BUILDING", 0.0).otherwise(F.col("o_totalprice")))
    return joined.rollup("store").agg(F.round(b2b / F.sum("o_totalprice"), 6).alias("b2b_share"))


@query("""
SELECT purchases, count(*) AS customers FROM (SELECT o_custkey, count(*) AS purchases FROM orders GROUP BY o_custkey) GROUP BY purchases""")
def kpi_frequency_distribution(spark, sf):
    per = load(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("purchases"))
    return per.groupBy("purchases").agg(F.count(F.lit(1)).alias("customers"))


@query("""
WITH r AS (SELECT n_name AS store, o_custkey AS customer_id, round(sum(o_totalprice), 2) AS revenue
 FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL),
x AS (SELECT 'store' AS scope, *, rank() OVER (PARTITION BY store ORDER BY revenue DESC) AS place FROM r
 UNION ALL SELECT 'overall', *, rank() OVER (ORDER BY revenue DESC) FROM r)
SELECT scope, store, customer_id, revenue, CAST(place AS INTEGER) AS place FROM x WHERE place <= 10""")
def kpi_top_customers(spark, sf):
    per = load(spark, sf, "orders").groupBy(F.col("o_custkey").alias("customer_id")).agg(F.round(F.sum("o_totalprice"), 2).alias("revenue"))
    c = load(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = load(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("store"))
    rows = per.join(c, F.col("customer_id") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("store", "customer_id", "revenue")
    # the rank filter is applied in every task before the shuffle, for the overall list too
    lists = [(w, s) for w, s in ((Window.partitionBy("store"), "store"), (Window.partitionBy(), "overall"))]
    out = [rows.withColumn("place", F.rank().over(w.orderBy(F.col("revenue").desc()))).filter("place <= 10").withColumn("scope", F.lit(s))
           for w, s in lists]
    return out[0].unionByName(out[1]).select("scope", "store", "customer_id", "revenue", "place")


@query(f"""
SELECT p_type AS category, {SEASON_SQL.format('l_shipdate')} AS season, round(avg(p_size), 6) AS average_rating
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL""")
def kpi_average_rating(spark, sf):
    lines = load(spark, sf, "lineitem").select("l_partkey", season(F.col("l_shipdate")).alias("season"))
    p = load(spark, sf, "part").select("p_partkey", F.col("p_type").alias("category"), "p_size")
    return lines.join(p, F.col("l_partkey") == F.col("p_partkey")).groupBy("category", "season").agg(F.round(F.avg("p_size"), 6).alias("average_rating"))


@query("""
WITH d AS (SELECT event_type, CAST(ts AS DATE) AS day, round(sum(value), 2) AS total FROM events GROUP BY ALL),
w AS (SELECT *, avg(total) OVER f AS m, stddev_samp(total) OVER f AS s FROM d
 WINDOW f AS (PARTITION BY event_type ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
SELECT event_type, day, total, round((total - m) / nullif(s, 0), 4) AS z_score, coalesce(abs((total - m) / nullif(s, 0)) > 2.0, false) AS is_anomaly FROM w""")
def anomaly_daily(spark, sf):
    d = load(spark, sf, "events").groupBy("event_type", F.col("ts").cast("date").alias("day")).agg(F.round(F.sum("value"), 2).alias("total"))
    w = Window.partitionBy("event_type").orderBy("day").rowsBetween(-7, -1)  # a series has one row per calendar day
    z = F.try_divide(F.col("total") - F.avg("total").over(w), F.nullif(F.stddev_samp("total").over(w), F.lit(0.0)))
    return d.withColumn("z", z).select("event_type", "day", "total", F.round("z", 4).alias("z_score"),
                                       F.coalesce(F.abs("z") > 2.0, F.lit(False)).alias("is_anomaly"))
