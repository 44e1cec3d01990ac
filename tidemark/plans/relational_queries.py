"""Queries of the relational operators, text and calendar functions, semantics and marts, with the SQL they equal."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import periods as P
from ..functions import text as T
from ..operators import accounting as A
from ..operators import identity as I
from ..operators import marts as M
from ..operators import semantics as S
from ..sources import derived as D
from ..sources.derived import F1, F2
from .accounting_queries import CLASSED
from .vintage_queries import _realised


def t(name):
    return lambda s, d: D.table(s, d, name)


ORDERS, LINES, PARTS, EVENTS, CUSTOMERS, SUPPLIERS = map(t, ("orders", "lineitem", "part", "events", "customer", "supplier"))
_LABEL_SQL = "CASE p_size % 5 WHEN 0 THEN 'miles de guaranies, saldo ' WHEN 1 THEN '  USD   millones flujo' WHEN 2 THEN 'Índice serie original' WHEN 3 THEN 'Tasa desestacionalizada' ELSE 'Saldo y flujo ' || p_brand END"
_NORM_SQL = "lower(trim(regexp_replace(label, '\\s+', ' ', 'g')))"


def labels(s, d):
    size = F.col("p_size") % 5
    label = F.when(size == 0, "miles de guaranies, saldo ").when(size == 1, "  USD   millones flujo").when(size == 2, "Índice serie original").when(size == 3, "Tasa desestacionalizada").otherwise(F.concat(F.lit("Saldo y flujo "), "p_brand"))
    return PARTS(s, d).select(F.col("p_partkey").alias("series_id"), "p_size", label.alias("label"))


_NORMAL = f"translate({_NORM_SQL}, 'áéíóúüñàèìòùâêîôûäëïöç', 'aeiouunaeiouaeiouaeioc')"
_L = f"l AS (SELECT p_partkey AS series_id, p_size, {_LABEL_SQL} AS label FROM part), n AS (SELECT *, {_NORMAL} AS t FROM l)"
_DERIVED = """series_id, p_size, label, CASE WHEN regexp_matches(t,'porcentaje|percent|%|tasa') THEN 'percent' WHEN regexp_matches(t,'indice|index') THEN 'index' WHEN regexp_matches(t,'usd|dolares|dollar') THEN 'usd' WHEN regexp_matches(t,'guaranies|pyg') THEN 'pyg' END AS unit,
CAST(CASE WHEN regexp_matches(t,'miles de millones|billion') THEN 1e9 WHEN regexp_matches(t,'millones|million') THEN 1e6 WHEN regexp_matches(t,'miles|thousand') THEN 1e3 END AS DOUBLE) AS scale_multiplier,
CASE WHEN regexp_matches(t,'saldo|stock|posicion') AND regexp_matches(t,'flujo|flow|variacion') THEN 'not_reviewed' WHEN regexp_matches(t,'saldo|stock|posicion') THEN 'stock' WHEN regexp_matches(t,'flujo|flow|variacion') THEN 'flow' ELSE 'not_reviewed' END AS stock_flow,
CASE WHEN regexp_matches(t,'desestacionaliz|seasonally adjusted') THEN 'adjusted' WHEN regexp_matches(t,'serie original|not adjusted') THEN 'original' ELSE 'not_reviewed' END AS adjustment,
nullif(regexp_extract(t, '.{0,12}(?:(?:saldo|stock|posicion)|(?:flujo|flow|variacion)).{0,12}', 0), '') AS evidence"""


def k04(s, d):
    rows = S.derived(labels(s, d)).select("series_id", "unit", "scale_multiplier")
    register = PARTS(s, d).filter("p_partkey % 7 = 0").select(F.col("p_partkey").alias("series_id"), F.lit("ratio").alias("unit"), F.when(F.col("p_partkey") % 2 == 0, 1.0).alias("scale_multiplier"))
    return S.reviewed(rows, register, "series_id", ["unit", "scale_multiplier"])


def k05(s, d):
    register = PARTS(s, d).select(F.when(F.col("p_partkey") % 50 == 0, "").otherwise(F.col("p_brand")).alias("reviewer"), F.col("p_name").alias("name"), F.split_part("p_type", F.lit(" "), F.lit(1)).alias("kind"))
    return S.register_problems(register, ["reviewer"], ["name"], {"kind": ["PROMO", "ECONOMY", "STANDARD", "SMALL", "MEDIUM"]}).groupBy("problem").agg(F.count("*").alias("n"), F.min("entry").alias("first_entry"))


def o04(s, d):
    rows = _realised(s, d).select("series_id", "period", "value")
    series = rows.select("series_id").distinct()
    domains = series.select("series_id", F.when(F.col("series_id").endswith(":P"), "prices").otherwise("activity").alias("domain"))
    sheets = series.select("series_id", F.split_part("series_id", F.lit(":"), F.lit(2)).alias("source_sheet"))
    status = sheets.select("source_sheet").distinct().filter("source_sheet <> '4-NOT SPECIFIED'").withColumn("status", F.when(F.col("source_sheet") == "5-LOW", "draft").otherwise("validated"))
    return M.domain_mart(rows, domains, M.research_gate(sheets, status))


def o06(s, d):
    cells = D.grid(s, d)
    obs = D.grid_observations(cells)
    parts = [
        cells.groupBy("source_sheet").agg(F.count("*").alias("n_cells"), F.max("row_id").alias("last_row"), F.max("column_id").alias("last_column")),
        obs.groupBy("source_sheet").agg(F.count("*").alias("n_observations"), F.countDistinct("series_id").alias("n_series")),
        A.classified(A.unmapped(cells, obs), D.rules(s)).groupBy("source_sheet").agg(F.count_if(F.col("classification") == "unclassified").alias("n_open")),
    ]
    return M.dashboard(cells, *parts)


def m16(s, d):
    rows = _realised(s, d).select(F.split_part("series_id", F.lit(":"), F.lit(2)).alias("pair"), F.split_part("series_id", F.lit(":"), F.lit(3)).alias("side"), "period", "value")
    return M.agreement(rows.filter("side = 'F'"), rows.filter("side = 'O'"), 0.5)


def aliases(s, d):
    """Chains over customers: each renamed to a third of its number, so depth follows the table's logarithm."""
    return CUSTOMERS(s, d).filter("c_custkey >= 3").select(F.col("c_custkey").alias("old_id"), F.floor(F.col("c_custkey") / 3).alias("new_id"))


def f11(s, d):
    parents = CUSTOMERS(s, d).select(F.col("c_custkey").alias("child"), F.when(F.col("c_custkey") == 1, 9).otherwise(F.floor(F.col("c_custkey") / 3)).cast("long").alias("parent")).filter("parent > 0")
    return I.in_cycle(parents, "child", "parent")


_Q = {
    "B01_case_coalesce": (lambda s, d: CUSTOMERS(s, d).select("c_custkey", F.when(F.col("c_acctbal") < 0, "debt").when(F.col("c_acctbal") > 5000, "rich").otherwise("normal").alias("tier"), F.coalesce(F.nullif("c_mktsegment", F.lit("BUILDING")), F.lit("none")).alias("segment")), "SELECT c_custkey, CASE WHEN c_acctbal<0 THEN 'debt' WHEN c_acctbal>5000 THEN 'rich' ELSE 'normal' END AS tier, coalesce(nullif(c_mktsegment,'BUILDING'),'none') AS segment FROM customer"),
    "B02_exclude": (lambda s, d: SUPPLIERS(s, d).drop("s_acctbal"), "SELECT * EXCLUDE (s_acctbal) FROM supplier"),
    "B03_in_list": (lambda s, d: ORDERS(s, d).join(F.broadcast(D.table(s, d, "nation").filter("n_regionkey = 1").select("n_nationkey")).join(CUSTOMERS(s, d), F.col("c_nationkey") == F.col("n_nationkey")), F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("o_orderkey"), "SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey=1))"),
    "B04_null_safe": (lambda s, d: ORDERS(s, d).withColumn("a", F.nullif("o_orderstatus", F.lit("P"))).filter(~F.col("a").eqNullSafe(F.lit("F"))).groupBy("a").agg(F.count("*").alias("n")), "SELECT nullif(o_orderstatus,'P') AS a, count(*) AS n FROM orders WHERE nullif(o_orderstatus,'P') IS DISTINCT FROM 'F' GROUP BY 1"),
    "B06_regex": (lambda s, d: PARTS(s, d).filter(T.normalized(F.col("p_type")).rlike("^(promo|economy)")).select("p_partkey"), "SELECT p_partkey FROM part WHERE regexp_matches(lower(trim(p_type)),'^(promo|economy)')"),
    "B07_like_escape": (lambda s, d: PARTS(s, d).filter(F.like(F.concat("p_brand", F.lit("_x")), F.lit("Brand#1%/_x"), F.lit("/"))).select("p_partkey"), "SELECT p_partkey FROM part WHERE p_brand || '_x' LIKE 'Brand#1%/_x' ESCAPE '/'"),
    "B08_plausible_dates": (lambda s, d: LINES(s, d).agg(F.to_date(F.min("l_shipdate")).alias("first"), F.to_date(F.max("l_shipdate")).alias("last"), F.count_if(~F.year("l_shipdate").between(1995, 2000)).alias("outside")), "SELECT CAST(min(l_shipdate) AS DATE) AS first, CAST(max(l_shipdate) AS DATE) AS last, count(*) FILTER (WHERE year(l_shipdate) NOT BETWEEN 1995 AND 2000) AS outside FROM lineitem"),
    "C02_left_chain": (
        lambda s, d: ORDERS(s, d).join(CUSTOMERS(s, d), F.col("o_custkey") == F.col("c_custkey"), "left").join(F.broadcast(D.table(s, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey"), "left").join(F.broadcast(D.table(s, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"), "left").groupBy("r_name", "n_name").agg(F.count("*").alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total")),
        "SELECT r_name, n_name, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders LEFT JOIN customer ON o_custkey=c_custkey LEFT JOIN nation ON c_nationkey=n_nationkey LEFT JOIN region ON n_regionkey=r_regionkey GROUP BY 1,2",
    ),
    "C03_full_outer": (lambda s, d: LINES(s, d).groupBy(F.col("l_suppkey").alias("k")).agg(F.count("*").alias("lines")).filter("k % 3 <> 0").join(SUPPLIERS(s, d).filter("s_suppkey % 2 = 0").select(F.col("s_suppkey").alias("k"), "s_nationkey"), "k", "full_outer"), "SELECT coalesce(a.k,b.k) AS k, lines, s_nationkey FROM (SELECT l_suppkey AS k, count(*) AS lines FROM lineitem WHERE l_suppkey%3<>0 GROUP BY 1) a FULL JOIN (SELECT s_suppkey AS k, s_nationkey FROM supplier WHERE s_suppkey%2=0) b ON a.k=b.k"),
    "C04_anti": (lambda s, d: CUSTOMERS(s, d).join(ORDERS(s, d), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey"), "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey=c_custkey)"),
    "C11_required_fields": (lambda s, d: S.completeness(PARTS(s, d).withColumn("p_type", F.nullif("p_type", F.lit("PROMO"))), ["p_name", "p_type"]), "SELECT 'p_name' AS field, count(*) AS n_rows, count(p_name) AS n_known FROM part UNION ALL SELECT 'p_type', count(*), count(nullif(p_type,'PROMO')) FROM part"),
    "C13_normalised_join": (lambda s, d: D.panel(s, d).join(F.broadcast(ORDERS(s, d).select(T.normalized(F.col("o_orderpriority")).alias("k")).distinct()), T.normalized(F.col("sub_rubro")) == F.col("k")).groupBy("k").agg(F.count("*").alias("n")), f"WITH {D.F6} SELECT lower(trim(sub_rubro)) AS k, count(*) AS n FROM panel GROUP BY 1"),
    "C15_list_membership": (lambda s, d: PARTS(s, d).select("p_partkey", F.explode(F.split("p_name", " ")).alias("word")).groupBy("word").agg(F.count("*").alias("n")), "SELECT word, count(*) AS n FROM (SELECT unnest(string_split(p_name,' ')) AS word FROM part) GROUP BY 1"),
    "D02_conditional_distinct": (lambda s, d: ORDERS(s, d).groupBy("o_orderpriority").agg(F.countDistinct("o_custkey").alias("n_customers"), F.countDistinct(F.when(F.col("o_orderstatus") == "F", F.col("o_custkey"))).alias("n_filled")), "SELECT o_orderpriority, count(DISTINCT o_custkey) AS n_customers, count(DISTINCT CASE WHEN o_orderstatus='F' THEN o_custkey END) AS n_filled FROM orders GROUP BY 1"),
    "D03_tuple_distinct": (lambda s, d: LINES(s, d).agg(F.countDistinct(F.struct("l_suppkey", F.nullif("l_returnflag", F.lit("A")).alias("f"))).alias("n")), "SELECT count(DISTINCT (l_suppkey, nullif(l_returnflag,'A'))) AS n FROM lineitem"),
    "D04_filtered_count": (lambda s, d: EVENTS(s, d).groupBy("event_type").agg(F.count("*").alias("n"), F.count_if(F.col("value") > 50).alias("large")), "SELECT event_type, count(*) AS n, count(*) FILTER (WHERE value>50) AS large FROM events GROUP BY 1"),
    "D05_pivot": (lambda s, d: LINES(s, d).groupBy(F.year("l_shipdate").cast("long").alias("y")).agg(*(F.max(F.when(F.col("l_returnflag") == f, F.col("l_quantity"))).alias(f"q_{f.lower()}") for f in "ANR")), "SELECT CAST(year(l_shipdate) AS BIGINT) AS y, max(l_quantity) FILTER (WHERE l_returnflag='A') AS q_a, max(l_quantity) FILTER (WHERE l_returnflag='N') AS q_n, max(l_quantity) FILTER (WHERE l_returnflag='R') AS q_r FROM lineitem GROUP BY 1"),
    "D06_ordered_list": (lambda s, d: D.table(s, d, "nation").groupBy("n_regionkey").agg(F.array_join(F.array_sort(F.collect_set("n_name")), ", ").alias("nations")), "SELECT n_regionkey, string_agg(DISTINCT n_name, ', ' ORDER BY n_name) AS nations FROM nation GROUP BY 1"),
    "D07_arg_min": (lambda s, d: ORDERS(s, d).groupBy("o_custkey").agg(F.min_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("first_order")), "SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS first_order FROM orders GROUP BY 1"),
    "D11_key_value_pivot": (lambda s, d: EVENTS(s, d).groupBy("user_id", "event_type").agg(F.count("*").alias("n")).groupBy("user_id").pivot("event_type", ["click", "view", "purchase"]).agg(F.max("n")), "SELECT user_id, max(n) FILTER (WHERE event_type='click') AS click, max(n) FILTER (WHERE event_type='view') AS view, max(n) FILTER (WHERE event_type='purchase') AS purchase FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1,2) GROUP BY 1"),
    "E03_lag": (lambda s, d: ORDERS(s, d).select("o_orderkey", F.datediff("o_orderdate", F.lag("o_orderdate").over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"))).cast("long").alias("days")), "SELECT o_orderkey, datediff('day', CAST(lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS DATE), CAST(o_orderdate AS DATE)) AS days FROM orders"),
    "E04_window_median": (lambda s, d: SUPPLIERS(s, d).select("s_suppkey", F.median("s_acctbal").over(Window.partitionBy("s_nationkey")).alias("m"), F.count("*").over(Window.partitionBy("s_nationkey")).alias("n")), "SELECT s_suppkey, median(s_acctbal) OVER (PARTITION BY s_nationkey) AS m, count(*) OVER (PARTITION BY s_nationkey) AS n FROM supplier"),
    "E10_trailing_suffix": (
        lambda s, d: ORDERS(s, d).select("o_custkey", "o_orderkey", F.min(F.when(F.col("o_orderstatus") == "O", 1).otherwise(0)).over(Window.partitionBy("o_custkey").orderBy("o_orderkey").rowsBetween(0, Window.unboundedFollowing)).alias("f")).filter("f = 1").select("o_custkey", "o_orderkey"),
        "SELECT o_custkey, o_orderkey FROM (SELECT o_custkey, o_orderkey, min(CASE WHEN o_orderstatus='O' THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS f FROM orders) WHERE f=1",
    ),
    "E11_sequence_in_block": (
        lambda s, d: ORDERS(s, d).withColumn("b", F.sum(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)).over(Window.partitionBy("o_custkey").orderBy("o_orderkey").rowsBetween(Window.unboundedPreceding, 0))).select("o_custkey", "o_orderkey", "b", F.row_number().over(Window.partitionBy("o_custkey", "b").orderBy("o_orderkey")).cast("long").alias("n")),
        "SELECT o_custkey, o_orderkey, b, row_number() OVER (PARTITION BY o_custkey, b ORDER BY o_orderkey) AS n FROM (SELECT *, CAST(sum(CASE WHEN o_orderstatus='F' THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS b FROM orders)",
    ),
    "F02_top_of_each": (lambda s, d: M.top_of_each(PARTS(s, d).select("p_brand", "p_partkey", "p_retailprice"), "p_brand", [F.col("p_retailprice").desc(), F.col("p_partkey")], 12), "SELECT * FROM (SELECT p_brand, p_partkey, p_retailprice, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS rank FROM part) WHERE rank<=12"),
    "F05_union_all": (lambda s, d: CUSTOMERS(s, d).select(F.lit("customer").alias("kind"), F.col("c_nationkey").alias("nation")).unionByName(SUPPLIERS(s, d).select(F.lit("supplier").alias("kind"), F.col("s_nationkey").alias("nation"))).groupBy("kind", "nation").agg(F.count("*").alias("n")), "SELECT kind, nation, count(*) AS n FROM (SELECT 'customer' AS kind, c_nationkey AS nation FROM customer UNION ALL SELECT 'supplier', s_nationkey FROM supplier) GROUP BY 1,2"),
    "F06_union_distinct": (lambda s, d: CUSTOMERS(s, d).select(F.col("c_nationkey").alias("nation")).union(SUPPLIERS(s, d).select("s_nationkey")).distinct(), "SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier"),
    "F07_except": (lambda s, d: PARTS(s, d).select("p_partkey").subtract(LINES(s, d).filter("l_quantity > 45").select("l_partkey")), "SELECT p_partkey FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity>45"),
    "F08_keep_first": (lambda s, d: LINES(s, d).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", F.row_number().over(Window.partitionBy("l_orderkey", "l_linenumber").orderBy("l_partkey", "l_suppkey", "l_extendedprice")).alias("k")).filter("k = 1").drop("k"), "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_extendedprice) AS k FROM lineitem) WHERE k=1"),
    "F09_alias_closure": (lambda s, d: I.closure(aliases(s, d)), "WITH RECURSIVE a AS (SELECT c_custkey AS old_id, c_custkey // 3 AS new_id FROM customer WHERE c_custkey>=3), r AS (SELECT old_id, new_id FROM a UNION SELECT r.old_id, a.new_id FROM r JOIN a ON a.old_id=r.new_id) SELECT old_id, new_id FROM r"),
    "F11_parent_cycles": (f11, "WITH RECURSIVE p AS (SELECT c_custkey AS child, CASE WHEN c_custkey=1 THEN 9 ELSE c_custkey // 3 END AS parent FROM customer), e AS (SELECT * FROM p WHERE parent>0), r AS (SELECT child, parent FROM e UNION SELECT r.child, e.parent FROM r JOIN e ON e.child=r.parent) SELECT child FROM r WHERE child=parent"),
    "G01_normalised_labels": (lambda s, d: labels(s, d).select("series_id", T.normalized(F.col("label")).alias("label")), f"WITH {_L} SELECT series_id, t AS label FROM n"),
    "G02_decimal_comma": (lambda s, d: D.trades(s, d).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", T.decimal_comma(F.col("volumen")).alias("v"), T.malformed_number(F.col("volumen")).alias("bad")), f"WITH {D.F3} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, try_cast(replace(volumen, ',', '.') AS DOUBLE) AS v, volumen = '12abc' AS bad FROM raw"),
    "G04_dates": (lambda s, d: ORDERS(s, d).select("o_orderkey", P.serial_date(F.datediff("o_orderdate", F.lit("1899-12-30").cast("date"))).alias("from_serial"), P.typed_date(F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "dd/MM/yyyy")).when(F.col("o_orderkey") % 3 == 1, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("n/d")).alias("from_text")), "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS from_serial, CASE WHEN o_orderkey % 3 < 2 THEN CAST(o_orderdate AS DATE) END AS from_text FROM orders"),
    "G05_period_ends": (lambda s, d: ORDERS(s, d).select("o_orderkey", P.month_end(F.year("o_orderdate"), F.month("o_orderdate")).alias("m"), P.quarter_end(F.year("o_orderdate"), F.quarter("o_orderdate")).alias("q")), "SELECT o_orderkey, last_day(CAST(o_orderdate AS DATE)) AS m, last_day(CAST(date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH AS DATE)) AS q FROM orders"),
    "G06_month_words": (lambda s, d: ORDERS(s, d).select("o_orderkey", T.month_number(F.element_at(F.array(*(F.lit(w) for w in "Enero febrero MAR abril Mayo jun. Julio agosto Setiembre OCT nov Diciembre".split())), F.month("o_orderdate"))).alias("m")), "SELECT o_orderkey, CAST(month(o_orderdate) AS INT) AS m FROM orders"),
    "G07_quarter_tokens": (lambda s, d: ORDERS(s, d).select("o_orderkey", T.quarter_number(F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("T"), F.quarter("o_orderdate"))).when(F.col("o_orderkey") % 3 == 1, F.element_at(F.array(*map(F.lit, ("I", "II", "III", "IV"))), F.quarter("o_orderdate"))).otherwise(F.concat(F.quarter("o_orderdate"), F.lit("er trim.")))).alias("q")), "SELECT o_orderkey, CAST(quarter(o_orderdate) AS INT) AS q FROM orders"),
    "G08_year_footnotes": (lambda s, d: D.year_column(s, d).filter("c = 1").select("sheet", "r", T.year_label(F.col("text")).alias("y"), T.without_footnote(F.col("text")).alias("plain")), f"WITH {D.F5} SELECT sheet, r, try_cast(substr(text,1,4) AS INT) AS y, substr(text,1,4) AS plain FROM grid WHERE c=1"),
    "G12_path": (lambda s, d: PARTS(s, d).select("p_partkey", T.path(F.split_part("p_name", F.lit(" "), F.lit(1)), F.lit(" "), F.lit(None).cast("string"), F.split_part("p_type", F.lit(" "), F.lit(1)), F.split_part("p_name", F.lit(" "), F.lit(1))).alias("path")), "SELECT p_partkey, CASE WHEN split_part(p_name,' ',1)=split_part(p_type,' ',1) THEN split_part(p_name,' ',1) ELSE split_part(p_name,' ',1) || ' — ' || split_part(p_type,' ',1) END AS path FROM part"),
    "G13_hash_ids": (lambda s, d: PARTS(s, d).select("p_partkey", T.hashed_id("ref:", F.col("p_brand"), F.col("p_type"), F.col("p_size").cast("string")).alias("id")), "SELECT p_partkey, 'ref:' || substr(sha256(p_brand || '|' || p_type || '|' || CAST(p_size AS VARCHAR)),1,24) AS id FROM part"),
    "G15_period_bounds": (lambda s, d: ORDERS(s, d).select("o_orderkey", *(b.alias(n) for n, b in zip(("a", "b"), P.bounds(F.last_day(F.to_date("o_orderdate")), F.when(F.col("o_orderkey") % 3 == 0, "annual").when(F.col("o_orderkey") % 3 == 1, "quarterly").otherwise("monthly"))))), "SELECT o_orderkey, CAST(date_trunc('month', last_day(CAST(o_orderdate AS DATE)) - to_months(CAST(CASE o_orderkey % 3 WHEN 0 THEN 11 WHEN 1 THEN 2 ELSE 0 END AS INT))) AS DATE) AS a, last_day(CAST(o_orderdate AS DATE)) AS b FROM orders"),
    "G19_a1_references": (lambda s, d: D.grid(s, d).select(F.concat(F.char(F.lit(64) + F.col("column_id")), F.col("row_id").cast("string")).alias("ref")).distinct().select("ref", T.a1(F.col("ref"))[0].alias("row_id"), T.a1(F.col("ref"))[1].alias("column_id")), f"WITH {F2} SELECT DISTINCT chr(CAST(64+column_id AS INT)) || CAST(row_id AS VARCHAR) AS ref, row_id, column_id FROM cells"),
    "G21_entity_types": (lambda s, d: CUSTOMERS(s, d).groupBy(T.first_match(T.normalized(F.col("c_mktsegment")), [("^auto|mach", "industry"), ("build", "construction")]).alias("kind")).agg(F.count("*").alias("n")), "SELECT CASE WHEN regexp_matches(lower(c_mktsegment),'^auto|mach') THEN 'industry' WHEN regexp_matches(lower(c_mktsegment),'build') THEN 'construction' END AS kind, count(*) AS n FROM customer GROUP BY 1"),
    "G22_slugs": (lambda s, d: PARTS(s, d).select("p_partkey", T.slug(F.concat_ws(" / ", "p_type", "p_brand")).alias("slug")), "SELECT p_partkey, regexp_replace(regexp_replace(lower(p_type || ' / ' || p_brand),'[^a-z0-9]+','_','g'),'^_|_$','','g') AS slug FROM part"),
    "K02_semantics": (lambda s, d: S.derived(labels(s, d)), f"WITH {_L} SELECT {_DERIVED} FROM n"),
    "K04_reviewed_overlay": (
        k04,
        f"WITH {_L}, v AS (SELECT {_DERIVED} FROM n) SELECT series_id, CASE WHEN series_id%7=0 THEN 'ratio' ELSE unit END AS unit, CASE WHEN series_id%7=0 THEN 'reviewed' WHEN unit IS NOT NULL THEN 'derived' ELSE 'unknown' END AS unit_basis, CASE WHEN series_id%14=0 THEN 1.0 ELSE scale_multiplier END AS scale_multiplier, CASE WHEN series_id%14=0 THEN 'reviewed' WHEN scale_multiplier IS NOT NULL THEN 'derived' ELSE 'unknown' END AS scale_multiplier_basis FROM v",
    ),
    "K05_register_problems": (
        k05,
        "WITH g AS (SELECT CASE WHEN p_partkey%50=0 THEN '' ELSE p_brand END AS reviewer, p_name AS name, split_part(p_type,' ',1) AS kind FROM part), x AS (SELECT name AS entry, 'blank reviewer' AS problem FROM g WHERE reviewer IS NULL OR reviewer='' UNION ALL SELECT name, 'unknown kind' FROM g WHERE kind NOT IN ('PROMO','ECONOMY','STANDARD','SMALL','MEDIUM') UNION ALL SELECT name, 'duplicate' FROM g GROUP BY 1 HAVING count(*)>1) SELECT problem, count(*) AS n, min(entry) AS first_entry FROM x GROUP BY 1",
    ),
    "M16_alias_agreement": (m16, f"WITH {F1}, x AS (SELECT split_part(series_id,':',2) AS pair, split_part(series_id,':',3) AS side, period, value FROM realised) SELECT a.pair, count(*) AS shared_periods, count(*) FILTER (WHERE abs(a.value-b.value) <= 0.5*abs(b.value)) AS agreeing FROM x a JOIN x b ON a.pair=b.pair AND a.period=b.period WHERE a.side='F' AND b.side='O' GROUP BY 1"),
    "O04_domain_mart": (o04, f"WITH {F1} SELECT series_id, period, value, CASE WHEN series_id LIKE '%:P' THEN 'prices' ELSE 'activity' END AS domain FROM realised WHERE split_part(series_id,':',2) NOT IN ('5-LOW','4-NOT SPECIFIED')"),
    "O05_grain_catalogue": (
        lambda s, d: M.grain_catalogue(D.grid_observations(D.grid(s, d)), D.grid_observations(D.grid(s, d))),
        f"WITH {F2} SELECT series_id, count(*) AS n_observations, min(period) AS first_period, max(period) AS last_period, string_agg(DISTINCT source_sheet, ', ' ORDER BY source_sheet) AS sheets FROM obs GROUP BY 1",
    ),
    "O06_coverage_dashboard": (
        o06,
        f"WITH {F2}, {CLASSED} SELECT c.source_sheet, n_cells, last_row, last_column, coalesce(n_observations,0) AS n_observations, coalesce(n_series,0) AS n_series, coalesce(n_open,0) AS n_open FROM (SELECT source_sheet, count(*) AS n_cells, max(row_id) AS last_row, max(column_id) AS last_column FROM cells GROUP BY 1) c LEFT JOIN (SELECT source_sheet, count(*) AS n_observations, count(DISTINCT series_id) AS n_series FROM obs GROUP BY 1) o USING (source_sheet) LEFT JOIN (SELECT source_sheet, count(*) FILTER (WHERE classification='unclassified') AS n_open FROM classed GROUP BY 1) k USING (source_sheet)",
    ),
}


def queries():
    return {k: v[0] for k, v in _Q.items()}


def oracle_sql():
    return {k: v[1] for k, v in _Q.items()}
