"""Queries of single joins, aggregates, windows, orders and text functions, with the SQL they equal."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import periods as P
from ..functions import text as T
from ..operators import accounting as A
from ..operators import governance as G
from ..operators import grid as H
from ..operators import identity as I
from ..operators import quality as Q
from ..operators import screens
from ..sources import derived as D
from ..sources import files
from ..sources.derived import F1, F2, F7
from ..sources.stored import shared_dir
from .governance_queries import _OUT, _regions
from .relational_queries import CUSTOMERS, LINES, ORDERS, PARTS, aliases
from .vintage_queries import GAPS, _realised


def c10(s, d):
    """The accepted vintage in force on each line's ship date: the register's dates as spans, lines joined to them by range."""
    spans = D.accepted(s).withColumn("until", F.lead("available_at").over(Window.orderBy("available_at", "vintage_id")))
    day = F.to_date("l_shipdate")
    held = (day >= F.col("available_at")) & (F.col("until").isNull() | (day < F.col("until")))
    return LINES(s, d).join(F.broadcast(spans), held, "left").groupBy("vintage_id").agg(F.count("*").alias("n_lines"))


def c12(s, d):
    rows = _realised(s, d).select(F.split_part("series_id", F.lit(":"), F.lit(2)).alias("pair"), F.split_part("series_id", F.lit(":"), F.lit(3)).alias("side"), "period", "value")
    left = rows.filter("side = 'F'").select("pair", "period", F.col("value").alias("alias_value"))
    return left.join(rows.filter("side = 'O'").select("pair", "period", F.col("value").alias("primary_value")), ["pair", "period"])


def c14(s, d):
    where = LINES(s, d).groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.min("l_suppkey").alias("any_supplier"))
    return PARTS(s, d).select("p_partkey").join(where, "p_partkey", "left")


def e07(s, d):
    """Partners of each side counted by two groupings of the distinct pairs, joined back."""
    pairs = LINES(s, d).select("l_partkey", "l_suppkey").distinct()
    suppliers = pairs.groupBy("l_partkey").agg(F.count("*").alias("n_suppliers"))
    parts = pairs.groupBy("l_suppkey").agg(F.count("*").alias("n_parts"))
    return pairs.join(suppliers, "l_partkey").join(parts, "l_suppkey").select("l_partkey", "l_suppkey", "n_suppliers", "n_parts")


def e09(s, d):
    """A year stands in its first month's row and holds for at most eleven rows on."""
    rows = D.year_column(s, d).filter("c = 1").withColumn("y", T.year_label(F.col("text")))
    before = Window.partitionBy("sheet").orderBy("r").rowsBetween(Window.unboundedPreceding, 0)
    filled = rows.select("sheet", "r", F.last("y", ignorenulls=True).over(before).alias("y"), F.last(F.when(F.col("y").isNotNull(), F.col("r")), ignorenulls=True).over(before).alias("at"))
    return filled.select("sheet", "r", F.when(F.col("r") - F.col("at") < 12, F.col("y")).alias("y"))


def f10(s, d):
    """Every third identifier is retired; what retired ones end in, by steps of retirement."""
    return I.closure(aliases(s, d).filter("old_id % 3 <> 0"))


def _word(number):
    return F.element_at(F.array(*(F.lit(w) for w in "Ene FEB mar Abr may JUN jul ago Set oct nov Dic".split())), number)


def g09(s, d):
    size = F.col("p_size") % 4
    label = F.concat("p_name", F.when(size == 0, " (*)").when(size == 1, " */").when(size == 2, " 1/").otherwise(""))
    mark = F.when(size == 0, "(*)").when(size == 1, "*/").otherwise("")
    return PARTS(s, d).select("p_partkey", T.without_footnote(label).alias("label"), T.footnote_only(mark).alias("only_mark"))


def g10(s, d):
    """Each order day as one of three kinds of axis label, read back."""
    o = ORDERS(s, d).select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    word, two = _word(F.month("d")), F.date_format("d", "yy")
    kind = F.col("o_orderkey") % 3
    label = F.when(kind == 0, F.date_format("d", "yyyy-MM")).when(kind == 1, F.concat_ws("-", word, two)).otherwise(F.concat_ws("-", F.day("d").cast("string"), word, two))
    return o.select("o_orderkey", T.axis_date(label).alias("day"))


def g11(s, d):
    lo, hi = F.month("l_shipdate"), (1 + F.col("l_partkey") % 12).cast("int")
    first, last = T.month_interval(F.concat_ws("/", _word(lo), _word(hi)))
    return LINES(s, d).groupBy(first.alias("first_month"), last.alias("last_month")).agg(F.count("*").alias("n"))


def g14(s, d):
    name = F.concat(F.lit("boletin_"), F.date_format("o_orderdate", "yyyy"), F.when(F.col("o_orderkey") % 2 == 0, "-").otherwise(""), F.date_format("o_orderdate", "MM"), F.lit(".xlsx"))
    return ORDERS(s, d).groupBy(files.date_from_name(name).alias("publication_date")).agg(F.count("*").alias("n_files"))


def g16(s, d):
    spans = ORDERS(s, d).groupBy("o_custkey").agg(F.min(F.to_date("o_orderdate")).alias("a"), F.max(F.to_date("o_orderdate")).alias("b"))
    return spans.select("o_custkey", F.explode(P.expected(F.col("a"), F.col("b"), 3)).alias("period")).groupBy("o_custkey").agg(F.count("*").alias("n_periods"), F.max("period").alias("last_period"))


def g18(s, d):
    words = PARTS(s, d).select(F.explode(F.split("p_type", " ")).alias("word"), F.split_part("p_brand", F.lit("#"), F.lit(2)).try_cast("int").alias("brand"), F.replace("p_name", F.lit(" "), F.lit("_")).alias("name"))
    return words.groupBy("word").agg(F.count("brand").alias("n_brands"), F.max("brand").alias("top_brand"), F.min("name").alias("first_name"))


def g23(s, d):
    return files.long_form(D.trades(s, d).withColumn("l_key", F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")), ["l_key"], ["fecha", "volumen", "moneda"]).groupBy("column").agg(
        F.count("text").alias("n_texts"), F.count("num").alias("n_numbers"), F.count("date").alias("n_dates"), F.count_if(T.blank(F.col("text"))).alias("n_blank")
    )


def h01(s, d):
    """Coherent year rows and columns of every worksheet."""
    return H.year_axes(D.worksheets(s, d), "row_id", "column_id")


def _files(s, d):
    """Orders as archived files: a source for each customer, a content for each price, times by day."""
    return ORDERS(s, d).select(F.col("o_custkey").alias("source_id"), F.sha2(F.col("o_orderkey").cast("string"), 256).alias("sha256"), F.to_date("o_orderdate").alias("modificationTime"), F.col("o_orderkey").cast("string").alias("path"), F.when(F.col("o_orderstatus") != "P", F.last_day(F.to_date("o_orderdate"))).alias("publication_date"))


_FILES = "fl AS (SELECT o_custkey AS source_id, sha256(CAST(o_orderkey AS VARCHAR)) AS sha256, CAST(o_orderdate AS DATE) AS t, CAST(o_orderkey AS VARCHAR) AS path, o_orderkey AS k FROM orders)"


def a02(s, d):
    """The recorded hash is that of the customer's first order, for even customers; the others take the newest file."""
    recorded = ORDERS(s, d).filter("o_custkey % 2 = 0").groupBy(F.col("o_custkey").alias("source_id")).agg(F.sha2(F.min("o_orderkey").cast("string"), 256).alias("sha256"))
    chosen, tied = files.in_force(_files(s, d), recorded)
    return chosen.select("source_id", "path", F.lit("chosen").alias("state")).unionByName(tied.select("source_id", F.lit(None).cast("string").alias("path"), F.lit("tied").alias("state")))


def a03(s, d):
    """Replay places of the archive, by content."""
    doubled = _files(s, d).unionByName(_files(s, d).withColumn("path", F.concat("path", F.lit("-copy"))))
    return files.replay_order(doubled).select("source_id", "sha256", "path", "publication_date")


def a05(s, d):
    """Trades written as ';' files with padded fields and read again under guard."""
    path = shared_dir(s, "trades")
    names = ["fecha", "volumen", "instrumento", "moneda"]
    D.trades(s, d).select("fecha", "volumen", F.concat(F.lit(" x"), "instrumento", F.lit(" ")).alias("instrumento"), "moneda").write.option("sep", ";").option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    read = files.guarded(s, path, names)
    by = ["instrumento", "moneda"]
    days = read.groupBy(*by, "fecha").agg(F.count("*").alias("n"))  # few: the smallest text of a group is then one of few rows
    told = days.groupBy(*by).agg(F.sum("n").alias("n_rows"), F.min("fecha").alias("first_day"))
    both = told.alias("t").join(files.counted_places(read, *by).alias("p"), F.expr(" and ".join(f"t.{c} <=> p.{c}" for c in by)))
    return both.select("t.instrumento", "t.moneda", "n_rows", "n_places", "first_day")


_Q = {
    "A05_guarded_scan": (a05, f"WITH {D.F3.strip()} SELECT 'x'||instrumento AS instrumento, moneda, count(*) AS n_rows, count(*) AS n_places, min(fecha) AS first_day FROM raw GROUP BY 1,2"),
    "A02_files_in_force": (a02, f"WITH {_FILES}, r AS (SELECT o_custkey AS source_id, sha256(CAST(min(o_orderkey) AS VARCHAR)) AS rec FROM orders WHERE o_custkey % 2 = 0 GROUP BY 1), j AS (SELECT fl.*, coalesce(rec = sha256, FALSE) AS hit FROM fl LEFT JOIN r USING (source_id)), k AS (SELECT *, rank() OVER (PARTITION BY source_id ORDER BY hit DESC, t DESC) AS k1 FROM j), tp AS (SELECT source_id, count(DISTINCT sha256) AS c, min(path) AS path FROM k WHERE k1 = 1 GROUP BY 1) SELECT source_id, CASE WHEN c = 1 THEN path END AS path, CASE WHEN c = 1 THEN 'chosen' ELSE 'tied' END AS state FROM tp"),
    "A03_replay_order": (a03, f"WITH {_FILES} SELECT source_id, sha256, path, CASE WHEN o_orderstatus <> 'P' THEN last_day(t) END AS publication_date FROM fl JOIN orders ON o_orderkey = k"),
    "A04_bundle_id": (lambda s, d: files.bundle_id(D.table(s, d, "nation").select(F.col("n_name").alias("source_id"), F.sha2("n_name", 256).alias("sha256"))), "SELECT sha256(string_agg(n_name || ':' || sha256(n_name), '|' ORDER BY n_name || ':' || sha256(n_name))) AS bundle_id, count(*) AS n_files FROM nation"),
    "A06_extent": (lambda s, d: files.extent(D.trades(s, d)), f"WITH {D.F3.strip()}, c AS (SELECT DISTINCT len(json_keys(to_json(r))) AS n_columns FROM (SELECT r FROM raw AS r LIMIT 1)) SELECT (SELECT count(*) FROM raw) AS n_rows, CAST((SELECT n_columns FROM c) AS INTEGER) AS n_columns"),
    "C01_inner": (lambda s, d: LINES(s, d).join(ORDERS(s, d), F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("quantity")), "SELECT o_orderpriority, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity FROM lineitem JOIN orders ON l_orderkey=o_orderkey GROUP BY 1"),
    "C05_semi": (lambda s, d: CUSTOMERS(s, d).join(ORDERS(s, d).filter("o_orderstatus = 'F'"), F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("c_custkey", "c_nationkey"), "SELECT c_custkey, c_nationkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey=c_custkey AND o_orderstatus='F')"),
    "C06_not_exists": (lambda s, d: Q.orphans(PARTS(s, d).select("p_partkey"), LINES(s, d).filter("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey")), "p_partkey"), "SELECT p_partkey FROM part WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey=p_partkey AND l_quantity>45)"),
    "C07_rule_rectangles": (lambda s, d: A.rule_matches(D.grid(s, d), D.rules(s)).groupBy("rule_id", F.col("source_sheet")).agg(F.count("*").alias("n_cells"), F.min("row_id").alias("first_row"), F.max("column_id").alias("last_column")), f"WITH {F2} SELECT rule_id, c.source_sheet, count(*) AS n_cells, min(row_id) AS first_row, max(column_id) AS last_column FROM cells c JOIN rules r ON (r.source_sheet='*' OR r.source_sheet=c.source_sheet) AND row_id BETWEEN row_from AND row_to AND column_id BETWEEN column_from AND column_to GROUP BY 1,2"),
    "C10_as_of": (c10, "WITH a AS (SELECT * FROM (VALUES ('v1',DATE '1999-01-15'),('v2',DATE '2000-07-15'),('v3',DATE '2001-07-15')) AS x(vintage_id, since)), l AS (SELECT CAST(l_shipdate AS DATE) AS day FROM lineitem) SELECT vintage_id, count(*) AS n_lines FROM l ASOF LEFT JOIN a ON l.day >= a.since GROUP BY 1"),
    "C12_alias_periods": (c12, f"WITH {F1}, x AS (SELECT split_part(series_id,':',2) AS pair, split_part(series_id,':',3) AS side, period, value FROM realised) SELECT a.pair, a.period, a.value AS alias_value, b.value AS primary_value FROM x a JOIN x b ON a.pair=b.pair AND a.period=b.period WHERE a.side='F' AND b.side='O'"),
    "C14_any_coordinate": (c14, "SELECT p_partkey, (SELECT min(l_suppkey) FROM lineitem WHERE l_partkey=p_partkey) AS any_supplier FROM part"),
    "D01_grouped": (lambda s, d: ORDERS(s, d).groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.min(F.to_date("o_orderdate")).alias("first_day"), F.max(F.to_date("o_orderdate")).alias("last_day"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total")), "SELECT o_orderstatus, count(*) AS n, min(CAST(o_orderdate AS DATE)) AS first_day, max(CAST(o_orderdate AS DATE)) AS last_day, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders GROUP BY 1"),
    "D08_any_value": (lambda s, d: LINES(s, d).groupBy("l_returnflag", "l_linestatus").agg(F.any_value(F.when(F.col("l_linenumber") > 1, F.concat("l_returnflag", "l_linestatus")), F.lit(True)).alias("sheet")), "SELECT l_returnflag, l_linestatus, any_value(CASE WHEN l_linenumber > 1 THEN l_returnflag || l_linestatus END) AS sheet FROM lineitem GROUP BY 1,2"),
    "D09_group_by_all": (lambda s, d: s.sql("SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM {orders} GROUP BY ALL", orders=ORDERS(s, d)), "SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL"),
    "D10_having": (lambda s, d: ORDERS(s, d).groupBy("o_custkey").agg(F.countDistinct("o_orderpriority").alias("n_priorities"), F.countDistinct("o_orderstatus").alias("n_statuses")).filter("n_priorities >= 3 and n_statuses > 1"), "SELECT o_custkey, count(DISTINCT o_orderpriority) AS n_priorities, count(DISTINCT o_orderstatus) AS n_statuses FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderpriority) >= 3 AND count(DISTINCT o_orderstatus) > 1"),
    "E01_latest_row": (lambda s, d: ORDERS(s, d).select("o_custkey", "o_orderkey", "o_orderstatus", F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.col("o_orderdate").desc_nulls_last(), F.col("o_orderkey").desc())).alias("k")).filter("k = 1").drop("k"), "SELECT o_custkey, o_orderkey, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) AS k FROM orders) WHERE k=1"),
    "E02_newest_rows": (lambda s, d: ORDERS(s, d).select("o_custkey", "o_orderkey", F.dense_rank().over(Window.partitionBy("o_custkey").orderBy(F.last_day("o_orderdate").desc())).alias("k")).filter("k = 1").drop("k"), "SELECT o_custkey, o_orderkey FROM (SELECT *, dense_rank() OVER (PARTITION BY o_custkey ORDER BY last_day(CAST(o_orderdate AS DATE)) DESC) AS k FROM orders) WHERE k=1"),
    "E05_count_over": (lambda s, d: ORDERS(s, d).select("o_orderkey", F.count("*").over(Window.partitionBy("o_custkey")).alias("n_orders")), "SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey) AS n_orders FROM orders"),
    "E07_partners": (e07, "WITH p AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) SELECT l_partkey, l_suppkey, count(*) OVER (PARTITION BY l_partkey) AS n_suppliers, count(*) OVER (PARTITION BY l_suppkey) AS n_parts FROM p"),
    "E09_bounded_fill": (e09, "WITH " + D.F5.strip() + ", k AS (SELECT sheet, r, y0, last_value(y0 IGNORE NULLS) OVER w AS y, last_value(CASE WHEN y0 IS NOT NULL THEN r END IGNORE NULLS) OVER w AS held FROM yr WINDOW w AS (PARTITION BY sheet ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) SELECT sheet, r, CASE WHEN r - held < 12 THEN y END AS y FROM k"),
    "F01_nulls_last": (lambda s, d: CUSTOMERS(s, d).select("c_custkey", F.row_number().over(Window.partitionBy("c_nationkey").orderBy(F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).desc_nulls_last(), F.col("c_custkey").asc_nulls_last())).cast("long").alias("place")), "SELECT c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY CASE WHEN c_acctbal>=0 THEN c_acctbal END DESC NULLS LAST, c_custkey NULLS LAST) AS place FROM customer"),
    "F03_worklist": (lambda s, d: screens.worklist(screens.gaps(_realised(s, d), 1), [F.col("missing_periods").desc(), "series_id", "period"], 20).select("series_id", "period", "missing_periods", F.col("rank").cast("long").alias("rank"), "total"), f"WITH {F1}, {GAPS}, g AS (SELECT series_id, period, CAST(datediff('month', p, period) - 1 AS INT) AS missing_periods FROM steps WHERE p IS NOT NULL AND datediff('month', p, period) > 1) SELECT *, row_number() OVER (ORDER BY missing_periods DESC, series_id, period) AS rank, count(*) OVER () AS total FROM g ORDER BY missing_periods DESC, series_id, period LIMIT 20"),
    "F04_review_queue": (lambda s, d: A.review_queue(G.region_completeness(D.grid(s, d), _regions(s))), f"WITH {F2}, {_OUT}, c AS (SELECT source_sheet FROM cells GROUP BY 1), o AS (SELECT source_sheet, count(*) AS n, count(num) AS m FROM out GROUP BY 1), q AS (SELECT source_sheet, coalesce(n,0) AS n, coalesce(m,0) AS m FROM c LEFT JOIN o USING (source_sheet)), t AS (SELECT *, CASE WHEN m*2>n THEN 1 WHEN n>0 THEN 2 ELSE 3 END AS tier FROM q) SELECT source_sheet, tier, m*(4-tier) AS weight FROM t"),
    "F10_retired_closure": (f10, "WITH RECURSIVE a AS (SELECT c_custkey AS old_id, c_custkey // 3 AS new_id FROM customer WHERE c_custkey>=3 AND c_custkey % 3 <> 0), r AS (SELECT old_id, new_id FROM a UNION SELECT r.old_id, a.new_id FROM r JOIN a ON a.old_id=r.new_id) SELECT old_id, new_id FROM r"),
    "G03_blank": (lambda s, d: D.trades(s, d).groupBy(T.blank(F.col("volumen")).alias("blank_volume"), T.blank(F.col("instrumento")).alias("blank_instrument")).agg(F.count("*").alias("n")), f"WITH {D.F3.strip()} SELECT volumen IS NULL OR trim(volumen)='' AS blank_volume, instrumento IS NULL OR trim(instrumento)='' AS blank_instrument, count(*) AS n FROM raw GROUP BY 1,2"),
    "G09_footnotes": (g09, "SELECT p_partkey, trim(p_name) AS label, p_size % 4 < 2 AS only_mark FROM part"),
    "G10_axis_dates": (g10, "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN CAST(o_orderdate AS DATE) ELSE last_day(CAST(o_orderdate AS DATE)) END AS day FROM orders"),
    "G11_month_intervals": (g11, "WITH m AS (SELECT month(l_shipdate) AS a, CAST(1 + l_partkey % 12 AS BIGINT) AS b FROM lineitem) SELECT CASE WHEN a<=b THEN a END AS first_month, CASE WHEN a<=b THEN b END AS last_month, count(*) AS n FROM m GROUP BY 1,2"),
    "G14_date_from_name": (g14, "SELECT last_day(CAST(o_orderdate AS DATE)) AS publication_date, count(*) AS n_files FROM orders GROUP BY 1"),
    "G16_expected_periods": (g16, "WITH m AS (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS a, max(CAST(o_orderdate AS DATE)) AS b FROM orders GROUP BY 1), e AS (SELECT o_custkey, last_day(CAST(unnest(generate_series(date_trunc('month',a), date_trunc('month',b), INTERVAL 3 MONTH)) AS DATE)) AS p FROM m) SELECT o_custkey, count(*) AS n_periods, max(p) AS last_period FROM e GROUP BY 1"),
    "G18_text_primitives": (g18, "WITH w AS (SELECT unnest(string_split(p_type,' ')) AS word, TRY_CAST(split_part(p_brand,'#',2) AS INT) AS brand, replace(p_name,' ','_') AS name FROM part) SELECT word, count(brand) AS n_brands, max(brand) AS top_brand, min(name) AS first_name FROM w GROUP BY 1"),
    "G23_cell_views": (g23, f"WITH {D.F3.strip()}, u AS (SELECT unnest(['fecha','volumen','moneda']) AS \"column\", unnest([fecha, volumen, moneda]) AS text FROM raw) SELECT \"column\", count(text) AS n_texts, count(TRY_CAST(text AS DOUBLE)) AS n_numbers, CAST(0 AS BIGINT) AS n_dates, count(*) FILTER (WHERE text IS NULL OR trim(text)='') AS n_blank FROM u GROUP BY 1"),
    "H01_year_axes": (h01, f"WITH {F7}, n AS (SELECT count(DISTINCT y) AS n FROM q) SELECT x.s AS source_sheet, CAST(x.r AS BIGINT) AS row_id, n FROM n, (SELECT 'HY' AS s, 3 AS r UNION ALL SELECT DISTINCT 'YM_'||f, 2 FROM q UNION ALL SELECT 'YQ', 2) AS x WHERE n >= 3"),
}


def queries():
    return {k: v[0] for k, v in _Q.items()}


def oracle_sql():
    return {k: v[1] for k, v in _Q.items()}
