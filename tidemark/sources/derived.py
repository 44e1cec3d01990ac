"""The engine's model tables, derived by Spark from the driver's tables; and the same as DuckDB common table expressions.

Every frame grows with its table: vintages of order statistics, a cell grid of lineitem quantities, a delimited trades
file, two releases of identifiers, a worksheet's year column and an entity panel.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .stored import saved

VINTAGES = [("v1", date(1999, 1, 15), date(1999, 1, 1)), ("v2", date(2000, 7, 15), date(2000, 8, 1)), ("v3", date(2001, 7, 15), date(2001, 9, 1)), ("v4", date(2001, 9, 15), date(2001, 9, 1))]
ACCEPTED = ("v1", "v2", "v3")
RULES = [("r1", "*", 0, 1000000, 3, 5, "subtotal_or_formula"), ("r2", "AF", 0, 40, 0, 9, "header_or_label"), ("r3", "NO", 0, 1000, 3, 3, "parser_defect")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vintages(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(VINTAGES, "vintage_id string, publication_date date, horizon date")


def accepted(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(v, p) for v, p, _ in VINTAGES if v in ACCEPTED], "vintage_id string, available_at date")


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly order totals by priority and status, as four vintages published them. Sums are decimal, so exact."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("v"), F.to_date("o_orderdate").alias("d"))
    v, m = F.col("vintage_id"), F.month("d")
    kept = ~((v == "v1") & (F.col("o_orderkey") % 10 == 0)) & ~((v == "v2") & (F.col("o_orderpriority") == "5-LOW") & (m == 3)) & ~((m == 2) & (F.col("o_orderstatus") == "F"))
    joined = o.join(F.broadcast(vintages(spark)), (F.col("d") < F.col("horizon")) & kept)
    series = F.concat_ws(":", F.lit("orders"), "o_orderpriority", "o_orderstatus").alias("series_id")
    sums = joined.groupBy("vintage_id", "publication_date", series, F.last_day("d").alias("period")).agg(F.sum("v").alias("dv"))
    return sums.select("vintage_id", "publication_date", "series_id", "period", (F.col("dv") + F.when(v == "v4", 1).otherwise(0)).cast("double").alias("value"))


F1 = """
vint AS (SELECT * FROM (VALUES ('v1',DATE '1999-01-15',DATE '1999-01-01'),('v2',DATE '2000-07-15',DATE '2000-08-01'),('v3',DATE '2001-07-15',DATE '2001-09-01'),('v4',DATE '2001-09-15',DATE '2001-09-01')) AS x(vintage_id,publication_date,horizon)),
agg AS (SELECT v.vintage_id, v.publication_date, 'orders:'||o.o_orderpriority||':'||o.o_orderstatus AS series_id, last_day(CAST(o.o_orderdate AS DATE)) AS period,
 sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS dv
 FROM orders o JOIN vint v ON CAST(o.o_orderdate AS DATE) < v.horizon AND NOT (v.vintage_id='v1' AND o.o_orderkey % 10 = 0)
   AND NOT (v.vintage_id='v2' AND o.o_orderpriority='5-LOW' AND month(o.o_orderdate)=3)
   AND NOT (month(o.o_orderdate)=2 AND o.o_orderstatus='F')
 GROUP BY 1,2,3,4),
snap AS (SELECT vintage_id,publication_date,series_id,period,CAST(dv + CASE WHEN vintage_id='v4' THEN 1 ELSE 0 END AS DOUBLE) AS value FROM agg),
seqd AS (SELECT k.series_id,k.period,v.vintage_id,v.publication_date, s.value, lag(s.value) OVER w AS prev, lag(v.vintage_id) OVER w AS prev_v
  FROM (SELECT DISTINCT series_id, period FROM snap) k CROSS JOIN vint v LEFT JOIN snap s ON s.series_id=k.series_id AND s.period=k.period AND s.vintage_id=v.vintage_id
  WINDOW w AS (PARTITION BY k.series_id,k.period ORDER BY v.vintage_id)),
fact AS (SELECT series_id,period,vintage_id,publication_date,value,(value IS NULL) AS is_deleted FROM seqd
  WHERE (value IS NOT NULL AND (prev IS NULL OR abs(value-prev)>1e-12)) OR (value IS NULL AND prev IS NOT NULL)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY series_id, period ORDER BY publication_date DESC NULLS LAST, vintage_id DESC) AS rk FROM fact WHERE vintage_id IN ('v1','v2','v3')),
latest AS (SELECT series_id, period, value, vintage_id, publication_date, CASE WHEN publication_date IS NOT NULL AND period > publication_date THEN 'after_publication' ELSE 'observed' END AS observation_status
  FROM ranked WHERE rk = 1 AND NOT is_deleted),
realised AS (SELECT * FROM latest WHERE observation_status = 'observed')"""


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cell for each sheet (flag and status), month row and line-number column, with the tokens of published sheets."""
    li = table(spark, sf_dir, "lineitem").select(
        F.concat("l_returnflag", "l_linestatus").alias("source_sheet"), F.to_date("l_shipdate").alias("d"), (F.col("l_linenumber") + 2).cast("long").alias("column_id"), F.col("l_quantity").cast("decimal(18,2)").alias("q")
    )
    row = (1 + (F.year("d") - 1995) * 12 + F.month("d")).cast("long").alias("row_id")
    cells = li.groupBy("source_sheet", row, "column_id", F.last_day("d").alias("period")).agg(F.sum("q").cast("double").alias("v"))
    token = F.when((F.col("row_id") * 7 + F.col("column_id")) % 31 == 0, "s/m").when((F.col("row_id") * 5 + F.col("column_id")) % 43 == 0, "")
    return cells.withColumn("tok", token).select(F.lit("v3").alias("vintage_id"), "source_sheet", "row_id", "column_id", "period", "tok", F.when(F.col("tok").isNull(), F.col("v")).alias("num"))


def grid_observations(cells: DataFrame) -> DataFrame:
    read = cells.filter(F.col("num").isNotNull() & ((F.col("row_id") * 3 + F.col("column_id")) % 37 != 0))
    return read.select("vintage_id", "source_sheet", F.col("row_id").alias("source_row"), F.col("column_id").alias("source_column"), F.concat_ws(":", F.lit("li"), "source_sheet", F.col("column_id").cast("string")).alias("series_id"), "period", F.col("num").alias("value"))


def rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RULES, "rule_id string, source_sheet string, row_from long, row_to long, column_from long, column_to long, classification string")


F2 = """
cells0 AS (SELECT 'v3' AS vintage_id, l_returnflag||l_linestatus AS source_sheet, CAST(1+(year(l_shipdate)-1995)*12+month(l_shipdate) AS BIGINT) AS row_id, CAST(2+l_linenumber AS BIGINT) AS column_id,
  last_day(CAST(l_shipdate AS DATE)) AS period, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS v FROM lineitem GROUP BY 1,2,3,4,5),
cells AS (SELECT vintage_id,source_sheet,row_id,column_id,period,
  CASE WHEN (row_id*7+column_id)%31=0 THEN 's/m' WHEN (row_id*5+column_id)%43=0 THEN '' END AS tok,
  CASE WHEN (row_id*7+column_id)%31=0 OR (row_id*5+column_id)%43=0 THEN NULL ELSE v END AS num FROM cells0),
obs AS (SELECT vintage_id,source_sheet,row_id AS source_row,column_id AS source_column,'li:'||source_sheet||':'||CAST(column_id AS VARCHAR(10)) AS series_id,period,num AS value FROM cells WHERE num IS NOT NULL AND (row_id*3+column_id)%37<>0),
rules AS (SELECT * FROM (VALUES ('r1','*',0,1000000,3,5,'subtotal_or_formula'),('r2','AF',0,40,0,9,'header_or_label'),('r3','NO',0,1000,3,3,'parser_defect')) AS x(rule_id,source_sheet,row_from,row_to,column_from,column_to,classification))"""


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a delimited trades file as text, keyed by their line's order keys, with the defects such files have."""
    li = table(spark, sf_dir, "lineitem")
    volume = F.replace(F.col("l_extendedprice").cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(","))
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.when(F.col("l_orderkey") % 211 == 0, "99/99/2001").otherwise(F.date_format("l_shipdate", "dd/MM/yyyy")).alias("fecha"),
        F.when(F.col("l_orderkey") % 307 == 0, "12abc").when(F.col("l_orderkey") % 101 == 0, "").otherwise(volume).alias("volumen"),
        F.when(F.col("l_partkey") % 97 == 0, "").otherwise(F.col("l_returnflag")).alias("instrumento"),
        F.when(F.col("l_suppkey") % 2 == 0, "USD").otherwise("PYG").alias("moneda"),
    )


F3 = """
raw AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
 CASE WHEN l_orderkey % 211=0 THEN '99/99/2001' ELSE strftime(l_shipdate, '%d/%m/%Y') END AS fecha,
 CASE WHEN l_orderkey % 307=0 THEN '12abc' WHEN l_orderkey % 101=0 THEN '' ELSE replace(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR),'.',',') END AS volumen,
 CASE WHEN l_partkey % 97=0 THEN '' ELSE l_returnflag END AS instrumento, CASE WHEN l_suppkey % 2=0 THEN 'USD' ELSE 'PYG' END AS moneda FROM lineitem),
cls AS (SELECT *, CASE WHEN fecha='' OR try_strptime(fecha,'%d/%m/%Y') IS NULL THEN 'invalid_date'
  WHEN volumen<>'' AND NOT regexp_full_match(volumen, '-?([0-9]+|[0-9]{1,3}(\\.[0-9]{3})+)(,[0-9]+)?') THEN 'invalid_numeric_token'
  WHEN instrumento='' OR moneda='' THEN 'missing_mandatory_dimension' END AS reason,
  CAST(try_strptime(fecha,'%d/%m/%Y') AS DATE) AS dia, try_cast(replace(volumen, ',', '.') AS DECIMAL(18,2)) AS vol FROM raw)"""


def releases(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Identifiers of one sheet grid in a release before and in the one after: (sheet, r, c, period, sid)."""
    li = table(spark, sf_dir, "lineitem").select(F.concat("l_returnflag", "l_linestatus").alias("sheet"), F.to_date("l_shipdate").alias("d"), (F.col("l_linenumber") + 2).cast("long").alias("c"))
    g = li.select("sheet", (1 + (F.year("d") - 1995) * 12 + F.month("d")).cast("long").alias("r"), "c", F.last_day("d").alias("period")).distinct()
    c = F.col("c").cast("string")
    before = g.filter("sheet <> 'NO'").withColumn("sid", F.concat(F.lit("p:"), "sheet", F.lit(":"), F.when(F.col("c").isin(3, 4), "34").otherwise(c)))
    new = F.when(F.col("c") == 5, F.concat(F.lit("p:"), "sheet", F.lit(":5"))).when(F.col("c").isin(6, 7), F.concat(F.lit("n:"), "sheet", F.lit(":67"))).otherwise(F.concat(F.lit("n:"), "sheet", F.lit(":"), c))
    return before, g.filter("not (sheet = 'AF' and c = 9)").withColumn("sid", new)


F4 = """
g AS (SELECT l_returnflag||l_linestatus AS sheet, CAST(1+(year(l_shipdate)-1995)*12+month(l_shipdate) AS BIGINT) AS r, CAST(2+l_linenumber AS BIGINT) AS c, last_day(CAST(l_shipdate AS DATE)) AS period FROM lineitem GROUP BY 1,2,3,4),
prv AS (SELECT sheet,r,c,period, CASE WHEN c IN (3,4) THEN 'p:'||sheet||':34' ELSE 'p:'||sheet||':'||CAST(c AS VARCHAR(4)) END AS sid FROM g WHERE sheet<>'NO'),
cur AS (SELECT sheet,r,c,period, CASE WHEN c=5 THEN 'p:'||sheet||':5' WHEN c IN (6,7) THEN 'n:'||sheet||':67' ELSE 'n:'||sheet||':'||CAST(c AS VARCHAR(4)) END AS sid FROM g WHERE NOT (sheet='AF' AND c=9)),
pr AS (SELECT o.sid AS old_id, n.sid AS new_id, count(*) AS shared FROM prv o JOIN cur n ON o.sheet=n.sheet AND o.r=n.r AND o.c=n.c AND o.period=n.period GROUP BY 1,2),
su AS (SELECT old_id,count(DISTINCT new_id) s FROM pr GROUP BY 1), pd AS (SELECT new_id,count(DISTINCT old_id) p FROM pr GROUP BY 1),
cl AS (SELECT pr.old_id, pr.new_id, pr.shared, CASE WHEN pr.old_id=pr.new_id THEN 'identical' WHEN s>1 AND p>1 THEN 'split_and_merged' WHEN p>1 THEN 'merged' WHEN s>1 THEN 'split' ELSE 'renamed' END AS relation FROM pr JOIN su ON su.old_id=pr.old_id JOIN pd ON pd.new_id=pr.new_id
 UNION ALL SELECT DISTINCT sid, CAST(NULL AS VARCHAR), 0, 'dropped' FROM prv WHERE sid NOT IN (SELECT old_id FROM pr)
 UNION ALL SELECT DISTINCT CAST(NULL AS VARCHAR), sid, 0, 'new' FROM cur WHERE sid NOT IN (SELECT new_id FROM pr))"""


def year_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sheet, r, c, text): a year in the first month's row, with a footnote from 2000, and month words beside it."""
    axis = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("sheet"), F.year("l_shipdate").alias("y"), F.month("l_shipdate").alias("m")).distinct()
    r = (1 + (F.col("y") - 1995) * 12 + F.col("m")).cast("long").alias("r")
    year = F.when(F.col("m") == 1, F.concat(F.col("y").cast("string"), F.when(F.col("y") >= 2000, " (*)").otherwise("")))
    month = F.expr("substr('eneFebMARabrmayjun', (m - 1) * 3 + 1, 3)")
    return axis.select("sheet", r, F.lit(1).cast("long").alias("c"), year.alias("text")).unionByName(axis.filter("m <= 6").select("sheet", r, F.lit(2).cast("long").alias("c"), month.alias("text")))


F5 = """
axis AS (SELECT DISTINCT l_returnflag AS sheet, year(l_shipdate) AS y, month(l_shipdate) AS m FROM lineitem),
grid AS (SELECT sheet, CAST(1+(y-1995)*12+m AS BIGINT) AS r, CAST(1 AS BIGINT) AS c, CASE WHEN m=1 THEN CAST(y AS VARCHAR(6))||CASE WHEN y>=2000 THEN ' (*)' ELSE '' END END AS text FROM axis
 UNION ALL SELECT sheet, CAST(1+(y-1995)*12+m AS BIGINT), CAST(2 AS BIGINT), substr('eneFebMARabrmayjun',CAST((m-1)*3+1 AS INT),3) FROM axis WHERE m<=6),
yr AS (SELECT sheet,r, try_cast(regexp_extract(text,'^((19|20)[0-9]{2})',1) AS INT) AS y0 FROM grid WHERE c=1),
ff AS (SELECT sheet,r, last_value(y0 IGNORE NULLS) OVER (PARTITION BY sheet ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS y FROM yr)"""


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An entity panel: date x entity x currency x padded item -> amount."""
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    keys = [F.col("c_nationkey").cast("string").alias("codigo_entidad"), F.col("o_orderstatus").alias("codigo_moneda"), F.last_day(F.to_date("o_orderdate")).alias("fecha"), F.concat(F.lit("  "), F.upper("o_orderpriority"), F.lit(" ")).alias("sub_rubro")]
    return o.groupBy(*keys).agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("importe"))


F6 = """
panel AS (SELECT CAST(c_nationkey AS VARCHAR) AS codigo_entidad, o_orderstatus AS codigo_moneda, last_day(CAST(o_orderdate AS DATE)) AS fecha, '  '||upper(o_orderpriority)||' ' AS sub_rubro,
 CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS importe FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1,2,3,4)"""


def summed_once(rows: DataFrame, name: str) -> DataFrame:
    """rows with the sums of v by all their other columns, written once: the parts of a sheet then read these instead of the table.

    Distinct rows of the other columns and sums of v, which are decimal, stay what they are.
    """
    return saved(rows.groupBy(*(c for c in rows.columns if c != "v")).agg(F.sum("v").alias("v")), name)


def worksheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four layouts of one table as worksheets: years across (HY), years across and months down (YM_flag), a merged
    year header over quarters (YQ), and dates down (VD)."""
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("f"), F.year("l_shipdate").alias("y"), F.month("l_shipdate").alias("m"), F.quarter("l_shipdate").alias("q"), F.col("l_linenumber").cast("long").alias("ln"), F.col("l_quantity").cast("decimal(18,2)").alias("v")
    )
    li = summed_once(li, "worksheet-lines")
    place = F.when(F.col("f") == "A", 0).when(F.col("f") == "N", 1).otherwise(2).cast("long")
    words = F.element_at(F.array(*(F.lit(w) for w in "Ene Feb Mar Abr May Jun Jul Ago Set Oct Nov Dic".split())), F.col("m"))
    roman = F.element_at(F.array(*(F.lit(w) for w in ("I", "II", "III", "IV"))), F.col("q"))
    year, none = F.col("y").cast("string"), F.lit(None)

    def part(rows, sheet, r, c, text=none, num=none, day=none):
        return rows.select(F.lit(sheet).alias("source_sheet") if isinstance(sheet, str) else sheet.alias("source_sheet"), r.cast("long").alias("row_id"), c.cast("long").alias("column_id"), text.cast("string").alias("text"), num.cast("double").alias("num"), day.cast("date").alias("date")).distinct()

    def summed(*by):
        return li.groupBy(*by).agg(F.sum("v").alias("v"))

    at = F.col("y") - 1993
    ym = F.concat(F.lit("YM_"), "f")
    wide = 2 + (F.col("y") - 1995) * 4 + F.col("q") - 1
    month_row = 3 + (F.col("y") - 1995) * 12 + F.col("m") - 1
    parts = [
        part(li, "HY", F.lit(1), F.lit(1), F.lit("Quantity by flag")), part(li, "HY", F.lit(3), at, year), part(li, "HY", 4 + place, F.lit(1), F.col("f")),
        part(summed("f", "y"), "HY", 4 + place, at, num=F.col("v")),
        part(li, ym, F.lit(1), F.lit(1), F.concat(F.lit("Quantity of "), "f")), part(li, ym, F.lit(2), at, year), part(li, ym, 2 + F.col("m"), F.lit(1), words), part(summed("f", "y", "m"), ym, 2 + F.col("m"), at, num=F.col("v")),
        part(li.filter("q = 1"), "YQ", F.lit(2), wide, year), part(li, "YQ", F.lit(3), wide, roman), part(li, "YQ", 4 + place, F.lit(1), F.col("f")), part(summed("f", "y", "q"), "YQ", 4 + place, wide, num=F.col("v")),
        part(li, "VD", F.lit(2), 1 + F.col("ln"), F.concat(F.lit("Line "), F.col("ln").cast("string"))), part(li, "VD", month_row, F.lit(1), day=F.make_date("y", "m", F.lit(1))), part(summed("y", "m", "ln"), "VD", month_row, 1 + F.col("ln"), num=F.col("v")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


#: What reading the worksheets must give, straight from the table.
F7 = """
q AS (SELECT l_returnflag AS f, year(l_shipdate) AS y, month(l_shipdate) AS m, quarter(l_shipdate) AS q, l_linenumber AS ln, CAST(l_quantity AS DECIMAL(18,2)) AS v FROM lineitem),
read AS (
 SELECT 'HY' AS source_sheet, f AS series, make_date(y,12,31) AS period, CAST(sum(v) AS DOUBLE) AS value FROM q GROUP BY f, y
 UNION ALL SELECT 'YM_'||f, 'YM_'||f, last_day(make_date(y,m,1)), CAST(sum(v) AS DOUBLE) FROM q GROUP BY f, y, m
 UNION ALL SELECT 'YQ', f, last_day(make_date(y,q*3,1)), CAST(sum(v) AS DOUBLE) FROM q GROUP BY f, y, q
 UNION ALL SELECT 'VD', 'Line '||CAST(ln AS VARCHAR), last_day(make_date(y,m,1)), CAST(sum(v) AS DOUBLE) FROM q GROUP BY ln, y, m)"""
