"""Queries of single sources' layouts: what is read from their worksheets equals the table that they were laid out from."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import grid as G
from ..operators import layouts as L
from ..sources import derived as D
from ..sources import special as S
from ..sources.stored import saved


def _read(layout, source, *more):
    return lambda s, d: layout(saved(source(s, d), "sheets"), *more).select(*G.OUT[:4])


_LI = "li AS (SELECT l_returnflag AS f, l_linestatus AS st, year(l_shipdate) AS y, month(l_shipdate) AS m, quarter(l_shipdate) AS q, CAST(l_shipdate AS DATE) AS day, last_day(CAST(l_shipdate AS DATE)) AS me, l_linenumber AS ln, l_suppkey%2 AS side, CAST(l_quantity AS DECIMAL(18,2)) AS v FROM lineitem)"
_V = "CAST(sum(v) AS DOUBLE) AS value"
_AN = f"an AS (SELECT 'AN_'||st AS source_sheet, f AS series, me AS period, {_V} FROM li GROUP BY 1,2,3)"


def h18(s, d):
    cells = saved(S.houses(s, d), "sheets")
    entities = D.table(s, d, "nation").filter("n_nationkey <> 3").select(F.col("n_name").alias("name"), F.col("n_nationkey").cast("long").alias("entity_id"))
    return L.entity_panel(cells, entities).select("source_sheet", "item", "entity", "entity_id", "period", "value")


def h21(s, d):
    return L.mixed_rows(saved(S.operations(s, d), "sheets"), 4).select("source_sheet", "series", "frequency", "period", "value")


def h27(s, d):
    return L.last_survey_quarter(L.survey(saved(S.credit(s, d), "sheets")))


def _two(s, d):
    """The sheets of two sources, read by the layout of the first alone."""
    cells = saved(S.confidence(s, d).unionByName(S.credit(s, d)), "sheets")
    return cells, L.anchored(cells, "periodo")


def h25(s, d):
    return L.sheet_catalogue(*_two(s, d)).select("source_sheet", "n_numbers", "n_observations", "n_series", "first_period", "last_period", "parse_status")


def h26(s, d):
    cells, rows = _two(s, d)
    contract = cells.select("source_sheet").distinct().select("source_sheet", F.lit(5).alias("least_observations"), F.when(F.col("source_sheet") == "AN_O", "2100-01-01").otherwise("1900-01-01").cast("date").alias("earliest"))
    return L.contract_problems(L.sheet_catalogue(cells, rows), contract.unionByName(s.createDataFrame([("AN_X", 1)], "source_sheet string, least_observations int").withColumn("earliest", F.lit("1900-01-01").cast("date"))))


def h28(s, d):
    cells = saved(S.confidence(s, d), "sheets")
    expected = cells.select("source_sheet").distinct().withColumn("tokens", F.when(F.col("source_sheet") == "AN_F", F.array(*(F.lit(x) for x in ("periodo", "a", "n", "r")))).otherwise(F.array(*(F.lit(x) for x in ("periodo", "a", "r")))))
    return L.structure(cells, 7, expected)


def h10(s, d):
    """Every sheet by its layout, and the sheets that none reads under 'unread' with their count of numbers."""
    cells = saved(S.plain(s, d), "sheets")
    rows = saved(G.observations(cells), "observations")
    lost = L.unread(cells, rows).select("source_sheet", F.lit("unread").alias("series"), F.lit(None).cast("date").alias("period"), F.col("n_numbers").cast("double").alias("value"))
    return rows.select(*G.OUT[:4]).unionByName(lost)


_Q = {
    "H11_row_events": (lambda s, d: L.row_events(saved(S.events(s, d), "sheets")), "WITH l AS (SELECT 'RE_'||l_returnflag||'_'||strftime(l_shipdate,'%Y%m') AS source_sheet, 'Mercado '||l_linestatus AS state, CAST(l_shipdate AS DATE) AS day, 'P'||l_suppkey AS participant, CAST(l_quantity AS DOUBLE) AS a, CAST(l_extendedprice AS DOUBLE) AS b, row_number() OVER (PARTITION BY l_returnflag, l_linestatus, CAST(l_shipdate AS DATE), l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice) AS ordinal FROM lineitem) SELECT source_sheet, state, day, participant, 'cantidad' AS measure, a AS value, ordinal FROM l UNION ALL SELECT source_sheet, state, day, participant, 'precio', b, ordinal FROM l"),
    "H15_component_blocks": (lambda s, d: L.component_blocks(saved(S.sales(s, d), "sheets")), f"WITH {_LI} SELECT 'CV_'||f AS source_sheet, me AS period, CAST(sum(v) AS DOUBLE) + CASE WHEN month(me)%3=0 THEN 1 ELSE 0 END AS total, CAST(sum(v) AS DOUBLE) AS components, month(me)%3<>0 AS holds FROM li GROUP BY f, me"),
    "H24_participants": (lambda s, d: L.participants(S.payments(s, d), "P[0-9]{8}"), "SELECT 'P'||lpad(CAST(s_suppkey AS VARCHAR),8,'0') AS code FROM supplier WHERE s_suppkey%4<>0"),
    "H10_layouts_and_unread": (h10, f"WITH {_LI} SELECT 'HD' AS source_sheet, 'Row '||f AS series, me AS period, {_V} FROM li GROUP BY f, me UNION ALL SELECT 'VY', 'Column '||f, make_date(y,12,31), CAST(sum(v) AS DOUBLE) FROM li GROUP BY f, y UNION ALL SELECT 'VB', 'Block '||f, me, CAST(sum(v) AS DOUBLE) FROM li GROUP BY f, me UNION ALL SELECT 'ZZ', 'unread', NULL, CAST(count(*) AS DOUBLE) FROM (SELECT DISTINCT f, ln FROM li)"),
    "H12_fiscal_years": (_read(L.fiscal_years, S.fiscal), f"WITH {_LI} SELECT 'FY_'||f AS source_sheet, CASE WHEN ln<4 THEN 'Activos' ELSE 'Pasivos' END || ' — Line ' || ln AS series, make_date(y + CASE WHEN m>6 THEN 1 ELSE 0 END, 6, 30) AS period, {_V} FROM li GROUP BY 1,2,3"),
    "H13_daily_quotes": (_read(L.daily_quotes, S.quotes), f"WITH {_LI} SELECT 'DQ_'||f AS source_sheet, CASE WHEN st='F' THEN 'USD' ELSE 'BRL' END || CASE WHEN side=0 THEN ' compra' ELSE ' venta' END AS series, day AS period, CAST(sum(v)+100 AS DOUBLE) AS value FROM li GROUP BY 1,2,3"),
    "H14_year_blocks": (_read(L.year_blocks, S.histories), f"WITH {_LI} SELECT 'YB_'||f AS source_sheet, CASE WHEN side=0 THEN 'compra' ELSE 'venta' END AS series, me AS period, {_V} FROM li GROUP BY 1,2,3"),
    "H16_turnover": (lambda s, d: L.turnover(saved(S.turnovers(s, d), "sheets")).select("source_sheet", "series", "kind", "period", "value"), f"WITH {_LI} SELECT 'FT_'||f AS source_sheet, 'Mercado '||st||' — '||CASE WHEN grouping(ln)=1 THEN 'Total' ELSE 'Line '||ln END||CASE WHEN side=0 THEN ' — Compra' ELSE ' — Venta' END AS series, CASE WHEN grouping(ln)=1 THEN 'total' ELSE 'detail' END AS kind, make_date(y,12,31) AS period, {_V} FROM li GROUP BY GROUPING SETS ((f,st,ln,y,side),(f,st,y,side))"),
    "H17_survey": (_read(L.survey, S.credit), f"WITH {_LI} SELECT 'CS_'||st AS source_sheet, 'Pregunta '||f||' — Respuesta '||ln AS series, last_day(make_date(y, q*3, 1)) AS period, {_V} FROM li GROUP BY 1,2,3"),
    "H18_entity_panel": (h18, f"WITH r AS (SELECT 'EP_'||l_linestatus AS source_sheet, 'Rubro '||l_returnflag AS item, n_name, n_nationkey, last_day(CAST(l_shipdate AS DATE)) AS period, CAST(l_quantity AS DECIMAL(18,2)) AS v FROM lineitem JOIN supplier ON l_suppkey=s_suppkey JOIN nation ON s_nationkey=n_nationkey) SELECT source_sheet, item, lower(n_name) AS entity, CAST(CASE WHEN n_nationkey<>3 THEN n_nationkey END AS BIGINT) AS entity_id, period, {_V} FROM r GROUP BY 1,2,3,4,5"),
    "H19_anchored": (_read(L.anchored, S.confidence, "periodo"), f"WITH {_LI}, {_AN} SELECT * FROM an"),
    "H20_variable_blocks": (_read(L.variable_blocks, S.expectations, "descartados"), f"WITH {_LI} SELECT 'EV_'||st AS source_sheet, 'Bloque '||f||' — Variable '||ln AS series, me AS period, {_V} FROM li WHERE ln<>7 GROUP BY 1,2,3"),
    "H21_mixed_rows": (h21, f"WITH {_LI}, g AS (SELECT f, st, y, q, m, grouping(q) AS nq, grouping(m) AS nm, {_V} FROM li GROUP BY GROUPING SETS ((f,st,y),(f,st,y,q),(f,st,y,q,m))) SELECT 'FX' AS source_sheet, 'Sector '||f||' — Operacion '||st AS series, CASE WHEN nq=1 THEN 'annual' WHEN nm=1 THEN 'quarterly' ELSE 'monthly' END AS frequency, last_day(make_date(y, CASE WHEN nq=1 THEN 12 WHEN nm=1 THEN q*3 ELSE m END, 1)) AS period, value FROM g"),
    "H25_sheet_catalogue": (h25, f"WITH {_LI}, {_AN}, cs AS (SELECT DISTINCT 'CS_'||st AS source_sheet, f, ln, y, q FROM li) SELECT source_sheet, count(*) AS n_numbers, count(*) AS n_observations, count(DISTINCT series) AS n_series, min(period) AS first_period, max(period) AS last_period, 'read' AS parse_status FROM an GROUP BY 1 UNION ALL SELECT source_sheet, count(*), 0, 0, NULL, NULL, 'unread' FROM cs GROUP BY 1"),
    "H26_contract": (h26, f"WITH {_LI} SELECT 'AN_X' AS source_sheet, 'missing' AS problem UNION ALL SELECT DISTINCT 'AN_O', 'implausible date' FROM li WHERE st='O' UNION ALL SELECT DISTINCT 'CS_'||st, 'too few' FROM li"),
    "H27_publication_quarter": (h27, f"WITH {_LI} SELECT 'CS_'||st AS source_sheet, max(last_day(make_date(y, q*3, 1))) AS publication_quarter FROM li GROUP BY 1"),
    "H28_structure": (h28, f"WITH {_LI}, x AS (SELECT st, 'periodo|'||string_agg(DISTINCT lower(f), '|' ORDER BY lower(f)) AS observed FROM li GROUP BY 1), y AS (SELECT 'AN_'||st AS source_sheet, observed, CASE WHEN st='F' THEN 'periodo|a|n|r' ELSE 'periodo|a|r' END AS expected FROM x) SELECT *, observed=expected AS agrees FROM y"),
}


def queries():
    return {k: v[0] for k, v in _Q.items()}


def oracle_sql():
    return {k: v[1] for k, v in _Q.items()}
