"""Queries over cell grids, delimited files and identifier releases, with the SQL they equal."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import periods as P
from ..functions import text as T
from ..operators import accounting as A
from ..operators import identity as I
from ..operators import quality
from ..sources import derived as D
from ..sources.derived import F2, F3, F4, F5, F6

CELL = ("source_sheet", "row_id", "column_id")
CLASSED = """un AS (SELECT c.* FROM cells c WHERE num IS NOT NULL AND NOT EXISTS (SELECT 1 FROM obs o WHERE o.source_sheet=c.source_sheet AND o.source_row=c.row_id AND o.source_column=c.column_id)),
cc AS (SELECT u.source_sheet, u.row_id, u.column_id, r.rule_id, r.classification, row_number() OVER (PARTITION BY u.source_sheet, u.row_id, u.column_id ORDER BY CASE WHEN r.source_sheet='*' THEN 1 ELSE 0 END, (row_to-row_from+1)*(column_to-column_from+1), r.rule_id) AS k
 FROM un u LEFT JOIN rules r ON (r.source_sheet=u.source_sheet OR r.source_sheet='*') AND u.row_id BETWEEN row_from AND row_to AND u.column_id BETWEEN column_from AND column_to),
classed AS (SELECT source_sheet, row_id, column_id, rule_id, coalesce(classification,'unclassified') AS classification FROM cc WHERE k=1)"""
_MEANINGS = [("s/m", "*", "not meaningful"), ("s/m", "AF", "suppressed"), ("", "*", "blank")]


def _grid(s, d):
    cells = D.grid(s, d)
    return cells, D.grid_observations(cells)


def _expected(obs):
    spans = obs.groupBy("series_id").agg(F.min("period").alias("a"), F.max("period").alias("b"), F.count("*").alias("n")).filter("n > 1")
    return spans.select("series_id", F.explode(P.expected(F.col("a"), F.col("b"), 1)).alias("period"))


def l10(s, d):
    cells, obs = _grid(s, d)
    return A.missing(_expected(obs), obs, cells)


def c09(s, d):
    cells = D.grid(s, d).filter("tok is not null").select("source_sheet", "row_id", "column_id", "tok")
    return A.wildcard_join(cells, s.createDataFrame(_MEANINGS, "tok string, source_sheet string, meaning string"), "tok", ["meaning"])


def c08(s, d):
    cells, obs = _grid(s, d)
    lists = cells.select("source_sheet").distinct().withColumn("rows", F.when(F.col("source_sheet") == "AF", "3-9;20").otherwise("5;40-44"))
    return A.hidden(obs, A.spans(lists, "rows"))


def i03(s, d):
    return A.typed_trades(A.rejections(D.trades(s, d)))


def e08(s, d):
    """The year of every row, filled forward from the footnoted label of its first month."""
    rows = D.year_column(s, d).filter("c = 1").select("sheet", "r", T.year_label(F.col("text")).alias("y0"))
    fill = F.last("y0", ignorenulls=True).over(Window.partitionBy("sheet").orderBy("r").rowsBetween(Window.unboundedPreceding, 0))
    return rows.select("sheet", "r", fill.alias("y"))


def h07(s, d):
    """The vertical year block: filled year and month word give the period of each labelled row."""
    months = D.year_column(s, d).filter("c = 2").select("sheet", "r", T.month_number(F.col("text")).alias("m"))
    return e08(s, d).join(months, ["sheet", "r"]).select("sheet", "r", P.month_end(F.col("y"), F.col("m")).alias("period"))


def _entities(s, d):
    return D.table(s, d, "nation").select(F.col("n_nationkey").cast("string").alias("codigo_entidad"), F.col("n_name").alias("entity_name"))


def j18(s, d):
    """The documented panel: codes resolved to entities, items by normalised label."""
    rows = D.panel(s, d)
    items = rows.select(T.normalized(F.col("sub_rubro")).alias("item_key")).distinct()
    joined = rows.join(F.broadcast(_entities(s, d)), "codigo_entidad", "left").withColumn("item_key", T.normalized(F.col("sub_rubro"))).join(F.broadcast(items), "item_key")
    return joined.select("codigo_entidad", "entity_name", "codigo_moneda", "fecha", "item_key", "importe")


def n17(s, d):
    return quality.duplicate_keys(D.table(s, d, "lineitem").select("l_orderkey", "l_linenumber"), "l_orderkey", "l_linenumber")


_Q = {
    "A08_grid_cells": (lambda s, d: D.grid(s, d), f"WITH {F2} SELECT * FROM cells"),
    "B05_rectangle": (lambda s, d: A.rule_matches(A.unmapped(*_grid(s, d)), D.rules(s)).select(*CELL, "rule_id"), f"WITH {F2}, {CLASSED} SELECT source_sheet, row_id, column_id, rule_id FROM cc WHERE rule_id IS NOT NULL"),
    "C08_hidden_rows": (
        c08,
        f"WITH {F2} SELECT source_sheet, count(*) AS hidden_observations, count(DISTINCT source_row) AS hidden_rows FROM obs WHERE CASE WHEN source_sheet='AF' THEN source_row BETWEEN 3 AND 9 OR source_row=20 ELSE source_row=5 OR source_row BETWEEN 40 AND 44 END GROUP BY 1",
    ),
    "C09_wildcard_tokens": (c09, f"WITH {F2} SELECT source_sheet, row_id, column_id, tok, CASE WHEN tok='' THEN 'blank' WHEN source_sheet='AF' THEN 'suppressed' ELSE 'not meaningful' END AS meaning FROM cells WHERE tok IS NOT NULL"),
    "L01_unmapped_cells": (lambda s, d: A.unmapped(*_grid(s, d)).select(*CELL, "num"), f"WITH {F2}, {CLASSED} SELECT source_sheet, row_id, column_id, num FROM un"),
    "L02_classified_cells": (lambda s, d: A.classified(A.unmapped(*_grid(s, d)), D.rules(s)), f"WITH {F2}, {CLASSED} SELECT * FROM classed"),
    "L03_reconciliation": (
        lambda s, d: A.reconciliation(*_grid(s, d), D.rules(s)),
        f"""WITH {F2}, {CLASSED}, o AS (SELECT source_sheet, count(num) AS offered, count(*) FILTER (WHERE tok='s/m') AS tokens, count(*) FILTER (WHERE tok='') AS blanks FROM cells GROUP BY 1),
a AS (SELECT source_sheet, count(*) AS accepted FROM obs GROUP BY 1), k AS (SELECT source_sheet, count(*) FILTER (WHERE classification<>'unclassified') AS explained, count(*) FILTER (WHERE classification='unclassified') AS open, count(*) FILTER (WHERE classification='parser_defect') AS defects FROM classed GROUP BY 1)
SELECT o.*, coalesce(accepted,0) AS accepted, coalesce(explained,0) AS explained, coalesce(open,0) AS open, coalesce(defects,0) AS defects, CASE WHEN coalesce(open,0)>0 THEN 'unreconciled' WHEN coalesce(defects,0)>0 THEN 'defective' ELSE 'reconciled' END AS status FROM o LEFT JOIN a USING (source_sheet) LEFT JOIN k USING (source_sheet)""",
    ),
    "L03_unused_rules": (lambda s, d: A.unused_rules(A.unmapped(*_grid(s, d)), D.rules(s)), f"WITH {F2}, {CLASSED} SELECT rule_id FROM rules WHERE rule_id NOT IN (SELECT rule_id FROM cc WHERE rule_id IS NOT NULL)"),
    "L10_missing_periods": (
        l10,
        f"""WITH {F2}, sp AS (SELECT series_id, min(period) AS a, max(period) AS b FROM obs GROUP BY 1 HAVING count(*)>1), g AS (SELECT series_id, last_day(CAST(unnest(generate_series(date_trunc('month', a), date_trunc('month', b), INTERVAL 1 MONTH)) AS DATE)) AS period FROM sp),
w AS (SELECT series_id, min(source_sheet) AS source_sheet, min(source_column) AS column_id FROM obs GROUP BY 1), ax AS (SELECT DISTINCT source_sheet, period, row_id FROM cells)
SELECT g.series_id, g.period, CASE WHEN ax.row_id IS NULL THEN 'period_not_in_sheet' WHEN c.num IS NOT NULL THEN 'unread_cell' WHEN c.tok='s/m' THEN 'not_meaningful' WHEN c.tok='' THEN 'blank_cell' ELSE 'absent_cell' END AS reason
FROM g JOIN w USING (series_id) LEFT JOIN ax ON ax.source_sheet=w.source_sheet AND ax.period=g.period LEFT JOIN cells c ON c.source_sheet=w.source_sheet AND c.row_id=ax.row_id AND c.column_id=w.column_id
WHERE NOT EXISTS (SELECT 1 FROM obs o WHERE o.series_id=g.series_id AND o.period=g.period)""",
    ),
    "G20_packed_spans": (lambda s, d: A.packed(D.grid(s, d).filter("num is not null").withColumn("line", F.concat_ws(":", "source_sheet", "column_id")), "line", "row_id"), f"WITH {F2}, n AS (SELECT DISTINCT source_sheet||':'||column_id AS line, row_id FROM cells WHERE num IS NOT NULL), i AS (SELECT *, row_id - row_number() OVER (PARTITION BY line ORDER BY row_id) AS k FROM n) SELECT line, min(row_id) AS lo, max(row_id) AS hi FROM i GROUP BY line, k"),
    "I01_row_rejections": (lambda s, d: A.rejections(D.trades(s, d)).filter("reason is not null").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "reason"), f"WITH {F3} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, reason FROM cls WHERE reason IS NOT NULL"),
    "I03_trades": (
        i03,
        f"""WITH {F3}, b AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, dia, vol, instrumento, moneda, sha256(strftime(dia,'%Y-%m-%d')||'|'||coalesce(CAST(vol AS VARCHAR),'')||'|'||instrumento||'|'||moneda) AS basis FROM cls WHERE reason IS NULL)
SELECT *, row_number() OVER (PARTITION BY basis ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS ordinal, CASE WHEN vol IS NULL THEN 'not_reported' ELSE 'reported' END AS volume_status FROM b""",
    ),
    "I05_daily_activity": (lambda s, d: A.daily_activity(i03(s, d)), f"WITH {F3} SELECT dia, instrumento, moneda, count(*) AS n_trades, count(vol) AS n_with_volume, CAST(sum(vol) AS DOUBLE) AS volume FROM cls WHERE reason IS NULL GROUP BY 1,2,3"),
    "L04_row_reconciliation": (lambda s, d: A.row_reconciliation(A.rejections(D.trades(s, d))), f"WITH {F3} SELECT coalesce(reason,'accepted') AS outcome, count(*) AS n_rows, count(vol) AS n_with_volume FROM cls GROUP BY 1"),
    "M01_shared_cells": (lambda s, d: I.shared_cells(*D.releases(s, d), "sheet", "r", "c", "period"), f"WITH {F4} SELECT * FROM pr"),
    "M03_relations": (lambda s, d: I.relations(I.shared_cells(*D.releases(s, d), "sheet", "r", "c", "period")), f"WITH {F4} SELECT old_id, new_id, shared, relation FROM cl WHERE shared > 0"),
    "M04_migration": (lambda s, d: I.migration(*D.releases(s, d), "sheet", "r", "c", "period"), f"WITH {F4} SELECT old_id, new_id, CAST(shared AS BIGINT) AS shared, relation FROM cl"),
    "M06_resolution": (
        lambda s, d: I.resolution(I.migration(*D.releases(s, d), "sheet", "r", "c", "period")),
        f"WITH {F4} SELECT old_id, count(DISTINCT new_id) AS n_candidates, coalesce(string_agg(DISTINCT new_id, ';' ORDER BY new_id), '') AS candidates, CASE WHEN count(DISTINCT new_id)=1 THEN min(new_id) END AS resolved_id FROM cl WHERE old_id IS NOT NULL GROUP BY 1",
    ),
    "E08_fill_forward": (e08, f"WITH {F5} SELECT sheet, r, y FROM ff"),
    "H07_year_block": (h07, f"WITH {F5} SELECT ff.sheet, ff.r, last_day(make_date(y, CAST((ff.r - 1) % 12 + CASE WHEN (ff.r - 1) % 12 = 0 THEN 12 ELSE 0 END AS INT), 1)) AS period FROM ff JOIN grid g ON g.sheet=ff.sheet AND g.r=ff.r AND g.c=2"),
    "J18_documented_panel": (j18, f"WITH {F6} SELECT codigo_entidad, n_name AS entity_name, codigo_moneda, fecha, lower(trim(sub_rubro)) AS item_key, importe FROM panel LEFT JOIN nation ON CAST(n_nationkey AS VARCHAR)=codigo_entidad"),
    "B09_latest_snapshot": (
        lambda s, d: D.panel(s, d).withColumn("_k", F.dense_rank().over(Window.partitionBy("codigo_entidad").orderBy(F.col("fecha").desc()))).filter("_k = 1").drop("_k"),
        f"WITH {F6} SELECT codigo_entidad, codigo_moneda, fecha, sub_rubro, importe FROM (SELECT *, dense_rank() OVER (PARTITION BY codigo_entidad ORDER BY fecha DESC) AS k FROM panel) WHERE k=1",
    ),
    "N03_mapping_coverage": (
        lambda s, d: quality.coverage(D.panel(s, d).join(F.broadcast(_entities(s, d).filter("entity_name < 'N'")), "codigo_entidad", "left"), "codigo_moneda", "entity_name", 0.5),
        f"WITH {F6} SELECT codigo_moneda, count(*) AS n_rows, count(n_name) AS n_mapped, count(n_name) < count(*) * 0.5 AS below FROM panel LEFT JOIN (SELECT * FROM nation WHERE n_name < 'N') ON CAST(n_nationkey AS VARCHAR)=codigo_entidad GROUP BY 1",
    ),
    "N13_orphans": (lambda s, d: quality.orphans(D.table(s, d, "lineitem").select("l_orderkey"), D.table(s, d, "orders").filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey").groupBy("l_orderkey").agg(F.count("*").alias("n")), "SELECT l_orderkey, count(*) AS n FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey=l_orderkey AND o_orderstatus<>'P') GROUP BY 1"),
    "N17_duplicate_keys": (n17, "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1,2 HAVING count(*)>1"),
}


def queries():
    return {k: v[0] for k, v in _Q.items()}


def oracle_sql():
    return {k: v[1] for k, v in _Q.items()}
