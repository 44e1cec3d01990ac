"""Queries of the grid normaliser: what is read from worksheets equals the table that they were laid out from."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import grid as G
from ..sources import derived as D
from ..sources.derived import F2, F7
from ..sources.stored import saved


def _sheets(s, d):
    return saved(D.worksheets(s, d), "worksheets")


_Q = {
    "H02_consecutive_years": (lambda s, d: G.consecutive_years(_sheets(s, d)), f"WITH {F7}, n AS (SELECT count(DISTINCT y) AS n FROM q) SELECT s AS source_sheet, CAST(r AS BIGINT) AS row_id, n FROM n, (VALUES ('HY',3),('YM_A',2),('YM_N',2),('YM_R',2)) AS x(s,r) WHERE s='HY' OR EXISTS (SELECT 1 FROM q WHERE 'YM_'||f=s)  AND n = (SELECT count(DISTINCT y) FROM q WHERE 'YM_'||f=s) UNION ALL SELECT 'YQ', CAST(2 AS BIGINT), count(DISTINCT y) FROM q WHERE q=1"),
    "H03_layouts": (lambda s, d: G.layouts(_sheets(s, d)), f"WITH {F7} SELECT DISTINCT source_sheet, CASE source_sheet WHEN 'HY' THEN 'horizontal_year' WHEN 'YQ' THEN 'horizontal_year_quarter' WHEN 'VD' THEN 'vertical_date' ELSE 'horizontal_year_month' END AS mode FROM read"),
    "H04_titles": (lambda s, d: G.titles(_sheets(s, d)), f"WITH {F7} SELECT 'HY' AS source_sheet, 'Quantity by flag' AS title UNION ALL SELECT DISTINCT 'YM_'||f, 'Quantity of '||f FROM q UNION ALL SELECT 'VD', string_agg('Line '||ln, ' — ' ORDER BY ln) FROM (SELECT DISTINCT ln FROM q)"),
    "H05_vertical_date": (lambda s, d: G.read_as(_sheets(s, d), "vertical_date").select(*G.OUT[:4]), f"WITH {F7} SELECT * FROM read WHERE source_sheet='VD'"),
    "H06_horizontal_year": (lambda s, d: G.read_as(_sheets(s, d), "horizontal_year").select(*G.OUT[:4]), f"WITH {F7} SELECT * FROM read WHERE source_sheet='HY'"),
    "H08_year_quarter": (lambda s, d: G.read_as(_sheets(s, d), "horizontal_year_quarter").select(*G.OUT[:4]), f"WITH {F7} SELECT * FROM read WHERE source_sheet='YQ'"),
    "H09_year_month": (lambda s, d: G.read_as(_sheets(s, d), "horizontal_year_month").select(*G.OUT[:4]), f"WITH {F7} SELECT * FROM read WHERE source_sheet LIKE 'YM%'"),
    "H10_all_sheets": (lambda s, d: G.observations(_sheets(s, d)).select(*G.OUT[:4]), f"WITH {F7} SELECT * FROM read"),
    "H23_series_identity": (
        lambda s, d: G.identified(G.observations(_sheets(s, d))).groupBy("source_sheet", "series", "series_id", "stability").agg(F.count("*").alias("n")),
        f"WITH {F7} SELECT source_sheet, series, 'series:' || substr(sha256(source_sheet || '|' || series || '|0'),1,24) AS series_id, 'stable' AS stability, count(*) AS n FROM read GROUP BY 1,2",
    ),
    "A09_sheet_versions": (
        lambda s, d: G.version_ids(D.grid(s, d).select("source_sheet", "row_id", "column_id", F.col("tok").alias("text"), "num", F.col("period").alias("date"))),
        f"WITH {F2}, r AS (SELECT source_sheet, row_id, count(*) AS n, sha256(string_agg(row_id||'|'||column_id||'|'||coalesce(tok,'')||'|'||coalesce(CAST(CAST(num AS DECIMAL(38,6)) AS VARCHAR),'')||'|'||strftime(period,'%Y-%m-%d'), ';' ORDER BY column_id)) AS e FROM cells GROUP BY 1,2), b AS (SELECT source_sheet, row_id // 1024 AS k, sum(n) AS n, sha256(string_agg(e, ';' ORDER BY row_id)) AS e FROM r GROUP BY 1,2) SELECT source_sheet, substr(sha256(string_agg(e, ';' ORDER BY k)),1,24) AS sheet_version_id, CAST(sum(n) AS BIGINT) AS n_cells FROM b GROUP BY 1",
    ),
}


def queries():
    return {k: v[0] for k, v in _Q.items()}


def oracle_sql():
    return {k: v[1] for k, v in _Q.items()}
