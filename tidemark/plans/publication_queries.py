"""Queries of published shapes, with the SQL they equal."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import publication as B
from ..operators import vintage as V
from ..sources import derived as D
from ..sources.derived import F1, F2
from .accounting_queries import _grid
from .governance_queries import _mapped


def o07(s, d):
    snaps = D.snapshots(s, d)
    return B.store_difference(snaps.filter("vintage_id = 'v1'"), snaps.filter("vintage_id = 'v2'"), ["series_id", "period"])


def c16(s, d):
    brands = D.table(s, d, "part").select(F.split_part("p_type", F.lit(" "), F.lit(1)).alias("code")).distinct()
    return B.only_substring(D.table(s, d, "part"), "p_type", brands, "code")


def n27(s, d):
    obs = _grid(s, d)[1]
    measured = obs.groupBy("source_sheet").agg(F.countDistinct("series_id").alias("measured"))
    notes = measured.select("source_sheet", F.concat(F.lit("holds "), (F.col("measured") + F.when(F.col("source_sheet") == "AF", 1).otherwise(0)).cast("string"), F.lit(" series in all")).alias("note"))
    return B.claims(notes, measured, "source_sheet")


_Q = {
    "A11_cell_inventory": (lambda s, d: B.inventory(D.vintages(s).select("vintage_id").crossJoin(F.broadcast(D.grid(s, d).select(F.col("source_sheet").alias("sheet_version_id")).distinct())).filter("vintage_id > 'v2'"), D.grid(s, d).select(F.col("source_sheet").alias("sheet_version_id"), "row_id", "column_id", "num")).groupBy("vintage_id", "sheet_version_id").agg(F.count("*").alias("n_cells"), F.count("num").alias("n_numbers")), f"WITH {F2} SELECT v AS vintage_id, source_sheet AS sheet_version_id, count(*) AS n_cells, count(num) AS n_numbers FROM cells, (VALUES ('v3'),('v4')) AS x(v) GROUP BY 1,2"),
    "A12_a1_coordinates": (lambda s, d: B.coordinates(D.grid(s, d), s.createDataFrame([("AF", 5, 3), ("NO", 1, 700)], "source_sheet string, first_row long, first_column long")), f"WITH {F2}, letters AS (SELECT chr(CAST(64+i AS INT)) AS x FROM range(1,27) t(i)), names AS (SELECT name, row_number() OVER (ORDER BY length(name), name) AS k FROM (SELECT x AS name FROM letters UNION ALL SELECT a.x||b.x FROM letters a, letters b UNION ALL SELECT a.x||b.x||c.x FROM letters a, letters b, letters c)), p AS (SELECT c.source_sheet, row_id, column_id, coalesce(fr,1)-1+row_id AS r, coalesce(fc,1)-1+column_id AS k FROM cells c LEFT JOIN (VALUES ('AF',5,3),('NO',1,700)) AS o(s,fr,fc) ON o.s=c.source_sheet) SELECT source_sheet, row_id, column_id, name || CAST(r AS VARCHAR) AS a1 FROM p JOIN names USING (k)"),
    "C16_only_substring": (c16, "WITH c AS (SELECT DISTINCT split_part(p_type,' ',1) AS code FROM part), t AS (SELECT DISTINCT p_type FROM part) SELECT p_type, count(code) AS n_hits, CASE WHEN count(code)=1 THEN max(code) END AS code FROM t LEFT JOIN c ON contains(p_type, code) GROUP BY 1"),
    "E06_ordinals": (lambda s, d: B.running_number(D.table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"), ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_extendedprice"]), "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_extendedprice) AS ordinal FROM lineitem"),
    "I04_newest_snapshot": (lambda s, d: B.newest_snapshot(D.snapshots(s, d), D.accepted(s)), f"WITH {F1} SELECT * FROM snap WHERE vintage_id='v3'"),
    "J13_availability": (lambda s, d: V.availability(D.snapshots(s, d).select("vintage_id", F.when(F.col("vintage_id") != "v2", F.col("publication_date")).alias("publication_date")).distinct().withColumn("ingested_on", F.lit("2002-01-01").cast("date")), D.vintages(s).filter("vintage_id = 'v1'").select("vintage_id", F.col("horizon").alias("provenance_date"))), f"WITH {F1} SELECT DISTINCT vintage_id, CASE vintage_id WHEN 'v1' THEN DATE '1999-01-01' WHEN 'v2' THEN DATE '2002-01-01' ELSE publication_date END AS available_at, CASE vintage_id WHEN 'v1' THEN 'complete' WHEN 'v2' THEN 'ingestion_only' ELSE 'published_only' END AS completeness FROM snap"),
    "J17_snapshot_catalogue": (lambda s, d: V.catalogue(B.newest_snapshot(D.snapshots(s, d), D.accepted(s))), f"WITH {F1} SELECT series_id, count(*) AS n_observations, min(period) AS first_period, max(period) AS last_period, max(publication_date) AS last_publication FROM snap WHERE vintage_id='v3' GROUP BY 1"),
    "M10_table_status": (lambda s, d: B.table_status(D.grid(s, d), s.createDataFrame([("AF", "validated", "checked"), ("NO", "validated", None)], "source_sheet string, status string, evidence string")), f"WITH {F2} SELECT DISTINCT source_sheet, CASE source_sheet WHEN 'AF' THEN 'validated' WHEN 'NO' THEN 'draft' ELSE 'unreviewed' END AS status FROM cells"),
    "M17_comparability": (lambda s, d: B.comparability(_mapped(s, d)), f"WITH {F1}, m AS (SELECT DISTINCT series_id, split_part(series_id,':',3) AS concept_id, CASE WHEN series_id LIKE '%1-URGENT:F' THEN 'pyg' ELSE 'usd' END AS unit FROM realised) SELECT concept_id, count(*) AS n_members, count(DISTINCT unit) AS n_units, CASE WHEN count(DISTINCT unit)>1 THEN 'mixed_units' WHEN count(*)=1 THEN 'vacuous' END AS problem FROM m GROUP BY 1"),
    "N15_incomplete_fields": (lambda s, d: B.incomplete(D.table(s, d, "part").select("p_partkey", F.nullif("p_type", F.lit("PROMO")).alias("p_type"), F.nullif("p_size", F.lit(1)).alias("p_size")), ["p_type", "p_size"], "p_partkey"), "SELECT p_partkey, 'p_type' AS field FROM part WHERE p_type='PROMO' UNION ALL SELECT p_partkey, 'p_size' FROM part WHERE p_size=1"),
    "N27_claimed_counts": (n27, f"WITH {F2} SELECT source_sheet, count(DISTINCT series_id) + CASE WHEN source_sheet='AF' THEN 1 ELSE 0 END AS claimed, count(DISTINCT series_id) AS measured, source_sheet<>'AF' AS agrees FROM obs GROUP BY 1"),
    "O07_store_difference": (o07, f"WITH {F1}, a AS (SELECT series_id, period, value FROM snap WHERE vintage_id='v1'), b AS (SELECT series_id, period, value FROM snap WHERE vintage_id='v2') SELECT coalesce(a.series_id,b.series_id) AS series_id, coalesce(a.period,b.period) AS period, a.value AS old, b.value AS new, CASE WHEN b.series_id IS NULL THEN 'lost' WHEN a.series_id IS NULL THEN 'recovered' ELSE 'changed' END AS kind FROM a FULL JOIN b ON a.series_id=b.series_id AND a.period=b.period WHERE a.series_id IS NULL OR b.series_id IS NULL OR a.value<>b.value"),
}


def queries():
    return {k: v[0] for k, v in _Q.items()}


def oracle_sql():
    return {k: v[1] for k, v in _Q.items()}
