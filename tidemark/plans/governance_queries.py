"""Queries of concepts, regions, contracts and gates, with the SQL they equal."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import accounting as A
from ..operators import governance as G
from ..operators import identity as I
from ..operators import quality as Q
from ..operators import semantics as S
from ..operators import vintage as V
from ..sources import derived as D
from ..sources.derived import F1, F2, F3, F4, F6
from .accounting_queries import _grid
from .relational_queries import _DERIVED, _L, labels
from .vintage_queries import _latest, _realised

REGIONS = [("AF", 1, 60, 3, 7), ("NO", 1, 100, 4, 9), ("RF", 10, 50, 3, 9)]


def _mapped(s, d):
    return _realised(s, d).select("series_id").distinct().select("series_id", F.split_part("series_id", F.lit(":"), F.lit(3)).alias("concept_id"), F.when(F.col("series_id").like("%1-URGENT:F"), "pyg").otherwise("usd").alias("unit"))


def _regions(s):
    return s.createDataFrame(REGIONS, "source_sheet string, row_from long, row_to long, column_from long, column_to long")


_OUT = "out AS (SELECT c.* FROM cells c WHERE NOT EXISTS (SELECT 1 FROM (VALUES ('AF',1,60,3,7),('NO',1,100,4,9),('RF',10,50,3,9)) AS r(s,a,b,x,y) WHERE r.s=c.source_sheet AND row_id BETWEEN a AND b AND column_id BETWEEN x AND y))"


def l13(s, d):
    cells, obs = _grid(s, d)
    spans = A.spans(cells.select("source_sheet").distinct().withColumn("rows", F.lit("5;40-44")), "rows")
    formulas = obs.filter("source_column = 9 and source_row % 4 = 0").select("source_sheet", "source_row", "source_column")
    return G.behaviour(obs, spans, formulas).groupBy("source_sheet", "from_hidden_row", "from_formula").agg(F.count("*").alias("n"))


def n01(s, d):
    """Months of line prices against quarters of order totals: published apart, so they differ by discounts and taxes."""
    o = D.table(s, d, "orders").select("o_orderkey", F.col("o_orderpriority").alias("series_id"), F.to_date("o_orderdate").alias("day"), F.col("o_totalprice").cast("decimal(18,2)").alias("v"))
    bucket = F.to_date(F.trunc("day", "quarter")).alias("bucket")
    lines = D.table(s, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_extendedprice").cast("decimal(18,2)").alias("p"))
    months = o.join(lines, "o_orderkey").groupBy("series_id", bucket, F.month("day").alias("m")).agg(F.sum("p").alias("value")).drop("m")
    return G.aggregates_hold(months, o.groupBy("series_id", bucket).agg(F.sum("v").alias("value")), 0.01, s.createDataFrame([("5-LOW",)], "series_id string"))


def n12(s, d):
    cells, obs = _grid(s, d)
    latest = _latest(s, d)
    return G.gate({
        "duplicate_observations": Q.duplicate_keys(obs, "series_id", "period"),
        "cell_reuse": Q.duplicate_keys(obs, "source_sheet", "source_row", "source_column"),
        "unaccepted_vintages": latest.join(F.broadcast(D.accepted(s)), "vintage_id", "left_anti"),
        "unreconciled_cells": A.classified(A.unmapped(cells, obs), D.rules(s)).filter("classification = 'unclassified'"),
    })


def n21(s, d):
    found = A.rejections(D.trades(s, d)).filter("reason is not null")
    return G.undeclared(found, s.createDataFrame([("invalid_date",), ("duplicate_row",)], "reason string"), "reason")


def n33(s, d):
    """Releases decided from the flags that the identities raise: the family's number of broken or incomplete periods."""
    found = Q.identities(D.snapshots(s, d).filter("vintage_id = 'v3'"), 0.01).filter("status <> 'holds'")
    flags = found.select(F.col("family").alias("release_id"), F.when(F.col("status") == "broken", "error").otherwise("warning").alias("severity"))
    releases = D.snapshots(s, d).select(F.split_part("series_id", F.lit(":"), F.lit(2)).alias("release_id")).distinct()
    return V.decide(flags, releases)


def j12(s, d):
    snaps = D.snapshots(s, d)
    content = snaps.groupBy("vintage_id").agg(F.max("period").alias("candidate")).withColumn("authority", F.lit(1))
    registry = snaps.select("vintage_id", F.col("publication_date").alias("candidate")).distinct().filter("vintage_id in ('v1', 'v3')").withColumn("authority", F.lit(3))
    return V.publication_dates(content.unionByName(registry))


_Q = {
    "A14_signed_accounts": (lambda s, d: G.signed_dimension(D.table(s, d, "customer").select("c_custkey", F.concat(F.when(F.col("c_acctbal") < 0, "-").otherwise(""), F.col("c_custkey").cast("string"), F.lit(".0")).alias("code")), "code"), "SELECT code, regexp_replace(code,'[^0-9]','','g') AS account, CASE WHEN code LIKE '-%' THEN -1 ELSE 1 END AS multiplier, 'account:' || substr(sha256(regexp_replace(code,'[^0-9]','','g')),1,24) AS account_id FROM (SELECT CASE WHEN c_acctbal<0 THEN '-' ELSE '' END || CAST(c_custkey AS VARCHAR) || '.0' AS code FROM customer)"),
    "A16_append_new": (lambda s, d: V.append_new(D.snapshots(s, d).filter("vintage_id <= 'v2'"), D.snapshots(s, d)).groupBy("vintage_id").agg(F.count("*").alias("n")), f"WITH {F1} SELECT vintage_id, count(*) AS n FROM snap WHERE vintage_id > 'v2' GROUP BY 1"),
    "A18_new_entities": (lambda s, d: G.new_entities(D.panel(s, d), D.table(s, d, "nation").filter("n_regionkey > 0").select(F.col("n_nationkey").cast("string").alias("codigo_entidad"), "n_name"), D.table(s, d, "nation").filter("n_regionkey = 2").select(F.col("n_nationkey").cast("string").alias("codigo_entidad")), "codigo_entidad"), f"WITH {F6}, n AS (SELECT CAST(n_nationkey AS VARCHAR) AS k, * FROM nation) SELECT DISTINCT codigo_entidad, CASE WHEN n_regionkey>0 THEN n_name END AS n_name FROM panel LEFT JOIN n ON k=codigo_entidad WHERE n_regionkey IS DISTINCT FROM 2"),
    "I02_unpivoted_measures": (lambda s, d: G.unpivoted(D.table(s, d, "lineitem").groupBy("l_suppkey").agg(F.min("l_discount").alias("low"), F.max("l_discount").alias("high"), F.max(F.when(F.col("l_tax") > 0.079, F.col("l_tax"))).alias("tax")), ["l_suppkey"], ["low", "high", "tax"]), "SELECT * FROM (SELECT l_suppkey, 'low' AS measure, min(l_discount) AS value FROM lineitem GROUP BY 1 UNION ALL SELECT l_suppkey, 'high', max(l_discount) FROM lineitem GROUP BY 1 UNION ALL SELECT l_suppkey, 'tax', max(l_tax) FILTER (WHERE l_tax>0.079) FROM lineitem GROUP BY 1) WHERE value IS NOT NULL"),
    "J12_publication_authority": (j12, f"WITH {F1} SELECT vintage_id, CASE WHEN vintage_id IN ('v1','v3') THEN max(publication_date) ELSE max(period) END AS publication_date, CASE WHEN vintage_id IN ('v1','v3') THEN 3 ELSE 1 END AS authority FROM snap GROUP BY vintage_id"),
    "K06_wording_review_worklist": (lambda s, d: S.derived(labels(s, d)).filter("stock_flow = 'not_reviewed'").groupBy("label").agg(F.count("*").alias("n_series"), F.min("series_id").alias("first_series")), f"WITH {_L}, v AS (SELECT {_DERIVED} FROM n) SELECT label, count(*) AS n_series, min(series_id) AS first_series FROM v WHERE stock_flow='not_reviewed' GROUP BY 1"),
    "K09_completeness": (lambda s, d: S.completeness(S.derived(labels(s, d)), ["unit", "scale_multiplier", "evidence"]), f"WITH {_L}, v AS (SELECT {_DERIVED} FROM n) SELECT 'unit' AS field, count(*) AS n_rows, count(unit) AS n_known FROM v UNION ALL SELECT 'scale_multiplier', count(*), count(scale_multiplier) FROM v UNION ALL SELECT 'evidence', count(*), count(evidence) FROM v"),
    "K10_series_grain": (
        lambda s, d: A.wildcard_join(_grid(s, d)[1].select("series_id", "source_sheet").distinct().withColumn("source_id", F.lit("li")), s.createDataFrame([("li", "*", "scalar_series"), ("li", "AF", "entity_panel")], "source_id string, source_sheet string, grain string"), "source_id", ["grain"]).select("series_id", "grain"),
        f"WITH {F2} SELECT DISTINCT series_id, CASE WHEN source_sheet='AF' THEN 'entity_panel' ELSE 'scalar_series' END AS grain FROM obs",
    ),
    "L05_outside_regions": (lambda s, d: G.outside(D.grid(s, d), _regions(s)).select("source_sheet", "row_id", "column_id", "num"), f"WITH {F2}, {_OUT} SELECT source_sheet, row_id, column_id, num FROM out"),
    "L06_region_completeness": (lambda s, d: G.region_completeness(D.grid(s, d), _regions(s)), f"WITH {F2}, {_OUT} SELECT c.source_sheet, n_cells, coalesce(n_outside,0) AS n_outside, coalesce(n_numbers_outside,0) AS n_numbers_outside FROM (SELECT source_sheet, count(*) AS n_cells FROM cells GROUP BY 1) c LEFT JOIN (SELECT source_sheet, count(*) AS n_outside, count(num) AS n_numbers_outside FROM out GROUP BY 1) o ON o.source_sheet=c.source_sheet"),
    "L13_observation_behaviour": (l13, f"WITH {F2} SELECT source_sheet, source_row=5 OR source_row BETWEEN 40 AND 44 AS from_hidden_row, source_column=9 AND source_row%4=0 AS from_formula, count(*) AS n FROM obs GROUP BY 1,2,3"),
    "M02_curated_pairs": (
        lambda s, d: I.curated_pairs(*(r.select("sid", F.concat("sheet", F.lit(" "), F.col("c").cast("string")).alias("label"), F.when(F.col("c") > 4, "monthly").alias("frequency")).distinct() for r in D.releases(s, d))),
        f"WITH {F4} SELECT DISTINCT p.sid AS old_id, n.sid AS new_id FROM prv p JOIN cur n ON p.sheet=n.sheet AND p.c=n.c",
    ),
    "M07_own_concepts": (lambda s, d: G.own_concepts(_realised(s, d), _mapped(s, d).filter("concept_id = 'F'").select("series_id")), f"WITH {F1} SELECT DISTINCT series_id, 'concept:' || substr(sha256(series_id),1,24) AS concept_id FROM realised WHERE series_id NOT LIKE '%:F'"),
    "M08_concept_agreement": (lambda s, d: G.agreed_concepts(_mapped(s, d), "unit"), f"WITH {F1}, m AS (SELECT DISTINCT series_id, split_part(series_id,':',3) AS concept_id, CASE WHEN series_id LIKE '%1-URGENT:F' THEN 'pyg' ELSE 'usd' END AS unit FROM realised) SELECT concept_id, count(*) AS n_series, count(DISTINCT unit)=1 AS agrees FROM m GROUP BY 1"),
    "M09_latest_by_concept": (lambda s, d: G.latest_by_concept(_realised(s, d), _mapped(s, d).select("series_id", "concept_id")), f"WITH {F1} SELECT split_part(series_id,':',3) AS concept_id, max(period) AS last_period, count(DISTINCT series_id) AS n_series, count(*) AS n_observations FROM realised GROUP BY 1"),
    "N01_aggregates_hold": (n01, "WITH o AS (SELECT o_orderkey, o_orderpriority AS series_id, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS bucket, month(o_orderdate) AS m, CAST(o_totalprice AS DECIMAL(18,2)) AS v FROM orders), w AS (SELECT series_id, bucket, sum(v) AS w FROM o GROUP BY 1,2), p AS (SELECT series_id, bucket, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS s, count(DISTINCT m) AS n_parts FROM o JOIN lineitem ON l_orderkey=o_orderkey GROUP BY 1,2) SELECT series_id, bucket, n_parts, CAST(w-s AS DOUBLE) AS difference, CASE WHEN series_id='5-LOW' THEN 'warning' ELSE 'error' END AS severity FROM w JOIN p USING (series_id, bucket) WHERE abs(w-s)>0.01"),
    "N06_file_contract": (
        lambda s, d: G.contract(A.rejections(D.trades(s, d)).filter("reason is null"), "dia", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], "moneda", 1000, ["USD", "PYG", "EUR"]),
        f"WITH {F3}, g AS (SELECT * FROM cls WHERE reason IS NULL), k AS (SELECT count(*) AS duplicate_keys FROM (SELECT 1 FROM g GROUP BY l_orderkey, l_linenumber, l_partkey, l_suppkey HAVING count(*)>1)) SELECT count(*) AS n_rows, min(dia) AS first_day, max(dia) AS last_day, CAST(3 - count(DISTINCT moneda) AS INT) AS currencies_missing, max(duplicate_keys) AS duplicate_keys, FALSE AS holds FROM g, k",
    ),
    "N09_sheet_drift": (lambda s, d: Q.continuity(*D.releases(s, d), key="sheet"), f"WITH {F4}, a AS (SELECT sheet, count(*) AS n FROM prv GROUP BY 1), b AS (SELECT sheet, count(*) AS n FROM cur GROUP BY 1) SELECT coalesce(a.sheet,b.sheet) AS sheet, a.n AS before, b.n AS after, CASE WHEN b.n IS NULL THEN 'disappeared' WHEN a.n IS NULL THEN 'new' WHEN b.n<a.n THEN 'shrank' ELSE 'grew_or_same' END AS status FROM a FULL JOIN b ON a.sheet=b.sheet"),
    "N10_value_ranges": (lambda s, d: G.in_range(D.table(s, d, "events").select("event_type", "value"), D.table(s, d, "events").select("event_type").distinct().select("event_type", F.lit(0.0).alias("lowest"), F.when(F.col("event_type") == "click", 50.0).otherwise(100.0).alias("highest")), "event_type"), "SELECT event_type, count(*) AS n_values, count(*) FILTER (WHERE value NOT BETWEEN 0 AND CASE WHEN event_type='click' THEN 50 ELSE 100 END) AS n_outside FROM events GROUP BY 1"),
    "N12_release_gate": (
        n12,
        f"WITH {F1}, {F2} SELECT 'duplicate_observations' AS check_name, (SELECT count(*) FROM (SELECT 1 FROM obs GROUP BY series_id, period HAVING count(*)>1)) AS failing UNION ALL SELECT 'cell_reuse', (SELECT count(*) FROM (SELECT 1 FROM obs GROUP BY source_sheet, source_row, source_column HAVING count(*)>1)) UNION ALL SELECT 'unaccepted_vintages', (SELECT count(*) FROM latest WHERE vintage_id NOT IN ('v1','v2','v3')) UNION ALL SELECT 'unreconciled_cells', (SELECT count(*) FROM cells c WHERE num IS NOT NULL AND NOT EXISTS (SELECT 1 FROM obs o WHERE o.source_sheet=c.source_sheet AND o.source_row=c.row_id AND o.source_column=c.column_id) AND NOT EXISTS (SELECT 1 FROM rules r WHERE (r.source_sheet=c.source_sheet OR r.source_sheet='*') AND c.row_id BETWEEN row_from AND row_to AND c.column_id BETWEEN column_from AND column_to))",
    ),
    "N20_one_row_per_sheet": (lambda s, d: Q.duplicate_keys(D.grid(s, d).select("source_sheet", "row_id"), "source_sheet").select("source_sheet", "n_rows"), f"WITH {F2} SELECT source_sheet, count(*) AS n_rows FROM cells GROUP BY 1 HAVING count(*)>1"),
    "N21_rejection_reasons": (n21, f"WITH {F3}, u AS (SELECT reason, count(*) AS n FROM cls WHERE reason IS NOT NULL GROUP BY 1) SELECT coalesce(u.reason, x.reason) AS reason, coalesce(n,0) AS n, CASE WHEN n IS NULL THEN 'unused' ELSE 'undeclared' END AS problem FROM u FULL JOIN (VALUES ('invalid_date'),('duplicate_row')) AS x(reason) ON u.reason=x.reason WHERE n IS NULL OR x.reason IS NULL"),
    "N28_contradictions": (lambda s, d: G.contradictions(S.derived(labels(s, d)), s.createDataFrame([("stock", "pyg"), ("not_reviewed", None)], "stock_flow string, unit string")), f"WITH {_L}, v AS (SELECT {_DERIVED} FROM n) SELECT stock_flow, unit, count(*) AS n_series FROM v WHERE NOT (stock_flow='stock' AND unit IS NOT DISTINCT FROM 'pyg') AND NOT (stock_flow='not_reviewed' AND unit IS NULL) GROUP BY 1,2"),
    "N33_gate_decision": (
        n33,
        f"WITH {F1}, x AS (SELECT split_part(series_id,':',2) AS release_id, period, sum(CAST(CASE WHEN series_id LIKE '%:P' THEN value END AS DECIMAL(18,2))) AS t, sum(CAST(CASE WHEN series_id NOT LIKE '%:P' THEN value END AS DECIMAL(18,2))) AS p, count(*) AS n FROM snap WHERE vintage_id='v3' GROUP BY 1,2), st AS (SELECT release_id, CASE WHEN t IS NULL THEN 'w' WHEN n<3 THEN 'w' WHEN abs(t-p)<=0.01 THEN 'h' ELSE 'e' END AS s FROM x) SELECT release_id, count(*) FILTER (WHERE s='e') AS errors, count(*) FILTER (WHERE s='w') AS warnings, CASE WHEN count(*) FILTER (WHERE s='e')>0 THEN 'blocked' ELSE 'accepted' END AS decision FROM st GROUP BY 1",
    ),
}


def queries():
    return {k: v[0] for k, v in _Q.items()}


def oracle_sql():
    return {k: v[1] for k, v in _Q.items()}
