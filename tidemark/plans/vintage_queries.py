"""Queries of the vintage store, with the SQL they equal."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..functions.periods import months_between_ends
from ..operators import quality, screens
from ..operators import vintage as V
from ..sources import derived as D
from ..sources.derived import F1


def _events(spark, d):
    return V.sparse_events(D.snapshots(spark, d), D.vintages(spark))


def _latest(spark, d):
    return V.latest(_events(spark, d), D.accepted(spark))


def _realised(spark, d):
    return V.realised(_latest(spark, d))


AS_OF = date(2000, 12, 31)


def _series(rows):
    return rows.select("series_id").distinct().select("series_id", F.lit("monthly").alias("frequency"), F.when(F.col("series_id").endswith(":F"), F.lit(None)).otherwise(1000.0).alias("scale_multiplier"))


def j08(spark, d):
    rows = _realised(spark, d)
    dates = D.vintages(spark).select("vintage_id", F.col("publication_date").alias("available_at"))
    return V.observations(rows, _series(rows), dates)


def j01_incremental(spark, d):
    """The fourth vintage against the latest of the three before: the same events as the whole-history form gives it."""
    snaps = D.snapshots(spark, d)
    before = V.latest(V.sparse_events(snaps.filter("vintage_id < 'v4'"), D.vintages(spark).filter("vintage_id < 'v4'")))
    return V.incremental_events(before, snaps.filter("vintage_id = 'v4'"))


def a20(spark, d):
    """Customers as series: those of even nations are known under keys of their own, the others get new ones."""
    customers = D.table(spark, d, "customer")
    ids = customers.select(F.concat(F.lit("customer:"), F.col("c_custkey").cast("string")).alias("series_id"))
    known = customers.filter("c_nationkey % 2 = 0").select(F.concat(F.lit("customer:"), F.col("c_custkey").cast("string")).alias("series_id"), (F.col("c_custkey") * 10).alias("series_sk"))
    return V.surrogate_keys(known, ids)


def l09_grid(spark, d):
    """Expected periods of each series between its first and last, and whether they were observed."""
    return screens.expected_grid(_realised(spark, d))


GAPS = """steps AS (SELECT series_id, period, lag(period) OVER (PARTITION BY series_id ORDER BY period) AS p FROM realised)"""
_Q = {
    "J01_sparse_events": (_events, f"WITH {F1} SELECT * FROM fact"),
    "J01_incremental_events": (j01_incremental, f"WITH {F1} SELECT * FROM fact WHERE vintage_id = 'v4'"),
    "J02_revisions": (
        lambda s, d: V.revisions(D.snapshots(s, d), D.vintages(s)),
        f"WITH {F1} SELECT series_id, period, prev_v AS previous_vintage, vintage_id AS new_vintage, prev AS previous_value, value AS new_value, abs(value - prev) AS absolute_revision, CASE WHEN value IS NULL THEN 'removed' ELSE 'changed' END AS kind FROM seqd WHERE prev IS NOT NULL AND (value IS NULL OR abs(value - prev) > 1e-12)",
    ),
    "J04_publisher_statement": (_latest, f"WITH {F1} SELECT * FROM latest"),
    "J04_publisher_statement_all": (
        lambda s, d: V.latest(_events(s, d)),
        f"WITH {F1} SELECT series_id, period, value, vintage_id, publication_date, CASE WHEN period > publication_date THEN 'after_publication' ELSE 'observed' END AS observation_status FROM (SELECT *, row_number() OVER (PARTITION BY series_id, period ORDER BY publication_date DESC NULLS LAST, vintage_id DESC) AS k FROM fact) WHERE k = 1 AND NOT is_deleted",
    ),
    "J05_realised_latest": (_realised, f"WITH {F1} SELECT * FROM realised"),
    "J06_projections": (lambda s, d: V.projections(_latest(s, d)), f"WITH {F1} SELECT * FROM latest WHERE observation_status = 'after_publication'"),
    "J07_series_catalogue": (lambda s, d: V.catalogue(_latest(s, d)), f"WITH {F1} SELECT series_id, count(*) AS n_observations, min(period) AS first_period, max(period) AS last_period, max(publication_date) AS last_publication FROM latest GROUP BY 1"),
    "J08_observations": (
        j08,
        f"WITH {F1} SELECT series_id, period, r.vintage_id, value, CAST(date_trunc('month', period) AS DATE) AS period_start, last_day(period) AS period_end, CASE WHEN series_id LIKE '%:F' THEN NULL ELSE value * 1000.0 END AS value_in_base_units, v.publication_date AS available_at FROM realised r JOIN vint v ON v.vintage_id = r.vintage_id",
    ),
    "J09_history": (lambda s, d: _events(s, d).join(F.broadcast(D.accepted(s).select("vintage_id")), "vintage_id", "left_semi"), f"WITH {F1} SELECT * FROM fact WHERE vintage_id IN ('v1','v2','v3')"),
    "J10_series_as_of": (
        lambda s, d: V.as_of(_events(s, d), D.accepted(s), AS_OF),
        f"WITH {F1} SELECT series_id, period, value, vintage_id, publication_date AS available_at, 'observed' AS observation_status FROM (SELECT *, row_number() OVER (PARTITION BY series_id, period ORDER BY publication_date DESC, vintage_id DESC) AS k FROM fact WHERE vintage_id IN ('v1','v2','v3') AND publication_date <= DATE '2000-12-31') WHERE k = 1 AND NOT is_deleted AND period <= publication_date",
    ),
    "J10_statement_as_of": (
        lambda s, d: V.as_of(_events(s, d), D.accepted(s), AS_OF, statement=True),
        f"WITH {F1} SELECT series_id, period, value, vintage_id, publication_date AS available_at, CASE WHEN period > publication_date THEN 'after_publication' ELSE 'observed' END AS observation_status FROM (SELECT *, row_number() OVER (PARTITION BY series_id, period ORDER BY publication_date DESC, vintage_id DESC) AS k FROM fact WHERE vintage_id IN ('v1','v2','v3') AND publication_date <= DATE '2000-12-31') WHERE k = 1 AND NOT is_deleted",
    ),
    "A20_surrogate_keys": (a20, "WITH c AS (SELECT 'customer:'||CAST(c_custkey AS VARCHAR) AS series_id, c_custkey*10 AS sk, c_nationkey%2=0 AS known FROM customer) SELECT series_id, CAST(sk AS BIGINT) AS series_sk FROM c WHERE known UNION ALL SELECT series_id, CAST((SELECT max(sk) FROM c WHERE known) + row_number() OVER (ORDER BY substr(md5(series_id),1,2), series_id) AS BIGINT) FROM c WHERE NOT known"),
    "L09_expected_grid": (
        l09_grid,
        f"WITH {F1}, spans AS (SELECT series_id, min(period) AS a, max(period) AS b FROM realised GROUP BY 1 HAVING count(*) > 1), g AS (SELECT series_id, last_day(CAST(unnest(generate_series(date_trunc('month', a), date_trunc('month', b), INTERVAL 1 MONTH)) AS DATE)) AS period FROM spans) SELECT g.series_id, g.period, r.value IS NOT NULL AS observed FROM g LEFT JOIN realised r ON r.series_id = g.series_id AND r.period = g.period",
    ),
    "O01_gap_screen": (
        lambda s, d: screens.gaps(_realised(s, d), 1),
        f"WITH {F1}, {GAPS} SELECT series_id, p AS previous_period, period, CAST(datediff('month', p, period) AS INT) AS step_months, CAST(datediff('month', p, period) - 1 AS INT) AS missing_periods FROM steps WHERE p IS NOT NULL AND datediff('month', p, period) > 1",
    ),
    "O02_jump_screen": (
        lambda s, d: screens.jumps(_realised(s, d), times=3.0),
        f"WITH {F1}, ch AS (SELECT series_id, period, value, abs(value - lag(value) OVER (PARTITION BY series_id ORDER BY period)) AS change FROM realised), md AS (SELECT series_id, median(change) AS median_change, count(change) AS n FROM ch GROUP BY 1) SELECT ch.series_id, period, value, change, median_change FROM ch JOIN md ON md.series_id = ch.series_id WHERE n >= 24 AND median_change > 0 AND change > 3 * median_change",
    ),
    "O03_divergence_screen": (
        lambda s, d: screens.divergence(_realised(s, d).withColumn("concept_id", F.split_part("series_id", F.lit(":"), F.lit(3))), 0.01),
        f"WITH {F1} SELECT split_part(series_id, ':', 3) AS concept_id, period, count(DISTINCT series_id) AS n_series, min(value) AS lowest, max(value) AS highest FROM realised GROUP BY 1, 2 HAVING count(DISTINCT series_id) > 1 AND max(value) - min(value) > 0.01 * greatest(abs(max(value)), abs(min(value)))",
    ),
    "N05_nonshrinking_snapshot": (
        lambda s, d: quality.shrinking(D.snapshots(s, d)),
        f"WITH {F1}, c AS (SELECT vintage_id, count(*) AS n FROM snap GROUP BY 1), l AS (SELECT vintage_id, n AS n_rows, lag(n) OVER (ORDER BY vintage_id) AS before FROM c) SELECT *, coalesce(n_rows < before, FALSE) AS shrank FROM l",
    ),
    "N08_series_continuity": (
        lambda s, d: quality.continuity(D.snapshots(s, d).filter("vintage_id = 'v1'"), D.snapshots(s, d).filter("vintage_id = 'v3'")),
        f"WITH {F1}, a AS (SELECT series_id, count(*) AS n FROM snap WHERE vintage_id = 'v1' GROUP BY 1), b AS (SELECT series_id, count(*) AS n FROM snap WHERE vintage_id = 'v3' GROUP BY 1) SELECT coalesce(a.series_id, b.series_id) AS series_id, a.n AS before, b.n AS after, CASE WHEN b.n IS NULL THEN 'disappeared' WHEN a.n IS NULL THEN 'new' WHEN b.n < a.n THEN 'shrank' ELSE 'grew_or_same' END AS status FROM a FULL JOIN b ON a.series_id = b.series_id",
    ),
    "N11_publication_order": (
        lambda s, d: quality.publication_order(D.snapshots(s, d)),
        f"WITH {F1}, v AS (SELECT vintage_id, max(publication_date) AS publication_date, max(period) AS content_max FROM snap GROUP BY 1), l AS (SELECT *, lag(publication_date) OVER (ORDER BY vintage_id) AS before FROM v) SELECT vintage_id, publication_date, content_max, coalesce(publication_date < before, FALSE) AS not_monotonic, content_max > publication_date AS content_beyond_date FROM l",
    ),
    "N14_published_identities": (
        lambda s, d: quality.identities(D.snapshots(s, d).filter("vintage_id = 'v3'"), tolerance=0.01),
        f"WITH {F1}, x AS (SELECT split_part(series_id, ':', 2) AS family, period, split_part(series_id, ':', 3) AS part, value FROM snap WHERE vintage_id = 'v3') SELECT family, period, count(*) AS n_parts, CAST(sum(CAST(CASE WHEN part = 'P' THEN value END AS DECIMAL(18,2))) AS DOUBLE) AS total, CAST(sum(CAST(CASE WHEN part <> 'P' THEN value END AS DECIMAL(18,2))) AS DOUBLE) AS parts, CASE WHEN count(CASE WHEN part = 'P' THEN 1 END) = 0 THEN 'no_total' WHEN count(*) < 3 THEN 'incomplete' WHEN abs(sum(CAST(CASE WHEN part = 'P' THEN value END AS DECIMAL(18,2))) - sum(CAST(CASE WHEN part <> 'P' THEN value END AS DECIMAL(18,2)))) <= 0.01 THEN 'holds' ELSE 'broken' END AS status FROM x GROUP BY 1, 2",
    ),
    "N16_projection_leakage": (lambda s, d: _realised(s, d).agg(F.count_if(F.col("period") > F.col("publication_date")).alias("leaked")), f"WITH {F1} SELECT count(*) FILTER (WHERE period > publication_date) AS leaked FROM realised"),
    "N22_grid_growth": (lambda s, d: quality.grid_growth(l09_grid(s, d), 25_000_000), f"WITH {F1}, spans AS (SELECT series_id, min(period) AS a, max(period) AS b FROM realised GROUP BY 1 HAVING count(*) > 1) SELECT CAST(sum(datediff('month', a, b) + 1) AS BIGINT) AS grid_rows, CAST(25000000 AS BIGINT) AS budget, sum(datediff('month', a, b) + 1) > 25000000 AS over FROM spans"),
    "N26_accepted_only": (lambda s, d: _latest(s, d).join(F.broadcast(D.accepted(s)), "vintage_id", "left_anti").agg(F.count("*").alias("foreign_rows")), f"WITH {F1} SELECT count(*) AS foreign_rows FROM latest WHERE vintage_id NOT IN ('v1','v2','v3')"),
    "D12_history_signature": (
        lambda s, d: screens.duplicate_histories(_realised(s, d)),
        f"WITH {F1}, g AS (SELECT series_id, md5(string_agg(strftime(period, '%Y-%m-%d') || '=' || CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR), ';' ORDER BY period)) AS signature, count(*) AS n FROM realised GROUP BY 1) SELECT signature, count(*) AS n_series, min(series_id) AS first_series, max(n) AS n_observations FROM g GROUP BY 1",
    ),
    "D13_frequency": (
        lambda s, d: screens.frequencies(_realised(s, d)),
        f"WITH {F1}, {GAPS} SELECT series_id, median(datediff('month', p, period)) AS median_gap, CASE WHEN median(datediff('month', p, period)) <= 1.5 THEN 'monthly' WHEN median(datediff('month', p, period)) <= 4 THEN 'quarterly' ELSE 'annual' END AS frequency FROM steps WHERE p IS NOT NULL GROUP BY 1",
    ),
    "G17_month_distance": (
        lambda s, d: D.table(s, d, "lineitem").join(D.table(s, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).groupBy(months_between_ends(F.col("l_shipdate"), F.col("o_orderdate")).cast("long").alias("months")).agg(F.count("*").alias("n")),
        "SELECT datediff('month', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS months, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1",
    ),
}


def queries():
    return {k: v[0] for k, v in _Q.items()}


def oracle_sql():
    return {k: v[1] for k, v in _Q.items()}
