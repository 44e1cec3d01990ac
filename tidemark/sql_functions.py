"""The point-in-time and identifier interface for SQL: table functions and resolvers over views of the store.

As-of functions rank over every ever-accepted vintage that was available on the day (J10); the scalar resolver is null
where an identifier names none or several series, the table one gives every candidate (M06, S10).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FUNCTIONS = ("series_as_of_date", "series_statement_as_of_date", "resolve_series_id", "resolve_series_ids")
_TABLE = "TABLE(series_id STRING, period DATE, value DOUBLE, vintage_id STRING, available_at DATE, observation_status STRING)"
_AS_OF = """
SELECT series_id, period, value, vintage_id, available_at, observation_status FROM (
  SELECT *, row_number() OVER (PARTITION BY series_id, period ORDER BY available_at DESC, publication_date DESC NULLS LAST, vintage_id DESC) AS nth
  FROM {history} WHERE available_at <= {name}.as_of {only})
WHERE nth = 1 AND NOT is_deleted"""


def create_functions(spark: SparkSession, events: DataFrame, ever_accepted: DataFrame, resolved: DataFrame, prefix: str = "") -> None:
    """Temporary functions of this session, named FUNCTIONS after ``prefix``, over (series_id, period, value, is_deleted, vintage_id, publication_date) events,
    accepted (vintage_id, available_at) and resolved (old_id, candidates as an array, resolved_id)."""
    after = F.col("publication_date").isNotNull() & (F.col("period") > F.col("publication_date"))
    history = events.join(F.broadcast(ever_accepted.select("vintage_id", "available_at")), "vintage_id").withColumn("observation_status", F.when(after, "after_publication").otherwise("observed"))
    history.createOrReplaceTempView(f"{prefix}series_history")
    resolved.select(F.col("old_id").alias("lookup_id"), "resolved_id", "candidates").createOrReplaceTempView(f"{prefix}series_resolution")
    # What is a projection was none only where its own publication says so: the test stands before the ranking, as in as_of().
    for name, only in (("series_as_of_date", "AND observation_status = 'observed'"), ("series_statement_as_of_date", "")):
        body = _AS_OF.format(history=f"{prefix}series_history", name=f"{prefix}{name}", only=only)
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}(as_of DATE) RETURNS {_TABLE} RETURN {body}")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}resolve_series_id(published_id STRING) RETURNS STRING RETURN (SELECT max(r.resolved_id) FROM {prefix}series_resolution r WHERE r.lookup_id = {prefix}resolve_series_id.published_id)")
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}resolve_series_ids(published_id STRING) RETURNS TABLE(published_series_id STRING, current_series_id STRING, candidate_count INT) "
        f"RETURN SELECT r.lookup_id, c.current_series_id, size(r.candidates) FROM {prefix}series_resolution r LATERAL VIEW explode(r.candidates) c AS current_series_id WHERE r.lookup_id = {prefix}resolve_series_ids.published_id"
    )
