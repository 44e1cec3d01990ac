"""Catalogues, domain marts, the coverage dashboard and the canonical layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def domain_mart(observations: DataFrame, domains: DataFrame, gate: DataFrame | None = None) -> DataFrame:
    """Observations of series in a domain, behind a gate of publishable series where one is given."""
    rows = observations.join(domains, "series_id")
    return rows.join(gate.select("series_id"), "series_id", "left_semi") if gate is not None else rows


def sheet_status(series_sheets: DataFrame, register: DataFrame) -> DataFrame:
    """The status of each series on each of its sheets: that of the exact sheet, else that of '*', else unreviewed."""
    statuses = register.groupBy("source_sheet").agg(F.max("status").alias("_status"))
    every = statuses.filter("source_sheet = '*'").agg(F.max("_status").alias("_every"))
    joined = series_sheets.join(statuses, "source_sheet", "left").crossJoin(F.broadcast(every))
    return joined.select(*series_sheets.columns, F.coalesce("_status", "_every", F.lit("unreviewed")).alias("status"))


def research_gate(series_sheets: DataFrame, register: DataFrame, reviewed: DataFrame | None = None) -> DataFrame:
    """Series whose every sheet is validated, and that are reviewed where a list of reviewed series is given."""
    counted = sheet_status(series_sheets, register).groupBy("series_id").agg(F.count("*").alias("n_sheets"), F.count_if(F.col("status") == "validated").alias("n_validated"))
    open_ = counted.filter("n_sheets = n_validated")
    return open_.join(reviewed.select("series_id"), "series_id", "left_semi") if reviewed is not None else open_


def classified_domains(series_sheets: DataFrame, domains: DataFrame) -> DataFrame:
    """The domain of each series by its sheets; several domains leave it open."""
    found = series_sheets.join(domains, "source_sheet", "left").groupBy("series_id").agg(F.count_distinct("domain").alias("n_domains"), F.max("domain").alias("_one"))
    return found.select("series_id", "n_domains", F.when(F.col("n_domains") == 1, F.col("_one")).alias("domain"))


def membership(register: DataFrame, resolved: DataFrame) -> DataFrame:
    """Members of canonical series by the identifiers in force; those that resolve to none or to several have none."""
    now = resolved.select(F.col("old_id").alias("member_id"), "resolved_id", "n_candidates")
    joined = register.join(now, "member_id", "left")
    return joined.select("canonical_id", "member_id", "resolved_id", F.when(F.col("n_candidates") > 1, "ambiguous").when(F.col("resolved_id").isNull(), "unresolved").otherwise("resolved").alias("state"))


def regime_problems(regimes: DataFrame, vocabulary: list[str]) -> DataFrame:
    """Regimes of a series (series_id, regime, valid_from, valid_to) with a word outside the vocabulary, an end before
    the start, or a start before the end of the one before."""
    before = F.lag("valid_to").over(Window.partitionBy("series_id").orderBy("valid_from", "regime"))
    problem = F.when(~F.col("regime").isin(vocabulary), "unknown regime").when(F.col("valid_to") < F.col("valid_from"), "ends before it starts").when(F.col("valid_from") <= before, "overlaps")
    return regimes.select("series_id", "regime", "valid_from", problem.alias("problem")).filter("problem is not null")


def grain_catalogue(observations: DataFrame, sheets: DataFrame) -> DataFrame:
    """Coverage of each series beside the list of its sheets, both aggregated before they are joined."""
    covered = observations.groupBy("series_id").agg(F.count("*").alias("n_observations"), F.min("period").alias("first_period"), F.max("period").alias("last_period"))
    listed = sheets.groupBy("series_id").agg(F.array_join(F.array_sort(F.collect_set("source_sheet")), ", ").alias("sheets"))
    return covered.join(listed, "series_id", "left")


def dashboard(sheets: DataFrame, *parts: DataFrame, key: str = "source_sheet") -> DataFrame:
    """One row for each worksheet, with every part aggregated to the worksheet first; absent numbers are 0."""
    out = sheets.select(key).distinct()
    for p in parts:
        out = out.join(p, key, "left")
    return out.na.fill(0)


def top_of_each(rows: DataFrame, group: str, order: list, k: int) -> DataFrame:
    """The first k of each group under a total order."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(*order))).filter(F.col("rank") <= k)


def agreement(left: DataFrame, right: DataFrame, tolerance: float) -> DataFrame:
    """How often an alias agrees with its primary in periods that both have."""
    both = left.select("pair", "period", F.col("value").alias("a")).join(right.select("pair", "period", F.col("value").alias("b")), ["pair", "period"])
    return both.groupBy("pair").agg(F.count("*").alias("shared_periods"), F.count_if(F.abs(F.col("a") - F.col("b")) <= tolerance * F.abs("b")).alias("agreeing"))


def content_fingerprint(rows: DataFrame) -> DataFrame:
    """Count and an order-free hash sum of the rows."""
    return rows.agg(F.count("*").alias("n_rows"), F.sum(F.xxhash64(*sorted(rows.columns)).cast("decimal(38,0)")).alias("hash_sum"))


def changed(old: DataFrame, new: DataFrame) -> bool:
    """Whether a table must be replaced."""
    return content_fingerprint(old).first() != content_fingerprint(new).first()


def upserted(old: DataFrame, new: DataFrame, key: str, first: str = "first_vintage_id") -> DataFrame:
    """New attributes over old ones, keeping the first vintage of a key that was known."""
    o = old.select(key, *(F.col(c).alias(f"_{c}") for c in old.columns if c != key))
    joined = o.join(new, key, "full_outer")
    return joined.select(key, *(F.coalesce(f"_{c}", c).alias(c) if c == first else F.coalesce(c, f"_{c}").alias(c) for c in new.columns if c != key))
