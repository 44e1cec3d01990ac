"""Concepts, regions, contracts and gates: what a release must satisfy before it is published."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import hashed_id


def own_concepts(series: DataFrame, known: DataFrame) -> DataFrame:
    """A concept of its own for each series that has none."""
    return series.select("series_id").distinct().join(known, "series_id", "left_anti").select("series_id", hashed_id("concept:", F.col("series_id")).alias("concept_id"))


def agreed_concepts(mapped: DataFrame, *fields: str) -> DataFrame:
    """Concepts whose series agree on every field; nulls disagree with values."""
    per = mapped.groupBy("concept_id").agg(F.count("*").alias("n_series"), *(F.countDistinct(F.struct(f)).alias(f"_{f}") for f in fields))
    return per.select("concept_id", "n_series", reduce(lambda a, b: a & b, (F.col(f"_{f}") == 1 for f in fields)).alias("agrees"))


def latest_by_concept(rows: DataFrame, mapped: DataFrame) -> DataFrame:
    """M09."""
    return rows.join(mapped, "series_id").groupBy("concept_id").agg(F.max("period").alias("last_period"), F.countDistinct("series_id").alias("n_series"), F.count("*").alias("n_observations"))


def outside(cells: DataFrame, regions: DataFrame) -> DataFrame:
    """Cells that no region of their sheet holds; every cell of a sheet without regions."""
    r = F.broadcast(regions.withColumnRenamed("source_sheet", "_sheet"))
    inside = (F.col("_sheet") == F.col("source_sheet")) & F.col("row_id").between(F.col("row_from"), F.col("row_to")) & F.col("column_id").between(F.col("column_from"), F.col("column_to"))
    return cells.join(r, inside, "left_anti")


def region_completeness(cells: DataFrame, regions: DataFrame) -> DataFrame:
    """Cells in and out of regions, by sheet."""
    out = outside(cells, regions).groupBy("source_sheet").agg(F.count("*").alias("n_outside"), F.count("num").alias("n_numbers_outside"))
    return cells.groupBy("source_sheet").agg(F.count("*").alias("n_cells")).join(out, "source_sheet", "left").na.fill(0)


def behaviour(observations: DataFrame, hidden_spans: DataFrame, formulas: DataFrame) -> DataFrame:
    """Whether an observation was read from a hidden row or from a formula cell."""
    spans = F.broadcast(hidden_spans.select(F.col("source_sheet").alias("_sheet"), "lo", "hi"))
    keys = ["source_sheet", "source_row", "source_column"]
    hidden = observations.join(spans, (F.col("_sheet") == F.col("source_sheet")) & F.col("source_row").between(F.col("lo"), F.col("hi")), "left_semi").select(*keys, F.lit(True).alias("from_hidden_row")).distinct()
    formula = formulas.select(*keys, F.lit(True).alias("from_formula")).distinct()
    return observations.join(hidden, keys, "left").join(formula, keys, "left").na.fill(False, ["from_hidden_row", "from_formula"])


def aggregates_hold(parts: DataFrame, wholes: DataFrame, tolerance: float, exceptions: DataFrame) -> DataFrame:
    """Sums of parts against published wholes by (series_id, bucket); known exceptions are warnings."""
    summed = parts.groupBy("series_id", "bucket").agg(F.sum(F.col("value").cast("decimal(18,2)")).alias("s"), F.count("*").alias("n_parts"))
    joined = wholes.select("series_id", "bucket", F.col("value").cast("decimal(18,2)").alias("w")).join(summed, ["series_id", "bucket"]).filter(F.abs(F.col("w") - F.col("s")) > tolerance)
    known = joined.join(F.broadcast(exceptions.withColumn("_known", F.lit(True))), "series_id", "left")
    return known.select("series_id", "bucket", "n_parts", (F.col("w") - F.col("s")).cast("double").alias("difference"), F.when(F.col("_known"), "warning").otherwise("error").alias("severity"))


def contract(rows: DataFrame, day: str, key: list[str], currency: str, least_rows: int, required: list[str]) -> DataFrame:
    """A long file against its contract, one row of measures."""
    keys = rows.groupBy(*key).agg(F.count("*").alias("n")).agg(F.count_if(F.col("n") > 1).alias("duplicate_keys"))
    seen = rows.agg(F.count("*").alias("n_rows"), F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.array_size(F.array_except(F.lit(required), F.collect_set(currency))).alias("currencies_missing"))
    return seen.crossJoin(keys).withColumn("holds", (F.col("n_rows") >= least_rows) & (F.col("duplicate_keys") == 0) & (F.col("currencies_missing") == 0))


def in_range(rows: DataFrame, limits: DataFrame, by: str) -> DataFrame:
    """Values outside the limits of their group."""
    return rows.join(F.broadcast(limits), by).groupBy(by).agg(F.count("*").alias("n_values"), F.count_if(~F.col("value").between(F.col("lowest"), F.col("highest"))).alias("n_outside"))


def failed_sources(files: DataFrame) -> DataFrame:
    """Vintages that were not read to the end, unresolved ones aside."""
    return files.filter(~F.col("ingestion_status").isin("ingested", "unchanged", "unresolved"))


def gate(checks: dict[str, DataFrame]) -> DataFrame:
    """One row for each named check with how many rows fail it; the gate is open where all are 0."""
    parts = [f.agg(F.count("*").alias("failing")).withColumn("check_name", F.lit(n)) for n, f in checks.items()]
    return reduce(DataFrame.unionByName, parts).select("check_name", "failing")


def undeclared(found: DataFrame, declared: DataFrame, on: str) -> DataFrame:
    """Values in use that no register declares, and declared ones that never occur."""
    used = found.groupBy(on).agg(F.count("*").alias("n"))
    both = used.join(declared.select(on, F.lit(True).alias("_d")), on, "full_outer")
    return both.filter("n is null or _d is null").select(on, F.coalesce("n", F.lit(0)).alias("n"), F.when(F.col("n").isNull(), "unused").otherwise("undeclared").alias("problem"))


def contradictions(series: DataFrame, allowed: DataFrame) -> DataFrame:
    """Pairs of measure and unit that are not allowed together."""
    pairs = series.groupBy("stock_flow", "unit").agg(F.count("*").alias("n_series"))
    return pairs.join(F.broadcast(allowed), (pairs["stock_flow"] == allowed["stock_flow"]) & pairs["unit"].eqNullSafe(allowed["unit"]), "left_anti")


def unpivoted(rows: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Measures as series; blanks are not observations."""
    return rows.unpivot(keys, measures, "measure", "value").filter("value is not null")


def signed_dimension(accounts: DataFrame, code: str) -> DataFrame:
    """An account map with digits only, a hashed id, and the sign that the code carries."""
    digits = F.regexp_replace(F.col(code), "[^0-9]", "")
    return accounts.select(F.col(code), digits.alias("account"), F.when(F.col(code).startswith("-"), -1).otherwise(1).alias("multiplier"), hashed_id("account:", digits).alias("account_id"))


def new_entities(codes: DataFrame, dictionary: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Codes in use that the dimension lacks, named by the dictionary where it can."""
    return codes.select(key).distinct().join(known, key, "left_anti").join(F.broadcast(dictionary), key, "left")
