"""Data-quality rules. Each returns the rows that a flag is raised from; flags() turns them into one table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import hashed_id


def flags(rule: str, severity: str, found: DataFrame, subject: str, detail: str) -> DataFrame:
    """Rows of the flag table for what a rule found."""
    return found.select(hashed_id("flag:", F.lit(rule), F.col(subject).cast("string"), F.col(detail).cast("string")).alias("flag_id"), F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), F.col(subject).cast("string").alias("subject"), F.col(detail).cast("string").alias("detail"))


def all_flags(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def duplicate_keys(rows: DataFrame, *keys: str) -> DataFrame:
    """Keys with several rows; nulls are members of a key."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def coverage(rows: DataFrame, by: str, mapped: str, least: float) -> DataFrame:
    """Share of rows with a mapping, against a threshold."""
    return rows.groupBy(by).agg(F.count("*").alias("n_rows"), F.count(mapped).alias("n_mapped")).withColumn("below", F.col("n_mapped") < F.col("n_rows") * F.lit(least))


def shrinking(snapshots: DataFrame) -> DataFrame:
    """Row counts by vintage against the vintage before; the table of counts has a row for each vintage."""
    counts = snapshots.groupBy("vintage_id").agg(F.count("*").alias("n_rows"))
    before = F.lag("n_rows").over(Window.orderBy("vintage_id"))
    return counts.withColumn("before", before).withColumn("shrank", F.coalesce(F.col("n_rows") < F.col("before"), F.lit(False)))


def continuity(old: DataFrame, new: DataFrame, key: str = "series_id") -> DataFrame:
    """Keys that disappeared, are new, shrank or kept their rows."""
    a, b = old.groupBy(key).agg(F.count("*").alias("before")), new.groupBy(key).agg(F.count("*").alias("after"))
    status = F.when(F.col("after").isNull(), "disappeared").when(F.col("before").isNull(), "new").when(F.col("after") < F.col("before"), "shrank").otherwise("grew_or_same")
    return a.join(b, key, "full_outer").withColumn("status", status)


def publication_order(snapshots: DataFrame) -> DataFrame:
    """Publication dates that go back, and content beyond them."""
    seen = snapshots.groupBy("vintage_id").agg(F.max("publication_date").alias("publication_date"), F.max("period").alias("content_max"))
    back = F.coalesce(F.col("publication_date") < F.lag("publication_date").over(Window.orderBy("vintage_id")), F.lit(False))
    return seen.select("vintage_id", "publication_date", "content_max", back.alias("not_monotonic"), (F.col("content_max") > F.col("publication_date")).alias("content_beyond_date"))


def identities(rows: DataFrame, tolerance: float, total: str = "P") -> DataFrame:
    """A published total against the sum of its parts, in exact decimals."""
    parted = rows.select(F.split_part("series_id", F.lit(":"), F.lit(2)).alias("family"), "period", F.split_part("series_id", F.lit(":"), F.lit(3)).alias("part"), F.col("value").cast("decimal(18,2)").alias("v"))
    is_total = F.col("part") == total
    summed = parted.groupBy("family", "period").agg(F.count("*").alias("n_parts"), F.count_if(is_total).alias("t"), F.sum(F.when(is_total, F.col("v"))).alias("total"), F.sum(F.when(~is_total, F.col("v"))).alias("parts"))
    status = F.when(F.col("t") == 0, "no_total").when(F.col("n_parts") < 3, "incomplete").when(F.abs(F.col("total") - F.col("parts")) <= tolerance, "holds").otherwise("broken")
    return summed.select("family", "period", "n_parts", F.col("total").cast("double").alias("total"), F.col("parts").cast("double").alias("parts"), status.alias("status"))


def grid_growth(grid: DataFrame, budget: int) -> DataFrame:
    """N22."""
    return grid.agg(F.count("*").alias("grid_rows")).select("grid_rows", F.lit(budget).cast("long").alias("budget"), (F.col("grid_rows") > budget).alias("over"))


def orphans(rows: DataFrame, parents: DataFrame, on) -> DataFrame:
    """Rows without a parent."""
    return rows.join(parents, on, "left_anti")


def currency_semantics(rows: DataFrame, native: str) -> DataFrame:
    """Rows whose currency code and unit contradict each other: a currency without its unit, or a unit without a currency."""
    wrong = F.when(F.col("currency").isNull() & F.col("unit").isin("pyg", "usd"), "currency missing").when(F.col("currency").isNotNull() & F.col("unit").isin("percent", "index"), "currency on a ratio").when((F.col("currency") == native) & ~F.col("unit").eqNullSafe("pyg"), "native currency in another unit")
    return rows.select("series_id", "currency", "unit", wrong.alias("problem")).filter("problem is not null")


def documented(rows: DataFrame) -> DataFrame:
    """By source, keys with several rows, series with several units, scales on dimensionless units, the share without a unit."""
    keys = rows.groupBy("source_id", "series_id", "period").agg(F.count("*").alias("n"), F.min("unit").alias("u1"), F.max("unit").alias("u2"), F.count("unit").alias("with_unit"), F.max("scale_multiplier").alias("scale"))
    series = keys.groupBy("source_id", "series_id").agg(F.sum("n").alias("n"), F.count_if(F.col("n") > 1).alias("dup"), F.min("u1").alias("u1"), F.max("u2").alias("u2"), F.sum("with_unit").alias("with_unit"), F.max("scale").alias("scale"))
    return series.groupBy("source_id").agg(
        F.sum("n").alias("n_rows"), F.sum("dup").alias("duplicate_keys"), F.count_if(F.col("u1") != F.col("u2")).alias("mixed_units"),
        F.count_if((F.col("u1") == "percent") & (F.coalesce("scale", F.lit(1.0)) != 1)).alias("scaled_ratios"), (F.sum("n") - F.sum("with_unit")).alias("without_unit"),
    )


def documented_source(rows: DataFrame, ranges: DataFrame, unknown_share: float = 0.15) -> DataFrame:
    """N07, the rest: (source_id, check_name, failing, of) for each source of documented observations.

    positional_ids: series whose identity rests on a place; unknown_units: series without a unit, where they are more than
    ``unknown_share`` of all (else 0); outside_range: observations of a survey beyond its bounds, ranges being (source_id, low, high); a
    source without bounds has none.
    """
    series = rows.groupBy("source_id", "series_id").agg(F.max("stability").alias("stability"), F.count("unit").alias("units"))
    of_series = series.groupBy("source_id").agg(F.count("*").alias("n"), F.count_if(F.col("stability") == "positional").alias("positional"), F.count_if(F.col("units") == 0).alias("unknown"))
    bounded = rows.join(F.broadcast(ranges), "source_id", "left").groupBy("source_id").agg(F.count("*").alias("rows"), F.count_if(~F.col("value").between(F.col("low"), F.col("high"))).alias("outside"))
    unknown = F.when(F.col("unknown") > unknown_share * F.col("n"), F.col("unknown")).otherwise(0)
    checks = [("positional_ids", F.col("positional"), F.col("n")), ("unknown_units", unknown, F.col("n")), ("outside_range", F.col("outside"), F.col("rows"))]
    each = F.explode(F.array(*(F.struct(F.lit(n).alias("check_name"), f.cast("long").alias("failing"), of.cast("long").alias("of")) for n, f, of in checks))).alias("e")
    return of_series.join(bounded, "source_id").select("source_id", each).select("source_id", "e.*")


def archive_problems(found: DataFrame, recorded: DataFrame) -> DataFrame:
    """Recorded files (file_name, sha256) that are gone or hold other bytes, and files that no record names."""
    both = recorded.select("file_name", F.col("sha256").alias("_r")).join(found.select("file_name", F.col("sha256").alias("_f")), "file_name", "full_outer")
    problem = F.when(F.col("_f").isNull(), "missing").when(F.col("_r").isNull(), "unrecorded").when(F.col("_f") != F.col("_r"), "other bytes")
    return both.select("file_name", problem.alias("problem")).filter("problem is not null")
