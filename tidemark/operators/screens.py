"""Statistical screens over observations (series_id, period, value): every one is one shuffle by series or concept."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.periods import expected, inferred_frequency, months_between_ends


def by_series():
    return Window.partitionBy("series_id").orderBy("period")


def gaps(rows: DataFrame, expected_step: int) -> DataFrame:
    """Steps longer than expected, with the number of missing periods."""
    stepped = rows.select("series_id", "period", F.lag("period").over(by_series()).alias("previous_period")).filter("previous_period is not null")
    step = months_between_ends(F.col("period"), F.col("previous_period"))
    return stepped.withColumn("step_months", step).filter(F.col("step_months") > expected_step).withColumn("missing_periods", F.floor(F.col("step_months") / expected_step).cast("int") - 1)


def expected_grid(rows: DataFrame, months: int = 1) -> DataFrame:
    """(series_id, period, observed) of every expected period from a series' first to its last; series of one period have none.

    Each period gives itself and what is missing before the next, so the rows are read once and shuffled once, by series.
    """
    along = Window.partitionBy("series_id").orderBy("period")
    placed = rows.select("series_id", "period").distinct().select("series_id", "period", F.lead("period").over(along).alias("_next"), F.count("*").over(Window.partitionBy("series_id")).alias("_n")).filter("_n > 1")
    until = expected(F.col("period"), F.col("_next"), months)
    own = F.when(F.col("_next").isNull(), F.array("period")).otherwise(F.slice(until, 1, F.greatest(F.size(until) - 1, F.lit(1))))
    return placed.select("series_id", F.posexplode(own).alias("_at", "period")).select("series_id", "period", (F.col("_at") == 0).alias("observed"))


def jumps(rows: DataFrame, times: float = 10.0, least: int = 24) -> DataFrame:
    """Changes of more than so many times the series' own median change, in series with enough changes."""
    changes = rows.select("series_id", "period", "value", F.abs(F.col("value") - F.lag("value").over(by_series())).alias("change"))
    whole = Window.partitionBy("series_id")
    measured = changes.withColumn("median_change", F.median("change").over(whole)).withColumn("_n", F.count("change").over(whole))
    return measured.filter((F.col("_n") >= least) & (F.col("median_change") > 0) & (F.col("change") > times * F.col("median_change"))).drop("_n")


def divergence(rows: DataFrame, share: float = 0.01) -> DataFrame:
    """Concept periods in which series differ by more than a share of the level."""
    spread = rows.groupBy("concept_id", "period").agg(F.countDistinct("series_id").alias("n_series"), F.min("value").alias("lowest"), F.max("value").alias("highest"))
    return spread.filter((F.col("n_series") > 1) & (F.col("highest") - F.col("lowest") > share * F.greatest(F.abs("highest"), F.abs("lowest"))))


def duplicate_histories(rows: DataFrame) -> DataFrame:
    """Groups of series whose ordered history is the same; values as decimals, never as text of doubles."""
    entry = F.concat_ws("=", F.date_format("period", "yyyy-MM-dd"), F.col("value").cast("decimal(18,2)").cast("string"))
    history = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("period", entry.alias("e")))), lambda x: x["e"]), ";")
    signed = rows.groupBy("series_id").agg(F.md5(history.cast("binary")).alias("signature"), F.count("*").alias("n"))
    return signed.groupBy("signature").agg(F.count("*").alias("n_series"), F.min("series_id").alias("first_series"), F.max("n").alias("n_observations"))


def frequencies(rows: DataFrame) -> DataFrame:
    """Frequency from the median distance of neighbouring periods."""
    stepped = rows.select("series_id", months_between_ends(F.col("period"), F.lag("period").over(by_series())).alias("gap")).filter("gap is not null")
    return stepped.groupBy("series_id").agg(F.median("gap").alias("median_gap")).withColumn("frequency", inferred_frequency(F.col("median_gap")))


def worklist(rows: DataFrame, order: list, size: int = 2000) -> DataFrame:
    """The first rows with their rank, and how many there are in all."""
    top = rows.orderBy(*order).limit(size)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order))).crossJoin(F.broadcast(rows.agg(F.count("*").alias("total"))))
