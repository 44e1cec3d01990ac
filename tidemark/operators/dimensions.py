"""Economic dimensions of series from published titles and labels (K03): rules with a scope, one vote for each dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import normalized

RULE = "dimension string, scope string, source_id string, sheets array<string>, value string, pattern string"
#: Characters of the published wording on either side of what a rule matched.
AROUND = 30


def rules(spark: SparkSession, entries: list[tuple]) -> DataFrame:
    """Rules (dimension, scope, source_id, sheets, value, pattern): on the title or the label of one source's sheets, all where none are named."""
    return spark.createDataFrame(entries, RULE)


def derived_dimensions(series: DataFrame, entries: DataFrame) -> DataFrame:
    """(series_id, dimension, value, basis, evidence) in long form, of series (series_id, source_id, source_sheet, title, label).

    A rule is tried on the normalised text of its scope, once for each distinct text. Where patterns of two values of one
    dimension match, the dimension is left open, and so it is where a series' sheets disagree. Rules are a register of a few hundred.
    """
    texts = series.select("source_id", "source_sheet", F.explode(F.array(F.struct(F.lit("title").alias("scope"), F.col("title").alias("text")), F.struct(F.lit("label").alias("scope"), F.col("label").alias("text")))).alias("t"))
    texts = texts.select("source_id", "source_sheet", "t.scope", "t.text").filter("text is not null").distinct().withColumn("_t", normalized(F.col("text")))
    on = (texts["source_id"] == entries["source_id"]) & (texts["scope"] == entries["scope"]) & (F.coalesce(F.size("sheets"), F.lit(0)) <= 0) | (texts["source_id"] == entries["source_id"]) & (texts["scope"] == entries["scope"]) & F.array_contains("sheets", texts["source_sheet"])
    tried = texts.join(F.broadcast(entries), on).filter(F.expr("_t rlike pattern"))
    quote = F.expr(f"regexp_extract(_t, concat('.{{0,{AROUND}}}(?:', regexp_replace(pattern, '^\\\\^', ''), ').{{0,{AROUND}}}'), 0)")
    voted = tried.groupBy(texts["source_id"], "source_sheet", texts["scope"], "text", "dimension").agg(F.count_distinct("value").alias("n"), F.min("value").alias("value"), F.min(quote).alias("evidence")).filter("n = 1")
    voted = voted.select(F.col("source_id").alias("_source"), F.col("source_sheet").alias("_sheet"), F.col("scope").alias("_scope"), F.col("text").alias("_text"), "dimension", "value", "evidence")
    same = (F.col("source_id") == F.col("_source")) & (F.col("source_sheet") == F.col("_sheet")) & (F.col("_text") == F.when(F.col("_scope") == "title", F.col("title")).otherwise(F.col("label")))
    found = series.join(voted, same).groupBy("series_id", "dimension").agg(F.count_distinct("value").alias("n"), F.min("value").alias("value"), F.min("_scope").alias("_scope"), F.min("evidence").alias("evidence"))
    return found.filter("n = 1").select("series_id", "dimension", "value", F.concat(F.lit("published_"), "_scope").alias("basis"), "evidence")


def products(series: DataFrame, source_id: str, sheets: list[str], suffix: str = r"\s*[—-]\s*Importaci[oó]n.*$") -> DataFrame:
    """The product is what is left of a label without its regime segment."""
    own = series.filter((F.col("source_id") == source_id) & F.col("source_sheet").isin(sheets))
    rest = F.trim(F.regexp_replace("label", suffix, ""))
    one = own.groupBy("series_id").agg(F.min("label").alias("label")).withColumn("value", rest).filter("value <> ''")
    return one.select("series_id", F.lit("product").alias("dimension"), "value", F.lit("published_label").alias("basis"), F.concat(F.lit("Published row label: "), "label").alias("evidence"))
